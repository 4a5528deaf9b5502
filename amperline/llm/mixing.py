"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Each source has a share p of all tokens; its weight is p**a over the sum of all
p**a. At a = 1 the sources keep their shares, at a = 0 all weigh the same. The
exponent a is bisected to the smallest one that keeps every source within the
repetition limit, or to the one whose weights have the target entropy. Sums over
sources are Spark aggregations of the stored table of sources, so their number
does not matter to the driver.

A source's budget is its weight times the token budget. Its documents are dealt
into blocks by a hash of their id; in each epoch the blocks stand in a new order,
and the documents inside each block too. Whole epochs are given out as long as
the budget lasts, then whole blocks, and of the last block documents in order.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.session import durable


def token_count(text: Column) -> Column:
    """Words of a text."""
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)"), 1))


def _summed(sources: DataFrame, exponent: float) -> tuple[float, float, float]:
    """Entropy of the weights at an exponent, their largest repetition of a source, and the sum of p**a."""
    power = F.pow("_share", F.lit(exponent))
    z, plogp, steep = sources.agg(
        F.sum(power), F.sum(power * F.log("_share")), F.max(power / F.col("_share"))
    ).first()
    return float(-exponent * plogp / z + log(z)), float(steep / z), float(z)


def exponent_for(sources: DataFrame, entropy: float | None, repetitions: float, steps: int = 40) -> float:
    """Bisect the exponent on [0, 1].

    Both entropy and repetitions fall as the exponent grows. With a target entropy
    (natural units) it is the exponent that meets it, or the bound nearest to it;
    otherwise the smallest exponent whose most repeated source stays within
    `repetitions` passes of a budget of all tokens.
    """

    def too_flat(at: float) -> bool:
        found, most, _ = _summed(sources, at)
        return found > entropy if entropy is not None else most > repetitions

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if too_flat(middle) else (low, middle)
    return high


def source_weights(
    counted: DataFrame, entropy: float | None = None, repetitions: float = 4.0, budget: int | None = None
) -> DataFrame:
    """One row per source with tokens: its tokens, share, weight and budget."""
    by_source = counted.groupBy("_source").agg(F.sum("_tokens").alias("_all"), F.count("*").alias("_docs"))
    stored = durable(by_source.filter("_all > 0"))
    total = stored.agg(F.sum("_all")).first()[0] or 0
    shared = stored.withColumn("_share", F.col("_all") / F.lit(float(max(total, 1))))
    if not total:
        return shared.withColumn("_weight", F.lit(0.0)).withColumn("_budget", F.lit(0).cast("long"))
    exponent = exponent_for(shared, entropy, repetitions)
    weight = F.pow("_share", F.lit(exponent)) / F.lit(_summed(shared, exponent)[2])
    goal = F.floor(weight * F.lit(float(total if budget is None else budget)) + F.lit(1e-6)).cast("long")
    return shared.withColumn("_weight", weight).withColumn("_budget", goal)


def mix(
    docs: DataFrame,
    source: str = "source",
    entropy: float | None = None,
    repetitions: float = 4.0,
    budget: int | None = None,
    block_tokens: int = 200_000,
    seed: int = 17,
    into: tuple[str, str, str, str] = ("_epoch", "_block", "_order", "_weight"),
) -> DataFrame:
    """Documents as often as the mixture gives them out, in its order.

    `into` names the four columns added; columns of `docs` of these names are replaced.
    Returns every other column of `docs` and _epoch (0 first), _block and _order (position
    of the block in its epoch, and of the document in its block), _weight. Rows of
    a null source are one source. A text without words has no tokens and takes
    nothing from a budget: it goes with every whole block of its source; a source
    without any tokens gives out nothing. Repeated rows are documents of their own.
    `budget` is in words, all words of the table if None. An empty table stays empty.

    A document's block follows from its own hash, and budgets are cut between
    blocks first: running sums go over the table of blocks, and only the documents
    of the one cut block of a source are ordered by a window of about
    `block_tokens` words. A source that holds a third of all rows has more blocks,
    not a larger one.
    """
    docs = docs.drop(*into)
    fields = docs.columns
    names = [f"_c{i}" for i in range(len(fields))]
    plain = docs.toDF(*names)
    text, where, doc_id = (F.col(names[fields.index(n)]) for n in ("text", source, "doc_id"))
    counted = plain.withColumns(
        {"_source": where.cast("string"), "_tokens": token_count(text.cast("string")).cast("long"), "_doc": doc_id}
    )
    weights = source_weights(counted, entropy, repetitions, budget)
    facts = durable(
        weights.select(
            F.col("_source").alias("_s"),
            "_weight",
            "_budget",
            F.col("_all").alias("_source_tokens"),
            F.greatest(F.lit(1), F.ceil(F.col("_all") / F.lit(block_tokens))).cast("int").alias("_blocks"),
        )
    )
    dealt = counted.join(facts, F.col("_source").eqNullSafe(F.col("_s"))).withColumn(
        "_block", F.pmod(F.xxhash64(F.lit(seed), "_doc"), F.col("_blocks")).cast("int")
    )
    blocks = durable(_block_plan(dealt, facts, seed))
    key = (F.col("_source").eqNullSafe(F.col("_bs"))) & (F.col("_block") == F.col("_b"))
    given = dealt.join(blocks, key).withColumn("_passes", F.explode("_given")).select(
        *names, "_source", "_weight", "_doc", "_tokens", "_block", "_passes.*"
    )
    shuffled = F.xxhash64(F.lit(seed), F.col("_epoch"), F.col("_doc"))
    # the order inside a block is a hash; only a block that is cut needs running sums
    whole = given.filter("_left is null").withColumn("_at", shuffled)
    inside = Window.partitionBy("_source", "_block", "_epoch").orderBy("_at", "_doc", "_tokens")
    before = F.sum("_tokens").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    cut = (
        given.filter("_left is not null")
        .withColumn("_at", shuffled)
        .withColumn("_until", before)
        .filter((F.col("_until") <= F.col("_left")) & (F.col("_tokens") > 0))
        .drop("_until")
    )
    out = whole.unionByName(cut).select(
        *[F.col(n).alias(f) for n, f in zip(names, fields, strict=True)],
        F.col("_epoch").alias(into[0]),
        F.col("_place").alias(into[1]),
        F.col("_at").alias(into[2]),
        F.col("_weight").alias(into[3]),
    )
    return out


def _block_plan(dealt: DataFrame, facts: DataFrame, seed: int) -> DataFrame:
    """For each block the epochs it is given out in: whole, or with the tokens left for it."""
    held = dealt.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_held"), F.count("*").alias("_rows"))
    placed = held.join(
        facts.select("_s", "_budget", "_source_tokens"), F.col("_source").eqNullSafe(F.col("_s"))
    ).withColumn("_full", F.floor(F.col("_budget") / F.col("_source_tokens")).cast("int"))
    turn = F.xxhash64(F.lit(seed), F.col("_full"), F.col("_block"))
    running = Window.partitionBy("_source").orderBy(turn, "_block")
    until = F.sum("_held").over(running.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rest = F.col("_budget") - F.col("_full") * F.col("_source_tokens")
    left = rest - (F.col("_until") - F.col("_held"))
    none = F.array().cast("array<struct<_epoch: int, _place: bigint, _left: bigint>>")
    passes = F.transform(
        F.when(F.col("_full") > 0, F.sequence(F.lit(0), F.col("_full") - 1)).otherwise(F.array().cast("array<int>")),
        lambda e: F.struct(
            e.alias("_epoch"),
            F.xxhash64(F.lit(seed), e, F.col("_block")).alias("_place"),
            F.lit(None).cast("long").alias("_left"),
        ),
    )
    last = F.struct(
        F.col("_full").alias("_epoch"),
        turn.alias("_place"),
        F.when(F.col("_until") > rest, left).cast("long").alias("_left"),
    )
    more = F.when((left > 0) & (rest > 0), F.array(last)).otherwise(none)
    return placed.withColumn("_until", until).select(
        F.col("_source").alias("_bs"),
        F.col("_block").alias("_b"),
        F.concat(passes, more).alias("_given"),
    )


def mixture(docs: DataFrame) -> DataFrame:
    """doc_id, source, epoch, block and order keys, and weight of everything the mixture gives out."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("source").cast("string").alias("source"),
    )
    return mix(narrow).select(
        "doc_id",
        "source",
        F.col("_epoch").alias("epoch"),
        F.col("_block").alias("block_order"),
        F.col("_order").alias("doc_order"),
        F.round("_weight", 9).alias("weight"),
    )

"""Line dedup by a fixed-depth tree of log templates, in DataFrame operations only.

A line goes down the tree by its token count and its leading tokens, where a token
with a digit counts as a variable. Within a leaf, a token at a position is constant
if it is found there in at least `least` different texts, and a variable field (<*>)
otherwise. The line's template is its constants and fields; where fewer than half
of the tokens are constant the line is like no other and has none. Templates found
in at least `least` different texts recur, and their lines are dropped, wherever in
a text they stand. A group of near copies counts as one text, so copies of one
text, exact or with a few words changed, keep their lines.

Only texts with a line whose way down the tree is that of lines in `least` different
texts are looked at beyond the first pass: no other text can hold a recurring line.
Among them near copies are found by a sketch of each text, the smallest hashes of its runs of
words. Texts that share one of the first of these are compared with the one of
smallest key among them, and join it if the sketches tell a Jaccard similarity of
at least `COPY`. So no bucket is compared with itself pair by pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import SPACES, text_key
from amperline.session import durable

FIELD = "<*>"
#: White space between tokens.
_GAP = r"[\x20\x09-\x0D]+"
#: Words of a run, hashes of a sketch, hashes that bring texts together, least similarity of near copies.
RUN, SKETCH, BUCKETS, COPY = 5, 48, 8, 0.5


def _tokens(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(SPACES)), _GAP)


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(FIELD)).otherwise(token)


def _leaf(tokens: Column, depth: int) -> Column:
    """Hash of a line's way down the tree."""
    steps = [_masked(F.coalesce(F.get(tokens, F.lit(i)), F.lit(""))) for i in range(depth)]
    return F.xxhash64(F.size(tokens), *steps)


def tree_lines(docs: DataFrame, text: str, depth: int) -> DataFrame:
    """Every line that has tokens: its text's key, its position and its leaf."""
    split = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    # the key is made below the generator, once for each text and not for each of its lines
    keyed = docs.select(text_key(F.col(text)).alias("_text"), split.alias("_all"))
    lines = keyed.select("_text", F.posexplode("_all").alias("_pos", "_line"))
    filled = F.btrim(F.col("_line"), F.lit(SPACES)) != ""
    return lines.filter(filled).withColumn("_leaf", _leaf(_tokens(F.col("_line")), depth))


def _sketch() -> Column:
    """The smallest distinct hashes of all runs of _words (hashes of words), in order; a shorter text is one run."""
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - RUN, F.lit(0)))
    runs = F.transform(starts, lambda at: F.xxhash64(*[F.get("_words", at + i) for i in range(RUN)]))
    return F.slice(F.sort_array(F.array_distinct(runs)), 1, SKETCH)


def near_copies(texts: DataFrame) -> DataFrame:
    """Texts (_own, _body) that are near copies of another: _own, and the family it is counted with."""
    # the upper halves keep the order and take half the space
    short = F.transform("_low", lambda x: F.shiftright(x, 32).cast("int"))
    sketched = durable(
        texts.select("_own", F.transform(_tokens(F.col("_body")), lambda word: F.xxhash64(word)).alias("_words"))
        .select("_own", _sketch().alias("_low"))
        .select("_own", F.slice("_low", 1, BUCKETS).alias("_keys"), short.alias("_sketch"))
        .dropDuplicates(["_own"])
    )
    keys = sketched.select("_own", F.explode("_keys").alias("_key"))
    firsts = keys.groupBy("_key").agg(F.min("_own").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    pairs = keys.join(firsts.drop("_n"), "_key").filter("_own <> _first").select("_own", "_first").distinct()
    sketches = sketched.select("_own", "_sketch")
    both = pairs.join(sketches, "_own").join(sketches.toDF("_first", "_other"), "_first")
    union = F.slice(F.sort_array(F.array_union("_sketch", "_other")), 1, SKETCH)
    shared = F.size(F.array_intersect(F.array_intersect("_sketch", "_other"), "_union"))
    links = durable(
        both.withColumn("_union", union)
        .filter(shared >= COPY * F.size("_union"))
        .groupBy("_own")
        .agg(F.min("_first").alias("_family"))
    )
    # a text's first may have a smaller first itself
    for _ in range(3):
        onward = links.toDF("_family", "_next")
        links = durable(
            links.join(onward, "_family", "left").select("_own", F.coalesce("_next", "_family").alias("_family"))
        )
    return links


def _in_texts(found: DataFrame, *keys: str) -> DataFrame:
    """In how many different texts each key is found, near copies counted once."""
    return found.select(*keys, "_family").distinct().groupBy(*keys).agg(F.count("*").alias("_texts"))


def _at_place(at: Column, token: Column) -> Column:
    return F.concat(at.cast("string"), F.lit(" "), token)


def recurring_lines(docs: DataFrame, text: str, depth: int, least: int, alike: float) -> DataFrame:
    """Positions of recurring lines: one row per text that has any, with an array of them.

    Counts are of texts, near copies counted once, so copies of one text do not make
    its lines recur. Lines are counted by leaf first, without their text; a text that
    has none in a leaf of enough texts is not read again.
    """
    lines = tree_lines(docs, text, depth)
    places = durable(lines.select(F.xxhash64("_text").alias("_own"), "_leaf").distinct())
    often = _in_texts(places.withColumnRenamed("_own", "_family"), "_leaf").filter(F.col("_texts") >= least)
    shared = durable(places.join(often.select("_leaf"), "_leaf").select("_own", "_leaf").distinct())
    # ids only, so that they can be sent to the texts for as long as they are few
    wanted = durable(shared.select("_own").distinct())
    held = docs.select(F.xxhash64(text_key(F.col(text))).alias("_own"), F.col(text).cast("string").alias("_body"))
    held = durable(held.join(wanted, "_own", "left_semi"))
    families = near_copies(held)
    family = F.coalesce("_family", "_own").alias("_family")
    placed = shared.join(families, "_own", "left").select("_leaf", family)
    leaves = durable(_in_texts(placed, "_leaf").filter(F.col("_texts") >= least).select("_leaf"))
    found = tree_lines(held, "_body", depth).withColumn("_own", F.xxhash64("_text"))
    near = durable(
        found.join(leaves, "_leaf").distinct().join(families, "_own", "left")
        .select("_text", "_pos", "_line", "_leaf", family)
    )
    constants = (
        _in_texts(
            near.select("_leaf", "_family", F.posexplode(_tokens(F.col("_line"))).alias("_at", "_token")),
            "_leaf",
            "_at",
            "_token",
        )
        .filter(F.col("_texts") >= least)
        .groupBy("_leaf")
        .agg(F.collect_set(_at_place(F.col("_at"), F.col("_token"))).alias("_constants"))
    )
    spelled = near.select("_leaf", "_line").distinct().join(constants, "_leaf")
    parts = spelled.select(
        "_leaf",
        "_line",
        F.transform(
            _tokens(F.col("_line")),
            lambda token, at: F.when(F.array_contains("_constants", _at_place(at, token)), token).otherwise(FIELD),
        ).alias("_parts"),
    )
    variable = F.size(F.filter("_parts", lambda x: x == FIELD))
    templates = durable(
        parts.filter(F.size("_parts") - variable >= alike * F.size("_parts")).select(
            "_leaf", "_line", F.concat_ws(" ", "_parts").alias("_template")
        )
    )
    placed = near.join(templates, ["_leaf", "_line"])
    known = _in_texts(placed, "_leaf", "_template").filter(F.col("_texts") >= least)
    return (
        placed.join(known.select("_leaf", "_template"), ["_leaf", "_template"])
        .groupBy("_text")
        .agg(F.collect_set("_pos").alias("_drop"))
    )


def drop_recurring_lines(
    docs: DataFrame,
    text: str = "text",
    depth: int = 3,
    least: int = 10,
    alike: float = 0.5,
    into: tuple[str, str] = ("_lines", "_dropped"),
) -> DataFrame:
    """All columns of `docs`, the text without its recurring lines, and how many lines it had and lost.

    The counts are named by `into`; columns of `docs` of these names are replaced.

    Rows stay, also those whose text is nothing but recurring lines (then it is
    empty). A null text stays null and an empty one empty, each of one line without
    tokens; lines without tokens are never dropped. Repeated rows are treated alike
    and count as one text. Other columns, also of names used on the way, pass through.
    """
    docs = docs.drop(*into)
    fields = docs.columns
    names = [f"_c{i}" for i in range(len(fields))]
    plain = docs.toDF(*names)
    own = names[fields.index(text)]
    drops = recurring_lines(plain, own, depth, least, alike)
    lines = F.split(F.coalesce(F.col(own).cast("string"), F.lit("")), "\n")
    left = F.filter(lines, lambda _, at: ~F.array_contains("_drop", at))
    kept = F.when(F.col("_drop").isNull(), F.col(own)).otherwise(F.array_join(left, "\n"))
    joined = plain.withColumn("_text", text_key(F.col(own))).join(drops, "_text", "left")
    return joined.select(
        *[(kept if n == own else F.col(n)).alias(f) for n, f in zip(names, fields, strict=True)],
        F.size(lines).alias(into[0]),
        F.coalesce(F.size("_drop"), F.lit(0)).alias(into[1]),
    )


def line_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, lines, dropped lines and remaining text of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return drop_recurring_lines(narrow).select(
        "doc_id", F.col("_lines").alias("n_lines"), F.col("_dropped").alias("n_dropped"), "text"
    )

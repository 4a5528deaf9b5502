"""Hard negatives from exact inner products, found on lists that a cluster of anchors shares.

Anchors of one direction form a chunk. In each block of candidates a chunk sorts the
candidates once, by an upper bound that holds for all its members: with t the angle
between candidate and chunk centre and b the widest angle of a member to that centre,
no member's product exceeds |member| * |candidate| * cos(max(0, t - b)). Every member
walks that list and stops where the bound is below all it still looks for, which
certifies that nothing better follows in the block. Blocks are merged by Spark.

Candidates are dealt into parts by Spark, so are the chunks of anchors, a copy to
each part; a task holds one part and lets the chunks pass by.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amperline.llm.common import drawn_rows, record_batch, runs
from amperline.session import discard, durable, scratch_folder

#: Candidates that members of a chunk look at between two looks at the bound.
STRIDE = 512


def _matrix(vectors: pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors as rows; shorter ones are continued with zeros."""
    lists = vectors.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(width or 0, int(sizes.max(initial=0)))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


class Block:
    """Candidates of one part: ids, labels and vectors."""

    def __init__(self, rows: pa.Table) -> None:
        self.ids = rows.column("id").to_numpy()
        self.labels = rows.column("label").to_numpy()
        self.vectors = _matrix(rows.column("vector"))
        self.norms = np.sqrt((self.vectors**2).sum(axis=1))

    def bounds(self, members: np.ndarray) -> np.ndarray:
        """For each candidate: no member of length one has a larger product with it."""
        norms = np.sqrt((members**2).sum(axis=1))
        units = members[norms > 0] / norms[norms > 0, None]
        centre = units.sum(axis=0) if len(units) else np.zeros(members.shape[1])
        length = np.sqrt((centre**2).sum())
        if length < 1e-9:
            return self.norms.copy()
        centre = centre / length
        widest = np.arccos(np.clip(units @ centre, -1, 1)).max()
        cosine = np.divide(self.vectors @ centre, self.norms, out=np.ones(len(self.norms)), where=self.norms > 0)
        angle = np.arccos(np.clip(cosine, -1, 1))
        return self.norms * np.cos(np.maximum(0, angle - widest))


def _scores(members: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Integer products; below 2^53 floating point is exact, beyond it 64-bit integers are used."""
    most = np.abs(members).max(initial=0) * np.abs(candidates).max(initial=0) * members.shape[1]
    if most < 2**53:
        return (members @ candidates.T).astype(np.int64)
    return members.astype(np.int64) @ candidates.astype(np.int64).T


def walk(
    members: np.ndarray,
    block: Block,
    order: np.ndarray,
    bounds: np.ndarray,
    need: Callable[[int], float],
    see: Callable[[int, np.ndarray, np.ndarray], None],
) -> int:
    """Show candidates to members, best bound first, until no bound reaches what a member needs.

    ``see`` gets the member, the candidates' places and their scores; ``need`` says the
    least score that still matters to a member. Returns the number of products made.
    """
    norms = np.sqrt((members**2).sum(axis=1))
    active, made = np.arange(len(members)), 0
    for start in range(0, len(order), STRIDE):
        reach = norms[active] * bounds[order[start]] * (1 + 1e-9) + 1e-3
        active = active[reach >= [need(int(m)) for m in active]]
        if not len(active):
            break
        place = order[start : start + STRIDE]
        scores = _scores(members[active], block.vectors[place])
        made += scores.size
        for row, member in enumerate(active):
            see(int(member), place, scores[row])
    return made


class Best:
    """The best few of what was seen: higher scores first, ties by smaller ids."""

    def __init__(self, size: int, low: float = -np.inf, high: float = np.inf) -> None:
        self.size, self.low, self.high = size, low, high
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def need(self) -> float:
        """The least score that could still enter."""
        if self.low > self.high:
            return np.inf
        return max(self.low, float(self.scores[-1])) if len(self.scores) == self.size else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = np.flatnonzero((scores >= self.need()) & (scores <= self.high))
        if len(good):
            scores, ids = np.r_[self.scores, scores[good]], np.r_[self.ids, ids[good]]
            first = np.lexsort((ids, -scores))[: self.size]
            self.scores, self.ids = scores[first], ids[first]


def _walked(members: pa.Table, block: Block, bests: list[list[Best]], same: bool) -> None:
    """Fill what each member looks for from the block: rows of its own label, or of other labels."""
    vectors = _matrix(members.column("vector"), block.vectors.shape[1])
    if vectors.shape[1] > block.vectors.shape[1]:
        block.vectors = np.pad(block.vectors, ((0, 0), (0, vectors.shape[1] - block.vectors.shape[1])))
    bounds = block.bounds(vectors)
    order = np.argsort(-bounds, kind="stable")
    labels, ids = members.column("label").to_numpy(), members.column("id").to_numpy()
    for label in np.unique(labels):
        mine = np.flatnonzero(labels == label)
        listed = order[(block.labels[order] == label) == same]

        def see(m: int, place: np.ndarray, scores: np.ndarray, mine: np.ndarray = mine) -> None:
            found = block.ids[place]
            if same:
                other = found != ids[mine[m]]
                scores, found = scores[other], found[other]
            for best in bests[mine[m]]:
                best.add(scores, found)

        def need(m: int, mine: np.ndarray = mine) -> float:
            return min((best.need() for best in bests[mine[m]]), default=np.inf)

        walk(vectors[mine], block, listed, bounds, need, see)


def _over_parts(
    candidates: DataFrame, chunks: DataFrame, parts: int, same: bool, looked_for: Callable[[pa.Table], list[list[Best]]]
) -> DataFrame:
    """What the members of each chunk find in each part: their keys, the place of what they look for, id and score."""
    fields = [("akey", pa.int64()), ("anchor_id", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())]
    schema = pa.schema(fields)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, block = -1, None
        for (part, chunk), rows in runs(batches, "part", "chunk"):
            if chunk < 0:
                held, block = part, Block(rows)
            elif part == held:
                bests = looked_for(rows)
                _walked(rows, block, bests, same)
                keys, ids = rows.column("akey").to_numpy(), rows.column("id").to_numpy()
                flat = [(m, at, best) for m, several in enumerate(bests) for at, best in enumerate(several)]
                count = [len(best.ids) for _, _, best in flat]
                if sum(count):
                    who = np.repeat([m for m, _, _ in flat], count)
                    yield record_batch(
                        schema,
                        keys[who],
                        ids[who],
                        np.repeat([at for _, at, _ in flat], count),
                        np.concatenate([best.ids for _, _, best in flat]),
                        np.concatenate([best.scores for _, _, best in flat]),
                    )

    spread = chunks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = candidates.unionByName(spread, allowMissingColumns=True)
    dealt = both.repartition("part").sortWithinPartitions("part", "chunk")
    return dealt.mapInArrow(searched, "akey long, anchor_id long, place int, id long, score long")


def _centres(sample: np.ndarray, clusters: int) -> np.ndarray:
    """Directions of clusters of a sample of vectors, by a few rounds of spherical k-means."""
    norms = np.sqrt((sample**2).sum(axis=1, keepdims=True))
    units = np.divide(sample, norms, out=np.zeros_like(sample), where=norms > 0)
    centres = units[:: max(1, len(units) // clusters)][:clusters].copy()
    for _ in range(8):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        length = np.sqrt((sums**2).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def _chunked(queries: DataFrame, clusters: int, members: int, sample: int) -> DataFrame:
    """Anchors with the number of their chunk; chunks are pieces of one cluster, of about `members` each."""
    drawn = drawn_rows(queries, F.xxhash64("akey", F.lit(3)), queries.count(), sample).select("vector").toArrow()
    if not drawn.num_rows:
        return queries.withColumn("chunk", F.lit(0).cast("long"))
    centres = _centres(_matrix(drawn.column("vector")), clusters)
    fields = [("id", pa.int64()), ("akey", pa.int64()), ("label", pa.int64()), ("vector", pa.list_(pa.float64()))]
    schema = pa.schema([*fields, ("cluster", pa.int64())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(pa.chunked_array([batch.column("vector")]), centres.shape[1])[:, : centres.shape[1]]
            yield record_batch(schema, *[batch.column(n) for n, _ in fields], (vectors @ centres.T).argmax(axis=1))

    placed = queries.select([n for n, _ in fields]).mapInArrow(
        assigned, "id long, akey long, label long, vector array<double>, cluster long"
    )
    # one count per cluster, `clusters` of them at most
    counts = placed.groupBy("cluster").agg(F.ceil(F.count("*") / F.lit(members)).alias("pieces"))
    numbered = placed.join(F.broadcast(counts), "cluster")
    piece = F.col("cluster") * F.lit(1 << 32) + F.pmod(F.xxhash64("akey", F.lit(9)), F.col("pieces"))
    return numbered.withColumn("chunk", piece).drop("cluster", "pieces")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    clusters: int = 64,
    members: int = 512,
    sample: int = 4096,
) -> DataFrame:
    """For each anchor and positive the best rows of other labels within a band of the positive's score.

    `rows` has id long, label long and vector array<double> of whole numbers. The
    positives of an anchor are its `positives` best rows of the same label and another
    id; a negative has another label and a score from `low` to `high` per cent of the
    positive's. Higher scores come first, ties by smaller id. Returns anchor_id,
    positive_id, rank, negative_id, positive_score and negative_score.

    Rows without id, label or vector, or with a null or non-finite component, take no
    part. Rows of one id are never positives of each other; an anchor row repeated as a
    whole is one anchor, other repeated rows count each. Vectors of unequal length are
    continued with zeros. Products beyond 2^63 wrap around. Directions of clusters are
    fitted on `sample` anchors; they set the order of work and no result. An empty
    table gives an empty result, further columns are not read.
    """
    spark = rows.sparkSession
    places = [scratch_folder(spark) for _ in range(4)]
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = rows.select("id", "label", "vector", is_anchor.alias("asks")).filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
    )
    whole = durable(whole, places[0])
    keyed = whole.filter("asks").select("id", "label", "vector", F.xxhash64("id", "label", "vector").alias("akey"))
    queries = durable(keyed.dropDuplicates(["id", "akey"]), places[1])
    chunks = durable(_chunked(queries, clusters, members, sample), places[2])
    # part sizes grow with the root of the table, so that chunks are copied to few parts and a part fits in a task
    total = whole.count()
    parts = max(1, -(-total // min(131_072, max(1024, 16 * isqrt(total)))))
    candidates = whole.select(
        F.pmod(F.xxhash64("id", "vector"), F.lit(parts)).cast("int").alias("part"),
        F.lit(-1).cast("long").alias("chunk"),
        "id",
        "label",
        "vector",
    )

    def any_positive(members: pa.Table) -> list[list[Best]]:
        return [[Best(positives)] for _ in range(members.num_rows)]

    def in_bands(members: pa.Table) -> list[list[Best]]:
        wanted = members.column("wanted").to_pylist()
        return [[Best(negatives, -(-s * low // 100), s * high // 100) for s in several] for several in wanted]

    key = ["anchor_id", "akey"]
    best = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
    near = _over_parts(candidates, chunks, parts, True, any_positive)
    near = near.withColumn("place", F.row_number().over(best) - 1).filter(F.col("place") < positives)
    near = durable(near.withColumnsRenamed({"id": "positive_id", "score": "positive_score"}), places[3])
    # at most `positives` scores for each anchor, in the order of their places
    scores = near.groupBy(*key).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "positive_score"))), lambda x: x["positive_score"]).alias(
            "wanted"
        )
    )
    asking = chunks.join(scores.withColumnRenamed("anchor_id", "id"), ["id", "akey"])
    found = _over_parts(candidates, asking, parts, False, in_bands)
    within = Window.partitionBy(*key, "place").orderBy(F.desc("score"), "id")
    found = found.withColumn("rank", F.row_number().over(within)).filter(F.col("rank") <= negatives)
    result = durable(
        found.join(near, [*key, "place"]).select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )
    discard(spark, *places)
    return result


def mined_negatives(embeddings: DataFrame) -> DataFrame:
    """Hard negatives of embeddings: labels shifted where vec_id is divisible by 7, components scaled by 256."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    finite = F.transform("embedding", lambda x: F.when(~F.isnan(x) & (F.abs(x) < float("inf")), F.floor(x.cast("double") * 256)))
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("id"), label.alias("label"), finite.cast("array<double>").alias("vector")
    )
    return hard_negatives(rows, F.col("id") % 50 == 0)

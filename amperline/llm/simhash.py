"""SimHash near-duplicates: fingerprints meet at the words of a covering code.

The anchors are the words of an extended BCH code of 64 bits, far apart and spread
evenly, so that every fingerprint is near one: its distance to the nearest is its
radius, never more than the covering radius of the code. A fingerprint is at home
with one nearest anchor, and is copied to every anchor within its radius plus the
threshold.

No link is lost: let x and y differ in at most t bits and let x have the smaller (or
an equal) radius. The home of x is at most radius(x) + t <= radius(y) + t away from y,
so y was copied there. At each anchor those at home are compared with all that were
copied to it. Spark groups by anchor; an anchor of many members is dealt in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import record_batch, runs, small_batches
from amperline.llm.jaccard import components
from amperline.session import discard, durable, scratch_folder

#: x^6 + x + 1, a primitive polynomial of the field of 64 elements.
_FIELD = 0b1000011


def anchors(powers: tuple[int, ...]) -> np.ndarray:
    """Words of the code spanned by all ones and the traces of a * x^p, for the given powers p, over the field.

    (1, 3) gives 2^13 words, (1, 3, 9) 2^16 and (1, 3, 5) 2^19.
    """
    power = [1]
    while len(power) < 63:
        power.append(power[-1] << 1 ^ (_FIELD if power[-1] & 32 else 0))
    log = {x: at for at, x in enumerate(power)}

    def trace(exponent: int) -> int:
        total = 0
        for step in range(6):
            total ^= power[exponent * 2**step % 63]
        return total

    words, basis = np.zeros(1, np.uint64), []
    rows = [2**64 - 1]
    for p in powers:
        for a in range(6):
            rows.append(sum(trace(a + p * log[x]) << x for x in power))
    for row in rows:
        rest = row
        for known in basis:
            rest = min(rest, rest ^ known)
        if rest:
            basis.append(rest)
            words = np.concatenate([words, words ^ np.uint64(row)])
    return words


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the runs of `width` words of a text, repeats included; words are cut at ASCII white space.

    A bit is 1 if it is set in more than half of the XXH64 hashes. A text of fewer
    words is one run; null and a text without words give zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    count = max(1, len(words) - width + 1)
    hashed = xxhash.xxh64_intdigest
    hashes = np.fromiter((hashed(b" ".join(words[i : i + width]), seed) for i in range(count)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 65_536):
        ones += np.unpackbits(hashes[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(ones * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            found = np.array([fingerprint(t, width, seed) for t in batch.column("text").to_pylist()], np.uint64)
            yield record_batch(schema, batch.column("doc_id"), found.view(np.int64))

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


def at_anchors(prints: DataFrame, powers: tuple[int, ...], most: int) -> DataFrame:
    """One row per fingerprint and anchor within its radius plus `most`; `home` marks one nearest anchor."""
    schema = pa.schema([("anchor", pa.int32()), ("fp", pa.int64()), ("home", pa.bool_())])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = anchors(powers)
        step = max(1, 2**20 // len(words))
        for batch in batches:
            values = batch.column("fp").to_numpy().view(np.uint64)
            for at in range(0, len(values), step):
                part = values[at : at + step]
                away = np.bitwise_count(part[:, None] ^ words[None, :])
                home = away.argmin(axis=1)
                radius = away[np.arange(len(part)), home]
                row, anchor = np.nonzero(away <= (radius + most)[:, None])
                yield record_batch(schema, anchor.astype(np.int32), part[row].view(np.int64), home[row] == anchor)

    return prints.select("fp").mapInArrow(dealt, "anchor int, fp long, home boolean")


def cells(members: DataFrame, block: int) -> DataFrame:
    """Members of every anchor, dealt into cells of a block of those at home and a block of all its members.

    The counts are one row per word of the code, a fixed number, so that they may be broadcast.
    """
    counts = members.groupBy("anchor").agg(F.count_if("home").alias("homes"), F.count("*").alias("members"))
    blocks = counts.filter("homes > 0").select(
        "anchor",
        F.ceil(F.col("homes") / F.lit(block)).cast("int").alias("rows"),
        F.ceil(F.col("members") / F.lit(block)).cast("int").alias("cols"),
    )
    drawn = F.xxhash64("fp", F.lit(7))
    known = members.join(F.broadcast(blocks), "anchor").select(
        "anchor", "fp", "home", "rows", "cols", F.pmod(drawn, "rows").alias("row"), F.pmod(drawn, "cols").alias("col")
    )
    # a row at home goes to all cells of its row of blocks, and any row to all cells of its column
    at_home = known.filter("home").select(
        "anchor", "row", F.explode(F.sequence(F.lit(0), F.col("cols") - 1)).alias("col"), "fp", F.lit(0).alias("side")
    )
    copied = known.select(
        "anchor", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("row"), "col", "fp", F.lit(1).alias("side")
    )
    return at_home.withColumn("row", F.col("row").cast("int")).unionByName(copied.withColumn("col", F.col("col").cast("int")))


def joined(home: np.ndarray, other: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Values that have a link between `home` and `other`, and the smallest value each hangs together with."""
    values = np.unique(np.concatenate([home, other]))
    mine, theirs = np.searchsorted(values, home), np.searchsorted(values, other)
    root = np.arange(len(values))

    def top(at: int) -> int:
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return int(at)

    step = max(1, 2**21 // max(1, len(other)))
    for start in range(0, len(home), step):
        near = np.bitwise_count(home[start : start + step, None] ^ other[None, :]) <= most
        for row in np.flatnonzero(near.any(axis=1)):
            at = int(mine[start + row])
            for t in {top(int(x)) for x in np.unique(root[theirs[near[row]]])}:
                a, b = top(at), t
                root[max(a, b)] = min(a, b)
    ends = np.array([top(i) for i in range(len(values))], np.int64)
    hung = np.flatnonzero(ends != np.arange(len(values)))
    return values[hung], values[ends[hung]]


def links(dealt: DataFrame, most: int) -> DataFrame:
    """For each cell the fingerprints that hang together there, as pairs of one and the smallest of its group."""
    schema = pa.schema([("key", pa.int64()), ("root", pa.int64())])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in runs(batches, "anchor", "row", "col"):
            values = group.column("fp").to_numpy().view(np.uint64)
            side = group.column("side").to_numpy()
            one, other = joined(values[side == 0], values[side == 1], most)
            if len(one):
                yield record_batch(schema, one.view(np.int64), other.view(np.int64))

    sorted_cells = dealt.repartition("anchor", "row", "col").sortWithinPartitions("anchor", "row", "col")
    return sorted_cells.mapInArrow(compared, "key long, root long")


def fingerprint_components(
    docs: DataFrame,
    width: int = 3,
    most: int = 3,
    seed: int = 42,
    powers: tuple[int, ...] = (1, 3),
    block: int = 8192,
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of `docs`.

    Rows are linked if their fingerprints differ in `most` bits or fewer; component_id
    is the smallest doc_id that links reach, null if all ids there are null. Texts that
    are null, empty or without words share the fingerprint zero, linked like any other;
    repeated rows give repeated results; an empty table gives none. Columns besides
    doc_id and text are not read, whatever their names. `powers` sets the number of
    anchors: more of them mean more copies of a fingerprint and fewer comparisons.
    """
    spark = docs.sparkSession
    places = [scratch_folder(spark) for _ in range(4)]
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prints = durable(fingerprints(narrow, width, seed))
    nodes = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), places[0])
    members = durable(at_anchors(nodes, powers, most), places[1])
    found = durable(links(cells(members, block), most), places[2])
    roots = components(found)
    known = nodes.join(roots, nodes["fp"] == roots["key"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = known.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = durable(known.join(classes, "root").select("fp", "component_id"), places[3])
    discard(spark, *places[:3])
    return prints.join(facts, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )

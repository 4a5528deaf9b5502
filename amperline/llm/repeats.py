"""Removal of repeated byte strings by suffix sorting, shard by shard.

A string of `length` bytes that starts in two places has the same least window hash
at the same offset in both (its anchor), so both are in the shard of that hash. A
first pass counts anchors; those that occur once cannot lie in a repeat. For the
others the bytes around them, the strings they stand for, go to the shards. Each
shard is sorted by induction with common-prefix values; a start is repeated if the
suffix before or after it shares `length` bytes. Starts are joined to runs per text,
and the runs are cut from it.

A shard's queues are spilled and merged by Spark: shards are rows sorted by their
key on disk, and a task takes them in batches of a few megabytes. An anchor that is
in very many texts is cut into shards by the offset of the string to it.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import mixed, record_batch, small_batches, text_key
from amperline.llm.induced import CAP, suffix_queues
from amperline.session import durable

LENGTH = CAP
#: Bytes under one window hash; any LENGTH bytes hold LENGTH - WINDOW + 1 windows.
WINDOW = 64
_BASE = 0x9E3779B97F4A7C15 | 1
_LETTERS = mixed(np.arange(1, 257, dtype=np.uint64))


def _powers(base: int, size: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(size - 1, base, np.uint64)])


def window_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the WINDOW bytes from each place on."""
    inverse = pow(_BASE, -1, 1 << 64)
    sums = np.r_[np.uint64(0), np.cumsum(_LETTERS[data] * _powers(_BASE, len(data)))]
    count = len(data) - WINDOW + 1
    return mixed((sums[WINDOW:] - sums[:-WINDOW]) * _powers(inverse, count))


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text: hash, place, and the first and last start of the strings they stand for.

    The anchor of a string is the least of its window hashes, the first of equal ones.
    """
    hashes = window_hashes(data)
    span = LENGTH - WINDOW + 1
    count = len(hashes) - span + 1
    low32 = np.uint64(0xFFFFFFFF)
    ranked = (hashes & ~low32) | np.arange(len(hashes), dtype=np.uint64)
    # least of each span, from least values up to and from block borders
    size = -(-len(ranked) // span) * span
    blocks = np.full(size, np.uint64(2**64 - 1))
    blocks[: len(ranked)] = ranked
    blocks = blocks.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    place = (np.minimum(behind[:count], ahead[span - 1 : span - 1 + count]) & low32).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return hashes[place[first]].view(np.int64), place[first], first, np.r_[first[1:], count] - 1


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)


def anchor_table(texts: DataFrame) -> DataFrame:
    """Anchors of every text of LENGTH bytes or more; a text met again in the same task is passed over."""
    schema = pa.schema(
        [("hash", pa.int64()), ("key", pa.binary()), ("place", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]
    )

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in small_batches(batches, "text"):
            columns = [[np.zeros(0, np.int64)] for _ in range(4)]
            keys = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                data = _bytes(text)
                if len(data) < LENGTH or key in seen:
                    continue
                if len(seen) < 500_000:
                    seen.add(key)
                rows = anchors(data)
                for column, values in zip(columns, rows, strict=True):
                    column.append(values)
                keys += [key] * len(rows[0])
            hashes, place, first, last = map(np.concatenate, columns)
            yield record_batch(schema, hashes, keys, place, first, last)

    return texts.select("key", "text").mapInArrow(found, "hash long, key binary, place long, first long, last long")


def repeated_anchors(texts: DataFrame, most: int) -> DataFrame:
    """Per text its anchors that are elsewhere too, each with the number of shards of its hash.

    `most` is the number of anchors of one hash beyond which it is cut by offset.
    """
    table = durable(anchor_table(texts))
    # a text can come from several tasks; what is counted are its places, by their hash and the text's key
    own = F.xxhash64("key", "place")
    several = (
        table.groupBy("hash")
        .agg(F.count("*").alias("rows"), F.min(own).alias("low"), F.max(own).alias("high"))
        .filter("low <> high")
    )
    parts = F.least(F.lit(LENGTH - WINDOW + 1), F.ceil(F.col("rows") / F.lit(most))).cast("int")
    kept = table.join(several.select("hash", parts.alias("parts")), "hash").distinct()
    return kept.groupBy("key").agg(F.collect_list(F.struct("hash", "place", "first", "last", "parts")).alias("anchors"))


def shard_rows(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """The bytes each repeated anchor stands for, once for each text and shard."""
    schema = pa.schema([("shard", pa.int64()), ("key", pa.binary()), ("start", pa.int64()), ("data", pa.binary())])
    span = LENGTH - WINDOW + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            for row in batch.to_pylist():
                data = _bytes(row["text"]).tobytes()
                out: tuple[list, list, list, list] = ([], [], [], [])
                for a in row["anchors"]:
                    width = -(-span // a["parts"])
                    # offsets of the anchor in its strings, cut at multiples of the width
                    low, high = a["place"] - a["last"], a["place"] - a["first"]
                    for part in range(low // width, high // width + 1):
                        first = max(a["first"], a["place"] - (part + 1) * width + 1)
                        last = min(a["last"], a["place"] - part * width)
                        code = np.array([a["hash"]], np.int64).view(np.uint64) + np.uint64(part)
                        out[0].append(int(mixed(code).view(np.int64)[0]))
                        out[1].append(row["key"])
                        out[2].append(first)
                        out[3].append(data[first : last + LENGTH])
                yield record_batch(schema, *out)

    joined = texts.join(chosen, "key").select("key", "text", "anchors")
    return joined.mapInArrow(cut, "shard long, key binary, start long, data binary")


def _starts_in(pieces: list[bytes]) -> list[np.ndarray]:
    """Of each piece the starts whose LENGTH bytes are found at another start of the batch."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    # bytes 0 to 253 move up by two; 0 ends the text and 1 ends a piece (UTF-8 has no byte above 0xF4)
    text = np.frombuffer(b"\xff".join(pieces) + b"\xfe", np.uint8) + np.uint8(2)
    hit = np.zeros(len(text), bool)
    for order, shared in suffix_queues(text):
        same = shared >= LENGTH
        hit[order[same | np.r_[same[1:], False]]] = True
    begin = np.r_[0, np.cumsum(sizes + 1)[:-1]]
    return [np.flatnonzero(hit[b : b + max(0, n - LENGTH + 1)]) for b, n in zip(begin, sizes, strict=True)]


def repeated_starts(shards: DataFrame, batch_bytes: int) -> DataFrame:
    """Runs of repeated starts of each text: key, first and last start."""
    schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("last", pa.int64())])

    def solved(pieces: list[bytes], owners: list[set]) -> pa.RecordBatch:
        out: tuple[list, list, list] = ([], [], [])
        for data, own, hits in zip(pieces, owners, _starts_in(pieces), strict=True):
            if len(own) > 1:
                hits = np.arange(len(data) - LENGTH + 1)
            if len(hits):
                cuts = np.flatnonzero(np.diff(hits) != 1)
                runs = list(zip(np.r_[hits[0], hits[cuts + 1]].tolist(), np.r_[hits[cuts], hits[-1]].tolist(), strict=True))
                for key, start in own:
                    for first, last in runs:
                        out[0].append(key)
                        out[1].append(start + first)
                        out[2].append(start + last)
        return record_batch(schema, *out)

    def known(data: bytes, own: set) -> pa.RecordBatch:
        keys, starts = zip(*own, strict=True)
        return record_batch(schema, keys, starts, [s + len(data) - LENGTH for s in starts])

    def sort_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # shards are complete where the next one begins; several small ones are sorted as one text;
        # equal pieces of a shard are sorted once, and not at all if the shard has no other
        pieces: list[bytes] = []
        owners: list[set] = []
        shard: dict[bytes, set] = {}
        current, held = None, 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != current:
                    if len(shard) > 1:
                        pieces += shard.keys()
                        owners += shard.values()
                        held += sum(map(len, shard))
                    for data, own in shard.items() if len(shard) == 1 else ():
                        if len(own) > 1:
                            yield known(data, own)
                    shard, current = {}, row["shard"]
                    if held > batch_bytes:
                        yield solved(pieces, owners)
                        pieces, owners, held = [], [], 0
                # a text whose row is repeated sends the same place twice
                shard.setdefault(row["data"], set()).add((row["key"], row["start"]))
        pieces += shard.keys()
        owners += shard.values()
        if pieces:
            yield solved(pieces, owners)

    placed = shards.repartition("shard").sortWithinPartitions("shard")
    return placed.mapInArrow(sort_shards, "key binary, first long, last long")


def remove_repeats(docs: DataFrame, most: int = 4096, batch_bytes: int = 1_500_000) -> DataFrame:
    """All columns of `docs`, and _bytes, _removed, _spans, _kept_sha256 and _kept, the bytes that stay.

    Every byte under a string of 400 bytes that starts at another place too, of the
    same or another row, is removed; strings are judged on the whole input. Equal
    texts are sorted once: of a text in two rows or more all bytes go if it has 400.
    A null or empty text, and any below 400 bytes, stays as it is (null: no bytes).
    Ids may be null or repeated. An empty table stays empty.
    """
    fields = docs.columns
    names = [f"_c{i}" for i in range(len(fields))]
    plain = docs.toDF(*names)
    text = F.col(names[fields.index("text")]).cast("string")
    doc_id = F.col(names[fields.index("doc_id")]).cast("long")
    keyed = plain.select(text_key(text).alias("key"), doc_id.alias("doc_id"), text.alias("text"))
    texts = durable(keyed.groupBy("key").agg(F.count("*").alias("copies"), F.min("doc_id").alias("reader")))
    chosen = durable(repeated_anchors(keyed, most))
    reader = chosen.join(texts.select("key", "reader"), "key")
    once = keyed.join(reader.select("key", "reader"), "key").filter(F.col("doc_id").eqNullSafe(F.col("reader")))
    runs = repeated_starts(shard_rows(once.select("key", "text"), chosen), batch_bytes)
    per_text = durable(runs.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("runs")))
    copied = texts.filter("copies > 1").select("key", F.lit(True).alias("copied"))
    facts = per_text.join(copied, "key", "full").select("key", "runs", F.coalesce("copied", F.lit(False)).alias("copied"))
    rows = plain.withColumn("key", text_key(text)).join(facts, "key", "left").drop("key")
    return _cut(rows, names, fields)


def _cut(rows: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    own = names[fields.index("text")]
    kinds = dict(rows.dtypes)
    added = [
        ("_bytes", pa.int64(), "long"),
        ("_removed", pa.int64(), "long"),
        ("_spans", pa.int64(), "long"),
        ("_kept_sha256", pa.string(), "string"),
        ("_kept", pa.binary(), "binary"),
    ]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, own):
            out: list[list] = [[] for _ in added]
            texts, runs, copied = (batch.column(c).to_pylist() for c in (own, "runs", "copied"))
            for value, spans, twice in zip(texts, runs, copied, strict=True):
                data = _bytes(value)
                edges = np.zeros(len(data) + 1, np.int64)
                if twice and len(data) >= LENGTH:
                    edges[0], edges[-1] = 1, -1
                for run in spans or ():
                    edges[run["first"]] += 1
                    edges[run["last"] + LENGTH] -= 1
                gone = np.cumsum(edges[:-1]) > 0
                kept = data[~gone].tobytes()
                starts = int((gone & ~np.r_[False, gone[:-1]]).sum()) if len(gone) else 0
                row = (len(data), int(gone.sum()), starts, sha256(kept).hexdigest(), kept)
                for column, item in zip(out, row, strict=True):
                    column.append(item)
            plain = [batch.column(n) for n in names]
            extra = [pa.array(c, type=t) for c, (_, t, _) in zip(out, added, strict=True)]
            yield pa.RecordBatch.from_arrays([*plain, *extra], [*names, *(n for n, _, _ in added)])

    schema = ", ".join([*(f"{n} {kinds[n]}" for n in names), *(f"{n} {k}" for n, _, k in added)])
    return rows.mapInArrow(cut, schema).toDF(*fields, *(n for n, _, _ in added))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return remove_repeats(narrow).select(
        "doc_id",
        F.col("_bytes").alias("n_bytes"),
        F.col("_removed").alias("n_removed"),
        F.col("_spans").alias("n_spans"),
        F.col("_kept_sha256").alias("kept_sha256"),
    )

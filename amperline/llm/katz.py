"""Katz backoff scores with Good-Turing discounts, word pairs backing off to words.

Texts are packed into blocks: local word numbers, and a 64-bit hash for each word.
Counts, and later the mass each history keeps, are exchanged by key: a block sends
its distinct keys with its own sums to the partitions of a table ordered by key, and
gets the sums over all blocks back. A pair or word is sent once for each block, also
where a third of all tokens are equal. A pair's key is a hash of both words, so of n
pairs about n / 2**64 share one.

P(w) = d(c(w)) c(w) / N for known words; the rest of the mass is the one unknown word's.
P(w|h) = d(c(hw)) c(hw) / c(h) for known pairs, otherwise a(h) P(w) with
a(h) = (1 - sum of P(w|h) over known pairs) / (1 - sum of P(w) over the same words).
The discounts d(1) to d(5) are Katz's from counts of counts; where these give no
value in (0, 1] it is (r - 1/2) / r. Counts above 5 give up a thousandth of one, so
that every history leaves some mass; a history never met has a(h) = 1.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import WordHash, fold, mixed, record_batch, small_batches
from amperline.session import discard, durable, scratch_folder

TOP = 5
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_REPLY = "block long, bucket int, sums binary, owned binary"
_SENT = "block long, bucket int, size int, keys binary, sums binary"


def pack(values: np.ndarray) -> bytes:
    """Compressed array; bytes of equal weight lie together."""
    values = np.ascontiguousarray(values)
    return zlib.compress(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T.tobytes(), 1)


def unpack(data: bytes, kind: type) -> np.ndarray:
    """The array that was packed."""
    raw = np.frombuffer(zlib.decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel()


def text_blocks(docs: DataFrame, most: int, folder: str | None = None) -> DataFrame:
    """Blocks of about `most` bytes of text: ids and lengths of texts, tokens as word numbers, hashes of words."""
    schema = pa.schema(
        [(n, pa.list_(t)) for n, t in (("doc_id", pa.int64()), ("held", pa.bool_()), ("lengths", pa.int64()))]
        + [(n, pa.binary()) for n in ("tokens", "words")]
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, number, size = WordHash(), {}, 0
        ids, held, lengths, tokens = [], [], [], []

        def block() -> pa.RecordBatch:
            words = hashes.of(list(number))
            flat = np.concatenate(tokens)
            return record_batch(schema, [ids], [held], [lengths], [pack(flat)], [pack(words)])

        for batch in small_batches(batches, "text"):
            for row in batch.to_pylist():
                raw = (row["text"] or "").encode("utf-8", "surrogatepass").translate(_LOWER)
                found = [*raw.split(), b""]  # the empty word is the end
                tokens.append(np.fromiter((number.setdefault(w, len(number)) for w in found), np.int32, len(found)))
                ids.append(row["doc_id"])
                held.append(row["held"])
                lengths.append(len(found))
                size += len(raw) + 1
                if size >= most:
                    yield block()
                    number, size = {}, 0
                    ids, held, lengths, tokens = [], [], [], []
        if ids:
            yield block()

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold(F.col("doc_id"), 7) == 2, F.lit(False)).alias("held"),
        F.col("text").cast("string").alias("text"),
    )
    shape = "doc_id array<long>, held array<boolean>, lengths array<long>, tokens binary, words binary"
    return durable(narrow.mapInArrow(packed, shape).withColumn("block", F.monotonically_increasing_id()), folder)


def _send(block: int, keys: np.ndarray, sums: list[np.ndarray], bits: int) -> list[tuple]:
    """A block's sorted distinct keys and their sums, cut by the leading bits of the key."""
    cuts = np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1)) if bits else np.array([0, len(keys)])
    out = []
    for bucket in np.flatnonzero(np.diff(cuts)):
        part = slice(cuts[bucket], cuts[bucket + 1])
        gaps = np.diff(keys[part], prepend=np.uint64(0))
        out.append((block, int(bucket), int(len(gaps)), pack(gaps), pack(np.concatenate([s[part] for s in sums]))))
    return out


def _sent_batch(rows: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema(
        [("block", pa.int64()), ("bucket", pa.int32()), ("size", pa.int32()), ("keys", pa.binary()), ("sums", pa.binary())]
    )
    return record_batch(schema, *(zip(*rows, strict=True) if rows else [[]] * 5))


def exchange(
    sent: DataFrame, count: Callable[[np.ndarray], np.ndarray] | None = None, folder: str | None = None
) -> DataFrame:
    """Sums over all blocks for what each block sent, and which of its keys it is the first to send.

    With `count`, each bucket also gives a row of block -1 with its result for the first sums.
    """
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("sums", pa.binary()), ("owned", pa.binary())])

    def answer(rows: list[dict]) -> pa.RecordBatch:
        sizes = [r["size"] for r in rows]
        keys = np.concatenate([np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in rows])
        own = [unpack(r["sums"], np.float64).reshape(-1, n) for r, n in zip(rows, sizes, strict=True)]
        _, first, number = np.unique(keys, return_index=True, return_inverse=True)
        totals = [np.bincount(number, np.concatenate([x[i] for x in own])) for i in range(len(own[0]))]
        owned = np.zeros(len(keys), np.uint8)
        owned[first] = 1
        out = ([], [], [], [])
        ends = np.cumsum(sizes)
        for row, end, size in zip(rows, ends, sizes, strict=True):
            part = slice(end - size, end)
            answers = (row["block"], row["bucket"], pack(np.concatenate([t[number[part]] for t in totals])), pack(owned[part]))
            for column, value in zip(out, answers, strict=True):
                column.append(value)
        if count:
            for column, value in zip(out, (-1, rows[0]["bucket"], pack(count(totals[0])), b""), strict=True):
                column.append(value)
        return record_batch(schema, *out)

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["bucket"] != row["bucket"]:
                    yield answer(held)
                    held = []
                held.append(row)
        if held:
            yield answer(held)

    return durable(sent.repartition("bucket").sortWithinPartitions("bucket", "block").mapInArrow(answered, _REPLY), folder)


def _counts_of_counts(totals: np.ndarray) -> np.ndarray:
    """Tokens, types, and types of each count up to TOP + 1."""
    exact = [(totals == r).sum() for r in range(1, TOP + 2)]
    return np.array([totals.sum(), (totals > 0).sum(), *exact], np.float64)


def _statistics(replies: DataFrame) -> np.ndarray:
    """Sum of the statistics of all buckets; a few numbers from each, added up in pairs by tasks."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(TOP + 3)
        for batch in batches:
            for data in batch.column("sums").to_pylist():
                total += unpack(data, np.float64)
        yield pa.record_batch([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["found"])

    rows = replies.filter("block = -1").select("sums").mapInArrow(summed, "found array<double>")
    sums = rows.agg(*[F.sum(F.col("found")[i]).alias(f"s{i}") for i in range(TOP + 3)]).first()
    return np.array([x or 0.0 for x in sums])


def discounts(statistics: np.ndarray) -> np.ndarray:
    """d(r) for r from 0 (unused) to TOP, and the amount larger counts give up."""
    n = np.r_[0.0, statistics[2:]]
    with np.errstate(all="ignore"):
        tail = (TOP + 1) * n[TOP + 1] / n[1]
        r = np.arange(1, TOP + 1)
        katz = ((r + 1) * n[r + 1] / (n[r] * r) - tail) / (1 - tail)
    good = np.isfinite(katz) & (katz > 0) & (katz <= 1 - 1e-3 / r)
    return np.r_[1.0, np.where(good, katz, (r - 0.5) / r)]


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts after their discount."""
    small = d[np.minimum(counts, TOP).astype(np.int64)] * counts
    return np.where(counts > TOP, counts - 1e-3, small)


def _replies_by_block(replies: DataFrame, name: str) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("bucket", "sums", "owned")))
    return replies.filter("block >= 0").groupBy("block").agg(ordered.alias(name))


def _joined(parts: list[dict], rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Sums and ownership of all keys of a block, in the order of the keys."""
    sums = [unpack(p["sums"], np.float64).reshape(rows, -1) for p in parts]
    return list(np.concatenate(sums, axis=1)), np.concatenate([unpack(p["owned"], np.uint8) for p in parts])


def _pairs(tokens: np.ndarray, lengths: np.ndarray, words: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """History of every token, the end for the first of a text, and the key of each pair."""
    before = np.r_[end, tokens[:-1]]
    before[np.r_[0, np.cumsum(lengths)[:-1]]] = end
    return before, mixed(words[before] * np.uint64(0x9E3779B97F4A7C15) + words[tokens])


def score_texts(docs: DataFrame, block_bytes: int = 10_000_000, bucket_keys: int = 1_000_000) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from all rows outside the held-out fold (a null id is in none, so it is
    learnt from). A null or empty text is one token, its end. Repeated rows are
    scored and counted each. An empty table gives no rows. Columns other than
    doc_id and text are not read. A block holds whole texts, about `block_bytes` of
    them, and a bucket of the tables about `bucket_keys` keys a task sorts at once;
    both numbers of blocks and buckets grow with the input.
    """
    spark = docs.sparkSession
    early = [scratch_folder(spark) for _ in range(3)]
    blocks = text_blocks(docs, block_bytes, early[0])
    tokens = blocks.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    bits = max(0, int(np.ceil(np.log2(max(1, tokens / bucket_keys)))))

    def send_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, flat, _, train = _opened(row)
            count = np.bincount(flat[train], minlength=len(words)).astype(np.float64)
            order = np.argsort(words)
            yield _sent_batch(_send(row["block"], words[order], [count[order]], bits))

    def send_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, flat, end, train = _opened(row)
            keys, number = np.unique(_pairs(flat, np.array(row["lengths"]), words, end)[1], return_inverse=True)
            yield _sent_batch(_send(row["block"], keys, [np.bincount(number, train, len(keys))], bits))

    word_replies = exchange(blocks.mapInArrow(send_words, _SENT), _counts_of_counts, early[1])
    pair_replies = exchange(blocks.mapInArrow(send_pairs, _SENT), _counts_of_counts, early[2])
    of_words, of_pairs = _statistics(word_replies), _statistics(pair_replies)
    total, types = of_words[0], of_words[1]
    d1, d2 = discounts(of_words), discounts(of_pairs)
    small = of_words[2 : 2 + TOP]
    left = (small * np.arange(1, TOP + 1) * (1 - d1[1:])).sum() + 1e-3 * (types - small.sum())
    unknown = left / total if total else 1.0

    def word_chances(count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, discounted(count, d1) / max(total, 1), unknown)

    known = blocks.join(_replies_by_block(word_replies, "of_words"), "block").join(
        _replies_by_block(pair_replies, "of_pairs"), "block"
    )
    fields = ("n_tokens", "n_known", "base", "part")
    held_shape = "block long, doc_id array<long>, held array<boolean>, " + ", ".join(f"{f} array<double>" for f in fields)
    half_schema = pa.schema(
        [("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))]
        + [(f, pa.list_(pa.float64())) for f in fields]
        + [(f, pa.binary()) for f in ("words", "kept", "covered", "open_doc", "open_word")]
    )

    def score_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            words, flat, end, _ = _opened(row)
            order = np.argsort(words)
            count = np.empty(len(words))
            count[order] = _joined(row["of_words"], 1)[0][0]
            chance = word_chances(count)
            lengths = np.array(row["lengths"])
            before, key = _pairs(flat, lengths, words, end)
            keys, first, number = np.unique(key, return_index=True, return_inverse=True)
            (pair_count,), owned = _joined(row["of_pairs"], 1)
            mass = discounted(pair_count, d2) / np.maximum(count[before[first]], 1)
            mine = (owned > 0) & (pair_count > 0)
            kept = np.bincount(before[first[mine]], mass[mine], len(words))
            covered = np.bincount(before[first[mine]], chance[flat[first[mine]]], len(words))
            seen = pair_count[number] > 0
            value = np.log10(np.where(seen, mass[number], chance[flat]))
            owner = np.repeat(np.arange(len(lengths)), lengths)
            base = np.log10((count[flat] + 1) / (total + types + 1))
            per_doc = [
                np.bincount(owner, x, len(lengths)).tolist()
                for x in (np.ones(len(flat)), (count[flat] > 0).astype(float), base, value)
            ]
            # pairs never met wait for the weight of their history, which counts only if it was met itself
            wait = ~seen & (count[before] > 0)
            binary = [words[order], kept[order], covered[order], owner[wait].astype(np.int32)]
            place = np.empty(len(words), np.int32)
            place[order] = np.arange(len(words))
            lists = [[row["doc_id"]], [row["held"]], *([x] for x in per_doc)]
            packed = [[pack(x)] for x in (*binary, place[before[wait]])]
            yield record_batch(half_schema, [row["block"]], *lists, *packed)

    binaries = ", ".join(f"{f} binary" for f in ("words", "kept", "covered", "open_doc", "open_word"))
    half = durable(known.mapInArrow(score_known, f"{held_shape}, {binaries}"))
    discard(spark, *early)  # what is still needed of them is in `half`

    def send_mass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            sums = [unpack(row[f], np.float64) for f in ("kept", "covered")]
            yield _sent_batch(_send(row["block"], unpack(row["words"], np.uint64), sums, bits))

    masses = exchange(half.select("block", "words", "kept", "covered").mapInArrow(send_mass, _SENT))
    out_schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_())]
        + [(f, pa.int64()) for f in ("n_tokens", "n_known", "train_tokens")]
        + [(f, pa.float64()) for f in ("base_score", "score")]
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            (kept, covered), _ = _joined(row["of_mass"], 2)
            weight = np.log10(np.maximum(1 - kept, 1e-300) / np.maximum(1 - covered, 1e-300))
            owner, place = unpack(row["open_doc"], np.int32), unpack(row["open_word"], np.int32)
            size = len(row["doc_id"])
            score = np.array(row["part"]) + np.bincount(owner, weight[place], size)
            yield record_batch(
                out_schema,
                row["doc_id"],
                row["held"],
                [int(x) for x in row["n_tokens"]],
                [int(x) for x in row["n_known"]],
                [int(total)] * size,
                row["base"],
                score,
            )

    ready = half.select("block", "doc_id", "held", *fields, "open_doc", "open_word").join(
        _replies_by_block(masses, "of_mass"), "block"
    )
    return ready.mapInArrow(
        finish,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, int, np.ndarray]:
    """Word hashes, tokens, number of the end, and which tokens are learnt from."""
    words, flat = unpack(row["words"], np.uint64), unpack(row["tokens"], np.int32)
    end = int(flat[-1])
    return words, flat, end, np.repeat(~np.array(row["held"], bool), row["lengths"])

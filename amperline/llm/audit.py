"""How filters interact: what each removes, repeats and alone catches, in every order of application.

Whether a text is a repeat of an earlier document is found in radix tries. Texts are
dealt to ranges between adaptive prefixes, as long as it takes to tell ranges apart;
each range inserts its whole texts into a compressed trie whose terminals hold the
smallest doc_id, and a walk over the terminals flags all other rows. Before that the
rows of a task go through a trie of their own, so that a text of very many copies
sends one row a task. What is left of a document is a mask of the filters it fails;
masks are counted, and all orders are worked out from the counts.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import drawn_rows, record_batch, slices, small_batches
from amperline.session import durable

#: The filters in the order of the bits of a mask; the last one is the repeat of an earlier text.
FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")

_CAPITALS = bytes(range(65, 91))
_SYMBOLS = b"#$%&*|"


def failures(text: bytes, points: int) -> int:
    """Mask of the filters that a text of so many code points fails by itself (A to D)."""
    words = text.split()
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    mask = len(words) < 100
    mask |= (100 * len(set(words)) < 80 * len(words)) << 1
    mask |= (100 * capitals > 10 * points) << 2
    mask |= (len(text.translate(None, _SYMBOLS)) < len(text)) << 3
    return int(mask)


class Trie:
    """Compressed trie of whole byte strings; a terminal holds the smallest id that was put there."""

    def __init__(self) -> None:
        # a node is [label, children by first byte, terminal or -1]
        self.root: list = [b"", {}, -1]
        self.least: list[int] = []

    def put(self, text: bytes, doc_id: int) -> int:
        """Insert a text and return its terminal."""
        node, at = self.root, 0
        while at < len(text):
            child = node[1].get(text[at])
            if child is None:
                node[1][text[at]] = child = [text[at:], {}, -1]
            label = child[0]
            if not text.startswith(label, at):
                size = _common(label, text, at)
                upper = [label[:size], {label[size]: child}, -1]
                child[0] = label[size:]
                node[1][text[at]] = upper
                child, label = upper, upper[0]
            node, at = child, at + len(label)
        if node[2] < 0:
            node[2] = len(self.least)
            self.least.append(doc_id)
        elif doc_id < self.least[node[2]]:
            self.least[node[2]] = doc_id
        return node[2]


def _common(label: bytes, text: bytes, at: int) -> int:
    """Length of the common prefix of a label and the text from `at`, found by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


def adaptive_prefixes(texts: DataFrame, ranges: int, sample: int = 8192, window: int = 256) -> list[bytes]:
    """Up to about `ranges` prefixes that cut the texts into ranges of similar size; they set no result.

    Fitted on the first `window` bytes of at most `sample` texts. Where a beginning is
    shared by more different texts of the sample than a range should have, texts of
    that beginning are sampled again with a window four times as long (and a sample a
    fourth of the size, so that the bytes on the driver keep their bound), until the
    texts differ or end. A prefix is cut after the first byte in which it differs from
    the sampled text before it.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    key = F.xxhash64(raw)
    # drawn by row and not by text: copies of one text are a part of the sample, not all of it
    rows = texts.select(raw.alias("raw"), key.alias("key"), F.xxhash64(key, "doc_id").alias("draw"))
    total = texts.count()
    found: set[bytes] = set()
    open_heads: list[tuple[bytes, int, int]] = [(b"", ranges, total)]
    while open_heads and window <= 1 << 22:
        deeper: list[tuple[bytes, int, int]] = []
        for beginning, pieces, size in open_heads:
            part = rows.filter(F.substring("raw", 1, len(beginning)) == F.lit(beginning)) if beginning else rows
            drawn = drawn_rows(part, F.col("draw"), size, sample).select("key", F.substring("raw", 1, window)).collect()
            heads = sorted({key: bytes(head) for key, head in drawn}.values())
            fair = len(heads) / pieces
            last = 0
            counts = Counter(heads)
            for place in range(1, len(heads)):
                before, here = heads[place - 1], heads[place]
                if before != here and place - last >= fair:
                    found.add(here[: _common(before, here, 0) + 1])
                    last = place
            for head, count in counts.items():
                if count > 2 * fair and count > 8 and len(head) == window:
                    share = max(2, int(count / max(fair, 1)))
                    deeper.append((head, share, size * count // len(heads)))
        open_heads, window, sample = deeper, window * 4, max(32, sample // 4)
    return sorted(found)


def _judged(docs: DataFrame, bounds: list[bytes], held: int) -> DataFrame:
    """One row per document with its mask and the range of its text.

    Rows whose text an earlier row of the task has are marked at once and need no text;
    of rows that agree in everything one stays, with their number. The trie of a task
    is emptied when its texts reach `held` bytes.
    """
    fields = [
        ("range", pa.int32()),
        ("doc_id", pa.int64()),
        ("part", pa.string()),
        ("mask", pa.int32()),
        ("copies", pa.int64()),
        ("text", pa.binary()),
    ]
    schema = pa.schema(fields)

    def flushed(rows: Counter, texts: list[bytes], trie: Trie) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        for (terminal, doc_id, part, mask), copies in rows.items():
            first = doc_id is not None and trie.least[terminal] == doc_id
            if first:
                text = texts[terminal]
                out.append((bisect_right(bounds, text), doc_id, part, mask, copies, text))
                size += len(text)
            else:
                # a row without id has no smaller one; the others are spread, as no text decides on them
                marked = mask if doc_id is None else mask | REPEATED
                out.append((-1 - (doc_id or 0) % 1021, doc_id, part, marked, copies, None))
            if size > 2_000_000 or len(out) >= 5000:
                yield record_batch(schema, *zip(*out, strict=True))
                out, size = [], 0
        if out:
            yield record_batch(schema, *zip(*out, strict=True))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, trie, size = Counter(), [], Trie(), 0
        for batch in small_batches(batches, "text"):
            columns = [batch.column(n).to_pylist() for n in ("doc_id", "part", "text")]
            for doc_id, part, text in zip(*columns, strict=True):
                text = text or ""
                raw = text.encode("utf-8", "surrogatepass")
                mask = failures(raw, len(text))
                if doc_id is None:
                    rows[-1, None, part, mask] += 1
                    continue
                terminal = trie.put(raw, doc_id)
                if terminal == len(texts):
                    texts.append(raw)
                    size += len(raw)
                rows[terminal, doc_id, part, mask] += 1
            if size > held:
                yield from flushed(rows, texts, trie)
                rows, texts, trie, size = Counter(), [], Trie(), 0
        yield from flushed(rows, texts, trie)

    named = "range int, doc_id long, part string, mask int, copies long, text binary"
    return docs.mapInArrow(judged, named)


def _repeats(judged: DataFrame) -> DataFrame:
    """Masks with the bit of repeated texts, from a trie for each range of whole texts.

    Texts are read from the stream straight into the trie, so copies of a text take no memory.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("copies", pa.int64())])

    def tried(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), pieces in groupby(slices(batches, "range"), key=lambda x: x[0]):
            if number < 0:
                for _, piece in pieces:
                    yield record_batch(schema, *[piece.column(n) for n in schema.names])
                continue
            trie, ends, rows = Trie(), [], []
            for _, piece in pieces:
                ids = piece.column("doc_id").to_pylist()
                ends += map(trie.put, piece.column("text").to_pylist(), ids)
                # taken out of the batch, which holds the texts
                rows += zip(ids, *[piece.column(n).to_pylist() for n in ("part", "mask", "copies")], strict=True)
            ids, parts, masks, copies = zip(*rows, strict=True)
            later = np.array(ids) > np.array(trie.least)[ends]
            yield record_batch(schema, ids, parts, np.where(later, np.array(masks) | REPEATED, masks), copies)

    dealt = judged.repartition("range").sortWithinPartitions("range")
    return dealt.mapInArrow(tried, "doc_id long, part string, mask int, copies long")


def document_masks(docs: DataFrame, part: str = "lang", ranges: int | None = None, held: int = 48_000_000) -> DataFrame:
    """doc_id, part, mask and copies: which filters each document fails (bit 0 is A, bit 4 is E)."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col("text").cast("string").alias("text"),
    )
    shuffled = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = adaptive_prefixes(narrow, ranges or 8 * shuffled)
    return _repeats(_judged(narrow, bounds, held))


def interactions(counts: DataFrame) -> DataFrame:
    """What every filter does at every step of every order, from counts of masks.

    `counts` has part, mask, good, toxic and n. One row per part, order and step.
    """
    orders = [list(p) for p in permutations(FILTERS)]
    letters = F.array(*[F.lit("".join(o)) for o in orders])
    # the counts of a part are at most 4 times 32 rows, whatever the number of documents
    rows = counts.withColumn("filter_order", F.explode(letters)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )
    bits = {letter: 1 << at for at, letter in enumerate(FILTERS)}
    letter = F.substring("filter_order", F.col("step"), F.lit(1))

    def bit_of(name):
        return sum((F.when(name == k, F.lit(v)).otherwise(F.lit(0)) for k, v in bits.items()), F.lit(0))

    own = bit_of(letter)
    earlier = F.aggregate(
        F.sequence(F.lit(1), F.lit(len(FILTERS))),
        F.lit(0),
        lambda acc, at: acc + F.when(at < F.col("step"), bit_of(F.substring("filter_order", at, F.lit(1)))).otherwise(F.lit(0)),
    )
    marked = rows.select("part", "filter_order", "step", letter.alias("filter"), "mask", "good", "toxic", "n", own.alias("own"), earlier.alias("earlier"))
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("earlier")) != 0
    n = F.col("n")

    def total(condition, name):
        return F.sum(F.when(condition, n).otherwise(F.lit(0))).cast("long").alias(name)

    steps = marked.groupBy("part", "filter_order", "step", "filter").agg(
        total(~gone & ~fails, "kept"),
        total(~gone & fails, "removed"),
        total(gone & fails, "redundant"),
        total(F.col("mask") == F.col("own"), "unique_fails"),
        total(~gone & fails & F.col("good"), "good_lost"),
        total(~gone & fails & F.col("toxic"), "toxic_lost"),
    )
    shares = steps.groupBy("part", "filter").agg(F.sum("removed").cast("long").alias("shapley"))
    return steps.join(shares, ["part", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part (lang, null as empty), order of the five filters and step, zeros included.

    Null and empty texts are equal and of no words. Of rows of one text all fail E
    but those of the smallest doc_id; a row without doc_id has no smaller one and makes
    no other one fail. Repeated rows count each. A document is good or toxic if any row
    of `labels` with its id says so. An empty table gives no rows, further columns are
    not read.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, True).otherwise(False)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, True).otherwise(False)).alias("toxic"),
    )
    masks = document_masks(docs)
    flags = masks.join(known, "doc_id", "left").select(
        "part", "mask", "copies", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    counts = flags.groupBy("part", "mask", "good", "toxic").agg(F.sum("copies").cast("long").alias("n"))
    return interactions(durable(counts))

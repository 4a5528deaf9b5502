"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything between two of these is a word.
SPACES = " \t\n\x0b\x0c\r"

_MIX_A, _MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each with underscores added until it is no column, whatever the case."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo parts; an id that is null falls in no fold (null)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def text_key(text: Column) -> Column:
    """Key that is equal for equal texts only; null and empty text share one."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256))


def drawn_rows(rows: DataFrame, draw: Column, total: int, size: int) -> DataFrame:
    """At most `size` rows, those of the smallest hashes `draw`; `total` is about their number.

    Hashes far above are filtered first, so that all tasks together send about twice the
    sample, however many they are.
    """
    bound = min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, 2 * size / max(total, 1))))
    marked = rows.withColumn("_draw", draw).filter(F.col("_draw") <= F.lit(bound))
    return marked.orderBy("_draw").limit(size).drop("_draw")


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finisher of splitmix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= _MIX_A
    values ^= values >> np.uint64(27)
    values *= _MIX_B
    values ^= values >> np.uint64(31)
    return values


class WordHash(dict):
    """64-bit hashes of words, remembered up to a bound; the same on every machine."""

    def __init__(self, bound: int = 400_000) -> None:
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        from hashlib import blake2b

        value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        if len(self) >= self.bound:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        """Hashes of a list of words."""
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` words, in text order; a shorter text is one shingle, no words give none."""
    if not len(words):
        return words
    width = min(width, len(words))
    count = len(words) - width + 1
    out = np.full(count, width, np.uint64)
    for at in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[at : at + count])
    return out


def shingle_set(text: str | None, width: int, hashes: WordHash) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(hashes.of((text or "").encode("utf-8", "surrogatepass").split()), width))


def small_batches(batches: Iterator[pa.RecordBatch], column: str, most: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that the texts of one cut hold about `most` bytes; a longer single text stays whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch of the given columns, converted to the schema's types."""
    return pa.record_batch([pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
    """Pieces of batches of one group of integer keys, from rows that come sorted by these keys."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip(np.r_[0, cuts], np.r_[cuts, batch.num_rows], strict=True):
            yield tuple(values[:, a].tolist()), batch.slice(a, b - a)


def runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """Rows of one group of integer keys at a time, from rows that come sorted by these keys."""
    for group, pieces in groupby(slices(batches, *keys), key=lambda x: x[0]):
        yield group, pa.Table.from_batches([piece for _, piece in pieces])

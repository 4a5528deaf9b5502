"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by size: class j holds items of 2**j to 2**(j+1) - 1
shingles. For each class a document is cut into windows of three strides, a stride
being half the largest item of the class, so an item of the class that stands in a
document lies whole in one window of nearly its own size. A window and an item
are candidates if they agree in at least one of the MinHash values; with 32
values an item of containment 0.8 is missed once in ten thousand windows, a whole
item once in half a million. Every candidate is verified by exact containment
of the item's shingles in the whole document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import WordHash, mixed, shingle_hashes, shingle_set, small_batches, unused

_VALUES = 32
_SEEDS = mixed(np.arange(1, _VALUES + 1, dtype=np.uint64))


@dataclass(frozen=True)
class ItemClass:
    """The items of one size class, and their MinHash values in order."""

    stride: int
    values: np.ndarray  # sorted: value of (hash function, item)
    owners: np.ndarray  # item of each value
    telling: np.ndarray  # sorted: the shingles that give these values


def _agreed(seed: np.uint64, shingles: np.ndarray) -> np.ndarray:
    return mixed(shingles ^ seed)


def item_classes(sets: list[np.ndarray]) -> list[ItemClass]:
    """Partition items by size and sign them."""
    by_size: dict[int, list[int]] = {}
    for item, shingles in enumerate(sets):
        if len(shingles):
            by_size.setdefault(len(shingles).bit_length(), []).append(item)
    classes = []
    for bits, items in sorted(by_size.items()):
        values, owners, telling = [], [], []
        for item in items:
            for seed in _SEEDS:
                hashed = _agreed(seed, sets[item])
                at = int(hashed.argmin())
                values.append(hashed[at])
                owners.append(item)
                telling.append(sets[item][at])
        order = np.argsort(np.array(values, np.uint64), kind="stable")
        classes.append(
            ItemClass(
                max(1, 1 << (bits - 1)),
                np.array(values, np.uint64)[order],
                np.array(owners, np.int64)[order],
                np.unique(np.array(telling, np.uint64)),
            )
        )
    return classes


def short_items(sets: list[np.ndarray], lengths: list[int], width: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each length in words below `width`: the one shingle of every item of that length, and the items."""
    found = []
    for length in range(1, width):
        owners = np.array([i for i, n in enumerate(lengths) if n == length], np.int64)
        if len(owners):
            found.append((length, np.array([sets[i][0] for i in owners], np.uint64), owners))
    return found


def candidates(shingles: np.ndarray, group: ItemClass) -> np.ndarray:
    """Items of one class that agree with a window of the document in a MinHash value.

    A window can agree only if it holds one of the shingles that gave an item its
    value, so windows without one are passed over.
    """
    place = np.minimum(np.searchsorted(group.telling, shingles), len(group.telling) - 1)
    hits = np.flatnonzero(group.telling[place] == shingles)
    if not len(hits):
        return hits
    # strides within reach of a hit; a window is a stride and the two after it
    strides = np.unique((hits // group.stride)[:, None] + np.arange(-2, 3))
    strides = strides[(strides >= 0) & (strides * group.stride < len(shingles))]
    within = strides[:, None] * group.stride + np.arange(group.stride)
    filled = within < len(shingles)
    picked = shingles[np.minimum(within, len(shingles) - 1)]
    follows = np.r_[np.diff(strides) == 1, False]
    top = np.uint64(2**64 - 1)
    found = []
    for seed in _SEEDS:
        low = np.where(filled, _agreed(seed, picked), top).min(axis=1)
        second = np.where(follows, np.r_[low[1:], top], top)
        third = np.where(follows & np.r_[follows[1:], False], np.r_[low[2:], top, top][: len(low)], top)
        found.append(np.minimum(np.minimum(low, second), third))
    windows = np.unique(np.concatenate(found))
    start = np.searchsorted(group.values, windows, "left")
    stop = np.searchsorted(group.values, windows, "right")
    ranges = [group.owners[a:b] for a, b in zip(start[stop > start], stop[stop > start], strict=True)]
    return np.unique(np.concatenate(ranges)) if ranges else np.zeros(0, np.int64)


def _item_blocks(items: DataFrame, words: int) -> Iterator[list[tuple[object, str]]]:
    """The query set in blocks of about `words` words; equal rows once."""
    named = items.select(F.col("item_id").alias("item_id"), F.col("text").cast("string").alias("text")).filter(
        F.col("text").isNotNull()
    )
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, ceil(total / (6 * words)))
    for block in range(blocks):
        mine = named.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block)
        rows = mine.distinct().orderBy("item_id", "text").collect()
        if rows:
            yield [(r.item_id, r.text) for r in rows]


def find_items(
    docs: DataFrame,
    items: DataFrame,
    width: int = 5,
    least: float = 0.8,
    words: int = 500_000,
    into: str = "_hits",
) -> DataFrame:
    """All columns of `docs` and `into`, the items contained in each whole text.

    A column of `docs` of that name is replaced. `into` is an array of (item_id, containment): every item of which at least `least`
    of the distinct shingles occur in the document. The items are a stated query
    set; they go over all documents in blocks of about `words` words, which bounds
    what the driver and each task hold, and further blocks add to the array. Items
    without words are in no document; an item of fewer words than a shingle is
    sought as a run of its own length. Repeated documents are searched each, repeated items are one
    item for each id. A null or empty text and empty tables give empty arrays.
    """
    docs = docs.drop(into)
    fields = docs.schema
    names = [f"_c{i}" for i in range(len(fields))]
    text = names[[f.name for f in fields].index("text")]
    typed = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, fields, strict=True))
    id_type = items.schema["item_id"].dataType
    hit_type = f"array<struct<item_id: {id_type.simpleString()}, containment: double>>"
    out = docs.toDF(*names).withColumn("_hits", F.array().cast(hit_type))
    for block in _item_blocks(items, words):
        out = _search(out, block, text, f"{typed}, _hits {hit_type}", width, least)
    return out.toDF(*fields.names, into)


def _search(docs: DataFrame, block: list[tuple], text: str, schema: str, width: int, least: float) -> DataFrame:
    """Add the hits of one block of items."""
    hashes = WordHash()
    sets = [shingle_set(t, width, hashes) for _, t in block]
    ids = [i for i, _ in block]
    none = np.zeros(0, np.uint64)
    short = short_items(sets, [len(t.encode("utf-8", "surrogatepass").split()) for _, t in block], width)
    brief = {item for _, _, owners in short for item in owners.tolist()}
    classes = item_classes([none if i in brief else x for i, x in enumerate(sets)])

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHash()
        for batch in small_batches(batches, text):
            hits = []
            for value in batch.column(text).to_pylist():
                words = known.of((value or "").encode("utf-8", "surrogatepass").split())
                shingles = shingle_hashes(words, width)
                found = [candidates(shingles, c) for c in classes] if len(shingles) else []
                here = []
                if any(map(len, found)):
                    own = np.unique(shingles)
                    for item in np.unique(np.concatenate(found)).tolist():
                        share = float(np.isin(sets[item], own, assume_unique=True).mean())
                        if share >= least:
                            here.append({"item_id": ids[item], "containment": share})
                for length, values, owners in short:
                    whole = owners[np.isin(values, shingle_hashes(words, length))]
                    here += [{"item_id": ids[item], "containment": 1.0} for item in whole.tolist()]
                hits.append(here)
            at = batch.schema.get_field_index("_hits")
            before = batch.column(at).to_pylist()
            merged = pa.array([a + b for a, b in zip(before, hits, strict=True)], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), merged)

    return docs.mapInArrow(searched, schema)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and contained item: doc_id, item_id and the containment, at least 0.8."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hits = find_items(narrow, items).select("doc_id", F.explode("_hits").alias("_hit"))
    return hits.select("doc_id", "_hit.item_id", F.round("_hit.containment", 9).alias("containment"))


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs`, all columns whatever their names, that contain no item."""
    (mark,) = unused(docs.columns, "_hits")
    return find_items(docs, items, into=mark).filter(F.size(mark) == 0).drop(mark)

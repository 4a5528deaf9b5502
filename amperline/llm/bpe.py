"""Token counts of a byte-pair tokenizer by rank-synchronous merging of ragged arrays.

The distinct pre-tokens of a batch of texts lie in one flat array of symbols.
In every round each pre-token finds the lowest rank among its neighbouring
pairs, and all its pairs of that rank are merged at once, the left one first
where two overlap. Pre-tokens without a known pair leave the array; what is left
of each are its tokens. A merge never makes a pair of lower rank than its own,
so the rounds give the same symbols as merging one pair at a time.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import record_batch, small_batches

_NO_RANK = np.int64(1 << 40)


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    own = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


class PairMerger:
    """Counts tokens of pre-tokens with the merges of one vocabulary file."""

    def __init__(self, path: str, remembered: int = 400_000) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        ids, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        letters = _byte_letters()
        self.inner = np.array([ids[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([ids[letters[b] + suffix] for b in range(256)], np.int64)
        self.width = np.int64(max(ids.values()) + 1)
        pairs = [(ids[a], ids[b], ids[a + b]) for a, b in model["merges"]]
        table = np.array(pairs, np.int64)
        codes = table[:, 0] * self.width + table[:, 1]
        order = np.argsort(codes, kind="stable")
        self.codes, self.ranks, self.made = codes[order], order.astype(np.int64), table[order, 2]
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.marks = regex.compile("|".join(map(regex.escape, self.special)))
        self.known: dict[str, int] = {}
        self.remembered = remembered

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text and the number of special strings in it, which count as one token each."""
        pieces, marks = [text], 0
        if "<|" in text:
            pieces = self.marks.split(text)
            marks = len(pieces) - 1
        found: list[str] = []
        for piece in pieces:
            # lower case is taken letter by letter, without the rule for a final sigma
            piece = unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()
            found += self.pattern.findall(piece)
        return found, marks

    def merge(self, words: list[str]) -> np.ndarray:
        """Number of symbols that survive in each of some distinct pre-tokens."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        symbols, owner = self.inner[flat], np.repeat(np.arange(len(raw)), sizes)
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[flat[ends]]
        counts = sizes.copy()
        while len(symbols) > 1:
            code = symbols[:-1] * self.width + symbols[1:]
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            rank = np.where((self.codes[at] == code) & (owner[:-1] == owner[1:]), self.ranks[at], _NO_RANK)
            lowest = np.full(len(raw), _NO_RANK)
            starts = np.flatnonzero(np.r_[True, owner[1:-1] != owner[:-2]]) if len(owner) > 2 else np.array([0])
            lowest[owner[starts]] = np.minimum.reduceat(rank, starts)
            active = lowest[owner] < _NO_RANK
            if not active.any():
                break
            chosen = (rank == lowest[owner[:-1]]) & (rank < _NO_RANK)
            # of a run of overlapping pairs every second one counts, from the left
            where = np.flatnonzero(chosen)
            run = np.r_[0, np.flatnonzero(np.diff(where) != 1) + 1]
            length = np.diff(np.r_[run, len(where)])
            inside = np.arange(len(where)) - np.repeat(run, length)
            left = where[inside % 2 == 0]
            symbols[left] = self.made[at[left]]
            np.subtract.at(counts, owner[left], 1)
            stays = active
            stays[left + 1] = False
            symbols, owner = symbols[stays], owner[stays]
        return counts

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; a null text has none. New pre-tokens of all texts are merged together."""
        parts = [[self.pre_tokens(p) for p in _parts(text or "")] for text in texts]
        seen = set().union(*(words for text in parts for words, _ in text))
        fresh = seen.difference(self.known)
        if fresh:
            if len(self.known) + len(fresh) > self.remembered:
                self.known.clear()
                fresh = seen
            self.known.update(zip(fresh, self.merge(list(fresh)).tolist(), strict=True))
        count = self.known.__getitem__
        return [sum(marks + sum(map(count, words)) for words, marks in text) for text in parts]


def _parts(text: str, most: int = 1_000_000) -> Iterator[str]:
    """Cut a very long text at spaces, where no pre-token crosses."""
    start = 0
    while len(text) - start > most:
        cut = text.find(" ", start + most)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 2048) -> DataFrame:
    """Tokens of every whole text.

    Returns doc_id, n_bytes (UTF-8), n_tokens and over_limit (more than `limit`
    tokens), a row per row of the input, repeated rows included. A null or empty
    text has no bytes and no tokens; a null id stays null; other columns are not
    read. `vocabulary` is a file every executor can open. The work is one map
    over the scan: no shuffle, and a lost executor only repeats its tasks.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = PairMerger(vocabulary)
        for batch in small_batches(batches, "text"):
            texts = batch.column("text").to_pylist()
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
            yield record_batch(schema, batch.column("doc_id"), sizes.cast(pa.int64()), merger.count(texts))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )

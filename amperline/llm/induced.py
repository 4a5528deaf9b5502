"""Suffix sorting by induction, with common-prefix values, in whole-array steps.

Suffixes that are smaller than the next one are of type S, the others of type L; an
S after an L is a star. The order of all suffixes follows from that of the stars:
the suffixes stand in queues by first byte, queues are taken in order of the byte,
and everything in one sends the suffix one place to its left into the queue of that
suffix's byte, larger ones first from the left (type L), then from the right (S).
Because a queue only feeds itself along a run of one byte, it is taken in a few
rounds, each an array operation, instead of one suffix at a time. A suffix carries
the length of the prefix it shares with the one before it in the queue: one more
than the least such value between the two suffixes that sent them.

The queues are kept in a file beyond a number of suffixes, so what a task holds of
a text is the text, some bytes of marks for each of its places, and one queue.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise
from tempfile import TemporaryFile

import numpy as np

#: Values of common prefixes are cut here; longer ones are not told apart.
CAP = 400
#: Suffixes of all queues that are held in memory, about ten bytes each.
MOST = 4_000_000


def _types(text: np.ndarray) -> np.ndarray:
    """True for type S. The text ends in a byte smaller than all others."""
    size = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    after = np.searchsorted(change, np.arange(size - 1))
    last = np.minimum(after, len(change) - 1)
    smaller = text[change[last]] < text[change[last] + 1]
    return np.r_[smaller & (after < len(change)), True]


def _run_lengths(text: np.ndarray) -> np.ndarray:
    """How often the byte at each place is repeated from there on."""
    ends = np.r_[np.flatnonzero(text[1:] != text[:-1]), len(text) - 1]
    return ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text)) + 1


class _LeastSince:
    """For each queue the least common prefix since something was last sent to it."""

    def __init__(self, queues: int) -> None:
        self.since = np.full(queues, -1, np.int16)

    def send(self, target: np.ndarray, place: np.ndarray, shared: np.ndarray) -> np.ndarray:
        """Common prefixes of what the entries at `place` of a batch send, sorted by target.

        `shared` has the batch's own values, each with the entry before it.
        """
        size = len(shared)
        levels = [shared]
        step = 1
        while 2 * step <= size:
            before = levels[-1]
            levels.append(np.minimum(before[: len(before) - step], before[step:]))
            step *= 2
        flat_size = np.array([len(x) for x in levels])
        flat = np.concatenate(levels)
        offset = np.cumsum(flat_size) - flat_size

        def least(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            """Least value from low to high, both included; low <= high."""
            level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
            width = np.left_shift(1, level)
            return np.minimum(flat[offset[level] + low], flat[offset[level] + high - width + 1])

        out = np.empty(len(place), np.int16)
        first = np.diff(target, prepend=-1) != 0
        follows = np.flatnonzero(~first)
        out[follows] = least(place[follows - 1] + 1, place[follows])
        leading = place[first]
        old = self.since[target[first]]
        out[first] = np.where(old < 0, -1, np.minimum(old, least(np.zeros_like(leading), leading)))
        # what is left of the batch after the last one sent to each queue
        known = self.since >= 0
        self.since[known] = np.minimum(self.since[known], shared.min() if size else CAP)
        if len(target):
            last = np.diff(target, append=-1) != 0
            tail, queue = place[last], target[last]
            rest = np.full(len(tail), CAP, np.int16)
            inner = tail < size - 1
            rest[inner] = least(tail[inner] + 1, np.full(int(inner.sum()), size - 1))
            self.since[queue] = rest
        return np.where(out < 0, 0, np.minimum(out + 1, CAP)).astype(np.int16)


class _Queues:
    """A queue of suffixes for each first byte: places, and the prefix each shares with the one before it.

    Queues are taken in order of the byte, suffixes in order of arrival. If more than
    `most` suffixes are in memory, all go to the end of a file without a name, and
    come back queue by queue.
    """

    def __init__(self, count: int, most: int) -> None:
        self.parts: list[list] = [[] for _ in range(count)]
        self.taken = [0] * count
        self.most, self.held, self.file = most, 0, None

    def put(self, queue: int, places: np.ndarray, shared: np.ndarray | None) -> None:
        self.parts[queue].append((places, shared))
        self.held += len(places)
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = TemporaryFile(prefix="queues-")
        self.file.seek(0, 2)
        for parts in self.parts:
            for at, part in enumerate(parts):
                if not isinstance(part[0], int):
                    places, shared = part
                    parts[at] = (self.file.tell(), len(places), shared is not None)
                    self.file.write(places.tobytes())
                    self.file.write(shared.tobytes() if shared is not None else b"")
        self.held = 0

    def _loaded(self, part: tuple) -> tuple[np.ndarray, np.ndarray | None]:
        if not isinstance(part[0], int):
            return part
        at, size, valued = part
        self.file.seek(at)
        places = np.frombuffer(self.file.read(8 * size), np.int64)
        return places, np.frombuffer(self.file.read(2 * size), np.int16) if valued else None

    def _joined(self, parts: list) -> tuple[np.ndarray, np.ndarray | None]:
        loaded = [self._loaded(p) for p in parts]
        if not loaded:
            return np.zeros(0, np.int64), np.zeros(0, np.int16)
        valued = loaded[0][1] is not None
        return np.concatenate([x for x, _ in loaded]), np.concatenate([v for _, v in loaded]) if valued else None

    def take(self, queue: int) -> tuple[np.ndarray, np.ndarray | None]:
        """What has come to a queue since it was last taken."""
        parts = self.parts[queue][self.taken[queue] :]
        self.taken[queue] += len(parts)
        return self._joined(parts)

    def whole(self, queue: int) -> tuple[np.ndarray, np.ndarray | None]:
        """All that came to a queue, which is given up."""
        parts, self.parts[queue] = self.parts[queue], []
        self.held -= sum(len(p[0]) for p in parts if not isinstance(p[0], int))
        return self._joined(parts)


def _induce(
    text: np.ndarray, small: np.ndarray, runs: np.ndarray, stars: np.ndarray, shared: np.ndarray | None, most: int
) -> Iterator[tuple[np.ndarray, np.ndarray | None]]:
    """Suffixes in order, by first byte from the last byte to the first, from sorted stars.

    With `shared` of the stars, each suffix comes with the prefix it shares with the one before.
    """
    count = int(text.max()) + 1
    by_byte = np.searchsorted(text[stars], np.arange(count + 1))
    large, waiting = _Queues(count, most), _Queues(count, most)

    def scan(batch, values, wanted, since, queues) -> None:
        sender = np.flatnonzero((batch > 0) & (small[batch - 1] == wanted))
        if values is None and not len(sender):
            return
        target = text[batch[sender] - 1]
        order = np.argsort(target, kind="stable")
        sender, target = sender[order], target[order].astype(np.int16)
        sent = batch[sender] - 1
        if values is not None:
            values = since.send(target, sender, values)
        cuts = np.flatnonzero(np.diff(target, prepend=-1, append=-1)).tolist() if len(target) else []
        for a, b in pairwise(cuts):
            queues.put(int(target[a]), sent[a:b], None if values is None else values[a:b])

    def drain(byte, wanted, since, queues) -> int | None:
        """Scan a queue and what it sends to itself; the last place in it."""
        last = None
        while True:
            batch, values = queues.take(byte)
            if not len(batch):
                return last
            last = int(batch[-1])
            scan(batch, values, wanted, since, queues)

    since = _LeastSince(count)
    for byte in range(count):
        last = drain(byte, False, since, large)
        mine = slice(by_byte[byte], by_byte[byte + 1])
        batch = stars[mine]
        if len(batch):
            values = None
            if shared is not None:
                values = shared[mine].copy()
                values[0] = 0 if last is None else min(runs[last], runs[batch[0]])
            scan(batch, values, False, since, large)
    since = _LeastSince(count)
    for byte in range(count - 1, -1, -1):
        drain(byte, True, since, waiting)
        down, down_shared = waiting.whole(byte)
        up, up_shared = large.whole(byte)
        if byte == 0 and not len(down):
            down, down_shared = stars[:1], np.zeros(1, np.int16)  # the end of the text
        if shared is None:
            scan(up[::-1], None, True, since, waiting)
            yield np.r_[up, down[::-1]], None
            continue
        seam = np.int16(min(runs[up[-1]], runs[down[-1]]) if len(up) and len(down) else 0)
        if len(up):
            scan(up[::-1], np.r_[seam, up_shared[1:][::-1]], True, since, waiting)
        ends = np.r_[down_shared[1:], seam][::-1] if len(down) else down_shared
        yield np.r_[up, down[::-1]], np.r_[up_shared, ends]


def _same_pieces(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the pieces of equal size at a and b are equal."""
    same = np.ones(len(a), bool)
    live = np.arange(len(a))
    step = 0
    while len(live):
        live = live[size[live] > step]
        equal = text[a[live] + step] == text[b[live] + step]
        same[live[~equal]] = False
        live = live[equal]
        step += 1
    return same


def _shared_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix at each a and b, up to CAP; compared eight bytes at a time."""
    padded = np.r_[text, np.zeros(CAP + 16, np.uint8)]
    words = np.lib.stride_tricks.sliding_window_view(padded, 8).view(np.uint64)[:, 0]
    out = np.full(len(a), CAP, np.int64)
    live, step = np.arange(len(a)), 0
    while step < CAP and len(live):
        differ = words[a[live] + step] ^ words[b[live] + step]
        stop = differ != 0
        first = differ[stop]
        low = first & (~first + np.uint64(1))
        out[live[stop]] = step + (np.frexp(low.astype(np.float64))[1] - 1) // 8
        live = live[~stop]
        step += 8
    return np.minimum(out, CAP)


def _sort_names(names: np.ndarray) -> np.ndarray:
    """Order of the suffixes of the string of names: the smaller problem, by doubling as its alphabet is large."""
    rank = names.astype(np.int64)
    step = 1
    while True:
        second = np.r_[rank[step:] + 1, np.zeros(min(step, len(rank)), np.int64)][: len(rank)]
        key = rank * (len(rank) + 2) + second
        order = np.argsort(key, kind="stable")
        fresh = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(len(key), np.int64)
        rank[order] = fresh
        if fresh[-1] == len(rank) - 1:
            return order
        step *= 2


def suffix_queues(text: np.ndarray, most: int = MOST) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes in order, by first byte from the last byte to the first, with shared prefixes cut at CAP.

    `text` is an array of bytes whose last one is 0 and smaller than all others. The
    prefix of an entry is shared with the entry before; that of the first of a byte is 0.
    """
    size = len(text)
    if size == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int16)
        return
    small = _types(text)
    runs = np.minimum(_run_lengths(text), CAP).astype(np.int16)
    stars = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(stars) > 1:
        # sort the pieces from star to star by one induction, name them, and sort the string of names
        begin = stars[np.argsort(text[stars], kind="stable")]
        is_star = np.zeros(size, bool)
        is_star[stars] = True
        found = [part[is_star[part]] for part, _ in _induce(text, small, runs, begin, None, most)]
        pieces = np.concatenate(found[::-1])
        reach = np.zeros(size, np.int64)
        reach[stars] = np.r_[stars[1:], size - 1] - stars + 1
        length = reach[pieces]
        equal = length[1:] == length[:-1]
        at = np.flatnonzero(equal)
        equal[at] = _same_pieces(text, pieces[at], pieces[at + 1], length[at])
        name = np.empty(size, np.int64)
        name[pieces] = np.r_[0, np.cumsum(~equal)]
        stars = stars[_sort_names(name[stars])] if equal.any() else pieces
    shared = np.r_[0, _shared_prefix(text, stars[:-1], stars[1:])].astype(np.int16)
    yield from _induce(text, small, runs, stars, shared, most)


def sorted_suffixes(text: np.ndarray, most: int = MOST) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and, for each entry, the prefix shared with the entry before, cut at CAP."""
    order, shared = zip(*suffix_queues(text, most), strict=True)
    return np.concatenate(order[::-1]), np.concatenate(shared[::-1])

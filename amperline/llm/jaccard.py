"""Near-duplicate join on word shingles by fixed MinHash bands with exact verification.

Each distinct text gets a signature of MinHash values, cut into bands (trees). Texts
that share the prefix of a band are candidates; its length is fixed beforehand so
that the chance that a pair of the threshold's similarity shares none is below the
target. Each candidate pair is verified once, in
the first tree where it meets, by the exact Jaccard similarity of its shingle sets.

Pairs are never rows: a task holds the members of a bucket, or of two of its blocks
where a bucket is large, and gives out one row per member with the number of links
it found and the member it hangs together with.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from amperline.llm.common import WordHash, mixed, record_batch, shingle_set, small_batches, text_key, unused
from amperline.session import durable

TREES, DEPTH = 20, 4
_TIMES = mixed(np.arange(1, TREES * DEPTH + 1, dtype=np.uint64)) | np.uint64(1)
_PLUS = mixed(np.arange(1001, TREES * DEPTH + 1001, dtype=np.uint64))


def prefix_length(least: float, recall: float) -> int:
    """The longest prefix at which a pair of similarity `least` meets in some tree with chance `recall`."""
    for length in range(DEPTH, 1, -1):
        if 1 - (1 - least**length) ** TREES >= recall:
            return length
    return 1


def signature(shingles: np.ndarray) -> np.ndarray:
    """MinHash values of a shingle set, 32 bits each."""
    low = np.full(len(_TIMES), np.uint64(2**64 - 1))
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048]
        low = np.minimum(low, (part[None, :] * _TIMES[:, None] + _PLUS[:, None]).min(axis=1))
    return (low >> np.uint64(32)).astype(np.uint32)


def bucket_keys(signatures: np.ndarray, length: int) -> np.ndarray:
    """Key of the prefix of each tree, for each row of signatures."""
    paths = signatures.reshape(len(signatures), TREES, DEPTH)
    keys = np.broadcast_to(mixed(np.arange(TREES, dtype=np.uint64) + np.uint64(77)), (len(paths), TREES)).copy()
    for step in range(length):
        keys = mixed(keys * np.uint64(31) + paths[:, :, step].astype(np.uint64))
    return keys.view(np.int64)


def signed_texts(docs: DataFrame, width: int) -> DataFrame:
    """One row per distinct text: key, smallest doc_id, copies, number of shingles and signature; stored."""
    schema = pa.schema([("key", pa.binary()), ("doc_id", pa.int64()), ("shingles", pa.int64()), ("signature", pa.binary())])

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in small_batches(batches, "text"):
            sets = [shingle_set(t, width, hashes) for t in batch.column("text").to_pylist()]
            yield record_batch(
                schema,
                batch.column("key"),
                batch.column("doc_id"),
                [len(s) for s in sets],
                [signature(s).tobytes() if len(s) else None for s in sets],
            )

    rows = docs.select("key", "doc_id", "text").mapInArrow(
        signed, "key binary, doc_id long, shingles long, signature binary"
    )
    return durable(
        rows.groupBy("key").agg(
            F.min("doc_id").alias("doc_id"),
            F.count("*").alias("copies"),
            F.first("shingles").alias("shingles"),
            F.first("signature").alias("signature"),
        )
    )


def shared_buckets(texts: DataFrame, length: int, block: int) -> DataFrame:
    """Members of every bucket of two texts or more, dealt into groups of one or two blocks of the bucket."""
    schema = pa.schema([("bucket", pa.int64()), ("key", pa.binary())])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("signature").to_pylist())
            keys = bucket_keys(np.frombuffer(raw, np.uint32).reshape(-1, TREES * DEPTH), length)
            owners = batch.column("key").take(pa.array(np.repeat(np.arange(batch.num_rows), TREES)))
            yield record_batch(schema, keys.ravel(), owners)

    rows = texts.filter("signature is not null").select("key", "signature").mapInArrow(spread, "bucket long, key binary")
    rows = durable(rows)
    full = rows.groupBy("bucket").agg(F.count("*").alias("members")).filter("members > 1")
    parts = F.ceil(F.col("members") / F.lit(block)).cast("int")
    mine = F.pmod(F.xxhash64("key", F.lit(5)), F.col("parts")).cast("int")
    members = rows.join(full.select("bucket", parts.alias("parts")), "bucket").withColumn("part", mine)
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    return pairs.select(
        F.when(F.col("parts") == 1, F.col("bucket")).otherwise(F.xxhash64("bucket", low, high)).alias("gid"),
        "bucket",
        F.when(low == high, F.lit(-1)).otherwise(F.col("part")).alias("part"),
        "key",
    )


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one gid at a time, from rows sorted by gid."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        gid = batch.column("gid").to_numpy()
        cuts = np.r_[0, np.flatnonzero(np.diff(gid)) + 1, len(gid)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0].column("gid")[0].as_py() != int(gid[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _by_group(rows: DataFrame) -> DataFrame:
    return rows.repartition("gid").sortWithinPartitions("gid", "key")


def likely_pairs(groups: DataFrame, texts: DataFrame, length: int, least: float) -> DataFrame:
    """Members that have a pair to verify in their group, with their partners.

    A pair belongs to the first tree where it shares a prefix, and is passed over if
    its signatures agree in so few values that it is not near `least` (more than
    five standard deviations away). Partners are numbers of members of the group,
    in the order of their keys, among those returned.
    """
    schema = pa.schema([("gid", pa.int64()), ("key", pa.binary()), ("partners", pa.binary())])
    floor = (least - 0.25) * TREES * DEPTH

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: tuple[list, list, list] = ([], [], [])
        for group in _runs(batches):
            size = group.num_rows
            raw = b"".join(group.column("signature").to_pylist())
            signatures = np.frombuffer(raw, np.uint32).reshape(size, -1)
            keys = bucket_keys(signatures, length)
            tree = int(np.flatnonzero(keys[0] == group.column("bucket")[0].as_py())[0])
            part = group.column("part").to_numpy()
            found = []
            for row in range(size - 1):
                rest = slice(row + 1, size)
                good = (part[row] < 0) | (part[rest] != part[row])
                if tree:
                    good &= ~(keys[rest, :tree] == keys[row, :tree]).any(axis=1)
                at = np.flatnonzero(good)
                at = at[(signatures[row + 1 + at] == signatures[row]).sum(axis=1) >= floor]
                found.append(at + row + 1)
            found.append(np.zeros(0, np.int64))
            used = np.zeros(size, bool)
            for row, partners in enumerate(found):
                if len(partners):
                    used[row] = used[partners] = True
            if used.any():
                number = np.cumsum(used) - 1
                names = group.column("key").to_pylist()
                for row in np.flatnonzero(used):
                    out[0].append(group.column("gid")[0].as_py())
                    out[1].append(names[row])
                    out[2].append(number[found[row]].astype(np.int32).tobytes())
            if len(out[0]) >= 5000:
                yield record_batch(schema, *out)
                out = ([], [], [])
        yield record_batch(schema, *out)

    with_signatures = groups.join(texts.select("key", "signature"), "key").select("gid", "bucket", "part", "key", "signature")
    return _by_group(with_signatures).mapInArrow(paired, "gid long, key binary, partners binary")


def _verified(sets: list[np.ndarray], partners: list[np.ndarray], least: float) -> list[np.ndarray]:
    """Of each member's partners those of exact similarity `least` or more."""
    sizes = np.array([len(s) for s in sets])
    total = sum(map(len, partners))
    if total < 200:
        out = []
        for row, others in enumerate(partners):
            common = np.array([len(np.intersect1d(sets[row], sets[o], assume_unique=True)) for o in others], float)
            out.append(others[common >= least * (sizes[row] + sizes[others] - common) - 1e-9] if len(others) else others)
        return out
    # many pairs share most shingles: those in all sets, or in one, need no column
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    names, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    everywhere = int((count == len(sets)).sum())
    telling = (count > 1) & (count < len(sets))
    place = np.cumsum(telling) - 1
    keep = telling[column]
    owner, column = owner[keep], place[column[keep]]
    common = [np.zeros(len(o)) for o in partners]
    for start in range(0, int(telling.sum()), 4096):
        mine = (column >= start) & (column < start + 4096)
        matrix = np.zeros((len(sets), 4096), np.float32)
        matrix[owner[mine], column[mine] - start] = 1
        for low in range(0, len(sets), 256):
            product = matrix[low : low + 256] @ matrix.T
            for row in range(low, min(low + 256, len(sets))):
                if len(partners[row]):
                    common[row] += product[row - low, partners[row]]
    out = []
    for row, others in enumerate(partners):
        both = common[row] + everywhere
        out.append(others[both >= least * (sizes[row] + sizes[others] - both) - 1e-9])
    return out


def _together(links: list[np.ndarray]) -> np.ndarray:
    """Smallest member each member hangs together with."""
    root = np.arange(len(links))

    def find(at: int) -> int:
        while root[at] != at:
            root[at] = root[root[at]]
            at = root[at]
        return at

    for row, others in enumerate(links):
        for top in {find(int(o)) for o in np.unique(root[others])} if len(others) else ():
            a, b = find(row), top
            root[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(len(links))])


def verified_links(docs: DataFrame, texts: DataFrame, pairs: DataFrame, width: int, least: float) -> DataFrame:
    """For each member of a group: its number of verified links there, and the member it hangs together with.

    Shingle sets are made from the texts of members only, once for each text.
    """
    shingled = pa.schema([("key", pa.binary()), ("sorted", pa.binary())])
    linked = pa.schema([("key", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHash()
        for batch in small_batches(batches, "text"):
            sets = [shingle_set(t, width, hashes).tobytes() for t in batch.column("text").to_pylist()]
            yield record_batch(shingled, batch.column("key"), sets)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _runs(batches):
            names = group.column("key").to_pylist()
            sets = [np.frombuffer(x, np.uint64) for x in group.column("sorted").to_pylist()]
            links = _verified(sets, [np.frombuffer(x, np.int32) for x in group.column("partners").to_pylist()], least)
            count = np.array([len(x) for x in links])
            for others in links:
                np.add.at(count, others, 1)
            root = _together(links)
            has = np.flatnonzero(count)
            yield record_batch(linked, [names[i] for i in has], count[has], [names[root[i]] for i in has])

    # of equal texts the row of the smallest id is read; rows repeated as a whole give equal sets
    needed = pairs.select("key").distinct().join(texts.select("key", F.col("doc_id").alias("reader")), "key")
    readers = docs.join(needed, "key").filter(F.col("doc_id").eqNullSafe(F.col("reader")))
    sets = readers.select("key", "text").mapInArrow(shingles, "key binary, sorted binary").dropDuplicates(["key"])
    return _by_group(pairs.join(sets, "key")).mapInArrow(verify, "key binary, links long, root binary")


def components(edges: DataFrame) -> DataFrame:
    """Smallest key of the connected component of every key that has an edge (key, root).

    Alternating stars: each key's larger neighbours, then its smaller ones, are hung
    on its smallest neighbour until nothing changes. Every round is stored.
    """

    def normal(frame: DataFrame) -> DataFrame:
        return frame.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def smallest(frame: DataFrame) -> DataFrame:
        return frame.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("low"))

    now = durable(normal(edges.select(F.col("key").alias("a"), F.col("root").alias("b"))))
    seen = state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(smallest(both), "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = durable(normal(large))
        small = large.join(smallest(large), "a")
        small = small.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            small.select("a", F.col("low").alias("b"))
        )
        now = durable(normal(small))
        if (after := state(now)) == seen:
            return now.select(F.col("a").alias("key"), F.col("b").alias("root"))
        seen = after


def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    least: float = 0.8,
    recall: float = 0.99999,
    block: int = 2048,
    into: tuple[str, str, str, str] = ("_class", "_class_id", "_links", "_copies"),
) -> DataFrame:
    """All columns of `docs`, and _class, _class_id, _links and _copies.

    `into` names these four otherwise; columns of `docs` of these names are replaced.

    Two texts are linked if the Jaccard similarity of their sets of word runs of
    `width` is `least` or more; a shorter text is one run. _links is the number of
    other texts a row's text is linked to, _copies the number of rows with its very
    text. _class_id is the smallest doc_id of the rows that hang together by links or
    equal texts, _class their common key. Texts without words are linked to none;
    equal ones, null and empty among them, share a class. Ids may be null or
    repeated: rows are told apart by text. An empty table stays empty.
    """
    docs = docs.drop(*into)
    fields = docs.columns
    names = [f"_c{i}" for i in range(len(fields))]
    plain = docs.toDF(*names)
    text = F.col(names[fields.index("text")]).cast("string")
    doc_id = F.col(names[fields.index("doc_id")]).cast("long")
    keyed = plain.select(text_key(text).alias("key"), doc_id.alias("doc_id"), text.alias("text"))
    texts = signed_texts(keyed, width)
    length = prefix_length(least, recall)
    pairs = durable(likely_pairs(shared_buckets(texts, length, block), texts, length, least))
    found = durable(verified_links(keyed, texts, pairs, width, least))
    counts = found.groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(found.select("key", "root"))
    nodes = texts.select("key", "doc_id", "copies").join(roots, "key", "left").join(counts, "key", "left")
    nodes = durable(nodes.withColumn("root", F.coalesce("root", "key")))
    classes = nodes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    facts = nodes.join(classes, "root").select(
        "key",
        F.col("root").alias("_class"),
        F.col("class_id").alias("_class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("_links"),
        F.col("copies").alias("_copies"),
    )
    return plain.withColumn("key", text_key(text)).join(facts, "key").select(
        *[F.col(n).alias(f) for n, f in zip(names, fields, strict=True)],
        *[F.col(n).alias(f) for n, f in zip(("_class", "_class_id", "_links", "_copies"), into, strict=True)],
    )


def near_duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return near_duplicates(narrow).select(
        "doc_id",
        F.col("_class_id").alias("class_id"),
        F.col("_links").alias("n_links"),
        F.col("_copies").alias("n_copies"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class of near duplicates, that of the smallest id, with the columns of `docs`."""
    *into, rank = unused(docs.columns, "_class", "_class_id", "_links", "_copies", "_rank")
    marked = near_duplicates(docs, into=tuple(into))
    order = Window.partitionBy(into[0]).orderBy(F.col("doc_id").asc_nulls_last(), text_key(F.col("text")))
    first = marked.withColumn(rank, F.row_number().over(order)).filter(F.col(rank) == 1)
    return first.drop(rank, *into)

"""Filter audit, SimHash components and hard negatives against brute force on small inputs."""

from __future__ import annotations

from collections import Counter
from itertools import permutations

import numpy as np
import pytest
import xxhash
from amperline.llm.audit import FILTERS, Trie, adaptive_prefixes, audit_filters, document_masks
from amperline.llm.catalog import ORACLES, QUERIES
from amperline.llm.negatives import Block, hard_negatives, mined_negatives
from amperline.llm.simhash import anchors, fingerprint, fingerprint_components, joined

from check_oracles import TABLES, rows_of

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, mask int, fp long, fingerprint string"
SPACES = " \t\n\x0b\x0c\r"


def prose(seed: int, count: int, vocabulary: int = 4000) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, vocabulary, count))


BASE = prose(1, 400)
TEXTS = [
    (1, BASE, "en"),
    (2, BASE, "en"),
    (2, BASE, "en"),
    (3, BASE.replace("w1", "W1", 1), None),
    (4, BASE + " more", ""),
    (5, None, "en"),
    (6, "", "fr"),
    (7, "   \n\t ", "en"),
    (None, BASE, "en"),
    (None, BASE, "en"),
    (8, prose(3, 30_000), "en"),
    (9, "#$ AB " * 120, "fr"),
    (10, "LOUD " * 99, "fr"),
    (0, BASE + " more", "fr"),
    (11, "one two", "fr"),
    (12, "ONE two", "fr"),
    *[(100 + i, BASE[:1500] + f" tail {i}", "en") for i in range(30)],
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, p, "s", 0, 0, "x") for i, t, p in TEXTS], SHAPE).repartition(3)


def words_of(text: str) -> list[str]:
    for space in SPACES:
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


def mask_of(text: str, repeated: bool) -> int:
    words = words_of(text)
    return (
        (len(words) < 100)
        | (100 * len(set(words)) < 80 * len(words)) << 1
        | (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text)) << 2
        | any(c in "#$%&*|" for c in text) << 3
        | repeated << 4
    )


def expected_masks() -> Counter:
    found: Counter = Counter()
    for i, t, p in TEXTS:
        repeated = i is not None and any(o is not None and o < i and (u or "") == (t or "") for o, u, _ in TEXTS)
        found[i, p or "", mask_of(t or "", repeated)] += 1
    return found


@pytest.mark.parametrize(("ranges", "held"), [(4, 48_000_000), (40, 1), (1, 5000)])
def test_masks_equal_brute_force(docs, ranges, held):
    found: Counter = Counter()
    for row in document_masks(docs, ranges=ranges, held=held).collect():
        found[row.doc_id, row.part, row.mask] += row.copies
    assert found == expected_masks()


def test_audit_counts_every_order(spark, docs):
    labels = spark.createDataFrame([(2, 1, 1), (9, 1, 0), (9, 0, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [row for row, n in expected_masks().items() for _ in range(n)]
    expected, shares = {}, Counter()
    for order in permutations(FILTERS):
        for part in {p for _, p, _ in rows}:
            alive = [(i, m) for i, p, m in rows if p == part]
            gone: list = []
            for step, letter in enumerate(order, 1):
                bit = 1 << FILTERS.index(letter)
                out = [x for x in alive if x[1] & bit]
                alive = [x for x in alive if not x[1] & bit]
                shares[part, letter] += len(out)
                expected[part, "".join(order), step] = (
                    len(alive),
                    len(out),
                    sum(bool(m & bit) for _, m in gone),
                    sum(m == bit for _, p, m in rows if p == part),
                    sum(i in (2, 9) for i, _ in out),
                    sum(i in (2, 9) for i, _ in out),
                )
                gone += out
    found = audit_filters(docs, labels).collect()
    assert len(found) == len(expected) == 3 * 120 * 5
    for row in found:
        key = (row.part, row.filter_order, row.step)
        assert tuple(row)[3:9] == expected[key]
        assert row.shapley == shares[row.part, row.filter_order[row.step - 1]]


def test_trie_keeps_the_least_id():
    trie, texts = Trie(), [b"", b"abc", b"ab", b"abd", b"abc", b"", b"x" * 1000, b"x" * 999 + b"y", b"ab"]
    ends = [trie.put(t, 10 - at) for at, t in enumerate(texts)]
    assert [e for e in ends] == [0, 1, 2, 3, 1, 0, 4, 5, 2]
    assert trie.least == [5, 6, 2, 7, 4, 3]


def test_prefixes_reach_behind_a_long_common_beginning(spark):
    start = "same beginning " * 100
    rows = [(i, start + f"{i % 50:03d} and more") for i in range(400)] + [(i, "only text") for i in range(400, 800)]
    bounds = adaptive_prefixes(spark.createDataFrame(rows, "doc_id long, text string"), 10)
    behind = [b for b in bounds if b.startswith(start.encode())]
    assert len(behind) >= 5 and max(map(len, behind)) <= len(start) + 3


def test_nothing_in_nothing_out(spark, docs):
    nothing = spark.createDataFrame([], SHAPE)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit_filters(nothing, labels).count() == 0
    assert fingerprint_components(nothing).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mined_negatives(vectors).count() == 0


def print_of(text: str) -> int:
    words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
    runs = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_components_equal_brute_force(docs):
    found = Counter(map(tuple, fingerprint_components(docs, block=4).collect()))
    prints = [print_of(t or "") for _, t, _ in TEXTS]
    root = list(range(len(TEXTS)))
    for _ in TEXTS:
        for a, x in enumerate(prints):
            for b, y in enumerate(prints):
                if (x ^ y).bit_count() <= 3:
                    root[a] = root[b] = min(root[a], root[b])
    expected: Counter = Counter()
    for at, (i, _, _) in enumerate(TEXTS):
        ids = [TEXTS[b][0] for b in range(len(TEXTS)) if root[b] == root[at] and TEXTS[b][0] is not None]
        expected[i, f"{prints[at]:016x}", min(ids, default=None)] += 1
    assert found == expected
    assert fingerprint("") == fingerprint(None) == 0


@pytest.mark.parametrize("powers", [(1,), (1, 3), (1, 3, 9)])
def test_every_near_pair_meets_at_a_home(powers):
    words = anchors(powers)
    assert len(np.unique(words)) == len(words) == {(1,): 2**7, (1, 3): 2**13, (1, 3, 9): 2**16}[powers]
    rng = np.random.default_rng(5)
    for x in rng.integers(0, 2**64, 100, dtype=np.uint64):
        y = x
        for bit in rng.choice(64, 3, replace=False):
            y ^= np.uint64(1) << np.uint64(bit)
        one, other = np.bitwise_count(words ^ x), np.bitwise_count(words ^ y)
        at_one, at_other = int(one.argmin()), int(other.argmin())
        assert other[at_one] <= other.min() + 3 or one[at_other] <= one.min() + 3


def test_joined_finds_groups():
    far = 2**40 + 2**50 + 2**60
    values = np.array([0, 1, 3, 7, far, far + 1, 2**64 - 1], np.uint64)
    one, root = joined(values, values, 1)
    assert dict(zip(one.tolist(), root.tolist(), strict=True)) == {1: 0, 3: 0, 7: 0, far + 1: far}


def negatives_of(rows, positives=5, negatives=3):
    found: Counter = Counter()
    for i, label, v in dict.fromkeys(rows):
        if i % 50:
            continue
        scored = [(sum(map(int.__mul__, v, w)), j, other) for j, other, w in rows]
        near = sorted((-s, j) for s, j, other in scored if other == label and j != i)[:positives]
        for s, j in near:
            band = sorted((-t, k) for t, k, other in scored if other != label and -50 * s <= 100 * t <= -95 * s)
            for rank, (t, k) in enumerate(band[:negatives], 1):
                found[i, j, rank, k, -s, -t] += 1
    return found


@pytest.mark.parametrize("clusters", [1, 7])
def test_negatives_equal_brute_force(spark, clusters):
    rng = np.random.default_rng(8)
    centres = rng.normal(0, 60, (4, 6))
    rows = [(int(i), int(i * 7 % 3), tuple(map(int, centres[i % 4] + rng.normal(0, 25, 6)))) for i in range(600)]
    rows += rows[:2] + [(50, 0, (0, 0, 0, 0, 0, 0)), (601, 1, rows[50][2]), (602, 2, rows[50][2])]
    frame = spark.createDataFrame(
        [(i, label, list(map(float, v)), "x") for i, label, v in rows], "id long, label long, vector array<double>, akey string"
    )
    asks = frame["id"] % 50 == 0
    found = hard_negatives(frame.repartition(3), asks, clusters=clusters, members=4)
    assert Counter(map(tuple, found.collect())) == negatives_of(rows)


def test_rows_that_take_no_part(spark):
    rows = [(i, [float(i % 9) / 8, 1.0], i % 2) for i in range(101)]
    bad = [(None, [1.0, 1.0], 1), (200, None, 1), (250, [1.0, None], 0), (300, [float("nan"), 1.0], 0), (350, [float("inf"), 1.0], 1), (400, [1.0, 1.0], None)]
    shape = "vec_id long, embedding array<float>, label int"
    good = mined_negatives(spark.createDataFrame(rows, shape)).collect()
    assert good and sorted(mined_negatives(spark.createDataFrame(rows + bad, shape)).collect()) == sorted(good)


def test_bound_holds_for_every_member():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 50, (200, 5)).round()
    vectors[3] = 0
    block = Block(pa.table({"id": np.arange(200), "label": np.zeros(200, int), "vector": vectors.tolist()}))
    members = vectors[:20]
    bounds = block.bounds(members)
    norms = np.sqrt((members**2).sum(axis=1))
    assert (members @ vectors.T <= norms[:, None] * bounds[None, :] * (1 + 1e-9) + 1e-3).all()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    for table in TABLES:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    frame = QUERIES[name](spark, SF)
    answer = duck.execute(ORACLES[name])
    columns = [item[0] for item in answer.description]
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, answer.fetchall())

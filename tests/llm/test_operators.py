"""Operators against brute force on small inputs: nulls, empty and long texts, repeats, clashing names."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from amperline.llm.bpe import PairMerger
from amperline.llm.containment import contaminated, find_items
from amperline.llm.host_rules import judge_by_host, measure
from amperline.llm.induced import CAP, sorted_suffixes
from amperline.llm.jaccard import keep_one_of_each, near_duplicates
from amperline.llm.katz import score_texts
from amperline.llm.mixing import mix, source_weights
from amperline.llm.pages import blocks_of, extract_main_text, shared_lines, template_lines
from amperline.llm.repeats import remove_repeats
from amperline.llm.templates import drop_recurring_lines
from amperline.llm.toxicity import drop_toxic, score_toxicity
from pyspark.sql import functions as F

SHAPE = "doc_id long, text string, lang string, source string, n_chars long, key string, _text string"


def words(seed: int, count: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 5000, count))


BASE = words(1, 300)
NEAR = BASE.replace(BASE.split()[150], "other", 1)
TEXTS = [
    (1, BASE),
    (2, BASE),
    (2, BASE),
    (3, NEAR),
    (4, words(2, 200)),
    (5, None),
    (6, ""),
    (7, "  \n\t "),
    (None, "few words"),
    (8, words(3, 30_000)),
    (9, words(4, 50) + " " + " ".join(BASE.split()[100:220]) + " " + words(5, 50)),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None, "s" if (i or 0) % 2 else None, 0, "k", "x") for i, t in TEXTS]
    return spark.createDataFrame(rows, SHAPE)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SHAPE)


def shingles(text: str | None) -> frozenset:
    w = (text or "").encode().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_suffix_order_and_prefixes():
    rng = np.random.default_rng(0)
    for case in range(200):
        text = rng.integers(1, 4, rng.integers(0, 60))
        if case % 10 == 0:
            text = np.r_[np.full(900, 2), 3, np.full(700, 2), 1, np.full(450, 2)]
        text = np.r_[text, 0].astype(np.uint8)
        raw = text.tobytes()
        order = sorted(range(len(raw)), key=lambda i: raw[i:])
        shared = [0]
        for a, b in zip(order[:-1], order[1:], strict=True):
            n = 0
            while n < CAP and max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
                n += 1
            shared.append(n)
        for most in (1_000_000, 3):  # suffixes held in memory; beyond, the queues are in a file
            got = sorted_suffixes(text, most)
            assert got[0].tolist() == order
            assert got[1].tolist() == shared


def test_repeated_bytes(docs):
    texts = [(t or "").encode() for _, t in TEXTS]
    seen = Counter(t[s : s + 400] for t in texts for s in range(len(t) - 399))
    expected = []
    for (doc_id, _), t in zip(TEXTS, texts, strict=True):
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - 399):
            if seen[t[s : s + 400]] > 1:
                gone[s : s + 400] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        expected.append((doc_id, len(t), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    # with two anchors of a hash the shards are cut by offset as well
    for most in (4096, 1):
        found = remove_repeats(docs, most=most)
        assert found.columns[:7] == docs.columns
        rows = [(r.doc_id, r._bytes, r._removed, r._kept_sha256) for r in found.collect()]
        assert sorted(rows, key=str) == sorted(expected, key=str)


def test_near_duplicates(docs):
    found = near_duplicates(docs).collect()
    for row in found:
        others = {t for _, t in TEXTS if t != row.text and shingles(t) and shingles(row.text)}
        linked = [
            t for t in others
            if len(shingles(t) & shingles(row.text)) >= 0.8 * len(shingles(t) | shingles(row.text))
        ]
        assert row._links == len(linked)
    assert {r._class_id for r in found if r.doc_id in (1, 2, 3)} == {1}
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8, 9]


def test_large_buckets_are_cut(spark):
    base = BASE.split()
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1 :]])) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(frame, block=7).collect()
    assert {(r._class_id, r._links) for r in found} == {(0, 39)}


def test_contained_items(spark, docs):
    inside = " ".join(BASE.split()[110:150])
    items = spark.createDataFrame(
        [(1, inside), (1, inside), (2, words(9, 40)), (3, None), (4, ""), (5, "few words")], "item_id long, text string"
    )
    expected = {
        (d, i)
        for d, t in TEXTS
        for i, q in ((1, inside), (2, words(9, 40)), (5, "few words"))
        if len(shingles(q) & shingles(t)) >= 0.8 * len(shingles(q))
    }
    for size in (500_000, 10):
        hits = find_items(docs, items, words=size).select("doc_id", F.explode("_hits").alias("h")).collect()
        assert {(r.doc_id, r.h.item_id) for r in hits} == expected
    assert contaminated(docs, items.limit(0)).count() == 0


def test_short_items_in_long_texts(spark):
    texts = spark.createDataFrame([(1, f"{BASE} few words here {BASE}"), (2, "few words"), (3, BASE)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "few words"), (2, "words here w"), (3, "here")], "item_id long, text string")
    hits = {(r.doc_id, r.item_id, r.containment) for r in contaminated(texts, items).collect()}
    assert hits == {(1, 1, 1.0), (1, 3, 1.0), (2, 1, 1.0)}


def test_token_counts():
    tokenizers = pytest.importorskip("tokenizers")
    public = pytest.importorskip("public_tokenizers")
    path = public.path("word_bpe_49k.json")
    texts = [t or "" for _, t in TEXTS] + ["<|endoftext|>Hi it's<|startoftext|>", "aaaa" * 300, "ΑΣ ÉTÉ Straße İ 中文 ½²"]
    library = tokenizers.Tokenizer.from_file(path)
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert PairMerger(path, remembered=50).count(texts) == expected


def test_base_measures(docs, nothing):
    assert measure(None) == (0, 0, 0, 0, 0)
    assert measure("a b c a b c\n#x\n#x\n\n \n") == (8, 10, 2, 1, 6)
    rows = judge_by_host(docs).collect()
    assert len(rows) == len(TEXTS)
    assert {r.doc_id for r in rows if r.kept} == {1, 2, 3, 4, 8, 9}
    assert judge_by_host(nothing).count() == 0


def test_pages(spark):
    page = "<head><title>t</title></head><nav><a>menu</a></nav><article><h1>A &amp; b</h1><p>x <b>y<br>z<p>q</article><footer>f"
    assert blocks_of(page) == [(2, "A & b"), (2, "x y z"), (2, "q")]
    assert blocks_of(None) == []
    assert shared_lines([1, 2, 3, 4], [2, 9, 4, 1]) == {1, 3}
    plain = "<body><div>menu</div><p>own {}</p><div>end</div></body>"
    rows = [
        (1, "http://h/a/1", page, "c"),
        (2, "http://g/a/1", plain.format(1), "c"),
        (3, "http://g/a/2", plain.format(2), "c"),
        (4, None, plain.format(3), "c"),
        (5, "http://g/b", None, "c"),
    ]
    found = extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string, lines string"))
    assert {r.page_id: r.text for r in found.collect()} == {
        1: "A & b\nx y z\nq", 2: "own 1", 3: "own 2", 4: "menu\nown 3\nend", 5: "",
    }


def test_differencing_decides_on_every_page(spark):
    page = "<div>top of site</div><article>{}</article><p>{}</p>"
    story = "<p>one</p><p>two</p><p>three</p><p>four</p><p>five</p><p>six</p>"
    near = story.replace("six", "seven")
    texts = [("a1", "teaser", "long text"), *[(f"b{i}", story, "") for i in range(9)], ("b9", near, ""), ("c1", "<p>else</p>two", "")]
    rows = [(i, f"http://h/{path}", page.format(x, y)) for i, (path, x, y) in enumerate(texts)]
    found = {r.page_id: r.text for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    told = ["one\ntwo\nthree\nfour\nfive\nsix"] * 9
    assert found[0] == "teaser\nlong text"
    assert [found[i] for i in range(1, 10)] == told
    # "two" is on one other body only, so it is no line of the template
    assert found[10] == "one\ntwo\nthree\nfour\nfive\nseven"
    assert found[11] == "else\ntwo"


def test_template_lines_need_a_second_page():
    assert template_lines([1, 2, 3, 4], [[1, 2, 9, 8], [1, 7, 6, 5], [1, 2, 3, 4]]) == [0]
    assert template_lines([1, 2, 3, 4], [[1, 2, 9, 8]]) == [0, 1]
    assert template_lines([1, 2, 3], [[1, 2, 9], [1, 2, 8], [1, 7, 6], [1, 5, 5]]) == [0]
    assert template_lines([1, 2, 3, 4], [[1, 2, 3, 4]]) == template_lines([], []) == []


@pytest.mark.parametrize(
    "piece", ["<script ", "<a ", '<a "', "<a '\"<b'\" ", "<b></i>", "<!-- ", "<!x ", "<script>", "</script   ", "<", "<p>x</p>"]
)
def test_broken_markup_takes_linear_time(piece):
    import time

    start = time.perf_counter()
    blocks_of(piece * (1_000_000 // len(piece)) + ">")
    assert time.perf_counter() - start < 20


def test_markup_of_broken_pages():
    def texts(page):
        return [text for _, text in blocks_of(page)]

    assert texts('<p title="a>b">x</p>') == ["x"] and texts("<p title='a>b>x") == ["b>x"]
    assert texts("a < b <!-- c") == ["a < b"] and texts("x <a ") == ["x <a"]
    assert texts("1<script>if (a<b) '</p>'</script >2") == ["12"] and texts("1<style>x") == ["1"]
    assert texts("<p>a<p>b</i></b>c") == ["a", "bc"] and texts("<div><nav>m</div>t") == ["t"]


def test_pages_of_an_empty_table(spark):
    assert extract_main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_marks_in_names_of_main_elements():
    for page in (
        '<article class="post comments-open"><p>text</p></article>',
        '<main class="has-sidebar"><p>text</p></main>',
        '<article class="login"><p>text</p></article>',
    ):
        assert blocks_of(page) == [(2, "text")]
    for page in (
        '<body class="no-sidebar"><p>text</p><div class="sidebar">x</div></body>',
        '<div class="with-menu"><p>text</p><div id="cookie-banner">x</div></div>',
    ):
        assert blocks_of(page) == [(1, "text")]


def test_recurring_lines(spark, docs, nothing):
    rows = [(i, f"{words(i, 20)}\nposted 12:{i:02d} by all of us here\n{words(900 + i, 20)}") for i in range(12)]
    found = drop_recurring_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all("posted" not in r.text and r._dropped == 1 and r._lines == 3 for r in found)
    same = drop_recurring_lines(docs)
    assert same.columns[:7] == docs.columns
    key = lambda t: str(t)
    assert sorted((r.text for r in same.collect()), key=key) == sorted((t for _, t in TEXTS), key=key)
    assert drop_recurring_lines(nothing).count() == 0


def test_recurring_lines_in_one_surrounding(spark):
    footer = "all rights are held by us\nwrite to the desk at noon\nprinted in the old town hall"
    kinds = {
        "footer": lambda i: f"{words(i, 30)}\n{footer}",
        "blank": lambda i: f"{words(100 + i, 30)}\n\nread more on our other site\n\n{words(200 + i, 30)}",
        "whole": lambda i: f"posted 12:{i:02d} by all of us here",
        "few": lambda i: f"{words(300 + i, 30)}\nonly some of the texts have this",
        "copies": lambda i: " ".join([*BASE.split()[:i], f"x{i}", *BASE.split()[i + 1 : 150]]) + "\nthe end of this one story",
    }
    rows = [(k, f(i)) for k, f in kinds.items() for i in range(9 if k == "few" else 12)]
    found = drop_recurring_lines(spark.createDataFrame(rows, "kind string, text string")).collect()
    dropped = {k: {r._dropped for r in found if r.kind == k} for k in kinds}
    assert dropped == {"footer": {3}, "blank": {1}, "whole": {1}, "few": {0}, "copies": {0}}


def test_mixing(spark, docs, nothing):
    rows = [(i, "a b c d e f g h i j", "big" if i % 10 else "small") for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    given = mix(frame, repetitions=3.0, block_tokens=500).groupBy("source", "doc_id").count()
    per_source = {r.source: r.n for r in given.groupBy("source").agg(F.sum("count").alias("n")).collect()}
    # 40 of 400 documents: three passes of the small source, the rest of the budget for the large one
    assert abs(per_source["small"] - 120) <= 1 and abs(per_source["big"] - 280) <= 1
    assert given.filter("source = 'small'").agg(F.max("count")).first()[0] == 3
    counted = frame.select(F.col("source").alias("_source"), F.lit(10).cast("long").alias("_tokens"))
    weights = [r._weight for r in source_weights(counted, entropy=0.5).collect()]
    assert abs(-sum(w * math.log(w) for w in weights) - 0.5) < 1e-6
    assert mix(nothing).count() == 0
    assert mix(docs).columns[:7] == docs.columns


def test_toxicity(spark, docs, nothing):
    rows = [(i, words(i, 60) + (" you idiot" if i % 4 == 0 else "")) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    found = score_toxicity(frame, labels).collect()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    assert np.mean([r.predicted == (r.doc_id % 4 == 0) for r in held]) > 0.97
    assert sorted(r.doc_id for r in drop_toxic(frame, labels).collect()) == [i for i in range(400) if i % 4]
    assert len(score_toxicity(docs, labels.limit(0)).collect()) == len(TEXTS)
    assert score_toxicity(nothing, labels).count() == 0


def test_language_model(docs, nothing):
    found = score_texts(docs, block_bytes=500, bucket_keys=100).collect()
    tokens = [(i, [*(t or "").encode().lower().split(), b""]) for i, t in TEXTS]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, t in tokens if not held(i) for w in t)
    total = sum(counts.values())
    assert {r.train_tokens for r in found} == {total}
    expected = [
        (str(i), len(t), sum(w in counts for w in t), round(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in t), 6))
        for i, t in tokens
    ]
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == sorted(expected)
    assert all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert score_texts(nothing).count() == 0


def test_host_rates_equal_brute_force_and_reject_by_rule(spark):
    rng = np.random.default_rng(4)
    hosts = {"good": (400, 0.1), "other": (300, 0.12), "bad": (200, 0.9), "small": (2, 1.0), None: (50, 0.1)}
    rows = []
    for host, (count, share) in hosts.items():
        for _ in range(count):
            rows.append((len(rows), words(len(rows), 10 if rng.random() < share else 60), host))
    rows += [(len(rows) + i, words(5000 + i, 100).replace("w", "##w"), "marks") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    failed = {i: len(t.split()) < 50 or 100 * measure(t)[4] > 50 * len(t.split()) for i, t, _ in rows}
    symbols = {i: 100 * measure(t)[2] > 10 * measure(t)[1] for i, t, _ in rows}

    def shrunk(broken):
        n, k = Counter(h for _, _, h in rows), Counter(h for i, _, h in rows if broken[i])
        total, mean = len(rows), sum(broken.values()) / len(rows)
        beyond = sum(k[h] ** 2 / n[h] for h in n) / total - mean**2 - mean * (1 - mean) * len(n) / total
        strength = min(total, mean * (1 - mean) / beyond) if beyond > 0 else total
        rate = {h: (k[h] + mean * strength) / (n[h] + strength) for h in n}
        low = {h: rate[h] - 3 * math.sqrt(rate[h] * (1 - rate[h]) / (n[h] + strength + 1)) for h in n}
        return rate, {h for h in n if low[h] > max(0.25, 2 * mean)}

    rate, out = shrunk(failed)
    _, marked = shrunk(symbols)
    assert out == {"bad"} and marked == {"marks"}
    found = {r.doc_id: r for r in judge_by_host(docs).collect()}
    assert len(found) == len(rows)
    for i, _, host in rows:
        row = found[i]
        assert row.host_rate == pytest.approx(rate[host], abs=2e-9)
        names = ["base"] * (host in out) + ["symbols"] * (host in marked)
        assert row.host_rules == ",".join(names)
        assert row.base_failed == failed[i] and row.kept == (not failed[i] and not names)
    assert sum(r.kept for r in found.values()) < sum(not r.base_failed for r in found.values())

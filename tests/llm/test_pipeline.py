"""The stages of the corpus pipeline on small tables, each against a plain rule, and columns of any name."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import pytest
from amperline.llm.containment import find_items
from amperline.llm.jaccard import near_duplicates
from amperline.llm.mixing import mix
from amperline.llm.templates import drop_recurring_lines
from amperline.llm.toxicity import fit, scored

NAMES = [
    "_score", "_hits", "_class", "_class_id", "_links", "_copies", "_rank", "_lines", "_dropped", "_epoch", "_block",
    "_order", "_weight", "_text", "_draw", "EPOCH", "weight", "doc_order", "key", "_SCORE_",
]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in NAMES)
STAGES = dict(corpus_pipeline.STAGES)


def words(seed: int, count: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, 4000, count))


ITEM = words(77, 30)
NEAR = words(50, 300)
TOXIC = " vile you awful"
TEXTS = {
    **{i: words(i, 80) for i in range(40)},
    **{i: words(i, 60) + TOXIC * 5 for i in range(40, 60)},
    60: words(60, 40) + " " + ITEM + " " + words(61, 40),
    61: NEAR,
    62: NEAR.replace(NEAR.split()[150], "changed", 1),
    63: NEAR,
    64: None,
    65: "",
    66: " \n ",
    **{i: f"{words(i, 50)}\nsubscribe to our letter number {i} today\n{words(i + 500, 50)}" for i in range(70, 85)},
    90: words(90, 30_000),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, None if i % 7 == 0 else "en", f"s{i % 3}", len(t or ""), *range(len(NAMES))) for i, t in TEXTS.items()]
    rows.append(rows[5])
    spark.createDataFrame(rows, SHAPE).write.parquet(f"{place}/documents.parquet")
    labels = [(i, 1, int(40 <= i < 60)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{place}/labels.parquet")
    items = [(1, ITEM), (2, words(99, 25)), (3, None), (4, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


EVERY = sorted([*TEXTS, 5])


def test_toxic_documents_go(spark, docs, folder):
    left = STAGES["toxicity"](spark, docs, folder)
    assert left.columns == docs.columns
    assert ids(left) == [i for i in EVERY if not 40 <= i < 60]


def test_recurring_lines_go(spark, docs, folder):
    left = STAGES["line_dedup"](spark, docs, folder)
    assert left.columns == docs.columns and ids(left) == EVERY
    for row in left.collect():
        expected = TEXTS[row.doc_id]
        if 70 <= row.doc_id < 85:
            first, _, last = expected.split("\n")
            expected = f"{first}\n{last}"
        assert row.text == expected and row.n_chars == len(expected or "")


def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_one_of_each_group_stays(spark, docs, folder):
    left = STAGES["near_duplicates"](spark, docs, folder)
    kept, sets = [], {i: shingles(t) for i, t in TEXTS.items()}
    for i in sorted(TEXTS):
        near = (j for j in kept if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) and sets[i])
        same = (j for j in kept if (TEXTS[i] or "") == (TEXTS[j] or ""))
        if next(near, next(same, None)) is None:
            kept.append(i)
    assert left.columns == docs.columns and ids(left) == kept


def test_documents_with_test_items_go(spark, docs, folder):
    left = STAGES["decontamination"](spark, docs, folder)
    items = [shingles(ITEM), shingles(words(99, 25))]
    clean = [i for i in EVERY if not any(len(s & shingles(TEXTS[i])) >= 0.8 * len(s) for s in items)]
    assert left.columns == docs.columns and ids(left) == clean and 60 not in clean


def test_mixture_gives_out_whole_documents(spark, docs, folder):
    given = STAGES["mixing"](spark, docs, folder)
    names = [c for c in docs.columns if c.lower() not in ("epoch", "weight", "doc_order")]
    assert given.columns == [*names, "epoch", "block_order", "doc_order", "weight"]
    rows = given.collect()
    # the budget is that of all words, so no source is repeated beyond four times, and weights sum to one
    assert max(r.epoch for r in rows) < 4
    assert abs(sum({r.source: r.weight for r in rows}.values()) - 1) < 1e-9
    assert all(r.text == TEXTS[r.doc_id] for r in rows)


def test_the_whole_pipeline(spark, folder):
    left = corpus_pipeline.run(spark, folder)
    found = {r.doc_id for r in left.select("doc_id").collect()}
    gone = {*range(40, 60), 60, 62, 63}
    assert not found & gone and found <= set(TEXTS)
    for name, stage in corpus_pipeline.STAGES:
        empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
        assert stage(spark, empty, folder).count() == 0, name


def test_results_replace_columns_of_their_names(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    frames = {
        ("_score",): scored(docs, fit(docs, labels)),
        ("_hits",): find_items(docs, spark.read.parquet(f"{folder}/benchmark.parquet")),
        ("_lines", "_dropped"): drop_recurring_lines(docs),
        ("_class", "_class_id", "_links", "_copies"): near_duplicates(docs),
        ("_epoch", "_block", "_order", "_weight"): mix(docs),
    }
    for names, frame in frames.items():
        assert frame.columns == [*[c for c in docs.columns if c not in names], *names]
        assert frame.select(*frame.columns).count() > 0

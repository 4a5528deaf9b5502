"""Registered queries of the pipeline operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from amperline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register a query under its own name."""
    QUERIES[function.__name__] = function
    return function


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures of all documents, with the verdicts of their sources."""
    from amperline.llm.host_rules import judge_by_host

    return judge_by_host(table(spark, sf_dir, "documents"))


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents."""
    import public_tokenizers

    from amperline.llm.bpe import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    from amperline.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items contained in documents."""
    from amperline.llm.containment import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mixture of all sources gives out over a budget of all words."""
    from amperline.llm.mixing import mixture

    return mixture(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines of recurring templates."""
    from amperline.llm.templates import line_dedup

    return line_dedup(table(spark, sf_dir, "documents"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    from amperline.llm.pages import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near duplicates of all documents."""
    from amperline.llm.jaccard import near_duplicate_classes

    return near_duplicate_classes(table(spark, sf_dir, "documents"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without byte strings that are found twice."""
    from amperline.llm.repeats import repeated_bytes

    return repeated_bytes(table(spark, sf_dir, "documents"))


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of all documents."""
    from amperline.llm.katz import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


@query
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the components that hang together by few bits."""
    from amperline.llm.simhash import fingerprint_components

    return fingerprint_components(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors among all embeddings."""
    from amperline.llm.negatives import mined_negatives

    return mined_negatives(table(spark, sf_dir, "embeddings"))


ORACLES["op13_hard_negatives"] = """
WITH e AS (
    SELECT vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, a.label AS anchor_label, e.vec_id, e.label,
           CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
    FROM e AS a JOIN e ON a.vec_id <> e.vec_id
    WHERE a.vec_id % 50 = 0
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score
    FROM s WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label
WHERE 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""


@query
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interaction of five filters over all documents, in all orders."""
    from amperline.llm.audit import audit_filters

    return audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op11_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), w AS (
    SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY text) AS least
    FROM d
), f AS (
    SELECT doc_id, part,
           CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
    FROM w
), l AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), c AS (
    SELECT part, mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, count(*) AS n
    FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL
), x(letter, bit) AS (
    VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), o AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
    FROM x a, x b, x c, x d, x e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), s AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS letter,
           (SELECT bit FROM x WHERE x.letter = substr(filter_order, step, 1)) AS own,
           coalesce((SELECT sum(bit) FROM x WHERE strpos(filter_order, x.letter) < step), 0)::INTEGER AS earlier
    FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)
), r AS (
    SELECT part, filter_order, step, letter,
           sum(CASE WHEN mask & earlier = 0 AND mask & own = 0 THEN n ELSE 0 END)::BIGINT AS kept,
           sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
           sum(CASE WHEN mask & earlier <> 0 AND mask & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
           sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
           sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 AND good = 1 THEN n ELSE 0 END)::BIGINT AS good_lost,
           sum(CASE WHEN mask & earlier = 0 AND mask & own <> 0 AND toxic = 1 THEN n ELSE 0 END)::BIGINT AS toxic_lost
    FROM c, s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley
FROM r
"""

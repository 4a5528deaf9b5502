"""Quality rules judged by host: shrunken failure rates decide for all documents of a host."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from amperline.llm.common import SPACES, record_batch, small_batches
from amperline.session import durable

SYMBOLS = "#*$%&|<>"


def repeated_words(words: list[bytes], width: int = 3) -> int:
    """Words that lie in a window of `width` words found at least twice in the text."""
    count = len(words) - width + 1
    if count < 2:
        return 0
    codes = pd.factorize(np.array(words, dtype=object))[0].astype(np.int64)
    window = codes[:count]
    for at in range(1, width):
        # both numbers stay below the text's length, so their product fits and the code is exact
        window = pd.factorize(window * len(words) + codes[at : at + count])[0].astype(np.int64)
    twice = np.bincount(window)[window] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:count] += twice
    edges[width : width + count] -= twice
    return int((np.cumsum(edges[:-1]) > 0).sum())


def lines_of(text: str | None) -> list[str]:
    """The lines of a text that have a word."""
    return [x for x in (text or "").split("\n") if x.strip(SPACES)]


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = lines_of(text)
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def document_measures(docs: DataFrame, host: str) -> DataFrame:
    """The base measures and rule failures of every whole text, beside its host."""
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    schema = pa.schema([("doc_id", pa.int64()), ("host", pa.string()), *((f, pa.int64()) for f in fields)])

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            rows = [(*measure(t), len(lines_of(t))) for t in batch.column("text").to_pylist()]
            yield record_batch(schema, batch.column("doc_id"), batch.column("host"), *zip(*rows, strict=True))

    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(host).cast("string").alias("host"),
        F.col("text").cast("string").alias("text"),
    )
    found = narrow.mapInArrow(measured, "doc_id long, host string, " + ", ".join(f"{f} long" for f in fields))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.withColumn("base_failed", base)


#: Rules judged by host: conditions on the measures that a document breaks.
RULES = {
    "base": "base_failed",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 30 * n_lines",
}


def host_rates(measures: DataFrame, rules: dict[str, str]) -> DataFrame:
    """Failures of every rule by host, with the rate shrunk towards all hosts and its lower bound.

    One row per host and rule. The beta prior of a rule comes from the hosts' own
    rates by moments: their mean and variance, weighted by documents, less the
    variance that binomial chance alone gives. Where hosts differ no more than chance,
    or there is only one, the prior is as strong as all documents, and each host gets
    about the common rate; where they differ, a host of many documents keeps its own.
    `low` is three standard deviations of the posterior below the rate. All sums are
    combined before the shuffle, so a host with a third of the rows sends one row per
    task.
    """
    failed = [F.count_if(F.expr(broken)).alias(name) for name, broken in rules.items()]
    wide = measures.groupBy("host").agg(F.count("*").alias("n"), *failed)
    hosts = wide.unpivot(["host", "n"], list(rules), "rule", "k")
    prior = hosts.groupBy("rule").agg(
        F.sum("n").cast("double").alias("docs"),
        F.count("*").alias("hosts"),
        (F.sum("k") / F.sum("n")).alias("mean"),
        (F.sum(F.col("k") * F.col("k") / F.col("n")) / F.sum("n")).alias("second"),
    )
    spread = F.col("mean") * (1 - F.col("mean"))
    beyond = F.col("second") - F.col("mean") * F.col("mean") - spread * F.col("hosts") / F.col("docs")
    strength = F.least(F.col("docs"), F.when(beyond > 0, spread / beyond).otherwise(F.col("docs")))
    rate = (F.col("k") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("strength") + 1))
    return (
        hosts.join(prior.select("rule", "mean", strength.alias("strength")), "rule")
        .withColumn("rate", rate)
        .select("host", "rule", "n", "k", "mean", "rate", (F.col("rate") - 3 * deviation).alias("low"))
    )


def judge_by_host(
    docs: DataFrame,
    host: str = "source",
    least: float = 0.25,
    times: float = 2.0,
    rules: dict[str, str] | None = None,
) -> DataFrame:
    """Rule measures of every document and the verdict of its host.

    A host is rejected for a rule if the lower bound of its shrunken failure rate is
    above `least` and above `times` the rate of all documents. A document is kept if it
    passes the base rules and its host is rejected for none of `rules`; host_rules
    names those it is rejected for. Rows without a host form one host of their own. A
    null or empty text has no words and fails; repeated rows are measured and counted
    as often as they come; an empty table gives no rows; other columns are not
    read. The measures, a few numbers per document, are stored once in the shared
    folder; hosts are joined to them, and a host of many documents is split by
    adaptive execution or, with few hosts, not shuffled at all.
    """
    measures = durable(document_measures(docs, host))
    rates = host_rates(measures, rules or RULES)
    rejected = F.col("low") > F.greatest(F.lit(least), times * F.col("mean"))
    own = F.col("rule") == "base"
    # at most as many names as there are rules
    verdict = rates.groupBy(F.col("host").alias("_host")).agg(
        F.array_join(F.array_sort(F.collect_list(F.when(rejected, F.col("rule")))), ",").alias("host_rules"),
        F.max("n").alias("host_docs"),
        F.max(F.when(own, F.col("k"))).alias("host_failed"),
        F.max(F.when(own, F.col("rate"))).alias("host_rate"),
    )
    return measures.join(verdict, F.col("host").eqNullSafe(F.col("_host"))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("host_rules") == "")).alias("kept"),
        "host_docs",
        "host_failed",
        F.round("host_rate", 9).alias("host_rate"),
        "host_rules",
    )

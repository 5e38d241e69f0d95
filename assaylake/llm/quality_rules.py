"""Quality rules whose verdicts are shared by the documents of a host.

Every document is measured once. Rule failures are counted by host, and each failure rate is shrunk towards the
rate of all hosts with a beta prior fitted to them by moments, so a host of a few documents is not judged by
chance. Where a host's shrunk rate of a rule is above ``HOST_LIMIT``, its documents must meet the stricter limit
of that rule; everywhere, a document that fails the base rules goes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import keyed, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
REPEAT_WINDOW = 5
# Share of a host's documents that may fail a rule, after shrinking.
HOST_LIMIT = 0.5
# Documents that the prior counts for at least.
LEAST_STRENGTH = 4.0
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeated_words(words: list[str], window: int = REPEAT_WINDOW) -> int:
    """Words inside windows that occur twice or more; windows are ranked pairwise, so nothing is hashed."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    rank, width = ids, 1
    while width < window:
        step = min(width, window - width)  # windows of width + step, from two that may overlap
        left, right = rank[: len(rank) - step], rank[step:]
        different, rank = np.unique(left * (int(rank.max()) + 1) + right, return_inverse=True)
        if len(different) == len(rank):  # no two windows of this width are equal, so no wider ones are
            return 0
        width += step
    often = np.bincount(rank)[rank] > 1
    if not often.any():
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def measure(text: str) -> tuple[int, int, int, int, int]:
    found = WORD.findall(text)
    seen, dup_lines = set(), 0
    for line in text.split("\n"):
        if line in seen:
            dup_lines += WORD.search(line) is not None
        else:
            seen.add(line)
    symbols = sum(text.count(c) for c in SYMBOLS)
    return len(found), sum(map(len, found)), symbols, dup_lines, repeated_words(found)


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, source, version, the five measures) for every row."""

    def run(batches):
        for batch in batches:
            rows = np.array([measure(t or "") for t in batch.column("text").to_pylist()], np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("doc_id", "source", "version")] + [pa.array(rows[:, i]) for i in range(5)],
                names=["doc_id", "source", "version", *MEASURES],
            )

    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("version"), "text")
    kinds = dict(rows.dtypes)
    schema = f"doc_id {kinds['doc_id']}, source {kinds['source']}, version long, " + ", ".join(f"{m} long" for m in MEASURES)
    return rows.mapInArrow(run, schema)


def rules() -> dict[str, tuple[Column, Column]]:
    """Per rule: a document fails it, and fails its stricter form that holds on bad hosts."""
    n = F.col("n_words")
    return {
        "short": (n < 10, n < 20),
        "repeats": (F.lit(100) * F.col("n_repeat_words") > F.lit(20) * n, F.lit(100) * F.col("n_repeat_words") > F.lit(10) * n),
        "symbols": (F.lit(100) * F.col("n_symbols") > F.lit(10) * n, F.lit(100) * F.col("n_symbols") > F.lit(5) * n),
        "lines": (F.lit(100) * F.col("n_dup_lines") > F.lit(10) * n, F.lit(100) * F.col("n_dup_lines") > F.lit(5) * n),
    }


BASE = ("short", "repeats")


def host_verdicts(measures: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(source, n_docs, rate_<rule>, bad_<rule>) per host; the null source is a host too."""
    tests = rules()
    hosts = measures.groupBy("source").agg(
        F.count("*").alias("n_docs"), *[F.sum(fails.cast("long")).alias(f"f_{r}") for r, (fails, _) in tests.items()]
    )
    # The prior's moments: one row for all hosts, whatever their number.
    moments = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n_docs").alias("docs"),
        F.sum(F.lit(1.0) / F.col("n_docs")).alias("inverse"),
        *[F.sum(f"f_{r}").alias(f"s_{r}") for r in tests],
        *[F.sum(F.pow(F.col(f"f_{r}") / F.col("n_docs"), 2)).alias(f"q_{r}") for r in tests],
        *[F.sum(F.col(f"f_{r}") / F.col("n_docs")).alias(f"m_{r}") for r in tests],
    ).first()
    columns = ["source", "n_docs"]
    for r in tests:
        mean, strength = beta_prior(
            moments["hosts"], moments["docs"] or 0, moments["inverse"] or 0.0, moments[f"s_{r}"] or 0, moments[f"m_{r}"] or 0.0, moments[f"q_{r}"] or 0.0
        )
        rate = (F.col(f"f_{r}") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
        columns += [rate.alias(f"rate_{r}"), (rate > limit).alias(f"bad_{r}")]
    return hosts.select(*columns)


def beta_prior(hosts: int, docs: int, inverse: float, failures: int, rates: float, squares: float) -> tuple[float, float]:
    """Mean and strength (alpha + beta) of the prior: what the rates vary beyond binomial chance.

    Without documents the prior is flat (1/2, 2); one host, or rates that vary no more than chance, give a prior
    as strong as all documents of an average host.
    """
    if not docs:
        return 0.5, 2.0
    mean = (failures + 1) / (docs + 2)
    average = docs / hosts
    if hosts < 2:
        return mean, average
    spread = max(0.0, (squares - rates * rates / hosts) / (hosts - 1))
    chance = mean * (1 - mean) * inverse / hosts
    beyond = spread - chance
    if beyond <= 0:
        return mean, average
    return mean, min(average, max(LEAST_STRENGTH, mean * (1 - mean) / beyond - 1))


def quality_rules(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Measures and verdict of every row: doc_id, source, version, the measures, base_failed, kept.

    Null text has no words and so fails the base rules, as an empty one does. Documents without a source share one
    host. Repeated rows are measured alike and count as often as they occur. An empty table gives an empty result.
    """
    held = stored(measured(docs), "quality")  # a few numbers per document; read by both passes below
    hosts = host_verdicts(held, limit).withColumnRenamed("source", "_host")
    tests = rules()
    failed = tests[BASE[0]][0] | tests[BASE[1]][0]
    strict = F.lit(False)
    for r, (_, stricter) in tests.items():
        strict = strict | (F.col(f"bad_{r}") & stricter)
    # One row per host on the right; a host with a third of all rows is split by adaptive execution.
    judged = held.join(hosts, F.col("source").eqNullSafe(F.col("_host")), "left")
    return judged.select(
        "doc_id", "source", "version", *MEASURES, failed.alias("base_failed"), (~failed & ~strict).alias("kept")
    )


def keep_good(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """The rows of ``docs`` that ``quality_rules`` keeps, with all their columns."""
    verdicts = quality_rules(docs, limit).filter("kept")
    good = verdicts.select(F.xxhash64("doc_id").alias("_id"), F.col("version").alias("_v"), F.xxhash64("source").alias("_s"))
    rows = keyed(docs).withColumn("_s", F.xxhash64("row.source"))
    return rows.join(good, ["_id", "_v", "_s"], "left_semi").select("row.*")

"""Repeated runs of lines, found by winnowing.

The method: lines are hashed once; of every ``run_lines`` consecutive hashes the least one (the last of equals) is
selected. A document's selected positions, some two of four, are its fingerprints: any two equal runs of that length select the
same one at the same place. The positions are stored, counted by fingerprint, and those whose fingerprint occurs at
one position only are dropped by a join. A match at a joined position extends to the left and right, over the runs
of ``run_lines`` lines that selected it: partners of a position may agree with it on either side only, so each of
these runs finds its first occurrence by a 128-bit hash. All but the first are deleted, and runs that overlap or touch
are one longer repetition. No pairs of positions are formed, so a line that a third of all documents hold costs one row each.

Runs of fewer lines count too where their words reach ``short_words``: each is a fingerprint of its own, so a long
line, or two, are deleted wherever they repeat, and exact copies of such documents go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assaylake.llm.common import SPACES, let, stored, word_count

# Consecutive lines with words that must agree before anything is deleted.
RUN_LINES = 3
# Words that make a repeated run of fewer lines count.
SHORT_WORDS = 50


def _content(lines: Column) -> Column:
    """The lines with words: raw index, and the text without white space around it."""
    trimmed = F.transform(lines, lambda line, i: F.struct(i.alias("raw"), F.btrim(line, F.lit(SPACES)).alias("s")))
    return F.filter(trimmed, lambda line: line["s"] != "")


def _lines(text: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _positions(h: Column, run_lines: int, short_words: int | None) -> Column:
    """The fingerprints of a document: hash, and the runs around it that selected it (start, lines, hash of their content)."""

    def members(start, lines):
        return [F.get(h, start + F.lit(i)) for i in range(lines)]

    def run(start, lines):
        found = members(start, lines)
        return F.struct(
            start.alias("start"),
            F.lit(lines).alias("lines"),
            F.xxhash64(*[m["a"] for m in found]).alias("a"),
            F.xxhash64(F.lit(1), *[m["b"] for m in found]).alias("b"),
        )

    def starts(lines):
        return F.when(F.size(h) >= lines, F.sequence(F.lit(0), F.size(h) - lines)).otherwise(F.array().cast("array<int>"))

    def selected(start):
        hashes = [F.struct(m["a"].alias("h"), F.lit(-i).alias("at")) for i, m in enumerate(members(start, run_lines))]
        return start - F.array_min(F.array(*hashes))["at"]

    def extended(chosen):
        """Every selected position once, with the runs to its left and right that selected it."""

        def position(at):
            around = F.sequence(F.greatest(at - (run_lines - 1), F.lit(0)), F.least(at, F.size(chosen) - 1))
            own = F.filter(around, lambda start: F.get(chosen, start) == at)
            return F.struct(F.get(h, at)["a"].alias("fingerprint"), F.transform(own, lambda start: run(start, run_lines)).alias("runs"))

        return F.transform(F.array_distinct(chosen), position)

    def short_run(start, lines):
        fingerprint = F.xxhash64(F.lit(lines), *[m["a"] for m in members(start, lines)])
        return F.struct(fingerprint.alias("fingerprint"), F.array(run(start, lines)).alias("runs"))

    def short_runs(lines):
        worded = F.filter(starts(lines), lambda start: sum((m["words"] for m in members(start, lines)), F.lit(0)) >= short_words)
        return F.transform(worded, lambda start: short_run(start, lines))

    found = [let(F.transform(starts(run_lines), selected), extended)]
    if short_words is not None:
        found += [short_runs(lines) for lines in range(1, run_lines)]
    return F.concat(*found)


def _fingerprints(docs: DataFrame, run_lines: int, short_words: int | None) -> DataFrame:
    """(doc_id, version, fingerprint, runs): a row per selected position."""

    def hashed(x):
        words = [] if short_words is None else [word_count(x["s"]).alias("words")]
        return F.struct(F.xxhash64(x["s"]).alias("a"), F.xxhash64(F.lit(1), x["s"]).alias("b"), *words)

    positions = let(F.transform(_content(_lines("text")), hashed), lambda h: _positions(h, run_lines, short_words))
    rows = docs.select("doc_id", F.xxhash64("text").alias("version"), F.explode(positions).alias("position"))
    return rows.select("doc_id", "version", "position.*")


def repeated_runs(docs: DataFrame, run_lines: int = RUN_LINES, short_words: int | None = SHORT_WORDS) -> DataFrame:
    """(doc_id, version, runs): (start, lines) where a run repeats an earlier one, counted in lines with words.

    Earlier is by doc_id (null last), then text hash, then place. Equal rows share their places. Of runs that start
    at the same place the longest is given.
    """
    positions = stored(_fingerprints(docs, run_lines, short_words), "line-positions")
    recurring = positions.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    met = positions.join(recurring, "fingerprint", "left_semi")
    candidates = stored(met.select("doc_id", "version", F.inline("runs")), "line-runs")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "version", "start")
    same = ["lines", "a", "b"]
    first = candidates.groupBy(*same).agg(F.min(place).alias("first"), F.max(place).alias("final"))
    first = first.filter("first != final").select(*same, "first")
    later = candidates.join(first, same).filter(place > F.col("first"))
    places = later.groupBy("doc_id", "version").agg(F.sort_array(F.collect_set(F.struct("start", "lines"))).alias("runs"))
    return places.withColumn("runs", let(F.col("runs"), _longest))


def _longest(runs: Column) -> Column:
    """Of sorted (start, lines) the last of each start."""
    return F.filter(runs, lambda r, j: F.coalesce(F.get(runs, j + 1)["start"] != r["start"], F.lit(True)))


def line_dedup(docs: DataFrame, run_lines: int = RUN_LINES, short_words: int | None = SHORT_WORDS) -> DataFrame:
    """Documents with later repeated runs deleted: (doc_id, text, n_lines, n_removed).

    ``text`` is the text without the deleted lines; blank lines inside a deleted run go with it and do not count.
    ``n_lines`` counts lines with words. Null text stays null with no lines; an empty or blank text stays as it is;
    later repeated runs of fewer than ``run_lines`` lines go as well if they have ``short_words`` words (None: never). Repeated rows get the same answer, and an empty table gives
    an empty result. A document whose lines all went keeps an empty text.
    """
    return _cleaned(docs.select("doc_id", "text"), run_lines, short_words).select("doc_id", "text", "n_lines", "n_removed")


def deduplicated(docs: DataFrame, run_lines: int = RUN_LINES, short_words: int | None = SHORT_WORDS) -> DataFrame:
    """The rows of ``docs`` with later repeated runs deleted from ``text`` and ``n_chars`` counted anew.

    A document whose lines with words all went is a repetition and goes; others keep all their columns.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in rest]).alias("_rest")) if rest else docs
    kept = _cleaned(packed, run_lines, short_words).filter((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    columns = {"doc_id": F.col("doc_id"), "text": F.col("text")} | {c: F.col(f"_rest.`{c}`") for c in rest}
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        columns["n_chars"] = F.when(F.col("n_removed") == 0, columns["n_chars"]).otherwise(F.length("text")).cast(kind)
    return kept.select(*[columns[c].alias(c) for c in docs.columns])


def _cleaned(docs: DataFrame, run_lines: int, short_words: int | None) -> DataFrame:
    """The columns of ``docs`` (doc_id, text and at most _rest) with the text cleaned, n_lines and n_removed."""
    extra = [c for c in docs.columns if c == "_rest"]
    gone = repeated_runs(docs, run_lines, short_words).select(F.xxhash64("doc_id").alias("key"), "version", "runs")
    rows = docs.select("doc_id", "text", *extra, F.xxhash64("doc_id").alias("key"), F.xxhash64("text").alias("version"))
    joined = rows.join(gone, ["key", "version"], "left")
    runs = F.col("runs")
    n_gone = F.size("runs")

    def end(j):
        return F.get(runs, j)["start"] + F.get(runs, j)["lines"]

    def reached(j):  # lines up to the end of the runs before this one; starts differ, so older runs end earlier
        return F.greatest(F.lit(0), *[end(j - i) for i in range(1, run_lines + 1)])

    def kept(lines, raw):
        def gap(j):
            begin = F.when(j == 0, 0).otherwise(F.get(raw, reached(j) - 1) + 1)
            end = F.when(j == n_gone, F.size(lines)).otherwise(F.get(raw, F.get(runs, j)["start"]))
            return F.slice(lines, begin + 1, F.greatest(F.lit(0), end - begin))

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n_gone), gap)), "\n")

    def fresh(run, j):  # lines that this run adds to those deleted before it
        return F.greatest(F.lit(0), end(j) - F.greatest(run["start"], reached(j)))

    def answer(lines):
        raw = F.transform(_content(lines), lambda x: x["raw"])
        return let(
            raw, lambda r: F.struct(F.size(r).cast("long").alias("n_lines"), F.when(runs.isNotNull(), kept(lines, r)).alias("kept"))
        )

    removed = F.aggregate(F.transform(runs, fresh), F.lit(0), lambda total, x: total + x)
    answered = joined.select("doc_id", "text", *extra, "runs", let(_lines("text"), answer).alias("answer"), removed.alias("removed"))
    return answered.select(
        "doc_id",
        F.when(F.col("runs").isNull(), F.col("text")).otherwise(F.col("answer.kept")).alias("text"),
        *extra,
        F.col("answer.n_lines").alias("n_lines"),
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
    )

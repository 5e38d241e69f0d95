"""Statistics against plain Python, rules from a printed tree, held-out accuracy, and hard rows."""

import re
import zlib

import pytest
from pyspark.sql import functions as F

from assaylake.llm.rule_ensemble import (
    Condition,
    RuleEnsemble,
    held_out,
    merged,
    paths,
    quality_scores,
    rule_column,
    statistics,
    without_complements,
)
from tests.llm.helpers import WORD, hard_rows, prose, rows, table

TREE = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5, numClasses=2, numFeatures=3
  If (feature 2 <= 0.5)
   Predict: 0.0
  Else (feature 2 > 0.5)
   If (feature 0 <= 1.0E-5)
    Predict: 1.0
   Else (feature 0 > 1.0E-5)
    If (feature 2 <= 0.75)
     Predict: 1.0
    Else (feature 2 > 0.75)
     Predict: 0.0
"""


def test_paths_of_a_tree():
    a, c = (lambda above, t: Condition("a", above, t)), (lambda above, t: Condition("c", above, t))
    assert paths(TREE, ["a", "b", "c"]) == {
        (c(False, 0.5),), (c(True, 0.5),), (a(False, 1e-5), c(True, 0.5)), (a(True, 1e-5), c(True, 0.5)),
        (a(True, 1e-5), c(False, 0.75), c(True, 0.5)), (a(True, 1e-5), c(True, 0.75)),
    }
    assert merged([c(False, 3.0), c(False, 2.0), c(True, 0.0), c(True, 1.0)]) == (c(False, 2.0), c(True, 1.0))
    assert without_complements([(c(False, 0.5),), (c(True, 0.5),), (a(True, 1.0), c(True, 0.5))]) == [(c(False, 0.5),), (a(True, 1.0), c(True, 0.5))]


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if x.strip(" ")]
    over = lambda a, b: a / max(b, 1)
    return {
        "words": len(words), "chars": len(text), "mean_word": over(sum(map(len, words)), len(words)), "words_a_line": over(len(words), len(lines)),
        "distinct_words": over(len(set(words)), len(words)), "distinct_by_root": over(len(set(words)), len(words) ** 0.5), "distinct_lines": over(len(set(lines)), len(lines)),
        "symbols": over(len(re.findall(r"[#*$%&|<>=_~^@\\+{}\[\]]", text)), len(text)), "marks": over(len(re.findall("[.,;:]", text)), len(text)),
        "calls": over(len(re.findall("[!?]", text)), len(text)), "capitals": over(sum(c.isupper() and c.isalpha() for c in text), len(text)), "digits": over(sum(c.isdecimal() for c in text), len(text)),
    }


def test_statistics_are_those_of_plain_python(spark):
    texts = [r[1] for r in hard_rows()] + ["ÄB c! d? ١2", "a a a\nb\nb\n \n", "x" * 100_000]
    got = table(spark, rows(*texts)).select("text", *[c.alias(n) for n, c in statistics(F.col("text")).items()]).collect()
    assert len(got) == len(texts)
    for r in got:
        for name, value in plain(r["text"]).items():
            assert r[name] == pytest.approx(value), (name, (r["text"] or "")[:40])


def test_rules_become_one_expression(spark):
    rule = (Condition("a", True, 1.0), Condition("b", False, 2.0))
    ensemble = RuleEnsemble(-1.0, ((rule, 2.0),))
    got = spark.createDataFrame([(2.0, 2.0), (1.0, 0.0)], "a double, b double").select(rule_column(rule).alias("met"), ensemble.score().alias("p")).collect()
    assert [r["met"] for r in got] == [True, False]
    assert [r["p"] for r in got] == pytest.approx([0.7310585786300049, 0.2689414213699951])


def marked(spark, count):
    bad = [lambda t: t.upper().replace(" ", "!! "), lambda t: re.sub(r"\S+", lambda m: m[0] + "###", t), lambda t: (t.split()[0] + " ") * 150]
    texts = [prose(i, 40 + i % 200) if i % 4 else bad[i // 4 % 3](prose(i, 40 + i % 200)) for i in range(count)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0, "x") for i in range(count)], "doc_id long, quality int, toxic int, text string")
    return table(spark, rows(*texts)), labels


def test_held_out_accuracy(spark):
    docs, labels = marked(spark, 400)
    # Labels of held-out rows are turned round: a model that saw them would suffer, and the score must not follow them.
    seen = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    got = {r["doc_id"]: r for r in quality_scores(docs, seen).collect()}
    assert len(got) == 400
    assert {i for i, r in got.items() if r["held_out"]} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values())
    right = [r["predicted"] == (i % 4 > 0) for i, r in got.items() if r["held_out"]]
    assert sum(right) / len(right) >= 0.97


def test_labels_lang_and_source_are_no_input(spark):
    docs, labels = marked(spark, 200)
    one = {r["doc_id"]: r["score"] for r in quality_scores(docs, labels).collect()}
    other = docs.withColumns({"lang": F.lit("zz"), "source": F.col("doc_id").cast("string"), "quality": F.lit(0)})
    assert {r["doc_id"]: r["score"] for r in quality_scores(other, labels).collect()} == pytest.approx(one)


def test_hard_rows_and_missing_classes(spark, hard, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (20, 1), (30, 0), (31, 1), (99, 1), (None, 0)], "doc_id long, quality int")
    assert len(quality_scores(hard, labels).collect()) == len(hard_rows())
    none = quality_scores(hard, labels.filter("false")).collect()
    assert {r["score"] for r in none} == {0.5}
    assert all(r["score"] > 0.99 for r in quality_scores(hard, labels.filter("quality = 1")).collect())
    assert all(r["score"] < 0.01 for r in quality_scores(hard, labels.filter("quality = 0")).collect())
    assert quality_scores(nothing, labels).collect() == []

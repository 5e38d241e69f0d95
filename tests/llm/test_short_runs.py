"""Later repeated runs of one or two lines with many words, against brute force."""

import random

import pytest

from assaylake.llm.line_dedup import _fingerprints, deduplicated, line_dedup
from tests.llm.helpers import WORD, hard_rows, rows, table

SPACES = " \t\n\x0b\x0c\r"


def brute(found, words=50):
    """doc_id -> text and number of deleted lines: runs of three lines, and of one or two with so many words."""
    seen, out = {}, {}
    for doc_id, text, *_ in found:
        lines = text.split("\n")
        content = [i for i, x in enumerate(lines) if x.strip(SPACES)]
        gone = set()
        for size in (1, 2, 3):
            for k in range(len(content) - size + 1):
                run = tuple(lines[i].strip(SPACES) for i in content[k : k + size])
                if size == 3 or sum(len(WORD.findall(x)) for x in run) >= words:
                    if seen.setdefault(run, (doc_id, k)) != (doc_id, k):
                        gone.update(range(content[k], content[k + size - 1] + 1))
        out[doc_id] = "\n".join(x for i, x in enumerate(lines) if i not in gone), sum(i in gone for i in content)
    return out


def line(seed, words):
    return " ".join(f"w{seed}x{i}" for i in range(words))


def test_a_repeated_line_of_fifty_words_goes(spark):
    texts = [line(1, 50), line(2, 49), line(1, 50), line(2, 49), f"a\n {line(1, 50)} \n\nb", f"{line(3, 25)}\n{line(4, 25)}", f"c\n{line(3, 25)}\n\n{line(4, 25)}\nd"]
    found = rows(*texts)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup(table(spark, found)).collect()}
    assert got == brute(found)
    assert got[2] == ("", 1) and got[3] == (texts[3], 0) and got[4] == ("a\n\nb", 1) and got[6] == ("c\nd", 2)


def test_the_pipeline_stage_drops_long_copies_of_one_line(spark):
    kept = deduplicated(table(spark, rows(line(1, 60), line(2, 9), line(1, 60), f"a\n{line(1, 60)}", line(2, 9))))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in kept.collect() if r["doc_id"] != 0} == {1: (line(2, 9), len(line(2, 9))), 3: ("a", 1), 4: (line(2, 9), len(line(2, 9)))}


@pytest.mark.parametrize("seed", [1, 2])
def test_runs_of_all_lengths_match_brute_force(spark, seed):
    pick = random.Random(seed)
    lines = [line(i, n) for i, n in enumerate([1, 2, 20, 24, 26, 30, 49, 50, 70, 90])] + ["", "  "]
    found = rows(*["\n".join(pick.choice(lines) for _ in range(pick.randint(1, 9))) for _ in range(80)])
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in line_dedup(table(spark, found)).collect()}
    assert got == brute(found)


def test_hard_rows_keep_their_number(spark, hard, nothing):
    assert len(line_dedup(hard).collect()) == len(hard_rows())
    assert line_dedup(nothing).collect() == []


def test_each_position_is_stored_once_with_the_runs_that_selected_it(spark):
    """Window minima: fewer positions than runs, no run lost, and every run holds the position that carries it."""
    found = rows("\n".join(f"line {i * 7919 % 101}" for i in range(60)), "one\ntwo")
    got = _fingerprints(table(spark, found), 3, 50).collect()
    starts = sorted(run["start"] for r in got for run in r["runs"])
    assert starts == list(range(58)) and len(got) < 45 and {r["doc_id"] for r in got} == {0}
    for r in got:
        own = [run["start"] for run in r["runs"]]
        assert own == list(range(own[0], own[0] + len(own))) and len(own) <= 3

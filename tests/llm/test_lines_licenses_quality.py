"""Line dedup, licence scan and quality rules against brute force."""

from collections import Counter

from assaylake.llm.license_scan import TEMPLATES, bigrams, license_scan, size_bounds
from assaylake.llm.line_dedup import RUN_LINES, deduplicated, line_dedup
from assaylake.llm.quality_rules import beta_prior, keep_good, measure, quality_rules, repeated_words
from tests.llm.helpers import WORD, hard_rows, prose, rows, table

SPACES = " \t\n\x0b\x0c\r"


def brute_lines(found, t=RUN_LINES):
    """(doc_id, text) -> text without later repeated runs; documents in order of doc_id."""
    seen, out = {}, {}
    for doc_id, text in sorted({(r[0], r[1]) for r in found if r[0] is not None and r[1] is not None}):
        lines = text.split("\n")
        content = [i for i, x in enumerate(lines) if x.strip(SPACES)]
        gone = set()
        for k in range(len(content) - t + 1):
            run = tuple(lines[i].strip(SPACES) for i in content[k : k + t])
            if seen.setdefault(run, (doc_id, k)) != (doc_id, k):
                gone.update(range(content[k], content[k + t - 1] + 1))
        out[doc_id, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone), sum(i in gone for i in content)
    return out


def line_cases():
    block = "alpha one\nbeta two\ngamma three\ndelta four"
    texts = [
        block, f"start\n{block}\nend", "beta two\ngamma three", f"  beta two\n\n gamma three \ndelta four\nmore",
        "x\nx\nx\nx\nx\nx\ny", "x\nx\nx", block + "\n" + block, "\n\n\n\n", "a\nb\nc\nd\ne", "z\nb\nc\nd\ny\na\nb\nc", block,
    ]
    return rows(*texts)


def test_later_runs_of_lines_go(spark):
    found = line_cases()
    want = brute_lines(found)
    for r in line_dedup(table(spark, found)).collect():
        text = dict((x[0], x[1]) for x in found)[r["doc_id"]]
        assert (r["text"], r["n_removed"]) == want[r["doc_id"], text], r["doc_id"]


def test_hard_lines(spark, hard, nothing):
    out = line_dedup(hard).collect()
    assert len(out) == len(hard_rows())
    assert [r["text"] for r in out if r["doc_id"] == 4] == [None]
    assert line_dedup(nothing).collect() == [] and deduplicated(nothing).collect() == []
    kept = deduplicated(hard)
    assert kept.columns == hard.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[30] == 3 and ids[3] == 1 and ids[8] == 0 and ids[1] == 1


def test_licences_are_found_in_lines_paragraphs_and_texts(spark, hard, nothing):
    mit = TEMPLATES[0][1]
    cut = mit.find("subject to")
    texts = ["x\nReleased under the MIT license!\ny", mit, f"Intro\n\n{mit[:cut]}\n{mit[cut:]}\n\nOutro", "licensed under\nthe", "Licensed under CC BY-NC 4.0."]
    got = {(r["doc_id"], r["license_id"]): (r["dice"], r["n_units"]) for r in license_scan(table(spark, rows(*texts))).collect()}
    assert got == {(0, "MIT"): (1.0, 2), (1, "MIT"): (1.0, 1), (2, "MIT"): (1.0, 3), (4, "CC-BY-NC-4.0"): (1.0, 1)}
    assert license_scan(hard).collect() == [] and license_scan(nothing).collect() == []


def test_dice_against_all_templates(spark):
    lines = ["Licensed under the MIT License now", "this work is licensed under the gnu general public license version 2", "under the", "Released under the MIT License " * 3]
    want = set()
    for i, line in enumerate(lines):
        own = bigrams(line)
        scored = [(2 * len(set(own) & set(bigrams(t))) / (len(own) + len(bigrams(t))), name) for name, t in TEMPLATES]
        best = min((-s, n) for s, n in scored)
        if -best[0] >= 0.8:
            want.add((i, best[1], -best[0]))
    assert {(r["doc_id"], r["license_id"], r["dice"]) for r in license_scan(table(spark, rows(*lines))).collect()} == want
    assert size_bounds(4, 0.8) == (3, 6)


def brute_repeats(words):
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    return len({i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(5)})


def test_repeated_words_match_brute_force():
    import random

    for seed in range(60):
        pick = random.Random(seed)
        words = [pick.choice("abc") if seed % 3 else pick.choice("ab") for _ in range(pick.randint(0, 60))]
        assert repeated_words(words) == brute_repeats(words)


def test_measures_and_base_rules(spark, hard, nothing):
    for text in [r[1] or "" for r in hard_rows()]:
        words = WORD.findall(text)
        lines = text.split("\n")
        dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
        assert measure(text) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, brute_repeats(words))
    out = quality_rules(hard).collect()
    assert len(out) == len(hard_rows())
    for r in out:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules(nothing).collect() == [] and keep_good(nothing).collect() == []
    assert keep_good(hard).columns == hard.columns
    assert {r["_id"] for r in keep_good(hard).collect()} == {"x_id"}


def test_bad_hosts_are_stricter_and_small_ones_lean_on_the_rest(spark):
    good, loose = [prose(i, 60) for i in range(60)], "# " * 4 + prose(99, 60)
    bad = ["# " * 9 + prose(200 + i, 60) for i in range(40)]
    found = [(i, t, "en", "good", 0) for i, t in enumerate(good)] + [(100 + i, t, "en", "bad", 0) for i, t in enumerate(bad)]
    found += [(200, loose, "en", "bad", 0), (201, loose, "en", "good", 0), (202, prose(7, 60), "en", "bad", 0), (203, bad[0], "en", "tiny", 0)]
    found += [(300 + i, prose(300 + i, 60), "en", f"host{i % 30}", 0) for i in range(120)]
    kept = {r["doc_id"]: r["kept"] for r in quality_rules(table(spark, found)).collect()}
    assert not kept[200] and kept[201] and kept[202] and kept[203]
    assert all(kept[i] for i in range(60))


def test_prior():
    assert beta_prior(0, 0, 0.0, 0, 0.0, 0.0) == (0.5, 2.0)
    mean, strength = beta_prior(1, 100, 0.01, 10, 0.1, 0.01)
    assert abs(mean - 11 / 102) < 1e-12 and strength == 100

"""Hot phrases shorter than a string, followed by different text."""

import numpy as np
import pyarrow as pa
import pytest

from assaylake.llm import suffix_dedup as sd
from tests.llm.helpers import prose, rows, table
from tests.llm.test_passages_classes_fingerprints_mix import brute_removed, removed

PHRASE = "the very same forty-five bytes stand in each, "


def hot_rows(n):
    return rows(*[f"{prose(i, 3)} {PHRASE}{prose(5000 + i % (n - 5), 12)}" for i in range(n)])


def texts_of(found):
    return sd.Texts(pa.table({"doc_id": [r[0] for r in found], "text": [r[1] for r in found]}))


def test_strings_behind_a_hot_phrase_are_spread_over_ranges():
    texts = texts_of(hot_rows(300))
    sent = texts.suffixes(np.full(len(texts.asked_keys()[0]), sd.HOT, np.uint8))
    assert not len(sent["around"]) and (sent["bits"] == 1).all()
    ranges = 16
    to = sd.digest_ranges(sent["digest"], ranges)
    strings = [texts.data[p : p + sd.LENGTH].tobytes() for p in sent["place"].tolist()]
    grams, group, counts = np.unique([s[: sd.GRAM] for s in strings], return_inverse=True, return_counts=True)
    hottest = -1 - to[group == counts.argmax()]
    assert counts.max() >= 290 and np.bincount(hottest, minlength=ranges).max() < 0.2 * len(hottest)
    assert np.bincount(-1 - to, minlength=ranges).max() < 0.1 * len(to)
    meets = {}
    assert all(meets.setdefault(s, (t, bytes(d))) == (t, bytes(d)) for s, t, d in zip(strings, to.tolist(), sent["digest"]))
    assert len({d for _, d in meets.values()}) == len(meets)


def test_keys_count_different_surroundings_only():
    """A text that many documents copy sends its suffixes once; a phrase before different text sends one per document."""
    copies, phrases = texts_of(rows(*[prose(1, 40)] * 50)), texts_of(hot_rows(50))
    _, counts = copies.asked_keys()
    assert (counts >= sd.SEVERAL).all() and ((counts & ~sd.SEVERAL) <= 3).all()  # ends differ by the next document
    _, counts = phrases.asked_keys()
    assert (counts & ~sd.SEVERAL).max() >= 45


@pytest.mark.parametrize("most", [1, 20, 10**9])
def test_a_hot_phrase_matches_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(sd, "MOST_SUFFIXES", most)
    monkeypatch.setattr(sd, "GROUP_TEXT", 2_000)
    monkeypatch.setattr(sd, "SORTED_TEXT", 1_000)
    found = hot_rows(60)
    assert removed(table(spark, found)) == brute_removed(found)

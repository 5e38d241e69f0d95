"""Ranked search against brute force: ties, repeats, small trees, many blocks, and what is pruned."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from assaylake.llm import dual_tree_search as dual
from assaylake.llm.dual_tree_search import DocumentTree, Search, Stats, item_blocks, ranked_search, terms_of
from tests.llm.helpers import hard_rows, prose, rows, table

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def split(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(found, items, top=10):
    """Sorted (item_id, rank, doc_id, score)."""
    docs = [(r[0], Counter(split(r[1]))) for r in found]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total, length = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in docs:
            m = 100 - 90 + (90 * n * total) // length
            w = lambda t: math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
            score = sum(w(t) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(split(text)) if c[t])
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id))
        out += [(item_id, k, doc_id, -score) for k, (score, _, doc_id) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


def asked(spark, items):
    return spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, doc_id string")


def test_terms_are_those_of_the_pattern(monkeypatch):
    monkeypatch.setattr(dual, "PIECE", 7)
    for text in ["", "A-b  C9", "ÄÖ x\x00y éÉ,日本 z_z", "a" * 50 + " b", *[r[1] for r in hard_rows() if r[1]][1:4]]:
        assert [t.decode() for part in terms_of(text.encode()) for t in part] == split(text)


def test_hard_rows(spark, hard, nothing):
    items = [(1, prose(2, 30)), (2, None), (3, ""), (4, "word two Ö é"), (5, prose(1, 500)), (5, prose(3, 10)), (None, prose(5, 9)), (7, "nowhere-at-all9")]
    assert answers(ranked_search(hard, asked(spark, items))) == brute(hard_rows(), items)
    assert answers(ranked_search(nothing, asked(spark, items))) == []
    assert answers(ranked_search(hard, asked(spark, []))) == []


def corpus(count, seed):
    """Two vocabularies, many ties (equal texts), a few documents that hold an item."""
    pick = random.Random(seed)
    words = [[f"{a}{i}" for i in range(60)] for a in "xy"]
    weights = [1 / (i + 1) for i in range(60)]
    made = lambda n: " ".join(pick.choices(words[pick.randrange(2)], weights, k=n))
    texts = [made(pick.randint(0, 60)) for _ in range(count)]
    texts += [pick.choice(texts) for _ in range(count // 3)]
    items = [(i, pick.choice(texts) if i % 3 else made(12)) for i in range(25)]
    return rows(*texts), items


@pytest.mark.parametrize("seed", [1, 2])
def test_many_trees_and_blocks(spark, seed, monkeypatch):
    found, items = corpus(700, seed)
    docs = table(spark, found).repartition(7)
    assert len(list(item_blocks(asked(spark, items), 400))) > 3
    assert answers(ranked_search(docs, asked(spark, items))) == brute(found, items)
    assert answers(ranked_search(docs, asked(spark, items), top=3, block_bytes=400)) == brute(found, items, 3)


def tree_of(found, terms, monkeypatch):
    """One tree and its numbers, without Spark."""
    import pyarrow as pa

    numbers = {t.encode(): k for k, t in enumerate(terms)}
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in found]), pa.array([r[1] for r in found])], names=["doc_id", "text"])
    made = [b.to_pylist()[0] for b in dual._vectors(numbers)([batch])]
    return made[:-1], made[-1]


def test_bounds_hold_and_prune(monkeypatch):
    found, items = corpus(900, 5)
    terms = sorted({t for _, text in items for t in split(text)})
    trees, last = tree_of(found, terms, monkeypatch)
    number = {t: k for k, t in enumerate(terms)}
    item_terms = [np.array(sorted({number[t] for t in split(text)}), np.int64) for _, text in items]
    stats = Stats(item_terms, len(terms), last["docs"], last["length"], {h["term"]: h["n"] for h in last["holders"]})
    tree = DocumentTree(trees[0], stats)
    scored = Counter()
    plain = DocumentTree.scores
    monkeypatch.setattr(DocumentTree, "scores", lambda self, docs, w: (scored.update(n=len(docs)), plain(self, docs, w))[1])
    search = Search(stats, np.zeros(len(stats.items), np.int64), 5)
    search.add(tree)
    first = scored["n"]
    every = len(tree.ids) * len(stats.items)
    assert first < every  # whole pairs of nodes were left out
    again = Search(stats, search.least, 5)
    again.add(tree)
    assert scored["n"] - first < first and again.best == search.best  # less still with k-th scores known before
    for item, (_, of) in enumerate(stats.items):
        weights = np.zeros(len(terms), np.int64)
        weights[of] = stats.weights[of]
        exact = plain(tree, np.arange(len(tree.ids)), weights)
        leaf = tree.levels[-1].bounds(of, stats.weights[of])
        assert (exact <= leaf[np.arange(len(tree.ids)) // dual.LEAF]).all()
        want = sorted(zip((-exact[exact > 0]).tolist(), tree.known[exact > 0].tolist(), tree.ids[exact > 0].tolist()))[:5]
        assert search.best[item] == want

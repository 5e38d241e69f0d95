"""Suffix dedup, n-gram join, fingerprints, mixing and the pipeline against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from assaylake.llm import suffix_dedup as sd
from assaylake.llm.components import components
from assaylake.llm.fingerprints import LEAST, MOST, chunk_ends, chunks, containment, document_fingerprints, fingerprint, gear_hash
from assaylake.llm.mixing import mix_sources, mixed
from assaylake.llm.ngram_join import ngram_classes, one_of_each, trie_links
from tests.llm.helpers import WORD, hard_rows, prose, rows, table


def brute_removed(found, n=50):
    first = {}
    for doc_id, text, *_ in found:
        data = (text or "").encode()
        key = float("inf") if doc_id is None else doc_id
        for i in range(len(data) - n + 1):
            s = data[i : i + n]
            first[s] = min(first.get(s, key), key)
    out = []
    for doc_id, text, *_ in found:
        data = (text or "").encode()
        key = float("inf") if doc_id is None else doc_id
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - n + 1):
            if first[data[i : i + n]] < key:
                gone[i : i + n] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), int(gone.sum()), spans, kept))
    return Counter(out)


def passage_rows(seed, docs=40):
    pick = random.Random(seed)
    shared = [prose(1000 + i, 20) for i in range(5)] + ["é" * 40, "ab" * 60, "a" * 120, "same " * 30]
    texts = []
    for i in range(docs):
        parts = [prose(seed * 100 + i, pick.randint(1, 40))]
        for _ in range(pick.randint(0, 3)):
            piece = pick.choice(shared)
            begin = pick.randint(0, len(piece) // 3)
            parts.append(piece[begin : begin + pick.randint(20, 90)])
        pick.shuffle(parts)
        texts.append(pick.choice(["", " "]).join(parts))
    return rows(*texts, texts[0], texts[1][:80], texts[2] + "!")


def removed(df):
    return Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in sd.suffix_dedup(df).collect())


@pytest.mark.parametrize("hot", [200, 1])
def test_repeated_bytes_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)  # with 1, the strings of every shared gram go apart
    monkeypatch.setattr(sd, "GROUP_TEXT", 2_000)  # many buckets, ranges and splitters
    found = passage_rows(hot)
    assert removed(table(spark, found)) == brute_removed(found)


def test_passages_of_hard_rows(spark, hard, nothing):
    assert removed(hard) == brute_removed(hard_rows())
    assert sd.suffix_dedup(nothing).collect() == []


def test_multikey_order_and_prefixes():
    pick = np.random.default_rng(1)
    data = pick.integers(97, 99, (500, 21)).astype(np.uint8)
    data[::7] = data[0]
    order = sd.multikey_order(data)
    ordered = [data[i].tobytes() for i in order]
    assert ordered == sorted(ordered)
    shared = sd.common_prefixes(data, order)
    for k in range(1, 500):
        a, b = ordered[k - 1], ordered[k]
        assert shared[k] == next((i for i in range(21) if a[i] != b[i]), 21)


def shingles(text, n):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def brute_classes(sets, percent):
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                shared = len(sets[i] & sets[j])
                if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                    parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(sets))]


def edited(text, seed):
    pick, words = random.Random(seed), text.split(" ")
    for _ in range(pick.randint(0, 1 + len(words) // 40)):
        at = pick.randrange(len(words))
        words[at : at + 1] = pick.choice([[], ["new"], [words[at], "more"]])
    return " ".join(words)


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_classes_match_brute_force(spark, words, percent):
    base = [prose(i, 10 + 15 * i) for i in range(12)]
    texts = [edited(base[i % 12], i) for i in range(150)] + ["a b", "A b", "a", "", None, "x y z", "x y z w"]
    texts += [f"{base[7][:300]} {prose(500 + i, 60)}" for i in range(20)]  # a shared passage links nothing by itself
    found = rows(*texts)
    want = brute_classes([shingles(t, words) for t in texts], percent)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_classes(table(spark, found), words, percent).collect()}
    assert got == {i: (len(shingles(t, words)), want[i]) for i, t in enumerate(texts)}
    kept = sorted(r["doc_id"] for r in one_of_each(table(spark, found), words, percent).collect())
    assert kept == sorted(set(want))


def test_large_groups_meet_block_by_block(spark, monkeypatch):
    from assaylake.llm import ngram_join

    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 7)
    base = prose(3, 90)
    texts = [edited(base, i) for i in range(60)] + [base]
    want = brute_classes([shingles(t, 4) for t in texts], 85)
    got = {r["doc_id"]: r["component_id"] for r in ngram_classes(table(spark, rows(*texts))).collect()}
    assert got == dict(enumerate(want))


def test_trie_finds_every_class():
    for seed in range(40):
        pick = random.Random(seed)
        base = [frozenset(pick.sample(range(200), pick.randint(1, 40))) for _ in range(5)]
        sets = []
        for _ in range(60):
            s = set(pick.choice(base))
            for _ in range(pick.randint(0, 3)):
                s ^= {pick.randrange(200)}
            sets.append(frozenset(s or {1}))
        sets = list(dict.fromkeys(sets))
        links = trie_links([np.array(sorted(s), np.uint64) for s in sets], None, 85)
        parent = list(range(len(sets)))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            shared = len(sets[a] & sets[b])
            assert 100 * shared >= 85 * (len(sets[a]) + len(sets[b]) - shared)
            parent[max(find(a), find(b))] = min(find(a), find(b))
        assert [find(i) for i in range(len(sets))] == brute_classes(sets, 85)


def test_classes_of_hard_rows(spark, hard, nothing):
    got = ngram_classes(hard).collect()
    assert len(got) == len(hard_rows())
    by = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert by[8] == 1 and by[9] == 0 and by[2] == 2 and by[4] == 4 and by[30] == 30
    kept = one_of_each(hard, 5, 80)
    assert kept.columns == hard.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[30] == 1 and ids[8] == 0 and ids[9] == 0 and ids[1] == 1 and ids[None] == 2 and ids[31] == 2
    assert ngram_classes(nothing).collect() == [] and one_of_each(nothing, 5, 80).collect() == []


def test_components_of_chains_and_stars(spark):
    edges = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)] + [("s000", f"s{i:03d}") for i in range(1, 50)] + [("x", "x"), ("z", "y")]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {k: v for k, v in got.items() if k[0] == "c"} == {f"c{i:03d}": "c000" for i in range(61)}
    assert all(v == "s000" for k, v in got.items() if k[0] == "s") and got["z"] == "y"


def test_gear_hash_and_chunks():
    data = prose(1, 2000).encode()
    h = gear_hash(data)
    from assaylake.llm.fingerprints import _GEAR

    for i in (0, 5, 31, 32, 500):
        want = sum(int(_GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) & 0xFFFFFFFF
        assert int(h[i]) == want
    ends = chunk_ends(data)
    sizes = [b - a for a, b in zip([0, *ends], ends)]
    assert ends[-1] == len(data) and all(LEAST <= s <= MOST for s in sizes[:-1])
    assert 30 < sum(sizes) / len(sizes) < 130
    shifted = chunks(b"some words before " + data)
    assert containment(chunks(data), shifted) > 0.97
    assert chunk_ends(b"") == [] and fingerprint({}) == "" and containment({}, {}) == 1.0 and containment({}, {"a": 1}) == 0.0


def brute_fingerprints(found):
    import xxhash  # noqa: F401

    order = sorted(found, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = Counter()
    for i, r in enumerate(order):
        text, after = r[1] or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 3
        changed = text[: len(text) - cut] + after[:cut]
        a, b, c = chunks(text.encode()), chunks(changed.encode()), chunks(after.encode())
        out[r[0], len(text), hashlib.sha256(changed.encode()).hexdigest(), fingerprint(a), fingerprint(b), containment(a, b), containment(a, c)] += 1
    return out


def test_fingerprints(spark, hard, nothing, monkeypatch):
    from assaylake.llm import fingerprints

    monkeypatch.setattr(fingerprints, "GROUP_BYTES", 900)  # many blocks
    found = rows(*[prose(i, 1 + 7 * i % 90) for i in range(80)], None, "", "x")
    random.Random(1).shuffle(found)
    got = Counter(tuple(r) for r in document_fingerprints(table(spark, found).repartition(5)).collect())
    assert got == brute_fingerprints(found)
    lone = [r for r in hard_rows() if r[0] not in (None, 31)]
    assert len(document_fingerprints(hard).collect()) == len(hard_rows())
    assert Counter(tuple(r) for r in document_fingerprints(table(spark, lone)).collect()) == brute_fingerprints(lone)
    assert document_fingerprints(nothing).collect() == []
    one = document_fingerprints(table(spark, rows(prose(1, 50)))).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, excess, full = {s: 0.0 for s in order}, 1.5 * sum(sizes.values()), set()
    while excess > 1e-9 and len(full) < len(order):
        total = sum(weight[s] for s in order if s not in full)
        for s in order:
            if s not in full:
                target[s] += excess * weight[s] / total
        excess = 0.0
        for s in order:
            if s not in full and target[s] > 2 * sizes[s]:
                excess += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                full.add(s)
    return target


def test_mix_meets_targets_and_agrees_with_itself(spark):
    pick = random.Random(4)
    source = lambda i: None if i % 17 == 0 else f"s{min(i % 13, i % 7)}"
    texts = [prose(i, pick.randint(1, 80)) if i % 19 else pick.choice([None, "", " "]) for i in range(900)]
    found = rows(*texts, source=source)
    got = mix_sources(table(spark, found)).collect()
    size = {r[0]: len(WORD.findall(r[1] or "")) for r in found}
    of = {r[0]: r[3] for r in found}
    sizes = Counter()
    for i, n in size.items():
        sizes[of[i]] += n
    want, taken = brute_targets(sizes), Counter()
    assert {r["doc_id"]: r["size"] for r in got} == size
    for r in got:
        assert r["source_size"] == sizes[of[r["doc_id"]]] and abs(r["target"] - want[of[r["doc_id"]]]) < 1e-6
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        taken[of[r["doc_id"]]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 80 for s in sizes)  # by less than one document
    again = mix_sources(table(spark, found[::-1]).repartition(5)).collect()
    assert {(r["doc_id"], r["taken"]) for r in again} == {(r["doc_id"], r["taken"]) for r in got}


def test_mix_is_unbiased(spark):
    """Over many sources alike but for their ids, a document of either size is taken as often as its rate says."""
    found = [(i, "w " * (1 if i % 2 else 9), "en", f"s{i // 4:04d}", 0) for i in range(4800)]
    by = defaultdict(list)
    for r in mix_sources(table(spark, found)).collect():
        if r["target"] < 2 * r["source_size"]:
            by[r["size"], round(r["target"] / r["source_size"], 6)].append(r["copies"])
    for (_, rate), copies in by.items():
        assert abs(sum(copies) / len(copies) - rate) < 0.06


def test_mixed_rows(spark, hard, nothing):
    picks = mix_sources(hard).collect()
    assert len(picks) == len(hard_rows())
    kept = mixed(hard)
    assert kept.columns == hard.columns
    want = Counter()
    for r in picks:
        want[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in kept.collect()) == +want
    assert mix_sources(nothing).collect() == [] and mixed(nothing).collect() == []


def test_pipeline_stages_hold_on_hard_rows(spark, hard, nothing):
    import corpus_pipeline

    for docs in (hard, nothing):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, "")
            if name != "pack":
                assert docs.columns == columns
                assert all(r["_id"] == "x_id" and r["raw"] == "xraw" for r in docs.collect() if "_id" in columns)
        docs.collect()


def test_pipeline_against_brute_force(spark, tmp_path):
    """Quality and lines by their brute force, classes by comparison of all pairs; then counts of the mix and the packing."""
    import corpus_pipeline
    from assaylake.llm.quality_rules import quality_rules
    from tests.llm.test_short_runs import brute as brute_lines

    base = [prose(i, 60) for i in range(40)]
    found = rows(*base, *[edited(base[i], i) for i in range(15)], *["short one"] * 5, *[f"{base[3]}\n{prose(70 + i, 40)}" for i in range(10)])
    table(spark, found).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = {r["doc_id"] for r in quality_rules(docs).filter("kept").collect()}
    found = [r for r in found if r[0] in good]
    clean = brute_lines(found)
    found = [(*r[:1], clean[r[0]][0], *r[2:]) for r in found if clean[r[0]][0].strip()]
    classes = brute_classes([shingles(r[1], 5) for r in found], 80)
    found = [r for i, r in enumerate(found) if classes[i] == i]
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, str(tmp_path))
    assert {(r["doc_id"], r["text"], r["n_chars"]) for r in docs.collect()} == {(r[0], r[1], len(r[1])) for r in found}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    taken = Counter()
    for r in mix_sources(docs).collect():
        taken[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in out if r["piece"] == 0) == +taken

"""Token files, packing and sharding: exact round trips and properties."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from assaylake.llm.packing import best_fit, best_fit_packing
from assaylake.llm.sharding import OVERHEAD, balanced_shards, least_loaded, write_shards
from assaylake.llm.token_output import decode_ranks, encode_ranks, token_digests
from assaylake.llm.tokens import PieceTokenizer
from tests.llm.helpers import crc_of, hard_rows, prose, rows, table

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "  ", " a", "a ", "a  b", "a \n b", "a\nb c", "don't I'll we've x's", "x y z  w", "　a b", "tab\tand space", "1234 56,7 8.9",
    "İΣ ẞ café é ö", "<|endoftext|> a <|endoftext|>", "a <|endoftext|> b", "x<|endoftext|>y  z", "<|startoftext|>x", "A<|ENDOFTEXT|> b <|endoftext", "\x1c a\x1fb \x85 c", "中文 字", "a\r\n b \r", "   x", "'s 't",
]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_by_piece_are_the_ids_of_the_text(path):
    plain = Tokenizer.from_file(path)
    pick = random.Random(5)
    alphabet = [" ", " ", "a", "b", "Z", "<|endoftext|>", "\n", "\t", "'", "s", ".", ",", "1", "é", " ", "́", "Σ", "\U0001f600", "\x1c", " "]
    texts = ODD + [r[1] or "" for r in hard_rows()] + ["".join(pick.choices(alphabet, k=pick.randint(1, 40))) for _ in range(3000)]
    for text, packed in zip(texts, PieceTokenizer(path, 4).encode(texts)):
        assert np.frombuffer(packed, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


def test_variable_length_round_trip():
    pick = random.Random(3)
    for n in (0, 1, 3, 4, 5, 1000):
        ranks = np.array([pick.choice([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, pick.randrange(300)]) for _ in range(n)], np.uint32)
        control, data = encode_ranks(ranks)
        assert len(control) == -(-n // 4)
        assert decode_ranks(control, data, n).tolist() == ranks.tolist()


def test_token_files(spark, hard, nothing):
    plain = Tokenizer.from_file(BYTES)
    got = token_digests(hard, BYTES).collect()
    found = hard_rows()
    assert len(got) == len(found)
    want = Counter((r[0], crc_of([*plain.encode(r[1] or "", add_special_tokens=False).ids, 2])) for r in found)
    assert Counter((r["doc_id"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):  # gapless, in ascending doc_id order
        assert r["start"] == at
        at += r["n_tokens"]
    ids = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert token_digests(nothing, BYTES).collect() == []


def test_best_fit_plan_is_best_fit():
    """The plan opens as many sequences as best fit does one piece at a time."""
    for seed in range(30):
        pick = random.Random(seed)
        size = pick.choice([10, 64, 2048])
        histogram = {n: pick.randint(1, 40) for n in pick.sample(range(1, size + 1), min(size, pick.randint(1, 30)))}
        rooms = []
        for n in sorted(histogram, reverse=True):
            for _ in range(histogram[n]):
                fitting = [r for r in rooms if r >= n]
                if fitting:
                    rooms.remove(min(fitting))
                    rooms.append(min(fitting) - n)
                else:
                    rooms.append(size - n)
        used, ranks = defaultdict(list), defaultdict(list)
        for length, rank, count, first, offset in best_fit(histogram, size):
            for i in range(count):
                used[first + i].append((offset, length))
                ranks[length].append(rank + i)
        assert len(used) == len(rooms)
        for placed in used.values():
            at = 0
            for offset, length in sorted(placed):
                assert offset == at
                at += length
            assert at <= size
        assert {n: sorted(r) for n, r in ranks.items()} == {n: list(range(c)) for n, c in histogram.items()}


def test_packing(spark, hard, nothing):
    plain = Tokenizer.from_file(WORDS)
    want = Counter()
    for r in hard_rows():
        ids = [*plain.encode(r[1] or "", add_special_tokens=False).ids, 0]
        for k, begin in enumerate(range(0, len(ids), 2048)):
            want[r[0], k, begin, len(ids[begin : begin + 2048]), crc_of(ids[begin : begin + 2048])] += 1
    got = best_fit_packing(hard, WORDS).collect()
    assert Counter(tuple(r)[:5] for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in by.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    assert best_fit_packing(nothing, WORDS).collect() == []


def test_shards(spark, hard, nothing, tmp_path):
    copies = [(1000 + i, prose(9, 50), "en", "s", 0) for i in range(200)]
    many = rows(*[prose(i, 5 + i % 90) for i in range(800)], first=100) + copies
    got = balanced_shards(table(spark, many)).collect()
    sizes = {r[0]: len(r[1].encode()) + OVERHEAD for r in many}
    text = {r[0]: r[1] for r in many}
    assert {r["doc_id"]: r["size"] for r in got} == sizes
    assert all(r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode()) and r["law"] == "bytes" and r["grown_shard"] is None for r in got)
    shard_of = defaultdict(set)
    for r in got:
        shard_of[text[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in shard_of.values())
    slots, loads = defaultdict(list), Counter()
    for r in got:
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = sorted(loads.values())
    group = 200 * sizes[1000]
    assert ordered[-1] == max(group, ordered[-1]) and ordered[-2] - ordered[0] <= 2 * max(sizes.values())
    assert len(balanced_shards(hard).collect()) == len(hard_rows()) and balanced_shards(nothing).collect() == []
    write_shards(hard, str(tmp_path / "shards"), 3)
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(hard_rows())


def test_least_loaded_is_longest_first():
    assert least_loaded([(5, "a"), (4, "b"), (3, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}

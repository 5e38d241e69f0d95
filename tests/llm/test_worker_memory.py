"""What a Python worker holds: tables of words and the keys that one range answers for."""

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest

from assaylake.llm import tokens
from assaylake.llm.buckets import answer_totals, answers, asked

PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json")]


@pytest.mark.parametrize("path", PATHS)
def test_words_met_again_stay_known_while_others_are_dropped(path, monkeypatch):
    monkeypatch.setattr(tokens, "MEMORY", 400)
    coder, encoded, held = tokens.PieceTokenizer(path, 4), [], []
    encode = coder._encode
    monkeypatch.setattr(coder, "_encode", lambda new: encoded.extend(new) or encode(new))
    letters = "abcdefghijklmnopqrst"
    for block in range(30):
        rare = [f"{letters[block % 20]}{a}{b}{letters[block // 20]}" for a in letters for b in letters[:5]]
        text = " ".join(["start", "common", *rare, "words."])
        whole = coder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(coder.encode([text])), "<u4").tolist() == whole
        held.append(sum(len(t.newer) + len(t.older) for t in (coder.known, coder.spaced)))
    assert [w.strip() for w in encoded].count("common") == [w.strip() for w in encoded].count("words") == 1
    assert len(encoded) > 2000 and max(held) < 2 * 400


def test_a_range_answers_without_copies_of_its_keys():
    buckets, n = 40, 10_000
    rng = np.random.default_rng(1)
    common = rng.integers(0, 2**64, 2 * n, np.uint64, endpoint=False)
    sets = [np.unique(rng.choice(common, n)) for _ in range(buckets)]
    sets = [s[np.concatenate([[True], np.diff(s >> np.uint64(16)) > 0])] for s in sets]
    table = pa.concat_tables([asked(i, s, np.full(len(s), i % 3 + 1, np.uint8), 1) for i, s in enumerate(sets)])
    total = sum(map(len, sets))
    tracemalloc.start()
    found = answer_totals(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 34 * total
    want = {}
    for i, s in enumerate(sets):
        for key in (s >> np.uint64(16)).tolist():
            want[key] = want.get(key, 0) + i % 3 + 1
    for i, s in enumerate(sets):
        heard = found.filter(pc.equal(found["bucket"], i))
        assert answers(heard, 0, np.uint8).tolist() == [min(255, want[k]) for k in (s >> np.uint64(16)).tolist()]

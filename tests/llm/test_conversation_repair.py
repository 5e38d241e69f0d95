"""Conversation repair against brute force: all edits of short rows, a table of states for long ones, whole tables."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from assaylake.llm import conversation_repair as repair
from assaylake.llm.conversation_repair import LETTERS, best, joined, lightest, repaired

FITS = re.compile("(s?(ua)+)?")
LETTER = {v: k for k, v in LETTERS.items()}
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def every_way(rows):
    """Least (cost, audit) by trying all edits; rows are (initial, fault)."""
    inserts = ["", "u", "a", "ua", "au"]
    options = []
    for initial, fault in rows:
        more = 3 if fault == "T" else 0
        own = [(4, "D", "")]
        if fault not in "BD":
            own += [(more, "K", initial), (more + 3, "R", "u"), (more + 3, "R", "a")]
        options.append(own)
    found = []
    for edits in itertools.product(*options):
        for between in itertools.product(inserts, repeat=len(rows) + 1):
            shape = between[0] + "".join(e[2] + b for e, b in zip(edits, between[1:]))
            if FITS.fullmatch(shape):
                audit = "I" * len(between[0]) + "".join(e[1] + "I" * len(b) for e, b in zip(edits, between[1:]))
                found.append((sum(e[0] for e in edits) + 3 * sum(map(len, between)), audit))
    return min(found)


def by_table(rows):
    """Least (cost, audit) row by row; returns the repaired rows too. Rows are (role, text, fault)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    def inserted(cells):
        for _ in range(3):
            for last, (cost, audit, lines) in list(cells.items()):
                for r in "ua":
                    if (last, r) in after:
                        new = cost + 3, audit + "I", lines + [f"{full[r]}:"]
                        if r not in cells or new[:2] < cells[r][:2]:
                            cells[r] = new
        return cells

    cells = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        new = {}

        def offer(last, weight):
            if last not in new or weight[:2] < new[last][:2]:
                new[last] = weight

        more = 3 if fault == "T" else 0
        for last, (cost, audit, lines) in cells.items():
            offer(last, (cost + 4, audit + "D", lines))
            if fault in "BD":
                continue
            if (last, role[:1]) in after or not role:
                offer(role[:1] or last, (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
            for r in "ua":
                if (last, r) in after:
                    offer(r, (cost + more + 3, audit + "R", [*lines, f"{full[r]}:{text}"]))
        cells = inserted(new)
    return min((cells[last] for last in ("", "a") if last in cells), key=lambda c: c[:2])


def test_lightest_is_the_least_of_all_ways():
    pick = random.Random(1)
    kinds = [(i, f) for i in "suax" for f in ".BDT"] + [(i, ".") for i in "sua"] * 6
    for n, times in ((0, 1), (1, 16), (2, 60), (3, 25)):
        for _ in range(times):
            rows = [pick.choice(kinds) for _ in range(n)]
            assert best(lightest("".join(LETTER[r] for r in rows))) == every_way(rows), rows


def test_pieces_join_to_the_whole():
    pick = random.Random(2)
    for _ in range(60):
        letters = "".join(pick.choice(list(LETTERS)) for _ in range(pick.randint(2, 14)))
        cuts = sorted({0, len(letters), *(pick.randint(0, len(letters)) for _ in range(2))})
        ways = [repair._ways_of(letters[a:b]) for a, b in itertools.pairwise(cuts)]
        whole = joined(ways)
        assert min(whole[0, s] for s in (0, 3) if (0, s) in whole) == best(lightest(letters)), letters


def brute(found):
    """conv_id -> the contract's row, from (conv_id, turn, role, text)."""
    rows, space = {}, lambda x: " " if x is None else str(x)
    for conv, turn, role, text in found:
        rows.setdefault(conv, [])
        kind = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            rows[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = {}
    for conv, own in rows.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.md5(r[2].encode()).hexdigest()))
        seen, marked, faults = set(), [], {"B": 0, "D": 0, "T": 0, ".": 0}
        for _, role, text in own:
            shown = VISIBLE.findall(text)
            fault = "B" if not shown else "D" if (role, text) in seen else "T" if shown[-1] not in ".!?" else "."
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        turns = {t for t, *_ in own if t is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, lines = by_table(marked)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, faults["B"], faults["D"], faults["T"], illegal, cost, audit, digest)
    return out


def conversations(seed, count, turns=9):
    pick = random.Random(seed)
    found = []
    for conv in range(count):
        for turn in range(pick.randint(1, turns)):
            role = pick.choice(["system", "user", "assistant", "tool", None, ""]) if pick.random() < 0.2 else ("user", "assistant")[turn % 2]
            text = pick.choice(["Yes.", "No", "é!\n", " \t", "", None, "same. ", f"text {pick.randint(0, 30)}?"])
            found.append((None if conv == 3 else conv, None if pick.random() < 0.05 else turn + (pick.random() < 0.1), role, text))
    return found + found[:5]


def check(spark, found):
    df = spark.createDataFrame([(*r, "z", "q") for r in found], "conv_id long, turn long, role string, text string, piece string, letters string")
    got = repaired(df.repartition(3)).collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len({r["conv_id"] for r in got}) == len(got)
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in got} == brute(found)


def test_whole_tables(spark):
    check(spark, conversations(1, 120) + [(500, t, "assistant" if t % 2 else "user", "x" * 200_000 + ".") for t in range(4)])


def test_long_conversations_are_joined_from_pieces(spark, monkeypatch):
    monkeypatch.setattr(repair, "PIECE_ROWS", 4)
    monkeypatch.setattr(repair, "FAN", 2)
    found = conversations(2, 25) + [(77, t, random.Random(t).choice(["user", "assistant", "user"]), f"a {t % 40}.") for t in range(90)]
    check(spark, found)


def test_nothing(spark):
    assert repaired(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
    # A row that is dropped leaves a conversation without rows.
    gone = next(t for t in range(999) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    check(spark, [(8, gone, "user", "a.")])

"""Conversation structure repair: the lightest derivation of a well-formed conversation.

A conversation is well formed if its role initials read ``(s?(ua)+)?``. Rows are kept, given another role, deleted, and
empty turns are put in between; each edit has a price. Items of the deduction are (rows read, state of the pattern); an
edit leads from an item and a row to the next item, and an item weighs (cost, audit), the audit being the initials of the
edits so far. Every edit makes a weight larger, so Knuth's agenda may finalise the lightest open item for good; it stops
when the goal is popped. Two audits of one item and cost are never prefixes of each other (they differ in insertions,
which cost), so appending keeps their order and the least audit is found with the least cost.

Rows get their order by ranges, without whole conversations in one task, and become strings of one letter each, in
pieces of ``PIECE_ROWS``. Most conversations are one piece and are derived at once. A longer one is derived piece by
piece, from each state to each state; pieces are then joined in groups of ``FAN``, level by level, so a conversation with
a third of all rows is a tree of small tasks. Only its audit, one letter per edit, is one value, as it is in the result.
The digest of a repaired conversation is sequential by nature: its rows are sorted by Spark and streamed through the hash
of one task, which holds one row, the audit and the hash, never the conversation.

Order: by turn (nulls first); rows of one turn by role and digest of the text, so repeated rows stand next to each other.
Nulls: role and text count as one space, ``conv_id`` null is a conversation of its own. Empty roles have no initial and
fit anywhere. Further columns are never read. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import heapq

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assaylake.llm.common import ranked, stored

# Prices of edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
PIECE_ROWS, FAN = 512, 64
# States of the pattern: nothing yet, after s, after u, after a; and the roles that lead on.
START, NEXT, GOALS = 0, ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}), (0, 3)
NAMES = {"u": "user", "a": "assistant"}
INITIALS, FAULTS = "sua-x", ".BDT"  # "-": no initial, "x": any other; fine, blank, duplicate, truncated
# One letter per row: initial and fault.
LETTERS = {chr(97 + 4 * i + f): (initial, fault) for i, initial in enumerate(INITIALS) for f, fault in enumerate(FAULTS)}


# ---- deduction ----


def edits(letter: str, state: int):
    """(cost, initial of the edit, next state) for a row."""
    initial, fault = LETTERS[letter]
    yield DELETE, "D", state
    if fault in "BD":
        return
    more = TRUNCATED if fault == "T" else 0
    if initial == "-":
        yield more, "K", state
    elif initial in NEXT[state]:
        yield more, "K", NEXT[state][initial]
    for role, after in NEXT[state].items():
        if role in NAMES:
            yield more + REROLE, "R", after


def lightest(letters: str, start: int = START, goals=GOALS) -> dict[int, tuple[int, str]]:
    """State -> (cost, audit) of the lightest derivations from ``start`` over all rows, for each goal state.

    Items are popped from the agenda in the order of their weights; each is final when popped.
    """
    final: set[tuple[int, int]] = set()
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    found: dict[int, tuple[int, str]] = {}
    while agenda and len(found) < len(goals):
        cost, audit, row, state = heapq.heappop(agenda)
        if (row, state) in final:
            continue
        final.add((row, state))
        if row == len(letters) and state in goals:
            found[state] = cost, audit
        for role, after in NEXT[state].items():
            if role in NAMES and (row, after) not in final:
                heapq.heappush(agenda, (cost + INSERT, audit + "I", row, after))
        if row < len(letters):
            for price, name, after in edits(letters[row], state):
                if (row + 1, after) not in final:
                    heapq.heappush(agenda, (cost + price, audit + name, row + 1, after))
    return found


def best(found: dict[int, tuple[int, str]]) -> tuple[int, str]:
    """The lighter of the derivations that end well."""
    return min(found[state] for state in GOALS if state in found)


def joined(pieces: list[dict[tuple[int, int], tuple[int, str]]]) -> dict[tuple[int, int], tuple[int, str]]:
    """Pieces one behind the other: (from, to) -> (cost, audit). Prefixes grow on the right, so order is kept."""
    found = pieces[0]
    for piece in pieces[1:]:
        more: dict[tuple[int, int], tuple[int, str]] = {}
        for (a, b), (cost, audit) in found.items():
            for (c, d), (price, tail) in piece.items():
                if b == c:
                    weight = cost + price, audit + tail
                    if (a, d) not in more or weight < more[a, d]:
                        more[a, d] = weight
        found = more
    return found


# ---- rows ----


def _visible(text: Column) -> Column:
    return F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after damage by a checksum of conversation and turn; nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind"))
    text = (
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    kept = rows.filter(F.col("_kind") != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy"))
    return kept.drop("_copy")


ROW = ["conv_id", "turn", "role", "_text"]


def _events(rows: DataFrame) -> DataFrame:
    """Different rows with their number, fault, and whether role and text occur for the first time there."""
    shown = _visible(F.col("text"))
    ends_well = F.substring(shown, -1, 1).isin(".", "!", "?")
    fault = F.when(shown == "", "B").when(~ends_well, "T").otherwise(".")
    slim = rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("_text"), fault.alias("fault"))
    events = slim.groupBy(*ROW, "fault").agg(F.count("*").alias("n"))
    # Nulls come first among turns, as they do in the order of rows.
    firsts = events.groupBy("conv_id", "role", "_text").agg(F.min(_turn_order()).alias("_first"))
    same = F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("e.role") == F.col("f.role")) & (F.col("e._text") == F.col("f._text"))
    both = events.withColumn("_at", _turn_order()).alias("e").join(firsts.alias("f"), same)
    return both.select("e.*", (F.col("_at") == F.col("_first")).alias("first")).drop("_at")


def _turn_order() -> Column:
    return F.struct(F.col("turn").isNotNull().alias("there"), F.coalesce(F.col("turn"), F.lit(0)).alias("turn"))


def _letters() -> Column:
    """The letters of equal rows: the first may be fine or truncated, those after it are duplicates."""
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "", F.lit(INITIALS.index("-"))).otherwise(
        F.coalesce(F.array_position(F.array(*map(F.lit, "sua")), initial), F.lit(0)).cast("int") - 1
    )
    place = F.when(place < 0, F.lit(INITIALS.index("x"))).otherwise(place)
    letter = lambda fault: F.char(F.lit(97) + 4 * place + fault)
    known = F.when(F.col("fault") == "B", 1).when(F.col("fault") == "T", 3).otherwise(0)
    later = F.when(F.col("fault") == "B", letter(F.lit(1))).otherwise(letter(F.lit(2)))
    one = F.when(F.col("first"), letter(known)).otherwise(later)
    return F.concat(one, F.repeat(later, (F.col("n") - 1).cast("int")))


# ---- audits ----

# A way through a piece travels as "from to cost audit".
_WAYS = "array<string>"


def _ways_of(letters: str) -> dict[tuple[int, int], tuple[int, str]]:
    states = range(len(NEXT))
    return {(a, b): weight for a in states for b, weight in lightest(letters, a, reachable(a, len(letters))).items()}


def reachable(start: int, rows: int) -> tuple[int, ...]:
    """States that edits can lead to: everything but a way back to the start or to s; s only by a kept row."""
    return tuple(state for state in range(len(NEXT)) if state not in (0, 1) or state == start or (state == 1 and start == 0 and rows))


def _packed(found) -> list[str]:
    return [f"{a} {b} {cost} {audit}" for (a, b), (cost, audit) in sorted(found.items())]


def _unpacked(ways) -> dict[tuple[int, int], tuple[int, str]]:
    rows = (w.split(" ", 3) for w in ways)
    return {(int(a), int(b)): (int(cost), audit) for a, b, cost, audit in rows}


def _short_audits(letters: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([best(lightest(x)) for x in letters], columns=["cost", "audit"])


def _piece_ways(letters: pd.Series) -> pd.Series:
    return pd.Series([_packed(_ways_of(x)) for x in letters])


def _joined_ways(pieces: pd.Series) -> pd.Series:
    return pd.Series([_packed(joined([_unpacked(way) for way in ways])) for ways in pieces])


def audits(pieces: DataFrame) -> DataFrame:
    """(conv_id, cost, audit) from (conv_id, piece, letters)."""
    sized = pieces.groupBy("conv_id").agg(F.count("*").alias("n"), F.max_by("letters", "piece").alias("letters"))
    short = F.pandas_udf(_short_audits, "cost long, audit string")
    alone = sized.filter("n = 1").select("conv_id", short("letters").alias("r")).select("conv_id", "r.cost", "r.audit")
    most = sized.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0]
    if most <= 1:
        return alone
    several = sized.filter("n > 1").select(F.col("conv_id").alias("_conv"))
    # The index of a piece within its conversation; the numbers of its pieces follow each other.
    long = pieces.join(several, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    lows = long.groupBy(F.col("conv_id").alias("_conv")).agg(F.min("piece").alias("_low"))
    long = long.join(lows, F.col("conv_id").eqNullSafe(F.col("_conv"))).withColumn("piece", F.col("piece") - F.col("_low"))
    # One derivation is heavy beside the row that asks for it: spread the pieces.
    long = long.select("conv_id", "piece", "letters").repartition(F.col("conv_id"), F.col("piece"))
    ways = stored(long.select("conv_id", "piece", F.pandas_udf(_piece_ways, _WAYS)("letters").alias("way")), "ways")
    join = F.pandas_udf(_joined_ways, _WAYS)
    while most > 1:  # one round per factor of FAN
        group = F.floor(F.col("piece") / FAN).alias("piece")
        sorted_ways = F.array_sort(F.collect_list(F.struct("piece", "way")))
        met = ways.groupBy("conv_id", group).agg(F.transform(sorted_ways, lambda x: x["way"]).alias("ways"))
        ways = stored(met.select("conv_id", "piece", join("ways").alias("way")), "ways")
        most = -(-most // FAN)
    fields = F.transform("way", lambda w: F.split(w, " ", 4))
    ended = F.filter(fields, lambda w: (w[0] == str(START)) & w[1].isin(*map(str, GOALS)))
    least = F.array_min(F.transform(ended, lambda w: F.struct(w[2].cast("long").alias("cost"), w[3].alias("audit"))))
    done = ways.select("conv_id", least.alias("r")).select("conv_id", "r.cost", "r.audit")
    return alone.unionByName(done)


# ---- repaired text ----


class Repaired:
    """The digest of one conversation while its rows go by."""

    def __init__(self, conv_id, audit: str):
        self.conv_id, self.audit, self.at, self.state = conv_id, audit, 0, START
        self.hash, self.lines = hashlib.sha256(), 0

    def _line(self, role: str, text: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1

    def _next(self) -> str:
        """The only role of NAMES that leads on."""
        role = next(r for r in NEXT[self.state] if r in NAMES)
        self.state = NEXT[self.state][role]
        return NAMES[role]

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._line(self._next(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._line(self._next(), text)
        elif edit == "K":
            self.state = NEXT[self.state][role[0]] if role else self.state
            self._line(role, text)

    def end(self) -> tuple:
        self._inserted()
        return self.conv_id, self.hash.hexdigest()


def _digests(schema: pa.Schema):
    def build(batches):
        now, done = None, []
        for batch in batches:
            names = batch.schema.names
            for begin in range(0, batch.num_rows, 256):  # few texts at a time as Python strings
                for row in zip(*(batch.column(names.index(n)).slice(begin, 256).to_pylist() for n in ("conv_id", "audit", "role", "text"))):
                    conv_id, audit, role, text = row
                    if audit is not None:  # the head of a conversation comes first
                        if now:
                            done.append(now.end())
                        now = Repaired(conv_id, audit)
                    else:
                        now.row(role, text)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in done], t.type) for k, t in enumerate(schema)], schema=schema)
            done = []
        if now:
            yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip(now.end(), schema)], schema=schema)

    return build


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): audits go ahead of the sorted rows of their conversation."""
    from pyspark.sql.pandas.types import to_arrow_type

    none = lambda kind: F.lit(None).cast(kind)
    kinds = dict(rows.dtypes)
    heads = found.select("conv_id", none(kinds["turn"]).alias("turn"), none("string").alias("role"), none("string").alias("text"), "audit")
    body = rows.select("conv_id", "turn", "role", "text", none("string").alias("audit"))
    both = heads.unionByName(body).withColumn("_text", F.md5(F.col("text").cast("binary")))
    order = ["conv_id", F.col("audit").isNull(), "turn", "role", "_text"]
    sorted_rows = both.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "audit", "role", "text")
    schema = pa.schema([("conv_id", to_arrow_type(rows.schema["conv_id"].dataType)), ("repaired_sha256", pa.string())])
    return sorted_rows.mapInArrow(_digests(schema), f"conv_id {kinds['conv_id']}, repaired_sha256 string")


# ---- counts ----


def _counts(events: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated) by conversation."""
    fine_first = F.col("first") & (F.col("fault") != "B")
    by_turn = events.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("fault") == "B", F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "B", 0).otherwise(F.col("n") - fine_first.cast("long"))).alias("duplicate"),
        F.sum((fine_first & (F.col("fault") == "T")).cast("long")).alias("truncated"),
    )
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long")
    sums = [F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated")]
    return by_turn.groupBy("conv_id").agg(gaps.alias("gaps"), *sums)


def _initials(letters: Column) -> Column:
    """Initials for letters; rows without one stand as '-'."""
    return F.translate(letters, "".join(LETTERS), "".join(initial for initial, _ in LETTERS.values()))


def _illegal(pieces: DataFrame) -> DataFrame:
    """(conv_id, illegal): neighbours in a piece, and the last and first rows of pieces that follow each other."""
    roles = _initials(F.col("letters"))
    legal = (F.length(roles) - 1) - sum(
        F.regexp_count(roles, F.lit(f"{pair[0]}(?={pair[1]})")) for pair in ("su", "ua", "au")
    )
    ends = pieces.select("conv_id", "piece", legal.alias("inner"), F.substring(roles, 1, 1).alias("head"), F.substring(roles, -1, 1).alias("tail"))
    before = F.lag("tail").over(W.partitionBy("conv_id").orderBy("piece"))
    seam = F.when(before.isNull() | F.concat(before, F.col("head")).isin("su", "ua", "au"), 0).otherwise(1)
    return ends.select("conv_id", (F.col("inner") + seam).alias("illegal")).groupBy("conv_id").agg(F.sum("illegal").cast("long").alias("illegal"))


def repaired(conversations: DataFrame) -> DataFrame:
    """One row per conversation: its faults after damage, the lightest repair and the digest of the repaired text."""
    rows = damaged(conversations)
    events = stored(_events(rows), "events")
    order = ["conv_id", "turn", "role", "_text"]
    placed = ranked(events.select(*order, _letters().alias("letters")), order, "rank", "turns")
    piece = F.floor(F.col("rank") / PIECE_ROWS).alias("piece")
    in_order = F.array_sort(F.collect_list(F.struct("rank", "letters")))
    pieces = placed.groupBy("conv_id", piece).agg(F.array_join(F.transform(in_order, lambda x: x["letters"]), "").alias("letters"))
    pieces = stored(pieces, "pieces")
    found = stored(audits(pieces), "audits")
    parts = [_counts(events), _illegal(pieces), found, digests(rows, found)]
    out = conversations.select("conv_id").distinct()
    for part in parts:
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )

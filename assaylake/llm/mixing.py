"""Sources mixed to target weights by pivotal dependent rounding.

Every source gets a target of words. A document is taken ``floor(rate)`` times, and once more with the probability
that is left, where rate is target by size of its source. Those fractional copies are not drawn apart: they meet in
blocks, two at a time; words move from one to the other at random, without changing their sum or either's
expectation, until one is taken or left. The one still undecided meets the next. A block's last undecided document
goes to a block of the next level, so that a tree of a few levels settles a source of any size, and what a source
gives differs from its target by less than its last document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from assaylake.llm.common import keyed, ranked, stored, word_count

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_COPIES = 2
# Documents that meet in one block of the tree, on average.
BLOCK = 64


def source_targets(sizes: DataFrame, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target) from (source, source_size): shares by weight, none above ``most`` sizes.

    Sources by code point, null last, weigh 5, 2, 1, and so on. What one cannot take is shared among the others by
    weight again, until none is above; each round is one sum over all sources.
    """
    held = ranked(sizes.withColumn("last", F.col("source").isNull()), ["last", "source"], "at", "sources")
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("at") % len(WEIGHTS) + 1).cast("int"))
    held = stored(held.select("source", "source_size", weight.alias("weight")), "weights")
    total = (held.agg(F.sum("source_size")).first()[0] or 0) * share
    cap = F.col("source_size") * F.lit(float(most))
    level, full = 0.0, -1
    while True:
        above = cap <= F.col("weight") * F.lit(level)
        fixed, open_weight, now_full = held.agg(
            F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))), F.count_if(above)
        ).first()
        if not open_weight or now_full == full:
            break
        level, full = (total - (fixed or 0.0)) / open_weight, now_full
    return held.select("source", "source_size", F.least(cap, F.col("weight") * F.lit(level)).alias("target"))


def _uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone, so reruns agree."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) * F.lit(2.0**-53)


def _meet(state: Column, unit: Column) -> Column:
    """One meeting: ``state`` holds the undecided unit and the decided ones so far."""
    carry = state["carry"]
    a, p, b, q = carry["size"], carry["part"], unit["size"], unit["part"]
    up = F.least(1 - p, q * b / a)  # carry rises, unit falls
    down = F.least(p, (1 - q) * b / a)  # carry falls, unit rises
    rises = _uniform(carry["key"], unit["key"]) * (up + down) < down
    # Whichever bound was met becomes exactly 0 or 1.
    carry_part = F.when(rises, F.when(1 - p <= q * b / a, 1.0).otherwise(p + up)).otherwise(
        F.when(p <= (1 - q) * b / a, 0.0).otherwise(p - down)
    )
    unit_part = F.when(rises, F.when(q * b / a <= 1 - p, 0.0).otherwise(q - up * a / b)).otherwise(
        F.when((1 - q) * b / a <= p, 1.0).otherwise(q + down * a / b)
    )
    moved = F.struct(
        carry.withField("part", F.greatest(F.lit(0.0), F.least(F.lit(1.0), carry_part))).alias("c"),
        unit.withField("part", F.greatest(F.lit(0.0), F.least(F.lit(1.0), unit_part))).alias("u"),
    )
    return moved


def _settle(units: Column, kind: str, alike: bool) -> Column:
    """All units of a block in a row, the largest first; at most one stays undecided.

    On the first level the units are ``alike``: all have the same fraction. Then a unit meets the rest of the block
    as a whole: it is drawn, and what it takes or leaves moves to the fraction of the rest. So only small units are
    left to meet one by one. This goes on while the rest can bear it.
    """
    settled = lambda u: (u["part"] == 0.0) | (u["part"] == 1.0)
    empty = F.lit(None).cast(kind)
    rate = F.get(units, F.lit(0))["part"] if alike else F.lit(None).cast("double")
    rest = F.aggregate(units, F.lit(0.0), lambda total, u: total + F.when(settled(u), 0.0).otherwise(u["size"]))
    start = F.struct(empty.alias("carry"), F.array().cast(f"array<{kind}>").alias("done"), rate.alias("rate"), rest.alias("rest"))

    def state_of(carry, done, rate, rest):
        return F.struct(carry.alias("carry"), done.alias("done"), rate.alias("rate"), rest.alias("rest"))

    def step(state, unit):
        f, size = state["rate"], unit["size"]
        rest = F.when(settled(unit), state["rest"]).otherwise(state["rest"] - size)
        own = unit.withField("part", F.coalesce(f, unit["part"]))
        bearable = state["carry"].isNull() & ((1 - f) * size <= f * rest) & (f * size <= (1 - f) * rest)
        drawn = F.when(_uniform(unit["key"], F.lit("rest")) < f, F.lit(1.0)).otherwise(F.lit(0.0))
        moved = F.greatest(F.lit(0.0), F.least(F.lit(1.0), f + (f - drawn) * size / rest))
        against_rest = state_of(empty, F.concat(state["done"], F.array(unit.withField("part", drawn))), moved, rest)

        def after(m):
            both = F.array(m["c"], m["u"])
            left = F.get(F.filter(both, lambda u: ~settled(u)), F.lit(0))
            return state_of(left, F.concat(state["done"], F.filter(both, settled)), f, rest)

        met = F.transform(F.array(F.struct(state.alias("s"), own.alias("u"))), lambda x: _meet(x["s"], x["u"]))
        together = F.get(F.transform(met, after), F.lit(0))
        decided = state_of(state["carry"], F.concat(state["done"], F.array(F.when(settled(unit), unit).otherwise(own))), f, rest)
        alone = state_of(own, state["done"], f, rest)
        return (
            F.when(settled(unit) | settled(own), decided)
            .when(bearable & (rest > 0), against_rest)
            .when(state["carry"].isNull(), alone)
            .otherwise(together)
        )

    return F.aggregate(units, start, step)


def mix_sources(docs: DataFrame, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """One row per document: doc_id, version, size, source_size, target, copies, taken.

    Null text has no words. Documents without a source form one source, the last in order. A document without words
    is taken zero times; a source without words has target 0. Repeated rows are documents of their own, told apart
    by a number given when they are first read. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("version"), word_count(F.col("text")).alias("size"))
    # Equal rows are counted and numbered, so that each is a unit with a key that later runs find again.
    counted = rows.groupBy("doc_id", "source", "version", "size").agg(F.count("*").alias("n"))
    rows = stored(
        counted.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("n"), "mix-rows"
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    sizes = stored(sizes, "source-sizes")
    targets = source_targets(sizes.select("source", "source_size"), share, most)
    targets = targets.withColumnRenamed("source", "_source")
    # One row per source on the right; a source with a third of all rows is split by adaptive execution.
    targets = targets.join(sizes.select("source", "n_docs"), F.col("_source").eqNullSafe(F.col("source"))).drop("source")
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.least(F.floor(rate), F.lit(most)).cast("int")
    part = F.when((F.col("size") > 0) & (whole < most), rate - whole).otherwise(F.lit(0.0))
    key = F.xxhash64("doc_id", "version", "copy")
    unit = F.struct(
        key.alias("key"), F.col("size").cast("double").alias("size"), part.alias("part"), whole.alias("whole"), "doc_id", "version",
        F.col("source_size"), "target",
    )
    undecided = joined.select("source", F.col("n_docs").alias("n"), unit.alias("unit"))
    kind = undecided.schema["unit"].dataType.simpleString()
    most_units = sizes.agg(F.max("n_docs")).first()[0] or 0
    settled, level = [], 0
    while True:
        # A source of n units has n / BLOCK blocks, and as many units at most on the next level.
        blocks = F.ceil(F.col("n") / BLOCK)
        spread = undecided.withColumns({"block": F.pmod(F.xxhash64("unit.key", F.lit(level)), blocks), "n": blocks})
        gathered = spread.groupBy("source", "n", "block").agg(
            # Large documents first: small ones then settle what they leave.
            F.sort_array(F.collect_list(F.struct((-F.col("unit.size")).alias("order"), F.col("unit.key").alias("key"), "unit"))).alias("units")
        )
        ordered = gathered.select("source", "n", F.transform("units", lambda u: u["unit"]).alias("units"))
        done = stored(ordered.select("source", "n", _settle(F.col("units"), kind, level == 0).alias("state")), f"mix-level-{level}")
        settled.append(done.select(F.explode("state.done").alias("unit")))
        undecided = done.filter("state.carry is not null").select("source", "n", F.col("state.carry").alias("unit"))
        level, most_units = level + 1, -(-most_units // BLOCK)
        if most_units <= 1:
            break
    # The root: one unit of a source may be left; it is drawn with its own probability.
    drawn = F.when(_uniform(F.col("unit.key"), F.lit("root")) < F.col("unit.part"), F.lit(1.0)).otherwise(F.lit(0.0))
    result = undecided.select(F.col("unit").withField("part", drawn).alias("unit"))
    for one in settled:
        result = result.unionByName(one)
    copies = (F.col("unit.whole") + F.col("unit.part").cast("int")).alias("copies")
    size = F.col("unit.size").cast("long")
    return result.select(
        "unit.doc_id", "unit.version", size.alias("size"), "unit.source_size", "unit.target", copies
    ).withColumn("taken", F.col("copies") * F.col("size"))


def mixed(docs: DataFrame, share: float = SHARE, most: int = MOST_COPIES) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    picks = mix_sources(docs, share, most).groupBy(F.xxhash64("doc_id").alias("_id"), F.col("version").alias("_v"))
    picks = picks.agg(F.sum("copies").alias("_copies"), F.count("*").alias("_n")).filter("_copies > 0")
    # Rows that share doc_id and text share their copies: the first of them take one more where they do not divide.
    row = F.row_number().over(W.partitionBy("_id", "_v").orderBy("_v"))
    found = keyed(docs).join(picks, ["_id", "_v"]).withColumn("_row", row)
    own = F.floor((F.col("_copies") + F.col("_n") - F.col("_row")) / F.col("_n")).cast("int")
    return found.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), own))).select("row.*")

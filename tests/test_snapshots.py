"""Versioned tables: what readers see, interrupted and competing writers, key index, folders that stay untouched."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaylake.functions.bitmaps import bitmaps, holds, is_set
from assaylake.sinks import keyed
from assaylake.sinks.keyed import BUCKET, DayStore, KeyedStore, differences, key_index
from assaylake.sinks.snapshots import NOTHING, Entry, SnapshotTable, WriteConflict

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.DateType()), T.StructField("v", T.LongType())])


def frame(spark, found):
    return spark.createDataFrame(found, "id string, day string, v long").withColumn("day", F.col("day").cast("date"))


def rows(df):
    return sorted(((r["id"], str(r["day"]), r["v"]) for r in df.collect()), key=str)


def texts(found):
    return sorted(((i, str(d), v) for i, d, v in found), key=str)


FIRST = [("a", "2024-01-01", 1), ("b", "2024-01-01", 2), ("c", "2024-01-02", 3), ("d", None, 4), (None, "2024-01-02", 5)]


def test_a_reader_keeps_its_version(spark, tmp_path):
    store = DayStore(spark, str(tmp_path / "t"), SCHEMA, "id", "day", ["v"])
    assert not store.exists() and rows(store.read()) == []
    first = store.replace(frame(spark, FIRST))
    pinned = store.read(first)
    changes = store.kept_changes(
        differences(store.rows_of(frame(spark, [("a", "2024-01-01", 0), ("d", None, 0)]), first), frame(spark, [("a", "2024-01-02", 9)]), "id", store.columns, store.place)
    )
    second = store.take_in(changes, first)
    assert rows(pinned) == texts(FIRST)
    now = [("a", "2024-01-02", 9), *FIRST[1:3], FIRST[4]]
    assert rows(store.read()) == rows(store.read(second)) == texts(now)
    # The day that gained a row got a folder more; its old folder is still part of the table.
    assert {e.part for e in second.entries} == {"day=2024-01-01", "day=2024-01-02"}
    assert Entry(1, "day=2024-01-02") in second.entries and Entry(1, "day=2024-01-01") not in second.entries
    assert rows(store.table.read(store.table.at(1))) == texts(FIRST)
    assert store.take_in(store.kept_changes(changes.rows.limit(0)), second) == second


def test_an_interrupted_write_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, str(tmp_path / "t"), SCHEMA, "id", 2)
    store.replace(frame(spark, FIRST))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:  # the data are there, the version is not
        patch.setattr(SnapshotTable, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            store.replace(frame(spark, [("z", None, 0)]))
    assert rows(store.read()) == texts(FIRST) and store.table.versions() == [1]
    after = store.replace(frame(spark, FIRST[:2]))
    assert rows(store.read()) == texts(FIRST[:2]) and after.generations() == {3}
    assert store.table.sweep(keep=1) == [1, 2]
    assert rows(store.read()) == texts(FIRST[:2]) and store.table.versions() == [2]


def test_the_slower_of_two_writers_is_told(spark, tmp_path):
    table = SnapshotTable(spark, str(tmp_path / "t"), SCHEMA, "day")
    generation, entries = table.write(frame(spark, FIRST), ["v"])
    other = table.write(frame(spark, FIRST[:1]), ["v"])[1]
    table.publish(NOTHING, entries)
    with pytest.raises(WriteConflict):
        table.publish(NOTHING, other)
    assert rows(table.read()) == texts(FIRST)


def test_the_index_misses_no_key_and_finds_few_strangers(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"))
    words = 10
    index = key_index(keys.withColumn(BUCKET, F.lit(0)), "id", words)
    asked = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") < 20_000).alias("held"))
    bits = keyed.bits_of(F.col("id"))
    asked = asked.select("held", keyed.word_of(F.col("id"), F.lit(words)).alias("word"), bits[0].alias("a"), bits[1].alias("b"))
    met = asked.join(index, "word").groupBy("held").agg(F.sum((is_set(F.col("bits"), F.col("a")) & is_set(F.col("bits"), F.col("b"))).cast("long")).alias("n"))
    found = {r["held"]: r["n"] for r in met.collect()}
    assert found[True] == 20_000 and found[False] < 1_000


def test_only_folders_with_a_changed_key_are_written_anew(spark, tmp_path):
    store = KeyedStore(spark, str(tmp_path / "t"), SCHEMA, "id", 64)
    base = [(f"k{i}", "2024-01-01", i) for i in range(1000)]
    first = store.replace(frame(spark, base))
    assert len(first.entries) == 16
    new = [("k7", "2024-01-01", -7), ("k8", "2024-01-01", 8), ("new", None, 1)]
    held = store.rows_of(frame(spark, new), first)
    assert len(store.may_hold(frame(spark, new), first)) <= 4  # two folders hold k7 and k8
    changes = store.kept_changes(differences(held, frame(spark, new), "id", store.columns, store.place))
    assert {r["id"]: r["kind"] for r in changes.rows.collect()} == {"k7": "changed", "new": "inserted"}
    second = store.take_in(changes, first)
    assert changes.rewritten == 1 and len(set(first.entries) - set(second.entries)) == 1
    want = [r for r in base if r[0] != "k7"] + [("k7", "2024-01-01", -7), ("new", None, 1)]
    assert rows(store.read()) == texts(want)
    gone = differences(store.rows_of(frame(spark, [("k9", None, 0), ("new", None, 0)]), second), frame(spark, []), "id", store.columns, store.place)
    store.take_in(store.kept_changes(gone), second)
    assert rows(store.read()) == texts([r for r in want if r[0] not in ("k9", "new")])


@pytest.mark.parametrize("kind", [KeyedStore, DayStore])
def test_many_small_writes_are_folded(spark, tmp_path, kind, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_RUNS", 4)
    more = (4,) if kind is KeyedStore else ("day",)
    store = kind(spark, str(tmp_path / "t"), SCHEMA, "id", *more)
    want, snapshot = [], NOTHING
    for night in range(9):
        new = [(f"n{night}", "2024-01-01", night), (f"n{max(0, night - 3)}", "2024-01-01", 100 + night)]
        new = new[: 1 + (night > 3)]
        want = [r for r in want if r[0] not in {n[0] for n in new}] + new
        held = store.rows_of(frame(spark, new), snapshot)
        changes = store.kept_changes(differences(held, frame(spark, new), "id", store.columns, store.place))
        snapshot = store.take_in(changes, snapshot)
        assert rows(store.read()) == texts(want)
        assert len(snapshot.generations()) <= 5


def test_bit_maps_hold_their_numbers(spark):
    some = [0, 1, 7, 8, 32_767, 32_768, 32_769, 2_147_483_647, -1, -32_768]
    maps = bitmaps(spark.createDataFrame([(n,) for n in [*some, None]], "n long"), "n")
    asked = spark.createDataFrame([(n,) for n in [*some, 2, 9, 65_536, -2, None]], "n long")
    joined = asked.join(maps, F.bitmap_bucket_number("n") == F.col("bucket"), "left")
    assert {r["n"]: r["h"] for r in joined.select("n", holds(F.col("bits"), F.col("n")).alias("h")).collect()} == dict.fromkeys(some, True) | dict.fromkeys([2, 9, 65_536, -2, None], False)


def test_the_files_of_a_hot_day_hold_ranges_apart(spark, tmp_path):
    """Nine tenths of all rows lie on one day: it becomes several files, and one value of the cluster column is in one of them."""
    hot = spark.range(20_000).select(
        F.col("id").cast("string"), F.when(F.col("id") % 10 == 0, F.date_add(F.lit("2024-02-01").cast("date"), (F.col("id") % 50).cast("int"))).otherwise(F.lit("2024-01-01").cast("date")).alias("day"), (F.xxhash64("id") % 5000).alias("v")
    )
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store = DayStore(spark, str(tmp_path / "t"), SCHEMA, "id", "day", ["v"])
        snapshot = store.replace(hot.repartition(7))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    held = store.table.read(entries=snapshot.of_parts(["day=2024-01-01"])).groupBy(F.input_file_name()).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    ranges = sorted((r["low"], r["high"]) for r in held.collect())
    assert len(ranges) >= 3 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    assert store.read().count() == 20_000

"""Incremental processing."""

from pyspark.sql import functions as F

from assaylake.functions import json as j
from assaylake.operators.versions import latest_version, updated_since
from assaylake.plans.marts import measurement_since
from assaylake.schemas.raw import RUN_DATE as RUN_DATE_COLUMN
from assaylake.session import scratch_path
from assaylake.sinks.keyed import DayStore, KeyedStore, differences
from assaylake.sinks import tables as sinks
from assaylake.sinks.raw import raw_append, raw_read, raw_replace
from assaylake.sinks.upsert import merge_by_key
from contract.adapter import RUN_DATE
from contract.registry import query

MARK = "1999-06-15 00:00:00"


def mark():
    return F.lit(MARK).cast("timestamp")


query(
    "incremental_filter",
    f"""SELECT measurement_id, measurement_concept_id, specimen_id, _loaded_at FROM measurements
        WHERE _loaded_at >= TIMESTAMP '{MARK}'""",
)(
    lambda t: measurement_since(t.ws, mark()).select(
        "measurement_id", "measurement_concept_id", "specimen_id", "_loaded_at"
    )
)


def stored_and_new(t):
    """Measurements as known before the mark, and what an incremental run computes after it."""
    columns = ["measurement_id", "value_source_value", "_loaded_at"]
    whole = t.ws.model("omop_measurement").select(*columns)
    old = whole.withColumn("value_source_value", F.lit("stale")).filter(
        F.col("_loaded_at") < mark() + F.expr("interval 200 days")
    )
    # Both the keys and the rows of what is new are read: its plan runs once, as in an upsert of a stored table.
    path = scratch_path(t.spark, "new")
    new = sinks.table_sink(measurement_since(t.ws, mark()).select(*columns), path)
    return old, new


query(
    "upsert_by_key",
    f"""SELECT measurement_id, CASE WHEN _loaded_at >= TIMESTAMP '{MARK}' THEN value_source_value ELSE 'stale' END
        AS value_source_value, _loaded_at FROM measurements""",
)(lambda t: merge_by_key(*stored_and_new(t), "measurement_id"))
query(
    "append_new_columns",
    f"""SELECT measurement_id, CASE WHEN _loaded_at >= TIMESTAMP '{MARK}' THEN value_source_value ELSE 'stale' END
        AS value_source_value, _loaded_at, CASE WHEN _loaded_at >= TIMESTAMP '{MARK}' THEN 'second' END AS batch
        FROM measurements""",
)(lambda t: _with_new_column(t))


def _with_new_column(t):
    old, new = stored_and_new(t)
    return merge_by_key(old, new.withColumn("batch", F.lit("second")), "measurement_id")


query(
    "partition_replace",
    """SELECT id, 'male' AS gender, DATE '2024-01-02' AS run_date FROM patients WHERE gender = 'male'
        UNION ALL SELECT id, 'unknown', DATE '2024-01-01' FROM patients WHERE c_custkey % 13 = 0""",
)(lambda t: _replaced(t))


def _replaced(t):
    """Load two run dates, then load the later one again with other rows."""
    path = scratch_path(t.spark, "raw")
    rows = t.raw("Patient")
    raw_append(rows, path)
    gender = j.text(j.json_path(F.col("raw"), "gender"))
    later = rows.filter((F.col(RUN_DATE_COLUMN) == F.lit(RUN_DATE).cast("date")) & (gender == "male"))
    raw_replace(later, path, RUN_DATE)
    return raw_read(t.spark, path).select(
        F.col("resource_id").alias("id"), gender.alias("gender"), F.col(RUN_DATE_COLUMN).alias("run_date")
    )


query("since_window", f"SELECT oid, l_shipdate AS last_updated FROM versions WHERE l_shipdate >= TIMESTAMP '{MARK}'")(
    lambda t: updated_since(t.timed("Observation"), mark()).select(F.col("resource_id").alias("oid"), "last_updated")
)


# ---- maintained tables -----------------------------------------------------------------------

NEWEST = "SELECT oid, max(l_shipdate) AS last_updated FROM versions GROUP BY oid"


def _maintained(t):
    """A keyed store of the versions known some days after the mark, then what arrived since the mark taken in."""
    newest = latest_version(t.raw("Observation")).select(F.col("resource_id").alias("oid"), "last_updated")
    # Read for what is known, for the folders and keys of what arrived, and for the comparison: documents are parsed once.
    newest = sinks.table_sink(newest, scratch_path(t.spark, "newest"))
    known = newest.filter(F.col("last_updated") < mark() + F.expr("interval 200 days")).withColumn("state", F.lit("stale"))
    arrived = newest.filter(F.col("last_updated") >= mark()).withColumn("state", F.lit("fresh"))
    store = KeyedStore(t.spark, scratch_path(t.spark, "maintained"), known.schema, "oid", 20_000)
    first = store.replace(known)
    changes = store.kept_changes(differences(store.rows_of(arrived, first), arrived, "oid", store.columns, store.place))
    return store, first, changes, store.take_in(changes, first)


query("maintained_versions", f"SELECT oid, last_updated, CASE WHEN last_updated >= TIMESTAMP '{MARK}' THEN 'fresh' ELSE 'stale' END AS state FROM ({NEWEST})")(
    lambda t: _maintained(t)[0].read()
)
query("pinned_version", f"SELECT oid, last_updated, 'stale' AS state FROM ({NEWEST}) WHERE last_updated < TIMESTAMP '{MARK}' + INTERVAL 200 DAY")(
    lambda t: (lambda store, first, *_: store.read(first))(*_maintained(t))
)
query(
    "change_kinds",
    f"""SELECT CASE WHEN last_updated < TIMESTAMP '{MARK}' + INTERVAL 200 DAY THEN 'changed' ELSE 'inserted' END AS kind, count(*) AS n_rows
        FROM ({NEWEST}) WHERE last_updated >= TIMESTAMP '{MARK}' GROUP BY 1""",
)(lambda t: _maintained(t)[2].rows.groupBy("kind").agg(F.count("*").alias("n_rows")))


def _moved(t):
    """Orders by month: every tenth customer's move to the next month, those of every eleventh are withdrawn."""
    orders = t.base("orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")
    )
    store = DayStore(t.spark, scratch_path(t.spark, "months"), orders.schema, "o_orderkey", "month", ["o_custkey"])
    first = store.replace(orders)
    touched = orders.filter("o_custkey % 10 = 0 or o_custkey % 11 = 0")
    new = touched.filter("o_custkey % 11 <> 0").withColumn("month", F.add_months("month", 1))
    changes = store.kept_changes(differences(store.rows_of(touched, first), new, "o_orderkey", store.columns, store.place))
    store.take_in(changes, first)
    return store.read()


query(
    "maintained_days",
    """SELECT o_orderkey, o_custkey, o_orderstatus,
        CAST(date_trunc('month', CAST(o_orderdate AS DATE)) + CASE WHEN o_custkey % 10 = 0 THEN INTERVAL 1 MONTH ELSE INTERVAL 0 MONTH END AS DATE) AS month
        FROM orders WHERE o_custkey % 11 <> 0""",
)(lambda t: _moved(t))

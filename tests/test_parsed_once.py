"""Queries that read observations several times scan and parse their documents once, and fail when a column was not stored."""

import datetime

import pytest
from pyspark.errors import PySparkException

from assaylake.plans.build import stored_once
from contract import load_queries, registry
from contract.adapter import Tables
from contract.queries_checks import staged_once


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Six orders of four lines each, every second line in two versions; years on both sides of the mark."""
    root = tmp_path_factory.mktemp("tables")

    def write(name, schema, rows):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")

    day = lambda i: datetime.datetime(1999, 1, 1) + datetime.timedelta(days=40 * i)
    write("region", "r_regionkey int, r_name string", [(0, "r")])
    write("nation", "n_nationkey int, n_name string, n_regionkey int", [(0, "n", 0)])
    write("customer", "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(i, f"c{i}", 0, "s") for i in range(3)])
    write("supplier", "s_suppkey long, s_name string", [(1, "s1")])
    write("part", "p_partkey long, p_name string, p_size int, p_retailprice double", [(i, f"p{i}", i, 1.0) for i in range(1, 9)])
    orders = [(i, i % 4, "F", day(i), "1-URGENT") for i in range(6)]
    write("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string", orders)
    lines = [
        (o, 1 + (o + n) % 8, 1, n, 2.0, 3.0, 0.1, 0.2, "AN"[n % 2] if n < 3 else "R", "F", day(o + later))
        for o in range(6) for n in range(1, 5) for later in range(1 + n % 2)
    ]
    kinds = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    write("lineitem", f"{kinds}, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp", lines)
    return str(root), len(lines)


NAMES = (
    "check_unique", "check_not_null", "check_relationship", "omop_validation_summary", "maintained_versions", "pinned_version", "change_kinds",
)


@pytest.mark.parametrize("name", NAMES)
def test_every_document_is_parsed_once(spark, folder, monkeypatch, name):
    root, versions = folder
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    tables, plain = Tables(spark, root), Tables(spark, root)
    lines = tables.lines("Observation")
    tables._frames["lines:Observation"] = lines.mapInArrow(counted, lines.schema)
    build = load_queries().QUERIES[name]
    monkeypatch.setattr(registry, "tables", lambda *_: tables)
    found = sorted(build(spark, root).collect(), key=str)
    assert seen.value == versions
    assert found
    if name in ("check_unique", "check_not_null", "check_relationship"):
        unshared = {"check_unique": "unique_checks", "check_not_null": "not_null_checks", "check_relationship": "person_relationship_checks"}
        from assaylake.quality import stages

        assert found == sorted(getattr(stages, unshared[name])(plain.ws).collect(), key=str)


def test_a_column_that_was_not_stored_cannot_be_read(spark, folder):
    once = staged_once(Tables(spark, folder[0]))
    assert once.model("stg_observation_lab").count() == 12
    with pytest.raises(PySparkException, match="observation_versions.loinc_code was not stored"):
        once.model("stg_observation_lab").select("loinc_code").collect()
    whole = stored_once(Tables(spark, folder[0]).ws, ["observation_versions"]).model("observation_versions")
    assert whole.filter("loinc_code is not null").count() > 0

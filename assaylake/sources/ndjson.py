"""Bulk-export landing files: ``<prefix>/<run date>/<Type>-NNNN.ndjson``.

An entry may be one file or a folder of parts, as distributed exporters write.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.functions.json import text
from assaylake.functions.scalars import required_cast
from assaylake.schemas.raw import FILE_URI, RUN_DATE

TYPE_IN_PATH = r"/([^/-]+)[^/]*\.ndjson(?:/[^/]*)?$"
_BLANK = " \t\r\n\f\x0b"
_ENVELOPE = "struct<id:variant,resourceType:variant,meta:struct<lastUpdated:variant>>"


def resource_type_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, TYPE_IN_PATH, 1), F.lit(""))


def landing_discover(spark: SparkSession, prefix: str, run_date: str) -> DataFrame:
    """(resource_type, path, length) of every landed file, in folders of the day too; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{prefix}/{run_date}")
    found = found.filter(F.col("path").rlike(r"\.ndjson(/[^/]*)?$"))
    return found.select(resource_type_of(F.col("path")).alias("resource_type"), "path", "length")


def ndjson_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(line, file_uri): one row per non-blank line, outer white space removed."""
    scanned = spark.read.text(path).select(
        F.btrim("value", F.lit(_BLANK)).alias("line"), F.col("_metadata.file_path").alias("file_uri")
    )
    return scanned.filter(F.col("line") != "")


def _parsed(lines: DataFrame) -> DataFrame:
    documents = lines.withColumn("raw", F.try_parse_json("line"))
    return documents.withColumn("envelope", F.try_variant_get("raw", "$", _ENVELOPE))


def raw_envelope(lines: DataFrame, run_date: Column | str) -> DataFrame:
    """Raw-table rows from (line, file_uri). A line that is no JSON object fails the job."""
    failure = F.raise_error(F.concat(F.lit("bad NDJSON line in "), F.col("file_uri")))
    checked = _parsed(lines).withColumn(
        "envelope", F.when(F.col("envelope").isNull(), failure).otherwise(F.col("envelope"))
    )
    return _rows(checked, run_date)


def timed_once(rows: DataFrame) -> DataFrame:
    """The same raw rows, parsed once however they are filtered by update time.

    Spark moves a filter below the columns it reads and repeats their expressions in it, here several parses of every
    document. No filter moves below the generator that hands on the update time; members nobody reads are still pruned.
    """
    others = [c for c in rows.columns if c != "last_updated"]
    return rows.select(*others, F.explode(F.array("last_updated")).alias("last_updated")).select(*rows.columns)


def raw_envelope_quarantined(lines: DataFrame, run_date: Column | str) -> tuple[DataFrame, DataFrame]:
    """(good raw rows, bad lines) for loads that set bad lines aside instead of failing."""
    parsed = _parsed(lines)
    good = parsed.filter(F.col("envelope").isNotNull())
    bad = parsed.filter(F.col("envelope").isNull()).select("line", "file_uri")
    return _rows(good, run_date), bad


def _rows(parsed: DataFrame, run_date: Column | str) -> DataFrame:
    day = F.lit(run_date) if isinstance(run_date, str) else run_date
    envelope = F.col("envelope")
    return parsed.select(
        F.coalesce(text(envelope["id"]), F.lit("")).alias("resource_id"),
        F.coalesce(text(envelope["resourceType"]), F.lit("")).alias("resource_type"),
        required_cast(text(envelope["meta"]["lastUpdated"]), "timestamp", "lastUpdated").alias("last_updated"),
        "raw",
        day.cast("date").alias(RUN_DATE),
        F.col("file_uri").alias(FILE_URI),
    )


def ndjson_scan(spark: SparkSession, prefix: str, run_date: str, resource_type: str) -> DataFrame:
    """Raw rows of one resource type landed on one day, in folders of the day too; other types' files are not opened."""
    found = landing_discover(spark, prefix, run_date).filter(F.col("resource_type") == resource_type)
    # Folders, not files, are listed for the read: as many as exporters made for the type.
    entry = F.regexp_extract("path", r"^(.*\.ndjson)(?:/[^/]*)?$", 1)
    paths = sorted(r[0] for r in found.select(entry).distinct().collect())
    if not paths:
        raise FileNotFoundError(f"no {resource_type} files under {prefix}/{run_date}")
    return raw_envelope(ndjson_lines(spark, paths), run_date)

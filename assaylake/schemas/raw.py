"""Layout of the raw tables, one per resource type."""

from pyspark.sql import types as T

RUN_DATE = "_ingest_run_date"
FILE_URI = "_ingest_file_uri"

RAW = T.StructType(
    [
        T.StructField("resource_id", T.StringType(), False),
        T.StructField("resource_type", T.StringType(), False),
        T.StructField("last_updated", T.TimestampType(), True),
        T.StructField("raw", T.VariantType(), False),
        T.StructField(RUN_DATE, T.DateType(), False),
        T.StructField(FILE_URI, T.StringType(), False),
    ]
)

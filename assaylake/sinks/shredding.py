"""Raw documents stored shredded: frequent members as Parquet columns of their own inside the VARIANT.

Each file's writer takes the members from its first rows. A member of another type than its column, and whatever is rare, stays
in the binary rest, so no document changes. Files may differ in what they shred, and older files may be whole.

Columns of one member compress far better than documents, and extractions pushed into the scan never build the
document again. Spark 4.1 still opens all member columns of a VARIANT, also for a query that extracts few of them.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import SparkSession

from assaylake.session import EXTRACT_IN_SCAN, settings


@contextlib.contextmanager
def raw_layout(spark: SparkSession) -> Iterator[None]:
    """Within the block, VARIANT columns are written shredded if the session was configured for it."""
    chosen = spark.conf.get(EXTRACT_IN_SCAN, "false")
    wanted = ("spark.sql.variant.writeShredding.enabled", "spark.sql.variant.inferShreddingSchema")
    with settings(spark, dict.fromkeys(wanted, chosen)):
        yield

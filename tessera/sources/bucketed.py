"""Cell tables stored in buckets of their coordinates.

Two tables of one shape that are written this way meet bucket by bucket: elementwise joins
(J1-J5) of them read, merge and move nothing. Worth it for operands that are used more than once, as
writing a table is one shuffle of its cells.
"""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession

from tessera.core import Cells
from tessera.session import remove_table, scratch_table_path

# About 100 MB of (bigint, bigint, double) cells, one file and one join task each.
CELLS_PER_BUCKET = 4_000_000
# Spark refuses tables of more buckets (spark.sql.sources.bucketing.maxBuckets).
MAX_BUCKETS = 100_000


def bucket_count(spark: SparkSession, shape: tuple[int, ...]) -> int:
    """Buckets of a table of this shape: equal shapes get equal counts, hence meet without a shuffle."""
    wanted = math.ceil(math.prod(shape) / CELLS_PER_BUCKET)
    return min(MAX_BUCKETS, max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def write_bucketed(a: Cells, name: str | None = None, buckets: int | None = None) -> tuple[Cells, str]:
    """Write ``a`` as a table bucketed and sorted by its coordinates, below the checkpoint folder;
    returns the stored matrix and the table's name (``drop_bucketed`` ends it).

    One file a bucket, so the sort order of a bucket is that of its file. Cells outside the shape and repeated
    cells are stored as they are.
    """
    spark = a.df.sparkSession
    name = name or f"cells_{uuid.uuid4().hex}"
    n = buckets or bucket_count(spark, a.shape)
    (a.select_cells().repartition(n, *a.coords).write.bucketBy(n, *a.coords).sortBy(*a.coords)
     .option("path", scratch_table_path(spark, name)).format("parquet").saveAsTable(name))
    return a.with_df(spark.table(name)), name


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Drop a table of ``write_bucketed`` and its files."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").collect()
    spark.sql(f"DROP TABLE {name}")
    remove_table(spark, rows[0]["data_type"])

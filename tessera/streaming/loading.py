"""Labelled CSV files as a stream: one stream, two sinks.

Files of a folder arrive through ``readStream``; every micro-batch goes through the loader's row-local
checks (``sources.csv.split_labeled``) and is written twice, accepted samples and rejects.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tessera.session import scratch_table_path
from tessera.sources.csv import CSV_OPTIONS, csv_schema, split_labeled


def load_labeled_stream(spark: SparkSession, folder: str, n_features: int = 4,
                        label_map: dict[str, int] | None = None, bad_number: str = "reject",
                        unknown: str = "keep", out: str | None = None,
                        files_per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Load every file of ``folder`` that no earlier run on ``out`` has loaded; returns the whole
    ``(samples, rejects)`` written so far, with the columns of ``read_labeled_csv``.

    * ``out`` holds the samples, the rejects and the stream's log; a new scratch folder by default.
      Called again with the same ``out``, only new files are read.
    * A batch is written to a folder of its own number, replaced when the batch is
      run again after a failure, so both sinks hold each line once.
    * ``files_per_batch`` bounds a batch; ``None`` takes all files that are there.
    * ``unknown='error'`` ends the stream at the first unknown label, as it ends the load.
    * No files: both results are empty.
    """
    out = out or scratch_table_path(spark, "csv-stream")
    good, bad = os.path.join(out, "samples"), os.path.join(out, "rejects")
    reader = spark.readStream.schema(csv_schema(n_features)).options(**CSV_OPTIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", str(int(files_per_batch)))

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # both sinks read the lines once
        try:
            samples, rejects = split_labeled(batch, n_features, label_map, bad_number, unknown)
            samples.write.mode("overwrite").parquet(os.path.join(good, f"batch={number}"))
            rejects.write.mode("overwrite").parquet(os.path.join(bad, f"batch={number}"))
        finally:
            batch.unpersist()

    (reader.csv(folder).writeStream.foreachBatch(write).option("checkpointLocation", os.path.join(out, "log"))
     .trigger(availableNow=True).start().awaitTermination())
    empty = spark.createDataFrame([], csv_schema(n_features))
    schemas = [part.schema for part in split_labeled(empty, n_features, label_map, bad_number, unknown)]
    found = [_written(spark, path, schema) for path, schema in zip((good, bad), schemas)]
    return found[0], found[1]


def _written(spark: SparkSession, path: str, schema) -> DataFrame:
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(conf).exists(where):  # no file, no batch
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)

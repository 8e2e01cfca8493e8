"""Scoring a stream of rows with a trained network.

The network's forward pass is row-local (``mapInArrow``), so it runs
unchanged on a streaming DataFrame: rows arrive through ``readStream``, are
scored batch by batch, and land in a parquet sink in the shared checkpoint
folder (exactly-once through the sink's own log). No state is kept.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.plans.mlp import mlp_predict
from tessera.session import scratch_table_path


def score_stream(stream: DataFrame, params, features: str | list[str], keep: list[str]) -> DataFrame:
    """The streaming form of ``mlp_predict`` (still lazy, still a stream)."""
    return mlp_predict(params, stream, features, keep=keep)


def predict_stream(spark: SparkSession, sf_dir: str, table: str,
                   featurize: Callable[[DataFrame], DataFrame], params,
                   keep: list[str], features: str | list[str] = "x") -> DataFrame:
    """Stream ``table`` from ``sf_dir`` through ``featurize`` and the network
    until all available input is processed; return the written result."""
    # a table is one file or a folder of part files; as a pattern (that matches only
    # itself) a file stream takes either
    path = os.path.join(sf_dir, f"{table}.parque")
    stream = spark.readStream.schema(spark.read.parquet(path + "t").schema).parquet(path + "[t]")
    scored = score_stream(featurize(stream), params, features, keep)
    out = scratch_table_path(spark, f"{table}-scored")
    query = (scored.writeStream.format("parquet")
             .option("path", out)
             .option("checkpointLocation", out + "-log")
             .trigger(availableNow=True)
             .start())
    query.awaitTermination()
    return spark.read.parquet(out)

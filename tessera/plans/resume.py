"""Saved states of a training run: tables in a folder, one subfolder an epoch.

A state counts once its ``done`` table is written, which comes last; a run that died while
writing leaves a subfolder without it, and the state before is taken."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _folders(spark: SparkSession, folder: str) -> list[int]:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(where):
        return []
    found = []
    for item in store.listStatus(where):
        name = re.fullmatch(r"epoch-(\d+)", item.getPath().getName())
        if name and store.exists(jvm.org.apache.hadoop.fs.Path(f"{item.getPath()}/done/_SUCCESS")):
            found.append(int(name[1]))
    return sorted(found)


def path(folder: str, epoch: int, table: str) -> str:
    return f"{folder}/epoch-{epoch:09d}/{table}"


def save(spark: SparkSession, folder: str, epoch: int, tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(path(folder, epoch, name))
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(path(folder, epoch, "done"))


def latest(spark: SparkSession, folder: str | None, most: int) -> int:
    """Epoch of the newest whole state up to ``most``, 0 if there is none."""
    return max((e for e in (_folders(spark, folder) if folder else []) if e <= most), default=0)


def load(spark: SparkSession, folder: str, epoch: int, table: str) -> DataFrame:
    return spark.read.parquet(path(folder, epoch, table))

"""Seeded permutation rank, exact train/validation split, row cap.

Both order rows by ``(b, keys...)`` where ``b = hash_bits(seed, keys)`` is a
52-bit hash of the (unique) keys — the integer behind ``u = b / 2**52`` — so
ties between equal hashes are broken by the keys. Buckets are bit prefixes of
``b``: even by construction, exact, and refinable. Neither operator needs a
global window over all rows:

* ``shuffle_rank`` counts a 12-bit prefix histogram (at most 4096 rows to the
  driver), picks a prefix length that leaves ~``ROWS_PER_BUCKET`` rows per
  bucket, turns bucket counts into offsets with a window over the count table,
  and ranks rows inside their own bucket only.
* ``train_val_split`` finds the bucket holding the cut from the same kind of
  histogram, refines it by 12 more bits while it is larger than
  ``RANK_MAX`` rows (one pass per level: one level up to ~8·10⁹ rows), ranks
  only that bucket to find the exact cut row, and then classifies every row
  with one lexicographic comparison — a projection.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.core import HASH_BITS, hash_bits, maybe_broadcast
from tessera.session import scratch_table_path

LEVEL_BITS = 12
ROWS_PER_BUCKET = 1_000_000
RANK_MAX = 2_000_000


def _prefix(bits: int) -> Column:
    return F.shiftright(F.col("_h"), HASH_BITS - bits)


def _lex_le(cols: list[str], vals: list) -> Column:
    """``(cols...) <= (vals...)`` in lexicographic order."""
    cond = F.col(cols[-1]) <= F.lit(vals[-1])
    for c, v in zip(reversed(cols[:-1]), reversed(vals[:-1])):
        cond = (F.col(c) < F.lit(v)) | ((F.col(c) == F.lit(v)) & cond)
    return cond


def _histogram(x: DataFrame, bits: int, where: Column | None = None) -> list[tuple[int, int]]:
    """Sorted ``(bucket, count)`` of a ``bits``-long prefix (≤ 4096 buckets
    below the given bucket, so the result is bounded)."""
    src = x if where is None else x.filter(where)
    rows = src.groupBy(_prefix(bits).alias("_bk")).agg(F.count(F.lit(1)).alias("_c")).collect()
    return sorted((int(r["_bk"]), int(r["_c"])) for r in rows)


def _hashed(df: DataFrame, keys: list[str], seed: int, hash_col: str | None) -> DataFrame:
    """Rows with the 52-bit draw ``_h``; a caller that persists its rows can
    store ``hash_bits(seed, keys)`` once and pass its name as ``hash_col``
    (the md5 is the costly part of every pass)."""
    return df.withColumn("_h", F.col(hash_col) if hash_col else hash_bits(seed, *keys))


def shuffle_rank(df: DataFrame, keys: list[str], seed: int, rank_col: str = "rank",
                 rows_per_bucket: int = ROWS_PER_BUCKET, hash_col: str | None = None) -> DataFrame:
    """Position (1-based) of every row in a seeded random permutation.

    ``keys`` must identify rows uniquely (ties of the hash are broken by them).
    """
    x = _hashed(df, keys, seed, hash_col)
    coarse = _histogram(x, LEVEL_BITS)
    biggest = max((c for _, c in coarse), default=0)
    extra = max(0, math.ceil(math.log2(max(1.0, biggest / rows_per_bucket))))
    bits = min(HASH_BITS, LEVEL_BITS + extra)
    xb = x.withColumn("_bk", _prefix(bits))
    counts = xb.groupBy("_bk").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bk", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    inner = Window.partitionBy("_bk").orderBy("_h", *keys)
    n_buckets = min(2 ** bits, sum(c for _, c in coarse))
    ranked = (xb.join(maybe_broadcast(offsets, n_buckets), "_bk")
              .withColumn(rank_col, F.col("_off") + F.row_number().over(inner)))
    return ranked.drop("_h", "_bk", "_off")


def train_val_split(df: DataFrame, keys: list[str], frac: float = 0.8, seed: int = 7,
                    flag_col: str = "is_train", rank_max: int = RANK_MAX,
                    hash_col: str | None = None) -> DataFrame:
    """Flag exactly ``floor(frac · n)`` rows as training rows (the first ones
    of the seeded permutation), the rest as validation rows.
    ``keys`` must identify rows uniquely."""
    if not 0.0 <= frac <= 1.0:
        raise ValueError("train_val_split: frac must be in [0, 1]")
    x = _hashed(df, keys, seed, hash_col)
    hist = _histogram(x, LEVEL_BITS)
    n = sum(c for _, c in hist)
    need = int(math.floor(frac * n))  # rows still to place in the current bucket
    if need == 0:
        return x.drop("_h").withColumn(flag_col, F.lit(False))
    bits, where = LEVEL_BITS, None
    while True:
        seen = 0
        for bucket, count in hist:
            if seen + count >= need:
                break
            seen += count
        need -= seen
        where = _prefix(bits) == F.lit(bucket)
        if count <= rank_max or bits >= HASH_BITS:
            break
        step = min(LEVEL_BITS, HASH_BITS - bits)
        bits += step
        hist = _histogram(x, bits, where)
    order = ["_h", *keys]
    cut = (x.filter(where).select(*order)
           .withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
           .filter(F.col("_rn") == need).select(*order).first())
    flag = _lex_le(order, [cut[c] for c in order])
    return x.withColumn(flag_col, flag).drop("_h")


def head(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Row cap (the loader's ``max_rows``): the first rows in partition order; no cap when ``None``.

    A count per partition gives every partition its share, so each keeps its
    own first rows and nothing is gathered in one task. Partitions of a scan are
    the same in both jobs. Those that come out of a shuffle need not be, so there
    each partition's first rows are numbered and written once, and the cut is a filter
    on what was written: exactly ``max_rows`` rows, the same ones on every read.
    """
    if max_rows is None:
        return df
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return _head_written(df, int(max_rows))
    sizes = dict(df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    share, _ = _shares(sizes, int(max_rows))

    def first(batches):
        from pyspark import TaskContext
        room = share.get(TaskContext.get().partitionId(), 0)
        for b in batches:
            if room <= 0:
                return
            yield b.slice(0, room)
            room -= b.num_rows

    return df.mapInArrow(first, df.schema)


def _shares(sizes: dict[int, int], max_rows: int) -> tuple[dict[int, int], int]:
    """Rows that each partition keeps, and the last partition that keeps any (-1: none)."""
    share, left, last = {}, max_rows, -1
    for p in sorted(sizes):
        if not left:
            break
        share[p], last = min(left, sizes[p]), p
        left -= share[p]
    return share, last


def _head_written(df: DataFrame, max_rows: int) -> DataFrame:
    """:func:`head` of rows numbered in one job: at most ``max_rows`` of a partition are written."""
    spark = df.sparkSession
    part, pos = "_part", "_pos"
    while {part, pos} & set(df.columns):
        part, pos = "_" + part, "_" + pos
    schema = T.StructType([*df.schema.fields, T.StructField(part, T.LongType()), T.StructField(pos, T.LongType())])

    def number(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        p, seen = TaskContext.get().partitionId(), 0
        for b in batches:
            b = b.slice(0, max_rows - seen)
            if not b.num_rows:
                return
            at = pa.array(range(seen, seen + b.num_rows), pa.int64())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([p] * b.num_rows, pa.int64()), at],
                                             names=[*b.schema.names, part, pos])
            seen += b.num_rows

    path = scratch_table_path(spark, "head")
    df.mapInArrow(number, schema).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    share, last = _shares(dict(rows.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect()), max_rows)
    keep = (F.col(part) < F.lit(last)) | ((F.col(part) == F.lit(last)) & (F.col(pos) < F.lit(share.get(last, 0))))
    return rows.filter(keep).drop(part, pos)


def split_sizes(df: DataFrame, flag_col: str = "is_train") -> DataFrame:
    return df.groupBy(flag_col).agg(F.count(F.lit(1)).alias("n"))

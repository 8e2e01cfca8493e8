"""Dense layer and Adam on a parameter table.

Parameter table (one row per weight): ``layer STRING, name STRING ('W' or
'b'), i INT, j INT, value, grad, m, v DOUBLE``; bias rows have ``i = 0``.
The Adam step counter ``t`` is an argument/return value. Parameters are
model-sized, so moving them to numpy for a row-local product is bounded by
the model, never by the data (checked against ``BROADCAST_CELLS``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.core import BROADCAST_CELLS, Cells, arrow_matrix, hash_uniform
from tessera.operators.linalg import col_sum, matmul, matmul_rows, matmul_wide
from tessera.operators.shape import transpose

PARAM_SCHEMA = T.StructType([
    T.StructField("layer", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("i", T.IntegerType()), T.StructField("j", T.IntegerType()),
    T.StructField("value", T.DoubleType()), T.StructField("grad", T.DoubleType()),
    T.StructField("m", T.DoubleType()), T.StructField("v", T.DoubleType())])


def linear_init(spark: SparkSession, layer: str, in_dim: int, out_dim: int, seed: int) -> DataFrame:
    """W uniform in [-1, 1) (unscaled, as in the reference), b and moments 0.

    ``W[i, j] = 2·u(seed, i·out_dim + j) - 1``: the same numbers for any
    partitioning and in plain SQL.
    """
    w = (spark.range(0, in_dim * out_dim)
         .select(F.lit(layer).alias("layer"), F.lit("W").alias("name"),
                 (F.col("id") / out_dim).cast("int").alias("i"),
                 (F.col("id") % out_dim).cast("int").alias("j"),
                 (F.lit(2.0) * hash_uniform(seed, "id") - F.lit(1.0)).alias("value")))
    b = (spark.range(0, out_dim)
         .select(F.lit(layer).alias("layer"), F.lit("b").alias("name"), F.lit(0).alias("i"),
                 F.col("id").cast("int").alias("j"), F.lit(0.0).alias("value")))
    zero = F.lit(0.0)
    return w.unionByName(b).select("layer", "name", "i", "j", "value",
                                   zero.alias("grad"), zero.alias("m"), zero.alias("v"))


def layer_arrays(params: DataFrame, layer: str | None, column: str = "value"):
    """``(W, b)`` of one layer as numpy, or ``{layer: (W, b)}`` for all layers
    when ``layer`` is None. One collect, model-sized and size-checked."""
    src = params if layer is None else params.filter(F.col("layer") == layer)
    rows = src.select("layer", "name", "i", "j", column).limit(BROADCAST_CELLS + 1).collect()
    if len(rows) > BROADCAST_CELLS:
        raise ValueError("parameters are too large to ship to tasks")
    found: dict[str, tuple[np.ndarray, np.ndarray]] = {}
    for name in sorted({r["layer"] for r in rows}):
        ws = [(r["i"], r["j"], r[column]) for r in rows if r["layer"] == name and r["name"] == "W"]
        bs = [(r["j"], r[column]) for r in rows if r["layer"] == name and r["name"] == "b"]
        if not ws:
            raise ValueError(f"no weights for layer {name}")
        W = np.zeros((max(i for i, _, _ in ws) + 1, max(j for _, j, _ in ws) + 1))
        for i, j, v in ws:
            W[i, j] = v
        b = np.zeros(W.shape[1])
        for j, v in bs:
            b[j] = v
        found[name] = (W, b)
    if layer is None:
        return found
    if layer not in found:
        raise ValueError(f"no weights for layer {layer}")
    return found[layer]


def params_from_arrays(spark: SparkSession, layers: dict[str, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    rows = []
    for name, (W, b) in layers.items():
        for i in range(W.shape[0]):
            for j in range(W.shape[1]):
                rows.append((name, "W", i, j, float(W[i, j]), 0.0, 0.0, 0.0))
        for j in range(len(b)):
            rows.append((name, "b", 0, j, float(b[j]), 0.0, 0.0, 0.0))
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def linear_forward(params: DataFrame, layer: str, x: DataFrame, key: str, col: str,
                   out: str = "out") -> DataFrame:
    """``X · W + b`` on packed rows; row-local, no shuffle. A layer above
    ``BROADCAST_CELLS`` weights stays a table and takes the grid product."""
    if layer_size(params, layer) > BROADCAST_CELLS:
        W, b = layer_cells(params, layer)
        return matmul_wide(x, key, col, W, b, out)
    W, b = layer_arrays(params, layer)
    return matmul_rows(x, key, col, W, b, out)


def layer_size(params: DataFrame, layer: str) -> int:
    return params.filter((F.col("layer") == layer) & (F.col("name") == "W")).count()


def layer_cells(params: DataFrame, layer: str, column: str = "value") -> tuple[Cells, Cells]:
    """``(W, b)`` of one layer as cell tables (any size)."""
    own = params.filter(F.col("layer") == layer)
    w, b = own.filter(F.col("name") == "W"), own.filter(F.col("name") == "b")
    top = w.agg(F.max("i").alias("i"), F.max("j").alias("j")).first()
    if top["i"] is None:
        raise ValueError(f"no weights for layer {layer}")
    shape = (top["i"] + 1, top["j"] + 1)
    return (Cells(w.select(F.col("i").cast("bigint").alias("c0"), F.col("j").cast("bigint").alias("c1"),
                           F.col(column).alias("value")), shape),
            Cells(b.select(F.col("j").cast("bigint").alias("c0"), F.col(column).alias("value")), shape[1:]))


def linear_backward(params: DataFrame, layer: str, x: DataFrame, dy: DataFrame | None, key: str,
                    x_col: str, dy_col: str) -> tuple[DataFrame, DataFrame]:
    """Gradients of one dense layer.

    Returns ``(grads, dx)``: ``grads`` has ``(layer, name, i, j, grad)`` with
    ``dW = Xᵀ·dY`` and ``db = Σ_rows dY`` (the reference overwrites, it does
    not accumulate); ``dx`` holds packed rows ``dY · Wᵀ``.

    ``X`` and ``dY`` meet on the row key (one join) — or, with ``dy=None``,
    ``dy_col`` is a column of ``x`` itself and no join is needed. Each task
    then reduces its rows to one ``(in+1) × out`` partial, so the final
    aggregation moves ``partitions × parameters`` numbers, independent of the
    number of rows.
    """
    if layer_size(params, layer) > BROADCAST_CELLS:
        return _backward_wide(params, layer, x, dy, key, x_col, dy_col)
    W, _ = layer_arrays(params, layer)
    d_in, d_out = W.shape
    if dy is None:
        joined = x.select(key, F.col(x_col).cast("array<double>").alias("_x"),
                          F.col(dy_col).cast("array<double>").alias("_dy"))
        dy = x
    else:
        joined = x.select(key, F.col(x_col).cast("array<double>").alias("_x")).join(
            dy.select(key, F.col(dy_col).cast("array<double>").alias("_dy")), key)
    schema = T.StructType([T.StructField("idx", T.LongType()), T.StructField("g", T.DoubleType())])

    def run(batches):
        acc = np.zeros((d_in + 1, d_out))
        seen = False
        for batch in batches:
            if batch.num_rows == 0:
                continue
            X = arrow_matrix(batch.column("_x"), d_in)
            G = arrow_matrix(batch.column("_dy"), d_out)
            acc[:d_in] += X.T @ G
            acc[d_in] += G.sum(axis=0)
            seen = True
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(acc.size, dtype=np.int64)), pa.array(acc.reshape(-1))],
                names=["idx", "g"])

    sums = joined.mapInArrow(run, schema).groupBy("idx").agg(F.sum("g").alias("grad"))
    row = (F.col("idx") / d_out).cast("int")
    grads = sums.select(F.lit(layer).alias("layer"),
                        F.when(row < d_in, F.lit("W")).otherwise(F.lit("b")).alias("name"),
                        F.when(row < d_in, row).otherwise(F.lit(0)).alias("i"),
                        (F.col("idx") % d_out).cast("int").alias("j"), "grad")
    dx = matmul_rows(dy, key, dy_col, W.T, None, "dx")
    return grads, dx


def _backward_wide(params, layer, x, dy, key, x_col, dy_col):
    """:func:`linear_backward` for a layer that is too large to ship: grid products of cells."""
    W, _ = layer_cells(params, layer)
    dy = x if dy is None else dy
    rows = x.agg(F.max(F.col(key).cast("bigint"))).first()[0]

    def cells(df, col, width):
        packed = df.select(F.col(key).cast("bigint").alias("c0"), F.posexplode(F.col(col).cast("array<double>"))
                           .alias("c1", "value"))
        return Cells(packed.select("c0", F.col("c1").cast("bigint").alias("c1"), "value"), (int(rows) + 1, width))

    X, G = cells(x, x_col, W.shape[0]), cells(dy, dy_col, W.shape[1])
    dw = matmul(transpose(X), G, method="block").df
    db = col_sum(G).df
    grads = dw.select(F.lit(layer).alias("layer"), F.lit("W").alias("name"), F.col("c0").cast("int").alias("i"),
                      F.col("c1").cast("int").alias("j"), F.col("value").alias("grad")).unionByName(
        db.select(F.lit(layer).alias("layer"), F.lit("b").alias("name"), F.lit(0).alias("i"),
                  F.col("c0").cast("int").alias("j"), F.col("value").alias("grad")))
    return grads, matmul_wide(dy, key, dy_col, transpose(W), None, "dx")


def apply_grads(params: DataFrame, grads: DataFrame) -> DataFrame:
    """Replace the ``grad`` column with new gradients (parameter-sized join)."""
    g = grads.select("layer", "name", "i", "j", F.col("grad").alias("_g"))
    return (params.join(g, ["layer", "name", "i", "j"], "left")
            .withColumn("grad", F.coalesce(F.col("_g"), F.col("grad"))).drop("_g"))


def adam_step(params: DataFrame, t: int, lr: float = 0.01, beta1: float = 0.9,
              beta2: float = 0.999, eps: float = 1e-8) -> tuple[DataFrame, int]:
    """One bias-corrected Adam update of every parameter; returns ``(params, t+1)``."""
    t1 = t + 1
    c1, c2 = 1.0 - beta1 ** t1, 1.0 - beta2 ** t1
    g = F.col("grad")
    m = F.lit(beta1) * F.col("m") + F.lit(1.0 - beta1) * g
    v = F.lit(beta2) * F.col("v") + F.lit(1.0 - beta2) * g * g
    step = F.lit(lr) * (F.col("_m") / F.lit(c1)) / (F.sqrt(F.col("_v") / F.lit(c2)) + F.lit(eps))
    out = (params.withColumn("_m", m).withColumn("_v", v)
           .select("layer", "name", "i", "j", (F.col("value") - step).alias("value"), "grad",
                   F.col("_m").alias("m"), F.col("_v").alias("v")))
    return out, t1


def adam_numpy(w: np.ndarray, g: np.ndarray, m: np.ndarray, v: np.ndarray, t: int,
               lr: float, beta1: float, beta2: float, eps: float):
    """The same update on driver-held arrays (used by the training loop)."""
    t1 = t + 1
    m = beta1 * m + (1.0 - beta1) * g
    v = beta2 * v + (1.0 - beta2) * g * g
    w = w - lr * (m / (1.0 - beta1 ** t1)) / (np.sqrt(v / (1.0 - beta2 ** t1)) + eps)
    return w, m, v, t1

"""The row-local scorer runs unchanged on a stream."""

from matrix_help import SF001
from tessera.plans import mlp, suite
from tessera.streaming.scoring import predict_stream


def test_stream_equals_batch(spark):
    stats = suite.lineitem_stats(spark, SF001)
    params = suite._fixed_params(spark)
    keep = ["l_orderkey", "l_linenumber"]
    streamed = predict_stream(spark, SF001, "lineitem", lambda df: suite.lineitem_features(df, stats),
                              params, keep=keep)
    batch = mlp.mlp_predict(params, suite._lineitem_xy(spark, SF001), "x", keep=keep)
    # batch boundaries differ between the two, so BLAS may round the last bit
    # differently: compare to 12 digits
    def norm(rows):
        return sorted(tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in rows)
    a, b = norm(streamed.collect()), norm(batch.collect())
    assert a == b and len(a) == 6000


def test_cell_projections_run_on_a_stream(spark):
    """Stateless cell operators (scale, relu, gelu, dropout) are projections,
    so a streaming cell table goes through them unchanged."""
    from tessera.core import Cells
    from tessera.operators import elementwise as ew
    from tessera.session import scratch_table_path
    from tessera.sources.packing import rows_to_cells

    emb_schema = spark.read.parquet(f"{SF001}/embeddings.parquet").schema
    stream = spark.readStream.schema(emb_schema).option("pathGlobFilter", "embeddings.parquet") \
        .parquet(SF001)
    cells = rows_to_cells(stream, "vec_id", "embedding", n_rows=500, width=64)
    out_cells = ew.dropout(ew.gelu(ew.relu(ew.scale(cells, 2.0))), 0.1, 3)
    out = scratch_table_path(spark, "stream-cells")
    q = (out_cells.df.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", out + "-log").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    batch = rows_to_cells(spark.read.parquet(f"{SF001}/embeddings.parquet"), "vec_id", "embedding",
                          n_rows=500, width=64)
    want = ew.dropout(ew.gelu(ew.relu(ew.scale(batch, 2.0))), 0.1, 3).df
    assert got.count() == 500 * 64
    assert got.exceptAll(want).count() == 0
    assert isinstance(out_cells, Cells)

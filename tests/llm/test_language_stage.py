"""The pipeline's first stage gives its languages on to the mixing."""

from pyspark.sql import functions as F

from tessera.llm import langid, mixing

SF = "/root/testdata/sf0.01"


def test_mixing_goes_by_the_language_found(spark):
    """Labels that are missing or wrong in the held-out rows, which the network never learns from, do not reach the mixing."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    spoilt = docs.withColumn("lang", F.when(langid.held_out(), F.when(F.col("doc_id") % 2 == 0, "xx")).otherwise(F.col("lang")))
    out = corpus_pipeline.language(spark, spoilt, "")
    assert out.schema == docs.schema
    found = {r["doc_id"]: r["lang"] for r in out.collect()}
    want = {r["doc_id"]: r["lang"] for r in docs.where(langid.held_out()).collect()}
    assert want and sum(found[i] == v for i, v in want.items()) > 0.97 * len(want)
    cells = {r[0] for r in mixing.marked(out).select("_language").distinct().collect()}
    assert cells == {r[0] for r in docs.select("lang").distinct().collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # the network reads a text once

"""Very long payloads and texts, and empty tables, through the archive, the mixture and the pipeline."""

import hashlib

import pytest

from tessera.llm import mixing, warc

SF = "/root/testdata/sf0.001"


def test_archive_of_very_long_payloads(spark):
    big = "<p>größer als ein Puffer</p>\r\n\r\n" * 200_000
    rows = [(1, "http://a/", big), (2, "http://b/", big), (3, "http://c/", big[:-1] + "x")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r["page_id"]: r for r in warc.report(df).collect()}
    for k, _, html in rows:
        payload = html.encode()
        assert got[k]["payload_bytes"] == len(payload) > 5_000_000
        assert got[k]["payload_digest"] == hashlib.sha1(payload).hexdigest()
    assert [(got[k]["record_type"], got[k]["refers_to"]) for k in (1, 2, 3)] == [
        ("revisit", 2), ("response", None), ("response", None)]


def test_sample_of_an_empty_table(empty):
    got = mixing.sample(empty)
    assert got.columns == empty.columns and got.count() == 0


@pytest.fixture
def folder(tmp_path):
    def write(docs):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        return str(tmp_path)
    return write


def test_pipeline_of_an_empty_table(spark, folder):
    import corpus_pipeline
    sf = folder(spark.read.parquet(f"{SF}/documents.parquet").limit(0))
    got = corpus_pipeline.run(spark, sf)
    assert got.count() == 0 and {"doc_id", "piece", "sequence_id"} <= set(got.columns)


def test_pipeline_stages_of_a_very_long_text(spark):
    """A text of 2 MB in many words passes the language and near-duplicate stages whole; its copy goes."""
    import corpus_pipeline
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(20)
    first = docs.first()
    long = " ".join(f"word{k * 7919 % 100_003} of" for k in range(160_000))
    extra = [{**first.asDict(), "doc_id": 10 ** 7 + k, "text": long} for k in (0, 1)]
    both = docs.union(spark.createDataFrame(extra, docs.schema)).repartition(2)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, stages["language"](spark, both, ""), "")
    assert kept.columns == docs.columns
    left = {r["doc_id"]: r["text"] for r in kept.where(f"doc_id >= {10 ** 7}").collect()}
    assert left == {10 ** 7: long}

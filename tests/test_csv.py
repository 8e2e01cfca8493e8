"""Labelled CSV loading with malformed rows (FIXTURES.md §3)."""

import os
import tempfile

import pytest

from tessera.sources.csv import read_labeled_csv

BAD = ("Id,a,b,c,d,Species\n"
       "1,5.1,3.5,1.4,0.2,Iris-setosa\r\n"
       "2,,3.0,1.4,0.2,Iris-virginica\n"
       "3,x,3.0,1.4,0.2,weird\n"
       "4,1,2\n")


@pytest.fixture(scope="module")
def bad_csv():
    d = tempfile.mkdtemp(prefix="tessera-csv-", dir="/tmp")
    p = os.path.join(d, "samples_bad.csv")
    with open(p, "w", newline="") as f:
        f.write(BAD)
    return p


def test_default_mode_rejects(spark, bad_csv):
    samples, rejects = read_labeled_csv(spark, bad_csv)
    rows = samples.collect()
    assert [(r["id"], r["f0"], r["f3"], r["label"]) for r in rows] == [("1", 5.1, 0.2, 0)]
    reasons = {r["id"]: r["reason"] for r in rejects.collect()}
    assert reasons == {"2": "empty field", "3": "bad number", "4": "missing label"}


def test_zero_mode_reads_junk_as_zero(spark, bad_csv):
    samples, rejects = read_labeled_csv(spark, bad_csv, bad_number="zero")
    got = {r["id"]: (r["f0"], r["label"]) for r in samples.collect()}
    assert got == {"1": (5.1, 0), "3": (0.0, -1)}
    assert {r["id"] for r in rejects.collect()} == {"2", "4"}


def test_unknown_drop_and_cap(spark, bad_csv):
    samples, _ = read_labeled_csv(spark, bad_csv, bad_number="zero", unknown="drop")
    assert [r["id"] for r in samples.collect()] == ["1"]
    capped, _ = read_labeled_csv(spark, bad_csv, bad_number="zero", max_rows=1)
    assert capped.count() == 1


def test_unknown_error(spark, bad_csv):
    samples, _ = read_labeled_csv(spark, bad_csv, bad_number="zero", unknown="error")
    with pytest.raises(Exception):
        samples.collect()


def test_broken_lines_of_several_files(spark, tmp_path):
    """One header in each part file, none among the rows, and as many files as the input has partitions."""
    import glob

    from matrix_help import SF001
    from tessera.plans import suite
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    sf = str(tmp_path)
    li.repartition(5).write.parquet(f"{sf}/lineitem.parquet")
    want = sorted(tuple(r) for r in suite.q_read_labeled_csv_rejects(spark, SF001).collect())
    assert want and sorted(tuple(r) for r in suite.q_read_labeled_csv_rejects(spark, sf).collect()) == want
    path = suite._broken_lines(spark, sf).removeprefix("file:")
    lines = [open(p).read().splitlines() for p in glob.glob(f"{path}/part-*")]
    assert len(lines) > 1 and sum(map(len, lines)) == li.count() + len(lines)
    assert all(x[0] == "id,a,b,c,d,name" and "id,a,b,c,d,name" not in x[1:] for x in lines)
    assert not any('"' in line for x in lines for line in x)


def test_line_breaks_end_a_label_only(spark):
    """Trailing breaks are cut, those inside stay; a label without any is taken as it is."""
    from tessera.sources.csv import split_labeled
    names = ["x", "x\r", "x\r\n\r", "x\ny", "x\ry\n", "\r\n", "", None]
    raw = spark.createDataFrame([(str(i), "1", n, None) for i, n in enumerate(names)],
                                "id string, c0 string, label_name string, _corrupt string")
    samples, rejects = split_labeled(raw, 1, {"x": 4})
    got = {int(r["id"]): (r["label_name"], r["label"]) for r in samples.collect()}
    assert got == {0: ("x", 4), 1: ("x", 4), 2: ("x", 4), 3: ("x\ny", -1), 4: ("x\ry", -1)}
    assert {(r["id"], r["reason"]) for r in rejects.collect()} == {(i, "missing label") for i in "567"}

"""Labelled CSV loading and label encoding.

Layout read (as in the reference's loader): a header line, then per row an id
(dropped), ``n_features`` numbers and a trailing class name. Unlike the
reference, a malformed row never ends the load: it goes to a rejects table
with a reason, and loading continues.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.core import maybe_broadcast
from tessera.operators.split import head

# Class names and codes of the reference's training program.
IRIS_LABELS = {"Iris-setosa": 0, "Iris-versicolor": 1, "Iris-virginica": 2}

UNKNOWN_CODE = -1
# Above this many names the mapping is joined as a table instead of a CASE chain.
_CASE_LIMIT = 64
# Numeric prefix, as C's atof reads it ("5.1x" -> 5.1).
_NUMBER_PREFIX = r"^\s*([+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?)"


def encode_labels(df: DataFrame, col: str, mapping: dict[str, int], out: str = "label") -> DataFrame:
    """Map class names to integer codes; an unknown name (or NULL) gets -1."""
    if not mapping:
        return df.withColumn(out, F.lit(UNKNOWN_CODE))
    if len(mapping) <= _CASE_LIMIT:
        expr = reduce(lambda acc, kv: acc.when(F.col(col) == F.lit(kv[0]), F.lit(int(kv[1]))),
                      list(mapping.items())[1:],
                      F.when(F.col(col) == F.lit(next(iter(mapping))),
                             F.lit(int(next(iter(mapping.values()))))))
        return df.withColumn(out, F.coalesce(expr, F.lit(UNKNOWN_CODE)).cast("int"))
    spark = df.sparkSession
    table = spark.createDataFrame([(k, int(v)) for k, v in mapping.items()], ["_name", "_code"])
    joined = df.join(maybe_broadcast(table, len(mapping)), df[col] == F.col("_name"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_code"), F.lit(UNKNOWN_CODE)).cast("int")) \
        .drop("_name", "_code")


def _parse_number(raw: Column, bad_number: str) -> Column:
    s = F.trim(raw)
    exact = s.try_cast("double")
    if bad_number == "reject":
        return exact
    prefix = F.regexp_extract(s, _NUMBER_PREFIX, 1)
    return F.coalesce(exact, F.when(prefix != "", prefix.try_cast("double")), F.lit(0.0))


def read_labeled_csv(spark: SparkSession, path: str, n_features: int = 4,
                     label_map: dict[str, int] | None = None, bad_number: str = "reject",
                     unknown: str = "keep", max_rows: int | None = None,
                     ) -> tuple[DataFrame, DataFrame]:
    """Load ``id, f0..f{n-1}, label`` rows; returns ``(samples, rejects)``; rejects are
    ``(id, reason, line)`` with the row as it was read.

    * ``bad_number='reject'`` (default): a field that is not a number rejects
      the row; ``'zero'`` reads a numeric prefix like ``atof`` (junk -> 0.0).
      An empty field always rejects the row.
    * ``unknown``: ``'keep'`` (code -1, the reference's behaviour), ``'drop'``
      or ``'error'``.
    * ``max_rows``: cap on accepted samples (the reference's array size).
    """
    raw = spark.read.schema(csv_schema(n_features)).options(**CSV_OPTIONS).csv(path)
    samples, rejects = split_labeled(raw, n_features, label_map, bad_number, unknown)
    return head(samples, max_rows), rejects


# malformed lines are kept, one line is one row
CSV_OPTIONS = {"header": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "multiLine": "false"}


def csv_schema(n_features: int) -> str:
    """Exactly id, features and label: a row with another number of fields is kept
    whole in the corrupt-record column, its values are never shifted."""
    return ", ".join(f"{c} string" for c in ("id", *[f"c{i}" for i in range(n_features)], "label_name", "_corrupt"))


def split_labeled(raw: DataFrame, n_features: int = 4, label_map: dict[str, int] | None = None,
                  bad_number: str = "reject", unknown: str = "keep") -> tuple[DataFrame, DataFrame]:
    """``(samples, rejects)`` of lines read by ``csv_schema``; row-local, so for streams too."""
    if bad_number not in ("reject", "zero") or unknown not in ("keep", "drop", "error"):
        raise ValueError("read_labeled_csv: bad mode")
    label_map = IRIS_LABELS if label_map is None else label_map
    id_c, feat_c, label_c = "id", [f"c{i}" for i in range(n_features)], "label_name"
    breaks = F.contains(F.col(label_c), F.lit("\r")) | F.contains(F.col(label_c), F.lit("\n"))
    label_txt = F.when(breaks, F.regexp_replace(F.col(label_c), r"[\r\n]+$", "")).otherwise(F.col(label_c))
    feats = [_parse_number(F.col(c), bad_number).alias(f"f{i}") for i, c in enumerate(feat_c)]
    empty = [F.col(c).isNull() | (F.trim(F.col(c)) == "") for c in feat_c]
    line = F.coalesce("_corrupt", F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("")) for c in (id_c, *feat_c, label_c)]))
    parsed = raw.select(F.col(id_c).alias("id"), *feats, label_txt.alias("label_name"), "_corrupt",
                        line.alias("line"), reduce(lambda a, b: a | b, empty).alias("_empty"))
    bad_num = reduce(lambda a, b: a | b, [F.col(f"f{i}").isNull() for i in range(n_features)])
    missing = F.col("label_name").isNull() | (F.col("label_name") == "")
    reason = (F.when(missing, F.lit("missing label"))
              .when(F.col("_corrupt").isNotNull(), F.lit("too many fields"))
              .when(F.col("_empty"), F.lit("empty field"))
              .when(bad_num, F.lit("bad number")))
    tagged = parsed.withColumn("_reason", reason)
    rejects = tagged.filter(F.col("_reason").isNotNull()).select(
        "id", F.col("_reason").alias("reason"), "line")
    samples = encode_labels(tagged.filter(F.col("_reason").isNull()), "label_name", label_map)
    if unknown == "drop":
        samples = samples.filter(F.col("label") != UNKNOWN_CODE)
    elif unknown == "error":
        samples = samples.withColumn(
            "label", F.when(F.col("label") == UNKNOWN_CODE,
                            F.raise_error(F.concat(F.lit("unknown label: "), F.col("label_name"))))
            .otherwise(F.col("label")).cast("int"))
    samples = samples.select("id", *[f"f{i}" for i in range(n_features)], "label_name", "label")
    return samples, rejects

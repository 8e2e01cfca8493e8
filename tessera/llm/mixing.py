"""Operator 8: mixing sources to target weights by iterative proportional fitting, in
DataFrame operations only.

Token counts are added up by (source, language, topic). The cell weights are then raked: scaled
to the target of each source, of each language and of each topic in turn, ``ROUNDS`` times.
A cell's documents are drawn with the probability that makes its expected tokens proportional to
its raked weight. The scale is set by a token budget, a share of all tokens: cells that would need
a probability above 1 are taken whole, and what they lack is spread over the others by their weights
(:func:`fill_scale`). Without a budget, as in :func:`report` and its SQL, the largest probability is 1:
the sample meets the weights without repeating a document, but its smallest cell sets its size.
Draws are hashes of the id and the seed, the same however the data is laid out or a task is repeated.

Targets default to tempered shares (tokens to the power of ``TEMPER``, normalised); any table
(value, weight) can stand in. The topic is a column expression; by default the text's form
(:func:`text_form`).

Defined cases: null source or language is the value ``(none)``; null text is empty; a cell without tokens has
probability 0; rows with equal ids are drawn together; an empty table gives an empty result;
columns of the input are kept only by :func:`sample`; a column that already has one of
the added names is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.core import hash_uniform, hash_uniform_sql
from tessera.llm.common import written

DIMENSIONS = ("source", "language", "topic")
TEMPER = {"source": 0.5, "language": 0.5, "topic": 0.7}
ROUNDS = 20
SEED = 41
#: Expected tokens of a sample, as a share of all tokens.
BUDGET = 0.5
NONE = "(none)"
WORD = r"[^\x20\x09-\x0D]+"
#: Cells up to which the raking stays in one partition and the cell table is broadcast; more
#: cells are shuffled and joined like any table, with the same result.
SMALL_CELLS = 50_000
_ADDED = ("_source", "_language", "_topic", "n_tokens", "probability", "sampled")


def text_form(text: Column, words: Column) -> Column:
    """Topic by the text's form: notice, short, long or prose."""
    return (F.when(F.lower(text).contains("license"), "notice").when(words < 100, "short")
            .when(words >= 1000, "long").otherwise("prose"))


def labelled(docs: DataFrame, topic: Callable[[Column, Column], Column] = text_form) -> DataFrame:
    """``docs`` (doc_id, text, lang, source) with _source, _language, _topic and n_tokens."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.regexp_count(text, F.lit(WORD)).cast("bigint")
    base = docs.drop(*_ADDED).withColumn("n_tokens", words)
    return base.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit(NONE)),
        "_language": F.coalesce(F.col("lang").cast("string"), F.lit(NONE)),
        "_topic": F.coalesce(topic(text, F.col("n_tokens")), F.lit(NONE))})


def default_targets(cells: DataFrame) -> dict[str, DataFrame]:
    """(value, weight) of each dimension: tempered token shares."""
    out = {}
    for d in DIMENSIONS:
        sums = cells.groupBy(F.col(d).alias("value")).agg(F.sum("tokens").alias("t"))
        out[d] = sums.where("t > 0").select("value", F.pow(F.col("t").cast("double"), F.lit(TEMPER[d])).alias("weight"))
    return out


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``cells`` (source, language, topic, tokens) with ``weight``, raked to the targets. Values without a target
    have weight 0; targets of values without cells are left out of the normalisation."""
    few = cells.count() <= SMALL_CELLS
    out = cells.withColumn("weight", F.col("tokens").cast("double"))
    for d in DIMENSIONS:
        t = targets[d].select(F.col("value").alias(d), F.col("weight").cast("double").alias("share"))
        t = t.join(cells.where("tokens > 0").select(d).distinct(), d)
        total = t.agg(F.sum("share")).first()[0] or 1.0
        t = t.select(d, (F.col("share") / F.lit(float(total))).alias(f"to_{d}"))
        out = out.join(t, d, "left").withColumn(f"to_{d}", F.coalesce(f"to_{d}", F.lit(0.0)))
    out = written(out.coalesce(1) if few else out, "rake")
    for start in range(0, rounds, 5):
        out = out.coalesce(1) if few else out
        for _ in range(start, min(start + 5, rounds)):
            for d in DIMENSIONS:
                has = F.sum("weight").over(Window.partitionBy(d))
                out = out.withColumn("weight", F.when(has > 0, F.col("weight") * F.col(f"to_{d}") / has).otherwise(0.0))
        out = written(out, "rake")
    return out


def fill_scale(rated: DataFrame, budget: float) -> float:
    """The scale at which ``rated`` (tokens, weight, ratio) cells drawn with probability least(1, scale * ratio)
    hold ``budget`` of all tokens in expectation, or all tokens with a weight if those are fewer. Each step
    takes the cells that the last scale filled as whole and sets the scale of the others; it only
    grows, so it ends when no further cell is filled."""
    wanted = budget * float(rated.agg(F.sum("tokens")).first()[0] or 0)
    scale, filled = 0.0, -1
    while True:
        full = F.col("ratio") * F.lit(scale) >= 1
        n, held, rest = rated.agg(F.count(F.when(full, 1)), F.sum(F.when(full, F.col("tokens"))),
                                  F.sum(F.when(~full, F.col("weight")))).first()
        if n == filled or not rest:
            return scale
        scale, filled = max(scale, (wanted - (held or 0)) / rest), n


def probabilities(cells: DataFrame, targets: dict[str, DataFrame] | None = None, rounds: int = ROUNDS,
                  budget: float | None = None) -> DataFrame:
    """``cells`` with raked weight and drawing probability."""
    cells = written(cells, "cells")
    raked = rake(cells, targets or default_targets(cells), rounds)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    rated = raked.select(*DIMENSIONS, "tokens", "weight", ratio.alias("ratio"))
    if budget is None:
        top = rated.agg(F.max("ratio")).first()[0]
        share = F.col("ratio") / F.lit(float(top)) if top else F.lit(0.0)
    else:
        share = F.least(F.lit(1.0), F.col("ratio") * F.lit(fill_scale(rated, budget)))
    return rated.select(*DIMENSIONS, "tokens", "weight", share.alias("probability"))


def marked(docs: DataFrame, targets: dict[str, DataFrame] | None = None,
           topic: Callable[[Column, Column], Column] = text_form, rounds: int = ROUNDS, seed: int = SEED,
           budget: float | None = BUDGET) -> DataFrame:
    """``docs`` with _source, _language, _topic, n_tokens, probability and sampled."""
    rows = labelled(docs, topic)
    cells = rows.groupBy(*[F.col(f"_{d}").alias(d) for d in DIMENSIONS]).agg(F.sum("n_tokens").alias("tokens"))
    table = written(probabilities(cells, targets, rounds, budget).select(
        *[F.col(d).alias(f"_{d}") for d in DIMENSIONS], "probability"), "probabilities")
    if table.count() <= SMALL_CELLS:
        table = F.broadcast(table)
    out = rows.join(table, [f"_{d}" for d in DIMENSIONS])
    return out.withColumn("sampled", hash_uniform(seed, "doc_id") < F.col("probability"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, columns as they were."""
    return marked(docs, **options).where("sampled").select(*[c for c in docs.columns if c not in _ADDED])


def report(docs: DataFrame) -> DataFrame:
    """Every document's cell, tokens, probability and draw, without a budget."""
    return marked(docs, budget=None).select("doc_id", *[F.col(f"_{d}").alias(d) for d in DIMENSIONS], "n_tokens",
                               F.round("probability", 9).alias("probability"), "sampled")


def oracle_sql(rounds: int = ROUNDS, seed: int = SEED) -> str:
    """DuckDB statement for :func:`report` over ``documents``."""
    steps = [f"""d AS (SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS language,
        coalesce(text, '') AS t, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS n_tokens
        FROM documents)""",
             """r AS (SELECT doc_id, source, language, n_tokens, CASE WHEN contains(lower(t), 'license') THEN 'notice'
        WHEN n_tokens < 100 THEN 'short' WHEN n_tokens >= 1000 THEN 'long' ELSE 'prose' END AS topic FROM d)""",
             "c AS (SELECT source, language, topic, CAST(sum(n_tokens) AS DOUBLE) AS tokens FROM r GROUP BY ALL)"]
    for d in DIMENSIONS:
        steps.append(f"s_{d} AS (SELECT {d}, pow(sum(tokens), {TEMPER[d]}) AS s FROM c GROUP BY {d} HAVING sum(tokens) > 0)")
        steps.append(f"t_{d} AS (SELECT {d}, s / (SELECT sum(s) FROM s_{d}) AS to_{d} FROM s_{d})")
    joins = " ".join(f"LEFT JOIN t_{d} USING ({d})" for d in DIMENSIONS)
    steps.append(f"w0 AS (SELECT source, language, topic, tokens, tokens AS w, "
                 f"{', '.join(f'coalesce(to_{d}, 0) AS to_{d}' for d in DIMENSIONS)} FROM c {joins})")
    k = 0
    for _ in range(rounds):
        for d in DIMENSIONS:
            steps.append(f"w{k + 1} AS MATERIALIZED (SELECT * REPLACE (CASE WHEN sum(w) OVER (PARTITION BY {d}) > 0 THEN "
                         f"w * to_{d} / sum(w) OVER (PARTITION BY {d}) ELSE 0 END AS w) FROM w{k})")
            k += 1
    steps.append(f"q AS (SELECT source, language, topic, CASE WHEN tokens > 0 THEN w / tokens ELSE 0 END AS ratio FROM w{k})")
    return f"""WITH {', '.join(steps)}
        SELECT doc_id, source, language, topic, n_tokens,
            round(CASE WHEN m.top > 0 THEN ratio / m.top ELSE 0 END, 9) AS probability,
            {hash_uniform_sql(seed, 'doc_id')} < CASE WHEN m.top > 0 THEN ratio / m.top ELSE 0 END AS sampled
        FROM r JOIN q USING (source, language, topic) CROSS JOIN (SELECT max(ratio) AS top FROM q) m"""

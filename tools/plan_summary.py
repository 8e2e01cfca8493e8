"""Summarise the physical plan every registered query would run at scale.

``python tools/plan_summary.py /root/testdata/sf0.01`` prints a markdown table:
shuffles, broadcasts, join strategies, windows and Arrow (Python) stages.

The test tables are single parquet row groups and tiny, so locally Spark
skips exchanges for one-partition inputs and broadcasts every small table on
its own. For the table the static plan is shown with automatic broadcasts off
(``autoBroadcastJoinThreshold=-1``, AQE off): what remains broadcast is only
what the library hints itself, on sizes it has proven.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def static_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue().split("\n\n")[0]  # the tree only


def summary(tree: str) -> dict[str, int]:
    def n(pattern):
        return len(re.findall(pattern, tree))
    return {
        "shuffles": n(r"(?<![A-Za-z])Exchange \("),
        "reused": n(r"ReusedExchange \("),
        "broadcasts": n(r"BroadcastExchange \("),
        "smj": n(r"SortMergeJoin"),
        "bhj": n(r"BroadcastHashJoin"),
        "shj": n(r"ShuffledHashJoin"),
        "windows": n(r"\bWindow \("),
        "arrow": n(r"MapInArrow \("),
        "scans": n(r"Scan parquet"),
    }


def main() -> None:
    from tessera import build_session
    from tessera.plans.suite import QUERIES
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    cols = ["shuffles", "reused", "broadcasts", "smj", "bhj", "shj", "windows", "arrow", "scans"]
    print("| query | " + " | ".join(cols) + " |")
    print("| --- |" + " --- |" * len(cols))
    only = set(sys.argv[2:])
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        if name in ("mlp_train", "mlp_predict_stream"):
            continue
        s = summary(static_plan(fn(spark, sf)))
        print(f"| {name} | " + " | ".join(str(s[c]) for c in cols) + " |", flush=True)


if __name__ == "__main__":
    main()

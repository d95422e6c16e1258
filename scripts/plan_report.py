"""Shape of the final (AQE) physical plan of each pipeline stage on parquet
inputs: shuffles, broadcasts, join kinds, windows, generators.

usage: python scripts/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from tallymart.operators.mart import summary, summary_onepass  # noqa: E402
from tallymart.operators.quality import evaluate  # noqa: E402
from tallymart.plans.fixture import FIXTURE, tally_bronze  # noqa: E402
from tallymart.plans.medallion import clean_bronze, gold, gold_checks, silver  # noqa: E402
from tallymart.session import local_session, materialize  # noqa: E402

NODES = {
    "shuffles": r"Exchange hashpartitioning|Exchange SinglePartition|Exchange rangepartitioning",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "generates": r"Generate ",
    "hash aggregates": r"HashAggregate\(",
}


def shape(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    parts = [f"{len(re.findall(p, final))} {k}" for k, p in NODES.items() if re.findall(p, final)]
    skew = " (skew split)" if "skew=true" in final else ""
    return ", ".join(parts) + skew


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 8)
    bronze = materialize(clean_bronze(tally_bronze(spark, sf_dir), FIXTURE), "plan-bronze")
    silver_df = materialize(silver(bronze, FIXTURE), "plan-silver")
    tables = gold(silver_df, FIXTURE)
    rows = [
        ("silver (normalise + classify + expand)", silver(bronze, FIXTURE)),
        ("gates (evaluate, 5 rules)", evaluate(silver_df, FIXTURE.rules)),
        ("mart, pivot + join", summary(silver_df, FIXTURE.summary)),
        ("mart, one pass", summary_onepass(silver_df, FIXTURE.summary)),
        ("dim_mesa", tables["dim_mesa"]),
        ("fact", tables["fact_resultados"]),
        ("gold key checks (8 tables, 5 FKs)", gold_checks(tables, FIXTURE)),
    ]
    for name, df in rows:
        print(f"| {name} | {shape(df)} |")
    spark.stop()


if __name__ == "__main__":
    main()

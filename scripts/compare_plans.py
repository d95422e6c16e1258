"""

usage: python scripts/compare_plans.py [sf_dir] [runs]
Prints one line per comparison with the median seconds of each form.
"""

from __future__ import annotations

import os
import statistics
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tallymart.operators.classify import entity_class  # noqa: E402
from tallymart.operators.mart import summary, summary_onepass  # noqa: E402
from tallymart.operators.quality import evaluate, violations  # noqa: E402
from tallymart.operators.reshape import expand_measure, expand_measure_union  # noqa: E402
from tallymart.plans.fixture import FIXTURE, tally_bronze  # noqa: E402
from tallymart.plans.medallion import clean_bronze, normalize, silver  # noqa: E402
from tallymart.session import local_session, scratch_path  # noqa: E402


def timed(action, runs):
    action()  # warm-up
    samples = []
    for _ in range(runs):
        t = time.perf_counter()
        action()
        samples.append(time.perf_counter() - t)
    return statistics.median(samples)


def noop(df):
    return lambda: df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = local_session(8, 8)
    bronze_path = scratch_path(spark, "cmp-bronze")
    clean_bronze(tally_bronze(spark, sf_dir), FIXTURE).write.parquet(bronze_path)
    bronze = spark.read.parquet(bronze_path)
    silver_path = scratch_path(spark, "cmp-silver")
    silver(bronze, FIXTURE).write.parquet(silver_path)
    s = spark.read.parquet(silver_path)
    norm = normalize(bronze, FIXTURE)
    classified = entity_class(norm, FIXTURE.classes)

    rows = [
        ("classify: window vs aggregate+join",
         timed(noop(entity_class(norm, FIXTURE.classes, method="window")), runs),
         timed(noop(entity_class(norm, FIXTURE.classes, method="join")), runs)),
        ("measure rows: union vs explode",
         timed(noop(expand_measure_union(classified, FIXTURE.measure_row)), runs),
         timed(noop(expand_measure(classified, FIXTURE.measure_row)), runs)),
        ("gates: one action per gate vs one pass",
         timed(lambda: [violations(s, r).count() for r in FIXTURE.rules], runs),
         timed(lambda: evaluate(s, FIXTURE.rules).collect(), runs)),
        ("mart: pivot+join vs one pass",
         timed(noop(summary(s, FIXTURE.summary)), runs),
         timed(noop(summary_onepass(s, FIXTURE.summary)), runs)),
    ]
    for name, a, b in rows:
        print(f"{name:45s} {a:6.2f}s  {b:6.2f}s")
    spark.stop()


if __name__ == "__main__":
    main()

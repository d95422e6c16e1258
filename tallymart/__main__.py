"""Run the full refresh as one job:

    python -m tallymart '/data/raw/*.txt' /data/tally

or ``python -m tallymart <glob> <out>`` with a local session.  Exit status 1
when a source failed or a gate fired (after the good sources are loaded /
before silver is published), 0 otherwise.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tallymart.operators.quality import QualityError
from tallymart.plans.elections import DISTRICTS, ELECTION
from tallymart.plans.medallion import IngestError, run, table_targets
from tallymart.session import ensure_checkpoint_dir, input_bytes, scale_conf


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tallymart", description=__doc__.splitlines()[0])
    parser.add_argument("input", help="glob of the district files")
    parser.add_argument("out", help="root folder of bronze/, silver/ and gold/ (or a table prefix with --catalog)")
    parser.add_argument("--catalog", action="store_true", help="write catalog tables named <out><table>, e.g. tally.")
    parser.add_argument("--districts", help="comma list of expected district codes (default: all 24)")
    parser.add_argument("--report-only", action="store_true", help="publish even when a gate fires")
    parser.add_argument("--joined-mart", action="store_true", help="pivot + join mart instead of one pass")
    parser.add_argument("--reload", help="comma list of dist_codigo values that this delivery replaces in bronze; "
                        "all other districts keep their files")
    parser.add_argument("--enforce-widths", action="store_true", help="a code cut to its width stops the run")
    parser.add_argument("--no-key-report", action="store_true", help="do not check the keys of the gold tables")
    parser.add_argument("--buckets", type=int, help="with --catalog: cluster silver by polling table")
    parser.add_argument("--keep-settings", action="store_true", help="do not size shuffles from the input")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tallymart").getOrCreate()
    ensure_checkpoint_dir(spark)
    try:
        if not args.keep_settings:
            size = input_bytes(spark, args.input)
            for key, value in scale_conf(size, spark.sparkContext.defaultParallelism).items():
                spark.conf.set(key, value)
        expected = args.districts.split(",") if args.districts else DISTRICTS
        out = table_targets(args.out) if args.catalog else args.out
        result = run(spark, args.input, ELECTION, out, expected=expected,
                     enforce_quality=not args.report_only, onepass=not args.joined_mart,
                     reload=args.reload.split(",") if args.reload else None, enforce_widths=args.enforce_widths,
                     buckets=args.buckets, check_keys=not args.no_key_report)
    except (IngestError, QualityError) as err:
        print(str(err), file=sys.stderr)
        return 1
    print(json.dumps({"quality": result.quality, "truncated": result.truncated, "keys": result.keys,
                      "replaced": result.replaced, "tables": result.tables}))
    return 0


if __name__ == "__main__":
    sys.exit(main())

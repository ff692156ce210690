"""Full reload of a warehouse.

    spark-submit tallyhouse/plans/backfill.py --source DIR --warehouse DIR
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from tallyhouse.plans import job
from tallyhouse.session import build_session


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Reload all retail CSV files")
    parser.add_argument("--source", required=True)
    parser.add_argument("--warehouse", required=True)
    args = parser.parse_args(argv)
    spark = build_session("tallyhouse-backfill")
    report = job.backfill(spark, args.source, args.warehouse)
    job.summary(spark, report).show(truncate=False)
    return job.OK


if __name__ == "__main__":
    sys.exit(main())

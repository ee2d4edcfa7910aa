"""Monthly revenue by zone and service, as a job to submit.

spark-submit meterline/jobs/monthly_revenue.py --input_green ... --input_yellow ... --output ...
"""

from __future__ import annotations

import argparse

from meterline.plans.models import monthly_revenue_job
from meterline.session import build_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input_green", required=True, help="Parquet path or glob of green trips")
    parser.add_argument("--input_yellow", required=True, help="Parquet path or glob of yellow trips")
    parser.add_argument("--output", required=True, help="folder for the one result file, replaced if it exists")
    args = parser.parse_args(argv)
    monthly_revenue_job(build_session("monthly-revenue"), args.input_green, args.input_yellow, args.output)


if __name__ == "__main__":
    main()

"""Jobs from the command line, for spark-submit or ``python -m playline``.

    python -m playline daily  --raw-root s3a://bucket --out-root s3a://bucket --run-date 2024-01-30
    python -m playline events --raw-root … --out-root … --from 2024-01-01 --to 2024-01-08
"""

from __future__ import annotations

import argparse
import datetime as dt

from playline.plans import jobs
from playline.session import build


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="playline", description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=["media", "events", "engagement", "daily"])
    parser.add_argument("--raw-root", help="folder above raw_data")
    parser.add_argument("--out-root", required=True, help="folder above processed")
    parser.add_argument("--run-date", type=dt.date.fromisoformat, help="default: today, UTC")
    parser.add_argument("--database", default=jobs.DB)
    parser.add_argument("--batches", help="table of landed batches; default: pointer files")
    parser.add_argument("--blind-append", action="store_true", help="append events without a check")
    parser.add_argument(
        "--look-back", type=int, metavar="DAYS", help="search known events only in these days"
    )
    parser.add_argument("--key-index", action="store_true", help="keep an index of event keys")
    parser.add_argument("--from", dest="from_ts", type=dt.datetime.fromisoformat)
    parser.add_argument("--to", dest="to_ts", type=dt.datetime.fromisoformat)
    args = parser.parse_args()
    if args.job != "engagement" and not args.raw_root:
        parser.error("--raw-root is required")
    return args


def main() -> None:
    args = arguments()
    spark = build(f"playline-{args.job}")
    run = {
        "media": lambda: jobs.build_dim_media(
            spark, args.raw_root, args.out_root, args.run_date, args.batches
        ),
        "events": lambda: jobs.build_fact_events(
            spark,
            args.raw_root,
            args.out_root,
            args.run_date,
            not args.blind_append,
            args.from_ts,
            args.to_ts,
            args.batches,
            args.look_back,
            f"{args.database}.fact_events__keys" if args.key_index else None,
        ),
        "engagement": lambda: jobs.build_engagement(
            spark, args.out_root, args.run_date, args.database
        ),
        "daily": lambda: jobs.run_daily(
            spark,
            args.raw_root,
            args.out_root,
            args.run_date,
            args.database,
            not args.blind_append,
            args.batches,
            args.look_back,
            args.key_index,
        ),
    }[args.job]
    print(f"{args.job}: {run()}")
    spark.stop()


if __name__ == "__main__":
    main()

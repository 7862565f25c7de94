"""Analytics report job.

    spark-submit feedlens/jobs/report.py --tables s3a://lake/tables --raw-events s3a://lake/feed/raw_user_events \\
        --output s3a://lake/reports/2024-01-31 --until 2024-01-31
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from feedlens import schemas as S
from feedlens.jobs.common import add_table_options, load, positive
from feedlens.operators.reports import source_report
from feedlens.session import build_session
from feedlens.sources.sinks import existing_table


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    add_table_options(parser)
    parser.add_argument("--raw-events", help="Parquet table of raw events; the audit table is read while it is empty")
    parser.add_argument("--output", required=True, help="folder that gets one table per part")
    parser.add_argument("--until", type=datetime.fromisoformat, help="end of the report (UTC), now by default")
    parser.add_argument("--days", type=positive, default=30)
    parser.add_argument("--limit", type=positive, default=10)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> list[str]:
    args = parse(argv)
    spark = build_session("feed-report")
    until = (args.until or datetime.now(timezone.utc)).replace(tzinfo=timezone.utc)
    raw = existing_table(spark, args.raw_events, S.RAW_EVENTS) if args.raw_events else None
    audit = load(spark, args, "pending_events").withColumnRenamed("timestamp", "event_timestamp")
    parts = source_report(
        raw, audit, load(spark, args, "articles"), load(spark, args, "categories"), load(spark, args, "user_category_scores"),
        until, args.limit, args.days,
    )
    for name, part in parts.items():
        part.write.mode("overwrite").parquet(f"{args.output}/{name}")
    return list(parts)


if __name__ == "__main__":
    main()

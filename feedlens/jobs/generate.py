"""Synthetic data job: seed dimensions and events, as files, log records or audit rows.

    spark-submit feedlens/jobs/generate.py --users 500 --articles 1000 --events 100000 --output-dir data
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import functions as F

from feedlens.jobs.common import add_table_options, env, jdbc_options, positive
from feedlens.session import build_session
from feedlens.sources import sinks, synthetic as Y

FULL = {"users": 500, "articles": 1000, "events": 100_000}
SMALL = {"users": 100, "articles": 200, "events": 10_000}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    add_table_options(parser)
    for name, count in FULL.items():
        parser.add_argument(f"--{name}", type=positive, default=count)
    parser.add_argument("--fallback", action="store_true", help=f"small scale: {SMALL}")
    parser.add_argument("--seed", type=int, default=42)
    parser.add_argument("--output-dir", help="folder for JSON lines of users, articles and events")
    parser.add_argument("--to-kafka", action="store_true")
    parser.add_argument("--kafka-bootstrap-servers", default=env("KAFKA_BOOTSTRAP_SERVERS"))
    parser.add_argument("--topic", default=env("KAFKA_USER_EVENTS_TOPIC", "user_events"))
    parser.add_argument("--to-db", action="store_true")
    args = parser.parse_args(argv)
    if args.fallback:
        vars(args).update(SMALL)
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session("feed-generator")
    now = datetime.now(timezone.utc)
    users = Y.synthetic_users(spark.range(1, args.users + 1))
    articles = Y.synthetic_articles(spark.range(1, args.articles + 1), now, seed=args.seed)
    events = Y.synthetic_events(spark.range(args.events), users, articles, now, seed=args.seed)

    def publish(df):
        sinks.publish_events(df, args.kafka_bootstrap_servers, args.topic)

    def audit(df):
        sinks.write_audit_jdbc(df, jdbc_options(args))

    if args.to_kafka and args.to_db:
        sinks.write_both(events, publish, audit)
    elif args.to_kafka:
        publish(events)
    elif args.to_db:
        audit(events)
    if args.output_dir:
        sinks.write_jsonl(users.select("email", "full_name", "role"), f"{args.output_dir}/generated_users")
        sinks.write_jsonl(articles.select("title", "category_slug", "source_url"),
                          f"{args.output_dir}/generated_articles")
        sinks.write_jsonl(events.withColumnRenamed("event_timestamp", "timestamp"),
                          f"{args.output_dir}/generated_events")
    elif not (args.to_kafka or args.to_db):
        events.groupBy("event_type").agg(F.count("*").alias("events_count")).show(truncate=False)


if __name__ == "__main__":
    main()

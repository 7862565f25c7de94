"""Event stream job.

    spark-submit feedlens/jobs/stream_events.py --kafka-bootstrap-servers host:9092 \\
        --topic user_events --output-base s3a://lake/feed --checkpoint-dir s3a://lake/checkpoints/feed
"""

from __future__ import annotations

import argparse

from feedlens.jobs.common import env, positive
from feedlens.session import build_session, stream_session
from feedlens.sources.readers import read_event_stream
from feedlens.streaming.job import DEFAULT_TRIGGER, run_event_job


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--kafka-bootstrap-servers", default=env("KAFKA_BOOTSTRAP_SERVERS"))
    parser.add_argument("--topic", default=env("KAFKA_USER_EVENTS_TOPIC", "user_events"))
    parser.add_argument("--starting-offsets", default=env("SPARK_STARTING_OFFSETS", "latest"))
    parser.add_argument("--input-text", help="read JSON lines from this folder instead of a topic")
    parser.add_argument("--output-base", default=env("SPARK_OUTPUT_BASE"), required=env("SPARK_OUTPUT_BASE") is None)
    parser.add_argument("--checkpoint-dir", default=env("SPARK_CHECKPOINT_DIR"),
                        required=env("SPARK_CHECKPOINT_DIR") is None)
    parser.add_argument("--processing-time", default=env("SPARK_PROCESSING_TIME", DEFAULT_TRIGGER))
    parser.add_argument("--available-now", action="store_true", help="stop when the present input is done")
    parser.add_argument("--dedupe", action="store_true", help="store each event id of a day once")
    parser.add_argument("--allow-missing-session", action="store_true", help="events of the API have no session")
    parser.add_argument("--compact-every", type=positive, default=360, help="batches per score snapshot")
    parser.add_argument("--state-partitions", type=positive, help="fixed for the life of the checkpoint")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = stream_session(build_session("feed-event-stream"), args.state_partitions)
    if args.input_text:
        records = read_event_stream(spark, "text", path=args.input_text)
    else:
        records = read_event_stream(spark, "kafka", servers=args.kafka_bootstrap_servers, topic=args.topic,
                                    startingOffsets=args.starting_offsets)
    run_event_job(
        spark, records, args.output_base, args.checkpoint_dir, args.available_now, args.processing_time,
        args.dedupe, args.compact_every, not args.allow_missing_session,
    ).awaitTermination()


if __name__ == "__main__":
    main()

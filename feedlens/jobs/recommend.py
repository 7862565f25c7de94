"""Recommendation batch job.

    spark-submit feedlens/jobs/recommend.py --tables s3a://lake/tables --raw-events s3a://lake/feed/raw_user_events \\
        --output s3a://lake/recommendations
"""

from __future__ import annotations

import argparse

from feedlens import schemas as S
from feedlens.jobs.common import add_table_options, env, load, positive
from feedlens.operators.events import interaction_events
from feedlens.operators.recommend import RecommendationSettings
from feedlens.plans.recommendation_batch import run_recommendations
from feedlens.session import build_session

DEFAULTS = RecommendationSettings()


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    add_table_options(parser)
    parser.add_argument("--raw-events", help="Parquet table of raw events; without it the audit table is used alone")
    parser.add_argument("--output", required=True, help="folder of the stored recommendations")
    parser.add_argument("--top-n", type=positive, default=int(env("RECOMMENDATION_TOP_N", str(DEFAULTS.top_n))))
    parser.add_argument("--min-events", type=positive,
                        default=int(env("RECOMMENDATION_MIN_EVENTS", str(DEFAULTS.min_events))))
    parser.add_argument("--model-version", default=env("RECOMMENDATION_MODEL_VERSION", DEFAULTS.model_version))
    parser.add_argument("--fallback-pool-size", type=positive, default=None,
                        help="articles of the global fallback; all of them by default")
    parser.add_argument("--rank", type=positive, default=DEFAULTS.rank)
    parser.add_argument("--max-iter", type=positive, default=DEFAULTS.max_iter)
    parser.add_argument("--reg-param", type=float, default=DEFAULTS.reg_param)
    parser.add_argument("--alpha", type=float, default=DEFAULTS.alpha)
    parser.add_argument("--seed", type=int, default=DEFAULTS.seed)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> dict[str, int]:
    args = parse(argv)
    spark = build_session("feed-recommendations")
    raw = spark.read.schema(S.RAW_EVENTS).parquet(args.raw_events) if args.raw_events else None
    settings = RecommendationSettings(
        top_n=args.top_n, min_events=args.min_events, pool_size=args.fallback_pool_size,
        model_version=args.model_version, rank=args.rank, max_iter=args.max_iter, reg_param=args.reg_param,
        alpha=args.alpha, seed=args.seed,
    )
    counts = run_recommendations(
        load(spark, args, "users"), load(spark, args, "articles"),
        load(spark, args, "user_category_subscriptions"),
        interaction_events(raw, load(spark, args, "pending_events")), args.output, settings,
    )
    print("recommendations stored:", counts)
    return counts


if __name__ == "__main__":
    main()

"""Options shared by the spark-submit entry points."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from feedlens.sources.readers import read_files, read_jdbc_split


def positive(text: str) -> int:
    number = int(text)
    if number < 1:
        raise argparse.ArgumentTypeError("must be a positive integer")
    return number


def env(name: str, default: str | None = None) -> str | None:
    return os.environ.get(name, default)


def add_table_options(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--tables", help="folder with one Parquet table per name")
    parser.add_argument("--jdbc-url", default=env("POSTGRES_JDBC_URL"))
    parser.add_argument("--jdbc-user", default=env("POSTGRES_USER"))
    parser.add_argument("--jdbc-password", default=env("POSTGRES_PASSWORD"))
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    parser.add_argument("--jdbc-partitions", type=positive, default=32)


def jdbc_options(args: argparse.Namespace) -> dict[str, str]:
    return {"url": args.jdbc_url, "user": args.jdbc_user, "password": args.jdbc_password,
            "driver": args.jdbc_driver}


def load(spark: SparkSession, args: argparse.Namespace, name: str) -> DataFrame:
    if args.tables:
        return read_files(spark, args.tables, name)
    if not args.jdbc_url:
        raise SystemExit("give --tables or --jdbc-url")
    return read_jdbc_split(spark, name, jdbc_options(args), args.jdbc_partitions)

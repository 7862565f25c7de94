"""Compaction of tables that micro-batches write as (day, batch) partitions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

STAGED = "_compacted"


def _folders(fs, path, prefix: str) -> dict[str, object]:
    """The partition folders of a path by value."""
    return {
        status.getPath().getName().removeprefix(prefix): status.getPath()
        for status in fs.listStatus(path) if status.getPath().getName().startswith(prefix)
    }


def compact_days(spark: SparkSession, table: str, day_column: str, before: date, batch_column: str = "batch_id") -> int:
    """Rewrite each day before ``before`` that has several batch partitions into one; returns their number.

    No batch may write to these days any more. A day is staged under a hidden folder of its own,
    then its old partitions are hidden and the staged one is moved in, named after the day's highest batch. A run that
    was lost half-way is finished by the next one.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    root = jvm.Path(table)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return 0
    rewritten = 0
    for day, folder in sorted(_folders(fs, root, f"{day_column}=").items()):
        if not day[:1].isdigit() or date.fromisoformat(day) >= before:
            continue
        batches = _folders(fs, folder, f"{batch_column}=")
        staged = jvm.Path(folder, STAGED)
        complete = fs.exists(jvm.Path(staged, "_SUCCESS"))
        if len(batches) < 2 and not complete:
            continue
        newest = max((int(batch) for batch in batches), default=-1)
        if not complete:
            rows = spark.read.parquet(str(folder)).drop(batch_column)
            rows.hint("rebalance").write.mode("overwrite").parquet(str(staged))
        for path in batches.values():
            fs.rename(path, jvm.Path(folder, f"_old-{path.getName()}"))
        hidden = _folders(fs, folder, f"_old-{batch_column}=")
        newest = max([newest, *(int(batch) for batch in hidden)])
        fs.rename(staged, jvm.Path(folder, f"{batch_column}={newest}"))
        for path in hidden.values():
            fs.delete(path, True)
        rewritten += 1
    return rewritten

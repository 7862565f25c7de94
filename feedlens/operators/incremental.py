"""Reports kept up to date by deltas.

A kept report is a keyed table of sums over events, with the number of distinct members (users) per key, and beside it
the members themselves with how often each stands in the key's events. A batch brings events with sign +1 or, taken
back, -1. Sums change by the batch's signed sums; a member counts from when its multiplicity rises above 0 until it
is 0 again. Only the buckets (by key hash) that the batch touches are read and written, never the events before it.

A batch is first staged: the new contents of the touched buckets are written aside, and only then put in place by
overwriting these buckets. A repeated batch, after a failure or by mistake, finds its staged contents and puts the same in place
again; it never adds twice. Batches are applied one after another.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlens import schemas as S
from feedlens.functions import expressions as X
from feedlens.operators.reports import CLICKED

BUCKETS = 1024


@dataclass(frozen=True)
class ReportSpec:
    """What a report sums per key: ``keys`` and ``measures`` are expressions over an event, ``member`` a column counted distinct."""

    keys: Mapping[str, Column]
    measures: Mapping[str, Column] = field(default_factory=dict)
    member: str | None = None

    def rows(self, events: DataFrame, sign: int) -> DataFrame:
        """One row per event with all keys: keys, signed measures, ``events_count`` and the member."""
        keys = [expression.alias(name) for name, expression in self.keys.items()]
        measures = [(sign * expression).alias(name) for name, expression in self.measures.items()]
        member = F.col(self.member) if self.member else F.lit(None).cast("string")
        rows = events.select(*keys, *measures, F.lit(sign).cast("long").alias("events_count"), member.alias("member"))
        return rows.dropna(how="any", subset=list(self.keys))


def _is(*types: str) -> Column:
    return F.coalesce(F.col("event_type").isin(*types), F.lit(False)).cast("long")


def _score() -> Column:
    return X.weight(S.RATING_WEIGHTS, 0.0)


def categories_spec() -> ReportSpec:
    return ReportSpec({"category_id": F.col("category_id")}, {"score": _score()}, "user_id")


def _counters() -> dict[str, Column]:
    return {"views_count": _is("view_article"), "likes_count": _is("like_article"), "saves_count": _is("save_article")}


def articles_spec() -> ReportSpec:
    measures = {**_counters(), "opens_from_recommendations_count": _is(CLICKED), "score": _score()}
    return ReportSpec({"article_id": F.col("article_id")}, measures)


def favorites_spec() -> ReportSpec:
    return ReportSpec({"user_id": F.col("user_id"), "category_id": F.col("category_id")}, {**_counters(), "score": _score()})


def types_spec() -> ReportSpec:
    return ReportSpec({"event_type": F.col("event_type")}, {}, "user_id")


def days_spec() -> ReportSpec:
    return ReportSpec({"date": F.to_date("event_timestamp")}, {}, "user_id")


class KeptReport:
    """A report stored below ``root``: ``sums`` and ``members`` by bucket, and the staged contents of batches."""

    def __init__(self, spark: SparkSession, root: str, spec: ReportSpec, buckets: int = BUCKETS) -> None:
        self.spark, self.root, self.spec, self.buckets = spark, root.rstrip("/"), spec, buckets
        self.keys, self.sums = list(spec.keys), [*spec.measures, "events_count"]

    # --- files
    def _exists(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _staged(self, batch_id: int, name: str) -> str:
        return f"{self.root}/staged/batch={batch_id}/{name}"

    def _bucket(self, columns: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.buckets)).cast("int")

    def _stored(self, name: str, schema, buckets: DataFrame | None = None) -> DataFrame:
        """Rows of a table, or of the buckets listed in ``buckets``, of which there are a bounded number."""
        path = f"{self.root}/{name}"
        if not self._exists(path):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).parquet(path)
        if buckets is None:
            return rows
        return rows.where(F.col("bucket").isin([row["bucket"] for row in buckets.select("bucket").distinct().collect()]))

    def _put(self, staged: str, name: str) -> None:
        """The staged buckets in place of the stored ones; the others are not touched."""
        rows = self.spark.read.parquet(staged)
        rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(
            f"{self.root}/{name}"
        )

    # --- batches
    def apply(self, batch_id: int, added: DataFrame, removed: DataFrame | None = None) -> None:
        """Add events and take others back, once per ``batch_id``."""
        if not self._exists(self._staged(batch_id, "sums/_SUCCESS")):
            self._stage(batch_id, added, removed)
        if self.spec.member:
            self._put(self._staged(batch_id, "members"), "members")
        self._put(self._staged(batch_id, "sums"), "sums")

    def _stage(self, batch_id: int, added: DataFrame, removed: DataFrame | None) -> None:
        delta = self.spec.rows(added, 1)
        if removed is not None:
            delta = delta.unionByName(self.spec.rows(removed, -1))
        per_key = delta.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in self.sums])
        per_key = per_key.withColumn("members", F.lit(0).cast("long"))
        if self.spec.member:
            per_key = per_key.unionByName(self._stage_members(batch_id, delta))
        sums = [*self.sums, "members"]
        changes = per_key.groupBy(*self.keys).agg(*[F.sum(name).alias(name) for name in sums]).withColumn("bucket", self._bucket(self.keys))
        path = self._staged(batch_id, "changes")
        changes.write.mode("overwrite").parquet(path)
        changes = self.spark.read.schema(changes.schema).parquet(path)
        old = self._stored("sums", changes.schema, changes)
        new = old.withColumn("touched", F.lit(0)).unionByName(changes.withColumn("touched", F.lit(1))).groupBy("bucket", *self.keys).agg(
            *[F.sum(name).alias(name) for name in sums], F.max("touched").alias("touched")
        )
        # A key that just became empty keeps a row of zeros, so that its bucket is overwritten even if it is the last one there.
        kept = new.where((F.col("events_count") != 0) | (F.col("members") != 0) | (F.col("touched") == 1)).drop("touched")
        kept.write.mode("overwrite").parquet(self._staged(batch_id, "sums"))

    def _stage_members(self, batch_id: int, delta: DataFrame) -> DataFrame:
        """Stages the members' new multiplicities; returns the keys' changes in distinct members, other sums 0."""
        columns = [*self.keys, "member"]
        changes = delta.where("member is not null").groupBy(*columns).agg(F.sum("events_count").alias("times"))
        # Buckets by key and member: the members of a frequent key are spread.
        changes = changes.withColumn("bucket", self._bucket(columns))
        path = self._staged(batch_id, "member-changes")
        changes.write.mode("overwrite").parquet(path)
        changes = self.spark.read.schema(changes.schema).parquet(path)
        old = self._stored("members", changes.schema, changes).withColumn("before", F.col("times"))
        both = old.unionByName(changes.withColumn("before", F.lit(None).cast("long")))
        new = both.groupBy("bucket", *columns).agg(
            F.sum("times").alias("times"), F.coalesce(F.sum("before"), F.lit(0)).alias("before"),
            F.max(F.col("before").isNull()).alias("touched"),
        ).where("times <> 0 or touched")
        path = self._staged(batch_id, "member-steps")
        new.write.mode("overwrite").parquet(path)
        new = self.spark.read.schema(new.schema).parquet(path)
        new.select("bucket", *columns, "times").write.mode("overwrite").parquet(self._staged(batch_id, "members"))
        # A batch may bring a removal before its event: negative multiplicities are kept, and do not count.
        step = (F.col("times") > 0).cast("long") - (F.col("before") > 0).cast("long")
        zeros = [F.lit(0).cast(dict(delta.dtypes)[name]).alias(name) for name in self.sums]
        return new.where("touched").groupBy(*self.keys).agg(F.sum(step).alias("members")).select(*self.keys, *zeros, "members")

    # --- reading
    def report(self) -> DataFrame:
        """``*keys, *measures, events_count`` and, with a member, ``unique_users_count`` of every key with events."""
        rows = self.spark.read.parquet(f"{self.root}/sums").where("events_count <> 0")
        members = [F.col("members").alias("unique_users_count")] if self.spec.member else []
        return rows.select(*self.keys, *self.spec.measures, "events_count", *members)

    def changed(self, batch_id: int) -> DataFrame:
        """The keys that a batch touched, with their new sums (none for keys without events any more)."""
        keys = self.spark.read.parquet(self._staged(batch_id, "changes")).select(*self.keys)
        return keys.join(self.spark.read.parquet(self._staged(batch_id, "sums")).drop("bucket"), self.keys)

    def repaired_top(self, top: DataFrame, batch_id: int, order: Sequence[tuple[str, bool]], limit: int) -> DataFrame:
        """The first ``limit`` rows of the report after a batch, from ``top``, its first rows before, and the touched keys.

        ``order`` lists columns with whether they descend, and is total. A key that was not in ``top`` and was not
        touched ranks below ``top``'s last row still. So if ``limit`` rows rank no lower than that, they are the list;
        only otherwise (rows of the list fell) is the report read.
        """
        sort = [F.desc(name) if descending else F.asc(name) for name, descending in order]
        columns = self.report().columns
        touched = self.changed(batch_id).where("events_count <> 0")
        if self.spec.member:
            touched = touched.withColumnRenamed("members", "unique_users_count")
        known = top.join(touched.select(*self.keys), self.keys, "left_anti").unionByName(touched.select(*columns)).select(*columns)
        rows = top.orderBy(*sort).collect()  # ``limit`` rows
        if len(rows) < limit:
            return self.report().orderBy(*sort).limit(limit)
        floor = rows[-1]
        above, equal = F.lit(False), F.lit(True)
        for name, descending in order:
            value = F.lit(floor[name])
            above = above | (equal & ((F.col(name) > value) if descending else (F.col(name) < value)))
            equal = equal & (F.col(name) == value)
        found = known.where(above | equal).orderBy(*sort).limit(limit)
        return found if found.count() == limit else self.report().orderBy(*sort).limit(limit)

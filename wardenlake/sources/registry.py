"""Model registry: a log of registrations and deletions on a table with commits.

The state of a version is its latest entry. Registering checks and appends in one commit: of several writers of one
version without `overwrite` exactly one gets True, and nothing that was reported as done is lost.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from wardenlake.schema import registry_schema
from wardenlake.sources.commit_log import NUMBER, CommittedTable

LOG_SCHEMA = T.StructType([T.StructField("deleted", T.BooleanType(), False), *registry_schema().fields])


# ---------------------------------------------------------------------------------------------
# queries on a table of entries


def upsert(entries: DataFrame, new: DataFrame, overwrite: bool = False) -> DataFrame:
    """Add entries. A known version keeps its old entry, or with `overwrite` takes the new one."""
    if overwrite:
        return entries.join(new.select("version"), "version", "left_anti").unionByName(new)
    return entries.unionByName(new.join(entries.select("version"), "version", "left_anti"))


def list_versions(entries: DataFrame) -> DataFrame:
    return entries.orderBy(F.desc("registered_at"), "version")


def get_version(entries: DataFrame, version: str) -> DataFrame:
    return entries.where(F.col("version") == version)


def compare_versions(entries: DataFrame, versions=None, metrics=None) -> DataFrame:
    """Metric by version matrix plus the registration dates; versions not known are left out."""
    chosen = entries if versions is None else entries.where(F.col("version").isin(list(versions)))
    if versions is None:
        versions = [r["version"] for r in entries.select("version").distinct().orderBy("version").collect()]
    else:
        known = {r["version"] for r in chosen.select("version").distinct().collect()}
        versions = [v for v in versions if v in known]
    values = chosen.select("version", F.explode("metrics").alias("metric", "value"))
    if metrics is not None:
        values = values.where(F.col("metric").isin(list(metrics)))
    return values.groupBy("metric").pivot("version", list(versions)).agg(F.first("value")).orderBy("metric")


def registration_dates(entries: DataFrame) -> DataFrame:
    return entries.select("version", F.to_date("registered_at").alias("registered_on"))


def best_version(entries: DataFrame, metric: str = "f1", higher_is_better: bool = True) -> DataFrame:
    """(version, value) of the best entry that has the metric; the earlier one wins a tie."""
    rated = entries.select("version", "registered_at", F.col("metrics")[metric].alias("value")).where("value IS NOT NULL")
    by_value = F.desc("value") if higher_is_better else F.asc("value")
    return rated.orderBy(by_value, "registered_at", "version").limit(1).select("version", "value")


def model_info(entries: DataFrame, model_path: str) -> DataFrame:
    """The metadata of a model path, or one row that says not_found."""
    hit = entries.where(F.col("model_path") == model_path)
    info = hit.agg(F.max_by(F.struct("version", "registered_at", "metrics", "params"), "registered_at").alias("e"))
    return info.select(
        F.lit(model_path).alias("model_path"),
        F.when(F.col("e").isNull(), "not_found").otherwise("found").alias("status"),
        F.col("e.version").alias("version"),
        F.col("e.metrics").alias("metrics"),
        F.col("e.params").alias("params"),
    )


# ---------------------------------------------------------------------------------------------
# storage


def newest_entries(log: DataFrame) -> DataFrame:
    """The latest entry of every version that isn't deleted. A commit has one entry of a version."""
    newest = Window.partitionBy("version").orderBy(F.desc(NUMBER))
    latest = log.withColumn("at", F.row_number().over(newest)).where("at = 1 AND NOT deleted")
    return latest.select(*[f.name for f in registry_schema()])


class ModelRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.table = spark, CommittedTable(spark, path, LOG_SCHEMA)

    def entries(self) -> DataFrame:
        return newest_entries(self.table.read())

    def _entry(self, deleted: bool, version: str, at: datetime, *rest) -> DataFrame:
        return self.spark.createDataFrame([(deleted, version, at, *rest)], LOG_SCHEMA).coalesce(1)

    def register(
        self, version, metrics, params=None, model_path=None, tags=None, notes=None, overwrite=False, registered_at=None
    ) -> bool:
        """False, and no change, if the version exists and `overwrite` is not set."""
        row = self._entry(
            False,
            version,
            registered_at or datetime.now(timezone.utc),
            {k: float(v) for k, v in metrics.items()},
            {k: str(v) for k, v in (params or {}).items()},
            model_path,
            list(tags or []),
            notes or "",
        )
        if overwrite:
            return self.table.append(row) > 0
        return self.table.update(lambda log: None if get_version(newest_entries(log), version).take(1) else row) is not None

    def register_all(self, entries: DataFrame, overwrite: bool = False) -> bool:
        """Many entries in one commit. Known versions keep their entry unless `overwrite`; False if nothing was added.

        Of entries of the same version the one registered last counts.
        """
        last = Window.partitionBy("version").orderBy(F.desc("registered_at"), "model_path")
        new = entries.withColumn("__at", F.row_number().over(last)).where("__at = 1")
        new = new.select(F.lit(False).alias("deleted"), *[f.name for f in registry_schema()])

        def change(log: DataFrame) -> DataFrame | None:
            added = new if overwrite else new.join(newest_entries(log).select("version"), "version", "left_anti")
            return None if added.isEmpty() else added.select(*LOG_SCHEMA.names)

        return self.table.update(change) is not None

    def add_metrics(self, version: str, metrics) -> bool:
        """False, and no change, if the version is unknown."""
        added = F.create_map(*[F.lit(x) for k, v in metrics.items() for x in (k, float(v))]) if metrics else None

        def change(log: DataFrame) -> DataFrame | None:
            known = get_version(newest_entries(log), version)
            if not known.take(1):
                return None
            if added is not None:
                kept = F.map_filter("metrics", lambda name, _: ~name.isin(list(metrics)))
                known = known.withColumn("metrics", F.map_concat(F.coalesce(kept, F.expr("cast(map() as map<string,double>)")), added))
            return known.select(F.lit(False).alias("deleted"), *[f.name for f in registry_schema()]).coalesce(1)

        return self.table.update(change) is not None

    def delete(self, version: str) -> bool:
        gone = self._entry(True, version, datetime.now(timezone.utc), None, None, None, None, None)
        return self.table.update(lambda log: gone if get_version(newest_entries(log), version).take(1) else None) is not None

    def list_versions(self) -> DataFrame:
        return list_versions(self.entries())

    def get(self, version: str) -> DataFrame:
        return get_version(self.entries(), version)

    def compare(self, versions=None, metrics=None) -> DataFrame:
        return compare_versions(self.entries(), versions, metrics)

    def best_version(self, metric: str = "f1", higher_is_better: bool = True) -> DataFrame:
        return best_version(self.entries(), metric, higher_is_better)

    def model_info(self, model_path: str) -> DataFrame:
        return model_info(self.entries(), model_path)

"""Loaders for stored tables (S-3, S-4, S-6) and the registry writer (S-7).

In production the inventory, external catalog, registry and executions are
parquet tables. Loaders select only the needed columns and apply filters on
plain columns, so Catalyst prunes the ``ReadSchema``, pushes the filters to
the parquet scan and, for tables partitioned by ``project_id``, prunes
partitions.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan.session import path_exists, shared_dir

INVENTORY_COLS = ["project_id", "data_id", "data_type", "path", "name", "size", "etag", "status",
                  "owning_project_id"]


def read_inventory(spark: SparkSession, path: str, project_ids: Iterable[str] | None = None,
                   data_type: str | None = None, cols: list[str] | None = None) -> DataFrame:
    """S-3: project objects, optionally restricted to some projects / a type."""
    df = spark.read.parquet(path).select(*(cols or INVENTORY_COLS))
    if project_ids is not None:
        df = df.filter(F.col("project_id").isin(list(project_ids)))
    if data_type is not None:
        df = df.filter(F.col("data_type") == data_type)
    return df


def read_external_catalog(spark: SparkSession, path: str, current_only: bool = True) -> DataFrame:
    """S-4: external objects by bucket and key; ``current_state`` pushed down."""
    df = spark.read.parquet(path).select("s3_object_id", "bucket", "key", "size", "etag", "current_state")
    if current_only:
        df = df.filter(F.col("current_state"))
    return df.withColumn("uri", F.concat(F.lit("s3://"), F.col("bucket"), F.lit("/"), F.col("key")))


def write_inventory(inventory: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Store an inventory partitioned by project, sorted by path inside each
    file, so lookups prune partitions and row groups. Ranges of (project, path)
    split a large project over many tasks."""
    (inventory.repartitionByRange("project_id", "path").sortWithinPartitions("project_id", "path")
              .write.mode(mode).partitionBy("project_id").parquet(path))


#: Hash buckets of a stored registry.
REGISTRY_BUCKETS = 64
REGISTRY_COLS = ["id", "id_type", "task_token", "registered_at"]
REGISTRY_SCHEMA = "id string, id_type string, task_token string, registered_at timestamp, bucket int"


def registry_writer(path: str, buckets: int = REGISTRY_BUCKETS):
    """S-7, S-8 as a ``foreachBatch`` function over changes: ``id, id_type,
    task_token, registered_at`` to put, or with ``removed_at`` the instant from
    which the key is gone (null or no such column: a put).

    The table lies in hash buckets of the key. A batch reads and replaces only
    the buckets that its keys fall into; the others are not touched. Per key the
    last change counts, by time; a removal wins over a put of the same instant.
    A replayed batch leaves the same table. The new buckets are written to the
    shared folder before they replace the old ones, so they are whole when the
    swap begins. Rows without id mark buckets that became empty."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        gone = F.col("removed_at") if "removed_at" in batch.columns else F.lit(None)
        change = batch.select("id", "id_type", "task_token", F.col("registered_at").cast("timestamp"),
                              gone.cast("timestamp").alias("removed_at")).filter(F.col("id").isNotNull()).withColumn(
            "bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
        change = change.persist()
        try:
            touched = sorted(r.bucket for r in change.select("bucket").distinct().collect())  # at most ``buckets``
            if not touched:
                return
            rows = change.withColumn("at", F.coalesce("removed_at", "registered_at"))
            if path_exists(spark, path):
                old = spark.read.schema(REGISTRY_SCHEMA).parquet(path).filter(
                    F.col("bucket").isin(touched) & F.col("id").isNotNull())
                rows = rows.unionByName(old.withColumn("removed_at", F.lit(None).cast("timestamp"))
                                        .withColumn("at", F.col("registered_at")))
            last = F.max_by(F.struct("task_token", "registered_at", "removed_at", "bucket"),
                            F.struct("at", F.col("removed_at").isNotNull()))
            new = (rows.groupBy("id", "id_type").agg(last.alias("r")).filter(F.col("r.removed_at").isNull())
                   .select("id", "id_type", "r.task_token", "r.registered_at", "r.bucket"))
            empty = change.select(*[F.lit(None).cast(kind).alias(c) for c, kind in zip(
                REGISTRY_COLS, ("string", "string", "string", "timestamp"), strict=True)], "bucket").distinct()
            shared_dir(spark)
            whole = new.unionByName(empty).repartition("bucket").checkpoint()
            (whole.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket").parquet(path))
        finally:
            change.unpersist()
    return write


def read_registry(spark: SparkSession, path: str, id_type: str | None = None) -> DataFrame | None:
    """S-6 on a stored registry; ``None`` if nothing is written yet. A folder
    that cannot be read is an error."""
    if not path_exists(spark, path):
        return None
    df = spark.read.schema(REGISTRY_SCHEMA).parquet(path).filter(F.col("id").isNotNull()).select(*REGISTRY_COLS)
    return df.filter(F.col("id_type") == id_type) if id_type else df

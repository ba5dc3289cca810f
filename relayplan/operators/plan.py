"""Plan assembly (A-2, S-10) and storage mapping (E-15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan.functions import uri as U
from relayplan.operators.resolve import EXTERNAL_KIND, FILE_KIND, FOLDER_KIND


def assemble_plan(resolved: DataFrame) -> DataFrame:
    """A-2: per request, how many sources are files, folders and externals.

    The lists themselves stay as rows of ``resolved`` (written partitioned by
    request, see ``write_plan``); only counts are aggregated.
    """
    k = F.col("kind")
    return resolved.groupBy("request_id").agg(
        F.count_if(k == FILE_KIND).alias("n_files"),
        F.count_if(k == FOLDER_KIND).alias("n_folders"),
        F.count_if(k == EXTERNAL_KIND).alias("n_external"))


def write_plan(plan: DataFrame, path: str, partition_by: tuple[str, ...] = ("kind",),
               mode: str = "overwrite") -> None:
    """S-10: write plan rows as parquet, partitioned for later per-kind reads."""
    plan.write.mode(mode).partitionBy(*partition_by).parquet(path)


def s3_targets(objects: DataFrame, storage_config: DataFrame) -> DataFrame:
    """E-15: project path -> ``s3://bucket/prefix + key`` via the project's
    storage configuration (one row per project; AQE picks the join from measured sizes)."""
    cfg = storage_config.select("project_id", "bucket", "prefix")
    j = objects.join(cfg, "project_id")
    return j.select("project_id", "path", U.s3_uri(F.col("bucket"), F.col("prefix"), F.col("path")).alias("s3_uri"))

"""Stored layouts of the inventory that make lookups cheap (S-3, J-1, J-5, J-6).

*Areas*: partitioned by project and by a hash of the leading folders of the
path. A micro-batch of requests names few projects and folders, and dynamic
partition pruning reads only their areas.

*Buckets*: bucketed and sorted by the columns of a lookup. A join on these
columns exchanges the looked-up keys, never the inventory.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.session import exchange_partitions, releasing, scratch_path

#: Areas of a project, and how many leading folders decide the area of a path.
AREAS = 16
DEPTH = 2

AREA_SCHEMA = ("data_id string, data_type string, path string, name string, size bigint, etag string, "
               "status string, owning_project_id string, project_id string, area int")


# -- areas ---------------------------------------------------------------------

def _folder(path: Column) -> Column:
    return F.when(path.endswith("/"), path).otherwise(U.parent(path))


def path_area(path: Column, areas: int = AREAS, depth: int = DEPTH) -> Column:
    """Area of an object: all below one folder of ``depth`` components share it."""
    lead = F.substring_index(_folder(path), "/", depth + 1)
    return F.pmod(F.xxhash64(lead), F.lit(areas)).cast("int")


def lookup_areas(path: Column, areas: int = AREAS, depth: int = DEPTH) -> Column:
    """Areas in which a path and, if it is a folder, all below it can lie: one,
    or all for a folder of fewer than ``depth`` components."""
    shallow = path.endswith("/") & (F.size(F.split(path, "/")) - 1 <= depth)
    return F.when(shallow, F.sequence(F.lit(0), F.lit(areas - 1))).otherwise(F.array(path_area(path, areas, depth)))


def write_areas(inventory: DataFrame, path: str, areas: int = AREAS, depth: int = DEPTH) -> None:
    """Store an inventory by project and area, sorted by path inside each file.
    Ranges of (project, area, path) split a large area over many tasks."""
    by = ("project_id", "area", "path")
    with releasing(inventory.sparkSession):
        (inventory.withColumn("area", path_area(F.col("path"), areas, depth))
         .repartitionByRange(*by).sortWithinPartitions(*by)
         .write.mode("overwrite").option("compression", "zstd").partitionBy("project_id", "area").parquet(path))


def read_areas(spark: SparkSession, path: str) -> DataFrame:
    """The stored inventory with ``area``; ids of projects stay text."""
    return spark.read.schema(AREA_SCHEMA).parquet(path)


def project_paths(uris: DataFrame, uri_col: str) -> DataFrame:
    """``project_id, path`` of the project URIs among ``uris``."""
    u = F.col(uri_col)
    return (uris.filter(U.uri_scheme(u) == K.PROJECT_SCHEME)
            .select(U.uri_netloc(u).alias("project_id"), U.uri_path(u).alias("path")))


def touched_areas(paths: DataFrame, areas: int = AREAS, depth: int = DEPTH) -> DataFrame:
    """``project_id, area`` that lookups of ``paths`` (``project_id, path``) can
    meet, stored in the shared folder, so that its measured size decides how
    it is joined."""
    spark = paths.sparkSession
    out = scratch_path(spark, "areas")
    (paths.select("project_id", F.explode(lookup_areas(F.col("path"), areas, depth)).alias("area"))
     .distinct().write.mode("overwrite").parquet(out))
    return spark.read.schema("project_id string, area int").parquet(out)


def prune(stored: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of the touched areas. The semi join lets Spark prune the partitions
    of ``stored`` at run time while ``touched`` is below the broadcast
    threshold; above it the join still keeps the other areas out of what follows."""
    return stored.join(touched.filter(F.col("area") >= 0), ["project_id", "area"], "left_semi").drop("area")


# -- buckets -------------------------------------------------------------------

def write_buckets(inventory: DataFrame, table: str, path: str, by: tuple[str, ...], buckets: int | None = None) -> int:
    """Store an inventory in buckets of the columns of a lookup, one sorted file
    a bucket, as the table ``table`` at ``path``. Returns the number of
    buckets: by default the partitions an exchange starts with, since Spark
    exchanges a side again that has fewer."""
    n = buckets or exchange_partitions(inventory.sparkSession)
    (inventory.repartition(n, *by).write.mode("overwrite").format("parquet").option("compression", "zstd")
     .bucketBy(n, *by).sortBy(*by).option("path", path).saveAsTable(table))
    return n


def open_buckets(spark: SparkSession, table: str, path: str, schema: str, by: tuple[str, ...], buckets: int) -> DataFrame:
    """The stored table in a session whose catalog does not know it yet."""
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{table}` ({schema}) USING parquet "
              f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)

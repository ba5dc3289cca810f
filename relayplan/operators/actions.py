"""What to do with each file (J-9, J-10, U-4) and the aggregates over it
(A-1, A-3, A-7, A-8, W-6).

Aggregates are algebraic (count, sum, min, max), so Spark combines them
map-side and a hot group costs one partial row per task. Job membership is
kept as rows (``job_members``); no unbounded list is collected into a row:
the id lists of ``split_parts`` go on in further rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.functions.predicates import is_partial, part_class
from relayplan.operators.resolve import FILE_KIND, parse_destinations
from relayplan.session import stored

COPY, REPLACE_PARTIAL, SKIP, CONFLICT = "COPY", "REPLACE_PARTIAL", "SKIP", "CONFLICT"
MISSING_SOURCE = "MISSING_SOURCE"


def file_targets(resolved: DataFrame, requests: DataFrame) -> DataFrame:
    """Direct FILE sources with the path they land on.

    request_id, data_id, name, size, etag, target_project, target_folder, target_path
    """
    f = resolved.filter(F.col("kind") == FILE_KIND)
    d = parse_destinations(requests)
    j = f.join(d, "request_id")
    return j.select(
        "request_id", "data_id", "name", "size", "etag",
        F.col("dest_project").alias("target_project"),
        F.col("dest_folder").alias("target_folder"),
        U.path_join(F.col("dest_folder"), F.col("name")).alias("target_path"),
    )


def transfer_action(targets: DataFrame, dest_inventory: DataFrame) -> DataFrame:
    """J-10: COPY (nothing there), REPLACE_PARTIAL (unfinished file there),
    SKIP (same size there), CONFLICT (different size there), and
    MISSING_SOURCE where ``targets`` says the source was not found.

    Left equi-join on (project, path) against existing destination files.
    """
    ex = dest_inventory.filter(F.col("data_type") == K.FILE).select(
        F.col("project_id").alias("target_project"), F.col("path").alias("target_path"),
        F.col("status").alias("existing_status"), F.col("size").alias("existing_size"),
        F.col("data_id").alias("existing_id"))
    j = targets.join(ex, ["target_project", "target_path"], "left")
    found = F.col("found") if "found" in targets.columns else F.lit(True)
    action = (F.when(~found, F.lit(MISSING_SOURCE))
               .when(F.col("existing_status").isNull(), F.lit(COPY))
               .when(is_partial("existing_status"), F.lit(REPLACE_PARTIAL))
               .when(F.col("existing_size").eqNullSafe(F.col("size")), F.lit(SKIP))
               .otherwise(F.lit(CONFLICT)))
    return j.withColumn("action", action)


def transfer_summary(actions: DataFrame, by: tuple[str, ...] = ("request_id", "action")) -> DataFrame:
    """A-7: files and bytes per group."""
    return actions.groupBy(*by).agg(F.count(F.lit(1)).alias("files"),
                                    F.sum("size").alias("bytes"))


def transfer_rollup(actions: DataFrame) -> DataFrame:
    """A-7 report: rollup(destination project, action) with the grouping level."""
    return (actions.rollup("target_project", "action")
                   .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
                        F.grouping_id().alias("level"))
                   .withColumnRenamed("target_project", "dest_project_id"))


def largest_transfers(actions: DataFrame, k: int = 20) -> DataFrame:
    """W-6: top-k files still to move by size, ties broken by id.

    ``orderBy().limit()`` plans TakeOrderedAndProject: each task keeps k rows.
    """
    todo = actions.filter(F.col("action").isin(COPY, REPLACE_PARTIAL))
    return (todo.select("request_id", "data_id", "size")
                .orderBy(F.col("size").desc(), F.col("data_id").asc(), F.col("request_id").asc())
                .limit(k))


def partials_to_delete(targets: DataFrame, dest_inventory: DataFrame) -> DataFrame:
    """J-9: PARTIAL files directly in a destination folder whose name is one
    of the request's source names. ``left_semi`` on (project, folder, name)."""
    want = targets.select(F.col("target_project").alias("project_id"), F.col("target_folder").alias("_folder"),
                          U.basename("target_path").alias("name")).distinct()
    p = dest_inventory.filter((F.col("data_type") == K.FILE) & is_partial("status")) \
                      .withColumn("_folder", U.parent("path"))
    return p.join(want, ["project_id", "_folder", "name"], "left_semi").select("project_id", "path")


def still_missing(targets: DataFrame, dest_inventory: DataFrame) -> DataFrame:
    """U-4: planned destination files with nothing at their path yet."""
    ex = dest_inventory.select(F.col("project_id").alias("target_project"),
                               F.col("path").alias("target_path"))
    return targets.join(ex, ["target_project", "target_path"], "left_anti")


#: Ids in one row of a list.
LIST_ITEMS = 1_000


def split_parts(files: DataFrame, mode: str = "strict", max_items: int = LIST_ITEMS) -> DataFrame:
    """A-3: the files of a request by part class: how many, bytes, first and last
    id, and the ids themselves in order, a line each. A list longer than
    ``max_items`` goes on in further rows (``part`` 1, 2, ...), which repeat what
    holds for the whole class; all but the last row of a list are full.

    Rows are range-partitioned by their place in the lists, so a request that has a
    large share of all files is spread over many tasks; the counts per partition
    and list are summed up, and rows numbered within them.

    request_id, part_class, files, bytes, first_id, last_id, part, ids
    """
    keys = ["request_id", "part_class"]
    c = files.select("request_id", part_class("etag", mode).alias("part_class"), "data_id", "size")
    # written, so that it is fixed which row lies in which partition
    rows = stored(c.repartitionByRange(*keys, "data_id").withColumn("_at", F.spark_partition_id()))
    counts = rows.groupBy(*keys, "_at").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_bytes"),
                                            F.min("data_id").alias("_lo"), F.max("data_id").alias("_hi"))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    lists = counts.select(
        *keys, "_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"),
        F.sum("_n").over(whole).alias("files"), F.sum("_bytes").over(whole).alias("bytes"),
        F.min("_lo").over(whole).alias("first_id"), F.max("_hi").over(whole).alias("last_id"))
    no = F.row_number().over(Window.partitionBy(*keys, "_at").orderBy("data_id")) - 1
    numbered = rows.select(*keys, "_at", "data_id", no.alias("_no")).alias("r")
    same = reduce(lambda a, b: a & b, [F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}")) for k in (*keys, "_at")])
    figures = ["files", "bytes", "first_id", "last_id"]
    cut = numbered.join(lists.alias("l"), same).select(
        *[f"r.{k}" for k in keys], *figures, F.expr(f"(_first + _no) div {max_items}").alias("part"), "data_id")
    ids = F.sort_array(F.collect_list("data_id"))  # at most ``max_items``
    return cut.groupBy(*keys, *figures, "part").agg(
        F.when(F.count("data_id") > 0, F.array_join(ids, "\n")).alias("ids"))


def job_members(files: DataFrame, mode: str = "strict") -> DataFrame:
    """A-1 rows: multi-part files with the copy job (request, destination
    folder) they belong to. Single-part files are moved one by one."""
    return (files.filter(part_class("etag", mode) == "MULTI")
                 .select("request_id", F.col("target_project"), F.col("target_folder").alias("dest"),
                         "data_id", "size"))


def build_copy_jobs(members: DataFrame) -> DataFrame:
    """A-1: one job per (request, destination folder)."""
    return members.groupBy("request_id", "target_project", "dest").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"),
        F.min("data_id").alias("first_id"), F.max("data_id").alias("last_id"))


def destination_collisions(planned: DataFrame) -> DataFrame:
    """A-8: two sources of one request landing on the same path.

    ``planned``: request_id, target_project, target_path.
    """
    return (planned.groupBy("request_id", "target_project", "target_path")
                   .agg(F.count(F.lit(1)).alias("n"))
                   .filter(F.col("n") > 1)
                   .select("request_id", F.col("target_path").alias("dest_path"), "n"))


def external_targets(resolved: DataFrame, requests: DataFrame, external_objects: DataFrame) -> DataFrame:
    """External (``s3``) sources with the path they land on: destination
    folder + base name of the object key; size and part class from the
    current catalog entry (J-8). ``found`` is false for missing objects."""
    from relayplan.operators.resolve import EXTERNAL_KIND, external_metadata
    u = F.col("source_uri")
    ext = (resolved.filter((F.col("kind") == EXTERNAL_KIND) & (U.uri_scheme(u) == K.OBJECT_SCHEME))
                   .select("request_id", "pos", "source_uri"))
    meta = external_metadata(ext, external_objects, uri_col="source_uri")
    d = parse_destinations(requests)
    name = U.basename(U.uri_path(u))
    return meta.join(d, "request_id").select(
        "request_id", "pos", "source_uri", name.alias("name"), "size", "etag", "is_multipart", "found",
        F.col("dest_project").alias("target_project"), F.col("dest_folder").alias("target_folder"),
        U.path_join(F.col("dest_folder"), name).alias("target_path"))


def external_actions(targets: DataFrame, dest_inventory: DataFrame) -> DataFrame:
    """J-10 for the external-object mover; objects missing from the catalog
    cannot be moved (MISSING_SOURCE)."""
    return transfer_action(targets, dest_inventory)


def transfer_report(actions: DataFrame, mode: str = "strict") -> DataFrame:
    """A-7 in full: per request, action and part class the files, bytes and
    largest file -- what a caller needs to choose between the one-by-one
    mover, a copy job or a large-file mover (the choice itself is the
    caller's parameter, not a constant here)."""
    c = actions.withColumn("part_class", part_class("etag", mode))
    return c.groupBy("request_id", "action", "part_class").agg(
        F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes"), F.max("size").alias("max_size"))

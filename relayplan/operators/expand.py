"""Recursive folder expansion and checks built on it (J-5, A-4, P-14, A-1, A-8).

Prefix containment ("file lies under folder") is turned into an equi-join:
each file path is exploded into its proper ancestor folders and joined on
(project, folder). This plans a hash or sort-merge join instead of a
nested-loop join, and replaces the original's re-published event per
sub-folder with one closed-form join. Top-level ancestors are hot keys; AQE
skew-join splitting handles a folder that owns a large share of all files,
and ``salt`` spreads it explicitly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.operators.resolve import FOLDER_KIND, parse_destinations


def folder_levels(folders: DataFrame, path: str = "path") -> DataFrame:
    """(project_id, _levels): how many ``/`` the named folders of a project hold. Only
    ancestors with as many can meet them. A row a project, no longer than its
    deepest path, so it is broadcast."""
    return F.broadcast(folders.groupBy("project_id").agg(F.collect_set(U.slashes(path)).alias("_levels")))


def source_levels(resolved: DataFrame) -> DataFrame:
    """``folder_levels`` of the FOLDER sources. Reads ``resolved`` once more, so
    that should be stored."""
    return folder_levels(resolved.filter(F.col("kind") == FOLDER_KIND))


def file_ancestors(inventory: DataFrame, levels: DataFrame | None = None) -> DataFrame:
    """(project_id, folder, data_id, path, name, size, etag) for every file
    and each of its proper ancestor folders (of ``levels``, if given)."""
    f = inventory.filter(F.col("data_type") == K.FILE)
    if levels is not None:
        f = f.join(levels, "project_id")
    return f.select("project_id", F.explode(U.ancestors("path", None if levels is None else "_levels")).alias("folder"),
                    "data_id", "path", "name", "size", "etag")


def expand_recursive(resolved: DataFrame, requests: DataFrame, inventory: DataFrame,
                     salt: int = 1, levels: DataFrame | None = None) -> DataFrame:
    """J-5: every file below each FOLDER source, with its destination path
    ``dest/<folder name>/<path relative to the folder>``.

    ``salt > 1`` spreads every (project, folder) key over ``salt`` join
    partitions: file rows get ``hash(data_id) % salt``, folder-source rows are
    replicated once per salt value. Use it where a few folders own most files
    and adaptive skew-join splitting is off; by default AQE splits skewed
    partitions at run time. ``levels`` (``source_levels`` of a stored ``resolved``)
    leaves out the ancestors that no source can be.

    request_id, data_id, size, etag, source_folder, dest_project, dest_path, dest_scheme
    """
    # the few folders meet their destination first, so that files are exchanged once
    src = (resolved.filter(F.col("kind") == FOLDER_KIND)
                   .select("request_id", "project_id", F.col("path").alias("folder"),
                           F.col("name").alias("folder_name"))
                   .join(parse_destinations(requests).drop("dest_uri"), "request_id"))
    files = file_ancestors(inventory, levels)
    keys = ["project_id", "folder"]
    if salt > 1:
        src = src.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        files = files.withColumn("_salt", F.pmod(F.xxhash64("data_id"), F.lit(salt)).cast("int"))
        keys = keys + ["_salt"]
    j = src.join(files, keys)
    rel = U.relative_to(F.col("path"), F.col("folder"))
    dest = U.normalise_path(F.concat(F.col("dest_folder"), F.col("folder_name"), F.lit("/"), rel))
    return j.select("request_id", "data_id", "size", "etag",
                    F.col("folder").alias("source_folder"), "dest_project", dest.alias("dest_path"), "dest_scheme")


def folder_tree(resolved: DataFrame, requests: DataFrame, inventory: DataFrame,
                levels: DataFrame | None = None) -> DataFrame:
    """Every FOLDER source and every folder below it, with the destination
    folder it becomes; folders without files included. ``levels`` as in
    ``expand_recursive``.

    request_id, dest_uri, dest_scheme, dest_project, dest_folder
    """
    src = (resolved.filter(F.col("kind") == FOLDER_KIND)
                   .select("request_id", "project_id", F.col("path").alias("folder"),
                           F.col("name").alias("folder_name"))
                   .join(parse_destinations(requests), "request_id"))
    own = F.array_union(U.ancestors("path", None if levels is None else "_levels"), F.array("path"))
    below = inventory.filter(F.col("data_type") == K.FOLDER)
    if levels is not None:
        below = below.join(levels, "project_id")
    below = below.select(
        "project_id", F.explode(own).alias("folder"), F.col("path").alias("below"))
    j = src.join(below, ["project_id", "folder"])
    path = U.normalise_path(F.concat(F.col("dest_folder"), F.col("folder_name"), F.lit("/"),
                                     U.relative_to(F.col("below"), F.col("folder"))))
    return j.select("request_id", "dest_uri", "dest_scheme", "dest_project", path.alias("dest_folder")).distinct()


def recursive_jobs(tree: DataFrame, expanded: DataFrame) -> DataFrame:
    """A-4: one job per folder of the tree, with the files directly in it."""
    files = (expanded.select("request_id", U.parent("dest_path").alias("dest_folder"), "size")
                     .groupBy("request_id", "dest_folder")
                     .agg(F.count(F.lit(1)).alias("files"), F.sum("size").alias("bytes")))
    zero = F.lit(0).cast("long")
    return (tree.select("request_id", "dest_folder").distinct().join(files, ["request_id", "dest_folder"], "left")
                .select("request_id", "dest_folder", F.coalesce("files", zero).alias("files"),
                        F.coalesce("bytes", zero).alias("bytes")))


def loop_guard(resolved: DataFrame, requests: DataFrame) -> DataFrame:
    """P-14: requests whose destination lies inside (or is) one of their own
    source folders. Ancestors of the destination joined on
    (request, project, folder)."""
    d = parse_destinations(requests).filter(F.col("dest_scheme") == K.PROJECT_SCHEME)
    anc = d.select("request_id", F.col("dest_project").alias("project_id"),
                   F.explode(F.array_union(U.ancestors("dest_folder"), F.array("dest_folder"))).alias("folder"))
    src = (resolved.filter(F.col("kind") == FOLDER_KIND)
                   .select("request_id", "project_id", F.col("path").alias("folder"), "source_uri"))
    return src.join(anc, ["request_id", "project_id", "folder"], "left_semi").select("request_id", "source_uri")


def planned_files(targets: DataFrame, expanded: DataFrame, external: DataFrame | None = None) -> DataFrame:
    """All files a request moves: direct files, expanded folder contents and,
    if given, external objects (``actions.external_targets``; their URI is the
    id, ``found`` is false for those missing from the catalog).

    request_id, data_id, size, etag, target_project, target_folder, target_path, found
    """
    cols = ["request_id", "data_id", "size", "etag", "target_project", "target_folder", "target_path"]
    a = targets.select(*cols, F.lit(True).alias("found"))
    b = expanded.select("request_id", "data_id", "size", "etag", F.col("dest_project").alias("target_project"),
                        U.parent("dest_path").alias("target_folder"), F.col("dest_path").alias("target_path"),
                        F.lit(True).alias("found"))
    out = a.unionByName(b)
    if external is not None:
        out = out.unionByName(external.withColumn("data_id", F.col("source_uri")).select(*cols, "found"))
    return out

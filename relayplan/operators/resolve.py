"""Resolving URIs and ids against the inventory (J-1 .. J-4, J-6 .. J-8, W-2, W-5).

Every lookup is one equi-join over whole tables; the per-object API calls of
the original become a hash or sort-merge join picked by Catalyst/AQE. The
inventory is never broadcast: it is the largest table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.functions.predicates import part_class

FILE_KIND, FOLDER_KIND, EXTERNAL_KIND = "FILE", "FOLDER", "EXTERNAL"


def parse_destinations(requests: DataFrame) -> DataFrame:
    """request_id, dest_uri, dest_scheme, dest_project, dest_folder.

    ``dest_folder`` is the destination path with exactly one final ``/``.
    """
    d = F.col("destination_uri")
    return requests.select(
        "request_id",
        d.alias("dest_uri"),
        U.uri_scheme(d).alias("dest_scheme"),
        U.uri_netloc(d).alias("dest_project"),
        U.as_folder(U.uri_path(d)).alias("dest_folder"),
    )


def resolve_sources(sources: DataFrame, inventory: DataFrame) -> DataFrame:
    """J-1: each (request_id, pos, source_uri) -> FILE / FOLDER / EXTERNAL.

    Left equi-join on (project, path); only ``icav2`` URIs can resolve, the
    rest become EXTERNAL (unresolvable is not an error). List order is kept
    in ``pos`` (W-5).
    """
    u = F.col("source_uri")
    s = sources.select(
        "request_id", "pos", "source_uri",
        F.when(U.uri_scheme(u) == K.PROJECT_SCHEME, U.uri_netloc(u)).alias("_prj"),
        U.uri_path(u).alias("_path"),
    )
    inv = inventory.select(
        F.col("project_id").alias("_prj"), F.col("path").alias("_path"),
        "data_id", "data_type", "name", "size", "etag", F.lit(True).alias("_hit"))
    j = s.join(inv, ["_prj", "_path"], "left")
    own = lambda c: F.when(F.col("_hit"), F.col(c))  # noqa: E731  (the keys are the object's own)
    kind = (F.when(F.col("data_type") == K.FILE, F.lit(FILE_KIND))
             .when(F.col("data_type") == K.FOLDER, F.lit(FOLDER_KIND))
             .otherwise(F.lit(EXTERNAL_KIND)))
    return j.select("request_id", "pos", "source_uri", kind.alias("kind"),
                    own("_prj").alias("project_id"), "data_id", own("_path").alias("path"), "name", "size", "etag")


def external_sources(resolved: DataFrame) -> DataFrame:
    """J-2: the sources that did not resolve to a project object."""
    return resolved.filter(F.col("kind") == EXTERNAL_KIND).select("request_id", "pos", "source_uri")


def dest_folders(dest_inventory: DataFrame) -> DataFrame:
    """Existing destination folders: FOLDER objects (empty ones included) and
    every proper ancestor of a destination object."""
    own = dest_inventory.filter(F.col("data_type") == K.FOLDER).select("project_id", U.as_folder("path").alias("path"))
    anc = dest_inventory.select("project_id", F.explode(U.ancestors("path")).alias("path"))
    return own.unionByName(anc).distinct()


def missing_destinations(requests: DataFrame, dest_inventory: DataFrame, tree: DataFrame | None = None) -> DataFrame:
    """J-3: destination folders that must be created: the requests' own and,
    with ``tree`` (``expand.folder_tree``), one for each folder they copy.

    Only well-formed project destinations (``icav2``, final ``/``) count; the
    rest are validation errors (P-4). ``left_anti`` against existing folders.
    """
    cols = ["dest_uri", "dest_scheme", "dest_project", "dest_folder"]
    want = parse_destinations(requests).select(*cols)
    if tree is not None:
        want = want.unionByName(tree.select(*cols))
    d = (want.filter((F.col("dest_scheme") == K.PROJECT_SCHEME) & F.col("dest_uri").endswith("/"))
         .select(F.col("dest_project").alias("project_id"), F.col("dest_folder").alias("path"))
         .distinct())
    return d.join(dest_folders(dest_inventory), ["project_id", "path"], "left_anti")


def list_folder(folders: DataFrame, inventory: DataFrame) -> DataFrame:
    """J-4: direct children (files and folders) of each folder, as URIs.

    ``folders``: (project_id, path) with path ending in ``/``. Equi-join on
    the child's parent path.
    """
    f = folders.select(F.col("project_id"), F.col("path").alias("_parent")).distinct()
    c = inventory.select("project_id", U.parent("path").alias("_parent"), "path")
    j = f.join(c, ["project_id", "_parent"])
    return j.select(U.project_uri(F.col("project_id"), F.col("_parent")).alias("folder"),
                    U.project_uri(F.col("project_id"), F.col("path")).alias("child_uri"))


def lookup_by_id(refs: DataFrame, inventory: DataFrame, id_col: str = "data_id") -> DataFrame:
    """J-6/J-7: (…, data_id) -> size, found. Left equi-join on the id."""
    inv = inventory.filter(F.col("data_type") == K.FILE).select(
        F.col("data_id").alias(id_col), F.col("size").alias("size"), F.lit(True).alias("_hit"))
    j = refs.join(inv, id_col, "left")
    return j.withColumn("found", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")


def current_catalog(external_objects: DataFrame) -> DataFrame:
    """S-4 + W-2: current objects only, one row per URI.

    The original takes the first search result and states no order; here the
    smallest object id wins. ``min_by`` is an aggregate, so duplicate URIs are
    reduced map-side before the shuffle.
    """
    cur = external_objects.filter(F.col("current_state"))
    return (cur.groupBy("uri")
               .agg(F.min_by(F.struct("size", "etag", "bucket", "key"), F.col("s3_object_id")).alias("o"))
               .select("uri", "o.size", "o.etag", "o.bucket", "o.key"))


def external_metadata(uris: DataFrame, external_objects: DataFrame, uri_col: str = "uri") -> DataFrame:
    """J-8: size and loose multi-part flag by URI; ``found`` false when the
    object is missing or not current."""
    cat = current_catalog(external_objects).select(
        F.col("uri").alias(uri_col), "size", "etag",
        (part_class("etag", "loose") == "MULTI").alias("is_multipart"),
        F.lit(True).alias("_hit"))
    j = uris.join(cat, uri_col, "left")
    return j.withColumn("found", F.coalesce(F.col("_hit"), F.lit(False))).drop("_hit")

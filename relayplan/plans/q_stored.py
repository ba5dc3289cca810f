"""Queries over stored tables: loaders, the plan writer, small expressions
(S-3, S-4, S-10, E-6, E-13, E-16). Each table is written to the shared folder
first, as a deployment would have it."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan.functions import uri as U
from relayplan.functions.predicates import bool_text
from relayplan.operators import expand as X
from relayplan.operators import resolve as R
from relayplan.operators.plan import write_plan
from relayplan.plans.registry import query
from relayplan.session import scratch_path, stored
from relayplan.sources import catalog as C
from relayplan.sources import layout as L
from relayplan.sources.tables import Tables


@query("stored_inventory", """
select project_id, data_id, size, starts_with(path,'/runs/1995/') as in_1995 from inv
""")
def q_stored_inventory(spark, d):
    """S-3 + E-6: files of a stored inventory, and whether a folder holds them."""
    path = scratch_path(spark, "inventory")
    C.write_inventory(Tables(spark, d).inventory, path)
    inv = C.read_inventory(spark, path, data_type="FILE", cols=["project_id", "data_id", "data_type", "path", "size"])
    return inv.select("project_id", "data_id", "size", U.path_contains(F.lit("/runs/1995"), F.col("path")).alias("in_1995"))


def _bucketed(spark, inventory, name, by):
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    L.write_buckets(inventory, table, path, by)
    return spark.table(table)


@query("bucketed_sources", """
select request_id, cast(pos as bigint) as pos, kind, data_id, size from resolved
""")
def q_bucketed_sources(spark, d):
    """S-3 + J-1: sources looked up in an inventory bucketed by project and path."""
    t = Tables(spark, d)
    r = R.resolve_sources(t.request_sources, _bucketed(spark, t.inventory, "by_path", ("project_id", "path")))
    return r.select("request_id", F.col("pos").cast("bigint").alias("pos"), "kind", "data_id", "size")


@query("bucketed_ids", """
select r.request_id, cast(r.item as bigint) as item, r.data_id, i.size, i.data_id is not null as found
from ren r left join inv i on i.data_id=r.data_id where r.data_id is not null
""")
def q_bucketed_ids(spark, d):
    """S-3 + J-6: ids looked up in an inventory bucketed by id."""
    t = Tables(spark, d)
    refs = t.renaming_map.filter(F.col("data_id").isNotNull()).select(
        "request_id", F.col("item").cast("bigint").alias("item"), "data_id")
    by_id = _bucketed(spark, t.inventory.select("data_id", "data_type", "size"), "by_id", ("data_id",))
    return R.lookup_by_id(refs, by_id).select("request_id", "item", "data_id", "size", "found")


@query("touched_inventory", """
named as (select distinct regexp_extract(source_uri,'^[^:/?#]+://([^/]*)',1) as project_id,
    regexp_extract(source_uri,'^[^:/?#]+://[^/]*(/.*)$',1) as path
  from src where regexp_extract(source_uri,'^([^:/?#]+)://',1)='icav2'),
own as (select project_id, data_id, size, path as k from inventory
        union all
        select project_id, data_id, size, concat(array_to_string(list_slice(parts,1,i),'/'),'/') as k
        from (select *, unnest(range(1, len(parts))) as i
              from (select *, string_split(rtrim(path,'/'),'/') as parts from inventory)))
select distinct o.project_id, o.data_id, o.size from own o join named n on n.project_id=o.project_id and n.path=o.k
""")
def q_touched_inventory(spark, d):
    """S-3 + T-1: objects that sources name or that lie below them, from the
    areas of a stored inventory that the sources touch."""
    t = Tables(spark, d).stored("file_rows")
    path = scratch_path(spark, "areas-inventory")
    L.write_areas(t.inventory, path)
    named = L.project_paths(t.request_sources, "source_uri")
    areas = L.read_areas(spark, path)
    areas.stored_path = path
    inv = L.prune(areas, L.touched_areas(named))
    # an object meets itself and its ancestors, which end in "/" and hold as many as a named folder
    levels = X.folder_levels(named.filter(F.col("path").endswith("/")))
    above = U.ancestors("path", F.coalesce("_levels", F.array().cast("array<int>")))
    keys = (inv.join(levels, "project_id", "left")
            .select("project_id", "data_id", "size", F.explode(F.concat(F.array("path"), above)).alias("key")))
    # an object may be met by its own path and by folders; written before these are told apart
    met = stored(keys.join(named.withColumnRenamed("path", "key").distinct(), ["project_id", "key"], "left_semi")
                 .select("project_id", "data_id", "size"), areas, t.file_rows)
    return met.distinct()


@query("stored_catalog", """
select uri, size, 'true' as is_current from ext where current_state
""")
def q_stored_catalog(spark, d):
    """S-4 + E-16: current objects of a stored catalog."""
    path = scratch_path(spark, "catalog")
    Tables(spark, d).external_objects.drop("uri").write.parquet(path)
    return C.read_external_catalog(spark, path).select("uri", "size", bool_text("current_state").alias("is_current"))


@query("stored_plan", """
select request_id, kind, count(*) as n from resolved group by all
""")
def q_stored_plan(spark, d):
    """S-10: the plan written by kind and read back."""
    t = Tables(spark, d)
    path = scratch_path(spark, "plan")
    write_plan(R.resolve_sources(t.request_sources, t.inventory), path)
    return spark.read.parquet(path).groupBy("request_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("heartbeat_inputs", """
select request_id, case when o_custkey%41<>0 then concat('{"taskToken":"',task_token,'"}') else '{}' end as body from req
""")
def q_heartbeat_inputs(spark, d):
    """E-13: null fields do not appear in the object."""
    token = F.when(F.col("o_custkey") % 41 != 0, F.col("task_token"))
    return Tables(spark, d).requests.select("request_id", F.to_json(F.struct(token.alias("taskToken"))).alias("body"))

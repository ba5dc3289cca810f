"""Queries: recursive expansion, jobs, loop guard, collisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan.functions import uri as U
from relayplan.operators import actions as A
from relayplan.operators import expand as X
from relayplan.operators import resolve as R
from relayplan.plans.q_planning import FILES, PLACES, _expand, _resolved, _tables
from relayplan.plans.registry import query
from relayplan.sources.tables import Tables

def _expanded(t: Tables, cols=FILES):
    resolved = _resolved(t, cols)
    return resolved, _expand(t, resolved)


@query("expand_recursive", """
select request_id, data_id, dest_path from expanded
""")
def q_expand_recursive(spark, d):
    _, e = _expanded(_tables(spark, d), PLACES)
    return e.select("request_id", "data_id", "dest_path")


@query("recursive_jobs", """
t as (select distinct request_id, dest_folder from ftree)
select t.request_id, t.dest_folder, count(e.data_id) as files, cast(coalesce(sum(e.size), 0) as bigint) as bytes
from t left join expanded e on e.request_id=t.request_id and regexp_replace(e.dest_path,'[^/]+/?$','')=t.dest_folder
group by all
""")
def q_recursive_jobs(spark, d):
    t = _tables(spark, d)
    resolved, e = _expanded(t, PLACES)
    return X.recursive_jobs(X.folder_tree(resolved, t.requests, t.inventory, X.source_levels(resolved)), e)


@query("loop_guard", """
req2 as (select * replace (case when request_id%70=0 then concat('icav2://',project_id,src_folder,'copy/')
                                 else destination_uri end as destination_uri) from req),
d2 as (select request_id, regexp_extract(destination_uri,'^[^:/?#]+://([^/]*)',1) as dest_project,
    regexp_replace(concat(regexp_extract(destination_uri,'^[^:/?#]+://[^/]*(/.*)?$',1),'/'),'/+$','/') as dest_folder
  from req2 where regexp_extract(destination_uri,'^([^:/?#]+)://',1)='icav2')
select r.request_id, r.source_uri from resolved r
where r.kind='FOLDER' and exists (select 1 from d2 where d2.request_id=r.request_id
  and d2.dest_project=r.project_id and starts_with(d2.dest_folder, r.path))
""")
def q_loop_guard(spark, d):
    t = Tables(spark, d)
    rid = F.col("request_id")
    req2 = t.requests.withColumn(
        "destination_uri",
        F.when(rid % 70 == 0, U.project_uri(F.col("project_id"), F.concat(F.col("src_folder"), F.lit("copy/"))))
         .otherwise(F.col("destination_uri")))
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    return X.loop_guard(resolved, req2)


@query("copy_jobs", """
pfiles as (select request_id, data_id, size, etag, target_project, target_folder from targets
  union all select request_id, data_id, size, etag, dest_project, regexp_replace(dest_path,'[^/]+/?$','') from expanded)
select request_id, target_project, target_folder as dest, count(*) as files, cast(sum(size) as bigint) as bytes,
  min(data_id) as first_id, max(data_id) as last_id
from pfiles where etag is not null and regexp_full_match(etag,'\\w+-\\d+') group by all
""")
def q_copy_jobs(spark, d):
    t = _tables(spark, d)
    resolved, e = _expanded(t)
    planned = X.planned_files(A.file_targets(resolved, t.requests), e)
    return A.build_copy_jobs(A.job_members(planned))


@query("destination_collisions", """
rv as (select request_id+1 as request_id, pos, source_uri, kind, project_id, data_id, path, name, size, etag
       from resolved where kind='FILE' and request_id%6=0
       union all select * from resolved where kind='FILE'),
tg as (select r.request_id, d.dest_project as target_project,
    regexp_replace(regexp_replace(concat(d.dest_folder,'/',r.name),'/(\\./)+','/','g'),'/+','/','g') as target_path
  from rv r join dest d using (request_id)),
al as (select * from tg union all select request_id, dest_project, dest_path from expanded)
select request_id, target_path as dest_path, count(*) as n from al
group by request_id, target_project, target_path having count(*) > 1
""")
def q_destination_collisions(spark, d):
    """A-8 over planned target paths. Every sixth request's named files are
    also sources of the request after it, whose files have the same names."""
    t = _tables(spark, d)
    resolved, e = _expanded(t)
    named = resolved.filter(F.col("kind") == R.FILE_KIND)
    shared = named.filter(F.col("request_id") % 6 == 0).withColumn("request_id", F.col("request_id") + 1)
    return A.destination_collisions(X.planned_files(A.file_targets(named.unionByName(shared), t.requests), e))

"""Queries: URIs, resolution, actions and their summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan.functions import uri as U
from relayplan.functions.predicates import part_class
from relayplan.operators import actions as A
from relayplan.operators import expand as X
from relayplan.operators import resolve as R
from relayplan.plans.registry import query
from relayplan.session import discard, stored
from relayplan.sources.tables import Tables


def _tables(spark, d):
    """Tables for whole plans, which read the files many times."""
    return Tables(spark, d).stored("file_rows")


#: Columns of resolved sources that say where files are and go, and those of the files themselves.
PLACES = ("request_id", "pos", "source_uri", "kind", "project_id", "path", "name")
FILES = (*PLACES, "data_id", "size", "etag")


def _resolved(t: Tables, cols=FILES):
    """The resolved sources, written once: named files, folders and externals
    each read them. Only ``cols`` of the inventory are exchanged."""
    return stored(R.resolve_sources(t.request_sources, t.inventory).select(*cols))


def _expand(t: Tables, resolved):
    """Contents of the folders among stored ``resolved``."""
    return X.expand_recursive(resolved, t.requests, t.inventory, levels=X.source_levels(resolved))


#: Columns of planned files that decide an action, those that name a file, and those of its parts.
ACTION = ("request_id", "size", "target_project", "target_path", "found")
NAMED = (*ACTION, "data_id")
PARTS = ("request_id", "data_id", "size", "etag")


def _planned(t: Tables, cols, resolved=None):
    """``cols`` of every file of the plan: named files, contents of named folders,
    externals. Written once, so that the exchanges that make them are gone before
    those that use them begin. ``resolved`` is kept if given."""
    own = resolved
    if own is None:
        # each kind keeps what its part of the plan reads
        kept = {"source_uri": R.EXTERNAL_KIND, "path": R.FOLDER_KIND, "data_id": R.FILE_KIND}
        if "etag" not in cols:
            kept["etag"] = None
        own = stored(R.resolve_sources(t.request_sources, t.inventory).select(
            *[F.when(F.col("kind") == kept[c], F.col(c)).alias(c) if c in kept else c for c in FILES]))
    planned = X.planned_files(A.file_targets(own, t.requests), _expand(t, own),
                              A.external_targets(own, t.requests, t.external_objects))
    return stored(planned.select(*cols), *([] if resolved else [own]))


def _actions(t: Tables, cols=NAMED):
    return A.transfer_action(_planned(t, cols), t.destination_inventory)


@query("uri_parts", """
u as (select url as uri from pages union all select source_uri from src),
p as (select uri, regexp_extract(uri,'^([^:/?#]+)://',1) as scheme,
        regexp_extract(uri,'^[^:/?#]+://([^/]*)',1) as netloc,
        regexp_extract(uri,'^[^:/?#]+://[^/]*(/.*)?$',1) as path from u)
select uri, scheme, netloc, path, regexp_extract(path,'([^/]+)/*$',1) as base,
  regexp_replace(path,'[^/]+/?$','') as parent, regexp_replace(path,'^/+','') as key from p
""")
def q_uri_parts(spark, d):
    t = Tables(spark, d)
    u = (t.raw("pages", ["url"]).select(F.col("url").alias("uri"))
          .unionByName(t.request_sources.select(F.col("source_uri").alias("uri"))))
    p = U.uri_path("uri")
    return u.select("uri", U.uri_scheme("uri").alias("scheme"), U.uri_netloc("uri").alias("netloc"),
                    p.alias("path"), U.basename(p).alias("base"), U.parent(p).alias("parent"),
                    U.strip_leading_slash(p).alias("key"))


@query("part_class", """
select data_id,
  case when etag is null then 'UNKNOWN' when regexp_full_match(etag,'\\w+-\\d+') then 'MULTI' else 'SINGLE' end as strict,
  case when etag is null then 'UNKNOWN' when contains(etag,'-') then 'MULTI' else 'SINGLE' end as loose
from inventory where data_type='FILE'
""")
def q_part_class(spark, d):
    inv = Tables(spark, d).inventory.filter(F.col("data_type") == "FILE")
    return inv.select("data_id", part_class("etag", "strict").alias("strict"),
                      part_class("etag", "loose").alias("loose"))


@query("part_split", f"""
pc as (select request_id, data_id, size,
  case when etag is null then 'UNKNOWN' when regexp_full_match(etag,'\\w+-\\d+') then 'MULTI' else 'SINGLE' end as part_class
  from planned),
pl as (select request_id, part_class, data_id, count(*) over w as files, cast(sum(size) over w as bigint) as bytes,
    min(data_id) over w as first_id, max(data_id) over w as last_id,
    cast((row_number() over (partition by request_id, part_class order by data_id nulls first) - 1) // {A.LIST_ITEMS} as bigint) as part
  from pc window w as (partition by request_id, part_class))
select request_id, part_class, files, bytes, first_id, last_id, part, string_agg(data_id, chr(10) order by data_id) as ids
from pl group by all
""")
def q_part_split(spark, d):
    planned = _planned(_tables(spark, d), PARTS)
    lists = A.split_parts(planned, "strict")
    discard(planned)
    return lists


@query("external_metadata", """
cat as (select uri, arg_min(size, s3_object_id) as size, arg_min(etag, s3_object_id) as etag
        from ext where current_state group by uri)
select e.request_id, e.uri, c.size, contains(c.etag,'-') as is_multipart, c.uri is not null as found
from extl e left join cat c using (uri)
""")
def q_external_metadata(spark, d):
    t = Tables(spark, d)
    return R.external_metadata(t.external_sources.select("request_id", "uri"), t.external_objects) \
            .select("request_id", "uri", "size", "is_multipart", "found")


@query("resolve_sources", """
select request_id, cast(pos as bigint) as pos, kind, data_id from resolved
""")
def q_resolve_sources(spark, d):
    t = Tables(spark, d)
    r = R.resolve_sources(t.request_sources, t.inventory)
    return r.select("request_id", F.col("pos").cast("bigint").alias("pos"), "kind", "data_id")


@query("external_sources", """
select request_id, source_uri from resolved where kind='EXTERNAL'
""")
def q_external_sources(spark, d):
    t = Tables(spark, d)
    return R.external_sources(R.resolve_sources(t.request_sources, t.inventory)).select("request_id", "source_uri")


@query("missing_destinations", """
dfold as (select distinct project_id, concat(array_to_string(list_slice(parts,1,i),'/'),'/') as path
  from (select project_id, parts, unnest(range(1, len(parts))) as i
        from (select project_id, string_split(path,'/') as parts from dst))),
want as (select dest_project as project_id, dest_folder as path from dest
         where dest_scheme='icav2' and ends_with(dest_uri,'/')
         union select dest_project, dest_folder from ftree where dest_scheme='icav2' and ends_with(dest_uri,'/'))
select project_id, path from want w
where not exists (select 1 from dfold f where f.project_id=w.project_id and f.path=w.path)
""")
def q_missing_destinations(spark, d):
    t = _tables(spark, d)
    resolved = _resolved(t, PLACES)
    return R.missing_destinations(t.requests, t.destination_inventory,
                                  X.folder_tree(resolved, t.requests, t.inventory, X.source_levels(resolved)))


@query("list_folder", """
f as (select distinct project_id, path from resolved where kind='FOLDER')
select concat('icav2://',f.project_id,f.path) as folder, concat('icav2://',i.project_id,i.path) as child_uri
from f join inventory i on i.project_id=f.project_id and regexp_replace(i.path,'[^/]+/?$','')=f.path
""")
def q_list_folder(spark, d):
    t = Tables(spark, d)
    r = R.resolve_sources(t.request_sources, t.inventory)
    folders = r.filter(F.col("kind") == R.FOLDER_KIND).select("project_id", "path")
    return R.list_folder(folders, t.inventory)


@query("lookup_by_id", """
select r.request_id, cast(r.item as bigint) as item, r.data_id, i.size, i.data_id is not null as found
from ren r left join inv i on i.data_id=r.data_id where r.data_id is not null
""")
def q_lookup_by_id(spark, d):
    t = Tables(spark, d)
    refs = t.renaming_map.filter(F.col("data_id").isNotNull()).select(
        "request_id", F.col("item").cast("bigint").alias("item"), "data_id")
    return R.lookup_by_id(refs, t.inventory).select("request_id", "item", "data_id", "size", "found")


@query("transfer_action", """
select request_id, data_id, action from actions
""")
def q_transfer_action(spark, d):
    return _actions(_tables(spark, d)).select("request_id", "data_id", "action")


@query("transfer_summary", """
select request_id, action, count(*) as files, cast(sum(size) as bigint) as bytes from actions group by all
""")
def q_transfer_summary(spark, d):
    return A.transfer_summary(_actions(_tables(spark, d), ACTION))


@query("transfer_rollup", """
select target_project as dest_project_id, action, count(*) as files, cast(sum(size) as bigint) as bytes,
  cast(grouping(target_project, action) as bigint) as level
from actions group by rollup(target_project, action)
""")
def q_transfer_rollup(spark, d):
    return A.transfer_rollup(_actions(_tables(spark, d), ACTION)).select(
        "dest_project_id", "action", "files", "bytes", F.col("level").cast("bigint").alias("level"))


@query("largest_transfers", """
select request_id, data_id, size from actions where action in ('COPY','REPLACE_PARTIAL')
order by size desc, data_id asc, request_id asc limit 20
""")
def q_largest_transfers(spark, d):
    return A.largest_transfers(_actions(_tables(spark, d)), 20)


@query("partials_to_delete", """
pfiles as (select target_project, target_path from targets
  union all select dest_project, dest_path from expanded)
select x.project_id, x.path from dst x
where x.status='PARTIAL' and exists (select 1 from pfiles p where p.target_project=x.project_id
  and regexp_replace(p.target_path,'[^/]+/?$','')=regexp_replace(x.path,'[^/]+/?$','')
  and regexp_extract(p.target_path,'([^/]+)/*$',1)=x.name)
""")
def q_partials_to_delete(spark, d):
    """J-9 for every copy job of the plan: direct files and folder contents."""
    t = _tables(spark, d)
    resolved = _resolved(t)
    planned = X.planned_files(A.file_targets(resolved, t.requests), _expand(t, resolved))
    return A.partials_to_delete(planned, t.destination_inventory)


@query("still_missing", """
select p.request_id, p.target_path as dest_path from planned p
where not exists (select 1 from dst x where x.project_id=p.target_project and x.path=p.target_path)
""")
def q_still_missing(spark, d):
    """U-4 over the whole plan."""
    t = _tables(spark, d)
    m = A.still_missing(_planned(t, ("request_id", "target_project", "target_path")), t.destination_inventory)
    return m.select("request_id", F.col("target_path").alias("dest_path"))


@query("plan_summary", """
select request_id, count(*) filter (where kind='FILE') as n_files,
  count(*) filter (where kind='FOLDER') as n_folders, count(*) filter (where kind='EXTERNAL') as n_external
from resolved group by request_id
""")
def q_plan_summary(spark, d):
    from relayplan.operators.plan import assemble_plan
    t = Tables(spark, d)
    return assemble_plan(R.resolve_sources(t.request_sources, t.inventory))


@query("s3_targets", """
select x.project_id, x.path, concat('s3://',c.bucket,'/',c.prefix,regexp_replace(x.path,'^/+','')) as s3_uri
from dst x join storage_config c using (project_id)
""")
def q_s3_targets(spark, d):
    from relayplan.operators.plan import s3_targets
    t = Tables(spark, d)
    return s3_targets(t.destination_inventory.select("project_id", "path"), t.storage_config)


@query("external_actions", """
cat as (select uri, arg_min(size, s3_object_id) as size from ext where current_state group by uri),
et as (select r.request_id, r.source_uri, c.size, c.uri is not null as found, d.dest_project as target_project,
    regexp_replace(regexp_replace(concat(d.dest_folder,'/',
      regexp_extract(regexp_extract(r.source_uri,'^[^:/?#]+://[^/]*(/.*)?$',1),'([^/]+)/*$',1)),
      '/(\\./)+','/','g'),'/+','/','g') as target_path
  from resolved r join dest d using (request_id) left join cat c on c.uri=r.source_uri
  where r.kind='EXTERNAL' and regexp_extract(r.source_uri,'^([^:/?#]+)://',1)='s3')
select et.request_id, et.source_uri,
  case when not et.found then 'MISSING_SOURCE' when x.status is null then 'COPY'
       when x.status='PARTIAL' then 'REPLACE_PARTIAL' when x.size is not distinct from et.size then 'SKIP'
       else 'CONFLICT' end as action
from et left join dst x on x.project_id=et.target_project and x.path=et.target_path
""")
def q_external_actions(spark, d):
    t = Tables(spark, d)
    resolved = R.resolve_sources(t.request_sources, t.inventory)
    tg = A.external_targets(resolved, t.requests, t.external_objects)
    return A.external_actions(tg, t.destination_inventory).select("request_id", "source_uri", "action")


@query("event_transfer_summary", """
select request_id, action, count(*) as files, cast(sum(size) as bigint) as bytes from actions group by all
""")
def q_event_transfer_summary(spark, d):
    """The production path: JSON request events -> plan -> files and bytes
    per request and action (equals transfer_summary: every request arrives
    as one event, in either layout)."""
    from relayplan.plans.planner import plan_transfers, requests_from_events
    from relayplan.sources import events as EV
    from relayplan.sources.request_events import request_event_bodies
    t = _tables(spark, d)
    parsed = EV.parse_requests(request_event_bodies(t))
    good, _ = EV.quarantine(parsed, EV.message_problem())
    # parsed once: what the plan reads of an event
    p = F.col("request.payload")
    request = F.struct(F.struct(*[p.getField(f.name).alias(f.name) if f.name in ("sourceUriList", "destinationUri")
                                  else F.lit(None).cast(f.dataType).alias(f.name) for f in EV.PAYLOAD]).alias("payload"),
                       "request.taskToken", "request.layout")
    good = stored(EV.normalise_legacy(good).select("request_id", "part", request.alias("request")))
    et = requests_from_events(good)
    plan = plan_transfers(et.requests, et.sources, t.inventory, t.destination_inventory, t.external_objects,
                          store=stored, cols=ACTION)
    discard(good, plan.resolved)
    return A.transfer_summary(plan.actions)


@query("transfer_report", """
select request_id, action,
  case when etag is null then 'UNKNOWN' when regexp_full_match(etag,'\\w+-\\d+') then 'MULTI' else 'SINGLE' end as part_class,
  count(*) as files, cast(sum(size) as bigint) as bytes, max(size) as max_size
from actions group by all
""")
def q_transfer_report(spark, d):
    return A.transfer_report(_actions(_tables(spark, d), (*ACTION, "etag")))

"""Queries: verification, job states, registry, heartbeats."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan.functions.predicates import summarise_poll, summarise_push
from relayplan.functions import uri as U
from relayplan.operators import jobs as J
from relayplan.operators import resolve as R
from relayplan.operators import ticks as TK
from relayplan.operators import verify as V
from relayplan.plans.q_planning import NAMED, PLACES, _expand, _planned, _resolved, _tables
from relayplan.plans.registry import query
from relayplan.session import discard, stored
from relayplan.sources import events as EV
from relayplan.sources.tables import Tables

AS_OF = "2024-01-15 00:00:00"
TS_FMT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
SQL_TS = "strftime({c}, '%Y-%m-%d %H:%M:%S.%f')"
PATH = "'^[^:/?#]+://[^/]*(/.*)?$'"
SCHEME = "'^([^:/?#]+)://'"
NETLOC = "'^[^:/?#]+://([^/]*)'"


def as_of():
    return F.expr(f"TIMESTAMP_NTZ '{AS_OF}'")


def ts_text(c: str):
    return F.date_format(F.col(c), TS_FMT)


def _lookup_sql(src: str, uri: str, out: str) -> str:
    """SQL: left-join sizes for URI column ``uri`` of CTE ``src``."""
    return f"""
  select s.*, coalesce(o.size, e.size) as {out}, (o.path is not null or e.uri is not null) as {out}_found
  from {src} s
  left join objs o on regexp_extract(s.{uri},{SCHEME},1)='icav2'
    and o.project_id=regexp_extract(s.{uri},{NETLOC},1) and o.path=regexp_extract(s.{uri},{PATH},1)
  left join cat e on regexp_extract(s.{uri},{SCHEME},1)='s3' and e.uri=s.{uri}"""


OBJ_SQL = """
objs as (select project_id, path, size from inventory where data_type='FILE'
         union all select project_id, path, size from dst),
cat as (select uri, arg_min(size, s3_object_id) as size from ext where current_state group by uri)
"""


def _objects(t: Tables):
    cols = ["project_id", "path", "data_type", "size"]
    return t.inventory.select(*cols).unionByName(t.destination_inventory.select(*cols))


def _steps(*unread):
    """A ``store`` of steps of which each replaces the one before; without the columns
    ``unread``, which no later step reads."""
    last = []

    def store(df):
        last[:] = [stored(df.drop(*unread), *last)]
        return last[0]
    return store


def _size_checks(t: Tables, planned):
    """The expected size at each planned place of the whole plan."""
    tg = planned.join(R.parse_destinations(t.requests).select("request_id", "dest_scheme"), "request_id")
    return tg.select("request_id", "data_id",
                     F.concat(F.col("dest_scheme"), F.lit("://"), F.col("target_project"), F.col("target_path"))
                     .alias("output_uri"), F.col("size").alias("expected"))


def _pair_checks(t: Tables, resolved):
    """Source and destination folder of each planned file: named files,
    folder contents (their own destination folder) and externals."""
    d = t.requests.select("request_id", "destination_uri")
    named = (resolved.filter(F.col("kind").isin(R.FILE_KIND, R.EXTERNAL_KIND))
                     .select("request_id", "source_uri").join(d, "request_id"))
    below = _expand(t, resolved).select("request_id", "data_id", "dest_project", "dest_path")
    files = t.files.select("data_id", U.project_uri(F.col("project_id"), F.col("path")).alias("source_uri"))
    scheme = R.parse_destinations(t.requests).select("request_id", "dest_scheme")
    return named.unionByName(below.join(files, "data_id").join(scheme, "request_id").select(
        "request_id", "source_uri", F.concat(F.col("dest_scheme"), F.lit("://"), F.col("dest_project"),
                                             U.parent("dest_path")).alias("destination_uri")))


PAIR_SQL = """
pc as (select r.request_id, r.source_uri, q.destination_uri from resolved r join req q using (request_id)
       where r.kind in ('FILE','EXTERNAL')
       union all select e.request_id, concat('icav2://',i.project_id,i.path),
         concat(d.dest_scheme,'://',e.dest_project,regexp_replace(e.dest_path,'[^/]+/?$',''))
       from expanded e join inv i using (data_id) join dest d on d.request_id=e.request_id)
"""


@query("verify_size", OBJ_SQL + f""",
chk as (select t.request_id, t.data_id, concat(d.dest_scheme,'://',t.target_project,t.target_path) as output_uri,
  t.size as expected from planned t join dest d using (request_id)),
l as ({_lookup_sql('chk', 'output_uri', 'actual')})
select request_id, data_id, output_uri, expected, actual,
  case when regexp_extract(output_uri,{SCHEME},1) not in ('s3','icav2') then 'UNSUPPORTED'
       when not actual_found then 'MISSING' when expected is not distinct from actual then 'OK' else 'MISMATCH' end as result
from l
""")
def q_verify_size(spark, d):
    t = _tables(spark, d)
    return V.verify_size(_size_checks(t, _planned(t, NAMED)), _objects(t), t.external_objects).select(
        "request_id", "data_id", "output_uri", "expected", "actual", "result")


NORM = "regexp_replace(regexp_replace({x},'/(\\./)+','/','g'),'/+','/','g')"


@query("verify_pair", OBJ_SQL + f""",
{PAIR_SQL},
pd as (select *, concat(regexp_extract(destination_uri,{SCHEME},1),'://',regexp_extract(destination_uri,{NETLOC},1),
  {NORM.format(x=f"concat(regexp_extract(destination_uri,{PATH},1),'/',regexp_extract(regexp_extract(source_uri,{PATH},1),'([^/]+)/*$',1))")}) as dest_uri
  from pc),
l1 as ({_lookup_sql('pd', 'dest_uri', 'dest_size')}),
l2 as ({_lookup_sql('l1', 'source_uri', 'source_size')})
select request_id, source_uri, dest_uri,
  case when regexp_extract(dest_uri,{SCHEME},1) not in ('s3','icav2')
         or regexp_extract(source_uri,{SCHEME},1) not in ('s3','icav2') then 'UNSUPPORTED'
       when not source_size_found then 'MISSING' when not dest_size_found then 'MISSING'
       when source_size is not distinct from dest_size then 'OK' else 'MISMATCH' end as result
from l2
""")
def q_verify_pair(spark, d):
    t = _tables(spark, d)
    resolved = _resolved(t, PLACES)
    r = V.verify_pair(_pair_checks(t, resolved), _objects(t), t.external_objects, store=_steps("destination_uri"))
    discard(resolved)
    return r.select("request_id", "source_uri", "dest_uri", "result")


PD_SQL = f"""pd as (select *, concat(regexp_extract(destination_uri,{SCHEME},1),'://',regexp_extract(destination_uri,{NETLOC},1),
  {NORM.format(x=f"concat(regexp_extract(destination_uri,{PATH},1),'/',regexp_extract(regexp_extract(source_uri,{PATH},1),'([^/]+)/*$',1))")}) as dest_uri
  from pc)"""


@query("verify_transfer", OBJ_SQL + f""",
chk as (select t.request_id, t.data_id, concat(d.dest_scheme,'://',t.target_project,t.target_path) as output_uri,
  t.size as expected from planned t join dest d using (request_id)),
ls as ({_lookup_sql('chk', 'output_uri', 'actual')}),
{PAIR_SQL}, {PD_SQL},
l1 as ({_lookup_sql('pd', 'dest_uri', 'dest_size')}),
l2 as ({_lookup_sql('l1', 'source_uri', 'source_size')}),
a as (select request_id, case when expected is null then 'INVALID' else 'SIZE' end as mode,
    case when expected is null then 'INVALID'
       when regexp_extract(output_uri,{SCHEME},1) not in ('s3','icav2') then 'UNSUPPORTED'
       when not actual_found then 'MISSING' when expected is not distinct from actual then 'OK' else 'MISMATCH' end as result
  from ls
  union all select request_id, 'PAIR',
    case when regexp_extract(dest_uri,{SCHEME},1) not in ('s3','icav2')
         or regexp_extract(source_uri,{SCHEME},1) not in ('s3','icav2') then 'UNSUPPORTED'
       when not source_size_found then 'MISSING' when not dest_size_found then 'MISSING'
       when source_size is not distinct from dest_size then 'OK' else 'MISMATCH' end
  from l2)
select request_id, mode, result, count(*) as n from a group by all
""")
def q_verify_transfer(spark, d):
    """P-8: size checks, pair checks and checks with neither (an external
    source whose size is unknown) through one dispatch."""
    t = _tables(spark, d)
    resolved = _resolved(t)
    nul = F.lit(None).cast("string")
    planned = _planned(t, NAMED, resolved)
    size = _size_checks(t, planned).select(F.col("request_id").alias("check_id"), F.col("expected").alias("file_size"),
                                  "output_uri", nul.alias("destination_uri"), nul.alias("source_uri"))
    pair = _pair_checks(t, resolved).select(F.col("request_id").alias("check_id"), F.lit(None).cast("long").alias("file_size"),
                                  nul.alias("output_uri"), "destination_uri", "source_uri")
    r = V.verify_transfer(size.unionByName(pair), _objects(t), t.external_objects, store=_steps())
    discard(resolved, planned)
    return (r.withColumnRenamed("check_id", "request_id").groupBy("request_id", "mode", "result")
             .agg(F.count(F.lit(1)).alias("n")))


def _status_bodies(t: Tables):
    """Queue bodies: JSON arrays of up to five notifications (S-5)."""
    e = t.job_status_events
    item = F.struct(F.struct(F.col("job_id").alias("id"), F.col("status")).alias("payload"))
    return (e.groupBy(F.floor(F.col("event_id") / 5).alias("batch"))
             .agg(F.to_json(F.collect_list(item)).alias("body")))


@query("status_summary", """
select status,
  case when status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING') then 'RUNNING'
       when status in ('STOPPED','PARTIALLY_SUCCEEDED','FAILED') then 'FAILED' else 'SUCCEEDED' end as poll,
  case when status='SUCCEEDED' then 'SUCCESS'
       when status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING') then 'NON_TERMINAL' else 'FAILURE' end as push,
  count(*) as n
from job group by status
""")
def q_status_summary(spark, d):
    n = EV.parse_status_bodies(_status_bodies(Tables(spark, d)))
    return (n.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
             .select("status", summarise_poll(F.col("status")).alias("poll"),
                     summarise_push(F.col("status")).alias("push"), "n"))


@query("match_status", """
select event_id, case when r.id is null then 'NOT_IN_DB' when status='SUCCEEDED' then 'SUCCESS'
  when status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING') then 'NON_TERMINAL' else 'FAILURE' end as outcome
from job left join (select id from regp where id_type='JOB_ID') r on r.id=job.job_id
""")
def q_match_status(spark, d):
    t = Tables(spark, d)
    return J.match_status(t.job_status_events, t.job_registry).select("event_id", "outcome")


FIRST_SQL = f"""
ft as (select job_id, status, ts from (select *, row_number() over (partition by job_id order by ts, event_id) as rn
  from job where status not in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING')
    and job_id in (select id from regp where id_type='JOB_ID')) where rn=1)
"""


@query("first_terminal", FIRST_SQL + f"""
select job_id, status, {SQL_TS.format(c='ts')} as ts from ft
""")
def q_first_terminal(spark, d):
    t = Tables(spark, d)
    f = J.first_terminal(t.job_status_events, t.job_registry)
    return f.select("job_id", "status", ts_text("ts").alias("ts"))


LATEST_SQL = f"""
ls as (select job_id, status from (select *, row_number() over (partition by job_id order by ts desc, event_id desc) as rn
  from job where ts <= timestamp '{AS_OF}') where rn=1)
"""


@query("latest_status", LATEST_SQL + """
select job_id, status from ls
""")
def q_latest_status(spark, d):
    return J.latest_status(Tables(spark, d).job_status_events, as_of())


def _new_registrations(t: Tables):
    r = t.job_registry
    return (r.filter(F.substring(F.md5("id"), 1, 1).isin("0", "1", "2", "3"))
             .select("id", "id_type", F.md5(F.concat("id", F.lit("-v2"))).alias("task_token"),
                     (F.col("registered_at") + F.expr("INTERVAL 1 HOUR")).alias("registered_at")))


@query("registry_upsert", """
newr as (select id, id_type, md5(concat(id,'-v2')) as task_token, registered_at + interval 1 hour as registered_at
  from regp where substr(md5(id),1,1) in ('0','1','2','3')),
u as (select *, 0 as v from regp union all select *, 1 from newr)
select id, id_type, task_token from (select *, row_number() over (partition by id, id_type
  order by registered_at desc, v desc) as rn from u) where rn=1
""")
def q_registry_upsert(spark, d):
    t = Tables(spark, d)
    return J.upsert_registry(t.job_registry, _new_registrations(t)).select("id", "id_type", "task_token")


@query("registry_delete", FIRST_SQL + """
select id, id_type, task_token from regp
where not (id_type='JOB_ID' and id in (select job_id from ft))
""")
def q_registry_delete(spark, d):
    t = Tables(spark, d)
    done = J.first_terminal(t.job_status_events, t.job_registry).select("job_id")
    return J.delete_registry(t.job_registry, done).select("id", "id_type", "task_token")


@query("registry_expire", f"""
select id, id_type from regp where registered_at + interval 1 day > timestamp '{AS_OF}'
""")
def q_registry_expire(spark, d):
    r = Tables(spark, d).job_registry.withColumn("expire_at", F.col("registered_at") + F.expr("INTERVAL 1 DAY"))
    return J.expire_registry(r, as_of()).select("id", "id_type")


@query("pending_jobs", """
select id_type, count(*) as n from regp group by id_type
""")
def q_pending_jobs(spark, d):
    return J.pending_count(Tables(spark, d).job_registry)


@query("poll_pending", LATEST_SQL + """
select r.id as job_id, case when ls.status is null or ls.status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING')
    then 'HEARTBEAT' when ls.status in ('STOPPED','PARTIALLY_SUCCEEDED','FAILED') then 'FAILURE' else 'SUCCESS' end as signal
from regp r left join ls on ls.job_id=r.id where r.id_type='JOB_ID'
""")
def q_poll_pending(spark, d):
    t = Tables(spark, d)
    return J.poll_pending(t.job_registry, t.job_status_events, as_of()).select("job_id", "signal")


@query("external_heartbeats", """
select execution_id, json_extract_string(input, '$.taskToken') as task_token from executions where status='RUNNING'
""")
def q_external_heartbeats(spark, d):
    return J.external_heartbeats(Tables(spark, d).executions)


@query("heartbeat_batches", """
x as (select execution_id from executions where status='RUNNING'),
y as (select *, cast(floor((row_number() over (order by execution_id) - 1)/50) as bigint) as batch_no from x)
select batch_no, count(*) as n, min(execution_id) as first_id from y group by all
""")
def q_heartbeat_batches(spark, d):
    ex = J.scan_running_executions(Tables(spark, d).executions)
    return J.batches(ex, "execution_id")


#: Waiting intervals and the ticks of the schedule, by definition.
TICKS_SQL = f"""
wait as (select id as job_id, registered_at as r, min(ts) filter (status not in
    ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING')) as t
  from regp left join job on job_id = id where id_type='JOB_ID' group by id, registered_at),
span as (select min(registered_at) as a, (select max(ts) from job) as b from regp),
tick as (select unnest(generate_series(time_bucket(interval 3 minute, a, timestamp '1970-01-01 00:00:00'), b,
    interval 3 minute)) as tick from span)
"""


def horizon(t: Tables):
    """The instant up to which ticks are made: the newest notification."""
    return F.lit(t.job_status_events.agg(F.max("ts")).first()[0])


@query("heartbeat_ticks", TICKS_SQL + f"""
select {SQL_TS.format(c='tick')} as window_start, count(*) as jobs
from tick join wait on r <= tick and (t is null or t > tick) group by tick
""")
def q_heartbeat_ticks(spark, d):
    t = Tables(spark, d)
    h = TK.heartbeat_ticks(t.job_registry, t.job_status_events, horizon(t))
    return h.select(ts_text("window_start").alias("window_start"), "jobs")


@query("waiting_jobs", TICKS_SQL + f"""
select job_id, {SQL_TS.format(c='min(tick)')} as first_tick, {SQL_TS.format(c='max(tick)')} as last_tick, count(*) as ticks
from tick join wait on r <= tick and (t is null or t > tick) group by job_id
""")
def q_waiting_jobs(spark, d):
    t = Tables(spark, d)
    s = TK.with_ticks(TK.waiting_intervals(t.job_registry, t.job_status_events), horizon(t))
    text = lambda c: F.date_format(TK.tick_time(c), TS_FMT)
    return s.select("job_id", text("first").alias("first_tick"), text("last").alias("last_tick"),
                    (F.col("last") - F.col("first") + 1).alias("ticks"))


@query("slowest_transfers", TICKS_SQL + """
select job_id, greatest(epoch_us(t) - epoch_us(r), 0) as wait_us from wait where t is not null
order by wait_us desc, job_id limit 20
""")
def q_slowest_transfers(spark, d):
    t = Tables(spark, d)
    return TK.slowest_waits(TK.waiting_intervals(t.job_registry, t.job_status_events), 20)


@query("poll_ticks", TICKS_SQL + f""",
p as (select job_id, tick from tick join wait on r <= tick and tick < r + interval 1 day),
st as (select p.job_id, tick, arg_max(status, (ts, event_id)) as status
  from p left join job on job.job_id = p.job_id and ts <= tick group by p.job_id, tick),
sig as (select job_id, tick, case when status is null or status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING')
    then 'HEARTBEAT' when status in ('STOPPED','PARTIALLY_SUCCEEDED','FAILED') then 'FAILURE' else 'SUCCESS' end as signal
  from st),
e as (select job_id, min(tick) filter (signal <> 'HEARTBEAT') as stop from sig group by job_id)
select job_id, count(*) filter (signal = 'HEARTBEAT') as heartbeats, arg_max(signal, tick) as signal,
  {SQL_TS.format(c='max(tick)')} as last_tick
from sig join e using (job_id) where stop is null or tick <= stop group by job_id
""")
def q_poll_ticks(spark, d):
    t = Tables(spark, d)
    signals = TK.poll_signals(t.job_registry, t.job_status_events, horizon(t), wait="1 day")
    return TK.poll_outcomes(signals).select(
        "job_id", "heartbeats", "signal", F.date_format(TK.tick_time("tick"), TS_FMT).alias("last_tick"))


@query("heartbeat_timeouts", f"""
g as (select job_id, ts, epoch_us(ts) - epoch_us(lag(ts) over (partition by job_id order by ts, event_id)) as gap_us from job)
select job_id, {SQL_TS.format(c='ts')} as ts, cast(floor(gap_us/1000000) as bigint) as gap_seconds
from g where gap_us > 300000000
""")
def q_heartbeat_timeouts(spark, d):
    h = J.heartbeat_timeouts(Tables(spark, d).job_status_events)
    return h.select("job_id", ts_text("ts").alias("ts"), F.col("gap_seconds").cast("bigint").alias("gap_seconds"))



"""Queries: streams (checked against their batch twins) and quarantine."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan.plans.q_events import VALIDATE_SQL
from relayplan.plans.q_jobs import FIRST_SQL, SQL_TS, TICKS_SQL, TS_FMT
from relayplan.plans.registry import query
from relayplan.sources import events as EV
from relayplan.sources.tables import Tables
from relayplan.streaming import streams as S


@query("stream_validate_requests", VALIDATE_SQL)
def q_stream_validate_requests(spark, d):
    return S.stream_validate_requests(spark, d)


@query("stream_match_status", """
select distinct job_id, status, case when r.id is null then 'NOT_IN_DB' when status='SUCCEEDED' then 'SUCCESS'
  when status in ('INITIALIZED','WAITING_FOR_RESOURCES','RUNNING') then 'NON_TERMINAL' else 'FAILURE' end as outcome
from job left join (select id from regp where id_type='JOB_ID') r on r.id=job.job_id
""")
def q_stream_match_status(spark, d):
    return S.stream_match_status(spark, d)


@query("stream_heartbeat_ticks", TICKS_SQL + f"""
select {SQL_TS.format(c='tick')} as window_start, count(*) as jobs
from tick join wait on r <= tick and (t is null or t > tick) group by tick
""")
def q_stream_heartbeat_ticks(spark, d):
    h = S.stream_heartbeat_ticks(spark, d)
    return h.select(F.date_format("window_start", TS_FMT).alias("window_start"), "jobs")


@query("stream_release_waiting", FIRST_SQL + f"""
select job_id, status, {SQL_TS.format(c='ts')} as ts from ft
""")
def q_stream_release_waiting(spark, d):
    r = S.stream_release_waiting(spark, d)
    return r.select("job_id", "status", F.date_format(F.timestamp_micros("ts_us"), TS_FMT).alias("ts"))


@query("stream_registry", FIRST_SQL + """
select id, id_type, task_token from regp where id_type='JOB_ID' and id not in (select job_id from ft)
""")
def q_stream_registry(spark, d):
    return S.stream_registry(spark, d).select("id", "id_type", "task_token")


@query("stream_heartbeat_timeouts", f"""
g as (select job_id, ts, epoch_us(ts) - epoch_us(lag(ts) over (partition by job_id order by ts, event_id)) as gap_us from job)
select job_id, {SQL_TS.format(c='ts')} as ts, cast(floor(gap_us/1000000) as bigint) as gap_seconds
from g where gap_us > 300000000
""")
def q_stream_heartbeat_timeouts(spark, d):
    r = S.stream_heartbeat_timeouts(spark, d)
    return r.select("job_id", F.date_format(F.timestamp_micros("ts_us"), TS_FMT).alias("ts"),
                    F.floor(F.col("gap_us") / 1_000_000).cast("bigint").alias("gap_seconds"))


@query("stream_transfer_summary", """
select request_id, action, count(*) as files, cast(sum(size) as bigint) as bytes from actions group by all
""")
def q_stream_transfer_summary(spark, d):
    return S.stream_transfer_summary(spark, d)


@query("quarantine", """
b as (select event_id, case when event_id%50=0 then substr(props,2)
        when event_id%50=25 then replace(props,'"k"','"x"') else props end as p from events)
select event_id, case when not json_valid(p) then 'MALFORMED_JSON' else 'MISSING_FIELD' end as reason
from b where not json_valid(p) or json_extract(p,'$.k') is null
""")
def q_quarantine(spark, d):
    e = Tables(spark, d).raw("events", ["event_id", "props"])
    eid, p = F.col("event_id"), F.col("props")
    broken = (F.when(eid % 50 == 0, F.expr("substring(props, 2)"))
               .when(eid % 50 == 25, F.replace(p, F.lit('"k"'), F.lit('"x"')))
               .otherwise(p))
    parsed = e.select("event_id", F.from_json(broken, "k INT, _corrupt_record STRING",
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("j"))
    reason = (F.when(F.col("j._corrupt_record").isNotNull() | F.col("j").isNull(), F.lit("MALFORMED_JSON"))
               .when(F.col("j.k").isNull(), F.lit("MISSING_FIELD")))
    _, bad = EV.quarantine(parsed, reason)
    return bad.select("event_id", "reason")

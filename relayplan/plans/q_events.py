"""Queries: request events, validation, routing, renaming-item checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions import predicates as P
from relayplan.operators.validate import validate_requests
from relayplan.plans.registry import query
from relayplan.sources import events as EV
from relayplan.sources.request_events import request_event_bodies
from relayplan.sources.tables import Tables

PAT = K.URI_PATTERN

LISTS_SQL = """
srcl as (select request_id, row_number() over (partition by request_id order by pos, source_uri) - 1 as i,
  source_uri from src),
renl as (select request_id, row_number() over (partition by request_id order by item) - 1 as i,
  input_uri, data_id, output_file_name from ren),
extll as (select request_id, row_number() over (partition by request_id order by uri) - 1 as i, uri from extl)
"""

VALIDATE_SQL = LISTS_SQL + f""",
ev as (select request_id, case when request_id%130=0 then 'OtherBus' else '{K.EVENT_BUS_NAME}' end as bus,
  request_id%30=0 as legacy, o_custkey%41<>0 as has_token, destination_uri from req)
select request_id, 'EventBusName' as field, 'enum' as rule from ev where bus<>'{K.EVENT_BUS_NAME}'
union all select request_id, 'Detail.taskToken', 'required' from ev where not has_token
union all select request_id, 'Detail.payload', 'required' from ev where legacy
union all select request_id, 'Detail.payload.sourceUriList', 'minItems' from ev
  where not legacy and request_id not in (select request_id from src)
union all select request_id, 'Detail.payload.destinationUri', 'endsWithSlash' from ev
  where not legacy and not ends_with(destination_uri,'/')
union all select s.request_id, concat('Detail.payload.sourceUriList[', cast(s.i as varchar), ']'), 'pattern'
  from srcl s join ev using (request_id) where not legacy and not regexp_matches(s.source_uri,'{PAT}')
union all select x.request_id, concat('Detail.payload.externalSourceUriList[', cast(x.i as varchar), ']'), 'pattern'
  from extll x join ev using (request_id) where not legacy and not regexp_matches(x.uri,'{PAT}')
union all select n.request_id, concat('Detail.payload.renamingMapList[', cast(n.i as varchar), ']'), 'oneOf'
  from renl n join ev using (request_id)
  where not legacy and coalesce(n.input_uri is not null and regexp_matches(n.input_uri,'{PAT}'), false)
                    = coalesce(n.data_id is not null and length(n.data_id)>=1, false)
"""


def parsed_request_events(t: Tables, internal: bool = False):
    """Parsed events; oversize and malformed messages are quarantined (S-12)."""
    parsed = EV.parse_requests(request_event_bodies(t, internal))
    good, _ = EV.quarantine(parsed, EV.message_problem())
    return good


@query("validate_requests", VALIDATE_SQL)
def q_validate_requests(spark, d):
    ev = parsed_request_events(Tables(spark, d))
    return validate_requests(ev)


@query("route_events", """
ev as (select request_id, cast(floor(request_id/10) as bigint)%3=1 as internal from req)
select request_id, 'internal_copy' as route from ev where internal
union all select request_id, 'internal_token' from ev where internal and request_id%9=0
union all select request_id, 'external_copy' from ev where not internal and request_id%130<>0 and request_id%30<>0
union all select request_id, 'external_legacy' from ev
  where not internal and request_id%130<>0 and (request_id%30=0 or request_id%110=0)
""")
def q_route_events(spark, d):
    ev = parsed_request_events(Tables(spark, d), internal=True)
    return EV.route_events(ev).select("request_id", "route")


@query("legacy_normalise", LISTS_SQL + """,
nr as (select request_id, count(*) as n from ren group by 1)
select s.request_id, s.i as pos, s.source_uri, r.destination_uri,
  case when r.o_custkey%41<>0 then r.task_token end as task_token,
  case when r.request_id%30=0 then 'legacy' else 'nested' end as layout,
  case when r.request_id%30=0 then 0 else coalesce(nr.n,0) end as n_renames
from srcl s join req r using (request_id) left join nr using (request_id)
""")
def q_legacy_normalise(spark, d):
    ev = EV.normalise_legacy(parsed_request_events(Tables(spark, d)))
    rq = F.col("request")
    return ev.select(
        "request_id",
        F.posexplode(rq.getField("payload").getField("sourceUriList")).alias("pos", "source_uri"),
        rq.getField("payload").getField("destinationUri").alias("destination_uri"),
        rq.getField("taskToken").alias("task_token"),
        rq.getField("layout").alias("layout"),
        F.size(rq.getField("payload").getField("renamingMapList")).cast("bigint").alias("n_renames"),
    ).withColumn("pos", F.col("pos").cast("bigint"))


@query("renaming_item_valid", f"""
select request_id, cast(item as bigint) as item,
  coalesce(regexp_matches(input_uri,'{PAT}'), false) <> coalesce(length(data_id)>=1, false)
    and output_file_name is not null and length(output_file_name)>=1 as valid,
  coalesce(data_id, input_uri) is not null as has_input
from ren
""")
def q_renaming_item_valid(spark, d):
    r = Tables(spark, d).renaming_map
    return r.select("request_id", F.col("item").cast("bigint").alias("item"),
                    P.renaming_item_valid("input_uri", "data_id", "output_file_name").alias("valid"),
                    P.has_rename_input("data_id", "input_uri").alias("has_input"))


@query("output_name_valid", r"""
select request_id, cast(item as bigint) as item,
  output_file_name is not null and length(output_file_name)>0 and not contains(output_file_name,'/')
    and output_file_name not in ('.','..') as strict,
  output_file_name is not null and not (length(output_file_name)=0 or regexp_matches(output_file_name,'[^/]//')
    or regexp_matches(output_file_name,'^///') or regexp_matches(output_file_name,'[^/]/$')
    or (regexp_matches(output_file_name,'(^|/)\.(/|$)') and output_file_name<>'.')) as compat
from ren
""")
def q_output_name_valid(spark, d):
    r = Tables(spark, d).renaming_map
    return r.select("request_id", F.col("item").cast("bigint").alias("item"),
                    P.output_name_valid("output_file_name", "strict").alias("strict"),
                    P.output_name_valid("output_file_name", "compat").alias("compat"))

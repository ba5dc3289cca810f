"""JSON events -> relational tables -> plan equals the table-driven plan."""

from pyspark.sql import functions as F

from relayplan.plans.planner import plan_transfers, requests_from_events
from relayplan.sources import events as EV
from relayplan.sources.request_events import request_event_bodies
from relayplan.sources.tables import Tables


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def test_events_to_plan(spark, sf_small):
    t = Tables(spark, sf_small)
    parsed = EV.parse_requests(request_event_bodies(t))
    good, bad = EV.quarantine(parsed, EV.message_problem())
    assert bad.count() == 0
    et = requests_from_events(good)
    assert rows(et.sources, "request_id", "source_uri") == rows(t.request_sources, "request_id", "source_uri")
    # legacy (flat) events carry no renaming list; nested ones carry all items
    legacy = good.filter(F.col("event.Detail.payload").isNull()).select("request_id")
    ren = t.renaming_map.join(legacy, "request_id", "left_anti")
    assert rows(et.renames, "request_id", "input_uri", "data_id", "output_file_name") == \
        rows(ren, "request_id", "input_uri", "data_id", "output_file_name")
    a = plan_transfers(et.requests, et.sources, t.inventory, t.destination_inventory, t.external_objects)
    b = plan_transfers(t.requests, t.request_sources, t.inventory, t.destination_inventory, t.external_objects)
    assert rows(a.actions, "request_id", "data_id", "action") == rows(b.actions, "request_id", "data_id", "action")
    assert rows(a.expanded, "request_id", "data_id", "dest_path") == rows(b.expanded, "request_id", "data_id", "dest_path")
    assert rows(a.jobs, "request_id", "dest", "files") == rows(b.jobs, "request_id", "dest", "files")
    assert rows(a.missing_folders, "project_id", "path") == rows(b.missing_folders, "project_id", "path")


def test_actions_cover_the_whole_plan(spark, sf_small):
    from relayplan.operators import actions as A
    t = Tables(spark, sf_small)
    plan = plan_transfers(t.requests, t.request_sources, t.inventory, t.destination_inventory, t.external_objects)
    direct = A.file_targets(plan.resolved, t.requests)
    ext = A.external_targets(plan.resolved, t.requests, t.external_objects)
    parts = [direct, plan.expanded, ext]
    assert all(p.count() > 0 for p in parts)
    assert plan.actions.count() == sum(p.count() for p in parts)
    size = lambda d: d.agg(F.sum("size")).first()[0] or 0
    assert size(plan.actions) == sum(map(size, parts))
    assert {r.action for r in plan.actions.select("action").distinct().collect()} == {
        "COPY", "REPLACE_PARTIAL", "SKIP", "CONFLICT", "MISSING_SOURCE"}

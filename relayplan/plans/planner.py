"""From copy-request events to a transfer plan.

``read_requests``/``parse_requests`` -> ``normalise_legacy`` ->
``requests_from_events`` (lists exploded with their positions) ->
``plan_transfers`` (resolve, expand, classify, decide, group). Nothing is
evaluated until a result is written or collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan.operators import actions as A
from relayplan.operators import expand as X
from relayplan.operators import resolve as R
from relayplan.sources import events as EV


@dataclass
class EventTables:
    requests: DataFrame          # request_id, destination_uri, task_token, layout
    sources: DataFrame           # request_id, pos, source_uri
    renames: DataFrame           # request_id, item, input_uri, data_id, output_file_name
    externals: DataFrame         # request_id, pos, uri


def requests_from_events(events: DataFrame, key: str = "request_id") -> EventTables:
    """Normalised events (column ``request``, see ``normalise_legacy``) to
    relational tables; list positions are kept (W-5)."""
    n = EV.normalise_legacy(events) if "request" not in events.columns else events
    p = F.col("request.payload")
    # a request that spans several events is described by the first
    head = n.filter(F.col("part") == 0) if "part" in n.columns else n
    reqs = head.select(key, p.getField("destinationUri").alias("destination_uri"),
                    F.col("request.taskToken").alias("task_token"), F.col("request.layout").alias("layout"))
    srcs = n.select(key, F.posexplode(p.getField("sourceUriList")).alias("pos", "source_uri"))
    rens = (n.select(key, F.posexplode(p.getField("renamingMapList")).alias("_i", "_r"))
             .select(key, (F.col("_i") + 1).alias("item"), F.col("_r.sourceUri").alias("input_uri"),
                     F.col("_r.dataId").alias("data_id"), F.col("_r.outputFileName").alias("output_file_name")))
    exts = n.select(key, F.posexplode(p.getField("externalSourceUriList")).alias("pos", "uri"))
    return EventTables(reqs, srcs, rens, exts)


@dataclass
class TransferPlan:
    resolved: DataFrame          # every source with its kind (J-1)
    expanded: DataFrame          # files below folder sources (J-5)
    actions: DataFrame           # the decision for every file: named, below folders, external (J-10)
    jobs: DataFrame              # one copy job per destination folder (A-1)
    partials: DataFrame          # unfinished destination files each copy job deletes first (J-9)
    missing_folders: DataFrame   # destination folders to create (J-3)


def plan_transfers(requests: DataFrame, sources: DataFrame, inventory: DataFrame,
                   dest_inventory: DataFrame, external_objects: DataFrame, store=None,
                   cols: tuple[str, ...] = ("*",)) -> TransferPlan:
    """``store`` may write the resolved sources once (as ``session.stored`` does): each
    part of the plan reads them, and folders are then met at their own levels only.
    It then writes the planned files too, ``cols`` of them; actions have these."""
    resolved = R.resolve_sources(sources, inventory)
    levels = None
    if store is not None:
        resolved = store(resolved)
        levels = X.source_levels(resolved)
    expanded = X.expand_recursive(resolved, requests, inventory, levels=levels)
    own = A.file_targets(resolved, requests)
    planned = X.planned_files(own, expanded, A.external_targets(resolved, requests, external_objects))
    project_files = X.planned_files(own, expanded)
    if store is not None:
        planned = store(planned.select(*cols))
    return TransferPlan(
        resolved=resolved,
        expanded=expanded,
        actions=A.transfer_action(planned, dest_inventory),
        jobs=A.build_copy_jobs(A.job_members(project_files)),
        partials=A.partials_to_delete(project_files, dest_inventory),
        missing_folders=R.missing_destinations(requests, dest_inventory, X.folder_tree(resolved, requests, inventory, levels)),
    )

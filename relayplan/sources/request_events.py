"""Copy-request events as JSON message bodies, derived from the tables.

Stands in for the event bus: each request row becomes one JSON event (the
unit a bus delivers, bounded by its message size limit), assembled from
the request's sources, renaming items and external URIs. Variations:

- bus ``OtherBus`` when ``request_id % 130 = 0`` (enum failure)
- legacy flat layout when ``request_id % 30 = 0``
- both nested and flat destination when ``request_id % 110 = 0`` (overlap)
- no task token when ``o_custkey % 41 = 0``
- a list longer than ``max_items`` goes on in further events of the request
  (``part`` 1, 2, ...), by position, as a bus message is limited in size
- with ``internal=True``: ``(request_id div 10) % 3 = 1`` events come from
  the internal bus and source, with a ``jobId`` when ``request_id % 9 = 0``
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.session import exchange_partitions, releasing, scratch_path
from relayplan.sources import layout as L
from relayplan.sources.tables import Tables

# Positions of a list that one event carries.
EVENT_ITEMS = 1_000


def event_lists(t: Tables, max_items: int = EVENT_ITEMS, partitions: int | None = None) -> DataFrame:
    """(request_id, part, _s, _r, _x): the lists of each request, cut into parts: runs
    of ``max_items`` positions, so no group is longer than that, however long the
    list. A list without items in a part is null.

    Items of all lists and the requests are rows of one exchange, by request (into
    ``partitions``, if given)."""
    lists = {"_s": (t.request_sources, "pos", F.struct("pos", "source_uri")),
             "_r": (t.renaming_map, "item", F.struct("item", "input_uri", "data_id", "output_file_name")),
             "_x": (t.external_sources, "pos", F.col("uri"))}
    # part 0 exists even where all lists are empty or start later
    rows = t.requests.select("request_id", F.lit(0).alias("part"), F.lit("").alias("list"))
    for name, (df, position, item) in lists.items():
        rows = rows.unionByName(df.select(
            "request_id", F.floor(F.col(position) / max_items).cast("int").alias("part"), F.lit(name).alias("list"),
            item.alias(name)), allowMissingColumns=True)
    own = [F.when(F.count_if(F.col("list") == name) > 0, F.sort_array(F.collect_list(name))).alias(name) for name in lists]
    many = F.count_if(F.col("list") == "")
    # items without a position are in no part: each list has its own row of them
    apart = F.when(F.col("part").isNull(), F.col("list")).alias("_apart")
    by = rows.repartition("request_id") if partitions is None else rows.repartition(partitions, "request_id")
    return (by.groupBy("request_id", "part", apart).agg(*own, many.alias("_n"))
            # a request that comes twice has its events twice
            .withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.greatest(F.col("_n").cast("int"), F.lit(1))))).drop("_n", "_apart"))


def stored_lists(t: Tables, max_items: int = EVENT_ITEMS) -> DataFrame:
    """``event_lists`` written once in buckets of the request: a micro-batch exchanges
    its requests only, neither making the lists again nor exchanging them."""
    spark = t.spark
    path = scratch_path(spark, "lists")
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    n = exchange_partitions(spark)
    with releasing(spark):
        L.write_buckets(event_lists(t, max_items, n), table, path, ("request_id",), n)
    out = spark.table(table)
    out.stored_path = path
    return out


def request_event_bodies(t: Tables, internal: bool = False, requests: DataFrame | None = None,
                         max_items: int = EVENT_ITEMS, lists: DataFrame | None = None) -> DataFrame:
    """(request_id, part, body) with body the JSON event text.

    Every request has the event of part 0; longer lists fill further parts.
    ``requests`` may be a streaming DataFrame; the lists are static, cut into
    parts before the stream-static joins. ``lists``: ``stored_lists``, for streams.
    """
    r = t.requests if requests is None else requests
    j = r.join(event_lists(t, max_items) if lists is None else lists, "request_id")

    rid = F.col("request_id")
    is_int = ((F.floor(rid / 10) % 3) == 1) if internal else F.lit(False)
    legacy = ~is_int & (rid % 30 == 0)
    both = ~is_int & ~legacy & (rid % 110 == 0)
    srcs = F.coalesce(F.transform("_s", lambda x: x.getField("source_uri")), F.array().cast("array<string>"))
    rens = F.transform("_r", lambda x: F.struct(x.getField("input_uri").alias("sourceUri"),
                                                x.getField("data_id").alias("dataId"),
                                                x.getField("output_file_name").alias("outputFileName")))
    payload = F.struct(srcs.alias("sourceUriList"), F.col("destination_uri").alias("destinationUri"),
                       rens.alias("renamingMapList"), F.col("_x").alias("externalSourceUriList"))
    detail = F.struct(
        F.when(~legacy, payload).alias("payload"),
        F.when(F.col("o_custkey") % 41 != 0, F.col("task_token")).alias("taskToken"),
        F.when(legacy, srcs).alias("sourceUriList"),
        F.when(legacy | both, F.col("destination_uri")).alias("destinationUri"),
        F.when(is_int & (rid % 9 == 0), F.concat(F.lit("job-"), rid.cast("string"))).alias("jobId"),
    )
    bus = (F.when(is_int, F.lit(K.INTERNAL_BUS_NAME))
            .when(rid % 130 == 0, F.lit("OtherBus"))
            .otherwise(F.lit(K.EVENT_BUS_NAME)))
    ev = F.struct(
        rid.cast("string").alias("id"),
        bus.alias("EventBusName"),
        F.when(is_int, F.lit(K.EVENT_SOURCE)).otherwise(F.lit("manual")).alias("Source"),
        F.lit(K.DETAIL_TYPE).alias("DetailType"),
        detail.alias("Detail"),
    )
    return j.select("request_id", "part", F.to_json(ev).alias("body"))

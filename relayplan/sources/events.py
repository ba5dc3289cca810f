"""Event sources: copy requests, job-state notifications (S-1, S-2, S-5, S-12).

Events are read with an explicit schema (no inference). Malformed JSON
lands in ``_corrupt_record`` and is split off by ``quarantine``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayplan import constants as K

RENAMING_ITEM = T.StructType([
    T.StructField("sourceUri", T.StringType()),
    T.StructField("dataId", T.StringType()),
    T.StructField("outputFileName", T.StringType()),
])

PAYLOAD = T.StructType([
    T.StructField("sourceUriList", T.ArrayType(T.StringType())),
    T.StructField("destinationUri", T.StringType()),
    T.StructField("renamingMapList", T.ArrayType(RENAMING_ITEM)),
    T.StructField("externalSourceUriList", T.ArrayType(T.StringType())),
])

# One schema for both layouts: nested ``Detail.payload`` and the legacy
# flat ``Detail`` (sourceUriList / destinationUri directly under Detail).
DETAIL = T.StructType([
    T.StructField("payload", PAYLOAD),
    T.StructField("taskToken", T.StringType()),
    T.StructField("sourceUriList", T.ArrayType(T.StringType())),
    T.StructField("destinationUri", T.StringType()),
    T.StructField("jobId", T.StringType()),
])

REQUEST_EVENT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("EventBusName", T.StringType()),
    T.StructField("Source", T.StringType()),
    T.StructField("DetailType", T.StringType()),
    T.StructField("Detail", DETAIL),
])

STATUS_ITEM = T.StructType([
    T.StructField("payload", T.StructType([
        T.StructField("id", T.StringType()),
        T.StructField("status", T.StringType()),
    ])),
])
STATUS_BODY = T.ArrayType(STATUS_ITEM)

CORRUPT = "_corrupt_record"


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """S-1 from files: one JSON event per line, typed, permissive.

    Same shape as ``parse_requests``: ``request_id`` (the event id), ``event``
    (null when malformed), ``_corrupt_record`` and ``body`` (the raw line of
    a malformed record, else a placeholder so only corrupt rows quarantine).
    """
    schema = T.StructType(REQUEST_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
    df = (spark.read.schema(schema).option("mode", "PERMISSIVE")
               .option("columnNameOfCorruptRecord", CORRUPT).json(path))
    ev = F.struct(*[F.col(f.name) for f in REQUEST_EVENT.fields])
    ok = F.col(CORRUPT).isNull()
    return df.select(F.col("id").alias("request_id"), F.when(ok, ev).alias("event"), CORRUPT,
                     F.coalesce(F.col(CORRUPT), F.lit("{}")).alias("body"))


def parse_requests(df: DataFrame, body_col: str = "body") -> DataFrame:
    """S-1 from a text column (queue message bodies): adds ``event`` (typed
    struct, null when malformed) and ``_corrupt_record``."""
    schema = T.StructType(REQUEST_EVENT.fields + [T.StructField(CORRUPT, T.StringType())])
    p = F.from_json(F.col(body_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return (df.withColumn("_p", p)
              .withColumn(CORRUPT, F.col(f"_p.{CORRUPT}"))
              .withColumn("event", F.when(F.col(CORRUPT).isNull(), F.col("_p").dropFields(CORRUPT)))
              .drop("_p"))


def normalise_legacy(events: DataFrame) -> DataFrame:
    """S-2 + U-1: both layouts -> ``{payload{...}, taskToken}``.

    The nested payload wins when both are present (the original fires both
    rules for such an event; the normalised request is the nested one).
    Adds ``request`` with the normalised struct; the renaming and external
    lists default to empty arrays (E-11).
    """
    d = F.col("event.Detail")
    nested = d.getField("payload")
    flat = F.struct(d.getField("sourceUriList").alias("sourceUriList"),
                    d.getField("destinationUri").alias("destinationUri"),
                    F.lit(None).cast(T.ArrayType(RENAMING_ITEM)).alias("renamingMapList"),
                    F.lit(None).cast(T.ArrayType(T.StringType())).alias("externalSourceUriList"))
    use_nested = nested.getField("destinationUri").isNotNull()
    p = F.when(use_nested, nested).otherwise(flat)
    req = F.struct(
        F.struct(p.getField("sourceUriList").alias("sourceUriList"),
                 p.getField("destinationUri").alias("destinationUri"),
                 F.coalesce(p.getField("renamingMapList"), F.array().cast(T.ArrayType(RENAMING_ITEM))).alias("renamingMapList"),
                 F.coalesce(p.getField("externalSourceUriList"), F.array().cast(T.ArrayType(T.StringType()))).alias("externalSourceUriList"),
                 ).alias("payload"),
        d.getField("taskToken").alias("taskToken"),
        F.when(use_nested, F.lit("nested")).otherwise(F.lit("legacy")).alias("layout"),
    )
    return events.withColumn("request", req)


def route_events(events: DataFrame, bus_main: str = K.EVENT_BUS_NAME,
                 bus_internal: str = K.INTERNAL_BUS_NAME, source: str = K.EVENT_SOURCE,
                 detail_type: str = K.DETAIL_TYPE) -> DataFrame:
    """P-5: every rule an event matches, one row per (event, route).

    internal_copy: internal bus, our source, detail type, nested destination
    internal_token: internal bus, our source, detail type, Detail.jobId
    external_copy: main bus, detail type, nested destination
    external_legacy: main bus, detail type, flat destination
    ``exists`` is ``isNotNull``. An event can match several rules.
    """
    e = F.col("event")
    d = e.getField("Detail")
    bus, src, dt = e.getField("EventBusName"), e.getField("Source"), e.getField("DetailType")
    nested_dest = d.getField("payload").getField("destinationUri").isNotNull()
    internal = (bus == bus_internal) & (src == source) & (dt == detail_type)
    main = (bus == bus_main) & (dt == detail_type)
    routes = F.array(
        F.when(internal & nested_dest, F.lit("internal_copy")),
        F.when(internal & d.getField("jobId").isNotNull(), F.lit("internal_token")),
        F.when(main & nested_dest, F.lit("external_copy")),
        F.when(main & d.getField("destinationUri").isNotNull(), F.lit("external_legacy")),
    )
    return events.withColumn("route", F.explode(F.filter(routes, lambda r: r.isNotNull())))


def parse_status_bodies(df: DataFrame, body_col: str = "body") -> DataFrame:
    """S-5: queue body (JSON array of ``{payload:{id,status}}``) -> one row per
    notification with its position in the body."""
    p = F.from_json(F.col(body_col), STATUS_BODY)
    return (df.select("*", F.posexplode(p).alias("item_pos", "item"))
              .select("*", F.col("item.payload.id").alias("job_id"), F.col("item.payload.status").alias("status"))
              .drop("item"))


def message_problem(body_col: str = "body") -> F.Column:
    """Why a message cannot be handled: NO_BODY, MALFORMED_JSON."""
    return (F.when(F.col(body_col).isNull(), F.lit("NO_BODY"))
             .when(F.col(CORRUPT).isNotNull(), F.lit("MALFORMED_JSON")))


def quarantine(df: DataFrame, reasons: F.Column) -> tuple[DataFrame, DataFrame]:
    """S-12: split rows into (good, bad); ``reasons`` is a nullable string
    column, non-null marks a row for the side table."""
    tagged = df.withColumn("reason", reasons)
    return tagged.filter(F.col("reason").isNull()).drop("reason"), tagged.filter(F.col("reason").isNotNull())

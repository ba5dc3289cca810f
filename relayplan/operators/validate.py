"""Request validation (P-1 .. P-4): one row per failed rule.

The event schema is compiled into column predicates: one boolean per rule,
per-item rules through ``transform`` over the arrays, and the failures
exploded. Pure projection, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions.predicates import one_input


def _chk(field, rule: str, bad: Column) -> Column:
    f = F.lit(field) if isinstance(field, str) else field
    return F.struct(f.alias("field"), F.lit(rule).alias("rule"), F.coalesce(bad, F.lit(False)).alias("bad"))


def _item_field(prefix: str, i: Column) -> Column:
    return F.concat(F.lit(prefix + "["), i.cast("string"), F.lit("]"))


def _uri_items(arr: Column, prefix: str) -> Column:
    """minLength and pattern checks for every item of a URI array."""
    def per(u, i):
        return F.array(_chk(_item_field(prefix, i), "minLength", F.length(u) < 1),
                       _chk(_item_field(prefix, i), "pattern", ~u.rlike(K.URI_PATTERN)))
    return F.flatten(F.transform(F.coalesce(arr, F.array().cast("array<string>")), per))


def validate_requests(events: DataFrame, key: str = "request_id",
                      bus_name: str = K.EVENT_BUS_NAME, detail_type: str = K.DETAIL_TYPE) -> DataFrame:
    """P-1/P-2/P-3/P-4 over parsed events (column ``event``) -> (key, field, rule).

    Rules follow the event schema (2020-12 reading, URI pattern with search
    semantics) plus the handler's rule that the destination ends in ``/``.
    Where a request spans several events (column ``part``), the rules on the
    envelope and on whole lists are checked on the first; item numbers count
    within the event.
    """
    e = F.col("event")
    d = e.getField("Detail")
    p = d.getField("payload")
    bus, src, dt = e.getField("EventBusName"), e.getField("Source"), e.getField("DetailType")
    tok = d.getField("taskToken")
    sl = p.getField("sourceUriList")
    dest = p.getField("destinationUri")
    scalar = F.array(
        _chk("EventBusName", "required", bus.isNull()),
        _chk("EventBusName", "enum", bus.isNotNull() & (bus != F.lit(bus_name))),
        _chk("Source", "required", src.isNull()),
        _chk("Source", "minLength", F.length(src) < 1),
        _chk("DetailType", "required", dt.isNull()),
        _chk("DetailType", "enum", dt.isNotNull() & (dt != F.lit(detail_type))),
        _chk("Detail", "required", d.isNull()),
        _chk("Detail.payload", "required", d.isNotNull() & p.isNull()),
        _chk("Detail.taskToken", "required", d.isNotNull() & tok.isNull()),
        _chk("Detail.taskToken", "minLength", F.length(tok) < 1),
        _chk("Detail.payload.sourceUriList", "required", p.isNotNull() & sl.isNull()),
        _chk("Detail.payload.sourceUriList", "minItems", F.size(sl) < 1),
        _chk("Detail.payload.destinationUri", "required", p.isNotNull() & dest.isNull()),
        _chk("Detail.payload.destinationUri", "minLength", F.length(dest) < 1),
        _chk("Detail.payload.destinationUri", "endsWithSlash", (F.length(dest) >= 1) & ~dest.endswith("/")),
    )
    srcs = _uri_items(sl, "Detail.payload.sourceUriList")
    exts = _uri_items(p.getField("externalSourceUriList"), "Detail.payload.externalSourceUriList")

    def ren(x, i):
        f = _item_field("Detail.payload.renamingMapList", i)
        out = x.getField("outputFileName")
        return F.array(_chk(f, "oneOf", ~one_input(x.getField("sourceUri"), x.getField("dataId"))),
                       _chk(f, "outputFileName", out.isNull() | (F.length(out) < 1)))
    rens = F.flatten(F.transform(F.coalesce(p.getField("renamingMapList"),
                                            F.array().cast("array<struct<sourceUri:string,dataId:string,outputFileName:string>>")),
                                 ren))
    if "part" in events.columns:
        scalar = F.when(F.col("part") == 0, scalar).otherwise(F.slice(scalar, 1, 0))
    allc = F.concat(scalar, srcs, exts, rens)
    return (events.select(key, F.explode(F.filter(allc, lambda c: c.getField("bad"))).alias("c"))
                  .select(key, F.col("c.field").alias("field"), F.col("c.rule").alias("rule")))

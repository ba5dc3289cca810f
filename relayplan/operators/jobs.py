"""Job states, the waiting-job registry and heartbeats (J-18 .. J-20, W-3,
W-4, S-6 .. S-9, A-5, A-6, T-5, T-7 as batch operators; T-4 is in ``ticks``).

The registry is a table keyed by (id, id_type). Per-job reductions use
``min_by``/``max_by`` aggregates (partial aggregation map-side), so a job
with very many notifications never gathers them in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relayplan import constants as K
from relayplan.functions.predicates import non_terminal, summarise_poll, summarise_push
from relayplan.session import shared_dir

SUCCESS, FAILURE, NON_TERMINAL, NOT_IN_DB = "SUCCESS", "FAILURE", "NON_TERMINAL", "NOT_IN_DB"
HEARTBEAT = "HEARTBEAT"


def scan_registry(registry: DataFrame, id_type: str = K.REGISTRY_JOB_ID_TYPE) -> DataFrame:
    """S-6: one id type, projected to (job_id, task_token). The filter is
    pushed to the scan when the registry is a parquet table."""
    return registry.filter(F.col("id_type") == id_type).select(
        F.col("id").alias("job_id"), "task_token")


def match_status(events: DataFrame, registry: DataFrame) -> DataFrame:
    """J-18 + T-6: each notification against the registry snapshot.

    SUCCESS / FAILURE (push mapping: unknown states fail) / NON_TERMINAL
    (ignored) / NOT_IN_DB (accepted and ignored).
    """
    reg = scan_registry(registry).withColumn("_reg", F.lit(True))
    j = events.join(reg, "job_id", "left")
    out = F.when(F.col("_reg").isNull(), F.lit(NOT_IN_DB)).otherwise(summarise_push(F.col("status")))
    return j.withColumn("outcome", out).drop("_reg")


def first_terminal(events: DataFrame, registry: DataFrame) -> DataFrame:
    """W-3: the first terminal state per registered job, by (ts, event_id).

    Success or failure deletes the registry row, so later states find
    nothing; this is the state that releases the job.
    """
    reg = scan_registry(registry).select("job_id")
    term = events.filter(~non_terminal("status")).join(reg, "job_id", "left_semi")
    return (term.groupBy("job_id")
                .agg(F.min_by(F.struct("status", "ts", "event_id"), F.struct("ts", "event_id")).alias("f"))
                .select("job_id", "f.status", "f.ts", "f.event_id"))


def latest_status(events: DataFrame, as_of=None) -> DataFrame:
    """W-4: latest state per job at ``as_of`` (inclusive)."""
    e = events if as_of is None else events.filter(F.col("ts") <= F.lit(as_of))
    return e.groupBy("job_id").agg(F.max_by(F.col("status"), F.struct("ts", "event_id")).alias("status"))


def upsert_registry(registry: DataFrame, new: DataFrame) -> DataFrame:
    """S-7: put by key; the newer row (registered_at, then the new batch)
    replaces the older one."""
    cols = ["id", "id_type", "task_token", "registered_at"]
    u = (registry.select(*cols, F.lit(0).alias("_v"))
                 .unionByName(new.select(*cols, F.lit(1).alias("_v"))))
    return (u.groupBy("id", "id_type")
             .agg(F.max_by(F.struct("task_token", "registered_at"), F.struct("registered_at", "_v")).alias("r"))
             .select("id", "id_type", "r.task_token", "r.registered_at"))


def delete_registry(registry: DataFrame, done_job_ids: DataFrame) -> DataFrame:
    """S-8 / U-3: remove released JOB_ID rows (``left_anti``); rows of other
    id types stay."""
    done = done_job_ids.select(F.col("job_id").alias("id"), F.lit(K.REGISTRY_JOB_ID_TYPE).alias("id_type"))
    return registry.join(done, ["id", "id_type"], "left_anti")


def expire_registry(registry: DataFrame, as_of, ttl_col: str = "expire_at") -> DataFrame:
    """T-7: rows past their TTL disappear; no TTL means no expiry."""
    e = F.col(ttl_col)
    return registry.filter(e.isNull() | (e > F.lit(as_of)))


def pending_count(registry: DataFrame) -> DataFrame:
    """A-5: waiting rows per id type (the heartbeat stops when JOB_ID is 0)."""
    return registry.groupBy("id_type").agg(F.count(F.lit(1)).alias("n"))


def poll_pending(registry: DataFrame, events: DataFrame, as_of=None) -> DataFrame:
    """J-19 + T-8: each waiting job -> HEARTBEAT (still running, or status
    unavailable), FAILURE or SUCCESS (poll mapping)."""
    reg = scan_registry(registry)
    st = latest_status(events, as_of)
    j = reg.join(st, "job_id", "left")
    s = summarise_poll(F.col("status"))
    sig = (F.when(F.col("status").isNull() | (s == "RUNNING"), F.lit(HEARTBEAT))
            .when(s == "FAILED", F.lit(FAILURE)).otherwise(F.lit(SUCCESS)))
    return j.withColumn("signal", sig)


def scan_running_executions(executions: DataFrame) -> DataFrame:
    """S-9: running request executions only (a pushed filter)."""
    return executions.filter(F.col("status") == K.EXECUTION_RUNNING)


def external_heartbeats(executions: DataFrame) -> DataFrame:
    """J-20 + E-12: running execution -> task token parsed from its input."""
    return scan_running_executions(executions).select(
        "execution_id", F.get_json_object("input", "$.taskToken").alias("task_token"))


def batch_items(df: DataFrame, order_col: str, n: int = K.HEARTBEAT_BATCH) -> DataFrame:
    """A-6: rows numbered by ``order_col`` and cut into batches of ``n``; all
    but the last batch are full. Adds ``batch_no``.

    Rows are range-partitioned and sorted once, into a checkpoint that fixes
    which row lies in which partition. Partitions are counted, the counts
    (one row per partition) summed up, and rows numbered within partitions.
    """
    shared_dir(df.sparkSession)
    parts = df.repartitionByRange(F.col(order_col)).withColumn("_part", F.spark_partition_id()).checkpoint()
    counts = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    own = Window.partitionBy("_part").orderBy(order_col)
    return (parts.withColumn("_no", F.row_number().over(own) - 1).join(first, "_part")
                 .withColumn("batch_no", F.expr(f"(_first + _no) div {n}"))
                 .drop("_part", "_no", "_first"))


def batches(df: DataFrame, order_col: str, n: int = K.HEARTBEAT_BATCH) -> DataFrame:
    """A-6: ``batch_no, n, first_id`` of each batch."""
    return batch_items(df, order_col, n).groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n"), F.min(order_col).alias("first_id"))


def heartbeat_timeouts(events: DataFrame, limit_seconds: int = K.HEARTBEAT_TIMEOUT_SECONDS,
                       bucket: str = "1 hour") -> DataFrame:
    """T-5 (batch): gaps between consecutive signs of life of a job longer
    than the limit.

    A plain ``lag`` over ``partitionBy(job_id)`` puts one job's whole
    history in one task. Here ``lag`` runs per (job, time bucket); the first
    event of a bucket takes its predecessor from the summary of the job's
    previous non-empty bucket (one row per bucket, ``max(ts)``), so a job
    with a large share of all events is spread over many tasks.
    """
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    width = interval_micros(bucket)
    e = events.withColumn("_us", us).withColumn("_b", F.floor(F.col("_us") / width))
    w = Window.partitionBy("job_id", "_b").orderBy("_us", "event_id")
    inner = e.withColumn("_prev", F.lag("_us").over(w))
    summ = e.groupBy("job_id", "_b").agg(F.max("_us").alias("_last"))
    summ = summ.withColumn("_prev_bucket_last",
                           F.lag("_last").over(Window.partitionBy("job_id").orderBy("_b")))
    j = inner.join(summ.select("job_id", "_b", "_prev_bucket_last"), ["job_id", "_b"])
    prev = F.coalesce(F.col("_prev"), F.col("_prev_bucket_last"))
    gap = F.col("_us") - prev
    return (j.withColumn("gap_us", gap)
             .filter(prev.isNotNull() & (F.col("gap_us") > F.lit(limit_seconds * 1_000_000)))
             .withColumn("gap_seconds", F.floor(F.col("gap_us") / 1_000_000))
             .drop("_us", "_b", "_prev", "_prev_bucket_last"))


def interval_micros(text: str) -> int:
    """``'<n> <unit>'`` (seconds, minutes, hours, days) in microseconds."""
    n, unit = text.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600,
            "day": 86400, "days": 86400}[unit]
    return int(n) * mult * 1_000_000

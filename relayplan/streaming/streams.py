"""Structured Streaming operators (T-1 .. T-10, S-11, S-12).

Sources are file streams over rows of the given tables, written in slices to
the shared folder (a queue or bus in production), so each run has several
micro-batches. Every stream writes through ``foreachBatch`` into a parquet
folder per batch id, overwritten on replay, so a restarted or retried batch
never duplicates output (S-11). Checkpoints and outputs live under the
shared folder (``spark.checkpoint.dir``), so a lost executor or driver
restart resumes from the last committed batch.

State is bounded by event time and lives in Spark's state store: a job's state
goes when it is released or expires (``waiting``), sessions go when they close,
duplicates are known for a span. No sink reads what earlier batches wrote. A
drained stream ends with a clock row, an event of no job that moves time on,
as the schedule does in a running one; so nothing stays behind a watermark.

Triggers: ``available_now=True`` drains what is there and stops (tests,
backfills); otherwise ``processingTime`` (T-2: 10 seconds) keeps running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relayplan import constants as K
from relayplan.functions import uri as U
from relayplan.functions.predicates import non_terminal, summarise_push
from relayplan.operators import ticks as TK
from relayplan.operators.plan import write_plan
from relayplan.operators.validate import validate_requests
from relayplan.session import discard, path_exists, releasing, scratch_path, stored
from relayplan.sources import catalog as C
from relayplan.sources import events as EV
from relayplan.sources import layout as L
from relayplan.sources.request_events import request_event_bodies, stored_lists
from relayplan.sources.tables import Tables, job_events_from_events, requests_from_orders
from relayplan.streaming import waiting as WT


# -- plumbing ------------------------------------------------------------------

def staged_stream(df: DataFrame, order: str, slices: int = 3, clock: tuple[str, object] | None = None) -> DataFrame:
    """``df`` as a stream of micro-batches in the order of a numeric column:
    its slices are written to the shared folder by one job, a file each, and
    read one at a time. With ``clock`` (column, instant) a last row that has
    nothing but that instant follows. Stands in for a queue."""
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    cuts = df.agg(F.percentile_approx(order, [i / slices for i in range(1, slices)]).alias("c")).first()["c"] or []
    number = sum(((F.col(order) > c).cast("int") for c in cuts), F.lit(0))
    df.withColumn("_slice", number).repartition(slices, "_slice").write.partitionBy("_slice").parquet(path)
    if clock is not None:
        column, at = clock
        spark.range(1).select(*[(at if f.name == column else F.lit(None)).cast(f.dataType).alias(f.name)
                                for f in df.schema.fields]).write.parquet(f"{path}/_slice={len(cuts) + 1}")
    stamp(spark, [p for p in (f"{path}/_slice={k}" for k in range(len(cuts) + 2)) if path_exists(spark, p)])
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/_slice=*")


def stamp(spark: SparkSession, folders: list[str]) -> None:
    """Modification times a second apart, folder by folder: the order in which
    a file stream reads them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    now = int(jvm.java.lang.System.currentTimeMillis())
    for k, folder in enumerate(folders):
        fs = jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(conf)
        for f in fs.listStatus(jvm.org.apache.hadoop.fs.Path(folder)):
            fs.setTimes(f.getPath(), now - 1000 * (len(folders) - k), -1)


def idempotent_sink(out_path: str):
    """S-11: foreachBatch writer; batch N always lands in ``batch=N``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
    return write


def start_stream(df: DataFrame, name: str, sink_path: str, checkpoint: str, output_mode: str = "append",
                 available_now: bool = False, every: str = K.STATUS_BATCH_WINDOW):
    """Start ``df`` into an idempotent parquet sink and return the query.

    T-2: by default a micro-batch every ``every`` (10 seconds); bound the
    batch size at the source (``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``).
    ``available_now`` drains what is there and stops.
    """
    w = (df.writeStream.outputMode(output_mode)
           .option("checkpointLocation", checkpoint)
           .foreachBatch(idempotent_sink(sink_path)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)
    return w.queryName(f"{name}_{abs(hash(sink_path)) % 10**8}").start()


def run_to_completion(df: DataFrame, name: str, output_mode: str = "append",
                      sink_path: str | None = None, checkpoint: str | None = None) -> str:
    """Drain ``df`` (available-now trigger) into an idempotent parquet sink and
    return the sink path. Passing the same ``checkpoint`` and ``sink_path``
    again resumes where the last run stopped."""
    spark = df.sparkSession
    out = sink_path or scratch_path(spark, f"{name}-out")
    q = start_stream(df, name, out, checkpoint or scratch_path(spark, f"{name}-ckpt"), output_mode,
                     available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return out


def read_sink(spark: SparkSession, out: str, schema: T.StructType) -> DataFrame:
    """Everything a sink wrote, without the batch column (empty when the
    stream produced no batch)."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(out).select(*schema.fieldNames())


def _event_time(df: DataFrame) -> DataFrame:
    """Watermarks need ``timestamp``; the tables store ``timestamp_ntz``
    wall-clock UTC, so the cast keeps the instant under a UTC session."""
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


# -- T-1 / S-12: request stream -> validation failures ---------------------------------

VALIDATION_OUT = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("field", T.StringType()),
                               T.StructField("rule", T.StringType())])


def validation_sinks(out_path: str, quarantine_path: str):
    """foreachBatch writer with two outputs from one micro-batch: messages
    that cannot be handled go to the quarantine (S-12), the rest are
    validated (P-1..P-4). Both writes are per batch id, so replays are
    idempotent; the batch is persisted without its texts so it is parsed once."""
    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_problem", EV.message_problem()).drop("body").persist()
        try:
            good, bad = EV.quarantine(b, F.col("_problem"))
            (bad.select("request_id", "reason", F.col(EV.CORRUPT).alias("body"))
                .write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}"))
            validate_requests(good).write.mode("overwrite").parquet(f"{out_path}/batch={batch_id}")
        finally:
            b.unpersist()
    return write


def stream_validate_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-1: each request validated as it arrives; unparsable
    messages go to a quarantine sink (S-12). Stream-static joins attach the
    request's lists."""
    t = Tables(spark, sf_dir).stored("file_rows")
    lists = stored_lists(t)
    discard(t.file_rows)
    orders = staged_stream(t.raw("orders", ["o_orderkey", "o_custkey", "o_orderdate"]), "o_orderkey")
    parsed = EV.parse_requests(request_event_bodies(t, requests=requests_from_orders(orders), lists=lists))
    out, quar = scratch_path(spark, "validate-out"), scratch_path(spark, "validate-quarantine")
    drain(parsed, validation_sinks(out, quar), scratch_path(spark, "validate-ckpt"))
    discard(lists)
    return read_sink(spark, out, VALIDATION_OUT)


# -- job states: sources --------------------------------------------------------------

#: How far apart notifications of one moment may arrive.
LATENESS = "10 minutes"
#: How long an unregistered state waits for its registration.
HOLD = "10 minutes"
#: How long after its registration a job may end, where state must be bounded.
TTL = "7 days"


def closing(t: Tables, *spans: str):
    """An instant behind all notifications by more than the given spans."""
    newest = t.job_status_events.agg(F.max("ts")).first()[0]
    if newest is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(newest) + sum((F.expr(f"interval {s}") for s in spans), F.expr("interval 1 hour"))


def status_stream(t: Tables, clock) -> DataFrame:
    """Notifications as a stream, with a clock row at the end."""
    raw = t.raw("events", ["event_id", "ts", "event_type"])
    events = job_events_from_events(staged_stream(raw, "event_id", clock=("ts", clock)))
    return _event_time(events.fillna(WT.CLOCK, ["job_id"]))


def registration_stream(t: Tables, clock) -> DataFrame:
    """JOB_ID registrations as a stream: ``job_id, task_token, ts``."""
    regs = t.job_registry.filter(F.col("id_type") == K.REGISTRY_JOB_ID_TYPE).select(
        F.col("id").alias("job_id"), "task_token", F.col("registered_at").alias("ts"),
        F.unix_micros(F.col("registered_at").cast("timestamp")).alias("us"))
    return _event_time(staged_stream(regs, "us", clock=("ts", clock)).fillna(WT.CLOCK, ["job_id"])).drop("us")


def without_clock(rows: DataFrame) -> DataFrame:
    """What a sink wrote, but for clock rows. Not part of the streams: there the
    filter would move below the watermark and stop the clock."""
    return rows.filter(F.col("job_id") != WT.CLOCK)


# -- T-6 / T-10 / S-11: notifications -> outcomes -------------------------------------

MATCH_OUT = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("status", T.StringType()),
                          T.StructField("outcome", T.StringType())])


def first_deliveries(events: DataFrame, within: str = TTL) -> DataFrame:
    """T-10: the first delivery of each (job, state), told from repeats for
    ``within`` of event time; then its key is forgotten. A job's states lie
    within its time to live, so repeats do, however batches are cut."""
    return events.withWatermark("ts", within).dropDuplicatesWithinWatermark(["job_id", "status"])


#: Hash buckets of the keys that a stream has written.
SEEN_BUCKETS = 64


def first_rows_sink(out_path: str, seen_path: str, keys: list[str], buckets: int = SEEN_BUCKETS):
    """T-10, S-11: foreachBatch writer of the rows whose key no earlier batch
    wrote, however long ago; of equal keys within a batch one row. What the
    stream's state has forgotten lies in hash buckets at ``seen_path``: a batch
    reads the keys of its own buckets and adds its new ones. A replayed batch
    looks at earlier batches only, so it decides the same."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        types = {f.name: f.dataType for f in batch.schema.fields}
        b = (batch.dropDuplicates(keys)
             .withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist())
        try:
            new = b
            if path_exists(spark, seen_path):
                touched = [r.bucket for r in b.select("bucket").distinct().collect()]  # at most ``buckets``
                stored = T.StructType([T.StructField(k, types[k]) for k in keys]
                                      + [T.StructField("bucket", T.IntegerType()), T.StructField("batch", T.LongType())])
                old = (spark.read.schema(stored).parquet(seen_path)
                       .filter(F.col("bucket").isin(touched) & (F.col("batch") < batch_id)).alias("old"))
                same = [F.col(f"new.{k}").eqNullSafe(F.col(f"old.{k}")) for k in keys]
                new = b.alias("new").join(old, same, "left_anti")
            out = f"{out_path}/batch={batch_id}"
            new.write.mode("overwrite").parquet(out)
            (spark.read.schema(b.schema).parquet(out).select(*keys, "bucket", F.lit(batch_id).cast("long").alias("batch"))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("bucket", "batch").parquet(seen_path))
        finally:
            b.unpersist()
    return write


def match_stream(statuses: DataFrame, registrations: DataFrame, ttl: str = TTL, hold: str = HOLD,
                 lateness: str = LATENESS) -> DataFrame:
    """T-6: each (job, state) against the stream of registrations, whichever
    comes first. A state finds a registration that is at most ``ttl`` older or
    ``hold`` younger; when time has passed that, it leaves as NOT_IN_DB. Both
    sides keep what may still meet, no longer. ``lateness`` bounds how late
    either stream's rows arrive (first deliveries have their own span)."""
    s = statuses.select("job_id", "status", "ts")
    r = (registrations.withWatermark("ts", lateness)
         .select(F.col("job_id").alias("reg_job"), F.col("ts").alias("reg_ts")))
    on = ((F.col("job_id") == F.col("reg_job"))
          & (F.col("reg_ts") >= F.col("ts") - F.expr(f"interval {ttl}"))
          & (F.col("reg_ts") <= F.col("ts") + F.expr(f"interval {hold}")))
    out = F.when(F.col("reg_job").isNull(), F.lit("NOT_IN_DB")).otherwise(summarise_push(F.col("status")))
    return s.join(r, on, "leftOuter").select("job_id", "status", out.alias("outcome"))


def stream_match_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-10 + T-6: duplicate deliveries of the same (job, state) dropped, then
    each matched against the running stream of registrations."""
    t = Tables(spark, sf_dir)
    clock = closing(t, TTL, TTL, HOLD)
    res = match_stream(first_deliveries(status_stream(t, clock)), registration_stream(t, clock))
    out = scratch_path(spark, "match-out")
    drain(res, first_rows_sink(out, scratch_path(spark, "match-seen"), ["job_id", "status"]),
          scratch_path(spark, "match-ckpt"))
    return without_clock(read_sink(spark, out, MATCH_OUT))


# -- T-3 / T-7: release waiting jobs ------------------------------------------------------

RELEASE_OUT = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("status", T.StringType()),
                            T.StructField("ts_us", T.LongType()), T.StructField("event_id", T.LongType())])


def job_buckets(t: Tables) -> int:
    """Buckets of ``WT.BUCKET_JOBS`` jobs, by their number to a few hundredths."""
    jobs = t.job_status_events.select("job_id").unionByName(t.job_registry.select(F.col("id").alias("job_id")))
    return -(-jobs.agg(F.approx_count_distinct("job_id")).first()[0] // WT.BUCKET_JOBS) or 1


def waiting_stream(spark: SparkSession, sf_dir: str, ttl: str | None = None) -> str:
    """T-3 end to end: registrations and notifications as two streams through
    the state of waiting jobs (``waiting``). Returns the folder of its rows."""
    t = Tables(spark, sf_dir)
    clock = closing(t, HOLD, LATENESS, *([ttl] if ttl else []))
    moves = WT.waiting_jobs(registration_stream(t, clock), status_stream(t, clock), HOLD, ttl, LATENESS, job_buckets(t))
    return run_to_completion(moves, "waiting")


def registry_sink(out_path: str, registry_path: str):
    """foreachBatch: the moves of a batch (S-11), and the registry kept up with
    them: waits that open are put, waits that end removed (S-7, S-8)."""
    outcomes, registry = idempotent_sink(out_path), C.registry_writer(registry_path)

    def write(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist()
        try:
            outcomes(b, batch_id)
            registry(WT.registry_changes(b), batch_id)
        finally:
            b.unpersist()
    return write


def stream_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored registry after the streams: what still waits."""
    t = Tables(spark, sf_dir)
    clock = closing(t, HOLD, LATENESS)
    moves = WT.waiting_jobs(registration_stream(t, clock), status_stream(t, clock), HOLD, None, LATENESS, job_buckets(t))
    registry = scratch_path(spark, "registry")
    drain(moves, registry_sink(scratch_path(spark, "registry-moves"), registry), scratch_path(spark, "registry-ckpt"))
    return C.read_registry(spark, registry)


def stream_release_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first terminal state of each registered job."""
    moves = read_sink(spark, waiting_stream(spark, sf_dir), WT.MOVES)
    return moves.filter(F.col("move") == WT.RELEASED).select(*RELEASE_OUT.fieldNames())


# -- T-4: heartbeat ticks -------------------------------------------------------------

def stream_heartbeat_ticks(spark: SparkSession, sf_dir: str, every: str = K.HEARTBEAT_EVERY) -> DataFrame:
    """T-4: jobs that wait at each tick, from what the stream of waiting jobs
    wrote: +1 where a wait begins, -1 where it ends."""
    t = Tables(spark, sf_dir)
    until = F.lit(t.job_status_events.agg(F.max("ts")).first()[0])
    deltas = TK.tick_deltas(TK.with_ticks(WT.intervals(read_sink(spark, waiting_stream(spark, sf_dir), WT.MOVES)),
                                          until, every))
    return TK.running_counts(deltas).select(TK.tick_time("tick", every).alias("window_start"), "jobs")


# -- T-5: heartbeat timeouts -----------------------------------------------------------

SESSIONS = T.StructType([T.StructField("job_id", T.StringType()), T.StructField("first_us", T.LongType()),
                         T.StructField("last_us", T.LongType())])


def alive_sessions(events: DataFrame, limit_seconds: int = K.HEARTBEAT_TIMEOUT_SECONDS,
                   lateness: str = LATENESS) -> DataFrame:
    """T-5: stretches of a job's life without a wait longer than the limit, as
    session windows. A session leaves when time has passed its end; until
    then it is one row of state."""
    # a session goes on if the next sign of life comes within the limit, the limit included
    gap = f"{limit_seconds} seconds 1 microsecond"
    return (events.withWatermark("ts", lateness).groupBy(F.session_window("ts", gap).alias("w"), "job_id")
            .agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
            .select("job_id", F.unix_micros("a").alias("first_us"), F.unix_micros("b").alias("last_us")))


def session_gaps(sessions: DataFrame) -> DataFrame:
    """Waits between a job's sessions: ``job_id, ts_us`` (the next sign of
    life) and ``gap_us``. A job has no more sessions than limits fit into its
    time, however many notifications it has."""
    w = Window.partitionBy("job_id").orderBy("first_us")
    return (sessions.withColumn("gap_us", F.col("first_us") - F.lag("last_us").over(w))
            .filter(F.col("gap_us").isNotNull()).select("job_id", F.col("first_us").alias("ts_us"), "gap_us"))


def stream_heartbeat_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    sessions = alive_sessions(status_stream(t, closing(t, LATENESS)))
    return session_gaps(without_clock(read_sink(spark, run_to_completion(sessions, "sessions"), SESSIONS)))


def drain(df: DataFrame, writer, checkpoint: str) -> None:
    """Run a ``foreachBatch`` writer over what is there, then stop."""
    q = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(writer).trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


# -- T-1: plan each request as it arrives ----------------------------------------------

SUMMARY_OUT = T.StructType([T.StructField("request_id", T.LongType()), T.StructField("action", T.StringType()),
                            T.StructField("files", T.LongType()), T.StructField("bytes", T.LongType())])


def plan_sink(out_path: str, quarantine_path: str, inventory: DataFrame, destinations: DataFrame,
              external_objects: DataFrame):
    """foreachBatch: plan the micro-batch's requests with the batch planner.
    ``inventory`` and ``destinations`` are stored by areas (``sources.layout``):
    a batch reads the areas that its URIs name. Resolved sources and planned files are
    written once and go with the batch; a step's exchanges go with the step. The decided files are written once
    (``actions/``); summary and copy jobs are read off them. All outputs are
    per batch id (idempotent on replay). A request lives in one batch, so
    per-batch aggregates are final."""
    from relayplan.operators import actions as A
    from relayplan.plans.planner import plan_transfers, requests_from_events

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # what the plan needs of a message: not its text, nor the lists that the plan does not read
        request = F.col("request")
        for name in ("renamingMapList", "externalSourceUriList"):
            request = request.withField(f"payload.{name}", F.lit(None).cast(EV.PAYLOAD[name].dataType))
        b = (EV.normalise_legacy(batch.withColumn("reason", EV.message_problem()))
             .select("request_id", *[c for c in batch.columns if c == "part"], "reason", request.alias("request")).persist())
        steps = []

        def store(df: DataFrame) -> DataFrame:
            steps.append(stored(df))
            return steps[-1]

        try:
            good, bad = b.filter(F.col("reason").isNull()), b.filter(F.col("reason").isNotNull())
            (bad.select("request_id", "reason").write.mode("overwrite")
                .parquet(f"{quarantine_path}/batch={batch_id}"))
            et = requests_from_events(good)
            # targets are planned below the normalised destination folder
            folders = L.project_paths(et.requests, "destination_uri").withColumn(
                "path", U.normalise_path(U.as_folder("path")))
            plan = plan_transfers(et.requests, et.sources,
                                  L.prune(inventory, L.touched_areas(L.project_paths(et.sources, "source_uri"))),
                                  L.prune(destinations, L.touched_areas(folders)),
                                  external_objects, store=store)
            actions = f"{out_path}/actions/batch={batch_id}"
            with releasing(spark):
                write_plan(plan.actions, actions, ("action",))
                decided = spark.read.schema(plan.actions.schema).parquet(actions)
                (A.transfer_summary(decided).write.mode("overwrite")
                  .parquet(f"{out_path}/summary/batch={batch_id}"))
                own = decided.filter(~F.col("data_id").contains("://"))  # external objects are named by URI
                (A.build_copy_jobs(A.job_members(own)).write.mode("overwrite")
                  .parquet(f"{out_path}/jobs/batch={batch_id}"))
        finally:
            discard(*steps)
            b.unpersist()
    return write


def stream_plan(spark: SparkSession, sf_dir: str) -> str:
    """T-1: request events as a stream, each micro-batch planned. Returns the
    output folder (``actions/``, ``summary/`` and ``jobs/``)."""
    t = Tables(spark, sf_dir).stored("file_rows")
    lists = stored_lists(t)
    areas = []
    for df, name in ((t.inventory, "inventory-areas"), (t.destination_inventory, "destination-areas")):
        path = scratch_path(spark, name)
        L.write_areas(df, path)
        areas.append(L.read_areas(spark, path))
        areas[-1].stored_path = path
    discard(t.file_rows)
    orders = staged_stream(t.raw("orders", ["o_orderkey", "o_custkey", "o_orderdate"]), "o_orderkey")
    parsed = EV.parse_requests(request_event_bodies(t, requests=requests_from_orders(orders), lists=lists))
    out, quar = scratch_path(spark, "plan-out"), scratch_path(spark, "plan-quarantine")
    drain(parsed, plan_sink(out, quar, *areas, t.external_objects), scratch_path(spark, "plan-ckpt"))
    discard(lists, *areas)
    return out


def stream_transfer_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_sink(spark, f"{stream_plan(spark, sf_dir)}/summary", SUMMARY_OUT)

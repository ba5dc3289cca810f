"""Streams equal their batch twins; the stateful release emits each
registered job once."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from relayplan.operators import jobs as J
from relayplan.sources.tables import Tables
from relayplan.streaming import streams as S
from relayplan.streaming import waiting as WT


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """State is kept per shuffle partition: two are enough for small streams."""
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", was)


def test_release_once_and_only_registered(spark, sf_small):
    rel = S.stream_release_waiting(spark, sf_small)
    t = Tables(spark, sf_small)
    assert rel.count() == rel.select("job_id").distinct().count()
    reg = J.scan_registry(t.job_registry).select("job_id")
    assert rel.join(reg, "job_id", "left_anti").count() == 0
    batch = J.first_terminal(t.job_status_events, t.job_registry).select(
        "job_id", "status", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"))
    assert sorted(map(tuple, rel.select("job_id", "status", "ts_us").collect())) == sorted(map(tuple, batch.collect()))


def batches(spark, path, frames):
    """A stream over frames that arrive one after the other, one per micro-batch."""
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def ts(spark, rows, schema):
    return spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))


REG = "job_id string, ts string"
STATUS = "job_id string, status string, ts string, event_id long"


END = "2030-01-01 00:00:00"


def cut(rows, n):
    """Rows in ``n`` micro-batches of consecutive rows."""
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def moves(spark, path, regs, statuses, hold="10 days", ttl=None, lateness="0 seconds", clock=True):
    """Rows of the stream of waiting jobs; each stream's frames come one by one."""
    path.mkdir(parents=True, exist_ok=True)
    regs, statuses = ([*x, *([[row]] if clock else [])] for x, row in (
        (regs, (WT.CLOCK, END)), (statuses, (WT.CLOCK, None, END, None))))
    r = batches(spark, str(path / "r"), [ts(spark, x, REG) for x in regs]).withColumn("task_token", F.concat(F.lit("t-"), "job_id"))
    s = batches(spark, str(path / "s"), [ts(spark, x, STATUS) for x in statuses])
    out = S.run_to_completion(WT.waiting_jobs(r, s, hold, ttl, lateness), "moves", sink_path=str(path / "out"),
                              checkpoint=str(path / "ckpt"))
    return S.read_sink(spark, out, WT.MOVES).collect()


def released(spark, tmp_path, regs, statuses, **more):
    return sorted((x.job_id, x.status, x.event_id) for x in moves(spark, tmp_path / "run", regs, statuses, **more)
                  if x.move == WT.RELEASED)


def test_registration_waits_for_days(spark, tmp_path):
    """Registered on day 0, other jobs move time on, done on day 12."""
    got = released(spark, tmp_path, [[("j", "2024-01-01 00:00:00")], [("k", "2024-01-05 00:00:00")]],
                   [[("k", "RUNNING", "2024-01-02 00:00:00", 1)], [("k", "FAILED", "2024-01-06 00:00:00", 2)],
                    [("x", "SUCCEEDED", "2024-01-10 00:00:00", 3)], [("j", "SUCCEEDED", "2024-01-13 00:00:00", 4)]])
    assert got == [("j", "SUCCEEDED", 4), ("k", "FAILED", 2)]


def test_early_state_waits_a_bounded_time(spark, tmp_path):
    """A terminal state may come before its registration, by ``hold`` at most;
    states after the release find nothing."""
    regs = [[("a", "2024-01-01 00:00:00")], [("b", "2024-01-01 00:00:00")], [("j", "2024-01-09 00:00:00")]]
    states = [[("j", "FAILED", "2024-01-01 00:00:00", 1), ("j", "SUCCEEDED", "2024-01-01 00:00:01", 2)],
              [("z", "SUCCEEDED", "2024-01-08 00:00:00", 3)], [("j", "SUCCEEDED", "2024-01-01 00:00:05", 4)],
              [("j", "SUCCEEDED", "2024-01-20 00:00:00", 5)], [("b", "STOPPED", "2024-01-21 00:00:00", 6)]]
    long = released(spark, tmp_path / "long", regs, states, lateness="30 days")
    assert long == [("b", "STOPPED", 6), ("j", "FAILED", 1)]
    short = released(spark, tmp_path / "short", regs, states, hold="1 hour", lateness="30 days")
    assert short == [("b", "STOPPED", 6), ("j", "SUCCEEDED", 5)]


def test_state_holds_the_waiting_jobs_only(spark, tmp_path):
    """After the run the state has one row per job that still waits."""
    regs = [(f"j{i}", f"2024-01-01 {i:02d}:00:00") for i in range(20)]
    states = [(f"j{i}", "FAILED", f"2024-01-02 {i % 24:02d}:00:00", i) for i in range(0, 30, 2)]
    got = moves(spark, tmp_path, cut(regs, 3), cut(states, 4), hold="1 hour")
    done = {m.job_id for m in got if m.move == WT.RELEASED}
    assert done == {f"j{i}" for i in range(0, 20, 2)}
    rows = spark.read.format("statestore").load(str(tmp_path / "ckpt")).selectExpr("key.*").collect()
    assert sorted(r.job_id for r in rows) == sorted({r[0] for r in regs} - done)
    left = WT.intervals(spark.createDataFrame(got, WT.MOVES)).filter("end_us is null").collect()
    assert sorted(r.job_id for r in left) == sorted(r.job_id for r in rows)


def plain(regs, statuses, hold, ttl):
    """The moves by replaying registrations and states in the order of time."""
    out = []
    for j in {r[0] for r in regs}:
        mine = sorted((datetime.fromisoformat(t), n) for n, (k, t) in enumerate(regs) if k == j)
        ends = sorted((datetime.fromisoformat(t), e, s) for k, s, t, e in statuses
                      if k == j and s not in ("INITIALIZED", "WAITING_FOR_RESOURCES", "RUNNING"))
        while mine:
            start = mine[0][0]
            end = next((e for e in ends if e[0] >= start - hold), None)
            out.append((WT.OPENED, j, start, None))
            if end and end[0] < start + ttl:
                out.append((WT.RELEASED, j, start, end[1]))
                until, ends = max(end[0], start), [e for e in ends if e > end]
            else:
                out.append((WT.EXPIRED, j, start, None))
                until = start + ttl - timedelta(microseconds=1)
            mine = [m for m in mine if m[0] > until]
    return sorted(out, key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_moves_do_not_depend_on_arrival(spark, tmp_path, seed):
    """Either stream first or both together, in 1, 3 and 7 micro-batches: the
    rows of a replay in time order; expired waits are released by no state."""
    rnd = random.Random(seed)
    at = lambda: str(datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(20_000)))
    regs = sorted(((f"j{rnd.randrange(25)}", at()) for _ in range(40)), key=lambda r: r[1])
    states = sorted(((f"j{rnd.randrange(30)}", rnd.choice(["RUNNING", "FAILED", "SUCCEEDED"]), at(), i)
                     for i in range(80)), key=lambda r: r[2])
    want = plain(regs, states, timedelta(hours=5), timedelta(days=2))
    assert {w[0] for w in want} == {WT.OPENED, WT.RELEASED, WT.EXPIRED}
    for name, a, b in (("both1", 1, 1), ("both3", 3, 3), ("regs", 1, 7), ("states", 7, 1)):
        got = moves(spark, tmp_path / name, cut(regs, a), cut(states, b), hold="5 hours", ttl="2 days")
        epoch = datetime(1970, 1, 1)
        rows = [(m.move, m.job_id, epoch + timedelta(microseconds=m.reg_us), m.event_id) for m in got]
        assert sorted(rows, key=str) == want, name


def matched(spark, path, regs, statuses, **more):
    path.mkdir(parents=True)
    r = batches(spark, str(path / "r"), [ts(spark, x, REG) for x in [*regs, [(WT.CLOCK, END)]]])
    s = batches(spark, str(path / "s"), [ts(spark, x, STATUS) for x in [*statuses, [(WT.CLOCK, None, END, None)]]])
    out = S.run_to_completion(S.match_stream(S.first_deliveries(s, "1 day"), r, **more), "match",
                              sink_path=str(path / "out"), checkpoint=str(path / "ckpt"))
    return sorted(map(tuple, S.without_clock(S.read_sink(spark, out, S.MATCH_OUT)).collect()))


def test_unknown_notifications_leave_the_stream(spark, tmp_path):
    """T-6: the same outcomes whichever stream comes first, in 1, 3 and 7
    micro-batches; unknown ones leave as NOT_IN_DB when time has passed."""
    rnd = random.Random(4)
    at = lambda n: str(datetime(2024, 1, 1) + timedelta(minutes=n))
    regs = sorted(((f"j{i}", at(rnd.randrange(1000))) for i in range(0, 20, 2)), key=lambda r: r[1])
    states = sorted(((f"j{rnd.randrange(24)}", rnd.choice(["RUNNING", "FAILED", "SUCCEEDED", "ODD"]),
                      at(rnd.randrange(1200)), n) for n in range(90)), key=lambda r: r[2])
    known, want, seen = dict(regs), [], set()
    for j, s, t, _ in states:
        if (j, s) in seen:
            continue
        seen.add((j, s))
        r = known.get(j)
        t, r = datetime.fromisoformat(t), r and datetime.fromisoformat(r)
        ok = r is not None and t - timedelta(hours=8) <= r <= t + timedelta(hours=1)
        want.append((j, s, {"SUCCEEDED": "SUCCESS", "RUNNING": "NON_TERMINAL"}.get(s, "FAILURE") if ok else "NOT_IN_DB"))
    assert {w[2] for w in want} == {"SUCCESS", "FAILURE", "NON_TERMINAL", "NOT_IN_DB"}
    for name, a, b in (("one", 1, 1), ("three", 3, 3), ("regs", 1, 7), ("states", 7, 1)):
        got = matched(spark, tmp_path / name, cut(regs, a), cut(states, b), ttl="8 hours", hold="1 hour", lateness="0 seconds")
        assert got == sorted(want), name


def test_duplicates_do_not_depend_on_batch_cuts(spark, tmp_path):
    rows = [("j", "FAILED", f"2024-01-01 {h:02d}:00:00", h) for h in (0, 5, 6, 7)]
    for name, frames in (("one", [rows]), ("four", [[r] for r in rows])):
        ev = batches(spark, str(tmp_path / name), [ts(spark, x, STATUS) for x in frames])
        out = S.run_to_completion(S.first_deliveries(ev), "dup", sink_path=str(tmp_path / f"{name}-out"))
        assert spark.read.parquet(out).count() == 1


def test_first_rows_are_known_for_ever(spark, tmp_path):
    """Repeats that the state has forgotten are found in the stored keys; a
    replayed batch writes what it wrote; null keys are keys."""
    import glob

    out, seen = str(tmp_path / "out"), str(tmp_path / "seen")
    write = S.first_rows_sink(out, seen, ["job_id", "status"], buckets=4)

    def frame(*rows):
        return spark.createDataFrame(rows, "job_id string, status string, n int")

    def wrote(k):
        return sorted(((r.job_id, r.status, r.n) for r in spark.read.parquet(f"{out}/batch={k}").collect()), key=str)

    write(frame(("a", "FAILED", 1), ("a", "FAILED", 1), ("b", None, 2)), 0)
    second = frame(("a", "FAILED", 3), ("a", "RUNNING", 4), ("b", None, 5), (None, None, 6))
    for _ in range(2):
        write(second, 1)
        assert wrote(1) == [("a", "RUNNING", 4), (None, None, 6)]
    write(frame(("c", "FAILED", 7)), 2)
    write(frame(("c", "FAILED", 8), (None, None, 9)), 3)
    write(second, 1)  # replayed late: later batches do not count
    assert wrote(0) == [("a", "FAILED", 1), ("b", None, 2)] and wrote(1) == [("a", "RUNNING", 4), (None, None, 6)]
    assert wrote(2) == [("c", "FAILED", 7)] and wrote(3) == []
    assert len(glob.glob(f"{seen}/bucket=*/batch=3")) == 0


def test_timeouts_over_batches(spark, tmp_path):
    """Waits longer than the limit between signs of life, across micro-batches
    and out of order within the lateness; a wait of just the limit is none."""
    rows = [("j", "RUNNING", "2024-01-01 00:00:00", 1), ("k", "RUNNING", "2024-01-01 00:00:00", 2),
            ("k", "RUNNING", "2024-01-01 00:04:00", 3), ("j", "RUNNING", "2024-01-01 00:06:00", 4),
            ("j", "RUNNING", "2024-01-01 00:20:00", 5), ("j", "RUNNING", "2024-01-01 00:18:00", 6),
            ("k", "FAILED", "2024-01-01 00:09:01", 7), ("m", "RUNNING", "2024-01-01 00:00:00", 8),
            ("m", "RUNNING", "2024-01-01 00:05:00", 9)]
    want = [("j", "2024-01-01 00:06:00", 360), ("j", "2024-01-01 00:18:00", 720), ("k", "2024-01-01 00:09:01", 301)]
    for n in (1, 3, 7):
        ev = batches(spark, str(tmp_path / f"ev{n}"), [ts(spark, x, STATUS) for x in [*cut(rows, n), [(WT.CLOCK, None, END, 0)]]])
        out = S.run_to_completion(S.alive_sessions(ev, lateness="30 minutes"), "sessions", sink_path=str(tmp_path / f"out{n}"),
                                  checkpoint=str(tmp_path / f"ckpt{n}"))
        gaps = S.session_gaps(S.without_clock(S.read_sink(spark, out, S.SESSIONS))).select(
            "job_id", F.timestamp_micros("ts_us").cast("string").alias("ts"), "gap_us").collect()
        assert sorted((r.job_id, r.ts, r.gap_us // 1_000_000) for r in gaps) == want
        # what is left in the state is the clock's own session
        assert spark.read.format("statestore").load(str(tmp_path / f"ckpt{n}")).count() <= 1


def test_release_resumes_from_its_checkpoint(spark, tmp_path):
    regs = [("a", "2024-01-01 00:00:00"), ("b", "2024-01-01 00:00:00")]
    moves(spark, tmp_path, [regs], [[("a", "FAILED", "2024-01-01 00:01:00", 1)]], clock=False)
    states = [("a", "SUCCEEDED", "2024-01-01 00:02:00", 2), ("b", "FAILED", "2024-01-01 00:03:00", 3)]
    got = moves(spark, tmp_path, [], [states])
    assert sorted((m.job_id, m.event_id) for m in got if m.move == WT.RELEASED) == [("a", 1), ("b", 3)]


def test_unreadable_sink_is_an_error(spark, tmp_path):
    assert S.read_sink(spark, str(tmp_path / "none"), S.RELEASE_OUT).count() == 0
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):  # noqa: B017
        S.read_sink(spark, str(bad), S.RELEASE_OUT).collect()


def test_processing_time_trigger_with_bounded_batches(spark, sf_small, tmp_path):
    """T-2: a continuously running stream (processing-time trigger, one file
    per micro-batch) reaches the same sessions as the drained one."""
    t = Tables(spark, sf_small)
    ev = S.alive_sessions(S.status_stream(t, S.closing(t, S.LATENESS)))
    q = S.start_stream(ev, "sessions-test", str(tmp_path / "out"), str(tmp_path / "ckpt"), every="1 second")
    try:
        q.processAllAvailable()
        assert q.lastProgress is not None
    finally:
        q.stop()
    got = S.session_gaps(S.without_clock(S.read_sink(spark, str(tmp_path / "out"), S.SESSIONS))).select("job_id", "ts_us", "gap_us")
    ref = J.heartbeat_timeouts(t.job_status_events).select(
        "job_id", F.unix_micros(F.col("ts").cast("timestamp")), "gap_us")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ref.collect())) != []


def test_stream_plan_over_several_batches(spark, sf_small):
    """T-1, T-2: requests in three micro-batches give the summary of the
    batch planner, and copy jobs."""
    import os

    from relayplan.operators import actions as A
    from relayplan.plans.planner import plan_transfers

    out = S.stream_plan(spark, sf_small)
    got = S.read_sink(spark, f"{out}/summary", S.SUMMARY_OUT)
    local = out.removeprefix("file:")
    assert len([p for p in os.listdir(f"{local}/summary") if p.startswith("batch=")]) >= 3
    t = Tables(spark, sf_small)
    plan = plan_transfers(t.requests, t.request_sources, t.inventory, t.destination_inventory, t.external_objects)
    ref = A.transfer_summary(plan.actions)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, ref.collect()), key=str)
    jobs = spark.read.parquet(f"{out}/jobs").drop("batch")
    assert jobs.select(*plan.jobs.columns).exceptAll(plan.jobs).isEmpty() and jobs.count() == plan.jobs.count() > 0


def test_registry_replaces_touched_buckets_only(spark, tmp_path):
    """S-7, S-8: a batch of ten keys rewrites ten buckets at most; removals,
    buckets that become empty, re-registration, replays."""
    from relayplan.sources import catalog as C

    path = str(tmp_path / "registry")
    write = C.registry_writer(path)
    schema = "id string, id_type string, task_token string, registered_at string, removed_at string"

    def put(batch_id, rows):
        df = spark.createDataFrame(rows, schema).withColumns(
            {c: F.to_timestamp(c) for c in ("registered_at", "removed_at")})
        write(df, batch_id)

    def files():
        return {f: f.stat().st_mtime_ns for f in (tmp_path / "registry").glob("bucket=*/*.parquet")}

    def rows():
        return sorted((r.id, r.id_type, r.task_token) for r in C.read_registry(spark, path).collect())

    day = lambda n: f"2024-01-{n:02d} 00:00:00"
    put(0, [(f"j{i}", "JOB_ID", "t", day(1), None) for i in range(2000)])
    before = files()
    assert len(before) == C.REGISTRY_BUCKETS and len(rows()) == 2000
    change = [(f"j{i}", "JOB_ID", f"new{i}", day(2), None) for i in range(5)]
    change += [(f"j{i}", "JOB_ID", "t", day(1), day(3)) for i in range(5, 10)]
    put(1, change)
    after = files()
    assert 1 <= len({f.parent for f in before if f not in after}) <= 10
    want = sorted([(f"j{i}", "JOB_ID", f"new{i}") for i in range(5)] + [(f"j{i}", "JOB_ID", "t") for i in range(10, 2000)])
    assert rows() == want
    put(1, change)
    assert rows() == want
    # removed and registered again; an older put and an older removal do nothing
    put(2, [("j5", "JOB_ID", "again", day(4), None), ("j0", "JOB_ID", "old", day(1), None), ("j1", "JOB_ID", "t", day(1), day(1))])
    assert rows() == sorted([*want, ("j5", "JOB_ID", "again")])
    put(3, [(f"j{i}", "JOB_ID", "t", day(1), day(9)) for i in range(2000)])
    assert rows() == [] and C.read_registry(spark, path, "OTHER").count() == 0


def test_large_event_ids_are_exact(spark, tmp_path):
    """A state that comes in one batch with its registration keeps its id."""
    big = 2**53 + 1
    got = released(spark, tmp_path, [[("j", "2024-01-01 00:00:00")]], [[("j", "FAILED", "2024-01-01 00:00:01", big)]])
    assert got == [("j", "FAILED", big)]


def test_jobs_in_buckets_move_alike(spark, tmp_path, monkeypatch):
    """State per job and per bucket of jobs: the same moves, in one and in several
    micro-batches; a call serves a bucket, however many jobs it has rows for."""
    rnd = random.Random(7)
    at = lambda: str(datetime(2024, 1, 1) + timedelta(minutes=rnd.randrange(20_000)))
    regs = sorted(((f"j{rnd.randrange(60)}", at()) for _ in range(120)), key=lambda r: r[1])
    states = sorted(((f"j{rnd.randrange(70)}", rnd.choice(["RUNNING", "FAILED", "SUCCEEDED"]), at(), i)
                     for i in range(200)), key=lambda r: r[2])
    one = lambda got: sorted(map(tuple, got), key=str)
    more = {"hold": "5 hours", "ttl": "2 days"}
    want = one(moves(spark, tmp_path / "jobs", [regs], [states], **more))
    assert {m[0] for m in want} == {WT.OPENED, WT.RELEASED, WT.EXPIRED}
    plain_jobs = WT.waiting_jobs
    monkeypatch.setattr(WT, "waiting_jobs", lambda *a: plain_jobs(*a, buckets=3))
    for n, a, b in ((1, 1, 1), (2, 4, 2)):
        assert one(moves(spark, tmp_path / f"buckets{n}", cut(regs, a), cut(states, b), **more)) == want
    # no ttl: what still waits stays, a row of state a bucket at most
    moves(spark, tmp_path / "kept", cut(regs, 3), [states], hold="5 hours")
    kept = spark.read.format("statestore").load(str(tmp_path / "kept" / "ckpt")).selectExpr("key.*").collect()
    assert 1 <= len(kept) <= 3 and kept[0].asDict().keys() == {"bucket"}


def test_registered_streams_call_once_for_many_jobs(spark, sf_small):
    t = Tables(spark, sf_small)
    jobs = t.job_status_events.select("job_id").unionByName(t.job_registry.selectExpr("id as job_id")).distinct().count()
    assert 0.9 <= S.job_buckets(t) * WT.BUCKET_JOBS / jobs < 2

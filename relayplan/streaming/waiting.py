"""T-3, T-7: the jobs that wait, as keyed state of a stream.

A job waits from its registration until its first terminal state. State is kept
per job, or for some jobs together: registrations not yet released, and terminal
states that came early.
All decisions are made in event time, when the watermark has passed them, so
that they are the same whichever of the two streams comes first and however
their rows are cut into batches:

- the first terminal state, by (time, event id), that is at most ``hold`` older
  than the registration releases the job; its state is cleared;
- with ``ttl``, a registration that is not released by then expires; no later
  state releases it;
- a terminal state that finds no registration within ``hold`` is forgotten.

Rows that come later than the watermark allows are dropped by Spark.

Registered again while it waits, a job keeps its wait and has the newest token.
What is kept of a job is its open registrations and the terminal states of the last
``hold``; non-terminal states never reach the state.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from relayplan import constants as K
from relayplan.functions.predicates import non_terminal
from relayplan.operators.jobs import interval_micros

OPENED, RELEASED, EXPIRED = "OPENED", "RELEASED", "EXPIRED"
#: The job of a clock row. Not null: Spark moves null checks below watermarks.
CLOCK = ""

MOVES = T.StructType([
    T.StructField("move", T.StringType()), T.StructField("job_id", T.StringType()),
    T.StructField("task_token", T.StringType()), T.StructField("reg_us", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("ts_us", T.LongType()),
    T.StructField("event_id", T.LongType())])
STATE = T.StructType([T.StructField("kept", T.StringType())])


def settle(kept: dict, now: int, hold: int, ttl: int | None) -> tuple[list[tuple], int | None]:
    """Decides what lies before the instant ``now``; changes ``kept``. Returns
    rows (move, token, reg_us, status, ts_us, event_id) and the instant at which
    to look again, if any is left. ``kept``: sorted lists ``regs`` (us, token,
    whether the wait was opened) and ``states`` (us, event id, status)."""
    regs, states, rows, due = kept["regs"], kept["states"], [], []
    while regs:
        start, token, opened = regs[0]
        if start > now:
            due.append(start)
            break
        if not opened:
            rows.append((OPENED, token, start, None, None, None))
            regs[0][2] = True
        end = next((s for s in states if s[0] >= start - hold), None)
        over = None if ttl is None else start + ttl
        if end is not None and (over is None or end[0] < over):
            if end[0] > now:
                due.append(end[0])
                break
            until, move = max(end[0], start), RELEASED
            states[:] = [s for s in states if s > end]
        elif over is not None and over <= now:
            until, move, end = over - 1, EXPIRED, (over, None, None)
        else:
            due += [] if over is None else [over]
            break
        # registrations up to the end are one wait
        token = [r[1] for r in regs if r[0] <= until][-1]
        rows.append((move, token, start, end[2], end[0], end[1]))
        regs[:] = [r for r in regs if r[0] > until]
    least = min(regs[0][0], now) if regs else now
    states[:] = [s for s in states if s[0] + hold >= least]
    if states and not regs:
        due.append(states[0][0] + hold)
    return rows, min(due, default=None)


def _processor(hold: int, ttl: int | None):
    """The function of a key: a job, or the jobs of a bucket. Its state is one text:
    what each of its jobs keeps, and when to look at that again."""
    names = MOVES.fieldNames()

    def run(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        jobs = json.loads(state.get[0]) if state.exists else {}
        touched = set()
        for f in frames:
            for text in f["row"].tolist():
                row = json.loads(text)
                job = row.get("job_id")
                if not job:  # the clock
                    continue
                kept = jobs.setdefault(job, {"regs": [], "states": [], "due": None})
                touched.add(job)
                if row["is_reg"]:
                    kept["regs"].append([row["us"], row.get("task_token"), False])
                else:
                    kept["states"].append([row["us"], row["event_id"], row.get("status")])
        now_ms = state.getCurrentWatermarkMs()
        now, moves = now_ms * 1000, []
        for job, kept in list(jobs.items()):
            if job not in touched and (kept["due"] is None or kept["due"] > now):
                continue
            if job in touched:
                kept["regs"].sort(key=lambda r: r[0])
                kept["states"].sort()
            rows, kept["due"] = settle(kept, now, hold, ttl)
            moves += [dict(zip(names, (m, job, *r), strict=True)) for m, *r in rows]
            if not (kept["regs"] or kept["states"]):
                del jobs[job]
        if jobs:
            state.update((json.dumps(jobs, separators=(",", ":")),))
            due = min((kept["due"] for kept in jobs.values() if kept["due"] is not None), default=None)
            if due is not None:
                state.setTimeoutTimestamp(max(due // 1000 + 1, now_ms + 1))
        elif state.exists:
            state.remove()
        if moves:
            yield pd.DataFrame({"moves": [json.dumps(moves)]})
    return run


#: Jobs of a bucket, about: what a call of the function costs besides its rows is
#: shared by as many, and its state is read and written whole.
BUCKET_JOBS = 128


def waiting_jobs(registrations: DataFrame, statuses: DataFrame, hold: str, ttl: str | None = None,
                 lateness: str = "10 minutes", buckets: int | None = None) -> DataFrame:
    """Streams of registrations (job_id, task_token, ts) and notifications
    (job_id, status, ts, event_id) to rows of ``MOVES``: a job's wait was opened,
    released by a state, or expired.

    State is kept per job, or with ``buckets`` per hash bucket of jobs: the rows are
    the same. A micro-batch that has rows for many jobs takes a call for each key,
    which costs far more than its rows, so streams of many jobs a batch should have
    buckets of some ``BUCKET_JOBS``. Their number belongs to the checkpoint."""
    us = F.unix_micros("ts").alias("us")
    key = "job_id" if buckets is None else "bucket"

    def packed(*more):  # one text a row: a column costs more than its values where a call gets a row or two
        return F.to_json(F.struct(us, "job_id", *more)).alias("row")

    def keyed(df, *more):
        keys = [F.col("job_id") if buckets is None else
                F.pmod(F.xxhash64("job_id"), F.lit(buckets)).cast("int").alias(key)]
        return df.select(*keys, "ts", packed(*more))

    r = keyed(registrations.withWatermark("ts", lateness), F.lit(True).alias("is_reg"), "task_token")
    s = keyed(statuses.withWatermark("ts", lateness).filter((F.col("job_id") == CLOCK) | ~non_terminal("status")),
              F.lit(False).alias("is_reg"), F.col("event_id").cast("long").alias("event_id"), "status")
    ttl_us = None if ttl is None else interval_micros(ttl)
    moves = r.unionByName(s).groupBy(key).applyInPandasWithState(
        _processor(interval_micros(hold), ttl_us), "moves string", STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return moves.select(F.inline(F.from_json("moves", T.ArrayType(MOVES))))


def intervals(moves: DataFrame) -> DataFrame:
    """``job_id, start_us, end_us`` of each wait; not yet ended: null."""
    opened = moves.filter(F.col("move") == OPENED).select("job_id", F.col("reg_us").alias("start_us"))
    ended = moves.filter(F.col("move") != OPENED).select(
        "job_id", F.col("reg_us").alias("start_us"), F.col("ts_us").alias("end_us"))
    return opened.join(ended, ["job_id", "start_us"], "left")


def registry_changes(moves: DataFrame) -> DataFrame:
    """What the moves change in a stored registry: a wait that opens is put, one
    that ends is removed (S-7, S-8)."""
    end = F.when(F.col("move") != OPENED, F.timestamp_micros(F.greatest("ts_us", "reg_us")))
    return moves.select(F.col("job_id").alias("id"), F.lit(K.REGISTRY_JOB_ID_TYPE).alias("id_type"), "task_token",
                        F.timestamp_micros("reg_us").alias("registered_at"), end.alias("removed_at"))

"""Runs that can be resumed: a state machine of jobs on an append-only table.

A run is an ordered list of named jobs under one run id (a source table's day,
say). Every change of state is one appended row of ``{database}.job_states``:

    started(attempt)  ->  committed(attempt)
                      ->  failed(attempt)  ->  started(attempt + 1) ...

* **Claim.** A job begins with a ``started`` row that carries a token of its own
  and a lease. A job whose last row is ``started`` with a lease that still holds
  belongs to another process, and is left to it. When two processes append their
  claims at the same time both read the table again: the claim that sorts first
  (by attempt, then time, then token) has the job.
* **Commit token.** The token is given to the job, which may write it with its
  results. A ``committed`` row ends the job: a later call of the run skips it, and
  hands back what the job returned as its result text.
* **Retries.** A failed job is tried again up to ``attempts`` times in all, over all
  calls of the run; waiting times double from ``wait_seconds``. Errors named in
  ``final`` (a failed quality gate: the data will not change by itself) are not
  retried within a call. After the last attempt the run stops, later jobs do not
  start, and a new call with more attempts goes on from there.

Jobs must themselves be safe to repeat, as the jobs of ``plans.jobs`` are: an
attempt that died between its write and its commit is run again.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, StringType, StructField, StructType, TimestampType)

from ..lake import Lake
from .tables import ensure_table, write_by_name

STARTED, FAILED, COMMITTED = "started", "failed", "committed"

STATE_SCHEMA = StructType([
    StructField("run_id", StringType()), StructField("job", StringType()),
    StructField("attempt", IntegerType()), StructField("state", StringType()),
    StructField("token", StringType()), StructField("at", TimestampType()),
    StructField("lease_until", TimestampType()), StructField("detail", StringType()),
    StructField("run_date", StringType()),
])


class JobTaken(RuntimeError):
    """Another process holds the job's lease."""


class AttemptsUsedUp(RuntimeError):
    """A job failed as often as it may."""


@dataclass(frozen=True)
class Job:
    """``work(token)`` does the job and may return a short result text."""

    name: str
    work: Callable[[str], str | None]


def _now() -> datetime:
    return datetime.now(timezone.utc)


class ResumableRun:
    """One run id's jobs, in order."""

    def __init__(self, spark: SparkSession, lake: Lake, run_id: str, jobs: Sequence[Job],
                 attempts: int = 3, wait_seconds: float = 1.0, lease_seconds: float = 3600.0,
                 database: str = "logs", final: tuple[type[BaseException], ...] = (),
                 clock: Callable[[], datetime] = _now,
                 sleep: Callable[[float], None] = time.sleep, run_date: str | None = None):
        names = [j.name for j in jobs]
        if len(set(names)) != len(names):
            raise ValueError("a run names a job twice")
        if attempts < 1:
            raise ValueError("a job needs one attempt at least")
        self.spark, self.lake, self.run_id, self.jobs = spark, lake, run_id, list(jobs)
        self.attempts, self.wait, self.lease = attempts, wait_seconds, lease_seconds
        self.final, self.clock, self.sleep = final, clock, sleep
        self.run_date = run_date or run_id
        self.table = f"{database}.job_states"
        ensure_table(spark, self.table,
                     [(f.name, f.dataType.simpleString()) for f in STATE_SCHEMA.fields],
                     "run_date", lake.location("logs", database, "job_states"))

    def states(self) -> DataFrame:
        """All state rows of this run; its date's partition only is read."""
        return self.spark.table(self.table).where(
            (F.col("run_date") == self.run_date) & (F.col("run_id") == self.run_id))

    def _append(self, job: str, attempt: int, state: str, token: str,
                detail: str | None = None) -> None:
        now = self.clock()
        until = now + timedelta(seconds=self.lease) if state == STARTED else None
        row = (self.run_id, job, attempt, state, token, now, until, detail, self.run_date)
        df = self.spark.createDataFrame([row], STATE_SCHEMA).coalesce(1)
        write_by_name(df, self.table, mode="append", rebalance=False)

    def _history(self, job: str) -> list:
        """Rows of a job in order; a few per attempt, bounded by the attempts."""
        self.spark.catalog.refreshTable(self.table)
        rows = self.states().where(F.col("job") == job).collect()
        order = {STARTED: 0, FAILED: 1, COMMITTED: 1}
        return sorted(rows, key=lambda r: (r.attempt, order[r.state], r["at"], r.token))

    @staticmethod
    def _holders(history: list) -> dict[int, object]:
        """Attempt -> the claim that has it: the first one."""
        out: dict[int, object] = {}
        for r in history:
            if r.state == STARTED:
                out.setdefault(r.attempt, r)
        return out

    def _claim(self, job: str) -> tuple[int, str] | str | None:
        """(attempt, token); or the result text of a committed job (None: without one)."""
        history = self._history(job)
        for r in history:
            if r.state == COMMITTED:
                return r.detail
        holders = self._holders(history)
        attempt = max(holders, default=0)
        if attempt:
            ended = {r.token for r in history if r.state == FAILED}
            if holders[attempt].token not in ended:
                until = holders[attempt].lease_until.replace(tzinfo=None)
                if until > self._wall():
                    raise JobTaken(f"{self.run_id}: {job} is being run by another process")
        if attempt >= self.attempts:
            raise AttemptsUsedUp(f"{self.run_id}: {job} used up its {self.attempts} attempts")
        token = uuid.uuid4().hex
        self._append(job, attempt + 1, STARTED, token)
        if self._holders(self._history(job))[attempt + 1].token != token:
            raise JobTaken(f"{self.run_id}: another process claimed {job} first")
        return attempt + 1, token

    def _wall(self) -> datetime:
        """The clock in the session's time zone, as timestamps are collected."""
        zone = datetime.now().astimezone().tzinfo
        return self.clock().astimezone(zone).replace(tzinfo=None)

    def _one(self, job: Job) -> str | None:
        while True:
            claim = self._claim(job.name)
            if not isinstance(claim, tuple):
                return claim
            attempt, token = claim
            try:
                detail = job.work(token)
            except Exception as exc:
                self._append(job.name, attempt, FAILED, token, f"{type(exc).__name__}: {exc}"[:500])
                if attempt >= self.attempts or isinstance(exc, self.final):
                    raise
                self.sleep(self.wait * 2 ** (attempt - 1))
                continue
            self._append(job.name, attempt, COMMITTED, token, detail)
            return detail

    def run(self) -> dict[str, str | None]:
        """Run what is not committed yet, in order; job -> result text."""
        return {job.name: self._one(job) for job in self.jobs}


def attempts_of(states: DataFrame) -> DataFrame:
    """Per run and job: attempts made, failures, and whether it is committed."""
    return states.groupBy("run_id", "job").agg(
        F.countDistinct(F.when(F.col("state") == STARTED, F.col("attempt"))).alias("attempts"),
        F.count_if(F.col("state") == FAILED).alias("failures"),
        F.bool_or(F.col("state") == COMMITTED).alias("committed"))

"""Resumable runs: attempts, leases, skipped jobs, final errors."""

from datetime import datetime, timedelta, timezone

import pytest

from strata.operators.quality import QualityGateError
from strata.operators.runs import (AttemptsUsedUp, Job, JobTaken, ResumableRun, attempts_of)
from strata.params import IngestParams, QualityParams
from strata.plans.daily import PipelineSpec
from strata.plans.resume import resume_pipeline
from strata.session import fresh_name


class Clock:
    def __init__(self):
        self.now = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)

    def __call__(self):
        self.now += timedelta(seconds=1)
        return self.now


@pytest.fixture()
def make(spark, lake):
    db, clock, slept = fresh_name("l"), Clock(), []

    def build(jobs, **settings):
        return ResumableRun(spark, lake, "run", jobs, database=db, clock=clock,
                            sleep=slept.append, run_date="20240101", **settings)

    build.clock, build.slept = clock, slept
    return build


def _failing(times, calls, error=OSError):
    def work(token):
        calls.append(token)
        if len(calls) <= times:
            raise error("no")
        return "done"

    return work


def _made(run):
    return {r.job: (r.attempts, r.failures, r.committed) for r in
            attempts_of(run.states()).collect()}


def test_retries_then_skips(make):
    first, second = [], []
    jobs = [Job("a", _failing(0, first)), Job("b", _failing(2, second))]
    run = make(jobs, wait_seconds=5)
    assert run.run() == {"a": "done", "b": "done"}
    assert make.slept == [5, 10]
    assert _made(run) == {"a": (1, 0, True), "b": (3, 2, True)}
    assert len(set(second)) == 3  # each attempt has its own token
    assert make(jobs).run() == {"a": "done", "b": "done"} and (len(first), len(second)) == (1, 3)


def test_stops_and_goes_on_with_more_attempts(make):
    calls, later = [], []
    jobs = [Job("a", _failing(3, calls)), Job("b", _failing(0, later))]
    with pytest.raises(OSError):
        make(jobs, attempts=2).run()
    assert not later
    with pytest.raises(AttemptsUsedUp):
        make(jobs, attempts=2).run()
    assert make(jobs, attempts=4).run()["b"] == "done" and len(calls) == 4


def test_final_errors_are_not_retried(make):
    calls = []
    jobs = [Job("a", _failing(1, calls, QualityGateError))]
    with pytest.raises(QualityGateError):
        make(jobs, final=(QualityGateError,)).run()
    assert len(calls) == 1
    make(jobs, final=(QualityGateError,)).run()
    assert len(calls) == 2


def test_a_running_job_is_left_alone_until_its_lease_ends(make):
    run = make([Job("a", _failing(0, []))], lease_seconds=60)
    run._claim("a")  # another process, which then dies
    with pytest.raises(JobTaken):
        make([Job("a", _failing(0, []))], lease_seconds=60).run()
    make.clock.now += timedelta(seconds=120)
    again = make([Job("a", _failing(0, []))], lease_seconds=60)
    assert again.run() == {"a": "done"} and _made(again) == {"a": (2, 0, True)}


def test_of_two_claims_the_first_wins(make):
    calls = []
    run = make([Job("a", _failing(0, calls))])
    append = run._append

    def raced(job, attempt, state, token, detail=None):
        if state == "started":
            make.clock.now -= timedelta(seconds=30)
            append(job, attempt, state, "other")  # a claim made a moment earlier
            make.clock.now += timedelta(seconds=30)
        append(job, attempt, state, token, detail)

    run._append = raced
    with pytest.raises(JobTaken):
        run.run()
    assert not calls


def test_bad_settings(make):
    with pytest.raises(ValueError):
        make([Job("a", str), Job("a", str)])
    with pytest.raises(ValueError):
        make([], attempts=0)


def test_day_goes_on_after_a_failure(spark, lake):
    """The records are taken once; the silver job that failed is done by the second call."""
    db, logs = fresh_name("s"), fresh_name("l")
    delivered = []

    def records():
        delivered.append(1)
        return spark.createDataFrame([(1, "a"), (2, None)], "id BIGINT, name STRING")

    def spec(gate):
        return PipelineSpec("shop", "items", "20240101",
                            IngestParams(db, "items", (("id", "BIGINT"), ("name", "STRING"))),
                            logs_db=logs, gate=QualityParams.from_dict({"quality_params": gate}))

    with pytest.raises(QualityGateError):
        resume_pipeline(spark, lake, records, spec({"not_null": {"column": "name"}}))
    assert resume_pipeline(spark, lake, records, spec({"not_null": {"column": "id"}}))[
        "bronze_to_silver"] == f"{db}.items"
    assert len(delivered) == 1 and spark.table(f"{db}.items").count() == 2
    states = attempts_of(spark.table(f"{logs}.job_states"))
    assert {r.job: r.attempts for r in states.collect()} == {"capture": 1, "bronze_to_silver": 2}

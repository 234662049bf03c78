"""Jobs that wait, as a stateful stream with event-time timers, and callbacks that answer them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ROCKS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}
CHANGES = "job string, us long, before string, status string, accepted boolean, cause string"
NEXT = {"": {"PROCESSING"}, "PROCESSING": {"COMPLETED", "REVIEW_PENDING", "FAILED"}, "FAILED": {"PROCESSING"}, "COMPLETED": set(), "REVIEW_PENDING": {"COMPLETED"}}
#: Jobs are dealt to so many buckets, each one key of the stream's state.
BUCKETS = 1024


class Jobs(StatefulProcessor):
    """State machines of a bucket's jobs: rows (job, us, seq, status) in order of time, each accepted or refused from its job's
    state so far.

    A job that is PROCESSING fails by itself ``timeout_ms`` after it began, whether a timer says so or a later row shows
    that the time had passed, so the answer does not hang on where batches end.  A job in any other state is
    forgotten ``forget_ms`` after its last change, so state is bounded.  A bucket's states are read and written once a batch
    and share one timer, the earliest; a batch's rows of a bucket are held in a worker at a time.
    """

    def __init__(self, timeout_ms: int, forget_ms: int | None):
        self.timeout_ms, self.forget_ms = timeout_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("jobs", "job array<string>, status array<string>, due array<long>")

    def _now(self) -> dict[str, tuple[str, int]]:
        if not self.state.exists():
            return {}
        names, statuses, dues = self.state.get()
        return dict(zip(names, zip(statuses, dues)))

    def _put(self, jobs: dict[str, tuple[str, int]]) -> None:
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t[0] if isinstance(t, tuple) else t)
        known = {job: x for job, x in jobs.items() if x[0]}
        if not known:
            self.state.clear()
            return
        self.state.update((list(known), [s for s, _ in known.values()], [d for _, d in known.values()]))
        if due := min((d for _, d in known.values() if d), default=0):
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        jobs, out = self._now(), []
        ordered = pd.concat(list(rows)).sort_values(["us", "seq"])
        for job, us, to in zip(ordered["job"].tolist(), ordered["us"].tolist(), ordered["status"].tolist()):
            status, due = jobs.get(job, ("", 0))
            while due and us // 1000 > due:  # a job that failed by its time may have been forgotten since, too
                status, due = jobs[job] = self._expired(job, status, due, out)
            ok = to in NEXT.get(status, ())
            out.append((job, us, status, to, ok, "asked"))
            if ok:
                jobs[job] = to, self._due(to, us // 1000)
        self._put(jobs)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        jobs, out = self._now(), []
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        for job, (status, due) in jobs.items():
            while due and due <= now:
                status, due = jobs[job] = self._expired(job, status, due, out)
        self._put(jobs)
        yield self._frame(out)

    def _due(self, status: str, ms: int) -> int:
        return ms + self.timeout_ms if status == "PROCESSING" else ms + self.forget_ms if self.forget_ms else 0

    def _expired(self, job: str, status: str, due: int, out: list[tuple]) -> tuple[str, int]:
        if status != "PROCESSING":
            return "", 0
        out.append((job, due * 1000, status, "FAILED", True, "timeout"))
        return "FAILED", self._due("FAILED", due)

    def _frame(self, out: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(out, columns=["job", "us", "before", "status", "accepted", "cause"])

    def close(self) -> None:
        pass


def job_states(stream: DataFrame, timeout_ms: int = 3_600_000, forget_ms: int | None = None, delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """Each status change of (job, at, seq, status) with the state before it, whether it is allowed, and its cause.

    ``buckets`` grows with the number of jobs and is fixed for a checkpoint.
    """
    for k, v in ROCKS.items():
        stream.sparkSession.conf.set(k, v)
    rows = stream.withWatermark("at", delay).select(F.pmod(F.xxhash64("job"), F.lit(buckets)).alias("bucket"), "at", "job", F.unix_micros("at").alias("us"), "seq", "status")
    changed = rows.groupBy("bucket").transformWithStateInPandas(Jobs(timeout_ms, forget_ms), CHANGES, "append", "eventTime")
    return changed.select("job", F.timestamp_micros("us").alias("at"), "before", "status", "accepted", "cause")


def outcome_of(answer: Column, request: Column, error: Column) -> Column:
    """What became of a request and an answer, either of them NULL where there is none."""
    return F.when(answer.isNull(), "timed_out").when(request.isNull(), "late").when(error.isNull(), "resumed").otherwise("failed")


def answered(requests: DataFrame, answers: DataFrame, timeout: str, delay: str = "0 seconds") -> DataFrame:
    """(token, job, asked_at, done_at, error, outcome) of requests (token, job, asked_at) and answers (token, done_at, error).

    One outer join by token within the time allowed: a request with its answer is ``resumed`` or ``failed``, one without is
    ``timed_out`` once both watermarks have passed its time, and an answer without a waiting request is ``late``.
    State holds a batch's rows and what is younger than that; ``stores.answer_writer`` does the same without state.
    """
    r = requests.withWatermark("asked_at", delay).alias("r")
    a = answers.withWatermark("done_at", delay).alias("a")
    j = r.join(a, F.expr(f"r.token = a.token AND a.done_at >= r.asked_at AND a.done_at <= r.asked_at + interval {timeout}"), "full_outer")
    outcome = outcome_of(F.col("a.token"), F.col("r.token"), F.col("a.error"))
    return j.select(F.coalesce("r.token", "a.token").alias("token"), "r.job", "r.asked_at", "a.done_at", "a.error", outcome.alias("outcome"))


def acknowledged(outcomes: str, late: str):
    """A batch writer that sends late answers to a table of their own and acknowledges the others."""

    def write(batch: DataFrame, batch_id: int) -> None:
        from ..workers import written

        rows = written(batch)
        rows.where("outcome <> 'late'").write.mode("overwrite").parquet(f"{outcomes}/batch={batch_id}")
        rows.where("outcome = 'late'").select("token", "done_at", "error").write.mode("overwrite").parquet(f"{late}/batch={batch_id}")

    return write

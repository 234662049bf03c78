"""Queries over streams made of ``events``: each feeds its slices of time one after the other, handles all that is
there, and stops; a last heartbeat moves the watermarks past all that waits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..streaming import flows, stores, timers
from .catalogue import _folder, query, sha, table

#: Slices of the month: most of it, its end, and two short ones.
_SLICE = "CASE WHEN day(ts) <= 20 THEN 0 WHEN day(ts) <= 29 THEN 1 WHEN hour(ts) < 20 THEN 2 ELSE 3 END"


def _fed(spark: SparkSession, sf: str, name: str, rows: Callable[[DataFrame], DataFrame], start: Callable[[DataFrame, str], None], heartbeat: Callable[[DataFrame], DataFrame] | None = None) -> str:
    """Feeds the slices of ``rows(events)`` to a stream, one run each; gives the folder that ``start`` writes to."""
    out = _folder(spark, name)
    events = table(spark, sf, "events")
    parts = [rows(events.where(F.expr(_SLICE) == i)) for i in range(4)] + ([heartbeat(events)] if heartbeat else [])
    for part in parts:
        part.write.mode("append").parquet(f"{out}/in")
        start(spark.readStream.schema(part.schema).parquet(f"{out}/in"), out)
    return out


_KIND = "CASE event_type WHEN 'signup' THEN 'register' WHEN 'error' THEN 'fail' ELSE 'status' END"
_VALUE = "CASE event_type WHEN 'signup' THEN 'f' || event_id WHEN 'error' THEN CASE WHEN value < 10 THEN '' ELSE props END WHEN 'purchase' THEN 'COMPLETED' WHEN 'view' THEN 'REVIEW_PENDING' ELSE CASE WHEN value < 40 THEN 'NONSENSE' ELSE 'PROCESSING' END END"


def _changes(events: DataFrame) -> DataFrame:
    return events.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("job"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), F.expr(_KIND).alias("kind"), F.expr(_VALUE).alias("value"))


def _job_table(spark, sf) -> str:
    start = lambda stream, out: flows.run_once(stream.writeStream.foreachBatch(stores.job_writer(f"{out}/jobs", f"{out}/refused")), f"{out}/state")
    return _fed(spark, sf, "jobs", _changes, start)


_WALK = f"""WITH RECURSIVE c AS (SELECT 'u' || user_id AS job, ts, event_id, {_SLICE} AS part, {_KIND} AS kind, {_VALUE} AS val, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk AS (SELECT job, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS TIMESTAMP) AS ts, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS val, CAST(NULL AS VARCHAR) AS problem, CAST(NULL AS VARCHAR) AS status, CAST(NULL AS VARCHAR) AS filename, CAST(NULL AS TIMESTAMP) AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at, CAST(NULL AS VARCHAR) AS error_reason FROM (SELECT DISTINCT job FROM c)
  UNION ALL SELECT job, i, event_id, ts, kind, val, problem, CASE WHEN problem IS NOT NULL THEN status WHEN kind = 'register' THEN 'PROCESSING' WHEN kind = 'fail' THEN 'FAILED' ELSE val END, CASE WHEN problem IS NULL AND kind = 'register' THEN val ELSE filename END,
    CASE WHEN problem IS NULL AND kind = 'register' THEN ts ELSE created_at END, CASE WHEN problem IS NULL THEN ts ELSE updated_at END, CASE WHEN problem IS NOT NULL THEN error_reason WHEN kind = 'fail' THEN val END
  FROM (SELECT w.job, c.i, c.event_id, c.ts, c.kind, c.val, w.status, w.filename, w.created_at, w.updated_at, w.error_reason,
    CASE c.kind WHEN 'register' THEN CASE WHEN w.status IS NULL OR w.status = 'FAILED' THEN NULL WHEN w.status = 'PROCESSING' THEN 'IN_PROGRESS' ELSE 'ALREADY_PROCESSED' END
      WHEN 'status' THEN CASE WHEN c.val = 'NONSENSE' THEN 'invalid_status' WHEN w.status IS NULL THEN 'not_found' END ELSE CASE WHEN c.val = '' THEN 'reason_missing' WHEN w.status IS NULL THEN 'not_found' END END AS problem
    FROM walk w JOIN c ON c.job = w.job AND c.i = w.i + 1))
"""


@query(_WALK + "SELECT job, status, filename, created_at, updated_at, error_reason FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY i DESC) AS k FROM walk) WHERE k = 1 AND status IS NOT NULL")
def job_store(spark, sf):
    """The table of jobs after all events, changed batch by batch."""
    return stores.read_jobs(spark, f"{_job_table(spark, sf)}/jobs")


@query(_WALK + "SELECT job, event_id AS seq, kind, problem FROM walk WHERE problem IS NOT NULL")
def job_store_refused(spark, sf):
    return stores.read_refused(spark, f"{_job_table(spark, sf)}/refused").select("job", "seq", "kind", "problem")


@query(_WALK + """, t AS (SELECT *, CAST('0x' || left(md5(job), 7) AS BIGINT) % 64 AS bucket FROM c), j AS (SELECT job, bucket, min(part) AS since FROM (SELECT t.* FROM t JOIN (SELECT job, min(i) AS i FROM walk WHERE status IS NOT NULL GROUP BY job) w ON w.job = t.job AND t.i = w.i) GROUP BY job, bucket)
SELECT CAST(part AS INT) AS batch, count(DISTINCT t.bucket) AS buckets_rewritten, (SELECT count(*) FROM j WHERE j.since <= t.part AND j.bucket IN (SELECT bucket FROM t AS o WHERE o.part = t.part)) AS jobs_written FROM t
WHERE t.bucket IN (SELECT bucket FROM j WHERE j.since <= t.part) GROUP BY part""")
def job_store_batches(spark, sf):
    """How many of the 64 buckets each batch rewrote, and how many jobs they hold."""
    kept = _folder(spark, "kept")

    def start(stream, out):
        def write(batch, batch_id):
            stores.job_writer(f"{out}/jobs", f"{out}/refused")(batch, batch_id)
            rows = spark.read.schema(stores.JOB + ", bucket int").parquet(f"{out}/jobs/batch={batch_id}")
            rows.agg(F.lit(batch_id).cast("int").alias("batch"), F.countDistinct("bucket").alias("buckets_rewritten"), F.count(F.lit(1)).alias("jobs_written")).write.mode("overwrite").parquet(f"{kept}/batch_id={batch_id}")

        flows.run_once(stream.writeStream.foreachBatch(write), f"{out}/state")

    _fed(spark, sf, "jobs", _changes, start)
    return spark.read.parquet(kept).drop("batch_id")


@query("SELECT sha256, event_id, user_id FROM (SELECT sha256(props) AS sha256, event_id, user_id, row_number() OVER (PARTITION BY props ORDER BY event_id) AS k FROM events) WHERE k = 1")
def stream_dedupe(spark, sf):
    """The first event of each content over all batches; what was seen is on disk, not in the stream's state."""
    rows = lambda e: e.select(sha("props").alias("sha256"), F.col("event_id").alias("seq"), "user_id")
    start = lambda stream, out: flows.run_once(stream.writeStream.foreachBatch(stores.first_seen_writer(f"{out}/ledger", f"{out}/rows", buckets=16)), f"{out}/state")
    out = _fed(spark, sf, "dedupe", rows, start)
    return spark.read.parquet(f"{out}/rows/batch=*").select("sha256", F.col("seq").alias("event_id"), "user_id")


_JOB_STATUS = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'purchase' THEN 'COMPLETED' WHEN 'view' THEN 'REVIEW_PENDING' ELSE 'PROCESSING' END"
_TIMEOUT_H = 8
_LAWFUL = "(s = '' AND c.status = 'PROCESSING') OR (s = 'PROCESSING' AND c.status IN ('COMPLETED', 'REVIEW_PENDING', 'FAILED')) OR (s = 'FAILED' AND c.status = 'PROCESSING') OR (s = 'REVIEW_PENDING' AND c.status = 'COMPLETED')"


@query(f"""WITH RECURSIVE c AS (SELECT CAST(user_id AS VARCHAR) AS job, ts, {_JOB_STATUS} AS status, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events),
walk AS (SELECT job, CAST(0 AS BIGINT) AS i, CAST(NULL AS TIMESTAMP) AS ts, '' AS before, '' AS asked, false AS accepted, '' AS state, CAST(NULL AS TIMESTAMP) AS since, CAST(NULL AS TIMESTAMP) AS ran_out FROM (SELECT DISTINCT job FROM c)
  UNION ALL SELECT job, i, ts, s, status, ok, CASE WHEN ok THEN status ELSE s END, CASE WHEN ok THEN ts WHEN over THEN NULL ELSE since END, CASE WHEN over THEN since + INTERVAL {_TIMEOUT_H} HOUR END FROM (
    SELECT c.job, c.i, c.ts, c.status, x.s, x.over, x.since, {_LAWFUL} AS ok FROM (SELECT job, i, since, state = 'PROCESSING' AND nxt > since + INTERVAL {_TIMEOUT_H} HOUR AS over, CASE WHEN state = 'PROCESSING' AND nxt > since + INTERVAL {_TIMEOUT_H} HOUR THEN 'FAILED' ELSE state END AS s
      FROM (SELECT w.*, n.ts AS nxt FROM walk w JOIN c n ON n.job = w.job AND n.i = w.i + 1)) x JOIN c ON c.job = x.job AND c.i = x.i + 1)),
ends AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY i DESC) AS k FROM walk)
SELECT job, ts AS at_, before, asked AS status, accepted, 'asked' AS cause FROM walk WHERE i > 0 UNION ALL SELECT job, make_timestamp(epoch_us(ran_out) // 1000 * 1000), 'PROCESSING', 'FAILED', true, 'timeout' FROM walk WHERE ran_out IS NOT NULL
UNION ALL SELECT job, make_timestamp((epoch_us(since) // 1000 + {_TIMEOUT_H} * 3600000) * 1000), 'PROCESSING', 'FAILED', true, 'timeout' FROM ends WHERE k = 1 AND state = 'PROCESSING'""".replace("at_", "changed_at"))
def stream_states(spark, sf):
    """Every change of every job; a job that is not done in time fails by its timer."""
    rows = lambda e: e.select(F.col("user_id").cast("string").alias("job"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), F.expr(_JOB_STATUS).alias("status"))
    beat = lambda e: e.agg((F.max("ts") + F.expr("interval 30 days")).cast("timestamp").alias("at")).select(F.lit("").alias("job"), "at", F.lit(0).cast("long").alias("seq"), F.lit("").alias("status"))
    start = lambda stream, out: flows.run_once(timers.job_states(stream, _TIMEOUT_H * 3_600_000).writeStream.format("parquet").option("path", f"{out}/rows"), f"{out}/state")
    out = _fed(spark, sf, "states", rows, start, beat)
    return spark.read.parquet(f"{out}/rows").where("job <> ''").select("job", F.col("at").alias("changed_at"), "before", "status", "accepted", "cause")


_CALLBACKS = """WITH q AS (SELECT event_id // 2 AS token, user_id, ts FROM events WHERE event_id % 2 = 0), a AS (SELECT event_id // 2 AS token, ts, CASE WHEN event_type = 'error' THEN props END AS error FROM events WHERE event_id % 2 = 1),
o AS (SELECT coalesce(q.token, a.token) AS token, q.user_id, q.ts AS asked_at, a.ts AS done_at, a.error, CASE WHEN a.token IS NULL THEN 'timed_out' WHEN q.token IS NULL THEN 'late' WHEN a.error IS NULL THEN 'resumed' ELSE 'failed' END AS outcome FROM q FULL JOIN a ON a.token = q.token AND a.ts BETWEEN q.ts AND q.ts + INTERVAL 4 MINUTE)
"""


def _callbacks(spark, sf) -> str:
    """Events in pairs: the even one asks, the odd one answers, in time or too late."""
    token = F.floor(F.col("event_id") / 2).cast("string")
    rows = lambda e: e.select((F.col("event_id") % 2 == 1).alias("is_answer"), token.alias("token"), F.col("user_id").cast("string").alias("job"), F.col("ts").cast("timestamp").alias("at"), F.when((F.col("event_type") == "error") & (F.col("event_id") % 2 == 1), F.col("props")).alias("error"))
    last = lambda e: e.agg((F.max("ts") + F.expr("interval 1 day")).cast("timestamp").alias("at"))
    beat = lambda e: last(e).select(F.explode(F.array(F.lit(True), F.lit(False))).alias("is_answer"), F.when(F.col("is_answer"), "end").otherwise("begin").alias("token"), F.lit("").alias("job"), "at", F.lit(None).cast("string").alias("error"))

    start = lambda stream, out: flows.run_once(stream.writeStream.foreachBatch(stores.answer_writer(f"{out}/calls", f"{out}/outcomes", f"{out}/late", "4 minutes")), f"{out}/state")
    return _fed(spark, sf, "callbacks", rows, start, beat)


@query(_CALLBACKS + "SELECT CAST(token AS BIGINT) AS token, CAST(user_id AS VARCHAR) AS job, asked_at, done_at, error, outcome FROM o WHERE outcome <> 'late'")
def callback_outcomes(spark, sf):
    """Every request with its answer in time, or timed out, over a stream of requests and their answers."""
    return spark.read.parquet(f"{_callbacks(spark, sf)}/outcomes/batch=*").select(F.col("token").cast("long").alias("token"), "job", "asked_at", "done_at", "error", "outcome")


@query(_CALLBACKS + "SELECT CAST(token AS BIGINT) AS token, done_at, error FROM o WHERE outcome = 'late'")
def late_answers(spark, sf):
    return spark.read.parquet(f"{_callbacks(spark, sf)}/late/batch=*").select(F.col("token").cast("long").alias("token"), "done_at", "error")


_PROBLEM = "CASE WHEN event_type = 'error' THEN 'pdf ' || props WHEN value < 5 THEN 'TOO_SMALL' WHEN user_id % 10 = 3 AND event_type = 'view' THEN 'NOT_FOUND' END"


@query(f"""SELECT event_id, user_id, {_PROBLEM} AS cause, ts AS failed_at, ts + INTERVAL 14 DAY AS kept_until FROM events WHERE {_PROBLEM} IS NOT NULL AND ts + INTERVAL 14 DAY >= TIMESTAMP '2024-01-25'""")
def dead_letters(spark, sf):
    """Triggers that failed, with their causes, those still kept; read back from their JSON."""
    rows = lambda e: e.select("event_id", "user_id", F.col("ts").alias("at"), F.expr(_PROBLEM).alias("problem"))
    start = lambda stream, out: flows.run_once(stream.writeStream.foreachBatch(stores.routed_writer(f"{out}/good", f"{out}/dead")), f"{out}/state")
    letters = stores.read_letters(spark, f"{_fed(spark, sf, 'letters', rows, start)}/dead").where("kept_until >= timestamp_ntz'2024-01-25'")
    return letters.select(F.from_json("trigger", "event_id long, user_id long").alias("t"), "cause", "failed_at", "kept_until").select("t.*", "cause", "failed_at", "kept_until")


_FAILING = "CASE event_type WHEN 'error' THEN 'transient' WHEN 'view' THEN 'undecodable' WHEN 'signup' THEN 'permanent' END"


@query(f"""WITH e AS (SELECT event_id, {_FAILING} AS err, CAST(floor(value / 20) AS INT) AS fails FROM events), m AS (SELECT *, CASE err WHEN 'transient' THEN 5 WHEN 'undecodable' THEN 2 ELSE 1 END AS most FROM e)
SELECT event_id, CASE WHEN err IS NULL OR fails < most THEN event_id * 2 END AS answer, CASE WHEN err IS NOT NULL AND fails >= most THEN err END AS error, CASE WHEN err IS NULL OR fails < most THEN 'succeeded' ELSE 'failed' END AS outcome, CASE WHEN err IS NULL THEN 1 ELSE least(fails + 1, most) END AS attempts FROM m""")
def retry_outcomes(spark, sf):
    """Calls that fail so many times as the event's value says, each class of error under its own policy."""

    def call(rows, attempt):
        bad = rows["err"].notna() & (rows["fails"] >= attempt)
        return rows.assign(error=rows["err"].where(bad, None), answer=(rows["event_id"] * 2).astype("Int64").mask(bad))[["event_id", "answer", "error"]]

    e = table(spark, sf, "events").select("event_id", F.expr(_FAILING).alias("err"), F.floor(F.col("value") / 20).cast("int").alias("fails"))
    quick = {k: (n, 0, 0) for k, (n, _, _) in flows.POLICIES.items()}
    return flows.called(e, call, "event_id long, answer long", quick, batch=1000).select("event_id", "answer", "error", "outcome", "attempts")

"""Tables that micro-batches change a few partitions at a time.

Rows are dealt to buckets by a hash of their key, and a batch writes only the buckets that it touches, to a folder of
its own: ``root/batch=B/bucket=K``.  Batch B reads what batches before B have written, so a batch that runs again
starts from the same state, replaces its own folder and changes nothing else; a folder counts once it is complete.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks
from ..workers import written

BUCKETS = 64
JOB = "job string, status string, filename string, created_at timestamp, updated_at timestamp, error_reason string"
STATE = ("status", "filename", "created_at", "updated_at", "error_reason")
REFUSED = "job string, at timestamp, seq long, kind string, value string, problem string"


def bucket_of(key, buckets: int = BUCKETS) -> Column:
    """The bucket of a key, from its MD5, so that any engine can find it."""
    key = F.col(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 7), 16, 10).cast("long") % buckets).cast("int")


def _file_system(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _complete(spark: SparkSession, root: str) -> list[tuple[int, object]]:
    """(batch, path) of the batches that were written whole, in order."""
    fs, path = _file_system(spark, root)
    found = [x.getPath() for x in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "batch=*")) or []]
    return sorted(((int(x.getName().split("=")[1]), x) for x in found if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(x, "_SUCCESS"))), key=lambda x: x[0])


def versions(spark: SparkSession, root: str) -> dict[int, list[int]]:
    """Bucket -> the complete batches that wrote it, in order; names only, no data is read."""
    fs, _ = _file_system(spark, root)
    out: dict[int, list[int]] = {}
    for number, batch in _complete(spark, root):
        for bucket in fs.listStatus(batch):
            if (name := bucket.getPath().getName()).startswith("bucket="):
                out.setdefault(int(name.split("=")[1]), []).append(number)
    return {k: sorted(v) for k, v in out.items()}


def _read(spark: SparkSession, root: str, parts: list[tuple[int, int]], schema: str) -> DataFrame:
    """The rows of (batch, bucket) parts."""
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/batch={b}/bucket={k}" for b, k in parts])


def _replace(df: DataFrame, root: str, batch_id: int) -> None:
    df.repartition(F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{root}/batch={batch_id}")


def _drop_older(spark: SparkSession, root: str, parts: list[tuple[int, int]]) -> None:
    fs, _ = _file_system(spark, root)
    for batch, bucket in parts:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/batch={batch}/bucket={bucket}"), True)


def touched(batch: DataFrame) -> list[int]:
    """The buckets of a batch, at most as many as there are."""
    return sorted(r[0] for r in batch.select("bucket").distinct().collect())


# --- jobs -----------------------------------------------------------------------------------------------------


def applied(now: DataFrame, changes: DataFrame) -> DataFrame:
    """(job, state, refused): jobs after their changes (job, at, seq, kind, value, reason), folded in order of at and seq.

    ``register`` (value: file name) takes a job that is new or FAILED, and fails it at once where a reason is given;
    ``status`` sets a status other than FAILED and clears the error; ``fail`` (value: reason) fails a job.  What is not allowed is refused with its problem and changes
    nothing.  State and changes meet in one exchange.
    """
    kinds = f"struct<{', '.join(f'{c}: {k}' for c, k in (x.split(' ') for x in JOB.split(', ')[1:]))}>"
    state, change = F.struct(*STATE).cast(kinds), F.struct("at", "seq", "kind", "value", "reason")
    rows = now.select("job", state.alias("state"), F.lit(None).cast("struct<at:timestamp,seq:bigint,kind:string,value:string,reason:string>").alias("change"))
    rows = rows.unionByName(changes.select("job", F.lit(None).cast(kinds).alias("state"), change.alias("change")))
    d = rows.groupBy("job").agg(F.max("state").alias("state"), F.array_sort(F.collect_list("change")).alias("changes"))
    refusal = "array<struct<at:timestamp,seq:bigint,kind:string,value:string,problem:string>>"

    def step(acc: Column, x: Column) -> Column:
        was, kind, value, at = acc.getField("state"), x.getField("kind"), x.getField("value"), x.getField("at")
        status = was.getField("status")
        new, known = kind == "register", status.isNotNull()
        problem = F.when(
            new, F.when(~(status.isNull() | checks.reprocessable(status)), checks.conflict_decision(status).getField("code"))
        ).when(kind == "status", F.when(~checks.valid_status(value) | (value == "FAILED"), "invalid_status").when(~known, "not_found")).when(kind == "fail", F.when(F.coalesce(value, F.lit("")) == "", "reason_missing").when(~known, "not_found")).otherwise("unknown_change")
        after = F.struct(
            F.when(new, F.when(x.getField("reason").isNull(), "PROCESSING").otherwise("FAILED")).when(kind == "fail", "FAILED").otherwise(value).alias("status"),
            F.when(new, value).otherwise(was.getField("filename")).alias("filename"),
            F.when(new, at).otherwise(was.getField("created_at")).alias("created_at"),
            at.alias("updated_at"),
            F.when(kind == "fail", value).when(new, x.getField("reason")).alias("error_reason"),
        )
        said = F.array_append(acc.getField("refused"), F.struct(at.alias("at"), x.getField("seq").alias("seq"), kind.alias("kind"), value.alias("value"), problem.alias("problem")))
        return F.struct(F.when(problem.isNull(), after).otherwise(was).cast(kinds).alias("state"), F.when(problem.isNull(), acc.getField("refused")).otherwise(said).cast(refusal).alias("refused"))

    done = F.aggregate("changes", F.struct(F.col("state"), F.array().cast(refusal).alias("refused")), step)
    return d.select("job", done.alias("d")).select("job", "d.state", "d.refused")


def job_writer(root: str, refused_root: str, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A batch writer for changes (job, at, seq, kind, value[, reason]): touched buckets are folded and written, the rest is not
    read.  Refused changes go to ``refused_root``.  States older than the one a batch started from are deleted."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changes = written(batch.select("job", F.col("at").cast("timestamp").alias("at"), F.col("seq").cast("long").alias("seq"), "kind", "value", (F.col("reason") if "reason" in batch.columns else F.lit(None)).cast("string").alias("reason"), bucket_of("job", buckets).alias("bucket")))
        mine, had = touched(changes), versions(spark, root)
        before = {k: [b for b in had.get(k, []) if b < batch_id] for k in mine}
        now = _read(spark, root, [(v[-1], k) for k, v in before.items() if v], JOB)
        folded = written(applied(now, changes.drop("bucket")))
        _replace(folded.where("state.status IS NOT NULL").select("job", "state.*", bucket_of("job", buckets).alias("bucket")), root, batch_id)
        folded.select("job", F.explode("refused").alias("r")).select("job", "r.*").write.mode("overwrite").parquet(f"{refused_root}/batch={batch_id}")
        _drop_older(spark, root, [(b, k) for k, v in before.items() for b in v[:-1]])

    return write


def read_jobs(spark: SparkSession, root: str) -> DataFrame:
    """All jobs as the last complete batch of their bucket left them."""
    return _read(spark, root, [(v[-1], k) for k, v in versions(spark, root).items()], JOB)


def read_refused(spark: SparkSession, refused_root: str) -> DataFrame:
    return spark.read.schema(REFUSED).parquet(f"{refused_root}/batch=*")


# --- contents seen before ---------------------------------------------------------------------------------------


def first_seen_writer(ledger: str, out: str, key: str = "sha256", order: str = "seq", buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A batch writer that passes on the first row of each key, by ``order``, and none of keys of earlier batches.

    What was seen is kept on disk by bucket, and a batch probes only the buckets of its own keys; the stream itself
    holds no state, however long it runs.  Rows without a key are passed on.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("bucket", bucket_of(F.coalesce(F.col(key), F.lit("")), buckets))
        named = rows.where(F.col(key).isNotNull())
        first = written(named.groupBy(key).agg(F.min_by(F.struct(*batch.columns), order).alias("r"), F.first("bucket").alias("bucket")))
        had = versions(spark, ledger)
        seen = _read(spark, ledger, [(b, k) for k in touched(first) for b in had.get(k, []) if b < batch_id], f"{key} string")
        fresh = written(first.join(seen, key, "left_anti"))
        _replace(fresh.select(key, "bucket"), ledger, batch_id)
        fresh.select("r.*").unionByName(rows.where(F.col(key).isNull()).drop("bucket")).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return write


# --- requests and their answers ---------------------------------------------------------------------------------

CALLS = "is_answer boolean, token string, job string, at timestamp, error string"


def answer_writer(root: str, outcomes: str, late: str, timeout: str, delay: str = "0 seconds") -> Callable[[DataFrame, int], None]:
    """A batch writer for requests and answers (CALLS) that gives what ``timers.answered`` gives, with nothing in the
    stream's state.

    A batch's rows meet each other and those that still wait in one outer join.  What both sides have seen sets the
    mark: a request times out when its time ends before the mark, an answer is late when it came before it, and rows whose
    time has not ended are written as those that wait; the others may not meet any more.  A row that itself comes after the
    mark is answered from what waits then.
    """
    span = F.expr(f"interval {timeout}")

    def write(batch: DataFrame, batch_id: int) -> None:
        from .timers import acknowledged, outcome_of

        spark = batch.sparkSession
        had = [b for b, _ in _complete(spark, f"{root}/waiting") if b < batch_id]
        rows = batch.select("is_answer", "token", "job", "at", "error", F.lit(True).alias("fresh"))
        if had:
            waiting = spark.read.schema(CALLS).parquet(f"{root}/waiting/batch={had[-1]}")
            rows = rows.unionByName(waiting.withColumn("fresh", F.lit(False)))
        seen = [F.max(F.when(F.col("is_answer") == x, F.unix_micros(F.col("at") - F.expr(f"interval {delay}")))).alias(c) for c, x in (("asked", False), ("done", True))]
        marks = batch.agg(*seen)
        was = spark.read.schema("asked long, done long").parquet(f"{root}/marks/batch={had[-1]}").first() if had else (None, None)
        now = [max((x for x in pair if x is not None), default=None) for pair in zip(was, marks.first())]
        mark, before = (F.timestamp_micros(F.lit(None if None in x else min(x)).cast("long")) for x in (now, was))

        r = rows.where("NOT is_answer").select("token", "job", F.col("at").alias("asked_at"), "fresh").alias("r")
        a = rows.where("is_answer").select("token", F.col("at").alias("done_at"), "error", "fresh", F.lit(True).alias("there")).alias("a")
        j = r.join(a, (F.col("r.token") == F.col("a.token")) & (F.col("done_at") >= F.col("asked_at")) & (F.col("done_at") <= F.col("asked_at") + span), "full_outer")
        decided = (
            F.when(F.col("a.there").isNull(), F.col("asked_at") + span < mark)
            .when(F.col("r.fresh").isNull(), (F.col("done_at") < mark) & (F.col("a.fresh") | before.isNull() | (F.col("done_at") >= before)))
            .otherwise(F.col("r.fresh") | F.col("a.fresh"))
        )
        out = j.where(decided).select(F.coalesce("r.token", "a.token").alias("token"), "job", "asked_at", "done_at", "error", outcome_of(F.col("a.there"), F.col("r.fresh"), F.col("error")).alias("outcome"))
        acknowledged(outcomes, late)(out, batch_id)
        spark.range(1).select(*[F.lit(x).cast("long").alias(c) for x, c in zip(now, ("asked", "done"))]).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")
        rows.where(F.coalesce(F.col("at") + span >= mark, F.lit(True))).drop("fresh").write.mode("overwrite").parquet(f"{root}/waiting/batch={batch_id}")
        fs, _ = _file_system(spark, root)
        for b in had[:-1]:
            for part in ("waiting", "marks"):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{part}/batch={b}"), True)

    return write


# --- dead letters -----------------------------------------------------------------------------------------------


def routed_writer(out: str, dead: str, problem: str = "problem", at: str = "at", keep_days: int = 14) -> Callable[[DataFrame, int], None]:
    """A batch writer that parts good rows from failing ones: a failing trigger is kept whole as JSON, with its cause
    and the time until which it is kept.  Times are the trigger's, so a batch that runs again writes the same."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = written(batch)
        good = F.col(problem).isNull()
        rows.where(good).drop(problem).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        kept = F.struct(*[c for c in batch.columns if c != problem])
        letters = rows.where(~good).select(F.to_json(kept).alias("trigger"), F.col(problem).alias("cause"), F.col(at).alias("failed_at"), (F.col(at) + F.make_dt_interval(F.lit(keep_days))).alias("kept_until"))
        letters.write.mode("overwrite").parquet(f"{dead}/batch={batch_id}")

    return write


def read_letters(spark: SparkSession, dead: str, as_of=None) -> DataFrame:
    """Letters that are still kept at ``as_of``, all without it."""
    d = spark.read.parquet(f"{dead}/batch=*")
    return d if as_of is None else d.where(F.col("kept_until") >= F.lit(as_of))


def redriven(letters: DataFrame, schema: str) -> DataFrame:
    """The triggers of letters as rows again."""
    return letters.select(F.from_json("trigger", schema).alias("t"), "cause").select("t.*", "cause")

"""Event-driven parts as Structured Streaming: ingestion, de-duplication, waiting for callbacks, routing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import checks
from ..sources.readers import BINARY


def upload_stream(spark: SparkSession, root: str) -> DataFrame:
    """One row for each new upload, with job, hash and file mark; other prefixes never trigger."""
    f = spark.readStream.format("binaryFile").schema(BINARY).load(f"{root}/uploads/*/original.pdf")
    return f.select(checks.job_id_of("path").alias("job"), "path", "modificationTime", "length", F.sha2("content", 256).alias("sha256"), checks.looks_like_pdf("content").alias("is_pdf")).where("job IS NOT NULL")


def once_by_content(stream: DataFrame, time: str, delay: str = "30 days") -> DataFrame:
    """The first event of each content hash within the delay, which bounds the state; ``stores.first_seen_writer``
    remembers for ever, on disk."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(["sha256"])


def validated(stream: DataFrame, infos: DataFrame) -> DataFrame:
    """Adds reason (NULL: accepted) and decision from file facts (job, encrypted, pages)."""
    j = stream.join(infos, "job", "left")
    why = checks.rejection("length", "is_pdf", "sha256", "job", F.coalesce("encrypted", F.lit(False)), "pages")
    return j.withColumn("reason", why).withColumn("decision", F.when(F.col("reason").isNull(), "PROCEED").otherwise("REJECTED"))


def upload_changes(uploads: DataFrame) -> DataFrame:
    """Validated uploads as changes of the job table: each registers its job, and fails it where it was rejected."""
    return uploads.select("job", F.col("modificationTime").alias("at"), F.xxhash64("path").alias("seq"), F.lit("register").alias("kind"), F.col("path").alias("value"), "reason")


def fan_out(sinks: dict[str, str], column: str = "decision") -> Callable[[DataFrame, int], None]:
    """A batch writer that sends rows to the folder of their decision; running a batch again replaces its part."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for value, path in sinks.items():
            batch.where(F.col(column) == value).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def latest_status(stream: DataFrame) -> DataFrame:
    """The last status of each job, as an updating aggregate."""
    return stream.groupBy("job").agg(F.max_by("status", "at").alias("status"), F.max("at").alias("at"))


def run_once(writer: DataStreamWriter, checkpoint: str) -> None:
    """All that is there now, then stop; the next run goes on after it."""
    q = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


#: Attempts, first and longest wait in ms by class of error; any other class is not tried again.
POLICIES = {"transient": (5, 500, 20_000), "undecodable": (2, 0, 0)}


def called(df: DataFrame, call: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str, policies: dict[str, tuple[int, int, int]] = POLICIES, concurrency: int = 5, batch: int = 100) -> DataFrame:
    """Calls out for rows, so many tasks at a time, and tries failed rows again by the policy of their class of error.

    ``call(rows, attempt)`` answers every row it is given, in the rows' index: ``error`` is the class of its error, or
    None, beside the columns of ``schema``.  Only rows whose policy allows it are queued for the next attempt, after a
    wait with full jitter; answered rows are not asked again, and a row that fails stops no other.  Adds ``outcome``
    (succeeded or failed), ``error`` and ``attempts``.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import random
        import time

        for frame in frames:
            for i in range(0, len(frame), batch):
                queued, attempt = frame.iloc[i : i + batch], 1
                while len(queued):
                    got = call(queued, attempt)
                    left = got["error"].map(lambda e: policies.get(e, (1, 0, 0))[0] if isinstance(e, str) else 0)
                    done = got[left <= attempt]
                    failed = done["error"].map(lambda e: isinstance(e, str)).astype(bool)
                    yield done.assign(outcome=failed.map({True: "failed", False: "succeeded"}), attempts=attempt)
                    again = got.index[left > attempt]
                    waits = [policies[e][1:] for e in got.loc[again, "error"]]
                    if waits:
                        time.sleep(random.uniform(0, max(min(base * 2 ** (attempt - 1), cap) for base, cap in waits)) / 1000)
                    queued, attempt = queued.loc[again], attempt + 1

    # Rows are dealt evenly: how long a call takes says nothing about its key.
    return df.repartition(concurrency).mapInPandas(run, f"{schema}, error string, outcome string, attempts int")


def page_answers(pages: DataFrame, call: Callable[[pd.DataFrame, int], pd.DataFrame], schema: str, **options) -> DataFrame:
    """Answers for pages (job, page, ...): whatever page an answer names, it gets the one that was asked for."""

    def asked(rows: pd.DataFrame, attempt: int) -> pd.DataFrame:
        return call(rows, attempt).assign(job=rows["job"], page=rows["page"])

    return called(pages, asked, schema, **options)


def throttled(df: DataFrame, call: Callable[[pd.DataFrame], pd.DataFrame], schema: str, interval_s: float = 0.35) -> DataFrame:
    """Calls out for rows one batch at a time with a least interval: the outside service is the limit, not Spark."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import time

        last = 0.0
        for frame in frames:
            for i in range(len(frame)):
                wait = interval_s - (time.monotonic() - last)
                if last and wait > 0:
                    time.sleep(wait)
                last = time.monotonic()
                yield call(frame.iloc[i : i + 1])

    return df.coalesce(1).mapInPandas(run, schema)

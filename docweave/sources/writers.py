"""Sinks: idempotent overwrites, snapshots, rejects, recordings, object keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import _col

CHUNK_PAGES = 25


def overwrite_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Replaces what is there; with ``by``, only the partitions that ``df`` holds."""
    w = df.write.mode("overwrite")
    (w.option("partitionOverwriteMode", "dynamic").partitionBy(by) if by else w).json(path)


def overwrite_parquet(df: DataFrame, path: str, by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    (w.option("partitionOverwriteMode", "dynamic").partitionBy(by) if by else w).parquet(path)


def write_snapshot(df: DataFrame, root: str, version: int) -> str:
    """A new version beside the old ones, so a reader never sees half of one, and no job reads what it writes."""
    path = f"{root}/v={version:012d}"
    df.write.mode("overwrite").parquet(path)
    return path


def read_snapshot(spark: SparkSession, root: str) -> tuple[DataFrame | None, int]:
    """(the last complete version, its number); (None, -1) before the first."""
    jvm = spark._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(root)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(jpath):
        return None, -1
    names = [f.getPath() for f in fs.listStatus(jpath)]
    done = sorted(int(p.getName()[2:]) for p in names if p.getName().startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))
    return (spark.read.parquet(f"{root}/v={done[-1]:012d}"), done[-1]) if done else (None, -1)


def page_chunks(pages: DataFrame, size: int = CHUNK_PAGES) -> DataFrame:
    """Adds chunk, so that a writer handles so many pages at once."""
    return pages.withColumn("chunk", F.floor((F.col("page") - 1) / size).cast("int"))


def chunk_problems(pages: DataFrame, counts: DataFrame, size: int = CHUNK_PAGES) -> DataFrame:
    """(job, chunk, expected, written) of chunks that lack pages."""
    chunks = F.explode(F.sequence(F.lit(0), F.floor((F.col("page_count") - 1) / size).cast("int"))).alias("chunk")
    w = counts.where("page_count >= 1").select("job", "page_count", chunks).groupBy("job", "chunk").agg(F.sum(F.least(F.lit(size), F.col("page_count") - F.col("chunk") * size)).cast("bigint").alias("expected"))
    # A page is a bit of its chunk, so that a chunk takes one number where it is counted.
    if size <= 64:
        written = F.bit_count(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(page - 1, {size}) as int))"))).cast("bigint")
    else:
        written = F.countDistinct("page")
    got = page_chunks(pages, size).groupBy("job", "chunk").agg(written.alias("written"))
    return w.join(got, ["job", "chunk"], "left").withColumn("written", F.coalesce("written", F.lit(0))).where("written < expected")


def failures(df: DataFrame) -> DataFrame:
    """Failure reports (job, code, cause) with the cause as JSON."""
    return df.select("job", F.col("code"), F.to_json(F.struct(F.col("job"), F.col("ocr_job"), F.col("message"))).alias("cause"))


def recording(calls: DataFrame) -> DataFrame:
    """What a recorder keeps of calls (job, at, token, status, ...): pages still in progress are dropped, and a call
    for the first page, which has no token, starts the job's list anew. Adds page, from 1 on."""
    w = W.partitionBy("job")
    done = calls.where(F.coalesce("status", F.lit("")) != "IN_PROGRESS")
    start = F.max(F.when(F.coalesce("token", F.lit("")) == "", F.col("at"))).over(w)
    return done.withColumn("_start", start).where("_start IS NULL OR at >= _start").drop("_start").withColumn("page", F.row_number().over(w.orderBy("at")))


def recorded_bodies(responses: DataFrame) -> DataFrame:
    """Responses (url, status, content) as they are recorded: valid JSON as body, anything else as text."""
    is_json = F.try_parse_json("content").isNotNull()
    return responses.select("url", "status", F.when(is_json, F.col("content")).alias("body"), F.when(~is_json, F.col("content")).alias("text"))


def raw_first(raw_root: str, result_root: str, interpret: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A batch writer that saves raw answers before it interprets them: a failing interpretation leaves them readable,
    and running a batch again replaces its parts. Results are made from what was saved."""

    def write(batch: DataFrame, batch_id: int) -> None:
        path = f"{raw_root}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        interpret(batch.sparkSession.read.schema(batch.schema).parquet(path)).write.mode("overwrite").parquet(f"{result_root}/batch={batch_id}")

    return write


def upload_key(job) -> Column:
    return F.format_string("uploads/%s/original.pdf", _col(job))


def page_image_key(job, page) -> Column:
    return F.format_string("work/%s/pages/page-%04d.png", _col(job), _col(page))


def page_result_key(job, page) -> Column:
    return F.format_string("work/%s/bedrock/page-%04d.json", _col(job), _col(page))


def text_layer_key(job) -> Column:
    return F.format_string("work/%s/text/layer.txt", _col(job))


def result_key(job, route) -> Column:
    return F.format_string("outputs/%s/result-%s.json", _col(job), _col(route))


def comparison_key(job) -> Column:
    return F.format_string("outputs/%s/comparison.json", _col(job))


def expired(files: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Work files past their retention; uploads and outputs never expire."""
    return files.where(F.col("path").rlike("(^|/)work/") & (F.col("modificationTime") < F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))))

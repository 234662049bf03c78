"""Scans: files, JSON with a fixed schema, feeds, recorded responses, manifests, job snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import checks
from ..functions import scalars as s
from ..functions import text as t

BINARY = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Files with content; columns that are not used, content above all, are not read."""
    r = spark.read.format("binaryFile")
    return (r.option("pathGlobFilter", glob) if glob else r).load(path)


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time only."""
    return files(spark, path).select("path", "length", "modificationTime")


def exists(wanted: DataFrame, heads: DataFrame) -> DataFrame:
    """Rows of ``wanted`` whose path is there."""
    return wanted.join(heads.select("path"), "path", "left_semi")


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole small files as text."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def json_records(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """One JSON value a file in a fixed schema; a malformed file raises, or leaves a NULL row if not strict."""
    return spark.read.schema(schema).json(path, multiLine=True, mode="FAILFAST" if strict else "PERMISSIVE")


def json_with_rejects(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of JSON lines; rejects keep the line."""
    raw = spark.read.text(path).select(F.from_json("value", f"{schema}, _corrupt STRING", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r"), "value")
    bad = F.col("r._corrupt").isNotNull() | F.col("r").isNull()
    return raw.where(~bad).select("r.*").drop("_corrupt"), raw.where(bad).select(F.col("value").alias("raw"))


def uploads(spark: SparkSession, root: str) -> DataFrame:
    """Uploaded files with job id, hash, size and file mark; the hash is taken in the scan's own stage."""
    f = files(spark, f"{root}/uploads/*/original.pdf")
    return f.select(checks.job_id_of("path").alias("job"), "path", "length", F.sha2("content", 256).alias("sha256"), checks.looks_like_pdf("content").alias("is_pdf")).where("job IS NOT NULL")


def text_layers(jobs: DataFrame, layers: DataFrame) -> DataFrame:
    """(job, text, has_text_layer): '' where the layer is not to be read or not there."""
    return jobs.select("job", "has_text_layer").join(layers.select("job", "text"), "job", "left").select("job", F.when(F.col("has_text_layer"), F.coalesce("text", F.lit(""))).otherwise("").alias("text"), "has_text_layer")


def feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of an Atom feed: id, title, published, categories, primary."""
    schema = ("id STRING, title STRING, published STRING, category ARRAY<STRUCT<_term: STRING, _VALUE: STRING>>, primary_category STRUCT<_term: STRING, _VALUE: STRING>")
    x = spark.read.format("xml").option("rowTag", "entry").option("ignoreNamespace", "true").schema(schema).load(path)
    return x.select("id", "title", "published", F.transform("category", lambda c: c.getField("_term")).alias("categories"), F.col("primary_category._term").alias("primary"))


def licence_of(xml) -> F.Column:
    """The licence element of a metadata record in XML."""
    return F.nullif(t.trim_space(F.xpath_string(F.col(xml) if isinstance(xml, str) else xml, F.lit("//*[local-name()='license']"))), F.lit(""))


def responses(spark: SparkSession, path: str) -> DataFrame:
    """Recorded HTTP responses (url, status, body, text)."""
    raw = spark.read.text(path, wholetext=True).select(F.try_parse_json("value").alias("v"))
    get = lambda p, kind: F.try_variant_get("v", p, kind)
    body = F.try_variant_get("v", "$.body", "variant")
    return raw.select(get("$.url", "string").alias("url"), get("$.status", "int").alias("status"), F.when(body.isNotNull(), F.to_json(body)).alias("body"), get("$.text", "string").alias("text"))


def replay(requests: DataFrame, recorded: DataFrame, key: str = "url") -> DataFrame:
    """Requests with their recorded response; missing ones have NULLs."""
    return requests.join(recorded.dropDuplicates([key]), key, "left")


def paged(results: DataFrame, job: str = "job", seq: str = "seq", token: str = "next_token") -> DataFrame:
    """Problems of paged results: (job, problem) where a page but the last has no token, the last has one, or a token repeats."""
    from pyspark.sql import Window as W

    # All in one pass over the rows as they are dealt out by job; a token repeats where it stands for the second time.
    has = F.coalesce(F.col(token), F.lit("")) != ""
    more = F.lead(seq).over(W.partitionBy(job).orderBy(seq)).isNotNull()
    again = F.row_number().over(W.partitionBy(job, token).orderBy(seq)) == 2
    r = results.withColumns({"_has": has, "_more": more}).withColumn("_again", again)
    found = [F.when(F.col("_again") & F.col("_has"), "repeated_token"), F.when(F.col("_more") != F.col("_has"), F.when(F.col("_has"), "token_on_last").otherwise("token_missing"))]
    if "status" in results.columns:
        found.append(F.when((F.col(seq) == 1) & (F.coalesce("status", F.lit("")) == ""), "status_missing"))
    return r.select(F.col(job).alias("job"), F.explode(F.array_compact(F.array(*found))).alias("problem"))


def whole_answers(results: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages, problems) of paged results (job, seq, next_token, status): all pages of the jobs whose chain of tokens
    holds and whose first page succeeded; the status of later pages does not count. Every other job has a problem."""
    chain = paged(results)
    failed = results.where((F.col("seq") == 1) & ~checks.succeeded("status") & (F.coalesce("status", F.lit("")) != "")).select(F.col("job"), F.lit("not_succeeded").alias("problem"))
    problems = chain.union(failed).distinct()
    return results.join(problems.select("job"), "job", "left_anti"), problems


def replay_pages(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Requests (job, token) with the recorded page (job, seq, next_token, ...) that follows the token; no token asks
    for the first page, and an unknown one leaves NULLs."""
    from pyspark.sql import Window as W

    asked = F.coalesce(F.lag("next_token").over(W.partitionBy("job").orderBy("seq")), F.lit(""))
    pages = recorded.withColumn("token", asked).dropDuplicates(["job", "token"])
    return requests.withColumn("token", F.coalesce("token", F.lit(""))).join(pages, ["job", "token"], "left")


def replay_answers(requests: DataFrame, recorded: DataFrame) -> DataFrame:
    """Requests (paper, route) with the recorded answer of their key; missing ones have NULLs."""
    return replay(requests.withColumn("record", F.concat_ws("-", "paper", "route")), recorded, "record")


def manifest(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A manifest's rows, or none where it does not exist yet."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return spark.read.schema(schema).json(path) if fs.exists(jpath) else spark.createDataFrame([], schema)


def notices(raw: DataFrame) -> DataFrame:
    """Completion messages (value) as rows; those without a job id are dropped."""
    return raw.select(s.completion_notice("value").alias("n")).where("n IS NOT NULL").select(F.col("n.JobId").alias("ocr_job"), F.col("n.Status").alias("status"), F.col("n.JobTag").alias("tag"), s.epoch_ms("n.Timestamp").alias("at"))


def current_notices(seen: DataFrame, callbacks: DataFrame) -> DataFrame:
    """Messages of the OCR job that a document waits for; those of superseded jobs fall out of the join."""
    return seen.join(callbacks, (seen.tag == callbacks.job) & (seen.ocr_job == callbacks.current_ocr_job)).select(callbacks.job, "ocr_job", "status", "at", "task_token")

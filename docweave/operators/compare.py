"""Both routes' documents side by side, and what becomes of the job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s

_RESULT = "struct<status:string,needs_review:boolean,missing_pages:int,error:string,cause:string>"


#: What of a document is compared.
PARTS = ("title", "author_names", "abstract", "headings", "sizes")


def parts(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns of PARTS."""
    sizes = F.struct(*[F.size(c).alias(c) for c in ("sections", "figures", "tables", "references")])
    return docs.withColumns({"title": F.col("metadata.title"), "author_names": F.transform("metadata.authors", lambda x: x.getField("name")), "abstract": F.col("metadata.abstract"), "headings": F.transform("sections", lambda x: x.getField("heading")), "sizes": sizes})


def difference(a: str, b: str) -> Column:
    """struct(title, authors, abstract, counts, headings): pairs of the parts of two documents."""
    at = lambda d, c: F.col(f"{d}.{c}")
    counts = F.struct(*[s.count_pair(at(a, f"sizes.{c}"), at(b, f"sizes.{c}")).alias(c) for c in ("sections", "figures", "tables", "references")])
    return F.struct(s.value_pair(f"{a}.title", f"{b}.title").alias("title"), s.list_pair(at(a, "author_names"), at(b, "author_names")).alias("authors"), s.value_pair(f"{a}.abstract", f"{b}.abstract").alias("abstract"), counts.alias("counts"), s.list_pair(at(a, "headings"), at(b, "headings")).alias("headings"))


def diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """(job_id, title, authors, abstract, counts, headings): pairs of both documents; only jobs with both."""
    j = parts(a).select("job_id", *PARTS).alias("a").join(parts(b).select("job_id", *PARTS).alias("b"), F.col("a.job_id") == F.col("b.job_id"))
    return j.select(F.col("a.job_id").alias("job_id"), difference("a", "b").alias("d")).select("job_id", "d.*")


def decision(a_status: Column, b_status: Column, a_review: Column, b_review: Column) -> Column:
    """(status, needs_review) of a job from its routes' statuses: succeeded, failed or skipped."""
    ok = lambda x: F.coalesce(x == "succeeded", F.lit(False))
    bad = lambda x: F.coalesce(x == "failed", F.lit(False))
    any_ok, any_bad = ok(a_status) | ok(b_status), bad(a_status) | bad(b_status)
    review = (any_ok & any_bad) | (ok(a_status) & F.coalesce(a_review, F.lit(False))) | (ok(b_status) & F.coalesce(b_review, F.lit(False)))
    status = F.when(~any_ok, "FAILED").when(review, "REVIEW_PENDING").otherwise("COMPLETED")
    return F.struct(status.alias("status"), (any_ok & review).alias("needs_review"))


def route_result(there: Column, review: Column, skipped: Column, missing: Column, error: Column, cause: Column) -> Column:
    """A route's result for one job: without a document it failed unless it was skipped; missing pages or a caught
    error need review."""
    there = F.coalesce(there, F.lit(False))
    status = F.when(skipped, "skipped").when(there, "succeeded").otherwise("failed")
    missing = F.when(there, F.greatest(missing, F.lit(0)).cast("int")).otherwise(0)
    again = there & (F.coalesce(review, F.lit(False)) | (missing > 0) | error.isNotNull())
    return F.struct(status.alias("status"), again.alias("needs_review"), missing.alias("missing_pages"), error.alias("error"), cause.alias("cause")).cast(_RESULT)


def sides(reports: DataFrame, *fields: str) -> DataFrame:
    """(job, a, b): the reports of both routes beside each other, from rows with job and route; one aggregation."""
    side = F.struct(*fields)
    return reports.groupBy("job").agg(F.max(F.when(F.col("route") == "textract", side)).alias("a"), F.max(F.when(F.col("route") == "bedrock", side)).alias("b"))


def comparison(jobs: DataFrame, reports: DataFrame) -> DataFrame:
    """One row a job (job, skipped, page_count, caught): status, needs_review, both results, and the diff where both
    succeeded. reports: verified documents of both routes with ``needs_review``, ``seen`` and the document's parts
    that are compared (PARTS); ``caught`` is the payload of a failure, or NULL."""
    j = jobs.join(sides(reports, "needs_review", "seen", *PARTS), "job", "left").withColumn("_c", s.parse_catch("caught"))
    none = F.lit(None).cast("string")
    a = route_result(F.col("a").isNotNull(), F.col("a.needs_review"), F.coalesce("skipped", F.lit(False)), F.lit(0), none, none)
    b = route_result(F.col("b").isNotNull(), F.col("b.needs_review"), F.lit(False), F.col("page_count") - F.coalesce("b.seen", F.lit(0)), F.col("_c.error"), F.col("_c.cause"))
    j = j.withColumns({"textract": a, "bedrock": b})
    j = j.withColumn("d", decision(F.col("textract.status"), F.col("bedrock.status"), F.col("textract.needs_review"), F.col("bedrock.needs_review")))
    both = (F.col("textract.status") == "succeeded") & (F.col("bedrock.status") == "succeeded")
    return j.select("job", "d.status", "d.needs_review", "textract", "bedrock", F.when(both, difference("a", "b")).alias("diff"))

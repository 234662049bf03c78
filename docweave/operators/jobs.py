"""The table of jobs: conditional inserts and updates as joins over a snapshot.

A change set is joined with the current snapshot by job and gives the next snapshot and what was refused.
Snapshots are written by the caller (see ``sinks``), so a retried change set meets the same state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import checks

COLUMNS = ["job", "status", "filename", "created_at", "updated_at", "error_reason"]


def register(jobs: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, conflicts): inserts (job, filename, at) whose job is new or FAILED; conflicts carry the old row."""
    asked = requests.groupBy("job").agg(F.min_by("filename", "at").alias("new_file"), F.min("at").alias("at")).withColumn("asked", F.lit(True))
    j = jobs.join(asked, "job", "full_outer")
    accepted = F.col("asked") & (F.col("status").isNull() | checks.reprocessable("status"))
    take = F.coalesce(accepted, F.lit(False))
    pick = lambda new, old: F.when(take, new).otherwise(F.col(old)).alias(old)
    snapshot = j.select("job", pick(F.lit("PROCESSING"), "status"), pick(F.col("new_file"), "filename"), pick(F.col("at"), "created_at"), pick(F.col("at"), "updated_at"), pick(F.lit(None).cast("string"), "error_reason"))
    conflicts = j.where(F.col("asked") & ~take).select(*COLUMNS, checks.conflict_decision("status").alias("decision"))
    return snapshot, conflicts


def update_status(jobs: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, refused): sets (job, status, at) of existing jobs and clears their error; FAILED needs ``mark_failed``."""
    good = changes.where(checks.valid_status("status") & (F.col("status") != "FAILED"))
    last = good.groupBy("job").agg(F.max_by("status", "at").alias("to"), F.max("at").alias("at"))
    j = jobs.join(last, "job", "left")
    has = F.col("to").isNotNull()
    snapshot = j.select("job", F.coalesce("to", "status").alias("status"), "filename", "created_at", F.coalesce("at", "updated_at").alias("updated_at"), F.when(~has, F.col("error_reason")).alias("error_reason"))
    wrong = changes.where(~checks.valid_status("status") | (F.col("status") == "FAILED")).select("job", F.lit("invalid_status").alias("problem"))
    unknown = good.join(jobs.select("job"), "job", "left_anti").select("job", F.lit("not_found").alias("problem"))
    return snapshot, wrong.union(unknown)


def mark_failed(jobs: DataFrame, failures: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(next snapshot, refused): fails (job, reason, at) of existing jobs; a reason is needed."""
    good = failures.where(F.coalesce("reason", F.lit("")) != "")
    last = good.groupBy("job").agg(F.max_by("reason", "at").alias("reason"), F.max("at").alias("at"))
    j = jobs.join(last, "job", "left")
    has = F.col("reason").isNotNull()
    snapshot = j.select("job", F.when(has, "FAILED").otherwise(F.col("status")).alias("status"), "filename", "created_at", F.coalesce("at", "updated_at").alias("updated_at"), F.coalesce("reason", "error_reason").alias("error_reason"))
    wrong = failures.where(F.coalesce("reason", F.lit("")) == "").select("job", F.lit("reason_missing").alias("problem"))
    unknown = good.join(jobs.select("job"), "job", "left_anti").select("job", F.lit("not_found").alias("problem"))
    return snapshot, wrong.union(unknown)


def list_by_status(jobs: DataFrame, status: str, limit: int | None = None) -> DataFrame:
    """Jobs of a status, last updated first."""
    out = jobs.where(F.col("status") == status).orderBy(F.desc("updated_at"), "job")
    return out.limit(limit) if limit else out


def get_job(jobs: DataFrame, job: str) -> DataFrame:
    return jobs.where(F.col("job") == job)


def latest(changes: DataFrame, key: str, order: list) -> DataFrame:
    """The last row of each key."""
    return changes.withColumn("_k", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_k = 1").drop("_k")


def encoded(jobs: DataFrame) -> DataFrame:
    """Rows for the wire; an empty id or unknown status raises."""
    from ..functions.scalars import wire_time

    ok = (F.coalesce("job", F.lit("")) != "") & checks.valid_status("status")
    return jobs.select(F.when(ok, F.col("job")).otherwise(F.raise_error(F.lit("job row without id or with unknown status"))).alias("job"), "status", "filename", wire_time("created_at").alias("created_at"), wire_time("updated_at").alias("updated_at"), F.nullif("error_reason", F.lit("")).alias("error_reason"))


def decoded(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(jobs, rejects) of wire rows; rows without id, status or readable times are rejected."""
    from ..functions.scalars import parse_wire_time

    r = rows.withColumns({"_c": parse_wire_time("created_at"), "_u": parse_wire_time("updated_at")})
    good = (F.coalesce("job", F.lit("")) != "") & checks.valid_status("status") & F.col("_c").isNotNull() & F.col("_u").isNotNull()
    jobs = r.where(good).select("job", "status", "filename", F.col("_c").alias("created_at"), F.col("_u").alias("updated_at"), F.nullif("error_reason", F.lit("")).alias("error_reason"))
    return jobs, r.where(~good).drop("_c", "_u")


def respond(answers: DataFrame, waiting: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answers that resume their task, late ones) of answers (token, error) by the tokens that still wait. A token that
    timed out, was answered or never was is gone alike: its answer is late, is reported and does no harm."""
    known = waiting.select("token").distinct().withColumn("_waits", F.lit(True))
    a = answers.join(known, "token", "left")
    resumed = a.where("_waits").withColumn("outcome", F.when(F.col("error").isNull(), "resumed").otherwise("failed")).drop("_waits")
    return resumed, a.where("_waits IS NULL").withColumn("outcome", F.lit("gone")).drop("_waits")


def executions(runs: DataFrame, part: str | None = None, last: int = 5, within: int = 20) -> DataFrame:
    """The last executions (name, input, started), or among the last ``within`` those whose input holds ``part``."""
    recent = runs.orderBy(F.desc("started"), "name").limit(within if part else last)
    return recent.where(F.col("input").contains(part)) if part else recent

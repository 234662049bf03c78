"""A corpus of papers: search, selection, enrichment, manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import checks
from ..functions import text as t
from ..workers import written


def entry_rows(feed: DataFrame) -> DataFrame:
    """Feed entries (id, title, published, categories, primary) as rows; entries without a valid id are dropped."""
    tail = F.regexp_extract("id", r"([^/]+)$", 1)
    e = feed.withColumn("_i", t.paper_id(tail)).where("_i IS NOT NULL")
    return e.select(F.col("_i.id").alias("arxiv_id"), F.col("_i.version").alias("version"), t.fields_joined("title").alias("title"), F.filter("categories", lambda c: F.coalesce(c, F.lit("")) != "").alias("categories"), "primary", F.try_to_timestamp("published").alias("published"))


def search(entries: DataFrame, limit: int) -> DataFrame:
    """Newest first."""
    return entries.orderBy(F.desc("published"), "arxiv_id").limit(limit)


def lookup(entries: DataFrame, ids: list[str]) -> DataFrame:
    if not ids:
        raise ValueError("no ids")
    return entries.where(F.col("arxiv_id").isin(ids))


def unknown(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries whose id is not in the manifest, whatever their version."""
    return entries.join(manifest.select("arxiv_id"), "arxiv_id", "left_anti")


def select_papers(entries: DataFrame, manifest: DataFrame, lo: int = 0, hi: int = 0, want: int = 0) -> DataFrame:
    """New entries with pages in range, newest first, the first ``want`` that are accepted (0: all)."""
    ok = unknown(entries, manifest).where(checks.in_range("pages", F.lit(lo), F.lit(hi))).orderBy(F.desc("published"), "arxiv_id")
    return ok.limit(want) if want else ok


def enriched(papers: DataFrame) -> DataFrame:
    """Adds references, license_kind, has_source and sha256 from text, license, content_type and content."""
    return papers.withColumns({"references": t.count_references("text"), "license_kind": checks.licence_kind("license"), "has_source": checks.has_source("content_type"), "sha256": F.sha2("content", 256)})


def with_positions(keys: DataFrame, key: str, first: int = 0, out: str = "ord") -> DataFrame:
    """(key, out): each key's position in the order of all keys, from ``first`` on, without one task that sees all.

    Keys are dealt out by ranges and written once; the ranges' sizes, one number a partition, are summed in the driver
    into where each range begins; within a range keys are numbered by themselves.
    """
    spark = keys.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = written(keys.select(key).repartitionByRange(parts, key).withColumn("_part", F.spark_partition_id()))
    starts, at = [], first
    for r in sorted(dealt.groupBy("_part").count().collect()):
        starts.append((r["_part"], at))
        at += r["count"]
    begin = spark.createDataFrame(starts, "_part int, _start long")  # a row a partition
    inside = F.row_number().over(W.partitionBy("_part").orderBy(key)) - 1
    return dealt.withColumn("_at", inside).join(F.broadcast(begin), "_part").select(key, (F.col("_start") + F.col("_at")).cast("int").alias(out))


def upsert(manifest: DataFrame, papers: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """The manifest (with ord) with papers replaced in place by key, new ones appended in order of key."""
    fresh = papers.dropDuplicates([key])
    kept = manifest.join(fresh.select(key), key, "left_anti")
    replaced = fresh.join(manifest.select(key, "ord"), key)
    new = written(fresh.join(manifest.select(key), key, "left_anti"))
    last = manifest.agg(F.max("ord")).first()[0]
    at = with_positions(new, key, 0 if last is None else last + 1)
    return kept.unionByName(replaced.select(*manifest.columns)).unionByName(new.join(at, key).select(*manifest.columns))


def run(entries: DataFrame, details: DataFrame, manifest: DataFrame, lo: int = 0, hi: int = 0, want: int = 0) -> DataFrame:
    """The manifest after one run: entries that it does not know and whose pages are in range, the newest ``want`` (0: all),
    enriched from their details (arxiv_id, pages, text, license, content_type, content) and put in."""
    found = entries.join(details, "arxiv_id")
    picked = written(enriched(select_papers(found, manifest, lo, hi, want)))
    return upsert(manifest, picked)

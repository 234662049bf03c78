"""The flagship plan: both routes' extractions to verified documents, a comparison and the jobs' next states."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import compare, merge, normalize, verify
from ..schemas import CONFIDENCE, COST, METADATA, PROVENANCE, REFERENCE, SECTION, SOURCE, FIGURE, TABLE


def page_documents(pages: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Page results as documents of the page route, with ``seen``, how many page numbers had a result."""
    m = merge.merge_pages(pages, counts)
    none = lambda kind: F.lit(None).cast(kind.lower() if isinstance(kind, str) else kind)
    meta = F.struct(F.col("title"), F.col("authors"), F.col("abstract"), F.col("keywords"), F.lit("").alias("venue"), F.lit(0).alias("year"), F.lit("").alias("primary_category")).cast(METADATA)
    cost = F.struct(F.lit(0).alias("textract_pages"), F.array().cast("array<string>").alias("textract_features"), F.coalesce("model", F.lit("")).alias("bedrock_model"), F.col("input_tokens").cast("int").alias("input_tokens"), F.col("output_tokens").cast("int").alias("output_tokens")).cast(COST)
    warn = F.transform(F.coalesce("warnings", F.array().cast("array<struct<code:string,page:int>>")), lambda w: F.concat_ws(" ", w.getField("code"), w.getField("page").cast("string")))
    prov = F.struct(F.lit("bedrock").alias("route"), F.col("extracted_at").cast("timestamp"), none(CONFIDENCE).alias("confidence"), cost.alias("cost"), F.col("duration_ms").cast("bigint"), warn.alias("warnings")).cast(PROVENANCE)
    secs = F.transform("sections", lambda x: F.struct(x.getField("level").alias("level"), x.getField("heading").alias("heading"), x.getField("text").alias("text"), x.getField("pages").alias("pages")))
    figs = F.transform("figures", lambda x: F.struct(x.getField("id").alias("id"), x.getField("caption").alias("caption"), x.getField("page").alias("page"), F.lit(None).cast("array<double>").alias("bbox")))
    tabs = F.transform("tables", lambda x: F.struct(x.getField("id").alias("id"), x.getField("caption").alias("caption"), x.getField("page").alias("page"), F.lit(None).cast("array<double>").alias("bbox"), x.getField("header").alias("header"), x.getField("rows").alias("rows")))
    refs = F.transform("references", lambda x: F.struct(*[x.getField(c).alias(c) for c in ("raw", "title", "authors", "year", "venue", "doi")]))
    arr = lambda c, kind: F.coalesce(c.cast(f"array<{kind}>"), F.array().cast(f"array<{kind}>"))
    return m.select(
        F.col("job").alias("job_id"), F.lit("").alias("schema_version"), none(SOURCE).alias("source"), meta.alias("metadata"), arr(secs, SECTION).alias("sections"), arr(figs, FIGURE).alias("figures"), arr(tabs, TABLE).alias("tables"), arr(refs, REFERENCE).alias("references"), prov.alias("provenance"), "seen",
    )


def layout_documents(elements: DataFrame, outline: DataFrame) -> DataFrame:
    """Sections of the layout route: outline rows (job, idx, level, heading, from_ord, to_ord) point at elements.

    The range join carries the job as its equality, so it plans as a hash join with a residual condition.
    """
    body = elements.where(F.col("type").isin("LAYOUT_TEXT", "LAYOUT_LIST", "LINE") & F.col("table_id").isNull() & (F.col("text") != "")).select("job", "n", "page", "text")
    sizes = elements.groupBy("job").agg(F.count(F.lit(1)).alias("size"))
    o = outline.join(sizes, "job", "left")
    none = (F.col("from_ord") == -1) & (F.col("to_ord") == -1)
    bad = ~none & ((F.col("from_ord") < 0) | (F.col("to_ord") >= F.coalesce("size", F.lit(0))) | (F.col("from_ord") > F.col("to_ord")))
    o = o.withColumn("bad_range", bad)
    hits = o.where(~none & ~bad).alias("o").join(body.alias("b"), (F.col("o.job") == F.col("b.job")) & F.col("b.n").between(F.col("o.from_ord"), F.col("o.to_ord")))
    texts = hits.groupBy(F.col("o.job").alias("job"), "idx").agg(F.array_sort(F.collect_list(F.struct("b.n", "b.page", "b.text"))).alias("p"))
    out = o.join(texts, ["job", "idx"], "left")
    return out.select("job", "idx", "level", "heading", F.coalesce(F.array_join(F.transform("p", lambda x: x.getField("text")), "\n\n"), F.lit("")).alias("text"), F.coalesce(F.array_sort(F.array_distinct(F.col("p.page"))), F.array().cast("array<int>")).alias("pages"), "bad_range")


def outline_references(outline: DataFrame, elements: DataFrame) -> DataFrame:
    """References (job, idx, element, raw, ...) with raw text taken from the element they point at; bad pointers keep their own."""
    at = elements.select("job", F.col("n").alias("element"), F.col("text").alias("element_text"))
    out = outline.join(at, ["job", "element"], "left")
    return out.withColumn("bad_pointer", F.col("element").isNotNull() & F.col("element_text").isNull()).withColumn("raw", F.coalesce("element_text", F.trim("raw"))).drop("element_text")


def finalize(jobs: DataFrame, layout: DataFrame, pages: DataFrame, layers: DataFrame, works: DataFrame | None, as_of_year: int, unavailable: DataFrame | None = None, catches: DataFrame | None = None) -> dict[str, DataFrame]:
    """jobs: (job, skipped, page_count); layout: documents of the layout route; pages: page results; catches: (job,
    raw) payloads of failures, unless ``jobs`` carries them as ``caught``.

    Gives documents (normalised, of both routes), reports, and the comparison that decides each job's state.  All is
    keyed by the job: each input is dealt out by it once, and pages, documents, scores and sides meet in that dealing.
    """
    valid = jobs.where((F.coalesce("job", F.lit("")) != "") & (F.col("page_count") >= 1))
    if catches is not None:
        valid = valid.join(catches.select("job", F.col("raw").alias("caught")), "job", "left")
    elif "caught" not in jobs.columns:
        valid = valid.withColumn("caught", F.lit(None).cast("string"))
    made = page_documents(pages, valid.select("job", "page_count"))
    own = layout.withColumn("seen", F.lit(None).cast("int")).select(*made.columns)
    docs = compare.parts(normalize.normalize(own.unionByName(made), as_of_year, ("seen",)))
    reports = verify.verify(docs, layers, works, unavailable, keep=("seen", *compare.PARTS))
    return {"documents": docs.drop("seen", *compare.PARTS), "reports": reports.drop("seen", *compare.PARTS), "comparison": compare.comparison(valid, reports)}

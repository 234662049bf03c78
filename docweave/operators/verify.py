"""Documents verified against their text layer and registered works: scores, hallucinations, review flags.

A document meets its layer by one join on the job; its values are scored, averaged by field and judged inside that row,
so no value is ever shuffled.  Only references leave it, to be looked up, and come back as one row a document.
Evidence that is not there is left out of every mean rather than counted as zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import text as t
from ..schemas import CONFIDENCE_FIELDS
from ..workers import written
from . import references as refs
from . import scoring


def values_of() -> Column:
    """array of (field, ord, path, value, short, grp): every value of a document that has a counterpart in the text.

    ``grp`` is the table of a cell, whose cells count as one item; ``ord`` is the order of scanning.
    """
    row = lambda field, rank, i, path, value, short, grp=None: F.struct(
        F.lit(field).alias("field"), F.struct(F.lit(rank).alias("a"), i.cast("int").alias("b"), F.lit(0 if short else 1).alias("c")).alias("ord"), path.alias("path"), F.coalesce(value, F.lit("")).alias("value"), F.lit(short).alias("short"), (F.lit(None).cast("int") if grp is None else grp.cast("int")).alias("grp")
    )
    zero = F.lit(0)
    m = F.col("metadata")
    each = lambda col, fn: F.transform(F.col(col), fn)
    raw = lambda r, i: F.when(F.coalesce(r.getField("raw"), F.lit("")) != "", row("references", 6, i, s.item_path("references", i, "raw"), r.getField("raw"), True)).otherwise(row("references", 6, i, s.item_path("references", i, "title"), r.getField("title"), True))
    cells = F.flatten(F.transform(F.col("tables"), lambda x, i: F.transform(F.flatten(F.concat(x.getField("header"), x.getField("rows"))), lambda c: row("tables", 5, i, F.format_string("tables[%d].cells", i), c, False, i))))
    return F.concat(
        F.array(row("title", 0, zero, F.lit("metadata.title"), m.getField("title"), True)),
        F.transform(m.getField("authors"), lambda a, i: row("authors", 1, i, s.item_path("metadata.authors", i, "name"), a.getField("name"), True)),
        F.array(row("abstract", 2, zero, F.lit("metadata.abstract"), m.getField("abstract"), False)),
        each("sections", lambda x, i: row("sections", 3, i, s.item_path("sections", i, "heading"), x.getField("heading"), True)),
        each("sections", lambda x, i: row("sections", 3, i, s.item_path("sections", i, "text"), x.getField("text"), False)),
        each("figures", lambda x, i: row("figures", 4, i, s.item_path("figures", i, "caption"), x.getField("caption"), True)),
        each("tables", lambda x, i: row("tables", 5, i, s.item_path("tables", i, "caption"), x.getField("caption"), True)),
        cells,
        each("references", raw),
    )


def _mean(scores: Column) -> Column:
    """Mean of an array, NULL when it is empty."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(scores) > 0, total / F.size(scores))


def field_scores(scored: Column) -> Column:
    """map field -> (original, items): mean score of a field's items; the cells of a table are one item."""

    def one(field: str) -> Column:
        mine = F.filter(scored, lambda v: (v.getField("field") == field) & v.getField("score").isNotNull())
        score_of = lambda rows: F.transform(rows, lambda v: v.getField("score"))
        alone = score_of(F.filter(mine, lambda v: v.getField("grp").isNull()))
        if field != "tables":
            return alone
        groups = F.array_compact(F.array_distinct(F.transform(mine, lambda v: v.getField("grp"))))
        return F.concat(alone, F.transform(groups, lambda g: _mean(score_of(F.filter(mine, lambda v: v.getField("grp") == g)))))

    rows = F.array(*[F.struct(F.lit(f).alias("field"), one(f).alias("scores")) for f in CONFIDENCE_FIELDS])
    value = lambda x: F.struct(F.round(_mean(x.getField("scores")), 4).alias("original"), F.size(x.getField("scores")).cast("bigint").alias("items"))
    return F.map_from_entries(F.transform(F.filter(rows, lambda x: F.size(x.getField("scores")) > 0), lambda x: F.struct(x.getField("field"), value(x))))


def hallucinations(scored: Column, mismatches: Column) -> Column:
    """array of (path, value, score): short values hardly found, in scanning order, then DOIs of other works
    (mismatches: array of (i, doi, similarity))."""
    order = lambda v: F.struct(v.getField("ord").getField("a").alias("a"), v.getField("ord").getField("b").alias("b"), v.getField("path").alias("path"), v.getField("value").alias("value"), F.round(v.getField("score"), 4).alias("score"))
    found = F.array_sort(F.transform(F.filter(scored, lambda v: scoring.is_hallucination(v.getField("score"), v.getField("short"))), order))
    own = F.transform(found, lambda v: F.struct(v.getField("path").alias("path"), v.getField("value").alias("value"), v.getField("score").alias("score")))
    dois = F.transform(F.array_sort(mismatches), lambda m: F.struct(s.item_path("references", m.getField("i"), "doi").alias("path"), m.getField("doi").alias("value"), m.getField("similarity").alias("score")))
    return F.concat(own, dois)


def document_references(docs: DataFrame) -> DataFrame:
    """(job, i, title, raw, doi) of every reference; ``job`` is (job, route) where documents have a route."""
    return docs.select(F.struct(F.col("job_id").alias("job"), F.col("provenance.route").alias("route")).alias("job"), F.posexplode("references").alias("i", "r")).select("job", "i", "r.title", "r.raw", "r.doi")


def verify(docs: DataFrame, layers: DataFrame, works: DataFrame | None = None, unavailable: DataFrame | None = None, threshold: float = scoring.REVIEW_BELOW, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row a document: fields, hallucinations, reference summary, original_checked, needs_review, and ``keep``.

    docs may be of both routes; layers: (job, text, has_text_layer). A field's confidence is the mean of the signals
    there are: agreement with the text, the extractor's own confidence (layout route only), and for references
    the share verified.  With ``works`` the documents are written once, as their references are looked up apart.
    """
    if works is not None:
        docs = written(docs)
    # Texts are dealt out by job first, so that no tokens are shuffled.
    usable = layers.select("job", "text", "has_text_layer").repartition(F.col("job")).withColumn("_folded", t.fold("text")).where(F.col("has_text_layer") & (F.col("_folded") != ""))
    known = scoring.with_vocabulary(usable, "text", "_tokens", "_pairs").select("job", "_folded", "_tokens", "_pairs")
    d = docs.withColumnRenamed("job_id", "job").withColumn("_route", F.col("provenance.route")).join(known, "job", "left")
    summary = ("verified", "mismatch", "not_found", "unavailable", "skipped", "crossref")
    if works is None:
        nothing = {c: F.lit(0).cast("bigint") for c in summary[:4]} | {"skipped": F.size("references").cast("bigint"), "crossref": F.lit(None).cast("double")}
        d = d.withColumns(nothing | {"_wrong": F.array().cast("array<struct<i:int,doi:string,similarity:double>>")})
    else:
        checks = refs.check_references(document_references(docs), works, unavailable)
        told = refs.summarize(checks, F.collect_list(F.when(F.col("status") == "mismatch", F.struct("i", "doi", "similarity"))).alias("_wrong"))
        told = told.select(F.col("job.job").alias("job"), F.col("job.route").alias("_route"), *summary, "_wrong")
        d = d.join(told, ["job", "_route"], "left").withColumn("_wrong", F.coalesce("_wrong", F.array().cast("array<struct<i:int,doi:string,similarity:double>>")))
    d = d.withColumn("_values", scoring.tokenized_values(values_of()))
    d = d.withColumn("_scored", F.when(F.col("_folded").isNotNull(), scoring.scored_values(F.col("_values"), F.col("_folded"), F.col("_tokens"), F.col("_pairs"))).otherwise(F.array()))
    d = d.withColumns({"fields": F.when(F.col("_folded").isNotNull(), field_scores(F.col("_scored"))), "hallucinations": hallucinations(F.col("_scored"), F.col("_wrong"))})
    original = lambda f: F.try_element_at("fields", F.lit(f)).getField("original")
    layout = lambda f: F.when(F.col("_route") == "textract", F.col(f"provenance.confidence.{f}"))
    conf = {f: s.mean_of(original(f), layout(f), *([F.col("crossref")] if f == "references" else [])) for f in CONFIDENCE_FIELDS}
    d = d.withColumns({"confidence": F.struct(*[c.alias(f) for f, c in conf.items()]), "original_checked": F.col("_folded").isNotNull()})
    low = F.exists(F.array(*[F.col(f"confidence.{f}") for f in CONFIDENCE_FIELDS]), lambda c: F.coalesce(c < threshold, F.lit(False)))
    return d.select(
        "job", F.col("_route").alias("route"), "original_checked", "confidence", "fields", "hallucinations", *summary,
        (~F.col("original_checked") | (F.size("hallucinations") > 0) | low).alias("needs_review"), *keep,
    )

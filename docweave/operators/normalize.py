"""Documents brought to one form: collapsed texts, clamped levels, bare DOIs, plausible years, sorted sets.

One projection of nested transforms, so a document never leaves its row.  Applying it twice changes nothing.
Warnings are codes with arguments, prefixed by ``normalize:``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import text as t
from ..schemas import AUTHOR, FIGURE, REFERENCE, ROUTES, SCHEMA_VERSION, SECTION, TABLE

PREFIX = "normalize: "


def _text(c: Column) -> Column:
    return F.coalesce(t.collapse_space(c), F.lit(""))


def metadata(m: Column, as_of_year: int) -> Column:
    f = m.getField
    return F.struct(
        _text(f("title")).alias("title"),
        F.transform(F.coalesce(f("authors"), F.array().cast(f"array<{AUTHOR}>")), s.collapsed_author).alias("authors"),
        _text(f("abstract")).alias("abstract"),
        t.collapse_strings(f("keywords")).alias("keywords"),
        _text(f("venue")).alias("venue"),
        s.year(F.coalesce(f("year"), F.lit(0)), as_of_year).alias("year"),
        _text(f("primary_category")).alias("primary_category"),
    )


def sections(x: Column) -> Column:
    level = lambda r: F.coalesce(t.heading_level(_text(r.getField("heading")), r.getField("level")), F.lit(0)).cast("int")
    one = lambda r: F.struct(
        t.clamp_level(level(r)).alias("level"), _text(r.getField("heading")).alias("heading"), F.coalesce(t.normalize_text(r.getField("text")), F.lit("")).alias("text"), s.sorted_distinct(s.or_empty(r.getField("pages"), "array<int>")).alias("pages")
    )
    return F.transform(F.coalesce(x, F.array().cast(f"array<{SECTION}>")), one)


def figures(x: Column) -> Column:
    one = lambda r: F.struct(_text(r.getField("id")).alias("id"), _text(r.getField("caption")).alias("caption"), r.getField("page").alias("page"), r.getField("bbox").alias("bbox"))
    return F.transform(F.coalesce(x, F.array().cast(f"array<{FIGURE}>")), one)


def tables(x: Column) -> Column:
    cells = lambda r, c: t.trimmed_cells(s.or_empty(r.getField(c), "array<array<string>>")).alias(c)
    one = lambda r: F.struct(_text(r.getField("id")).alias("id"), _text(r.getField("caption")).alias("caption"), r.getField("page").alias("page"), r.getField("bbox").alias("bbox"), cells(r, "header"), cells(r, "rows"))
    return F.transform(F.coalesce(x, F.array().cast(f"array<{TABLE}>")), one)


def references(x: Column, as_of_year: int) -> Column:
    one = lambda r: F.struct(
        _text(r.getField("raw")).alias("raw"), F.coalesce(t.reference_title(r.getField("title")), F.lit("")).alias("title"), t.collapse_strings(r.getField("authors")).alias("authors"),
        s.year(F.coalesce(r.getField("year"), F.lit(0)), as_of_year).alias("year"), _text(r.getField("venue")).alias("venue"), t.doi(r.getField("doi")).alias("doi"),
    )
    return F.transform(F.coalesce(x, F.array().cast(f"array<{REFERENCE}>")), one)


def warnings(as_of_year: int) -> Column:
    """What normalising a document changes or finds odd, in a fixed order."""
    say = lambda *parts: F.concat(F.lit(PREFIX), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    m, p = F.col("metadata"), F.col("provenance")
    when = lambda cond, *parts: F.array_compact(F.array(F.when(cond, say(*parts))))
    level = lambda r: F.coalesce(t.heading_level(_text(r.getField("heading")), r.getField("level")), F.lit(0))
    secs = F.array_compact(F.transform(F.coalesce(F.col("sections"), F.array().cast(f"array<{SECTION}>")), lambda r, i: F.when(t.clamp_level(level(r)) != level(r), say("level_clamped sections[", i, "] ", level(r)))))
    refs = F.coalesce(F.col("references"), F.array().cast(f"array<{REFERENCE}>"))
    years = F.array_compact(F.transform(refs, lambda r, i: F.when(s.year_out_of_range(r.getField("year"), as_of_year), say("year_out_of_range references[", i, "] ", r.getField("year")))))
    dois = F.array_compact(F.transform(refs, lambda r, i: F.when(t.doi_malformed(r.getField("doi")), say("doi_malformed references[", i, "] ", r.getField("doi")))))
    return F.concat(
        when(s.year_out_of_range(m.getField("year"), as_of_year), "year_out_of_range metadata ", m.getField("year")),
        secs, years, dois,
        when(F.coalesce(F.col("job_id"), F.lit("")) == "", "job_id_empty"),
        when(~F.coalesce(p.getField("route").isin(*ROUTES), F.lit(False)), "route_unknown ", F.coalesce(p.getField("route"), F.lit(""))),
        when(p.getField("extracted_at").isNull(), "extracted_at_missing"),
        when(F.coalesce(p.getField("duration_ms") < 0, F.lit(False)), "duration_negative ", p.getField("duration_ms")),
    )


def provenance(p: Column, found: Column) -> Column:
    cost = p.getField("cost").withField("textract_features", s.sorted_distinct(p.getField("cost").getField("textract_features")))
    return p.withField("cost", cost).withField("warnings", F.array_distinct(F.concat(s.or_empty(p.getField("warnings")), found)))


def normalize(docs: DataFrame, as_of_year: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """Documents in one form, and the columns ``keep``; ``as_of_year`` is the clock, never read from the machine."""
    return docs.select(
        "job_id",
        F.coalesce(F.nullif("schema_version", F.lit("")), F.lit(SCHEMA_VERSION)).alias("schema_version"),
        "source",
        metadata(F.col("metadata"), as_of_year).alias("metadata"),
        sections(F.col("sections")).alias("sections"),
        figures(F.col("figures")).alias("figures"),
        tables(F.col("tables")).alias("tables"),
        references(F.col("references"), as_of_year).alias("references"),
        provenance(F.col("provenance"), warnings(as_of_year)).alias("provenance"),
        *keep,
    )

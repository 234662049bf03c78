"""Page results merged into one document: first arrivals, islands of continued sections and references.

Each part stands alone as rows (windows and groups over many jobs' pages); ``merge_pages`` makes the whole document with
one exchange: a job's page results are collected once, and everything else happens inside that row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as t
from ..schemas import AUTHOR


def first_arrivals(pages: DataFrame, key: str = "job", page: str = "page", arrival: str = "arrival") -> DataFrame:
    """One row a page, the one that arrived first; pages below 1 are dropped."""
    w = W.partitionBy(key, page).orderBy(arrival)
    return pages.where(F.col(page) >= 1).withColumn("_k", F.row_number().over(w)).where("_k = 1").drop("_k")


def page_warnings(pages: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(job, code, page): invalid, repeated and missing pages. expected: (job, page_count)."""
    bad = pages.where("page < 1").select("job", F.lit("invalid_page").alias("code"), "page")
    again = pages.where("page >= 1").groupBy("job", "page").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("job", F.lit("repeated_page").alias("code"), F.explode(F.array_repeat("page", F.col("n").cast("int") - 1)).alias("page"))
    return bad.union(again).union(missing_pages(pages, expected).select("job", F.lit("missing_page").alias("code"), "page"))


def missing_pages(pages: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(job, page) of pages 1..N without a result; N is the expected count, else the last page seen."""
    seen = pages.where("page >= 1").groupBy("job").agg(F.collect_set("page").alias("have"), F.max("page").alias("last"))
    jobs = seen if expected is None else expected.select("job", F.col("page_count").alias("want")).join(seen, "job", "full_outer")
    n = F.col("last") if expected is None else F.when(F.col("want") > 0, F.col("want")).otherwise(F.col("last"))
    have = F.coalesce("have", F.array().cast("array<int>"))
    return jobs.where(n >= 1).select("job", F.explode(F.array_except(F.sequence(F.lit(1), n), have)).alias("page"))


def gap_filled(pages: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows 1..page_count of every job, with NULLs where a page has no result."""
    slots = counts.where("page_count >= 1").select("job", F.explode(F.sequence(F.lit(1), "page_count")).alias("page"))
    return slots.join(pages, ["job", "page"], "left")


def starts_section(heading: Column, idx: Column, cont: Column) -> Column:
    return (heading != "") | ((idx == 0) & ~F.coalesce(cont, F.lit(True)))


def continues_reference(idx: Column, cont: Column) -> Column:
    return (idx == 0) & F.coalesce(cont, F.lit(False))


def section_islands(rows: DataFrame, key: str = "job") -> DataFrame:
    """Adds island to rows (key, page, idx, heading, cont): a heading starts one; without a heading a row joins
    the island before, unless it is the first of a page that says it does not continue."""
    starts = starts_section(F.col("heading"), F.col("idx"), F.col("cont"))
    w = W.partitionBy(key).orderBy("page", "idx")
    first = F.row_number().over(w) == 1
    return rows.withColumn("_s", (starts | first).cast("int")).withColumn("island", F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_s")


def reference_islands(rows: DataFrame, key: str = "job") -> DataFrame:
    """Adds island to rows (key, page, idx, cont): only a page's first reference can continue, if it says so."""
    joins = continues_reference(F.col("idx"), F.col("cont"))
    w = W.partitionBy(key).orderBy("page", "idx")
    first = F.row_number().over(w) == 1
    return rows.withColumn("_s", (~joins | first).cast("int")).withColumn("island", F.sum("_s").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_s")


def merged_sections(pages: DataFrame) -> DataFrame:
    """(job, island, level, heading, text, pages) of page results with sections and cont_section."""
    rows = pages.select("job", "page", F.col("cont_section").alias("cont"), F.posexplode("sections").alias("idx", "s")).select("job", "page", "idx", "cont", F.col("s.level").alias("level"), F.coalesce(t.trim_space("s.heading"), F.lit("")).alias("heading"), F.coalesce(t.trim_space("s.text"), F.lit("")).alias("text"))
    parts = section_islands(rows).groupBy("job", "island").agg(F.array_sort(F.collect_list(F.struct("page", "idx", "level", "heading", "text"))).alias("p"))
    return parts.select("job", "island", F.col("p")[0].level.alias("level"), F.col("p")[0].heading.alias("heading"), t.join_fragments(F.col("p.text")).alias("text"), F.array_distinct("p.page").alias("pages"))


def merged_references(pages: DataFrame) -> DataFrame:
    """(job, island, raw, title, authors, year, venue, doi): fragments joined, missing fields from later ones."""
    rows = pages.select("job", "page", F.col("cont_reference").alias("cont"), F.posexplode("references").alias("idx", "r"))
    clean = lambda f: F.nullif(t.trim_space(F.col(f"r.{f}")), F.lit(""))
    rows = reference_islands(rows.select("job", "page", "idx", "cont", F.coalesce(t.trim_space("r.raw"), F.lit("")).alias("raw"), clean("title").alias("title"), F.when(F.size("r.authors") > 0, F.col("r.authors")).alias("authors"), F.nullif(F.col("r.year"), F.lit(0)).alias("year"), clean("venue").alias("venue"), clean("doi").alias("doi")))
    order = F.struct("page", "idx")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    parts = rows.groupBy("job", "island").agg(F.array_sort(F.collect_list(F.struct("page", "idx", "raw"))).alias("p"), *[first(c) for c in ("title", "authors", "year", "venue", "doi")])
    return parts.select("job", "island", t.join_fragments(F.col("p.raw")).alias("raw"), F.coalesce("title", F.lit("")).alias("title"), "authors", F.coalesce("year", F.lit(0)).alias("year"), F.coalesce("venue", F.lit("")).alias("venue"), "doi")


def merged_metadata(pages: DataFrame, key: str = "job", page: str = "page") -> DataFrame:
    """First title, abstract, authors and keywords that are not empty, in page order."""
    text = lambda c: F.min_by(t.trim_space(c), F.when(t.trim_space(c) != "", F.col(page)))
    items = lambda c: F.min_by(c, F.when(F.size(c) > 0, F.col(page)))
    return pages.groupBy(key).agg(F.coalesce(text("title"), F.lit("")).alias("title"), F.coalesce(text("abstract"), F.lit("")).alias("abstract"), items("authors").alias("authors"), items("keywords").alias("keywords"))


def merged_items(pages: DataFrame, column: str) -> DataFrame:
    """Figures or tables of all pages in page order, stamped with their page: (job, idx, id, caption, page, ...)."""
    more = [c for c in ("header", "rows") if column == "tables"]
    rows = pages.select("job", "page", F.posexplode(column).alias("pos", "x"))
    w = W.partitionBy("job").orderBy("page", "pos")
    return rows.select("job", (F.row_number().over(w) - 1).alias("idx"), t.trim_space("x.label").alias("id"), t.trim_space("x.caption").alias("caption"), "page", *[F.coalesce(F.col(f"x.{c}"), F.array().cast("array<array<string>>")).alias(c) for c in more])


def route_cost(pages: DataFrame, key: str = "job", page: str = "page") -> DataFrame:
    """Sums of tokens and the first model named."""
    return pages.groupBy(key).agg(F.min_by("model", F.when(F.col("model") != "", F.col(page))).alias("model"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"))


def route_timing(pages: DataFrame, key: str = "job", end: str = "extracted_at", duration_ms: str = "duration_ms") -> DataFrame:
    """(key, extracted_at, duration_ms): the last end, and milliseconds from the earliest start; rows without an end do not count."""
    start = F.col(end) - F.make_dt_interval(secs=(F.col(duration_ms) / 1000).cast("decimal(18,6)"))
    times = pages.groupBy(key).agg(F.max(end).alias("extracted_at"), F.min(F.when(F.col(end).isNotNull(), start)).alias("_s"))
    return times.select(key, "extracted_at", F.coalesce(F.timestamp_diff("MILLISECOND", F.col("_s"), F.col("extracted_at")), F.lit(0)).alias("duration_ms"))


def outlines(pages: DataFrame) -> DataFrame:
    """Page results (PAGE_RESULTS) with the levels and headings of their sections, and as many figures, tables and
    references without content: they merge into the same documents, without the texts that :mod:`compare` leaves out."""
    def empty(c: str) -> Column:
        kind = pages.schema[c].dataType.elementType
        return F.transform(c, lambda x: F.lit(None).cast(kind))

    return pages.withColumns({"sections": F.transform("sections", lambda x: x.withField("text", F.lit(None).cast("string"))), **{c: empty(c) for c in ("figures", "tables", "references")}})


def _islands(rows: str, starts) -> Column:
    """The runs of a row's array: each begins with the first item or one that ``starts``."""
    at = F.filter(F.transform(F.col(rows), lambda r, i: F.when((i == 0) | starts(r), i)), lambda i: i.isNotNull())
    upto = lambda at, k: F.coalesce(F.get(at, k + 1), F.size(rows))
    cut = lambda at: F.transform(at, lambda i, k: F.slice(F.col(rows), i + 1, upto(at, k) - i))
    return F.element_at(F.transform(F.array(at), cut), 1)


def _first(values: Column, there=lambda v: v.isNotNull()) -> Column:
    return F.get(F.filter(values, there), F.lit(0))


def _total(values: Column) -> Column:
    """Sum of the values there are, NULL without any."""
    return F.aggregate(values, F.lit(None).cast("bigint"), lambda a, v: F.when(v.isNull(), a).otherwise(F.coalesce(a, F.lit(0).cast("bigint")) + v))


def merge_pages(pages: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """One row a job with all parts of the merged document, and ``seen``, how many page numbers had a result.

    pages: rows of PAGE_RESULTS; expected: (job, page_count). Jobs without a page of 1 or more have no document.
    """
    rest = [c for c in pages.columns if c not in ("job", "page", "arrival")]
    d = pages.groupBy("job").agg(F.array_sort(F.collect_list(F.struct("page", "arrival", *rest))).alias("all"))
    if expected is not None:
        d = d.join(expected.select("job", F.col("page_count").cast("int").alias("want")), "job", "left")
    else:
        d = d.withColumn("want", F.lit(None).cast("int"))
    same = lambda x, i: F.coalesce(F.get(F.col("all"), i - 1).getField("page") == x.getField("page"), F.lit(False)) & (i > 0)
    d = d.withColumns({
        "one": F.filter("all", lambda x, i: (x.getField("page") >= 1) & ~same(x, i)),
        "again": F.filter("all", lambda x, i: (x.getField("page") >= 1) & same(x, i)),
        "bad": F.filter("all", lambda x: x.getField("page") < 1),
        "seen": F.size(F.array_distinct(F.filter(F.transform("all", lambda x: x.getField("page")), lambda p: p.isNotNull()))),
    }).where(F.size("one") > 0).drop("all")
    each = lambda fn: F.transform("one", fn)
    trimmed = lambda r, f: F.coalesce(t.trim_space(r.getField(f)), F.lit(""))
    clean = lambda r, f: F.nullif(t.trim_space(r.getField(f)), F.lit(""))
    list_of = lambda x, f: F.coalesce(x.getField(f), F.array())
    section = lambda x: F.transform(list_of(x, "sections"), lambda r, i: F.struct(x.getField("page").alias("page"), i.alias("idx"), x.getField("cont_section").alias("cont"), r.getField("level").alias("level"), trimmed(r, "heading").alias("heading"), trimmed(r, "text").alias("text")))
    reference = lambda x: F.transform(
        list_of(x, "references"),
        lambda r, i: F.struct(i.alias("idx"), x.getField("cont_reference").alias("cont"), trimmed(r, "raw").alias("raw"), clean(r, "title").alias("title"), F.when(F.size(r.getField("authors")) > 0, r.getField("authors")).alias("authors"), F.nullif(r.getField("year"), F.lit(0)).alias("year"), clean(r, "venue").alias("venue"), clean(r, "doi").alias("doi")),
    )
    grid = lambda r, f: F.coalesce(r.getField(f), F.array().cast("array<array<string>>")).alias(f)
    item = lambda r, x, *more: F.struct(t.trim_space(r.getField("label")).alias("id"), t.trim_space(r.getField("caption")).alias("caption"), x.getField("page").alias("page"), *[grid(r, f) for f in more])
    items = lambda f, *more: F.flatten(each(lambda x: F.transform(list_of(x, f), lambda r: item(r, x, *more))))
    start = lambda x: F.when(x.getField("extracted_at").isNotNull(), x.getField("extracted_at") - F.make_dt_interval(secs=(x.getField("duration_ms") / 1000).cast("decimal(18,6)")))
    d = d.withColumns({
        "section_rows": F.flatten(each(section)), "reference_rows": F.flatten(each(reference)),
        "extracted_at": F.array_max(each(lambda x: x.getField("extracted_at"))), "started": F.array_min(each(start)),
        "pages_there": each(lambda x: x.getField("page")),
    })
    d = d.withColumns({
        "section_runs": _islands("section_rows", lambda r: starts_section(r.getField("heading"), r.getField("idx"), r.getField("cont"))),
        "reference_runs": _islands("reference_rows", lambda r: ~continues_reference(r.getField("idx"), r.getField("cont"))),
        "upto": F.when(F.col("want") > 0, F.col("want")).otherwise(F.array_max("pages_there")),
    })
    part = lambda run, f: F.transform(run, lambda r: r.getField(f))
    whole_section = lambda run: F.struct(F.get(run, F.lit(0)).getField("level").alias("level"), F.get(run, F.lit(0)).getField("heading").alias("heading"), t.join_fragments(part(run, "text")).alias("text"), F.array_distinct(part(run, "page")).alias("pages"))
    whole_reference = lambda run: F.struct(
        t.join_fragments(part(run, "raw")).alias("raw"), F.coalesce(_first(part(run, "title")), F.lit("")).alias("title"), _first(part(run, "authors")).alias("authors"), F.coalesce(_first(part(run, "year")), F.lit(0)).alias("year"), F.coalesce(_first(part(run, "venue")), F.lit("")).alias("venue"), _first(part(run, "doi")).alias("doi")
    )
    warn = lambda code, pages: F.transform(pages, lambda p: F.struct(F.lit(code).alias("code"), p.alias("page")))
    return d.select(
        "job",
        F.coalesce(_first(each(lambda x: clean(x, "title"))), F.lit("")).alias("title"), F.coalesce(_first(each(lambda x: clean(x, "abstract"))), F.lit("")).alias("abstract"),
        _first(each(lambda x: x.getField("authors")), lambda v: F.size(v) > 0).cast(f"array<{AUTHOR}>").alias("authors"), _first(each(lambda x: x.getField("keywords")), lambda v: F.size(v) > 0).alias("keywords"),
        _first(each(lambda x: x.getField("model")), lambda v: v != "").alias("model"), _total(each(lambda x: x.getField("input_tokens"))).alias("input_tokens"), _total(each(lambda x: x.getField("output_tokens"))).alias("output_tokens"),
        "extracted_at", F.coalesce(F.timestamp_diff("MILLISECOND", F.col("started"), F.col("extracted_at")), F.lit(0)).alias("duration_ms"),
        F.transform("section_runs", whole_section).alias("sections"), F.transform("reference_runs", whole_reference).alias("references"), items("figures").alias("figures"), items("tables", "header", "rows").alias("tables"),
        F.array_sort(F.concat(
            warn("invalid_page", part(F.col("bad"), "page")), warn("repeated_page", part(F.col("again"), "page")),
            warn("missing_page", F.when(F.col("upto") >= 1, F.array_except(F.sequence(F.lit(1), F.greatest("upto", F.lit(1))), "pages_there")).otherwise(F.array().cast("array<int>"))),
        )).alias("warnings"),
        "seen",
    )

"""The layout route: a graph of blocks read into one document a job.

Blocks are walked by kind of relationship - layout blocks to their lines, tables to cells, merged cells and titles, cells
to words - with one descent for all texts.  Elements get their reading order, tables take the elements that overlap
them most, captions come from neighbours; then each job's parts are collected into a row, where the outline that an
interpreter gave points at elements by number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import checks
from ..functions import scalars as s
from ..functions import text as t
from ..operators import grid, layout
from ..schemas import AUTHOR, CONFIDENCE, CONFIDENCE_FIELDS, COST, FIGURE, METADATA, PROVENANCE, REFERENCE, SECTION, SOURCE, TABLE
from ..workers import written

#: What an interpreter answers for a job: metadata, an outline of element ranges, and references that point at elements.
ANSWERS = (
    f"job STRING, title STRING, authors ARRAY<{AUTHOR}>, abstract STRING, keywords ARRAY<STRING>, venue STRING, year INT, "
    "sections ARRAY<STRUCT<level: INT, heading: STRING, from: INT, to: INT>>, "
    "references ARRAY<STRUCT<element: INT, raw: STRING, title: STRING, authors: ARRAY<STRING>, year: INT, venue: STRING, doi: STRING>>, "
    "model STRING, input_tokens INT, output_tokens INT"
)


@dataclass(frozen=True)
class Reading:
    """Blocks understood: elements (job, n, type, page, text, bbox, confidence, table_id), tables, figures, warnings
    (job, part, k, said), page counts."""

    elements: DataFrame
    tables: DataFrame
    figures: DataFrame
    warnings: DataFrame
    counts: DataFrame


def _table_blocks(blocks: DataFrame) -> DataFrame:
    place = F.row_number().over(W.partitionBy("job").orderBy("ord"))
    b = blocks.where("block_type = 'TABLE'").withColumn("table_ord", place - 1)
    return b.select("job", F.concat(F.lit("table-"), (F.col("table_ord") + 1).cast("string")).alias("table_id"), "table_ord", F.col("id").alias("block_id"), s.page_or_first("page").alias("page"), s.bbox("left", "top", "width", "height").alias("bbox"), s.confidence("confidence").alias("own_confidence"))


def _titles(blocks: DataFrame, edges: DataFrame, texts: DataFrame, tables: DataFrame) -> DataFrame:
    """(job, table_id, caption): a table's titles, else its footers."""
    parts = tables.join(edges.select("job", F.col("parent").alias("block_id"), F.col("child").alias("id"), "pos"), ["job", "block_id"])
    parts = parts.join(blocks.where("block_type IN ('TABLE_TITLE', 'TABLE_FOOTER')").select("job", "id", "block_type"), ["job", "id"]).join(texts, ["job", "id"]).where("full_text <> ''")
    of = lambda kind: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("block_type") == kind, F.struct("pos", "full_text")))), lambda x: x.getField("full_text")), " ")
    return parts.groupBy("job", "table_id").agg(of("TABLE_TITLE").alias("title"), of("TABLE_FOOTER").alias("footer")).select("job", "table_id", t.first_non_empty("title", "footer").alias("caption"))


def outline(blocks: DataFrame, edges: DataFrame, stated: DataFrame | None = None) -> Reading:
    """The same elements, tables and figures as :func:`read` gives, with empty texts, captions and cells, in the order of
    their blocks and without warnings: enough for what :mod:`compare` looks at, and nothing is written on the way."""
    shown = layout.element_blocks(blocks, edges)
    none, blank, grid_of = F.lit(None), F.lit(""), F.array().cast("array<array<string>>")
    e = shown.select("job", F.col("ord").alias("n"), F.col("block_type").alias("type"), "page", blank.alias("text"), none.cast("string").alias("table_id"), none.cast("double").alias("confidence"))
    figures = e.where("type = 'LAYOUT_FIGURE'").select("job", "n", blank.alias("id"), blank.alias("caption"), "page", none.cast("array<double>").alias("bbox"))
    tables = blocks.where("block_type = 'TABLE'").select("job", blank.alias("table_id"), F.col("ord").alias("table_ord"), s.page_or_first("page").alias("page"), none.cast("array<double>").alias("bbox"), blank.alias("caption"), grid_of.alias("header"), grid_of.alias("rows"), none.cast("double").alias("confidence"))
    warnings = blocks.where(F.lit(False)).select("job", F.lit(0).alias("part"), F.lit(0).alias("k"), blank.alias("said"))
    return Reading(e, tables, figures, warnings, layout.page_counts(blocks, stated))


def read(blocks: DataFrame, edges: DataFrame, stated: DataFrame | None = None) -> Reading:
    """Blocks (BLOCKS) and their relationships (BLOCK_EDGES) as elements, tables and figures. stated: (job, pages)."""
    shown = layout.element_blocks(blocks, edges)
    parts = blocks.where("block_type IN ('CELL', 'MERGED_CELL', 'TABLE_TITLE', 'TABLE_FOOTER')").select("job", "id")
    texts = written(layout.block_texts(blocks, edges, shown.select("job", "id").unionByName(parts)))
    tables = _table_blocks(blocks)
    e = written(layout.numbered(layout.reading_order(layout.with_texts(shown, texts))).withColumn("n", F.col("n").cast("int")))
    linked = layout.exclusive_overlaps(e, tables)
    near = e.join(linked, ["job", "n"], "left").withColumns({"table_caption": layout.caption_near(["table"]), "figure_caption": layout.caption_near(["figure", "fig."])})
    e = written(near.select("job", "n", "type", "page", "text", "bbox", "confidence", "reordered", "table_id", "table_caption", "figure_caption"))

    cells = grid.cells_of(blocks, edges, texts, tables)
    sure = cells.where(~F.col("merged") & (F.col("confidence") > 0)).groupBy("job", "table_id").agg(F.sum(s.confidence("confidence")).alias("total"), F.count(F.lit(1)).alias("cells"))
    d = tables.join(grid.restored_tables(cells), ["job", "table_id"], "left").join(sure, ["job", "table_id"], "left").join(_titles(blocks, edges, texts, tables), ["job", "table_id"], "left")
    d = d.join(e.where("table_id IS NOT NULL").select("job", "table_id", "table_caption"), ["job", "table_id"], "left")
    own = F.when(F.col("own_confidence") > 0, F.col("own_confidence"))
    known = F.coalesce("cells", F.lit(0)) + F.when(own.isNotNull(), 1).otherwise(0)
    none = F.array().cast("array<array<string>>")
    d = written(d.select(
        "job", "table_id", "table_ord", "page", "bbox", t.first_non_empty("caption", "table_caption").alias("caption"), F.coalesce("header", none).alias("header"), F.coalesce("body", none).alias("rows"),
        F.coalesce(F.try_divide(F.coalesce(own, F.lit(0.0)) + F.coalesce("total", F.lit(0.0)), known), F.lit(0.0)).alias("confidence"), F.col("header").isNull().alias("no_cells"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("inferred", "missing", "stray_headers")],
    ))
    figure = layout.sequence_ids(e.where("type = 'LAYOUT_FIGURE'"), "figure", "n")
    figures = figure.select("job", "n", "id", F.col("figure_caption").alias("caption"), "page", "bbox", "confidence")

    say = lambda df, part, k, *words: df.select("job", F.lit(part).alias("part"), F.col(k).cast("int").alias("k"), F.concat_ws(" ", *words).alias("said"))
    n = lambda c: F.col(c).cast("string")
    warnings = say(d.where("no_cells"), 0, "table_ord", F.lit("no_cells"), "table_id")
    for part, code in ((1, "stray_headers"), (2, "inferred"), (3, "missing")):
        warnings = warnings.unionByName(say(d.where(F.col(code) > 0), part, "table_ord", F.lit(code), "table_id", n(code)))
    warnings = warnings.unionByName(say(e.where("reordered").select("job", "page").distinct(), 4, "page", F.lit("reordered page"), n("page")))
    warnings = warnings.unionByName(say(figures.where("caption = ''"), 5, "n", F.lit("no_caption"), "id"))
    return Reading(e.drop("table_caption", "figure_caption"), d, figures, warnings, layout.page_counts(blocks, stated))


def texts_of(r: Reading) -> DataFrame:
    """(job, text): what an interpreter is given to read."""
    return layout.reading_text(r.elements, r.tables.select("job", "page", "table_id", "table_ord", t.markdown("header", "rows").alias("markdown")))


def _collected(r: Reading) -> DataFrame:
    """(job, els, figures, tables, said, page_count): all parts of a job in one row, by one exchange."""
    rows = r.elements.select("job", F.struct("n", "type", "page", "text", "table_id", "confidence").alias("el"))
    for df, order, value, name in (
        (r.figures, "n", F.struct("id", "caption", "page", "bbox").cast(FIGURE), "fig"),
        (r.tables, "table_ord", F.struct(F.struct(F.col("table_id").alias("id"), "caption", "page", "bbox", "header", "rows").cast(TABLE).alias("t"), "confidence"), "tab"),
        (r.warnings, "part", F.struct("k", "said"), "warn"),
    ):
        rows = rows.unionByName(df.select("job", F.struct(F.col(order).alias("o"), value.alias("v")).alias(name)), allowMissingColumns=True)
    rows = rows.unionByName(r.counts.select("job", "page_count"), allowMissingColumns=True)
    d = rows.groupBy("job").agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in ("el", "fig", "tab", "warn")], F.max("page_count").alias("page_count"))
    part = lambda c, fn: F.transform(c, lambda x: fn(x.getField("v")))
    return d.select("job", F.col("el").alias("els"), part("fig", lambda v: v).alias("figures"), part("tab", lambda v: v.getField("t")).alias("tables"), part("tab", lambda v: v.getField("confidence")).alias("table_confidences"), part("warn", lambda v: v.getField("said")).alias("read_warnings"), "page_count")


def _mean_confidence(values: Column) -> Column:
    return F.when(F.size(values) > 0, s.round6(F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)))


def documents(r: Reading, answers: DataFrame, features: tuple[str, ...] = ("LAYOUT", "TABLES")) -> DataFrame:
    """Documents (DOCUMENT) of jobs with answers (ANSWERS): sections and references take their text from elements.

    A section whose range is out of bounds keeps its heading without text; a reference that points nowhere keeps its
    own raw text; both are warned of.  Jobs without elements and tables have no document.
    """
    d = answers.select("job", *[F.col(c).alias(f"_{c}") for c in answers.columns if c != "job"]).join(_collected(r), "job")
    d = d.where((F.size("els") > 0) | (F.size("tables") > 0))
    size = F.size("els")

    def section(o: Column) -> Column:
        lo, hi = o.getField("from"), o.getField("to")
        fits = (lo >= 0) & (hi < size) & (lo <= hi)
        body = F.filter(F.slice(F.col("els"), F.when(fits, lo + 1).otherwise(1), F.when(fits, hi - lo + 1).otherwise(0)), lambda x: checks.is_body(x.getField("type"), x.getField("table_id")) & (x.getField("text") != ""))
        pages = F.transform(body, lambda x: x.getField("page"))
        return F.struct(o.getField("level").alias("level"), o.getField("heading").alias("heading"), F.array_join(F.transform(body, lambda x: x.getField("text")), "\n\n").alias("text"), s.sorted_distinct(pages).alias("pages"))

    def reference(o: Column) -> Column:
        at = F.get(F.col("els"), F.when(o.getField("element") >= 0, o.getField("element"))).getField("text")
        return F.struct(F.coalesce(at, t.trim_space(o.getField("raw")), F.lit("")).alias("raw"), *[o.getField(c).alias(c) for c in ("title", "authors", "year", "venue", "doi")])

    bad_range = lambda o, i: F.when(~((o.getField("from") == -1) & (o.getField("to") == -1)) & ~((o.getField("from") >= 0) & (o.getField("to") < size) & (o.getField("from") <= o.getField("to"))), F.format_string("bad_range sections[%d]", i))
    bad_pointer = lambda o, i: F.when((o.getField("element") < 0) | (o.getField("element") >= size), F.format_string("bad_pointer references[%d]", i))
    outline, refs = F.coalesce("_sections", F.array()), F.coalesce("_references", F.array())
    said = F.concat("read_warnings", F.array_compact(F.transform(outline, bad_range)), F.array_compact(F.transform(refs, bad_pointer)))
    of_type = lambda kind: F.transform(F.filter("els", lambda x: x.getField("type") == kind), lambda x: x.getField("confidence"))
    sure = {"title": of_type("LAYOUT_TITLE"), "sections": of_type("LAYOUT_SECTION_HEADER"), "figures": of_type("LAYOUT_FIGURE"), "tables": F.col("table_confidences")}
    conf = F.struct(*[(_mean_confidence(sure[f]) if f in sure else F.lit(None)).cast("double").alias(f) for f in CONFIDENCE_FIELDS]).cast(CONFIDENCE)
    cost = F.struct(F.col("page_count").alias("textract_pages"), F.array(*map(F.lit, features)).alias("textract_features"), F.col("_model").alias("bedrock_model"), F.col("_input_tokens").alias("input_tokens"), F.col("_output_tokens").alias("output_tokens")).cast(COST)
    meta = F.struct(*[F.col(f"_{c}").alias(c) for c in ("title", "authors", "abstract", "keywords", "venue", "year")], F.lit("").alias("primary_category")).cast(METADATA)
    list_of = lambda c, kind: F.coalesce(F.col(c) if isinstance(c, str) else c, F.array().cast(f"array<{kind}>")).cast(f"array<{kind}>")
    return d.select(
        F.col("job").alias("job_id"), F.lit("").alias("schema_version"), F.lit(None).cast(SOURCE).alias("source"), meta.alias("metadata"),
        list_of(F.transform(outline, section), SECTION).alias("sections"), list_of("figures", FIGURE).alias("figures"), list_of("tables", TABLE).alias("tables"), list_of(F.transform(refs, reference), REFERENCE).alias("references"),
        F.struct(F.lit("textract").alias("route"), F.lit(None).cast("timestamp").alias("extracted_at"), conf.alias("confidence"), cost.alias("cost"), F.lit(0).cast("bigint").alias("duration_ms"), said.alias("warnings")).cast(PROVENANCE).alias("provenance"),
    )

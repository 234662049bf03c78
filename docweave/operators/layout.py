"""Reading order of layout blocks: columns, bands, captions and numbers.

Every step is partitioned by job and page, so a page's blocks meet in one task and nothing else does.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions import text as t

#: Boxes wider than this say nothing about columns; a gutter is at least this wide, with its middle in these bounds.
MAX_COLUMN_WIDTH, MIN_GUTTER, GUTTER_FROM, GUTTER_TO = 0.55, 0.02, 0.3, 0.7
LAYOUT_TYPES = ("LAYOUT_TITLE", "LAYOUT_HEADER", "LAYOUT_FOOTER", "LAYOUT_SECTION_HEADER", "LAYOUT_PAGE_NUMBER", "LAYOUT_LIST", "LAYOUT_FIGURE", "LAYOUT_TABLE", "LAYOUT_KEY_VALUE", "LAYOUT_TEXT")


def column_splits(elements: DataFrame) -> DataFrame:
    """(job, page, split) of the pages (job, page, ord, bbox) that have two columns."""
    narrow = elements.where((F.size("bbox") == 4) & (F.col("bbox")[2] - F.col("bbox")[0] <= MAX_COLUMN_WIDTH)).select("job", "page", "ord", F.col("bbox")[0].alias("x0"), F.col("bbox")[2].alias("x1"))
    before = W.partitionBy("job", "page").orderBy("x0", "ord").rowsBetween(W.unboundedPreceding, -1)
    gap = narrow.withColumn("right", F.max("x1").over(before)).where("right IS NOT NULL").select("job", "page", "ord", "x0", (F.col("x0") - F.col("right")).alias("gap"), (F.col("right") + (F.col("x0") - F.col("right")) / 2).alias("mid"))
    good = gap.where((F.col("gap") > MIN_GUTTER) & F.col("mid").between(GUTTER_FROM, GUTTER_TO))
    return good.groupBy("job", "page").agg(F.min_by("mid", F.struct(-F.col("gap"), F.col("x0"), F.col("ord"))).alias("split"))


def column_of(box: Column, split: Column) -> Column:
    """1 left, 2 right, 0 across or no columns."""
    return F.when(split.isNull() | (F.coalesce(F.size(box), F.lit(0)) != 4), 0).when(box[2] <= split, 1).when(box[0] >= split, 2).otherwise(0)


def reading_order(elements: DataFrame) -> DataFrame:
    """Adds col, rank (from 0, in reading order within the page) and reordered (per page)."""
    e = elements.join(column_splits(elements), ["job", "page"], "left")
    e = e.withColumns({"col": column_of(F.col("bbox"), F.col("split")), "_top": s.box_top("bbox"), "_left": s.box_left("bbox")})
    page = W.partitionBy("job", "page")
    across = (F.col("col") == 0).cast("int")
    above = F.coalesce(F.sum(across).over(page.orderBy("_top", "ord").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    e = e.withColumn("_band", F.when(F.col("split").isNull(), F.lit(0)).otherwise(2 * above + across))
    key = lambda c: F.when(F.col("split").isNull(), F.lit(0.0)).otherwise(F.col(c))
    e = e.withColumn("rank", F.row_number().over(page.orderBy("_band", key("col"), key("_top"), key("_left"), "ord")) - 1)
    place = F.row_number().over(page.orderBy("ord")) - 1
    return e.withColumn("_place", place).withColumn("reordered", F.max(F.col("rank") != F.col("_place")).over(page)).drop("_top", "_left", "_band", "_place", "split")


def numbered(elements: DataFrame) -> DataFrame:
    """Adds n, the element's number in its document (from 0): pages in order, reading order within."""
    return elements.withColumn("n", F.row_number().over(W.partitionBy("job").orderBy("page", "rank")) - 1)


def caption_near(prefixes: list[str], order: str = "n") -> Column:
    """The text of the next, else the previous element of the page, if it starts with a prefix in any case."""
    w = W.partitionBy("job", "page").orderBy(order)
    fits = lambda x: F.lower(t.trim_space(x)).rlike("^(?:" + t.any_of(prefixes) + ")")
    after, prior = F.lead("text").over(w), F.lag("text").over(w)
    return F.when(fits(after), t.trim_space(after)).when(fits(prior), t.trim_space(prior)).otherwise("")


def sequence_ids(df: DataFrame, prefix: str, order: str, out: str = "id") -> DataFrame:
    """Adds prefix-1, prefix-2, ... within each job."""
    return df.withColumn(out, F.concat(F.lit(f"{prefix}-"), F.row_number().over(W.partitionBy("job").orderBy(order)).cast("string")))


def block_texts(blocks: DataFrame, edges: DataFrame, roots: DataFrame | None = None) -> DataFrame:
    """(job, id, full_text): a block's own text, or its descendants' texts in order, joined by blanks.

    A block counts once under one root, where a descent in order meets it first: at the smallest path of child
    positions; blocks on the same path stand in the order of their texts.  Blocks, child edges and roots are dealt out by
    job once and pass in the order of jobs; shared children and cycles end the descent and depth has no bound.
    roots: (job, id) of the blocks asked for; all without it.
    """
    own = F.when(F.coalesce("text", F.lit("")) != "", F.col("text")).when(F.col("block_type") == "SELECTION_ELEMENT", F.coalesce("selection_status", F.lit("")))
    none = F.lit(None)
    row = lambda df, kind, at, child=none, pos=none, own=none: df.select("job", F.lit(kind).cast("byte").alias("kind"), F.col(at).alias("at"), child.cast("string").alias("child"), pos.cast("int").alias("pos"), own.cast("string").alias("own"))
    rows = row(blocks, 0, "id", own=own).unionByName(row(edges.where("rel_type = 'CHILD'"), 1, "parent", F.col("child"), F.col("pos")))
    if roots is not None:
        rows = rows.unionByName(row(roots, 2, "id"))
    dealt = rows.repartition("job").sortWithinPartitions("job", "kind")
    return dealt.mapInArrow(_descents(roots is None), "job string, id string, full_text string")


def _descents(everything: bool):
    """Texts of the blocks asked for, from rows (job, kind, at, child, pos, own) of blocks 0, edges 1 and roots 2 that come
    job by job; one job's graph is held at a time."""

    def run(batches):
        job, own, child, asked, out = None, {}, {}, {}, []

        def finish():
            ids = own if everything else [x for x in asked if x in own and x is not None and job is not None]
            for at in ids:
                out.append((job, at, "" if job is None or at is None else _descent(at, own, child)))

        for batch in batches:
            jobs, kinds, ats, tos, places, owns = batch.columns
            places = places.cast("int64").fill_null(-(1 << 40))  # nulls first
            for j, kind, at, to, pos, text in zip(*(c.to_numpy(zero_copy_only=False).tolist() for c in (jobs, kinds, ats, tos, places, owns))):
                if j != job:
                    finish()
                    job, own, child, asked = j, {}, {}, {}
                if kind == 0:
                    before = own.get(at)
                    own[at] = text if before is None or (text is not None and text < before) else before
                elif kind == 2:
                    asked[at] = None
                elif at is not None and to is not None and to in own:
                    near = child.setdefault(at, {})
                    near[to] = min(pos, near.get(to, pos))
            if out:
                yield _text_rows(out)
                out = []
        finish()
        yield _text_rows(out)

    return run


def _text_rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(3)], names=["job", "id", "full_text"])


def _descent(root: str, own: dict[str, str | None], child: dict[str, dict[str, int]]) -> str:
    """The text under ``root``: a walk in the order of paths, where blocks on the same path go together."""
    if own[root] is not None:
        return own[root]
    seen, texts, ahead = set(), [], [[root]]
    while ahead:
        here = [x for x in ahead.pop() if x not in seen]
        seen.update(here)
        texts += sorted(x for x in map(own.get, here) if x)
        below: dict[str, int] = {}
        for x in here:
            if own[x] is None:
                for to, pos in child.get(x, {}).items():
                    if to not in seen:
                        below[to] = min(pos, below.get(to, pos))
        places: dict[int, list[str]] = {}
        for to, pos in below.items():
            places.setdefault(pos, []).append(to)
        ahead += [places[pos] for pos in sorted(places, reverse=True)]
    return " ".join(texts)


def element_blocks(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """The blocks that become elements.

    A list whose parts are layout blocks themselves is left out; single lines count only on pages without any
    layout block.
    """
    b = blocks.withColumn("page", s.page_or_first("page"))
    shown = b.where(F.col("block_type").isin(*LAYOUT_TYPES))
    parts = edges.where("rel_type = 'CHILD'").join(shown.select("job", F.col("id").alias("child")), ["job", "child"], "left_semi")
    wrappers = shown.where("block_type = 'LAYOUT_LIST'").join(parts.select("job", F.col("parent").alias("id")), ["job", "id"], "left_semi")
    kept = shown.join(wrappers.select("job", "id"), ["job", "id"], "left_anti")
    lines = b.where("block_type = 'LINE'").join(kept.select("job", "page").distinct(), ["job", "page"], "left_anti")
    return kept.unionByName(lines)


def with_texts(shown: DataFrame, texts: DataFrame) -> DataFrame:
    """Element blocks as elements (job, ord, id, type, page, text, bbox, confidence); texts: (job, id, full_text)."""
    both = shown.join(texts, ["job", "id"], "left")
    return both.select("job", "ord", "id", F.col("block_type").alias("type"), "page", F.coalesce("full_text", F.lit("")).alias("text"), s.bbox("left", "top", "width", "height").alias("bbox"), s.confidence("confidence").alias("confidence"))


def elements_of(blocks: DataFrame, edges: DataFrame) -> DataFrame:
    """Layout elements (job, ord, id, type, page, text, bbox, confidence)."""
    shown = element_blocks(blocks, edges)
    return with_texts(shown, block_texts(blocks, edges, shown))


def page_counts(blocks: DataFrame, stated: DataFrame | None = None) -> DataFrame:
    """(job, page_count): the number stated, else the largest page, at least 1."""
    seen = blocks.groupBy("job").agg(F.max(s.page_or_first("page")).alias("seen"))
    if stated is None:
        return seen.select("job", F.greatest("seen", F.lit(1)).alias("page_count"))
    return seen.join(stated, "job", "left").select("job", F.greatest(F.when(F.col("pages") > 0, F.col("pages")).otherwise(F.col("seen")), F.lit(1)).alias("page_count"))


def _crossing(elements: DataFrame, tables: DataFrame) -> DataFrame:
    """(job, page, ebox, tbox, area): boxes of table elements and boxes of tables of one page that share area, to nine places.

    Each box counts once, however many elements or tables have it.
    """
    side = lambda df, p: df.select("job", "page", F.col("bbox").alias(f"{p}box")).distinct()
    e, x = side(elements.where("type = 'LAYOUT_TABLE'"), "e"), side(tables, "t")
    at = lambda p, i: F.col(f"{p}box")[i]
    crossing = (at("e", 0) < at("t", 2)) & (at("t", 0) < at("e", 2)) & (at("e", 1) < at("t", 3)) & (at("t", 1) < at("e", 3))
    area = (F.least(at("e", 2), at("t", 2)) - F.greatest(at("e", 0), at("t", 0))) * (F.least(at("e", 3), at("t", 3)) - F.greatest(at("e", 1), at("t", 1)))
    met = e.alias("e").join(x.alias("t"), (F.col("e.job") == F.col("t.job")) & (F.col("e.page") == F.col("t.page")) & crossing)
    return met.select("e.job", "e.page", "ebox", "tbox", F.round(area, 9).alias("area")).where("area > 0")


def best_overlaps(elements: DataFrame, tables: DataFrame) -> DataFrame:
    """(job, n, table_id, area): for each table element the table of its page it shares most area with.

    Of the tables with the same box only the first can be the best, and elements with the same box have the same best.
    """
    first = tables.groupBy("job", "page", F.col("bbox").alias("tbox")).agg(F.min_by(F.struct("table_ord", "table_id"), "table_ord").alias("t"))
    best = F.max_by(F.struct("t.table_id", "area", "t.table_ord"), F.struct(F.col("area"), -F.col("t.table_ord")))
    of_box = _crossing(elements, tables).join(first, ["job", "page", "tbox"]).groupBy("job", "page", "ebox").agg(best.alias("b"))
    every = elements.where("type = 'LAYOUT_TABLE'").select("job", "page", "n", F.col("bbox").alias("ebox")).join(of_box, ["job", "page", "ebox"])
    return every.groupBy("job", "n").agg(F.max_by("b", F.struct(F.col("b.area"), -F.col("b.table_ord"))).alias("b")).select("job", "n", "b.table_id", "b.area")


def exclusive_overlaps(elements: DataFrame, tables: DataFrame) -> DataFrame:
    """(job, n, table_id): each table used once, elements choosing in reading order, first table wins ties.

    Each choice depends on the ones before it, so a page's elements choose one after the other, from the boxes that
    cross theirs; of the tables with one box the first that is left is taken.
    """
    row = lambda df, kind, **cols: df.select("job", "page", F.lit(kind).cast("byte").alias("kind"), *[cols.get(c, F.lit(None)).cast(k).alias(c) for c, k in (("n", "int"), ("table_id", "string"), ("ebox", "array<double>"), ("tbox", "array<double>"), ("area", "double"))])
    c = F.col
    rows = row(elements.where("type = 'LAYOUT_TABLE'"), 0, n=c("n"), ebox=c("bbox")).unionByName(row(tables, 1, n=c("table_ord"), table_id=c("table_id"), tbox=c("bbox"))).unionByName(row(_crossing(elements, tables), 2, ebox=c("ebox"), tbox=c("tbox"), area=c("area")))
    return rows.groupBy("job", "page").applyInArrow(_choices, "job string, n int, table_id string")


def _choices(page: pa.Table) -> pa.Table:
    """The choices of one page, from its elements 0, its tables 1 and the pairs of boxes that cross 2."""
    part = lambda kind, *cols: zip(*(page.filter(pc.equal(page["kind"], kind))[c].to_pylist() for c in cols))
    box = lambda b: None if b is None else tuple(b)
    left: dict[tuple, list] = {}  # of each box the tables not taken, first one last
    for order, table, b in sorted(part(1, "n", "table_id", "tbox"), key=lambda x: (x[0], x[1] or ""), reverse=True):
        left.setdefault(box(b), []).append((order, table))
    ranked: dict[tuple, list] = {}
    for e, x, area in sorted(part(2, "ebox", "tbox", "area"), key=lambda p: p[2]):
        ranked.setdefault(box(e), []).append((area, box(x)))
    boxes: dict[int, set] = {}
    for n, e in part(0, "n", "ebox"):
        boxes.setdefault(n, set()).add(box(e))
    chosen, taken = [], set()
    for n in sorted(x for x in boxes if x is not None):
        best = None
        for e in boxes[n]:
            pairs = ranked.get(e, [])
            while pairs and not _free(left[pairs[-1][1]], taken):
                pairs.pop()
            for area, x in reversed(pairs):
                if area < pairs[-1][0]:
                    break
                if _free(left[x], taken):
                    here = (-area, *left[x][-1])
                    best = here if best is None or here < best else best
        if best:
            taken.add(best[2])
            chosen.append((n, best[2]))
    job = page["job"][0].as_py()
    return pa.table({"job": pa.array([job] * len(chosen), pa.string()), "n": pa.array([n for n, _ in chosen], pa.int32()), "table_id": pa.array([x for _, x in chosen], pa.string())})


def _free(queue: list, taken: set) -> bool:
    while queue and queue[-1][1] in taken:
        queue.pop()
    return bool(queue)


def reading_text(elements: DataFrame, tables: DataFrame) -> DataFrame:
    """(job, text): elements with numbers and page heads, tables in markdown where they stand, others at their page's end."""
    n = lambda c: F.col(c).cast("string")
    placed = elements.join(tables.select("job", F.col("table_id"), "markdown"), ["job", "table_id"], "left")
    table_text = F.concat(F.lit("[#"), n("n"), F.lit(" TABLE "), F.col("table_id"), F.lit("]\n"), F.col("markdown"), F.lit("\n"))
    plain = F.concat(F.lit("[#"), n("n"), F.lit(" "), t.layout_tag("type"), F.lit("] "), F.col("text"), F.lit("\n\n"))
    lines = placed.select("job", "page", F.lit(1).alias("part"), F.col("n").alias("k"), F.when(F.col("markdown").isNotNull(), table_text).when(F.col("text") != "", plain).otherwise("").alias("line"))
    heads = elements.select("job", "page").distinct().select("job", "page", F.lit(0).alias("part"), F.lit(0).alias("k"), F.concat(F.lit("## page "), n("page"), F.lit("\n\n")).alias("line"))
    rest = tables.join(elements.select("job", "table_id").where("table_id IS NOT NULL"), ["job", "table_id"], "left_anti")
    on_page = rest.join(elements.select("job", "page").distinct().withColumn("there", F.lit(True)), ["job", "page"], "left")
    left = on_page.select("job", F.when(F.col("there"), F.col("page")).otherwise(F.lit(2147483647)).alias("page"), F.lit(2).alias("part"), F.col("table_ord").alias("k"), F.concat(F.lit("[TABLE "), F.col("table_id"), F.lit("]\n"), F.col("markdown"), F.lit("\n")).alias("line"))
    every = lines.unionByName(heads).unionByName(left)
    return every.groupBy("job").agg(F.array_sort(F.collect_list(F.struct("page", "part", "k", "line"))).alias("l")).select("job", F.array_join(F.transform("l", lambda x: x.getField("line")), "").alias("text"))


def class_confidence(elements: DataFrame, tables: DataFrame | None = None) -> DataFrame:
    """(job, title, sections, figures, tables): mean confidence of each class, to six places; NULL without members."""
    one = lambda kind: s.round6(F.avg(F.when(F.col("type") == kind, F.col("confidence"))))
    out = elements.groupBy("job").agg(one("LAYOUT_TITLE").alias("title"), one("LAYOUT_SECTION_HEADER").alias("sections"), one("LAYOUT_FIGURE").alias("figures"))
    if tables is None:
        return out.withColumn("tables", F.lit(None).cast("double"))
    return out.join(tables.groupBy("job").agg(s.round6(F.avg("confidence")).alias("tables")), "job", "left")

"""Tables restored from sparse cells with spans, merged cells and header rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEY = ["job", "table_id"]


def _span(n: str) -> Column:
    return F.greatest(F.coalesce(F.col(n), F.lit(1)), F.lit(1))


def covered_slots(cells: DataFrame) -> DataFrame:
    """One row a slot (row, col): text of the cell placed last (merged cells after plain ones), and header.

    Input rows: job, table_id, place (order of placing), merged, row, col, row_span, col_span, text, header.
    """
    span = lambda at, n: F.sequence(F.col(at), F.col(at) + F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)) - 1)
    slots = cells.where("row >= 1 AND col >= 1").withColumn("r", F.explode(span("row", F.col("row_span")))).withColumn("c", F.explode(span("col", F.col("col_span"))))
    return slots.groupBy(*KEY, "r", "c").agg(F.max_by("text", F.struct("merged", "place")).alias("text"), F.max("header").alias("header"))


def table_shapes(cells: DataFrame) -> DataFrame:
    """(job, table_id, rows, cols) by the cells' far ends."""
    far = lambda at, n: F.max(F.col(at) + F.greatest(F.coalesce(n, F.lit(1)), F.lit(1)) - 1)
    return cells.groupBy(*KEY).agg(far("row", F.col("row_span")).alias("rows"), far("col", F.col("col_span")).alias("cols"))


def full_grid(cells: DataFrame) -> DataFrame:
    """Every slot of every table: r, c, text ('' where missing), filled, inferred, is_header.

    Header rows are those at the top without a break.  In them an empty slot takes the text of the nearest
    filled slot to its left, if that is not empty.
    """
    # One exchange by table: its first cell brings every slot, and slots are grouped where they are.
    by_table, far = W.partitionBy(*KEY), lambda at, n: F.max(F.col(at) + _span(n) - 1)
    c = cells.select(*KEY, "place", "merged", "row", "col", "row_span", "col_span", "text", "header").repartition(*KEY)
    c = c.withColumns({"rows": far("row", "row_span").over(by_table), "cols": far("col", "col_span").over(by_table), "_first": F.row_number().over(by_table.orderBy(F.lit(1))) == 1})
    down, right = lambda at, n: F.sequence(F.col(at), F.col(at) + _span(n) - 1), F.sequence(F.lit(1), F.col("cols"))
    none = F.array().cast("array<struct<r:int,c:int,own:boolean>>")
    slots = lambda rs, cs, own: F.flatten(F.transform(rs, lambda r: F.transform(cs, lambda x: F.struct(r.cast("int").alias("r"), x.cast("int").alias("c"), F.lit(own).alias("own")))))
    own = F.when((F.col("row") >= 1) & (F.col("col") >= 1), slots(down("row", "row_span"), down("col", "col_span"), True)).otherwise(none)
    every = F.when(F.col("_first"), slots(F.sequence(F.lit(1), F.col("rows")), right, False)).otherwise(none)
    g = c.withColumn("s", F.explode(F.concat(own, F.coalesce(every, none)))).groupBy(*KEY, "rows", "cols", "s.r", "s.c").agg(
        F.max_by(F.when(F.col("s.own"), F.col("text")), F.when(F.col("s.own"), F.struct("merged", "place"))).alias("text"), F.max(F.when(F.col("s.own"), F.col("header"))).alias("header")
    )
    g = g.withColumn("filled", F.col("text").isNotNull() | F.col("header").isNotNull())
    row, table = W.partitionBy(*KEY, "r"), W.partitionBy(*KEY)
    g = g.withColumn("row_header", F.coalesce(F.max(F.col("header")).over(row), F.lit(False)))
    g = g.withColumn("first_body", F.min(F.when(~F.col("row_header"), F.col("r"))).over(table))
    g = g.withColumn("is_header", F.col("row_header") & (F.col("first_body").isNull() | (F.col("r") < F.col("first_body"))))
    left = F.last(F.when(F.col("filled"), F.coalesce("text", F.lit(""))), True).over(row.orderBy("c").rowsBetween(W.unboundedPreceding, -1))
    g = g.withColumn("inferred", ~F.col("filled") & F.col("is_header") & (F.coalesce(left, F.lit("")) != ""))
    text = F.when(F.col("filled"), F.coalesce("text", F.lit(""))).when(F.col("inferred"), left).otherwise("")
    return g.select(*KEY, "rows", "cols", "r", "c", text.alias("text"), "filled", "inferred", "is_header", "row_header")


def restored_tables(cells: DataFrame) -> DataFrame:
    """(job, table_id, header, body, inferred, missing, stray_headers) of every table."""
    g = full_grid(cells)
    rows = g.groupBy(*KEY, "r", "is_header", "row_header").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("c", "text"))), lambda x: x.getField("text")).alias("cells"),
        F.count_if("inferred").alias("inferred"),
        F.count_if(~F.col("filled") & ~F.col("inferred")).alias("missing"),
    )
    pick = lambda flag: F.transform(F.array_sort(F.collect_list(F.when(F.col("is_header") == flag, F.struct("r", "cells")))), lambda x: x.getField("cells"))
    return rows.groupBy(*KEY).agg(pick(True).alias("header"), pick(False).alias("body"), F.sum("inferred").alias("inferred"), F.sum("missing").alias("missing"), F.count_if(F.col("row_header") & ~F.col("is_header")).alias("stray_headers"))


def cells_of(blocks: DataFrame, edges: DataFrame, texts: DataFrame, tables: DataFrame) -> DataFrame:
    """Cell rows of the table blocks: tables has (job, table_id, block_id); texts (job, id, full_text)."""
    inside = tables.join(edges.select("job", F.col("parent").alias("block_id"), F.col("child").alias("id"), "pos"), ["job", "block_id"])
    cell = blocks.where("block_type IN ('CELL', 'MERGED_CELL')").join(texts, ["job", "id"])
    return inside.join(cell, ["job", "id"]).select(
        "job", "table_id", F.col("pos").alias("place"), (F.col("block_type") == "MERGED_CELL").alias("merged"), F.col("row_index").alias("row"), F.col("column_index").alias("col"), "row_span", "column_span", F.col("column_span").alias("col_span"),
        F.col("full_text").alias("text"), F.coalesce(F.array_contains("entity_types", "COLUMN_HEADER"), F.lit(False)).alias("header"), "confidence",
    ).drop("column_span")


def sparse_cells(df: DataFrame, job: str, table: str, row: str, col: str, text: str, header: str) -> DataFrame:
    """Any rows as plain cells without spans."""
    return df.select(F.col(job).cast("string").alias("job"), F.col(table).cast("string").alias("table_id"), F.lit(0).alias("place"), F.lit(False).alias("merged"), F.col(row).alias("row"), F.col(col).alias("col"), F.lit(1).alias("row_span"), F.lit(1).alias("col_span"), F.col(text).alias("text"), F.col(header).alias("header"))

"""Strict answers, positions, corpus runs, the layout route and small rules on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from docweave.functions import checks, scalars, strict
from docweave.functions import text as t
from docweave.operators import corpus
from docweave.plans import layout_route
from docweave.schemas import BLOCK_EDGES, BLOCKS
from docweave.sources import readers
from docweave.streaming import flows

DDL = "a STRING NOT NULL, n INT, deep ARRAY<STRUCT<x: ARRAY<INT>, ok: BOOLEAN NOT NULL>> NOT NULL, f DOUBLE"


@pytest.mark.parametrize(
    "raw, want",
    [
        ('{"a": "x", "n": null, "deep": [], "f": 1}', []),
        ('{"a": "x", "n": 3, "deep": [{"x": [1, 2], "ok": true}], "f": 2.5}', []),
        ('{"a": null, "n": "3", "deep": null, "f": "1"}', [("$.a", "null"), ("$.n", "mistyped"), ("$.deep", "null"), ("$.f", "mistyped")]),
        ('{"deep": [{"x": [1, "2", null], "ok": 1, "z": 0}, 5]}', [("$.a", "missing"), ("$.n", "missing"), ("$.deep[0].x[1]", "mistyped"), ("$.deep[0].x[2]", "null"), ("$.deep[0].ok", "mistyped"), ("$.deep[0].z", "unknown"), ("$.deep[1]", "mistyped"), ("$.f", "missing")]),
        ('[1]', [("$", "mistyped")]),
        ('null', [("$", "null")]),
        ('{"a": 1', [("$", "invalid")]),
        ('{"a": "x"} more', [("$", "invalid")]),
        ('{"a": "x"}]', [("$", "invalid")]),
        ('{"a": "x"}}', [("$", "invalid")]),
        ('1, 2', [("$", "invalid")]),
        ('', [("$", "invalid")]),
        (None, [("$", "invalid")]),
    ],
)
def test_every_field_that_does_not_fit(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw string")
    assert [tuple(p) for p in df.select(strict.schema_problems("raw", DDL).alias("p")).first().p] == want


def test_positions_in_order_of_keys(spark):
    keys = [f"k{i:05}" for i in random.Random(1).sample(range(90_000), 3000)]
    df = spark.createDataFrame([(k,) for k in keys], "key string").repartition(7)
    at = corpus.with_positions(df, "key", 10)
    assert {r.key: r.ord for r in at.collect()} == {k: 10 + i for i, k in enumerate(sorted(keys))}
    assert "SinglePartition" not in at._jdf.queryExecution().executedPlan().toString()
    assert corpus.with_positions(df.where("false"), "key").collect() == []


def test_one_run_of_the_corpus(spark):
    entries = spark.createDataFrame([(f"p{i}", i) for i in range(6)], "arxiv_id string, published int")
    details = spark.createDataFrame([(f"p{i}", i + 1, "[1] a\n[7] b", "http://creativecommons.org", "application/gzip", b"x") for i in range(6)], "arxiv_id string, pages int, text string, license string, content_type string, content binary")
    have = spark.createDataFrame([("p4", 0, None), ("old", 1, 9)], "arxiv_id string, ord int, references int")
    got = {r.arxiv_id: (r.ord, r.references) for r in corpus.run(entries, details, have, 2, 6, 2).collect()}
    assert got == {"p4": (0, None), "old": (1, 9), "p3": (2, 7), "p5": (3, 7)}


def test_layout_route(spark):
    """Two columns read left then right; a table under its caption with a merged cell and a gap; a figure with none."""
    b = lambda i, kind, page=1, text=None, box=(0.1, 0.1, 0.3, 0.1), sure=90.0, row=None, col=None, span=None, head=False: ("j", i, f"b{i}", kind, page, text, sure, *box, row, col, 1, span, ["COLUMN_HEADER"] if head else None, None)
    left, right = lambda y: (0.05, y, 0.4, 0.05), lambda y: (0.55, y, 0.4, 0.05)
    blocks = [
        b(1, "LAYOUT_TEXT", box=right(0.1)), b(2, "LAYOUT_SECTION_HEADER", box=left(0.1)), b(3, "LAYOUT_TABLE", box=right(0.3)), b(4, "LAYOUT_TEXT", box=right(0.4)), b(5, "LAYOUT_FIGURE", 2, box=left(0.1)),
        b(11, "LINE", text="right"), b(12, "LINE", text="Head"), b(14, "LINE", text="Table 1 of it"),
        b(20, "TABLE", box=right(0.3), sure=70.0), b(21, "CELL", row=1, col=1, head=True), b(22, "CELL", row=2, col=1), b(23, "MERGED_CELL", row=3, col=1, span=2), b(31, "WORD", text="h"), b(32, "WORD", text="v"), b(33, "WORD", text="m"),
    ]
    edges = [("b1", "b11"), ("b2", "b12"), ("b4", "b14"), ("b20", "b21"), ("b20", "b22"), ("b20", "b23"), ("b21", "b31"), ("b22", "b32"), ("b23", "b33")]
    r = layout_route.read(spark.createDataFrame(blocks, BLOCKS), spark.createDataFrame([("j", p, c, "CHILD", i) for i, (p, c) in enumerate(edges)], BLOCK_EDGES))
    assert [(x.n, x.text, x.table_id) for x in r.elements.orderBy("n").collect()] == [(0, "Head", None), (1, "right", None), (2, "", "table-1"), (3, "Table 1 of it", None), (4, "", None)]
    section, ref = "level", ("element", "raw", "title", "authors", "year", "venue", "doi")
    answer = [("j", "T", [], "A", [], "", 0, [(1, "one", 1, 3), (1, "none", -1, -1), (2, "bad", 3, 9)], [(0, "x", "", [], 0, "", None), (7, " own ", "", [], 0, "", None)], "m", 1, 2), ("gone", "T", [], "", [], "", 0, [], [], "m", 0, 0)]
    docs = layout_route.documents(r, spark.createDataFrame(answer, layout_route.ANSWERS)).collect()
    assert [d.job_id for d in docs] == ["j"]
    d = docs[0]
    assert [(x.heading, x.text, x.pages) for x in d.sections] == [("one", "right\n\nTable 1 of it", [1]), ("none", "", []), ("bad", "", [])]
    assert [(x.caption, x.header, x.rows) for x in d.tables] == [("Table 1 of it", [["h", "h"]], [["v", ""], ["m", "m"]])]
    assert [x.raw for x in d.references] == ["Head", "own"] and [(x.id, x.caption, x.page) for x in d.figures] == [("figure-1", "", 2)]
    assert d.provenance.warnings == ["inferred table-1 1", "missing table-1 1", "reordered page 1", "no_caption figure-1", "bad_range sections[2]", "bad_pointer references[1]"]
    assert d.provenance.confidence.tables == round((0.7 + 0.9 + 0.9) / 3, 6) and d.provenance.cost.textract_pages == 2
    assert section and ref


def test_small_rules(spark):
    one = spark.range(1)
    said = lambda c: one.select(c.alias("x")).first().x
    assert said(checks.features_setting_problem(F.lit(" , "))) == "empty" and said(checks.features_setting_problem(F.lit("TABLES"))) is None
    problem = lambda topic, role: said(checks.start_problem(F.lit("b"), F.lit("k"), F.array(F.lit("LAYOUT")), F.lit(topic).cast("string"), F.lit(role).cast("string")))
    assert [problem(*x) for x in (("t", "r"), (None, None), ("t", None), ("", "r"))] == [None, None, "notification incomplete", "notification incomplete"]
    assert said(scalars.mean_or_zero(F.array().cast("array<double>"))) == 0 and said(scalars.mean_or_zero(F.array(F.lit(1.0), F.lit(2.0)))) == 1.5
    assert said(t.in_page_order(F.array(*map(F.lit, ("page-10.png", "x.txt", "page-9.png", "page-0002.png"))))) == ["page-0002.png", "page-9.png", "page-10.png", "x.txt"]


def test_files_are_read_as_they_are(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1,\n "b": "x"}')
    (tmp_path / "b.json").write_text('{"a": 2}')
    assert sorted(tuple(r) for r in readers.json_records(spark, str(tmp_path), "a int, b string").collect()) == [(1, "x"), (2, None)]
    (tmp_path / "c.json").write_text("{nonsense")
    with pytest.raises(Exception):
        readers.json_records(spark, str(tmp_path), "a int, b string").collect()
    assert readers.json_records(spark, str(tmp_path), "a int, b string", strict=False).count() == 3
    assert {r.path.rsplit("/", 1)[1]: r.text for r in readers.texts(spark, str(tmp_path)).collect()}["b.json"] == '{"a": 2}'
    assert {r.path.rsplit("/", 1)[1]: r.length for r in readers.file_heads(spark, str(tmp_path)).collect()} == {"a.json": 19, "b.json": 8, "c.json": 9}


def test_calls_keep_their_interval(spark):
    import time

    call = lambda rows: rows.assign(at=time.monotonic())
    got = sorted(r.at for r in flows.throttled(spark.range(4), call, "id long, at double", 0.1).collect())
    assert all(b - a > 0.08 for a, b in zip(got, got[1:]))

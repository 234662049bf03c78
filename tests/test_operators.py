"""Operators on small hand-made tables, and properties that hold whatever the order and partitioning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docweave import schemas
from docweave.operators import compare, corpus, grid, jobs, layout, merge, normalize, references, scoring, verify
from docweave.plans import finalize
from docweave.sources import readers, writers

T0 = dt.datetime(2026, 1, 1)


def boxes(spark, rows):
    return spark.createDataFrame([("j", 1, i, list(map(float, b))) for i, b in enumerate(rows)], "job string, page int, ord int, bbox array<double>")


@pytest.mark.parametrize("rows,two", [([(0.08, 0, 0.46, 1), (0.52, 0, 0.90, 1)], True), ([(0.05, 0, 0.95, 1), (0.05, 0, 0.95, 1)], False), ([(0.05, 0, 0.14, 1), (0.16, 0, 0.6, 1)], False), ([(0.1, 0, 0.49, 1), (0.5, 0, 0.9, 1)], False), ([(0.08, 0, 0.46, 1)], False)])
def test_columns(spark, rows, two):
    assert (layout.column_splits(boxes(spark, rows)).count() == 1) == two


def test_reading_order(spark):
    rows = [(0.1, 0.0, 0.9, 0.05), (0.52, 0.1, 0.9, 0.2), (0.08, 0.1, 0.46, 0.2), (0.52, 0.3, 0.9, 0.4), (0.08, 0.3, 0.46, 0.4), (0.1, 0.5, 0.9, 0.55), (0.08, 0.6, 0.46, 0.7)]
    got = layout.reading_order(boxes(spark, rows).repartition(5)).orderBy("rank").collect()
    assert [r.ord for r in got] == [0, 2, 4, 1, 3, 5, 6] and [r.col for r in got] == [0, 1, 1, 2, 2, 0, 1] and got[0].reordered


def test_blocks_to_elements(spark):
    def block(ord, id, kind, page=1, text=None, left=0.1, top=0.1, **more):
        return {"job": "j", "ord": ord, "id": id, "block_type": kind, "page": page, "text": text, "confidence": 90.0, "left": left, "top": top, "width": 0.5, "height": 0.1, "row_index": None, "column_index": None, "row_span": None, "column_span": None, "entity_types": None, "selection_status": None} | more

    b = spark.createDataFrame([block(0, "list", "LAYOUT_LIST"), block(1, "t1", "LAYOUT_TEXT"), block(2, "l1", "LINE", text="one"), block(3, "l2", "LINE", text="two"), block(4, "l3", "LINE", page=2, text="alone"), block(5, "loop", "LAYOUT_TEXT", page=0)], schemas.BLOCKS)
    e = spark.createDataFrame([("j", "list", "t1", "CHILD", 0), ("j", "t1", "l1", "CHILD", 0), ("j", "t1", "l2", "CHILD", 1), ("j", "loop", "loop", "CHILD", 0), ("j", "t1", "none", "CHILD", 2)], schemas.BLOCK_EDGES)
    got = {r.id: r for r in layout.elements_of(b, e).collect()}
    assert set(got) == {"t1", "loop", "l3"} and got["t1"].text == "one two" and got["loop"].text == "" and got["t1"].confidence == 0.9 and got["t1"].bbox == [0.1, 0.1, 0.6, 0.2]
    assert layout.page_counts(b).first().page_count == 2


def test_block_texts_of_shared_children_and_depth(spark):
    """A block that two parents share counts once, where a descent meets it first; depth has no bound."""
    text = {"hello": "hello", "deep": "down"}
    chain = [f"c{i}" for i in range(20)]
    ids = ["root", "a", "b", "hello", *chain, "deep"]
    b = spark.createDataFrame([("j", i, "WORD" if i in text else "LAYOUT_TEXT", text.get(i)) for i in ids], "job string, id string, block_type string, text string").withColumn("selection_status", F.lit(None).cast("string"))
    edges = [("root", "b", 1), ("root", "a", 0), ("a", "hello", 0), ("b", "hello", 0), ("root", "c0", 2), *[(x, y, 0) for x, y in zip(chain, chain[1:])], (chain[-1], "deep", 0), (chain[-1], "root", 1), ("b", "deep", 1)]
    e = spark.createDataFrame([("j", p, c, "CHILD", n) for p, c, n in edges], "job string, parent string, child string, rel_type string, pos int")
    got = {r.id: r.full_text for r in layout.block_texts(b, e).collect()}
    assert got["root"] == "hello down" and got["b"] == "hello down" and got["c5"] == "down hello" and got["hello"] == "hello"


def test_block_texts_leave_nothing_on_disk(spark, monkeypatch):
    """A descent of any depth is one dealing by job: no level of it is written out. Ties go by text, nulls first."""
    monkeypatch.setattr(type(spark.range(1)), "checkpoint", None)
    b = spark.createDataFrame([("j", i, "WORD" if x else "LINE", x) for i, x in (("r", None), ("p", None), ("q", None), ("w", "w"), ("v", "v"), ("u", "u"), (None, "n"))], "job string, id string, block_type string, text string").withColumn("selection_status", F.lit(None).cast("string"))
    edges = [("r", "p", 3), ("r", "q", 3), ("p", "w", 1), ("q", "v", 1), ("p", "u", None), ("q", "r", 0), ("r", None, 0), ("r", "gone", 0)]
    e = spark.createDataFrame([("j", p, c, "CHILD", n) for p, c, n in edges], "job string, parent string, child string, rel_type string, pos int")
    assert {(r.id, r.full_text) for r in layout.block_texts(b, e).collect()} == {("r", "u v w"), ("p", "u w"), ("q", "u w v"), ("w", "w"), ("v", "v"), ("u", "u"), (None, "")}
    asked = spark.createDataFrame([("j", "p"), ("j", "p"), ("j", "none"), (None, "p")], "job string, id string")
    assert [(r.id, r.full_text) for r in layout.block_texts(b, e, asked).collect()] == [("p", "u w")]


def test_captions_and_text(spark):
    e = spark.createDataFrame([("j", 1, 0, "LAYOUT_FIGURE", "", None), ("j", 1, 1, "LAYOUT_TEXT", "Fig. 1: x", None), ("j", 1, 2, "LAYOUT_TABLE", "cells", "table-1"), ("j", 2, 3, "LAYOUT_TEXT", "end", None)], "job string, page int, n int, type string, text string, table_id string")
    assert [r.c for r in e.withColumn("c", layout.caption_near(["figure", "fig."])).orderBy("n").collect()] == ["Fig. 1: x", "", "Fig. 1: x", ""]
    tabs = spark.createDataFrame([("j", "table-1", 1, "| a |\n"), ("j", "table-2", 2, "| b |\n")], "job string, table_id string, table_ord int, markdown string").withColumn("page", F.col("table_ord"))
    assert layout.reading_text(e, tabs).first().text == "## page 1\n\n[#1 TEXT] Fig. 1: x\n\n[#2 TABLE table-1]\n| a |\n\n## page 2\n\n[#3 TEXT] end\n\n[TABLE table-2]\n| b |\n\n"


def test_exclusive_tables(spark):
    e = spark.createDataFrame([("j", 1, 0, "LAYOUT_TABLE", [0.0, 0.0, 1.0, 1.0]), ("j", 1, 1, "LAYOUT_TABLE", [0.0, 0.0, 1.0, 0.5])], "job string, page int, n int, type string, bbox array<double>")
    tabs = spark.createDataFrame([("j", 1, "a", 1, [0.0, 0.0, 1.0, 0.5]), ("j", 1, "b", 2, [0.0, 0.0, 1.0, 0.4])], "job string, page int, table_id string, table_ord int, bbox array<double>")
    assert {(r.n, r.table_id) for r in layout.exclusive_overlaps(e, tabs).collect()} == {(0, "a"), (1, "b")}
    assert {(r.n, r.table_id) for r in layout.best_overlaps(e, tabs).collect()} == {(0, "a"), (1, "a")}


def test_overlaps_of_many_copies_of_a_box(spark):
    """Equal boxes are compared once: a page with 20,000 tables and as many elements in few boxes is no product of them."""
    from time import monotonic

    from docweave.operators.layout import _crossing

    box = lambda k: F.array(k / 10, F.lit(0.0), k / 10 + 0.25, F.lit(1.0))
    e = spark.range(20000).select(F.lit("j").alias("job"), F.lit(1).alias("page"), F.col("id").cast("int").alias("n"), F.lit("LAYOUT_TABLE").alias("type"), box(F.col("id") % 5).alias("bbox"))
    tabs = spark.range(20000).select(F.lit("j").alias("job"), F.lit(1).alias("page"), F.concat(F.lit("t"), "id").alias("table_id"), F.col("id").cast("int").alias("table_ord"), box(F.col("id") % 5).alias("bbox"))
    assert _crossing(e, tabs).count() == 19
    began = monotonic()
    best = {r.n: r.table_id for r in layout.best_overlaps(e, tabs).collect()}
    assert best == {n: f"t{n % 5}" for n in range(20000)}
    assert {r.n: r.table_id for r in layout.exclusive_overlaps(e, tabs).collect()} == {n: f"t{n}" for n in range(20000)}
    assert monotonic() - began < 60


def test_grid(spark):
    cell = lambda place, r, c, text, header=False, rs=1, cs=1, merged=False: ("j", "t", place, merged, r, c, rs, cs, text, header)
    rows = [cell(0, 1, 1, "Model", True, rs=2), cell(1, 1, 2, "BLEU", True), cell(2, 1, 4, "Cost", True), cell(3, 2, 2, "EN-DE", True), cell(4, 2, 3, "EN-FR", True), cell(5, 2, 4, "FLOPs", True), cell(6, 3, 1, "x"), cell(7, 3, 2, "1"), cell(8, 3, 4, "3"), cell(9, 4, 1, "late", True)]
    df = spark.createDataFrame(rows, "job string, table_id string, place int, merged boolean, row int, col int, row_span int, col_span int, text string, header boolean")
    r = grid.restored_tables(df.repartition(4)).first()
    assert r.header == [["Model", "BLEU", "BLEU", "Cost"], ["Model", "EN-DE", "EN-FR", "FLOPs"]] and r.body[0] == ["x", "1", "", "3"] and (r.inferred, r.missing, r.stray_headers) == (1, 4, 1)


def pages(spark, rows):
    base = {"job": "j", "arrival": 0, "title": "", "abstract": "", "authors": [], "keywords": [], "sections": [], "figures": [], "tables": [], "references": [], "cont_section": None, "cont_reference": None, "model": "", "input_tokens": 1, "output_tokens": 2, "extracted_at": None, "duration_ms": 0}
    return spark.createDataFrame([base | {"arrival": i} | r for i, r in enumerate(rows)], schemas.PAGE_RESULTS)


def sec(heading, text, level=1):
    return {"level": level, "heading": heading, "text": text}


def test_merge(spark):
    ref = {"raw": "LeCun. Deep", "title": "", "authors": None, "year": 0, "venue": "", "doi": " "}
    more = {"raw": "learning.", "title": "Deep learning", "authors": ["L"], "year": 2015, "venue": "N", "doi": "10.1/x"}
    p = pages(spark, [
        {"page": 2, "sections": [sec("", "goes on"), sec("B", "b")], "cont_reference": True, "references": [more], "model": "m", "extracted_at": T0 + dt.timedelta(seconds=12), "duration_ms": 5000},
        {"page": 1, "title": " T ", "sections": [sec("A", "starts")], "references": [ref], "figures": [{"label": " F1 ", "caption": "c"}], "extracted_at": T0 + dt.timedelta(seconds=10), "duration_ms": 6000},
        {"page": 1, "title": "late"}, {"page": 0}, {"page": 4, "sections": [sec("", "new")], "cont_section": False},
    ])
    m = merge.merge_pages(p.repartition(5), spark.createDataFrame([("j", 4)], "job string, page_count int")).first()
    assert m.title == "T" and [(s.heading, s.text, s.pages) for s in m.sections] == [("A", "starts goes on", [1, 2]), ("B", "b", [2]), ("", "new", [4])]
    assert (m.references[0].raw, m.references[0].title, m.references[0].year, m.references[0].doi) == ("LeCun. Deep learning.", "Deep learning", 2015, "10.1/x")
    assert m.model == "m" and m.input_tokens == 3 and m.duration_ms == 8000 and m.extracted_at == T0 + dt.timedelta(seconds=12) and m.figures[0].id == "F1"
    assert [(w.code, w.page) for w in m.warnings] == [("invalid_page", 0), ("missing_page", 3), ("repeated_page", 1)]
    assert merge.missing_pages(p.where("page < 1")).count() == 0


def document(route="bedrock", **more):
    cost = {"textract_pages": 0, "textract_features": ["TABLES", "LAYOUT", "TABLES"], "bedrock_model": "", "input_tokens": 0, "output_tokens": 0}
    prov = {"route": route, "extracted_at": T0, "confidence": None, "cost": cost, "duration_ms": 1, "warnings": []}
    return {"job_id": "j", "schema_version": "", "source": None, "metadata": None, "sections": [], "figures": [], "tables": [], "references": [], "provenance": prov} | more


def test_normalize_twice(spark):
    ref = lambda **k: {"raw": " r ", "title": "T.", "authors": [" a ", ""], "year": 2050, "venue": None, "doi": "DOI:10.1000/A"} | k
    d = document(metadata={"title": " A  b ", "authors": [{"name": " x ", "affiliation": None, "email": None}], "abstract": None, "keywords": None, "venue": None, "year": 0, "primary_category": None}, sections=[{"level": 9, "heading": "2.1 X", "text": "a \r\nb", "pages": [3, 1, 3]}, {"level": 9, "heading": "Yes", "text": None, "pages": None}], references=[ref(), ref(doi="nonsense", year=2000)])
    once = normalize.normalize(spark.createDataFrame([d], schemas.DOCUMENT), 2026)
    twice = normalize.normalize(once, 2026)
    r = once.first()
    assert r.metadata.title == "A b" and [(s.level, s.text, s.pages) for s in r.sections] == [(2, "a\nb", [1, 3]), (4, "", [])]
    assert [(x.title, x.year, x.doi, x.authors) for x in r.references] == [("T", 0, "10.1000/a", ["a"]), ("T", 2000, None, ["a"])]
    assert r.provenance.cost.textract_features == ["LAYOUT", "TABLES"] and len(r.provenance.warnings) == 3 and r.schema_version == "1.0"
    assert [x.asDict(True) for x in once.collect()] == [x.asDict(True) for x in twice.collect()]


LAYER = "Mesh Routing for\nSmall Sensor Networks\n\nIda Holm1 Tomas Vega2\n\nAbstract\nSmall sensor networks waste much radio en-\nergy on idle listening. We present a mesh protocol that wakes each node once per round.\n\n1 Introduction\nRadio cost dominates every battery budget.\n\nFigure 1: Overview of the mesh protocol layers.\n\nTable 1: Energy per round.\nNode Idle Active\nSink 12.5 3.1\n\nReferences\n[1] P. Quill. Deep sleeping. Sensor Letters, 2015.\n"


def verification(spark, route="bedrock", confidence=None):
    ref = lambda **k: {"raw": "", "title": "", "authors": [], "year": 0, "venue": "", "doi": None} | k
    refs = [ref(raw="P. Quill. Deep sleeping. Sensor Letters, 2015.", title="Deep sleeping", doi="10.1/deep"), ref(raw="P. Quill. Deep sleeping. Sensor Letters, 2015.", doi="10.1/none"), ref(raw="Other, A. Entirely foreign attention heads.", title="Entirely foreign attention heads", doi="10.1/deep"), ref(raw="P. Quill. Deep sleeping. Sensor Letters, 2015."), ref(title="Mesh Routing for Small Sensor Networks"), ref(raw="Doe. Lost paper. 2020.", doi="10.1/down")]
    meta = {"title": "Mesh Routing for Small Sensor Networks", "authors": [{"name": n, "affiliation": "", "email": ""} for n in ("Ida Holm", "Tomas Vega", "Jane Roe")], "abstract": "Small sensor networks waste much radio energy on idle listening.", "keywords": [], "venue": "", "year": 0, "primary_category": ""}
    figs = [{"id": "f1", "caption": "Figure 1: Overview of the mesh protocol layers.", "page": 1, "bbox": None}, {"id": "f2", "caption": "Ablation over sampling temperature", "page": 1, "bbox": None}]
    tabs = [{"id": "t", "caption": "Table 1: Energy per round.", "page": 1, "bbox": None, "header": [["Node", "Idle", "Active"]], "rows": [["Sink", "12.5", "3.1"]]}]
    secs = [{"level": 1, "heading": "1 Introduction", "text": "Radio cost dominates every battery budget.", "pages": [1]}]
    d = document(route, metadata=meta, sections=secs, figures=figs, tables=tabs, references=refs)
    d["provenance"] = d["provenance"] | {"confidence": confidence}
    works = spark.createDataFrame([("10.1/deep", "Deep sleeping"), ("10.1/mesh", "Mesh flooding for large sensor swarms")], schemas.WORKS)
    down = spark.createDataFrame([("10.1/down",)], "doi string")
    layers = spark.createDataFrame([("j", LAYER, True)], "job string, text string, has_text_layer boolean")
    docs = spark.createDataFrame([d], schemas.DOCUMENT)
    return docs, layers, works, down


def test_verify_end_to_end(spark):
    docs, layers, works, down = verification(spark)
    r = verify.verify(docs, layers, works, down).first()
    f = {k: (v.original, v.items) for k, v in r.fields.items()}
    assert f["title"] == (1.0, 1) and f["authors"] == (0.6667, 3) and f["abstract"] == (1.0, 1) and f["figures"] == (0.5, 2) and f["tables"] == (1.0, 2) and f["sections"] == (1.0, 2)
    checks = references.check_references(verify.document_references(docs), works, down).orderBy("i").collect()
    assert [c.status for c in checks] == ["verified", "notFound", "mismatch", "verified", "notFound", "unavailable"]
    assert (r.verified, r.mismatch, r.not_found, r.unavailable, r.crossref) == (2, 1, 2, 1, 0.6667)
    assert [h.path for h in r.hallucinations] == ["metadata.authors[2].name", "figures[1].caption", "references[2].raw", "references[5].raw", "references[2].doi"]
    assert r.needs_review and r.original_checked and r.confidence.references == round((f["references"][0] + 0.6667) / 2, 4)


def test_verify_signals(spark):
    conf = dict.fromkeys(schemas.CONFIDENCE_FIELDS) | {"title": 0.998, "figures": 0.912}
    docs, layers, works, _ = verification(spark, "textract", conf)
    r = verify.verify(docs, layers, works).first()
    assert r.confidence.title == 0.999 and r.confidence.figures == 0.706 and r.confidence.authors == 0.6667
    bare = verify.verify(docs, layers.withColumn("has_text_layer", F.lit(False)), None).first()
    assert not bare.original_checked and bare.needs_review and bare.confidence.title == 0.998 and bare.skipped == 6 and bare.confidence.authors is None


def test_circuit_breaker(spark):
    s = ["verified", "unavailable", "unavailable", "skipped", "unavailable", "verified", "skipped", "verified"]
    df = spark.createDataFrame([("j", i, x) for i, x in enumerate(s)], "job string, i int, status string")
    got = [r.status for r in references.circuit_breaker(df, limit=7).orderBy("i").collect()]
    assert got == ["verified", "unavailable", "unavailable", "skipped", "unavailable", "unavailable", "unavailable", "skipped"]


def test_breaker_takes_matches_along(spark):
    df = spark.createDataFrame([("j", i, s, 0.2, "d") for i, s in enumerate(["verified", "unavailable", "unavailable", "unavailable", "verified", "mismatch", "verified"])], "job string, i int, status string, similarity double, matched_doi string")
    got = references.circuit_breaker(df, limit=6).orderBy("i").collect()
    assert [r.similarity for r in got] == [0.2, 0.2, 0.2, 0.2, None, None, None] and got[4].matched_doi is None and got[6].status == "skipped"


def test_substrings_by_blocks(spark):
    needles = spark.createDataFrame([(1, "ab cd"), (2, "cde"), (3, "Ab"), (4, "..."), (5, "cde")], "value_id long, value string")
    texts = spark.createDataFrame([("x", "zabcdé"), ("y", "AB c-d e"), ("z", None), ("e", "")], "text_id string, text string")
    want = {(1, "x"), (3, "x"), (1, "y"), (2, "y"), (3, "y"), (5, "y")}
    for limit in (1 << 20, 4):
        assert {tuple(r) for r in scoring.substring_matches(needles, texts, limit).collect()} == want
    assert scoring.substring_matches(needles.where("value_id = 4"), texts).count() == 0


def test_jobs(spark):
    at = lambda n: T0 + dt.timedelta(hours=n)
    none = spark.createDataFrame([], schemas.JOBS)
    ask = lambda *rows: spark.createDataFrame(list(rows), "job string, filename string, at timestamp")
    now, conflicts = jobs.register(none, ask(("a", "f", at(0)), ("b", "g", at(0))))
    assert {r.status for r in now.collect()} == {"PROCESSING"} and conflicts.count() == 0
    now, refused = jobs.mark_failed(now, spark.createDataFrame([("a", "bad", at(1)), ("b", "", at(1)), ("x", "r", at(1))], "job string, reason string, at timestamp"))
    assert {(r.job, r.problem) for r in refused.collect()} == {("b", "reason_missing"), ("x", "not_found")}
    now, conflicts = jobs.register(now, ask(("a", "f2", at(2)), ("b", "g2", at(2))))
    assert [(r.job, r.filename, r.decision.code) for r in conflicts.collect()] == [("b", "g", "IN_PROGRESS")]
    now, refused = jobs.update_status(now, spark.createDataFrame([("a", "COMPLETED", at(3)), ("b", "FAILED", at(3)), ("y", "COMPLETED", at(3))], "job string, status string, at timestamp"))
    assert {(r.job, r.problem) for r in refused.collect()} == {("b", "invalid_status"), ("y", "not_found")}
    assert {(r.job, r.status, r.error_reason) for r in now.collect()} == {("a", "COMPLETED", None), ("b", "PROCESSING", None)}
    back, bad = jobs.decoded(jobs.encoded(now))
    assert {tuple(r) for r in back.collect()} == {tuple(r) for r in now.collect()} and bad.count() == 0
    assert [r.job for r in jobs.list_by_status(now, "COMPLETED", 5).collect()] == ["a"] and jobs.get_job(now, "b").count() == 1
    with pytest.raises(Exception):
        jobs.encoded(now.withColumn("status", F.lit("?"))).collect()


def test_compare_and_finalize(spark):
    docs, layers, works, down = verification(spark, "textract")
    p = pages(spark, [{"page": 1, "title": "MESH routing  for Small Sensor Networks", "sections": [sec("1 introduction", "x")]}])
    j = spark.createDataFrame([("j", False, 2), ("k", True, 1), ("", False, 1)], "job string, skipped boolean, page_count int")
    out = finalize.finalize(j, docs, p, layers, works, 2026, down)
    c = {r.job: r for r in out["comparison"].collect()}
    assert set(c) == {"j", "k"} and c["j"].status == "REVIEW_PENDING" and c["j"].bedrock.missing_pages == 1 and c["j"].diff.title.equal and c["j"].diff.headings.equal and not c["j"].diff.counts.figures.equal
    assert (c["k"].status, c["k"].needs_review, c["k"].textract.status, c["k"].bedrock.status, c["k"].diff) == ("FAILED", False, "skipped", "failed", None)
    assert out["documents"].count() == 2 and out["reports"].count() == 2


@pytest.mark.parametrize("a,b,ra,rb,want", [("succeeded", "succeeded", False, False, ("COMPLETED", False)), ("succeeded", "succeeded", False, True, ("REVIEW_PENDING", True)), ("succeeded", "failed", False, False, ("REVIEW_PENDING", True)), ("skipped", "succeeded", False, False, ("COMPLETED", False)), ("skipped", "failed", False, False, ("FAILED", False)), ("failed", "failed", True, True, ("FAILED", False))])
def test_decisions(spark, a, b, ra, rb, want):
    assert tuple(spark.range(1).select(compare.decision(F.lit(a), F.lit(b), F.lit(ra), F.lit(rb)).alias("d")).first().d) == want


def test_outline_ranges(spark):
    e = spark.createDataFrame([("j", i, 1 + i // 2, "LAYOUT_TEXT" if i != 1 else "LAYOUT_FIGURE", None, f"t{i}") for i in range(4)], "job string, n int, page int, type string, table_id string, text string")
    o = spark.createDataFrame([("j", 0, 1, "a", 0, 2), ("j", 1, 1, "b", -1, -1), ("j", 2, 1, "c", 3, 4), ("j", 3, 1, "d", 2, 1)], "job string, idx int, level int, heading string, from_ord int, to_ord int")
    got = finalize.layout_documents(e, o).orderBy("idx").collect()
    assert [(r.text, r.pages, r.bad_range) for r in got] == [("t0\n\nt2", [1, 2], False), ("", [], False), ("", [], True), ("", [], True)]
    refs = spark.createDataFrame([("j", 0, 3, "own"), ("j", 1, 9, " own "), ("j", 2, None, "own")], "job string, idx int, element int, raw string")
    assert [(r.raw, r.bad_pointer) for r in finalize.outline_references(refs, e).orderBy("idx").collect()] == [("t3", False), ("own", True), ("own", False)]


def test_corpus(spark, tmp_path):
    feed = '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom"><entry><id>http://arxiv.org/abs/2608.20318v1</id><title>A\n  b</title><published>2026-08-20T00:00:00Z</published><category term="cs.CL"/><category term=""/><arxiv:primary_category term="cs.CL"/></entry><entry><id>http://arxiv.org/abs/2608.1v1</id><title>x</title><published>z</published></entry></feed>'
    (tmp_path / "f.xml").write_text(feed)
    rows = corpus.entry_rows(readers.feed(spark, str(tmp_path / "f.xml"))).collect()
    assert [(r.arxiv_id, r.version, r.title, r.categories, r.primary) for r in rows] == [("2608.20318", "v1", "A b", ["cs.CL"], "cs.CL")]
    entries = spark.createDataFrame([(str(i), i, T0 + dt.timedelta(days=i)) for i in range(6)], "arxiv_id string, pages int, published timestamp")
    known = spark.createDataFrame([("5",)], "arxiv_id string")
    assert [r.arxiv_id for r in corpus.select_papers(entries, known, 2, 4, 2).collect()] == ["4", "3"]
    m = spark.createDataFrame([("a", 0, "old"), ("b", 1, "old")], "arxiv_id string, ord int, v string")
    up = corpus.upsert(m, spark.createDataFrame([("b", "new"), ("c", "new")], "arxiv_id string, v string"))
    assert [(r.arxiv_id, r.v) for r in up.orderBy("ord").collect()] == [("a", "old"), ("b", "new"), ("c", "new")]
    with pytest.raises(ValueError):
        corpus.lookup(entries, [])


def test_sources_and_sinks(spark, tmp_path):
    d = tmp_path / "uploads" / "abc"
    d.mkdir(parents=True)
    (d / "original.pdf").write_bytes(b"x%PDF-1.7 body")
    r = readers.uploads(spark, str(tmp_path)).first()
    assert r.job == "abc" and r.is_pdf and len(r.sha256) == 64
    lines = tmp_path / "l.json"
    lines.write_text('{"a": 1}\nbroken\n')
    rows, bad = readers.json_with_rejects(spark, str(lines), "a INT")
    assert [x.a for x in rows.collect()] == [1] and [x.raw for x in bad.collect()] == ["broken"]
    root = str(tmp_path / "snap")
    assert writers.read_snapshot(spark, root) == (None, -1)
    writers.write_snapshot(spark.range(3), root, 1)
    writers.write_snapshot(spark.range(5), root, 2)
    now, version = writers.read_snapshot(spark, root)
    assert now.count() == 5 and version == 2
    assert readers.manifest(spark, str(tmp_path / "none"), schemas.PAPERS).count() == 0
    paged = spark.createDataFrame([("j", 1, "t", "OK"), ("j", 2, "t", "OK"), ("j", 3, "u", "OK")], "job string, seq int, next_token string, status string")
    assert {x.problem for x in readers.paged(paged).collect()} == {"repeated_token", "token_on_last"}


def test_streams(spark, tmp_path):
    from docweave.streaming import flows, stores

    for job, body in (("a", b"%PDF-1"), ("b", b"%PDF-1"), ("c", b"nothing")):
        (tmp_path / "uploads" / job).mkdir(parents=True)
        (tmp_path / "uploads" / job / "original.pdf").write_bytes(body)
    (tmp_path / "work").mkdir()
    (tmp_path / "work" / "x.pdf").write_bytes(b"%PDF-2")
    infos = spark.createDataFrame([(j, False, 3) for j in "abc"], "job string, encrypted boolean, pages int")
    stream = flows.upload_changes(flows.validated(flows.once_by_content(flows.upload_stream(spark, str(tmp_path)), "modificationTime"), infos))
    write = stores.job_writer(str(tmp_path / "jobs"), str(tmp_path / "refused"))
    for _ in range(2):
        flows.run_once(stream.writeStream.foreachBatch(write), str(tmp_path / "state"))
    now = stores.read_jobs(spark, str(tmp_path / "jobs"))
    assert now.count() == 2 and {r.status for r in now.collect()} == {"FAILED"} and {r.error_reason for r in now.collect()} == {"HASH_MISMATCH", "NOT_PDF"}


def test_answers_are_saved_raw_and_replayed(spark, tmp_path):
    pages = spark.createDataFrame([("a", 1, "t1", "SUCCEEDED"), ("a", 2, None, "FAILED"), ("b", 1, "t", "SUCCEEDED"), ("b", 2, "t", "SUCCEEDED"), ("b", 3, None, ""), ("c", 1, None, "FAILED"), ("d", 1, None, "")], "job string, seq int, next_token string, status string")
    whole, problems = readers.whole_answers(pages)
    assert sorted((r.job, r.seq) for r in whole.collect()) == [("a", 1), ("a", 2)]
    assert {tuple(r) for r in problems.collect()} == {("b", "repeated_token"), ("c", "not_succeeded"), ("d", "status_missing")}
    asked = spark.createDataFrame([("a", None), ("a", "t1"), ("a", "other")], "job string, token string")
    assert {r.token: r.seq for r in readers.replay_pages(asked, pages).collect()} == {"": 1, "t1": 2, "other": None}
    answers = readers.replay_answers(spark.createDataFrame([("p", "layout"), ("p", "x")], "paper string, route string"), spark.createDataFrame([("p-layout", "yes")], "record string, answer string"))
    assert {r.route: r.answer for r in answers.collect()} == {"layout": "yes", "x": None}
    bodies = writers.recorded_bodies(spark.createDataFrame([("u", 200, '{"a": 1}'), ("v", 500, "gone away"), ("w", 204, None)], "url string, status int, content string"))
    assert [(r.body, r.text) for r in bodies.orderBy("url").collect()] == [('{"a": 1}', None), (None, "gone away"), (None, None)]
    calls = spark.createDataFrame([("j", 1, None, "SUCCEEDED"), ("j", 2, "t", "SUCCEEDED"), ("j", 3, None, "IN_PROGRESS"), ("j", 4, None, "SUCCEEDED"), ("j", 5, "t", None)], "job string, at int, token string, status string")
    assert [(r.at, r.page) for r in writers.recording(calls).orderBy("at").collect()] == [(4, 1), (5, 2)]

    def fails(df):
        raise ValueError("not readable")

    one = spark.createDataFrame([("a", "{")], "job string, raw string")
    with pytest.raises(ValueError):
        writers.raw_first(f"{tmp_path}/raw", f"{tmp_path}/out", fails)(one, 3)
    assert spark.read.parquet(f"{tmp_path}/raw/batch=3").collect() == one.collect()
    for _ in range(2):
        writers.raw_first(f"{tmp_path}/raw", f"{tmp_path}/out", lambda d: d.withColumn("n", F.length("raw")))(one, 3)
    assert [r.n for r in spark.read.parquet(f"{tmp_path}/out/batch=3").collect()] == [1]
    resumed, late = jobs.respond(spark.createDataFrame([("x", None), ("y", "bad"), ("z", None), (None, None)], "token string, error string"), spark.createDataFrame([("x",), ("y",), ("y",), (None,)], "token string"))
    assert {tuple(r) for r in resumed.collect()} == {("x", None, "resumed"), ("y", "bad", "failed")} and {r.token for r in late.collect()} == {"z", None}


def test_a_grid_takes_one_exchange(spark):
    from docweave.operators import grid

    cells = spark.createDataFrame(
        [("j", "a", 0, False, 1, 1, 1, 2, "h", True), ("j", "a", 1, True, 1, 2, 2, 1, "m", False), ("j", "a", 2, False, 3, 3, None, None, None, False), ("j", "a", 3, False, 0, 1, 1, 1, "out", True), ("j", "b", 0, False, 1, 2, 1, 1, "z", True)],
        "job string, table_id string, place int, merged boolean, row int, col int, row_span int, col_span int, text string, header boolean",
    )
    g = grid.full_grid(cells)
    got = {(r.table_id, r.r, r.c): (r.text, r.filled, r.is_header) for r in g.collect()}
    assert got == {
        ("a", 1, 1): ("h", True, True), ("a", 1, 2): ("m", True, True), ("a", 1, 3): ("m", False, True), ("a", 2, 1): ("", False, False), ("a", 2, 2): ("m", True, False), ("a", 2, 3): ("", False, False),
        ("a", 3, 1): ("", False, False), ("a", 3, 2): ("", False, False), ("a", 3, 3): ("", True, False), ("b", 1, 1): ("", False, True), ("b", 1, 2): ("z", True, True),
    }
    assert g._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning") == 1

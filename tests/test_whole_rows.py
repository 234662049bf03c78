"""Queries over every row and the whole text, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from docweave.operators import compare, references, scoring
from docweave.plans import composites, finalize, layout_route
from docweave.plans.catalogue import QUERIES
from docweave.schemas import BLOCK_EDGES, BLOCKS


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("tables"))
    put = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{out}/{name}.parquet")
    tail = " ".join(f"w{i}" for i in range(40))
    # Document 1 (odd) holds only the first 12 words of item 1; item 2 stands whole in document 2.
    put("documents", [(1, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 end"), (2, "x " + tail), (3, "alone")], "doc_id long, text string")
    put("benchmark", [(1, tail), (2, tail)], "item_id long, text string")
    put("part", [(50 * i, 10 + i) for i in range(1, 8)], "p_partkey long, p_size int")
    put("conversations", [(1, t, "user" if t == 0 else "assistant", f"t{t}") for t in range(8)], "conv_id long, turn int, role string, text string")
    events = spark.createDataFrame([(1, 5, "error", 10), (2, 5, "purchase", 20), (3, 10, "error", 30), (4, 15, "view", 40)], "event_id long, user_id long, event_type string, at int")
    events.select("event_id", "user_id", "event_type", F.timestamp_seconds("at").alias("ts")).write.parquet(f"{out}/events.parquet")
    return out


def test_every_value_is_scored_whole(spark, sf):
    flags = {(r.job, r.value[:5]): r.score for r in QUERIES["hallucination_flags"](spark, sf).collect()}
    assert flags == {(1, "w0 w1"): round(11 / 39, 4)}
    review = {r.job: (r["items"], r.needs_review) for r in QUERIES["review_flag"](spark, sf).collect()}
    assert review == {1: (2, True), 2: (2, False), 3: (1, False)}


def test_vocabulary_is_made_once(spark):
    values = spark.createDataFrame([(1, "a b c"), (2, "a"), (3, None)], "value_id long, value string")
    texts = spark.createDataFrame([(1, "B a c d"), (2, "a"), (3, ""), (4, None), (5, "x b-\na c")], "text_id long, text string")
    out = scoring.pair_coverage(values, texts)
    assert {(r.value_id, r.text_id, r.hits, r.pairs, r.score) for r in out.collect()} == {(1, 1, 1, 2, 0.5), (1, 5, 1, 2, 0.5)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Filter" in x and "regexp_extract_all" in x]


def test_vocabulary_is_made_only_where_asked(spark):
    values = spark.createDataFrame([(1, "a b c", True), (1, "c", False), (2, "b a", True), (3, "q", True), (4, "--", True), (4, None, True)], "job long, value string, short boolean")
    layers = spark.createDataFrame([(1, "x a b c"), (1, "x a b c"), (1, "b a c"), (2, "a b"), (3, "."), (4, "z")], "job long, text string")
    out = scoring.score_values(values, layers)
    got = sorted(((r.job, r.value or "", r.score) for r in out.collect()), key=str)
    assert got == sorted([(1, "a b c", 1.0), (1, "a b c", 1.0), (1, "a b c", 0.5), (1, "c", 1.0), (1, "c", 1.0), (1, "c", 1.0), (2, "b a", 1.0), (3, "q", None), (4, "--", None), (4, "", None)], key=str)
    assert "LeftSemi" in out._jdf.queryExecution().optimizedPlan().toString()


def test_every_part_meets(spark, sf):
    size = {50 * i: 10 + i for i in range(1, 8)}

    def area(n, o):
        a, b, c, d = size[n] / 100, size[n] / 200, size[o] / 90, size[o] / 150
        return max(0, min(a, c) + 0.2 - max(a, c)) * max(0, min(b, d) + 0.2 - max(b, d))

    got = {r.n: r.table_id for r in QUERIES["overlap_match"](spark, sf).collect()}
    assert got == {n: f"t{max(size, key=lambda o: (round(area(n, o), 9), -o))}" for n in size}
    assert {r.n for r in QUERIES["overlap_exclusive"](spark, sf).collect()} <= set(size)


def test_every_turn_is_merged(spark, sf):
    assert sum(r.parts for r in QUERIES["turn_islands"](spark, sf).collect()) == 8


def test_every_event_counts(spark, sf):
    # Users 5, 10, 15: job 2u is set and asked for, -1-2u only set, 2u+1 only asked for.
    got = {r.job: (r.status, r.filename) for r in QUERIES["job_upsert"](spark, sf).collect()}
    assert got == {10: ("COMPLETED", "f2"), -11: ("COMPLETED", "f2"), 11: ("PROCESSING", "g1"), 20: ("PROCESSING", "g3"), -21: ("FAILED", "f3"), 21: ("PROCESSING", "g3"), 30: ("PROCESSING", "f4"), -31: ("PROCESSING", "f4"), 31: ("PROCESSING", "g4")}
    assert {r.job: r.code for r in QUERIES["job_conflicts"](spark, sf).collect()} == {10: "ALREADY_PROCESSED", 30: "IN_PROGRESS"}
    assert {r.job: r.status for r in QUERIES["job_status_updates"](spark, sf).collect()} == {10: "REVIEW_PENDING", -11: "COMPLETED", 20: "COMPLETED", -21: "FAILED", 30: "PROCESSING", -31: "PROCESSING"}


def test_title_is_matched_whole(spark, sf):
    # Item 1 agrees with document 1 on its first 60 characters only.
    got = {r.i: r for r in QUERIES["title_match"](spark, sf).collect()}
    assert got[1].matched_doi == got[2].matched_doi == "10.1/2" and got[1].matched_title.endswith("w39") and got[2].status == "verified"


@pytest.mark.parametrize("common", [0, 2, 6, 10_000])
def test_common_tokens_rank_and_propose(spark, common):
    rnd = random.Random(5)
    words = [f"a{i}" for i in range(6)] + [f"b{i}" for i in range(60)]
    pick = lambda: " ".join(rnd.choice(words[:6] if rnd.random() < 0.6 else words) for _ in range(rnd.randint(1, 7)))
    works = [(f"d{i:03}", pick()) for i in range(120)]
    refs = [("j", i, None, pick() if i % 2 else works[i][1], "") for i in range(40)]
    have = {d: set(x.split()) for d, x in works}
    n = {w: sum(w in s for s in have.values()) for w in words}
    want = {}
    for _, i, _, title, _ in refs:
        mine = set(title.split())
        got = sorted((-round(sum(1 / n[w] for w in sorted(mine & s)), 12), d) for d, s in have.items() if mine & s)
        want[i] = [d for _, d in got[:3]]
    w = spark.createDataFrame(works, "doi string, title string")
    r = spark.createDataFrame(refs, "job string, i int, doi string, title string, raw string")
    mine = r.select("job", "i", F.explode(F.array_distinct(F.split("title", " "))).alias("token"))
    got = {}
    for x in references.best_candidates(mine, w, common).orderBy("i", "rank").collect():
        got.setdefault(x.i, []).append(x.doi)
    assert got == {i: d for i, d in want.items() if d}
    found = {x.i: x for x in references.search_titles(r, w, common).collect()}
    assert all(found[i].matched_doi is not None for i in range(0, 40, 2))


def test_title_search_meets_works_by_rare_tokens(spark, monkeypatch):
    """A reference of common tokens and a rare one that three works have meets these works, not all that share a common token."""
    works = [(f"d{i:03}", "the of and " + ("rare" if i < 3 else f"x{i}")) for i in range(300)] + [("d900", "the the"), ("d900", "of")]
    mine = spark.createDataFrame([("j", i, w) for i in range(5) for w in ("the", "of", "and", "rare", "gone")], "job string, i int, token string")
    sizes, plain = [], references.written
    monkeypatch.setattr(references, "written", lambda df: (lambda x: (sizes.append((x.columns, x.count())), x)[1])(plain(df)))
    got = references.best_candidates(mine, spark.createDataFrame(works, "doi string, title string")).orderBy("i", "rank").collect()
    assert [(x.i, x.doi, x.rank) for x in got] == [(i, f"d00{k}", k + 1) for i in range(5) for k in range(3)]
    assert max(n for cols, n in sizes if "doi" in cols and "i" in cols) == 15


def exchanges(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange")


def test_chunks_and_chains_in_one_pass(spark):
    from docweave.sources import readers, writers

    counts = spark.createDataFrame([("a", 30), ("b", 50), ("c", 0)], "job string, page_count int")
    pages = spark.createDataFrame([("a", p) for p in (*range(1, 31), 30, 31)] + [("b", p) for p in (1, 1, 2, 26)], "job string, page int")
    for size, want in ((25, {("b", 0, 25, 2), ("b", 1, 25, 1)}), (100, {("b", 0, 50, 3)})):
        got = writers.chunk_problems(pages, counts, size)
        assert {tuple(x) for x in got.collect()} == want
    assert "explode(sequence(1" not in writers.chunk_problems(pages, counts)._jdf.queryExecution().optimizedPlan().toString()
    r = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("a", 3, "x"), ("b", 1, None), ("b", 2, "")], "job string, seq int, next_token string")
    assert exchanges(readers.paged(r)) == 1
    assert sorted(tuple(x) for x in readers.paged(r).collect()) == [("a", "repeated_token"), ("a", "token_on_last"), ("b", "token_missing")]


def test_diff_reads_no_texts(spark, tmp_path, monkeypatch):
    """Documents are compared without their texts being read or written, and alike."""
    roles = ("user", "assistant", "system", None)
    rows = [(c, t, roles[(c * t + t) % 4], None if (c + t) % 9 == 8 else f"Turn {t}\n of  {c % 3}.") for c in range(1, 9) for t in range(c + 4)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    whole = compare.diff(*composites._normal(spark, str(tmp_path))).collect()
    monkeypatch.setattr(layout_route, "written", lambda df: pytest.fail("texts are written"))
    merged = finalize.page_documents
    seen = []
    monkeypatch.setattr(finalize, "page_documents", lambda *a: seen.append(merged(*a)) or seen[-1])
    got = {r.job_id: r for r in QUERIES["document_diff"](spark, str(tmp_path)).collect()}
    assert len(whole) == 6 and set(got) == {r.job_id for r in whole}
    for w in whole:
        g = got[w.job_id]
        assert (g.same_title, g.title, g.same_authors, g.same_abstract, g.same_headings) == (w.title.equal, w.title.textract, w.authors.equal, w.abstract.equal, w.headings.equal)
        assert (g.same_references, g.figures, g.layout_figures, g.same_sections) == (w.counts.references.equal, w.counts.figures.bedrock, w.counts.figures.textract, w.counts.sections.equal)
    assert {x.text for r in seen[0].collect() for x in r.sections} == {""}


def test_outline_has_the_documents_of_the_whole_reading(spark):
    """Lists of layout blocks, lines beside them, tables alone: the outline counts what the reading counts."""
    kinds = {"a": ["LAYOUT_LIST", "LAYOUT_TEXT", "LAYOUT_FIGURE", "LAYOUT_FIGURE"], "b": ["TABLE", "TABLE"], "c": ["LINE"], "d": ["WORD"], "e": ["LAYOUT_LIST", "LAYOUT_LIST"], "f": ["LAYOUT_FIGURE", "LINE", "TABLE"]}
    blocks = spark.createDataFrame([(j, f"b{i}", k, i) for j, ks in kinds.items() for i, k in enumerate(ks)], "job string, id string, block_type string, ord int")
    edges = spark.createDataFrame([("a", "b0", "b1"), ("e", "b0", "b1"), ("e", "b1", "b0")], "job string, parent string, child string").withColumns({"rel_type": F.lit("CHILD"), "pos": F.lit(0)})
    given = composites._cast(blocks, BLOCKS), composites._cast(edges, BLOCK_EDGES)
    one = F.array(F.struct(F.lit(1).alias("level"), F.lit("h").alias("heading"), F.lit(0).alias("from"), F.lit(0).alias("to")))
    answers = composites._cast(blocks.select("job").distinct().withColumn("sections", one), layout_route.ANSWERS)
    of = lambda reading: sorted((r.job_id, r.sizes.sections, r.sizes.figures, r.sizes.tables, r.sizes.references, r.headings) for r in compare.parts(layout_route.documents(reading, answers)).collect())
    got = of(layout_route.outline(*given))
    assert got == of(layout_route.read(*given)) and [x[:4] for x in got] == [("a", 1, 2, 0), ("b", 1, 0, 2), ("c", 1, 0, 0), ("f", 1, 1, 1)]

"""The similarity join, the trained models, the licence scan and the pipeline, against plain versions."""

import random
import re
import zlib

import numpy as np

from docweave.llm import html_extract, jaccard_join, licences, quality_classifier
from docweave.llm.components import components

from . import brute
from .test_operators import SF, documents, pairs


def classes(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicate_classes(df).collect()}


def test_components(spark):
    rnd = random.Random(2)
    links = [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)] + [(2000, i) for i in range(2001, 2100)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        up[b] = a
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}


def test_join_on_documents(spark):
    d = documents(spark)
    assert classes(d) == brute.jaccard_components(pairs(d))


def near_copies(seed, groups, copies, low, high):
    rnd = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rnd.randint(0, 200)}" for _ in range(rnd.randint(low, high))]
        for _ in range(copies):
            w = base[:]
            for _ in range(rnd.randint(0, max(1, len(w) // 25))):
                at = rnd.randrange(len(w))
                w[at : at + rnd.randint(0, 1)] = [f"x{rnd.randint(0, 10**6)}"][: rnd.randint(0, 1)]
            rows.append((len(rows) * 7 + 3, " ".join(w)))
    rnd.shuffle(rows)
    return rows


def test_join_of_near_copies(spark):
    rows = near_copies(1, 12, 9, 5, 200) + [(100_000 + i, t) for i, (_, t) in enumerate(near_copies(2, 40, 4, 1, 14))]
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == brute.jaccard_components(rows)


def test_join_of_many_short_texts(spark):
    rnd = random.Random(8)
    rows = []
    for _ in range(150):
        w = [f"w{rnd.randint(0, 30)}" for _ in range(rnd.randint(5, 11))]
        rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join([*w, "z"])), (len(rows) + 2, " ".join(w[1:]))]
    assert classes(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)) == brute.jaccard_components(rows)


def test_join_of_large_groups_and_shared_passages(spark, monkeypatch):
    """Groups beyond the pair limit, and texts that share a passage but are otherwise unlike."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rnd = random.Random(4)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = near_copies(3, 2, 90, 60, 90)
    rows += [(50_000 + i, " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(25)) + " " + passage + " " + " ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(5, 30)))) for i in range(120)]
    rows += [(60_000 + i, passage + f" q{i // 2} r{i % 3}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute.jaccard_components(rows)
    assert classes(df) == want
    kept = {r.doc_id for r in jaccard_join.near_duplicates_removed(df).collect()}
    assert kept == {c for _, c in want.values()}
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)  # everything by joins
    assert classes(df) == want


def test_join_of_odd_tables(spark):
    assert classes(spark.createDataFrame([], "doc_id long, text string")) == {}
    got = jaccard_join.near_duplicate_classes(spark.createDataFrame([(1, None), (2, ""), (3, "a b"), (4, "A  b"), (4, "A  b"), (None, "a b")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in got) == [(0, 1, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 3), (4, 1, 3)]


def test_slot_bound():
    """Differing slots never outnumber the symmetric difference."""
    rnd = np.random.default_rng(0)
    a = np.unique(rnd.integers(0, 1 << 63, 300).astype(np.uint64))
    b = np.unique(np.concatenate([a[:270], rnd.integers(0, 1 << 63, 20).astype(np.uint64)]))
    c = np.unique(np.concatenate([b, rnd.integers(0, 1 << 63, 400).astype(np.uint64)]))  # of another length
    s = [jaccard_join.parity_sketches(x, np.array([0, len(x)]))[0] for x in (a, b, c)]
    assert len(s[0]) < len(s[2])
    for x, y, left, right in ((a, b, s[0], s[1]), (a, c, s[0], s[2]), (b, c, s[1], s[2])):
        assert jaccard_join.bits_apart([left], [right])[0] <= len(np.setxor1d(x, y))
    assert jaccard_join.bits_apart(s, s).tolist() == [0, 0, 0]


def test_quality_classifier(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = quality_classifier.fit_quality(d, labels)
    got = {r.doc_id: r for r in quality_classifier.quality_scores(d, model).collect()}
    assert all(r.held_out == (zlib.crc32(str(k).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for k, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) >= 0.95
    # The linear-time identity against all pairs.
    d1, b1, v1, s1 = quality_classifier.features(np.frombuffer(b"the cat sat", np.uint8), np.array([0, 11]), np.array([11.0]))
    rows, cols, x, n = model._rows(d1, b1, v1, s1)
    pairwise = sum(float(model.v[cols[i]] @ model.v[cols[j]]) * x[i] * x[j] for i in range(len(x)) for j in range(i))
    assert abs(model.w0 + float(model.w[cols] @ x) + pairwise - model._sums(rows, cols, x, n)[1][0]) < 1e-4
    kept = quality_classifier.rejected_removed(d, model)
    assert kept.columns == d.columns and {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.score >= 0.5}


def test_quality_odd_tables(spark):
    d = documents(spark)
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    model = quality_classifier.fit_quality(d, none)
    assert {r.score for r in quality_classifier.quality_scores(d, model).collect()} == {0.5}
    assert quality_classifier.quality_scores(d.limit(0), model).count() == 0


def test_html_pages(spark):
    import html

    p = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_extract.main_text(p).collect()}
    for r in p.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r.page_id].text == "\n\n".join(x for x in parts if x) and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_html_unseen_pages():
    rnd = random.Random(12345)
    for _ in range(60):
        found, y = html_extract.example(rnd)
        assert (html_extract.labeller().label([found])[0] == (y > 0)).mean() > 0.9


def test_labels_come_from_the_recurrence():
    """On flat pages only the blocks around a paragraph tell what it is: without recurrence labels get worse."""
    model, cut = html_extract.labeller(), html_extract.BlockLabeller()
    cut.p = {k: v * 0 if k.startswith("wh") else v for k, v in model.p.items()}
    rnd = random.Random(77)
    pages = [html_extract.example(rnd, flat=True) for _ in range(150)]
    right = lambda m: np.concatenate([k == (y > 0) for k, (_, y) in zip(m.label([f for f, _ in pages]), pages)]).mean()
    assert right(model) > 0.97 and right(cut) < right(model) - 0.02


def test_page_without_article():
    story = [f"The river rose by {k} feet on day {k}, and the town moved its boats to higher ground." for k in range(1, 6)]
    page = "<html><body><p><a href=/>Home</a></p><p><a href=/n>News</a></p><h1>High water</h1>" + "".join(f"<p>{x}</p>" for x in story) + "<h3>Comments (2)</h3><p>I saw it from the bridge and it was quite something.</p><p>Me too, we stayed up all night.</p><p>© 2020 The Paper</p></body></html>"
    assert html_extract.main_texts([page], html_extract.labeller()) == ["\n\n".join(["High water", *story])]


def test_pages_are_read_in_linear_time():
    import time

    texts = lambda page: [b.text for b in html_extract.blocks(page)]
    assert texts('<a title="oops>link</a> end') == ["link end"] and texts("<p title='a>b' x=\"y\">c</p>") == ["c"] and texts("a < b <p>c") == ["a < b", "c"]
    for page in ("<p " * 200_000 + '"', "<p x='" * 100_000, "<div>" * 100_000 + "x", "<b>" * 50_000 + "</i>" * 50_000, "<div><span>" * 50_000 + "</b>" * 50_000, "<!--" * 100_000, "<p>word</p>" * 60_000, "<article><p>" + "long words here " * 600_000):
        at = time.time()
        html_extract.vectors(html_extract.blocks(page))
        assert time.time() - at < 20


def test_html_odd_pages(spark):
    odd = [None, "", "plain text", "<p>a<p>b", "<!-- x", "<script>var a='<p>'", "<article><p>One &amp; two&nbsp;three.<p>Four</article>", "<" * 500, "<div>" * 3000 + "x", "<p>a</p>" * 20_000]
    rows = [(i, "u", h) for i, h in enumerate(odd)]
    got = html_extract.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(got) == len(odd) and got[0].text == got[1].text == ""
    assert [b.text for b in html_extract.blocks("<article><p>One &amp; two&nbsp;three.<p>Four</article>")] == ["One & two three.", "Four"]
    assert html_extract.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_labeller_gradients():
    rnd = random.Random(1)
    m = html_extract.BlockLabeller()
    pages = [html_extract.example(rnd) for _ in range(2)]
    x, mask, y = html_extract._padded([html_extract.vectors(f) for f, _ in pages], [t for _, t in pages])
    x = x.astype(float)
    _, g = m.gradients(x, mask, y)
    for k in ("wxf", "whf", "bb", "whb", "wo"):
        i = tuple(np.unravel_index(np.argmax(np.abs(g[k])), g[k].shape))
        old, e, out = m.p[k][i], 1e-5, []
        for s in (1, -1):
            m.p[k][i] = old + s * e
            out.append(m.gradients(x, mask, y)[0])
        m.p[k][i] = old
        assert abs((out[0] - out[1]) / (2 * e) - g[k][i]) < 1e-4 * max(1, abs(g[k][i]))


def _bigrams(w):
    return set(zip(w, w[1:]))


def _licence_runs(text, templates):
    """(template, words) of runs of two or more lines, each with half of its word pairs in the template."""
    lines = [w for w in (brute.ALNUM.findall(brute.lower(x)) for x in text.split("\n"))]
    for name, b in templates.items():
        run, held = [], []  # lines of the run, short lines that wait for the next one of it
        for w in [*lines, ["end", "of", "text"]]:
            if len(w) < 2:
                held.append(w)
            elif 2 * sum(x in b for x in zip(w, w[1:])) >= len(w) - 1:
                run = [*run, *held, w] if run else [w]
                held = []
            else:
                if sum(len(x) > 1 for x in run) > 1:
                    yield name, [x for y in run for x in y]
                run, held = [], []


def test_licences(spark):
    d = documents(spark)
    mit, bsd = licences.TEMPLATES["mit"], licences.TEMPLATES["bsd-2-clause"]
    wrapped = lambda text, mark: "\n".join(mark + " ".join(text.split()[i : i + 9]) for i in range(0, len(text.split()), 9))
    prose = "\n".join(f"line {i} of a story that has nothing to do with it at all" for i in range(60))
    texts = [
        mit, "intro\n\n" + mit.replace(". ", ".\n") + "\n\nend", "Released under the MIT License!\nx", wrapped(mit, "# "), prose + "\n" + wrapped(mit, " * ").replace("\n", "\r\n") + "\r\n" + prose,
        prose + "\n\n" + bsd.replace(": 1.", ":\n\n1.").replace(" 2. ", "\n\n2. ").replace(" THIS", "\n\nTHIS") + "\n\n" + prose, wrapped(mit, "// ") + "\n" + prose + "\n" + wrapped(mit, "// "), bsd, licences.TEMPLATES["unlicense"], "of\nthe software\n\nthe software\nin no event", "the software\n" * 5,
    ]
    d = d.union(spark.createDataFrame([(9001 + i, x, "", "", 0) for i, x in enumerate(texts)], d.schema))
    t = {k: _bigrams(brute.ALNUM.findall(brute.lower(v))) for k, v in licences.TEMPLATES.items()}
    got = {r.doc_id: r for r in licences.licence_scan(d).collect()}
    for k, text in pairs(d):
        want, words = {}, [(None, brute.ALNUM.findall(brute.lower(s))) for s in {*(text or "").split("\n"), *(text or "").split("\n\n"), text or ""}]
        for one, w in [*words, *_licence_runs(text or "", t)]:
            g = _bigrams(w)
            for name, b in t.items():
                if g and one in (None, name) and 2 * len(g & b) >= licences.THRESHOLD * (len(g) + len(b)):
                    want[name] = max(want.get(name, 0), 2 * len(g & b) / (len(g) + len(b)))
        assert got[k].licences == ",".join(sorted(want)), text
        if want:
            assert got[k].best_dice == round(max(want.values()), 6)
    best = [got[9001 + i].best_licence for i in range(9)]
    assert best == ["mit", "mit", "mit-notice", "mit", "mit", "bsd-2-clause", "mit", "bsd-2-clause", "unlicense"]
    assert got[9007].n_matches == 2 and got[9001].n_matches == 1
    assert licences.licence_scan(d.limit(0)).count() == 0


def test_licences_in_sql(spark, tmp_path):
    """The SQL twin gives the same rows, on texts with runs, repeated rows, ties and nulls."""
    import duckdb

    mit = licences.TEMPLATES["mit"]
    rows = [(1, "x y z\n" + mit.replace(". ", ".\n\n") + "\nend of it all"), (1, None), (2, ""), (3, "the software\nthe software\na\nin no event shall"), (4, mit + "\n\n" + mit), (4, mit + "\n\n" + mit), (5, "All rights reserved.\nAll rights reserved.")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = sorted(map(str, db.sql("SELECT doc_id, n_matches, licences, best_licence, best_dice FROM (" + licences.ORACLE_SQL + ")").fetchall()))
    assert sorted(str(tuple(r)) for r in licences.op2_licence_scan(spark, str(tmp_path)).select("doc_id", "n_matches", "licences", "best_licence", "best_dice").collect()) == want


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality_classifier"](spark, docs, SF)
    single = stages["jaccard_join"](spark, kept, SF)
    want = brute.jaccard_components(pairs(kept))
    assert {r.doc_id for r in single.collect()} == {c for _, c in want.values()}
    clean = stages["decontamination"](spark, single, SF)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = {x[0] for x in brute.contamination(pairs(single), items) if x[5]}
    before, after = dict(pairs(single)), dict(pairs(clean))
    assert all(after.get(k) == t for k, t in before.items() if k not in hits) and all(after.get(k) != before[k] for k in hits)
    private = stages["personal_data"](spark, clean, SF)
    for df in (kept, single, clean, private):
        assert df.columns == docs.columns and df.dtypes == docs.dtypes
    out = corpus_pipeline.run(spark, SF)
    assert out.count() == private.count()

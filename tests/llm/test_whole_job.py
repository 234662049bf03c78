"""Cases in which an operator once did less than its whole job."""

import random

from docweave.llm import html_extract, jaccard_join, quality_classifier

from . import brute


def test_one_word_extensions_of_short_texts(spark, monkeypatch):
    """More than GROUP texts that share a hot slot with a text that fills few slots itself."""
    rnd = random.Random(11)
    rows = []
    for _ in range(60):
        base = [f"w{rnd.randint(0, 10**6)}" for _ in range(7)]
        # The text itself is neither first nor last, so that the group's star and chain do not lead all to it.
        rows += [(len(rows) + k, " ".join(base + [f"x{rnd.randint(0, 10**6)}"] * (k != 7))) for k in range(jaccard_join.GROUP + 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    want = brute.jaccard_components(rows)
    run = lambda: {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.near_duplicate_classes(df).collect()}
    assert run() == want
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    assert run() == want


def test_hidden_is_an_attribute_not_a_word():
    texts = lambda page: [b.text for b in html_extract.blocks(page)]
    assert texts('<article class="overflow-hidden"><p title="hidden">One <a href="/hidden-lake">two</a> three.</p></article>') == ["One two three."]
    assert texts("<p data-x='display: none'>a</p><p hidden>b</p><p HIDDEN=''>c</p><p aria-hidden=true>d</p><p style='color:red; display : none'>e</p><p hidden=until-found>f</p>") == ["a", "f"]
    assert texts("<html><head><title>t</title><meta charset=utf-8><style>p{}</style><body><p>One</p>") == ["One"]
    assert texts("<head><title>t</title><p>One</p>") == ["One"] and texts("<head><template><p>no</p></template></head><p>One</p>") == ["One"]
    assert texts("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x=1</annotation></math> be.</p>") == ["Let x=1 be."]


def test_unfitted_classifier_keeps_everything(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for labels in ([], [(k, 1) for k in range(1, 200)]):
        model = quality_classifier.fit_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
        assert {r.score for r in quality_classifier.quality_scores(docs, model).collect()} == {0.5}
        assert quality_classifier.rejected_removed(docs, model).count() == docs.count()

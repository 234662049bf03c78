import itertools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import language_id as li
from docweave.llm.common import table, vocabulary

DDL = "doc_id long, text string, lang string, source string"
PATH = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def pieces():
    return li.Pieces(PATH)


def segmentations(word, pieces):
    """Every way to cut a marked word into pieces, as lists of piece numbers."""

    def cuts(rest):
        if not rest:
            yield []
            return
        if not pieces.known(rest[0]):
            for tail in cuts(rest[1:]):
                yield [pieces.bytes_from + b for b in rest[0].encode()] + tail
        for j in range(1, len(rest) + 1):
            if (p := pieces.tree.get(rest[:j], -1)) >= 0:
                for tail in cuts(rest[j:]):
                    yield [p, *tail]

    return list(cuts(li.MARK + word))


@pytest.mark.parametrize("seed", [1, 2])
def test_sums_over_all_segmentations(pieces, seed):
    rng = np.random.default_rng(seed)
    log_p = np.log(rng.dirichlet(np.ones(pieces.size) * 0.3, 3) + 1e-9).astype(np.float32)
    words = ["the", "Haus", "été", "a", "straßen", "日本語", "xq🙂z", "internat", "ⴰⵣ", "the"]
    model = li.LanguageModel(PATH, ["x", "y", "z"], log_p)
    got = model.word_scores(words)
    for w, g in zip(words, got):
        ways = segmentations(w, pieces)
        want = [math.log(math.fsum(math.exp(sum(float(log_p[k, p]) for p in way)) for way in ways)) for k in range(3)]
        assert np.allclose(g, want, atol=1e-9), w
    lattices = li.Lattices(words, pieces)
    used = lattices.uses(log_p[1, lattices.piece].astype(float)[:, None])[:, 0]
    for i, w in enumerate(words):
        expected, total = Counter(), 0.0
        for way in segmentations(w, pieces):
            p = math.exp(sum(float(log_p[1, x]) for x in way))
            total += p
            for x in way:
                expected[x] += p
        mine = Counter()
        for p, u in zip(lattices.piece[lattices.word == i], used[lattices.word == i]):
            mine[int(p)] += u
        assert all(abs(mine[x] - v / total) < 1e-9 for x, v in expected.items()) and set(mine) == set(expected)


def test_long_words_and_texts(pieces):
    model = li.LanguageModel(PATH, ["x", "y"], np.full((2, pieces.size), -math.log(pieces.size)))
    scores, lettered = model.text_scores(["ab" * 20000, "the house " * 30000, "12 , 34", "", "½²"])
    assert np.isfinite(scores).all() and lettered.tolist() == [True, True, False, False, False]
    assert abs(scores[1, 0] - 30000 * model.word_scores(["the", "house"])[:, 0].sum()) < 1e-3
    assert model.predict(["the", "½"]) [0] == ["x", "und"]  # equal scores: the first by name


def test_accuracy_on_held_out_documents(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = li.op12_language_id(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang", "text"), "doc_id").where("held_out AND lang_pred <> 'und'").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    assert {r.held_out for r in got} == {True} and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in got)
    assert all(0 <= r.score <= 1 for r in got)


def test_only_texts_and_taught_labels_matter(spark):
    """Other labels of held-out rows, other ids and sources change nothing."""
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text", "lang", "source")
    out = li.held_out(F.col("doc_id"))
    model = li.fit_languages(docs, PATH, sample=40)
    odd = li.fit_languages(docs.withColumn("lang", F.when(out, "zz").otherwise(F.col("lang"))).withColumn("source", F.lit("?")).repartition(5), PATH, sample=40)
    assert model.langs == odd.langs and (model.log_p == odd.log_p).all()
    assert np.allclose(np.exp(model.log_p.astype(float)).sum(1), 1, atol=1e-3)
    texts = [r.text for r in docs.limit(30).collect()]
    assert model.predict(texts)[0] == odd.predict(texts)[0]


def test_sample_is_bounded(spark):
    rows = [(i, f"mot numero {'a' * (i % 7)}", "fr", "s") for i in range(400)] + [(5, "twice", "fr", "s")] * 3
    got = li._sampled(spark.createDataFrame(rows, DDL), 50, "doc_id", "text", "lang").collect()
    assert len(got) == 50
    ids = sorted((r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2), key=lambda x: x)
    assert len(set(ids)) > 50


def test_odd_rows_and_empty_tables(spark):
    rng = random.Random(3)
    en, de = "the and of that with house river".split(), "der und das nicht mit haus fluss".split()
    rows = [(i, " ".join(rng.choices(en if i % 2 else de, k=20)), "en" if i % 2 else "de", "s") for i in range(120)]
    rows += [(500, None, "en", None), (501, "", None, "s"), (502, "12 34 !", "en", "s"), (None, "the house and the river", "en", "s"), (503, "das haus und der fluss " * 20000, None, None), (504, "the", None, "s"), (504, "the", None, "s")]
    df = spark.createDataFrame(rows, DDL).withColumn("lang_pred", F.lit("clash")).withColumn("score", F.lit("clash")).withColumn("word", F.lit(1))
    model = li.fit_languages(df, PATH)
    got = li.languages(df, model).collect()
    assert len(got) == len(rows) and model.langs == ["de", "en"]
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (500, 501, 502)] == ["und"] * 3 and [by[i].score for i in (500, 501, 502)] == [0.0] * 3
    assert by[503].lang_pred == "de" and by[504].lang_pred == "en" and by[None].lang_pred == "en" and by[None].held_out is False
    assert [r.lang_pred for r in got if r.doc_id == 504] == ["en", "en"]
    assert all((by[i].lang_pred == ("en" if i % 2 else "de")) for i in range(120))
    empty = spark.createDataFrame([], DDL)
    nothing = li.fit_languages(empty, PATH)
    assert li.languages(empty, nothing).collect() == []
    assert {(r.lang_pred, r.score) for r in li.languages(df, nothing).collect()} == {("und", 0.0)}


def test_unlearnable_labels(spark):
    """A language whose documents have no letters is known but has only the smoothing's probabilities."""
    held = next(i for i in itertools.count() if zlib.crc32(str(i).encode()) % 4 != 2)
    model = li.fit_languages(spark.createDataFrame([(held, "1 2", "xx", "s")], DDL), PATH)
    assert model.langs == ["xx"] and model.predict(["word", "1"])[0] == ["xx", "und"]

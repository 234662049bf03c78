import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docweave.llm import collocations as c

DDL = "doc_id long, text string, lang string"


def brute_counts(rows, longest=4):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lower):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(longest, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    return f, n


def brute(rows, least=30, top=2000):
    f, n = brute_counts(rows)
    f = {k: v for k, v in f.items() if v >= least}
    found = {}
    for (lang, p), a in f.items():
        inside = any(100 * v >= 80 * a for (l2, q), v in f.items() if l2 == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
        if len(p) > 1 and not inside:
            score, _, l, r = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), l, r))
    return {(lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, v in found.items() for i, (s, a, p, l, r) in enumerate(sorted(v)[:top], 1)}


def corpus(seed, docs=160):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "Étang", "a", "cat", "sat", "日本", "x\xa0y", "on", "THE", "mat", "w" * 300]
    rows = []
    for i in range(docs):
        words = rng.choices(vocabulary, [30, 9, 3, 9, 4, 4, 3, 2, 5, 3, 3, 1], k=rng.randrange(60))
        text = "".join(w + rng.choices([" ", "  ", "\t", ", ", ".", "\n", "\x0c", " : "], [30, 3, 2, 1, 1, 1, 1, 1])[0] for w in words)
        rows.append((i, text, rng.choice(["en", "en", "en", "fr", None, "und", ""])))
    return rows + [(1, None, "en"), (None, "", "de"), (2, " ,.; ", "de")] + rows[:40] + [(7, "of the " * 3000, "en"), (8, "the the " * 900 + "end", "fr")]


@pytest.mark.parametrize("stretches, partitions", [((1 << 22, 1 << 20), 2), ((300, 70), 5)])
def test_every_count(spark, stretches, partitions):
    rows = corpus(1)
    df = spark.createDataFrame(rows, DDL).withColumn("bucket", F.lit("clash")).withColumn("phrase", F.lit(1)).repartition(partitions)
    counts, totals = c.phrase_counts(df, least=5, stretches=stretches)
    f, n = brute_counts(rows)
    assert {(r.lang, tuple(r.phrase.split(" "))): r.f for r in counts.collect()} == {k: v for k, v in f.items() if v >= 5}
    assert {r.lang: r.n for r in totals.collect() if r.n} == {k: v for k, v in n.items() if v}


def test_whole_answer_and_its_sql(spark, tmp_path):
    rows = corpus(2, 400)
    df = spark.createDataFrame(rows, DDL)
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in c.op13_collocations(spark, str(tmp_path)).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == brute(rows) and len(got) > 20
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == {tuple(r) for r in con.execute(f"SELECT lang, rank, phrase, a, l, r, n, score FROM ({c.ORACLE_SQL})").fetchall()}


def test_top_and_ties(spark):
    rows = [(i, f"w{i % 50} v{i % 50}", "en") for i in range(2000)]
    got = c.collocations(spark.createDataFrame(rows, DDL), top=7).orderBy("rank").collect()
    assert [r.phrase for r in got] == sorted(f"w{i} v{i}" for i in range(50))[:7] and [r.rank for r in got] == list(range(1, 8))
    assert {(r.a, r.l, r.r, r.n, r.score) for r in got} == {(40, 40, 40, 4000, 1000000)}


def test_products_beyond_64_bits(spark):
    big = 5 * 10**18
    counts = spark.createDataFrame([("en", "a b", big - 1), ("en", "a", big), ("en", "b", big), ("en", "a b c", big // 5 * 4), ("en", "b c", big // 5 * 4), ("en", "c", big)], "lang string, phrase string, f long")
    got = {r.phrase: (r.score, r.k) for r in c.scored(counts).collect()}
    assert got["a b"] == (2000000 * (big - 1) // (2 * big), 1) and got["a b c"] == (2000000 * (big // 5 * 4) // (2 * big - 1), 2)
    most = {r.phrase: r.most for r in c.contained(counts).collect()}
    assert most == {"a b": big // 5 * 4, "b c": big // 5 * 4}


def test_stack_of_beginnings():
    rows = [np.array(x) for x in ([0, 0, 0, 1], [2, 2, 2, 2], [1, 1, 9, 1], [0, 9, 9, 9])]
    got = [(length, at.tolist(), n.tolist()) for length, at, n in c.beginnings(rows, np.array([1, 2, 4, 8]), 9)]
    assert got == [(1, [0, 3], [7, 8]), (2, [0, 3], [3, 8]), (3, [0], [1])]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], DDL).write.parquet(f"{tmp_path}/documents.parquet")
    assert c.op13_collocations(spark, str(tmp_path)).collect() == []
    assert c.collocations(spark.createDataFrame([(1, None, None), (2, "", "en")], DDL)).collect() == []

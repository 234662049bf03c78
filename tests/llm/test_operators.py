"""Operators against plain Python versions, on the small tables and on odd rows."""

import random

import pytest

from docweave.llm import decontaminate, packed, pii, quality_rules, substring_dedup
from docweave.llm.piece_codec import CodecMismatch, codec, decode_pieces, encode_pieces, piece_digests
from docweave.llm.common import vocabulary
from docweave.llm.token_counts import token_counts

from . import brute

SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\n", "a", "one two three four five", "x " * 40, "Abc def.\n" * 30, "日本 語　x", "a" * 3000, "1.2.3.4 1.2.3.4.5 256.1.1.1 0255.1.1.1", "a@b.c_d@e.f x@y_z@w.v a@b", "+1 (234) 567-8901 +1234 4111 1111 1111 1111 4111-1111-1111-1112",
       "<|endoftext|> it's  a\t\ttest▁▁x", "ok\x00\x01\x1c\x85z"]


def documents(spark, extra=True):
    d = spark.read.parquet(f"{SF}/documents.parquet")
    if extra:
        odd = spark.createDataFrame([(10_000 + i, t, "en", None if i % 2 else "src1", 0) for i, t in enumerate(ODD)], d.schema)
        d = d.union(odd)
    return d


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_pii_base_spans(spark):
    d = documents(spark)
    got = {r["doc_id"]: r for r in pii.pii_spans(d).collect()}
    for k, t in pairs(d):
        n, h, base = brute.pii(t)
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == n, (t, base)
        assert r.base_sha256 == h
        assert r.spans.startswith(base)


def test_pii_random_strings(spark):
    rnd = random.Random(3)
    alpha = ["1", "23", "4", ".", "-", " ", "@", "a", "B_", "+", "(", ")", "é", "😀", "com", "255", "4111111111111111"]
    rows = [(i, "".join(rnd.choices(alpha, k=rnd.randint(0, 40)))) for i in range(1500)]
    got = {r["doc_id"]: r for r in pii.pii_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, t in rows:
        n, h, base = brute.pii(t)
        assert got[k].base_sha256 == h, (t, base, got[k].spans)


def test_pii_of_dense_text(spark):
    """Work grows with the spans, not with their square."""
    import time

    text = " ".join(f"user{i}@host{i}.example.org" for i in range(20_000))
    d = spark.createDataFrame([(1, text)], "doc_id long, text string")
    at = time.time()
    assert pii.pii_spans(d).first().n_email == 20_000
    assert pii.redact(d).first().text == " ".join(["[EMAIL]"] * 20_000)
    assert time.time() - at < 60


def planted(seed, n):
    """Sentences with data that no base format covers, and with look-alikes; built apart from the trees' examples."""
    rnd = random.Random(seed)
    dig = lambda k: "".join(rnd.choice("0123456789") for _ in range(k))
    hexa = lambda k: "".join(rnd.choice("0123456789abcdef") for _ in range(k - 1)) + dig(1)
    name = lambda: rnd.choice(["anna", "piotr", "luis", "mei", "omar"])
    private = [lambda: ("secret", "The api_key=", hexa(40)), lambda: ("secret", "Set password: ", hexa(24)), lambda: ("number", "Her SSN is SSN ", f"{dig(3)}-{dig(2)}-{dig(4)}"), lambda: ("number", "Please call ", f"{dig(3)}-{dig(3)}-{dig(4)}"), lambda: ("obscured_email", "You may contact ", f"{name()}.{name()} (at) mailhost (dot) org")]
    other = [lambda: ("", "It is on page ", f"{dig(4)}-{dig(4)}"), lambda: ("", "The ISBN ", dig(7)), lambda: ("", "They met at ", f"the station at Rome.{name().capitalize()}"), lambda: ("", "See ", "the-long-road-to-the-north-" + dig(2))]
    return [(i, *rnd.choice(private if i % 2 else other)()) for i in range(n)]


def test_pii_proposals(spark):
    """Recall of proposals on planted rows, by kind, look-alikes left alone; and thresholds that decide."""
    rows = planted(5, 600)
    d = spark.createDataFrame([(i, f"{lead}{x} before noon on Monday.") for i, _, lead, x in rows], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_spans(d).collect()}
    for kind in pii.PROPOSED:
        mine = [(i, lead, x) for i, k, lead, x in rows if k == kind]
        spans = {i: [(int(a), int(b)) for k, a, b in (s.split(":") for s in got[i].split(",") if s) if k == kind] for i, *_ in mine}
        found = [any(a <= len(lead) and b >= len(lead) + len(x) for a, b in spans[i]) for i, lead, x in mine]
        assert sum(found) >= 0.9 * len(mine), (kind, sum(found), len(mine))
    alone = [not got[i] for i, k, *_ in rows if not k]
    assert sum(alone) >= 0.97 * len(alone)
    assert all(cut != 0 for _, cut in pii.model(spark).values())


def test_redaction(spark):
    rows = [(1, 'mail bob@x.org now, token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end', 5), (2, "clean text here", 15), (3, None, 0)]
    out = {r.doc_id: r for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()}
    assert out[1].text == 'mail [EMAIL] now, token = "[SECRET]" end' and out[1].n_chars == len(out[1].text)
    assert out[2].text == "clean text here" and out[3].text is None
    odd = [(1, "é😀 +1 234 567 8901@x.org and 1.2.3.4, 5.6.7.8", "s", "m"), (2, "", None, None)]
    got = pii.redact(spark.createDataFrame(odd, "doc_id long, text string, _spans string, masked string")).collect()
    assert {r.doc_id: r.text for r in got} == {1: "é😀 [PHONE] and [IP], [IP]", 2: ""} and got[0]._spans == "s"


def test_quality(spark):
    d = documents(spark)
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(d).collect()}
    for k, t in pairs(d):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute.quality(t), t
        assert not (r.kept and r.base_failed)


@pytest.mark.parametrize("few", [True, False])
def test_bad_host(spark, monkeypatch, few):
    monkeypatch.setattr(quality_rules, "BROADCAST_HOSTS", 100 if few else 0)
    good = " ".join(f"w{i}" for i in range(50))
    rows = [(i, "bad" if i % 2 else good + str(i), "http://evil.org/x" if i % 2 else "fine.org") for i in range(400)] + [(1001, good, "http://evil.org/y")]
    got = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert got[0].kept and not got[1].kept and not got[1001].kept and not got[1001].base_failed


def test_substrings(spark):
    d = documents(spark)
    got = {r["doc_id"]: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(d).collect()}
    want = brute.substrings(pairs(d))
    assert {k: v for k, v in want.items() if got[k] != v} == {}


def test_substrings_random(spark):
    rnd = random.Random(5)
    base = [str(rnd.randint(0, 3)) for _ in range(60)]
    rows = []
    for i in range(120):
        a = rnd.randint(0, 40)
        rows.append((i * 3, " ".join(base[a : a + rnd.randint(5, 30)] + [str(rnd.randint(0, 2)) for _ in range(rnd.randint(0, 30))])))
    got = {r["doc_id"]: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.repeated_words(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.substrings(rows)
    cut = {r.doc_id: r.text for r in substring_dedup.dedup_substrings(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, row int")).collect()}
    for k, (n, gone, h) in brute.substrings(rows).items():
        assert len(cut[k].split()) == n - gone


def test_every_word_is_checked():
    c = codec(vocabulary("piece_bpe_32k.model"))
    seen, check = [], c._check
    c.known.clear()
    c.old.clear()
    c._check = lambda words, ids, back: (seen.extend(words), check(words, ids, back))
    try:
        text = "Hello, world!\nnext (line)\n\n:end  two"
        c.digest([text])
        assert set(c.split(text)) <= set(seen)
    finally:
        c._check = check


def test_contamination(spark):
    d = documents(spark)
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    more = spark.createDataFrame([(900, "Of the, to"), (901, "the"), (902, None), (903, "..."), (904, "one two THREE four five")], "item_id long, text string")
    for its in (items, items.union(more), items.limit(0)):
        want = brute.contamination(pairs(d), [(r.item_id, r.text) for r in its.collect()])
        for size in (decontaminate.BLOCK_BYTES, 500):
            got = decontaminate.contamination(d, its, block_bytes=size).collect() if size > 600 or its.count() < 9 else None
            if got is not None:
                assert sorted(tuple(r) for r in got) == sorted(want)


def test_contamination_in_blocks(spark):
    d = documents(spark, False).limit(60)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").limit(12)
    want = brute.contamination(pairs(d), [(r.item_id, r.text) for r in items.collect()])
    assert sorted(tuple(r) for r in decontaminate.contamination(d, items, block_bytes=900).collect()) == sorted(want)


def test_contamination_by_long_and_repeated_items(spark):
    """A long item is cut into pieces, repeated ones are taken once: blocks stay small and nothing is lost."""
    rnd = random.Random(9)
    long = [f"w{rnd.randint(0, 500)}" for _ in range(3000)]
    items = [(1, " ".join(long)), (2, "Of the")] + [(3, " ".join(f"v{i}" for i in range(20)))] * 50
    rows = [(k, " ".join(f"u{k}" for _ in range(5)) + " " + " ".join(long[a : a + n])) for k, (a, n) in enumerate((rnd.randint(0, 2990), rnd.randint(5, 60)) for _ in range(80))]
    rows += [(900, items[-1][1] + " of the"), (901, None)]
    its = spark.createDataFrame(items, "item_id long, text string")
    blocks = decontaminate._blocks(its, "item_id", "text", 4000, decontaminate.WINDOW)
    assert len(blocks) > 3 and max(sum(len(r.text) for r in b.collect()) for b in blocks) <= 6000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = decontaminate.contamination(docs, its, block_bytes=16_000).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute.contamination(rows, items))
    assert decontaminate.contamination(docs.limit(0), its).count() == 0


def test_decontaminate_cuts(spark):
    item = " ".join(f"w{i}" for i in range(12))
    rows = [(1, "a b c d e f g h i j k l m n " + item + " tail end", 0), (2, item, 0), (3, "clean", 5), (4, None, 0)]
    out = {r.doc_id: r for r in decontaminate.decontaminate(spark.createDataFrame(rows, "doc_id long, text string, n_chars long"), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert out[1].text == "a b c d e f g h i j k l m n  tail end" and 2 not in out and out[3].text == "clean" and out[4].text is None


def test_tokens_and_pieces(spark):
    import hashlib

    import sentencepiece
    from tokenizers import Tokenizer

    d = documents(spark)
    rows = pairs(d)
    tok = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in token_counts(d, vocabulary("byte_bpe_50k.json")).collect()}
    for k, t in rows:
        n = len(tok.encode(t or "", add_special_tokens=False))
        assert (got[k].n_bytes, got[k].n_tokens, got[k].over_limit) == (len((t or "").encode()), n, n > 1024)
    lib = sentencepiece.SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in piece_digests(d, vocabulary("piece_bpe_32k.model")).collect()}
    coded = encode_pieces(d, vocabulary("piece_bpe_32k.model"))
    ids_of = {r.doc_id: r.ids for r in coded.collect()}
    back = {r.doc_id: r.text for r in decode_pieces(coded, vocabulary("piece_bpe_32k.model")).collect()}
    for k, t in rows:
        ids = lib.encode(t or "")
        assert ids_of[k] == ids and back[k] == lib.decode(ids)
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), brute.sha(lib.decode(ids)))


def test_other_vocabularies(spark):
    d = documents(spark).limit(40)
    assert {r.n_tokens > 0 for r in token_counts(d, vocabulary("word_bpe_49k.json")).collect()} == {True}
    assert token_counts(d, vocabulary("piece_bpe_32k.model")).count() == 40


def test_mismatch_is_raised():
    c = codec(vocabulary("piece_bpe_32k.model"))
    with pytest.raises(CodecMismatch):
        c._check([" the"], [[1]], [" the"])


def test_empty_tables(spark):
    d = documents(spark).limit(0)
    for out in (pii.pii_spans(d), quality_rules.quality_rules(d), substring_dedup.repeated_words(d), token_counts(d, vocabulary("byte_bpe_50k.json")), piece_digests(d, vocabulary("piece_bpe_32k.model"))):
        assert out.count() == 0


def test_packed_round_trip():
    import numpy as np

    rnd = np.random.default_rng(1)
    h, doc = rnd.integers(0, 1 << 63, 500).astype(np.uint64), np.sort(rnd.integers(0, 9, 500))
    ids = np.arange(100, 109)
    back = set()
    for b, p in packed.pack(h, doc, ids, packed.bucket_of(h, 7), 7, 8):
        i, n, k = packed.unpack(p, 8)
        assert (packed.bucket_of(k, 7) == b).all()
        back |= set(zip(np.repeat(i, n).tolist(), k.tolist()))
    assert back == set(zip(ids[doc].tolist(), h.tolist()))

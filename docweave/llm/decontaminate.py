"""Benchmark decontamination with a generalised suffix automaton (operator 10).

The normalised test items form one suffix automaton over word numbers.  Training tokens stream through it and
the length of the longest match ending at each word is tracked: a length of at least ``window`` words, or a
whole shorter item, hits the words it covers.  Matches of two words are looked up for a whole Arrow slice with
numpy first, so that only stretches in which every adjacent word pair occurs in some item, and which are long
enough to hold a window, go through the automaton word by word.

The items are the stated query set.  Distinct ones are taken in blocks of about ``block_bytes`` of text, each block
one automaton that is broadcast; a long item is cut into pieces that share a window less one word.  Documents pass
the blocks one after another, so no broadcast grows with the item table.

Defined results: null and empty texts have no words and no hits; items without words never occur; repeated
items count once per ``item_id``, a null ``item_id`` as the empty string; repeated rows give repeated rows;
an empty item table leaves every document clean; other columns are not read (``decontaminate`` passes them on).
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table, tidy
from .textnum import ALNUM_LOWER, Words, text_slices

WINDOW = 10
BLOCK_BYTES = 4 << 20
#: Blocks that documents pass before the rows are written and lineage is cut.
BLOCKS_AT_ONCE = 4


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items of each window and of each short item."""

    def __init__(self, items: Iterable[tuple[str, str]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        ids, texts = [], []
        for item, text in items:
            ids.append(item)
            texts.append((text or "").encode("utf-8", "surrogatepass"))
        bounds = np.cumsum([0, *map(len, texts)])
        words = Words(np.frombuffer(b"".join(texts), np.uint8), bounds, ALNUM_LOWER)
        self.vocab, numbers = np.unique(words.h, return_inverse=True)
        tokens = numbers.tolist()
        seqs = [tokens[a:b] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]
        for seq in seqs:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        n = len(self.len)
        order = sorted(range(1, n), key=self.len.__getitem__)
        self.at_window = [0] * n
        for s in order:
            up = self.link[s]
            if self.len[s] >= window:
                self.at_window[s] = s if self.len[up] < window else self.at_window[up]
        self.items: dict[int, frozenset[str]] = {}
        found: dict[int, set[str]] = {}
        shorts: dict[int, set[tuple[int, str]]] = {}
        for item, seq in zip(ids, seqs):
            s = 0
            for i, c in enumerate(seq):
                s = self.next[s][c]
                if i + 1 >= window:
                    found.setdefault(self.at_window[s], set()).add(item)
            if 0 < len(seq) < window:
                shorts.setdefault(s, set()).add((len(seq), item))
        self.items = {s: frozenset(x) for s, x in found.items()}
        none: tuple = ()
        self.short: list[tuple] = [none] * n
        for s in order:
            own, up = shorts.get(s), self.short[self.link[s]]
            self.short[s] = (*sorted(own), *up) if own else up
        lengths = [len(s) for s in seqs if s]
        self.least = min([window, *lengths]) if lengths else 0
        pairs = [np.array(s[:-1], np.int64) * len(self.vocab) + np.array(s[1:], np.int64) for s in seqs if len(s) > 1]
        self.pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.vocab & np.uint64(0xFFFF)).astype(np.int64)] = True

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, c, q)
        cur = len(length)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(length)
        nxt.append(dict(nxt[q]))
        length.append(length[p] + 1)
        link.append(link[q])
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        link[q] = new
        return new

    def stretches(self, words: Words) -> list[tuple[int, int, list[int]]]:
        """(first word, end, word numbers) of the stretches that can hold an occurrence."""
        n = len(words)
        if not n or not self.least:
            return []
        known = np.flatnonzero(self.seen[(words.h & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.searchsorted(self.vocab, words.h[known])
        at[at == len(self.vocab)] = 0
        good = self.vocab[at] == words.h[known]
        known, number = known[good], at[good]
        if not len(known):
            return []
        doc = np.searchsorted(words.first, known, side="right")
        joined = (np.diff(known) == 1) & (doc[1:] == doc[:-1])
        if self.least > 1:
            key = number[:-1] * len(self.vocab) + number[1:]
            pos = np.searchsorted(self.pairs, key)
            pos[pos == len(self.pairs)] = 0
            joined &= self.pairs[pos] == key if len(self.pairs) else False
        cut = np.flatnonzero(~joined) + 1
        begin, end = np.concatenate([[0], cut]), np.concatenate([cut, [len(known)]])
        keep = end - begin >= self.least
        return [(int(known[a]), int(known[b - 1]) + 1, number[a:b].tolist()) for a, b in zip(begin[keep], end[keep])]

    def hits(self, words: Words) -> tuple[list[tuple[int, int]], dict[int, set[str]]]:
        """Ascending (from, to) stretches of hit words, and the items found by each stretch's first word."""
        spans: list[tuple[int, int]] = []
        items: dict[int, set[str]] = {}
        nxt, link, length, win, short, w = self.next, self.link, self.len, self.at_window, self.short, self.window
        for first, _, tokens in self.stretches(words):
            s = m = 0
            got: set[str] = set()
            lo = hi = -1
            for i, c in enumerate(tokens):
                while (t := nxt[s].get(c)) is None and s:
                    s = link[s]
                    m = length[s]
                if t is None:
                    continue
                s, m = t, m + 1
                back = 0
                if m >= w:
                    back = w
                    got |= self.items[win[s]]
                for size, item in short[s]:
                    if size <= m:
                        back = max(back, size)
                        got.add(item)
                if back:
                    a = i + 1 - back
                    if hi < 0:
                        lo, hi = a, i + 1
                    elif a <= hi:
                        lo, hi = min(lo, a), i + 1
                    else:
                        spans.append((first + lo, first + hi))
                        lo, hi = a, i + 1
            if hi >= 0:
                spans.append((first + lo, first + hi))
            if got:
                items[first] = got
        return spans, items


def _pieces(window: int, limit: int):
    """(item, piece) of items: a long text in pieces of about ``limit`` bytes that share window - 1 words, so that
    every window of the item is one of some piece, and no piece of a long item is shorter than a window."""

    def run(batches):
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw, cuts = text.encode(), [(0, None)]
                if len(raw) > limit:
                    words = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), ALNUM_LOWER)
                    size = max(window, int(len(words) * limit / len(raw)))
                    cuts = [(k, k + size + window - 1) for k in range(0, max(1, len(words) - window + 1), size)]
                out = [text] if len(cuts) == 1 else [raw[words.start[a] : words.end[min(b, len(words)) - 1]].decode() for a, b in cuts]
                yield pa.RecordBatch.from_arrays([pa.array([item] * len(out), pa.string()), pa.array(out, pa.string())], names=["item", "text"])

    return run


def _blocks(items: DataFrame, item_key: str, column: str, block_bytes: int, window: int) -> list[DataFrame]:
    """The distinct items in blocks of about half of ``block_bytes``, dealt by hash: repeats count once and a long
    item is cut, so no block outgrows what is collected and broadcast."""
    rows = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(column).cast("string"), F.lit("")).alias("text")).distinct()
    rows = rows.mapInArrow(tidy(_pieces(window, max(1, block_bytes // 16))), "item string, text string")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0)).alias("n")).first()["n"]
    if size <= block_bytes:
        return [rows]
    n = math.ceil(size / (block_bytes / 2))
    rows = durable(rows)
    return [rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i) for i in range(n)]


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _scan(docs: DataFrame, items: DataFrame, window: int, key: str, column: str, item_key: str, item_column: str, block_bytes: int, finish: Callable | None, schema: str) -> DataFrame:
    """One pass of all texts for each block of items. ``finish`` turns what the last one found, slice by slice, into
    rows of ``schema``: it gets the keys, the texts, the words of each, and lists of word spans, byte spans and items."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)[key]
    spans = f"`{key}` {kind}, text string, n_words long, word_spans array<int>, byte_spans array<long>, items array<string>"
    names = [key, "text", "n_words", "word_spans", "byte_spans", "items"]
    out = docs.select(F.col(key), F.col(column).cast("string").alias("text"))
    blocks = _blocks(items, item_key, item_column, block_bytes, window)
    for turn, block in enumerate(blocks):
        if turn and turn % BLOCKS_AT_ONCE == 0:
            out = durable(out)
        automaton = spark.sparkContext.broadcast(ItemAutomaton([(r["item"], r["text"]) for r in block.collect()], window))
        last = turn == len(blocks) - 1

        def run(batches, automaton=automaton, again=turn > 0, end=finish if last else None):
            for batch in batches:
                found = automaton.value
                texts = batch.column(1)
                for i, j, data, bounds in text_slices(texts):
                    words = Words(data, bounds, ALNUM_LOWER)
                    hit, got = found.hits(words)
                    w: list[list] = [[] for _ in range(j - i)]
                    b: list[list] = [[] for _ in range(j - i)]
                    k: list[list] = [[] for _ in range(j - i)]
                    if again:
                        w = [list(zip(x[::2], x[1::2])) for x in batch.column(3).slice(i, j - i).to_pylist()]
                        k = batch.column(5).slice(i, j - i).to_pylist()
                    for first, x in got.items():
                        d = int(np.searchsorted(words.first, first, side="right")) - 1
                        k[d] = sorted({*k[d], *x})
                    for a, e in hit:
                        d = int(np.searchsorted(words.first, a, side="right")) - 1
                        base = int(words.first[d])
                        w[d].append((a - base, e - base))
                    for d in range(j - i):
                        if w[d]:
                            w[d] = _merge(w[d])
                            base, at = int(words.first[d]), int(bounds[d])
                            b[d] = [x for a, e in w[d] for x in (int(words.start[base + a]) - at, int(words.end[base + e - 1]) - at)]
                            w[d] = [x for p in w[d] for x in p]
                    keys, own = batch.column(0).slice(i, j - i), texts.slice(i, j - i)
                    if end is not None:
                        yield end(keys, own, words.counts, w, b, k)
                    else:
                        yield pa.RecordBatch.from_arrays([keys, own, pa.array(words.counts, pa.int64()), pa.array(w, pa.list_(pa.int32())), pa.array(b, pa.list_(pa.int64())), pa.array(k, pa.list_(pa.string()))], names=names)

        out = out.mapInArrow(tidy(run), schema if last and finish else spans)
    return out


def contaminated_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", column: str = "text", item_key: str = "item_id", item_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, text, n_words, word_spans, byte_spans, items) of every row.

    Spans are flat lists of (from, to) pairs: of word numbers, and of UTF-8 byte positions in the text.
    """
    return _scan(docs, items, window, key, column, item_key, item_column, block_bytes, None, "")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id", column: str = "text", item_key: str = "item_id", item_column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    clean = hashlib.sha256(b"").hexdigest()

    def digest(keys, _, n_words, w, __, k):
        hit = np.array([sum(x[1::2]) - sum(x[::2]) for x in w], np.int64)
        sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() if x else clean for x in k]
        return pa.RecordBatch.from_arrays([keys, pa.array(n_words, pa.int64()), pa.array(hit), pa.array([len(x) for x in k], pa.int64()), pa.array(sha, pa.string()), pa.array(hit > 0)], names=[key, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return _scan(docs, items, window, key, column, item_key, item_column, block_bytes, digest, f"`{key}` {dict(docs.dtypes)[key]}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


def decontaminate(docs: DataFrame, items: DataFrame, max_words: int = 0, max_coverage: float = 0.5, window: int = WINDOW, column: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without contaminated passages: documents of which more than ``max_coverage`` of the words are
    hit are left out, and hit stretches of more than ``max_words`` words are cut out of the other texts.
    Clean rows stay as they are; ``n_chars``, where present, follows a text that was cut."""
    others = [F.col(c) for c in docs.columns if c != column] or [F.lit(0).alias("_")]
    rows = docs.select(F.struct(*others).alias("row"), F.col(column).cast("string").alias("text"))

    def cut(keys, texts, n_words, w, b, _):
        keep, changed, new = np.ones(len(texts), bool), np.zeros(len(texts), bool), {}
        for r in [r for r, x in enumerate(w) if x]:
            x, y = w[r], b[r]
            keep[r] = sum(x[1::2]) - sum(x[::2]) <= max_coverage * n_words[r]
            raw, out, at = texts[r].as_py().encode(), [], 0
            for k in range(0, len(x), 2):
                if x[k + 1] - x[k] > max_words:
                    out.append(raw[at : y[k]])
                    at = y[k + 1]
            if out:
                new[r], changed[r] = b"".join([*out, raw[at:]]).decode(), True
        if new:
            texts = pa.array([new.get(r, t) for r, t in enumerate(texts.to_pylist())], pa.string())
        return pa.RecordBatch.from_arrays([keys, texts, pa.array(changed)], names=["row", "text", "changed"]).filter(pa.array(keep))

    kind = dict(rows.dtypes)["row"]
    out = _scan(rows, items, window, "row", "text", "item_id", "text", block_bytes, cut, f"row {kind}, text string, changed boolean")
    kept = lambda c: F.col("row").getField(c)
    chars = lambda c: F.when(F.col("changed"), F.length("text").cast("long")).otherwise(kept(c))
    return out.select(*[F.col("text").alias(c) if c == column else (chars if c == "n_chars" else kept)(c).alias(c) for c in docs.columns])


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[k:k + 9], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM i WHERE len(w) > 0)),
dw AS (SELECT r, k, size, array_to_string(w[k:k + size - 1], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS k FROM d), (SELECT DISTINCT size FROM iw) WHERE k + size - 1 <= len(w)),
h AS (SELECT r, k, size, item_id FROM dw JOIN iw USING (size, g)),
c AS (SELECT r, count(DISTINCT k + j) AS n_hit FROM h, range(0, 10) AS x(j) WHERE j < size GROUP BY r),
t AS (SELECT r, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS sha FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

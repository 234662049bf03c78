"""Phrase collocations by counted suffixes (operator 13).

1. Every word begins a suffix of its piece, cut to ``longest`` words.  A task turns the words of a stretch of text
   into numbers of its own dictionary, adds up equal suffixes, and deals them to buckets by language and first
   word: one row a bucket, with the bucket's words and its suffixes as numbers.
2. A bucket's suffixes are sorted reverse-lexicographically, so those with a common beginning stand together and
   the longest first.  The stack of the suffix's beginnings then says all counts: a beginning is pushed where the
   words up to it change and popped, with what was added up meanwhile, where they change next.  The stack's pushes
   and pops are found for all suffixes of a bucket at once (:func:`beginnings`).
3. Counts of ``least`` and more are kept.  All parts of a phrase have at least its count, so cuts are scored and
   contained phrases dropped by joins of these counts among themselves.

Hot words: a first pass adds up, for each stretch, the beginnings of one to three words that make up a share of it,
and keeps those that make up ``1 / (4 * buckets)`` of all words.  Suffixes of a hot beginning are dealt by one more word,
those of a hot pair by two more, then by the whole suffix, of which a stretch sends one row.  Buckets then give parts
of the counts of hot beginnings, which the sum after step 2 adds up.  What is hot changes where suffixes are counted,
never a count.  At most ``4 * buckets`` beginnings of each length can be hot, 8 bytes each, so they may be broadcast.

Words are compared as bytes; hashes only choose buckets.  Defined results: a null text has no words; a null
language is ``und``, together with that value; repeated rows count each; an empty table gives an empty table; only
the two named columns are read; ties in rank cannot be, as phrases of a language differ.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import durable, table, tidy
from .packed import bucket_of, input_bytes
from .textnum import Words, mix, text_slices

LONGEST, LEAST, TOP, COVERED_PERCENT, SCALE = 4, 30, 2000, 80, 2_000_000
#: Words of a stretch when suffixes are sent, and when hot beginnings are sought; estimated input bytes a bucket.
SENT_WORDS, SOUGHT_WORDS = 1 << 20, 1 << 21
BUCKET_BYTES, MOST_BUCKETS = 16 << 20, 1 << 19
#: Tasks that first rank the phrases of a language.
RANKERS = 64

_STOP = np.zeros(256, bool)
_STOP[list(b".,;:!?\n\x0b\x0c\r")] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
#: Byte table of words: 0 separates, any other value stands for the lower-cased byte.
PHRASES = np.where(_STOP | np.isin(np.arange(256), list(b" \t")), 0, _LOWER.astype(np.uint16) + 1).astype(np.uint16)
_NEXT = np.uint64(0x9E3779B97F4A7C15)


class Stretch:
    """The words of some texts: bytes, lengths, hashes, language numbers, and whether the next word follows in the
    same piece."""

    def __init__(self) -> None:
        self.langs: dict[str, int] = {}
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, langs: list[str], data: np.ndarray, bounds: np.ndarray) -> None:
        words = Words(data, bounds, PHRASES)
        n = len(words)
        if not n:
            return
        doc = words.doc_of_words()
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        follows = np.zeros(n, bool)
        follows[:-1] = (doc[1:] == doc[:-1]) & (stops[words.start[1:]] == stops[words.end[:-1]])
        own = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int32)
        self.parts.append((_LOWER[data[PHRASES[data] > 0]], words.end - words.start, words.h, own[doc], follows))
        self.size += n

    def close(self) -> None:
        self.text, length, self.h, self.lang, self.follows = (np.concatenate(x) for x in zip(*self.parts))
        self.offsets = np.concatenate([[0], np.cumsum(length)])
        salt = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        self.salt = salt[self.lang]

    def encoded(self) -> tuple[np.ndarray, pa.Array]:
        """A number for each word, and the distinct words."""
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), self.size, [None, pa.py_buffer(self.offsets.astype(np.int64)), pa.py_buffer(self.text)])
        d = words.dictionary_encode()
        return d.indices.to_numpy(), d.dictionary

    def runs(self, longest: int) -> list[np.ndarray]:
        """For k of 1, 2, ...: whether a word has k further words in its piece."""
        out, going = [], self.follows
        for _ in range(longest - 1):
            out.append(going)
            going = going & np.concatenate([self.follows[len(out) :], np.zeros(len(out), bool)])
        return out

    def beginnings(self, longest: int) -> Iterator[np.ndarray]:
        """Hashes of the first 1, 2, ... words of each word's suffix, with its language; ended suffixes keep an end mark."""
        key, going = mix(self.h + self.salt * _NEXT), self.follows
        yield key
        for k in range(1, longest):
            then = np.full(self.size, np.uint64(k))
            then[:-k] = np.where(going[:-k], self.h[k:], then[:-k])
            key = mix(key * _NEXT + then)
            yield key
            going = going & np.concatenate([self.follows[k:], np.zeros(min(k, self.size), bool)])[: self.size]


def _stretches(batches, size: int) -> Iterator[Stretch]:
    s = Stretch()
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for i, j, data, bounds in text_slices(batch.column(1)):
            s.add(langs[i:j], data, bounds)
            if s.size >= size:
                s.close()
                yield s
                s = Stretch()
    if s.size:
        s.close()
        yield s


def _heavy(longest: int, share: float, stretch: int):
    """(length, lang, key, n): words of each language as length 0, and beginnings that make up a share of a stretch."""

    def run(batches):
        for s in _stretches(batches, stretch):
            count, names = np.bincount(s.lang, minlength=len(s.langs)), list(s.langs)
            rows = [pa.array(np.zeros(len(names), np.int32)), pa.array(names, pa.string()), pa.array(np.zeros(len(names), np.int64)), pa.array(count)]
            out = [pa.RecordBatch.from_arrays(rows, names=["length", "lang", "key", "n"])]
            least, on = max(1, int(share * s.size)), np.arange(s.size)
            for length, h in enumerate(s.beginnings(longest - 1), 1):  # a heavy pair begins with a heavy word
                keys, at, n = np.unique(h[on], return_inverse=True, return_counts=True)
                heavy = n >= least
                on = on[heavy[at]]
                rows = [pa.array(np.full(int(heavy.sum()), length, np.int32)), pa.nulls(int(heavy.sum()), pa.string()), pa.array(keys[heavy].view(np.int64)), pa.array(n[heavy])]
                out.append(pa.RecordBatch.from_arrays(rows, names=["length", "lang", "key", "n"]))
            yield from out

    return run


def _among(h: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(h), bool)
    at = np.searchsorted(keys, h)
    at[at == len(keys)] = 0
    return keys[at] == h


def _sent(longest: int, buckets: int, hot, stretch: int):
    """(bucket, langs, words, suffixes) of the suffixes of each stretch, equal ones added up."""

    def run(batches):
        hot_keys = hot.value
        for s in _stretches(batches, stretch):
            ids, words = s.encoded()
            depth, where, going = np.ones(s.size, np.int64), None, np.ones(s.size, bool)
            for k, key in enumerate(s.beginnings(longest), 1):
                where = key if where is None else np.where(going, key, where)
                if k < longest:
                    going &= _among(key, hot_keys[k])
                    depth += going
            columns = [ids] + [np.where(r, np.concatenate([ids[k:], np.zeros(k, ids.dtype)]), -1) for k, r in enumerate(s.runs(longest), 1)]
            bucket = bucket_of(where, buckets)
            order = np.lexsort((*reversed(columns), depth, s.lang, bucket))
            columns = [c[order] for c in (bucket, s.lang, depth, *columns)]
            first = np.flatnonzero(reduce(np.logical_or, [np.concatenate([[True], c[1:] != c[:-1]]) for c in columns]))
            counts = np.diff(np.concatenate([first, [s.size]]))
            bucket, lang, depth, *columns = (c[first] for c in columns)
            cut = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            names, rows, seen = np.array(list(s.langs), object), [], np.zeros(len(words) + 1, bool)
            for i, j in zip(cut[:-1].tolist(), cut[1:].tolist()):
                m = np.stack([c[i:j] for c in columns])
                seen[m + 1] = True
                seen[0] = False
                used = np.flatnonzero(seen) - 1
                seen[used + 1] = False
                own = np.searchsorted(used, m).astype(np.int32)
                own[m < 0] = -1
                langs, tag = np.unique(lang[i:j], return_inverse=True)
                part = np.stack([tag.astype(np.int32), depth[i:j].astype(np.int32), *own, np.minimum(counts[i:j], (1 << 31) - 1).astype(np.int32)])
                rows.append((int(bucket[i]), names[langs].tolist(), b" ".join(words.take(pa.array(used)).to_pylist()), part.astype(np.int16 if len(used) < 1 << 15 and part[-1].max() < 1 << 15 else np.int32).tobytes(), j - i))
            b, langs, w, p, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(langs, pa.list_(pa.string())), pa.array(w, pa.binary()), pa.array(p, pa.binary()), pa.array(n, pa.int32())], names=["bucket", "langs", "words", "suffixes", "n"])

    return run


def beginnings(rows: list[np.ndarray], counts: np.ndarray, end: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, at, count) for all beginnings of sorted suffixes: ``rows`` are their columns (what keeps suffixes apart,
    then the words), ``at`` is where a beginning is pushed on the stack, ``count`` what was added until it is popped."""
    changes = np.concatenate([[True], rows[0][1:] != rows[0][:-1]]) if len(counts) else np.zeros(0, bool)
    for length, c in enumerate(rows[1:], 1):
        changes = changes | np.concatenate([[True], c[1:] != c[:-1]]) if len(counts) else changes
        at = np.flatnonzero(changes)
        total = np.add.reduceat(counts, at) if len(at) else counts
        there = c[at] != end
        yield length, at[there], total[there]


def _counted(longest: int, least: int):
    """(lang, phrase, f) of the beginnings in each bucket: those of ``least`` and more, and parts of hot ones."""

    def counts_of(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        words = pa.concat_arrays([pa.array(w.split(b" "), pa.binary()) for _, w, _, _ in parts]).dictionary_encode()
        number, words = words.indices.to_numpy(), words.dictionary
        by = pc.sort_indices(words, sort_keys=[("", "descending")]).to_numpy().astype(np.int64)
        rank = np.empty(len(words) + 1, np.int64)
        rank[by] = np.arange(len(words))
        rank[-1] = end = len(words)  # the end of a suffix comes last
        columns, base = [], 0
        for names, w, raw, n in parts:
            m = np.frombuffer(raw, np.int16 if len(raw) == 2 * n * (longest + 3) else np.int32).reshape(longest + 3, n)
            own = np.append(number[base : base + w.count(b" ") + 1], end)
            base += len(own) - 1
            code = np.array([langs.setdefault(x, len(langs)) for x in names])
            columns.append(np.concatenate([[code[m[0]] * (longest + 1) + m[1]], rank[own[m[2:-1]]], m[-1:].astype(np.int64)]))
        tag, *cols, counts = np.concatenate(columns, axis=1)
        order = np.lexsort((*reversed(cols), tag))
        tag, counts, cols = tag[order], counts[order], [c[order] for c in cols]
        by = np.append(by, 0)
        name = pa.array(list(langs), pa.string())
        for length, at, total in beginnings([tag, *cols], counts, end):
            keep = (total >= least) | (tag[at] % (longest + 1) > length)
            at, total = at[keep], total[keep]
            texts = [words.take(pa.array(by[c[at]])) for c in cols[:length]]
            phrase = pc.binary_join_element_wise(*texts, b" ").cast(pa.string())
            yield pa.RecordBatch.from_arrays([name.take(pa.array(tag[at] // (longest + 1))), phrase, pa.array(total)], names=["lang", "phrase", "f"])

    def run(batches):
        bucket, parts = None, []
        for batch in batches:
            for b, langs, words, raw, n in zip(*(c.to_pylist() for c in batch.columns)):
                if b != bucket and parts:
                    yield from counts_of(parts)
                    parts = []
                bucket = b
                parts.append((langs, words, raw, n))
        if parts:
            yield from counts_of(parts)

    return run


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, lang: str = "lang", column: str = "text", stretches: tuple[int, int] = (SOUGHT_WORDS, SENT_WORDS)) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f) of all phrases of 1 to ``longest`` words that occur ``least`` times or more, and (lang, n)."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(column), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(max(2 * parts, min(input_bytes(docs), 1 << 60) // BUCKET_BYTES), MOST_BUCKETS) | 1
    share = 1 / (4 * buckets)
    found = durable(rows.mapInArrow(tidy(_heavy(longest, share, stretches[0])), "length int, lang string, key long, n long").groupBy("length", "lang", "key").agg(F.sum("n").alias("n")))
    totals = found.where("length = 0").select("lang", "n")
    words = totals.agg(F.sum("n")).first()[0] or 0
    hot = found.where((F.col("length") > 0) & (F.col("n") >= max(1, share * words))).select("length", "key").collect()
    keys = {k: np.sort(np.array([r["key"] for r in hot if r["length"] == k], np.int64).view(np.uint64)) for k in range(1, longest)}
    sent = rows.mapInArrow(tidy(_sent(longest, buckets, spark.sparkContext.broadcast(keys), stretches[1])), "bucket int, langs array<string>, words binary, suffixes binary, n int")
    counted = sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_counted(longest, least)), "lang string, phrase string, f long")
    return durable(counted.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)), totals


def _whole(c: Column | str) -> Column:
    """A count as a number whose products cannot overflow."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def scored(counts: DataFrame, scale: int = SCALE) -> DataFrame:
    """(lang, phrase, a, score, k, l, r): for each phrase of two words and more the cut that scores least."""
    p = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    cut = p.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", 1, F.col("k")), " ").alias("head"), F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ").alias("tail"))
    cut = cut.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"]).join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    d = cut.withColumns({"top": F.lit(scale).cast("decimal(10,0)") * _whole("a"), "low": _whole("l") + _whole("r")}).withColumn("score", F.expr("top div low"))
    return d.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("c")).select("lang", "phrase", "a", "c.score", "c.k", "c.l", "c.r")


def contained(counts: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, most): the largest count of a longer phrase around each phrase of two words and more."""
    p = counts.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 2)
    inner = [F.when(F.size("w") >= i + size, F.array_join(F.slice("w", i + 1, size), " ")) for size in range(2, longest) for i in range(longest - size + 1)]
    size = lambda x: F.size(F.split(x, " "))
    return p.select("lang", "f", F.size("w").alias("words"), F.explode(F.array_compact(F.array(*inner))).alias("phrase")).where(size(F.col("phrase")) < F.col("words")).groupBy("lang", "phrase").agg(F.max("f").alias("most"))


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """``found`` with its first ``top`` rows of each language, by score, count and phrase, and their rank from 1."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    d = found.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKERS)))
    d = d.withColumn("rank", F.row_number().over(W.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return d.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best ``top`` phrases of each language."""
    counts, totals = phrase_counts(docs, longest, least)
    found = scored(counts).join(contained(counts, longest), ["lang", "phrase"], "left")
    found = found.where(F.col("most").isNull() | (100 * _whole("most") < covered_percent * _whole("a"))).drop("most")
    return ranked(found, top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, array_to_string(ws[i:i+k-1], ' ') AS phrase, k AS size FROM s, range(1, 5) AS x(k) WHERE i + k - 1 <= len(ws)),
c AS (SELECT lang, phrase, any_value(size) AS size, count(*) AS f FROM g GROUP BY lang, phrase HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
cut AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, size, k FROM c, range(1, 4) AS x(k) WHERE k < size),
sc AS (SELECT t.lang, t.phrase, t.a, t.k, h.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * t.a // (CAST(h.f AS HUGEINT) + r.f) AS BIGINT) AS score FROM cut t
       JOIN c h ON h.lang = t.lang AND h.phrase = array_to_string(t.ws[1:t.k], ' ') JOIN c r ON r.lang = t.lang AND r.phrase = array_to_string(t.ws[t.k+1:], ' ')),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM sc) WHERE o = 1),
o AS (SELECT lang, phrase, max(f) AS most FROM (SELECT lang, f, array_to_string(string_split(phrase, ' ')[i:i+k-1], ' ') AS phrase FROM c, range(1, 4) AS x(i), range(2, 4) AS y(k) WHERE size > 2 AND k < size AND i + k - 1 <= size) GROUP BY lang, phrase),
kept AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.most IS NULL OR 100 * o.most < 80 * b.a)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, CAST(n.n AS BIGINT) AS n, k.score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept) k JOIN n ON n.lang = k.lang WHERE k.rank <= 2000
"""

"""Removal of repeated word sequences by fixed-block anchors (operator 8).

A window of 13 words holds a whole block of 7 wherever blocks begin at every seventh word, so every repeat of
a window touches some reference block of the document it repeats.

1. Every document's non-overlapping blocks of 7 words are indexed; every rolling window of 7 words of every
   document probes the index.  A probe that finds a block of a smaller document is a hit, and so is the block.
2. Around hits, on both sides, the windows of 13 words that hold one are compared in full (64-bit hashes of
   their words, by the smallest document that has each): runs of windows that match are the maximal exact
   repeats that extend the hit.  Words covered by a matching window go.

Both comparisons move packed keys (see ``packed``): 4 bytes a probe, since a false hit only costs a comparison
in step 2.  Texts are shuffled once, and that exchange serves both answers.  A bucket's keys fit in memory by
its share of the input; a passage that a third of all documents share adds one key a document to each of the
buckets of its windows.

Defined results: null and empty texts have no words; rows that share a ``doc_id`` are one document for the
comparison and are each judged; rows without ``doc_id`` are compared with nothing; an empty table gives an
empty table; other columns are not read (``dedup_substrings`` passes them on).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .packed import Packer, batch_of, bucket_count, bucket_of, home, homes, low, member, pack, unpack
from .textnum import SPACED, Words, text_slices

WINDOW = 13
PACKED = "bucket int, kind int, payload binary"
PROBE_BYTES, WINDOW_BYTES, ANSWER_BYTES = 4, 8, 8


def _unique(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, key) pairs, by document."""
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.concatenate([[True], (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])]) if len(h) else np.zeros(0, bool)
    return h[keep], doc[keep]


def _anchors(n: int, size: int):
    """Blocks (kind 0) and probes (kind 1) of documents."""

    def run(batches):
        out = Packer(n, PROBE_BYTES)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, bounds in text_slices(batch.column(1)):
                words = Words(data, bounds, SPACED)
                h, at = words.windows(size)
                doc = np.searchsorted(words.first, at, side="right") - 1
                block = (at - words.first[doc]) % size == 0
                yield from out.add(0, h[block], doc[block], ids[i:j], bucket_of(h[block], n))
                h, doc = _unique(h, doc)
                yield from out.add(1, h, doc, ids[i:j], bucket_of(h, n))
        yield from out.flush()

    return run


class _Answers:
    """Collects (kind, document, key) and gives packed rows by the documents' homes."""

    def __init__(self, n: int, width: int, limit: int = 1 << 20):
        self.n, self.width, self.limit, self.size = n, width, limit, 0
        self.parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def add(self, kind: int, ids: np.ndarray, keys: np.ndarray):
        self.parts.setdefault(kind, []).append((ids, keys))
        self.size += len(ids)
        return self.flush() if self.size >= self.limit else ()

    def flush(self):
        rows = []
        for kind, parts in self.parts.items():
            ids, keys = (np.concatenate(x) for x in zip(*parts))
            if len(ids):
                order = np.argsort(ids, kind="stable")
                u, doc = np.unique(ids[order], return_inverse=True)
                rows += [(b, kind, p) for b, p in pack(keys[order], doc, u, homes(u, self.n)[doc], self.n, self.width)]
        self.parts, self.size = {}, 0
        return (batch_of(rows),) if rows else ()


def _rows(batches):
    """(bucket, kind, payload) in order."""
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), (x.as_py() for x in batch.column(2)))


def _full(keys: np.ndarray, bucket: int) -> np.ndarray:
    """Keys of four bytes, with their bucket in the fifth byte and above."""
    return keys | np.uint64(bucket << 32)


def _match_blocks(n: int):
    """Answers: keys of probes that found a smaller document's block (kind 1), and of blocks found (kind 0)."""

    def run(batches):
        answers = _Answers(n, 8)
        now, blocks, index = None, [], None

        def close():
            if index is not None:
                keys, first, _, most, bk, bd, pos = index
                hit = bd < most[pos]
                yield from answers.add(0, bd[hit], _full(bk[hit], now))

        for bucket, kind, payload in _rows(batches):
            if bucket != now:
                yield from close()
                now, blocks, index = bucket, [], None
            ids, counts, keys = unpack(payload, PROBE_BYTES)
            docs = np.repeat(ids, counts)
            if kind == 0:
                blocks.append((keys, docs))
                continue
            if index is None:
                if not blocks:
                    continue
                bk, bd = (np.concatenate(x) for x in zip(*blocks))
                order = np.lexsort((bd, bk))
                bk, bd = bk[order], bd[order]
                head = np.concatenate([[True], bk[1:] != bk[:-1]])
                index = (bk[head], None, bd[head], np.full(int(head.sum()), np.iinfo(np.int64).min), bk, bd, np.cumsum(head) - 1)
                blocks = []
            u, _, least, most, *_ = index
            at = np.searchsorted(u, keys)
            at[at == len(u)] = 0
            found = u[at] == keys
            at, docs, keys = at[found], docs[found], keys[found]
            np.maximum.at(most, at, docs)
            hit = least[at] < docs
            yield from answers.add(1, docs[hit], _full(keys[hit], now))
        yield from close()
        yield from answers.flush()

    return run


def _answers_of(right: pa.Table, ids: np.ndarray, width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Kind: (keys, position of their document in the sorted ``ids``)."""
    out: dict[int, list] = {}
    for kind, payload in zip(right.column("kind").to_pylist(), (x.as_py() for x in right.column("payload"))):
        who, counts, keys = unpack(payload, width)
        at = np.searchsorted(ids, who)
        out.setdefault(kind, []).append((keys, np.repeat(at, counts)))
    return {k: tuple(np.concatenate(x) for x in zip(*v)) for k, v in out.items()}


def _sorted_ids(left: pa.Table, key: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ids; each row's place among them; which rows have an id."""
    col = left.column(key).combine_chunks()
    has = ~col.is_null().to_numpy(zero_copy_only=False)
    ids = col.fill_null(0).to_numpy(zero_copy_only=False)
    u = np.unique(ids[has])
    return u, np.searchsorted(u, ids), has


def _windows(n: int, size: int, window: int, key: str):
    """Windows around hits, of one home's documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows: list = []
        if right.num_rows and left.num_rows:
            u, place, has = _sorted_ids(left, key)
            told = _answers_of(right, u, 8)
            none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            for i, j, data, bounds in text_slices(left.column("text")):
                words = Words(data, bounds, SPACED)
                h, at = words.windows(size)
                doc = np.searchsorted(words.first, at, side="right") - 1
                keys = _full_many(low(h, PROBE_BYTES), bucket_of(h, n))
                who = place[i:j][doc]
                hit = member(keys, who, *told.get(1, none)) | (((at - words.first[doc]) % size == 0) & member(keys, who, *told.get(0, none)))
                hit &= has[i:j][doc]
                near = np.zeros(len(words) + 1, np.int64)
                flags = np.zeros(len(words) + 1, np.int64)
                flags[at[hit] + 1] = 1
                near = np.cumsum(flags)  # near[p]: hits at words before p
                h, at = words.windows(window)
                if not len(h):
                    continue
                keep = near[at + window - size + 1] > near[at]
                h, at = h[keep], at[keep]
                doc = np.searchsorted(words.first, at, side="right") - 1
                h, doc = _unique(h, doc)
                rows += [(b, 0, p) for b, p in pack(h, doc, u[place[i:j]], bucket_of(h, n), n, WINDOW_BYTES)]
        return pa.Table.from_batches([batch_of(rows)])

    return run


def _full_many(keys: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return keys | bucket.astype(np.uint64) << np.uint64(32)


def _match_windows(n: int):
    """Answers: keys of windows that a smaller document has."""

    def run(batches):
        answers = _Answers(n, ANSWER_BYTES)
        now, parts = None, []

        def close():
            if parts:
                keys, docs = (np.concatenate(x) for x in zip(*parts))
                order = np.lexsort((docs, keys))
                keys, docs = keys[order], docs[order]
                head = np.concatenate([[True], keys[1:] != keys[:-1]])
                later = docs > docs[head][np.cumsum(head) - 1]
                yield from answers.add(0, docs[later], keys[later])

        for bucket, _, payload in _rows(batches):
            if bucket != now:
                yield from close()
                now, parts = bucket, []
            ids, counts, keys = unpack(payload, WINDOW_BYTES)
            parts.append((keys, np.repeat(ids, counts)))
        yield from close()
        yield from answers.flush()

    return run


def _removals(left: pa.Table, right: pa.Table, window: int, key: str):
    """(from row, to row, words, removed flag of each word) of one home's documents."""
    u, place, has = _sorted_ids(left, key)
    told = _answers_of(right, u, ANSWER_BYTES).get(0) if right.num_rows else None
    for i, j, data, bounds in text_slices(left.column("text")):
        words = Words(data, bounds, SPACED)
        gone = np.zeros(len(words), bool)
        if told is not None:
            h, at = words.windows(window)
            if len(h):
                doc = np.searchsorted(words.first, at, side="right") - 1
                hit = member(low(h, ANSWER_BYTES), place[i:j][doc], *told) & has[i:j][doc]
                steps = np.zeros(len(words) + 1, np.int64)
                np.add.at(steps, at[hit], 1)
                np.add.at(steps, at[hit] + window, -1)
                gone = np.cumsum(steps)[:-1] > 0
        yield i, j, words, gone


def _prepared(docs: DataFrame, n: int, key: str, column: str, *more) -> DataFrame:
    return docs.select(F.col(key), F.coalesce(F.col(column), F.lit("")).alias("text"), *more, home(F.col(key).cast("long"), n, F.col(column)).alias("bucket"))


def _answers(docs: DataFrame, n: int, window: int, key: str, column: str) -> DataFrame:
    size = (window + 1) // 2
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(key).cast("long").alias(key), F.coalesce(F.col(column), F.lit("")).alias("text"))
    packed = rows.where(F.col(key).isNotNull()).mapInArrow(_anchors(n, size), PACKED)
    found = packed.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_match_blocks(n), PACKED)
    near = _prepared(docs, n, key, column).groupBy("bucket").cogroup(found.groupBy("bucket")).applyInArrow(_windows(n, size, window, key), PACKED)
    return near.repartition(parts, "bucket").sortWithinPartitions("bucket", "kind").mapInArrow(_match_windows(n), PACKED)


def repeated_words(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row."""
    n = bucket_count(docs)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        total, removed, sha = [], [], []
        for i, j, words, gone in _removals(left, right, window, key):
            raw, first = words.data.tobytes(), words.first.tolist()
            start, end, kept = words.start.tolist(), words.end.tolist(), np.flatnonzero(~gone).tolist()
            cut = np.searchsorted(kept, words.first).tolist() if kept else [0] * len(first)
            for d in range(j - i):
                text = b" ".join([raw[start[k] : end[k]] for k in kept[cut[d] : cut[d + 1]]])
                total.append(first[d + 1] - first[d])
                removed.append(total[-1] - (cut[d + 1] - cut[d]))
                sha.append(hashlib.sha256(text).hexdigest())
        return pa.table({key: left.column(key), "n_words": pa.array(total, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(sha, pa.string())})

    kind = dict(docs.dtypes)[key]
    left = _prepared(docs, n, key, column).groupBy("bucket")
    return left.cogroup(_answers(docs, n, window, key, column).groupBy("bucket")).applyInArrow(run, f"{key} {kind}, n_words long, n_removed long, kept_sha256 string")


def dedup_substrings(docs: DataFrame, window: int = WINDOW, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with repeated words removed from ``column``, kept words joined by one blank; texts without
    repeats stay as they are."""
    n = bucket_count(docs)
    others = F.struct(*docs.columns).alias("row")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = left.column("text").to_pylist()
        for i, j, words, gone in _removals(left, right, window, key):
            if gone.any():
                raw = words.data.tobytes()
                for d in range(j - i):
                    a, b = int(words.first[d]), int(words.first[d + 1])
                    if gone[a:b].any():
                        out[i + d] = b" ".join([raw[words.start[k] : words.end[k]] for k in range(a, b) if not gone[k]]).decode()
        return pa.table({"row": left.column("row"), "text": pa.array(out, pa.string())})

    left = _prepared(docs, n, key, column, others)
    kind = dict(left.dtypes)["row"]
    got = left.groupBy("bucket").cogroup(_answers(docs, n, window, key, column).groupBy("bucket")).applyInArrow(run, f"row {kind}, text string")
    text = F.when(F.col("row").getField(column).isNotNull(), F.col("text"))
    return got.select(*[text.alias(c) if c == column else F.col("row").getField(c).alias(c) for c in docs.columns])


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_words(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, k, array_to_string(w[k:k + 12], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d)),
m AS (SELECT g, min(doc_id) AS least FROM g GROUP BY g), h AS (SELECT r, k FROM g JOIN m USING (g) WHERE least < doc_id),
x AS (SELECT r, list(DISTINCT k + j) AS gone FROM h, range(0, 13) AS y(j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed, sha256(coalesce(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, p: NOT list_contains(gone, p)) END, ' '), '')) AS kept_sha256 FROM d LEFT JOIN x USING (r)
"""

"""Quality scores of whole texts by a factorisation machine (operator 9).

Features are hashed words (damped counts, normalised a document), structure statistics of the text's bytes,
lines and words, and the length the table states for it.  The machine scores them with weights and with
products of low-rank factors for every pair of features, which the identity

    sum of <v_i, v_j> x_i x_j over pairs = 1/2 * sum over factors of ((sum v_i x_i)^2 - sum (v_i x_i)^2)

takes in time linear in the words.  It is fitted on at most ``sample`` labelled rows, those with the smallest
hash of their id, never on held-out ones; labels, lang, source and doc_id are never features.

Defined results: null and empty texts are scored from their statistics alone; without labels of two classes every
score is 0.5; of labelled rows that share an id one is learnt; repeated rows give repeated rows; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, tidy
from .textnum import SPACED_LOWER, Words, text_slices

SAMPLE = 4000
BUCKETS, FACTORS, EPOCHS, BATCH, SEED = 1 << 14, 8, 12, 64, 5

#: Byte classes of the structure statistics.
_CLASS = np.zeros(256, np.uint8)
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:", b"!?", b"|", b"#*$%&<>"), 1):
    _CLASS[list(_chars)] = _i
_CLASS[0x80:] = 10
CLASSES = 11
STATS = CLASSES + 7


def features(data: np.ndarray, bounds: np.ndarray, stated: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of the word features, and one row of statistics a document."""
    n = len(bounds) - 1
    words = Words(data, bounds, SPACED_LOWER)
    size = np.diff(bounds)
    code = np.repeat(np.arange(n, dtype=np.int32) * CLASSES, size) + _CLASS[data]
    count = np.bincount(code, minlength=n * CLASSES).reshape(n, CLASSES).astype(np.float64)
    doc = words.doc_of_words()
    key, times = np.unique(doc * BUCKETS + (words.h & np.uint64(BUCKETS - 1)).astype(np.int64), return_counts=True)
    d, b, v = key // BUCKETS, key % BUCKETS, np.log1p(times)
    norm = np.sqrt(np.bincount(d, v * v, minlength=n))
    v = v / norm[d]
    w, length = words.counts, np.bincount(doc, (words.end - words.start).astype(np.float64), minlength=n)
    distinct = np.bincount(d, minlength=n)
    lines = count[:, 5] + 1
    stats = np.column_stack([count / np.maximum(size, 1)[:, None], np.log1p(w), np.log1p(size), length / np.maximum(w, 1), distinct / np.maximum(w, 1), np.log1p(w / lines), (w < 10).astype(float), np.log1p(stated)])
    return d, b, v, stats


class FactorisationMachine:
    """Weights and factors of BUCKETS word features followed by STATS statistics, and a bias."""

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        size = BUCKETS + STATS
        self.w0, self.w, self.v = 0.0, np.zeros(size), rng.normal(0, 0.02, (size, FACTORS))
        self.mean, self.scale = np.zeros(STATS), np.ones(STATS)

    def _rows(self, d, b, v, stats):
        """The sparse rows with the statistics appended as features."""
        n = len(stats)
        z = np.clip((stats - self.mean) / self.scale, -4, 4) / np.sqrt(STATS)
        rows = np.concatenate([d, np.repeat(np.arange(n), STATS)])
        cols = np.concatenate([b, np.tile(np.arange(BUCKETS, BUCKETS + STATS), n)])
        return rows, cols, np.concatenate([v, z.ravel()]), n

    def _sums(self, rows, cols, x, n):
        vx = self.v[cols] * x[:, None]
        s = np.column_stack([np.bincount(rows, vx[:, f], minlength=n) for f in range(FACTORS)])
        square = np.bincount(rows, (vx * vx).sum(1), minlength=n)
        return s, self.w0 + np.bincount(rows, self.w[cols] * x, minlength=n) + 0.5 * ((s * s).sum(1) - square)

    def score(self, d, b, v, stats) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._sums(*self._rows(d, b, v, stats))[1], -30, 30)))

    def fit(self, docs: list[tuple[np.ndarray, np.ndarray]], stats: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5) -> FactorisationMachine:
        """AdaGrad on the logistic loss. docs: (buckets, values) of each document."""
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = stats.mean(0), stats.std(0) + 1e-9
        p = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.w0 = float(np.log(p / (1 - p)))
        gw, gv, g0 = np.full_like(self.w, 1e-6), np.full_like(self.v, 1e-6), 1e-6
        for _ in range(epochs):
            order = rng.permutation(len(y))
            for k in range(0, len(order), BATCH):
                part = order[k : k + BATCH]
                d = np.repeat(np.arange(len(part)), [len(docs[i][0]) for i in part])
                rows, cols, x, n = self._rows(d, np.concatenate([docs[i][0] for i in part]), np.concatenate([docs[i][1] for i in part]), stats[part])
                s, out = self._sums(rows, cols, x, n)
                err = (1 / (1 + np.exp(-np.clip(out, -30, 30))) - y[part]) / len(part)
                used, at = np.unique(cols, return_inverse=True)
                ex = err[rows] * x
                dw = np.bincount(at, ex) + decay * self.w[used]
                gw[used] += dw * dw
                self.w[used] -= rate * dw / np.sqrt(gw[used])
                vx = self.v[cols] * x[:, None]
                dv = np.column_stack([np.bincount(at, ex * (s[rows, f] - vx[:, f])) for f in range(FACTORS)]) + decay * self.v[used]
                gv[used] += dv * dv
                self.v[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
                g0 += err.sum() ** 2
                self.w0 -= 0.1 * rate * err.sum() / np.sqrt(g0)
        self.w, self.v = self.w.astype(np.float32), self.v.astype(np.float32)
        return self


def held_out(key: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 1 by 3."""
    return F.crc32(key.cast("string").cast("binary")) % 3 == 1


def _stated_of(docs: DataFrame, column: str) -> Column:
    stated = F.col("n_chars").cast("double") if "n_chars" in docs.columns else F.length(column).cast("double")
    return F.greatest(F.coalesce(stated, F.lit(0.0)), F.lit(0.0))


def _read(docs: DataFrame, key: str, column: str) -> DataFrame:
    return docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"), _stated_of(docs, column).alias("stated"))


def _stated(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(2).to_numpy(zero_copy_only=False)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, key: str = "doc_id", column: str = "text") -> FactorisationMachine:
    """A machine fitted on at most ``sample`` labelled rows outside the held-out third."""
    pick = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    pick = pick.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                d, b, v, stats = features(data, bounds, _stated(batch)[i:j])
                cut = np.searchsorted(d, np.arange(j - i + 1))
                at = range(j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(3).slice(i, j - i), pa.array([b[cut[k] : cut[k + 1]].astype(np.int32).tobytes() for k in at], pa.binary()), pa.array([v[cut[k] : cut[k + 1]].astype(np.float32).tobytes() for k in at], pa.binary()), pa.array([s.tobytes() for s in stats], pa.binary()), batch.column(0).slice(i, j - i)],
                    names=["y", "b", "v", "s", "doc_id"],
                )

    kind = dict(docs.dtypes)[key]
    # The sample's size is bounded by the parameter, so it may be broadcast. Of rows that share an id the least text counts.
    rows = _read(docs, key, column).join(F.broadcast(pick), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "stated")).alias("r"), F.max("quality").cast("double").alias("y"))
    rows = rows.select("doc_id", "r.text", "r.stated", "y")
    got = sorted(rows.mapInArrow(tidy(run), f"y double, b binary, v binary, s binary, doc_id {kind}").collect(), key=lambda r: (r["doc_id"], r["s"]))
    fm = FactorisationMachine()
    y = np.array([r["y"] for r in got])
    if len(set(y.tolist())) < 2:
        fm.v[:] = 0
        return fm
    return fm.fit([(np.frombuffer(r["b"], np.int32), np.frombuffer(r["v"], np.float32)) for r in got], np.stack([np.frombuffer(r["s"]) for r in got]), (y > 0).astype(float))


def quality_scores(docs: DataFrame, model: FactorisationMachine, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, held_out, score, predicted) of every row."""
    fm = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                p = fm.value.score(*features(data, bounds, _stated(batch)[i:j])) if j > i else np.zeros(0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(p)], names=[key, "score"])

    kind = dict(docs.dtypes)[key]
    out = _read(docs, key, column).mapInArrow(tidy(run), f"{key} {kind}, score double")
    return out.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rejected_removed(docs: DataFrame, model: FactorisationMachine, column: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents that score below ``threshold``."""
    fm = docs.sparkSession.sparkContext.broadcast(model)
    others = [F.col(c) for c in docs.columns if c != column] or [F.lit(0).alias("_")]
    row = docs.select(F.struct(*others).alias("row"), F.col(column).cast("string").alias("text"), _stated_of(docs, column).alias("stated"))

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                p = fm.value.score(*features(data, bounds, _stated(batch)[i:j]))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["row", "text"]).slice(i, j - i).filter(pa.array(p >= threshold))

    out = row.mapInArrow(tidy(run), f"row {dict(row.dtypes)['row']}, text string")
    return out.select(*[F.col("text").cast(kind).alias(c) if c == column else F.col("row").getField(c).alias(c) for c, kind in docs.dtypes])


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_scores(docs, fit_quality(docs, table(spark, sf_dir, "labels")))

"""Exchange of hash keys between documents in packed form.

Operators that look for equal word windows send one key a word.  As rows that is one object a key; here the
keys of many Arrow slices are dealt to buckets by their upper bits and sent as one binary value a bucket, so a
shuffle moves little more than the keys.  Buckets follow the hash, so a frequent key adds at most one entry a
document to one bucket.  Answers go back in the same form, dealt by document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Estimated input bytes for each bucket, beyond the session's number of shuffle partitions.
BUCKET_BYTES = 16 << 20


def input_bytes(df: DataFrame) -> int:
    """The optimiser's size estimate: that of the files, where rows come from files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def bucket_count(df: DataFrame) -> int:
    """An odd number of buckets that grows with the input."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(max(2 * parts, min(input_bytes(df), 1 << 50) // BUCKET_BYTES), 1 << 20) | 1


def home(key: Column, n: int, spare: Column) -> Column:
    """The answer bucket of a document; ``spare`` deals out documents without an id."""
    return F.pmod(F.coalesce(key.bitwiseXOR(F.shiftrightunsigned(key, 15)).bitwiseXOR(F.shiftrightunsigned(key, 31)), F.xxhash64(spare)), F.lit(n)).cast("int")


def homes(ids: np.ndarray, n: int) -> np.ndarray:
    """The same for an array of ids."""
    u = ids.astype(np.int64).view(np.uint64)
    return np.mod((u ^ (u >> np.uint64(15)) ^ (u >> np.uint64(31))).view(np.int64), n)


def bucket_of(h: np.ndarray, n: int) -> np.ndarray:
    return ((h >> np.uint64(40)) * np.uint64(n) >> np.uint64(24)).astype(np.int64)


def deal(place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of entries by place, and where each place begins in it."""
    order = np.argsort(place.astype(np.uint16 if n < 65536 else np.uint32), kind="stable")
    return order, np.searchsorted(place[order], np.arange(n + 1))


#: Bytes of the whole numbers that a payload's columns may be written in.
_SIZES = ((1, np.int8), (2, np.int16), (4, np.int32), (8, np.int64))


def _small(a: np.ndarray) -> tuple[int, bytes]:
    """(bytes a number, numbers) in the least size that holds them all."""
    lo, hi = (int(a.min()), int(a.max())) if len(a) else (0, 0)
    size, kind = next((s, k) for s, k in _SIZES if np.iinfo(k).min <= lo and hi <= np.iinfo(k).max)
    return size, a.astype(kind).tobytes()


def pack(h: np.ndarray, doc: np.ndarray, ids: np.ndarray, place: np.ndarray, n: int, width: int) -> Iterator[tuple[int, bytes]]:
    """(place, payload) of the keys ``h`` of documents ``ids[doc]``; ``doc`` ascends within a place.

    A payload holds the numbers of documents and keys and columns, the steps from one document's id to the next, keys
    a document, and the keys' lowest ``width`` bytes: the first four of every key together, then the rest.  Steps and
    counts take the fewest bytes that hold them, mostly one, so a document with a single key in a bucket, as it comes
    to be where buckets are many, costs little more than the key.  ``ids`` may have several columns.
    """
    order, begin = deal(place, n)
    h, doc = h[order], doc[order]
    columns = ids.reshape(len(ids), -1)
    for b in np.flatnonzero(np.diff(begin)).tolist():
        keys, d = h[begin[b] : begin[b + 1]], doc[begin[b] : begin[b + 1]]
        heads = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
        parts = [_small(np.diff(np.concatenate([heads, [len(d)]])))]
        with np.errstate(over="ignore"):
            parts += [_small(np.diff(c.astype(np.int64), prepend=np.int64(0))) for c in columns[d[heads]].T]
        raw = keys.astype("<u8").view(np.uint8).reshape(-1, 8)
        yield b, b"".join([np.array([len(heads), len(keys), columns.shape[1], *(s for s, _ in parts)], np.int32).tobytes(), *(p for _, p in parts), np.ascontiguousarray(raw[:, :4]).tobytes(), np.ascontiguousarray(raw[:, 4:width]).tobytes()])


class Packer:
    """Gathers keys of kinds over the slices of a task and gives packed rows (bucket, kind, payload), once there are
    ``limit`` keys.  Where buckets are more than that, a row holds a key or two, and then costs its own 40 bytes."""

    def __init__(self, n: int, width: int, limit: int = 1 << 19):
        self.n, self.width, self.limit, self.size = n, width, limit, 0
        self.parts: dict[int, list[tuple]] = {}

    def add(self, kind: int, h: np.ndarray, doc: np.ndarray, ids: np.ndarray, place: np.ndarray):
        """The keys ``h`` of documents ``ids[doc]``, ``doc`` ascending, for the buckets ``place``."""
        self.parts.setdefault(kind, []).append((h, doc, ids, place.astype(np.int32)))
        self.size += len(h)
        return self.flush() if self.size >= self.limit else ()

    def flush(self):
        rows = []
        for kind, parts in self.parts.items():
            h, doc, ids, place = zip(*parts)
            base = np.cumsum([0, *map(len, ids)])
            doc = np.concatenate([d + b for d, b in zip(doc, base)])
            rows += [(b, kind, p) for b, p in pack(np.concatenate(h), doc, np.concatenate(ids), np.concatenate(place), self.n, self.width)]
        self.parts, self.size = {}, 0
        return (batch_of(rows),) if rows else ()


def batch_of(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    b, k, p = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array(k, pa.int32()), pa.array(p, pa.binary())], names=["bucket", "kind", "payload"])


def unpack(payload: bytes, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, keys a document, keys) of a payload; keys as 64-bit numbers of their lowest ``width`` bytes."""
    m, n, c = np.frombuffer(payload, np.int32, 3).tolist()
    sizes = np.frombuffer(payload, np.int32, c + 1, 12).tolist()
    at, columns = 16 + 4 * c, []
    for size in sizes:
        columns.append(np.frombuffer(payload, dict(_SIZES)[size], m, at))
        at += size * m
    counts = columns[0].astype(np.int32)
    with np.errstate(over="ignore"):
        ids = [np.cumsum(x, dtype=np.int64) for x in columns[1:]]
    raw = np.zeros((n, 8), np.uint8)
    raw[:, :4] = np.frombuffer(payload, np.uint8, 4 * n, at).reshape(n, 4)
    if width > 4:
        raw[:, 4:width] = np.frombuffer(payload, np.uint8, (width - 4) * n, at + 4 * n).reshape(n, width - 4)
    return ids[0] if c == 1 else np.stack(ids, 1), counts, raw.view("<u8").ravel()


def low(h: np.ndarray, width: int) -> np.ndarray:
    return h & np.uint64((1 << 8 * width) - 1)


def member(keys: np.ndarray, doc: np.ndarray, of: np.ndarray, of_doc: np.ndarray) -> np.ndarray:
    """Which (key, document number) pairs are among the pairs (of, of_doc)."""
    odd = np.uint64(0xC2B2AE3D27D4EB4F)
    have = np.unique(of + of_doc.astype(np.uint64) * odd)
    if not len(have):
        return np.zeros(len(keys), bool)
    want = keys + doc.astype(np.uint64) * odd
    at = np.searchsorted(have, want)
    at[at == len(have)] = 0
    return have[at] == want

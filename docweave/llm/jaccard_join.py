"""Exact n-gram Jaccard join by parity sketches (operator 4).

A document's set of word shingles is dealt by hash to K slots, and each slot keeps the XOR of its shingles'
hashes.  A shingle in only one of two documents changes one slot, so the number of differing slots is at most
the symmetric difference, and the same holds for the differing bits of a one-bit-a-shingle parity sketch.
Sets of n and m shingles with similarity 3/4 or more differ in at most (n+m)/7 shingles.  A sketch has two to four
bits a shingle, a power of two: the longer one of a pair folds onto the shorter, and the bound still holds.

1. Documents with equal sets are one class; the smallest doc_id stands for it.
2. Size bands: a band's documents use the same K; those within a quarter of the next band are guests there, so
   every linkable pair meets in some band.
3. Pigeonhole: at most D slots of a pair differ.  Every document sends its first D+1 slots in one global order
   (slots with many shingles first); linkable pairs have one of them in common.
4. Groups of up to ``GROUP`` documents with one slot give all their pairs as candidates.  A larger group gives
   a star and a chain, and its slot is "hot": its documents send slots again with hot slots last in the order,
   the rarer ones of them first.
5. Candidates whose parity sketches differ in more bits than linked sets can are dropped; the others are verified
   in full on 64-bit shingle hashes: first one for each document, then those whose ends are not yet connected.
6. Groups that are still large hold documents made of hot slots, mostly connected by now.  Groups with the same
   smallest document are taken together, so that a pair that shares many slots is compared once; documents outside
   the group's largest component are compared with all its documents by parity sketch, block by block, and verified.
   A group costs its size times the documents outside that component, the one part that is not linear.

So every link between different texts is found or lies inside an already connected component, and no group of
copies is expanded into its pairs.  The components are exact up to collisions of 64-bit hashes, of which 10^10
different shingles hold three pairs or so; a slot key of 40 bits only ever proposes a pair too many.

Defined results: null and empty texts have an empty set and link with nothing; rows that share a ``doc_id``
are one node; rows without ``doc_id`` get no component; an empty table gives an empty table; other columns are
not read (``near_duplicates_removed`` passes them on).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import durable, table, tidy
from .components import components
from .packed import Packer, bucket_count, bucket_of, low, unpack
from .substring_dedup import _rows, _unique
from .textnum import SPACED_LOWER, Words, mix, text_slices

SHINGLE = 5
#: Similarity at least NUM / DEN.
NUM, DEN = 75, 100
#: Documents with one slot of which all pairs are candidates.
GROUP = 12
#: Candidate pairs that a task forms at once.
PAIRS_AT_ONCE = 1 << 17
#: Rows of ids or keys that may be broadcast (8 bytes each); beyond, the same data is joined.
BROADCAST_ROWS = 1 << 20
BLOCK = 1024
KEY_BYTES = 5


def _band_starts() -> np.ndarray:
    """Smallest sizes of the bands; three steps of the largest size ratio of a linkable pair make a band."""
    starts, x = [1], 1
    while x < 1 << 40:
        x = max(x + 1, -(-x * 64 // 27))
        starts.append(x)
    return np.array(starts, np.int64)


BANDS = _band_starts()


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes by document, each one's document, and where each document begins."""
    words = Words(data, bounds, SPACED_LOWER)
    h, at = words.windows(size)
    doc = np.searchsorted(words.first, at, side="right") - 1
    few = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(few):  # the whole sequence is one shingle
        extra = np.array([_sequence(words.h[words.first[d] : words.first[d + 1]]) for d in few], np.uint64)
        h, doc = np.concatenate([h, extra]), np.concatenate([doc, few])
    h, doc = _unique(h, doc)
    return h, doc, np.searchsorted(doc, np.arange(len(bounds)))


def _sequence(h: np.ndarray) -> np.uint64:
    out = np.array([len(h)], np.uint64)
    for x in h:
        out = mix(out * np.uint64(31) + x)
    return out[0]


def parity_sketches(h: np.ndarray, begin: np.ndarray) -> list[bytes]:
    """Each document's parity sketch: a shingle flips one of its bits, of which a power of two, 2 to 4 a shingle."""
    n = np.diff(begin)
    bits = np.int64(1) << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(bits)])
    doc = np.repeat(np.arange(len(n)), n)
    at = first[doc] + (mix(h + np.uint64(77)) & (bits[doc] - 1).astype(np.uint64)).astype(np.int64)
    raw = np.packbits((np.bincount(at, minlength=int(first[-1])) & 1).astype(np.uint8), bitorder="little")
    return [raw[a:b].tobytes() for a, b in zip((first[:-1] // 8).tolist(), (first[1:] // 8).tolist())]


def _folded(s: np.ndarray, words: int) -> np.ndarray:
    """Sketches (one a row) of fewer bits: halves are laid over each other."""
    while s.shape[1] > words:
        half = s.shape[1] // 2
        s = s[:, :half] ^ s[:, half:]
    return s


def bits_apart(left: list[bytes], right: list[bytes]) -> np.ndarray:
    """Bits in which the sketches of each pair differ, at the shorter one's length."""
    size = np.array([(len(a), len(b)) for a, b in zip(left, right)], np.int64).reshape(-1, 2)
    out = np.zeros(len(left), np.int64)
    for la, lb in np.unique(size, axis=0).tolist():
        rows = np.flatnonzero((size == (la, lb)).all(1))
        a, b = (np.frombuffer(b"".join([x[r] for r in rows.tolist()]), np.uint64).reshape(len(rows), -1) for x in (left, right))
        words = min(la, lb) // 8
        out[rows] = np.bitwise_count(_folded(a, words) ^ _folded(b, words)).sum(1)
    return out


def _prints(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2): size and 128-bit signature of every row's set."""

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                h, _, begin = shingle_sets(data, bounds)
                sums = []
                for odd in (1, 0x9E3779B97F4A7C15):
                    total = np.zeros(len(h) + 1, np.uint64)
                    np.cumsum(mix(h + np.uint64(odd)), out=total[1:])
                    sums.append((total[begin[1:]] - total[begin[:-1]]).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(begin)), *map(pa.array, sums)], names=["doc_id", "n", "s1", "s2"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, s1 long, s2 long")


def _full(key: np.ndarray, buckets: int) -> np.ndarray:
    return bucket_of(key, buckets).astype(np.uint64) << np.uint64(40) | low(key, KEY_BYTES)


def _among(x: np.ndarray, known: np.ndarray | None) -> np.ndarray:
    """Which of x are in the sorted array."""
    if known is None or not len(known):
        return np.zeros(len(x), bool)
    at = np.searchsorted(known, x)
    at[at == len(known)] = 0
    return known[at] == x


Hot = tuple[np.ndarray, np.ndarray]


def _lateness(x: np.ndarray, hot: Hot | None) -> np.ndarray:
    """How late keys come in the order: 0 where they are not hot, else by the number of documents that have them.
    hot: sorted keys, and the class of each one's number."""
    late = np.zeros(len(x), np.int64)
    if hot is not None and len(hot[0]):
        at = np.searchsorted(hot[0], x)
        at[at == len(hot[0])] = 0
        is_hot = hot[0][at] == x
        late[is_hot] = hot[1][at[is_hot]]
    return late


def _slots(h: np.ndarray, doc: np.ndarray, n: np.ndarray, buckets: int, hot: Hot | None, every: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Keys that the documents send, and each key's document. n: sizes of the sets."""
    keys, docs = [], []
    band = np.searchsorted(BANDS, n, side="right") - 1
    most = n * DEN // NUM
    for guest in (False, True):
        b = np.maximum(band, 0) + guest
        partner = most if guest else np.minimum(most, BANDS[b + 1] - 1)
        here = (n > 0) & ((most >= BANDS[b]) if guest else True)
        want = np.where(here, (n + partner) * (DEN - NUM) // (DEN + NUM) + 1, 0)
        slots = np.maximum(BANDS[b + 1] // 2, 1)
        on = here[doc]
        hh, dd = h[on], doc[on]
        if not len(hh):
            continue
        slot = ((mix(hh + np.uint64(5)) >> np.uint64(32)) * slots[dd].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        order = np.argsort(dd << 36 | slot, kind="stable")
        place = (dd << 36 | slot)[order]
        head = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        xor = np.bitwise_xor.reduceat(hh[order], head)
        size = np.diff(np.concatenate([head, [len(place)]]))
        sd, sl = place[head] >> 36, place[head] & ((1 << 36) - 1)
        key = mix(mix(xor + np.uint64(1)) + mix((b[sd].astype(np.uint64) << np.uint64(36)) + sl.astype(np.uint64)))
        cold = _lateness(_full(key, buckets), hot) == 0
        short = np.flatnonzero(here & ((np.bincount(sd[cold], minlength=len(n)) < want) | every))
        # Too few slots are filled and not hot: empty ones come before the hot ones, in one order for all.
        owner = np.repeat(short, slots[short])
        empty = np.arange(len(owner)) - np.repeat(np.cumsum(slots[short]) - slots[short], slots[short])
        free = ~_among(owner << 36 | empty, place[head])
        owner, empty = owner[free], empty[free]
        more = mix(np.uint64(0xE) * mix((b[owner].astype(np.uint64) << np.uint64(36)) + empty.astype(np.uint64)))
        size = np.concatenate([size, np.zeros(len(more), np.int64)])
        key, sd = np.concatenate([key, more]), np.concatenate([sd, owner])
        late = _lateness(_full(key, buckets), hot)
        order = np.lexsort((key, -size, late, sd))
        sd, key = sd[order], key[order]
        rank = np.arange(len(sd)) - np.searchsorted(sd, sd)
        first = (rank < want[sd]) | every
        keys.append(key[first])
        docs.append(sd[first])
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    key, doc = np.concatenate(keys), np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return key[order], doc[order]


def _sorted_hot(rows: list[tuple[int, int]]) -> Hot:
    a = np.array(rows, np.int64).reshape(-1, 2)
    keys, first = np.unique(a[:, 0], return_index=True)
    return keys.astype(np.uint64), a[first, 1]


def _send(buckets: int, hot=None, per_doc: bool = False):
    """Packed slots of documents. hot: a broadcast of hot keys with their classes; per_doc: a third column has each
    document's, as (key, class)."""

    def run(batches):
        out = Packer(buckets, KEY_BYTES)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, bounds in text_slices(batch.column(1)):
                h, doc, begin = shingle_sets(data, bounds)
                n = np.diff(begin)
                late = hot.value if hot is not None else None
                if per_doc:
                    late = _sorted_hot([(x["key"], x["class"]) for row in batch.column(2).slice(i, j - i).to_pylist() for x in row or ()])
                key, doc = _slots(h, doc, n, buckets, late)
                yield from out.add(0, key, doc, np.stack([ids[i:j], n], 1), bucket_of(key, buckets))
        yield from out.flush()

    return run


def _all_keys(buckets: int):
    """(key, doc_id) of every slot of documents, for looking up hot keys by a join."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, bounds in text_slices(batch.column(1), 1 << 20):
                h, doc, begin = shingle_sets(data, bounds)
                n = np.diff(begin)
                key, doc = _slots(h, doc, n, buckets, None, every=True)
                full = bucket_of(key, buckets).astype(np.uint64) << np.uint64(40) | low(key, KEY_BYTES)
                yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int64)), pa.array(ids[i:j][doc])], names=["key", "doc_id"])

    return run


def _linkable(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return DEN * np.minimum(n, m) >= NUM * np.maximum(n, m)


def _meet(group: int):
    """(kind, a, b): candidates (0, doc, doc) and members of hot slots (1, key, doc) of each bucket."""

    def found(bucket: int, parts: list):
        keys = np.concatenate([p[0] for p in parts])
        docs, sizes = np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
        order = np.lexsort((docs, keys))
        keys, docs, sizes = keys[order], docs[order], sizes[order]
        again = np.concatenate([[False], (keys[1:] == keys[:-1]) & (docs[1:] == docs[:-1])])
        keys, docs, sizes = keys[~again], docs[~again], sizes[~again]
        head = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.concatenate([head, [len(keys)]]))

        def candidates(a, b):
            good = _linkable(sizes[a], sizes[b])
            a, b = docs[a[good]], docs[b[good]]
            order = np.lexsort((b, a))
            a, b = a[order], b[order]
            new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
            return 0, a[new], b[new]

        for s in np.unique(size[(size > 1) & (size <= group)]).tolist():
            x, y = np.triu_indices(s, 1)
            at = head[size == s]
            step = max(1, PAIRS_AT_ONCE // len(x))
            for k in range(0, len(at), step):
                part = at[k : k + step, None]
                yield candidates((part + x).ravel(), (part + y).ravel())
        if (size > group).any():
            large, count = head[size > group], size[size > group]
            hot = np.repeat(large - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(int(count.sum()))
            first = np.repeat(large, count)
            for k in range(0, len(hot), PAIRS_AT_ONCE):
                h, f = hot[k : k + PAIRS_AT_ONCE], first[k : k + PAIRS_AT_ONCE]
                h, f = h[h > f], f[h > f]
                yield candidates(np.concatenate([f, h - 1]), np.concatenate([h, h]))
                h = hot[k : k + PAIRS_AT_ONCE]
                yield 1, (np.uint64(bucket << 40) | keys[h]).astype(np.int64), docs[h]

    def run(batches):
        def out(bucket, parts):
            for kind, a, b in found(bucket, parts) if parts else ():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(a), pa.array(b)], names=["kind", "a", "b"])

        now, parts = None, []
        for bucket, _, payload in _rows(batches):
            if bucket != now:
                yield from out(now, parts)
                now, parts = bucket, []
            ids, counts, keys = unpack(payload, KEY_BYTES)
            parts.append((keys, np.repeat(ids[:, 0], counts), np.repeat(ids[:, 1], counts)))
        yield from out(now, parts)

    return run


def _only(docs: DataFrame, ids: DataFrame, how: str, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` with (left_semi) or without (left_anti) a key in ``ids``; broadcast if few enough."""
    n = ids.count()
    if n == 0:
        return docs if how == "left_anti" else docs.limit(0)
    ids = ids.select(F.col("doc_id").alias(key))
    return docs.join(F.broadcast(ids) if n <= BROADCAST_ROWS else ids, key, how)


def _sets(docs: DataFrame, sketch: bool) -> DataFrame:
    """(doc_id, n, s): the sorted set in eight bytes a shingle, or the parity sketch."""

    def run(batches):
        for batch in batches:
            for i, j, data, bounds in text_slices(batch.column(1)):
                h, _, begin = shingle_sets(data, bounds)
                s = parity_sketches(h, begin) if sketch else [h[begin[k] : begin[k + 1]].tobytes() for k in range(j - i)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(np.diff(begin)), pa.array(s, pa.binary())], names=["doc_id", "n", "s"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, s binary")


def _with(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs with both ends' (n, s), of which there is one row a doc_id."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("s").alias("s_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("s").alias("s_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "n_a", "n_b", "s_a", "s_b")


def _near_enough(batches):
    """Pairs whose parity sketches differ in no more bits than linked sets can."""
    for batch in batches:
        apart = bits_apart(batch.column(4).to_pylist(), batch.column(5).to_pylist())
        total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
        keep = apart * (DEN + NUM) <= total * (DEN - NUM)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _linked(batches):
    """Pairs whose sets are similar enough."""
    for batch in batches:
        n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        keep = _linkable(n, m)
        for r in np.flatnonzero(keep).tolist():
            a, b = (np.frombuffer(batch.column(k)[r].as_py(), np.uint64) for k in (4, 5))
            same = int(_among(a, b).sum())
            keep[r] = DEN * same >= NUM * (n[r] + m[r] - same)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))


def _verified(pairs: DataFrame, docs: DataFrame, sketches: DataFrame) -> DataFrame:
    """The links among candidate pairs: by sketch, then in full."""
    near = durable(_with(pairs, sketches).mapInArrow(tidy(_near_enough), "a long, b long"))
    return durable(_with(near, _sets(_only(docs, _ends(near), "left_semi"), False).dropDuplicates(["doc_id"])).mapInArrow(tidy(_linked), "a long, b long"))


def _ends(pairs: DataFrame) -> DataFrame:
    return durable(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())


def _labelled(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    la, lb = labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    return pairs.join(la, "a", "left").join(lb, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def _compare_blocks(block: pa.Table) -> pa.Table:
    """Candidates of a block of a hot group's odd documents and a block of all its documents: different components,
    linkable sizes, near sketches."""
    doc, label, n, asks = (block.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "component", "n", "asks"))
    raw = [np.frombuffer(x, np.uint64)[None] for x in block.column("s").to_pylist()]
    words = min(x.size for x in raw)
    s = np.concatenate([_folded(x, words) for x in raw])
    told = np.flatnonzero(~asks)
    a, b = [], []
    for i in np.flatnonzero(asks).tolist():
        near = told[(label[told] != label[i]) & _linkable(n[told], n[i])]
        near = near[np.bitwise_count(s[near] ^ s[i]).sum(1) * (DEN + NUM) <= (n[near] + n[i]) * (DEN - NUM)]
        other = doc[near]
        a.append(np.minimum(other, doc[i]))
        b.append(np.maximum(other, doc[i]))
    pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def _rest(hot: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Candidates between components of the groups (key, doc_id) that stayed large."""
    hot = durable(hot.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = durable(hot.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("doc_id").alias("pivot")).where("lo < hi").select("key", "pivot"))
    # Counted, so that the members of a hot key need not meet in one task to learn its group.
    group = durable(hot.join(F.broadcast(mixed) if mixed.count() <= BROADCAST_ROWS else mixed, "key").select("pivot", "doc_id", "component").distinct())
    parts = group.groupBy("pivot", "component").count().groupBy("pivot").agg(F.max_by("component", "count").alias("most"), F.sum("count").alias("size"), F.max("count").alias("largest"))
    in_blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    parts = durable(parts.select("pivot", "most", in_blocks(F.col("size")).alias("blocks"), in_blocks(F.col("size") - F.col("largest")).alias("odd_blocks")))
    group = group.join(F.broadcast(parts) if parts.count() <= BROADCAST_ROWS else parts, "pivot").join(sketches, "doc_id")
    block = lambda c: F.pmod(F.xxhash64("doc_id"), F.col(c))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    row = ["doc_id", "component", "n", "s"]
    asking = group.where("component <> most").select("pivot", block("odd_blocks").alias("x"), every("blocks").alias("y"), F.lit(True).alias("asks"), *row)
    asked = group.select("pivot", every("odd_blocks").alias("x"), block("blocks").alias("y"), F.lit(False).alias("asks"), *row)
    return asking.union(asked).groupBy("pivot", "x", "y").applyInArrow(_compare_blocks, "a long, b long").distinct()


def near_duplicate_classes(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row."""
    docs = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.col(column), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = bucket_count(docs)
    prints = durable(_prints(docs))
    named = prints.where("n > 0 and doc_id is not null")
    classes = named.groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last")).where("rep < last").drop("last")
    copies = durable(named.join(classes, ["n", "s1", "s2"]).where("doc_id <> rep").select("doc_id", "rep").distinct())
    filled = docs.where("doc_id is not null")
    single = _only(filled, copies.select("doc_id"), "left_anti")

    def met(sent: DataFrame) -> DataFrame:
        return durable(sent.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(_meet(GROUP)), "kind int, a long, b long"))

    packed = "bucket int, kind int, payload binary"
    first = met(single.mapInArrow(tidy(_send(buckets)), packed))
    found, hot = first.where("kind = 0").select("a", "b"), first.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc_id"))
    hot_keys = durable(hot.groupBy("key").count().select("key", F.floor(F.log2("count")).cast("long").alias("class")))
    rest = None
    if n_hot := hot_keys.count():
        again = _only(single, durable(hot.select("doc_id").distinct()), "left_semi").select("doc_id", "text")
        if n_hot <= BROADCAST_ROWS:
            keys = _sorted_hot([(r["key"], r["class"]) for r in hot_keys.collect()])
            sent = again.mapInArrow(tidy(_send(buckets, docs.sparkSession.sparkContext.broadcast(keys))), packed)
        else:
            own = again.mapInArrow(tidy(_all_keys(buckets)), "key long, doc_id long").join(hot_keys, "key").groupBy("doc_id").agg(F.collect_list(F.struct("key", "class")).alias("late"))
            sent = again.join(own, "doc_id", "left").select("doc_id", "text", "late").mapInArrow(tidy(_send(buckets, per_doc=True)), packed)
        second = met(sent)
        found = found.union(second.where("kind = 0").select("a", "b"))
        rest = second.where("kind = 1").select(F.col("a").alias("key"), F.col("b").alias("doc_id"))
    found = durable(found.distinct())
    met_ids = _ends(found)
    if rest is not None:
        met_ids = durable(met_ids.union(rest.select("doc_id")).distinct())
    sketches = durable(_sets(_only(filled, met_ids, "left_semi"), True).dropDuplicates(["doc_id"]))
    links = _verified(durable(found.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")), filled, sketches)
    labels = durable(components(links))
    links = links.union(_verified(durable(_labelled(found, labels)), filled, sketches))
    if rest is not None and not rest.isEmpty():
        labels = durable(components(links))
        links = links.union(_verified(durable(_labelled(_rest(rest, labels, sketches), labels)), filled, sketches))
    every = links.union(copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b")))
    labels = components(every)
    out = prints.join(labels.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select(F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def near_duplicates_removed(docs: DataFrame, key: str = "doc_id", column: str = "text") -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest key."""
    classes = near_duplicate_classes(docs, key, column).where(F.col(key) != F.col("component_id")).select(F.col(key).alias("doc_id")).distinct()
    gone = durable(classes)
    return _only(docs, gone, "left_anti", key).select(*docs.columns)


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 75 * (na.n + nb.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
c AS (SELECT a AS doc_id, a AS o FROM e UNION SELECT c.doc_id, e.b FROM c JOIN e ON e.a = c.o)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce((SELECT min(o) FROM c WHERE c.doc_id = d.doc_id), d.doc_id) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id
"""

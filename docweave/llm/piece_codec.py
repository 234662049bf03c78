"""Exact encoding and decoding with merge-type sentencepiece vocabularies (operator 3).

The encoder keeps an agenda of adjacent symbol pairs ordered by the score of the piece they form, leftmost
first among equals, and merges from the top until no pair forms a piece.  Since no piece of such a vocabulary
holds a word mark after another character, a text falls into independent words in front of its word marks (and
around line breaks, when no piece holds one).  The agenda therefore runs over the distinct words of an Arrow
batch: short words side by side in numpy arrays, one merge per word and round; long ones on a heap.

Every word new to a worker is also encoded and decoded by the sentencepiece library in the same Arrow batch,
behind what it may follow in a text: a blank, a letter where it begins with a mark, or a line's end; a difference raises ``CodecMismatch`` rather than returning ids the library would not give.

Defined results: a null or empty text has no ids and decodes to the empty text; repeated rows give repeated
rows; an empty table gives an empty table; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import REMEMBERS, map_texts, table, vocabulary

MARK = "▁"
#: Words of up to this many characters run side by side; longer ones use the heap.
SIDE_BY_SIDE = 48
#: Words that a worker remembers in each of two generations.
REMEMBERED = 120_000

#: A text is also cut between one of these letters and one of these marks, if no piece of the vocabulary has both in a row.
LETTERS, POINTS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?#*$%&|"

NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class CodecMismatch(RuntimeError):
    """Own ids or text differ from the library's."""


def _fields(buf: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protocol-buffer message: integers, or bytes of nested and fixed-size values."""
    i = 0

    def varint() -> int:
        nonlocal i
        x = s = 0
        while True:
            b = buf[i]
            i += 1
            x |= (b & 127) << s
            s += 7
            if b < 128:
                return x

    while i < len(buf):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
            continue
        n = {1: 8, 5: 4}.get(tag & 7) or varint()
        yield tag >> 3, buf[i : i + n]
        i += n


class PieceCodec:
    def __init__(self, path: str):
        import sentencepiece

        raw = open(path, "rb").read()
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces, scores, kinds, norm, trainer = [], [], [], {}, {}
        for no, v in _fields(raw):
            if no == 1:
                f = dict(_fields(v))
                pieces.append(f.get(1, b"").decode())
                scores.append(np.frombuffer(f[2], "<f4")[0] if 2 in f else np.float32(0))
                kinds.append(f.get(3, NORMAL))
            elif no == 2:
                trainer = dict(_fields(v))
            elif no == 3:
                norm = dict(_fields(v))
        if trainer.get(3) != 2:
            raise ValueError("not a merge-type vocabulary")
        if norm.get(1) not in (b"identity", None) or norm.get(2) or norm.get(4, 1) or USER in kinds or UNUSED in kinds:
            raise ValueError("a normaliser, user-defined or unused pieces are not supported")
        self.prefix = bool(norm.get(3, 1))
        self.id = {p: i for i, p in enumerate(pieces) if kinds[i] == NORMAL}
        self.byte0 = pieces.index("<0x00>")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("pieces cross words")
        self.stop = stop = "" if any("\n" in p for p in self.id) else "\n"
        apart = not any(re.search(f"[{LETTERS}][{POINTS}]", p) for p in self.id)
        self.words = re.compile((f" *[{LETTERS}]+(?=[{POINTS}])|" if apart else "") + f" +[^ {stop}]*|[^ {stop}]+" + (f"|{stop}" if stop else "")).findall
        self.size = len(pieces)
        self.score = np.array(scores, np.float32)
        self.text = pieces
        pair: dict[int, int] = {}
        for p, i in self.id.items():
            for k in range(1, len(p)):
                a, b = self.id.get(p[:k]), self.id.get(p[k:])
                if a is not None and b is not None:
                    pair[a * self.size + b] = i
        self.pair = pair
        self.keys = np.array(sorted(pair), np.int64)
        self.made = np.array([pair[k] for k in self.keys.tolist()], np.int64)
        self.char = -np.arange(0x110000, dtype=np.int64) - 1
        for p, i in self.id.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        self.char[0x20] = self.char[ord(MARK)]
        self.name = [str(i) for i in range(self.size)]
        #: word: its ids joined, their number, its decoded text; of late, and of a while ago
        self.known: dict[str, tuple[str, int, str]] = {}
        self.old: dict[str, tuple[str, int, str]] = {}

    def _symbols(self, words: list[str]) -> np.ndarray:
        """Ids of the characters of words of one length; minus the code point, less 1, where a character is no piece."""
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        return self.char[points].reshape(len(words), -1)

    def _heap(self, sym: list[int]) -> list[int]:
        n, size, score, pair = len(sym), self.size, self.score, self.pair
        sym, nxt, prv = sym[:], [*range(1, n), -1], [*range(-1, n - 1)]
        agenda: list[tuple[float, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if sym[i] >= 0 and sym[j] >= 0 and (m := pair.get(sym[i] * size + sym[j])) is not None:
                heapq.heappush(agenda, (-float(score[m]), i, sym[i], sym[j], m))

        for i in range(n - 1):
            offer(i, i + 1)
        dead = [False] * n
        while agenda:
            _, i, a, b, m = heapq.heappop(agenda)
            j = nxt[i]
            if dead[i] or j < 0 or sym[i] != a or sym[j] != b:
                continue
            sym[i], dead[j], nxt[i] = m, True, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
                offer(i, nxt[i])
            if prv[i] >= 0:
                offer(prv[i], i)
        return [s for s, d in zip(sym, dead) if not d]

    def _find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and pieces of symbol pairs; minus infinity where they form none."""
        k = np.where((a >= 0) & (b >= 0), a * self.size + b, -1)
        at = np.minimum(np.searchsorted(self.keys, k), len(self.keys) - 1)
        hit = self.keys[at] == k
        m = np.where(hit, self.made[at], 0)
        return np.where(hit, self.score[m], -np.inf), m

    def _side_by_side(self, s: np.ndarray) -> list[list[int]]:
        """The agenda of many words of one length: in each round every word merges its best pair."""
        s = s.copy()
        n, w = s.shape
        length = np.full(n, w)
        rows, live = np.arange(n), np.arange(n)
        if w > 1:
            sc, mk = self._find(s[:, :-1], s[:, 1:])
            while len(live):
                best = sc[live].argmax(1)
                good = sc[live, best] > -np.inf
                live, best = live[good], best[good]
                if not len(live):
                    break
                s[live, best] = mk[live, best]
                cols = np.arange(w)
                # close the gap to the right of each merge
                src = np.minimum(cols[None, :] + (cols[None, :] > best[:, None]), w - 1)
                s[live] = np.take_along_axis(s[live], src, 1)
                length[live] -= 1
                src = src[:, : w - 1]
                src = np.minimum(src, w - 2)
                sc[live] = np.take_along_axis(sc[live], src, 1)
                mk[live] = np.take_along_axis(mk[live], src, 1)
                last = length[live] - 1
                for at in (best - 1, best):
                    ok = (at >= 0) & (at < last)
                    r, c = live[ok], at[ok]
                    sc[r, c], mk[r, c] = self._find(s[r, c], s[r, c + 1])
                over = cols[None, : w - 1] >= last[:, None]
                sc[live] = np.where(over, -np.inf, sc[live])
        return [s[i, : length[i]].tolist() for i in rows]

    def _expand(self, symbols: list[int]) -> list[int]:
        if min(symbols, default=0) >= 0:
            return symbols
        return [x for s in symbols for x in ([s] if s >= 0 else [self.byte0 + b for b in chr(-s - 1).encode()])]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        out: list[list[int]] = [[]] * len(words)
        by_len: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_len.setdefault(len(w), []).append(i)
        for n, rows in by_len.items():
            sym = self._symbols([words[i] for i in rows])
            if n <= SIDE_BY_SIDE:  # in parts that stay in a processor's cache
                done = [s for k in range(0, len(rows), 2048) for s in self._side_by_side(sym[k : k + 2048])]
            else:
                done = map(self._heap, sym.tolist())
            for i, s in zip(rows, done):
                out[i] = self._expand(s)
        return out

    def decode_words(self, many: list[list[int]]) -> list[str]:
        """Text of each word's ids: pieces with marks as blanks, runs of byte pieces as UTF-8."""
        b0, b1, text, out = self.byte0, self.byte0 + 256, self.text, []
        for ids in many:
            if min(ids) < b1 and any(b0 <= i < b1 for i in ids):
                out.append(b"".join(bytes([i - b0]) if b0 <= i < b1 else text[i].encode() for i in ids).decode("utf-8", "replace").replace(MARK, " "))
            else:
                out.append("".join([text[i] for i in ids]).replace(MARK, " "))
        return out

    def _check(self, words: list[str], ids: list[list[int]], back: list[str]) -> None:
        """The same words in one text through the library, which puts a mark in front where the model says so."""
        own = [i for w in ids for i in w]
        text, decoded = "".join(words), "".join(back)
        theirs = self.lib.encode(text[1:] if self.prefix else text, num_threads=1)
        if own != theirs:
            at = next((i for i, (a, b) in enumerate(zip(own, theirs)) if a != b), min(len(own), len(theirs)))
            raise CodecMismatch(f"own ids {own[at:at + 20]}, library's {theirs[at:at + 20]}")
        if (decoded[1:] if self.prefix else decoded) != self.lib.decode(theirs):
            raise CodecMismatch("own text differs from the library's")

    def _check_behind(self, lead: list[str], before: str, words: list[str], ids: list[list[int]], back: list[str], which: list[int]) -> None:
        """Checks words, each behind ``before``, in texts that begin with ``lead``."""
        carry = [*lead, before] if before else lead
        own_ids = self.encode_words(carry)
        own_back = self.decode_words(own_ids)
        for i in range(0, len(which), 200):
            seq = [(w, x, b) for w, x, b in zip(lead, own_ids, own_back)]
            for k in which[i : i + 200]:
                seq += [(before, own_ids[-1], own_back[-1])] if before else []
                seq.append((words[k], ids[k], back[k]))
            self._check(*map(list, zip(*seq)))

    def _learn(self, words: list[str]) -> None:
        ids = self.encode_words(words)
        back = self.decode_words(ids)
        blank = [k for k, w in enumerate(words) if (w[0] == " " or not self.prefix) and w[-1] != " "]
        for i in range(0, len(blank), 200):
            part = blank[i : i + 200]
            self._check([words[k] for k in part], [ids[k] for k in part], [back[k] for k in part])
        for k, w in enumerate(words):  # runs of blanks would join what stands beside them
            if w[-1] == " " and len(w) > 1:
                self._check([w], [ids[k]], [back[k]])
        inner = [k for k, w in enumerate(words) if self.prefix and w[0] != " "]
        marked = [k for k in inner if words[k][0] in POINTS]
        self._check_behind([" ", self.stop] if self.stop else [" "], self.stop, words, ids, back, sorted(set(inner) - set(marked)))
        self._check_behind([], " a", words, ids, back, marked)
        name = self.name
        self.known.update((w, (",".join([name[x] for x in i]), len(i), w if w == b else b)) for w, i, b in zip(words, ids, back))

    def split(self, text: str) -> list[str]:
        text = text.replace(MARK, " ")
        return self.words(" " + text if self.prefix else text) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for w in self.encode_words(self.split(text)) for i in w]

    def digest(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(ids, their hash, the decoded text's hash) of each text."""
        cut = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.old, self.known = self.known, {}
        new = {w for c in cut for w in c} - self.known.keys()
        self.known.update((w, self.old[w]) for w in new & self.old.keys())
        if new := list(new - self.known.keys()):
            self._learn(new)
        out, get = [], self.known.__getitem__
        for c in cut:
            if not c:
                out.append((0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()))
                continue
            ids, n, back = zip(*map(get, c))
            text = "".join(back)
            text = text[1:] if self.prefix and text[:1] == " " else text
            out.append((sum(n), hashlib.sha256(",".join(ids).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
        return out


_codecs: dict[str, PieceCodec] = {}
REMEMBERS["piece_codec"] = _codecs.clear


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encode_pieces(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, ids) of every row: the ids themselves, for training files."""

    def make(texts):
        c = codec(path)
        return [pa.array([c.encode(t) for t in texts], pa.list_(pa.int32()))]

    return map_texts(docs, key, column, make, f"{key} {dict(docs.dtypes)[key]}, ids array<int>", "piece_codec")


def decode_pieces(coded: DataFrame, path: str, key: str = "doc_id", column: str = "ids") -> DataFrame:
    """(key, text) of rows of ids; null ids decode to the empty text, as no ids do."""
    names = [key, "text"]

    def run(batches):
        for batch in batches:
            c, out = codec(path), []
            for ids in batch.column(1).to_pylist():
                t = c.decode_words([ids])[0] if ids else ""
                out.append(t[1:] if c.prefix and t[:1] == " " else t)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=names)

    return coded.select(key, column).mapInArrow(run, f"{key} {dict(coded.dtypes)[key]}, text string")


def piece_digests(docs: DataFrame, path: str, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of every row of ``docs``, encoded and decoded in full."""

    def make(texts):
        n, ids, back = zip(*codec(path).digest(texts)) if texts else ((), (), ())
        return [pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(back, pa.string())]

    return map_texts(docs, key, column, make, f"{key} {dict(docs.dtypes)[key]}, n_tokens long, ids_sha256 string, decoded_sha256 string", "piece_codec")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))

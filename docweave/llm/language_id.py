"""Language of whole texts by segmentation-marginalised unigrams (operator 12).

A language gives each piece of a fixed public vocabulary a probability.  A text's words are its runs of letters, each
with the vocabulary's word mark in front; a word can be cut into pieces in many ways, and its probability in a language
is the sum over all of them, which the forward algorithm takes over the word's lattice: nodes are the places between
characters, edges the pieces that fit there.  A character that is no piece goes by its bytes, each with a node of its
own, so every word has a probability.  No piece crosses the mark, so a text's probability is the product over its words.

The probabilities are fitted by expectation and maximisation on at most ``sample`` documents of each language, those with the
smallest hash of their id, never on held-out ones: tasks run the lattices forward and backward and give expected
uses of pieces, in whole numbers so that no order of adding them matters, and the driver turns the sums (one row a
language and piece) into probabilities.  All languages are taken as equally likely beforehand.

Defined results: a null text, or one without letters, is ``und`` with score 0; without anything learnt every text is;
languages with equal scores give the one that sorts first; rows with a null id never teach and are not held out; of rows that
share an id and language one teaches; repeated rows give repeated rows; an empty table gives an empty table; other
columns are not read.  The model holds a row of the vocabulary for each language that ``lang`` names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import REMEMBERS, durable, map_texts, table, tidy, vocabulary

SAMPLE, ROUNDS, SMOOTHING = 1000, 3, 0.1
#: Values remembered by a worker (words times languages), and edges of the lattices worked on at once.
REMEMBERED, EDGES = 1_600_000, 1 << 18
#: Expected uses are counted in parts of this size.
GRAIN = 1 << 20
MARK = "▁"
_WORDS = re.compile(r"[^\W\d_]+")


class Pieces:
    """The vocabulary's pieces that can cut a marked word, as a tree of beginnings, and the 256 bytes."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        usual = [p for p in usual if MARK not in p[1:] and not any(c.isspace() for c in p)]
        #: Numbers of pieces; -1 for what only begins one.
        self.tree: dict[str, int] = {p[:n]: -1 for p in usual for n in range(1, len(p))}
        self.tree.update((p, i) for i, p in enumerate(usual))
        self.bytes_from, self.size = len(usual), len(usual) + 256

    def known(self, char: str) -> bool:
        return self.tree.get(char, -1) >= 0


class Lattices:
    """All ways to cut some words: edges with their piece between nodes that are numbered through."""

    def __init__(self, words: list[str], pieces: Pieces):
        src, dst, piece, many, size = [], [], [], [], []
        get, base = pieces.tree.get, 0
        for w in words:
            w, start = MARK + w, len(src)
            if all(map(pieces.known, w)):
                place = range(base, base + len(w) + 1)
            else:
                place = [base]
                for c in w:
                    raw = c.encode("utf-8", "surrogatepass")
                    if not pieces.known(c):
                        src += range(place[-1], place[-1] + len(raw))
                        dst += range(place[-1] + 1, place[-1] + len(raw) + 1)
                        piece += [pieces.bytes_from + b for b in raw]
                    place.append(place[-1] + (1 if pieces.known(c) else len(raw)))
            for i in range(len(w)):
                for j in range(i + 1, len(w) + 1):
                    p = get(w[i:j])
                    if p is None:
                        break
                    if p >= 0:
                        src.append(place[i])
                        dst.append(place[j])
                        piece.append(p)
            many.append(len(src) - start)
            size.append(place[-1] - base + 1)
            base = place[-1] + 1
        self.src, self.dst, self.piece = (np.array(x, np.int64) for x in (src, dst, piece))
        self.word = np.repeat(np.arange(len(words)), many)
        self.first = np.concatenate([[0], np.cumsum(size)])[:-1].astype(np.int64)
        self.last = self.first + np.array(size, np.int64) - 1
        self.nodes = base

    def sums(self, weight: np.ndarray, back: bool = False) -> np.ndarray:
        """Log sums, for each node and column of ``weight`` (a row an edge), over the ways to it from its word's
        beginning; ``back``: to its word's end from it."""
        a, b, start = (self.dst, self.src, self.last) if back else (self.src, self.dst, self.first)
        step = np.abs(b - start[self.word])
        order = np.lexsort((b, step))
        a, b, step, weight = a[order], b[order], step[order], weight[order]
        out = np.full((self.nodes, weight.shape[1]), -np.inf)
        out[start] = 0
        cut = np.flatnonzero(np.concatenate([[True], step[1:] != step[:-1], [True]])) if len(step) else []
        for i, j in zip(cut[:-1], cut[1:]):
            at = np.flatnonzero(np.concatenate([[True], b[i + 1 : j] != b[i : j - 1]]))
            out[b[i:j][at]] = np.logaddexp.reduceat(out[a[i:j]] + weight[i:j], at, axis=0)
        return out

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log probability of each word, by column."""
        return self.sums(weight)[self.last]

    def uses(self, weight: np.ndarray) -> np.ndarray:
        """Probability of each edge given its word, by column."""
        ahead = self.sums(weight)
        return np.exp(ahead[self.src] + weight + self.sums(weight, True)[self.dst] - ahead[self.last][self.word])


def _groups(words: list[str]):
    """Indexes of words of like length, few enough that their lattices stay small."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    i = 0
    while i < len(order):
        j, size = i, 0
        while j < len(order) and (j == i or size < EDGES):
            size += 4 * len(words[order[j]]) + 4
            j += 1
        yield order[i:j]
        i = j


_pieces: dict[str, Pieces] = {}


def pieces_of(path: str) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


class LanguageModel:
    """Log probabilities of the vocabulary's pieces, a row a language."""

    def __init__(self, path: str, langs: list[str], log_p: np.ndarray):
        self.path, self.langs, self.log_p = path, langs, log_p.astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.table = np.zeros((0, len(self.langs)))

    def __getstate__(self):
        return self.path, self.langs, self.log_p

    def __setstate__(self, state):
        self.__init__(*state)

    def word_scores(self, words: list[str]) -> np.ndarray:
        """Log probability of each word in each language, over all its segmentations."""
        out = np.zeros((len(words), len(self.langs)))
        for group in _groups(words):
            lattices = Lattices([words[i] for i in group], pieces_of(self.path))
            out[group] = lattices.forward(self.log_p.T[lattices.piece].astype(np.float64))
        return out

    def text_scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities by language, whether there is a letter) of each text."""
        cut = [_WORDS.findall(t) for t in texts]
        if len(self.at) * max(1, len(self.langs)) > REMEMBERED:
            self.forget()
        new = sorted({w for c in cut for w in c} - self.at.keys())
        self.table = np.concatenate([self.table, self.word_scores(new)])
        self.at.update(zip(new, range(len(self.at), len(self.at) + len(new))))
        lettered = np.array([any(c.isalpha() for w in words for c in w) for words in cut], bool)
        counts = np.array([len(c) for c in cut], np.int64)
        ids = np.fromiter((self.at[w] for c in cut for w in c), np.int64, int(counts.sum()))
        text = np.repeat(np.arange(len(texts)), counts)
        return np.stack([np.bincount(text, self.table[ids, k], minlength=len(texts)) for k in range(len(self.langs))], 1), lettered

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Each text's language and its probability among the languages."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        scores, lettered = self.text_scores(texts)
        p = np.exp(scores - scores.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        best = p.argmax(1)
        return [self.langs[k] if there else "und" for k, there in zip(best.tolist(), lettered)], np.where(lettered, p.max(1), 0.0)


def held_out(key: Column) -> Column:
    """Rows that never teach: crc32 of the id as text leaves 2 by 4."""
    return F.crc32(key.cast("string").cast("binary")) % 4 == 2


def _sampled(docs: DataFrame, sample: int, key: str, column: str, lang: str) -> DataFrame:
    """(lang, text) of at most ``sample`` documents a language."""
    rows = docs.select(F.col(lang).cast("string").alias("lang"), F.col(key).alias("id"), F.col(column).alias("text"), F.xxhash64(F.col(key)).alias("h"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id")))
    nth = F.row_number().over(W.partitionBy("lang").orderBy("h", "id"))
    # The smallest hashes of each task's rows are found before they meet.
    bar = rows.select("lang", "id", "h").distinct().withColumn("nth", nth).where(F.col("nth") <= sample).groupBy("lang").agg(F.max("h").alias("bar"))
    return rows.join(F.broadcast(bar), "lang").where("h <= bar").groupBy("lang", "id").agg(F.min("text").alias("text")).select("lang", "text")


def _sample_words(batches):
    for batch in batches:
        counts: dict[tuple[str, str], int] = {}
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            counts.setdefault((lang, ""), 0)  # a language is known even where its texts have no letters
            for w in _WORDS.findall(text):
                counts[lang, w] = counts.get((lang, w), 0) + 1
        rows = [*counts] or [("", "")]
        langs, words = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array([counts.get(r, 0) for r in rows], pa.int64())], names=["lang", "word", "n"]).slice(0, len(counts))


def fit_languages(docs: DataFrame, path: str, sample: int = SAMPLE, rounds: int = ROUNDS, key: str = "doc_id", column: str = "text", lang: str = "lang") -> LanguageModel:
    """A model fitted on ``docs`` that are not held out."""
    size = pieces_of(path).size
    words = durable(_sampled(docs, sample, key, column, lang).mapInArrow(tidy(_sample_words), "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = sorted(r["lang"] for r in words.select("lang").distinct().collect())
    log_p = np.full((len(langs), size), -np.log(size), np.float32)
    row = {x: k for k, x in enumerate(langs)}
    for _ in range(rounds if langs else 0):
        model = docs.sparkSession.sparkContext.broadcast(log_p)

        def uses(batches, model=model):
            """Expected uses of pieces by language, in grains."""
            pieces = pieces_of(path)
            total = np.zeros((len(langs), pieces.size), np.int64)
            for batch in batches:
                lang, word, n = (c.to_pylist() for c in batch.columns)
                for group in _groups(word):
                    lattices = Lattices([word[i] for i in group], pieces)
                    k = np.array([row[lang[i]] for i in group])[lattices.word]
                    used = lattices.uses(model.value[k, lattices.piece].astype(np.float64)[:, None])[:, 0]
                    np.add.at(total, (k, lattices.piece), np.rint(used * GRAIN).astype(np.int64) * np.array([n[i] for i in group])[lattices.word])
            k, p = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(p, pa.int32()), pa.array(total[k, p])], names=["k", "piece", "uses"])

        found = words.where("n > 0").mapInArrow(tidy(uses), "k int, piece int, uses long").groupBy("k", "piece").agg(F.sum("uses").alias("uses")).toArrow()
        total = np.full((len(langs), size), SMOOTHING)
        total[found["k"].to_numpy(), found["piece"].to_numpy()] += found["uses"].to_numpy() / GRAIN
        log_p = np.log(total / total.sum(1, keepdims=True)).astype(np.float32)
    return LanguageModel(path, langs, log_p)


_current: list[LanguageModel] = []
REMEMBERS["language_id"] = lambda: [m.forget() for m in _current]


def languages(docs: DataFrame, model: LanguageModel, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts):
        m = shared.value
        if m not in _current:
            _current[:] = [m]
        langs, score = m.predict(texts)
        return [pa.array(langs, pa.string()), pa.array(score)]

    out = map_texts(docs, key, column, make, f"{key} {dict(docs.dtypes)[key]}, lang_pred string, score double", "language_id")
    return out.select(key, F.coalesce(held_out(F.col(key)), F.lit(False)).alias("held_out"), "lang_pred", "score")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return languages(docs, fit_languages(docs, vocabulary("piece_bpe_32k.model")))

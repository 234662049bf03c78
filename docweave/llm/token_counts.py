"""Token counts of whole texts under a public vocabulary (operator 6).

The library is asked for lengths only.  A text is cut where no token can cross: in front of a blank or a line
break that stands alone between two non-blank characters, which the byte-level pre-tokenizer always separates.
Equal pieces have equal lengths, so each Arrow batch asks the library only for pieces not seen lately, in
groups balanced by bytes; a long text costs no more memory than its pieces.

Defined results: a null or empty text has 0 bytes and 0 tokens; repeated rows give repeated rows; an empty
table gives an empty table; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import REMEMBERS, map_texts, table, vocabulary

#: Blank characters as the byte-level pre-tokenizer's pattern sees them.
BLANKS = "\t-\r \x85\xa0  -     　"
#: Letters and marks between which the pattern always cuts; "<", "|" and ">" are left out, as special strings hold them.
_LETTERS, _POINTS = "A-Za-zÀ-ÖØ-öø-ÿ", ".,;:!?#*$%&"
_PIECES = re.compile(f" ?[{_LETTERS}]+(?=[{_POINTS}])| ?[^{BLANKS}]+|\n(?=[^{BLANKS}])|[{BLANKS}]+[^{BLANKS}]*")

#: Distinct pieces whose lengths a worker remembers in each of two generations, and bytes of pieces sent to the library at once.
REMEMBERED = 400_000
GROUP_BYTES = 256 << 10


class PieceCounter:
    """Lengths of texts in tokens; ``kind`` "json" is a tokenizers file, "model" a sentencepiece one."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.known: dict[str, int] = {}
        self.old: dict[str, int] = {}
        if path.endswith(".json"):
            from tokenizers import Tokenizer

            self.tok = Tokenizer.from_file(path)
            self.tok.no_truncation()
            self.tok.no_padding()
            self.split = _PIECES.findall if self._byte_level() else None
            self.lengths = lambda group: [len(e) for e in self.tok.encode_batch_fast(group, add_special_tokens=False)]
        else:
            import sentencepiece

            self.tok = sentencepiece.SentencePieceProcessor(model_file=path)
            self.split = None
            self.lengths = lambda group: [len(x) for x in self.tok.encode(group, num_threads=1)]

    def _byte_level(self) -> bool:
        """Cutting is exact for the plain byte-level scheme only; any other file gets whole texts."""
        import json

        spec = json.loads(self.tok.to_str())
        pre = spec.get("pre_tokenizer") or {}
        odd = [t for t in spec.get("added_tokens", []) if re.search(f"[{BLANKS}]", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]]
        return spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not odd

    def _learn(self, pieces: list[str]) -> None:
        group, size = [], 0
        for p in pieces:
            group.append(p)
            size += len(p.encode())
            if size >= GROUP_BYTES:
                self.known.update(zip(group, self.lengths(group)))
                group, size = [], 0
        if group:
            self.known.update(zip(group, self.lengths(group)))

    def counts(self, texts: list[str]) -> list[int]:
        if self.split is None:
            out: list[int] = []
            group, size = [], 0
            for t in texts:
                group.append(t)
                size += len(t.encode())
                if size >= GROUP_BYTES:
                    out += self.lengths(group)
                    group, size = [], 0
            return out + (self.lengths(group) if group else [])
        cut = [self.split(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.old, self.known = self.known, {}
        new = {p for c in cut for p in c} - self.known.keys()
        self.known.update((p, self.old[p]) for p in new & self.old.keys())
        self._learn(list(new - self.known.keys()))
        get = self.known.__getitem__
        return [sum(map(get, c)) for c in cut]


_counters: dict[str, PieceCounter] = {}
REMEMBERS["token_counts"] = _counters.clear


def counter(path: str) -> PieceCounter:
    if path not in _counters:
        _counters[path] = PieceCounter(path)
    return _counters[path]


def token_counts(docs: DataFrame, path: str, limit: int = 1024, key: str = "doc_id", column: str = "text") -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row of ``docs``."""

    def make(texts):
        n = counter(path).counts(texts)
        return [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())]

    return map_texts(docs, key, column, make, f"{key} {dict(docs.dtypes)[key]}, n_bytes long, n_tokens long, over_limit boolean", "token_counts")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))

"""Small helpers that several training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workers import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file; operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def row_slices(texts: list[str], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most ``limit`` characters each; a longer text is alone in its range."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= limit):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def map_texts(df: DataFrame, keep: str, column: str, make: Callable, schema: str, own: str = "") -> DataFrame:
    """Run ``make(texts) -> columns`` over Arrow batches of (keep, column); null text is the empty text.

    Only the two named columns are read, so other columns, whatever their names, play no part.
    """

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for i, j in row_slices(texts, 4 << 20):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *make(texts[i:j])], names=names)

    names = [x.split(" ")[0] for x in schema.split(", ")]
    return df.select(F.col(keep), F.col(column)).mapInArrow(tidy(run, own), schema)


def durable(df: DataFrame) -> DataFrame:
    """``df`` written to the session's shared checkpoint folder and read back: computed once, lineage cut, and
    safe when executors are lost."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: What a worker remembers between batches, by operator, and how to forget it.
REMEMBERS: dict[str, Callable[[], None]] = {}


def tidy(run: Callable, own: str = "") -> Callable:
    """``run`` for mapInArrow in a worker that outlives it: what other operators remembered there is forgotten
    first, and freed memory goes back to the system at the end of the task."""

    def tidied(batches):
        for name, forget in REMEMBERS.items():
            if name != own:
                forget()
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL("libc.so.6").malloc_trim(0)

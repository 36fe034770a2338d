"""What several text operators share: reading documents, storing, batches for Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Maps A-Z to a-z and nothing else, for bytes.
LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


class WordMemo(dict):
    """Values by word, for the life of a worker process, in bounded memory.

    Holds at most ``most`` words of up to ``letters`` letters: of every half that fills up, those met again in
    the next half stay. Longer words (addresses, encoded data) are made anew each time.
    """

    def __init__(self, make: Callable[[str], object], most: int, letters: int = 64):
        super().__init__()
        self.make, self.half, self.letters, self.before = make, most // 2, letters, {}

    def __missing__(self, word: str) -> object:
        if len(word) > self.letters:
            return self.make(word)
        value = self.before.pop(word, None)
        if value is None:
            value = self.make(word)
        if len(self) >= self.half:
            self.before = dict(self)
            self.clear()
        self[word] = value
        return value


_WORKER: dict[str, object] = {}


def worker_value(key: str, make: Callable[[], object]) -> object:
    """One long-lived value a worker process: another key drops the one before, so stages do not add up."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = make()
    return _WORKER[key]


def drop_worker_value() -> None:
    """Free the value that an earlier stage left in this worker process; for stages that keep none."""
    _WORKER.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def split_words(text: str) -> list[bytes]:
    """Words of a text as UTF-8. ``bytes.split`` cuts at exactly the six separators of ``WORD``."""
    return text.encode("utf-8", "surrogatepass").split()


def small_batches(batches: Iterator[pa.RecordBatch], text: str, most_bytes: int = 8 << 20, most_rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a task holds few texts as Python objects at a time; a longer text comes alone."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            if i > start and (held + size > most_bytes or i - start >= most_rows):
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)

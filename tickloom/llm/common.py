"""Helpers shared by the operators: word rules, tables, Arrow columns and hashing of keys."""
from __future__ import annotations

import threading
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the word rule `[^\x20\x09-\x0D]+`; bytes.split() cuts at exactly these characters.
SPACE = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]"
WORD_CLASS = "[^\\x20\\x09-\\x0D]"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


BATCH = "4m"


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of 4 MB, not of Spark's 64 MB, of which each task holds several, on both sides."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH)


def text_of(name: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """Words in order; none in an empty or blank text."""
    return F.array_remove(F.split(text, f"{SPACE_CLASS}+", -1), "")


def remainder(column: Column, by: int) -> Column:
    """crc32 of the value as text, modulo `by`; null values count as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % by


_TABLE: dict = {}
_USED = [0.0]
IDLE_SECONDS = 5


def worker_table(kind: str, make: Callable[[], dict]) -> dict:
    """A table that the tasks of a Python worker share; to be asked for again with each batch.

    A worker keeps the table of one kind, that which it used last, and none once it has been idle for a few seconds.
    """
    _USED[0] = time.monotonic()
    if kind not in _TABLE:
        _TABLE.clear()
        _TABLE[kind] = make()
        threading.Thread(target=_give_back, args=(_TABLE[kind],), daemon=True).start()
    return _TABLE[kind]


def _give_back(table: dict) -> None:
    """Wait until the worker is idle, then let go of the table, if it is still the one in use."""
    while any(t is table for t in _TABLE.values()):
        if time.monotonic() - _USED[0] > IDLE_SECONDS:
            _TABLE.clear()
        time.sleep(1)
    del table
    pa.default_memory_pool().release_unused()


def smallest_hashes(hash_: str, rows: int, of: int) -> Column:
    """A filter that some twice `rows` of `of` rows pass, those with the smallest hashes.

    It stands before a limit in the order of the hash, so that a task passes on few rows whatever the number of tasks.
    """
    share = min(1.0, (2 * rows + 100) / max(1, of))
    return F.col(hash_) <= F.lit(min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64))))


def utf8(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, empty for nulls."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def arrow_rows(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch, so that what is derived from it stays small."""
    for start in range(0, batch.num_rows, size):
        yield batch.slice(start, size)


def list_array(values: np.ndarray, lengths: list[int], kind: pa.DataType) -> pa.ListArray:
    """One list per length, cut from `values` in order."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows, regrouped so that all rows of a key stand in the same batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(key)
        cut = _last_change(column)
        if held and (cut > 0 or held[-1].column(key)[-1].as_py() != column[0].as_py()):
            if held[-1].column(key)[-1].as_py() != column[0].as_py():
                yield _joined(held)
                held = []
        if cut > 0:
            yield _joined([*held, batch.slice(0, cut)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield _joined(held)


def _last_change(column: pa.Array) -> int:
    """Where the last run of equal values begins."""
    values = column.to_numpy(zero_copy_only=False)
    changes = np.flatnonzero(values[1:] != values[:-1])
    return int(changes[-1]) + 1 if len(changes) else 0


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]

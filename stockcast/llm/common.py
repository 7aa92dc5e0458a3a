"""Helpers shared by the operators of this subpackage.

* ``stored``: write a frame as Parquet in the shared scratch folder and read it
  back (cuts the lineage, survives lost executors).
* byte-level scanning of whole Arrow batches: words are found and hashed with
  numpy over the concatenated UTF-8 bytes, without a Python loop per word.
  Word separators and A-Z are ASCII, so working on bytes equals working on
  code points.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockcast.session import scratch_path, ship_package

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Text bytes scanned at once by the numpy helpers; a longer text is scanned
#: alone, whole.
SCAN_BYTES = 1 << 19


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    if spark.conf.get(BATCH_ROWS, "10000") == "10000":  # left at its default: texts are long rows
        spark.conf.set(BATCH_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], by: str, pieces: int = 64) -> DataFrame:
    """Left join of ``rows`` with a table of unique ``keys``, where one key may hold any
    share of the rows: the table's row goes to each (key, piece of its rows) first, so
    that the rows of a key are dealt over ``pieces`` join keys. ``by`` deals them."""
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(by), F.lit(pieces)))
    wanted = dealt.select(*keys, "_piece").distinct()
    return dealt.join(wanted.join(table, keys), [*keys, "_piece"], "left").drop("_piece")


def give_back() -> None:
    """Returns memory of a Python worker, which outlives its tasks, to the system."""
    _powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # no such call in this C library
        pass


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z alone."""
    return F.translate(c, UPPER, LOWER)


# ------------------------------------------------------------ byte scanning

_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
IS_WORD = ~_SEP
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32

_U = np.uint64
_P = 0x9E3779B97F4A7C55  # odd, so that powers have inverses modulo 2^64
_P_INV = pow(_P, -1, 1 << 64)
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_powers: dict[str, np.ndarray] = {}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the multiplier and of its inverse."""
    if len(_powers.get("p", ())) < n:
        for key, base in (("p", _P), ("i", _P_INV)):
            steps = np.full(max(n, SCAN_BYTES), base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["p"][:n], _powers["i"][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Words:
    """Words of a run of texts: ``start``/``end`` byte positions, ``doc`` (index
    of the text each belongs to), ``first`` (index of each text's first word,
    one more entry than texts) and, on demand, 64-bit hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        word = IS_WORD[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = word
        after = np.zeros(len(data) + 1, bool)
        after[:-1] = word
        cuts = offsets[:-1]
        before[cuts] = False  # a text's first byte has nothing before it
        after[offsets[1:]] = False
        self.start = np.flatnonzero(word & ~before[:-1])
        self.end = np.flatnonzero(word & ~after[1:]) + 1
        self.first = np.searchsorted(self.start, offsets)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def hashes(self, lower: bool = True) -> np.ndarray:
        data = LOWERED[self.data] if lower else self.data
        p, inverse = _power(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_VALUE[data] * p[: len(data)], out=total[1:])
        h = (total[self.end] - total[self.start]) * inverse[self.start]
        return mixed(h + (self.end - self.start).astype(np.uint64))


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null counts as empty."""
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SCAN_BYTES):
    """Cuts texts into runs [a, b) of at most ``limit`` bytes, one text at least."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b
        a = b


def word_runs(column: pa.Array, limit: int = SCAN_BYTES):
    """(a, b, Words) over the texts of a column, a bounded number of bytes at a time."""
    data, offsets = texts_of(column)
    for a, b in slices(offsets, limit):
        yield a, b, Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])

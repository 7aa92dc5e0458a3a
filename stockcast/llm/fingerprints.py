"""Document fingerprints by one-permutation MinHash.

A text's distinct five-word shingles are hashed once. The top bits of a hash
choose one of ``BINS`` bins, each keeps its smallest hash. Bins left empty are filled
by optimal densification: bin i tries the bins that a fixed hash of (i, attempt)
names until it meets one that was not empty, so that every empty bin copies a
full one drawn uniformly and independently. Of each bin's hash the ``BITS`` low
bits are stored, packed and written in hexadecimal.

Likeness of two fingerprints: the share P of bins that agree, corrected for the bits
that agree by chance, C = 2^-BITS: (P - C) / (1 - C), within 0 and 1. Its standard
error is about sqrt(P (1 - P) / BINS) / (1 - C): 0.03 at 0.6.

``with_edits`` compares each document with an edited form that takes its end from
the next document in id order. Texts move once, dealt by ranges of the id: a task
streams its sorted range looking one row ahead; the last row of a range waits for
the first of the next one, which one join of range edges brings (two rows a
range, never all rows in one task).

Edge cases: null text counts as empty; a text without words has the empty fingerprint,
which is like another empty one (1) and unlike all others (0). Fewer than five words:
the whole sequence is the one shingle. Rows that share an id follow one another by a
hash of the text, then the text; rows without id come last. A table of one row is its own next. An
empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.common import give_back, mixed, stored
from stockcast.llm.ngram_join import shingle_runs

SHINGLE = 5
BIN_BITS, BITS = 8, 4
BINS = 1 << BIN_BITS
CHANCE = 2.0**-BITS

_U = np.uint64


class _Donors:
    """attempt -> for every bin, the bin it asks at that attempt (the same everywhere)."""

    def __init__(self):
        self.rows: list[np.ndarray] = []

    def __getitem__(self, attempt: int) -> np.ndarray:
        while len(self.rows) <= attempt:
            seed = _U((len(self.rows) + 1) << 32)
            self.rows.append((mixed(np.arange(BINS, dtype=_U) + seed) >> _U(64 - BIN_BITS)).astype(np.int64))
        return self.rows[attempt]


_donors = _Donors()


def densified(bins: np.ndarray, full: np.ndarray) -> np.ndarray:
    """``bins`` with each bin that is not ``full`` copied from a full one."""
    source = np.arange(BINS)
    empty, attempt = np.flatnonzero(~full), 0
    while len(empty):
        asked = _donors[attempt][empty]
        hit = full[asked]
        source[empty[hit]] = asked[hit]
        empty, attempt = empty[~hit], attempt + 1
    return bins[source]


def packed(grams: np.ndarray) -> bytes:
    """Fingerprint of a set's sorted distinct hashes; of no hashes, no bytes."""
    if not len(grams):
        return b""
    which = (grams >> _U(64 - BIN_BITS)).astype(np.int64)
    least = np.flatnonzero(np.r_[True, which[1:] != which[:-1]])  # sorted: a bin's first is its smallest
    bins, full = np.zeros(BINS, np.uint8), np.zeros(BINS, bool)
    bins[which[least]] = (grams[least] & _U((1 << BITS) - 1)).astype(np.uint8)
    full[which[least]] = True
    bins = densified(bins, full)
    return (bins[0::2] << 4 | bins[1::2]).tobytes() if BITS == 4 else np.packbits(np.unpackbits(bins[:, None], axis=1)[:, 8 - BITS :]).tobytes()


def packed_texts(texts: list[str]) -> list[bytes]:
    return [packed(grams) for _, grams in shingle_runs(pa.array(texts, pa.string()), SHINGLE)]


def likeness(a: bytes, b: bytes) -> float:
    """Estimated Jaccard similarity of the sets behind two fingerprints."""
    if not a or not b:
        return float(a == b)
    x, y = (np.unpackbits(np.frombuffer(f, np.uint8)).reshape(BINS, BITS) for f in (a, b))
    agree = float((x == y).all(axis=1).mean())
    return min(1.0, max(0.0, (agree - CHANCE) / (1 - CHANCE)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) a row; equal texts have equal fingerprints."""

    def run(batches):
        for batch in batches:
            found = packed_texts([t or "" for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f.hex() for f in found], pa.string())], ["doc_id", "fingerprint"])
        give_back()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by the start of another text."""
    take = len(text) // 4
    return text[: len(text) - take] + following[:take]


_KIND = (
    "part int, place long, first boolean, last boolean, doc_id long, n_chars long, text string, "
    "edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"
)
_NAMES = [f.split()[0] for f in _KIND.split(", ")]


def _compared(text: str, own: bytes, other: str, following: bytes) -> tuple:
    """What follows from a document and its next one, but for the edited text's print."""
    changed = edited(text, other)
    return changed, hashlib.sha256(changed.encode()).hexdigest(), likeness(own, following)


def _streamed(batches):
    """A sorted range: every row with what its next row says; a range's first and
    last rows keep their text, the last one still lacks its next."""
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    place, held = 0, None  # held: (place, id, text, print) of the row that waits for its next

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_ARROW)], _NAMES)

    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        if not texts:
            continue
        prints = packed_texts(texts)
        queue = ([held] if held else []) + [(place + k, i, t, p) for k, (i, t, p) in enumerate(zip(ids, texts, prints))]
        place, held = place + len(ids), queue[-1]
        pairs = list(zip(queue, queue[1:]))
        facts = [_compared(a[2], a[3], b[2], b[3]) for a, b in pairs]
        new = packed_texts([f[0] for f in facts])
        rows = [
            (part, a[0], a[0] == 0, False, a[1], len(a[2]), a[2] if a[0] == 0 else None, f[1], a[3], e, likeness(a[3], e), f[2])
            for (a, _), f, e in zip(pairs, facts, new)
        ]
        if rows:
            yield out(rows)
    if held:
        yield out([(part, held[0], held[0] == 0, True, held[1], len(held[2]), held[2], None, held[3], None, None, None)])
    give_back()


_ARROW = [
    pa.field(n, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "double": pa.float64()}[k])
    for n, k in (f.split() for f in _KIND.split(", "))
]


def _ends(batches):
    """Last rows of ranges joined with the first rows of the next ranges."""
    for batch in batches:
        rows = batch.to_pylist()
        facts = [_compared(r["text"] or "", r["print"], r["next_text"] or "", r["next_print"]) for r in rows]
        new = packed_texts([f[0] for f in facts])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["doc_id"] for r in rows], pa.int64()),
                pa.array([r["n_chars"] for r in rows], pa.int64()),
                pa.array([f[1] for f in facts], pa.string()),
                pa.array([r["print"] for r in rows], pa.binary()),
                pa.array(new, pa.binary()),
                pa.array([likeness(r["print"], e) for r, e in zip(rows, new)], pa.float64()),
                pa.array([f[2] for f in facts], pa.float64()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"],
        )
    give_back()


def _hex(c: str) -> Column:
    return F.lower(F.hex(c))


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next) a row."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text"), F.col("text").asc_nulls_first()]
    dealt = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order)
    seen = stored(dealt.mapInArrow(_streamed, _KIND), "fingerprints")
    kept = ["doc_id", "n_chars", "edited_sha256", "print", "edited_print", "near_edited", "near_next"]

    # one (part, following part) row a range that has rows; the last one wraps round
    heads = seen.where("first").select("part")
    ring = Window.orderBy("part")
    following = heads.withColumn("after", F.lead("part").over(ring)).withColumn("after", F.coalesce("after", F.min("part").over(Window.partitionBy())))
    starts = seen.where("first").select(F.col("part").alias("after"), F.col("text").alias("next_text"), F.col("print").alias("next_print"))
    last = seen.where("last").select("part", "doc_id", "n_chars", "text", "print").join(following, "part").join(starts, "after")
    ends = last.select("doc_id", "n_chars", "text", "print", "next_text", "next_print").mapInArrow(
        _ends, "doc_id long, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"
    )
    whole = seen.where("not last").select(*kept).unionByName(ends)
    return whole.select(
        "doc_id", "n_chars", "edited_sha256", _hex("print").alias("fingerprint"), _hex("edited_print").alias("edited_fingerprint"), "near_edited", "near_next"
    )

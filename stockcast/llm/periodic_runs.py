"""Periodic runs of words: seeds on diagonals, extended once.

A run is a stretch of consecutive words with smallest period q and at least
``max(LEAST, EXPONENT * q)`` words, which no neighbouring word extends keeping the
period. Word i of a run equals word i + q, so a run is a long match on the
diagonal of lag q: at least 3q words long, and 5 at lag 1.

* **Index.** Lags are taken in classes [2^j, 2^(j+1)). The k-grams of a class have
  the overlap its shortest run guarantees: k = 3 * 2^j (5 for lag 1). As k is at least
  any lag of the class, a k-gram of a run occurs next exactly one smallest period
  on, so pairs of *consecutive* occurrences in a text find every run:
  fewer than one pair a word and class, however often a k-gram repeats. k-grams
  are named by doubling (a window's name mixes those of its halves).
* **Extend.** A pair on the diagonal of its lag is extended left and right over
  the words themselves. A table holds, per lag, the furthest word covered, so
  that the other pairs of the same run are skipped. The lag so found is the run's
  smallest period: a smaller one would have brought the k-gram back earlier.

Texts are scanned whole, a bounded number of bytes at a time (a longer text alone).
Words are compared by 64-bit hashes, told apart by text.

Edge cases: null or empty text, or no words: no runs, empty collapsed text. Rows
are scanned each for itself (repeats, equal ids, null ids). An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import SCAN_BYTES, Words, give_back, mixed, slices, texts_of

LEAST, EXPONENT = 6, 4  # words and periods in the shortest run

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)


def _paired(names: np.ndarray, shift: int, other: np.ndarray | None = None) -> np.ndarray:
    """Names of windows made of a window and the one ``shift`` words on."""
    other = names if other is None else other
    n = max(0, min(len(names), len(other) - shift))
    return mixed(names[:n] * _STEP + other[shift : shift + n])


def _reach(a: np.ndarray, b: np.ndarray) -> int:
    """Number of equal leading entries."""
    n, at, width = min(len(a), len(b)), 0, 16
    while at < n:
        differs = a[at : at + width] != b[at : at + width]
        if differs.any():
            return min(n, at + int(differs.argmax()))
        at, width = at + width, width * 4
    return n


def find_runs(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of every run, by text, start and period.

    ``words`` are the hashes of the words of several texts, ``first`` the index of
    each text's first word, one more entry than texts.
    """
    size = np.diff(first)
    text = np.repeat(np.arange(len(size)), size)
    end = first[1:][text]
    names = mixed(words ^ mixed(text + 1))  # windows of 2^j words
    found, j, longest = [], 0, int(size.max(initial=0))
    while max(LEAST, EXPONENT << j) <= longest:
        low = 1 << j
        twice = _paired(names, low)
        if j == 0:
            k, grams = LEAST - 1, _paired(_paired(twice, 2), 4, names)
        else:
            k, grams = 3 * low, _paired(twice, 2 * low, names)
        whole = np.arange(k, k + len(grams)) <= end[: len(grams)]  # windows inside one text
        at = np.flatnonzero(whole & (size[text[: len(grams)]] >= max(LEAST, EXPONENT * low)))
        at = at[np.argsort(grams[at], kind="stable")]
        lag = np.diff(at)
        near = np.flatnonzero((lag >= low) & (lag < 2 * low))
        near = near[grams[at[near]] == grams[at[near + 1]]]
        found += _extended(words, text, first, at[near], lag[near])
        names, j = twice, j + 1
    return sorted(found)


def _extended(words, text, first, seeds: np.ndarray, lags: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    order = np.lexsort((seeds, lags))
    seeds, lags = seeds[order], lags[order]
    furthest: dict[int, int] = {}  # per lag: the word up to which its diagonal is settled
    k = 0
    while k < len(seeds):
        i, q = int(seeds[k]), int(lags[k])
        if i < furthest.get(q, 0):  # jump to the first pair of this lag beyond
            stop = int(np.searchsorted(lags, q, "right"))
            k += int(np.searchsorted(seeds[k:stop], furthest[q]))
            continue
        t = int(text[i])
        a, b = int(first[t]), int(first[t + 1])
        right = i + _reach(words[i : b - q], words[i + q : b])
        left = i - _reach(words[a:i][::-1], words[a + q : i + q][::-1])
        furthest[q] = max(right, i + 1)
        if right - left + q >= max(LEAST, EXPONENT * q):
            yield t, left - a, right - left + q, q
        k += 1


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay when each run is cut to its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The registered query's damage: a tenth of the texts, by the checksum h of the
    id, go periodic from word a on, with a and the period drawn from h."""
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) a row: ``runs`` an array of (start, length,
    period) by start and period, ``collapsed`` the text without the repetitions,
    its words joined by one space. ``damage`` changes a text's words beforehand."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = texts_of(batch.column(1))
            size, runs, short = [], [], []
            for a, b in slices(offsets, SCAN_BYTES):
                texts = [data[offsets[k] : offsets[k + 1]].tobytes().split() for k in range(a, b)]
                if damage:
                    texts = [damage(i, words) for i, words in zip(ids[a:b], texts)]
                whole = [b" ".join(words) for words in texts]
                cut = np.cumsum([0, *map(len, whole)])
                scan = Words(np.frombuffer(b"".join(whole), np.uint8), cut)
                of = [[] for _ in texts]
                for t, *one in find_runs(scan.hashes(lower=False), scan.first):
                    of[t].append(tuple(one))
                size += map(len, texts)
                runs += [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in of]
                short += [b" ".join(collapsed(words, rs)) if rs else w for words, rs, w in zip(texts, of, whole)]
            kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(runs, kind), pa.array(short, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "runs", "collapsed"],
            )
        give_back()

    kind = "doc_id long, n_words long, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kind)


def run_digests(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256,
    collapsed_sha256) from ``periodic_runs``; the longest run, ties by start, period."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]))
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

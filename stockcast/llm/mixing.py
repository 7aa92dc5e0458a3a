"""Mixing sources to target weights: balanced sampling by the cube method.

A document's size is its number of words. Sources weigh 5, 2, 1, repeating in
code point order (null last) and share 150 % of all sizes; a target stops at
twice its source's size and the excess is shared again by weight. A document
is taken floor(f) whole times plus once more with the fractional part of
f = target / source size as its inclusion probability.

The cube method decides the fractional part: within a block of documents the
probabilities move along directions of the null space of the balancing
constraints (document total and word total), until at most two documents a
block are still fractional. The leftovers of many blocks form the next round's
blocks, until one block a source is left; its at most two documents are the
landing problem, rounded to the nearest word total. Totals so stay exact up to
the last two documents of a source. Blocks are dealt by a hash of the id, so a
source of any size is spread; all choices depend on ids alone, so reruns agree.

Edge cases: null text or no words: size 0, taken 0 (its number of copies is
balanced like any other). A source of size 0 has target 0. Null sources are one
source, null ids hash as such, repeated rows are units of their own; an empty
table gives an empty result. Extra columns are ignored by ``mix`` and kept by
``mixed_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.common import WORD, stored

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, MOST = 1.5, 2.0
BLOCK, FAN = 2048, 512  # documents a block; blocks whose leftovers meet
EPS = 1e-9


def sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"))


def targets(sized: DataFrame) -> DataFrame:
    """(source, source_size, n_docs, rank, target); one row a source."""
    source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # one row a source, not a document
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    source = stored(source.withColumn("rank", rank).withColumn("weight", weight), "mix-sources")
    total = source.agg(F.sum("source_size")).first()[0] or 0
    level = None  # words a unit of weight; sources that reach their cap leave the sharing
    open_ = F.lit(True)
    while True:
        capped, weight_sum = source.agg(F.sum(F.when(~open_, MOST * F.col("source_size"))), F.sum(F.when(open_, F.col("weight")))).first()
        if not weight_sum:
            break
        new = (SHARE * total - (capped or 0.0)) / weight_sum
        if level is not None and new <= level:
            break
        level = new
        open_ = level * F.col("weight") < MOST * F.col("source_size")
    want = F.least(F.lit(float(level or 0.0)) * F.col("weight"), MOST * F.col("source_size"))
    return source.select("source", "source_size", "n_docs", "rank", want.alias("target"))


def flight(prob: np.ndarray, size: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Moves probabilities, keeping their sum and the sum of prob * size, until
    at most two are fractional. ``turn`` in [0, 1) picks the direction."""
    prob = prob.copy()
    scale = float(size.max()) or 1.0
    held: list[int] = []
    for k in range(len(prob)):
        if EPS < prob[k] < 1 - EPS:
            held.append(k)
        while len(held) == 3:
            a, b, c = (size[i] / scale for i in held)
            way = (c - b, a - c, b - a)  # null vector of the rows (1, 1, 1) and (a, b, c)
            if not any(way):
                way = (1.0, -1.0, 0.0)
            up = min((1 - prob[i]) / w if w > 0 else prob[i] / -w for i, w in zip(held, way) if w)
            down = min(prob[i] / w if w > 0 else (1 - prob[i]) / -w for i, w in zip(held, way) if w)
            step = up if turn[held[-1]] * (up + down) < down else -down
            for i, w in zip(held, way):
                prob[i] += step * w
            near = min(held, key=lambda i: min(prob[i], 1 - prob[i]))
            prob[near] = round(prob[near])  # the one that reached its bound, free of rounding
            held = [i for i in held if EPS < prob[i] < 1 - EPS]
    return np.where(prob < EPS, 0.0, np.where(prob > 1 - EPS, 1.0, prob))


def landing(start: np.ndarray, prob: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Rounds the last fractions to the nearest word total, then document total,
    and makes the one exchange (a taken for an untaken document of the block)
    that brings the word total nearest to its expectation. ``start``: the
    probabilities the block came with."""
    at = np.flatnonzero((prob > 0) & (prob < 1))
    best = None
    for bits in range(1 << len(at)):
        take = np.array([bits >> k & 1 for k in range(len(at))], float)
        miss = (abs(float(((take - prob[at]) * size[at]).sum())), abs(float((take - prob[at]).sum())), bits)
        if best is None or miss < best[0]:
            best = (miss, take)
    prob = prob.copy()
    prob[at] = best[1]
    over = float(((prob - start) * size).sum())
    free = (start > EPS) & (start < 1 - EPS)
    taken, spare = np.flatnonzero(free & (prob == 1)), np.flatnonzero(free & (prob == 0))
    if len(taken) and len(spare):
        spare = spare[np.argsort(size[spare], kind="stable")]
        want = size[taken] - over
        near = np.searchsorted(size[spare], want).clip(0, len(spare) - 1)
        for other in (near, (near - 1).clip(0)):
            left = np.abs(over - size[taken] + size[spare[other]])
            k = int(np.argmin(left))
            if left[k] < abs(over) - 0.5:
                i, j = taken[k], spare[other[k]]
                prob[i], prob[j] = 0.0, 1.0
                break
    return prob


UNIT = "doc_id {id}, source string, size long, source_size long, target double, rank long, n_docs long, whole long, prob double, ticket long, block long"


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every row."""
    sized = stored(sizes(docs, id_col, source_col, text_col).withColumn("source", F.col("source").cast("string")), "mix-sizes")
    goal = stored(targets(sized), "mix-targets")
    share = F.when(F.col("source_size") > 0, F.least(F.lit(MOST), F.col("target") / F.col("source_size"))).otherwise(0.0)
    unit = (
        sized.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("whole", F.floor(share))
        .withColumn("prob", share - F.col("whole"))
        .withColumn("ticket", F.xxhash64("doc_id", "size", F.lit("mix")))
        .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("block")), F.ceil(F.col("n_docs") / BLOCK)))
        .withColumn("rank", F.col("rank").cast("long"))
    )
    kind = UNIT.format(id=sized.schema["doc_id"].dataType.simpleString())
    unit = unit.select(*(c.split()[0] for c in kind.split(", ")))

    def moved(last: bool):
        def run(group: pa.Table) -> pa.Table:
            # large documents first, so that what is left for the landing is small
            group = group.sort_by([("size", "descending"), ("ticket", "ascending"), ("doc_id", "ascending")])
            size = group["size"].to_numpy().astype(float)
            turn = (group["ticket"].to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
            start = group["prob"].to_numpy()
            prob = flight(start, size, turn)
            prob = landing(start, prob, size) if last else prob
            return group.set_column(group.schema.get_field_index("prob"), "prob", pa.array(prob))

        return run

    blocks = goal.agg(F.max(F.ceil(F.col("n_docs") / BLOCK))).first()[0] or 1
    done = []
    while True:
        unit = stored(unit.groupBy("rank", "block").applyInArrow(moved(blocks <= 1), kind), "mix-flight")
        if blocks <= 1:
            done.append(unit)
            break
        done.append(unit.where("prob = 0 or prob = 1"))
        unit = unit.where("prob > 0 and prob < 1").withColumn("block", F.floor(F.col("block") / FAN))
        blocks = -(-blocks // FAN)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    copies = (F.col("whole") + F.col("prob").cast("long")).alias("copies")
    return whole.select("doc_id", "source", "size", "source_size", "target", copies, (F.col("size") * copies).alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, all its columns."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    keyed = docs.withColumn("_id", F.col(id_col)).withColumn("_source", F.col(source_col).cast("string")).withColumn("_size", size)
    like = Window.partitionBy("_id", "_source", "_size").orderBy(F.lit(0))
    keyed = keyed.withColumn("_nth", F.row_number().over(like))
    take = mix(docs, id_col, source_col, text_col).select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "copies")
    like = Window.partitionBy("_id", "_source", "_size").orderBy(F.desc("copies"))
    take = take.withColumn("_nth", F.row_number().over(like)).where("copies > 0").withColumnRenamed("copies", "_copies")
    same = [keyed[c].eqNullSafe(take[c]) for c in ("_id", "_source", "_size", "_nth")]
    rows = keyed.join(take, same)
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select(*(docs[c] for c in docs.columns))

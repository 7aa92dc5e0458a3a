"""Ordered scans per key, one exchange of the rows, no key bound to one task.

``weighed`` parts the rows of a frame by the weight of their key:

* keys that hold no more than their share of a task (nearly all) stay whole. One
  hash exchange on the key serves every window and grouping that follows;
* heavy keys are cut along their order into *chunks* of about that share. The cuts
  are rows of a hashed sample of the heavy keys, compared over the whole order, so
  that a bulk load of one instant is cut, too. The exchange is on (key, chunk).

Both parts run the same code. A scan is a monoid: ``inside`` values run over the
rows of a chunk in place, one summary row a chunk is scanned along the key's
chunks, and what enters a chunk is applied to its rows. For whole keys there is
nothing to enter, so the last two steps are not in their plan.

Bounds: at most one key in ``rows / chunk_rows`` is heavy and there are at most twice
as many chunks, whatever the data; only tables of that size are
broadcast. Finding the heavy keys counts the rows of each key (narrow, combined map-side).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from stockcast.session import materialize, plain_unions

#: A key with fewer rows is never worth cutting.
LEAST_CHUNK = 1 << 16
#: Rows of a task after the exchange, whatever the number of rows: more rows make more
#: tasks. Up to the number of partitions, tasks may hold fewer, but ``FEW_ROWS`` at least.
TASK_ROWS, FEW_ROWS = 1 << 17, 1 << 13
#: Sampled rows of a heavy key a chunk.
SAMPLED = 64


@dataclass(frozen=True)
class Weighed:
    """Rows whose keys are whole (``cut`` False) or cut into chunks. Both have the
    column ``chunk``, which is 0 for whole keys."""

    rows: DataFrame
    keys: tuple[str, ...]
    cut: bool

    def by(self, *more) -> list:
        """What windows and groupings inside a chunk are partitioned by."""
        return [*self.keys, *(["chunk"] if self.cut else []), *more]

    def window(self, *more) -> WindowSpec:
        return Window.partitionBy(*self.by(*more))

    def with_rows(self, rows: DataFrame) -> Weighed:
        return replace(self, rows=rows)

    def entered(
        self,
        segment: list[str],
        summary: dict[str, Column],
        carry: Callable[[WindowSpec], dict[str, Column]],
        defaults: dict[str, Column],
        where: Column | None = None,
        first: Callable[[DataFrame, WindowSpec], DataFrame] | None = None,
    ) -> Weighed:
        """Adds to each row what enters its chunk.

        ``segment`` columns (the key, or finer) are scanned along. ``summary`` makes one row
        a (segment, chunk) of the rows ``where``; ``first`` may add columns to it, given
        the segment's chunks in order; ``carry`` gives, by the window of a segment's
        chunks, the columns that enter. ``defaults`` holds for segments in one chunk.
        """
        if not self.cut:
            return self.with_rows(self.rows.withColumns(defaults))
        local = materialize(self.rows)  # summarised and read again
        known = local if where is None else local.where(where)
        line = Window.partitionBy(*segment).orderBy("chunk")
        table = known.groupBy(*segment, "chunk").agg(*[c.alias(n) for n, c in summary.items()])
        # a chunk's edge is crossed by at most one segment that is finer than the key
        table = table.withColumn("_chunks", F.count(F.lit(1)).over(Window.partitionBy(*segment))).where("_chunks > 1")
        if first is not None:
            table = first(table, line)
        table = table.withColumns(carry(line)).select(*segment, "chunk", *defaults)
        kept = [c for c in local.columns if c not in defaults]
        entering = [F.coalesce(F.col(f"_in.{n}"), d).alias(n) for n, d in defaults.items()]
        same = F.lit(True)
        for c in (*segment, "chunk"):
            same = same & F.col(f"_row.{c}").eqNullSafe(F.col(f"_in.{c}"))
        rows = local.alias("_row").join(table.alias("_in"), same, "left").select(*[F.col(f"_row.{c}") for c in kept], *entering)
        return self.with_rows(rows)


def before(line: WindowSpec) -> WindowSpec:
    """The chunks before a chunk, along its segment."""
    return line.rowsBetween(Window.unboundedPreceding, -1)


def after(line: WindowSpec) -> WindowSpec:
    """The chunks after a chunk, along its segment."""
    return line.rowsBetween(1, Window.unboundedFollowing)


def weighed(df: DataFrame, keys: list[str], order: list[str], parts: int | None = None, chunk_rows: int | None = None) -> list[Weighed]:
    """``df`` in one or two parts of disjoint keys: whole ones and, if there are any, cut
    ones. The cuts follow ``order``, nulls first.

    A key is heavy with more than ``chunk_rows`` rows; by default a task's share of
    all rows (of ``parts`` tasks; unless given the shuffle partitions, or more, of
    ``TASK_ROWS`` rows), but no fewer than ``LEAST_CHUNK`` unless ``parts`` is given.
    The exchange has a fixed number of tasks: coalesced by their compressed
    size, as Spark would, their rows and so their memory grow with the table.
    """
    plain_unions(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total, most = counts.agg(F.sum("_n"), F.max("_n")).first()
    total = total or 0
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # what one task may hold is left to Spark to deal
    tasks = max(-(-total // TASK_ROWS), min(usual, total // FEW_ROWS)) if total > TASK_ROWS else 0
    if chunk_rows is None:
        least = 1 if parts else LEAST_CHUNK
        parts = parts or max(usual, tasks)
        chunk_rows = max(least, -(-total // parts))
    if not total or most <= chunk_rows:
        return [_dealt(df.withColumn("chunk", F.lit(0)), keys, False, tasks)]
    cuts = materialize(_cuts(df, keys, order, counts.where(F.col("_n") > chunk_rows), chunk_rows))
    held = df.join(F.broadcast(cuts), keys, "left").withColumn("chunk", _chunk(F.struct(*order)))
    whole, heavy = held.where(F.col("_cuts").isNull()), held.where(F.col("_cuts").isNotNull())
    drop = ("_cuts", "_coarse", "_step")
    return [
        _dealt(whole.drop(*drop).withColumn("chunk", F.lit(0)), keys, False, tasks),
        _dealt(heavy.drop(*drop), keys, True, tasks),
    ]


def _dealt(rows: DataFrame, keys: list[str], cut: bool, tasks: int) -> Weighed:
    """The one exchange, by the coarsest of the groupings that follow."""
    part = Weighed(rows, tuple(keys), cut)
    return part.with_rows(rows.repartition(*([tasks] if tasks else []), *part.by()))


def _cuts(df: DataFrame, keys: list[str], order: list[str], heavy: DataFrame, chunk_rows: int) -> DataFrame:
    """One row a heavy key: its cuts in order, every ``_step``-th of them apart."""
    every = max(1, chunk_rows // SAMPLED)
    picked = F.pmod(F.xxhash64(*keys, *order), F.lit(every)) == 0
    sample = df.join(F.broadcast(heavy), keys).where(picked).select(*keys, "_n", F.struct(*order).alias("_at"))
    pieces = F.ceil(F.col("_n") / F.lit(chunk_rows))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_at")) - 1
    piece = F.floor(rank * pieces / F.count(F.lit(1)).over(Window.partitionBy(*keys))).cast("int")
    first = sample.withColumn("_piece", piece).groupBy(*keys, "_piece").agg(F.min("_at").alias("_at"))
    found = first.groupBy(*keys).agg(F.sort_array(F.collect_set(F.when(F.col("_piece") > 0, F.col("_at")))).alias("_cuts"))
    # a heavy key of which nothing was sampled stays one chunk
    found = heavy.select(*keys).join(found, keys, "left").withColumn("_cuts", F.coalesce("_cuts", F.array().cast(found.schema["_cuts"].dataType)))
    found = found.withColumn("_step", F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("_cuts")))).cast("int"))
    return found.withColumn("_coarse", F.filter("_cuts", lambda _, i: i % F.col("_step") == 0))


def _chunk(at: Column) -> Column:
    """Number of cuts at or before a row, looked up in two steps."""
    reached = lambda cuts: F.size(F.filter(cuts, lambda c: c <= at))
    block = reached(F.col("_coarse"))
    base = (block - 1) * F.col("_step")
    return F.when(block <= 0, 0).otherwise(base + reached(F.slice("_cuts", base + 1, F.col("_step"))))


def spread_join(rows: DataFrame, table: DataFrame, keys: list[str], by: list[str], pieces: int = 64) -> DataFrame:
    """Left join of ``rows`` with a table of unique ``keys``, where one key may hold any
    share of the rows: the table's row goes to each (key, piece of its rows) first, so
    that the rows of a key are dealt over ``pieces`` join keys. ``by`` deals them."""
    dealt = rows.withColumn("_piece", F.pmod(F.xxhash64(*by), F.lit(pieces)))
    wanted = dealt.select(*keys, "_piece").distinct()
    return dealt.join(wanted.join(table, keys), [*keys, "_piece"], "left").drop("_piece")


def joined(parts: list[DataFrame]) -> DataFrame:
    """The results of the parts, which hold disjoint keys, as one frame."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""The order table as it was: validity intervals and lookups at any instant.

Every distinct info of a life span is valid from its first line to the line that
empties the key: an interval of the key's arrival ranks (and of arrival times). The
intervals are a *temporal table*; the order table at any moment is the set of intervals
that hold then, and the table after the last line the open ones.

A lookup needs no pairing of a key's lines: a scan over the timeline gives each
probe the life span and position it meets, and within a span all infos first seen up
to that position hold. Infos and probes meet on (key, span, block of positions), so
that a long span of a heavy key is many join keys, and the rows read are the
rows returned plus at most a block a probe.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.operators.orders import LINE_ORDER, complete_line, firsts_of, folded, spans_of
from stockcast.operators.scan import Weighed, after, before, joined, weighed
from stockcast.schemas import INFO_FIELDS, KEYS
from stockcast.session import materialize

#: Ranks of a key in one block of a lookup join.
BLOCK = 1 << 12

LINE, PROBE = 0, 1  # a probe comes after the lines of its instant


def ended_of(part: Weighed, at: str) -> Weighed:
    """Add ``ends``: (rn, arrival) of the key's next line that leaves it empty, null while
    it is not emptied."""
    empties = F.when(~F.col("occupied"), F.struct("rn", F.col(at).alias("at")))
    backwards = part.window().orderBy(F.desc("rn")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = part.with_rows(part.rows.withColumn("own_ends", F.min(empties).over(backwards)))
    part = part.entered(
        list(part.keys),
        {"_first": F.min(empties)},
        lambda chunks: {"later": F.min("_first").over(after(chunks))},
        {"later": F.lit(None).cast(part.rows.schema["own_ends"].dataType)},
    )
    return part.with_rows(part.rows.withColumn("ends", F.coalesce("own_ends", "later")).drop("own_ends", "later"))


def order_table_history(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """One row per distinct info of a life span: store, product, the info's fields, and
    its validity: from line ``from_rn`` at ``from_at`` up to, but without, line ``to_rn`` at
    ``to_at`` (null while it holds)."""
    order = order or LINE_ORDER
    found = []
    for part in folded(lines, order, parts):
        rows = ended_of(firsts_of(part), order[0]).rows.where(F.col("occupied") & F.col("first_in_span"))
        found.append(rows.select(*KEYS, *INFO_FIELDS, F.col("rn").alias("from_rn"), F.col(order[0]).alias("from_at"), F.col("ends.rn").alias("to_rn"), F.col("ends.at").alias("to_at")))
    return joined(found)


def _blocks(a: Column, b: Column) -> Column:
    return F.sequence(F.floor(a / BLOCK).cast("long"), F.floor(b / BLOCK).cast("long"))


def _seen(infos: DataFrame, probes: DataFrame) -> DataFrame:
    """Each probe (key, span, pos, ...) with the infos of its span first seen up to pos."""
    here = infos.select(*KEYS, "span", F.floor(F.col("from_rn") / BLOCK).cast("long").alias("block"), "from_rn", F.struct(*INFO_FIELDS).alias("info"))
    asked = probes.withColumn("block", F.explode(_blocks(F.col("span"), F.col("pos"))))
    return asked.join(here, [*KEYS, "span", "block"]).where(F.col("from_rn") <= F.col("pos")).drop("block")


def order_table_as_of(lines: DataFrame, instants: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """The order table at given instants: for each row of ``instants`` (store, product,
    ``at``) the infos that hold after all lines arrived up to then: the row, the info's
    fields and ``from_rn``, its place. A row whose key is empty then gives nothing; rows
    with a null key or instant neither."""
    order = order or LINE_ORDER
    extra = [c for c in instants.columns if c not in (*KEYS, "at")]
    of_line = list(dict.fromkeys([*order[1:], *INFO_FIELDS]))
    known = lines.where(complete_line(order)).select(*KEYS, F.col(order[0]).alias("t"), F.lit(LINE).alias("src"), *of_line)
    null = lambda c: F.lit(None).cast(lines.schema[c].dataType).alias(c)
    placed = F.col("store").isNotNull() & F.col("product").isNotNull() & F.col("at").isNotNull()
    asked = instants.where(placed).select(*KEYS, F.col("at").alias("t"), F.lit(PROBE).alias("src"), *[null(c) for c in of_line], F.struct(F.lit(1).alias("_"), *extra).alias("probe"))
    both = known.withColumn("probe", F.lit(None).cast(asked.schema["probe"].dataType)).unionByName(asked)
    timeline, lane, found = ["t", "src", *order[1:]], ["src"], []
    for part in weighed(both, KEYS, timeline, parts):
        part = firsts_of(spans_of(part, timeline, F.col("src") == LINE, lane), lane)
        line = F.when(F.col("src") == LINE, F.struct("rn", "occupied", "span"))
        run = part.window().orderBy(*timeline).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        part = part.with_rows(part.rows.withColumn("line", line).withColumn("own", F.max("line").over(run)))
        part = part.entered(
            list(part.keys),
            {"_last": F.max("line")},
            lambda chunks: {"_in": F.max("_last").over(before(chunks))},
            {"_in": F.lit(None).cast(part.rows.schema["line"].dataType)},
        )
        rows = part.rows.withColumn("seen", F.greatest("_in", "own")).select(*KEYS, "t", "src", "rn", "span", "occupied", "first_in_span", *INFO_FIELDS, "seen", "probe")
        rows = materialize(rows.where((F.col("src") == PROBE) | (F.col("occupied") & F.col("first_in_span"))))
        infos = rows.where(F.col("src") == LINE).withColumnRenamed("rn", "from_rn")
        probes = rows.where((F.col("src") == PROBE) & F.col("seen.occupied")).select(*KEYS, F.col("t").alias("at"), "probe", F.col("seen.span").alias("span"), F.col("seen.rn").alias("pos"))
        found.append(_seen(infos, probes).select(*KEYS, "at", *[F.col(f"probe.{c}").alias(c) for c in extra], "info.*", "from_rn"))
    return joined(found)


def merged_infos(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Each line merged with the order table read after the line's own update, as rows:
    store, product, ``rn`` (the line's rank), order_id and line_no of the line, the merged
    info's fields, ``own`` (the line's own info, which comes first in the list) and ``from_rn``
    (the order of the others). A line that empties the key is merged with nothing.

    This is the whole list of every line, so a span of n infos gives up to n²/2 rows, as
    the service's records do; ``operators.replay.merged_with_table`` gives its size
    and sum in linear space."""
    found = []
    line = F.struct("order_id", "line_no", *[F.col(c).alias(f"own_{c}") for c in INFO_FIELDS])
    for part in folded(lines, order, parts):
        rows = firsts_of(part).rows.select(*KEYS, "rn", "span", "occupied", "first_in_span", "line_no", *INFO_FIELDS)
        rows = materialize(rows)  # read as infos and as probes
        infos = rows.where(F.col("occupied") & F.col("first_in_span")).withColumnRenamed("rn", "from_rn")
        probes = rows.where("occupied").select(*KEYS, "span", F.col("rn").alias("pos"), line.alias("line"))
        own = F.lit(True)
        for c in INFO_FIELDS:
            own = own & F.col(f"info.{c}").eqNullSafe(F.col(f"line.own_{c}"))
        kept = _seen(infos, probes).select(*KEYS, F.col("pos").alias("rn"), F.col("line.order_id").alias("line_order_id"), "line.line_no", "info.*", own.alias("own"), "from_rn")
        alone = rows.where(~F.col("occupied")).select(
            *KEYS, "rn", F.col("order_id").alias("line_order_id"), "line_no", *INFO_FIELDS, F.lit(True).alias("own"), F.col("rn").alias("from_rn")
        )
        found += [kept, alone]
    return joined(found)

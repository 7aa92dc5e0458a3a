"""Order side: flatten orders into lines, fold lines per (store, product).

The fold keeps, per key, the distinct order infos seen since the last
retraction. Its rule (applied in arrival order, per key):

* the first line of an empty key is stored as it is, unchecked;
* afterwards, if the stored list or the new line has a quantity <= 0, the
  key is deleted; otherwise the new info is appended (distinct, first kept).

So a lone non-positive line stays until the next line, which then deletes
both. Per key there are three states: empty, positive list, lone
non-positive line. Whether a row leaves the key occupied follows a closed
form over windows, which is what Spark runs here (no per-key collection):

    sync(i)     = q(i) > 0 and q(i-1) > 0          (the key is surely occupied)
    occupied(i) = sync(i) or not occupied(i-1),     occupied(0) = false

that is, after the last sync row s: occupied(i) = (1 + i - s) odd; with no
sync yet: i odd. A *life span* is a maximal run of occupied rows; the state
after row i is the distinct infos of the span's rows up to i.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockcast.operators.scan import Weighed, before, joined, weighed
from stockcast.schemas import INFO_FIELDS, KEYS, PLACE

# arrival order of order lines inside a key: time, then order, line, quantity
LINE_ORDER = ["created_at", "order_id", "line_no", "quantity"]
# arrival order of lines that come from a topic: the record's time and place, then as above
TOPIC_ORDER = ["arrived_at", *PLACE, "order_id", "line_no", "quantity"]


def explode_lines(orders: DataFrame) -> DataFrame:
    """Flatten orders into one row per item, re-keyed by (store, product).

    An order with no items gives no row (``explode``, not ``explode_outer``).
    Items may carry a ``line_no``; otherwise the 1-based position is used.
    An ``arrived_at`` of the order (its record's arrival) and the record's place in its
    topic go along.
    """
    arrival = [c for c in ("arrived_at", *PLACE) if c in orders.columns]
    item_fields = orders.schema["items"].dataType.elementType.fieldNames()
    line_no = F.col("item.line_no") if "line_no" in item_fields else (F.col("pos") + 1).cast("int")
    return orders.select(
        "order_id", "store", "created_at", "deliver_at", "status", *arrival, F.posexplode("items").alias("pos", "item")
    ).select(
        "store",
        F.col("item.product").alias("product"),
        "order_id",
        line_no.alias("line_no"),
        F.col("item.quantity").alias("quantity"),
        "created_at",
        "deliver_at",
        "status",
        *arrival,
    )


def info_struct(prefix: str | None = None) -> Column:
    """The five-field order info (quantity, order_id, created_at, deliver_at, status)."""
    p = f"{prefix}." if prefix else ""
    return F.struct(*[F.col(f"{p}{f}").alias(f) for f in INFO_FIELDS])


def line_info(lines: DataFrame) -> DataFrame:
    """Each line as a single-info order record: store, product, info array of one."""
    return lines.select(*KEYS, F.array(info_struct()).alias("info"))


def nonpositive_orders(orders: DataFrame) -> DataFrame:
    """Orders holding an item with quantity <= 0 (the retraction signal)."""
    return orders.where(F.exists("items", lambda i: i["quantity"] <= 0))


def complete_line(order: list[str]) -> Column:
    """A line the fold can place: key, arrival time and quantity are known."""
    known = [F.col(c).isNotNull() for c in (*KEYS, order[0], "quantity")]
    return known[0] & known[1] & known[2] & known[3]


def rejected_lines(lines: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The lines the fold leaves out, as they are: a null key, arrival time or
    quantity. Together with the folded ones these are all lines."""
    return lines.where(~complete_line(order or LINE_ORDER))


def spans_of(part: Weighed, order: list[str], where: Column | None = None, lane: list[str] | None = None) -> Weighed:
    """Add the fold's per-row state to the order lines of a part.

    Columns added: ``rn`` (1-based arrival rank in the key), ``occupied`` (key
    non-empty after the row) and ``span`` (last unoccupied rn up to the row, 0 if
    none: an occupied row's life span).

    A chunk's rows before its first sync row alternate from the state the chunk is
    entered in, so both outcomes follow from the row's rank; one summary row a
    chunk, scanned along the key's chunks, settles which one holds. Where other
    rows stand between the lines, ``where`` picks the lines and ``lane`` is the
    column that keeps the others out of the windows (their values mean nothing).
    """
    q = F.col("quantity")
    w = part.window(*(lane or [])).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # inside each chunk: local rank, first and last sync row so far, and the last
    # unoccupied row after a sync row
    since = 1 + F.col("rn_c") - F.col("last_sync")
    local = (
        part.rows.withColumn("rn_c", F.row_number().over(w).cast("long"))
        .withColumn("sync", (q > 0) & F.coalesce(F.lag(q).over(w) > 0, F.lit(False)))
        .withColumn("last_sync", F.max(F.when(F.col("sync"), F.col("rn_c"))).over(run))
        .withColumn("first_sync", F.min(F.when(F.col("sync"), F.col("rn_c"))).over(run))
        .withColumn("empty_after", F.max(F.when(since % 2 == 0, F.col("rn_c"))).over(run))
        .drop("sync")
    )

    def last_unoccupied(alternating: Column) -> Column:
        """Of the first ``alternating`` rows after the entry, or after a sync row."""
        before_sync = alternating - (alternating + F.col("entered")) % 2
        return F.when(before_sync > 0, F.greatest("empty_after", before_sync)).otherwise(F.col("empty_after"))

    def settled(table: DataFrame, line) -> DataFrame:
        entered_since = 1 + F.col("off") - F.col("synced")
        return (
            table.withColumn("off", F.coalesce(F.sum("n").over(before(line)), F.lit(0)).cast("long"))
            .withColumn("opens", (F.col("first_q") > 0) & F.coalesce(F.lag("last_q").over(line) > 0, F.lit(False)))
            .withColumn("g", F.greatest(F.col("off") + F.col("last_sync"), F.when(F.col("opens"), F.col("off") + 1)))
            .withColumn("synced", F.max("g").over(before(line)))
            # a chunk opening with a sync row goes on as if entered empty
            .withColumn(
                "entered",
                F.when(F.col("opens"), 0).when(F.col("synced").isNull(), F.col("off") % 2).otherwise(entered_since % 2).cast("long"),
            )
            .withColumn("m", F.col("off") + last_unoccupied(F.coalesce(F.col("first_sync") - 1, F.col("n"))))
        )

    entered = part.with_rows(local).entered(
        list(part.keys),
        {
            "n": F.count(F.lit(1)),
            "first_q": F.min_by(q, F.col("rn_c")),
            "last_q": F.max_by(q, F.col("rn_c")),
            "last_sync": F.max("last_sync"),
            "first_sync": F.min("first_sync"),
            "empty_after": F.max("empty_after"),
        },
        lambda line: {"carry_span": F.max("m").over(before(line))},
        {"off": F.lit(0).cast("long"), "entered": F.lit(0).cast("long"), "carry_span": F.lit(None).cast("long")},
        where,
        settled,
    )
    # every row's state from its chunk's entry
    own_empty = F.col("off") + last_unoccupied(F.coalesce(F.col("first_sync") - 1, F.col("rn_c")))
    return part.with_rows(
        entered.rows.withColumn("rn", F.col("off") + F.col("rn_c"))
        .withColumn("occupied", F.coalesce(since % 2 == 1, (F.col("entered") + F.col("rn_c")) % 2 == 1))
        .withColumn("span", F.coalesce(F.greatest(F.col("carry_span"), own_empty), F.lit(0)).cast("long"))
        .drop("rn_c", "last_sync", "first_sync", "empty_after", "off", "entered", "carry_span")
    )


def last_empty_of(part: Weighed) -> Weighed:
    """Add ``last_empty``: the key's last unoccupied rn, 0 if none."""
    own = F.max("span").over(part.window())
    if part.cut:
        whole = Window.partitionBy(*part.keys)
        part = part.entered(list(part.keys), {"_top": F.max("span")}, lambda line: {"_last": F.max("_top").over(whole)}, {"_last": F.lit(None).cast("long")})
        return part.with_rows(part.rows.withColumn("last_empty", F.coalesce("_last", own)).drop("_last"))
    return part.with_rows(part.rows.withColumn("last_empty", own))


def firsts_of(part: Weighed, lane: list[str] | None = None) -> Weighed:
    """Add ``first_in_span``: the first row of its distinct info inside its span.
    Repeats inside a chunk are settled there; of each info of a cut key only its
    first row per chunk meets the others, which takes an exchange of those."""
    # an unoccupied row has its own rn as span; keep it apart from the span it closes
    info = ["span", "occupied", *INFO_FIELDS, *(lane or [])]
    in_chunk = F.row_number().over(part.window(*info).orderBy("rn")) == 1
    if not part.cut:
        return part.with_rows(part.rows.withColumn("first_in_span", in_chunk))
    overall = F.row_number().over(Window.partitionBy(*part.keys, *info, "repeat").orderBy("rn")) == 1
    return part.with_rows(
        part.rows.withColumn("first_c", in_chunk)
        .withColumn("repeat", F.when(~F.col("first_c"), F.col("rn")))
        .withColumn("first_in_span", F.col("first_c") & overall)
        .drop("first_c", "repeat")
    )


def folded(lines: DataFrame, order: list[str] | None = None, parts: int | None = None, keys: list[str] = KEYS) -> list[Weighed]:
    """The lines the fold can place, by the weight of their key, with their spans."""
    order = order or LINE_ORDER
    return [spans_of(p, order) for p in weighed(lines.where(complete_line(order)), keys, order, parts)]


def annotate_spans(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Add the fold's per-row state to order lines (all but ``rejected_lines``):
    ``spans_of`` plus ``last_empty`` and ``chunk``, the piece of a heavy key's arrival
    order (0 for others). ``parts`` tasks share the rows; the shuffle partitions if
    not given."""
    return joined([last_empty_of(p).rows for p in folded(lines, order, parts)])


def annotate_fold(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """``annotate_spans`` plus ``first_in_span`` (see ``firsts_of``)."""
    return joined([firsts_of(last_empty_of(p)).rows for p in folded(lines, order, parts)])


def order_table_rows(
    lines: DataFrame, order: list[str] | None = None, with_rank: bool = False, parts: int | None = None
) -> DataFrame:
    """The live infos of the order table after all lines: one row per distinct
    info, flat (store, product, quantity, order_id, created_at, deliver_at,
    status), plus ``rn`` (arrival rank of its first occurrence) if asked.

    Rows after the key's last unoccupied row form its current life span; the
    distinct infos there are the live set."""
    found = []
    for part in folded(lines, order, parts):
        live = last_empty_of(part).rows.where(F.col("rn") > F.col("last_empty"))
        found.append(live.groupBy(*KEYS, *INFO_FIELDS).agg(F.min("rn").alias("rn")))
    return joined(found) if with_rank else joined(found).drop("rn")


def live_totals(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """``annotate_fold`` plus ``info_count`` and ``live_quantity``: number and
    summed quantity of the span's distinct infos up to the row. The running
    values are taken per chunk; a chunk adds the totals of the span's
    earlier chunks, so a long span is never one task."""
    fresh = F.col("first_in_span") & F.col("occupied")
    one, amount = F.when(fresh, 1).otherwise(0), F.when(fresh, F.col("quantity")).otherwise(0.0)
    out = []
    for part in folded(lines, order, parts):
        part = firsts_of(last_empty_of(part))
        run = part.window("span").orderBy("rn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        part = part.with_rows(part.rows.withColumn("n_c", F.sum(one).over(run)).withColumn("q_c", F.sum(amount).over(run)))
        part = part.entered(
            [*KEYS, "span"],
            {"n": F.sum(one), "q": F.sum(amount)},
            lambda line: {"n_in": F.sum("n").over(before(line)), "q_in": F.sum("q").over(before(line))},
            {"n_in": F.lit(0).cast("long"), "q_in": F.lit(0.0)},
        )
        out.append(
            part.rows.withColumn("info_count", F.col("n_in") + F.col("n_c"))
            .withColumn("live_quantity", F.col("q_in") + F.col("q_c"))
            .drop("n_in", "n_c", "q_in", "q_c")
        )
    return joined(out)


def order_table_changelog(lines: DataFrame, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """The table's changelog: one row per line, the key's state after it.

    ``deleted`` marks a tombstone (key emptied); ``info_count`` and
    ``live_quantity`` describe the distinct live infos after the row. Both
    are running values over the row's life span, so no state is gathered.
    """
    return live_totals(lines, order, parts).select(
        *KEYS,
        "rn",
        "order_id",
        "line_no",
        (~F.col("occupied")).alias("deleted"),
        F.when(F.col("occupied"), F.col("info_count")).otherwise(0).alias("info_count"),
        F.when(F.col("occupied"), F.col("live_quantity")).otherwise(0.0).alias("live_quantity"),
    )


def merged_tables(lines: DataFrame, side: Column, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """``merge_order_rows`` of the two order tables that one set of lines makes, by its
    ``side`` (0: the first, 1: the second): one fold over (side, key)."""
    keys, found = [*KEYS, "side"], []
    for part in folded(lines.withColumn("side", side.cast("int")), order, parts, keys):
        live = last_empty_of(part).rows.where(F.col("rn") > F.col("last_empty"))
        found.append(live.groupBy(*keys, *INFO_FIELDS).agg(F.min("rn").alias("rn")))
    first = F.min("side").over(Window.partitionBy(*KEYS)) == 0  # the merge is driven by the first
    both = joined(found).withColumn("first", first).where("first")
    place = F.min(F.struct("side", "rn")).alias("place")
    return both.groupBy(*KEYS, *INFO_FIELDS).agg(place).select(*KEYS, *INFO_FIELDS, "place.side", "place.rn")


def merge_order_rows(first: DataFrame, second: DataFrame) -> DataFrame:
    """Flat form of merging two order records per key: the first's infos, then
    the second's, repeats dropped. Only keys of the first take part (a missing
    second leaves the first as it is). Both come with ``rn``; an info's place in
    the merged list is (``side``, ``rn``) of its first occurrence."""
    first_keys = first.select(*KEYS).distinct()
    both = first.withColumn("side", F.lit(0)).unionByName(second.join(first_keys, KEYS, "left_semi").withColumn("side", F.lit(1)))
    place = F.min(F.struct("side", "rn")).alias("place")
    return both.groupBy(*KEYS, *INFO_FIELDS).agg(place).select(*KEYS, *INFO_FIELDS, "place.side", "place.rn")

"""Order fold with retractions: Spark's window closed form against an
event-by-event model, on many random sign sequences at once."""

import random
from datetime import timedelta

from conftest import utc
from helpers import lines_df
from stockcast.operators import orders as O

BASE = utc(2021, 1, 1)


def model(seq):
    """Fold of the reference, one line at a time; returns live infos and per-row state."""
    state, after = None, []
    for info in seq:
        if state is None:
            state = [info]
        elif info[0] <= 0 or any(i[0] <= 0 for i in state):
            state = None
        elif info not in state:
            state.append(info)
        after.append(list(state or []))
    return state or [], after


def _random_lines(n_keys=300, seed=7):
    rng = random.Random(seed)
    rows = []
    for k in range(n_keys):
        for i in range(rng.randint(1, 14)):
            oid = f"o{rng.randint(0, 2)}"
            rows.append(
                (
                    "s",
                    f"p{k}",
                    oid,
                    i + 1,
                    float(rng.choice([-1, 0, 1, 2, 3, 3])),
                    BASE + timedelta(hours=rng.randint(0, 5)),
                    BASE + timedelta(days=int(oid[1:]) + 1),
                    "CAPTURED",
                )
            )
    return rows


def _arrival(r):
    return (r[5], r[2], r[3], r[4])


def _info(r):
    return (r[4], r[2], r[5], r[6], r[7])


import pytest


@pytest.mark.parametrize("parts", [1, 8, 200])
def test_fold_matches_model(spark, parts):
    rows = _random_lines()
    by_key = {}
    for r in sorted(rows, key=_arrival):
        by_key.setdefault(r[1], []).append(r)
    df = lines_df(spark, rows)

    live = {}
    for r in O.order_table_rows(df, parts=parts).collect():
        live.setdefault(r["product"], set()).add(
            (r["quantity"], r["order_id"], r["created_at"], r["deliver_at"], r["status"])
        )
    log = {}
    for r in O.order_table_changelog(df, parts=parts).collect():
        log[(r["product"], r["rn"])] = (r["deleted"], r["info_count"], r["live_quantity"])

    for key, seq in by_key.items():
        final, after = model([_info(r) for r in seq])
        got = {(q, o, c.replace(tzinfo=None), d.replace(tzinfo=None), s) for q, o, c, d, s in live.get(key, set())}
        want = {(q, o, c.replace(tzinfo=None), d.replace(tzinfo=None), s) for q, o, c, d, s in final}
        assert got == want, key
        for rn, state in enumerate(after, start=1):
            assert log[(key, rn)] == (not state, len(state), float(sum(i[0] for i in state))), (key, rn)


def test_lone_nonpositive_line_stays_until_next(spark):
    df = lines_df(
        spark,
        [("s", "p", "a", 1, 0.0, BASE, BASE, "CAPTURED")],
    )
    assert O.order_table_rows(df).count() == 1
    df2 = lines_df(
        spark,
        [
            ("s", "p", "a", 1, 0.0, BASE, BASE, "CAPTURED"),
            ("s", "p", "b", 1, 5.0, BASE + timedelta(hours=1), BASE, "CAPTURED"),
        ],
    )
    assert O.order_table_rows(df2).count() == 0


def test_replay_is_independent_of_chunking(spark):
    """Cutting scans into many small slices (200 ranges, 3-rank position
    slices) gives the same replay as no cutting at all."""
    from conftest import SF_SMALL
    from stockcast.operators import replay as R
    from stockcast.sources import tables

    lines, stock = tables.lines(spark, SF_SMALL), tables.stock(spark, SF_SMALL)
    whole = R.replay_projections(lines, stock, 7, parts=1, pos_chunk=None)
    cut = R.replay_projections(lines, stock, 7, parts=200, pos_chunk=3)
    assert whole.count() == cut.count()
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_one_second_of_a_hot_key_is_cut(spark):
    rows = [("s", "hot", f"o{i:03d}", 1, float(i % 5), BASE, BASE, "CAPTURED") for i in range(400)]
    spread = O.annotate_spans(lines_df(spark, rows), parts=16).groupBy("chunk").count().collect()
    assert len(spread) > 8 and max(r["count"] for r in spread) < 100


def test_folded_and_rejected_lines_are_all_lines(spark):
    good = ("s", "p", "a", 1, 2.0, BASE, BASE, "CAPTURED")
    bad = [("s", None, *good[2:]), (None, *good[1:]), (*good[:4], None, *good[5:]), (*good[:5], None, *good[6:])]
    lines = lines_df(spark, [good, *bad])
    assert O.order_table_changelog(lines, parts=4).count() == 1
    assert O.rejected_lines(lines).count() == len(bad)


def test_replay_follows_the_given_arrival_order(spark):
    """Lines arrive at 1 h and 9 h, the check at 3 h, while the creation times run the other way."""
    from helpers import stocks_df
    from pyspark.sql import functions as F
    from stockcast.operators import replay as R

    h = lambda n: BASE + timedelta(hours=n)
    lines = lines_df(spark, [("s", "p", "o1", 1, 5.0, h(9), h(1), "CAPTURED"), ("s", "p", "o2", 1, 7.0, h(1), h(2), "CAPTURED")])
    lines = lines.withColumn("arrival", F.when(F.col("order_id") == "o1", F.lit(h(1))).otherwise(F.lit(h(9))))
    got = R.replay_projections(lines, stocks_df(spark, [("s", "p", h(3), h(3), 100.0)]), 1, line_order=["arrival", "order_id", "line_no", "quantity"])
    rows = {(r["branch"], r["order_id"], r["quantity"]) for r in got.where("slice = 'A'").collect()}
    assert rows == {(R.ON_STOCK, None, 95.0), (R.ON_ORDER, "o2", 88.0)}

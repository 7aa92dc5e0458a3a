"""The segmented scan: whole and cut keys give the same results, one exchange of the
rows where no key is heavy, balanced chunks where one is."""

import os
import random
import subprocess
import sys
import tempfile
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, utc
from helpers import lines_df, stocks_df
from stockcast.operators import orders as O
from stockcast.operators import replay as R
from stockcast.operators import views as V
from stockcast.operators.scan import weighed
from stockcast.sources import tables

BASE = utc(2021, 1, 1)
HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _exchanges(df) -> list[str]:
    """Exchanges of rows (not broadcasts) in the plan."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    return [l.strip() for l in text.splitlines() if "Exchange " in l and "BroadcastExchange" not in l]


def test_one_exchange_of_the_rows(spark):
    lines, stock = tables.lines(spark, SF_SMALL), tables.stock(spark, SF_SMALL)
    lines, stock = spark.createDataFrame(lines.limit(50).collect(), lines.schema), spark.createDataFrame(stock.limit(50).collect(), stock.schema)
    for df in (O.order_table_rows(lines), O.order_table_changelog(lines), R.replay_projections(lines, stock, 7)):
        found = _exchanges(df)
        assert len(found) == 1 and "hashpartitioning(store" in found[0], found


def test_heavy_keys_are_cut_evenly_and_others_stay_whole(spark):
    rows = [("s", "hot", f"o{i % 50}", i, 1.0, BASE + timedelta(hours=i // 300), BASE, None) for i in range(3000)]
    rows += [("s", f"p{i}", "o", 1, 1.0, BASE, BASE, None) for i in range(1500)]
    whole, cut = weighed(lines_df(spark, rows), ["store", "product"], O.LINE_ORDER, chunk_rows=200)
    assert not whole.cut and whole.rows.count() == 1500
    sizes = [r["count"] for r in cut.rows.groupBy("chunk").count().collect()]
    assert cut.cut and sum(sizes) == 3000 and 10 <= len(sizes) <= 20 and max(sizes) < 500
    edges = cut.rows.groupBy("chunk").agg(F.min(F.struct(*O.LINE_ORDER)).alias("a"), F.max(F.struct(*O.LINE_ORDER)).alias("b")).orderBy("chunk").collect()
    assert all(x.b < y.a for x, y in zip(edges, edges[1:]))


def _mixed(seed=3):
    """A hot key with long spans, repeats, retractions and daily checks, and small keys."""
    rng = random.Random(seed)
    at = lambda h: BASE + timedelta(hours=h)
    lines, stocks = [], []
    for k in range(12):
        hot = k < 2
        for i in range(400 if hot else rng.randrange(0, 9)):
            q = float(rng.choice([1, 2, 3, 4, 5, 6, 7, 8]) if hot and i % 90 else rng.choice([-1, 0, 2, 2]))
            oid = f"o{rng.randrange(40)}"
            lines.append(("s", f"p{k}", oid, i % 3, q, at(rng.randrange(0, 900)), at(rng.randrange(0, 2400)), "CAPTURED"))
        for d in range(30 if hot else rng.randrange(0, 3)):
            stocks.append(("s", f"p{k}", at(24 * d + rng.randrange(0, 9)), at(24 * rng.randrange(-2, d + 1)), float(100 + d)))
    return lines, stocks


@pytest.mark.parametrize("rows", [7, 60])
def test_replay_of_cut_keys(spark, rows):
    lines, stocks = _mixed()
    lines, stocks = lines_df(spark, lines).repartition(3), stocks_df(spark, stocks).repartition(2)
    for mode in ("period_days", "calendar_days"):
        whole = R.replay_projections(lines, stocks, 5, mode).collect()
        cut = R.replay_projections(lines, stocks, 5, mode, pos_chunk=rows).collect()
        assert len(whole) > 5000 and sorted(map(str, whole)) == sorted(map(str, cut))


def test_asof_join_of_a_cut_key(spark):
    rng = random.Random(9)
    left = [(rng.choice([1, 1, 1, 2, None]), rng.randrange(400), i) for i in range(600)]
    right = [(rng.choice([1, 1, 2, 3, None]), rng.randrange(400), i) for i in range(500)]
    l, r = spark.createDataFrame(left, "k int, t int, i int"), spark.createDataFrame(right, "k int, t int, j int")
    want = {i: max(((u, j) for q, u, j in right if q is not None and q == k and u <= t), default=(None, None))[1] for k, t, i in left}
    for parts in (None, 40):
        got = {x["i"]: x["right_j"] for x in V.asof_left_join(l, r, "k", "t", ["j"], parts).collect()}
        assert got == want


def test_due_rows_stay_within_the_horizon(spark):
    """A thousand daily checks on one span: an info makes a row for each date whose horizon
    it falls into, not for each date."""
    at = lambda h: BASE + timedelta(hours=h)
    lines = lines_df(spark, [("s", "p", f"o{i}", 1, 1.0, at(i), at(24 * (i * 9)), None) for i in range(100)])
    stocks = stocks_df(spark, [("s", "p", at(200 + d), at(24 * d), 5.0) for d in range(1000)])
    days = 7
    for mode, reach in (("calendar_days", days), ("period_days", days * 34)):  # the dates span 33 months
        both, order = R.timeline(lines, stocks, O.LINE_ORDER)
        (part,) = weighed(both, R.KEYS, order)
        part = R.firsts_of(R.spans_of(part, order, F.col("src") == R.LINE, ["src"]), ["src"])
        rows = R.asked_and_due(R.dates_of(R.events_of(R.latest_of(part, order))), days, mode).rows
        assert rows.count() <= reach * 100 + 1100


def test_a_session_without_a_checkpoint_folder():
    """Nothing names a scratch folder: a local master makes one, and a cut key is stored there."""
    code = (
        "import sys; sys.path[:0] = ['.', 'tests']\n"
        "from pyspark.sql import SparkSession\n"
        "spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').config('spark.sql.shuffle.partitions', '2').getOrCreate()\n"
        "assert spark.conf.get('spark.checkpoint.dir', None) is None\n"
        "from helpers import lines_df\n"
        "from stockcast.operators import orders as O\n"
        "from datetime import datetime\n"
        "rows = [('s', 'p', f'o{i}', 1, 1.0, datetime(2021, 1, 1, i), datetime(2021, 1, 2), None) for i in range(9)]\n"
        "assert O.order_table_rows(lines_df(spark, rows), parts=4).count() == 9\n"
    )
    env = {k: v for k, v in os.environ.items() if k not in ("SPARK_CONF_DIR", "PYSPARK_SUBMIT_ARGS")}
    env["SPARK_CONF_DIR"] = tempfile.mkdtemp()
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=300, cwd=HOME)
    assert done.returncode == 0, done.stderr[-2000:]


def test_entry_lists_the_core_queries_without_the_other_packages():
    """Training-data operators that can't be imported leave the other queries in place."""
    code = (
        "import sys; sys.path.insert(0, '.')\n"
        "sys.modules['ahocorasick'] = None\n"
        "import __spark_entry__ as e\n"
        "names = e.queries()\n"
        "assert len(names) >= 38 and 'order_table' in names and not any(n.startswith('op') and n[2].isdigit() for n in names)\n"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=HOME)
    assert done.returncode == 0, done.stderr[-2000:]


def test_more_rows_make_more_tasks(spark, monkeypatch):
    from stockcast.operators import scan

    monkeypatch.setattr(scan, "TASK_ROWS", 1000)
    monkeypatch.setattr(scan, "LEAST_CHUNK", 100_000)
    for n in (10_000, 40_000):
        rows = spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("at"))
        (part,) = scan.weighed(rows, ["k"], ["at"])
        assert part.rows.rdd.getNumPartitions() == n // 1000  # AQE would coalesce them by size
        assert part.rows.count() == n


def test_checks_are_made_by_more_tasks(spark, monkeypatch, tmp_path):
    spark.range(1000).selectExpr("id AS p_partkey", "CAST(id % 50 AS INT) AS p_size").coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame([(i, f"r{i}") for i in range(5)], "r_regionkey int, r_name string").write.parquet(str(tmp_path / "region.parquet"))
    plain = tables.stock(spark, str(tmp_path))
    monkeypatch.setattr(tables, "PARTS_A_TASK", 100)
    dealt = tables.stock(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 10
    assert dealt.count() == plain.count() == 10_000 and dealt.exceptAll(plain).isEmpty()

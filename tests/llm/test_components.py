"""Connected components against union-find, over one and many levels."""

import random

import pyarrow as pa
import pytest

from stockcast.llm import components as C
from stockcast.llm.common import spread_join


def joined(edges):
    top = {}

    def find(x):
        top.setdefault(x, x)
        while top[x] != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((find(a), find(b)))
            top[high] = low
    return {x: find(x) for x in list(top)}


def graphs():
    rng = random.Random(6)
    mixed = list(range(1500))
    rng.shuffle(mixed)
    return {
        "chain": [(i, i + 1) for i in range(900)],
        "mixed chain": list(zip(mixed, mixed[1:])),
        "stars": [(i % 40 * 1000, i) for i in range(9000)],
        "random": [(rng.randrange(6000), rng.randrange(6000)) for _ in range(2800)],
        "loops and nulls": [(5, 5), (1, None), (None, 2), (7, 8), (8, 7), (7, 8)],
        "none": [],
    }


@pytest.mark.parametrize("name", graphs())
@pytest.mark.parametrize("at_once", [1 << 18, 40])
def test_components(spark, monkeypatch, name, at_once):
    monkeypatch.setattr(C, "AT_ONCE", at_once)
    edges = graphs()[name]
    got = C.components(spark.createDataFrame(edges, "a long, b long").repartition(11)).collect()
    assert len(got) == len({r.node for r in got}) and {r.node: r.component for r in got} == joined(edges)


def test_thinned_edges_are_bounded_by_nodes(spark):
    """40,000 edges of a dense group leave at most one edge a node and task."""
    rng = random.Random(2)
    edges = [(rng.randrange(900), rng.randrange(900)) for _ in range(40_000)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    assert C.thinned(frame).count() <= 4 * 899


def test_a_large_forest_is_given_out_in_pieces(monkeypatch):
    monkeypatch.setattr(C, "HELD", 50)
    rng = random.Random(3)
    edges = [(rng.randrange(1 << 18), rng.randrange(1 << 18)) for _ in range(200_000)]
    batches = [pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in edges[k : k + 20_000]]) for k in range(0, 200_000, 20_000)]
    out = [(r["a"], r["b"]) for batch in C._stars(batches) for r in batch.to_pylist()]
    assert joined(out) == {x: c for x, c in joined(edges).items()}


def test_spread_join_of_a_hot_key(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, null, id % 2) AS k")
    table = spark.createDataFrame([(1, "one"), (7, "seven")], "k long, name string")
    got = {r.id: r.name for r in spread_join(rows, table, ["k"], "id").collect()}
    assert got == {i: "one" if i % 3 and i % 2 else None for i in range(5000)}

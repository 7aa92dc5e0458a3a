"""Verified sets are made where the texts lie: no exchange holds a text."""

import numpy as np

from stockcast.llm import ngram_join


def test_filter_holds_its_ids_and_few_others(spark):
    ids = spark.createDataFrame([(i,) for i in (0, -1, 5, 5, 2**62, -(2**63))], "id long").repartition(3)
    words = ngram_join.id_filter(ids)
    held = lambda x: words[(at := ngram_join._id_bits(np.array(x, np.int64))) >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)
    assert held([0, -1, 5, 2**62, -(2**63)]).all() and held(range(100, 1100)).sum() < 10
    assert not ngram_join.id_filter(ids.limit(0)).any()


def test_texts_are_not_exchanged(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(k, " ".join([*base[:-1], f"end{k}"])) for k in range(4)] + [(9, "other words here and there"), (None, " ".join(base)), (2, "a text of an id that occurs twice"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    classes = spark.createDataFrame([], "n long, h1 long, h2 long, node long, seq long")
    families = spark.createDataFrame([], "node long, component long")
    links = ngram_join._verified(docs, classes, families, 4, 85, 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = links._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert any("text" in x for x in plan) and not any("Exchange" in x and "text" in x for x in plan)
    depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
    scan = next(i for i, x in enumerate(plan) if "text" in x and "MapInArrow" not in x)
    above = next(x for x in reversed(plan[:scan]) if "Exchange" in x or "MapInArrow" in x)
    assert "MapInArrow" in above and depth(above) < depth(plan[scan])
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.ngram_join(docs).collect()}
    assert got == {(0, 57): 0, (1, 57): 0, (2, 57): 0, (3, 57): 0, (9, 2): 9, (None, 57): None, (2, 5): 0, (3, 0): 3}

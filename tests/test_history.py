"""The temporal order table against the line-by-line model, for whole keys and for
keys cut into many chunks, with short lookup blocks."""

import random
from collections import Counter
from datetime import timedelta

import pytest

from conftest import utc
from helpers import lines_df
from stockcast.operators import history as H
from test_fold import _arrival, _info, _random_lines, model

BASE = utc(2021, 1, 1)


def _lines():
    rng = random.Random(21)
    rows = _random_lines(n_keys=60, seed=5)
    for i in range(500):  # a hot key with long spans and a few retractions
        q = 0.0 if i % 170 == 169 else float(rng.randrange(1, 4))
        rows.append(("s", "hot", f"o{rng.randrange(60)}", i, q, BASE + timedelta(hours=i // 3), BASE, "CAPTURED"))
    return rows


def _plain(x):
    return x.replace(tzinfo=None) if hasattr(x, "tzinfo") else x


def _key(info):
    return tuple(map(_plain, info))


@pytest.fixture(params=[None, 200])
def parts(request, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 16 if request.param else 1 << 12)
    return request.param


@pytest.fixture(scope="module")
def by_key():
    found = {}
    for r in sorted(_lines(), key=_arrival):
        found.setdefault(r[1], []).append(r)
    return found


def _info_of(r):
    return _key((r["quantity"], r["order_id"], r["created_at"], r["deliver_at"], r["status"]))


def test_history(spark, parts, by_key):
    want = Counter()
    for key, seq in by_key.items():
        _, after = model([_info(r) for r in seq])
        held = {}
        for rn, (line, state) in enumerate(zip(seq, after), start=1):
            for info in state:
                held.setdefault(info, (rn, line[5]))
            for info in [i for i in held if i not in state]:
                a = held.pop(info)
                want[(key, _key(info), a[0], _plain(a[1]), rn, _plain(line[5]))] += 1
        for info, a in held.items():
            want[(key, _key(info), a[0], _plain(a[1]), None, None)] += 1
    got = H.order_table_history(lines_df(spark, _lines()).repartition(4), parts=parts).collect()
    assert Counter((r["product"], _info_of(r), r["from_rn"], r["from_at"], r["to_rn"], r["to_at"]) for r in got) == want


def test_as_of(spark, parts, by_key):
    rng = random.Random(4)
    asked = [("s", k, BASE + timedelta(minutes=rng.randrange(-30, 60 * 7 if k != "hot" else 60 * 170)), i) for i, k in enumerate([*by_key, *["hot"] * 60, "none"])]
    asked += [(None, "hot", BASE, -1), ("s", "hot", None, -2), asked[0]]
    want = Counter()
    for _, k, at, i in asked:
        seq = by_key.get(k, []) if at is not None and i != -1 else []
        _, after = model([_info(r) for r in seq])
        upto = sum(r[5] <= at for r in seq) if seq else 0
        for info in after[upto - 1] if upto else []:
            want[(k, i, _key(info))] += 1
    instants = spark.createDataFrame(asked, "store string, product string, at timestamp, i int")
    got = H.order_table_as_of(lines_df(spark, _lines()).repartition(3), instants, parts=parts).collect()
    assert Counter((r["product"], r["i"], _info_of(r)) for r in got) == want


def test_merged_infos(spark, parts, by_key):
    got = {}
    for r in H.merged_infos(lines_df(spark, _lines()).repartition(3), parts=parts).collect():
        got.setdefault((r["product"], r["rn"]), []).append((not r["own"], r["from_rn"], _info_of(r)))
    for key, seq in by_key.items():
        infos = [_info(r) for r in seq]
        _, after = model(infos)
        for rn, (own, state) in enumerate(zip(infos, after), start=1):
            want = [_key(own), *[_key(i) for i in state if i != own]]  # the new info first, then the table's
            assert [i for _, _, i in sorted(got[(key, rn)])] == want
    assert len(got) == sum(map(len, by_key.values()))


def test_no_lines(spark):
    lines = lines_df(spark, [])
    instants = spark.createDataFrame([("s", "p", BASE)], "store string, product string, at timestamp")
    assert H.order_table_history(lines).count() == H.order_table_as_of(lines, instants).count() == H.merged_infos(lines).count() == 0

"""Labels of the licence scan against a brute-force alignment, and the base columns against
their SQL."""

import random
import re

import duckdb
import pytest

from stockcast.llm import license_scan as L

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return [x for x in re.split(L.WORDS, (text or "").translate(LOWER)) if x]


def cover(w, notice):
    """Best share of the notice's k-grams that some stretch of the text has in order, its
    hits at most two cells of diagonals wide."""
    t = notice.split()
    grams = len(t) - L.GRAM + 1
    hits = [(i, j) for i in range(len(w) - L.GRAM + 1) for j in range(grams) if w[i : i + L.GRAM] == t[j : j + L.GRAM]]
    best = 0
    for low in {(i - j) // (L.SHIFT + 1) + d for i, j in hits for d in (-1, 0)}:
        group = sorted((i, j) for i, j in hits if (i - j) // (L.SHIFT + 1) in (low, low + 1))
        length = {}
        for i, j in group:
            length[i, j] = 1 + max((n for (a, b), n in length.items() if a < i and b < j), default=0)
        best = max(best, max(length.values()))
    return best / grams


def labels(text):
    w = words(text)
    found = {label for label, phrase in L.PHRASES if any(w[i : i + len(phrase.split())] == phrase.split() for i in range(len(w)))}
    return ",".join(sorted(found | {label for label, notice in L.NOTICES if cover(w, notice) >= L.COVER}))


def texts():
    rng = random.Random(17)
    out = ["this work is this work is this work is licensed under a", None, "", "mit licensed", "MIT License", "the " * 400]
    for _, notice in L.NOTICES:
        w = notice.split()
        out += [notice.upper(), f"so {notice} and", " ".join([notice] * 3)]
        k = rng.randrange(1, len(w))
        out += [" ".join(w[:k] + ["very", "much"][: rng.randrange(1, 3)] + w[k:]), " ".join(w[: k - 1] + w[k:])]  # words put in, left out
        out += [" ".join(w[len(w) // 2 :] + w[: len(w) // 2]), " ".join(rng.sample(w, len(w))), " ".join(w[: int(len(w) * 0.7)])]
        out.append(" ".join(x for a in range(0, len(w), 4) for x in [*w[a : a + 4], *w[a : a + 2]]))  # stutters
    long = " ".join(rng.choice(["the", "software", "is", "provided", "as", "notice"]) for _ in range(3000))
    return out + [long, f"{long} {L.NOTICES[0][1]} {long}"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())] + [(None, L.NOTICES[0][1], "x"), (1, None, "x")], "doc_id long, text string, template string").repartition(3)


def test_labels_are_those_of_an_alignment(docs):
    got = {r.doc_id: r for r in L.license_scan(docs).collect() if r.doc_id is not None}
    for i, text in enumerate(texts()):
        assert got[i].labels == labels(text), (i, text)
        best = max([cover(words(text), n) for _, n in L.NOTICES] + [float(bool(got[i].n_base))])
        assert abs(got[i].score - best) < 1e-9
    assert got[0].labels == ""  # four of seven k-grams, three times


def test_every_notice_has_its_own_label(spark):
    rows = [(i, notice) for i, (_, notice) in enumerate(L.NOTICES)]
    for r in L.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        base = set(filter(None, r.base_labels.split(",")))
        assert set(r.labels.split(",")) == {L.NOTICES[r.doc_id][0]} | base


def test_base_columns_equal_their_sql(spark):
    rows = [(i, t) for i, t in enumerate(texts())]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = sorted(con.execute(L.BASE_SQL).fetchall())
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"]
    got = L.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).select(*columns).collect()
    assert sorted(map(tuple, got)) == want


def test_no_python_on_the_main_path(spark):
    found = L.license_scan(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    text = found._sc._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert not any(node in text for node in ("MapIn", "EvalPython", "FlatMapGroups", "PythonUDF"))

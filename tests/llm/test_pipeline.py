"""Every stage of the corpus pipeline against brute force, on the stage's own input."""

import collections
import hashlib
import re

import pytest

pytest.importorskip("public_tokenizers")
import corpus_pipeline as pipeline  # noqa: E402
from stockcast.llm import mixing, quality  # noqa: E402

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input rows, output rows, output columns) of each stage, run in order; the input holds
    near copies, repeated texts, nulls and empty texts besides the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, [tuple(r) for r in docs.collect()]
    long = [r for r in rows if len(words(r[1])) > 60][:6]
    more = [(10_000 + k, r[1] + " " + "added word", *r[2:]) for k, r in enumerate(long)]
    more += [(20_000 + k, re.sub(r" ", "  ", r[1]), *r[2:]) for k, r in enumerate(long)]
    more += [(30_000, None, "en", "web", 0), (30_001, "", "en", None, 0), (30_002, " ", None, "web", 1)]
    frame = spark.createDataFrame(rows + more, docs.schema).repartition(5)
    out = {}
    for name, stage in pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, frame, SF).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = ([r.asDict() for r in frame.collect()], [r.asDict() for r in after.collect()], after.columns)
        frame = after
    return columns, out


def test_stage_names_and_columns(stages):
    columns, out = stages
    assert list(out) == ["quality classifier", "exact dedup", "n-gram Jaccard join", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    for name in list(out)[:-1]:
        assert sorted(out[name][2]) == sorted(columns)


def test_quality_stage(spark, stages):
    before, after, _ = stages[1]["quality classifier"]
    frame = spark.createDataFrame([(r["doc_id"], r["text"]) for r in before], "doc_id long, text string")
    good = {r.doc_id for r in quality.classify(frame, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    assert {r["doc_id"] for r in after} <= {r["doc_id"] for r in before} and 0 < len(after) < len(before)
    assert len({r["doc_id"] for r in after} ^ good) <= 0.02 * len(before)  # fitted again on the same rows
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in after}
    assert sum((d in kept) == bool(q) for d, q in labels.items()) >= 0.9 * len(labels)


def test_exact_stage(stages):
    before, after, _ = stages[1]["exact dedup"]
    first = {}
    for r in sorted(before, key=lambda r: r["doc_id"]):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or ""), r)
    assert sorted(map(str, after)) == sorted(map(str, first.values())) and len(after) < len(before)


def test_near_stage(stages):
    before, after, _ = stages[1]["n-gram Jaccard join"]
    n = pipeline.WORDS
    grams = {}
    for r in before:
        w = words(r["text"])
        grams[r["doc_id"]] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()
    top = {d: d for d in grams}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(grams)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            x, y = grams[a], grams[b]
            if x and y and pipeline.OF * len(x & y) >= pipeline.SIMILAR * len(x | y):
                low, high = sorted((find(a), find(b)))
                top[high] = low
    stay = {d for d in ids if find(d) == d}
    assert sorted(map(str, after)) == sorted(str(r) for r in before if r["doc_id"] in stay) and len(after) < len(before)


def test_mixing_stage(spark, stages):
    before, after, _ = stages[1]["mixing sources to target weights"]
    frame = spark.createDataFrame([(r["doc_id"], r["text"], r["source"]) for r in before], "doc_id long, text string, source string")
    mix = mixing.mix(frame).collect()
    assert collections.Counter(r["doc_id"] for r in after) == collections.Counter({r.doc_id: r.copies for r in mix if r.copies})
    whole = {r["doc_id"]: r for r in before}
    assert all(r == whole[r["doc_id"]] for r in after)
    taken, biggest = collections.Counter(), collections.Counter()
    for r in after:
        taken[r["source"]] += len(words(r["text"]))
        biggest[r["source"]] = max(biggest[r["source"]], len(words(r["text"])))
    for r in mix:
        assert abs(taken[r.source] - r.target) <= 2 * biggest[r.source] + 1


def test_bpe_stage(stages):
    tiktoken = pytest.importorskip("tiktoken")
    from stockcast.llm import bpe
    from stockcast.llm.queries import vocabulary

    path, pattern = vocabulary()
    coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    before, after, columns = stages[1]["byte-level BPE encoding and decoding"]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = collections.Counter()
    for r in before:
        ids = coder.encode_ordinary(r["text"] or "")
        want[r["doc_id"], len(ids), sha(",".join(map(str, ids))), sha(r["text"] or "")] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in after) == want and "ids" in columns


def test_run_keeps_all_of_every_stage(spark, stages):
    got = pipeline.run(spark, SF)
    assert got.columns == stages[1]["byte-level BPE encoding and decoding"][2]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert 0 < got.select("doc_id").distinct().count() <= docs.count()

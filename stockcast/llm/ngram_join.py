"""N-gram Jaccard join: a blocked sparse product of the document by n-gram matrix.

Documents link when ``den * |A and B| >= num * |A or B|`` for their sets of
distinct word n-grams. All links count; the result is each document's
component (smallest id reachable). How it runs:

1. A pass counts n-grams into a fixed-size table of hashed counters (summed by
   a shuffle). It only *orders* the matrix columns: rare columns first. Any
   order gives the same links, a good one gives small blocks.
2. Documents with equal sets become one class (hashed set equality, combined
   map-side), so groups of copies cost one row.
3. Each class indexes only its first ``n - ceil(t n) + 1`` columns: a linked
   pair must share one of them. Overlap counts are accumulated per pair over
   these columns, cut into blocks by size, and pairs whose size-derived bound
   cannot reach the threshold are discarded. A block that many classes share
   emits no pairs but a star around the token's smallest class, which puts all of
   its classes into one family.
4. Surviving pairs and stars form families (connected candidates). Within a
   family the whole sets are multiplied: blocks of classes against blocks of
   the same or the next size level, sizes farther apart cannot link. A block
   holds a bounded number of n-grams; a large family becomes many blocks. Only
   a spanning forest of the verified links leaves a block.

Edge cases: null or empty text, or no words: size 0, no links. Fewer words
than n: the whole sequence is the one n-gram. Rows without id keep their row,
link with nothing and have a null component. Repeated rows share an id and so a component.
An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import give_back, mixed, spread_join, stored, word_runs
from stockcast.llm.components import components, forest

COUNTER_BITS = 18
COUNTERS = 1 << COUNTER_BITS  # hashed n-gram counters; their levels take 256 KB
PAIRS_UPTO = 128  # a column block of more classes makes a star instead of pairs
BLOCK = 1 << 21  # n-grams in one block of a product
FILTER_BITS = 24  # hashed document ids of a filter; 2 MB

_U = np.uint64


def shingle_runs(column: pa.Array, n: int):
    """(text index, hashes): every text's distinct n-gram hashes, sorted."""
    for a, b, words in word_runs(column):
        h, first = words.hashes(), words.first
        size = np.diff(first)
        grams = np.zeros(max(0, len(h) - n + 1), _U)
        for k in range(n):
            grams = mixed(grams * _U(0x9E3779B97F4A7C15) + h[k : k + len(grams)])
        doc = words.doc
        whole = doc[: len(grams)] == doc[n - 1 :] if len(grams) else np.zeros(0, bool)
        grams, at = grams[whole], doc[: len(grams)][whole]
        few = np.flatnonzero((size > 0) & (size < n))
        if len(few):
            short = np.array([_sequence(h[first[i] : first[i + 1]]) for i in few], _U)
            where = np.searchsorted(at, few)
            grams, at = np.insert(grams, where, short), np.insert(at, where, few)
        cut = np.searchsorted(at, np.arange(b - a + 1)).tolist()
        for i in range(b - a):
            own = np.sort(grams[cut[i] : cut[i + 1]])
            if len(own) > 1:
                own = own[np.r_[True, own[1:] != own[:-1]]]
            yield a + i, own


def _sequence(h: np.ndarray) -> np.uint64:
    x = np.array([len(h)], _U)
    for v in h:
        x = mixed(x * _U(0xC2B2AE3D27D4EB4F) + v)
    return x[0]


def _digests(grams: np.ndarray) -> tuple[int, int]:
    """Two sums that tell sets apart."""
    if not len(grams):
        return 0, 0
    with np.errstate(over="ignore"):
        return int(grams.sum(dtype=_U).view(np.int64)), int(mixed(grams ^ _U(0xD6E8FEB86659FD93)).sum(dtype=_U).view(np.int64))


def column_levels(docs: DataFrame, text: str, n: int) -> np.ndarray:
    """For each hashed counter 0 for ordinary counts, else about log2 of the
    count (uint8). Counts beyond four deviations of an even spread stand out."""

    def count(batches):
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            held, size = [], 0
            for _, grams in shingle_runs(batch.column(0), n):
                held.append(grams)
                size += len(grams)
                if size > 1 << 20:
                    total += np.bincount((np.concatenate(held) >> _U(64 - COUNTER_BITS)).astype(np.int64), minlength=COUNTERS)
                    held, size = [], 0
            if held:
                total += np.bincount((np.concatenate(held) >> _U(64 - COUNTER_BITS)).astype(np.int64), minlength=COUNTERS)
        at = np.flatnonzero(total)
        for k in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + (1 << 16)], pa.int32()), pa.array(total[at[k : k + (1 << 16)]])], ["counter", "count"])
        give_back()

    counts = docs.select(text).mapInArrow(count, "counter int, count long").groupBy("counter").agg(F.sum("count").alias("count"))
    counts = stored(counts, "ngram-counters")
    mean = (counts.agg(F.sum("count")).first()[0] or 0) / COUNTERS
    high = counts.where(F.col("count") > mean + 4 * math.sqrt(mean) + 4).toArrow()  # at most COUNTERS rows
    level = np.zeros(COUNTERS, np.uint8)
    level[high["counter"].to_numpy()] = np.log2(high["count"].to_numpy()).astype(np.uint8) + 1
    return level


def size_level(n: str, num: int, den: int) -> Column:
    """Sizes of linked sets are at most one level apart."""
    step = math.log(den / num) * (1 + 1e-9) if num < den else 1.0
    return F.floor(F.log(F.col(n).cast("double")) / step)


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row; links need
    ``den * intersection >= num * union``."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    levels = spark.sparkContext.broadcast(column_levels(docs, "text", n))

    def sets(batches):
        for batch in batches:
            ids, rows = batch.column(0), []
            for _, grams in shingle_runs(batch.column(1), n):
                keep = len(grams) - -(-num * len(grams) // den) + 1 if len(grams) else 0
                level = levels.value[(grams >> _U(64 - COUNTER_BITS)).astype(np.int64)]
                # by level, then by the low bits; grams are sorted, which settles ties
                first = np.argsort(level.astype(_U) << _U(56) | grams & _U((1 << 56) - 1), kind="stable")[:keep]
                rows.append((len(grams), *_digests(grams), (grams[first] & _U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [ids, *(pa.array([r[k] for r in rows], pa.int64()) for k in range(3)), pa.array([r[3] for r in rows], pa.list_(pa.int32()))],
                ["doc_id", "n", "h1", "h2", "prefix"],
            )
        give_back()

    rows = docs.mapInArrow(sets, "doc_id long, n long, h1 long, h2 long, prefix array<int>").withColumn("seq", F.monotonically_increasing_id())
    rows = stored(rows, "ngram-sets")
    some = rows.where("n > 0 and doc_id is not null")
    classes = some.groupBy("n", "h1", "h2").agg(F.min(F.struct("doc_id", "seq")).alias("first"))
    classes = stored(classes.select("n", "h1", "h2", F.col("first.doc_id").alias("node"), F.col("first.seq").alias("seq")), "ngram-classes")

    # Product over the indexed columns: (token, class) entries, of each class's first row.
    entries = some.select("seq", "n", "prefix").join(classes.select("seq", "node"), "seq").select(F.explode("prefix").alias("token"), "node", F.col("n").cast("int"))
    often = entries.groupBy("token").agg(F.count("*").alias("g"), F.min("node").alias("hub")).where("g > 1").select("token", "hub")
    # Linked sizes are at most one level apart: a token's column is cut by level,
    # and a class stands in the blocks of its own and the next level.
    level = size_level("n", num, den)
    # few tokens are shared: stored, as two readers of other columns would exchange all entries twice
    shared = stored(entries.join(often, "token"), "ngram-shared")
    entries = shared.withColumn("lv", level).withColumn("b", F.explode(F.array(F.col("lv"), F.col("lv") + 1)))
    column = entries.groupBy("token", "b").agg(F.count("*").alias("g")).where("g > 1")
    entries = stored(entries.join(column, ["token", "b"]), "ngram-entries")
    star = entries.where((F.col("g") > PAIRS_UPTO) & (F.col("node") != F.col("hub"))).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    small = entries.where(F.col("g") <= PAIRS_UPTO)
    x = small.select("token", "b", F.col("node").alias("a"), F.col("n").alias("na"), F.col("lv").alias("la")).alias("x")
    y = small.select("token", "b", F.col("node").alias("c"), F.col("n").alias("nc"), F.col("lv").alias("lc")).alias("y")
    near = (F.col("na") * den >= F.col("nc") * num) & (F.col("nc") * den >= F.col("na") * num)
    once = F.col("x.b") == F.greatest("la", "lc")  # two classes of one level meet in two blocks
    beyond = F.greatest(F.floor(F.col("na") * num / den), F.floor(F.col("nc") * num / den))  # columns past a prefix, at most
    pair = (
        x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.b") == F.col("y.b")) & (F.col("a") < F.col("c")) & once & near)
        .groupBy("a", "c", "na", "nc")
        .agg(F.count("*").alias("overlap"))
        .where((F.col("overlap") + beyond) * (num + den) >= (F.col("na") + F.col("nc")) * num)
        .select("a", F.col("c").alias("b"))
    )
    families = stored(components(star.union(pair)), "ngram-families")
    links = _verified(docs, classes, families, n, num, den)
    joined = stored(components(links), "ngram-components")
    named = classes.drop("seq").join(joined, "node", "left").select("n", "h1", "h2", F.coalesce("component", "node").alias("component_id"))
    return (
        spread_join(rows.select("doc_id", "seq", "n", "h1", "h2"), named, ["n", "h1", "h2"], "seq")
        .select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).otherwise(F.col("doc_id")).alias("component_id"))
    )


def _id_bits(ids: np.ndarray) -> np.ndarray:
    """The place of each id in a filter."""
    return mixed(ids.astype(np.int64).view(_U) + _U(1)) >> _U(64 - FILTER_BITS)


def id_filter(ids: DataFrame) -> np.ndarray:
    """One bit a hashed id, in words of 64: ids that are not in it aren't among ``ids``. Of a
    fixed size, so that with very many ids more others pass."""

    def bits(batches):
        words = np.zeros(1 << FILTER_BITS - 6, _U)
        for batch in batches:
            at = _id_bits(batch.column(0).to_numpy())
            np.bitwise_or.at(words, (at >> _U(6)).astype(np.int64), _U(1) << (at & _U(63)))
        at = np.flatnonzero(words)
        for k in range(0, len(at), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(at[k : k + (1 << 16)], pa.int32()), pa.array(words[at[k : k + (1 << 16)]].view(np.int64))], ["word", "bits"])

    found = ids.mapInArrow(bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << FILTER_BITS - 6, _U)
    words[found["word"].to_numpy()] = found["bits"].to_numpy().view(_U)
    return words


def _verified(docs: DataFrame, classes: DataFrame, families: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b): a forest of the links inside each block of the families' products."""
    member = families.withColumnRenamed("component", "family").join(classes.drop("seq"), "node").select(F.col("node").alias("doc_id"), "family", "n", "h1", "h2")
    level = size_level("n", num, den)
    whole = member.groupBy("family").agg(F.sum("n").alias("all_n"))
    parts = member.withColumn("level", level).groupBy("family", "level").agg(F.sum("n").alias("level_n"))
    parts = parts.join(whole, "family").withColumn("split", F.when(F.col("all_n") <= BLOCK, F.lit(0)).otherwise(F.ceil(F.col("level_n") / F.lit(BLOCK // 2))).cast("int"))
    following = parts.select("family", (F.col("level") - 1).alias("level"), F.col("split").alias("after"))
    before = parts.select("family", (F.col("level") + 1).alias("level"), F.col("split").alias("ahead"))
    parts = parts.join(following, ["family", "level"], "left").join(before, ["family", "level"], "left").select("family", "level", "split", F.coalesce("after", F.lit(0)).alias("after"), F.coalesce("ahead", F.lit(0)).alias("ahead"))
    # Blocks (level, i) x (level, j >= i) and (level, i) x (level + 1, j); side 1
    # rows are compared with side 2 rows, side 0 rows with one another.
    own = F.pmod(F.xxhash64("doc_id"), F.greatest("split", F.lit(1)).cast("long")).cast("int")
    block = lambda lv, i, up, j, side: F.struct(lv.cast("long").alias("lv"), i.cast("int").alias("i"), F.lit(up).alias("up"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    upto = lambda c: F.sequence(F.lit(0), c - 1)
    none = F.array().cast("array<struct<lv:bigint,i:int,up:int,j:int,side:int>>")
    lv, i = F.col("level"), F.col("own")
    placed = F.when(F.col("split") == 0, F.array(block(F.lit(0), F.lit(0), 0, F.lit(0), 0))).otherwise(
        F.concat(
            F.array(block(lv, i, 0, i, 0)),
            F.transform(F.filter(upto(F.col("split")), lambda j: j > i), lambda j: block(lv, i, 0, j, 1)),
            F.transform(F.filter(upto(F.col("split")), lambda j: j < i), lambda j: block(lv, j, 0, i, 2)),
            F.when(F.col("after") > 0, F.transform(upto(F.col("after")), lambda j: block(lv, i, 1, j, 1))).otherwise(none),
            F.when(F.col("ahead") > 0, F.transform(upto(F.col("ahead")), lambda j: block(lv - 1, j, 1, i, 2))).otherwise(none),
        )
    )
    placed = spread_join(member.withColumn("level", level), parts, ["family", "level"], "doc_id").withColumn("own", own).select("doc_id", "family", "n", "h1", "h2", F.explode(placed).alias("p")).select("doc_id", "family", "n", "h1", "h2", "p.*")
    wanted = docs.sparkSession.sparkContext.broadcast(id_filter(families.select("node")))

    def full(batches):
        # the texts are read where they lie: only the sets of wanted documents are exchanged
        for batch in batches:
            ids = batch.column(0)
            at = _id_bits(ids.fill_null(0).to_numpy(zero_copy_only=False))
            there = (wanted.value[(at >> _U(6)).astype(np.int64)] >> (at & _U(63)) & _U(1)).astype(bool) & ids.is_valid().to_numpy(zero_copy_only=False)
            batch = batch.filter(pa.array(there))
            out = []
            for _, grams in shingle_runs(batch.column(1), n):
                out.append((len(grams), *_digests(grams), grams.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array([r[k] for r in out], pa.int64()) for k in range(3)), pa.array([r[3] for r in out], pa.binary())], ["doc_id", "n", "h1", "h2", "grams"]
            )
        give_back()

    sets = docs.select("doc_id", "text").mapInArrow(full, "doc_id long, n long, h1 long, h2 long, grams binary")
    rows = placed.join(sets, ["doc_id", "n", "h1", "h2"]).select("family", "lv", "i", "up", "j", F.col("doc_id").alias("node"), "n", "h1", "h2", "side", "grams")

    def product(group: pa.Table) -> pa.Table:
        node, side = group["node"].to_numpy(), group["side"].to_numpy()
        sets = np.stack([node, *(group[c].to_numpy() for c in ("n", "h1", "h2"))], 1)
        at = np.unique(sets, axis=0, return_index=True)[1]  # a repeated row comes once, other texts of its id too
        node, side = node[at], side[at]
        lists = [np.frombuffer(g, _U) for g in group["grams"].take(pa.array(at)).to_pylist()]
        a, b = _block_links(lists, side, num, den)
        if len(a):
            tree, root = forest(node[a], node[b])
            a, b = tree[tree != root], root[tree != root]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return rows.groupBy("family", "lv", "i", "up", "j").applyInArrow(product, "a long, b long")


def _block_links(lists: list[np.ndarray], side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked index pairs of a block: row by row of the sparse product, overlap
    counts of a document with all others whose size allows a link."""
    size = np.array([len(x) for x in lists])
    order = np.argsort(size, kind="stable")
    size, side, lists = size[order], side[order], [lists[k] for k in order]
    column, inverse = np.unique(np.concatenate(lists), return_inverse=True)
    row = np.repeat(np.arange(len(lists)), size)
    cut = np.concatenate([[0], np.cumsum(size)])
    held = np.argsort(inverse, kind="stable")  # by column, then by size of the document
    holder = row[held]
    start = np.searchsorted(inverse[held], np.arange(len(column) + 1))
    shared = (start[1:] - start[:-1]) > 1
    left, right = [], []
    for k in range(len(lists)):
        low = np.searchsorted(size, -(-num * size[k] // den))  # earlier documents are too small
        if low >= k:
            continue
        cols = inverse[cut[k] : cut[k + 1]]
        cols = cols[shared[cols]]
        if len(cols) * den < num * size[k]:
            continue
        count, at = start[cols + 1] - start[cols], start[cols]
        where = np.repeat(at - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        overlap = np.bincount(holder[where], minlength=k + 1)[low:k]
        linked = low + np.flatnonzero((num + den) * overlap >= num * (size[low:k] + size[k]))
        linked = linked[(side[linked] == 0) | (side[linked] != side[k])]
        left.append(np.full(len(linked), k))
        right.append(linked)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return order[np.concatenate(left)], order[np.concatenate(right)]

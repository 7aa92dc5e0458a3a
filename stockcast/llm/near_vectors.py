"""Embedding near-dedup on a robust-pruned flat graph.

Vectors of equal label (and length) are dealt to overlapping shards: centres
are fitted on a bounded sample, and each vector goes to its nearest ones. To how
many is measured for each label: sampled vectors are compared with all vectors
of the label, and the overlap grows from ``OVERLAP`` until ``RECALL`` of their links,
in all and of a vector on average, lie in a common shard. Where few links were seen,
made pairs just at the threshold have to be held as well. A label for which
``WIDEST`` shards a vector are too few (or cost more than comparing all) is one shard.
Inside a shard, overlapping cells get a robust-pruned neighbour graph each
(candidates from greedy search on the graph so far, pruned so that no
neighbour is reached better through another); the cells' adjacency lists are
united to one flat graph. Every vector is then searched from the cells' medoids;
once the search has come in range of the threshold it expands until no vector in
range is left unvisited. Found pairs are verified by cosine in double
precision. Each shard audits its recall on sampled vectors against brute force
and searches again, wider, where it falls short; where that doesn't help either
(a group of all but equal vectors, whose links the prune drops), the shard is
compared whole, in exact products.

Equal unit vectors are one representative with a number of copies: the copies
link with one another and share all other links, so they need no search.

A pair that several shards hold counts in the first of them alone, so counts add
up without listing pairs: a shard returns a number of links for each vector and
a spanning forest. A shard beyond ``BLOCK`` vectors is split into blocks and
searched block against block, so no task holds more than two blocks.

Edge cases: a null label or vector, a zero vector, or one with null or
non-finite components links with nothing and stays. Repeated rows are vectors
of their own (linked, as their cosine is 1, and counted one by one). A null id never is a component's smallest
id unless there is no other. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockcast.llm.common import stored
from stockcast.llm.components import components, forest

SAMPLE = 20_000  # vectors that centres are fitted on
SHARD, BLOCK = 500, 4_096  # vectors a centre is made for; most in a block
OVERLAP, WIDEST = 2, 12  # shards a vector is dealt to, at least and at most
QUERIES, EVIDENCE = 2048, 64  # vectors a label that audit the dealing; linked ones that are enough
CELL, DEGREE, BEAM, ALPHA = 512, 24, 48, 1.2
AUDIT, RECALL = 32, 0.98


# ------------------------------------------------------------------ the graph


def search(x, graph, queries, entries, beam, near=None):
    """Greedy search of many queries at once. Returns (ids, sims) of the best
    ``beam`` each, or, with ``near``, the mask of all vectors of at least that similarity
    that were reached (range expansion)."""
    q, n = len(queries), len(x)
    seen = np.zeros((q, n), bool)
    done = np.zeros((q, n), bool)
    rows = np.arange(q)
    point = x[queries]
    best = np.full((q, beam), -1)
    sims = np.full((q, beam), -np.inf)
    found = np.zeros((q, n), bool) if near is not None else None

    def visit(who, ids):
        """Adds unseen ids (rows of ``who``) to the beams."""
        ids = np.where(ids >= 0, ids, 0) if (fresh := ids >= 0).all() else np.where(fresh, ids, 0)
        fresh &= ~seen[who[:, None], ids]
        order = np.sort(np.where(fresh, ids, n), axis=1)
        fresh = (order < n) & np.concatenate([np.ones((len(who), 1), bool), order[:, 1:] != order[:, :-1]], 1)
        ids = np.where(fresh, order, 0)
        near_by = np.where(fresh, np.einsum("qrd,qd->qr", x[ids], point[who]), -np.inf)
        r, c = np.nonzero(fresh)
        seen[who[r], ids[r, c]] = True
        if found is not None:
            found[who[r], ids[r, c]] = near_by[r, c] >= near
        all_ids = np.concatenate([best[who], np.where(fresh, ids, -1)], 1)
        all_sims = np.concatenate([sims[who], near_by], 1)
        top = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        best[who] = np.take_along_axis(all_ids, top, 1)
        sims[who] = np.take_along_axis(all_sims, top, 1)

    visit(rows, np.broadcast_to(entries, (q, len(entries))).copy())
    active = rows
    while len(active):
        ids = best[active]
        waiting = (ids >= 0) & ~done[active[:, None], np.maximum(ids, 0)]
        has = waiting.any(1)
        active, ids, waiting = active[has], ids[has], waiting[has]
        if not len(active):
            break
        step = np.argsort(~waiting, axis=1, kind="stable")[:, :2]  # the two best not yet expanded
        chosen = np.where(np.take_along_axis(waiting, step, 1), np.take_along_axis(ids, step, 1), -1)
        r, c = np.nonzero(chosen >= 0)
        done[active[r], chosen[r, c]] = True
        links = np.where(chosen[:, :, None] >= 0, graph[np.maximum(chosen, 0)], -1)
        visit(active, links.reshape(len(active), -1))
    if near is None:
        return best, sims
    active = rows
    while len(active):  # expand all that is in range
        open_ = found[active] & ~done[active]
        has = open_.any(1)
        active, open_ = active[has], open_[has]
        if not len(active):
            break
        chosen = np.argsort(~open_, axis=1, kind="stable")[:, :8]
        valid = np.take_along_axis(open_, chosen, 1)
        r, c = np.nonzero(valid)
        done[active[r], chosen[r, c]] = True
        links = np.where(valid[:, :, None], graph[chosen], -1)
        visit(active, links.reshape(len(active), -1))
    return found


def pruned(x, nodes, pool):
    """Robust prune of the candidate lists ``pool`` (-1: none) of ``nodes``."""
    m = len(nodes)
    pool = np.where(pool == nodes[:, None], -1, pool)
    pool = np.sort(pool, axis=1)
    pool[:, 1:][pool[:, 1:] == pool[:, :-1]] = -1
    cand = x[np.maximum(pool, 0)]
    dist = np.where(pool >= 0, np.maximum(0, 2 - 2 * np.einsum("mpd,md->mp", cand, x[nodes])), np.inf)
    out = np.full((m, DEGREE), -1)
    rows = np.arange(m)
    for k in range(DEGREE):
        pick = np.argmin(dist, axis=1)
        live = np.isfinite(dist[rows, pick])
        if not live.any():
            break
        out[live, k] = pool[rows[live], pick[live]]
        between = np.maximum(0, 2 - 2 * np.einsum("mpd,md->mp", cand, cand[rows, pick]))
        dist[(ALPHA**2 * between <= dist) & live[:, None]] = np.inf
        dist[rows, pick] = np.inf
    return out


def cell_graph(x, members, rng):
    """Neighbour lists (indices into x) of one cell's members, and its medoid."""
    n = len(members)
    local = x[members]
    medoid = int(np.argmax(local @ local.mean(0)))
    graph = np.full((n, DEGREE), -1)
    if n > 1:
        graph[:, : min(8, n - 1)] = (np.arange(n)[:, None] + rng.permutation(np.arange(1, n))[: min(8, n - 1)]) % n
        for first in range(0, n, 512):  # insert in batches
            nodes = np.arange(first, min(n, first + 512))
            pool, _ = search(local, graph, nodes, np.array([medoid]), BEAM)
            graph[nodes] = pruned(local, nodes, np.concatenate([pool, graph[nodes]], 1))
            # back links of the batch: those pointed at get candidates and are pruned again
            src, at = np.nonzero(graph[nodes] >= 0)
            dst, src = graph[nodes][src, at], nodes[src]
            order = np.argsort(dst, kind="stable")
            dst, src = dst[order], src[order]
            hit, start, count = np.unique(dst, return_index=True, return_counts=True)
            back = np.full((len(hit), min(int(count.max()), 2 * BEAM)), -1)
            slot = np.arange(len(dst)) - np.repeat(start, count)
            keep = slot < back.shape[1]
            back[np.repeat(np.arange(len(hit)), count)[keep], slot[keep]] = src[keep]
            graph[hit] = pruned(local, hit, np.concatenate([graph[hit], back], 1))
    return np.where(graph >= 0, members[np.maximum(graph, 0)], -1), int(members[medoid])


def flat_graph(x, rng):
    """The united adjacency lists of overlapping cells, and the cells' medoids."""
    n = len(x)
    k = max(1, -(-n // (CELL // 2)))
    if k == 1:
        cells = [np.arange(n)]
    else:
        centres = x[rng.choice(n, k, replace=False)]
        near = np.argsort(-(x @ centres.T), axis=1, kind="stable")[:, :2]
        cells = [np.flatnonzero((near == c).any(1)) for c in range(k)]
    graph = np.full((n, 2 * DEGREE), -1)
    used = np.zeros(n, np.int64)
    medoids = []
    for members in cells:
        if len(members):
            links, medoid = cell_graph(x, members, rng)
            graph[members[:, None], used[members][:, None] * DEGREE + np.arange(DEGREE)] = links
            used[members] += 1
            medoids.append(medoid)
    return graph, np.unique(medoids)


def shard_pairs(x, threshold, seed=11):
    """Yields (query indices, mask of their links) of a shard, verified."""
    rng = np.random.default_rng(seed)
    n = len(x)

    def apart(rows, good):
        good[np.arange(len(rows)), rows] = False
        return rows, good

    graph, medoids = flat_graph(x, rng)
    beam = BEAM
    audit = rng.choice(n, min(n, AUDIT), replace=False)
    truth = x[audit] @ x.T >= threshold
    for _ in range(4):
        got = search(x, graph, audit, medoids, beam, threshold - 1e-9) & truth
        if got.sum() >= RECALL * truth.sum():
            break
        beam *= 2
    else:  # the graph doesn't lead to them
        for a in range(0, n, 256):
            rows = np.arange(a, min(n, a + 256))
            yield apart(rows, x[rows] @ x.T >= threshold)
        return
    mask = np.zeros((n, n), bool)
    for a in range(0, n, 256):
        rows = np.arange(a, min(n, a + 256))
        mask[rows] = search(x, graph, rows, medoids, beam, threshold - 1e-9)
    mask |= mask.T
    for a in range(0, n, 256):
        rows = np.arange(a, min(n, a + 256))
        r, c = np.nonzero(mask[rows])
        good = np.zeros((len(rows), n), bool)
        for k in range(0, len(r), 1 << 16):  # verified in double precision
            i, j = r[k : k + (1 << 16)], c[k : k + (1 << 16)]
            good[i, j] = np.einsum("kd,kd->k", x[rows[i]], x[j]) >= threshold
        yield apart(rows, good)


# ------------------------------------------------------------------ the shards


def _unit(column: pa.Array):
    """(usable, unit vectors or None) of an array column."""
    out = []
    for v in column.to_pylist():
        u = None
        if v and None not in v:
            a = np.array(v, np.float64)
            if np.isfinite(a).all() and (norm := np.abs(a).max()) > 0:
                a = a / norm
                u = a / np.sqrt(a @ a)
        out.append(u)
    return out


def nearest(x: np.ndarray, c: np.ndarray, m: int) -> np.ndarray:
    """[vectors, m] numbers of the nearest centres, the nearest first."""
    return np.argsort(-(x @ c.T), axis=1, kind="stable")[:, :m]


def overlap_needed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The overlap at which pairs, given by both sides' nearest centres, first share
    a shard; one more than the lists are long where they never do."""
    rank = np.maximum(*np.indices((a.shape[1], b.shape[1]))) + 1
    out = np.full(len(a), a.shape[1] + 1)
    for k in range(0, len(a), 4096):
        same = a[k : k + 4096, :, None] == b[k : k + 4096, None, :]
        out[k : k + 4096] = np.where(same, rank, a.shape[1] + 1).min((1, 2))
    return out


def overlap_of(seen: np.ndarray, made: np.ndarray, k: int) -> int | None:
    """Smallest overlap that holds ``RECALL`` of the links. seen[query, o] counts links of
    the sampled vectors that need overlap o; made: what made pairs at the
    threshold need. None if no overlap is enough or one shard costs less."""
    linked = seen[seen.sum(1) > 0]
    for m in range(OVERLAP, seen.shape[1] - 1):
        if m * m >= k:  # m shards a vector, each m times as large
            return None
        share = linked[:, : m + 1].sum(1) / linked.sum(1)
        held = not len(linked) or (share.mean() >= RECALL and linked[:, : m + 1].sum() >= RECALL * linked.sum())
        if held and (len(linked) >= EVIDENCE or (made <= m).mean() >= RECALL):
            return m
    return None


def centres(vectors: DataFrame, threshold: float) -> dict[tuple, tuple[np.ndarray, int]]:
    """Centres and overlap of labels that need more than one shard. Centres are from
    a bounded sample: farthest points first, none within linking range of another."""
    sizes = vectors.groupBy("label", "d").count().where(F.col("count") > SHARD)
    sample = vectors.join(sizes, ["label", "d"]).orderBy(F.xxhash64("row")).limit(SAMPLE).select("label", "d", "row", "unit", "count").collect()
    groups: dict[tuple, list] = {}
    for r in sample:
        groups.setdefault((r.label, r.d), []).append(r)
    out, audit = {}, {}
    for key, rows in groups.items():
        x = np.stack([np.frombuffer(r.unit) for r in rows])
        want = -(-rows[0]["count"] // SHARD)
        picked, reach = [int(np.argmin(x @ x.mean(0)))], None
        while True:
            near = x @ x[picked[-1]]
            reach = near if reach is None else np.maximum(reach, near)
            far = int(np.argmin(reach))
            if len(picked) >= want or reach[far] >= threshold:
                break
            picked.append(far)
        if len(picked) > OVERLAP:  # fewer would put every vector into every shard
            out[key] = x[picked]
            asked = x[:QUERIES]
            audit[key] = (x[picked], np.array([r.row for r in rows[:QUERIES]]), asked, nearest(asked, x[picked], WIDEST))
    if not out:
        return {}
    sent = vectors.sparkSession.sparkContext.broadcast(audit)

    def asked_of_all(batches):
        """Links of the sampled vectors with all of their label, by overlap needed."""
        audit = sent.value
        seen = {key: np.zeros((len(held[1]), WIDEST + 2), np.int64) for key, held in audit.items()}
        for batch in batches:
            row = batch.column(0).to_numpy()
            label, d, unit = (batch.column(c).to_pylist() for c in (1, 2, 3))
            at: dict[tuple, list] = {}
            for i, key in enumerate(zip(label, d)):
                if key in audit:
                    at.setdefault(key, []).append(i)
            for key, found in at.items():
                c, asked_row, asked, asked_near = audit[key]
                x = np.stack([np.frombuffer(unit[i]) for i in found])
                i, q = np.nonzero((x @ asked.T >= threshold) & (row[found][:, None] != asked_row))
                hit, i = np.unique(i, return_inverse=True)
                need = overlap_needed(nearest(x[hit], c, WIDEST)[i], asked_near[q])
                np.add.at(seen[key], (q, np.minimum(need, WIDEST + 1)), 1)
        for (label, d), counts in seen.items():
            q, o = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(q), pa.string()), pa.array([d] * len(q), pa.int32()), pa.array(q.astype(np.int32)), pa.array(o.astype(np.int32)), pa.array(counts[q, o])], ["label", "d", "q", "o", "n"])

    links = vectors.select("row", "label", "d", "unit").mapInArrow(asked_of_all, "label string, d int, q int, o int, n long").groupBy("label", "d", "q", "o").agg(F.sum("n").alias("n")).collect()
    sent.unpersist()
    seen = {key: np.zeros((len(audit[key][1]), WIDEST + 2), np.int64) for key in out}
    for r in links:
        seen[r.label, r.d][r.q, r.o] = r.n
    dealt = {}
    for key, c in out.items():
        asked, asked_near = audit[key][2:]
        aside = np.random.default_rng(7).normal(size=asked.shape)
        aside -= (aside * asked).sum(1, keepdims=True) * asked
        aside /= np.maximum(np.sqrt((aside * aside).sum(1, keepdims=True)), 1e-300)
        made = threshold * asked + np.sqrt(max(0.0, 1 - threshold**2)) * aside
        m = overlap_of(seen[key], overlap_needed(nearest(made, c, WIDEST), asked_near), len(c))
        if m is not None:
            dealt[key] = (c, m)
    return dealt


def near_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row."""
    spark = embeddings.sparkSession

    def units(batches):
        for batch in batches:
            u = _unit(batch.column(3))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([None if v is None else len(v) for v in u], pa.int32()), pa.array([None if v is None else v.tobytes() for v in u], pa.binary())], ["row", "vec_id", "label", "d", "unit"])

    rows = embeddings.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v"))
    rows = stored(rows.mapInArrow(units, "row long, vec_id long, label string, d int, unit binary"), "vectors")
    kind = ["label", "d", "unit"]
    vectors = rows.where("label is not null and unit is not null").groupBy(*kind).agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("vec_id").alias("least_id"))
    vectors = stored(vectors, "vector-kinds")
    sent = spark.sparkContext.broadcast(centres(vectors, threshold))

    def assigned(batches):
        for batch in batches:
            label, d, unit = (batch.column(c).to_pylist() for c in (1, 2, 3))
            shards = []
            for key in zip(label, d, unit):
                c, m = sent.value.get(key[:2], (None, 0))
                shards.append([0] if c is None else sorted(nearest(np.frombuffer(key[2])[None], c, m)[0].tolist()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int32()))], ["row", "label", "d", "unit", "copies", "shards"])

    dealt = stored(vectors.select("row", *kind, "copies").mapInArrow(assigned, "row long, label string, d int, unit binary, copies long, shards array<int>").withColumn("shard", F.explode("shards")), "vector-shards")
    split = dealt.groupBy("label", "d", "shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("m"))
    own = F.pmod(F.xxhash64("row"), F.col("m").cast("long")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda k: F.struct(F.least(k, F.col("own")).alias("i"), F.greatest(k, F.col("own")).alias("j")))
    blocks = dealt.join(split, ["label", "d", "shard"]).withColumn("own", own).withColumn("p", F.explode(others)).select("label", "d", "shard", "p.i", "p.j", "own", "row", "unit", "copies", "shards")

    def linked(group: pa.Table) -> pa.Table:
        order = np.argsort(group["row"].to_numpy())
        row, own, copies = (group[c].to_numpy()[order] for c in ("row", "own", "copies"))
        x = np.stack([np.frombuffer(u) for u in group["unit"].to_pylist()])[order]
        held = group["shards"].to_pylist()
        width = max(map(len, held))
        shards = np.array([s + [-1] * (width - len(s)) for s in held])[order]
        shard, across = group["shard"][0].as_py(), group["i"][0].as_py() != group["j"][0].as_py()
        links = np.zeros(len(row), np.int64)
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for q, good in shard_pairs(x, threshold):
            for s in range(width):  # the pair counts in its smallest common shard alone
                mine = shards[q, s]
                other = np.isin(mine, [-1, *range(shard, shard + 1)]) | (mine > shard)
                good &= ~((shards[None, :, :] == mine[:, None, None]).any(2) & ~other[:, None])
            if across:
                good &= own[q][:, None] != own[None, :]
            links[q] += good @ copies
            r, c = np.nonzero(good)
            if len(r):
                node, root = forest(np.concatenate([row[q[r]], left]), np.concatenate([row[c], right]))
                left, right = node[node != root], root[node != root]
        has = links > 0
        return pa.table({"a": pa.array(np.concatenate([row[has], left])), "b": pa.array(np.concatenate([row[has], right])), "links": pa.array(np.concatenate([links[has], np.zeros(len(left), np.int64)]))})

    found = stored(blocks.groupBy("label", "d", "shard", "i", "j").applyInArrow(linked, "a long, b long, links long"), "vector-links")
    links = found.where("links > 0").groupBy(F.col("a").alias("row")).agg(F.sum("links").alias("n_links"))
    joined = components(found.where("links = 0").select("a", "b")).withColumnRenamed("node", "row")
    named = vectors.join(links, "row", "left").join(joined, "row", "left").withColumn("component", F.coalesce("component", "row"))
    named = stored(named.withColumn("n_links", F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).select(*kind, "least_id", "n_links", "component"), "vector-components")
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "component").select(*kind, "n_links", "component_id", F.lit(True).alias("usable"))
    component_id = F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("vec_id"))
    return rows.join(named, kind, "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"), F.coalesce(F.col("vec_id") == component_id, F.lit(False)).alias("kept"))

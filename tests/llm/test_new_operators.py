"""Conversation repair, periodic runs and document fingerprints against brute force,
on small tables with nulls, empty and long texts, ties, repeated rows, extra columns
with clashing names, and on empty tables."""

import collections
import functools
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from stockcast.llm import conversation_repair as repair
from stockcast.llm import fingerprints, periodic_runs

SPACE = r"[\x20\x09-\x0D]"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture
def cut_in(spark):
    """Sets a number of shuffle partitions that Spark keeps."""
    names = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = [spark.conf.get(n) for n in names]

    def cut(parts):
        spark.conf.set(names[0], str(parts))
        spark.conf.set(names[1], "false")

    yield cut
    for name, value in zip(names, before):
        spark.conf.set(name, value)


# ---------------------------------------------------------------- conversation repair


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        words = re.sub(SPACE, "", text)
        out.append("blank" if not words else "duplicate" if (role, text) in seen else "truncated" if words[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


LEGAL = re.compile(r"(s?(ua)+)?")


def cheapest(rows, found):
    """(cost, audit, repaired) by trying every legal role sequence (short conversations)."""
    best = None
    top = 2 * len(rows) + 2
    targets = [""] + ["".join(p) + "ua" * k for k in range(1, top // 2 + 1) for p in ("", "s")]
    for target in targets:
        @functools.lru_cache(None)
        def tail(i, j):
            """(cost, audit, lines) of the cheapest way to write target[j:] from rows[i:]."""
            if i == len(rows) and j == len(target):
                return 0, "", ()
            ways = []
            if j < len(target) and target[j] in "ua":
                role = {"u": "user", "a": "assistant"}[target[j]]
                if rest := tail(i, j + 1):
                    ways.append((rest[0] + 3, "I" + rest[1], (f"{role}:", *rest[2])))
            if i < len(rows):
                if rest := tail(i + 1, j):
                    ways.append((rest[0] + 4, "D" + rest[1], rest[2]))
                if j < len(target) and found[i] not in ("blank", "duplicate") and (rest := tail(i + 1, j + 1)):
                    extra = 3 if found[i] == "truncated" else 0
                    if rows[i][2][:1] == target[j]:
                        ways.append((rest[0] + extra, "K" + rest[1], (f"{rows[i][2]}:{rows[i][3]}", *rest[2])))
                    if target[j] in "ua":
                        role = {"u": "user", "a": "assistant"}[target[j]]
                        ways.append((rest[0] + 3 + extra, "R" + rest[1], (f"{role}:{rows[i][3]}", *rest[2])))
            return min(ways) if ways else None

        way = tail(0, 0)
        best = way if best is None or (way and way < best) else best
    return best


def expected(turns):
    by = collections.defaultdict(list)
    for conv in {r[0] for r in turns}:
        by[conv] = []
    for r in damaged([r[:4] for r in turns]):
        by[r[0]].append(r)
    out = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        known = [r[1] for r in rows if r[1] is not None]
        found = faults(rows)
        cost, audit, lines = cheapest(tuple(rows), found)
        initials = [r[2][:1] for r in rows]
        out[conv] = (
            max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(found.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, sha("\n".join(lines)),
        )
    return out


def conversations():
    rng = random.Random(11)
    texts = ["Hello.", "hello", " ", "", None, "\t\n", "Why?", "go on", "Yes!  \n", "line\nline two.", "à bientôt。", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "tool", "", "User"]
    rows = []
    for conv in range(260):
        n = rng.randrange(0, 8)
        for turn in range(n):
            role = rng.choice(roles) if conv % 3 else ("user", "assistant")[turn % 2]
            rows.append((conv, turn + (turn > 3) * 2, role, rng.choice(texts), turn, "extra"))
    rows += [(None, k, ("user", "assistant")[k % 2], "Well.", 0, None) for k in range(4)]
    rows += [(900, None, "user", "One.", 0, None), (900, None, "assistant", "Two.", 0, None), (900, 3, "user", "Three", 0, None)]
    rows += [(901, 1, "user", "Same turn.", 0, None), (901, 1, "assistant", "Same turn.", 0, None), (901, 1, "assistant", "And again", 0, None)]
    rows += [rows[k] for k in range(0, 60, 7)]  # repeated rows
    return rows


KIND = "conv_id long, turn long, role string, text string, seq int, digest string"


def collected(frame):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in frame.collect()}


def test_conversation_repair(spark):
    turns = conversations()
    frame = spark.createDataFrame(turns, KIND).repartition(5)
    got = collected(repair.repair(repair.damaged(frame), frame))
    assert got == expected(turns)


@pytest.mark.parametrize("modulus", [repair.Node.MODULUS, 7, 1])
def test_audit_dp_breaks_ties_whatever_the_hashes(monkeypatch, modulus):
    monkeypatch.setattr(repair.Node, "MODULUS", modulus)  # small ones make collisions
    repair._short_audits.cache_clear()
    rng = random.Random(modulus)
    code = {"blank": "b", "duplicate": "d", "truncated": "t", None: "-"}
    for _ in range(250):
        n = rng.randrange(1, 8)
        rows = tuple((0, k, rng.choice(["system", "user", "assistant", "tool"]), f"t{k}") for k in range(n))
        found = [rng.choice([None, None, "truncated", "blank", "duplicate"]) for _ in range(n)]
        want = cheapest(rows, found)
        initials, marks = "".join(r[2][0] for r in rows), "".join(code[f] for f in found)
        cuts = sorted({0, n, *(rng.randrange(n + 1) for _ in range(3))})
        pieces = [(initials[a:b], marks[a:b]) for a, b in zip(cuts, cuts[1:])]
        cost, chosen = repair.conversation_audit(pieces)
        assert (cost, "".join(a for _, a in chosen)) == want[:2]
    repair._short_audits.cache_clear()


def test_a_long_conversation_is_cut_into_slices(spark, cut_in):
    cut_in(8)
    rng = random.Random(5)
    turns = [(1, k, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "no", f"Turn {k}.", f"turn {k}"])) for k in range(3000)]
    turns += [(2, 0, "user", "Hi."), (2, 1, "assistant", "Ho.")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(4)
    rows = repair.sliced(frame)
    assert rows.where("conv_id = 1").select("slice").distinct().count() > 1
    codes = repair.coded(rows)
    one = repair.audits(codes).where("conv_id = 1").first()
    ordered = [(1, t, r, x) for _, t, r, x in turns[:3000]]
    marks = "".join({"blank": "b", "duplicate": "d", "truncated": "t", None: "-"}[f] for f in faults(ordered))
    whole = repair.conversation_audit([("".join(r[2][0] for r in ordered), marks)])
    assert (one.cost, one.audit) == (whole[0], whole[1][0][1])
    # the same by a table of whole strings
    cells = {0: (0, "")}
    def put(cells, state, way):
        if state not in cells or way < cells[state]:
            cells[state] = way
    def widened(cells):
        cells = dict(cells)
        for _ in range(3):
            for state, (c, a) in list(cells.items()):
                put(cells, repair.NEXT[state][0], (c + 3, a + "I"))
        return cells
    for r, f in zip(ordered, marks):
        new = {}
        for state, (c, a) in widened(cells).items():
            put(new, state, (c + 4, a + "D"))
            if f in "t-":
                extra = 3 if f == "t" else 0
                if (state, r[2][0]) in repair.STEP:
                    put(new, repair.STEP[state, r[2][0]], (c + extra, a + "K"))
                put(new, repair.NEXT[state][0], (c + extra + 3, a + "R"))
        cells = new
    cells = widened(cells)
    assert (one.cost, one.audit) == min(cells[0], cells[3])
    got = collected(repair.repair(frame))
    pieces, it = [], iter(ordered)
    state = 0
    for e in one.audit:
        if e == "I":
            state, role = repair.NEXT[state]
            pieces.append(f"{role}:")
            continue
        row = next(it)
        if e == "R":
            state, role = repair.NEXT[state]
            pieces.append(f"{role}:{row[3]}")
        elif e == "K":
            state = repair.STEP[state, row[2][0]]
            pieces.append(f"{row[2]}:{row[3]}")
    assert got[1][-1] == sha("\n".join(pieces)) and got[2][-3:] == (0, "KK", sha("user:Hi.\nassistant:Ho."))
    text = repair.repaired_text(rows, repair.edits(codes, repair.audits(codes))).where("conv_id = 1").orderBy("place").collect()
    assert "".join(r.text for r in text) == "\n".join(pieces) + "\n"


# ---------------------------------------------------------------- periodic runs


def all_runs(w):
    """(start, length, period) of every run, by trying every period."""
    n, out = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                s = w[i : i + length]
                if not any(all(s[k] == s[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.add((i, length, q))
            i = max(j, i + 1) if j > i else i + 1
    return sorted(out)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def tail(doc_id, w):
    n = len(w)
    if doc_id is None or not n:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def run_row(doc_id, text):
    w = tail(doc_id, words_of(text))
    runs = all_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def texts():
    rng = random.Random(12)
    some = lambda n, k: " ".join(rng.choice("abcdefghij"[:k]) for _ in range(n))
    out = [None, "", " \t\n", "one", "a a a a a", "a a a a a a", "A a A a A a A a", "x a a a a a a a y", "déjà vu\n" * 9, "\x1c\x85 \xa0 " * 8]
    out += [some(rng.randrange(0, 60), rng.randrange(1, 5)) for _ in range(150)]
    out += [some(20, 9) + " " + " ".join([some(m, 10)] * k) + " " + some(20, 9) for m in (1, 2, 3, 5, 8, 13, 31) for k in (2, 3, 4, 5, 9)]
    nested = " ".join(["b a a a a a a a"] * 5)  # runs inside a run
    out += [nested, f"{nested} c {nested} c {nested} c {nested} c", "z " * 3000, some(900, 8), " ".join(f"w{k}" for k in range(700))]
    return out


def test_periodic_runs(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(texts())]
    rows += [(None, "a b " * 6), (5, "a a a a a a"), (5, "a a a a a a")]
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, runs int, collapsed string").repartition(3)
    got = periodic_runs.run_digests(periodic_runs.periodic_runs(frame, damage=periodic_runs.repeated_tail)).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(run_row(*r) for r in rows)


def test_periodic_runs_over_several_texts_at_once():
    rng = random.Random(2)
    for _ in range(400):
        parts = [[rng.choice("abc") for _ in range(rng.randrange(0, 40))] for _ in range(4)]
        parts.append(parts[0] * 4)
        first = np.cumsum([0, *map(len, parts)])
        words = np.array([ord(c) for p in parts for c in p], np.uint64)
        assert periodic_runs.find_runs(words, first) == [(t, *r) for t, p in enumerate(parts) for r in all_runs(p)]


def test_one_run_is_extended_once(monkeypatch):
    calls = []
    reach = periodic_runs._reach
    monkeypatch.setattr(periodic_runs, "_reach", lambda a, b: calls.append(1) or reach(a, b))
    words = np.array([k % 7 for k in range(70_000)], np.uint64)
    assert periodic_runs.find_runs(words, np.array([0, 70_000])) == [(0, 0, 70_000, 7)]
    assert len(calls) <= 4


# ---------------------------------------------------------------- fingerprints


def grams(text):
    w = [x.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for x in words_of(text)]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def jaccard(a, b):
    a, b = grams(a), grams(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def documents():
    rng = random.Random(13)
    some = lambda n: " ".join(rng.choice(["le", "und", "The", "漢字", "😀", "x"]) + str(rng.randrange(300)) for _ in range(n))
    base = some(400)
    out = [None, "", "\n ", "one", "one two", base, base, base.upper(), base + " " + some(40), some(9000)]
    return out + [some(rng.randrange(0, 600)) for _ in range(120)]


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_fingerprints_of_edits(spark, cut_in, parts):
    rows = [(3 * i - 7, t) for i, t in enumerate(documents())]
    frame = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, print string, place string").repartition(4)
    cut_in(parts)
    got = {r.doc_id: r for r in fingerprints.with_edits(frame).collect()}
    assert len(got) == len(rows)
    off, of_print = [], {}
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1]):
        t, u = t or "", u or ""
        cut = len(t) // 4
        changed = t[: len(t) - cut] + u[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(changed))
        assert of_print.setdefault(t, r.fingerprint) == r.fingerprint
        off += [r.near_edited - jaccard(t, changed), r.near_next - jaccard(t, u)]
        if not cut:
            assert r.near_edited == 1.0 and r.fingerprint == r.edited_fingerprint
    assert abs(np.mean(off)) < 0.02 and np.sqrt(np.mean(np.square(off))) < 0.05 and np.abs(off).max() < 0.25
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(frame).collect()}
    assert plain == {i: r.fingerprint for i, r in got.items()}


def test_fingerprints_of_repeated_and_missing_ids(spark):
    rows = [(None, "a b c d e f g h"), (1, "a b c d e f"), (1, "a b c d e f"), (1, None), (None, None)]
    got = fingerprints.with_edits(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.n_chars) for r in got) == collections.Counter((i, len(t or "")) for i, t in rows)
    alone = fingerprints.with_edits(spark.createDataFrame([(4, "alone in the world it is")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == sha("alone in the world" + "alone ")


def test_densification_keeps_the_estimate_for_small_sets():
    rng = np.random.default_rng(4)
    off = []
    for size in (3, 10, 40, 150):
        for _ in range(150):
            pool = rng.integers(0, 1 << 64, 2 * size, dtype=np.uint64)
            a, b = np.sort(pool[: int(1.5 * size)]), np.sort(pool[size // 2 :])
            off.append(fingerprints.likeness(fingerprints.packed(a), fingerprints.packed(b)) - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
    assert abs(np.mean(off)) < 0.02


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert repair.repair(repair.damaged(turns), turns).count() == 0
    assert periodic_runs.run_digests(periodic_runs.periodic_runs(docs)).count() == 0
    assert fingerprints.with_edits(docs).count() == 0 and fingerprints.fingerprints(docs).count() == 0

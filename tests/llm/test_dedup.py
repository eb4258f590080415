"""Exact copies, Jaccard groups and repeated passages against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strataq.llm import common, exact_dedup, jaccard, repeats

SCHEMA = "doc_id long, text string, n_chars long, b string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 0, "x") for i, t in rows], SCHEMA)


EDGES = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "A"), (None, "a"), (5, "word " * 3000), (6, "word " * 3000), (7, "b c"), (8, "B  c")]


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda t: F.unhex(F.lit("00"))])
@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(spark, digest, keep):
    got = exact_dedup.exact_dedup(frame(spark, EDGES), keep=keep, digest=digest, memtable_rows=3).collect()
    assert len(got) == len(EDGES)
    by = {}
    for i, t in EDGES:
        by.setdefault(t or "", []).append(i)
    best = min if keep == "smallest" else max
    want = sorted((i, best(x for x in ids if x is not None), len(ids)) for ids in by.values() for i in ids if i is not None)
    assert sorted((r.id, r.keep_id, r.group_size) for r in got if r.id is not None) == want
    assert sum(r.kept for r in got) == len(by)
    assert all(r.id == r.keep_id for r in got if r.kept)


def test_drop_copies(spark):
    out = exact_dedup.drop_copies(frame(spark, EDGES))
    assert out.columns == ["doc_id", "text", "n_chars", "b"]
    assert sorted(r.doc_id for r in out.collect()) == [1, 3, 4, 5, 7, 8]
    assert exact_dedup.drop_copies(frame(spark, [])).count() == 0


def test_sums_meet_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(common, "FAN", 3)
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1000, (2, 23, 5)).astype(np.float32)
    rows = [(piece, part, x[piece, part].tobytes()) for piece in range(2) for part in range(23)]
    parts = common.stash(spark, spark.createDataFrame(rows, "piece int, part int, sums binary"), "parts")
    got = common.sum_tables(parts, np.float32)
    assert all(np.array_equal(got[k], x[k].astype(float).sum(0)) for k in range(2)) and common.sum_tables(parts.limit(0)) == {}


def test_mark_maybe(spark):
    keys = common.stash(spark, spark.range(0, 3000, 3).select("id"), "keys")
    table = spark.range(0, 20_000).select(F.when(F.col("id") < 19_000, F.col("id")).alias("k"), "id")
    got = common.mark_maybe(table, keys, {"may": "k"}).collect()
    assert len(got) == 20_000 and all(r.may for r in got if r.id < 3000 and r.id % 3 == 0) and not any(r.may for r in got if r.k is None)
    assert sum(r.may for r in got) < 1000 + 0.15 * 18_000
    assert not any(r.may for r in common.mark_maybe(table.limit(50), common.stash(spark, spark.range(0), "none"), {"may": "k"}).collect())


@pytest.mark.parametrize("one_task", [0, 60, 1 << 17])
def test_components(spark, one_task, monkeypatch):
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(-40, 40)] + [(rng.randrange(100, 300), rng.randrange(100, 300)) for _ in range(120)] + [(500, 500), (7, 3), (3, 7), (3, 7)]
    label = {n: n for ab in links for n in ab if ab[0] != ab[1]}
    while (now := {n: min([label[n]] + [label[b if a == n else a] for a, b in links if n in (a, b) and a != b]) for n in label}) != label:
        label = now
    written, real = [], common.stash
    monkeypatch.setattr(common, "stash", lambda s, df, what: written.append(what) or real(s, df, what))
    got = common.components(spark, spark.createDataFrame(links, "a long, b long"), one_task).collect()
    assert sorted((r.node, r.component) for r in got) == sorted(label.items())
    # a graph that fits in one task is one step, not a dozen of written tables
    assert one_task < len(links) or written == ["edges", "hooks"]
    assert common.components(spark, spark.createDataFrame([(1, 1)], "a long, b long"), one_task).count() == 0


def test_a_root_of_two_blocks_counts_once():
    s = np.arange(9, dtype=np.uint64).tobytes()
    batch = pa.RecordBatch.from_arrays([pa.array([1, 1, 2, 2], pa.int64()), pa.array([5] * 4, pa.int64()), pa.array([2] * 4, pa.int64()), pa.array([0] * 4, pa.int64()), pa.array([s] * 4, pa.binary())],
                                       names=["id", "mh", "nb", "block", "tokens"])
    out = [(r["id"], r["root"], r["tokens"]) for b in jaccard._group_blocks(80)([batch]) for r in b.to_pylist()]
    assert out == [(1, 1, s), (2, 1, None)]


def test_unstash(spark):
    one = common.stash(spark, spark.range(5), "one")
    two = common.stash(spark, one.where("id > 1"), "two")
    common.unstash(one)
    assert two.count() == 3
    with pytest.raises(Exception, match="one"):
        spark.read.parquet(one.stashed)


def plain_index(rows):
    """digest: n, least, most, by brute force."""
    out = {}
    for i, t in rows:
        d = hashlib.sha256((t or "").encode()).digest()
        n, lo, hi = out.get(d, (0, None, None))
        out[d] = (n + 1, i if lo is None else lo if i is None else min(lo, i), i if hi is None else hi if i is None else max(hi, i))
    return out


def state(index):
    return {bytes(r.digest): (r.n, r.least, r.most) for r in index.merged().collect()}


def test_index_append_equals_rebuild(spark):
    """Batches go into runs that are merged level by level; the outcome is that of one build over all rows."""
    rng = random.Random(6)
    batches = [[(rng.randrange(500), f"text {rng.randrange(60)}") for _ in range(n)] for n in (40, 1, 90, 0, 25, 60)] + [EDGES]
    index, every = exact_dedup.DigestIndex(spark, memtable_rows=8, fanout=3), []
    for rows in batches:
        index.append(exact_dedup.digests_of(frame(spark, rows)))
        every += rows
        assert all(sum(len(x.runs) for x in index.levels if x.depth == d) < 3 for d in {x.depth for x in index.levels})
        got = {bytes(r.digest): (r.n, r.least, r.most) for r in index.lookup(exact_dedup.digests_of(frame(spark, every))).collect()}
        assert got == plain_index(every)
    assert max(x.depth for x in index.levels) > 1 and len(index.slots) == len(batches)
    assert len({r.slot for x in index.slots for r in x.collect()}) == len(every)
    built = exact_dedup.build_index(frame(spark, every), memtable_rows=1000)
    assert state(index) == state(built) == plain_index(every) and len(index.levels) == 1 and len(index.levels[0].runs) == 1
    empty = exact_dedup.build_index(frame(spark, []))
    assert empty.merged() is None and empty.lookup(exact_dedup.digests_of(frame(spark, every))).count() == 0


def test_runs_are_sorted_and_filters_skip_them(spark):
    rows = [(k, f"text {k}") for k in range(400)]
    index = exact_dedup.DigestIndex(spark, memtable_rows=16, fanout=1000).append(exact_dedup.digests_of(frame(spark, rows)))
    [level] = index.levels
    assert len(level.runs) >= 25 and level.bits >= 10 * 16
    asked = exact_dedup.digests_of(frame(spark, rows[:10] + [(9000 + k, f"another {k}") for k in range(300)]))
    visits = index.visits(asked, level).collect()
    own = {bytes(r.digest): r.run for r in level.rows.collect()}
    met = [(r.run, bytes(r.digest)) for r in visits]
    assert all((own[hashlib.sha256(t.encode()).digest()], hashlib.sha256(t.encode()).digest()) in met for _, t in rows[:10])
    assert len(met) < 10 + 0.02 * 300 * len(level.runs)  # of all pairs of a digest and a run, few beyond the true ones
    merged = exact_dedup.DigestIndex(spark, memtable_rows=16, fanout=4).append(exact_dedup.digests_of(frame(spark, rows)))
    for x in merged.levels:
        for r in x.runs:
            for part in x.rows.where(f"run = {r}").select("digest").rdd.glom().map(lambda p: [bytes(q.digest) for q in p]).collect():
                assert part == sorted(part)


def near(seed=1):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    rows, n = [], 0
    for base in range(6):
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(14):
            t = list(text)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(60)] = rng.choice(words)
            rows.append((n, " ".join(t)))
            n += 3
    return rows + [(1000, None), (1001, ""), (1002, "one two"), (1003, "ONE\ttwo"), (1004, "one two three four five"), (None, "one two"), (1005, "the same " * 2000), (1005, "the same " * 2000)]


def brute_components(rows):
    sets, par = {}, {}
    for i, t in rows:
        if i is None:
            continue
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets[i] = {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        par[i] = i

    def find(a):
        while par[a] != a:
            a = par[a]
        return a

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                par[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block", [256, 3])
def test_jaccard(spark, block, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "QUERIES", 2 if block == 3 else 1024)
    rows = near()
    got = jaccard.jaccard_components(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = brute_components(rows)
    assert {r.id: (r.n_shingles, r.component_id) for r in got if r.id is not None} == want
    assert [(r.n_shingles, r.component_id) for r in got if r.id is None] == [(1, 1002)]


def test_jaccard_bound_and_empty(spark):
    assert jaccard.jaccard_components(frame(spark, [])).count() == 0
    kept = jaccard.keep_one_of_each(frame(spark, near()))
    want = brute_components(near())
    assert sorted(r.doc_id for r in kept.select("doc_id").distinct().where("doc_id is not null").collect()) == sorted({c for _, c in want.values()})


def test_keep_one_judges_texts_that_share_an_identifier(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    kept = jaccard.keep_one_of_each(frame(spark, [(1, a), (2, a + " more"), (2, b), (3, b.upper()), (None, a), (None, "alone it stands here today"), (None, None), (4, "")]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(1, a), (2, b), (None, "alone it stands here today"), (None, None), (4, "")], key=str)


def brute_repeats(rows, n, keep):
    texts = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    first, count, out = {}, {}, {}
    for k in order:
        for p in range(len(texts[k]) - n + 1):
            w = texts[k][p:p + n]
            first.setdefault(w, (k, p))
            count[w] = count.get(w, 0) + 1
    for k, b in enumerate(texts):
        gone = set()
        for p in range(len(b) - n + 1):
            w = b[p:p + n]
            if count[w] > 1 and (keep == "none" or first[w] != (k, p)):
                gone.update(range(p, p + n))
        kept = bytes(x for q, x in enumerate(b) if q not in gone)
        out[rows[k][0]] = (len(b), len(gone), sum(q - 1 not in gone for q in gone), hashlib.sha256(kept).hexdigest())
    return out


def passages():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(2, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    shared = [text(40) for _ in range(3)]
    rows = []
    for k in range(24):
        parts = [text(rng.randrange(1, 30))]
        for _ in range(rng.randrange(3)):
            s = rng.choice(shared)
            a = rng.randrange(40)
            parts += [s[a:a + rng.randrange(60, 200)], text(rng.randrange(1, 20))]
        rows.append((k, " ".join(parts)))
    return rows + [(90, None), (91, ""), (92, "ab" * 300), (93, rows[0][1]), (94, "short")]


def test_longest_previous_factors():
    rng = np.random.default_rng(8)
    for least in (1, 3, 6):
        for n in (0, 1, 2, 40, 90):
            w = rng.integers(97, 99, (n, 6)).astype(np.uint8)
            factor, source = repeats.longest_previous_factors(w, least)
            shared = lambda a, b: next((k for k in range(6) if a[k] != b[k]), 6)
            for k in range(n):
                best = max((shared(w[k], w[j]) for j in range(k)), default=0)
                assert factor[k] == (best if best >= least else 0)
                assert source[k] < k and (source[k] == -1) == (best < least)
                assert source[k] == -1 or shared(w[k], w[source[k]]) == best


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("most", [8192, 2])
def test_repeats(spark, keep, most):
    rows = passages()
    got = repeats.remove_repeats(frame(spark, rows), length=80, keep=keep, most=most).collect()
    assert {r.id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == brute_repeats(rows, 80, keep)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def batch_of(texts):
    return pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array([0] * len(texts), pa.int64()), pa.array(texts, pa.string())], names=["id", "k", "text"])


def test_runs_cover_every_start_once(monkeypatch):
    """Also where long texts are cut in pieces; equal windows have equal anchors at equal offsets."""
    texts = [t for _, t in passages()] + ["ab" * 900]
    for piece in (1 << 20, 37):
        monkeypatch.setattr(repeats, "PIECE", piece)
        anchor_of = {}
        seen = set()
        for out in repeats._emit_runs(80)(iter([batch_of(texts)])):
            for r in out.to_pylist():
                b = (texts[r["id"]] or "").encode()
                assert len(r["ctx"]) == 16
                for s in range(r["n"]):
                    w = b[r["p"] + s: r["p"] + s + 80]
                    assert len(w) == 80 and (r["id"], r["p"] + s) not in seen
                    seen.add((r["id"], r["p"] + s))
                    assert anchor_of.setdefault(w, (r["anchor"], r["off"] - s)) == (r["anchor"], r["off"] - s)
        assert seen == {(k, p) for k, t in enumerate(texts) for p in range(len((t or "").encode()) - 79)}


def test_long_text_in_bounded_memory():
    """A text of 64 MB: what is held beside the text itself."""
    text = np.random.default_rng(1).integers(97, 123, 64 << 20).astype(np.uint8).tobytes().decode()
    batch = batch_of([text])
    tracemalloc.start()
    starts = sum(int(np.sum(out.column(3).to_numpy())) for out in repeats._emit_runs(400)(iter([batch])))
    emitted = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    picks = [[{"p": p, "spans": [0, 100]} for p in range(0, 60 << 20, 1 << 16)]]
    kind = pa.list_(pa.struct([("p", pa.int64()), ("spans", pa.list_(pa.int32()))]))
    rows = pa.RecordBatch.from_arrays([pa.array([1]), batch.column(2), pa.array(picks, kind)], names=["id", "text", "picks"])
    [out] = list(repeats._remove(400, False)(iter([rows])))
    removed = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert starts == (64 << 20) - 399 and emitted < 400 << 20 and removed < 400 << 20
    assert out.to_pylist()[0]["n_removed"] == 960 * 499 and out.to_pylist()[0]["n_spans"] == 960


def test_digests_alone_remove_nothing():
    """Of two windows of one digest the arrays decide: other bytes are no repeat."""
    rows = pa.RecordBatch.from_arrays([pa.array([b"a", b"a", b"b", b"b", b"c"], pa.binary()), pa.array([0, 1, 0, 1, 0], pa.int32()),
                                       pa.array([b"x" * 80, b"x" * 79 + b"y", b"z" * 80, b"z" * 80, b"q" * 80], pa.binary())], names=["w", "last", "bytes"])
    assert [r["w"] for out in repeats._confirm(80)(iter([rows])) for r in out.to_pylist()] == [b"b"]


def test_repeats_edges(spark):
    assert repeats.remove_repeats(frame(spark, []), length=80).count() == 0
    t = "".join(random.Random(2).choice("abcdef") for _ in range(300))
    got = repeats.remove_repeats(frame(spark, [(1, t), (1, t), (None, t[:200])]), length=80, keep="none").collect()
    assert [(r.n_bytes, r.n_removed) for r in sorted(got, key=lambda r: -r.n_bytes)] == [(300, 300), (300, 300), (200, 200)]

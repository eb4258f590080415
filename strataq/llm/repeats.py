"""Repeated passages by suffix order and longest-previous-factor arrays.

A window of ``length`` bytes is repeated if it starts elsewhere too. Suffixes are put in order, and the longest previous
factor of each is the longer of the prefixes that it shares with the previous and the next suffix of a smaller position; a window
has an earlier match exactly if its factor reaches ``length``. ``keep="first"`` removes windows with an earlier match, by
identifier and position; ``keep="none"`` removes all that match anything.

Suffixes that can match are brought together by anchors: the least hash of a 32-byte gram within a window is chosen
by its content alone, so equal windows have equal anchors at equal offsets. Adjacent starts with one
anchor form a run, whose context is the bytes that its windows cover. A window reaches half of its other bytes to the left of its anchor
or to the right; a run of which no such half, with the anchor, occurs elsewhere matches nothing and goes at once. Runs with one context (one 128-bit digest of these bytes)
are counted, with map-side aggregation, and two of them stand for all: the first, and the last as its twin. The arrays are
computed over the first runs and twins of all contexts of an anchor, in batches of a bounded number of windows, and
what they find is removed: a context's other runs take over what is found for its twin, and are never compared by a weaker hash. Contexts of
an anchor with more than ``most`` of them meet by the 128-bit digest of each window instead; of the windows of one digest
the first and the last go through the arrays, and the others take over what these find.

Nulls: null and empty texts have no bytes and nothing is removed; texts shorter than ``length`` stay whole. Null
identifiers come last in the order and are kept apart by their text. Repeated rows repeat each other's windows. Empty
tables give empty results. Extra columns are ignored. Texts are read whole; long ones are hashed in overlapping pieces of
``PIECE`` bytes, so that a task needs a few times a text's own size.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.llm.common import batch_bytes, mark_maybe, mix64, only_maybe, stash, unstash

GRAM, POSITION_BITS = 32, 28
#: Starts of a text that are hashed together, and bytes of several texts that are.
PIECE, AT_ONCE = 1 << 20, 1 << 18
#: Windows sorted at once.
SORTED = 8192
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    n = len(x) - w + 1
    full = np.concatenate((x, np.full(-len(x) % w, np.uint64(2**64 - 1)))).reshape(-1, w)
    ahead = np.minimum.accumulate(full, axis=1).reshape(-1)
    behind = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[w - 1: w - 1 + n])


def runs_of(texts: list[np.ndarray], length: int):
    """Of several texts: for each run its text, first start, number of starts, offset of the anchor, anchor, context digest, and
    the hashes of its left and right half, with masks of those that none of its windows reaches."""
    sizes = np.array([len(t) for t in texts], np.int64)
    b = np.concatenate(texts) if texts else np.zeros(0, np.uint8)
    if len(b) < length:
        return None
    up, down = _powers(1 << max(19, int(len(b)).bit_length()))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[: len(b)])))
    grams = mix64((sums[GRAM:] - sums[:-GRAM]) * down[: len(b) - GRAM + 1])
    low = np.uint64((1 << POSITION_BITS) - 1)
    least = _sliding_min((grams & ~low) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
    anchor = (least & low).astype(np.int64)
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(texts)), sizes)[: len(anchor)]
    good = np.arange(len(anchor)) + length <= ends[owner]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1]) | ~good[:-1]
    first = np.flatnonzero(new & good)
    if not len(first):
        return None
    total = np.concatenate(([0], np.cumsum(good)))
    following = np.concatenate((first[1:], [len(anchor)]))
    n = total[following] - total[first]
    off = anchor[first] - first
    data = memoryview(b)
    ctx = [hashlib.blake2b(data[p: q], digest_size=16, salt=o).digest()
           for p, q, o in zip(first.tolist(), (first + n - 1 + length).tolist(), (int(x).to_bytes(8, "little") for x in off), strict=True)]
    own, a = owner[first], anchor[first]
    # a window whose anchor stands at ``left`` or later covers so many bytes before it, another ``right`` bytes after it
    left = (length - GRAM) // 2
    right = length - GRAM - left + 1
    no_left, no_right = off < left, off - n + 1 >= left
    half = lambda p, q, tag: mix64((sums[q] - sums[p]) * down[p] + np.uint64(tag))
    halves = (half(np.maximum(a - left, 0), a + GRAM, 1), no_left, half(a, np.minimum(a + GRAM + right, len(b)), 2), no_right)
    return own, first - (ends - sizes)[own], n, off, mix64(grams[a]), ctx, halves


def _slices(batches, rows: int = 256):
    """Batches of few rows, so that the Python objects made of a batch stay few, however long its lists are."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _pieces(column, length: int):
    """The texts of an Arrow column in lists of about AT_ONCE bytes: (row, first byte, bytes). Long texts come in pieces that
    share length - 1 bytes, so that every start is in exactly one."""
    held, size = [], 0
    for row, b in enumerate(batch_bytes(column)):
        for at in range(0, max(1, len(b) - length + 1), PIECE):
            held.append((row, at, b[at: at + PIECE + length - 1]))
            size += len(held[-1][2])
            if size >= AT_ONCE:
                yield held
                held, size = [], 0
    if held:
        yield held


_RUNS = "id long, k long, p long, n int, off int, anchor long, ctx binary, l long, r long"


def _emit_runs(length: int):
    def run(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(1)
            for held in _pieces(batch.column(2), length):
                if (r := runs_of([b for _, _, b in held], length)) is not None:
                    own, p, n, off, anchor, ctx, (left, no_left, right, no_right) = r
                    take = pa.array(np.array([row for row, _, _ in held])[own])
                    p = p + np.array([at for _, at, _ in held])[own]
                    yield pa.RecordBatch.from_arrays([ids.take(take), keys.take(take), pa.array(p, pa.int64()), pa.array(n.astype(np.int32)), pa.array(off.astype(np.int32)),
                                                      pa.array(anchor.view(np.int64)), pa.array(ctx, pa.binary()), pa.array(left.view(np.int64), mask=no_left), pa.array(right.view(np.int64), mask=no_right)],
                                                     names=["id", "k", "p", "n", "off", "anchor", "ctx", "l", "r"])

    return run


#: The bytes of a run that stands for its context: the first (copy 0) or its twin (copy 1), with its place in the order.
_CUT = "anchor long, ctx binary, copy int, off int, n int, o long, p long, k long, bytes binary"
_CUT_ARROW = pa.schema([("anchor", pa.int64()), ("ctx", pa.binary()), ("copy", pa.int32()), ("off", pa.int32()), ("n", pa.int32()), ("o", pa.int64()), ("p", pa.int64()), ("k", pa.int64()), ("bytes", pa.binary())])


def _cut(length: int):
    """The bytes of chosen runs of each text."""
    def run(batches):
        for batch in _slices(batches):
            rows = []
            for b, key, picks in zip(batch_bytes(batch.column(0)), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                rows += [(r["anchor"], r["ctx"], r["copy"], r["off"], r["n"], r["o"], r["p"], key, b[r["p"]: r["p"] + r["n"] - 1 + length].tobytes()) for r in picks]
            for k in range(0, len(rows), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k: k + 10_000], strict=True), _CUT_ARROW, strict=True)], schema=_CUT_ARROW)

    return run


def _slices(batches, rows: int = 256):
    """Batches of few rows, so that the Python objects made of a batch stay few, however long its lists are."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


def _smaller(place: np.ndarray, lcp: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each suffix in order, with the text positions ``place`` and the prefix ``lcp`` shared with the suffix before:
    the previous one of a smaller position and the prefix shared with it; -1 and 0 where that is shorter than ``least``.
    Pointers jump over suffixes of larger positions, all at once, until each rests on a smaller one."""
    to, common = np.arange(-1, len(place) - 1), lcp.copy()
    walk = np.flatnonzero(common >= least)
    while len(walk := walk[place[to[walk]] > place[walk]]):
        via = to[walk]
        common[walk] = np.minimum(common[walk], common[via])
        to[walk] = to[via]
        walk = walk[common[walk] >= least]
    far = common < least
    to[far], common[far] = -1, 0
    return to, common


def longest_previous_factors(windows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Of suffixes in text order, each given by its first bytes: the longest prefix that an earlier suffix shares, and
    that suffix (0 and -1 where it is shorter than ``least``). In suffix order the longest one is shared with the previous
    or the next suffix of a smaller position."""
    n, length = windows.shape
    factor, source = np.zeros(n, np.int64), np.full(n, -1)
    if n:
        order = np.argsort(windows.view(f"S{length}")[:, 0], kind="stable")
        w = windows[order]
        differ = w[1:] != w[:-1]
        lcp = np.concatenate(([0], np.where(differ.any(1), differ.argmax(1), length), [0]))
        before, with_before = _smaller(order, lcp[:-1], least)
        after, with_after = (x[::-1] for x in _smaller(order[::-1], lcp[:0:-1], least))
        after = np.where(after < 0, -1, n - 1 - after)
        best = np.where(with_before >= with_after, before, after)
        factor[order] = np.maximum(with_before, with_after)
        source[order] = np.where(best < 0, -1, order[best])
    return factor, source


def match_windows(buffer: np.ndarray, starts: np.ndarray, rank: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the suffixes at ``starts``: whether the first ``length`` bytes occur at another of them, and at one before it
    by rank, ties in the order given. The first of equal windows has no previous factor, but is one."""
    by_rank = np.argsort(rank, kind="stable")
    windows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(buffer, length)[starts[by_rank]])
    factor, source = longest_previous_factors(windows, length)
    hit = factor >= length
    other, earlier = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    earlier[by_rank] = hit
    other[by_rank[hit]] = other[by_rank[source[hit]]] = True
    return other, earlier


def _spans(hit: np.ndarray) -> list[int]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return edge.tolist()


_FOUND = "anchor long, ctx binary, copy int, other array<int>, earlier array<int>"
_FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("ctx", pa.binary()), ("copy", pa.int32()), ("other", pa.list_(pa.int32())), ("earlier", pa.list_(pa.int32()))])


def _sort_groups(length: int):
    """Contexts sorted by anchor and place: windows of whole groups, or of offsets of a large group, are matched together."""
    def run(batches):
        held, windows = [], 0  # contexts of whole groups
        group, group_windows, key = [], 0, None

        def match(rows):
            if not rows:
                return
            buffer = np.frombuffer(b"".join(r[8] for r in rows), np.uint8)
            base = np.concatenate(([0], np.cumsum([len(r[8]) for r in rows])[:-1]))
            off, n = np.array([r[3] for r in rows], np.int64), np.array([r[4] for r in rows], np.int64)
            rank = np.arange(len(rows))  # those that can match, of one anchor, come in the order of their places
            if n.sum() <= 2 * SORTED:
                which = np.repeat(np.arange(len(rows)), n)
                s = np.arange(n.sum()) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
                slices = [(which, s)]
            else:  # equal windows have equal offsets from their anchor
                step = max(1, SORTED // len(rows))
                slices = []
                for lo in range(0, int(off.max()) + 1, step):
                    a, z = np.maximum(0, off - (lo + step - 1)), np.minimum(n - 1, off - lo)
                    m = np.maximum(0, z - a + 1)
                    slices.append((np.repeat(np.arange(len(rows)), m), np.arange(m.sum()) - np.repeat(np.concatenate(([0], np.cumsum(m)[:-1])), m) + np.repeat(a, m)))
            flat_o, flat_e = np.zeros(n.sum(), bool), np.zeros(n.sum(), bool)
            at = np.concatenate(([0], np.cumsum(n)))
            for which, s in slices:
                if len(s):
                    o, e = match_windows(buffer, base[which] + s, rank[which], length)
                    flat_o[at[which] + s], flat_e[at[which] + s] = o, e
            out = [(*r[:3], _spans(flat_o[at[k]: at[k + 1]]), _spans(flat_e[at[k]: at[k + 1]])) for k, r in enumerate(rows) if flat_o[at[k]: at[k + 1]].any()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _FOUND_ARROW, strict=True)], schema=_FOUND_ARROW)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group and row[:3] == group[-1][:3]:
                    continue  # the same run of a repeated row
                if row[0] != key:
                    held += group
                    windows += group_windows
                    group, group_windows, key = [], 0, row[0]
                    if windows >= SORTED:
                        yield from match(held)
                        held, windows = [], 0
                group.append(row)
                group_windows += row[4]
                if group_windows >= SORTED and held:
                    yield from match(held)
                    held, windows = [], 0
        yield from match(held + group)

    return run


_EACH = "anchor long, ctx binary, copy int, o long, p long, k long, s int, w binary"
_EACH_ARROW = pa.schema([*(_CUT_ARROW.field(c) for c in ("anchor", "ctx", "copy", "o", "p", "k")), ("s", pa.int32()), ("w", pa.binary())])


def _each_window(length: int):
    """The digest of each window of a context."""
    def run(batches):
        for batch in batches:
            rows = []
            for anchor, ctx, copy, _, n, o, p, key, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows += [(anchor, ctx, copy, o, p, key, s, hashlib.blake2b(data[s: s + length], digest_size=16).digest()) for s in range(n)]
                if len(rows) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EACH_ARROW, strict=True)], schema=_EACH_ARROW)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _EACH_ARROW, strict=True)], schema=_EACH_ARROW)

    return run


def _windows_at(length: int):
    """The bytes of chosen windows of a context: w, last (0 for the first of a digest), bytes."""
    def run(batches):
        for batch in _slices(batches):
            rows = [(x["w"], x["last"], data[x["s"]: x["s"] + length]) for data, at in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for x in at]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int32(), pa.binary()), strict=True)], names=["w", "last", "bytes"])

    return run


def _confirm(length: int):
    """Of the first and the last window of each digest, sorted so: the digests whose last window the arrays match with the first."""
    def run(batches):
        held: dict = {}

        def close(done):
            rows = [(w, *done[w]) for w in done if None not in done[w]]
            windows = np.frombuffer(b"".join(x for _, a, z in rows for x in (a, z)), np.uint8).reshape(-1, length)
            factor, source = longest_previous_factors(windows, length)
            sure = [rows[k // 2][0] for k in range(1, len(windows), 2) if factor[k] >= length and (windows[source[k]] == windows[k - 1]).all()]
            return pa.RecordBatch.from_arrays([pa.array(sure, pa.binary())], names=["w"])

        for batch in batches:
            for w, last, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if w not in held and len(held) >= SORTED:
                    yield close(held)
                    held = {}
                pair = held.setdefault(w, [None, None])
                pair[last] = data
        if held:
            yield close(held)

    return run


def _merge_starts(name: str, hit):
    starts = F.array_sort(F.collect_list(F.when(hit, F.col("s"))))
    return F.flatten(F.transform(starts, lambda s: F.array(s, s + 1))).alias(name)


def _union(picks, length: int) -> list[tuple[int, int]]:
    """The bytes that runs' spans of window starts cover, as sorted intervals that do not touch."""
    every = np.array([(r["p"] + lo, r["p"] + hi - 1 + length) for r in picks for lo, hi in zip(r["spans"][::2], r["spans"][1::2], strict=True)], np.int64)
    every = every[np.argsort(every[:, 0], kind="stable")]
    reach = np.maximum.accumulate(every[:, 1])
    new = np.concatenate(([True], every[1:, 0] > reach[:-1]))
    return list(zip(every[new, 0].tolist(), np.maximum.reduceat(every[:, 1], np.flatnonzero(new)).tolist(), strict=True))


def _remove(length: int, full_text: bool):
    def run(batches):
        for batch in _slices(batches):
            ids, out = batch.column(0), []
            for b, picks in zip(batch_bytes(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                gone, at, digest, kept = _union(picks, length), 0, hashlib.sha256(), []
                for lo, hi in [*gone, (len(b), len(b))]:
                    digest.update(b[at: lo])
                    if full_text:
                        kept.append(b[at: lo].tobytes())
                    at = hi
                out.append((len(b), sum(hi - lo for lo, hi in gone), len(gone), digest.hexdigest(), b"".join(kept) if full_text else None))
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()), strict=True))],
                                             names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400, keep: str = "first", most: int = 8192,
                   with_text: bool = True) -> DataFrame:
    """One row for each document: id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, kept (the bytes left)."""
    if length < 2 * GRAM or keep not in ("first", "none"):
        raise ValueError(f"length is at least {2 * GRAM}, and keep is first or none")
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("k", F.xxhash64("text")).select("id", "k", "text")
    every = stash(spark, docs.mapInArrow(_emit_runs(length), _RUNS), "runs")
    # runs of which no half occurs twice match nothing
    half = every.select(F.explode(F.array("l", "r")).alias("id")).where("id is not null")
    twice = stash(spark, half.groupBy("id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("id"), "halves")
    runs = stash(spark, mark_maybe(every, twice, {"in_l": "l", "in_r": "r"}).where("in_l or in_r").drop("l", "r", "in_l", "in_r"), "repeated")
    unstash(every, twice)
    # the first run of each context stands for it, and the last, if there are several, is its twin
    order = F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("o"), "p", "k", "id", "n", "off")
    contexts = stash(spark, runs.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("f"), F.max(order).alias("g")), "contexts")
    several = contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts"))
    ends = F.when(F.col("c") > 1, F.array(F.col("f"), F.col("g"))).otherwise(F.array(F.col("f")))
    picks = contexts.join(several, "anchor").where("contexts > 1 or c > 1").select("anchor", "ctx", "contexts", F.posexplode(ends).alias("copy", "e")).select("anchor", "ctx", "contexts", "copy", "e.*")
    # texts of a run that stands for others: one list for each text, no longer than the text's own runs
    picks = picks.groupBy("id", "k").agg(F.collect_list(F.struct("anchor", "ctx", "copy", "p", "n", "off", "o", "contexts")).alias("picks")).withColumnsRenamed({"id": "i2", "k": "k2"})
    picks = stash(spark, picks, "picks")
    texts = only_maybe(docs, "k", picks.select(F.col("k2").alias("id")))
    same = lambda a, b: F.col("id").eqNullSafe(F.col(a)) & (F.col("k") == F.col(b))
    cut = texts.join(picks, same("i2", "k2")).select("text", "k", "picks")
    small = cut.withColumn("picks", F.filter("picks", lambda x: x["contexts"] <= most)).mapInArrow(_cut(length), _CUT)
    found = small.repartition("anchor").sortWithinPartitions("anchor", "o", "p", "k", "ctx", "copy").mapInArrow(_sort_groups(length), _FOUND)
    found = stash(spark, found if keep == "first" else found.where("copy = 0"), "found")
    written = [runs, contexts, picks, found]
    if not several.where(F.col("contexts") > most).isEmpty():
        large = stash(spark, cut.withColumn("picks", F.filter("picks", lambda x: x["contexts"] > most)).mapInArrow(_cut(length), _CUT), "large")
        each = stash(spark, large.mapInArrow(_each_window(length), _EACH).dropDuplicates(["anchor", "ctx", "copy", "s"]), "windows")
        me = F.struct("o", "p", "k", "copy", "s", "anchor", "ctx")
        by = stash(spark, each.groupBy("w").agg(F.count(F.lit(1)).alias("c"), F.min(me).alias("a"), F.max(me).alias("z")).where("c > 1").drop("c"), "digests")
        at = by.select("w", F.posexplode(F.array("a", "z")).alias("last", "e")).select("w", "last", "e.*").groupBy("anchor", "ctx", "copy").agg(F.collect_list(F.struct("s", "w", "last")).alias("at"))
        chosen = large.join(at, ["anchor", "ctx", "copy"]).select("bytes", "at").mapInArrow(_windows_at(length), "w binary, last int, bytes binary")
        sure = chosen.repartition("w").sortWithinPartitions("w", "last").mapInArrow(_confirm(length), "w binary")
        hit = each.join(by.join(sure.distinct(), "w").select("w", "a"), "w").withColumn("me", me)
        hit = hit.groupBy("anchor", "ctx", "copy").agg(_merge_starts("other", F.lit(True)), _merge_starts("earlier", F.col("me") != F.col("a")))
        hit = stash(spark, hit if keep == "first" else hit.where("copy = 0"), "found")
        found, written = found.unionByName(hit), [*written, large, each, by, hit]
    if keep == "none":
        state, spans = found.select("anchor", "ctx", "other"), F.col("other")
    else:  # a context's first run loses what is earlier elsewhere, all others what the twin loses
        one, two = (found.where(F.col("copy") == j).select("anchor", "ctx", F.col("earlier").alias(c)) for j, c in enumerate(("first", "others")))
        state = stash(spark, contexts.select("anchor", "ctx", F.struct("f.o", "f.p", "f.k").alias("f")).join(one.join(two, ["anchor", "ctx"], "full"), ["anchor", "ctx"]), "state")
        spans = F.when(F.struct(F.coalesce("id", F.lit(2**63 - 1)).alias("o"), "p", "k") == F.col("f"), F.col("first")).otherwise(F.col("others"))
    marked = runs.join(state, ["anchor", "ctx"]).select("id", "k", "p", spans.alias("spans")).where("size(spans) > 0")
    # a set: repeated rows have the same spans
    marked = marked.groupBy("id", "k").agg(F.collect_set(F.struct("p", "spans")).alias("picks")).withColumnsRenamed({"id": "i2", "k": "k2"})
    marked = stash(spark, marked, "marked")
    unstash(*written)
    out = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    changed = only_maybe(docs, "k", marked.select(F.col("k2").alias("id"))).join(marked, same("i2", "k2")).select("id", "text", "picks").mapInArrow(_remove(length, with_text), out)
    whole = docs.select("id", "k", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
                        F.sha2("text", 256).alias("kept_sha256"), (F.encode("text", "UTF-8") if with_text else F.lit(None).cast("binary")).alias("kept"))
    whole = whole.join(marked.select("i2", "k2"), same("i2", "k2"), "left_anti").drop("k")
    both = changed.unionByName(whole)
    return both if with_text else both.drop("kept")

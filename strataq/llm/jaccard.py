"""N-gram Jaccard join by a token-group matrix.

A document is its set of distinct word shingles, as 64-bit hashes. Equal sets are one node, the document
with the smallest identifier. Nodes join when 100 * |intersection| >= percent * |union|.

1. Partition: nodes with one of two min-hashes in common meet in blocks of a bounded size; a block forms groups, each with
   the union of its members' tokens. A node is compared with a group's members only if enough of
   its tokens are in that union. Roots of the blocks of a large min-hash meet again, until one block is left.
2. Matrix: tokens are ordered by how common they are (a table of counts of fixed size, over all documents), and
   a node's first (100 - percent + EXTRA) percent and one more must hold a token of any node that it joins. The matrix holds, for those
   tokens, the groups that have them. A node is a query for each larger group that shares enough such tokens for the sizes of both.
3. Opening: queries meet blocks of a candidate group's members. The block's token union bounds the overlap; only
   blocks that qualify are opened, and one link ends the search. First one block of each group; then, for queries
   still apart from their group, the matrix is asked again for each of the other blocks, and they meet those whose tokens allow
   a link. So no link between different components is lost.

Hot min-hashes, groups and queries are split in blocks; tokens that many documents share come last in the order.
Groups are components of links, found by rounds of contraction on written tables.

Nulls: null and empty texts have the empty set and join nothing; a row with a null identifier gets the component of
an equal set, or null. Repeated rows share a node. Texts are read whole. Empty tables give empty
results. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.llm.common import chunks, components, mix64, only_maybe, stash, sum_tables, unstash, words_of

#: Cells of the table of token counts, and the pieces in which it is summed.
CELL_BITS, PIECES = 18, 16
#: Min-hashes by which nodes first meet.
KEYS = 2
#: Members of a block, and queries that meet it at once.
BLOCK, QUERIES = 256, 1024
#: So many percent of a set, and one, are tokens that a prefix has to share, beyond the shortest possible prefix.
EXTRA = 10
#: Rounds of grouping by a further min-hash, for min-hashes of more than one block.
LEVELS = 8
_TURN = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts, width: int):
    """The sorted set of shingle hashes of each text; fewer words than ``width`` are one shingle."""
    h, counts = words_of(texts, lower=True)
    ends = np.cumsum(counts)
    for a, z in zip(ends - counts, ends, strict=True):
        n = z - a
        if n == 0:
            yield h[0:0]
            continue
        k = min(n, width)
        g = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            g = g * _TURN + h[a + j: z - k + 1 + j]
        yield np.unique(mix64(g))


def _minhash(s: np.ndarray, level: int = 0) -> int:
    return int(mix64(s ^ np.uint64(0x5DEECE66D1234567 + 1013904223 * level)).min().view(np.int64))


def _as_long(s: np.ndarray) -> pa.Array:
    return pa.array(s.view(np.int64))


_NODE = pa.schema([("id", pa.int64()), ("k", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("mh", pa.list_(pa.int64())), ("piece", pa.int32()), ("part", pa.int32()), ("sums", pa.binary())])


def _describe(width: int):
    """A row for each document, and at the end the table of token counts in pieces."""
    def run(batches):
        cells = np.zeros(1 << CELL_BITS, np.int64)
        for batch in batches:
            n, digest, mh = [], [], []
            for texts in chunks([batch.column(1)]):
                sets = list(shingle_sets(texts, width))
                for s in sets:
                    n.append(len(s))
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    mh.append([_minhash(s, k) for k in range(KEYS)] if len(s) else None)
                every = np.concatenate(sets)
                cells += np.bincount((every >> np.uint64(64 - CELL_BITS)).astype(np.int64), minlength=len(cells))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(mh, pa.list_(pa.int64())),
                                              pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())], schema=_NODE)
        if cells.any():
            from pyspark import TaskContext

            none = lambda t: pa.nulls(PIECES, t)
            yield pa.RecordBatch.from_arrays([none(pa.int64()), none(pa.int64()), none(pa.int64()), none(pa.binary()), none(pa.list_(pa.int64())), pa.array(range(PIECES), pa.int32()),
                                              pa.array([TaskContext.get().partitionId()] * PIECES, pa.int32()), pa.array([p.tobytes() for p in cells.reshape(PIECES, -1)], pa.binary())], schema=_NODE)

    return run


def _token_counts(described: DataFrame) -> np.ndarray:
    sums = sum_tables(described.where("piece is not null").select("piece", "part", "sums"), np.int64)
    return np.concatenate([sums[k] for k in range(PIECES)]) if sums else np.zeros(1 << CELL_BITS, np.int64)


def joins(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = overlap(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


class Groups:
    """The groups of one block: members and token union of each."""

    def __init__(self, percent: int):
        self.percent, self.groups = percent, []

    def add(self, node: int, s: np.ndarray) -> None:
        hit = []
        for k, (union, members) in enumerate(self.groups):
            if 100 * overlap(s, union) >= self.percent * len(s) and any(joins(s, m, self.percent) for _, m in members):
                hit.append(k)
        members, union = [(node, s)], s
        for k in reversed(hit):
            u, m = self.groups.pop(k)
            members, union = m + members, np.union1d(u, union)
        self.groups.append((union, members))


_SETS = "id long, tokens binary"


def _sets(width: int):
    def run(batches):
        for batch in batches:
            sets = [s.tobytes() for texts in chunks([batch.column(1)]) for s in shingle_sets(texts, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["id", "tokens"])

    return run


def _rekey(level: int):
    def run(batches):
        for batch in batches:
            mh = [_minhash(np.frombuffer(t, np.uint64), level) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(mh, pa.int64()), batch.column(1)], names=["id", "mh", "tokens"])

    return run


_ROOTS = pa.schema([("id", pa.int64()), ("root", pa.int64()), ("mh", pa.int64()), ("nb", pa.int64()), ("tokens", pa.binary())])


def _group_blocks(percent: int):
    def run(batches):
        key, groups, nb, last = None, None, 1, None

        def close():
            rows = []
            for _, members in groups.groups:
                root = min(members, key=lambda m: m[0])
                for node, s in members:
                    if len(members) > 1 or nb > 1:
                        rows.append((node, root[0], key[0], nb, s.tobytes() if nb > 1 and node == root[0] else None))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _ROOTS, strict=True)], schema=_ROOTS)

        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns]
            for node, mh, n, block, tokens in zip(*cols, strict=True):
                if (mh, block) != key:
                    if groups is not None:
                        yield from close()
                    key, groups, nb, last = (mh, block), Groups(percent), n, None
                if node != last:  # a root of two blocks comes twice
                    groups.add(node, np.frombuffer(tokens, np.uint64))
                last = node
        if groups is not None:
            yield from close()

    return run


def _first_groups(spark, docs, nodes, width: int, percent: int) -> DataFrame:
    """Links within equal min-hashes."""
    keys = nodes.select("id", F.posexplode("mh").alias("k", "mh"))
    sized = keys.groupBy("k", "mh").agg(F.count(F.lit(1)).alias("c"), F.ceil(F.count(F.lit(1)) / BLOCK).alias("nb")).where("c > 1")
    # the number of the key is folded into it
    at = keys.join(sized, ["k", "mh"]).select("id", F.xxhash64("k", "mh").alias("mh"), "nb", F.pmod(F.xxhash64("id"), F.col("nb")).alias("block"))
    at = stash(spark, at, "shared")
    texts = only_maybe(docs, "id", at.select("id"))
    sets = texts.select("id", "text").mapInArrow(_sets(width), _SETS)
    rows, links = at.join(sets, "id").select("id", "mh", "nb", "block", "tokens"), []
    for level in range(KEYS, KEYS + LEVELS):
        dealt = rows.repartition("mh", "block").sortWithinPartitions("mh", "block", "id")
        out = stash(spark, dealt.mapInArrow(_group_blocks(percent), "id long, root long, mh long, nb long, tokens binary"), "groups")
        links.append(out.where("id != root").select(F.col("id").alias("a"), F.col("root").alias("b")))
        roots = out.where("tokens is not null").select("id", "tokens")
        if level == KEYS + LEVELS - 1 or roots.isEmpty():
            break
        # roots of one family mostly share their next min-hash too; others part ways here
        roots = stash(spark, roots.mapInArrow(_rekey(level), "id long, mh long, tokens binary"), "roots")
        sized = roots.groupBy("mh").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("nb"), F.count(F.lit(1)).alias("c")).where("c > 1")
        rows = roots.join(sized, "mh").select("id", "mh", "nb", F.pmod(F.xxhash64("id", F.lit(level)), F.col("nb")).alias("block"), "tokens")
    every = links[0]
    for x in links[1:]:
        every = every.union(x)
    return every


def _prefixes(width: int, percent: int, counts):
    def run(batches):
        for batch in batches:
            ids, n, first = [], [], []
            at = batch.column(0).to_pylist()
            k = 0
            for texts in chunks([batch.column(1)]):
                for s in shingle_sets(texts, width):
                    if len(s):
                        p = len(s) - -(-percent * len(s) // 100) + 1 + EXTRA * len(s) // 100
                        c = counts.value[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
                        first.append(s[np.lexsort((s, c))[:p]].view(np.int64))
                        ids.append(at[k])
                        n.append(len(s))
                    k += 1
            off = np.concatenate(([0], np.cumsum([len(f) for f in first]))).astype(np.int32)
            flat = np.concatenate(first) if first else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(off), pa.array(flat))], names=["id", "n", "first"])

    return run


def _open(percent: int):
    """Rows sorted by group, block, part and role, members first; one link of each query with the block."""
    def run(batches):
        key, members, union = None, [], None
        for batch in batches:
            out = []
            for g, block, part, role, node, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                s = np.frombuffer(tokens, np.uint64)
                if (g, block, part) != key:
                    key, members, union = (g, block, part), [], None
                if role == 0:
                    members.append((node, s))
                    continue
                if union is None:
                    union = np.unique(np.concatenate([m for _, m in members])) if members else s[0:0]
                if 100 * overlap(s, union) < percent * len(s):
                    continue
                link = next((m for m, x in members if joins(s, x, percent)), None)
                if link is not None:
                    out.append((node, link))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["a", "b"])

    return run


def _opened(spark, docs, pairs, members, width: int, percent: int) -> DataFrame:
    """pairs: q, g, block; members: g, id, block. Links of queries with members of the blocks that they are to meet."""
    parts = pairs.groupBy("g", "block").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    rows = members.join(parts, ["g", "block"]).select("g", "block", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"), F.lit(0).alias("role"), "id")
    rows = rows.union(pairs.join(parts, ["g", "block"]).select("g", "block", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int").alias("part"), F.lit(1).alias("role"), F.col("q").alias("id")))
    rows = openings = stash(spark, rows, "openings")
    texts = only_maybe(docs, "id", openings.select("id"))
    sets = texts.select("id", "text").mapInArrow(_sets(width), _SETS)
    full = rows.join(sets, "id").select("g", "block", "part", "role", "id", "tokens")
    dealt = full.repartition("g", "block", "part").sortWithinPartitions("g", "block", "part", "role", "id")
    links = stash(spark, dealt.mapInArrow(_open(percent), "a long, b long"), "links")
    unstash(openings)
    return links


def _relabel(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """id, label of every node; those without links are their own."""
    return nodes.select("id").join(found.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("label"))


def _needed(percent: int):
    """The fewest tokens that the prefixes of a query and of some member of the group must share.

    Let w be the last token, in the common order, of the prefix that ends first. Shared tokens up to w are
    in both prefixes; of those after w there are at most as many as that set has beyond its prefix, which
    is below keep * n + 1. Together they must reach percent / (100 + percent) of both sizes. As a function of
    the member's size the bound is least at an end of the sizes that can join."""
    keep, both = F.lit((percent - EXTRA) / 100), F.lit(percent / (100 + percent))
    n, lo = F.col("n"), F.greatest(F.col("least"), F.floor(F.col("n") * percent / 100))
    hi = F.least(F.col("most"), F.ceil(F.col("n") * 100 / percent))
    at = lambda m: both * (n + m) - keep * F.greatest(n, m) - 1
    return F.greatest(F.lit(1.0), F.floor(F.least(at(lo), at(hi))))


def _fits(percent: int):
    """Whether the sizes of a query and of some member of the group allow a link, and the tokens that either can share."""
    fits = (F.col("n") * 100 >= F.col("least") * percent) & (F.col("most") * 100 >= F.col("n") * percent)
    return fits & ((F.col("n") + F.col("least")) * percent <= F.least("reach", "g_reach") * (100 + percent))


def _bounds():
    return F.min("n").alias("least"), F.max("n").alias("most"), F.max("reach").alias("g_reach")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row for each document: id, n_shingles, component_id (the smallest identifier reachable) and k (a hash of the text)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("k"))
    described = stash(spark, docs.mapInArrow(_describe(width), "id long, k long, n long, digest binary, mh array<long>, piece int, part int, sums binary"), "described")
    rows = described.where("piece is null")
    classes = stash(spark, rows.where("digest is not null and id is not null").groupBy("digest").agg(F.min("id").alias("id"), F.first("mh").alias("mh"), F.first("n").alias("n")), "classes")
    # an identifier that several sets share is a node of each of them; it links them as its own document would
    nodes = stash(spark, classes.select("id", "mh"), "nodes")
    counts = spark.sparkContext.broadcast(_token_counts(described))
    named = docs.where("id is not null").select("id", "text")
    links = _first_groups(spark, named, nodes, width, percent)
    links = stash(spark, links, "links0")
    labels = stash(spark, _relabel(nodes, components(spark, links)).distinct(), "labels0")

    # the matrix: common-last prefixes, and the groups that have their tokens
    first = only_maybe(named, "id", nodes).select("id", "text").mapInArrow(_prefixes(width, percent, counts), "id long, n long, first array<long>")
    size = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    known = stash(spark, labels.join(size, "label"), "groups0")
    first = stash(spark, first.join(known, "id"), "prefixes")
    cells = first.select("id", "n", "label", "size", F.size("first").alias("p"), F.explode("first").alias("token"))
    # a token of one group joins nothing; a node with too few other tokens joins nothing, and its tokens
    # then may be left with one group
    for _ in range(2):
        shared = cells.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select(F.col("token").alias("id"))
        shared, last = stash(spark, shared, "tokens"), cells
        cells = only_maybe(cells, "token", shared).join(shared.withColumnRenamed("id", "token"), "token", "left_semi")
        cells = some = stash(spark, cells.drop("reach"), "cells")
        unstash(shared, *([last] if hasattr(last, "stashed") else []))
        alive = cells.groupBy("id").agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("n"))
        alive = alive.withColumns({"least": F.lit(0), "most": F.lit(1 << 62)}).where(F.col("c") >= _needed(percent)).select("id", "c")
        # prefix tokens that went are in no other group, so that at most ``reach`` tokens of a node can be shared
        cells = stash(spark, cells.join(alive, "id").withColumn("reach", F.col("n") - F.col("p") + F.col("c")).drop("c"), "cells")
        unstash(some)
    matrix = cells.groupBy("token", F.col("label").alias("g")).agg(F.first("size").alias("g_size"), *_bounds())
    smaller = (F.col("size") < F.col("g_size")) | ((F.col("size") == F.col("g_size")) & (F.col("label") < F.col("g")))
    cand = cells.join(matrix, "token").where(_fits(percent) & smaller).groupBy(F.col("id").alias("q"), "g").agg(
        F.count(F.lit(1)).alias("common"), F.max("n").alias("n"), F.first("g_size").alias("g_size"), F.min("least").alias("least"), F.max("most").alias("most"))
    cand = stash(spark, cand.where(F.col("common") >= _needed(percent)).select("q", "g", "g_size"), "candidates")
    unstash(first)
    if cand.isEmpty():
        final = labels
    else:
        wanted = cand.select("g", "g_size").distinct()
        members = wanted.join(labels.withColumnRenamed("label", "g"), "g")
        members = stash(spark, members.select("g", "id", F.pmod(F.xxhash64("id"), F.ceil(F.col("g_size") / BLOCK)).alias("block")), "members")
        one = members.groupBy("g").agg(F.min("block").alias("block"))
        some = _opened(spark, named, cand.select("q", "g").join(one, "g"), members.join(one, ["g", "block"]).select("g", "id", "block"), width, percent)
        over = links.union(some)
        final = stash(spark, _relabel(nodes, components(spark, over)).distinct(), "labels1")
        rest = members.join(one, ["g", "block"], "left_anti")
        if not rest.isEmpty():
            now = final.withColumnRenamed("id", "q").withColumnRenamed("label", "now")
            of_g = final.select(F.col("id").alias("g"), F.col("label").alias("g_now"))  # a label is one of its members
            apart = stash(spark, cand.join(now, "q").join(of_g, "g").where("now != g_now").select("q", "g"), "apart")
            if not apart.isEmpty():
                # the matrix again, a row for each further block: a query meets only blocks whose tokens allow a link
                rest = stash(spark, rest.join(apart.select("g").distinct(), "g").select("g", "id", "block"), "rest")
                of_block = cells.select("id", "token", "n", "reach").join(rest, "id").groupBy("token", "g", "block").agg(*_bounds())
                asked = apart.join(cells.select(F.col("id").alias("q"), "token", "n", "reach"), "q").join(of_block, ["token", "g"]).where(_fits(percent))
                pairs = asked.groupBy("q", "g", "block").agg(F.count(F.lit(1)).alias("common"), F.first("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
                pairs = stash(spark, pairs.where(F.col("common") >= _needed(percent)).select("q", "g", "block"), "pairs")
                more = _opened(spark, named, pairs, rest, width, percent)
                final = stash(spark, _relabel(nodes, components(spark, over.union(more))).distinct(), "labels2")
    unstash(cells)
    by_class = classes.select("digest", F.col("id").alias("node")).join(final.withColumnRenamed("id", "node"), "node").select(F.col("digest").alias("d2"), "label")
    out = rows.join(by_class, F.col("digest") == F.col("d2"), "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.coalesce("label", "id").alias("component_id"), "k")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that aren't the first of their group by identifier (null last), all columns as they are. A
    document is an identifier and its text: different texts of one identifier are judged each by itself, rows that repeat both stay
    together, and rows with a null identifier are documents like others."""
    spark, own = docs.sparkSession, docs.withColumn("__own", F.xxhash64(id_col, text_col))
    judged = jaccard_components(own.select(F.col("__own").alias("__id"), F.col(text_col).alias("text")), "__id", "text", width, percent)
    judged = stash(spark, judged.select("id", "component_id").distinct(), "judged")
    groups = judged.where("id != component_id").select("component_id").distinct()
    members = judged.join(groups, "component_id").select("component_id", F.col("id").alias("__m"))
    ids = own.select("__own", F.col(id_col).alias("__i")).distinct()
    members = stash(spark, members.join(ids, F.col("__m") == F.col("__own")).select("component_id", "__m", "__i"), "members")
    first = members.groupBy("component_id").agg(F.min(F.struct(F.col("__i").isNull().alias("none"), "__i", "__m")).alias("f")).select(F.col("f.__m").alias("__m"))
    gone = stash(spark, members.select("__m").join(first, "__m", "left_anti"), "near")
    return own.join(gone, F.col("__own") == F.col("__m"), "left_anti").drop("__own")

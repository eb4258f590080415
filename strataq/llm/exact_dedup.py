"""Exact deduplication by a log-structured merge index, in DataFrame operations only.

``append`` fills memtables: of each task's rows, ``memtable_rows`` at a time. A memtable is flushed as a run of level 0, sorted by
digest and written without a shuffle, with a filter of its own, whose bits are sized by its rows. Once a level holds ``fanout``
runs they are compacted: each digest keeps its number of rows, smallest and largest identifier and the row that stays, and
the merged run goes one level down, cut into shards by digest range, each sorted. All groups of a level merge in one job, and
of a level's runs each is rewritten once, so a digest is rewritten once a level and new batches never rewrite all of the index.

``lookup`` asks the runs for digests: a run's filter decides first which digests visit it, and a digest that is in no
filter reads no run.

Every hit is verified: of a digest that occurs twice, the least and the greatest text must be the same bytes. Only if some
digest covers different texts are its rows grouped by text. A bit filter, sized by the digests that occur twice and
broadcast, tells which texts have to be read for this.

Nulls: a null text counts as empty; a null identifier never beats another and its rows still count.
Repeated rows (same identifier and text): exactly one stays. Empty tables give empty results. Extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataq.llm.common import fresh_path, only_maybe, stash

#: Runs of a level that are merged into one; rows of a shard of a merged run, about, and its most shards, beyond which these grow.
FANOUT, SHARD_ROWS, MOST_SHARDS = 64, 1 << 12, 1 << 12
#: Bits of a run's filter for each of its rows, at least and at most, and the bits of one row of a filter.
BITS_EACH, LEAST_BITS, MOST_BITS, ROW_BITS = 10, 1 << 15, 1 << 33, 1 << 15
#: Rows of a batch have numbers below this; a batch adds its own number times it.
BATCH_ROWS = 1 << 53


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclass
class Level:
    """The runs of one level: rows (run, digest, n, least, most, stay) and filters (run, part, bits), each filter of ``bits`` bits."""

    depth: int
    runs: list[int]
    rows: DataFrame
    filters: DataFrame
    bits: int
    count: int


@dataclass
class DigestIndex:
    """``slots`` has every row that was put in: id, digest, slot (one number for each row)."""

    spark: SparkSession
    keep: str = "smallest"
    memtable_rows: int = 1 << 20
    fanout: int = FANOUT
    levels: list[Level] = field(default_factory=list)
    slots: list[DataFrame] = field(default_factory=list)

    def append(self, rows: DataFrame) -> DigestIndex:
        """Flush memtables of (id, digest) and compact the levels that are full."""
        at = F.monotonically_increasing_id()
        # the number of the task, and of the memtable within it
        run = F.shiftleft(F.shiftright(at, 33), 20) + F.floor(at.bitwiseAND((1 << 33) - 1) / self.memtable_rows)
        numbered = rows.select("id", "digest", (at + F.lit(len(self.slots) * BATCH_ROWS)).alias("slot"), run.alias("run"))
        numbered.sortWithinPartitions("run", "digest").write.parquet(path := fresh_path(self.spark, "run0"))
        flushed = self.spark.read.schema(numbered.schema).parquet(path)
        self.slots.append(flushed.select("id", "digest", "slot"))
        sizes = sorted((r.run, r["count"]) for r in flushed.groupBy("run").count().collect())  # one row for each memtable
        if sizes:
            ones = flushed.select("run", "digest", F.lit(1).cast("long").alias("n"), F.col("id").alias("least"), F.col("id").alias("most"), F.col("slot").alias("stay"))
            self._add(0, sizes, ones)
            self._compact()
        return self

    def _add(self, depth: int, sizes: list[tuple[int, int]], rows: DataFrame) -> None:
        bits = LEAST_BITS
        while bits < min(MOST_BITS, BITS_EACH * max(n for _, n in sizes)):
            bits *= 2
        place = F.pmod(F.xxhash64("digest"), F.lit(bits))
        filters = rows.select("run", place.alias("b")).groupBy("run", F.expr(f"b div {ROW_BITS}").alias("part")).agg(F.expr(f"bitmap_construct_agg(b % {ROW_BITS})").alias("bits"))
        self.levels.append(Level(depth, [r for r, _ in sizes], rows, stash(self.spark, filters, "filters"), bits, sum(n for _, n in sizes)))

    def _compact(self, everything: bool = False) -> None:
        """Merge the runs of each level that has ``fanout`` of them, from the first level down; with ``everything``, all runs
        until one is left."""
        depth = 0
        while any(x.depth >= depth for x in self.levels):
            here = [x for x in self.levels if x.depth == depth]
            count = sum(len(x.runs) for x in here)
            if count >= self.fanout or (everything and count and (count > 1 or depth == 0 or any(x.depth > depth for x in self.levels))):
                self.levels = [x for x in self.levels if x.depth != depth]
                self._merge(here, depth + 1)
            depth += 1

    def _merge(self, here: list[Level], depth: int) -> None:
        """Groups of ``fanout`` runs become a run each."""
        runs, rows, at = -(-sum(len(x.runs) for x in here) // self.fanout), None, 0
        for x in here:
            # runs are numbered in their order, over all levels that meet
            order = self.spark.createDataFrame([(r, (at + k) // self.fanout) for k, r in enumerate(x.runs)], "run long, to long")
            now = x.rows.join(F.broadcast(order), "run").drop("run")
            rows, at = now if rows is None else rows.unionByName(now), at + len(x.runs)
        shards = min(MOST_SHARDS, max(1, sum(x.count for x in here) // runs // SHARD_ROWS))
        shard = F.expr(f"cast(conv(hex(substring(digest, 1, 2)), 16, 10) as int) * {shards} div 65536")  # digests are spread evenly
        best = F.min_by("stay", "least") if self.keep == "smallest" else F.max_by("stay", "most")
        dealt = rows.withColumn("shard", F.coalesce(shard, F.lit(0)))
        merged = dealt.groupBy("to", "shard", "digest").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"), F.coalesce(best, F.min("stay")).alias("stay"))
        merged = merged.select(F.col("to").alias("run"), "shard", "digest", "n", "least", "most", "stay")
        merged.repartition("run", "shard").sortWithinPartitions("run", "shard", "digest").write.parquet(path := fresh_path(self.spark, f"run{depth}"))
        merged = self.spark.read.schema(merged.schema).parquet(path).drop("shard")
        self._add(depth, sorted((r.run, r["count"]) for r in merged.groupBy("run").count().collect()), merged)

    def visits(self, digests: DataFrame, level: Level) -> DataFrame:
        """run, digest: the runs of a level that each digest of a table has to visit by the runs' filters."""
        bit = digests.select("digest").distinct().withColumn("b", F.pmod(F.xxhash64("digest"), F.lit(level.bits)))
        met = bit.join(level.filters, F.expr(f"b div {ROW_BITS}") == F.col("part"))
        byte = f"cast(conv(hex(substring(bits, cast((b % {ROW_BITS}) div 8 + 1 as int), 1)), 16, 10) as int)"
        return met.where(F.expr(f"bit_get({byte}, cast(b % 8 as int)) = 1")).select("run", "digest")

    def lookup(self, digests: DataFrame) -> DataFrame:
        """digest, n, least, most of the digests of a table that the index holds."""
        found = None
        for level in self.levels:
            hit = level.rows.join(self.visits(digests, level), ["run", "digest"]).select("digest", "n", "least", "most")
            found = hit if found is None else found.union(hit)
        if found is None:
            return digests.select("digest", F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("least"), F.lit(None).cast("long").alias("most")).limit(0)
        return found.groupBy("digest").agg(F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))

    def merged(self) -> DataFrame | None:
        """Compacts all runs into one: digest, n, least, most, stay. None for an empty index."""
        if sum(len(x.runs) for x in self.levels) > 1 or any(x.depth == 0 for x in self.levels):
            self._compact(everything=True)
        return self.levels[0].rows.drop("run") if self.levels else None


def digests_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), digest(F.coalesce(F.col(text_col), F.lit(""))).alias("digest"))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest=sha256,
                memtable_rows: int = 1 << 20, fanout: int = FANOUT) -> DigestIndex:
    """An index of all rows. ``keep``: smallest or largest identifier."""
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is smallest or largest")
    return DigestIndex(docs.sparkSession, keep, memtable_rows, fanout).append(digests_of(docs, id_col, text_col, digest))


def collisions(docs: DataFrame, merged: DataFrame, text_col: str, digest=sha256) -> DataFrame:
    """Digests that cover different texts: byte verification of every hit. Copies meet in each task
    before anything is shuffled, so a hot text crosses the network once for each task."""
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t")).select("t", digest(F.col("t")).alias("digest"))
    maybe = only_maybe(texts, "digest", merged.where("n > 1").select(F.col("digest").alias("id")))
    return maybe.groupBy("digest").agg(F.min("t").alias("lo"), F.max("t").alias("hi")).where("lo != hi").select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", digest=sha256,
                memtable_rows: int = 1 << 20, fanout: int = FANOUT) -> DataFrame:
    """One row for each input row: id, digest, keep_id, group_size and kept.

    The rows are joined with the digests seen twice; a hot digest is split by adaptive skew joins,
    since only the side of the rows is large."""
    spark = docs.sparkSession
    index = build_index(docs, id_col, text_col, keep, digest, memtable_rows, fanout)
    merged, out = index.merged(), index.slots[0]
    if merged is None:
        return out.select("id", "digest", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    keep_id = F.col("least" if keep == "smallest" else "most").alias("keep_id")
    twice = merged.where("n > 1").select(F.col("digest").alias("d2"), "n", "stay", keep_id)
    bad = stash(spark, collisions(docs, merged, text_col, digest), "collisions")
    clash = bad.count() > 0
    if clash:
        out = out.join(bad, "digest", "left_anti")
    out = out.join(twice, F.col("digest") == F.col("d2"), "left").select(
        "id", "digest", F.coalesce("keep_id", "id").alias("keep_id"), F.coalesce("n", F.lit(1)).alias("group_size"),
        F.coalesce(F.col("stay") == F.col("slot"), F.lit(True)).alias("kept"))
    if clash:
        own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).withColumn("digest", digest(F.col("t")))
        own = stash(spark, own.join(bad, "digest", "left_semi").withColumn("slot", F.monotonically_increasing_id()), "clashing")
        best = F.min_by("slot", "id") if keep == "smallest" else F.max_by("slot", "id")
        by = own.groupBy("t").agg(F.count(F.lit(1)).alias("group_size"), (F.min if keep == "smallest" else F.max)("id").alias("keep_id"),
                                  F.coalesce(best, F.min("slot")).alias("stay"))
        out = out.unionByName(own.join(by, "t").select("id", "digest", "keep_id", "group_size", (F.col("stay") == F.col("slot")).alias("kept")))
    return out


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """``docs`` without its exact copies, all columns as they are. Of equal texts under different identifiers the one that
    ``keep`` names stays; different texts that share an identifier are judged each by itself."""
    spark = docs.sparkSession
    judged = stash(spark, exact_dedup(docs, id_col, text_col, keep), "judged")
    each = judged.where("group_size > 1").groupBy("id", "digest").agg(F.count(F.lit(1)).alias("rows"), F.max("kept").alias("kept"))
    each = each.select(F.col("id").alias("__id"), F.col("digest").alias("__digest"), F.col("rows").alias("__rows"), F.col("kept").alias("__kept"))
    marked = docs.withColumn("__d", sha256(F.coalesce(F.col(text_col), F.lit(""))))
    gone = each.where(~F.col("__kept"))
    out = marked.join(gone, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest")), "left_anti")
    again = each.where("__kept and __rows > 1")
    if not again.isEmpty():  # the same row several times: one of them stays
        on = F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__d") == F.col("__digest"))
        out = out.join(again, on, "left_anti").unionByName(out.join(again, on, "left_semi").dropDuplicates([id_col, "__d"]))
    return out.drop("__d")

"""Mixing sources to target weights by the cube method.

Every source has a target in words; a document is taken floor(r) times plus once more with the
fractional inclusion probability r - floor(r), where r is its source's target over its size. Flight
phases move the vector of probabilities through the null space of the balancing constraints (number of
documents, number of words), three open documents at a time, until at most two of a block are open; the
open ones of all blocks fly again, level by level, until one block for each source is left. In that block ten
documents spread over its sizes wait until the others have flown; with the two that these leave open they are the
landing problem: of their subsets whose number of documents is within one of the expected one, the landing draws among the few
whose words come nearest to the expected words. So a source misses its target by few words, and only
these twelve documents leave their inclusion probabilities.

Blocks are chosen by hashing identifiers, and every draw comes from a seeded generator for its block, so
reruns agree whatever the number of tasks. A block streams through a task that holds three documents; the last
block of a source, of about BLOCK rows without texts, is held whole.

Nulls: a null text has size 0; a null source is a source of its own, after all others; null identifiers are
hashed like any value. Repeated rows are documents of their own. A source without words has target 0 and
is not taken. Empty tables give empty results. Columns other than the three named are ignored.
"""

from __future__ import annotations

import functools
import math
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataq.llm.common import WORD, stash

#: Documents in a block; about two of them stay open.
BLOCK = 512
EPS = 1e-9
#: Documents that wait for the landing, and subsets that it draws among.
WAITING, NEAREST = 10, 4


@functools.cache
def _subsets(n: int) -> np.ndarray:
    return (np.arange(1 << n)[:, None] >> np.arange(n)) & 1


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=(3.0, 1.0, 2.0), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """source, source_size, docs, target for a table of (source, size). Weights repeat over the sources by
    code point, null last; a target stops at ``cap`` times its source's size and what is above is
    shared again by weight. With sources by cap / weight, those are capped before which the shared
    level exceeds their own. The windows run over one row for each source."""
    if not weights or min(weights) <= 0 or not 0 < share <= cap:
        raise ValueError("weights are above 0, and share is above 0 and at most cap")
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    by = by.withColumn("w", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int")))
    by = by.withColumns({"most": F.lit(cap) * F.col("source_size"), "level": F.lit(cap) * F.col("source_size") / F.col("w")})
    every, order = Window.partitionBy(), Window.orderBy("level", F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    by = by.withColumn("shared", (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("w").over(onward))
    # the first source that is not capped sets the level for itself and all after it
    by = by.withColumn("k", F.row_number().over(order))
    by = by.withColumn("line", F.min_by("shared", F.when(F.col("shared") <= F.col("level"), F.col("k"))).over(every))
    target = F.when(F.col("line").isNull() | (F.col("level") <= F.col("line")), F.col("most")).otherwise(F.col("w") * F.col("line"))
    return by.select("source", "source_size", "docs", target.alias("target"))


class _Flight:
    """The open documents of one block: at most two between calls, of which two constraints leave one direction."""

    def __init__(self, seed: str):
        self.draw, self.open = random.Random(seed).random, []

    def add(self, p: float, size: float, row):
        """Returns the rows that this document's arrival decides, as (row, 0 or 1)."""
        self.open.append([p, size, row])
        done = []
        while True:
            for u in [u for u in self.open if not EPS < u[0] < 1 - EPS]:
                self.open.remove(u)
                done.append((u[2], int(u[0] > 0.5)))
            if len(self.open) < 3:
                return done
            (_, a, _), (_, b, _), (_, c, _) = self.open
            d = (1.0, -1.0, 0.0) if a == b else (c - b, a - c, b - a)  # the null space of counts and words
            up = min((1 - u[0]) / x if x > 0 else u[0] / -x for u, x in zip(self.open, d, strict=True) if x)
            down = min(u[0] / x if x > 0 else (1 - u[0]) / -x for u, x in zip(self.open, d, strict=True) if x)
            step = up if self.draw() * (up + down) < down else -down
            for u, x in zip(self.open, d, strict=True):
                u[0] = min(1.0, max(0.0, u[0] + step * x))

    def land(self, waiting):
        """Decide the open documents and those that waited (p, size, row)."""
        every = [*self.open, *waiting]
        if not every:
            return []
        p, size = np.array([u[0] for u in every]), np.array([u[1] for u in every])
        sets = _subsets(len(every))
        sets = sets[np.abs(sets.sum(1) - p.sum()) < 1 + EPS]
        near = np.argsort(np.abs(sets @ size - p @ size), kind="stable")[:NEAREST]
        taken = sets[near[int(self.draw() * len(near))]]
        return [(u[2], int(x)) for u, x in zip(every, taken, strict=True)]


def _whole_block(flight: _Flight, rows: list[dict]):
    """Fly and land the last block of a source; its rows come by falling size."""
    open_ = [k for k, r in enumerate(rows) if EPS < r["p"] < 1 - EPS]
    n = min(WAITING, len(open_))
    waits = {open_[(2 * k + 1) * len(open_) // (2 * n)] for k in range(n)}
    done = [d for k, r in enumerate(rows) if k not in waits for d in flight.add(r["p"], float(r["size"]), r)]
    return done + flight.land([(rows[k]["p"], float(rows[k]["size"]), rows[k]) for k in sorted(waits)])


def _fly(level: int, seed: int, last: bool):
    def run(batches):
        block, flight, held, schema = None, None, [], None

        def close():
            if last:
                return [{**r, "x": x, "p": float(x)} for r, x in _whole_block(flight, held)]
            return [{**r, "p": p, "x": None} for p, _, r in flight.open]

        for batch in batches:
            out, schema = [], batch.schema
            for r in batch.to_pylist():
                key = (r["source"], r["block"])
                if key != block:
                    if flight is not None:
                        out.extend(close())
                    block, flight, held = key, _Flight(f"{seed}/{level}/{key!r}"), []
                if last:
                    held.append(r)
                else:
                    out.extend({**d, "x": x, "p": float(x)} for d, x in flight.add(r["p"], float(r["size"]), r))
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
        if flight is not None and (out := close()):
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=(3.0, 1.0, 2.0),
        share: float = 1.5, cap: float = 2.0, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """One row for each document: id, source, size, source_size, target, copies, taken (copies times size) and row (a hash of
    identifier, text and source)."""
    spark = docs.sparkSession
    row = F.xxhash64(id_col, text_col, source_col).alias("row")
    sizes = stash(spark, docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words(F.col(text_col)).alias("size"), row), "sizes")
    plan = stash(spark, targets(sizes, weights, share, cap), "targets")
    r = F.when(F.col("source_size") > 0, F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    rows = sizes.join(plan.withColumnRenamed("source", "s2"), F.col("source").eqNullSafe(F.col("s2"))).drop("s2")
    rows = rows.withColumn("r", r).withColumn("base", F.floor(F.col("r") + EPS).cast("int"))
    rows = rows.withColumns({"p": F.greatest(F.col("r") - F.col("base"), F.lit(0.0)), "x": F.lit(None).cast("int")})
    rows = rows.select("id", "source", "size", "source_size", "docs", "target", "base", "p", "x", "row")
    most, decided = plan.agg(F.max("docs")).first()[0] or 0, []
    level = 0
    while True:
        # a level's blocks follow from the documents of a source, not from what is open, and so agree in reruns
        left = math.ceil(most / (block / 2) ** level)
        last = left <= block
        count = F.lit(1) if last else F.greatest(F.lit(1), F.ceil(F.col("docs") / F.lit(float(block) * (block / 2) ** level)))
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "size", F.lit(level)), count.cast("long")))
        dealt = dealt.repartition("source", "block").sortWithinPartitions("source", "block", F.desc("size"), "id")
        flown = stash(spark, dealt.mapInArrow(_fly(level, seed, last), dealt.schema), f"flight{level}").drop("block")
        decided.append(flown.where("x is not null"))
        if last:
            break
        rows, level = flown.where("x is null"), level + 1
    out = decided[0]
    for d in decided[1:]:
        out = out.unionByName(d)
    copies = F.col("base") + F.col("x")
    return out.select("id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"), "row")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: the documents that are taken, all their columns, and size, source_size, target, copies and taken. Rows
    that repeat identifier, text and source come once, with the copies of all of them."""
    plan = mix(docs, id_col, text_col, source_col, **how)
    added = {"size": F.first("size"), "source_size": F.first("source_size"), "target": F.first("target"), "copies": F.sum("copies").cast("int"), "taken": F.sum("taken")}
    plan = plan.where("copies > 0").groupBy(F.col("row").alias("__row")).agg(*(c.alias(f"__{n}") for n, c in added.items()))
    own = docs.withColumn("__r", F.xxhash64(id_col, text_col, source_col))
    repeated = stash(docs.sparkSession, own.groupBy("__r").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("__r").alias("__again")), "repeated")
    if not repeated.isEmpty():
        on = F.col("__r") == F.col("__again")
        own = own.join(repeated, on, "left_anti").unionByName(own.join(repeated, on, "left_semi").dropDuplicates(["__r"]))
    out = own.join(plan, F.col("__r") == F.col("__row"))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c not in added), *(F.col(f"__{n}").alias(n) for n in added))

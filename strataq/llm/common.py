"""What the operators share: the cluster's shared folder, written tables and byte-level word splitting."""

from __future__ import annotations

import functools
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of bytes other than space and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


@functools.cache
def _own_dir() -> str:
    return "file://" + tempfile.mkdtemp(prefix="strataq-")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all machines share; where it is unset and Spark runs
    in one process, a folder of our own."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return _own_dir()


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{shared_dir(spark)}/strataq-{what}-{uuid.uuid4().hex}"


def stash(spark: SparkSession, df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` in the shared folder and read it again, so that a lost executor costs no recomputation."""
    df.write.parquet(path := fresh_path(spark, what))
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed = path
    return out


def unstash(*tables: DataFrame) -> None:
    """Delete written tables that nothing later reads."""
    for df in tables:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(df.stashed)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


#: Multipliers by position in a word (mod 64), fixed by a seed so that hashes agree everywhere.
_MULT = np.random.default_rng(20240501).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that all bits of a hash depend on all bits of its input."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_spans(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in bytes ``b``."""
    gap = _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], gap, [True])).view(np.int8)))
    return edge[0::2], edge[1::2]


def words_of(texts: list[np.ndarray], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Of several texts as bytes: a 64-bit hash for each word, and the number of words in each text. With
    ``lower``, A-Z count as a-z."""
    sizes = np.array([len(t) for t in texts], np.int64)
    gap = np.full(1, 0x20, np.uint8)
    b = np.concatenate([x for t in texts for x in (t, gap)]) if texts else np.zeros(0, np.uint8)
    s, e = word_spans(b)
    counts = np.diff(np.searchsorted(s, np.concatenate(([0], np.cumsum(sizes + 1)))))
    if not len(s):
        return np.zeros(0, np.uint64), counts
    n = e - s
    at = np.concatenate(([0], np.cumsum(n)[:-1]))
    inside = np.arange(n.sum()) - np.repeat(at, n)
    v = b[inside + np.repeat(s, n)]
    v = (_LOWER[v] if lower else v).astype(np.uint64) + np.uint64(1)
    h = v * _MULT[inside & 63]
    if n.max() > 64:  # beyond 64 bytes the multiplier turns, so that long words with swapped parts differ
        h = h * (np.uint64(2) * (inside >> 6).astype(np.uint64) + np.uint64(1))
    return mix64(np.add.reduceat(h, at) + n.astype(np.uint64)), counts


def word_hashes(b: np.ndarray, lower: bool) -> np.ndarray:
    return words_of([b], lower)[0]


def chunks(columns, most: int = 1 << 19):
    """The texts of Arrow string columns in lists of about ``most`` bytes."""
    for column in columns:
        held, size = [], 0
        for b in batch_bytes(column):
            held.append(b)
            size += len(b)
            if size >= most:
                yield held
                held, size = [], 0
        if held:
            yield held


def text_bytes(value) -> np.ndarray:
    """A text as bytes; null is empty."""
    return np.frombuffer(b"" if value is None else value if isinstance(value, bytes) else value.encode("utf-8"), np.uint8)


def batch_bytes(column):
    """The UTF-8 bytes of each text in an Arrow string column, without copies; null is empty."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if not len(column):
        return
    off = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None and column.buffers()[2].size else np.zeros(0, np.uint8)
    null = column.is_null().to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield data[0:0] if null[k] else data[off[k]: off[k + 1]]


#: Rows of partial sums that one task adds up; more are added level by level.
FAN = 32


def sum_tables(parts: DataFrame, dtype=np.float64) -> dict[int, np.ndarray]:
    """The sums by piece of a written table of partial ones (piece int, part int, sums binary of ``dtype``), one row for each
    piece and task. Partial sums meet in a tree of FAN rows a task, so no task reads more than that however many there are;
    the driver gets one row for each piece. Floats are added in double precision."""
    from pyspark.sql import functions as F

    wide = np.dtype(np.float64 if np.issubdtype(dtype, np.floating) else dtype)

    def adding(kind):
        def add(batches):
            import pyarrow as pa

            total: dict[tuple, np.ndarray] = {}
            for batch in batches:
                for piece, part, sums in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    x = np.frombuffer(sums, kind).astype(wide)
                    total[piece, part] = total[piece, part] + x if (piece, part) in total else x
            if total:
                keys = list(total)
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([total[k].tobytes() for k in keys], pa.binary())], names=["piece", "part", "sums"])

        return add

    spark, left = parts.sparkSession, (parts.agg(F.max("part")).first()[0] or 0) + 1
    while True:
        left = -(-left // FAN)
        met = parts.select("piece", F.expr(f"cast(part % {left} as int)").alias("part"), "sums").repartition("piece", "part").sortWithinPartitions("piece", "part")
        met, dtype = met.mapInArrow(adding(dtype), "piece int, part int, sums binary"), wide
        if left == 1:
            return {r.piece: np.frombuffer(r.sums, wide) for r in met.collect()}
        parts = stash(spark, met, "sums")


#: Bits of a filter of keys: at least, at most (a million rows of two numbers), and for each key.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 18, 1 << 26, 10


def mark_maybe(df: DataFrame, keys: DataFrame, marks: dict[str, str]) -> DataFrame:
    """``df`` with a boolean column for each of ``marks`` (column to key): whether the key may be in the written table ``keys``
    (column id). A bit filter sized by the number of keys is broadcast, so that most other rows can go before any
    shuffle; the join that follows decides. A null key is not there. A filter at its largest size fills up as keys grow, and is left
    out where it would tell next to nothing."""
    from pyspark.sql import functions as F

    n, bits = keys.count(), LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    if n > 2 * MOST_BITS:
        return df.withColumns({mark: F.col(key).isNotNull() for mark, key in marks.items()})
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    rows = keys.select(place("id").alias("b")).groupBy(F.expr("b div 64").alias("__w")).agg(F.expr("bit_or(shiftleft(1L, cast(b % 64 as int)))").alias("__v"))
    rows = stash(df.sparkSession, rows, "filter")
    for mark, key in marks.items():
        df = df.withColumn("__b", place(F.col(key))).join(F.broadcast(rows), F.expr("__b div 64") == F.col("__w"), "left")
        df = df.withColumn(mark, F.col(key).isNotNull() & F.expr("coalesce(bit_get(__v, cast(__b % 64 as int)), 0) = 1")).drop("__b", "__w", "__v")
    return df


def only_maybe(df: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key may be in ``keys``."""
    return mark_maybe(df, keys, {"__may": key}).where("__may").drop("__may")


#: Edges of a graph that one task contracts at once.
ONE_TASK = 1 << 17


def _contracted(batches):
    """node, to (the smallest node reachable) of all edges that it gets."""
    import pyarrow as pa

    up: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x

    for batch in batches:
        for a, b in zip(*(batch.column(k).to_pylist() for k in range(2)), strict=True):
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    if up:
        yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([top(x) for x in list(up)], pa.int64())], names=["node", "to"])


def components(spark: SparkSession, links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """node, component (the smallest node reachable) of the graph of ``links`` (a, b: long). Each round every node
    is contracted into the neighbour, or itself, that comes first in a random order; long chains too shrink by
    a fraction a round. Once at most ``one_task`` edges are left, one task contracts them all. Every round is a written table."""
    from pyspark.sql import functions as F

    edges = stash(spark, links.where("a != b").select("a", "b"), "edges")
    found = None
    while left := edges.count():
        if left <= one_task:
            to = stash(spark, edges.coalesce(1).mapInArrow(_contracted, "node long, to long"), "hooks")
            if found is None:
                unstash(edges)
                return to.withColumnRenamed("to", "component")
            last, found = found, stash(spark, found.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select("node", F.coalesce("next", "to").alias("to")), "labels")
            unstash(last, to)
            break
        both = edges.union(edges.select("b", "a"))
        key = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))
        to = both.groupBy("a").agg(F.min(key("b")).alias("m")).select(F.col("a").alias("node"), F.least("m", key("a"))["v"].alias("to"))
        to, last = stash(spark, to, "hooks"), found
        # nodes that a round leaves alone have no hook of their own and stay as they are
        found = to if found is None else stash(spark, found.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select("node", F.coalesce("next", "to").alias("to")), "labels")
        one = edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        edges, old = stash(spark, one.where("x != y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges"), edges
        unstash(old, *([last, to] if last is not None else []))
    if found is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    small = found.groupBy("to").agg(F.min("node").alias("component"))
    out = stash(spark, found.join(small, "to").select("node", "component"), "components")
    unstash(edges, found)
    return out

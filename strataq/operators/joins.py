"""Equi-joins. The strategy (broadcast, shuffled hash, sort-merge, skew split) is Spark's choice from
sizes it measures; nothing is hinted. Where keys repeat on both sides the rows out, not those in, are the work: ``many``
deals the driving rows over the cluster first, for Spark counts tasks by the bytes that they read, and ``tiled`` makes
the rows out in an order that columnar files store in few bytes."""

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataq.errors import UnsupportedJoin
from strataq.operators.predicates import all_, member, ref

KINDS = {"inner": "inner", "left": "left", "right": "right", "full": "full"}
#: Rows in a tile, at most. The left side's values stand still for a tile of the right side, whose values come again after as many rows.
TILE = 256
#: Parts that a key's driving rows are dealt over; the other side's tiles go to each.
PARTS = 16


def _tasks(df: DataFrame) -> int:
    """As many tasks as a shuffle has, and some for each core."""
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)


def dealt(df: DataFrame) -> DataFrame:
    """The rows in turn over many tasks; no key decides where a row goes."""
    return df.repartition(_tasks(df))


def _tiles(df: DataFrame, name: str, columns, keys, to: str, deal: bool) -> DataFrame:
    """The rows as arrays ``to`` of at most TILE with equal keys ``__0``, ``__1``, ... A key's rows are counted by one task, or, dealt,
    by one for each ``__part``, which hangs on the row's values alone: a task that runs again moves no row. Sorts go to disk if they must."""
    on = [f"__{i}" for i in range(len(keys))]
    hashed = [member(name, c) for c in dict.fromkeys([*keys, *columns]) if not any(x in df.select(member(name, c)).dtypes[0][1] for x in ("map<", "variant"))]
    rows = df.select(*(member(name, k).alias(x) for x, k in zip(on, keys)), F.pmod(F.xxhash64(*hashed), F.lit(PARTS)).cast("int").alias("__part"),
                     F.struct(*(member(name, c) for c in columns)).alias("__row"))
    if deal:
        on.append("__part")
        rows = rows.repartition(_tasks(df), *on)
    rows = rows.withColumn("__tile", F.floor((F.row_number().over(Window.partitionBy(*on).orderBy(F.lit(0))) - 1) / TILE))
    made = F.collect_list("__row")  # of structs, for it drops nulls; the values of a column alone need none from then on
    return rows.groupBy(*on, "__tile").agg((made if len(columns) > 1 else made[columns[0]]).alias(to)).drop("__tile")


def tiled(left: DataFrame, right: DataFrame, names, wanted, pairs, kind: str) -> DataFrame | None:
    """The join of two single tables under ``names`` by tiles: arrays of rows with equal keys are joined, then laid out row by row. One side's
    values stand still for a tile while the other's come round again and again, and files of runs and dictionaries hold such rows in a
    fraction of a byte. The driving side's tiles are dealt by key and part; the others meet them once in each part. Columns
    that ``wanted`` can mean (None: all) are kept. None is returned where names or the kind need the plain join."""
    frames = (left, right)
    lower = [[c.lower() for c in df.columns] for df in frames]

    def names_of(i):
        return {f"{names[i]}.{c}": c for c in frames[i].columns} | {c: c for c in frames[i].columns if c.lower() not in lower[1 - i]}

    own = [names_of(0), names_of(1)]
    pairs = [(a, b) if a in own[0] else (b, a) for a, b in pairs]
    if kind == "full" or not all(a in own[0] and b in own[1] for a, b in pairs) or any(len(set(x)) < len(x) for x in lower):
        return None
    if not all(re.fullmatch(r"\w+", x) for x in (*names, *left.columns, *right.columns)):
        return None
    keys, drives = ([own[0][a] for a, _ in pairs], [own[1][b] for _, b in pairs]), int(kind == "right")
    said = None if wanted is None or "`" in "".join(wanted) else {x for w in wanted for x in w.lower().split(".")}
    kept = [[c for c in df.columns if said is None or c.lower() in said] or keys[i][:1] for i, df in enumerate(frames)]
    sides = [_tiles(df, names[i], kept[i], keys[i], f"__rows{i}", i == drives) for i, df in enumerate(frames)]
    sides[1 - drives] = sides[1 - drives].withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    sides = [df.alias(f"__side{i}") for i, df in enumerate(sides)]
    on = [*(f"__{i}" for i in range(len(pairs))), "__part"]
    met = sides[0].join(sides[1], all_(*(member("__side0", c) == member("__side1", c) for c in on)), KINDS[kind]).select("__rows0", "__rows1")
    # lateral views give the columns back under both tables' names, which no method of a frame does
    lists = [[f"`{c}`" for c in cs] for cs in kept]
    views = [f"LATERAL VIEW {'' if kind == 'inner' else 'OUTER '}{'inline' if len(cs) > 1 else 'explode'}(__rows{i}) `{names[i]}` AS {', '.join(cs)}" for i, cs in enumerate(lists)]
    return left.sparkSession.sql(f"SELECT {', '.join(f'`{names[i]}`.{c}' for i, cs in enumerate(lists) for c in cs)} FROM {{met}} {' '.join(views)}", met=met)


def join_pairs(left: DataFrame, right: DataFrame, pairs, kind: str = "inner", many: bool = False, names=None, wanted=None) -> DataFrame:
    """Join on an AND of equalities of qualified names. A NULL in any part of a key matches nothing. ``many``: most
    rows match many others; rows out stream from small tables by many tasks. A full join takes no notice of it.
    ``names``: those of two single tables whose joined rows are all that is asked for; the join may then go by tiles."""
    if kind not in KINDS:
        raise UnsupportedJoin(f"join kind {kind!r} is not one of {', '.join(KINDS)}")
    pairs = list(pairs)
    if not pairs:
        raise UnsupportedJoin("a join needs at least one pair of columns")
    for pair in pairs:
        if len(pair) != 2 or not all(isinstance(x, str) for x in pair):
            raise UnsupportedJoin("ON takes equalities between columns only")
    if many and names and (df := tiled(left, right, names, wanted, pairs, kind)) is not None:
        return df
    if many and kind == "right":
        right = dealt(right)
    elif many and kind != "full":
        left = dealt(left)
    return left.join(right, all_(*(ref(a) == ref(b) for a, b in pairs)), KINDS[kind])

"""Benchmark decontamination by spaced-seed hashing, in DataFrame operations only.

Words are lower-cased runs of letters and digits. A fixed mask picks four of five adjacent words; the
hash of the picked words is a seed. Seeds of the benchmark are joined with those of the documents. A hit says on which diagonal a
document lies beside an item (at which distance equal words stand); each diagonal of a document and an item is then scored once, along
their whole common stretch, 1 for an equal word and -2 for another. An overlap counts
from a best stretch of ``min_score`` on, or when all but one in ``RATE`` of the item's words are equal.

No overlap lacks a seed. A stretch without one has runs of at most four equal words, runs of three or four before two
others, and scores 4 at most; and one in ``RATE`` words substituted leave items of more than ``SHORT`` words a seed
(tried for all placements in 11, 12 and 18 words; longer items have such a part). Shorter items have seeds of their
own, of all words but one (of all, below ``RATE`` words); documents are searched for the lengths that the benchmark has. Words that are added or left out end an overlap.

Seeds are three numbers each, in proportion to the benchmark's words; an item's words are held once. Benchmarks of up to
``inline_seeds`` seeds are broadcast; larger ones meet the documents' seeds by a shuffle, which skew joins split where one seed
is in very many documents, after a bit filter. Documents are shuffled only if they share a seed with an item.

Nulls: null and empty texts have no words and no hits; rows with a null identifier are judged and returned
as such. Items of any length from one word on are found; repeated items count once. Repeated rows hit alike and give
one row for each pair of identifiers. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataq.llm.common import only_maybe, stash

#: Offsets of the words that count, in windows of SPAN words.
MASKS = ((0, 1, 2, 4),)
SPAN = 5
#: One word in RATE may be another; items of up to SHORT words have masks by their length.
RATE, SHORT = 6, 10


def word_codes(text: Column) -> Column:
    """The words as 64-bit hashes."""
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<bigint>")).otherwise(F.transform(F.split(clean, " "), lambda w: F.xxhash64(w)))


def _seed(codes: str, i: str, mask: tuple[int, ...]) -> str:
    return f"xxhash64('{mask}', {', '.join(f'{codes}[{i} + {o}]' for o in mask)})"


def short_masks(n: int) -> list[tuple[int, ...]]:
    """The masks of items of ``n`` words, up to SHORT."""
    return [tuple(range(n))] if n < RATE else [tuple(o for o in range(n) if o != gone) for gone in range(n)]


def benchmark_items(bench: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item, codes, key (one number for each distinct item and text that has words)."""
    items = bench.select(F.col(id_col).alias("item"), word_codes(F.col(text_col)).alias("codes")).where(F.size("codes") > 0)
    return items.dropDuplicates(["item", "codes"]).withColumn("key", F.monotonically_increasing_id())


def item_seeds(items: DataFrame) -> DataFrame:
    """seed, key, at (position of the window in the item)."""
    at = F.explode(F.expr(f"if(size(codes) > {SHORT}, sequence(0, size(codes) - {SPAN}), array(0))")).alias("at")
    by_size = " ".join(f"when {n} then array({', '.join(_seed('codes', 'at', m) for m in short_masks(n))})" for n in range(1, SHORT + 1))
    seeds = F.expr(f"case size(codes) {by_size} else array({', '.join(_seed('codes', 'at', m) for m in MASKS)}) end")
    return items.select("key", "codes", at).select("key", "at", F.explode(seeds).alias("seed"))


def document_seeds(sizes: list[int]) -> Column:
    """Of a column ``words``: an array of seeds by position, for each mask; ``sizes`` are the lengths of short items."""
    masks = [(SPAN, m) for m in MASKS] + [(n, m) for n in sizes for m in short_masks(n)]
    each = [f"if(size(h) >= {n}, transform(sequence(0, size(h) - {n}), i -> {_seed('h', 'i', m)}), cast(array() as array<bigint>))" for n, m in masks]
    return F.expr(f"flatten(transform(array(words), h -> array({', '.join(each)})))")  # the outer transform binds the words once


#: Of a diagonal d: the best stretch's score, and the equal words in all. The item's word k lies beside the document's word d + k.
_ALONG = """aggregate(
    if(least(size(codes), size(words) - d) > greatest(0, -d), sequence(greatest(0, -d), least(size(codes), size(words) - d) - 1), cast(array() as array<int>)),
    struct(0 as cur, 0 as score, 0 as matched),
    (a, k) -> if(words[d + k] = codes[k], struct(a.cur + 1 as cur, greatest(a.score, a.cur + 1) as score, a.matched + 1 as matched),
                 struct(greatest(0, a.cur - 2) as cur, a.score as score, a.matched as matched)))"""


def decontaminate(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", min_score: int = 10, inline_seeds: int = 200_000) -> DataFrame:
    """One row for each document and item that overlap: id, item, score, matched (equal words along the best diagonal)."""
    spark = docs.sparkSession
    items = stash(spark, benchmark_items(bench, item_col, item_text_col), "items")
    seeds = stash(spark, item_seeds(items), "seeds")
    n, sizes = seeds.count(), sorted(r.n for r in items.select(F.size("codes").alias("n")).where(f"n <= {SHORT}").distinct().collect())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).withColumn("row", F.xxhash64("id", "t"))
    met = rows.select("row", word_codes(F.col("t")).alias("words")).select("row", F.explode(document_seeds(sizes)).alias("own"))
    met = met.select("row", F.posexplode("own").alias("i", "seed"))
    if n > inline_seeds:
        met = only_maybe(met, "seed", seeds.select(F.col("seed").alias("id")))
    met = met.join(F.broadcast(seeds) if n <= inline_seeds else seeds, "seed")
    met = stash(spark, met.groupBy("row", "key").agg(F.collect_set(F.col("i") - F.col("at")).alias("diagonals")), "diagonals")
    near = only_maybe(rows, "row", met.select(F.col("row").alias("id")).distinct()).select("id", "row", word_codes(F.col("t")).alias("words"))
    pairs = met.join(items, "key").join(near, "row")
    along = F.explode(F.expr(f"transform(diagonals, d -> {_ALONG})")).alias("s")
    scored = pairs.select("id", "item", F.size("codes").alias("size"), along).where(f"s.score >= {min_score} or s.matched >= size - size div {RATE}")
    return scored.groupBy("id", "item").agg(F.max("s.score").alias("score"), F.max("s.matched").alias("matched"))


def drop_contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows that overlap an item, all columns as they are. Rows are judged one by one, also where
    different texts share an identifier."""
    own = docs.withColumn("__row", F.xxhash64(id_col, text_col))
    text = F.col(text_col).alias(text_col)
    judged = decontaminate(own.select(F.col("__row").alias("__id"), text), bench, "__id", text_col, **how)
    bad = stash(docs.sparkSession, judged.select(F.col("id").alias("__bad")).distinct(), "leaks")
    return own.join(bad, F.col("__row") == F.col("__bad"), "left_anti").drop("__row")

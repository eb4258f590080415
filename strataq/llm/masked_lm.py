"""Masked pseudo-likelihood: a bidirectional window network predicts every word from two words on each side.

Words are hashed to 8,192 cells: a path of three choices, among 16, 16 and 32 (LEVELS). The hidden layer is tanh of the sum of
one learned vector for each neighbour's cell and its place; from it come the choices of the word's path, each on top of
log-frequencies of the corpus given the choices before it. The word within its cell comes from a vocabulary of all words and their counts:
log p(word | neighbours) = log p(cell | neighbours) + log p(word | cell). A document's score is the sum over its words.

Documents are dealt by a hash of identifier and text to blocks of about ``BLOCK`` bytes, whose number follows from the corpus and
whose order within is fixed. Training goes in synchronous rounds over growing shares of the blocks (ROUNDS), so that every
word of every document is predicted once. In a round each block trains by itself, from the parameters that the round before ended with; the
results are averaged by words. So neither the number of tasks nor the layout of the input changes a score, but for
the order in which floats are added. A task that has several blocks adds up their results; the sums of all tasks
meet in a tree, and the driver holds one network (2 MB).

The vocabulary holds every distinct word (as a 64-bit hash) and grows with the corpus; it is a written table. Words seen
once give half a count, and each cell ``FLOOR`` besides, to the rest: what a cell's unseen words have together. To
score, a block's distinct words are joined with the vocabulary and come before its documents.

Nulls: null and empty texts have no words and score 0. Texts are read whole; a document of one word is predicted
from padding. Repeated rows score alike, and meet in one block, which streams. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.llm.common import chunks, stash, sum_tables, words_of

LEVELS = (16, 16, 32)
WORDS, CHOICES, HIDDEN, PLACES = int(np.prod(LEVELS)), sum(LEVELS), 16, (-2, -1, 1, 2)
BATCH, PIECES = 8192, 16
#: The largest weight of a choice: no sum of HIDDEN of them overflows.
LARGEST = 5.0
#: Bytes of text in a block, and texts worked on at once.
BLOCK, AT_ONCE = 8 << 20, 1 << 20
#: Rounds of training, as the sixteenth of the blocks at which each ends.
ROUNDS = (1, 4, 16)
FLOOR = 1e-4
_SHAPES = ((len(PLACES), WORDS + 1, HIDDEN), (HIDDEN,), (HIDDEN, CHOICES))
_ENDS = np.cumsum(LEVELS)
#: Which choices belong to which level.
_LEVEL = np.repeat(np.eye(len(LEVELS), dtype=np.float32), LEVELS, axis=0)
SIZE = sum(int(np.prod(s)) for s in _SHAPES)


class Model(tuple):
    """(params, frequencies), with ``vocab`` (word, logp: log p(word | cell)), ``rest`` (by cell, of its unseen words), and of
    the texts it was fitted to the number of ``blocks`` and ``words`` (block, word)."""

    vocab: DataFrame
    rest: np.ndarray
    blocks: int
    words: DataFrame


def start(seed: int = 3) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [(rng.normal(0, 0.1, s) if len(s) > 1 else np.zeros(s)).astype(np.float32) for s in _SHAPES]


def _split(flat: np.ndarray) -> list[np.ndarray]:
    at = np.cumsum([0, *(int(np.prod(s)) for s in _SHAPES)])
    return [flat[a: z].reshape(s).astype(np.float32) for s, a, z in zip(_SHAPES, at[:-1], at[1:], strict=True)]


def _frequencies(counts: np.ndarray) -> np.ndarray:
    """By the first two choices: log-frequencies of all choices, the second given the first, the third given both."""
    c = counts.reshape(LEVELS) + 0.5
    given = lambda x: np.log(x / x.sum(-1, keepdims=True))
    rows = np.empty((*LEVELS[:2], CHOICES), np.float32)
    rows[..., : _ENDS[0]] = given(c.sum((1, 2)))
    rows[..., _ENDS[0]: _ENDS[1]] = given(c.sum(2))[:, None]
    rows[..., _ENDS[1]:] = given(c)
    return rows.reshape(-1, CHOICES)


def _path(cells: np.ndarray) -> tuple[np.ndarray, ...]:
    """The three choices of each cell, as places among all choices."""
    first, third = np.divmod(cells, LEVELS[2])
    first, second = np.divmod(first, LEVELS[1])
    return first, second + _ENDS[0], third + _ENDS[1]


def _windows(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words' cells, padded between texts; the places of real words; words in each text."""
    return _laid(*words_of(texts, lower=True))


def _laid(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    pad = max(PLACES)
    at = np.arange(len(h)) + np.repeat(np.arange(len(counts)) * pad + pad, counts)
    line = np.full(len(h) + pad * (len(counts) + 1), WORDS, np.int64)
    line[at] = (h % np.uint64(WORDS)).astype(np.int64)
    return line, at, counts


def log_probs(params, freq, line: np.ndarray, at: np.ndarray, block: int = 4096) -> np.ndarray:
    """log p of the cells at places ``at``, given their neighbours."""
    table, bias, weights = params
    out = np.empty(len(at))
    for k in range(0, len(at), block):
        i = at[k: k + block]
        hid = bias + table[0].take(line[i + PLACES[0]], 0)
        for j, place in enumerate(PLACES[1:], 1):
            hid += table[j].take(line[i + place], 0)
        np.tanh(hid, out=hid)
        x, r = hid @ weights, np.arange(len(i))
        x += freq.take(line[i] // LEVELS[2], 0)
        picked = sum(x[r, c] for c in _path(line[i]))
        np.exp(x, out=x)
        out[k: k + block] = picked - np.log(x @ _LEVEL).sum(1)
    return out


def train(params, freq, line: np.ndarray, at: np.ndarray, squares, rate: float = 0.08) -> None:
    """One pass of Adagrad over the words at ``at``, in place."""
    vectors, old = params[0].reshape(-1, HIDDEN), squares[0].reshape(-1, HIDDEN)
    for k in range(0, len(at), BATCH):
        i = at[k: k + BATCH]
        ctx = np.concatenate([line[i + place] + j * (WORDS + 1) for j, place in enumerate(PLACES)]).astype(np.uint16)
        hid = vectors.take(ctx, 0).reshape(len(PLACES), len(i), HIDDEN).sum(0)
        hid += params[1]
        np.tanh(hid, out=hid)
        r, g = np.arange(len(i)), hid @ params[2]
        g += freq.take(line[i] // LEVELS[2], 0)
        np.exp(g, out=g)
        g *= (1 / (g @ _LEVEL)) @ _LEVEL.T
        for c in _path(line[i]):
            g[r, c] -= 1
        g *= np.float32(1 / len(i))
        back = g @ params[2].T
        back *= 1 - hid * hid
        for p, s, x in ((params[2], squares[2], hid.T @ g), (params[1], squares[1], back.sum(0))):
            s += x * x
            p -= rate * x / np.sqrt(s + 1e-8)
        np.clip(params[2], -LARGEST, LARGEST, out=params[2])
        order = np.argsort(ctx, kind="stable")  # equal vectors side by side; a radix sort
        ctx = ctx[order]
        first = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1])))
        rows, g = ctx[first], np.add.reduceat(back.take(order % len(i), 0), first, axis=0)
        q = old[rows] + g * g
        old[rows] = q
        vectors[rows] -= rate * g / np.sqrt(q + 1e-8)


_LEARNT = pa.schema([("piece", pa.int32()), ("part", pa.int32()), ("sums", pa.binary()), ("block", pa.int64()), ("word", pa.int64()), ("n", pa.int64())])


def _words_out(block: int, held: list):
    """Rows of a block's distinct words and their counts."""
    words, inverse = np.unique(np.concatenate([w for w, _ in held]), return_inverse=True)
    n = np.bincount(inverse, np.concatenate([c for _, c in held]), len(words)).astype(np.int64)
    for k in range(0, len(words), 1 << 17):
        part = slice(k, k + (1 << 17))
        m = len(words[part])
        none = pa.nulls(m, pa.int32())
        yield pa.RecordBatch.from_arrays([none, none, pa.nulls(m, pa.binary()), pa.array(np.full(m, block)), pa.array(words[part].view(np.int64)), pa.array(n[part])], schema=_LEARNT)


def _by_block(batches):
    """(block, texts) of rows that come sorted by block, the texts in lists of about AT_ONCE bytes."""
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        cut = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            for texts in chunks([batch.column(1).slice(a, z - a)], AT_ONCE) if z > a else ():
                yield int(blocks[a]), texts


def _learn(held):
    """Sums of the networks that each block of a task ends with, in pieces, and each block's words and counts."""
    def run(batches):
        from pyspark import TaskContext

        total, seen, words = np.zeros(SIZE), np.zeros(WORDS), 0.0
        params = squares = own = found = now = freq = None

        def close():
            nonlocal words
            n = own.sum()
            if n:
                total.__iadd__(np.concatenate([p.reshape(-1) for p in params]) * n)
                seen.__iadd__(own)
                words += n
                yield from _words_out(now, found)

        for block, texts in _by_block(batches):
            if block != now:
                if now is not None:
                    yield from close()
                params, before = [p.copy() for p in held.value[0]], held.value[1]
                squares, own, found, now = [np.zeros_like(p) for p in params], np.zeros(WORDS), [], block
            h, counts = words_of(texts, lower=True)
            line, at, _ = _laid(h, counts)
            if len(at):
                own += np.bincount(line[at], minlength=WORDS)
                found.append(np.unique(h, return_counts=True))
                if len(found) > 15:
                    u, inverse = np.unique(np.concatenate([w for w, _ in found]), return_inverse=True)
                    found = [(u, np.bincount(inverse, np.concatenate([c for _, c in found]), len(u)))]
                freq = _frequencies(before + own)
                train(params, freq, line, at, squares)
        if now is not None:
            yield from close()
        if words:
            flat = np.concatenate((total, seen, [words]))
            sums, n = [x.tobytes() for x in np.array_split(flat, PIECES)], PIECES
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([TaskContext.get().partitionId()] * n, pa.int32()), pa.array(sums, pa.binary()),
                                              *(pa.nulls(n, pa.int64()) for _ in range(3))], schema=_LEARNT)

    return run


def vocabulary(counts: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """Of words and counts: the written table of log p(word | cell), and log p of the rest of each cell."""
    spark = counts.sparkSession
    words = stash(spark, counts.groupBy("word").agg(F.sum("n").alias("n")).withColumn("cell", F.expr(f"cast(pmod(word, {WORDS}) as int)")), "words")
    cells = stash(spark, words.groupBy("cell").agg(F.sum("n").alias("all"), F.count_if(F.col("n") == 1).alias("once")), "cells")
    rest = np.zeros(WORDS)
    for r in cells.collect():
        rest[r.cell] = np.log((r.once / 2 + FLOOR) / (r["all"] + FLOOR))
    logp = F.log((F.col("n") - F.when(F.col("n") == 1, 0.5).otherwise(0.0)) / (F.col("all") + FLOOR))
    return words.join(F.broadcast(cells), "cell").select("word", logp.alias("logp")), rest


def _dealt(docs: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))


def _blocks(docs: DataFrame, text_col: str) -> int:
    return (docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0) // BLOCK + 1


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", seed: int = 3) -> Model:
    """The network and the vocabulary of a corpus."""
    spark, blocks = docs.sparkSession, _blocks(docs, text_col)
    rows, params, counts, learnt, done = _dealt(docs, id_col, text_col, blocks), start(seed), np.zeros(WORDS), [], 0
    for end in ROUNDS:
        share = rows.where((F.col("block") % ROUNDS[-1] >= done) & (F.col("block") % ROUNDS[-1] < end)).repartition("block")
        share = share.sortWithinPartitions("block", F.xxhash64("id", "text"), "id").select("block", "text")
        held = spark.sparkContext.broadcast((params, counts))
        parts = stash(spark, share.mapInArrow(_learn(held), "piece int, part int, sums binary, block long, word long, n long"), "learnt")
        sums = sum_tables(parts.where("piece is not null").select("piece", "part", "sums"))
        if sums:
            flat = np.concatenate([sums[k] for k in range(PIECES)])
            params, counts = _split(flat[:SIZE] / flat[-1]), counts + flat[SIZE:-1]
        learnt.append(parts.where("piece is null").select("block", "word", "n"))
        done = end
    model = Model((params, _frequencies(counts)))
    words = learnt[0].union(learnt[1]).union(learnt[2])
    model.vocab, model.rest = vocabulary(words)
    model.blocks, model.words = blocks, words.select("block", "word")
    return model


def _distinct(batches):
    """The distinct words of each block."""
    now, found = None, []
    for block, texts in _by_block(batches):
        if block != now and found:
            yield from (b.select(["block", "word"]) for b in _words_out(now, found))
            found = []
        now = block
        h = np.unique(words_of(texts, lower=True)[0])
        found.append((h, np.ones(len(h))))
    if found:
        yield from (b.select(["block", "word"]) for b in _words_out(now, found))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", fitted: bool = False) -> DataFrame:
    """id, n_words, pll (the sum of log-probabilities) and mean_logprob (null without words). ``fitted``: the documents are
    those of the fit, whose words are at hand."""
    spark, blocks = docs.sparkSession, model.blocks if fitted else _blocks(docs, text_col)
    held, rows = spark.sparkContext.broadcast((*model, model.rest)), _dealt(docs, id_col, text_col, blocks)
    kind = rows.schema["id"].dataType.simpleString()
    found = model.words if fitted else rows.repartition("block").sortWithinPartitions("block").select("block", "text").mapInArrow(_distinct, "block long, word long")
    known = found.join(model.vocab, "word").select("block", F.col("word").alias("word"), "logp", F.lit(None).cast(kind).alias("id"), F.lit(None).cast("string").alias("text"))

    def run(batches):
        params, freq, rest = held.value
        now, words, logp, got, ready = None, [], [], [], False
        for batch in batches:
            blocks, of_word = batch.column(0).to_numpy(), batch.column(2).is_valid().to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.diff(blocks) | np.diff(of_word.astype(np.int8))) + 1
            for a, z in zip([0, *cut], [*cut, len(blocks)], strict=True):
                if blocks[a] != now:
                    now, words, logp, ready = blocks[a], [], [], False
                part = batch.slice(a, z - a)
                if of_word[a]:  # a block's words come before its documents
                    words.append(part.column(1).to_numpy().view(np.uint64))
                    logp.append(part.column(2).to_numpy())
                    continue
                if not ready:
                    w, p = np.concatenate([np.zeros(0, np.uint64), *words]), np.concatenate([np.zeros(0), *logp])
                    order = np.argsort(w)
                    w, p, ready = np.append(w[order], np.uint64(2**64 - 1)), np.append(p[order], np.nan), True
                n, pll = [], []
                for texts in chunks([part.column(4)], AT_ONCE):
                    h, counts = words_of(texts, lower=True)
                    line, at, _ = _laid(h, counts)
                    k = np.searchsorted(w, h)
                    own = np.where(w[k] == h, p[k], np.nan) if len(h) else np.zeros(0)
                    own = np.where(np.isnan(own), rest[line[at]], own)
                    sums = np.concatenate(([0.0], np.cumsum(log_probs(params, freq, line, at) + own)))
                    ends = np.cumsum(counts)
                    n.extend(counts)
                    pll.extend(sums[ends] - sums[ends - counts])
                yield pa.RecordBatch.from_arrays([part.column(3), pa.array(n, pa.int64()), pa.array(pll, pa.float64())], names=["id", "n_words", "pll"])

    none = rows.select("block", F.lit(None).cast("long").alias("word"), F.lit(None).cast("double").alias("logp"), "id", "text")
    dealt = known.union(none).repartition("block").sortWithinPartitions("block", F.col("logp").isNull())
    out = dealt.mapInArrow(run, f"id {kind}, n_words long, pll double")
    return out.withColumn("mean_logprob", F.when(F.col("n_words") > 0, F.col("pll") / F.col("n_words")))

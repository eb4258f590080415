"""Quality classifier: random-indexing word vectors, pooled, then a two-layer network.

Every hashed word has a sparse random index vector; over all texts, a word's vector is the mean of the index
vectors of its contexts, which are two words on each side and the word's own last three bytes. A document is the mean, the
spread and the mean step of its words' vectors. A network with one hidden layer, trained in numpy on at most ``max_labelled``
labelled documents, gives a logit, and a temperature fitted on labelled documents that it was not trained on
makes it a probability.

The word vectors cover all documents; what is gathered is one table of fixed size for each task, summed in
pieces by a tree. The driver holds that table (2 MB) and the vectors of the labelled sample: at most ``max_labelled`` labels, and
as many documents that carry one of them, each text once.

Nulls: null and empty texts have the zero vector and get a score; null labels are left out. Without both
labels in the sample, the score is the share of label 1, or one half. Repeated rows are scored
alike. Texts are read whole. Labels, languages, sources and identifiers are never part of a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataq.llm.common import chunks, mix64, stash, sum_tables, word_spans, words_of

#: Hashed words, and the length of their vectors.
WORDS, DIM, NONZERO = 1 << 14, 32, 4
POOLED = 3 * DIM + 1
#: Words at which a document's own evidence weighs as much as the average document.
PRIOR_WORDS = 8
PIECES = 16
#: Words whose contexts are counted at once.
COUNTED = 1 << 19
#: The bound of the labelled sample.
MAX_LABELLED = 20_000


def _index_vectors(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, DIM, (NONZERO, n)), rng.choice(np.array([-1.0, 1.0], np.float32), (NONZERO, n))


def _tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Of several texts: hashed words, and words in each text."""
    h, counts = words_of(texts, lower=False)
    return (h % np.uint64(WORDS)).astype(np.int64), counts


def _endings(texts) -> np.ndarray:
    """The hashed last three bytes of every word."""
    b = np.frombuffer(b" ".join(t.tobytes() for t in texts), np.uint8)
    s, e = word_spans(b)
    x = b[e - 1].astype(np.uint64)
    for k in (2, 3):
        x = x * np.uint64(257) + np.where(e - s >= k, b[np.maximum(e - k, 0)], 0).astype(np.uint64)
    return (mix64(x) % np.uint64(WORDS)).astype(np.int64)


def _hashed(batches, most: int = COUNTED):
    """Hashed words, endings and each word's text, of about ``most`` words at once. Words are hashed in small chunks, for that
    takes some fifty bytes for each byte of text."""
    held, n, texts_so_far = [], 0, 0
    for texts in chunks(b.column(0) for b in batches):
        w, counts = _tokens(texts)
        if not len(w):
            continue
        held.append((w.astype(np.int32), _endings(texts).astype(np.int32), np.repeat(np.arange(len(counts), dtype=np.int32) + np.int32(texts_so_far), counts)))
        n, texts_so_far = n + len(w), texts_so_far + len(counts)
        if n >= most:
            yield tuple(np.concatenate(x) for x in zip(*held, strict=True))
            held, n, texts_so_far = [], 0, 0
    if held:
        yield tuple(np.concatenate(x) for x in zip(*held, strict=True))


def _gather(seed: int):
    def run(batches):
        (at, sign), (at2, sign2) = _index_vectors(seed, WORDS), _index_vectors(seed + 1, WORDS)
        total, seen = np.zeros(WORDS * DIM), np.zeros(WORDS)
        for w, e, doc in _hashed(batches):
            seen += np.bincount(w, minlength=WORDS)
            for k in range(NONZERO):
                total += np.bincount(w * DIM + at2[k][e], sign2[k][e], WORDS * DIM)
                for off in (1, 2):
                    same = doc[:-off] == doc[off:]
                    a, b = w[:-off][same], w[off:][same]
                    total += np.bincount(a * DIM + at[k][b], sign[k][b], WORDS * DIM)
                    total += np.bincount(b * DIM + at[k][a], sign[k][a], WORDS * DIM)
        rows = np.concatenate((total.reshape(WORDS, DIM), seen[:, None]), axis=1).astype(np.float32).reshape(PIECES, -1)
        if seen.any():
            from pyspark import TaskContext

            part = pa.array([TaskContext.get().partitionId()] * PIECES, pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(range(PIECES), pa.int32()), part, pa.array([r.tobytes() for r in rows], pa.binary())], names=["piece", "part", "sums"])

    return run


def word_vectors(docs: DataFrame, text_col: str = "text", seed: int = 11) -> np.ndarray:
    """WORDS x DIM, scaled so that every coordinate has mean 0 and spread 1 over the words that occur."""
    parts = stash(docs.sparkSession, docs.select(text_col).mapInArrow(_gather(seed), "piece int, part int, sums binary"), "vectors")
    table = np.zeros((PIECES, WORDS // PIECES * (DIM + 1)))
    for piece, sums in sum_tables(parts, np.float32).items():
        table[piece] = sums
    table = table.reshape(WORDS, DIM + 1)
    seen = table[:, -1:]
    v = table[:, :-1] / np.maximum(seen, 1)
    used = seen[:, 0] > 0
    if used.any():
        v[used] = (v[used] - v[used].mean(0)) / (v[used].std(0) + 1e-9)
    return v.astype(np.float32)


def pool(texts, vectors: np.ndarray) -> np.ndarray:
    """Of each text's word vectors: mean, standard deviation, and root mean square of the steps from word to
    word, which are small where words repeat; a text of one word has steps of the usual size. Last the weight
    of the text's own evidence, which draws short texts to the average one."""
    w, counts = _tokens(texts)
    out = np.zeros((len(counts), POOLED), np.float32)
    some = np.flatnonzero(counts)
    if len(some):
        v = vectors[w]
        at = np.concatenate(([0], np.cumsum(counts[some])[:-1]))
        n = counts[some][:, None]
        out[some, :DIM] = np.add.reduceat(v, at) / n
        out[some, DIM: 2 * DIM] = np.sqrt(np.maximum(np.add.reduceat(v * v, at) / n - out[some, :DIM] ** 2, 0))
        step = np.zeros_like(v)
        step[:-1] = (v[1:] - v[:-1]) ** 2
        step[at + counts[some] - 1] = 0
        out[some, 2 * DIM: -1] = np.where(n > 1, np.sqrt(np.add.reduceat(step, at) / np.maximum(n - 1, 1)), 2**0.5)
        out[some, -1:] = n / (n + PRIOR_WORDS)
    return out


@dataclass
class QualityModel:
    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float
    constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum((x[:, :-1] - self.centre) / self.scale * x[:, -1:] @ self.w1 + self.b1, 0)
        return h @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -30, 30)))


def fit_network(x: np.ndarray, y: np.ndarray, vectors: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 5) -> QualityModel:
    """Adam on mini-batches of four fifths of the rows; the temperature on the others."""
    rng = np.random.default_rng(seed)
    zero = np.zeros(1)
    if len(np.unique(y)) < 2:
        return QualityModel(vectors, zero, zero + 1, zero, zero, zero, 0.0, 1.0, float(y.mean()) if len(y) else 0.5)
    order = rng.permutation(len(y))
    tune, fit = order[: len(y) // 5], order[len(y) // 5:]
    x = x.astype(np.float64)
    centre, scale = x[fit, :-1].mean(0), x[fit, :-1].std(0) + 1e-6
    z = (x[:, :-1] - centre) / scale * x[:, -1:]
    params = [rng.normal(0, (2 / z.shape[1]) ** 0.5, (z.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    m1, m2, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(epochs):
        mixed = rng.permutation(fit)
        for k in range(0, len(mixed), 128):
            i = mixed[k: k + 128]
            a = z[i] @ params[0] + params[1]
            h = np.maximum(a, 0)
            p = 1 / (1 + np.exp(-np.clip(h @ params[2] + params[3], -30, 30)))
            g = (p - y[i]) / len(i)
            back = np.outer(g, params[2]) * (a > 0)
            step += 1
            for j, grad in enumerate((z[i].T @ back + 1e-3 * params[0], back.sum(0), h.T @ g + 1e-3 * params[2], g.sum(keepdims=True))):
                m1[j] = 0.9 * m1[j] + 0.1 * grad
                m2[j] = 0.999 * m2[j] + 0.001 * grad * grad
                params[j] = params[j] - 0.005 * (m1[j] / (1 - 0.9**step)) / ((m2[j] / (1 - 0.999**step)) ** 0.5 + 1e-8)
    model = QualityModel(vectors, centre, scale, params[0], params[1], params[2], float(params[3][0]), 1.0)
    if len(tune):
        logit = model.logits(x[tune])
        loss = lambda t: np.mean(np.logaddexp(0, np.where(y[tune] == 1, -logit, logit) / t))
        model.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return model


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", train_where=None,
        max_labelled: int = MAX_LABELLED) -> QualityModel:
    """``train_where``: a condition on the labels' identifiers that a training row has to meet."""
    spark = docs.sparkSession
    vectors = word_vectors(docs, text_col)
    chosen = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    chosen = chosen if train_where is None else chosen.where(train_where)
    chosen = chosen.select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__y")).orderBy(F.xxhash64("__id"), "__id", "__y").limit(max_labelled)
    # at most max_labelled rows of two numbers are broadcast
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), F.col("id") == F.col("__id")).select("t", F.col("__y").alias("y"), "id")
    held = spark.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in batches:
            parts = [pool(texts, held.value) for texts in chunks([batch.column(0)])]
            if parts:
                x = np.concatenate(parts)
                yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["id", "y", "x"])

    made = rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, y int, x binary")
    # a labelled identifier may stand on any number of rows
    made = made.distinct().orderBy(F.xxhash64("id", "x"), "y").limit(max_labelled)
    got = sorted(made.collect(), key=lambda r: (str(r.id), r.y, bytes(r.x)))
    x = np.array([np.frombuffer(r.x, np.float32) for r in got]).reshape(len(got), POOLED)
    return fit_network(x, np.array([r.y for r in got], np.float64), vectors)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text", out_col: str = "score") -> DataFrame:
    """The input's rows and columns, and the score of each text; nothing is shuffled."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            got = [held.value.score(pool(texts, held.value.vectors)) for texts in chunks([batch.column(at)])]
            column = pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*batch.schema.names, out_col])

    from pyspark.sql.types import DoubleType, StructField, StructType

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(out_col, DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5, train_where=None) -> DataFrame:
    """``docs`` without the rows whose score is below ``threshold``, all columns as they are."""
    return score(docs, fit(docs, labels, id_col, text_col, train_where=train_where), text_col, "__score").where(F.col("__score") >= threshold).drop("__score")

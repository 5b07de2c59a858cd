"""Quality classifier: random-indexing word vectors, pooled per document, then
a two-layer numpy network whose probabilities are calibrated by a temperature.

Tokens.  Words are split at [\\x20\\x09-\\x0D]; each word gives a form token
(its hash among ``FORMS`` buckets) and a shape token (runs of lower case,
upper case, digits and each punctuation mark collapsed: ``Xx``, ``x$``).
Repetition is seen through three more tokens, counted like words: a word equal
to the one before, a word seen earlier in the text, a line seen earlier.

Vectors.  Every shape has a fixed sparse ternary index vector.  A word's
vector is its own index vector plus the normalised sum of the index vectors of
the shapes up to two words away, summed over all documents (counts are added
by Spark; the sums are at most ``FORMS`` x ``SHAPES``).  A document is
the mean of its tokens' vectors and the logarithm of its length.

The network is fitted on at most ``SAMPLE`` labelled rows (documented bound;
chosen by a hash of the id), a part of which only sets the temperature.  All
documents are scored, each from its whole text.

Defined results: null and empty texts are scored as texts without words;
without labelled rows every score is 0.5, with one class only the smoothed
share of that class; repeated rows are scored alike; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import fold_of, labelled_sample, map_batches, stored, text_bytes

FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3
SAMPLE = 20_000      # labelled rows that the classifier is fitted on, at most
FORMS = 1 << 14      # buckets of word forms
SHAPES = 1 << 8      # buckets of word shapes (the contexts)
DIM = 64
HIDDEN = 32

_SAME, _SEEN, _LINE = range(3)      # repetition tokens
_ROWS = FORMS + SHAPES + 3

_LOWER = re.compile(rb"[a-z\x80-\xff]+")
_UPPER = re.compile(rb"[A-Z]+")
_DIGIT = re.compile(rb"[0-9]+")
_RUN = re.compile(rb"([^xX0])\1+")


def word_token(word: bytes) -> int:
    """Form and shape bucket of a word, in one number."""
    shape = _RUN.sub(rb"\1", _DIGIT.sub(b"0", _UPPER.sub(b"\x01", _LOWER.sub(b"x", word)))).replace(b"\x01", b"X")
    return (zlib.crc32(word.lower()) & (FORMS - 1)) * SHAPES + (zlib.crc32(shape) & (SHAPES - 1))


def word_tokens(word: bytes) -> tuple[int, int]:
    """Form and shape bucket of a word."""
    return divmod(word_token(word), SHAPES)


class _Memo(dict):
    """Tokens of the words met so far; long words are not kept, and it starts anew when it is full."""

    def __missing__(self, word: bytes) -> int:
        token = word_token(word)
        if len(word) <= 64:
            if len(self) >= 1 << 17:
                self.clear()
            self[word] = token
        return token


_TOKENS = _Memo()


def tokens_of(words) -> np.ndarray:
    return np.fromiter(map(_TOKENS.__getitem__, words), np.int64, len(words))


def index_vectors(rows: int, dim: int = DIM, nonzero: int = 8, seed: int = 11) -> np.ndarray:
    """One fixed sparse ternary vector for each token."""
    rng = np.random.default_rng(seed)
    out = np.zeros((rows, dim), np.float32)
    places = rng.permuted(np.broadcast_to(np.arange(dim), (rows, dim)), axis=1)[:, :nonzero]
    out[np.arange(rows)[:, None], places] = rng.choice([-1.0, 1.0], (rows, nonzero))
    return out / np.sqrt(nonzero)


def context_counts(docs: DataFrame) -> DataFrame:
    """form, shape, n: how often a shape stands within two words of a form."""
    def run(batches):
        total, held, size = np.zeros(FORMS * SHAPES, np.int64), [], 0
        for batch in batches:
            for text in batch["text"].to_pylist():
                tokens = tokens_of(text.split())
                for gap in (1, 2):
                    near, far = tokens[gap:], tokens[:-gap]
                    held += [near - near % SHAPES + far % SHAPES, far - far % SHAPES + near % SHAPES]
                size += 4 * len(tokens)
                if size > 1 << 22:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        at = np.flatnonzero(total)
        for part in np.array_split(at, len(at) // 100_000 + 1):
            yield pa.RecordBatch.from_arrays([pa.array((part // SHAPES).astype(np.int32)), pa.array((part % SHAPES).astype(np.int32)), pa.array(total[part])],
                                             ["form", "shape", "n"])
    return (docs.select("text").mapInArrow(run, "form int, shape int, n bigint")
            .groupBy("form", "shape").agg(F.sum("n").alias("n")))


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(_ROWS, DIM) vectors of forms, shapes and repetition tokens, from the bytes of all texts."""
    own = index_vectors(_ROWS)
    # bounded: FORMS * SHAPES counts at most, and only those that occur, as Arrow columns (16 bytes each)
    counts = context_counts(docs).toArrow()
    context = np.zeros((FORMS, DIM), np.float64)
    shapes = own[FORMS:FORMS + SHAPES].astype(np.float64)
    form, shape, n = (counts[c].to_numpy() for c in ("form", "shape", "n"))
    order = np.lexsort((shape, form))
    form, shape, n = form[order], shape[order], n[order]
    for shape_id in np.unique(shape):
        here = shape == shape_id
        context[form[here]] += n[here, None] * shapes[shape_id]
    norm = np.linalg.norm(context, axis=1, keepdims=True)
    own[:FORMS] = 0.25 * own[:FORMS] + (context / np.maximum(norm, 1e-9)).astype(np.float32)
    return own


def document_vector(text: bytes, vectors: np.ndarray) -> np.ndarray:
    """Mean vectors of forms, shapes and repetition tokens, and the log length."""
    words = text.split()
    out = np.zeros(2 * DIM + 4, np.float32)
    if not words:
        return out
    counts = Counter(words)
    tokens = tokens_of(counts)
    n = np.fromiter(counts.values(), np.float32, len(counts))
    total = float(len(words))
    out[:DIM] = n @ vectors[tokens // SHAPES] / total
    out[DIM:2 * DIM] = np.bincount(tokens % SHAPES, n, SHAPES) @ vectors[FORMS:FORMS + SHAPES] / total
    lines = text.split(b"\n")
    repeats = (sum(map(eq, words, words[1:])) / total, 1.0 - len(counts) / total, 1.0 - len(set(lines)) / len(lines))
    out[:DIM] += np.asarray(repeats, np.float32) @ vectors[FORMS + SHAPES:]
    out[2 * DIM:2 * DIM + 3] = repeats
    out[-1] = np.log1p(total)
    return out


def document_vectors(texts, vectors: np.ndarray) -> np.ndarray:
    return np.stack([document_vector(t, vectors) for t in texts]) if len(texts) else np.zeros((0, 2 * DIM + 4), np.float32)


# --------------------------------------------------------------------- network

class Network:
    """Two layers (tanh, logistic), inputs standardised, logits over a temperature."""

    def __init__(self, mean, scale, w1, b1, w2, b2, temperature=1.0):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2
        self.temperature = temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(x.astype(np.float64)) / self.temperature, -30, 30)))


def _constant(share: float, width: int) -> Network:
    b = float(np.log(share / (1 - share)))
    return Network(np.zeros(width), np.ones(width), np.zeros((width, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), b)


def fit_network(x: np.ndarray, y: np.ndarray, hold: np.ndarray, epochs: int = 40, batch: int = 256,
                rate: float = 3e-3, decay: float = 1e-3, seed: int = 5) -> Network:
    """Adam on the rows outside ``hold``; the temperature minimises the log loss inside it."""
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        return _constant((y.sum() + 0.5) / (len(y) + 1.0), width)
    if hold.all() or not hold.any() or y[~hold].min() == y[~hold].max():
        hold = np.zeros(len(y), bool)
    x = x.astype(np.float64)
    tx, ty = x[~hold], y[~hold].astype(np.float64)
    rng = np.random.default_rng(seed)
    mean, scale = tx.mean(axis=0), tx.std(axis=0) + 1e-3
    p = [rng.normal(0, 1 / np.sqrt(width), (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN),
         np.zeros(1)]
    m, v, step = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    z = (tx - mean) / scale
    for _ in range(epochs):
        order = rng.permutation(len(ty))
        for at in range(0, len(ty), batch):
            pick = order[at:at + batch]
            h = np.tanh(z[pick] @ p[0] + p[1])
            err = (1 / (1 + np.exp(-np.clip(h @ p[2] + p[3], -30, 30))) - ty[pick]) / len(pick)
            back = np.outer(err, p[2]) * (1 - h * h)
            grads = [z[pick].T @ back + decay * p[0], back.sum(axis=0), h.T @ err + decay * p[2], err.sum(keepdims=True)]
            step += 1
            for k, g in enumerate(grads):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    hx, hy = (x[hold], y[hold]) if hold.any() else (tx, ty)
    logits = net.logits(hx)

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - hy * logits / t))
    net.temperature = min(np.geomspace(0.5, 8, 41), key=loss)
    return net


# -------------------------------------------------------------------- operator

def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents; network from labelled rows outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, "quality", fold_of("doc_id", FOLDS) != HELD_OUT, bound), "quality-sample")
    vectors = word_vectors(text_bytes(docs))
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = document_vectors([t.as_py() for t in batch["text"]], shared.value)
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(list(x), pa.list_(pa.float32()))],
                                          ["doc_id", "label", "x"])

    # bounded: ``bound`` rows of 132 numbers
    rows = map_batches(sample.select("doc_id", "label", "text"), run, "doc_id bigint, label int, x array<float>").toArrow()
    ids = rows["doc_id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, 2 * DIM + 4)[order]
    hold = np.array([zlib.crc32(b"t%d" % i) % 6 == 0 for i in ids[order]], bool)
    return vectors, fit_network(x, rows["label"].to_numpy()[order].astype(np.int64), hold)


def quality_scores(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, digest (xxhash64 of the text), held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, bound))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        vectors, net = shared.value
        scores = []
        for at in range(0, batch.num_rows, 512):
            scores.append(net.score(document_vectors([t.as_py() for t in batch["text"].slice(at, 512)], vectors)))
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["digest"], pa.array(score)], ["doc_id", "digest", "score"])

    scored = map_batches(text_bytes(docs, F.xxhash64("text").alias("digest")), run, "doc_id bigint, digest bigint, score double")
    return scored.select("doc_id", "digest", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those predicted to be of low quality; all columns stay.
    The rejected (doc_id, text digest) pairs are removed by an anti join."""
    bad = stored(quality_scores(docs, labels, bound, threshold).filter("predicted = 0").select(
        F.col("doc_id").alias("_bad_id"), F.col("digest").alias("_bad_digest")).distinct(), "low-quality")
    return docs.join(bad, docs["doc_id"].cast("bigint").eqNullSafe(bad["_bad_id"])
                     & (F.xxhash64(docs["text"]) == bad["_bad_digest"]), "left_anti")

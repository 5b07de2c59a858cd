"""Toxicity by a weighted finite-state pattern grammar.

Words become symbols (insult, threat verb, modal, target, negation, report,
other).  Five small transducers read them one after the other - negation marks
what it governs, reported speech marks what it quotes, a modal before a threat
verb makes a threat, a target nearby marks an insult as aimed, and the last one
adds the aim that follows an insult - and are composed into one machine, whose
transitions are tabulated once: state, symbol -> state, marks of the match.
The machine runs over clauses.  A match weighs its word's weight times the
weights of its marks; a clause scores the sum of its matches.  All that is
known of a document are scores of its clauses: no word counts by itself.

The word lists below are the grammar's fixed part.  The arc weights are
learned from a bounded sample of labelled rows: insult stems of any language
(shrunk log odds of word prefixes, counted by Spark) from one part, the scope
weights of negation, report and aim (starting from fixed ones) and a logistic
calibration of the clause scores from the other.

Defined results: null and empty texts match nothing; without labelled rows the
fixed lists and weights are used alone; repeated rows are scored alike; words
and texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import fold_of, labelled_sample, map_batches, stored, text_bytes

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.7
SAMPLE = 20_000          # labelled rows that are learned from, at most
STEMS = 4_000            # learned prefixes, at most (the strongest)
PREFIXES = range(3, 9)   # lengths of learned prefixes; whole words count as well
MIN_DOCUMENTS = 4
PRIOR = 4.0              # documents of average toxicity that each prefix is shrunk by

OTHER, INSULT, THREAT, MODAL, TARGET, NEGATION, REPORT = range(7)

# The grammar's words.
WORDS = {
    INSULT: """idiot idiots moron morons stupid loser losers scum trash clown clowns pathetic worthless disgusting
        dumb fool imbecile vermin dummkopf idioten abschaum wertlos dumm imbécile ordure minable stupide nul
        idiota estúpido basura inútil patético imbécil""",
    THREAT: "kill hurt destroy beat burn shoot stab töten schlagen tuer frapper matar golpear",
    MODAL: "will shall gonna going must should werde wirst vais vas voy vamos",
    TARGET: "you your yours he she they them him her people everyone du dich ihr euch tu toi vous tú vosotros ellos",
    NEGATION: "not no never without isn't aren't don't nicht kein keine nie pas jamais sans nunca sin",
    REPORT: "said says told wrote writes called claims quoted sagte sagt schrieb dit écrit dijo dice escribió",
}
SEED_WEIGHT = 3.0


# ----------------------------------------------------------------- transducers

# Marks of a match.
NEGATED, REPORTED, AIMED = 1, 2, 4
AIM = 8          # a target behind an insult: adds the aim to an insult that is scored already
MARKS = 9
# Scope weights of negation, report and aim before anything is learned.
SCOPES = (0.5, 0.7, 1.3)


class Transducer:
    """Letter transducer: ``step(state, symbol) -> (state, symbol, marks)`` from state ``start``."""

    def __init__(self, start, step):
        self.start, self.step = start, step

    def compose(self, other: "Transducer") -> "Transducer":
        """Reads with self, feeds its output to ``other``; marks add up."""
        def step(state, symbol):
            a, mid, m = self.step(state[0], symbol)
            b, out, k = other.step(state[1], mid)
            return (a, b), out, m | k
        return Transducer((self.start, other.start), step)


def _scope(opener: int, length: int, governed: tuple[int, ...], mark: int) -> Transducer:
    """After ``opener``, governed symbols within ``length`` words get the mark."""
    def step(left, symbol):
        m = mark if left and symbol in governed else 0
        return (length if symbol == opener else max(0, left - 1)), symbol, m
    return Transducer(0, step)


def grammar() -> Transducer:
    negation = _scope(NEGATION, 3, (INSULT, THREAT), NEGATED)
    reported = _scope(REPORT, 12, (INSULT, THREAT), REPORTED)
    target = _scope(TARGET, 4, (INSULT,), AIMED)

    def threat(left, symbol):
        if symbol == THREAT:   # a threat verb alone is none
            return 0, (THREAT if left else OTHER), 0
        return (3 if symbol == MODAL else max(0, left - 1)), symbol, 0

    def aimed(state, symbol):   # insult ... target: the insult has been scored, its aim adds
        near, last = state
        if symbol == TARGET and near and last == INSULT:
            return (0, OTHER), INSULT, AIM
        return ((3, symbol) if symbol in (INSULT, THREAT) else (max(0, near - 1), last)), symbol, 0

    return negation.compose(reported).compose(Transducer(0, threat)).compose(target).compose(Transducer((0, OTHER), aimed))


@functools.cache
def machine() -> list[list[tuple[int, int]]]:
    """Transitions of the composed grammar: [state][symbol] -> (state, marks of a match, or -1 for none)."""
    g = grammar()
    number, rows, todo = {g.start: 0}, [], [g.start]
    while todo:
        state = todo.pop(0)
        row = []
        for symbol in range(7):
            nxt, out, marks = g.step(state, symbol)
            if nxt not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            row.append((number[nxt], marks if out in (INSULT, THREAT) else -1))
        rows.append(row)
    return rows


def arc_weights(scopes=SCOPES) -> list[float]:
    """The weight of every set of marks: the product of its scopes'; a following aim adds what aiming adds."""
    out = [float(np.prod([w for bit, w in zip((NEGATED, REPORTED, AIMED), scopes) if marks & bit])) for marks in range(AIM)]
    return [*out, scopes[2] - 1.0]


def clause_matches(clause: list[tuple[int, float, bytes]]) -> list[tuple[int, float, bytes]]:
    """(marks, word weight, word) of the matches in a clause of (symbol, weight, word)."""
    state, aim, out, rows = 0, (0.0, b""), [], machine()
    for symbol, weight, word in clause:
        state, marks = rows[state][symbol]
        if symbol in (INSULT, THREAT):
            aim = weight, word
        if marks >= 0:
            out.append((marks, *(aim if symbol == TARGET else (weight, word))))
    return out


# --------------------------------------------------------------------- lexicon

_EDGE = re.compile(r"^\W+|\W+$")


class Lexicon:
    """Symbols and weights of raw words (bytes, with their punctuation)."""

    def __init__(self, stems: dict[str, float]):
        self.stems = stems
        self.words = {w: (kind, SEED_WEIGHT) for kind, words in WORDS.items() for w in words.split()}
        self.memo: dict[bytes, tuple[int, float, bool]] = {}

    def look_up(self, raw: bytes) -> tuple[int, float, bool]:
        """Symbol, weight, and whether the word ends a clause."""
        text = raw.decode("utf-8", "replace")
        word = _EDGE.sub("", text.lower())
        kind, weight = self.words.get(word, (OTHER, 0.0))
        learned = max((self.stems.get(f, 0.0) for f in word_features(word)), default=0.0)
        if learned > 0 and kind in (OTHER, INSULT):
            kind, weight = INSULT, max(weight if kind == INSULT else 0.0, learned)
        return kind, weight, text[-1:] in ".!?;:,"

    def get(self, raw: bytes) -> tuple[int, float, bool]:
        found = self.memo.get(raw)
        if found is None:
            if len(self.memo) > 200_000:   # bounded memory
                self.memo.clear()
            found = self.memo[raw] = self.look_up(raw)
        return found


def word_features(word: str) -> list[str]:
    """Prefixes, and the whole word marked by a closing bar."""
    return [word[:k] for k in PREFIXES if len(word) > k] + [word + "|"] if word else []


def clauses(text: bytes, lexicon: Lexicon) -> Iterator:
    """The clauses of a text that hold an insult or a threat verb, and at last its number of words."""
    n = 0
    for line in text.split(b"\n"):
        words = line.split()
        n += len(words)
        found = [lexicon.get(w) for w in words]
        if not any(f[0] == INSULT or f[0] == THREAT for f in found):
            continue
        clause: list[tuple[int, float, bytes]] = []
        last = None
        for word, (symbol, weight, ends) in zip(words, found):
            if word != last:   # a word said again and again is one match
                clause.append((symbol, weight, word.lower()))
            last = word
            if ends and clause:
                yield clause
                clause = []
        if clause:
            yield clause
    yield n


FEATURES = 7


def scores(matched: list[list[tuple[int, float, bytes]]], n: int, arcs: list[float]) -> tuple[float, ...]:
    """Strongest clause, all clauses, matched clauses, all clauses in a hundred
    words, the matches of different words, each at its strongest, the machine's
    matches in a hundred words, and its matches of different words (logarithms)."""
    each, strongest, hits = [], {}, 0
    for clause in matched:
        total = 0.0
        for marks, weight, word in clause:
            s = arcs[marks] * weight
            total += s
            hits += marks != AIM
            if marks != AIM and s > strongest.get(word, 0.0):
                strongest[word] = s
        each.append(total)
    total = sum(each)
    return (np.log1p(max(each, default=0.0)), np.log1p(total), np.log1p(sum(s > 0 for s in each)), np.log1p(100.0 * total / n) if n else 0.0,
            np.log1p(sum(strongest.values())), np.log1p(100.0 * hits / n) if n else 0.0, np.log1p(len(strongest)))


def features(text: bytes, lexicon: Lexicon, arcs: list[float] | None = None) -> tuple[float, ...]:
    *found, n = clauses(text, lexicon)
    return scores([clause_matches(c) for c in found], n, arcs or arc_weights())


def mark_sums(text: bytes, lexicon: Lexicon) -> list[float]:
    """Word weights of a text's matches by their marks, and its number of words: what the scopes are learned from."""
    *found, n = clauses(text, lexicon)
    out = [0.0] * MARKS + [float(n)]
    for clause in found:
        for marks, weight, _ in clause_matches(clause):
            out[marks] += weight
    return out


# -------------------------------------------------------------------- learning

def learned_stems(sample: DataFrame, limit: int = STEMS) -> dict[str, float]:
    """The strongest prefixes by shrunk log odds; at most ``limit`` reach the driver."""
    def run(batches):
        toxic, clean = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"].to_pylist()):
                words = {_EDGE.sub("", w) for w in set(text.as_py().decode("utf-8", "replace").lower().split())}
                (toxic if label else clean).update({f for w in words for f in word_features(w)})
                if len(toxic) + len(clean) > 400_000:
                    yield _counts(toxic, clean)
                    toxic, clean = Counter(), Counter()
        yield _counts(toxic, clean)

    totals = sample.agg(F.sum((F.col("label") > 0).cast("int")), F.count(F.lit(1))).first()
    if not totals[0] or totals[0] == totals[1]:
        return {}
    p = totals[0] / totals[1]
    share = (F.col("toxic") + F.lit(PRIOR * p)) / (F.col("toxic") + F.col("clean") + F.lit(PRIOR))
    weight = F.log(share / (1 - share)) - F.lit(float(np.log(p / (1 - p))))
    best = (sample.select("text", "label").mapInArrow(run, "feature string, toxic bigint, clean bigint")
            .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
            .filter(F.col("toxic") >= MIN_DOCUMENTS).withColumn("weight", weight).filter("weight > 1.5")
            .orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "feature").limit(limit))
    return {r["feature"]: r["weight"] for r in best.collect()}


def _counts(toxic: Counter, clean: Counter) -> pa.RecordBatch:
    names = list(toxic.keys() | clean.keys())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[f] for f in names], pa.int64()),
                                       pa.array([clean[f] for f in names], pa.int64())], ["feature", "toxic", "clean"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method with a ridge; returns the bias and the weights."""
    z = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(z.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * len(y) * np.r_[0, w[1:]] / 10
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(np.r_[1e-6, np.full(len(w) - 1, ridge * len(y) / 10)])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn_scopes(sums: np.ndarray, y: np.ndarray, rounds: int = 400, rate: float = 0.03, prior: float = 4.0) -> tuple[float, ...]:
    """Scope weights that fit the labels best, as ``prior`` rows' worth of evidence says they are ``SCOPES``.

    A document is toxic with the logit of b + a log(1 + t) + c log(1 + 100 t / words), t its matches' weight; gradient steps
    (Adam) on a, b, c and the scopes' logarithms, which stay within a factor of eight of where they start."""
    s, n = sums[:, :MARKS], np.maximum(sums[:, MARKS], 1.0)
    start = np.log(SCOPES)
    p = np.r_[-3.0, 1.0, 0.3, start]
    m, v = np.zeros(6), np.zeros(6)

    def loss(q):
        t = s @ np.array(arc_weights(np.exp(q[3:])))
        z = q[0] + q[1] * np.log1p(np.maximum(t, 0)) + q[2] * np.log1p(np.maximum(100 * t / n, 0))
        return np.mean(np.logaddexp(0, z) - y * z) + prior / len(y) * np.sum((q[3:] - start) ** 2)

    for step in range(1, rounds + 1):
        grad = np.array([(loss(p + d) - loss(p - d)) / 2e-4 for d in np.eye(6) * 1e-4])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
        p[3:] = np.clip(p[3:], start - np.log(8), start + np.log(8))
    # an aim never takes weight away
    return float(np.exp(p[3])), float(np.exp(p[4])), float(max(1.0, np.exp(p[5])))


# Used while nothing is labelled: one aimed insult is about even.
_FALLBACK = np.array([-4.0, 2.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0])


def fit(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE) -> tuple[dict[str, float], list[float], np.ndarray]:
    """Learned stems, the arcs' weights and the calibration's, from rows outside the held-out fold."""
    sample = stored(labelled_sample(docs, labels, "toxic", fold_of("doc_id", FOLDS) != HELD_OUT, bound), "toxic-sample")
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10))
    stems = learned_stems(sample.filter(part < 6))
    rest = sample.filter(part >= 6).select("doc_id", "label", "text")

    def numbers(of) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of every text of the second part, and the labels; bounded: less than ``bound`` short rows."""
        def run(batches):
            lexicon = Lexicon(stems)
            for batch in batches:
                x = [list(map(float, of(t, lexicon))) for t in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], pa.array(x, pa.list_(pa.float64()))], ["doc_id", "label", "x"])
        rows = rest.mapInArrow(run, "doc_id bigint, label int, x array<double>").toArrow().sort_by("doc_id")
        y = (rows["label"].to_numpy() > 0).astype(float)
        return rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1) if len(y) else np.zeros((0, 1)), y

    sums, y = numbers(mark_sums)
    if not len(y) or y.min() == y.max():
        return stems, arc_weights(), _FALLBACK
    arcs = arc_weights(learn_scopes(sums, y))
    x, y = numbers(functools.partial(features, arcs=arcs))
    return stems, arcs, fit_logistic(x, y)


def toxicity_scores(docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, clause_score (strongest clause)."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, bound))

    def run(batches):
        stems, arcs, w = shared.value
        lexicon = Lexicon(stems)
        for batch in batches:
            x = np.array([features(t, lexicon, arcs) for t in batch["text"].to_pylist()], dtype=np.float64).reshape(-1, FEATURES)
            score = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score), pa.array(np.expm1(x[:, 0]))],
                                             ["doc_id", "score", "clause_score"])

    scored = text_bytes(docs).mapInArrow(run, "doc_id bigint, score double, clause_score double")
    return scored.select("doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "clause_score")

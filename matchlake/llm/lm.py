"""LM scoring by logistic context mixing over bits.

Tokens (lower-cased words, then one end) are spelled as bytes and a closing
space; the end is the closing space alone.  Each byte is coded bit by bit.  A
token's first byte is predicted across its edge, from the hashed token before
it (``edge_bits``); the bits of the others from several hashed contexts: the
one, two and three bytes before it within the token, the whole prefix of the
token, and the prefix within one of ``TOPICS`` kinds of text.  A gate (how often the prefix
contexts and the three-byte context have been seen) picks a set of weights;
the predictors' stretched probabilities are combined by it in the logistic
domain.  A table refines the mixed probability by the bits already known of
the byte.  A document adapts online which kind it is: its kinds' weights are
updated by every token's probability, so that in the end its probability is
the kinds' weighted mean of the products (a sum over tokens for each kind).

What is gathered from the corpus, all of it by Spark:

* the count of every distinct token in every kind of text, and how often each
  byte begins a token behind the tokens of each slot (one grouped sum over all
  training texts);
* the bit counts of the hashed byte contexts, from every distinct token by its
  count (one grouped sum; the tables have a fixed number of slots);
* prefix counts, of every distinct token of up to ``LONG`` bytes: the tokens are range-sorted as they
  are spelled and cut into runs (``RUN`` bytes), so that all tokens with a
  prefix stand together.  A run counts its own prefixes; those that go on in
  other runs begin its first or end its last token, and only the counts along
  these two pass through the driver.  The counts are exact and sit beside the
  tokens that they predict, so no table of them is broadcast.

Kinds are a mixture of hashed unigrams, fitted by EM rounds over all training
texts (kept as bags of hash buckets); every training text then belongs to the
likeliest.  The weights of each gate are a logistic regression over all
occurrences of all training tokens, each taken out of the counts first: every
Newton step goes over all of them, and so do the counts of the refinement.  Tokens with a
common prefix share its counts, so each different bit prefix of a run is
trained on and scored once (``Prefixes``).

Behind its first byte the contexts do not cross a token's edge, so that part
of a token's cost is one number for each kind: each distinct token is scored
once, the frequent ones are broadcast, the others meet their documents in a
join in which no token holds more than 1 / HEAVY of the tokens.  The first
bytes are scored for every occurrence, in the order of the text.

A token of more than ``LONG`` bytes (a blob, as a rule) has no part in the
prefix counts; it is counted, trained on and coded by its last three bytes, a
slice at a time, so that its time is linear in its length and its memory bounded.

Defined results: a null or empty text has one token, the end; a null id
belongs to neither fold (not trained on, not held out); repeated rows get a
row each; an empty training set scores with zero counts.
"""

from __future__ import annotations

import functools
import zlib
from itertools import chain, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.common import fold_of, map_batches, stored, text_bytes

FOLDS, HELD_OUT = 5, 1
HEAVY = 1 << 20
STEPS = 4                # Newton steps of the weights, each over all training tokens

TOPICS = 4
TOPIC_BUCKETS = 1 << 11
RESTARTS, SHORT_ROUNDS, ROUNDS = 12, 4, 20     # mixtures tried, EM rounds of all of them, rounds of the likeliest

# Slots of the hashed byte contexts (orders 1 to 3), of the prefixes, and of the
# prefixes by kind (the last two only where the prefixes are not counted exactly).
SLOTS = (1 << 16, 1 << 19, 1 << 20, 1 << 22, 1 << 22)
ORDERS = len(SLOTS)
_OFFSETS = np.concatenate([[0], np.cumsum(SLOTS)]).astype(np.int64)
CHUNK = 1 << 15          # bytes scored at a time (small arrays stay in the cache)
BAGS = 1 << 20           # bytes of texts whose bags of words are kept in one row
PIECE = 1 << 22          # bytes of texts whose words are told apart at a time
RUN = 1 << 17            # bytes of distinct tokens whose prefixes are counted at a time
EDGE_SLOTS = 1 << 10     # slots of the token before, for a token's first byte
START = EDGE_SLOTS       # the slot of a text's beginning
EDGE_SURE = 12           # steps of how often a slot's node was seen
LONG = 1 << 8            # a token of more bytes is coded by its last bytes only, a slice at a time

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x100000001B3


# ---------------------------------------------------------------- token stream

_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def pieces(texts: list[bytes], limit: int = PIECE):
    """Slices of ``texts`` of about ``limit`` bytes (at least one text each)."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def occurrences(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray, np.ndarray]:
    """The texts' different lower-cased words, the number of the word at each
    place of the texts one after the other, and where each text's words begin
    (and the last ones end)."""
    stream = np.frombuffer(b" ".join(texts).lower() + b" ", np.uint8)
    inside = ~_BLANK[stream]
    turns = np.flatnonzero(np.diff(inside, prepend=False))
    starts = turns[::2]
    offsets = np.concatenate([[0], np.cumsum(turns[1::2] - starts)]).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(stream[inside])])
    coded = words.dictionary_encode()
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return coded.dictionary, coded.indices.to_numpy(), np.searchsorted(starts, begins)


def listed(words: pa.Array) -> list[bytes]:
    """The array's values, none of them null (``to_pylist`` makes each one by way of a scalar)."""
    if not len(words):
        return []
    _, offsets, data = words.cast(pa.binary()).buffers()
    at = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1]
    data = data.slice(at[0], at[-1] - at[0]).to_pybytes() if data else b""
    at = (at - at[0]).tolist()
    return [data[a:b] for a, b in zip(at, at[1:])]


def chunks(tokens: list[bytes], limit: int = CHUNK):
    """Slices of ``tokens`` of about ``limit`` bytes (at least one token each)."""
    start, size = 0, 0
    for i, t in enumerate(tokens):
        size += len(t) + 1
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(tokens):
        yield start, len(tokens)


@functools.cache
def _power_table(n: int, inverse: bool) -> np.ndarray:
    p = np.full(n, pow(_BASE, -1, 1 << 64) if inverse else _BASE, np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def _powers(n: int, inverse: bool = False) -> np.ndarray:
    """Powers 0 to n-1 of the hash base (or of its inverse) modulo 2^64."""
    return _power_table(1 << max(18, (n - 1).bit_length()), inverse)[:n]


def contexts(tokens: list[bytes], orders: int = ORDERS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, token starts, (``orders``, bytes) context hashes) of the tokens spelled one after the other."""
    stream = np.frombuffer(b" ".join(tokens) + b" ", np.uint8)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    at = np.arange(len(stream)) - np.repeat(starts, lengths)
    out = np.zeros((orders, len(stream)), np.uint64)
    wide = stream.astype(np.uint64)
    ctx = np.zeros(len(stream), np.uint64)
    for order in (1, 2, 3):
        back = np.zeros(len(stream), np.uint64)
        back[order:] = wide[:-order] + np.uint64(1)
        back[at < order] = 0          # nothing before the token
        ctx = ctx * np.uint64(257) + back
        out[order - 1] = ctx
    if orders == 3:
        return stream, starts, out
    with np.errstate(over="ignore"):
        # hash of the token's bytes before this one: sum of byte * BASE^place, shifted to a common power
        power = _powers(len(stream))
        sums = np.concatenate([[np.uint64(0)], np.cumsum((wide + np.uint64(1)) * power, dtype=np.uint64)])[:-1]
        first = np.repeat(sums[starts], lengths)
        out[3] = (sums - first) * np.repeat(_powers(len(stream), True)[starts], lengths) + at.astype(np.uint64)
    return stream, starts, out


def topic_context(ctx: np.ndarray, topic) -> np.ndarray:
    """The prefix context within kind ``topic`` (a number, or one for each byte)."""
    with np.errstate(over="ignore"):
        return ctx[3] * np.uint64(31) + (np.asarray(topic).astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)


def nodes(stream: np.ndarray, bit) -> tuple[np.ndarray, np.ndarray]:
    """Bit ``bit`` (0: highest; a number, or one for each byte) of every byte, and the node of the bits known before it."""
    bit = np.asarray(bit).astype(np.uint32)
    wide = stream.astype(np.uint32)
    node = (np.uint32(1) << bit | wide >> (np.uint32(8) - bit)).astype(np.int64)
    return (wide >> (np.uint32(7) - bit)).astype(np.uint8) & np.uint8(1), node


def slot(ctx: np.ndarray, node: np.ndarray, order: int) -> np.ndarray:
    """Table slot of a context at a node."""
    wide = node.astype(np.uint64)
    if order == 0:
        at = (ctx << np.uint64(8) | wide).astype(np.int64)
    else:
        with np.errstate(over="ignore"):
            h = (ctx * np.uint64(256) + wide + np.uint64(order)) * _MIX
            at = (((h ^ (h >> np.uint64(29))) * _MIX) >> np.uint64(40)).astype(np.int64)
    return (at & (SLOTS[order] - 1)) + _OFFSETS[order]


# ---------------------------------------------------------------------- counts

def word_numbers(words: list[bytes]) -> np.ndarray:
    """A 32-bit number for every word."""
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words))


def text_words(at: np.ndarray, bounds: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word, times): each text's different words and how often it has them (``occurrences``)."""
    each = np.sort(np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * max(n_words, 1) + at)
    new = np.flatnonzero(np.diff(each, prepend=-1))
    return *np.divmod(each[new], max(n_words, 1)), np.diff(np.append(new, len(each)))


def bags(docs: DataFrame) -> DataFrame:
    """Blocks of training texts that have words: a hash of each id, and each text's hash buckets with what they weigh
    (bursts count little)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts, keys, rows = batch["text"].to_pylist(), batch["key"].to_numpy(), []
        for a, b in pieces(texts, BAGS):
            different, at, bounds = occurrences(texts[a:b])
            numbers = word_numbers(listed(different))
            text, word, times = text_words(at, bounds, len(numbers))
            cell = text * TOPIC_BUCKETS + (numbers & (TOPIC_BUCKETS - 1))[word]
            order = np.argsort(cell, kind="stable")
            new = np.flatnonzero(np.diff(cell[order], prepend=-1))
            if len(new):
                x = np.add.reduceat(np.log1p(times)[order], new).astype(np.float16)
                text, bucket = np.divmod(cell[order][new], TOPIC_BUCKETS)
                first = np.flatnonzero(np.diff(text, prepend=-1))
                rows.append((keys[a:b][text[first]].tobytes(), first.tobytes(), bucket.astype(np.uint16).tobytes(), x.tobytes()))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in (zip(*rows) if rows else [()] * 4)], ["key", "first", "bucket", "x"])

    train = docs.filter(fold_of("doc_id", FOLDS) != HELD_OUT)
    return map_batches(text_bytes(train, F.xxhash64("doc_id", F.lit("topic")).alias("key")), run, "key binary, first binary, bucket binary, x binary")


def _blocks(batches):
    """(keys, texts by buckets) of each row of ``bags``."""
    for batch in batches:
        for key, first, bucket, x in zip(*(batch[c].to_pylist() for c in ("key", "first", "bucket", "x"))):
            first, bucket = np.frombuffer(first, np.int64), np.frombuffer(bucket, np.uint16)
            out = np.zeros((len(first), TOPIC_BUCKETS), np.float32)
            out[np.repeat(np.arange(len(first)), np.diff(np.append(first, len(bucket)))), bucket] = np.frombuffer(x, np.float16)
            yield np.frombuffer(key, np.int64), out


def _summed(rows: DataFrame, run, size: int) -> np.ndarray:
    """The sum of the ``size`` numbers that ``run`` makes of each task's batches."""
    def cells(batches):
        total = run(batches)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["cell", "n"])
    got = rows.mapInArrow(cells, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()   # ``size`` rows at most
    out = np.zeros(size)
    out[got["cell"].to_numpy()] = got["n"].to_numpy()
    return out


def em_round(blocks: DataFrame, shares: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log likelihoods of mixtures (mixtures, kinds), (mixtures, kinds, buckets)
    over all texts, the texts that fall to each kind, and their buckets' sums."""
    many, kinds = shares.shape
    shared = blocks.sparkSession.sparkContext.broadcast((shares, logs.reshape(many * kinds, -1).T.astype(np.float32)))

    def run(batches):
        shares, logs = shared.value
        like, mass, words = np.zeros(many), np.zeros((many, kinds)), np.zeros((many * kinds, TOPIC_BUCKETS))
        for _, x in _blocks(batches):
            each = shares + (x @ logs).astype(np.float64).reshape(-1, many, kinds)
            top = each.max(axis=2, keepdims=True)
            weight = np.exp(each - top)
            sums = weight.sum(axis=2, keepdims=True)
            like += (top + np.log(sums)).sum(axis=(0, 2))
            weight /= sums
            mass += weight.sum(axis=0)
            words += weight.reshape(len(x), -1).astype(np.float32).T @ x
        return np.concatenate([like, mass.ravel(), words.ravel()])

    out = _summed(blocks, run, many + many * kinds * (1 + TOPIC_BUCKETS))
    shared.unpersist()
    return out[:many], out[many:many + many * kinds].reshape(many, kinds), out[many + many * kinds:].reshape(many, kinds, -1)


def topics(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of the kinds, and their log unigrams over hash buckets: a
    mixture fitted by EM on all training documents.  ``RESTARTS`` mixtures
    start from random documents; the likeliest after some rounds is fitted on."""
    blocks = stored(bags(docs), "bags")
    n_starts = RESTARTS * TOPICS

    def first_keys(batches):
        """The task's texts of the smallest keys."""
        held = np.zeros(0, np.int64), np.zeros((0, TOPIC_BUCKETS), np.float32)
        for key, x in _blocks(batches):
            keys, xs = np.concatenate([held[0], key]), np.concatenate([held[1], x])
            order = np.lexsort((xs.sum(axis=1), keys))[:n_starts]
            held = keys[order], xs[order]
        yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(list(held[1]), pa.list_(pa.float32()))], ["key", "x"])

    starts = blocks.mapInArrow(first_keys, "key bigint, x array<float>").orderBy("key", "x").limit(n_starts).toArrow()
    if starts.num_rows < 2 * TOPICS:
        return np.zeros(1), np.zeros((1, TOPIC_BUCKETS))
    x = starts["x"].combine_chunks().flatten().to_numpy().reshape(-1, TOPIC_BUCKETS).astype(np.float64)
    chosen = np.stack([np.random.default_rng(seed).choice(len(x), TOPICS, replace=False) for seed in range(RESTARTS)])
    if len(x) == n_starts:
        chosen = np.arange(n_starts).reshape(RESTARTS, TOPICS)
    _, n, sums = em_round(blocks, np.zeros((1, 1)), np.zeros((1, 1, TOPIC_BUCKETS)))
    n = n[0, 0]
    words, shares, before = x[chosen] + 0.05 * sums[0] / n + 1e-3, np.full((RESTARTS, TOPICS), -np.log(TOPICS)), -np.inf
    for step in range(ROUNDS):
        logs = np.log(words / words.sum(axis=2, keepdims=True)).astype(np.float32)
        like, mass, sums = em_round(blocks, shares, logs)
        shares, words = np.log((mass + 1) / (n + TOPICS)), sums + 0.05
        if step + 1 >= SHORT_ROUNDS:
            best = [int(like.argmax())]
            if like[best[0]] - before < 1e-5 * abs(like[best[0]]):
                break
            shares, words, before = shares[best], words[best], like[best[0]]
    best = int(like.argmax())
    return shares[best], np.log(words[best] / words[best].sum(axis=1, keepdims=True)).astype(np.float32)


# ------------------------------------------------------ across the token's edge

def pairs_of(words: list[bytes], numbers: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For every token of the texts, their ends included: (slot of the token before it, its own first byte) as one
    number.  ``at``, ``bounds``: as ``occurrences`` gives them; ``numbers``: of the words."""
    n, texts = len(at), len(bounds) - 1
    place = np.arange(n) + np.repeat(np.arange(texts), np.diff(bounds))     # an end stands behind each text
    slots = np.full(n + texts, START, np.int64)
    first = np.full(n + texts, 32, np.int64)
    if n:
        slots[place + 1] = (numbers & (EDGE_SLOTS - 1))[at]
        first[place] = np.fromiter(map(itemgetter(0), words), np.int64, len(words))[at]
    return slots * 256 + first


def likeliest_kinds(found: tuple[np.ndarray, np.ndarray], numbers: np.ndarray, at: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The likeliest kind of each text (arguments as for ``pairs_of``)."""
    shares, logs = found
    texts = len(bounds) - 1
    if len(shares) == 1:
        return np.zeros(texts, np.int64)
    like = np.tile(shares[:, None], (1, texts))
    if len(at):
        text, word, times = text_words(at, bounds, len(numbers))
        weight = np.log1p(times)
        for k, log in enumerate(logs):
            like[k] += np.bincount(text, log[numbers & (TOPIC_BUCKETS - 1)][word] * weight, texts)
    return like.argmax(axis=0)


def edge_rows(total: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Counted pairs as rows beside the tokens': a space (which no token holds), the slot's two bytes and the byte."""
    at = np.flatnonzero(total)
    slots, first = at // 256, at % 256
    return [b" " + bytes(x) for x in np.stack([slots >> 8, slots & 255, first], axis=1).astype(np.uint8).tolist()], total[at]


def edge_counts(rows: pa.Table, kinds: int) -> np.ndarray:
    """(kinds, EDGE_SLOTS + 1, 256): how often each byte begins a token behind the tokens of each slot."""
    out = np.zeros((kinds, (EDGE_SLOTS + 1) * 256), np.int64)
    names = np.frombuffer(b"".join(rows["token"].to_pylist()), np.uint8).reshape(-1, 4).astype(np.int64)
    for k in range(kinds):
        out[k, (names[:, 1] * 256 + names[:, 2]) * 256 + names[:, 3]] = rows[f"c{k}"].to_numpy()
    return out.reshape(kinds, -1, 256)


def edge_bits(counts: np.ndarray, rounds: int = 100, rate: float = 0.05) -> np.ndarray:
    """(kinds, EDGE_SLOTS + 1, 256): bits of every byte behind every slot.

    Each bit of the byte is predicted by three counts: of the slot in this kind
    of text, of the slot in all kinds, and of all slots in this kind.  They are
    mixed in the logistic domain by weights that depend on how often the first
    has been seen; the weights are fitted on all counts, with each occurrence
    left out of its own."""
    steps, weights = [], np.tile([0.5, 0.3, 0.3, 0.0], (EDGE_SURE, 1))
    for depth in range(8):
        n = counts.reshape(*counts.shape[:2], 1 << depth, 2, -1).sum(axis=4).astype(np.float64)
        slot_, kind = (np.broadcast_to(n.sum(axis=a, keepdims=True), n.shape) for a in (0, 1))
        sure = np.minimum(np.log2(1 + n.sum(axis=3)), EDGE_SURE - 1).astype(np.int64)
        steps.append((n, slot_, kind, sure))

    def stretch(n, one: int, left_out: float):
        """Stretched probability of a one, with ``left_out`` occurrences of bit ``one`` taken out."""
        n0, n1 = n[..., 0] - left_out * (one == 0), n[..., 1] - left_out * (one == 1)
        return np.log((np.maximum(n1, 0) + 0.3) / (np.maximum(n0, 0) + 0.3))

    cases = []
    for n, slot_, kind, sure in steps:
        for one in (0, 1):
            here = n[..., one] > 0
            x = np.stack([stretch(c[here], one, 1.0) for c in (n, slot_, kind)] + [np.ones(int(here.sum()))])
            cases.append((x, n[here][:, one], float(one), sure[here]))
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, rounds + 1):
        grad, mass = np.zeros_like(weights), np.full(EDGE_SURE, 1.0)
        for x, n, one, sure in cases:
            err = n * (_squash((weights[sure].T * x).sum(axis=0)) - one)
            grad += np.stack([np.bincount(sure, err * part, EDGE_SURE) for part in x], axis=1)
            mass += np.bincount(sure, n, EDGE_SURE)
        grad /= mass[:, None]
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        weights = weights - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-4)
    out = np.zeros(counts.shape)
    for depth, (n, slot_, kind, sure) in enumerate(steps):
        w = weights[sure]
        x = sum(w[..., i] * stretch(c, 0, 0.0) for i, c in enumerate((n, slot_, kind))) + w[..., 3]
        p = np.clip(_squash(x), 1e-6, 1 - 1e-6)
        both = -np.log2(np.stack([1 - p, p], axis=3)).reshape(*counts.shape[:2], -1)
        out += np.repeat(both, 128 >> depth, axis=2)
    return out.astype(np.float32)


# ---------------------------------------------------------------------- counts

def token_counts(docs: DataFrame, kinds: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """token (bytes; empty: the end; the pairs of ``edge_rows`` as well), c0, c1, ... (in training texts of each
    kind), c (in training texts), c_all (in all texts); the kinds' document counts are those of the end."""
    shared = docs.sparkSession.sparkContext.broadcast(kinds)
    n_kinds = len(kinds[0])

    def run(batches):
        edges = np.zeros((n_kinds, (EDGE_SLOTS + 1) * 256), np.int64)
        for batch in batches:
            texts, folds = batch["text"].to_pylist(), batch["fold"].to_pylist()
            for a, b in pieces(texts):
                different, at, bounds = occurrences(texts[a:b])
                words = listed(different)
                numbers = word_numbers(words)
                train = np.array([f is not None and f != HELD_OUT for f in folds[a:b]])
                kind = np.where(train, likeliest_kinds(shared.value, numbers, at, bounds), n_kinds)
                pairs, lengths = pairs_of(words, numbers, at, bounds), np.diff(bounds)
                of_pair = np.repeat(kind, lengths + 1)
                for k in np.unique(kind[kind < n_kinds]).tolist():
                    edges[k] += np.bincount(pairs[of_pair == k], minlength=edges.shape[1])
                # the ends, then the words
                n = np.zeros((n_kinds + 1, 1 + len(words)), np.int32)
                n[:, 0] = np.bincount(kind, minlength=n_kinds + 1)
                n[:, 1:] = np.bincount(np.repeat(kind, lengths) * len(words) + at, minlength=n[:, 1:].size).reshape(n_kinds + 1, -1)
                yield _token_rows(pa.concat_arrays([pa.array([b""], pa.binary()), different]), n)
        for k, total in enumerate(edges):
            names, n = edge_rows(total)
            rest = np.zeros((n_kinds + 1, len(n)), np.int64)
            rest[k] = n
            yield _token_rows(pa.array(names, pa.binary()), rest)

    rows = text_bytes(docs, fold_of("doc_id", FOLDS).alias("fold")).select("text", "fold")
    per = [f"c{k}" for k in range(n_kinds)]
    sums = rows.mapInArrow(run, "token binary, " + ", ".join(f"{c} bigint" for c in [*per, "other"])).groupBy("token").agg(
        *[F.sum(c).alias(c) for c in [*per, "other"]])
    c = sum((F.col(k) for k in per[1:]), F.col(per[0]))
    return sums.select("token", *per, c.alias("c"), (c + F.col("other")).alias("c_all"))


def _token_rows(tokens: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
    """Tokens, and how often they are in training texts of each kind and in other texts."""
    return pa.RecordBatch.from_arrays([tokens, *map(pa.array, counts.astype(np.int64))],
                                      ["token", *(f"c{k}" for k in range(len(counts) - 1)), "other"])


def _add(table: np.ndarray, tokens: list[bytes], counts: np.ndarray, orders, topic: int | None = None) -> None:
    """Add the tokens' bit counts to table (2, slots), for the given orders (the last one: within ``topic``)."""
    flat, size = table.reshape(-1), table.shape[1]
    for a, b in chunks(tokens):
        stream, starts, ctx = contexts(tokens[a:b], ORDERS if max(orders) > 2 else 3)
        if topic is not None:
            ctx[4] = topic_context(ctx, topic)
        weight = np.repeat(counts[a:b], np.diff(np.append(starts, len(stream)))).astype(np.float64)
        for bit in range(8):
            ones, node = nodes(stream, bit)
            for k in orders:
                np.add.at(flat, slot(ctx[k], node, k) + ones.astype(np.int64) * size, weight)


def long_slices(token: bytes):
    """(bytes, context hashes of orders 1 to 3, the first and the end of its own
    bytes) of each slice of a token; the bytes before its own are the token's."""
    for a in range(0, len(token), CHUNK):
        lead = min(a, 3)
        stream, _, ctx = contexts([token[a - lead:a + CHUNK]], 3)
        # a slice in the middle has no closing space
        yield stream, ctx, lead, len(stream) if a + CHUNK >= len(token) else len(stream) - 1


def _add_long(table: np.ndarray, token: bytes, count: float) -> None:
    """``_add`` for one token of any length, a slice at a time (orders 1 to 3)."""
    flat, size = table.reshape(-1), table.shape[1]
    for stream, ctx, first, end in long_slices(token):
        for bit in range(8):
            ones, node = nodes(stream[first:end], bit)
            for k in range(3):
                np.add.at(flat, slot(ctx[k, first:end], node, k) + ones.astype(np.int64) * size, float(count))


def context_counts(counts: DataFrame) -> DataFrame:
    """slot, n0, n1 of the byte contexts (orders 1 to 3) over all distinct training tokens."""
    size = int(_OFFSETS[3])

    def run(batches):
        table = np.zeros((2, size))
        for batch in batches:
            tokens, c = listed(batch["token"]), batch["c"].to_numpy(zero_copy_only=False)
            short = np.fromiter((len(t) <= LONG for t in tokens), bool, len(tokens))
            _add(table, [t for t in tokens if len(t) <= LONG], c[short], range(3))
            for i in np.flatnonzero(~short).tolist():
                _add_long(table, tokens[i], c[i])
        at = np.flatnonzero(table.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(table[0, at]), pa.array(table[1, at])], ["slot", "n0", "n1"])

    return (counts.filter(F.col("c") > 0).select("token", "c").mapInArrow(run, "slot bigint, n0 double, n1 double")
            .groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")))


# -------------------------------------------------------------- prefix counts

def shared_bits(a: bytes, b: bytes) -> int:
    """Leading bits that two different spelled tokens share."""
    n = min(len(a), len(b))
    return 8 * n - (int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length()


_LEAD = np.array([8, *(7 - int(np.log2(b)) for b in range(1, 256))])


def shared_along(spelled: list[bytes]) -> np.ndarray:
    """``shared_bits`` of each spelled token and the next one (each ends in a space that it holds nowhere else)."""
    if len(spelled) < 2:
        return np.zeros(0, np.int64)
    stream = np.frombuffer(b"".join(spelled), np.uint8)
    ends = np.cumsum(np.fromiter(map(len, spelled), np.int64, len(spelled)))
    here, after = np.append(0, ends[:-2]), ends[:-1]
    out, pair, byte = np.zeros(len(here), np.int64), np.arange(len(here)), 0
    while len(pair):
        differ = stream[here + byte] ^ stream[after + byte]
        apart = differ != 0
        out[pair[apart]] = 8 * byte + _LEAD[differ[apart]]
        pair, here, after, byte = pair[~apart], here[~apart], after[~apart], byte + 1
    return out


def token_runs(counts: DataFrame, kinds: int, limit: int = RUN) -> DataFrame:
    """token, c_all, c0, c1, ...: arrays of up to ``limit`` bytes of neighbouring tokens, in spelled order."""
    names = ["token", "c_all", *(f"c{k}" for k in range(kinds))]

    def run(batches):
        held, size = [], 0
        for batch in batches:
            start = 0
            for i, token in enumerate(listed(batch["token"])):
                size += len(token) + 1
                if size >= limit:
                    yield _run_row([*held, batch.slice(start, i + 1 - start)], names)
                    held, size, start = [], 0, i + 1
            if start < batch.num_rows:
                held.append(batch.slice(start))
        if held:
            yield _run_row(held, names)

    spelled = F.concat(F.col("token"), F.lit(b" "))
    short = counts.filter(F.octet_length("token") <= LONG)
    # some eight runs a partition: their work is by tokens, of which there are many in a few bytes
    size = short.agg(F.sum(F.octet_length("token") + 1)).first()[0] or 0
    ordered = short.select(*names, spelled.alias("spelled")).repartitionByRange(max(1, -(-size // (8 * limit))), "spelled").sortWithinPartitions("spelled")
    return ordered.select(*names).mapInArrow(
        run, "token array<binary>, " + ", ".join(f"{n} array<bigint>" for n in names[1:]))


def _run_row(parts: list[pa.RecordBatch], names: list[str]) -> pa.RecordBatch:
    table = pa.Table.from_batches(parts).combine_chunks()
    cols = [pa.concat_arrays(table[n].chunks) for n in names]
    return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in cols], names)


def _runs(batch: pa.RecordBatch, kinds: int):
    """(tokens, (tokens, kinds) counts, c_all) of each row of ``token_runs``."""
    for i in range(batch.num_rows):
        yield (listed(batch["token"][i].values),
               np.stack([batch[f"c{k}"][i].values.to_numpy() for k in range(kinds)], axis=1).astype(np.float64),
               batch["c_all"][i].values.to_numpy())


def _along(shared: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(depths, kinds): tokens of a run that share the first token's leading
    bits, by their number; the last depth's value holds for all deeper ones."""
    least = np.minimum.accumulate(shared)
    sums = np.cumsum(counts, axis=0)
    depth = np.arange(int(least[0]) + 2 if len(least) else 1)
    return sums[len(least) - np.searchsorted(least[::-1], depth)]


def run_edges(runs: DataFrame, kinds: int) -> dict[bytes, tuple[np.ndarray, np.ndarray]]:
    """For each run (named by its first token): the counts, by depth, of the
    tokens before and after it that share its first and its last token's bits."""
    def run(batches):
        for batch in batches:
            rows = []
            for tokens, counts, _ in _runs(batch, kinds):
                spelled = [t + b" " for t in tokens]
                shared = shared_along(spelled)
                rows.append((tokens[0], tokens[-1], int(shared.min()) if len(shared) else 8 * len(spelled[0]),
                             _along(shared, counts).ravel(), _along(shared[::-1], counts[::-1]).ravel()))
            types = [pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 5, types)],
                                             ["first", "last", "whole", "head", "tail"])

    # two tokens, and the counts along them, for every RUN bytes of distinct tokens
    rows = runs.mapInArrow(run, "first binary, last binary, whole bigint, head array<double>, tail array<double>").toArrow().to_pylist()
    rows.sort(key=lambda r: r["first"] + b" ")
    none = np.zeros((0, kinds))
    before, after = [none], [none]
    for a, b in zip(rows, rows[1:]):
        before.append(_beyond(a["tail"], a["whole"], before[-1], shared_bits(a["last"] + b" ", b["first"] + b" "), kinds))
    for b, a in zip(rows[::-1], rows[-2::-1]):
        after.append(_beyond(b["head"], b["whole"], after[-1], shared_bits(a["last"] + b" ", b["first"] + b" "), kinds))
    return {r["first"]: x for r, x in zip(rows, zip(before, after[::-1]))}


def _beyond(near: list[float], whole: int, far: np.ndarray, shared: int, kinds: int) -> np.ndarray:
    """Counts by depth (up to ``shared`` bits) in the next run, and in those behind it where all of the run shares the bits."""
    near = np.array(near).reshape(-1, kinds)
    out = near[np.minimum(np.arange(shared + 1), len(near) - 1)]
    n = min(shared, whole, len(far) - 1) + 1
    out[:n] += far[:n]
    return out


class Prefixes:
    """The different bit prefixes of a run's tokens (distinct, in spelled order), each met once.

    First the prefixes that several tokens of the run share, by length
    (``levels`` cuts them; the first one is empty), then the bits of each token
    that it has alone (``tails`` begins them).  ``owner``, ``depth``: first token
    with the prefix and its bits; ``up``: the prefix of one bit less; ``own``:
    (prefixes, kinds) counts in the run; ``same``: with those beyond its ends;
    both are columns ``row`` of (kinds, rows) ``own_rows`` and ``same_rows``
    (``whole_rows``: of all kinds); ``last``: each token's longest shared prefix."""

    def __init__(self, tokens: list[bytes], counts: np.ndarray, before: np.ndarray, after: np.ndarray):
        n, kinds = counts.shape
        lengths = np.fromiter(map(len, tokens), np.int64, n) + 1
        shared = np.array([0, *shared_along([t + b" " for t in tokens]), 0], np.int64)
        deepest = np.maximum(shared[:-1], shared[1:])
        sums = np.concatenate([np.zeros((1, kinds)), np.cumsum(counts, axis=0)])
        self.last = np.zeros(n, np.int64)
        owner, stop, up, self.levels = [np.zeros(1, np.int64)], [np.full(1, n)], [np.zeros(1, np.int64)], [0, 1]
        live = np.arange(n)
        while True:
            live = live[deepest[live] >= len(owner)]
            if not len(live):
                break
            new = shared[live] < len(owner)
            first = np.flatnonzero(new)
            owner.append(live[first])
            stop.append(live[np.append(first[1:], len(live)) - 1] + 1)
            up.append(self.last[owner[-1]])
            self.last[live] = self.levels[-1] + np.cumsum(new) - 1
            self.levels.append(self.levels[-1] + len(first))
        self.tails = self.levels[-1] + np.cumsum(8 * lengths - deepest) - (8 * lengths - deepest)
        alone = np.repeat(np.arange(n), 8 * lengths - deepest)
        place = np.arange(self.levels[-1], self.levels[-1] + len(alone))
        above = place - 1
        above[self.tails - self.levels[-1]] = self.last
        self.owner, self.up = np.concatenate([*owner, alone]), np.concatenate([*up, above])
        self.depth = np.concatenate([np.repeat(np.arange(len(owner)), np.diff(self.levels)), place - self.tails[alone] + deepest[alone] + 1])
        # counts: a row for each shared prefix and for each token (its bits alone have the same counts), by kind
        stop, inside = np.concatenate(stop), self.levels[-1]
        self.row = np.concatenate([np.arange(inside), inside + alone])
        # and one for each bit of the first and the last token that goes on beyond the run's ends
        head = np.append(np.flatnonzero(self.owner[:inside] == 0), np.arange(inside, inside + 8 * lengths[0] - deepest[0]))
        tail = np.append(np.flatnonzero(stop == n), np.arange(self.tails[-1], len(self.owner)))
        ends = np.union1d(head[head >= inside], tail[tail >= inside])
        ends = ends[self.depth[ends] < max(len(before), len(after))]
        self.row[ends] = inside + n + np.arange(len(ends))
        self.own_rows = np.concatenate([sums[stop] - sums[self.owner[:inside]], counts, counts[self.owner[ends]]])
        self.same_rows = self.own_rows.copy()
        for at, beyond in ((head, before), (tail, after)):
            at = at[self.depth[at] < len(beyond)]
            self.same_rows[self.row[at]] += beyond[self.depth[at]]
        self.own_rows, self.same_rows = np.ascontiguousarray(self.own_rows.T), np.ascontiguousarray(self.same_rows.T)
        self.whole_rows = self.same_rows.sum(axis=0)     # in all kinds

    @property
    def own(self) -> np.ndarray:
        return self.own_rows.T[self.row]

    @property
    def same(self) -> np.ndarray:
        return self.same_rows.T[self.row]

    def along(self, values: np.ndarray) -> np.ndarray:
        """(kinds, tokens): sums of the prefixes' (kinds, prefixes) values along each token."""
        out = np.add.reduceat(values, self.tails, axis=1)
        sums = values[:, :self.levels[-1]].copy()
        for a, b in zip(self.levels[1:], self.levels[2:]):
            sums[:, a:b] += sums[:, self.up[a:b]]
        return out + sums[:, self.last]


def prefix_counts(tokens: list[bytes], counts: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """(2, 8, kinds, bytes): for every bit of the spelled tokens (distinct, in
    spelled order), how often the bits known before it were followed by its
    value and by the other one, in the tokens and beyond their ends."""
    found = Prefixes(tokens, counts, before, after)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
    starts = np.cumsum(lengths) - lengths
    out = np.zeros((2, 8, counts.shape[1], int(lengths.sum())), np.float32)
    token, at, same = np.arange(len(tokens)), np.append(found.tails[1:], len(found.owner)) - 1, found.same
    while len(token):
        byte, bit = np.divmod(found.depth[at] - 1, 8)
        out[0, bit, :, starts[token] + byte] = same[at]
        out[1, bit, :, starts[token] + byte] = same[found.up[at]] - same[at]
        at = found.up[at]
        token, at = token[found.depth[at] > 0], at[found.depth[at] > 0]
    return out


def prefix_counts_of(at: int, shared: np.ndarray, counts: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """(2, 8, kinds, ``length``): ``prefix_counts`` of one token of a run, from
    the bits that neighbours share; only the counts along it are made."""
    def side(near: np.ndarray, own_first: np.ndarray, beyond: np.ndarray) -> np.ndarray:
        """Counts by depth of the token and those on one side of it, and in the runs behind."""
        along = _along(near, own_first)
        out = along[np.minimum(np.arange(8 * length + 1), len(along) - 1)]
        deep = min(int(near.min()) if len(near) else 8 * length, len(beyond) - 1, 8 * length) + 1
        out[:deep] += beyond[:deep]
        return out
    total = side(shared[at:], counts[at:], after) + side(shared[:at][::-1], counts[:at + 1][::-1], before) - counts[at]
    return np.stack([total[1:], total[:-1] - total[1:]]).reshape(2, length, 8, -1).transpose(0, 2, 3, 1).astype(np.float32)


# ----------------------------------------------------------------------- model

_SURE = 7                # steps of confidence
_STEP = np.array([0, 1, 2, 2, 3, 3, 4, 4, 5, 5, 5] + [6] * 10, np.intp)
_GATES = _SURE * _SURE * 4
_BUCKETS = 48


def _squash(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-x))


class Model:
    """Context tables, gated mixing weights, the refinement table, and the kinds' log shares."""

    def __init__(self, table: np.ndarray, shares: np.ndarray):
        self.n0, self.n1 = table
        self.shares = shares
        self.weights = np.full((_GATES, ORDERS + 1), 0.2)
        self.weights[:, -1] = 0.0
        # refinement: per node and bucket of the mixed probability, [zeros, ones]
        centre = _squash((np.arange(_BUCKETS + 1) - _BUCKETS / 2) / 2)
        self.refined = np.stack([np.tile(30 * (1 - centre), (256, 1)), np.tile(30 * centre, (256, 1))])
        self.freeze()

    def freeze(self) -> None:
        """Tabulate what scoring reads: stretched probabilities, confidences, weights by input."""
        self.stretch, self.sure = np.empty(len(self.n0), np.float32), np.empty(len(self.n0), np.uint8)
        for at in range(0, len(self.n0), 1 << 20):      # bounded memory
            part = slice(at, at + (1 << 20))
            self.stretch[part] = self._stretch(self.n0[part], self.n1[part])
            self.sure[part] = self._sure(self.n0[part] + self.n1[part])
        self.by_input = np.ascontiguousarray(self.weights.T).astype(np.float32)
        self.turned = (self.refined / self.refined.sum(axis=0)).astype(np.float32)

    @staticmethod
    def _stretch(n0, n1):
        return np.clip(np.log((n1 + 0.02) / (n0 + 0.02)), -12, 12)

    @staticmethod
    def _sure(n):
        # log2 rounded down is the exponent of the number
        return np.minimum((np.asarray(1 + n, np.float32).view(np.int32) >> 23) - 127, 20).astype(np.uint8)

    @staticmethod
    def _gate(topic, prefix, three):
        """Weight set: steps of log2 of how often the contexts have been seen."""
        return _STEP.take(topic) * (4 * _SURE) + Model._shared_gate(prefix, three)

    @staticmethod
    def _shared_gate(prefix, three):
        return _STEP.take(prefix) * 4 + np.minimum(three >> 2, 3)

    def mixed(self, st, gate: np.ndarray) -> np.ndarray:
        """Stretched probability of a one: gated weights over the ORDERS inputs."""
        w = self.by_input
        out = w[ORDERS].take(gate)
        for k, x in enumerate(st):      # an input not given is zero
            part = w[k].take(gate)
            part *= x
            out += part
        return np.clip(out, -11.9, 11.9, out=out)

    def cost(self, x: np.ndarray, ones: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Bits of the bits ``ones``: by the mixed probability, a quarter of it replaced by what its neighbouring buckets
        have turned out to be (interpolated).  A bit's own probability is made, which one less the other's would round."""
        place = 2 * x + _BUCKETS / 2
        low = place.astype(np.int32)
        part = place - low.astype(x.dtype)
        at = ((ones.astype(np.int64) << 8) + node) * (_BUCKETS + 1) + low
        flat = self.turned.reshape(-1)
        below, above = flat.take(at), flat.take(at + 1)
        p = 0.75 * _squash(x * (ones * np.float32(2) - np.float32(1))) + 0.25 * (below + part * (above - below))
        return -np.log2(np.clip(p, 1e-6, 1 - 1e-6, out=p))

    def _seen(self, ones, same, other) -> tuple[np.ndarray, np.ndarray]:
        """Stretched probability of a one, and confidence, from the counts of a bit's value and of the other one."""
        st = self._stretch(other.astype(np.float32), same.astype(np.float32))
        return np.where(ones == 1, st, -st), self._sure((same + other).astype(np.float32))

    def token_bits(self, tokens: list[bytes]) -> np.ndarray:
        """(kinds, tokens): bits of each token behind its first byte under the
        frozen model, with the prefix counts of the hashed tables."""
        kinds = len(self.shares)
        out = np.zeros((kinds, len(tokens)))
        for a, b in chunks(tokens):
            stream, starts, ctx = contexts(tokens[a:b])
            own = [topic_context(ctx, k) for k in range(kinds)]
            bits = np.zeros((kinds, len(stream)))
            for bit in range(8):
                ones, node = nodes(stream, bit)
                at = [slot(ctx[k], node, k) for k in range(4)]
                st = [self.stretch[x] for x in at]
                last = np.stack([slot(c, node, ORDERS - 1) for c in own])
                shared = self._shared_gate(self.sure[at[3]], self.sure[at[2]])
                for kind in range(kinds):
                    x = self.mixed([*st, self.stretch[last[kind]]], _STEP[self.sure[last[kind]]] * (4 * _SURE) + shared)
                    bits[kind] += self.cost(x, ones, node)
            bits[:, starts] = 0      # the first byte is coded from the token before
            out[:, a:b] = np.add.reduceat(bits, starts, axis=1)
        return out

    def run_bits(self, tokens: list[bytes], prefixes: Prefixes) -> np.ndarray:
        """(kinds, tokens): as ``token_bits``, with the exact counts of the run's prefixes, each of which is scored once."""
        kinds = len(self.shares)
        bits = np.zeros((kinds, len(prefixes.owner)))

        for at, ones, node, slots in prefix_bits(tokens, prefixes):
            row, up = prefixes.row[at], prefixes.row.take(prefixes.up[at])
            whole = prefixes.whole_rows.take(row)
            st, sure = self._seen(ones, whole, prefixes.whole_rows.take(up) - whole)
            st = np.stack([*(self.stretch.take(x) for x in slots), st])
            shared = self._shared_gate(sure, self.sure.take(slots[2]))
            # most prefixes are new to most kinds, which then predict alike
            part = np.tile(self.cost(self.mixed(st, shared), ones, node), (kinds, 1))
            met, kind = _filled(prefixes.same_rows, up)
            same, ones = prefixes.same_rows.reshape(-1).take(kind + row.take(met)), ones.take(met)
            by_kind, sure = self._seen(ones, same, prefixes.same_rows.reshape(-1).take(kind + up.take(met)) - same)
            st = [*(x.take(met) for x in st), by_kind]
            by_kind = self.cost(self.mixed(st, _STEP.take(sure) * (4 * _SURE) + shared.take(met)), ones, node.take(met))
            for k, (a, b) in enumerate(_slices(kind, kinds, prefixes.same_rows.shape[1])):
                part[k, met[a:b]] = by_kind[a:b]
            bits[:, at] = part
        return prefixes.along(bits)

    def leave_out(self) -> None:
        """Tabulate what training reads: stretched probabilities of the byte contexts' bits, and confidences, with one
        occurrence of a zero or of a one taken out."""
        self.left, self.left_sure = np.empty((2, len(self.n0)), np.float32), np.empty((2, len(self.n0)), np.uint8)
        for at in range(0, len(self.n0), 1 << 18):      # bounded memory
            part = slice(at, at + (1 << 18))
            for one in range(2):
                n0, n1 = (np.maximum(n[part] - np.float32(one == k), 0) for k, n in enumerate((self.n0, self.n1)))
                self.left[one, part], self.left_sure[one, part] = self._stretch(n0, n1), self._sure(n0 + n1)

    def run_cases(self, tokens: list[bytes], prefixes: Prefixes):
        """What training occurrences behind first bytes are predicted from, a
        part of a run at a time: how many, (inputs, cases) with the occurrence
        itself taken out of the counts, gates, bits, nodes."""
        whole, by_kind = prefixes.whole_rows, prefixes.same_rows.reshape(-1)
        for at, ones, node, slots, kind in prefix_bits(tokens, prefixes, trained=True):
            row, up = prefixes.row.take(at), prefixes.row.take(prefixes.up.take(at))
            of_kind, up_kind = kind + row, kind + up
            st, seen, one = np.empty((ORDERS, len(at)), np.float32), [], ones * np.int64(len(self.n0))
            sign = ones * np.float32(2) - np.float32(1)
            for k, x in enumerate(slots):
                st[k] = self.left.reshape(-1).take(x + one)
            for k, rows, here, above in ((3, whole, row, up), (4, by_kind, of_kind, up_kind)):
                same, n = rows.take(here), rows.take(above)
                st[k] = self._stretch((n - same).astype(np.float32), (same - 1).astype(np.float32)) * sign
                seen.append(self._sure((n - 1).astype(np.float32)))
            gate = self._shared_gate(seen[0], self.left_sure.reshape(-1).take(slots[2] + one))
            yield prefixes.own_rows.reshape(-1).take(of_kind), st, _STEP.take(seen[1]) * (4 * _SURE) + gate, ones, node

    def long_token_bits(self, token: bytes) -> float:
        """Bits of a token of any length from the three bytes before each of its
        own, a slice at a time; no count of whole prefixes is at hand, so it
        costs the same in every kind."""
        total = 0.0
        for stream, ctx, lead, stop in long_slices(token):
            for bit in range(8):
                ones, node = nodes(stream, bit)
                at = [slot(ctx[k], node, k) for k in range(3)]
                none = np.zeros(len(stream), np.float32)
                gate = self._gate(np.zeros(len(stream), np.int64), np.zeros(len(stream), np.int64), self.sure[at[2]])
                cost = self.cost(self.mixed([*(self.stretch[x] for x in at), none, none], gate), ones, node)
                # the first byte is coded from the token before
                total += float(cost[max(lead, 1):stop].sum(dtype=np.float64))
        return total

    def long_cases(self, token: bytes, count: float):
        """``run_cases`` of a token of any length, as ``long_token_bits`` codes it, a slice at a time."""
        for stream, ctx, lead, stop in long_slices(token):
            at = slice(max(lead, 1), stop)
            for bit in range(8):
                ones, node = nodes(stream[at], bit)
                st, none = np.zeros((ORDERS, len(ones)), np.float32), np.zeros(len(ones), np.int64)
                for k in range(3):
                    x = slot(ctx[k, at], node, k) + ones * np.int64(len(self.n0))
                    st[k] = self.left.reshape(-1).take(x)
                yield np.full(len(ones), float(count)), st, self._gate(none, none, self.left_sure.reshape(-1).take(x)), ones, node

    def train(self, tokens: list[bytes], kinds: np.ndarray, rate: float = 0.03) -> None:
        """Online passes in steps of 256 tokens, first for the weights (Adam,
        with a falling rate), then for the refinement; a token's own occurrence
        is taken out of the counts before they predict it."""
        m, v, t = np.zeros_like(self.weights), np.zeros_like(self.weights), 0
        for phase in ("weights", "weights", "refinement"):
            for a in range(0, len(tokens), 256):
                part = tokens[a:a + 256]
                stream, starts, ctx = contexts(part)
                ctx[4] = topic_context(ctx, np.repeat(kinds[a:a + 256], np.diff(np.append(starts, len(stream)))))
                for bit in range(8):
                    ones, node = nodes(stream, bit)
                    at = np.stack([slot(ctx[k], node, k) for k in range(ORDERS)])
                    n0, n1 = self.n0[at], self.n1[at]
                    n0 = np.maximum(n0 - (ones == 0), 0)
                    n1 = np.maximum(n1 - (ones == 1), 0)
                    st = self._stretch(n0, n1)
                    sure = self._sure(n0 + n1)
                    gate = self._gate(sure[4], sure[3], sure[2])
                    x = self.mixed(st, gate)
                    if phase == "refinement":
                        self.refined += self.turned_out(x, ones, node, np.ones(len(x)))
                        continue
                    err = ones - _squash(x)
                    n = np.bincount(gate, minlength=_GATES) + 4.0
                    grad = np.stack([np.bincount(gate, err * st[k], _GATES) / n for k in range(ORDERS)]
                                    + [np.bincount(gate, err, _GATES) / n], axis=1)
                    t += 1
                    m = 0.9 * m + 0.1 * grad
                    v = 0.99 * v + 0.01 * grad * grad
                    self.weights += rate / (1 + t / 400) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-3)
                    self.by_input = self.weights.T

    @staticmethod
    def turned_out(x: np.ndarray, ones: np.ndarray, node: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """(2, nodes, buckets): bits that turned out behind the mixed probabilities, shared by neighbouring buckets."""
        place = 2 * x + _BUCKETS / 2
        low = place.astype(np.int64)
        part = place - low
        cell = (ones.astype(np.int64) * 256 + node) * (_BUCKETS + 1) + low
        size = 2 * 256 * (_BUCKETS + 1)
        return (np.bincount(cell, weight * (1 - part), size) + np.bincount(cell + 1, weight * part, size)).reshape(2, 256, -1)


def _filled(rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the columns ``at`` of (kinds, rows) counts, those that are not zero, kind by kind: their places in ``at``,
    and where their kind's counts begin in the flat counts."""
    met = [np.flatnonzero((row > 0).take(at)) for row in rows]
    return np.concatenate(met), np.repeat(np.arange(len(rows)) * rows.shape[1], [len(m) for m in met])


def _slices(kind: np.ndarray, kinds: int, size: int) -> list[tuple[int, int]]:
    """Where each kind lies in ``_filled``."""
    cuts = np.searchsorted(kind, np.arange(kinds + 1) * size).tolist()
    return list(zip(cuts, cuts[1:]))


def prefix_bits(tokens: list[bytes], prefixes: Prefixes, trained: bool = False):
    """The run's prefixes that end behind a token's first byte, a part at a
    time: (places, their last bits, nodes, slots of the byte contexts); if
    ``trained``, once for each kind whose training texts have them, and where
    the kind's counts begin."""
    stream, starts, ctx = contexts(tokens, 3)
    behind, start = np.flatnonzero(prefixes.depth > 8), starts.take(prefixes.owner)
    for a in range(0, len(behind), CHUNK):
        at = behind[a:a + CHUNK]
        if trained:
            place, kind = _filled(prefixes.own_rows, prefixes.row.take(at))
            at = at.take(place)
        elif at[-1] - at[0] + 1 == len(at):
            at = slice(at[0], at[-1] + 1)
        last = prefixes.depth[at] - 1
        byte = start[at] + (last >> 3)
        ones, node = nodes(stream.take(byte), last & 7)
        slots = [slot(ctx[k].take(byte), node, k) for k in range(3)]
        yield (at, ones, node, slots, kind) if trained else (at, ones, node, slots)


def fit(counts: DataFrame, runs: DataFrame, edges: Broadcast, kinds: int, steps: int = STEPS) -> Model:
    """Tables, weights and refinement from all occurrences of all training
    tokens.  The weights of a gate are a logistic regression, found by Newton
    steps on sums that Spark adds up, each over all occurrences."""
    table = np.zeros((2, int(_OFFSETS[3])), np.float32)
    rows = context_counts(counts).toArrow()      # bounded by the slots of orders 1 to 3
    at = rows["slot"].to_numpy()
    table[0, at], table[1, at] = rows["n0"].to_numpy(), rows["n1"].to_numpy()
    del rows, at
    per = [f"c{k}" for k in range(kinds)]
    ends = counts.filter(F.octet_length("token") == 0).select(*per).first()
    documents = np.array([ends[c] for c in per] if ends else [0] * kinds, float)
    model = Model(table, np.log((documents + 1) / (documents.sum() + kinds)))
    tables = runs.sparkSession.sparkContext.broadcast(table)
    longs = stored(counts.filter((F.col("c") > 0) & (F.octet_length("token") > LONG)).select("token", "c"), "long-tokens")
    trained_on = [runs] if longs.isEmpty() else [runs, longs]

    def over_all(run, size: int) -> np.ndarray:
        return sum(_summed(rows, run, size) for rows in trained_on)

    def cases(batches, by_input):
        trained = Model.__new__(Model)
        trained.n0, trained.n1 = tables.value
        trained.leave_out()
        trained.by_input = by_input.astype(np.float32)
        for batch in batches:
            if "c" in batch.schema.names:
                found = (trained.long_cases(t, c) for t, c in zip(batch["token"].to_pylist(), batch["c"].to_pylist()))
            else:
                found = (trained.run_cases(tokens, Prefixes(tokens, by_kind, *edges.value[tokens[0]]))
                         for tokens, by_kind, _ in _runs(batch, kinds))
            for weight, st, gate, ones, node in chain.from_iterable(found):
                yield weight, st, gate, ones, node, trained.mixed(st, gate)

    inputs = ORDERS + 1
    for _ in range(steps):
        def slopes(batches, by_input=model.by_input):
            """Each gate's gradient and Hessian."""
            sums = np.zeros((_GATES, inputs, 1 + inputs))
            for weight, st, gate, ones, _, x in cases(batches, by_input):
                order = np.argsort(gate.astype(np.uint8), kind="stable")
                gate, weight, p = gate[order], weight[order], _squash(x[order])
                z, sloped = np.ones((inputs, len(gate))), np.empty((1 + inputs, len(gate)))
                z[:ORDERS] = st[:, order]
                np.multiply(weight, ones[order] - p, out=sloped[0])
                np.multiply(z, weight * p * (1 - p), out=sloped[1:])
                first = np.flatnonzero(np.diff(gate, prepend=-1)).tolist()
                for a, b, g in zip(first, [*first[1:], len(gate)], gate[first].tolist()):
                    sums[g] += z[:, a:b] @ sloped[:, a:b].T
            return sums.ravel()

        sums = over_all(slopes, _GATES * inputs * (1 + inputs)).reshape(_GATES, inputs, 1 + inputs)
        move = np.linalg.solve(sums[:, :, 1:] + np.eye(inputs), sums[:, :, :1])[:, :, 0]
        # a step of a gate changes no weight by more than one half
        model.weights += move / np.maximum(1, 2 * np.abs(move).max(axis=1, keepdims=True))
        model.by_input = np.ascontiguousarray(model.weights.T)

    def refined(batches, by_input=model.by_input):
        total = np.zeros((2, 256, _BUCKETS + 1))
        for weight, _, _, ones, node, x in cases(batches, by_input):
            total += Model.turned_out(x, ones, node, weight)
        return total.ravel()

    model.refined += over_all(refined, model.refined.size).reshape(model.refined.shape)
    model.freeze()
    tables.unpersist()
    return model


# -------------------------------------------------------------------- operator

def lm_scores(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (smoothed unigrams, log10), score (the model's log10
    probability), bits_per_byte."""
    spark = docs.sparkSession
    found = topics(docs)
    kinds = len(found[0])
    both = stored(token_counts(docs, found), "token-counts")
    pair = F.substring("token", 1, 1) == F.lit(b" ")
    counts = both.filter(~pair)
    # bounded: as many rows as the table has cells
    across = edge_bits(edge_counts(both.filter(pair).select("token", *[f"c{k}" for k in range(kinds)]).toArrow(), kinds)).reshape(kinds, -1)
    sums = counts.agg(F.sum("c"), F.sum(F.when(F.col("c") > 0, 1)), F.sum("c_all")).first()
    total, distinct, overall = (int(x or 0) for x in sums)
    runs = stored(token_runs(counts, kinds), "token-runs")
    edges = spark.sparkContext.broadcast(run_edges(runs, kinds))
    model = fit(counts, runs, edges, kinds)
    model.n0 = model.n1 = None      # scoring reads the frozen tables only
    shared = spark.sparkContext.broadcast(model)
    log_n = float(np.log10(total + 0.5 * (distinct + 1)))
    own = [f"own{k}" for k in range(kinds)]

    def cost(batches):
        for batch in batches:
            for tokens, by_kind, c_all in _runs(batch, kinds):
                c = by_kind.sum(axis=1)
                bits = shared.value.run_bits(tokens, Prefixes(tokens, by_kind, *edges.value[tokens[0]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens, pa.binary()), pa.array(c.astype(np.int64)), pa.array(c_all), pa.array(np.log10(c + 0.5) - log_n),
                     *map(pa.array, bits)], ["token", "c", "c_all", "base", *own])

    def long_cost(batches):
        for batch in batches:
            tokens, c = batch["token"].to_pylist(), batch["c"].to_numpy()
            bits = [shared.value.long_token_bits(t) for t in tokens]
            yield pa.RecordBatch.from_arrays([batch["token"], batch["c"], batch["c_all"], pa.array(np.log10(c + 0.5) - log_n),
                                              *[pa.array(bits, pa.float64())] * kinds], ["token", "c", "c_all", "base", *own])

    schema = "token binary, c bigint, c_all bigint, base double, " + ", ".join(f"{k} double" for k in own)
    long = counts.filter(F.octet_length("token") > LONG).select("token", "c", "c_all").mapInArrow(long_cost, schema)
    costs = stored(runs.mapInArrow(cost, schema).unionByName(long), "token-costs")
    frequent = F.col("c_all") * HEAVY >= F.lit(overall)
    known = costs.filter(frequent).toArrow()      # HEAVY rows at most
    table = {t: i for i, t in enumerate(t for part in known["token"].chunks for t in listed(part))}
    values = np.stack([known["c"].to_numpy() > 0, known["base"].to_numpy(), *(known[k].to_numpy() for k in own)])
    look_up = spark.sparkContext.broadcast((table, values, across))
    summed = ["n_known", "base", *own]

    def split(batches):
        """A row per document with its frequent tokens summed, and a row per document and other token."""
        index, value, first_bits = look_up.value
        for batch in batches:
            texts = batch["text"].to_pylist()
            for a, b in pieces(texts):
                different, at, bounds = occurrences(texts[a:b])
                words, lengths = listed(different), np.diff(bounds)
                pairs = pairs_of(words, word_numbers(words), at, bounds)
                edge = np.add.reduceat(first_bits[:, pairs], bounds[:-1] + np.arange(b - a), axis=1, dtype=np.float64)
                words.append(b"")
                text = np.concatenate([np.repeat(np.arange(b - a), lengths), np.arange(b - a)])
                at = np.concatenate([at, np.full(b - a, len(words) - 1)])
                known = np.fromiter(map(index.get, words, repeat(-1)), np.int64, len(words))
                here = (known >= 0)[at]
                usual, place = text[here], known[at[here]]
                sums = [np.bincount(usual, v[place], b - a) for v in value]
                each = np.sort(text[~here] * len(words) + at[~here])
                new = np.flatnonzero(np.diff(each, prepend=-1))
                owner, word = np.divmod(each[new], len(words))
                yield _split_rows(batch["row"].to_numpy()[a:b], batch["doc_id"][a:b], lengths + 1, np.array([len(t) for t in texts[a:b]]),
                                  sums[:2] + [s + e for s, e in zip(sums[2:], edge)], owner,
                                  pa.concat_arrays([different, pa.array([b""], pa.binary())]).take(pa.array(word)), np.diff(np.append(new, len(each))), summed)

    keyed = docs.withColumn("_row", F.monotonically_increasing_id())
    parts = text_bytes(keyed, F.col("_row").alias("row")).mapInArrow(
        split, "row bigint, token binary, times int, doc_id bigint, n_tokens bigint, n_bytes bigint, "
        + ", ".join(f"{c} double" for c in summed))
    rest = costs.filter(~frequent).select("token", F.when(F.col("c") > 0, 1.0).otherwise(0.0).alias("_n_known"),
                                          *[F.col(c).alias(f"_{c}") for c in summed[1:]])
    joined = parts.join(rest, "token", "left")
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.max("n_bytes").alias("n_bytes"),
        *[F.sum(F.coalesce(F.col(c), F.col("times") * F.col(f"_{c}"), F.lit(0.0))).alias(c) for c in summed])
    # bits of the document: the kinds' weighted mean of its probabilities
    best = F.least(*own) if kinds > 1 else F.col(own[0])
    mean = sum((F.exp((best - F.col(k)) * F.lit(float(np.log(2.0)))) * F.lit(float(np.exp(w))) for k, w in zip(own, model.shares)),
               F.lit(0.0))
    sums = sums.withColumn("bits", best - F.log2(mean))
    return sums.select(
        "doc_id", F.coalesce(fold_of("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "n_tokens",
        F.col("n_known").cast("bigint").alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("bits") * F.lit(-float(np.log10(2.0)))).alias("score"),
        (F.col("bits") / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))


def _split_rows(rows: np.ndarray, ids: pa.Array, n_tokens: np.ndarray, n_bytes: np.ndarray, sums: list[np.ndarray],
                owner: np.ndarray, names: pa.Array, times: np.ndarray, summed: list[str]) -> pa.RecordBatch:
    """First a row per document (its token, a space and its number, equals no
    real token), then the documents' other tokens (``owner``: their documents)."""
    def then_nulls(col: pa.Array) -> pa.Array:
        return pa.concat_arrays([col, pa.nulls(len(names), col.type)])
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([rows, rows[owner]])), pa.concat_arrays([pa.array([b" %d" % r for r in rows.tolist()], pa.binary()), names]),
         pa.array(np.concatenate([np.zeros(len(rows), np.int32), times]).astype(np.int32)),
         *map(then_nulls, [ids, pa.array(n_tokens.astype(np.int64)), pa.array(n_bytes), *map(pa.array, sums)])],
        ["row", "token", "times", "doc_id", "n_tokens", "n_bytes", *summed])

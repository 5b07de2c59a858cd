"""Jaccard join, Merkle manifest and prefix trie against their plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_operators import AWKWARD, SF, frame, order, whole

from matchlake.llm import common, hashing, jaccard, merkle, trie


def same(df, want):
    return order(tuple(r) for r in df.collect()) == order(want)


# ------------------------------------------------------------------ 11 jaccard

NEAR = [" ".join(random.Random(i).choice("abcdefgh") + str(random.Random(i * 99 + j).randrange(60)) for j in range(80)) for i in range(5)]


def near_rows():
    """Groups of edited copies around the threshold, copies, short, empty and null texts, huge words."""
    rng = random.Random(5)
    huge = "z" * 1_500_000
    rows = [(None, None), (1, ""), (2, " \t "), (3, "one two"), (4, "One  TWO"), (5, "one two three four five"), (None, NEAR[0]), (None, NEAR[0] + " x"),
            (None, "nothing like it here now"), (8, "é ü" * 5), (8, "é ü" * 5), (9, f"{huge} q w"), (10, f"{huge} Q w"), (11, "big words come here " * 70_000),
            (12, " ".join(map(str, range(60_000)))), (13, " ".join(map(str, range(58_000))))]
    for i in range(150):
        w = NEAR[i % 5].split()
        for _ in range(rng.randrange(6)):
            w[rng.randrange(80)] = f"q{rng.randrange(1000)}"
        rows.append((100 + i, " ".join(w[rng.randrange(4):])))
    return rows


@pytest.mark.parametrize("bits,tile", [(jaccard.RARITY_BITS, jaccard.TILE), (6, 8)])
def test_jaccard_awkward(spark, monkeypatch, bits, tile):
    """Whatever the size of the rarity table and of the tiles, the components are the same."""
    monkeypatch.setattr(jaccard, "TILE", tile)
    monkeypatch.setattr(jaccard, "BLOCK", tile)
    rows = near_rows()
    docs = frame(spark, [(i, t, "en", "a") for i, t in rows]).withColumns({c: F.lit(c) for c in ("cid", "n", "s1", "copies", "part", "size")})
    got = jaccard.jaccard_components(docs, bits=bits)
    want = brute.jaccard(rows)
    assert same(got, want)
    assert sum(c is not None and c != i for i, _, c in want) > 50


def test_jaccard_of_awkward_rows_and_empty_table(spark):
    docs = frame(spark)
    assert same(jaccard.jaccard_components(docs), brute.jaccard([r[:2] for r in AWKWARD]))
    assert jaccard.jaccard_components(docs.filter("false")).count() == 0


def test_prefix_filter_loses_no_pair():
    """Sets that link share a shingle in both prefixes, whatever the order (the smaller by its short one)."""
    rng = np.random.default_rng(3)
    for _ in range(300):
        n = int(rng.integers(1, 60))
        a = rng.choice(500, n, replace=False)
        b = np.unique(np.concatenate([a[rng.random(n) < 0.9], rng.integers(500, 900, rng.integers(0, 6))]))
        if not len(b):
            continue
        common = len(np.intersect1d(a, b))
        if 100 * common < 80 * (len(a) + len(b) - common):
            continue
        rank = rng.permutation(900)
        x, y = sorted((sorted(a, key=rank.__getitem__), sorted(b, key=rank.__getitem__)), key=len)
        short = len(x) - -(-len(x) * 160 // 180) + 1
        assert set(x[:short]) & set(y[:jaccard.prefix_size(len(y), 80)])


def test_word_hashes_do_not_depend_on_the_cut(monkeypatch):
    texts = [b"alpha beta\tgamma", b"", b" x ", b"y" * 9000 + b" tail\x0bend", b"a bb ccc " * 500]
    before = [h.tolist() for h in hashing.word_hashes(texts)]
    monkeypatch.setattr(hashing, "_PIECE", 64)
    assert [h.tolist() for h in hashing.word_hashes(texts)] == before
    assert [len(b) for b in before] == [len(t.split()) for t in texts]


# ------------------------------------------------------------------- 12 merkle

def rows_of(df, *cols):
    return [r.asDict() for r in df.select(*cols).collect()]


_DOC = ("doc_id", "source", "lang", "n_chars", "text")


@pytest.mark.parametrize("make", [frame, whole], ids=["awkward", "table"])
@pytest.mark.parametrize("block", [16, merkle.BLOCK])
def test_merkle(spark, make, block):
    docs = make(spark)
    got = merkle.manifest(docs, block=block)
    want = brute.merkle(rows_of(docs, *_DOC))
    assert same(got, want)
    assert {w[-1] for w in want} == {True, False}
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_merkle_deep_source_nulls_and_lone_leaves(spark):
    """One source of several levels, a null source, null ids and fields, repeated rows; one row; no row."""
    docs = spark.range(700).select(
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 9 > 0, F.lit("big")).alias("source"),
        F.when(F.col("id") % 2 > 0, F.lit("en")).alias("lang"), (F.col("id") % 3).alias("n_chars"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("Text É "), F.col("id") % 50)).alias("text"))
    docs = docs.unionByName(docs.limit(9)).unionByName(docs.filter("doc_id = 8").withColumn("source", F.lit("")))
    docs = docs.withColumns({c: F.lit(c) for c in ("g", "leaf", "up", "slot", "block", "id", "mark")})
    assert same(merkle.manifest(docs, block=8), brute.merkle(rows_of(docs, *_DOC)))
    one = docs.filter("doc_id = 8 and source = ''")
    got = merkle.manifest(one).first()
    assert got["leaf"] == got["subroot"] == got["root"] and got["proof_sha256"] == brute.sha("")
    assert merkle.manifest(docs.filter("false")).count() == 0


def test_recursion_limit_is_put_back(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    merkle.manifest(whole(spark).limit(20))
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") == before


# --------------------------------------------------------------------- 13 trie

def conversations(spark):
    """Null turns, roles, texts and ids, ties, repeats, borrowed and missing bases, negative ids, long copies."""
    rng = random.Random(3)
    rows = []
    for c in [*range(-3, 12), 100, 101, 150, 200, 299, 305, None]:
        for i in range(rng.choice([1, 2, 3, 7, 8])):
            rows.append((c, rng.choice([None, i, i, 1]), rng.choice(["user", None, ""]), rng.choice(["a", "bb", None, "é€", "x" * 9000])))
    for c in (1000, 1001, 1002):
        rows += [(c, i, "user", f"x{i}") for i in range(1100 if c < 1002 else 1090)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    return df.withColumns({c: F.lit(c) for c in ("depth", "g", "digest", "size", "h", "ends", "k1")}).repartition(3)


@pytest.mark.parametrize("bands", [1, trie.BANDS, 40])
def test_trie_in_any_number_of_bands(spark, monkeypatch, bands):
    monkeypatch.setattr(trie, "MANY", 3)
    monkeypatch.setattr(trie, "CHUNK", 2)
    monkeypatch.setattr(common, "BLOCK", 64)
    table = conversations(spark) if bands < 40 else spark.read.parquet(f"{SF}/conversations.parquet")
    got = trie.prefix_trie(table, bands)
    assert same(got, brute.trie(rows_of(table, "conv_id", "turn", "role", "text")))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def test_trie_of_no_conversations_and_turnless_ones(spark):
    empty = conversations(spark).filter("false")
    assert trie.prefix_trie(empty).count() == 0
    # conversation 7 has fewer turns than it borrows, and its base is missing: it ends at the root
    short = next(c for c in range(1, 100) if brute.zlib.crc32(str(c).encode()) % 6 > 1)
    df = spark.createDataFrame([(short, 0, "user", "only")], "conv_id bigint, turn bigint, role string, text string")
    assert [tuple(r) for r in trie.prefix_trie(df).collect()] == [(short, 0, None, 1, 0, 1, 0, brute.sha(str(short)))]


def test_bands_cover_every_depth_once(spark):
    convs = spark.createDataFrame([(i, e) for i, e in enumerate([0, 0, 3, 3, 3, 9, 400, 5000])], "conv_id bigint, ends bigint")
    for number in (1, 4, 100):
        cuts = trie.bands(convs, number)
        assert cuts[0][1] == 5001 and cuts[-1][0] == 0
        assert all(hi == lo for (lo, _), (_, hi) in zip(cuts, cuts[1:]))
        assert len(cuts) <= 2 * number + 1

"""SentencePiece, centroid clustering and fill-in-the-middle against the library and plain Python."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from conftest import DATA
from quarry.llm import centroids, fim, pieces, queries
from quarry.llm.tables import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def vocab():
    return pieces.vocabulary(MODEL)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def strange_texts(rnd, n=800):
    letters = "abcdeeettaaa   ▁▁=-<>0123\n\té日😀"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(200))) for _ in range(n)]
    texts += [c * k for c in " =a-▁" for k in range(40)] + ["\x00", "<s>", "</s> x", "<0x41>", "﻿ a", "é"]
    return texts + ["".join(chr(c) for c in (rnd.randrange(0x10FFFF) for _ in range(30)) if not 0xD800 <= c < 0xE000) for _ in range(200)]


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_merge_rounds_equal_the_library(vocab, library):
    texts = strange_texts(random.Random(5))
    assert [ids_of(x) for x in pieces.encode(vocab, texts, {})] == library.encode(texts)
    cache = {}
    assert [ids_of(pieces.encode(vocab, [t], cache)[0]) for t in texts[:200]] == library.encode(texts[:200])  # one by one, words kept


@pytest.mark.parametrize("text", [" " * 6000, "a" * 9000 + " " * 5000, "".join(random.Random(2).choice("abcdefghijklmnop") for _ in range(30_000)), "日" * 5000 + "word " * 20_000])
def test_long_words_equal_the_library(vocab, library, text):
    assert ids_of(pieces.encode(vocab, [text], {})[0]) == library.encode(text)
    word = pieces.words(vocab, text)[0]
    assert pieces.merged_long(vocab, word) == pieces.merged_words(vocab, [word])[0] or len(word) > 8000


def test_words_are_cut_where_no_piece_can_lie(vocab):
    assert pieces.words(vocab, "") == []
    assert pieces.words(vocab, "two words") == ["▁two", "▁words"]
    assert "".join(pieces.words(vocab, "日本 x\x00y  z")) == "▁日本▁x\x00y▁▁z"


def test_decoder_equals_the_library(vocab, library):
    rnd = random.Random(3)
    lists = [[rnd.choice([rnd.randrange(300), rnd.randrange(32_000)]) for _ in range(rnd.randrange(12))] for _ in range(4000)]
    assert [pieces.decode(vocab, x) for x in lists] == [library.decode(x) for x in lists]


def test_encoding_keeps_rows_and_columns(spark, library):
    long = "x y" * 200_000
    rows = [(1, None, "k", [7]), (2, "", "k", [7]), (2, "", "k", [7]), (None, "a b", "k", [7]), (3, long, "k", [7])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    got = pieces.encoded(docs, MODEL)
    assert got.columns == ["doc_id", "text", "decoded", "ids"]
    want = [[1, *library.encode(t or ""), 2] for _, t, *_ in rows]
    assert [r.ids for r in got.collect()] == want
    back = pieces.decoded(got, MODEL).collect()
    assert [(r.text or "", r.ids) for r in back] == [(r.decoded, w) for r, w in zip(back, want)]
    nulls = spark.createDataFrame([(None,), ([1, 2],)], "ids array<int>")
    assert [r.decoded for r in pieces.decoded(nulls, MODEL).collect()] == [None, ""]
    assert pieces.encoded(docs.limit(0), MODEL).count() == 0


def test_query_of_pieces_equals_the_library(spark, library):
    docs = {r.doc_id: r.text or "" for r in table(spark, DATA, "documents").collect()}
    got = queries.op11_sentencepiece(spark, DATA).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# ---- centroids ------------------------------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [int(np.floor(64 * np.float64(x))) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)]
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    at = [v for _, v in sorted((r for r in kept if r[0] is not None), key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), j) for j, c in enumerate(at))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in kept]
        for j in range(len(at)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            at[j] = [sum(x) // len(mine) for x in zip(*mine)] if mine else at[j]
    found = [(i, *near(v)) for i, v in kept]
    inertia = sum(d for _, d, _ in found)
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted((str(i), j, d, sum(e for _, e, c in found if c == j), inertia, sha(at[j])) for i, d, j in found)


@pytest.mark.parametrize("k,n", [(16, 300), (5, 60), (1, 9), (7, 3), (16, 1)])
def test_clusters(spark, k, n):
    rnd = np.random.default_rng(k + n)
    middles = rnd.normal(size=(4, 8))
    rows = [(i, (middles[i % 4] + rnd.normal(size=8) * 0.2).astype(np.float32).tolist()) for i in range(n)]
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * 7), (n + 3, [1.0] * 7 + [None]), (n + 4, [float("nan")] * 8), (n + 5, [float("inf")] * 8), (0, rows[0][1]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, e, 1, 2) for i, e in rows], "vec_id long, embedding array<float>, cluster int, v int")
    got = centroids.clustered(df, k=k, dims=8, pairs=3).collect()
    assert sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in got) == brute_clusters(rows, k, 3, 8)


def test_equal_vectors_and_no_vectors(spark):
    df = spark.createDataFrame([(i, [0.5] * 8) for i in range(40)], "vec_id long, embedding array<double>")
    got = centroids.clustered(df, dims=8).collect()
    assert len(got) == 40 and {(r.cluster, r.distance, r.inertia) for r in got} == {(0, 0, 0)}  # ties go to the smaller number
    assert centroids.clustered(df.filter("vec_id < 0"), dims=8).collect() == []
    with pytest.raises(Exception, match="component beyond"):
        centroids.clustered(spark.createDataFrame([(1, [1e300] * 8)], df.schema), dims=8).collect()


def test_bounds_never_exceed_distances_and_spare_work():
    rnd = np.random.default_rng(1)
    middles = rnd.integers(-4000, 4000, size=(16, 64))
    v = np.concatenate([m + rnd.integers(-60, 60, size=(100, 64)) for m in middles])
    pivots = v[rnd.permutation(len(v))[:16]]
    apart = ((pivots[::2] - pivots[1::2]) ** 2).sum(axis=1)
    near, exact = centroids.squared(v, pivots), centroids.squared(v, middles)
    low = centroids.lower_bounds(near, centroids.squared(middles, pivots), apart)
    assert (low**2 <= exact).all()
    cluster, distance, measured = centroids.nearest(v, near, middles, pivots, apart)
    assert (cluster == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert measured < exact.size / 4


# ---- fill in the middle ---------------------------------------------------------------------------------------


def brute_fim(i, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", p, m, s, text
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


def test_fill_in_middle(spark):
    rnd = random.Random(4)
    shared = "".join(rnd.choice("abc dé日😀\n.") for _ in range(9000))
    texts = [None, "", "a", "<", "<P", "x<P>y", "é" * 5000, "z" * 20_000, "a<S" * 40, shared, shared[3:], shared + "b" + shared, "b" + shared * 40]
    texts += ["".join(rnd.choice("abc dé日😀<PSM>\n.") for _ in range(rnd.randrange(3000))) for _ in range(60)]
    rows = [(i, t, "k", 3) for i, t in enumerate(texts)] + [(3, "<", "k", 3), (None, "no key", "k", 3)]
    made = fim.transformed(spark.createDataFrame(rows, "doc_id long, text string, form string, n int"))
    got = made.withColumn("back", fim.restored(F.col("form"), F.col("output"))).collect()
    assert len(got) == len(rows) and {r.form for r in got} == {"plain", "psm", "spm"}
    for r, (i, text, *_) in zip(got, rows):
        assert (r.n, r.form, r.prefix, r.middle, r.suffix, r.output) == brute_fim(i, text)
        assert r.doc_id == i and r.back == (text or "")
    assert fim.transformed(made.select("doc_id", F.col("output").alias("text")).limit(0)).count() == 0


def test_chunks_are_cut_by_content_and_shared():
    rnd = random.Random(6)
    body = "".join(rnd.choice("abcdefgh  ijk.é") for _ in range(60_000)).encode()
    chunks = fim.Chunks()
    fim.Document(body, chunks)
    met = chunks.met
    for lead in (b"other text ", b"x", "é".encode() * 700):
        d = fim.Document(lead + body, chunks)
        assert b"".join(d.text[a:b] for a, b in zip(d.starts, d.ends)) == lead + body
        assert d.n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", (lead + body).decode()))
    assert chunks.reused > 2.5 * met  # all but the first chunks of the three are known
    sizes = [b - a for a, b in zip(d.starts, d.ends)]
    assert max(sizes) <= fim.LONGEST and met > len(body) / fim.LONGEST
    small = fim.Chunks(limit=1000)
    assert fim.Document(body, small).n == fim.Document(body, chunks).n and small.size <= 1000 + fim.LONGEST + 200

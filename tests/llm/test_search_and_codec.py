"""Whitening, ranked lexical search and byte-level BPE against brute-force versions
and the tiktoken library, with their defined results for odd rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from opslake.llm import bpe_prefix, catalog, lexical_scan, whitening
from tests.conftest import SF_SMALL

# --- 11 ------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, component int, n long, x string, i int, v double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, None, 5, 6, "x", 7, 8.0) for i, e in rows], VECTORS)


def _reference(rows, dims):
    """Exact deviations and, by a symmetric eigenvalue solver, the spectrum."""
    kept = [(i, tuple(math.floor(64 * float(np.float32(c))) + 10**6 for c in e) + (10**6,) * (dims - len(e)))
            for i, e in rows if e is not None and all(c is not None and math.isfinite(c) for c in e)]
    distinct = sorted({x for _, x in kept})
    n, sums = len(distinct), [sum(c) for c in zip(*distinct)]
    centred = np.array([[n * a - s for a, s in zip(x, sums)] for x in distinct], float) / n
    values, vectors_ = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], vectors_[:, ::-1].T


def _check_whitening(spark, rows, dims, k=16):
    kept, n, sums, values, basis = _reference(rows, dims)
    got = whitening.whiten(vectors(spark, rows), k).collect()
    m = min(k, int((values > 1e-13 * values[0]).sum()))
    assert Counter((r.vec_id, r.component) for r in got) == Counter((i, c) for i, _ in kept for c in range(1, m + 1))
    deviation = {(i, sum((n * a - s) ** 2 for a, s in zip(x, sums))) for i, x in kept}
    assert {(r.vec_id, r.deviation) for r in got} == deviation and {r.n for r in got} == {n}
    for r in got:
        assert math.isclose(r.explained, values[r.component - 1] / values.sum(), rel_tol=1e-9)
        assert r.identity_error < 1e-8
    # each row's projection, up to one sign for each component
    x_of = {}
    for i, x in kept:
        x_of.setdefault(i, []).append((np.array(x, float) - np.array([s / n for s in sums])))
    for c in range(1, m + 1):
        near = [abs(values[c - 1] - v) < 1e-6 * values[0] for j, v in enumerate(values) if j != c - 1]
        if any(near):
            continue  # a repeated value: any direction of its space may stand for it
        want = {i: sorted(float(x @ basis[c - 1]) / math.sqrt(values[c - 1]) for x in xs) for i, xs in x_of.items()}
        have = {}
        for r in got:
            if r.component == c:
                have.setdefault(r.vec_id, []).append(r.whitened)
        sign = 1 if abs(sum(want[i][0] * have[i][0] for i in want if len(want[i]) == 1)) == sum(
            want[i][0] * have[i][0] for i in want if len(want[i]) == 1) else -1
        for i in want:
            assert np.allclose(sorted(sign * v for v in have[i]), want[i], atol=1e-8)
    return got


def test_whitening(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.standard_normal(12) * 0.8 ** np.arange(12)).astype(np.float32).tolist()) for i in range(150)]
    rows += [(i, rows[0][1]) for i in range(150, 260)]                       # a mass of equal vectors counts once
    rows += [(7, rows[9][1]), (None, rows[10][1]), (400, rows[11][1][:5]), (401, [])]
    rows += [(500, None), (501, [1.0, None] + [0.0] * 10), (502, [float("nan")] * 12), (503, [float("inf")] * 12)]
    got = _check_whitening(spark, rows, 12)
    assert not {500, 501, 502, 503} & {r.vec_id for r in got} and {7, None, 400, 401} <= {r.vec_id for r in got}
    # few rows span few directions; equal rows, one row and none span none
    _check_whitening(spark, [(i, e) for i, e in rows[:5]], 12)
    for some in ([(1, [0.5, 0.25]), (2, [0.5, 0.25])], [(1, [0.5])], [(1, []), (2, [])], []):
        out = whitening.whiten(vectors(spark, some))
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_whitening_of_large_entries(spark):
    rows = [(1, [1e8, 1.0]), (2, [-1e8, 0.5]), (3, [3e30, 0.0]), (4, [0.0, 0.0])]
    kept = {i: [max(-(1 << 40), min(1 << 40, math.floor(64 * float(np.float32(c))))) + 10**6 for c in e] for i, e in rows}
    sums = [sum(c) for c in zip(*kept.values())]
    want = {i: sum((4 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in kept.items()}
    got = {r.vec_id: r.deviation for r in whitening.whiten(vectors(spark, rows)).collect()}
    assert got == {i: v if v < 1 << 63 else None for i, v in want.items()} and None in got.values()


@pytest.mark.parametrize("spectrum", ["flat", "falling", "repeated", "gap", "thin"])
def test_bidiagonalisation_finds_the_largest_values(spectrum):
    rng = np.random.default_rng(2)
    dims = 96
    d = {"flat": np.ones(dims), "falling": 0.7 ** np.arange(dims), "repeated": np.repeat([9.0, 5.0, 1e-3], [3, 20, dims - 23]),
         "gap": np.repeat([10.0, 1e-6], [16, dims - 16]), "thin": np.repeat([1.0, 0.0], [9, dims - 9])}[spectrum]
    x = np.linalg.qr(rng.standard_normal((400, dims)))[0] * d @ np.linalg.qr(rng.standard_normal((dims, dims)))[0]
    steps = []

    def product(h):
        steps.append(1)
        u = x @ h
        return x.T @ u, float(u @ u)

    values, vectors_ = whitening.principal(product, dims, float(np.linalg.norm(x)), 16)
    live = int((d[:16] > 0).sum())
    assert np.allclose(values[:live], np.sort(d)[::-1][:live], rtol=1e-9, atol=1e-12) and (values[live:] < 1e-6).all()
    v = vectors_[:live]
    assert np.abs(v @ v.T - np.eye(live)).max() < 1e-12
    assert np.abs(x.T @ (x @ v.T) - v.T * values[:live] ** 2).max() < 1e-11 * values[0] ** 2
    if spectrum == "falling":
        assert len(steps) < dims  # settled early


# --- 12 ------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def _ranked(rows, items, k):
    found = [(i, Counter(_terms(t))) for i, t in rows]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    count, length = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(_terms(t))
    out = []
    for item, terms in wanted.items():
        scored = []
        for doc, c, n in found:
            m = 50 + (50 * n * count) // length
            s = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in terms if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc))
        out += [(item, r + 1, d, -s) for r, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


def _texts(rng, n, words):
    seps = [" ", "  ", "\n", ", ", "-", "_", "'", "\x00", "\x7f"]
    return ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randint(0, 60))) for _ in range(n)]


@pytest.mark.parametrize("small_lots", [False, True])
def test_lexical_search(spark, monkeypatch, small_lots):
    if small_lots:
        monkeypatch.setattr(lexical_scan, "LOT_TERMS", 12)
    rng = random.Random(7)
    words = ["a", "A", "ab", "b", "aB", "é", "É", "漢字", "x1", "1", "1x", "ß", " ", "zz", "ZZ"] + [f"w{i}" for i in range(40)]
    rows = list(enumerate(_texts(rng, 60, words)))
    rows += [(100, None), (101, ""), (102, " -- "), (103, "a " * 60_000 + "w1"), (104, "w1 w2"), (104, "w1 w2"), (105, "w1 w2"),
             (None, "w1 w2"), (None, "w3"), (106, "w1w2 w12"), (107, "A")]
    items = list(enumerate(_texts(rng, 8, words))) + [(50, None), (51, ""), (52, "--"), (53, "w1 W1, w1"), (None, "w1"),
                                                      (54, "nowhere"), (55, "w1"), (55, "w2"), (56, "a")]
    docs = spark.createDataFrame([(i, t, 1, 2, "t", 3) for i, t in rows],
                                 "doc_id long, text string, rank int, score long, term string, item_id long")
    bench = spark.createDataFrame([(i, t, 1, "z") for i, t in items], "item_id long, text string, lot int, term string")
    for k in (5, 50):
        got = lexical_scan.lexical_search(docs.repartition(3), bench, k)
        assert got.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, got.collect())) == _ranked(rows, items, k)
    for d, b in ((docs.limit(0), bench), (docs, bench.limit(0)), (docs, bench.where("item_id in (50, 51)"))):
        assert lexical_scan.lexical_search(d, b).count() == 0


def test_only_whole_terms_are_counted():
    found = lexical_scan.automaton(["a", "ab", "é", "b"])
    texts = pa.array(["a ab abc a", None, "", "b", "é éa, é", "A-B_ab"])
    n, text, term, tf = lexical_scan.count_terms(found, texts)
    assert n.tolist() == [4, 0, 0, 1, 3, 3]
    assert list(zip(text.tolist(), term.tolist(), tf.tolist())) == [
        (0, 0, 2), (0, 1, 1), (3, 3, 1), (4, 2, 2), (5, 0, 1), (5, 1, 1), (5, 3, 1)]


# --- 13 ------------------------------------------------------------------------

ALPHABETS = ["ab", "abcde ", "aeiouths ", "\n \t　", "абвгд", "日本語漢字", "'sltre ", "0123456789", "éüñ a", "😀‍́", "<|endoftext|>"]


def _text(rng, most):
    return "".join(rng.choice(rng.choice(ALPHABETS)) for _ in range(rng.randint(0, most)))


@pytest.fixture(scope="module")
def words():
    return bpe_prefix.vocabulary(bpe_prefix.default_ranks(), bpe_prefix.default_pattern())


@pytest.fixture(scope="module")
def library(words):
    return tiktoken.Encoding("plain", pat_str=bpe_prefix.default_pattern(), mergeable_ranks=words.ranks, special_tokens={})


def test_ids_equal_the_library(words, library):
    rng = random.Random(3)
    for _ in range(3000):
        t = _text(rng, 60)
        ids = np.frombuffer(words.encode(t), "<u4").tolist()
        assert ids == library.encode_ordinary(t) and words.decode(words.encode(t)) == t.encode()
        data = bytes(rng.randrange(256) for _ in range(rng.randint(1, 14)))  # bytes of any kind in one piece
        assert words.ids(words.extend(data, []), data) == library._core_bpe.encode_single_piece(data)


def test_the_pattern_splits_like_the_library(words, library):
    """Every character, in contexts in which its class matters."""
    for c in map(chr, [*range(0xD800), *range(0xE000, 0x110000)]):
        t = f"a{c}b {c}{c} 1{c}1.{c}.  {c}"
        want = library.encode_ordinary(t)
        if [i for p in words.split(t) for i in library._core_bpe.encode_single_piece(p.encode())] != want:
            raise AssertionError(hex(ord(c)))


def test_each_prefix_holds_the_last_token_of_its_own_encoding(words, library):
    rng = random.Random(5)
    for _ in range(200):
        data = _text(rng, 25).encode()
        last = words.extend(data, [])
        for end in range(1, len(data) + 1):
            own = library._core_bpe.encode_single_piece(data[:end])
            if own != [words.ranks.get(data[:end])] or data[:end] in words.made:
                assert own[-1] == last[end - 1]


def test_two_tokens_fit_when_merging_leaves_them(words):
    rng = random.Random(6)
    ranks = sorted(words.made.values())
    for _ in range(4000):
        a, b = rng.choice(ranks), rng.choice(ranks[:2000])
        assert words.fits(a, b) == (words.merged(words.bytes_of[a] + words.bytes_of[b])[-1] == [a, b])


def test_tokens_that_merging_does_not_make(tmp_path):
    """'abc' is in the vocabulary, but 'b' and 'c' merge first, and there is no 'a' + 'bc' before it."""
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"cd", b"ab", b"abcd", b"xab", b"aa", b"aaa"]
    path = tmp_path / "own.tiktoken"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    own = bpe_prefix.Vocabulary(str(path), bpe_prefix.default_pattern())
    library = tiktoken.Encoding("own", pat_str=bpe_prefix.default_pattern(), mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(1)
    for _ in range(4000):
        t = "".join(rng.choice("abcdx ") for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(own.encode(t), "<u4").tolist() == library.encode_ordinary(t), t


def test_edits_encode_only_their_neighbourhood(words, library):
    rng = random.Random(8)
    for _ in range(600):
        e = bpe_prefix.Encoded(words, _text(rng, 250))
        for _ in range(3):
            a = rng.randint(0, len(e.text))
            b = min(len(e.text), a + rng.choice([0, 0, 1, 3, 20]))
            e.replace(a, b, _text(rng, rng.choice([0, 1, 10])))
            assert e.ids() == library.encode_ordinary(e.text) and e.pieces == words.split(e.text)
            assert e.prefixes().tolist() == bpe_prefix.Encoded(words, e.text).prefixes().tolist()
        e.append(_text(rng, 9))
        assert e.ids() == library.encode_ordinary(e.text)
    for text in ("word and " * 20_000, "abcdefgh" * 20_000):  # many pieces, and one long piece
        e = bpe_prefix.Encoded(words, text)
        e.computed = 0
        e.replace(80_000, 80_003, "zq")
        e.append("tail")
        assert e.computed < 500 and e.ids() == library.encode_ordinary(e.text)


def test_byte_bpe_documents(spark, words, library):
    rng = random.Random(9)
    rows = [(i, _text(rng, 200)) for i in range(80)]
    rows += [(200, None), (201, ""), (202, " "), (203, "x" * 100_000), (204, "same"), (204, "same"), (None, "no id"), (205, "<|endoftext|>")]
    docs = spark.createDataFrame([(i, t, "a", b"b", 1, b"c") for i, t in rows],
                                 "doc_id long, text string, ids string, data binary, n_tokens long, last_tokens binary")
    coded = bpe_prefix.decode_documents(bpe_prefix.encode_documents(docs.repartition(3)))
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.data)) for r in coded.collect())
    assert got == Counter((i, np.asarray(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows)
    assert bpe_prefix.encode_documents(docs.limit(0)).count() == 0
    # appends and edits of stored documents
    unique = docs.where("doc_id is not null and doc_id <> 204")
    kept = unique.select("doc_id", "text").join(bpe_prefix.encode_documents(unique, prefixes=True).drop("ids"), "doc_id")
    edits = spark.createDataFrame([(3, 5, 9, "neu"), (4, 10**6, 10**6, " more"), (5, 0, 10**9, None), (200, 0, 0, "now some"),
                                   (203, 50_000, 50_001, " "), (999, 0, 0, "x")],
                                  "doc_id long, start long, stop long, replacement string")
    texts = dict(rows)
    texts.update({3: texts[3][:5] + "neu" + texts[3][9:], 4: texts[4] + " more", 5: "", 200: "now some",
                  203: "x" * 50_000 + " " + "x" * 49_999})
    out = bpe_prefix.edit_documents(kept, edits).collect()
    assert {r.doc_id for r in out} == {i for i, _ in rows if i not in (None, 204)}
    for r in out:
        assert r.text == (texts[r.doc_id] or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode_ordinary(r.text)
        assert bytes(r.last_tokens) == bpe_prefix.Encoded(words, r.text).prefixes().tobytes()


def test_byte_bpe_query(spark, library):
    import hashlib
    texts = dict(duckdb.sql(f"select doc_id, text from '{SF_SMALL}/documents.parquet'").fetchall())
    got = catalog.QUERIES["op13_byte_bpe"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_whitening_query(spark):
    rows = duckdb.sql(f"select vec_id, embedding from '{SF_SMALL}/embeddings.parquet'").fetchall()
    kept, n, sums, values, _ = _reference(rows, 64)
    got = catalog.QUERIES["op11_embedding_whitening"](spark, SF_SMALL)
    assert got.count() == 16 * len(kept) and got.select("n").distinct().collect() == [(n,)]
    total = sum(sum((n * a - s) ** 2 for a, s in zip(x, sums)) for _, x in kept)
    assert got.where("component = 3").agg(F.sum(F.col("deviation").cast("decimal(38,0)"))).first()[0] == total
    shares = {r[0]: r[1] for r in got.select("component", "explained").distinct().collect()}
    assert all(math.isclose(shares[c], values[c - 1] / values.sum(), rel_tol=1e-9) for c in range(1, 17))

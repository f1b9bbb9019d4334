"""Whitening, periodic runs and token counts against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktape.llm import periodic, queries, token_counts, whitening
from sparktape.llm.hashing import U, mix64

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], DOCS)


# -- 11 ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("spectrum", ["flat", "falling", "ties", "low_rank", "zero"])
@pytest.mark.parametrize("d", [1, 3, 8, 40, 150])
def test_eigenvectors_to_double_precision(d, spectrum):
    rng = np.random.default_rng(d)
    turn = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {
        "flat": 1 + rng.random(d) / 10,
        "falling": 100.0 / np.arange(1, d + 1) ** 2,
        "ties": np.repeat([7.0, 7.0, 3.0], d)[::3],
        "low_rank": np.where(np.arange(d) < 2, 5.0 - np.arange(d), 0.0),
        "zero": np.zeros(d),
    }[spectrum]
    matrix = (turn * values) @ turn.T
    got, vectors = whitening.jacobi_davidson(lambda b: matrix @ b, d, 4)
    top = max(values.max(), 1e-300)
    assert np.allclose(got, np.sort(values)[::-1][:4], rtol=0, atol=1e-13 * top)
    assert np.abs(matrix @ vectors - vectors * got).max() <= 1e-12 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(got))).max() < 1e-12
    assert (vectors[np.abs(vectors).argmax(axis=0), np.arange(len(got))] > 0).all()


def plain_whitening(rows):
    """Rows of the query, from a covariance that is written out."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    whole = [[math.floor(256 * float(c)) for c in v] for _, v in kept]
    fit = np.array(sorted(set(map(tuple, whole))))
    n, sums = len(fit), fit.sum(axis=0).tolist()
    centred = fit - fit.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = {}
    for (i, _), x in zip(kept, whole, strict=True):
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(min(4, len(values))):
            white = float((x - fit.mean(axis=0)) @ vectors[:, k] / math.sqrt(values[k]))
            found.setdefault((i, k + 1), []).append((n, deviation, abs(white), values[k] / np.trace(covariance)))
    return found


def check_whitening(got, want):
    assert len(got) == sum(map(len, want.values()))
    for row in got:
        n, deviation, white, share = want[row.vec_id, row.component][0]
        assert (row.n, row.deviation) == (n, deviation)
        assert abs(row.whitened) == pytest.approx(white, abs=1e-9)
        assert row.explained == pytest.approx(share, rel=1e-9)
        assert row.identity_error < 1e-9


def test_whitening_of_given_vectors(spark, sf_dir):
    rows = [tuple(r) for r in queries.read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding").collect()]
    check_whitening(queries.op11_whitening(spark, sf_dir).collect(), plain_whitening(rows))


def whitening_query(spark, tmp_path, rows, schema="vec_id long, embedding array<double>"):
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "embeddings.parquet"))
    return queries.op11_whitening(spark, str(tmp_path)).collect()


def test_whitening_of_odd_vectors(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1 + k) for k in range(6)]) for i in range(300)]
    # A vector that a third of all rows hold, once a null id, and refused ones.
    rows += [(1000 + i, rows[0][1]) for i in range(150)] + [(None, rows[1][1])]
    bad = [None, [1.0, None] * 3, [math.nan] * 6, [math.inf] + [0.0] * 5, [0.0] * 5 + [-math.inf]]
    other = [[], [1.0] * 5, [1e300] * 6]
    got = whitening_query(spark, tmp_path, rows + [(2000 + i, v) for i, v in enumerate(bad + other)])
    check_whitening(got, plain_whitening(rows))


def test_whitening_sign_is_one_for_all_rows(spark, tmp_path):
    rows = [(i, [float(i), -2.0 * i]) for i in range(50)]
    got = whitening_query(spark, tmp_path, rows, "vec_id long, embedding array<float>")
    first = sorted((r.vec_id, r.whitened) for r in got if r.component == 1)
    steps = np.diff([w for _, w in first])
    assert (steps > 0).all() or (steps < 0).all()
    # No variance is left for the second component.
    assert {r.whitened for r in got if r.component == 2} == {None}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])], [(1, [0.5, 0.25]), (2, [0.5, 0.25])]])
def test_whitening_without_variance(spark, tmp_path, rows):
    got = whitening_query(spark, tmp_path, rows)
    one = len(rows) == 2
    assert len(got) == (4 if one else 0)
    assert all(r.whitened is None and r.explained is None and r.deviation == 0 and r.n == 1 for r in got)


def test_whitening_of_large_numbers(spark):
    rows = spark.createDataFrame([(i, [float(1 << 44) + i, float(i % 3)]) for i in range(9)], "vec_id long, embedding array<double>")
    learnt = whitening.fit(rows.withColumn("deviation", F.lit("x")))
    assert learnt.sums[0] == sum(256 * ((1 << 44) + i) for i in range(9))
    # n x and S are far from zero, their difference is not.
    found = whitening.with_whitened(rows.withColumn("deviation", F.lit("x")), learnt).collect()
    for r in found:
        x = [math.floor(256 * c) for c in r.embedding]
        assert r.deviation == sum((9 * a - s) ** 2 for a, s in zip(x, learnt.sums, strict=True))
    assert learnt.identity_error < 1e-9
    assert whitening._deviations(np.array([[1 << 40], [0]]), 1, [0]) == [None, 0]


def test_whitening_clashing_columns(spark):
    rows = spark.createDataFrame([(1, [0.1, 0.9], 5, 6)], "vec_id long, embedding array<double>, Whole_Vector int, whitened int")
    learnt = whitening.fit(rows)
    found = whitening.with_whitened(rows, learnt)
    assert found.columns == ["vec_id", "embedding", "Whole_Vector", "whitened", "deviation"]
    assert found.first().Whole_Vector == 5


# -- 12 ---------------------------------------------------------------------------------------


def plain_runs(words, least=12):
    """All runs by trying every period at every place."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, q, b - a) for (a, b), q in found.items())


def plain_collapse(words, runs):
    gone = {i for a, q, n in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng):
    letters = rng.choice([1, 2, 3, 5, 50])
    kind = rng.random()
    if kind < 0.3:
        return [rng.randrange(letters) for _ in range(rng.randint(0, 300))]
    if kind < 0.5:
        a, b = [0], [0, 1]
        while len(b) < rng.randint(10, 400):
            a, b = b, b + a
        return b[rng.randrange(len(b)) :]

    def nested(depth):
        if not depth:
            return [rng.randrange(letters) for _ in range(rng.randint(1, 6))]
        out = []
        for _ in range(rng.randint(1, 3)):
            part = nested(depth - 1)
            out += part * rng.randint(1, 5) + part[: rng.randrange(len(part) + 1)]
        return out

    return nested(rng.randint(1, 3))[:600]


def test_runs_equal_brute_force():
    rng = random.Random(12)
    for _ in range(250):
        texts = [periodic_words(rng) for _ in range(rng.randint(1, 4))]
        hashes = [mix64(np.array(t, dtype=U) + U(1)) if t else np.zeros(0, U) for t in texts]
        bounds = np.cumsum([0, *map(len, texts)])
        words, heads = periodic._separated(np.concatenate(hashes), bounds)
        got = periodic.find_runs(words, max(map(len, texts)))
        want = [(a + h, a + h + n, q) for t, h in zip(texts, heads.tolist()) for a, q, n in plain_runs(t)]
        assert sorted(zip(got.start.tolist(), got.end.tolist(), got.period.tolist())) == sorted(want), texts


def test_stretches_of_short_periods_that_touch():
    """Longer runs around a fault in a run of period 4, some cut by the end of the text."""
    text = "01010010100010001000100010001000100100010001000100010001"
    got = periodic.find_runs(np.append(mix64(np.array(list(text), dtype=U)), U(5)), len(text))
    assert sorted(zip(got.start.tolist(), got.period.tolist(), (got.end - got.start).tolist())) == plain_runs(text)
    assert (10, 23, 46) in plain_runs(text)


def test_one_repeated_word_is_one_run():
    words = np.full(300_000, U(7))
    assert [a.tolist() for a in periodic.find_runs(words, len(words))] == [[0], [len(words)], [1]]


def planted(doc_id, text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    code, n = zlib.crc32(str(doc_id).encode()), len(words)
    if code % 10 == 0 and n:
        a = code // 10 % n
        p = 1 + (n - a) // (3 + code // 10 % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def check_periodic(rows, texts):
    for r in rows:
        words = planted(r.doc_id, texts[r.doc_id])
        runs = plain_runs(words)
        best = min(runs, key=lambda u: (-u[2], u[0], u[1]), default=None)
        assert r.n_runs == len(runs)
        assert (r.start, r.period, r.length) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[2] // best[1])
        listed = "".join(f"{a},{n},{q}\n" for a, q, n in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()


def test_periodic_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(4)
    names = ["ab", "Ab", "é", "日本", "x\x00", " ", " ", "."]
    texts = [" ".join(names[w % len(names)] for w in periodic_words(rng)) for _ in range(150)]
    texts += ["", " \n", None, "one", "\ta\x0bb\x0cc\r\nd  e ", " ".join(["lonely"] * 700)]
    documents(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op12_periodic(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts)
    assert sum(r.n_runs > 0 for r in rows) > 80
    check_periodic(rows, dict(enumerate(texts)))


def test_periodic_query_of_given_documents(spark, sf_dir):
    texts = {r.doc_id: r.text for r in queries.read_table(spark, sf_dir, "documents").select("doc_id", "text").collect()}
    short = {d for d, t in texts.items() if len((t or "").split()) < 1500}
    rows = [r for r in queries.op12_periodic(spark, sf_dir).collect() if r.doc_id in short]
    assert len(rows) == len(short) > 100
    check_periodic(rows, texts)


def test_runs_of_odd_tables(spark):
    schema = "doc_id long, text string, RUNS int, encoded int"
    loop = "a b " * 20
    docs = spark.createDataFrame([(None, loop, 1, 2), (1, None, 1, 2), (1, loop, 1, 2), (1, loop, 1, 2)], schema)
    found = periodic.with_runs(docs)
    assert found.columns == ["doc_id", "text", "encoded", "runs", "collapsed"]
    assert [r.collapsed for r in found.orderBy(F.col("text").desc_nulls_last()).collect()] == ["a b"] * 3 + [""]
    kept = periodic.collapse_runs(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.text) for r in kept.collect()) == ["None", "a b", "a b", "a b"]
    assert periodic.with_runs(docs.limit(0)).collect() == []
    assert queries.with_planted_period(docs.where("doc_id is null")).first().text == loop


# -- 13 ---------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def encoder():
    return token_counts.PieceEncoder(token_counts.default_model())


PARTS = ["a", " ", "▁", "the", "é", "日本", "\n", "  ", "aaaa", "😀", "<s>", "</s>", "\x00", "ing", " a", "0x", "̀", "①"]


def test_spliced_counts_equal_the_library(encoder):
    rng = random.Random(13)
    for _ in range(400):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 200))).encode()
        for chunk, overlap in ((16, 4), (64, 8), (7, 1)):
            assert token_counts.count_spliced(encoder, text, chunk, overlap) == len(encoder.model.encode(text.decode()))


def test_overlaps_widen_where_no_border_is_stable(encoder, monkeypatch):
    seen = []
    begins = token_counts.PieceEncoder.begins
    monkeypatch.setattr(token_counts.PieceEncoder, "begins", lambda self, t: seen.append(len(t)) or begins(self, t))
    loop = b"a" * 5000
    assert token_counts.count_spliced(encoder, loop, 100, 8) == encoder.count(loop)
    assert max(seen) == 5000 and len(seen) < 12
    seen.clear()
    prose = "some words and 日本語 ".encode() * 400
    assert token_counts.count_spliced(encoder, prose, 1000, 16) == encoder.count(prose)
    assert max(seen) < 1100


def test_chunks_that_disagree_are_encoded_whole(encoder, monkeypatch):
    """A border that one chunk does not have is never trusted."""
    begins = token_counts.PieceEncoder.begins
    monkeypatch.setattr(token_counts.PieceEncoder, "begins", lambda self, t: begins(self, t)[::3])
    text = b"nothing here is where it should be " * 60
    assert token_counts.count_spliced(encoder, text, 300, 16) == encoder.count(text)


def test_borders_are_in_every_context(encoder):
    rng = random.Random(5)
    for _ in range(200):
        text = "".join(rng.choices(PARTS, k=20)).encode()
        for at in encoder.stable_borders(text):
            assert encoder.count(text) == encoder.count(text[:at]) + int(np.sum(encoder.begins(text) >= at))
            assert at in encoder.begins(text)
    assert list(encoder.stable_borders(b"\xff\xfe ab")) == []


def test_token_query_equals_the_library(spark, sf_dir, encoder):
    rows = queries.op13_token_counts(spark, sf_dir).collect()
    texts = {r.doc_id: r.text or "" for r in queries.read_table(spark, sf_dir, "documents").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        n = len(encoder.model.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_token_counts_of_odd_tables(spark, encoder):
    huge = "word 日本 " * 20_000
    rows = [(None, "a", 1), (1, None, 1), (2, "", 1), (3, huge, 1), (3, huge, 1), (4, "</s><unk>\x00", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_Tokens int")
    found = token_counts.with_token_counts(docs, limit=2)
    assert found.columns == ["doc_id", "text", "n_bytes", "n_tokens", "over_limit"]
    for r in found.collect():
        n = len(encoder.model.encode(r.text or ""))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 2)
    assert found.count() == len(rows)
    assert token_counts.with_token_counts(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op12_periodic", "op13_token_counts"])
def test_plans_are_narrow(spark, sf_dir, name):
    text = queries.all_queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1

"""Whitening, clustering over the VA-file and winnowing against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tallyworks.llm import queries, va_file, whitening, winnowing
from tests.comparison import compare, connect
from tests.conftest import SMALL

VECTORS = "vec_id long, embedding array<float>, label int, x int, c int, n int, cells string, key int, cluster int"


@pytest.fixture(scope="module")
def vectors():
    """(vec_id, embedding): repeats, a frequent vector, NULLs, other lengths, far and tiny values."""
    chance = np.random.default_rng(11)
    base = chance.normal(scale=0.2, size=(240, 64)) @ np.diag(np.linspace(0.2, 2, 64)) + chance.normal(size=(6, 64))[chance.integers(0, 6, 240)]
    rows = [(i, [float(v) for v in np.float32(b)]) for i, b in enumerate(base)]
    rows += [(500 + i, rows[7][1]) for i in range(120)] + [(3, rows[3][1]), (3, rows[4][1]), (None, rows[9][1]), (None, None)]
    bad = [None, float("nan"), float("inf"), -float("inf")]
    rows += [(700 + i, [b, *rows[i][1][1:]]) for i, b in enumerate(bad)] + [(710, []), (711, [0.5] * 3), (712, [0.25, 1.0, 0.0]), (713, [0.0, 1.0, 2.0])]
    return rows


@pytest.fixture(scope="module")
def embeddings(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, 3, 4, "y", 5, 6) for i, v in vectors], VECTORS).repartition(5)


def usable(vectors, scale, dim):
    return [(i, [int(np.floor(scale * float(np.float32(c)))) for c in v]) for i, v in vectors if v is not None and len(v) == dim and all(c is not None and np.isfinite(c) for c in v)]


def test_factor_and_rotation():
    chance = np.random.default_rng(2)
    for d, rank in ((1, 1), (5, 3), (8, 8), (33, 20)):
        half = chance.normal(size=(d, rank)) * 10.0 ** chance.integers(-4, 4, rank)
        a = half @ half.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] == rank and np.allclose(factor @ factor.T, a, atol=1e-12 * np.abs(a).max())
        values, vectors = whitening.jacobi(factor)
        assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-9, atol=1e-13 * values[0])
        assert np.allclose(vectors.T @ vectors, np.eye(rank), atol=1e-12) and np.allclose(vectors * values @ vectors.T, a, atol=1e-12 * np.abs(a).max())
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_whitening_against_plain_numbers(spark, embeddings, vectors):
    found = {}
    for r in whitening.whiten(embeddings).collect():
        found.setdefault((r.vec_id, r.deviation), []).append(r)
    want = Counter()
    for dim in (64, 3):
        rows = usable(vectors, 256, dim)
        x = np.array(sorted({tuple(v) for _, v in rows}))
        n, total = len(x), [int(s) for s in x.sum(0)]
        cov = (x - x.mean(0)).T @ (x - x.mean(0)) / n
        values, axes = np.linalg.eigh(cov)
        values, axes = values[::-1], axes[:, ::-1]
        k = min(4, int((values > 1e-9 * values[0]).sum()))
        assert dim == 64 or k == 2
        white = (x - x.mean(0)) @ axes[:, :k] / np.sqrt(values[:k])
        for i, v in rows:
            away = sum((n * a - b) ** 2 for a, b in zip(v, total, strict=True))
            want[i, away] += k
            of = white[(x == v).all(1)][0]
            for r in found[i, away]:
                assert r.n == n and r.identity_error < 1e-10 and abs(r.explained / (values[r.component - 1] / np.trace(cov)) - 1) < 1e-10
                assert abs(abs(r.whitened) - abs(of[r.component - 1])) < 1e-9
    assert {key: len(rows) for key, rows in found.items()} == dict(want)
    one = {}
    for r in (r for rows in found.values() for r in rows if r.n > 10):
        one.setdefault(r.component, []).append(r.whitened)
    assert sorted(one) == [1, 2, 3, 4]


def test_whitening_of_nothing_and_of_one_vector(spark, embeddings):
    assert whitening.whiten(embeddings.where("false")).count() == 0
    assert whitening.whiten(embeddings.where("vec_id >= 500 and vec_id < 620")).count() == 0
    huge = spark.createDataFrame([(i, [float(2**40 + i), float(i)]) for i in range(4)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(huge, scale=1).where("component = 1").collect()
    assert {r.vec_id: r.deviation for r in rows} == {i: 2 * (4 * i - 6) ** 2 for i in range(4)}
    assert whitening._deviation(np.array([[2**40], [0]]), 2, np.array([2**40]), 2**40) == [None, None]


def plain_clusters(vectors, dim=64, scale=1024, k=8, rounds=10, seed=3):
    rows = usable(vectors, scale, dim)
    order = sorted(rows, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in order[:k]]

    def place():
        far = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in rows]
        return [(min(f), f.index(min(f))) for f in far]

    for _ in range(rounds):
        placed = place()
        for c in range(len(centroids)):
            mine = [v for (_, v), (_, at) in zip(rows, placed, strict=True) if at == c]
            if mine:
                centroids[c] = [sum(column) // len(mine) for column in zip(*mine, strict=True)]
    placed = place()
    inertia = Counter()
    for far, at in placed:
        inertia[at] += far
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, at, far, inertia[at], sum(inertia.values()), sha[at]) for (i, _), (far, at) in zip(rows, placed, strict=True))


def test_clusters_against_plain_rounds(embeddings, vectors):
    columns = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    for args in ({}, {"dim": 3}, {"k": 3, "rounds": 2, "seed": 9}):
        found = va_file.cluster(embeddings, **args)
        assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == plain_clusters(vectors, **args)
    assert va_file.cluster(embeddings.where("false")).count() == 0


def test_clusters_against_sql(spark):
    from tallyworks.llm.oracle import ORACLE

    problems, n = compare(queries.op12_va_file(spark, SMALL), connect(SMALL), ORACLE["op12_va_file"])
    assert not problems and n


@pytest.mark.parametrize("bits", [2, 4, 8])
def test_intervals_hold_the_distances(monkeypatch, bits):
    monkeypatch.setattr(va_file, "BITS", bits)
    chance = np.random.default_rng(bits)
    x, centroids = chance.integers(-500, 500, (300, 7)), chance.integers(-500, 500, (5, 7))
    centroids[3] = centroids[1]  # ties are not decided by cells
    low, high = x.min(0), x.max(0) + 1
    inner = np.sort(chance.integers(-500, 500, (2**bits - 1, 7)), axis=0)
    borders = np.vstack([low, np.clip(inner, low, high), high]).T
    cells = va_file.cells_of(x, borders).astype(int)
    assert all((borders[j][cells[:, j]] <= x[:, j]).all() and (x[:, j] < borders[j][cells[:, j] + 1]).all() for j in range(7))
    bounds = va_file.Bounds(borders, centroids)
    at, far = va_file.nearest(x, centroids)
    assert bounds.possible(cells)[np.arange(300), at].all()
    decided = bounds.decided(cells)
    assert (decided[decided >= 0] == at[decided >= 0]).all() and not (np.isin(decided, [1, 3])).any()
    assert (va_file.nearest(x, centroids, bounds.possible(cells))[0] == at).all()


def test_settled_vectors_are_not_read_and_the_file_is_not_moved(spark, embeddings):
    rows = embeddings.where("size(embedding) = 64 and vec_id < 240").selectExpr("monotonically_increasing_id() as key", "vec_id", "transform(embedding, v -> cast(floor(v * 1024) as int)) as x")
    rows = va_file.materialize(rows, "test")
    file = va_file.VaFile(rows, 64)
    x = np.array([r.x for r in rows.collect()])
    before, now = x[:4], x[4:8]
    total = Counter(file.sums(before))
    for place, v in file.changes(before, now).items():
        total[place] += v
    assert {p: v for p, v in total.items() if v} == {p: v for p, v in file.sums(now).items() if v}
    scan = file.table().select("key", "cells")._jdf.queryExecution().executedPlan().toString()
    assert "x#" not in scan.split("ReadSchema")[1]
    keys = spark.range(10).selectExpr("id as key").repartition(3)
    with_setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keys.join(file.table().select("key", "x"), "key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_setting)
    assert plan.count("ENSURE_REQUIREMENTS") == 1  # only the keys
    file.drop()
    assert not spark.catalog.tableExists(file.name)


def plain_marks(text, gram=winnowing.GRAM, window=winnowing.WINDOW):
    """(place, hash) by looking at every window."""
    if not text:
        return []
    runs = [text[i : i + gram] for i in range(max(len(text) - gram, 0) + 1)]
    hashes = [((h := xxhash.xxh64(r.encode("utf-32-be"), seed=42).intdigest()) >> 32) - (h >> 63 << 32) for r in runs]
    out = []
    for s in range(max(len(runs) - window, 0) + 1):
        part = hashes[s : s + window]
        at = s + max(i for i, h in enumerate(part) if h == min(part))
        if (at, hashes[at]) not in out[-1:]:
            out.append((at, hashes[at]))
    return out


def like(a, b):
    x, y = {h for _, h in a}, {h for _, h in b}
    return len(x & y) / len(x | y) if x | y else 1.0


def written(found):
    return " ".join(f"{h & 0xFFFFFFFF:08x}@{p}" for p, h in found)


def plain_edits(rows):
    """Rows in descending order of ids, those of one id by Spark's hash of their texts."""
    hashes = lambda t: (h := xxhash.xxh64(t.encode(), seed=42).intdigest()) - (h >> 63 << 64)
    order = sorted([(i, t or "") for i, t in rows], key=lambda r: (r[0] if r[0] is not None else -(2**63), hashes(r[1])), reverse=True)
    out = Counter()
    for at, (i, text) in enumerate(order):
        after = order[(at + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = plain_marks(text), plain_marks(edited)
        out[i, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(own), written(changed), like(own, changed), like(own, plain_marks(after))] += 1
    return out


COLUMNS = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def found_edits(spark, docs):
    found = winnowing.edits(spark, docs).withColumn("edited_sha256", F.sha2("edited", 256))
    return Counter(tuple(r[c] for c in COLUMNS) for r in found.collect())


@pytest.mark.parametrize("per_bucket", [1000, 7])
def test_marks_and_edits_against_all_windows(spark, documents, awkward, monkeypatch, per_bucket):
    monkeypatch.setattr(winnowing, "PER_BUCKET", per_bucket)
    monkeypatch.setattr(winnowing, "SEGMENT", 500)
    assert found_edits(spark, documents) == plain_edits(awkward)


def test_edits_of_short_texts_and_ties(spark, monkeypatch):
    monkeypatch.setattr(winnowing, "PER_BUCKET", 5)
    chance = random.Random(21)
    for letters in ("a", "ab", "aé😀z "):
        rows = [(i, "".join(chance.choice(letters) for _ in range(chance.choice([0, 1, 3, 15, 16, 17, 30, 46, 47, 48, 60, 95, 140])))) for i in range(60)]
        rows += [(5, rows[5][1]), (5, "other"), (None, "x"), (None, None)] + [(70, "same again " * 9)] * 30
        assert found_edits(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)) == plain_edits(rows)
    assert found_edits(spark, spark.createDataFrame([(4, "alone in the table")], "doc_id long, text string")) == plain_edits([(4, "alone in the table")])
    assert winnowing.edits(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_shared_runs_leave_shared_marks(spark):
    chance = random.Random(22)
    say = lambda n: "".join(chance.choice("abcdefgh ") for _ in range(n))
    shared = [say(winnowing.REACH) for _ in range(40)]
    rows = [(2 * k + side, say(chance.randint(0, 200)) + s + say(chance.randint(0, 200))) for k, s in enumerate(shared) for side in (0, 1)]
    marks = {r.doc_id: {m.hash for m in r.marks} for r in winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(marks[2 * k] & marks[2 * k + 1] for k in range(40))


def test_marks_need_no_python(spark):
    plan = winnowing.edits(spark, spark.read.parquet(f"{SMALL}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapIn" not in plan

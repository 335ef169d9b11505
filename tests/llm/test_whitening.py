"""Whitening against an eigendecomposition in numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import whitening

VECTORS = "vec_id bigint, embedding array<float>, row string, x string, component string"


def reference(rows, scale=256):
    """(vec_id, x) of the kept rows, and sizes, sums, eigenvalues and axes of the distinct ones."""
    kept = [(i, np.floor(scale * np.array(v, np.float32).astype(float)).astype(np.int64))
            for i, v, *_ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.unique(np.array([x for _, x in kept]), axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return kept, n, sums, values[::-1], axes[:, ::-1]


def check(got, rows, components=4):
    kept, n, sums, values, axes = reference(rows)
    assert len(got) == len(kept) * min(components, len(sums))
    by_component = {}
    for r in got:
        by_component.setdefault(r["component"], []).append(r)
    for c, found in by_component.items():
        assert {(r["n"], r["identity_error"] < 1e-9) for r in found} == {(n, True)}
        assert found[0]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
        want = sorted((str(i), sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums))) for i, x in kept)
        assert sorted((str(r["id"]), r["deviation"]) for r in found) == want
        if values[c - 1] < 1e-9:
            assert {r["whitened"] for r in found} == {None}
            continue
        exact = {}
        for i, x in kept:
            exact.setdefault(str(i), []).append(((n * x - sums) / n) @ axes[:, c - 1] / math.sqrt(values[c - 1]))
        sign = np.sign(sum(r["whitened"] * exact[str(r["id"])][0] for r in found if len(exact[str(r["id"])]) == 1))
        for i, mine in exact.items():
            theirs = sorted(sign * r["whitened"] for r in found if str(r["id"]) == i)
            assert theirs == pytest.approx(sorted(mine), abs=1e-9)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    spread = [3, 2, 1.5, 1.2, 1, 0.7]
    out = [(i, [r.gauss(0.5, s) for s in spread]) for i in range(60)]
    out += [(100 + i, out[0][1]) for i in range(70)]  # more than half of the rows are copies
    out += [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [math.nan] * 6), (203, [math.inf, 0.0, 0.0, 0.0, 0.0, 0.0]),
            (None, out[1][1]), (204, out[2][1]), (204, out[2][1])]
    return [(*x, "clash", "clash", "clash") for x in out]


def whitened(df, **more):
    return whitening.whiten(df, **more).select("row.vec_id", "*").withColumnRenamed("vec_id", "id").collect()


def test_whitening(spark, rows):
    check(whitened(spark.createDataFrame(rows, VECTORS).repartition(4)), rows)


def test_dependent_and_constant_columns(spark):
    r = random.Random(5)
    rows = []
    for i in range(40):
        a, b = r.randrange(-2000, 2000), r.randrange(-1000, 1000)
        rows.append((i, [a / 256, a / 256, b / 256, 7.0, (a + b) / 256], "c", "c", "c"))  # rank 2 of 5
    check(whitened(spark.createDataFrame(rows, VECTORS)), rows)


def test_more_dimensions_than_rows(spark):
    r = random.Random(6)
    rows = [(i, [r.uniform(-1, 1) for _ in range(20)], "c", "c", "c") for i in range(6)]
    check(whitened(spark.createDataFrame(rows, VECTORS)), rows)


def test_a_single_distinct_vector(spark):
    rows = [(i, [1.0, 2.0], "c", "c", "c") for i in range(3)]
    got = whitened(spark.createDataFrame(rows, VECTORS))
    assert sorted((r["id"], r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in got) == [
        (i, c, 1, 0, None, None, 0.0) for i in range(3) for c in (1, 2)
    ]


def test_tables_without_whole_vectors(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    for none in (df.filter("false"), df.filter("vec_id IN (200, 201)")):
        assert whitened(none) == []
    assert whitened(df.withColumn("embedding", F.array().cast("array<float>"))) == []


def test_lengths_are_spaces_of_their_own(spark, rows):
    short = [(1000 + i, [float(i % 7), float(i % 3)], "c", "c", "c") for i in range(30)]
    got = whitened(spark.createDataFrame([*rows, *short], VECTORS))
    check([r for r in got if r["id"] is not None and r["id"] >= 1000], short)
    check([r for r in got if r["id"] is None or r["id"] < 1000], rows)


def test_deviations_beyond_32_bits():
    centre = whitening.Centre(3, [10**9, -(10**9)])
    x = np.array([[10**9, -(10**9)], [0, 1], [2**40, 0]])
    want = [sum((3 * int(a) - s) ** 2 for a, s in zip(row, centre.sums)) for row in x]
    assert centre.deviations(x) == [w if w < 2**63 else None for w in want]
    assert want[0] < 2**63 < want[2]


def test_an_ill_conditioned_matrix_is_orthogonalised(spark):
    r = np.random.default_rng(2)
    base = r.integers(-(10**6), 10**6, (300, 1))
    rows = [(i, [float(v) for v in (base[i] + np.array([0, 1, 2, 3]) * r.integers(-1, 2, 4))], "c", "c", "c") for i in range(300)]
    df = spark.createDataFrame(rows, VECTORS.replace("float", "double"))
    got = whitening.whiten(df, scale=1).select("component", "whitened", "identity_error").collect()
    assert got[0]["identity_error"] < 1e-4

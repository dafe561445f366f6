import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradewind.llm import whitening

VECTORS = "vec_id long, embedding array<double>"


def frame(spark, rows, schema=VECTORS):
    return spark.createDataFrame(rows, schema).repartition(3)


def expected(rows, wanted=whitening.COMPONENTS):
    """Whole matrices on one machine: eigenvalues, and by row the number, the exact deviation and the whitened vector."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in good], object)
    n, sums = len(x), x.sum(axis=0)
    centred = np.array([[float(Fraction(int(n * a - s), n)) for a, s in zip(row, sums)] for row in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(wanted, int((values > whitening.RANK * values[0]).sum())) if values[0] > 0 else 0
    white = centred @ vectors[:, :k] / np.sqrt(values[:k])
    return values, {i: (n, int(((n * r - sums) ** 2).sum()), w) for (i, _), r, w in zip(good, x, white)}


def compared(found, rows, wanted=whitening.COMPONENTS):
    values, want = expected(rows, wanted)
    got = {r["vec_id"]: r for r in found.collect()}
    assert got.keys() == want.keys()
    ids = sorted(want)
    a, b = (np.array([list(x) for x in c]) for c in ([got[i]["whitened"] for i in ids], [want[i][2] for i in ids]))
    assert a.shape == b.shape
    b = b * np.sign((a * b).sum(axis=0))
    assert np.abs(a - b).max() < 1e-8 * max(1, np.abs(b).max())
    first = got[ids[0]]
    assert np.allclose(first["explained"], values[:a.shape[1]] / values.sum(), rtol=1e-9)
    assert all((r["n"], int(r["deviation"])) == want[i][:2] and r["identity_error"] == first["identity_error"] < 1e-9 for i, r in got.items())


@pytest.mark.parametrize("dimension,wanted,spread", [(6, 32, 1.0), (60, 32, 1.0), (60, 5, 0.97), (70, 4, 0.5)])
def test_equals_whole_matrices(spark, dimension, wanted, spread):
    rng = np.random.default_rng(dimension + wanted)
    x = rng.standard_normal((500, dimension)) * spread ** np.arange(dimension) * 3 + rng.standard_normal(dimension) * 20
    rows = [(n, v) for n, v in enumerate(x.tolist())]
    compared(whitening.whiten(frame(spark, rows), wanted), rows, wanted)


def test_one_large_component_beside_a_flat_spectrum(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((900, 64)) + np.outer(rng.random(900) < 0.3, np.full(64, 9.0))
    rows = [(n, v) for n, v in enumerate(x.tolist())]
    compared(whitening.whiten(frame(spark, rows)), rows)


def test_the_filter_does_the_work(spark):
    """The block is narrower than the vectors, and a start that lacks the largest component finds it all the same."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 64))
    x[:, 0] *= 30
    packed = whitening.blocks(frame(spark, [(n, v) for n, v in enumerate(x.tolist())]))
    data = whitening._Centred(packed.persist(), 64)
    blind, times = np.eye(64)[1:], data.times
    calls = []

    def counted(q):
        calls.append(q.shape)
        # The first products miss the first dimension altogether.
        return blind.T @ (blind @ times(blind.T @ (blind @ q))) if len(calls) <= 30 else times(q)

    data.times = counted
    values, found = whitening.components(data, 8)
    c = np.floor(64 * x) - np.floor(64 * x).mean(axis=0)
    assert np.allclose(values, np.linalg.eigvalsh(c.T @ c / 400)[::-1][:8], rtol=1e-10)
    assert len(calls) > 3 * whitening.DEGREE and max(s[1] for s in calls) < 64


def test_left_out_and_defined_cases(spark):
    good = [(n, [float(n), n * n / 7, -1.5]) for n in range(9)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [float("nan"), 1.0, 1.0]), (94, [1.0, float("-inf"), 1.0]), (95, [1e300, 0.0, 0.0])]
    short = [(96, [1.0, 2.0]), (97, [1.0, 2.0, 3.0, 4.0])]
    compared(whitening.whiten(frame(spark, good + odd + short)), good)
    floats = frame(spark, good + odd[:-1], "vec_id long, embedding array<float>")
    assert whitening.whiten(floats).count() == 9


def test_repeats_nulls_and_extra_columns(spark):
    rows = [(None, [1.0, 2.0]), (None, [3.0, 1.0]), (5, [2.0, 2.0]), (5, [2.0, 2.0])]
    clashing = frame(spark, rows).withColumns({"n": F.lit("x"), "whitened": F.lit(1), "d": F.lit(None).cast("int"), "deviation": F.lit(2)})
    found = whitening.whiten(clashing).collect()
    assert sorted(str(r["vec_id"]) for r in found) == ["5", "5", "None", "None"] and {r["n"] for r in found} == {4}
    text = frame(spark, [("a", [1.0, 2.0]), ("b", [2.0, 5.0])], "vec_id string, embedding array<double>")
    assert sorted(r["vec_id"] for r in whitening.whiten(text).collect()) == ["a", "b"]


def test_without_variance_or_rows(spark):
    same = whitening.whiten(frame(spark, [(n, [1.0, 2.0]) for n in range(4)])).collect()
    assert [list(r["whitened"]) for r in same] == [[]] * 4 and {int(r["deviation"]) for r in same} == {0}
    assert whitening.whiten(frame(spark, [])).count() == 0 and whitening.whiten(frame(spark, [(1, None)])).count() == 0


def test_large_numbers_stay_exact(spark):
    rows = [(n, [n * 1e9 + 0.3, -n * 1e12, float(n % 3)]) for n in range(40)]
    _, want = expected(rows)
    found = whitening.whiten(frame(spark, rows)).collect()
    assert {r["vec_id"]: int(r["deviation"]) for r in found} == {i: w[1] for i, w in want.items()}

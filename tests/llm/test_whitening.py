import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from ..conftest import SF_SMALL
from vaxmart.llm import registry, whitening

SCHEMA = "vec_id long, embedding array<double>, component int, n string"


def brute(rows):
    """(x by row, n, S, V) with exact whole numbers and fractions."""
    kept = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, dim = len(fit), len(fit[0])
    s = [sum(x[d] for x in fit) for d in range(dim)]
    v = [[float(Fraction(n * sum(x[a] * x[b] for x in fit) - s[a] * s[b], n * n)) for b in range(dim)] for a in range(dim)]
    return kept, fit, n, s, np.array(v)


def verify(rows, got):
    kept, fit, n, s, v = brute(rows)
    e, w = np.linalg.eigh(v)
    e, w = e[::-1], w[:, ::-1]
    size = min(16, int((e > e[0] * len(e) * np.finfo(float).eps).sum()))
    assert len(got) == size * len(kept) and {r["n"] for r in got} == {n}
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    sign = {}
    for i, x in kept:
        mine = by_id[i]
        assert sorted(mine) == list(range(1, size + 1))
        for k in range(size):
            for r in mine[k + 1]:
                assert r["deviation"] == sum((n * a - b) ** 2 for a, b in zip(x, s))
                assert math.isclose(r["explained"], e[k] / np.trace(v), rel_tol=1e-9)
                want = float(np.dot([a - b / n for a, b in zip(x, s)], w[:, k]) / math.sqrt(e[k]))
                if abs(want) > 1e-3:
                    sign.setdefault(k, np.sign(want) * np.sign(r["whitened"]))
                    assert math.isclose(r["whitened"], sign[k] * want, rel_tol=1e-6, abs_tol=1e-6)
    assert all(r["identity_error"] < 1e-6 for r in got)


def test_small_table(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet'").fetchall()
    verify(rows, registry.QUERIES["op11_whitening"](spark, SF_SMALL).collect())


@pytest.mark.parametrize("scale", [1.0, 900.0])
def test_brute_force_with_odd_rows(spark, scale):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.normal(0, scale, 5)]) for i in range(300)]
    rows += [(300 + i, rows[7][1]) for i in range(40)] + [(None, rows[3][1])]
    rows += [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0]), (402, [math.nan] * 5), (403, [1.0, math.inf, 0.0, 0.0, 0.0]), (404, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    verify(rows, whitening.whiten(df).collect())
    more = df.union(spark.createDataFrame([(500, [1.0, 2.0], 1, "x"), (501, [1e300] * 5, 1, "x")], SCHEMA))
    verify(rows, whitening.whiten(more).collect())


def test_degenerate_tables(spark):
    make = lambda rows: whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA))
    assert make([]).count() == make([(1, None), (2, [])]).count() == make([(1, [1.0, 2.0])] * 3).count() == 0
    flat = [(i, [float(i % 7), 2.0, -float(i % 7)]) for i in range(30)]  # rank one
    out = make(flat).collect()
    assert len(out) == 30 and {r["component"] for r in out} == {1}
    verify(flat, out)


def test_scatter_is_exact():
    rng = np.random.default_rng(1)
    for bits in (1, 3, 13):
        x = rng.integers(0, 1 << bits, (200, 6)).astype(np.uint16)
        counts = whitening.cross_counts(whitening.planes(x, bits))
        exact = x.astype(object).T @ x.astype(object)
        for a in range(6):
            for b in range(a, 6):
                assert sum(int(c) << k for k, c in enumerate(counts[:, a, b])) == exact[a, b]


def test_deviations_beyond_a_long(spark):
    rows = [(i, [float(1 << 40) * i, 3.0 * i * i]) for i in range(20)]
    out = whitening.whiten(spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)).collect()
    kept, _, n, s, _ = brute(rows)
    want = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in kept}
    assert all((r["deviation"], r["deviation_digits"]) in ((want[r["vec_id"]], None), (None, str(want[r["vec_id"]]))) for r in out)
    assert any(r["deviation"] is None for r in out)

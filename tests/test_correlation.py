"""Correlation of all pairs against pandas, with nulls, constants and empty tables."""

import math
import random

import pandas as pd

from retenta.operators.profiling import correlation_matrix


def test_pairs_match_pandas(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(500):
        x = rnd.gauss(0, 1)
        row = [x, 1e9 + x + rnd.gauss(0, 1), -x, 3.0, None, rnd.random()]
        rows.append([None if v is not None and k < 3 and rnd.random() < 0.2 else v for k, v in enumerate(row)])
    names = ["a", "far away", "c", "same", "none", "f"]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(5)
    want = pd.DataFrame(rows, columns=names).astype(float).corr()
    out = correlation_matrix(df, names).collect()
    assert len(out) == 15
    for r in out:
        if {r.a, r.b} & {"same", "none"}:
            assert r["corr"] is None
        else:
            assert math.isclose(r["corr"], want.loc[r.a, r.b], abs_tol=1e-6)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b long")
    assert all(r["corr"] is None for r in correlation_matrix(empty, ["a", "b"]).collect())

"""Null and tie semantics compared with pandas itself on random inputs:
row-wise mean / sum that skip nulls, mode (ties -> smallest), median,
sorted label codes."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings, strategies as st

from retenta.functions.scalar import row_mean_skipna, row_sum_skipna
from retenta.operators.encoding import apply_label_encoder, fit_label_encoder
from retenta.operators.imputation import fit_table

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
maybe_int = st.one_of(st.none(), st.integers(-1000, 1000))


@SETTINGS
@given(st.lists(st.tuples(*[maybe_int] * 6), min_size=1, max_size=20))
def test_row_mean_and_sum_match_pandas(spark, rows):
    cols = [f"m{i}" for i in range(6)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, " + ", ".join(f"{c} bigint" for c in cols))
    got = {r["id"]: r for r in df.select("id", row_mean_skipna(cols).alias("mean"),
                                          row_sum_skipna(cols).alias("sum")).collect()}
    pdf = pd.DataFrame(rows, columns=cols, dtype="float64")
    for i, (m, s) in enumerate(zip(pdf.mean(axis=1), pdf.sum(axis=1))):
        assert (got[i]["mean"] is None) == math.isnan(m)
        if not math.isnan(m):
            assert math.isclose(got[i]["mean"], m, rel_tol=1e-12, abs_tol=1e-12)
        assert got[i]["sum"] == s


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["a", "b", "c", "Cero"])), min_size=1, max_size=25),
       st.lists(st.one_of(st.none(), st.integers(0, 9).map(float)), min_size=1, max_size=25))
def test_mode_and_median_match_pandas(spark, labels, numbers):
    n = max(len(labels), len(numbers))
    labels = (labels * n)[:n]
    numbers = (numbers * n)[:n]
    df = spark.createDataFrame(list(zip(labels, numbers)), "s string, x double")
    got = {r["variable"]: r["value"] for r in fit_table(df, "t", (("s", "moda"), ("x", "mediana"))).collect()}
    mode = pd.Series(labels, dtype="object").mode()
    assert got["s"] == (mode.iloc[0] if len(mode) else None)
    med = pd.Series(numbers, dtype="float64").median()
    assert (got["x"] is None) == math.isnan(med)
    if not math.isnan(med):
        assert float(got["x"]) == med


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["Rango_SDO_01", "Rango_SDO_00", "b", "B", "a"])),
                min_size=1, max_size=20))
def test_label_codes_match_sorted_vocabulary(spark, labels):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "id int, c string")
    enc = fit_label_encoder(df, ["c"])
    got = {r["id"]: r["c"] for r in apply_label_encoder(df, enc, ["c"]).collect()}
    vocab = sorted({v for v in labels if v is not None})
    code = {v: i for i, v in enumerate(vocab)}
    for i, v in enumerate(labels):
        assert got[i] == (code[v] if v is not None else len(vocab))


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "a", "b"]), st.integers(0, 5)),
                min_size=1, max_size=40), st.integers(1, 6))
def test_distributed_order_matches_window_on_random_ties(spark, rows, parts):
    from pyspark.sql import Window, functions as F
    from retenta.operators.ordering import row_number_global, running_sums
    df = spark.createDataFrame([(i, g, float(s)) for i, (g, s) in enumerate(rows)], "id long, g string, s double")
    w = Window.partitionBy("g").orderBy(F.col("s").desc(), F.col("id"))
    want = df.select("id", F.row_number().over(w).alias("rn"))
    got = row_number_global(df, [F.col("s").desc(), F.col("id")], partition_cols=["g"], name="rn",
                            num_partitions=parts).select("id", "rn")
    assert sorted(got.collect()) == sorted(want.collect())
    agg = df.groupBy("g", "s").agg(F.count(F.lit(1)).alias("n"))
    cw = Window.partitionBy("g").orderBy(F.col("s").desc()).rowsBetween(Window.unboundedPreceding, 0)
    want_cum = agg.select("g", "s", F.sum("n").over(cw).alias("n_cum"))
    got_cum = running_sums(agg, ["n"], [F.col("s").desc()], partition_cols=["g"], num_partitions=parts)
    assert sorted(got_cum.select("g", "s", "n_cum").collect()) == sorted(want_cum.collect())

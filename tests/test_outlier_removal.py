"""Sequential outlier removal by downdated moments against the column-by-column loop."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from retentio.operators import clean as CL


def _loop(pdf, cols, t):
    for c in cols:
        s = pdf[c].std(ddof=1)
        if s and not np.isnan(s):
            pdf = pdf[~(((pdf[c] - pdf[c].mean()) / s).abs() > t)]
    return pdf


def _frame(n=3000, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(0, 1, n)
    pdf = pd.DataFrame({"id": np.arange(n), "a": base, "b": base * 2 + rng.normal(0, 1, n), "heavy": rng.standard_t(2, n),
                        "far": rng.normal(1e8, 3.0, n), "flat": 5.0, "tied": base ** 3 * 10, "none": np.nan})
    pdf.loc[::13, "b"] = np.nan
    pdf.loc[[5, 50], ["a", "tied"]] = [[400.0, 1e9], [-300.0, -1e9]]     # most of the variance goes with two rows
    return pdf


def _spark(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.select("id", *[F.when(~F.isnan(c), F.col(c)).alias(c) for c in pdf.columns if c != "id"])


@pytest.mark.parametrize("suspect", [0.5, 0.85, 0.999])
@pytest.mark.parametrize("cols", [["a", "b", "heavy", "far", "flat", "tied", "none"], ["tied", "heavy", "a", "b"], ["heavy"]])
def test_equals_the_loop(spark, monkeypatch, suspect, cols):
    monkeypatch.setattr(CL, "SUSPECT", suspect)
    pdf = _frame()
    got = sorted(r["id"] for r in CL.remove_outliers(_spark(spark, pdf), cols, 3.0).select("id").collect())
    assert got == sorted(_loop(pdf, cols, 3.0)["id"]) and len(got) < len(pdf)


def test_like_columns_take_two_scans(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame(rng.normal(0, 1, (4000, 6)), columns=list("abcdef"))
    assert len(CL._downdated(spark.createDataFrame(pdf), list("abcdef"), 3.0)) == 6


def test_empty_and_single_rows(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    assert CL.remove_outliers(df, ["a", "b"]).count() == 1
    assert CL.remove_outliers(df.limit(0), ["a", "b"]).count() == 0
    assert CL.remove_outliers(df, []).count() == 1

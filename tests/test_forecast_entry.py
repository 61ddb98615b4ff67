"""Sequence windows (edge case: shorter / equal / longer than the window) and the driver contract."""
from retentio.operators import forecast as FC


def _panel(spark):
    rows = []
    for cid, length in [(1, 2), (2, 3), (3, 4)]:
        for t in range(1, length + 1):
            rows.append((cid, t, float(t), 0.0, t % 2))
    return spark.createDataFrame(rows, "id long, t int, n double, e double, label int")


def test_sequences_need_window_plus_one(spark):
    out = FC.sequences(_panel(spark), "id", "t", ["n", "e"], "label", window=3).collect()
    assert [(r["id"], r["t_end"]) for r in out] == [(3, 3)]


def test_forecast_skips_short_and_slides_last_observed(spark):
    out = FC.forecast(_panel(spark), "id", "t", ["n", "e"], [0, 0, 0, 0, 1, 0], 0.0, window=3, periods=3)
    rows = sorted((r["id"], r["period"], r["t"], r["forecast_prob"]) for r in out.collect())
    assert {r[0] for r in rows} == {2, 3}
    # only the newest slot has weight: every period sees the last observed n
    assert all(r[2] == 4 + r[1] for r in rows)
    assert len({r[3] for r in rows if r[0] == 3}) == 1


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())


def test_forecast_timestamp_labels_add_months(spark):
    import datetime as dt
    rows = [(1, dt.datetime(2024, m, 1), float(m), 0.0, 0) for m in range(1, 5)]
    df = spark.createDataFrame(rows, "id long, t timestamp, n double, e double, label int")
    out = FC.forecast(df, "id", "t", ["n", "e"], [0] * 6, 0.0, window=3, periods=2, time_kind="timestamp")
    got = sorted((r["period"], r["t"]) for r in out.collect())
    assert [p for p, _ in got] == [1, 2] and got[0][1].month == 5 and got[1][1].month == 6


def test_run_log_appends(spark):
    import tempfile

    from retentio.operators.models import append_run_log
    d = tempfile.mkdtemp(prefix="retentio-test-")
    append_run_log(spark, f"{d}/log", {"auc": 0.8, "threshold": 0.4})
    append_run_log(spark, f"{d}/log", {"auc": 0.9, "threshold": 0.5})
    assert spark.read.parquet(f"{d}/log").count() == 2

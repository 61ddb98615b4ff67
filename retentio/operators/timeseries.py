"""Time-series ensemble (survey §2.11, T1-T7): base models per period -> sequences of their
scores -> sequence model -> scored series and forecasts.

``fit`` takes a panel (id, time, features, label).  A base model is a set of features; for
each, one logistic model per period and one over all periods are fitted
(``irls.fit_groups``).  The per-period scores of a customer, in windows of consecutive rows,
are the inputs of the sequence model, whose label is that of the row after the window;
a period without a model (its label takes one value) scores 0.  Rows to be scored later may
lie in periods that were never seen, so ``score`` and ``forecast`` feed the sequence model with
the models over all periods; rows before the first full window take their mean.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentio.operators import forecast as FC
from retentio.operators import irls
from retentio.session import stored


def _score(df: DataFrame, coefficients: Sequence[float], features: Sequence[str], name: str) -> DataFrame:
    eta = irls.linear([F.lit(b) for b in coefficients],
                      [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
    return df.withColumn(name, irls.logistic(eta))


@dataclass
class TimeSeriesModel:
    """A fitted chain.  ``period_models`` has one row per base model, period and coefficient."""
    id_col: str
    time_col: str
    bases: dict[str, list[str]]
    window: int
    overall: dict[str, list[float]]
    sequence: list[float]
    period_models: DataFrame

    @property
    def scores(self) -> list[str]:
        return [f"p_{b}" for b in self.bases]

    def base_scores(self, panel: DataFrame) -> DataFrame:
        """``panel`` with one score per base model, from the models over all periods."""
        for b, features in self.bases.items():
            panel = _score(panel, self.overall[b], features, f"p_{b}")
        return panel

    def score_sequences(self, seqs: DataFrame) -> DataFrame:
        """``seqs`` (windows of base scores) with ``prob``."""
        x = [f"x{s}_{c}" for s in range(self.window) for c in self.scores]
        return _score(seqs, self.sequence, x, "prob")

    def score(self, panel: DataFrame) -> DataFrame:
        """T4: (id, time, score) of every row."""
        mean = sum((F.col(c) for c in self.scores), F.lit(0.0)) / len(self.scores)
        return FC.score_series(self.base_scores(panel), self.id_col, self.time_col, self.scores, self.sequence[1:],
                               self.sequence[0], mean, self.window)

    def forecast(self, panel: DataFrame, periods: int = 3, time_kind: str = "numeric") -> DataFrame:
        """(id, time, forecast_prob, period) of every customer with a full window."""
        return FC.forecast(self.base_scores(panel), self.id_col, self.time_col, self.scores, self.sequence[1:],
                           self.sequence[0], self.window, periods, time_kind)

    def history_and_forecast(self, panel: DataFrame, customers: DataFrame, periods: int = 3) -> DataFrame:
        """(id, time, prob, kind) of the chosen customers: what a forecast chart shows."""
        chosen = panel.join(customers.select(self.id_col).distinct(), self.id_col)
        past = self.score(chosen).select(self.id_col, self.time_col, F.col("score").alias("prob"), F.lit("history").alias("kind"))
        coming = self.forecast(chosen, periods).select(self.id_col, self.time_col, F.col("forecast_prob").alias("prob"),
                                                       F.lit("forecast").alias("kind"))
        return past.unionByName(coming)

    def save(self, path: str) -> None:
        self.period_models.write.mode("overwrite").parquet(f"{path}/period_models")
        meta = {k: getattr(self, k) for k in ("id_col", "time_col", "bases", "window", "overall", "sequence")}
        (self.period_models.sparkSession.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1)
         .write.mode("overwrite").text(f"{path}/metadata"))

    @staticmethod
    def load(spark: SparkSession, path: str) -> "TimeSeriesModel":
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        return TimeSeriesModel(**meta, period_models=spark.read.parquet(f"{path}/period_models"))


def period_models(panel: DataFrame, time_col: str, bases: Mapping[str, Sequence[str]], label: str,
                  ridge: float = 1.0) -> dict[str, DataFrame]:
    """Per base model a table (time, n, b0, b1, ...), all periods fitted together."""
    return {b: irls.fit_groups(panel, time_col, features, label, ridge) for b, features in bases.items()}


def period_scores(panel: DataFrame, time_col: str, bases: Mapping[str, Sequence[str]],
                  models: Mapping[str, DataFrame]) -> DataFrame:
    """``panel`` with the scores of its own periods' models; 0 where a period has none."""
    for b, features in bases.items():
        coefficients = [f"b{i}" for i in range(len(features) + 1)]
        eta = irls.linear([F.col(c) for c in coefficients],
                          [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features])
        panel = (panel.join(models[b].select(time_col, *coefficients), time_col, "left")
                 .withColumn(f"p_{b}", F.coalesce(irls.logistic(eta), F.lit(0.0))).drop(*coefficients))
    return panel


def sequences(panel: DataFrame, id_col: str, time_col: str, bases: Mapping[str, Sequence[str]], label: str,
              models: Mapping[str, DataFrame], window: int = 3) -> DataFrame:
    """T2 over the per-period scores: the sequence model's rows."""
    scored = period_scores(panel, time_col, bases, models)
    return FC.sequences(scored, id_col, time_col, [f"p_{b}" for b in bases], label, window)


def fit(panel: DataFrame, id_col: str, time_col: str, bases: Mapping[str, Sequence[str]], label: str, window: int = 3,
        ridge: float = 1.0) -> TimeSeriesModel:
    """Fit the whole chain.  Raises ValueError if no customer has a row after a full window."""
    names = list(dict.fromkeys(c for f in bases.values() for c in f))
    panel = stored(panel.select(id_col, time_col, label, *names), "panel")
    models = period_models(panel, time_col, bases, label, ridge)
    seqs = sequences(panel, id_col, time_col, bases, label, models, window)
    x = [f"x{s}_p_{b}" for s in range(window) for b in bases]
    sequence = irls.fit_groups(seqs, None, x, "label_next", ridge).first()
    overall = {b: irls.fit_groups(panel, None, f, label, ridge).first() for b, f in bases.items()}
    if sequence is None or None in overall.values():
        raise ValueError("the labels of the panel or of its sequences take one value only")
    rows = None
    for b, features in bases.items():
        one = irls.terms(models[b], time_col, features).select(F.lit(b).alias("model"), "*")
        rows = one if rows is None else rows.unionByName(one)
    values = lambda row, k: [row[f"b{i}"] for i in range(k + 1)]                          # noqa: E731
    return TimeSeriesModel(id_col, time_col, {b: list(f) for b, f in bases.items()}, window,
                           {b: values(overall[b], len(f)) for b, f in bases.items()}, values(sequence, len(x)), rows)

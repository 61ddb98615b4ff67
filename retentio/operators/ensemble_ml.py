"""Ensembles as Spark ML estimators and models (survey §2.10, B1-B9; §2.8, M11).

A fitted ensemble is a ``PipelineModel``: every base model adds one score column, and a last
stage combines them.  So it scores rows it has never seen, and Spark ML's own writer and
reader save and load it as a whole.

Stacking fits the meta-model on out-of-fold scores.  Ridge-logistic bases fit all
folds in one grouped IRLS (a row belongs to the groups of the folds that leave it in);
other kinds fit one pipeline a fold.  The base models are then refitted on all rows.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.operators import ensemble as EB
from retentio.operators import irls
from retentio.operators.models import create_model
from retentio.operators.sample import stratified_kfold, stratified_split
from retentio.session import stored

RIDGE = "ridge_logistic"
METHODS = ("voting", "averaging", "weighted", "stacking", "blending")
#: columns that Spark ML's classifiers add, dropped once the score is taken
SCRATCH = ["raw_features", "features", "rawPrediction", "probability", "prediction"]


def _param(name: str, convert):
    return Param(Params._dummy(), name, name, typeConverter=convert)


def score_column(coefficients, features) -> Column:
    """Logistic score of raw feature columns; NULL counts as 0."""
    x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
    return irls.logistic(irls.linear([F.lit(float(b)) for b in coefficients], x))


class RidgeLogisticModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``scoreCol`` from ``coefficients`` (intercept first)."""
    features = _param("features", TypeConverters.toListString)
    coefficients = _param("coefficients", TypeConverters.toListFloat)
    scoreCol = _param("scoreCol", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, features=None, coefficients=None, scoreCol="prob"):
        super().__init__()
        self._setDefault(scoreCol="prob")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("scoreCol"),
                             score_column(self.getOrDefault("coefficients"), self.getOrDefault("features")))


class RidgeLogistic(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Logistic regression with an L2 penalty on raw features (M6 with its default penalty of 1)."""
    features = _param("features", TypeConverters.toListString)
    labelCol = _param("labelCol", TypeConverters.toString)
    scoreCol = _param("scoreCol", TypeConverters.toString)
    ridge = _param("ridge", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, features=None, labelCol="label", scoreCol="prob", ridge=1.0):
        super().__init__()
        self._setDefault(labelCol="label", scoreCol="prob", ridge=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> RidgeLogisticModel:
        features = self.getOrDefault("features")
        row = irls.fit_groups(df, None, features, self.getOrDefault("labelCol"), self.getOrDefault("ridge")).first()
        if row is None:
            raise ValueError("the label takes one value only")
        return RidgeLogisticModel(features=features, coefficients=[row[f"b{i}"] for i in range(len(features) + 1)],
                                  scoreCol=self.getOrDefault("scoreCol"))


class TakeScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Turns a classifier's probability vector into ``scoreCol`` and drops the classifier's columns."""
    scoreCol = _param("scoreCol", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, scoreCol="prob"):
        super().__init__()
        self._setDefault(scoreCol="prob")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOrDefault("scoreCol"), vector_to_array("probability")[1]).drop(*SCRATCH)


class CombineScores(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``outputCol`` from the score columns.  ``weights`` are those of the models; for stacking
    ``coefficients`` are the meta-model's, intercept first."""
    scoreCols = _param("scoreCols", TypeConverters.toListString)
    method = _param("method", TypeConverters.toString)
    weights = _param("weights", TypeConverters.toListFloat)
    coefficients = _param("coefficients", TypeConverters.toListFloat)
    outputCol = _param("outputCol", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, scoreCols=None, method="averaging", weights=None, coefficients=None, outputCol="ensemble"):
        super().__init__()
        self._setDefault(method="averaging", outputCol="ensemble")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None

    def _transform(self, df: DataFrame) -> DataFrame:
        method = {"blending": "weighted"}.get(self.value("method"), self.value("method"))
        return EB.combine(df, self.value("scoreCols"), method,
                          self.value("coefficients") if method == "stacking" else self.value("weights"), self.value("outputCol"))


def _base(name: str, spec: Mapping, label: str, seed: int) -> Pipeline:
    """The estimator of a base model: ``spec`` has kind, features and the kind's parameters."""
    spec = dict(spec)
    kind, features = spec.pop("kind"), spec.pop("features")
    if kind == RIDGE:
        return Pipeline(stages=[RidgeLogistic(features=list(features), labelCol=label, scoreCol=f"p_{name}", **spec)])
    model = create_model(kind, features, label, seed=seed, **spec)
    return Pipeline(stages=[*model._pipeline().getStages(), TakeScore(scoreCol=f"p_{name}")])


class ChurnEnsemble(Estimator):
    """Fits base models ({name: {"kind", "features", ...}}) and their combination to a PipelineModel that
    adds ``p_<name>`` columns and ``ensemble``."""

    def __init__(self, bases: Mapping[str, Mapping], method: str = "averaging", id_col: str = "CustomerID", label: str = "label",
                 weights=None, folds: int = 5, metric: str = "auc", val_fraction: float = 0.2, seed: int = 42,
                 shuffle: str = "hash"):
        super().__init__()
        if method not in METHODS:
            raise ValueError(f"unknown ensemble method: {method}")
        if not bases:
            raise ValueError("an ensemble needs at least one base model")
        self.bases, self.ensemble_method, self.id_col, self.label = dict(bases), method, id_col, label
        self.model_weights, self.folds, self.metric = weights, folds, metric
        self.val_fraction, self.seed, self.shuffle = val_fraction, seed, shuffle

    @property
    def score_cols(self) -> list[str]:
        return [f"p_{b}" for b in self.bases]

    def _fit_bases(self, df: DataFrame, names=None) -> list:
        out = []
        for name in names or self.bases:
            out += _base(name, self.bases[name], self.label, self.seed).fit(df).stages
        return out

    def out_of_fold(self, df: DataFrame) -> DataFrame:
        """``df`` with ``fold`` and, in p_<name>, the scores of models that have not seen the row's fold
        (NULL where the other folds have one class)."""
        k = self.folds
        out = stored(stratified_kfold(df, self.id_col, self.label, k, self.seed, self.shuffle).where("fold IS NOT NULL"), "folds")
        ridge = [b for b, s in self.bases.items() if s["kind"] == RIDGE]
        other = [b for b in self.bases if b not in ridge]
        folded = out
        if other:
            parts = [PipelineModel(self._fit_bases(folded.where(F.col("fold") != f), other)).transform(folded.where(F.col("fold") == f))
                     for f in range(k)]
            out = reduce(DataFrame.unionByName, parts)
        if ridge:
            left_in = F.explode(F.filter(F.array(*map(F.lit, range(k))), lambda f: f != F.col("fold")))
            grouped = folded.withColumn("_held", left_in)
            for b in ridge:
                spec = self.bases[b]
                features = list(spec["features"])
                fits = irls.fit_groups(grouped, "_held", features, self.label, spec.get("ridge", 1.0))
                x = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features]
                names = [f"_b{i}" for i in range(len(features) + 1)]
                one = fits.select(F.col("_held").alias("fold"), *[F.col(n[1:]).alias(n) for n in names])
                out = (out.join(one, "fold", "left").withColumn(f"p_{b}", irls.logistic(irls.linear([F.col(n) for n in names], x)))
                       .drop(*names))
        return stored(out, "out-of-fold")

    def _fit(self, df: DataFrame) -> PipelineModel:
        cols, method = self.score_cols, self.ensemble_method
        features = list(dict.fromkeys(c for s in self.bases.values() for c in s["features"]))
        weights = list(dict.fromkeys(s["weight_col"] for s in self.bases.values() if s.get("weight_col")))
        df = stored(df.select(self.id_col, self.label, *features, *weights), "ensemble-rows")      # read by every fit
        last = CombineScores(scoreCols=cols, method=method)
        if method == "stacking":
            oof = self.out_of_fold(df).dropna(subset=cols)
            row = irls.fit_groups(oof, None, cols, self.label).first()
            if row is None:
                raise ValueError("no out-of-fold scores of both classes to fit the meta-model on")
            last._set(coefficients=[row[f"b{i}"] for i in range(len(cols) + 1)])
            stages = self._fit_bases(df)
        elif method == "blending":
            parts = stored(stratified_split(df, self.id_col, self.label, self.val_fraction, self.seed, shuffle=self.shuffle), "blend")
            stages = self._fit_bases(parts.where("split = 'train'").drop("split"))
            scored = stored(PipelineModel(stages).transform(parts.where("split = 'test'").drop("split")).select(self.label, *cols), "blend")
            best = EB.optimal_weights(scored, cols, self.label, self.metric).first()
            last._set(weights=[best[f"w_{c}"] for c in cols])
        else:
            last._set(weights=EB.normalize_weights(len(cols), self.model_weights))
            stages = self._fit_bases(df)
        return PipelineModel([*stages, last])


def contributions(model: PipelineModel, scored: DataFrame, detailed: bool = False) -> DataFrame:
    """B9 / B10 of a fitted ensemble over rows it has scored."""
    last = model.stages[-1]
    method = last.value("method")
    meta = last.value("coefficients")
    return EB.contributions(scored, last.value("scoreCols"), {"blending": "weighted"}.get(method, method), last.value("weights"),
                            detailed, meta)

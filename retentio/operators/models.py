"""Model fit / score through Spark ML (survey §2.8, M1-M13; L5, L6, L11-L13; V11, V18).

Every estimator is a Spark ML ``Pipeline`` (VectorAssembler -> optional
scaler -> classifier), so fitting is a distributed iteration and scoring is
one ``transform``.  Probabilities come out of the probability vector with
``vector_to_array`` (JVM-side, no Python UDF).
"""

from __future__ import annotations

import json
import re
import random
import time
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.operators.leafwise import LeafwiseBoosting, LeafwiseModel
from retentio.operators.network import NetworkClassifier, NetworkModel

# Default hyper-parameters of the reference's model families.
BOOSTING_XGB = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.8}
BOOSTING_LGBM = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "numLeaves": 31, "minChild": 20, "ridge": 1.0,
                 "featureShare": 0.8}
FOREST = {"numTrees": 100}
GRADIENT_BOOSTING = {"maxIter": 100, "maxDepth": 3}
NETWORK_HIDDEN = [64, 32, 16]
NETWORK = {"maxIter": 100, "dropout": 0.3}


@dataclass
class ChurnModel:
    """A fitted (or not yet fitted) classifier over named feature columns."""
    kind: str
    features: list[str]
    label: str = "label"
    params: dict = field(default_factory=dict)
    weight_col: str | None = None
    seed: int = 42
    model: PipelineModel | None = None
    history: list[dict] = field(default_factory=list)

    # ------------------------------------------------------------- M1-M8
    def _classifier(self):
        p = dict(self.params)
        common = {"featuresCol": "features", "labelCol": self.label}
        if self.kind == "lightgbm":
            kw = {**BOOSTING_LGBM, **p, **common, "seed": self.seed}
            if self.weight_col:
                kw["weightCol"] = self.weight_col
            return LeafwiseBoosting(**kw)
        if self.kind in ("xgboost", "gradient_boosting"):
            base = {"xgboost": BOOSTING_XGB, "gradient_boosting": GRADIENT_BOOSTING}[self.kind]
            kw = {**base, **p, **common, "seed": self.seed}
            if self.weight_col:
                kw["weightCol"] = self.weight_col
            return GBTClassifier(**kw)
        if self.kind == "random_forest":
            kw = {**FOREST, **p, **common, "seed": self.seed}
            if self.weight_col:
                kw["weightCol"] = self.weight_col
            return RandomForestClassifier(**kw)
        if self.kind == "logistic_regression":
            kw = {"maxIter": 100, **p, **common}
            if self.weight_col:
                kw["weightCol"] = self.weight_col
            return LogisticRegression(**kw)
        if self.kind == "neural_network":
            kw = {"hidden": NETWORK_HIDDEN, **NETWORK, **p, **common, "seed": self.seed}
            if self.weight_col:
                kw["weightCol"] = self.weight_col
            return NetworkClassifier(**kw)
        raise ValueError(f"unknown model kind: {self.kind}")

    def _pipeline(self) -> Pipeline:
        stages = [VectorAssembler(inputCols=self.features, outputCol="raw_features", handleInvalid="keep")]
        if self.kind in ("logistic_regression", "neural_network"):
            stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
        else:
            stages[0].setOutputCol("features")
        stages.append(self._classifier())
        return Pipeline(stages=stages)

    def fit(self, df: DataFrame) -> "ChurnModel":
        t0 = time.time()
        self.model = self._pipeline().fit(df)
        self.history.append({"event": "fit", "seconds": round(time.time() - t0, 3), "kind": self.kind,
                             "params": {k: v for k, v in self.params.items() if k != "hidden"}})
        return self

    # ------------------------------------------------------------- M9
    def _check(self):
        if self.model is None:
            raise ValueError("Model has not been fitted. Call fit() first.")

    def predict_proba(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        self._check()
        out = self.model.transform(df)
        return out.select(*keep, vector_to_array("probability")[1].alias("prob"))

    def predict(self, df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
        p = self.predict_proba(df, keep)
        return p.withColumn("pred", (F.col("prob") >= threshold).cast("int"))

    # ------------------------------------------------------------- L11 / L12
    def feature_importances(self) -> list[tuple[str, float]]:
        """Sorted (feature, importance); trees give gain-based importances."""
        self._check()
        clf = self.model.stages[-1]
        if not hasattr(clf, "featureImportances"):
            if hasattr(clf, "coefficients"):
                vals = [abs(float(v)) for v in clf.coefficients.toArray()]
            else:
                raise ValueError(f"feature importances are not available for {self.kind}")
        else:
            vals = [float(v) for v in clf.featureImportances.toArray()]
        return sorted(zip(self.features, vals), key=lambda t: -t[1])

    def split_counts(self) -> dict[str, int]:
        """L12 'weight' importance: number of splits on each feature across all trees."""
        self._check()
        clf = self.model.stages[-1]
        if isinstance(clf, LeafwiseModel):
            weight = clf.importances("weight")
            return {f: int(weight.get(i, 0)) for i, f in enumerate(self.features)}
        counts = {f: 0 for f in self.features}
        for tree in getattr(clf, "trees", []):
            for m in re.finditer(r"feature (\d+)", tree.toDebugString):
                counts[self.features[int(m.group(1))]] += 1
        # each split prints two branches (If / Else)
        return {k: v // 2 for k, v in counts.items()}

    def split_importances(self, kind: str = "gain") -> dict[str, float]:
        """L12 of the leaf-wise trees: 'weight', mean 'gain' or mean 'cover' of a feature's splits."""
        self._check()
        clf = self.model.stages[-1]
        if not isinstance(clf, LeafwiseModel):
            raise ValueError(f"{kind} of splits is not kept for {self.kind}")
        found = clf.importances(kind)
        return {f: found.get(i, 0.0) for i, f in enumerate(self.features)}

    def linear_form(self) -> tuple[list[float], list[float], list[float], float] | None:
        """(mean, scale, coefficients, intercept) of a two-class logistic regression, whose margin is
        ``sum((x - mean) * scale * coefficient) + intercept``; None for other kinds."""
        self._check()
        clf = self.model.stages[-1]
        if self.kind != "logistic_regression" or clf.coefficientMatrix.numRows != 1:
            return None
        scaler = self.model.stages[-2]
        scale = [1.0 / float(v) if v else 0.0 for v in scaler.std.toArray()]
        return ([float(v) for v in scaler.mean.toArray()], scale,
                [float(v) for v in clf.coefficients.toArray()], float(clf.intercept))

    # ------------------------------------------------------------- M13
    def training_curve(self, df: DataFrame | None = None) -> list[tuple[int, float]]:
        self._check()
        clf = self.model.stages[-1]
        if isinstance(clf, (LeafwiseModel, NetworkModel)):
            return [(k, train) for k, train, _ in clf.history()]
        if self.kind == "logistic_regression":
            return list(enumerate(clf.summary.objectiveHistory))
        if hasattr(clf, "evaluateEachIteration") and df is not None:
            feats = self.model.stages[0].transform(df)
            return list(enumerate(clf.evaluateEachIteration(feats)))
        if hasattr(clf, "summary") and hasattr(clf.summary, "objectiveHistory"):
            return list(enumerate(clf.summary.objectiveHistory))
        return []

    # ------------------------------------------------------------- M11
    def save(self, path: str) -> None:
        self._check()
        self.model.write().overwrite().save(f"{path}/pipeline")
        meta = {"kind": self.kind, "features": self.features, "label": self.label,
                "params": {k: v for k, v in self.params.items()}, "weight_col": self.weight_col,
                "seed": self.seed, "history": self.history}
        from pyspark.sql import SparkSession
        SparkSession.getActiveSession().createDataFrame([(json.dumps(meta),)], "meta string") \
            .coalesce(1).write.mode("overwrite").text(f"{path}/metadata")

    @staticmethod
    def load(path: str) -> "ChurnModel":
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        m = ChurnModel(meta["kind"], meta["features"], meta["label"], meta["params"], meta["weight_col"], meta["seed"])
        m.model = PipelineModel.load(f"{path}/pipeline")
        m.history = meta.get("history", [])
        return m


MODEL_KINDS = ["xgboost", "lightgbm", "random_forest", "logistic_regression", "gradient_boosting", "neural_network"]


def create_model(kind: str, features: Sequence[str], label: str = "label", **params) -> ChurnModel:
    """M8: model registry; an unknown kind raises ValueError."""
    if kind not in MODEL_KINDS:
        raise ValueError(f"Unsupported model type: {kind}")
    weight_col = params.pop("weight_col", None)
    seed = params.pop("seed", 42)
    return ChurnModel(kind, list(features), label, params, weight_col, seed)


# ----------------------------------------------------------------- M10 / V11


def tune(kind: str, df: DataFrame, features: Sequence[str], label: str, grid: dict[str, list],
         n_iter: int | None = 10, folds: int = 3, metric: str = "areaUnderROC", seed: int = 42,
         parallelism: int = 2) -> tuple[ChurnModel, list[tuple[dict, float]]]:
    """Random (``n_iter``) or full grid search with k-fold CrossValidator."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
    base = create_model(kind, features, label, seed=seed)
    pipe = base._pipeline()
    clf = pipe.getStages()[-1]
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(clf.getParam(name), values)
    maps = builder.build()
    if n_iter is not None and n_iter < len(maps):
        maps = random.Random(seed).sample(maps, n_iter)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=maps, numFolds=folds, seed=seed, parallelism=parallelism,
                        evaluator=BinaryClassificationEvaluator(labelCol=label, metricName=metric))
    cvm = cv.fit(df)
    results = [({p.name: v for p, v in m.items()}, float(s)) for m, s in zip(maps, cvm.avgMetrics)]
    best = max(results, key=lambda t: t[1])[0]
    model = create_model(kind, features, label, seed=seed, **best)
    model.model = cvm.bestModel
    return model, results


def cross_validate(kind: str, df: DataFrame, id_col: str, features: Sequence[str], label: str, k: int = 5,
                   seed: int = 42, resampling: str = "none", ratio: float = 1.0, shuffle: str = "hash",
                   **params) -> tuple[DataFrame, DataFrame]:
    """Stratified k folds; resampling applies to the training part only; a fold whose
    test part holds one class is skipped; returns per-fold metrics and mean / population std.

    Folds of a ridge logistic regression without resampling are fitted in one grouped IRLS, other kinds
    one after the other; the metrics of all folds come from one grouped pass over the scores."""
    from functools import reduce

    from retentio.operators import metrics as MT
    from retentio.operators.ensemble_ml import RIDGE, ChurnEnsemble
    from retentio.operators.sample import resample, stratified_kfold
    from retentio.session import stored
    if kind == RIDGE and resampling == "none":
        base = {"cv": {"kind": RIDGE, "features": list(features), **params}}
        scored = (ChurnEnsemble(base, id_col=id_col, label=label, folds=k, seed=seed, shuffle=shuffle).out_of_fold(df)
                  .where("p_cv IS NOT NULL").select("fold", F.col(label).alias("label"), F.col("p_cv").alias("prob")))
    else:
        folded = stored(stratified_kfold(df, id_col, label, k, seed, shuffle), "folds")               # reused by 2k jobs
        parts = []
        for f in range(k):
            train = resample(folded.where(F.col("fold") != f).drop("fold"), id_col, label, features, resampling, ratio, seed)
            m = create_model(kind, features, label, seed=seed, **params).fit(train)
            parts.append(m.predict_proba(folded.where(F.col("fold") == f), keep=["fold", label]).withColumnRenamed(label, "label"))
        scored = reduce(DataFrame.unionByName, parts)
    scored = stored(scored, "fold-scores")
    both = scored.groupBy("fold").agg(F.count_distinct("label").alias("_classes")).where("_classes = 2").select("fold")
    scored = scored.join(both, "fold", "left_semi")                   # one row per fold
    cls = MT.classification_metrics(scored, model="fold").select("fold", "accuracy", "precision", "recall", "f1")
    per = cls.join(MT.roc_auc(scored, model="fold").select("fold", "roc_auc"), "fold")
    per = per.select(F.col("fold").cast("int").alias("fold"), "accuracy", "precision", "recall", "f1", "roc_auc")
    summary = per.agg(*[x for c in ["accuracy", "precision", "recall", "f1", "roc_auc"]
                        for x in (F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std"))])
    return per, summary


# ----------------------------------------------------------------- L5 / L6 / L13 / L14


def select_model_based(df: DataFrame, features: Sequence[str], label: str, k: int = 20, seed: int = 42) -> list[str]:
    """Top-k features by random-forest importance (100 trees)."""
    m = create_model("random_forest", features, label, seed=seed).fit(df)
    return [f for f, _ in m.feature_importances()[:k]]


def select_from_model(df: DataFrame, features: Sequence[str], label: str, threshold="mean", seed: int = 42) -> list[str]:
    """Keep features whose importance >= mean / median / a number."""
    imp = create_model("random_forest", features, label, seed=seed).fit(df).feature_importances()
    vals = sorted(v for _, v in imp)
    if threshold == "mean":
        thr = sum(vals) / len(vals)
    elif threshold == "median":
        n = len(vals)
        thr = vals[n // 2] if n % 2 else (vals[n // 2 - 1] + vals[n // 2]) / 2
    else:
        thr = float(threshold)
    return [f for f in features if dict(imp)[f] >= thr]


def permutation_importance(model: ChurnModel, df: DataFrame, id_col: str, label: str, n_repeats: int = 5,
                           seed: int = 42) -> DataFrame:
    """AUC drop when one feature's values are permuted across rows.

    Per repeat, one permutation pairs each row's position in id order with the
    row at the same position in a seeded hash order (exact ranks from the
    slice-wise ``row_index``, all repeats in one pass).  Every (repeat, feature)
    variant of a row is scored with only that feature taken from the donor row,
    and reduced to distinct scores before anything is shuffled.  A logistic
    regression's variants are scored in NumPy, a batch of pairs at a time; other
    kinds send every variant through the fitted pipeline.
    """
    from retentio.operators import metrics as MT
    from retentio.plans.ordering import row_index
    base = MT.roc_auc(model.predict_proba(df, keep=[label]).withColumnRenamed(label, "label")).first()[0]
    feats = list(model.features)
    by_id = row_index(df.select(id_col, label, *feats), [id_col], name="_pos")
    repeats = F.explode(F.sequence(F.lit(0), F.lit(n_repeats - 1))).alias("_rep")
    shuffled = df.select(id_col, *feats, repeats).withColumn("_k", F.xxhash64(F.col(id_col), F.col("_rep") + F.lit(seed)))
    donor = row_index(shuffled, ["_k", id_col], ["_rep"], name="_pos") \
        .select("_pos", "_rep", *[F.col(f).alias(f"_d_{f}") for f in feats])
    pairs = by_id.join(donor, "_pos")
    scalar = all(isinstance(df.schema[f].dataType, (T.NumericType, T.BooleanType)) for f in feats)
    form = model.linear_form() if scalar else None
    counts = _linear_counts(pairs, feats, label, form) if form else _variant_counts(model, pairs, feats, label)
    auc = MT.auc_of_counts(counts, ["_variant"])                # one row per feature and repeat
    drop = F.lit(None if base is None else float(base)).cast("double") - F.col("roc_auc")
    name = F.element_at(F.array(*map(F.lit, feats)), F.col("_variant") % len(feats) + 1)
    return (auc.groupBy(name.alias("feature"))
            .agg(F.avg(drop).alias("importance_mean"), F.stddev_pop(drop).alias("importance_std")))


def _variant_counts(model: ChurnModel, pairs: DataFrame, feats: Sequence[str], label: str) -> DataFrame:
    """Score counts of every variant (repeat x features + feature), each row through the model's pipeline."""
    from retentio.operators import metrics as MT
    from retentio.session import cut_lineage
    tag = F.explode(F.array(*[F.lit(j) for j in range(len(feats))])).alias("_f")
    variants = cut_lineage(pairs).select("*", tag).select(
        F.col(label).alias("_label"), (F.col("_rep") * len(feats) + F.col("_f")).alias("_variant"), *[
            F.when(F.col("_f") == j, F.col(f"_d_{f}")).otherwise(F.col(f)).alias(f) for j, f in enumerate(feats)])
    return MT.score_counts(model.predict_proba(variants, keep=["_variant", "_label"]), "_label", model="_variant")


def _linear_counts(pairs: DataFrame, feats: Sequence[str], label: str, form: tuple) -> DataFrame:
    """``_variant_counts`` of a logistic regression.

    A variant's margin is the sum of the terms before its feature, the donor's term and the terms after
    it, so one pair costs two running sums for all its variants.  For a given feature the sum depends on
    the variant's values alone: rows with equal values tie, whoever their donor is."""
    mean, scale, coef, intercept = form
    k = len(feats)

    def count(batches):
        for b in batches:
            def terms(prefix):
                x = np.column_stack([b.column(f"{prefix}{j}").to_numpy(zero_copy_only=False) for j in range(k)])
                return (x - mean) * scale * coef

            if not b.num_rows:
                continue
            pos, neg, rep = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_pos", "_neg", "_rep"))
            with np.errstate(over="ignore", invalid="ignore"):
                own, donor = terms("_x"), terms("_d")
                before, after = np.zeros_like(own), np.zeros_like(own)
                np.cumsum(own[:, :-1], axis=1, out=before[:, 1:])
                after[:, :-1] = np.cumsum(own[:, :0:-1], axis=1)[:, ::-1]
                score = 1.0 - 1.0 / (1.0 + np.exp(before + donor + after + intercept))
            out = []
            for r in np.unique(rep).tolist():
                at = np.flatnonzero(rep == r)
                for j in range(k):
                    value, inverse = np.unique(score[at, j], return_inverse=True)
                    out.append((r * k + j, value, *(np.bincount(inverse, y[at], len(value)) for y in (pos, neg))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([v[0] for v in out], [len(v[1]) for v in out]), pa.int32()),
                 pa.array(np.concatenate([v[1] for v in out]), pa.float64()),
                 *[pa.array(np.concatenate([v[i] for v in out]).astype(np.int64)) for i in (2, 3)]],
                names=["_variant", "score", "pos", "neg"])

    def values(prefix, names):                    # a missing value scores NaN, as the assembler keeps it
        return [F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))).alias(f"{prefix}{j}") for j, c in enumerate(names)]

    y = F.col(label) == 1
    given = pairs.select("_rep", F.coalesce(y, F.lit(False)).alias("_pos"), F.coalesce(~y, F.lit(False)).alias("_neg"),
                         *values("_x", feats), *values("_d", [f"_d_{f}" for f in feats]))
    return (given.mapInArrow(count, "_variant int, score double, pos long, neg long")
            .groupBy("_variant", "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def importance_origin(importances: Sequence[tuple[str, float]], engineered: Sequence[str], top: int = 20) -> dict:
    """Share of original vs engineered features among the top-n importances."""
    head = [f for f, _ in list(importances)[:top]]
    eng = sum(1 for f in head if f in set(engineered))
    return {"engineered": eng, "original": len(head) - eng, "engineered_share": eng / len(head) if head else 0.0}


# ----------------------------------------------------------------- M12


def append_run_log(spark, path: str, record: dict) -> None:
    """Append one training-run record (time, metrics, threshold, cv) to a Parquet log."""
    spark.createDataFrame([(time.strftime("%Y-%m-%dT%H:%M:%S"), json.dumps(record, default=str))],
                          "ts string, record string").write.mode("append").parquet(path)

"""End-to-end workflows (survey §2.12, W1-W7) composed from the operators.

Each step is either a fit (a column-bounded aggregate) or a lazy projection,
so a whole workflow on a table is a handful of aggregation jobs followed by
one chained projection that Catalyst collapses.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retentio.operators import clean as CL
from retentio.operators import encode as EN
from retentio.operators import features as FE
from retentio.operators import fitted as FT
from retentio.operators import metrics as MT
from retentio.operators import models as MD
from retentio.operators import sample as SA
from retentio.operators import select as SE
from retentio.roles import CHURN_ROLES, ColumnRoles
from retentio.session import cut_lineage, stored


# ----------------------------------------------------------------- W1


@dataclass
class PreprocessConfig:
    missing_threshold: float = 0.7
    outlier_treatment: str = "clip"
    outlier_threshold: float = 3.0
    categorical_encoding: str = "one-hot"
    numerical_scaling: str = "standard"
    create_feature_groups: bool = True


@dataclass
class Preprocessor:
    """Drop sparse -> impute (median / mode) -> outliers (train only) -> F1-F6
    -> binary + one-hot / label encoding -> scaling -> target map.  ``fit_transform``
    fits every state on train; ``transform`` replays it on holdout."""
    roles: ColumnRoles = CHURN_ROLES
    config: PreprocessConfig = field(default_factory=PreprocessConfig)
    state: dict = field(default_factory=dict)

    def _numeric(self, df):
        return [c for c in self.roles.numeric if c in df.columns]

    def _coerce(self, df):
        return CL.coerce_numeric(df, [c for c in self.roles.discrete if c in df.columns])

    def fit_transform(self, df: DataFrame) -> DataFrame:
        cfg, st = self.config, self.state
        df = self._coerce(df)
        st["drop"] = CL.fit_drop_sparse(df, cfg.missing_threshold)
        df = st["drop"].transform(df)
        st["median"] = CL.fit_median_imputer(df, self._numeric(df))
        st["mode"] = CL.fit_mode_imputer(df, [c for c in self.roles.strings if c in df.columns])
        df = st["mode"].transform(st["median"].transform(df))
        df = CL.handle_outliers(df, [c for c in self.roles.continuous if c in df.columns],
                                cfg.outlier_treatment, cfg.outlier_threshold, is_train=True)
        # the encoder and scaler fits below read a stored table, not the cleaning chain
        df = cut_lineage(df)
        return self._encode_scale(df, fit=True)

    def transform(self, df: DataFrame) -> DataFrame:
        st = self.state
        df = st["drop"].transform(self._coerce(df))
        num = self._numeric(df)
        df = st["mode"].transform(st["median"].transform(df, fallback=num),
                                  fallback=[c for c in self.roles.strings if c in df.columns])
        return self._encode_scale(df, fit=False)

    def model(self) -> PipelineModel:
        """The fitted state as a pipeline that can be saved, loaded and run on a stream."""
        return FT.pipeline_of(self.state, self.roles)

    def _encode_scale(self, df: DataFrame, fit: bool) -> DataFrame:
        cfg, st = self.config, self.state
        if cfg.create_feature_groups:
            if fit:
                st["grouped"] = FE.grouped_features(df)
            df = FE.add_features(df, names=FE.available(df, st["grouped"]))
        bins = [c for c in self.roles.binary if c in df.columns]
        cats = [c for c in self.roles.categorical if c in df.columns]
        if fit:
            st["binary"] = EN.fit_binary_encoder(df, bins)
            st["categorical"] = (EN.fit_one_hot(df, cats) if cfg.categorical_encoding == "one-hot"
                                 else EN.fit_label_encoder(df, cats))
        df = st["binary"].transform(df)
        df = st["categorical"].transform(df)
        num = [c for c in self._numeric(df)]
        if cfg.numerical_scaling != "none":
            if fit:
                _, st["scaler"] = EN.scale(df, num, {"standard": "standard", "minmax": "minmax",
                                                    "robust": "robust"}[cfg.numerical_scaling])
            df = st["scaler"].transform(df)
        if self.roles.target in df.columns:
            df = CL.map_target(df, self.roles.target)
        return df


# ----------------------------------------------------------------- W2


@dataclass
class FeatureEngineer:
    """F7-F55 -> correlation drop (L1) -> univariate selection (L2); the kept
    column list is frozen at fit and replayed on holdout."""
    roles: ColumnRoles = CHURN_ROLES
    corr_threshold: float = 0.85
    k: int = 30
    selected: list[str] = field(default_factory=list)

    def fit_transform(self, df: DataFrame, label: str = "label") -> DataFrame:
        feats = FE.add_features(df)
        numeric = [c for c, t in feats.dtypes if t in ("double", "int", "bigint") and c not in (self.roles.id, label)]
        filled = feats.fillna(0.0, numeric)
        kept = SE.kept_after_correlation(filled, numeric, self.corr_threshold)
        ranked = SE.select_k_best(filled, kept, label, k=self.k).where("selected").collect()   # one row per feature
        self.selected = [r["feature"] for r in sorted(ranked, key=lambda r: r["rank"])]
        return feats.select(self.roles.id, label, *self.selected)

    def transform(self, df: DataFrame, label: str = "label") -> DataFrame:
        feats = FE.add_features(df)
        cols = [self.roles.id] + ([label] if label in feats.columns else [])
        return CL.align_features(feats, cols + self.selected)


# ----------------------------------------------------------------- W3


def prepare_data(df: DataFrame, roles: ColumnRoles = CHURN_ROLES, test_frac: float = 0.2, seed: int = 42,
                 out_path: str | None = None, shuffle: str = "hash") -> DataFrame:
    """Target map -> strict Yes/No columns to 0/1 -> one-hot the rest -> stratified
    split -> (optional) one Parquet written partitioned by ``split`` (S8)."""
    df = CL.map_target(df, roles.target, "label").where(F.col("label").isNotNull())
    strings = [c for c, t in df.dtypes if t == "string" and c not in (roles.id, roles.target)]
    strict = EN.strict_binary_columns(df, strings)
    df = df.select(*[F.when(F.col(c) == "Yes", 1).when(F.col(c) == "No", 0).alias(c) if c in strict else F.col(c)
                     for c in df.columns])
    rest = [c for c in strings if c not in strict]
    df = EN.fit_one_hot(df, rest).transform(df)      # a wide column becomes one sparse vector
    out = SA.stratified_split(df, roles.id, "label", test_frac, seed, shuffle=shuffle)
    if out_path:
        out.write.mode("overwrite").partitionBy("split").parquet(out_path)
    return out


# ----------------------------------------------------------------- W4 / W6 / W7


def training_run(train: DataFrame, test: DataFrame, id_col: str, features: Sequence[str], kind: str = "random_forest",
                 resampling: str = "none", ratio: float = 1.0, threshold_metric: str = "f1", seed: int = 42,
                 val_fraction: float = 0.2, grid: dict[str, list] | None = None, n_iter: int = 10, cv_folds: int = 0,
                 out_path: str | None = None, **params) -> dict:
    """Set a validation part of ``train`` aside -> resample the rest -> fit, or tune over ``grid`` -> threshold
    that is best on the validation part -> metrics of ``test`` at 0.5 and at that threshold, curves, importances.
    ``cv_folds`` adds cross-validation over ``train``; with ``out_path`` the model, the scores of ``test`` and one
    line of the run log are saved there."""
    parts = stored(SA.stratified_split(train.select(id_col, "label", *features), id_col, "label", val_fraction, seed), "run")
    fit_rows = SA.resample(parts.where("split = 'train'").drop("split"), id_col, "label", features, resampling, ratio, seed)
    tried = []
    if grid:
        model, tried = MD.tune(kind, stored(fit_rows, "run"), features, "label", grid, n_iter, seed=seed)
    else:
        model = MD.create_model(kind, features, "label", seed=seed, **params).fit(fit_rows)
    held = model.predict_proba(parts.where("split = 'test'"), keep=[id_col, "label"])
    best = MT.best_threshold(held, threshold_metric).first()
    scored = stored(model.predict_proba(test, keep=[id_col, "label"]), "run-scores")       # read by every metric
    base = MT.classification_metrics(scored, threshold=0.5)
    tuned = MT.classification_metrics(scored, threshold=best["threshold"])
    auc = MT.roc_auc(scored)
    out = {"model": model, "scored": scored, "metrics": base, "threshold": best["threshold"], "tuned_metrics": tuned,
           "tuning": tried, "roc_auc": auc, "roc_curve": MT.roc_curve(scored), "pr_curve": MT.pr_curve(scored),
           "importances": model.feature_importances() if kind != "neural_network" else []}
    if cv_folds:
        out["cv"], out["cv_summary"] = MD.cross_validate(kind, train, id_col, features, "label", cv_folds, seed, resampling,
                                                         ratio, **params)
    if out_path:
        model.save(f"{out_path}/model")
        scored.write.mode("overwrite").parquet(f"{out_path}/scores")
        record = {"kind": kind, "resampling": resampling, "threshold": best["threshold"], "metrics": base.first().asDict(),
                  "tuned_metrics": tuned.first().asDict(), "roc_auc": auc.first()[0], "tuning": tried,
                  "cv": out["cv_summary"].first().asDict() if cv_folds else None}
        MD.append_run_log(train.sparkSession, f"{out_path}/runs", record)
    return out


def compare_original_vs_engineered(train: DataFrame, test: DataFrame, id_col: str, original: Sequence[str],
                                   engineered: Sequence[str], seed: int = 42) -> DataFrame:
    """The same random forest on the original and on original + engineered
    features, metrics side by side with absolute and percent improvement (V14)."""
    scored = None
    for name, feats in (("original", list(original)), ("engineered", list(original) + list(engineered))):
        m = MD.create_model("random_forest", feats, "label", seed=seed).fit(train)
        p = m.predict_proba(test, keep=[id_col, "label"]).withColumnRenamed("prob", name)
        scored = p if scored is None else scored.join(p.drop("label"), id_col)
    return MT.improvement_table(scored.withColumnRenamed(id_col, "id"), "original", "engineered")


# Fixed value: the deployment notebook's hand-set operating threshold.
DEPLOYMENT_THRESHOLD = 0.38


def score_holdout(model: MD.ChurnModel, holdout: DataFrame, id_col: str,
                  threshold: float = DEPLOYMENT_THRESHOLD) -> DataFrame:
    """Align holdout to the model's features, score, threshold -> (id, prob, pred)."""
    aligned = CL.align_features(holdout, [id_col, *model.features], fill=0.0)
    scored = model.predict_proba(aligned, keep=[id_col])
    return scored.select(F.col(id_col).alias("customer_id"), F.col("prob").alias("churn_probability"),
                         (F.col("prob") >= threshold).cast("int").alias("predicted_churn"))


def deployment_batch(model: MD.ChurnModel | str, holdout: DataFrame, id_col: str, out_path: str | None = None,
                     threshold: float = DEPLOYMENT_THRESHOLD, top: int = 20) -> dict:
    """Load (``model`` may be the folder of a saved one) -> score -> report (when labels exist) -> top-k risk ->
    importances -> write predictions (S9)."""
    if isinstance(model, str):
        model = MD.ChurnModel.load(model)
    preds = score_holdout(model, holdout, id_col, threshold)
    out = {"predictions": preds, "top_risk": MT.top_risk(preds, "churn_probability", top, "customer_id"),
           "importances": model.feature_importances() if model.kind != "neural_network" else []}
    if "label" in holdout.columns:
        j = preds.join(holdout.select(F.col(id_col).alias("customer_id"), "label"), "customer_id")
        out["report"] = MT.classification_report(j.withColumnRenamed("churn_probability", "prob"), threshold=threshold)
    if out_path:
        preds.write.mode("overwrite").parquet(out_path)
    return out


def first_look_importance(raw: DataFrame, roles: ColumnRoles = CHURN_ROLES, seed: int = 42) -> list[tuple[str, float]]:
    """Target map -> numeric coercion -> median impute -> label-encode strings ->
    standard scale -> random forest (100 trees, depth 5, balanced) -> importances."""
    df = CL.map_target(raw, roles.target, "label").where(F.col("label").isNotNull())
    num = [c for c in roles.numeric if c in df.columns]
    df = CL.coerce_numeric(df, num)
    df = CL.fit_median_imputer(df, num).transform(df)
    strings = [c for c in roles.strings if c in df.columns]
    df = EN.fit_label_encoder(df, strings).transform(df, unknown="none")
    df = EN.fit_standard_scaler(df, num).transform(df)
    df = SA.with_weight_column(df, "label")
    feats = num + strings
    model = MD.create_model("random_forest", feats, "label", seed=seed, maxDepth=5, weight_col="weight").fit(df)
    return model.feature_importances()


# ----------------------------------------------------------------- S10


def process_and_save(spark, train_path: str, holdout_path: str, out_dir: str,
                     config: PreprocessConfig | None = None, roles: ColumnRoles = CHURN_ROLES) -> Preprocessor:
    """Load train + holdout, fit the preprocessor on train, replay it on holdout
    (holdout columns aligned to train's), write both as Parquet and the fitted pipeline under ``out_dir``."""
    from retentio.sources import io as IO
    train, holdout = IO.load_pair(spark, train_path, holdout_path)
    pre = Preprocessor(roles, config or PreprocessConfig())
    t = pre.fit_transform(train)
    h = pre.transform(holdout)
    h = CL.align_features(h, [c for c in t.columns if c != roles.target or c in h.columns], fill=0.0)
    IO.save(t, f"{out_dir}/train_processed.parquet")
    IO.save(h, f"{out_dir}/holdout_processed.parquet")
    pre.model().write().overwrite().save(f"{out_dir}/preprocessor")
    return pre

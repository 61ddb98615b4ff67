"""Query registry: one callable per operator, ``(spark, sf_dir) -> DataFrame``.

Every query reads the supplied tables (through the data bridge) so its work
grows with them; computed doubles are rounded to six places, matching the
SQL oracles in ``retentio.plans.oracles``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retentio.functions.expr import rnd
from retentio.operators import features as FE
from retentio.session import stored
from retentio.sources.mart import customer_mart, mart_table, scored_table, usage_series

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def round_doubles(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[rnd(F.col(f.name), places).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def mart(spark, sf):
    return mart_table(spark, sf)


def raw_mart(spark, sf):
    return mart_table(spark, sf, raw=True)


def raw_numeric(spark, sf):
    """The raw mart with its text columns of numbers coerced."""
    return CL.coerce_numeric(raw_mart(spark, sf), ROLES.discrete)


# --------------------------------------------------------------------------- bridge
@query("s03_customer_mart")
def q_customer_mart(spark, sf):
    return customer_mart(spark, sf)


@query("s03_customer_mart_raw")
def q_customer_mart_raw(spark, sf):
    return customer_mart(spark, sf, raw=True)


@query("s03_scored_table")
def q_scored(spark, sf):
    return scored_table(spark, sf)


@query("s03_usage_series")
def q_usage(spark, sf):
    return usage_series(spark, sf).drop("day")


# --------------------------------------------------------------------------- features
def _family_query(family: str, variant: str = "fe"):
    def run(spark, sf):
        m = mart(spark, sf)
        names = FE.family_members(family)
        return round_doubles(m.select("CustomerID", *FE.feature_columns(m, names, variant)))
    return run


for _fam in FE.FAMILIES:
    QUERIES[f"f_features_{_fam}"] = _family_query(_fam)


@query("f_features_variants")
def q_feature_variants(spark, sf):
    m = mart(spark, sf)
    names = list(FE.VARIANTS)
    return round_doubles(m.select("CustomerID", *FE.feature_columns(m, names, variant="cut")))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Risk scores (F47-F50) -> churn rate by tenure bucket."""
    m = mart(spark, sf)
    feats = m.select("Churn", *FE.feature_columns(m, ["TenureBucket", "ChurnRiskScore"]))
    label = F.when(F.col("Churn") == "Yes", 1.0).otherwise(0.0)
    return (feats.groupBy("TenureBucket")
            .agg(rnd(F.avg(label) * 100).alias("churn_rate_pct"),
                 F.count("*").alias("n_customers"),
                 rnd(F.avg("ChurnRiskScore")).alias("avg_risk_score"))
            .orderBy(F.desc("churn_rate_pct"), "TenureBucket"))


QUERIES["flagship_churn_by_tenure"] = flagship


# --------------------------------------------------------------------------- profiling
from retentio.operators import profile as PR  # noqa: E402
from retentio.roles import CHURN_ROLES as ROLES  # noqa: E402

NULLABLE = ["CreditRating", "MaritalStatus", "ChildrenInHH", "MonthlyRevenue", "TotalRecurringCharge",
            "PercChangeMinutes", "PercChangeRevenues", "DroppedCalls", "CustomerCareCalls", "AgeHH1",
            "RetentionCalls", "Churn"]
DUP_COLS = ["ServiceArea", "CreditRating", "PrizmCode", "Occupation", "MaritalStatus", "ChildrenInHH"]
FEATURE_NUMERIC = list(ROLES.continuous) + list(ROLES.discrete)


@query("p01_missing_summary")
def q_p01(spark, sf):
    return PR.missing_summary(raw_mart(spark, sf))


@query("p02_nullity_correlation")
def q_p02(spark, sf):
    return PR.nullity_correlation(raw_mart(spark, sf), NULLABLE)


@query("p03_duplicate_rows")
def q_p03(spark, sf):
    return PR.duplicate_rows(raw_mart(spark, sf), DUP_COLS)


@query("p04_duplicate_keys")
def q_p04(spark, sf):
    return PR.duplicate_keys(spark.read.parquet(f"{sf}/orders.parquet"), "o_custkey")


@query("p06_describe_numeric")
def q_p06(spark, sf):
    return PR.describe_numeric(raw_numeric(spark, sf), list(ROLES.numeric))


@query("p07_top_values")
def q_p07(spark, sf):
    return PR.top_values(mart(spark, sf), "ServiceArea", 10)


@query("p08_value_counts")
def q_p08(spark, sf):
    return PR.value_counts(raw_mart(spark, sf), "CreditRating")


@query("p09_histogram")
def q_p09(spark, sf):
    return PR.histogram(mart(spark, sf), "MonthlyRevenue", 30)


@query("p10_box_stats")
def q_p10(spark, sf):
    return PR.box_stats(mart(spark, sf), "MonthlyRevenue", by="Churn")


@query("p11_target_distribution")
def q_p11(spark, sf):
    return PR.target_distribution(mart(spark, sf), "Churn")


@query("p12_rate_by_category")
def q_p12(spark, sf):
    return PR.rate_by_category(mart(spark, sf), "PrizmCode", "Churn")


@query("p13_correlation_matrix")
def q_p13(spark, sf):
    return PR.correlation_matrix(raw_numeric(spark, sf), list(ROLES.numeric))


def _labelled(spark, sf):
    m = mart(spark, sf)
    return m.withColumn("label", F.when(F.col("Churn") == "Yes", 1).otherwise(0))


@query("p14_top_target_correlations")
def q_p14(spark, sf):
    return PR.top_target_correlations(_labelled(spark, sf), FEATURE_NUMERIC, "label", 10)


@query("p15_correlated_pairs")
def q_p15(spark, sf):
    return PR.correlated_pairs(mart(spark, sf), FEATURE_NUMERIC, 0.7)


@query("p16_iqr_outlier_summary")
def q_p16(spark, sf):
    return PR.iqr_outlier_summary(raw_numeric(spark, sf), list(ROLES.numeric))


@query("p17_non_numeric_audit")
def q_p17(spark, sf):
    return PR.non_numeric_audit(raw_mart(spark, sf), list(ROLES.discrete))


@query("p18_density")
def q_p18(spark, sf):
    return PR.density(scored_table(spark, sf), "p1", by="label", grid=100)


@query("v09_score_histogram")
def q_v09(spark, sf):
    return PR.histogram(scored_table(spark, sf), "p1", bins=20, by="label")


# --------------------------------------------------------------------------- cleaning
from retentio.operators import clean as CL  # noqa: E402
from retentio.operators import encode as EN  # noqa: E402

CONT = list(ROLES.continuous)
CATS = list(ROLES.categorical)
BINS = list(ROLES.binary)


@query("c01_coerce_numeric")
def q_c01(spark, sf):
    r = raw_mart(spark, sf)
    return CL.coerce_numeric(r, ROLES.discrete).select("CustomerID", *ROLES.discrete)


@query("c02_sparse_columns")
def q_c02(spark, sf):
    return CL.sparse_decision_table(raw_mart(spark, sf), 0.7)


#: the customers that imputers are fitted on; they are replayed on all
FIT_ROWS = "(CustomerID * 7919) % 1009 < 700"


@query("c03_impute_median")
def q_c03(spark, sf):
    r = raw_numeric(spark, sf).select("CustomerID", *FEATURE_NUMERIC)
    return round_doubles(CL.fit_median_imputer(r.where(FIT_ROWS), FEATURE_NUMERIC).transform(r))


@query("c05_impute_mode")
def q_c05(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *CATS, *BINS)
    return CL.fit_mode_imputer(r.where(FIT_ROWS), CATS + BINS).transform(r)


@query("c06_impute_self")
def q_c06(spark, sf):
    r = raw_numeric(spark, sf).select("CustomerID", *FEATURE_NUMERIC, *CATS, *BINS)
    return round_doubles(CL.impute_self(r, FEATURE_NUMERIC, CATS + BINS))


@query("c07_second_pass_impute")
def q_c07(spark, sf):
    r = raw_numeric(spark, sf).select("CustomerID", *FEATURE_NUMERIC, *CATS, *BINS)
    return round_doubles(CL.second_pass(r, r.where(FIT_ROWS), FEATURE_NUMERIC, CATS + BINS))


@query("c08_outlier_clip")
def q_c08(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *CONT)
    return round_doubles(CL.fit_outlier_clip(r, CONT, 3.0).transform(r))


@query("c09_outlier_remove")
def q_c09(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *CONT)
    return CL.remove_outliers(r, CONT, 3.0).select("CustomerID")


@query("c10_outlier_impute")
def q_c10(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *CONT)
    return round_doubles(CL.fit_outlier_impute(r, CONT, 3.0).transform(r))


ALIGN_TRAIN_COLUMNS = sorted(c for c in ["CustomerID", "Churn", "MonthlyRevenue", "AgeHH1", "AgeHH2", "PrizmCode"])


@query("c12_align_features")
def q_c12(spark, sf):
    holdout = raw_mart(spark, sf).drop("AgeHH2").withColumn("ExtraColumn", F.lit(1))
    return CL.align_features(holdout, ALIGN_TRAIN_COLUMNS, fill=0)


@query("c13_target_map")
def q_c13(spark, sf):
    return CL.map_target(raw_mart(spark, sf).select("CustomerID", "Churn"), "Churn")


# --------------------------------------------------------------------------- encoding
@query("e01_encode_binary")
def q_e01(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *BINS)
    return EN.fit_binary_encoder(r, BINS).transform(r)


@query("e03_strict_binary")
def q_e03(spark, sf):
    r = raw_mart(spark, sf)
    strict = set(EN.strict_binary_columns(r, CATS + BINS))
    rows = [(c, c in strict) for c in CATS + BINS]
    # the decision above is one distributed aggregate; this frame only reports it
    return spark.createDataFrame(rows, "column string, is_strict_binary boolean")


@query("e04_label_encode")
def q_e04(spark, sf):
    r = raw_mart(spark, sf).select("CustomerID", *CATS)
    return EN.fit_label_encoder(r, CATS).transform(r, unknown="mode")


@query("e04_label_encode_wide_holdout")
def q_e04_wide(spark, sf):
    """A key column with thousands of values, fitted on early lines and replayed on all
    (later keys are unknown: code of the most frequent key)."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("key"), "l_shipdate")
    enc = EN.fit_label_encoder(li.where("l_shipdate < timestamp '1997-01-01'"), ["key"])
    return enc.transform(li.drop("l_shipdate"))


ONE_HOT_COLS = ["ServiceArea", "CreditRating", "PrizmCode", "Occupation", "MaritalStatus"]


@query("e06_one_hot")
def q_e06(spark, sf):
    m = mart(spark, sf).select("CustomerID", *ONE_HOT_COLS)
    return EN.fit_one_hot(m, ONE_HOT_COLS).transform(m)


@query("e07_dummies_drop_first")
def q_e07(spark, sf):
    m = mart(spark, sf).select("CustomerID", *ONE_HOT_COLS)
    return EN.fit_one_hot(m, ONE_HOT_COLS, drop_first=True).transform(m)


@query("e06_one_hot_wide")
def q_e06_wide(spark, sf):
    """A key column with thousands of values as one sparse vector, fitted on early lines (later keys: all zeros)."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("key"), "l_shipdate")
    enc = EN.fit_one_hot(li.where("l_shipdate < timestamp '1997-01-01'"), ["key"])
    vector = F.unwrap_udt("key_onehot")
    return enc.transform(li.drop("l_shipdate")).select(
        "l_orderkey", "l_linenumber", vector["size"].alias("size"), F.size(vector["indices"]).alias("non_zeros"),
        F.get(vector["indices"], F.lit(0)).alias("place"), F.get(vector["values"], F.lit(0)).alias("value"))


@query("e08_scale_standard")
def q_e08(spark, sf):
    m = mart(spark, sf).select("CustomerID", *FEATURE_NUMERIC)
    return round_doubles(EN.fit_standard_scaler(m, FEATURE_NUMERIC).transform(m))


@query("e09_scale_minmax")
def q_e09(spark, sf):
    m = mart(spark, sf).select("CustomerID", *FEATURE_NUMERIC)
    return round_doubles(EN.fit_minmax_scaler(m, FEATURE_NUMERIC).transform(m))


@query("e10_scale_robust")
def q_e10(spark, sf):
    m = mart(spark, sf).select("CustomerID", *FEATURE_NUMERIC)
    return round_doubles(EN.fit_robust_scaler(m, FEATURE_NUMERIC).transform(m))


@query("e12_prepare_for_model")
def q_e12(spark, sf):
    out, _ = EN.prepare_for_model(mart(spark, sf), "CustomerID", "Churn")
    return out


# --------------------------------------------------------------------------- metrics
from retentio.operators import blend_optimiser as BO  # noqa: E402
from retentio.operators import ensemble as EB  # noqa: E402
from retentio.operators import metrics as MT  # noqa: E402

MODELS = ["p1", "p2", "p3"]


def scored1(spark, sf, model="p1"):
    """Single-model view of the scored table: id, label, prob."""
    return scored_table(spark, sf).select("id", "label", F.col(model).alias("prob"))


@query("v01_confusion_matrix")
def q_v01(spark, sf):
    return MT.confusion_counts(scored1(spark, sf), threshold=0.5)


@query("v02_classification_metrics")
def q_v02(spark, sf):
    return MT.classification_metrics(scored1(spark, sf), threshold=0.5)


@query("v03_roc_auc")
def q_v03(spark, sf):
    return MT.roc_auc(scored1(spark, sf))


@query("v04_average_precision")
def q_v04(spark, sf):
    return MT.average_precision(scored1(spark, sf))


@query("v05_roc_curve")
def q_v05(spark, sf):
    return MT.roc_curve(scored1(spark, sf))


@query("v06_pr_curve")
def q_v06(spark, sf):
    return MT.pr_curve(scored1(spark, sf))


@query("v07_classification_report")
def q_v07(spark, sf):
    return MT.classification_report(scored1(spark, sf), threshold=0.5)


@query("v08_threshold_sweep")
def q_v08(spark, sf):
    return MT.threshold_sweep(scored1(spark, sf))


@query("v08_best_threshold")
def q_v08b(spark, sf):
    return MT.best_threshold(scored1(spark, sf), "f1")


@query("v10_calibration")
def q_v10(spark, sf):
    return MT.calibration(scored1(spark, sf), n_bins=10)


@query("v12_compare_models")
def q_v12(spark, sf):
    return MT.compare_models(scored_table(spark, sf), MODELS)


@query("v13_best_model")
def q_v13(spark, sf):
    return MT.best_model(scored_table(spark, sf), MODELS, "f1")


@query("v14_improvement_table")
def q_v14(spark, sf):
    return MT.improvement_table(scored_table(spark, sf), "p2", "p1")


@query("v15_business_impact")
def q_v15(spark, sf):
    return MT.business_impact(scored1(spark, sf), threshold=0.5)


@query("v16_impact_by_model")
def q_v16(spark, sf):
    return MT.business_impact(MT.long_scores(scored_table(spark, sf), MODELS), threshold=0.5, model="model")


@query("v17_top_risk")
def q_v17(spark, sf):
    return MT.top_risk(scored_table(spark, sf), "p3", 20)


# --------------------------------------------------------------------------- ensembles
ENSEMBLE_WEIGHTS = [0.5, 0.3, 0.2]


@query("b02_voting")
def q_b02(spark, sf):
    s = scored_table(spark, sf)
    return EB.combine(s, MODELS, "voting").select("id", "label", "ensemble")


@query("b03_averaging")
def q_b03(spark, sf):
    s = scored_table(spark, sf)
    return round_doubles(EB.combine(s, MODELS, "averaging").select("id", "label", "ensemble"))


@query("b04_weighted")
def q_b04(spark, sf):
    s = scored_table(spark, sf)
    return round_doubles(EB.combine(s, MODELS, "weighted", ENSEMBLE_WEIGHTS).select("id", "label", "ensemble"))


@query("b06_blend_auc")
def q_b06(spark, sf):
    return EB.blend_weights(scored_table(spark, sf), MODELS, metric="auc")


@query("b06_blend_f1_two_models")
def q_b06b(spark, sf):
    return EB.blend_weights(scored_table(spark, sf), ["p1", "p2"], metric="f1")


@query("b09_contributions")
def q_b09(spark, sf):
    return EB.contributions(scored_table(spark, sf), MODELS, "weighted", ENSEMBLE_WEIGHTS)


@query("b10_contributions_detailed")
def q_b10(spark, sf):
    return EB.contributions(scored_table(spark, sf), MODELS, "weighted", ENSEMBLE_WEIGHTS, detailed=True)


# --------------------------------------------------------------------------- splits & resampling
from retentio.operators import forecast as FC  # noqa: E402
from retentio.operators import irls as IR  # noqa: E402
from retentio.operators import mutual_info as MI  # noqa: E402
from retentio.operators import sample as SA  # noqa: E402
from retentio.operators import select as SE  # noqa: E402
from retentio.operators import timeseries as TS  # noqa: E402


def _ids(spark, sf):
    return mart(spark, sf).select("CustomerID", "Churn")


@query("r01_stratified_split")
def q_r01(spark, sf):
    return SA.stratified_split(_ids(spark, sf), "CustomerID", "Churn", 0.2, seed=42, shuffle="modular")


@query("r02_random_split")
def q_r02(spark, sf):
    return SA.stratified_split(_ids(spark, sf), "CustomerID", "Churn", 0.2, seed=7, stratify=False, shuffle="modular")


@query("r03_three_way_split")
def q_r03(spark, sf):
    return SA.three_way_split(_ids(spark, sf), "CustomerID", "Churn", 0.3, seed=42, shuffle="modular")


@query("r04_stratified_kfold")
def q_r04(spark, sf):
    return SA.stratified_kfold(_ids(spark, sf), "CustomerID", "Churn", 5, seed=42, shuffle="modular")


@query("r05_undersample")
def q_r05(spark, sf):
    return SA.undersample(_ids(spark, sf), "CustomerID", "Churn", 1.0, seed=42, shuffle="modular")


@query("r09_class_weights")
def q_r09(spark, sf):
    return round_doubles(SA.class_weights(_ids(spark, sf), "Churn"))


@query("r10_scale_pos_weight")
def q_r10(spark, sf):
    return round_doubles(SA.scale_pos_weight(scored_table(spark, sf), "label"))


@query("r11_class_distribution")
def q_r11(spark, sf):
    ids = _ids(spark, sf)
    return round_doubles(SA.distribution_before_after(ids, SA.undersample(ids, "CustomerID", "Churn", 1.0, shuffle="modular"), "Churn"))


# --------------------------------------------------------------------------- selection & statistics
def _lab(spark, sf):
    return _labelled(spark, sf)


@query("l01_drop_correlated")
def q_l01(spark, sf):
    return SE.drop_correlated(mart(spark, sf), FEATURE_NUMERIC, 0.85)


@query("l02_select_k_best_anova")
def q_l02(spark, sf):
    return SE.select_k_best(_lab(spark, sf), FEATURE_NUMERIC, "label", k=10)


@query("l04_mutual_info_binned")
def q_l04(spark, sf):
    return SE.mutual_info_binned(_lab(spark, sf), FEATURE_NUMERIC, "label")


@query("l04_mutual_info_neighbours")
def q_l04_neighbours(spark, sf):
    """The k-nearest-neighbour estimate of every numeric feature."""
    return MI.mutual_info(_lab(spark, sf), FEATURE_NUMERIC, "label")


WOE_NUMERIC = ["MonthlyRevenue", "CurrentEquipmentDays", "MonthsInService"]
WOE_CATEGORICAL = ["PrizmCode"]


@query("l08_woe_table")
def q_l08w(spark, sf):
    return round_doubles(SE.woe_table(_lab(spark, sf), WOE_NUMERIC, WOE_CATEGORICAL, "label"))


@query("l02_indicator_f")
def q_l02_indicators(spark, sf):
    """F of each one-hot indicator of two key columns with thousands of values."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_orderkey", "l_returnflag")
    return SE.indicator_f(li, ["l_partkey", "l_orderkey"], "l_returnflag")


@query("l01_indicator_correlation")
def q_l01_indicators(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    return SE.indicator_correlation(li, ["l_partkey", "l_suppkey"], ["l_quantity", "l_extendedprice", "l_discount"])


@query("l02_select_encoded")
def q_l02_encoded(spark, sf):
    """The best of the order lines' numeric columns and of all indicators of four key and flag columns."""
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    li = li.withColumn("late", (F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp")).cast("int"))
    return SE.select_encoded(li, ["l_quantity", "l_extendedprice", "l_discount"],
                             ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"], "late", k=30)


@query("l08_information_value")
def q_l08(spark, sf):
    return SE.information_values(_lab(spark, sf), FEATURE_NUMERIC, CATS, "label")


# --------------------------------------------------------------------------- sequences & forecast
SEQ_VECTOR = ["n", "n_error"]
#: base models of the time-series ensemble: their features
SERIES_BASES = {"usage": ["n", "n_error"], "spend": ["value"]}


@query("t02_sequences")
def q_t02(spark, sf):
    return FC.sequences(usage_series(spark, sf), "id", "t", SEQ_VECTOR, "label", window=3)


def _series_model(panel):
    return TS.fit(panel, "id", "t", SERIES_BASES, "label", window=3)


@query("t01_per_period_models")
def q_t01(spark, sf):
    """Coefficients of every base model in every period."""
    panel = usage_series(spark, sf)
    models = TS.period_models(panel, "t", SERIES_BASES, "label")
    rows = [IR.terms(models[b], "t", f).select(F.lit(b).alias("model"), "*") for b, f in SERIES_BASES.items()]
    return round_doubles(rows[0].unionByName(rows[1]))


@query("t03_sequence_model")
def q_t03(spark, sf):
    """Windows of the per-period scores and what the fitted sequence model makes of them."""
    panel = usage_series(spark, sf)
    model = _series_model(panel)
    fitted = {b: model.period_models.where(F.col("model") == b).groupBy("t").pivot("term", ["intercept", *f]).agg(F.first("coefficient"))
              .select("t", *[F.col(c).alias(f"b{i}") for i, c in enumerate(["intercept", *f])])
              for b, f in SERIES_BASES.items()}
    seqs = TS.sequences(panel, "id", "t", SERIES_BASES, "label", fitted)
    return round_doubles(model.score_sequences(seqs))


@query("t04_score_series")
def q_t04(spark, sf):
    panel = usage_series(spark, sf)
    return round_doubles(_series_model(panel).score(panel))


@query("t05_forecast")
def q_t05(spark, sf):
    panel = usage_series(spark, sf)
    return _series_model(panel).forecast(panel, periods=3)


# --------------------------------------------------------------------------- models (rows-only checks)
from pyspark.ml import PipelineModel  # noqa: E402

from retentio.operators import ensemble_ml as ML  # noqa: E402
from retentio.operators import models as MD  # noqa: E402
from retentio.operators import smote as SM  # noqa: E402
from retentio.plans import reports as RP  # noqa: E402
from retentio.plans import workflows as WF  # noqa: E402

def _model_frame(spark, sf):
    m = _labelled(spark, sf)
    return CL.fit_median_imputer(m, FEATURE_NUMERIC).transform(m).select("CustomerID", "label", *FEATURE_NUMERIC)


def _train_test(spark, sf):
    # stored: every iteration of a fit reads it
    sp = stored(SA.stratified_split(_model_frame(spark, sf), "CustomerID", "label", 0.2, seed=42), "train-test")
    return sp.where(F.col("split") == "train").drop("split"), sp.where(F.col("split") == "test").drop("split")


def _spw_weighted(df):
    spw = SA.scale_pos_weight(df, "label").first()["scale_pos_weight"]
    return df.withColumn("weight", F.when(F.col("label") == 1, F.lit(float(spw))).otherwise(F.lit(1.0)))


def _fit_score(kind, weighted=None, **params):
    def run(spark, sf):
        train, test = _train_test(spark, sf)
        wcol = None
        if weighted == "spw":
            train, wcol = _spw_weighted(train), "weight"
        elif weighted == "balanced":
            train, wcol = SA.with_weight_column(train, "label"), "weight"
        model = MD.create_model(kind, FEATURE_NUMERIC, "label", weight_col=wcol, **params).fit(train)
        return RP.scored_report(model.predict_proba(test, keep=["CustomerID", "label"]), "CustomerID", "label", "prob")
    return run


QUERIES["m01_boosted_trees_xgb"] = _fit_score("xgboost", "spw")
QUERIES["m02_boosted_trees_lgbm"] = _fit_score("lightgbm")
QUERIES["m04_neural_network"] = _fit_score("neural_network")
QUERIES["m05_random_forest"] = _fit_score("random_forest", "balanced")
QUERIES["m06_logistic_regression"] = _fit_score("logistic_regression", "balanced")
QUERIES["m07_gradient_boosting"] = _fit_score("gradient_boosting")


@query("m03_early_stopping")
def q_m03(spark, sf):
    train, test = _train_test(spark, sf)
    val = SA.stratified_split(train, "CustomerID", "label", 0.2, seed=11)
    val = val.withColumn("is_val", F.col("split") == "test").drop("split")
    model = MD.create_model("xgboost", FEATURE_NUMERIC, "label", validationIndicatorCol="is_val",
                            validationTol=0.01).fit(val)
    return RP.scored_report(model.predict_proba(test, keep=["CustomerID", "label"]), "CustomerID", "label", "prob")


def _leafwise(spark, sf, **params):
    """Leaf-wise trees on all features, with a fifth of the training rows for validation."""
    train, _ = _train_test(spark, sf)
    val = SA.stratified_split(train, "CustomerID", "label", 0.2, seed=11)
    val = stored(val.withColumn("is_val", F.col("split") == "test").drop("split"), "train-val")
    return MD.create_model("lightgbm", FEATURE_NUMERIC, "label", validationIndicatorCol="is_val", maxIter=20, **params).fit(val)


@query("m02_leafwise_trees")
def q_m02_trees(spark, sf):
    """Every node of the fitted trees: split, gain, cover, rows and leaf value."""
    clf = _leafwise(spark, sf).model.stages[-1]
    rows = [(k, v, FEATURE_NUMERIC[f] if f >= 0 else None, t, g, c, int(n), x) for k, v, f, t, g, c, n, x in clf.split_rows()]
    return round_doubles(spark.createDataFrame(rows, "tree int, node int, feature string, threshold double, gain double, "
                                                     "cover double, n_rows long, value double"))


@query("m13_validation_curve")
def q_m13_curve(spark, sf):
    """Log loss on training and validation rows after every tree."""
    clf = _leafwise(spark, sf, patience=5).model.stages[-1]
    return round_doubles(spark.createDataFrame([tuple(r) for r in clf.history()], "n_trees int, training double, validation double"))


@query("m10_tuning")
def q_m10(spark, sf):
    """Cross-validated AUC of every setting that was tried."""
    train, _ = _train_test(spark, sf)
    _, results = MD.tune("logistic_regression", train, FEATURE_NUMERIC, "label",
                         {"regParam": [0.0, 0.001, 0.01, 0.1, 1.0], "elasticNetParam": [0.0, 0.5, 1.0]}, n_iter=10, folds=3)
    return round_doubles(spark.createDataFrame([(p["regParam"], p["elasticNetParam"], m) for p, m in results],
                                               "reg_param double, elastic_net double, cv_auc double"))


@query("m13_training_curve")
def q_m13(spark, sf):
    train, _ = _train_test(spark, sf)
    curve = MD.create_model("gradient_boosting", FEATURE_NUMERIC, "label").fit(train).training_curve(train)
    return round_doubles(spark.createDataFrame([(k, float(v)) for k, v in curve], "round int, loss double"))


def _importance_rows(spark, importances, top=None):
    rows = [(f, float(v), i) for i, (f, v) in enumerate(importances[:top], 1)]
    return round_doubles(spark.createDataFrame(rows, "feature string, importance double, rank int"))


@query("l05_model_based_selection")
def q_l05(spark, sf):
    train, _ = _train_test(spark, sf)
    model = MD.create_model("random_forest", FEATURE_NUMERIC, "label").fit(train)
    return _importance_rows(spark, model.feature_importances(), 20)


@query("l06_select_from_model")
def q_l06(spark, sf):
    """Which features reach the mean and the median importance."""
    train, _ = _train_test(spark, sf)
    mean, median = (set(MD.select_from_model(train, FEATURE_NUMERIC, "label", t)) for t in ("mean", "median"))
    return spark.createDataFrame([(f, f in mean, f in median) for f in FEATURE_NUMERIC],
                                 "feature string, reaches_mean boolean, reaches_median boolean")


@query("l12_split_counts")
def q_l12(spark, sf):
    """Splits, mean gain and mean cover of every feature over the leaf-wise trees."""
    model = _leafwise(spark, sf)
    kinds = [model.split_importances(k) for k in ("weight", "gain", "cover")]
    return round_doubles(spark.createDataFrame([(f, int(kinds[0][f]), float(kinds[1][f]), float(kinds[2][f])) for f in FEATURE_NUMERIC],
                                               "feature string, weight long, gain double, cover double"))


@query("l13_permutation_importance")
def q_l13(spark, sf):
    train, test = _train_test(spark, sf)
    m = MD.create_model("logistic_regression", FEATURE_NUMERIC, "label").fit(train)
    return round_doubles(MD.permutation_importance(m, test, "CustomerID", "label", n_repeats=10))


@query("v11_cross_validate")
def q_v11(spark, sf):
    """Metrics of every fold; the folds' models are fitted together."""
    per, _ = MD.cross_validate(ML.RIDGE, _labelled(spark, sf), "CustomerID", CV_FEATURES, "label", k=5, shuffle="modular")
    return round_doubles(per)


@query("v18_score_holdout")
def q_v18(spark, sf):
    train, test = _train_test(spark, sf)
    m = MD.create_model("logistic_regression", FEATURE_NUMERIC, "label").fit(train)
    out = WF.score_holdout(m, test.drop("label"), "CustomerID")
    back = out.join(test.select(F.col("CustomerID").alias("customer_id"), "label"), "customer_id")
    return RP.scored_report(back, "customer_id", "label", "churn_probability")


@query("b05_stacking")
def q_b05(spark, sf):
    """Trees and logistic regressions, stacked; scored on customers that no model has seen."""
    train, test = _train_test(spark, sf)
    bases = {"logistic": {"kind": "logistic_regression", "features": FEATURE_NUMERIC},
             "forest": {"kind": "random_forest", "features": FEATURE_NUMERIC},
             "boosted": {"kind": "gradient_boosting", "features": FEATURE_NUMERIC, "maxIter": 20},
             "ridge": {"kind": ML.RIDGE, "features": CONT[:6]}}
    scored = ML.ChurnEnsemble(bases, "stacking", folds=3).fit(train).transform(test)
    return RP.scored_report(scored, "CustomerID", "label", "ensemble")


#: features of the cross-validated model: the columns that describe usage and its change
CV_FEATURES = ["MonthlyRevenue", "MonthlyMinutes", "PercChangeMinutes", "PercChangeRevenues", "DroppedCalls", "CustomerCareCalls"]

#: base models of the stacked ensemble that SQL can refit: their features
STACK_BASES = {"service": ["DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls"],
               "value": ["MonthlyRevenue", "MonthlyMinutes", "TotalRecurringCharge"],
               "change": ["PercChangeMinutes", "PercChangeRevenues", "OverageMinutes"]}


def _stacked(spark, sf):
    """(model as loaded from disk, its scores of the held-out customers)"""
    m = _labelled(spark, sf)
    sp = stored(SA.stratified_split(m, "CustomerID", "label", 0.2, seed=42, shuffle="modular"), "train-test")
    bases = {b: {"kind": ML.RIDGE, "features": f} for b, f in STACK_BASES.items()}
    fitted = ML.ChurnEnsemble(bases, "stacking", folds=5, shuffle="modular").fit(sp.where("split = 'train'").drop("split"))
    path = _scratch(spark, "ensemble")
    fitted.write().overwrite().save(path)
    model = PipelineModel.load(path)
    return model, model.transform(sp.where("split = 'test'").drop("split")).select(
        "CustomerID", "label", *[f"p_{b}" for b in STACK_BASES], "ensemble")


@query("b05_stacking_scores")
def q_b05_scores(spark, sf):
    return round_doubles(_stacked(spark, sf)[1])


@query("b09_contributions_stacking")
def q_b09_stacking(spark, sf):
    return round_doubles(ML.contributions(*_stacked(spark, sf)))


@query("b07_blend_search")
def q_b07(spark, sf):
    scored = scored_table(spark, sf).withColumn("p4", (F.col("p1") + F.col("p3")) / 2)
    return round_doubles(EB.blend_search(scored, [*MODELS, "p4"], metric="auc"))


@query("b07_blend_optimise")
def q_b07_optimise(spark, sf):
    scored = scored_table(spark, sf).withColumn("p4", (F.col("p1") + F.col("p3")) / 2)
    return round_doubles(BO.blend_optimise(scored, [*MODELS, "p4"], metric="auc"))


@query("t07_forecast_with_history")
def q_t07(spark, sf):
    """Past scores and forecasts of ten drawn customers (the number that a chart shows)."""
    from retentio.plans.ordering import k_smallest
    panel = usage_series(spark, sf)
    drawn = k_smallest(panel.select("id").distinct().withColumn("_h", SA.shuffle_key("id", 42, "modular")), ["_h", "id"], 10)
    return round_doubles(_series_model(panel).history_and_forecast(panel, drawn))


def _resampled_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per class: rows, original rows, synthetic rows, and synthetic values that lie
    outside the range of the class's original rows (interpolation has none)."""
    lo_hi = before.groupBy("label").agg(*[f(c).alias(f"{n}_{i}") for i, c in enumerate(FEATURE_NUMERIC)
                                          for n, f in (("lo", F.min), ("hi", F.max))])
    outside = sum((F.when((F.col(c) < F.col(f"lo_{i}") - 1e-9) | (F.col(c) > F.col(f"hi_{i}") + 1e-9), 1).otherwise(0)
                   for i, c in enumerate(FEATURE_NUMERIC)), F.lit(0))
    synthetic = F.col("CustomerID").isNull()
    # lo_hi holds one row per class
    return after.join(F.broadcast(lo_hi), "label").groupBy("label").agg(
        F.count("*").alias("count"), F.count("CustomerID").alias("original"), F.count_if(synthetic).alias("synthetic"),
        F.sum(F.when(synthetic, outside).otherwise(0)).alias("outside_hull"))


@query("r06_smote")
def q_r06(spark, sf):
    frame = _model_frame(spark, sf)
    return _resampled_report(frame, SM.smote(frame, "CustomerID", "label", FEATURE_NUMERIC, ratio=1.0))


@query("r07_hybrid")
def q_r07(spark, sf):
    frame = _model_frame(spark, sf)
    return _resampled_report(frame, SM.hybrid(frame, "CustomerID", "label", FEATURE_NUMERIC, ratio=0.5))


# --------------------------------------------------------------------------- workflows
@query("w01_preprocess")
def q_w01(spark, sf):
    return round_doubles(WF.Preprocessor().fit_transform(raw_mart(spark, sf)))


@query("w02_feature_engineering")
def q_w02(spark, sf):
    """The engineered frame, one row per customer and selected feature (k, default 30) with its rank."""
    fe = WF.FeatureEngineer(k=30)
    out = fe.fit_transform(_labelled(spark, sf))
    rank = F.create_map(*[x for i, c in enumerate(fe.selected, 1) for x in (F.lit(c), F.lit(i))])
    rows = out.select("CustomerID", "label", *[F.col(c).cast("double").alias(c) for c in fe.selected]) \
        .unpivot(["CustomerID", "label"], fe.selected, "feature", "value")
    return round_doubles(rows.withColumn("rank", rank[F.col("feature")]))


@query("s10_saved_preprocessor")
def q_s10(spark, sf):
    """Fitted on two thirds of the customers, saved, loaded, replayed on the others."""
    from pyspark.ml import PipelineModel
    raw = raw_mart(spark, sf)
    pre = WF.Preprocessor()
    pre.fit_transform(raw.where(FIT_ROWS))
    path = _scratch(spark, "preprocessor")
    pre.model().save(path)
    return round_doubles(PipelineModel.load(path).transform(raw.where("(CustomerID * 7919) % 1009 >= 700")))


@query("w03_prepare_data")
def q_w03(spark, sf):
    return WF.prepare_data(mart(spark, sf), shuffle="modular")


@query("w04_training_run")
def q_w04(spark, sf):
    """Metrics of the held-out customers at 0.5 and at the threshold chosen on the validation part."""
    train, test = _train_test(spark, sf)
    res = WF.training_run(train, test, "CustomerID", FEATURE_NUMERIC, "random_forest", resampling="undersample",
                          grid={"maxDepth": [3, 5], "numTrees": [20, 50]}, n_iter=3, out_path=_scratch(spark, "run"))
    cut = float(res["threshold"])
    rows = [res[k].select(F.lit(n).alias("at"), F.lit(t).alias("threshold"), "accuracy", "precision", "recall", "f1")
            for k, n, t in (("metrics", "default", 0.5), ("tuned_metrics", "chosen", cut))]
    return round_doubles(rows[0].unionByName(rows[1]))


@query("w05_original_vs_engineered")
def q_w05(spark, sf):
    m = _labelled(spark, sf)
    eng = [n for f in FE.FAMILIES for n in FE.family_members(f) if n not in FEATURE_NUMERIC]
    eng = [n for n in dict.fromkeys(eng) if n not in ("TenureBucket", "AgeSegment")]      # those two are strings
    full = FE.add_features(m, names=eng)
    full = CL.fit_median_imputer(full, FEATURE_NUMERIC + eng).transform(full)
    sp = stored(SA.stratified_split(full.select("CustomerID", "label", *FEATURE_NUMERIC, *eng), "CustomerID", "label", 0.2), "train-test")
    train, test = sp.where("split = 'train'").drop("split"), sp.where("split = 'test'").drop("split")
    return WF.compare_original_vs_engineered(train, test, "CustomerID", FEATURE_NUMERIC, eng)


@query("w06_deployment_batch")
def q_w06(spark, sf):
    train, test = _train_test(spark, sf)
    path = _scratch(spark, "model")
    MD.create_model("logistic_regression", FEATURE_NUMERIC, "label").fit(train).save(path)
    out = WF.deployment_batch(path, test, "CustomerID")["predictions"]
    back = out.join(test.select(F.col("CustomerID").alias("customer_id"), "label"), "customer_id")
    return RP.scored_report(back, "customer_id", "label", "churn_probability")


@query("w07_first_look_importance")
def q_w07(spark, sf):
    return _importance_rows(spark, WF.first_look_importance(raw_mart(spark, sf)))


# --------------------------------------------------------------------------- sources / sinks / streaming
from retentio.sources import io as IO  # noqa: E402


def _scratch(spark, name):
    import uuid

    from retentio.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/retentio-io/{name}-{uuid.uuid4().hex[:12]}"


@query("s01_csv_roundtrip")
def q_s01(spark, sf):
    m = mart(spark, sf)
    path = _scratch(spark, "mart") + ".csv"
    IO.save(m, path)
    return IO.load(spark, path, schema=m.schema)


@query("s02_json_roundtrip")
def q_s02(spark, sf):
    """Records over several lines and separated by commas, which only a whole-file reader or ranges can take."""
    m = mart(spark, sf)
    path = _scratch(spark, "mart") + ".json"
    m.select(F.to_json(F.struct("*"), {"pretty": "true"})).write.option("lineSep", ",\n").text(path)
    return IO.load(spark, path, schema=m.schema)


@query("s03_parquet_roundtrip")
def q_s03(spark, sf):
    m = mart(spark, sf)
    path = _scratch(spark, "mart") + ".parquet"
    IO.save(m, path)
    return IO.load(spark, path)


@query("s08_split_files")
def q_s08(spark, sf):
    path = _scratch(spark, "splits")
    IO.write_splits(WF.prepare_data(mart(spark, sf), shuffle="modular"), path)
    return spark.read.parquet(path).groupBy("split", "label").agg(F.count("*").alias("count"))


@query("st01_streaming_features")
def q_st01(spark, sf):
    from retentio.sources.mart import mart_table
    from retentio.streaming.features import run_available
    src = mart_table(spark, sf)
    source_path = src.inputFiles()[0].rsplit("/", 1)[0]
    base = _scratch(spark, "stream")
    out = run_available(spark, source_path, src.schema, f"{base}/out", f"{base}/checkpoint", families=["risk"])
    return round_doubles(out)


@query("b08_blend_average_precision")
def q_b08(spark, sf):
    return EB.blend_weights(scored_table(spark, sf), ["p1", "p3"], metric="average_precision")

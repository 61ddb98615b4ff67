"""DuckDB oracle SQL for every exactly-checkable query in the registry."""

from __future__ import annotations

from retentio.plans.oracle_irls import irls_ctes, logistic_sql
from retentio.plans.oracle_mart import SCORED_CTE, USAGE_CTE, mart_ctes, mart_ctes_raw_only

ORACLES: dict[str, str] = {}


def W(body: str, raw: bool = False, scored: bool = False, usage: bool = False, mart: bool = True) -> str:
    parts = []
    if mart or raw or scored:
        parts.append(mart_ctes(raw=False))
    if raw:
        parts.append(mart_ctes_raw_only())
    if scored:
        parts.append(SCORED_CTE)
    if usage:
        parts.append(USAGE_CTE)
    return "WITH " + ",".join(parts) + "\n" + body


def nzs(x: str) -> str:
    return f"(CASE WHEN ({x}) = 0 THEN 1 ELSE ({x}) END)"


def m1() -> str:
    return "(CASE WHEN MonthsInService < 1 THEN 1 ELSE MonthsInService END)"


def fl(cond: str) -> str:
    return f"coalesce(CAST(({cond}) AS INTEGER), 0)"


def clip_sql(x: str, lo, hi) -> str:
    return f"(CASE WHEN {x} < {lo} THEN {lo} WHEN {x} > {hi} THEN {hi} ELSE {x} END)"


# --------------------------------------------------------------------------- bridge
ORACLES["s03_customer_mart"] = W("SELECT * FROM mart")
ORACLES["s03_customer_mart_raw"] = W("SELECT * FROM raw", raw=True)
ORACLES["s03_scored_table"] = W("SELECT * FROM scored", scored=True)
ORACLES["s03_usage_series"] = W("SELECT id, t, n, value, n_error, label FROM usage", usage=True, mart=False)

# --------------------------------------------------------------------------- features
_TOTAL_CALLS = "(OutboundCalls + InboundCalls)"
_PROBLEM = "(DroppedCalls + BlockedCalls + UnansweredCalls)"
_CPM = f"({_TOTAL_CALLS} / {m1()})"
_SFU = f"({fl('CallWaitingCalls > 0')} + {fl('CallForwardingCalls > 0')} + {fl('ThreewayCalls > 0')})"
_RRR = f"(TotalRecurringCharge / {nzs('MonthlyRevenue')})"
_AVG_AGE = ("(CASE WHEN (CASE WHEN AgeHH1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN AgeHH2 > 0 THEN 1 ELSE 0 END) > 0 "
            "THEN ((CASE WHEN AgeHH1 > 0 THEN AgeHH1 ELSE 0.0 END) + (CASE WHEN AgeHH2 > 0 THEN AgeHH2 ELSE 0.0 END)) "
            "/ ((CASE WHEN AgeHH1 > 0 THEN 1 ELSE 0 END) + (CASE WHEN AgeHH2 > 0 THEN 1 ELSE 0 END)) END)")
_TECH = f"({fl(chr(39).join(['OwnsComputer = ', 'Yes', '']))} + {fl(chr(39).join(['HandsetWebCapable = ', 'Yes', '']))})"
_SQ = f"({fl('DroppedCalls > 0')} + {fl('BlockedCalls > 0')} + {fl('UnansweredCalls > 0')} + {fl('CustomerCareCalls > 2')})"
_FIN = f"({fl('PercChangeRevenues < -10')} + {fl('OverageMinutes > 0')} + {fl('MonthlyRevenue < 50')} + {fl(_RRR + ' < 0.5')})"
_ENG = f"({fl('MonthsInService <= 3')} + {fl(_CPM + ' < 10')} + {fl(_SFU + ' = 0')} + {fl('ReferralsMadeBySubscriber = 0')})"
_MAX_RISK = 4 * 0.4 + 4 * 0.4 + 4 * 0.2

SQL_FEATURES = {
    "TotalCallIssues": "DroppedCalls + BlockedCalls",
    "TotalCalls": _TOTAL_CALLS,
    "OutboundCallRatio": f"OutboundCalls / {nzs(_TOTAL_CALLS)}",
    "TotalServiceCalls": "CustomerCareCalls + RetentionCalls",
    "HandsetsPerModel": f"Handsets / {nzs('HandsetModels')}",
    "RevenuePerMinute": f"MonthlyRevenue / {nzs('MonthlyMinutes')}",
    "CustomerCareCallsPerMonth": f"CustomerCareCalls / {m1()}",
    "TotalProblemCalls": _PROBLEM,
    "ProblemCallsPerMonth": f"{_PROBLEM} / {m1()}",
    "CallsPerMonth": _CPM,
    "SpecialFeaturesUsed": _SFU,
    "RetentionCallsPerMonth": f"RetentionCalls / {m1()}",
    "RetentionSuccessRate": f"RetentionOffersAccepted / {nzs('RetentionCalls')}",
    "PeakCallsRatio": f"PeakCallsInOut / {nzs('PeakCallsInOut + OffPeakCallsInOut')}",
    "PremiumServiceUsage": fl("DirectorAssistedCalls > 0"),
    "RoamingServiceUsage": fl("RoamingCalls > 0"),
    "HasOverages": fl("OverageMinutes > 0"),
    "NormalizedChangeMinutes": f"{clip_sql('PercChangeMinutes', -100, 100)} / 100",
    "NormalizedChangeRevenues": f"{clip_sql('PercChangeRevenues', -100, 100)} / 100",
    "ConsistentChangeDirection": fl("PercChangeMinutes * PercChangeRevenues > 0"),
    "LargeNegativeChange": fl("PercChangeMinutes < -20 OR PercChangeRevenues < -20"),
    "TenureBucket": ("CASE WHEN MonthsInService <= 3 THEN '0-3 months' WHEN MonthsInService <= 6 THEN '4-6 months' "
                     "WHEN MonthsInService <= 12 THEN '7-12 months' WHEN MonthsInService <= 24 THEN '1-2 years' "
                     "WHEN MonthsInService > 24 THEN '2+ years' ELSE 'Unknown' END"),
    "IsNewCustomer": fl("MonthsInService <= 3"),
    "ARPM": f"MonthlyRevenue / {nzs('MonthlyMinutes')}",
    "ProblemCallRatio": f"(DroppedCalls + BlockedCalls) / {nzs(_TOTAL_CALLS)}",
    "RetentionToServiceRatio": f"RetentionCalls / {m1()}",
    "EquipmentLifeRatio": f"CurrentEquipmentDays / {nzs('MonthsInService * 30')}",
    "RecurringRevenueRatio": _RRR,
    "TechSavvyScore": _TECH,
    "HasChildren": fl("ChildrenInHH = 'Yes'"),
    "IsMultiPersonHH": fl("AgeHH1 > 0 AND AgeHH2 > 0"),
    "AvgHHAge": _AVG_AGE,
    "AgeSegment": (f"CASE WHEN {_AVG_AGE} < 25 THEN 'Under 25' WHEN {_AVG_AGE} < 35 THEN '25-34' "
                   f"WHEN {_AVG_AGE} < 45 THEN '35-44' WHEN {_AVG_AGE} < 55 THEN '45-54' "
                   f"WHEN {_AVG_AGE} >= 55 THEN '55+' ELSE 'Unknown' END"),
    "HasMadeReferrals": fl("ReferralsMadeBySubscriber > 0"),
    "HighReferrer": fl("ReferralsMadeBySubscriber >= 2"),
    "CreditScore": "10 - (CASE WHEN AdjustmentsToCreditRating > 10 THEN 10 ELSE AdjustmentsToCreditRating END)",
    "HighIncome": fl("IncomeGroup >= 7"),
    "LowIncome": fl("IncomeGroup <= 3"),
    "CustomerLifetimeValue": "MonthlyRevenue * MonthsInService",
    "RevenueStability": "100 - (CASE WHEN abs(PercChangeRevenues) > 100 THEN 100 ELSE abs(PercChangeRevenues) END)",
    "RevenuePerSubscription": "MonthlyRevenue / (CASE WHEN ActiveSubs < 1 THEN 1 ELSE ActiveSubs END)",
    "HighValueCustomer": fl("MonthlyRevenue > 100"),
    "UsageTrendDirection": "coalesce(CAST(sign(PercChangeMinutes) AS DOUBLE), 0.0)",
    "RevenueTrendDirection": "coalesce(CAST(sign(PercChangeRevenues) AS DOUBLE), 0.0)",
    "UsageAcceleration": f"PercChangeMinutes / {m1()}",
    "RevenueAcceleration": f"PercChangeRevenues / {m1()}",
    "TrendConsistency": ("abs((CAST(sign(PercChangeMinutes) AS DOUBLE) + CAST(sign(PercChangeRevenues) AS DOUBLE) "
                         "+ CAST(sign(CustomerCareCalls) AS DOUBLE) + CAST(sign(DroppedCalls) AS DOUBLE)) / 4)"),
    "ServiceQualityRiskScore": _SQ,
    "FinancialRiskScore": _FIN,
    "EngagementRiskScore": _ENG,
    "ChurnRiskScore": f"({_SQ} * 0.4 + {_FIN} * 0.4 + {_ENG} * 0.2) / {_MAX_RISK!r} * 100",
    "NewCustomerWithProblems": fl(f"MonthsInService <= 3 AND {_PROBLEM} > 0"),
    "HighValueCustomerWithProblems": fl(f"MonthlyRevenue > 100 AND {_PROBLEM} > 0"),
    "ServiceIssuesWithDecliningUsage": fl(f"{_PROBLEM} > 0 AND PercChangeMinutes < 0"),
    "FailedRetentionAttempts": fl("RetentionCalls > 1 AND RetentionOffersAccepted = 0"),
    "TechSavvyWithProblems": fl(f"{_TECH} > 0 AND {_PROBLEM} > 0"),
}

_AVG_AGE_CUT = "(CASE WHEN AgeHH2 > 0 THEN (AgeHH1 + AgeHH2) / 2 ELSE AgeHH1 END)"
SQL_VARIANTS = {
    "TenureBucket": ("CASE WHEN MonthsInService > 0 AND MonthsInService <= 3 THEN '0-3 months' "
                     "WHEN MonthsInService > 3 AND MonthsInService <= 6 THEN '3-6 months' "
                     "WHEN MonthsInService > 6 AND MonthsInService <= 12 THEN '6-12 months' "
                     "WHEN MonthsInService > 12 AND MonthsInService <= 24 THEN '1-2 years' "
                     "WHEN MonthsInService > 24 THEN '2+ years' END"),
    "RetentionToServiceRatio": f"RetentionCalls / {nzs('CustomerCareCalls')}",
    "IsMultiPersonHH": fl("AgeHH2 > 0"),
    "AvgHHAge": _AVG_AGE_CUT,
    "AgeSegment": (f"CASE WHEN {_AVG_AGE_CUT} > 0 AND {_AVG_AGE_CUT} <= 25 THEN '18-25' "
                   f"WHEN {_AVG_AGE_CUT} > 25 AND {_AVG_AGE_CUT} <= 35 THEN '26-35' "
                   f"WHEN {_AVG_AGE_CUT} > 35 AND {_AVG_AGE_CUT} <= 50 THEN '36-50' "
                   f"WHEN {_AVG_AGE_CUT} > 50 AND {_AVG_AGE_CUT} <= 65 THEN '51-65' "
                   f"WHEN {_AVG_AGE_CUT} > 65 THEN '65+' END"),
}

_INT_FEATURES = {"PremiumServiceUsage", "RoamingServiceUsage", "HasOverages", "ConsistentChangeDirection",
                 "LargeNegativeChange", "IsNewCustomer", "TechSavvyScore", "HasChildren", "IsMultiPersonHH",
                 "HasMadeReferrals", "HighReferrer", "HighIncome", "LowIncome", "HighValueCustomer",
                 "SpecialFeaturesUsed", "ServiceQualityRiskScore", "FinancialRiskScore", "EngagementRiskScore",
                 "NewCustomerWithProblems", "HighValueCustomerWithProblems", "ServiceIssuesWithDecliningUsage",
                 "FailedRetentionAttempts", "TechSavvyWithProblems"}
_STR_FEATURES = {"TenureBucket", "AgeSegment"}


def _feat_sql(name: str, expr: str) -> str:
    if name in _INT_FEATURES:
        return f"CAST({expr} AS INTEGER) AS {name}"
    if name in _STR_FEATURES:
        return f"{expr} AS {name}"
    return f"round(CAST({expr} AS DOUBLE), 6) AS {name}"


_FAMILIES = {
    "grouped": ["TotalCallIssues", "TotalCalls", "OutboundCallRatio", "TotalServiceCalls", "HandsetsPerModel",
                "RevenuePerMinute"],
    "behavioral": ["TotalCalls", "CustomerCareCallsPerMonth", "TotalProblemCalls", "ProblemCallsPerMonth",
                   "CallsPerMonth", "SpecialFeaturesUsed", "RetentionCallsPerMonth", "RetentionSuccessRate"],
    "usage": ["RevenuePerMinute", "PeakCallsRatio", "PremiumServiceUsage", "RoamingServiceUsage", "HasOverages"],
    "change": ["NormalizedChangeMinutes", "NormalizedChangeRevenues", "ConsistentChangeDirection",
               "LargeNegativeChange", "TenureBucket", "IsNewCustomer"],
    "ratio": ["ARPM", "ProblemCallRatio", "RetentionToServiceRatio", "EquipmentLifeRatio", "RecurringRevenueRatio"],
    "profile": ["TechSavvyScore", "HasChildren", "IsMultiPersonHH", "AvgHHAge", "AgeSegment", "HasMadeReferrals",
                "HighReferrer", "CreditScore", "HighIncome", "LowIncome"],
    "value": ["CustomerLifetimeValue", "RevenueStability", "RevenuePerSubscription", "HighValueCustomer"],
    "trend": ["UsageTrendDirection", "RevenueTrendDirection", "UsageAcceleration", "RevenueAcceleration",
              "TrendConsistency"],
    "risk": ["ServiceQualityRiskScore", "FinancialRiskScore", "EngagementRiskScore", "ChurnRiskScore"],
    "interaction": ["NewCustomerWithProblems", "HighValueCustomerWithProblems", "ServiceIssuesWithDecliningUsage",
                    "FailedRetentionAttempts", "TechSavvyWithProblems"],
}

for _fam, _names in _FAMILIES.items():
    _cols = ", ".join(_feat_sql(n, SQL_FEATURES[n]) for n in _names)
    ORACLES[f"f_features_{_fam}"] = W(f"SELECT CustomerID, {_cols} FROM mart")

ORACLES["f_features_variants"] = W(
    "SELECT CustomerID, " + ", ".join(_feat_sql(n, e) for n, e in SQL_VARIANTS.items()) + " FROM mart")

ORACLES["flagship_churn_by_tenure"] = W(f"""
SELECT {SQL_FEATURES['TenureBucket']} AS TenureBucket,
       round(avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) * 100, 6) AS churn_rate_pct,
       count(*) AS n_customers,
       round(avg({SQL_FEATURES['ChurnRiskScore']}), 6) AS avg_risk_score
FROM mart GROUP BY 1""")


# --------------------------------------------------------------------------- profiling
from retentio.roles import CHURN_ROLES as ROLES  # noqa: E402
from retentio.sources.mart import MART_COLUMNS  # noqa: E402

_CONT = list(ROLES.continuous)
_NUMERIC = list(ROLES.continuous) + list(ROLES.discrete)
_NULLABLE = ["CreditRating", "MaritalStatus", "ChildrenInHH", "MonthlyRevenue", "TotalRecurringCharge",
             "PercChangeMinutes", "PercChangeRevenues", "DroppedCalls", "CustomerCareCalls", "AgeHH1",
             "RetentionCalls", "Churn"]


def _union(parts):
    return "\nUNION ALL\n".join(parts)


ORACLES["p01_missing_summary"] = W(_union([
    f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE {c} IS NULL) AS missing_count,
       round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / count(*), 6) AS missing_pct FROM raw"""
    for c in MART_COLUMNS]), raw=True)

ORACLES["p02_nullity_correlation"] = W(_union([
    f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
       CASE WHEN isnan(corr(CAST({a} IS NULL AS DOUBLE), CAST({b} IS NULL AS DOUBLE))) THEN NULL
            ELSE round(corr(CAST({a} IS NULL AS DOUBLE), CAST({b} IS NULL AS DOUBLE)), 6) END AS corr
FROM raw
HAVING count(*) FILTER (WHERE {a} IS NULL) BETWEEN 1 AND count(*) - 1
   AND count(*) FILTER (WHERE {b} IS NULL) BETWEEN 1 AND count(*) - 1"""
    for i, a in enumerate(_NULLABLE) for b in _NULLABLE[i + 1:]]), raw=True)

ORACLES["p03_duplicate_rows"] = W("""
SELECT count(*) AS n_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT ServiceArea, CreditRating, PrizmCode, Occupation,
                                         MaritalStatus, ChildrenInHH FROM raw)) AS n_duplicate_rows
FROM raw""", raw=True)

ORACLES["p04_duplicate_keys"] = """
SELECT count(*) AS n_keys, count(*) FILTER (WHERE cnt > 1) AS n_repeated_keys,
       CAST(coalesce(sum(cnt - 1), 0) AS BIGINT) AS n_duplicate_rows
FROM (SELECT o_custkey, count(*) AS cnt FROM orders GROUP BY o_custkey)"""

_RAW_NUMERIC = (", rawnum AS (SELECT * REPLACE (" + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ROLES.discrete)
                + ") FROM raw)\n")
ORACLES["p06_describe_numeric"] = W(_RAW_NUMERIC + _union([
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
       round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM rawnum"""
    for c in _NUMERIC]), raw=True)

ORACLES["p07_top_values"] = W("""
SELECT ServiceArea AS value, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(ServiceArea) FROM mart), 6) AS pct
FROM mart WHERE ServiceArea IS NOT NULL GROUP BY ServiceArea ORDER BY count DESC, value LIMIT 10""")

ORACLES["p08_value_counts"] = W("""
SELECT CreditRating AS value, count(*) AS count FROM raw WHERE CreditRating IS NOT NULL GROUP BY 1""", raw=True)


def _histogram_sql(src: str, col: str, bins: int, by: str | None) -> str:
    key = f"{by}, " if by else ""
    grid = (f"(SELECT DISTINCT {by} FROM d) k CROSS JOIN (SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r"
            if by else f"(SELECT CAST(range AS INTEGER) AS bin FROM range({bins})) r")
    using = f"USING ({by}, bin)" if by else "USING (bin)"
    return f"""
, d AS (SELECT {key}CAST({col} AS DOUBLE) AS x FROM {src} WHERE {col} IS NOT NULL),
b AS (SELECT min(x) AS mn, max(x) AS mx FROM d),
c AS (SELECT {key}CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((x - mn) * {bins} / (mx - mn)), {bins - 1}) END AS INTEGER) AS bin,
             count(*) AS cnt FROM d CROSS JOIN b GROUP BY ALL),
g AS (SELECT * FROM {grid})
SELECT {key}bin, round(mn + bin * (mx - mn) / {bins}, 6) AS lo, round(mn + (bin + 1) * (mx - mn) / {bins}, 6) AS hi,
       coalesce(cnt, 0) AS count
FROM g CROSS JOIN b LEFT JOIN c {using}"""


ORACLES["p09_histogram"] = W(_histogram_sql("mart", "MonthlyRevenue", 30, None))
ORACLES["v09_score_histogram"] = W(_histogram_sql("scored", "p1", 20, "label"), scored=True)

ORACLES["p10_box_stats"] = W("""
, q AS (SELECT Churn, quantile_cont(MonthlyRevenue, 0.25) AS q1, quantile_cont(MonthlyRevenue, 0.5) AS med,
               quantile_cont(MonthlyRevenue, 0.75) AS q3 FROM mart WHERE MonthlyRevenue IS NOT NULL GROUP BY Churn)
SELECT m.Churn, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3,
       round(min(MonthlyRevenue) FILTER (WHERE MonthlyRevenue >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
       round(max(MonthlyRevenue) FILTER (WHERE MonthlyRevenue <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
       count(*) FILTER (WHERE MonthlyRevenue < q1 - 1.5 * (q3 - q1) OR MonthlyRevenue > q3 + 1.5 * (q3 - q1)) AS n_outliers,
       count(*) AS n
FROM mart m JOIN q ON m.Churn = q.Churn WHERE MonthlyRevenue IS NOT NULL
GROUP BY m.Churn, q1, med, q3""")

ORACLES["p11_target_distribution"] = W("""
SELECT Churn AS label, count(*) AS count,
       round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM mart), 6) AS pct
FROM mart GROUP BY Churn""")

ORACLES["p12_rate_by_category"] = W("""
SELECT PrizmCode AS category, round(avg(CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END) * 100, 6) AS rate_pct,
       count(*) AS n
FROM mart GROUP BY PrizmCode""")


def _corr_sql(a: str, b: str, src: str) -> str:
    return (f"""SELECT '{a}' AS column_a, '{b}' AS column_b,
       count(*) FILTER (WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS n,
       CASE WHEN isnan(corr({a}, {b})) THEN NULL ELSE round(corr({a}, {b}), 6) END AS corr FROM {src}""")


ORACLES["p13_correlation_matrix"] = W(_RAW_NUMERIC + _union(
    [_corr_sql(a, b, "rawnum") for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]]), raw=True)

ORACLES["p14_top_target_correlations"] = W(
    ", lab AS (SELECT *, CASE WHEN Churn = 'Yes' THEN 1.0 ELSE 0.0 END AS label FROM mart),\n"
    "c AS (" + _union([f"SELECT '{a}' AS feature, CASE WHEN isnan(corr({a}, label)) THEN NULL "
                       f"ELSE round(corr({a}, label), 6) END AS corr FROM lab" for a in _NUMERIC]) + ")\n"
    """SELECT feature, corr, rank, side FROM (
  SELECT feature, corr, CAST(row_number() OVER (ORDER BY corr DESC, feature) AS INTEGER) AS rank, 'top' AS side
  FROM c WHERE corr IS NOT NULL) WHERE rank <= 10
UNION ALL
SELECT feature, corr, rank, side FROM (
  SELECT feature, corr, CAST(row_number() OVER (ORDER BY corr ASC, feature) AS INTEGER) AS rank, 'bottom' AS side
  FROM c WHERE corr IS NOT NULL) WHERE rank <= 10""")

ORACLES["p15_correlated_pairs"] = W(
    ", c AS (" + _union([_corr_sql(a, b, "mart") for i, a in enumerate(_NUMERIC) for b in _NUMERIC[i + 1:]]) + ")\n"
    "SELECT column_a, column_b, corr FROM c WHERE abs(corr) > 0.7")

ORACLES["p16_iqr_outlier_summary"] = W(_RAW_NUMERIC + _union([
    f"""SELECT '{c}' AS "column",
       (SELECT count(*) FROM rawnum, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM rawnum) b
        WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS outlier_count,
       round(CAST((SELECT count(*) FROM rawnum, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM rawnum) b
        WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS DOUBLE) * 100.0 / (SELECT count(*) FROM rawnum), 6)
         AS outlier_pct"""
    for c in _NUMERIC]), raw=True)

ORACLES["p17_non_numeric_audit"] = W(_union([
    f"""SELECT '{c}' AS "column", count(*) AS non_numeric_count,
       list_slice(list_sort(list_distinct(list({c}))), 1, 5) AS examples
FROM raw WHERE {c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL HAVING count(*) > 0"""
    for c in ROLES.discrete]), raw=True)

ORACLES["p18_density"] = W("""
, d AS (SELECT label, p1 AS x FROM scored),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM d),
st AS (SELECT label, count(*) AS n, stddev_samp(x) AS sd FROM d GROUP BY label),
cnt AS (SELECT label, x, count(*) AS cnt FROM d GROUP BY label, x),
g AS (SELECT CAST(range AS INTEGER) AS g FROM range(100)),
e AS (SELECT cnt.label, g.g, mn + g.g * (mx - mn) / 99 AS xg, cnt, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, x
      FROM cnt JOIN st USING (label) CROSS JOIN g CROSS JOIN mm)
SELECT label, g AS grid_idx, round(xg, 6) AS x,
       round(sum(cnt * exp(-0.5 * ((xg - x) / bw) * ((xg - x) / bw)) / (n * bw * sqrt(2 * pi()))), 6) AS density
FROM e GROUP BY label, g, xg""", scored=True)


# --------------------------------------------------------------------------- cleaning
_CATS = list(ROLES.categorical)
_BINS = list(ROLES.binary)


def _med(c, src="raw"):
    return f"(SELECT quantile_cont({c}, 0.5) FROM {src})"


def _mode(c, src="raw"):
    return f"(SELECT {c} FROM {src} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


ORACLES["c01_coerce_numeric"] = W(
    "SELECT CustomerID, " + ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in ROLES.discrete) + " FROM raw", raw=True)

ORACLES["c02_sparse_columns"] = W(_union([
    f"""SELECT '{c}' AS "column", round(CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / count(*), 6) AS null_pct,
       CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0 / count(*) > 70.0 AS dropped FROM raw"""
    for c in MART_COLUMNS]), raw=True)

_FIT = _RAW_NUMERIC + ", fitrows AS (SELECT * FROM rawnum WHERE (CustomerID * 7919) % 1009 < 700)\n"
ORACLES["c03_impute_median"] = W(
    _FIT + "SELECT CustomerID, " + ", ".join(f"round(coalesce({c}, {_med(c, 'fitrows')}), 6) AS {c}" for c in _NUMERIC)
    + " FROM rawnum", raw=True)

ORACLES["c05_impute_mode"] = W(
    _FIT + "SELECT CustomerID, " + ", ".join(f"coalesce({c}, {_mode(c, 'fitrows')}) AS {c}" for c in _CATS + _BINS)
    + " FROM raw", raw=True)

ORACLES["c06_impute_self"] = W(
    _RAW_NUMERIC + "SELECT CustomerID, " + ", ".join(f"round(coalesce({c}, {_med(c, 'rawnum')}), 6) AS {c}" for c in _NUMERIC)
    + ", " + ", ".join(f"coalesce({c}, {_mode(c)}) AS {c}" for c in _CATS + _BINS) + " FROM rawnum", raw=True)

ORACLES["c07_second_pass_impute"] = W(
    _FIT + "SELECT CustomerID, " + ", ".join(f"round(coalesce({c}, (SELECT avg({c}) FROM fitrows)), 6) AS {c}" for c in _NUMERIC)
    + ", " + ", ".join(f"coalesce({c}, {_mode(c, 'fitrows')}) AS {c}" for c in _CATS + _BINS) + " FROM rawnum", raw=True)


def _zflag(c, src):
    return (f"(SELECT count(*) FILTER (WHERE abs(({c} - m) / s) > 3) FROM {src}, "
            f"(SELECT avg({c}) AS m, stddev_samp({c}) AS s FROM {src}) st)")


def _clip_expr(c, src="raw"):
    q = f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {src})"
    lo = f"(SELECT q1 - 1.5 * (q3 - q1) FROM {q})"
    hi = f"(SELECT q3 + 1.5 * (q3 - q1) FROM {q})"
    return (f"CASE WHEN {_zflag(c, src)} = 0 THEN {c} WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} "
            f"ELSE {c} END")


ORACLES["c08_outlier_clip"] = W(
    "SELECT CustomerID, " + ", ".join(f"round({_clip_expr(c)}, 6) AS {c}" for c in _CONT) + " FROM raw", raw=True)


def _seq_remove() -> str:
    ctes = [f", t0 AS (SELECT CustomerID, {', '.join(_CONT)} FROM raw)"]
    for i, c in enumerate(_CONT):
        prev = f"t{i}"
        ctes.append(f"t{i + 1} AS (SELECT * FROM {prev} WHERE NOT coalesce(abs(({c} - "
                    f"(SELECT avg({c}) FROM {prev})) / (SELECT stddev_samp({c}) FROM {prev})) > 3, false))")
    return ",\n".join(ctes) + f"\nSELECT CustomerID FROM t{len(_CONT)}"


ORACLES["c09_outlier_remove"] = W(_seq_remove(), raw=True)


def _impute_expr(c, src="raw"):
    z = f"abs(({c} - (SELECT avg({c}) FROM {src})) / (SELECT stddev_samp({c}) FROM {src})) > 3"
    return f"CASE WHEN {_zflag(c, src)} > 0 AND coalesce({z}, false) THEN {_med(c, src)} ELSE {c} END"


ORACLES["c10_outlier_impute"] = W(
    "SELECT CustomerID, " + ", ".join(f"round({_impute_expr(c)}, 6) AS {c}" for c in _CONT) + " FROM raw", raw=True)

_ALIGN = sorted(["CustomerID", "Churn", "MonthlyRevenue", "AgeHH1", "AgeHH2", "PrizmCode"])
ORACLES["c12_align_features"] = W(
    "SELECT " + ", ".join("0 AS AgeHH2" if c == "AgeHH2" else c for c in _ALIGN) + " FROM raw", raw=True)

ORACLES["c13_target_map"] = W(
    "SELECT CustomerID, CAST(CASE WHEN Churn = 'Yes' THEN 1 WHEN Churn = 'No' THEN 0 END AS INTEGER) AS Churn FROM raw",
    raw=True)

# --------------------------------------------------------------------------- encoding
_POS = "('yes', 'y', 'true', 't', '1')"
_NEG = "('no', 'n', 'false', 'f', '0')"
_POLARITY_BINS = [c for c in _BINS if c != "Homeownership"]
ORACLES["e01_encode_binary"] = W(
    "SELECT CustomerID, "
    + ", ".join(f"CAST(CASE WHEN lower({c}) IN {_POS} THEN 1 WHEN lower({c}) IN {_NEG} THEN 0 END AS INTEGER) AS {c}"
                for c in _POLARITY_BINS)
    + ", CAST(dense_rank() OVER (ORDER BY coalesce(Homeownership, 'nan')) - 1 AS INTEGER) AS Homeownership FROM raw",
    raw=True)

ORACLES["e03_strict_binary"] = W(_union([
    f"""SELECT '{c}' AS "column", (count(DISTINCT {c}) = 2 AND bool_and({c} IN ('Yes', 'No'))) AS is_strict_binary
FROM raw WHERE {c} IS NOT NULL""" for c in _CATS + _BINS]), raw=True)

ORACLES["e04_label_encode"] = W(
    "SELECT CustomerID, " + ", ".join(
        f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'nan')) - 1 AS INTEGER) AS {c}" for c in _CATS) + " FROM raw",
    raw=True)

# category lists follow from the mart's definitions (fixed by construction)
_ONE_HOT = {
    "ServiceArea": sorted(f"NATION_{i}" for i in range(25)),
    "CreditRating": ["1-Highest", "2-High", "3-Good", "5-Low", "7-Lowest"],
    "PrizmCode": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "Occupation": ["Clerical", "Crafts", "Other", "Professional", "Retired"],
    "MaritalStatus": ["No", "Unknown", "Yes"],
}


def _one_hot_sql(drop_first: bool) -> str:
    cols = []
    for c, cats in _ONE_HOT.items():
        for v in (cats[1:] if drop_first else cats):
            cols.append(f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{c}_{v}\"")
    return W("SELECT CustomerID, " + ", ".join(cols) + " FROM mart")


ORACLES["e04_label_encode_wide_holdout"] = """
WITH dict AS (SELECT k, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS code FROM (
       SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01')),
most AS (SELECT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, k LIMIT 1)
SELECT l_orderkey, l_linenumber, coalesce(dict.code, (SELECT code FROM dict JOIN most USING (k))) AS key
FROM lineitem LEFT JOIN dict ON dict.k = CAST(l_orderkey AS VARCHAR)"""
ORACLES["e06_one_hot_wide"] = """
WITH dict AS (SELECT k, CAST(row_number() OVER (ORDER BY k) - 1 AS INTEGER) AS code FROM (
       SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS k FROM lineitem WHERE l_shipdate < TIMESTAMP '1997-01-01'))
SELECT l_orderkey, l_linenumber, CAST((SELECT count(*) FROM dict) AS INTEGER) AS size,
       CAST(CASE WHEN code IS NULL THEN 0 ELSE 1 END AS INTEGER) AS non_zeros, code AS place,
       CASE WHEN code IS NOT NULL THEN CAST(1 AS DOUBLE) END AS value
FROM lineitem LEFT JOIN dict ON dict.k = CAST(l_orderkey AS VARCHAR)"""


def _indicator_ctes(cols: list[str], label: str) -> str:
    """ind: n and ANOVA F of every indicator, from the sums over the whole 0 / 1 column."""
    parts = " UNION ALL ".join(f"SELECT '{c}' AS source, CAST({c} AS VARCHAR) AS value, y FROM d WHERE {c} IS NOT NULL" for c in cols)
    return f"""cls AS (SELECT y, count(*) AS ny FROM d GROUP BY y),
tot AS (SELECT CAST(sum(ny) AS DOUBLE) AS n, count(*) AS k FROM cls),
cell AS (SELECT source, value, y, count(*) AS c FROM ({parts}) GROUP BY ALL),
cells AS (SELECT v.source, v.value, cls.ny, coalesce(cell.c, 0) AS c FROM (SELECT DISTINCT source, value FROM cell) AS v
          CROSS JOIN cls LEFT JOIN cell ON cell.source = v.source AND cell.value = v.value AND cell.y = cls.y),
sums AS (SELECT source, value, sum(c) AS n, sum(c * c / CAST(ny AS DOUBLE)) AS a FROM cells GROUP BY ALL),
ind AS (SELECT source, value, CAST(s.n AS BIGINT) AS n,
       CASE WHEN s.n - a > 1e-9 THEN round(((a - s.n * s.n / tot.n) / (tot.k - 1)) / ((s.n - a) / (tot.n - tot.k)), 6) END AS f_score
       FROM sums AS s, tot)"""


def _indicator_corr_cte(cols: list[str], numeric: list[str]) -> str:
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS source, value, '{x}' AS feature,
       CASE WHEN nv < n AND sx > 0 THEN round((xv / n - mx * nv / n) / (sx * sqrt(nv / n * (1 - nv / n))), 6) END AS corr
FROM (SELECT CAST({c} AS VARCHAR) AS value, CAST(count(*) AS DOUBLE) AS nv, sum(CAST({x} AS DOUBLE)) AS xv FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1),
     (SELECT CAST(count(*) AS DOUBLE) AS n, avg(CAST({x} AS DOUBLE)) AS mx, stddev_pop(CAST({x} AS DOUBLE)) AS sx FROM lineitem)"""
        for c in cols for x in numeric)
    return f"icor AS ({parts})"


ORACLES["l02_indicator_f"] = f"""
WITH d AS (SELECT l_partkey, l_orderkey, l_returnflag AS y FROM lineitem WHERE l_returnflag IS NOT NULL),
{_indicator_ctes(["l_partkey", "l_orderkey"], "l_returnflag")}
SELECT source, value, n, f_score FROM ind"""
_LINE_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
ORACLES["l01_indicator_correlation"] = f"""
WITH {_indicator_corr_cte(["l_partkey", "l_suppkey"], _LINE_NUMERIC)}
SELECT source, value, feature, corr FROM icor"""
_LINE_KEYS = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]


def _select_encoded_sql() -> str:
    plain = " UNION ALL ".join(f"SELECT '{c}' AS source, CAST(NULL AS VARCHAR) AS value, y, CAST({c} AS DOUBLE) AS x FROM d" for c in _LINE_NUMERIC)
    again = " OR ".join(f"(source = '{b}' AND abs((SELECT corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) FROM lineitem)) > 0.85)"
                        for i, b in enumerate(_LINE_NUMERIC) for a in _LINE_NUMERIC[:i])
    return f"""
WITH d AS (SELECT *, CASE WHEN l_shipdate >= TIMESTAMP '1997-01-01' THEN 1 ELSE 0 END AS y FROM lineitem),
{_indicator_ctes(_LINE_KEYS, "y")},
{_indicator_corr_cte(_LINE_KEYS, _LINE_NUMERIC)},
xs AS ({plain}),
gm AS (SELECT source, y, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM xs GROUP BY ALL),
am AS (SELECT source, sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS m FROM gm GROUP BY ALL),
num AS (SELECT source, CAST(NULL AS VARCHAR) AS value, round((sum(gm.n * (gm.m - am.m) * (gm.m - am.m)) / (max(am.k) - 1))
       / (sum(gm.n * gm.v) / (max(am.n) - max(am.k))), 6) AS f_score FROM gm JOIN am USING (source) GROUP BY source),
allf AS (SELECT source, value, f_score FROM num WHERE NOT ({again})
         UNION ALL SELECT source, value, f_score FROM ind
         WHERE NOT EXISTS (SELECT 1 FROM icor WHERE icor.source = ind.source AND icor.value = ind.value AND abs(corr) > 0.85)),
rk AS (SELECT *, CAST(row_number() OVER (ORDER BY f_score DESC, source, value NULLS FIRST) AS INTEGER) AS rank
       FROM allf WHERE f_score IS NOT NULL)
SELECT source, value, f_score, rank FROM rk WHERE rank <= 30"""


ORACLES["l02_select_encoded"] = _select_encoded_sql()
ORACLES["e06_one_hot"] = _one_hot_sql(False)
ORACLES["e07_dummies_drop_first"] = _one_hot_sql(True)

ORACLES["e08_scale_standard"] = W("SELECT CustomerID, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM mart)) / (SELECT CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL "
    f"THEN 1 ELSE stddev_pop({c}) END FROM mart), 6) AS {c}" for c in _NUMERIC) + " FROM mart")

ORACLES["e09_scale_minmax"] = W("SELECT CustomerID, " + ", ".join(
    f"round(({c} - (SELECT min({c}) FROM mart)) / (SELECT CASE WHEN max({c}) - min({c}) = 0 THEN 1 "
    f"ELSE max({c}) - min({c}) END FROM mart), 6) AS {c}" for c in _NUMERIC) + " FROM mart")

ORACLES["e10_scale_robust"] = W("SELECT CustomerID, " + ", ".join(
    f"round(({c} - (SELECT quantile_cont({c}, 0.5) FROM mart)) / (SELECT CASE WHEN quantile_cont({c}, 0.75) = "
    f"quantile_cont({c}, 0.25) THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END FROM mart), 6) AS {c}"
    for c in _NUMERIC) + " FROM mart")

_STRING_COLS = _CATS + _BINS
ORACLES["e12_prepare_for_model"] = W("SELECT " + ", ".join(
    f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}" if c in _STRING_COLS else c
    for c in MART_COLUMNS) + " FROM mart")


# --------------------------------------------------------------------------- metrics
def S(body: str) -> str:
    """Oracle over the scored table with ``s1`` = (id, label, prob = p1)."""
    return W(", s1 AS (SELECT id, label, p1 AS prob FROM scored)\n" + body, scored=True)


def _div0(a: str, b: str) -> str:
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END)"


def _metric_cols(tp="tp", fp="fp", tn="tn", fn="fn") -> dict[str, str]:
    prec = _div0(tp, f"{tp} + {fp}")
    rec = _div0(tp, f"{tp} + {fn}")
    return {"accuracy": _div0(f"{tp} + {tn}", f"{tp} + {fp} + {tn} + {fn}"), "precision": prec, "recall": rec,
            "f1": _div0(f"2 * {prec} * {rec}", f"{prec} + {rec}")}


_CM = """count(*) FILTER (WHERE label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND prob >= 0.5) AS fp,
       count(*) FILTER (WHERE label <> 1 AND prob < 0.5) AS tn, count(*) FILTER (WHERE label = 1 AND prob < 0.5) AS fn"""

ORACLES["v01_confusion_matrix"] = S(f"SELECT {_CM} FROM s1")
ORACLES["v02_classification_metrics"] = S(
    f", cm AS (SELECT {_CM} FROM s1)\nSELECT tp, fp, tn, fn, "
    + ", ".join(f"round({e}, 6) AS {k}" for k, e in _metric_cols().items()) + " FROM cm")

_SC = """, sc AS (SELECT prob AS score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
                 CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM s1 GROUP BY prob),
asc_c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM sc),
desc_c AS (SELECT *, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                     sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                     (SELECT sum(pos) FROM sc) AS P, (SELECT sum(neg) FROM sc) AS N FROM sc)
"""
ORACLES["v03_roc_auc"] = S(_SC + """SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0
  THEN sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 6) AS roc_auc FROM asc_c""")
ORACLES["v04_average_precision"] = S(_SC + """SELECT round(CASE WHEN max(P) > 0
  THEN sum((pos / P) * (cum_pos / (cum_pos + cum_neg))) END, 6) AS average_precision FROM desc_c""")
ORACLES["v05_roc_curve"] = S(_SC + f"""SELECT score AS threshold, round({_div0('cum_neg', 'N')}, 6) AS fpr,
       round({_div0('cum_pos', 'P')}, 6) AS tpr FROM desc_c
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0, 0.0""")
ORACLES["v06_pr_curve"] = S(_SC + f"""SELECT score AS threshold, round(cum_pos / (cum_pos + cum_neg), 6) AS precision,
       round({_div0('cum_pos', 'P')}, 6) AS recall, round({_div0('P', 'P + N')}, 6) AS baseline FROM desc_c""")

_m = {k: e for k, e in _metric_cols().items()}
ORACLES["v07_classification_report"] = S(f"""
, cm AS (SELECT {_CM} FROM s1),
pr AS (SELECT tp, fp, tn, fn, {_div0('tp', 'tp + fp')} AS p1, {_div0('tp', 'tp + fn')} AS r1,
              {_div0('tn', 'tn + fn')} AS p0, {_div0('tn', 'tn + fp')} AS r0, tp + fn AS s1, tn + fp AS s0 FROM cm),
f AS (SELECT *, {_div0('2 * p1 * r1', 'p1 + r1')} AS f1_1, {_div0('2 * p0 * r0', 'p0 + r0')} AS f1_0, s0 + s1 AS n FROM pr)
SELECT '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f1_0, 6) AS f1, s0 AS support FROM f
UNION ALL SELECT '1', round(p1, 6), round(r1, 6), round(f1_1, 6), s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round({_div0('tp + tn', 'n')}, 6), n FROM f
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f1_0 + f1_1) / 2, 6), n FROM f
UNION ALL SELECT 'weighted avg', round({_div0('p0 * s0 + p1 * s1', 'n')}, 6), round({_div0('r0 * s0 + r1 * s1', 'n')}, 6),
                 round({_div0('f1_0 * s0 + f1_1 * s1', 'n')}, 6), n FROM f""")

_SWEEP = """, g AS (SELECT range AS i, CAST(0.01 AS DOUBLE) + CAST(range - 1 AS DOUBLE) * CAST(0.01 AS DOUBLE) AS t
           FROM range(1, 100)),
cmg AS (SELECT i, t, count(*) FILTER (WHERE label = 1 AND prob >= t) AS tp, count(*) FILTER (WHERE label <> 1 AND prob >= t) AS fp,
               count(*) FILTER (WHERE label <> 1 AND prob < t) AS tn, count(*) FILTER (WHERE label = 1 AND prob < t) AS fn
        FROM g CROSS JOIN s1 GROUP BY i, t),
sweep AS (SELECT i, round(t, 6) AS threshold, tp, fp, tn, fn, """ + ", ".join(
    f"round({e}, 6) AS {k}" for k, e in _metric_cols().items()) + " FROM cmg)\n"
ORACLES["v08_threshold_sweep"] = S(_SWEEP + "SELECT threshold, tp, fp, tn, fn, accuracy, precision, recall, f1 FROM sweep")
ORACLES["v08_best_threshold"] = S(_SWEEP + "SELECT threshold, f1 AS score FROM sweep ORDER BY f1 DESC, i LIMIT 1")

ORACLES["v10_calibration"] = S("""
, edges AS (SELECT CAST(range AS DOUBLE) * CAST(0.1 AS DOUBLE) AS e FROM range(0, 11)),
b AS (SELECT prob, label, (SELECT count(*) FROM edges WHERE e <= prob) - 1 AS raw_bin FROM s1)
SELECT CAST(CASE WHEN raw_bin < 0 THEN 0 WHEN raw_bin > 9 THEN 9 ELSE raw_bin END AS INTEGER) AS bin,
       round(avg(prob), 6) AS prob_pred, round(avg(CAST(label AS DOUBLE)), 6) AS prob_true, count(*) AS count
FROM b GROUP BY 1""")


def _model_metrics_cte(models) -> str:
    parts = []
    for m in models:
        parts.append(f"""m_{m} AS (
  SELECT {', '.join(f'round({e}, 6) AS {k}' for k, e in _metric_cols().items())},
         (SELECT round(CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END, 6)
          FROM (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
                FROM (SELECT {m} AS score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
                             CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM scored GROUP BY {m}))) AS roc_auc
  FROM (SELECT count(*) FILTER (WHERE label = 1 AND {m} >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND {m} >= 0.5) AS fp,
               count(*) FILTER (WHERE label <> 1 AND {m} < 0.5) AS tn, count(*) FILTER (WHERE label = 1 AND {m} < 0.5) AS fn
        FROM scored))""")
    return ", " + ",\n".join(parts) + "\n"


_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def _compare_sql(models) -> str:
    return _model_metrics_cte(models) + _union([
        f"SELECT '{k}' AS metric, " + ", ".join(f"(SELECT CAST({k} AS DOUBLE) FROM m_{m}) AS {m}" for m in models)
        for k in _METRICS])


ORACLES["v12_compare_models"] = W(_compare_sql(["p1", "p2", "p3"]), scored=True)
ORACLES["v13_best_model"] = W(
    _model_metrics_cte(["p1", "p2", "p3"]) + """
SELECT 'f1' AS metric,
       CASE WHEN (SELECT f1 FROM m_p1) >= (SELECT f1 FROM m_p2) AND (SELECT f1 FROM m_p1) >= (SELECT f1 FROM m_p3) THEN 'p1'
            WHEN (SELECT f1 FROM m_p2) >= (SELECT f1 FROM m_p3) THEN 'p2' ELSE 'p3' END AS best_model,
       greatest((SELECT f1 FROM m_p1), (SELECT f1 FROM m_p2), (SELECT f1 FROM m_p3)) AS value""", scored=True)
ORACLES["v14_improvement_table"] = W(_model_metrics_cte(["p2", "p1"]) + _union([
    f"""SELECT '{k}' AS metric, (SELECT CAST({k} AS DOUBLE) FROM m_p2) AS base, (SELECT CAST({k} AS DOUBLE) FROM m_p1) AS new,
       round((SELECT {k} FROM m_p1) - (SELECT {k} FROM m_p2), 6) AS abs_improvement,
       round(CASE WHEN (SELECT {k} FROM m_p2) <> 0 THEN ((SELECT {k} FROM m_p1) - (SELECT {k} FROM m_p2)) / (SELECT {k} FROM m_p2) * 100 END, 6)
         AS pct_improvement""" for k in _METRICS]), scored=True)


def _impact_select(keys: str = "") -> str:
    return f"""SELECT {keys}tp + fp + tn + fn AS total_customers, tp + fn AS actual_churners, tp + fp AS predicted_churners,
       tp, fp, tn, fn, round(tp * CAST(0.3 AS DOUBLE), 6) AS retained_customers, round(tp * CAST(0.3 AS DOUBLE) * CAST(1000.0 AS DOUBLE), 6) AS retention_value,
       round(fp * CAST(200.0 AS DOUBLE), 6) AS wasted_retention_cost, round(fn * CAST(1000.0 AS DOUBLE), 6) AS missed_churn_cost,
       round((tp + fp) * CAST(200.0 AS DOUBLE), 6) AS total_retention_cost,
       round(tp * CAST(0.3 AS DOUBLE) * CAST(1000.0 AS DOUBLE) - (tp + fp) * CAST(200.0 AS DOUBLE), 6) AS net_value,
       round(CASE WHEN (tp + fp) * CAST(200.0 AS DOUBLE) > 0 THEN (tp * CAST(0.3 AS DOUBLE) * CAST(1000.0 AS DOUBLE) - (tp + fp) * CAST(200.0 AS DOUBLE)) / ((tp + fp) * CAST(200.0 AS DOUBLE)) ELSE CAST(0.0 AS DOUBLE) END, 6) AS roi"""


ORACLES["v15_business_impact"] = S(f", cm AS (SELECT {_CM} FROM s1)\n" + _impact_select() + " FROM cm")
ORACLES["v16_impact_by_model"] = W(
    ", lg AS (SELECT id, label, 'p1' AS model, p1 AS prob FROM scored UNION ALL SELECT id, label, 'p2', p2 FROM scored "
    "UNION ALL SELECT id, label, 'p3', p3 FROM scored),\n"
    f"cm AS (SELECT model, {_CM} FROM lg GROUP BY model)\n" + _impact_select("model, ") + " FROM cm", scored=True)
ORACLES["v17_top_risk"] = W("SELECT * FROM scored ORDER BY p3 DESC, id LIMIT 20", scored=True)

# --------------------------------------------------------------------------- ensembles
ORACLES["b02_voting"] = W("""SELECT id, label,
  CASE WHEN ((CASE WHEN p1 >= 0.5 THEN 1 ELSE 0 END) * CAST(1/3 AS DOUBLE) + (CASE WHEN p2 >= 0.5 THEN 1 ELSE 0 END) * CAST(1/3 AS DOUBLE)
             + (CASE WHEN p3 >= 0.5 THEN 1 ELSE 0 END) * CAST(1/3 AS DOUBLE)) / 1.0 >= 0.5 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS ensemble
FROM scored""", scored=True)
ORACLES["b03_averaging"] = W("SELECT id, label, round((p1 + p2 + p3) / 3, 6) AS ensemble FROM scored", scored=True)
ORACLES["b04_weighted"] = W("SELECT id, label, round(p1 * 0.5 + p2 * 0.3 + p3 * 0.2, 6) AS ensemble FROM scored",
                            scored=True)


def _blend_sql(models, metric) -> str:
    from retentio.operators.ensemble import blend_grid
    combos = blend_grid(len(models))
    vals = ", ".join("(" + ", ".join([str(i)] + [f"CAST('{w!r}' AS DOUBLE)" for w in c]) + ")"
                     for i, c in enumerate(combos))
    wcols = ", ".join(f"w{j}" for j in range(len(models)))
    blended = " + ".join(f"{m} * w{j}" for j, m in enumerate(models))
    head = f", grid(combo, {wcols}) AS (VALUES {vals}),\nbl AS (SELECT combo, label, {blended} AS prob FROM grid CROSS JOIN scored)"
    if metric == "auc":
        body = """,
sc AS (SELECT combo, prob AS score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
              CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM bl GROUP BY combo, prob),
c AS (SELECT *, sum(neg) OVER (PARTITION BY combo ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg FROM sc),
res AS (SELECT combo, CASE WHEN sum(pos) > 0 AND sum(neg) > 0 THEN sum(pos * (cum_neg - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) END AS score
        FROM c GROUP BY combo)"""
    elif metric == "average_precision":
        body = """,
sc AS (SELECT combo, prob AS score, CAST(count(*) FILTER (WHERE label = 1) AS DOUBLE) AS pos,
              CAST(count(*) FILTER (WHERE label <> 1) AS DOUBLE) AS neg FROM bl GROUP BY combo, prob),
c AS (SELECT *, sum(pos) OVER (PARTITION BY combo ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
                sum(neg) OVER (PARTITION BY combo ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg,
                sum(pos) OVER (PARTITION BY combo) AS P FROM sc),
res AS (SELECT combo, sum(pos / P * cum_pos / (cum_pos + cum_neg)) AS score FROM c GROUP BY combo)"""
    else:
        m = _metric_cols()[metric]
        body = f""",
cm AS (SELECT combo, count(*) FILTER (WHERE label = 1 AND prob >= 0.5) AS tp, count(*) FILTER (WHERE label <> 1 AND prob >= 0.5) AS fp,
              count(*) FILTER (WHERE label <> 1 AND prob < 0.5) AS tn, count(*) FILTER (WHERE label = 1 AND prob < 0.5) AS fn
       FROM bl GROUP BY combo),
res AS (SELECT combo, {m} AS score FROM cm)"""
    sel = ", ".join(f"round(w{j}, 6) AS w_{mm}" for j, mm in enumerate(models))
    return W(head + body + f"\nSELECT {sel}, round(score, 6) AS score FROM res JOIN grid USING (combo) "
             "WHERE score IS NOT NULL ORDER BY score DESC, combo LIMIT 1", scored=True)


ORACLES["b06_blend_auc"] = _blend_sql(["p1", "p2", "p3"], "auc")
ORACLES["b06_blend_f1_two_models"] = _blend_sql(["p1", "p2"], "f1")
ORACLES["b08_blend_average_precision"] = _blend_sql(["p1", "p3"], "average_precision")

_ENS = "(p1 * 0.5 + p2 * 0.3 + p3 * 0.2)"
ORACLES["b09_contributions"] = W(_union([
    f"SELECT '{m}' AS model, round(corr({m}, {_ENS}), 6) AS correlation, CAST({w} AS DOUBLE) AS weight FROM scored"
    for m, w in zip(["p1", "p2", "p3"], [0.5, 0.3, 0.2])]), scored=True)
ORACLES["b10_contributions_detailed"] = W(_union([
    f"SELECT '{m}' AS model, round(corr({m}, {_ENS}), 6) AS correlation, CAST({w} AS DOUBLE) AS weight, "
    f"CAST({w} AS DOUBLE) AS unique_contribution FROM scored"
    for m, w in zip(["p1", "p2", "p3"], [0.5, 0.3, 0.2])]), scored=True)


# --------------------------------------------------------------------------- splits & resampling
def _key(seed):
    return f"((CustomerID * 7919 + {seed}) % 1000003)"


def _split_sql(frac, seed, stratify=True) -> str:
    part = "PARTITION BY Churn " if stratify else ""
    cnt = "count(*) OVER (PARTITION BY Churn)" if stratify else "count(*) OVER ()"
    return W(f"""
, rk AS (SELECT CustomerID, Churn, row_number() OVER ({part}ORDER BY {_key(seed)}, CustomerID) AS r,
                floor(CAST({cnt} AS DOUBLE) * CAST({frac} AS DOUBLE) + 0.5) AS cut FROM mart)
SELECT CustomerID, Churn, CASE WHEN r <= cut THEN 'test' ELSE 'train' END AS split FROM rk""")


ORACLES["r01_stratified_split"] = _split_sql(0.2, 42)
ORACLES["r02_random_split"] = _split_sql(0.2, 7, stratify=False)
ORACLES["r03_three_way_split"] = W(f"""
, rk AS (SELECT CustomerID, Churn, row_number() OVER (PARTITION BY Churn ORDER BY {_key(42)}, CustomerID) AS r,
                floor(CAST(count(*) OVER (PARTITION BY Churn) AS DOUBLE) * CAST(0.3 AS DOUBLE) + 0.5) AS temp FROM mart)
SELECT CustomerID, Churn,
       CASE WHEN r <= floor(temp * CAST(0.5 AS DOUBLE) + 0.5) THEN 'test' WHEN r <= temp THEN 'val' ELSE 'train' END AS split
FROM rk""")
ORACLES["r04_stratified_kfold"] = W(f"""
SELECT CustomerID, Churn,
       CAST((row_number() OVER (PARTITION BY Churn ORDER BY {_key(42)}, CustomerID) - 1) % 5 AS INTEGER) AS fold FROM mart""")
_UNDER = f"""
, cc AS (SELECT Churn, count(*) AS n FROM mart GROUP BY Churn),
mino AS (SELECT Churn, n FROM cc ORDER BY n, Churn LIMIT 1),
majo AS (SELECT Churn, n FROM cc ORDER BY n DESC, Churn DESC LIMIT 1),
under AS (
  SELECT CustomerID, Churn FROM mart WHERE Churn = (SELECT Churn FROM mino)
  UNION ALL
  SELECT CustomerID, Churn FROM (
    SELECT CustomerID, Churn, row_number() OVER (ORDER BY {_key(42)}, CustomerID) AS r FROM mart
    WHERE Churn = (SELECT Churn FROM majo))
  WHERE r <= CAST(floor(CAST((SELECT n FROM mino) AS DOUBLE) / 1.0) AS BIGINT))
"""
ORACLES["r05_undersample"] = W(_UNDER + "SELECT * FROM under")
ORACLES["r09_class_weights"] = W("""
SELECT Churn, count(*) AS count,
       round(CAST((SELECT count(*) FROM mart) AS DOUBLE) / ((SELECT count(DISTINCT Churn) FROM mart) * count(*)), 6) AS weight
FROM mart GROUP BY Churn""")
ORACLES["r10_scale_pos_weight"] = W("""
SELECT count(*) FILTER (WHERE label = 0) AS neg, count(*) FILTER (WHERE label = 1) AS pos,
       round(CASE WHEN count(*) FILTER (WHERE label = 1) > 0
             THEN CAST(count(*) FILTER (WHERE label = 0) AS DOUBLE) / count(*) FILTER (WHERE label = 1) ELSE 1.0 END, 6)
         AS scale_pos_weight FROM scored""", scored=True)
ORACLES["r11_class_distribution"] = W(_UNDER + """
SELECT 'before' AS stage, Churn, count(*) AS count, round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM mart), 6) AS pct
FROM mart GROUP BY Churn
UNION ALL
SELECT 'after', Churn, count(*), round(CAST(count(*) AS DOUBLE) * 100.0 / (SELECT count(*) FROM under), 6) FROM under GROUP BY Churn""")



def _resampled(majority: str, ratio: str) -> str:
    """Class counts after SMOTE up to ``ratio`` of ``majority`` (an expression over small / large)."""
    return W(f""",
cls AS (SELECT CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, count(*) AS n FROM mart GROUP BY 1),
lim AS (SELECT CAST(min(n) AS DOUBLE) AS small, CAST(max(n) AS DOUBLE) AS large FROM cls),
tgt AS (SELECT small, {majority} AS maj FROM lim),
aft AS (SELECT label, CASE WHEN n = small THEN greatest(n, CAST(floor({ratio} * maj) AS BIGINT)) ELSE CAST(maj AS BIGINT) END AS count,
               CASE WHEN n = small THEN n ELSE CAST(maj AS BIGINT) END AS original FROM cls, tgt)
SELECT label, count, original, count - original AS synthetic, CAST(0 AS BIGINT) AS outside_hull FROM aft""")


ORACLES["r06_smote"] = _resampled("large", "1.0")
ORACLES["r07_hybrid"] = _resampled("CASE WHEN small / large < 0.3 THEN least(large, floor(small / 0.3)) ELSE large END", "0.5")

# --------------------------------------------------------------------------- selection & statistics
_LAB = ", lab AS (SELECT *, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label FROM mart)\n"

ORACLES["l01_drop_correlated"] = W(
    ", pairs AS (" + _union([
        f"SELECT {i} AS i, {j} AS j, round(corr({a}, {b}), 6) AS c FROM mart"
        for i, a in enumerate(_NUMERIC) for j, b in enumerate(_NUMERIC) if i < j]) + "),\n"
    "names(feature, ordinal) AS (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(_NUMERIC)) + ")\n"
    "SELECT feature, CAST(ordinal AS INTEGER) AS ordinal, "
    "EXISTS (SELECT 1 FROM pairs WHERE j = ordinal AND abs(c) > 0.85 AND NOT isnan(c)) AS dropped FROM names")


def _anova_sql(f: str) -> str:
    return f"""SELECT '{f}' AS feature, round(CASE WHEN k > 1 AND n > k AND (sstot - ssbn) / (n - k) > 0
  THEN (ssbn / (k - 1)) / ((sstot - ssbn) / (n - k)) END, 6) AS f_score
FROM (SELECT sum(ng) AS n, count(*) AS k, ss - s * s / sum(ng) AS sstot, sum(sg * sg / ng) - s * s / sum(ng) AS ssbn
      FROM (SELECT label, count({f}) AS ng, sum({f}) AS sg,
                   (SELECT sum({f} * {f}) FROM lab) AS ss, (SELECT sum({f}) FROM lab) AS s
            FROM lab WHERE {f} IS NOT NULL GROUP BY label) GROUP BY ss, s)"""


ORACLES["l02_select_k_best_anova"] = W(
    _LAB + ", sc AS (" + _union([_anova_sql(f) for f in _NUMERIC]) + "),\n"
    "names(feature, ordinal) AS (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(_NUMERIC)) + ")\n"
    "SELECT feature, f_score AS score, CAST(row_number() OVER (ORDER BY f_score DESC NULLS LAST, ordinal) AS INTEGER) AS rank, "
    "row_number() OVER (ORDER BY f_score DESC NULLS LAST, ordinal) <= 10 AS selected FROM sc JOIN names USING (feature)")

_DECILES = "[" + ", ".join(f"CAST('{p!r}' AS DOUBLE)" for p in [i * 0.1 for i in range(10)] + [1.0]) + "]"


def _bins_sql(numeric, categorical) -> str:
    parts = []
    for f in numeric:
        parts.append(f"""SELECT '{f}' AS feature, CAST(greatest((SELECT count(*) FROM (SELECT DISTINCT unnest(quantile_cont({f}, {_DECILES})) AS e FROM lab) WHERE e < {f}), 1) AS VARCHAR) AS bin, label
FROM lab WHERE {f} IS NOT NULL
  AND (SELECT count(DISTINCT e) FROM (SELECT unnest(quantile_cont({f}, {_DECILES})) AS e FROM lab)) >= 2""")
    for f in categorical:
        parts.append(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS bin, label FROM lab WHERE {f} IS NOT NULL")
    return _union(parts)


def _woe_ctes(numeric, categorical) -> str:
    return (_LAB + ", b AS (" + _bins_sql(numeric, categorical) + "),\n" + """
g AS (SELECT feature, bin, count(*) AS count, sum(CAST(label AS DOUBLE)) AS events FROM b GROUP BY feature, bin),
g2 AS (SELECT *, count - events AS non_events, sum(events) OVER (PARTITION BY feature) AS te,
              sum(count - events) OVER (PARTITION BY feature) AS tn FROM g),
w AS (SELECT feature, bin, count, events, non_events, events / te AS event_pct, non_events / tn AS non_event_pct,
             CASE WHEN events = 0 AND non_events > 0 THEN CAST('-Infinity' AS DOUBLE)
                  WHEN non_events = 0 AND events > 0 THEN CAST('Infinity' AS DOUBLE)
                  ELSE ln((events / te) / (non_events / tn)) END AS woe,
             CASE WHEN events = 0 OR non_events = 0 THEN CAST('Infinity' AS DOUBLE)
                  ELSE (events / te - non_events / tn) * ln((events / te) / (non_events / tn)) END AS iv_part FROM g2)
""")


_WOE_NUM = ["MonthlyRevenue", "CurrentEquipmentDays", "MonthsInService"]
ORACLES["l08_woe_table"] = W(_woe_ctes(_WOE_NUM, ["PrizmCode"]) + """
SELECT feature, bin, count, round(events, 6) AS events, round(non_events, 6) AS non_events, round(event_pct, 6) AS event_pct,
       round(non_event_pct, 6) AS non_event_pct, round(woe, 6) AS woe, round(iv_part, 6) AS iv_part FROM w""")
ORACLES["l08_information_value"] = W(_woe_ctes(_NUMERIC, _CATS) + """
SELECT feature, round(sum(iv_part), 6) AS iv,
       CASE WHEN sum(iv_part) <= 0.02 THEN 'Useless' WHEN sum(iv_part) <= 0.1 THEN 'Weak'
            WHEN sum(iv_part) <= 0.3 THEN 'Medium' WHEN sum(iv_part) <= 0.5 THEN 'Strong' ELSE 'Very Strong' END AS strength
FROM w GROUP BY feature""")
ORACLES["l04_mutual_info_binned"] = W(_LAB + ", b AS (" + _bins_sql(_NUMERIC, []) + "),\n" + """
j AS (SELECT feature, bin, label, CAST(count(*) AS DOUBLE) AS nxy FROM b GROUP BY ALL),
j2 AS (SELECT *, sum(nxy) OVER (PARTITION BY feature, bin) AS nx, sum(nxy) OVER (PARTITION BY feature, label) AS ny,
              sum(nxy) OVER (PARTITION BY feature) AS n FROM j)
SELECT feature, round(sum(nxy / n * ln(nxy * n / (nx * ny))), 6) AS mutual_info FROM j2 GROUP BY feature""")



def _psi(n: str) -> str:
    n = f"CAST({n} AS DOUBLE)"
    y = f"({n} + 6)"
    return (f"(ln({y}) - 1 / (2 * {y}) - 1 / (12 * {y} * {y}) + 1 / (120 * pow({y}, 4)) - 1 / (252 * pow({y}, 6)) - "
            + " - ".join(f"1 / ({n} + {i})" for i in range(6)) + ")")


_NEAR_ENDS = ", ".join(
    "CASE WHEN lag(v, {b}) OVER w IS NOT NULL AND lead(v, {a}) OVER w IS NOT NULL THEN "
    "greatest(v - lag(v, {b}) OVER w, lead(v, {a}) OVER w - v) END AS r{b}".format(b=j, a=3 - j) for j in range(4))
ORACLES["l04_mutual_info_neighbours"] = W(_LAB + ", l AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS feature, label, CAST({f} AS DOUBLE) AS v FROM lab WHERE {f} IS NOT NULL" for f in _NUMERIC) + f"""),
g AS MATERIALIZED (SELECT feature, label, v, count(*) AS c FROM l GROUP BY feature, label, v),
nc AS (SELECT feature, label, sum(c) AS nc FROM g GROUP BY feature, label),
rr AS (SELECT feature, label, v, {_NEAR_ENDS} FROM l WINDOW w AS (PARTITION BY feature, label ORDER BY v)),
r AS MATERIALIZED (SELECT feature, label, v, min(least(coalesce(r0, 1e300), coalesce(r1, 1e300), coalesce(r2, 1e300), coalesce(r3, 1e300))) AS r
      FROM rr GROUP BY feature, label, v),
p AS MATERIALIZED (SELECT feature, v, sum(c) AS c FROM g GROUP BY feature, v),
m AS (SELECT r.feature, r.label, r.v, sum(p.c) AS m FROM r JOIN p ON r.feature = p.feature
        AND ((r.r = 0 AND p.v = r.v) OR (r.r > 0 AND p.v > r.v - r.r * (1 - 1e-9) AND p.v < r.v + r.r * (1 - 1e-9)))
      GROUP BY r.feature, r.label, r.v)
SELECT feature, round(greatest({_psi('n')} + mean, 0), 6) AS mutual_info FROM (
  SELECT g.feature, sum(g.c) AS n, sum(g.c * ({_psi('CASE WHEN r.r = 0 THEN g.c ELSE 3 END')} - {_psi('nc.nc')} - {_psi('m.m')})) / sum(g.c) AS mean
  FROM g JOIN r ON g.feature = r.feature AND g.label = r.label AND g.v = r.v JOIN m ON g.feature = m.feature AND g.label = m.label AND g.v = m.v
  JOIN nc ON g.feature = nc.feature AND g.label = nc.label GROUP BY g.feature) AS q""")

# --------------------------------------------------------------------------- sequences & forecast
ORACLES["t02_sequences"] = W("""
, s AS (SELECT id, t AS t_end,
       CAST(lag(n, 2) OVER w AS DOUBLE) AS x0_n, CAST(lag(n_error, 2) OVER w AS DOUBLE) AS x0_n_error,
       CAST(lag(n, 1) OVER w AS DOUBLE) AS x1_n, CAST(lag(n_error, 1) OVER w AS DOUBLE) AS x1_n_error,
       CAST(n AS DOUBLE) AS x2_n, CAST(n_error AS DOUBLE) AS x2_n_error,
       lead(label, 1) OVER w AS label_next, row_number() OVER w AS rn
  FROM usage WINDOW w AS (PARTITION BY id ORDER BY t))
SELECT id, t_end, x0_n, x0_n_error, x1_n, x1_n_error, x2_n, x2_n_error, label_next FROM s
WHERE rn >= 3 AND label_next IS NOT NULL""", usage=True, mart=False)

_BASES = {"usage": ["n", "n_error"], "spend": ["value"]}
_PERIOD = ",\n".join(irls_ctes(f"per_{b}", "usage", f, "label", group="t") for b, f in _BASES.items())


def _series_sql() -> str:
    """The fitted chain: per_<base> (coefficients per period), all_<base> and seq (one row each), and
    us, the panel with the scores of the models over all periods."""
    scored = ", ".join("coalesce({}, 0) AS p_{}".format(logistic_sql([f"{b}.b{i}" for i in range(len(f) + 1)], [f"u.{c}" for c in f]), b)
                       for b, f in _BASES.items())
    joins = " ".join(f"LEFT JOIN per_{b} AS {b} ON u.t = {b}.grp" for b in _BASES)
    xs = [f"x{s}_p_{b}" for s in range(3) for b in _BASES]
    lags = ", ".join(f"lag(p_{b}, {2 - s}) OVER w AS x{s}_p_{b}" if s < 2 else f"p_{b} AS x2_p_{b}" for s in range(3) for b in _BASES)
    overall = ", ".join("{} AS p_{}".format(logistic_sql([f"(SELECT b{i} FROM all_{b})" for i in range(len(f) + 1)], f), b)
                        for b, f in _BASES.items())
    return ",\n" + ",\n".join([
        _PERIOD,
        f"ps AS MATERIALIZED (SELECT u.id, u.t, u.label, {scored} FROM usage AS u {joins})",
        f"""sq AS MATERIALIZED (SELECT * FROM (SELECT id, t AS t_end, {lags}, lead(label, 1) OVER w AS label_next, row_number() OVER w AS rn
  FROM ps WINDOW w AS (PARTITION BY id ORDER BY t)) AS q WHERE rn >= 3 AND label_next IS NOT NULL)""",
        irls_ctes("seq", "sq", xs, "label_next"),
        *[irls_ctes(f"all_{b}", "usage", f, "label") for b, f in _BASES.items()],
        f"us AS MATERIALIZED (SELECT id, t, {overall} FROM usage)"])


_SERIES = _series_sql()
_SEQ_B = [f"(SELECT b{i} FROM seq)" for i in range(7)]

ORACLES["t01_per_period_models"] = W(",\n" + _PERIOD + "\n" + " UNION ALL ".join(
    f"SELECT '{b}' AS model, grp AS t, n, '{c}' AS term, round(b{i}, 6) AS coefficient FROM per_{b}"
    for b, f in _BASES.items() for i, c in enumerate(["intercept", *f])), usage=True, mart=False)

_SEQ_X = [f"x{s}_p_{b}" for s in range(3) for b in _BASES]
ORACLES["t03_sequence_model"] = W(_SERIES + f"""
SELECT id, t_end, {', '.join(f'round({x}, 6) AS {x}' for x in _SEQ_X)}, label_next, round({logistic_sql(_SEQ_B, _SEQ_X)}, 6) AS prob
FROM sq""", usage=True, mart=False)


def _fc_slots():
    # slot s (0 oldest .. 2 newest) at period k holds latest-rank r = 3 - s - (k - 1), clamped at 1
    out = []
    for s in range(3):
        r = f"(3 - {s} - (period - 1))"
        for b in _BASES:
            out.append(f"(CASE WHEN {r} = 3 THEN v3_{b} WHEN {r} = 2 THEN v2_{b} ELSE v1_{b} END)")
    return out


def _history(panel: str) -> str:
    lags = ", ".join(f"lag(p_{b}, {2 - s}) OVER w AS a{s}_{b}" if s < 2 else f"p_{b} AS a2_{b}" for s in range(3) for b in _BASES)
    mean = " + ".join(f"p_{b}" for b in _BASES)
    return f"""SELECT id, t, round(CASE WHEN rn >= 3 THEN {logistic_sql(_SEQ_B, [f'a{s}_{b}' for s in range(3) for b in _BASES])}
     ELSE ({mean}) / {len(_BASES)} END, 6) AS score
  FROM (SELECT *, {lags}, row_number() OVER w AS rn FROM {panel} WINDOW w AS (PARTITION BY id ORDER BY t)) AS s"""


def _future(panel: str) -> str:
    last = ", ".join(f"max(CASE WHEN r = {r} THEN p_{b} END) AS v{r}_{b}" for r in (1, 2, 3) for b in _BASES)
    return f"""SELECT id, CAST((SELECT max(t) FROM {panel}) + period AS INTEGER) AS t,
    round({logistic_sql(_SEQ_B, _fc_slots())}, 6) AS forecast_prob, period
  FROM (SELECT id, {last} FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY t DESC) AS r, count(*) OVER (PARTITION BY id) AS cnt
        FROM {panel}) AS rk WHERE r <= 3 AND cnt >= 3 GROUP BY id) AS lastw CROSS JOIN (SELECT CAST(range AS INTEGER) AS period FROM range(1, 4)) AS st"""


ORACLES["t04_score_series"] = W(_SERIES + "\n" + _history("us"), usage=True, mart=False)
ORACLES["t05_forecast"] = W(_SERIES + "\n" + _future("us"), usage=True, mart=False)
ORACLES["t07_forecast_with_history"] = W(_SERIES + f""",
samp AS (SELECT id FROM (SELECT DISTINCT id FROM usage) AS d ORDER BY (id * 7919 + 42) % 1000003, id LIMIT 10),
uc AS (SELECT * FROM us WHERE id IN (SELECT id FROM samp))
SELECT id, t, score AS prob, 'history' AS kind FROM ({_history('uc')}) AS h
UNION ALL SELECT id, t, forecast_prob AS prob, 'forecast' AS kind FROM ({_future('uc')}) AS f""", usage=True, mart=False)


# --------------------------------------------------------------------------- sources / sinks / streaming
ORACLES["s01_csv_roundtrip"] = W("SELECT * FROM mart")
ORACLES["s02_json_roundtrip"] = W("SELECT * FROM mart")
ORACLES["s03_parquet_roundtrip"] = W("SELECT * FROM mart")
ORACLES["s08_split_files"] = W(f"""
, rk AS (SELECT CustomerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label,
                row_number() OVER (PARTITION BY Churn ORDER BY {_key(42)}, CustomerID) AS r,
                floor(CAST(count(*) OVER (PARTITION BY Churn) AS DOUBLE) * CAST(0.2 AS DOUBLE) + 0.5) AS cut FROM mart)
SELECT CASE WHEN r <= cut THEN 'test' ELSE 'train' END AS split, label, count(*) AS count FROM rk GROUP BY 1, 2""")
ORACLES["st01_streaming_features"] = ORACLES["f_features_risk"]


# --------------------------------------------------------------------------- W3 prepare data
# Categories follow from the mart's definition: nation names are NATION_<key> for the 25 keys.
_W3_ONE_HOT = {
    **_ONE_HOT,
    "Homeownership": ["Known", "Unknown"],
}
_W3_STRICT = ["ChildrenInHH", "HandsetWebCapable", "OwnsComputer", "HasCreditCard", "MadeCallToRetentionTeam"]


def _w3_sql() -> str:
    cols = []
    for c in MART_COLUMNS:
        if c in _W3_STRICT:
            cols.append(f"CAST(CASE WHEN {c} = 'Yes' THEN 1 WHEN {c} = 'No' THEN 0 END AS INTEGER) AS {c}")
        elif c in _W3_ONE_HOT:
            cols += [f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{c}_{v}\"" for v in _W3_ONE_HOT[c]]
        else:
            cols.append(c)
    return W(f"""
, lab AS (SELECT *, CAST(CASE WHEN Churn = 'Yes' THEN 1 WHEN Churn = 'No' THEN 0 END AS INTEGER) AS label FROM mart),
rk AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_key(42)}, CustomerID) AS r,
              floor(CAST(count(*) OVER (PARTITION BY label) AS DOUBLE) * CAST(0.2 AS DOUBLE) + 0.5) AS cut FROM lab
       WHERE label IS NOT NULL)
SELECT {', '.join(cols)}, label, CASE WHEN r <= cut THEN 'test' ELSE 'train' END AS split FROM rk""")


ORACLES["w03_prepare_data"] = _w3_sql()


# --------------------------------------------------------------------------- W1 preprocess
# Columns the 70 % null rule removes from the raw mart: the event-derived ones
# (customers without events have NULL there; about 90 % of customers).
_W1_SPARSE = ["DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls", "ThreewayCalls", "ReceivedCalls",
              "OutboundCalls", "InboundCalls", "CallForwardingCalls", "CallWaitingCalls", "DroppedBlockedCalls",
              "RetentionCalls", "RetentionOffersAccepted"]


def _w1_sql(fit: str = "true", apply: str | None = None) -> str:
    """W1 fitted on the ``fit`` rows; the result is those rows, or the ``apply`` rows without the outlier step."""
    kept = [c for c in MART_COLUMNS if c not in _W1_SPARSE]
    num = [c for c in list(ROLES.continuous) + list(ROLES.discrete) if c in kept]
    cont = [c for c in ROLES.continuous if c in kept]
    strs = [c for c in list(ROLES.categorical) + list(ROLES.binary) if c in kept]
    disc = set(ROLES.discrete)
    t1 = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" if c in disc else c for c in kept)
    t2 = ", ".join(f"coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM f1)) AS {c}" if c in num else
                   f"coalesce({c}, (SELECT {c} FROM f1 WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
                   if c in strs else c for c in kept)
    t3 = ", ".join(f"{_clip_expr(c, 'f2')} AS {c}" if c in cont else c for c in kept)
    feats = [f"Handsets / {nzs('HandsetModels')} AS HandsetsPerModel",
             f"MonthlyRevenue / {nzs('MonthlyMinutes')} AS RevenuePerMinute"]
    enc = []
    for c in kept:
        if c in ROLES.binary and c != "Homeownership":
            enc.append(f"CAST(CASE WHEN lower({c}) IN {_POS} THEN 1 WHEN lower({c}) IN {_NEG} THEN 0 END AS INTEGER) AS {c}")
        elif c == "Homeownership":
            enc.append("CAST(CASE Homeownership WHEN 'Known' THEN 0 WHEN 'Unknown' THEN 1 END AS INTEGER) AS Homeownership")
        elif c in ROLES.categorical:
            enc += [f"CAST(CASE WHEN {c} = '{v}' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS \"{c}_{v}\"" for v in _W3_ONE_HOT[c]]
        elif c in num:
            enc.append(f"round(({c} - (SELECT avg({c}) FROM t3)) / (SELECT CASE WHEN stddev_pop({c}) = 0 OR stddev_pop({c}) IS NULL "
                       f"THEN 1 ELSE stddev_pop({c}) END FROM t3), 6) AS {c}")
        elif c == "Churn":
            enc.append("CAST(CASE WHEN Churn = 'Yes' THEN 1 WHEN Churn = 'No' THEN 0 END AS INTEGER) AS Churn")
        else:
            enc.append(c)
    enc += [f"round({f.split(' AS ')[0]}, 6) AS {f.split(' AS ')[1]}" for f in feats]
    return W(f"""
, t1 AS (SELECT {t1} FROM raw),
f1 AS (SELECT * FROM t1 WHERE {fit}),
t2 AS (SELECT {t2} FROM t1),
f2 AS (SELECT * FROM t2 WHERE {fit}),
t3 AS (SELECT {t3} FROM f2)
SELECT {', '.join(enc)} FROM {f"(SELECT * FROM t2 WHERE {apply})" if apply else "t3"}""", raw=True)


ORACLES["w01_preprocess"] = _w1_sql()
ORACLES["s10_saved_preprocessor"] = _w1_sql("(CustomerID * 7919) % 1009 < 700", "(CustomerID * 7919) % 1009 >= 700")


# --------------------------------------------------------------------------- model reports
# What a report must say, stated from the tables alone.
_CLS = ", cls AS (SELECT CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, count(*) AS n FROM mart GROUP BY 1)"
_HELD = "(SELECT CAST(sum(floor(n * 0.2 + 0.5)) AS BIGINT) FROM cls)"


def _scored_report_sql(rows: str) -> str:
    return W(_CLS + f"""
SELECT {rows} AS n_rows, {rows} AS n_ids, CAST(0 AS BIGINT) AS n_out_of_range, true AS beats_floor""")


for _q in ("m01_boosted_trees_xgb", "m02_boosted_trees_lgbm", "m03_early_stopping", "m04_neural_network", "m05_random_forest",
           "m06_logistic_regression", "m07_gradient_boosting", "v18_score_holdout", "w06_deployment_batch"):
    ORACLES[_q] = _scored_report_sql(_HELD)
ORACLES["b05_stacking"] = _scored_report_sql(_HELD)

_STACK = {"service": ["DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls"],
          "value": ["MonthlyRevenue", "MonthlyMinutes", "TotalRecurringCharge"],
          "change": ["PercChangeMinutes", "PercChangeRevenues", "OverageMinutes"]}


def _stack_sql() -> str:
    """oof_<base> (coefficients per held-out fold), meta, full_<base>, and held: the scored held-out rows."""
    cols = list(dict.fromkeys(c for f in _STACK.values() for c in f))
    score = lambda at, b: logistic_sql([f"{at}_{b}.b{i}" for i in range(len(_STACK[b]) + 1)],          # noqa: E731
                                       [f"coalesce(CAST(d.{c} AS DOUBLE), 0)" for c in _STACK[b]])
    p = [f"p_{b}" for b in _STACK]
    return ",\n" + ",\n".join([
        f"""rk AS MATERIALIZED (SELECT CustomerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, {', '.join(cols)},
       row_number() OVER (PARTITION BY Churn ORDER BY {_key(42)}, CustomerID) AS r,
       floor(CAST(count(*) OVER (PARTITION BY Churn) AS DOUBLE) * CAST(0.2 AS DOUBLE) + 0.5) AS cut FROM mart)""",
        f"""fo AS MATERIALIZED (SELECT *, (row_number() OVER (PARTITION BY label ORDER BY {_key(42)}, CustomerID) - 1) % 5 AS fold
       FROM rk WHERE r > cut)""",
        "rep AS MATERIALIZED (SELECT fo.*, k.range AS held FROM fo JOIN range(5) AS k ON k.range <> fo.fold)",
        *[irls_ctes(f"oof_{b}", "rep", f, "label", group="held") for b, f in _STACK.items()],
        "oof AS MATERIALIZED (SELECT d.label, " + ", ".join(f"{score('oof', b)} AS p_{b}" for b in _STACK) + " FROM fo AS d "
        + " ".join(f"JOIN oof_{b} ON oof_{b}.grp = d.fold" for b in _STACK) + ")",
        irls_ctes("meta", "oof", p, "label"),
        *[irls_ctes(f"full_{b}", "fo", f, "label") for b, f in _STACK.items()],
        "hp AS MATERIALIZED (SELECT d.CustomerID, d.label, " + ", ".join(f"{score('full', b)} AS p_{b}" for b in _STACK)
        + " FROM rk AS d " + " ".join(f"JOIN full_{b} ON true" for b in _STACK) + " WHERE d.r <= d.cut)",
        "held AS MATERIALIZED (SELECT hp.*, " + logistic_sql([f"meta.b{i}" for i in range(len(p) + 1)], p)
        + " AS ensemble FROM hp JOIN meta ON true)"])


_STACKED = _stack_sql()
ORACLES["b05_stacking_scores"] = W(_STACKED + "\nSELECT CustomerID, label, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in [*(f"p_{b}" for b in _STACK), "ensemble"]) + " FROM held")
_META_SUM = " + ".join(f"abs(b{i})" for i in range(1, len(_STACK) + 1))
ORACLES["b09_contributions_stacking"] = W(_STACKED + "\n" + " UNION ALL ".join(
    f"SELECT 'p_{b}' AS model, round(corr(p_{b}, ensemble), 6) AS correlation, round((SELECT abs(b{i}) / ({_META_SUM}) FROM meta), 6) AS weight "
    "FROM held" for i, b in enumerate(_STACK, 1)))


def _v11_sql() -> str:
    cols = ["MonthlyRevenue", "MonthlyMinutes", "PercChangeMinutes", "PercChangeRevenues", "DroppedCalls", "CustomerCareCalls"]
    score = logistic_sql([f"cv.b{i}" for i in range(len(cols) + 1)], [f"coalesce(CAST(d.{c} AS DOUBLE), 0)" for c in cols])
    return W(f""",
fo AS MATERIALIZED (SELECT CustomerID, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label, {', '.join(cols)},
  (row_number() OVER (PARTITION BY Churn ORDER BY {_key(42)}, CustomerID) - 1) % 5 AS fold FROM mart),
rep AS MATERIALIZED (SELECT fo.*, k.range AS held FROM fo JOIN range(5) AS k ON k.range <> fo.fold),
{irls_ctes('cv', 'rep', cols, 'label', group='held')},
sc AS MATERIALIZED (SELECT d.fold, d.label, {score} AS p FROM fo AS d JOIN cv ON cv.grp = d.fold),
cm AS (SELECT fold, count(*) AS n, sum(CASE WHEN p >= 0.5 AND label = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p >= 0.5 AND label = 0 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN p < 0.5 AND label = 1 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN p < 0.5 AND label = 0 THEN 1 ELSE 0 END) AS tn FROM sc GROUP BY fold),
rk AS (SELECT fold, label, rank() OVER (PARTITION BY fold ORDER BY p) + (count(*) OVER (PARTITION BY fold, p) - 1) / 2.0 AS r FROM sc),
au AS (SELECT fold, (sum(CASE WHEN label = 1 THEN r ELSE 0 END) - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * sum(1 - label)) AS auc
  FROM rk GROUP BY fold)
SELECT CAST(cm.fold AS INTEGER) AS fold, round((tp + tn) / CAST(n AS DOUBLE), 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / CAST(tp + fp AS DOUBLE) ELSE 0 END, 6) AS "precision",
  round(CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) ELSE 0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END, 6) AS f1, round(auc, 6) AS roc_auc
FROM cm JOIN au ON cm.fold = au.fold""")


ORACLES["v11_cross_validate"] = _v11_sql()

def _w02_sql(k: int = 30, threshold: float = 0.85) -> str:
    """The L1 and L2 rules over mart columns and features, in long form."""
    made = {c: e for c, e in SQL_FEATURES.items() if c not in ("TenureBucket", "AgeSegment")}
    cols = [*[(c, c) for c in _NUMERIC], *made.items()]
    long = " UNION ALL ".join(f"SELECT CustomerID, label, '{c}' AS feature, {i} AS ordinal, CAST({e} AS DOUBLE) AS v FROM lab"
                              for i, (c, e) in enumerate(cols))
    return W(_LAB + f""", lf AS MATERIALIZED (SELECT *, coalesce(v, 0) AS x FROM ({long}) AS u),
pairs AS (SELECT a.ordinal AS i, b.ordinal AS j, round(corr(a.x, b.x), 6) AS c
  FROM lf AS a JOIN lf AS b ON a.CustomerID = b.CustomerID AND a.ordinal < b.ordinal GROUP BY a.ordinal, b.ordinal),
kept AS MATERIALIZED (SELECT DISTINCT ordinal, feature FROM lf
  WHERE ordinal NOT IN (SELECT j FROM pairs WHERE abs(c) > {threshold} AND NOT isnan(c))),
mu AS (SELECT ordinal, avg(x) AS mu FROM lf GROUP BY ordinal),
g AS (SELECT lf.ordinal, label, count(*) AS n, sum(x - mu) AS s, sum((x - mu) * (x - mu)) AS q FROM lf
  JOIN mu ON lf.ordinal = mu.ordinal GROUP BY lf.ordinal, label),
t AS (SELECT ordinal, sum(n) AS n, count(*) AS k, sum(q) - sum(s) * sum(s) / sum(n) AS sstot,
  sum(s * s / n) - sum(s) * sum(s) / sum(n) AS ssbn FROM g GROUP BY ordinal),
f AS (SELECT ordinal, round(CASE WHEN k > 1 AND n > k AND (sstot - ssbn) / (n - k) > 0
  THEN (ssbn / (k - 1)) / ((sstot - ssbn) / (n - k)) END, 6) AS f_score FROM t),
best AS (SELECT kept.ordinal, row_number() OVER (ORDER BY f_score DESC NULLS LAST, kept.ordinal) AS rank
  FROM kept JOIN f ON kept.ordinal = f.ordinal)
SELECT CustomerID, label, feature, round(v, 6) AS value, CAST(rank AS INTEGER) AS rank
FROM lf JOIN best ON lf.ordinal = best.ordinal WHERE rank <= {k}""")


ORACLES["w02_feature_engineering"] = _w02_sql()

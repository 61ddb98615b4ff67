"""Derived customer features (survey §2.5, F1-F57) as Catalyst expressions.

Each feature is a function of a resolver ``c(name)`` that returns either the
source column or, for a derived name, that feature's own expression.  Derived
inputs are therefore inlined, and any set of features is added by ONE
``select`` (no chains of ``withColumn``); Catalyst's subexpression
elimination shares the repeated pieces inside whole-stage codegen.

Null semantics follow the survey's N1-N9 rules (see ``retentio.functions.expr``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.functions.expr import clip, clip_lower, clip_upper, flag, nz, sign0

Resolver = Callable[[str], Column]


def _m1(c: Resolver) -> Column:
    return clip_lower(c("MonthsInService"), 1)


def _yes(c: Resolver, name: str) -> Column:
    return flag(c(name) == "Yes")


def _present(c: Resolver, names: Iterable[str], term: Callable[[Column], Column]) -> list[Column]:
    """``term`` of the columns that the frame has."""
    out = []
    for n in names:
        try:
            out.append(term(c(n)))
        except KeyError:
            continue
    return out


def _tech_savvy(c: Resolver) -> Column:
    """An absent column counts as 'No'; absent as a feature if both are."""
    parts = _present(c, ["OwnsComputer", "HandsetWebCapable"], lambda x: flag(x == "Yes"))
    if not parts:
        raise KeyError("OwnsComputer, HandsetWebCapable")
    return sum(parts[1:], parts[0])


def _trend_consistency(c: Resolver) -> Column:
    """Mean sign of the indicators that are present; absent as a feature if none is."""
    signs = _present(c, ["PercChangeMinutes", "PercChangeRevenues", "CustomerCareCalls", "DroppedCalls"], F.signum)
    if not signs:
        raise KeyError("indicators of a trend")
    return F.abs(sum(signs[1:], signs[0]) / len(signs))


def _avg_positive_age(c: Resolver) -> Column:
    a1 = F.when(c("AgeHH1") > 0, c("AgeHH1"))
    a2 = F.when(c("AgeHH2") > 0, c("AgeHH2"))
    n = a1.isNotNull().cast("int") + a2.isNotNull().cast("int")
    return F.when(n > 0, (F.coalesce(a1, F.lit(0.0)) + F.coalesce(a2, F.lit(0.0))) / n)


# Fixed values that must equal the reference: risk weights and score scale.
RISK_WEIGHTS = (0.4, 0.4, 0.2)
MAX_RISK = 4 * 0.4 + 4 * 0.4 + 4 * 0.2

# Bucket labels of the two tenure / age variants.
TENURE_LABELS = ["0-3 months", "4-6 months", "7-12 months", "1-2 years", "2+ years"]
TENURE_CUT_LABELS = ["0-3 months", "3-6 months", "6-12 months", "1-2 years", "2+ years"]
AGE_LABELS = ["Under 25", "25-34", "35-44", "45-54", "55+"]
AGE_CUT_LABELS = ["18-25", "26-35", "36-50", "51-65", "65+"]
CREDIT_MAPPING = {"Poor": 1, "Fair": 2, "Good": 3, "Excellent": 4}


def _right_closed_cut(x: Column, edges: list[float], labels: list[str]) -> Column:
    """``pd.cut`` semantics: (e0, e1], (e1, e2], ...; at/below e0 or NULL -> NULL."""
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (x > lo) & (x <= hi)
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def _risk_service(c):
    return (flag(c("DroppedCalls") > 0) + flag(c("BlockedCalls") > 0)
            + flag(c("UnansweredCalls") > 0) + flag(c("CustomerCareCalls") > 2))


def _risk_financial(c):
    return (flag(c("PercChangeRevenues") < -10) + flag(c("OverageMinutes") > 0)
            + flag(c("MonthlyRevenue") < 50) + flag(c("RecurringRevenueRatio") < 0.5))


def _risk_engagement(c):
    return (flag(c("MonthsInService") <= 3) + flag(c("CallsPerMonth") < 10)
            + flag(c("SpecialFeaturesUsed") == 0) + flag(c("ReferralsMadeBySubscriber") == 0))


# name -> (family, expression builder); dict order is the output order.
FEATURES: dict[str, tuple[str, Callable[[Resolver], Column]]] = {
    # grouped (cleaning-time feature groups), F1-F6
    "TotalCallIssues": ("grouped", lambda c: c("DroppedCalls") + c("BlockedCalls")),
    "TotalCalls": ("behavioral", lambda c: c("OutboundCalls") + c("InboundCalls")),
    "OutboundCallRatio": ("grouped", lambda c: c("OutboundCalls") / nz(c("TotalCalls"))),
    "TotalServiceCalls": ("grouped", lambda c: c("CustomerCareCalls") + c("RetentionCalls")),
    "HandsetsPerModel": ("grouped", lambda c: c("Handsets") / nz(c("HandsetModels"))),
    "RevenuePerMinute": ("usage", lambda c: c("MonthlyRevenue") / nz(c("MonthlyMinutes"))),
    # behavioral, F7-F13
    "CustomerCareCallsPerMonth": ("behavioral", lambda c: c("CustomerCareCalls") / _m1(c)),
    "TotalProblemCalls": ("behavioral", lambda c: c("DroppedCalls") + c("BlockedCalls") + c("UnansweredCalls")),
    "ProblemCallsPerMonth": ("behavioral", lambda c: c("TotalProblemCalls") / _m1(c)),
    "CallsPerMonth": ("behavioral", lambda c: c("TotalCalls") / _m1(c)),
    "SpecialFeaturesUsed": ("behavioral", lambda c: flag(c("CallWaitingCalls") > 0)
                            + flag(c("CallForwardingCalls") > 0) + flag(c("ThreewayCalls") > 0)),
    "RetentionCallsPerMonth": ("behavioral", lambda c: c("RetentionCalls") / _m1(c)),
    "RetentionSuccessRate": ("behavioral", lambda c: c("RetentionOffersAccepted") / nz(c("RetentionCalls"))),
    # usage pattern, F14-F17
    "PeakCallsRatio": ("usage", lambda c: c("PeakCallsInOut") / nz(c("PeakCallsInOut") + c("OffPeakCallsInOut"))),
    "PremiumServiceUsage": ("usage", lambda c: flag(c("DirectorAssistedCalls") > 0)),
    "RoamingServiceUsage": ("usage", lambda c: flag(c("RoamingCalls") > 0)),
    "HasOverages": ("usage", lambda c: flag(c("OverageMinutes") > 0)),
    # change, F18-F23
    "NormalizedChangeMinutes": ("change", lambda c: clip(c("PercChangeMinutes"), -100, 100) / 100),
    "NormalizedChangeRevenues": ("change", lambda c: clip(c("PercChangeRevenues"), -100, 100) / 100),
    "ConsistentChangeDirection": ("change", lambda c: flag(c("PercChangeMinutes") * c("PercChangeRevenues") > 0)),
    "LargeNegativeChange": ("change", lambda c: flag((c("PercChangeMinutes") < -20) | (c("PercChangeRevenues") < -20))),
    "TenureBucket": ("change", lambda c: F.when(c("MonthsInService") <= 3, TENURE_LABELS[0])
                     .when(c("MonthsInService") <= 6, TENURE_LABELS[1])
                     .when(c("MonthsInService") <= 12, TENURE_LABELS[2])
                     .when(c("MonthsInService") <= 24, TENURE_LABELS[3])
                     .when(c("MonthsInService") > 24, TENURE_LABELS[4]).otherwise("Unknown")),
    "IsNewCustomer": ("change", lambda c: flag(c("MonthsInService") <= 3)),
    # ratio, F24-F28
    "ARPM": ("ratio", lambda c: c("MonthlyRevenue") / nz(c("MonthlyMinutes"))),
    "ProblemCallRatio": ("ratio", lambda c: (c("DroppedCalls") + c("BlockedCalls")) / nz(c("TotalCalls"))),
    "RetentionToServiceRatio": ("ratio", lambda c: c("RetentionCalls") / _m1(c)),
    "EquipmentLifeRatio": ("ratio", lambda c: c("CurrentEquipmentDays") / nz(c("MonthsInService") * 30)),
    "RecurringRevenueRatio": ("ratio", lambda c: c("TotalRecurringCharge") / nz(c("MonthlyRevenue"))),
    # profile, F29-F37
    "TechSavvyScore": ("profile", _tech_savvy),
    "HasChildren": ("profile", lambda c: _yes(c, "ChildrenInHH")),
    "IsMultiPersonHH": ("profile", lambda c: flag((c("AgeHH1") > 0) & (c("AgeHH2") > 0))),
    "AvgHHAge": ("profile", _avg_positive_age),
    "AgeSegment": ("profile", lambda c: F.when(c("AvgHHAge") < 25, AGE_LABELS[0])
                   .when(c("AvgHHAge") < 35, AGE_LABELS[1]).when(c("AvgHHAge") < 45, AGE_LABELS[2])
                   .when(c("AvgHHAge") < 55, AGE_LABELS[3]).when(c("AvgHHAge") >= 55, AGE_LABELS[4])
                   .otherwise("Unknown")),
    "HasMadeReferrals": ("profile", lambda c: flag(c("ReferralsMadeBySubscriber") > 0)),
    "HighReferrer": ("profile", lambda c: flag(c("ReferralsMadeBySubscriber") >= 2)),
    "CreditScore": ("profile", lambda c: 10 - clip_upper(c("AdjustmentsToCreditRating"), 10)),
    "HighIncome": ("profile", lambda c: flag(c("IncomeGroup") >= 7)),
    "LowIncome": ("profile", lambda c: flag(c("IncomeGroup") <= 3)),
    # customer value, F38-F41
    "CustomerLifetimeValue": ("value", lambda c: c("MonthlyRevenue") * c("MonthsInService")),
    "RevenueStability": ("value", lambda c: 100 - clip_upper(F.abs(c("PercChangeRevenues")), 100)),
    "RevenuePerSubscription": ("value", lambda c: c("MonthlyRevenue") / clip_lower(c("ActiveSubs"), 1)),
    "HighValueCustomer": ("value", lambda c: flag(c("MonthlyRevenue") > 100)),
    # trend, F42-F46
    "UsageTrendDirection": ("trend", lambda c: sign0(c("PercChangeMinutes"))),
    "RevenueTrendDirection": ("trend", lambda c: sign0(c("PercChangeRevenues"))),
    "UsageAcceleration": ("trend", lambda c: c("PercChangeMinutes") / _m1(c)),
    "RevenueAcceleration": ("trend", lambda c: c("PercChangeRevenues") / _m1(c)),
    "TrendConsistency": ("trend", _trend_consistency),
    # composite risk, F47-F50
    "ServiceQualityRiskScore": ("risk", _risk_service),
    "FinancialRiskScore": ("risk", _risk_financial),
    "EngagementRiskScore": ("risk", _risk_engagement),
    "ChurnRiskScore": ("risk", lambda c: (c("ServiceQualityRiskScore") * RISK_WEIGHTS[0]
                                          + c("FinancialRiskScore") * RISK_WEIGHTS[1]
                                          + c("EngagementRiskScore") * RISK_WEIGHTS[2]) / MAX_RISK * 100),
    # interactions, F51-F55
    "NewCustomerWithProblems": ("interaction", lambda c: flag((c("IsNewCustomer") == 1) & (c("TotalProblemCalls") > 0))),
    "HighValueCustomerWithProblems": ("interaction", lambda c: flag((c("HighValueCustomer") == 1) & (c("TotalProblemCalls") > 0))),
    "ServiceIssuesWithDecliningUsage": ("interaction", lambda c: flag((c("TotalProblemCalls") > 0) & (c("PercChangeMinutes") < 0))),
    "FailedRetentionAttempts": ("interaction", lambda c: flag((c("RetentionCalls") > 1) & (c("RetentionOffersAccepted") == 0))),
    "TechSavvyWithProblems": ("interaction", lambda c: flag((c("TechSavvyScore") > 0) & (c("TotalProblemCalls") > 0))),
}

# The second implementation family ('segment'/'cut' variant, survey F22b-F36b).
VARIANTS: dict[str, Callable[[Resolver], Column]] = {
    "TenureBucket": lambda c: _right_closed_cut(c("MonthsInService"), [0, 3, 6, 12, 24, float("inf")], TENURE_CUT_LABELS),
    "RetentionToServiceRatio": lambda c: c("RetentionCalls") / nz(c("CustomerCareCalls")),
    "IsMultiPersonHH": lambda c: flag(c("AgeHH2") > 0),
    "AvgHHAge": lambda c: F.when(c("AgeHH2") > 0, (c("AgeHH1") + c("AgeHH2")) / 2).otherwise(c("AgeHH1")),
    "AgeSegment": lambda c: _right_closed_cut(c("AvgHHAge"), [0, 25, 35, 50, 65, float("inf")], AGE_CUT_LABELS),
}

FAMILIES = ["grouped", "behavioral", "usage", "change", "ratio", "profile", "value", "trend", "risk", "interaction"]

# F1-F6 as produced by the cleaning pipeline (W1), in its order.
GROUPED = ["TotalCallIssues", "TotalCalls", "OutboundCallRatio", "TotalServiceCalls", "HandsetsPerModel", "RevenuePerMinute"]


def resolver(df_columns: Iterable[str], variant: str = "fe") -> Resolver:
    cols = set(df_columns)

    def c(name: str) -> Column:
        if name in cols:
            return F.col(name)
        if variant != "fe" and name in VARIANTS:
            return VARIANTS[name](c)
        if name in FEATURES:
            return FEATURES[name][1](c)
        raise KeyError(f"unknown column or feature: {name}")
    return c


def family_members(family: str) -> list[str]:
    if family == "grouped":
        return list(GROUPED)
    return [n for n, (fam, _) in FEATURES.items() if fam == family]


def feature_columns(df: DataFrame, names: Iterable[str], variant: str = "fe") -> list[Column]:
    c = resolver([x for x in df.columns if x not in set(names)], variant)
    return [c(n).alias(n) for n in names]


def available(df: DataFrame, names: Iterable[str], variant: str = "fe") -> list[str]:
    """Features whose inputs are all present (the reference skips the others)."""
    c = resolver(df.columns, variant)
    out = []
    for n in names:
        try:
            c(n)
        except KeyError:
            continue
        out.append(n)
    return out


def grouped_features(df: DataFrame) -> list[str]:
    """F1-F6 that W1 adds to ``df``: those whose inputs are present and, for OutboundCallRatio, only
    if the calls of all rows add up to more than 0 (one aggregate)."""
    names = available(df, [n for n in GROUPED if n not in df.columns])
    if "OutboundCallRatio" in names:
        total = df.select(F.sum(resolver(df.columns)("TotalCalls"))).first()[0]
        if not (total or 0) > 0:
            names.remove("OutboundCallRatio")
    return names


def add_features(df: DataFrame, names: Iterable[str] | None = None, families: Iterable[str] | None = None,
                 variant: str = "fe", keep: bool = True) -> DataFrame:
    """Append features in one projection (F1-F55; ``variant='cut'`` for F22b-F33b)."""
    if names is None:
        fams = list(families or FAMILIES)
        names = []
        for f in fams:
            names += [n for n in family_members(f) if n not in names]
    names = list(names)
    base = [F.col(c) for c in df.columns if c not in set(names)] if keep else []
    return df.select(*base, *feature_columns(df, names, variant))


def credit_score_mapped(df: DataFrame, col: str = "CreditRating") -> DataFrame:
    """Map Poor/Fair/Good/Excellent -> 1..4, only when every value is mapped.

    The decision is one distributed aggregate (count of unmapped or NULL rows)
    evaluated before the projection is added.
    """
    unmapped = df.select(F.count_if(~F.col(col).isin(list(CREDIT_MAPPING)) | F.col(col).isNull())).first()[0]
    if unmapped:
        return df
    m = F.create_map(*[x for k, v in CREDIT_MAPPING.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn("CreditScore", m[F.col(col)])


# feature -> group, as used by the feature-analysis notebook.
GROUP_NAMES = {
    "behavioral": "Behavioral Features", "usage": "Usage Pattern Features", "change": "Change Features",
    "ratio": "Ratio Features", "profile": "Profile Features", "value": "Customer Value Features",
    "trend": "Trend Features", "risk": "Risk Score Features", "interaction": "Interaction Features",
}


def new_features(before: DataFrame, after: DataFrame) -> list[str]:
    """columns present after feature creation and not before, in output order."""
    old = set(before.columns)
    return [c for c in after.columns if c not in old]


def categorize_features(df: DataFrame) -> DataFrame:
    """one row per engineered column of ``df`` with its group name."""
    rows = [(c, GROUP_NAMES.get(FEATURES[c][0], "Other")) for c in df.columns if c in FEATURES]
    return df.sparkSession.createDataFrame(rows, "feature string, feature_group string")

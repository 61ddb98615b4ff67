"""Data bridge: derive churn-shaped tables from the supplied TPC-H-like tables.

``customer_mart``  one row per customer with the telecom-style column roles
                   (see ``retentio.roles.CHURN_ROLES``).
``scored_table``   id, label and three deterministic pseudo-probabilities,
                   the input of every metric / ensemble operator.
``usage_series``   user x day panel (events) for the sequence operators.

Plan shape (what makes it hold at scale):
  lineitem --partial agg by l_orderkey--> order level (1 row per order)
  orders ⋈ order level on o_orderkey (both unique per key: no skew)
  --partial agg by (o_custkey, day)--> daily rows; a hot customer is bounded
  by its number of distinct order days, so the per-customer window that finds
  first/last order day never holds an unbounded group.
  events --partial agg by user_id--> one row per user.
  The global last order day is a scalar subquery, not a cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retentio.functions.expr import r6, rnd


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cnt(cond) -> F.Column:
    return F.count_if(cond)


def _customer_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("qty"),
        F.sum(F.when(F.col("l_quantity") > 45, F.col("l_quantity") - 45).otherwise(F.lit(0.0))).alias("over_qty"),
        _cnt((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.085)).alias("n_roam"),
        _cnt(F.col("l_linenumber") % 2 == 1).alias("n_peak"),
        _cnt(F.col("l_linenumber") % 2 == 0).alias("n_offpeak"),
    )
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_orderstatus")
    od = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    daily = od.groupBy("o_custkey", "o_orderdate").agg(
        rnd(F.sum("o_totalprice"), 2).alias("rev"),
        rnd(F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(F.lit(0.0))), 2).alias("rev_f"),
        F.sum(F.coalesce("qty", F.lit(0.0))).alias("qty"),
        F.sum(F.coalesce("over_qty", F.lit(0.0))).alias("over_qty"),
        F.sum(F.coalesce("n_roam", F.lit(0))).alias("n_roam"),
        F.sum(F.coalesce("n_peak", F.lit(0))).alias("n_peak"),
        F.sum(F.coalesce("n_offpeak", F.lit(0))).alias("n_offpeak"),
        F.count("*").alias("n_orders"),
        _cnt(F.col("o_orderpriority") == "1-URGENT").alias("n_urgent"),
        _cnt(F.col("o_orderstatus") == "O").alias("n_open"),
    )
    w = Window.partitionBy("o_custkey")
    daily = daily.withColumn("first_d", F.min("o_orderdate").over(w)).withColumn(
        "last_d", F.max("o_orderdate").over(w))
    span = F.datediff("last_d", "first_d")
    late = (2 * F.datediff("o_orderdate", "first_d")) > span
    per_cust = daily.groupBy("o_custkey").agg(
        F.min("first_d").alias("first_d"),
        F.max("last_d").alias("last_d"),
        rnd(F.sum("rev"), 2).alias("rev"),
        rnd(F.sum("rev_f"), 2).alias("rev_f"),
        rnd(F.sum(F.when(late, F.col("rev")).otherwise(F.lit(0.0))), 2).alias("rev2"),
        rnd(F.sum(F.when(late, F.lit(0.0)).otherwise(F.col("rev"))), 2).alias("rev1"),
        F.sum("qty").alias("qty"),
        F.sum(F.when(late, F.col("qty")).otherwise(F.lit(0.0))).alias("qty2"),
        F.sum(F.when(late, F.lit(0.0)).otherwise(F.col("qty"))).alias("qty1"),
        F.sum("over_qty").alias("over_qty"),
        F.sum("n_roam").alias("n_roam"),
        F.sum("n_peak").alias("n_peak"),
        F.sum("n_offpeak").alias("n_offpeak"),
        F.sum("n_orders").alias("n_orders"),
        F.sum("n_urgent").alias("n_urgent"),
        F.sum("n_open").alias("n_open"),
    )
    return per_cust


def _user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    t, v = F.col("event_type"), F.col("value")
    return ev.groupBy("user_id").agg(
        _cnt(t == "error").alias("DroppedCalls"),
        _cnt((t == "error") & (v > 30)).alias("BlockedCalls"),
        _cnt((t == "view") & (v < 10)).alias("UnansweredCalls"),
        _cnt(t == "signup").alias("CustomerCareCalls"),
        _cnt((t == "click") & (v > 40)).alias("ThreewayCalls"),
        F.count("*").alias("ReceivedCalls"),
        _cnt(t == "click").alias("OutboundCalls"),
        _cnt(t == "view").alias("InboundCalls"),
        _cnt((t == "purchase") & (v < 5)).alias("CallForwardingCalls"),
        _cnt((t == "view") & (v > 40)).alias("CallWaitingCalls"),
        _cnt(t == "purchase").alias("RetentionCalls"),
        _cnt((t == "purchase") & (v > 50)).alias("RetentionOffersAccepted"),
    )


EVENT_CONTINUOUS = ["DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls",
                    "ThreewayCalls", "ReceivedCalls", "OutboundCalls", "InboundCalls",
                    "CallForwardingCalls", "CallWaitingCalls"]
EVENT_DISCRETE = ["RetentionCalls", "RetentionOffersAccepted"]

# Output column order of the mart (both flavours).
MART_COLUMNS = [
    "CustomerID", "Churn",
    "ServiceArea", "CreditRating", "PrizmCode", "Occupation", "MaritalStatus",
    "ChildrenInHH", "HandsetWebCapable", "OwnsComputer", "Homeownership", "HasCreditCard",
    "MadeCallToRetentionTeam",
    "MonthlyRevenue", "MonthlyMinutes", "TotalRecurringCharge", "DirectorAssistedCalls",
    "OverageMinutes", "RoamingCalls", "PercChangeMinutes", "PercChangeRevenues",
    "DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls", "ThreewayCalls",
    "ReceivedCalls", "OutboundCalls", "InboundCalls", "PeakCallsInOut", "OffPeakCallsInOut",
    "DroppedBlockedCalls", "CallForwardingCalls", "CallWaitingCalls", "AgeHH1", "AgeHH2",
    "MonthsInService", "UniqueSubs", "ActiveSubs", "Handsets", "HandsetModels",
    "CurrentEquipmentDays", "RetentionCalls", "RetentionOffersAccepted",
    "ReferralsMadeBySubscriber", "IncomeGroup", "AdjustmentsToCreditRating", "HandsetPrice",
]

DISCRETE = ["MonthsInService", "UniqueSubs", "ActiveSubs", "Handsets", "HandsetModels",
            "CurrentEquipmentDays", "RetentionCalls", "RetentionOffersAccepted",
            "ReferralsMadeBySubscriber", "IncomeGroup", "AdjustmentsToCreditRating", "HandsetPrice"]


def customer_mart(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """Churn-shaped wide table.

    ``raw=False`` (feature flavour): every numeric column is a double, users
    without events count zero events.  ``raw=True``: discrete columns are
    strings (``HandsetPrice`` holds 'Unknown'), event columns stay NULL for
    customers without events and about 10 % of a few columns are nulled by
    key arithmetic, as the cleaning operators expect.
    """
    gmax = read_table(spark, sf_dir, "orders").select(F.max("o_orderdate")).scalar()
    act = _customer_activity(spark, sf_dir)
    ev = _user_events(spark, sf_dir)
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = (cust.join(act, cust.c_custkey == act.o_custkey, "inner")
            .join(nation, cust.c_nationkey == nation.n_nationkey, "left")
            .join(ev, cust.c_custkey == ev.user_id, "left"))

    k = F.col("c_custkey")
    months = (F.floor(F.datediff("last_d", "first_d") / 30) + 1)
    span = F.datediff("last_d", "first_d")
    idle = F.datediff(gmax, "last_d")
    yes_no = lambda cond: F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))

    def ev_col(c):
        return F.col(c).cast("double") if raw else F.coalesce(F.col(c), F.lit(0)).cast("double")

    def maybe_null(c, modulus, rest):
        return F.when(k % modulus == rest, F.lit(None)).otherwise(c) if raw else c

    def disc(c):
        return c.cast("string") if raw else c.cast("double")

    handset_price = F.when(k % 5 == 0, F.lit("Unknown")).otherwise((10 * (1 + k % 7)).cast("string"))
    cols = {
        "CustomerID": k,
        "Churn": yes_no(idle > 365),
        "ServiceArea": F.col("n_name"),
        "CreditRating": maybe_null(
            F.when(F.col("c_acctbal") < 0, "7-Lowest").when(F.col("c_acctbal") < 2000, "5-Low")
            .when(F.col("c_acctbal") < 5000, "3-Good").when(F.col("c_acctbal") < 8000, "2-High")
            .otherwise("1-Highest"), 10, 7),
        "PrizmCode": F.col("c_mktsegment"),
        "Occupation": F.when(k % 5 == 0, "Professional").when(k % 5 == 1, "Clerical")
        .when(k % 5 == 2, "Crafts").when(k % 5 == 3, "Retired").otherwise("Other"),
        "MaritalStatus": maybe_null(
            F.when(k % 3 == 0, "Yes").when(k % 3 == 1, "No").otherwise("Unknown"), 10, 5),
        "ChildrenInHH": maybe_null(yes_no(k % 4 == 0), 10, 1),
        "HandsetWebCapable": yes_no(k % 5 != 0),
        "OwnsComputer": yes_no(k % 6 == 1),
        "Homeownership": F.when(k % 3 != 2, "Known").otherwise("Unknown"),
        "HasCreditCard": yes_no(F.col("c_acctbal") > 0),
        "MadeCallToRetentionTeam": yes_no(F.coalesce(F.col("RetentionCalls"), F.lit(0)) > 10),
        "MonthlyRevenue": maybe_null(r6(F.col("rev") / 1000 / months), 10, 3),
        "MonthlyMinutes": r6(F.col("qty") / months),
        "TotalRecurringCharge": maybe_null(r6(F.col("rev_f") / 1000 / months), 10, 4),
        "DirectorAssistedCalls": F.col("n_urgent").cast("double"),
        "OverageMinutes": F.col("over_qty").cast("double"),
        "RoamingCalls": F.col("n_roam").cast("double"),
        "PercChangeMinutes": F.when((span == 0) | (F.col("qty1") == 0), F.lit(None).cast("double"))
        .otherwise(r6((F.col("qty2") - F.col("qty1")) / F.col("qty1") * 100)),
        "PercChangeRevenues": F.when((span == 0) | (F.col("rev1") == 0), F.lit(None).cast("double"))
        .otherwise(r6((F.col("rev2") - F.col("rev1")) / F.col("rev1") * 100)),
    }
    for c in EVENT_CONTINUOUS:
        cols[c] = ev_col(c)
    cols["PeakCallsInOut"] = F.col("n_peak").cast("double")
    cols["OffPeakCallsInOut"] = F.col("n_offpeak").cast("double")
    cols["DroppedBlockedCalls"] = ev_col("DroppedCalls") + ev_col("BlockedCalls")
    cols["AgeHH1"] = maybe_null(F.when(k % 11 == 0, F.lit(0.0)).otherwise((18 + k % 61).cast("double")), 20, 9)
    cols["AgeHH2"] = F.when(k % 3 == 0, F.lit(0.0)).otherwise((18 + (k * 7) % 59).cast("double"))
    cols["MonthsInService"] = disc(months)
    cols["UniqueSubs"] = disc(1 + k % 3)
    cols["ActiveSubs"] = disc(F.col("n_open"))
    cols["Handsets"] = disc(1 + F.floor(F.col("n_orders") / 5))
    cols["HandsetModels"] = disc(1 + F.floor(F.col("n_orders") / 8))
    cols["CurrentEquipmentDays"] = disc(idle)
    for c in EVENT_DISCRETE:
        cols[c] = F.col(c).cast("string") if raw else ev_col(c)
    cols["ReferralsMadeBySubscriber"] = disc(F.when(k % 4 == 0, k % 3).otherwise(F.lit(0)))
    cols["IncomeGroup"] = disc(k % 10)
    cols["AdjustmentsToCreditRating"] = disc(k % 13)
    cols["HandsetPrice"] = handset_price if raw else handset_price.try_cast("double")
    return base.select(*[cols[c].alias(c) for c in MART_COLUMNS])


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, label and three pseudo-probabilities in thousandths (exact in both engines).

    p1/p2 mix the label with key arithmetic; p3 mixes the idle days with key
    arithmetic, so it carries real signal from the orders table.
    """
    m = mart_table(spark, sf_dir).select("CustomerID", "Churn", "CurrentEquipmentDays")
    k = F.col("CustomerID")
    label = F.when(F.col("Churn") == "Yes", F.lit(1)).otherwise(F.lit(0))
    days = F.col("CurrentEquipmentDays").cast("long")
    return m.select(
        k.alias("id"),
        label.alias("label"),
        ((350 * label + (k * 7919) % 650) / 1000.0).alias("p1"),
        ((250 * label + (k * 104729 + 17) % 750) / 1000.0).alias("p2"),
        ((F.least(days, F.lit(500)) + (k * 31) % 500) / 1000.0).alias("p3"),
    )


def usage_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x day panel from events: id, t (day index 1..), n, value, label.

    ``label`` = 1 when the user has no event on the following day.
    Partial aggregation by (user, day) keeps a hot user's group bounded by
    its number of active days.
    """
    ev = read_table(spark, sf_dir, "events")
    day = F.to_date("ts")
    first_day = ev.select(F.min(day)).scalar()
    daily = ev.groupBy(F.col("user_id").alias("id"), day.alias("day")).agg(
        F.count("*").alias("n"),
        rnd(F.sum("value"), 2).alias("value"),
        F.count_if(F.col("event_type") == "error").alias("n_error"),
    )
    w = Window.partitionBy("id").orderBy("day")
    nxt = F.lead("day").over(w)
    return daily.select(
        "id", "day",
        (F.datediff("day", first_day) + 1).alias("t"),
        "n", "value", "n_error",
        F.when(nxt.isNull() | (F.datediff(nxt, F.col("day")) > 1), F.lit(1)).otherwise(F.lit(0)).alias("label"),
    )


# Bump when the mart definition changes: materialized copies are keyed by it.
MART_VERSION = "1"


def _input_signature(spark: SparkSession, sf_dir: str, names) -> str:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    parts = []
    for n in names:
        p = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{n}.parquet")
        fs = p.getFileSystem(conf)
        if fs.exists(p):
            st = fs.getContentSummary(p)
            parts.append(f"{n}:{st.getLength()}:{fs.getFileStatus(p).getModificationTime()}")
    return "|".join(parts)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def mart_table(spark: SparkSession, sf_dir: str, raw: bool = False) -> DataFrame:
    """The mart as a written table: built once per input version under the shared
    checkpoint folder (``spark.checkpoint.dir``), then read back by every query.

    Fit steps of the operators run several small jobs over their input; reading a
    stored table keeps each of them a scan instead of a rebuild of the joins and
    aggregations above, and a stored table survives executor loss.
    """
    import hashlib

    from retentio.session import checkpoint_dir
    sig = _input_signature(spark, sf_dir, ["customer", "orders", "lineitem", "events", "nation"])
    key = hashlib.sha1(f"{MART_VERSION}|{sf_dir}|{raw}|{sig}".encode()).hexdigest()[:16]
    path = f"{checkpoint_dir(spark)}/retentio-marts/{'raw' if raw else 'mart'}-{key}"
    if not _exists(spark, f"{path}/_SUCCESS"):
        customer_mart(spark, sf_dir, raw=raw).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

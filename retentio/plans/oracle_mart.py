"""DuckDB-dialect twins of the data-bridge tables, used by the SQL oracles.

They are written independently of the DataFrame code in
``retentio.sources.mart`` so the correctness gate compares two separate
derivations of the same definition.
"""

_LI_ORDER = """
li_o AS (
  SELECT l_orderkey,
         sum(l_quantity) AS qty,
         sum(CASE WHEN l_quantity > 45 THEN l_quantity - 45 ELSE 0.0 END) AS over_qty,
         count(*) FILTER (WHERE l_returnflag = 'R' AND l_discount > 0.085) AS n_roam,
         count(*) FILTER (WHERE l_linenumber % 2 = 1) AS n_peak,
         count(*) FILTER (WHERE l_linenumber % 2 = 0) AS n_offpeak
  FROM lineitem GROUP BY l_orderkey)"""

_DAILY = """
daily0 AS (
  SELECT o_custkey, o_orderdate,
         round(sum(o_totalprice), 2) AS rev,
         round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0 END), 2) AS rev_f,
         sum(coalesce(qty, 0.0)) AS qty,
         sum(coalesce(over_qty, 0.0)) AS over_qty,
         sum(coalesce(n_roam, 0)) AS n_roam,
         sum(coalesce(n_peak, 0)) AS n_peak,
         sum(coalesce(n_offpeak, 0)) AS n_offpeak,
         count(*) AS n_orders,
         count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS n_urgent,
         count(*) FILTER (WHERE o_orderstatus = 'O') AS n_open
  FROM orders LEFT JOIN li_o ON o_orderkey = l_orderkey
  GROUP BY o_custkey, o_orderdate),
daily AS (
  SELECT *, min(o_orderdate) OVER (PARTITION BY o_custkey) AS first_d,
            max(o_orderdate) OVER (PARTITION BY o_custkey) AS last_d
  FROM daily0),
act AS (
  SELECT o_custkey, min(first_d) AS first_d, max(last_d) AS last_d,
         round(sum(rev), 2) AS rev, round(sum(rev_f), 2) AS rev_f,
         round(sum(CASE WHEN 2 * date_diff('day', first_d, o_orderdate) > date_diff('day', first_d, last_d) THEN rev ELSE 0.0 END), 2) AS rev2,
         round(sum(CASE WHEN 2 * date_diff('day', first_d, o_orderdate) > date_diff('day', first_d, last_d) THEN 0.0 ELSE rev END), 2) AS rev1,
         sum(qty) AS qty,
         sum(CASE WHEN 2 * date_diff('day', first_d, o_orderdate) > date_diff('day', first_d, last_d) THEN qty ELSE 0.0 END) AS qty2,
         sum(CASE WHEN 2 * date_diff('day', first_d, o_orderdate) > date_diff('day', first_d, last_d) THEN 0.0 ELSE qty END) AS qty1,
         sum(over_qty) AS over_qty, sum(n_roam) AS n_roam, sum(n_peak) AS n_peak,
         sum(n_offpeak) AS n_offpeak, sum(n_orders) AS n_orders, sum(n_urgent) AS n_urgent,
         sum(n_open) AS n_open
  FROM daily GROUP BY o_custkey)"""

_EVENTS = """
ev AS (
  SELECT user_id,
         count(*) FILTER (WHERE event_type = 'error') AS DroppedCalls,
         count(*) FILTER (WHERE event_type = 'error' AND value > 30) AS BlockedCalls,
         count(*) FILTER (WHERE event_type = 'view' AND value < 10) AS UnansweredCalls,
         count(*) FILTER (WHERE event_type = 'signup') AS CustomerCareCalls,
         count(*) FILTER (WHERE event_type = 'click' AND value > 40) AS ThreewayCalls,
         count(*) AS ReceivedCalls,
         count(*) FILTER (WHERE event_type = 'click') AS OutboundCalls,
         count(*) FILTER (WHERE event_type = 'view') AS InboundCalls,
         count(*) FILTER (WHERE event_type = 'purchase' AND value < 5) AS CallForwardingCalls,
         count(*) FILTER (WHERE event_type = 'view' AND value > 40) AS CallWaitingCalls,
         count(*) FILTER (WHERE event_type = 'purchase') AS RetentionCalls,
         count(*) FILTER (WHERE event_type = 'purchase' AND value > 50) AS RetentionOffersAccepted
  FROM events GROUP BY user_id)"""

_EV_CONT = ["DroppedCalls", "BlockedCalls", "UnansweredCalls", "CustomerCareCalls",
            "ThreewayCalls", "ReceivedCalls", "OutboundCalls", "InboundCalls",
            "CallForwardingCalls", "CallWaitingCalls"]


def _mart_select(raw: bool) -> str:
    def ev(c):
        return f"CAST({c} AS DOUBLE)" if raw else f"CAST(coalesce({c}, 0) AS DOUBLE)"

    def nul(expr, m, r):
        return f"CASE WHEN c_custkey % {m} = {r} THEN NULL ELSE {expr} END" if raw else expr

    def disc(expr):
        return f"CAST({expr} AS VARCHAR)" if raw else f"CAST({expr} AS DOUBLE)"

    months = "CAST(floor(date_diff('day', first_d, last_d) / 30) + 1 AS BIGINT)"
    span = "date_diff('day', first_d, last_d)"
    idle = "date_diff('day', last_d, (SELECT max(o_orderdate) FROM orders))"
    hp = "CASE WHEN c_custkey % 5 = 0 THEN 'Unknown' ELSE CAST(10 * (1 + c_custkey % 7) AS VARCHAR) END"
    cols = [
        "c_custkey AS CustomerID",
        f"CASE WHEN {idle} > 365 THEN 'Yes' ELSE 'No' END AS Churn",
        "n_name AS ServiceArea",
        nul("CASE WHEN c_acctbal < 0 THEN '7-Lowest' WHEN c_acctbal < 2000 THEN '5-Low' "
            "WHEN c_acctbal < 5000 THEN '3-Good' WHEN c_acctbal < 8000 THEN '2-High' ELSE '1-Highest' END",
            10, 7) + " AS CreditRating",
        "c_mktsegment AS PrizmCode",
        "CASE c_custkey % 5 WHEN 0 THEN 'Professional' WHEN 1 THEN 'Clerical' WHEN 2 THEN 'Crafts' "
        "WHEN 3 THEN 'Retired' ELSE 'Other' END AS Occupation",
        nul("CASE c_custkey % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'No' ELSE 'Unknown' END", 10, 5) + " AS MaritalStatus",
        nul("CASE WHEN c_custkey % 4 = 0 THEN 'Yes' ELSE 'No' END", 10, 1) + " AS ChildrenInHH",
        "CASE WHEN c_custkey % 5 <> 0 THEN 'Yes' ELSE 'No' END AS HandsetWebCapable",
        "CASE WHEN c_custkey % 6 = 1 THEN 'Yes' ELSE 'No' END AS OwnsComputer",
        "CASE WHEN c_custkey % 3 <> 2 THEN 'Known' ELSE 'Unknown' END AS Homeownership",
        "CASE WHEN c_acctbal > 0 THEN 'Yes' ELSE 'No' END AS HasCreditCard",
        "CASE WHEN coalesce(RetentionCalls, 0) > 10 THEN 'Yes' ELSE 'No' END AS MadeCallToRetentionTeam",
        nul(f"round(rev / 1000 / {months}, 6)", 10, 3) + " AS MonthlyRevenue",
        f"round(qty / {months}, 6) AS MonthlyMinutes",
        nul(f"round(rev_f / 1000 / {months}, 6)", 10, 4) + " AS TotalRecurringCharge",
        "CAST(n_urgent AS DOUBLE) AS DirectorAssistedCalls",
        "CAST(over_qty AS DOUBLE) AS OverageMinutes",
        "CAST(n_roam AS DOUBLE) AS RoamingCalls",
        f"CASE WHEN {span} = 0 OR qty1 = 0 THEN NULL ELSE round((qty2 - qty1) / qty1 * 100, 6) END AS PercChangeMinutes",
        f"CASE WHEN {span} = 0 OR rev1 = 0 THEN NULL ELSE round((rev2 - rev1) / rev1 * 100, 6) END AS PercChangeRevenues",
    ]
    cols += [f"{ev(c)} AS {c}" for c in _EV_CONT]
    cols += [
        "CAST(n_peak AS DOUBLE) AS PeakCallsInOut",
        "CAST(n_offpeak AS DOUBLE) AS OffPeakCallsInOut",
        f"{ev('DroppedCalls')} + {ev('BlockedCalls')} AS DroppedBlockedCalls",
        nul("CASE WHEN c_custkey % 11 = 0 THEN 0.0 ELSE CAST(18 + c_custkey % 61 AS DOUBLE) END", 20, 9) + " AS AgeHH1",
        "CASE WHEN c_custkey % 3 = 0 THEN 0.0 ELSE CAST(18 + (c_custkey * 7) % 59 AS DOUBLE) END AS AgeHH2",
        f"{disc(months)} AS MonthsInService",
        f"{disc('1 + c_custkey % 3')} AS UniqueSubs",
        f"{disc('n_open')} AS ActiveSubs",
        f"{disc('CAST(1 + floor(n_orders / 5) AS BIGINT)')} AS Handsets",
        f"{disc('CAST(1 + floor(n_orders / 8) AS BIGINT)')} AS HandsetModels",
        f"{disc(idle)} AS CurrentEquipmentDays",
    ]
    for c in ["RetentionCalls", "RetentionOffersAccepted"]:
        cols.append(f"CAST({c} AS VARCHAR) AS {c}" if raw else f"{ev(c)} AS {c}")
    cols += [
        f"{disc('CASE WHEN c_custkey % 4 = 0 THEN c_custkey % 3 ELSE 0 END')} AS ReferralsMadeBySubscriber",
        f"{disc('c_custkey % 10')} AS IncomeGroup",
        f"{disc('c_custkey % 13')} AS AdjustmentsToCreditRating",
        (hp if raw else f"TRY_CAST({hp} AS DOUBLE)") + " AS HandsetPrice",
    ]
    body = ",\n         ".join(cols)
    return (f"SELECT {body}\n  FROM customer JOIN act ON c_custkey = o_custkey"
            "\n  LEFT JOIN nation ON c_nationkey = n_nationkey"
            "\n  LEFT JOIN ev ON c_custkey = user_id")


def mart_ctes(raw: bool = False, name: str = "mart") -> str:
    """CTE list ending in ``{name}`` (feature flavour) or the raw flavour."""
    return ",".join([_LI_ORDER, _DAILY, _EVENTS]) + f",\n{name} AS (\n  {_mart_select(raw)})"


SCORED_CTE = """
scored AS (
  SELECT CustomerID AS id,
         CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label,
         (350 * CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END + (CustomerID * 7919) % 650) / 1000.0 AS p1,
         (250 * CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END + (CustomerID * 104729 + 17) % 750) / 1000.0 AS p2,
         (least(CAST(CurrentEquipmentDays AS BIGINT), 500) + (CustomerID * 31) % 500) / 1000.0 AS p3
  FROM mart)"""

USAGE_CTE = """
udaily AS (
  SELECT user_id AS id, CAST(ts AS DATE) AS day, count(*) AS n,
         round(sum(value), 2) AS value,
         count(*) FILTER (WHERE event_type = 'error') AS n_error
  FROM events GROUP BY user_id, CAST(ts AS DATE)),
usage AS (
  SELECT id, day,
         CAST(date_diff('day', (SELECT min(CAST(ts AS DATE)) FROM events), day) + 1 AS INTEGER) AS t,
         n, value, n_error,
         CASE WHEN lead(day) OVER (PARTITION BY id ORDER BY day) IS NULL
                OR date_diff('day', day, lead(day) OVER (PARTITION BY id ORDER BY day)) > 1
              THEN 1 ELSE 0 END AS label
  FROM udaily)"""


def with_mart(body: str, raw: bool = False, scored: bool = False) -> str:
    ctes = mart_ctes(raw=False)
    if raw:
        ctes += "," + mart_ctes_raw_only()
    if scored:
        ctes += "," + SCORED_CTE
    return f"WITH {ctes}\n{body}"


def mart_ctes_raw_only() -> str:
    return f"\nraw AS (\n  {_mart_select(True)})"


def with_usage(body: str) -> str:
    return f"WITH {USAGE_CTE}\n{body}"

"""Column roles: the single source of truth for which column plays which part."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ColumnRoles:
    id: str = "CustomerID"
    target: str = "Churn"
    categorical: tuple[str, ...] = ()
    binary: tuple[str, ...] = ()
    continuous: tuple[str, ...] = ()
    discrete: tuple[str, ...] = ()
    excluded: tuple[str, ...] = field(default_factory=tuple)

    @property
    def numeric(self) -> tuple[str, ...]:
        return self.continuous + self.discrete

    @property
    def strings(self) -> tuple[str, ...]:
        return self.categorical + self.binary

    def present(self, columns, group: str) -> list[str]:
        cols = set(columns)
        return [c for c in getattr(self, group) if c in cols]


# Roles of the churn mart built by ``retentio.sources.mart``.
CHURN_ROLES = ColumnRoles(
    categorical=("ServiceArea", "CreditRating", "PrizmCode", "Occupation", "MaritalStatus"),
    binary=("ChildrenInHH", "HandsetWebCapable", "OwnsComputer", "Homeownership", "HasCreditCard",
            "MadeCallToRetentionTeam"),
    continuous=("MonthlyRevenue", "MonthlyMinutes", "TotalRecurringCharge", "DirectorAssistedCalls",
                "OverageMinutes", "RoamingCalls", "PercChangeMinutes", "PercChangeRevenues", "DroppedCalls",
                "BlockedCalls", "UnansweredCalls", "CustomerCareCalls", "ThreewayCalls", "ReceivedCalls",
                "OutboundCalls", "InboundCalls", "PeakCallsInOut", "OffPeakCallsInOut", "DroppedBlockedCalls",
                "CallForwardingCalls", "CallWaitingCalls", "AgeHH1", "AgeHH2"),
    discrete=("MonthsInService", "UniqueSubs", "ActiveSubs", "Handsets", "HandsetModels", "CurrentEquipmentDays",
              "RetentionCalls", "RetentionOffersAccepted", "ReferralsMadeBySubscriber", "IncomeGroup",
              "AdjustmentsToCreditRating", "HandsetPrice"),
)

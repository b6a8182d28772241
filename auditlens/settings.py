"""Settings of a build. Every builder takes them as an argument; nothing reads the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType


@dataclass(frozen=True)
class CustomClient:
    """A user-defined client type. A field left out sets no condition."""

    client_name: str
    user_agent: str | None = None
    principal_email: str | None = None

    def __post_init__(self) -> None:
        if not self.user_agent and not self.principal_email:
            raise ValueError(f"custom client {self.client_name!r} needs an agent or an email")


# Default prices and weights, which results depend on.
SLOT_PRICES = MappingProxyType({"standard": 0.04, "enterprise": 0.06, "enterprise_plus": 0.10})
ON_DEMAND_PRICE_PER_TIB = 6.225


@dataclass(frozen=True)
class Settings:
    # The day that stands for "today".
    as_of: dt.date

    # Weights of the priority, threat and importance scores.
    priority_threat_weight: float = 0.65
    priority_importance_weight: float = 0.35
    threat_egress_weight: float = 0.35
    threat_query_cost_weight: float = 0.30
    threat_build_cost_weight: float = 0.25
    threat_errors_weight: float = 0.10
    importance_service_weight: float = 0.2
    importance_dbt_weight: float = 0.2
    importance_egress_weight: float = 0.35
    importance_breadth_weight: float = 0.25

    # Client types that score 1 to 4 in the egress part of importance.
    importance_clients_1: tuple[str, ...] = ("Web console",)
    importance_clients_2: tuple[str, ...] = (
        "Connected Sheet - User Initiated",
        "Connected Sheet - Scheduled",
        "Scheduled Query",
    )
    importance_clients_3: tuple[str, ...] = ()
    importance_clients_4: tuple[str, ...] = ()

    prod_datasets: tuple[str, ...] = ()
    stage_datasets: tuple[str, ...] = ()
    custom_clients: tuple[CustomClient, ...] = ()
    egress_emails: tuple[str, ...] = ()

    pricing_schedule: str = "on_demand"
    on_demand_price_per_tib: float = ON_DEMAND_PRICE_PER_TIB
    slot_prices: Mapping[str, float] = field(default_factory=lambda: SLOT_PRICES)

    # Reports: build them at all, and demand a date range from their readers.
    enable_reports: bool = True
    require_partition_filter: bool = True

    # Development limit: only the last days of the log, on named targets.
    enable_dev_limits: bool = True
    dev_limit_days: int = 30
    dev_targets: tuple[str, ...] = ("dev",)
    target: str = "prod"

    # Incremental runs take today and this many days before.
    lookback_days: int = 3
    # Snapshots of an upserted table, and states of a table by day, that stay for their readers, the
    # latest included, and how many
    # upserts write their own rows only, before the next snapshot is written.
    kept_snapshots: int = 3
    versions_per_snapshot: int = 7

    def __post_init__(self) -> None:
        if self.kept_snapshots < 2:
            raise ValueError("the snapshot before the latest has to stay for its readers")
        if self.pricing_schedule != "on_demand" and self.pricing_schedule not in self.slot_prices:
            raise ValueError(f"no price for schedule {self.pricing_schedule!r}")

    @property
    def lookback_start(self) -> dt.date:
        return self.as_of - dt.timedelta(days=self.lookback_days)

    @property
    def lookback(self) -> list[dt.date]:
        """The days an incremental run replaces: today and those before it, oldest first."""
        return [self.as_of - dt.timedelta(days=n) for n in range(self.lookback_days, -1, -1)]

    @property
    def dev_limit_start(self) -> dt.date | None:
        """First day kept under the development limit, or None where it does not apply."""
        if self.enable_dev_limits and self.target in self.dev_targets:
            return self.as_of - dt.timedelta(days=self.dev_limit_days)
        return None

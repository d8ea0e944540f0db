"""What each feed's columns mean. Cleansing, profiling and metrics are driven by these."""

from __future__ import annotations

from dataclasses import dataclass, field

from ledgerlake.functions.cleanse import COUNT, CURRENCY, MEASURE


@dataclass(frozen=True)
class FeedSpec:
    name: str
    columns: tuple[str, ...]
    key: str
    foreign_keys: tuple[str, ...] = ()
    ts: str | None = None
    metric: str = ""
    secondary: str = ""
    optional: tuple[str, str] = ("", "")
    roles: dict[str, str] = field(default_factory=dict)
    categories: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    codes: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()
    file_format: str = "json"
    dated: bool = False  # lands in dated folders

    @property
    def keys(self) -> tuple[str, ...]:
        return (self.key, *self.foreign_keys)

    @property
    def secondary_is_count(self) -> bool:
        return self.roles.get(self.secondary) == COUNT


SPECS: dict[str, FeedSpec] = {
    s.name: s
    for s in (
        FeedSpec(
            "customers_crm",
            (
                "customer_id", "full_name", "ssn", "email", "phone", "loyalty_tier", "credit_limit_usd",
                "reward_points", "home_lat", "home_lon",
            ),
            key="customer_id",
            metric="credit_limit_usd",
            secondary="reward_points",
            optional=("phone", "loyalty_tier"),
            roles={"credit_limit_usd": CURRENCY, "reward_points": COUNT, "home_lat": MEASURE, "home_lon": MEASURE},
            categories=("loyalty_tier",),
            texts=("full_name",),
            pii=("ssn", "email"),
        ),
        FeedSpec(
            "merchants_stores",
            (
                "merchant_id", "store_name", "merchant_category", "terminal_monthly_fee_usd",
                "commission_rate_pct", "store_manager_code", "region_notes",
            ),
            key="merchant_id",
            metric="terminal_monthly_fee_usd",
            secondary="commission_rate_pct",
            optional=("store_manager_code", "region_notes"),
            roles={"terminal_monthly_fee_usd": CURRENCY, "commission_rate_pct": MEASURE},
            categories=("merchant_category",),
            texts=("store_name",),
            file_format="csv",
        ),
        FeedSpec(
            "device_auth_logs",
            (
                "session_id", "device_id", "customer_id", "auth_event", "auth_latency_ms", "risk_score_raw",
                "user_agent", "mfa_method", "event_ts",
            ),
            key="session_id",
            foreign_keys=("device_id", "customer_id"),
            ts="event_ts",
            metric="auth_latency_ms",
            secondary="risk_score_raw",
            optional=("user_agent", "mfa_method"),
            roles={"auth_latency_ms": MEASURE, "risk_score_raw": MEASURE},
            categories=("auth_event",),
            dated=True,
        ),
        FeedSpec(
            "payment_transactions",
            (
                "transaction_id", "customer_id", "merchant_id", "device_id", "ssn", "payment_method",
                "tx_amount", "discount_pct", "promo_code", "device_ip", "tx_lat", "tx_lon", "tx_status", "tx_ts",
            ),
            key="transaction_id",
            foreign_keys=("customer_id", "merchant_id", "device_id"),
            ts="tx_ts",
            metric="tx_amount",
            secondary="net_amount_after_discount",
            optional=("device_ip", "promo_code"),
            roles={"tx_amount": CURRENCY, "discount_pct": MEASURE, "tx_lat": MEASURE, "tx_lon": MEASURE},
            categories=("tx_status",),
            codes=("payment_method",),
            pii=("ssn",),
            dated=True,
        ),
        FeedSpec(
            "chargeback_disputes",
            (
                "dispute_id", "transaction_id", "reason_code", "dispute_amount", "penalty_fee_usd",
                "customer_statement", "agent_notes",
            ),
            key="dispute_id",
            foreign_keys=("transaction_id",),
            metric="dispute_amount",
            secondary="penalty_fee_usd",
            optional=("customer_statement", "agent_notes"),
            roles={"dispute_amount": CURRENCY, "penalty_fee_usd": CURRENCY},
            categories=("reason_code",),
            dated=True,
        ),
    )
}

# Referential edges: child feed, foreign key, parent feed.
EDGES: tuple[tuple[str, str, str], ...] = (
    ("payment_transactions", "customer_id", "customers_crm"),
    ("payment_transactions", "merchant_id", "merchants_stores"),
    ("device_auth_logs", "customer_id", "customers_crm"),
    ("chargeback_disputes", "transaction_id", "payment_transactions"),
)
RING_DEVICE = "DEV-FRAUD-999"
STATUS_PRIORITY = {"SETTLED": 3, "AUTHORIZED": 2, "PENDING": 1}
HIGH_RISK_CATEGORIES = ("CRYPTO", "GAMBLING")

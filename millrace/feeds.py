"""The eight feeds: columns, widths, types, keys, rules, and how each is merged.

Everything a feed differs in is data here; the operators are the same for all.
"""

from __future__ import annotations

from dataclasses import dataclass

from millrace.functions.casts import storage_type
from millrace.operators.quality import Accepted, Matches, NotNull, Parses, Rule


@dataclass(frozen=True)
class Field:
    """A column: landing width in characters, and its staging type."""

    name: str
    width: int
    kind: str = "string"


@dataclass(frozen=True)
class Target:
    """The table a feed's changes end up in."""

    table: str
    job: str
    kind: str  # scd2, upsert or append
    surrogate: str | None = None
    stamp: str = "updated_at"
    update: tuple[str, ...] | None = None  # columns a match overwrites; None is all


@dataclass(frozen=True)
class Feed:
    name: str
    key: str
    fields: tuple[Field, ...]
    rules: tuple[Rule, ...]
    target: Target
    update: tuple[str, ...] | None = None  # columns a staging match overwrites; None is all
    gate: tuple[str, ...] = ()  # a staging match counts only when one of these differs
    insert_only: bool = False
    month: str | None = None  # typed column whose month partitions the merged tables; no update changes it
    buckets: int = 64  # of the key's hash, by which they are partitioned without a month
    multiline: bool = True  # values in quotes may hold line breaks; a file is then read by one task

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def raw_table(self) -> str:
        return f"RAW.RAW_{self.name.upper()}"

    @property
    def stage_table(self) -> str:
        return f"STAGING.STG_{self.name.upper()}"

    @property
    def load_job(self) -> str:
        return f"S3_TO_RAW_{self.name.upper()}"

    @property
    def stage_job(self) -> str:
        return f"RAW_TO_STAGING_{self.name.upper()}"

    @property
    def validate_job(self) -> str:
        return f"VALIDATE_RAW_{self.name.upper()}"

    @property
    def landing_schema(self) -> str:
        return ", ".join(f"{c} string" for c in self.columns)

    @property
    def raw_schema(self) -> str:
        return f"{self.landing_schema}, source_file_name string, _load_ts timestamp_ntz"

    @property
    def typed_schema(self) -> str:
        return ", ".join(f"{f.name} {storage_type(f.kind)}" for f in self.fields)

    @property
    def stage_schema(self) -> str:
        return f"{self.typed_schema}, updated_at timestamp_ntz"

    @property
    def change_schema(self) -> str:
        return f"{self.stage_schema}, _action string, _is_update boolean, _changed_at timestamp_ntz"

    @property
    def target_schema(self) -> str:
        parts = [f"{self.target.surrogate} bigint"] if self.target.surrogate else []
        parts.append(self.typed_schema)
        if self.name == "cdr":
            parts.append("usage_date date")
        if self.name == "support_tickets":
            parts.append("resolution_minutes decimal(10,0)")
        if self.target.kind == "scd2":
            parts.append("eff_start_ts timestamp_ntz, eff_end_ts timestamp_ntz, is_current boolean")
        else:
            parts.append(f"{self.target.stamp} timestamp_ntz")
        return ", ".join(parts)


# Accepted codes.
REGIONS = ("NORTH", "SOUTH", "EAST", "WEST")
AMOUNT = "decimal(12,2)"
STAMP_HINT = " (expected YYYY-MM-DD HH24:MI:SS)"

CUSTOMERS = Feed(
    name="customers",
    key="customer_id",
    fields=(
        Field("customer_id", 20),
        Field("first_name", 100),
        Field("last_name", 100),
        Field("date_of_birth", 20, "date"),
        Field("national_id", 30),
        Field("email", 200),
        Field("phone_number", 30),
        Field("address_line1", 200),
        Field("city", 100),
        Field("region", 50),
        Field("postal_code", 20),
        Field("plan_id", 20),
        Field("activation_date", 20, "date"),
        Field("account_status", 20),
        Field("customer_segment", 30),
        Field("credit_score", 10, "decimal(5,0)"),
    ),
    rules=(
        NotNull("customer_id"),
        Parses("date_of_birth"),
        Parses("activation_date"),
        Accepted("account_status", ("ACTIVE", "SUSPENDED", "CHURNED")),
        Accepted("customer_segment", ("CONSUMER", "SME", "ENTERPRISE")),
        Accepted("region", REGIONS),
    ),
    gate=("account_status", "plan_id", "address_line1", "region"),
    target=Target("dim_customer", "STAGING_TO_CURATED_DIM_CUSTOMER", "scd2", surrogate="customer_sk"),
)

PLANS = Feed(
    name="plans",
    key="plan_id",
    fields=(
        Field("plan_id", 20),
        Field("plan_name", 100),
        Field("plan_type", 20),
        Field("monthly_fee", 20, "decimal(10,2)"),
        Field("data_limit_gb", 20, "decimal(10,2)"),
        Field("voice_minutes", 20, "decimal(10,0)"),
        Field("sms_count", 20, "decimal(10,0)"),
        Field("currency", 10),
        Field("effective_date", 20, "date"),
    ),
    rules=(NotNull("plan_id"), Parses("effective_date"), Accepted("plan_type", ("PREPAID", "POSTPAID"))),
    target=Target("dim_plan", "STAGING_TO_CURATED_DIM_PLAN", "upsert", surrogate="plan_sk"),
)

DEVICES = Feed(
    name="devices",
    key="device_id",
    fields=(
        Field("device_id", 20),
        Field("imei", 30),
        Field("customer_id", 20),
        Field("device_model", 100),
        Field("device_os", 50),
        Field("activation_date", 20, "date"),
        Field("device_status", 20),
    ),
    rules=(NotNull("device_id"), Parses("activation_date"), Accepted("device_status", ("ACTIVE", "INACTIVE"))),
    target=Target(
        "dim_device",
        "STAGING_TO_CURATED_DIM_DEVICE",
        "upsert",
        surrogate="device_sk",
        update=("imei", "customer_id", "device_model", "device_os", "device_status"),
    ),
)

CDR = Feed(
    name="cdr",
    key="cdr_id",
    fields=(
        Field("cdr_id", 40),
        Field("customer_id", 20),
        Field("call_type", 10),
        Field("origin_number", 30),
        Field("destination_number", 30),
        Field("cell_tower_id", 20),
        Field("call_start_ts", 30, "timestamp"),
        Field("call_end_ts", 30, "timestamp"),
        Field("duration_seconds", 20, "decimal(10,0)"),
        Field("data_volume_mb", 20, "decimal(12,3)"),
        Field("roaming_flag", 5, "flag"),
        Field("region", 50),
    ),
    rules=(
        NotNull("cdr_id"),
        Parses("call_start_ts", "timestamp", STAMP_HINT),
        Parses("call_end_ts", "timestamp", STAMP_HINT),
        Accepted("call_type", ("VOICE", "SMS", "DATA")),
        Accepted("roaming_flag", ("Y", "N"), any_case=True),
        Accepted("region", REGIONS),
    ),
    insert_only=True,
    target=Target("fact_cdr_usage", "STAGING_TO_CURATED_FACT_CDR", "append", stamp="loaded_at"),
)

BILLING = Feed(
    name="billing",
    key="invoice_id",
    fields=(
        Field("invoice_id", 20),
        Field("customer_id", 20),
        Field("billing_period", 10),
        Field("plan_id", 20),
        Field("usage_charges", 20, AMOUNT),
        Field("tax_amount", 20, AMOUNT),
        Field("total_amount", 20, AMOUNT),
        Field("invoice_date", 20, "date"),
        Field("due_date", 20, "date"),
        Field("invoice_status", 20),
    ),
    rules=(
        NotNull("invoice_id"),
        Matches("billing_period"),
        Parses("invoice_date"),
        Parses("due_date"),
        Accepted("invoice_status", ("PAID", "OPEN", "OVERDUE")),
    ),
    update=("usage_charges", "tax_amount", "total_amount", "invoice_status"),
    month="billing_period",
    target=Target(
        "fact_billing",
        "STAGING_TO_CURATED_FACT_BILLING",
        "upsert",
        stamp="loaded_at",
        update=("total_amount", "invoice_status"),
    ),
)

PAYMENTS = Feed(
    name="payments",
    key="payment_id",
    fields=(
        Field("payment_id", 20),
        Field("invoice_id", 20),
        Field("customer_id", 20),
        Field("payment_date", 20, "date"),
        Field("amount", 20, AMOUNT),
        Field("payment_method", 30),
        Field("card_last4", 10),
        Field("payment_status", 20),
    ),
    rules=(
        NotNull("payment_id"),
        Parses("payment_date"),
        Accepted("payment_method", ("CARD", "BANK_TRANSFER", "WALLET", "CASH")),
        Accepted("payment_status", ("SUCCESS", "FAILED", "PENDING", "REFUNDED")),
    ),
    update=("payment_status", "amount"),
    month="payment_date",
    target=Target(
        "fact_payments",
        "STAGING_TO_CURATED_FACT_PAYMENTS",
        "upsert",
        stamp="loaded_at",
        update=("payment_status", "amount"),
    ),
)

TOWERS = Feed(
    name="towers",
    key="tower_id",
    fields=(
        Field("tower_id", 20),
        Field("region", 50),
        Field("latitude", 20, "decimal(9,6)"),
        Field("longitude", 20, "decimal(9,6)"),
        Field("capacity_mbps", 20, "decimal(10,0)"),
        Field("tower_status", 20),
    ),
    rules=(
        NotNull("tower_id"),
        Accepted("region", REGIONS),
        Accepted("tower_status", ("ACTIVE", "MAINTENANCE", "INACTIVE")),
    ),
    update=("tower_status", "capacity_mbps"),
    target=Target(
        "dim_tower",
        "STAGING_TO_CURATED_DIM_TOWER",
        "upsert",
        surrogate="tower_sk",
        update=("tower_status", "capacity_mbps"),
    ),
)

SUPPORT_TICKETS = Feed(
    name="support_tickets",
    key="ticket_id",
    fields=(
        Field("ticket_id", 20),
        Field("customer_id", 20),
        Field("opened_at", 30, "timestamp"),
        Field("closed_at", 30, "timestamp"),
        Field("category", 50),
        Field("priority", 10),
        Field("ticket_status", 20),
        Field("channel", 20),
    ),
    rules=(
        NotNull("ticket_id"),
        Parses("opened_at", "timestamp", ""),
        Parses("closed_at", "timestamp", ""),
        Accepted("category", ("BILLING", "NETWORK", "DEVICE", "PLAN_CHANGE", "OTHER")),
        Accepted("priority", ("LOW", "MEDIUM", "HIGH", "URGENT")),
        Accepted("ticket_status", ("OPEN", "CLOSED", "IN_PROGRESS", "ESCALATED")),
        Accepted("channel", ("CALL", "CHAT", "EMAIL", "APP")),
    ),
    update=("closed_at", "ticket_status"),
    month="opened_at",
    target=Target(
        "fact_support_tickets",
        "STAGING_TO_CURATED_FACT_TICKETS",
        "upsert",
        stamp="loaded_at",
        update=("closed_at", "ticket_status", "resolution_minutes"),
    ),
)

FEEDS: dict[str, Feed] = {
    f.name: f for f in (CUSTOMERS, PLANS, DEVICES, CDR, BILLING, PAYMENTS, TOWERS, SUPPORT_TICKETS)
}

# The order in which changes are carried over to their targets.
CURATED_ORDER = ("customers", "plans", "devices", "towers", "cdr", "billing", "payments", "support_tickets")


def pick(names: str | list[str] | tuple[str, ...] = "all") -> list[Feed]:
    """Feeds by name: 'all', 'a,b' or a sequence."""
    if names == "all":
        return list(FEEDS.values())
    wanted = names.split(",") if isinstance(names, str) else list(names)
    return [FEEDS[n.strip()] for n in wanted]

"""Masks, row filters and classification tags attached to tables.

They apply to base tables, under the reports: a regional analyst's totals cover only the
rows that analyst may see.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import masks

Mask = Callable[[str, str], Column]

# Roles without a row filter, and the regions of the others.
OPEN_ROLES = (
    "R_TELECOM_ADMIN",
    "R_DATA_ENGINEER",
    "R_DATA_GOVERNANCE",
    "R_ANALYST_GLOBAL",
    "R_COMPLIANCE_OFFICER",
)
ROLE_REGIONS = (("R_ANALYST_NORTH", "NORTH"), ("R_ANALYST_SOUTH", "SOUTH"))

# Masks and row filters by table.
MASKS: dict[str, dict[str, Mask]] = {
    "dim_customer": {
        "national_id": masks.mask_national_id,
        "email": masks.mask_email,
        "phone_number": masks.mask_phone,
        "address_line1": masks.mask_address,
        "date_of_birth": masks.mask_birth_date,
    },
    "fact_payments": {"card_last4": masks.mask_card},
    "fact_cdr_usage": {"origin_number": masks.mask_phone, "destination_number": masks.mask_phone},
}
ROW_FILTERS = {"dim_customer": "region", "fact_cdr_usage": "region", "dim_tower": "region"}

# Table, column, classification, category.
TAGS = (
    ("dim_customer", "first_name", "PII", "NAME"),
    ("dim_customer", "last_name", "PII", "NAME"),
    ("dim_customer", "date_of_birth", "PII", "DOB"),
    ("dim_customer", "national_id", "CONFIDENTIAL", "NATIONAL_ID"),
    ("dim_customer", "email", "PII", "CONTACT_INFO"),
    ("dim_customer", "phone_number", "PII", "CONTACT_INFO"),
    ("dim_customer", "address_line1", "PII", "ADDRESS"),
    ("dim_customer", "credit_score", "FINANCIAL", "NONE"),
    ("fact_payments", "card_last4", "FINANCIAL", "PAYMENT_CARD"),
    ("fact_payments", "amount", "FINANCIAL", "NONE"),
    ("fact_cdr_usage", "origin_number", "PII", "CONTACT_INFO"),
    ("fact_cdr_usage", "destination_number", "PII", "CONTACT_INFO"),
    ("fact_billing", "total_amount", "FINANCIAL", None),
    ("fact_billing", "usage_charges", "FINANCIAL", None),
)


def apply_masks(df: DataFrame, attached: Mapping[str, Mask], role: str) -> DataFrame:
    """One projection; columns without a mask pass through."""
    return df.select(*[attached[c](c, role).alias(c) if c in attached else F.col(c) for c in df.columns])


def row_filter(df: DataFrame, column: str, role: str, role_map: DataFrame | Iterable[tuple[str, str]]) -> DataFrame:
    """Rows whose `column` value the role may see; a role absent from the map sees none.

    A map given as pairs becomes a literal list, which reaches the Parquet scan. A map
    given as a table is semi-joined; duplicates in it do no harm.
    """
    if role in OPEN_ROLES:
        return df
    if isinstance(role_map, DataFrame):
        allowed = role_map.where(F.col("role_name") == role).select(F.col("region").alias(column)).distinct()
        return df.join(allowed, column, "left_semi").select(*df.columns)
    regions = sorted({region for name, region in role_map if name == role})
    return df.where(F.col(column).isin(*regions)) if regions else df.where(F.lit(False))


def secure(
    tables: Mapping[str, DataFrame],
    role: str,
    role_map: DataFrame | Iterable[tuple[str, str]] = ROLE_REGIONS,
) -> dict[str, DataFrame]:
    """Every table as the role sees it: row filter first, on the bare values, then masks."""
    seen = {}
    for name, df in tables.items():
        if name in ROW_FILTERS:
            df = row_filter(df, ROW_FILTERS[name], role, role_map)
        seen[name] = apply_masks(df, MASKS[name], role) if name in MASKS else df
    return seen


def tag_columns(table: str, df: DataFrame) -> DataFrame:
    """Attach the table's tags as column metadata."""
    tags = {
        column: {k: v for k, v in (("data_classification", level), ("pii_category", category)) if v}
        for name, column, level, category in TAGS
        if name == table
    }
    return df.select(*[F.col(c).alias(c, metadata=tags[c]) if c in tags else F.col(c) for c in df.columns])


def sensitive_inventory(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tagged columns with how many values each holds; one aggregation per table."""
    report = None
    for table, df in tables.items():
        tags = [t for t in TAGS if t[0] == table and t[1] in df.columns]
        if not tags:
            continue
        counts = df.agg(*[F.count(column).alias(column) for _, column, _, _ in tags])
        lines = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(column).alias("column_name"),
                F.lit(level).alias("data_classification"),
                F.lit(category).cast("string").alias("pii_category"),
                F.col(column).alias("values_held"),
            )
            for _, column, level, category in tags
        ]
        part = counts.select(F.inline(F.array(*lines)))
        report = part if report is None else report.unionByName(part)
    if report is None:
        raise ValueError("no table has tagged columns")
    return report

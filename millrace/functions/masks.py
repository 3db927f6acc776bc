"""Column masks by role.

The role is known when the plan is built, so each mask is one plain expression and a
privileged role gets the bare column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.casts import as_col

# Roles and the constants masks return.
SEES_ALL = ("R_COMPLIANCE_OFFICER", "R_TELECOM_ADMIN")
ANALYSTS = ("R_ANALYST_GLOBAL", "R_ANALYST_NORTH", "R_ANALYST_SOUTH")
SEES_AMOUNTS = ("R_COMPLIANCE_OFFICER", "R_TELECOM_ADMIN", "R_DATA_ENGINEER")
EMAIL_HIDDEN = "***MASKED***"
ADDRESS_HIDDEN = "***ADDRESS REDACTED***"


def mask_national_id(c: Column | str, role: str) -> Column:
    value = as_col(c)
    return value if role in SEES_ALL else F.concat(F.lit("XXX-XX-"), F.right(value, F.lit(4)))


def mask_email(c: Column | str, role: str) -> Column:
    value = as_col(c)
    if role in SEES_ALL:
        return value
    if role in ANALYSTS:
        return F.concat(F.lit("***@"), F.split_part(value, F.lit("@"), F.lit(2)))
    return F.lit(EMAIL_HIDDEN)


def mask_phone(c: Column | str, role: str) -> Column:
    value = as_col(c)
    if role in SEES_ALL:
        return value
    return F.concat(F.left(value, F.lit(3)), F.lit("-XXX-"), F.right(value, F.lit(2)))


def mask_address(c: Column | str, role: str) -> Column:
    """The constant stands in for null too."""
    return as_col(c) if role in SEES_ALL else F.lit(ADDRESS_HIDDEN)


def mask_birth_date(c: Column | str, role: str) -> Column:
    value = as_col(c)
    if role in SEES_ALL:
        return value
    if role in ANALYSTS:
        return F.make_date(F.year(value), F.lit(1), F.lit(1))
    return F.lit(None).cast("date")


def mask_card(c: Column | str, role: str) -> Column:
    value = as_col(c)
    return value if role in SEES_ALL else F.concat(F.lit("**"), F.right(value, F.lit(2)))


def round_currency(c: Column | str, role: str) -> Column:
    """Tens only, kept at decimal(12,2)."""
    value = as_col(c)
    return value if role in SEES_AMOUNTS else F.round(value, -1).cast("decimal(12,2)")

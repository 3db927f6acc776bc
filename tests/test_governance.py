import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import masks
from millrace.operators import governance as g

SCHEMA = "national_id string, email string, phone_number string, address_line1 string, date_of_birth date, region string"
ROW = ("123456789", "a@b.example", "+15551234", "1 Main St", dt.date(1980, 5, 6), "NORTH")


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([ROW, (None,) * 6], SCHEMA)


def as_seen(customers, role):
    return [tuple(r) for r in g.apply_masks(customers, g.MASKS["dim_customer"], role).collect()]


def test_privileged_roles_see_all(customers):
    assert as_seen(customers, "R_TELECOM_ADMIN") == [ROW, (None,) * 6]


def test_analysts_see_less(customers):
    full, empty = as_seen(customers, "R_ANALYST_SOUTH")
    assert full == ("XXX-XX-6789", "***@b.example", "+15-XXX-34", "***ADDRESS REDACTED***", dt.date(1980, 1, 1), "NORTH")
    assert empty == (None, None, None, "***ADDRESS REDACTED***", None, None)


def test_others_see_least(customers):
    full, empty = as_seen(customers, "R_DATA_ENGINEER")
    assert full[1] == "***MASKED***" and full[4] is None
    assert empty == (None, "***MASKED***", None, "***ADDRESS REDACTED***", None, None)


def test_email_without_at_sign(spark):
    df = spark.createDataFrame([("plain",)], "e string")
    assert df.select(masks.mask_email("e", "R_ANALYST_GLOBAL")).first()[0] == "***@"


def test_card_and_currency(spark):
    df = spark.sql("SELECT '0042' c, CAST(1234.56 AS decimal(12,2)) m, CAST(NULL AS decimal(12,2)) n")
    seen = df.select(masks.mask_card("c", "x").alias("c"), masks.round_currency("m", "x").alias("m"), masks.round_currency("n", "x").alias("n"))
    assert tuple(seen.first()) == ("**42", Decimal("1230.00"), None)
    assert seen.schema["m"].dataType.simpleString() == "decimal(12,2)"
    assert df.select(masks.round_currency("m", "R_DATA_ENGINEER")).first()[0] == Decimal("1234.56")


@pytest.mark.parametrize("as_table", [False, True])
def test_row_filter(spark, customers, as_table):
    pairs = [*g.ROLE_REGIONS, *g.ROLE_REGIONS]
    role_map = spark.createDataFrame(pairs, "role_name string, region string") if as_table else pairs
    counts = {r: g.row_filter(customers, "region", r, role_map).count() for r in ("R_ANALYST_NORTH", "R_ANALYST_SOUTH", "R_OTHER", "R_DATA_ENGINEER")}
    assert counts == {"R_ANALYST_NORTH": 1, "R_ANALYST_SOUTH": 0, "R_OTHER": 0, "R_DATA_ENGINEER": 2}


def test_policies_apply_to_the_right_tables(spark, customers):
    tables = {"dim_customer": customers, "fact_billing": customers}
    seen = g.secure(tables, "R_ANALYST_SOUTH")
    assert seen["dim_customer"].count() == 0 and seen["fact_billing"].count() == 2


def test_tags_and_inventory(spark, customers):
    tagged = g.tag_columns("dim_customer", customers)
    assert tagged.schema["email"].metadata == {"data_classification": "PII", "pii_category": "CONTACT_INFO"}
    assert tagged.schema["region"].metadata == {}
    found = {r.column_name: r.values_held for r in g.sensitive_inventory({"dim_customer": customers}).collect()}
    assert found == {"date_of_birth": 1, "national_id": 1, "email": 1, "phone_number": 1, "address_line1": 1}
    assert len(g.TAGS) == 14

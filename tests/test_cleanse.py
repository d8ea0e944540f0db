"""Column functions on hand-written dirt."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import cleanse as c
from ledgerlake.functions import features as feat
from ledgerlake.functions import privacy


def apply(spark, values, f, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


NUMBERS = [
    ("12.5", "12.50"), ("$1,234.50", "1234.50"), ("($1,234.50)", "-1234.50"), ("$(5)", "-5.00"), ("( 7.25 )*", "-7.25"),
    ("1,000 pts*", "1000.00"), ("45 #", "45.00"), ("12ms", "12.00"), ("12 MS!", "12.00"), ("3.25%", "3.25"),
    ("-30 deg", "-30.00"), ("USD 9", "9.00"), ("9 USD", "9.00"), (".5", "0.50"), ("7.", "7.00"), ("+3", "3.00"),
    ("12.345", "12.35"), ("-12.345", "-12.35"), ("0", "0.00"), ("\t8 ", "8.00"), ("1,234,567.8", "1234567.80"),
    ("abc", None), ("", None), (" ", None), ("{}", None), ("1.2.3", None), ("1-2", None), ("NaN", None), ("1d", None),
    ("-$5.00", "-5.00"), ("(USD 5.00)", "-5.00"), ("(5 pts)", "-5.00"), ("5.00-", "-5.00"), ("5.00 USD -", "-5.00"), ("USD +4", "4.00"),
    ("12,5", None), ("1,2,3", None), ("1,2345", None), ("5)", None), ("--5", None), ("-5-", None), ("(-5)", None), ("1e5", None), ("-", None),
    ("12abc", None), ("1 2", None), ("(12", None), ("1usd2", None), (None, None), ("99999999999999999999", None),
]


@pytest.mark.parametrize("accounting", [True, False])
def test_parse_number(spark, accounting):
    got = apply(spark, [t for t, _ in NUMBERS], lambda v: c.parse_number(v, accounting=accounting))
    want = [None if w is None else Decimal(w) for _, w in NUMBERS]
    if not accounting:
        want = [abs(w) if w is not None and "(" in t else w for (t, _), w in zip(NUMBERS, want)]
    assert got == want


def test_parse_number_types(spark):
    assert apply(spark, ["12 pts", "1.5", "x"], lambda v: c.parse_number(v, c.COUNT)) in ([12, 1, None], [12, None, None])
    assert apply(spark, ["(1.5)ms", "2"], lambda v: c.parse_number(v, c.MEASURE)) == [-1.5, 2.0]


def test_parse_number_long_text_is_linear(spark):
    assert apply(spark, ["$ " * 20000 + "x", "5" + " *" * 20000], c.parse_number) == [None, Decimal("5.00")]


def test_parse_ts(spark):
    cases = {
        "2024-01-31 23:59:58": datetime(2024, 1, 31, 23, 59, 58),
        " 2024-01-31T23:59:58Z ": datetime(2024, 1, 31, 23, 59, 58),
        "01/31/2024 23:59:58": datetime(2024, 1, 31, 23, 59, 58),
        "01/31/2024 23:59": datetime(2024, 1, 31, 23, 59),
        "1706745598": datetime(2024, 1, 31, 23, 59, 58),
        "2024-02-30 00:00:00": None, "13/01/2024 00:00": None, "2024-01-31": None, "31.01.2024": None,
        "2024-01-31 23:59:58+02:00": None, "": None, None: None,
    }
    assert apply(spark, list(cases), c.parse_ts) == list(cases.values())


def test_parse_ts_ignores_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:  # an hour that does not exist in New York
        assert apply(spark, ["2024-03-10 02:30:00", "1710037800"], lambda v: c.parse_ts(v).cast("string")) == ["2024-03-10 02:30:00"] * 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_parse_ts_order_decides_between_equal_shapes(spark):
    us, eu = c.TsFormat("us", "MM/dd/yyyy HH:mm"), c.TsFormat("eu", "dd/MM/yyyy HH:mm")
    text = ["02/03/2024 10:00", "20/03/2024 10:00"]
    assert apply(spark, text, lambda v: c.parse_ts(v, [us, eu])) == [datetime(2024, 2, 3, 10), datetime(2024, 3, 20, 10)]
    assert apply(spark, text, lambda v: c.parse_ts(v, [eu, us])) == [datetime(2024, 3, 2, 10), datetime(2024, 3, 20, 10)]
    assert apply(spark, text, lambda v: c.ts_format_name(v, [us, eu])) == ["us", "eu"]
    fraction = c.TsFormat("micros", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    assert apply(spark, ["2024-01-01 00:00:00.000005"], lambda v: c.parse_ts(v, [fraction])) == [datetime(2024, 1, 1, 0, 0, 0, 5)]


def test_ts_format_name(spark):
    got = apply(spark, ["2024-01-31 23:59:58", "2024-01-31T23:59:58Z", "01/31/2024 23:59", "1706745598", "soon", None], c.ts_format_name)
    assert got == ["iso", "iso_z", "us_minutes", "epoch", "unparseable", "missing"]


def test_keys_categories_codes(spark):
    assert apply(spark, ["\t cust-1 ", "CUST-1", None, "  "], c.norm_key) == ["CUST-1", "CUST-1", None, ""]
    assert apply(spark, [" GOLD*! ", "A*B#", None, "***"], c.norm_category) == ["GOLD", "A*B", None, ""]
    assert apply(spark, ["0", " 1* ", "2#", "3", "x", "", None, "01"], c.norm_code) == [0, 1, 2, None, None, None, None, 1]


def test_hashes_match_across_spellings(spark):
    import hashlib

    digest = hashlib.sha256(b"user1@example.com").hexdigest()
    assert apply(spark, [" USER1@EXAMPLE.COM", "user1@example.com "], privacy.hash_email) == [digest] * 2
    assert apply(spark, [" 123-45-6789 "], privacy.hash_ssn) == [hashlib.sha256(b"123-45-6789").hexdigest()]


def test_distance_is_clamped_and_missing_stays_missing(spark):
    df = spark.createDataFrame(
        [(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, 10.0, 20.0), (90.0, 0.0, -90.0, 0.0), (0.0, 0.0, None, 1.0)],
        "a double, b double, x double, y double",
    )
    got = [r[0] for r in df.select(feat.haversine_km(F.col("a"), F.col("b"), F.col("x"), F.col("y"))).collect()]
    assert got[0] == pytest.approx(20015.0868, abs=1e-3) and got[1] == 0.0
    assert got[2] == pytest.approx(20015.0868, abs=1e-3) and got[3] is None


def test_net_amount_without_rate_is_the_amount(spark):
    df = spark.createDataFrame([(Decimal("10.05"), 0.5), (Decimal("10.00"), None)], "a decimal(18,2), r double")
    assert [r[0] for r in df.select(feat.net_amount(F.col("a"), F.col("r"))).collect()] == [Decimal("5.03"), Decimal("10.00")]


def test_masked_view_needs_the_tag(spark):
    df = spark.createDataFrame([("1", "123-45-6789")], "customer_id string, ssn string")
    with pytest.raises(ValueError):
        privacy.masked_view(df, False, ["ssn"])
    tagged = privacy.tag_columns(df, {"ssn": "pii"})
    assert privacy.masked_view(tagged, True, ["ssn"]).first().ssn == "123-45-6789"
    assert len(privacy.masked_view(tagged, False, ["ssn"]).first().ssn) == 64


def test_fill_defaults_keeps_types(spark):
    df = spark.createDataFrame([(None, None)], "a decimal(18,2), b string")
    out = c.fill_defaults(df, {"a": 0, "b": "x"})
    assert out.dtypes == df.dtypes and out.first() == (Decimal("0.00"), "x")

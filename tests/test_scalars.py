import pytest
from pyspark.sql import functions as F

from countypanel.functions import scalars as x
from tests.helpers import frame


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("code, expected", [("1001", "01001"), ("01001", "01001"), ("123456", "12345")])
def test_fips_pad_pads_and_cuts(spark, code, expected):
    assert one(spark, x.fips_pad(F.lit(code), 5)) == expected


@pytest.mark.parametrize("code, expected", [("7", "007"), ("0007", "0007")])
def test_zfill_never_cuts(spark, code, expected):
    assert one(spark, x.zfill(F.lit(code), 3)) == expected


def test_missing_code_stays_missing(spark):
    null = F.lit(None).cast("string")
    assert one(spark, x.zfill(null, 5)) is None
    assert one(spark, x.fips_pad(null, 5)) is None


@pytest.mark.parametrize(
    "text, expected",
    [("12", 12.0), (" 3.5 ", 3.5), ("-1e2", -100.0), ("N/A", None), ("", None), ("1d", None), ("2.5F", None), (None, None)],
)
def test_to_numeric(spark, text, expected):
    assert one(spark, x.to_numeric(F.lit(text).cast("string"))) == expected


@pytest.mark.parametrize("text, expected", [("2017", 2017), ("2017.0", 2017), ("x", None)])
def test_to_year(spark, text, expected):
    assert one(spark, x.to_year(F.lit(text))) == expected


@pytest.mark.parametrize("n, d, expected", [(1.0, 4.0, 0.25), (1.0, 0.0, None), (None, 4.0, None), (1.0, None, None)])
def test_safe_ratio(spark, n, d, expected):
    assert one(spark, x.safe_ratio(F.lit(n).cast("double"), F.lit(d).cast("double"))) == expected


@pytest.mark.parametrize("v, expected", [(-1.0, None), (0.0, 0.0), (2.0, 2.0), (None, None)])
def test_negative_to_null(spark, v, expected):
    assert one(spark, x.negative_to_null(F.lit(v).cast("double"))) == expected


def test_sentinel_to_null(spark):
    assert one(spark, x.sentinel_to_null(F.lit(-666666666.0))) is None
    assert one(spark, x.sentinel_to_null(F.lit(50000.0))) == 50000.0


@pytest.mark.parametrize("rucc, expected", [(0, None), (1, False), (3, False), (4, True), (10, True), (-1, None), (None, None)])
def test_rural_flag(spark, rucc, expected):
    assert one(spark, x.rural_flag(F.lit(rucc).cast("long"))) is expected


@pytest.mark.parametrize(
    "change, expected",
    [(0.01, "stable"), (-0.01, "stable"), (0.011, "deteriorated"), (-0.011, "improved"), (None, "stable")],
)
def test_trajectory_class(spark, change, expected):
    assert one(spark, x.trajectory_class(F.lit(change).cast("double"))) == expected


@pytest.mark.parametrize("year, expected", [(2019, "ACA individual mandate penalty repealed"), (2022, None), (None, None)])
def test_policy_events(spark, year, expected):
    assert one(spark, x.label_of(F.lit(year).cast("long"), x.POLICY_EVENTS)) == expected


def test_area_code_parts(spark):
    area = F.lit("CN0100300000000")
    assert one(spark, F.concat(x.area_state(area), x.area_county(area))) == "01003"


def test_surrogate_key_is_stable_and_keeps_nulls_apart(spark):
    df = frame(spark, "a string, b long", ("01001", 2017), (None, 2017), ("01001", None))
    keys = [r["k"] for r in df.select(x.surrogate_key("a", "b").alias("k")).collect()]
    assert len(set(keys)) == 3
    import hashlib

    assert hashlib.md5(b"01001-2017").hexdigest() in keys
    assert None not in keys


def test_strict_cast_raises_on_bad_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.range(1).select(F.lit("abc").cast("long")).collect()

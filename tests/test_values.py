import pytest
from pyspark.sql import functions as F

from tonetide.functions import values as V


def one(spark, value, kind, expression):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expression).first()[0]


def test_strip_forms(spark):
    assert one(spark, "t3_3tabc", "string", V.ltrim_chars("x", "t3_")) == "abc"
    assert one(spark, "t3_3tabc", "string", V.strip_prefix("x", "t3_")) == "3tabc"
    assert one(spark, "abt3_", "string", V.strip_prefix("x", "t3_")) == "abt3_"
    assert one(spark, None, "string", V.strip_prefix("x", "t3_")) is None


def test_week_year_day_is_not_a_trap(spark):
    assert one(spark, 1514700000, "long", V.epoch_to_day("x")) == "2017-12-31"
    assert one(spark, None, "long", V.epoch_to_day("x")) is None


def test_parse_day(spark):
    assert str(one(spark, "2017-12-31", "string", V.parse_day("x"))) == "2017-12-31"
    assert one(spark, "not a day", "string", V.parse_day("x")) is None


@pytest.mark.parametrize(
    ("text", "pos", "neg"),
    [("1", 1, 0), ("-1", 0, 1), ("0", 0, 0), (None, 0, 0), ("abc", 0, 0)],
)
def test_binary_label(spark, text, pos, neg):
    assert one(spark, text, "string", V.binary_label("x", 1)) == pos
    assert one(spark, text, "string", V.binary_label("x", -1)) == neg


@pytest.mark.parametrize(
    ("p", "pos", "neg"), [(0.2, 0, 0), (0.2000001, 1, 0), (0.25, 1, 0), (0.26, 1, 1), (None, 0, 0)]
)
def test_flag_is_strict(spark, p, pos, neg):
    assert one(spark, p, "double", V.flag("x", 0.2)) == pos
    assert one(spark, p, "double", V.flag("x", 0.25)) == neg


def test_flag_in_32_bits(spark):
    # 0.2 is slightly larger once rounded to 32 bits.
    assert one(spark, 0.2, "double", V.flag("x", 0.2, float32=True)) == 1


def test_measures(spark):
    df = spark.createDataFrame([(75.0, 25.0)], "p double, n double")
    row = df.select(V.difference("p", "n").alias("d"), V.intensity("n", 0, 100).alias("s")).first()
    assert (row.d, row.s) == (50.0, 0.5)
    with pytest.raises(ValueError):
        V.intensity("n", 1, 1)


def test_class_probability(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.25, 0.75),)], ["v"])
    assert df.select(V.class_probability("v")).first()[0] == 0.75
    assert df.select(V.class_probability("v", 0)).first()[0] == 0.25
    assert df.select(F.col("v")).count() == 1


def test_days_do_not_depend_on_the_session_zone(spark, conf):
    for zone in ("UTC", "Asia/Tokyo", "America/New_York"):
        conf("spark.sql.session.timeZone", zone)
        assert one(spark, 1514764799, "long", V.epoch_to_day("x")) == "2017-12-31"
        assert one(spark, -1, "long", V.epoch_to_day("x")) == "1969-12-31"


def test_labels_with_decimals(spark):
    assert one(spark, "1.0", "string", V.binary_label("x", 1)) == 1
    assert one(spark, "1x", "string", V.binary_label("x", 1)) == 0

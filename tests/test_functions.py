from pyspark.sql import functions as F

from roadlens.functions import (
    after, before, date_hour, half_up_ratio, is_empty, kv_field, kv_map, kv_set_field,
    lenient_seconds, minus_seconds, pad2, pad_id, parse_time, range_label, to_int, trim_comma,
)


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_date_hour_keeps_overflow_hour(spark):
    assert one(spark, date_hour(F.lit("2018-07-01 25:10:00"))) == "2018-07-01_25"
    assert one(spark, date_hour(F.lit("2018-07-01 08:00:59"))) == "2018-07-01_08"


def test_range_label(spark):
    cases = {
        "2018-07-01 25:10:00": "2018-07-01 25:10~2018-07-01 25:15",
        "2018-07-01 23:57:12": "2018-07-01 23:55~2018-07-01 24:00",
        "2018-07-01 09:55:00": "2018-07-01 09:55~2018-07-01 10:00",
        "2018-07-01 09:04:59": "2018-07-01 09:00~2018-07-01 09:05",
        "2018-07-01 00:05:00": "2018-07-01 00:05~2018-07-01 00:10",
    }
    for text, want in cases.items():
        assert one(spark, range_label(F.lit(text))) == want


def test_padding_never_truncates(spark):
    assert one(spark, pad_id(F.lit("12345"), 4)) == "12345"
    assert one(spark, pad_id(F.lit("12"), 4)) == "0012"
    assert one(spark, pad2(F.lit("7"))) == "07"
    assert one(spark, pad2(F.lit("123"))) == "123"


def test_half_up_ratio_exact_ties(spark):
    assert one(spark, half_up_ratio(F.lit(57), F.lit(200))) == 0.29
    assert one(spark, half_up_ratio(F.lit(14), F.lit(112))) == 0.13
    assert one(spark, half_up_ratio(F.lit(1), F.lit(3))) == 0.33
    assert one(spark, half_up_ratio(F.lit(2), F.lit(3))) == 0.67
    assert one(spark, half_up_ratio(F.lit(1), F.lit(0))) is None


def test_lenient_time(spark):
    assert one(spark, lenient_seconds(F.lit("1970-01-02 00:00:01"))) == 86401
    assert one(spark, lenient_seconds(F.lit("1970-01-01 24:00:01"))) == 86401
    assert one(spark, lenient_seconds(F.lit("garbage"))) is None
    assert one(spark, after(F.lit("2018-07-01 10:00:00"), F.lit("2018-07-01 09:59:59"))) is True
    assert one(spark, before(F.lit("2018-07-01 10:00:00"), F.lit("x"))) is False
    assert one(spark, minus_seconds(F.lit("2018-07-01 10:00:00"), F.lit("2018-07-01 09:58:30"))) == 90
    assert one(spark, minus_seconds(F.lit("bad"), F.lit("2018-07-01 09:58:30"))) == 0
    assert one(spark, parse_time(F.lit("2018-07-01 24:10:00"))) is None


def test_text_helpers(spark):
    assert one(spark, is_empty(F.lit(None).cast("string"))) is True
    assert one(spark, is_empty(F.lit(""))) is True
    assert one(spark, is_empty(F.lit("a"))) is False
    assert one(spark, trim_comma(F.lit(",a,b,"))) == "a,b"
    assert one(spark, trim_comma(F.lit(",,a,,"))) == ",a,"
    assert one(spark, to_int(F.lit("12x"))) is None
    assert one(spark, to_int(F.lit("42"))) == 42


def test_kv_records(spark):
    rec = F.lit("name=zhang|age=18|bad|empty=|age=20")
    assert one(spark, kv_field(rec, "age")) == "18"
    assert one(spark, kv_field(rec, "empty")) is None
    assert one(spark, kv_field(rec, "missing")) is None
    assert one(spark, kv_set_field(F.lit("name=a|age=12"), "name", "b")) == "name=b|age=12"
    assert one(spark, kv_set_field(F.lit("name=a|age=12|"), "zzz", "b")) == "name=a|age=12"
    assert one(spark, kv_map(rec)) == {"name": "zhang", "age": "20"}


def test_range_label_malformed(spark):
    assert one(spark, range_label(F.lit(None).cast("string"))) is None
    assert one(spark, range_label(F.lit("2018-07-01 xx:55:00"))) is None
    assert one(spark, range_label(F.lit("2018-07-01 xx:10:00"))) == "2018-07-01 xx:10~2018-07-01 xx:15"
    assert one(spark, range_label(F.lit("2018-07-01 10:zz:00"))) is None


def test_seconds_text_inverts_lenient_seconds(spark):
    from roadlens.functions import seconds_text
    assert one(spark, seconds_text(lenient_seconds(F.lit("2018-07-01 25:10:05")))) == "2018-07-02 01:10:05"
    assert one(spark, seconds_text(F.lit(0))) == "1970-01-01 00:00:00"
    assert one(spark, seconds_text(F.lit(-1))) == "1969-12-31 23:59:59"


def test_lenient_seconds_overflow_is_null(spark):
    assert one(spark, lenient_seconds(F.lit("2018-07-01 9999999999999999:00:00"))) is None


def test_range_label_overflow_is_null(spark):
    assert one(spark, range_label(F.lit("2018-07-01 2147483647:55:00"))) is None
    assert one(spark, range_label(F.lit("2018-07-01 10:2147483647:00"))) is None


def test_format_double(spark):
    from roadlens.functions import format_double
    assert one(spark, format_double(F.lit(0.285), 2)) == 0.29
    assert one(spark, format_double(F.lit(0.125), 2)) == 0.13
    assert one(spark, format_double(F.lit(2.0 / 3.0), 2)) == 0.67


def test_binary_rounding_equals_exact_decimals(spark):
    import random
    from decimal import ROUND_HALF_UP, Decimal

    from roadlens.functions import format_double_binary

    rng = random.Random(1)
    values = [0.285, 0.29, 0.5, 1.005, 2.675, 0.125, 0.375, -0.125, -0.285, 0.0, 1e-320, 0.995, 0.999999999, 4503599627370495.5,
              4503599627370496.0, 1e300, 9007199254740993.0, 90071992547409.125, 45035996273704.955, 1 / 3]
    values += [n / d for n, d in ((rng.randint(0, 500), rng.randint(1, 500)) for _ in range(50_000))]
    values += [rng.randint(0, 10 ** 6) / 1000 for _ in range(25_000)]  # decimal ties
    values += [rng.uniform(-1, 1) * 10 ** rng.randint(-8, 15) for _ in range(25_000)]
    for scale in (0, 2, 6):
        rows = (spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
                .select("i", format_double_binary("v", scale).alias("r")).collect())
        unit = Decimal(1).scaleb(-scale)
        for r in rows:
            v = values[r.i]
            want = v if abs(v) >= 2 ** 52 else float(Decimal(v).quantize(unit, ROUND_HALF_UP))
            assert r.r == want, (v, r.r, want)
    odd = spark.createDataFrame([(None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "v double")
    assert [str(r[0]) for r in odd.select(format_double_binary("v")).collect()] == ["None", "nan", "inf", "-inf"]

"""Scalar functions: the reference's own sample values plus edge bands."""

import datetime as dt
import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cdcflow.functions import idfn, jsonval, text, timefn
from conftest import many, one

AS_OF = dt.date(2025, 1, 1)


def test_email_samples(spark):
    out = many(spark, text.clean_email, ["test@gmail.com", "test@naver.com", "invalid-email", None, ""])
    assert out == ["test@gmail.com", "test@naver.com", None, None, None]


def test_email_cleaning(spark):
    out = many(
        spark,
        text.clean_email,
        ["User.Name..X@Example.COM", "a+b%c@x.io", "a@b.co", "a.@b.co", "a b@x.io", " ab@x.io", "ab@x..io", "ab@x.c0"],
    )
    assert out == ["user.name.x@example.com", "abc@x.io", None, None, "a b@x.io", None, "ab@x.io", None]


def test_email_long_input_is_fast(spark):
    # the literal pattern backtracks exponentially on this shape
    v = "user" + "a" * 5000 + "@" + "b" * 5000
    assert one(spark, text.clean_email(F.col("x")), v) is None


ORIGINAL_EMAIL = re.compile(r"^[a-zA-Z0-9._%+-]+[^.@]+@[A-Za-z0-9]+([.-]?[A-Za-z0-9]+)*\.[A-Za-z]{2,}$", re.I)
OURS = re.compile(
    r"^(?:[a-z0-9._-]*\.[a-z0-9_ -]+|[a-z0-9_-][a-z0-9_ -]+)@[a-z0-9]+(?:[.-][a-z0-9]+)*\.[a-z]{2,}$"
)


@settings(max_examples=3000, deadline=None)
@given(st.text(alphabet="ab1._@ -", max_size=14))
def test_email_shape_equals_original_pattern(s):
    # on cleaned text (only [a-z0-9._@ -] remain, dots squeezed) both agree
    s = re.sub(r"\.+", ".", s)
    assert bool(ORIGINAL_EMAIL.match(s)) == bool(OURS.match(s))


def test_phone_samples(spark):
    out = many(spark, text.clean_phone, ["01012345678", "021234567", "07012345678", "0111234567", "123"])
    assert out == ["010-1234-5678", "02-123-4567", "070-1234-5678", None, None]


def test_phone_bands(spark):
    out = many(spark, text.clean_phone, ["0212345678", "(031) 123-4567", "0501234567", "05012345678", "0311234567", "+82 10"])
    assert out == ["02-1234-5678", "031-123-4567", "050-123-4567", "050-1234-5678", "031-123-4567", None]


def test_name_samples(spark):
    assert many(spark, text.clean_name, ["홍 길 동", "james", "!!!"]) == ["홍길동", "JAMES", "고객님"]


def test_name_quirks(spark):
    out = many(
        spark,
        text.clean_name,
        ["홍길동 김철수", "홍길동/김철수", "홍길동(VIP)", "1 2", "Lee, Jane", "  james bond  ", " ", "Kim (Manager)"],
    )
    assert out == ["홍길동김철수", "홍길동", "홍길동", "1 2", "LEE", "JAMES BOND", "고객님", "KIM"]


def test_name_compact_samples(spark):
    assert many(spark, text.clean_name_compact, ["홍 길 동", "홍길동(VIP)", "!!", None]) == ["홍길동", "홍길동", "고객", None]


def test_address_samples(spark):
    assert many(spark, text.clean_address, ["서울시\t강남구", " ", "  ab  ", "a"]) == ["서울시 강남구", None, "ab", None]


def test_text_or_null(spark):
    assert many(spark, text.text_or_null, ["value", None, "", " null ", " x "]) == ["value", None, None, None, "x"]


def test_yn_to_boolean(spark):
    assert many(spark, idfn.yn_to_boolean, ["Y", "true", "N", "false", None, "1", " y "]) == [
        True, True, False, False, False, False, True,
    ]


def test_null_to_empty(spark):
    assert many(spark, text.null_to_empty, [None, "test"]) == ["", "test"]


def test_as_boolean(spark):
    f_true = lambda c: idfn.as_boolean(c, True)
    f_false = lambda c: idfn.as_boolean(c, False)
    assert many(spark, f_false, ["1", "Y", "x", None, " "]) == [True, True, False, False, False]
    assert many(spark, f_true, ["0", "n", "x", None]) == [False, False, True, True]


def test_parse_timestamp_samples(spark):
    out = many(
        spark,
        timefn.parse_timestamp_text,
        ["1678886400000", "2023-03-15T13:20:00Z", "1678886400", "1678886400000000", "2023-03-15", "", None, "99999999999999999999"],
    )
    assert out == [1678886400000, 1678886400000, 1678886400000, 1678886400000, None, None, None, None]


def test_parse_instant_offsets_and_case(spark):
    out = many(spark, timefn.parse_instant, ["2023-03-15T22:20:00+09:00", "2023-03-15t13:20:00.5z", "2023-02-30T00:00:00Z"])
    assert out == [1678886400000, 1678886400500, None]


def test_normalize_epoch_bands(spark):
    vals = [0, -5, 5, 9_999_999_999, 10_000_000_000, 999_999_999_999, 1_000_000_000_000, 9_999_999_999_999,
            10_000_000_000_000, 9_999_999_999_999_999, 10_000_000_000_000_000]
    out = many(spark, timefn.normalize_epoch_millis, vals, "x bigint")
    assert out == [0, -5, 5000, 9_999_999_999_000, 10_000_000_000, 999_999_999_999, 1_000_000_000_000,
                   9_999_999_999_999, 10_000_000_000, 9_999_999_999_999, 10_000_000_000_000_000]


def test_json_timestamp_number_and_text(spark):
    df = spark.createDataFrame(
        [('{"t": 1678886400}',), ('{"t": 1678886400.9}',), ('{"t": "1678886400000"}',), ('{"t": {"a":1}}',), ('{}',)], "v string"
    )
    out = [r[0] for r in df.select(timefn.parse_timestamp(F.parse_json("v"), "t")).collect()]
    assert out == [1678886400000, 1678886400000, 1678886400000, None, None]


def test_refine_birth_samples(spark):
    f = lambda c: timefn.refine_birth(c, AS_OF)
    out = many(spark, f, ["19900101", "900101", "invalid", "19900230", "19901301", "20991231", "18991231", "250101", "1990-01-01"])
    assert out == [dt.date(1990, 1, 1), dt.date(1990, 1, 1), None, dt.date(1990, 2, 28), None, None, None,
                   dt.date(1925, 1, 1), dt.date(1990, 1, 1)]


def test_refine_birth_epoch_days(spark):
    assert one(spark, timefn.refine_birth_epoch_days(F.col("x"), AS_OF), "19700101") == 0


def test_contdate(spark):
    out = many(spark, timefn.contdate_to_millis, ["2023/01/01", "2023/02/30", "2023/1/1", " ", None])
    assert out == [1672531200000, 1677542400000, None, None, None]


def test_resident_number(spark):
    vals = ["900101-1234567", "0001013234567", "900101-", "12345", "851313-2345678", "000229-4000000"]
    assert many(spark, idfn.gender_from_resno, vals) == ["M", "M", None, None, "F", "F"]
    days = many(spark, idfn.birth_from_resno, vals)
    assert days[0] == (dt.date(1990, 1, 1) - dt.date(1970, 1, 1)).days
    assert days[1] == (dt.date(2000, 1, 1) - dt.date(1970, 1, 1)).days
    assert days[2:5] == [None, None, None]
    assert days[5] == (dt.date(2000, 2, 29) - dt.date(1970, 1, 1)).days


def test_decode_sequence(spark):
    import base64

    big = (1 << 200) + 12345
    vals = ["AAAA", base64.b64encode((255).to_bytes(1, "big")).decode(), base64.b64encode(big.to_bytes(26, "big")).decode(),
            "!!", "", None, "AAE"]
    assert many(spark, idfn.decode_sequence_b64, vals) == ["0", "255", str(big), "", "", "", "1"]
    df = spark.createDataFrame([('{"value":"AAAA"}',), ("null",)], "v string")
    assert [r[0] for r in df.select(idfn.decode_sequence(F.parse_json("v"))).collect()] == ["0", ""]


def test_decode_sequence_of_any_length(spark):
    import base64
    import random

    rng = random.Random(4)
    nums = [0, 1, 255, 2**64 - 1, 2**64, 2**120 - 1, 2**120, 10**36, 10**37, 10**45 - 1, 10**45, 2**128 - 1] + [rng.getrandbits(8 * n) for n in (8, 15, 16, 17, 31, 40, 100, 200, 333)]
    nums += [10**k for k in (54, 81, 200)] + [2**(32 * k) for k in (4, 7, 50)]
    text = lambda v, pad=0: base64.b64encode(b"\0" * pad + v.to_bytes((v.bit_length() + 7) // 8 or 1, "big")).decode()
    assert many(spark, idfn.decode_sequence_b64, [text(v) for v in nums]) == [str(v) for v in nums]
    assert many(spark, idfn.decode_sequence_b64, [text(v, 50) for v in nums]) == [str(v) for v in nums]


def test_json_text_value_rule(spark):
    df = spark.createDataFrame(
        [('{"s":"x","n":12,"d":1.5,"b":true,"o":{"k":1},"a":[1],"z":null,"a.b":"dot","t":100.50,"ts":"100.50","e":1e10,'
          '"big":123456789012345678901234567890}',)], "v string")
    d = F.parse_json("v")
    names = ["s", "n", "d", "b", "o", "a", "z", "missing", "a.b", "t", "ts", "e", "big"]
    row = df.select(*[jsonval.json_text(d, f).alias(f) for f in names]).collect()[0]
    assert list(row) == ["x", "12", "1.5", "true", "", "", None, None, "dot", "100.5", "100.50", "1.0E10",
                         "123456789012345678901234567890"]


def test_format_template(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    c = text.format_template("{x}-{y}-{z}", {"x": F.col("x"), "y": F.col("y")})
    assert df.select(c).collect()[0][0] == "a--{z}"


def test_processed_at_offset(spark):
    now = F.timestamp_millis(F.lit(1_700_000_000_000))
    assert one(spark, timefn.processed_at(now)) == 1_700_000_000_000 + 9 * 3_600_000

"""Flags, resident-number fields and the change-sequence codec."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.functions._util import as_col, lit_or_col
from cdcflow.functions.jsonval import json_text
from cdcflow.functions.text import _let, java_trim

# ---------------------------------------------------------------------------
# Fixed values that results depend on.
TRUE_WORDS = ("y", "true")            # yn_to_boolean (case-insensitive)
AS_BOOL_TRUE = ("y", "true", "1")     # as_boolean: "1" / "0" compared exactly
AS_BOOL_FALSE = ("n", "false", "0")
MALE_DIGITS = "1357"                  # resident-number gender digit
FEMALE_DIGITS = "2468"
CENTURY_2000_DIGITS = "3478"
CENTURY_1800_DIGITS = "90"
# Valid standard base64 (RFC 4648 alphabet, padding optional, no whitespace).
BASE64_SHAPE = r"^([A-Za-z0-9+/]{4})*([A-Za-z0-9+/]{2}(==)?|[A-Za-z0-9+/]{3}=?)?\z"
# ---------------------------------------------------------------------------

_LIMB = 1_000_000_000  # base of the decimal limbs used by decode_sequence
_WORD = 1 << 32        # and of the binary words
WORD_DIGITS = 8        # hex digits of a word


def yn_to_boolean(c: Column | str) -> Column:
    """``Y``/``true`` (trimmed, any case) -> true; everything else, NULL included -> false."""
    t = F.lower(java_trim(as_col(c)))
    return F.coalesce(t.isin(*TRUE_WORDS), F.lit(False))


def as_boolean(c: Column | str, default: bool | Column) -> Column:
    """Y/true/1 -> true, N/false/0 -> false, NULL/blank/other -> ``default``.

    ``c`` is the value-to-text of the field (a JSON boolean reads ``true``/``false``).
    """
    t = java_trim(as_col(c))
    lt = F.lower(t)
    d = lit_or_col(default).cast("boolean")
    return (
        F.when(t.isNull() | (t == ""), d)
        .when(lt.isin("y", "true") | (t == "1"), F.lit(True))
        .when(lt.isin("n", "false") | (t == "0"), F.lit(False))
        .otherwise(d)
    )


def _resno_digit(c: Column) -> Column:
    """The gender/century digit: position 7 (1-based), or 8 when the text has a dash."""
    return F.when(c.contains("-"), F.when(F.length(c) >= 8, F.substring(c, 8, 1))).otherwise(F.substring(c, 7, 1))


def gender_from_resno(c: Column | str) -> Column:
    """``M``/``F`` from a resident registration number; anything else -> NULL."""
    x = as_col(c)
    g = _resno_digit(x)
    out = F.when(F.instr(F.lit(MALE_DIGITS), g) > 0, F.lit("M")).when(F.instr(F.lit(FEMALE_DIGITS), g) > 0, F.lit("F"))
    return F.when(F.length(x) >= 7, F.when(g != "", out))


def birth_from_resno(c: Column | str) -> Column:
    """Birth date (epoch days) from ``yymmdd`` + the century digit; strict date check."""
    x = as_col(c)
    g = _resno_digit(x)
    century = (
        F.when((g != "") & (F.instr(F.lit(CENTURY_2000_DIGITS), g) > 0), F.lit(2000))
        .when((g != "") & (F.instr(F.lit(CENTURY_1800_DIGITS), g) > 0), F.lit(1800))
        .otherwise(F.lit(1900))
    )
    yy = F.substring(x, 1, 2)
    mm = F.substring(x, 3, 2)
    dd = F.substring(x, 5, 2)
    ok = (F.length(x) >= 7) & g.isNotNull() & F.substring(x, 1, 6).rlike("^[0-9]{6}$")
    y = century + yy.try_cast("int")
    m = mm.try_cast("int")
    d = dd.try_cast("int")
    last = F.dayofmonth(F.last_day(F.make_date(y, m, F.lit(1))))
    valid = ok & m.between(1, 12) & d.between(1, 31)
    return F.when(valid, F.when(d <= last, F.unix_date(F.make_date(y, m, d))))


def _long_decimal(h: Column) -> Column:
    """Hex text of any length -> decimal text: words of 32 bits are folded into limbs of
    nine decimal digits, least first (``limb * 2**32 + carry`` fits a BIGINT)."""
    size = F.ceil(F.length(h) / F.lit(WORD_DIGITS)).cast("int")
    padded = F.lpad(h, size * WORD_DIGITS, "0")
    words = F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.conv(F.substring(padded, i * WORD_DIGITS + 1, WORD_DIGITS), 16, 10).cast("bigint"))

    def mul_add(acc: Column, word: Column) -> Column:
        step = F.aggregate(
            acc,
            F.struct(F.array().cast("array<bigint>").alias("out"), word.alias("carry")),
            lambda st, limb: _let(
                limb * _WORD + st["carry"],
                lambda v: F.struct(F.array_append(st["out"], v % _LIMB).alias("out"), F.call_function("div", v, F.lit(_LIMB)).alias("carry")),
            ),
        )
        return _let(step, lambda s: F.when(s["carry"] > 0, _carried(s)).otherwise(s["out"]))

    def _carried(s: Column) -> Column:
        rest = F.call_function("div", s["carry"], F.lit(_LIMB))  # a carry is under 2**32: two limbs at most
        grown = F.array_append(s["out"], s["carry"] % _LIMB)
        return F.when(rest > 0, F.array_append(grown, rest)).otherwise(grown)

    limbs = F.aggregate(words, F.array(F.lit(0).cast("bigint")), mul_add)
    return F.array_join(
        F.transform(F.reverse(limbs), lambda v, i: F.when(i == 0, v.cast("string")).otherwise(F.lpad(v.cast("string"), 9, "0"))), "")


def decode_sequence_b64(c: Column | str) -> Column:
    """Base64 big-endian unsigned integer -> its decimal text; NULL/empty/bad -> ``''``.

    Arbitrary length without a UDF.  The text is decoded once and its hex digits,
    without leading zeros, are bound to a lambda variable: up to 8 bytes go through
    ``conv``, up to 15 fit a DECIMAL(38,0) as high * 2^64 + low, longer ones are folded.
    """
    x = as_col(c)
    raw = F.when(x.rlike(BASE64_SHAPE), F.try_to_binary(x, F.lit("base64")))
    two64 = F.lit("18446744073709551616").cast("decimal(38,0)")

    def decimal(h: Column) -> Column:
        n = F.length(h)
        low = F.conv(F.substring(h, -16, 16), 16, 10).cast("decimal(38,0)")
        high = F.conv(h.substr(F.lit(1), n - 16), 16, 10).cast("decimal(38,0)")
        return (
            F.when(n == 0, F.lit("0"))
            .when(n <= 16, F.conv(h, 16, 10))
            .when(n <= 30, (high * two64 + low).cast("decimal(38,0)").cast("string"))
            .when(n > 30, _long_decimal(h))
        )

    out = _let(F.ltrim(F.hex(raw), F.lit("0")), decimal)
    return F.when(x.isNull() | (x == ""), F.lit("")).otherwise(F.coalesce(out, F.lit("")))


def decode_sequence(data: Column | str, field: str = "value") -> Column:
    """Decode a ``{"value": base64}`` sequence object held as VARIANT."""
    d = as_col(data)
    return F.when(d.isNull() | F.is_variant_null(d), F.lit("")).otherwise(decode_sequence_b64(json_text(d, field)))

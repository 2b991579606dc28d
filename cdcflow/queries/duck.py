"""DuckDB SQL fragments implementing the reference semantics, for oracles.

These are written independently of the Spark Column functions (different
engine, different regex library, explicit CASE logic) so that a query and
its oracle agree only if both implement the stated rules.  Each helper takes
an SQL expression (text) and returns an SQL expression.
"""

from __future__ import annotations

TRIM_CHARS = "(" + " || ".join(f"chr({i})" for i in range(0x21)) + ")"
NAME_FALLBACK = "'고객님'"
NAME_COMPACT_FALLBACK = "'고객'"
AREA = "('031','032','033','041','042','043','051','052','053','054','055','061','062','063','064')"


def jtrim(x: str) -> str:
    return f"trim({x}, {TRIM_CHARS})"


def blank_null(x: str, body: str) -> str:
    return f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL ELSE {body} END)"


def email(x: str) -> str:
    c = f"lower(regexp_replace(regexp_replace({x}, '[^a-zA-Z0-9._@ -]', '', 'g'), '\\.+', '.', 'g'))"
    # The original pattern as written (RE2 matches in linear time).
    pat = "^[a-zA-Z0-9._%+-]+[^.@]+@[A-Za-z0-9]+([.-]?[A-Za-z0-9]+)*\\.[A-Za-z]{2,}$"
    return blank_null(x, f"(CASE WHEN regexp_full_match({c}, '{pat}') THEN {c} END)")


def phone(x: str) -> str:
    d = f"regexp_replace({x}, '[^0-9]', '', 'g')"
    n = f"length({d})"
    p2 = f"substr({d}, 1, 2)"
    p3 = f"substr({d}, 1, 3)"

    def fmt(a: int, b: int) -> str:
        return f"(substr({d}, 1, {a}) || '-' || substr({d}, {a + 1}, {b}) || '-' || substr({d}, {a + b + 1}))"

    body = (
        f"CASE WHEN {n} = 9 AND {p2} = '02' THEN {fmt(2, 3)} "
        f"WHEN {n} = 10 AND {p2} = '02' THEN {fmt(2, 4)} "
        f"WHEN {n} = 10 AND ({p3} IN {AREA} OR {p3} IN ('050','070')) THEN {fmt(3, 3)} "
        f"WHEN {n} = 11 AND ({p3} IN {AREA} OR {p3} IN ('010','050','070')) THEN {fmt(3, 4)} "
        f"ELSE NULL END"
    )
    return blank_null(x, f"({body})")


def name(x: str) -> str:
    t = jtrim(x)
    sq = f"replace(regexp_replace({t}, '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g'), '/', ',')"
    # all parts single chars <=> every space-separated token has length <= 1
    all_single = f"list_bool_and(list_transform(string_split({sq}, ' '), lambda p: length(p) <= 1))"
    glued = (
        f"(CASE WHEN position(' ' IN {sq}) = 0 THEN {sq} "
        f"WHEN {all_single} THEN replace({sq}, ' ', '') ELSE split_part({sq}, ' ', 1) END)"
    )
    s2 = f"(CASE WHEN regexp_matches({t}, '[a-zA-Z]') THEN {t} ELSE {glued} END)"
    s3 = f"(CASE WHEN position(',' IN {s2}) > 0 THEN split_part({s2}, ',', 1) ELSE split_part({x}, '(', 1) END)"
    kept = f"regexp_replace({s3}, '[^a-zA-Z가-힣 ]', '', 'g')"
    up = f"(CASE WHEN regexp_matches({kept}, '[a-z]') THEN {jtrim(f'upper({kept})')} ELSE {kept} END)"
    nos = f"(CASE WHEN regexp_matches({up}, '[가-힣]') THEN replace({up}, ' ', '') ELSE {up} END)"
    s4 = f"(CASE WHEN regexp_matches({s3}, '[a-zA-Z가-힣]') THEN {nos} ELSE {s3} END)"
    s5 = (
        f"(CASE WHEN {jtrim(s4)} = '' OR regexp_full_match({s4}, '[^a-zA-Z가-힣 ]+') "
        f"THEN {NAME_FALLBACK} ELSE {s4} END)"
    )
    return blank_null(x, jtrim(s5))


def name_compact(x: str) -> str:
    a = f"regexp_replace({x}, '[ \\t\\n\\x0B\\f\\r]+', '', 'g')"
    b = f"regexp_replace({a}, '\\([^)]*\\)', '', 'g')"
    c = f"regexp_replace({b}, '[^a-zA-Z가-힣0-9 ]', '', 'g')"
    return blank_null(x, f"(CASE WHEN {c} = '' THEN {NAME_COMPACT_FALLBACK} ELSE {c} END)")


def address(x: str) -> str:
    t = jtrim(f"replace(replace({x}, chr(9), ' '), chr(160), '')")
    return blank_null(x, f"(CASE WHEN length({t}) >= 2 THEN {t} END)")


def text_or_null(x: str) -> str:
    t = jtrim(x)
    return f"(CASE WHEN {x} IS NULL OR {t} = '' OR lower({t}) = 'null' THEN NULL ELSE {t} END)"


def yn(x: str) -> str:
    return f"coalesce(lower({jtrim(x)}) IN ('y', 'true'), false)"


def as_bool(x: str, default: str) -> str:
    t = jtrim(x)
    return (
        f"(CASE WHEN {x} IS NULL OR {t} = '' THEN {default} "
        f"WHEN lower({t}) IN ('y','true') OR {t} = '1' THEN true "
        f"WHEN lower({t}) IN ('n','false') OR {t} = '0' THEN false ELSE {default} END)"
    )


def normalize(v: str) -> str:
    return (
        f"(CASE WHEN {v} > 0 AND {v} < 10000000000 THEN {v} * 1000 "
        f"WHEN {v} >= 1000000000000 AND {v} < 10000000000000 THEN {v} "
        f"WHEN {v} >= 10000000000000 AND {v} < 10000000000000000 THEN {v} // 1000 "
        f"ELSE {v} END)"
    )


ISO = "^[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt][0-9]{2}:[0-9]{2}:[0-9]{2}(\\.[0-9]{1,9})?([Zz]|[+-][0-9]{2}:[0-9]{2}(:[0-9]{2})?)$"


def instant(x: str) -> str:
    return f"(CASE WHEN regexp_full_match({x}, '{ISO}') THEN epoch_ms(TRY_CAST(upper({x}) AS TIMESTAMPTZ)) END)"


def ts_text(x: str) -> str:
    return (
        f"(CASE WHEN {x} IS NULL OR {x} = '' THEN NULL "
        f"WHEN regexp_full_match({x}, '[0-9]+') THEN {normalize(f'TRY_CAST({x} AS BIGINT)')} "
        f"ELSE {instant(x)} END)"
    )


def lenient_date(y: str, m: str, d: str) -> str:
    """yyyyMMdd resolution that clamps day 29-31 to the month end."""
    return (
        f"(CASE WHEN {m} BETWEEN 1 AND 12 AND {d} BETWEEN 1 AND 31 AND {y} >= 1 "
        f"THEN make_date({y}, {m}, least({d}, day(last_day(make_date({y}, {m}, 1))))) END)"
    )


def refine_birth(x: str, as_of: str) -> str:
    dg = f"substr(regexp_replace({x}, '[^0-9]', '', 'g'), 1, 8)"
    y8, m8, d8 = (f"TRY_CAST(substr({dg}, {a}, {b}) AS INTEGER)" for a, b in ((1, 4), (5, 2), (7, 2)))
    date8 = lenient_date(y8, m8, d8)
    yy = f"TRY_CAST(substr({dg}, 1, 2) AS INTEGER)"
    m6 = f"TRY_CAST(substr({dg}, 3, 2) AS INTEGER)"
    d6 = f"TRY_CAST(substr({dg}, 5, 2) AS INTEGER)"
    cy = f"year({as_of})"
    year6 = f"(CASE WHEN {cy} - (1900 + {yy}) > 90 THEN (CASE WHEN {cy} - (2000 + {yy}) <= 0 THEN 1900 + {yy} ELSE 2000 + {yy} END) ELSE 1900 + {yy} END)"
    date6 = lenient_date(year6, m6, d6)
    return (
        f"(CASE WHEN length({dg}) = 8 AND {date8} >= DATE '1900-01-01' AND {date8} <= {as_of} THEN {date8} "
        f"WHEN length({dg}) = 6 THEN {date6} END)"
    )


def contdate(x: str) -> str:
    d = lenient_date(f"TRY_CAST(substr({x},1,4) AS INTEGER)", f"TRY_CAST(substr({x},6,2) AS INTEGER)", f"TRY_CAST(substr({x},9,2) AS INTEGER)")
    return f"(CASE WHEN regexp_full_match({x}, '[0-9]{{4}}/[0-9]{{2}}/[0-9]{{2}}') THEN epoch_ms(CAST({d} AS TIMESTAMP)) END)"


def resno_digit(x: str) -> str:
    return f"(CASE WHEN position('-' IN {x}) > 0 THEN (CASE WHEN length({x}) >= 8 THEN substr({x}, 8, 1) END) ELSE substr({x}, 7, 1) END)"


def gender(x: str) -> str:
    g = resno_digit(x)
    return (
        f"(CASE WHEN length({x}) < 7 THEN NULL WHEN {g} IN ('1','3','5','7') THEN 'M' "
        f"WHEN {g} IN ('2','4','6','8') THEN 'F' END)"
    )


def birth_resno(x: str) -> str:
    g = resno_digit(x)
    cent = f"(CASE WHEN {g} IN ('3','4','7','8') THEN 2000 WHEN {g} IN ('9','0') THEN 1800 ELSE 1900 END)"
    y = f"({cent} + TRY_CAST(substr({x},1,2) AS INTEGER))"
    m = f"TRY_CAST(substr({x},3,2) AS INTEGER)"
    d = f"TRY_CAST(substr({x},5,2) AS INTEGER)"
    return (
        f"(CASE WHEN length({x}) >= 7 AND {g} IS NOT NULL AND regexp_full_match(substr({x},1,6), '[0-9]{{6}}') "
        f"THEN CAST(TRY(make_date({y}, {m}, {d})) - DATE '1970-01-01' AS INTEGER) END)"
    )


def jpath(field: str) -> str:
    return "'$.\"" + field + "\"'"


def json_text(doc: str, field: str) -> str:
    """Value-to-text of one top-level field of JSON text ``doc``."""
    p = jpath(field)
    return (
        f"(CASE WHEN json_type({doc}, {p}) IN ('OBJECT', 'ARRAY') THEN '' "
        f"WHEN json_type({doc}, {p}) = 'NULL' THEN NULL ELSE json_extract_string({doc}, {p}) END)"
    )


def json_is_number(doc: str, field: str) -> str:
    return f"coalesce(json_type({doc}, {jpath(field)}) IN ('BIGINT', 'UBIGINT', 'DOUBLE', 'HUGEINT'), false)"


def json_ts(doc: str, field: str) -> str:
    """parse_timestamp over a JSON field: numbers by value, text by ts_text."""
    p = jpath(field)
    num = (
        f"(CASE WHEN json_type({doc}, {p}) IN ('BIGINT', 'UBIGINT') THEN TRY_CAST(json_extract({doc}, {p}) AS BIGINT) "
        f"ELSE TRY_CAST(trunc(TRY_CAST(json_extract({doc}, {p}) AS DOUBLE)) AS BIGINT) END)"
    )
    return (
        f"(CASE WHEN {json_is_number(doc, field)} THEN {normalize(num)} "
        f"ELSE {ts_text(json_text(doc, field))} END)"
    )

"""Personal-data cleansers as native Column expressions.

Each cleanser returns NULL for a NULL or empty input, mirroring the dispatch
rule "type or input empty -> null".  ``cleanse(kind, col)`` is that dispatch.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from cdcflow.functions._util import as_col

# ---------------------------------------------------------------------------
# Fixed values that results depend on (must stay exactly as listed).
# Korean area codes accepted as the first three digits of a phone number:
AREA_CODES = (
    "031", "032", "033", "041", "042", "043",
    "051", "052", "053", "054", "055",
    "061", "062", "063", "064",
)
# Extra three-digit prefixes: 10-digit numbers also allow 050 and 070,
# 11-digit numbers also allow 010, 050 and 070.
PHONE10_EXTRA = ("050", "070")
PHONE11_EXTRA = ("010", "050", "070")
SEOUL_PREFIX = "02"
# Placeholders for names with nothing usable left.
NAME_FALLBACK = "고객님"
NAME_COMPACT_FALLBACK = "고객"
# Character classes (ASCII letters plus the Hangul syllable block).
LETTER_CLASS = "a-zA-Z가-힣"
# Java's ``\s`` (no Unicode whitespace) and Java ``String.trim`` (chars <= U+0020).
JAVA_SPACE = r"[ \t\n\x0B\f\r]"
# ---------------------------------------------------------------------------

_TRIM_CHARS = "".join(chr(i) for i in range(0x21))


def java_trim(c: Column | str) -> Column:
    """Java ``String.trim``: strip every char <= U+0020 at both ends."""
    return F.btrim(as_col(c), F.lit(_TRIM_CHARS))


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Multi-step cleansers reference earlier steps inside CASE branches, where
    Spark does no common-subexpression elimination; inlining them would grow
    the expression (and its generated code) multiplicatively.  A one-element
    ``transform`` binds the step to a variable instead.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _blank_to_null(c: Column) -> Column:
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))


def clean_email(c: Column | str) -> Column:
    """Normalise and validate an e-mail address; invalid -> NULL.

    Steps: drop chars outside ``[a-zA-Z0-9._@ -]`` (so ``+``/``%`` vanish but
    spaces stay), squeeze runs of dots, lowercase, then require the shape
    ``local@domain.tld``.  The shape test is the linear-time equivalent of
    ``^[a-zA-Z0-9._%+-]+[^.@]+@[A-Za-z0-9]+([.-]?[A-Za-z0-9]+)*\\.[A-Za-z]{2,}$``
    on the cleaned text: the local part is at least two chars, does not start
    with a space, does not end with a dot, and every space comes after its last
    dot; domain labels are joined by single ``.``/``-`` and the final label
    (after a dot) has two or more letters.  (The literal pattern backtracks
    exponentially on long dot-less domains.)
    """
    x = as_col(c)
    cleaned = F.lower(F.regexp_replace(F.regexp_replace(x, r"[^a-zA-Z0-9._@ -]", ""), r"\.+", "."))
    shape = (
        r"^(?:[a-z0-9._-]*\.[a-z0-9_ -]+|[a-z0-9_-][a-z0-9_ -]+)"
        r"@[a-z0-9]+(?:[.-][a-z0-9]+)*\.[a-z]{2,}$"
    )
    return _blank_to_null(x).otherwise(F.when(cleaned.rlike(shape), cleaned))


def clean_phone(c: Column | str) -> Column:
    """Korean phone number -> ``AA-BBB-CCCC`` style, or NULL when not valid.

    Digits only; 9 digits starting 02 -> 2-3-4; 10 digits starting 02 -> 2-4-4;
    10 digits with an area code, 050 or 070 -> 3-3-4; 11 digits with an area
    code, 010, 050 or 070 -> 3-4-4.
    """
    x = as_col(c)
    d = F.regexp_replace(x, "[^0-9]", "")
    n = F.length(d)
    p2 = F.substring(d, 1, 2)
    p3 = F.substring(d, 1, 3)

    def fmt(a: int, b: int) -> Column:
        return F.concat_ws("-", F.substring(d, 1, a), F.substring(d, a + 1, b), F.substring(d, a + b + 1, 64))

    return (
        _blank_to_null(x)
        .when((n == 9) & (p2 == SEOUL_PREFIX), fmt(2, 3))
        .when((n == 10) & (p2 == SEOUL_PREFIX), fmt(2, 4))
        .when((n == 10) & p3.isin(*AREA_CODES, *PHONE10_EXTRA), fmt(3, 3))
        .when((n == 11) & p3.isin(*AREA_CODES, *PHONE11_EXTRA), fmt(3, 4))
    )


def clean_name(c: Column | str) -> Column:
    """Person-name cleanser.

    1. trim (Java trim).
    2. No ASCII letter: whitespace runs -> one space, ``/`` -> ``,``; if a
       space remains, all-single-char parts are glued, else the first part wins.
    3. Text with a comma -> the part before the first comma; otherwise the
       *original untrimmed* input up to the first ``(`` (the result of step 2
       is dropped in that case).
    4. With a letter or Hangul: keep ``[a-zA-Z가-힣 ]`` only; any lowercase ->
       uppercase + trim; any Hangul -> remove spaces.
    5. Blank, or only non-name chars -> the fallback placeholder.
    6. trim.
    """
    x = as_col(c)

    def from_trimmed(t: Column) -> Column:
        squeezed = F.regexp_replace(F.regexp_replace(t, JAVA_SPACE + "+", " "), "/", ",")
        # parts are separated by single spaces, so "every part has length <= 1"
        # is "no two adjacent non-space characters".
        glued = _let(
            squeezed,
            lambda sq: F.when(~sq.contains(" "), sq)
            .when(~sq.rlike("[^ ][^ ]"), F.regexp_replace(sq, " ", ""))
            .otherwise(F.substring_index(sq, " ", 1)),
        )
        step2 = F.when(t.rlike("[a-zA-Z]"), t).otherwise(glued)
        return _let(
            step2,
            lambda s2: F.when(s2.contains(","), F.substring_index(s2, ",", 1)).otherwise(F.substring_index(x, "(", 1)),
        )

    def name_chars(s3: Column) -> Column:
        kept = F.regexp_replace(s3, f"[^{LETTER_CLASS} ]", "")
        upper = _let(kept, lambda k: F.when(k.rlike("[a-z]"), java_trim(F.upper(k))).otherwise(k))
        no_space = _let(upper, lambda u: F.when(u.rlike("[가-힣]"), F.regexp_replace(u, " ", "")).otherwise(u))
        return F.when(s3.rlike(f"[{LETTER_CLASS}]"), no_space).otherwise(s3)

    step3 = _let(java_trim(x), from_trimmed)
    step4 = _let(step3, name_chars)
    step5 = _let(
        step4,
        lambda s4: F.when((java_trim(s4) == "") | s4.rlike(f"^[^{LETTER_CLASS} ]+$"), F.lit(NAME_FALLBACK)).otherwise(s4),
    )
    return _blank_to_null(x).otherwise(java_trim(step5))


def clean_name_compact(c: Column | str) -> Column:
    """Compact name: drop whitespace, ``(...)`` groups and non-name chars."""
    x = as_col(c)
    no_ws = F.regexp_replace(x, JAVA_SPACE + "+", "")
    no_paren = F.regexp_replace(no_ws, r"\([^)]*\)", "")
    kept = F.regexp_replace(no_paren, f"[^{LETTER_CLASS}0-9 ]", "")
    return _blank_to_null(x).otherwise(F.when(kept == "", F.lit(NAME_COMPACT_FALLBACK)).otherwise(kept))


def clean_address(c: Column | str) -> Column:
    """Tab -> space, drop NBSP, Java-trim; fewer than 2 chars -> NULL."""
    x = as_col(c)
    t = java_trim(F.regexp_replace(F.translate(x, "\t", " "), "\u00a0", ""))
    return _blank_to_null(x).otherwise(F.when(F.length(t) >= 2, t))


_CLEANSERS = {
    "email": clean_email,
    "tel_no": clean_phone,
    "name": clean_name,
    "name1": clean_name_compact,
    "address": clean_address,
}


def cleanse(kind: str | None, c: Column | str) -> Column:
    """Dispatch by cleansing type; unknown or empty type -> NULL."""
    fn = _CLEANSERS.get(kind or "")
    if fn is None:
        return F.lit(None).cast("string")
    return fn(c)


def text_or_null(c: Column | str) -> Column:
    """Trimmed text; NULL for NULL, blank, or the word ``null`` (any case)."""
    t = java_trim(as_col(c))
    return F.when((t != "") & (F.lower(t) != "null"), t)


def null_to_empty(c: Column | str) -> Column:
    return F.coalesce(as_col(c).cast("string"), F.lit(""))


_PLACEHOLDER = re.compile(r"\{([^{}]+)\}")


def format_template(template: str, fields: dict[str, Column]) -> Column:
    """Replace each ``{field}`` whose name is a known field by its text.

    NULL values become ``''``; placeholders naming unknown fields stay literal.
    The template is split once on the driver into literal and field pieces, so
    the executor only runs a ``concat``.
    """
    pieces: list[Column] = []
    pos = 0
    for m in _PLACEHOLDER.finditer(template):
        name = m.group(1)
        if name not in fields:
            continue
        if m.start() > pos:
            pieces.append(F.lit(template[pos : m.start()]))
        pieces.append(null_to_empty(fields[name]))
        pos = m.end()
    if pos < len(template):
        pieces.append(F.lit(template[pos:]))
    if not pieces:
        return F.lit("")
    return F.concat(*pieces)

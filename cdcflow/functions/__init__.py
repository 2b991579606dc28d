"""Scalar Column functions (cleansers, parsers, codecs).

All of them are built from Spark's native expressions, so they stay inside
whole-stage code generation and never leave the JVM.
"""

from cdcflow.functions.jsonval import (  # noqa: F401
    json_is_number,
    json_text,
    json_value,
    variant_path,
)
from cdcflow.functions.text import (  # noqa: F401
    clean_address,
    clean_email,
    clean_name,
    clean_name_compact,
    clean_phone,
    cleanse,
    format_template,
    java_trim,
    null_to_empty,
    text_or_null,
)
from cdcflow.functions.timefn import (  # noqa: F401
    contdate_to_millis,
    normalize_epoch_millis,
    now_millis,
    ntz_epoch_micros,
    parse_instant,
    parse_timestamp,
    parse_timestamp_text,
    processed_at,
    refine_birth,
    refine_birth_epoch_days,
)
from cdcflow.functions.idfn import (  # noqa: F401
    as_boolean,
    birth_from_resno,
    decode_sequence,
    decode_sequence_b64,
    gender_from_resno,
    yn_to_boolean,
)

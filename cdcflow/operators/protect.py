"""Protect / reveal sensitive columns with Spark's native AES.

Same contract as the original remote crypto service (single and batch calls,
NULL in -> NULL out, failure -> NULL, batch keeps order and length) but a local
cipher: AES-GCM, base64 text.  ``deterministic=True`` derives the IV from a keyed
hash of the plaintext, so equal plaintexts give equal ciphertexts (joinable
tokens) and different ones never share an IV; the default random IV is the
safer choice for storage.  ``reveal`` takes the IV from the text.

The key (16, 24 or 32 bytes) is a literal of the plan; ``redact_plans`` hides the
cipher calls in explain output and plan descriptions.  Whoever can read the
driver's memory or run code in the session can still read the key.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from cdcflow.functions._util import as_col

KEY_CONF = "cdcflow.protect.key"
REDACTION_CONF = "spark.sql.redaction.string.regex"
REDACTED_CALLS = r"(?i)aes_?(en|de)crypt[^\n]*"


def redact_plans(spark: SparkSession) -> None:
    """Hide cipher calls in plan texts, unless the session has a redaction pattern of its own."""
    if not spark.conf.get(REDACTION_CONF, None):
        spark.conf.set(REDACTION_CONF, REDACTED_CALLS)


def protect(c: Column | str, key: str, deterministic: bool = False) -> Column:
    x = as_col(c).cast("string")
    if deterministic:
        iv = F.unhex(F.substring(F.sha2(F.concat(F.lit(key), F.lit("\u0000"), x, F.lit("\u0000"), F.lit(key)), 256), 1, 24))
        enc = F.aes_encrypt(x, F.lit(key), F.lit("GCM"), F.lit("DEFAULT"), iv)
    else:
        enc = F.aes_encrypt(x, F.lit(key), F.lit("GCM"))
    return F.base64(enc)


def reveal(c: Column | str, key: str) -> Column:
    raw = F.try_to_binary(as_col(c).cast("string"), F.lit("base64"))
    return F.try_aes_decrypt(raw, F.lit(key), F.lit("GCM")).cast("string")


def protect_all(arr: Column | str, key: str, deterministic: bool = False) -> Column:
    """Batch form: element-wise, same order and length."""
    return F.transform(as_col(arr), lambda v: protect(v, key, deterministic))


def reveal_all(arr: Column | str, key: str) -> Column:
    return F.transform(as_col(arr), lambda v: reveal(v, key))

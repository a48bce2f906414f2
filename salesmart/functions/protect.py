"""

The key is derived once on the driver (PBKDF2); the work per row is Spark's
built-in ``aes_encrypt`` / ``try_aes_decrypt`` (JVM, codegen), base64 text at
rest. Two modes:

* ``GCM`` (default): random IV per value, authenticated; a wrong key gives
  NULL, never garbage.
* ``CBC`` with a fixed IV: the reference's scheme (PKCS padding, base64 of the
  cipher text without the IV). Equal plaintexts give equal cipher texts, which
  allows equality joins on protected columns but also reveals equal values.

``protect`` and ``reveal`` take the key from a scalar subquery over a one-row
frame, so it shows in no plan, log or event file of the frame. ``encrypt`` and
``decrypt`` work on single columns; given the key as bytes they hold it as a
literal, and such plans must stay out of logs.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the key derivation (PBKDF2 with HMAC-SHA1, 1000 rounds,
# 64 bytes derived, the first 32 kept as the AES-256 key) and the IV length.
KDF_HASH = "sha1"
KDF_ROUNDS = 1000
KDF_BYTES = 64
KEY_BYTES = 32
IV_BYTES = 16


def derive_key(secret: str, salt: str) -> bytes:
    """AES-256 key from a secret and a salt."""
    return hashlib.pbkdf2_hmac(KDF_HASH, secret.encode("utf-8"), salt.encode("utf-8"),
                               KDF_ROUNDS, KDF_BYTES)[:KEY_BYTES]


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _key(key: bytes | Column) -> Column:
    return key if isinstance(key, Column) else F.lit(key)


def encrypt(col: str | Column, key: bytes | Column, mode: str = "GCM", iv: bytes | None = None) -> Column:
    """base64 cipher text of a string column (NULL stays NULL)."""
    if mode == "GCM":
        return F.base64(F.aes_encrypt(_c(col), _key(key), F.lit("GCM"), F.lit("DEFAULT")))
    if mode == "CBC":
        if iv is None or len(iv) != IV_BYTES:
            raise ValueError("CBC needs a 16-byte IV")
        out = F.aes_encrypt(_c(col), _key(key), F.lit("CBC"), F.lit("PKCS"), F.lit(iv))
        # Spark prepends the IV; the stored form is the cipher text alone.
        return F.base64(F.substring(out, IV_BYTES + 1, 1 << 30))
    raise ValueError(f"unsupported mode {mode}")


def decrypt(col: str | Column, key: bytes | Column, mode: str = "GCM", iv: bytes | None = None) -> Column:
    """Plaintext string; NULL when the value does not decrypt with ``key``."""
    raw = F.unbase64(_c(col))
    if mode == "GCM":
        return F.try_aes_decrypt(raw, _key(key), F.lit("GCM"), F.lit("DEFAULT")).cast("string")
    if mode == "CBC":
        if iv is None or len(iv) != IV_BYTES:
            raise ValueError("CBC needs a 16-byte IV")
        return F.try_aes_decrypt(F.concat(F.lit(iv), raw), _key(key), F.lit("CBC"),
                                 F.lit("PKCS")).cast("string")
    raise ValueError(f"unsupported mode {mode}")


def _hidden(df: DataFrame, key: bytes) -> Column:
    """The key as a scalar subquery over a one-row frame."""
    return df.sparkSession.createDataFrame([(key,)], "protection_key binary").scalar()


def protect(df: DataFrame, cols: list[str], key: bytes, mode: str = "GCM", iv: bytes | None = None) -> DataFrame:
    """Replace ``cols`` by their cipher texts."""
    hidden = _hidden(df, key)
    return df.withColumns({c: encrypt(c, hidden, mode, iv) for c in cols})


def reveal(df: DataFrame, cols: list[str], key: bytes, mode: str = "GCM", iv: bytes | None = None) -> DataFrame:
    """Replace ``cols`` by their plaintexts."""
    hidden = _hidden(df, key)
    return df.withColumns({c: decrypt(c, hidden, mode, iv) for c in cols})

"""Column protection from built-in expressions; no row leaves the JVM.

Keys are arguments. They become literals of the plan, so set
``spark.sql.redaction.string.regex`` where plans are logged.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.contract import Contract

# Salts that start like this were never set.
PLACEHOLDERS = ("REQUIRED_", "change-me")


@dataclass(frozen=True, repr=False)
class Keys:
    """Secrets of a run, handed in by the caller. ``cipher`` is raw AES key material."""

    salt: str = ""
    salt2: str = ""
    cipher: bytes = b""


def hmac_sha256(column: Column | str, key: bytes) -> Column:
    """Hex HMAC-SHA256 of the text of a value (RFC 2104); null stays null."""
    if len(key) > 64:
        key = hashlib.sha256(key).digest()
    key = key.ljust(64, b"\0")
    value = F.col(column) if isinstance(column, str) else column
    inner = F.lit(bytes(b ^ 0x36 for b in key))
    outer = F.lit(bytes(b ^ 0x5C for b in key))
    digest = F.unhex(F.sha2(F.concat(inner, value.cast("string").cast("binary")), 256))
    return F.sha2(F.concat(outer, digest), 256)


def mask(column: Column | str) -> Column:
    """First and last two characters, stars between; short values become four stars."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    stars = F.repeat(F.lit("*"), F.greatest(F.length(text) - 4, F.lit(0)))
    return F.when(F.length(text) <= 4, "****").otherwise(
        F.concat(F.substring(text, 1, 2), stars, F.substring(text, -2, 2)))


def encrypt(column: Column | str, key: bytes, salt: str, salt2: str) -> Column:
    """Base64 AES-GCM of the salted text of a value; null stays null."""
    text = (F.col(column) if isinstance(column, str) else column).cast("string")
    plain = F.concat_ws("|", F.sha2(F.lit(salt), 256), F.md5(F.lit(salt2)), text).cast("binary")
    return F.when(text.isNotNull(), F.base64(F.aes_encrypt(plain, F.lit(key), F.lit("GCM"))))


def decrypt(column: Column | str, key: bytes) -> Column:
    """The text that ``encrypt`` was given."""
    sealed = F.col(column) if isinstance(column, str) else column
    plain = F.aes_decrypt(F.unbase64(sealed), F.lit(key), F.lit("GCM")).cast("string")
    return F.regexp_replace(plain, "^[0-9a-f]{64}[|][0-9a-f]{32}[|]", "")


def protect(df: DataFrame, contract: Contract, keys: Keys = Keys()) -> DataFrame:
    """Apply the security levels hash, pii and mask in one projection.

    A contract without protected columns needs no keys.
    """
    levels = {f.name: f.level for f in contract.fields if f.level in ("hash", "pii", "mask")}
    if not levels:
        return df
    used = set(levels.values())
    if used & {"hash", "pii"} and (not keys.salt or keys.salt.startswith(PLACEHOLDERS)):
        raise ValueError("Hashed and encrypted columns need a salt of your own")
    if "pii" in used:
        if not keys.salt2 or keys.salt2.startswith(PLACEHOLDERS):
            raise ValueError("Encrypted columns need a second salt of your own")
        if len(keys.cipher) not in (16, 24, 32):
            raise ValueError(f"An AES key has 16, 24 or 32 bytes, not {len(keys.cipher)}")
    rules = {
        "hash": lambda c: hmac_sha256(c, keys.salt.encode("utf-8")),
        "pii": lambda c: encrypt(c, keys.cipher, keys.salt, keys.salt2),
        "mask": mask,
    }
    return df.select(*(
        rules[levels[c]](F.col(f"`{c}`")).alias(c) if c in levels else F.col(f"`{c}`")
        for c in df.columns
    ))

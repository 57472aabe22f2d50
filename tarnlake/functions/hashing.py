"""Hashes, keyed tokens and deterministic samples, all from built-in expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and null stand-in of the row hash.
HASH_SEPARATOR = "\x01"
HASH_NULL = "\x02"

_SHA256_BLOCK = 64


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over the columns' text, null-safe and separator-joined."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit(HASH_NULL)) for c in columns]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)


def row_hash_json(columns: list[str]) -> Column:
    """SHA-256 over the JSON text of the columns, nulls kept."""
    return F.sha2(
        F.to_json(F.array(*[F.col(c).cast("string") for c in columns]), {"ignoreNullFields": "false"}),
        256,
    )


def hmac_sha256(value: Column, secret: bytes) -> Column:
    """HMAC-SHA256 in hex as two nested ``sha2`` calls (RFC 2104)."""
    key = hashlib.sha256(secret).digest() if len(secret) > _SHA256_BLOCK else secret
    key = key.ljust(_SHA256_BLOCK, b"\x00")
    inner_pad = F.lit(bytes(b ^ 0x36 for b in key))
    outer_pad = F.lit(bytes(b ^ 0x5C for b in key))
    inner = F.unhex(F.sha2(F.concat(inner_pad, F.encode(value, "UTF-8")), 256))
    return F.sha2(F.concat(outer_pad, inner), 256)


def token(value: Column, secret: bytes) -> Column:
    """Stable pseudonym: ``TOKEN-`` and the first 16 upper-case hex digits of the HMAC."""
    return F.concat(F.lit("TOKEN-"), F.upper(F.substring(hmac_sha256(value, secret), 1, 16)))


def sample_slot(key: Column, modulo: int) -> Column:
    """Slot 0..modulo-1 of a key: first 8 hex digits of its SHA-256, modulo ``modulo``."""
    if modulo < 1:
        raise ValueError("modulo must be at least 1")
    digest = F.sha2(F.coalesce(key.cast("string"), F.lit("")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(modulo))

"""Field classification by name and masking policies."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.hashing import token
from tarnlake.functions.values import keep_last

SENSITIVE = "sensitive_pii"
PERSONAL = "pii"
INTERNAL = "internal"

# Field names that mark sensitive and personal data, ignoring case.
SENSITIVE_NAMES = (
    r"^ssn", r"^social.?security", r"^credit.?card", r"^cvv", r"^tax.?id",
)
PERSONAL_NAMES = (
    r"^email", r"^phone", r"^mobile", r"^ssn", r"^social.?security", r"^date.?of.?birth", r"^dob$",
    r"^birth.?date", r"^national.?id", r"^passport", r"^credit.?card", r"^account.?number",
    r"^ip.?address",
)

STRATEGIES = ("none", "partial_mask", "full_mask", "tokenise", "hash", "redact")


@dataclass(frozen=True)
class FieldMask:
    column: str
    strategy: str
    visible: int = 4
    level: str = PERSONAL

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown masking strategy {self.strategy!r}")


def classify_name(name: str) -> str:
    """Best guess of a field's sensitivity from its name."""
    for level, patterns in ((SENSITIVE, SENSITIVE_NAMES), (PERSONAL, PERSONAL_NAMES)):
        if any(re.search(p, name, re.IGNORECASE) for p in patterns):
            return level
    return INTERNAL


def auto_policy(columns: Iterable[str]) -> tuple[FieldMask, ...]:
    """Full masks for sensitive names, partial masks for personal ones; empty when there are none."""
    strategy = {SENSITIVE: "full_mask", PERSONAL: "partial_mask"}
    levels = ((c, classify_name(c)) for c in columns)
    return tuple(FieldMask(c, strategy[lv], level=lv) for c, lv in levels if lv in strategy)


def masked(value: Column, mask: FieldMask, secret: bytes | None = None) -> Column:
    text = value.cast("string")
    if mask.strategy == "none":
        result = text
    elif mask.strategy == "full_mask":
        result = F.lit("***")
    elif mask.strategy == "redact":
        result = F.lit("REDACTED")
    elif mask.strategy == "partial_mask":
        result = keep_last(text, mask.visible)
    elif mask.strategy == "hash":
        result = F.sha2(text, 256)
    else:
        if secret is None:
            raise ValueError("tokenise needs a secret")
        result = token(text, secret)
    return F.when(text.isNotNull(), result)


def apply_masks(
    df: DataFrame, policy: Iterable[FieldMask], secret: bytes | None = None
) -> DataFrame:
    """Mask the policy's columns that exist; nulls stay null."""
    present = {m.column: m for m in policy if m.column in df.columns}
    if not present:
        return df
    return df.withColumns({c: masked(F.col(f"`{c}`"), m, secret) for c, m in present.items()})

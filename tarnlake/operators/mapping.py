"""Declarative field mapping from raw text columns to typed canonical columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.values import cast_to, date_pattern, is_missing, keep_last, parse_layout

_SOURCE_NAME = re.compile(r"^[a-zA-Z_][a-zA-Z0-9_.]{0,127}$")
_TARGET_NAME = re.compile(r"^[a-z][a-z0-9_]{0,127}$")

# Defaults of the mapping parameters.
DEFAULT_DATE_IN = "%Y-%m-%dT%H:%M:%S.%fZ"
DEFAULT_DATE_OUT = "%Y-%m-%d"

TRANSFORMS = ("rename", "concat", "date_format", "cast", "mask")
ON_MISSING = ("drop_field", "raise_error", "use_default")


@dataclass(frozen=True)
class MappingRule:
    sources: tuple[str, ...]
    target: str
    transform: str = "rename"
    params: dict[str, str] = field(default_factory=dict)
    on_missing: str = "drop_field"
    default: str | None = None

    def __post_init__(self) -> None:
        if not self.sources:
            raise ValueError("a rule names at least one source field")
        for name in self.sources:
            if not _SOURCE_NAME.match(name):
                raise ValueError(f"bad source field {name!r}")
        if not _TARGET_NAME.match(self.target):
            raise ValueError(f"bad target field {self.target!r}")
        if self.transform not in TRANSFORMS:
            raise ValueError(f"unknown transform {self.transform!r}")
        if self.on_missing not in ON_MISSING:
            raise ValueError(f"unknown missing-field behaviour {self.on_missing!r}")


def rules_from_config(config: list[dict]) -> tuple[MappingRule, ...]:
    """Rules from a parsed rule file."""
    return tuple(
        MappingRule(
            tuple(r["source_fields"]),
            r["canonical_field"],
            r.get("transformation", "rename"),
            dict(r.get("transformation_params", {})),
            r.get("missing_field_behavior", "drop_field"),
            r.get("default_value"),
        )
        for r in config
    )


def _source(df: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def _value(df: DataFrame, rule: MappingRule, strict: bool) -> Column:
    columns = [_source(df, s) for s in rule.sources]
    first = columns[0]
    if rule.transform == "concat":
        parts = [c.cast("string") for c in columns]
        return F.concat_ws(rule.params.get("separator", " "), *parts)
    if rule.transform == "date_format":
        written = date_pattern(rule.params.get("output_format", DEFAULT_DATE_OUT))
        if rule.sources[0] in df.columns and df.schema[rule.sources[0]].dataType.typeName() in (
            "date", "timestamp", "timestamp_ntz",
        ):
            return F.date_format(first, written)
        layout = rule.params.get("input_format", DEFAULT_DATE_IN)
        if strict:
            moment = F.to_timestamp(first, date_pattern(layout, parsing=True))
        else:
            moment = parse_layout(first, layout)
        return F.date_format(moment, written)
    if rule.transform == "cast":
        return cast_to(first, rule.params.get("type", "string"), strict)
    if rule.transform == "mask":
        return keep_last(first, int(rule.params.get("visible_chars", "4")))
    return first


def _default(rule: MappingRule) -> Column:
    value = F.lit(rule.default)
    if rule.transform == "cast" and rule.default is not None:
        return cast_to(value, rule.params.get("type", "string"))
    return value


def _mapped(df: DataFrame, rules: tuple[MappingRule, ...], strict: bool) -> tuple[list[Column], Column | None]:
    """Target columns, and the reason to reject a row: empty for none, None if no rule can reject."""
    outputs: list[Column] = []
    reasons: list[Column] = []
    for rule in rules:
        missing = reduce(lambda a, b: a | b, [is_missing(_source(df, s)) for s in rule.sources])
        value = F.when(~missing, _value(df, rule, strict))
        if rule.on_missing == "use_default" and rule.default is not None:
            value = F.when(missing, _default(rule)).otherwise(value)
        outputs.append(value.alias(rule.target))
        if rule.on_missing == "raise_error":
            reasons.append(F.when(missing, F.lit(rule.target)))
        if not strict and rule.transform in ("cast", "date_format"):
            reasons.append(F.when(~missing & value.isNull(), F.lit(rule.target)))
    if not reasons:
        return outputs, None
    return outputs, F.concat_ws(",", F.array_distinct(F.array_compact(F.array(*reasons))))


def map_fields(
    df: DataFrame,
    rules: tuple[MappingRule, ...] | None,
    strict: bool = True,
    keep: tuple[str, ...] = (),
) -> tuple[DataFrame, DataFrame]:
    """Apply a rule set; returns the mapped rows and the rejected raw rows.

    A row is rejected when a required field is missing. With ``strict`` a value that cannot be read
    stops the job; without it the row is rejected. ``reject_reason`` names the target fields.
    Without rules the rows pass through. ``keep`` carries raw columns such as partition columns.
    """
    if rules is None:
        return df, df.withColumn("reject_reason", F.lit("")).where(F.lit(False))
    outputs, reason = _mapped(df, rules, strict)
    if reason is None:
        return df.select(*outputs, *keep), df.withColumn("reject_reason", F.lit("")).where(F.lit(False))
    accepted = df.where(reason == "").select(*outputs, *keep)
    rejected = df.withColumn("reject_reason", reason).where(F.col("reject_reason") != "")
    return accepted, rejected


RAW, REASON = "_raw_row", "_reject_reason"


def map_tagged(df: DataFrame, rules: tuple[MappingRule, ...] | None, strict: bool = True) -> DataFrame:
    """Mapped and rejected rows in one frame, for jobs that read the raw rows once.

    Accepted rows have the target columns and an empty ``_reject_reason``; rejected ones have nulls
    there and their raw columns in ``_raw_row``.
    """
    raw = F.struct(*[F.col(f"`{c}`").alias(c) for c in df.columns])
    if rules is None:
        return df.select("*", F.when(F.lit(False), raw).alias(RAW), F.lit("").alias(REASON))
    outputs, reason = _mapped(df, rules, strict)
    tagged = df.withColumn(REASON, F.lit("") if reason is None else reason)
    accepted = F.col(REASON) == ""
    targets = [F.when(accepted, o).alias(r.target) for o, r in zip(outputs, rules)]
    return tagged.select(*targets, F.when(~accepted, raw).alias(RAW), REASON)

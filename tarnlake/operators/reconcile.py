"""Comparing two layers: counts, money, watermark bounds and sampled fields."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.hashing import sample_slot
from tarnlake.functions.values import variance_pct

# Default tolerances in percent, default sample modulus.
COUNT_TOLERANCE_PCT = 0.1
SUM_TOLERANCE_PCT = 0.0
SAMPLE_MODULO = 100

_RESULT = ["comparator", "measure", "expected", "observed", "variance_pct", "tolerance_pct", "verdict", "detail"]


def _two_sides(expected: DataFrame, observed: DataFrame, measure: Column) -> DataFrame:
    """One row with the measure of both layers; each layer is aggregated on its own first."""
    e = expected.agg(measure.alias("v")).select(F.lit("e").alias("side"), "v")
    o = observed.agg(measure.alias("v")).select(F.lit("o").alias("side"), "v")
    return e.unionByName(o).agg(
        F.max(F.when(F.col("side") == "e", F.col("v"))).alias("e"),
        F.max(F.when(F.col("side") == "o", F.col("v"))).alias("o"),
    )


def verdict(variance: Column, tolerance: float, comparable: Column) -> Column:
    return (
        F.when(~comparable, "not_comparable")
        .when(variance == 0.0, "matched")
        .when(variance <= tolerance, "within_tolerance")
        .otherwise("variance")
    )


def _numeric(
    sides: DataFrame, comparator: str, name: str, tolerance: float, detail: Column
) -> DataFrame:
    comparable = F.col("e").isNotNull() & F.col("o").isNotNull()
    variance = F.when(comparable, variance_pct(F.col("e"), F.col("o"))).otherwise(0.0)
    return sides.select(
        F.lit(comparator).alias("comparator"),
        F.lit(name).alias("measure"),
        F.col("e").cast("string").alias("expected"),
        F.col("o").cast("string").alias("observed"),
        variance.alias("variance_pct"),
        F.lit(float(tolerance)).alias("tolerance_pct"),
        verdict(variance, tolerance, comparable).alias("verdict"),
        F.when(comparable, detail)
        .otherwise("one or both measurements are not numeric")
        .alias("detail"),
    )


def compare_counts(
    expected: DataFrame, observed: DataFrame, name: str = "rows", tolerance: float = COUNT_TOLERANCE_PCT
) -> DataFrame:
    sides = _two_sides(expected, observed, F.count(F.lit(1)))
    return _numeric(sides, "count", name, tolerance, F.lit(""))


def compare_money(
    expected: DataFrame,
    observed: DataFrame,
    column: str,
    scale: int = 2,
    tolerance: float = SUM_TOLERANCE_PCT,
) -> DataFrame:
    """Sums in decimal arithmetic; the difference is reported exactly."""
    total = F.sum(F.col(column).cast(f"decimal(18,{scale})"))
    sides = _two_sides(expected, observed, total)
    difference = F.concat(F.lit("difference="), (F.col("o") - F.col("e")).cast("string"))
    return _numeric(sides, "monetary_sum", column, tolerance, difference)


def compare_bounds(expected: DataFrame, observed: DataFrame, column: str) -> DataFrame:
    """Lowest and highest watermark as text; any difference is a variance."""
    bounds = F.concat_ws(
        "..", F.min(F.col(column)).cast("string"), F.max(F.col(column)).cast("string")
    )
    sides = _two_sides(expected, observed, bounds)
    same = F.col("e").eqNullSafe(F.col("o"))
    return sides.select(
        F.lit("watermark_bounds").alias("comparator"),
        F.lit(column).alias("measure"),
        F.col("e").alias("expected"),
        F.col("o").alias("observed"),
        F.when(same, 0.0).otherwise(100.0).alias("variance_pct"),
        F.lit(0.0).alias("tolerance_pct"),
        F.when(same, "matched").otherwise("variance").alias("verdict"),
        F.lit("").alias("detail"),
    )


def hash_sample(df: DataFrame, key: str, modulo: int = SAMPLE_MODULO) -> DataFrame:
    """The rows whose key hashes to slot 0: the same rows on every run."""
    return df.where(sample_slot(F.col(key), modulo) == 0)


def compare_fields(
    source: DataFrame, target: DataFrame, key: str, fields: list[str]
) -> DataFrame:
    """Match rate of each field over the keys both sides have; values compared as trimmed text."""

    def text(name: str) -> Column:
        return F.coalesce(F.trim(F.col(name).cast("string")), F.lit(""))

    left = source.select(F.col(key).cast("string").alias("k"), *[text(f).alias(f"s_{f}") for f in fields])
    right = target.select(F.col(key).cast("string").alias("k"), *[text(f).alias(f"t_{f}") for f in fields])
    joined = left.join(right, "k")
    rows = F.count(F.lit(1))
    rates = [
        F.struct(
            F.lit(f).alias("field_name"),
            rows.alias("compared"),
            F.count_if(F.col(f"s_{f}") == F.col(f"t_{f}")).alias("matched"),
        )
        for f in fields
    ]
    return (
        joined.agg(F.array(*rates).alias("r"))
        .select(F.inline("r"))
        .withColumn(
            "match_rate_pct",
            F.when(F.col("compared") == 0, 100.0).otherwise(
                100.0 * F.col("matched") / F.col("compared")
            ),
        )
    )


def reconciliation(comparisons: list[DataFrame]) -> DataFrame:
    """All comparison rows of one report, numbered in the order given."""
    numbered = [c.select(F.lit(i).alias("position"), *_RESULT) for i, c in enumerate(comparisons)]
    return reduce(DataFrame.unionByName, numbered)


def report(comparisons: DataFrame, header: dict[str, str]) -> DataFrame:
    """One row: findings, worst variance and a signature over the compared values.

    ``header`` gives tenant_code, entity_id, period, run_id and rule_version. The signature is the
    SHA-256 of compact JSON with sorted names, so a changed figure shows. A report has a handful
    of comparison rows, one per comparator and measure.
    """
    entry = F.struct(
        "position",
        F.struct("comparator", "expected", "measure", "observed", "verdict").alias("entry"),
    )
    gathered = comparisons.agg(
        F.array_sort(F.collect_list(entry)).alias("rows"),
        F.count_if(F.col("verdict") == "variance").alias("findings"),
        F.max("variance_pct").alias("worst_variance_pct"),
    )
    names = ("entity_id", "period", "rule_version", "run_id", "tenant_code")
    payload = F.to_json(
        F.struct(
            F.transform("rows", lambda r: r["entry"]).alias("comparisons"),
            *[F.lit(header[n]).alias(n) for n in names],
        )
    )
    return gathered.select(
        *[F.lit(header[n]).alias(n) for n in names],
        F.size("rows").alias("comparisons"),
        "findings",
        "worst_variance_pct",
        (F.col("findings") == 0).alias("matched"),
        F.sha2(payload, 256).alias("signature"),
    )

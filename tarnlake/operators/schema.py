"""Schema snapshots, drift classification and dataset lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SNAPSHOT = (
    "name string, data_type string, is_nullable boolean, length int, precision int, scale int"
)

# Drift classes in order of severity.
CLASSES = ("no_drift", "non_breaking", "potentially_breaking", "breaking")


def declared_schema(df: DataFrame) -> DataFrame:
    """Snapshot rows of the declared schema: one row per column."""
    rows = []
    for f in df.schema.fields:
        decimal = isinstance(f.dataType, T.DecimalType)
        rows.append(
            (
                f.name,
                f.dataType.typeName(),
                f.nullable,
                getattr(f.dataType, "length", None),
                f.dataType.precision if decimal else None,
                f.dataType.scale if decimal else None,
            )
        )
    return df.sparkSession.createDataFrame(rows, SNAPSHOT)


def observed_schema(df: DataFrame) -> DataFrame:
    """Snapshot rows with nullability and text length as found in the data, from one pass."""
    entries = []
    for f in df.schema.fields:
        col = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, T.StringType)
        decimal = isinstance(f.dataType, T.DecimalType)
        entries.append(
            F.struct(
                F.lit(f.name).alias("name"),
                F.lit(f.dataType.typeName()).alias("data_type"),
                (F.count_if(col.isNull()) > 0).alias("is_nullable"),
                (F.max(F.length(col)) if text else F.lit(None)).cast("int").alias("length"),
                F.lit(f.dataType.precision if decimal else None).cast("int").alias("precision"),
                F.lit(f.dataType.scale if decimal else None).cast("int").alias("scale"),
            )
        )
    return df.agg(F.array(*entries).alias("r")).select(F.inline("r"))


def fingerprint(snapshot: DataFrame) -> DataFrame:
    """One row: SHA-256 over name, type, length, precision and scale, by name; not nullability."""

    def number(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit("null"))

    item = F.concat(
        F.lit('{"len": '), number("length"), F.lit(', "name": "'), F.col("name"),
        F.lit('", "prec": '), number("precision"), F.lit(', "scale": '), number("scale"),
        F.lit(', "type": "'), F.col("data_type"), F.lit('"}'),
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col("name"), item.alias("item"))))
    text = F.concat(
        F.lit("["), F.array_join(F.transform(ordered, lambda x: x["item"]), ", "), F.lit("]")
    )
    return snapshot.agg(
        F.count(F.lit(1)).alias("fields"), F.sha2(text, 256).alias("schema_fingerprint")
    )


def _flag(value: Column) -> Column:
    return F.when(value, "True").otherwise("False")


def schema_drift(current: DataFrame, previous: DataFrame) -> DataFrame:
    """One row per change: field, kind, class, previous and current value."""
    c = current.select(*[F.col(x).alias(f"c_{x}") for x in current.columns])
    p = previous.select(*[F.col(x).alias(f"p_{x}") for x in previous.columns])
    both = c.join(p, F.col("c_name") == F.col("p_name"), "full_outer")
    in_c, in_p = F.col("c_name").isNotNull(), F.col("p_name").isNotNull()

    def change(when: Column, kind: str, level: Column | str, before: Column, after: Column) -> Column:
        return F.when(
            when,
            F.struct(
                F.lit(kind).alias("change_kind"),
                (F.lit(level) if isinstance(level, str) else level).alias("classification"),
                before.cast("string").alias("previous_value"),
                after.cast("string").alias("current_value"),
            ),
        )

    none = F.lit(None).cast("string")
    changes = [
        change(in_p & ~in_c, "removed", "breaking", F.col("p_data_type"), none),
        change(
            in_c & ~in_p,
            "added",
            F.when(F.col("c_is_nullable"), "non_breaking").otherwise("breaking"),
            none,
            F.col("c_data_type"),
        ),
    ]
    kept = in_c & in_p
    for attribute, kind, level in (
        ("data_type", "type_changed", "breaking"),
        ("precision", "precision_changed", "potentially_breaking"),
        ("scale", "scale_changed", "potentially_breaking"),
        ("length", "length_changed", "potentially_breaking"),
    ):
        before, after = F.col(f"p_{attribute}"), F.col(f"c_{attribute}")
        changes.append(change(kept & ~before.eqNullSafe(after), kind, level, before, after))
    before, after = F.col("p_is_nullable"), F.col("c_is_nullable")
    changes.append(
        change(
            kept & ~before.eqNullSafe(after),
            "nullability_changed",
            F.when(after, "non_breaking").otherwise("breaking"),
            _flag(before),
            _flag(after),
        )
    )
    return (
        both.select(
            F.coalesce("c_name", "p_name").alias("field_name"),
            F.explode(F.array_compact(F.array(*changes))).alias("d"),
        )
        .select("field_name", "d.*")
    )


def drift_summary(changes: DataFrame) -> DataFrame:
    """One row: number of changes, the worst class, and whether transformation must stop."""
    order = F.array(*[F.lit(c) for c in CLASSES])
    rank = F.array_position(order, F.col("classification"))
    worst = F.coalesce(F.max_by("classification", rank), F.lit(CLASSES[0]))
    return changes.agg(
        F.count(F.lit(1)).alias("changes"), worst.alias("overall_classification")
    ).withColumn("is_transformation_blocked", F.col("overall_classification") == "breaking")


def lineage(
    df: DataFrame,
    run_id: str,
    stage: str,
    entity_id: str,
    sources: list[tuple[str, str, str]],
    target: tuple[str, str, str],
    versions: dict[str, str] | None = None,
) -> DataFrame:
    """Lineage rows of one stage: a row per source dataset, with the rows written to the target.

    A dataset is ``(name, path, layer)``; ``versions`` holds the rule versions in force.
    """
    if not sources:
        raise ValueError("lineage needs at least one source dataset")
    names = ["source_name", "source_path", "source_layer"]
    listed = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(names, s)]) for s in sources])
    told = F.lit("{}")
    if versions:
        pairs = [F.lit(x) for item in sorted(versions.items()) for x in item]
        told = F.to_json(F.create_map(*pairs))
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(run_id).alias("run_id"),
        F.lit(stage).alias("stage"),
        F.lit(entity_id).alias("entity_id"),
        F.inline(listed),
        *[F.lit(v).alias(f"target_{k}") for k, v in zip(("name", "path", "layer"), target)],
        "record_count",
        told.alias("versions"),
    )

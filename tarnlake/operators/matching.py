"""Finding records of the same real-world entity: blocking, rules, links and decisions.

Links are the output that clustering needs. Records that agree on a whole rule key are linked to
the smallest record id of the key, not to each other, so a key shared by very many records costs
one link per record. Similarity rules compare distinct value combinations, and only those that
agree on every field the threshold makes compulsory.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions import text
from tarnlake.operators.scope import SCOPE_COLUMN
from tarnlake.session import cut_lineage

RECORD_ID = "_record_id"
SOURCE_ID = "_source_id"
KINDS = ("exact", "jaro_winkler", "token_set")

_EPS = 1e-9
_TILE_ROWS = 512
#: Tile of the groups that ``_close_texts`` compares.
_TEXT_ROWS = 4_096
_TEXT_SCORE = "_text_score"
_BUCKET_DIGITS = 4
_NO_UNIT = "\x00"


@dataclass(frozen=True)
class Blocking:
    """How records are divided before comparison.

    Without ``max_block_size`` every pair of a block is a candidate. With it, larger blocks are cut
    into pieces of that size and pairs across pieces are not compared; the pieces follow a fixed
    order of the record ids' hash, so they do not depend on partitioning.
    """

    key_type: str
    field: str
    max_block_size: int | None = None

    def __post_init__(self) -> None:
        if self.key_type not in text.BLOCK_KEYS:
            raise ValueError(f"unknown blocking key {self.key_type!r}")
        if self.max_block_size is not None and self.max_block_size < 2:
            raise ValueError("a block holds at least two records")


@dataclass(frozen=True)
class ExactField:
    field: str
    normalise: bool = True


@dataclass(frozen=True)
class SimilarField:
    field: str
    weight: float
    kind: str = "exact"

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown similarity {self.kind!r} for {self.field!r}")
        if self.weight <= 0:
            raise ValueError(f"the weight of {self.field!r} must be positive")


@dataclass(frozen=True)
class ExactRule:
    rule_id: str
    fields: tuple[ExactField, ...]


@dataclass(frozen=True)
class SimilarRule:
    rule_id: str
    fields: tuple[SimilarField, ...]
    threshold: float

    def __post_init__(self) -> None:
        if self.threshold <= 0:
            raise ValueError(f"rule {self.rule_id!r}: a threshold of 0 matches everything")


@dataclass(frozen=True)
class MatchRules:
    entity_type: str
    version: str
    rules: tuple[ExactRule | SimilarRule, ...]
    blocking: Blocking | None = None
    within_unit: bool = False
    ascii_only: bool = False


def rules_from_config(config: dict, within_unit: bool = False) -> MatchRules:
    """Rules from a parsed rule file; unknown or missing settings are errors."""
    rules: list[ExactRule | SimilarRule] = []
    for item in config["rules"]:
        try:
            if item["strategy"] == "deterministic":
                fields = tuple(
                    ExactField(f["field_name"], f.get("normalise", True)) for f in item["fields"]
                )
                rules.append(ExactRule(item["rule_id"], fields))
            elif item["strategy"] == "probabilistic":
                similar = tuple(
                    SimilarField(f["field_name"], float(f["weight"]), f["similarity_kind"])
                    for f in item["fields"]
                )
                rules.append(SimilarRule(item["rule_id"], similar, float(item["match_threshold"])))
            else:
                raise ValueError(f"unknown strategy {item['strategy']!r}")
        except KeyError as exc:
            raise ValueError(f"rule {item.get('rule_id')!r} lacks {exc.args[0]!r}") from exc
    block = config.get("blocking")
    blocking = None
    if block:
        blocking = Blocking(block["key_type"], block["source_field"], block.get("max_block_size"))
    return MatchRules(
        config["entity_type"], config["rule_set_version"], tuple(rules), blocking, within_unit
    )


# ---------------------------------------------------------------- records and blocks


def tag_records(df: DataFrame, source: str, key: str) -> DataFrame:
    """Add ``_record_id`` (``source:key``) and ``_source_id``."""
    return df.withColumn(
        RECORD_ID, F.concat(F.lit(f"{source}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))
    ).withColumn(SOURCE_ID, F.lit(source))


def union_sources(sources: dict[str, DataFrame | None], key: str | dict[str, str]) -> DataFrame:
    """Tagged union by name of every source that has data."""
    tagged = [
        tag_records(df, name, key if isinstance(key, str) else key[name])
        for name, df in sources.items()
        if df is not None
    ]
    if not tagged:
        raise ValueError("no source has data")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def block_column(rules: MatchRules) -> Column:
    key = F.lit("")
    if rules.blocking is not None:
        make = text.BLOCK_KEYS[rules.blocking.key_type]
        key = make(F.col(rules.blocking.field), rules.ascii_only)
    if not rules.within_unit:
        return key
    unit = F.coalesce(F.nullif(F.col(SCOPE_COLUMN), F.lit("")), F.lit(text.UNATTRIBUTED_KEY))
    return unit if rules.blocking is None else F.concat_ws("::", unit, key)


def cut_blocks(records: DataFrame, block: str, size: int, record_id: str = RECORD_ID) -> DataFrame:
    """Add ``_chunk``: the piece of its block a record belongs to, at most ``size`` records each.

    Only oversized blocks are ranked. Their records are first spread over hash buckets; counts per
    bucket give the rank at which each bucket starts, and the rank inside a bucket comes from a
    window over that bucket alone. No task ever holds a whole hot block.
    """
    sizes = records.groupBy(block).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    flagged = records.join(sizes.withColumnRenamed(block, "_b"), F.col(block) == F.col("_b"), "left").drop("_b")
    small = flagged.where(F.col("_n").isNull()).drop("_n").withColumn("_chunk", F.lit(0).cast("long"))
    digest = F.md5(F.col(record_id))
    large = (
        flagged.where(F.col("_n").isNotNull())
        .drop("_n")
        .withColumn("_digest", digest)
        .withColumn("_bucket", F.substring("_digest", 1, _BUCKET_DIGITS))
    )
    counts = large.groupBy(block, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(block).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col(block).alias("_b"),
        F.col("_bucket").alias("_k"),
        F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy(block, "_bucket").orderBy("_digest", record_id)
    ranked = large.withColumn("_rank", F.row_number().over(inside) - 1)
    placed = ranked.join(
        starts, (F.col(block) == F.col("_b")) & (F.col("_bucket") == F.col("_k"))
    ).withColumn("_chunk", F.floor((F.col("_start") + F.col("_rank")) / size).cast("long"))
    return small.unionByName(placed.select(*small.columns))


def cut_block_report(records: DataFrame, block: str, size: int) -> DataFrame:
    """One row: blocks that ``cut_blocks`` cuts at ``size``, and the records in them."""
    sizes = records.groupBy(block).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > size)
    return sizes.agg(
        F.count(F.lit(1)).alias("cut_blocks"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("records_in_cut_blocks"),
    )


def _fields(rules: MatchRules) -> tuple[list[str], list[str]]:
    """Fields needed normalised, and fields needed as they are."""
    normal, raw = [], []
    for rule in rules.rules:
        for f in rule.fields:
            as_is = isinstance(f, ExactField) and not f.normalise
            (raw if as_is else normal).append(f.field)
    return list(dict.fromkeys(normal)), list(dict.fromkeys(raw))


def _normal(name: str) -> str:
    return f"n_{name}"


def _raw(name: str) -> str:
    return f"r_{name}"


def prepare(records: DataFrame, rules: MatchRules) -> DataFrame:
    """Record id, block, unit, piece and the compared values; nothing else of the record."""
    normal, raw = _fields(rules)
    unit = F.coalesce(F.col(SCOPE_COLUMN).cast("string"), F.lit(_NO_UNIT)) if rules.within_unit else F.lit("")
    slim = records.select(
        F.col(RECORD_ID),
        block_column(rules).alias("_block"),
        unit.alias("_unit"),
        *[text.normalise(F.col(f), rules.ascii_only).alias(_normal(f)) for f in normal],
        *[F.col(f).cast("string").alias(_raw(f)) for f in raw],
    )
    if rules.blocking is not None and rules.blocking.max_block_size is not None:
        return cut_blocks(slim, "_block", rules.blocking.max_block_size)
    return slim.withColumn("_chunk", F.lit(0).cast("long"))


_GROUP = ["_block", "_unit", "_chunk"]


def _same(left: str, right: str, columns: list[str], nullable: tuple[str, ...] = ()) -> Column:
    """Equality in all columns; two nulls are equal in the nullable ones."""
    pairs = [(c, F.col(f"{left}.{c}"), F.col(f"{right}.{c}")) for c in columns]
    return reduce(lambda x, y: x & y, [a.eqNullSafe(b) if c in nullable else a == b for c, a, b in pairs])


def star_links(prepared: DataFrame, keys: list[str], nullable: tuple[str, ...] = ()) -> DataFrame:
    """Link every record to the smallest record id with the same keys.

    The smallest id is a map-side-combined aggregate, and joining it back is one row per key, so
    adaptive execution can split a hot key.
    """
    hubs = (
        prepared.groupBy(*keys)
        .agg(F.min(RECORD_ID).alias("hub"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
        .drop("n")
    )
    return (
        prepared.alias("r")
        .join(hubs.alias("h"), _same("r", "h", keys, nullable))
        .where(F.col(f"r.{RECORD_ID}") != F.col("hub"))
        .select(F.col("hub").alias("record_a_id"), F.col(f"r.{RECORD_ID}").alias("record_b_id"))
    )


# ---------------------------------------------------------------- similarity


def _similarity(f: SimilarField, left: str, right: str) -> Column:
    a, b = F.col(f"{left}.{_normal(f.field)}"), F.col(f"{right}.{_normal(f.field)}")
    if f.kind == "jaro_winkler":
        return text.jaro_winkler(a, b)
    if f.kind == "token_set":
        return text.token_overlap(text.tokens(a), text.tokens(b))
    return F.when(a == b, 1.0).otherwise(0.0)


def _total(parts: list[tuple[SimilarField, Column]], left: str, right: str) -> Column:
    """Weighted sum in field order; a field with a null on either side adds nothing."""
    total = F.lit(0.0)
    for f, similarity in parts:
        both = F.col(f"{left}.{_normal(f.field)}").isNotNull() & F.col(
            f"{right}.{_normal(f.field)}"
        ).isNotNull()
        total = total + F.when(both, similarity * F.lit(float(f.weight))).otherwise(0.0)
    return total


def _matched(parts: list[tuple[SimilarField, Column]], left: str, right: str) -> Column:
    names = []
    for f, similarity in parts:
        both = F.col(f"{left}.{_normal(f.field)}").isNotNull() & F.col(
            f"{right}.{_normal(f.field)}"
        ).isNotNull()
        names.append(F.when(both & (similarity > 0.5), F.lit(f.field)))
    return F.array_compact(F.array(*names))


def _scored(
    pairs: DataFrame, rule: SimilarRule, prefix: str = "_s"
) -> tuple[DataFrame, list[tuple[SimilarField, Column]]]:
    """Add a column per field similarity, so that each is computed once per pair; those of texts that
    ``close_sides`` compared are known."""
    names = {f"{prefix}{i}": f for i, f in enumerate(rule.fields)}
    known = _TEXT_SCORE in pairs.columns
    rows = pairs.withColumns(
        {
            n: F.col(_TEXT_SCORE) if known and f.kind == "jaro_winkler" else _similarity(f, "a", "b")
            for n, f in names.items()
        }
    )
    return rows, [(f, F.col(n)) for n, f in names.items()]


@dataclass(frozen=True)
class Approach:
    """One way to a superset of a rule's matches: fields that must be equal, and at most one whose
    words must overlap to a degree."""

    equal: tuple[str, ...]
    words: str | None = None
    overlap: float = 0.0


def _needed(rule: SimilarRule, f: SimilarField) -> float:
    """How similar a field must be at least if the others are at their most."""
    others = sum(g.weight for g in rule.fields) - f.weight
    return (rule.threshold - others) / f.weight - _EPS


def approaches(rule: SimilarRule) -> list[Approach]:
    """What any match must have in common, derived from weights and threshold.

    With the other fields at most 1, a field needs ``(threshold - other weights) / weight``. Where
    that is positive for an exact field, matches are equal in it; for a word-set field, matches
    overlap at least that much. If no field is compulsory but all are exact or word sets, every
    match reaches the average ``threshold / total weight`` in at least one of them. Otherwise all
    pairs of a block are compared.
    """
    weights = sum(f.weight for f in rule.fields)

    def need(f: SimilarField) -> float:
        return _needed(rule, f)

    equal = tuple(f.field for f in rule.fields if f.kind == "exact" and need(f) > 0)
    words = [f for f in rule.fields if f.kind == "token_set" and need(f) > 0]
    if equal or words:
        best = max(words, key=need) if words else None
        return [Approach(equal, best.field if best else None, need(best) if best else 0.0)]
    if all(f.kind in ("exact", "token_set") for f in rule.fields):
        share = rule.threshold / weights - _EPS
        return [
            Approach((f.field,)) if f.kind == "exact" else Approach((), f.field, share)
            for f in rule.fields
        ]
    return [Approach(())]


def _with_rare_words(profiles: DataFrame, approach: Approach) -> DataFrame:
    """One row per (profile, word) for the words a match must share one of.

    Words are ordered from rare to common. Two sets that overlap by ``overlap`` share a word among
    the first ``n - ceil(overlap * n) + 1`` of each, the prefix of set-similarity joins (Chaudhuri
    et al., 2006), so only those words become join keys.
    """
    source = _normal(approach.words)
    split = profiles.withColumn("_words", text.tokens(F.col(source)))
    exploded = split.select("profile", F.explode("_words").alias("word"))
    frequency = exploded.groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    ordered = (
        exploded.join(frequency, "word")
        .groupBy("profile")
        .agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("s"))
    )
    n = F.size("s")
    keep = n - F.ceil(F.lit(approach.overlap) * n - _EPS).cast("int") + 1
    prefix = ordered.select(
        "profile", F.transform(F.slice("s", F.lit(1), F.least(keep, n)), lambda w: w["word"]).alias("_prefix")
    )
    return (
        split.drop("_words")
        .join(prefix, "profile")
        .withColumn("_word", F.explode("_prefix"))
    )


def _in_cells(keyed: DataFrame, keys: list[str], bounded: bool) -> DataFrame:
    """Spread groups with many profiles over cells of bounded size.

    The profiles of a large group fall into tiles by hash. A cell joins two tiles, and every pair
    of profiles meets in exactly one cell, so no pair is lost and no task holds the whole group.
    """
    if bounded:
        zero = F.lit(0)
        return keyed.withColumns({"_tile": zero, "_low": zero, "_high": zero})
    sizes = (
        keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > _TILE_ROWS)
    )
    flagged = (
        keyed.alias("k")
        .join(sizes.alias("s"), _same("k", "s", keys), "left")
        .select("k.*", F.coalesce(F.ceil(F.col("s._n") / _TILE_ROWS), F.lit(1)).cast("int").alias("_t"))
    )
    tiled = flagged.withColumn("_tile", F.pmod(F.xxhash64("profile"), F.col("_t")).cast("int"))
    spread = tiled.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_t") - 1)))
    return spread.withColumns(
        {"_low": F.least("_tile", "_other"), "_high": F.greatest("_tile", "_other")}
    ).drop("_t", "_other")


def _best_score(rule: SimilarRule) -> Column:
    """What a record can score at most: the weights of its usable fields."""
    best = F.lit(0.0)
    for f in rule.fields:
        value = F.col(_normal(f.field))
        usable = value.isNotNull() & (value != "") if f.kind == "token_set" else value.isNotNull()
        best = best + F.when(usable, float(f.weight)).otherwise(0.0)
    return best


def _profiles(prepared: DataFrame, rule: SimilarRule) -> tuple[DataFrame, list[str]]:
    """Distinct value combinations per group that could reach the threshold at all.

    A combination scores at most the weights of its non-null fields, so one below the threshold
    matches nothing. Every record with the combination is linked to ``profile``, its smallest id.
    """
    values = [_normal(f.field) for f in rule.fields]
    possible = prepared.where(_best_score(rule) >= rule.threshold)
    keys = [*_GROUP, *values]
    return possible.select(RECORD_ID, *keys), keys


def combinations(prepared: DataFrame, rule: SimilarRule) -> tuple[DataFrame, DataFrame]:
    """Links inside value combinations, and the combinations."""
    possible, keys = _profiles(prepared, rule)
    inside = star_links(possible, keys, tuple(keys[len(_GROUP) :]))
    return inside, possible.groupBy(*keys).agg(F.min(RECORD_ID).alias("profile"))


def similar_pairs(
    prepared: DataFrame, rule: SimilarRule, bounded: bool
) -> tuple[DataFrame, DataFrame]:
    """Links inside value combinations, and scored matching pairs of combinations."""
    inside, profiles = combinations(prepared, rule)
    found: list[DataFrame] = []
    options = approaches(rule)
    only = None if bounded else lone_text(rule, options)
    if only is not None:
        profiles = cut_lineage(profiles, "profiles")
        rest, wide = _by_group_size(profiles, options[0], only)
        small = matching_pairs(_candidates(rest, rule, options[0], False), rule)
        return inside, small if wide is None else small.unionByName(_close_texts(wide, rule, only))
    for approach in options:
        found.append(_candidates(profiles, rule, approach, bounded))
    pairs = reduce(DataFrame.unionByName, found)
    if len(options) > 1:
        pairs = pairs.distinct()
    result = matching_pairs(pairs, rule)
    return inside, result


def matching_pairs(pairs: DataFrame, rule: SimilarRule) -> DataFrame:
    """Score and matched fields of the pairs of combinations that reach the rule's threshold."""
    rows, scored = _scored(pairs, rule)
    return rows.select(
        F.col("a.profile").alias("record_a_id"),
        F.col("b.profile").alias("record_b_id"),
        _total(scored, "a", "b").alias("score"),
        _matched(scored, "a", "b").alias("matched_fields"),
    ).where(F.col("score") >= rule.threshold)


def lone_text(rule: SimilarRule, options: list[Approach]) -> SimilarField | None:
    """The Jaro-Winkler field of a rule whose other fields are equal in all matches, if it has to be
    similar to a degree."""
    others = [f for f in rule.fields if f.field not in options[0].equal]
    if len(options) > 1 or len(others) != 1 or others[0].kind != "jaro_winkler":
        return None
    return others[0] if _needed(rule, others[0]) > 0 else None


def word_letters(value: Column) -> Column:
    """The length of a text, more than a word has letters if ``text.close_pairs`` can't compare it."""
    return F.greatest(F.length(value), F.when(F.contains(value, F.lit("\x00")), text.WORD_LETTERS + 1))


def _by_group_size(
    profiles: DataFrame, approach: Approach, only: SimilarField
) -> tuple[DataFrame, DataFrame | None]:
    """Combinations of small groups, and ``_group, _tiles, profile, text`` of those in large groups, if
    there are any. Groups with a text that doesn't fit a word count as small."""
    rows, keys = equal_profiles(profiles, approach)
    value = F.col(_normal(only.field))
    rows = rows.where(value.isNotNull() & F.col("profile").isNotNull())
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.max(word_letters(value)).alias("_longest"))
    large = sizes.where((F.col("_n") > _TILE_ROWS) & (F.col("_longest") <= text.WORD_LETTERS))
    tiles = F.ceil(F.col("_n") / _TEXT_ROWS).cast("int")
    large = cut_lineage(
        large.select(*keys, F.monotonically_increasing_id().alias("_group"), tiles.alias("_tiles")), "large"
    )
    if large.isEmpty():
        return profiles, None
    rest = profiles.join(large, keys, "left_anti")
    return rest, rows.join(large, keys).select("_group", "_tiles", "profile", value.alias("text"))


def _close_texts(wide: DataFrame, rule: SimilarRule, only: SimilarField) -> DataFrame:
    """``matching_pairs`` of all combinations of each group, by comparing many texts at a time.

    The cells are those of ``_in_cells`` with larger tiles. A task holds the texts of one cell.
    """
    tile = F.pmod(F.xxhash64("profile"), F.col("_tiles")).cast("int")
    spread = wide.withColumn("_tile", tile).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)))
    cell = ["_group", "_low", "_high"]
    spread = spread.withColumns({"_low": F.least("_tile", "_other"), "_high": F.greatest("_tile", "_other")})
    spread = spread.select(*cell, "_tile", "profile", "text")
    # Cells differ in work, not in bytes: several for each core even out.
    session = spread.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), 4 * session.sparkContext.defaultParallelism)
    dealt = spread.repartition(tasks, *cell).sortWithinPartitions(*cell)
    least = _needed(rule, only)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _cells(batches, cell):
            tiles, names = held["_tile"].to_numpy(), held["profile"].to_numpy(zero_copy_only=False)
            rank = np.unique(names, return_inverse=True)[1]
            texts = held["text"].to_numpy(zero_copy_only=False)
            low, high = (np.flatnonzero(tiles == held[c][0].as_py()) for c in ("_low", "_high"))
            sides = [(low, low)] if held["_low"][0] == held["_high"][0] else [(low, high), (high, low)]
            for a, b in sides:
                for i, j, score in text.close_pairs(texts[a], texts[b], rank[a], rank[b], least):
                    ends = [held["profile"].take(pa.array(side)) for side in (a[i], b[j])]
                    yield pa.RecordBatch.from_arrays([*ends, pa.array(score)], ["record_a_id", "record_b_id", "_s"])

    pairs = dealt.mapInArrow(compare, "record_a_id string, record_b_id string, _s double")
    total, names = F.lit(0.0), []
    for f in rule.fields:
        alike = f is only
        total = total + (F.col("_s") if alike else F.lit(1.0)) * F.lit(float(f.weight))
        names.append(F.when(F.col("_s") > 0.5, F.lit(f.field)) if alike else F.lit(f.field))
    return pairs.select(
        "record_a_id", "record_b_id", total.alias("score"), F.array_compact(F.array(*names)).alias("matched_fields")
    ).where(F.col("score") >= rule.threshold)


def close_sides(a: DataFrame, b: DataFrame, cell: list[str], rule: SimilarRule, only: SimilarField) -> DataFrame:
    """The sides ``a`` and ``b``, as structs of the columns they share, of the pairs of a row of ``a`` and
    one of ``b`` in a cell that can match by their texts, which have to fit a word; with the similarity.

    A pair is compared with the smaller profile first, and not with itself; a task holds a cell.
    """
    value = _normal(only.field)
    values = [_normal(f.field) for f in rule.fields]
    shared = [c for c in a.columns if c in b.columns and (c not in cell or c in values)]
    usable = reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in (*cell, value, "profile")])
    sides = [
        side.where(usable).select(*dict.fromkeys([*cell, *shared]), F.lit(right).alias("_right"))
        for side, right in ((a, False), (b, True))
    ]
    both = sides[0].unionByName(sides[1])
    fields = ", ".join(f"`{c}`: {both.schema[c].dataType.simpleString()}" for c in shared)
    tasks = int(both.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(tasks, *cell).sortWithinPartitions(*cell)
    least = _needed(rule, only)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _cells(batches, cell):
            right = held["_right"].to_numpy(zero_copy_only=False)
            left, right = np.flatnonzero(~right), np.flatnonzero(right)
            if not len(left) or not len(right):
                continue
            rank = np.unique(held["profile"].to_numpy(zero_copy_only=False), return_inverse=True)[1]
            texts = held[value].to_numpy(zero_copy_only=False)
            rows = pa.StructArray.from_arrays([held[c] for c in shared], shared)
            for x, y in ((left, right), (right, left)):
                for i, j, score in text.close_pairs(texts[x], texts[y], rank[x], rank[y], least):
                    ends = [rows.take(pa.array(side)) for side in (x[i], y[j])]
                    ends = ends if x is left else ends[::-1]
                    yield pa.RecordBatch.from_arrays([*ends, pa.array(score)], ["a", "b", _TEXT_SCORE])

    return dealt.mapInArrow(compare, f"a struct<{fields}>, b struct<{fields}>, {_TEXT_SCORE} double")


def _cells(batches: Iterable[pa.RecordBatch], cell: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each cell as one batch, from rows sorted by the cells."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        other = np.zeros(batch.num_rows - 1, bool)
        for c in cell:
            other |= pc.not_equal(batch[c].slice(1), batch[c].slice(0, len(other))).to_numpy(zero_copy_only=False)
        bounds = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for low, high in zip(bounds, bounds[1:]):
            part = batch.slice(low, high - low)
            if held and any(held[-1][c][0] != part[c][0] for c in cell):
                yield pa.concat_batches(held)
                held = []
            held.append(part)
    if held:
        yield pa.concat_batches(held)


def _bound(rule: SimilarRule, known_equal: tuple[str, ...]) -> Column:
    """A score no pair exceeds, from built-in expressions, to spare most pairs the exact one.

    Fields that the join already makes equal count in full.
    """
    parts: list[tuple[SimilarField, Column]] = []
    for f in rule.fields:
        if f.field in known_equal:
            parts.append((f, F.lit(1.0)))
        elif f.kind == "jaro_winkler":
            name = _normal(f.field)
            bound = text.jaro_winkler_bound(F.col(f"a.l_{name}"), F.col(f"b.l_{name}"))
            parts.append((f, bound))
        else:
            parts.append((f, _similarity(f, "a", "b")))
    return _total(parts, "a", "b")


def with_letters(profiles: DataFrame, rule: SimilarRule) -> DataFrame:
    """Add what the bound needs of the texts, where it is not there yet."""
    letters = [_normal(f.field) for f in rule.fields if f.kind == "jaro_winkler"]
    letters = [n for n in letters if f"l_{n}" not in profiles.columns]
    if not letters:
        return profiles
    slots = profiles.withColumns({f"t_{n}": text.letter_slots(F.col(n)) for n in letters})
    return slots.withColumns(
        {f"l_{n}": text.letter_profile(F.col(n), F.col(f"t_{n}")) for n in letters}
    ).drop(*[f"t_{n}" for n in letters])


def equal_profiles(profiles: DataFrame, approach: Approach) -> tuple[DataFrame, list[str]]:
    """The combinations that can match by an approach, and the columns that matches are equal in."""
    for f in approach.equal:
        profiles = profiles.where(F.col(_normal(f)).isNotNull())
    return profiles, [*_GROUP, *[_normal(f) for f in approach.equal]]


def keyed_profiles(
    profiles: DataFrame, rule: SimilarRule, approach: Approach
) -> tuple[DataFrame, list[str]]:
    """``equal_profiles`` with what the bound needs."""
    return equal_profiles(with_letters(profiles, rule), approach)


def as_pairs(joined: DataFrame, rule: SimilarRule) -> DataFrame:
    """The sides ``a`` and ``b`` of a join of combinations as two structs of the compared values."""
    columns = ["profile", *[_normal(f.field) for f in rule.fields]]
    return joined.select(
        *[c for c in joined.columns if c == _TEXT_SCORE],
        F.struct(*[F.col(f"a.{c}").alias(c) for c in columns]).alias("a"),
        F.struct(*[F.col(f"b.{c}").alias(c) for c in columns]).alias("b"),
    )


def _candidates(
    profiles: DataFrame, rule: SimilarRule, approach: Approach, bounded: bool
) -> DataFrame:
    """Pairs of combinations as two structs, each pair once, pruned by the score bound."""
    keyed, keys = keyed_profiles(profiles, rule, approach)
    if approach.words is not None:
        keyed = _with_rare_words(keyed.where(F.col(_normal(approach.words)).isNotNull()), approach)
        keys.append("_word")
    side = _in_cells(keyed, keys, bounded)
    # The join is heavy in comparisons, not in bytes: a fixed number of partitions keeps adaptive
    # execution from merging it into few tasks. Cells bound the size of a group.
    tasks = int(side.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    side = side.repartition(tasks, *keys, "_low", "_high")
    once = (F.col("a._low") == F.col("a._high")) | (F.col("a._tile") != F.col("b._tile"))
    condition = (
        _same("a", "b", [*keys, "_low", "_high"])
        & (F.col("a.profile") < F.col("b.profile"))
        & once
        & (_bound(rule, approach.equal) >= rule.threshold - _EPS)
    )
    if approach.words is not None:
        shared = F.array_intersect(F.col("a._prefix"), F.col("b._prefix"))
        condition = condition & (F.element_at(shared, 1) == F.col("a._word"))
    return as_pairs(side.alias("a").join(side.alias("b"), condition), rule)


# ---------------------------------------------------------------- value combinations of a rule

#: Before the id of a combination; sorts after every record id.
COMBO_MARK = "\U0010ffff"
COMBO = "combo string, match_key string, rule int, values map<string,string>"


def _complete(rule: ExactRule | SimilarRule) -> tuple[list[str], Column]:
    """The prepared columns that a rule compares, and whether a record can match by it at all."""
    if isinstance(rule, ExactRule):
        keys = _exact_keys(rule)
        return keys, reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return [_normal(f.field) for f in rule.fields], _best_score(rule) >= rule.threshold


def record_combos(prepared: DataFrame, rules: MatchRules) -> DataFrame:
    """``record_id, combo, rule, group, values``: what each record is compared by, one row per rule.

    Two records match by a rule, directly or in steps, if they have one combination or combinations
    that match; which ones do depends on the combinations alone, not on the records that have them.
    """
    found = []
    for number, rule in enumerate(rules.rules):
        columns, possible = _complete(rule)
        values = F.map_from_entries(
            F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).alias("v")) for c in columns])
        )
        group = F.to_json(F.array(*[F.col(c).cast("string") for c in _GROUP]))
        rows = prepared.where(possible).select(
            F.col(RECORD_ID).alias("record_id"), group.alias("group"), values.alias("values")
        )
        name = F.concat_ws("|", F.lit(str(number)), "group", F.to_json("values", {"ignoreNullFields": "false"}))
        found.append(
            rows.withColumn("rule", F.lit(number)).withColumn(
                "combo", F.concat(F.lit(COMBO_MARK), F.sha2(name, 256))
            )
        )
    return reduce(DataFrame.unionByName, found)


def combo_keys(combos: DataFrame, rules: MatchRules) -> DataFrame:
    """``combo, match_key, rule, values``: the keys of which matching combinations share one.

    Fields that any match is equal in go into the key; of a word-set field, each word of a prefix in
    a fixed order of hashes, which stays the same while records come and go.
    """
    found = []
    for number, rule in enumerate(rules.rules):
        if isinstance(rule, ExactRule):
            continue
        for turn, approach in enumerate(approaches(rule)):
            rows = combos.where(F.col("rule") == number)
            equal = [F.col("values")[_normal(f)] for f in approach.equal]
            for e in equal:
                rows = rows.where(e.isNotNull())
            word = F.lit("")
            if approach.words is not None:
                words = text.tokens(F.col("values")[_normal(approach.words)])
                order = F.array_sort(F.transform(words, lambda w: F.struct(F.xxhash64(w).alias("h"), w.alias("w"))))
                n = F.size(order)
                keep = F.least(n, n - F.ceil(F.lit(approach.overlap) * n - _EPS).cast("int") + 1)
                rows = rows.withColumn("_word", F.explode(F.slice(order, F.lit(1), keep)))
                word = F.col("_word.w")
            parts = F.to_json(F.array(F.lit(f"{number}.{turn}"), F.col("group"), word, *equal))
            found.append(rows.select("combo", F.sha2(parts, 256).alias("match_key"), "rule", "values"))
    empty = combos.sparkSession.createDataFrame([], COMBO)
    return reduce(DataFrame.unionByName, found, empty)


def combo_profiles(rows: DataFrame, rule: SimilarRule, number: int) -> DataFrame:
    """Those rows of ``combo_keys`` that belong to a rule, with the values it compares; their combination
    as ``profile``."""
    names = [_normal(f.field) for f in rule.fields]
    wide = rows.where(F.col("rule") == number).select("*", *[F.col("values")[n].alias(n) for n in names])
    return wide.drop("values", "rule").withColumnRenamed("combo", "profile")


# ---------------------------------------------------------------- links and decisions


def _decision(
    links: DataFrame, rule_id: str, strategy: str, score: Column, fields: Column, version: str
) -> DataFrame:
    return links.select(
        "record_a_id",
        "record_b_id",
        F.lit(rule_id).alias("rule_id"),
        F.lit(strategy).alias("strategy"),
        F.lit(True).alias("is_match"),
        score.alias("confidence_score"),
        fields.alias("matched_fields"),
        F.lit(version).alias("rule_set_version"),
    )


def _exact_keys(rule: ExactRule) -> list[str]:
    return [_normal(f.field) if f.normalise else _raw(f.field) for f in rule.fields]


def match_links(
    records: DataFrame,
    rules: MatchRules,
    find: Callable[[DataFrame, SimilarRule, bool], tuple[DataFrame, DataFrame]] = similar_pairs,
) -> DataFrame:
    """Positive decisions that connect every two records some rule matches, directly or in steps.

    One row per link: ids, rule, strategy, score, matched fields, version; never field values.
    ``find`` makes the links of a similarity rule: by default all matching pairs of combinations;
    ``connecting.connecting_pairs`` finds fewer that connect the same records.
    """
    prepared = cut_lineage(prepare(records, rules))
    bounded = (
        rules.blocking is not None
        and rules.blocking.max_block_size is not None
        and rules.blocking.max_block_size <= _TILE_ROWS
    )
    found: list[DataFrame] = []
    for rule in rules.rules:
        if isinstance(rule, ExactRule):
            keys = _exact_keys(rule)
            complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
            links = star_links(prepared.where(complete), [*_GROUP, *keys])
            names = F.array(*[F.lit(f.field) for f in rule.fields])
            found.append(
                _decision(links, rule.rule_id, "deterministic", F.lit(1.0), names, rules.version)
            )
            continue
        inside, pairs = find(prepared, rule, bounded)
        # equal combinations score the weights of their usable fields
        values = [F.col(_normal(f.field)) for f in rule.fields]
        usable = [
            v.isNotNull() & (v != "") if f.kind == "token_set" else v.isNotNull()
            for f, v in zip(rule.fields, values)
        ]
        weight = F.lit(0.0)
        for f, ok in zip(rule.fields, usable):
            weight = weight + F.when(ok, float(f.weight)).otherwise(0.0)
        own = prepared.select(
            F.col(RECORD_ID).alias("record_b_id"),
            weight.alias("score"),
            F.array_compact(
                F.array(*[F.when(ok, F.lit(f.field)) for f, ok in zip(rule.fields, usable)])
            ).alias("matched_fields"),
        )
        scored = inside.join(own, "record_b_id").unionByName(pairs)
        found.append(
            _decision(
                scored,
                rule.rule_id,
                "probabilistic",
                text.round_score(F.col("score")),
                F.col("matched_fields"),
                rules.version,
            )
        )
    return reduce(DataFrame.unionByName, found)


def decide(pairs: DataFrame, records: DataFrame, rules: MatchRules) -> DataFrame:
    """Every rule's decision, matched or not, for the given pairs of record ids."""
    normal, raw = _fields(rules)
    slim = records.select(
        RECORD_ID,
        *[text.normalise(F.col(f), rules.ascii_only).alias(_normal(f)) for f in normal],
        *[F.col(f).cast("string").alias(_raw(f)) for f in raw],
    )
    joined = (
        pairs.select("record_a_id", "record_b_id")
        .alias("p")
        .join(slim.alias("a"), F.col("p.record_a_id") == F.col(f"a.{RECORD_ID}"))
        .join(slim.alias("b"), F.col("p.record_b_id") == F.col(f"b.{RECORD_ID}"))
    )
    decisions = []
    for number, rule in enumerate(rules.rules):
        if isinstance(rule, ExactRule):
            score, fields, matched = _exact_decision(rule)
            strategy = "deterministic"
        else:
            joined, parts = _scored(joined, rule, f"_s{number}_")
            total = _total(parts, "a", "b")
            matched, score = total >= rule.threshold, text.round_score(total)
            fields, strategy = _matched(parts, "a", "b"), "probabilistic"
        decisions.append(
            F.struct(
                F.lit(rule.rule_id).alias("rule_id"),
                F.lit(strategy).alias("strategy"),
                matched.alias("is_match"),
                score.alias("confidence_score"),
                fields.alias("matched_fields"),
                F.lit(rules.version).alias("rule_set_version"),
            )
        )
    return joined.select(
        "p.record_a_id", "p.record_b_id", F.explode(F.array(*decisions)).alias("d")
    ).select("record_a_id", "record_b_id", "d.*")


def _exact_decision(rule: ExactRule) -> tuple[Column, Column, Column]:
    """Score, the fields equal before the first that is not, and whether all are."""
    so_far = F.lit(True)
    names = []
    for key, f in zip(_exact_keys(rule), rule.fields):
        so_far = so_far & F.coalesce(F.col(f"a.{key}") == F.col(f"b.{key}"), F.lit(False))
        names.append(F.when(so_far, F.lit(f.field)))
    score = F.when(so_far, 1.0).otherwise(0.0)
    return score, F.array_compact(F.array(*names)), so_far


# ---------------------------------------------------------------- evaluation


def evaluate_matches(decisions: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: TP, FP, FN, TN, precision, recall, F1 and accuracy over the labelled pairs.

    ``labels(record_a_id, record_b_id, is_true_match)``; the order inside a pair does not matter,
    and a labelled pair without a decision counts as no match.
    """

    def ordered(df: DataFrame, *extra: Column) -> DataFrame:
        a, b = F.col("record_a_id"), F.col("record_b_id")
        return df.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y"), *extra)

    predicted = (
        ordered(decisions, F.col("is_match"))
        .groupBy("x", "y")
        .agg(F.bool_or("is_match").alias("predicted"))
    )
    joined = ordered(labels, F.col("is_true_match").alias("truth")).join(predicted, ["x", "y"], "left")
    said = F.coalesce(F.col("predicted"), F.lit(False))
    counts = joined.agg(
        F.count(F.lit(1)).alias("labelled_pairs"),
        F.count_if(said & F.col("truth")).alias("tp"),
        F.count_if(said & ~F.col("truth")).alias("fp"),
        F.count_if(~said & F.col("truth")).alias("fn"),
        F.count_if(~said & ~F.col("truth")).alias("tn"),
    )

    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    rated = counts.withColumns(
        {
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "accuracy": ratio(tp + tn, F.col("labelled_pairs")),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rated.withColumn("f1_score", ratio(F.lit(2.0) * p * r, p + r))

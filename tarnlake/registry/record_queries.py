"""Mapping, masking, quality, merge and reconciliation queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.functions.hashing import row_hash, row_hash_json
from tarnlake.operators import masking, mapping, merge, quality, reconcile
from tarnlake.registry.base import Tables, derived, query

derived(
    "raw_customers",
    """
    SELECT cast(c_custkey AS string) AS id,
           CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS name,
           c_mktsegment AS segment,
           CASE WHEN c_custkey % 11 = 0 THEN NULL
                ELSE cast(cast(c_acctbal AS decimal(18,2)) AS string) END AS balance,
           CASE c_custkey % 4 WHEN 0 THEN 'TRUE' WHEN 1 THEN 'yes' WHEN 2 THEN '0' ELSE 'no' END AS active_flag,
           '20' || lpad(cast(10 + c_custkey % 15 AS string), 2, '0') || '-'
             || lpad(cast(1 + c_custkey % 12 AS string), 2, '0') || '-'
             || lpad(cast(1 + c_custkey % 28 AS string), 2, '0') || 'T10:11:12.'
             || lpad(cast(c_custkey % 1000 AS string), 3, '0') || 'Z' AS created,
           '+1 555 ' || lpad(cast(c_custkey AS string), 7, '0') AS phone,
           'person' || cast(c_custkey AS string) || '@d' || cast(c_nationkey AS string) || '.test' AS email,
           CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE lpad(cast(c_custkey AS string), 9, '0') END AS ssn
    FROM {customer}
    """,
)

_RULES = (
    mapping.MappingRule(("id",), "account_id", "cast", {"type": "integer"}),
    mapping.MappingRule(("name",), "full_name"),
    mapping.MappingRule(("name", "segment"), "label", "concat", {"separator": " / "}),
    mapping.MappingRule(("balance",), "balance", "cast", {"type": "decimal"}),
    mapping.MappingRule(("active_flag",), "is_active", "cast", {"type": "boolean"}),
    mapping.MappingRule(("created",), "created_date", "date_format"),
    mapping.MappingRule(("phone",), "phone_number", "mask"),
    mapping.MappingRule(("absent",), "absent_field"),
)


@query(
    "map_rename_cast_concat_date",
    """
    SELECT cast(id AS bigint) AS account_id, nullif(name, '') AS full_name,
           CASE WHEN name <> '' THEN name || ' / ' || segment END AS label,
           cast(balance AS double) AS balance, lower(active_flag) IN ('true', '1', 'yes') AS is_active,
           substr(created, 1, 10) AS created_date,
           repeat('*', length(phone) - 4) || right(phone, 4) AS phone_number,
           cast(NULL AS string) AS absent_field
    FROM {raw_customers}
    """,
)
def map_rename_cast_concat_date(t: Tables) -> DataFrame:
    return mapping.map_fields(t.raw_customers, _RULES)[0]


@query(
    "map_missing_behaviour",
    """
    SELECT id AS account_id, CASE WHEN name <> '' THEN name ELSE 'unnamed' END AS full_name,
           cast(coalesce(balance, '-1') AS double) AS balance, ssn AS tax_ref
    FROM {raw_customers}
    """,
)
def map_missing_behaviour(t: Tables) -> DataFrame:
    rules = (
        mapping.MappingRule(("id",), "account_id"),
        mapping.MappingRule(("name",), "full_name", on_missing="use_default", default="unnamed"),
        mapping.MappingRule(
            ("balance",), "balance", "cast", {"type": "float"}, on_missing="use_default", default="-1"
        ),
        mapping.MappingRule(("ssn",), "tax_ref"),
    )
    return mapping.map_fields(t.raw_customers, rules)[0]


@query(
    "map_rejects",
    """
    SELECT id, CASE WHEN name IS NULL OR name = '' THEN
                 CASE WHEN balance IS NULL THEN 'full_name,balance' ELSE 'full_name' END
               ELSE 'balance' END AS reject_reason
    FROM {raw_customers} WHERE name IS NULL OR name = '' OR balance IS NULL
    """,
)
def map_rejects(t: Tables) -> DataFrame:
    rules = (
        mapping.MappingRule(("name",), "full_name", on_missing="raise_error"),
        mapping.MappingRule(("balance",), "balance", "cast", {"type": "decimal"}, on_missing="raise_error"),
    )
    return mapping.map_fields(t.raw_customers, rules)[1].select("id", "reject_reason")


@query(
    "map_bad_values",
    """
    SELECT ok, count(*) AS rows, cast(sum(n) AS double) AS total FROM (
      SELECT regexp_matches(raw, '^[0-9]+$') AS ok,
             CASE WHEN regexp_matches(raw, '^[0-9]+$') THEN cast(raw AS bigint) END AS n
      FROM (SELECT CASE WHEN o_orderkey % 8 = 0 THEN cast(o_orderkey AS string) || '.5x'
                        ELSE cast(o_orderkey AS string) END AS raw FROM {orders}) x) y GROUP BY ok
    """,
)
def map_bad_values(t: Tables) -> DataFrame:
    raw = t.sql(
        """SELECT CASE WHEN o_orderkey % 8 = 0 THEN cast(o_orderkey AS string) || '.5x'
                  ELSE cast(o_orderkey AS string) END AS raw FROM {orders}"""
    )
    rules = (mapping.MappingRule(("raw",), "n", "cast", {"type": "integer"}),)
    good, bad = mapping.map_fields(raw, rules, strict=False)
    both = good.select(F.lit(True).alias("ok"), "n").unionByName(
        bad.select(F.lit(False).alias("ok"), F.lit(None).cast("long").alias("n"))
    )
    return both.groupBy("ok").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").cast("double").alias("total")
    )


@query(
    "mask_partial",
    """
    SELECT id, repeat('*', length(phone) - 4) || right(phone, 4) AS phone,
           CASE WHEN length(segment) <= 8 THEN repeat('*', length(segment))
                ELSE repeat('*', length(segment) - 8) || right(segment, 8) END AS segment
    FROM {raw_customers}
    """,
)
def mask_partial(t: Tables) -> DataFrame:
    policy = (masking.FieldMask("phone", "partial_mask"), masking.FieldMask("segment", "partial_mask", 8))
    return masking.apply_masks(t.raw_customers.select("id", "phone", "segment"), policy)


@query("mask_hash", "SELECT id, sha256(email) AS email, sha256(ssn) AS ssn FROM {raw_customers}")
def mask_hash(t: Tables) -> DataFrame:
    policy = (masking.FieldMask("email", "hash"), masking.FieldMask("ssn", "hash"))
    return masking.apply_masks(t.raw_customers.select("id", "email", "ssn"), policy)


_SECRET = b"check-key"
_INNER = bytes(b ^ 0x36 for b in _SECRET.ljust(64, b"\x00")).hex()
_OUTER = bytes(b ^ 0x5C for b in _SECRET.ljust(64, b"\x00")).hex()


@query(
    "mask_token",
    f"""
    SELECT id, 'TOKEN-' || upper(substr(sha256(unhex('{_OUTER}') ||
             unhex(sha256(unhex('{_INNER}') || encode(email)))), 1, 16)) AS email,
           CASE WHEN ssn IS NOT NULL THEN 'REDACTED' END AS ssn
    FROM {{raw_customers}}
    """,
)
def mask_token(t: Tables) -> DataFrame:
    policy = (masking.FieldMask("email", "tokenise"), masking.FieldMask("ssn", "redact"))
    return masking.apply_masks(t.raw_customers.select("id", "email", "ssn"), policy, _SECRET)


@query(
    "mask_auto_policy",
    """
    SELECT id, name, segment, balance, active_flag, created,
           repeat('*', length(phone) - 4) || right(phone, 4) AS phone,
           repeat('*', length(email) - 4) || right(email, 4) AS email,
           CASE WHEN ssn IS NOT NULL THEN '***' END AS ssn
    FROM {raw_customers}
    """,
)
def mask_auto_policy(t: Tables) -> DataFrame:
    raw = t.raw_customers
    return masking.apply_masks(raw, masking.auto_policy(raw.columns))


# ---------------------------------------------------------------- quality

derived(
    "checked_lines",
    """
    SELECT l_orderkey, l_linenumber, l_quantity,
           CASE WHEN l_orderkey % 23 = 0 THEN 'n/a'
                ELSE cast(cast(l_extendedprice AS decimal(18,2)) AS string) END AS price,
           CASE WHEN l_orderkey % 29 = 0 THEN ' ' WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_returnflag END AS flag,
           CASE WHEN l_orderkey % 37 = 0 THEN 'X' ELSE l_linestatus END AS status,
           CASE WHEN l_orderkey % 41 = 0 THEN l_partkey + 100000000 WHEN l_orderkey % 43 = 0 THEN NULL
                ELSE l_partkey END AS part_ref,
           CASE WHEN l_orderkey % 47 = 0 THEN '2999-01-01' WHEN l_orderkey % 53 = 0 THEN '1980-06-30'
                WHEN l_orderkey % 59 = 0 THEN 'soon' ELSE cast(cast(l_shipdate AS date) AS string) END AS shipped
    FROM {lineitem}
    """,
)

_CHECKS = (
    quality.NullCheck("flag", "blocking"),
    quality.RangeCheck("price", "warning", 1000.0, 90000.0),
    quality.PatternCheck("price", r"[0-9]+\.[0-9]{2}$", "warning"),
    quality.AllowedCheck("status", frozenset({"O", "F"}), "blocking"),
)

_VIOLATIONS = """
    SELECT l_orderkey, l_linenumber, 'flag' AS field_name, 'null_check' AS check_kind,
           'blocking' AS severity, 'Field ''flag'' is null or empty' AS detail
    FROM {checked_lines} a WHERE flag IS NULL OR trim(flag) = ''
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'price', 'range_check', 'warning', 'Field ''price'' is not numeric'
    FROM {checked_lines} b WHERE price = 'n/a'
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'price', 'range_check', 'warning',
           'Value ' || cast(cast(price AS double) AS string) || ' < min=1000.0'
    FROM {checked_lines} c WHERE price <> 'n/a' AND try_cast(price AS double) < 1000
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'price', 'range_check', 'warning',
           'Value ' || cast(cast(price AS double) AS string) || ' > max=90000.0'
    FROM {checked_lines} d WHERE price <> 'n/a' AND try_cast(price AS double) > 90000
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'price', 'pattern_check', 'warning',
           'Field ''price'' does not match pattern'
    FROM {checked_lines} e WHERE price = 'n/a'
    UNION ALL
    SELECT l_orderkey, l_linenumber, 'status', 'allowed_values', 'blocking',
           'Field ''status'' value not in allowed set'
    FROM {checked_lines} f WHERE status NOT IN ('O', 'F')
"""


@query("dq_violations", _VIOLATIONS)
def dq_violations(t: Tables) -> DataFrame:
    return quality.record_violations(t.checked_lines, _CHECKS, ["l_orderkey", "l_linenumber"])


@query(
    "dq_record_report",
    """
    SELECT count(*) AS total_records, count_if(NOT w AND NOT b) AS records_passed,
           count_if(w AND NOT b) AS records_with_warnings, count_if(b) AS records_blocked,
           cast(sum(n) AS bigint) AS violations, count_if(b) > 0 AS is_publication_blocked
    FROM (
      SELECT price = 'n/a' OR try_cast(price AS double) < 1000 OR try_cast(price AS double) > 90000 AS w,
             flag IS NULL OR trim(flag) = '' OR status NOT IN ('O', 'F') AS b,
             (CASE WHEN price = 'n/a' THEN 2
                   WHEN try_cast(price AS double) < 1000 OR try_cast(price AS double) > 90000 THEN 1 ELSE 0 END)
             + (CASE WHEN flag IS NULL OR trim(flag) = '' THEN 1 ELSE 0 END)
             + (CASE WHEN status NOT IN ('O', 'F') THEN 1 ELSE 0 END) AS n
      FROM {checked_lines} x) y
    """,
    bigint=("records_passed", "records_with_warnings", "records_blocked"),
)
def dq_record_report(t: Tables) -> DataFrame:
    return quality.record_report(t.checked_lines, _CHECKS)


@query(
    "dq_completeness",
    """
    SELECT 'flag' AS field_name, 100.0 * count_if(flag IS NOT NULL AND flag <> '') / count(*) AS population_rate_pct,
           100.0 * count_if(flag IS NOT NULL AND flag <> '') / count(*) >= 95 AS passed FROM {checked_lines} a
    UNION ALL
    SELECT 'part_ref', 100.0 * count(part_ref) / count(*), 100.0 * count(part_ref) / count(*) >= 95 FROM {checked_lines} b
    """,
)
def dq_completeness(t: Tables) -> DataFrame:
    return quality.completeness(t.checked_lines, ["flag", "part_ref"])


def _batch_policy(t: Tables) -> quality.BatchPolicy:
    return quality.BatchPolicy(
        required=("flag", "part_ref"),
        natural_key=("l_orderkey", "l_linenumber"),
        date_fields=("shipped",),
        foreign_keys=(quality.ForeignKey("part_ref", t.part, "p_partkey"),),
        today=date(2002, 1, 1),
    )


_OUTCOMES = """
    SELECT 'completeness' AS rule_id, least(
             100.0 * count_if(flag IS NOT NULL AND flag <> '') / count(*), 100.0 * count(part_ref) / count(*)
           ) AS measured_value, 95.0 AS threshold, least(
             100.0 * count_if(flag IS NOT NULL AND flag <> '') / count(*), 100.0 * count(part_ref) / count(*)
           ) >= 95 AS passed FROM {checked_lines} a
    UNION ALL
    SELECT 'date-validation', 100.0 * count_if(shipped IN ('2999-01-01', '1980-06-30')) / count(*), 0.5,
           100.0 * count_if(shipped IN ('2999-01-01', '1980-06-30')) / count(*) <= 0.5 FROM {checked_lines} b
    UNION ALL
    SELECT 'duplicate-rate', 100.0 * sum(n - 1) / sum(n), 0.5, 100.0 * sum(n - 1) / sum(n) <= 0.5
    FROM (SELECT count(*) AS n FROM {checked_lines} c GROUP BY l_orderkey, l_linenumber) g
    UNION ALL
    SELECT 'referential-integrity', 100.0 * count_if(o) / count(*), 1.0, 100.0 * count_if(o) / count(*) <= 1
    FROM (SELECT part_ref IS NOT NULL AND part_ref NOT IN (SELECT p_partkey FROM {part}) AS o
          FROM {checked_lines} d) h
"""


@query("dq_batch_checks", _OUTCOMES, double=("threshold",))
def dq_batch_checks(t: Tables) -> DataFrame:
    return quality.batch_checks(t.checked_lines, _batch_policy(t))


@query("dq_duplicate_rate", f"SELECT * FROM ({_OUTCOMES}) o WHERE rule_id = 'duplicate-rate'", double=("threshold",))
def dq_duplicate_rate(t: Tables) -> DataFrame:
    policy = quality.BatchPolicy(natural_key=("l_orderkey", "l_linenumber"))
    return quality.batch_checks(t.checked_lines, policy)


@query(
    "dq_orphan_rate",
    """
    SELECT part_ref AS key, count(*) AS rows FROM {checked_lines} l
    WHERE part_ref IS NOT NULL AND part_ref NOT IN (SELECT p_partkey FROM {part}) GROUP BY part_ref
    """,
)
def dq_orphan_rate(t: Tables) -> DataFrame:
    found = quality.orphans(t.checked_lines, quality.ForeignKey("part_ref", t.part, "p_partkey"))
    return found.select(F.col("key").cast("long").alias("key"), "rows")


@query(
    "dq_date_anomaly",
    """
    SELECT shipped, count(*) AS rows FROM {checked_lines} l WHERE shipped IN ('2999-01-01', '1980-06-30') GROUP BY 1
    """,
)
def dq_date_anomaly(t: Tables) -> DataFrame:
    lines = t.checked_lines.where(quality.date_anomalies(t.checked_lines, ["shipped"], date(2002, 1, 1)) > 0)
    return lines.groupBy("shipped").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "dq_gate",
    f"""
    SELECT count(*) AS checks, string_agg(CASE WHEN NOT passed THEN rule_id END, ',' ORDER BY rule_id) AS failed_rules,
           count_if(NOT passed) > 0 AS blocked FROM ({_OUTCOMES}) o
    """,
)
def dq_gate(t: Tables) -> DataFrame:
    return quality.batch_gate(quality.batch_checks(t.checked_lines, _batch_policy(t)))


@query(
    "dq_gate_verdict",
    f"""
    SELECT count_if(severity = 'blocking') AS blocking_count, count_if(severity = 'warning') AS warning_count,
           count_if(severity = 'blocking') = 0 AS permitted FROM ({_VIOLATIONS}) v
    """,
    bigint=("blocking_count", "warning_count"),
)
def dq_gate_verdict(t: Tables) -> DataFrame:
    found = quality.record_violations(t.checked_lines, _CHECKS, ["l_orderkey"])
    return quality.gate_verdict(found)


@query(
    "dq_batch_exceptions",
    f"""
    SELECT rule_id, CASE rule_id WHEN 'completeness' THEN 'completeness_below_threshold'
             WHEN 'duplicate-rate' THEN 'duplicate_rate_exceeded'
             WHEN 'referential-integrity' THEN 'referential_orphan' ELSE 'date_validation' END AS kind,
           'warn' AS severity, printf('%.2f', measured_value) AS observed_value,
           CASE WHEN rule_id = 'completeness' THEN '>=' ELSE '<=' END || printf('%.2f', cast(threshold AS double)) AS expected_value
    FROM ({_OUTCOMES}) o WHERE NOT passed
    """,
)
def dq_batch_exceptions(t: Tables) -> DataFrame:
    return quality.batch_exceptions(quality.batch_checks(t.checked_lines, _batch_policy(t)))


@query(
    "dq_exception_store",
    f"""
    SELECT 'lineitem' AS entity_id, 'run-1' AS run_id, check_kind AS rule_id, 'quality_violation' AS kind,
           CASE severity WHEN 'blocking' THEN 'error' ELSE 'warn' END AS severity, detail AS message,
           field_name AS key_field_name,
           CASE WHEN length(k) <= 4 THEN repeat('*', length(k))
                ELSE substr(k, 1, 2) || repeat('*', length(k) - 4) || right(k, 2) END AS sample_key
    FROM (SELECT *, cast(l_orderkey AS string) || '|' || cast(l_linenumber AS string) AS k FROM ({_VIOLATIONS}) v) x
    """,
)
def dq_exception_store(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    found = quality.record_violations(t.checked_lines, _CHECKS, keys)
    return quality.exception_rows(found, {"entity_id": "lineitem", "run_id": "run-1"}, keys)


# ---------------------------------------------------------------- merge

derived(
    "order_state",
    """
    SELECT cast(o_orderkey AS string) AS id, o_custkey AS customer, o_totalprice AS amount,
           o_orderstatus AS status, 0 AS revision, 'no' AS is_delete
    FROM {orders} WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'
    """,
)
derived(
    "order_delta",
    """
    SELECT CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN ''
                ELSE cast(o_orderkey AS string) END AS id,
           o_custkey AS customer, o_totalprice + 1 AS amount, o_orderstatus AS status, 1 AS revision,
           CASE WHEN o_orderkey % 11 = 0 THEN 'Yes' ELSE 'no' END AS is_delete
    FROM {orders} WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00' OR o_orderkey % 7 = 0
    UNION ALL
    SELECT cast(o_orderkey AS string), o_custkey, o_totalprice + 2, 'U', 2, 'no'
    FROM {orders} WHERE o_orderkey % 14 = 0
    """,
)
_LATEST = """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY revision DESC) AS rn
                   FROM {order_delta} d WHERE id <> '') r WHERE rn = 1
"""
_MERGED = f"""
    SELECT id, customer, amount, status, revision, is_delete FROM {{order_state}} p
    WHERE id NOT IN (SELECT id FROM ({_LATEST}) l1)
    UNION ALL
    SELECT id, customer, amount, status, revision, is_delete FROM ({_LATEST}) l2 WHERE is_delete <> 'Yes'
"""
_ALL_MERGED = f"""
    SELECT id, customer, amount, status, revision, is_delete FROM {{order_state}} p
    WHERE id NOT IN (SELECT id FROM ({_LATEST}) l1)
    UNION ALL
    SELECT id, customer, amount, status, revision, is_delete FROM ({_LATEST}) l2
"""


@query("scd1_merge", _ALL_MERGED)
def scd1_merge(t: Tables) -> DataFrame:
    return merge.merge_current(t.order_state, t.order_delta, ["id"], ["revision"])


@query("scd1_soft_delete", _MERGED)
def scd1_soft_delete(t: Tables) -> DataFrame:
    return merge.merge_current(t.order_state, t.order_delta, ["id"], ["revision"], "is_delete")


@query(
    "scd1_first_run",
    f"SELECT id, customer, amount, status, revision, is_delete FROM ({_LATEST}) l WHERE is_delete <> 'Yes'",
)
def scd1_first_run(t: Tables) -> DataFrame:
    return merge.merge_current(None, t.order_delta, ["id"], ["revision"], "is_delete")


@query(
    "scd1_counts",
    f"""
    SELECT (SELECT count(*) FROM {{order_delta}} a) AS delta_rows,
           (SELECT count(*) FROM {{order_delta}} b WHERE id IS NULL OR id = '') AS rows_without_key,
           (SELECT count(*) FROM ({_LATEST}) l WHERE is_delete = 'Yes') AS deleted_keys,
           (SELECT count(*) FROM ({_MERGED}) m) AS merged_rows
    """,
)
def scd1_counts(t: Tables) -> DataFrame:
    merged = merge.merge_current(t.order_state, t.order_delta, ["id"], ["revision"], "is_delete")
    return merge.merge_counts(t.order_delta, merged, ["id"], ["revision"], "is_delete")


@query("latest_per_key", f"SELECT id, customer, amount, status, revision, is_delete FROM ({_LATEST}) l")
def latest_per_key(t: Tables) -> DataFrame:
    delta = t.order_delta
    return merge.latest_per_key(delta.where(merge.has_key(["id"])), ["id"], ["revision"])


derived(
    "part_target",
    """
    SELECT p_partkey, p_name, CASE WHEN p_partkey % 19 = 0 THEN p_size + 1 ELSE p_size END AS p_size,
           CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_brand END AS p_brand
    FROM {part} WHERE p_partkey % 17 <> 0
    """,
)


@query(
    "row_hash_changes",
    """
    SELECT s.p_partkey, s.p_name, s.p_size, s.p_brand,
           sha256(concat_ws(chr(1), cast(s.p_partkey AS string), s.p_name, cast(s.p_size AS string), s.p_brand)) AS _row_hash
    FROM {part} s LEFT JOIN {part_target} t ON s.p_partkey = t.p_partkey
    WHERE t.p_partkey IS NULL OR s.p_size <> t.p_size OR t.p_brand IS NULL
    """,
)
def row_hash_changes(t: Tables) -> DataFrame:
    columns = ["p_partkey", "p_name", "p_size", "p_brand"]
    return merge.changed_rows(t.part.select(*columns), t.part_target, ["p_partkey"], columns)


@query(
    "row_hash_counts",
    """
    SELECT count_if(c) AS loaded, count_if(NOT c) AS skipped FROM (
      SELECT t.p_partkey IS NULL OR s.p_size <> t.p_size OR t.p_brand IS NULL AS c
      FROM {part} s LEFT JOIN {part_target} t ON s.p_partkey = t.p_partkey) x
    """,
    bigint=("loaded", "skipped"),
)
def row_hash_counts(t: Tables) -> DataFrame:
    columns = ["p_partkey", "p_name", "p_size", "p_brand"]
    incoming = t.part.select(*columns)
    return merge.change_counts(incoming, merge.changed_rows(incoming, t.part_target, ["p_partkey"], columns))


@query(
    "row_hash_json",
    """
    SELECT p_partkey, sha256('[' || '"' || cast(p_partkey AS string) || '","' || p_name || '",'
           || coalesce('"' || p_brand || '"', 'null') || ']') AS content_hash FROM {part_target}
    """,
)
def row_hash_json_query(t: Tables) -> DataFrame:
    return t.part_target.select(
        "p_partkey", row_hash_json(["p_partkey", "p_name", "p_brand"]).alias("content_hash")
    )


@query(
    "upsert_purge",
    """
    SELECT p_partkey, p_name, p_size FROM (
      SELECT p_partkey, p_name, p_size FROM {part_target} a WHERE p_partkey % 5 <> 0
      UNION ALL SELECT p_partkey, p_name, p_size FROM {part} b WHERE p_partkey % 5 = 0) u WHERE p_size <> 7
    """,
)
def upsert_purge(t: Tables) -> DataFrame:
    staged = t.part.where(F.col("p_partkey") % 5 == 0).withColumn("gone", F.col("p_size") == 7)
    target = t.part_target.withColumn("gone", F.col("p_size") == 7)
    columns = ["p_partkey", "p_name", "p_size", "gone"]
    result = merge.upsert(target.select(*columns), staged.select(*columns), ["p_partkey"], "gone")
    return result.drop("gone")


@query(
    "merge_verify",
    f"""
    SELECT count(*) AS merged_rows, count(DISTINCT id) AS distinct_keys,
           count(*) = count(DISTINCT id) AS verified FROM ({_MERGED}) m
    """,
)
def merge_verify(t: Tables) -> DataFrame:
    merged = merge.merge_current(t.order_state, t.order_delta, ["id"], ["revision"], "is_delete")
    return merge.verify_merge(merged, ["id"])


# ---------------------------------------------------------------- reconciliation

derived(
    "orders_copy",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority,
           CASE WHEN o_orderkey % 3 = 0 THEN ' ' || o_orderstatus || ' ' WHEN o_orderkey % 50 = 0 THEN 'Z'
                ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderkey % 97 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
    FROM {orders} WHERE o_orderkey % 1999 <> 0
    """,
)
_COUNTS = """
    SELECT 'count' AS comparator, 'rows' AS measure, cast(e AS string) AS expected, cast(o AS string) AS observed,
           cast(abs(o - e) AS double) / e * 100 AS variance_pct, 0.1 AS tolerance_pct,
           CASE WHEN o = e THEN 'matched' WHEN cast(abs(o - e) AS double) / e * 100 <= 0.1 THEN 'within_tolerance'
                ELSE 'variance' END AS verdict, '' AS detail
    FROM (SELECT (SELECT count(*) FROM {orders}) AS e, (SELECT count(*) FROM {orders_copy} c) AS o) x
"""
_MONEY = """
    SELECT 'monetary_sum' AS comparator, 'o_totalprice' AS measure, cast(e AS string) AS expected,
           cast(o AS string) AS observed,
           abs(cast(o AS double) - cast(e AS double)) / abs(cast(e AS double)) * 100 AS variance_pct,
           0.0 AS tolerance_pct, CASE WHEN o = e THEN 'matched' ELSE 'variance' END AS verdict,
           'difference=' || cast(o - e AS string) AS detail
    FROM (SELECT (SELECT sum(cast(o_totalprice AS decimal(18,2))) FROM {orders}) AS e,
                 (SELECT sum(cast(o_totalprice AS decimal(18,2))) FROM {orders_copy} c) AS o) x
"""
_BOUNDS = """
    SELECT 'watermark_bounds' AS comparator, 'o_orderkey' AS measure, e AS expected, o AS observed,
           CASE WHEN e = o THEN 0.0 ELSE 100.0 END AS variance_pct, 0.0 AS tolerance_pct,
           CASE WHEN e = o THEN 'matched' ELSE 'variance' END AS verdict, '' AS detail
    FROM (SELECT (SELECT cast(min(o_orderkey) AS string) || '..' || cast(max(o_orderkey) AS string) FROM {orders}) AS e,
                 (SELECT cast(min(o_orderkey) AS string) || '..' || cast(max(o_orderkey) AS string)
                  FROM {orders_copy} c) AS o) x
"""


@query("recon_count", _COUNTS, double=("tolerance_pct",))
def recon_count(t: Tables) -> DataFrame:
    return reconcile.compare_counts(t.orders, t.orders_copy)


@query("recon_money", _MONEY, double=("tolerance_pct",))
def recon_money(t: Tables) -> DataFrame:
    return reconcile.compare_money(t.orders, t.orders_copy, "o_totalprice")


@query("recon_bounds", _BOUNDS, double=("variance_pct", "tolerance_pct"))
def recon_bounds(t: Tables) -> DataFrame:
    return reconcile.compare_bounds(t.orders, t.orders_copy, "o_orderkey")


@query(
    "recon_report",
    f"""
    SELECT 'orders' AS entity_id, '2001-08' AS period, 'v1' AS rule_version, 'run-1' AS run_id, 'demo' AS tenant_code,
           3 AS comparisons, count_if(verdict = 'variance') AS findings, max(variance_pct) AS worst_variance_pct,
           count_if(verdict = 'variance') = 0 AS matched,
           sha256('{{"comparisons":[' || string_agg('{{"comparator":"' || comparator || '","expected":"' || expected
             || '","measure":"' || measure || '","observed":"' || observed || '","verdict":"' || verdict || '"}}', ','
             ORDER BY p) || '],"entity_id":"orders","period":"2001-08","rule_version":"v1","run_id":"run-1",'
             || '"tenant_code":"demo"}}') AS signature
    FROM (SELECT 0 AS p, * FROM ({_COUNTS}) a UNION ALL SELECT 1, * FROM ({_MONEY}) b
          UNION ALL SELECT 2, * FROM ({_BOUNDS}) c) x
    """,
    bigint=("findings",),
)
def recon_report(t: Tables) -> DataFrame:
    header = {
        "tenant_code": "demo", "entity_id": "orders", "period": "2001-08", "run_id": "run-1", "rule_version": "v1",
    }
    rows = reconcile.reconciliation([recon_count(t), recon_money(t), recon_bounds(t)])
    return reconcile.report(rows, header)


_SAMPLED = "cast('0x' || substr(sha256(cast(o_orderkey AS string)), 1, 8) AS bigint) % 10 = 0"


@query("hash_sample", f"SELECT o_orderkey FROM {{orders}} WHERE {_SAMPLED}")
def hash_sample(t: Tables) -> DataFrame:
    return reconcile.hash_sample(t.orders.select("o_orderkey"), "o_orderkey", 10)


@query(
    "recon_sampled_fields",
    f"""
    WITH j AS (SELECT s.o_orderstatus = trim(c.o_orderstatus) AS a, s.o_totalprice = c.o_totalprice AS b
      FROM (SELECT * FROM {{orders}} WHERE {_SAMPLED}) s JOIN {{orders_copy}} c ON s.o_orderkey = c.o_orderkey)
    SELECT 'o_orderstatus' AS field_name, count(*) AS compared, count_if(a) AS matched,
           100.0 * count_if(a) / count(*) AS match_rate_pct FROM j
    UNION ALL SELECT 'o_totalprice', count(*), count_if(b), 100.0 * count_if(b) / count(*) FROM j
    """,
    bigint=("matched",),
)
def recon_sampled_fields(t: Tables) -> DataFrame:
    fields = ["o_orderstatus", "o_totalprice"]
    source = reconcile.hash_sample(t.orders, "o_orderkey", 10)
    target = reconcile.hash_sample(t.orders_copy, "o_orderkey", 10)
    return reconcile.compare_fields(source, target, "o_orderkey", fields)

"""Entity resolution queries over three derived sources of the same people."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnlake.operators import clusters, connecting, matching, survivorship
from tarnlake.operators.matching import (
    RECORD_ID,
    Blocking,
    ExactField,
    ExactRule,
    MatchRules,
    SimilarField,
    SimilarRule,
)
from tarnlake.plans import increments, jobs
from tarnlake.registry.base import Tables, derived, query
from tarnlake.session import cut_lineage, work_path
from tarnlake.sources import bucketed

derived(
    "people",
    """
    SELECT c_custkey, c_mktsegment AS segment, c_acctbal AS balance,
           'unit-' || cast(c_nationkey AS string) AS scope_unit_id,
           substr(md5(cast(c_custkey AS string)), 1, 8) || ' ' || substr(md5(cast(c_custkey AS string)), 9, 6)
             || ' ' || lower(c_mktsegment) AS full_name,
           'p' || cast(c_custkey AS string) || '@d' || cast(c_nationkey AS string) || '.test' AS email
    FROM {customer}
    """,
)
derived(
    "crm_people",
    """
    SELECT cast(c_custkey AS string) AS pk, full_name,
           CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE email END AS email_address, segment, balance, scope_unit_id,
           '2024-01-' || lpad(cast(1 + c_custkey % 28 AS string), 2, '0') || 'T10:00:00Z' AS last_modified,
           cast(c_custkey AS string) || '-555-' || lpad(cast(c_custkey % 10000 AS string), 4, '0') AS phone
    FROM {people}
    """,
)
derived(
    "erp_people",
    """
    SELECT cast(c_custkey + 500000000 AS string) AS pk,
           upper(CASE WHEN c_custkey % 5 = 0 THEN substr(full_name, 1, 2) || substr(full_name, 4) ELSE full_name END) AS full_name,
           CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE email END AS email_address, segment,
           CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE balance + 1 END AS balance, scope_unit_id,
           '2024-01-' || lpad(cast(1 + c_custkey % 25 AS string), 2, '0') || 'T10:00:00.123Z' AS last_modified,
           cast(NULL AS string) AS phone
    FROM {people} WHERE c_custkey % 2 = 0
    """,
)
derived(
    "web_people",
    """
    SELECT cast(c_custkey + 700000000 AS string) AS pk,
           CASE WHEN c_custkey % 4 = 0 THEN substr(full_name, 10) || '  ' || substr(full_name, 1, 8)
                WHEN c_custkey % 5 = 1 THEN replace(full_name, 'a', 'á') ELSE full_name END AS full_name,
           CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 2 = 1 THEN upper(email) ELSE email END AS email_address,
           segment, balance + 2 AS balance, scope_unit_id,
           CASE WHEN c_custkey % 6 = 0 THEN 'n/a'
                ELSE '2024-01-' || lpad(cast(1 + c_custkey % 20 AS string), 2, '0') END AS last_modified,
           '(' || cast(c_custkey AS string) || ') 1' AS phone
    FROM {people} WHERE c_custkey % 3 = 0
    """,
)
_COLUMNS = "pk, full_name, email_address, segment, balance, scope_unit_id, last_modified, phone"
derived(
    "all_people",
    f"""
    SELECT 'crm:' || pk AS _record_id, 'crm' AS _source_id, {_COLUMNS} FROM {{crm_people}} a
    UNION ALL SELECT 'erp:' || pk, 'erp', {_COLUMNS} FROM {{erp_people}} b
    UNION ALL SELECT 'web:' || pk, 'web', {_COLUMNS} FROM {{web_people}} c
    """,
)


def _records(t: Tables) -> DataFrame:
    return matching.union_sources(
        {"crm": t.crm_people, "erp": t.erp_people, "web": t.web_people, "absent": None}, "pk"
    )


EMAIL_RULE = ExactRule("email-exact", (ExactField("email_address"),))
NAME_RULE = SimilarRule(
    "name-segment-fuzzy",
    (SimilarField("full_name", 0.65, "jaro_winkler"), SimilarField("segment", 0.35)),
    0.88,
)
WORD_RULE = SimilarRule(
    "name-words", (SimilarField("full_name", 0.7, "token_set"), SimilarField("segment", 0.3)), 0.85
)
BY_DOMAIN = Blocking("email_domain", "email_address")


def people_rules(*rules, blocking: Blocking | None = BY_DOMAIN, within_unit: bool = False) -> MatchRules:
    return MatchRules("person", "v1", tuple(rules), blocking, within_unit)


_NAME = r"lower(trim(regexp_replace(strip_accents(full_name), '\s+', ' ', 'g')))"
_DOMAIN = """CASE WHEN email_address IS NULL THEN '__unknown__'
                  ELSE lower(split_part(trim(email_address), '@', 2)) END"""
_VIEW = f"""
    SELECT _record_id AS id, {_DOMAIN} AS block, {_NAME} AS nm, lower(segment) AS sg,
           lower(trim(email_address)) AS em, scope_unit_id AS unit FROM {{all_people}} v
"""


@query("er_tagged_union", "SELECT * FROM {all_people} x")
def er_tagged_union(t: Tables) -> DataFrame:
    return _records(t)


@query(
    "er_blocks",
    rf"""
    SELECT key_type, block, count(*) AS records FROM (
      SELECT 'email_domain' AS key_type, {_DOMAIN} AS block FROM {{all_people}} a
      UNION ALL
      SELECT 'phone_normalized', CASE WHEN phone IS NULL THEN '__unknown__'
               ELSE substr(regexp_replace(phone, '[^0-9]', '', 'g'), 1, 7) END FROM {{all_people}} b
      UNION ALL
      SELECT 'name_first3', nfc_normalize(CASE WHEN letters = '' THEN '__empty__' ELSE substr(letters, 1, 3) END)
      FROM (SELECT regexp_replace(strip_accents(lower(trim(full_name))), '[^a-z]', '', 'g') AS letters FROM {{all_people}} c) d
      UNION ALL
      SELECT 'record_id_prefix', substr(_record_id, 1, 8) FROM {{all_people}} e) x
    GROUP BY ALL
    """,
)
def er_blocks(t: Tables) -> DataFrame:
    records = _records(t)
    fields = {
        "email_domain": "email_address", "phone_normalized": "phone",
        "name_first3": "full_name", "record_id_prefix": RECORD_ID,
    }
    keyed = [
        records.select(
            F.lit(kind).alias("key_type"),
            matching.block_column(people_rules(blocking=Blocking(kind, name))).alias("block"),
        )
        for kind, name in fields.items()
    ]
    union = reduce(DataFrame.unionByName, keyed)
    return union.groupBy("key_type", "block").agg(F.count(F.lit(1)).alias("records"))


@query(
    "er_unit_blocks",
    f"SELECT unit || '::' || block AS block, count(*) AS records FROM ({_VIEW}) v GROUP BY 1",
)
def er_unit_blocks(t: Tables) -> DataFrame:
    rules = people_rules(within_unit=True)
    return (
        _records(t)
        .groupBy(matching.block_column(rules).alias("block"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    "er_block_chunks",
    f"""
    SELECT block, chunk AS _chunk, count(*) AS records, min(id) AS first_id FROM (
      SELECT block, id, CASE WHEN n <= 40 THEN 0 ELSE (rn - 1) // 40 END AS chunk FROM (
        SELECT block, id, count(*) OVER (PARTITION BY block) AS n,
               row_number() OVER (PARTITION BY block ORDER BY md5(id), id) AS rn FROM ({_VIEW}) v) x) y GROUP BY ALL
    """,
)
def er_block_chunks(t: Tables) -> DataFrame:
    rules = people_rules(EMAIL_RULE, blocking=Blocking("email_domain", "email_address", 40))
    return (
        matching.prepare(_records(t), rules)
        .groupBy(F.col("_block").alias("block"), "_chunk")
        .agg(F.count(F.lit(1)).alias("records"), F.min(RECORD_ID).alias("first_id"))
    )


_EMAIL_LINKS = f"""
    SELECT hub AS record_a_id, id AS record_b_id, 'email-exact' AS rule_id, 1.0 AS confidence_score
    FROM (SELECT id, min(id) OVER (PARTITION BY block, em) AS hub FROM ({_VIEW}) v WHERE em IS NOT NULL) x
    WHERE hub <> id
"""


@query("er_links_exact", _EMAIL_LINKS, double=("confidence_score",))
def er_links_exact(t: Tables) -> DataFrame:
    links = matching.match_links(_records(t), people_rules(EMAIL_RULE))
    return links.select("record_a_id", "record_b_id", "rule_id", "confidence_score")


_JW = """(j + 0.1 * (CASE WHEN substr(x, 1, 4) = substr(y, 1, 4) AND least(length(x), length(y)) >= 4 THEN 4
                         WHEN substr(x, 1, 3) = substr(y, 1, 3) THEN 3 WHEN substr(x, 1, 2) = substr(y, 1, 2) THEN 2
                         WHEN substr(x, 1, 1) = substr(y, 1, 1) THEN 1 ELSE 0 END) * (1 - j))"""


def _with_jaro(pairs: str) -> str:
    """Check SQL: adds ``j``, the Jaro similarity of ``x`` and ``y``, to a pair query.

    The built-in function halves an odd number of transpositions downwards; this does not. The
    text is folded character by character; a matched character of ``y`` becomes ``chr(2)``.
    """
    i, ch = "cast(substr(e, 1, 4) AS integer)", "substr(e, 5, 1)"
    left_over, taken = "split_part(acc, chr(1), 1)", "split_part(acc, chr(1), 2)"
    reach = "(greatest(length(x), length(y)) // 2 - 1)"
    start = f"greatest(1, {i} - {reach})"
    window = f"substr({left_over}, {start}, greatest(least(length(y), {i} + {reach}) - {start} + 1, 0))"
    at = f"({start} + instr({window}, {ch}) - 1)"
    step = f"""CASE WHEN instr({window}, {ch}) > 0 THEN substr({left_over}, 1, {at} - 1) || chr(2)
                 || substr({left_over}, {at} + 1) || chr(1) || {taken} || {ch} ELSE acc END"""
    return f"""
    SELECT *, CASE WHEN x = y THEN 1.0 WHEN length(l) = 0 THEN 0.0 ELSE
        (length(l) / length(x) + length(l) / length(y) + (length(l)
          - len(list_filter(range(1, length(l) + 1), lambda k: substr(l, k, 1) <> substr(r, k, 1))) / 2) / length(l)) / 3
        END AS j FROM (
      SELECT *, split_part(acc, chr(1), 2) AS l, array_to_string(list_transform(range(1, length(y) + 1),
        lambda k: CASE WHEN substr(acc, k, 1) = chr(2) THEN substr(y, k, 1) ELSE '' END), '') AS r FROM (
        SELECT *, list_reduce(list_transform(range(1, length(x) + 1),
          lambda k: lpad(cast(k AS varchar), 4, '0') || substr(x, k, 1)), lambda acc, e: {step}, y || chr(1)) AS acc
        FROM ({pairs}) pairs) f) h
    """


def _name_links(group: str = "block", where: str = "true") -> str:
    profiles = f"SELECT {group} AS g, nm, sg, min(id) AS profile FROM ({_VIEW}) v WHERE {where} GROUP BY ALL"
    pairs = _with_jaro(
        f"""SELECT a.profile AS record_a_id, b.profile AS record_b_id, a.nm AS x, b.nm AS y
            FROM ({profiles}) a JOIN ({profiles}) b ON a.g = b.g AND a.sg = b.sg AND a.profile < b.profile"""
    )
    return f"""
    SELECT record_a_id, record_b_id, 'name-segment-fuzzy' AS rule_id, cast(printf('%.4f', s) AS double) AS confidence_score FROM (
      SELECT record_a_id, record_b_id, {_JW} * 0.65 + 0.35 AS s FROM ({pairs}) p) q
    WHERE s >= 0.88
    UNION ALL
    SELECT hub, id, 'name-segment-fuzzy', 1.0 FROM (
      SELECT id, min(id) OVER (PARTITION BY {group}, nm, sg) AS hub FROM ({_VIEW}) v WHERE {where}) x WHERE hub <> id
    """


@query("er_jaro_winkler", _name_links())
def er_jaro_winkler(t: Tables) -> DataFrame:
    links = matching.match_links(_records(t), people_rules(NAME_RULE))
    return links.select("record_a_id", "record_b_id", "rule_id", "confidence_score")


_WORDS = r"list_distinct(list_filter(string_split(nm, ' '), lambda w: w <> ''))"


@query(
    "er_token_set",
    f"""
    WITH p AS (SELECT nm, sg, min(id) AS profile, {_WORDS} AS w FROM ({_VIEW}) v GROUP BY nm, sg)
    SELECT record_a_id, record_b_id, cast(printf('%.4f', s) AS double) AS confidence_score FROM (
      SELECT a.profile AS record_a_id, b.profile AS record_b_id,
             len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))) * 0.7 + 0.3 AS s
      FROM p a JOIN p b ON a.sg = b.sg AND a.profile < b.profile) x WHERE s >= 0.85
    UNION ALL
    SELECT hub, id, 1.0 FROM (SELECT id, min(id) OVER (PARTITION BY nm, sg) AS hub FROM ({_VIEW}) v) y WHERE hub <> id
    """,
)
def er_token_set(t: Tables) -> DataFrame:
    links = matching.match_links(_records(t), people_rules(WORD_RULE, blocking=None))
    return links.select("record_a_id", "record_b_id", "confidence_score")


_LINKS = f"SELECT record_a_id AS a, record_b_id AS b FROM ({_EMAIL_LINKS}) e UNION SELECT record_a_id, record_b_id FROM ({_name_links()}) n"


def _clusters_sql(links: str = _LINKS) -> str:
    return f"""
    WITH RECURSIVE links AS MATERIALIZED ({links}),
      edge AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
      reach AS (SELECT _record_id AS id, _record_id AS root FROM {{all_people}} n
                UNION SELECT r.id, e.b FROM reach r JOIN edge e ON r.root = e.a)
    SELECT id AS _record_id, min(root) AS cluster FROM reach GROUP BY id
    """


def _person_rules() -> MatchRules:
    return people_rules(EMAIL_RULE, NAME_RULE)


def _membership(t: Tables) -> DataFrame:
    return connecting.clustered_records(_records(t), _person_rules())


@query("er_clusters", _clusters_sql())
def er_clusters(t: Tables) -> DataFrame:
    return _membership(t)


_UNIT_LINKS = _name_links("unit || '::' || block")


@query(
    "er_clusters_within_unit",
    _clusters_sql(f"SELECT record_a_id AS a, record_b_id AS b FROM ({_UNIT_LINKS}) n"),
)
def er_clusters_within_unit(t: Tables) -> DataFrame:
    return connecting.clustered_records(_records(t), people_rules(NAME_RULE, within_unit=True))


_GID = "'gid-' || substr(sha256('_source_id:person:' || string_agg(_record_id, '|' ORDER BY _record_id)), 1, 16)"


@query(
    "er_golden_ids",
    f"""
    SELECT {_GID} AS golden_id, count(*) AS member_count, string_agg(_record_id, '|' ORDER BY _record_id) AS members
    FROM ({_clusters_sql()}) c GROUP BY cluster
    """,
)
def er_golden_ids(t: Tables) -> DataFrame:
    """Golden ids with the records of each, from two tables bucketed by the id."""
    membership = cut_lineage(_membership(t))
    ids = cut_lineage(clusters.golden_ids(membership, "person"))
    path = work_path(t.spark, "golden")
    named = membership.join(ids.select("cluster", "golden_id"), "cluster")
    bucketed.publish_members(ids.select("golden_id", "member_count"), named, path, "run-1", 16)
    golden = bucketed.golden_with_members(t.spark, path, "run-1")
    return golden.select("golden_id", "member_count", F.array_join(bucketed.MEMBERS, "|").alias("members"))


POLICY = survivorship.Survivorship(
    "person",
    "v1",
    (
        survivorship.FieldRule("full_name", "source_priority", ("erp", "web")),
        survivorship.FieldRule("email_address", "longest"),
        survivorship.FieldRule("last_modified", "most_recent", timestamp="last_modified"),
        survivorship.FieldRule("phone", "first_non_null", ("web", "crm")),
    ),
    output_fields=("full_name", "email_address", "last_modified", "phone", "balance", "segment"),
    source_order=("crm", "erp", "web"),
)

_ORD = "CASE _source_id WHEN 'crm' THEN 1 WHEN 'erp' THEN 2 ELSE 3 END, _record_id"
_TS = """coalesce(try_strptime(last_modified, '%Y-%m-%dT%H:%M:%S.%fZ'), try_strptime(last_modified, '%Y-%m-%dT%H:%M:%SZ'),
                  try_strptime(last_modified, '%Y-%m-%d'))"""
_PICK = {
    "full_name": f"CASE _source_id WHEN 'erp' THEN 1 WHEN 'web' THEN 2 ELSE 3 END, {_ORD}",
    "email_address": f"length(email_address) DESC, {_ORD}",
    "last_modified": f"{_TS} DESC NULLS LAST, {_ORD}",
    "phone": f"CASE _source_id WHEN 'web' THEN 1 WHEN 'crm' THEN 2 ELSE 3 END, {_ORD}",
    "balance": _ORD,
    "segment": _ORD,
    "scope_unit_id": _ORD,
}
_STRATEGY = {"full_name": "source_priority", "email_address": "longest", "last_modified": "most_recent"}
_CLUSTERED = f"SELECT p.*, c.cluster FROM {{all_people}} p JOIN ({_clusters_sql()}) c USING (_record_id)"
_FIRSTS = ", ".join(
    f"first({f} ORDER BY {order}) FILTER ({f} IS NOT NULL) AS {f}" for f, order in _PICK.items()
)


def _resolved(t: Tables) -> jobs.Resolution:
    return jobs.resolve_entities(_records(t), _person_rules(), POLICY, "run-1")


_GOLDEN = f"""
    SELECT golden_id, n AS contributing_record_count, full_name, email_address, last_modified, phone, balance, segment,
           scope_unit_id FROM (
      SELECT cluster, {_GID} AS golden_id, count(*) AS n, {_FIRSTS} FROM ({_CLUSTERED}) k GROUP BY cluster) g
    """


@query("er_golden", _GOLDEN)
def er_golden(t: Tables) -> DataFrame:
    return _resolved(t).golden.drop(
        "survivorship_version", "match_run_id", "field_provenance"
    )


@query("er_incremental", _GOLDEN)
def er_incremental(t: Tables) -> DataFrame:
    """The golden records of all sources after two increments: one with records that are wrong, early
    or not to stay, and one that mends, adds and removes them."""
    records, key = _records(t), F.crc32(RECORD_ID) % 10
    store = increments.ResolutionStore(t.spark, work_path(t.spark, "resolution"), _person_rules(), POLICY, 256 << 10)
    mistaken = records.where(key < 8).withColumn(
        "full_name", F.when(key == 0, F.reverse("full_name")).otherwise(F.col("full_name"))
    ).withColumn("email_address", F.when(key == 1, F.lit("shared@d1.test")).otherwise(F.col("email_address")))
    extra = records.where(key == 9).withColumn(RECORD_ID, F.concat(F.lit("old:"), RECORD_ID))
    increments.apply_increment(store, mistaken.unionByName(extra), "run-1")
    mended = records.where(key.isin(0, 1, 8, 9))
    increments.apply_increment(store, mended, "run-2", extra.select(RECORD_ID))
    return store.golden().select(
        "golden_id", "contributing_record_count", "full_name", "email_address", "last_modified", "phone",
        "balance", "segment", "scope_unit_id",
    )


@query(
    "er_conflicts",
    f"""
    WITH k AS MATERIALIZED (SELECT cluster, _record_id, _source_id, full_name, email_address, last_modified, phone, balance,
                                   segment, scope_unit_id FROM ({_CLUSTERED}) z),
         g AS (SELECT cluster, {_GID} AS golden_id FROM k GROUP BY cluster)
    SELECT golden_id, canonical_field, winning_source_id, winning_record_id, strategy_applied, candidate_source_count
    FROM g JOIN (
    """
    + " UNION ALL ".join(
        f"""SELECT cluster, '{f}' AS canonical_field, first(_source_id ORDER BY {order}) AS winning_source_id,
                   first(_record_id ORDER BY {order}) AS winning_record_id,
                   '{_STRATEGY.get(f, 'first_non_null')}' AS strategy_applied, count(*) AS candidate_source_count
            FROM k WHERE {f} IS NOT NULL GROUP BY cluster HAVING count(*) > 1"""
        for f, order in _PICK.items()
    )
    + ") u USING (cluster)",
)
def er_conflicts(t: Tables) -> DataFrame:
    return _resolved(t).conflicts


@query(
    "er_provenance",
    f"""
    SELECT cluster_size, provenance, count(*) AS clusters FROM (
      SELECT cluster, count(*) AS cluster_size,
             first(_source_id ORDER BY {_PICK['full_name']}) FILTER (full_name IS NOT NULL) || '/' ||
             coalesce(first(_source_id ORDER BY {_PICK['email_address']}) FILTER (email_address IS NOT NULL), '-') AS provenance
      FROM ({_CLUSTERED}) k GROUP BY cluster) x GROUP BY ALL
    """,
)
def er_provenance(t: Tables) -> DataFrame:
    golden = _resolved(t).golden
    source = F.col("field_provenance")
    label = F.concat(source["full_name"], F.lit("/"), F.coalesce(F.try_element_at(source, F.lit("email_address")), F.lit("-")))
    return golden.groupBy(
        F.col("contributing_record_count").alias("cluster_size"), label.alias("provenance")
    ).agg(F.count(F.lit(1)).alias("clusters"))


derived(
    "people_labels",
    """
    SELECT 'erp:' || cast(c_custkey + 500000000 AS string) AS record_a_id, 'crm:' || cast(c_custkey AS string) AS record_b_id,
           true AS is_true_match FROM {customer} WHERE c_custkey % 2 = 0
    UNION ALL
    SELECT 'crm:' || cast(c_custkey AS string), 'web:' || cast(c_custkey + 700000000 AS string), true
    FROM {customer} WHERE c_custkey % 3 = 0
    UNION ALL
    SELECT 'crm:' || cast(c_custkey AS string), 'erp:' || cast(c_custkey + 500000001 AS string), false
    FROM {customer} WHERE c_custkey % 2 = 1
    """,
)
_LABEL_PAIRS = _with_jaro(
    f"""SELECT l.record_a_id, l.record_b_id, l.is_true_match, coalesce(a.em = b.em, false) AS ex, a.nm AS x, b.nm AS y,
               a.sg AS sa, b.sg AS sb
        FROM {{people_labels}} l JOIN ({_VIEW}) a ON l.record_a_id = a.id JOIN ({_VIEW}) b ON l.record_b_id = b.id"""
)
_DECIDED = f"""
    SELECT record_a_id, record_b_id, ex, cast(printf('%.4f', coalesce({_JW}, 0) * 0.65 + CASE WHEN sa = sb THEN 0.35 ELSE 0 END) AS double) AS score,
           coalesce({_JW}, 0) * 0.65 + CASE WHEN sa = sb THEN 0.35 ELSE 0 END >= 0.88 AS fz, is_true_match, {_JW} > 0.5 AS nf, sa = sb AS sf
    FROM ({_LABEL_PAIRS}) p
"""


@query(
    "er_decisions",
    f"""
    SELECT record_a_id, record_b_id, 'email-exact' AS rule_id, 'deterministic' AS strategy, ex AS is_match,
           CASE WHEN ex THEN 1.0 ELSE 0.0 END AS confidence_score,
           CASE WHEN ex THEN 'email_address' ELSE '' END AS matched_fields FROM ({_DECIDED}) a
    UNION ALL
    SELECT record_a_id, record_b_id, 'name-segment-fuzzy', 'probabilistic', fz, score,
           concat_ws(',', CASE WHEN nf THEN 'full_name' END, CASE WHEN sf THEN 'segment' END) FROM ({_DECIDED}) b
    """,
)
def er_decisions(t: Tables) -> DataFrame:
    rows = matching.decide(t.people_labels, _records(t), _person_rules())
    return rows.withColumn("matched_fields", F.array_join("matched_fields", ",")).drop("rule_set_version")


@query(
    "er_eval",
    f"""
    SELECT labelled_pairs, tp, fp, fn, tn, precision, recall, accuracy,
           CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1_score
    FROM (SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, (tp + tn) / labelled_pairs AS accuracy
          FROM (SELECT count(*) AS labelled_pairs, count_if(p AND is_true_match) AS tp, count_if(p AND NOT is_true_match) AS fp,
                       count_if(NOT p AND is_true_match) AS fn, count_if(NOT p AND NOT is_true_match) AS tn
                FROM (SELECT is_true_match, coalesce(ex OR fz, false) AS p FROM {{people_labels}} l
                      LEFT JOIN (SELECT record_a_id, record_b_id, ex, fz FROM ({_DECIDED}) d) d USING (record_a_id, record_b_id)) x) y) z
    """,
    bigint=("tp", "fp", "fn", "tn"),
)
def er_eval(t: Tables) -> DataFrame:
    decisions = matching.decide(t.people_labels, _records(t), _person_rules())
    return matching.evaluate_matches(decisions, t.people_labels)


@query(
    "er_golden_id_events",
    f"""
    WITH RECURSIVE c1 AS MATERIALIZED ({_clusters_sql(f"SELECT record_a_id AS a, record_b_id AS b FROM ({_EMAIL_LINKS}) e")}),
      c2 AS MATERIALIZED ({_clusters_sql()}),
      g1 AS (SELECT cluster, {_GID} AS gid FROM c1 GROUP BY cluster), g2 AS (SELECT cluster, {_GID} AS gid FROM c2 GROUP BY cluster),
      f AS (SELECT g2.gid AS golden_id, g1.gid AS previous_golden_id, count(*) AS records
            FROM c2 JOIN g2 USING (cluster) JOIN c1 ON c1._record_id = c2._record_id JOIN g1 ON g1.cluster = c1.cluster GROUP BY ALL),
      h AS (SELECT *, count(*) OVER (PARTITION BY golden_id) AS s, count(*) OVER (PARTITION BY previous_golden_id) AS t FROM f)
    SELECT golden_id, previous_golden_id, CASE WHEN s > 1 THEN 'merge' WHEN t > 1 THEN 'split' ELSE 'assign' END AS operation, records
    FROM h WHERE s > 1 OR t > 1 OR golden_id <> previous_golden_id
    """,
)
def er_golden_id_events(t: Tables) -> DataFrame:
    records = _records(t)

    def run(*rules) -> DataFrame:
        members = cut_lineage(connecting.clustered_records(records, people_rules(*rules)))
        ids = clusters.golden_ids(members, "person")
        return members.join(ids, "cluster").select(RECORD_ID, "golden_id")

    return clusters.golden_id_events(run(EMAIL_RULE), run(EMAIL_RULE, NAME_RULE))

"""Matching against brute force, clustering, golden ids, survivorship."""

from __future__ import annotations

import hashlib
import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.functions.text import close_pairs, jaro_winkler_text, round_four
from tarnlake.operators import clusters, connecting, matching, survivorship
from tarnlake.operators.matching import (
    Blocking,
    ExactField,
    ExactRule,
    MatchRules,
    SimilarField,
    SimilarRule,
)

SCHEMA = "_record_id string, _source_id string, name string, city string, email string, scope_unit_id string"


def people(n: int, seed: int = 1):
    rng = random.Random(seed)
    first = ["anna", "annie", "bob", "rob", "robert", "maria", "marie", "jose", "josé", "li"]
    last = ["smith", "smyth", "jones", "garcia", "garzia", "chen", "cheng", "ng"]
    out = []
    for i in range(n):
        name = f"{rng.choice(first)} {rng.choice(last)}"
        if rng.random() < 0.2:
            name = " ".join(reversed(name.split()))
        if rng.random() < 0.1:
            name = name.upper()
        out.append(
            (
                f"{rng.choice('abc')}:{i:05d}",
                rng.choice("abc"),
                None if rng.random() < 0.05 else name,
                None if rng.random() < 0.1 else rng.choice(["york", "leeds"]),
                None if rng.random() < 0.3 else f"u{rng.randrange(n // 2)}@{rng.choice(['x', 'y'])}.test",
                rng.choice(["unit-1", "unit-2", None]),
            )
        )
    return out


def norm(v):
    import re
    import unicodedata

    if v is None:
        return None
    return re.sub(r"\s+", " ", unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode()).strip().lower()


def similarity(kind, a, b):
    if kind == "exact":
        return float(a == b)
    if kind == "jaro_winkler":
        return jaro_winkler_text(a, b)
    x, y = set(a.split()), set(b.split())
    return len(x & y) / len(x | y) if x and y else 0.0


FIELD = {"name": 2, "city": 3, "email": 4}


def matches(rule, r, s):
    if isinstance(rule, ExactRule):
        return all(norm(r[FIELD[f.field]]) is not None and norm(r[FIELD[f.field]]) == norm(s[FIELD[f.field]]) for f in rule.fields)
    total = 0.0
    for f in rule.fields:
        a, b = norm(r[FIELD[f.field]]), norm(s[FIELD[f.field]])
        if a is not None and b is not None:
            total += similarity(f.kind, a, b) * f.weight
    return total >= rule.threshold


def brute_components(data, rules, block=lambda r: ""):
    parent = {r[0]: r[0] for r in data}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r, s in itertools.combinations(sorted(data), 2):
        if block(r) == block(s) and any(matches(rule, r, s) for rule in rules):
            a, b = sorted((find(r[0]), find(s[0])))
            parent[b] = a
    return {r[0]: find(r[0]) for r in data}


def spark_components(spark, data, rules: MatchRules):
    records = spark.createDataFrame(data, SCHEMA)
    links = matching.match_links(records, rules)
    return {r[0]: r[1] for r in clusters.connected_components(records, links).collect()}


WORDS = SimilarRule("words", (SimilarField("name", 0.6, "token_set"), SimilarField("city", 0.4)), 0.8)
LETTERS = SimilarRule("letters", (SimilarField("name", 0.7, "jaro_winkler"), SimilarField("city", 0.3)), 0.95)
LOOSE = SimilarRule("loose", (SimilarField("name", 0.5, "token_set"), SimilarField("email", 0.5)), 0.5)
NAME_ONLY = SimilarRule("name-only", (SimilarField("name", 1.0, "jaro_winkler"),), 0.97)
EMAIL = ExactRule("email", (ExactField("email"),))
NAME_CITY = ExactRule("name-city", (ExactField("name"), ExactField("city")))


@pytest.mark.parametrize(
    "rules", [(EMAIL,), (NAME_CITY,), (WORDS,), (LETTERS,), (LOOSE,), (NAME_ONLY,), (EMAIL, LETTERS, WORDS)]
)
def test_links_connect_what_brute_force_connects(spark, rules):
    data = people(120)
    got = spark_components(spark, data, MatchRules("p", "v1", rules))
    assert got == brute_components(data, rules)


def test_hot_group_is_tiled_without_losing_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "_TILE_ROWS", 7)
    data = people(150, seed=3)
    for rules in ((LETTERS,), (NAME_ONLY,), (WORDS,)):
        got = spark_components(spark, data, MatchRules("p", "v1", rules))
        assert got == brute_components(data, rules)


def test_connecting_links_give_the_components_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(matching, "_TILE_ROWS", 7)
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 3)
    monkeypatch.setattr(connecting, "_FIRST_MEMBERS", 1)
    data = people(150, seed=3)
    records = spark.createDataFrame(data, SCHEMA)
    for rule in (LETTERS, NAME_ONLY):
        rules = MatchRules("p", "v1", (EMAIL, rule))
        links = connecting.connecting_links(records, rules)
        got = {r[0]: r[1] for r in clusters.connected_components(records, links).collect()}
        assert got == brute_components(data, rules.rules)


def test_alike_combinations_are_connected_by_few_links(spark, monkeypatch):
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 8)
    data = [(f"a:{i:03d}", "a", f"margarethe smithson{i:03d}", "c", None, None) for i in range(120)]
    records = spark.createDataFrame(data, SCHEMA)
    rules = MatchRules("p", "v1", (LETTERS,))
    links = connecting.connecting_links(records, rules)
    # All 7,140 pairs match; a tile of 8 is compared with itself and the next one.
    assert links.count() <= 120 * 12
    found = clusters.connected_components(records, links)
    assert {r.cluster for r in found.collect()} == {"a:000"}


def test_what_has_joined_the_main_component_is_compared_no_further(spark, monkeypatch):
    monkeypatch.setattr(matching, "_TILE_ROWS", 8)
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 8)
    compared, score = [], matching.matching_pairs

    def counted(pairs, rule):
        compared.append(pairs.count())
        return score(pairs, rule)

    monkeypatch.setattr(matching, "matching_pairs", counted)
    names = [f"margarethe smithson{i:03d}" for i in range(400)] + [f"xmargarethe smithson{i:03d}" for i in range(60)]
    data = [(f"a:{i:03d}", "a", name, "c", None, None) for i, name in enumerate(names)]
    records = spark.createDataFrame(data, SCHEMA)
    links = connecting.connecting_links(records, MatchRules("p", "v1", (LETTERS,)))
    found = clusters.connected_components(records, links)
    assert {r.cluster for r in found.collect()} == {"a:000"}
    # The neighbours, and a few members with a part of the group instead of 16 with all 400.
    assert sum(compared) <= 460 * 12 + 1000


def test_clustered_records_are_the_components_of_all_links(spark, monkeypatch):
    monkeypatch.setattr(matching, "_TILE_ROWS", 7)
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 3)
    monkeypatch.setattr(connecting, "_FIRST_MEMBERS", 1)
    data = people(150, seed=3)
    records = spark.createDataFrame(data, SCHEMA)
    rules = (EMAIL, LETTERS, NAME_ONLY, WORDS)
    got = connecting.clustered_records(records.unionByName(records.limit(3)), MatchRules("p", "v1", rules))
    found = [tuple(r) for r in got.collect()]
    assert len(found) == 153 and dict(found) == brute_components(data, rules)


@pytest.mark.parametrize("long_one", [False, True])
def test_search_compares_many_texts_at_a_time(spark, monkeypatch, long_one):
    """The search for components needs no bound where the texts fit a word, and finds the same."""
    monkeypatch.setattr(matching, "_TILE_ROWS", 7)
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 3)
    monkeypatch.setattr(connecting, "_FIRST_MEMBERS", 1)
    calls = []
    close, letters = matching.close_sides, matching.with_letters
    monkeypatch.setattr(matching, "close_sides", lambda *a: calls.append("close") or close(*a))
    monkeypatch.setattr(matching, "with_letters", lambda *a: calls.append("letters") or letters(*a))
    data = people(120, seed=8)
    if long_one:
        data += [("a:long", "a", "ab" * 40, "york", None, None), ("b:long", "b", "ab" * 39 + "b", "york", None, None)]
    rule = SimilarRule("n", (SimilarField("name", 0.65, "jaro_winkler"), SimilarField("city", 0.35)), 0.9)
    found = connecting.clustered_records(spark.createDataFrame(data, SCHEMA), MatchRules("p", "v1", (rule,)))
    assert {r[0]: r[1] for r in found.collect()} == brute_components(data, (rule,))
    assert set(calls) == {"letters" if long_one else "close"}


def test_what_an_exact_rule_connects_is_not_compared(spark, monkeypatch):
    monkeypatch.setattr(connecting, "_WHOLE_ROWS", 1)
    monkeypatch.setattr(connecting, "_NEAR_ROWS", 8)
    compared, score = [], matching.matching_pairs

    def counted(pairs, rule):
        compared.append(pairs.count())
        return score(pairs, rule)

    monkeypatch.setattr(matching, "matching_pairs", counted)
    # Names of equal letters pass the bound; none of the turned ones matches, but all share an address.
    names = [f"margarethe smithson{i:03d}" for i in range(120)]
    names += [name[::-1] for name in names[:40]]
    data = [(f"a:{i:03d}", "a", name, "c", f"p{i % 120}@x.test", None) for i, name in enumerate(names)]
    records = spark.createDataFrame(data, SCHEMA)
    found = connecting.clustered_records(records, MatchRules("p", "v1", (EMAIL, LETTERS)))
    assert {r.cluster for r in found.collect()} == {"a:000"}
    assert len(compared) == 1 and compared[0] <= 160 * 12


def test_tiles_meet_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(matching, "_TILE_ROWS", 5)
    profiles = spark.createDataFrame([(f"p{i:03d}", "g") for i in range(43)], "profile string, g string")
    cells = matching._in_cells(profiles, ["g"], bounded=False)
    a, b = cells.alias("a"), cells.alias("b")
    once = (F.col("a._low") == F.col("a._high")) | (F.col("a._tile") != F.col("b._tile"))
    pairs = a.join(
        b,
        (F.col("a._low") == F.col("b._low")) & (F.col("a._high") == F.col("b._high")) & (F.col("a.profile") < F.col("b.profile")) & once,
    ).select(F.col("a.profile"), F.col("b.profile"))
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(set(found)) == 43 * 42 // 2


def test_blocking_and_units(spark):
    data = people(100, seed=5)
    by_domain = MatchRules("p", "v1", (LETTERS,), Blocking("email_domain", "email"))
    domain = lambda r: "?" if r[4] is None else r[4].split("@")[1]
    assert spark_components(spark, data, by_domain) == brute_components(data, (LETTERS,), domain)
    units = MatchRules("p", "v1", (LETTERS,), within_unit=True)
    assert spark_components(spark, data, units) == brute_components(data, (LETTERS,), lambda r: r[5])


def test_chunks_follow_hash_order_and_bound_the_block(spark):
    data = [(f"r{i}", "hot" if i % 3 else f"b{i}") for i in range(300)]
    cut = matching.cut_blocks(spark.createDataFrame(data, "_record_id string, b string"), "b", 40)
    got = {r["_record_id"]: (r["b"], r["_chunk"]) for r in cut.collect()}
    assert len(got) == 300
    hot = sorted((r for r, b in data if b == "hot"), key=lambda r: (hashlib.md5(r.encode()).hexdigest(), r))
    for place, record in enumerate(hot):
        assert got[record] == ("hot", place // 40)
    assert all(c == 0 for b, c in got.values() if b != "hot")


def test_result_does_not_depend_on_partitioning(spark):
    data = people(90, seed=8)
    rules = MatchRules("p", "v1", (EMAIL, LETTERS), Blocking("name_first3", "name", 10))
    first = spark_components(spark, data, rules)
    random.Random(2).shuffle(data)
    records = spark.createDataFrame(data, SCHEMA).repartition(7)
    links = matching.match_links(records, rules)
    assert first == {r[0]: r[1] for r in clusters.connected_components(records, links).collect()}


def test_another_unit_is_never_joined(spark):
    data = people(80, seed=11)
    got = spark_components(spark, data, MatchRules("p", "v1", (EMAIL, LETTERS, WORDS), within_unit=True))
    unit = {r[0]: r[5] for r in data}
    assert all(unit[a] == unit[b] for a, b in got.items())


def test_decisions(spark, rows):
    data = [
        ("a:1", "a", "Anna Smith", "york", "a@x.test", None),
        ("a:2", "a", "anna  smith", None, "A@X.TEST", None),
        ("a:3", "a", "Bob Jones", "leeds", None, None),
    ]
    records = spark.createDataFrame(data, SCHEMA)
    pairs = spark.createDataFrame([("a:1", "a:2"), ("a:1", "a:3")], "record_a_id string, record_b_id string")
    both = ExactRule("name-email", (ExactField("name"), ExactField("email")))
    raw = ExactRule("raw-email", (ExactField("email", normalise=False),))
    got = matching.decide(pairs, records, MatchRules("p", "v2", (both, raw, WORDS))).collect()
    by = {(r.record_b_id, r.rule_id): r for r in got}
    assert len(got) == 6
    assert by["a:2", "name-email"].is_match and by["a:2", "name-email"].matched_fields == ["name", "email"]
    assert not by["a:2", "raw-email"].is_match
    assert by["a:2", "words"].confidence_score == 0.6 and not by["a:2", "words"].is_match
    assert by["a:3", "name-email"].confidence_score == 0.0 and by["a:3", "name-email"].matched_fields == []


def test_approaches_are_necessary_conditions():
    assert matching.approaches(LETTERS) == [matching.Approach(("city",))]
    words = matching.approaches(WORDS)[0]
    assert words.equal == ("city",) and words.words == "name" and words.overlap == pytest.approx(2 / 3, abs=1e-6)
    assert len(matching.approaches(LOOSE)) == 2
    assert matching.approaches(NAME_ONLY) == [matching.Approach(())]


def test_rules_are_checked():
    with pytest.raises(ValueError, match="weight"):
        matching.rules_from_config(
            {
                "entity_type": "s",
                "rule_set_version": "v1",
                "rules": [
                    {"rule_id": "x", "strategy": "probabilistic", "fields": [{"field_name": "n", "similarity": "trigram"}]}
                ],
            }
        )
    with pytest.raises(ValueError, match="similarity"):
        SimilarField("n", 1.0, "trigram")
    with pytest.raises(ValueError):
        SimilarRule("r", (), 0.0)


def test_long_chain_is_one_component(spark):
    n = 60
    nodes = spark.createDataFrame([(f"{i:03d}",) for i in range(n + 3)], "_record_id string")
    order = list(range(n))
    random.Random(4).shuffle(order)
    links = spark.createDataFrame(
        [(f"{a:03d}", f"{b:03d}") for a, b in zip(order, order[1:])], "record_a_id string, record_b_id string"
    )
    got = {r[0]: r[1] for r in clusters.connected_components(nodes, links).collect()}
    assert all(got[f"{i:03d}"] == "000" for i in range(n))
    assert got["060"] == "060"


def test_close_pairs_are_those_of_the_plain_similarity():
    rng = random.Random(3)
    for letters, longest in itertools.product(("ab", "0123456789abcdef ", "aé漢b"), (1, 3, 8, 20, 33, 64)):
        def made(n):
            return ["".join(rng.choice(letters) for _ in range(rng.randrange(longest + 1))) for _ in range(n)]

        first, ranks = made(20), [np.array([rng.randrange(20) for _ in range(n)]) for n in (20, 33)]
        second = made(30) + first[:3]
        least = rng.choice([0.01, 0.5, 0.8154, 1.0])
        want = {
            (i, j): jaro_winkler_text(a, b)
            for (i, a), (j, b) in itertools.product(enumerate(first), enumerate(second))
            if ranks[0][i] < ranks[1][j]
        }
        found = [
            ((int(a), int(b)), s)
            for i, j, score in close_pairs(first, second, *ranks, least)
            for a, b, s in zip(i, j, score)
        ]
        assert len(found) == len(dict(found))
        assert dict(found) == {k: v for k, v in want.items() if v >= least}


def test_scores_are_rounded_as_by_round():
    rng = random.Random(5)
    values = [rng.random() for _ in range(3000)] + [k / 20000 for k in range(2000)] + [0.00005, 1.0, -0.12345, 1e12 + 0.3]
    assert round_four(np.array(values)).tolist() == [round(v, 4) for v in values]
    assert np.isnan(round_four(np.array([np.nan]))[0])


@pytest.mark.parametrize("long_one", [False, True])
def test_large_groups_are_compared_many_texts_at_a_time(spark, monkeypatch, long_one):
    """All pairs of a large group, in tiles; nulls, equal ids and groups with a text that is too long."""
    monkeypatch.setattr(matching, "_TILE_ROWS", 20)
    monkeypatch.setattr(matching, "_TEXT_ROWS", 16)
    joined = []
    candidates = matching._candidates
    monkeypatch.setattr(matching, "_candidates", lambda p, *a: joined.append(p.count()) or candidates(p, *a))
    rule = SimilarRule("n", (SimilarField("name", 0.65, "jaro_winkler"), SimilarField("city", 0.35)), 0.88)
    rng = random.Random(11)
    data = people(150, seed=9)
    data += [(f"a:x{i}", "a", "".join(rng.choice("abcd ") for _ in range(9)), "york", None, None) for i in range(40)]
    data += [("a:x1", "a", "abcdabcd", "york", None, None), ("a:small", "a", "anna smith", "hull", None, None)]
    if long_one:
        data.append(("a:long", "a", "ab" * 40, "york", None, None))
    records = spark.createDataFrame(data, SCHEMA)
    prepared = matching.prepare(records, MatchRules("p", "v1", (rule,)))
    _, pairs = matching.similar_pairs(prepared, rule, False)
    got = sorted((r.record_a_id, r.record_b_id, r.score, tuple(r.matched_fields)) for r in pairs.collect())
    combos = {}
    for r in data:
        if r[2] is not None and r[3] is not None:
            key = norm(r[2]), r[3]
            combos[key] = min(combos.get(key, r[0]), r[0])
    want = []
    for ((n1, c1), p1), ((n2, c2), p2) in itertools.product(combos.items(), combos.items()):
        score = jaro_winkler_text(n1, n2) * 0.65 + 0.35
        if c1 == c2 and p1 < p2 and score >= 0.88:
            want.append((p1, p2, 0.0 + jaro_winkler_text(n1, n2) * 0.65 + 1.0 * 0.35, ("name", "city")))
    assert got == sorted(want) and len(got) > 100
    # Only what is in small groups, or has no city, goes through the join.
    york = sum(c == "york" for _, c in combos)
    assert (joined[0] >= york) == long_one


def test_few_edges_are_solved_by_one_task(spark, monkeypatch):
    rng = random.Random(7)
    ids = [f"{rng.choice('aé')}{i}\U0010ffff"[: rng.choice([5, 9])] + str(i) for i in range(90)]
    pairs = [(rng.choice(ids), rng.choice(ids)) for _ in range(60)] + list(zip(ids[60:80], ids[61:81]))
    links = spark.createDataFrame([*pairs, (None, ids[0])], "record_a_id string, record_b_id string")
    nodes = spark.createDataFrame([(i,) for i in ids], "_record_id string")
    cuts = []
    whole = clusters.cut_lineage
    monkeypatch.setattr(clusters, "cut_lineage", lambda df, label="cut": cuts.append(label) or whole(df, label))

    def run(one_task):
        del cuts[:]
        found = clusters.connected_components(nodes, links.repartition(5), one_task=one_task).collect()
        return sorted(tuple(r) for r in found), len(cuts)

    rounds, many = run(0)
    at_once, two = run(clusters.ONE_TASK_EDGES)
    assert at_once == rounds and len({c for _, c in rounds}) < 60
    assert two == 2 < many
    assert run(10) == (rounds, many)


def test_components_without_links(spark):
    nodes = spark.createDataFrame([("a",), ("b",)], "_record_id string")
    links = spark.createDataFrame([], "record_a_id string, record_b_id string")
    assert {tuple(r) for r in clusters.connected_components(nodes, links).collect()} == {("a", "a"), ("b", "b")}


def test_golden_ids(spark):
    members = spark.createDataFrame([("c", f"s:{i}") for i in range(9)] + [("d", "s:x")], "cluster string, _record_id string")
    got = {r.cluster: r for r in clusters.golden_ids(members, "person").collect()}
    joined = "|".join(sorted(f"s:{i}" for i in range(9)))
    assert got["c"].golden_id == "gid-" + hashlib.sha256(f"_source_id:person:{joined}".encode()).hexdigest()[:16]
    assert got["c"].member_count == 9 and got["d"].member_count == 1
    # one formula for every size and partitioning
    again = {r.cluster: r for r in clusters.golden_ids(members.repartition(5), "person").collect()}
    assert again == got
    many = spark.range(25_000).selectExpr("'big' AS cluster", "concat('s:', id) AS _record_id")
    big = clusters.golden_ids(many.repartition(7), "person").first()
    joined = "|".join(sorted(f"s:{i}" for i in range(25_000)))
    assert big.golden_id == "gid-" + hashlib.sha256(f"_source_id:person:{joined}".encode()).hexdigest()[:16]
    assert big.member_count == 25_000


def test_members_of_a_golden_id_are_sorted_by_ranges(spark, capsys):
    members = spark.range(9).selectExpr("'big' AS cluster", "concat('s:', id) AS _record_id")
    clusters.golden_ids(members, "person").explain()
    assert "rangepartitioning(" in capsys.readouterr().out


def test_golden_id_events(spark, rows):
    before = spark.createDataFrame([("1", "A"), ("2", "B"), ("3", "C"), ("4", "C"), ("5", "D")], "_record_id string, golden_id string")
    after = spark.createDataFrame(
        [("1", "AB"), ("2", "AB"), ("3", "C1"), ("4", "C2"), ("5", "D"), ("6", "E")], "_record_id string, golden_id string"
    )
    assert rows(clusters.golden_id_events(before, after)) == [
        ("AB", "A", "merge", 1), ("AB", "B", "merge", 1), ("C1", "C", "split", 1), ("C2", "C", "split", 1), ("E", None, "assign", 1),
    ]


def survivor(spark, data, rule, order=()):
    records = spark.createDataFrame(data, "cluster string, _record_id string, _source_id string, v string, ts string")
    policy = survivorship.Survivorship("p", "v1", (rule,), source_order=order)
    return survivorship.resolve_fields(records, policy).first()["v"]


CLUSTER = [
    ("c", "a:1", "a", None, "2024-01-03"),
    ("c", "b:1", "b", "bee", "2024-01-01"),
    ("c", "c:1", "c", "see!", "2024-01-02T00:00:00Z"),
    ("c", "d:1", "d", "dee!", "nonsense"),
]


@pytest.mark.parametrize(
    ("rule", "order", "winner"),
    [
        (survivorship.FieldRule("v", "first_non_null"), (), "b:1"),
        (survivorship.FieldRule("v", "first_non_null"), ("d", "c"), "d:1"),
        (survivorship.FieldRule("v", "source_priority", ("a", "d", "b")), (), "d:1"),
        (survivorship.FieldRule("v", "source_priority", ("zz",)), (), "b:1"),
        (survivorship.FieldRule("v", "longest"), (), "c:1"),
        (survivorship.FieldRule("v", "most_recent", timestamp="ts"), (), "c:1"),
        (survivorship.FieldRule("v", "most_recent"), (), "b:1"),
    ],
)
def test_survivorship(spark, rule, order, winner):
    got = survivor(spark, CLUSTER, rule, order)
    assert got["record"] == winner and got["candidates"] == 3


def test_most_recent_without_any_readable_time(spark):
    data = [("c", "a:1", "a", "x", "?"), ("c", "b:1", "b", "y", None)]
    assert survivor(spark, data, survivorship.FieldRule("v", "most_recent", timestamp="ts"))["record"] == "a:1"


def test_pinning_keeps_the_scope_column(spark):
    records = spark.createDataFrame(
        [("c", "a:1", "a", "x", "y", "unit-1")], "cluster string, _record_id string, _source_id string, v string, w string, scope_unit_id string"
    )
    got = survivorship.resolve_fields(records, survivorship.Survivorship("p", "v1", output_fields=("v",)))
    assert set(got.columns) == {"cluster", "v", "scope_unit_id"}


def test_evaluation(spark):
    decisions = spark.createDataFrame(
        [("a", "b", True), ("d", "c", False), ("c", "d", True), ("e", "f", True)], "record_a_id string, record_b_id string, is_match boolean"
    )
    labels = spark.createDataFrame(
        [("b", "a", True), ("c", "d", False), ("g", "h", True), ("i", "j", False)], "record_a_id string, record_b_id string, is_true_match boolean"
    )
    r = matching.evaluate_matches(decisions, labels).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (1, 1, 1, 1)
    assert (r.precision, r.recall, r.f1_score, r.accuracy) == (0.5, 0.5, 0.5, 0.5)
    none = matching.evaluate_matches(decisions.limit(0), labels.limit(0)).first()
    assert (none.precision, none.recall, none.f1_score, none.accuracy) == (0.0, 0.0, 0.0, 0.0)

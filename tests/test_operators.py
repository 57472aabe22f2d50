from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tarnlake.operators import benchmark, graph, incremental, lifecycle, mapping, masking, merge
from tarnlake.operators import quality, reconcile, schema, scope
from tarnlake.plans import jobs, kpis, metrics
from tarnlake.plans.model import (
    AccessDenied,
    Dimension,
    Entity,
    EntityJoin,
    FieldFilter,
    Metric,
    MetricModel,
    MetricQueryError,
    MetricRequest,
    TimeDimension,
    TimeRange,
)

# ------------------------------------------------------------------ mapping and masking


def test_dotted_source_names(spark):
    df = spark.createDataFrame([("1", "2024-01-02T03:04:05.678Z")], ["id", "auditInfo.createdAt"])
    rules = (mapping.MappingRule(("auditInfo.createdAt",), "created", "date_format"),)
    assert mapping.map_fields(df, rules)[0].first()[0] == "2024-01-02"


def test_strict_cast_stops_the_job(spark):
    df = spark.createDataFrame([("3.0",)], "n string")
    rules = (mapping.MappingRule(("n",), "n", "cast", {"type": "integer"}),)
    with pytest.raises(PySparkException):
        mapping.map_fields(df, rules)[0].collect()
    good, bad = mapping.map_fields(df, rules, strict=False)
    assert good.count() == 0 and bad.first()["reject_reason"] == "n"


def test_default_is_cast_and_missing_column_counts_as_missing(spark):
    df = spark.createDataFrame([("",)], "n string")
    rules = (
        mapping.MappingRule(("n",), "n", "cast", {"type": "integer"}, "use_default", "7"),
        mapping.MappingRule(("gone",), "g", "rename", {}, "use_default", "d"),
        mapping.MappingRule(("gone",), "h"),
    )
    assert tuple(mapping.map_fields(df, rules)[0].first()) == (7, "d", None)


def test_rule_names_are_checked():
    with pytest.raises(ValueError):
        mapping.MappingRule(("ok",), "Not Ok")
    with pytest.raises(ValueError):
        mapping.MappingRule((), "x")
    with pytest.raises(ValueError):
        mapping.MappingRule(("1bad",), "x")


def test_no_rules_pass_through(spark):
    df = spark.createDataFrame([("1",)], "n string")
    assert mapping.map_fields(df, None)[0].collect() == df.collect()


@pytest.mark.parametrize(
    ("name", "level"),
    [
        ("ssn_last4", "sensitive_pii"), ("Tax_ID", "sensitive_pii"), ("creditcard", "sensitive_pii"), ("cvv2", "sensitive_pii"),
        ("email_address", "pii"), ("Phone", "pii"), ("dob", "pii"), ("date_of_birth", "pii"), ("ip_address", "pii"),
        ("dobermann", "internal"), ("work_email", "internal"), ("name", "internal"),
    ],
)
def test_name_classification(name, level):
    assert masking.classify_name(name) == level


def test_tokenise_needs_a_secret(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    with pytest.raises(ValueError):
        masking.apply_masks(df, [masking.FieldMask("x", "tokenise")])
    masked = masking.apply_masks(df, [masking.FieldMask(c, "redact") for c in ("x", "y", "z")])
    assert tuple(masked.first()) == ("REDACTED", None)


# ------------------------------------------------------------------ quality


def test_pattern_is_anchored_at_the_start_only(spark):
    df = spark.createDataFrame([("ab1",), ("xab",), (None,)], "v string")
    got = quality.record_violations(df, [quality.PatternCheck("v", "a|b")], ["v"]).collect()
    assert [r.v for r in got] == ["xab"]


def test_blocked_beats_warned(spark):
    df = spark.createDataFrame([("", "5"), ("a", "500"), ("", "500"), ("a", None)], "n string, v string")
    checks = [quality.NullCheck("n", "blocking"), quality.RangeCheck("v", "warning", 0, 100)]
    r = quality.record_report(df, checks).first()
    assert (r.total_records, r.records_passed, r.records_with_warnings, r.records_blocked, r.violations) == (4, 1, 1, 2, 4)


def test_empty_batch_passes(spark):
    df = spark.createDataFrame([], "a string, d string")
    policy = quality.BatchPolicy(required=("a",), natural_key=("a",), date_fields=("d",), today=date(2024, 1, 1))
    got = {r.rule_id: (r.measured_value, r.passed) for r in quality.batch_checks(df, policy).collect()}
    assert got == {"completeness": (100.0, True), "duplicate-rate": (0.0, True), "date-validation": (0.0, True)}


def test_null_keys_are_duplicates_of_each_other(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "k string")
    r = quality.batch_checks(df, quality.BatchPolicy(natural_key=("k",))).first()
    assert r.measured_value == pytest.approx(100 / 3)


def test_date_rate_counts_fields_and_rows(spark):
    df = spark.createDataFrame([("2999-01-01", "1980-01-01"), ("2024-01-02", None)], "a string, b string")
    r = quality.batch_checks(df, quality.BatchPolicy(date_fields=("a", "b"), today=date(2024, 1, 1))).first()
    assert r.measured_value == 100.0


def test_gate_mode(spark):
    outcomes = spark.createDataFrame([("a", False), ("b", True)], "rule_id string, passed boolean")
    assert quality.batch_gate(outcomes).first().blocked
    assert not quality.batch_gate(outcomes, "warn").first().blocked


def test_stored_samples_are_masked(spark):
    df = spark.createDataFrame([("alice1", "v", "null_check", "blocking", "x")], "email string, field_name string, check_kind string, severity string, detail string")
    run = {"run_id": "r"}
    assert quality.exception_rows(df, run, ["email"]).first().sample_key == "al**e1"
    assert quality.exception_rows(df, run, ["email"], masking.auto_policy(["email"])).first().sample_key == "al**e1"
    hidden = (masking.FieldMask("email", "full_mask", level=masking.SENSITIVE),)
    assert quality.exception_rows(df, run, ["email"], hidden).first().sample_key is None
    assert quality.exception_rows(df, run, ["email"], ()).first().sample_key == "alice1"


# ------------------------------------------------------------------ merge


def test_merge_is_idempotent(spark, rows):
    prev = spark.createDataFrame([("1", "a", 0), ("2", "b", 0), ("3", "c", 0)], "id string, v string, n int")
    delta = spark.createDataFrame([("2", "B", 1), ("2", "BB", 2), ("4", "D", 1), (None, "x", 1), ("", "y", 1)], "id string, v string, n int")
    once = merge.merge_current(prev, delta, ["id"], ["n"])
    assert rows(once) == [("1", "a", 0), ("2", "BB", 2), ("3", "c", 0), ("4", "D", 1)]
    assert rows(merge.merge_current(once, delta, ["id"], ["n"])) == rows(once)


@pytest.mark.parametrize(
    ("kind", "yes", "no"), [("boolean", True, False), ("string", "Yes", "False"), ("int", 1, 0)]
)
def test_soft_delete_markers(spark, kind, yes, no):
    prev = spark.createDataFrame([("1", no), ("2", no)], f"id string, gone {kind}")
    delta = spark.createDataFrame([("1", yes), ("3", yes), ("4", None)], f"id string, gone {kind}")
    got = merge.merge_current(prev, delta, ["id"], ["gone"], "gone")
    assert sorted(r.id for r in got.collect()) == ["2", "4"]


def test_merge_needs_keys(spark):
    df = spark.createDataFrame([("1",)], "id string")
    with pytest.raises(merge.MergeError):
        merge.merge_current(None, df, [], ["id"])
    with pytest.raises(merge.MergeError):
        merge.upsert(df, df, ["nope"])


def test_latest_per_key_with_ties_is_stable(spark, rows):
    data = [("a", i % 3, f"v{i}") for i in range(30)]
    first = rows(merge.latest_per_key(spark.createDataFrame(data, "k string, n int, v string"), ["k"], ["n"]))
    again = spark.createDataFrame(data[::-1], "k string, n int, v string").repartition(5)
    assert rows(merge.latest_per_key(again, ["k"], ["n"])) == first


def test_null_to_value_is_a_change(spark):
    target = spark.createDataFrame([(1, None), (2, "x")], "k int, v string")
    incoming = spark.createDataFrame([(1, ""), (2, "x"), (3, None)], "k int, v string")
    got = merge.changed_rows(incoming, target, ["k"], ["k", "v"])
    assert sorted(r.k for r in got.collect()) == [1, 3]


# ------------------------------------------------------------------ reconciliation


def test_money_compares_exactly(spark):
    a = spark.createDataFrame([(0.1,), (0.2,)], "v double")
    b = spark.createDataFrame([(0.3,)], "v double")
    assert reconcile.compare_money(a, b, "v").first().verdict == "matched"
    c = spark.createDataFrame([(0.31,)], "v double")
    r = reconcile.compare_money(a, c, "v").first()
    assert r.verdict == "variance" and r.detail == "difference=0.01"


def test_nothing_to_compare(spark):
    empty = spark.createDataFrame([], "v double")
    r = reconcile.compare_money(empty, empty, "v").first()
    assert r.verdict == "not_comparable" and r.variance_pct == 0.0


def test_signature_changes_with_a_figure(spark):
    a, b = spark.range(100), spark.range(101)
    head = dict(tenant_code="t", entity_id="e", period="p", run_id="r", rule_version="v")
    one = reconcile.report(reconcile.reconciliation([reconcile.compare_counts(a, a)]), head).first()
    two = reconcile.report(reconcile.reconciliation([reconcile.compare_counts(a, b)]), head).first()
    assert one.matched and not two.matched and one.signature != two.signature


# ------------------------------------------------------------------ scope


def test_empty_claim_is_refused():
    with pytest.raises(scope.ScopeDenied):
        scope.scope_filter(scope.ScopeClaims())
    with pytest.raises(scope.UnknownUnit):
        scope.scope_filter(scope.ScopeClaims(frozenset({"__tenant__"})))
    with pytest.raises(ValueError):
        scope.unrestricted("because")


def test_predicates(spark):
    df = spark.createDataFrame([("unit-1",), ("unit-2",), (None,), ("__tenant__",)], "scope_unit_id string")

    def seen(claims):
        return sorted(str(r[0]) for r in scope.scope_filter(claims).apply(df).collect())

    assert seen(scope.ScopeClaims(frozenset({"unit-1"}))) == ["unit-1"]
    assert len(seen(scope.ScopeClaims(tenant_wide=True))) == 4
    assert seen(scope.ScopeClaims(frozenset({"__tenant__"}), single=True)) == ["None", "__tenant__"]


def test_claims_expand_and_check(spark):
    units = spark.createDataFrame(
        [("area", None), ("unit-1", "area"), ("unit-2", "area"), ("unit-3", None), ("unit-4", "unit-1"), ("unit-1", "unit-4")],
        "scope_unit_id string, parent_scope_unit_id string",
    )
    assert scope.build_claims(["area"], units).units == {"area", "unit-1", "unit-2", "unit-4"}
    assert scope.build_claims([], units, single=True).units == {"__tenant__"}
    with pytest.raises(scope.UnknownUnit):
        scope.build_claims(["nowhere"], units)
    with pytest.raises(scope.UnknownUnit):
        scope.build_claims(["__tenant__"], units)
    with pytest.raises(scope.ScopeDenied):
        scope.scope_filter(scope.build_claims([], units))


def test_stamping(spark):
    df = spark.createDataFrame([(" Unit-1 ",), ("unit-9",), ("__tenant__",), ("",), ("x y",), (None,)], "o string")
    known = spark.createDataFrame([("unit-1",), ("__tenant__",)], "scope_unit_id string")

    def units(attribution, k=None):
        return [r.scope_unit_id for r in scope.stamp_scope(df, attribution, k).collect()]

    by_field = scope.Attribution(field="o")
    assert sorted(map(str, units(by_field, known))) == ["None"] * 5 + ["unit-1"]
    assert units(by_field)[:2] == ["unit-1", "unit-9"]
    assert set(units(scope.Attribution(owner="unit-7"))) == {"unit-7"}
    assert set(units(scope.Attribution(single=True))) == {"__tenant__"}
    assert set(units(scope.Attribution())) == {None}


def test_row_security_hides_null_units(spark):
    df = spark.createDataFrame([("u", None), ("u", "b"), (None, "b"), ("u", "c")], "scope_unit_id string, brand_code string")
    assert scope.row_security(df, ["u"], ["b"]).count() == 2
    assert scope.row_security(df, ["u"], []).count() == 1
    with pytest.raises(scope.ScopeDenied):
        scope.row_security(df, [])


# ------------------------------------------------------------------ metrics


def small_model():
    return MetricModel(
        (
            Entity(
                "company",
                (Dimension("industry", "industry"), Dimension("country", "country", tag="pii")),
                (
                    Metric("total_revenue", "sum", "annual_revenue", scale=2),
                    Metric("company_count", "count"),
                    Metric("secret", "sum", "annual_revenue", tag="finance"),
                    Metric("per_company", kind="ratio", numerator="secret", denominator="company_count"),
                    Metric("paid", "sum", "paid"),
                    Metric("null_ratio", kind="ratio", numerator="total_revenue", denominator="paid"),
                    Metric("zero_ratio", kind="ratio", numerator="total_revenue", denominator="paid", zero_when_undefined=True),
                ),
                (TimeDimension("day", "day"),),
                (EntityJoin("owner", "owner_id", "id"),),
            ),
            Entity("owner", (Dimension("label", "label"),)),
        )
    )


@pytest.fixture(scope="module")
def companies(spark):
    return {
        "company": spark.createDataFrame(
            [("it", "de", 10.0, 0.0, date(2024, 1, 1), 1, "u1"), ("it", "fr", 5.5, 0.0, date(2024, 2, 1), 2, "u1"), ("ag", "de", 1.0, 2.0, date(2024, 2, 5), 1, "u2")],
            "industry string, country string, annual_revenue double, paid double, day date, owner_id int, scope_unit_id string",
        ),
        "owner": spark.createDataFrame([(1, "one", "u1"), (2, "two", "u2")], "id int, label string, scope_unit_id string"),
    }


ANYONE = scope.ScopeFilter(None)


def test_access_tags(companies):
    model = small_model()
    with pytest.raises(AccessDenied):
        metrics.metric_query(model, MetricRequest("company", ("company_count",), ("country",)), companies, scope=ANYONE)
    with pytest.raises(AccessDenied):  # a part of a ratio
        metrics.metric_query(model, MetricRequest("company", ("per_company",)), companies, scope=ANYONE)
    with pytest.raises(AccessDenied):  # a filter
        request = MetricRequest("company", ("company_count",), filters=(FieldFilter("country", "eq", "de"),))
        metrics.metric_query(model, request, companies, scope=ANYONE)


def test_zero_denominator(companies):
    request = MetricRequest("company", ("null_ratio", "zero_ratio"), ("industry",))
    got = {r.industry: r for r in metrics.metric_query(small_model(), request, companies, scope=ANYONE).collect()}
    assert got["it"].null_ratio is None and got["it"].zero_ratio == 0.0 and got["ag"].null_ratio == 0.5


def test_scope_covers_the_joined_side(companies):
    request = MetricRequest("company", ("company_count",), joined=(("owner", "label"),))
    got = metrics.metric_query(small_model(), request, companies, scope=scope.ScopeFilter(("u1",))).collect()
    assert sorted((str(r.owner_label), r.company_count) for r in got) == [("None", 1), ("one", 1)]


def test_bad_requests_and_models(companies):
    model = small_model()
    for bad in (
        lambda: MetricRequest("company", ()),
        lambda: MetricRequest("company", ("x",), row_limit=0),
        lambda: MetricRequest("company", ("x",), row_limit=100_001),
        lambda: MetricRequest("company", ("x",), time_range=TimeRange("today")),
        lambda: TimeRange(),
        lambda: TimeRange("next_week"),
        lambda: FieldFilter("d", "in"),
        lambda: FieldFilter("d", "in", values=tuple(range(1001))),
        lambda: FieldFilter("d", "is_null", 1),
        lambda: FieldFilter("d", "eq"),
        lambda: FieldFilter("d", "like", "x"),
        lambda: Metric("m", "sum", "*"),
        lambda: Metric("m", kind="ratio", numerator="a"),
        lambda: Metric("Bad Name"),
        lambda: Entity("e", (Dimension("d", "d"), Dimension("d", "x"))),
        lambda: Entity("e", (Dimension("d", "d"),), (), (TimeDimension("d", "d"),)),
        lambda: Entity("e", joins=(EntityJoin("t", "a", "b"), EntityJoin("t", "c", "d"))),
        lambda: Entity("e", metrics=(Metric("r", kind="ratio", numerator="x", denominator="y"),)),
        lambda: MetricModel((Entity("ee", joins=(EntityJoin("gone", "a", "b"),)),)),
        lambda: metrics.metric_query(model, MetricRequest("nope", ("x",)), companies, scope=ANYONE),
        lambda: metrics.metric_query(model, MetricRequest("company", ("nope",)), companies, scope=ANYONE),
        lambda: metrics.metric_query(model, MetricRequest("company", ("company_count",), joined=(("x", "y"),)), companies, scope=ANYONE),
        lambda: metrics.governed_columns(Entity("ee", (Dimension("d", "d", tag="t"),)), frozenset(), with_scope=False),
    ):
        with pytest.raises(MetricQueryError):
            bad()


def test_derived_of_derived_is_rejected():
    parts = (Metric("a", "sum", "x"), Metric("b", "sum", "y"), Metric("r", kind="ratio", numerator="a", denominator="b"))
    with pytest.raises(MetricQueryError):
        Entity("ee", metrics=(*parts, Metric("rr", kind="ratio", numerator="r", denominator="b")))


def test_period_to_date_compares_like_for_like(companies):
    request = MetricRequest("company", ("company_count",), time="day", grain="month")
    got = metrics.compare_periods(
        small_model(), request, companies, scope=ANYONE, today=date(2024, 2, 3), against="period_to_date"
    ).first()
    assert (got.company_count, got.company_count_previous) == (1, 1)


def test_only_needed_columns_are_read(companies, tmp_path, spark):
    path = str(tmp_path / "c")
    companies["company"].write.parquet(path)
    request = MetricRequest("company", ("total_revenue",), ("industry",))
    plan = metrics.metric_query(small_model(), request, {"company": spark.read.parquet(path)}, scope=scope.ScopeFilter(("u1",)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<industry:string,annual_revenue:double,scope_unit_id:string>" in text
    assert "PushedFilters: [IsNotNull(scope_unit_id), EqualTo(scope_unit_id,u1)]" in text or "In(scope_unit_id" in text


def test_restatement(spark, rows):
    before = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0)], "p int, m double")
    after = spark.createDataFrame([(1, 1.0), (2, 2.5), (4, 4.0)], "p int, m double")
    assert rows(metrics.restatement(before, after, ["p"], "m")) == [(2, 2.0, 2.5, "m"), (3, 3.0, None, "m"), (4, None, 4.0, "m")]


def test_catalogue_is_complete():
    model = kpis.business_model()
    assert len(model.entities) == 18
    for entity, metric in kpis.KPI_METRICS.values():
        assert model.entity(entity).metric(metric)
    assert kpis.expand_tags(frozenset({kpis.EXECUTIVE})) >= kpis.DEPARTMENTS
    assert kpis.expand_tags(frozenset({kpis.FINANCE})) == {kpis.FINANCE}


# ------------------------------------------------------------------ benchmark and alerts


@pytest.mark.parametrize("bad", [{"rank", "average"}, {"rank", "sum", "min"}, {"min", "max", "average"}])
def test_revealing_combinations(bad):
    with pytest.raises(benchmark.RevealingBenchmark):
        benchmark.check_functions(bad)


def test_cohort_of_the_viewers_own_units_is_hidden(spark):
    df = spark.createDataFrame([("x", f"u{i}", float(i)) for i in range(6)] + [("y", f"u{i}", 1.0) for i in range(9)], "g string, scope_unit_id string, v double")
    got = benchmark.peer_benchmark(df, "v", ["g"], {"sum"}, ["u0", "u1"])
    assert [r.g for r in got.collect()] == ["y"]


def test_alerts(spark):
    df = spark.createDataFrame([(1, 10.0, None), (2, 10.0, 0.0), (3, 13.0, 10.0), (4, None, 10.0)], "p int, v double, old double")
    rules = [benchmark.AlertCondition("v", "changed_by_pct_above", 20), benchmark.AlertCondition("v", "gte", 10)]
    got = {r.p: r.fires for r in benchmark.evaluate_alerts(df, rules, {"v": "old"}).collect()}
    assert got == {1: False, 2: False, 3: True, 4: False}


# ------------------------------------------------------------------ graph


def test_twins(spark):
    golden = spark.createDataFrame([("g1", "won", "u1", 1), ("g2", None, None, 2)], "golden_id string, stage string, scope_unit_id string, k int")
    orders = spark.createDataFrame([("o1", 1, "u2"), ("o2", 1, None), (None, 1, "u1"), ("o3", None, "u1")], "golden_id string, k int, scope_unit_id string")
    rule = graph.Relationship("placed", "company", "order", "k", "k")
    table, twins = jobs.build_twins(golden, "company", [(rule, orders)], "stage")
    assert table.count() == 2
    got = {r.golden_id: r for r in twins.collect()}
    assert got["g1"].rollups == {"placed_count": 2} and got["g1"].lifecycle_stage == "won"
    found = graph.twin_edges(table, "g1").orderBy("to_golden_id").collect()
    assert [(e.to_golden_id, e.to_scope_unit_id) for e in found] == [("o1", "u2"), ("o2", None)]
    assert got["g1"].edge_count == 2 and got["g2"].rollups == {} and got["g2"].edge_count == 0
    assert got["g1"].attributes.k == 1
    assert [e.to_golden_id for e in graph.twin_edges(table, "g1", 1).collect()] == ["o1"]
    assert [e.to_golden_id for e in graph.twin_edges(table, "g1", 5, ("placed", "o1")).collect()] == ["o2"]
    assert graph.twin_edges(table, "g2").count() == 0


# ------------------------------------------------------------------ schema


def test_drift_classes(spark, rows):
    def snap(*r):
        return spark.createDataFrame(list(r), schema.SNAPSHOT)

    old = snap(("a", "int", True, None, None, None), ("b", "string", False, 10, None, None), ("c", "decimal", True, None, 10, 2), ("d", "int", True, None, None, None))
    new = snap(("a", "long", False, None, None, None), ("b", "string", True, 20, None, None), ("c", "decimal", True, None, 12, 3), ("e", "int", True, None, None, None), ("f", "int", False, None, None, None))
    changes = schema.schema_drift(new, old)
    assert rows(changes.select("field_name", "change_kind", "classification")) == [
        ("a", "nullability_changed", "breaking"), ("a", "type_changed", "breaking"),
        ("b", "length_changed", "potentially_breaking"), ("b", "nullability_changed", "non_breaking"),
        ("c", "precision_changed", "potentially_breaking"), ("c", "scale_changed", "potentially_breaking"),
        ("d", "removed", "breaking"), ("e", "added", "non_breaking"), ("f", "added", "breaking"),
    ]
    none = schema.drift_summary(schema.schema_drift(old, old)).first()
    assert (none.changes, none.overall_classification, none.is_transformation_blocked) == (0, "no_drift", False)
    same = schema.fingerprint(old).first().schema_fingerprint
    assert same == schema.fingerprint(old.withColumn("is_nullable", F.lit(False))).first().schema_fingerprint
    assert same != schema.fingerprint(new).first().schema_fingerprint


def test_declared_schema(spark):
    df = spark.sql("SELECT 1 AS a, cast(1 AS decimal(7,3)) AS b")
    got = {r.name: r for r in schema.declared_schema(df).collect()}
    assert (got["b"].precision, got["b"].scale, got["a"].is_nullable) == (7, 3, False)


# ------------------------------------------------------------------ incremental


def test_chunk_days(spark):
    def days(rate, per_day):
        return spark.range(1).select(incremental.chunk_days(F.lit(rate), F.lit(per_day))).first()[0]

    assert days(500.0, 100_000.0) == 3
    assert days(500.0, 10.0) == 90
    assert days(1.0, 1e9) == 1
    assert days(500.0, 0.0) == 90


def test_chunk_plan(spark):
    jobs_df = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 10), 4)], "window_start date, window_end date, chunk_days int")
    got = [(r.sequence, r.chunk_start, r.chunk_end) for r in incremental.plan_chunks(jobs_df).collect()]
    assert got == [
        (0, date(2024, 1, 1), date(2024, 1, 4)), (1, date(2024, 1, 5), date(2024, 1, 8)), (2, date(2024, 1, 9), date(2024, 1, 10)),
    ]
    for bad in ((date(2024, 1, 2), date(2024, 1, 1), 1), (date(2000, 1, 1), date(2024, 1, 1), 1)):
        df = spark.createDataFrame([bad], "window_start date, window_end date, chunk_days int")
        with pytest.raises(PySparkException):
            incremental.plan_chunks(df).collect()


def test_chunk_replay_counts_once(spark):
    at = [datetime(2024, 1, 1, h) for h in range(8)]
    log = [
        ("j", 0, "running", 0, at[0]), ("j", 0, "completed", 10, at[1]), ("j", 0, "completed", 99, at[2]),
        ("j", 1, "completed", 5, at[1]), ("j", 1, "compensated", 0, at[3]),
        ("j", 2, "failed", 0, at[1]), ("j", 2, "compensated", 0, at[2]), ("j", 2, "running", 0, at[3]), ("j", 2, "completed", 7, at[4]),
    ]
    ledger = incremental.chunk_ledger(
        spark.createDataFrame(log, "job string, sequence int, event string, rows int, happened_at timestamp"), ["job"]
    )
    got = {r.sequence: (r.state, r.rows_processed, r.attempts) for r in ledger.collect()}
    assert got == {0: ("completed", 10, 1), 1: ("compensated", 0, 0), 2: ("completed", 7, 1)}
    assert incremental.resume_pointer(ledger, ["job"]).first().next_sequence == 1


@pytest.mark.parametrize("limit", [1, 5, 17, 59, 60, 61, 200])
def test_capped_read(spark, limit):
    df = spark.sql("SELECT id, timestamp_seconds(1700000000 + (id * 7919 % 60) * 20000 + (id % 4)) AS ts FROM range(60)")
    got, more = incremental.capped_read(df, "ts", limit, ["id"])
    want = [r.id for r in df.orderBy("ts", "id").limit(limit).collect()]
    assert sorted(r.id for r in got.collect()) == sorted(want)
    assert more == (limit < 60)


def test_capped_read_inside_one_second(spark):
    df = spark.sql("SELECT id, timestamp_seconds(1700000000) AS ts FROM range(50)")
    got, more = incremental.capped_read(df, "ts", 20, ["id"])
    assert sorted(r.id for r in got.collect()) == list(range(20)) and more


def test_replay_bounds():
    with pytest.raises(ValueError):
        incremental.replay_window(datetime(2024, 1, 1), datetime(2024, 1, 1))


def test_first_update_starts_the_state(spark):
    state = spark.createDataFrame([], "source_id string, connection_id string, entity_id string, version long, last_watermark timestamp, run_id string")
    updates = spark.createDataFrame([("s", "c", "e", 0, datetime(2024, 1, 1), "r")], "source_id string, connection_id string, entity_id string, expected_version int, new_watermark timestamp, run_id string")
    accepted, refused = incremental.advance_watermarks(state, updates)
    assert accepted.first().version == 1 and refused.count() == 0


# ------------------------------------------------------------------ lifecycle and jobs


def test_unacknowledged_hold(spark):
    df = spark.createDataFrame([("t",)], "tenant_code string")
    with pytest.raises(lifecycle.HoldNotAcknowledged):
        lifecycle.erase_tenant({"a": df}, "t", {"a": "case"})


def test_certificate_is_withheld_while_rows_remain(spark):
    df = spark.createDataFrame([("t",), ("other",), (None,)], "tenant_code string")
    kept, report = lifecycle.erase_tenant({"a": df}, "t")
    assert kept["a"].count() == 2
    assert lifecycle.erasure_certificate(report, kept, "t").first().complete
    assert not lifecycle.erasure_certificate(report, {"a": df}, "t").first().complete


def test_too_many_unowned_rows_fail_the_job(spark):
    raw = spark.createDataFrame([("1", "u-1", 1), ("2", "", 1)], "id string, owner string, n int")
    spec = jobs.TransformSpec(None, ("id",), ("n",), scope.Attribution(field="owner"))
    with pytest.raises(ValueError, match="no owner"):
        jobs.transform(raw, spec)
    single = jobs.TransformSpec(None, ("id",), ("n",), scope.Attribution(single=True))
    done = jobs.transform(raw, single)
    assert not done.blocked and {r.scope_unit_id for r in done.curated.collect()} == {"__tenant__"}

from __future__ import annotations

import hashlib
import hmac
from datetime import date

import pytest
from pyspark.sql import functions as F

from tarnlake.functions import hashing, text, values
from tarnlake.functions.fiscal import FiscalCalendar, inclusive


def one(spark, column, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()])
    return df.select(column.alias("x")).first()[0]


# worked out by hand: matches, half transpositions, prefix
@pytest.mark.parametrize(
    ("a", "b", "expected"),
    [
        ("martha", "marhta", 17 / 18 + 3 * 0.1 * (1 - 17 / 18)),
        ("dixon", "dicksonx", 0.8133333333333332),
        ("dwayne", "duane", 0.84),
        ("abc", "abc", 1.0),
        ("", "", 1.0),
        ("", "a", 0.0),
        ("ab", "cd", 0.0),
        ("a", "b", 0.0),
    ],
)
def test_jaro_winkler(a, b, expected):
    assert text.jaro_winkler_text(a, b) == pytest.approx(expected, abs=1e-12)


def test_jaro_winkler_boost_has_no_floor():
    # Jaro 0.55, one shared leading letter: the boost applies although Jaro is below 0.7
    assert text.jaro_winkler_text("aaxyzq", "abcdez") > 0.0
    low = text.jaro_winkler_text("abcdef", "axyzuv")
    assert low == pytest.approx((1 / 6 + 1 / 6 + 1) / 3 + 0.1 * (1 - (1 / 6 + 1 / 6 + 1) / 3))


def test_jaro_winkler_column_and_bound(spark):
    words = ["martha", "marhta", "dixon", "dicksonx", "dwayne", "duane", "", "zz", "aab", "baa", "abab"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    pairs = df.select(F.col("w").alias("a")).crossJoin(df.select(F.col("w").alias("b")))
    bound = text.jaro_winkler_bound(*[text.letter_profile(F.col(c), text.letter_slots(F.col(c))) for c in "ab"])
    for r in pairs.select("a", "b", text.jaro_winkler("a", "b").alias("s"), bound.alias("u")).collect():
        assert r.s == pytest.approx(text.jaro_winkler_text(r.a, r.b))
        assert r.u >= r.s - 1e-12, r


def test_batch_equals_text_by_text_and_bound_holds(spark):
    import random

    rng = random.Random(7)
    words = ["".join(rng.choice("abcde é") for _ in range(rng.randrange(1, 18))) for _ in range(60)]
    words += ["a" * 40, "a" * 300, "ab" * 70, "b" * 41, "", "x", "\x00y"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    pairs = df.select(F.col("w").alias("a")).crossJoin(df.select(F.col("w").alias("b")))
    bound = text.jaro_winkler_bound(*[text.letter_profile(F.col(c), text.letter_slots(F.col(c))) for c in "ab"])
    for r in pairs.select("a", "b", text.jaro_winkler("a", "b").alias("s"), bound.alias("u")).collect():
        assert r.s == text.jaro_winkler_text(r.a, r.b), r
        assert r.u >= r.s - 1e-12, r


@pytest.mark.parametrize(
    ("value", "expected"),
    [("  Crème   Brûlée ", "creme brulee"), ("ACME\tCorp", "acme corp"), ("ﬁne Ⅳ", "fine iv"), ("日本", ""), (None, None)],
)
def test_normalise(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    assert df.select(text.normalise(F.col("v")).alias("x")).first()[0] == expected


def test_block_keys(spark):
    df = spark.createDataFrame(
        [("A.B@X.Org ", "+49 (30) 12-345-678", "Éric Blair"), ("nobody", "12", "1 2"), (None, None, None), ("", "-", "Al")],
        "e string, p string, n string",
    )
    got = [
        tuple(r)
        for r in df.select(
            text.email_domain_key(F.col("e")), text.phone_key(F.col("p")), text.name_key(F.col("n"))
        ).collect()
    ]
    assert got[0] == ("x.org", "4930123", "eri")
    assert got[1] == ("__no_domain__", "12", "__empty__")
    assert got[2] == ("__unknown__",) * 3
    assert got[3] == ("__no_domain__", "__no_phone__", "al")


def test_token_overlap(spark):
    def score(a, b):
        return one(spark, text.token_overlap(text.tokens(F.col("a")), text.tokens(F.col("b"))), a=a, b=b)

    assert score("acme corp", "corp acme") == 1.0
    assert score("acme corp", "acme inc") == pytest.approx(1 / 3)
    assert score("", "acme") == 0.0


@pytest.mark.parametrize("secret", [b"k", b"x" * 64, b"y" * 100])
def test_hmac_token(spark, secret):
    for value in ("", "alice@example.test", "日本"):
        want = hmac.new(secret, value.encode(), hashlib.sha256).hexdigest()
        assert one(spark, hashing.hmac_sha256(F.col("v"), secret), v=value) == want
        assert one(spark, hashing.token(F.col("v"), secret), v=value) == f"TOKEN-{want[:16].upper()}"


def test_sample_slot(spark):
    for key in ("a", "1", ""):
        want = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16) % 100
        assert one(spark, hashing.sample_slot(F.col("v"), 100), v=key) == want
    with pytest.raises(ValueError):
        hashing.sample_slot(F.col("v"), 0)


def test_row_hash_tells_null_from_empty(spark):
    df = spark.createDataFrame([(None, "a"), ("", "a"), ("a", ""), ("a", None)], "x string, y string")
    hashes = {r[0] for r in df.select(hashing.row_hash(["x", "y"])).collect()}
    assert len(hashes) == 4


@pytest.mark.parametrize(
    ("value", "visible", "expected"),
    [("123456789", 4, "*****6789"), ("1234", 4, "****"), ("12", 4, "**"), ("", 4, ""), ("abc", 0, "***")],
)
def test_keep_last(spark, value, visible, expected):
    assert one(spark, values.keep_last(F.col("v"), visible), v=value) == expected


def test_redact_key(spark):
    assert one(spark, values.redact_key(F.col("v")), v="abcdefg") == "ab***fg"
    assert one(spark, values.redact_key(F.col("v")), v="abcd") == "****"


@pytest.mark.parametrize(
    ("layout", "value", "expected"),
    [
        ("%Y-%m-%dT%H:%M:%S.%fZ", "2024-03-05T10:11:12.5Z", "2024-03-05"),
        ("%Y-%m-%dT%H:%M:%S.%fZ", "2024-03-05T10:11:12.123456Z", "2024-03-05"),
        ("%Y-%m-%dT%H:%M:%S.%f%z", "2024-03-05T10:11:12.123+0000", "2024-03-05"),
        ("%d/%m/%Y", "05/03/2024", "2024-03-05"),
        ("%Y-%m-%d", "2024-3-5x", None),
    ],
)
def test_date_layouts(spark, layout, value, expected):
    moment = values.parse_layout(F.col("v"), layout)
    assert one(spark, F.date_format(moment, values.date_pattern("%Y-%m-%d")), v=value) == expected


def test_iso_dates(spark):
    good = ["2024-03-05", "2024-03-05T10:11:12Z", "2024-03-05 10:11", " 2024-03-05T10:11:12.123+02:00 "]
    bad = ["soon", "2024-13-01", "05/03/2024", ""]
    for v in good:
        assert one(spark, values.parse_iso_date(F.col("v")), v=v) == date(2024, 3, 5), v
    for v in bad:
        assert one(spark, values.parse_iso_date(F.col("v")), v=v) is None, v


def test_variance(spark):
    def v(e, o):
        return one(spark, values.variance_pct(F.col("e"), F.col("o")), e=e, o=o)

    assert v(100, 99) == 1.0
    assert v(0, 0) == 0.0
    assert v(0, 5) == 100.0


# ------------------------------------------------------------------ fiscal calendar


def test_fiscal_labels(spark):
    april = FiscalCalendar(4)
    df = spark.createDataFrame(
        [(date(2024, 3, 31),), (date(2024, 4, 1),), (date(2024, 12, 31),), (date(2025, 1, 15),)], "d date"
    )
    d = F.col("d")
    got = df.select(april.fiscal_year(d), april.quarter(d), april.period(d)).collect()
    assert [tuple(r) for r in got] == [(2024, 4, 12), (2025, 1, 1), (2025, 3, 9), (2025, 4, 10)]


@pytest.mark.parametrize("start_month", range(1, 13))
@pytest.mark.parametrize("grain", ["day", "week", "month", "quarter", "year"])
def test_truncation_agrees_with_bounds(spark, start_month, grain):
    calendar = FiscalCalendar(start_month, week_start=start_month % 7)
    df = spark.sql("SELECT explode(sequence(DATE '2023-12-25', DATE '2025-03-05', INTERVAL 9 DAY)) AS d")
    for r in df.select("d", calendar.truncated(F.col("d"), grain).alias("t")).collect():
        start, end = calendar.bounds(r.d, grain)
        assert r.t == start
        assert start <= r.d < end


def test_comparisons():
    plain = FiscalCalendar()
    day = date(2024, 2, 29)
    assert plain.comparison(day, "day", "prior_year") == (date(2023, 2, 28), date(2023, 3, 1))
    assert plain.comparison(day, "month", "prior_period") == (date(2024, 1, 1), date(2024, 2, 1))
    assert plain.comparison(day, "quarter", "period_to_date") == (date(2024, 1, 1), date(2024, 3, 1))
    assert FiscalCalendar(2).comparison(date(2024, 1, 5), "quarter", "prior_period") == (date(2023, 8, 1), date(2023, 11, 1))


def test_relative_ranges():
    c, today = FiscalCalendar(4), date(2024, 5, 15)
    assert c.relative("today", today) == (date(2024, 5, 15), date(2024, 5, 16))
    assert c.relative("yesterday", today) == (date(2024, 5, 14), date(2024, 5, 15))
    assert c.relative("last_7_days", today) == (date(2024, 5, 9), date(2024, 5, 16))
    assert c.relative("last_30_days", today)[0] == date(2024, 4, 16)
    assert c.relative("last_90_days", today)[0] == date(2024, 2, 16)
    assert c.relative("month_to_date", today) == (date(2024, 5, 1), date(2024, 5, 16))
    assert c.relative("quarter_to_date", today) == (date(2024, 4, 1), date(2024, 5, 16))
    assert c.relative("year_to_date", today) == (date(2024, 4, 1), date(2024, 5, 16))
    assert c.relative("last_month", today) == (date(2024, 4, 1), date(2024, 5, 1))
    assert c.relative("last_quarter", today) == (date(2024, 1, 1), date(2024, 4, 1))
    assert c.relative("last_year", today) == (date(2023, 4, 1), date(2024, 4, 1))


def test_inclusive_range():
    assert inclusive(date(2024, 1, 1), date(2024, 1, 31)) == (date(2024, 1, 1), date(2024, 2, 1))
    with pytest.raises(ValueError):
        inclusive(date(2024, 1, 2), date(2024, 1, 1))

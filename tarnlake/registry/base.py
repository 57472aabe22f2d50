"""Query registration and the input tables derived from the given ones.

Derived inputs are written once, as SQL that Spark and the checking engine both run, so that a
check compares the operators and not two versions of their input.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


@dataclass(frozen=True)
class Entry:
    run: Callable[[Tables], DataFrame]
    oracle: str | None


INPUTS: dict[str, str] = {}
REGISTRY: dict[str, Entry] = {}


class Tables:
    """The given tables of one folder and the inputs derived from them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE_TABLES:
            return self.spark.read.parquet(self.path(name))
        if name in INPUTS:
            return self.sql(INPUTS[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        names = dict.fromkeys(_PLACEHOLDER.findall(text))
        return self.spark.sql(text, **{n: getattr(self, n) for n in names})


def derived(name: str, sql: str) -> None:
    INPUTS[name] = sql


def expand(text: str) -> str:
    """SQL for the checking engine: derived inputs become subqueries, given tables plain names."""

    def inline(match: re.Match[str]) -> str:
        name = match.group(1)
        return name if name in BASE_TABLES else f"({expand(INPUTS[name])})"

    return _PLACEHOLDER.sub(inline, text)


def query(
    name: str,
    oracle: str | None = None,
    bigint: tuple[str, ...] = (),
    double: tuple[str, ...] = (),
):
    """Register a query; the oracle may use ``{input}`` placeholders.

    ``bigint`` and ``double`` state the types of result columns for which SQL engines widen sums and
    literals differently.
    """
    kinds = dict.fromkeys(bigint, "BIGINT") | dict.fromkeys(double, "DOUBLE")

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered twice")
        typed = oracle
        if oracle is not None and kinds:
            casts = ", ".join(f"cast({c} AS {kind}) AS {c}" for c, kind in kinds.items())
            typed = f"SELECT * REPLACE ({casts}) FROM ({oracle}) typed"
        REGISTRY[name] = Entry(fn, typed)
        return fn

    return add


# ---------------------------------------------------------------- derived inputs

derived(
    "units",
    """
    SELECT 'unit-' || cast(n_nationkey AS string) AS scope_unit_id,
           'area-' || cast(n_regionkey AS string) AS parent_scope_unit_id,
           n_nationkey % 7 <> 6 AS active,
           CASE WHEN n_nationkey % 5 = 0 THEN DATE '1999-01-01' END AS effective_from,
           CASE WHEN n_nationkey % 4 = 0 THEN DATE '2000-12-31' END AS effective_to
    FROM {nation}
    UNION ALL
    SELECT 'area-' || cast(r_regionkey AS string), 'all-areas', true,
           cast(NULL AS date), cast(NULL AS date)
    FROM {region}
    UNION ALL
    SELECT 'all-areas', cast(NULL AS string), max(r_regionkey) >= 0,
           cast(NULL AS date), cast(NULL AS date)
    FROM {region}
    """,
)
derived(
    "accounts",
    """
    SELECT c_custkey, c_name, c_mktsegment AS industry, c_acctbal,
           'unit-' || cast(c_nationkey AS string) AS scope_unit_id,
           'unit-' || cast(c_nationkey AS string) AS home_unit,
           CASE WHEN c_custkey % 9 = 0 THEN cast(NULL AS string)
                ELSE 'brand-' || cast(c_custkey % 3 AS string) END AS brand_code
    FROM {customer}
    """,
)
derived(
    "sales",
    """
    SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
           cast(o.o_orderdate AS date) AS activity_date, o.o_totalprice AS gross_booked_amount,
           o.o_orderstatus AS order_status, o.o_orderpriority AS service_line,
           CASE WHEN o.o_orderkey % 4 = 0 THEN o.o_totalprice END AS refund_amount,
           'unit-' || cast(c.c_nationkey AS string) AS scope_unit_id
    FROM {orders} o LEFT JOIN {customer} c ON o.o_custkey = c.c_custkey
    """,
)

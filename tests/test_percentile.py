"""Exact percentiles against the built-in and a sorted list."""

from __future__ import annotations

import math
import random
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyroom.operators import percentile
from tallyroom.operators.percentile import exact_percentiles

SHARES = [0.01, 0.25, 0.5, 0.99, 1.0]


def check(spark, values, bits=16, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    ours = exact_percentiles(df, {f"p{i}": ("x", p) for i, p in enumerate(SHARES)}, bits)
    builtin = df.selectExpr(
        *[f"percentile_disc({p}) within group (order by x) as p{i}" for i, p in enumerate(SHARES)]
    )
    assert {f.dataType.simpleString() for f in ours.schema} == {kind}
    if kind == "double":
        assert list(map(str, ours.first())) == list(map(str, builtin.first()))
    # The built-in gives doubles for every type, so the others are held against a sorted list.
    ordered = sorted((r.x for r in df.collect() if r.x is not None), key=lambda v: (v != v, v))
    expected = [ordered[max(math.ceil(p * len(ordered)), 1) - 1] if ordered else None for p in SHARES]
    assert list(map(str, ours.first())) == list(map(str, expected))


@pytest.mark.parametrize(
    "values",
    [
        [], [None], [None, None, 4.0], [7.0], [5.0] * 40, list(map(float, range(100))),
        list(map(float, range(101))), [-1.0, -1.0, 0.0, 2.5, 2.5, 2.5, 9.0],
        [1.0] * 1000 + list(map(float, range(2, 500))),
    ],
    ids=lambda v: f"{len(v)} values",
)
def test_edge_cases(spark, values):
    check(spark, values)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), max_size=60))
def test_random_values(spark, values):
    check(spark, values, bits=32)


def test_continuous_values_with_a_hot_one(spark):
    rng = random.Random(5)
    values = [rng.lognormvariate(3, 2) if rng.random() > 1 / 3 else 17.0 for _ in range(20000)]
    df = spark.createDataFrame([(v, -v) for v in values], "x double, y double").repartition(7)
    wanted = {"a": ("x", 0.5), "b": ("x", 0.99), "c": ("y", 0.01), "d": ("y", 0.37)}
    row = exact_percentiles(df, wanted).first()
    columns = {"x": sorted(values), "y": sorted(-v for v in values)}
    for name, (column, p) in wanted.items():
        assert row[name] == columns[column][math.ceil(p * len(values)) - 1]


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("bigint", [2**53 + 1, 2**53, 2**63 - 1, -(2**63), 2**53 + 1, None, 0]),
        ("int", [3, -1, 2**31 - 1, -(2**31), 3, 3]),
        ("decimal(18,3)", [Decimal("900719925474099.301"), Decimal("-0.001"), Decimal("900719925474099.302")]),
        ("double", [math.nan, 1.0, -math.inf, math.inf, 5e-324, -5e-324, 2.2250738585072014e-308, 0.0, 1.7976931348623157e308]),
        ("double", [math.nextafter(2.0**k, d) for k in (-1022, -60, 0, 1, 3, 52, 1023) for d in (0.0, math.inf)]),
        ("float", [0.1, 0.25, None, -3.5]),
    ],
    ids=["bigint", "int", "decimal", "doubles", "powers", "float"],
)
def test_every_type_is_searched_as_it_is(spark, kind, values):
    check(spark, values, 16, kind)
    check(spark, values, 24, kind)


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(), min_size=1, max_size=40))
def test_any_doubles(spark, values):
    # Both zeros are one value, and which of them the built-in gives is open.
    check(spark, [v + 0.0 if v != 0 else 0.0 for v in values])


def test_other_types_are_refused(spark):
    with pytest.raises(TypeError):
        exact_percentiles(spark.createDataFrame([("a",)], "x string"), {"p": ("x", 0.5)})


def test_no_task_grows_with_the_data(spark):
    """Twenty times the distinct values: only counts of a hundredth of them are dealt out, and no window grows with them."""
    bits = 6
    for rows in (4_000, 80_000):
        df = spark.range(rows, numPartitions=4).selectExpr("cast(xxhash64(id) as double) as x")
        result = exact_percentiles(df, {"p": ("x", 0.5)}, bits)
        result.collect()
        plan = result._jdf.queryExecution().executedPlan()
        assert "rangepartitioning" not in plan.toString()
        exchanged = _exchanged_rows(plan)
        by_entry = [n for keys, n in exchanged if keys == ["entry"]]
        by_value = [n for keys, n in exchanged if "d" in keys]
        # A window of all bins, and one of the values of a bin.
        assert len(by_entry) == 2 and max(by_entry) <= 2 ** (bits + 2)
        assert len(by_value) == 1 and by_value[0] <= 0.013 * rows + 64
        assert all(n <= 2 ** (bits + 2) for keys, n in exchanged if "d" not in keys)


def test_the_table_is_read_twice(spark, tmp_path):
    spark.range(5000).selectExpr("id % 977 as x", "cast(id as double) / 7 as y").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    result = exact_percentiles(df, {"a": ("x", 0.99), "b": ("y", 0.01), "c": ("y", 0.5), "d": ("y", 0.99)})
    assert tuple(result.collect()[0]) == (966, 49 / 7, 2499 / 7, 4949 / 7)
    plan = result._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") + plan.count("Scan parquet") <= 2


def test_a_missed_rank_is_an_error(spark, monkeypatch):
    """Brackets beside the rank, as a broken sketch would give them."""
    monkeypatch.setattr(percentile, "ASIDE", -0.2)
    df = spark.range(1000).selectExpr("cast(id as double) as x")
    with pytest.raises(Exception, match="misses the rank"):
        exact_percentiles(df, {"p": ("x", 0.5)}).collect()


def _exchanged_rows(plan) -> list[tuple[list[str], int]]:
    """Columns and rows written of each hash exchange of a plan that has run."""
    found, nodes = [], [plan]
    while nodes:
        node = nodes.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            nodes.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            nodes.append(node.plan())
        if node.nodeName() == "Exchange":
            metric = node.metrics().get("shuffleRecordsWritten")
            keys = re.search(r"hashpartitioning\((.*?), \d+\)", node.simpleString(1000))
            if metric.isDefined() and keys:
                found.append((re.findall(r"(\w+)#", keys[1]), int(metric.get().value())))
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return found

"""Plan shape checks: what the optimizer must (not) produce for the
registered queries when no table is small enough to broadcast by estimate,
as on a large cluster."""

import re

import pytest

from fleetbook.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython",
             "ArrowEvalPython", "Window", "CollectLimit")


@pytest.fixture()
def no_static_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_slow_operators(no_static_broadcast, name):
    plan = physical(QUERIES[name](no_static_broadcast, SF))
    for op in FORBIDDEN:
        assert op not in plan, (name, op)
    # sort-based aggregation only for a global aggregate (no grouping keys)
    for keys in re.findall(r"SortAggregate\(key=\[([^\]]*)\]", plan):
        assert keys == "", (name, keys)
    # NOT IN never becomes the null-aware broadcast anti join
    assert "BroadcastHashJoin" not in plan or ", true" not in "".join(
        re.findall(r"BroadcastHashJoin .*LeftAnti.*", plan)), name


def test_pushdown_and_pruning(spark):
    plan = physical(QUERIES["filter_price"](spark, SF))
    assert "PushedFilters: [IsNotNull(p_retailprice), GreaterThan(p_retailprice,985.0)]" in plan
    assert "ReadSchema: struct<p_partkey:bigint,p_retailprice:double>" in plan
    plan = physical(QUERIES["filter_overdue"](spark, SF))
    assert "o_orderpriority" not in plan.split("ReadSchema:")[1].split("\n")[0]


@pytest.mark.parametrize("name", ["filter_overdue", "filter_overdue_today", "settle_due", "settle_offers"])
def test_status_filter_reaches_the_reader(spark, name):
    assert "EqualTo(o_orderstatus,O)" in physical(QUERIES[name](spark, SF))


def test_status_filter_of_written_sides_reaches_the_reader(spark, monkeypatch):
    """Queries that write the filtered side first: its own plan."""
    from fleetbook.plans import materialize

    seen, write = [], materialize.write_counted
    monkeypatch.setattr(materialize, "write_counted",
                        lambda df, *a: (seen.append(physical(df)), write(df, *a))[1])
    for name in ("overdue_lookup", "overdue_report", "settle_cars"):
        seen.clear()
        QUERIES[name](spark, SF)
        assert any("EqualTo(o_orderstatus,O)" in p for p in seen), name


def test_price_reservations_joins_the_cars_once(no_static_broadcast):
    plan = physical(QUERIES["price_reservations"](no_static_broadcast, SF))
    assert plan.count("part.parquet") == 1


def test_hot_promo_code_never_shuffles_reservations(no_static_broadcast):
    """Five promo codes key all orders: the orders must reach the code level
    only through partial aggregates or broadcast joins."""
    for name in ("price_total", "one_time_promo", "promo_usage", "expire_offers"):
        plan = physical(QUERIES[name](no_static_broadcast, SF))
        for m in re.finditer(r"Exchange hashpartitioning\(promo_code#\d+, \d+\)", plan):
            below = [ln.strip(" :+-") for ln in plan[m.end():].split("\n")[1:]]
            node = next(ln for ln in below if not ln.startswith(("Project", "Filter")))
            assert node.startswith(("HashAggregate", "LocalTableScan")), (name, node)


def test_not_in_plan_has_no_forced_broadcast(no_static_broadcast):
    from fleetbook.plans.joins import null_aware_anti_join

    plan = physical(QUERIES["users_without_exact_payment"](no_static_broadcast, SF))
    assert "LeftAnti" in plan and "Subquery" in plan
    # the anti join is never Spark's null-aware variant (last flag of the node)
    assert not re.search(r"BroadcastHashJoin [^\n]*LeftAnti[^\n]*, true\n", plan)
    # without materializing, a list of unknown size stays a sort-merge join
    spark = no_static_broadcast
    left = spark.read.parquet(f"{SF}/customer.parquet")
    right = spark.read.parquet(f"{SF}/orders.parquet")
    plain = physical(null_aware_anti_join(left, right, "c_custkey", "o_custkey",
                                          materialize_right=False))
    assert "SortMergeJoin" in plain and "LeftAnti" in plain


def test_not_in_list_state_is_one_subquery(no_static_broadcast):
    plan = physical(QUERIES["users_without_exact_payment"](no_static_broadcast, SF))
    assert len(set(re.findall(r"Subquery subquery#(\d+)", plan))) == 1

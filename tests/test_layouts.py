"""Tables laid out for their joins and updates: buckets, months, loads,
footers, run-time filters; each with the plan that the layout is for."""

import datetime as dt
import glob
import os
import re
import tempfile
import uuid
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetbook import jobs
from fleetbook.operators import queries, settlement
from fleetbook.plans import runtime_filters, statistics
from fleetbook.registry import QUERIES
from fleetbook.sources import bucketed, catalog, partitioned
from fleetbook.streaming.state import settings

SF = "/root/testdata/sf0.001"
RES = "reservation_id long, status string, tot_amount decimal(12,2), start_date date, license_no string"
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
SMALL_BLOOM = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def folder():
    return tempfile.mkdtemp(prefix="fb-layout-", dir="/tmp")


@pytest.fixture()
def rental(spark):
    """2,000 reservations over ten months, every 200th open, and three payments each."""
    n = F.col("id")
    res = spark.range(2000).select(
        n.alias("reservation_id"), F.when(n % 200 == 0, "Reserved").otherwise("Completed").alias("status"),
        (n + 1).cast("decimal(12,2)").alias("tot_amount"),
        F.date_add(F.lit(dt.date(2024, 1, 5)), (n % 300).cast("int")).alias("start_date"),
        F.concat(F.lit("L"), n % 7).alias("license_no"))
    pay = spark.range(6000).select((n % 2000).alias("reservation_id"), n.alias("pid"),
                                   ((n % 2000) / 3 + 1).cast("decimal(12,2)").alias("amount_paid"))
    base = folder()
    res.write.parquet(f"{base}/res")
    pay.write.parquet(f"{base}/pay")
    return spark.read.parquet(f"{base}/res"), spark.read.parquet(f"{base}/pay")


# ------------------------------------------------------------ run-time filters

def shuffled_bytes(df):
    """Bytes written by the exchanges of the final plan."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName() == "Exchange":
            total += node.metrics().apply("shuffleBytesWritten").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return total


def test_few_open_reservations_prune_the_payments(spark, rental):
    res, pay = rental
    with settings(spark, {**NO_BROADCAST, **SMALL_BLOOM}):
        due = settlement.due_reservations(res, pay, few_open=None)
        text = plan(due)
        assert re.search(r"Filter \(.*might_contain.*\n.*", text), text
        at = text.index("might_contain")
        assert "pid" not in text and "pay" in text[at:]          # it filters the payment scan
        done = settlement.settle_reservations(res, pay, few_open=None)
        pruned = shuffled_bytes(due)
        with_filter, settled = rows(due), rows(done)
    off = {"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}
    with settings(spark, {**NO_BROADCAST, **off}):
        plain = settlement.due_reservations(res, pay)
        assert "might_contain" not in plan(plain)
        whole = shuffled_bytes(plain)
        assert with_filter == rows(plain) and settled == rows(settlement.settle_reservations(res, pay))
    assert pruned < whole / 3, (pruned, whole)


def test_settling_few_finds_them_with_the_filter(spark, rental, monkeypatch):
    from fleetbook.plans import materialize

    res, pay = rental
    seen, write = [], materialize.write_counted
    monkeypatch.setattr(materialize, "write_counted", lambda df, *a: (seen.append(plan(df)), write(df, *a))[1])
    with settings(spark, SMALL_BLOOM):
        done = settlement.settle_reservations(res, pay, few_open=None)
    assert any("might_contain" in p for p in seen)
    assert rows(done) == rows(settlement.settle_reservations(res, pay))


@pytest.mark.parametrize("name", ["settle_due", "settle_reservations"])
def test_registered_settlements_use_the_filter_when_few_are_open(spark, name, monkeypatch):
    """The same keys over a copy of the orders of which few are open."""
    from fleetbook.plans import materialize

    base = folder()
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    few_open = F.when(F.col("o_orderkey") % 40 == 0, "O").otherwise("F")
    orders.withColumn("o_orderstatus", few_open).write.parquet(f"{base}/orders.parquet")
    spark.read.parquet(f"{SF}/lineitem.parquet").write.parquet(f"{base}/lineitem.parquet")
    seen, write = [], materialize.write_counted
    monkeypatch.setattr(materialize, "write_counted", lambda df, *a: (seen.append(plan(df)), write(df, *a))[1])
    with settings(spark, {**NO_BROADCAST, **SMALL_BLOOM}):
        df = QUERIES[name](spark, base)
        assert any("might_contain" in p for p in [*seen, plan(df)])
        got = rows(df)
    with settings(spark, {"spark.sql.optimizer.runtime.bloomFilter.enabled": "false"}):
        monkeypatch.setattr(runtime_filters, "FEW_ROWS", 0)
        assert got == rows(QUERIES[name](spark, base))


def test_few_counts_rows_and_shares(spark, monkeypatch):
    df = spark.range(100)
    assert runtime_filters.few(df, F.col("id") < 10)
    assert not runtime_filters.few(df, F.col("id") < 11)
    monkeypatch.setattr(runtime_filters, "FEW_ROWS", 5)
    assert not runtime_filters.few(df, F.col("id") < 10)
    assert runtime_filters.few(df.limit(0), F.lit(True))


def test_bloom_settings_build_a_filter_for_the_keys(spark, rental):
    res, pay = rental
    with settings(spark, {**runtime_filters.bloom_settings(5_000_000), **SMALL_BLOOM}):
        assert "might_contain" in plan(settlement.due_reservations(res, pay, few_open=True))


# -------------------------------------------------------------------- buckets

@pytest.mark.parametrize("name", ["join_payments_bucketed", "cap_payment_bucketed", "settle_due_bucketed"])
def test_bucketed_joins_have_no_exchange(spark, name):
    with settings(spark, NO_BROADCAST):
        text = plan(QUERIES[name](spark, SF))
    assert "Exchange" not in text and "SortMergeJoin" in text and "Bucketed: true" in text


def test_a_bucket_that_holds_far_more_is_read_as_plain_files(spark, monkeypatch):
    monkeypatch.setattr(bucketed, "LEAST_SKEWED", 1)
    n = F.col("id")
    even = spark.range(4000).select(n.alias("k"), n.alias("v"))
    hot = spark.range(4000).select(F.when(n < 3000, 7).otherwise(n).alias("k"), F.xxhash64("id").alias("v"))
    for df, expected in ((even, True), (hot, False)):
        table = f"fb_test_{uuid.uuid4().hex[:8]}"
        path = bucketed.write_bucketed(df, table, "k", 8, f"{folder()}/t")
        got = bucketed.read_bucketed(spark, table, path)
        assert ("Bucketed: true" in plan(got.groupBy("k").count())) is expected
        assert rows(got) == rows(df)
        bucketed.write_bucketed(df, table, "k", 8, path)   # a retry replaces it
        assert spark.table(table).count() == 4000
        spark.sql(f"DROP TABLE {table}")


def test_bucket_counts():
    assert bucketed.bucket_count(0, 4) == 8
    assert bucketed.bucket_count(100 << 40, 4000) == 1 << 19


# --------------------------------------------------------------------- months

def files(path):
    return {f: (os.path.getmtime(f), os.path.getsize(f)) for f in glob.glob(f"{path}/*/*.parquet")}


def month_table(spark, res, payments=False):
    path = f"{folder()}/reservation"
    partitioned.write_by_month(res, path, "start_date", "start_month")
    return path


def test_settling_writes_only_months_with_a_due_row(spark, rental):
    res, pay = rental
    pay = pay.where("reservation_id in (0, 400)")     # the only ones paid in full
    due = settlement.due_reservations(res, pay.union(pay.select("reservation_id", "pid", F.lit(10**6).cast("decimal(12,2)"))))
    every = pay.union(pay.select("reservation_id", "pid", F.lit(10**6).cast("decimal(12,2)")))
    expected = rows(settlement.settle_reservations(res, every))
    path = month_table(spark, res)
    before = files(path)
    touched = jobs.settle_partitions(spark, path, "start_month", every)
    months = {r[0] for r in due.select(partitioned.month_of("start_date")).collect()}
    assert set(touched) == months and 0 < len(months) < 10
    after = files(path)
    kept = {f for f in before if not any(f"start_month={m}/" in f for m in months)}
    assert kept and all(after.get(f) == before[f] for f in kept)
    assert not any(f in after for f in set(before) - kept)
    assert rows(spark.read.parquet(path).select(res.columns)) == expected
    assert jobs.settle_partitions(spark, path, "start_month", every) == []   # nothing left to do
    assert files(path) == after


def test_a_replacement_cut_short_is_finished_or_undone(spark, rental, monkeypatch):
    res, _ = rental
    path = month_table(spark, res)
    change = spark.read.parquet(path).where("start_month = 202403").withColumn("status", F.lit("Moved"))
    expected = rows(spark.read.parquet(path).withColumn(
        "status", F.when(F.col("start_month") == 202403, "Moved").otherwise(F.col("status"))))
    original = rows(spark.read.parquet(path))
    # dies before the copy is complete: the table is as it was
    change.write.partitionBy("start_month").parquet(path + "_pending")
    partitioned.recover(spark, path, "start_month")
    assert rows(spark.read.parquet(path)) == original and not os.path.exists(path + "_pending")
    # dies after: the next job finishes it, even when the month's files are gone
    real = partitioned.recover
    monkeypatch.setattr(partitioned, "recover", lambda *a: None)
    partitioned.replace_partitions(change, path, "start_month")
    for f in glob.glob(f"{path}/start_month=202403/*"):
        os.remove(f)
    monkeypatch.setattr(partitioned, "recover", real)
    assert partitioned.update_partitions(spark, path, "start_month", lambda t: t.limit(0), lambda t: t) == []
    assert rows(spark.read.parquet(path)) == expected and not os.path.exists(path + "_pending")


def test_cascade_deletes_touch_only_months_that_lose_rows(spark, rental):
    res, pay = rental
    parent, child = month_table(spark, res), f"{folder()}/payment"
    partitioned.write_by_month(pay.join(res.select("reservation_id", "start_date"), "reservation_id"), child,
                               "start_date", "start_month")
    before = files(child)
    gone = F.col("start_date").between(dt.date(2024, 2, 1), dt.date(2024, 2, 29)) | (F.col("reservation_id") == 100)
    expected = rows(res.where(~gone).select("reservation_id"))
    in_parent, in_child = jobs.cascade_delete_partitions(spark, parent, child, "start_month", lambda t: t.where(gone))
    assert in_parent == in_child and 202402 in in_parent and len(in_parent) == 2
    assert rows(spark.read.parquet(parent).select("reservation_id")) == expected
    left = spark.read.parquet(child)
    assert rows(left.select("reservation_id").distinct()) == expected and left.count() == 3 * len(expected)
    assert not glob.glob(f"{child}/start_month=202402/*")
    same = [f for f in before if not any(f"start_month={m}/" in f for m in in_child)]
    assert same and all(files(child).get(f) == before[f] for f in same)
    assert jobs.cascade_delete_partitions(spark, parent, child, "start_month", lambda t: t.where(gone)) == ([], [])


def test_months_prune_the_folders_read(spark):
    with settings(spark, {}):
        text = plan(QUERIES["filter_overdue_by_month"](spark, SF))
    assert re.search(r"PartitionFilters: \[[^\]]*end_date_month#\d+ <= 199601", text), text
    n_months = len({r[0] for r in spark.read.parquet(f"{SF}/orders.parquet").select(
        partitioned.month_of(F.to_date("o_orderdate"))).distinct().collect()})
    df = QUERIES["filter_overdue_by_month"](spark, SF)
    read = {re.search(r"end_date_month=(\d+)", f)[1] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}
    assert read and all(int(m) <= 199601 for m in read) and len(read) < n_months


def test_months_are_pruned_by_the_other_side_at_run_time(spark):
    df = QUERIES["payments_of_due_months"](spark, SF)
    assert "dynamicpruning" in plan(df)
    df.collect()
    todo, partitions = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        if node.nodeName().startswith("Scan parquet") and node.metrics().contains("numPartitions"):
            partitions.append(node.metrics().apply("numPartitions").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    assert partitions == [1]


def test_rows_without_a_date_have_a_folder_of_their_own(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 5, 9)), (2, None), (3, dt.date(2024, 12, 31))], "id int, d date")
    path = f"{folder()}/t"
    partitioned.write_by_month(df, path, "d", "m")
    table = spark.read.parquet(path)
    assert rows(table.select("id", "m")) == [(1, 202405), (2, 0), (3, 202412)]
    assert rows(partitioned.between_months(table, "m", dt.date(2024, 6, 1)).select("id")) == [(3,)]
    assert rows(partitioned.between_months(table, "m", hi=dt.date(2024, 5, 1)).select("id")) == [(1,)]


# ---------------------------------------------------------------------- loads

def test_a_load_repeated_replaces_its_own_rows(spark):
    path = f"{folder()}/t"
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])

    def load(values, name):
        partitioned.append_load(spark.createDataFrame(values, schema), path, name)

    load([(1, "a"), (2, "b")], "monday")
    load([(3, "c")], "tuesday")
    first = files(path)
    load([(3, "c")], "tuesday")
    assert rows(partitioned.read_loads(spark, path, schema)) == [(1, "a"), (2, "b"), (3, "c")]
    load([(4, "d")], "tuesday")
    assert rows(partitioned.read_loads(spark, path, schema, ["tuesday"])) == [(4, "d")]
    load([], "tuesday")
    assert rows(partitioned.read_loads(spark, path, schema)) == [(1, "a"), (2, "b")]
    assert {f: s for f, s in first.items() if "monday" in f} == files(path)
    assert schema.fieldNames() == ["id", "v"]
    with pytest.raises(ValueError):
        load([(1, "a")], "a/b")


# -------------------------------------------------------------------- footers

def test_maximum_comes_from_the_footers(spark):
    path = f"{SF}/orders.parquet"
    schema = spark.read.parquet(path).schema
    assert "PushedAggregation: [MAX(o_totalprice)]" in plan(statistics.footer_max(spark, path, schema, "o_totalprice"))
    found = statistics.rows_at_maximum(spark, path, schema, "o_totalprice")
    assert "GreaterThanOrEqual(o_totalprice" in plan(found)
    assert "useV1SourceList" not in str(spark.conf.get("spark.sql.sources.useV1SourceList"))


def test_maximum_with_ties_nulls_and_no_rows(spark):
    schema = "id int, x double"
    cases = [([(1, 5.0), (2, None), (3, 5.001), (4, 4.99)], [1, 3]), ([(1, None), (2, None)], []), ([], []),
             ([(1, -3.0), (2, -3.0)], [1, 2]), ([(1, 1.0), (2, 7.25), (3, 7.25)], [2, 3])]
    for values, expected in cases:
        path = f"{folder()}/t"
        spark.createDataFrame(values, schema).repartition(3).write.parquet(path)
        table = spark.read.parquet(path)
        got = statistics.rows_at_maximum(spark, path, table.schema, "x")
        assert rows(got.select("id")) == [(i,) for i in expected]


def test_files_without_statistics_are_scanned(spark):
    path = f"{folder()}/t"
    (spark.createDataFrame([(1, 2.0), (2, 9.0)], "id int, x double").write
     .option("parquet.column.statistics.enabled", "false").parquet(path))
    assert statistics.column_max(spark, path, spark.read.parquet(path).schema, "x") == 9.0


# -------------------------------------------------------------- SQL functions

def test_sql_functions_equal_the_operators(spark, seed):
    from fleetbook.operators import pricing

    catalog.register_frames(seed)
    made = catalog.register_functions(spark)
    assert {"late_fee", "rental_price", "total_after_offer", "raise_rates", "overdue_on", "due_reservations"} <= set(made)
    for pct in (D("10"), D("7.5"), D("0")):
        raised = settlement.raise_rates(seed["car_insurance"], pct).select("car_type", "insurance_type", "insurance_price")
        assert rows(spark.sql(f"SELECT * FROM raise_rates({pct})")) == rows(raised)
    as_of = dt.date(2018, 1, 1)
    late = queries.overdue_reservations(seed["reservation"], as_of).select("reservation_id", "license_no", "end_date")
    assert rows(spark.sql(f"SELECT * FROM overdue_on(DATE '{as_of}')")) == rows(late)
    due = settlement.due_reservations(seed["reservation"], seed["payment"]).select("reservation_id", "tot_amount")
    assert rows(spark.sql("SELECT * FROM due_reservations()")) == rows(due)
    fee = spark.sql("SELECT reservation_id, late_fee(end_date, actual_end_date, CAST(penalty_amount AS DECIMAL(12,2))) AS f "
                    "FROM reservation")
    assert rows(fee) == rows(pricing.penalty_amount(seed["reservation"]).select("reservation_id", "penalty_amount"))


def test_total_after_offer_in_sql(spark):
    from fleetbook.operators.pricing import total_after_offer

    catalog.register_functions(spark)
    cases = [(D("200.00"), D("10"), None, True), (D("200.00"), None, D("25"), True), (D("200.00"), D("10"), D("25"), True),
             (D("200.00"), D("10"), None, False), (D("200.00"), None, None, True), (D("200.00"), None, None, None),
             (None, D("10"), D("25"), True), (D("99.99"), D("33.33"), None, True)]
    df = spark.createDataFrame(cases, "b decimal(20,2), p decimal(5,2), d decimal(8,2), a boolean")
    cols = [F.col(c) for c in "bpda"]
    df.createOrReplaceTempView("fb_totals")
    got = spark.sql("SELECT total_after_offer(b, p, d, a) AS t FROM fb_totals").collect()
    assert got == df.select(total_after_offer(*cols).cast("decimal(12,2)").alias("t")).collect()
    assert [r[0] for r in got] == [D("180.00"), D("175.00"), D("180.00"), D("200.00"), None, D("200.00"), None, D("66.66")]


def test_a_filter_asked_of_a_table_function_reaches_the_reader(spark):
    path = f"{folder()}/r"
    spark.createDataFrame([(1, "Reserved", D(5), dt.date(2024, 1, 1), "L")], RES).withColumn(
        "end_date", F.col("start_date")).withColumn("actual_end_date", F.lit(None).cast("date")).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("fb_res")
    catalog.register_functions(spark, {"reservation": "fb_res"})
    with settings(spark, {"spark.sql.maxMetadataStringLength": "5000"}):
        text = plan(spark.sql("SELECT reservation_id FROM overdue_on(DATE '2024-02-01') WHERE reservation_id > 5"))
    assert "GreaterThan(reservation_id,5)" in text and "tot_amount" not in text


# ------------------------------------------------------- a folder settled in place

def _settled_folder(spark, seed, src):
    """The seed tables, reservations and cars in partitions."""
    parted = {"reservation": ("start_month", partitioned.month_of("start_date")), "car": ("kind", F.col("car_type"))}
    for name, df in seed.items():
        path = f"{src}/{name}.parquet"
        if name in parted:
            part, value = parted[name]
            df.withColumn(part, value).write.partitionBy(part).parquet(path)
        else:
            df.write.parquet(path)


def test_settling_a_folder_in_place_equals_the_whole_rewrite(spark, seed, monkeypatch):
    expected = settlement.settle(seed["reservation"], seed["payment"], seed["offer_details"], seed["car"])
    parts = {"reservation": "start_month", "car": "kind"}
    src = folder()
    _settled_folder(spark, seed, src)
    before = {n: files(f"{src}/{n}.parquet") for n in ("reservation", "car")}
    # dies when the offers and cars are done and the reservations are not: run again
    real, seen = partitioned.update_partitions, []

    def dies(spark, path, *a):
        if "reservation" in path and not seen:
            seen.append(path)
            raise RuntimeError("lost")
        return real(spark, path, *a)

    monkeypatch.setattr(partitioned, "update_partitions", dies)
    with pytest.raises(RuntimeError):
        jobs.settle_in_place(spark, src, parts)
    written = jobs.settle_in_place(spark, src, parts)
    assert written["reservation"] and written["car"]
    for name, df in expected.items():
        assert rows(spark.read.parquet(f"{src}/{name}.parquet").select(df.columns)) == rows(df), name
    for name in before:
        n_parts = {os.path.dirname(f) for f in before[name]}
        kept = {f: s for f, s in before[name].items()
                if not any(f"{parts[name]}={v}/" in f for v in written[name])}
        assert len(written[name]) < len(n_parts) and kept
        assert {f: files(f"{src}/{name}.parquet").get(f) for f in kept} == kept
    assert jobs.settle_in_place(spark, src, parts) == {"offer_details": [], "car": [], "reservation": []}


def test_command_line_loads_and_settles_in_place(spark, seed):
    from fleetbook.cli import main
    from fleetbook.sources.schemas import SCHEMAS

    base = folder()
    seed["payment"].write.parquet(f"{base}/new")
    for _ in range(2):   # a retried append
        main(["append", "--src", f"{base}/new", "--dst", f"{base}/loads", "--table", "payment", "--load", "day-1"], spark)
    got = partitioned.read_loads(spark, f"{base}/loads/payment.parquet", SCHEMAS["payment"])
    assert rows(got) == rows(seed["payment"].select(got.columns))
    src = f"{base}/tables"
    _settled_folder(spark, seed, src)
    main(["settle-in-place", "--src", src, "--reservation-part", "start_month", "--car-part", "kind"], spark)
    expected = settlement.settle(seed["reservation"], seed["payment"], seed["offer_details"], seed["car"])["reservation"]
    assert rows(spark.read.parquet(f"{src}/reservation.parquet").select(expected.columns)) == rows(expected)

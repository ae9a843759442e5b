"""Stream jobs: same rows as the batch transform, and a restart from the
checkpoint writes nothing twice."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetbook.functions.scalars import money
from fleetbook.operators.pricing import cap_payment
from fleetbook.streaming import payments, promos

SF = "/root/testdata/sf0.001"


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_capped_stream_equals_batch_and_restarts_cleanly(spark):
    base = tempfile.mkdtemp(prefix="fb-stream-", dir="/tmp")
    src = os.path.join(base, "src")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    ev.where("event_id % 2 = 0").write.parquet(src, mode="append")
    totals = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").alias("reservation_id"), money("c_acctbal").alias("tot_amount"))

    def pay(df):
        return df.select("event_id", F.col("user_id").alias("reservation_id"),
                         money("value").alias("amount_paid"))

    def run():
        stream = pay(spark.readStream.schema(ev.schema).parquet(src))
        q = payments.start_to_parquet(payments.capped_payments(stream, totals),
                                      f"{base}/out", f"{base}/ckpt")
        q.awaitTermination()

    run()
    first = spark.read.parquet(f"{base}/out").count()
    run()   # nothing new: restart from the checkpoint adds nothing
    assert spark.read.parquet(f"{base}/out").count() == first
    ev.where("event_id % 2 = 1").write.parquet(src, mode="append")
    run()   # the second file is picked up once
    got = spark.read.parquet(f"{base}/out")
    expect = cap_payment(pay(ev), totals)
    assert _sorted(got.select(*expect.columns)) == _sorted(expect)


def test_one_time_offer_batches_follow_arrival_order(spark):
    base = tempfile.mkdtemp(prefix="fb-promo-", dir="/tmp")
    src = os.path.join(base, "src")
    ev = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "ts", "event_type")
    handler = promos.OneTimeOfferUse(f"{base}/out", f"{base}/state", ["ts"], key="event_id",
                                     code="event_type")
    cut = ev.agg(F.expr("percentile_approx(ts, 0.5)")).first()[0]
    for part in (ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)):
        part.write.parquet(src, mode="append")
        promos.run_batches(spark.readStream.schema(ev.schema).parquet(src), handler,
                           f"{base}/ckpt")
    # a restart with no new files changes nothing
    promos.run_batches(spark.readStream.schema(ev.schema).parquet(src), handler, f"{base}/ckpt")
    out = spark.read.parquet(f"{base}/out")
    assert out.count() == ev.count()
    firsts = out.where("promo_available = 1").select("event_type", "event_id")
    ev.createOrReplaceTempView("ev_promo")
    expect = spark.sql("select event_type, min_by(event_id, struct(ts, event_id)) "
                       "from ev_promo group by event_type")
    assert _sorted(firsts) == _sorted(expect)


def test_one_time_offer_stream_with_offer_table(spark):
    from fleetbook.sources.tables import rows_frame
    from pyspark.sql import types as T

    base = tempfile.mkdtemp(prefix="fb-promo2-", dir="/tmp")
    src = os.path.join(base, "src")
    schema = "rid bigint, day int, code string"
    offers = rows_frame(spark, [("A", "Y", "Available"), ("B", "N", "Available"),
                                ("C", "Y", "Expired")],
                        T.StructType([T.StructField("code", T.StringType()),
                                      T.StructField("is_one_time", T.StringType()),
                                      T.StructField("status", T.StringType())]))
    handler = promos.OneTimeOfferUse(f"{base}/out", f"{base}/state", ["day"], key="rid",
                                     code="code", offers=offers)
    batches = [[(1, 5, "A"), (2, 3, "A"), (3, 1, "B"), (4, 1, "C"), (5, 1, "D")],
               [(6, 0, "A"), (7, 9, "B"), (8, 2, "C")]]
    for rows_ in batches:
        spark.createDataFrame(rows_, schema).write.parquet(src, mode="append")
        promos.run_batches(spark.readStream.schema(schema).parquet(src), handler, f"{base}/ckpt")
    got = dict(tuple(r) for r in spark.read.parquet(f"{base}/out").select(
        "rid", "promo_available").collect())
    # A: the earliest of the first batch wins; the later batch sees it used up
    assert got == {1: 0, 2: 1, 3: 1, 4: 0, 5: 0, 6: 0, 7: 1, 8: 0}


def test_priced_rentals_stream_equals_batch(spark, seed):
    from fleetbook.operators.pricing import car_prices, insurance_amount, penalty_amount, rent_amount

    base = tempfile.mkdtemp(prefix="fb-price-", dir="/tmp")
    src = os.path.join(base, "src")
    res = seed["reservation"]
    res.write.parquet(src)
    prices = car_prices(seed["car"], seed["car_type"])
    types = seed["car"].select("vin", "car_type")
    cars = types.join(prices.select("vin", "price_per_day"), "vin")
    stream = spark.readStream.schema(res.schema).parquet(src)
    q = payments.start_to_parquet(payments.priced_rentals(stream, cars, seed["car_insurance"]),
                                  f"{base}/out", f"{base}/ckpt")
    q.awaitTermination()
    writer = payments.PricedRentalWriter(cars, seed["car_insurance"], f"{base}/out2")
    payments.run_foreach_batch(stream, writer, f"{base}/ckpt2")
    expect = insurance_amount(rent_amount(penalty_amount(res), prices), types,
                              seed["car_insurance"])
    cols = ["reservation_id", "penalty_amount", "rental_amount", "insurance_amount"]
    for out in ("out", "out2"):
        assert _sorted(spark.read.parquet(f"{base}/{out}").select(*cols)) == _sorted(expect.select(*cols))


def test_capped_payment_writer_matches_batch_and_replays_safely(spark):
    base = tempfile.mkdtemp(prefix="fb-capw-", dir="/tmp")
    src = os.path.join(base, "src")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    totals = spark.read.parquet(f"{SF}/customer.parquet").select(
        F.col("c_custkey").alias("reservation_id"), money("c_acctbal").alias("tot_amount"))

    def pay(df):
        return df.select("event_id", F.col("user_id").alias("reservation_id"),
                         money("value").alias("amount_paid"))

    writer = payments.CappedPaymentWriter(totals, f"{base}/out")
    ev.where("event_id % 2 = 0").write.parquet(src, mode="append")
    payments.run_foreach_batch(pay(spark.readStream.schema(ev.schema).parquet(src)), writer,
                               f"{base}/ckpt")
    ev.where("event_id % 2 = 1").write.parquet(src, mode="append")
    payments.run_foreach_batch(pay(spark.readStream.schema(ev.schema).parquet(src)), writer,
                               f"{base}/ckpt")
    # a retried batch rewrites its own folder: run batch 1 again by hand
    writer(pay(ev.where("event_id % 2 = 1")), 1)
    got = spark.read.parquet(f"{base}/out").select("event_id", "reservation_id", "amount_paid")
    expect = cap_payment(pay(ev), totals).select("event_id", "reservation_id", "amount_paid")
    assert _sorted(got) == _sorted(expect)


def test_replay_in_time_slices_feeds_every_row_once(spark):
    import datetime as dt

    base = tempfile.mkdtemp(prefix="fb-slices-", dir="/tmp")
    rows_ = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(20)]
    rows_ += [(100, None), (101, None)]
    table = spark.createDataFrame(rows_, "id bigint, ts timestamp_ntz")
    seen = []

    def after(i):
        seen.append((i, spark.read.parquet(f"{base}/src").count()))

    promos.replay_in_time_slices(table, "ts", 4, f"{base}/src", after)
    assert [i for i, _ in seen] == [0, 1, 2, 3]
    assert seen[-1][1] == 22
    got = sorted(r[0] for r in spark.read.parquet(f"{base}/src").collect())
    assert got == sorted(r[0] for r in rows_)


def _arrivals(spark, base, payments, reservations, **kw):
    """The stream over two folders, run until what has arrived is done."""
    from fleetbook.streaming import arrivals, state

    schema_p, schema_r = "pid long, reservation_id long, amount_paid decimal(12,2), paid_at timestamp", \
        "reservation_id long, tot_amount decimal(12,2), made_at timestamp"
    for name, rows, schema in (("p", payments, schema_p), ("r", reservations, schema_r)):
        if rows is not None:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
    out = arrivals.capped_on_arrival(
        spark.readStream.schema(schema_p).parquet(f"{base}/p"), spark.readStream.schema(schema_r).parquet(f"{base}/r"),
        pay_time="paid_at", res_time="made_at", wait="10 days", delay="2 days", **kw)
    state.finish(state.start_with_state(
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
        .trigger(availableNow=True), spark))
    return sorted((r[0], r[2]) for r in spark.read.schema(schema_p).parquet(f"{base}/out").collect())


def test_payment_before_its_reservation_is_capped_when_that_comes(spark):
    import datetime as dt
    from decimal import Decimal as D

    def day(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    base = tempfile.mkdtemp(prefix="fb-arrive-", dir="/tmp")
    early = [(1, 7, D(90), day(3)), (2, 8, D(5), day(3)), (3, 99, D(50), day(1))]
    assert _arrivals(spark, base, early, [(5, D(1), day(2))], salt_by="pid") == []   # all wait for their reservations
    got = _arrivals(spark, base, [(4, 7, D(10), day(5)), (5, 7, D(70), day(5))],
                    [(7, D(60), day(4)), (8, D(60), day(5))], salt_by="pid")
    assert got == [(1, D(60)), (2, D(5)), (4, D(10)), (5, D(60))]   # a restart in between, capped when it came
    # the watermark passes the time in which 99 might have come: handed on as it is
    got = _arrivals(spark, base, [(6, None, None, day(400))], [(-1, None, day(400))], salt_by="pid")
    assert got == [(1, D(60)), (2, D(5)), (3, D(50)), (4, D(10)), (5, D(60))]


def test_late_payments_are_capped_in_batch_and_none_is_lost(spark):
    import datetime as dt
    from decimal import Decimal as D

    from fleetbook.streaming.arrivals import missing_payments

    def day(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    base = tempfile.mkdtemp(prefix="fb-late-", dir="/tmp")
    _arrivals(spark, base, [(1, 7, D(90), day(100))], [(7, D(60), day(100)), (8, D(60), day(100))])
    _arrivals(spark, base, [(2, 8, D(90), day(102))], [(9, D(1), day(102))])
    late = [(3, 8, D(80), day(1)), (4, 8, D(80), None), (5, None, D(80), day(102)), (6, 55, D(80), day(2))]
    got = _arrivals(spark, base, late, [(10, D(1), day(103))])
    assert got == [(1, D(60)), (2, D(60))]   # 5 has no key and waits until the watermark has passed
    every = spark.read.parquet(f"{base}/p")
    rest = missing_payments(every, spark.read.parquet(f"{base}/out"), spark.read.parquet(f"{base}/r"), ["pid"])
    assert sorted((r[0], r[2]) for r in rest.collect()) == [(3, D(60)), (4, D(60)), (5, D(80)), (6, D(80))]


def _uses(spark, base, rows=None, offers=None):
    from fleetbook.streaming import first_uses, state

    schema = "id long, day int, code string, note string"
    if rows:
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{base}/src")
    stream = spark.readStream.schema(schema).parquet(f"{base}/src")
    if offers is None:
        out = first_uses.first_uses(stream, key="id", code="code", order_by=["day"])
    else:
        out = first_uses.offer_uses(stream, offers, key="id", code="code", order_by=["day"])
    state.finish(state.start_with_state(
        out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
        .trigger(availableNow=True), spark))
    return {r["id"]: r["promo_available"] for r in spark.read.parquet(f"{base}/out").collect()}


def test_first_uses_in_keyed_state(spark):
    base = tempfile.mkdtemp(prefix="fb-uses-", dir="/tmp")
    first = [(5, 2, "A", "x"), (3, 1, "A", "y"), (4, 1, "A", None), (6, None, "B", "x"), (7, 9, "B", "x"),
             (8, 1, None, "x"), (9, None, "C", "x")]
    assert _uses(spark, base, first) == {5: 0, 3: 1, 4: 0, 6: 0, 7: 1, 8: 0, 9: 1}
    again = _uses(spark, base)   # a restart with nothing new
    assert again == {5: 0, 3: 1, 4: 0, 6: 0, 7: 1, 8: 0, 9: 1}
    got = _uses(spark, base, [(1, 0, "A", "x"), (2, 0, "D", "x"), (10, 1, "D", "x")])   # earlier, but a later batch
    assert got == {**again, 1: 0, 2: 1, 10: 0}


def test_first_uses_by_offer_terms(spark):
    from pyspark.sql import types as T

    from fleetbook.sources.tables import rows_frame

    offers = rows_frame(spark, [("A", "Y", "Available"), ("B", "N", "Available"), ("C", "Y", "Expired")],
                        T.StructType([T.StructField(c, T.StringType()) for c in ("code", "is_one_time", "status")]))
    base = tempfile.mkdtemp(prefix="fb-uses2-", dir="/tmp")
    rows = [(1, 1, "A", ""), (2, 2, "A", ""), (3, 1, "B", ""), (4, 2, "B", ""), (5, 1, "C", ""), (6, 1, "Z", "")]
    assert _uses(spark, base, rows, offers) == {1: 1, 2: 0, 3: 1, 4: 1, 5: 0, 6: 0}


def test_state_written_per_batch_does_not_grow_with_the_codes_used(spark):
    import glob

    base = tempfile.mkdtemp(prefix="fb-uses3-", dir="/tmp")
    _uses(spark, base, [(i, 1, f"code-{i}-{'x' * 40}", "") for i in range(4000)])
    _uses(spark, base, [(5000, 1, "new", ""), (5001, 1, "code-7-" + "x" * 40, "")])

    def written(version):
        return sum(os.path.getsize(f) for f in glob.glob(f"{base}/ckpt/state/0/*/{version}.changelog"))

    assert 0 < written(2) < written(1) / 10


def test_a_hot_code_sends_one_row_per_run_to_the_state(spark):
    from fleetbook.streaming import first_uses

    rows = spark.range(30_000).select("id", F.lit(1).alias("day"), F.lit("hot").alias("code"))
    marked = first_uses._marked(rows.repartition(4), "code", ["day", "id"])
    assert marked.where(first_uses.CANDIDATE).count() <= 8


def test_rentals_are_priced_when_their_car_comes(spark):
    import datetime as dt
    from decimal import Decimal as D

    from fleetbook.sources.tables import rows_frame
    from fleetbook.streaming import arrivals, state
    from pyspark.sql import types as T

    def day(n):
        return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)

    base = tempfile.mkdtemp(prefix="fb-cars-", dir="/tmp")
    rental = ("rid long, vin string, insurance_type string, start_date date, end_date date, actual_end_date date, "
              "penalty_amount decimal(12,2), booked_at timestamp")
    car = "vin string, car_type string, price_per_day decimal(8,2), listed_at timestamp"
    rates = rows_frame(spark, [("S", "full", D("3.00"))], T.StructType([
        T.StructField("car_type", T.StringType()), T.StructField("insurance_type", T.StringType()),
        T.StructField("insurance_price", T.DecimalType(8, 2))]))

    def book(rid, vin, n, cover="full"):
        start, end = day(n).date(), day(n + 2).date()
        return rid, vin, cover, start, end, day(n + 3).date(), None, day(n)

    def run(rentals, cars):
        for name, values, schema in (("rentals", rentals, rental), ("cars", cars, car)):
            spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(f"{base}/{name}")
        priced = arrivals.priced_on_arrival(
            spark.readStream.schema(rental).parquet(f"{base}/rentals"), spark.readStream.schema(car).parquet(f"{base}/cars"),
            rates, rent_time="booked_at", car_time="listed_at", wait="10 days", delay="2 days", salt_by="rid")
        state.finish(state.start_with_state(
            priced.writeStream.format("parquet").option("path", f"{base}/out")
            .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True), spark))
        return spark.read.schema(priced.schema).parquet(f"{base}/out")

    assert run([book(1, "A", 3), book(2, "B", 3), book(3, "Z", 1)], [("Q", "S", D(9), day(2))]).count() == 0
    run([book(4, "A", 5, "none")], [("A", "S", D(10), day(4)), ("B", "M", D(20), day(5))])
    out = run([(5, None, None, None, None, None, None, day(400))], [("-", None, None, day(400))])
    run([book(6, "A", 1)], [("-", None, None, day(401))])   # late: not handed on by the stream
    got = {r.rid: (r.penalty_amount, r.rental_amount, r.insurance_amount) for r in out.collect()}
    assert got == {1: (D(50), D(30), D(9)), 2: (D(50), D(60), None), 3: (D(50), None, None), 4: (D(50), D(30), None)}
    every, cars = spark.read.parquet(f"{base}/rentals"), spark.read.parquet(f"{base}/cars").where("vin != '-'")
    rest = arrivals.missing_rentals(every, out, cars, rates, ["rid"])
    assert {r.rid: r.rental_amount for r in rest.collect()} == {5: None, 6: D(30)}

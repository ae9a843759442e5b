"""Seed goldens: results worked out by hand from the seed rows."""

import datetime as dt
from decimal import Decimal as D

from pyspark.sql import functions as F

from fleetbook.operators import integrity, pricing, queries, reports, settlement
from fleetbook.sources.schemas import (FOREIGN_KEYS, LENGTHS, PRIMARY_KEYS, UNIQUE_COLUMNS,
                                       cascade_order, not_null_columns)

AFTER = dt.date(2016, 1, 1)


def rows(df, *cols):
    return sorted(tuple(r) for r in (df.select(*cols) if cols else df).collect())


def test_users_without_exact_payment(seed):
    out = queries.users_without_exact_payment(seed["car_user"], seed["reservation"], seed["payment"])
    assert rows(out) == sorted([("Glenn", "Tucker"), ("Ron", "Harper"), ("Manoj", "Punwani")])


def test_join_payments(seed):
    out = queries.join_payments(seed["reservation"], seed["payment"])
    assert rows(out) == sorted([
        (1, D("129.65"), D("129.65")), (5, D("398.90"), D("300.00")), (5, D("398.90"), D("98.90")),
        (3, D("689.35"), D("689.35")), (4, D("114.90"), D("114.91"))])


def test_locations_with_cars(seed):
    out = queries.exists_in(seed["rental_location"], seed["car"], "rental_location_id",
                            "rental_location_id").select("phone")
    assert rows(out) == sorted([("9726031111",), ("9726032222",), ("9721903121",), ("721903121",)])


def test_reserved_models(seed):
    out = queries.exists_in(seed["car"], seed["reservation"], "vin", "vin").select("model")
    assert rows(out) == sorted([("Mazda3",), ("Toyota Camry",), ("BMW",), ("Acura MDX",),
                                ("Sienna",)])


def test_rented_types_over_price(seed):
    out = queries.rented_types_over_price(seed["car_type"], seed["car"], seed["reservation"], 85)
    assert rows(out) == sorted([("SUV", D("89.95")), ("MiniVan", D("109.95")),
                                ("Premium", D("149.95"))])


def test_max_and_top(seed):
    assert rows(queries.max_reservation(seed["reservation"])) == [(3, D("689.35"))]
    assert rows(queries.top_reservations(seed["reservation"])) == [(3, D("689.35"))]


def test_left_join_insurance(seed):
    out = queries.left_join_lookup(seed["car_insurance"], seed["insurance"],
                                   [("insurance_type", "insurance_type")])
    assert out.count() == 10 and len(out.columns) == 7
    assert out.where(F.col("insurance_type_r").isNull()).count() == 0


def test_settle(seed):
    res, pay = seed["reservation"], seed["payment"]
    due = settlement.due_reservations(res, pay)
    assert rows(due, "reservation_id") == [(3,)]
    out = settlement.settle(res, pay, seed["offer_details"], seed["car"])
    status = dict(rows(out["reservation"], "reservation_id", "status"))
    assert status == {1: "Completed", 2: "Completed", 3: "Completed", 4: "Completed",
                      5: "Completed"}
    assert rows(out["offer_details"], "promo_code", "status") == rows(
        seed["offer_details"], "promo_code", "status")
    cars = {r[0]: (r[1], r[2]) for r in rows(out["car"], "vin", "rental_location_id", "status")}
    assert cars["N892993994858292"] == (104, "Available")
    assert cars["R908891209418173"] == (103, "Unavailable")


def test_settle_reservations_both_inputs(seed):
    res, pay = seed["reservation"], seed["payment"]
    by_pay = settlement.settle_reservations(res, pay)
    by_due = settlement.settle_reservations(res, due=settlement.due_reservations(res, pay))
    assert rows(by_pay) == rows(by_due)
    assert by_pay.columns == res.columns


def test_settle_with_lineage_cut(seed):
    out = settlement.settle(seed["reservation"], seed["payment"], seed["offer_details"],
                            seed["car"], cut_lineage=True)
    assert rows(out["reservation"].where("status = 'Reserved'")) == []


def test_overdue_report_before_and_after_settle(seed):
    res, users = seed["reservation"], seed["car_user"]
    lines = rows(reports.overdue_report(res, users, as_of=AFTER), "line")
    assert lines == [("User Courtney  Rollins  whose email id is courtney.r@hotmail.com has not "
                      "returned the car with VIN N892993994858292.",)]
    settled = settlement.settle(res, seed["payment"], seed["offer_details"], seed["car"])
    assert reports.overdue_report(settled["reservation"], users, as_of=AFTER).count() == 0


def test_promo_usage_report(seed):
    out = reports.promo_usage_report(seed["offer_details"], seed["reservation"])
    assert rows(out, "line") == sorted([
        ("Promo Code CHRISTMAS10 has been used 0 times.",),
        ("Promo Code NewYear10 has been used 1 times.",),
        ("Promo Code VeteranDay15 has been used 0 times.",)])


def test_raise_rates(seed):
    out = settlement.raise_rates(seed["car_insurance"], 10)
    got = {(r[0], r[1]): r[2] for r in out.collect()}
    before = {(r[0], r[1]): r[2] for r in seed["car_insurance"].collect()}
    expect = {D("9.99"): D("10.99"), D("10.99"): D("12.09"), D("12.99"): D("14.29"),
              D("14.99"): D("16.49"), D("19.99"): D("21.99"), D("24.99"): D("27.49"),
              D("29.99"): D("32.99"), D("49.99"): D("54.99")}
    assert all(got[k] == expect[v] for k, v in before.items())
    assert out.schema["insurance_price"].dataType == seed["car_insurance"].schema[
        "insurance_price"].dataType


def test_cap_payment(seed):
    out = pricing.cap_payment(seed["payment"], seed["reservation"])
    got = dict(rows(out, "payment_id", "amount_paid"))
    assert got == {1001: D("129.65"), 1002: D("300.00"), 1003: D("98.90"), 1004: D("689.35"),
                   1005: D("114.90")}


def test_penalty_rent_insurance(seed):
    res = seed["reservation"]
    pen = dict(rows(pricing.penalty_amount(res), "reservation_id", "penalty_amount"))
    assert pen == {1: 0, 2: 0, 3: 0, 4: 0, 5: 0}
    prices = pricing.car_prices(seed["car"], seed["car_type"])
    rent = dict(rows(pricing.rent_amount(res, prices), "reservation_id", "rental_amount"))
    assert rent == {1: D("119.70"), 2: D("119.80"), 3: None, 4: D("89.95"), 5: D("299.90")}
    ins = dict(rows(pricing.insurance_amount(res, seed["car"], seed["car_insurance"]),
                    "reservation_id", "insurance_amount"))
    assert ins == {1: D("59.94"), 2: D("43.96"), 3: None, 4: D("24.99"), 5: D("99.98")}


def test_price_total(seed):
    res, offers = seed["reservation"], seed["offer_details"]
    stored = dict(rows(pricing.price_total(res, offers, ["start_date"]),
                       "reservation_id", "tot_amount"))
    assert stored == {1: D("129.65"), 2: D("129.75"), 3: D("620.42"), 4: D("114.90"),
                      5: D("398.90")}
    priced = pricing.price_reservations(res, seed["car"], seed["car_type"],
                                        seed["car_insurance"], offers, ["start_date"])
    assert dict(rows(priced, "reservation_id", "tot_amount")) == {
        1: D("179.64"), 2: D("163.76"), 3: None, 4: D("114.94"), 5: D("399.88")}


def test_integrity_holds_on_seeds(seed):
    for fk in FOREIGN_KEYS:
        bad = integrity.check_foreign_key(seed[fk.child], seed[fk.parent], fk.child_cols,
                                          fk.parent_cols)
        assert bad.count() == 0, fk
    for t, keys in PRIMARY_KEYS.items():
        assert integrity.check_primary_key(seed[t], keys).count() == 0, t
    for t, cols in UNIQUE_COLUMNS.items():
        assert integrity.check_unique(seed[t], cols).count() == 0, t
    for t in PRIMARY_KEYS:
        assert integrity.not_null_violations(seed[t], not_null_columns(t)).count() == 0, t


def test_length_check_on_seeds(seed):
    found = {}
    for t, limits in LENGTHS.items():
        out = integrity.check_length(seed[t], {c: n for c, (n, _) in limits.items()})
        found[t] = out.count()
    assert all(v == 0 for v in found.values()), found


def test_cascade_order():
    order = cascade_order()
    pos = {t: i for i, t in enumerate(order)}
    assert all(pos[fk.parent] < pos[fk.child] for fk in FOREIGN_KEYS)


def _removed(seed, kept, table, *cols):
    return sorted(set(rows(seed[table], *cols)) - set(rows(kept[table], *cols)))


def test_cascade_delete_car_type(seed):
    doomed = seed["car_type"].where("car_type = 'SUV'").select("car_type")
    kept = integrity.cascade_delete(seed, {"car_type": doomed}, FOREIGN_KEYS)
    assert len(_removed(seed, kept, "car_insurance", "car_type", "insurance_type")) == 2
    assert _removed(seed, kept, "car", "vin") == [("R908891209418173",)]
    assert _removed(seed, kept, "reservation", "reservation_id") == [(4,)]
    assert _removed(seed, kept, "payment", "payment_id") == [(1005,)]
    assert _removed(seed, kept, "additional_driver", "reservation_id", "name") == [(4, "Brad Cook")]
    assert _removed(seed, kept, "accessory_reserved", "accessory_id", "reservation_id") == [
        (1, 4), (2, 4)]
    assert _removed(seed, kept, "car_user", "license_no") == []


def test_cascade_delete_user(seed):
    doomed = seed["car_user"].where("license_no = 'C11609103'").select("license_no")
    kept = integrity.cascade_delete(seed, {"car_user": doomed}, FOREIGN_KEYS, cut_lineage=True)
    assert _removed(seed, kept, "user_credentials", "login_id") == [("courtney90",)]
    assert _removed(seed, kept, "card_details", "login_id") == [("courtney90",)]
    assert _removed(seed, kept, "reservation", "reservation_id") == [(2,), (3,), (4,)]
    assert _removed(seed, kept, "payment", "payment_id") == [(1004,), (1005,)]
    assert _removed(seed, kept, "additional_driver", "reservation_id", "name") == [
        (2, "Green Taylor"), (2, "Robert Moore"), (4, "Brad Cook")]
    assert _removed(seed, kept, "accessory_reserved", "accessory_id", "reservation_id") == [
        (1, 4), (2, 4), (5, 2)]


def test_users_without_exact_payment_in_whole_units(seed):
    from fleetbook.functions.scalars import round_to_int

    res = seed["reservation"].withColumn("tot_amount", round_to_int("tot_amount"))
    pay = seed["payment"].withColumn("amount_paid", round_to_int("amount_paid"))
    out = queries.users_without_exact_payment(seed["car_user"], res, pay)
    assert rows(out) == sorted([("Glenn", "Tucker"), ("Ron", "Harper"), ("Manoj", "Punwani")])

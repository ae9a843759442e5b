"""Catalogue of the rental tables: column types, keys, references, lengths.

Column types follow the declared table definitions with money kept in cents
(``decimal(8,2)``). Spark does not enforce keys, references or text lengths
on DataFrames, so they are recorded here and checked by
``fleetbook.operators.integrity``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(8, 2)
PERCENT = T.DecimalType(5, 2)


def _f(name: str, dtype: T.DataType, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable)


S, I, D = T.StringType(), T.IntegerType(), T.DateType()

# Table definitions (name, type, nullable) as declared.
SCHEMAS: dict[str, T.StructType] = {
    "rental_location": T.StructType([
        _f("rental_location_id", I, False), _f("phone", S, False), _f("email", S),
        _f("street_name", S, False), _f("state", S, False), _f("zip_code", S, False),
    ]),
    "car_type": T.StructType([
        _f("car_type", S, False), _f("price_per_day", MONEY, False),
    ]),
    "insurance": T.StructType([
        _f("insurance_type", S, False), _f("bodily_coverage", MONEY, False),
        _f("medical_coverage", MONEY, False), _f("collision_coverage", MONEY, False),
    ]),
    "car_insurance": T.StructType([
        _f("car_type", S, False), _f("insurance_type", S, False),
        _f("insurance_price", MONEY, False),
    ]),
    "car_user": T.StructType([
        _f("license_no", S, False), _f("fname", S, False), _f("mname", S),
        _f("lname", S, False), _f("email", S, False), _f("address", S, False),
        _f("phone", S, False), _f("dob", D, False), _f("user_type", S, False),
    ]),
    "user_credentials": T.StructType([
        _f("login_id", S, False), _f("password", S, False),
        _f("year_of_membership", S, False), _f("license_no", S, False),
    ]),
    "card_details": T.StructType([
        _f("login_id", S, False), _f("name_on_card", S, False), _f("card_no", S, False),
        _f("expiry_date", D, False), _f("cvv", S, False), _f("billing_address", S, False),
    ]),
    "car": T.StructType([
        _f("vin", S, False), _f("rental_location_id", I, False), _f("reg_no", S),
        _f("status", S, False), _f("seating_capacity", I, False),
        _f("disability_friendly", S), _f("car_type", S, False), _f("model", S),
        _f("year", S), _f("color", S),
    ]),
    "offer_details": T.StructType([
        _f("promo_code", S, False), _f("description", S), _f("promo_type", S, False),
        _f("is_one_time", S), _f("percentage", PERCENT), _f("discounted_amount", MONEY),
        _f("status", S, False),
    ]),
    "reservation": T.StructType([
        _f("reservation_id", I, False), _f("start_date", D, False), _f("end_date", D, False),
        _f("meter_start", I, False), _f("meter_end", I), _f("rental_amount", MONEY, False),
        _f("insurance_amount", MONEY, False), _f("actual_end_date", D),
        _f("status", S, False), _f("license_no", S, False), _f("vin", S, False),
        _f("promo_code", S), _f("additional_amount", MONEY), _f("tot_amount", MONEY, False),
        _f("insurance_type", S), _f("penalty_amount", MONEY), _f("drop_location_id", I),
    ]),
    "payment": T.StructType([
        _f("payment_id", I, False), _f("amount_paid", MONEY, False), _f("card_no", S),
        _f("expiry_date", D), _f("name_on_card", S), _f("cvv", S),
        _f("billing_address", S), _f("reservation_id", I, False), _f("login_id", S),
        _f("saved_card_no", S), _f("paid_by_cash", S),
    ]),
    "additional_driver": T.StructType([
        _f("reservation_id", I, False), _f("name", S, False), _f("dob", D, False),
    ]),
    "accessories": T.StructType([
        _f("accessory_id", I, False), _f("type", S, False), _f("amount", MONEY, False),
    ]),
    "accessory_reserved": T.StructType([
        _f("accessory_id", I, False), _f("reservation_id", I, False),
    ]),
}

# Primary keys as declared.
PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "rental_location": ("rental_location_id",),
    "car_type": ("car_type",),
    "insurance": ("insurance_type",),
    "car_insurance": ("car_type", "insurance_type"),
    "car_user": ("license_no",),
    "user_credentials": ("login_id",),
    "card_details": ("login_id", "card_no"),
    "car": ("vin",),
    "offer_details": ("promo_code",),
    "reservation": ("reservation_id",),
    "payment": ("payment_id",),
    "additional_driver": ("reservation_id", "name"),
    "accessories": ("accessory_id",),
    "accessory_reserved": ("accessory_id", "reservation_id"),
}

# Unique columns other than keys (NULLs exempt).
UNIQUE_COLUMNS: dict[str, tuple[str, ...]] = {
    "car_user": ("email",),
    "car": ("reg_no",),
}


@dataclass(frozen=True)
class ForeignKey:
    """``child(child_cols)`` references ``parent(parent_cols)``; all declared
    with ON DELETE CASCADE."""

    child: str
    child_cols: tuple[str, ...]
    parent: str
    parent_cols: tuple[str, ...]


# The sixteen declared references.
FOREIGN_KEYS: tuple[ForeignKey, ...] = (
    ForeignKey("car_insurance", ("car_type",), "car_type", ("car_type",)),
    ForeignKey("car_insurance", ("insurance_type",), "insurance", ("insurance_type",)),
    ForeignKey("user_credentials", ("license_no",), "car_user", ("license_no",)),
    ForeignKey("card_details", ("login_id",), "user_credentials", ("login_id",)),
    ForeignKey("car", ("car_type",), "car_type", ("car_type",)),
    ForeignKey("car", ("rental_location_id",), "rental_location", ("rental_location_id",)),
    ForeignKey("reservation", ("drop_location_id",), "rental_location", ("rental_location_id",)),
    ForeignKey("reservation", ("license_no",), "car_user", ("license_no",)),
    ForeignKey("reservation", ("vin",), "car", ("vin",)),
    ForeignKey("reservation", ("promo_code",), "offer_details", ("promo_code",)),
    ForeignKey("reservation", ("insurance_type",), "insurance", ("insurance_type",)),
    ForeignKey("payment", ("reservation_id",), "reservation", ("reservation_id",)),
    ForeignKey("payment", ("login_id", "saved_card_no"), "card_details", ("login_id", "card_no")),
    ForeignKey("additional_driver", ("reservation_id",), "reservation", ("reservation_id",)),
    ForeignKey("accessory_reserved", ("accessory_id",), "accessories", ("accessory_id",)),
    ForeignKey("accessory_reserved", ("reservation_id",), "reservation", ("reservation_id",)),
)

# Declared text lengths; True marks blank-padded CHAR(n).
LENGTHS: dict[str, dict[str, tuple[int, bool]]] = {
    "rental_location": {"phone": (10, True), "email": (25, False), "street_name": (40, False),
                        "state": (2, True), "zip_code": (6, True)},
    "car_type": {"car_type": (15, False)},
    "insurance": {"insurance_type": (15, False)},
    "car_insurance": {"car_type": (15, False), "insurance_type": (15, False)},
    "car_user": {"license_no": (15, False), "fname": (15, False), "mname": (1, False),
                 "lname": (15, False), "email": (25, False), "address": (100, False),
                 "phone": (10, True), "user_type": (10, False)},
    "user_credentials": {"login_id": (15, False), "password": (15, False),
                         "year_of_membership": (4, True), "license_no": (15, False)},
    "card_details": {"login_id": (15, False), "name_on_card": (50, False),
                     "card_no": (16, True), "cvv": (3, True), "billing_address": (50, False)},
    "car": {"vin": (17, True), "reg_no": (15, False), "status": (15, False),
            "disability_friendly": (1, True), "car_type": (15, False), "model": (20, False),
            "year": (4, True), "color": (10, False)},
    "offer_details": {"promo_code": (15, False), "description": (50, False),
                      "promo_type": (20, False), "is_one_time": (1, True), "status": (10, False)},
    "reservation": {"status": (10, False), "license_no": (15, False), "vin": (17, True),
                    "promo_code": (15, False), "insurance_type": (15, False)},
    "payment": {"card_no": (16, True), "name_on_card": (50, False), "cvv": (3, True),
                "billing_address": (50, False), "login_id": (15, False),
                "saved_card_no": (16, True), "paid_by_cash": (1, True)},
    "additional_driver": {"name": (50, False)},
    "accessories": {"type": (15, False)},
}


def not_null_columns(table: str) -> list[str]:
    """Columns declared NOT NULL (primary-key columns included)."""
    return [f.name for f in SCHEMAS[table].fields if not f.nullable]


def cascade_order(tables=None, foreign_keys=FOREIGN_KEYS) -> list[str]:
    """Tables in an order where every parent precedes its children."""
    remaining = set(SCHEMAS if tables is None else tables)
    order: list[str] = []
    while remaining:
        ready = sorted(t for t in remaining
                       if all(fk.parent not in remaining or fk.parent == t
                              for fk in foreign_keys if fk.child == t))
        if not ready:
            raise ValueError("foreign-key graph has a cycle")
        order.extend(ready)
        remaining.difference_update(ready)
    return order

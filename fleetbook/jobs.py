"""Maintenance jobs over a folder of rental tables.

Each job reads ``<src>/<table>.parquet``, runs operators, and writes whole
new table versions to ``<dst>/<table>.parquet``. Writing whole tables to a
new folder (never rewriting the input in place) makes every job safe to
re-run after a failure: a retry overwrites its own partial output and the
input is untouched. Scratch tables of a job are removed after its last write.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetbook.operators import integrity, settlement
from fleetbook.plans.joins import broadcast_counted
from fleetbook.plans.materialize import write_counted
from fleetbook.session import scratch_scope
from fleetbook.sources import partitioned
from fleetbook.sources.schemas import (FOREIGN_KEYS, LENGTHS, PRIMARY_KEYS, SCHEMAS,
                                       UNIQUE_COLUMNS, ForeignKey, not_null_columns)
from fleetbook.sources.tables import read_table, table_path


def load(spark: SparkSession, src: str, names: Iterable[str] | None = None) -> dict[str, DataFrame]:
    return {n: read_table(spark, src, n) for n in (names or SCHEMAS)}


def write_all(tables: Mapping[str, DataFrame], dst: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(table_path(dst, name))


def settle_job(spark: SparkSession, src: str, dst: str, cut_lineage: bool = True) -> None:
    """Settle paid reservations: new reservation, offer and car tables."""
    t = load(spark, src, ["reservation", "payment", "offer_details", "car"])
    with scratch_scope(spark):
        out = settlement.settle(t["reservation"], t["payment"], t["offer_details"], t["car"],
                                cut_lineage=cut_lineage, few_open=None if cut_lineage else False)
        write_all(out, dst)


def settle_partitions(spark: SparkSession, path: str, part: str, payments: DataFrame,
                      of: Callable[[DataFrame], DataFrame] = lambda table: table) -> list:
    """Settle a reservation table kept in partitions, in place: only the
    partitions that hold a due reservation are written. ``of`` narrows the
    open reservations looked at (some months). Returns the partitions
    written; a job that failed can be run again (see ``partitioned``)."""
    with scratch_scope(spark):
        found: dict[str, DataFrame] = {}

        def changed(table: DataFrame) -> DataFrame:
            due = settlement.due_reservations(of(table), payments, few_open=None).select("reservation_id", part)
            found["due"] = write_counted(due, "due")[0]
            return found["due"]

        def update(table: DataFrame) -> DataFrame:
            return settlement.settle_reservations(table, due=broadcast_counted(found["due"].select("reservation_id")))

        return partitioned.update_partitions(spark, path, part, changed, update)


def settle_in_place(spark: SparkSession, src: str, parts: Mapping[str, str]) -> dict[str, list]:
    """Settle a folder of tables in place. ``parts`` names the partition
    columns of ``reservation`` and ``car``; only their partitions with a
    changed row are written, and ``offer_details`` only when an offer expires.
    Returns what was written per table.

    The reservations come last: until they are marked completed the due set
    is found again, so a job that failed on the way is simply run again, and
    what it had already written stays as it is.
    """
    res, car, offer = (table_path(src, n) for n in ("reservation", "car", "offer_details"))
    partitioned.recover(spark, res, parts["reservation"])
    partitioned.recover(spark, offer, None)
    with scratch_scope(spark):
        table = spark.read.parquet(res)
        due = write_counted(settlement.due_reservations(table, read_table(spark, src, "payment"), few_open=None).select(
            "reservation_id", "vin", "promo_code", "drop_location_id", parts["reservation"]), "due")[0]
        offers = spark.read.parquet(offer)
        settled = write_counted(settlement.settle_offers(offers, due), "offers")[0]
        expired = settled.exceptAll(offers).count()
        if expired:
            partitioned.replace_table(settled, offer)
        vins = broadcast_counted(due.select(F.col("vin").alias("__due_vin")).distinct())
        cars = partitioned.update_partitions(
            spark, car, parts["car"], lambda t: t.join(vins, F.col("vin") == F.col("__due_vin"), "left_semi"),
            lambda t: settlement.settle_cars(t, due, small_winner=True))
        keys = broadcast_counted(due.select("reservation_id"))
        done = partitioned.update_partitions(
            spark, res, parts["reservation"], lambda t: due,
            lambda t: settlement.settle_reservations(t, due=keys))
    return {"offer_details": [expired] if expired else [], "car": cars, "reservation": done}


def cascade_delete_partitions(spark: SparkSession, parent: str, child: str, part: str, doomed: Callable[[DataFrame], DataFrame],
                              key: str = "reservation_id") -> tuple[list, list]:
    """Delete rows of a partitioned parent table and the rows of a partitioned
    child table that refer to them, in place: only partitions that lose a row
    are written, or removed when they lose all. The child goes first, so a
    job that failed in between finds the parent's rows again. Returns the
    partitions touched in parent and child."""
    partitioned.recover(spark, parent, part)
    with scratch_scope(spark):
        gone = write_counted(doomed(spark.read.parquet(parent)).select(F.col(key).alias("__gone"), part), "gone")[0]
        keys = broadcast_counted(gone.select("__gone").where(F.col("__gone").isNotNull()).distinct())

        def hit(table: DataFrame) -> DataFrame:
            return table.join(keys, F.col(key) == F.col("__gone"), "left_semi")

        def kept(table: DataFrame) -> DataFrame:
            return table.join(keys, F.col(key) == F.col("__gone"), "left_anti")

        in_child = partitioned.delete_from_partitions(spark, child, part, hit, kept)
        return partitioned.delete_from_partitions(spark, parent, part, hit, kept), in_child


def append_job(spark: SparkSession, src: str, dst: str, table: str, load: str) -> None:
    """Append the rows of ``src`` (parquet) to a rental table kept by load,
    matched by column name; running it again replaces the same load."""
    rows = spark.read.parquet(src).select(*SCHEMAS[table].fieldNames())
    rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMAS[table].fields])
    partitioned.append_load(rows, table_path(dst, table), load)


def raise_rates_job(spark: SparkSession, src: str, dst: str, percentage) -> None:
    rates = read_table(spark, src, "car_insurance")
    write_all({"car_insurance": settlement.raise_rates(rates, percentage)}, dst)


def cascade_delete_job(spark: SparkSession, src: str, dst: str,
                       deleted: Mapping[str, DataFrame],
                       foreign_keys: Iterable[ForeignKey] = FOREIGN_KEYS) -> None:
    """Delete the given rows and all that reference them; write every
    table's survivors."""
    tables = load(spark, src)
    with scratch_scope(spark):
        write_all(integrity.cascade_delete(tables, deleted, foreign_keys, cut_lineage=True), dst)


# Columns whose values a report shows masked but for the last four characters
MASKED = {"card_no", "saved_card_no"}


def _shown(column: str) -> F.Column:
    if column not in MASKED:
        return F.col(column)
    text = F.rtrim(F.col(column).cast("string"))
    hidden = F.greatest(F.length(text) - 4, F.lit(0))
    return F.concat(F.repeat(F.lit("*"), hidden), F.substr(text, hidden + 1)).alias(column)


def _describe(df: DataFrame, cols: Iterable[str]) -> F.Column:
    return F.to_json(F.struct(*[_shown(c) for c in cols]))


def _row_rules(df: DataFrame, table: str) -> DataFrame:
    """NOT NULL and length violations in one pass over a table, as (rule,
    detail): a count per column with NULLs, a row per value too long."""
    nulls = [F.when(F.col(c).isNull(), F.struct(
        F.lit("not_null").alias("rule"), F.lit(c).alias("column_name"), F.lit(None).cast("string").alias("detail")))
        for c in not_null_columns(table)]
    long = [F.when(F.length(F.col(c)) > n, F.struct(
        F.lit("length").alias("rule"), F.lit(c).alias("column_name"),
        F.to_json(F.struct(*[_shown(k) for k in PRIMARY_KEYS[table]], F.lit(c).alias("column_name"),
                           F.length(F.col(c)).alias("length"))).alias("detail")))
        for c, (n, _) in LENGTHS.get(table, {}).items()]
    broken = F.filter(F.array(*nulls, *long), lambda v: v.isNotNull())
    each = F.when(F.col("rule") == "length", F.monotonically_increasing_id())  # equal details are rows of their own
    counted = (df.select(F.explode(broken).alias("v")).select("v.*").withColumn("each", each)
               .groupBy("rule", "column_name", "detail", "each").agg(F.count(F.lit(1)).alias("n_nulls")))
    return counted.select("rule", F.coalesce("detail", F.to_json(F.struct("column_name", "n_nulls"))).alias("detail"))


def integrity_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every violated rule of the catalogue, one row per violation:
    ``(rule, table_name, columns, detail)``. An empty result means all
    keys, unique columns, NOT NULL columns, references and text lengths
    hold."""
    parts: list[DataFrame] = []

    def add(rule: str, table: str, cols: Iterable[str], df: DataFrame, detail: F.Column):
        parts.append(df.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                               F.lit(",".join(cols)).alias("columns"),
                               detail.alias("detail")))

    for t, keys in PRIMARY_KEYS.items():
        if t in tables:
            dup = integrity.check_primary_key(tables[t], keys)
            add("primary_key", t, keys, dup, _describe(dup, [*keys, "n"]))
    for t, cols in UNIQUE_COLUMNS.items():
        if t in tables:
            dup = integrity.check_unique(tables[t], cols)
            add("unique", t, cols, dup, _describe(dup, [*cols, "n"]))
    for t in tables:
        if t in SCHEMAS:
            found = _row_rules(tables[t], t)
            parts.append(found.select("rule", F.lit(t).alias("table_name"), F.lit("").alias("columns"), "detail"))
    for fk in FOREIGN_KEYS:
        if fk.child in tables and fk.parent in tables:
            bad = integrity.check_foreign_key(tables[fk.child], tables[fk.parent],
                                              fk.child_cols, fk.parent_cols)
            keys = PRIMARY_KEYS[fk.child]
            add("foreign_key", fk.child, fk.child_cols, bad,
                _describe(bad, [*keys, *[c for c in fk.child_cols if c not in keys]]))
    report = parts[0]
    for p in parts[1:]:
        report = report.unionByName(p)
    return report


def integrity_job(spark: SparkSession, src: str, dst: str) -> None:
    integrity_report(load(spark, src)).write.mode("overwrite").parquet(
        table_path(dst, "integrity_report"))

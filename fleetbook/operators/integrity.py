"""Declared constraints re-aimed as data checks, plus cascading delete.

Spark does not enforce keys, references, NOT NULL on read, or text lengths.
Each check returns the violating rows (or a per-column summary for NOT
NULL), so an empty result means the rule holds. Every check is one scan of
the table plus at most one shuffle on the key.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.plans.joins import small_side
from fleetbook.sources.schemas import PRIMARY_KEYS, ForeignKey, cascade_order


def check_primary_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once, with their count ``n``. Counting is
    partially aggregated per task, so a heavily duplicated key is one row
    per task before the shuffle."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Like ``check_primary_key``, but rows with a NULL in the columns are
    exempt, as for a UNIQUE constraint."""
    cond = None
    for c in columns:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return check_primary_key(df.where(cond), columns)


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One pass over the table: per column, the row count and the number of
    NULLs, as rows ``(column_name, n_rows, n_nulls)``."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    aggs += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("bigint").alias(f"__n{i}")
             for i, c in enumerate(columns)]
    summary = df.agg(*aggs)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"__n{i}").alias("n_nulls"))
                      for i, c in enumerate(columns)])
    return (summary.select(F.col("__rows").cast("bigint").alias("n_rows"),
                           F.explode(pairs).alias("__p"))
            .select("__p.column_name", "n_rows", "__p.n_nulls"))


def not_null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return check_not_null(df, columns).where(F.col("n_nulls") > 0)


def check_foreign_key(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                      parent_cols: Sequence[str]) -> DataFrame:
    """Child rows whose reference has no parent. A reference with a NULL in
    any of its columns is not checked (simple match), so for a single
    column a NULL passes and for two columns a half-NULL pair passes."""
    keys = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parent_cols)])
    present = None
    cond = None
    for i, c in enumerate(child_cols):
        present = F.col(c).isNotNull() if present is None else present & F.col(c).isNotNull()
        term = F.col(c) == F.col(f"__p{i}")
        cond = term if cond is None else cond & term
    return child.where(present).join(keys, cond, "left_anti")


def check_length(df: DataFrame, limits: Mapping[str, int], keep: Sequence[str] = ()) -> DataFrame:
    """Values longer than their declared length, as rows
    ``(*keep, column_name, value, length)``; all columns in one scan."""
    checks = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"),
                 F.length(F.col(c)).alias("length"), F.lit(n).alias("limit"))
        for c, n in limits.items()])
    over = F.filter(checks, lambda s: s["length"] > s["limit"])
    return (df.select(*keep, F.explode(over).alias("__v"))
            .select(*keep, "__v.column_name", "__v.value", "__v.length"))


def _keys_match(child_cols: Sequence[str], parent_cols: Sequence[str]):
    cond = None
    for i, c in enumerate(child_cols):
        term = F.col(c) == F.col(f"__d{i}")
        cond = term if cond is None else cond & term
    return cond


def cascade_delete(tables: Mapping[str, DataFrame], deleted: Mapping[str, DataFrame],
                   foreign_keys: Iterable[ForeignKey], *,
                   keys: Mapping[str, Sequence[str]] | None = PRIMARY_KEYS,
                   cut_lineage: bool = False) -> dict[str, DataFrame]:
    """Delete rows and everything that references them, transitively.

    ``deleted[t]`` holds the rows (or just the key columns) removed from
    table ``t`` directly; they are matched on the table's key from ``keys``
    when ``deleted[t]`` has it, else on all shared columns (NULL-safe).
    Tables are visited parents first; a child loses
    the rows whose reference matches a removed parent row, then passes its
    own removed rows on to its children. Each step is a semi join (what is
    removed) and an anti join (what survives) on the reference columns;
    NULL references never match and survive. With ``cut_lineage`` each
    removed key set is written once to the shared checkpoint folder and,
    when proven small (deleting a few users), broadcast, so no child table
    is shuffled for it. Returns the surviving rows of every table.
    """
    fks = list(foreign_keys)
    removed: dict[str, DataFrame] = {}
    survivors: dict[str, DataFrame] = {}
    for name in cascade_order(tables.keys(), fks):
        df = tables[name]
        gone_parts: list[DataFrame] = []
        keep = df
        if name in deleted:
            root = deleted[name]
            key = [c for c in (keys or {}).get(name, ()) if c in root.columns]
            on = key or [c for c in root.columns if c in df.columns]
            root_keys = root.select(*[F.col(c).alias(f"__r{i}") for i, c in enumerate(on)])
            root_keys = small_side(root_keys.distinct(), cut_lineage)
            # whole rows may hold NULLs, which must still identify the row
            match = None
            for i, c in enumerate(on):
                term = F.col(c).eqNullSafe(F.col(f"__r{i}"))
                match = term if match is None else match & term
            gone_parts.append(df.join(root_keys, match, "left_semi"))
            keep = keep.join(root_keys, match, "left_anti")
        for fk in fks:
            if fk.child != name or fk.parent not in removed:
                continue
            doomed = removed[fk.parent].select(
                *[F.col(p).alias(f"__d{i}") for i, p in enumerate(fk.parent_cols)])
            if not cut_lineage:
                doomed = doomed.distinct()
            cond = _keys_match(fk.child_cols, fk.parent_cols)
            gone_parts.append(df.join(doomed, cond, "left_semi"))
            keep = keep.join(doomed, cond, "left_anti")
        survivors[name] = keep
        referenced = sorted({c for fk in fks if fk.parent == name for c in fk.parent_cols})
        if gone_parts and referenced:
            gone = gone_parts[0].select(*referenced)
            for part in gone_parts[1:]:
                gone = gone.unionByName(part.select(*referenced))
            # only the columns children reference; written once and, when
            # small, broadcast to every child join
            removed[name] = small_side(gone.distinct(), cut_lineage)
    return survivors

"""One-time offers used up in a stream, with the used codes in keyed state.

The state store holds a row per used code and a batch writes the codes that
it uses first, so the work of a batch does not grow with the codes used so
far. Rows of a hot code do not meet in one task: inside the tasks that read
the batch each run of rows keeps its first arrival of a code as a
candidate, every other row is already known to come later, and only the
candidates are dealt to the tasks that hold the codes' state.

A code goes to its first arrival in (``order_by``, ``key``) order within the
first batch that has it; NULL order values come last. A row without a code
gets nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetbook.plans.joins import bounded_broadcast

CANDIDATE = "__candidate"


def _arrival(frame: pd.DataFrame, order: Sequence[str]) -> pd.DataFrame:
    return frame.sort_values(list(order), kind="stable", na_position="last")


def _marked(stream: DataFrame, code: str, order: Sequence[str]) -> DataFrame:
    """The stream with a mark on the rows that may be the first of their code:
    one per code and run of rows."""
    schema = T.StructType([*stream.schema.fields, T.StructField(CANDIDATE, T.BooleanType(), False)])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select([code, *order]).to_pandas().reset_index(drop=True)
            firsts = _arrival(rows[rows[code].notna()], order).drop_duplicates(code).index
            flag = pd.Series(False, index=rows.index)
            flag[firsts] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(flag, pa.bool_())], [*batch.schema.names, CANDIDATE])

    return stream.mapInArrow(mark, schema)


def first_uses(stream: DataFrame, *, key: str, code: str, order_by: Sequence[str],
               flag: str = "promo_available") -> DataFrame:
    """The stream with ``flag`` = 1 on the first use of each code, else 0."""
    order = [*order_by, key]
    marked = _marked(stream, code, order)
    later = marked.where(~F.col(CANDIDATE)).drop(CANDIDATE).withColumn(flag, F.lit(0))
    candidates = marked.where(F.col(CANDIDATE)).drop(CANDIDATE)
    schema = T.StructType([*stream.schema.fields, T.StructField(flag, T.IntegerType(), False)])

    def use(_, runs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = _arrival(pd.concat(runs), order)
        given = pd.Series(0, index=rows.index, dtype="int32")
        if not state.exists:
            given.iloc[0] = 1
            state.update((True,))
        rows[flag] = given
        yield rows

    decided = candidates.groupBy(code).applyInPandasWithState(
        use, schema, "used boolean", "append", GroupStateTimeout.NoTimeout)
    return decided.unionByName(later)


def offer_uses(stream: DataFrame, offers: DataFrame, *, key: str, code: str, order_by: Sequence[str],
               flag: str = "promo_available") -> DataFrame:
    """``first_uses`` by the terms in ``offers`` (code, is_one_time, status): an
    available offer is given to every row, a one-time offer to the first."""
    terms = offers.select(F.col(code).alias("__oc"), F.col("is_one_time").alias("__one"),
                          F.col("status").alias("__st"))
    used = first_uses(stream, key=key, code=code, order_by=order_by, flag=flag)
    given = (F.col("__st") == "Available") & F.when(F.col("__one") == "Y", F.col(flag) == 1).otherwise(F.lit(True))
    return (used.join(bounded_broadcast(terms), F.col(code) == F.col("__oc"), "left")
            .withColumn(flag, F.when(given, 1).otherwise(0)).drop("__oc", "__one", "__st"))

"""Run-time Bloom filters: the few keys of one side prune the other's scan.

Spark builds such a filter itself (``spark.sql.optimizer.runtime.bloomFilter``):
a side with a selective filter and a small size estimate is read first, its
join keys become a Bloom filter, and ``might_contain`` on the other side
drops rows before they are aggregated or shuffled. The size estimate of a
filtered table is that of the whole table, though, so with large tables the
rule never applies. ``known_size`` writes the filtered rows, which makes the
estimate real; ``few`` says whether that is worth it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetbook.plans.materialize import write_counted

# Spark's filter holds 4,000,000 keys by default at its false-positive rate
FEW_ROWS = 4_000_000
FEW_SHARE = 0.1


def few(df: DataFrame, condition: Column) -> bool:
    """Whether the rows of ``df`` that meet ``condition`` are few: at most
    ``FEW_ROWS`` and ``FEW_SHARE`` of all. One pass over the columns that the
    condition reads."""
    n, chosen = df.agg(F.count(F.lit(1)), F.count_if(condition)).first()
    return chosen <= FEW_ROWS and chosen <= FEW_SHARE * n


def known_size(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, so that its size is known."""
    return write_counted(df)[0]


def bloom_settings(keys: int, bits_per_key: int = 10, row_bytes: int = 64) -> dict[str, str]:
    """Session settings with which a filter of ``keys`` keys is built: about
    1 % false positives at ten bits a key. The caller decides whether to
    apply them."""
    bits = max(8 << 20, keys * bits_per_key)
    prefix = "spark.sql.optimizer.runtime.bloomFilter."
    return {
        prefix + "enabled": "true",
        prefix + "creationSideThreshold": str(max(10 << 20, keys * row_bytes)),
        prefix + "expectedNumItems": str(max(1_000_000, keys)),
        prefix + "maxNumItems": str(max(4_000_000, keys)),
        prefix + "numBits": str(bits),
        prefix + "maxNumBits": str(max(64 << 20, bits)),
    }

"""Benchmark decontamination by greedy string tiling.

1. Each benchmark item gives its word n-grams as seeds. A pass over the
   documents keeps the runs of words that seeds cover; a bitmap of seed
   hashes, sized by the seeds, drops the rest inside the scan.
2. A document that holds only an item's most frequent seeds, which do not
   cover enough of it, cannot hold enough: only the other seeds are joined to
   the runs', and a word run that very many documents hold makes no pairs.
   A pair of a document and an item goes on when its shared seeds cover
   enough of the item.
3. Greedy string tiling of the pair: the longest common runs of words not yet
   marked are found by running Karp-Rabin hashes, marked, and so on down to
   the least length. Every tile is made of seeds, so the runs are all it needs.
   Tiles may lie anywhere, so a reordered passage is covered too.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import text_batches, written

MIN_MATCH = 4          # least tile, in words
PERCENT = 50           # of an item's words that tiles must cover
BITMAP_LOG2 = (22, 27)  # bits of the bitmap: 512 KB at least, 16 MB at most
BITS_A_SEED = 16

_SPACED = bytes(c if chr(c).isalnum() or c > 127 else 32 for c in range(256))  # ASCII marks as blanks
_BASE = 0x9E3779B97F4A7C15


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().translate(_SPACED).split()


def _seeds(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` words."""
    h = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) * np.uint64(_BASE)
    h ^= h >> np.uint64(32)
    out = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for i in range(size):
        out = out * np.uint64(0x100000001B3) + h[i:i + len(out)]
    out ^= out >> np.uint64(29)
    return out * np.uint64(_BASE)


def _bitmap(seeds: DataFrame) -> tuple[int, np.ndarray]:
    """(k, bitmap): the leading ``k`` bits of every seed, as a bitmap of 2^k
    bits; its words, not the seeds, come to the driver."""
    least, most = BITMAP_LOG2
    k = min(most, max(least, (BITS_A_SEED * seeds.count()).bit_length()))
    at = F.shiftrightunsigned("seed", 64 - k)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (at % 64).cast("int"))
    words = (seeds.select(F.shiftright(at, 6).alias("word"), bit.alias("bit"))
             .groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas())
    bitmap = np.zeros((1 << k) // 64, np.int64)
    bitmap[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return k, bitmap


def _scan(pattern: list[int], text: list[int], p_marked: bytearray, t_marked: bytearray, size: int) -> list:
    """Maximal unmarked matches of at least ``size``, as (length, p, t):
    running Karp-Rabin hashes of the text in a table, looked up by those of
    the pattern, then compared word by word."""
    mod, top = (1 << 61) - 1, pow(1_000_003, size - 1, (1 << 61) - 1)

    def windows(seq, marked):
        value = length = 0
        for i, x in enumerate(seq):
            if marked[i]:
                value = length = 0
                continue
            if length == size:
                value = (value - seq[i - size] * top) % mod
                length -= 1
            value = (value * 1_000_003 + x) % mod
            length += 1
            if length == size:
                yield value, i - size + 1

    table = defaultdict(list)
    for value, t in windows(text, t_marked):
        table[value].append(t)
    found = []
    for value, p in windows(pattern, p_marked):
        for t in table.get(value, ()):
            n = 0
            while (p + n < len(pattern) and t + n < len(text) and pattern[p + n] == text[t + n]
                   and not p_marked[p + n] and not t_marked[t + n]):
                n += 1
            if n >= size:
                found.append((n, p, t))
    return found


def tiles(pattern: list, runs: list[list], least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of ``pattern`` by ``runs``: non-overlapping tiles
    (length, start in the pattern, start in the joined runs), longest first;
    of equal ones the first in the pattern, then in the runs."""
    codes: dict = {}
    coded = [codes.setdefault(w, len(codes) + 1) for w in pattern]
    text: list[int] = []
    for run in runs:
        text += [codes.get(w, 0) for w in run] + [0]  # 0 matches nothing
    p_marked, t_marked = bytearray(len(coded)), bytearray(x == 0 for x in text)
    out = []
    size = min(len(coded), max(map(len, runs), default=0))
    while size >= least > 0:
        found = _scan(coded, text, p_marked, t_marked, size)
        placed = False
        for n, p, t in sorted(found, key=lambda m: (-m[0], m[1], m[2])):
            if any(p_marked[p:p + n]) or any(t_marked[t:t + n]):
                break  # cut up by a mark: what is left of it is found anew
            p_marked[p:p + n] = t_marked[t:t + n] = b"\1" * n
            out.append((n, p, t))
            placed = True
        if not placed:
            size = max(least, size // 2) if size > least else 0
    return out


def _items(benchmark: DataFrame, id_col: str, text_col: str, min_match: int) -> DataFrame:
    """(item, item_id, words, size): one row per distinct item with words; an
    item of fewer than ``min_match`` words is a seed as a whole."""
    def cut(batches):
        for rows, texts in text_batches(batches, 1 << 20):
            words = [words_of(t) for t in texts]
            keep = pa.array([bool(w) for w in words])
            yield pa.record_batch(
                [*(c.filter(keep) for c in rows.columns[:2]),
                 pa.array([w for w in words if w], pa.list_(pa.binary())),
                 pa.array([min(min_match, len(w)) for w in words if w], pa.int32())],
                names=["item", "item_id", "words", "size"])

    return (benchmark.select(F.xxhash64(id_col, text_col).alias("item"),
                             F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string")).distinct()
            .mapInArrow(cut, "item long, item_id long, words array<binary>, size int"))


def _rarest(seeds: DataFrame, items: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """(item, seed): the seeds of each item but its most frequent positions
    among the documents' runs, as many of those as do not cover ``percent``
    hundredths of it together: a document that holds no other seed of the
    item cannot cover enough."""
    often = held.join(seeds.select("seed").distinct(), "seed", "left_semi").groupBy("seed").agg(F.count("*").alias("runs"))
    by_item = (seeds.join(often, "seed", "left")
               .groupBy("item").agg(F.collect_list(F.struct(F.coalesce("runs", F.lit(0)).alias("runs"), "seed", "pos")).alias("all"))
               .join(items.select("item", "size", F.size("words").alias("len")), "item"))

    def rest(batches):
        for batch in batches:
            item, found, size, length = (c.to_pylist() for c in batch.columns)
            for i, positions, k, n in zip(item, found, size, length):
                covered, keep = set(), set()
                for x in sorted(positions, key=lambda x: (-x["runs"], x["seed"], x["pos"])):
                    if not keep and 100 * len(covered.union(range(x["pos"], x["pos"] + k))) < percent * n:
                        covered.update(range(x["pos"], x["pos"] + k))
                    else:
                        keep.add(x["seed"])
                yield pa.record_batch([pa.array([i] * len(keep), pa.int64()), pa.array(list(keep), pa.int64())],
                                      names=["item", "seed"])

    return by_item.select("item", "all", "size", "len").mapInArrow(rest, "item long, seed long")


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                 percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs of a document and a benchmark item of which tiles of at least
    ``min_match`` words cover ``percent`` hundredths or more: doc_id, item_id,
    item_words, covered, n_tiles, longest.

    Words are lower-cased and split at ASCII blanks and marks. An item shorter
    than ``min_match`` must occur whole. Texts that are null, empty or without
    words take no part, nor do documents with a null id; rows that share an id
    are one document; repeated items count once, a null item id is kept. An
    empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    items = written(_items(benchmark, item_id_col, item_text_col, min_match), "items")

    def item_seeds(batches):
        for batch in batches:
            for item, words, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = _seeds(words, size)
                yield pa.record_batch([pa.array([item] * len(found), pa.int64()), pa.array(range(len(found)), pa.int32()),
                                       pa.array(found.view(np.int64))], names=["item", "pos", "seed"])

    seeds = written(items.select("item", "words", "size")
                    .mapInArrow(item_seeds, "item long, pos int, seed long"), "seeds")
    sizes = [r.size for r in items.select(F.col("size").alias("size")).distinct().collect()]  # 1 to min_match
    shared = spark.sparkContext.broadcast(_bitmap(seeds))

    def runs(batches):
        k, words_of_bits = shared.value
        bits = words_of_bits.view(np.uint64)
        for rows, texts in text_batches(batches, 4 << 20):
            out = []
            for doc, text in zip(rows.column(0).to_pylist(), texts):
                words = words_of(text)
                covered, hits = np.zeros(len(words) + 1, bool), {}
                for size in sizes:
                    h = _seeds(words, size)
                    b = h >> np.uint64(64 - k)
                    at = np.flatnonzero(bits[b >> np.uint64(6)] >> (b & np.uint64(63)) & np.uint64(1))
                    hits[size] = (at, h[at].view(np.int64))
                    for i in range(size):
                        covered[at + i] = True
                if not covered.any():
                    continue
                edges = np.flatnonzero(np.diff(covered.astype(np.int8), prepend=0))
                for lo, hi in zip(edges[::2], edges[1::2]):
                    inside = set().union(*(h[(at >= lo) & (at < hi)].tolist() for at, h in hits.values()))
                    out.append({"doc": doc, "start": int(lo), "words": words[lo:hi], "seeds": list(inside)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema(
                [("doc", pa.int64()), ("start", pa.int32()), ("words", pa.list_(pa.binary())),
                 ("seeds", pa.list_(pa.int64()))]))

    found = written(docs.where(F.col(id_col).isNotNull())
                    .select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string"))
                    .mapInArrow(runs, "doc long, start int, words array<binary>, seeds array<long>"), "runs")
    held = found.select("doc", "start", F.explode("seeds").alias("seed"))
    rare = _rarest(seeds, items, held, percent)
    near = written(held.select("doc", "seed").join(rare, "seed").select("doc", "item").distinct(), "near-items")
    hits = written(held.join(near, "doc").join(seeds, ["item", "seed"])
                   .select("doc", "start", "item", "pos").distinct(), "hits")
    words = F.flatten(F.transform("pos", lambda p: F.sequence(p, p + F.col("size") - 1)))
    reach = (hits.groupBy("doc", "item").agg(F.collect_set("pos").alias("pos"))
             .join(items.select("item", F.size("words").alias("len"), "size"), "item")
             .where(100 * F.size(F.array_distinct(words)) >= percent * F.col("len")).select("doc", "item"))
    pairs = (hits.select("doc", "item", "start").distinct().join(reach, ["doc", "item"])
             .join(found.select("doc", "start", "words").distinct(), ["doc", "start"])
             .join(items.select("item", "item_id", F.col("words").alias("pattern"), "size"), "item"))

    def tile(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[0]
        got = tiles(list(first["pattern"]), [list(w) for w in group.sort_values("start")["words"]], int(first["size"]))
        covered = sum(n for n, _, _ in got)
        if 100 * covered < percent * len(first["pattern"]):
            return pd.DataFrame(columns=["doc_id", "item_id", "item_words", "covered", "n_tiles", "longest"])
        return pd.DataFrame({"doc_id": [first["doc"]], "item_id": pd.array([first["item_id"]], "Int64"),
                             "item_words": [len(first["pattern"])], "covered": [covered], "n_tiles": [len(got)],
                             "longest": [max(n for n, _, _ in got)]})

    return pairs.groupBy("doc", "item").applyInPandas(
        tile, "doc_id long, item_id long, item_words long, covered long, n_tiles long, longest long")

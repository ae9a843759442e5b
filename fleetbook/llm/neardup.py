"""Near-duplicate documents: MinHash bands, odd sketches, exact confirmation.

1. One pass reduces a document to its shingle count, a 128-bit fingerprint of
   the shingle set, band keys of its MinHash samples, and an odd sketch: the
   samples folded into a parity bitmap. Documents with equal sets form a
   class, so exact copies meet in a partial aggregate, never in pairs.
2. Classes that share a band key form a bucket. Each member is paired with
   the bucket's least class only (the hub), so a bucket gives as many pairs as
   it has members.
3. The XOR of two odd sketches has a population count that tells how many
   samples differ; pairs whose estimate is clearly below the threshold go.
   The others are confirmed on their full shingle sets, and confirmed links
   give components.
4. A bucket whose members now lie in one component needs no more: links
   inside a component cannot change the result. In the others members of
   different components are compared by sketch, in blocks of bounded size. One
   round confirms each member's nearest one only, which joins most of what
   belongs together; a last round confirms every pair that passes, so no link
   is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetbook.llm.common import few_ids, text_batches, written
from fleetbook.llm.components import components

WORDS = 5
BANDS, ROWS = 36, 4   # a pair at 0.75 shares no band once in 900,000 times
# Sketches as (MinHash samples, bits, margin): the margin is 4 standard deviations
# of the estimate at 0.75. Every class has a rough one, whose first samples make
# the bands; classes in buckets that stay open get a fine one.
ROUGH, FINE = (256, 1024, 0.125), (2048, 8192, 0.045)
BLOCK = 1024          # members of a bucket compared in one task
NEAREST_ROUNDS = 1    # rounds that take each member's nearest only, before all are compared

_RNG = np.random.default_rng(20)


def _odd(n: int) -> np.ndarray:
    return _RNG.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_PLACE, _SAMPLES, _IN_BAND, _BAND = _odd(WORDS), _odd(FINE[0]), _odd(ROWS), _odd(BANDS)
_SHORT = _odd(WORDS)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # splitmix64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct word 5-grams of a whole text;
    words are runs between ASCII blanks, A-Z lower-cased. A shorter text is
    one shingle, a text without words none."""
    words = text.encode().lower().split()  # bytes: ASCII case and blanks only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < WORDS:
        return _mix((h * _PLACE[:n]).sum(keepdims=True, dtype=np.uint64) + _SHORT[n])
    out = h[:n - WORDS + 1] * _PLACE[0]
    for i in range(1, WORDS):
        out += h[i:n - WORDS + 1 + i] * _PLACE[i]
    return np.unique(_mix(out))


def _samples(s: np.ndarray, n: int) -> np.ndarray:
    least = np.full(n, ~np.uint64(0))
    for lo in range(0, len(s), 256):
        np.minimum(least, (s[lo:lo + 256, None] * _SAMPLES[:n]).min(0), out=least)
    return least


def _band_keys(least: np.ndarray) -> np.ndarray:
    rows = least[:BANDS * ROWS].reshape(BANDS, ROWS)
    return _mix((rows * _IN_BAND).sum(1, dtype=np.uint64) + _BAND).view(np.int64)


def _fold(least: np.ndarray, bits: int) -> np.ndarray:
    """The odd sketch of MinHash samples: a bit is set if an odd number of
    them hash to it."""
    at = _mix(least + _SAMPLES[:len(least)]) % np.uint64(bits)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits) & 1).view(np.int64)


def _signature(text: str) -> tuple:
    s = shingles(text)
    if not len(s):
        return 0, 0, 0, None, None
    least = _samples(s, ROUGH[0])
    keys = _band_keys(least)
    f1, f2 = s.sum(dtype=np.uint64), _mix(s ^ _M2).sum(dtype=np.uint64)
    return len(s), int(f1.view(np.int64)), int(f2.view(np.int64)), keys, _fold(least, ROUGH[1])


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def sign(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            n, f1, f2, bands, sketch = zip(*map(_signature, texts))
            yield pa.record_batch(
                [rows.column(0), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()),
                 pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                names=["id", "n", "f1", "f2", "bands", "sketch"])

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string"))
            .mapInArrow(sign, "id long, n long, f1 long, f2 long, bands array<long>, sketch array<long>"))


def similar_enough(differ, similarity: float, kind: tuple[int, int, float]):
    """Whether ``differ`` bits between two odd sketches of a kind allow
    ``similarity``, less the kind's margin: the share of samples that differ
    is (1 - similarity), each flips two bits, and flips that meet are expected
    to cancel."""
    samples, bits, margin = kind
    return differ <= bits / 2 * (1 - np.exp(-4 * samples * (1 - similarity + margin) / bits))


def _pass_by_sketch(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that pass by set sizes and rough sketches."""
    sketches = classes.select("rep", "n", "sketch")
    differ = sum(F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(ROUGH[1] // 64))
    return (pairs.join(sketches.toDF("a", "a_n", "a_sketch"), "a").join(sketches.toDF("b", "b_n", "b_sketch"), "b")
            .where(100 * F.least("a_n", "b_n") >= percent * F.greatest("a_n", "b_n"))
            .where(similar_enough(differ, percent / 100, ROUGH)).select("a", "b"))


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of class representatives that are links by their full
    shingle sets."""
    near = written(pairs, "near-pairs")
    ids = few_ids(near.select(F.col("a").alias("id")).union(near.select("b")).distinct())

    def sets(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            yield pa.record_batch([rows.column(0), pa.array([shingles(t).tobytes() for t in texts], pa.binary())],
                                  names=["id", "set"])

    full = written(docs.join(ids, "id", "left_semi").mapInArrow(sets, "id long, set binary").distinct(), "sets")

    def check(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(bool(both) and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([c.filter(pa.array(keep)) for c in batch.columns[:2]], names=["a", "b"])

    return written(near.join(full.toDF("a", "a_set"), "a").join(full.toDF("b", "b_set"), "b")
                   .select("a", "b", "a_set", "b_set").mapInArrow(check, "a long, b long"), "links")


def _compare(key, n, rep, component, block, across: bool, sketch, bands, similarity: float, nearest: bool):
    """Pairs (a, b) of one bucket block, or of two, that lie in different
    components and pass by size and fine sketch; the best of each member only,
    if ``nearest``, else each pair in the first bucket that it shares (which
    is open too, as the pair is)."""
    order = np.argsort(n, kind="stable")
    n, rep, component, block = n[order], rep[order], component[order], block[order]
    sketch, bands = sketch[order], bands[order]
    if (component == component[0]).all():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    xs, ys = [], []
    for lo in range(0, len(rep), 16):
        hi = min(lo + 16, len(rep))
        first = int(np.searchsorted(n, n[lo] * similarity, side="left")) if nearest else lo
        end = int(np.searchsorted(n, n[hi - 1] / similarity, side="right"))
        differ = np.bitwise_count(sketch[lo:hi, None] ^ sketch[None, first:end]).sum(2, dtype=np.int64)
        ok = similar_enough(differ, similarity, FINE) & (component[lo:hi, None] != component[None, first:end])
        if across:
            ok &= block[lo:hi, None] != block[None, first:end]
        if nearest:
            x = np.flatnonzero(ok.any(1))
            y = np.where(ok, differ, FINE[1] + 1).argmin(1)[x]
        else:
            x, y = np.nonzero(ok)
        xs.append(x + lo)
        ys.append(y + first)
    x, y = np.concatenate(xs), np.concatenate(ys)
    if not nearest:
        x, y = x[x < y], y[x < y]
        shared = bands[x] == bands[y]
        here = bands[x, shared.argmax(1)] == key
        x, y = x[here], y[here]
    return np.maximum(rep[x], rep[y]), np.minimum(rep[x], rep[y])


def _open_members(members: DataFrame, found: DataFrame) -> DataFrame | None:
    """Members of buckets that do not lie in one component, with their
    component; None if there is no such bucket."""
    placed = members.join(found, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "size", F.coalesce("component", "rep").alias("component"))
    keys = written(placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                   .where("lo != hi").select("key"), "open-buckets")
    return None if keys.isEmpty() else written(placed.join(keys, "key"), "open-members")


def _fine_sketches(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(rep, n, sketch, bands) with fine sketches for a table of ids."""
    def sketch(batches):
        for rows, texts in text_batches(batches, 4 << 20):
            sets = [shingles(t) for t in texts]
            least = [_samples(s, FINE[0]) for s in sets]
            yield pa.record_batch(
                [rows.column(0), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([_fold(x, FINE[1]) for x in least], pa.list_(pa.int64())),
                 pa.array([_band_keys(x) for x in least], pa.list_(pa.int64()))],
                names=["rep", "n", "sketch", "bands"])

    return written(docs.join(few_ids(ids.toDF("id").distinct()), "id", "left_semi")
                   .mapInArrow(sketch, "rep long, n long, sketch array<long>, bands array<long>").distinct(),
                   "fine-sketches")


def _crossing(open_: DataFrame, sketches: DataFrame, similarity: float, nearest: bool) -> DataFrame:
    """Distinct pairs (a, b) of members of a bucket in different components
    that pass by size and sketch. A bucket of more than ``BLOCK`` members is
    cut into hashed blocks, and each two blocks meet in a group of their own."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("long")
    columns = ["key", "i", "j", "n", "rep", "component", "block"]
    blocked = (open_.join(sketches, "rep")
               .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("long"))
               .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
               .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
               .select(*columns, "sketch", "bands").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))

    def compare(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            numbers = np.stack([table.column(c).to_numpy() for c in columns])
            starts = np.flatnonzero((numbers[:3, 1:] != numbers[:3, :-1]).any(0)) + 1
            done = int(starts[-1]) if len(starts) else 0
            yield from groups(table, numbers, np.concatenate([[0], starts[:-1]]) if len(starts) else starts, done)
            held = table.slice(done).combine_chunks().to_batches()[0]
        if held is not None and held.num_rows:
            table = pa.Table.from_batches([held])
            yield from groups(table, np.stack([table.column(c).to_numpy() for c in columns]), np.array([0]), held.num_rows)

    def groups(table, numbers, starts, end):
        if not end:
            return
        sketch, bands = (table.column(c).combine_chunks().flatten().to_numpy().reshape(-1, width)
                         for c, width in (("sketch", FINE[1] // 64), ("bands", BANDS)))
        out = [_compare(numbers[0, lo], *numbers[3:, lo:hi], numbers[1, lo] != numbers[2, lo],
                        sketch[lo:hi].view(np.uint64), bands[lo:hi], similarity, nearest)
               for lo, hi in zip(starts, [*starts[1:], end])]
        yield pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out)], names=["a", "b"])

    return blocked.mapInArrow(compare, "a long, b long").distinct()


def _own_links(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between a repeated id and the representative of each of its
    texts' classes, which make its texts one document."""
    worded = signed.where("id is not null and n > 0")
    again = few_ids(signed.where("id is not null").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id"))
    return written(worded.join(again, "id").select("id", "n", "f1", "f2").distinct()
                   .join(classes.select("n", "f1", "f2", "rep"), ["n", "f1", "f2"])
                   .select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct(), "own-links")


def near_duplicates(docs: DataFrame, percent: int = 75, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` (distinct word 5-grams of the whole
    text), ``component_id`` (least id reached over links, itself included) and
    ``kept`` (the id is its component's). Two documents are linked when their
    shingle sets have a Jaccard similarity of ``percent`` hundredths or more.

    A null or empty text, or one without words, has no shingles and no links.
    Rows that repeat an id are one document with the links of each of its
    texts; each is returned. A row with a null id is returned with a null
    component, kept, and linked with nothing. An empty table gives no rows.
    Other columns are not read.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = written(signatures(docs, id_col, text_col), "signatures")
    classes = written(signed.where("id is not null and n > 0").groupBy("n", "f1", "f2")
                      .agg(F.min("id").alias("rep"), F.first("bands").alias("bands"),
                           F.first("sketch").alias("sketch")), "classes")

    banded = classes.select("rep", F.explode("bands").alias("key"))
    buckets = written(banded.groupBy("key").agg(F.count("*").alias("size"), F.min("rep").alias("hub"))
                      .where("size > 1"), "buckets")
    members = written(banded.join(buckets, "key"), "members")
    first = members.where("rep != hub").select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    own = _own_links(signed, classes)
    links = own.union(_confirmed(_pass_by_sketch(first, classes, percent), plain, percent))
    found, sketches = written(components(links), "components"), None
    for last in [False] * NEAREST_ROUNDS + [True]:
        open_ = _open_members(members, found)
        if open_ is None:
            break
        # buckets only close, so the first round's members have all that is needed later
        if sketches is None:
            sketches = _fine_sketches(open_.select("rep"), plain)
        crossing = _crossing(open_, sketches, percent / 100, nearest=not last)
        links = links.union(_confirmed(crossing, plain, percent))
        found = written(components(links), "components")

    class_of = written(
        classes.join(found, F.col("rep") == F.col("node"), "left")
        .select("n", "f1", "f2", F.coalesce("component", "rep").alias("component")), "class-components")
    # an id with several texts has their component in each of its rows, those without words too
    of_id = few_ids(own.join(found, F.col("a") == F.col("node")).select(
        F.col("a").alias("id"), F.col("component").alias("shared")).distinct())
    out = (signed.select("id", "n", "f1", "f2").join(class_of, ["n", "f1", "f2"], "left")
           .join(of_id, "id", "left"))
    component = F.when(F.col("id").isNotNull(), F.coalesce("shared", "component", "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))

"""Token ids in wavelet-matrix files.

A shard holds the ids of a run of documents in document order as bit planes,
highest bit first; each plane keeps the order of the one before with the
zeros moved to the front. The file also holds the ones of each block of a
plane, so a plane answers rank and select, and one file gives back any token,
counts of a token in any range, and where its occurrences are, without
listing the ids. Sections are zstd-compressed, planes in chunks of their own,
and a query decompresses only the chunks that it looks at.

Files are written by Spark's own parquet writer, one shard (one row) a file:
commits are atomic, a retried task replaces its own output, and the files are
wherever Spark can write.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetbook.llm.common import text_batches
from fleetbook.llm.encoding import encoder

MAGIC = b"FBW2"
BLOCK = 512        # bits between two running counts
CHUNK = 1 << 14    # bytes of a plane that are compressed together, whole blocks
CHUNKS_KEPT = 64   # decompressed chunks of a plane that a reader keeps


class Plane:
    """The bits of a level, decompressed chunk by chunk as they are read."""

    def __init__(self, chunks: list[bytes], size: int):
        self.chunks, self.size, self.open = chunks, size, {}

    def _chunk(self, i: int) -> np.ndarray:
        if i not in self.open:
            if len(self.open) >= CHUNKS_KEPT:
                self.open.pop(next(iter(self.open)))
            self.open[i] = np.frombuffer(zstandard.ZstdDecompressor().decompress(self.chunks[i], max_output_size=CHUNK), np.uint8)
        return self.open[i]

    def byte(self, i: int) -> int:
        return int(self._chunk(i // CHUNK)[i % CHUNK])

    def block(self, lo: int, hi: int) -> np.ndarray:
        """Bytes [lo, hi) of one block."""
        return self._chunk(lo // CHUNK)[lo % CHUNK:(hi - 1) % CHUNK + 1] if hi > lo else np.empty(0, np.uint8)

    def whole(self) -> np.ndarray:
        unzip = zstandard.ZstdDecompressor()
        return np.frombuffer(b"".join(unzip.decompress(c, max_output_size=CHUNK) for c in self.chunks), np.uint8)


class Packed(Plane):
    """A plane that is not compressed."""

    def __init__(self, data: np.ndarray):
        self.data, self.size = data, len(data)

    def byte(self, i: int) -> int:
        return int(self.data[i])

    def block(self, lo: int, hi: int) -> np.ndarray:
        return self.data[lo:hi]

    def whole(self) -> np.ndarray:
        return self.data


def block_ones(plane: np.ndarray) -> np.ndarray:
    """The ones in each block of a plane."""
    per = np.bitwise_count(np.pad(plane, (0, -len(plane) % (BLOCK // 8))))
    return per.reshape(-1, BLOCK // 8).sum(1, dtype=np.uint16)


class WaveletMatrix:
    """Rank and select over a sequence of ids below ``2 ** bits``."""

    def __init__(self, n: int, planes: list[Plane], zeros: list[int], ones: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.ones = n, planes, zeros, ones
        self.bits = len(planes)
        self.ranks = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in ones]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        cur = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        planes, zeros, after = [], [], np.empty_like(cur)
        for shift in range(bits - 1, -1, -1):
            bit = (cur & cur.dtype.type(1 << shift)).astype(bool)
            planes.append(Packed(np.packbits(bit)))
            z = len(cur) - int(np.count_nonzero(bit))
            zeros.append(z)
            np.compress(~bit, cur, out=after[:z])
            np.compress(bit, cur, out=after[z:])
            cur, after = after, cur
        return cls(len(ids), planes, zeros, [block_ones(p.data) for p in planes])

    def _bit(self, level: int, i: int) -> int:
        return self.planes[level].byte(i >> 3) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a plane."""
        block, rest = divmod(i, BLOCK)
        plane = self.planes[level]
        at = block * BLOCK // 8
        n = int(self.ranks[level][block]) + int(np.bitwise_count(plane.block(at, i >> 3)).sum())
        return n + ((plane.byte(i >> 3) >> (8 - (rest & 7))).bit_count() if rest & 7 else 0)

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.bits):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | int(bit)
        return value

    def _range(self, value: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.bits):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if value >> (self.bits - 1 - level) & 1:
                lo, hi = self.zeros[level] + a, self.zeros[level] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, value: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``value`` in positions [lo, hi)."""
        if value >> self.bits:
            return 0
        a, b = self._range(value, lo, self.n if hi is None else hi)
        return b - a

    def _find(self, level: int, k: int, bit: int) -> int:
        """Position of the k-th (from 0) one or zero of a plane."""
        ranks = self.ranks[level]

        def before(b: int) -> int:
            return int(ranks[b]) if bit else b * BLOCK - int(ranks[b])

        block = bisect_right(range(len(ranks)), k, key=before) - 1
        plane = self.planes[level]
        data = plane.block(block * BLOCK // 8, min((block + 1) * BLOCK // 8, plane.size))
        inside = np.flatnonzero(np.unpackbits(data) == bit)
        return block * BLOCK + int(inside[k - before(block)])

    def select(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``value``."""
        if not 0 <= k < self.count(value):
            raise IndexError("no such occurrence")
        i = self._range(value, 0, 0)[0] + k
        for level in range(self.bits - 1, -1, -1):
            bit = value >> (self.bits - 1 - level) & 1
            i = self._find(level, i - self.zeros[level] if bit else i, bit)
        return i

    def occurrences(self, value: int) -> list[int]:
        return [self.select(value, k) for k in range(self.count(value))]

    def to_ids(self) -> np.ndarray:
        """The whole sequence, planes undone from the lowest bit up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        cur = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            bit = np.unpackbits(self.planes[level].whole(), count=self.n).view(bool)
            out = np.empty(self.n, kind)
            z = self.zeros[level]
            out[np.flatnonzero(~bit)] = cur[:z]
            out[np.flatnonzero(bit)] = cur[z:] | kind(1 << (self.bits - 1 - level))
            cur = out
        return cur.astype("<u4")


def pack(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int) -> bytes:
    """One shard as bytes: magic, bits, documents, ids, then the sections, each
    with its length (document ids, which of them are null, lengths, zeros per
    plane, ones per block of all planes), then per plane its chunks."""
    wm = WaveletMatrix.build(ids, bits)
    zip_ = zstandard.ZstdCompressor(level=1).compress
    out = [MAGIC, struct.pack("<BQQ", bits, len(doc_ids), len(ids))]
    for raw in (
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.packbits([d is None for d in doc_ids]).tobytes() if doc_ids else b"",
        np.array(lengths, "<u8").tobytes(),
        np.array(wm.zeros, "<u8").tobytes(),
        np.concatenate([x.astype("<u2") for x in wm.ones]).tobytes(),
    ):
        packed = zip_(raw)
        out += [struct.pack("<QQ", len(raw), len(packed)), packed]
    for plane in wm.planes:
        data = plane.whole().tobytes()
        chunks = [zip_(data[lo:lo + CHUNK]) for lo in range(0, len(data), CHUNK)]
        out += [struct.pack(f"<Q{len(chunks)}I", len(data), *map(len, chunks)), *chunks]
    return b"".join(out)


def unpack(data: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, lengths and the wavelet matrix of one shard file; its
    planes stay compressed until they are read."""
    if data[:4] != MAGIC:
        raise ValueError("not a token shard")
    bits, n_docs, n = struct.unpack_from("<BQQ", data, 4)
    at, sections = 4 + struct.calcsize("<BQQ"), []
    unzip = zstandard.ZstdDecompressor()
    for _ in range(5):
        raw, packed = struct.unpack_from("<QQ", data, at)
        at += 16
        sections.append(unzip.decompress(data[at:at + packed], max_output_size=raw) if raw else b"")
        at += packed
    planes = []
    for _ in range(bits):
        size, = struct.unpack_from("<Q", data, at)
        lengths = struct.unpack_from(f"<{-(-size // CHUNK)}I", data, at + 8)
        at += 8 + 4 * len(lengths)
        edges = list(accumulate(lengths, initial=at))
        planes.append(Plane([data[lo:hi] for lo, hi in zip(edges, edges[1:])], size))
        at = edges[-1]
    nulls = np.unpackbits(np.frombuffer(sections[1], np.uint8), count=n_docs)
    docs = [None if x else int(d) for d, x in zip(np.frombuffer(sections[0], "<i8"), nulls)]
    zeros = [int(z) for z in np.frombuffer(sections[3], "<u8")]
    ones = list(np.frombuffer(sections[4], "<u2").reshape(bits, -1)) if bits else []
    return docs, np.frombuffer(sections[2], "<u8").astype(np.int64), WaveletMatrix(n, planes, zeros, ones)


SHARDS = "part int, seq int, n_docs long, n_tokens long, payload binary"


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, bits: int = 16,
                 id_col: str = "doc_id", text_col: str = "text", shard_tokens: int = 1 << 20,
                 chunk_bytes: int = 1 << 20) -> None:
    """Encode every whole text, append ``end_id`` to each document and write
    the ids as wavelet-matrix shards in ascending document order.

    Rows are range-partitioned by id and sorted inside a partition (a null id
    first; rows of equal id by text); each partition streams its documents
    into shards of about ``shard_tokens`` ids, so memory is bounded by a shard
    or by one document. A null text is empty: its document holds the end id
    alone. ``bits`` must hold the largest id.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
               .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text"))
    end = np.array([end_id], "<u4").tobytes()

    def build(batches):
        encode, part, seq = encoder(tokenizer, ids=True), TaskContext.get().partitionId(), 0
        held, names, lengths, n = [], [], [], 0

        def flush():
            ids = np.frombuffer(b"".join(held), "<u4")
            if len(ids) and int(ids.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            return pa.RecordBatch.from_pylist(
                [{"part": part, "seq": seq, "n_docs": len(names), "n_tokens": len(ids),
                  "payload": pack(names, lengths, ids, bits)}],
                schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                                  ("n_tokens", pa.int64()), ("payload", pa.binary())]))

        for rows, texts in text_batches(batches, chunk_bytes):
            for name, data in zip(rows.column(0).to_pylist(), encode(texts)):
                size = len(data) // 4 + 1
                if n and n + size > shard_tokens:
                    yield flush()
                    seq += 1
                    held.clear(), names.clear(), lengths.clear()
                    n = 0
                held += [data, end]
                names.append(name)
                lengths.append(size)
                n += size
        if n:
            yield flush()

    (ordered.mapInArrow(build, SHARDS).write.mode("overwrite")
     .option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path))


def _shards(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The shard files, and (part, seq, base): the ids before each shard."""
    shards = spark.read.schema(SHARDS).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    before = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition, so the one-task window below stays small
    parts_before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
             .select("part", F.coalesce(F.sum("size").over(parts_before), F.lit(0)).alias("part_start")))
    starts = (sizes.withColumn("shard_start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
              .join(parts, "part")
              .select("part", "seq", (F.col("part_start") + F.col("shard_start")).alias("base")))
    return shards, starts


def _asked(spark: SparkSession, path: str, answer, schema: str) -> DataFrame:
    """``answer(base, docs, lengths, matrix)`` gives rows for every shard."""
    shards, starts = _shards(spark, path)

    def each(batches):
        for batch in batches:
            for row in batch.to_pylist():
                rows = list(answer(row["base"], *unpack(row["payload"])))
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows], schema=kinds)

    names = [c.split()[0] for c in schema.split(", ")]
    kinds = pa.schema([(n, pa.int64()) for n in names])
    return shards.join(starts, ["part", "seq"]).select("base", "payload").mapInArrow(each, schema)


def occurrences(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """Where the asked tokens are: token, doc_id, offset in the document and
    position among all ids; a row each, by select on each shard. The tokens
    are a short list; a token that is nowhere has no row."""
    wanted = sorted(set(tokens))

    def answer(base, docs, lengths, wm):
        ends = np.cumsum(lengths)
        for token in wanted:
            for at in wm.occurrences(token):
                i = int(np.searchsorted(ends, at, side="right"))
                yield token, docs[i], at - int(ends[i] - lengths[i]), base + at

    return _asked(spark, path, answer, "token long, doc_id long, offset long, position long")


def token_frequencies(spark: SparkSession, path: str, tokens: Sequence[int], lo: int = 0,
                      hi: int | None = None) -> DataFrame:
    """(token, n): how often each asked token is among the ids [lo, hi), by
    two ranks a plane on each shard."""
    wanted = sorted(set(tokens))

    def answer(base, docs, lengths, wm):
        first, last = max(0, lo - base), wm.n if hi is None else min(wm.n, hi - base)
        if first < last:
            yield from ((token, wm.count(token, first, last)) for token in wanted)

    found = _asked(spark, path, answer, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    asked = spark.createDataFrame([(t,) for t in wanted], "token long")
    return asked.join(found, "token", "left").select("token", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def tokens_at(spark: SparkSession, path: str, positions: Sequence[int]) -> DataFrame:
    """(position, token) of the asked positions among all ids; those beyond
    the ids have no row."""
    wanted = sorted(set(positions))

    def answer(base, docs, lengths, wm):
        lo, hi = bisect_left(wanted, base), bisect_left(wanted, base + wm.n)
        yield from ((p, wm.access(p - base)) for p in wanted[lo:hi])

    return _asked(spark, path, answer, "position long, token long")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the shard files alone: doc_id, start (ids of all
    documents before it), n_tokens, ids_crc32 (of its ids as little-endian
    unsigned 32-bit integers).

    Starts add three running sums: inside a shard, over the shards of a
    partition, and over partitions (as many rows as partitions).
    """
    shards, starts = _shards(spark, path)

    def documents(batches):
        for batch in batches:
            for row in batch.to_pylist():
                names, lengths, wm = unpack(row["payload"])
                ids, ends = wm.to_ids(), np.cumsum(lengths)
                crc = [zlib.crc32(ids[e - k:e]) for e, k in zip(ends, lengths)]
                yield pa.record_batch(
                    [pa.array([row["part"]] * len(names), pa.int32()),
                     pa.array([row["seq"]] * len(names), pa.int32()), pa.array(names, pa.int64()),
                     pa.array(ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(crc, pa.int64())],
                    names=["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])

    rows = shards.select("part", "seq", "payload").mapInArrow(
        documents, "part int, seq int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    return (rows.join(starts, ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"))

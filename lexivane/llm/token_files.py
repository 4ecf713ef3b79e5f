"""Token-ID files with a minimal perfect hash index.

Documents are dealt and sorted by key, encoded with the tokenizers library (its
normalizer, pre-tokenizer and model, each distinct whitespace-free run of a batch once), and packed into shards of a bounded size that
Spark's own writer commits, one file each, in whatever file system the path names. A
shard holds, little-endian:

    magic 8 bytes | partition u32 | sequence u32 | n_docs u64 | n_ids u64 | id width u32 | n_levels u32 | n_overflow u64
    sizes of levels in bits u64 * n_levels
    each level in blocks of 512 bits: set bits before the block u32 | bits 64 bytes
    slots, in the order of the hash: fingerprint u32 | crc32 of the ids u32 | length u32 | offset u64
    overflow, sorted: null flag u8 | key i64 | occurrence u32
    keys: i64 * n_docs, null flag u8 * n_docs, occurrence u32 * n_docs, in the order of the payload
    raw id payload: n_ids * width | crc32 u32 of all before

The index is a minimal perfect hash of levelled bit arrays: a key takes the position of
its first level in which no other key has its bit, and the rank of that bit is its slot.
Keys whose hashes agree in all 64 bits never part, so after LEVELS levels what is left
goes to the overflow, which is searched by key; its slots come last. A lookup reads one
block per level that it tries (less than two on average), one slot and its own ids, by
byte ranges: its cost doesn't grow with the shard. A key that isn't there is told by its
fingerprint but for one in 2^32.

Shards cover disjoint ascending ranges of keys. When they are written, a manifest (Parquet,
a row per shard, in their order) is made of them, which leads a key to its shard and gives
the shard's first position; a lookup reads the rows whose range has one of its keys.

Defined results: null text is empty text, which has the end id alone; a null key comes
first and can be looked up as None; documents with the same key are ordered by text and
told apart by their occurrence within a shard; an empty table gives no shard. Keys must be
numbers (they are cast to long); other columns aren't written, whatever their names.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexivane.llm.bpe import coder, slices
from lexivane.llm.common import bounded_batches, materialize, shuffles_end_with_their_query, tidied

MAGIC = b"LXVIDS02"
HEAD = struct.Struct("<8sIIQQIIQ")
SHARD_BYTES = 4 << 20  # of ids; a shard is held a few times over in a task, so raise it with the executors' memory
SHARD_DOCS = 1 << 16
GAMMA = 2.0
LEVELS = 40
BITS = 512
MANIFEST = "_manifest"
BLOCK = np.dtype([("before", "<u4"), ("bits", "u1", BITS // 8)])
SLOT = np.dtype([("print", "<u4"), ("crc", "<u4"), ("size", "<u4"), ("at", "<u8")])
SPILLED = np.dtype([("null", "u1"), ("key", "<i8"), ("occurrence", "<u4")])


# ---- minimal perfect hash -----------------------------------------------------------
def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    """A 64-bit finalizer, salted."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def key_hash(keys: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    return _mixed(_mixed(keys.astype(np.int64).view(np.uint64), 1) ^ _mixed((occurrence.astype(np.uint64) << np.uint64(1)) | null.astype(np.uint64), 2), 3)


def position(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """The bit of each hash in a level of so many bits."""
    return (_mixed(hashes, 100 + level) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Levels of bit arrays over 64-bit hashes; those that agree in all bits are left over."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        ones = [np.concatenate([[0], np.cumsum(x)]) for x in levels]
        bases = np.cumsum([0, *(int(o[-1]) for o in ones)])
        self.ranks = [o + b for o, b in zip(ones, bases)]
        self.n = int(bases[-1])

    @classmethod
    def build(cls, hashes: np.ndarray) -> "PerfectHash":
        levels, left = [], hashes
        while len(left) and len(levels) < LEVELS:
            size = max(64, int(GAMMA * len(left)))
            at = position(left, len(levels), size)
            bits = np.bincount(at, minlength=size) == 1
            levels.append(bits)
            left = left[~bits[at]]
        return cls(levels)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash; -1 where no level has its bit."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        left = np.arange(len(hashes))
        for level, bits in enumerate(self.levels):
            at = position(hashes[left], level, len(bits))
            hit = bits[at]
            out[left[hit]] = self.ranks[level][at[hit]]
            left = left[~hit]
        return out

    def blocks(self, level: int) -> np.ndarray:
        """A level as it is stored."""
        bits = self.levels[level]
        out = np.zeros(-(-len(bits) // BITS), BLOCK)
        out["before"] = self.ranks[level][: len(bits) : BITS]
        out["bits"] = np.packbits(np.pad(bits, (0, -len(bits) % BITS)), bitorder="little").reshape(-1, BITS // 8)
        return out


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    return (_mixed(hashes, 7) >> np.uint64(32)).astype(np.uint32)


# ---- shards -------------------------------------------------------------------------
def pack(partition: int, sequence: int, keys: np.ndarray, null: np.ndarray, lengths: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    occurrence = pd.DataFrame({"k": keys, "n": null}).groupby(["k", "n"]).cumcount().to_numpy().astype(np.uint32)
    hashes = key_hash(keys, null, occurrence)
    index = PerfectHash.build(hashes)
    slot = index.slots(hashes)
    spilled = np.zeros(int((slot < 0).sum()), SPILLED)
    if len(spilled):
        rest = np.flatnonzero(slot < 0)
        rest = rest[np.lexsort((occurrence[rest], keys[rest], null[rest]))]
        spilled["null"], spilled["key"], spilled["occurrence"] = null[rest], keys[rest], occurrence[rest]
        slot[rest] = index.n + np.arange(len(rest))
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    wide = np.ascontiguousarray(ids, dtype="<u4")
    made = np.zeros(len(keys), SLOT)
    made["print"][slot], made["size"][slot], made["at"][slot] = fingerprint(hashes), lengths, ends[:-1]
    made["crc"][slot] = [zlib.crc32(wide[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
    parts = [HEAD.pack(MAGIC, partition, sequence, len(keys), len(ids), width, len(index.levels), len(spilled)), np.array([len(x) for x in index.levels], "<u8").tobytes()]
    parts += [index.blocks(i).tobytes() for i in range(len(index.levels))]
    parts += [made.tobytes(), spilled.tobytes(), keys.astype("<i8").tobytes(), null.astype(np.uint8).tobytes(), occurrence.astype("<u4").tobytes()]
    parts.append(memoryview(np.ascontiguousarray(ids, dtype="<u2" if width == 2 else "<u4")).cast("B"))
    crc = 0
    for p in parts:
        crc = zlib.crc32(p, crc)
    return b"".join([*parts, struct.pack("<I", crc)])


class Index:
    """Keyed access to one shard by byte ranges: `read(at, n)` gives n bytes of it."""

    def __init__(self, read):
        self.read = read
        magic, self.partition, self.sequence, self.n_docs, self.n_ids, self.width, n_levels, self.n_spilled = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        self.sizes = np.frombuffer(read(HEAD.size, 8 * n_levels), "<u8").astype(np.int64).tolist()
        at, self.levels = HEAD.size + 8 * n_levels, []
        for size in self.sizes:
            self.levels.append(at)
            at += BLOCK.itemsize * -(-size // BITS)
        self.slots = at
        self.spilled = self.slots + SLOT.itemsize * self.n_docs
        self.keys = self.spilled + SPILLED.itemsize * self.n_spilled
        self.payload = self.keys + 13 * self.n_docs

    def find(self, key: int | None, occurrence: int = 0) -> list[int] | None:
        """The ids of a key's document, None if it isn't here."""
        null = np.array([key is None], np.uint8)
        hashes = key_hash(np.array([key or 0]), null, np.array([occurrence]))
        slot = -1
        for level, (size, start) in enumerate(zip(self.sizes, self.levels)):
            at = int(position(hashes, level, size)[0])
            block = np.frombuffer(self.read(start + BLOCK.itemsize * (at // BITS), BLOCK.itemsize), BLOCK)[0]
            bits = np.unpackbits(block["bits"], bitorder="little")
            if bits[at % BITS]:
                slot = int(block["before"]) + int(bits[: at % BITS].sum())
                break
        if slot < 0:
            slot = self._spilled_slot((int(null[0]), key or 0, occurrence))
            if slot < 0:
                return None
        found = np.frombuffer(self.read(self.slots + SLOT.itemsize * slot, SLOT.itemsize), SLOT)[0]
        if found["print"] != fingerprint(hashes)[0]:
            return None
        raw = self.read(self.payload + self.width * int(found["at"]), self.width * int(found["size"]))
        ids = np.frombuffer(raw, "<u2" if self.width == 2 else "<u4")
        if zlib.crc32(ids.astype("<u4")) != found["crc"]:
            raise ValueError("a document's ids are damaged")
        return ids.tolist()

    def _spilled_slot(self, wanted: tuple[int, int, int]) -> int:
        low, high = 0, self.n_spilled
        while low < high:
            middle = (low + high) // 2
            x = np.frombuffer(self.read(self.spilled + SPILLED.itemsize * middle, SPILLED.itemsize), SPILLED)[0]
            here = (int(x["null"]), int(x["key"]), int(x["occurrence"]))
            if here == wanted:
                return self.n_docs - self.n_spilled + middle
            low, high = (middle + 1, high) if here < wanted else (low, middle)
        return -1


class Shard:
    """A whole shard read back and verified."""

    def __init__(self, data: bytes):
        body = memoryview(data)[:-5] if data[-1:] == b"\n" and zlib.crc32(memoryview(data)[:-5]) == struct.unpack("<I", data[-5:-1])[0] else memoryview(data)[:-4]
        if zlib.crc32(body) != struct.unpack("<I", bytes(data[len(body) : len(body) + 4]))[0]:
            raise ValueError("a shard is damaged")
        x = Index(lambda at, n: bytes(body[at : at + n]))
        self.partition, self.sequence, self.n_docs, self.n_ids, self.width = x.partition, x.sequence, x.n_docs, x.n_ids, x.width
        levels = [np.unpackbits(np.frombuffer(body, BLOCK, -(-size // BITS), start)["bits"].reshape(-1), bitorder="little")[:size].astype(bool) for size, start in zip(x.sizes, x.levels)]
        self.index = PerfectHash(levels)
        self.slots, self.spilled = np.frombuffer(body, SLOT, self.n_docs, x.slots), np.frombuffer(body, SPILLED, x.n_spilled, x.spilled)
        n = self.n_docs
        self.keys, self.null, self.occurrence = np.frombuffer(body, "<i8", n, x.keys), np.frombuffer(body, np.uint8, n, x.keys + 8 * n), np.frombuffer(body, "<u4", n, x.keys + 9 * n)
        self.ids = np.frombuffer(body, "<u2" if self.width == 2 else "<u4", self.n_ids, x.payload)

    def find(self, keys: np.ndarray, null: np.ndarray, occurrence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Offset and length in ids for each key; -1 and 0 for those that aren't here."""
        hashes = key_hash(keys, null, occurrence)
        slot = self.index.slots(hashes)
        if len(self.spilled):
            known = {tuple(map(int, x)): self.index.n + i for i, x in enumerate(self.spilled)}
            for i in np.flatnonzero(slot < 0):
                slot[i] = known.get((int(null[i]), int(keys[i]), int(occurrence[i])), -1)
        if not self.n_docs:
            return np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        found = self.slots[np.maximum(slot, 0)]
        here = (slot >= 0) & (found["print"] == fingerprint(hashes))
        return np.where(here, found["at"].astype(np.int64), -1), np.where(here, found["size"].astype(np.int64), 0)


# ---- writing and reading by Spark -----------------------------------------------------
def write(docs: DataFrame, out: str, tokenizer: str, key_col: str = "doc_id", text_col: str = "text", end_id: int | None = 1, vocab_size: int = 49408, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the token ids of docs in ascending key order as shards under the folder out."""
    spark = docs.sparkSession
    bounded_batches(spark)
    width = 2 if max(vocab_size, (end_id or 0) + 1) <= 1 << 16 else 4
    slim = docs.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text"), F.col("text")]
    dealt = slim.repartitionByRange(n, *order[:2]).sortWithinPartitions(*order)

    def run(batches):
        partition, sequence = TaskContext.get().partitionId(), 0
        held, rows, size = [], 0, 0

        def flush():
            nonlocal sequence, held, rows, size
            keys, null, lengths, ids = (np.concatenate(x) for x in zip(*held))
            data = pack(partition, sequence, keys, null, lengths, ids, width)
            sequence, held, rows, size = sequence + 1, [], 0, 0
            return pa.RecordBatch.from_arrays([pa.Array.from_buffers(pa.binary(), 1, [None, pa.py_buffer(struct.pack("<2i", 0, len(data))), pa.py_buffer(data)])], names=["data"])

        for whole in batches:
            for batch in slices(whole, "text", 6_000_000):
                lists = coder(tokenizer, tree=False).encode_batch(batch.column(1))
                ends, flat = np.asarray(lists.offsets).astype(np.int64), np.asarray(lists.values)
                lengths = np.diff(ends)
                if end_id is not None:
                    flat = np.insert(flat, ends[1:], end_id)
                    lengths = lengths + 1
                key = batch.column(0)
                null = np.asarray(key.is_null()).astype(np.uint8)
                keys = np.asarray(key.fill_null(0)).astype(np.int64)
                held.append((keys, null, lengths, flat.astype(np.uint16 if width == 2 else np.uint32)))
                rows, size = rows + len(keys), size + width * len(flat)
                if size >= shard_bytes or rows >= SHARD_DOCS:
                    yield flush()
        if held:
            yield flush()

    files = dealt.mapInArrow(tidied(run), "data binary").select(F.col("data").cast("string").alias("value"))
    with shuffles_end_with_their_query(spark):
        files.write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(out)
        shards_of(spark, out).orderBy("start").write.parquet(f"{out}/{MANIFEST}")


def _files(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(out)


def shards_of(spark: SparkSession, out: str) -> DataFrame:
    """A row per shard, read from the shards, each of which is verified: path, partition, sequence, n_docs, n_ids, first and last key, whether it begins with null keys, and start (ids before it)."""

    def run(frames):
        for pdf in frames:
            rows = []
            for path, data in zip(pdf["path"], pdf["content"]):
                s = Shard(data)
                some = s.keys[s.null == 0]
                rows.append((path, s.partition, s.sequence, s.n_docs, s.n_ids, int(some[0]) if len(some) else None, int(some[-1]) if len(some) else None, bool(s.null[0])))
            yield pd.DataFrame(rows, columns=["path", "partition", "sequence", "n_docs", "n_ids", "first_key", "last_key", "has_null"]).astype({"first_key": "Int64", "last_key": "Int64"})

    found = _files(spark, out).select("path", "content").mapInPandas(run, "path string, partition long, sequence long, n_docs long, n_ids long, first_key long, last_key long, has_null boolean")
    return _with_starts(found)


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """The manifest as it was written with the shards."""
    return spark.read.parquet(f"{out}/{MANIFEST}")


def _with_starts(shards: DataFrame) -> DataFrame:
    """A row per shard (megabytes each), so the running sum over all of them is small."""
    before = Window.orderBy("partition", "sequence").rowsBetween(Window.unboundedPreceding, -1)
    return shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(spark: SparkSession, out: str, with_ids: bool = False) -> DataFrame:
    """Every document, by keyed lookup in its shard's index: doc_id, start, n_tokens, ids_crc32 (and ids)."""

    def run(batches):
        for batch in batches:
            for data in batch.column(0):
                s = Shard(data.as_py())
                at, size = s.find(s.keys, s.null, s.occurrence)
                if (at < 0).any():
                    raise ValueError("a key isn't in its shard's index")
                ids = s.ids.astype("<u4")
                crc = [zlib.crc32(ids[a : a + n]) for a, n in zip(at.tolist(), size.tolist())]
                cols = [pa.array(s.keys, mask=s.null.astype(bool)), pa.array(np.full(len(at), s.partition, np.int64)), pa.array(np.full(len(at), s.sequence, np.int64)), pa.array(at), pa.array(size), pa.array(crc, pa.int64())]
                names = ["doc_id", "partition", "sequence", "at", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.array([ids[a : a + n].astype(np.int64) for a, n in zip(at.tolist(), size.tolist())], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "doc_id long, partition long, sequence long, at long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")
    bounded_batches(spark)
    rows = _files(spark, out).select("content").mapInArrow(tidied(run), schema)
    if not with_ids:
        rows = materialize(rows, "read")  # slim; the files are read once
        shards = rows.groupBy("partition", "sequence").agg(F.sum("n_tokens").alias("n_ids"))
        starts = _with_starts(shards).select("partition", "sequence", "start")
    else:
        starts = manifest(spark, out).select("partition", "sequence", "start")
    joined = rows.join(starts, ["partition", "sequence"])
    return joined.select("doc_id", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


class Ranges:
    """Byte ranges of one file by Hadoop's file system, wherever it lies; counts the bytes that were asked for."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, p = spark._jvm, spark._jvm.org.apache.hadoop.fs.Path(path)
        self.stream, self.bytes = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p), 0

    def __call__(self, at: int, n: int) -> bytes:
        self.bytes += n
        if not n:
            return b""
        self.stream.seek(at)
        return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n))

    def close(self) -> None:
        self.stream.close()


def lookup(spark: SparkSession, out: str, keys: list[int | None], counted: list | None = None) -> dict:
    """Ids of a few keys by keyed access: for each the ids of its documents, in order.

    The manifest's rows whose ranges have one of the keys are read (several for a key where
    its repeats cross shards); of their shards a lookup reads the head, the blocks and slot
    that its hash names, and its ids. `counted` gets the bytes read of each shard.
    """
    found: dict = {k: [] for k in keys}
    some = [k for k in found if k is not None]
    inside = F.lit(False)
    for k in some:
        inside = inside | ((F.col("first_key") <= k) & (F.col("last_key") >= k))
    if None in found:
        inside = inside | F.col("has_null")
    for r in manifest(spark, out).filter(inside).orderBy("start").collect():
        read = Ranges(spark, r.path)
        try:
            shard = Index(read)
            for k in found:
                if not (r.has_null if k is None else r.first_key is not None and r.first_key <= k <= r.last_key):
                    continue
                occurrence = 0
                while (ids := shard.find(k, occurrence)) is not None:
                    found[k].append(ids)
                    occurrence += 1
        finally:
            read.close()
        if counted is not None:
            counted.append(read.bytes)
    return found

"""Media columns by content-defined payload chunking.

A payload is kept as 8-bit mono samples in a WAV container. Its bytes are cut where a
rolling gear hash of the last 32 bytes meets a mask, every half kilobyte or so, so equal
passages give equal chunks wherever they lie. Chunks and media are named by the first 16
bytes of their SHA-256; the store holds each digest once (a distinct by digest) and a
recipe holds each payload's ordered chunk list. Reconstruction joins recipes with the
store, checks the whole media's digest, and computes features from what was read back.

Chunks are compressed with zstandard under a dictionary that is trained on the first
SAMPLE_BYTES of at most SAMPLE texts, chosen by their hash; with too little text for the
trainer there is none. It only changes the size of the store, never what is read back.

Distinct payloads are told apart by the SHA-256 of their bytes: copies share one recipe
and are reconstructed once, however many there are. Media are put together in WAVES parts,
so that only a part of the store is on the move at a time. Texts are cut twice, once for
recipes and once for chunks: in one pass the chunks of all copies would have to be kept
until they are distinct, which costs the store's size once more.

Defined results: null text is empty text; the empty payload is 64 zero samples; ties and
repeated rows keep their rows; an empty table gives an empty result; other columns of the
input aren't carried over, so their names don't matter. Keys must be numbers (they are
cast to long).
"""

from __future__ import annotations

import hashlib
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.llm.bpe import slices
from lexivane.llm.common import bounded_batches, materialize, remove_path, scratch, shuffles_end_with_their_query, tidied, work_path

UNIT = 64
RATE = 8000
MIN_CHUNK, MAX_CHUNK = 1 << 8, 1 << 16
MASK = np.uint32(((1 << 9) - 1) << 23)
STEPS = 5
LEVEL = 12
SAMPLE, SAMPLE_BYTES, DICTIONARY = 1500, 4000, 1 << 18
NAME_BYTES = 16
SEEN = 1 << 18
HOT_USES, SALTS = 2000, 32
WAVES = 2


def _gear() -> np.ndarray:
    """256 pseudo-random 32-bit words from a rule."""
    x = np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(32)).astype(np.uint32)


GEAR = _gear()


def wav(samples: bytes) -> bytes:
    """Samples as an 8-bit mono WAV file."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", (36 + len(samples)) & 0xFFFFFFFF, b"WAVE", b"fmt ", 16, 1, 1, RATE, RATE, 1, 8, b"data", len(samples))
    return head + samples


def samples_of(media: bytes) -> bytes:
    """The samples of such a file."""
    if media[:4] != b"RIFF" or media[36:40] != b"data" or struct.unpack("<I", media[40:44])[0] != len(media) - 44:
        raise ValueError("not a WAV file of this form")
    return media[44:]


def name_of(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:NAME_BYTES]


def payload(data: bytes) -> bytes:
    return data + bytes(UNIT - len(data) % UNIT if len(data) % UNIT or not data else 0)


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: sum of GEAR of the last 32 bytes, each shifted by its age; by doubling."""
    h = GEAR[data]
    for k in range(STEPS):
        w = 1 << k
        h[w:] = h[w:] + (h[:-w] << np.uint32(w))
    return h


def cuts(data: bytes) -> list[int]:
    """Ends of the chunks of one media file."""
    n = len(data)
    if n <= MIN_CHUNK:
        return [n]
    marks = np.flatnonzero((rolling(np.frombuffer(data, np.uint8)) & MASK) == 0) + 1
    out, at = [], 0
    while n - at > MIN_CHUNK:
        i = int(np.searchsorted(marks, at + MIN_CHUNK))
        end = min(int(marks[i]) if i < len(marks) else n, at + MAX_CHUNK, n)
        out.append(end)
        at = end
    if at < n:
        out.append(n)
    return out


def recipes(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row of docs: doc_id, media (the name of its media), n_bytes (unpadded) and recipe, the ordered chunk list (digest, size)."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(key_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    item = pa.struct([("digest", pa.binary()), ("size", pa.int32())])

    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                names, sizes, lists = [], [], []
                for text in batch.column(1):
                    raw = text.as_buffer().to_pybytes() if text.is_valid else b""
                    media = wav(payload(raw))
                    names.append(name_of(media))
                    sizes.append(len(raw))
                    ends = cuts(media)
                    lists.append([{"digest": name_of(media[x:y]), "size": y - x} for x, y in zip([0, *ends], ends)])
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.binary()), pa.array(sizes, pa.int64()), pa.array(lists, pa.list_(item))], names=["doc_id", "media", "n_bytes", "recipe"])

    return slim.mapInArrow(tidied(run), "doc_id long, media binary, n_bytes long, recipe array<struct<digest:binary,size:int>>")


def dictionary(docs: DataFrame, text_col: str = "text") -> bytes:
    """A zstandard dictionary for chunks from a bounded choice of texts; empty where there is too little to train on."""
    t = F.col(text_col).cast("string")
    some = docs.filter(t.isNotNull()).select(F.xxhash64(t).alias("h"), F.substring(t, 1, SAMPLE_BYTES).alias("t"))
    # The choice is made of hashes alone; only the texts that have one of the least are brought together, copies once.
    most = some.select("h").distinct().orderBy("h").limit(SAMPLE).agg(F.max("h").alias("h")).head().h
    if most is None:
        return b""
    rows = some.filter(F.col("h") <= most).groupBy("h").agg(F.min("t").alias("t")).orderBy("h").toArrow()
    try:
        return zstandard.train_dictionary(DICTIONARY, [wav(payload(x.encode())) for x in rows.column("t").to_pylist()], k=48, d=6, level=3).as_bytes()
    except zstandard.ZstdError:
        return b""


def packer(known: bytes):
    params = zstandard.ZstdCompressionParameters.from_level(LEVEL, source_size=1 << 10, dict_size=len(known), format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_checksum=False, write_dict_id=False, write_content_size=True)
    d = zstandard.ZstdCompressionDict(known)
    if known:
        d.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=d, compression_params=params).compress


def unpacker(known: bytes):
    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(known), format=zstandard.FORMAT_ZSTD1_MAGICLESS).decompress


def chunks(docs: DataFrame, known: bytes, text_col: str = "text") -> DataFrame:
    """The chunks of each row of docs: digest and data (compressed under the dictionary). Repeats within a task are left out, as far as SEEN digests tell them."""
    bounded_batches(docs.sparkSession)
    slim = docs.select(F.col(text_col).cast("string").alias("text"))

    def run(batches):
        pack, seen = packer(known), set()
        for whole in batches:
            for batch in slices(whole, "text", 1_000_000):
                found = {}
                if len(seen) > SEEN:
                    seen.clear()
                for text in batch.column(0):
                    media, at = wav(payload(text.as_buffer().to_pybytes() if text.is_valid else b"")), 0
                    for end in cuts(media):
                        digest = name_of(media[at:end])
                        if digest not in seen:
                            seen.add(digest)
                            found[digest] = pack(media[at:end])
                        at = end
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.binary())], names=["digest", "data"])

    return slim.mapInArrow(tidied(run), "digest binary, data binary")


class Store:
    """The chunk store: a table of each digest once with its bytes, in buckets of the digest so that joins by digest don't move it, and the dictionary of the chunks."""

    def __init__(self, docs: DataFrame, text_col: str = "text"):
        self.spark = docs.sparkSession
        n = max(2, int(self.spark.conf.get("spark.sql.shuffle.partitions", "200")))
        self.dictionary = dictionary(docs, text_col)
        once = chunks(docs, self.dictionary, text_col).repartition(n, "digest").dropDuplicates(["digest"])
        self.name, self.path = "lexivane_chunks_" + uuid.uuid4().hex, work_path(self.spark, "chunks")
        with shuffles_end_with_their_query(self.spark):
            once.write.bucketBy(n, "digest").option("path", self.path).option("compression", "none").saveAsTable(self.name)

    @property
    def df(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        remove_path(self.spark, self.path.rsplit("/", 1)[0])


def rebuild(lists: DataFrame, store: Store) -> DataFrame:
    """Each media of the lists (media, recipe; each media once), put together from the store and verified: media, payload and media figures and feature.

    Chunks used by more than HOT_USES media are few; their uses are dealt over SALTS
    copies of them, so that no task gets all uses of one chunk.
    """
    kept, known = store.df, store.dictionary
    parts = lists.select("media", F.size("recipe").alias("n"), F.posexplode("recipe").alias("seq", "part")).select("media", "n", "seq", F.col("part.digest").alias("digest"))
    hot = materialize(parts.groupBy("digest").count().filter(F.col("count") > HOT_USES).select("digest"), "hot")

    def with_data(wanted: DataFrame) -> DataFrame:
        cool = wanted.join(hot, "digest", "left_anti").join(kept, "digest")
        salted = wanted.join(hot, "digest", "left_semi").withColumn("salt", F.pmod(F.xxhash64("media"), F.lit(SALTS)))
        copies = kept.join(hot, "digest", "left_semi").withColumn("salt", F.explode(F.array([F.lit(i).cast("long") for i in range(SALTS)])))
        return cool.select("media", "n", "seq", "data").unionByName(salted.join(copies, ["digest", "salt"]).select("media", "n", "seq", "data"))

    whole = with_data(parts).groupBy("media").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("seq", "data"))).alias("list"))
    schema = "media binary, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def run(batches):
        unpack = unpacker(known)
        for batch in batches:
            rows = []
            for name, n, chain in zip(batch.column(0), batch.column(1), batch.column(2)):
                media = b"".join([unpack(x) for x in chain.values.field("data").to_pylist()])
                sha = hashlib.sha256(media)
                if len(chain) != n.as_py() or sha.digest()[:NAME_BYTES] != name.as_py():
                    raise ValueError("a payload is damaged")
                x = samples_of(media)
                rows.append((name.as_py(), len(x), hashlib.sha256(x).hexdigest(), zlib.crc32(x[-UNIT:]), len(media), sha.hexdigest(), features(x)))
            kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
            cols = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[c.split()[0] for c in schema.split(", ")])

    return whole.mapInArrow(tidied(run), schema)


def media_columns(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes and the read-back figures of each row of docs. The store is dropped when all media are read back."""
    store = Store(docs, text_col)
    try:
        with scratch(docs.sparkSession) as keep:
            held = keep(materialize(recipes(docs, key_col, text_col), "recipes"))
            wave = F.pmod(F.xxhash64("media"), F.lit(WAVES)).alias("wave")
            lists = materialize(held.select("media", "recipe", wave).dropDuplicates(["media"]), "lists")
            found = None
            for w in range(WAVES):
                part = keep(materialize(rebuild(lists.filter(F.col("wave") == w).select("media", "recipe"), store), "rebuilt"))
                found = part if found is None else found.unionByName(part)
    finally:
        store.drop()
    return held.select("doc_id", "n_bytes", "media").join(found, "media").drop("media")


def features(samples: bytes) -> str:
    """Mean, root mean square, crossings of the middle and entropy in bits of 8-bit samples."""
    x = np.frombuffer(samples, np.uint8)
    counts = np.bincount(x, minlength=256)
    p = counts[counts > 0] / len(x)
    y = x.astype(np.int32) - 128
    crossings = int(np.count_nonzero((y[1:] < 0) != (y[:-1] < 0)))
    return f"n={len(x)};mean={x.mean():.4f};rms={float(np.sqrt(np.mean(np.square(y, dtype=np.float64)))):.4f};zc={crossings};h={float(-(p * np.log2(p)).sum()):.4f}"

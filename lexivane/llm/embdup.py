"""Near-duplicates of embeddings by cross-polytope hashing.

A vector is turned by three rounds of random signs and fast Hadamard transforms; its hash
is the largest coordinate with its sign, and `depth` such hashes name a bucket of a table.
Besides its own bucket a vector is put into the PROBES buckets that are next likely (a
second or third largest coordinate in place of the largest, least loss first).

Every bucket that holds several vectors is named by its pivot, the least of them, and the
buckets of one pivot are one group: the many buckets that a set of near copies shares
count once, and each of its vectors is sent once. The vectors of a group are candidates;
their cosines are computed in double precision, by matrix products in blocks of a bounded
number of vectors. A linked pair counts only in the first of the groups that it shares, so
counts are exact over the pairs found, and each block reports sums per vector and a
spanning forest: no list of all pairs is made, however large a group of copies.

Equal vectors form one node and are never compared. The depth grows with the logarithm of
the number of vectors, so that unlike vectors fill at most LOAD of a table's buckets and
rarely meet, and the number of tables is the least for which a pair at the threshold
misses all of them with probability MISS, by the share of such pairs (made at random in
the vectors' own dimension, with a fixed seed) that one table of that depth lets meet.

Defined results: null vectors, empty ones, zero vectors and those with null or non-finite
components link with nothing (component: themselves); vectors of different lengths aren't
linked; copies link with each other; rows with a null id have their component's least id;
an empty table gives an empty result; other columns aren't carried over. Ids must be
numbers (they are cast to long).
"""

from __future__ import annotations

import hashlib
import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexivane.llm.common import bounded_batches, materialize, scratch, tidied
from lexivane.llm.neardup import connected

COSINE = 0.95
PROBES = 8
LOAD, MISS = 0.02, 1e-4
TRIALS = 2000
BLOCK = 1024
GROUP_ROWS = 4096
#: Groups of at most so many vectors are compared pair by pair, all of a task's together.
FEW, PAIRS = 48, 1 << 15
SEED = 6


@lru_cache(maxsize=64)
def shape_for(n: int, dims: int = 64, cosine: float = COSINE) -> tuple[int, int]:
    """Depth and number of tables for n vectors."""
    wide = max(2, 1 << (dims - 1).bit_length())
    depth = max(1, math.ceil(math.log(max(2.0, n * (PROBES + 1) / LOAD)) / math.log(2 * wide)))
    return depth, max(1, math.ceil(math.log(MISS) / math.log(max(1e-9, 1 - meeting(dims, depth, cosine)))))


def meeting(dims: int, depth: int, cosine: float) -> float:
    """The share of pairs of vectors of this cosine that meet in one table of this depth."""
    if dims < 2:
        return 1 - 1e-9
    rng = np.random.default_rng([SEED, dims, depth])
    x, y = rng.normal(size=(2, TRIALS, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y -= (x * y).sum(1)[:, None] * x
    y /= np.maximum(1e-300, np.linalg.norm(y, axis=1)[:, None])
    a, b = (codes(v, depth, 1) for v in (x, cosine * x + math.sqrt(max(0.0, 1 - cosine * cosine)) * y))
    met = (a[:, :, None] == b[:, None, :]).any(axis=(1, 2)).mean()
    return min(1 - 1e-9, max(0.01, float(met) - 0.01))


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each column, orthonormal; the height is a power of two."""
    d, n = x.shape
    h, scale = 1, np.asarray(1 / math.sqrt(d), x.dtype)
    while h < d:
        y, x = np.empty_like(x).reshape(d // (2 * h), 2, h, n), x.reshape(d // (2 * h), 2, h, n)
        np.add(x[:, 0], x[:, 1], out=y[:, 0])
        np.subtract(x[:, 0], x[:, 1], out=y[:, 1])
        x = y.reshape(d, n)
        h *= 2
    return x * scale


def codes(x: np.ndarray, depth: int, tables: int, probes: int = PROBES, seed: int = SEED) -> np.ndarray:
    """The buckets of each unit vector: n x (tables * (probes + 1)) 64-bit names, fewer for shallow tables of few dimensions."""
    n, dims = x.shape
    d = max(2, 1 << (dims - 1).bit_length())
    k = min(3, d)
    wide = np.zeros((d, n), np.float32)
    wide[:dims] = x.T
    rng = np.random.default_rng([seed, dims])
    rows = np.arange(n)[:, None]
    out = []
    for t in range(tables):
        best, loss = [], []
        for _ in range(depth):
            r = wide
            for _ in range(3):
                r = hadamard(r * rng.choice(np.array([-1, 1], np.float32), size=(d, 1)))
            r = np.ascontiguousarray(r.T)
            size = np.abs(r)
            top = np.argpartition(-size, k - 1, axis=1)[:, :k]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
            size = np.take_along_axis(size, top, 1)
            best.append(top.astype(np.uint64) + np.uint64(d) * (r[rows, top] < 0).astype(np.uint64))
            loss.append(size[:, :1] - size)
        choices = [{}]
        for a in range(depth):
            choices += [{a: q} for q in range(1, k)] + [{a: 1, b: 1} for b in range(a)]
        gaps, names = [], []
        for c in choices:
            gaps.append(sum((loss[a][:, q] for a, q in c.items()), np.zeros(n, np.float32)))
            name = np.full(n, t + 1, np.uint64)
            with np.errstate(over="ignore"):
                for a in range(depth):
                    name = (name * np.uint64(0x9E3779B97F4A7C15) + best[a][:, c.get(a, 0)] + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
                    name ^= name >> np.uint64(29)
                name ^= np.uint64(dims)
            names.append(name)
        gaps[0] -= 1
        order = np.argsort(np.column_stack(gaps), axis=1, kind="stable")[:, : probes + 1]
        out.append(np.take_along_axis(np.column_stack(names), order, 1))
    return np.concatenate(out, axis=1).view(np.int64) if out else np.zeros((n, 0), np.int64)


def packed(values: np.ndarray) -> bytes:
    """A vector's components, in 32 bits if that loses nothing."""
    with np.errstate(over="ignore"):
        slim = values.astype("<f4")
    return b"4" + slim.tobytes() if (slim == values).all() else b"8" + values.astype("<f8").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    """The unit vector of what was packed."""
    return _unit(np.frombuffer(data, "<f4" if data[:1] == b"4" else "<f8", offset=1).astype(np.float64))


def _unit(values: np.ndarray) -> np.ndarray | None:
    if not len(values) or not np.isfinite(values).all():
        return None
    top = np.abs(values).max()
    if not top:
        return None
    values = values / top
    return values / math.sqrt(float(values @ values))


def signatures(vectors: DataFrame, key_col: str, vector_col: str, depth: int, tables: int) -> DataFrame:
    """vec_id, node (null for vectors that link with nothing), packed (its components' bytes), buckets."""
    bounded_batches(vectors.sparkSession)
    slim = vectors.select(F.col(key_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches):
        for batch in batches:
            units, data = [], []
            for v in batch.column(1):
                values = v.values if v.is_valid else None
                unit = None if values is None or values.null_count else _unit(np.asarray(values))
                units.append(unit)
                data.append(None if unit is None else packed(np.asarray(values)))
            buckets: list = [None] * len(units)
            for size in {len(u) for u in units if u is not None}:
                at = [i for i, u in enumerate(units) if u is not None and len(u) == size]
                for i, c in zip(at, codes(np.array([units[i] for i in at]), depth, tables)):
                    buckets[i] = np.unique(c)
            nodes = [None if u is None else hashlib.blake2b(u.tobytes(), digest_size=16).digest() for u in units]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(data, pa.binary()), pa.array(buckets, pa.list_(pa.int64()))], names=["vec_id", "node", "packed", "buckets"])

    return slim.mapInArrow(tidied(run), "vec_id long, node binary, packed binary, buckets array<long>")


def _first_met(group: int, lists: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """True for pairs that share no group of a lesser name than this one."""
    lower = [x[x < group] for x in lists]
    everything = np.concatenate(lower)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lower])
    _, column, counts = np.unique(everything, return_inverse=True, return_counts=True)
    keep = counts > 1
    if not keep.any():
        return np.ones((len(left), len(right)), bool)
    place = np.cumsum(keep) - 1
    x = np.zeros((len(lists), int(keep.sum())), np.float32)
    some = keep[column]
    x[owner[some], place[column[some]]] = 1
    return (x[left] @ x[right].T) < 0.5


def forest(hit: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of a symmetric matrix of links, breadth first."""
    left, out = np.ones(len(hit), bool), []
    for root in range(len(hit)):
        if not left[root]:
            continue
        left[root], front = False, np.array([root])
        while len(front):
            reach = hit[front] & left
            new = np.flatnonzero(reach.any(axis=0))
            out += zip(front[reach[:, new].argmax(axis=0)].tolist(), new.tolist())
            left[new], front = False, new
    return out


class Found:
    """What comparisons found in a task: linked copies of each row, and forest edges as row pairs."""

    def __init__(self, units: list[np.ndarray], copies: np.ndarray, lists: list[np.ndarray], cosine: float):
        self.units, self.copies, self.lists, self.cosine = units, copies, lists, cosine
        self.sums, self.edges, self.sets = np.zeros(len(units), np.int64), [], {}

    def block(self, group: int, rows: np.ndarray, part: np.ndarray) -> None:
        """The rows of one pair of blocks of a group, by a matrix product. part: 0 and 1 for the sides, 2 for both."""
        dims = np.array([len(self.units[i]) for i in rows])
        for size in np.unique(dims):
            some = dims == size
            left, right = rows[some & (part != 1)], rows[some & (part != 0)]
            if not len(left) or not len(right):
                continue
            both = part[0] == 2
            x = np.array([self.units[i] for i in left])
            y = x if both else np.array([self.units[i] for i in right])
            hit = x @ y.T >= self.cosine
            if both:
                np.fill_diagonal(hit, False)
            if not hit.any():
                continue
            rows_hit, cols_hit = hit.any(1), hit.any(0)
            left, right, hit = left[rows_hit], right[cols_hit], hit[rows_hit][:, cols_hit]
            members, at = np.unique(np.concatenate([left, right]), return_inverse=True)
            hit &= _first_met(group, [self.lists[i] for i in members], at[: len(left)], at[len(left) :])
            self.sums[left] += hit @ self.copies[right]
            if not both:
                self.sums[right] += hit.T @ self.copies[left]
            if both:
                whole = hit
            else:
                whole = np.zeros((len(members), len(members)), bool)
                whole[np.ix_(at[: len(left)], at[len(left) :])] = hit
                whole |= whole.T
            self.edges += [(int(members[u]), int(members[v])) for u, v in forest(whole)]

    def _set(self, i: int) -> frozenset:
        if i not in self.sets:
            self.sets[i] = frozenset(self.lists[i].tolist())
        return self.sets[i]

    def few(self, groups: list[tuple[int, np.ndarray]]) -> None:
        """Groups of few rows each, pair by pair, PAIRS at a time."""
        held, size, above = [], 0, {}
        for group, rows in groups:
            if len(rows) not in above:
                above[len(rows)] = np.triu_indices(len(rows), 1)
            i, j = above[len(rows)]
            held.append((np.full(len(i), group), rows[i], rows[j]))
            size += len(i)
            if size >= PAIRS:
                self._pairs(held)
                held, size = [], 0
        self._pairs(held)

    def _pairs(self, held: list) -> None:
        if not held:
            return
        group, i, j = (np.concatenate(x) for x in zip(*held))
        dims = np.array([len(u) for u in self.units])
        alike = dims[i] == dims[j]
        for size in np.unique(dims[i[alike]]):
            at = np.flatnonzero(alike & (dims[i] == size))
            rows, place = np.unique(np.concatenate([i[at], j[at]]), return_inverse=True)
            x = np.array([self.units[r] for r in rows])
            near = np.einsum("ij,ij->i", x[place[: len(at)]], x[place[len(at) :]]) >= self.cosine
            for k in at[near]:
                a, b = int(i[k]), int(j[k])
                if min(self._set(a) & self._set(b)) == group[k]:
                    self.sums[a] += self.copies[b]
                    self.sums[b] += self.copies[a]
                    self.edges.append((a, b))


def compare(rows: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """node, links, other: sums and forest edges of the dealt rows (pivot, i, j, node, packed, copies, pivots, part) of some groups."""
    rows = rows.sort_values(["pivot", "i", "j"], kind="stable")
    names, known, units = rows["node"].to_numpy(), {}, []
    for node, data in zip(names, rows["packed"]):
        if node not in known:
            known[node] = unpacked(data)
        units.append(known[node])
    keys, part = rows[["pivot", "i", "j"]].to_numpy(), rows["part"].to_numpy()
    found = Found(units, rows["copies"].to_numpy(), [np.sort(np.asarray(x)) for x in rows["pivots"]], cosine)
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(rows) else np.zeros(0, int)
    small = []
    for a, b in zip(starts, [*starts[1:], len(rows)]):
        if part[a] == 2 and b - a <= FEW:
            small.append((keys[a][0], np.arange(a, b)))
        else:
            found.block(int(keys[a][0]), np.arange(a, b), part[a:b])
    found.few(small)
    out = [(names[i], int(found.sums[i]), None) for i in np.flatnonzero(found.sums)] + [(names[a], 0, names[b]) for a, b in found.edges]
    return pd.DataFrame(out, columns=["node", "links", "other"])


def components(vectors: DataFrame, key_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row of vectors."""
    with scratch(vectors.sparkSession) as keep:
        facts = vectors.agg(F.count("*").alias("n"), F.avg(F.when(F.size(vector_col) > 0, F.size(vector_col))).alias("dims")).head()
        depth, tables = shape_for(1 << max(0, facts.n - 1).bit_length(), max(1, round(facts.dims or 1)), cosine)
        signed = keep(materialize(signatures(vectors, key_col, vector_col, depth, tables), "signed"))
        some = signed.filter("node is not null")
        nodes = materialize(some.groupBy("node").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"), F.max("packed").alias("packed"), F.max("buckets").alias("buckets")), "nodes")
        # A bucket is known by its pivot from here on, and buckets of one pivot are one group.
        spread = nodes.select("node", F.xxhash64("node").alias("name"), F.explode("buckets").alias("bucket"))
        pivots = spread.groupBy("bucket").agg(F.min("name").alias("pivot"), F.count("*").alias("m")).filter("m > 1").select("bucket", "pivot")
        met = materialize(spread.select("node", "bucket").join(pivots, "bucket").select("node", "pivot").distinct(), "met")
        used = met.groupBy("pivot").agg(F.count("*").alias("m")).filter("m > 1").select("pivot", "m", F.ceil(F.col("m") / BLOCK).cast("int").alias("k"))
        used = materialize(used, "groups")
        total = used.agg(F.sum(F.col("m") * F.col("k"))).head()[0] or 0
        shares = max(1, int(total) // GROUP_ROWS)
        lists = met.join(used, "pivot").groupBy("node").agg(F.collect_list(F.struct("pivot", "k")).alias("groups"))
        dealt = nodes.select("node", "copies", "packed").join(lists, "node").withColumn("pivots", F.transform("groups", lambda x: x["pivot"])).withColumn("group", F.explode("groups"))
        dealt = dealt.select("node", "copies", "packed", "pivots", F.col("group.pivot").alias("pivot"), F.col("group.k").alias("k"))
        block = F.pmod(F.xxhash64("node", "pivot"), F.col("k")).cast("int")
        dealt = dealt.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
        dealt = dealt.select("pivot", "node", "copies", "packed", "pivots", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("part"))
        dealt = dealt.withColumn("g", F.pmod(F.xxhash64("pivot", "i", "j"), F.lit(shares)))

        def verify(pdf: pd.DataFrame) -> pd.DataFrame:
            return compare(pdf, cosine)

        found = materialize(dealt.groupBy("g").applyInPandas(verify, "node binary, links long, other binary"), "found")
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        edges = found.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b"))
        placed = nodes.select("node", "least", "copies")
        labels = connected(edges).join(placed.select("node", "least"), "node")
        roots = labels.groupBy("label").agg(F.min("least").alias("component_id"))
        known = labels.select("node", "label").join(roots, "label").select("node", "component_id")
        facts = placed.join(links, "node", "left").join(known, "node", "left").select("node", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component_id", "least").alias("component_id"))
        facts = keep(materialize(facts, "facts"))
    out = signed.select("vec_id", "node").join(facts, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))

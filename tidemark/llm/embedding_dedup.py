"""Embedding near-de-duplication by collision counting on one-dimensional projections.

Each unit vector is projected on many random directions. For a query vector, the
others within half a window of its projection collide with it in that
projection; pairs colliding in enough projections are candidates, and their
cosine in double precision decides. The window and the count needed are
calibrated: the difference of two projections of a pair at the threshold is
normal with a known spread, so collisions are binomial, and the count is the
largest one that such a pair reaches with the recall asked for.

The first two projections also place the work: sorted and cut into cells one
window wide, so that colliding pairs share a cell or lie in adjacent ones. Each
cell meets its forward neighbours once; a cell with many rows is split into
chunks that meet pairwise. Tasks return sums of links and a spanning forest,
never pairs. Equal vectors are collapsed to one weighted row before all this.

The number of colliding pairs grows with the square of the rows (each
projection halves, not divides by n): that is the cost of the method.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from .common import materialise, ship
from .components import connected_components

SEED = 20_817
#: Half-width of a counting window, in standard deviations of a threshold pair's difference.
WIDTH = 2.2

#: Projections are compared as bytes, in levels so wide (in standard deviations) and modulo 256 of them.
LEVEL = 0.02


def directions(dim: int, count: int) -> np.ndarray:
    """dim x count Gaussian directions, the same wherever they are made."""
    return np.random.Generator(np.random.PCG64([SEED, dim])).standard_normal((dim, count))


def calibrate(threshold: float, projections: int, recall: float) -> tuple[float, float, int]:
    """Window half-widths of the placing and the counting projections, and the
    collisions needed, so that a pair exactly at the threshold is found with
    probability ``recall`` (closer pairs with a higher one)."""
    spread = math.sqrt(max(2 - 2 * threshold, 1e-12))
    miss = (1 - recall) / 2
    z = 1.0
    while 2 * math.erfc(z / math.sqrt(2)) > miss:  # two placing projections
        z += 0.01
    half = WIDTH * spread
    p = math.erf(WIDTH / math.sqrt(2))
    need, tail = projections, 0.0
    while need > 0:
        tail += math.comb(projections, need) * p**need * (1 - p) ** (projections - need)
        if tail >= 1 - miss:
            break
        need -= 1
    return z * spread, half, need


def _unit(block: np.ndarray) -> np.ndarray:
    block = block / np.abs(block).max(axis=1, keepdims=True)  # else squares may leave the doubles' range
    return block / np.linalg.norm(block, axis=1, keepdims=True)


def _matrix(col: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = col.combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


PLACED = "node long, size long, dim int, c0 long, c1 long"


def _place(width: float):
    def run(batches):
        for b in batches:
            lists = b.column(2)
            dims = np.array([len(x) for x in lists], np.int64)
            cells = np.zeros((len(dims), 2), np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = _unit(np.array(lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False),
                                   np.float64).reshape(len(at), dim))
                cells[at] = np.floor(x @ directions(dim, 2) / width).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), lists, pa.array(dims, pa.int32()), pa.array(cells[:, 0]), pa.array(cells[:, 1])],
                ["node", "size", "vec", "dim", "c0", "c1"])
    return run


def _labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable over the links a-b, by hooking and jumping."""
    low = np.arange(n)
    while True:
        m = np.minimum(low[a], low[b])
        new = low.copy()
        np.minimum.at(new, low[a], m)
        np.minimum.at(new, low[b], m)
        while (new[new] != new).any():
            new = new[new]
        new = new[new]
        if (new == low).all():
            return low
        low = new


LINKS = "node long, links long, root long"


def levels(proj: np.ndarray) -> np.ndarray:
    """Projections as one byte each; those 256 levels apart are alike, which only adds candidates."""
    return np.floor(proj / LEVEL).astype(np.int64).astype(np.uint8)


def window(half: float) -> int:
    """The most levels between two projections that are ``half`` apart; what is nearer is never further in levels.
    From 128 on all bytes are within it."""
    return min(int((half + 1e-5) / LEVEL) + 1, 128)


def collide(p: np.ndarray, r: np.ndarray, w: int, gap: np.ndarray, flag: np.ndarray) -> np.ndarray:
    """Whether each of ``p`` is within ``w`` levels of each of ``r``: differences from -w to w are
    told by one comparison, modulo 256."""
    np.subtract((p + np.uint8(w))[:, None], r[None, :], out=gap)
    return np.less_equal(gap, np.uint8(min(2 * w, 255)), out=flag)


def _meet(threshold: float, projections: int, place: float, half: float, need: int, step: int = 128):
    def run(key, t):
        n = t.num_rows
        order = np.argsort(t["node"].to_numpy(), kind="stable")
        node, size = t["node"].to_numpy()[order], t["size"].to_numpy()[order]
        member, chunk = t["member"].to_numpy(zero_copy_only=False)[order], t["chunk"].to_numpy()[order]
        x = _unit(_matrix(t["vec"], n))[order]
        proj = np.ascontiguousarray(levels(x @ directions(x.shape[1], 2 + projections)).T)
        single = x.astype(np.float32)
        i, j = key[3].as_py(), key[4].as_py()
        links = np.zeros(n, np.int64)
        found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left, right = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
        sides = [(p[left], p[right], window(place if k < 2 else half)) for k, p in enumerate(proj)]
        for s in range(0, len(left), step):
            q = left[s:s + step]
            gap, flag = np.empty((len(q), len(right)), np.uint8), np.empty((len(q), len(right)), bool)
            near = member[q][:, None] | member[right][None, :]
            if i == j:
                near &= q[:, None] < right[None, :]
            count = np.zeros(near.shape, np.uint8)
            for k, (p, r, w) in enumerate(sides):
                collide(p[s:s + step], r, w, gap, flag)
                if k < 2:
                    near &= flag
                else:
                    np.add(count, flag.view(np.uint8), out=count)
            a, b = np.divmod(np.flatnonzero(near & (count >= need)), len(right))
            a, b = q[a], right[b]
            for at in range(0, len(a), 1 << 11):
                p, r = a[at:at + (1 << 11)], b[at:at + (1 << 11)]
                close = np.einsum("ij,ij->i", single[p], single[r]) >= threshold - 1e-3  # spares most the doubles
                p, r = p[close], r[close]
                ok = np.einsum("ij,ij->i", x[p], x[r]) >= threshold
                found_a.append(p[ok])
                found_b.append(r[ok])
        a, b = np.concatenate(found_a), np.concatenate(found_b)
        np.add.at(links, a, size[b])
        np.add.at(links, b, size[a])
        low, at = _labels(a, b, n), np.flatnonzero(links)
        return pa.table({"node": node[at], "links": links[at], "root": node[low[at]]})
    return run


def embedding_dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                    threshold: float = 0.95, projections: int = 16, recall: float = 0.9999,
                    per_chunk: int = 6000) -> DataFrame:
    """(id, n_links, component_id, kept) per vector: direct links to other rows at
    cosine >= ``threshold``, smallest id reachable, and whether it is that id.

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing, as do rows with a null id (no component, not kept) and
    vectors of different length. Repeated rows link with each other.
    """
    ship(vectors.sparkSession)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast(ArrayType(DoubleType())).alias("vec"))
    v = v.withColumn("vec", F.expr(
        "CASE WHEN id IS NOT NULL AND size(vec) > 0 AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
        " AND exists(vec, x -> x <> 0) THEN vec END"))
    place, half, need = calibrate(threshold, projections, recall)
    reps = v.where("vec is not null").groupBy("vec").agg(F.min("id").alias("node"), F.count("*").alias("size"))
    placed = materialise(reps.select("node", "size", "vec").mapInArrow(
        _place(place), "node long, size long, vec array<double>, dim int, c0 long, c1 long"), "embedding-cells")
    # A unit is a cell with its members; rows of the four cells behind it visit.
    moves = [(0, 0), (1, 0), (0, 1), (1, 1), (1, -1)]
    units = placed.withColumn("m", F.explode(F.array(*[
        F.struct((F.col("c0") + a).alias("u0"), (F.col("c1") + b).alias("u1"), F.lit((a, b) == (0, 0)).alias("member"))
        for a, b in moves]))).select("dim", "m.u0", "m.u1", "m.member", "node", "size", "vec")
    # The number of cells is bounded by the grid (a projection's range over the window), not by the rows.
    chunks = units.groupBy("dim", "u0", "u1").agg(F.count("*").alias("rows"), F.max("member").alias("has"))
    chunks = chunks.where("has").select("dim", "u0", "u1", F.ceil(F.col("rows") / per_chunk).cast("long").alias("s"))
    met = (units.join(F.broadcast(chunks), ["dim", "u0", "u1"])
           .withColumn("chunk", F.pmod(F.xxhash64("node"), "s"))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("s") - 1)))
           .withColumns({"i": F.least("chunk", "other"), "j": F.greatest("chunk", "other")}))
    found = materialise(met.select("dim", "u0", "u1", "i", "j", "member", "chunk", "node", "size", "vec")
                        .groupBy("dim", "u0", "u1", "i", "j")
                        .applyInArrow(_meet(threshold, projections, place, half, need), LINKS), "embedding-links")
    comp = connected_components(found, "node", "root").withColumnRenamed("component", "component_id")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = (placed.select("vec", "node", "size").join(links, "node", "left").join(comp, "node", "left")
             .select(F.col("vec"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                     F.coalesce("component_id", "node").alias("component_id")))
    return v.join(named, "vec", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component_id", "id"), F.lit(False)).alias("kept"))

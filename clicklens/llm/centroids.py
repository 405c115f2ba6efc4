"""Centroid clustering by Walsh-Hadamard progressive search, in exact integers.

A vector of ``size`` components (a power of two) becomes the integers floor(``scale`` * x). The Walsh-Hadamard
transform H, with rows ordered from coarse to fine (by their sign changes), keeps distances up to a factor:
size * |v - c|^2 = |Hv - Hc|^2, exactly, in integers. For a block of vectors the squared differences of the
first coefficients are summed against every centroid; the best of them is finished for an upper bound, and a
centroid whose partial sum is already larger is strictly worse and goes. The others take the next
coefficients, and those left at the end are finished to the last one, so ties are seen and go to the smaller
number.

A round is one scan: each task sums its vectors by centroid, the sums meet in a grouped aggregate of at most
``k`` rows a task, and the driver divides ``k`` rows of sums (the only thing it collects).

Defined cases: a vector that is null, of another size, or has a null, NaN or infinite component is left out;
the first centroids are the ``k`` vectors with the smallest sha256 of ``1:<id>``, equal hashes (repeated ids)
in the order of their components, null ids after all others; with fewer than ``k`` vectors there are so many
centroids; an empty table gives an empty result; rows that repeat are clustered each. An integer component
beyond +-2^24 raises ``ValueError``: sums of squares would leave 64 bits. Only id and vector are read, so
other columns' names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import quoted
from clicklens.llm.lineage import cut

LARGEST = 1 << 24
STAGES = (4, 16)    # coefficients after which worse centroids go
_ROWS = 4_096       # vectors of a block


def sequency_order(size: int) -> np.ndarray:
    """Rows of the natural Hadamard matrix from the fewest sign changes to the most."""
    changes = [0] * size
    for r in range(size):
        signs = [(r & c).bit_count() & 1 for c in range(size)]
        changes[r] = sum(a != b for a, b in zip(signs, signs[1:]))
    return np.argsort(changes, kind="stable")


def transform(v: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row of integers, coefficients from coarse to fine."""
    out, half = v.copy(), 1
    size = v.shape[1]
    while half < size:
        pairs = out.reshape(len(out), size // (2 * half), 2, half)
        low, high = pairs[:, :, 0, :].copy(), pairs[:, :, 1, :].copy()
        pairs[:, :, 0, :], pairs[:, :, 1, :] = low + high, low - high
        half *= 2
    return out[:, sequency_order(size)]


def nearest(v: np.ndarray, spectra: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance) of each row of ``v``; ``spectra``: the transformed centroids."""
    t, size = transform(v), v.shape[1]
    stages = [0, *[s for s in STAGES if s < size], size]
    diff = t[:, None, :stages[1]] - spectra[None, :, :stages[1]]
    partial = np.einsum("nkc,nkc->nk", diff, diff)
    best = partial.argmin(axis=1)
    diff = t - spectra[best]
    bound = np.einsum("nc,nc->n", diff, diff)
    alive = partial <= bound[:, None]
    for a, z in zip(stages[1:], stages[2:]):
        row, k = np.nonzero(alive)
        diff = t[row, a:z] - spectra[k, a:z]
        partial[row, k] += np.einsum("pc,pc->p", diff, diff)
        alive &= partial <= bound[:, None]
    partial[~alive] = np.iinfo(np.int64).max
    cluster = partial.argmin(axis=1)    # the first of equals
    return cluster, partial[np.arange(len(v)), cluster] // size


def _integers(col, scale: int, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first row, integer vectors) of an Arrow list column without nulls, a block at a time."""
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)
    for a in range(0, len(x), _ROWS):
        v = np.floor(x[a:a + _ROWS] * scale)
        if np.abs(v).max() > LARGEST:
            raise ValueError(f"a component times {scale} lies beyond +-{LARGEST}")
        yield a, v.astype(np.int64)


def _sums(rows: DataFrame, spectra: np.ndarray, scale: int) -> dict[int, list[int]]:
    """For each centroid with vectors: the sums of their components, then their number."""
    size = spectra.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(spectra), size + 1), dtype=np.int64)
        for b in batches:
            for _, v in _integers(b.column(0), scale, size):
                cluster, _ = nearest(v, spectra)
                np.add.at(total, cluster, np.pad(v, ((0, 0), (0, 1)), constant_values=1))
        used = np.flatnonzero(total[:, -1])
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *[pa.array(c) for c in total[used].T]],
                                         names=["k", *[f"s{i}" for i in range(size + 1)]])

    fields = [f"s{i}" for i in range(size + 1)]
    parts = rows.select("v").mapInArrow(run, ", ".join(["k int", *[f"{f} long" for f in fields]]))
    # sums over all tasks may pass 64 bits
    summed = parts.groupBy("k").agg(*[F.sum(F.col(f).cast("decimal(38,0)")).alias(f) for f in fields])
    return {r[0]: [int(x) for x in r[1:]] for r in summed.collect()}


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, size: int = 64, id_col: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid: its integers) for every vector of ``size`` finite numbers."""
    if size & (size - 1) or size < 2:
        raise ValueError("size must be a power of two")
    v = F.col(quoted(vector)).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(quoted(id_col)).alias("id"), v.alias("v")).where((F.size("v") == size) & finite)
    digest = F.sha2(F.concat(F.lit("1:"), F.col("id").cast("string")), 256)
    integers = F.transform("v", lambda x: F.floor(x * scale))
    first = rows.orderBy(digest.asc_nulls_last(), integers).limit(k).select(integers).collect()
    kind = rows.schema["id"].dataType.simpleString()
    if not first:
        return rows.limit(0).selectExpr("id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia",
                                        "cast(array() as array<bigint>) as centroid")
    if any(abs(x) > LARGEST for r in first for x in r[0]):
        raise ValueError(f"a component times {scale} lies beyond +-{LARGEST}")
    centers = [list(r[0]) for r in first]
    for _ in range(rounds):
        for n, s in _sums(rows, transform(np.array(centers, dtype=np.int64)), scale).items():
            centers[n] = [x // s[-1] for x in s[:-1]]
    spectra = transform(np.array(centers, dtype=np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, ints in _integers(b.column(1), scale, size):
                number, distance = nearest(ints, spectra)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(a, len(ints)), pa.array(number.astype(np.int32)), pa.array(distance)],
                    names=["id", "cluster", "distance"])

    # read twice, for the sums and for the rows: cut so that it is computed once (three numbers a vector)
    found = cut(rows.mapInArrow(run, f"id {kind}, cluster int, distance long"))
    inertia = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())    # k rows at most
    known = vectors.sparkSession.createDataFrame([(n, d, sum(inertia.values()), centers[n]) for n, d in inertia.items()],
                                                 "cluster int, cluster_inertia long, inertia long, centroid array<bigint>")
    return found.join(F.broadcast(known), "cluster").select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")

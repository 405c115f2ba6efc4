"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

1. ``statistics``: one pass over the whole texts gives ``len(STATISTICS)`` numbers a document (shares of kinds of
   characters, word lengths, repeated words, runs and lines, sizes); nothing else of a document is read.
2. The numbers are centred and scaled by the labelled rows' means and deviations, cut at +-6, and mapped to
   ``features`` cosines whose inner products approximate a Gaussian kernel of width ``width`` (times the root of the
   number of statistics).
3. Ridge regression: every task sums the products of its labelled rows' features (the normal equations) by fold;
   the sums meet row by row of the matrix in grouped tasks. Features are rounded to 1/2^15, so the sums are integers
   and do not depend on how rows were dealt. The driver gets one matrix a fold and solves it.
4. Isotonic calibration: each labelled row is scored by the weights of the other folds (the total less its own
   fold's sums), counted by score in ``bins`` bins, and pool-adjacent-violators makes the share of label 1 rise
   with the score. Between the pooled levels the share is interpolated, so that equal shares do not hide an order.

All labelled rows take part; no sample is drawn. Driver: (``features`` + 1)^2 numbers a fold, ``bins`` counts.

Defined cases: a null or empty text has statistics 0 and is scored like any other; labels of unknown ids and null
labels are ignored; an id that is repeated in labels has label 0 if any of its rows has; with one class only, every
score is that class's; without labels, 0.5. Empty tables give empty results. ``statistics`` reads only id and text,
so other columns do not matter; rows that repeat an id are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import quoted
from clicklens.llm.words import NOT_BLANK, Words, window_hashes, word_blocks

STATISTICS = ("log_bytes", "log_words", "word_bytes", "word_deviation", "blank", "upper", "lower", "digit", "mark", "sign",
              "beyond_ascii", "bang", "bar", "stop", "log_lines", "line_words", "repeated_lines", "repeated_words", "repeated_pairs",
              "repeated_runs", "capital_words", "one_letter", "long_words", "sign_words")
SCALE = 1 << 15     # features are multiples of 1 / SCALE: products of 2^22 rows stay whole in a double
_GRID = 1 << 10     # statistics are rounded to 1 / _GRID for their means


def _kind(chars: bytes) -> np.ndarray:
    t = np.zeros(256, dtype=bool)
    t[list(chars)] = True
    return t


_KINDS = {"blank": _kind(bytes([0x20, *range(9, 14)])), "upper": _kind(bytes(range(65, 91))), "lower": _kind(bytes(range(97, 123))),
          "digit": _kind(bytes(range(48, 58))), "mark": _kind(b".,;:!?'\"()-"), "sign": _kind(b"#*$%&|<>@^_~=+/\\{}[]`"),
          "beyond_ascii": _kind(bytes(range(128, 256))), "bang": _kind(b"!"), "bar": _kind(b"|"), "stop": _kind(b".")}


def _repeated(row: np.ndarray, h: np.ndarray, rows: int) -> np.ndarray:
    """Share of each row's entries that stand earlier in the same row."""
    order = np.lexsort((h, row))
    r, v = row[order], h[order]
    again = np.zeros(len(r), dtype=bool)
    again[1:] = (r[1:] == r[:-1]) & (v[1:] == v[:-1])
    return np.bincount(r, weights=again, minlength=rows) / np.maximum(1, np.bincount(row, minlength=rows))


def _block_statistics(w: Words) -> np.ndarray:
    """(rows, statistics) of a block of whole texts."""
    n = w.rows
    size = np.diff(w.offsets)
    one = np.maximum(1, size)
    of_byte = np.repeat(np.arange(n), size)
    share = {k: np.bincount(of_byte, weights=t[w.buf], minlength=n) / one for k, t in _KINDS.items()}
    words = np.maximum(1, w.counts())
    length = (w.ends - w.starts).astype(np.float64)
    mean = np.bincount(w.row, weights=length, minlength=n) / words
    spread = np.sqrt(np.maximum(0, np.bincount(w.row, weights=length ** 2, minlength=n) / words - mean ** 2))

    def of_words(what) -> np.ndarray:
        return np.bincount(w.row, weights=what, minlength=n) / words
    h = w.hashes()
    again = {"repeated_words": _repeated(w.row, h, n)}
    for name, k in (("repeated_pairs", 2), ("repeated_runs", 5)):
        m = max(0, len(h) - k + 1)
        same = np.flatnonzero(w.row[:m] == w.row[len(h) - m:])    # within one text
        again[name] = _repeated(w.row[same], window_hashes(h, k)[same], n)
    # lines: words that begin after a line break start a line
    breaks = np.concatenate(([0], np.cumsum(w.buf == 10)))
    line = breaks[w.starts]
    starts = np.ones(len(line), dtype=bool)
    starts[1:] = (line[1:] != line[:-1]) | (w.row[1:] != w.row[:-1])
    first = np.flatnonzero(starts)
    with np.errstate(over="ignore"):
        place = (np.arange(len(line)) - np.repeat(first, np.diff(np.append(first, len(line)))) + 1).astype(np.uint64)
        line_hash = np.add.reduceat(h * (place * np.uint64(2) + np.uint64(1)), first) if len(first) else np.empty(0, dtype=np.uint64)
    lines = np.bincount(w.row[first], minlength=n)
    head = w.buf[w.starts] if len(w.starts) else np.empty(0, dtype=np.uint8)
    tail = w.buf[w.ends - 1] if len(w.ends) else np.empty(0, dtype=np.uint8)
    columns = {"log_bytes": np.log1p(size), "log_words": np.log1p(w.counts()), "word_bytes": np.minimum(mean, 40), "word_deviation": np.minimum(spread, 40),
               **share, "log_lines": np.log1p(lines), "line_words": np.log1p(w.counts() / np.maximum(1, lines)),
               "repeated_lines": _repeated(w.row[first], line_hash, n), **again,
               "capital_words": of_words(_KINDS["upper"][head]), "one_letter": of_words(length == 1), "long_words": of_words(length >= 16),
               "sign_words": of_words(_KINDS["sign"][tail])}
    return np.column_stack([columns[k] for k in STATISTICS])


def statistics(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, stats: array of ``len(STATISTICS)`` floats) of every row of ``docs``."""
    src = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text)).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in word_blocks(b.column(1), NOT_BLANK):
                x = _block_statistics(w).astype(np.float32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(w.first, w.rows), lists], names=["id", "stats"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, stats array<float>")


@dataclass
class Model:
    """Means, deviations and frequencies of the features; weights; and the calibration's corner points."""
    mean: np.ndarray
    deviation: np.ndarray
    frequency: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    share: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Whole numbers: the cosines in units of 1 / SCALE, then SCALE itself for the constant."""
        z = np.clip((x - self.mean) / self.deviation, -6, 6)
        out = np.empty((len(x), len(self.phase) + 1))
        np.rint(np.cos(z @ self.frequency + self.phase) * SCALE, out=out[:, :-1])
        out[:, -1] = SCALE
        return out

    def raw(self, x: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return self.features(x) @ (self.weights if weights is None else weights) / SCALE

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.at, self.share), 0.0, 1.0)


def _matrix(col) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)


def _blocks(b: pa.RecordBatch, rows: int = 2_048) -> Iterator[pa.RecordBatch]:
    for a in range(0, b.num_rows, rows):
        yield b.slice(a, rows)


def _normal_equations(rows: DataFrame, model: Model, folds: int) -> np.ndarray:
    """(folds, D, D + 1): sums of feature products, and of feature times label, over the rows of each fold."""
    d = len(model.phase) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((folds, d, d + 1), dtype=np.int64)
        seen = np.zeros(folds, dtype=bool)
        for b in batches:
            for part in _blocks(b):
                phi, y, fold = model.features(_matrix(part.column(0))), part.column(1).to_numpy().astype(np.float64), part.column(2).to_numpy()
                for k in np.unique(fold):
                    mine = phi[fold == k]
                    seen[k] = True
                    # whole numbers below 2^53: exact in doubles, then added as 64-bit integers
                    total[k] += np.hstack([mine.T @ mine, (mine.T @ y[fold == k])[:, None] * SCALE]).astype(np.int64)
        for k in np.flatnonzero(seen):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, k, dtype=np.int32)), pa.array(np.arange(d, dtype=np.int32)),
                                              pa.array([total[k, i].tobytes() for i in range(d)], pa.binary())], names=["fold", "i", "row"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(d + 1, dtype=np.int64)
        for x in table.column("row"):
            total += np.frombuffer(x.as_py(), dtype=np.int64)
        return pa.table({"fold": table.column("fold")[:1], "i": table.column("i")[:1], "row": pa.array([total.tobytes()], pa.binary())})

    parts = rows.select("stats", "y", "fold").mapInArrow(sums, "fold int, i int, row binary")
    out = np.zeros((folds, d, d + 1))
    for r in parts.groupBy("fold", "i").applyInArrow(add, "fold int, i int, row binary").collect():
        out[r.fold, r.i] = np.frombuffer(bytes(r.row), dtype=np.int64)
    return out / SCALE ** 2


def _solve(sums: np.ndarray, ridge: float) -> np.ndarray:
    d = sums.shape[0]
    rows = max(1.0, sums[-1, -2])    # the constant's square, summed: the number of rows
    penalty = np.full(d, ridge * rows)
    penalty[-1] = 1e-9 * rows
    return np.linalg.solve(sums[:, :-1] + np.diag(penalty), sums[:, -1])


def pool_adjacent_violators(ones: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rising sequence of shares nearest to ones / counts (weights: counts)."""
    level: list[list[float]] = []     # ones, counts, bins
    for a, b in zip(ones.tolist(), counts.tolist()):
        level.append([a, b, 1])
        while len(level) > 1 and level[-2][0] * level[-1][1] >= level[-1][0] * level[-2][1]:
            top = level.pop()
            level[-1] = [x + y for x, y in zip(level[-1], top)]
    return np.repeat([a / b for a, b, _ in level], [k for _, _, k in level])


def _calibration(at: np.ndarray, ones: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Corner points of a strictly rising curve: each pooled level at its middle, then both ends of the scale."""
    share = pool_adjacent_violators(ones, counts)
    cut = np.flatnonzero(np.diff(share) != 0) + 1
    pooled = [(np.average(a, weights=n), s[0]) for a, n, s in zip(np.split(at, cut), np.split(counts, cut), np.split(share, cut))]
    x, y = np.array([p[0] for p in pooled]), np.array([p[1] for p in pooled])
    low, high = min(x[0], -1.0) - 1, max(x[-1], 2.0) + 1
    return np.concatenate(([low], x, [high])), np.concatenate(([y[0] / 2], y, [(1 + y[-1]) / 2]))


def fit(stats: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", label: str = "quality", features: int = 256,
        width: float = 1.0, ridge: float = 1e-5, folds: int = 5, bins: int = 2_000, seed: int = 12) -> Model:
    """Train on the labels that ``train_rows`` (a condition on the label table's id) admits. ``stats`` is read four times."""
    marked = (labels.select(F.col(quoted(id_col)).alias(id_col), F.col(quoted(label)).cast("int").alias("y"))
              .where(F.col(quoted(id_col)).isNotNull() & F.col("y").isNotNull()).where(train_rows)
              .groupBy(F.col(quoted(id_col)).alias("id")).agg(F.min("y").alias("y")))
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(folds)).cast("int").alias("fold")
    rows = stats.join(marked, "id").select("stats", "y", fold)
    m = len(STATISTICS)
    grid = [F.round(F.get("stats", F.lit(i)).cast("double") * _GRID).cast("long").cast("decimal(38,0)") for i in range(m)]
    moments = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0)), *[F.sum(g) for g in grid], *[F.sum(g * g) for g in grid]).first()
    n, ones = moments[0], moments[1]
    rng = np.random.default_rng(seed)
    frequency, phase = rng.normal(size=(m, features)) / (width * np.sqrt(m)), rng.uniform(0, 2 * np.pi, features)
    if n == 0 or ones in (0, n):    # nothing to tell apart
        flat = np.full(2, 0.5 if n == 0 else ones / n)
        return Model(np.zeros(m), np.ones(m), frequency, phase, np.zeros(features + 1), np.array([0.0, 1.0]), flat)
    mean = np.array([float(x) for x in moments[2:2 + m]]) / n / _GRID
    square = np.array([float(x) for x in moments[2 + m:]]) / n / _GRID ** 2
    model = Model(mean, np.maximum(1e-3, np.sqrt(np.maximum(0, square - mean ** 2))), frequency, phase, np.zeros(features + 1), np.zeros(1), np.zeros(1))
    sums = _normal_equations(rows, model, folds)
    total = sums.sum(axis=0)
    apart = np.array([_solve(total - s, ridge) for s in sums])
    model.weights = _solve(total, ridge)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in _blocks(b):
                fold, phi = part.column(2).to_numpy(), model.features(_matrix(part.column(0)))
                s = np.einsum("nd,nd->n", phi, apart[fold]) / SCALE
                bin_ = np.clip(np.floor((s + 0.5) / 2 * bins), 0, bins - 1).astype(np.int32)    # scores of -0.5 to 1.5
                yield pa.RecordBatch.from_arrays([pa.array(bin_), part.column(1)], names=["bin", "y"])

    counted = (rows.select("stats", "y", "fold").mapInArrow(score, "bin int, y int").groupBy("bin")
               .agg(F.sum("y").alias("ones"), F.count(F.lit(1)).alias("n")).orderBy("bin").collect())
    at = (np.array([r.bin for r in counted]) + 0.5) * 2 / bins - 0.5
    model.at, model.share = _calibration(at, np.array([r.ones for r in counted]), np.array([r.n for r in counted]))
    return model


def score(stats: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(id, score: 0 to 1, predicted: 1 from ``threshold``) of every row of ``stats``."""
    shared = stats.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(**shared.value)
        for b in batches:
            for part in _blocks(b):
                s = own.scores(_matrix(part.column(1)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 names=["id", "score", "predicted"])
    return stats.select("id", "stats").mapInArrow(run, f"id {stats.schema['id'].dataType.simpleString()}, score double, predicted int")

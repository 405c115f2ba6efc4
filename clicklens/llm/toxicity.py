"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic examples and unlabelled texts train linear numpy classifiers with the class-prior-corrected
risk  prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)),  logistic loss; when the bracket falls below zero the
step goes up its gradient instead (the non-negative correction). Rows marked not toxic are not used as
negatives: they are unlabelled texts like any other, and only tell the class prior.

Features of a text are the presence of its lower-cased words and of their first 4, 5 and 6 bytes, hashed into
2^22 bins, so that the memory of a task does not depend on the vocabulary and no feature is left out beforehand. A
classifier keeps the bins that are clearly more, or clearly less, frequent among its positives than among its
unlabelled texts (z of ``z_least`` either way), ``max_features`` at most: a word can speak for a text, too.

Unlabelled texts: a share of all documents (``unlabelled_share``, by hash of the id), or ``max_unlabelled`` of them
where that is more, so the sample grows with the input. Confirmed examples: about ``max_positive`` (a bound on labelled
rows). Both are dealt to bags of about ``bag`` unlabelled texts and ``bag_positive`` confirmed ones, an example to
several bags if need be; a bag trains one classifier in one task, and Spark adds the bags' weights by bin. What the
driver collects and broadcasts is one weight a bin. Scoring reads every text whole. A sample that lacks a class which
the tables hold is an error (``ValueError``), not a model.

Defined cases: a null or empty text has no feature and gets the classifiers' bias; labels of unknown ids and
null labels are ignored; an id that is repeated in labels counts as toxic if any of its rows is; without a
confirmed example every score is 0; empty tables give empty results; extra columns are carried, but for the
result's own names (``score``, ``predicted``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clicklens.llm.columns import Own, quoted
from clicklens.llm.lineage import chosen
from clicklens.llm.words import ALNUM, Words, word_blocks, word_hashes

HEADS = (4, 5, 6)
SPACE = 1 << 22     # bins of the hashed feature space
UNIT = 1 << 32      # weights are summed in whole units of 1 / UNIT


def _bins(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(SPACE - 1)).astype(np.int64)


def _features(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, hash) of the words of a block and of their heads, kind after kind."""
    size = w.ends - w.starts
    yield w.row, w.hashes()
    for n in HEADS:
        long = np.flatnonzero(size >= n)
        # the kind is part of the hash: a word is not its own head
        yield w.row[long], word_hashes(w.buf, w.starts[long], w.starts[long] + n) ^ np.uint64(0x51ED27A3C0FFEE00 + n)


@dataclass
class Weights:
    """Averaged classifiers: the bins of features, their weights, and the bias."""
    bins: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts) -> np.ndarray:
        """Score in 0..1 of each text of an Arrow column."""
        known = np.zeros(SPACE, dtype=bool)
        known[self.bins] = True
        out = []
        for w in word_blocks(texts, ALNUM, lower=True):
            total = np.full(w.rows, self.bias)
            found = [np.empty(0, dtype=np.int64)]
            for row, h in _features(w):
                at = _bins(h)
                hit = np.flatnonzero(known[at])
                found.append(row[hit].astype(np.int64) * SPACE + at[hit])
            pairs = np.unique(np.concatenate(found))
            if len(pairs):
                np.add.at(total, pairs // SPACE, self.weights[np.searchsorted(self.bins, pairs % SPACE)])
            out.append(1.0 / (1.0 + np.exp(-np.clip(total, -60, 60))))
        return np.concatenate(out) if out else np.empty(0)


def nnpu_gradient(theta: np.ndarray, rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, prior: float) -> np.ndarray:
    """Direction of the non-negative risk at ``theta`` (weights, then the bias) on binary features (``rows``, ``cols``)."""
    n_pos = max(1, int(positive.sum()))
    n_unl = max(1, len(positive) - int(positive.sum()))
    z = np.bincount(rows, weights=theta[cols], minlength=len(positive)) + theta[-1]
    s = 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))
    loss_neg = np.logaddexp(0, z)
    bracket = loss_neg[~positive].sum() / n_unl - prior * loss_neg[positive].sum() / n_pos
    # d loss(+)/dz = s - 1, d loss(-)/dz = s
    up = np.where(positive, prior * (s - 1) / n_pos, 0.0)
    down = np.where(positive, -prior * s / n_pos, s / n_unl)
    g = up + down if bracket >= 0 else -down
    return np.append(np.bincount(cols, weights=g[rows], minlength=len(theta) - 1), g.sum())


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, positive: np.ndarray, n_features: int, prior: float,
             steps: int = 400, rate: float = 0.05, l2: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier on binary features (``rows``, ``cols``) by the non-negative risk."""
    theta = np.zeros(n_features + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        grad = nnpu_gradient(theta, rows, cols, positive, prior)
        grad[:-1] += l2 * prior * theta[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _present(texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, bin) of the features of each text, once a text."""
    for w in word_blocks(texts, ALNUM, lower=True):
        found = [row.astype(np.int64) * SPACE + _bins(h) for row, h in _features(w)]
        pairs = np.unique(np.concatenate(found))
        yield pairs // SPACE + w.first, pairs % SPACE


def _train(texts: pa.Array, positive: np.ndarray, prior: float, max_features: int, z_least: float):
    """(bins, weights, bias) of one bag."""
    counts = np.zeros((2, SPACE), dtype=np.int32)
    for row, at in _present(texts):
        np.add.at(counts, (positive[row].astype(np.int8), at), 1)
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    seen = np.flatnonzero(counts.any(axis=0))
    in_unl, in_pos = counts[:, seen]
    both = (in_pos + in_unl) / (n_pos + n_unl)
    z = (in_pos / n_pos - in_unl / n_unl) / np.sqrt(np.maximum(both * (1 - both), 1e-12) * (1 / n_pos + 1 / n_unl))
    clear = np.flatnonzero(np.abs(z) >= z_least)
    good = np.sort(seen[clear[np.argsort(-np.abs(z[clear]), kind="stable")[:max_features]]])
    new = np.full(SPACE, -1, dtype=np.int32)
    new[good] = np.arange(len(good))
    rows, cols = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int32)]
    for row, at in _present(texts):
        use = new[at] >= 0
        rows.append(row[use])
        cols.append(new[at[use]])
    weights, bias = nnpu_fit(np.concatenate(rows), np.concatenate(cols), positive, len(good), prior)
    return good, weights, bias


def fit(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id", text: str = "text",
        label: str = "toxic", max_positive: int = 8_000, max_unlabelled: int = 16_000, unlabelled_share: float = 1 / 16,
        bag: int = 4_000, bag_positive: int = 2_000, max_features: int = 5_000, z_least: float = 4.0) -> Weights:
    """Train on the rows of ``docs`` and ``labels`` that ``train_rows`` (a condition on the id) admits."""
    name = quoted(id_col)
    marked = (labels.select(F.col(name).alias(id_col), F.col(quoted(label)).cast("int").alias("_y"))
              .where(F.col(name).isNotNull() & F.col("_y").isNotNull()).where(train_rows)
              .groupBy(name).agg(F.max("_y").alias("_y")))
    n_pos, n_all = marked.agg(F.coalesce(F.sum("_y"), F.lit(0)), F.count(F.lit(1))).first()
    if not n_pos:
        return Weights(np.empty(0, dtype=np.int64), np.empty(0), -60.0)
    prior = min(0.9, max(1e-3, n_pos / n_all))
    pool = docs.select(F.col(name).alias(id_col), F.col(quoted(text)).alias("_t")).where(train_rows)
    digest = F.xxhash64(F.lit("sample"), F.col(name))
    # about max_positive ids at most: small enough to look up where the texts lie
    ids = F.broadcast(marked.where("_y = 1").where(chosen(digest, max_positive, n_pos)).select(name, F.lit(True).alias("_p")))
    total = docs.count()
    wanted = min(total, max(max_unlabelled, int(total * unlabelled_share))) if max_unlabelled else 0
    most = max(1, min(n_pos, max_positive))
    bags = max(1, round(wanted / bag), -(-most // bag_positive))
    # a confirmed example goes to as many bags as it takes to give each about bag_positive of them
    shared = min(bags, max(1, round(bags * bag_positive / most)))
    # one scan serves both samples: a text may be a confirmed example, an unlabelled text, or both
    first = F.pmod(F.xxhash64(F.lit("bag"), "_t"), F.lit(bags))
    in_bag = lambda p, at: F.struct(F.lit(p).alias("_p"), at.alias("_bag"))
    none = F.array().cast("array<struct<_p:boolean,_bag:bigint>>")
    as_example = F.transform(F.sequence(F.lit(0), F.lit(shared - 1)), lambda j: in_bag(True, F.pmod(first + j, F.lit(bags))))
    roles = F.concat(F.when(F.col("_p"), as_example).otherwise(none), F.when(F.col("_u"), F.array(in_bag(False, first))).otherwise(none))
    read = pool.withColumn("_u", F.coalesce(chosen(digest, wanted, total), F.lit(False))).join(ids, [id_col], "left")
    sample = read.where("_u or _p").select("_t", F.xxhash64("_t").alias("_k"), F.inline(roles))

    def train(table: pa.Table) -> pa.Table:
        # the same sums, whatever order the rows arrived in
        order = np.argsort(table.column("_k").to_numpy(), kind="stable")
        table = table.select(["_t", "_p"]).combine_chunks().take(pa.array(order))
        texts = table.column("_t").combine_chunks()
        positive = np.array(table.column("_p").to_pylist(), dtype=bool)
        at, w, bias = np.empty(0, dtype=np.int64), np.empty(0), None
        if positive.any():
            at, w, bias = _train(texts, positive, prior, max_features, z_least)
        # bin -1 has the bias, bin -2 the number of unlabelled texts; weights are whole units, so that sums are exact
        return pa.table({"bin": pa.array(np.concatenate((at, [-1] * (bias is not None), [-2])).astype(np.int64)),
                         "w": pa.array(np.rint(np.concatenate((w * UNIT, [bias * UNIT] if bias is not None else [], [(~positive).sum()]))).astype(np.int64))})

    # summed over the bags in Spark: SPACE + 2 rows at most, however many bags there are
    found = {r["bin"]: (r["w"], r["n"]) for r in sample.groupBy("_bag").applyInArrow(train, "bin long, w long")
             .groupBy("bin").agg(F.sum("w").alias("w"), F.count(F.lit(1)).alias("n")).collect()}
    if not found.pop(-2, (0, 0))[0] and not pool.isEmpty():
        raise ValueError("the sample has no unlabelled text: max_unlabelled is too small for the table")
    bias, trained = found.pop(-1, (0, 0))
    if not trained:
        if not pool.join(marked.where("_y = 1").select(name), [id_col], "left_semi").isEmpty():
            raise ValueError("the sample has no confirmed example, though the table has: max_positive is too small")
        return Weights(np.empty(0, dtype=np.int64), np.empty(0), -60.0)
    bins = np.array(sorted(found), dtype=np.int64)
    return Weights(bins, np.array([found[int(b)][0] for b in bins]) / UNIT / trained, bias / UNIT / trained)


def score(docs: DataFrame, model: Weights, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1) and ``predicted`` (1 from a score of 0.5)."""
    own = Own(docs, ["score", "predicted"])
    src = own.df.select(*own.keys())
    shared = docs.sparkSession.sparkContext.broadcast((model.bins, model.weights, model.bias))
    at = own.names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = Weights(*shared.value)
        for b in batches:
            s = weights.scores(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*b.schema.names, "score", "predicted"])
    made = StructType([*src.schema.fields]).add("score", "double").add("predicted", "integer")
    return src.mapInArrow(run, made).select(*own.back(), "score", "predicted")


def drop_toxic(docs: DataFrame, model: Weights, text: str = "text") -> DataFrame:
    """``docs`` without those predicted toxic."""
    own = Own(docs)
    return score(own.df, model, own.key[text]).where("predicted = 0").select(*own.back())

"""Source divergence audit: how far a source's words lie from its language's, and from those of other sources.

Terms are runs of letters (``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased). A language keeps the terms
that occur in at least ``least_docs`` of its documents; V is their number. A group (language, source), or a whole
language, gives a kept term p = 1 + floor(1e9 * (count + 5) / (N + 5 * V)), N the sum of its counts. All in integers.

* ``pair``: for each other source of the language the sum of |p - q| over all kept terms.
* ``term``: the kept terms that the group uses and that have p > q, q the language's, by p - q: ranks to ``top``.

Counting. Tasks take the terms of a block of texts as Arrow strings, count them exactly by (language, source,
term), and merge blocks until they would hold too many entries; a grouped aggregate adds the tasks' counts. Kept
terms are then a small table, cut from its lineage: one row for each (language, term, source) that occurs.

Count-cell ranking. Terms of a group with equal (group count, language count) have equal p - q: they are one cell.
Cells are few; cells of equal value are one level. The best ``top`` levels of a group are found first (a per-group
limit, applied before its shuffle); those whose cumulative number of terms stays below ``top`` before them matter,
and only the terms of their cells are expanded, in UTF-8 order, and ranked to ``top``.

Pairs. Kept terms are dealt by hash to blocks of about ``block`` matrix entries (terms x sources); a task fills the
matrix of p, with the value of count 0 where a term does not occur, and sums |p - q| of its columns. The result has
a row for each pair of sources of a language, which is what is asked for; nothing else grows with their square.

Defined cases: null text, language and source read as ''; a group without terms has all counts 0; a language
without kept terms has pairs of value 0 and no ``term`` rows; a single source has no pairs; rows that repeat count
each; an empty table gives an empty result. Only the named columns are read, so other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.columns import quoted
from clicklens.llm.lineage import cut
from clicklens.llm.words import byte_table, word_blocks
from clicklens.operators.common import bounded_broadcast

#: after A-Z are lower-cased: letters and bytes of letters beyond ASCII
LETTERS = byte_table(lambda b: 0x61 <= b <= 0x7A or b >= 0x80)
HELD = 400_000      # entries that a task merges before it lets them go


def _strings(w) -> pa.Array:
    """The words of a block as an Arrow string array, from one copy of their bytes."""
    size = w.ends - w.starts
    offsets = np.zeros(len(size) + 1, dtype=np.int32)
    np.cumsum(size, out=offsets[1:])
    # bytes of words, one after another: the blanks between them are left out
    edge = np.zeros(len(w.buf) + 1, dtype=np.int8)
    edge[w.starts] += 1
    edge[w.ends] -= 1
    data = w.buf[np.cumsum(edge[:-1], dtype=np.int8) > 0]
    return pa.StringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _block_counts(w, group: np.ndarray) -> pa.Table:
    """(g, term, n, docs) of a block: occurrences, and rows that have the term, by group."""
    codes = _strings(w).dictionary_encode()
    terms, code = codes.dictionary, codes.indices.to_numpy().astype(np.int64)
    of = group[w.first + w.row]
    # words lie in the order of rows: one entry for each (row, term), then for each (group, term)
    per_row, times = np.unique(w.row * len(terms) + code, return_counts=True)
    row, code = per_row // max(1, len(terms)), per_row % max(1, len(terms))
    of = group[w.first + row]
    key, at = np.unique(of * max(1, len(terms)) + code, return_inverse=True)
    return pa.table({"g": key // max(1, len(terms)), "term": terms.take(pa.array(key % max(1, len(terms)))),
                     "n": np.bincount(at, weights=times, minlength=len(key)).astype(np.int64),
                     "docs": np.bincount(at, minlength=len(key)).astype(np.int64)})


def _merged(tables: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(tables).group_by(["g", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return t.rename_columns({"n_sum": "n", "docs_sum": "docs"}) if "n_sum" in t.column_names else t


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term of every group of ``docs`` (lang, source, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[tuple, int] = {}
        held: list[pa.Table] = []
        least = 0

        def release():
            out = _merged(held)
            g = out.column("g").to_numpy()
            lang, source = (pa.array([k[i] for k in names], pa.string()).take(pa.array(g)) for i in (0, 1))
            return pa.table({"lang": lang, "source": source, "term": out.column("term"), "n": out.column("n"),
                             "docs": out.column("docs")}).combine_chunks().to_batches(max_chunksize=50_000)

        for b in batches:
            pairs = zip(b.column(0).to_pylist(), b.column(1).to_pylist())
            group = np.array([names.setdefault(p, len(names)) for p in pairs], dtype=np.int64)
            for w in word_blocks(b.column(2), LETTERS, lower=True):
                if len(w.starts):
                    held.append(_block_counts(w, group))
            if sum(t.num_rows for t in held) > least + HELD:
                held = [_merged(held)]
                least = held[0].num_rows
                if least > HELD:
                    yield from release()
                    held, least = [], 0
        if held:
            yield from release()

    parts = docs.select("lang", "source", "text").mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: str, total: str, v: str) -> Column:
    """p = 1 + floor(1e9 * (count + 5) / (total + 5 * v)), exact for any counts."""
    return F.expr(f"cast(1 + (cast(1000000000 as decimal(10,0)) * (cast({count} as decimal(19,0)) + 5))"
                  f" div (cast({total} as decimal(19,0)) + 5 * cast({v} as decimal(18,0))) as bigint)")


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, block: int = 200_000, lang: str = "lang",
          source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank) of every group of ``docs``."""
    rows = docs.select(*[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    over = Window.partitionBy("lang", "term")
    kept = cut(count_terms(rows).select("lang", "source", "term", "n", F.sum("n").over(over).alias("all_n"), F.sum("docs").over(over).alias("all_docs"),
                                        F.min("source").over(over).alias("least"))
               .where(F.col("all_docs") >= least_docs)
               .select("lang", "source", "term", "n", "all_n", (F.col("least") == F.col("source")).alias("once")))
    # V and N of each language: every kept term is counted at its smallest source
    langs = kept.groupBy("lang").agg(F.count_if("once").alias("v"), F.sum("n").alias("all_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = (rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("total", "v", "all_total")]))
    groups = groups.withColumn("sources", F.count(F.lit(1)).over(Window.partitionBy("lang")))
    groups = cut(groups.withColumn("blocks", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("v") * F.col("sources") / block))))
    known = kept.join(bounded_broadcast(groups, 1_000_000), ["lang", "source"])
    return _pairs(known, groups).unionByName(_terms(known, top))


def _terms(known: DataFrame, top: int) -> DataFrame:
    cells = known.groupBy("lang", "source", "n", "all_n").agg(
        F.count(F.lit(1)).alias("m"), F.first("total").alias("total"), F.first("v").alias("v"), F.first("all_total").alias("all_total"))
    valued = cells.withColumn("value", share("n", "total", "v") - share("all_n", "all_total", "v")).where("value > 0")
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    levels = (valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
              .withColumn("level", F.row_number().over(best)).where(F.col("level") <= top))
    before = F.sum("m").over(best.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("m")
    chosen = levels.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    # a cell is named by its two counts: the terms of the chosen cells come by an equi-join
    wanted = valued.join(chosen, ["lang", "source", "value"]).select("lang", "source", "n", "all_n", "value")
    found = known.select("lang", "source", "n", "all_n", "term").join(wanted, ["lang", "source", "n", "all_n"])
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("term"))    # strings compare by their bytes
    return (found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value",
                         F.row_number().over(ranked).alias("rank"))
            .where(F.col("rank") <= top))


def _pairs(known: DataFrame, groups: DataFrame) -> DataFrame:
    # each block needs the value of count 0 of every source of its language
    zero = F.when(F.col("v") > 0, share("0", "total", "v")).alias("zero")
    columns = groups.where("sources > 1").select("lang", "source", zero, F.explode(F.sequence(F.lit(1).cast("long"), "blocks")).alias("block"))
    entries = known.where("sources > 1").select(
        "lang", (F.pmod(F.xxhash64("term"), F.col("blocks")) + 1).alias("block"), "source", "term", share("n", "total", "v").alias("p"))

    def run(key, entries: pa.Table, columns: pa.Table) -> pa.Table:
        sources = columns.column("source").combine_chunks()
        order = pc.sort_indices(sources)
        sources = sources.take(order)
        zero = columns.column("zero").combine_chunks().take(order).fill_null(0).to_numpy(zero_copy_only=False)
        n = len(sources)
        total = np.zeros((n, n), dtype=np.int64)
        if len(entries):
            term = entries.column("term").combine_chunks().dictionary_encode()
            p = np.repeat(zero[:, None], len(term.dictionary), axis=1)
            at = pc.index_in(entries.column("source").combine_chunks(), sources).to_numpy()
            p[at, term.indices.to_numpy()] = entries.column("p").to_numpy()
            for i in range(n - 1):
                total[i, i + 1:] = np.abs(p[i + 1:] - p[i]).sum(axis=1)
        a, b = np.triu_indices(n, 1)
        return pa.table({"lang": pa.repeat(key[0], len(a)), "a": sources.take(pa.array(a)), "b": sources.take(pa.array(b)),
                         "value": total[a, b]})

    parts = (entries.groupBy("lang", "block").cogroup(columns.groupBy("lang", "block"))
             .applyInArrow(run, "lang string, a string, b string, value long"))
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("p")
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    return (sums.select("lang", "value", both).select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
            .withColumn("rank", F.row_number().over(ranked)))


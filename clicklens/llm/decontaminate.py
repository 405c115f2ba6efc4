"""Benchmark decontamination: a broadcast set of normalised test n-grams, scanned for in training windows.

Words are lower-cased (A-Z) runs of digits, letters a-z and non-ASCII characters. Every ``n`` consecutive
words of a benchmark item are a window; an item of fewer words, but not none, is one window. A task hashes
all windows of its documents at once, looks the hashes up in the broadcast set and verifies each hit word
by word, so the result does not rest on hashes.

The set is broadcast only while it has at most ``max_windows`` windows (they are counted first). A larger
benchmark is joined instead: both sides' windows meet by hash in a shuffle and are verified there.

Defined cases: a null text has no words and no hits; an item with a null text or no words has no window;
an item with a null id hits words but has no id to list; repeated items and documents count like the first;
an empty table gives an empty result, or no hits. Extra columns are carried, whatever their names, but for
the result's own names (``n_words``, ``hit_spans``, ``items``), which replace those of the input.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.columns import Own, quoted
from clicklens.llm.lineage import cut
from clicklens.llm.words import ALNUM, Words, window_hashes, word_blocks

RESULT = ("n_words", "hit_spans", "items")
RESULT_TYPES = "n_words long, hit_spans array<struct<start:int,end:int>>, items array<string>"
#: windows that are broadcast at most: about 100 bytes each, 200 MB in a task
MAX_WINDOWS = 1_000_000


def _window_text(w: Words, data: bytes, i: int, n: int) -> bytes:
    return b" ".join(data[w.starts[j]:w.ends[j]] for j in range(i, i + n))


def item_windows(benchmark: DataFrame, n: int = 13, text: str = "text", item: str = "item_id") -> DataFrame:
    """One row per window and item: ``window`` (words joined by a space), ``size`` in words, ``hash``, ``item``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_pylist()
            for w in word_blocks(b.column(1), ALNUM, lower=True):
                h, data, first = w.hashes(), w.buf.tobytes(), w.first_word()
                out: list[tuple] = []
                for r in range(w.rows):
                    a, z = int(first[r]), int(first[r + 1])
                    size = min(n, z - a)
                    if size:
                        hs = window_hashes(h[a:z], size).view(np.int64)
                        out += [(_window_text(w, data, a + k, size).decode(), size, int(hs[k]), ids[w.first + r])
                                for k in range(len(hs))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int32()),
                     pa.array([o[2] for o in out], pa.int64()), pa.array([o[3] for o in out], pa.string())],
                    names=["window", "size", "hash", "item"])
    return (benchmark.select(F.col(quoted(item)).cast("string"), F.col(quoted(text)).cast("string"))
            .mapInArrow(run, "window string, size int, hash long, item string").distinct())


class _Set:
    """The broadcast windows: per size the sorted hashes, and the items of each window text."""

    def __init__(self, rows):
        self.items: dict[bytes, list[str]] = {}
        hashes: dict[int, set[int]] = {}
        for window, size, h, item in rows:
            found = self.items.setdefault(window.encode(), [])
            if item is not None:
                found.append(item)
            hashes.setdefault(size, set()).add(h)
        self.hashes = {s: np.sort(np.fromiter(v, dtype=np.int64).view(np.uint64)) for s, v in hashes.items()}
        self.maps = {}
        for s, v in self.hashes.items():
            bits = np.zeros(1 << 22, dtype=bool)
            bits[(v & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
            self.maps[s] = bits

    def hits(self, w: Words) -> Iterator[tuple[int, int, list[str]]]:
        """(first word, size, items) of each window of the block that occurs in the benchmark."""
        h, data = w.hashes(), None
        for size, known in self.hashes.items():
            hs = window_hashes(h, size)
            if not len(hs):
                continue
            maybe = np.flatnonzero(self.maps[size][(hs & np.uint64((1 << 22) - 1)).astype(np.int64)])
            maybe = maybe[w.row[maybe] == w.row[maybe + size - 1]]
            at = np.searchsorted(known, hs[maybe])
            maybe = maybe[known[np.minimum(at, len(known) - 1)] == hs[maybe]]
            for i in maybe.tolist():
                data = w.buf.tobytes() if data is None else data
                found = self.items.get(_window_text(w, data, i, size))
                if found is not None:
                    yield i, size, found


def _spans(covered: np.ndarray) -> list[dict]:
    """Runs of true entries as (start, end exclusive)."""
    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return [{"start": int(a), "end": int(z)} for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, text: str = "text",
                       item_text: str = "text", item: str = "item_id", max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` with ``n_words``, ``hit_spans`` (runs of hit words, by word number) and ``items`` (ids, sorted)."""
    spark = docs.sparkSession
    windows = item_windows(benchmark, n, item_text, item)
    if windows.limit(max_windows + 1).count() > max_windows:
        return _by_join(docs, cut(windows), n, text)
    known = spark.sparkContext.broadcast([tuple(r) for r in windows.collect()])
    own = Own(docs, RESULT)
    src = own.df.select(*own.keys())
    made = pa.schema([("n_words", pa.int64()),
                      ("hit_spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                      ("items", pa.list_(pa.string()))])
    at = own.names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Set(known.value)
        for b in batches:
            counts, spans, items = [], [], []
            for w in word_blocks(b.column(at), ALNUM, lower=True):
                first, c = w.first_word(), w.counts()
                marks: dict[int, tuple[np.ndarray, set[str]]] = {}
                for i, size, found in lookup.hits(w):
                    r = int(w.row[i])
                    if r not in marks:
                        marks[r] = (np.zeros(int(c[r]), dtype=bool), set())
                    marks[r][0][i - first[r]:i - first[r] + size] = True
                    marks[r][1].update(found)
                counts += c.tolist()
                spans += [_spans(marks[r][0]) if r in marks else [] for r in range(w.rows)]
                items += [sorted(marks[r][1], key=str.encode) if r in marks else [] for r in range(w.rows)]
            arrays = [pa.array(v, f.type) for v, f in zip((counts, spans, items), made)]
            yield pa.RecordBatch.from_arrays([*b.columns, *arrays], schema=pa.schema([*b.schema, *made]))
    return src.mapInArrow(run, T.StructType([*src.schema.fields, *T.StructType.fromDDL(RESULT_TYPES).fields])).select(*own.back(), *RESULT)


def _by_join(docs: DataFrame, windows: DataFrame, n: int, text: str) -> DataFrame:
    """The same result for a benchmark too large to broadcast: windows of both sides meet by hash.

    A text's windows are keyed by the text's digest, so equal texts are scanned once and rows need no id. First only
    the windows' hashes travel (a number and a place); for those that the benchmark has, the texts are scanned again
    and their windows are compared word by word.
    """
    own = Own(docs, RESULT)
    text = own.key[text]
    keyed = own.df.withColumn("_text_key", F.sha2(F.col(text), 256))
    # windows shorter than n come from short items; their sizes are at most n values
    sizes = sorted(r[0] for r in windows.select("size").distinct().collect())

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            for w in word_blocks(b.column(1), ALNUM, lower=True):
                h, first = w.hashes(), w.first_word()
                for size in sizes:
                    hs = window_hashes(h, size)
                    for a in range(0, len(hs), 1 << 16):
                        at = np.arange(a, min(len(hs), a + (1 << 16)))
                        at = at[w.row[at] == w.row[at + size - 1]]
                        yield pa.RecordBatch.from_arrays(
                            [keys.take(pa.array(w.row[at] + w.first)), pa.array((at - first[w.row[at]]).astype(np.int32)),
                             pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(hs[at].view(np.int64))],
                            names=["_text_key", "pos", "size", "hash"])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in word_blocks(b.column(1), ALNUM, lower=True):
                data, first, out = w.buf.tobytes(), w.first_word(), []
                for r in range(w.rows):
                    key = b.column(0)[w.first + r].as_py()
                    out += [(key, x["pos"], x["size"], _window_text(w, data, int(first[r]) + x["pos"], x["size"]).decode())
                            for x in b.column(2)[w.first + r].as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.string(), pa.int32(), pa.int32(), pa.string()))],
                    names=["_text_key", "pos", "size", "window"])

    texts = keyed.groupBy("_text_key").agg(F.first(text).alias("_t")).where("_text_key is not null")
    seen = texts.mapInArrow(hashes, "_text_key string, pos int, size int, hash long")
    maybe = (seen.join(windows.select("size", "hash").distinct(), ["size", "hash"], "left_semi")
             .groupBy("_text_key").agg(F.collect_list(F.struct("pos", "size")).alias("_maybe")))
    at = texts.join(maybe, "_text_key").mapInArrow(compared, "_text_key string, pos int, size int, window string")
    hits = at.join(windows.select("size", "window", "item"), ["size", "window"])
    per = (hits.groupBy("_text_key").agg(
        F.array_distinct(F.array_sort(F.flatten(F.collect_set(F.sequence(F.col("pos"), F.col("pos") + F.col("size") - 1))))).alias("_at"),
        F.array_sort(F.collect_set("item")).alias("items")))
    # neighbours in the sorted words tell where a run begins and ends
    begins = F.filter("_at", lambda x, i: (i == 0) | (F.get("_at", i - 1) < x - 1))
    ends = F.filter("_at", lambda x, i: (i == F.size("_at") - 1) | (F.get("_at", i + 1) > x + 1))
    per = per.select("_text_key", "items", F.zip_with(
        begins, ends, lambda a, z: F.struct(a.alias("start"), (z + 1).alias("end"))).alias("hit_spans"))
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    count = F.size(F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != ""))
    return (keyed.join(per, "_text_key", "left")
            .select(*own.back(),
                    F.when(F.col(text).isNull(), 0).otherwise(count).cast("long").alias("n_words"),
                    F.coalesce("hit_spans", F.expr("array()").cast("array<struct<start:int,end:int>>")).alias("hit_spans"),
                    F.coalesce("items", F.expr("array()").cast("array<string>")).alias("items")))


def hit_words(spans) -> F.Column:
    """Number of words inside ``hit_spans``."""
    return F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))


def is_contaminated(n_words: str = "n_words", spans: str = "hit_spans", share: int = 20):
    """The rule: some word is hit, and at least one in ``share`` of all words."""
    hit = hit_words(spans)
    return (hit > 0) & (F.lit(share) * hit >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """``docs`` without the contaminated ones; the others stay as they are."""
    own = Own(docs)
    found = find_contamination(own.df, benchmark, text=own.key[text], **kw)
    return found.where(~is_contaminated()).select(*own.back())


def cut_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", **kw) -> DataFrame:
    """``docs`` with the hit words taken out of the text (normalised words joined by a space) where there are any."""
    own = Own(docs)
    text_name, text = text, own.key[text]
    found = find_contamination(own.df, benchmark, text=text, **kw)
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")
    kept = F.filter(words, lambda x, i: ~F.exists("hit_spans", lambda s: (s["start"] <= i) & (i < s["end"])))
    new = F.when(F.size("hit_spans") > 0, F.array_join(kept, " ")).otherwise(F.col(text))
    return found.select(*own.back(**{text_name: new}))

"""Exact substring dedup with suffix automata of reference shards.

A word is removed from a document when a window of ``n`` words that covers it also starts in a document with
a smaller id. Every document is reference and query at once, so automata of the whole corpus cannot be
broadcast; instead reference shards are cut so small that each fits a task, and the stretches of documents
that could match a shard are brought to it:

1. Anchors. The leftmost smallest of the ``n - gram + 1`` hashed word grams of a window is its anchor. Equal
   windows have equal anchors, and neighbouring windows mostly share one (about one anchor in 5 words). A
   document's windows with one anchor form a stretch, at most ``2 n - gram`` words.
2. Rows (anchor, id, digest of the stretch) meet by anchor. Only anchors under two ids or more matter. If all
   their stretches are equal, every id but the smallest has its stretch removed; nothing more is read. Digests are
   BLAKE2b of the stretch's bytes, 128 bits: no word goes on a word hash, which only routes.
3. The different stretches of an anchor are a reference shard. Equal ones are grouped before the shuffle
   under their smallest id (larger ids lose every window of it). In ascending order of id each one is
   streamed through the shard's suffix automaton, then added to it: the matching statistic at a word is the
   longest run ending there that occurs under a smaller id; runs of ``n`` words or more mark removed spans.
4. An anchor with more than ``shard`` stretches is no single shard: its windows are routed by their own
   hash, so each shard is one window's text (an exact way for hot passages, split evenly).

Rows of an anchor meet in one task in 2, so anchors that hold over 1/100,000 of the rows of a sample of
documents (1 in 16, by hash; 100,000 anchors at most) are counted with a grouped aggregate and a broadcast
join instead. The sample only routes: both ways give the same rows.

Copies of a whole text are found by their SHA-256 first (128 bits of it) and take no part in 3 and 4.

Defined cases: a null or empty text has no words and nothing removed; ids that are no whole numbers come after
all that are, in the order of their hashes, and rows with a null id likewise, by their texts' hashes; rows that
share an id never remove from each other; an empty table gives an empty result. Only id and text are read, so other columns' names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.columns import quoted
from clicklens.llm.lineage import cut
from clicklens.llm.words import NOT_BLANK, Words, window_hashes, word_blocks

GRAM = 5
SHARD = 2_000


def _leftmost_min(g: np.ndarray, w: int) -> np.ndarray:
    """Position of the leftmost smallest of every ``w`` consecutive entries of ``g``."""
    at, size = np.arange(len(g)), 1
    while size < w:
        step = min(size, w - size)
        a, b = at[:len(at) - step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        size += step
    return at


def _stretches(w: Words, n: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of each run of windows with one anchor in one row."""
    none = np.empty(0, dtype=np.int64)
    if len(w.starts) < n:
        return none, none, np.empty(0, dtype=np.uint64)
    h = w.hashes()
    g = window_hashes(h, gram)
    at = _leftmost_min(g, n - gram + 1)
    ok = np.flatnonzero(w.row[:len(h) - n + 1] == w.row[n - 1:])
    if not len(ok):
        return none, none, np.empty(0, dtype=np.uint64)
    new = np.ones(len(ok), dtype=bool)
    new[1:] = (at[ok][1:] != at[ok][:-1]) | (np.diff(ok) != 1)
    first = np.flatnonzero(new)
    return ok[first], np.diff(np.append(first, len(ok))), g[at[ok[first]]]


class SuffixAutomaton:
    """Suffix automaton of several word sequences: one set of states, started anew at the root for each."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, words) -> None:
        nxt, link, length, last = self.next, self.link, self.length, 0
        for c in words:
            known = nxt[last].get(c)
            if known is not None and length[known] == length[last] + 1:
                last = known
                continue
            split = known is not None
            if not split:
                cur = len(nxt)
                nxt.append({})
                length.append(length[last] + 1)
                link.append(0)
            p = last
            while not split and p != -1 and c not in nxt[p]:
                nxt[p][c] = cur
                p = link[p]
            if split or p != -1:
                q = nxt[p][c]
                if length[q] != length[p] + 1:
                    clone = len(nxt)
                    nxt.append(dict(nxt[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p != -1 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = clone
                    q = clone
                if split:
                    last = q
                    continue
                link[cur] = q
            last = cur

    def statistics(self, words) -> list[int]:
        """For each word the length of the longest run ending there that occurs in an added sequence."""
        nxt, link, length, state, run, out = self.next, self.link, self.length, 0, 0, []
        for c in words:
            while state and c not in nxt[state]:
                state = link[state]
                run = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                run += 1
            else:
                run = 0
            out.append(run)
        return out


def _shard_hits(rows: list[tuple[str, tuple[int, int], int]], n: int) -> Iterator[tuple[tuple[int, int], int, int]]:
    """(digest, smallest id, windows hit as bits) of a shard's stretches (words, digest, id), sorted by id."""
    if len(rows) == 1:
        yield rows[0][1], rows[0][2], 0
        return
    sam, waiting = SuffixAutomaton(), []
    for text, digest, doc in rows:
        if waiting and waiting[0][1] != doc:
            for words, _ in waiting:
                sam.add(words)
            waiting = []
        words = text.split(" ")
        mask = 0
        for end, run in enumerate(sam.statistics(words)):
            if run >= n:
                mask |= 1 << (end - n + 1)
        waiting.append((words, doc))
        yield digest, doc, mask


def _with_key(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(id, text, doc, th, th2): ``doc`` orders documents; an id that is no number, or none, lies above all others, by
    the hash of the id or of the text. ``th`` and ``th2`` are 128 bits of the text's SHA-256."""
    t, i = F.col(quoted(text)).cast("string"), F.col(quoted(id_col))
    above = F.lit((1 << 63) - 1) - F.pmod(F.when(i.isNull(), F.xxhash64(t)).otherwise(F.xxhash64(i.cast("string"))), F.lit(1 << 61))
    sha = F.sha2(F.coalesce(t, F.lit("")), 256)
    part = lambda at: F.conv(F.substring(sha, at, 16), 16, -10).cast("long")
    return docs.select(i.alias("id"), t.alias("text"), F.coalesce(i.cast("string").try_cast("long"), above).alias("doc"),
                       part(1).alias("th"), part(17).alias("th2"))


def _anchor_names(docs: DataFrame, n: int, gram: int) -> DataFrame:
    """(anchor) of every stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for w in word_blocks(b.column(0), NOT_BLANK):
                yield pa.RecordBatch.from_arrays([pa.array(_stretches(w, n, gram)[2].view(np.int64))], names=["anchor"])
    return docs.select("text").mapInArrow(run, "anchor long")


def _anchors(docs: DataFrame, n: int, gram: int, popular, wanted: bool, digests: bool = True) -> DataFrame:
    """(doc, anchor, digest of its stretch in two halves) of the stretches whose anchors are among ``popular``, or (not
    ``wanted``) of all others. Digests are made for these only, and only if asked for."""
    names = ["doc", "anchor", "da", "db"] if digests else ["doc", "anchor"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = popular.value
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for w in word_blocks(b.column(1), NOT_BLANK):
                first, size, anchor = _stretches(w, n, gram)
                mine = np.flatnonzero(np.isin(anchor, known) == wanted)
                if len(mine):
                    first, size, anchor = first[mine], size[mine], anchor[mine]
                    made = _digests(w.joined(), first, size + n - 1) if digests else ()
                    yield pa.RecordBatch.from_arrays([pa.array(ids[w.first + w.row[first]]), pa.array(anchor.view(np.int64)), *made], names=names)
    return docs.select("doc", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def _digests(joined: tuple[bytes, np.ndarray, np.ndarray], first: np.ndarray, words: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """128-bit digests, in two halves, of the bytes of runs of ``words`` words from ``first``."""
    data, begin, end = joined
    view = memoryview(data)
    found = b"".join([blake2b(view[a:z], digest_size=16).digest() for a, z in zip(begin[first].tolist(), end[first + words - 1].tolist())])
    halves = np.frombuffer(found, dtype=np.int64).reshape(-1, 2)
    return pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())


def _flags(src: DataFrame, n: int, gram: int, shard: int) -> DataFrame:
    """Per document the anchors whose stretches are surely removed, may be, or must be routed window by window."""
    sampled = cut(_anchor_names(src.where(F.pmod(F.xxhash64("doc"), F.lit(16)) == 0), n, gram).groupBy("anchor").count())
    total = sampled.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    often = sampled.where(F.col("count") >= max(8, total // 100_000)).select("anchor").collect()
    popular = src.sparkSession.sparkContext.broadcast(np.sort(np.array([r[0] for r in often], dtype=np.int64).view(np.uint64)))
    seen = {"least": F.min("doc"), "most": F.max("doc"), "n": F.count(F.lit(1))}
    seen |= {f"{d}{k}": f(d) for d in ("da", "db") for k, f in ((0, F.min), (1, F.max))}
    by = Window.partitionBy("anchor")
    cold = _anchors(src, n, gram, popular, False).select("doc", "anchor", *[f.over(by).alias(k) for k, f in seen.items()])
    stats = _anchors(src, n, gram, popular, True).groupBy("anchor").agg(*[f.alias(k) for k, f in seen.items()])
    hot = _anchors(src, n, gram, popular, True, digests=False).join(F.broadcast(stats), "anchor")
    kind = (F.when((F.col("da0") == F.col("da1")) & (F.col("db0") == F.col("db1")), F.when(F.col("doc") > F.col("least"), "sure"))
            .when(F.col("n") <= shard, "maybe").otherwise("apart"))
    return (cold.unionByName(hot).where("least < most").select("doc", "anchor", kind.alias("kind"))
            .where("kind is not null"))


def _in_rows(row: np.ndarray, values: np.ndarray, lists, first: int) -> np.ndarray:
    """For each (row, value): is the value in that row's list (an Arrow list column)?"""
    out = np.zeros(len(row), dtype=bool)
    bounds = np.searchsorted(row, np.arange(row[-1] + 2)) if len(row) else []
    for r in range(len(bounds) - 1):
        a, z = bounds[r], bounds[r + 1]
        if z > a:
            have = lists[first + r].values
            if have is not None and len(have):
                out[a:z] = np.isin(values[a:z], have.to_numpy(zero_copy_only=False))
    return out


def _routed(flagged: DataFrame, n: int, gram: int) -> DataFrame:
    """(doc, th, start, windows, key, da, db, stretch) of the stretches and windows that need an automaton."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 2))
            maybe, apart, copies = (b.column(i) for i in (5, 6, 7))
            for w in word_blocks(b.column(3), NOT_BLANK):
                first, size, anchor = _stretches(w, n, gram)
                if not len(first):
                    continue
                row, value = w.row[first], anchor.view(np.int64)
                whole = _in_rows(row, ths[w.first + row], copies, w.first)
                one = _in_rows(row, value, maybe, w.first) & ~whole
                cut = _in_rows(row, value, apart, w.first) & ~whole
                # a stretch of a hot anchor is cut into its windows, each routed by its own hash
                rep = size[cut]
                at_cut = np.repeat(first[cut], rep) + np.arange(rep.sum()) - np.repeat(np.cumsum(rep) - rep, rep)
                at = np.concatenate((first[one], at_cut))
                count = np.concatenate((size[one], np.ones(len(at_cut), dtype=np.int64)))
                if not len(at):
                    continue
                windows = window_hashes(w.hashes(), n)[at_cut] if len(at_cut) else np.empty(0, dtype=np.uint64)
                keys = np.concatenate((anchor[one], windows))
                joined = data, s, e = w.joined()
                texts = [data[a:z] for a, z in zip(s[at].tolist(), e[at + count + n - 2].tolist())]
                begin = w.first_word()[w.row[at]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[w.first + w.row[at]]), pa.array(ths[w.first + w.row[at]]),
                     pa.array((at - begin).astype(np.int32)), pa.array(count.astype(np.int32)),
                     pa.array(keys.view(np.int64)), *_digests(joined, at, count + n - 1),
                     pa.array(texts, pa.binary()).cast(pa.string())],
                    names=["doc", "th", "start", "windows", "key", "da", "db", "stretch"])
    return flagged.mapInArrow(run, "doc long, th long, start int, windows int, key long, da long, db long, stretch string")


def _matched(shards: DataFrame, n: int) -> DataFrame:
    """(key, da, db, least, mask): ``shards`` (key, stretch, da, db, least) streamed shard by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        out: list[tuple] = []

        def settle():
            out.extend((key, *digest, least, mask) for digest, least, mask in (_shard_hits(rows, n) if rows else ()))
        for b in batches:
            for k, text, da, db, least in zip(*(c.to_pylist() for c in b.columns)):
                if k != key:
                    settle()
                    key, rows = k, []
                rows.append((text, (da, db), least))
                if len(out) >= 10_000:
                    yield _batch(out)
                    out = []
        settle()
        yield _batch(out)

    def _batch(out):
        cols = zip(*out) if out else ((),) * 5
        return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in cols],
                                          names=["key", "da", "db", "least", "mask"])
    ordered = shards.select("key", "stretch", "da", "db", "least").repartition("key").sortWithinPartitions("key", "least")
    return ordered.mapInArrow(run, "key long, da long, db long, least long, mask long")


def remove_repeats(docs: DataFrame, n: int = 13, id_col: str = "doc_id", text: str = "text", gram: int = GRAM,
                   shard: int = SHARD) -> DataFrame:
    """(id, n_words, removed: spans of words, kept: the kept words joined by one blank) for every row of ``docs``."""
    if not 0 < n - gram + 1 <= 63:
        raise ValueError("a stretch has 1 to 63 windows")
    src = _with_key(docs, id_col, text)
    digest = src.select("doc", "th", "th2")
    firsts = cut(digest.groupBy("th", "th2").agg(F.min("doc").alias("least")))
    copies = digest.join(firsts, ["th", "th2"]).where("doc > least").select("doc", F.col("th").alias("anchor"), F.lit("copy").alias("kind"))
    flags = cut(_flags(src, n, gram, shard).unionByName(copies).groupBy("doc").agg(
        *[F.collect_set(F.when(F.col("kind") == k, F.col("anchor"))).alias(k) for k in ("sure", "maybe", "apart", "copy")]))
    # one plan of one shape wherever texts and flags meet, so that the texts are shuffled once
    texts = src.select("doc", "id", "th", "text").join(flags, "doc", "left").select("doc", "id", "th", "text", "sure", "maybe", "apart", "copy")
    routed = _routed(texts, n, gram)
    shards = routed.groupBy("key", "da", "db", "stretch").agg(F.min("doc").alias("least"))
    matched = _matched(shards, n)
    hits = (routed.select("doc", "th", "start", "windows", "key", "da", "db").join(matched, ["key", "da", "db"])
            .select("doc", "th", "start", "windows",
                    F.when(F.col("doc") > F.col("least"), F.lit(-1).cast("long")).otherwise(F.col("mask")).alias("mask"))
            .where("mask <> 0")
            .groupBy("doc").agg(F.collect_list(F.struct("th", "start", "windows", "mask")).alias("hits")))
    return _kept(texts.join(hits, "doc", "left"), n, gram)


def _kept(marked: DataFrame, n: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ths = b.column(2).to_numpy(zero_copy_only=False)
            sure, copy, hits = (b.column(i) for i in (4, 7, 8))
            for w in word_blocks(b.column(3), NOT_BLANK):
                data, first = w.buf.tobytes(), w.first_word()
                s, e = w.starts.tolist(), w.ends.tolist()
                gone = np.zeros(len(s) + 1, dtype=np.int32)  # +1 where a removed run begins, -1 after it
                at, size, anchor = _stretches(w, n, gram)
                if len(at):
                    out = _in_rows(w.row[at], anchor.view(np.int64), sure, w.first)
                    np.add.at(gone, at[out], 1)
                    np.add.at(gone, at[out] + size[out] + n - 1, -1)
                for r in range(w.rows):
                    i, a, z = w.first + r, int(first[r]), int(first[r + 1])
                    if z - a >= n:
                        if ths[i] in (copy[i].as_py() or ()):
                            gone[a] += 1
                            gone[z] -= 1
                        for hit in hits[i].as_py() or ():
                            if hit["th"] == ths[i]:
                                start, mask = a + hit["start"], hit["mask"]
                                for j in range(hit["windows"]):
                                    if mask >> j & 1:
                                        gone[start + j] += 1
                                        gone[start + j + n] -= 1
                off = np.cumsum(gone[:-1]) > 0
                spans, kept = [], []
                for r in range(w.rows):
                    a, z = int(first[r]), int(first[r + 1])
                    edge = np.diff(np.concatenate(([0], off[a:z].astype(np.int8), [0])))
                    spans.append([{"start": int(x), "end": int(y)}
                                  for x, y in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
                    kept.append(b" ".join([data[s[j]:e[j]] for j in (np.flatnonzero(~off[a:z]) + a).tolist()]))
                yield pa.RecordBatch.from_arrays(
                    [b.column(1).slice(w.first, w.rows), pa.array(w.counts()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                     pa.array(kept, pa.binary()).cast(pa.string())], names=["id", "n_words", "removed", "kept"])
    kind = marked.schema["id"].dataType.simpleString()
    return (marked.select("doc", "id", "th", "text", "sure", "maybe", "apart", "copy", "hits")
            .mapInArrow(run, f"id {kind}, n_words long, removed array<struct<start:int,end:int>>, kept string"))

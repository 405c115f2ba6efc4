"""SimHash near-duplicates by fuzzy hashing with the binary Golay code.

A text's fingerprint has 64 bits: a bit is set when over half of its word shingles' XXH64 values have it.
Fingerprints link when at most ``distance`` (0 to 2) bits differ; documents of linked fingerprints form groups.

Candidates. The fingerprint is cut into segments of 22, 21 and 21 bits, each padded to a word of the perfect
[23,12,7] Golay code, whose decoder maps every 23-bit word to the one codeword within distance 3. With two
errors in three segments, one segment has none and a second has one at most (pigeonhole). A word's *near
indices* are the codewords that it and its 23 one-bit neighbours decode to (1 or 6 of them); two words that
differ in one bit share one. So every pair (exact segment, near index of another segment) is a key, and
linked fingerprints share a key. Copies share a fingerprint, so only distinct fingerprints are keyed.

Verification. Keys of up to ``bucket`` fingerprints emit their pairs, and the bit distance is checked. Fingerprints
of larger buckets are linked without pairs, and exactly: two fingerprints differ in two bits or fewer if and only
if their balls of radius 1 meet, so each one joins the smallest member seen at each of its 65 ball words. No
bucket is gathered whole: sizes are counted first, and a ball word has 65 fingerprints at most.

Defined cases: a null or empty text has fingerprint zero and links like any other; fewer words than a shingle
make one shingle of all of them; null ids group last: a group's id is null only if all its ids are; repeated
rows are rows of one fingerprint; an empty table gives an empty result. Only id and text are read, so other
columns' names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import Own, quoted
from clicklens.llm.lineage import cut
from clicklens.llm.links import components
from clicklens.llm.words import NOT_BLANK, word_blocks

# Fixed values of the code: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, length, and our segments.
GOLAY_GENERATOR = 0xAE3
GOLAY_LENGTH = 23
SEGMENTS = ((0, 22), (22, 21), (43, 21))

_PIECE = 1 << 15


def fingerprint(texts, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit fingerprints (uint64) of an Arrow text column."""
    out = []
    for w in word_blocks(texts, NOT_BLANK, lower=True):
        prints = np.zeros(w.rows, dtype=np.uint64)
        # words joined by one blank: shingle i is then one slice
        data = w.buf.tobytes()
        first, starts, ends = w.first_word(), w.starts.tolist(), w.ends.tolist()
        one = xxhash.xxh64_intdigest
        for r in range(w.rows):
            a, z = int(first[r]), int(first[r + 1])
            if a == z:
                continue
            words = [data[s:e] for s, e in zip(starts[a:z], ends[a:z])]
            n = max(1, len(words) - shingle + 1)
            ones = np.zeros(64, dtype=np.int64)
            for i in range(0, n, _PIECE):
                part = words[i:i + _PIECE + shingle - 1]
                flat = b" ".join(part)
                if len(part) < shingle:
                    hs = [one(flat, seed)]
                else:
                    ends_at = np.cumsum(np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1) - 1
                    begin = [0, *(ends_at[:len(part) - shingle] + 1).tolist()]
                    hs = [one(flat[x:y], seed) for x, y in zip(begin, ends_at[shingle - 1:].tolist())]
                bits = np.unpackbits(np.array(hs, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                ones += bits.sum(axis=0, dtype=np.int64)
            prints[r] = np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]
        out.append(prints)
    return np.concatenate(out) if out else np.empty(0, dtype=np.uint64)


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text_hash, fp): one row per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    src = docs.select(F.col(quoted(id_col)).alias("id"), F.xxhash64(F.col(quoted(text))).alias("text_hash"),
                      F.col(quoted(text)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = fingerprint(b.column(2), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))],
                                             names=["id", "text_hash", "fp"])
    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text_hash long, fp long")


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word modulo the generator polynomial."""
    r = words.astype(np.int64).copy()
    for bit in range(GOLAY_LENGTH - 1, 10, -1):
        r = np.where((r >> bit) & 1, r ^ (GOLAY_GENERATOR << (bit - 11)), r)
    return r


def _leaders() -> np.ndarray:
    """The error of weight 3 or less behind each of the 2,048 syndromes."""
    errors = np.array([0] + [(1 << i) | (1 << j) | (1 << k) for i in range(23) for j in range(i, 23) for k in range(j, 23)])
    table = np.zeros(1 << 11, dtype=np.int64)
    table[_syndromes(errors)] = errors
    return table


_LEADERS = _leaders()


def golay_index(words: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword within distance 3 of each 23-bit word."""
    return (words ^ _LEADERS[_syndromes(words)]) >> 11


def near_indices(words: np.ndarray) -> np.ndarray:
    """(n, 24): the indices that a word and its one-bit neighbours decode to, with repeats."""
    flips = np.concatenate(([0], 1 << np.arange(GOLAY_LENGTH, dtype=np.int64)))
    return golay_index((words[:, None] ^ flips[None, :]).ravel()).reshape(-1, len(flips))


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key): the keys of each fingerprint, without repeats; a key has 3 + 22 + 12 bits."""
    segs = [((fp >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    rows, keys = [], []
    near = [np.sort(near_indices(s), axis=1) for s in segs]
    fresh = [np.concatenate((np.ones((len(fp), 1), dtype=bool), n[:, 1:] != n[:, :-1]), axis=1) for n in near]
    for j in range(3):
        for k in range(3):
            if j != k:
                r, c = np.nonzero(fresh[k])
                rows.append(r)
                keys.append(((np.int64(3 * j + k) << 34) | (segs[j][r] << 12) | near[k][r, c]))
    return np.concatenate(rows), np.concatenate(keys)


def _with_keys(prints: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, len(fp), 4096):
                part = fp[a:a + 4096]
                r, k = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(part[r]), pa.array(k)], names=["fp", "key"])
    return prints.mapInArrow(run, "fp long, key long")


def link_edges(prints: DataFrame, distance: int = 2, bucket: int = 16) -> DataFrame:
    """(a, b): edges between distinct fingerprints (``prints``: fp) whose components are those of all links."""
    if not 0 <= distance <= 2:
        raise ValueError("the keys find links of at most 2 bits")
    keyed = _with_keys(prints)
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = cut(keyed.join(sizes, "key"))
    small = shared.where(F.col("n") <= bucket).groupBy("key").agg(F.array_sort(F.collect_list("fp")).alias("m"))
    pairs = (small.select("m", F.posexplode("m").alias("i", "a"))
             .select("a", F.explode(F.slice("m", F.col("i") + 2, F.lit(bucket))).alias("b")))
    pairs = pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()
    large = shared.where(F.col("n") > bucket).select("fp").distinct()
    if distance < 2:  # a ball of radius 1 would link two bits: a word and its neighbours are looked up instead
        flips = [0] if distance == 0 else [0] + [1 << i for i in range(63)] + [-(1 << 63)]
        words = F.array(*[F.lit(f).cast("long") for f in flips])
        near = large.select(F.col("fp").alias("a"), F.explode(F.transform(words, lambda f: F.col("fp").bitwiseXOR(f))).alias("b"))
        return pairs.unionByName(near.where("a < b").join(large.select(F.col("fp").alias("b")), "b").select("a", "b"))
    words = F.array(*[F.lit(f).cast("long") for f in [0] + [1 << i for i in range(63)] + [-(1 << 63)]])
    ball = large.select("fp", F.explode(F.transform(words, lambda f: F.col("fp").bitwiseXOR(f))).alias("word"))
    # at most 65 fingerprints meet at a word
    met = ball.groupBy("word").agg(F.collect_list("fp").alias("m")).where("size(m) > 1")
    linked = met.select(F.array_min("m").alias("a"), F.explode("m").alias("b")).where("a <> b").distinct()
    return pairs.unionByName(linked)


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text: str = "text",
                    bucket: int = 16) -> DataFrame:
    """(id, text_hash, fp, component_id, root) for every row: ``component_id`` is the smallest id reachable through
    linked fingerprints (not a name of the group: it may be null, or stand in several), ``root`` the group's smallest fingerprint."""
    rows = cut(fingerprints(docs, shingle, id_col, text))
    firsts = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(link_edges(firsts.select("fp"), distance, bucket))
    grouped = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = cut(grouped.join(least, "root").select("fp", "component_id", "root"))
    return rows.join(classes, "fp").select("id", "text_hash", "fp", "component_id", "root")


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group: the one with the smallest id, null last (of equal ids the smallest text hash; equal rows are one)."""
    found = near_duplicates(docs, shingle, distance, id_col, text)
    # where all ids are null, min() of the struct still names one text
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")).alias("k"))
    # the join and the removal of equal rows have one key without nulls, so texts are shuffled once
    key = lambda i, h: [i.isNull().alias("_none"), F.coalesce(i.cast("string"), F.lit("")).alias("_id"), h.alias("_h")]
    keep = first.select(*key(F.col("k.id"), F.col("k.text_hash")))
    own = Own(docs)
    marked = own.df.select("*", *key(F.col(own.key[id_col]), F.xxhash64(F.col(own.key[text]))))
    names = ["_none", "_id", "_h"]
    return marked.join(keep, names, "left_semi").dropDuplicates(names).select(*own.back())

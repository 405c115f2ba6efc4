"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of its last 8 bytes says so, moved on to the next ASCII white space: the
same passage is cut alike in every document. Documents are sent to tasks by the smallest hash of their
chunks, so those that share most chunks meet, and a task encodes each chunk once (caches of bounded size).
A new chunk is put together from its pieces (a run of blanks and the word after it), which are encoded once
too: new pieces go through the tokenizer in long runs, and tokens must lie inside pieces there. Where one
does not, the tokenizer joins words, and chunks are encoded whole from then on.

Chunk joins are repaired: the last piece before a join and the first after it are encoded together; where
that differs from their separate ids, more pieces are taken on both sides until the outermost pieces of the
stretch have the same ids alone and in it, at last the text up to there.

A home of a third of all rows would be one task: homes that hold over 1/200 of the rows (200 at most, so
they fit a plan; counted in a sample of 1 row in 16, which only routes) are spread over 64 tasks by the text's id.

Defined cases: a null text is an empty one with no ids; rows that are repeated are rows like any other; a
very long text is cut into chunks like any other; an empty table gives an empty result; extra columns are
carried, but for the names of the result.
"""

from __future__ import annotations

import hashlib
import os
import re
import sys
import types
from collections import OrderedDict
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clicklens.llm.columns import Own
from clicklens.llm.lineage import cut
from clicklens.llm.words import NOT_BLANK, word_blocks

#: average bytes between cuts; bytes of a task's cache
CHUNK = 1 << 10
CACHE_BYTES = 4 << 20
PIECES = 300_000
RUN = 400

OUTPUTS = {"n_tokens": ("long", pa.int64()), "ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string()),
           "ids_sha256": ("string", pa.string()), "decoded_sha256": ("string", pa.string())}

_GEAR = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1, 0xD3A2646D, 0xFD7046C5, 0xB55A4F09)]


def chunks(texts, size: int = CHUNK) -> Iterator[list[bytes]]:
    """The chunks of each text of an Arrow column; joined they are its UTF-8 bytes."""
    for w in word_blocks(texts, NOT_BLANK):
        buf = w.buf
        data = buf.tobytes()
        h = np.zeros(len(buf), dtype=np.uint32)
        for j, gear in enumerate(_GEAR):
            h[7:] += buf[7 - j:len(buf) - j].astype(np.uint32) * gear if len(buf) > 7 else np.uint32(0)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        at = np.flatnonzero((h >> np.uint32(8)) % np.uint32(size) == 0)
        blank = np.flatnonzero(~NOT_BLANK[buf])
        row = np.searchsorted(w.offsets, at, side="right") - 1
        at = at[at >= w.offsets[row] + 7]  # the hash lies inside the text
        nxt = np.searchsorted(blank, at)
        cuts = np.unique(blank[nxt[nxt < len(blank)]])
        ends = np.searchsorted(cuts, w.offsets)
        for r in range(w.rows):
            a, z = int(w.offsets[r]), int(w.offsets[r + 1])
            inner = cuts[ends[r]:ends[r + 1]].tolist()
            edges = [a, *(c for c in inner if a < c < z), z]
            yield [data[x:y] for x, y in zip(edges, edges[1:])] if z > a else []


_BLANKS = b" \t\n\r\x0b\x0c"
_PIECE = re.compile(rb"[ \t\n\r\x0b\x0c]*[^ \t\n\r\x0b\x0c]+|[ \t\n\r\x0b\x0c]+")


def _tail_start(chunk: bytes) -> int:
    """Where the last piece of a chunk begins."""
    end = len(chunk.rstrip(b" \t\n\r\x0b\x0c"))
    at = max(chunk.rfind(c, 0, end) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c"))
    while at > 0 and chunk[at - 1] in b" \t\n\r\x0b\x0c":
        at -= 1
    return max(at, 0)


def _head_end(chunk: bytes) -> int:
    """Where the first piece of a chunk ends."""
    begin = len(chunk) - len(chunk.lstrip(b" \t\n\r\x0b\x0c"))
    found = [x for x in (chunk.find(c, begin) for c in (b" ", b"\t", b"\n", b"\r", b"\x0b", b"\x0c")) if x >= 0]
    return min(found, default=len(chunk))


class ChunkEncoder:
    """A tokenizer file with caches of encoded chunks and pieces; ids are kept as little-endian 32-bit bytes."""

    def __init__(self, vocab: str, cache_bytes: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(vocab)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cache: OrderedDict[bytes, bytes] = OrderedDict()
        self.pieces: dict[bytes, bytes] = {}
        self.separable = True
        self.bytes, self.most, self.encoded, self.reused = 0, cache_bytes, 0, 0

    def _encode(self, texts: Sequence[bytes]) -> list[bytes]:
        if not texts:
            return []
        return [np.array(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> None:
        """Ids of new pieces: those of blanks and a word in runs, where a token outside a piece ends the use of pieces;
        others (a text's first word, or its last blanks) by themselves."""
        alone = [p for p in pieces if p[0] not in _BLANKS or p[-1] in _BLANKS]
        self.pieces.update(zip(alone, self._encode(alone)))
        pieces = [p for p in pieces if p[0] in _BLANKS and p[-1] not in _BLANKS]
        for a in range(0, len(pieces), RUN):
            part = pieces[a:a + RUN]
            texts = [p.decode() for p in part]
            run = self.tok.encode("".join(texts), add_special_tokens=False)
            edges = np.cumsum([0, *map(len, texts)])
            spans = np.array(run.offsets, dtype=np.int64).reshape(-1, 2)
            at = np.searchsorted(edges, spans[:, 0], side="right") - 1
            if len(spans) and (spans[:, 1] > edges[at + 1]).any():
                self.separable = False
                return
            ids, cuts = np.array(run.ids, dtype="<u4").tobytes(), (4 * np.searchsorted(at, np.arange(len(part) + 1))).tolist()
            for p, x, y in zip(part, cuts, cuts[1:]):
                self.pieces[p] = ids[x:y]

    def _new_ids(self, new: list[bytes]) -> list[bytes]:
        """Ids of new chunks."""
        if self.separable:
            split = [_PIECE.findall(c) for c in new]
            known = self.pieces
            if len(known) > PIECES:
                known.clear()
            self._learn(list(set(chain.from_iterable(split)).difference(known)))
            if self.separable:
                get = known.__getitem__
                return [b"".join(map(get, s)) for s in split]
        return self._encode(new)

    def _chunk_ids(self, docs: list[list[bytes]]) -> dict[bytes, bytes]:
        have, new = {}, []
        for c in dict.fromkeys(chain.from_iterable(docs)):
            ids = self.cache.get(c)
            if ids is None:
                new.append(c)
            else:
                self.cache.move_to_end(c)
                have[c] = ids
        self.encoded += len(new)
        self.reused += sum(map(len, docs)) - len(new)
        for c, ids in zip(new, self._new_ids(new)):
            have[c] = self.cache[c] = ids
            self.bytes += len(c) + len(ids) + 300
        while self.bytes > self.most and self.cache:
            c, ids = self.cache.popitem(last=False)
            self.bytes -= len(c) + len(ids) + 300
        return have

    def encode(self, docs: list[list[bytes]]) -> Iterator[bytes]:
        """Ids of each text, given as its chunks."""
        have = self._chunk_ids(docs)
        joins = list(dict.fromkeys((a[_tail_start(a):], z[:_head_end(z)]) for d in docs for a, z in zip(d, d[1:])))
        alone = list(dict.fromkeys(x for j in joins for x in j))
        small = dict(zip(alone, self._encode(alone)))
        agree = {j for j, ids in zip(joins, self._encode([a + z for a, z in joins])) if ids == small[j[0]] + small[j[1]]}
        for d in docs:
            out = [have[c] for c in d[:1]]
            for k in range(1, len(d)):
                tail, head, ids = d[k - 1][_tail_start(d[k - 1]):], d[k][:_head_end(d[k])], have[d[k]]
                if (tail, head) in agree and out[-1].endswith(small[tail]) and ids.startswith(small[head]):
                    out.append(ids)
                else:
                    out = [self._repair(d[:k], b"".join(out), d[k], ids)]
            yield b"".join(out)

    def _repair(self, before: list[bytes], left_ids: bytes, right: bytes, right_ids: bytes) -> bytes:
        """Ids of the chunks ``before`` (``left_ids``) and of ``right``, with the join encoded anew."""
        a, z, k, used = _PIECE.findall(before[-1]), _PIECE.findall(right), 2, 1
        while k < len(a) or used < len(before):
            while k >= len(a) and used < len(before):    # on into earlier chunks, twice as many each time
                used = min(len(before), 2 * used)
                a = _PIECE.findall(b"".join(before[-used:]))
            tail, head = b"".join(a[-k:]), b"".join(z[:k])
            t, h, mid, first, last = self._encode([tail, head, tail + head, a[-k:][0], z[:k][-1]])
            # where the right chunk is taken whole nothing after it is judged here: its own join comes next
            if left_ids.endswith(t) and right_ids.startswith(h) and mid.startswith(first) and (k >= len(z) or mid.endswith(last)):
                return left_ids[:len(left_ids) - len(t)] + mid + right_ids[len(h):]
            k *= 2
        return self._encode([b"".join(before) + right])[0]

    def decode(self, ids: list[bytes]) -> list[str]:
        return self.tok.decode_batch([np.frombuffer(i, dtype="<u4").tolist() for i in ids], skip_special_tokens=False)


def _encoder(vocab: str) -> ChunkEncoder:
    """This process's encoder of a file: a Python worker keeps it from task to task."""
    kept = sys.modules.setdefault("_kept_bpe_encoders", types.ModuleType("_kept_bpe_encoders")).__dict__
    if vocab not in kept:
        kept[vocab] = ChunkEncoder(vocab)
    return kept[vocab]


def _homes(docs: DataFrame, at: int, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            home = [min(map(xxhash.xxh64_intdigest, c), default=0) for c in chunks(b.column(at), size)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(home, dtype=np.uint64).view(np.int64))],
                                             names=[*b.schema.names, "_home"])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields]).add("_home", "long"))


def encode_documents(docs: DataFrame, vocab: str, outputs: Sequence[str] = ("n_tokens", "ids"), text: str = "text",
                     carry: Sequence[str] = ("doc_id",), size: int = CHUNK) -> DataFrame:
    """The ``carry`` columns of every row with the wanted ``OUTPUTS`` of its text."""
    carry = [c for c in carry if c not in outputs]
    own = Own(docs, set(docs.columns) - set(carry))
    src = own.df.select(*[F.col(own.key[c]) for c in carry], F.col(own.key[text]).alias("_text"))
    at = len(carry)
    row = F.xxhash64(*[F.col(own.key[c]) for c in carry])
    counted = cut(_homes(src.where(F.pmod(row, F.lit(16)) == 0).select("_text"), 0, size).groupBy("_home").count())
    n = counted.agg(F.coalesce(F.sum("count"), F.lit(0))).first()[0]
    hot = [r[0] for r in counted.where(F.col("count") > max(16, n // 200)).select("_home").collect()]
    homed = _homes(src, at, size)
    spread = F.when(F.col("_home").isin(hot), F.pmod(row, F.lit(64))) if hot else F.lit(None)
    placed = homed.repartition(F.col("_home"), spread.cast("long"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocab)
        for b in batches:
            step = 256
            for a in range(0, b.num_rows, step):
                part = b.slice(a, step)
                ids = list(encoder.encode(list(chunks(part.column(at), size))))
                made = {"n_tokens": lambda: [len(i) // 4 for i in ids], "ids": lambda: [np.frombuffer(i, dtype="<i4") for i in ids],
                        "ids_sha256": lambda: [hashlib.sha256(i).hexdigest() for i in ids]}
                if {"decoded", "decoded_sha256"} & set(outputs):
                    texts = encoder.decode(ids)
                    made["decoded"] = lambda: texts
                    made["decoded_sha256"] = lambda: [hashlib.sha256(t.encode()).hexdigest() for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:at], *(pa.array(made[o](), OUTPUTS[o][1]) for o in outputs)],
                    names=[*part.schema.names[:at], *outputs])
    made = T.StructType.fromDDL(", ".join(f"{o} {OUTPUTS[o][0]}" for o in outputs))
    found = placed.mapInArrow(run, T.StructType([*src.schema.fields[:at], *made.fields]))
    return found.select(*[F.col(own.key[c]).alias(c) for c in carry], *outputs)

"""Sharding: a Feistel permutation with cycle walking over global row numbers.

A row's number is its place in an order that only its content decides; the permutation of the numbers
0..N-1 is keyed by ``seed``. Row ``p`` of the shuffled order goes to shard ``p mod n`` and slot ``p div n``:
counts differ by one at most, slots have no gaps, and both are computable from the row number alone.

Numbers without a global sort: rows are hashed into buckets, about sqrt(N) of them (none under 1,000 rows
on average), each bucket's rows are ranked by the order columns, and buckets are laid one after another. Equal rows are counted
before the shuffle and get a run of numbers, so a row that is repeated a million times is one row there.

The Feistel network works on pairs (l, r) with l < a, r < b, where a and b are close to sqrt(N) and
a*b >= N: fewer than a + b numbers lie outside 0..N-1, and a walk through them ends after at most
``steps`` rounds, found exactly from these few numbers when the plan is made.

Defined cases: null columns sort and hash like a value of their own; rows that are equal in all columns
share a run of slots (any assignment among them is the same); an empty table gives an empty result.
Result names (``shard``, ``slot``, ``row_number``) replace those of the input.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clicklens.llm.columns import Own

ROUNDS = 6
_MASK = (1 << 32) - 1


def _mix32(x: Column, key: int) -> Column:
    """Keyed 32-bit hash with shifts and products that stay below 2**63."""
    x = (x.bitwiseXOR(F.lit(key & _MASK))).bitwiseAND(F.lit(_MASK))
    for mul, shift in ((0x45D9F3B, 16), (0x2C1B3C6D, 15)):
        x = (x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(mul)).bitwiseAND(F.lit(_MASK))
    return x.bitwiseXOR(F.shiftright(x, 13))


def _mix32_py(x: int, key: int) -> int:
    x = (x ^ key) & _MASK
    for mul, shift in ((0x45D9F3B, 16), (0x2C1B3C6D, 15)):
        x = ((x ^ (x >> shift)) * mul) & _MASK
    return x ^ (x >> 13)


class Feistel:
    """Permutation of 0..n-1; ``of`` is the plain Python form of what ``permute`` does to a column."""

    def __init__(self, n: int, seed: int = 0, rounds: int = ROUNDS):
        self.n, self.rounds = n, rounds
        self.a = max(1, math.isqrt(max(0, n - 1)) + 1) if n else 1
        self.b = max(1, -(-n // self.a))
        self.keys = [_mix32_py((seed * 0x9E3779B1 + i * 0x85EBCA6B) & _MASK, 0x5BD1E995) for i in range(rounds)]
        outside, self.steps = range(n, self.a * self.b) if n else (), 1
        chain: dict[int, int] = {}
        for x in outside:  # fewer than a + b numbers
            seen, y = 1, self.once(x)
            while y >= n:
                seen, y = seen + 1, self.once(y)
            chain[x] = seen
        # a walk enters the outside at most once: 1 step in, then the longest way out
        self.steps += max(chain.values(), default=0)

    def once(self, x: int) -> int:
        left, right = divmod(x, self.b)
        for i, k in enumerate(self.keys):
            if i % 2:
                right = (right + _mix32_py(left & _MASK, k)) % self.b
            else:
                left = (left + _mix32_py(right & _MASK, k)) % self.a
        return left * self.b + right

    def of(self, x: int) -> int:
        y = self.once(x)
        while y >= self.n:
            y = self.once(y)
        return y

    def permute(self, df: DataFrame, number: str, out: str) -> DataFrame:
        """``df`` with the permuted ``number`` in ``out``: one projection a round, so no expression is repeated."""
        own = Own(df, [out])
        keep = [F.col(k) for k in own.keys()]
        df = own.df.select(*keep, F.col(own.key[number]).alias("_fx"))
        for step in range(self.steps):
            inside = (F.col("_fx") < self.n) & F.lit(step > 0)
            df = df.select(*keep, F.col("_fx"), inside.alias("_in"),
                           F.expr(f"_fx div {self.b}L").alias("_l"), (F.col("_fx") % F.lit(self.b)).alias("_r"))
            for i, k in enumerate(self.keys):
                if i % 2:
                    pair = (F.col("_l"), ((F.col("_r") + _mix32(F.col("_l").bitwiseAND(F.lit(_MASK)), k)) % F.lit(self.b)).alias("_r"))
                else:
                    pair = (((F.col("_l") + _mix32(F.col("_r").bitwiseAND(F.lit(_MASK)), k)) % F.lit(self.a)).alias("_l"), F.col("_r"))
                df = df.select(*keep, "_fx", "_in", *pair)
            df = df.select(*keep, F.when(F.col("_in"), F.col("_fx"))
                           .otherwise(F.col("_l") * F.lit(self.b) + F.col("_r")).alias("_fx"))
        return df.select(*own.back(), F.col("_fx").alias(out))


def number_rows(df: DataFrame, order: list[str], n: int, out: str = "row_number") -> DataFrame:
    """``df`` (of ``n`` rows) with ``out``: 0..n-1 in an order that content alone decides.

    The order is: hash bucket, then ``order``, then all columns.
    """
    own = Own(df, [out])
    every = [F.col(k) for k in own.keys()]
    buckets = max(1, n // max(1000, math.isqrt(n)))
    lead = [F.col(own.key[c]) for c in order]
    counted = own.df.select(*every).groupBy(*own.keys()).agg(F.count(F.lit(1)).alias("_copies"))
    hashed = counted.withColumn("_h", F.xxhash64(*every)).withColumn("_b", F.pmod(F.col("_h"), F.lit(buckets)))
    # one row a bucket, so about sqrt(n) rows in the one task that adds them up
    sizes = hashed.groupBy("_b").agg(F.sum("_copies").alias("_n"))
    offsets = sizes.select("_b", (F.sum("_n").over(Window.orderBy("_b")) - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_b").orderBy(*lead, "_h", *every)
    ranked = hashed.withColumn("_to", F.sum("_copies").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    placed = ranked.join(offsets, "_b").withColumn("_from", F.col("_off") + F.col("_to") - F.col("_copies"))
    # runs of equal rows are cut into pieces before they are laid out, so a long run is no single task's work
    single = placed.where("_copies = 1").select(*own.back(), F.col("_from").alias(out))
    piece = F.explode(F.sequence(F.col("_from"), F.col("_from") + F.col("_copies") - 1, F.lit(10_000).cast("long")))
    runs = (placed.where("_copies > 1").select(*every, (F.col("_from") + F.col("_copies")).alias("_end"), piece.alias("_p"))
            .repartition("_p"))
    many = runs.select(*own.back(), F.explode(F.sequence(
        F.col("_p"), F.least(F.col("_end"), F.col("_p") + 10_000) - 1)).alias(out))
    return single.unionByName(many)


def shard_rows(df: DataFrame, shards: int, order: list[str], seed: int = 0) -> DataFrame:
    """``df`` with ``row_number``, ``shard`` (0..shards-1) and ``slot`` (0.. without gaps in each shard)."""
    own = Own(df, ["row_number", "shard", "slot"])
    base = own.df.select(*own.keys())
    n = base.count()
    numbered = number_rows(base, [own.key[c] for c in order], n)
    moved = Feistel(n, seed).permute(numbered, "row_number", "_p")
    return moved.select(*own.back(), "row_number", (F.col("_p") % F.lit(shards)).cast("int").alias("shard"),
                        F.expr(f"_p div {int(shards)}L").alias("slot"))

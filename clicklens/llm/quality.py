"""Quality rules by weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Built-in functions only. Every rule votes 1 (good), 0 (bad) or -1 (abstains) on a text. The texts are counted
by their pattern of votes (3 ** rules patterns at most, so that table fits the driver at every size), and
expectation-maximisation over these counts of all texts estimates the share of good texts and, for each rule
and vote, how likely it is on good and on bad texts (conditional independence; votes start as mostly right and never count against themselves).
A text is kept when its posterior probability of being good is at least ``threshold``.

Statistics of a text (whole texts): ``n_words`` words ``[^\\x20\\x09-\\x0D]+``, ``word_chars`` code points in
them, ``n_symbols`` characters of ``#*$%&|<>``, ``n_lines`` and ``n_dup_lines`` lines with a word and those equal to an
earlier one, ``n_repeat_words`` words inside 3-word windows that occur twice or more (windows are compared by
64-bit hashes within one text), ``n_letters`` letters, ``n_upper`` upper-case letters, ``n_marks`` runs of two or
more signs, ``n_lone`` words of signs alone, ``n_symbol_runs`` runs of the symbols.

Defined cases: a null or empty text has all statistics zero; repeated rows are rows like any other and count
as often in the estimates; an empty table gives an empty result; extra columns are carried, but for the
result's own names.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import Own, quoted
from clicklens.llm.lineage import cut

BLANK = r"[\x20\x09-\x0D]+"
STATS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper",
         "n_marks", "n_lone", "n_symbol_runs")


def text_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the statistics of each whole text (all long)."""
    mine = Own(docs, STATS)
    own, docs = [F.col(k) for k in mine.keys()], mine.df
    t = F.coalesce(F.col(mine.key[text]), F.lit(""))
    words = F.filter(F.split(t, BLANK, -1), lambda w: w != "")
    df = docs.select(*own, F.transform(words, lambda w: F.xxhash64(w)).alias("_w"))
    n = F.size("_w")
    windows = F.when(n >= 3, F.transform(
        F.slice("_w", 1, F.greatest(F.lit(0), n - 2)),
        lambda w, i: F.xxhash64(w, F.get("_w", i + 1), F.get("_w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    df = df.select(*own, n.cast("long").alias("n_words"), windows.alias("_k"))
    # sort only where something repeats; then neighbours tell which windows occur twice
    placed = F.array_sort(F.transform("_k", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    df = df.select(*own, "n_words", F.when(F.size(F.array_distinct("_k")) < F.size("_k"), placed).alias("_s"))
    same = lambda s, i: F.coalesce(F.get("_s", i)["k"] == s["k"], F.lit(False))
    again = F.filter("_s", lambda s, i: same(s, i - 1) | same(s, i + 1))
    covered = F.size(F.array_distinct(F.flatten(F.transform(again, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2)))))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(*own, "n_words", F.when(F.col("_s").isNull(), 0).otherwise(covered).cast("long").alias("n_repeat_words"),
                   lines.alias("_l"))
    long = lambda c: F.length(c).cast("long")
    return df.select(
        *mine.back(), "n_words", long(F.translate(t, " \t\n\x0b\f\r", "")).alias("word_chars"),
        long(F.regexp_replace(t, r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words", long(F.regexp_replace(t, r"[^\p{L}]+", "")).alias("n_letters"),
        long(F.regexp_replace(t, r"[^\p{Lu}]+", "")).alias("n_upper"),
        F.regexp_count(t, F.lit(r"[!?.,;:#*$%&|<>~=]{2,}")).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])[#*$%&|<>~=!?.,;:]++(?![^\x20\x09-\x0D])")).cast("long").alias("n_lone"),
        F.regexp_count(t, F.lit(r"[#*$%&|<>]++")).cast("long").alias("n_symbol_runs"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1).otherwise(-1)


def rules() -> dict[str, Column]:
    """The rules' votes over the columns of ``text_stats``: 1 good, 0 bad, -1 abstains."""
    n, chars, letters = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_letters"), F.lit(1))
    words = F.greatest(n, F.lit(1))
    lines = F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "length": _vote(n >= 50, n < 10),
        "word_length": _vote((chars >= 3 * n) & (chars <= 10 * n), (chars < 2 * n) | (chars > 15 * n)),
        "symbols": _vote(20 * F.col("n_symbols") < words, 4 * F.col("n_symbols") > words),
        "duplicate_lines": _vote(10 * F.col("n_dup_lines") <= lines, 10 * F.col("n_dup_lines") > 3 * lines),
        "repeated_windows": _vote(5 * F.col("n_repeat_words") <= words, 10 * F.col("n_repeat_words") > 3 * words),
        "letters": _vote(10 * F.col("n_letters") >= 8 * chars, 10 * F.col("n_letters") < 6 * chars),
        "symbol_share": _vote(100 * F.col("n_symbols") < chars, 20 * F.col("n_symbols") > chars),
        "symbol_words": _vote(20 * F.col("n_symbol_runs") < words, 5 * F.col("n_symbol_runs") > words),
        "marks": _vote(50 * F.col("n_marks") < words, 10 * F.col("n_marks") > words),
        "lone_signs": _vote(50 * F.col("n_lone") < words, 10 * F.col("n_lone") > words),
        "capitals": _vote(10 * F.col("n_upper") <= 2 * letters, 2 * F.col("n_upper") > letters),
    }


def estimate(counts: Sequence[tuple[tuple[int, ...], int]], steps: int = 200, prior: float = 0.8, right: float = 0.8):
    """(log odds of the share of good texts, log odds of each rule's votes) from (votes, count) of all patterns."""
    counts = sorted(counts)
    if not counts:
        return 0.0, []
    votes = np.array([v for v, _ in counts]) + 1                 # columns of ``like``: abstains, bad, good
    times = np.array([c for _, c in counts], dtype=np.float64)
    k, rule = votes.shape[1], np.arange(votes.shape[1])
    like = np.tile(np.array([[0.5, 0.5], [1 - right, right], [right, 1 - right]]), (k, 1, 1))    # rule, vote, (on good, on bad)
    share = prior
    for _ in range(steps):
        odds = np.log(share / (1 - share)) + (np.log(like[..., 0]) - np.log(like[..., 1]))[rule, votes].sum(axis=1)
        p = 1 / (1 + np.exp(np.clip(-odds, -700, 700)))
        part = np.stack([times * p, times * (1 - p)])
        share = min(0.999, max(0.001, part[0].sum() / part.sum()))
        # one text of each vote beforehand keeps probabilities off zero
        seen = np.stack([[np.bincount(votes[:, r], weights=w, minlength=3) for w in part] for r in rule]).transpose(0, 2, 1)
        like = (seen + 1) / (part.sum(axis=1) + 3)
        # no rule is worse than chance: a vote that would speak against itself says nothing, and neither does abstaining
        against = np.stack([np.ones(k, dtype=bool), like[:, 1, 0] > like[:, 1, 1], like[:, 2, 0] < like[:, 2, 1]], axis=1)
        like = np.where(against[..., None], like.mean(axis=2, keepdims=True), like)
    weights = np.log(like[..., 0] / like[..., 1])
    return float(np.log(share / (1 - share))), [{v: float(w[v + 1]) for v in (1, 0, -1)} for w in weights]


def judge(docs: DataFrame, carry: Sequence[str] = ("doc_id",), text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The ``carry`` columns of every row with the statistics, ``posterior`` (probability of a good text) and ``good``.

    The statistics, a few numbers a text, are checkpointed: the estimates and the verdicts read them.
    """
    src = docs.select(*[F.col(quoted(c)).alias(f"_c{i}") for i, c in enumerate(carry)], F.col(quoted(text)).alias("_text"))
    voters = rules()
    stats = text_stats(src, "_text").drop("_text")
    names = [f"_v{i}" for i in range(len(voters))]
    voted = cut(stats.select(*stats.columns, *[v.alias(n) for n, v in zip(names, voters.values())]))
    counts = [(tuple(r[n] for n in names), r["count"]) for r in voted.groupBy(*names).count().collect()]
    base, weights = estimate(counts)
    odds = F.lit(base)
    for name, w in zip(names, weights):
        odds = odds + F.when(F.col(name) == 1, w[1]).when(F.col(name) == 0, w[0]).otherwise(w[-1])
    scored = voted.withColumn("posterior", 1 / (1 + F.exp(-odds)))
    return scored.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)], *STATS, "posterior",
                         (F.col("posterior") >= threshold).alias("good"))

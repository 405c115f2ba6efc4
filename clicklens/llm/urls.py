"""URL filters: rules on hosts and paths, found by hashed expressions.

A url is expanded into host suffixes (of the numbers of labels that rules have) and path prefixes (of the lengths
that rules have). Each
expression's SHA-256 has a short prefix; urls and rules meet in an equi-join on it, the full digest is
confirmed, and of a url's rules the longest wins (then the longer host, then block over allow). Urls without
a rule get ``default``.

Work is done once for each distinct (host, path): they are grouped before the shuffle, and the verdicts are
joined back, which an adaptive join splits for a popular one. Rules are broadcast only up to ``max_rules``
(counted); more are joined by shuffle.

Defined cases: a null url, or one without ``://``, has an empty host and path and no rule; a path that is
empty starts with no rule's path; null or repeated page ids are rows like any other; an empty table gives an
empty result; columns of the result (``host``, ``path``, ``rule``, ``verdict``) replace those of the input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import Own
from clicklens.operators.common import bounded_broadcast

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: hexadecimal digits of the short prefix: 32 bits
PREFIX = 8


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with ``host`` (A-Z lower-cased) and ``path`` of the url."""
    own = Own(df, ["host", "path"])
    u = own.key[url]
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring({u}, instr({u}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return own.df.select(*own.back(), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))


def apply_rules(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
                max_rules: int = 100_000) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (host and path of the rule that won, or null) and ``verdict``.

    ``rules`` has ``action`` (allow or block), ``host`` and ``path``, all text.
    """
    own = Own(pages, ["host", "path", "rule", "verdict"])
    split = split_url(own.df.select(*own.keys()), own.key[url])
    digest = lambda host, path: F.sha2(F.concat_ws("\n", host, path), 256)
    listed = rules.select("action", F.col("host").alias("r_host"), F.col("path").alias("r_path"),
                          digest(F.col("host"), F.col("path")).alias("r_digest"))
    listed = listed.withColumn("prefix", F.substring("r_digest", 1, PREFIX))
    # distinct lengths of the rules' paths: as many as the longest path has characters, at most
    lengths = sorted(r[0] for r in rules.select(F.length("path").alias("n")).distinct().collect() if r[0] is not None)
    wanted = F.array(*[F.lit(n) for n in lengths]).cast("array<int>")
    # and of labels in the rules' hosts: a host has one suffix of each number of labels, however many labels it has
    depths = sorted(r[0] for r in rules.select(F.size(F.split("host", r"\.", -1)).alias("n")).distinct().collect() if r[0] > 0)
    deep = F.array(*[F.lit(n) for n in depths]).cast("array<int>")
    urls = split.select("host", "path").where("host <> ''").distinct()
    labels = F.size(F.split("host", r"\.", -1))
    suffixes = urls.select("host", "path", F.explode(F.transform(
        F.filter(deep, lambda n: n <= labels), lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))).alias("suffix"))
    expressions = suffixes.select("host", "path", "suffix",
                                  F.explode(F.filter(wanted, lambda n: n <= F.length("path"))).alias("n"))
    expressions = expressions.withColumn("digest", digest(F.col("suffix"), F.expr("substring(path, 1, n)")))
    met = (expressions.withColumn("prefix", F.substring("digest", 1, PREFIX))
           .join(bounded_broadcast(listed, max_rules), "prefix").where("digest = r_digest"))
    rank = F.struct(F.length("r_host") + F.length("r_path"), F.length("r_host"), (F.col("action") == "block").cast("int"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("r_host", "r_path", "action"), rank).alias("won"))
    return (split.join(best, ["host", "path"], "left")
            .select(*own.back(), "host", "path", F.concat("won.r_host", "won.r_path").alias("rule"),
                    F.coalesce("won.action", F.lit(default)).alias("verdict")))

"""Input columns with the names that operators use inside, with dots and with backticks come back unchanged."""

import pytest
from pyspark.sql import functions as F

from clicklens.llm import bpe, centroids, decontaminate, divergence, pii, quality, quality_classifier, secret_scan, shards, simhash, substrings, toxicity, urls
from clicklens.llm import queries as Q

PASSAGE = " ".join(f"word{i}" for i in range(30))
NAMES = ["_to", "_b", "_h", "_p", "_fx", "_l", "_r", "_in", "_copies", "_n", "_off", "_from", "_end", "_whole", "_runs", "pii", "_values", "_id", "_text_hash",
         "score", "predicted", "n_words", "hit_spans", "items", "_text_key", "_at", "_t", "hash", "window", "size", "pos", "_text", "_home", "ids", "n_tokens",
         "_c0", "_c1", "_w", "_k", "_s", "won", "host", "path", "rule", "verdict", "row_number", "shard", "slot", "good", "posterior", "stats", "id", "a.b", "x`y", "a b"]
SCHEMA = ", ".join(["doc_id long", "text string", "lang string", "source string", "n_chars long", "url string", *(f"`{n.replace('`', '``')}` string" for n in NAMES)])


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"{PASSAGE} mail a{i}@b.org {i}", "en", "a/b", 5, f"http://h{i}.net/fr/x", *(f"{n}{i}" for n in NAMES)) for i in range(6)]
    return spark.createDataFrame(rows, SCHEMA).cache()


def _bench(spark):
    return spark.createDataFrame([(1, "none of these words")], "item_id long, text string")


def _model(spark):
    import numpy as np
    return toxicity.Weights(np.empty(0, dtype=np.int64), np.empty(0), -1.0)


KEEPERS = {
    "shards": (lambda s, d: shards.shard_rows(d, 3, ["doc_id"]), {"row_number", "shard", "slot"}),
    "numbers": (lambda s, d: shards.number_rows(d, ["doc_id"], 6), {"row_number"}),
    "feistel": (lambda s, d: shards.Feistel(6).permute(d, "doc_id", "slot"), {"slot"}),
    "urls": (lambda s, d: urls.apply_rules(d, s.createDataFrame([("block", "net", "/fr/")], "action string, host string, path string")),
             {"host", "path", "rule", "verdict"}),
    "split_url": (lambda s, d: urls.split_url(d), {"host", "path"}),
    "find_pii": (lambda s, d: pii.find_pii(d), {"pii"}),
    "redact": (lambda s, d: pii.redact(d), {"text"}),
    "keep_one": (lambda s, d: simhash.keep_one(d.where("doc_id = 1")), set()),
    "mask": (lambda s, d: secret_scan.mask(d, secret_scan.scan(d)), {"text"}),
    "score": (lambda s, d: toxicity.score(d, _model(s)), {"score", "predicted"}),
    "drop_toxic": (lambda s, d: toxicity.drop_toxic(d, _model(s)), set()),
    "contamination": (lambda s, d: decontaminate.find_contamination(d, _bench(s)), {"n_words", "hit_spans", "items"}),
    "contamination_by_join": (lambda s, d: decontaminate.find_contamination(d, _bench(s), max_windows=0), {"n_words", "hit_spans", "items"}),
    "drop_contaminated": (lambda s, d: decontaminate.drop_contaminated(d, _bench(s)), set()),
    "cut_contamination": (lambda s, d: decontaminate.cut_contamination(d, _bench(s)), set()),
    "text_stats": (lambda s, d: quality.text_stats(d), set(quality.STATS)),
    "judge": (lambda s, d: quality.judge(d, ["doc_id", *(n for n in NAMES if n not in (*quality.STATS, "posterior", "good"))]),
              {*quality.STATS, "posterior", "good", "text", "lang", "source", "n_chars", "url"}),
    "bpe": (lambda s, d: bpe.encode_documents(d, Q.vocabulary(), carry=["doc_id", *NAMES]), {"n_tokens", "ids", "text", "lang", "source", "n_chars", "url"}),
}


@pytest.mark.parametrize("name", sorted(KEEPERS))
def test_other_columns_are_unchanged(spark, docs, name):
    run, replaced = KEEPERS[name]
    out = run(spark, docs)
    mine = [c for c in docs.columns if c not in replaced]
    assert [c for c in out.columns if c in mine] == mine
    given = {r["doc_id"]: r for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == (1 if name == "keep_one" else 6)
    for r in rows:
        assert [r[c] for c in mine] == [given[r["doc_id"]][c] for c in mine]


def test_stages_and_readers_of_few_columns(spark, docs):
    import corpus_pipeline as P
    for name, stage in P.STAGES:
        if name != "toxicity":      # reads labels of the tables: see below
            out = stage(spark, docs.where("doc_id = 1"), "/root/testdata/sf0.001")
            assert out.count() == 1
            if name != "bpe":
                assert out.columns == docs.columns and {r["a.b"] for r in out.collect()} == {"a.b1"}
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"), F.lit(1).alias("quality"), F.lit(1).alias("a.b"))
    assert toxicity.drop_toxic(docs, toxicity.fit(docs, labels, F.lit(True))).columns == docs.columns
    assert substrings.remove_repeats(docs).count() == 6 and simhash.near_duplicates(docs).count() == 6
    stats = quality_classifier.statistics(docs)
    assert quality_classifier.score(stats, quality_classifier.fit(stats, labels, F.lit(True), features=8)).count() == 6
    assert divergence.audit(docs, 2).where("part = 'term'").count() == 0 and secret_scan.scan(docs).count() >= 0
    vectors = docs.withColumn("embedding", F.array_repeat(F.col("doc_id").cast("float"), 64))
    assert centroids.cluster(vectors, id_col="doc_id").count() == 6


def test_names_that_need_quotes_as_arguments(spark, docs):
    odd = docs.select(F.col("doc_id").alias("i.d"), F.col("text").alias("t.x"), F.col("lang").alias("l.g"), F.col("source").alias("s`c"))
    assert substrings.remove_repeats(odd, id_col="i.d", text="t.x").count() == 6
    assert simhash.near_duplicates(odd, id_col="i.d", text="t.x").count() == 6
    assert pii.redact(odd, text="t.x").columns == odd.columns
    assert simhash.keep_one(odd, id_col="i.d", text="t.x").count() >= 1
    assert quality_classifier.statistics(odd, "i.d", "t.x").count() == 6
    assert divergence.audit(odd, 2, lang="l.g", source="s`c", text="t.x").count() == 0
    assert bpe.encode_documents(odd, Q.vocabulary(), text="t.x", carry=["i.d"]).count() == 6
    assert decontaminate.find_contamination(odd, _bench(spark), text="t.x").count() == 6
    labels = odd.select("`i.d`", F.lit(1).alias("y.y"))
    assert toxicity.score(odd, toxicity.fit(odd, labels, F.lit(True), id_col="i.d", text="t.x", label="y.y"), text="t.x").count() == 6

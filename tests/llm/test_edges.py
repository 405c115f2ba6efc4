"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import pytest
from pyspark.sql import functions as F

from clicklens.llm import bpe, decontaminate, pii, quality, secret_scan, shards, simhash, substrings, toxicity, urls
from clicklens.llm import queries as Q
from tests.llm import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, items string, pii string, score string, host string"
PASSAGE = " ".join(f"word{i}" for i in range(30))
LONG = " ".join(f"tok{i % 5000}x{i % 7}" for i in range(60_000))
TEXTS = [
    (1, PASSAGE), (2, "before " + PASSAGE + " after"), (2, "before " + PASSAGE + " after"), (3, None), (4, ""), (5, " \n\t "),
    (6, LONG), (7, LONG + " end"), (None, PASSAGE), (None, None), (8, PASSAGE.upper()), (9, "a b c"), (10, "a b c"),
    (11, "one\x0btwo\x0cthree é ñ 漢字 <|endoftext|> don't 12345"), (12, PASSAGE + "\n" + PASSAGE),
    (13, "mail a.b@c.d.e, x@y, 1.2.3.4 1.2.3.4.5 999.1.1.1 +1 (017) 555-7713 4111 1111 1111 1111 0000000000000000000000"),
    (14, "iban GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33; ssn 078-05-1120, 078-05-1121"),
    (15, "a@b.c_d@e.f +12 34.56.78.90.12 5105-1051-0510-5100 12 34"), (16, "x" * 1500), (17, "1" * 1500), (18, "a." * 750),
    (19, 'token = "1eb9c654e721b4f812088970e66a6345cee33dd6" and 4785380592391139'), (20, "l\nl\nl \nm\n\n\nm x"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "a/b", 1, 7, "x", "y", "z", "h") for i, t in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(t):
    return (t is None, t or "")


def test_substrings(spark, docs, none):
    # a null id lies above all others, in the order of the texts' hashes
    h = {r.text: r.h for r in docs.select("text", F.pmod(F.xxhash64("text"), F.lit(1 << 61)).alias("h")).collect()}
    order = [(i if i is not None else (1 << 63) - 1 - h[t], t) for i, t in TEXTS]
    want = sorted(zip([i for i, _ in TEXTS], brute.removed(order)), key=repr)
    for shard in (substrings.SHARD, 1):
        got = substrings.remove_repeats(docs, shard=shard).collect()
        gone = [sum(s.end - s.start for s in r.removed) for r in got]
        assert sorted([(r.id, (r.n_words, g, r.kept)) for r, g in zip(got, gone)], key=repr) == want
    assert substrings.remove_repeats(none).count() == 0


def test_popular_anchors_give_the_same_result(spark):
    rows = [(i, f"own{i} begin{i} " + PASSAGE + f" end{i} " + " ".join(f"w{i}x{j}" for j in range(20))) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = {i: w for (i, _), w in zip(rows, brute.removed(rows))}
    for shard in (substrings.SHARD, 5):
        got = substrings.remove_repeats(df, shard=shard).collect()
        assert {r.id: (r.n_words, sum(s.end - s.start for s in r.removed), r.kept) for r in got} == want


def test_suffix_automaton_statistics():
    import random
    rng = random.Random(5)
    for _ in range(200):
        seqs = [[rng.choice("abc") for _ in range(rng.randrange(1, 12))] for _ in range(4)]
        sam = substrings.SuffixAutomaton()
        for s in seqs[:-1]:
            sam.add(s)
        runs = {tuple(s[i:j]) for s in seqs[:-1] for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        q = seqs[-1]
        assert sam.statistics(q) == [max((n for n in range(e + 2) if n == 0 or tuple(q[e + 1 - n:e + 1]) in runs)) for e in range(len(q))]


def test_simhash(spark, docs, none):
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(TEXTS)
    prints = [brute.fingerprint(t) for _, t in TEXTS]
    roots = brute.components(prints)
    least = {}
    for (i, _), r in zip(TEXTS, roots):
        if i is not None:
            least[r] = min(least.get(r, i), i)
    want = sorted(((i, p, least.get(r)) for (i, _), p, r in zip(TEXTS, prints, roots)), key=repr)
    assert sorted(((r.id, r.fp % (1 << 64), r.component_id) for r in got), key=repr) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    assert simhash.near_duplicates(none).count() == 0 and simhash.keep_one(none).count() == 0


@pytest.mark.parametrize("bucket", [1, 3, 16])
@pytest.mark.parametrize("distance", [0, 1, 2])
def test_links_are_all_found(spark, bucket, distance):
    import random
    rng = random.Random(distance)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 4))) for b in base for _ in range(12)}
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    from clicklens.llm.links import components
    edges = simhash.link_edges(df, distance, bucket)
    root = {r.node % (1 << 64): r.root for r in components(edges).collect()}
    names = sorted(prints)
    group = {p: p for p in names}
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(names):
            for b in names[:i]:
                if (a ^ b).bit_count() <= distance and group[a] != group[b]:
                    group[a] = group[b] = min(group[a], group[b])
                    changed = True
    for a in names:
        for b in names:
            assert (group[a] == group[b]) == (a == b or (a in root and root.get(a) == root.get(b)))


def test_golay_is_perfect():
    import numpy as np
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000)
    code = simhash.golay_index(words)
    # one-bit neighbours share a near index
    near = simhash.near_indices(words)
    assert (near[:, 0] == code).all() and max(len(set(n)) for n in near.tolist()) <= 6
    for bit in range(23):
        other = simhash.near_indices(words ^ (1 << bit))
        assert all(set(a) & set(b) for a, b in zip(near[:200].tolist(), other[:200].tolist()))


def test_decontaminate(spark, docs, none):
    items = [(1, PASSAGE), (2, "a b C!"), (2, "a b C!"), (3, None), (4, ""), (None, "one two"), (5, "..."), (10, "tok1x1 tok2x2")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((repr(i), *brute.contamination(t, items)) for i, t in TEXTS)
    for most in (decontaminate.MAX_WINDOWS, 3):
        got = decontaminate.find_contamination(docs, bench, max_windows=most)
        rows = got.select("doc_id", "n_words", decontaminate.hit_words("hit_spans").alias("n"), "items").collect()
        assert sorted((repr(r[0]), r[1], r[2], r[3]) for r in rows) == want
    kept = decontaminate.drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(not (h and 20 * h >= w) for _, w, h, _ in want)
    assert decontaminate.find_contamination(none, bench).count() == 0
    assert decontaminate.find_contamination(docs, bench.limit(0)).where("size(items) > 0").count() == 0
    cut = {r.text for r in decontaminate.cut_contamination(docs, bench).where("doc_id = 2").collect()}
    assert cut == {"before after"}


def test_pii(spark, docs, none):
    got = {}
    for r in pii.find_pii(docs).collect():
        got.setdefault((r.doc_id, r.text), []).append([(s.kind, s.start, s.end) for s in r.pii])
    for i, t in TEXTS:
        for spans in got[(i, t)]:
            assert [s for s in spans if s[0] in pii.BASE] == brute.base_spans(t)
    text = TEXTS[16][1]
    extra = [(k, text[a:z]) for k, a, z in got[(14, text)][0] if k not in pii.BASE]
    assert ("iban", "GB82 WEST 1234 5698 7654 32") in extra and not any(v.endswith("33") for _, v in extra)
    red = {r.doc_id: r.text for r in pii.redact(docs).where("doc_id in (1, 13, 14)").collect()}
    assert red[1] == PASSAGE and "[EMAIL]" in red[13] and "[IP]" in red[13] and "[IBAN]" in red[14]
    assert pii.redact(docs).columns == docs.columns and pii.find_pii(none).count() == 0


CONTEXT = [
    ("call me: 017-555-7713 today", [("local_phone", "017-555-7713", 0.6)]), ("version 017-555-7713 of it", []),
    ("tel (017) 555-7713", [("local_phone", "(017) 555-7713", 0.6)]), ("call 1.2.3.4", [("ip", "1.2.3.4", 0.6)]),
    ("card 4222 2222 2222 2", [("short_card", "4222 2222 2222 2", 0.6)]), ("part 4222222222222", []), ("card 4222222222223", []),
    ("write to jane.doe (at) example (dot) org", [("spaced_email", "jane.doe (at) example (dot) org", 0.6)]),
    ("mail jane @ example . org", [("spaced_email", "jane @ example . org", 0.6)]), ("jane @ example . org", []),
    ("contact a@b.org", [("email", "a@b.org", 0.9)]), ("see a@b.org", [("email", "a@b.org", 0.7)]),
    ("ssn 078-05-1120", [("ssn", "078-05-1120", 0.6)]), ("no 078-05-1120", []),
]


def test_context_words_decide_weaker_kinds(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CONTEXT)], "doc_id long, text string")
    found = {r.doc_id: [(s.kind, s.value, round(s.score, 1)) for s in r.pii] for r in pii.find_pii(docs).collect()}
    assert [found[i] for i in range(len(CONTEXT))] == [want for _, want in CONTEXT]


def test_many_matches_in_one_text(spark):
    text = " ".join(f"u{i}@h.org" for i in range(1000))
    (row,) = pii.find_pii(spark.createDataFrame([(text,)], "text string")).collect()
    assert [(s.kind, s.start, s.end) for s in row.pii] == brute.base_spans(text)


def test_quality(spark, docs, none):
    got = sorted(((repr(r.doc_id), *r[1:3], r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()))
    assert got == sorted((repr(i), *brute.quality(t)) for i, t in TEXTS)
    assert quality.judge(none).count() == 0


def test_estimates_equal_the_plain_form():
    import random
    rng = random.Random(6)
    for n in (1, 3, 40):
        counts = list({tuple(rng.choice((1, 1, 0, -1)) for _ in range(5)): rng.randint(1, 50) for _ in range(n)}.items())
        base, weights = quality.estimate(counts)
        plain, plain_weights = brute.weighed(counts)
        assert abs(base - plain) < 1e-6 and all(abs(a[v] - b[v]) < 1e-6 for a, b in zip(weights, plain_weights) for v in a)
    assert quality.estimate([]) == (0.0, [])


def test_bpe(spark, docs, none):
    from tokenizers import Tokenizer
    vocab = Q.vocabulary()
    tok = Tokenizer.from_file(vocab)
    tok.no_truncation(), tok.no_padding()
    want = sorted((repr(i), (ids := tok.encode(t or "", add_special_tokens=False).ids), tok.decode(ids, skip_special_tokens=False))
                  for i, t in TEXTS)
    for size in (bpe.CHUNK, 16):
        got = bpe.encode_documents(docs, vocab, ("n_tokens", "ids", "decoded"), size=size).collect()
        assert sorted((repr(r.doc_id), r.ids, r.decoded) for r in got) == want and all(r.n_tokens == len(r.ids) for r in got)
    assert bpe.encode_documents(none, vocab).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_joins_are_repaired_whatever_the_cuts(name):
    """Cuts inside words and between blanks: the ids are those of the whole text."""
    import random

    import numpy as np
    rng = random.Random(3)
    text = " ".join(rng.choice(["don't", "hello", "  wide", "123", "naïve", "end.\n", "été"]) for _ in range(120)).encode()
    encoder = bpe.ChunkEncoder(Q.vocabulary(name))
    for _ in range(60):
        at = sorted(i for i in rng.sample(range(1, len(text)), 4) if text[i] & 0xC0 != 0x80)
        parts = [text[a:z] for a, z in zip([0, *at], [*at, len(text)])]
        (ids,) = encoder.encode([parts])
        assert np.frombuffer(ids, dtype="<u4").tolist() == encoder.tok.encode(text.decode(), add_special_tokens=False).ids


def test_toxicity(spark, docs, none):
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(1, 15)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    out = toxicity.score(docs, model).collect()
    assert len(out) == len(TEXTS) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    blank = toxicity.fit(docs, labels.limit(0), F.lit(True))
    assert all(r.score < 1e-20 for r in toxicity.score(docs, blank).collect())
    assert toxicity.score(none, model).count() == 0 and toxicity.drop_toxic(docs, blank).columns == docs.columns
    assert toxicity.fit(none, labels, F.lit(True)).bias < 0


def test_nnpu_finds_the_marked_words(spark):
    rows = [(i, " ".join(["plain"] * (i % 5) + [f"w{i * 7 % 50}", f"v{i % 31}", *(["vilebad"] if i % 10 == 0 else [])])) for i in range(2000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = df.where("doc_id < 1000").select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    out = toxicity.score(df, toxicity.fit(df, labels, F.lit(True))).where("doc_id >= 1000").collect()
    assert all(r.predicted == (r.doc_id % 10 == 0) for r in out)


def test_shards(spark, docs, none):
    out = shards.shard_rows(docs, 4, ["doc_id"], seed=1).collect()
    assert len(out) == len(TEXTS)
    assert sorted(r.row_number for r in out) == list(range(len(TEXTS)))
    by = [sorted(r.slot for r in out if r.shard == s) for s in range(4)]
    assert all(s == list(range(len(s))) for s in by) and max(map(len, by)) - min(map(len, by)) <= 1
    again = shards.shard_rows(docs.repartition(7), 4, ["doc_id"], seed=1).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))
    assert shards.shard_rows(none, 4, ["doc_id"]).count() == 0
    same = spark.range(25_000).select(F.lit(1).alias("doc_id"))
    assert shards.shard_rows(same, 3, ["doc_id"]).agg(F.countDistinct("row_number"), F.max("slot")).first()[:] == (25_000, 8333)


def test_urls(spark):
    given = [(1, "HTTP://WWW.Example.COM/en/x?q#f"), (2, None), (3, "no scheme"), (4, "http://net"), (4, "http://net"), (5, "x://a.b.net/fr/"),
             (None, "x://a..com/"), (6, "://"), (7, "a://b://c.com/en/"), (8, "http://example.com/EN/"), (9, "http://xexample.com/en/"), (10, "")]
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in given], "page_id long, url string, host string, verdict string")
    for rules in (Q.URL_RULES, [("block", "com", "/e"), ("allow", "example.com", "/en"), ("block", "example.com", "/en")], []):
        table = spark.createDataFrame(list(rules), "action string, host string, path string")
        for most in (100, 0):
            out = urls.apply_rules(df, table, max_rules=most).collect()
            assert sorted((repr(r.page_id), r.host, r.path, r.rule, r.verdict) for r in out) == sorted(
                ((repr(i), *brute.url_rule(u, rules)) for i, u in given), key=lambda x: (x[0], x[1], x[2], x[3] or "", x[4]))


def test_secrets(spark, docs, none):
    out = secret_scan.scan(docs)
    rows = out.collect()
    texts = {}
    for i, t in TEXTS:
        texts.setdefault(i, []).append(t)
    assert rows and all(any((t or "")[r.start:r.end] == r.value for t in texts[r.id]) for r in rows)
    one_class = spark.createDataFrame([(19, 9, 1)], "id long, start int, label int")
    assert {r.score for r in secret_scan.scan(docs, one_class).collect()} == {1.0}
    assert secret_scan.scan(none).count() == 0
    masked = secret_scan.mask(docs, out)
    assert masked.columns == docs.columns and masked.count() == len(TEXTS)


def _thue_morse(k, a="a", b="b"):
    word, other = a, b
    for _ in range(k):
        word, other = word + other, other + word
    return word, other


def test_words_that_a_polynomial_hash_takes_for_equal_are_kept(spark):
    one, two = _thue_morse(10)
    head, tail = " ".join(f"h{i}" for i in range(20)), " ".join(f"t{i}" for i in range(20))
    rows = [(1, f"{head} {one} {tail}"), (2, f"{head} {two} {tail}"), (3, f"{head} {one} {tail}")]
    from clicklens.llm.words import NOT_BLANK, word_blocks
    import pyarrow as pa
    (block,) = word_blocks(pa.array([f"{one} {two}"]), NOT_BLANK)
    assert len(set(block.hashes().tolist())) == 1       # the hash that routes cannot tell them apart
    want = {i: w for (i, _), w in zip(rows, brute.removed(rows))}
    for shard in (substrings.SHARD, 1):
        got = {r.id: (r.n_words, sum(s.end - s.start for s in r.removed), r.kept) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), shard=shard).collect()}
        assert got == want and got[2][:2] == (41, 40) and got[2][2] == two and got[3][1] == 41


def test_text_ids_have_an_order(spark):
    rows = [("x1", PASSAGE), ("7", PASSAGE), ("x2", PASSAGE + " end")]
    got = {r.id: sum(s.end - s.start for s in r.removed) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"7": 0, "x1": 30, "x2": 30}


def test_a_url_of_many_labels_is_quick(spark):
    import time
    rules = spark.createDataFrame([("block", "b.net", "/"), ("allow", "a.b.net", "/x/")], "action string, host string, path string")
    long = "http://" + "a." * 50_000 + "b.net/x/y"
    pages = spark.createDataFrame([(1, long), (2, "http://net/"), (3, "http://.b.net/x/")], "page_id long, url string")
    urls.apply_rules(pages.limit(1), rules).collect()
    began = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in urls.apply_rules(pages, rules).collect()}
    assert time.time() - began < 8 and got == {1: ("a.b.net/x/", "allow"), 2: (None, "allow"), 3: ("b.net/", "block")}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encode_documents_equals_the_library_for_every_file(spark, name):
    import random

    from tokenizers import Tokenizer
    rng = random.Random(9)
    tok = Tokenizer.from_file(Q.vocabulary(name))
    tok.no_truncation(), tok.no_padding()
    words = ["Hello", "world", "don't", " ", "  ", "\n", "\n\n", "\t", "été", "漢字", "12345", "...", "<|endoftext|>", "x" * 40, "\U0001F600", "A", "\r\n", " "]
    texts = [t for _, t in TEXTS] + ["Hello world", " Hello", "Hello ", "\n", "  \n x"] + [
        "".join(rng.choice(words) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for size in (bpe.CHUNK, 16):
        got = {r.doc_id: (list(r.ids), r.decoded) for r in bpe.encode_documents(docs, Q.vocabulary(name), ("ids", "decoded"), size=size).collect()}
        for i, t in enumerate(texts):
            ids = tok.encode(t or "", add_special_tokens=False).ids
            assert got[i] == (ids, tok.decode(ids, skip_special_tokens=False)), (i, t)

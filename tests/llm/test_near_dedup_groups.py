"""keep_one keeps one document of each group, whatever the groups' ids are."""

from clicklens.llm import simhash
from tests.llm import brute

WORDS = [" ".join(f"{kind}{i}" for i in range(30)) for kind in ("apple", "stone", "river", "cloud")]


def kept(spark, rows):
    assert len(set(brute.components([brute.fingerprint(t) for _, t in rows]))) == len({t for _, t in rows})
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=repr)


def test_unlinked_texts_without_ids_all_stay(spark):
    rows = [(None, WORDS[0]), (None, WORDS[1]), (None, WORDS[1]), (3, WORDS[2])]
    assert kept(spark, rows) == sorted(set(rows), key=repr)


def test_one_id_on_unlinked_texts_keeps_each(spark):
    rows = [(1, WORDS[0]), (1, WORDS[1]), (2, WORDS[1])]
    assert kept(spark, rows) == sorted(rows[:2], key=repr)


def test_a_null_id_gives_way_to_an_id(spark):
    assert kept(spark, [(None, WORDS[3]), (5, WORDS[3])]) == [(5, WORDS[3])]

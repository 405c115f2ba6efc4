"""Secret scans: a random forest removes false positives among proposed secrets.

Built-in functions and Spark ML only. Proposed is, from left to right (``PROPOSAL``):

* the value behind a secret-like name, with or without an assignment sign and quotes: characters up to a blank, a quote,
  a bracket, ``,``, ``;`` or ``&``, without the punctuation that ends it (``API_KEY=...``, ``password = P@ss.w0rd``);
* the run of ``[A-Za-z0-9+/_-]`` right behind another assignment sign (and a quote);
* any other run of 16 or more characters with a digit; runs of eight or more behind it that dots join belong to it.

Runs may end in up to two ``=`` of padding. Features of a proposal: its length, character transitions (changes between
lower case, upper case, digits and signs), shares of digits, hexadecimal and upper-case characters, distinct characters,
how much of it words of a dictionary cover, its path (depth, test or example folders) and the words beside it: an
assignment sign, quotes, how much of the 40 characters before are signs or digits, the length of the word before.

The forest is trained from labelled findings (``id``, ``start``, ``label`` 1 secret / 0 not), at most about
``max_train`` of them, chosen by hash; they are sorted into one partition so that training repeats exactly. Scores are
cross-fitted: proposals fall into two halves by the hash of their value, and each half is scored by the forest trained
on the other one, so no score comes from a label of the same value. Where a half lacks a class, one forest of all
labels scores all. Proposals are few and short; they are checkpointed once and read by training and scoring.

Without reviewed findings, ``label_by_use`` makes labels from facts that the forest does not read: the names beside a
value, and checks of the value itself (Luhn, uuid).

Defined cases: null and empty texts have no proposals; a null path has depth 0; given labels that name no proposal
are counted in a warning (``unmet``), and an error if none does; repeated rows give repeated findings; when the labelled
findings lack one of the classes a warning says so and nothing is removed (score 1); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import warnings

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import Own, quoted
from clicklens.llm.lineage import chosen, cut
from clicklens.llm.pii import luhn, match_ends

SECRET_NAMES = "key|token|secret|passw|pwd|auth|credential|bearer|signature"
RUN = r"A-Za-z0-9+/_\-"
PAD = r"(?:={1,2}+(?![A-Za-z0-9+/_\-=\"'`]))?"
# A proposal is the end of a match: what stands before the value is matched along, so that no position looks back far.
NAMED = rf"(?i:{SECRET_NAMES})[A-Za-z0-9_\-]{{0,24}}[\"'`]?(?:[\x20\t]{{0,4}}[=:]>?[\x20\t]{{0,4}}|[\x20\t]{{1,4}})[\"'`]?"
SIGNED = r"[=:]>?[\x20\t]{0,4}[\"'`]?"
ANY = r"[^\x00-\x20\"'`<>(){}\[\],;&]*[^\x00-\x20\"'`<>(){}\[\],;&.!?:=]={0,2}"
SHORT = rf"[{RUN}]++{PAD}"
DOTTED = rf"[{RUN}]++(?:\.[{RUN}]{{8,}}+)*+{PAD}"
LONG = rf"(?<![{RUN}])(?=[{RUN}]{{16}})(?=[A-Za-z+/_\-]*+[0-9]){DOTTED}"
PROPOSAL = rf"(?:{NAMED})(?:{ANY})|(?:{SIGNED})(?:{SHORT})|{LONG}"
VALUES = rf"^(?:(?:{NAMED})({ANY})|(?:{SIGNED})({SHORT})|({DOTTED}))$"
ASSIGNED = r"[=:]>?\s*[\"'`]?$"
LONG_VALUE = r"^(?=.{16})[^0-9]*[0-9]"
# Words that names and placeholders are made of (a stated default; pass another list as ``dictionary``).
DICTIONARY = ("account", "admin", "api", "auth", "bucket", "class", "client", "cluster", "config", "data", "default", "demo",
              "dev", "dummy", "example", "file", "function", "group", "host", "id", "image", "index", "item", "key", "local",
              "mail", "main", "model", "module", "name", "node", "page", "path", "prod", "project", "public", "request",
              "sample", "section", "server", "service", "session", "string", "system", "table", "test", "time", "user", "value",
              "version", "your")
FEATURES = ("length", "transitions", "digits", "hex", "upper", "distinct_chars", "dictionary", "path_depth", "path_test",
            "assigned", "quoted", "signs_before", "digits_before", "word_before")


def proposals(docs: DataFrame, id_col: str = "doc_id", text: str = "text", path: str = "source") -> DataFrame:
    """(id, path, start, end, value, before, after): every proposed secret with the 40 characters before it,
    other proposals included, and up to 40 after it."""
    t = F.col(quoted(text))
    df = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(path)).cast("string").alias("path"), t.alias("t"),
                     F.regexp_extract_all(t, F.lit(PROPOSAL), F.lit(0)).alias("w")).where("size(w) > 0")
    value = lambda w: F.concat(*[F.regexp_extract(w, VALUES, k) for k in (1, 2, 3)])
    df = df.select("id", "path", "w", F.transform("w", value).alias("m"), F.split("t", PROPOSAL, -1).alias("g"))
    df = df.select("id", "path", "w", "m", "g", match_ends(F.col("g"), F.col("w")).alias("e"))
    last = lambda x: F.substr(x, F.greatest(F.lit(1), F.length(x) - 39))
    # a stretch and its match: one character at least
    df = df.withColumn("p", F.zip_with(F.slice("g", 1, F.size("w")), "w", lambda g, w: last(F.concat(last(g), last(w)))))
    lead = lambda v, i: F.substr(F.get("w", i), F.lit(1), F.length(F.get("w", i)) - F.length(v))
    before = lambda v, i: last(F.concat(F.array_join(F.slice("p", F.greatest(F.lit(1), i - 39), F.least(i, F.lit(40))), ""),
                                        last(F.get("g", i)), lead(v, i)))
    found = F.transform("m", lambda v, i: F.struct(
        (F.get("e", i) - F.length(v)).cast("int").alias("start"), F.get("e", i).cast("int").alias("end"), v.alias("value"),
        before(v, i).alias("before"), F.substring(F.get("g", i + 1), 1, 40).alias("after")))
    return df.select("id", "path", F.inline(found))


def features(found: DataFrame, dictionary=DICTIONARY) -> DataFrame:
    """``found`` with one double column per name in ``FEATURES``, and ``named``: does a secret-like name stand before it?"""
    v, before = F.col("value"), F.coalesce("before", F.lit(""))
    size = F.length(v).cast("double")
    share = lambda pattern: F.length(F.regexp_replace(v, pattern, "")) / size
    shape = v
    for chars, one in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), (r"[^A-Za-z0-9]+", "-")):
        shape = F.regexp_replace(shape, chars, one)
    words = "|".join(sorted(dictionary, key=lambda w: (-len(w), w)))
    p = F.lower(F.coalesce("path", F.lit("")))
    around = F.greatest(F.length(before), F.lit(1))
    beside = lambda pattern: F.length(F.regexp_replace(before, pattern, "")) / around
    made = {
        "length": size, "transitions": (F.length(shape) - 1) / size, "digits": share("[^0-9]+"), "hex": share("[^0-9a-fA-F]+"),
        "upper": share("[^A-Z]+"), "distinct_chars": F.size(F.array_distinct(F.split(v, ""))) / size,
        "dictionary": 1 - F.length(F.regexp_replace(F.lower(v), words, "")) / size,
        "path_depth": F.size(F.filter(F.split(p, "/"), lambda x: x != "")), "path_test": p.rlike("test|example|sample|mock|doc"),
        "assigned": before.rlike(ASSIGNED), "quoted": before.rlike("[\"']$") & F.col("after").rlike("^[\"']"),
        "signs_before": beside(r"[A-Za-z0-9\x20\n]+"), "digits_before": beside("[^0-9]+"),
        "word_before": F.length(F.regexp_extract(before, r"([A-Za-z]+)[^A-Za-z]*$", 1)),
        "named": F.lower(before).rlike(rf"(?:{SECRET_NAMES})[^\n]{{0,30}}$")}
    return found.select(*found.columns, *[c.cast("double").alias(n) for n, c in made.items()])


def label_by_use(found: DataFrame) -> DataFrame:
    """Labelled findings for tables without reviewed ones: (id, start, label).

    Labelled 1 is a value that a secret-like name is assigned, quoted or not, unless it fails the checks below. Labelled
    0 are uuids and numbers that pass the Luhn check, commit names (40 hexadecimal characters behind the word commit,
    revision or sha), and, where no secret-like name stands beside, values that nothing is assigned to and values that
    are short or without a digit; beside a name, a plain word of prose without an assignment, and names or placeholders
    (letters alone that words of the dictionary cover). Others have no label. The forest reads none of these names and
    checks.
    """
    before, v = F.lower("before"), F.col("value")
    given = before.rlike(rf"(?:{SECRET_NAMES})[\w\-]*[\"'`]?\s*[=:]>?\s*[\"'`]?$")
    beside = before.rlike(rf"(?:{SECRET_NAMES})[\w\-]*[\"'`]?\s*(?:[=:]>?)?\s*[\"'`]?$")
    free = ~before.rlike(ASSIGNED)
    words = "|".join(sorted(DICTIONARY, key=lambda w: (-len(w), w)))
    number = v.rlike("^[0-9]{8,}$") & luhn(F.regexp_replace("value", "[^0-9]", ""))
    uuid = v.rlike("^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$")
    commit = v.rlike("^[0-9a-fA-F]{40}$") & before.rlike(r"(?:commit|revision|sha)\W{1,3}$")
    placeholder = v.rlike("^[A-Za-z_\\-]+$") & (F.regexp_replace(F.lower(v), rf"{words}|password|passwd|{SECRET_NAMES}|[_\-]", "") == "")
    no = (uuid | commit | (~beside & (number | free | ~v.rlike(LONG_VALUE))) | (beside & free & v.rlike("^[A-Z]?[a-z]+$")) | (given & placeholder))
    return found.select("id", "start", F.when(no, 0).when(given, 1).alias("label")).where("label is not null")


def unmet(found: DataFrame, labels: DataFrame) -> int:
    """How many distinct labelled findings (id, start) name no proposal."""
    named = found.select(F.col("id").alias("_id"), F.col("start").alias("_start"))
    left = labels.select("id", "start").distinct()
    return left.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("start") == F.col("_start")), "left_anti").count()


def _half() -> Column:
    """0 or 1 by the hash of the value."""
    return F.pmod(F.xxhash64(F.lit("half"), F.col("value")), F.lit(2))


def _forest(train: DataFrame, trees: int, depth: int, seed: int):
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="_f")
    forest = RandomForestClassifier(featuresCol="_f", labelCol="label", probabilityCol="_p", rawPredictionCol="_r",
                                    predictionCol="_c", numTrees=trees, maxDepth=depth, seed=seed)
    model = forest.fit(assemble.transform(train))
    return lambda df: model.transform(assemble.transform(df)).withColumn("score", vector_to_array(F.col("_p"))[1]).drop("_f", "_p", "_r", "_c")


def _labelled(found: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("id").alias("_id"), F.col("start").alias("_start"), F.col("label").cast("double").alias("label")).distinct()
    known = found.join(named, F.col("id").eqNullSafe(F.col("_id")) & (F.col("start") == F.col("_start")))
    return known.select("id", "start", "value", "label", *FEATURES)


def cross_scored(found: DataFrame, known: DataFrame, trees: int = 40, depth: int = 6, seed: int = 7) -> DataFrame:
    """``found`` with ``score``: each half by the forest of the labels ``known`` in the other half."""
    known = known.withColumn("_half", _half()).repartition(1).sortWithinPartitions("id", "start", "value", "label")
    classes = {(r[0], r[1]) for r in known.select("_half", "label").distinct().collect()}
    if len(classes) < 4:
        return _forest(known, trees, depth, seed)(found)
    halves = [_forest(known.where(F.col("_half") == 1 - k), trees, depth, seed)(found.where(_half() == k)) for k in (0, 1)]
    return halves[0].unionByName(halves[1])


def held_out(found: DataFrame, labels: DataFrame, form: Column, **kw) -> DataFrame:
    """(form, precision, recall, n): how the cross-fitted scores of the labelled proposals agree with their labels, by ``form`` (of the value)."""
    known = _labelled(found, labels)
    scored = cross_scored(known, known, **kw).withColumn("form", form)
    hit, real = F.col("score") >= 0.5, F.col("label") == 1
    return scored.groupBy("form").agg((F.count_if(hit & real) / F.nullif(F.count_if(hit), F.lit(0))).alias("precision"),
                                      (F.count_if(hit & real) / F.nullif(F.count_if(real), F.lit(0))).alias("recall"),
                                      F.count(F.lit(1)).alias("n"))


def scan(docs: DataFrame, labelled=None, id_col: str = "doc_id", text: str = "text", path: str = "source",
         max_train: int = 20_000, trees: int = 40, depth: int = 6, seed: int = 7) -> DataFrame:
    """(id, path, start, end, value, score, secret) of every proposal; ``secret`` from a score of 0.5.

    ``labelled`` is a table (id, start, label), or a function that makes it from the proposals; without one,
    ``label_by_use``.
    """
    found = cut(features(proposals(docs, id_col, text, path)))
    labels = labelled if isinstance(labelled, DataFrame) else (labelled or label_by_use)(found)
    known = _labelled(found, labels)
    sizes = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    if isinstance(labelled, DataFrame) and (lost := unmet(found, labels)):
        if not sizes and not found.isEmpty():
            raise ValueError(f"none of the {lost} labelled findings names a proposal")
        warnings.warn(f"{lost} labelled findings name no proposal", stacklevel=2)
    train = known.where(chosen(F.xxhash64("id", "start", "value"), max_train, sum(sizes.values())))
    classes = {r[0] for r in train.select("label").distinct().collect()}
    if classes != set(sizes):
        raise ValueError(f"the sample of about {max_train} of the labelled findings lacks a class: {sizes}")
    keep = ["id", "path", "start", "end", "value"]
    if classes != {0.0, 1.0}:
        if not found.isEmpty():
            warnings.warn(f"the labelled findings have one class at most ({sizes}): every proposal stays", stacklevel=2)
        return found.select(*keep, F.lit(1.0).alias("score"), F.lit(True).alias("secret"))
    scored = cross_scored(found, train, trees, depth, seed)
    return scored.select(*keep, "score", (F.col("score") >= 0.5).alias("secret"))


def mask(docs: DataFrame, findings: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the values found to be secrets replaced by ``[SECRET]`` wherever they stand in that document;
    those of under 16 characters where they stand as whole runs."""
    values = (findings.where("secret").groupBy(F.col("id").alias("_id")).agg(F.array_sort(F.collect_set("value")).alias("_values")))
    own = Own(docs)
    joined = own.df.join(values, own.df[own.key[id_col]].eqNullSafe(F.col("_id")), "left")
    whole = lambda v: F.concat(F.lit(rf"(?<![{RUN}])\Q"), v, F.lit(rf"\E(?![{RUN}])"))
    new: Column = F.aggregate(F.coalesce("_values", F.array().cast("array<string>")), F.col(own.key[text]), lambda acc, v: F.when(
        F.length(v) < 16, F.regexp_replace(acc, whole(v), F.lit("[SECRET]"))).otherwise(F.replace(acc, v, F.lit("[SECRET]"))))
    return joined.select(*own.back(**{text: new}))

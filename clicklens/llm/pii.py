"""Personal data: regular expressions propose spans, checksums confirm them, nearby context words adjust the score.

Built-in functions only. A kind's matches are those of ``regexp_extract_all``; their places follow from the
lengths of the stretches between them (``split`` by the same expression), in code points, end exclusive.

Base kinds (always reported when their check holds): ``email``, ``ip`` (four parts, each at most 255), ``card``
(14 to 19 digits, Luhn), ``phone`` (10 to 15 digits). Added kinds: ``iban`` (mod-97 check), and four weaker ones that
are reported only beside a context word: ``ssn`` (3-2-4 digits), ``local_phone`` (three groups of digits without a
country), ``short_card`` (12 or 13 digits, Luhn) and ``spaced_email``. A span's score is its
kind's base score plus 0.2 where one of the kind's context words stands within 40 characters, in the text
between its neighbours of the same kind; spans from a score of 0.5 are reported, so for the weaker kinds the context
decides, and for the others it says how sure a span is.

The expressions give the same matches as the plain ones in the comments beside them, but take time in
proportion to the text: possessive loops, and a start only where a run of the first class begins or the last
match ended.

Defined cases: a null or empty text has no spans; spans of different kinds may overlap; repeated rows are
rows like any other; an empty table gives an empty result; extra columns are carried, but for ``pii``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicklens.llm.columns import Own

_LOCAL = r"A-Za-z0-9._%+\-"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    hint: str        # cheap expression that any match satisfies
    base: float
    context: str


# In the order in which they are listed.
KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    Kind("email", rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9\-]++(?:\.[A-Za-z0-9\-]++)++", "@[A-Za-z0-9\\-]", 0.7,
         "mail|contact|write"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, "ip|address|host|server"),
    # [0-9]([\x20-]?[0-9])+
    Kind("card", r"[0-9](?:[\x20\-]?[0-9])++", r"[0-9][\x20\-]?[0-9][\x20\-]?[0-9][\x20\-]?[0-9]", 0.7,
         "card|visa|credit|payment"),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9\-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobile"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", 0.6, "iban|account|bank"),
    Kind("ssn", r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])", r"[0-9]-[0-9]{2}-[0-9]", 0.4,
         "ssn|social security|tax id"),
    # three groups of digits without a country, such as (017) 555-7713 or 017.555.7713
    Kind("local_phone", r"(?<![0-9+.\-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.\-])[0-9]{3,4}[\x20.\-][0-9]{3,4}(?![0-9.\-]*[0-9])",
         r"[0-9]\)?[\x20.\-]?[0-9]{3}", 0.4, "phone|call|tel|mobile|fax"),
    # 12 or 13 digits, in groups or not
    Kind("short_card", r"(?<![0-9\-])(?:[0-9][\x20\-]?){11,12}[0-9](?![\x20\-]?[0-9])", r"[0-9][\x20\-]?[0-9][\x20\-]?[0-9][\x20\-]?[0-9]", 0.4,
         "card|visa|credit|payment"),
    # name (at) host (dot) org, name @ host . org
    Kind("spaced_email", rf"(?<![{_LOCAL}])[{_LOCAL}]{{1,64}}+(?:\x20@\x20|\x20?[(\[]at[)\]]\x20?)[A-Za-z0-9\-]++"
         r"(?:(?:\x20\.\x20|\x20?[(\[]dot[)\]]\x20?|\.)[A-Za-z0-9\-]++)++", r"\x20@\x20|[(\[]at[)\]]", 0.4, "mail|contact|write"),
)
BASE = ("email", "ip", "card", "phone")
THRESHOLD = 0.5
NEAR = 40
SPAN = "array<struct<start:int,rank:int,end:int,kind:string,value:string,score:double>>"
_GROUP = 256


def luhn(digits: Column) -> Column:
    """Does a string of digits pass the Luhn check?"""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), d.cast("int") + 1)
    ).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda acc, d: acc + d) % 10 == 0


def mod97(code: Column) -> Column:
    """Does an IBAN without blanks pass its mod-97 check?"""
    moved = F.split(F.concat(F.substr(code, F.lit(5)), F.substring(code, 1, 4)), "")
    rest = F.aggregate(moved, F.lit(0), lambda acc, c: F.when(
        c.between("0", "9"), (acc * 10 + (F.ascii(c) - 48)) % 97).otherwise((acc * 100 + (F.ascii(c) - 55)) % 97))
    return rest == 1


def _confirmed(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return ~value.rlike(r"(?:^|\.)0*(?:[1-9][0-9]{3,}|[3-9][0-9]{2}|2[6-9][0-9]|25[6-9])(?:\.|$)")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(False)
    if kind == "short_card":
        return luhn(digits)
    if kind == "local_phone":
        return F.length(digits).between(8, 12)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    if kind == "iban":
        plain = F.regexp_replace(value, " ", "")
        return F.when(F.length(plain).between(15, 34), mod97(plain)).otherwise(False)
    return F.lit(True)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body (or a lambda in it) uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(lengths: Column) -> Column:
    """Running sums of an array of ints, in groups so that long arrays stay cheap."""
    def total(xs: Column) -> Column:
        return F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def within(group: Column, before: Column) -> Column:
        return F.transform(group, lambda _, i: before + total(F.slice(group, 1, i + 1)))

    def laid_out(groups: Column) -> Column:
        return let(F.transform(groups, total), lambda totals: F.flatten(F.transform(
            groups, lambda g, k: let(total(F.slice(totals, 1, k)), lambda before: within(g, before)))))

    return let(lengths, lambda xs: let(F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.size(xs) - 1) / _GROUP).cast("int"))),
        lambda g: F.slice(xs, g * _GROUP + 1, _GROUP)), laid_out))


def match_ends(gaps: Column, matches: Column) -> Column:
    """Where each match ends: ``gaps`` are the stretches before, between and after ``matches``."""
    return running(F.zip_with(F.slice(gaps, 1, F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m)))


def _kind_spans(text: Column, rank: int, kind: Kind) -> Column:
    """The confirmed spans of one kind."""
    none = F.array().cast(SPAN)

    def spans(matches: Column, gaps: Column, ends: Column) -> Column:
        def span(value: Column, i: Column) -> Column:
            end, before = F.get(ends, i), F.get(gaps, i)
            near = F.lower(F.concat_ws(" ", F.substr(before, F.greatest(F.lit(1), F.length(before) - NEAR + 1)),
                                       F.substring(F.get(gaps, i + 1), 1, NEAR)))
            score = F.lit(kind.base) + F.when(near.rlike(rf"\b(?:{kind.context})"), 0.2).otherwise(0.0)
            # array_sort compares the fields in this order
            return F.struct((end - F.length(value)).cast("int").alias("start"), F.lit(rank).alias("rank"),
                            end.cast("int").alias("end"), F.lit(kind.name).alias("kind"), value.alias("value"), score.alias("score"))
        return F.filter(F.transform(matches, span), lambda s: _confirmed(kind.name, s["value"]) & (s["score"] >= THRESHOLD))

    placed = let(F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), lambda m: F.when(
        F.size(m) > 0, let(F.split(text, kind.pattern, -1), lambda g: let(match_ends(g, m), lambda e: spans(m, g, e)))).otherwise(none))
    return F.when(text.rlike(kind.hint), placed).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``pii``: its spans (start, rank of the kind, end, kind, value, score) by start, then kind."""
    own = Own(docs, ["pii"])
    t = F.coalesce(F.col(own.key[text]), F.lit(""))
    found = F.concat(*[_kind_spans(t, rank, kind) for rank, kind in enumerate(KINDS)])
    return own.df.select(*own.back(), F.array_sort(found).alias("pii"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data replaced by its kind in brackets; overlapping spans become one."""
    own = Own(docs)
    marked = find_pii(own.df.withColumn("_whole", F.col(own.key[text])), own.key[text])
    t = F.col("_whole")
    # spans by start: a later one that begins inside the run so far only lengthens it
    none = F.array().cast("array<struct<start:int,end:int,kind:string>>")

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"), last["kind"].alias("kind"))
        return F.when((F.size(acc) > 0) & (s["start"] < F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(0))),
                      F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(longer))).otherwise(F.concat(acc, F.array(fresh)))

    runs = F.when(F.size("pii") > 0, F.aggregate("pii", none, merge)).otherwise(none)
    df = marked.select(*own.keys(), "_whole", runs.alias("_runs"))
    parts = F.transform("_runs", lambda s, i: F.concat(
        F.substr(t, F.when(i == 0, 1).otherwise(F.get("_runs", i - 1)["end"] + 1),
                 s["start"] - F.when(i == 0, 0).otherwise(F.get("_runs", i - 1)["end"])),
        F.lit("["), F.upper(s["kind"]), F.lit("]")))
    done = F.concat(F.array_join(parts, ""), F.substr(t, F.element_at("_runs", -1)["end"] + 1))
    new = F.when(F.size("_runs") > 0, done).otherwise(t)
    return df.select(*own.back(**{text: new}))

"""Personal data by weak supervision: labelers vote on candidate spans, and what they agree on trains the span classifier.

Candidates, votes and the classifier's sum are SQL expressions on the row of a document; nothing is shuffled but the counts of
vote patterns.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradewind.llm.label_model import confusions, logistic, posterior
from tradewind.llm.util import text_or_empty

#: Kinds of spans, in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "secret")
#: Patterns of candidates. Quantifiers that never have to give back are possessive, and an address is looked for
#: from the start of a word only (or where the last match ended), so that time is in proportion to the text.
LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "loose phone": r"(?<![0-9+])(?:\([0-9]{3}\)[\x20.-]?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
    "secret": r"\bAKIA[0-9A-Z]{8,}|(?i:\b(?:password|passwd|pwd|token|secret|api[_-]?key)\b\s?[=:]\s?"
              r"(?:\x22[^\x22\n]{4,}+\x22|[0-9a-z+/_-]{4,}))",
}
#: A text without this has no candidate of the kind.
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){11}", "phone": r"\+[0-9]",
         "loose phone": r"[0-9]{3}[\x20.-][0-9]{4}", "secret": r"AKIA|(?i:password|passwd|pwd|token|secret|api[_-]?key)"}
#: Gazetteers and context words.
DOMAINS = ("com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "uk", "eu")
ISSUERS = r"^(4|5[1-5]|2[2-7]|3[47]|6)"
NEAR = {"email": "mail|contact|write|@", "ip": "address|server|host|ip", "card": "card|visa|master|credit|pay",
        "phone": "phone|tel|call|fax|mobile", "secret": "key|login|user|auth|pass|token"}
FAR = "version|release|isbn|license|chapter|section|figure|table|order no"
VOTES = ("form", "check", "gazetteer", "context")
TRAITS = ("short", "long", "spaced", "mixed")
CONTEXT = 24
#: Weight of unseen patterns of votes in training, as a share of the candidates; and the probability from which a span is added.
UNSEEN, SURE = 0.5, 0.7


def _found(text: Column, name: str) -> Column:
    """All matches of a pattern, leftmost first, with code points counted along the parts between them."""
    kind = name.split()[-1]
    parts = F.zip_with(F.split(text, PATTERNS[name], -1), F.regexp_extract_all(text, F.lit(PATTERNS[name]), F.lit(0)),
                       lambda gap, value: F.struct(F.length(gap).alias("gap"), value.alias("value")))
    none = F.array().cast("array<struct<kind:string,form:string,start:int,end:int,value:string>>")

    def step(state: Column, part: Column) -> Column:
        start = state["at"] + part["gap"]
        end = start + F.length(part["value"])
        one = F.struct(F.lit(kind).alias("kind"), F.lit("loose" if name != kind else "base").alias("form"),
                       start.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(F.coalesce(end, start).alias("at"), F.when(
            part["value"].isNotNull(), F.concat(state["out"], F.array(one))).otherwise(state["out"]).alias("out"))

    hint = text.contains(HINTS[name]) if name == "email" else text.rlike(HINTS[name])
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))
    return F.when(hint, F.aggregate(parts, start, step, lambda s: s["out"])).otherwise(none)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(c: Column) -> Column:
    """Checks that a match of a base pattern must pass."""
    part = lambda p: F.regexp_replace(p, "^0+", "")
    in_range = F.forall(F.split(c["value"], r"\."), lambda p: (F.length(part(p)) <= 3)
                        & (F.coalesce(F.when(part(p) == "", F.lit(0)).otherwise(F.substring(part(p), 1, 3).cast("int")), F.lit(0)) <= 255))
    digits = F.length(_digits(c["value"]))
    return (F.when(c["kind"] == "email", F.lit(True)).when(c["kind"] == "ip", in_range)
            .when(c["kind"] == "card", digits.between(12, 19) & F.call_function("luhn_check", F.when(digits <= 19, _digits(c["value"])).otherwise(F.lit("1"))))
            .when(c["kind"] == "phone", digits.between(9, 15)).otherwise(F.lit(False)))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _judged(text: Column, c: Column) -> Column:
    """A candidate with the labelers' votes and its traits."""
    kind, value = c["kind"], c["value"]
    before = F.lower(F.substring(text, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT))))
    after = F.lower(F.substring(text, c["end"] + 1, CONTEXT))
    around = F.concat(before, F.lit(" "), after)
    near = reduce(lambda a, k: a.when(kind == k, around.rlike(NEAR[k])), KINDS, F)
    letters, digits = value.rlike("[A-Za-z]"), value.rlike("[0-9]")
    base = (c["form"] == "base") & (kind != "secret")
    valid = _valid(c)
    body = F.when(kind == "secret", F.regexp_replace(value, r"(?i)^([a-z_-]+\s?[=:]\s?)", "")).otherwise(value)
    quoted, key = body.startswith('"'), value.startswith("AKIA")
    plain_word = body.rlike(r"^\x22?[A-Za-z_-]+\x22?$") & ~key
    # How a span is written, whatever its digits: usual groups, labels of letters, parts without leading zeros.
    usual = (F.when(kind == "email", value.rlike(r"\.[A-Za-z]{2,}$"))
             .when(kind == "ip", value.rlike(r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$"))
             .when(kind == "card", value.rlike(r"^([0-9]{4}([\x20-])[0-9]{4}\2[0-9]{4}\2[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\3[0-9]{5})$"))
             .when(kind == "phone", value.rlike(r"^(\+|\()")).otherwise(quoted & ~plain_word | key | (F.length(body) >= 12) & ~plain_word))
    odd = (F.when(kind == "card", value.rlike(r"[\x20-]") | (F.length(value) > 16)).when(kind == "phone", F.lit(False))
           .when(kind == "secret", plain_word).otherwise(F.lit(True)))
    listed = (F.when(kind == "email", F.lower(F.substring_index(value, ".", -1)).isin(*DOMAINS))
              .when(kind == "card", _digits(value).rlike(ISSUERS)).when(kind == "phone", value.contains("555") | value.startswith("+")))
    listed_vote = F.when(kind == "secret", _vote(key, plain_word)).otherwise(_vote(listed, ~listed))
    check = F.when(kind == "secret", body.rlike("[0-9]") & body.rlike("[A-Za-z]")).otherwise(valid)
    return F.struct(
        kind.alias("kind"), c["start"].alias("start"), c["end"].alias("end"), (base & valid).alias("base"),
        _vote(usual, odd).alias("form"), _vote(check, ~check).alias("check"), listed_vote.alias("gazetteer"),
        # A number that its context calls something else is that, also with a telling word further away.
        F.when(before.rlike(FAR), -1).when(near, 1).otherwise(0).alias("context"),
        (F.length(value) < 10).cast("int").alias("short"), (F.length(value) > 22).cast("int").alias("long"),
        value.contains(" ").cast("int").alias("spaced"), (letters & digits).cast("int").alias("mixed"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ``_c``: candidate spans of all kinds, with votes and traits."""
    text = text_or_empty()
    found = docs.withColumn("_c", F.concat(*[_found(text, name) for name in PATTERNS]))
    return found.withColumn("_c", F.transform("_c", lambda c: _judged(text, c)))


def counted(docs: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each kind the patterns of votes, the traits with them, and how many candidates have both.

    What comes to the driver is one count for each kind and combination of four votes and four traits: at most 6,480 rows.
    """
    keys = ["kind", *VOTES, *TRAITS]
    rows = candidates(docs).select(F.explode("_c").alias("c")).groupBy(*[F.col("c")[k].alias(k) for k in keys]).count().collect()
    out = {}
    for kind in KINDS:
        own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: [r[k] for k in keys])
        if own:
            out[kind] = tuple(np.array([[r[k] for k in names] for r in own], float) for names in (VOTES, TRAITS, ("count",)))
    return {kind: (votes, traits, counts[:, 0]) for kind, (votes, traits, counts) in out.items()}


def train(docs: DataFrame) -> dict[str, np.ndarray]:
    """For each kind the weights of yes votes, of no votes and of traits, and a constant.

    The classifier learns what the label model says of the candidates, and, with a weight of ``UNSEEN`` beside them, of all patterns of
    votes, so that it knows what to make of votes that no candidate has.
    """
    weights = {}
    for kind, (votes, traits, counts) in counted(docs).items():
        table, share = confusions(votes, counts, [v == "check" for v in VOTES])
        every = np.array(list(product((-1.0, 0.0, 1.0), repeat=len(VOTES))))
        usual = np.tile(np.average(traits, axis=0, weights=counts), (len(every), 1))
        said = np.vstack([votes, every])
        features = np.hstack([said > 0, said < 0, np.vstack([traits, usual])]).astype(float)
        target = posterior(said, table, share)
        weights[kind] = logistic(features, target, np.concatenate([counts, np.full(len(every), UNSEEN * counts.sum() / len(every))]))
    return weights


def _score(c: Column, weights: dict[str, np.ndarray]) -> Column:
    out = F.when(F.lit(False), F.lit(0.0))
    for kind, w in weights.items():
        known = [*[(c[v] > 0).cast("int") for v in VOTES], *[(c[v] < 0).cast("int") for v in VOTES], *[c[t] for t in TRAITS]]
        terms = [value * float(x) for value, x in zip(known, w)]
        out = out.when(c["kind"] == kind, reduce(lambda a, b: a + b, terms) + float(w[-1]))
    return out.otherwise(F.lit(-99.0))


def find(docs: DataFrame, weights: dict[str, np.ndarray] | None = None) -> DataFrame:
    """``docs`` with ``spans``: personal data as ``kind``, ``start``, ``end`` (code points, end exclusive) and ``base``, in order.

    ``docs`` needs ``text``; other columns stay, except that one named ``spans`` is replaced. A null or empty text has no spans.
    Base spans pass the fixed rules and always stay; the classifier adds spans that no base span overlaps. Without ``weights`` it is
    trained on ``docs`` first, all of them. A text of any length is searched whole. Repeated rows are judged alike; an empty table
    gives no rows.
    """
    weights = train(docs) if weights is None else weights
    rows = candidates(docs)
    rows = rows.withColumn("_base", F.filter("_c", lambda c: c["base"]))
    rows = rows.withColumn("_more", F.filter("_c", lambda c: ~c["base"] & (_score(c, weights) >= math.log(SURE / (1 - SURE)))))
    more = F.filter("_more", lambda c: ~F.exists("_base", lambda b: (c["start"] < b["end"]) & (b["start"] < c["end"])))
    order = lambda c: reduce(lambda a, k: a.when(c["kind"] == k, KINDS.index(k)), KINDS, F)
    keyed = F.array_sort(F.transform(F.concat("_base", more), lambda c: F.struct(
        c["start"].alias("start"), order(c).alias("order"), c["end"].alias("end"), c["kind"].alias("kind"), c["base"].alias("base"))))
    spans = F.transform(keyed, lambda c: F.struct(
        c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["base"].alias("base")))
    return rows.withColumn("spans", spans).drop("_c", "_base", "_more")


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """A text with each span replaced by its kind in brackets; of spans that overlap the first one's kind is put."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        apart = s["start"] >= state["at"]
        put = F.concat(state["out"], F.substring(text, state["at"] + 1, s["start"] - state["at"]), F.lit("["), F.upper(s["kind"]), F.lit("]"))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(apart, put).otherwise(state["out"]).alias("out"))

    done = F.aggregate(spans, start, step)
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))).otherwise(text)

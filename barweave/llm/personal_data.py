"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a
span classifier is trained on the result.

1. *Candidates.* Patterns find e-mail addresses, IP addresses, card and phone numbers (the
   base kinds) and looser things: keys and passwords, other long numbers, spelt-out mail
   addresses. Positions come from the pieces between the matches.
2. *Votes.* Regex, gazetteer and context labelers each say yes, no or nothing on a candidate.
3. *Reliabilities.* Expectation-maximisation over the counts of vote patterns estimates how
   often each labeler is right, and from that how likely each candidate is private.
4. *Classifier.* Naive Bayes over features of the span (kind, length, digits, variety, what
   stands beside it), trained on those likelihoods, decides on the looser candidates. Base
   spans stay in any case.

The corpus is read twice, by built-in functions only: once to count (votes, features), a
table whose size is bounded by the number of categories, and once to apply the classifier
row by row. No text is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import Packed, folded_before

# The base kinds in order. The patterns find what the plain ones find,
#   email [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
#   ip    [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
#   card  [0-9]([\x20-]?[0-9])+      phone \+[0-9][\x20().0-9-]+[0-9]
# but are not tried again inside a run that has failed, and take only cards long enough.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "secret": r"(?<![A-Za-z0-9_-])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{3,}+[\"']?\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_-]{12,}+",
    "number": r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])",
    "at_mail": r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{2,}+\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9.-]{2,}+",
}
#: A text without this has no match, and is not searched.
NEEDS = {"email": "@", "phone": "+", "secret": "[=:]", "at_mail": "[\\[(](?:at|AT)[\\])]"}
KINDS = (*BASE, *LOOSE)
LEFT = 24  # characters before a candidate that labelers see
# Words that announce private data, and ends of mail hosts.
ANNOUNCING = (
    "mail|contact|kontakt|phone|tel|call|fax|mobil|card|visa|account|konto|address|login|user"
)
SECRET_WORDS = "password|passwd|pwd|secret|token|api|key|auth|credential"
HOST_ENDS = "com|org|net|edu|io|de|fr|es|uk|info"
LABELERS = ("pattern", "gazetteer", "announced", "surrounded", "variety")

EM_ROUNDS = 50
SPAN = "kind:string,start:bigint,stop:bigint,body:string,left:string,right:string"


def _matches(rows: DataFrame, text: Column) -> DataFrame:
    """The rows with ``_found``, all candidates of all kinds."""
    patterns = {**BASE, **LOOSE}
    has_digit = F.rlike(text, F.lit("[0-9]"))
    empty = F.array().cast("array<string>")
    steps = rows.withColumn("_digit", has_digit)
    for kind, pattern in patterns.items():
        gate = F.rlike(text, F.lit(f"[{NEEDS[kind]}]" if kind in ("email", "phone") else NEEDS[kind])) if kind in NEEDS else F.col("_digit")
        steps = steps.withColumn(
            f"_m_{kind}",
            F.when(gate, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(empty),
        )
    for kind, pattern in patterns.items():
        steps = steps.withColumn(
            f"_p_{kind}",
            F.when(F.size(f"_m_{kind}") > 0, F.split(text, pattern, -1)).otherwise(empty),
        )
    found = F.concat(*(_located(kind) for kind in patterns))
    extra = [f"_{part}_{kind}" for kind in patterns for part in "mp"]
    return steps.withColumn("_found", found).drop("_digit", *extra)


def _located(kind: str) -> Column:
    """Spans of one kind: the pieces between the matches give the places."""
    matches, pieces = F.col(f"_m_{kind}"), F.col(f"_p_{kind}")
    none = F.array().cast(f"array<struct<{SPAN}>>")

    def span(gap_before, at):
        start = (gap_before + F.length(F.get(pieces, at))).cast("bigint")
        body = F.get(matches, at)
        return F.struct(
            F.lit(kind).alias("kind"),
            start.alias("start"),
            (start + F.length(body)).cast("bigint").alias("stop"),
            body.alias("body"),
            F.right(F.get(pieces, at), F.lit(LEFT)).alias("left"),
            F.left(F.get(pieces, at + 1), F.lit(2)).alias("right"),
        )

    lengths = F.transform(
        matches, lambda body, at: (F.length(F.get(pieces, at)) + F.length(body)).cast("bigint")
    )
    before = folded_before(lengths, F.lit(0).cast("bigint"), lambda a, b: a + b)
    walked = F.transform(before, span)
    return F.when(F.size(matches) > 0, F.filter(walked, lambda s: _valid(kind, s["body"]))).otherwise(none)


def _digits(body: Column) -> Column:
    return F.regexp_replace(body, "[^0-9]", "")


def _valid(kind: str, body: Column) -> Column:
    if kind == "ip":
        part = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
        return F.rlike(body, F.lit(f"^{part}(?:\\.{part}){{3}}$"))
    if kind == "card":
        return F.length(_digits(body)).between(14, 19) & _luhn(_digits(body))
    if kind == "phone":
        return F.length(_digits(body)).between(10, 15)
    return F.lit(True)


def _luhn(digits: Column) -> Column:
    backward = F.split(F.reverse(digits), "")
    values = F.transform(
        backward,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def _votes(span: Column) -> Column:
    """One letter per labeler: y, n, or - where it has nothing to say."""
    kind, body, left = span["kind"], span["body"], F.lower(span["left"])
    base = kind.isin(*BASE)
    variety = F.size(F.array_distinct(F.split(body, "")))
    # Digits enough for a card that are none: a card would have been a base span.
    failed = (kind == "number") & (F.length(_digits(body)) >= 14)
    pattern = F.when(base, "y").when(failed, "n").otherwise("-")
    gazetteer = (
        F.when(kind.isin("email", "at_mail"), F.when(F.rlike(F.lower(body), F.lit(f"\\.(?:{HOST_ENDS})$")), "y").otherwise("-"))
        .when(kind == "secret", F.when(F.rlike(F.lower(body), F.lit(SECRET_WORDS)), "y").otherwise("n"))
        .otherwise("-")
    )
    announced = F.when(F.rlike(left, F.lit(ANNOUNCING)), "y").otherwise("-")
    beside = F.rlike(left, F.lit("[-/#$%.,=][ ]?$")) | F.rlike(span["right"], F.lit("^[-/%=]"))
    surrounded = F.when(beside, "n").otherwise("-")
    mixed = F.rlike(body, F.lit("[0-9]")) & F.rlike(body, F.lit("[a-zA-Z]"))
    spread = F.when(variety < 4, "n").when(mixed | (variety > 6), "y").otherwise("-")
    return F.concat(pattern, gazetteer, announced, surrounded, spread)


def _features(span: Column) -> Column:
    """Categories of a span, each with few values."""
    body = span["body"]
    length = F.length(body)
    digits = F.length(_digits(body))
    before = F.right(span["left"], F.lit(1))
    after = F.left(span["right"], F.lit(1))

    def sort_of(char: Column) -> Column:
        return (
            F.when(char == "", "edge")
            .when(F.rlike(char, F.lit("[0-9]")), "digit")
            .when(F.rlike(char, F.lit("\\s")), "blank")
            .when(F.rlike(char, F.lit("\\p{L}")), "letter")
            .otherwise("mark")
        )

    values = {
        "kind": span["kind"],
        "length": F.least(F.floor(length / 8), F.lit(6)).cast("string"),
        "digits": F.floor(4 * digits / length).cast("string"),
        "variety": F.least(F.floor(F.size(F.array_distinct(F.split(body, ""))) / 4), F.lit(5)).cast("string"),
        "before": sort_of(before),
        "after": sort_of(after),
        "long": (F.length(_digits(body)) >= 14).cast("string"),
        "known": F.rlike(F.lower(body), F.lit(SECRET_WORDS)).cast("string"),
    }
    return F.array(*(F.concat(F.lit(f"{name}="), value) for name, value in values.items()))


class SpanClassifier:
    """Log odds of a span being private: a prior and a weight per feature value."""

    def __init__(self, prior: float, weights: dict[str, float]):
        self.prior, self.weights = prior, weights

    def keeps(self, span: Column) -> Column:
        if not self.weights:
            return F.lit(self.prior > 0)
        table = F.create_map(*(F.lit(x) for pair in sorted(self.weights.items()) for x in pair))
        odds = F.aggregate(
            _features(span),
            F.lit(self.prior),
            lambda total, f: total + F.coalesce(F.try_element_at(table, f), F.lit(0.0)),
        )
        return odds > 0


def reliabilities(counts: dict[str, float]) -> tuple[float, list[dict[str, tuple[float, float]]]]:
    """Prior and, per labeler, how likely each vote is for private and for other candidates.

    Expectation-maximisation from a majority start; ``counts`` are by vote pattern.
    """
    n_labelers = max((len(v) for v in counts), default=0)
    likely = {v: (1.0 + v.count("y")) / (2.0 + v.count("y") + v.count("n")) for v in counts}
    prior, tables = 0.5, []
    for _ in range(EM_ROUNDS):
        private = sum(counts[v] * likely[v] for v in counts)
        total = sum(counts.values())
        prior = (private + 1) / (total + 2)
        tables = []
        for k in range(n_labelers):
            votes = {}
            for letter in "yn-":
                has = [v for v in counts if v[k] == letter]
                yes = sum(counts[v] * likely[v] for v in has)
                no = sum(counts[v] * (1 - likely[v]) for v in has)
                votes[letter] = ((yes + 1) / (private + 3), (no + 1) / (total - private + 3))
            tables.append(votes)
        for v in counts:
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(tables[k][letter][0] / tables[k][letter][1]) for k, letter in enumerate(v)
            )
            likely[v] = 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))
    return prior, tables


def _likelihood(votes: str, prior: float, tables: Sequence[dict]) -> float:
    odds = math.log(prior / (1 - prior))
    odds += sum(math.log(tables[k][v][0] / tables[k][v][1]) for k, v in enumerate(votes))
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, odds))))


def learn(docs: DataFrame, text: str = "text") -> SpanClassifier:
    """A classifier from all candidates of all texts; only counts by category leave Spark."""
    packed = Packed(docs)
    body = F.coalesce(packed[text], F.lit(""))
    spans = _matches(packed.rows.select(body.alias("_text")), F.col("_text"))
    seen = spans.select(F.explode("_found").alias("_span")).select(
        _votes(F.col("_span")).alias("votes"), _features(F.col("_span")).alias("features")
    )
    counted = seen.groupBy("votes", F.array_join("features", " ").alias("features")).agg(
        F.count("*").alias("n")
    )
    rows = sorted((r.votes, r.features, float(r.n)) for r in counted.collect())
    by_votes: dict[str, float] = {}
    for votes, _, n in rows:
        by_votes[votes] = by_votes.get(votes, 0.0) + n
    prior, tables = reliabilities(by_votes)
    private: dict[str, float] = {}
    other: dict[str, float] = {}
    total_private = total_other = 0.0
    for votes, features, n in rows:
        p = _likelihood(votes, prior, tables)
        total_private, total_other = total_private + n * p, total_other + n * (1 - p)
        for feature in features.split(" "):
            private[feature] = private.get(feature, 0.0) + n * p
            other[feature] = other.get(feature, 0.0) + n * (1 - p)
    weights = {
        f: math.log((private[f] + 1) / (total_private + 2))
        - math.log((other[f] + 1) / (total_other + 2))
        for f in private
    }
    return SpanClassifier(math.log((total_private + 1) / (total_other + 1)), weights)


def find_personal_data(
    docs: DataFrame, classifier: SpanClassifier, text: str = "text"
) -> DataFrame:
    """Every row with ``base_spans``, ``all_spans`` and ``clean_text``.

    Spans are structs of ``start``, ``kind`` and ``stop``, in code points with ends
    exclusive, by start and then kind. Base spans are those of :data:`BASE` that are valid
    (parts of an ip at most 255; cards of 14 to 19 digits that pass Luhn's check; phones of
    10 to 15 digits); a match that is not valid is dropped and not tried again. All spans
    are these and the looser candidates that the classifier keeps and that overlap no base
    span. ``clean_text`` has each span's kind in brackets in its place; of spans that overlap,
    the first names the whole.

    A null text counts as empty but stays null in ``clean_text``. Rows that repeat get the
    same spans; ids play no part; an empty table stays empty. Very long texts are searched
    whole. Columns of ``docs`` named like an added one are replaced.
    """
    made = ("base_spans", "all_spans", "clean_text")
    packed = Packed(docs)
    body = packed[text]
    found = _matches(
        packed.rows.withColumn("_text", F.coalesce(body, F.lit(""))), F.col("_text")
    )
    base = F.filter("_found", lambda s: s["kind"].isin(*BASE))
    found = found.withColumn("_base", base)
    added = F.filter(
        "_found",
        lambda s: ~s["kind"].isin(*BASE)
        & classifier.keeps(s)
        & ~F.exists("_base", lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"])),
    )
    found = found.withColumn("_added", added)
    found = found.withColumn("_all", _ordered(F.concat("_base", "_added")))
    return found.select(
        *packed.back(made),
        _ordered(F.col("_base")).alias("base_spans"),
        F.col("_all").alias("all_spans"),
        _blanked(body, F.col("_all")).alias("clean_text"),
    )


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spans, which come in order, replaced by the names of their kinds."""

    def between(start: Column, stop: Column) -> Column:
        return F.substr(text, (start + 1).cast("int"), (stop - start).cast("int"))

    def step(done, span):
        added = F.concat(done["text"], between(done["at"], span["start"]), F.lit("["), span["kind"], F.lit("]"))
        return F.struct(
            F.greatest(done["at"], span["stop"]).alias("at"),
            F.when(span["start"] >= done["at"], added).otherwise(done["text"]).alias("text"),
        )

    first = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("text"))
    replaced = F.aggregate(
        spans,
        first,
        step,
        lambda done: F.concat(done["text"], between(done["at"], F.length(text).cast("bigint"))),
    )
    return F.when(F.size(spans) > 0, replaced).otherwise(text)


def _ordered(spans: Column) -> Column:
    numbers = F.array(*map(F.lit, KINDS))
    keyed = F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.array_position(numbers, s["kind"]).alias("number"),
            s["stop"].alias("stop"),
            s["kind"].alias("kind"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["start"], s["kind"], s["stop"]),
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:stop`` of each span, joined by commas."""
    each = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return F.array_join(each, ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")

"""Secrets in texts: fixed patterns, and long tokens that pass for random.

1. *Candidates.* Runs of 16 or more token characters that no base span touches. A candidate's
   encoding is the smallest alphabet that holds its characters (decimal, hexadecimal, base 32,
   36, 62, 64, ...).
2. *Battery.* Under the hypothesis that the characters are drawn evenly from that alphabet, each
   candidate gets three scores: chi-squared of its character counts, runs of character classes
   (digits, small letters, capitals, marks), and serial correlation of neighbours' places in the
   alphabet. Their p-values are combined by Fisher's method; a token that is a secret passes at
   level ``t`` in ``1 - t`` of all cases, ordinary writing hardly ever.
3. *False discoveries.* Every candidate has a decoy: as many letters and digits of the text around
   it, with blanks left out. Decoys go through the same battery. For each length class, the
   share of decoys that pass a level, against the share of candidates that do, estimates how many
   discoveries would be false; the class takes the most lenient level whose estimate is within
   the limit. Short tokens, which ordinary writing resembles sooner, so need more.

The corpus is read twice, by built-in functions only: once to count (class, level), a table of
fixed size, and once to apply the levels row by row. No text is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barweave.llm.common import Packed, blocks_of, folded_before, let, piece_of

# The base kinds in order, and the least length of what each must have found.
ASSIGN = (
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?"
)
BASE = {
    "assign": ASSIGN + r"[A-Za-z0-9+/_.=-]+",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
NAMES = r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"
LEAST_VALUE = 6
TOKEN = "token"
TOKEN_CHARS = r"A-Za-z0-9+/_=-"
LEAST = 16
PATTERNS = {**BASE, TOKEN: rf"(?<![{TOKEN_CHARS}])[{TOKEN_CHARS}]{{{LEAST},}}+"}
KINDS = tuple(PATTERNS)

DIGITS, SMALL, LARGE = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# Alphabets from small to large, in the order of their symbols.
ALPHABETS = {
    "decimal": DIGITS,
    "hex": DIGITS + SMALL[:6],
    "HEX": DIGITS + LARGE[:6],
    "base32": LARGE + DIGITS[2:8],
    "small36": DIGITS + SMALL,
    "large36": DIGITS + LARGE,
    "base62": DIGITS + LARGE + SMALL,
    "base64": LARGE + SMALL + DIGITS + "+/",
    "url64": LARGE + SMALL + DIGITS + "-_",
    "all": LARGE + SMALL + DIGITS + "+/-_=",
}
#: Lower ends of the length classes, and levels from strict to lenient.
LENGTHS = (16, 20, 24, 32, 48, 64)
LEVELS = (0.5, 0.3, 0.2, 0.1, 0.05, 0.02, 0.01, 0.005, 0.002, 0.001)
FALSE_SHARE = 0.05

SPAN = "struct<start:bigint,stop:bigint,body:string,beside:string>"


def _matches(rows: DataFrame, text: Column) -> DataFrame:
    """The rows with ``_at_<kind>``, arrays of all matches that are valid."""
    empty = F.array().cast("array<string>")

    def matched(kind: str, gate: Column) -> Column:
        return F.when(gate, F.regexp_extract_all(text, F.lit(PATTERNS[kind]), F.lit(0))).otherwise(empty)

    # Access keys and hexadecimal numbers are parts of runs that are long enough for a token.
    long_run = F.size(f"_m_{TOKEN}") > 0
    gates = {
        TOKEN: F.rlike(text, F.lit(PATTERNS[TOKEN])),
        "assign": F.rlike(text, F.lit("[:=]")) & F.rlike(text, F.lit(NAMES)),
        "access": long_run & F.contains(text, F.lit("AKIA")),
        "hex": long_run,
    }
    steps = rows
    for kind, gate in gates.items():
        steps = steps.withColumn(f"_m_{kind}", matched(kind, gate)).withColumn(
            f"_p_{kind}", F.when(F.size(f"_m_{kind}") > 0, F.split(text, PATTERNS[kind], -1)).otherwise(empty)
        )
    for kind in PATTERNS:
        steps = steps.withColumn(f"_at_{kind}", _spans(kind))
    return steps.drop(*(f"_{part}_{kind}" for kind in PATTERNS for part in "mp"))


def _spans(kind: str) -> Column:
    none = F.array().cast(f"array<{SPAN}>")

    def located(bodies: Column, pieces: Column) -> Column:
        """Matches stand between pieces."""

        def span(before: Column, i: Column) -> Column:
            body = F.get(bodies, i)
            start = before + F.length(F.get(pieces, i))
            # Decoys come from both sides, so much of it as holds enough letters as a rule.
            near = 3 * F.length(body) + 64
            sides = F.concat(F.right(F.get(pieces, i), near), F.left(F.get(pieces, i + 1), near))
            return F.struct(
                start.alias("start"),
                (start + F.length(body)).alias("stop"),
                body.alias("body"),
                (sides if kind == TOKEN else F.lit("")).alias("beside"),
            )

        steps = F.zip_with(
            F.slice(pieces, 1, F.size(bodies)),
            bodies,
            lambda p, b: (F.length(p) + F.length(b)).cast("bigint"),
        )
        zero = F.lit(0).cast("bigint")
        return F.transform(folded_before(steps, zero, lambda a, b: a + b), span)

    spans = let(
        F.col(f"_m_{kind}"), lambda bodies: let(F.col(f"_p_{kind}"), lambda pieces: located(bodies, pieces))
    )
    if kind == "assign":
        value = lambda s: F.regexp_replace(s["body"], "^" + ASSIGN, "")
        spans = F.filter(spans, lambda s: F.length(value(s)) >= LEAST_VALUE)
    return F.when(F.size(f"_m_{kind}") > 0, spans).otherwise(none)


# --- the battery -------------------------------------------------------------------------


def alphabet_of(token: Column) -> Column:
    """The smallest alphabet that holds the token; tokens are of :data:`TOKEN_CHARS`."""
    tests = None
    for symbols in ALPHABETS.values():
        only = F.translate(token, symbols, "") == ""
        tests = F.when(only, symbols) if tests is None else tests.when(only, symbols)
    return tests


def _tail(z: Column) -> Column:
    """How likely a standard normal number lies as far from 0 on either side, to 1.5e-7.

    The rational approximation of erfc by Abramowitz and Stegun, 7.1.26.
    """
    terms = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)

    def with_t(x: Column, t: Column) -> Column:
        total = F.lit(0.0)
        for term in reversed(terms):
            total = (total + term) * t
        return F.greatest(total * F.exp(-x * x), F.lit(1e-15))

    return let(
        F.least(F.abs(z), F.lit(8.0)) / 2**0.5,
        lambda x: let(1 / (1 + 0.3275911 * x), lambda t: with_t(x, t)),
    )


def _class_shares(symbols: str) -> list[float]:
    counts = [
        sum(c in group for c in symbols) for group in (DIGITS, SMALL, LARGE)
    ]
    return [n / len(symbols) for n in [*counts, len(symbols) - sum(counts)]]


def _by_alphabet(alphabet: Column, value) -> Column:
    cases = None
    for symbols in ALPHABETS.values():
        this = F.lit(float(value(symbols)))
        cases = F.when(alphabet == symbols, this) if cases is None else cases.when(alphabet == symbols, this)
    return cases


def _change(symbols: str) -> float:
    """How likely two neighbours are of different classes, at least a little."""
    return 1 - sum(p * p for p in _class_shares(symbols))


def _joint(symbols: str) -> float:
    """Covariance of the changes on both sides of a character."""
    return sum(p * (1 - p) ** 2 for p in _class_shares(symbols)) - _change(symbols) ** 2


def _scores(token: Column, alphabet: Column, n: Column, k: Column, chars: Column) -> Column:
    """Three standard scores: too uneven, neighbours alike, and too few or many runs."""
    counts = F.transform(
        F.array_distinct(chars), lambda c: n - F.length(F.replace(token, c, F.lit("")))
    )
    squares = F.aggregate(counts, F.lit(0.0), lambda total, c: total + c * c)
    uneven = (squares * k / n - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
    # Places in the alphabet about their mean; their variance is (k * k - 1) / 12.
    places = F.transform(chars, lambda c: F.instr(alphabet, c) - (k + 1) / 2)
    products = let(
        places,
        lambda x: F.zip_with(
            F.slice(x, 1, F.size(x) - 1), F.slice(x, 2, F.size(x) - 1), lambda a, b: a * b
        ),
    )
    serial = F.aggregate(products, F.lit(0.0), lambda total, v: total + v)
    serial = serial * 12 / (k * k - 1) / F.sqrt(n - 1)
    classes = token
    for symbols, sign in ((SMALL, "a"), (LARGE, "A"), (DIGITS, "0"), ("+/-_=", "-")):
        classes = F.translate(classes, symbols, sign * len(symbols))
    runs = F.length(F.regexp_replace(classes, "a+|A+|0+|-+", "x")).cast("double")

    def changed(change: Column, joint: Column) -> Column:
        variance = (n - 1) * change * (1 - change) + 2 * (n - 2) * joint
        # An alphabet of one class has one run whatever the token.
        return F.when(change > 0, (runs - 1 - (n - 1) * change) / F.sqrt(variance)).otherwise(F.lit(0.0))

    by_class = let(
        _by_alphabet(alphabet, _change),
        lambda change: let(_by_alphabet(alphabet, _joint), lambda joint: changed(change, joint)),
    )
    # Characters that are too even are no reason for doubt: that test has one side.
    return F.array(F.greatest(uneven, F.lit(0.0)), serial, by_class)


def randomness(token: Column) -> Column:
    """Combined p-value of the three tests; tokens have two characters or more."""

    def scores(t: Column) -> Column:
        return let(
            alphabet_of(t),
            lambda a: let(
                F.length(t).cast("double"),
                lambda n: let(
                    F.length(a).cast("double"),
                    lambda k: let(F.split(t, ""), lambda chars: _scores(t, a, n, k, chars)),
                ),
            ),
        )

    logs = F.aggregate(
        let(token, scores), F.lit(0.0), lambda total, z: total - F.log(_tail(z))
    )
    # Fisher: twice this sum is chi-squared with six degrees of freedom.
    return let(logs, lambda half: F.exp(-half) * (1 + half + half * half / 2))


def _length_class(length: Column) -> Column:
    return sum(((length >= low).cast("int") for low in LENGTHS[1:]), F.lit(0))


def _level(p: Column) -> Column:
    """Number of the strictest level that ``p`` passes; the number of levels if it passes none."""
    return let(p, lambda p: sum(((p < level).cast("int") for level in LEVELS), F.lit(0)))


def _decoy(span: Column) -> Column:
    """Letters and digits beside a candidate, as many as it has characters; null if too few."""
    writing = F.regexp_replace(span["beside"], "[^A-Za-z0-9]", "")
    size = F.length(span["body"])
    return F.when(F.length(writing) >= size, F.left(writing, size))


def _apart(tokens: Column, assigns: Column) -> Column:
    """Tokens that overlap no other base span, in one pass over both sorted together.

    Access keys and hexadecimal numbers lie inside one run of token characters; the spans of names
    with values need not. Those are apart from each other, so the nearest on each side decide.
    """
    inner = f"(?:{BASE['access']})|(?:{BASE['hex']})"
    free = F.filter(tokens, lambda s: ~F.rlike(s["body"], F.lit(inner)))
    far, zero = F.lit(1 << 62), F.lit(0).cast("bigint")

    def keyed(spans: Column, number: int) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(number).alias("number"), s.alias("span")
            ),
        )

    def alone(both: Column) -> Column:
        stops = F.transform(both, lambda s: F.when(s["number"] == 0, s["span"]["stop"]).otherwise(zero))
        starts = F.transform(both, lambda s: F.when(s["number"] == 0, s["start"]).otherwise(far))
        before = folded_before(stops, zero, lambda a, b: F.greatest(a, b))
        after = F.reverse(folded_before(F.reverse(starts), far, lambda a, b: F.least(a, b)))
        beside = F.zip_with(before, after, lambda b, a: F.struct(b.alias("ended"), a.alias("begins")))
        kept = F.zip_with(
            both,
            beside,
            lambda s, n: F.when(
                (s["number"] == 1) & (n["ended"] <= s["start"]) & (n["begins"] >= s["span"]["stop"]),
                s["span"],
            ),
        )
        return F.filter(kept, lambda s: s.isNotNull())

    met = let(F.array_sort(F.concat(keyed(assigns, 0), keyed(free, 1))), alone)
    return F.when(F.size(assigns) > 0, met).otherwise(free)


def _candidates(rows: DataFrame, text: Column) -> DataFrame:
    """The rows with base spans, ``_at_token`` being the candidates that touch none."""
    found = _matches(rows, text)
    apart = _apart(F.col("_at_token"), F.col("_at_assign"))
    return found.withColumn("_at_token", F.when(F.size("_at_token") > 0, apart).otherwise(F.col("_at_token")))


def learn_levels(
    docs: DataFrame, text: str = "text", false_share: float = FALSE_SHARE
) -> list[float | None]:
    """The p-value a candidate must reach, for each length class; None where no level will do.

    Counts all candidates and decoys of all texts. Without decoys a class has its most lenient
    level, without candidates none.
    """
    packed = Packed(docs)
    body = F.coalesce(packed[text], F.lit(""))
    spans = _candidates(packed.rows.select(body.alias("_text")), F.col("_text"))
    seen = spans.select(F.explode("_at_token").alias("_span")).select(
        F.col("_span.body").alias("token"), _decoy(F.col("_span")).alias("decoy")
    )
    tested = seen.select(F.explode(F.array(
        F.struct(F.lit(False).alias("decoy"), F.col("token").alias("token")),
        F.struct(F.lit(True).alias("decoy"), F.col("decoy").alias("token")),
    )).alias("_t")).select("_t.*").where("token is not null")
    counts = (
        tested.select("decoy", _length_class(F.length("token")).alias("size"), _level(randomness(F.col("token"))).alias("level"))
        .groupBy("decoy", "size", "level")
        .agg(F.count("*").alias("n"))
        .collect()  # at most twice the number of classes times that of levels
    )
    return levels_within({(r["decoy"], r["size"], r["level"]): r["n"] for r in counts}, false_share)


def levels_within(counts: dict[tuple[bool, int, int], int], false_share: float) -> list[float | None]:
    """The most lenient level of each length class whose share of false ones is within the limit."""
    out: list[float | None] = []
    for size in range(len(LENGTHS)):
        def passed(decoy: bool, most: int, size: int = size) -> int:
            return sum(n for (d, s, level), n in counts.items() if d == decoy and s == size and level <= most)

        everything = len(LEVELS)
        tokens, decoys = passed(False, everything), passed(True, everything)
        best = None
        for most, level in enumerate(LEVELS):
            found = passed(False, most)
            # Shares, so that candidates too near an end of a text to have a decoy count.
            if found and passed(True, most) * tokens <= false_share * found * max(decoys, 1):
                best = level
        out.append(best)
    return out


def find_secrets(docs: DataFrame, levels: Sequence[float | None], text: str = "text") -> DataFrame:
    """Every row with ``base_spans``, ``all_spans`` and ``clean_text``.

    Spans are structs of ``start``, ``kind`` and ``stop``, in code points with ends exclusive, by
    start and then kind. Base spans are the matches of the patterns of :data:`BASE`: names of secrets
    with a value of six characters or more, access keys and hexadecimal numbers of 24
    or more. A match that is too short is dropped and not tried again. All spans are these
    and the candidates (kind ``token``) that pass the level of their length class.
    ``clean_text`` has each span's kind in brackets in its place; of spans that overlap, the first
    names the whole.

    A null text counts as empty but stays null in ``clean_text``. Rows that repeat get the same spans;
    ids play no part; an empty table stays empty. Texts and tokens of any length are searched
    and tested whole. Columns of ``docs`` named like an added one are replaced.
    """
    made = ("base_spans", "all_spans", "clean_text")
    packed = Packed(docs)
    body = packed[text]
    found = _candidates(packed.rows.withColumn("_text", F.coalesce(body, F.lit(""))), F.col("_text"))
    limits = F.array(*(F.lit(level).cast("double") for level in levels))

    def passes(s: Column) -> Column:
        limit = F.get(limits, _length_class(F.length(s["body"])))
        return F.coalesce(randomness(s["body"]) >= limit, F.lit(False))

    def named(kind: str) -> Column:
        number = KINDS.index(kind)
        return F.transform(
            f"_at_{kind}",
            lambda s: F.struct(s["start"].alias("start"), F.lit(number).alias("number"), s["stop"].alias("stop")),
        )

    found = found.withColumn("_at_token", F.filter("_at_token", passes))
    base = F.array_sort(F.concat(*map(named, BASE)))
    found = found.withColumn("_base", base).withColumn(
        "_all",
        F.when(F.size("_at_token") > 0, F.array_sort(F.concat("_base", named(TOKEN)))).otherwise(F.col("_base")),
    )
    names = F.array(*map(F.lit, KINDS))

    def shown(spans: str) -> Column:
        return F.transform(
            spans, lambda s: F.struct(s["start"].alias("start"), F.get(names, s["number"]).alias("kind"), s["stop"].alias("stop"))
        )

    return (
        found.withColumn("base_spans", shown("_base"))
        .withColumn("all_spans", shown("_all"))
        .select(*packed.back(made), "base_spans", "all_spans", _blanked(body, F.col("all_spans")).alias("clean_text"))
    )


def _blanked(text: Column, spans: Column) -> Column:
    """The text with spans, which come in order, replaced by their kinds, in one pass."""

    def cut(spans: Column, ended: Column, blocks: Column) -> Column:
        # A span that begins inside an earlier one only makes the hole larger.
        def shown(s: Column, end: Column) -> Column:
            named = F.concat(piece_of(blocks, end, s["start"]), F.lit("["), s["kind"], F.lit("]"))
            return F.when(s["start"] >= end, named).otherwise(F.lit(""))

        last = F.array_max(F.transform(spans, lambda s: s["stop"]))
        rest = piece_of(blocks, last, F.length(text).cast("bigint"))
        return F.concat(F.array_join(F.zip_with(spans, ended, shown), ""), rest)

    def with_ends(spans: Column) -> Column:
        stops = F.transform(spans, lambda s: s["stop"])
        ended = folded_before(stops, F.lit(0).cast("bigint"), lambda a, b: F.greatest(a, b))
        return let(ended, lambda ends: let(blocks_of(text), lambda blocks: cut(spans, ends, blocks)))

    return F.when(F.size(spans) > 0, let(spans, with_ends)).otherwise(text)

"""Personal data in texts: patterns propose, checksums confirm, context adjusts.

Everything is a column function. A kind's matches and the gaps between them come from
the same pattern, so the places of the matches are sums of lengths, and the words
around a match are the ends of its two gaps. The sums are made by
doubling, so that the work does not grow with the square of a text's matches. A plain test first leaves out texts in
which a kind cannot occur. Patterns use possessive repetition and begin where a run
of their characters begins, so that a long run costs one pass.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before and after a match in which context words are looked for.
BEFORE, AFTER = 40, 20
CONTEXT_BONUS = 0.3
#: Added kinds count from this score on; base kinds are kept whatever their score.
ACCEPT = 0.7

# fixed values: countries by the length of their account numbers
IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "EG LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN = "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{size - 4}}}" for size, names in IBAN_COUNTRIES.items()
)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: a text without a match of this has none of the kind
    hint: str
    score: float
    context: str
    base: bool = True


# fixed values: patterns of the kinds, in the order in which equal starts are listed
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        r"@", 0.8, r"mail|contact|kontakt|contacto|write",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        r"[0-9]\.[0-9]", 0.6, r"\bip\b|host|server|address|adresse",
    ),
    Kind(
        "card",
        r"[0-9](?:[ -]?[0-9])++",
        r"[0-9](?:[ -]?[0-9]){13}", 0.7, r"card|visa|credit|karte|carte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        r"\+[0-9]", 0.6, r"phone|tel|call|mobil|fax",
    ),
    Kind(
        "iban",
        rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])",
        r"[A-Z]{2}[0-9]{2}", 0.8, r"iban|bank|account|konto|compte|cuenta", False,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        r"[0-9]-[0-9]", 0.5, r"ssn|social security|insurance", False,
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])(?=[A-Fa-f]*+[0-9])(?=[0-9]*+[A-Fa-f])[A-Fa-f0-9]{32,}+(?![A-Za-z0-9])",
        r"[A-Fa-f0-9]{32}", 0.5, r"token|secret|passw|api.?key|bearer|credential", False,
    ),
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether every second digit from the right, doubled, and the others sum to tens."""

    def add(acc, i):
        digit = F.substring(digits, -i, 1).cast("int")
        twice = F.when(digit > 4, 2 * digit - 9).otherwise(2 * digit)
        return acc + F.when(i % 2 == 0, twice).otherwise(digit)

    places = F.sequence(F.lit(1), F.length(digits))
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def mod97(value: Column) -> Column:
    """Whether letters as 10 to 35, the first four characters last, leave 1 modulo 97."""
    turned = F.concat(F.substring(value, 5, 1000), F.substring(value, 1, 4))

    def step(acc, c):
        number = F.ascii(c)
        digit = number < 58
        return (acc * F.when(digit, 10).otherwise(100) + number - F.when(digit, 48).otherwise(55)) % 97

    return F.aggregate(F.split(turned, "(?<=.)(?=.)"), F.lit(0), step) == 1


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":

        def small(part):
            part = F.regexp_replace(part, "^0+", "")
            return (F.length(part) < 3) | ((F.length(part) == 3) & (part <= "255"))

        return F.forall(F.split(match, r"\."), small)
    if kind == "card":
        digits = _digits(match)
        return F.when(F.length(digits).between(14, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(F.replace(match, F.lit(" "), F.lit("")))
    if kind == "ssn":
        return ~match.rlike("^(000|666|9)|-00-|-0000$")
    return F.lit(True)


def _spans(order: int, kind: Kind) -> Column:
    """Spans of a kind's matches ``f{order}`` between the gaps ``g{order}``, failing ones dropped."""
    found, gaps = F.col(f"f{order}"), F.col(f"g{order}")
    after = F.slice(gaps, F.lit(2), F.size(found))
    parts = F.arrays_zip(
        found.alias("match"),
        F.slice(gaps, F.lit(1), F.size(found)).alias("gap"),
        after.alias("next"),
    )
    ends = F.zip_with(found, _starts(parts), lambda match, start: start + F.length(match))

    def span(x, end):
        near = F.lower(F.concat(F.right(x["gap"], F.lit(BEFORE)), F.lit(" "), F.left(x["next"], F.lit(AFTER))))
        score = F.lit(kind.score) + F.when(near.rlike(kind.context), CONTEXT_BONUS).otherwise(0.0)
        kept = _valid(kind.name, x["match"])
        one = F.struct(
            (end - F.length(x["match"])).alias("start"), F.lit(order).alias("order"), end.alias("end"),
            F.lit(kind.name).alias("kind"), F.least(score, F.lit(1.0)).alias("score"),
        )
        return F.when(kept, one)

    least = F.lit(0.0 if kind.base else ACCEPT)
    spans = F.filter(F.zip_with(parts, ends, span), lambda x: x.isNotNull() & (x["score"] >= least))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string,score:double>>")
    return F.when(F.size(found) > 0, spans).otherwise(none)


def _starts(parts: Column) -> Column:
    """Where each match begins: the lengths of all gaps and matches before it.

    Running sums by doubling: each turn adds the sums that end 1, 2, 4, ... places before. An array that grows
    by one in each turn would be copied as often as it has members.
    """
    n = F.size(parts)
    lengths = F.transform(parts, lambda x: F.length(x["gap"]) + F.length(x["match"]))

    def turn(sums, k):
        back = F.pow(F.lit(2), k).cast("int")
        moved = F.concat(F.array_repeat(F.lit(0), F.least(back, n)), F.slice(sums, F.lit(1), F.greatest(n - back, F.lit(0))))
        return F.zip_with(sums, moved, lambda a, b: a + b)

    ends = F.aggregate(F.sequence(F.lit(0), F.ceil(F.log2(n)).cast("int")), lengths, turn)
    return F.zip_with(ends, parts, lambda end, x: end - F.length(x["match"]))


def with_spans(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds all spans of a text, by start and then kind: ``(start, order, end, kind, score)``.

    Places are code points, the end exclusive. A NULL or empty text has no spans.
    Matches of one kind do not overlap; those of different kinds may.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    parts = []
    for i, kind in enumerate(KINDS):
        can = value.rlike(kind.hint)
        none = F.array().cast("array<string>")
        parts.append(F.when(can, F.regexp_extract_all(value, F.lit(kind.pattern), F.lit(0))).otherwise(none).alias(f"f{i}"))
        parts.append(F.when(can, F.split(value, kind.pattern, -1)).otherwise(none).alias(f"g{i}"))
    found = df.select("*", *parts)
    spans = F.concat(*[_spans(i, kind) for i, kind in enumerate(KINDS)])
    return found.select(*[F.col(c) for c in df.columns], F.array_sort(spans).alias(name))


def joined(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ","
    )


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds and all spans, a row for each row of *df*.

    ``base`` and ``spans`` list the spans of the base kinds and of all kinds. A NULL or empty text has none.
    Rows are looked at one by one: those with a NULL key and repeated ones stay. Other columns are not looked at.
    """
    plain = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    marked = with_spans(plain, "text", "spans").select("key", "spans")
    base = [k for k in KINDS if k.base]

    def count(order):
        return F.size(F.filter("spans", lambda x: x["order"] == order)).cast("bigint")

    return marked.select(
        F.col("key").alias(key),
        *[count(i).alias(f"n_{k.name}") for i, k in enumerate(base)],
        F.filter("spans", lambda x: x["order"] < len(base)).alias("base"),
        "spans",
    )

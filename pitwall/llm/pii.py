"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust their score.

Everything is a DataFrame function over one row, without a shuffle. Splitting a text by a pattern gives what stands
between the matches, so that running sums of lengths give positions. The sums are made by doubling steps: as many
steps as the number of matches has binary digits, also for a text with very many of them.

The patterns look for each kind alone, leftmost and without overlaps. They start only where a run of their first
characters starts and never give characters back, so the time is in proportion to the text, however long a run is.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are always reported once their own rule holds. ``iban`` and ``ssn``
are reported from a score of ``LEAST_SCORE`` on. Scores are per cent.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code points before and after a span, up to the next span of its kind, in which words count.
NEARBY = 40
# Points that words for and against a kind are worth.
WORD_POINTS = 20
LEAST_SCORE = 60

_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
_BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Leading zeros are taken whole, so a part of zeros alone has to match by itself.
_PART = f"(?:0++|{_BYTE})"
AGAINST = "example|invoice|order|part|serial|test|ticket|tracking|version"


@dataclass(frozen=True)
class Kind:
    """How spans of a kind are proposed (``pattern``), confirmed (``rule`` over ``m``) and scored."""

    name: str
    pattern: str
    rule: str
    points: int
    words: str
    base: bool = True


def _luhn(digits: str) -> str:
    value = f"cast(substr({digits}, i, 1) as int)"
    doubled = f"if((length({digits}) - i) % 2 = 1, {value} * 2 - if({value} > 4, 9, 0), {value})"
    return f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + {doubled}) % 10 = 0"


def _mod_97(code: str) -> str:
    turned = f"concat(substr({code}, 5), substr({code}, 1, 4))"
    sign = f"substr({turned}, i, 1)"
    step = f"if({sign} <= '9', s * 10 + ascii({sign}) - 48, s * 100 + ascii({sign}) - 55) % 97"
    return f"aggregate(sequence(1, length({code})), 0, (s, i) -> {step}) = 1"


_DIGITS = "regexp_replace(m, '[^0-9]', '')"
_CODE = "replace(m, ' ', '')"

KINDS = (
    Kind(
        "email",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
        "true",
        80,
        "contact|e-?mail|mail|write",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        f"m rlike r'^{_PART}(?:\\.{_PART}){{3}}$'",
        50,
        "address|client|host|ip|server",
    ),
    Kind(
        "card",
        "[0-9](?:[ -]?[0-9])++",
        f"length({_DIGITS}) between 14 and 19 and {_luhn(_DIGITS)}",
        80,
        "amex|card|credit|debit|mastercard|payment|visa",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        f"length({_DIGITS}) between 10 and 15",
        60,
        "call|cell|fax|mobile|phone|tel|telephone|whatsapp",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9_])[A-Z]{2}[0-9]{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9_])",
        f"length({_CODE}) between 15 and 34 and {_mod_97(_CODE)}",
        80,
        "account|bank|iban|transfer",
        base=False,
    ),
    Kind(
        "ssn",
        r"(?<![A-Za-z0-9_])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9_])",
        "substr(m, 1, 3) not in ('000', '666') and m < '9' and substr(m, 5, 2) <> '00' and substr(m, 8) <> '0000'",
        40,
        "security|social|ssn",
        base=False,
    ),
)

SPAN = "struct<start int, kind_no int, end int, kind string, value string, score int, base boolean>"


def _running_sums(sizes: str) -> str:
    """Running sums of an array, by doubling steps."""
    step = "transform(a, (v, i) -> v + coalesce(get(a, i - shiftleft(1, k)), 0))"
    steps = f"sequence(0, cast(ceil(log2(size({sizes}))) as int) - 1)"
    return f"if(size({sizes}) < 2, {sizes}, aggregate({steps}, {sizes}, (a, k) -> {step}))"


def any_word(words: str) -> str:
    """A pattern for any of some words, which no letter, digit or underscore touches."""
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{words})(?:$|[^\p{{L}}\p{{N}}_])"


def _spans(no: int, kind: Kind) -> Column:
    """The confirmed spans of a kind, from the columns that ``find`` has prepared."""
    near = f"concat(right(_between{no}[i], {NEARBY}), ' ', left(_between{no}[i + 1], {NEARBY}))"
    score = (
        f"{kind.points} + if({near} rlike r'{any_word(kind.words)}', {WORD_POINTS}, 0)"
        f" - if({near} rlike r'{any_word(AGAINST)}', {WORD_POINTS}, 0)"
    )
    fields = (
        f"named_struct('start', _ends{no}[i] - length(m), 'kind_no', {no}, 'end', _ends{no}[i], 'kind', '{kind.name}',"
        f" 'value', m, 'score', if({kind.rule}, {score}, -1), 'base', {str(kind.base).lower()})"
    )
    least = 0 if kind.base else LEAST_SCORE
    # points can only become negative where the rule fails
    return F.expr(f"filter(transform(_found{no}, (m, i) -> {fields}), s -> s.score >= {least})").cast(f"array<{SPAN}>")


def find(docs: DataFrame, text_column: str = "text", kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """``row`` (all columns of ``docs``) and ``spans``: start, end (code points, end exclusive), kind, value, score, base.

    Spans are ordered by start, then by kind as listed. Null and empty texts have none; equal texts have equal spans.
    A line break never stands inside a span. An ip part may have leading zeros. The rows of ``docs`` stay as they are,
    repeated ids included, and no column name of theirs can clash, as they are held in ``row``.
    """
    found = docs.select(F.struct("*").alias("row"), F.coalesce(F.col(text_column), F.lit("")).alias("_text"))
    numbers = range(len(kinds))
    parts = {}
    for no in numbers:
        pattern = F.lit(kinds[no].pattern)
        parts[f"_between{no}"] = F.split("_text", pattern, -1)
        parts[f"_found{no}"] = F.regexp_extract_all("_text", pattern, F.lit(0))
    found = found.withColumns(parts)
    sizes = {f"_sizes{no}": F.expr(f"transform(_found{no}, (m, i) -> length(m) + length(_between{no}[i]))") for no in numbers}
    found = found.withColumns(sizes)
    found = found.withColumns({f"_ends{no}": F.expr(_running_sums(f"_sizes{no}")) for no in numbers})
    spans = F.concat(*(_spans(no, kinds[no]) for no in numbers))
    return found.select("row", F.array_sort(spans).alias("spans"))


def of_kind(kind: str) -> Column:
    """The number of spans of a kind."""
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def shown(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

"""Column helpers for text, numbers and dates (all JVM-side expressions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a price text may carry around its digits.
PRICE_NOISE = "[\u202f\u2009₽]"

# A phone-like run: optional plus, then at least ten digits and separators.
CONTACT_PATTERN = r"\+?[0-9][0-9 ().-]{8,}[0-9]"

# Every Unicode white-space character; Spark's own trim() removes U+0020 only.
_SPACE = r"[\s\x0B\x85\p{Z}]"
# The look-behind tries each inner run of spaces once, not once per character.
SPACE_EDGES = rf"\A{_SPACE}++|(?<!{_SPACE}){_SPACE}++\z"
_INTEGER = r"\A[+-]?[0-9]+\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_text(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it.

    Inside higher-order functions Spark does not share common subexpressions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trim_space(c: Column | str) -> Column:
    """Strip Unicode white space from both ends."""
    return F.regexp_replace(_col(c), SPACE_EDGES, "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def strict_int(c: Column | str) -> Column:
    """BIGINT for an optional sign plus ASCII digits and nothing else, NULL otherwise.

    A plain cast would also take padding, decimals or exponents.
    """
    c = _col(c)
    return F.when(c.rlike(_INTEGER), c.try_cast("bigint"))


def checked_int(c: Column | str, bits: int, signed: bool, policy: str = "null") -> Column:
    """Narrow an integer to ``bits``: out of range is NULL, or wraps around."""
    if bits > 32:
        raise ValueError("only widths up to 32 bits fit a BIGINT without loss")
    c = _col(c).cast("bigint")
    span = 1 << bits
    low = -(span >> 1) if signed else 0
    if policy == "wrap":
        return F.pmod(c - F.lit(low), F.lit(span).cast("bigint")) + F.lit(low)
    if policy == "null":
        return F.when(c.between(low, low + span - 1), c)
    raise ValueError(f"unknown policy {policy!r}")


def checked_unsigned(c: Column | str, bits: int, policy: str = "null") -> Column:
    return checked_int(c, bits, signed=False, policy=policy)


def parse_price(c: Column | str, strip_spaces: bool = False, policy: str = "wrap") -> Column:
    """Price text to INT, 0 when it is not a plain integer.

    The narrow spaces and the currency sign are removed; an ordinary space stays, so
    ``"5 000"`` is 0 unless ``strip_spaces``.  ``policy`` rules values beyond 32 bits.
    """
    noise = PRICE_NOISE[:-1] + " ]" if strip_spaces else PRICE_NOISE
    value = strict_int(F.regexp_replace(_col(c), noise, ""))
    return F.coalesce(checked_int(value, 32, signed=True, policy=policy), F.lit(0)).cast("int")


def has_contact(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(CONTACT_PATTERN), F.lit(False))


def mask_contacts(c: Column | str, mask: str = "[contact]") -> Column:
    """Replace phone-like runs; the masked number is not kept anywhere."""
    return F.regexp_replace(_col(c), CONTACT_PATTERN, mask.replace("\\", r"\\").replace("$", r"\$"))


def longer_than(c: Column | str, n_bytes: int) -> Column:
    """True when the UTF-8 form is longer than ``n_bytes`` (bytes, not characters)."""
    return F.octet_length(_col(c)) > n_bytes


def keyword_class(text: Column, onsite: str, offsite: str, labels=("apartment", "outcall", "both")) -> Column:
    """Which of two words the lower-cased text holds: one label each, one for both, else ''."""


    def pick(low: Column) -> Column:
        on, off = low.contains(onsite), low.contains(offsite)
        only_one = F.when(on, F.lit(labels[0])).when(off, F.lit(labels[1])).otherwise(F.lit(""))
        return F.when(on & off, F.lit(labels[2])).otherwise(only_one)

    return let(F.lower(text), pick)


def yyyymm(ts: Column | str) -> Column:
    ts = _col(ts)
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def date_from_text(c: Column | str) -> Column:
    """First ``dd.mm.yyyy`` in the text, '' when there is none."""
    return F.regexp_extract(_col(c), r"(\d{2}\.\d{2}\.\d{4})", 1)


def parse_date(c: Column | str) -> Column:
    """The stored ``dd.mm.yyyy`` text as DATE; NULL when it is not a date."""
    return F.try_to_timestamp(_col(c), F.lit("dd.MM.yyyy")).cast("date")

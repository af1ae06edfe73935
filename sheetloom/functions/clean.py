"""Cleaning of single values, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sheetloom import fixed_values as fv

C = Column | str


def col(c: C) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_re(pattern: str) -> str:
    r"""Java spelling of a pattern whose ``\w \b \s \d`` know all of Unicode."""
    return "(?U)" + pattern


WHITE_SPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(
    chr(x) for x in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"


def pystrip(c: C) -> Column:
    """Trim every kind of white space at both ends."""
    return F.trim(col(c), F.lit(WHITE_SPACE))


def is_blank(c: C) -> Column:
    return col(c).isNull() | (pystrip(c) == "")


def nonblank(c: C) -> Column:
    """The value itself, or null when it is empty or white space."""
    return F.when(pystrip(c) != "", col(c))


def header_key(c: C) -> Column:
    r"""Header spelling used for comparison: lower case, ``space - / .`` to ``_``."""
    return F.trim(
        F.regexp_replace(F.lower(pystrip(c)), unicode_re(r"[\s\-/.]+"), "_"), F.lit("_"))


def header_key_text(alias: str) -> str:
    """The same spelling for a literal alias."""
    import re

    return re.sub(r"[\s\-/.]+", "_", alias.strip().lower()).strip("_")


def clean_str(c: C) -> Column:
    s = pystrip(c)
    return F.when((s != "") & ~F.lower(s).isin(fv.NULL_WORDS), s)


def clean_float(c: C) -> Column:
    """Number in a text with currency marks, commas or a percent sign.

    A leading ``Rs.``, ``INR`` or rupee sign is removed before the digits are
    collected, so that its full stop is not read as a decimal point.
    """
    s = clean_str(c)
    bare = F.regexp_replace(s, r"(?i)^(-?)\s*(?:rs\.?|inr|₹)\s*", "$1")
    sign = F.when(s.startswith("-"), F.lit(-1.0)).otherwise(F.lit(1.0))
    return F.regexp_replace(bare, r"[^0-9.]+", "").try_cast("double") * sign


def clean_int(c: C) -> Column:
    """Integer part of :func:`clean_float`; out-of-range values become null."""
    number = clean_float(c)
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(F.abs(number) < F.lit(2147483648.0), whole.cast("int"))


def _first_group(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, unicode_re(pattern), 1), F.lit(""))


def declared_count(c: C) -> Column:
    """``(6 Pcs)``, ``6 Pcs``, ``Pack of 4`` or plain digits, in that order."""
    s = clean_str(c)
    digits = F.coalesce(
        _first_group(s, fv.COUNT_IN_PARENTHESES),
        _first_group(s, fv.COUNT_OF_PIECES),
        _first_group(s, fv.COUNT_PACK_OF),
        F.when(s.rlike(r"^[0-9]+$"), s),
    )
    return digits.try_cast("int")


def clean_token(c: C) -> Column:
    """Text for containment tests: words joined by ``-``, one spelling unified."""
    dashed = F.regexp_replace(F.lower(pystrip(c)), unicode_re(r"[\W_]+"), "-")
    return F.regexp_replace(
        F.trim(dashed, F.lit("-")),
        unicode_re(rf"\b{fv.SPELLING_FROM}\b"), fv.SPELLING_TO)


def clean_amount(c: C) -> Column:
    """Positive amount with thousands commas, else null."""
    number = F.replace(pystrip(c), F.lit(","), F.lit("")).try_cast("double")
    return F.when(number > 0, number)


def gst_label(c: C) -> Column:
    whole = F.when(col(c) < 0, F.ceil(col(c))).otherwise(F.floor(col(c)))
    return F.coalesce(F.concat(whole.cast("string"), F.lit("% Extra")), F.lit(""))


def amount_text(c: C) -> Column:
    """A number as text with two decimals (never in exponent form); null beyond 36 digits."""
    return col(c).try_cast("decimal(38,2)").cast("string")


def code_prefix(c: C) -> Column:
    """Upper-case code prefix: characters other than words and ``-`` become ``-``."""
    dashed = F.regexp_replace(pystrip(c), unicode_re(r"[^\w\-]+"), "-")
    return F.upper(F.trim(dashed, F.lit("-")))


def two_digits(c: C) -> Column:
    return F.format_string("%02d", col(c))


def is_remote_url(c: C) -> Column:
    s = pystrip(c)
    return F.coalesce(
        s.startswith("http://") | s.startswith("https://") | s.contains(fv.HOSTED_DOMAIN),
        F.lit(False))


def is_hosted_url(c: C) -> Column:
    return F.coalesce(col(c).contains(fv.HOSTED_WORD), F.lit(False))


def title_case(c: C) -> Column:
    """Capital after every non-letter, the rest lower case."""
    pieces = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(?U)(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), w.substr(F.lit(2), F.length(w)))), "")


def natural_key(c: C) -> Column:
    """Text whose plain order is the natural order of ``c``.

    Digit runs are written as ``length of digits`` + digits without leading
    zeros, so 2 sorts before 10 for numbers of any length.  A
    text that starts with a digit sorts before any other.
    """
    chunks = F.regexp_extract_all(F.lower(col(c)), F.lit(r"(\d+|\D+)"), F.lit(1))

    def one(chunk: Column) -> Column:
        bare = F.regexp_replace(chunk, "^0+(?=.)", "")
        number = F.concat(F.lpad(F.length(bare).cast("string"), 10, "0"), bare)
        return F.when(chunk.rlike("^[0-9]"), number).otherwise(chunk)

    joined = F.array_join(F.transform(chunks, one), "\u0001")
    return F.when(col(c).rlike("^[0-9]"), F.concat(F.lit("\u0001"), joined)).otherwise(joined)

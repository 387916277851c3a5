"""Column expressions for cleaning. Each returns a ``Column``; nothing here
touches a DataFrame, so every expression stays inside whole-stage codegen and
composes into one projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from goldenrec import settings


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def email(col: str | Column) -> Column:
    """lower(trim(email))."""
    return F.lower(F.trim(_c(col)))


def phone(col: str | Column, pattern: str = settings.PHONE_STRIP_PATTERN) -> Column:
    """Keep digits and ``+`` only. A numeric input is cast to string first."""
    return F.regexp_replace(_c(col).cast("string"), pattern, "")


def proper_name(col: str | Column) -> Column:
    """initcap(trim(x)): words split on spaces only, rest lower-cased."""
    return F.initcap(F.trim(_c(col)))


def company_name(col: str | Column) -> Column:
    """Collapse whitespace runs to one space, trim, upper-case."""
    return F.upper(F.trim(F.regexp_replace(_c(col), r"\s+", " ")))


def blank_as_null(col: str | Column) -> Column:
    """NULL for NULL, empty or all-space strings; the value otherwise."""
    c = _c(col)
    return F.when(F.trim(c) != F.lit(""), c)


def boolean_three_state(
    col: str | Column,
    true_words: Sequence[str] = settings.TRUE_WORDS,
    false_words: Sequence[str] = settings.FALSE_WORDS,
) -> Column:
    """true/yes/1/t/y -> true, false/no/0/f/n -> false, anything else NULL.

    Strings outside both vocabularies go through ``try_cast`` instead of
    raising under ANSI mode, so a stray 'maybe' becomes NULL.
    """
    low = F.lower(F.trim(_c(col).cast("string")))
    return (
        F.when(low.isin(*true_words), F.lit(True))
        .when(low.isin(*false_words), F.lit(False))
        .otherwise(low.try_cast("boolean"))
    )


def boolean_two_state(col: str | Column, true_words: Sequence[str] = settings.TWO_STATE_TRUE_WORDS) -> Column:
    """true/yes/1 -> true, everything else including NULL -> false."""
    return F.when(F.lower(_c(col).cast("string")).isin(*true_words), F.lit(True)).otherwise(F.lit(False))


def full_name(first: str | Column = "first_name", last: str | Column = "last_name") -> Column:
    """first + ' ' + last; NULL when either part is NULL (concat, not concat_ws)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def parse_date(col: str | Column, fmt: str | None = None) -> Column:
    """Date from text; malformed input gives NULL instead of an error."""
    c = _c(col)
    return F.try_to_date(c, F.lit(fmt)) if fmt else F.try_to_date(c.cast("string"))


def as_int(col: str | Column) -> Column:
    """Integer from text; malformed input gives NULL (ANSI-safe)."""
    return _c(col).try_cast("int")


def source_system(path: str | Column, mapping: Iterable[tuple[str, str]] = settings.SOURCE_SYSTEMS,
                  default: str = settings.UNKNOWN_SOURCE) -> Column:
    """CASE chain over substrings of the path; first match wins."""
    p = _c(path)
    expr = None
    for needle, label in mapping:
        expr = F.when(p.contains(needle), F.lit(label)) if expr is None else expr.when(p.contains(needle), F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def file_name_from_path(path: str | Column) -> Column:
    """Last path segment: regexp_extract(path, '([^/]+)$', 1)."""
    return F.regexp_extract(_c(path), r"([^/]+)$", 1)


def confidence(repetition: str | Column, high_above: int = settings.HIGH_ABOVE,
               moderate_at: int = settings.MODERATE_AT) -> Column:
    """High when repetition > high_above, Moderate when == moderate_at, else Low."""
    r = _c(repetition)
    return F.when(r > high_above, F.lit("High")).when(r == moderate_at, F.lit("Moderate")).otherwise(F.lit("Low"))


def confidence_rank(label: str | Column, ranks: Iterable[tuple[str, int]] = settings.CONFIDENCE_RANKS) -> Column:
    """Numeric rank of a confidence label; NULL for an unknown label."""
    lab = _c(label)
    expr = None
    for name, rank in ranks:
        expr = F.when(lab == name, F.lit(rank)) if expr is None else expr.when(lab == name, F.lit(rank))
    return expr


def non_null_count(cols: Sequence[str | Column]) -> Column:
    """Number of non-NULL values among ``cols`` (record completeness)."""
    terms = [F.when(_c(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)) for c in cols]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total

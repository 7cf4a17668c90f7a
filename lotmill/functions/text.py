"""Text normalisation and extraction."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lotmill import rules

_NOT_WORD = r"[^\p{L}\p{N}_\-]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(entries: Mapping) -> Column:
    """A map literal; only for lookup tables whose size is fixed in the code."""
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def strip(c: Column | str) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(_col(c), F.lit(rules.WHITESPACE))


def hyphenate(c: Column | str, *marks: str) -> Column:
    """The given marks as hyphens. ``replace`` skips text without the mark; ``translate`` walks all of it."""
    value = _col(c)
    for mark in marks:
        value = F.replace(value, F.lit(mark), F.lit("-"))
    return value


def fold(c: Column | str) -> Column:
    """Trim and lower-case."""
    return F.lower(strip(c))


def blank_placeholders(c: Column | str, placeholders: Iterable[str] = rules.MISSING_PLACEHOLDERS) -> Column:
    """Trimmed text, or null where the text is one of the 'missing' spellings."""
    text = strip(c)
    return F.when(~text.isin(list(placeholders)), text)


def lookup_or_self(c: Column | str, aliases: Mapping[str, str]) -> Column:
    """Alias when there is one, otherwise the value itself."""
    value = _col(c)
    return F.coalesce(F.element_at(literal_map(aliases), value), value)


def lookup_or_null(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Strict lookup: a value outside the mapping becomes null."""
    return F.element_at(literal_map(mapping), _col(c))


def lookup_or_default(c: Column | str, mapping: Mapping, default) -> Column:
    return F.coalesce(F.element_at(literal_map(mapping), _col(c)), F.lit(default))


def only_word_characters(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), _NOT_WORD, "")


def plain_name(c: Column | str) -> Column:
    """Folded, hyphens for underscores, no other punctuation."""
    return only_word_characters(hyphenate(fold(c), "_"))


def unless_dropped(c: Column | str, drop: Iterable[str], aliases: Mapping[str, str]) -> Column:
    """Null for the unwanted names, otherwise the alias or the name itself."""
    name = _col(c)
    return F.when(~name.isin(list(drop)), lookup_or_self(name, aliases))


def without_punctuation(c: Column | str) -> Column:
    """Word characters and hyphens only; nothing left -> null."""
    return F.nullif(only_word_characters(c), F.lit(""))


def brand_name(c: Column | str, aliases=rules.BRAND_ALIASES, drop=rules.BRANDS_TO_DROP) -> Column:
    """Hyphenate, strip punctuation, null the unwanted names, then apply aliases."""
    return unless_dropped(plain_name(c), drop, aliases)


def model_name(c: Column | str, aliases=rules.MODEL_ALIASES, drop=rules.MODELS_TO_DROP) -> Column:
    """Like :func:`brand_name`, but aliases see the punctuation and empty results become null."""
    return without_punctuation(unless_dropped(hyphenate(fold(c), "_"), drop, aliases))


def category(c: Column | str, aliases: Mapping[str, str]) -> Column:
    """Hyphenate blanks and underscores, then apply aliases."""
    return lookup_or_self(hyphenate(fold(c), "_", " "), aliases)


def _extract(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, 1), F.lit(""))


def horsepower(c: Column | str) -> Column:
    """``60 kW (82 hp)`` -> 82.0; null without a bracketed hp figure."""
    return _extract(_col(c), r"\((\d+)\s*hp\)").try_cast("double")


def horsepower_or_digits(c: Column | str) -> Column:
    """Bracketed hp figure, else the first run of digits."""
    value = _col(c)
    return F.coalesce(_extract(value, r"\((\d+)\s*hp\)"), _extract(value, r"(\d+)")).try_cast("int")


def first_year(c: Column | str) -> Column:
    """First run of four digits as an integer, or null."""
    return _extract(_col(c).cast("string"), r"(\d{4})").try_cast("int")


def year_of_registration(c: Column | str) -> Column:
    """As :func:`first_year`, but text without a year is an error (null stays null)."""
    value = _col(c).cast("string")
    year = first_year(value)
    problem = F.raise_error(F.concat(F.lit("no four-digit year in: "), value)).cast("int")
    return F.when(value.isNotNull(), F.coalesce(year, problem))


def year_after_slash(c: Column | str) -> Column:
    """``02/2017`` -> 2017."""
    return F.split_part(_col(c), F.lit("/"), F.lit(2)).try_cast("int")


def leading_year(c: Column | str) -> Column:
    """First four characters as an integer (``2016-03-01 ...`` -> 2016)."""
    return F.substring(_col(c), 1, 4).try_cast("int")


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), r"\D", "")


def first_word(c: Column | str) -> Column:
    """First white-space separated token ('' for blank text)."""
    return F.element_at(F.split(strip(c), r"\s+"), 1)


def other_words(c: Column | str) -> Column:
    """All tokens after the first, joined by single blanks."""
    parts = F.split(strip(c), r"\s+")
    return F.array_join(F.slice(parts, F.lit(2), F.size(parts)), " ")


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither null nor the empty string."""
    return F.coalesce(*[F.nullif(_col(c), F.lit("")) for c in cols])


def title_case(c: Column | str) -> Column:
    return F.initcap(_col(c))


def thousands(c: Column | str, digits: int = 0) -> Column:
    return F.format_number(_col(c), digits)


def percent_text(c: Column | str, digits: int = 1) -> Column:
    return F.format_string(f"%.{digits}f%%", _col(c) * 100)


def run_label(model: Column | str = "model", dataset: Column | str = "dataset") -> Column:
    return F.concat(_col(model), F.lit(" ("), _col(dataset), F.lit(")"))


def display_name(c: Column | str, names: Mapping[str, str] = rules.DISPLAY_NAMES) -> Column:
    return lookup_or_self(c, names)

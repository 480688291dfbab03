"""String functions as native Column expressions (no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Separators used by the word-count programs.
WORD_SEPARATOR = r"\W+"     # batch word count, count-window word count
WHITESPACE_CHAR = r"\s"     # socket window word count (single char: empties kept)
SPACE = " "                 # stream word count
COMMA = ","                 # sensor lines
SEMICOLON = ";"             # semicolon CSV word count
SEPARATOR_CHARS = {WHITESPACE_CHAR: " \t\n\x0b\f\r", SPACE: " ", COMMA: ",", SEMICOLON: ";"}   # what each can match


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_drop_trailing(col, pattern: str) -> Column:
    """Regex split with the JVM ``String.split`` result shape: trailing
    empty strings are removed (Spark's ``split`` keeps them).

    ``""`` gives ``[""]``; a string made only of separators gives ``[]``.
    """
    s = _c(col)
    if pattern in SEPARATOR_CHARS:      # single characters: trimmed from the right without a regex
        stripped = F.rtrim(s, F.lit(SEPARATOR_CHARS[pattern]))
    else:
        # a pattern that already ends in "+" must not be wrapped in another
        # repetition: nested quantifiers backtrack exponentially on long runs
        tail = f"(?:{pattern})\\z" if pattern.endswith("+") else f"(?:{pattern})+\\z"
        stripped = F.regexp_replace(s, tail, "")
    return (F.when(s.isNull(), F.lit(None))
            .when(stripped == "", F.when(s == "", F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))
            .otherwise(F.split(stripped, pattern)))


def words(col, pattern: str = WORD_SEPARATOR, lower: bool = True, keep_empty: bool = True) -> Column:
    """Token array: optional lower-casing, split.  With ``keep_empty`` the
    JVM split shape is kept (trailing empties dropped, interior ones kept);
    without it empty tokens are removed, which makes the trailing rule moot
    and saves a regex pass."""
    s = _c(col)
    s = F.lower(s) if lower else s
    if keep_empty:
        return split_drop_trailing(s, pattern)
    return F.filter(F.split(s, pattern), lambda t: t != "")


def java_string_hash(col) -> Column:
    """``String.hashCode``: 31-polynomial over UTF-16 code units, int32
    wrap-around.  A character above U+FFFF is two units."""
    s = _c(col)
    points = F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("long"))
    two = lambda acc, c: (acc * F.lit(961) + (F.lit(0xD800) + F.shiftright(c - 0x10000, 10)) * 31
                          + F.lit(0xDC00) + (c - 0x10000).bitwiseAND(0x3FF))
    h = F.aggregate(points, F.lit(0).cast("long"),
                    lambda acc, c: F.when(c > 0xFFFF, two(acc, c)).otherwise(acc * F.lit(31) + c) % F.lit(4294967296))
    return F.when(s == "", F.lit(0)).otherwise(to_int32(h))


def to_int32(v: Column) -> Column:
    """Wrap a long into the signed 32-bit range."""
    m = F.pmod(v, F.lit(4294967296))
    return F.when(m >= F.lit(2147483648), m - F.lit(4294967296)).otherwise(m).cast("int")


def scaled_hash(col, factor: int) -> Column:
    """Parameterised scalar function: ``hash(s) * factor - 1000`` in int32."""
    return to_int32(java_string_hash(col).cast("long") * F.lit(factor) - F.lit(1000))


def normalize_part(col) -> Column:
    s = F.upper(_c(col))
    return F.trim(F.regexp_replace(F.regexp_replace(s, r"\W", " "), r"\s+", " "))


def normalize_address(street, zip_code, city) -> Column:
    """Three-argument address normalizer: upper, non-word -> space,
    collapse spaces, trim, joined with ``", "``."""
    return F.concat(normalize_part(street), F.lit(", "), normalize_part(zip_code),
                    F.lit(", "), normalize_part(city))

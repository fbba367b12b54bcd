"""Scalar text functions with the semantics of Python's ``str`` methods, as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space for ``str.isspace``, as a Java character class body.
WS = "\\t-\\r\\x1c-\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: The same characters as they are.
SPACES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(c: Column) -> Column:
    """Both ends without Unicode white space (``F.trim`` removes spaces only)."""
    return F.btrim(c, F.lit(SPACES))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACES))


def collapse_space(c: Column) -> Column:
    return F.regexp_replace(c, f"[{WS}]+", " ")


def collapse_newlines(c: Column) -> Column:
    return F.regexp_replace(c, "\n{3,}", "\n\n")


def word_count(c: Column) -> Column:
    """Runs of characters that are no white space; splitting is cheaper than counting matches."""
    bare = strip(c)
    return F.when(bare == "", 0).otherwise(F.size(F.split(bare, f"[{WS}]+"))).cast("int")


def once(rows: DataFrame, keep: list[str], **columns: Column) -> DataFrame:
    """The kept columns and the new ones, each of which is computed once per row.

    A generator over one struct is a bound that projections and filters are not folded through, so what
    follows reads the values instead of repeating their expressions.
    """
    return rows.select(*keep, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def count_char(c: Column, ch: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(ch), F.lit("")))


def any_of(c: Column, phrases: list[str] | tuple[str, ...]) -> Column:
    """True if one of the phrases is a substring; literal tests, no regular expression."""
    return reduce(lambda a, b: a | b, [F.contains(c, F.lit(p)) for p in phrases])


def head(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def tail(c: Column, n: int) -> Column:
    return F.right(c, F.lit(n))


def md5_text(c: Column) -> Column:
    return F.md5(F.encode(c, "utf-8"))


def problem_hash(c: Column) -> Column:
    """SHA-256 of the text stripped, with white space collapsed, in lower case."""
    return F.sha2(F.lower(collapse_space(strip(c))), 256)


def estimate_tokens(c: Column) -> Column:
    return F.floor(F.length(c) / 4).cast("int")


def answer_budget(partial: Column) -> Column:
    """Tokens left for a completion: 4000 less the estimate and 200, between 800 and 3000."""
    return F.greatest(F.lit(800), F.least(F.lit(3000), F.lit(3800) - estimate_tokens(partial))).cast("int")

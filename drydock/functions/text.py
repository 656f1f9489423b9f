"""String expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from drydock.config import NULL_TOKENS, WHITESPACE

_BLANKS = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]+"


def strip(c: Column) -> Column:
    """Remove white space at both ends (all of Unicode's, not only spaces)."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper_strip(c: Column) -> Column:
    return strip(F.upper(c))


def collapse_blanks(c: Column) -> Column:
    """Turn every run of white space into one space, and strip the ends."""
    return strip(F.regexp_replace(c, _BLANKS, " "))


def blank_to_null(c: Column) -> Column:
    """Null for a value which is empty once stripped; others are kept as is."""
    return F.when(strip(c) != "", c)


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/*$", 1)


def stem(path: Column) -> Column:
    """File name without its last extension (``a.tar.gz`` gives ``a.tar``)."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def contains_any(c: Column, words: Iterable[str]) -> Column:
    """True where the text contains one of the words."""
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def without_label(c: Column, label: str) -> Column:
    """Drop every occurrence of a label, then strip."""
    return strip(F.replace(c, F.lit(label), F.lit("")))


def before_parenthesis(c: Column) -> Column:
    return strip(F.substring_index(c, "(", 1))


def is_page_number(c: Column, max_digits: int) -> Column:
    """A line of digits only, and few of them."""
    digits = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}"
    return c.rlike(rf"\A[{digits}]{{1,{max_digits}}}\z")


def null_tokens(c: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Null for a text which is one of the tokens (exact match)."""
    tokens = list(tokens)
    longest = max((len(t.encode()) for t in tokens), default=0)
    return F.when((F.octet_length(c) > longest) | ~c.isin(tokens), c)


def glob_to_regex(pattern: str) -> str:
    """A file-name pattern (``*``, ``?``) as a regular expression."""
    parts = (".*" if ch == "*" else "." if ch == "?" else re.escape(ch) for ch in pattern)
    return r"\A" + "".join(parts) + r"\z"


def is_csv_member(member: Column) -> Column:
    return F.lower(member).endswith(".csv")


def decode_text(content: Column) -> Column:
    """Bytes to text: UTF-8 when all of it is valid, else ISO-8859-1.

    A leading byte-order mark is dropped.
    """
    utf8 = F.decode(content, "UTF-8")
    utf8 = F.when(utf8.startswith("\ufeff"), F.substring(utf8, 2, 2**31 - 1)).otherwise(utf8)
    return F.when(F.is_valid_utf8(content.cast("string")), utf8).otherwise(
        F.decode(content, "ISO-8859-1"))


def megabytes(size: Column) -> Column:
    return size.cast("double") / F.lit(1048576.0)


def megabytes_text(size: Column, digits: int) -> Column:
    """Megabytes with a fixed number of decimals, ties going to the even digit."""
    return F.format_string(f"%.{digits}f", F.bround(megabytes(size), digits))

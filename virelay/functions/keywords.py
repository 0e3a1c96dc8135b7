"""Keyword rules as Java regular expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Keywords that match as whole words only.
WHOLE_WORDS = ("lysin", "adp")
EXACT_ENZYME = re.compile(r"EC[:\s](?P<number>\d+\.\d+\.\d+\.\d+)")


def quoted(text: str) -> str:
    """``text`` as a literal in a Java pattern."""
    return re.sub(r"([^\w\s])", r"\\\1", text, flags=re.ASCII) if text.isascii() else "".join(c if c.isalnum() or c.isspace() else "\\" + c for c in text)


def pattern_of(keyword: str) -> str:
    """A keyword's pattern, without flags: whole word, exact enzyme number or plain substring."""
    if keyword.lower() in WHOLE_WORDS:
        return rf"\b{quoted(keyword.lower())}\b"
    if enzyme := EXACT_ENZYME.fullmatch(keyword):
        return rf"\bEC[:\s]{quoted(enzyme['number'])}\b"
    return quoted(keyword)


def any_of(keywords: list[str]) -> str | None:
    """One case-insensitive alternation of all keywords; None without keywords."""
    return "(?iu)(?:" + "|".join(pattern_of(k) for k in keywords) + ")" if keywords else None


def matches(text: Column, pattern: str | None) -> Column:
    """Whether ``text`` holds a match; false for null."""
    return F.lit(False) if pattern is None else F.coalesce(F.regexp_like(text, F.lit(pattern)), F.lit(False))


def any_column(flags: list[Column]) -> Column:
    """Or of flags as a balanced tree."""
    if not flags:
        return F.lit(False)
    while len(flags) > 1:
        flags = [flags[i] | flags[i + 1] if i + 1 < len(flags) else flags[i] for i in range(0, len(flags), 2)]
    return flags[0]

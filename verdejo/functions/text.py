"""Comparable text for names, as native column expressions.

Rule: lower case, compatibility decomposition, drop combining marks, every
character outside a-z, 0-9 and space becomes a space, spaces collapse. The
folding tables are generated from the Unicode database of the Python runtime.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_KEPT = frozenset("abcdefghijklmnopqrstuvwxyz0123456789 ")


@lru_cache(maxsize=1)
def _folds() -> tuple[dict[str, str], list[str], dict[str, str]]:
    """(one-to-one folds, dropped marks, one-to-many folds)."""
    single: dict[str, str] = {}
    dropped: list[str] = []
    several: dict[str, str] = {}
    for code in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if unicodedata.combining(char):
            dropped.append(char)
            continue
        parts = unicodedata.normalize("NFKD", char)
        if parts == char:
            continue
        left = "".join(p if p in _KEPT else " " for p in parts if not unicodedata.combining(p))
        if not left:
            dropped.append(char)
        elif left.strip() and len(left) == 1:
            single[char] = left
        elif left.strip():
            several[char] = left
    return single, dropped, several


def _char_class(chars) -> str:
    """A short regex class that covers the characters; small gaps are closed."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code - spans[-1][1] <= 8:
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def _fold_several(c: Column, several: dict[str, str]) -> Column:
    """Ligatures, fractions and enclosed letters; rare, so only on rows that have one."""
    pairs = "\x01".join(f"{char}\x02{spelled}" for char, spelled in several.items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    marks = _char_class(several)
    spelled = F.array_join(
        F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(table, ch), ch)), ""
    )
    return F.when(c.rlike(marks), spelled).otherwise(c)


def normal_form(c: str | Column) -> Column:
    """Name without accents, punctuation, capitals or double spaces; NULL gives ''."""
    text = F.lower(F.col(c) if isinstance(c, str) else c)
    single, dropped, several = _folds()
    folded = F.translate(_fold_several(text, several), "".join(single) + "".join(dropped), "".join(single.values()))
    # Pure ASCII, where bytes and characters agree, has nothing to fold.
    text = F.when(F.octet_length(text) == F.length(text), text).otherwise(folded)
    return F.coalesce(F.trim(F.regexp_replace(text, "[^a-z0-9]+", " ")), F.lit(""))


def tight_key(c: str | Column) -> Column:
    """The normal form with every space removed."""
    return F.replace(normal_form(c), F.lit(" "), F.lit(""))

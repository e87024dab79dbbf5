"""Text expressions: blank test, tokens, previews, term look-ups."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from functools import lru_cache
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip() takes for white space.
BLANK = r"\A[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]*\z"

# Fixed value: longest input of the classifier, in tokens.
MAX_TOKENS = 512

TOKEN_BREAK = "[^a-z0-9]+"
_TOKEN = re.compile("[a-z0-9]+")


def is_blank(text: Column) -> Column:
    """True for null, empty and all-white-space text."""
    return text.isNull() | text.rlike(BLANK)


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits, in order."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda t: t != "")


def distinct_tokens(text: Column) -> Column:
    """Each token once, in order of first use; one of them may be empty."""
    return F.array_distinct(F.split(F.lower(text), TOKEN_BREAK))


def normalize(text: Column) -> Column:
    """Lower-case text with every other run of characters turned into one space."""
    return F.trim(F.regexp_replace(F.lower(text), TOKEN_BREAK, " "))


def first_tokens(words: Column, limit: int = MAX_TOKENS) -> Column:
    """The classifier's view of a long text: its first ``limit`` tokens."""
    return F.slice(words, 1, limit)


def preview(text: Column, width: int = 50) -> Column:
    return F.substring(text, 1, width)


def preview_ellipsis(text: Column, width: int = 60) -> Column:
    """A preview that ends in dots only if something was cut off."""
    return F.when(F.length(text) > width, F.concat(preview(text, width), F.lit("..."))).otherwise(text)


def _checked(terms: Sequence[str]) -> tuple[str, ...]:
    terms = tuple(dict.fromkeys(terms))
    if not terms:
        raise ValueError("the term list is empty")
    bad = [t for t in terms if not _TOKEN.fullmatch(t)]
    if bad:
        raise ValueError(f"terms must be lower-case ASCII tokens, got {bad[:3]}")
    return terms


def _any_of(terms: list[str]) -> str:
    """Regex for any of the sorted terms, with shared beginnings written once.

    A match then takes as many steps as the token has letters, however long the list is.
    """
    branches = []
    for _, same in groupby(terms, key=lambda t: t[:1]):
        same = list(same)
        start = os.path.commonprefix(same)
        rest = [t[len(start):] for t in same]
        branches.append(start if len(rest) == 1 else start + _any_of(rest))
    if branches[0]:
        return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"
    return f"(?:{'|'.join(branches[1:])})?"


@lru_cache(maxsize=16)
def _whole_token(terms: tuple[str, ...]) -> str:
    """Regex for one of the terms as a whole token; the first test rules out most positions."""
    initials = "".join(sorted({t[0] for t in terms}))
    return f"(?=[{initials}])(?<![a-z0-9])({_any_of(sorted(terms))})(?![a-z0-9])"


def count_terms(text: Column, terms: Sequence[str]) -> Column:
    """How many tokens of the text are in the list, which may have any length."""
    return F.regexp_count(F.lower(text), F.lit(_whole_token(_checked(terms))))


def _checked_phrases(phrases: Sequence[str]) -> tuple[str, ...]:
    phrases = tuple(dict.fromkeys(phrases))
    if not phrases:
        raise ValueError("the phrase list is empty")
    bad = [p for p in phrases if not all(_TOKEN.fullmatch(t) for t in p.split(" "))]
    if bad:
        raise ValueError(f"phrases must be lower-case ASCII tokens with single spaces between them, got {bad[:3]}")
    return phrases


def first_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """The first listed phrase of the text, the longest of those that begin at the same token, else null.

    A phrase is one or more tokens in a row, whatever stands between them in the text. The list is a trie
    in which a longer phrase is tried before the shorter one that begins it.
    """
    return F.nullif(F.regexp_extract(normalize(text), _whole_token(_checked_phrases(phrases)), 1), F.lit(""))


def first_term(text: Column, terms: Sequence[str]) -> Column:
    """The first token of the text that is in the list, else null."""
    return F.nullif(F.regexp_extract(F.lower(text), _whole_token(_checked(terms)), 1), F.lit(""))

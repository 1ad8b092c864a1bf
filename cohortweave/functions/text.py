"""Text predicates and normalisers as built-in column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace at a text's ends.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0     　" + "".join(
    chr(code) for code in range(0x2000, 0x200B)
)


def strip(text: Column) -> Column:
    """Remove all whitespace at both ends (SQL ``trim`` removes spaces only)."""
    return F.btrim(text, F.lit(WHITESPACE))


def collapse_whitespace(text: Column) -> Column:
    """Trimmed text in which every run of whitespace is one space.

    Pure ASCII text takes the cheaper way, without the character table.
    """
    plain = F.regexp_replace(text, r"[\s\x1c-\x1f]+", " ")
    mapped = F.regexp_replace(F.translate(text, WHITESPACE, " " * len(WHITESPACE)), " {2,}", " ")
    return F.trim(F.when(F.octet_length(text) == F.char_length(text), plain).otherwise(mapped))


def has_whitespace(tokens: Iterable[str]) -> bool:
    return any(ch in WHITESPACE for token in tokens for ch in token)


def any_of(conditions: Iterable[Column]) -> Column:
    """OR of the conditions; false for none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def is_blank(text: Column) -> Column:
    return text.isNull() | (strip(text) == "")


def code_key(code: Column) -> Column:
    """Comparable form of a code: trimmed, upper case, without dots."""
    return F.translate(F.upper(strip(code)), ".", "")


def has_code_prefix(key: Column, prefixes: Sequence[str]) -> Column:
    """True when ``code_key`` output starts with any prefix; NULL codes never match."""
    wanted = sorted({p.upper().replace(".", "") for p in prefixes})
    return F.coalesce(any_of(key.startswith(p) for p in wanted), F.lit(False))


def contains_any(text: Column, tokens: Sequence[str]) -> Column:
    return any_of(F.contains(text, F.lit(t)) for t in tokens)


def canonical_name(
    text: Column, patterns: Sequence[str], aliases: Sequence[tuple[str, Sequence[str]]]
) -> Column:
    """Canonical medication name of a lower-cased, collapsed text, or NULL.

    The text must contain a pattern. Aliases are tried first, then the patterns
    in their given order.
    """
    matched = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        matched = F.when(F.contains(text, F.lit(pattern)), F.lit(pattern)).otherwise(matched)
    for canonical, tokens in reversed(aliases):
        # An alias only counts on a text that some pattern admits. A token that is
        # itself a pattern (or holds one) admits the text, so no second test is run.
        self_admitting = all(any(p in t for p in patterns) for t in tokens)
        hit = contains_any(text, tokens)
        if not self_admitting:
            hit = hit & contains_any(text, patterns)
        matched = F.when(hit, F.lit(canonical)).otherwise(matched)
    return matched


IDENTIFIER_MODES = ("identity", "lower", "subject_to_patient")


def normalize_identifier(identifier: Column, mode: str = "identity") -> Column:
    """Trimmed identifier, NULL when blank."""
    if mode not in IDENTIFIER_MODES:
        raise ValueError(f"Unsupported identity normalization_mode: {mode}")
    text = F.nullif(strip(identifier.cast("string")), F.lit(""))
    return F.lower(text) if mode == "lower" else text


def null_if_na(text: Column, tokens: Sequence[str]) -> Column:
    return F.when(~text.isin(list(tokens)), text)


# Accepted spellings of the two label classes.
TRUE_WORDS = ("1", "true", "yes", "y")
FALSE_WORDS = ("0", "false", "no", "n")


def label_class(value: Column) -> Column:
    """'1' or '0' for an accepted spelling; any other value fails the query."""
    word = F.lower(strip(F.coalesce(value.cast("string"), F.lit(""))))
    return (
        F.when(word.isin(*TRUE_WORDS), F.lit("1"))
        .when(word.isin(*FALSE_WORDS), F.lit("0"))
        .otherwise(
            F.raise_error(F.concat(F.lit("Unexpected label value: "), F.coalesce(value.cast("string"), F.lit("NULL"))))
        )
    )


def joined(items: Sequence[Column], separator: str = "|") -> Column:
    """Join the non-null items in order; '' when there are none."""
    return F.array_join(F.array_compact(F.array(*items)), separator)

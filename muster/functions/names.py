"""Entity names: normal form, block token, similarity threshold, identifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from muster.defaults import GENERIC_TOKENS, MERGE_SUFFIXES, MISSING_ID_TEXTS, RESOLVE_SUFFIXES
from muster.functions.exprs import safe_double, strip

# Letters and digits of any script; everything else separates words.
_WORD_BREAK = r"[^\p{L}\p{N}_]+"
_ASCII_WORD_BREAK = r"[^a-z0-9]+"


def normalize_name(
    name: Column, suffixes: Sequence[str] = MERGE_SUFFIXES, ascii_only: bool = False
) -> Column:
    """Lower-case words of ``name`` without legal-form words, one blank apart; null gives ''."""
    words = F.split(
        F.lower(F.coalesce(name, F.lit(""))), _ASCII_WORD_BREAK if ascii_only else _WORD_BREAK
    )
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*suffixes)), " ")


def resolve_name(name: Column) -> Column:
    """Normal form used for duplicates, merge groups and exclusion lists."""
    return normalize_name(name, RESOLVE_SUFFIXES)


def block_token(norm: Column, generic: Sequence[str] = GENERIC_TOKENS) -> Column:
    """First word of a normalized name that is not generic, else its first word, else ''."""
    words = F.split(norm, " ")
    telling = F.filter(words, lambda w: ~w.isin(*generic))
    return F.coalesce(F.get(telling, F.lit(0)), F.get(words, F.lit(0)), F.lit(""))


def token_count(norm: Column) -> Column:
    return F.when(norm == "", 0).otherwise(F.size(F.split(norm, " ")))


def similarity_threshold(
    tokens_a: Column, tokens_b: Column, short: float = 0.95, long: float = 0.92, limit: int = 2
) -> Column:
    """Short names need the higher similarity; the longer name of a pair decides."""
    return F.when(F.greatest(tokens_a, tokens_b) <= limit, F.lit(short)).otherwise(F.lit(long))


def is_missing(identifier: Column) -> Column:
    text = strip(identifier.cast("string"))
    return F.coalesce(text.isin(*MISSING_ID_TEXTS), F.lit(True))


def present_id(identifier: Column) -> Column:
    """The identifier's trimmed text, or null when it is missing."""
    return F.when(~is_missing(identifier), strip(identifier.cast("string")))


def cik_text(cik: Column) -> Column:
    """Registry number as digits, whether it came as text, integer or float."""
    return safe_double(cik).try_cast("bigint").cast("string")

"""Tokenisation and n-grams as built-in array expressions.

Two tokenisers exist, as in the reference:

* ``code_tokens`` - identifiers, integers and single symbols.  The symbol
  class is written ``[^\\\\s\\\\w]`` (doubled backslashes inside a raw string),
  so it means "any character except backslash, ``s`` and ``w``": whitespace
  characters *are* tokens and backslashes vanish.  Kept as is.
* ``word_tokens`` - the TF-IDF analyser: lower-case, runs of 2+ word
  characters (Unicode letters, digits, underscore).

N-grams are built with ``zip_with`` over shifted slices inside one lambda
scope, so the tokenising regex runs once per row even when Catalyst would
otherwise inline the token column into every use.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------
CODE_TOKEN_PATTERN = r"[a-zA-Z_][a-zA-Z0-9_]*|[0-9]+|[^\\s\\w]"
WORD_TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"          # Java / RE2 spelling
WHITESPACE_TOKEN_PATTERN = r"^\s$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def code_tokens(c, drop_whitespace: bool = False) -> Column:
    toks = F.regexp_extract_all(F.coalesce(_as_col(c), F.lit("")), F.lit(CODE_TOKEN_PATTERN), F.lit(0))
    if drop_whitespace:
        toks = F.filter(toks, lambda t: ~t.rlike(WHITESPACE_TOKEN_PATTERN))
    return toks


def word_tokens(c, lowercase: bool = True) -> Column:
    text = F.coalesce(_as_col(c), F.lit(""))
    if lowercase:
        text = F.lower(text)
    return F.regexp_extract_all(text, F.lit(WORD_TOKEN_PATTERN), F.lit(0))


def _ngrams_of(toks: Column, n: int) -> Column:
    """n-grams of order ``n`` of an array column, joined by one space."""
    if n == 1:
        return toks
    m = F.greatest(F.size(toks) - (n - 1), F.lit(0))
    out = F.slice(toks, 1, m)
    for k in range(1, n):
        out = F.zip_with(out, F.slice(toks, k + 1, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return out


def ngrams(tokens, n_min: int = 1, n_max: int = 3) -> Column:
    """All n-grams with ``n_min <= n <= n_max`` of an array column.

    The token array is bound once through a one-element ``transform`` so that
    an expensive producer (a regex) is not re-evaluated per reference."""
    if n_min < 1 or n_max < n_min:
        raise ValueError("need 1 <= n_min <= n_max")
    bound = F.array(_as_col(tokens))

    def build(toks):
        parts = [_ngrams_of(toks, n) for n in range(n_min, n_max + 1)]
        return parts[0] if len(parts) == 1 else F.concat(*parts)

    return F.element_at(F.transform(bound, build), 1)


def encode_ids(ids, max_length: int = 512, pad_id: int = 0) -> Column:
    """Truncate an id array to ``max_length`` and right-pad with ``pad_id``
    to exactly ``max_length``; returns ``struct(input_ids, attention_mask)``."""
    ids = _as_col(ids)
    cut = F.slice(ids, 1, max_length)
    pad = F.greatest(F.lit(max_length) - F.size(cut), F.lit(0))
    input_ids = F.concat(cut, F.array_repeat(F.lit(pad_id), pad))
    mask = F.concat(F.array_repeat(F.lit(1), F.size(cut)), F.array_repeat(F.lit(0), pad))
    return F.struct(input_ids.alias("input_ids"), mask.alias("attention_mask"))


# --- oracle side (DuckDB) -------------------------------------------------
def sql_code_tokens(expr: str) -> str:
    return f"regexp_extract_all(coalesce({expr}, ''), '{CODE_TOKEN_PATTERN}', 0)"


def sql_word_tokens(expr: str) -> str:
    return f"regexp_extract_all(lower(coalesce({expr}, '')), '{WORD_TOKEN_PATTERN}', 0)"

"""Label normalisation expressions and the fixed class / alias lists."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's label handling) --------------
# The eight target classes, in the reference's declaration order.
LANGUAGES = ["python", "javascript", "java", "cpp", "go", "rust", "sql", "htmlcss"]

# Aliases applied to lower-cased labels read from CSV sources; labels that are
# not listed pass through unchanged.
LANGUAGE_ALIASES = {
    "cpp": "cpp",
    "c++": "cpp",
    "python": "python",
    "javascript": "javascript",
    "js": "javascript",
    "java": "java",
    "go": "go",
    "golang": "go",
    "rust": "rust",
    "sql": "sql",
    "html": "htmlcss",
    "css": "htmlcss",
    "htmlcss": "htmlcss",
}

# Q&A-site tag -> class; unmapped tags have no class.
TAG_TO_LANGUAGE = {
    "python": "python",
    "javascript": "javascript",
    "java": "java",
    "c++": "cpp",
    "cpp": "cpp",
    "c-plus-plus": "cpp",
    "go": "go",
    "golang": "go",
    "rust": "rust",
    "sql": "sql",
    "html": "htmlcss",
    "css": "htmlcss",
    "html-css": "htmlcss",
}

# Hello-world index: requested language name -> label written (in this order).
HELLO_WORLD_TARGETS = [
    ("JavaScript", "javascript"),
    ("Java", "java"),
    ("Go", "go"),
    ("Rust", "rust"),
    ("SQL", "sql"),
    ("HTML", "html"),
    ("C#", "csharp"),
]


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def map_literal(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def normalize_label(c, aliases: dict | None = None) -> Column:
    """lower-case, then alias lookup; unmapped labels pass through."""
    low = F.lower(_as_col(c))
    return F.coalesce(F.try_element_at(map_literal(aliases or LANGUAGE_ALIASES), low), low)


def map_tag(c, tags: dict | None = None) -> Column:
    """Tag -> class; null when the tag is not mapped."""
    return F.try_element_at(map_literal(tags or TAG_TO_LANGUAGE), _as_col(c))


def sql_map_case(expr: str, mapping: dict, default: str = "NULL") -> str:
    """Oracle twin of a map lookup (a CASE over the same literal pairs)."""
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {default} END)"

"""Snippet cleaning as built-in column expressions (no UDF).

The cleaning is a fixed chain of regular-expression replacements; the order
matters (comments are removed before string literals, so ``"https://x"`` is
cut at ``//``; runs of 3+ newlines are squeezed before each line is
stripped, so blank lines holding spaces survive as empty lines).

Each step is kept in ``STEPS`` with the Java pattern Spark runs and the RE2
pattern the DuckDB oracle runs, side by side.  Java differs from Python in
two places that matter here:

* ``(?d)`` (UNIX_LINES) is needed so ``.``, ``^`` and ``$`` only treat ``\\n``
  as a line end, as Python does (Java would also stop at ``\\r``, U+0085,
  U+2028 and U+2029).
* the quoted-literal patterns must be possessive: the backtracking form
  recurses once per escape and overflows the stack on long inputs.

Two Spark-side patterns are cheaper equivalents of the oracle's: the line
right-strip is possessive (a shorter blank run is never followed by a line
end, so backtracking cannot find a match) and rules out most characters by two
ranges, and the final strip is a trim of newlines (see ``_apply``).  A step runs
only on texts that hold its ``marker`` or, for the line strips, a blank beside a
line end; the others pass unchanged, without being decoded for a pattern.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's cleaning semantics) ----------
# Python's str.strip() whitespace set, as a Java/RE2 character class body.
_WS_JAVA = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WSN_JAVA = r"\t\x0b-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_WS_RE2 = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WSN_RE2 = r"\t\x0b-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


@dataclass(frozen=True)
class Step:
    name: str
    java: str        # pattern for Spark's regexp_replace (java.util.regex)
    re2: str         # pattern for the DuckDB oracle (RE2)
    replacement: str
    py: str          # pattern for Python's re (the tests' third statement)
    closer: str = ""  # a match must end with this text
    marker: str = ""  # a match must hold this text


# Strict order of the cleaning chain (fixed values).
STEPS: tuple[Step, ...] = (
    Step("block_comments", r"(?s)/\*.*?\*/", r"(?s)/\*.*?\*/", "", r"(?s)/\*.*?\*/", "*/", "/*"),
    Step("slash_comments", r"(?md)//.*$", r"(?m)//.*$", "", r"(?m)//.*$", marker="//"),
    Step("hash_comments", r"(?md)#.*$", r"(?m)#.*$", "", r"(?m)#.*$", marker="#"),
    Step("html_comments", r"(?s)<!--.*?-->", r"(?s)<!--.*?-->", "", r"(?s)<!--.*?-->", "-->", "<!--"),
    Step("triple_double", r'(?s)""".*?"""', r'(?s)""".*?"""', '""', r'(?s)""".*?"""', marker='"""'),
    Step("triple_single", r"(?s)'''.*?'''", r"(?s)'''.*?'''", "''", r"(?s)'''.*?'''", marker="'''"),
    Step("double_quoted", r'(?d)"[^"\\]*+(?:\\.[^"\\]*+)*+"', r'"[^"\\]*(?:\\.[^"\\]*)*"', '""', r'"[^"\\]*(?:\\.[^"\\]*)*"', marker='"'),
    Step("single_quoted", r"(?d)'[^'\\]*+(?:\\.[^'\\]*+)*+'", r"'[^'\\]*(?:\\.[^'\\]*)*'", "''", r"'[^'\\]*(?:\\.[^'\\]*)*'", marker="'"),
    Step("squeeze_newlines", r"\n{3,}", r"\n{3,}", "\n\n", r"\n{3,}", marker="\n\n\n"),
    Step("line_lstrip", rf"(?md)^[{_WSN_JAVA}]+", rf"(?m)^[{_WSN_RE2}]+", "", r"(?m)^[^\S\n]+"),
    Step("line_rstrip", rf"(?md)[\t-\x20\x85-\u3000&&[{_WSN_JAVA}]]++$", rf"(?m)[{_WSN_RE2}]+$", "", r"(?m)[^\S\n]+$"),
    Step("strip", rf"\A[{_WS_JAVA}]+|[{_WS_JAVA}]+\z", rf"\A[{_WS_RE2}]+|[{_WS_RE2}]+\z", "", r"\A\s+|\s+\Z"),
)

STEP_GROUPS: dict[str, tuple[str, ...]] = {
    "block_comments": ("block_comments",),
    "line_comments": ("slash_comments", "hash_comments"),
    "html_comments": ("html_comments",),
    "string_literals": ("triple_double", "triple_single", "double_quoted", "single_quoted"),
    "whitespace": ("squeeze_newlines", "line_lstrip", "line_rstrip", "strip"),
}


# A blank beside a line end, in a text between two line ends.
_LINE_BLANK = rf"\n(?:(?<=[{_WSN_JAVA}]\n)|(?=[{_WSN_JAVA}]))"


def _apply(col: Column, names) -> Column:
    """The steps in order; one-element arrays bind the text of each step once."""
    by_name = {s.name: s for s in STEPS}
    names, texts, i = list(names), F.array(col), 0
    while i < len(names):
        if names[i:i + 2] == ["line_lstrip", "line_rstrip"]:
            texts, i = F.transform(texts, _line_strips(by_name[names[i]], by_name[names[i + 1]])), i + 2
            if names[i:i + 1] == ["strip"]:
                # After both per-line strips every line is empty or starts and
                # ends with a non-space, so the only whitespace left at either
                # end of the text is newlines (leading / trailing empty lines):
                # a linear trim of '\n' is the same as the full strip.
                texts, i = F.transform(texts, lambda t: F.btrim(t, F.lit("\n"))), i + 1
            continue
        texts, i = F.transform(texts, _replaced(by_name[names[i]])), i + 1
    return F.element_at(texts, 1)


def _replaced(s: Step):
    def run(t: Column) -> Column:
        done = _up_to_closer(t, s) if s.closer else F.regexp_replace(t, F.lit(s.java), F.lit(s.replacement))
        return F.when(t.contains(s.marker), done).otherwise(t) if s.marker else done
    return run


def _line_strips(left: Step, right: Step):
    def run(t: Column) -> Column:
        blank = F.concat(F.lit("\n"), t, F.lit("\n")).rlike(_LINE_BLANK)
        return F.when(blank, _replaced(right)(_replaced(left)(t))).otherwise(t)
    return run


def _up_to_closer(col: Column, s: Step) -> Column:
    """A lazy pattern searches the whole rest of the text from every opener
    that is never closed.  Only text up to the last closer can hold a match, so
    the pattern runs there and the tail is put back unchanged: linear.  The
    one-element array binds the text once."""
    def split(t):
        tail = F.substring_index(t, s.closer, -1)
        head = F.left(t, F.length(t) - F.length(tail))
        return F.concat(F.regexp_replace(head, F.lit(s.java), F.lit(s.replacement)), tail)
    return F.element_at(F.transform(F.array(col), split), 1)


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_block_comments(c) -> Column:
    return _apply(_as_col(c), STEP_GROUPS["block_comments"])


def remove_line_comments(c) -> Column:
    return _apply(_as_col(c), STEP_GROUPS["line_comments"])


def remove_html_comments(c) -> Column:
    return _apply(_as_col(c), STEP_GROUPS["html_comments"])


def remove_string_literals(c) -> Column:
    return _apply(_as_col(c), STEP_GROUPS["string_literals"])


def normalize_whitespace(c) -> Column:
    return _apply(_as_col(c), STEP_GROUPS["whitespace"])


def clean_text(c) -> Column:
    """The whole chain; a null or non-string input becomes ``''``."""
    return _apply(F.coalesce(_as_col(c).cast("string"), F.lit("")), [s.name for s in STEPS])


# --- oracle side: the same chain as a DuckDB SQL expression ----------------
def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_repl(s: str) -> str:
    if s == "\n\n":
        return "chr(10)||chr(10)"
    return _sql_str(s)


def sql_chain(expr: str, names) -> str:
    by_name = {s.name: s for s in STEPS}
    for name in names:
        s = by_name[name]
        expr = f"regexp_replace({expr}, {_sql_str(s.re2)}, {_sql_repl(s.replacement)}, 'g')"
    return expr


def sql_group(expr: str, group: str) -> str:
    return sql_chain(expr, STEP_GROUPS[group])


def sql_clean_text(expr: str) -> str:
    return sql_chain(f"coalesce(CAST({expr} AS VARCHAR), '')", [s.name for s in STEPS])

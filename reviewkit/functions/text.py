"""Text cleaning as native column expressions.

Cleaning runs in this fixed order: CJK punctuation -> ``{html}`` marker -> tags ->
URLs -> ASCII digits -> Unicode strip. Every rule is a JVM expression, so it stays
inside whole-stage code generation; no Python runs per row.

Regex dialect notes (the expressions must equal Python's ``re`` results):

* ``.`` in Java stops at ``\\r``, U+0085, U+2028, U+2029 as well as ``\\n``; the
  ``(?d)`` flag (UNIX_LINES) limits it to ``\\n`` as in Python.
* Java's ``\\S`` and SQL ``trim`` know only ASCII whitespace, so the Python
  whitespace set is spelled out. ``\\x{..}`` escapes are read the same way by Java
  and by RE2, so one pattern string serves Spark and the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -------------------------
# Code-point ranges Python's str.isspace() / re's \s accept, in order.
WHITESPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F),
    (0x3000, 0x3000),
]
# CJK symbols and punctuation, half- and full-width forms: each char -> one space.
CJK_PUNCT_RANGES = [(0x3000, 0x303F), (0xFF00, 0xFFEF)]
HTML_MARKER = "{html}"
# -----------------------------------------------------------------------------


def _char_class(ranges, negate: bool = False) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:x}}}" if lo == hi else f"\\x{{{lo:x}}}-\\x{{{hi:x}}}")
    return "[" + ("^" if negate else "") + "".join(parts) + "]"


def whitespace_chars() -> str:
    """All whitespace characters as one string (for character-set trim)."""
    return "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))


CJK_PUNCT_RE = _char_class(CJK_PUNCT_RANGES)
NON_SPACE_RE = _char_class(WHITESPACE_RANGES, negate=True)
TAG_RE_JAVA = "(?d)<.*?>"           # shortest tag, never across \n
TAG_RE_RE2 = "<.*?>"                # RE2's '.' already stops only at \n
URL_RE = "http" + NON_SPACE_RE + "+"
DIGITS_RE = "[0-9]+"
LETTER_RUN_RE = "\\p{L}+"          # token = maximal run of Unicode letters
WS_CHARS = whitespace_chars()


def to_text(c: Column) -> Column:
    """Cast to string."""
    return c.cast("string")


def replace_cjk_punct(c: Column) -> Column:
    """CJK punctuation and full-width forms -> one space each."""
    return F.regexp_replace(c, CJK_PUNCT_RE, " ")


def remove_html_marker(c: Column) -> Column:
    """Drop the literal ``{html}``."""
    return F.replace(c, F.lit(HTML_MARKER), F.lit(""))


def strip_tags(c: Column) -> Column:
    """Remove ``<...>`` (shortest match, not across a newline)."""
    return F.regexp_replace(c, TAG_RE_JAVA, "")


def strip_urls(c: Column) -> Column:
    """T4: remove ``http`` followed by non-whitespace (Unicode whitespace ends it)."""
    return F.regexp_replace(c, URL_RE, "")


def strip_digits(c: Column) -> Column:
    """T5: remove ASCII digit runs."""
    return F.regexp_replace(c, DIGITS_RE, "")


def strip_space(c: Column) -> Column:
    """Strip Unicode whitespace at both ends (character-set trim)."""
    return F.btrim(c, F.lit(WS_CHARS))


PROFILES = {
    "full": (to_text, replace_cjk_punct, remove_html_marker, strip_tags, strip_urls,
             strip_digits, strip_space),
    "punct_only": (to_text, replace_cjk_punct, strip_space),
    "strip_only": (to_text, strip_space),
    "none": (to_text,),
}


def clean_text(c: Column, profile: str = "full") -> Column:
    """Apply a cleaning profile (``full``, ``punct_only``, ``strip_only``, ``none``)."""
    if profile not in PROFILES:
        raise ValueError(f"unknown cleaning profile {profile!r}; use one of {sorted(PROFILES)}")
    for step in PROFILES[profile]:
        c = step(c)
    return c


def letter_tokens(c: Column) -> Column:
    """Maximal runs of Unicode letters, in text order (array<string>)."""
    return F.regexp_extract_all(c, F.lit(LETTER_RUN_RE), 0)


def token_count(tokens: Column) -> Column:
    """Number of tokens."""
    return F.size(tokens)


def tokens_to_json(tokens: Column) -> Column:
    """Token list as JSON text."""
    return F.to_json(tokens)


def tokens_from_json(c: Column) -> Column:
    """Inverse of T13."""
    return F.from_json(c, "array<string>")


# --- the same rules in DuckDB SQL, for the oracle queries ---------------------

def sql_ws_chars() -> str:
    """DuckDB expression for the whitespace character set."""
    return " || ".join(
        f"chr({c})" for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))


def _duck_literal(s: str) -> str:
    return "'" + s + "'"


# Cleaning steps as (SQL template, pattern) of one dialect; {e} is the text, {p} the pattern's literal.
SPARK_STEPS = {
    "to_text": ("CAST({e} AS STRING)", ""), "replace_cjk_punct": ("regexp_replace({e}, {p}, ' ')", CJK_PUNCT_RE),
    "remove_html_marker": ("replace({e}, {p}, '')", HTML_MARKER), "strip_tags": ("regexp_replace({e}, {p}, '')", TAG_RE_JAVA),
    "strip_urls": ("regexp_replace({e}, {p}, '')", URL_RE), "strip_digits": ("regexp_replace({e}, {p}, '')", DIGITS_RE),
    "strip_space": ("btrim({e}, {p})", WS_CHARS),
}
DUCK_STEPS = {
    "to_text": ("CAST({e} AS VARCHAR)", ""), "replace_cjk_punct": ("regexp_replace({e}, {p}, ' ', 'g')", CJK_PUNCT_RE),
    "remove_html_marker": ("replace({e}, {p}, '')", HTML_MARKER), "strip_tags": ("regexp_replace({e}, {p}, '', 'g')", TAG_RE_RE2),
    "strip_urls": ("regexp_replace({e}, {p}, '', 'g')", URL_RE), "strip_digits": ("regexp_replace({e}, {p}, '', 'g')", DIGITS_RE),
    "strip_space": ("trim({e}, {p})", None),
}


def render_step(expr: str, step: str, steps: dict, literal) -> str:
    """One cleaning step as SQL text; a pattern None stands for the whitespace set as an expression."""
    template, pattern = steps[step]
    return template.format(e=expr, p=sql_ws_chars() if pattern is None else literal(pattern))


def render_clean(expr: str, profile: str, steps: dict, literal) -> str:
    """The steps of a cleaning profile, in the order :func:`clean_text` applies them."""
    for step in PROFILES[profile]:
        expr = render_step(expr, step.__name__, steps, literal)
    return expr


def sql_step(expr: str, step: str) -> str:
    """DuckDB rendering of one cleaning step."""
    return render_step(expr, step, DUCK_STEPS, _duck_literal)


def sql_clean(expr: str, profile: str = "full") -> str:
    """DuckDB rendering of :func:`clean_text`."""
    return render_clean(expr, profile, DUCK_STEPS, _duck_literal)


def sql_letter_tokens(expr: str) -> str:
    return f"regexp_extract_all({expr}, '{LETTER_RUN_RE}')"

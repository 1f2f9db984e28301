"""Corpus cleaning columns (B2-B8) and the light syntax checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WORD, WS, col, collapse_ws, let, py_strip

# --- fixed values that must equal the reference's -------------------------------------------
# Leading words dropped from a description (matched in any case, followed by whitespace).
DESCRIPTION_PREFIXES = ["Find", "Get", "Return", "Show", "List"]
# Case-sensitive substrings counted by the complexity score, in the reference's order.
COMPLEXITY_INDICATORS = [
    "shortestPath", "allShortestPaths", "OPTIONAL MATCH", "WITH",
    "UNION", "UNWIND", "CASE", "COLLECT", "COUNT", "datetime()",
]
# Keywords of which at least one must occur (substring of the upper-cased query).
CYPHER_KEYWORDS = ["MATCH", "WHERE", "RETURN", "WITH", "OPTIONAL", "CREATE", "DELETE", "SET"]
# Node labels reported as entities when written as ``:Label`` followed by a non-word character.
ENTITY_LABELS = ["User", "Computer", "Group", "Domain", "GPO", "OU", "Container", "CertTemplate"]
# ---------------------------------------------------------------------------------------------


def clean_description(c) -> Column:
    """B2 (non-empty input): strip, drop one leading Find/Get/Return/Show/List + whitespace, capitalise."""
    prefixes = "|".join(DESCRIPTION_PREFIXES)
    d = F.regexp_replace(py_strip(c), rf"(?iu)^(?:{prefixes})[{WS}]+", "")
    return let(d, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 30)))


def clean_query(c) -> Column:
    """B3 (non-empty input): strip and collapse whitespace runs to one space."""
    return py_strip(collapse_ws(c))


def clean_source(c) -> Column:
    """Strip; empty -> ``unknown``; URLs (``http`` prefix) lose a trailing run of ``/`` and ``#``."""
    return let(py_strip(c), lambda s: (
        F.when(s == "", F.lit("unknown"))
        .when(s.startswith("http"), F.regexp_replace(s, r"[/#]+\z", ""))
        .otherwise(s)
    ))


def text_length(c) -> Column:
    """Length in code points, as BIGINT."""
    return F.length(col(c)).cast("long")


def complexity_score(c) -> Column:
    """Number of the complexity indicators present (case-sensitive substring tests)."""
    def body(q):
        terms = [q.contains(F.lit(t)).cast("int") for t in COMPLEXITY_INDICATORS]
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total

    return let(c, body)


def query_type(c) -> Column:
    """Read / modification / create / delete / other, by substring tests on the upper-cased text."""
    def body(u):
        writes = u.contains("CREATE") | u.contains("SET") | u.contains("DELETE")
        return (
            F.when(u.contains("MATCH") & u.contains("RETURN"), F.when(writes, "modification").otherwise("read"))
            .when(u.contains("CREATE"), "create")
            .when(u.contains("DELETE"), "delete")
            .otherwise("other")
        )

    return let(F.upper(col(c)), body)


def entities(c) -> Column:
    """Node labels written as ``:Label`` (any case) followed by a non-word character or the end."""
    def body(q):
        hits = [F.when(q.rlike(rf"(?iu):{label}(?![{WORD}])"), F.lit(label)) for label in ENTITY_LABELS]
        return F.filter(F.array(*hits), lambda x: x.isNotNull())

    return let(c, body)


def has_keyword(c) -> Column:
    """Any Cypher keyword occurs in the upper-cased text."""
    return F.upper(col(c)).rlike("|".join(CYPHER_KEYWORDS))


def char_count(c, ch: str) -> Column:
    q = col(c)
    return F.length(q) - F.length(F.replace(q, F.lit(ch), F.lit("")))


def balance(c, open_ch: str, close_ch: str) -> Column:
    """Occurrences of ``open_ch`` minus occurrences of ``close_ch`` (order ignored)."""
    return (char_count(c, open_ch) - char_count(c, close_ch)).cast("long")


def syntax_errors(c) -> Column:
    """Ordered list of light syntax errors; the query is valid when the list is empty."""
    def body(q):
        counts = F.struct(
            has_keyword(q).alias("kw"),
            balance(q, "(", ")").alias("paren"),
            balance(q, "[", "]").alias("bracket"),
            balance(q, "{", "}").alias("brace"),
        )

        def msgs(s):
            return F.filter(F.array(
                F.when(~s["kw"], F.lit("No Cypher keywords found")),
                F.when(s["paren"] != 0, F.format_string("Unbalanced parentheses (difference: %d)", s["paren"])),
                F.when(s["bracket"] != 0, F.format_string("Unbalanced brackets (difference: %d)", s["bracket"])),
                F.when(s["brace"] != 0, F.format_string("Unbalanced braces (difference: %d)", s["brace"])),
            ), lambda x: x.isNotNull())

        return let(counts, msgs)

    return let(c, body)


def syntax_ok(c) -> Column:
    """True when :func:`syntax_errors` would be empty (cheap form for filters)."""
    return let(c, lambda q: (
        has_keyword(q)
        & (balance(q, "(", ")") == 0)
        & (balance(q, "[", "]") == 0)
        & (balance(q, "{", "}") == 0)
    ))


def relax_regex_op(c) -> Column:
    """Replace ``=~`` by ``=`` before validating."""
    return F.replace(col(c), F.lit("=~"), F.lit("="))

"""Query-text similarity (H1-H7) as Spark expressions over aligned (generated, truth) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WORD, WS, col, collapse_ws, let, py_strip

# --- fixed values that must equal the reference's -------------------------------------------
# Characters whose surrounding whitespace is removed, in this order.
TIGHT_CHARS = ["(", ")", "[", "]", ":", "=", "<", ">"]
# Structure patterns: a keyword, whitespace, then a run of characters outside a negated class
# (the bracketed words are character classes, not keywords).
STRUCTURE_PATTERNS = {
    "match_patterns": r"match\s+([^where^return^with^order^limit]+)",
    "where_conditions": r"where\s+([^return^with^order^limit]+)",
    "return_clauses": r"return\s+([^order^limit]+)",
    "with_clauses": r"with\s+([^match^where^return^order^limit]+)",
}
STRUCTURE_WEIGHTS = {"match_patterns": 0.4, "where_conditions": 0.3, "return_clauses": 0.2, "with_clauses": 0.1}
DEFAULT_WEIGHTS = (0.4, 0.3, 0.3)  # exact, token, structural
SIMILARITY_THRESHOLD = 0.8
MEDIUM_THRESHOLD = 0.5
# ---------------------------------------------------------------------------------------------

TOKEN_PATTERN = rf"[{WORD}]+|[()\[\]{{}}:=<>!\-]|\"[^\"]*\""


def _java(p: str) -> str:
    """Reference pattern in Java syntax: Python-style whitespace class for ``\\s``."""
    return p.replace(r"\s", f"[{WS}]")


def normalize_query(c) -> Column:
    """H1: lower, collapse whitespace, strip, tighten around ( ) [ ] : = < >, single to double
    quotes, drop ``//`` to the end, strip. Null or empty gives ``''``."""
    # Null input runs through the chain as null; empty input stays empty: both give ''.
    return F.coalesce(_normalize(col(c)), F.lit(""))


def _normalize(q: Column) -> Column:
    n = py_strip(collapse_ws(F.lower(q)))
    # After the collapse the only whitespace left is single U+0020 spaces, so the reference's
    # eight sequential passes (remove spaces around each of ( ) [ ] : = < >) are one pass that
    # drops every space next to any of them.
    marks = "".join("\\" + ch if ch in "()[]" else ch for ch in TIGHT_CHARS)
    n = F.regexp_replace(n, rf" ?([{marks}]) ?", "$1")
    n = F.regexp_replace(n, r"'([^']*)'", '"$1"')
    n = F.regexp_replace(n, r"(?s)//.*", "")
    return py_strip(n)


def tokenize(normalized) -> Column:
    """H2: words, bracket/operator marks and double-quoted strings, in order."""
    return F.regexp_extract_all(F.lower(col(normalized)), F.lit(TOKEN_PATTERN), 0)


def jaccard(a, b) -> Column:
    """H3: Jaccard of two lists taken as sets; both empty 1.0, one empty 0.0."""
    def body(p):
        a, b = p["a"], p["b"]
        inter = F.size(F.array_intersect(a, b))
        union = F.size(F.array_union(a, b))
        return (
            F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0))
            .when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0))
            .otherwise(inter / union)
        )

    return let(F.struct(col(a).alias("a"), col(b).alias("b")), body)


def _structure_body(n: Column) -> Column:
    fields = []
    for name, pat in STRUCTURE_PATTERNS.items():
        frags = F.regexp_extract_all(n, F.lit("(?iu)" + _java(pat)), 1)
        fields.append(F.transform(frags, lambda x: py_strip(x)).alias(name))
    return F.struct(*fields)


def structure(normalized) -> Column:
    """H4: struct of the four fragment lists, computed on the normal form normalised again."""
    return let(normalize_query(normalized), _structure_body)


def structure_of_normal_form(normalized) -> Column:
    """H4 on a column that already holds :func:`normalize_query` output.

    The normal form is a fixed point of the normalisation (lower-casing is idempotent; after one
    pass there are no whitespace runs, no spaces beside the tightened marks, at most one unpaired
    single quote and no ``//``), so the reference's second pass changes nothing and is skipped.
    """
    return let(normalized, _structure_body)


def structural_similarity(s1, s2) -> Column:
    """H5: weighted set-Jaccard of the four lists (match .4, where .3, return .2, with .1)."""
    def body(p):
        total = F.lit(0.0)
        total_weight = 0.0
        for name, w in STRUCTURE_WEIGHTS.items():
            total = total + jaccard(p["s1"][name], p["s2"][name]) * F.lit(w)
            total_weight += w
        return total / F.lit(total_weight)

    return let(F.struct(col(s1).alias("s1"), col(s2).alias("s2")), body)


def similarity_columns(df, generated: str, truth: str, weights: tuple[float, float, float] = DEFAULT_WEIGHTS):
    """H6 over a DataFrame: adds normal forms, tokens, structures and the four scores.

    Normal forms are projected once and reused (no nested re-evaluation of the chain).
    """
    ew, tw, sw = weights
    df = df.withColumn("normalized_generated", normalize_query(generated)).withColumn(
        "normalized_truth", normalize_query(truth)
    )
    df = (
        df.withColumn("tokens_generated", tokenize("normalized_generated"))
        .withColumn("tokens_truth", tokenize("normalized_truth"))
        .withColumn("structure_generated", structure_of_normal_form("normalized_generated"))
        .withColumn("structure_truth", structure_of_normal_form("normalized_truth"))
    )
    exact = F.col("normalized_generated") == F.col("normalized_truth")
    tok = jaccard("tokens_generated", "tokens_truth")
    st = structural_similarity("structure_generated", "structure_truth")
    df = df.withColumn("exact_match", exact).withColumn("token_similarity", tok).withColumn(
        "structural_similarity", st
    )
    overall = F.when(F.col("exact_match"), F.lit(1.0)).otherwise(
        F.lit(ew) * F.lit(0.0) + F.lit(tw) * F.col("token_similarity") + F.lit(sw) * F.col("structural_similarity")
    )
    return df.withColumn("overall_score", overall)


def similarity_bucket(exact, score, threshold: float = SIMILARITY_THRESHOLD) -> Column:
    """H7: exact / high (>= threshold) / medium (>= 0.5) / low."""
    s = col(score)
    return (
        F.when(col(exact), F.lit("exact"))
        .when(s >= F.lit(threshold), F.lit("high"))
        .when(s >= F.lit(MEDIUM_THRESHOLD), F.lit("medium"))
        .otherwise(F.lit("low"))
    )

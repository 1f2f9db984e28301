"""Quality rules (operator 9): a threshold table compiled into one Spark projection.

Every measure is a built-in expression over the whole text; there is no user function, shuffle
or join. Null and blank texts have all measures 0 and fail the base rule (fewer than 20 words).
Repeated rows and extra columns pass through unchanged in number; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let
from .common import SPACE, words

# Frequent function words by language code.
STOP_WORDS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with",
    "fr": "au avec ce dans de des du elle en est et il la le les ne par pas pour que qui se sur un une",
    "de": "als auf das dem den der des die ein eine für ist im in mit nicht sich und von zu",
    "es": "al como con de del el en es la las lo los no para por que se su un una y",
}


@dataclass(frozen=True)
class Rule:
    """A document passes when low <= measure <= high (None: no limit)."""

    measure: str
    low: float | None = None
    high: float | None = None


# Thresholds of the verdict. Measures of no defined value (no line, unknown language) pass.
RULES = (
    Rule("mean_word_chars", 2.0, 15.0),
    Rule("symbols_per_word", None, 0.3),
    Rule("stop_word_share", 0.02, None),
    Rule("dup_line_share", None, 0.5),
    Rule("marked_word_share", None, 0.3),
)
MIN_WORDS, WINDOW, MAX_REPEAT_PCT = 20, 8, 30


def _repeat_words(ws: Column, n: int = WINDOW) -> Column:
    """Words inside an n-word window that occurs twice or more in the text.

    Window hashes with their place are sorted once; equal neighbours mark repeated windows; the
    words covered are the sum of min(n, step to the next marked window).
    """
    def of(hashes):
        wins = F.transform(F.sequence(F.lit(1), F.size(hashes) - n + 1),
                           lambda i: F.xxhash64(F.slice(hashes, i, n)))
        return let(wins, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long"))
                   .otherwise(covered(w)))

    def covered(w):
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        marked = let(placed, lambda s: F.array_sort(F.transform(
            F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"])),
            lambda x: x["i"])))
        return let(marked, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(n), F.coalesce(F.get(p, j + 1) - x, F.lit(n)))),
            F.lit(0).cast("long"), lambda s, x: s + x))

    return (F.when(F.size(ws) < n + 1, F.lit(0).cast("long"))
            .otherwise(let(F.transform(ws, lambda x: F.xxhash64(x)), of)))


def measures(text: Column, lang: Column) -> Column:
    """Struct of the counts of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    stop = sorted({w for ws in STOP_WORDS.values() for w in ws.split()})

    def of(ws):
        return F.struct(
            F.size(ws).cast("long").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                          (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"))).alias("lines"),
            _repeat_words(ws).alias("n_repeat_words"),
            F.size(F.filter(ws, lambda w: F.rtrim(F.lower(w), F.lit(".,;:")).isin(stop))).cast("long").alias("n_stop"),
            F.size(F.filter(ws, lambda w: w.endswith("!!") | w.endswith("!!."))).cast("long").alias("n_marked"),
            lang.isin(list(STOP_WORDS)).alias("has_stop_list"),
        )
    return let(words(text), of)


def compile_rules(rules: tuple[Rule, ...], values: dict[str, Column]) -> Column:
    """One boolean expression: every rule holds; a null measure passes."""
    ok = F.lit(True)
    for r in rules:
        v = values[r.measure]
        if r.low is not None:
            ok = ok & F.coalesce(v >= r.low, F.lit(True))
        if r.high is not None:
            ok = ok & F.coalesce(v <= r.high, F.lit(True))
    return ok


def score(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All columns of ``docs`` plus the counts, ``base_failed`` and ``kept``."""
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    m = docs.withColumn("__m", measures(F.col("text"), lang))
    n = F.col("__m.n_words")
    per = lambda c: F.when(n > 0, F.col(c) / n)
    values = {
        "mean_word_chars": per("__m.word_chars"),
        "symbols_per_word": per("__m.n_symbols"),
        "stop_word_share": F.when(F.col("__m.has_stop_list"), per("__m.n_stop")),
        "dup_line_share": F.when(F.col("__m.lines.n") > 0, F.col("__m.lines.dup") / F.col("__m.lines.n")),
        "marked_word_share": per("__m.n_marked"),
    }
    failed = (n < MIN_WORDS) | (100 * F.col("__m.n_repeat_words") > MAX_REPEAT_PCT * n)
    cols = {"n_words": n, "word_chars": F.col("__m.word_chars"), "n_symbols": F.col("__m.n_symbols"),
            "n_dup_lines": F.col("__m.lines.dup"), "n_repeat_words": F.col("__m.n_repeat_words"),
            "base_failed": failed, "kept": ~failed & compile_rules(rules, values)}
    keep = [c for c in docs.columns if c not in cols]
    return m.select(*keep, *[v.alias(k) for k, v in cols.items()])

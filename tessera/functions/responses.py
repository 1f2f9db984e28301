"""Model-response parsing (G1-G4): think-span removal, query extraction, error status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let, py_strip


def strip_think(c) -> Column:
    """G1: remove every ``<think>...</think>`` span (non-greedy, across lines); stray tags stay."""
    return F.regexp_replace(col(c), r"(?s)<think>.*?</think>", "")


def _clean_lines(text: Column, keep) -> Column:
    lines = F.transform(F.split(text, "\n"), lambda x: py_strip(x))
    return F.filter(lines, lambda x: (x != F.lit("")) & keep(x))


def extract_query(c) -> Column:
    """The query text of a response after think removal.

    Tagged: text between the first ``<query>`` and the first ``</query>`` (empty when the closing
    tag comes first), lines stripped, blank lines dropped. Untagged: lines stripped; blank lines,
    ``<...>`` lines and ``tags.`` lines dropped; if nothing is left, the stripped text.
    """
    return let(strip_think(c), _extract_from)


def _extract_from(s: Column) -> Column:
    open_at = F.locate("<query>", s)
    close_at = F.locate("</query>", s)
    start0 = open_at - 1 + 7  # 0-based start of the inner text
    end0 = close_at - 1
    inner = F.when(end0 > start0, F.substring(s, start0 + 1, end0 - start0)).otherwise(F.lit(""))
    tagged = F.array_join(_clean_lines(py_strip(inner), lambda x: F.lit(True)), "\n")
    untagged_lines = _clean_lines(
        py_strip(s),
        lambda x: ~(x.startswith("<") & x.endswith(">")) & ~x.startswith("tags."),
    )
    untagged = F.when(F.size(untagged_lines) > 0, F.array_join(untagged_lines, "\n")).otherwise(py_strip(s))
    return F.when((open_at > 0) & (close_at > 0), tagged).otherwise(untagged)


def is_generation_error(extracted) -> Column:
    """The extracted text reports a generation error."""
    return col(extracted).startswith("ERROR:")


def response_status(extracted) -> Column:
    """struct(status, generated_query, generation_error)."""
    def body(e):
        err = is_generation_error(e)
        return F.struct(
            F.when(err, F.lit("error")).otherwise(F.lit("ok")).alias("status"),
            F.when(~err, e).alias("generated_query"),
            F.when(err, e).alias("generation_error"),
        )

    return let(extracted, body)

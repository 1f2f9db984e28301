"""Shared text classes.

Python's ``str.strip``/``\\s`` and ``\\w`` are Unicode-aware while Java's are ASCII; these classes
give the Python behaviour inside Java regular expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python whitespace (str.isspace) as a Java character-class body.
WS = r"\s\x0b\x1c-\x1f\x{85}\p{Z}"
# Python word character (\w on str) as a Java character-class body.
WORD = r"\p{L}\p{N}_"
# The same whitespace as an explicit set (str.isspace over all code points; 29 characters,
# identical to the WS class) for Spark's character-set trim, which is far cheaper than a regex.
PY_WS_CHARS = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    Catalyst inlines a derived column into every place that reads it (projections collapsed,
    filters pushed below projections and joins). A body that reads its input many times would
    then repeat an expensive producer (regex chains) per reference; binding it once keeps the
    cost linear whatever the optimiser does with the plan.
    """
    return F.element_at(F.transform(F.array(col(value)), body), 1)


def py_strip(c) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.trim(col(c), F.lit(PY_WS_CHARS))


def collapse_ws(c) -> Column:
    """Replace every run of Unicode whitespace by one space (no trim)."""
    return F.regexp_replace(col(c), rf"[{WS}]+", " ")


def canonical_ws(c) -> Column:
    """Collapse whitespace runs to one space and trim; case kept (``' '.join(s.split())``)."""
    return py_strip(collapse_ws(c))


def is_blank(c) -> Column:
    """True when the text is empty after a Python-style strip."""
    return py_strip(c) == F.lit("")

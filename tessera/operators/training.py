"""Training-set preparation (M1-M8): formats, three-way split, few-shot examples, manifest.

Input rows are traces ``(id, description, query, source, reasoning_trace, generated_at)`` with a
unique id. Formats are projections; only the exact split sizes need a pass of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sampling import sample_n, take_first

# Names of the formats; the documentation states no wording, so labels are parameters.
FORMATS = ("instruction", "conversation", "cot", "qa")
INSTRUCTION = "Write a Cypher query for the request."


def to_format(df: DataFrame, kind: str, instruction: str = INSTRUCTION) -> DataFrame:
    """M1-M4: one training row per trace in the given format, with its id.

    instruction   instruction, input (description), output (query)
    conversation  messages: user (description), assistant (query)
    cot           prompt (description), completion: reasoning, a blank line, the query
    qa            question (description), answer (query)

    A null description or query counts as empty; a trace without reasoning has the query alone.
    """
    d, q = (F.coalesce(F.col(c), F.lit("")) for c in ("description", "query"))
    r = F.col("reasoning_trace")
    if kind == "instruction":
        return df.select("id", F.lit(instruction).alias("instruction"), d.alias("input"), q.alias("output"))
    if kind == "conversation":
        turn = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
        return df.select("id", F.array(turn("user", d), turn("assistant", q)).alias("messages"))
    if kind == "cot":
        body = F.when(r.isNull() | (r == ""), q).otherwise(F.concat(r, F.lit("\n\n"), q))
        return df.select("id", d.alias("prompt"), body.alias("completion"))
    if kind == "qa":
        return df.select("id", d.alias("question"), q.alias("answer"))
    raise ValueError(f"format must be one of {FORMATS}")


def three_way_split(df: DataFrame, train_ratio: float = 0.8, val_ratio: float = 0.1, seed: int = 42,
                    id_col: str = "id") -> DataFrame:
    """M5: add ``split``: floor(n * train_ratio) train rows, floor(n * val_ratio) validation rows,
    the rest test, in seeded order."""
    if not (0 < train_ratio < 1 and 0 <= val_ratio < 1 and train_ratio + val_ratio <= 1):
        raise ValueError("ratios must be between 0 and 1 and not exceed 1 together")
    size = F.col("__size")
    n_train = F.floor(size * F.lit(train_ratio))
    first = take_first(df, lambda t: t.withColumn("__take", n_train), seed, id_col, flag="__train")
    both = take_first(first, lambda t: t.withColumn("__take", n_train + F.floor(size * F.lit(val_ratio))), seed, id_col, flag="__both")
    split = F.when(F.col("__train"), "train").when(F.col("__both"), "validation").otherwise("test")
    return both.withColumn("split", split).drop("__train", "__both")


def few_shot(split: DataFrame, n: int = 3, seed: int = 42, id_col: str = "id") -> DataFrame:
    """M6: n examples of the train rows only."""
    return sample_n(split.filter(F.col("split") == "train"), n, seed, id_col)


def training_filter(df: DataFrame, min_length: int = 10, max_rows: int | None = None, id_col: str = "id") -> DataFrame:
    """M7: rows whose description has ``min_length`` characters or more; with ``max_rows`` the
    first of them by id (a row limit is the caller's choice, there is none by default)."""
    out = df.filter(F.length("description") >= min_length)
    return out if max_rows is None else out.orderBy(id_col).limit(max_rows)


def manifest(split: DataFrame, formats: tuple[str, ...] = FORMATS) -> DataFrame:
    """M8: rows per format and split (every format holds every row)."""
    counts = split.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return counts.select(F.explode(F.array(*[F.lit(f) for f in formats])).alias("format"), "split", "rows")

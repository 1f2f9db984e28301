import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_data import docs_of


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, tiny and very long texts, repeated rows, nulls in other columns."""
    long = " ".join(f"word{i % 977} and{i % 13}" for i in range(15000))
    return docs_of(spark, [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, "one two", "en", "b"),
        (5, "The same text of more than five words here.", "en", "a"), (5, "The same text of more than five words here.", "en", "a"),
        (6, "the same text of more than five words here.", "de", None), (7, long, "en", "c"), (8, long + " end", "en", "c"),
        (9, "日本語のテキストです。これは長い行になります。", "ja", "d"), (10, "a" * 5000, "en", "d")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tessera.plans.session import ensure_checkpoint_dir

    s = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.log.level", "ERROR").getOrCreate())
    ensure_checkpoint_dir(s)
    yield s

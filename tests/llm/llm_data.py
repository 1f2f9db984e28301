"""The small tables folder and documents made for the tests of ``tessera.llm``."""

SF = "/root/testdata/sf0.001"
# id, text, lang, source, n_chars and an extra column with a name that operators use themselves
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string"


def docs_of(spark, rows):
    """Documents of (doc_id, text, lang, source); n_chars follows the text."""
    return spark.createDataFrame([(i, t, la, so, None if t is None else len(t), "x") for i, t, la, so in rows], DOCS)


from pyspark.sql import functions as F

from tessera.functions import cleaning as C
from tessera.functions import responses as R
from tessera.functions import similarity as S
from tessera.functions.text import canonical_ws, py_strip


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).collect()[0]["y"]


def test_s17_unicode_whitespace(spark):
    assert one(spark, py_strip, " \t a b  \n") == "a b"
    assert one(spark, canonical_ws, " a　 b\x1c c\u0085 ") == "a b c"
    assert one(spark, py_strip, "​x") == "​x"  # zero-width space is not whitespace


def test_b2_description(spark):
    assert one(spark, C.clean_description, "  find   users") == "Users"
    assert one(spark, C.clean_description, "SHOW all") == "All"
    assert one(spark, C.clean_description, "Finding x") == "Finding x"  # needs whitespace after the word
    assert one(spark, C.clean_description, "list list x") == "List x"  # one prefix only
    assert one(spark, C.clean_description, "ßx") == "SSx"


def test_b4_source(spark):
    assert one(spark, C.clean_source, " https://a.org/x//#/ ") == "https://a.org/x"
    assert one(spark, C.clean_source, "   ") == "unknown"
    assert one(spark, C.clean_source, "ftp://a/") == "ftp://a/"


def test_s12_substrings(spark):
    assert one(spark, C.query_type, "MATCH (n) RETURN n SKIP 1 OFFSET 2") == "modification"  # SET in OFFSET
    assert one(spark, C.complexity_score, "WHERE n.name STARTS WITH 'a'") == 1  # WITH in STARTS WITH
    assert one(spark, C.complexity_score, "with count(x)") == 0  # case-sensitive
    assert one(spark, C.query_type, "create (n)") == "create"
    assert one(spark, C.query_type, "MATCH (n) DETACH DELETE n") == "delete"
    assert one(spark, C.query_type, "RETURN 1") == "other"


def test_b8_entities(spark):
    assert one(spark, C.entities, "MATCH (a:user)-[:X]->(b:GPOs) (c:Computer) (d:OU)") == ["User", "Computer", "OU"]
    assert one(spark, C.entities, "(x:Userx) (y:Domain_1) (z:Groupé)") == []


def test_c3_errors(spark):
    assert one(spark, C.syntax_errors, "MATCH ((n) RETURN [n") == [
        "Unbalanced parentheses (difference: 1)", "Unbalanced brackets (difference: 1)"]
    assert one(spark, C.syntax_errors, "look }{ here)") == [
        "No Cypher keywords found", "Unbalanced parentheses (difference: -1)"]
    assert one(spark, C.syntax_errors, "MATCH (n) RETURN n") == []
    assert one(spark, C.relax_regex_op, "n.name =~ 'a.*'") == "n.name = 'a.*'"


def test_s1_normalize(spark):
    assert one(spark, S.normalize_query, "MATCH (n:User)  WHERE n.x = 'a' // c RETURN n") == 'match(n:user)where n.x="a"'
    assert one(spark, S.normalize_query, "RETURN 'http://x.org/a'") == 'return "http:'
    assert one(spark, S.normalize_query, None) == ""
    assert one(spark, S.normalize_query, "") == ""
    assert one(spark, S.normalize_query, "a <\t= b") == "a<=b"


def test_h2_tokens(spark):
    assert one(spark, S.tokenize, 'match(n:user{name:"a b"})-->(m) return n.x') == [
        "match", "(", "n", ":", "user", "{", "name", ":", '"a b"', "}", ")", "-", "-", ">", "(", "m", ")",
        "return", "n", "x"]


def test_s2_structure(spark):
    st = one(spark, S.structure, "match (n) where n.a=1 return n")
    # MATCH (n): the space was removed by S1; 'n' is inside the where class, outside the return class
    assert st["match_patterns"] == [] and st["where_conditions"] == [] and st["return_clauses"] == ["n"]
    st = one(spark, S.structure, "match p=(a)-[*]->(b) return p")
    assert st["match_patterns"] == ["p=(a)-[*]->(b)"]
    assert st["return_clauses"] == ["p"]


def test_s4_similarity(spark):
    df = spark.createDataFrame([("MATCH (n) RETURN n", "match (n)  return n"), ("MATCH (n) RETURN n", "MATCH (m) RETURN m"),
                                ("", "")], "g string, t string")
    r = S.similarity_columns(df, "g", "t").select("exact_match", "token_similarity", "overall_score").collect()
    assert r[0]["exact_match"] and r[0]["overall_score"] == 1.0
    assert not r[1]["exact_match"] and r[1]["overall_score"] <= 0.6 + 1e-12  # S4: not exact => at most .6
    assert r[2]["exact_match"]
    jac = spark.createDataFrame([(["a", "b", "b"], ["b", "c"]), ([], []), ([], ["a"])], "a array<string>, b array<string>")
    v = jac.select(S.jaccard("a", "b").alias("j"), S.jaccard("b", "a").alias("k")).collect()
    assert [x["j"] for x in v] == [1 / 3, 1.0, 0.0] and all(x["j"] == x["k"] for x in v)


def test_s5_s6_extraction(spark):
    ex = R.extract_query
    assert one(spark, ex, "<think>a\n<query>x</query>\n</think>\n<query>\n  MATCH (n)\n\n  RETURN n \n</query>") == \
        "MATCH (n)\nRETURN n"
    assert one(spark, ex, "</query> x <query>MATCH (n)") == ""  # S6 closing tag first
    assert one(spark, ex, "</think>a<think>b") == "</think>a<think>b"  # stray tags stay
    assert one(spark, ex, "Sure:\n<b>\n  MATCH (n)\ntags.x\n") == "Sure:\nMATCH (n)"
    assert one(spark, ex, "<b>\n tags.y") == "<b>\n tags.y"  # nothing left: the stripped text
    assert one(spark, ex, "ERROR: boom") == "ERROR: boom"


def test_s3_normal_form_is_a_fixed_point(spark):
    """The second normalisation of H4 is skipped in H6 because it cannot change the text."""
    from sizes import SF_SMALL
    from tessera.plans import fixtures as X

    texts = X.doc_corpus(spark, SF_SMALL).select(F.col("query").alias("x")).unionByName(
        X.corpus(spark, SF_SMALL).select(F.col("query").alias("x")))
    n = texts.select(S.normalize_query("x").alias("n"))
    assert n.filter(S.normalize_query("n") != F.col("n")).count() == 0
    tricky = ["a '(' b", "'a' 'b", "x = ( y // 'c'", "Σ ΑΣ İ", "a <  > b", "'a // b'"]
    df = spark.createDataFrame([(t,) for t in tricky], "x string").select(S.normalize_query("x").alias("n"))
    assert df.filter(S.normalize_query("n") != F.col("n")).count() == 0

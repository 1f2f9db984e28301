"""Prefix trie, fill-in-middle and url filter against plain versions and on odd rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from llm_data import docs_of
from pyspark.sql import functions as F

from tessera.llm import conv_trie, fill_middle, url_filter, wavelet

# ---------------------------------------------------------------- 11 trie
TURNS = "conv_id long, turn long, role string, text string, n long, depth string, pos int"


def plain_trie(rows):
    """Nodes of rows (conv_id, turn, role, text): every prefix of every rebuilt conversation, listed."""
    by = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, (r or "").encode(), (x or "").encode()))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in by.items()}
    seqs = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seqs[c] = own.get(c - c % 5, [])[:h] + v[h:]
    members = defaultdict(list)
    for c, v in seqs.items():
        for d in range(len(v) + 1):
            members[tuple(v[:d])].append(c)
    kids = defaultdict(list)
    for k in members:
        if k:
            kids[k[:-1]].append(k)

    def below(k):
        todo, out = [k], []
        while todo:
            x = todo.pop()
            out.append(x)
            todo += kids[x]
        return out

    out = set()
    for k, cs in members.items():
        sub = below(k)
        ends = ",".join(str(c) for c in sorted(cs) if len(seqs[c]) == len(k))
        out.add((min(cs), len(k), min(members[k[:-1]]) if k else None, len(cs), len(kids[k]), sum(not kids[x] for x in sub),
                 sum((len(members[x]) - 1) * len(x[-1][1]) for x in sub if x), hashlib.sha256(ends.encode()).hexdigest()))
    return out


def trie_of(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], TURNS)
    got = conv_trie.conversation_trie(df).collect()
    out = {(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in got}
    assert len(out) == len(got)
    return out


def test_trie(spark):
    r = random.Random(3)
    rows = []
    for c in range(120):  # shared beginnings, equal conversations, one long one; turns with gaps and repeats
        n = 70 if c == 30 else r.choice([1, 2, 3, 5, 8, 9, 13])
        rows += [(c, 3 * i, r.choice(["user", "bot"]) if i > 2 else "user", r.choice(["é", "bb", "ccc"]) if i > 1 else "hi") for i in range(n)]
    rows += [(200, None, None, None), (200, None, "user", "z"), (200, 5, "user", "a"), (200, 5, "bot", "b"), (200, 5, "bot", "b"),
             (203, 1, "user", "x" * 20000), (None, 1, "user", "lost"), (10**15, 1, "", "ab"), (10**15, 2, "a", "b"), (7000, 2, "a", "b")]
    r.shuffle(rows)
    assert trie_of(spark, rows) == plain_trie(rows)


def test_trie_small(spark):
    assert trie_of(spark, []) == set()
    assert trie_of(spark, [(None, 1, "a", "b")]) == set()
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in range(1, 400)}
    empty = next(c for c in h if h[c] > 1 and c % 5)  # no leader, and its one turn is in its head
    assert trie_of(spark, [(empty, 0, "user", "gone")]) == {
        (empty, 0, None, 1, 0, 1, 0, hashlib.sha256(str(empty).encode()).hexdigest())}
    hot = [(c, i, "user", f"t{i}") for c in range(0, 4000, 5) for i in range(3)]
    assert trie_of(spark, hot) == plain_trie(hot)


# ---------------------------------------------------------------- 12 fill in the middle
def plain_fim(doc_id, text):
    text = text or ""
    h = hashlib.sha256(b"1:" + str("" if doc_id is None else doc_id).encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(text) + 1), h2 % (len(text) + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(text), "plain", None, None, text
    if h4 % 100 < 20:
        return len(text), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(text), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_middle(spark, odd):
    r = random.Random(5)
    signs = ["a", "Z", " ", "\n", "ß", "日", "😀", "<", "P", ">", "<M", "S>", "\u0301", "<S>"]
    texts = ["".join(r.choice(signs[:13] if i % 9 else signs) for _ in range(r.randrange(40))) for i in range(400)]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + [(None, "no id at all", "en", "a"), (7, "x" * 3_000_000 + "é" * 700_000, "en", "a")]
    for docs in (docs_of(spark, rows), odd):
        docs = docs.withColumn("form", F.lit("clash")).withColumn("n", F.lit("clash"))
        made = fill_middle.transform(docs)
        assert set(made.columns) >= {"lang", "size", "n", "form"} and made.columns.count("form") == 1
        got = sorted(((x.doc_id, x.n, x.form, x.prefix_chars, x.middle_chars, x.output) for x in made.collect()), key=repr)
        assert got == sorted(((d.doc_id, *plain_fim(d.doc_id, d.text)) for d in docs.collect()), key=repr)
        back = made.select("doc_id", fill_middle.restore(F.col("output"), F.col("form")).alias("t")).collect()
        assert sorted(map(tuple, back), key=repr) == sorted(((d.doc_id, d.text or "") for d in docs.collect()), key=repr)
    assert fill_middle.transform(odd.limit(0)).count() == 0


def test_fill_middle_words(spark):
    rows = [(i, f"one two  three\n\nfour five{i} ", "en", "a") for i in range(50)]
    made = fill_middle.transform(docs_of(spark, rows), unit="word").collect()
    for x in made:
        assert x.n == 5
        if x.form != "plain":
            text = rows[x.doc_id][1]
            begins = {text.index(w) for w in text.split()} | {len(text)}
            assert {x.prefix_chars, x.prefix_chars + x.middle_chars} <= begins


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 4, n).astype(np.uint8)
        m = wavelet.WaveletMatrix(symbols)
        at = np.arange(n + 1)
        for c in range(4):
            assert (m.rank(c, at) == np.concatenate([[0], np.cumsum(symbols == c)])).all()


# ---------------------------------------------------------------- 13 urls
def page(url, head="", body=""):
    return f"<html><head>{head}</head><body>{body}</body></html>", url


def test_url_rules(spark):
    cases = {  # url: host, path, rule, verdict
        None: ("", "", None, "allow"), "": ("", "", None, "allow"), "no scheme/net/": ("", "", None, "allow"),
        "http://net/": ("net", "/", "net/", "block"), "http://a.NET/x?y#z": ("a.net", "/x", "net/", "block"),
        "http://a.net": ("a.net", "", None, "allow"), "http://a.net?q=/": ("a.net", "", None, "allow"), "http://subnet/": ("subnet", "/", None, "allow"),
        "https://b.example.net/en/": ("b.example.net", "/en/", "example.net/en/", "allow"),
        "https://example.net/en": ("example.net", "/en", "net/", "block"), "https://badexample.net/en/": ("badexample.net", "/en/", "net/", "block"),
        "x://example.com/de/1": ("example.com", "/de/1", "example.com/de/", "block"), "http://example.com/fr/": ("example.com", "/fr/", None, "allow"),
        "http://k.org/fr/a://b.net/": ("k.org", "/fr/a://b.net/", "org/fr/", "allow"), "http://ÄB.Org/fr/": ("Äb.org", "/fr/", "org/fr/", "allow"),
    }
    df = spark.createDataFrame([(i, u, None, "a", "b") for i, u in enumerate(cases)], "page_id long, url string, html string, verdict string, node string")
    got = url_filter.judge(df.unionByName(df))
    assert got.count() == 2 * len(cases) and got.columns.count("verdict") == 1
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got.collect()} == cases
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_aliases(spark):
    canon = '<link href="{}" REL=\'nofollow Canonical\'>'
    pages = [
        page("http://one.example.org/a#top", canon.format("https://spam.net/x?a=1&amp;b=2")),        # target blocked: blocked
        page("http://two.example.org/b", '<META http-equiv=Refresh content="0; URL=http://one.example.org/a">'),  # through it: blocked
        page("http://three.example.org/c/d", "<link rel=canonical href='../../b'>"),                  # elsewhere: no link
        page("http://two.example.org/c/d", "<link rel=canonical href='../b'>"),                       # to two/b: blocked
        page("http://four.example.org/", canon.format("//five.net/") + canon.format("http://k.org/fr/x")),  # class holds an allow
        page("http://six.example.org/", "<!-- " + canon.format("http://spam.net/") + "--><script>'" + canon.format("http://spam.net/") + "'</script>"),
        page("http://seven.example.org/", "<link rel=stylesheet href=http://spam.net/>"),
        page("http://w.example.net/en/1", canon.format("http://spam.net/")),                          # its own rule allows it
        page("http://eight.example.org/", canon.format("http://w.example.net/en/1")),                 # class holds that allow
        page("HTTP://Nine.example.org:80", canon.format("mailto:x@spam.net")),
        page("http://ten.example.org/", "<p " * 50000 + canon.format("http://nine.example.org/")),
        page("https://spam.net/x?a=1&b=2"), page("http://five.net/"),
    ]
    want = ["block", "block", "allow", "block", "allow", "allow", "allow", "allow", "allow", "allow", "allow", "block", "block"]
    df = spark.createDataFrame([(i, u, h) for i, (h, u) in enumerate(pages)], "page_id long, url string, html string")
    assert [r.verdict for r in url_filter.judge(df).orderBy("page_id").collect()] == want
    # a hot class: a third of all pages refresh to one hub, which a handed-in redirect takes to a blocked host
    hub = [(i, f"http://p{i}.example.org/", "<meta http-equiv='refresh' content='5;url=http://hub.example.org/'>" if i % 3 == 0 else "") for i in range(3000)]
    moved = spark.createDataFrame([("http://hub.example.org", "http://evil.net/")], "src string, dst string")
    got = url_filter.judge(spark.createDataFrame(hub, "page_id long, url string, html string"), redirects=moved).collect()
    assert all((r.verdict == "block") == (r.page_id % 3 == 0) for r in got)


def test_url_chain(spark):
    """Nodes of one class share the verdict even where links are followed backwards."""
    chain = [(i, f"http://c{i}.example.org/", f"<link rel=canonical href=http://c{i + 1}.example.org/>") for i in range(60)]
    chain.append((60, "http://c60.example.org/", "<link rel=canonical href=http://end.net/>"))
    got = url_filter.judge(spark.createDataFrame(chain, "page_id long, url string, html string")).collect()
    assert {r.verdict for r in got} == {"block"}

"""HTML extraction (operator 1) by union-free regular-expression inference.

A page becomes a stream of blocks: the text of each block element with the path of elements above
it. The streams of one host are aligned one after another into a wrapper, a regular expression
without alternatives: equal neighbours and tandem repeats become repeated groups, blocks that some
pages lack become optional, and blocks whose text differs become text slots; text that all pages
share stays a constant of the template. Wrappers align with wrappers in the same way, so each task
first aligns the pages it reads, host by host, and only these small wrappers are shuffled and
aligned further, in rounds of at most ``FAN_IN``; a host with a third of all pages is one wrapper
per task, never a group of pages.

The wrapper says where a host's main text is: in article or main elements where the host has them,
else in the element whose slots hold most text outside links. Extraction takes a page's blocks
there, without menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments (by element, role, class and id), without hidden blocks and without constants of the
template, which count as such only in a wrapper of ``MIN_PAGES`` pages with a slot in its main text.

Null and empty html and pages without text give ''. Unclosed, crossed and unknown elements are
tolerated. A null or odd url makes the page a host of its own kind (''). Repeated rows give equal
results; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as entities
import json
import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

MIN_PAGES, FAN_IN, MAX_FOLD, HOSTS_HELD = 5, 64, 4, 500
BROADCAST_CHARS, SALTS = 8_000_000, 64

# Elements of HTML by how a text flow treats them.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr img".split())
NO_TEXT = set("script style noscript template iframe svg math canvas object video audio button select option textarea form nav footer aside dialog menu head title".split())
RAW = set("script style textarea title noscript iframe template".split())
CLOSES_P = set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSED_BY_SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "tbody", "thead", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
ROLES = set("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BOILER = re.compile(r"(?:^|[-_\s])(?:ads?|adverts?|advertisement|adbox|banner|breadcrumbs?|comments?|commentlist|cookies?|consent|disqus|footer|gdpr|masthead|menu|modal|nav|navbar|navigation|newsletter|notice|overlay|pagination|pager|popup|promo|promotion|recommended|related|replies|respond|share|sharing|sidebar|social|sponsored|sponsor|subscribe|toolbar|widget)(?:$|[-_\s\d])", re.I)

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'">]|"[^"]*"|'[^']*')*)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
SPACE_RUN = re.compile(r"\s+")
HOST = r"^(?i:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def _element(name: str, rest: str) -> tuple[str, bool, bool]:
    """Path step of an element, whether it is boilerplate, whether it holds the main text."""
    if not rest or rest.isspace():
        return name, name in NO_TEXT, name in ("article", "main")
    at = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(rest)}
    marks = f"{at.get('class', '')} {at.get('id', '')}".strip()
    role = at.get("role", "").lower()
    away = (name in NO_TEXT or role in ROLES or "hidden" in at or at.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", at.get("style", ""), re.I) is not None)
    main = name in ("article", "main") or role in ("main", "article")
    if marks and not main and name not in ("body", "html") and BOILER.search(marks):
        away = True
    return (name + "." + re.sub(r"\d+", "0", SPACE_RUN.sub(".", marks)) if marks else name), away, main


def blocks(page: str | None) -> list[tuple[str, str, bool, bool, int]]:
    """(path, text, boilerplate, in main, characters in links) of each block with text, in page order."""
    if not page:
        return []
    out: list[tuple[str, str, bool, bool, int]] = []
    stack: list[tuple[str, str, bool, bool, bool]] = []  # name, step, away, main, inline
    text: list[str] = []
    links = at = 0

    def flush():
        nonlocal links
        if text:
            t = SPACE_RUN.sub(" ", entities.unescape("".join(text))).strip()
            text.clear()
            if t:
                path = "/".join(s for _, s, _, _, inline in stack if not inline)
                main = any(m for _, _, _, m, _ in stack)
                away = any(a for _, _, a, _, _ in stack) or any(n == "header" for n, *_ in stack) and not main
                out.append((path, t, away, main, links))
        links = 0

    def close(k: int):
        """Close the open elements from the k-th on."""
        if any(not inline for *_, inline in stack[k:]):
            flush()
        del stack[k:]

    n, position = len(page), 0
    while position < n:
        m = TOKEN.search(page, position)
        piece = page[position:m.start() if m else n]
        if piece:
            text.append(piece)
            if any(s[0] == "a" for s in stack):
                links += len(piece.strip())
        if not m:
            break
        position = m.end()
        if m[2] is None:
            continue
        name = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(k)
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name in ("br", "wbr"):
            if name == "br":
                text.append(" ")
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            continue
        if name in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    close(k)
                    break
                if stack[k][0] in ("div", "article", "section", "main", "body", "td", "li", "table", "button"):
                    break
        if name in CLOSED_BY_SAME:
            same = {"dt", "dd"} if name in ("dt", "dd") else {"td", "th"} if name in ("td", "th") else {name}
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in same:
                    close(k)
                    break
                if stack[k][0] in CLOSED_BY_SAME[name]:
                    break
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, position)
            position = end.end() if end else n
            if name not in INLINE:
                flush()
            continue
        inline = name in INLINE
        if not inline:
            flush()
        if m[3].endswith("/") and name not in ("p", "div", "a", "article", "main", "section", "span"):
            continue
        step, away, main = _element(name, m[3])
        stack.append((name, step, away and not inline, main, inline))
    flush()
    return out


# A wrapper is a list of [path or list of entries, repeated, optional, text hash or None, pages,
# slot characters outside links]; a list of entries is a repeated group.


def _merge_entry(a: list, b: list) -> list:
    sig = a[0] if isinstance(a[0], str) else align(a[0], b[0])
    return [sig, a[1] or b[1], a[2] or b[2], a[3] if a[3] == b[3] else None, a[4] + b[4], a[5] + b[5]]


def _sign(e: list) -> str:
    return e[0] if isinstance(e[0], str) else "(" + " ".join(_sign(x) for x in e[0]) + ")"


def fold(entries: list) -> list:
    """Equal neighbours and tandem repeats of up to MAX_FOLD entries become repeated entries."""
    for size in range(1, MAX_FOLD + 1):
        out, i = [], 0
        while i < len(entries):
            unit = [_sign(e) for e in entries[i:i + size]]
            j = i + size
            while len(unit) == size and [_sign(e) for e in entries[j:j + size]] == unit:
                j += size
            if j > i + size:
                group = entries[i:i + size]
                for k in range(i + size, j, size):
                    group = [_merge_entry(a, b) for a, b in zip(group, entries[k:k + size])]
                chars = sum(e[5] for e in group)
                pages = entries[i][4]
                if size == 1:
                    out.append([group[0][0], True, group[0][2], None, pages, chars])
                else:
                    out.append([group, True, False, None, pages, chars])
                i = j
            else:
                out.append(entries[i])
                i += 1
        entries = out
    return entries


def page_wrapper(found: list) -> list:
    return fold([[path, False, False, xxhash.xxh3_64_hexdigest(text), 1, 0 if away else max(0, len(text) - 2 * links)]
                 for path, text, away, _, links in found])


def align(a: list, b: list) -> list:
    """One wrapper of two: a longest common run of entries, in order; the others become optional."""
    x, y = [_sign(e) for e in a], [_sign(e) for e in b]
    if x == y:
        return [_merge_entry(p, q) for p, q in zip(a, b)]
    n, m = len(x), len(y)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, low = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = low[j + 1] + 1 if x[i] == y[j] else max(low[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if x[i] == y[j]:
            out.append(_merge_entry(a[i], b[j]))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            out.append([*a[i][:2], True, *a[i][3:]])
            i += 1
        else:
            out.append([*b[j][:2], True, *b[j][3:]])
            j += 1
    out += [[*e[:2], True, *e[3:]] for e in a[i:] + b[j:]]
    return fold(out)


def _flat(wrapper: list):
    for e in wrapper:
        if isinstance(e[0], str):
            yield e
        else:
            yield from _flat(e[0])


MAIN_STEP = re.compile(r"(?:^|/)(?:article|main)(?:[./]|$)")


def plan(wrapper: list, pages: int) -> dict:
    """What extraction needs of a host's wrapper: the main element's path and the template's constants."""
    flat = list(_flat(wrapper))
    where = None
    if not any(MAIN_STEP.search(e[0]) and e[5] for e in flat):
        weight: dict[str, float] = {}
        for e in flat:
            if e[3] is not None and pages >= MIN_PAGES:
                continue
            steps, share = e[0].split("/"), 1.0
            for k in range(len(steps) - 1, 0, -1):
                weight["/".join(steps[:k])] = weight.get("/".join(steps[:k]), 0.0) + share * e[5]
                share *= 0.6
        where = max(weight, key=lambda p: (weight[p], len(p))) if any(weight.values()) else None
    main = [e for e in flat if (where is None or e[0].startswith(where))]
    fixed = {}
    if pages >= MIN_PAGES and any(e[3] is None and e[5] for e in main):
        fixed = {e[0] + "|" + e[3]: 1 for e in wrapper if isinstance(e[0], str) and e[3] is not None and not e[1] and e[4] >= MIN_PAGES}
    return {"where": where, "fixed": fixed}


def main_text(page: str | None, of: dict) -> str:
    found = blocks(page)
    good = [b for b in found if not b[2]]
    if any(b[3] for b in good):
        good = [b for b in good if b[3]]
    elif of["where"]:
        inside = [b for b in good if (b[0] + "/").startswith(of["where"] + "/")]
        good = inside or good
    if of["fixed"]:
        good = [b for b in good if b[0] + "|" + xxhash.xxh3_64_hexdigest(b[1]) not in of["fixed"]]
    return "\n".join(b[1] for b in good)


def _page_wrappers(frames):
    """Pages -> one wrapper per host and task (flushed when many hosts are held)."""
    held: dict[str, list] = {}

    def rows():
        out = pd.DataFrame({"host": list(held), "pages": [v[1] for v in held.values()], "wrapper": [json.dumps(v[0]) for v in held.values()]})
        held.clear()
        return out

    for df in frames:
        for host, page in zip(df["host"], df["html"]):
            w = page_wrapper(blocks(page))
            old = held.get(host)
            held[host] = [w, 1] if old is None else [align(old[0], w), old[1] + 1]
            if len(held) > HOSTS_HELD:
                yield rows()
    if held:  # a task may read no page
        yield rows()


def _join_wrappers(df: pd.DataFrame) -> pd.DataFrame:
    out, pages = None, 0
    for w, n in sorted(zip(df["wrapper"], df["pages"])):
        out = json.loads(w) if out is None else align(out, json.loads(w))
        pages += n
    return pd.DataFrame({"host": [df["host"].iloc[0]], "pages": [pages], "wrapper": [json.dumps(out)]})


def wrappers(pages: DataFrame) -> DataFrame:
    """host, pages, wrapper (JSON): one row per host."""
    schema = "host string, pages long, wrapper string"
    own = pages.select(F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")).alias("host"), "html")
    w = cut(own.mapInPandas(_page_wrappers, schema))
    while True:
        most = w.groupBy("host").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return w
        salt = F.pmod(F.xxhash64("wrapper", "pages"), F.lit(-(-most // FAN_IN)))
        w = cut(w.withColumn("salt", salt).groupBy("host", "salt").applyInPandas(
            lambda df: _join_wrappers(df.drop(columns="salt")), schema))


def _plans(frames):
    """Wrappers -> what extraction needs of them, as JSON."""
    for df in frames:
        yield pd.DataFrame({"h_": df["host"].tolist(), "plan": [json.dumps(plan(json.loads(w), n)) for w, n in zip(df["wrapper"], df["pages"])]})


def extract(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> page_id, url, text, n_chars.

    The hosts' plans are broadcast while they take at most ``BROADCAST_CHARS`` characters, so pages
    are read in place; beyond, pages meet them in a join on host and one of ``SALTS`` shares.
    """
    known = cut(wrappers(pages).mapInPandas(_plans, "h_ string, plan string"))
    own = pages.select("page_id", "url", "html", F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit("")).alias("host"))

    def run(frames):
        held: dict[str, dict] = {}
        for df in frames:
            texts = []
            for host, page, p in zip(df["host"], df["html"], df["plan"]):
                if host not in held:
                    if len(held) > HOSTS_HELD:
                        held.clear()
                    held[host] = json.loads(p) if isinstance(p, str) else {"where": None, "fixed": {}}
                texts.append(main_text(page, held[host]))
            yield pd.DataFrame({"page_id": df["page_id"], "url": df["url"].tolist(), "text": texts, "n_chars": [len(t) for t in texts]})

    if (known.agg(F.sum(F.length("h_") + F.length("plan"))).first()[0] or 0) <= BROADCAST_CHARS:
        met = own.join(F.broadcast(known), F.col("host") == F.col("h_"), "left")
    else:
        known = known.withColumn("s_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        own = own.withColumn("salt", F.pmod(F.hash("page_id", "url"), F.lit(SALTS)))
        met = own.join(known, (F.col("host") == F.col("h_")) & (F.col("salt") == F.col("s_")), "left")
    kind = dict(pages.dtypes)["page_id"]
    return (met.select("page_id", "url", "html", "host", "plan")
            .mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long"))

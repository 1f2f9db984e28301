"""Secret scans (operator 10): fixed patterns, and token efficiency for random strings.

Four kinds of spans, offsets in code points: ``assign``, ``access`` and ``hex`` by pattern, and
``random``, by the characters that a token of a tiktoken vocabulary covers. Runs of
``[A-Za-z0-9+/_=-]`` are taken apart where pattern spans, known digests (hex of the lengths of MD5,
SHA-1, SHA-2) and identifiers (UUIDs) lie in them; what is left, ``MIN_RUN`` characters or more, is cut into
tokens. Every stretch of tokens that covers ``MIN_RUN`` letters and digits is measured by itself, so a
path or name before a random string does not hide it; ``/ _ = -`` count neither as characters nor as
tokens. Stretches with fewer than ``MAX_CHARS_PER_TOKEN`` characters a token are marked; pieces between
``/ _ = -`` of which half is marked make up a span. A span has a piece of ``MIN_PIECE`` characters or more and both letters
and digits, or both cases; of one case alone it needs fewer than ``MAX_ONE_CASE`` characters a token.

Null and empty texts have no span. Repeated rows give one row each; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_CHARS_PER_TOKEN, MAX_ONE_CASE, MIN_RUN, MIN_PIECE, MAX_END_TOKEN, TOKENIZED_AT_ONCE = 2.2, 1.6, 16, 8, 3, 4096

# The patterns of the base kinds, in the order of their listing.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

RUN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
PIECE = re.compile(r"[A-Za-z0-9+]+")
KNOWN = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
                   r"|[0-9a-fA-F]{128}|[0-9a-fA-F]{96}|[0-9a-fA-F]{64}|[0-9a-fA-F]{56}|[0-9a-fA-F]{40}|[0-9a-fA-F]{32})(?![A-Za-z0-9])")
KEYWORDS = ("passw", "secret", "token", "api")


def ranks(path: str) -> dict[bytes, int]:
    """Pieces of a tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(piece): int(rank) for piece, rank in (line.split() for line in f)}


def encoding(pieces: dict[bytes, int]):
    """The vocabulary as a tiktoken encoding without special tokens."""
    import tiktoken

    pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("secrets", pat_str=pattern, mergeable_ranks=pieces, special_tokens={})


def random_spans(run: str, enc) -> list[tuple[int, int]]:
    """Begin and end of the random strings in a run of letters, digits and ``+/_=-``."""
    sizes, counted = [], []
    for i in range(0, len(run), TOKENIZED_AT_ONCE):
        for token in enc.encode_ordinary(run[i:i + TOKENIZED_AT_ONCE]):
            piece = enc.decode_single_token_bytes(token)
            sizes.append(len(piece))
            counted.append(len(piece) - sum(piece.count(c) for c in b"/_=-"))
    total = lambda x: np.concatenate([[0], np.cumsum(x)])
    at, chars, tokens = total(sizes), total(counted), total(np.array(counted) > 0)
    first = np.arange(len(sizes))
    last = np.searchsorted(chars, chars[:-1] + MIN_RUN)
    first, last = first[last < len(chars)], last[last < len(chars)]
    # a stretch begins and ends in short tokens, so that a word beside the random string stays out
    short = np.append((np.array(counted) > 0) & (np.array(counted) <= MAX_END_TOKEN), False)
    ends = short[first] & short[last - 1]
    first, last = first[ends], last[ends]
    low = chars[last] - chars[first] < MAX_CHARS_PER_TOKEN * (tokens[last] - tokens[first])
    edge = np.zeros(len(run) + 1, np.int64)
    np.add.at(edge, at[first[low]], 1)
    np.add.at(edge, at[last[low]], -1)
    marked = total(np.cumsum(edge)[:-1] > 0)
    groups: list[list[tuple[int, int]]] = [[]]
    for m in PIECE.finditer(run):
        if 2 * (marked[m.end()] - marked[m.start()]) >= m.end() - m.start():
            groups[-1].append(m.span())
        elif groups[-1]:
            groups.append([])
    out = []
    for g in groups:
        if not g or g[-1][1] - g[0][0] < MIN_RUN or max(e - s for s, e in g) < MIN_PIECE:
            continue
        start, end = g[0][0], g[-1][1]
        end += len(run[end:end + 2]) - len(run[end:end + 2].lstrip("="))  # padding of base 64
        # a piece's first letter may be a capital in any word
        body = "".join(run[b:b + 1].lower() + run[b + 1:e] for b, e in g)
        kinds = [any(c.isdigit() for c in body), any(c.islower() for c in body), any(c.isupper() for c in body)]
        i, j = np.searchsorted(at, start, side="right") - 1, np.searchsorted(at, end)
        if sum(kinds) > 1 or kinds[0] < 1 and chars[j] - chars[i] < MAX_ONE_CASE * (tokens[j] - tokens[i]):
            out.append((start, end))
    return out


def find(text: str | None, enc) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and random spans as (start, kind, end), each sorted by start, then kind."""
    if not text:
        return [], []
    spans = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    spans.sort()
    more = []
    runs = [m.span() for m in RUN.finditer(text)]
    # one sweep: runs and what is taken out of them both go up by start
    taken = sorted([(s, e) for s, _, e in spans] + [m.span() for m in KNOWN.finditer(text)]) if runs else []
    k = 0
    for start, end in runs:
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        place, j = start, k
        while place < end:
            while j < len(taken) and taken[j][1] <= place:
                j += 1
            stop = min(end, taken[j][0]) if j < len(taken) else end
            if stop - place >= MIN_RUN:
                more += [(place + s, 3, place + e) for s, e in random_spans(text[place:stop], enc)]
            place = max(stop, taken[j][1]) if j < len(taken) and stop < end else end
    return spans, more


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``docs(doc_id, text)`` -> counts by base kind, their digest, and all spans as text.

    The driver reads the vocabulary, whose size does not depend on the documents, and broadcasts it."""
    held = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))

    def run(frames):
        enc = encoding(held.value)
        for df in frames:
            found = [find(t, enc) for t in df["text"]]
            base = [[sum(s[1] == k for s in b) for b, _ in found] for k in range(3)]
            yield pd.DataFrame({
                "doc_id": df["doc_id"], "n_assign": base[0], "n_access": base[1], "n_hex": base[2],
                "n_random": [len(r) for _, r in found],
                "base_sha256": [hashlib.sha256(listed(b).encode()).hexdigest() for b, _ in found],
                "spans": [listed(b + r) for b, r in found]})

    return docs.select("doc_id", "text").mapInPandas(
        run, "doc_id long, n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string")

"""Secrets in texts: three fixed shapes, and strings that are new to their surroundings.

A candidate near a sensitive word is measured by zstandard, primed with a dictionary of common identifiers: the bytes
that it adds to the text around it, from which its other occurrences are taken. If it adds almost as many as random
strings of its length and alphabet add there, neither the identifiers nor the surroundings explain it, and it is
reported. In the surroundings' frame letters cost what they cost in that text, so an ordinary word of rare length is told
from a random one of the same letters.
"""

from __future__ import annotations

import bisect
import hashlib
import random
import re
import string
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

KINDS = ("assign", "access", "hex", "novel")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that have 24 or more
_CONTEXT = re.compile(r"passw|passphrase|secret|token|credential|bearer|api.?key|private.?key|access.?key|authoriz|signature|(?<![a-z0-9])(?:pwd|key)(?![a-z0-9])", re.I | re.A)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
LEAST = 16
AROUND = 512
NOVELTY = 0.8
DRAWS = 4
LEVEL = 12
_LOW, _UP, _DIGITS = string.ascii_lowercase, string.ascii_uppercase, string.digits
#: The first one that holds all of a candidate's characters is its alphabet.
ALPHABETS = (_DIGITS, _DIGITS + "abcdef", _DIGITS + "ABCDEF", _LOW, _UP, _UP + "234567=", _LOW + "234567=", _LOW + _DIGITS, _UP + _DIGITS, _LOW + _UP, _LOW + _UP + _DIGITS, _LOW + _UP + _DIGITS + "+/_=-")
_IDENTIFIERS = (
    " the and of to in is for with this that from return function class public private static final void string int"
    " import export const let var def self none true false null if else while for each value values name names user username"
    " userName user_name password passwordHash password_hash accessToken access_token refreshToken refresh_token apiKey api_key"
    " secretKey secret_key clientSecret client_secret clientId client_id authorization authentication Authorization Bearer"
    " credentials credentialProvider configuration environment variable example changeme placeholder your-key-here insert_token_here"
    " getElementById addEventListener requestHandler responseHandler createTokenProvider AuthenticationManager SecurityContextHolder"
    " application production development database connection session identifier abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    " 0123456789 https http www com org net path file index html json xml yaml "
).encode()
_PRIMED = zstandard.ZstdCompressionDict(_IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _novel(text: str, start: int, end: int) -> bool:
    word, n = text[start:end], end - start
    # Other places of the same string are no explanation of it, nor are those that the window's ends cut.
    around = text[max(0, start - AROUND - n) : start].replace(word, "\n")[-AROUND:] + "\n" + text[end : end + AROUND + n].replace(word, "\n")[:AROUND]
    known = around.encode("utf-8", "surrogatepass") + b"\n"
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=_PRIMED, write_content_size=False, write_dict_id=False)
    base = len(pack.compress(known))
    added = lambda w: len(pack.compress(known + w.encode() + b"\n")) - base
    alphabet, rng = next(a for a in ALPHABETS if not set(word) - set(a)), random.Random(n)
    return added(word) * DRAWS >= NOVELTY * sum(added("".join(rng.choices(alphabet, k=n))) for _ in range(DRAWS))


def _united(found: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans cover, apart and in order."""
    starts, ends = [], []
    for a, b in sorted((a, b) for _, a, b in found):
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def _covered(starts: list[int], ends: list[int], a: int, b: int) -> bool:
    before = bisect.bisect_left(starts, b) - 1
    return before >= 0 and a < ends[before]


def _candidates(text: str) -> Iterator[tuple[int, int]]:
    """Runs of 16 or more characters with a sensitive word within AROUND of them, before or after.

    A run that only white space parts from such a run is one too, as the lines of a key file are. A run that holds
    sensitive words is cut at them.
    """
    words = [m.span() for m in _CONTEXT.finditer(text)]
    if not words:
        return
    i, last = 0, -1
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        while i < len(words) and words[i][1] <= a - AROUND:
            i += 1
        if not (i < len(words) and words[i][0] < b + AROUND) and not (last >= 0 and text[last:a].isspace()):
            continue
        last, k = b, i
        while k < len(words) and words[k][1] <= a:
            k += 1
        while k < len(words) and words[k][0] < b:
            yield from _part(text, a, words[k][0])
            a, k = words[k][1], k + 1
        yield from _part(text, a, b)


def _part(text: str, a: int, b: int) -> Iterator[tuple[int, int]]:
    while a < b and text[a] == "=":
        a += 1
    if b - a >= LEAST:
        yield a, b


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then by KINDS; ends are exclusive, in code points."""
    text = text or ""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    starts, ends = _united(found)
    found += [("novel", a, b) for a, b in _candidates(text) if not _covered(starts, ends, a, b) and _novel(text, a, b)]
    return sorted(set(found), key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def join(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def redacted(text: str, found: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for _, a, b in sorted(found, key=lambda s: s[1]):
        if b > at:
            out += [text[at:a], "[SECRET]"] if a >= at else []
            at = b
    return "".join(out) + text[at:]


@F.pandas_udf(T.StructType().add("n_assign", "long").add("n_access", "long").add("n_hex", "long").add("base_sha256", "string").add("spans", "string"))
def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        rows = []
        for t in texts:
            found = spans(t)
            base = [s for s in found if s[0] != "novel"]
            n = [sum(s[0] == k for s in base) for k in KINDS[:3]]
            rows.append((*n, hashlib.sha256(join(base).encode()).hexdigest(), join(found)))
        yield pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "spans"])


@F.pandas_udf(T.StringType())
def _redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([None if t is None else redacted(t, found) if (found := spans(t)) else t for t in texts], dtype=object)


def redact(text: Column) -> Column:
    """The text with each span of spans() replaced by [SECRET]; null stays null."""
    return _redact(text)


def secret_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: one row per row of docs, whatever its other columns.

    A null or empty text has no spans, and the hash of the empty string. Null and repeated doc_ids pass through.
    """
    found = F.col("found")
    out = docs.select("doc_id", scan(F.col("text").cast("string")).alias("found"))
    return out.select("doc_id", *[found[c].alias(c) for c in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")])

"""Secret scan: keyword automaton, anchored expressions near hits, checksum validation.

One Aho-Corasick automaton holds every keyword in every mix of cases. Its hits
are the only places where a keyword kind's expression is tried, anchored there.
Hexadecimal runs have no keyword; any run of sixteen covers four neighbours in
a stride of four, so the expression for them is tried only around such a place.
Kinds whose tokens embed a checksum are kept only if it is right.

Kinds: ``assign``, ``access`` and ``hex`` (the base), and ``github`` and ``npm``
tokens, whose last six base-62 digits are the CRC-32 of the thirty before.
Spans are in code points, end exclusive, leftmost and without overlap in a kind.

Nulls and empty texts have no spans. Repeated rows give repeated results.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

# The keywords and expressions of the kinds.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_STRIDE = re.compile(r"[0-9a-f]{4,}")
GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
DIGITS62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
KINDS = ("assign", "access", "hex", "github", "npm")
BASE = 3  #: so many of the kinds are the base
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16


def checksum62(body: str) -> str:
    """CRC-32 of a token's body as six base-62 digits."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS62[digit] + out
    return out


def _long_value(m: re.Match) -> bool:
    return len(m.group(2)) >= MIN_VALUE


def _long_access(m: re.Match) -> bool:
    return m.end() - m.start() >= MIN_ACCESS


def _right_checksum(m: re.Match) -> bool:
    return checksum62(m.group(1)) == m.group(2)


#: By kind with keywords: the anchored expression, and what a match must fulfil.
RULES = {"assign": (ASSIGN, _long_value), "access": (ACCESS, _long_access), "github": (GITHUB, _right_checksum), "npm": (NPM, _right_checksum)}


def automaton() -> ahocorasick.Automaton:
    """Keywords by kind; those of ``assign`` in all mixes of lower and upper case."""
    a = ahocorasick.Automaton()
    for word in ASSIGN_WORDS:
        for cased in itertools.product(*[sorted({c.lower(), c.upper()}) for c in word]):
            a.add_word("".join(cased), ("assign", len(word)))
    a.add_word("AKIA", ("access", 4))
    for letter in "pousr":
        a.add_word(f"gh{letter}_", ("github", 4))
    a.add_word("npm_", ("npm", 4))
    a.make_automaton()
    return a


def _keyword_spans(text: str, hits: dict[str, list[int]]):
    for kind, starts in hits.items():
        expression, right = RULES[kind]
        end = 0
        for start in sorted(starts):
            if start >= end and (m := expression.match(text, start)):
                end = m.end()
                if right(m):
                    yield start, end, kind


def _hex_spans(text: str):
    done = 0
    for near in HEX_STRIDE.finditer(text[3::4]):
        first, last = 4 * near.start() + 3, 4 * near.end() - 1
        if last < done:
            continue
        while first > done and text[first - 1] in "0123456789abcdef":
            first -= 1
        done = HEX.match(text, last).end()
        for m in HEX.finditer(text, first, done):
            if m.end() - m.start() >= MIN_HEX:
                yield m.start(), m.end(), "hex"


def spans_of(text: str | None, words: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, end, kind) of a text, by start, then in the order of the kinds."""
    if not text:
        return []
    hits: dict[str, list[int]] = {}
    for last, (kind, length) in words.iter(text):
        hits.setdefault(kind, []).append(last - length + 1)
    found = [*_keyword_spans(text, hits), *_hex_spans(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _setup() -> Callable:
    words = automaton()

    def scan(ids, texts):
        spans = [spans_of(t, words) for t in texts]
        return {"doc_id": ids, "found": [[{"start": s, "end": e, "kind": k} for s, e, k in x] for x in spans]}

    return scan


def find_secrets(docs: DataFrame) -> DataFrame:
    """(doc_id, found array<struct<start, end, kind>>) of every row of ``docs`` (doc_id, text)."""
    return map_batches(docs, ["doc_id", "text"], _setup, "doc_id bigint, found array<struct<start:bigint, end:bigint, kind:string>>")


def joined(found, kinds):
    """kind:start:end of the spans of some kinds, joined by commas."""
    held = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(held, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text, per row."""
    found = F.col("found")

    def count(kind):
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return find_secrets(docs).select(
        "doc_id",
        *[count(k) for k in KINDS],
        F.sha2(joined(found, KINDS[:BASE]), 256).alias("base_sha256"),
        joined(found, KINDS).alias("spans"),
    )


def _redact_setup() -> Callable:
    words = automaton()

    def redact(text: str | None) -> str | None:
        if not text:
            return text
        out, at = [], 0
        for start, end, kind in spans_of(text, words):
            if start >= at:
                out += [text[at:start], f"<{kind}>"]
            at = max(at, end)
        return "".join(out) + text[at:]

    return redact


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with each secret span in ``text`` replaced by its kind in angle brackets.

    Overlapping spans become the mark of the first. Other columns, whatever
    their names, stay as they are; a null text stays null.
    """
    @F.pandas_udf("string")
    def redacted(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        redact = _redact_setup()
        for part in parts:
            yield pd.Series([redact(t) for t in part], dtype=object)

    return docs.withColumn(text, redacted(F.col(text)))

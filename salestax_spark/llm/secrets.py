"""Secret scan: an Aho-Corasick automaton finds keywords, regular expressions anchored at the hits decide, checksums confirm.

Texts are searched as UTF-8 bytes; all patterns are ASCII, so that gives the same matches as code points would, and
spans are given in code points. Two automata run over each text: keywords over the text with A-Z folded, and a run of 16
hexadecimal digits over the text with its bytes mapped to digit or not.

Kinds, in the order that decides ties: ``assign``, ``access``, ``hex``, then tokens whose last part is a checksum of the rest
(CRC-32 of the random part, in base 62 or hexadecimal): ``github``, ``npm``, ``grafana``; these count only if the checksum holds.
Matches of a kind are leftmost and do not overlap; too short ones are dropped after that.

Cases: a NULL text is an empty one. Repeated rows are scanned each. Extra columns are carried along, but for one called ``secret_spans``, which is
replaced. An empty table gives an empty result. Arrow batches are read a text at a time, so one text at a time is expanded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"
MIN_HEX, MIN_ACCESS, MIN_ASSIGN = 16, 18, 12
BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
IS_HEX = bytes(104 if b in b"0123456789abcdef" else 46 for b in range(256))


def base62_crc(body: bytes) -> bytes:
    value, digits = zlib.crc32(body), b""
    while value:
        value, digit = divmod(value, 62)
        digits = BASE62[digit : digit + 1] + digits
    return digits.rjust(6, b"0")


def _crc_hex(body: bytes) -> bytes:
    return b"%08x" % zlib.crc32(body)


#: Kind, keywords, pattern anchored at the keyword, and what a match has to satisfy.
Rule = tuple[str, tuple[str, ...], re.Pattern[bytes], Callable[[re.Match[bytes]], bool]]
RULES: tuple[Rule, ...] = (
    (
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I),
        lambda m: len(m[2]) >= MIN_ASSIGN,
    ),
    ("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= MIN_ACCESS),
    ("hex", (), re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= MIN_HEX),
    (
        "github",
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
        re.compile(rb"gh[pousr]_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        lambda m: base62_crc(m[1]) == m[2],
    ),
    (
        "npm",
        ("npm_",),
        re.compile(rb"npm_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])"),
        lambda m: base62_crc(m[1]) == m[2],
    ),
    (
        "grafana",
        ("glsa_",),
        re.compile(rb"glsa_([A-Za-z0-9]{32})_([0-9a-f]{8})(?![A-Za-z0-9])"),
        lambda m: _crc_hex(m[1]) == m[2],
    ),
)
HEX_RULE = next(i for i, rule in enumerate(RULES) if rule[0] == "hex")


def automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    words, runs = ahocorasick.Automaton(), ahocorasick.Automaton()
    for i, (_, keywords, _, _) in enumerate(RULES):
        for keyword in keywords:
            words.add_word(keyword, (i, len(keyword)))
    runs.add_word("h" * MIN_HEX, (HEX_RULE, MIN_HEX))
    words.make_automaton()
    runs.make_automaton()
    return words, runs


def find_spans(raw: bytes, words: ahocorasick.Automaton, runs: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind."""
    hits: set[tuple[int, int]] = set()
    for end, (rule, size) in words.iter(raw.translate(FOLD).decode("latin-1")):
        hits.add((end + 1 - size, rule))
    last = -2
    for end, (rule, size) in runs.iter(raw.translate(IS_HEX).decode("latin-1")):
        if end != last + 1:  # the first 16 digits of a run; the next ones hit again
            hits.add((end + 1 - size, rule))
        last = end
    found, free_from = [], [0] * len(RULES)
    for start, rule in sorted(hits):
        kind, _, pattern, valid = RULES[rule]
        if start >= free_from[rule] and (match := pattern.match(raw, start)):
            free_from[rule] = match.end()
            if valid(match):
                found.append((match.start(), rule, match.end(), kind))
    spans, at, points = [], 0, 0
    for start, _, end, kind in sorted(found):
        points += len(raw[at:start].decode("utf-8"))
        at = start
        spans.append((kind, points, points + end - start))  # matches are ASCII
    return spans


def scan_secrets(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` plus ``secret_spans``: array of kind, start, end, by start, then kind."""

    @F.pandas_udf(SPANS)
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        words, runs = automata()
        for texts in batches:
            found = [find_spans(bytes(t), words, runs) for t in texts]
            yield pd.Series([[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans in found], dtype=object)

    raw = F.coalesce(F.encode(F.col(text_column), "UTF-8"), F.lit(b""))
    return docs.withColumn("secret_spans", scan(raw))

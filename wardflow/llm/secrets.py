"""Secret scans: fixed patterns, and strings whose novelty zstandard measures.

Base spans are assignments to password-like names, access key ids and long hexadecimal runs.
The method adds strings that stand near a sensitive word, before or after it, and do not compress:
a candidate's marginal size is what it adds to the compressed text around it, with zstandard primed by
a dictionary of source code and identifiers.  Other copies of the candidate, or of a part of it that
``=`` or ``/`` sets off, are taken out of that text first, so a repeated secret is as novel as a single
one.  A candidate of which each character still costs ``NOVEL_BYTES`` is reported, and with it every
copy in the text, whatever stands near the copy.

Strings without a digit are not measured: to the compressor, long words, paths and names in mixed
case are as novel as random letters.  So a secret of letters alone is found by the base patterns only.

Spans are ``kind:start:end`` in code points, end exclusive.  Null texts count as empty and have no
spans; repeated rows have the same spans; an empty table gives an empty result.  Whole texts are
scanned, however long.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.batches import per_text

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 12, 18
BASE_KINDS = ("assign", "access", "hex")

# A text without any of these cannot hold an assignment.
_NAMES = ("passw", "secret", "token", "api")

# Candidates of the method: unbroken strings of at least this many characters.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
PART = re.compile(r"[A-Za-z0-9+_-]{20,}")
DIGIT = re.compile("[0-9]")
SENSITIVE = re.compile(
    r"key|auth|bearer|credential|private|signature|cookie|session|passw|secret|token|login", re.I
)
CONTEXT = 48  # characters on either side of a candidate that must hold a sensitive word
AROUND = 200  # characters on either side that the candidate is measured against
NOVEL_BYTES = 0.5  # marginal bytes a character

# What ordinary code and identifiers look like to the compressor.
IDENTIFIERS = """
import os sys json logging from typing import Optional class Client def __init__(self, config):
self.session = requests.Session() return response.json() if token is None: raise ValueError
public static final String private void getAccessToken setPassword credentialsProvider
authorization_header refresh_token client_secret api_key_id signature_version session_cookie
const apiKey = process.env.API_KEY; function authenticate(user, password) { return login(user) }
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 ----------------
BEGIN RSA PRIVATE KEY END RSA PRIVATE KEY https://www.example.com/index.html ================
"""


class Scanner:
    """Finds spans; ``known`` primes the compressor with code and identifiers."""

    def __init__(self, known: str = IDENTIFIERS):
        primed = zstandard.ZstdCompressionDict(
            known.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self._compress = zstandard.ZstdCompressor(
            level=3, dict_data=primed, write_content_size=False, write_checksum=False
        ).compress

    def base(self, text: str) -> list[tuple[int, int, str]]:
        found = []
        low = text.lower()
        if any(name in low for name in _NAMES):
            found += [
                (m.start(), m.end(), "assign")
                for m in ASSIGN.finditer(text)
                if m.end(2) - m.start(2) >= ASSIGN_LENGTH
            ]
        if "AKIA" in text:
            found += [
                (m.start(), m.end(), "access")
                for m in ACCESS.finditer(text)
                if m.end() - m.start() >= ACCESS_LENGTH
            ]
        found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
        return sorted(found, key=_order)

    def marginal(self, before: str, candidate: str, after: str) -> int:
        """Bytes that the candidate adds to its compressed surroundings."""
        around = (before + after).encode()
        return len(self._compress((before + candidate + after).encode())) - len(
            self._compress(around)
        )

    def novel(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
        """Copies of incompressible strings in a sensitive context that no base span covers."""
        places: dict[str, list[tuple[int, int]]] = {}
        secret = set()
        # base spans come by start: how far those that began so far reach
        begun, reach = 0, 0
        for m in CANDIDATE.finditer(text):
            start, end = m.span()
            while begun < len(base) and base[begun][0] <= start:
                reach = max(reach, base[begun][1])
                begun += 1
            if end <= reach:
                continue
            candidate = m.group()
            if not DIGIT.search(candidate):
                continue
            parts = {m.span()} | {p.span() for p in PART.finditer(text, start, end) if DIGIT.search(p.group())}
            for a, b in parts:
                places.setdefault(text[a:b], []).append((a, b))
            if not SENSITIVE.search(text, max(0, start - CONTEXT), start) and not SENSITIVE.search(
                text, end, end + CONTEXT
            ):
                continue
            strings = {text[a:b] for a, b in parts}
            before = without(text, max(0, start - AROUND), start, strings)
            after = without(text, end, min(len(text), end + AROUND), strings)
            if self.marginal(before, candidate, after) >= NOVEL_BYTES * (end - start):
                secret |= strings
        found, reached = [], 0
        for start, end in sorted((p for s in secret for p in places[s]), key=lambda p: (p[0], -p[1])):
            if end > reached:
                found.append((start, end, "novel"))
                reached = end
        return found

    def spans(self, text: str) -> tuple[list, list]:
        """Base spans, and all spans, by start and kind."""
        base = self.base(text)
        return base, sorted(base + self.novel(text, base), key=_order)

    def redacted(self, text: str, mark: str) -> str:
        """``text`` with each stretch of overlapping spans replaced by ``mark``."""
        out, at = [], 0
        for start, end, _ in self.spans(text)[1]:
            if start >= at:
                out += [text[at:start], mark]
            at = max(at, end)
        return "".join(out) + text[at:]


def without(text: str, start: int, end: int, strings: set[str]) -> str:
    """``text[start:end]`` without what copies of ``strings`` cover, also those that reach out of it."""
    spans = []
    for string in strings:
        # a copy that reaches out of the piece may begin before it or end behind it
        at = text.find(string, max(0, start - len(string) + 1), end + len(string) - 1)
        while at >= 0:
            spans.append((at, at + len(string)))
            at = text.find(string, at + 1, end + len(string) - 1)
    out, at = [], start
    for a, b in sorted(spans):
        out.append(text[at : max(at, min(a, end))])
        at = max(at, min(b, end))
    return "".join(out) + text[at:end]


_RANK = {kind: k for k, kind in enumerate((*BASE_KINDS, "novel"))}


def _order(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], _RANK[span[2]]


def shown(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _scanned(make: Callable[[], Scanner]) -> Callable:
    kept: list[Scanner] = []

    def run(texts: pa.Array) -> pa.Array:
        scanner = kept[0] if kept else kept.append(make()) or kept[0]
        out: tuple[list, ...] = ([], [], [], [], [])
        for text in texts.to_pylist():
            base, all_ = scanner.spans(text)
            for column, kind in zip(out, BASE_KINDS, strict=False):
                column.append(sum(s[2] == kind for s in base))
            out[3].append(hashlib.sha256(shown(base).encode()).hexdigest())
            out[4].append(shown(all_))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
            ["n_assign", "n_access", "n_hex", "base_sha256", "spans"],
        )

    return run


def secrets(text: Column) -> Column:
    """Counts of base spans, digest of the base spans, and all spans of a text."""
    return per_text(
        _scanned(Scanner),
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )(text)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    return docs.select(F.col(key), secrets(F.col(text)).alias("found")).select(key, "found.*")


def redact(text: Column, mark: str = "[secret]") -> Column:
    """The text without its secrets; a null text becomes empty."""
    kept: list[Scanner] = []

    def run(texts: pa.Array) -> pa.Array:
        scanner = kept[0] if kept else kept.append(Scanner()) or kept[0]
        return pa.array([scanner.redacted(t, mark) for t in texts.to_pylist()], pa.string())

    return per_text(run, "string")(text)

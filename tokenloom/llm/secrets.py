"""Secret scans: base patterns, and sliding-window entropy per character class over candidate strings.

A candidate is a maximal run of at least MIN_LENGTH characters A-Za-z0-9+/_=-. For each of its
character classes (CLASSES) the Shannon entropy of every window of WINDOW characters that lies in
that class is computed from counts that change by one character in and one out per step. Example
marks and identifiers of the allow-list cut a candidate, and each piece between them is judged alone. A
piece with a window above the threshold of a class is a span of kind `entropy`, from the first to the
last such window, less what base spans cover.

Everything happens on whole texts inside one map over the documents; there is no shuffle.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm import kernels
from tokenloom.llm.shared import record_batch

# The base patterns of the contract, on UTF-8 bytes.
ASSIGN = re.compile(rb"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW, MIN_LENGTH = 20, 20
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
# Character classes, with the bits per character from which a window of 20 looks random. Natural
# words stay below: a window must also hold digits and letters (upper and lower for `base64`).
CLASSES = (
    ("hex", re.compile(rb"[0-9a-fA-F]+"), 2.9),
    ("upper", re.compile(rb"[A-Z0-9]+"), 3.4),
    ("base64", re.compile(rb"[A-Za-z0-9+/_=-]+"), 3.7),
)
# Allow-list: example marks of public documentation and identifiers, and pieces that are plain numbers,
# words or paths. A window inside a repeated unit of up to 4 characters has at most 2 bits, below all classes.
MARKS = re.compile(rb"[Ee][Xx][Aa][Mm][Pp][Ll][Ee]|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
ALLOWED = (
    re.compile(rb"[0-9+/_=-]+\Z"),
    re.compile(rb"[A-Za-z]+(?:[-_/=+][A-Za-z]+)*[-_/=+0-9]*\Z"),
)


def base_spans(raw: bytes) -> list[tuple[int, int, int]]:
    """(start, end, kind index) in bytes; failing matches are dropped and not tried again."""
    found = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(raw) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), 1) for m in ACCESS.finditer(raw)]
    found += [(m.start(), m.end(), 2) for m in HEX.finditer(raw)]
    return found


def window_entropies(text: bytes, width: int = WINDOW) -> np.ndarray:
    """Bits per character of each window, from counts updated as the window slides.

    A step changes two counts, so it changes two terms of sum(c log c); the terms are looked up.
    """
    term = [0.0] + [c * math.log2(c) for c in range(1, width + 1)]
    counts = [0] * 256
    total = 0.0
    out = np.empty(max(0, len(text) - width + 1))
    for i, c in enumerate(text):
        if i >= width:
            gone = text[i - width]
            total += term[counts[gone] - 1] - term[counts[gone]]
            counts[gone] -= 1
        total += term[counts[c] + 1] - term[counts[c]]
        counts[c] += 1
        if i >= width - 1:
            out[i - width + 1] = math.log2(width) - total / width
    return out


def _looks_mixed(piece: bytes, name: str) -> bool:
    digit = any(48 <= c <= 57 for c in piece)
    upper, lower = piece.upper() != piece, piece.lower() != piece
    return digit and (upper or lower) and (name != "base64" or (upper and lower))


def _pieces(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Start and bytes of what the allow-list leaves of the candidates."""
    for m in CANDIDATE.finditer(raw):
        at = m.start()
        for mark in [*MARKS.finditer(raw, m.start(), m.end()), None]:
            piece = raw[at : mark.start() if mark else m.end()]
            if len(piece) >= WINDOW and not any(p.match(piece) for p in ALLOWED):
                yield at, piece
            at = mark.end() if mark else m.end()


def _outside(start: int, end: int, covered: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The parts of a span that no span of `covered` meets."""
    out = []
    for s, e, _ in sorted(covered):
        if e > start and s < end:
            if s > start:
                out.append((start, s))
            start = max(start, e)
    return [*out, (start, end)] if start < end else out


def entropy_spans(raw: bytes, covered: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of high entropy outside base spans and what the allow-list knows."""
    out = []
    for at, piece in _pieces(raw):
        best: list[int] = []
        for name, pattern, least in CLASSES:
            for run in pattern.finditer(piece):
                if run.end() - run.start() < WINDOW or not _looks_mixed(run.group(), name):
                    continue
                high = np.flatnonzero(window_entropies(run.group()) >= least)
                if len(high):
                    best += [run.start() + int(high[0]), run.start() + int(high[-1]) + WINDOW]
        if best:
            out += [(s, e, 3) for s, e in _outside(at + min(best), at + max(best), covered)]
    return out


def scan(raw: bytes) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind, in code points."""
    base = base_spans(raw)
    spans = sorted(base + entropy_spans(raw, base), key=lambda s: (s[0], s[2], s[1]))
    if spans and not raw.isascii():
        at = kernels.code_points(np.frombuffer(raw, np.uint8))
        spans = [(int(at[s]), int(at[e]), k) for s, e, k in spans]
    return spans


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)


OUT = ("doc_id long, n_assign long, n_access long, n_hex long, n_entropy long, base_sha256 string, spans string")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of `docs` (doc_id, text): counts by kind, digest of the base spans, all spans.

    Null and empty texts have no spans. Spans are kind:start:end in code points, end exclusive, by
    start and then kind. Repeated rows give repeated results; other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            data, offsets = kernels.column_bytes(batch.column("text"))
            whole = data.tobytes()
            rows = [[] for _ in range(6)]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                spans = scan(whole[a:b])
                for k in range(4):
                    rows[k].append(sum(s[2] == k for s in spans))
                rows[4].append(hashlib.sha256(_joined([s for s in spans if s[2] < 3]).encode()).hexdigest())
                rows[5].append(_joined(spans))
            yield record_batch(OUT, batch.column("doc_id"), *rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, OUT)


def mask_secrets(docs: DataFrame, mask: str = "█") -> DataFrame:
    """`docs` with every character of a secret replaced; all other columns stay."""

    @F.pandas_udf("string")
    def masked(texts):
        def one(text):
            if text is None:
                return None
            parts, at = [], 0
            for s, e, _ in scan(text.encode()):
                s = max(s, at)
                if e > s:
                    parts += [text[at:s], mask * (e - s)]
                    at = e
            return "".join([*parts, text[at:]])

        return texts.map(one, na_action="ignore")

    return docs.withColumn("text", masked("text"))

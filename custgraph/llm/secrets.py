"""Secret scan: keyword automaton first, anchored patterns at its hits, checksums inside tokens last.

An Aho-Corasick automaton finds the keywords of all kinds in one pass over the text with A-Z
lowered; each kind's pattern is tried only where one of its keywords starts. Long hex runs have no
keyword and are found by their own scan. Tokens that carry a CRC-32 of themselves are reported
only if it is right.

Defined results: a null or empty text has no spans; offsets are code points, end exclusive; rows
repeated under one id give one row each; texts are scanned whole; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "checked")  # in the order in which spans with one start are listed
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
#: Keywords by kind, lower case.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "checked": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
}
#: Digits of base 62 in the checksum of such tokens.
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum(body: str) -> str:
    """The six base-62 digits that end a token with this body."""
    value, out = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        out = DIGITS[digit] + out
    return out


@lru_cache(maxsize=1)
def automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def lowered(text: str) -> str:
    """``text`` with A-Z lowered and every position kept."""
    return text.lower() if text.isascii() else text.encode().lower().decode()


def find(text: str) -> list[tuple[int, int, str, int]]:
    """(start, place of the kind, kind, end) of all secrets, sorted."""
    starts: dict[str, list[int]] = {"assign": [], "access": [], "checked": []}
    for end, (kind, size) in automaton().iter(lowered(text)):
        starts[kind].append(end - size + 1)
    spans = [(m.start(), 2, "hex", m.end()) for m in HEX.finditer(text)]
    for place, kind, pattern in ((0, "assign", ASSIGN), (1, "access", ACCESS), (3, "checked", CHECKED)):
        free = 0  # matches of a kind do not overlap, those that fail the test included
        for start in sorted(starts[kind]):
            found = pattern.match(text, start) if start >= free else None
            if found is None:
                continue
            free = found.end()
            if kind == "assign":
                good = len(found.group(1)) >= 6
            elif kind == "access":
                good = free - start >= 20
            else:
                good = checksum(found.group(1)) == found.group(2)
            if good:
                spans.append((start, place, kind, free))
    return sorted(spans)


def redact(text: str, mark: str = "[REDACTED]") -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    out, at = [], 0
    for start, _, _, end in find(text):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, n_checked, base_sha256, spans) of every text; no shuffle."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        for batch in batches:
            counts, digests, listed = [[] for _ in KINDS], [], []
            for i in range(batch.num_rows):
                spans = find(batch.column(1)[i].as_py() or "")
                for place, held in enumerate(counts):
                    held.append(sum(s[1] == place for s in spans))
                base = ",".join(f"{k}:{a}:{b}" for a, place, k, b in spans if place < 3)
                digests.append(hashlib.sha256(base.encode()).hexdigest())
                listed.append(",".join(f"{k}:{a}:{b}" for a, _, k, b in spans))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(digests, pa.string()), pa.array(listed, pa.string())],
                names=[identifier, *[f"n_{k}" for k in KINDS], "base_sha256", "spans"],
            )

    numbers = ", ".join(f"n_{k} long" for k in KINDS)
    return docs.select(identifier, text).mapInArrow(work, f"`{identifier}` {kind}, {numbers}, base_sha256 string, spans string")


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced; null stays null, other columns are kept."""
    at = docs.columns.index(text)

    def work(batches):
        for batch in batches:
            cleaned = [x if x is None else redact(x) for x in batch.column(at).to_pylist()]
            yield batch.set_column(at, batch.schema.field(at), pa.array(cleaned, batch.schema.field(at).type))

    return docs.mapInArrow(work, docs.schema)

"""Exact token counts of every prefix by dynamic programming over byte-pair merges.

A vocabulary file of the ``tokenizers`` library (byte-level BPE) is read for its ranks alone; the
library does not count. A text is cut into the pieces of the byte-level pattern. Within a piece,
the last token of a prefix is the one that ends there, starts where another prefix ends, and may
follow that prefix's last token; such a pair may stand side by side if merging the bytes of the two
gives the two again. Exactly one token qualifies, so one pass gives the count of every prefix.

Defined results: a null or empty text has no tokens; special strings in a text are one token each,
as the library reads them by default; texts of any length are counted whole.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: The pattern of byte-level pre-tokenization.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class is the same in all Unicode versions; other texts are cut by the library.
UNSTABLE = r"[^\u0000-\u052f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u3001-\u30ff\u4e00-\u9fa5\uac00-\ud7a3]"
#: The same pattern for texts in which a letter is a word character but neither digit nor underline.
LATIN_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+"
FOREIGN = r"[^\x00-\xb1\xb4-\xb8\xba\xbb\xbf-\u024f]"
REMEMBERED = 600_000  # pieces whose count a worker remembers before it starts anew
_NEVER = 1 << 30


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class PrefixCounter:
    """Counts tokens of prefixes under the vocabulary file ``path``."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        spell = lambda s: bytes(letters[c] for c in s)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(spell(a), spell(b)): i for i, (a, b) in enumerate(pairs)}
        special = {t["content"] for t in spec["added_tokens"]}
        self.tokens = [spell(t) for t in spec["model"]["vocab"] if t not in special]
        self.trie: dict = {}  # byte -> next node; -1 -> number of the token that ends here
        for number, token in enumerate(self.tokens):
            node = self.trie
            for byte in token:
                node = node.setdefault(byte, {})
            node[-1] = number
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.pattern, self.unstable, self.path = regex.compile(PATTERN), regex.compile(UNSTABLE), path
        self.plain, self.foreign, self.controls = re.compile(LATIN_PATTERN), re.compile(FOREIGN), re.compile("[\x1c-\x1f]")
        self.fits: dict[int, bool] = {}
        self.spines: dict[bytes, tuple[list, list, bool]] = {}
        self.counts = _Counts(self)
        self._library = None

    def merge(self, data: bytes) -> list[tuple]:
        """Merge trees (bytes, rank, left, right) of a few bytes by applying the lowest-ranked merge again and again."""
        parts = [(data[i : i + 1], -1, None, None) for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get((a[0], b[0]), _NEVER) for a, b in zip(parts, parts[1:])]
            lowest = min(ranks)
            if lowest == _NEVER:
                break
            at = ranks.index(lowest)
            left, right = parts[at : at + 2]
            parts[at : at + 2] = [(left[0] + right[0], lowest, left, right)]
        return parts

    def spine(self, token: bytes) -> tuple[list, list, bool]:
        """Parts along the left and right edge of a token's merge tree, each with the rank of the merge
        that takes it up, and whether the token's bytes merge to the token at all."""
        found = self.spines.get(token)
        if found is None:
            trees = self.merge(token)
            edges = []
            for side in (2, 3):
                edge, node, above = [], trees[0 if side == 2 else -1], _NEVER
                while node is not None:
                    edge.append((node[0], above))
                    above, node = node[1], node[side]
                edges.append(edge[::-1])
            found = self.spines[token] = (*edges, len(trees) == 1)
        return found

    def adjacent(self, left: int, right: int) -> bool:
        """Whether two tokens can stand side by side: no merge across the border comes before those inside.

        Merges happen in the order of their ranks, as a merge's parts rank before it. So only the
        parts at the border matter: the right edge of the left token and the left edge of the right.
        """
        a, b, i, j = self.spine(self.tokens[left])[1], self.spine(self.tokens[right])[0], 0, 0
        while True:
            (part, up), (other, over) = a[i], b[j]
            across = self.rank.get((part, other), _NEVER)
            if across < up and across <= over and across != _NEVER:
                return False
            if up == over == _NEVER:
                return True
            if up <= over:
                i += 1
            else:
                j += 1

    def piece_counts(self, piece: bytes) -> list[int]:
        """Tokens of each prefix of one piece, from 0 bytes to all."""
        size, fits = len(piece), self.fits
        if len(fits) > 4 * REMEMBERED:
            fits.clear()
        counts, last = [0] * (size + 1), [-1] * (size + 1)
        for start in range(size):
            node, before, count = self.trie, last[start] << 20, counts[start] + 1
            for end in range(start, size):
                node = node.get(piece[end])
                if node is None:
                    break
                token = node.get(-1)
                if token is not None and last[end + 1] < 0:
                    fit = fits.get(before | token) if start else self.spine(self.tokens[token])[2]
                    if fit is None:
                        fit = fits[before | token] = self.adjacent(before >> 20, token)
                    if fit:
                        last[end + 1], counts[end + 1] = token, count
        return counts

    def pieces(self, text: str) -> list[str]:
        """Pieces of a text without special strings."""
        if text.isascii() or not self.foreign.search(text):
            if not self.controls.search(text):
                return self.plain.findall(text)
        if not self.unstable.search(text):
            return self.pattern.findall(text)
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path).pre_tokenizer
        return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text between special strings, and those strings (True)."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        yield text[at:], False

    def count(self, text: str) -> int:
        """Tokens of a whole text: the last entry of its prefix counts."""
        if self.special is None or not self.special.search(text):
            return sum(map(self.counts.__getitem__, self.pieces(text)))
        return sum(1 if special else sum(map(self.counts.__getitem__, self.pieces(part))) for part, special in self.segments(text))

    def prefix_counts(self, text: str) -> list[int]:
        """Tokens of text[:k] for every k from 0 to len(text), as the library encodes that prefix."""
        out, total, tally = [0], 0, lambda x: sum(map(self.counts.__getitem__, self.pieces(x)))
        clean = ""  # what stands between the last special string and here
        for part, special in self.segments(text):
            if special:
                # Cut short, the string is ordinary text that goes on from what stands before it.
                before = total - tally(clean)
                out += [before + tally(clean + part[:k]) for k in range(1, len(part))]
                total, clean = total + 1, ""
                out.append(total)
                continue
            clean, blank = part, ""
            for piece in self.pieces(part):
                # Blanks that lead a piece belong to the run of blanks before it while nothing follows them.
                joined = (len(piece) if piece.isspace() else int(piece[0] == " ")) if blank else 0
                for k in range(1, joined + 1):
                    out.append(total - self.counts[blank] + self.counts[blank + piece[:k]])
                if piece in ("'re", "'ve", "'ll"):
                    out += [total + self.counts["'"], total + self.counts["'"] + self.counts[piece[1]], total + self.counts[piece]]
                elif joined < len(piece):
                    steps, size = self.piece_counts(piece.encode()), len(piece[:joined].encode())
                    for letter in piece[joined:]:
                        size += len(letter.encode())
                        out.append(total + steps[size])
                total += self.counts[piece]
                blank = piece if piece.isspace() else ""
        return out

class _Counts(dict):
    """Token count of pieces, found when first asked for and forgotten when there are too many."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, piece: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        count = self[piece] = self.counter.piece_counts(piece.encode())[-1]
        return count


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """The counter of a vocabulary file, read once by each worker."""
    return PrefixCounter(path)


def longest_prefix(counts: list[int], budget: int) -> int:
    """Characters of the longest prefix that has at most ``budget`` tokens and no prefix of which has more."""
    for k, count in enumerate(counts):
        if count > budget:
            return k - 1
    return len(counts) - 1


def count_tokens(docs: DataFrame, path: str, limit: int = 512, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text; no shuffle."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        own = counter(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            tokens = [own.count(x) for x in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                names=[identifier, "n_bytes", "n_tokens", "over_limit"],
            )

    schema = f"`{identifier}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return docs.select(identifier, text).mapInArrow(work, schema)


def prefix_table(docs: DataFrame, path: str, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, counts): counts[k] is the exact number of tokens of the first k characters."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        own = counter(path)
        for batch in batches:
            for i in range(batch.num_rows):
                counts = own.prefix_counts(batch.column(1)[i].as_py() or "")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), pa.array([counts], pa.list_(pa.int32()))], names=[identifier, "counts"]
                )

    return docs.select(identifier, text).mapInArrow(work, f"`{identifier}` {kind}, counts array<int>")


def truncate(docs: DataFrame, path: str, budget: int, identifier: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): each text cut to the longest prefix within ``budget`` tokens, without encoding it again."""
    kind = docs.schema[identifier].dataType.simpleString()

    def work(batches):
        own = counter(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            cut = [x[: longest_prefix(own.prefix_counts(x), budget)] for x in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cut, pa.string())], names=[identifier, text])

    return docs.select(identifier, text).mapInArrow(work, f"`{identifier}` {kind}, `{text}` string")

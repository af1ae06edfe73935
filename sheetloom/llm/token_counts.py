"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair pieces.

A text is cut into pieces by the tokenizer's pattern. Inside a piece the encoding of a prefix is the
encoding of a shorter prefix plus one last token, and that token is the only vocabulary entry ending there
that stands next to the token before it without being merged differently. So one pass over a piece gives
the count at each of its prefixes; sums over pieces give the count at each prefix of the text. Truncation
and budget questions are looked up in these counts and nothing is encoded again.

Counts equal those of the ``tokenizers`` library for the same file, with special strings inside texts
counted as one token each (its default) and nothing added, cut or padded. A prefix that ends inside white
space, a contraction or a special string is counted as the library would count that prefix.

Scale: rows are independent; no shuffle. Distinct pieces are kept per task in a table of bounded size.
Defined results: null counts as an empty text; an empty text has no tokens; long texts are counted whole.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_right
from functools import lru_cache
from itertools import accumulate

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
KEPT_PIECES = 400_000  # distinct pieces whose counts a task remembers
KEPT_PAIRS = 1_000_000

# Fixed value: how byte-level vocabularies of this family cut a text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_CONTRACTIONS = frozenset(["'re", "'ve", "'ll"])
# Blocks whose character classes are the same in every Unicode version in use; other texts are cut by the library.
_SETTLED = [(0, 0x557), (0x2010, 0x2064), (0x3001, 0x3029), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]
_UNSETTLED = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}".replace("\x00", r"\x00") for a, b in _SETTLED) + "]")


def _class(kind: str) -> str:
    """The members of a character class within the settled blocks, as ranges for the plain pattern engine."""
    has, ranges = regex.compile(kind).fullmatch, []
    for first, end in _SETTLED:
        for i in range(first, end + 1):
            if has(chr(i)):
                if ranges and ranges[-1][1] == i - 1:
                    ranges[-1][1] = i
                else:
                    ranges.append([i, i])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


_L, _N, _S = map(_class, (r"\p{L}", r"\p{N}", r"\s"))
_PIECES = re.compile(PATTERN.replace(r"[^\s\p{L}\p{N}]", f"[^{_S}{_L}{_N}]").replace(r"\p{L}", f"[{_L}]").replace(r"\p{N}", f"[{_N}]")
                     .replace(r"\S", f"[^{_S}]").replace(r"\s", f"[{_S}]"))
_BLANK = frozenset(chr(i) for i in range(0x3001) if regex.match(r"\s", chr(i)))
_BLANK_RUN = re.compile("[" + "".join(re.escape(c) for c in sorted(_BLANK)) + "]{2,}")

RESULT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("fitting_chars", T.LongType()), T.StructField("prefix_counts", T.BinaryType())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _byte_letters() -> dict[str, int]:
    """Printable stand-ins of byte-level vocabularies: printable bytes are themselves, the others follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters = {chr(b): b for b in plain}
    for k, b in enumerate(b for b in range(256) if b not in set(plain)):
        letters[chr(256 + k)] = b
    return letters


class PrefixCounter:
    """Counts of one vocabulary; ``path`` is a tokenizer file that every executor has installed."""

    def __init__(self, path: str):
        import ahocorasick
        from tokenizers.pre_tokenizers import ByteLevel

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = _byte_letters()
        special = {t["content"] for t in spec["added_tokens"]}
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.library = ByteLevel(add_prefix_space=False, use_regex=True)
        self.names = [bytes([letters[c] for c in token]) for token in spec["model"]["vocab"] if token not in special]
        self.order: dict[tuple[bytes, bytes], int] = {}
        for k, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.order[bytes([letters[c] for c in a]), bytes([letters[c] for c in b])] = k
        self.pairs: dict[int, bool] = {}
        self.pieces: dict[str, bytes | tuple[int, ...]] = {}
        self.ending = ahocorasick.Automaton()
        for i, name in enumerate(self.names):
            if len(self.merged(name)) == 1:  # others never come out of the merges
                self.ending.add_word(name.decode("latin-1"), (i, len(name)))
        self.ending.make_automaton()

    def merged(self, data: bytes) -> list[bytes]:
        """Byte-pair merges of a few bytes, the earliest rule first."""
        parts, order = [data[i:i + 1] for i in range(len(data))], self.order
        while len(parts) > 1:
            rank, i = min([(order.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:], strict=False))])
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def adjacent(self, left: int, right: int) -> bool:
        """Whether two tokens next to each other stay as they are."""
        if len(self.pairs) >= KEPT_PAIRS:
            self.pairs.clear()
        a, b = self.names[left], self.names[right]
        known = self.pairs[left << 32 | right] = self.merged(a + b) == [a, b]
        return known

    def piece(self, piece: str) -> bytes | tuple[int, ...]:
        """Token counts at the end of each code point of one piece."""
        known = self.pieces.get(piece)
        if known is not None:
            return known
        if len(self.pieces) >= KEPT_PIECES:
            self.pieces.clear()
        data = piece.encode()
        n, pairs, adjacent = len(data), self.pairs.get, self.adjacent
        last, count = [-1] * (n + 1), [0] * (n + 1)
        # tokens that end at each byte, the longest first; exactly one of them goes with the token before it
        for end, (token, length) in self.ending.iter(data.decode("latin-1")):
            end += 1
            if count[end]:
                continue
            start = end - length
            if start:
                fits = pairs(last[start] << 32 | token)
                if fits is None:
                    fits = adjacent(last[start], token)
                if not fits:
                    continue
            last[end], count[end] = token, count[start] + 1
        ends = count[1:] if n == len(piece) else [count[i] for i in range(1, n + 1) if i == n or data[i] & 0xC0 != 0x80]
        found = bytes(ends) if max(ends) < 256 else tuple(ends)
        if n <= 256:
            self.pieces[piece] = found
        return found

    def split(self, text: str) -> list[str]:
        """Pieces of a text without special strings."""
        if _UNSETTLED.search(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]
        return _PIECES.findall(text)

    def counts(self, pieces: list[str]) -> list[int]:
        known, piece = self.pieces.get, self.piece
        return [(known(p) or piece(p))[-1] for p in pieces]

    def total(self, text: str) -> int:
        """Tokens of a whole text."""
        if self.special and (marks := len(self.special.findall(text))):
            return marks + sum(self.total(part) for part in self.special.split(text))
        return sum(self.counts(self.split(text)))

    def along(self, pieces: list[str], base: int = 0) -> list[int]:
        """Counts at the end of each code point of consecutive pieces, ``base`` tokens being before them."""
        counts: list[int] = []
        total, space, space_base = base, "", base
        for p in pieces:
            ends = self.piece(p)
            blank = all(c in _BLANK for c in p)
            lead = len(p) if blank else 1 if p[0] == " " else 0
            if lead:
                # a prefix that ends in white space has the whole run of it as its last piece
                run = self.piece(space + p[:lead])
                counts += [space_base + run[len(space) + k] for k in range(lead)]
            if not blank:
                inner = [total + e for e in ends[lead:]]
                if p in _CONTRACTIONS:
                    inner[1] = inner[0] + self.piece(p[1])[-1]
                counts += inner
            total += ends[-1]
            space, space_base = (space + p, space_base) if blank else ("", total)
        return counts

    def joined(self, text: str) -> np.ndarray:
        """Counts at the end of each code point of a text without special strings.

        The counts inside pieces are bytes that are remembered with the pieces; joined and raised by the sum of the
        pieces before, they are the text's. Only where a prefix is cut otherwise than the text they are put right.
        """
        pieces = self.split(text)
        known, piece = self.pieces.get, self.piece
        ends = [known(p) or piece(p) for p in pieces]
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(sizes)
        try:
            inside = np.frombuffer(b"".join(ends), np.uint8).astype(np.int32)
        except TypeError:  # a piece of more than 255 tokens
            inside = np.concatenate([np.frombuffer(e, np.uint8).astype(np.int32) if isinstance(e, bytes) else np.array(e, np.int32) for e in ends])
        totals = inside[stops - 1].cumsum(dtype=np.int32)
        before = np.concatenate([np.zeros(1, np.int32), totals[:-1]]) if len(pieces) else totals
        counts = inside + np.repeat(before, sizes)
        # a prefix that ends in white space has the whole run of it as its last piece
        for run in _BLANK_RUN.finditer(text):
            start, end = run.span()
            own = piece(run.group())
            counts[start:end] = (np.frombuffer(own, np.uint8) if isinstance(own, bytes) else np.array(own, np.int32)) + (counts[start - 1] if start else np.int32(0))
        # and one that ends inside a contraction has none
        if "'" in text:
            for k, p in enumerate(pieces):
                if p in _CONTRACTIONS:
                    at = int(stops[k]) - len(p)
                    counts[at + 1] = counts[at] + piece(p[1])[-1]
        return counts

    def counts_along(self, text: str) -> np.ndarray:
        """Counts at the end of each code point."""
        if not (self.special and self.special.search(text)):
            return self.joined(text)
        counts, base, at = [], 0, 0
        for mark in self.special.finditer(text):
            part = text[at:mark.start()]
            counts.append(self.joined(part) + base)
            inside = self.joined(part + mark.group())[len(part):-1] + base
            base += self.total(part) + 1
            counts += [inside, np.array([base], np.int32)]
            at = mark.end()
        return np.concatenate([*counts, self.joined(text[at:]) + base]).astype(np.int32)

    def prefixes(self, text: str) -> list[int]:
        return self.counts_along(text).tolist()

    def count_and_fit(self, text: str, budget: int) -> tuple[int, int]:
        """Tokens of a text, and code points of its longest prefix of at most ``budget`` tokens."""
        if self.special and self.special.search(text):
            counts = self.prefixes(text)
            return counts[-1], max((i + 1 for i, c in enumerate(counts) if c <= budget), default=0)
        pieces = self.split(text)
        sums = list(accumulate(self.counts(pieces)))
        if not sums or sums[-1] <= budget:
            return sums[-1] if sums else 0, len(text)
        first = over = bisect_right(sums, budget)  # the piece that the budget ends in
        while first and pieces[first][0] in _BLANK and pieces[first - 1][-1] in _BLANK:
            first -= 1
        counts = self.along(pieces[first:over + 3], sums[first - 1] if first else 0)
        inside = max((i + 1 for i, c in enumerate(counts) if c <= budget), default=0)
        return sums[-1], sum(map(len, pieces[:first])) + inside


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, limit: int = LIMIT, store: bool = False, path: str | None = None,
                 text_col: str = "text", into: str = "tokens") -> DataFrame:
    """Rows of ``docs`` with a struct: n_bytes, n_tokens, fitting_chars (longest prefix within ``limit`` tokens).

    ``store=True`` also keeps the count at every prefix as little-endian 32-bit numbers, one per code point,
    which ``stored_count`` and ``stored_fit`` answer from; the other numbers are then looked up there as well.
    """
    path = path or default_path()

    def make():
        dp = counter(path)

        def work(batch):
            out: dict[str, list] = {f.name: [] for f in RESULT}
            for data in as_bytes(batch.column(text_col)).to_pylist():
                text = (data or b"").decode("utf-8", "replace")
                kept = dp.counts_along(text).astype("<i4").tobytes() if store else None
                n, fitting = (stored_count(kept, len(text)), stored_fit(kept, limit)) if store else dp.count_and_fit(text, limit)
                out["n_bytes"].append(len(data or b""))
                out["n_tokens"].append(n)
                out["fitting_chars"].append(fitting)
                out["prefix_counts"].append(kept)
            return out
        return work

    return append_struct(docs, into, RESULT, make, text_col)


def stored_count(prefix_counts: bytes, chars: int) -> int:
    """Tokens of the prefix of ``chars`` code points."""
    return int(np.frombuffer(prefix_counts, "<i4")[chars - 1]) if chars and prefix_counts else 0


def stored_fit(prefix_counts: bytes, budget: int) -> int:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = np.flatnonzero(np.frombuffer(prefix_counts, "<i4") <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0

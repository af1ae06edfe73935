"""Byte-pair encoding by a streaming transducer with bounded lookahead, and decoding by a state machine.

**Sufficient lookahead.** Merge rules apply in the order of the list. Take a word and its first n letters
alone. Both begin with the same letters as tokens; a rule (u, v) can make them differ further left only
where v stands behind the place up to which they agree and u before it, and then they agree up to the start
of u. The next rule that moves this place comes later in the list, and its v begins with that u. So the
farthest place that letters to come can change is the longest chain of such rules, measured by the lengths
of their u: ``reach(u, v) = len(u) + max(reach of earlier rules whose u is a prefix of v)``. The largest reach
is the list's lookahead. It holds for lists in which both parts of a rule come out of earlier rules and every
token of one rule only; others are refused.

**Transducer.** A word's letters are fed in any portions. Once more letters than the lookahead are held, the
merges of what is held are worked out and every token that ends before the lookahead is final and leaves; so a
word of any length needs memory for a window only. A vocabulary with word ends puts its mark on a word's last
letter, which may be the last one held, so one letter more is kept back. Words of up to ``KEPT_LETTERS``
letters are remembered, in a table of bounded size.

**Decoding.** A machine takes ids in any portions and gives text; its state is the bytes of a character not yet
complete and whether a token came before.

Ids are those of the ``tokenizers`` library for the same file with ``add_special_tokens=False`` and without
truncation or padding: special strings inside a text are one token each; text between them is normalised, cut
into words and encoded. Decoded text is that of ``decode(ids, skip_special_tokens=False)``.

Scale: rows are independent, no shuffle. A text is worked through in parts of about ``PART`` characters, cut at
a space between ASCII letters, where no word, normalisation or special string reaches across. Defined results:
null counts as an empty text, which has no tokens and an empty decoded text; bytes that are no UTF-8 count as U+FFFD;
very long texts and words are encoded whole; every row has its own result, repeated or without id or not; other
columns pass through, one called like the result is replaced.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes
from sheetloom.llm.token_counts import _L, _N, _S, _UNSETTLED, _byte_letters

VOCABULARY = "word_bpe_49k.json"
PART = 1 << 16
KEPT_WORDS, KEPT_LETTERS = 400_000, 64
LEAST_WINDOW = 1_024  # letters; a window holds four times the lookahead at least
IDS_AT_A_TIME = 1 << 16

# The normaliser and the word pattern of the vocabulary that the plain pattern engine stands in for.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")

RESULT = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def sufficient_lookahead(rules: list[tuple[str, str]], end: str = "") -> int:
    """Letters behind a place that can still change the tokens before it."""
    made, best, longest = set(), {}, 0
    for u, v in rules:
        name = u + v
        v = v.removesuffix(end) if end else v
        if name in made or (len(u) > 1 and u not in made) or (len(v) > 1 and name[len(u):] not in made):
            raise ValueError(f"merge list is not in order at {u!r} {v!r}")
        made.add(name)
        reach = len(u) + max((best[v[:k]] for k in range(1, len(v) + 1) if v[:k] in best), default=0)
        best[u] = max(best.get(u, 0), reach)
        longest = max(longest, reach)
    return longest


class Vocabulary:
    """Merges, names and words of one tokenizer file that every executor has installed."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, marks = spec["model"], spec["added_tokens"]
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("only plain byte-pair vocabularies")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] and spec["normalizer"] for t in marks):
            raise ValueError("only special strings that stand for themselves")
        self.end = model["end_of_word_suffix"] or ""
        number: dict[str, int] = model["vocab"]
        rules = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.lookahead = sufficient_lookahead(rules, self.end)
        self.window = max(LEAST_WINDOW, 4 * self.lookahead)
        self.made = [-1, *(number[u + v] for u, v in rules)]  # rules are numbered from 1
        self.rank = {(number[u], number[v]): k for k, (u, v) in enumerate(rules, 1)}
        letters = _byte_letters()
        self.first = {b: number[c] for c, b in letters.items()}
        self.last = {b: number[c + self.end] for c, b in letters.items()}
        self.marks = {t["content"]: t["id"] for t in marks}
        self.mark = re.compile("|".join(map(re.escape, sorted(self.marks, key=len, reverse=True)))) if marks else None
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        split = ((spec["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
        self.plain_words = ((spec["normalizer"] or {}).get("normalizers") == NORMALIZERS and split.get("invert") is True
                            and split.get("behavior") == "Removed" and (split.get("pattern") or {}).get("Regex") == WORDS)
        names = {i: n for n, i in [*number.items(), *self.marks.items()]}
        joined = (spec["decoder"] or {}).get("type") is None  # without a decoder, names are joined by spaces
        if not joined and spec["decoder"]["type"] != "ByteLevel":
            raise ValueError("only byte-level decoders")
        self.between = b" " if joined else b""
        self.shown = {i: n.encode() if joined else self._bytes(n, letters) for i, n in names.items()}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _bytes(name: str, letters: dict[str, int]) -> bytes:
        return bytes([letters[c] for c in name]) if all(c in letters for c in name) else name.encode()

    def merged(self, data: bytes, ends: bool) -> list[tuple[int, int]]:
        """(token, letters) of consecutive letters by the merge list; ``ends`` puts the word's end on the last."""
        tokens = [self.first[b] for b in data]
        if ends:
            tokens[-1] = self.last[data[-1]]
        n, rank = len(tokens), self.rank
        size, after, before = [1] * n, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rule, i, tokens[i], tokens[i + 1]) for i in range(n - 1) if (rule := rank.get((tokens[i], tokens[i + 1])))]
        heapq.heapify(heap)
        while heap:
            rule, i, u, v = heapq.heappop(heap)
            j = after[i]
            if not size[i] or tokens[i] != u or j >= n or tokens[j] != v:
                continue
            tokens[i], size[i], size[j] = self.made[rule], size[i] + size[j], 0
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if rule := rank.get((tokens[i], tokens[j])):
                    heapq.heappush(heap, (rule, i, tokens[i], tokens[j]))
            if (h := before[i]) >= 0 and (rule := rank.get((tokens[h], tokens[i]))):
                heapq.heappush(heap, (rule, h, tokens[h], tokens[i]))
        return [(tokens[i], size[i]) for i in range(n) if size[i]]

    def merged_short(self, data: bytes) -> list[int]:
        """Tokens of a short word: the same merges, found by looking along all pairs."""
        tokens = [self.first[b] for b in data[:-1]] + [self.last[data[-1]]]
        rank, none = self.rank.get, len(self.made)
        rules = [rank(pair, none) for pair in zip(tokens, tokens[1:], strict=False)]
        while rules and (rule := min(rules)) != none:
            i = rules.index(rule)
            tokens[i:i + 2] = [self.made[rule]]
            del rules[i]
            if i < len(rules):
                rules[i] = rank((tokens[i], tokens[i + 1]), none)
            if i:
                rules[i - 1] = rank((tokens[i - 1], tokens[i]), none)
        return tokens

    def word(self, word: str) -> bytes:
        """Ids of one word, as little-endian 32-bit numbers."""
        if len(word) <= KEPT_LETTERS:
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            machine = Transducer(self)
            found = self.words[word] = _packed(machine.feed(word.encode()) + machine.finish())
            return found
        machine, out = Transducer(self), []
        for at in range(0, len(word), self.window):
            out.append(_packed(machine.feed(word[at:at + self.window].encode())))
        return b"".join([*out, _packed(machine.finish())])

    def split(self, part: str) -> list[str]:
        """Words of a text without special strings."""
        if self.plain_words and not _UNSETTLED.search(part):
            if part.isascii():
                return _WORDS.findall(part.lower())
            # capital sigma has one small form here, wherever it stands
            small = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            if not _UNSETTLED.search(small):
                return _WORDS.findall(small)
        if self.normalizer:
            part = self.normalizer.normalize_str(part)
        back = _byte_letters()
        return [bytes([back[c] for c in piece]).decode() for piece, _ in self.pre_tokenizer.pre_tokenize_str(part)]

    def parts(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > PART:
            cut = _CUT.search(text, start + PART)
            if not cut:
                break
            yield text[start:cut.start()]
            start = cut.start()
        yield text[start:]

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a text, part by part, as little-endian 32-bit numbers."""
        known, word, at = self.words.get, self.word, 0
        for mark in [*(self.mark.finditer(text) if self.mark else ()), None]:
            for part in self.parts(text[at:mark.start() if mark else len(text)]):
                yield b"".join([known(w) or word(w) for w in self.split(part)])
            if mark:
                yield _packed([self.marks[mark.group()]])
                at = mark.end()


class Transducer:
    """Tokens of one word whose letters come in portions."""

    def __init__(self, vocabulary: Vocabulary):
        self.of, self.held = vocabulary, b""

    def feed(self, letters: bytes) -> list[int]:
        """Tokens that no letter to come can change."""
        out: list[int] = []
        for at in range(0, len(letters), self.of.window):
            self.held += letters[at:at + self.of.window]
            if len(self.held) < self.of.window:
                continue
            stable, end = len(self.held) - 1 - self.of.lookahead, 0
            for token, size in self.of.merged(self.held, False):
                if end + size > stable:
                    break
                out.append(token)
                end += size
            self.held = self.held[end:]
        return out

    def finish(self) -> list[int]:
        """The rest, after the word's last letter."""
        held, self.held = self.held, b""
        if len(held) <= KEPT_LETTERS:
            return self.of.merged_short(held) if held else []
        return [token for token, _ in self.of.merged(held, True)]


class Decoder:
    """Text of ids that come in portions."""

    def __init__(self, vocabulary: Vocabulary):
        self.of, self.begun = vocabulary, False
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        shown = self.of.shown
        names = [shown[i] for i in ids.tolist() if i in shown]  # the library passes over ids it does not have
        if not names:
            return ""
        lead = self.of.between if self.begun else b""
        self.begun = True
        return self.machine.decode(lead + self.of.between.join(names))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def decode(of: Vocabulary, ids: np.ndarray) -> Iterator[str]:
    machine = Decoder(of)
    for at in range(0, len(ids), IDS_AT_A_TIME):
        yield machine.feed(ids[at:at + IDS_AT_A_TIME])
    yield machine.finish()


def encode_and_decode(docs: DataFrame, path: str | None = None, keep: bool = True, text_col: str = "text", into: str = "bpe") -> DataFrame:
    """Rows of ``docs`` with a struct: n_tokens, SHA-256 of the ids (little-endian, 32 bits each) and of the decoded text in UTF-8.

    With ``keep`` it has the ids and the decoded text as well; without, they are null and a text's ids go from the
    transducer to the decoder part by part.
    """
    path = path or default_path()

    def make():
        of = vocabulary(path)

        def work(batch):
            out: dict[str, list] = {f.name: [] for f in RESULT}
            for data in as_bytes(batch.column(text_col)).to_pylist():
                digest, told, machine, n, ids, decoded = hashlib.sha256(), hashlib.sha256(), Decoder(of), 0, [], []

                def take(text, told=told, decoded=decoded):
                    told.update(text.encode())
                    if keep:
                        decoded.append(text)

                for part in of.encode((data or b"").decode("utf-8", "replace")):
                    digest.update(part)
                    n += len(part) // 4
                    take(machine.feed(np.frombuffer(part, "<u4")))
                    if keep:
                        ids.append(part)
                take(machine.finish())
                row = (n, digest.hexdigest(), told.hexdigest(), np.frombuffer(b"".join(ids), "<i4") if keep else None, "".join(decoded) if keep else None)
                for f, value in zip(RESULT, row, strict=True):
                    out[f.name].append(value)
            return out
        return work

    return append_struct(docs, into, RESULT, make, text_col)

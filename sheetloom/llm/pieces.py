"""SentencePiece encoding with the N best segmentations, and decoding.

A text becomes a lattice: an edge for every vocabulary piece that occurs in it, with the piece's score. A
forward Viterbi pass gives the best score from the start to each position; it is an exact heuristic for
an A-star search that walks backwards from the end, so the search opens positions of the N best paths only
and returns them in order.

No piece of the usual models reaches over the start of a word, so every path passes there, and so it does
around a character that no piece has and before marks that no piece has behind a letter. The lattice then falls into segments: the forward pass runs once
per distinct segment, keeping its best and second best score. A text's N best paths deviate from the best
one in at most the N - 1 segments whose second best is nearest, so the search is run in these alone and
its results are merged. A model with a piece across word starts is searched over the whole text.

Scale: rows are independent; no shuffle. Distinct segments are remembered per task in a table of bounded
size. Whole texts are encoded.

Defined results: null and empty texts have no pieces, score 0 and one (empty) segmentation; a character
without a piece becomes its UTF-8 byte pieces (or the unknown piece) with the lowest score minus 10; equal
scores are ordered alike in every run: in a segment the longer last piece first, between segments the
earlier one. Decoding gives the normalised text back: for models that keep white space, the text itself.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import string
from array import array
from functools import lru_cache
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes

MODEL = "piece_bpe_32k.model"
N_BEST = 4
KEPT_SEGMENTS = 200_000  # that a task remembers
KEPT_SEARCHES = 5_000
SPACE = "▁"
PENALTY = 10.0  # of an unknown character below the lowest score

EDIT = T.StructType([T.StructField("at", T.IntegerType()), T.StructField("drop", T.IntegerType()), T.StructField("ids", T.ArrayType(T.IntegerType()))])
RESULT = T.StructType([
    T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_pieces", T.LongType()), T.StructField("score", T.DoubleType()),
    T.StructField("alternatives", T.ArrayType(T.StructType([T.StructField("score", T.DoubleType()), T.StructField("edits", T.ArrayType(EDIT))]))),
    T.StructField("ids_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())])


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(MODEL)


class Lattice:
    """Pieces and scores of one model; ``path`` is a model file that every executor has installed."""

    def __init__(self, path: str | None = None, pieces: list[tuple[str, float]] | None = None):
        import ahocorasick

        self.byte_ids: dict[int, int] = {}
        self.unknown_id, self.table, usable = 0, [], []
        if pieces is None:
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.unknown_id = model.unk_id()
            for i in range(model.get_piece_size()):
                name = model.id_to_piece(i)
                if model.is_byte(i):
                    self.byte_ids[int(name[3:5], 16)] = i
                    self.table.append(bytes([int(name[3:5], 16)]))
                elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                    self.table.append(b"")
                else:
                    usable.append((name, i, model.get_score(i)))
                    self.table.append(name.replace(SPACE, " ").encode())
        else:
            usable = [(name, i, score) for i, (name, score) in enumerate(pieces)]
            self.table = [name.replace(SPACE, " ").encode() for name, _ in pieces]
        self.ending = ahocorasick.Automaton()
        for name, i, score in usable:
            self.ending.add_word(name, (i, len(name), score))
        self.ending.make_automaton()
        self.unknown_score = min(score for _, _, score in usable) - PENALTY
        self.single = {name for name, _, _ in usable if len(name) == 1}
        known = {c for name, _, _ in usable for c in name} - {SPACE}
        # marks that no piece has behind a plain letter or digit: every path passes between the two
        before = {(a, b) for name, _, _ in usable for a, b in zip(name, name[1:], strict=False) if b in string.punctuation and a != SPACE}
        marks = set(string.punctuation) & known - {b for a, b in before if a.isalpha() or a.isdecimal()}
        tied = {a for a, b in before if b in marks} - marks  # what may stand before such a mark within a piece
        inner, mark, tie = ("".join(map(re.escape, sorted(x))) or "\0" for x in (known - marks, marks, tied))
        across = any(SPACE in name.lstrip(SPACE) for name, _, _ in usable)
        self.segments = re.compile(".+" if across else f"{SPACE}*[{mark}]*[{inner}]+(?:(?<=[{tie}])[{mark}]+[{inner}]*)*|{SPACE}*[{mark}]+|{SPACE}+|.",
                                   re.DOTALL)
        self.known: dict[str, tuple[float, float, bytes]] = {}
        self.searched: dict[tuple[str, int], list[tuple[float, list[int]]]] = {}

    def unknown(self, char: str) -> list[int]:
        found = [self.byte_ids.get(b) for b in char.encode("utf-8", "replace")]
        return [self.unknown_id] if None in found else found

    def plain(self, segment: str) -> bool:
        """Whether each character has a piece of its own."""
        return self.single.issuperset(segment)

    def edges(self, segment: str) -> list[tuple[int, int, int, float]]:
        """(end, start, piece or -1, score) by rising end; a character without a piece of its own gets an unknown edge."""
        if self.plain(segment):
            return [(end + 1, end + 1 - length, piece, score) for end, (piece, length, score) in self.ending.iter(segment)]
        found, at = [], 0
        for end, (piece, length, score) in self.ending.iter(segment):
            while at <= end:
                if segment[at] not in self.single:
                    found.append((at + 1, at, -1, self.unknown_score))
                at += 1
            found.append((end + 1, end + 1 - length, piece, score))
        found += [(k + 1, k, -1, self.unknown_score) for k in range(at, len(segment)) if segment[k] not in self.single]
        return found

    def as_found(self, segment: str):
        """Edges in the form that the automaton finds them in."""
        return ((end - 1, (piece, end - start, score)) for end, start, piece, score in self.edges(segment))

    def forward(self, segment: str) -> tuple[float, float, bytes]:
        """Best score, distance of the second best (infinite if none), ids of the best path as 32-bit numbers."""
        known = self.known.get(segment)
        if known is not None:
            return known
        if len(self.known) >= KEPT_SEGMENTS:
            self.known.clear()
        n, low = len(segment), float("-inf")
        best, second, via = [0.0] + [low] * n, [low] * (n + 1), [(0, 0)] * (n + 1)
        for end, (piece, length, score) in self.ending.iter(segment) if self.plain(segment) else self.as_found(segment):
            end += 1
            start = end - length
            reach, top = best[start] + score, best[end]
            if reach > top:
                other = second[start] + score
                second[end] = top if top > other else other
                best[end], via[end] = reach, (start, piece)
            elif reach > second[end]:
                second[end] = reach
        ids, at = [], n
        while at:
            start, piece = via[at]
            if piece >= 0:
                ids.append(piece)
            else:
                ids += self.unknown(segment[start])[::-1]
            at = start
        ids.reverse()
        found = best[n], best[n] - second[n], array("i", ids).tobytes()
        if n <= 256:
            self.known[segment] = found
        return found

    def forget(self) -> None:
        """Drop the segments remembered; the lattice itself stays for the worker's next task."""
        self.known.clear()
        self.searched.clear()

    def search(self, segment: str, n_best: int) -> list[tuple[float, list[int]]]:
        """The N best paths of a segment, searched once while it is remembered."""
        known = self.searched.get((segment, n_best))
        if known is None:
            if len(self.searched) >= KEPT_SEARCHES:
                self.searched.clear()
            known = self.a_star(segment, n_best)
            if len(segment) <= 256:
                self.searched[segment, n_best] = known
        return known

    def a_star(self, segment: str, n_best: int) -> list[tuple[float, list[int]]]:
        """The N best paths of a segment: backwards A-star with the forward scores as heuristic."""
        n, low = len(segment), float("-inf")
        best, ending = [low] * (n + 1), [[] for _ in range(n + 1)]
        best[0] = 0.0
        for edge in self.edges(segment):
            best[edge[0]] = max(best[edge[0]], best[edge[1]] + edge[3])
            ending[edge[0]].append(edge)
        order = count()
        heap, found = [(-best[n], next(order), n, 0.0, None)], []
        while heap and len(found) < n_best:
            _, _, at, behind, path = heapq.heappop(heap)
            if not at:
                ids = []
                while path:
                    (_, start, piece, _), path = path
                    ids += [piece] if piece >= 0 else self.unknown(segment[start])
                found.append((behind, ids))
                continue
            for edge in ending[at]:
                rest = behind + edge[3]
                heapq.heappush(heap, (-(best[edge[1]] + rest), next(order), edge[1], rest, (edge, path)))
        return found

    def encode(self, text: str, n_best: int = N_BEST) -> tuple[np.ndarray, float, list[tuple[float, list[dict]]]]:
        """Ids and score of the best path, and the other N - 1 as scores with edits of the best."""
        if not text:
            return np.zeros(0, "<i4"), 0.0, []
        segments = self.segments.findall(SPACE + text.replace(" ", SPACE))
        known, forward = self.known.get, self.forward
        bests, gaps, parts = zip(*[known(s) or forward(s) for s in segments], strict=True)
        score, ids = sum(bests), np.frombuffer(b"".join(parts), "<i4")
        if n_best < 2:
            return ids, score, []
        gap = np.array(gaps)
        least = np.partition(gap, n_best - 2)[n_best - 2] if len(gap) >= n_best else np.inf
        near = np.flatnonzero((gap <= least) & (gap < np.inf))
        near = sorted(near[np.argsort(gap[near], kind="stable")][:n_best - 1].tolist())
        starts = {i: (sum(map(len, parts[:i])) >> 2, len(parts[i]) >> 2) for i in near}
        # combinations of the near segments' paths, the best first; a number says which of its paths a segment takes
        paths = [self.search(segments[i], n_best) for i in near]
        loss = [[p[0][0] - q[0] for q in p] for p in paths]
        heap, seen, out = [(0.0, (0,) * len(near))], set(), []
        while heap and len(out) < n_best:
            lost, which = heapq.heappop(heap)
            out.append((score - lost, [{"at": starts[i][0], "drop": starts[i][1], "ids": paths[k][w][1]}
                                       for k, (i, w) in enumerate(zip(near, which, strict=True)) if w]))
            for k, w in enumerate(which):
                after = (*which[:k], w + 1, *which[k + 1:])
                if w + 1 < len(paths[k]) and after not in seen:
                    seen.add(after)
                    heapq.heappush(heap, (sum(loss[m][x] for m, x in enumerate(after)), after))
        return ids, score, out[1:]

    def decode(self, ids) -> str:
        table = self.table
        text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def edited(ids: list[int], edits: list[dict]) -> list[int]:
    """The ids of an alternative: the best path's ids with its edits."""
    out, at = [], 0
    for e in edits:
        out += [*ids[at:e["at"]], *e["ids"]]
        at = e["at"] + e["drop"]
    return out + list(ids[at:])


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


def encode(docs: DataFrame, n_best: int = N_BEST, path: str | None = None, text_col: str = "text", into: str = "pieces") -> DataFrame:
    """Rows of ``docs`` with a struct: ids, n_pieces and score of the best segmentation, alternatives (score, edits).

    ``ids_sha256`` is the digest of the ids as little-endian 32-bit numbers; ``round_trip`` tells whether
    decoding them gives the text back.
    """
    path = path or default_path()

    def make():
        model = lattice(path)

        def work(batch):
            out: dict[str, list] = {f.name: [] for f in RESULT}
            for data in as_bytes(batch.column(text_col)).to_pylist():
                text = (data or b"").decode("utf-8", "replace")
                ids, score, others = model.encode(text, n_best)
                out["ids"].append(ids)
                out["ids_sha256"].append(hashlib.sha256(ids.tobytes()).hexdigest())
                out["round_trip"].append(model.decode(ids.tolist()) == text)
                out["n_pieces"].append(len(ids))
                out["score"].append(score)
                out["alternatives"].append([{"score": s, "edits": e} for s, e in others])
            return out

        work.forget = model.forget
        return work

    return append_struct(docs, into, RESULT, make, text_col)


def decode(rows: DataFrame, ids_col: str, path: str | None = None, into: str = "decoded") -> DataFrame:
    """Rows with a struct: the text of an array of piece ids (null for null)."""
    path = path or default_path()

    def make():
        model = lattice(path)

        def work(batch):
            out = []
            for ids in batch.column(ids_col):
                out.append(model.decode(ids.values.to_numpy(zero_copy_only=False).tolist()) if ids.is_valid else None)
            return {"text": out}
        return work

    return append_struct(rows, into, T.StructType([T.StructField("text", T.StringType())]), make, None)

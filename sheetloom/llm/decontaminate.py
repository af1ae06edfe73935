"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Questions and answers of a benchmark become windows of ``size`` consecutive words (an item with fewer
words is one window). Words are ASCII letters lower-cased, digits and everything beyond ASCII; the rest
separates them. The automaton runs over a document's words once; a word inside any occurrence of a
window is *hit*, and runs of hit words are mapped back to code-point offsets of the original text.

Scale: documents are never shuffled. (window, item) pairs are built by Spark and dealt into shards by a hash
of both, so that the items of a window that very many of them share are spread over the shards too; a shard
holds about ``shard`` pairs and ``SHARD_BYTES`` of text however the windows are distributed, and one shard is
what is collected and broadcast at a time. A benchmark of one shard (the usual case) costs one pass; with more
shards the passes follow one another, their hits and items add up, and each result is written to the shared
folder, so that a worker holds one automaton at a time. A document's list of items is one value of its row.

Defined results: a null or empty text has no words and is not contaminated; an item without words or
without an id is never found; repeated items count once; very long texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes, free_name, rows_of
from sheetloom.session import written

WINDOW = 13
SHARD_PAIRS = 200_000
SHARD_BYTES = 32 << 20

_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])))])


def words(text: bytes | None) -> list[bytes]:
    """Normalised words of a UTF-8 text."""
    return text.translate(_FOLD).split() if text else []


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (window, item) pairs of a benchmark; ``window`` holds the words joined by spaces."""
    def make():
        def work(batch):
            out, ids = [], []
            for item, text in zip(batch.column("item").to_pylist(), as_bytes(batch.column("text")).to_pylist(), strict=True):
                found = words(text)
                for i in range(max(1, len(found) - size + 1) if found else 0):
                    out.append(b" ".join(found[i:i + size]))
                    ids.append(item)
            yield {"window": out, "item": ids}
        return work

    source = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return rows_of(source.where(F.col("item").isNotNull()), "window binary, item string", make).distinct()


def build(pairs: list[tuple[bytes, str]]):
    """Vocabulary, automaton over word numbers, and the names of the items."""
    import ahocorasick

    vocabulary: dict[bytes, int] = {}
    names: dict[str, int] = {}
    by_window: dict[tuple[int, ...], list[int]] = {}
    for window, item in pairs:
        key = tuple(vocabulary.setdefault(w, len(vocabulary) + 1) for w in window.split())
        by_window.setdefault(key, []).append(names.setdefault(item, len(names)))
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, found in by_window.items():
        automaton.add_word(key, (len(key), found))
    if by_window:
        automaton.make_automaton()
    return vocabulary, automaton if by_window else None, list(names)


def _runs(marks: bytearray) -> list[tuple[int, int]]:
    """First and last index of each run of ones."""
    return [(m.start(), m.end() - 1) for m in re.finditer(rb"\x01+", marks)]


def original_spans(text: bytes, runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    """Code-point offsets, end exclusive, of runs of words in the original text."""
    if not runs:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    spans, done, points = [], 0, 0
    for first, last in runs:
        span = []
        for offset in (at[first][0], at[last][1]):
            points += len(text[done:offset].decode("utf-8", "replace"))
            done = offset
            span.append(points)
        spans.append({"start": span[0], "end": span[1]})
    return spans


def _scan(docs: DataFrame, pairs: list[tuple[bytes, str]], text_col: str, into: str, earlier: str | None, last: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(pairs)

    def make():
        vocabulary, automaton, names = build(shared.value)

        def work(batch):
            out: dict[str, list] = {f.name: [] for f in RESULT}
            before = batch.column(earlier).to_pylist() if earlier else [None] * batch.num_rows
            for text, old in zip(as_bytes(batch.column(text_col)).to_pylist(), before, strict=True):
                found = words(text)
                marks, items = bytearray(len(found)), set(old["items"] if old else ())
                for run in old["hits"] if old else ():
                    marks[run["first"]:run["last"] + 1] = b"\1" * (run["last"] - run["first"] + 1)
                if automaton and found:
                    for end, (length, which) in automaton.iter(tuple([vocabulary.get(w, 0) for w in found])):
                        marks[end - length + 1:end + 1] = b"\1" * length
                        items.update([names[i] for i in which])
                runs = _runs(marks) if items else []
                out["n_words"].append(len(found))
                out["n_hit"].append(sum(marks))
                out["items"].append(sorted(items))
                out["spans"].append(original_spans(text, runs) if last and runs else [])
                out["hits"].append([{"first": a, "last": b} for a, b in runs])
            return out
        return work

    return append_struct(docs, into, RESULT, make, text_col)


def shard_count(found: DataFrame, shard: int) -> int:
    size = found.agg(F.count(F.lit(1)).alias("pairs"), F.sum(F.octet_length("window") + F.octet_length("item")).alias("bytes")).first()
    return max(1, -(-size["pairs"] // shard), -(-(size["bytes"] or 0) // SHARD_BYTES))


def shard_of(shards: int):
    return F.pmod(F.xxhash64("window", "item"), F.lit(shards))


def find_contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text_col: str = "text", into: str = "contamination",
                       item_id: str = "item_id", item_text: str = "text", shard: int = SHARD_PAIRS) -> DataFrame:
    """Rows of ``docs`` with a struct: n_words, n_hit, items (ids as strings, sorted), spans, hits (word runs)."""
    found = written(windows(benchmark, size, item_id, item_text), "benchmark-windows")
    shards = shard_count(found, shard)
    result, earlier = docs, None
    for k in range(shards):
        pairs = [(bytes(r["window"]), r["item"]) for r in found.where(shard_of(shards) == k).collect()]
        last = k == shards - 1
        target = into if last else free_name(result, f"{into}_{k}")
        result = _scan(result, pairs, text_col, target, earlier, last)
        if earlier:
            result = result.drop(earlier)
        if not last:
            result, earlier = written(result, "decontaminate"), target
    return result


def is_contaminated(n_hit, n_words):
    """The rule: at least a twentieth of the words, and one at least, lie inside test items."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


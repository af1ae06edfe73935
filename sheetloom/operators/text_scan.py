"""Facts and prices of whole texts, read by Python workers batch by batch.

The rules are those of :mod:`sheetloom.operators.facts`, whose column expressions run a rule each; here one pass over a
document runs all of them, and what a document says never leaves its batch before it is put together.  Texts of ASCII
letters are searched in lower case, from the places where a rule's words begin; all others by the rules as they are.
"""

from __future__ import annotations

import math
import os
import re
from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Context, Decimal
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sheetloom import fixed_values as fv

CHUNK_BYTES = 2 << 20  # of texts whose facts are held at a time, one text at least
BATCH_BYTES = 4 << 20  # of an Arrow batch between Spark and a Python worker, one row at least
PRICES = ["single_piece_price", "wholesale_price", "full_catalogue_price", "supplier_price", "price_notes"]


def beginnings(pattern: str) -> list[str] | None:
    """How the words begin that a pattern starts with, in lower case; nothing where a letter is all that is sure."""
    begin = re.match(r"\(\?i\)(?:\\b)?\(\?:", pattern)
    if not begin:
        return None
    words, depth, at, open_ = [""], 0, begin.end(), True
    while depth >= 0:
        x = pattern[at]
        literal = pattern[at + 1] if x == "\\" and pattern[at + 1] in "./-" else x
        at += 2 if x == "\\" else 1
        if x == "[":
            return None
        depth += (x == "(") - (x == ")")
        if x == "|" and depth == 0:
            words.append("")
            open_ = True
        elif open_ and depth == 0 and x not in "()|" and (x != "\\" or literal != x) and literal not in "?*+^$" + ("." if x == "." else ""):
            if pattern[at] in "?*":
                open_ = False
            else:
                words[-1] += literal
        else:
            open_ = False
    if min(len(w) for w in words) < 2 and not all(w and not w.isascii() for w in words if len(w) < 2):
        return None
    return sorted({w for w in words if not any(w != v and w.startswith(v) for v in words)})


def needles(pattern: str) -> list[str]:
    """A piece of each of the words that a pattern begins with, in lower case."""
    begin = re.match(r"\(\?i\)(?:\\b)?\(\?:", pattern)
    words, depth, piece, at = [[]], 0, "", begin.end()
    while depth >= 0:
        x = pattern[at]
        letter = pattern[at + 1] if x == "\\" and pattern[at + 1] in "./-" else x
        at += 2 if x == "\\" else 1
        plain = depth == 0 and (letter.isalnum() or letter in "-/" or x != letter)
        if plain and not (x == "\\" and letter == x) and pattern[at] not in "?*":
            piece += letter
        else:
            words[-1].append(piece)
            piece = ""
        depth += (x == "(") - (x == ")")
        if x == "|" and depth == 0:
            words.append([])
    return sorted({max(pieces, key=len) for pieces in words})


def _held(pattern: str) -> str:
    """A currency run that cannot backtrack."""
    run = fv.CURRENCY_RUN
    return pattern.replace(run, run.replace("]|", "]++|")[:-1] + "*+")


def _finder(pattern: str) -> Callable[[str, str, bool], Iterator[re.Match]]:
    """All matches of a pattern, one behind the other; their places are those of the text."""
    held = _held(pattern)
    whole, low_only, begins = re.compile(held), re.compile(held.removeprefix("(?i)").replace("xX", "x")), beginnings(pattern)
    needed = needles(pattern) if begins is None and re.match(r"\(\?i\)\\b\(\?:", pattern) else [""]

    def find(text: str, low: str, plain: bool) -> Iterator[re.Match]:
        if not plain:
            yield from whole.finditer(text)
        elif begins is None:
            if any([x in low for x in needed]):
                yield from low_only.finditer(low)
        else:
            places = []
            for word in begins:
                at = low.find(word)
                while at >= 0:
                    places.append(at)
                    at = low.find(word, at + 1)
            if len(places) > 1:
                places.sort()
            end = 0
            for at in places:
                if at >= end:
                    found = low_only.match(low, at)
                    if found:
                        end = found.end()
                        yield found

    return find


def _amount(text: str) -> float | None:
    try:
        number = float(text.strip().replace(",", ""))
    except ValueError:
        return None
    return number if number > 0 else None


_WIDE = Context(prec=60, rounding=ROUND_HALF_UP)


def amount_text(number: float | None) -> str | None:
    """A number with two decimals; nothing beyond 36 digits."""
    if number is None or not math.isfinite(number):
        return None
    if -1e15 < number < 1e15 and number == int(number):
        return f"{int(number)}.00"
    text = str(Decimal(repr(number)).quantize(Decimal("0.01"), context=_WIDE)) if abs(number) < 1e50 else ""
    return text if text and len(text.lstrip("-")) <= 39 else None


def _integer(text: str, bits: int) -> int | None:
    """Number of digits alone, where a column of this many bits holds it."""
    if not text.isascii() or not text.isdigit():
        return None
    return n if len(text) < 40 and (n := int(text)) < 1 << (bits - 1) else None


def _whole(number: float | None) -> str | None:
    return str(int(number)) if number is not None and abs(number) < 2.0 ** 63 else None


_RULES = [(order, field, name, _finder(pattern), shortest, confidence) for order, field, name, pattern, shortest, confidence in fv.FACT_RULES]
_PRICE_RULES = [(r[0], r[1], r[2], _finder(r[3]), r[4], r[5]) for r in fv.PRICE_RULES]
_TOTAL = (fv.BREAKDOWN_ORDER, "full_catalogue_price", fv.BREAKDOWN_RULE, _finder(fv.BREAKDOWN), 3, fv.BREAKDOWN_CONFIDENCE)
_MARKED = _finder(fv.MARKED_AMOUNT)
_FABRICS = [(k, re.compile(rf"\b{k}\b"), k.title()) for k in fv.KNOWN_FABRICS]
_PIECES = re.compile(r"p(?:cs?|ieces?|es?)\s*[x*]")  # in every breakdown
# as fv.LABEL_LINE: a label holds no mark, so it runs to the first one and never has to be given back
_LABEL = re.compile(r"[A-Za-z0-9][A-Za-z0-9\s/_\.]++(?=[:=\-–—])")
_LABEL_LETTERS = 41
_NO_KEY = re.compile("[^a-z0-9_]+")
_SKIPPED = frozenset(fv.LABEL_KEYS_SKIPPED)
_UNIT = ("wholesale_price", "single_piece_price")


def _fact_order(rule: int, sub: int, pos: int, extra: int = 0) -> int:
    return ((rule * 100 + sub) << 33) + pos * 2 + extra


def _rule_value(field: str, part: str) -> str | None:
    if field == "gst_percent":
        number = float(part)
        return amount_text(number) if number <= 100 else None
    if field == "total_designs":
        number = _integer(part, 64)
        return str(number) if number else None
    return part.strip()


def _has_breakdown(low: str, plain: bool) -> bool:
    return "=" in low and (not plain or _PIECES.search(low) is not None)


def _price_facts(text: str, low: str, plain: bool) -> list[tuple]:
    """Prices in rule order: rule, place, field, value, text, confidence, rule's name; equal totals of breakdowns once."""
    def run(rule: tuple) -> list[tuple]:
        order, field, name, find, group, confidence = rule
        out = []
        for pos, m in enumerate(find(text, low, plain)):
            start, end = m.span(group)
            value = _amount(text[start:end])
            if value is not None:
                out.append((order, pos, field, value, text[m.start():m.end()].strip(), confidence, name))
        return out

    found = {rule[0]: run(rule) for rule in _PRICE_RULES}
    known, totals = {x[3] for x in found[1]}, []
    if _has_breakdown(low, plain):
        for x in run(_TOTAL):
            if x[3] not in known:
                known.add(x[3])
                totals.append(x)
    return [*found[1], *found[2], *found[3], *totals, *found[5], *found[6]]


@lru_cache(4096)
def _field(label: str) -> str:
    return _NO_KEY.sub("_", label.lower()).strip("_")


def _line_facts(text: str) -> Iterator[tuple]:
    """Label lines with the lines that go on: line, field, value, text."""
    lines = [x.strip() for x in text.splitlines()]
    labels = []
    for line in lines:
        m = _LABEL.match(line)
        key = m.group().rstrip() if m else ""
        labels.append(key if len(key) <= _LABEL_LETTERS else "")
    for at, key in enumerate(labels):
        if len(key) < 2:
            continue
        line, stop = lines[at], at + 1
        while stop < len(lines) and lines[stop] and not labels[stop]:
            stop += 1
        parts, raw = [line[len(key):].lstrip()[1:].strip()], line
        if stop > at + 1:
            parts += lines[at + 1:stop]
            raw = "\n".join([line, *parts[1:]])
        value = " ".join(" ".join(parts).split())
        field = _field(key)
        if value and field not in _SKIPPED:
            yield at, field, value, raw


def facts_of(text: str) -> tuple[dict[tuple, tuple], list[tuple], list[int | None]]:
    """Facts by field and value in lower case, prices in rule order, and the numbers of designs that are told."""
    low, plain = text.lower(), text.isascii()
    facts: dict[tuple, tuple] = {}
    designs = []

    def add(field: str, order: int, value: str | None, raw: str, confidence: float, rule: str) -> None:
        key = (field, value.lower() if value is not None else None)
        if key not in facts or facts[key][1] > order:
            facts[key] = (field, order, value, raw, confidence, rule)

    fabric = False
    for rule, field, name, find, shortest, confidence in _RULES:
        for pos, m in enumerate(find(text, low, plain)):
            start, end = m.span(1)
            value = _rule_value(field, text[start:end])
            if value is not None and len(value) >= shortest:
                add(field, _fact_order(rule, 0, pos), value, text[m.start():m.end()].strip(), confidence, name)
                fabric = fabric or field == "fabric"
                if field == "total_designs":
                    designs.append(_integer(value, 32))
    if not fabric:
        for word, found, title in _FABRICS:
            if word in low and found.search(low):
                add("fabric", _fact_order(fv.KNOWN_FABRIC_ORDER, 0, 0), title, word, 0.75, "KEYWORD_KNOWN_FABRIC")
                break
    prices = _price_facts(text, low, plain)
    for rule, pos, field, value, raw, confidence, name in prices:
        shown = amount_text(value)
        add(field, _fact_order(fv.PRICE_FACT_ORDER, rule, pos), shown, raw, confidence, name)
        if field in _UNIT:
            add("price", _fact_order(fv.PRICE_FACT_ORDER, rule, pos, 1), shown, raw, confidence, name)
    base = _fact_order(fv.LABEL_LINE_ORDER, 0, 0)
    for line, field, value, raw in _line_facts(text):
        key = (field, value.lower())
        if key not in facts:  # label lines come last of all
            facts[key] = (field, base + line * 2, value, raw, 0.85, "REGEX_KEY_VALUE_LINE")
    return facts, prices, designs


def _near(a: float | None, b: float | None) -> bool:
    return a is not None and b is not None and abs(a - b) < 1.0


def _times(a: int | None, b: float | None) -> float | None:
    return a * b if a is not None and b is not None else None


def reconciled(text: str, prices: list[tuple], designs: list[int | None]) -> dict[str, float | str | None] | None:
    """Prices after the misread-currency checks of :func:`facts.reconciled_prices`; nothing for a text without prices."""
    if not prices:
        return None
    low, plain = text.lower(), text.isascii()
    first: dict[str, float] = {}
    for x in prices:
        first.setdefault(x[2], x[3])
    raw_fc, raw_ws, raw_sp = (first.get(x) for x in ("full_catalogue_price", "wholesale_price", "single_piece_price"))
    b_count = b_total = None
    for m in _TOTAL[3](text, low, plain) if _has_breakdown(low, plain) else ():
        b_count, b_total = _integer(m.group(1), 32), _amount(m.group(3))
        break
    pieces = designs[0] if designs and designs[0] else b_count
    marked = {text[m.start(1):m.end(1)] for m in _MARKED(text, low, plain)}

    def without_two(number: float | None) -> float | None:
        digits = _whole(number)
        return float(digits[1:]) if digits and digits.startswith("2") and len(digits) >= 4 else None

    def said(number: float | None) -> bool:
        return number is not None and _whole(number) in marked

    cut_fc, cut_ws, cut_sp = without_two(raw_fc), without_two(raw_ws), without_two(raw_sp)
    fc = cut_fc if said(cut_fc) else raw_fc
    many, expected = pieces is not None and pieces > 1, _times(pieces, cut_ws)
    by_count = many and (_near(expected, fc) or _near(expected, raw_fc))
    by_total = not many and _near(_times(b_count, cut_ws), b_total)
    ws = cut_ws if by_count or by_total else raw_ws
    if by_count and fc is not None and fc == raw_fc and _near(expected, raw_fc - 20000):
        fc = raw_fc - 20000
    elif by_total:
        fc = b_total
    by_order = None not in (ws, cut_sp, fc) and ws <= cut_sp < fc and said(cut_sp)
    sp = cut_sp if by_order else raw_sp
    notes = []

    def shown(number: float | None) -> str:
        return re.sub("0$", "", amount_text(number) or "")

    if said(cut_fc):
        notes.append(f"Full catalogue price corrected from {shown(raw_fc)} to {shown(cut_fc)}: leading '2' confirmed as misread Rupee symbol by matching alternative text mention")
    if by_count:
        notes.append(f"Wholesale price corrected from {shown(raw_ws)} to {shown(cut_ws)}: confirmed by catalogue count ({pieces} pcs x {shown(cut_ws)} = {shown(expected)})")
    elif by_total:
        notes.append(f"Wholesale price corrected from {shown(raw_ws)} to {shown(cut_ws)} via breakdown arithmetic")
    if by_order:
        notes.append(f"Single piece price corrected from {shown(raw_sp)} to {shown(cut_sp)} via alternative mention")
    supplier = next((x for x in (sp, ws, first.get("price")) if x is not None), None)
    return dict(zip(PRICES, (sp, ws, fc, supplier, "; ".join(notes) or None), strict=True))


def _firsts(facts: dict[tuple, tuple]) -> dict[str, tuple]:
    """First fact of each field."""
    first: dict[str, tuple] = {}
    for x in facts.values():
        if x[0] not in first or first[x[0]][1] > x[1]:
            first[x[0]] = x
    return first


def values_of(text: str) -> dict[str, str | None]:
    """One value per field, prices after reconciliation; a product's name stands in for its catalogue's."""
    facts, prices, designs = facts_of(text)
    values = {x[0]: x[2] for x in _firsts(facts).values()}
    for name, value in (reconciled(text, prices, designs) or {}).items():
        if value is not None:
            values[name] = value if isinstance(value, str) else amount_text(value)
    if values.get("catalog_name") is None and values.get("product_name") is not None:
        values["catalog_name"] = values["product_name"]
    return values


# ------------------------------------------------------------------ batches
def _facts_rows(text: str) -> list[tuple]:
    return [(order, field, *rest) for field, order, *rest in facts_of(text)[0].values()]


def _first_rows(text: str) -> list[tuple]:
    return [(field, value, order) for field, order, value, *_ in _firsts(facts_of(text)[0]).values()]


def _value_rows(text: str) -> list[tuple]:
    return list(values_of(text).items())


def _cell_rows(text: str) -> list[tuple]:
    values = sorted(values_of(text).items())
    return [([k for k, _ in values], [v for _, v in values])] if values else []


def _named_rows(text: str) -> list[tuple]:
    values = values_of(text)
    return [(values.get("supplier_price"), values.get("catalog_name"))] if values else []


def _last_rows(text: str) -> list[tuple]:
    facts, last = facts_of(text)[0], {}
    for field, order, value, *_ in facts.values():
        if field not in last or last[field][0] < order:
            last[field] = (order, value)
    return [(len(facts), [(k, last[k][1]) for k in sorted(last)])]


#: what is made of a text: columns of the rows, and the function that makes them
KINDS = {
    "facts": ("fact_ord bigint, field string, value string, raw_text string, confidence double, rule string", _facts_rows),
    "first": ("field string, value string, fact_ord bigint", _first_rows),
    "values": ("field string, value string", _value_rows),
    "cells": ("fields array<string>, cells array<string>", _cell_rows),
    "named": ("supplier_price string, catalog_name string", _named_rows),
    "last": ("fact_count bigint, last array<struct<key: string, value: string>>", _last_rows),
}


def _on_workers(df: DataFrame) -> None:
    """Let Python workers import this library, in batches bounded by bytes: texts differ too much in size for a number of rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    environment, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def rows_of(documents: DataFrame, kind: str, *kept: str) -> DataFrame:
    """Rows made of every text, with the ``kept`` columns of its document; a document without a text has none."""
    _on_workers(documents)
    read = documents.select(*kept, "text")
    made = T.StructType.fromDDL(KINDS[kind][0])
    out = T.StructType([*[read.schema[k] for k in kept], *made.fields])
    kinds = list(to_arrow_schema(made).types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = KINDS[kind][1]
        for batch in batches:
            own, texts = batch.select(list(kept)), batch.column("text")
            places: list[int] = []
            columns: list[list] = [[] for _ in kinds]
            size = 0

            def packed() -> pa.RecordBatch:
                taken = own.take(pa.array(places, pa.int64()))
                arrays = [pa.array(x, k) for x, k in zip(columns, kinds, strict=True)]
                return pa.RecordBatch.from_arrays([*taken.columns, *arrays], names=out.names)

            for i in range(len(texts)):
                text = texts[i].as_py()
                if text is None:
                    continue
                rows = make(text)
                size += len(text)
                if rows:
                    places.extend([i] * len(rows))
                    for column, cells in zip(columns, zip(*rows, strict=True), strict=True):
                        column.extend(cells)
                if size >= CHUNK_BYTES:
                    yield packed()
                    places, columns, size = [], [[] for _ in kinds], 0
            if places:
                yield packed()
        pa.default_memory_pool().release_unused()

    return read.mapInArrow(run, out)


def has_repeats(documents: DataFrame, key: list[str]) -> bool:
    """Whether several rows are one document; only the ids are read."""
    return not documents.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()

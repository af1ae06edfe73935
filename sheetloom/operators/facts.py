"""Facts and prices from catalogue texts.

``documents(run_id, doc_id, filename, status, provider, text, confidence)``.
Each rule runs over the whole text of each document in one scan, and so do label
lines and the checks of prices; only the facts leave the scan, never the text or
its lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators import text_scan

DOC = ["run_id", "doc_id"]
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1c\x1d\x1e\u0085  ]"


# Letters that equal a letter besides its two cases, where case does not count.
_ALSO = {"i": "\u0130\u0131", "k": "\u212a", "s": "\u017f"}


def _sought(pattern: str) -> str:
    """Pattern that looks first whether one of its words can start here.

    Of most places in a text this one letter is all that is read; the bounds of
    words and the words themselves are dearer by far.
    """
    begin = re.match(r"\(\?i\)(?=(?:\\b)?\(\?:)", pattern)
    if not begin:
        return pattern
    at = pattern.index("(?:") + 3
    firsts, depth, fresh = [], 0, True
    while depth >= 0:
        x = pattern[at]
        if x == "[" or fresh and x in "\\(.^$":
            return pattern
        if fresh:
            firsts.append(x)
        depth += (x == "(") - (x == ")")
        fresh = x == "|" and depth == 0
        at += 2 if x == "\\" else 1
    letters = "".join(dict.fromkeys(x for f in firsts for x in f.lower() + f.upper() + _ALSO.get(f, "")))
    return f"(?i)(?=(?-iU:[{letters}]))" + pattern[begin.end():]


def _java(pattern: str) -> str:
    """Unicode classes, a look at the first letter, and a currency run that cannot backtrack."""
    run = fv.CURRENCY_RUN
    held = run.replace("]|", "]++|")[:-1] + "*+"
    return c.unicode_re(_sought(pattern).replace(run, held))


def _matches(pattern: str) -> Column:
    """All matches of a pattern in the text."""
    return F.regexp_extract_all(F.col("text"), F.lit(_java(pattern)), F.lit(0))


def _group(match: Column, pattern: str, group: int = 1) -> Column:
    """Group of a match, read again from the match alone."""
    return F.regexp_extract(match, _java(pattern), group)


def _found(pattern: str, group: int = 1) -> Column:
    """All matches of a pattern in the text with one of their groups."""
    return F.transform(_matches(pattern), lambda m: F.struct(m.alias("all"), _group(m, pattern, group).alias("part")))


def _order(rule: int, sub: int, pos: Column, extra: int = 0) -> Column:
    """Place of a fact in its document: rule, then position."""
    return F.lit((rule * 100 + sub) << 33).cast("bigint") + pos.cast("bigint") * 2 + F.lit(extra)


def _fact(order: Column, field: str | Column, value: Column, raw: Column, confidence: float, rule: str) -> Column:
    return F.struct(
        order.alias("fact_ord"), (F.lit(field) if isinstance(field, str) else field).alias("field"),
        value.alias("value"), raw.alias("raw_text"), F.lit(confidence).alias("confidence"),
        F.lit(rule).alias("rule"))


def _value(field: str, raw: Column) -> Column:
    if field == "gst_percent":
        number = raw.try_cast("double")
        return F.when(number <= 100, c.amount_text(number))
    if field == "total_designs":
        number = raw.try_cast("bigint")
        return F.when(number > 0, number.cast("string"))
    return c.pystrip(raw)


def _rule_facts(rule: int, field: str, name: str, pattern: str, shortest: int, confidence: float) -> Column:
    facts = F.transform(_found(pattern), lambda m, i: _fact(
        _order(rule, 0, i), field, _value(field, m["part"]), c.pystrip(m["all"]), confidence, name))
    return F.filter(facts, lambda f: F.length(f["value"]) >= shortest)


# ----------------------------------------------------------------- prices
def _price_rule(rule: int, field: str, name: str, pattern: str, group: int, confidence: float) -> Column:
    found = F.transform(_found(pattern, group), lambda m, i: F.struct(
        F.lit(rule).alias("rule_no"), i.alias("pos"), F.lit(field).alias("field"),
        c.clean_amount(m["part"]).alias("value"),
        m["part"].alias("original_raw_number"), c.pystrip(m["all"]).alias("raw_text"),
        F.lit(confidence).alias("confidence"), F.lit(name).alias("rule")))
    return F.filter(found, lambda f: f["value"].isNotNull())


def _price_columns() -> list[Column]:
    """One array per price rule; put together by :func:`_price_array`."""
    totals = _price_rule(fv.BREAKDOWN_ORDER, "full_catalogue_price", fv.BREAKDOWN_RULE, fv.BREAKDOWN, 3,
                         fv.BREAKDOWN_CONFIDENCE)
    return [*[_price_rule(*r).alias(f"price_{r[0]}") for r in fv.PRICE_RULES],
            totals.alias(f"price_{fv.BREAKDOWN_ORDER}")]


def _price_array() -> Column:
    """Price facts of a text in rule order; equal breakdown totals are not repeated."""
    stated = F.transform("price_1", lambda f: f["value"])
    amounts = F.transform(f"price_{fv.BREAKDOWN_ORDER}", lambda f: f["value"])
    totals = F.filter(f"price_{fv.BREAKDOWN_ORDER}", lambda f, i: ~F.array_contains(stated, f["value"]) & (
        F.array_position(amounts, f["value"]) == i + F.lit(1)))
    return F.concat("price_1", "price_2", "price_3", totals, "price_5", "price_6")


def price_facts(documents: DataFrame) -> DataFrame:
    return (documents.select(*DOC, *_price_columns())
            .select(*DOC, F.inline(_price_array())))


def _as_facts(prices: Column) -> Column:
    """Price facts as text facts; unit prices also count as plain prices."""
    def fact(p: Column, field: Column, extra: int) -> Column:
        order = (F.lit(fv.PRICE_FACT_ORDER * 100) + p["rule_no"]).cast("bigint") * F.lit(1 << 33)
        return F.struct(
            (order + p["pos"].cast("bigint") * 2 + F.lit(extra)).alias("fact_ord"), field.alias("field"),
            c.amount_text(p["value"]).alias("value"), p["raw_text"].alias("raw_text"),
            p["confidence"].alias("confidence"), p["rule"].alias("rule"))

    unit = F.filter(prices, lambda p: p["field"].isin("wholesale_price", "single_piece_price"))
    return F.concat(F.transform(prices, lambda p: fact(p, p["field"], 0)),
                    F.transform(unit, lambda p: fact(p, F.lit("price"), 1)))


# ----------------------------------------------------------------- labels
_FABRIC_RULE = next(r for r in fv.FACT_RULES if r[1] == "fabric")


def labelled_facts(documents: DataFrame) -> DataFrame:
    """Facts of the label rules."""
    return documents.select(*DOC, F.inline(F.concat(*[_rule_facts(*r) for r in fv.FACT_RULES])))


def _known_fabric(low: Column) -> Column:
    """First known fabric word of a text in lower case."""
    return F.coalesce(*[
        F.when(low.contains(k) & low.rlike(c.unicode_re(rf"\b{k}\b")), F.lit(k)) for k in fv.KNOWN_FABRICS])


def _fabric_fact() -> Column:
    return F.when(F.col("known").isNotNull() & (F.size("fabrics") == 0), _fact(
        _order(fv.KNOWN_FABRIC_ORDER, 0, F.lit(0)), "fabric", c.title_case("known"), F.col("known"), 0.75,
        "KEYWORD_KNOWN_FABRIC"))


def known_fabrics(documents: DataFrame) -> DataFrame:
    """First known fabric word of a text without a labelled fabric."""
    return (documents.select(*DOC, "text", F.lower("text").alias("low"))
            .select(*DOC, _known_fabric(F.col("low")).alias("known"), _rule_facts(*_FABRIC_RULE).alias("fabrics"))
            .select(*DOC, F.inline(F.array_compact(F.array(_fabric_fact())))))


# A block of label and value starts at a label line and runs to the next label or blank line. Lines, the places
# where something starts and the blocks are arrays of the document's row, so that no line leaves it.
def _lines() -> Column:
    stripped = F.transform(F.split("text", LINE_BREAK), lambda x: c.pystrip(x))
    return F.transform(stripped, lambda x: F.struct(x.alias("line"), c.pystrip(F.regexp_extract(x, c.unicode_re(fv.LABEL_LINE), 1)).alias("label")))


def _starts() -> Column:
    return F.filter(F.transform("lines", lambda x, i: F.when((x["line"] == "") | (x["label"] != ""), i)), lambda i: i.isNotNull())


def _blocks() -> Column:
    def block(at: Column, k: Column) -> Column:
        stop = F.coalesce(F.get("starts", k + 1), F.size("lines"))
        more = stop > at + 1
        head, key = F.get("lines", at), F.get("lines", at)["label"]
        # a line is stripped, so its label is its start; what follows is white space, the mark and the value
        behind = F.ltrim(head["line"].substr(F.length(key) + 1, F.length(head["line"])), F.lit(c.WHITE_SPACE))
        first = c.pystrip(behind.substr(F.lit(2), F.length(behind)))
        rest = F.transform(F.sequence(at + 1, stop - 1), lambda i: F.get("lines", i)["line"])
        # the parts are stripped; a single space between words stays as it is
        whole = F.when(more, F.array_join(F.filter(F.concat(F.array(first), rest), lambda v: v != ""), " ")).otherwise(first)
        value = F.regexp_replace(whole, c.unicode_re(r"\s(?:(?<! )\s*|\s+)"), " ")
        raw = F.when(more, F.array_join(F.concat(F.array(head["line"]), rest), "\n")).otherwise(head["line"])
        # labels are of ASCII letters, digits, `/ _ .` and white space
        field = F.trim(F.regexp_replace(F.lower(key), "[^a-z0-9_]+", "_"), F.lit("_"))
        return F.when(key != "", F.struct(at.alias("line_no"), key.alias("label"), field.alias("field"), value.alias("value"), raw.alias("raw_text")))

    return F.filter(F.transform("starts", block), lambda x: x.isNotNull() & (F.length(x["label"]) >= 2) & (F.length(x["value"]) >= 1)
                    & ~x["field"].isin(fv.LABEL_KEYS_SKIPPED))


def _rows(documents: DataFrame, array: Column | str) -> DataFrame:
    """Entries of an array as rows.

    Taken with an outer generator and sifted behind it: from an inner one a filter on the array would follow, pushed
    through to the scan, and work the array out a second time.
    """
    return documents.select(*DOC, F.inline_outer(array)).where("field is not null")


def label_blocks(documents: DataFrame) -> DataFrame:
    """``label: value`` lines with their continuation lines, row by row."""
    return (documents.select(*DOC, _lines().alias("lines")).select(*DOC, "lines", _starts().alias("starts"))
            .transform(_rows, _blocks()))


def with_facts(documents: DataFrame) -> DataFrame:
    """Documents with an array of their facts in rule order, out of one scan of the texts."""
    others = [_rule_facts(*r) for r in fv.FACT_RULES if r is not _FABRIC_RULE]

    def line_fact(x: Column) -> Column:
        return _fact(_order(fv.LABEL_LINE_ORDER, 0, x["line_no"]), x["field"], x["value"], x["raw_text"], 0.85, "REGEX_KEY_VALUE_LINE")

    return (documents.select(*DOC, "text", F.lower("text").alias("low"))
            .select(*DOC, F.concat(*others).alias("others"), _known_fabric(F.col("low")).alias("known"),
                             _rule_facts(*_FABRIC_RULE).alias("fabrics"), *_price_columns(), _lines().alias("lines"))
            .select(*DOC, "others", "fabrics", F.array_compact(F.array(_fabric_fact())).alias("fabric"),
                    _price_array().alias("prices"), "lines", _starts().alias("starts"))
            .select(*DOC, F.concat("others", "fabrics", "fabric", _as_facts(F.col("prices")), F.transform(_blocks(), line_fact)).alias("facts")))


def all_facts(documents: DataFrame) -> DataFrame:
    """Every fact of every document; of equal values under one field the first stays.

    A document's facts are told apart where they are found. Only where several rows are one document, which takes a
    look at all ids, their facts are put together.
    """
    every = text_scan.rows_of(documents, "facts", *DOC)
    if not text_scan.has_repeats(documents, DOC):
        return every.withColumn("review_status", F.lit("PENDING"))
    rest = ["value", "raw_text", "confidence", "rule"]
    return (every.groupBy(*DOC, "field", F.lower("value").alias("value_key"))
            .agg(F.min_by(F.struct(*rest), "fact_ord").alias("f"), F.min("fact_ord").alias("fact_ord"))
            .select(*DOC, "fact_ord", "field", *[F.col(f"f.{x}").alias(x) for x in rest],
                    F.lit("PENDING").alias("review_status")))


def first_facts(documents: DataFrame) -> DataFrame:
    """:func:`first_per_field` of all facts, told where they are found."""
    if text_scan.has_repeats(documents, DOC):
        return first_per_field(all_facts(documents))
    return text_scan.rows_of(documents, "first", *DOC)


def first_per_field(facts: DataFrame) -> DataFrame:
    return (facts.groupBy(*DOC, "field").agg(F.min_by("value", "fact_ord").alias("value"),
                                             F.min("fact_ord").alias("fact_ord")))


# --------------------------------------------------------------- reconcile
def _python_float(x: Column) -> Column:
    return F.regexp_replace(c.amount_text(x), "0$", "")


def reconciled_prices(documents: DataFrame) -> DataFrame:
    """Prices of each document after the misread-currency checks, worked out within its row.

    A leading 2 is taken for a misread currency mark only with evidence: another
    mention of the amount after a mark, or arithmetic that holds without it.
    """
    # label lines never name the number of designs, so the rules are its only source
    counts = F.concat(*[_rule_facts(*r) for r in fv.FACT_RULES if r[1] == "total_designs"])
    said = documents.select(
        *DOC, *_price_columns(), counts.alias("counts"), F.regexp_extract("text", _java(fv.BREAKDOWN), 0).alias("breakdown"),
        F.regexp_extract_all("text", F.lit(_java(fv.MARKED_AMOUNT)), F.lit(1)).alias("marked")).withColumn("prices", _price_array())

    def first(field: str) -> Column:
        """First price of a kind; prices are in the order of rules and places."""
        return F.get(F.filter("prices", lambda x: x["field"] == field), F.lit(0))["value"]

    found = F.struct(F.when(F.size("prices") > 0, F.lit("price")).alias("field"), "breakdown", "marked",
                     F.get("counts", F.lit(0))["value"].try_cast("int").alias("designs"), first("wholesale_price").alias("raw_ws"),
                     first("single_piece_price").alias("raw_sp"), first("full_catalogue_price").alias("raw_fc"), first("price").alias("raw_any"))
    raw = (_rows(said, F.array(found))
           .withColumn("b_count", _group(F.col("breakdown"), fv.BREAKDOWN, 1).try_cast("int"))
           .withColumn("b_total", c.clean_amount(_group(F.col("breakdown"), fv.BREAKDOWN, 3)))
           .withColumn("pieces", F.coalesce(F.nullif("designs", F.lit(0)), F.col("b_count"))))

    def without_two(name: str) -> Column:
        digits = F.col(name).try_cast("bigint").cast("string")
        return F.when(digits.startswith("2") & (F.length(digits) >= 4),
                      digits.substr(F.lit(2), F.length(digits)).try_cast("bigint").cast("double"))

    def mentioned(x: Column) -> Column:
        return F.array_contains("marked", x.try_cast("bigint").cast("string"))

    cut = raw.select("*", *[without_two(f"raw_{n}").alias(f"cut_{n}") for n in ("fc", "ws", "sp")])
    one = cut.withColumn("fc1", F.when(mentioned(F.col("cut_fc")), F.col("cut_fc")).otherwise(F.col("raw_fc")))
    many = F.col("pieces") > 1
    expected = F.col("pieces") * F.col("cut_ws")

    def near(a: Column, b: Column) -> Column:
        return F.coalesce(F.abs(a - b) < 1.0, F.lit(False))

    by_count = F.coalesce(many, F.lit(False)) & (near(expected, F.col("fc1")) | near(expected, F.col("raw_fc")))
    by_total = ~F.coalesce(many, F.lit(False)) & near(F.col("b_count") * F.col("cut_ws"), F.col("b_total"))
    two = one.select("*", by_count.alias("by_count"), by_total.alias("by_total"), expected.alias("expected"))
    three = two.select(
        "*", F.when(F.col("by_count") | F.col("by_total"), F.col("cut_ws")).otherwise(F.col("raw_ws")).alias("ws"),
        F.when(F.col("by_count") & (F.col("fc1") == F.col("raw_fc")) & near(F.col("expected"), F.col("raw_fc") - 20000),
               F.col("raw_fc") - 20000).when(F.col("by_total"), F.col("b_total")).otherwise(F.col("fc1")).alias("fc"))
    fits = (F.col("ws") <= F.col("cut_sp")) & (F.col("cut_sp") < F.col("fc")) & mentioned(F.col("cut_sp"))
    four = three.withColumn("by_order", F.coalesce(fits, F.lit(False)))
    sp = F.when(F.col("by_order"), F.col("cut_sp")).otherwise(F.col("raw_sp"))

    def moved(what: str, a: str, b: str, tail: Column | str) -> Column:
        return F.concat(F.lit(f"{what} corrected from "), _python_float(F.col(a)), F.lit(" to "),
                        _python_float(F.col(b)), F.lit(tail) if isinstance(tail, str) else tail)

    notes = F.concat_ws(
        "; ",
        F.when(F.col("cut_fc").isNotNull() & mentioned(F.col("cut_fc")), moved(
            "Full catalogue price", "raw_fc", "cut_fc",
            ": leading '2' confirmed as misread Rupee symbol by matching alternative text mention")),
        F.when(F.col("by_count"), moved("Wholesale price", "raw_ws", "cut_ws", F.concat(
            F.lit(": confirmed by catalogue count ("), F.col("pieces").cast("string"), F.lit(" pcs x "),
            _python_float(F.col("cut_ws")), F.lit(" = "), _python_float(F.col("expected")), F.lit(")"))))
        .when(F.col("by_total"), moved("Wholesale price", "raw_ws", "cut_ws", " via breakdown arithmetic")),
        F.when(F.col("by_order"), moved("Single piece price", "raw_sp", "cut_sp", " via alternative mention")))
    return four.select(
        *DOC, sp.alias("single_piece_price"), F.col("ws").alias("wholesale_price"),
        F.col("fc").alias("full_catalogue_price"), F.coalesce(sp, F.col("ws"), F.col("raw_any")).alias("supplier_price"),
        F.nullif(notes, F.lit("")).alias("price_notes"))


# ------------------------------------------------------------ slip to row
def slip_values(documents: DataFrame, facts: DataFrame, prices: DataFrame) -> DataFrame:
    """One value per field and document, prices after reconciliation."""
    corrected = prices.select(*DOC, F.inline(F.filter(F.array(
        *[F.when(F.col(n).isNotNull(), F.struct(F.lit(n).alias("field"), c.amount_text(n).alias("value")))
          for n in ("single_piece_price", "wholesale_price", "full_catalogue_price", "supplier_price")],
        F.when(F.col("price_notes").isNotNull(), F.struct(
            F.lit("price_notes").alias("field"), F.col("price_notes").alias("value")))), lambda x: x.isNotNull())))
    merged = (first_per_field(facts).select(*DOC, "field", "value", F.lit(1).alias("rank"))
              .unionByName(corrected.withColumn("rank", F.lit(0))))
    per_field = merged.groupBy(*DOC, "field").agg(F.min_by("value", "rank").alias("value"))
    names = per_field.where(F.col("field").isin("catalog_name", "product_name")).groupBy(*DOC).agg(
        F.max(F.when(F.col("field") == "catalog_name", F.col("value"))).alias("cat"),
        F.max(F.when(F.col("field") == "product_name", F.col("value"))).alias("name"))
    lent = names.where(F.col("cat").isNull()).select(
        *DOC, F.lit("catalog_name").alias("field"), F.col("name").alias("value"))
    return per_field.unionByName(lent)


def slip_rows(documents: DataFrame, values: DataFrame) -> DataFrame:
    """One raw sheet row per document, ready for normalisation."""
    pairs = values.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct("field", "value"))).alias("cells"))
    return (pairs.join(documents.select(*DOC, "filename", F.col("text").alias("raw_ocr_text")), DOC)
            .select(F.concat_ws("/", "run_id", F.col("doc_id").cast("string")).alias("run_id"),
                    F.col("filename").alias("source_file"), F.lit(1).alias("row_number"),
                    F.concat(F.array(F.lit("raw_ocr_text")), F.col("cells.field")).alias("headers"),
                    F.concat(F.array(F.lit("raw_ocr_text")), F.col("cells.field")).alias("keys"),
                    F.concat(F.array("raw_ocr_text"), F.col("cells.value")).alias("cells")))


def read_values(documents: DataFrame) -> DataFrame:
    """:func:`slip_values` of all facts and the reconciled prices of documents, told where they are found."""
    if text_scan.has_repeats(documents, DOC):
        return slip_values(documents, all_facts(documents), reconciled_prices(documents))
    return text_scan.rows_of(documents, "values", *DOC)


def read_rows(documents: DataFrame) -> DataFrame:
    """:func:`slip_rows` of the values of documents, told where they are found."""
    if text_scan.has_repeats(documents, DOC):
        return slip_rows(documents, read_values(documents))
    text = documents.withColumn("raw_ocr_text", F.col("text"))
    found = text_scan.rows_of(text, "cells", *DOC, "filename", "raw_ocr_text")
    names = F.concat(F.array(F.lit("raw_ocr_text")), "fields")
    return found.select(
        F.concat_ws("/", "run_id", F.col("doc_id").cast("string")).alias("run_id"), F.col("filename").alias("source_file"),
        F.lit(1).alias("row_number"), names.alias("headers"), names.alias("keys"), F.concat(F.array("raw_ocr_text"), "cells").alias("cells"))


def read_names(documents: DataFrame) -> DataFrame:
    """Supplier price and catalogue name of each document that says anything."""
    if text_scan.has_repeats(documents, DOC):
        return read_values(documents).groupBy(*DOC).agg(*[
            F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in ("supplier_price", "catalog_name")])
    return text_scan.rows_of(documents, "named", *DOC)


def slip_rejects(documents: DataFrame, facts: DataFrame) -> DataFrame:
    """Documents without text or without any fact."""
    no_text = c.is_blank("text")
    silent = documents.join(facts.select(*DOC), DOC, "left_anti")
    return silent.select(*DOC, "filename", F.when(no_text, F.lit("No extractable product data found")).otherwise(
        F.lit("No recognizable catalogue fields found")).alias("reason"))


# ------------------------------------------------------------- documents
def document_confidence(documents: DataFrame, words: DataFrame) -> DataFrame:
    """Status of each document and the mean confidence of its words ``(run_id, doc_id, word, conf)``.

    Words without text and boxes marked -1 do not count; without any word the
    confidence is 0.8.
    """
    seen = (words.where((F.col("conf") != -1) & ~c.is_blank("word")).groupBy(*DOC)
            .agg(F.avg(F.col("conf").cast("decimal(9,2)")).alias("mean"), F.count(F.lit(1)).alias("word_count")))
    status = F.when(F.col("status").isin("FAILED", "UNSUPPORTED_FORMAT", "PROVIDER_UNAVAILABLE", "OCR_REQUIRED"),
                    F.col("status")).when(c.is_blank("text"), F.lit("NO_TEXT_FOUND")).otherwise(F.lit("SUCCESS"))
    return (documents.join(seen, DOC, "left").select(
        *DOC, status.alias("status"), F.coalesce("word_count", F.lit(0)).alias("word_count"),
        F.coalesce(F.bround(F.col("mean").cast("double") / 100, 2), F.lit(0.8)).alias("confidence")))


def document_summary(documents: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """Text length, number of facts and the last value of each field; without ``facts`` they are told where they are found."""
    length = F.length("text").alias("text_length")
    if facts is None and not text_scan.has_repeats(documents, DOC):
        told = text_scan.rows_of(documents.select(*DOC, length, F.coalesce("text", F.lit("")).alias("text")), "last", *DOC, "text_length")
        return told.select(*DOC, "text_length", "fact_count", F.when(F.col("fact_count") > 0, F.map_from_entries("last")).alias("fields"))
    per_field = (all_facts(documents) if facts is None else facts).groupBy(*DOC, "field").agg(
        F.count(F.lit(1)).alias("n"), F.max_by("value", "fact_ord").alias("value"))
    counted = per_field.groupBy(*DOC).agg(
        F.sum("n").alias("fact_count"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field", "value")))).alias("fields"))
    return (documents.select(*DOC, length).join(counted, DOC, "left")
            .na.fill(0, ["fact_count"]))

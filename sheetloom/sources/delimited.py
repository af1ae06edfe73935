"""Delimited catalogue sheets: many files, any header, any of four delimiters.

A sheet is a file, or a folder whose files are its parts in the order of their
names. The files are read as lines. A record's number is its place among the
records of its file split behind those of the splits before it; only counts per
split are shuffled, never the lines. Cells are cut by a pattern, so a row may
have any number of them.

A quoted cell may hold delimiters, quotes and line breaks. Whether a line begins
inside a quoted cell follows from all lines before it: each line maps the two
states (outside, inside) to states, maps are composed per split, and the state
at the start of a split comes from a running composition over splits, one row
each. Only records that cross the edge of a split are exchanged to be put
together. Sheets without such cells keep to built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.session import written
from sheetloom.sources.layouts import effective_keys_column

DELIMITERS = [",", "\t", ";", "|"]
FILE = "source_file"
_SPLIT = [FILE, "part"]
_QUOTED = '"[^"]*+(?:""[^"]*+)*+"'


def _raw(spark: SparkSession, paths: str | list[str], folders: bool) -> DataFrame:
    """All lines with their sheet, their split of it, and a number that rises within the split."""
    path, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    sheet = F.regexp_replace(path, "/[^/]*$", "/") if folders else path
    part = F.concat(path, F.lit("\0"), F.lpad(start.cast("string"), 20, "0"))
    return (spark.read.option("recursiveFileLookup", "true").text(paths)
            .select(sheet.alias(FILE), part.alias("part"), F.regexp_replace("value", "^\ufeff", "").alias("value")))


def _blank(tab_file: Column) -> Column:
    """Blank lines do not count; a line of tabs only is an empty row of a tab file."""
    return F.when(tab_file, F.trim("value", F.lit(c.WHITE_SPACE.replace("\t", "")))).otherwise(c.pystrip("value")) == ""


def _ends_inside(begins_inside: bool) -> Column:
    """Whether a line ends inside a quoted cell. Whole quoted cells go first; a quote at the start of a cell is left open."""
    def left_open(d: str) -> Column:
        sep = "\\" + d if d == "|" else d
        text = F.col("value")
        if begins_inside:  # the end of the cell that is open
            text = F.regexp_replace(F.concat(F.lit('"'), text), "^" + _QUOTED, "q")
        return F.regexp_replace(text, f"(?<=^|{sep}){_QUOTED}", "q").rlike(f'(^|{sep})"')

    out = F.when(~F.contains("value", F.lit('"')), F.lit(begins_inside))
    for d in DELIMITERS:
        out = out.when(F.col("delimiter") == d, left_open(d))
    return out


def _sheets(raw: DataFrame) -> DataFrame:
    """One row per sheet: its delimiter, and whether its records have to be put together or its blank lines looked at."""
    kept = raw.where(~_blank(F.lit(True))).withColumn("id", F.monotonically_increasing_id())
    heads = kept.groupBy(FILE).agg(F.min_by("value", F.struct("part", "id")).alias("value"))
    named = written(infer_delimiters(heads).select(FILE, "delimiter"), "sheet-delimiters")
    odd = _ends_inside(False) | ((F.col("delimiter") != "\t") & (c.pystrip("value") == ""))
    return written(kept.join(named, FILE).groupBy(FILE, "delimiter").agg(F.bool_or(odd).alias("tangled")), "sheets")


def _plain(raw: DataFrame, sheets: DataFrame) -> DataFrame:
    # numbered behind the filter, so the numbers of a split rise by one
    kept = raw.where(~_blank(F.lit(True))).withColumn("id", F.monotonically_increasing_id())
    own = kept.join(sheets.where(~F.col("tangled")).select(FILE), FILE)
    earlier = Window.partitionBy(FILE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    places = (own.groupBy(*_SPLIT).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
              .select(*_SPLIT, (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")))
    return own.join(places, _SPLIT).select(FILE, (F.col("id") + F.col("shift") + 1).alias("line_no"), "value")


def _split_maps(lines_: DataFrame) -> DataFrame:
    """One row per split: the state behind it and the records begun in it, for both states before it."""
    keys, flags = [FILE, "part"], ["opens", "stays", "blank"]

    def fold(batches):
        import pyarrow as pa

        now, inside, begun = None, [False, True], [0, 0]

        def row():
            return pa.RecordBatch.from_pydict({
                keys[0]: [now[0]], keys[1]: [now[1]], "end0": [inside[0]], "end1": [inside[1]],
                "n0": pa.array([begun[0]], pa.int64()), "n1": pa.array([begun[1]], pa.int64())})

        for batch in batches:
            for file, part, opens, stays, blank in zip(*[batch.column(x).to_pylist() for x in [*keys, *flags]], strict=True):
                if (file, part) != now:
                    if now:
                        yield row()
                    now, inside, begun = (file, part), [False, True], [0, 0]
                for k in (0, 1):
                    begun[k] += not inside[k] and not blank
                    inside[k] = stays if inside[k] else opens
        if now:
            yield row()

    return lines_.select(*keys, *flags).mapInArrow(fold, f"{FILE} string, part string, end0 boolean, end1 boolean, n0 bigint, n1 bigint")


def _split_states(maps: DataFrame) -> DataFrame:
    """Per split: whether it begins inside a cell, the records begun before it, and whether its sheet ends inside a cell.

    The state behind a split is that of the last split whose map is constant, turned by every swap since.
    """
    so_far = Window.partitionBy(FILE).orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_order = Window.partitionBy(FILE).orderBy("part")
    swaps = maps.withColumn("swaps", F.count_if(F.col("end0") & ~F.col("end1")).over(so_far))
    fixed = F.when(F.col("end0") == F.col("end1"), F.struct(F.col("end0").alias("state"), "swaps"))
    base = F.last(fixed, ignorenulls=True).over(so_far)
    turned = (F.col("swaps") - F.coalesce(base["swaps"], F.lit(0))) % 2 == 1
    behind = swaps.withColumn("behind", F.coalesce(base["state"], F.lit(False)) != turned)
    begins = behind.withColumn("inside", F.lag("behind", 1, False).over(in_order))
    before = Window.partitionBy(FILE).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    here = F.when(F.col("inside"), F.col("n1")).otherwise(F.col("n0"))
    counted = begins.withColumn("begun", F.coalesce(F.sum(here).over(before), F.lit(0))).withColumn("records", F.col("begun") + here)
    ends = counted.groupBy(FILE).agg(F.max_by("behind", "part").alias("unended"), F.max("records").alias("records"))
    return counted.select(FILE, "part", "inside", "begun").join(ends, FILE)


def _pieces(lines_: DataFrame) -> DataFrame:
    """Records of each split; one that begins before it or may end behind it is an edge."""
    names = [FILE, "part", "value", "opens", "stays", "blank", "inside", "begun"]

    def assemble(batches):
        import pyarrow as pa

        out, now, state, number, held, leading, size = [], None, False, 0, [], False, 0

        def packed():
            columns = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(columns, [pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_()], strict=True)],
                names=[names[0], "line_no", "part", "value", "edge"])

        for batch in batches:
            for file, part, value, opens, stays, blank, inside, begun in zip(*[batch.column(x).to_pylist() for x in names], strict=True):
                if (file, part) != now:
                    if held:
                        out.append((*now[:1], number, now[1], "\n".join(held), True))
                    now, state, number, held, leading = (file, part), inside, begun, [], inside
                if not state:
                    if blank:
                        continue
                    number, held, leading = number + 1, [], False
                held.append(value)
                state = stays if state else opens
                if not state:
                    out.append((file, number, part, "\n".join(held), leading))
                    held, leading = [], False
                size += len(value)
                if size > 1 << 20 and out:
                    yield packed()
                    out, size = [], 0
        if held:
            out.append((*now[:1], number, now[1], "\n".join(held), True))
        if out:
            yield packed()

    return lines_.select(*names).mapInArrow(assemble, f"{FILE} string, line_no bigint, part string, value string, edge boolean")


def _tangled(raw: DataFrame, sheets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of sheets with cells over several lines, and the sheets that end inside a cell."""
    own = (raw.withColumn("id", F.monotonically_increasing_id()).join(sheets.where("tangled").select(FILE, "delimiter"), FILE)
           .withColumns({"opens": _ends_inside(False), "stays": _ends_inside(True), "blank": _blank(F.col("delimiter") == "\t")}))
    in_order = [FILE, "part", "id"]  # a join may have mixed the lines
    states = written(_split_states(_split_maps(own.sortWithinPartitions(*in_order))), "sheet-splits")
    ended = own.join(states.where(~F.col("unended")).select(FILE, "part", "inside", "begun"), _SPLIT)
    pieces = written(_pieces(ended.sortWithinPartitions(*in_order)), "sheet-records")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "value"))), lambda x: x["value"]), "\n")
    glued = pieces.where("edge").groupBy(FILE, "line_no").agg(joined.alias("value"))
    unended = states.where("unended").groupBy(FILE).agg(F.max("records").alias("line_no"))
    return pieces.where(~F.col("edge")).select(FILE, "line_no", "value").unionByName(glued), unended


def _records(spark: SparkSession, paths: str | list[str], folders: bool) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Numbered records, sheets, and unended sheets if there may be any."""
    raw = _raw(spark, paths, folders)
    sheets = _sheets(raw)
    every, unended = _plain(raw, sheets), None
    if not sheets.where("tangled").isEmpty():
        more, unended = _tangled(raw, sheets)
        every = every.unionByName(more)
    return every.withColumn("line_no", F.col("line_no").cast("int")), sheets, unended


def lines(spark: SparkSession, paths: str | list[str], folders: bool = False) -> DataFrame:
    """Records with their number; the header is record 1. Line breaks inside a record are newlines.

    Blank lines between records do not count. A line of tabs only counts in a
    tab file: it is an empty row. A sheet that ends inside a quoted cell has no
    records; :func:`scan_rejects` names it. ``folders``: a folder is one sheet.
    """
    return _records(spark, paths, folders)[0]


def infer_delimiters(header_lines: DataFrame) -> DataFrame:
    """Delimiter of each file: the candidate its header line uses most.

    A header without any candidate is a tab file by extension, else a comma file.
    """
    def used(d: str) -> Column:
        return F.length("value") - F.length(F.replace(F.col("value"), F.lit(d), F.lit("")))

    counts = F.array(*[F.struct(used(d).alias("n"), F.lit(-i).alias("rank"), F.lit(d).alias("d"))
                       for i, d in enumerate(DELIMITERS)])
    best = F.array_max(counts)
    by_name = F.when(F.lower(FILE).rlike(r"\.(tsv|tab)$"), F.lit("\t")).otherwise(F.lit(","))
    return header_lines.select(FILE, "value", F.when(best["n"] > 0, best["d"]).otherwise(by_name).alias("delimiter"),
                               best["n"].alias("delimiter_count"))


def _cut(line: Column, d: str) -> Column:
    """Cells of a line: quoted ones without their quotes, doubled quotes single."""
    sep = "\\" + d if d == "|" else d
    quoted = '"([^"]*+(?:""[^"]*+)*+)"'
    every = F.regexp_extract_all(F.concat(line, F.lit(d)), F.lit(f'({quoted}[^{sep}]*|[^{sep}]*){sep}'), F.lit(1))

    def bare(x: Column) -> Column:
        inner = F.replace(F.regexp_extract(x, f"(?s)^{quoted}(.*)$", 1), F.lit('""'), F.lit('"'))
        return F.when(x.rlike(f"(?s)^{quoted}"), F.concat(inner, F.regexp_extract(x, f"(?s)^{quoted}(.*)$", 2))).otherwise(x)

    return F.transform(every, bare)


def _parsed() -> Column:
    """Cells of a line as an array, by the delimiter of its file."""
    out = F.when(F.col("delimiter") == DELIMITERS[0], _cut(F.col("value"), DELIMITERS[0]))
    for d in DELIMITERS[1:]:
        out = out.when(F.col("delimiter") == d, _cut(F.col("value"), d))
    return out


def _sheet_rows(every: DataFrame, sheets: DataFrame, run_id: Column | None) -> DataFrame:
    heads = every.where(F.col("line_no") == 1).join(sheets.select(FILE, "delimiter"), FILE)
    name = F.transform(_parsed(), lambda h, i: F.when(c.pystrip(h) != "", c.pystrip(h)).otherwise(F.concat(F.lit("Unnamed: "), i.cast("string"))))
    named = (heads.withColumn("headers", name).withColumn("keys", effective_keys_column(F.transform("headers", c.header_key)))
             .select(FILE, "delimiter", "headers", "keys"))
    rows = every.where(F.col("line_no") > 1).join(named, FILE)
    sheet = rows.select(FILE, F.col("line_no").alias("row_number"), "headers", "keys", _parsed().alias("all_cells"))
    return sheet.withColumn("run_id", F.col(FILE) if run_id is None else run_id)


def _too_long() -> Column:
    return F.size("all_cells") > F.size("headers")


def scan(spark: SparkSession, paths: str | list[str], run_id: Column | None = None, folders: bool = False) -> DataFrame:
    """Raw sheet rows of all files: ``run_id, source_file, row_number, headers, keys, cells``.

    A column without a name is called after its place; a row with more cells
    than the header is left to :func:`scan_rejects`; missing cells are null.
    """
    every, sheets, _ = _records(spark, paths, folders)
    rows = _sheet_rows(every, sheets, run_id).where(~_too_long())
    cells = F.transform("headers", lambda h, i: F.nullif(F.get("all_cells", i), F.lit("")))
    return rows.select("run_id", FILE, "row_number", "headers", "keys", cells.alias("cells"))


def scan_rejects(spark: SparkSession, paths: str | list[str], run_id: Column | None = None, folders: bool = False) -> DataFrame:
    """Rows with more cells than their header has columns, and the record that a sheet ends within."""
    every, sheets, unended = _records(spark, paths, folders)
    long = _sheet_rows(every, sheets, run_id).where(_too_long()).select("run_id", FILE, "row_number", F.concat(
        F.lit("Expected "), F.size("headers").cast("string"), F.lit(" fields, saw "), F.size("all_cells").cast("string")).alias("reason"))
    if unended is None:
        return long
    own = F.col(FILE) if run_id is None else run_id
    return long.unionByName(unended.select(own.alias("run_id"), FILE, F.col("line_no").cast("int").alias("row_number"),
                                           F.lit("End of file inside a quoted cell").alias("reason")))


def cells(rows: DataFrame) -> DataFrame:
    """Long form: one row per cell."""
    return rows.select("run_id", FILE, "row_number", F.posexplode(F.arrays_zip("headers", "cells")).alias("pos", "x")).select(
        "run_id", FILE, "row_number", "pos", F.col("x.headers").alias("header"), F.col("x.cells").alias("value"))


# --------------------------------------------------------- attribute files
def is_attribute_file() -> Column:
    return F.transform("headers", F.lower) == F.array(F.lit("column"), F.lit("value"))


def attributes_of(rows: DataFrame) -> DataFrame:
    """Key and value lines of two-column attribute files."""
    return rows.where(is_attribute_file()).select(
        FILE, "row_number", F.get("cells", F.lit(0)).alias("key"), F.get("cells", F.lit(1)).alias("value"))


def pivot_attributes(pairs: DataFrame) -> DataFrame:
    """One value per key and file: blank keys dropped, the last line of a key wins."""
    return (pairs.withColumn("key", c.pystrip("key")).where(F.col("key") != "")
            .groupBy(FILE, "key").agg(F.max_by(F.coalesce("value", F.lit("")), "row_number").alias("value")))


def attribute_rows(pairs: DataFrame) -> DataFrame:
    """One composite raw row per attribute file."""
    per_file = pivot_attributes(pairs).groupBy(FILE).agg(F.sort_array(F.collect_list(F.struct("key", "value"))).alias("p"))
    return per_file.select(
        F.col(FILE).alias("run_id"), FILE, F.lit(2).alias("row_number"), F.col("p.key").alias("headers"),
        effective_keys_column(F.transform("p.key", c.header_key)).alias("keys"),
        F.transform("p.value", lambda x: F.nullif(x, F.lit(""))).alias("cells"))


def strict_rejects(pairs: DataFrame) -> DataFrame:
    """Attribute files the strict reader refuses, with each reason."""
    named = pairs.withColumn("name", F.replace(F.lower(c.pystrip("key")), F.lit(" "), F.lit("_")))
    per_name = named.groupBy(FILE, "name").agg(
        F.count(F.lit(1)).alias("n"),
        F.bool_or(~c.is_blank("value") & F.col("name").isin(fv.STRICT_NUMERIC)
                  & c.pystrip("value").try_cast("double").isNull()).alias("bad"))
    hits = per_name.select(FILE, F.explode(F.array_compact(F.array(
        F.when(F.col("n") > 1, F.concat(F.lit("duplicate attribute "), F.col("name"))),
        F.when(F.col("bad"), F.concat(F.lit("not a number: "), F.col("name")))))).alias("reason"))
    wanted = F.array(*[F.lit(x) for x in fv.STRICT_REQUIRED])
    present = per_name.groupBy(FILE).agg(F.collect_set(
        F.when(F.col("name").isin(fv.STRICT_REQUIRED), F.col("name"))).alias("present"))
    missing = present.select(FILE, F.explode(F.array_except(wanted, "present")).alias("name")).select(
        FILE, F.concat(F.lit("missing column "), F.col("name")).alias("reason"))
    return hits.unionByName(missing)


def empty_sources(files: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Sources without a single data row."""
    return files.join(rows.select(key), key, "left_anti").select(
        key, F.lit("Input source contains no data rows (empty or header-only)").alias("reason"))

"""N-gram Jaccard join: prefix filters under several token orders, intersected before verification.

A document's set holds the hashes of its distinct ``SIZE``-word shingles. Sets as similar as the
threshold demands share at least one of their first tokens (the prefix) under *any* order of all tokens
that is the same for every document. Three orders are used: A puts tokens with rare hash buckets first,
B and C put classes of rare buckets first and order them by two other hashes. A pair is verified only if
its sizes fit and its prefixes meet under A, B and C.

1. Token counts by hash bucket (a table of fixed size) over all documents; they only shape the orders.
2. One row per document: fingerprint of its set, A prefix, and a histogram of the set over a few cells.
   Documents with equal sets are one *class*.
3. Tokens in the A prefixes of two classes or more; each brings its classes together in tiles of at most
   two blocks, split by hash, so that no token's group must fit into one task. Sizes, places (a token
   that is the first common one bounds what can follow) and histograms (no pair shares more tokens than
   the sum of their cells' minima) leave the classes that have a partner; then a pair is given to the
   first token that it shares under A. What leaves a tile is one row per class that still has a partner,
   never pairs.
4. Texts of those classes only are fetched and meet in their tiles again. Pairs whose prefixes do not meet
   under B and C as well go; the exact intersection of whole sets decides. A tile returns the links of each
   class and one edge to its tile's smallest relative.
5. Connected components over these edges.

Scale: work beyond the two scans follows the number of shared rare tokens. Texts that no partner is left
for are kept from the shuffle by a bit table of fixed size over the wanted ids. Hot groups: copies are one
class after a pre-aggregated step, groups of near copies are tiles. The broadcast tables have fixed sizes.

Defined results: null, empty and blank texts have no shingles and are linked with nothing, their component
is their own id; a document of one or two words has one shingle; a row without id takes part like any other
and lends no id to its component, which is null if none has one; rows that repeat an id are separate
documents; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheetloom.llm.common import append_struct, as_bytes, free_name, on_workers, rows_of
from sheetloom.llm.components import components
from sheetloom.session import clean_up, tables, written

SIZE = 3
PERCENT = 90
BUCKET_BITS = 18
WANTED_BITS = 22
BLOCK_CLASSES = 1_024  # classes of a block on average
BLOCK_WORDS = 1_000_000  # shingles of a block on average
PAIRS = 50_000  # pairs of members that are looked at together
PAIR_CELLS = 4_000_000  # of their histograms at a time
BEFORE = 16  # earlier shared tokens that a member shows in its tile
KEPT_WORDS = 100_000  # word hashes that a task remembers
_TILE = ["tok", "i", "j"]
CELLS, MOST_CELLS = 32, 512  # of a histogram; between them the power of two that gives 16 to 32 tokens a cell

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class Shingler:
    """Sets of shingle hashes; words are maximal runs without ASCII white space, A-Z lower-cased."""

    def __init__(self, size: int = SIZE):
        self.size, self.known = size, {}

    def words(self, text: bytes | None) -> np.ndarray:
        found = text.lower().split() if text else []
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        out = []
        for w in found:
            h = known.get(w)
            if h is None:
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return np.array(out, np.uint64)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct hashes; fewer words than a shingle has are one shingle of their own length."""
        words = self.words(text)
        if not len(words):
            return words
        width = min(self.size, len(words))
        mixed = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            mixed = (mixed ^ words[k:k + len(mixed)]) * _ODD[0]
            mixed ^= mixed >> np.uint64(32)
        return np.unique(mixed)


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1


def least_common(a, b, percent: int = PERCENT):
    """Tokens that two sets of these sizes share at least if they are linked."""
    return -(-percent * (a + b) // (100 + percent))


def bucket_of(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def first_tokens(tokens: np.ndarray, counts: np.ndarray, order: str, percent: int = PERCENT) -> np.ndarray:
    """First tokens of a set under one of the orders A, B and C."""
    seen = counts[bucket_of(tokens)]
    if order == "A":
        keys = (tokens, seen)
    else:
        keys = (tokens * _ODD[3 if order == "B" else 4], np.log2(seen + 1).astype(np.int64))
    return tokens[np.lexsort(keys)[:prefix_length(len(tokens), percent)]]


def histogram(tokens: np.ndarray) -> bytes | None:
    """Tokens by cell of their hash; None where a cell has more than a byte can say."""
    size = min(MOST_CELLS, max(CELLS, 1 << max(0, (len(tokens) // 16).bit_length() - 1)))
    cells = np.bincount((tokens & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return cells.astype(np.uint8).tobytes() if cells.max() < 256 else None


def most_common(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """No more tokens than this are shared by the sets of histograms that stand in the same rows."""
    size = min(p.shape[1], q.shape[1])
    p, q = (m if m.shape[1] == size else m.reshape(len(m), -1, size).sum(axis=1, dtype=np.uint32) for m in (p, q))
    return np.minimum(p, q).sum(axis=1, dtype=np.int64)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = _common(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _signed(tokens: np.ndarray) -> np.ndarray:
    return tokens.view(np.int64)


def bucket_counts(docs: DataFrame, size: int, text_col: str) -> np.ndarray:
    """Shingles of all documents by hash bucket."""
    def make():
        shingler, counts = Shingler(size), np.zeros(1 << BUCKET_BITS, np.int64)

        def work(batch):
            found = [shingler.shingles(t) for t in as_bytes(batch.column(text_col)).to_pylist()]
            if found:
                np.add(counts, np.bincount(bucket_of(np.concatenate(found)), minlength=len(counts)), out=counts)
            return iter(())

        def rest():
            used = np.flatnonzero(counts)
            yield {"bucket": used.astype(np.int32), "n": counts[used]}

        work.rest = rest
        return work

    rows = rows_of(docs.select(text_col), "bucket int, n long", make, text_col).groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    counts[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return counts


def described(docs: DataFrame, counts: np.ndarray, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n, class, a, cells): set size, fingerprint of the set (null if empty), A prefix, histogram."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def make():
        shingler = Shingler(size)

        def work(batch):
            out: dict[str, list] = {"doc_id": batch.column("doc_id"), "n": [], "class": [], "a": [], "cells": []}
            for text in as_bytes(batch.column("text")).to_pylist():
                tokens = shingler.shingles(text)
                some = len(tokens) > 0
                out["n"].append(len(tokens))
                out["class"].append(fingerprint(tokens) if some else None)
                out["a"].append(_signed(first_tokens(tokens, shared.value, "A", percent)) if some else None)
                out["cells"].append(histogram(tokens) if some else None)
            yield out
        return work

    return rows_of(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")),
                   "doc_id long, n long, class binary, a array<long>, cells binary", make)


def _tiles(members: DataFrame) -> DataFrame:
    """Members of a token's group once for each pair of blocks that their own block belongs to."""
    own = F.pmod(F.xxhash64("class", "tok"), F.col("blocks")).cast("int")
    spread = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return spread.select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).drop("other", "blocks")


def _whole_tiles(batches) -> Iterator[pa.Table]:
    """Sorted record batches as tables of whole tiles; what is held is the last tile and one batch."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _TILE])
        change = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if last is not None and (keys[:, 0] != last).any():
            change = np.concatenate([[0], change])
        last = keys[:, -1]
        if len(change):
            end = int(change[-1])
            yield pa.Table.from_batches([*kept, batch.slice(0, end)])
            kept = [batch.slice(end)]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def _by_tile(tiles: DataFrame) -> DataFrame:
    return on_workers(tiles).repartition(*_TILE).sortWithinPartitions(*_TILE, "own")


class Tiles:
    """Members of whole tiles, sorted, and the pairs of them that sizes, places and histograms leave."""

    def __init__(self, keys: np.ndarray, own: np.ndarray, n: np.ndarray, pos: np.ndarray, cells: list[bytes | None], percent: int):
        self.n, self.left, self.percent = n, n - pos, percent
        rows = len(n)
        starts = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1]) if rows else np.zeros(0, np.int64)
        ends = np.append(starts[1:], rows)
        tile = np.repeat(np.arange(len(starts)), ends - starts)
        second = np.flatnonzero((own == keys[2]) & (keys[1] != keys[2]))  # members of the second block stand last
        turn = ends.copy()
        np.minimum.at(turn, tile[second], second)
        # each member's partners are those from ``first`` to ``stop``
        self.stop = ends[tile]
        self.first = np.where(keys[1] == keys[2], np.arange(rows) + 1, turn[tile])
        self.stop[second] = self.first[second]
        self.sizes = np.array([len(c) if c else 0 for c in cells], np.int64)
        self.row, self.table = np.zeros(rows, np.int64), {}
        for size in np.unique(self.sizes[self.sizes > 0]).tolist():
            of = np.flatnonzero(self.sizes == size)
            self.row[of] = np.arange(len(of))
            self.table[size] = np.frombuffer(b"".join([cells[k] for k in of]), np.uint8).reshape(-1, size)

    def _too_few(self, a: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Pairs whose histograms cannot share as many tokens as they need."""
        out = np.zeros(len(a), bool)
        kinds = self.sizes[a] * (MOST_CELLS + 1) + self.sizes[b]
        for kind in np.unique(kinds).tolist():
            x, y = divmod(kind, MOST_CELLS + 1)
            if x and y:
                at = np.flatnonzero(kinds == kind)
                for part in np.array_split(at, -(-len(at) * max(x, y) // PAIR_CELLS)):
                    out[part] = most_common(self.table[x][self.row[a[part]]], self.table[y][self.row[b[part]]]) < least[part]
        return out

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        many = np.maximum(self.stop - self.first, 0)
        upto = np.cumsum(many)
        begin = 0
        while begin < len(many):
            end = max(begin + 1, int(np.searchsorted(upto, (upto[begin - 1] if begin else 0) + PAIRS, "right")))
            own = many[begin:end]
            total = int(own.sum())
            if total:
                a = np.repeat(np.arange(begin, end), own)
                b = np.arange(total) - np.repeat(np.cumsum(own) - own, own) + np.repeat(self.first[begin:end], own)
                low, high = np.minimum(self.n[a], self.n[b]), np.maximum(self.n[a], self.n[b])
                least = least_common(low, high, self.percent)
                fits = np.flatnonzero((100 * low >= self.percent * high) & (np.minimum(self.left[a], self.left[b]) >= least))
                a, b, least = a[fits], b[fits], least[fits]
                if len(a):
                    kept = ~self._too_few(a, b, least)
                    if kept.any():
                        yield a[kept], b[kept]
            begin = end


def _numbers(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy().astype(np.int64)


def with_partners(tiles: DataFrame, percent: int, home: bool) -> DataFrame:
    """(tok, pos, i, j, own, class): members that keep a partner in their tile.

    With ``home`` pairs go that share one of the tokens in ``before``, a few earlier ones that each class meets partners by.
    """
    def run(batches):
        for table in _whole_tiles(batches):
            found = Tiles(np.stack([_numbers(table, c) for c in _TILE]), _numbers(table, "own"), _numbers(table, "n"), _numbers(table, "pos"),
                          table.column("cells").to_pylist(), percent)
            if home:
                before = table.column("before").combine_chunks()
                sizes = np.asarray(before.value_lengths())
                earlier = np.zeros((table.num_rows, BEFORE), np.int64)
                known = np.arange(BEFORE) < sizes[:, None]
                earlier[known] = before.flatten().to_numpy()
            met = np.zeros(table.num_rows, bool)
            for a, b in found.pairs():
                if home:
                    asked = np.flatnonzero(~(met[a] & met[b]))
                    a, b = a[asked], b[asked]
                    shared = np.zeros(len(a), bool)
                    for k in range(BEFORE):
                        shared |= known[a, k] & ((earlier[a, k, None] == earlier[b]) & known[b]).any(axis=1)
                    a, b = a[~shared], b[~shared]
                met[a] = met[b] = True
            if met.any():
                kept = table.select(["tok", "pos", "i", "j", "own", "class"]).filter(pa.array(met))
                yield from kept.to_batches()

    return _by_tile(tiles).mapInArrow(run, "tok long, pos int, i int, j int, own int, class binary")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Members that two sorted sets share."""
    if len(a) > len(b):
        a, b = b, a
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum()) if len(a) else 0


def verified(tiles: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """(class, links, near): in each tile a class's linked documents of other classes, and its smallest relative.

    A pair is decided in one tile, that of the first token that its sets share under order A.
    """
    shared = tiles.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        shingler = Shingler(size)
        for table in _whole_tiles(batches):
            keys, own, pos = np.stack([_numbers(table, c) for c in _TILE]), _numbers(table, "own"), _numbers(table, "pos")
            classes, copies = table.column("class").to_pylist(), _numbers(table, "copies")
            tokens, cells, earlier, others = [], [], [], []
            for data, p in zip((t.as_py() for t in table.column("text")), pos, strict=True):
                own_tokens = shingler.shingles(data)
                tokens.append(own_tokens)
                cells.append(histogram(own_tokens))
                earlier.append(np.sort(first_tokens(own_tokens, shared.value, "A", percent)[:p]))
                others.append([np.sort(first_tokens(own_tokens, shared.value, order, percent)) for order in "BC"])
            links, root = np.zeros(len(classes), np.int64), list(range(len(classes)))

            def top(k, root=root):
                while root[k] != k:
                    root[k] = root[root[k]]
                    k = root[k]
                return k

            for a, b in Tiles(keys, own, np.array([len(t) for t in tokens], np.int64), pos, cells, percent).pairs():
                for x, y in zip(a.tolist(), b.tolist(), strict=True):
                    if (not _common(earlier[x], earlier[y]) and all(_common(p, q) for p, q in zip(others[x], others[y], strict=True))
                            and linked(tokens[x], tokens[y], percent)):
                        links[x] += copies[y]
                        links[y] += copies[x]
                        low, high = sorted((top(x), top(y)), key=classes.__getitem__)
                        root[high] = low
            out = np.flatnonzero(links).tolist()
            if out:
                yield pa.RecordBatch.from_pydict({"class": pa.array([classes[k] for k in out], pa.binary()), "links": pa.array(links[out], pa.int64()),
                                                  "near": pa.array([classes[top(k)] for k in out], pa.binary())})

    return _by_tile(tiles).mapInArrow(run, "class binary, links long, near binary")


def _cell(id_col: str):
    return F.pmod(F.xxhash64(F.col(id_col).cast("long")), F.lit(1 << WANTED_BITS)).cast("int")


def bit_table(ids: DataFrame, id_col: str = "doc_id") -> np.ndarray:
    """A bit for each cell that an id falls into: 2^WANTED_BITS of them, however many ids there are."""
    cells = ids.select(_cell(id_col).alias("cell")).distinct().toArrow()
    table = np.zeros(1 << WANTED_BITS, bool)
    table[cells.column("cell").to_numpy()] = True
    return np.packbits(table)


def fingerprint(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def texts_of(docs: DataFrame, wanted: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(found, text) of rows whose id falls into a cell of a wanted one; ``found`` is the text's own class."""
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(wanted))

    def make():
        hit, shingler = np.unpackbits(shared.value).view(bool), Shingler(size)

        def work(batch):
            kept = batch.filter(pa.array(hit[batch.column("cell").to_numpy()]))
            texts = as_bytes(kept.column("text")).to_pylist()
            sets = [shingler.shingles(t) for t in texts]
            some = [k for k, tokens in enumerate(sets) if len(tokens)]
            yield {"found": [fingerprint(sets[k]) for k in some], "text": [texts[k] for k in some]}
        return work

    return rows_of(docs.select(F.col(text_col).alias("text"), _cell(id_col).alias("cell")), "found binary, text binary", make)


def link_classes(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, class (fingerprint), root (smallest class of the component), component_id, n_links.

    ``n_links`` counts the other documents that a document is linked with, copies included.
    """
    counts = bucket_counts(docs, size, text_col)
    rows = written(described(docs, counts, size, percent, id_col, text_col), "described")
    alive = rows.where(F.col("class").isNotNull())

    # one row per class: copies of a text are one from here on
    classes = written(alive.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("n").alias("n"),
                                                 F.first("a").alias("a"), F.first("cells").alias("cells")), "classes")

    # tokens that two classes have in their A prefixes, then their members
    exploded = classes.select(F.posexplode("a").alias("pos", "tok"), "class", "n")
    # the first common token of two sets lies early in the smaller one
    early = F.col("pos") <= F.col("n") - F.ceil(2 * percent * F.col("n") / (100 + percent))
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_WORDS)).cast("int")
    shared = exploded.groupBy("tok").agg(F.count("*").alias("members"), blocks.alias("blocks"), F.bool_or(early).alias("early"))
    shared = shared.where("members > 1 and early").select("tok", "blocks")
    members = exploded.select("tok", "pos", "class").join(shared, "tok")
    looks = classes.select("class", "n", "cells")
    near = written(with_partners(_tiles(members.join(looks, "class")), percent, home=False), "near")
    in_order = F.transform(F.array_sort(F.collect_set(F.struct("pos", "tok"))), lambda t: t["tok"])
    tokens = near.groupBy("class").agg(in_order.alias("shared"))  # at most a prefix each
    before = F.slice("shared", F.lit(1), F.least(F.array_position("shared", F.col("tok")) - 1, F.lit(BEFORE)).cast("int"))
    met = near.join(looks.join(tokens, "class"), "class").withColumn("before", before).drop("shared")
    met = written(with_partners(met, percent, home=True), "partners")

    wanted = met.select("class").distinct().join(classes.select("class", "doc_id", "copies"), "class")
    # any row with a class's set stands for it
    texts = texts_of(docs, wanted, size, id_col, text_col).groupBy(F.col("found").alias("class")).agg(F.first("text").alias("text"))
    tiles = met.join(texts.join(wanted.select("class", "copies"), "class"), "class")
    links = written(verified(tiles, counts, size, percent), "links")

    roots = components(links.select(F.col("class").alias("u"), F.col("near").alias("v"))).select(F.col("v").alias("class"), "root")
    degree = links.groupBy("class").agg(F.sum("links").alias("links"))
    merged = classes.select("class", "doc_id", "copies").join(roots, "class", "left").join(degree, "class", "left").withColumn("root", F.coalesce("root", "class"))
    least = merged.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    known = merged.join(least, "root").select("class", "root", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    alone = rows.where(F.col("class").isNull())
    return (alive.select("doc_id", "n", "class").join(known, "class")
            .select("doc_id", F.col("n").alias("n_shingles"), "class", "root", "component_id", "n_links")
            .unionAll(alone.select("doc_id", F.col("n").alias("n_shingles"), "class", F.lit(None).cast("binary").alias("root"),
                                   F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))))


def keep_one(docs: DataFrame, size: int = SIZE, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, one of each component: the one with the smallest id (of equal rows any one).

    A row without id stays only where no similar one has an id. Rows without shingles stay. Texts of rows that are surely kept are not shuffled: a bit
    table over the ids of rows that may go tells them apart.
    """
    spark = docs.sparkSession
    known = tables(spark)
    found = written(link_classes(docs, size, percent, id_col, text_col).where("root is not null"), "linked")
    # the join's own tables have done their work
    clean_up(spark, [p for p in tables(spark)[:-1] if p not in known])
    keepers = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "class")).alias("k")).select("k.doc_id", "k.class")
    rows = found.groupBy("doc_id", "class").agg(F.count("*").alias("rows"))
    stays = [F.col("doc_id").eqNullSafe(F.col("s_id")), F.col("class") == F.col("s_class")]
    going = rows.join(keepers.select(F.col("doc_id").alias("s_id"), F.col("class").alias("s_class")), stays, "left").where("s_class is null or rows > 1")
    shared = docs.sparkSession.sparkContext.broadcast(bit_table(going))
    cell, mark = free_name(docs, "cell"), free_name(docs, "mark")

    def make():
        hit, shingler = np.unpackbits(shared.value).view(bool), Shingler(size)

        def work(batch):
            cells = batch.column(cell).to_numpy(zero_copy_only=False)
            out = []
            for at, text in zip(cells, as_bytes(batch.column(text_col)).to_pylist(), strict=True):
                tokens = shingler.shingles(text) if hit[int(at)] else ()
                out.append(fingerprint(tokens) if len(tokens) else None)
            return {"class": out}
        return work

    marked = append_struct(docs.withColumn(cell, _cell(id_col)), mark, T.StructType([T.StructField("class", T.BinaryType())]), make, text_col)
    asked = marked.where(F.col(mark)["class"].isNotNull())
    k = keepers.select(F.col("doc_id").alias(free_name(docs, "keeper_id")), F.col("class").alias(free_name(docs, "keeper_class")))
    both = [F.col(id_col).cast("long").eqNullSafe(F.col(k.columns[0])), F.col(mark)["class"] == F.col(k.columns[1])]
    first = Window.partitionBy(*k.columns).orderBy(k.columns[0])
    one = asked.join(k, both).withColumn(cell, F.row_number().over(first)).where(F.col(cell) == 1)
    return marked.where(F.col(mark)["class"].isNull()).select(docs.columns).unionAll(one.select(docs.columns))

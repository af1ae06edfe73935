"""Prefix trie of conversations by the splitter-skeleton method.

A turn is a key of 32 hex digits (SHA-256 of role and text), a conversation the sequence of its keys; the
trie's nodes are the distinct beginnings of sequences.

1. Turns are numbered within their conversation, stretch by stretch, and cut into segments of ``SEGMENT``
   turns. A segment belongs to a slab: a trie of its own below the node where the turns before it end. Equal
   segments of a slab are one class, so copies are one row from here on.
2. Classes are range-partitioned by their path (slab, then keys). A node whose members lie on both sides of a
   splitter is a beginning of that splitter's path: the splitters' beginnings are the *skeleton*, broadcast as
   their paths. All other nodes lie within one shard, which sorts its paths and finishes them with a stack.
   Skeleton nodes are left as partial counts, minima and sums, which are reduced by node; sums over
   subtrees of the skeleton are sums over each node's beginnings.
3. Slabs below the first are finished first. What hangs below the end of a segment is added up along the
   slabs by doubling, in as many rounds as the logarithm of their number, and given to the segment's last node.
4. Ids of conversations that end at a node are joined to text in stretches of ``STRETCH`` numbers, and digested
   stretch after stretch; a digest is sequential by nature, so it streams and holds one record batch.

Scale: every group has a bound: ``SEGMENT`` turns, ``STRETCH`` ids, shards of about ``SHARD_TURNS`` turns (their
number grows with the table; splitters are quantiles of a sample of paths of at most ``SEGMENT`` turns, and a class is
one row however many members it has). The skeleton has at most ``SEGMENT`` + 1 nodes per shard. Texts are
hashed where they are read and never shuffled.

Defined results: rows without conv_id belong to no conversation and take no part; a null role or text is
empty; a null turn comes first, equal turns come in the order of their keys, and repeated rows are turns
each; a conversation may have no turns (rebuilt ones); an empty table gives no nodes, else there is one root;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheetloom.llm.common import on_workers
from sheetloom.operators.ranking import rank_by_text
from sheetloom.session import written

SEGMENT = 64
SHARD_TURNS = 100_000
SAMPLED = 32  # paths of the sample for each shard
STRETCH = 4_096
UNIT = 32  # digits of a key
ROOT = "0" * UNIT
NOBODY = hashlib.sha256(b"").hexdigest()

_NODE = "key string, parent_key string, parent long, seg int, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved long, words long, ends string, open boolean"


def keyed(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, key, words) of rows (conv_id, turn, role, text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    told = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.substring(F.sha2(told, 256), 1, UNIT).alias("key"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))


def rebuilt(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, size, depth, key, words): each conversation's first turns taken from the first conversation of its group.

    The first h of them, h = crc32(conv_id) % ``heads``, are those of conversation conv_id - conv_id % ``group``.
    Every conversation also has a row of depth 0 without a key.
    """
    placed = written(rank_by_text(keyed(turns), ["conv_id"], ["turn", "key"], "place"), "placed")
    convs = placed.groupBy("conv_id").agg(F.max("place").cast("long").alias("own")).withColumn("h", F.crc32(F.col("conv_id").cast("string")) % heads)
    base = F.col("conv_id") - F.col("conv_id") % group
    first = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    lent = F.least("h", F.coalesce("there", F.lit(0)))
    convs = convs.withColumn("base", base).join(first, "base", "left").select(
        "conv_id", "base", "h", lent.alias("lent"), (lent + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    convs = written(convs, "conversations")
    turn = placed.select("conv_id", "place", "key", "words")
    rest = turn.join(convs, "conv_id").where(F.col("place") > F.col("h")).select(
        "conv_id", "size", (F.col("lent") + F.col("place") - F.col("h")).alias("depth"), "key", "words")
    head = turn.where((F.col("conv_id") % group == 0) & (F.col("place") < heads)).withColumnRenamed("conv_id", "base")
    begin = head.join(convs, "base").where(F.col("place") <= F.col("lent")).select("conv_id", "size", F.col("place").cast("long").alias("depth"), "key", "words")
    none = convs.select("conv_id", "size", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("long").alias("words"))
    return none.unionAll(begin).unionAll(rest)


def _slabs(segments: DataFrame) -> DataFrame:
    """(conv_id, seg, root) of conversations of several segments: a digest of the segments before."""
    def run(batches):
        conv, root = None, ROOT
        for batch in batches:
            made = []
            for c, s in zip(batch.column("conv_id").to_pylist(), batch.column("told").to_pylist(), strict=True):
                if c != conv:
                    conv, root = c, ROOT
                made.append(root)
                root = hashlib.sha256((root + s).encode()).hexdigest()[:UNIT]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("seg"), pa.array(made, pa.string())], names=["conv_id", "seg", "root"])

    rows = segments.where(F.col("size") > SEGMENT).select("conv_id", "seg", F.sha2("path", 256).alias("told"))
    return on_workers(rows).repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(run, "conv_id long, seg int, root string")


def _digests(members: DataFrame) -> DataFrame:
    """(cid, ends): digest of the comma-joined ids of each class's conversations that end there."""
    stretches = (members.withColumn("stretch", F.floor(F.col("conv_id") / STRETCH)).groupBy("cid", "stretch")
                 .agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")))

    def run(batches):
        cid, digest = None, None
        for batch in batches:
            done = []
            for c, ids in zip(batch.column("cid").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if c == cid:
                    digest.update(b",")
                else:
                    if cid is not None:
                        done.append((cid, digest.hexdigest()))
                    cid, digest = c, hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pydict({"cid": pa.array([d[0] for d in done], pa.string()), "ends": pa.array([d[1] for d in done], pa.string())})
        if cid is not None:
            yield pa.RecordBatch.from_pydict({"cid": [cid], "ends": [digest.hexdigest()]})

    return on_workers(stretches).repartition("cid").sortWithinPartitions("cid", "stretch").mapInArrow(run, "cid string, ends string")


def classes_of(elements: DataFrame) -> DataFrame:
    """One row per distinct segment of a slab: path (slab and keys), words per turn, members, smallest member, digest of those that end."""
    seg = F.floor((F.greatest("depth", F.lit(1)) - 1) / SEGMENT).cast("int")
    turns = F.sort_array(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("depth", "key", "words"))))
    cut = elements.groupBy("conv_id", seg.alias("seg")).agg(F.first("size").alias("size"), turns.alias("turns"))
    cut = written(cut.select("conv_id", "seg", "size", F.array_join(F.transform("turns", lambda t: t.key), "").alias("path"),
                             F.transform("turns", lambda t: t.words).alias("words")), "segments")
    single = cut.where(F.col("size") <= SEGMENT).withColumn("root", F.lit(ROOT))
    several = cut.where(F.col("size") > SEGMENT).join(_slabs(cut), ["conv_id", "seg"]).select(single.columns)
    cid = F.substring(F.sha2(F.concat("root", F.sha2("path", 256)), 256), 1, UNIT)
    placed = single.unionAll(several).withColumn("cid", cid).withColumn("open", (F.col("seg") + 1) * SEGMENT < F.col("size"))
    placed = written(placed.select("conv_id", "cid", "open", "seg", F.concat("root", "path").alias("path"), "words"), "members")
    whole = placed.groupBy("cid", "path").agg(F.first("words").alias("words"), F.first("seg").alias("seg"), F.count("*").alias("n"), F.min("conv_id").alias("least"),
                                              F.bool_or("open").alias("open"))
    return written(whole.join(_digests(placed.where(~F.col("open")).select("cid", "conv_id")), "cid", "left"), "classes")


def _splitters(classes: DataFrame, shard_turns: int) -> list[str]:
    """Paths that cut the classes into shards of about ``shard_turns`` turns."""
    size = classes.agg(F.sum(F.size("words") + 1).alias("turns"), F.count("*").alias("classes")).first()
    shards = -(-(size["turns"] or 0) // shard_turns)
    if shards < 2:
        return []
    every = max(1, size["classes"] // (shards * SAMPLED))
    sample = classes.where(F.pmod(F.xxhash64("path"), F.lit(every)) == 0).select("path")
    ranged = sample.repartitionByRange(shards, "path").groupBy(F.spark_partition_id().alias("p")).agg(F.min("path").alias("path"))
    return sorted(r["path"] for r in ranged.collect())[1:]


def _finish(rows: list[tuple], left: str, right: str) -> list[tuple]:
    """Nodes of one shard (rows of _NODE); those on the splitters around it are partial, with their key.

    ``rows`` are sorted: path, words, seg, n, least, ends, open, parent's id for the slab's top, and below the end: children, leaves, saved.
    """
    made: list[list] = []  # parent, key or None, seg, depth, least, n, children, leaves, saved, words, ends, open, top
    stack: list[int] = []

    def close() -> None:
        node = made[stack.pop()]
        up = made[stack[-1]] if stack else None
        if node[1] is None or node[3] == 0 and not _on(node[1]):
            if not node[6] and not node[11]:
                node[7] = 1
            node[8] += (node[5] - 1) * node[9]
            if up:
                up[6] += 1
                up[7] += node[7]
                up[8] += node[8]
        if up:
            up[4] = min(up[4], node[4])
            up[5] += node[5]

    def _on(key: str) -> bool:
        return left.startswith(key) or right.startswith(key)

    before = ""
    for path, words, seg, n, least, ends, is_open, top, children, leaves, saved in rows:
        units, same = len(path) // UNIT, 0
        while same < min(units, len(stack)) and path[same * UNIT:(same + 1) * UNIT] == before[same * UNIT:(same + 1) * UNIT]:
            same += 1
        while len(stack) > same:
            close()
        on = same == 0 or made[stack[-1]][1] is not None and _on(path[:same * UNIT])
        for u in range(same, units):
            on = on and _on(path[:(u + 1) * UNIT])
            made.append([stack[-1] if stack else -1, path[:(u + 1) * UNIT] if on or u == 0 else None, seg, u, least, 0, 0, 0, 0, words[u - 1] if u else 0, None, False, top])
            stack.append(len(made) - 1)
        node = made[stack[-1]]
        node[4], node[5], node[6], node[7], node[8] = min(node[4], least), node[5] + n, node[6] + children, node[7] + leaves, node[8] + saved
        node[10], node[11], before = ends, is_open, path
    while stack:
        close()
    out = []
    for up, key, seg, depth, least, n, children, leaves, saved, words, ends, is_open, top in made:
        parent = made[up] if up >= 0 else None
        partial = key is not None and _on(key)
        parent_key = parent[1] if parent and parent[1] is not None and _on(parent[1]) else None
        # below the top of a slab the parent is the node that the slab hangs on
        above = None if parent is None else top if depth == 1 and seg else None if parent_key else parent[4]
        out.append((key if partial or depth == 0 else None, parent_key, above, seg, depth, least, n, children, leaves, saved, words, ends, is_open, partial))
    return out


def nodes(classes: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """Nodes (_NODE) of the slabs that ``classes`` form.

    Columns: path, words, seg, n, least, ends, open, top (id of the node that the slab hangs on), below_children, below_leaves, below_saved.
    """
    splitters = classes.sparkSession.sparkContext.broadcast(_splitters(classes, shard_turns))
    columns = ["path", "words", "seg", "n", "least", "ends", "open", "top", "below_children", "below_leaves", "below_saved"]

    def deal(batches):
        cuts = splitters.value
        for batch in batches:
            shard = [bisect_right(cuts, p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], names=[*batch.schema.names, "shard"])

    def work(key, shard):
        at, cuts = key[0].as_py(), splitters.value
        rows = sorted(zip(*[shard.column(c).to_pylist() for c in columns], strict=True), key=lambda r: r[0])
        found = _finish(rows, cuts[at - 1] if at else "", cuts[at] if at < len(cuts) else "")
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), schema, strict=True)], schema=schema)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    own = f"{_NODE}, partial boolean"
    schema = pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in own.split(", "))])
    dealt = on_workers(classes.select(columns)).mapInArrow(deal, classes.select(columns).schema.add("shard", "integer"))
    found = written(dealt.groupBy("shard").applyInArrow(work, own), "nodes")

    # the skeleton: partial rows of a node from several shards are reduced
    parts = found.where("partial").groupBy("key").agg(
        F.max("parent_key").alias("parent_key"), F.max("parent").alias("parent"), F.first("seg").alias("seg"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")], F.max("words").alias("words"), F.max("ends").alias("ends"),
        F.bool_or("open").alias("open"))
    parts = written(parts, "skeleton")
    more = parts.where("parent_key is not null").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    bones = parts.join(more, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    leaf = F.when((F.col("n_children") == 0) & ~F.col("open"), 1).otherwise(F.col("n_leaves"))
    begins = F.transform(F.sequence(F.lit(0), F.col("depth")), lambda d: F.substr("key", F.lit(1), (d + 1) * UNIT))
    sums = (bones.select(leaf.alias("n_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("words")).alias("saved"), F.explode(begins).alias("key"))
            .groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")))
    bones = bones.drop("n_leaves", "saved").join(sums, "key")
    names = [f.split()[0] for f in _NODE.split(", ")]
    plain = found.where(~F.col("partial"))
    every = plain.where("parent_key is null").select(names).unionAll(plain.where("parent_key is not null").select(names)
                                                                      .unionAll(bones.where("parent_key is not null").select(names))
                                                                      .join(parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")), "parent_key")
                                                                      .withColumn("parent", F.coalesce("parent", "above")).select(names))
    return every.unionAll(bones.where("parent_key is null").select(names))


def _below(deep: DataFrame, hangs: DataFrame) -> DataFrame:
    """(key, below_children, below_leaves, below_saved) of slabs: sums over all slabs that hang on them.

    ``deep`` are the tops of slabs, ``hangs`` (key, up) tells the slab that each hangs on.
    """
    state = written(deep.select("key", "n_children", "n_leaves", "saved").join(hangs, "key", "left"), "slabs")
    while state.where("up is not null").limit(1).count():
        added = state.where("up is not null").groupBy(F.col("up").alias("key")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        higher = state.select(F.col("key").alias("up"), F.col("up").alias("higher"))
        state = written(state.join(added, "key", "left").join(higher, "up", "left").select(
            "key", "n_children", (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            F.col("higher").alias("up")), "slabs")
    return state.select("key", F.col("n_children").alias("below_children"), F.col("n_leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))


def trie(elements: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """All nodes of the trie of conversations whose turns are ``elements`` (as ``rebuilt`` gives them).

    Columns: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (words that need not be read
    again, over the subtree), ends_sha256 (of the ids of conversations that end at the node).
    """
    classes = classes_of(elements)
    nothing = [F.lit(0).cast("long").alias(f"below_{c}") for c in ("children", "leaves", "saved")]
    deep = classes.where("seg > 0")
    opens = classes.where("open").select("cid", "least", F.substr("path", F.lit(1), F.lit(UNIT)).alias("up"), "seg")
    tops = nodes(deep.select("*", F.lit(None).cast("long").alias("top"), *nothing), shard_turns).where("depth = 0")
    below = _below(tops, opens.select(F.col("cid").alias("key"), F.when(F.col("seg") > 0, F.col("up")).alias("up")))
    hung = opens.select(F.col("cid").alias("root"), F.col("least").alias("top"))
    ready = (classes.withColumn("root", F.substr("path", F.lit(1), F.lit(UNIT))).join(hung, "root", "left")
             .join(below, classes.cid == below.key, "left").drop("key", "root"))
    ready = ready.fillna(0, ["below_children", "below_leaves", "below_saved"])
    found = nodes(written(ready, "classes"), shard_turns).where("depth > 0 or seg = 0")
    return found.select("conv_id", (F.col("seg") * SEGMENT + F.col("depth")).cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                        "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))

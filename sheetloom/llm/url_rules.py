"""URL filters by a sorted sweep over reversed-host keys.

A host's labels in reverse order, each followed by a comma, make a key under which a host and all its
subdomains lie in one interval: ``net,example,`` up to ``net,example-``. Intervals of rules nest or are
apart. Rules open and close their interval as rows among the URLs' rows; all rows are sorted by key, and
the rules that are open at a URL are a stack with one slot for each depth of nesting. The longest rule
in the stack whose path begins the URL's path decides.

Scale: one range partitioning of keys (a hot host is cut by the URL's id), then a window per partition
that keeps the last row of each slot: the stack. What is open when a partition begins is the last state
of the partitions before it, taken from one summary row per partition. Only built-in functions run. The
partition numbers are written with the keys once, so that a repeated task cannot cut them differently.

Defined results: a null URL or one without ``://`` has an empty host and path and no rule; hosts are
compared label by label, A-Z lower-cased; two rules for the same host and path: block wins; a URL that no
rule fits gets ``default``; repeated rows stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sheetloom.session import written

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OPEN, _URL, _CLOSE = 1, 2, 0  # order among rows with one key


def host_of(url: Column) -> Column:
    after = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    return F.coalesce(F.translate(F.regexp_extract(after, "^[^/?#]*", 0), _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    after = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3))
    return F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def reversed_key(host: Column) -> Column:
    """Labels in reverse order, each ended by a comma; commas within labels are written otherwise."""
    plain = F.replace(F.replace(host, F.lit("%"), F.lit("%25")), F.lit(","), F.lit("%2C"))
    return F.concat(F.array_join(F.reverse(F.split(plain, r"\.")), ","), F.lit(","))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """A few rules (action, host, path) as a table."""
    rows = [F.struct(F.lit(a).alias("action"), F.lit(h).alias("host"), F.lit(p).alias("path")) for a, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _by_host(rules: DataFrame) -> DataFrame:
    """(key, depth, host_rules): rules by host, the longest path first."""
    one = rules.groupBy(F.translate("host", _UPPER, _UPPER.lower()).alias("host"), "path").agg(F.max("action").alias("action"))  # block is greater
    listed = F.transform(F.sort_array(F.collect_list(F.struct(F.length("path").alias("n"), "host", "path", "action")), asc=False),
                         lambda r: F.struct(F.concat(r.host, r.path).alias("rule"), r.path.alias("path"), r.action.alias("action")))
    return one.groupBy("host").agg(listed.alias("host_rules")).select(
        reversed_key(F.col("host")).alias("key"), F.size(F.split("host", r"\.")).alias("depth"), "host_rules")


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url",
          partitions: int | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages``; ``rules`` has columns action, host, path."""
    spark = pages.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = _by_host(rules)
    url = F.col(url_col)
    none = F.lit(None).cast(named.schema["host_rules"].dataType)
    points = pages.select(F.col(id_col).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    points = points.select(reversed_key(F.col("host")).alias("key"), F.lit(_URL).alias("kind"), F.lit(0).alias("depth"), none.alias("host_rules"),
                           "page_id", "host", "path")
    no_page = [F.lit(None).cast(points.schema["page_id"].dataType).alias("page_id"), F.lit("").alias("host"), F.lit("").alias("path")]
    opens = named.select("key", F.lit(_OPEN).alias("kind"), "depth", "host_rules", *no_page)
    # behind the last key that begins with the rule's: the closing comma raised by one
    closes = named.select(F.concat(F.expr("left(key, length(key) - 1)"), F.lit("-")).alias("key"), F.lit(_CLOSE).alias("kind"), "depth", none.alias("host_rules"), *no_page)
    rows = opens.unionAll(closes).unionAll(points).repartitionByRange(n, "key", "kind", "page_id", "path").withColumn("part", F.spark_partition_id())
    rows = written(rows, "url-keys")

    depths = [r["depth"] for r in named.select("depth").distinct().orderBy("depth").collect()]  # 127 at most: a host's labels
    edge = F.struct("host_rules")  # null inside: closed again

    def slot(d: int) -> Column:
        return F.when((F.col("depth") == d) & (F.col("kind") != _URL), edge)

    # the state that each partition leaves behind, and what is open where it begins
    ends = rows.where(F.col("kind") != _URL).groupBy("part").agg(*[F.max_by(slot(d), F.when(slot(d).isNotNull(), F.struct("key", "kind"))).alias(f"s{d}") for d in depths])
    parts = spark.range(n).select(F.col("id").cast("int").alias("part"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = parts.join(ends, "part", "left").select("part", *[F.last(f"s{d}", ignorenulls=True).over(earlier).alias(f"c{d}") for d in depths])

    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = rows.select("*", *[F.last(slot(d), ignorenulls=True).over(sweep).alias(f"o{d}") for d in depths]).where(F.col("kind") == _URL)
    at = swept.join(carried, "part", "left")
    # the deepest open host first, within it the longest path first
    stack = F.flatten(F.array(*[F.coalesce(F.coalesce(f"o{d}", f"c{d}")["host_rules"], F.array().cast(named.schema["host_rules"].dataType)) for d in reversed(depths)]))
    fitting = F.filter(stack, lambda r: F.col("path").startswith(r["path"]))
    longest = F.array_max(F.transform(fitting, lambda r: F.struct(F.length(r["rule"]).alias("n"), r["action"].alias("action"), r["rule"].alias("rule"))))
    return at.withColumn("best", longest).select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                                                 F.coalesce("best.action", F.lit(default)).alias("verdict"))


"""Which tokens occur inside which texts, as equi-joins.

A plain ``contains`` join compares every text with every token of its group.
Here each token is found through its last few characters (its anchor): a text
offers one anchor per position, the positions that hit learn the lengths of the
tokens behind the anchor, and each candidate substring is then looked up whole.
Work is linear in the text length; many tokens with one anchor cost no more
than the number of their different lengths.  Only places and anchors are
shuffled; the text joins the places that hit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

ANCHOR = 5


def contained_tokens(texts: DataFrame, tokens: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """``texts(keys, ids, text)`` and ``tokens(keys, token)`` to ``(keys, ids, token)``.

    ``ids`` name a text within its keys.  A pair comes once per occurrence; callers aggregate.
    """
    token = F.col("token")
    distinct = tokens.where(F.length(token) > 0).select(*keys, "token").distinct()
    size = F.least(F.length(token), F.lit(ANCHOR))
    anchors = (distinct.groupBy(*keys, F.right(token, size).alias("anchor"))
               .agg(F.collect_set(F.length(token)).alias("lengths")))
    sizes = distinct.groupBy(*keys).agg(F.collect_set(size).alias("sizes"))

    def at_each_end(n):
        ends = F.filter(F.sequence(F.lit(1), F.length("text")), lambda e: e >= n)
        return F.transform(ends, lambda e: F.struct(
            e.alias("end"), F.col("text").substr(e - n + F.lit(1), n).alias("anchor")))

    offered = (texts.where(F.length("text") > 0).join(sizes, keys)
               .select(*keys, *ids, F.inline(F.flatten(F.transform("sizes", at_each_end)))))
    hit = (offered.join(anchors, [*keys, "anchor"])
           .withColumn("length", F.explode("lengths"))
           .where(F.col("length") <= F.col("end")))
    whole = hit.drop("anchor", "lengths").join(texts.select(*keys, *ids, "text"), [*keys, *ids])
    candidates = whole.select(
        *keys, *ids,
        F.col("text").substr(F.col("end") - F.col("length") + F.lit(1), F.col("length")).alias("token"))
    return candidates.join(distinct, [*keys, "token"], "left_semi")

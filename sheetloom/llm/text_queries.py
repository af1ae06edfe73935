"""Queries of the operators that work on texts of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheetloom.llm import decontaminate, language_id, ngram_join, pieces, token_counts, toxicity, transducer
from sheetloom.llm.common import held_out, table
from sheetloom.llm.queries import query

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWER = f"translate({{}}, '{_UPPER}', '{_UPPER.lower()}')"

OP1_SQL = rf"""
with item as (
  select cast(item_id as varchar) as item, regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark where item_id is not null),
win as (
  select distinct item, least(13, len(w)) as k, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') as win
  from (select item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) as i from item where len(w) > 0)),
doc as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
  from documents),
part as (
  select rid, k, i, array_to_string(w[i:i + k - 1], ' ') as win
  from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i from doc, (select distinct k from win) where len(w) >= k)),
hit as (select distinct rid, item, i, part.k from part join win on part.k = win.k and part.win = win.win),
places as (select rid, count(distinct p) as n_hit from (select rid, unnest(range(i, i + k)) as p from hit) group by rid),
named as (select rid, count(distinct item) as n_items, array_to_string(list_sort(list(distinct item)), ',') as names from hit group by rid)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join places using (rid) left join named using (rid)
"""


@query("op1_decontaminate", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's overlap with the benchmark's items."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    r = F.col("contamination")
    return found.select("doc_id", r.n_words.alias("n_words"), r.n_hit.alias("n_hit"), F.size(r["items"]).cast("long").alias("n_items"),
                        F.sha2(F.array_join(r["items"], ","), 256).alias("items_sha256"),
                        decontaminate.is_contaminated(r.n_hit, r.n_words).alias("contaminated"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_texts(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", "toxicity.predicted")


OP4_SQL = rf"""
with recursive doc as (
  select row_number() over () as rid, doc_id, coalesce(regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+'), []) as w from documents),
sets as (
  select distinct rid, array_to_string(w[i:i + 2], ' ') as s
  from (select rid, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) as i from doc where len(w) > 0)),
size as (select rid, count(*) as n from sets group by rid),
pair as (
  select a.rid as x, b.rid as y, count(*) as common from sets a join sets b on a.s = b.s and a.rid <> b.rid group by a.rid, b.rid),
link as (
  select x, y from pair join size sx on sx.rid = x join size sy on sy.rid = y where 100 * common >= 90 * (sx.n + sy.n - common)),
reach as (select rid, rid as other from doc union select r.rid, l.y from reach r join link l on l.x = r.other),
low as (select r.rid, min(d.doc_id) as component_id from reach r join doc d on d.rid = r.other group by r.rid)
select doc.doc_id, cast(coalesce(size.n, 0) as bigint) as n_shingles, low.component_id,
  cast((select count(*) from link where link.x = doc.rid) as bigint) as n_links
from doc left join size using (rid) left join low using (rid)
"""


@query("op4_ngram_join", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of similar documents and its number of links."""
    return ngram_join.link_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("class", "root")


@query("op8_language_id")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from texts outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    network = language_id.fit(docs)
    return language_id.identify(docs.select("doc_id", "text"), network).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score")


@query("op9_pieces")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's best segmentations, and whether decoding gives its text back."""
    encoded = pieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    r = F.col("pieces")
    scores = F.concat(F.array(r.score), F.transform(r.alternatives, lambda a: a.score))
    return encoded.select("doc_id", r.n_pieces.alias("n_pieces"), r.score.alias("score"), scores.alias("nbest_scores"),
                          r.ids_sha256.alias("ids_sha256"), r.round_trip.alias("round_trip"))


@query("op10_token_counts")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, and how much of it fits into the limit, out of its prefix counts."""
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), store=True)
    r = F.col("tokens")
    return counted.select("doc_id", r.n_bytes.alias("n_bytes"), r.n_tokens.alias("n_tokens"),
                          (r.n_tokens > token_counts.LIMIT).alias("over_limit"), r.fitting_chars.alias("fitting_chars"))


@query("op13_bpe_stream")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids by the transducer, and their text by the decoder."""
    coded = transducer.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=False)
    return coded.select("doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")

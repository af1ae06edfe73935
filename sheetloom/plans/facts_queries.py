"""Queries of text facts and prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import facts
from sheetloom.operators import normalize as n
from sheetloom.plans import bindings as b
from sheetloom.plans import oracle_base as o
from sheetloom.plans.oracle_base import cte, sql
from sheetloom.plans.registry import query
from sheetloom.session import written

# Slips and the given documents as one text table.
TEXTS = f"""
select run_id, doc_id, filename, status, provider, text, confidence from ({b.SLIPS}) s
union all
select 'doc-' || source as run_id, 1000000000 + doc_id as doc_id, cast(doc_id as string) || '.txt' as filename, 'SUCCESS' as status,
  lang as provider, text, 0.9 as confidence
from {{documents}}
"""


def texts(spark, sf):
    return b.bind(spark, sf, TEXTS)


def slips(spark, sf):
    return b.bind(spark, sf, b.SLIPS)


def _re2(pattern: str) -> str:
    """Without look-ahead: a following label word is consumed instead."""
    return pattern.replace(r"(?=\b(?:", r"\b(?:").replace(r")\b))", r")\b)").replace(r"\b(?!\s*%)", r"\b")


def _each(pattern: str, group: int, source: str) -> str:
    return (f"(select run_id, doc_id, unnest(regexp_extract_all(text, {o.lit(_re2(pattern))}, {group})) as v, "
            f"generate_subscripts(regexp_extract_all(text, {o.lit(_re2(pattern))}, {group}), 1) - 1 as pos from {source})")


def _rule(rule, source):
    order, field, name, pattern, shortest, confidence = rule
    value = {"gst_percent": f"case when cast(v as double) <= 100 then {o.money('cast(v as double)')} end",
             "total_designs": "case when try_cast(v as bigint) > 0 then cast(cast(v as bigint) as varchar) end"}.get(
                 field, "trim(v, ' ' || chr(9) || chr(10) || chr(13))")
    return (f"select run_id, doc_id, cast({(order * 100) << 33} + pos * 2 as bigint) as fact_ord, '{field}' as field, {value} as value, "
            f"{confidence} as confidence, '{name}' as rule from {_each(pattern, 1, source)} where len({value}) >= {shortest}")


def _price(rule, source):
    order, field, name, pattern, group, confidence = rule
    return (f"select run_id, doc_id, {order} as rule_no, pos, '{field}' as field, cast(replace(v, ',', '') as double) as value, "
            f"v as original_raw_number, {confidence} as confidence, '{name}' as rule from {_each(pattern, group, source)} "
            "where cast(replace(v, ',', '') as double) > 0")


cte("t_texts", "", b.oracle_text(TEXTS))
_TOTALS = (fv.BREAKDOWN_ORDER, "full_catalogue_price", fv.BREAKDOWN_RULE, fv.BREAKDOWN, 3, fv.BREAKDOWN_CONFIDENCE)


def _define(prefix: str, source: str) -> None:
    """Fact expressions over one text table."""
    cte(f"{prefix}_labels", source, "\nunion all ".join(_rule(r, source) for r in fv.FACT_RULES))
    cte(f"{prefix}_stated", source, "\nunion all ".join(_price(r, source) for r in fv.PRICE_RULES))
    cte(f"{prefix}_prices", f"{source} {prefix}_stated", f"""
select * from {prefix}_stated union all
select * exclude (k) from (select *, row_number() over (partition by doc_id, value order by pos) as k from ({_price(_TOTALS, source)})) t
where k = 1 and not exists (select 1 from {prefix}_stated s where s.doc_id = t.doc_id and s.rule_no = 1 and s.value = t.value)""")
    keywords = o.values([(k, k.title(), i) for i, k in enumerate(fv.KNOWN_FABRICS)])
    cte(f"{prefix}_fabric", f"{source} {prefix}_labels", f"""
select run_id, doc_id, arg_min(title, i) as value from {source} d, {keywords} as w(word, title, i)
where regexp_matches(lower(text), '\\b' || word || '\\b')
  and not exists (select 1 from {prefix}_labels l where l.doc_id = d.doc_id and l.field = 'fabric') group by 1, 2""")
    cte(f"{prefix}_lines", source, f"""
select *, regexp_extract(line, {o.lit(fv.LABEL_LINE)}, 1) as label, regexp_extract(line, {o.lit(fv.LABEL_LINE)}, 2) as rest
from (select run_id, doc_id, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as line_no,
        trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) as line from {source})""")
    cte(f"{prefix}_blocks", f"{prefix}_lines", f"""
select * from (
  select run_id, doc_id, min(line_no) as line_no, trim(arg_min(label, line_no)) as label,
    trim(regexp_replace(lower(trim(arg_min(label, line_no))), '[^\\w]+', '_', 'g'), '_') as field,
    trim(regexp_replace(string_agg(nullif(case when label <> '' then trim(rest) else line end, ''), ' ' order by line_no), '\\s+', ' ', 'g')) as value
  from (select *, sum(case when line = '' or label <> '' then 1 else 0 end) over (partition by doc_id order by line_no) as block from {prefix}_lines)
  where line <> '' and block > 0 group by run_id, doc_id, block having arg_min(label, line_no) <> '')
where len(label) >= 2 and len(value) >= 1 and field not in {o.in_list(fv.LABEL_KEYS_SKIPPED)}""")
    cte(f"{prefix}_facts", f"{prefix}_labels {prefix}_prices {prefix}_fabric {prefix}_blocks", f"""
select run_id, doc_id, min(fact_ord) as fact_ord, field, arg_min(value, fact_ord) as value, arg_min(confidence, fact_ord) as confidence,
  arg_min(rule, fact_ord) as rule from (
  select * from {prefix}_labels
  union all select run_id, doc_id, cast((500 + rule_no)::bigint * {1 << 33} + pos * 2 as bigint), field, {o.money('value')}, confidence, rule from {prefix}_prices
  union all select run_id, doc_id, cast((500 + rule_no)::bigint * {1 << 33} + pos * 2 + 1 as bigint), 'price', {o.money('value')}, confidence, rule
    from {prefix}_prices where field in ('wholesale_price', 'single_piece_price')
  union all select run_id, doc_id, {(fv.KNOWN_FABRIC_ORDER * 100) << 33}, 'fabric', value, 0.75, 'KEYWORD_KNOWN_FABRIC' from {prefix}_fabric
  union all select run_id, doc_id, cast({(fv.LABEL_LINE_ORDER * 100) << 33} + line_no * 2 as bigint), field, value, 0.85, 'REGEX_KEY_VALUE_LINE' from {prefix}_blocks)
group by run_id, doc_id, field, lower(value)""")


_define("t", "t_texts")
_define("s", "b_slips")


@query("extract_labelled_facts", sql("select * from t_labels", "t_labels"))
def extract_labelled_facts(spark, sf):
    return facts.labelled_facts(texts(spark, sf)).drop("raw_text")


@query("known_fabric", sql("select * from t_fabric", "t_fabric"))
def known_fabric(spark, sf):
    return facts.known_fabrics(texts(spark, sf)).select("run_id", "doc_id", "value")


@query("label_blocks", sql("select * from t_blocks", "t_blocks"))
def label_blocks(spark, sf):
    return facts.label_blocks(texts(spark, sf)).drop("raw_text")


@query("extract_price_facts", sql("select * from t_prices", "t_prices"))
def extract_price_facts(spark, sf):
    return facts.price_facts(texts(spark, sf)).drop("raw_text")


@query("all_facts", sql("select * from t_facts", "t_facts"))
def all_facts(spark, sf):
    return facts.all_facts(texts(spark, sf)).drop("raw_text", "review_status")


@query("first_fact_per_field", sql(
    "select run_id, doc_id, field, arg_min(value, fact_ord) as value, min(fact_ord) as fact_ord from t_facts group by 1, 2, 3", "t_facts"))
def first_fact_per_field(spark, sf):
    return facts.first_facts(texts(spark, sf))


_F = "regexp_replace(cast(cast({0} as decimal(18,2)) as varchar), '0$', '')"
cte("t_first", "t_prices", """
select run_id, doc_id, arg_min(value, (rule_no, pos)) filter (where field = 'wholesale_price') as ws,
  arg_min(value, (rule_no, pos)) filter (where field = 'single_piece_price') as sp,
  arg_min(value, (rule_no, pos)) filter (where field = 'full_catalogue_price') as fc,
  arg_min(value, (rule_no, pos)) filter (where field = 'price') as anyp
from t_prices group by 1, 2""")
cte("t_r1", "t_first t_texts t_facts", f"""
select f.*, t.text, try_cast(regexp_extract(text, {o.lit(fv.BREAKDOWN)}, 1) as integer) as bc,
  try_cast(replace(regexp_extract(text, {o.lit(fv.BREAKDOWN)}, 3), ',', '') as double) as bt,
  coalesce(d.n, try_cast(regexp_extract(text, {o.lit(fv.BREAKDOWN)}, 1) as integer)) as pieces,
  {', '.join(f"case when cast(floor({x}) as bigint)::varchar like '2%' and len(cast(floor({x}) as bigint)::varchar) >= 4 then cast(substr(cast(floor({x}) as bigint)::varchar, 2) as bigint) end as c{x}" for x in ('fc', 'ws', 'sp'))}
from t_first f join t_texts t using (run_id, doc_id)
left join (select run_id, doc_id, arg_min(value, fact_ord)::integer as n from t_facts where field = 'total_designs' group by 1, 2) d using (run_id, doc_id)""")
_SAID = "regexp_matches(text, '(?i)(?:[#@₹=]|rs\\.?)\\s*' || {0} || '\\b')"
cte("t_r2", "t_r1", f"""
select *, coalesce(cfc is not null and {_SAID.format('cfc')}, false) as k1 from t_r1""")
cte("t_r3", "t_r2", """
select *, case when k1 then cfc else fc end as fc1,
  coalesce(pieces > 1, false) and coalesce(abs(pieces * cws - case when k1 then cfc else fc end) < 1 or abs(pieces * cws - fc) < 1, false) as k2,
  not coalesce(pieces > 1, false) and coalesce(abs(bc * cws - bt) < 1, false) as k3 from t_r2""")
cte("t_r4", "t_r3", """
select *, case when k2 or k3 then cws else ws end as ws2,
  case when k2 and fc1 = fc and abs(pieces * cws - (fc - 20000)) < 1 then fc - 20000 when k3 then bt else fc1 end as fc2 from t_r3""")
cte("t_r5", "t_r4", f"""
select *, coalesce(csp is not null and ws2 <= csp and csp < fc2 and {_SAID.format('csp')}, false) as k4 from t_r4""")
cte("t_recon", "t_r5", f"""
select run_id, doc_id, cast(case when k4 then csp else sp end as double) as single_piece_price, cast(ws2 as double) as wholesale_price,
  cast(fc2 as double) as full_catalogue_price, cast(coalesce(case when k4 then csp else sp end, ws2, anyp) as double) as supplier_price,
  nullif(concat_ws('; ',
    case when k1 then 'Full catalogue price corrected from ' || {_F.format('fc')} || ' to ' || {_F.format('cfc')} ||
      ': leading ''2'' confirmed as misread Rupee symbol by matching alternative text mention' end,
    case when k2 then 'Wholesale price corrected from ' || {_F.format('ws')} || ' to ' || {_F.format('cws')} || ': confirmed by catalogue count (' ||
      pieces || ' pcs x ' || {_F.format('cws')} || ' = ' || {_F.format('pieces * cws')} || ')'
      when k3 then 'Wholesale price corrected from ' || {_F.format('ws')} || ' to ' || {_F.format('cws')} || ' via breakdown arithmetic' end,
    case when k4 then 'Single piece price corrected from ' || {_F.format('sp')} || ' to ' || {_F.format('csp')} || ' via alternative mention' end), '') as price_notes
from t_r5""")


@query("reconcile_prices", sql("select * exclude (supplier_price, price_notes) from t_recon", "t_recon"))
def reconcile_prices(spark, sf):
    return facts.reconciled_prices(texts(spark, sf)).drop("supplier_price", "price_notes")


@query("price_precedence", sql("select run_id, doc_id, supplier_price, price_notes from t_recon", "t_recon"))
def price_precedence(spark, sf):
    return facts.reconciled_prices(texts(spark, sf)).select("run_id", "doc_id", "supplier_price", "price_notes")


cte("t_values", "t_facts t_recon", f"""
with base as (
  select run_id, doc_id, field, arg_min(value, rank) as value from (
    select run_id, doc_id, field, arg_min(value, fact_ord) as value, 1 as rank from t_facts group by 1, 2, 3
    union all select run_id, doc_id, 'single_piece_price', {o.money('single_piece_price')}, 0 from t_recon where single_piece_price is not null
    union all select run_id, doc_id, 'wholesale_price', {o.money('wholesale_price')}, 0 from t_recon where wholesale_price is not null
    union all select run_id, doc_id, 'full_catalogue_price', {o.money('full_catalogue_price')}, 0 from t_recon where full_catalogue_price is not null
    union all select run_id, doc_id, 'supplier_price', {o.money('supplier_price')}, 0 from t_recon where supplier_price is not null
    union all select run_id, doc_id, 'price_notes', price_notes, 0 from t_recon where price_notes is not null) group by 1, 2, 3)
select * from base union all
select run_id, doc_id, 'catalog_name', value from base b where field = 'product_name'
  and not exists (select 1 from base c where c.doc_id = b.doc_id and c.field = 'catalog_name')""")


@query("slip_to_raw_row", sql("select * from t_values", "t_values"))
def slip_to_raw_row(spark, sf):
    return facts.read_values(texts(spark, sf))


@query("slip_price_precedence", sql("""
select run_id, doc_id, max(value) filter (where field = 'supplier_price') as supplier_price, max(value) filter (where field = 'catalog_name') as catalog_name
from t_values group by 1, 2""", "t_values"))
def slip_price_precedence(spark, sf):
    return facts.read_names(texts(spark, sf))


@query("slip_products", sql(f"""
select run_id || '/' || doc_id as run_id, coalesce(max(value) filter (where field = 'catalog_name'), 'Catalog-1') as catalog_name,
  cast(max(value) filter (where field = 'supplier_price') as double) as supplier_price,
  coalesce(cast(max(value) filter (where field = 'total_designs') as bigint), max({o.count_of('value')}) filter (where field = 'full_catalogue'), 1) as variant_count
from t_values group by t_values.run_id, doc_id""", "t_values"))
def slip_products(spark, sf):
    """Slips through to products and placeholder variants."""
    rows = written(facts.read_rows(texts(spark, sf)), "slip-rows")
    products, variants = n.normalise(rows)
    counted = variants.groupBy("run_id", "product_ord").agg(F.count(F.lit(1)).alias("variant_count"))
    return products.join(counted, ["run_id", "product_ord"]).select(
        "run_id", "catalog_name", "supplier_price", "variant_count")


@query("slip_rejects", sql("""
select run_id, doc_id, filename, case when trim(text) = '' then 'No extractable product data found' else 'No recognizable catalogue fields found' end as reason
from t_texts s where not exists (select 1 from t_facts f where f.doc_id = s.doc_id)""", "t_texts t_facts"))
def slip_rejects(spark, sf):
    documents = texts(spark, sf)
    return facts.slip_rejects(documents, facts.all_facts(documents))


@query("document_confidence", sql("""
select run_id, doc_id, case when status = 'FAILED' then status when trim(text) = '' then 'NO_TEXT_FOUND' else 'SUCCESS' end as status,
  coalesce(n, 0) as word_count, coalesce((q + case when r > 5000 or (r = 5000 and q % 2 = 1) then 1 else 0 end) / 100.0, 0.8)::double as confidence
from t_texts left join (select run_id, doc_id, n, m // 10000 as q, m % 10000 as r from (select run_id, doc_id, count(*) as n, cast(round(avg(conf) * 10000) as bigint) as m from b_words where conf <> -1 and trim(word) <> '' group by 1, 2)) using (run_id, doc_id)""",
    "t_texts b_words"))
def document_confidence(spark, sf):
    return facts.document_confidence(texts(spark, sf), b.bind(spark, sf, b.WORDS))


@query("document_summary", sql("""
select run_id, doc_id, len(text) as text_length, coalesce(n, 0) as fact_count, coalesce(fields, '') as fields
from t_texts left join (select doc_id, sum(n) as n, string_agg(field || '=' || value, '|' order by field) as fields
  from (select doc_id, field, count(*) as n, arg_max(value, fact_ord) as value from t_facts group by 1, 2) group by 1) using (doc_id)""",
    "t_texts t_facts"))
def document_summary(spark, sf):
    out = facts.document_summary(texts(spark, sf))
    shown = F.array_join(F.transform(F.map_entries("fields"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return out.withColumn("fields", F.coalesce(shown, F.lit("")))

"""The same results in plain SQL for DuckDB: shared table expressions.

``CTES`` maps a name to (names it reads, SQL).  ``sql(body, *names)`` puts the
needed expressions in front of a query.
"""

from __future__ import annotations

import re

from sheetloom import fixed_values as fv
from sheetloom.functions.clean import header_key_text
from sheetloom.operators.normalize import FIELDS, MAPPED
from sheetloom.plans import bindings as b

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: str, text: str) -> None:
    CTES[name] = (tuple(deps.split()), text.strip())


def renamed(names: str, other: dict[str, str], prefix: str) -> None:
    """The expressions ``names`` again over other inputs: their own names get ``prefix``, those of ``other`` are replaced."""
    to = other | {n: f"{prefix}{n}" for n in names.split()}

    def put(text: str) -> str:
        return re.sub(r"\b(" + "|".join(to) + r")\b", lambda m: to[m[0]], text)

    for n in names.split():
        deps, text = CTES[n]
        cte(to[n], put(" ".join(deps)), put(text))


def sql(body: str, names: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            add(dep)
        order.append(name)

    for n in names.split():
        add(n)
    heads = ",\n".join(f"{n} as materialized (\n{CTES[n][1]}\n)" for n in order)
    return f"with {heads}\n{body.strip()}"


def lit(text: str | None) -> str:
    return "null" if text is None else "'" + text.replace("'", "''") + "'"


def values(rows: list[tuple]) -> str:
    def cell(x):
        return lit(x) if isinstance(x, str) or x is None else str(x)

    return "(values " + ", ".join("(" + ", ".join(cell(x) for x in r) + ")" for r in rows) + ")"


def in_list(items) -> str:
    return "(" + ", ".join(lit(x) for x in items) + ")"


# ------------------------------------------------------------- scalar texts
def cs(x: str) -> str:
    return f"case when trim({x}) = '' or lower(trim({x})) in {in_list(fv.NULL_WORDS)} then null else trim({x}) end"


def cf(x: str) -> str:
    bare = f"regexp_replace({cs(x)}, '^(-?)\\s*(?:rs\\.?|inr|₹)\\s*', '\\1', 'i')"
    return (f"(try_cast(regexp_replace({bare}, '[^0-9.]+', '', 'g') as double) * "
            f"case when {cs(x)} like '-%' then -1.0 else 1.0 end)")


def whole(x: str) -> str:
    return f"(case when {x} < 0 then ceil({x}) else floor({x}) end)"


def ci(x: str) -> str:
    return f"(case when abs({cf(x)}) < 2147483648 then cast({whole(cf(x))} as integer) end)"


def group1(x: str, pattern: str) -> str:
    return f"nullif(regexp_extract({x}, {lit(pattern)}, 1), '')"


def count_of(x: str) -> str:
    s = cs(x)
    return (f"try_cast(coalesce({group1(s, fv.COUNT_IN_PARENTHESES)}, {group1(s, fv.COUNT_OF_PIECES)}, "
            f"{group1(s, fv.COUNT_PACK_OF)}, case when regexp_matches({s}, '^[0-9]+$') then {s} end) as integer)")


def key_of(x: str) -> str:
    return f"trim(regexp_replace(lower(trim({x})), '[\\s\\-/.]+', '_', 'g'), '_')"


def token_of(x: str) -> str:
    return (f"regexp_replace(trim(regexp_replace(lower(trim({x})), '[\\W_]+', '-', 'g'), '-'), "
            f"'\\b{fv.SPELLING_FROM}\\b', '{fv.SPELLING_TO}', 'g')")


def prefix_of(x: str) -> str:
    return f"upper(trim(regexp_replace(trim({x}), '[^\\w\\-]+', '-', 'g'), '-'))"


def money(x: str) -> str:
    return f"cast(cast({x} as decimal(38,2)) as varchar)"


def two(x: str) -> str:
    return f"(case when {x} < 100 then lpad(cast({x} as varchar), 2, '0') else cast({x} as varchar) end)"


def drop(x: str, pattern: str) -> str:
    return f"trim(regexp_replace({x}, {lit(pattern)}, '', 'g'))"


def group_name(name: str) -> str:
    bare = f"coalesce(trim({name}), '')"
    for p in (fv.GROUP_NUMBER_RANGE, fv.GROUP_CODE_RANGE, fv.GROUP_VOLUME, fv.GROUP_TRAILING_NUMBER):
        bare = drop(bare, p)
    w = f"list_filter(regexp_split_to_array({bare}, '[\\s\\-_/]+'), lambda w: w <> '')"
    return (f"case when len({w}) = 0 then '{fv.GROUP_FALLBACK}' when len({w}) = 1 then left({w}[1], 6) "
            f"else left({w}[1], 6) || '-' || upper(left({w}[2], 1)) || "
            f"case when lower({w}[2]) in {in_list(fv.GROUP_MIDDLE_WORDS)} and len({w}) > 2 "
            f"then upper(left({w}[3], 1)) else '' end end")


def sku_of(name: str) -> str:
    return (f"coalesce('Vol-' || {group1(name, fv.SKU_VOLUME)}, "
            f"{group1(f'trim({name})', fv.SKU_TRAILING_TOKEN)})")


def words(x: str) -> str:
    return f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


def title_case(x: str) -> str:
    return (f"list_aggregate(list_transform(regexp_extract_all(lower({x}), '[a-z]+|[^a-z]+'), "
            f"lambda w: upper(left(w, 1)) || substr(w, 2)), 'string_agg', '')")


def title_cols(cat: str, brand: str, fab: str, work: str, kind: str) -> str:
    """Three steps need three selects; see ``titled``."""
    return (f"coalesce(trim({brand}), '') t_brand, coalesce(trim({fab}), '') t_fab, "
            f"coalesce(trim({work}), '') t_work, coalesce(nullif(trim({kind}), ''), 'Saree') t_kind, "
            f"coalesce(trim({cat}), '') t_cat0")


def titled(source: str, cat: str) -> str:
    """Select everything of ``source`` (with title_cols) plus the title."""
    cat1 = ("case when t_brand <> '' and t_cat0 <> '' then trim(regexp_replace(t_cat0, "
            "'(?i)\\b' || regexp_escape(t_brand) || '\\b', '', 'g')) else t_cat0 end")
    cat2 = drop(drop(cat1, fv.GROUP_VOLUME), fv.GROUP_TRAILING_NUMBER)
    adj = (f"case when lower(t_work) like '% print' then trim(left(t_work, len(t_work) - 6)) || ' Printed' "
           f"when lower(t_work) like '% printed' or lower(t_work) like '% work' then t_work "
           f"when t_work <> '' and {words('t_work')} <= 2 then t_work || ' Work' else '' end")
    all_said = ("(t_adj <> '' and t_cat <> '' and (contains(lower(t_adj), lower(t_cat)) "
                "or starts_with(lower(t_adj), left(lower(t_cat), 4))))")
    upper = "(upper({0}) = {0} and lower({0}) <> {0})"
    word = (f"case when t_brand <> '' and not {upper.format('t_brand')} and {upper.format('t_cat')} "
            f"then {title_case('t_cat')} else t_cat end")
    return f"""
select *, coalesce(nullif(concat_ws(' ', nullif(t_brand, ''),
    nullif(case when {all_said} then t_adj else {word} end, ''),
    nullif(case when not {all_said} and {words('t_adj')} <= 2 then t_adj else '' end, ''),
    nullif(t_fab, ''), nullif(t_kind, '')), ''), nullif({cat}, ''), 'Product') as title
from (select *, {cat2} as t_cat, {adj} as t_adj from {source})"""


def description(own: str, brand: str, cat: str, fab: str, blouse: str, work: str, wear: str, kind: str,
                price: str) -> str:
    def t(x):
        return f"coalesce(trim({x}), '')"

    o, br, ca, fa, bl, wo, we = (t(x) for x in (own, brand, cat, fab, blouse, work, wear))
    ki = f"coalesce(nullif(trim({kind}), ''), 'Saree')"
    shown = (f"case when {price} = floor({price}) then format('{{:,}}', cast({price} as bigint)) "
             f"else format('{{:,.2f}}', {price}) end")
    return f"""case when length({o}) > 20 then {o} else concat_ws(' ',
  case when {br} <> '' and {fa} <> '' and {ca} <> '' then 'Discover this elegant ' || {fa} || ' ' || {ki} || ' from ' || {br} || ' (' || {ca} || ' Collection).'
       when {br} <> '' and {fa} <> '' then 'Discover this elegant ' || {fa} || ' ' || {ki} || ' from ' || {br} || '.'
       when {br} <> '' and {ca} <> '' then 'Discover this premium ' || {ki} || ' from ' || {br} || ' (' || {ca} || ' Collection).'
       when {fa} <> '' then 'Designed in premium ' || {fa} || ' fabric.'
       when {ca} <> '' then 'Premium quality ' || {ki} || ' from ' || {ca} || ' Collection.'
       else 'Premium quality ' || {ki} || '.' end,
  case when {wo} <> '' then 'Showcases exquisite ' || {wo} || '.' end,
  case when {bl} <> '' and lower({bl}) <> lower({fa}) then 'Features a coordinated ' || {bl} || ' blouse fabric.'
       when {bl} <> '' then 'Includes a matching coordinated blouse piece.' end,
  case when {we} <> '' then 'An excellent choice for ' || {we} || ', offering elegance, comfort, and timeless appeal.' end,
  case when {price} > 0 then 'Single piece dropshipping price: ₹' || {shown} || '.' end) end"""


# ------------------------------------------------------------- binding views
for _name, _text in {
    "b_listing": b.LISTING, "b_images": b.IMAGES, "b_slips": b.SLIPS, "b_decisions": b.DECISIONS,
    "b_pixels": b.PIXELS, "b_words": b.WORDS, "b_blobs": b.BLOBS, "b_attr": b.ATTRIBUTE_FILES,
    "b_batch": b.BATCH, "b_paths": b.BATCH_PATHS, "b_import": b.IMPORT_SOURCES,
}.items():
    cte(_name, "", b.oracle_text(_text))


def _cells_of(style: int) -> str:
    shown = [(c, h[style]) for c, h in b.HEADERS.items() if h[style]]
    return "[" + ", ".join(
        f"{{'pos': {i}, 'header': {lit(h)}, 'value': nullif({c}, '')}}" for i, (c, h) in enumerate(shown)) + "]"


cte("b_cells", "b_listing", f"""
select run_id, source_file, row_number, u.pos, u.header, u.value, {key_of('u.header')} as nkey
from (select run_id, source_file, row_number, unnest(case style when 0 then {_cells_of(0)} when 1 then {_cells_of(1)}
      when 2 then {_cells_of(2)} else {_cells_of(3)} end) as u from b_listing)""")
cte("o_cells", "b_cells", """
select * from b_cells qualify row_number() over (partition by run_id, row_number, nkey order by pos desc) = 1""")
cte("o_profile", "o_cells", f"""
select run_id, signature_headers, supplier_named,
  case when signature_headers >= 2 or supplier_named then '{fv.WHOLESALE}' else '{fv.GENERIC}' end as profile
from (select run_id, count(distinct nkey) filter (where nkey in {in_list(fv.WHOLESALE_SIGNATURE)}) as signature_headers
      from o_cells group by 1)
join (select run_id, coalesce(contains(lower(arg_min(sup, row_number)), 'amra'), false) as supplier_named
      from (select run_id, row_number, coalesce(max(value) filter (where nkey = 'supplier_name' and trim(value) <> ''),
              max(value) filter (where nkey = 'supplier' and trim(value) <> ''), '') as sup
            from o_cells group by 1, 2) group by 1) using (run_id)""")

_alias_rows = []
for _profile, _aliases in ((fv.GENERIC, fv.GENERIC_ALIASES), (fv.WHOLESALE, fv.WHOLESALE_ALIASES)):
    for _field, _names in _aliases.items():
        for _i, _a in enumerate(_names):
            _alias_rows.append((_profile, _field, header_key_text(_a), _i))
_count_rows = [(header_key_text(a), i) for i, a in enumerate(fv.DECLARED_COUNT_ALIASES)]
_mapped_rows = [(p, k) for p, ks in MAPPED.items() for k in ks]

cte("o_hit", "o_cells o_profile", f"""
select run_id, row_number, profile, field, arg_min(header, priority) as header, arg_min(value, priority) as value
from o_cells join o_profile using (run_id)
join {values(_alias_rows)} as a(profile, field, nkey, priority) using (profile, nkey)
where trim(value) <> '' group by all""")
cte("o_count", "o_cells o_profile", f"""
select run_id, row_number, arg_min(header, priority) as header, arg_min(value, priority) as value,
  arg_min(n, priority) as n
from (select *, {count_of('value')} as n from o_cells join {values(_count_rows)} as a(nkey, priority) using (nkey)
      where trim(value) <> '') where n is not null group by 1, 2""")
cte("o_unmapped", "b_cells o_profile", f"""
select run_id, row_number, profile, header, value
from b_cells join o_profile using (run_id)
where value is not null and not exists (select 1 from {values(_mapped_rows)} as m(p, k)
  where m.p = profile and m.k = nkey)""")
cte("o_wide", "b_listing o_profile o_hit", "select l.run_id, l.row_number, l.source_file, p.profile, "
    + ", ".join(f"max(h.value) filter (where field = '{f}') as {f}, max(h.header) filter (where field = '{f}') as h_{f}"
                for f in FIELDS)
    + " from b_listing l join o_profile p using (run_id) left join o_hit h on h.run_id = l.run_id and h.row_number = l.row_number"
    + " group by 1, 2, 3, 4")
cte("o_keyed", "o_wide", f"""
select *, case when profile = '{fv.WHOLESALE}'
  then coalesce({cs('product_group')}, {cs('catalog_name')}, {cs('supplier_sku')}, 'amra_catalog_' || row_number)
  else coalesce({cs('catalog_name')}, {cs('product_group')}, {cs('product_name')}, 'sku_' || {cs('supplier_sku')},
                'row_' || row_number) end as group_key
from o_wide""")
cte("o_first", "o_keyed", f"""
select *, count(*) over g as row_count, sha256(run_id || '|' || profile || '|' || group_key) as product_id
from o_keyed window g as (partition by run_id, profile, group_key)
qualify row_number() over (partition by run_id, profile, group_key order by row_number) = 1""")
cte("o_p1", "o_first", f"""
select *, profile = '{fv.WHOLESALE}' as wh,
  {cs('catalog_name')} as v_cat, {cs('product_name')} as v_name, {cs('product_group')} as v_group,
  {cs('brand_name')} as v_brand, {cs('category_slug')} as v_slug, {cs('description')} as v_desc,
  {cf('single_piece_price')} as n_single, {cf('wholesale_price')} as n_ws, {cf('full_catalogue_price')} as n_full,
  {cf('supplier_price')} as n_price, {cf('gst_percent')} as n_gst, {ci('moq')} as n_moq
from o_first""")
cte("o_p2", "o_p1", f"""
select *, coalesce({cs('supplier_name')}, case when wh then '{fv.PROFILE_DEFAULTS[fv.WHOLESALE]['supplier_name']}' else '{fv.PROFILE_DEFAULTS[fv.GENERIC]['supplier_name']}' end) as f_supplier,
  case when wh then coalesce(v_cat, 'Amra Catalog ' || row_number) else coalesce(v_cat, v_name, 'Catalog-' || row_number) end as f_cat,
  coalesce({cs('product_type')}, case when wh then 'Saree' else 'General' end) as f_type,
  case when wh then n_price else coalesce(n_single, n_price, n_ws) end as f_price
from o_p1""")
cte("o_p3", "o_p2", titled(
    f"(select *, {title_cols('f_cat', 'v_brand', cs('fabric'), cs('work'), 'f_type')} from o_p2)", "f_cat"))
cte("o_products", "o_p3", f"""
select run_id, profile, group_key, product_id, row_number as product_ord, row_count, source_file,
  f_supplier as supplier_name, f_cat as catalog_name,
  case when wh then case when v_name <> f_cat then v_name else title end else coalesce(v_name, f_cat) end as product_name,
  case when wh then coalesce(v_group, {group_name('f_cat')}) else v_group end as product_group,
  v_brand as brand_name, f_type as product_type,
  case when wh then coalesce(v_slug, 'sarees') else {key_of('coalesce(category_slug, f_type)')} end as category_slug,
  case when wh then coalesce(v_desc, {description("null", 'v_brand', 'f_cat', 'fabric', 'blouse_fabric', 'work', 'occasion', 'f_type', 'f_price')})
       else v_desc end as description,
  f_price as supplier_price, n_gst as gst_percent,
  case when wh then coalesce(nullif(n_moq, 0), 1) else n_moq end as moq,
  {cs('dispatch_location')} as dispatch_location,
  wh, size as raw_size, {cs('size')} as c_size, fabric as raw_fabric, blouse_fabric as raw_blouse, work as raw_work, occasion as raw_occasion,
  saree_length as raw_saree_length, blouse_length as raw_blouse_length, stitch_type as raw_stitch_type,
  n_single, n_ws, n_full
from o_p3""")
cte("o_rows", "o_keyed o_products o_count", f"""
select k.*, p.product_id, p.product_ord, p.row_count, p.product_group as p_group, p.catalog_name as p_cat,
  p.supplier_price as p_price, p.wh, case when p.wh then p.raw_size else p.c_size end as p_size, n.n as declared,
  row_number() over (partition by k.run_id, k.profile, k.group_key order by k.row_number) as row_ord,
  {cs('k.supplier_sku')} as r_sku, {cs('k.variant_code')} as r_code, {cs('k.variant_name')} as r_name,
  {cs('k.color')} as r_color, {cs('k.image_sku')} as r_image
from o_keyed k join o_products p using (run_id, profile, group_key)
left join o_count n on n.run_id = k.run_id and n.row_number = k.row_number""")
cte("o_rows2", "o_rows", """
select *, row_count = 1 and coalesce(case when wh then declared > 1 or (variant_name is null and supplier_sku is null)
     else r_code is null and (declared > 1 or (declared = 1 and r_name is null)) end,
     case when wh then variant_name is null and supplier_sku is null else false end) as ph,
  case when r_image is not null then min(row_number) over (partition by run_id, profile, group_key, lower(r_image)) end as first_use
from o_rows""")
cte("o_var1", "o_rows2", """
select *, case when ph then copy_no else row_ord end as variant_ord
from (select *, unnest(range(1, 1 + case when ph and declared > 0 then declared else 1 end)) as copy_no from o_rows2)""")
_v = "'-V' || " + two("variant_ord")
cte("o_variants", "o_var1", f"""
select run_id, profile, product_id, product_ord, cast(variant_ord as integer) as variant_ord,
  case when wh then case
      when ph then trim(regexp_replace(upper(p_cat), '[^\\w]+', '-', 'g'), '-') || {_v}
      when r_image is null then p_group || {_v}
      when first_use = row_number then r_image else r_image || '-' || variant_ord end
    when not ph and r_code is not null then r_code
    when not ph and r_sku is not null then r_sku || {_v}
    else coalesce(nullif({prefix_of("case when ph then coalesce(p_group, r_sku, p_cat) else coalesce(p_group, p_cat) end")}, ''),
      case when ph then 'PROD-' || {two('variant_ord')} else 'SKU-' || row_number end) || {_v} end as variant_code,
  r_sku as supplier_sku,
  case when ph then 'Design ' || {two('variant_ord')} when wh then coalesce(r_name, 'Design ' || variant_ord)
       else coalesce(r_name, r_color, 'Option ' || variant_ord) end as variant_name,
  case when ph then null when wh then r_name else r_color end as color,
  case when ph then p_size when not wh then {cs('size')} end as size,
  case when ph or (case when wh then variant_cost else supplier_price end) is null then p_price
       else {cf('(case when wh then variant_cost else supplier_price end)')} end as supplier_cost,
  case when not ph then {cf('selling_price')} end as selling_price,
  case when not ph and not wh then {ci('stock_quantity')} end as stock_quantity,
  case when not ph and wh then r_image end as image_sku,
  case when not ph and wh then {cs('primary_image_url')} end as primary_image_url,
  case when not ph and wh then list_filter([{cs('gallery_1')}, {cs('gallery_2')}, {cs('gallery_3')}, {cs('gallery_4')}], lambda u: u is not null)
       else [] end as gallery_image_urls,
  false as publish, 'PENDING' as review_status, ph as is_placeholder, row_number
from o_var1""")

"""Views that read the given tables as supplier catalogue data.

The SQL below uses only what Spark and DuckDB both understand, so the checks
start from exactly the same rows.  ``{part}``, ``{orders}`` ... stand for the
given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sheetloom.functions.clean import header_key_text
from sheetloom.session import broadcast_by_measure
from sheetloom.sources.layouts import effective_keys


def _pick(expr: str, values: list[str | None]) -> str:
    arms = " ".join(
        f"when {i} then {'null' if v is None else chr(39) + v + chr(39)}" for i, v in enumerate(values))
    return f"case {expr} % {len(values)} {arms} end"


_MAKERS = ["Rajni", "Mahotsavi", "Bunawari", "Sethnika", "Noor"]
_LINES = ["Kriti", "Lifestyle Eradi", "Ajrak", "NOORANI"]
_SHADES = ["Red", "Navy Blue", "Teal", "Mustard", "Pink", "Wine", None, "Green", "Off White", "nan"]
_FABRICS = ["Modal Satin", "Art Silk", "Georgette", None, "Linen"]
_WORKS = ["Ajrak Print", "Zari", None, "Hand Made Thread Work", "Foil"]


def run_columns(k: str) -> str:
    """run and catalogue of item ``k``: run 'run-hot' holds a third of the items."""
    cat = f"cast(floor({k} / 4) as bigint)"
    run_no = f"cast(floor({k} / 48) as bigint)"
    return (
        f"{cat} as cat, "
        f"case when {cat} % 3 = 0 then 'run-hot' "
        f"else 'run-' || lpad(cast({run_no} as string), 6, '0') end as run_id, "
        f"case when {cat} % 3 = 0 then 0 else {run_no} % 4 end as style")


def catalogue_text(cat: str, k: str) -> str:
    """Catalogue title of item ``k``; some catalogues have one row only."""
    title = (f"{_pick(cat, _MAKERS)} || ' ' || {_pick(cat, _LINES)} || ' Vol-' || "
             f"cast({cat} as string)")
    return (f"case when {cat} % 11 = 3 then null when {cat} % 13 = 7 then 'nan' "
            f"when {cat} % 7 = 5 then 'Solo ' || {_pick(cat, _MAKERS)} || ' ' || cast({k} as string) "
            f"else {title} end")


LISTING = f"""
select k, run_id, cat, style, 'sheets/' || run_id || '.csv' as source_file,
  cast(k + 2 as int) as row_number,
  case when k % 5 = 0 then 'Supplier ' || cast(cat % 9 as string)
       when k % 5 = 1 then ' nan ' else null end as c_supplier,
  {catalogue_text('cat', 'k')} as c_catalogue,
  case when cat % 3 = 1 and cat % 7 <> 5 then 'GRP-' || cast(cat as string) end as c_group,
  case when cat % 4 = 2 then null else 'Item ' || {_pick('cat', _LINES)} || ' ' || lower(p_type) end as c_product,
  {_pick('cat', [None, *_MAKERS])} as c_brand,
  case when k % 9 = 0 then null else p_type end as c_type,
  case when k % 17 = 3 then 'NaN' when k % 10 = 7 then '  '
       when cat % 2 = 0 then 'AM-' || lpad(cast(cat % 50 as string), 4, '0')
       else 'SKU' || cast(k as string) end as c_sku,
  case k % 8 when 0 then '₹ ' || price when 1 then 'Rs. ' || price when 3 then '-50'
       when 4 then 'N/A' when 5 then null when 6 then '1,' || price || '/-' else price end as c_price,
  case k % 7 when 2 then 'INR 700' when 4 then 'none' when 5 then price else null end as c_wholesale,
  case k % 6 when 0 then '5%' when 1 then '12 %' when 2 then '5' when 3 then '120%' when 4 then '' else null end as c_gst,
  case k % 5 when 0 then '2 Pcs' when 1 then '6' when 2 then null when 3 then '0' else 'abc' end as c_moq,
  case when k % 6 = 5 then null else 'Shade ' || {_pick('k', _SHADES)} end as c_vname,
  {_pick('k', _SHADES)} as c_color,
  case when k % 4 = 1 then '5.5 m' else null end as c_size,
  {_pick('cat', _FABRICS)} as c_fabric,
  case when k % 3 = 0 then 'Banglori Silk' end as c_blouse,
  {_pick('cat', _WORKS)} as c_work,
  case cat % 6 when 0 then '₹8490 (6 Pcs)' when 1 then '4 Designs' when 2 then 'Pack of 3'
       when 3 then '5' when 4 then null else '1 Pc' end as c_count,
  case k % 7 when 0 then '0' when 1 then '-1' when 2 then null else cast(k % 40 as string) end as c_stock,
  case k % 6 when 0 then '2,999' when 1 then '-10' when 2 then '1499.50' else null end as c_sprice,
  case when k % 13 = 5 then 'D' || cast(k - 1 as string) when k % 9 = 4 then null
       else 'D' || cast(k as string) end as c_image_sku,
  case when k % 4 = 0 then 'https://cdn.example.com/u' || cast(k as string) || '.jpg'
       when k % 4 = 1 then 'https://x.blob.example.com/b' || cast(k as string) || '.png'
       when k % 4 = 2 then 'local/u' || cast(k as string) || '.jpg' end as c_image_url,
  case when k % 3 = 0 then 'https://x.blob.example.com/g' || cast(k as string) || '.png'
       when k % 3 = 1 then 'https://cdn.example.com/u' || cast(k as string) || '.jpg' end as c_img1,
  case when k % 2 = 0 then 'https://x.blob.example.com/g' || cast(k as string) || '.png' end as c_img2,
  case when cat % 5 = 3 then 'B' || cast(k as string) when k % 19 = 4 then 'b' || cast(k - 1 as string) end as c_vcode,
  case when k % 6 = 1 then 'Soft drape, long written supplier text.' when k % 6 = 2 then 'Short' end as c_desc,
  case when k % 4 = 3 then 'Surat' end as c_dispatch,
  case when k % 2 = 0 then 'India' else '' end as c_origin
from (select p_partkey as k, p_type, {run_columns('p_partkey')},
        cast(cast(p_retailprice as decimal(12,2)) as string) as price
      from {{part}}) p
"""

# field of the listing -> header in each of the four sheet styles
HEADERS: dict[str, list[str | None]] = {
    "c_supplier": ["Supplier Name", "Vendor", None, "Manufacturer"],
    "c_catalogue": ["Catalogue Name", "Collection", "Catalog-Name", "catalog"],
    "c_group": ["Product Group", "Series", "Group", None],
    "c_product": ["Product Name", "Product Title", "Title", "Item Name"],
    "c_brand": ["Brand Name", "Brand", "brand.name", "Brand Title"],
    "c_type": ["Product Type", "Category", "Type", "Item Type"],
    "c_sku": ["Supplier SKU", "Item Code", "SKU", "Style Code"],
    "c_price": ["Supplier Price", "Unit Price", "Single Piece Price", "Cost"],
    "c_wholesale": ["Wholesale Price", "Single Price", "wholesale_per_unit_price", "WS Price"],
    "c_gst": ["GST", "Tax Rate", "gst-percent", "VAT"],
    "c_moq": ["MOQ", "Min Order Qty", "Minimum Order Qty", "Pack Size"],
    "c_vname": ["Varient Name", "Option", "Variant", "Design"],
    "c_color": ["Colour", "Shade", "Color", " COLOR "],
    "c_size": ["Size", "Size", "Dimensions", "Length"],
    "c_fabric": ["Saree Fabric", "Fabric Composition", "Fabric", "Material"],
    "c_blouse": ["Blouse Fabric", None, "Blouse Material", None],
    "c_work": ["Work/Print Type", "Work", "Work", "Work"],
    "c_count": ["Total Designs", "Designs-Count", "Full Catalogue", "total_pieces"],
    "c_stock": ["Stock", "Stock", "Qty", "Inventory"],
    "c_sprice": ["Selling Proce", "MRP", "Retail Price", "Selling Price"],
    "c_image_sku": ["Image-SKU", "Image SKU", "Design Code", None],
    "c_image_url": ["Image URL", None, "Main Image URL", None],
    "c_img1": ["image1_url", None, "image1_url", None],
    "c_img2": ["image2_url", None, "Image2 URL", None],
    "c_vcode": [None, "Variant Code", None, "Barcode"],
    "c_desc": ["Description", "Details", "Product Description", "Summary"],
    "c_dispatch": ["Dispatch Location", "Warehouse", "Dispatch From", "Warehouse"],
    "c_origin": ["Country of Origin", "Origin", "Origin", "Brand-Title"],
}

_IMAGE_DIR = f"coalesce({catalogue_text('cat', 'k')}, 'loose')"

# One image per order: exact codes, suffixes, folders, shared SKUs, junk.
IMAGES = f"""
select run_id, source_identity, relative_path, min(image_ord) as image_ord, min(file_size_bytes) as file_size_bytes
from (select o as image_ord, run_id,
  'archive/' || run_id || '.zip' as source_identity,
  case kind
    when 0 then 'all/D' || cast(k as string) || '.jpg'
    when 1 then 'all/D' || cast(k as string) || '-' || cast(o % 23 as string) || '.PNG'
    when 2 then 'all/D' || cast(k as string) || '_front ' || cast(o as string) || '.jpeg'
    when 3 then {_IMAGE_DIR} || '/' || coalesce({_pick('k', _SHADES)}, 'plain') || ' ' || cast(o as string) || 'x.jpg'
    when 4 then 'GRP-' || cast(cat as string) || '/photo_' || cast(o % 9 as string) || '.png'
    when 5 then {_IMAGE_DIR} || '/N-' || lpad(cast(o % 6 + 1 as string), 3, '0') || '.webp'
    when 6 then 'sku/AM-' || lpad(cast(cat % 50 as string), 4, '0') || '_' || cast(o % 7 as string) || '.jpg'
    when 7 then 'misc/IMG ' || cast(o as string) || 'q.jpg'
    when 8 then 'web/u' || cast(k as string) || '.jpg'
    when 9 then 'sku/SKU' || cast(k as string) || '.jpg'
    else 'notes/readme' || cast(o as string) || '.txt' end as relative_path,
  cast(1000 + o % 977 as bigint) as file_size_bytes
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')}, o_orderkey % 11 as kind
      from {{orders}}) i) f
group by run_id, source_identity, relative_path
"""

# One text slip per order; the file name ties it to the image of the order.
SLIPS = f"""
select o as doc_id, run_id,
  case when o % 11 = 7 then 'IMG ' || cast(o as string) || 'q.jpg'
       when o % 11 = 3 then coalesce({_pick('k', _SHADES)}, 'plain') || ' ' || cast(o as string) || 'x.jpg'
       when o % 11 = 0 then 'D' || cast(k as string) || '.jpg'
       else 'slip' || cast(o as string) || '.jpg' end as filename,
  case when o % 37 = 5 then '' when o % 41 = 6 then 'no labels here, only words' else
    'Catalogue: ' || coalesce({_pick('cat', _MAKERS)}, 'x') || ' ' || {_pick('cat', _LINES)} || chr(10) ||
    'Brand - ' || {_pick('cat', _MAKERS)} || chr(10) ||
    case when o % 3 = 0 then 'SKU: SKU' || cast(k as string) || chr(10) else '' end ||
    case when o % 4 = 1 then 'Design No. D' || cast(k as string) || chr(10) else '' end ||
    case when o % 5 = 2 then 'Colour: ' || coalesce({_pick('k', _SHADES)}, 'Ecru') || chr(10) else '' end ||
    case when o % 6 = 4 then 'soft modal satin drape' || chr(10) else 'Fabric: Art Silk' || chr(10) end ||
    case o % 3 when 0 then 'Wholesale Per Unit Price - 2' || unit || chr(10) || 'Single Piece - 2' || single || chr(10)
               when 1 then 'Wholesale - Rs. ' || unit || chr(10) || 'Price: ' || unit || chr(10)
               else 'Rate: #' || unit || '/-' || chr(10) end ||
    case when o % 2 = 0 then 'Full Catalogue - 2' || total || ' (6 Pcs)' || chr(10) else '' end ||
    case when o % 7 = 0 then '6 Pes x 2' || unit || ' = #' || total || chr(10) else '' end ||
    case when o % 5 = 0 then 'dropship #' || single || ' only' || chr(10) else '' end ||
    'GST: ' || cast(o % 4 * 6 as string) || '%' || chr(10) ||
    case when o % 3 = 0 then 'Total Designs: 6 Pcs' || chr(10) else '' end ||
    chr(10) || 'Weight = 0.6 KG per pc' || chr(10) || '  (' || cast(o % 9 as string) || ' KG total)' || chr(10) ||
    chr(10) || 'thank you' end as text,
  case when o % 29 = 3 then 'FAILED' when o % 37 = 5 then 'NO_TEXT_FOUND' else 'SUCCESS' end as status,
  'reader' || cast(o % 2 as string) as provider,
  cast(o % 40 + 60 as double) / 100 as confidence
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')},
        cast(1000 + o_custkey % 900 as string) as unit,
        cast(1100 + o_custkey % 900 as string) as single,
        cast(6000 + 6 * (o_custkey % 900) as string) as total
      from {{orders}}) s
"""

# What was read from the slips, for matching.
SLIP_FACTS = f"""
select run_id, doc_id, filename, 1 as fact_ord, 'sku' as field, ' SKU' || cast(k as string) as value from (SLIP_BASE) a
union all
select run_id, doc_id, filename, 2 as fact_ord, 'design_number' as field, 'd' || cast(k + o % 2 as string) as value from (SLIP_BASE) b
union all
select run_id, doc_id, filename, 3 as fact_ord, 'color' as field, 'Shade ' || {_pick('k', _SHADES)} as value from (SLIP_BASE) c
""".replace("SLIP_BASE", f"""
select o as doc_id, k, o, run_id,
  case when o % 11 = 7 then 'IMG ' || cast(o as string) || 'q.jpg'
       when o % 11 = 3 then coalesce({_pick('k', _SHADES)}, 'plain') || ' ' || cast(o as string) || 'x.jpg'
       when o % 11 = 5 then 'N-00' || cast(o % 6 + 1 as string) || '.webp'
       else 'slip' || cast(o as string) || '.jpg' end as filename
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')} from {{orders}}) s""")

# Two review events per image, in event order.
DECISIONS = """
select event_id as decision_ord, cast(floor(event_id / 2) as bigint) as image_ord,
  case event_type when 'purchase' then 'approve' when 'error' then 'reject'
       when 'signup' then 'reassign' else 'none' end as action,
  'user' || cast(user_id as string) as reviewer,
  case when event_type = 'signup' then 'D' || cast(user_id as string) end as new_variant_code,
  case when event_type = 'purchase' and event_id % 3 = 0 then 'IS-' || cast(event_id as string) end as image_sku,
  case when event_type = 'purchase' and event_id % 4 = 0 then 'Teal' end as detected_color,
  case when event_type = 'error' and event_id % 2 = 0 then 'blurred' when event_type = 'purchase' and event_id % 5 = 0 then 'looks right' end as reason,
  't' || cast(event_id as string) as decided_at
from {events}
"""

# One pixel per order line; eight neighbouring orders make one image.
PIXELS = """
select 'run-' || cast(img % 7 as string) as run_id, img as image_id,
  case when img % 50 = 0 then 8 when img % 3 = 0 then 200 else 90 end as width,
  case when img % 50 = 0 then 8 when img % 3 = 0 then 160 else 80 end as height,
  cast((l_partkey * 7 + l_linenumber) % (case when img % 3 = 0 then 200 else 90 end) as int) as x,
  cast((l_suppkey * 13 + l_linenumber * 5 + l_partkey) % (case when img % 3 = 0 then 160 else 80 end) as int) as y,
  cast(case when img % 5 = 0 then 250 when img % 5 = 1 then (img * 37 + l_linenumber) % 256
       when img % 5 = 2 then l_partkey % 256 when img % 5 = 3 then 110 + img % 9 else img * 11 % 256 end as int) as r,
  cast(case when img % 5 = 0 then 250 when img % 5 = 1 then img * 91 % 256
       when img % 5 = 2 then l_suppkey % 256 when img % 5 = 3 then 110 + img % 9 else (img * 5 + l_partkey % 6) % 256 end as int) as g,
  cast(case when img % 5 = 0 then 249 when img % 5 = 1 then img * 17 % 200
       when img % 5 = 2 then (l_partkey + l_suppkey) % 256 when img % 5 = 3 then 110 + img % 9 else img * 3 % 256 end as int) as b
from (select l.*, cast(floor(l_orderkey / 8) as bigint) as img from {lineitem} l) p
"""

# Word boxes: one per order line, of the slip with the same order key.
WORDS = f"""
select s.run_id, l_orderkey as doc_id, case when l_linenumber = 4 then '  ' else 'w' || cast(l_partkey as string) end as word,
  case when l_partkey % 11 = 0 then -1.0 else l_quantity * 2 end as conf
from {{lineitem}} join (select run_id, doc_id from ({SLIPS})) s on s.doc_id = l_orderkey
"""

# Payloads to host: exact text copies reuse a key, other texts collide.
BLOBS = """
select * from (
  select doc_id as ord, source as supplier_name, 'Cat ' || lang as catalog_name,
    'V ' || cast(n_chars % 40 as string) || '/' || lang as variant_code,
    'My Image (' || cast(n_chars % 7 as string) || ') copy' ||
      case doc_id % 5 when 0 then '.PNG' when 1 then '.jpg' when 2 then '.webp' when 3 then '.bin' else '.jpeg' end as filename,
    text as content
  from {documents}
  union all
  select 2000000000 + doc_id as ord, source as supplier_name, 'Cat ' || lang as catalog_name, 'L' || cast(doc_id % 30 as string) as variant_code,
    'lang.bin' as filename, lang as content
  from {documents}
  union all
  select 1000000000 + page_id as ord, 'Page Co, Surat' as supplier_name, 'Pages #1' as catalog_name,
    'P' || cast(page_id % 30 as string) as variant_code, 'page.png' as filename,
    html as content
  from {pages}) b
"""

# Attribute files: one two-column file per supplier.
ATTRIBUTE_FILES = """
select s_suppkey, 'attr/' || cast(s_suppkey as string) || '.tsv' as source_file, line + 1 as row_number,
  case line when 1 then 'Supplier Name' when 2 then ' Catalogue Name' when 3 then 'Brand Name'
    when 4 then case when s_suppkey % 13 = 0 then 'SKU' else 'Supplier SKU' end
    when 5 then 'Product Type' when 6 then 'Supplier Price' when 7 then 'GST Percent'
    when 8 then case when s_suppkey % 7 = 0 then 'Brand Name' else 'MOQ' end
    when 9 then ' ' else 'Design Count' end as key,
  case line when 1 then s_name when 2 then 'Cat ' || cast(s_nationkey as string) when 3 then 'B' || cast(s_suppkey as string)
    when 4 then 'S' || cast(s_suppkey as string) when 5 then 'Saree'
    when 6 then case when s_suppkey % 5 = 0 then 'call us' else cast(cast(s_acctbal as decimal(12,2)) as string) end
    when 7 then '5' when 8 then '1' when 9 then 'x' else '' end as value
from (select s_suppkey, s_name, s_nationkey, s_acctbal, {LINES} as line from {supplier}) s
"""

# Batch manifests: one entry per order.
BATCH = f"""
select run_id as batch_name, o as entry_no,
  case o % 17 when 0 then '<name>' when 1 then ' ' when 2 then '[x' else 'Cat ' || cast(o % 9000 as string) end as name,
  case o % 7 when 0 then 'amra-wholesale' when 1 then 'Generic' when 2 then '' when 3 then 'unknown' else 'amra' end as supplier_adapter,
  case o % 10 when 0 then '' when 1 then 'in/' || cast(o as string) || '.doc' else 'in/' || cast(o as string) || '.CSV' end as source,
  case when o % 6 = 0 then 'img/' || cast(o % 100 as string) when o % 6 = 1 then null else '' end as images
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')} from {{orders}}) b
"""
# Paths that exist for the batch manifests.
BATCH_PATHS = """
select case when o_orderkey % 3 = 0 then 'img/' || cast(o_orderkey % 100 as string)
            when o_orderkey % 13 = 1 then 'elsewhere'
            when o_orderkey % 10 = 1 then 'in/' || cast(o_orderkey as string) || '.doc'
            else 'in/' || cast(o_orderkey as string) || '.CSV' end as path
from {orders} group by 1
"""

# Import tables of 26 columns, some rows blank, some sources empty or misnamed.
IMPORT_SOURCES = """
select 'cat-' || cast(cast(floor(p_partkey / 25) as bigint) as string) as source, cast(p_partkey as int) as row_number,
  case when p_partkey % 25 = 24 or floor(p_partkey / 25) % 20 = 7 then true else false end as blank_row,
  p_name as product_name, cast(cast(p_retailprice as decimal(12,2)) as string) as supplier_price,
  cast(p_partkey % 5 + 1 as string) as no
from {part}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are split.

    A caller whose tables are one small file each may set ``sheetloom.spread``
    to a number of partitions; nothing is shuffled unless it is set.
    """
    broadcast_by_measure(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    spread = spark.conf.get("sheetloom.spread", None)
    return df.repartition(int(spread)) if spread else df


def dealt(spark: SparkSession, df: DataFrame, key: str) -> DataFrame:
    """Rows of few bytes that become long ones, dealt over all cores before: their file may be one partition."""
    return df.repartition(2 * spark.sparkContext.defaultParallelism, key)


def bind(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    sql = sql.replace("{LINES}", "explode(array(1, 2, 3, 4, 5, 6, 7, 8, 9, 10))")
    names = [n for n in ("part", "orders", "lineitem", "events", "documents", "pages", "supplier")
             if "{" + n + "}" in sql]
    given = {n: table(spark, sf_dir, n) for n in names}
    if SLIPS in sql and "lineitem" not in given:  # a slip's text is made of two numbers, and dear to read
        given["orders"] = dealt(spark, given["orders"].select("o_orderkey", "o_custkey"), "o_orderkey")
    return spark.sql(sql, **given)


def oracle_text(sql: str) -> str:
    sql = sql.replace("{LINES}", "unnest([1, 2, 3, 4, 5, 6, 7, 8, 9, 10])")
    for n in ("part", "orders", "lineitem", "events", "documents", "pages", "supplier"):
        sql = sql.replace("{" + n + "}", n)
    return sql


def _literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def sheet_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing as raw sheet rows: headers and cells of each row, in order.

    A few bytes of the table become a row of a kilobyte, so one file's rows are dealt over all cores before.
    """
    part = dealt(spark, table(spark, sf_dir, "part"), "p_partkey")
    listing = spark.sql(LISTING, part=part)

    def by_style(build) -> Column:
        out = F.when(F.col("style") == 0, build(0))
        for s in (1, 2):
            out = out.when(F.col("style") == s, build(s))
        return out.otherwise(build(3))

    def cells(s: int) -> Column:
        return F.array(*[F.nullif(F.col(c), F.lit("")) for c, h in HEADERS.items() if h[s]])

    def headers(s: int) -> list[str]:
        return [h[s] for h in HEADERS.values() if h[s]]

    return listing.select(
        "run_id", "source_file", "row_number",
        by_style(lambda s: _literal_array(headers(s))).alias("headers"),
        by_style(lambda s: _literal_array(effective_keys([header_key_text(h) for h in headers(s)]))).alias("keys"),
        by_style(cells).alias("cells"),
    )


# Products and variants with every kind of damage, and products without variants.
DQ_PRODUCTS = f"""
select run_id, cat as product_ord, 'P' || cast(cat as string) as product_id,
  case when cat % 31 = 4 then ' ' else 'Name ' || cast(cat as string) end as product_name,
  case when cat % 37 = 5 then '' else 'Cat ' || cast(cat as string) end as catalog_name,
  case when cat % 29 = 6 then '  ' else 'Sup ' || cast(cat % 9 as string) end as supplier_name,
  case when cat % 5 = 1 then null when cat % 7 = 2 then -50.0 else 400.0 + cat end as supplier_price,
  case cat % 6 when 0 then 5.0 when 1 then 120.0 when 2 then -1.0 when 3 then 100.0 when 4 then 0.0 else null end as gst_percent,
  case cat % 5 when 0 then 'sarees' when 1 then 'Kurti Set' when 2 then 'UPPER' when 3 then ' ok-slug_2 ' else null end as category_slug,
  cast(case cat % 4 when 0 then 0 when 1 then 1 when 2 then null else -3 end as int) as moq
from (select {run_columns('p_partkey')} from {{part}}) p
group by run_id, cat
union all
select 'run-' || lpad(cast(s_nationkey as string), 6, '0') as run_id, 900000000 + s_suppkey as product_ord,
  'S' || cast(s_suppkey as string) as product_id, s_name as product_name, s_name as catalog_name,
  s_name as supplier_name, 1.0 as supplier_price, 5.0 as gst_percent, 'sarees' as category_slug, 1 as moq
from {{supplier}}
"""
DQ_VARIANTS = f"""
select run_id, cat as product_ord, 'P' || cast(cat as string) as product_id, cast(k % 4 + 1 as int) as variant_ord,
  case when k % 23 = 1 then ' ' when k % 19 = 2 then 'v' || cast(k - 1 as string) else 'V' || cast(k as string) end as variant_code,
  case when k % 17 = 3 then '' when k % 10 = 7 then null when cat % 2 = 0 then 'AM-' || cast(cat % 50 as string)
       else 'SKU' || cast(k as string) end as supplier_sku,
  case when k % 27 = 5 then '  ' else 'Variant ' || cast(k as string) end as variant_name,
  cast(case k % 7 when 0 then 0 when 1 then -1 when 2 then null else k % 40 end as int) as stock_quantity,
  case k % 9 when 0 then -5.0 when 1 then null else 100.0 + k end as supplier_cost,
  case k % 6 when 0 then 2999.0 when 1 then -10.0 when 2 then 1499.5 else null end as selling_price,
  k % 5 = 0 as publish,
  case k % 4 when 0 then 'https://a/u' || cast(k as string) when 1 then '' when 2 then null else 'https://a/g' || cast(k as string) end as primary_image_url,
  case when k % 3 = 0 then 'https://a/u' || cast(k as string) when k % 3 = 1 then 'https://a/g' || cast(k as string) end as g1,
  case when k % 2 = 0 then 'https://a/g' || cast(k as string) end as g2,
  case when k % 4 = 0 then 'https://a/g' || cast(k as string) end as g3
from (select p_partkey as k, {run_columns('p_partkey')} from {{part}}) p
"""
# Runs that were started, some of which gave no product.
RUNS = f"""
select run_id, count(*) as source_rows from (
  select {run_columns('p_partkey')} from {{part}}
  union all select 0 as cat, 'run-' || lpad(cast(s_nationkey as string), 6, '0') as run_id, 0 as style from {{supplier}}
  union all select 0 as cat, 'run-none-' || cast(s_nationkey as string) as run_id, 0 as style from {{supplier}}) r
group by run_id
"""

# The older 21-column table.
LEGACY = f"""
select run_id, cast(k + 2 as int) as row_number,
  case when k % 13 = 2 then ' ' else 'Sup ' || cast(cat % 9 as string) end as supplier_name,
  'Cat ' || cast(cat as string) as catalog_name,
  case when k % 3 = 0 then '' else 'Item ' || cast(k as string) end as product_name,
  case when k % 17 = 3 then null when k % 17 = 4 then 'NaN' when k % 5 = 1 then 'am-' || cast(k - 1 as string)
       else 'AM-' || cast(k as string) end as supplier_sku,
  case when k % 11 = 0 then null else 'Saree' end as product_type,
  case when k % 7 = 0 then null else 'B' end as brand_name,
  case when k % 6 = 0 then '' else 'Silk' end as fabric, case when k % 9 = 0 then null else 'Zari' end as work,
  case k % 8 when 0 then 'free' when 1 then '0' when 2 then '-4' when 3 then null else cast(k as string) end as supplier_price,
  case k % 6 when 0 then '101' when 1 then 'five' when 2 then '-1' when 3 then ' ' else '5' end as gst_percent,
  case when k % 2 = 0 then 'text' else ' ' end as description, case when k % 5 = 0 then '99' end as selling_proce,
  case when k % 4 = 0 then 'D' || cast(k as string) else '' end as image_sku, cast(null as string) as image_url,
  case k % 7 when 0 then 'True' when 1 then ' no ' when 2 then '0' when 3 then '' when 4 then 'yes' else 'false' end as publish
from (select p_partkey as k, {run_columns('p_partkey')} from {{part}}) p
"""


def dq_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bind(spark, sf_dir, DQ_PRODUCTS)


def dq_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    gallery = F.array_compact(F.array("g1", "g2", "g3"))
    return bind(spark, sf_dir, DQ_VARIANTS).withColumn("gallery_image_urls", gallery).drop("g1", "g2", "g3")


# Review manifest: about ten images per variant code, some stale, some unknown.
MANIFEST = f"""
select run_id, o as manifest_ord, 'img_' || cast(o as string) as image_id, filename as original_filename,
  'all/' || filename as image_path, 'Cat ' || cast(cat as string) as catalog_name, 'D' || cast(k as string) as matched_code,
  case when o % 9 = 4 then null when o % 23 = 5 then 'GHOST' || cast(k as string) else 'D' || cast(k as string) end as proposed_variant_code,
  case o % 5 when 0 then 'AMBIGUOUS' when 1 then 'UNMATCHED' else 'MATCHED' end as match_status,
  case when k % 3 = 0 then 'PENDING' when k % 3 = 1 then case when o % 6 = 0 then 'APPROVED' when o % 6 = 1 then 'REJECTED' else 'PENDING' end
       when o % 7 < 2 then 'APPROVED' else 'REJECTED' end as approval_status,
  case when o % 4 = 1 then 'OTHER' when o % 9 = 4 then 'UNASSIGNED' when o % 23 = 5 then 'GHOST' || cast(k as string)
       else 'D' || cast(k as string) end as hash_code,
  'user' || cast(o % 5 as string) as approved_by, '2024-01-0' || cast(o % 9 + 1 as string) as approved_at,
  case o % 6 when 0 then 'IS' || cast(k as string) when 1 then ' ' end as image_sku,
  case when o % 5 > 1 then 'EXACT_IMAGE_SKU' end as match_strategy, cast(o % 5 as double) / 4 as confidence,
  case when o % 3 = 0 then 'found by name ' || cast(o % 10 as string) end as notes,
  case when o % 5 = 2 then {_pick('k', _SHADES)} end as detected_color,
  case when o % 8 = 3 then 0.7 end as evidence_confidence,
  case when o % 3 = 1 then 'UNCERTAIN' end as evidence_status,
  case when o % 4 = 0 then 'manual' end as ocr_provider, case when o % 4 = 0 then 'SKU' || cast(k + o % 2 as string) end as ocr_sku,
  case when o % 8 = 0 then 'Teal' end as ocr_color, case when o % 16 = 0 then 'D' || cast(o % 7 as string) end as ocr_design,
  case when o % 12 = 0 then 'Silk' end as ocr_fabric, case when o % 4 = 0 then cast(o % 9 as double) / 8 end as ocr_confidence
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')},
  case when o_orderkey % 11 = 7 then 'IMG ' || cast(o_orderkey as string) || 'q.jpg'
       when o_orderkey % 11 = 0 then 'D' || cast(o_custkey as string) || '.jpg'
       else 'slip' || cast(o_orderkey as string) || '.jpg' end as filename from {{orders}}) m
"""
# Colour result per image.
COLOURS = f"""
select run_id, 'img_' || cast(o as string) as image_id,
  case o % 4 when 0 then 'EXTRACTED' when 1 then 'UNCERTAIN' when 2 then 'EXTRACTED' else 'BACKGROUND_ONLY' end as status,
  case when o % 2 = 0 then coalesce({_pick('k', _SHADES)}, 'Grey') end as canonical_color,
  cast(o % 50 + 50 as double) / 100 as confidence, case when o % 2 = 0 then '#0a0b0c' end as hex_code,
  o % 4 in (1, 3) as is_ambiguous, case when o % 4 = 1 then 'Multi-tonal image' end as notes
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')} from {{orders}}) c
"""
# Validation findings that name a variant code or only a SKU.
ISSUES = f"""
select run_id, case k % 4 when 0 then 'ERROR' when 1 then 'WARNING' when 2 then 'INFO' else 'ERROR' end as severity,
  'C' || cast(k % 7 as string) as code, 'text ' || cast(k as string) as message,
  case when k % 5 = 2 then null else 'D' || cast(k as string) end as variant_code, 'SKU' || cast(k as string) as supplier_sku
from (select p_partkey as k, {run_columns('p_partkey')} from {{part}}) i
"""
# Outcome of uploads per variant and image place.
UPLOADS = f"""
select run_id, 'D' || cast(k as string) as variant_code, o as sort_index, o % 10 = 0 as is_primary,
  case o % 6 when 0 then 'SKIPPED' when 1 then 'FAILED' when 2 then 'COLLISION' else 'UPLOADED' end as status,
  case when o % 6 > 2 then 'https://x.blob.example.com/' || cast(o as string) || '.jpg' end as blob_url
from (select o_orderkey as o, o_custkey as k, {run_columns('o_custkey')} from {{orders}}) u
"""


# Canonical rows of three datasets with a few conflicting identities.
DATASETS = f"""
select cast(k % 3 as int) as dataset_ord, run_id, 'P' || cast(cat as string) as product_id,
  case when k % 50 = 3 then 'Other ' || cast(cat as string) else 'Cat ' || cast(cat as string) end as catalog_name,
  case when k % 40 = 15 then 'V' || cast(k - 10 as string) when k % 30 = 4 then '' else 'V' || cast(k as string) end as variant_code,
  case when k % 7 = 0 then '' else 'Variant ' || cast(k as string) end as variant_name, cast(k as int) as row_number,
  case when k % 9 = 0 then null else 'P' || cast(cat as string) end as given_product_id
from (select p_partkey as k, {run_columns('p_partkey')} from {{part}}) d
"""

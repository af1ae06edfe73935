from pyspark.sql import functions as F

from sheetloom import fixed_values as fv
from sheetloom.operators import normalize as n
from sheetloom.operators import quality
from sheetloom.sources import delimited


def sheets(spark, tmp_path, **texts):
    for name, text in texts.items():
        suffix = "tsv" if "\t" in text else "csv"
        (tmp_path / f"{name}.{suffix}").write_text(text, encoding="utf-8")
    rows = delimited.scan(spark, str(tmp_path), F.regexp_extract("source_file", r"([^/]+)\.[a-z]+$", 1))
    return rows


APPAREL = """Item Code,Product Title,Collection,Brand,Category,Wholesale Price,Tax Rate,Shade,Size,Fabric Composition,Sleeve Type
WV-KUR-101,Aura Kurti,Aura Summer 2026,Weave,Kurti,420,5%,Rose,S,Cotton,Full
WV-KUR-101,Aura Kurti,Aura Summer 2026,Weave,Kurti,420,5%,Sky,M,Cotton,Half

WV-KUR-101,Aura Kurti,Aura Summer 2026,Weave,Kurti,420,5%,"Sand, light",L,Cotton,Half
"""
WHOLESALE = "\t".join(["Catalogue Name", "Product Group", "Supplier SKU", "Image SKU", "Varient Name", "Color", "Fabric", "Supplier Price"]) + "\n" + \
    "\n".join("\t".join(["Noor", "GRP", "AM-18001", sku, name, "x", "Silk", "₹ 780"]) for sku, name in (
        ("S-1", "Red"), ("S-2", "Blue"), ("s-1", "Green")))
SINGLE = """Catalogue Name,Dispatch Location,Supplier SKU,Supplier Price,GST,Total Designs,design_count
RAJTEX AJRAKH VOL 58,Surat,,₹ 680,(5%),6 Pcs,6
"""


def test_generic_sheet(spark, tmp_path):
    products, variants = n.normalise(sheets(spark, tmp_path, apparel=APPAREL))
    p = products.collect()
    assert len(p) == 1 and p[0].profile == fv.GENERIC
    assert (p[0].catalog_name, p[0].category_slug, p[0].supplier_price, p[0].gst_percent) == ("Aura Summer 2026", "kurti", 420.0, 5.0)
    assert p[0].attributes["Sleeve Type"] == "Full" and p[0].attributes["size"] == "S"
    v = variants.orderBy("variant_ord").collect()
    assert [x.variant_code for x in v] == ["WV-KUR-101-V01", "WV-KUR-101-V02", "WV-KUR-101-V03"]
    assert [x.variant_name for x in v] == ["Rose", "Sky", "Sand, light"]
    assert [x.row_number for x in v] == [2, 3, 4]
    assert all(x.selling_price is None and x.supplier_cost == 420.0 for x in v)


def test_wholesale_sheet_repeats_image_sku(spark, tmp_path):
    products, variants = n.normalise(sheets(spark, tmp_path, noor=WHOLESALE))
    assert [x.profile for x in products.collect()] == [fv.WHOLESALE]
    v = variants.orderBy("variant_ord").collect()
    assert [x.variant_code for x in v] == ["S-1", "S-2", "s-1-3"]
    assert [x.color for x in v] == ["Red", "Blue", "Green"]
    assert {x.supplier_sku for x in v} == {"AM-18001"}


def test_placeholders_are_not_invented(spark, tmp_path):
    _, variants = n.normalise(sheets(spark, tmp_path, single=SINGLE))
    v = variants.orderBy("variant_ord").collect()
    assert [x.variant_code for x in v] == [f"RAJTEX-AJRAKH-VOL-58-V0{i}" for i in range(1, 7)]
    assert [x.variant_name for x in v] == [f"Design 0{i}" for i in range(1, 7)]
    assert all(x.color is None and x.supplier_sku is None and x.selling_price is None and x.supplier_cost == 680.0 for x in v)


def test_large_declared_count_is_expanded_whole(spark):
    df = spark.createDataFrame([("a", 5000)], "id string, n int")
    got = n.expand(df, F.col("n"), "no").agg(F.count("no"), F.min("no"), F.max("no"), F.countDistinct("no")).first()
    assert tuple(got) == (5000, 1, 5000, 5000)


def test_last_equal_header_wins_and_unknown_choice_stops_a_run(spark, tmp_path):
    rows = sheets(spark, tmp_path, a="Collection,collection ,Title\nfirst,second,T\n", b="Title,Price\nX,1\n")
    assert {r.catalog_name for r in n.normalise(rows)[0].where("run_id = 'a'").collect()} == {"second"}
    chosen = spark.createDataFrame([("a", "Amra-Wholesale"), ("b", "who?")], "run_id string, spelling string")
    profiles = {r.run_id: r.profile for r in n.detect_profiles(rows, chosen).collect()}
    assert profiles == {"a": fv.WHOLESALE, "b": None}
    assert {r.run_id for r in n.normalise(rows, chosen)[0].collect()} == {"a"}


def test_attribute_file_and_empty_sources(spark, tmp_path):
    rows = sheets(spark, tmp_path, kv="Column\tValue\nBrand Name\tA\nBrand Name\tB\n\tskipped\nMOQ\t2\n")
    composite = delimited.attribute_rows(delimited.attributes_of(rows)).first()
    assert dict(zip(composite.headers, composite.cells)) == {"Brand Name": "B", "MOQ": "2"}
    files = spark.createDataFrame([("kv",), ("gone",)], "run_id string")
    assert [r.run_id for r in delimited.empty_sources(files, rows, "run_id").collect()] == ["gone"]


def test_one_bad_run_does_not_touch_the_others(spark, tmp_path):
    products, variants = n.normalise(sheets(spark, tmp_path, good=APPAREL, bad="Title,Stock,Cost\nX,-1,-50\n"))
    runs = products.select("run_id", F.lit(1).alias("source_rows")).distinct()
    report = {r.run_id: r for r in quality.validation_summary(
        runs, products, variants, quality.all_issues(products, variants, runs)).collect()}
    assert report["good"].is_valid and not report["bad"].is_valid
    assert report["bad"].error_count == 3  # price, cost, stock

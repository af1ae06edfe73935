from pyspark.sql import functions as F

from sheetloom.operators import exports
from sheetloom.operators import images as im
from sheetloom.sources import delimited, files


def test_folder(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    for name in ("img10.png", "a/img2.JPG", "a/b/x.webp", "a/data.csv"):
        (tmp_path / name).write_bytes(b"12345")
    listed = files.image_folder(spark, str(tmp_path))
    kept = im.inventory(listed)
    assert {(r.relative_path, r.file_extension) for r in kept.collect()} == {
        ("img10.png", ".png"), ("a/img2.JPG", ".jpg"), ("a/b/x.webp", ".webp")}
    assert [r.original_filename for r in im.ignored_files(listed).collect()] == ["data.csv"]


def test_delimiters_and_row_numbers_over_splits(spark, tmp_path):
    (tmp_path / "s.csv").write_text("A;B\n" + "".join(f"{i};x{i}\n" for i in range(2, 3000)))
    (tmp_path / "p.csv").write_text('A|"B|C"\n1|"q ""x"" | y"\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = delimited.scan(spark, str(tmp_path))
        big = rows.where(F.col("source_file").endswith("s.csv"))
        assert big.count() == 2998
        assert big.where(F.get("cells", F.lit(0)).cast("int") != F.col("row_number")).count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    small = rows.where(F.col("source_file").endswith("p.csv")).first()
    assert (small.headers, small.cells) == (["A", "B|C"], ["1", 'q "x" | y'])


def test_cells_over_several_lines_and_splits(spark, tmp_path):
    import csv
    import random

    rng = random.Random(5)
    bits = ["a", "b c", '"', ",", "\n", "\n\n", "5\" pipe", "", "é", "long " * 9, " "]
    wanted = [[("x" + "".join(rng.choices(bits, k=rng.randint(0, 6)))) if rng.random() < 0.8 else "" for _ in range(3)] + [str(i + 2)] for i in range(400)]
    (tmp_path / "in").mkdir()
    with open(tmp_path / "in" / "s.csv", "w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerow(["A", "B", "C\nD", "N"])
        for i, row in enumerate(wanted):
            csv.writer(f, lineterminator="\n", quoting=csv.QUOTE_ALL if i % 3 else csv.QUOTE_MINIMAL).writerow(row)
            f.write("  \n\t\n" if i % 50 == 0 else "")
    (tmp_path / "in" / "z.csv").write_text('A,B\n1,2\n3,5" x\n4,"open\n5,6\n')
    for size in ("4000b", "1g"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            rows = delimited.scan(spark, str(tmp_path / "in")).collect()
            rejects = delimited.scan_rejects(spark, str(tmp_path / "in")).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        got = sorted((r.row_number, [x or "" for x in r.cells]) for r in rows)
        assert {tuple(r.headers) for r in rows} == {("A", "B", "C\nD", "N")}
        assert got == [(i + 2, row) for i, row in enumerate(wanted)]
        assert [(r.source_file.rsplit("/", 1)[1], r.row_number, r.reason) for r in rejects] == [("z.csv", 4, "End of file inside a quoted cell")]


def test_folder_as_one_sheet_and_lines_of_tabs(spark, tmp_path):
    for name, text in (("a/p0.csv", "A,B\n1,2\n\t\n3,4\n"), ("a/p1.csv", '5,"6\n'), ("a/p2.csv", '7"\n8,9\n'), ("b/p0.csv", "A\tB\n1\t2\n\t\n3\t4\n")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    rows = delimited.scan(spark, str(tmp_path), folders=True).collect()
    got = {(r.source_file.rsplit("/", 2)[1], r.row_number): r.cells for r in rows}
    assert got == {("a", 2): ["1", "2"], ("a", 3): ["3", "4"], ("a", 4): ["5", "6\n7"], ("a", 5): ["8", "9"],
                   ("b", 2): ["1", "2"], ("b", 3): [None, None], ("b", 4): ["3", "4"]}


def test_hosted_galleries_in_blocks_and_the_store_import(spark, monkeypatch):
    from sheetloom.operators import run

    monkeypatch.setattr(run, "GALLERY_BLOCK", 3)
    variants = spark.createDataFrame(
        [("r", 1, 1, "V1", "https://old/p.jpg", ["https://old/g.jpg"], {"Fabric": "silk"}), ("r", 1, 2, "V2", None, ["https://old/g.jpg"], {})],
        "run_id string, product_ord bigint, variant_ord int, variant_code string, primary_image_url string, gallery_image_urls array<string>, attributes map<string,string>")
    uploads = spark.createDataFrame(
        [("r", "V1", f"https://x.blob/{i}.jpg", i, i == 0, "UPLOADED") for i in range(8)] + [("r", "V2", "https://x.blob/late.jpg", 4, False, "UPLOADED")],
        "run_id string, variant_code string, blob_url string, sort_index int, is_primary boolean, status string")
    galleries = run.hosted_galleries(uploads)
    blocks = {(r.variant_code, r.block): [u[-5] for u in r.urls] for r in galleries.where("variant_code = 'V1'").collect()}
    assert blocks == {("V1", 0): list("123"), ("V1", 1): list("456"), ("V1", 2): ["7"]}
    hosted = run.with_hosted(variants, uploads, galleries)
    got = {r.variant_code: (r.primary_image_url, len(r.gallery_image_urls)) for r in hosted.collect()}
    assert got == {"V1": ("https://x.blob/0.jpg", 3), "V2": (None, 1)}
    products = spark.createDataFrame([("r", 1, "s", "c", "n", {"work": "zari"})],
                                     "run_id string, product_ord bigint, supplier_name string, catalog_name string, product_name string, attributes map<string,string>")
    for name in ("product_group", "category_slug", "brand_name", "description"):
        products = products.withColumn(name, F.lit(None).cast("string"))
    products = products.withColumn("supplier_price", F.lit(1.0)).withColumn("gst_percent", F.lit(5.0))
    for name in ("variant_name", "supplier_sku", "image_sku", "size"):
        hosted = hosted.withColumn(name, F.lit(None).cast("string"))
    hosted = hosted.withColumn("supplier_cost", F.lit(None).cast("double")).withColumn("selling_price", F.lit(None).cast("double"))
    rows = {r.variant_ord: r for r in exports.store_import(products, hosted, uploads).collect()}
    assert (rows[1].main_image_url, rows[1].image_1_url, rows[1].fabric, rows[1].work) == ("https://x.blob/0.jpg", "https://x.blob/1.jpg", "silk", "zari")
    assert (rows[2].main_image_url, rows[2].image_1_url, rows[2].fabric) == ("https://x.blob/late.jpg", "", "")


def test_flat_files_with_different_columns(spark, tmp_path):
    from sheetloom.operators import merge
    from sheetloom.sources import flat

    (tmp_path / "a.csv").write_text('catalog_name,variant_code,image10_url,image2_url,Fabric,selling_price,attributes\n'
                                    'C,V1,u10,u2,"silk, ""soft""\nwarm",12.5,"{""Work"":""zari"",""Fabric"":""cotton""}"\nC,,,,,x,\n')
    (tmp_path / "b.csv").write_text("product_id;image1;Fabric;Fabric;description\nP;u1;a;b;'=1+1\n")
    back = flat.canonical_flat(spark, str(tmp_path))
    rows = {(r.source_file[-5], r.row_number): r for r in back.collect()}
    assert rows["a", 2].gallery_image_urls == ["u2", "u10"] and rows["a", 2].selling_price == 12.5
    assert rows["a", 2].attributes == {"Work": "zari", "Fabric": "cotton"}
    assert (rows["a", 3].gallery_image_urls, rows["a", 3].attributes, rows["a", 3].selling_price) == ([], {}, None)
    assert (rows["b", 2].gallery_image_urls, rows["b", 2].attributes["Fabric"], rows["b", 2].description) == (["u1"], "a", "=1+1")
    grouped = merge.regroup_flat(back).select("product_id", "variant_code", "variant_name").collect()
    assert sorted(map(tuple, grouped)) == [("C", "V1", "Standard"), ("C", "VAR-2", "Standard"), ("P", "VAR-1", "Standard")]


def test_broken_manifests_among_good_ones(spark, tmp_path):
    good = '{"manifest_version": "1.0",\n "run_id": "r", "entries": [{"manifest_ord": 3, "image_id": "i"}]}'
    for name, text in (("a.json", good), ("b.json", good[:-3]), ("c.json", "no json"), ("d.json", " \n")):
        (tmp_path / name).write_text(text)
    assert [(r.run_id, r.manifest_ord, r.image_id) for r in files.read_manifest(spark, str(tmp_path), whole=True).collect()] == [("r", 3, "i")]
    rejects = files.manifest_rejects(spark, str(tmp_path), whole=True).collect()
    assert sorted(r.source_file.rsplit("/", 1)[1] for r in rejects) == ["b.json", "c.json"]


def test_formula_safe_csv(spark, tmp_path):
    df = spark.createDataFrame([("=1+1", {"a": "b"}, 1.5), ("plain", None, None)], "t string, m map<string,string>, n double")
    safe = {r.n: r for r in exports.safe_table(df).collect()}
    assert safe[1.5].t == "'=1+1" and safe[1.5].m == '{"a":"b"}' and safe[None].t == "plain"


def _product(ord_):
    return ("r", ord_, f"p{ord_}", "s", "c", "n", None, 1.0)


def test_documents_with_many_images_and_without_variants(spark, tmp_path):
    products = spark.createDataFrame([_product(1), _product(2)], "run_id string, product_ord bigint, product_id string, supplier_name string, "
                                     "catalog_name string, product_name string, product_group string, supplier_price double")
    variants = spark.createDataFrame(
        [("r", 1, 1, "V1", None, "v", None, None, None, None, None, 1, False, "x", "u0", ["u1", "u0"], {"a": "b"})],
        "run_id string, product_ord bigint, variant_ord int, variant_code string, supplier_sku string, variant_name string, image_sku string, color string, "
        "size string, supplier_cost double, selling_price double, stock_quantity int, publish boolean, review_status string, primary_image_url string, "
        "gallery_image_urls array<string>, attributes map<string,string>")
    images = spark.range(1200).select(F.lit("r").alias("run_id"), F.lit(1).cast("long").alias("product_ord"), F.lit(1).alias("variant_ord"),
                                      F.col("id").cast("int").alias("sort_index"), F.concat(F.lit("i"), F.col("id").cast("string")).alias("image_id"),
                                      F.lit("f").alias("original_filename"), (F.col("id") == 0).alias("is_primary"))
    documents = exports.canonical_documents(products, variants, images)
    assert documents.where("product_ord = 2").count() == 1
    exports.write_canonical_json(documents, str(tmp_path / "d"))
    back = files.canonical_documents(spark, str(tmp_path / "d"))
    assert back.select("product_id").distinct().count() == 2
    rows = files.canonical_variants(back).collect()
    assert len(rows) == 1 and [i.sort_index for i in rows[0].images] == list(range(1200)) and rows[0].gallery_image_urls == ["u1"]


def test_gallery_keeps_what_the_hero_leaves(spark):
    variants = spark.createDataFrame([("r", "V", None, [])], "run_id string, variant_code string, primary_image_url string, gallery_image_urls array<string>")
    urls = ["https://h", "https://h", "https://a", "https://b", "https://c", "https://d", "https://e"]
    uploads = spark.createDataFrame([("r", "V", i, u) for i, u in enumerate(urls)], "run_id string, variant_code string, sort_index int, blob_url string")
    row = exports.with_hero(variants, uploads).first()
    assert row.hero_url == "https://h" and row.gallery == ["https://a", "https://b", "https://c", "https://d"]


def test_flat_table_keeps_a_long_gallery(spark):
    products = spark.createDataFrame([("r", 1, "s", "c", None, "n", None, None, None, None, 1.0, 5.0, {})],
                                     "run_id string, product_ord bigint, supplier_name string, catalog_name string, product_group string, product_name string, "
                                     "product_type string, category_slug string, brand_name string, description string, supplier_price double, gst_percent double, "
                                     "attributes map<string,string>")
    urls = [f"u{i}" for i in range(1, 7)]
    variants = spark.createDataFrame([("r", 1, 1, "V", "v", None, None, None, None, 1.0, None, 1, False, "x", "u0", urls, {})],
                                     "run_id string, product_ord bigint, variant_ord int, variant_code string, variant_name string, supplier_sku string, image_sku string, "
                                     "color string, size string, supplier_cost double, selling_price double, stock_quantity int, publish boolean, review_status string, "
                                     "primary_image_url string, gallery_image_urls array<string>, attributes map<string,string>")
    row = exports.canonical_flat(products, variants).first()
    assert row.gallery_image_urls == urls and row.image4_url == "u4"


def test_flat_table_has_a_slot_for_every_image_and_all_attributes(spark):
    products = spark.createDataFrame([("r", 1, "s", "c", None, "n", None, None, None, None, 1.0, 5.0, {"work": "Zari", "image2_url": "a", "image9_url": "b"})],
                                     "run_id string, product_ord bigint, supplier_name string, catalog_name string, product_group string, product_name string, "
                                     "product_type string, category_slug string, brand_name string, description string, supplier_price double, gst_percent double, "
                                     "attributes map<string,string>")
    urls = [f"u{i}" for i in range(1, 8)]
    variants = spark.createDataFrame([("r", 1, i, "V", "v", None, None, None, None, 1.0, None, 1, False, "x", "u0", g, a) for i, (g, a) in enumerate([(urls, None), (["u1"], {"work": "x", "fit": "y"})])],
                                     "run_id string, product_ord bigint, variant_ord int, variant_code string, variant_name string, supplier_sku string, image_sku string, "
                                     "color string, size string, supplier_cost double, selling_price double, stock_quantity int, publish boolean, review_status string, "
                                     "primary_image_url string, gallery_image_urls array<string>, attributes map<string,string>")
    long, short = exports.canonical_flat(products, variants).orderBy("variant_ord").collect()
    assert [long[f"image{i}_url"] for i in range(1, 8)] == urls and "image8_url" not in long.asDict()
    assert long.attributes == {"work": "Zari", "image9_url": "b"}
    assert short.image1_url == "u1" and short.image7_url is None
    assert short.attributes == {"work": "Zari", "image2_url": "a", "image9_url": "b", "fit": "y"}


def test_unnamed_columns_long_rows_and_lines_of_tabs(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Name,Note,,\nx,"a,""b""",7,\n\t\t\ny,b,,8\nz,1,2,3,4\n  \nlast,,,\n')
    (tmp_path / "b.tsv").write_text("A\tB\n1\t2\n\t\n3\t4\n")
    got = {(r.source_file.rsplit("/", 1)[1], r.row_number): r for r in delimited.scan(spark, str(tmp_path)).collect()}
    first = got["a.csv", 2]
    assert (first.headers, first.cells) == (["Name", "Note", "Unnamed: 2", "Unnamed: 3"], ["x", 'a,"b"', "7", None])
    assert [r.cells for (f, _), r in sorted(got.items()) if f == "b.tsv"] == [["1", "2"], [None, None], ["3", "4"]]
    assert [r.cells[0] for (f, _), r in sorted(got.items()) if f == "a.csv"] == ["x", "y", "last"]
    assert [r.reason for r in delimited.scan_rejects(spark, str(tmp_path)).collect()] == ["Expected 4 fields, saw 5"]

"""Images to variants: strict priorities, each a set of equi-joins.

Every image gets exactly one finding.  Inside a priority the first variant in
(product_ord, variant_ord) order wins.  Candidate keys are aggregated before a
join, so the right side of each join is unique on its key and no image is ever
paired with a whole group of variants.

images    run_id, image_id, relative_path, original_filename, normalized_stem, tokens
products  run_id, product_id, product_ord, product_group, catalog_name
variants  run_id, product_ord, variant_ord, variant_code, supplier_sku, variant_name, color, image_sku,
          primary_image_url
facts     run_id, image_id, fact_ord, field, value  (text read from the image)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sheetloom import fixed_values as fv
from sheetloom.functions import clean as c
from sheetloom.operators.substring import contained_tokens
from sheetloom.session import written

IMAGE = ["run_id", "image_id"]
PRODUCT = ["run_id", "product_ord"]
VARIANT = ["run_id", "product_ord", "variant_ord"]
FINDING_COLUMNS = ["run_id", "image_id", "status", "product_ord", "variant_ord", "match_strategy", "confidence",
                   "candidate_count", "sku", "note"]


def _finding(df: DataFrame, status: str | Column, strategy: str | Column, confidence: float | Column,
             variant: Column | None = None, product: Column | None = None, count: Column | None = None,
             sku: Column | None = None, note: Column | None = None) -> DataFrame:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    none = F.lit(None)
    return df.select(
        "run_id", "image_id", lit(status).alias("status"),
        (F.col("product_ord") if product is None else product).cast("bigint").alias("product_ord"),
        (none if variant is None else variant).cast("int").alias("variant_ord"),
        lit(strategy).alias("match_strategy"), lit(confidence).cast("double").alias("confidence"),
        (F.lit(1) if count is None else count).cast("bigint").alias("candidate_count"),
        (none if sku is None else sku).cast("string").alias("sku"),
        (none if note is None else note).cast("string").alias("note"))


# ----------------------------------------------------- 1: exact identity
def _identity_keys(variants: DataFrame) -> DataFrame:
    """(run, key) -> first variant that answers to it."""
    url_name = F.regexp_extract(F.col("primary_image_url"), r"([^/]+)/*$", 1)

    def key(kind: str, text: Column, rank: int, strategy: str) -> Column:
        return F.when(text != "", F.struct(
            F.concat(F.lit(kind), text).alias("key"), F.lit(rank).alias("rank"), F.lit(strategy).alias("strategy")))

    keys = F.array(
        key("S:", F.lower(c.pystrip("variant_code")), 1, "EXACT_VARIANT_CODE"),
        key("S:", F.lower(c.pystrip("image_sku")), 2, "EXACT_IMAGE_SKU"),
        key("F:", F.lower(url_name), 3, "SOURCE_URL_EXACT"))
    return (variants.select(*VARIANT, F.inline(F.filter(keys, lambda k: k.isNotNull())))
            .groupBy("run_id", "key")
            .agg(F.min(F.struct("product_ord", "variant_ord", "rank", "strategy")).alias("best")))


def _stem_prefixes(stem: Column) -> Column:
    """The stem and everything before each ``-`` or ``_`` in it."""
    cuts = F.filter(F.sequence(F.lit(2), F.greatest(F.length(stem), F.lit(2))),
                    lambda i: stem.substr(i, F.lit(1)).isin("-", "_"))
    return F.array_distinct(F.concat(F.array(stem), F.transform(cuts, lambda i: stem.substr(F.lit(1), i - F.lit(1)))))


def exact_identity(images: DataFrame, variants: DataFrame) -> DataFrame:
    probes = F.concat(
        F.transform(_stem_prefixes(F.col("normalized_stem")), lambda p: F.concat(F.lit("S:"), p)),
        F.array(F.concat(F.lit("F:"), F.lower("original_filename"))))
    best = (images.select(*IMAGE, F.explode(probes).alias("key"))
            .join(_identity_keys(variants), ["run_id", "key"])
            .groupBy(*IMAGE).agg(F.min("best").alias("best")))
    return _finding(best, "MATCHED", F.col("best.strategy"), 1.0, F.col("best.variant_ord"), F.col("best.product_ord"))


# ----------------------------------------------------- 2: product scope
def product_scope(images: DataFrame, products: DataFrame) -> DataFrame:
    """First product whose group or catalogue name occurs in the image path.

    The cleaned stem is a part of the cleaned path, so the path alone is searched.
    """
    names = F.array_compact(F.array(c.clean_token("product_group"), c.clean_token("catalog_name")))
    tokens = (products.select("run_id", "product_ord", F.explode(names).alias("token"))
              .groupBy("run_id", "token").agg(F.min("product_ord").alias("product_ord")))
    texts = images.select(*IMAGE, c.clean_token("relative_path").alias("text"))
    return (contained_tokens(texts, tokens, ["run_id"], ["image_id"])
            .join(tokens, ["run_id", "token"])
            .groupBy(*IMAGE).agg(F.min("product_ord").alias("product_ord")))


def _union_size(hits: DataFrame, variants: DataFrame, shared_a: Column, shared_b: Column,
                own: list[Column]) -> DataFrame:
    """How many variants of the product answer to at least one hit of the image.

    ``hits(run, product_ord, image_id, found)`` holds the set of tokens found.
    ``shared_a`` and ``shared_b`` may be the same for many variants and are only
    counted: |A| + |B| - |A and B|.  ``own`` tokens belong to few variants each;
    those not counted yet are added one by one.
    """
    keyed = variants.select(*VARIANT, shared_a.alias("a"), shared_b.alias("b"),
                            F.array_distinct(F.array_compact(F.array(*own))).alias("own"))

    def per_token(name: str) -> DataFrame:
        return (keyed.where(F.col(name) != "").groupBy(*PRODUCT, F.col(name).alias("token"))
                .agg(F.count(F.lit(1)).alias("n"), F.min("variant_ord").alias("first"))
                .withColumn("kind", F.lit(name)))

    both = (keyed.where((F.col("a") != "") & (F.col("b") != "")).groupBy(*PRODUCT, "a", "b")
            .agg((-F.count(F.lit(1))).alias("n"), F.min("variant_ord").alias("first"))
            .select(*PRODUCT, F.concat("a", F.lit("\u0001"), "b").alias("token"), "n", "first",
                    F.lit("ab").alias("kind")))
    stats = per_token("a").unionByName(per_token("b")).unionByName(both)
    pairs = F.flatten(F.transform("found", lambda x: F.transform(
        "found", lambda y: F.concat(x, F.lit("\u0001"), y))))
    probes = hits.select(*PRODUCT, "image_id", F.explode(F.concat(F.col("found"), pairs)).alias("token"))
    counted = (probes.join(stats, [*PRODUCT, "token"])
               .select(*PRODUCT, "image_id", "n", "first", F.lit(True).alias("is_shared"), F.lit(None).cast("int").alias("one")))
    singles = (keyed.select(*VARIANT, "a", "b", F.explode("own").alias("token")).where(F.col("token") != ""))
    alone = (hits.select(*PRODUCT, "image_id", "found", F.explode("found").alias("token"))
             .join(singles, [*PRODUCT, "token"])
             .where(~F.coalesce(F.array_contains("found", F.col("a")), F.lit(False))
                    & ~F.coalesce(F.array_contains("found", F.col("b")), F.lit(False)))
             .select(*PRODUCT, "image_id", "variant_ord").distinct()
             .select(*PRODUCT, "image_id", F.lit(1).cast("bigint").alias("n"), F.col("variant_ord").alias("first"),
                     F.lit(False).alias("is_shared"), F.col("variant_ord").alias("one")))
    return (counted.unionByName(alone).groupBy(*PRODUCT, "image_id")
            .agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.max("is_shared").alias("by_shared")))


def _path_keys() -> tuple[Column, Column, list[Column]]:
    """What a path may name a variant by: colour and name, which many variants share, and its code."""
    return c.clean_token("color"), c.clean_token("variant_name"), [c.clean_token("variant_code")]


def _fact_keys() -> tuple[Column, Column, list[Column]]:
    """What a text fact may name a variant by: SKU and name, which many share, and its own code and image SKU."""
    return F.lower("supplier_sku"), F.lower("variant_name"), [F.lower("variant_code"), F.lower("image_sku")]


def _path_tokens(scoped: DataFrame, variants: DataFrame) -> DataFrame:
    """Tokens of the scoped product's variants that occur in the path, a set per image."""
    colour, name, codes = _path_keys()
    words = variants.select(*PRODUCT, F.explode(F.array_compact(F.array(colour, name, *codes))).alias("token"))
    return (contained_tokens(scoped.select(*PRODUCT, "image_id", "text"), words, PRODUCT, ["image_id"])
            .groupBy(*PRODUCT, "image_id").agg(F.collect_set("token").alias("found")))


def _fact_tokens(scoped: DataFrame, facts: DataFrame) -> DataFrame:
    """Texts of the facts of an image, as a set."""
    return (facts.withColumn("token", F.lower(c.pystrip("value"))).where(F.col("token") != "")
            .join(scoped.select(*PRODUCT, "image_id"), IMAGE)
            .groupBy(*PRODUCT, "image_id").agg(F.collect_set("token").alias("found")))


def _asked(variants: DataFrame, scoped: DataFrame) -> DataFrame:
    """Variants of products that some image belongs to."""
    return variants.join(scoped.select(*PRODUCT).distinct(), PRODUCT, "left_semi")


def token_hits(scoped: DataFrame, variants: DataFrame) -> DataFrame:
    """Variants of the scoped product whose colour, name or code occurs in the path.

    ``scoped(run_id, image_id, product_ord, text)``; one row per image with
    ``n`` variants found, the ``first`` of them, and whether a colour or name hit.
    """
    asked = _asked(variants, scoped)
    return _union_size(_path_tokens(scoped, asked), asked, *_path_keys())


def fact_hits(scoped: DataFrame, variants: DataFrame, facts: DataFrame) -> DataFrame:
    """Variants of the scoped product named by a text fact of the image."""
    return _union_size(_fact_tokens(scoped, facts), variants, *_fact_keys())


def _sequence_number(clean_stem: Column) -> Column:
    return F.regexp_extract(clean_stem, r"(?:[_\-]|^0*)(\d{1,4})$", 1).try_cast("int")


def _is_photo_name(clean_stem: Column) -> Column:
    words = F.split(clean_stem, "-")
    return F.coalesce(F.get(words, F.size(words) - F.lit(2)).isin(fv.PHOTO_WORDS), F.lit(False))


def sequence_hits(scoped: DataFrame, variants: DataFrame) -> DataFrame:
    """Variant n of the scoped product for an image name that ends in n."""
    numbered = (scoped.withColumn("variant_ord", _sequence_number(F.col("stem_text")))
                .where((F.col("variant_ord") >= 1) & ~_is_photo_name(F.col("stem_text"))))
    candidate = numbered.join(variants.select(*VARIANT, "variant_code", "variant_name"), VARIANT)
    no, two = F.col("variant_ord").cast("string"), c.two_digits("variant_ord")
    code, name = F.lower("variant_code"), F.coalesce(F.lower("variant_name"), F.lit(""))
    tests = [code.contains(F.concat(F.lit("v"), two)), code.contains(F.concat(F.lit("v"), no)),
             code.contains(F.concat(F.lit("-"), no)), code.contains(two),
             name.contains(F.concat(F.lit("design "), two)), name.contains(F.concat(F.lit("design "), no))]
    return candidate.where(reduce(lambda a, b: a | b, tests)).select(*PRODUCT, "image_id", "variant_ord")


def scoped_texts(images: DataFrame, scope: DataFrame) -> DataFrame:
    return (images.join(scope, IMAGE).select(
        *IMAGE, "product_ord", c.clean_token("relative_path").alias("text"),
        c.clean_token("normalized_stem").alias("stem_text")))


def within_scope(images: DataFrame, scope: DataFrame, variants: DataFrame, facts: DataFrame) -> DataFrame:
    """Finding of every image that belongs to a product's scope."""
    sizes = variants.groupBy(*PRODUCT).agg(
        F.count(F.lit(1)).alias("size"), F.min("variant_ord").alias("only"))
    scoped = written(scoped_texts(images, scope).join(sizes, PRODUCT, "left")
                     .withColumn("size", F.coalesce("size", F.lit(0))), "scoped")
    many = scoped.where(F.col("size") > 1)
    by_token = written(token_hits(many, variants), "by-token")
    no_token = many.join(by_token.select(*PRODUCT, "image_id"), [*PRODUCT, "image_id"], "left_anti")
    by_fact = written(fact_hits(no_token, variants, facts), "by-fact")
    unnamed = no_token.join(by_fact.select(*PRODUCT, "image_id"), [*PRODUCT, "image_id"], "left_anti")
    by_number = sequence_hits(unnamed, variants)

    def named(hits: DataFrame, by_token_hit: bool) -> DataFrame:
        one = F.col("n") == 1
        label = F.when(F.col("by_shared"), F.lit("SCOPED_PRODUCT_COLOR_TOKEN")).otherwise(
            F.lit("OCR_CANDIDATE_VARIANT_MATCH")) if by_token_hit else F.lit("OCR_CANDIDATE_VARIANT_MATCH")
        return _finding(
            hits, F.when(one, F.lit("MATCHED")).otherwise(F.lit("AMBIGUOUS")),
            F.when(one, label).otherwise(F.lit("SCOPED_PRODUCT_AMBIGUOUS")),
            F.when(one, F.lit(0.85)).otherwise(F.lit(0.5)), F.when(one, F.col("first")), count=F.col("n"))

    single = _finding(scoped.where(F.col("size") == 1), "MATCHED", "SCOPED_SINGLE_VARIANT_PRODUCT", 0.90, F.col("only"))
    number = F.col("s.variant_ord")
    last = (unnamed.alias("u").join(by_number.alias("s"), [*PRODUCT, "image_id"], "left")
            .unionByName(scoped.where(F.col("size") == 0).withColumn("variant_ord", F.lit(None).cast("int"))))
    number = F.col("variant_ord")
    counted = _finding(
        last, F.when(number.isNotNull(), F.lit("MATCHED")).otherwise(F.lit("AMBIGUOUS")),
        F.when(number.isNotNull(), F.lit("SCOPED_DESIGN_SEQUENCE_INDEX")).otherwise(
            F.lit("SCOPED_MULTI_VARIANT_AMBIGUOUS")),
        F.when(number.isNotNull(), F.lit(0.90)).otherwise(F.lit(0.5)), number,
        count=F.when(number.isNotNull(), F.lit(1)).otherwise(F.col("size")), note=number.cast("string"))
    return reduce(DataFrame.unionByName, [single, named(by_token, True), named(by_fact, False), counted])


# ------------------------------------------- 2.5: facts outside any scope
def unscoped_facts(images: DataFrame, variants: DataFrame, facts: DataFrame) -> DataFrame:
    own = F.array_distinct(F.array_compact(F.array(F.lower("variant_code"), F.nullif(F.lower("image_sku"), F.lit("")))))
    keys = (variants.select(*VARIANT, F.explode(own).alias("token")).groupBy("run_id", "token")
            .agg(F.min(F.struct("product_ord", "variant_ord")).alias("place")))
    best = (facts.withColumn("token", F.lower(c.pystrip("value"))).where(F.col("token") != "")
            .join(images.select(*IMAGE), IMAGE, "left_semi")
            .join(keys, ["run_id", "token"])
            .groupBy(*IMAGE)
            .agg(F.min(F.struct("fact_ord", "place", "field", "value")).alias("best")))
    return _finding(best, "MATCHED", "OCR_CANDIDATE_EXACT", 0.85, F.col("best.place.variant_ord"),
                    F.col("best.place.product_ord"),
                    note=F.concat_ws(" ", "best.field", "best.value"))


# --------------------------------------------------- 3: supplier SKU
def _sku_tokens(images: DataFrame, skus: DataFrame) -> DataFrame:
    """Supplier SKUs (run, token) that are a token of the image's path or part of its stem, each once per image."""
    in_stem = contained_tokens(images.select(*IMAGE, F.col("normalized_stem").alias("text")), skus, ["run_id"], ["image_id"])
    in_path = images.select(*IMAGE, F.explode("tokens").alias("token")).join(skus, ["run_id", "token"], "left_semi")
    return in_stem.select(*IMAGE, "token").unionByName(in_path.select(*IMAGE, "token")).distinct()


def supplier_sku(images: DataFrame, variants: DataFrame) -> DataFrame:
    key = F.lower(c.pystrip("supplier_sku"))
    skus = (variants.where(F.col("supplier_sku") != "").withColumn("token", key).where(F.col("token") != "")
            .groupBy("run_id", "token").agg(
                F.count(F.lit(1)).alias("n"), F.min("variant_code").alias("low"), F.max("variant_code").alias("high"),
                F.min(F.struct("product_ord", "variant_ord", "supplier_sku")).alias("first"),
                F.max(F.struct("product_ord", "variant_ord")).alias("last")))
    per_image = (_sku_tokens(images, skus).join(skus, ["run_id", "token"]).groupBy(*IMAGE).agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.min("first").alias("first"), F.max("last").alias("last")))
    number = F.regexp_extract("original_filename", r"[_\-](\d+)(?:\.\w+)?$", 1).try_cast("int")
    sizes = variants.groupBy(*PRODUCT).agg(F.count(F.lit(1)).alias("size"))
    judged = (per_image.join(images.select(*IMAGE, number.alias("number")), IMAGE)
              .withColumn("product_ord", F.col("first.product_ord"))
              .join(sizes, PRODUCT))
    one = F.col("low") == F.col("high")
    indexed = ~one & F.coalesce((F.col("number") >= 1) & (F.col("number") <= F.col("size")), F.lit(False))
    return _finding(
        judged, F.when(one | indexed, F.lit("MATCHED")).otherwise(F.lit("AMBIGUOUS")),
        F.when(one, F.lit("SUPPLIER_SKU_SINGLE_VARIANT")).when(indexed, F.lit("SUPPLIER_SKU_INDEXED_SEQUENCE"))
        .otherwise(F.lit("SHARED_SUPPLIER_SKU_AMBIGUOUS")),
        F.when(one, F.lit(0.8)).when(indexed, F.lit(0.75)).otherwise(F.lit(0.4)),
        F.when(one, F.col("last.variant_ord")).when(indexed, F.col("number")),
        F.when(one, F.col("last.product_ord")).when(indexed, F.col("product_ord")),
        F.when(one | indexed, F.lit(1)).otherwise(F.col("n")),
        F.when(~one & ~indexed, F.col("first.supplier_sku")), F.col("number").cast("string"))


# ----------------------------------------------------------- everything
def _reason() -> Column:
    code, cat, sku = F.col("variant_code"), F.col("catalog_name"), F.col("supplier_sku")

    def say(*parts):
        return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p, F.lit("None")) for p in parts])

    s = F.col("match_strategy")
    n = F.col("candidate_count").cast("string")
    return (F.when(s == "EXACT_VARIANT_CODE", say("Matched exact variant_code '", code, "'"))
            .when(s == "EXACT_IMAGE_SKU", say("Matched exact image_sku '", F.col("image_sku"), "'"))
            .when(s == "SOURCE_URL_EXACT", say("Matched remote primary_image_url filename '", F.col("url_name"), "'"))
            .when(s == "SCOPED_SINGLE_VARIANT_PRODUCT",
                  say("Matched single-variant catalogue '", cat, "' (variant '", code, "')"))
            .when(s == "SCOPED_DESIGN_SEQUENCE_INDEX",
                  say("Matched scoped catalogue '", cat, "' sequence index ", F.col("note"), " with variant '", code, "'"))
            .when(s.isin("OCR_CANDIDATE_VARIANT_MATCH", "SCOPED_PRODUCT_COLOR_TOKEN"),
                  say("Matched scoped catalog '", cat, "' with variant '", code, "'"))
            .when(s == "SCOPED_PRODUCT_AMBIGUOUS",
                  say("Image belongs to catalog '", cat, "' but matches ", n, " variants"))
            .when(s == "SCOPED_MULTI_VARIANT_AMBIGUOUS",
                  say("Image belongs to catalogue '", cat, "' (", n, " variants), but lacks variant-distinguishing tokens"))
            .when(s == "OCR_CANDIDATE_EXACT",
                  say("Matched OCR candidate ", F.col("note"), " to variant '", code, "'"))
            .when(s == "SUPPLIER_SKU_SINGLE_VARIANT",
                  say("Matched single variant '", code, "' for supplier SKU '", sku, "'"))
            .when(s == "SUPPLIER_SKU_INDEXED_SEQUENCE",
                  say("Matched variant index ", F.col("note"), " ('", code, "') for supplier SKU '", sku, "'"))
            .when(s == "SHARED_SUPPLIER_SKU_AMBIGUOUS",
                  say("Image matches supplier SKU '", sku, "' but ", n, " variants share it without disambiguator"))
            .otherwise(F.lit("No reliable variant identity found")))


def describe(findings: DataFrame, products: DataFrame, variants: DataFrame) -> DataFrame:
    """Findings with the ids, codes and names they point to."""
    url_name = F.lower(F.regexp_extract("primary_image_url", r"([^/]+)/*$", 1))
    named = (findings
             .join(products.select("run_id", "product_ord", "product_id", "catalog_name"), PRODUCT, "left")
             .join(variants.select(*VARIANT, "variant_code", "supplier_sku", "image_sku", url_name.alias("url_name")),
                   VARIANT, "left")
             .withColumn("supplier_sku", F.coalesce("supplier_sku", "sku")))
    return named.select(
        "run_id", "image_id", "status", "product_id", "catalog_name", "variant_code", "supplier_sku",
        "match_strategy", "confidence", "candidate_count", _reason().alias("reason"),
        "product_ord", "variant_ord")


def match_images(images: DataFrame, products: DataFrame, variants: DataFrame, facts: DataFrame) -> DataFrame:
    """One finding per image.

    Each priority sees only the images the earlier ones left.  The intermediate
    results are written once: they are small (ids and places) and are read both
    by the next priority and by the final union.
    """
    images = written(images.select(*IMAGE, "relative_path", "original_filename", "normalized_stem", "tokens"), "images")
    variants = written(variants.select(
        *VARIANT, "variant_code", "supplier_sku", "variant_name", "color", "image_sku", "primary_image_url"), "variants")
    products = written(products.select(
        "run_id", "product_ord", "product_id", "product_group", "catalog_name"), "products")
    facts = written(facts.select(*IMAGE, "fact_ord", "field", "value"), "facts")

    first = written(exact_identity(images, variants), "exact")
    left = images.join(first.select(*IMAGE), IMAGE, "left_anti")
    scope = written(product_scope(left, products), "scope")
    second = within_scope(left, scope, variants, facts)
    left = left.join(scope.select(*IMAGE), IMAGE, "left_anti")
    third = written(unscoped_facts(left, variants, facts), "facts-found")
    left = left.join(third.select(*IMAGE), IMAGE, "left_anti")
    fourth = written(supplier_sku(left, variants), "sku-found")
    nothing = _finding(left.join(fourth.select(*IMAGE), IMAGE, "left_anti"), "UNMATCHED", F.lit(None).cast("string"),
                       0.0, product=F.lit(None), count=F.lit(0))
    found = reduce(DataFrame.unionByName, [first, second, third, fourth, nothing])
    return describe(found.select(*FINDING_COLUMNS), products, variants)


# ------------------------------------------------------ candidate codes
def _named_variants(hits: DataFrame, variants: DataFrame, shared_a: Column, shared_b: Column, own: list[Column]) -> DataFrame:
    """Variants of the product that answer to a hit of the image, each once.

    ``hits(run, product_ord, image_id, found)``. Three parts without common rows, so nothing has to be made distinct:
    variants by their first shared token, by the second where the first is no hit, and by the first own token that is
    a hit where neither shared one is.
    """
    keyed = variants.select(*VARIANT, "variant_code", shared_a.alias("a"), shared_b.alias("b"),
                            F.array_distinct(F.array_compact(F.array(*own))).alias("own"))
    probes = hits.select(*PRODUCT, "image_id", "found", F.explode("found").alias("token")).where(F.col("token") != "")

    def is_hit(name: str) -> Column:
        return F.coalesce((F.col(name) != "") & F.array_contains("found", F.col(name)), F.lit(False))

    def by(name: str) -> DataFrame:
        return probes.join(keyed.withColumn("token", F.explode("own") if name == "own" else F.col(name)), [*PRODUCT, "token"])

    first_own = F.get(F.filter("own", lambda x: (x != "") & F.array_contains("found", x)), F.lit(0))
    parts = [by("a"), by("b").where(~is_hit("a")),
             by("own").where(~is_hit("a") & ~is_hit("b") & (first_own == F.col("token")))]
    return reduce(DataFrame.unionByName, [p.select(*IMAGE, "product_ord", "variant_ord", "variant_code") for p in parts])


def candidates(findings: DataFrame, images: DataFrame, variants: DataFrame, facts: DataFrame,
               asked: DataFrame | None = None) -> DataFrame:
    """Variants that an ambiguous image fits, a row each: ``run_id, image_id, product_ord, variant_ord, variant_code``.

    Findings carry their number only. What makes them up is a set of tokens per image and the variants behind each
    token, and the two are joined here for the images of ``asked(run_id, image_id)``, or for all. Of variants with one
    code that share a supplier SKU the first is listed. Images that match, or fit nothing, have no rows.
    """
    open_ = findings.where(F.col("status") == "AMBIGUOUS")
    if asked is not None:
        open_ = open_.join(asked.select(*IMAGE).distinct(), IMAGE, "left_semi")
    open_ = written(open_.select(*IMAGE, "product_ord", "match_strategy"), "open-images")
    named = images.select(*IMAGE, "relative_path", "normalized_stem", "tokens").join(
        open_.select(*IMAGE, "match_strategy"), IMAGE)
    several = open_.where(F.col("match_strategy") == "SCOPED_PRODUCT_AMBIGUOUS").select(*IMAGE, "product_ord")
    scoped = written(scoped_texts(named, several), "open-scoped")
    of_product = written(_asked(variants, scoped), "open-variants")
    in_path = written(_path_tokens(scoped, of_product), "open-tokens")
    in_facts = _fact_tokens(scoped.join(in_path.select(*IMAGE), IMAGE, "left_anti"), facts)
    whole = (open_.where(F.col("match_strategy") == "SCOPED_MULTI_VARIANT_AMBIGUOUS").select(*IMAGE, "product_ord")
             .join(variants.select(*VARIANT, "variant_code"), PRODUCT))
    skus = (variants.withColumn("token", F.lower(c.pystrip("supplier_sku"))).where(F.col("token") != "")
            .groupBy("run_id", "token", "variant_code").agg(F.min(F.struct("product_ord", "variant_ord")).alias("place")))
    of_sku = named.where(F.col("match_strategy") == "SHARED_SUPPLIER_SKU_AMBIGUOUS")
    shared = (_sku_tokens(of_sku, skus.select("run_id", "token")).join(skus, ["run_id", "token"])
              .groupBy(*IMAGE, "variant_code").agg(F.min("place").alias("place")))
    parts = [_named_variants(in_path, of_product, *_path_keys()), _named_variants(in_facts, of_product, *_fact_keys()), whole,
             shared.select(*IMAGE, "place.product_ord", "place.variant_ord", "variant_code")]
    return reduce(DataFrame.unionByName, [p.select(*IMAGE, "product_ord", "variant_ord", "variant_code") for p in parts])


def summary(findings: DataFrame) -> DataFrame:
    """Counts and match rate per run."""
    def number(status: str) -> Column:
        return F.count_if(F.col("status") == status)

    rate = F.bround(number("MATCHED") / F.count(F.lit(1)) * 100, 2)
    return findings.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total_images"), number("MATCHED").alias("matched_count"),
        number("AMBIGUOUS").alias("ambiguous_count"), number("UNMATCHED").alias("unmatched_count"),
        rate.alias("match_rate_percent"))


# ------------------------------------------------ documents to images
def image_facts(images: DataFrame, facts: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """Facts of the document that belongs to each image.

    ``facts(run_id, doc_id, filename, fact_ord, field, value)``.  A document is
    found by file name, path or image id; of several with one name the last counts,
    even if its text says nothing, where ``documents(run_id, doc_id, filename)`` list them all.
    """
    documents = (facts if documents is None else documents).groupBy("run_id", F.lower("filename").alias("key")).agg(F.max("doc_id").alias("doc_id"))
    names = F.array(F.lower("original_filename"), F.lower("relative_path"), F.lower("image_id"))
    chosen = (images.select(*IMAGE, F.posexplode(names).alias("rank", "key"))
              .join(documents, ["run_id", "key"])
              .groupBy(*IMAGE).agg(F.min_by("doc_id", "rank").alias("doc_id")))
    return chosen.join(facts.drop("filename"), ["run_id", "doc_id"]).select(
        *IMAGE, "doc_id", "fact_ord", "field", "value")


# --------------------------------------------------------- galleries
def gallery(findings: DataFrame, images: DataFrame, variants: DataFrame) -> DataFrame:
    """Matched images of each variant in display order; index 0 is the primary."""
    from sheetloom.operators.ranking import rank_by_text

    matched = (findings.where(F.col("status") == "MATCHED").select(*IMAGE, "product_ord", "variant_ord")
               .join(images.select(*IMAGE, "relative_path", "original_filename", "normalized_stem"), IMAGE)
               .join(variants.select(*VARIANT, "variant_code", "image_sku"), VARIANT))
    stem = F.col("normalized_stem")

    def place(base: Column) -> Column:
        tail = F.when(stem.startswith(F.concat(base, F.lit("-"))) | stem.startswith(F.concat(base, F.lit("_"))),
                      stem.substr(F.length(base) + F.lit(2), F.length(stem)))
        return (F.when(stem == base, F.lit("0"))
                .when(tail.rlike("^[0-9]+$"), F.concat(F.lit("1"), c.natural_key(tail))))

    known = F.coalesce(place(F.lower("variant_code")),
                       F.when(F.col("image_sku") != "", place(F.lower("image_sku"))))
    order = F.concat(F.coalesce(known, F.lit("2")), F.lit("\u0001"),
                     F.when(known.isNotNull(), c.natural_key("original_filename")).otherwise(
                         c.natural_key("relative_path")))
    ranked = rank_by_text(matched.withColumn("order_key", order), VARIANT, ["order_key", "relative_path", "image_id"], "place")
    return (ranked.withColumn("sort_index", (F.col("place") - 1).cast("int"))
            .withColumn("is_primary", F.col("sort_index") == 0)
            .select(*IMAGE, "product_ord", "variant_ord", "variant_code", "original_filename", "normalized_stem",
                    "relative_path", "sort_index", "is_primary"))


def backfill_image_sku(variants: DataFrame, galleries: DataFrame) -> DataFrame:
    """A variant without image SKU takes the stem of its primary image."""
    primary = galleries.where("is_primary").select(*VARIANT, F.col("normalized_stem").alias("primary_stem"))
    return (variants.join(primary, VARIANT, "left")
            .withColumn("image_sku", F.coalesce(F.nullif("image_sku", F.lit("")), "primary_stem"))
            .drop("primary_stem"))

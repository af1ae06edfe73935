"""Values that decide results: alias lists, word lists, patterns, constants.

Everything in this file is a fixed value of the domain. Code elsewhere only
refers to these names.
"""

# ---------------------------------------------------------------- fixed values
# Supplier profiles.  Profile names and the accepted spellings of an explicit
# profile choice.
GENERIC = "generic_tabular"
WHOLESALE = "amra_adapter"
PROFILE_SPELLINGS = {
    "amra": WHOLESALE,
    "amra_wholesale": WHOLESALE,
    "amra_adapter": WHOLESALE,
    "generic": GENERIC,
    "generic_tabular": GENERIC,
    "tabular": GENERIC,
    "default": GENERIC,
}
WHOLESALE_SIGNATURE = [
    "catalogue_name", "catalog_name", "saree_fabric", "blouse_fabric",
    "varient_name", "product_group", "dispatch_location",
]
WHOLESALE_SUPPLIER_WORD = "amra"

# Defaults per profile: supplier name, product type, category slug, order minimum.
PROFILE_DEFAULTS = {
    GENERIC: {"supplier_name": "Generic Supplier", "product_type": "General",
              "category_slug": None, "moq": None},
    WHOLESALE: {"supplier_name": "Amra Wholesale", "product_type": "Saree",
                "category_slug": "sarees", "moq": 1},
}

# Header aliases per profile in priority order.
GENERIC_ALIASES = {
    "supplier_name": ["supplier_name", "supplier", "vendor", "manufacturer"],
    "catalog_name": ["catalog_name", "catalogue_name", "collection", "catalog", "catalogue", "group_name"],
    "product_name": ["product_name", "title", "product_title", "item_name", "name"],
    "product_group": ["product_group", "group", "series", "family"],
    "brand_name": ["brand", "brand_name", "brand_title"],
    "product_type": ["product_type", "type", "category", "item_type"],
    "category_slug": ["category_slug", "category", "slug"],
    "description": ["description", "details", "product_description", "summary"],
    "supplier_sku": ["supplier_sku", "sku", "item_code", "product_code", "style_code", "code", "model"],
    "supplier_price": ["supplier_price", "per_unit_price", "unit_price", "cost", "supplier_cost", "unit_cost", "purchase_price"],
    "wholesale_price": ["wholesale_price", "wholesale_per_unit_price", "ws_price", "wholesale_rate"],
    "full_catalogue_price": ["full_catalogue_price", "full_catalog_price", "catalogue_price", "catalog_price"],
    "single_piece_price": ["single_piece_price", "single_piece", "single_price", "single_rate"],
    "gst_percent": ["gst", "gst_percent", "tax_percent", "tax_rate", "vat"],
    "moq": ["minimum_order_quantity", "minimum_order_qty", "moq", "min_order_qty", "pack_size"],
    "variant_code": ["variant_code", "variant_sku", "barcode", "upc", "ean", "item_sku"],
    "variant_name": ["variant_name", "variant", "option", "design", "style", "color_name"],
    "color": ["color", "colour", "shade"],
    "size": ["size", "dimensions", "length"],
    "stock_quantity": ["stock", "quantity", "inventory", "stock_quantity", "qty"],
    "selling_price": ["selling_price", "retail_price", "mrp", "price"],
}
# Mapped by the generic profile although no field is read from them.
GENERIC_RESERVED = ["total_designs", "designs", "pieces", "pcs", "full_catalogue", "total_pieces"]

WHOLESALE_ALIASES = {
    "supplier_name": ["supplier_name", "supplier", "vendor"],
    "catalog_name": ["catalogue_name", "catalog_name", "catalogue", "catalog", "catalogue_title"],
    "product_group": ["product_group", "group", "group_name", "product_code"],
    "product_name": ["product_name", "product_title", "title", "name"],
    "brand_name": ["brand_name", "brand"],
    "product_type": ["product_type", "type", "category"],
    "category_slug": ["category_slug", "category"],
    "description": ["description", "product_description", "details"],
    "supplier_sku": ["supplier_sku", "sku", "item_code", "product_sku"],
    "supplier_price": ["single_piece_price", "single_piece", "supplier_price", "per_unit_price",
                       "wholesale_per_unit_price", "wholesale_price", "cost", "catalogue_price_per_piece"],
    "gst_percent": ["gst_percent", "gst", "tax_percent"],
    "moq": ["moq", "minimum_order_qty"],
    "dispatch_location": ["dispatch_location", "dispatch_from", "location"],
    "fabric": ["fabric", "saree_fabric", "material"],
    "blouse_fabric": ["blouse_fabric", "blouse_material"],
    "work": ["work", "work_print_type", "work/print_type", "work_type", "print_type", "embroidery"],
    "occasion": ["occasion", "wear_type"],
    "size": ["size", "dimensions"],
    "saree_length": ["saree_length", "saree_cut"],
    "blouse_length": ["blouse_length", "blouse_cut"],
    "stitch_type": ["stitch_type", "stitching"],
    "variant_name": ["varient_name", "variant_name", "variant", "design_name", "color", "colour", "shade"],
    "color": ["color", "colour", "shade"],
    "image_sku": ["image-sku", "image_sku", "image_id", "design_id", "design_code"],
    "primary_image_url": ["image_url", "image", "main_image_url"],
    "gallery_1": ["image1_url"],
    "gallery_2": ["image2_url"],
    "gallery_3": ["image3_url"],
    "gallery_4": ["image4_url"],
    "selling_price": ["selling_proce", "selling_price", "mrp", "retail_price"],
    "variant_cost": ["supplier_price", "per_unit_price", "single_piece", "cost"],
}
CATEGORY_ATTRIBUTES = ["fabric", "blouse_fabric", "work", "occasion", "size",
                       "saree_length", "blouse_length", "stitch_type"]
DECLARED_COUNT_ALIASES = [
    "total_designs", "total_design", "total_pieces", "total_piece", "full_catalogue",
    "full_catalog", "piece_count", "no_of_designs", "designs_count", "variant_count",
]
NULL_WORDS = ["nan", "none", "null"]
ATTRIBUTE_NOT_COPIED = "raw_ocr_text"

# Declared-count patterns, tried in this order.
COUNT_IN_PARENTHESES = r"(?i)\(\s*(\d+)\s*(?:pcs?|pieces?|designs?|items?)\b"
COUNT_OF_PIECES = r"(?i)\b(\d+)\s*(?:pcs?|pieces?|designs?|items?)\b"
COUNT_PACK_OF = r"(?i)\b(?:pack|set)\s+of\s+(\d+)\b"

# Catalogue name -> group patterns.
GROUP_NUMBER_RANGE = r"(?i)\b\d+\s+TO\s+\d+\s*(?:series)?\b.*"
GROUP_CODE_RANGE = r"(?i)\bS-\d+\s+TO\s+S-\d+\s*(?:series)?\b.*"
GROUP_VOLUME = r"(?i)\b(?:vol|volume|edition|part)[\s\-_]*\d+.*"
GROUP_TRAILING_NUMBER = r"[\s\-_]*\d+$"
GROUP_FALLBACK = "GROUP-1"
GROUP_MIDDLE_WORDS = ["lifestyle", "wholesale"]
SKU_VOLUME = r"(?i)\bvol(?:ume)?[\s\-_]*(\d+)\b"
SKU_TRAILING_TOKEN = r"(?i)\b(?:series[\s\-_]*)?([a-z0-9\-]+)$"

# Images.
IMAGE_EXTENSIONS = [".jpg", ".jpeg", ".png", ".webp"]
PHOTO_WORDS = ["photo", "photos", "image", "images", "img", "pic", "pics", "picture",
               "pictures", "shot", "shots", "frame", "frames", "page", "pages"]
SPELLING_FROM, SPELLING_TO = "amrah", "amra"
HOSTED_WORD = "blob"
HOSTED_DOMAIN = "blob.vercel-storage.com"
CONTENT_TYPES = {
    ".jpg": "image/jpeg", ".jpeg": "image/jpeg", ".png": "image/png",
    ".webp": "image/webp", ".gif": "image/gif", ".avif": "image/avif",
}
CONTENT_TYPE_OTHER = "application/octet-stream"

# Batch manifests.
SOURCE_EXTENSIONS = [".csv", ".tsv", ".xlsx", ".jpg", ".jpeg", ".png", ".webp",
                     ".bmp", ".tiff", ".pdf"]
FORMULA_PREFIXES = "=+-@"

# Output layouts.
IMPORT_COLUMNS = [
    "No", "supplier_name", "catalog_name", "product_group", "product_name", "varient_name",
    "supplier_sku", "product_type", "category_slug", "brand_name", "fabric", "blouse_fabric",
    "work", "occasion", "size", "description", "supplier_price", "gst_percent", "selling_price",
    "image-sku", "image_url", "publish", "image1_url", "image2_url", "image3_url", "image4_url",
]
FLAT_COLUMNS = [
    "supplier_name", "catalog_name", "product_group", "product_name", "variant_name", "variant_code",
    "supplier_sku", "image_sku", "product_type", "category_slug", "brand_name", "color", "size", "description",
    "supplier_price", "supplier_cost", "gst_percent", "selling_price", "stock_quantity", "publish",
    "review_status", "primary_image_url",
]
STORE_COLUMNS = [
    "supplier_name", "catalog_name", "product_group", "product_name", "variant_name", "supplier_sku", "image_sku",
    "category_slug", "brand_name", "fabric", "blouse_fabric", "work", "occasion", "size", "description",
    "supplier_price", "gst_percent", "selling_price", "publish", "main_image_url",
]
LEGACY_COLUMNS = [
    "supplier_name", "catalog_name", "product_group", "product_name", "varient_name",
    "supplier_sku", "product_type", "category_slug", "brand_name", "fabric", "blouse_fabric",
    "work", "occasion", "size", "description", "supplier_price", "gst_percent",
    "selling_proce", "image-sku", "image_url", "publish",
]
LEGACY_RENAMES = {
    "supplier_name": "supplier_name", "catalogue_name": "catalog_name",
    "brand_name": "brand_name", "supplier_sku": "supplier_sku",
    "product_type": "product_type", "saree_fabric": "fabric",
    "blouse_fabric": "blouse_fabric", "work": "work", "occasion": "occasion",
    "supplier_price": "supplier_price", "gst_percent": "gst_percent",
}
LEGACY_CONSTANTS = {
    "product_group": "Sarees", "product_name": "", "varient_name": "",
    "category_slug": "sarees", "size": "Saree 5.5 m, blouse 0.8 m", "description": "",
    "selling_proce": "", "image-sku": "", "image_url": "", "publish": "false",
}
LEGACY_REQUIRED = ["supplier_name", "supplier_sku", "product_type", "brand_name",
                   "fabric", "work", "supplier_price", "gst_percent"]
LEGACY_REVIEW = ["product_name", "description", "selling_proce", "image-sku", "image_url"]
STRICT_REQUIRED = ["supplier_name", "catalogue_name", "brand_name", "supplier_sku",
                   "product_type", "supplier_price", "gst_percent", "moq"]
STRICT_NUMERIC = ["supplier_price", "catalogue_price_per_piece", "gst_percent", "moq", "design_count"]

# Labelled facts: (order, field, rule id, pattern, group, shortest value, confidence).
FACT_RULES = [
    (1, "design_number", "REGEX_DESIGN_NUMBER_EXPLICIT",
     r"(?i)\b(?:design\s*(?:no\.?|num(?:ber)?|#)|d\.?\s*no\.?|d-no\.?|d/no\.?|dn)\s*[:=\-#]?\s*([a-z0-9\-_]+)", 2, 0.9),
    (2, "design_number", "REGEX_STYLE_NUMBER",
     r"(?i)\b(?:style\s*(?:no\.?|code|#)|art(?:\.|\s*no\.?))\s*[:=\-#]?\s*([a-z0-9\-_]+)", 2, 0.9),
    (3, "sku", "REGEX_SKU_EXPLICIT",
     r"(?i)\b(?:sku|supplier\s*sku|item\s*code|item\s*no\.?|product\s*code)\s*[:=\-#]?\s*([a-z0-9\-_]+)", 2, 0.9),
    (4, "color", "REGEX_COLOR_LABELED",
     r"(?i)\b(?:color|colour|shade|colorway)\s*[:=\-#]?\s*([a-z0-9\s\-_/]+?)(?:\r?\n|$|(?=\b(?:fabric|work|size|price|rate|gst|design)\b))", 2, 0.85),
    (6, "catalog_name", "REGEX_CATALOG_NAME_LABELED",
     r"(?i)\b(?:catalogue|catalog|collection|series)\s*(?:name)?\s*[:=\-#]?\s*([a-z0-9\s\-]+?)(?:\r?\n|$|(?=\b(?:price|rate|fabric|design|d\.no|gst|brand)\b))", 3, 0.8),
    (7, "brand_name", "REGEX_BRAND_NAME_LABELED",
     r"(?i)\b(?:brand\s*(?:name)?)\s*[:=\-#]?\s*([a-z0-9\s\-]+?)(?:\r?\n|$|(?=\b(?:catalogue|catalog|price|rate|fabric|design|gst)\b))", 2, 0.85),
    (8, "fabric", "REGEX_FABRIC_LABELED",
     r"(?i)\b(?:saree\s*fabric|blouse\s*fabric|fabric|material)\s*[:=\-#]?\s*([a-z0-9\s\-]+?)(?:\r?\n|$|(?=\b(?:blouse|work|size|length|price|rate)\b))", 3, 0.85),
    (10, "gst_percent", "REGEX_GST_PERCENT",
     r"(?i)\b(?:gst|tax)\s*[:=\-#]?\s*(\d+(?:\.\d+)?)\s*%", 1, 0.95),
    (11, "total_designs", "REGEX_TOTAL_DESIGNS",
     r"(?i)\b(?:total\s*(?:designs?|pieces?|pcs?)|pack\s*of|set\s*of)\s*[:=\-#]?\s*(\d+)\s*(?:pcs?|pieces?|designs?)?", 1, 0.9),
]
PRICE_FACT_ORDER, KNOWN_FABRIC_ORDER, LABEL_LINE_ORDER = 5, 9, 12
KNOWN_FABRICS = [
    "munga handloom", "modal satin", "art silk", "crinkle silk", "cotton silk", "pure silk",
    "tussar silk", "banarasi silk", "banarasi", "georgette", "chiffon", "organza", "crepe",
    "linen", "rayon", "jacquard",
]
LABEL_LINE = r"^\s*([A-Za-z0-9][A-Za-z0-9\s/_\.]{1,40}?)\s*[:=\-–—]\s*(.*)$"
LABEL_KEYS_SKIPPED = ["price", "rate", "gst", "total_designs", "design_no", "d_no", "full_catalogue_price"]

# Price facts: (order, field, rule id, pattern, amount group, confidence).
CURRENCY_RUN = r"(?:[₹%¥$=:\-\s#@|/—–]|rs\.?|inr)*"
AMOUNT = r"(\d+(?:,\d{3})*(?:\.\d{1,2})?)"
UNIT_TAIL = r"(?:\/-|\/pc|\bper\s*(?:pc|piece)\b)?"
PRICE_RULES = [
    (1, "full_catalogue_price", "REGEX_FULL_CATALOGUE_PRICE",
     r"(?i)\b(?:full\s*(?:catalogue|catalog|set)?(?:\s*price)?|catalogue\s*price|catalog\s*price)\s*[:=\-#—–]?\s*"
     + CURRENCY_RUN + AMOUNT + r"\s*(?:\/-|\/pc|\bper\s*(?:pc|piece)\b|\(\d+\s*(?:pcs?|pieces?)\))?", 1, 0.9),
    (2, "single_piece_price", "REGEX_SINGLE_PIECE_PRICE",
     r"(?i)\b(?:single\s*piece(?:\s*(?:available|only))?|single\s*price|retail\s*price|single\s*rate|single)\s*[:=\-#—–]?\s*"
     + CURRENCY_RUN + AMOUNT + r"\s*(?:\/-|\/pc|\bper\s*(?:pc|piece)\b|\(\d+\s*(?:pcs?|pieces?|pe)\))?", 1, 0.9),
    (3, "wholesale_price", "REGEX_WHOLESALE_PRICE",
     r"(?i)\b(?:wholesale\s*(?:per\s*unit\s*)?(?:price|rate)|ws\s*price|w\.s\.?\s*price|wholesale)\s*[:=\-#—–]?\s*"
     + CURRENCY_RUN + AMOUNT + r"\s*" + UNIT_TAIL, 1, 0.9),
    (5, "price", "REGEX_PRICE_LABELED",
     r"(?i)\b(?:mrp|cost|price|rate)\s*[:=\-#—–]?\s*" + CURRENCY_RUN + AMOUNT + r"\s*" + UNIT_TAIL, 1, 0.85),
    (6, "price", "REGEX_CURRENCY_SYMBOL",
     r"(?i)(?:₹\s*|rs\.\s*|inr\s*)" + AMOUNT + r"\b(?!\s*%)", 1, 0.85),
]
BREAKDOWN_ORDER, BREAKDOWN_RULE, BREAKDOWN_CONFIDENCE = 4, "REGEX_BREAKDOWN_TOTAL_PRICE", 0.88
BREAKDOWN = (r"(?i)(\d+)\s*(?:pcs?|pieces?|pes?)\s*[xX*]\s*(?:[₹#@]\s*|2)?(\d+(?:,\d{3})*(?:\.\d{1,2})?)"
             r"\s*=\s*(?:[₹#@]\s*|2)?(\d+(?:,\d{3})*(?:\.\d{1,2})?)")
MARKED_AMOUNT = r"(?i)(?:[#@₹=]|rs\.?)\s*(\d+)\b"

# Colour vote.
CROP_RATIO, CROP_TOP, SMALL_SIDE = 0.6, 0.30, 10
MIN_CHROMA, MIN_VALUE, MAX_VALUE = 0.12, 0.12, 0.95
PALE_MAX_CHROMA, PALE_MIN_VALUE, PALE_HUE_LOW, PALE_HUE_HIGH = 0.28, 0.48, 18.0, 55.0
CHROMATIC_SHARE, VALID_SHARE, NEUTRAL_CONFIDENCE = 0.10, 0.15, 0.65
TOP_SHARE, TOP_LEAD, VOTE_SCALE = 0.35, 0.15, 1.2
COLOUR_FAMILIES = {
    "Red": "Red/Maroon", "Maroon": "Red/Maroon",
    "Rust": "Rust/Orange", "Orange": "Rust/Orange", "Brown": "Rust/Orange",
    "Navy Blue": "Blue/Navy Blue", "Blue": "Blue/Navy Blue",
    "Teal": "Teal", "Green": "Green", "Olive": "Green",
    "Yellow": "Yellow/Mustard", "Mustard": "Yellow/Mustard",
    "Purple": "Purple/Pink", "Magenta": "Purple/Pink", "Pink": "Purple/Pink",
}
# ------------------------------------------------------------ end fixed values

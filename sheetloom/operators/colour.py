"""Dominant colour of images, voted over a pixel table.

``pixels(run_id, image_id, width, height, x, y, r, g, b)``.  A pixel is judged on
its own; images are counted per colour name first, so a picture with very many
pixels is combined on the map side.  Ties go to the first name in the alphabet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sheetloom import fixed_values as fv

IMAGE = ["run_id", "image_id"]


def is_inside() -> Column:
    """Pixels of the central part; lower for tall images. Images that are too small have none."""
    w, h = F.col("width"), F.col("height")
    cw, ch = F.floor(w * fv.CROP_RATIO), F.floor(h * fv.CROP_RATIO)
    left = F.floor((w - cw) / 2)
    top = F.least(F.when(h > 100, F.floor(h * fv.CROP_TOP)).otherwise(F.floor((h - ch) / 2)), h - ch)
    inside = (F.col("x") >= left) & (F.col("x") < left + cw) & (F.col("y") >= top) & (F.col("y") < top + ch)
    return (w >= fv.SMALL_SIDE) & (h >= fv.SMALL_SIDE) & inside


def crop(pixels: DataFrame) -> DataFrame:
    return pixels.where(is_inside())


def with_hsv(pixels: DataFrame) -> DataFrame:
    """Hue in degrees, saturation, value, and the masks made from them."""
    r, g, b = F.col("r"), F.col("g"), F.col("b")
    measured = pixels.withColumns({"top": F.greatest(r, g, b), "low": F.least(r, g, b)})
    delta, top = F.col("top") - F.col("low"), F.col("top")
    turn = (g - b) / delta
    hue = (F.when(delta == 0, F.lit(0.0)).when(top == r, F.when(turn < 0, turn + 6.0).otherwise(turn))
           .when(top == g, (b - r) / delta + 2.0).otherwise((r - g) / delta + 4.0)) * 60.0
    coloured = measured.withColumns({
        "h": hue, "s": F.when(top > 0, delta / top).otherwise(F.lit(0.0)), "v": top / 255.0})
    h, s, v = F.col("h"), F.col("s"), F.col("v")
    pale = ((s < fv.PALE_MAX_CHROMA) & (v > fv.PALE_MIN_VALUE) & (h >= fv.PALE_HUE_LOW) & (h <= fv.PALE_HUE_HIGH))
    valid = coloured.withColumn("is_valid", (v >= fv.MIN_VALUE) & (v <= fv.MAX_VALUE) & ~pale)
    return valid.withColumn("is_chromatic", F.col("is_valid") & (s >= fv.MIN_CHROMA))


def colour_name() -> Column:
    """Colour word of a pixel from its hue, saturation and value."""
    h, s, v = F.col("h"), F.col("s"), F.col("v")
    return (F.when((h >= 345) | (h <= 15), F.when((v < 0.40) & (s > 0.40), F.lit("Maroon")).otherwise(F.lit("Red")))
            .when(h <= 45, F.when(v >= 0.55, F.lit("Orange")).when(s >= 0.25, F.lit("Rust")).otherwise(F.lit("Brown")))
            .when(h <= 70, F.when(s <= 0.30, F.lit("Beige")).when((v < 0.65) & (h < 55), F.lit("Mustard"))
                  .otherwise(F.lit("Yellow")))
            .when(h <= 85, F.lit("Olive")).when(h <= 165, F.lit("Green")).when(h <= 195, F.lit("Teal"))
            .when(h <= 255, F.when(v < 0.50, F.lit("Navy Blue")).otherwise(F.lit("Blue")))
            .when(h <= 295, F.lit("Purple")).when(h <= 325, F.lit("Magenta")).otherwise(F.lit("Pink")))


def family(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in fv.COLOUR_FAMILIES.items() for x in kv])
    return F.coalesce(F.try_element_at(table, name), name)


def _all_counts(pixels: DataFrame) -> DataFrame:
    """Per image and colour: pixels inside the crop, and the image's shorter side.

    The null colour holds the pixels without a vote and those outside, so that
    every image has a row.
    """
    inside = F.col("inside")
    judged = with_hsv(pixels.withColumn("inside", is_inside()))
    name = F.when(inside & F.col("is_chromatic"), colour_name())

    def total(x: Column) -> Column:
        return F.sum(F.when(inside, x).otherwise(F.lit(0)))

    return (judged.groupBy(*IMAGE, name.alias("colour")).agg(
        F.count_if(inside).alias("n"), F.count_if(inside & F.col("is_valid")).alias("n_valid"),
        F.count_if(inside & F.col("is_chromatic")).alias("n_voting"),
        total(F.when(F.col("is_valid"), F.col("top")).otherwise(F.lit(0))).alias("sum_value"),
        *[total(F.col(x)).alias(f"sum_{x}") for x in ("r", "g", "b")], F.min(F.least("width", "height")).alias("side"))
        .withColumn("family", family(F.col("colour"))))


def colour_counts(pixels: DataFrame) -> DataFrame:
    """Pixels per image and colour; the null colour holds the pixels without a vote."""
    return _all_counts(pixels).where(F.col("n") > 0).drop("side")


def _hundredths(n: Column, total: Column, scale: int) -> Column:
    """n / total * scale in hundredths, halves to even, without fractions."""
    part = n * F.lit(scale)
    whole = F.floor(part / total).cast("bigint")
    rest = (part - whole * total) * 2
    up = (rest > total) | ((rest == total) & (whole % 2 == 1))
    return (whole + up.cast("int")) / F.lit(100.0)


def _hex(*parts: Column) -> Column:
    return F.concat(F.lit("#"), *[F.lower(F.lpad(F.hex(p.cast("bigint")), 2, "0")) for p in parts])


def dominant(pixels: DataFrame) -> DataFrame:
    """One colour result per image."""
    counts = _all_counts(pixels)
    totals = counts.groupBy(*IMAGE).agg(
        F.min("side").alias("side"), F.sum("n").alias("total"), F.sum("n_valid").alias("valid"), F.sum("sum_value").alias("sum_value"),
        F.coalesce(F.sum("n_voting"), F.lit(0)).alias("chromatic"))
    votes = counts.where(F.col("n_voting") > 0)  # a filter on the count stays above the aggregate
    families = votes.groupBy(*IMAGE, "family").agg(
        F.sum("n").alias("votes"),
        F.min(F.struct((-F.col("n")).alias("o"), "colour", "n", "sum_r", "sum_g", "sum_b")).alias("best"))
    order = Window.partitionBy(*IMAGE).orderBy(F.desc("votes"), "family")
    ranked = (families.withColumn("place", F.row_number().over(order))
              .withColumn("second", F.lead(F.struct("family", "votes")).over(order)).where(F.col("place") == 1))
    j = totals.join(ranked, IMAGE, "left")
    total, chroma, votes_ = F.col("total"), F.col("chromatic"), F.col("votes")
    tiny = F.col("side") < fv.SMALL_SIDE
    empty = total == 0
    neutral = chroma < total * fv.CHROMATIC_SHARE
    background = neutral & (F.col("valid") < total * fv.VALID_SHARE)
    value = F.col("sum_value") / F.nullif("valid", F.lit(0))
    tone = F.when(value > 0.75 * 255, F.lit("White")).when(value < 0.25 * 255, F.lit("Black")).otherwise(F.lit("Grey"))
    lead = votes_ - F.coalesce(F.col("second.votes"), F.lit(0))
    unsure = (votes_ < chroma * fv.TOP_SHARE) | (F.col("second").isNotNull() & (lead < chroma * fv.TOP_LEAD))
    status = (F.when(tiny | empty, F.lit("FAILED")).when(background, F.lit("BACKGROUND_ONLY"))
              .when(neutral, F.lit("EXTRACTED")).when(unsure, F.lit("UNCERTAIN")).otherwise(F.lit("EXTRACTED")))
    grey = F.floor(value)
    best = F.col("best")
    mean = [F.floor(best[f"sum_{x}"] / best["n"]) for x in ("r", "g", "b")]

    def percent(n: Column) -> Column:
        return F.floor(n * 100 / chroma).cast("string")

    notes = (
        F.when(tiny, F.lit("Image dimensions too small for reliable color analysis"))
        .when(empty, F.lit("No pixels inside the crop"))
        .when(background, F.lit("Image consists almost entirely of extreme highlights or shadows"))
        .when(neutral, F.concat(F.lit("Low-saturation neutral palette identified as "), tone))
        .when(unsure & F.col("second").isNotNull(), F.concat(
            F.lit("Multi-tonal image: '"), F.col("family"), F.lit("' ("), percent(votes_), F.lit("%) vs '"),
            F.col("second.family"), F.lit("' ("), percent(F.col("second.votes")), F.lit("%); requires manual review")))
        .when(unsure, F.concat(F.lit("Low dominant color confidence ("), percent(votes_),
                               F.lit("%); requires manual review")))
        .otherwise(F.concat(F.lit("Dominant color '"), best["colour"], F.lit("' accounts for "), percent(votes_),
                            F.lit("% of foreground palette"))))
    sure = status == "EXTRACTED"
    confidence = (F.when(status.isin("FAILED", "BACKGROUND_ONLY"), F.lit(0.0))
                  .when(neutral, F.lit(fv.NEUTRAL_CONFIDENCE)).when(unsure, _hundredths(votes_, chroma, 100))
                  .otherwise(F.least(F.lit(1.0), _hundredths(votes_, chroma, 120))))
    return j.select(
        *IMAGE, status.alias("status"), F.when(sure, F.when(neutral, tone).otherwise(best["colour"])).alias("canonical_color"),
        F.when(sure, F.when(neutral, _hex(grey, grey, grey)).otherwise(_hex(*mean))).alias("hex_code"),
        confidence.alias("confidence"), status.isin("UNCERTAIN", "BACKGROUND_ONLY").alias("is_ambiguous"),
        notes.alias("notes"))

"""Detected boxes on images, grids of items, and plans for image files. Windows are per image, row or sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Lengths below are shares of a reference image of this height.
REFERENCE_HEIGHT = 1050.0
#: Height of a card on the table.
CARD_HEIGHT = 3.062473


def filter_boxes(boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """WIN-12: boxes (image_id, x_px, z_px, w_px, h_px, img_w, img_h, solidity, corners) to (kept, discarded), with the
    centre (x, z) in units of the table, from the image's centre: nearly square, of plausible size and shape, at the left."""
    shape = F.col("w_px") / F.col("h_px")
    unit = F.lit(CARD_HEIGHT) / F.col("img_h")
    told = boxes.withColumn("x", (F.col("x_px") + F.col("w_px") / 2 - F.col("img_w") / 2) * unit).withColumn("z", (F.col("z_px") + F.col("h_px") / 2 - F.col("img_h") / 2) * unit)
    size = [(F.col(c) / F.col("img_h") > 20 / REFERENCE_HEIGHT) & (F.col(c) / F.col("img_h") < 45 / REFERENCE_HEIGHT) for c in ("w_px", "h_px")]
    good = (
        (shape > 0.9) & (shape < 1.1) & size[0] & size[1]
        & (F.col("solidity") > 0.7) & F.col("corners").between(3, 10) & (F.col("x") > -0.9) & (F.col("x") < -0.5)
    )
    return told.where(good), told.where(~F.coalesce(good, F.lit(False)))


def group_rows(boxes: DataFrame, threshold: float = 0.03) -> DataFrame:
    """WIN-9, SRT-3: boxes with `row`, from 0: by z, a new row where the step is over the threshold (for an image of the
    reference height, in proportion for others)."""
    w = Window.partitionBy("image_id").orderBy("z", "x", "w_px", "h_px")
    new = F.coalesce((F.abs(F.col("z") - F.lag("z").over(w)) > F.col("img_h") * (threshold / REFERENCE_HEIGHT)).cast("int"), F.lit(0))
    return boxes.withColumn("__new", new).withColumn("row", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def row_gaps(rows: DataFrame) -> DataFrame:
    """Boxes with `gap`, the step in x to the one before in the row (null for the first)."""
    w = Window.partitionBy("image_id", "row").orderBy("x", "z", "w_px", "h_px")
    return rows.withColumn("gap", F.col("x") - F.lag("x").over(w))


def prune_tails(rows: DataFrame, limit: float = 1.1) -> DataFrame:
    """WIN-10: in each row the boxes before the first gap over `limit` times the image's median gap; a median of 0 (or
    none) prunes nothing."""
    gaps = row_gaps(rows)
    medians = gaps.groupBy("image_id").agg(F.median("gap").alias("median_gap"))
    w = Window.partitionBy("image_id", "row").orderBy("x", "z", "w_px", "h_px").rowsBetween(Window.unboundedPreceding, 0)
    far = F.coalesce((F.col("median_gap") > 0) & (F.col("gap") / F.nullif("median_gap", F.lit(0.0)) > limit), F.lit(False)).cast("int")
    return gaps.join(medians, "image_id").withColumn("__far", F.max(far).over(w)).where("__far = 0").drop("__far")


def prune_row_starts(rows: DataFrame, limit: float = 0.07) -> DataFrame:
    """WIN-11: rows whose smallest x lies within the limit of the mean of the image's row starts."""
    starts = rows.groupBy("image_id", "row").agg(F.min("x").alias("start"), F.max("img_h").alias("img_h"))
    near = F.abs(F.col("start") - F.avg("start").over(Window.partitionBy("image_id"))) <= F.col("img_h") * (limit / REFERENCE_HEIGHT)
    kept = starts.withColumn("near", near).where("near").select("image_id", "row")
    return rows.join(kept, ["image_id", "row"], "left_semi")


def box_statistics(rows: DataFrame) -> DataFrame:
    """AGG-7: per image: rows, boxes, mean and median row start, mean and median gap, and the published start (mean
    start less 0.775 mean gaps)."""
    gaps = row_gaps(rows.drop("gap", "median_gap"))
    starts = gaps.groupBy("image_id", "row").agg(F.min("x").alias("start"), F.count(F.lit(1)).alias("n"))
    per_row = starts.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("n").alias("n_boxes"), F.avg("start").alias("mean_start"), F.median("start").alias("median_start"))
    per_gap = gaps.groupBy("image_id").agg(F.avg("gap").alias("mean_gap"), F.median("gap").alias("median_gap"))
    both = per_row.join(per_gap, "image_id")
    return both.withColumn("published_start", F.col("mean_start") - 0.775 * F.coalesce("mean_gap", F.lit(0.0)))


def row_statistics(rows: DataFrame) -> DataFrame:
    """AGG-7: per row: boxes and median z."""
    return rows.groupBy("image_id", "row").agg(F.count(F.lit(1)).alias("n_boxes"), F.median("z").alias("median_z"))


def grid_layout(items: DataFrame, columns: int, rows: int) -> DataFrame:
    """WIN-13, SRT-4: items (sheet, ord, width, height) at (x, y): the first columns x rows of each sheet in order, in
    cells of the first item's size."""
    w = Window.partitionBy("sheet").orderBy("ord")
    placed = items.withColumn("i", F.row_number().over(w) - 1).where(F.col("i") < columns * rows)
    first = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("cell_w", F.first("width").over(first)).withColumn("cell_h", F.first("height").over(first))
    return placed.select("sheet", "ord", "i", (F.col("i") % columns * F.col("cell_w")).alias("x"), (F.floor(F.col("i") / columns) * F.col("cell_h")).alias("y"))


def plan_images(images: DataFrame, target_width: int, target_height: int, max_border: int = 25, base_number: int = 0) -> DataFrame:
    """WIN-14: images (path, width, height, border_left, border_top, border_right, border_bottom, number) with the plan:
    rotated, size (0 keeps the ratio; both 0 keep all), centred crop box, skipped (a border over the limit), name."""
    wide = F.col("width") > F.col("height")
    w, h = F.col("width"), F.col("height")
    out_w = F.when(F.lit(target_width == 0 and target_height == 0), w).when(F.lit(target_width == 0), F.floor(w * target_height / h)).otherwise(F.lit(target_width))
    out_h = F.when(F.lit(target_width == 0 and target_height == 0), h).when(F.lit(target_height == 0), F.floor(h * target_width / w)).otherwise(F.lit(target_height))
    border = F.greatest("border_left", "border_top", "border_right", "border_bottom")
    number = (F.col("number") + base_number).cast("string")
    planned = images.select(
        "path", wide.alias("rotated"), out_w.cast("bigint").alias("out_width"), out_h.cast("bigint").alias("out_height"), (border > max_border).alias("skipped"),
        F.lpad(number, F.greatest(F.length(number), F.lit(5)), F.lit("0")).alias("new_stem"), "width", "height",
    )
    left = F.floor((F.col("width") - F.col("out_width")) / 2)
    top = F.floor((F.col("height") - F.col("out_height")) / 2)
    return planned.select("path", "rotated", "out_width", "out_height", left.alias("crop_left"), top.alias("crop_top"), "skipped", "new_stem")

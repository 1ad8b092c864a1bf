"""Intensity and texture features of image volumes held as image rows.

A volume is one row ``(subject_id, z, x, values)`` per line of voxels along y, ``values[y]`` being NULL or NaN where there is
none. ``lines_of`` makes such rows of a long voxel table ``(subject_id, x, y, z, value)``; every operator takes either
form. Headers are ``(subject_id, t1_path, zoom_x, zoom_y, zoom_z)``. Everything about intensities is computed from counts
per distinct value, and neighbours meet inside their row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.config import VolumeConfig
from cohortweave.functions.ordering import percentiles_of_counts, value_counts
from cohortweave.functions.skew import lookup_join
from cohortweave.schemas import SUBJECT_ERRORS

TEXTURE_METRICS = ("contrast", "homogeneity", "energy", "correlation")


def _finite(value: str) -> str:
    return f"({value} IS NOT NULL AND NOT isnan({value}) AND abs({value}) < double('infinity'))"


def lines_of(voxels: DataFrame) -> DataFrame:
    """Image rows of a long voxel table; image rows stay as they are.

    Voxels without a row are NULL, and so are the ends of shorter lines. Of several rows of one voxel the first in
    order of value counts. Rows without a subject or a place belong to no line.
    """
    if "values" in voxels.columns:
        return voxels
    cells = (
        voxels.dropna(subset=["subject_id", "x", "y", "z"])
        .groupBy("subject_id", "z", "x")
        .agg(F.expr("array_sort(collect_list(struct(y AS y, cast(value AS float) AS v))) AS cells"))
    )
    even = "cells[0].y = 0 AND cells[size(cells) - 1].y = size(cells) - 1 AND NOT exists(sequence(0, size(cells) - 1), k -> cells[k].y <> k)"
    found = "map_from_entries(filter(transform(cells, (c, k) -> if(k = 0 OR cells[k - 1].y <> c.y, c, null)), c -> c IS NOT NULL))"
    return cells.selectExpr("*", f"CASE WHEN NOT ({even}) THEN {found} END AS place").selectExpr(
        "subject_id",
        "z",
        "x",
        "if(place IS NULL, transform(cells, c -> c.v), transform(sequence(0, array_max(map_keys(place))), k -> try_element_at(place, k))) AS values",
    )


def geometry(voxels: DataFrame, headers: DataFrame) -> DataFrame:
    """Shape, voxel sizes and the share of non-finite voxels per subject. Voxels count up to the end of their line."""
    shape = (
        lines_of(voxels)
        .selectExpr("subject_id", "x", "z", "size(values) AS n", f"size(filter(values, v -> {_finite('v')})) AS good")
        .groupBy("subject_id")
        .agg(
            F.expr("max(x) + 1 AS shape_x"),
            F.expr("max(n) AS shape_y"),
            F.expr("max(z) + 1 AS shape_z"),
            F.expr("sum(n) AS voxel_count"),
            F.expr("1 - sum(good) / sum(n) AS image_nan_fraction"),
        )
    )
    return headers.join(shape, "subject_id", "left").selectExpr(
        "subject_id",
        "t1_path",
        "shape_x",
        "shape_y",
        "shape_z",
        "zoom_x AS voxel_size_x",
        "zoom_y AS voxel_size_y",
        "zoom_z AS voxel_size_z",
        "zoom_x * zoom_y * zoom_z AS voxel_volume",
        "coalesce(voxel_count, 0) AS voxel_count",
        "coalesce(image_nan_fraction, 1.0) AS image_nan_fraction",
    )


def foreground_counts(voxels: DataFrame, config: VolumeConfig = VolumeConfig()) -> tuple[DataFrame, DataFrame]:
    """Counts of distinct foreground values, and the threshold of each subject.

    Foreground means strictly above the configured percentile of finite values. Equal values meet before they leave
    a task.
    """
    values = lines_of(voxels).selectExpr("subject_id", "explode(values) AS value")
    counts = value_counts(values, ["subject_id"], "value")
    thresholds = percentiles_of_counts(
        counts, ["subject_id"], [config.foreground_percentile / 100.0], ["threshold"]
    )
    return lookup_join(counts, thresholds, ["subject_id"], "inner").filter("value > threshold"), thresholds


def intensity_summary(foreground: DataFrame) -> DataFrame:
    """Mean, population deviation, percentiles and extremes of ``(subject_id, value, n, threshold)``."""
    # Moments are taken around the threshold so that large offsets cancel out.
    moments = foreground.groupBy("subject_id").agg(
        F.expr("sum(n) AS foreground_voxel_count"),
        F.expr("max(threshold) AS threshold"),
        F.expr("sum(n * (value - threshold)) / sum(n) AS shift"),
        F.expr("sum(n * (value - threshold) * (value - threshold)) / sum(n) AS square"),
        F.expr("min(value) AS low"),
        F.expr("max(value) AS high"),
    )
    points = percentiles_of_counts(foreground, ["subject_id"], [0.1, 0.5, 0.9], ["p10", "p50", "p90"])
    return moments.join(points, "subject_id").selectExpr(
        "subject_id",
        "foreground_voxel_count",
        "threshold + shift AS t1_intensity_mean",
        "sqrt(greatest(square - shift * shift, 0.0D)) AS t1_intensity_std",
        "p10 AS t1_intensity_p10",
        "p50 AS t1_intensity_p50",
        "p90 AS t1_intensity_p90",
        "low AS t1_intensity_min",
        "high AS t1_intensity_max",
    )


def texture_limits(thresholds: DataFrame, intensities: DataFrame) -> DataFrame:
    """``(subject_id, threshold, low, high)`` per subject with any foreground."""
    # Reading the count keeps every use of the value counts the same plan.
    bounds = intensities.filter("foreground_voxel_count > 0").selectExpr(
        "subject_id", "t1_intensity_min AS low", "t1_intensity_max AS high"
    )
    return thresholds.join(bounds, "subject_id")


def texture_slices(voxels: DataFrame, limits: DataFrame, config: VolumeConfig = VolumeConfig()) -> DataFrame:
    """The slices used for texture: the middle ones among slices with any foreground, or all without a maximum.

    ``limits`` is ``(subject_id, threshold, low, high)``. A subject with one single
    foreground value has no texture.
    """
    line = lines_of(voxels).selectExpr("subject_id", "z", f"array_max(filter(values, v -> {_finite('v')})) AS peak")
    peaks = line.groupBy("subject_id", "z").agg(F.expr("max(peak) AS peak"))
    found = peaks.join(limits.filter("low < high"), "subject_id").filter("peak > threshold")
    chosen = found
    if config.max_slices is not None:
        half = max(config.max_slices // 2, 0)
        # One row per slice, so a window over a subject sees its slice count only.
        chosen = (
            found.selectExpr(
                "*",
                "row_number() OVER (PARTITION BY subject_id ORDER BY z) - 1 AS place",
                "count(1) OVER (PARTITION BY subject_id) AS slices",
            )
            .selectExpr("*", f"greatest(0, floor(slices / 2) - {half}) AS first_place")
            .filter(f"place BETWEEN first_place AND floor(slices / 2) + {half}")
            .filter(f"place < first_place + {int(config.max_slices)}")
        )
    return chosen.select("subject_id", "z", "threshold", "low", "high")


def cooccurrence(voxels: DataFrame, slices: DataFrame, config: VolumeConfig = VolumeConfig()) -> DataFrame:
    """Directed co-occurrence counts ``(subject_id, z, i, j, n)`` of neighbours along y.

    Both neighbours must be foreground. Levels are computed in single precision, the precision of the volumes. A line's
    pairs are formed in its row and counted before they leave the task.
    """
    scaled = "cast((cast(v AS float) - cast(low AS float)) / cast(high - low AS float) AS float)"
    level = f"cast(floor(least(greatest({scaled}, float(0)), float(1)) * float({int(config.levels) - 1})) AS int)"
    graded = lookup_join(lines_of(voxels), slices, ["subject_id", "z"], "inner").selectExpr(
        "subject_id", "z", f"transform(values, v -> CASE WHEN {_finite('v')} AND v > threshold THEN {level} END) AS i"
    )
    pairs = graded.selectExpr("subject_id", "z", "i", "slice(i, 2, size(i)) AS j").selectExpr("subject_id", "z", "inline(arrays_zip(i, j))")
    return pairs.filter("i IS NOT NULL AND j IS NOT NULL").groupBy("subject_id", "z", "i", "j").agg(F.expr("count(1) AS n"))


def slice_texture(pairs: DataFrame) -> DataFrame:
    """Contrast, homogeneity, energy and correlation per slice.

    A slice has at most levels x levels pair rows. Sums run over integers, so the
    moments are exact before the final divisions.
    """
    sums = pairs.groupBy("subject_id", "z").agg(
        F.expr("sum(n) AS s"),
        F.expr("sum(n * (i - j) * (i - j)) AS diff2"),
        F.expr("sum(n / (1.0D + abs(i - j))) AS near"),
        F.expr("sum(cast(n AS double) * n) AS square"),
        F.expr("sum(n * i) AS si"),
        F.expr("sum(n * j) AS sj"),
        F.expr("sum(n * i * i) AS sii"),
        F.expr("sum(n * j * j) AS sjj"),
        F.expr("sum(n * i * j) AS sij"),
    )
    spread = "(cast(s AS decimal(38, 0)) * {0} - cast({1} AS decimal(38, 0)) * {2})"
    return sums.selectExpr(
        "subject_id",
        "z",
        "diff2 / s AS contrast",
        "near / s AS homogeneity",
        "sqrt(square) / s AS energy",
        f"cast({spread.format('sii', 'si', 'si')} AS double) AS vi",
        f"cast({spread.format('sjj', 'sj', 'sj')} AS double) AS vj",
        f"cast({spread.format('sij', 'si', 'sj')} AS double) AS cov",
    ).selectExpr(
        "subject_id",
        "z",
        "contrast",
        "homogeneity",
        "energy",
        "CASE WHEN vi = 0 OR vj = 0 THEN 0.0D ELSE cov / (sqrt(vi) * sqrt(vj)) END AS correlation",
    )


def texture_summary(slice_metrics: DataFrame) -> DataFrame:
    """Mean and population deviation of each metric over a subject's slices."""
    return slice_metrics.groupBy("subject_id").agg(
        *[
            F.expr(f"{function}({metric}) AS glcm_{metric}_{stat}")
            for metric in TEXTURE_METRICS
            for stat, function in (("mean", "avg"), ("std", "stddev_pop"))
        ]
    )


def texture(voxels: DataFrame, limits: DataFrame, config: VolumeConfig = VolumeConfig()) -> DataFrame:
    slices = texture_slices(voxels, limits, config)
    return texture_summary(slice_texture(cooccurrence(voxels, slices, config)))


def volume_features(
    voxels: DataFrame,
    headers: DataFrame,
    config: VolumeConfig = VolumeConfig(),
    participants: DataFrame | None = None,
) -> DataFrame:
    """One row per header with geometry, foreground, intensity and texture features."""
    voxels = lines_of(voxels)
    shapes = geometry(voxels, headers)
    foreground, thresholds = foreground_counts(voxels, config)
    intensities = intensity_summary(foreground)
    limits = texture_limits(thresholds, intensities)
    features = (
        shapes.join(intensities, "subject_id", "left")
        .join(texture(voxels, limits, config), "subject_id", "left")
        .selectExpr(
            "subject_id",
            "t1_path",
            "shape_x",
            "shape_y",
            "shape_z",
            "voxel_size_x",
            "voxel_size_y",
            "voxel_size_z",
            "voxel_volume",
            "coalesce(foreground_voxel_count, 0) AS foreground_voxel_count",
            "coalesce(foreground_voxel_count, 0) * voxel_volume AS foreground_volume",
            "coalesce(foreground_voxel_count / nullif(voxel_count, 0), 0.0) AS foreground_fraction",
            "image_nan_fraction",
            *[f"t1_intensity_{s}" for s in ("mean", "std", "p10", "p50", "p90", "min", "max")],
            *[f"glcm_{m}_{s}" for m in TEXTURE_METRICS for s in ("mean", "std")],
        )
    )
    return features if participants is None else join_participants(features, participants)


def low_foreground_notes(features: DataFrame, config: VolumeConfig = VolumeConfig()) -> DataFrame:
    """Subjects whose foreground is below the configured minimum."""
    return features.filter(f"foreground_voxel_count < {int(config.min_foreground_voxels)}").selectExpr(
        "subject_id", "foreground_voxel_count", "'foreground voxel count below configured minimum' AS note"
    )


def join_participants(features: DataFrame, participants: DataFrame) -> DataFrame:
    """Left join of participant columns; without a key column features stay as they are."""
    if "participant_id" in participants.columns:
        participants = participants.withColumnRenamed("participant_id", "subject_id")
    if "subject_id" not in participants.columns:
        return features
    # Shared names get the suffixes that a two-sided merge gives them.
    shared = [c for c in participants.columns if c in features.columns and c != "subject_id"]
    left = features.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = participants.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return left.join(right, "subject_id", "left")


def missing_image_errors(inventory: DataFrame) -> DataFrame:
    """Error rows of subjects without an image."""
    return inventory.filter("has_t1 IS NOT TRUE OR t1_path IS NULL").selectExpr(
        "cast(subject_id AS string) AS subject_id",
        "'missing_t1' AS error_type",
        "'subject has no discovered T1w image' AS error_message",
    )


def all_errors(*errors: DataFrame) -> DataFrame:
    names = [f.name for f in SUBJECT_ERRORS]
    return reduce(DataFrame.unionByName, [e.select(*names) for e in errors])


def subject_counts(features: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Row, subject and error counts as one row."""
    if "subject_id" in features.columns:
        subjects = "count(DISTINCT subject_id)"
    else:
        subjects = "count(1)"
    counts = features.agg(F.expr("count(1) AS row_count"), F.expr(f"{subjects} AS subject_count"))
    error_count = F.lit(0) if errors is None else errors.agg(F.expr("count(1) AS n")).scalar()
    return counts.withColumn("error_count", error_count.cast("bigint"))

"""Amplitude, quality and spectral features of signals.

A signal is held as segments ``(patient_id, recording_id, edf_path, channel, start, sfreq, values)``: one row
per stretch of at most ``SEGMENT`` samples of a channel, ``start`` being the place of its first sample. Missing samples are
NULL or NaN entries. Each channel has its own rate. ``segments_of`` makes segments of a long sample table ``(..., channel,
sample_idx, value, sfreq)`` with one row for each sample; every operator takes either form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.config import BANDS, SignalConfig
from cohortweave.functions.ordering import percentiles_of_counts
from cohortweave.operators import spectrum

RECORDING = ["patient_id", "recording_id"]
SEGMENT = 65_536  # samples per segment made here


def _finite(value: str) -> str:
    return f"({value} IS NOT NULL AND NOT isnan({value}) AND abs({value}) < double('infinity'))"


def segments_of(samples: DataFrame) -> DataFrame:
    """Segments of a long sample table; segments stay as they are.

    Rows without a recording, channel or place belong to no segment. A place without a row ends a segment, and of
    several rows of one place all stay, so their values count, and the line length skips between them.
    """
    if "values" in samples.columns:
        return samples
    place = f"sample_idx div {SEGMENT}"
    runs = (
        samples.dropna(subset=[*RECORDING, "channel", "sample_idx"])
        .groupBy(*RECORDING, "channel", F.expr(place).alias("_piece"))
        .agg(
            F.expr("max(edf_path) AS edf_path"),
            F.expr("max(sfreq) AS sfreq"),
            F.expr("array_sort(collect_list(struct(sample_idx AS i, cast(value AS double) AS v))) AS cells"),
        )
    )
    # Places where a new segment starts inside the piece: at its first sample and behind each gap.
    starts = "filter(transform(cells, (c, k) -> if(k = 0 OR c.i <> cells[k - 1].i + 1, k, cast(null AS int))), k -> k IS NOT NULL) AS starts"
    whole = runs.selectExpr("*", f"if(cells[size(cells) - 1].i - cells[0].i = size(cells) - 1, array(0), null) AS even").selectExpr(
        "*", f"coalesce(even, {starts.removesuffix(' AS starts')}) AS starts"
    )
    cut = whole.selectExpr("*", "posexplode(starts) AS (n, first)").selectExpr(
        *RECORDING,
        "edf_path",
        "channel",
        "cells[first].i AS start",
        "sfreq",
        "transform(slice(cells, first + 1, coalesce(get(starts, n + 1), size(cells)) - first), c -> c.v) AS values",
    )
    return cut


def _channels(segments: DataFrame, config: SignalConfig) -> DataFrame:
    return segments if config.channel_limit is None else segments.filter(f"channel < {int(config.channel_limit)}")


def _cut(config: SignalConfig) -> str:
    """SQL: the values inside the configured time."""
    if not config.max_seconds:
        return "values"
    room = f"cast(floor({float(config.max_seconds)}D * sfreq) AS bigint) - start"
    return f"slice(values, 1, cast(greatest(0, least(size(values), {room})) AS int))"


def kept_samples(samples: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """The first channels and seconds that the settings allow, as segments; 0 or None means no limit."""
    segments = _channels(segments_of(samples), config)
    cut = segments.selectExpr(*[c if c != "values" else f"{_cut(config)} AS values" for c in segments.columns])
    return cut.filter("size(values) > 0") if config.max_seconds else cut


def recording_moments(samples: DataFrame, config: SignalConfig = SignalConfig(), steps: bool = False) -> DataFrame:
    """Shape, moments and quality of each recording in one aggregation.

    Moments are over all finite kept samples (NULL when there are none); missing samples stay in the denominator of the
    quality shares. ``truncated`` tells that the recording was longer than the configured maximum; its duration is
    that of its longest channel, and its sampling frequency the highest.

    Samples are read where their segments lie: only sums leave a task. With ``steps`` the line length is added, the mean
    absolute first difference inside each channel; differences between neighbouring segments come from their edges.
    """
    segments = _channels(segments_of(samples), config)
    limit = f"{float(config.max_seconds)}D" if config.max_seconds else "duration"
    shape = [*RECORDING, "edf_path", "channel", "sfreq", "stop"]
    cut = segments.selectExpr(*shape[:-1], "start", "start + size(values) AS stop", f"{_cut(config)} AS values")
    # Each sample, beside its successor; the last one of a segment has none.
    both = cut.selectExpr(*shape, "size(values) AS n", "values AS value", "slice(values, 2, size(values)) AS after")
    cells = both.selectExpr(*shape, "n", f"inline_outer(arrays_zip(value{', after' if steps else ''}))")
    good = f"CASE WHEN {_finite('value')} THEN value END"
    step = f"CASE WHEN {_finite('value')} AND {_finite('after')} THEN abs(after - value) END" if steps else "0D"
    found = (
        cells.selectExpr("*", f"{good} AS good", f"{step} AS step")
        .groupBy(*RECORDING)
        .agg(
            F.expr("max(edf_path) AS edf_path"),
            F.expr("max(sfreq) AS sampling_frequency_hz"),
            F.expr("coalesce(max(stop / nullif(sfreq, 0)), 0.0D) AS duration"),
            # Channels are numbered from zero without gaps.
            F.expr("cast(max(channel) + 1 AS bigint) AS channel_count"),
            F.expr("avg(good) AS mean_signal_amplitude"),
            F.expr("stddev_pop(good) AS std_signal_amplitude"),
            F.expr("avg(abs(good)) AS signal_abs_mean"),
            F.expr("sqrt(avg(good * good)) AS signal_rms"),
            F.expr("coalesce(count(good) / nullif(count_if(n > 0), 0), 0.0D) AS finite_sample_fraction"),
            F.expr("coalesce(count_if(value = 0) / nullif(count_if(n > 0), 0), 0.0D) AS zero_sample_fraction"),
            *([F.expr("coalesce(sum(step), 0D) AS _steps"), F.expr("count(step) AS _n")] if steps else []),
        )
        .selectExpr("*", f"least(duration, {limit}) AS recording_duration_seconds", f"duration > {limit} AS truncated")
    )
    if not steps:
        return found
    mean = "(_steps + coalesce(_between, 0D)) / nullif(_n + coalesce(_edges, 0), 0) AS signal_line_length_mean"
    own = [c for c in found.columns if c not in ("_steps", "_n")]
    return found.join(_edge_steps(cut), RECORDING, "left").selectExpr(*own, mean)


def _edge_steps(kept: DataFrame) -> DataFrame:
    """Sum and number of the finite differences between neighbouring segments. One row per segment is ordered, not the samples."""
    edges = kept.filter("size(values) > 0").selectExpr(
        *RECORDING, "channel", "start", "start + size(values) AS stop", "values[0] AS first", "values[size(values) - 1] AS last"
    )
    over = "OVER (PARTITION BY patient_id, recording_id, channel ORDER BY start)"
    return (
        edges.selectExpr(*RECORDING, "stop", "last", f"lead(start) {over} AS next", f"lead(first) {over} AS after")
        .filter(f"next = stop AND {_finite('last')} AND {_finite('after')}")
        .groupBy(*RECORDING)
        .agg(F.expr("sum(abs(after - last)) AS _between"), F.expr("count(1) AS _edges"))
    )


def median_amplitude(kept: DataFrame) -> DataFrame:
    """Exact median of the finite samples. Equal values meet before they leave a task."""
    values = segments_of(kept).selectExpr(*RECORDING, "explode(values) AS value").filter(_finite("value"))
    counts = values.groupBy(*RECORDING, "value").agg(F.expr("count(1) AS n"))
    return percentiles_of_counts(counts, RECORDING, [0.5], ["median_signal_amplitude"])


def line_length(kept: DataFrame) -> DataFrame:
    """Mean absolute first difference inside each channel, for recordings with any difference."""
    moments = recording_moments(kept, steps=True).filter("signal_line_length_mean IS NOT NULL")
    return moments.select(*RECORDING, "signal_line_length_mean")


def channel_power(kept: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """Spectral sums per channel: ``total_power``, ``total_bins`` and the same per band."""
    return spectrum.band_power(segments_of(kept), config.task_samples)


def spectral_features(power: DataFrame) -> DataFrame:
    """Mean power over channels and bins, in total and per band; NULL without a bin."""
    means = [("total", "spectral_power_mean")] + [(name, f"bandpower_{name}_mean") for name, _, _ in BANDS]
    return power.groupBy(*RECORDING).agg(
        *[F.expr(f"sum({part}_power) / nullif(sum({part}_bins), 0) AS {name}") for part, name in means]
    )


AMPLITUDE_COLUMNS = (
    "mean_signal_amplitude",
    "std_signal_amplitude",
    "median_signal_amplitude",
    "signal_abs_mean",
    "signal_rms",
    "signal_line_length_mean",
)
QUALITY_COLUMNS = ("finite_sample_fraction", "zero_sample_fraction")
FREQUENCY_COLUMNS = ("spectral_power_mean", *(f"bandpower_{name}_mean" for name, _, _ in BANDS))


def recording_features(samples: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """One row per recording with the feature groups that are switched on."""
    segments = segments_of(samples)
    kept = kept_samples(segments, config)
    features = recording_moments(segments, config, steps=config.amplitude)
    columns = ["recording_duration_seconds", "sampling_frequency_hz", "channel_count"]
    if config.amplitude:
        features = features.join(median_amplitude(kept), RECORDING, "left")
        columns += AMPLITUDE_COLUMNS
    if config.quality:
        columns += QUALITY_COLUMNS
    if config.frequency:
        features = features.join(spectral_features(channel_power(kept, config)), RECORDING, "left")
        columns += FREQUENCY_COLUMNS
    return features.select("patient_id", "edf_path", *columns)


def truncation_notes(samples: DataFrame, config: SignalConfig = SignalConfig()) -> DataFrame:
    """Recordings that were cut to the configured maximum."""
    return recording_moments(samples, config).filter("truncated").selectExpr(
        *RECORDING, "edf_path", "'recording was truncated to configured max_seconds' AS note"
    )


def patient_means(
    recordings: DataFrame, strategy: str = "mean", include_count: bool = True
) -> DataFrame:
    """Mean of every numeric column per patient, NULLs skipped, with the recording count."""
    if strategy != "mean":
        raise ValueError(f"Unsupported EEG aggregation_strategy: {strategy}")
    if "patient_id" not in recordings.columns:
        return recordings.sparkSession.createDataFrame([], "patient_id string")
    numeric = [
        f.name for f in recordings.schema if f.name != "patient_id" and isinstance(f.dataType, T.NumericType)
    ]
    # NaN counts as missing in a mean.
    means = [
        F.expr(f"avg(CASE WHEN NOT isnan(`{c}`) THEN cast(`{c}` AS double) END) AS `{c}`") for c in numeric
    ]
    if include_count:
        means.append(F.expr("count(1) AS recording_count"))
    known = recordings.filter("patient_id IS NOT NULL").groupBy("patient_id")
    return known.agg(*means) if means else known.agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def patient_counts(patients: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Row, patient and error counts as one row."""
    counts = patients.agg(F.expr("count(1) AS row_count"), F.expr("count(DISTINCT patient_id) AS patient_count"))
    error_count = F.lit(0) if errors is None else errors.agg(F.expr("count(1) AS n")).scalar()
    return counts.withColumn("error_count", error_count.cast("bigint"))

"""Registered queries for signals and volumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortweave.config import BANDS, SignalConfig, VolumeConfig
from cohortweave.operators import signal, volume
from cohortweave.plans import views as v
from cohortweave.plans.registry import presented, register
from cohortweave.plans.sql_views import BLOCKS, r6, with_blocks

# --- signals ---------------------------------------------------------------------------------

_SIGNAL = ("positions", "samples")


@register(
    "signal_amplitude",
    with_blocks(
        _SIGNAL,
        f"""SELECT patient_id, recording_id, max(edf_path) AS edf_path, {r6('avg(value)')} AS mean_signal_amplitude,
                   {r6('stddev_pop(value)')} AS std_signal_amplitude,
                   {r6('quantile_cont(value, 0.5)')} AS median_signal_amplitude,
                   {r6('avg(abs(value))')} AS signal_abs_mean, {r6('sqrt(avg(value * value))')} AS signal_rms
            FROM samples GROUP BY ALL""",
    ),
)
def signal_amplitude(spark: SparkSession, d: str) -> DataFrame:
    segments = v.segments(spark, d)
    moments = signal.recording_moments(segments).join(signal.median_amplitude(segments), signal.RECORDING, "left")
    return presented(
        moments.select(
            "patient_id",
            "recording_id",
            "edf_path",
            "mean_signal_amplitude",
            "std_signal_amplitude",
            "median_signal_amplitude",
            "signal_abs_mean",
            "signal_rms",
        )
    )


_DIFFS = """
    SELECT patient_id, recording_id, avg(abs(step)) AS line_length
    FROM (SELECT patient_id, recording_id,
                 value - lag(value) OVER (PARTITION BY recording_id, channel ORDER BY sample_idx) AS step FROM samples)
    GROUP BY ALL"""


@register(
    "signal_line_length",
    with_blocks(
        _SIGNAL,
        f"SELECT patient_id, recording_id, {r6('line_length')} AS signal_line_length_mean FROM ({_DIFFS})",
    ),
)
def signal_line_length(spark: SparkSession, d: str) -> DataFrame:
    return presented(signal.line_length(v.segments(spark, d)))


@register(
    "signal_quality",
    with_blocks(
        _SIGNAL,
        f"""SELECT patient_id, recording_id, {r6('count(value)::DOUBLE / count(*)')} AS finite_sample_fraction,
                   {r6('count(*) FILTER (value = 0)::DOUBLE / count(*)')} AS zero_sample_fraction,
                   {r6('(max(sample_idx) + 1) / 64.0::DOUBLE')} AS recording_duration_seconds,
                   64.0::DOUBLE AS sampling_frequency_hz, count(DISTINCT channel) AS channel_count, false AS truncated
            FROM samples GROUP BY ALL""",
    ),
)
def signal_quality(spark: SparkSession, d: str) -> DataFrame:
    return presented(
        signal.recording_moments(v.segments(spark, d)).select(
            "patient_id",
            "recording_id",
            "finite_sample_fraction",
            "zero_sample_fraction",
            "recording_duration_seconds",
            "sampling_frequency_hz",
            "channel_count",
            "truncated",
        )
    )


# Settings of the feature G1 itself: one channel and a quarter of a second.
_CUT = SignalConfig(channel_limit=1, max_seconds=0.25)


@register(
    "signal_truncated",
    with_blocks(
        _SIGNAL,
        f"""SELECT patient_id, recording_id, 0.25::DOUBLE AS recording_duration_seconds, 1::BIGINT AS channel_count,
                   true AS truncated, {r6('avg(value)')} AS mean_signal_amplitude,
                   {r6('count(value)::DOUBLE / count(*)')} AS finite_sample_fraction
            FROM samples WHERE channel < 1 AND sample_idx < 16 GROUP BY ALL""",
    ),
)
def signal_truncated(spark: SparkSession, d: str) -> DataFrame:
    return presented(
        signal.recording_moments(v.segments(spark, d), _CUT).select(
            "patient_id",
            "recording_id",
            "recording_duration_seconds",
            "channel_count",
            "truncated",
            "mean_signal_amplitude",
            "finite_sample_fraction",
        )
    )


@register(
    "truncation_notes",
    with_blocks(
        ("positions", "samples"),
        """SELECT patient_id, recording_id, edf_path, 'recording was truncated to configured max_seconds' AS note
           FROM samples GROUP BY patient_id, recording_id, edf_path HAVING max((sample_idx + 1) / sfreq) > 0.25""",
    ),
)
def truncation_notes(spark: SparkSession, d: str) -> DataFrame:
    return signal.truncation_notes(v.segments(spark, d), _CUT)


_POWER = """
    SELECT patient_id, recording_id, channel, k, k * 64.0::DOUBLE / 32 AS hertz,
           pow(sum(coalesce(value, 0) * cos(2 * pi() * k * sample_idx / 32)), 2)
           + pow(sum(coalesce(value, 0) * sin(2 * pi() * k * sample_idx / 32)), 2) AS power
    FROM samples, range(17) AS bins(k) GROUP BY ALL"""
_BAND_MEANS = ", ".join(
    f"avg(power) FILTER (hertz >= {low} AND hertz < {high}) AS bandpower_{name}_mean" for name, low, high in BANDS
)
_SPECTRUM = f"""
    SELECT patient_id, recording_id, avg(power) AS spectral_power_mean, {_BAND_MEANS}
    FROM ({_POWER}) GROUP BY patient_id, recording_id"""


@register(
    "signal_bands",
    with_blocks(
        _SIGNAL,
        "SELECT patient_id, recording_id, "
        + ", ".join(f"{r6(c)} AS {c}" for c in signal.FREQUENCY_COLUMNS)
        + f" FROM ({_SPECTRUM})",
    ),
)
def signal_bands(spark: SparkSession, d: str) -> DataFrame:
    return presented(signal.spectral_features(signal.channel_power(v.segments(spark, d))))


_RECORDINGS = f"""
    SELECT patient_id, recording_id, 0.5::DOUBLE AS recording_duration_seconds,
           64.0::DOUBLE AS sampling_frequency_hz, 2::BIGINT AS channel_count, m.mean_signal_amplitude,
           m.std_signal_amplitude, m.median_signal_amplitude, m.signal_abs_mean, m.signal_rms,
           line_length AS signal_line_length_mean, m.finite_sample_fraction, m.zero_sample_fraction,
           {', '.join(signal.FREQUENCY_COLUMNS)}, m.edf_path
    FROM (SELECT patient_id, recording_id, max(edf_path) AS edf_path, avg(value) AS mean_signal_amplitude,
                 stddev_pop(value) AS std_signal_amplitude, quantile_cont(value, 0.5) AS median_signal_amplitude,
                 avg(abs(value)) AS signal_abs_mean, sqrt(avg(value * value)) AS signal_rms,
                 count(value)::DOUBLE / count(*) AS finite_sample_fraction,
                 count(*) FILTER (value = 0)::DOUBLE / count(*) AS zero_sample_fraction
          FROM samples GROUP BY patient_id, recording_id) AS m
         JOIN ({_DIFFS}) USING (patient_id, recording_id) JOIN ({_SPECTRUM}) USING (patient_id, recording_id)"""
_FEATURES = (
    "recording_duration_seconds",
    "sampling_frequency_hz",
    *signal.AMPLITUDE_COLUMNS,
    *signal.QUALITY_COLUMNS,
    *signal.FREQUENCY_COLUMNS,
)


@register(
    "recording_features",
    with_blocks(
        _SIGNAL,
        f"SELECT patient_id, edf_path, channel_count, {', '.join(f'{r6(c)} AS {c}' for c in _FEATURES)} FROM ({_RECORDINGS})",
    ),
)
def recording_features(spark: SparkSession, d: str) -> DataFrame:
    return presented(signal.recording_features(v.segments(spark, d)))


@register(
    "patient_signal_mean",
    with_blocks(
        _SIGNAL,
        f"""SELECT patient_id, {r6('avg(channel_count)')} AS channel_count,
                   {', '.join(f"{r6(f'avg({c})')} AS {c}" for c in _FEATURES)}, count(*) AS recording_count
            FROM ({_RECORDINGS}) GROUP BY patient_id""",
    ),
)
def patient_signal_mean(spark: SparkSession, d: str) -> DataFrame:
    return presented(signal.patient_means(signal.recording_features(v.segments(spark, d))))


# Lengths without a factor, at two rates per recording. So small a task makes every channel a long one, and the
# chirp transform decides on all of them.
_MIXED_POWER = """
    SELECT patient_id, recording_id, channel, k, k * sfreq / n AS hertz,
           pow(sum(coalesce(value, 0) * cos(2 * pi() * k * sample_idx / n)), 2)
           + pow(sum(coalesce(value, 0) * sin(2 * pi() * k * sample_idx / n)), 2) AS power
    FROM mixed, range(19) AS bins(k) WHERE k <= n // 2 GROUP BY ALL"""
_MIXED_DIFFS = """
    SELECT recording_id, avg(abs(step)) AS signal_line_length_mean
    FROM (SELECT recording_id, value - lag(value) OVER (PARTITION BY recording_id, channel ORDER BY sample_idx) AS step FROM mixed)
    GROUP BY ALL"""
_MIXED = SignalConfig(task_samples=8)


@register(
    "signal_mixed_rates",
    with_blocks(
        ("positions", "mixed"),
        f"""SELECT patient_id, edf_path, 0.5::DOUBLE AS recording_duration_seconds, 74.0::DOUBLE AS sampling_frequency_hz,
                   2::BIGINT AS channel_count, {', '.join(f"{r6(c)} AS {c}" for c in _FEATURES[2:])}
            FROM (SELECT patient_id, recording_id, max(edf_path) AS edf_path, avg(value) AS mean_signal_amplitude,
                         stddev_pop(value) AS std_signal_amplitude, quantile_cont(value, 0.5) AS median_signal_amplitude,
                         avg(abs(value)) AS signal_abs_mean, sqrt(avg(value * value)) AS signal_rms,
                         count(value)::DOUBLE / count(*) AS finite_sample_fraction,
                         count(*) FILTER (value = 0)::DOUBLE / count(*) AS zero_sample_fraction
                  FROM mixed GROUP BY patient_id, recording_id)
                 JOIN ({_MIXED_DIFFS}) USING (recording_id)
                 JOIN (SELECT recording_id, avg(power) AS spectral_power_mean, {_BAND_MEANS}
                       FROM ({_MIXED_POWER}) GROUP BY recording_id) USING (recording_id)""",
    ),
)
def signal_mixed_rates(spark: SparkSession, d: str) -> DataFrame:
    return presented(signal.recording_features(v.mixed_segments(spark, d), _MIXED))


# --- volumes ---------------------------------------------------------------------------------

_VOLUME = VolumeConfig(min_foreground_voxels=2500)
_LIMITS = {
    **{name: BLOCKS[name] for name in ("positions", "voxels", "volume_headers", "participants")},
    "cuts": "SELECT subject_id, quantile_cont(CAST(value AS DOUBLE), 0.2) AS threshold FROM voxels GROUP BY subject_id",
    "fore": """SELECT v.*, threshold FROM voxels v JOIN cuts USING (subject_id)
               WHERE CAST(value AS DOUBLE) > threshold""",
    "intensity": """
        SELECT subject_id, count(*) AS foreground_voxel_count, avg(val) AS t1_intensity_mean,
               stddev_pop(val) AS t1_intensity_std, quantile_cont(val, 0.1) AS t1_intensity_p10,
               quantile_cont(val, 0.5) AS t1_intensity_p50, quantile_cont(val, 0.9) AS t1_intensity_p90,
               min(val) AS t1_intensity_min, max(val) AS t1_intensity_max
        FROM (SELECT subject_id, CAST(value AS DOUBLE) AS val FROM fore) GROUP BY subject_id""",
    "slices": """
        SELECT subject_id, z FROM (
            SELECT subject_id, z, row_number() OVER (PARTITION BY subject_id ORDER BY z) - 1 AS place,
                   count(*) OVER (PARTITION BY subject_id) AS n
            FROM (SELECT DISTINCT subject_id, z FROM fore))
        WHERE place BETWEEN greatest(0, n // 2 - 1) AND n // 2 + 1""",
    "levels": """
        SELECT subject_id, x, y, z,
               CAST(floor(least(greatest(
                 CAST((CAST(value AS DOUBLE) - low) AS FLOAT) / CAST(high - low AS FLOAT),
                 0::FLOAT), 1::FLOAT) * 63::FLOAT) AS INT) AS level
        FROM fore JOIN slices USING (subject_id, z)
             JOIN (SELECT subject_id, t1_intensity_min AS low, t1_intensity_max AS high FROM intensity)
             USING (subject_id)""",
    "pairs": """
        SELECT a.subject_id, a.z, a.level AS i, b.level AS j, count(*) AS n
        FROM levels a JOIN levels b ON a.subject_id = b.subject_id AND a.z = b.z AND a.x = b.x AND b.y = a.y + 1
        GROUP BY ALL""",
    "probs": "SELECT *, n / sum(n) OVER (PARTITION BY subject_id, z) AS p FROM pairs",
    "centred": """
        SELECT *, sum(i * p) OVER (PARTITION BY subject_id, z) AS mi, sum(j * p) OVER (PARTITION BY subject_id, z) AS mj
        FROM probs""",
    "metrics": """
        SELECT subject_id, z, sum((i - j) * (i - j) * p) AS contrast, sum(p / (1 + abs(i - j))) AS homogeneity,
               sqrt(sum(p * p)) AS energy,
               sum((i - mi) * (j - mj) * p) / (sqrt(sum((i - mi) * (i - mi) * p)) * sqrt(sum((j - mj) * (j - mj) * p)))
                   AS correlation
        FROM centred GROUP BY subject_id, z""",
}
_TEXTURE = ", ".join(
    f"{r6(f'{fn}({m})')} AS glcm_{m}_{stat}"
    for m in volume.TEXTURE_METRICS
    for stat, fn in (("mean", "avg"), ("std", "stddev_pop"))
)


def _volume_sql(select: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in _LIMITS.items()) + "\n" + select


@register(
    "volume_geometry",
    _volume_sql(
        f"""SELECT subject_id, t1_path, max(x) + 1 AS shape_x, max(y) + 1 AS shape_y, max(z) + 1 AS shape_z,
                   {r6('max(zoom_x)')} AS voxel_size_x, max(zoom_y) AS voxel_size_y, max(zoom_z) AS voxel_size_z,
                   {r6('max(zoom_x * zoom_y * zoom_z)')} AS voxel_volume, count(*) AS voxel_count,
                   {r6('1 - count(value)::DOUBLE / count(*)')} AS image_nan_fraction
            FROM voxels JOIN volume_headers USING (subject_id) GROUP BY subject_id, t1_path"""
    ),
)
def volume_geometry(spark: SparkSession, d: str) -> DataFrame:
    return presented(volume.geometry(v.lines(spark, d), v.volume_headers(spark, d)))


_INTENSITY = [f"t1_intensity_{s}" for s in ("mean", "std", "p10", "p50", "p90", "min", "max")]


@register(
    "volume_intensity",
    _volume_sql(
        f"""SELECT subject_id, foreground_voxel_count, {', '.join(f'{r6(c)} AS {c}' for c in _INTENSITY)}
            FROM intensity"""
    ),
)
def volume_intensity(spark: SparkSession, d: str) -> DataFrame:
    foreground, _ = volume.foreground_counts(v.lines(spark, d), _VOLUME)
    return presented(volume.intensity_summary(foreground))


def _limits(spark: SparkSession, d: str) -> DataFrame:
    foreground, thresholds = volume.foreground_counts(v.lines(spark, d), _VOLUME)
    return volume.texture_limits(thresholds, volume.intensity_summary(foreground))


@register("volume_slices", _volume_sql("SELECT subject_id, z FROM slices"))
def volume_slices(spark: SparkSession, d: str) -> DataFrame:
    return volume.texture_slices(v.lines(spark, d), _limits(spark, d), _VOLUME).select("subject_id", "z")


@register("volume_cooccurrence", _volume_sql("SELECT subject_id, z, i, j, n FROM pairs"))
def volume_cooccurrence(spark: SparkSession, d: str) -> DataFrame:
    lines = v.lines(spark, d)
    return volume.cooccurrence(lines, volume.texture_slices(lines, _limits(spark, d), _VOLUME), _VOLUME)


_EVERY = VolumeConfig(max_slices=None)


@register(
    "volume_every_slice",
    _volume_sql("SELECT subject_id, z, i, j, n FROM pairs").replace("WHERE place BETWEEN greatest(0, n // 2 - 1) AND n // 2 + 1", ""),
)
def volume_every_slice(spark: SparkSession, d: str) -> DataFrame:
    lines = v.lines(spark, d)
    return volume.cooccurrence(lines, volume.texture_slices(lines, _limits(spark, d), _EVERY), _EVERY)


@register("volume_texture", _volume_sql(f"SELECT subject_id, {_TEXTURE} FROM metrics GROUP BY subject_id"))
def volume_texture(spark: SparkSession, d: str) -> DataFrame:
    return presented(volume.texture(v.lines(spark, d), _limits(spark, d), _VOLUME))


_VOLUME_ROWS = f"""
    SELECT subject_id, t1_path, shape_x, shape_y, shape_z, {r6('voxel_size_x')} AS voxel_size_x, voxel_size_y,
           voxel_size_z, {r6('voxel_volume')} AS voxel_volume, foreground_voxel_count,
           {r6('foreground_voxel_count * voxel_volume')} AS foreground_volume,
           {r6('foreground_voxel_count::DOUBLE / voxel_count')} AS foreground_fraction,
           {r6('image_nan_fraction')} AS image_nan_fraction, {', '.join(f'{r6(c)} AS {c}' for c in _INTENSITY)},
           textures.* EXCLUDE (subject_id), segment, balance
    FROM (SELECT subject_id, t1_path, max(x) + 1 AS shape_x, max(y) + 1 AS shape_y, max(z) + 1 AS shape_z,
                 max(zoom_x) AS voxel_size_x, max(zoom_y) AS voxel_size_y, max(zoom_z) AS voxel_size_z,
                 max(zoom_x * zoom_y * zoom_z) AS voxel_volume, count(*) AS voxel_count,
                 1 - count(value)::DOUBLE / count(*) AS image_nan_fraction
          FROM voxels JOIN volume_headers USING (subject_id) GROUP BY subject_id, t1_path)
         JOIN intensity USING (subject_id)
         JOIN (SELECT subject_id, {_TEXTURE} FROM metrics GROUP BY subject_id) AS textures USING (subject_id)
         LEFT JOIN participants ON participant_id = subject_id"""


@register("volume_features", _volume_sql(_VOLUME_ROWS))
def volume_features(spark: SparkSession, d: str) -> DataFrame:
    return presented(
        volume.volume_features(v.lines(spark, d), v.volume_headers(spark, d), _VOLUME, v.participants(spark, d))
    )


@register(
    "volume_participants",
    with_blocks(
        ("volume_headers", "participants"),
        """SELECT subject_id, t1_path, segment, balance
           FROM volume_headers LEFT JOIN participants ON participant_id = subject_id""",
    ),
)
def volume_participants(spark: SparkSession, d: str) -> DataFrame:
    headers = v.volume_headers(spark, d).select("subject_id", "t1_path")
    return presented(volume.join_participants(headers, v.participants(spark, d)))


@register(
    "low_foreground",
    _volume_sql(
        """SELECT subject_id, foreground_voxel_count, 'foreground voxel count below configured minimum' AS note
           FROM intensity WHERE foreground_voxel_count < 2500"""
    ),
)
def low_foreground(spark: SparkSession, d: str) -> DataFrame:
    foreground, _ = volume.foreground_counts(v.lines(spark, d), _VOLUME)
    return volume.low_foreground_notes(volume.intensity_summary(foreground), _VOLUME)

"""Signals and volumes against numpy."""

import numpy as np
import pyarrow as pa
import pytest

from cohortweave.config import BANDS, SignalConfig, VolumeConfig
from cohortweave.functions import ordering
from cohortweave.operators import signal, spectrum, volume

SAMPLES = (
    "patient_id string, recording_id string, edf_path string, channel int, sample_idx bigint, value double, sfreq double"
)
VOXELS = "subject_id string, x int, y int, z int, value float"
HEADERS = "subject_id string, t1_path string, zoom_x double, zoom_y double, zoom_z double"


def sample_frame(spark, recordings, sfreq):
    rows = [
        (patient, rec, f"/{patient}/{rec}.edf", c, i, float(x), float(sfreq))
        for (patient, rec), data in recordings.items()
        for c, channel in enumerate(data)
        for i, x in enumerate(channel)
    ]
    return spark.createDataFrame(rows, SAMPLES)


def expected_signal(data, sfreq):
    good = data[np.isfinite(data)]
    diffs = np.diff(data, axis=1)
    diffs = diffs[np.isfinite(diffs)]
    filled = np.where(np.isfinite(data), data, 0.0)
    power = np.abs(np.fft.rfft(filled, axis=1)) ** 2
    hertz = np.fft.rfftfreq(data.shape[1], 1 / sfreq)
    out = {
        "mean_signal_amplitude": good.mean(),
        "std_signal_amplitude": good.std(),
        "median_signal_amplitude": np.median(good),
        "signal_abs_mean": np.abs(good).mean(),
        "signal_rms": np.sqrt((good**2).mean()),
        "signal_line_length_mean": np.abs(diffs).mean(),
        "finite_sample_fraction": np.isfinite(data).mean(),
        "zero_sample_fraction": (data == 0).mean(),
        "spectral_power_mean": power.mean(),
    }
    for name, low, high in BANDS:
        mask = (hertz >= low) & (hertz < high)
        out[f"bandpower_{name}_mean"] = power[:, mask].mean() if mask.any() else None
    return out


@pytest.fixture(scope="module")
def recordings():
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(size=(2, 200)), 2)
    a[0, 10] = np.nan
    a[1, 20:23] = 0.0
    a[1, 50] = np.inf
    b = rng.normal(size=(3, 151)) * 1e-5
    return {("p1", "r1"): a, ("p1", "r2"): b, ("p2", "r3"): np.array([[1.0, -1.0, 1.0, -1.0], [0.0, 2.0, 0.0, 2.0]])}


def test_recording_features(spark, recordings):
    got = signal.recording_features(sample_frame(spark, recordings, 50.0)).collect()
    assert len(got) == 3
    for row in got:
        key = (row.patient_id, row.edf_path.split("/")[-1].removesuffix(".edf"))
        data = recordings[key]
        assert row.channel_count == data.shape[0]
        assert row.recording_duration_seconds == pytest.approx(data.shape[1] / 50.0)
        for name, value in expected_signal(data, 50.0).items():
            if value is None:
                assert row[name] is None, name
            else:
                assert row[name] == pytest.approx(value, rel=1e-9, abs=1e-15), name


def test_limits_and_switches(spark, recordings):
    config = SignalConfig(channel_limit=1, max_seconds=2.0, frequency=False)
    samples = sample_frame(spark, recordings, 50.0)
    rows = {r.edf_path: r for r in signal.recording_features(samples, config).collect()}
    row = rows["/p1/r1.edf"]
    kept = recordings[("p1", "r1")][:1, :100]
    assert "spectral_power_mean" not in row.asDict() and row.channel_count == 1
    assert row.recording_duration_seconds == 2.0
    assert row.signal_rms == pytest.approx(expected_signal(kept, 50.0)["signal_rms"])
    assert {r.recording_id for r in signal.truncation_notes(samples, config).collect()} == {"r1", "r2"}


def test_line_length_across_segments(spark, monkeypatch):
    monkeypatch.setattr(signal, "SEGMENT", 4)
    data = np.random.default_rng(1).normal(size=(2, 23))
    row = signal.line_length(sample_frame(spark, {("p", "r"): data}, 10.0)).first()
    assert row.signal_line_length_mean == pytest.approx(np.abs(np.diff(data, axis=1)).mean())


def test_no_finite_sample(spark):
    row = signal.recording_features(sample_frame(spark, {("p", "r"): np.full((1, 4), np.nan)}, 4.0)).first()
    assert row.mean_signal_amplitude is None and row.median_signal_amplitude is None
    assert row.finite_sample_fraction == 0.0 and row.spectral_power_mean == 0.0


def test_patient_means(spark):
    recs = spark.createDataFrame(
        [("p1", "a", 1.0, 2), ("p1", "b", None, 4), ("p2", "c", float("nan"), 6), (None, "d", 1.0, 1)],
        "patient_id string, edf_path string, feature_a double, feature_b int",
    )
    rows = {r.patient_id: r for r in signal.patient_means(recs).collect()}
    assert set(rows) == {"p1", "p2"}
    assert rows["p1"].feature_a == 1.0 and rows["p1"].feature_b == 3.0 and rows["p1"].recording_count == 2
    assert rows["p2"].feature_a is None
    with pytest.raises(ValueError, match="aggregation_strategy"):
        signal.patient_means(recs, "median")
    errors = spark.createDataFrame([("p9", "x", "OSError", "bad")], "patient_id string, edf_path string, error_type string, error_message string")
    counts = signal.patient_counts(signal.patient_means(recs), errors).first()
    assert (counts.row_count, counts.patient_count, counts.error_count) == (2, 2, 1)


# --- volumes ---------------------------------------------------------------------------------


def voxel_frame(spark, volumes):
    rows = []
    for subject, data in volumes.items():
        for (x, y, z), value in np.ndenumerate(data):
            rows.append((subject, x, y, z, float(value)))
    headers = [(s, f"/{s}/T1w.nii.gz", 1.0, 0.5, 2.0) for s in volumes]
    return spark.createDataFrame(rows, VOXELS), spark.createDataFrame(headers, HEADERS)


def numpy_texture(data, fore, levels, max_slices):
    """Co-occurrence metrics by the direct definition."""
    values = data[fore]
    low, high = float(values.min()), float(values.max())
    chosen = np.where(fore.any(axis=(0, 1)))[0]
    centre, half = len(chosen) // 2, max_slices // 2
    found = []
    for z in chosen[max(0, centre - half) : centre + half + 1][:max_slices]:
        plane = data[:, :, z].astype(np.float32)
        level = np.floor(np.clip((plane - np.float32(low)) / np.float32(high - low), 0, 1) * np.float32(levels - 1))
        p = np.zeros((levels, levels))
        for x in range(plane.shape[0]):
            for y in range(plane.shape[1] - 1):
                if fore[x, y, z] and fore[x, y + 1, z]:
                    p[int(level[x, y]), int(level[x, y + 1])] += 1
        if p.sum() == 0:
            continue
        p /= p.sum()
        i, j = np.indices(p.shape)
        mi, mj = (i * p).sum(), (j * p).sum()
        si, sj = np.sqrt(((i - mi) ** 2 * p).sum()), np.sqrt(((j - mj) ** 2 * p).sum())
        found.append(
            (
                ((i - j) ** 2 * p).sum(),
                (p / (1 + abs(i - j))).sum(),
                np.sqrt((p**2).sum()),
                ((i - mi) * (j - mj) * p).sum() / (si * sj) if si * sj > 0 else 0.0,
            )
        )
    return np.array(found)


@pytest.mark.parametrize("max_slices", [1, 2, 3])
def test_volume_features(spark, max_slices):
    rng = np.random.default_rng(7)
    a = rng.integers(0, 40, size=(9, 10, 8)).astype(np.float32)
    a[1, 2, 3] = np.nan
    a[:, :, 0] = 0
    b = rng.normal(100, 5, size=(6, 7, 5)).astype(np.float32)
    volumes = {"a": a, "b": b}
    config = VolumeConfig(levels=16, max_slices=max_slices)
    rows = {r.subject_id: r for r in volume.volume_features(*voxel_frame(spark, volumes), config).collect()}
    for subject, data in volumes.items():
        row = rows[subject]
        finite = data[np.isfinite(data)].astype(float)
        fore = np.isfinite(data) & (data > np.percentile(finite, 20))
        inside = data[fore].astype(float)
        assert (row.shape_x, row.shape_y, row.shape_z) == data.shape
        assert row.voxel_volume == 1.0 and row.foreground_voxel_count == inside.size
        assert row.foreground_fraction == pytest.approx(inside.size / data.size)
        assert row.image_nan_fraction == pytest.approx(1 - np.isfinite(data).mean())
        assert row.t1_intensity_mean == pytest.approx(inside.mean())
        assert row.t1_intensity_std == pytest.approx(inside.std())
        for q in (10, 50, 90):
            assert row[f"t1_intensity_p{q}"] == pytest.approx(np.percentile(inside, q))
        assert (row.t1_intensity_min, row.t1_intensity_max) == (inside.min(), inside.max())
        texture = numpy_texture(data, fore, 16, max_slices)
        for k, name in enumerate(volume.TEXTURE_METRICS):
            assert row[f"glcm_{name}_mean"] == pytest.approx(texture[:, k].mean(), abs=1e-12)
            assert row[f"glcm_{name}_std"] == pytest.approx(texture[:, k].std(), abs=1e-7)


def test_lines_of_voxels(spark):
    """Gaps and missing ends are NULL, of repeated voxels one counts, and lines need no particular order."""
    nan = float("nan")
    rows = [("s", 0, 2, 1, 5.0), ("s", 0, 0, 1, 1.0), ("s", 1, 0, 1, 2.0), ("s", 1, 1, 1, nan), ("s", 2, 1, 0, 7.0), ("s", 2, 1, 0, 6.0), ("s", None, 1, 0, 9.0)]
    made = volume.lines_of(spark.createDataFrame(rows, VOXELS))
    found = {(r.z, r.x): str(list(r["values"])) for r in made.collect()}
    assert found == {(1, 0): "[1.0, None, 5.0]", (1, 1): "[2.0, nan]", (0, 2): "[None, 6.0]"}
    assert volume.lines_of(made) is made


def test_every_slice(spark):
    rng = np.random.default_rng(2)
    data = rng.integers(0, 30, size=(5, 6, 9)).astype(np.float32)
    config = VolumeConfig(levels=8, max_slices=None)
    (row,) = volume.volume_features(*voxel_frame(spark, {"a": data}), config).collect()
    texture = numpy_texture(data, data > np.percentile(data, 20), 8, 99)
    assert len(texture) == 9 and row.glcm_contrast_mean == pytest.approx(texture[:, 0].mean())


def test_neighbours_meet_in_their_row(spark):
    from cohortweave.plans.catalog import QUERIES

    plan = QUERIES["volume_every_slice"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ORDER BY y" not in plan and "lead(" not in plan


def test_bright_cube_and_empty_volume(spark):
    cube = np.ones((24, 24, 24), dtype=np.float32)
    cube[8:16, 8:16, 8:16] = 10
    nothing = np.full((2, 2, 2), np.nan, dtype=np.float32)
    voxels, headers = voxel_frame(spark, {"cube": cube, "nothing": nothing})
    rows = {r.subject_id: r for r in volume.volume_features(voxels, headers).collect()}
    assert rows["cube"].foreground_voxel_count == 512 and rows["cube"].t1_intensity_mean == 10.0
    assert rows["cube"].t1_intensity_std == 0.0 and rows["cube"].glcm_contrast_mean is None  # one grey value
    assert rows["nothing"].foreground_voxel_count == 0 and rows["nothing"].t1_intensity_mean is None
    assert rows["nothing"].image_nan_fraction == 1.0 and rows["nothing"].foreground_fraction == 0.0
    low = {r.subject_id for r in volume.low_foreground_notes(volume.volume_features(voxels, headers)).collect()}
    assert low == {"cube", "nothing"}


def test_participants(spark):
    features = spark.createDataFrame([("s1", 1.0), ("s2", 2.0)], "subject_id string, feature_a double")
    people = spark.createDataFrame([("s1", 30, 9.0)], "participant_id string, age int, feature_a double")
    rows = {r.subject_id: r for r in volume.join_participants(features, people).collect()}
    assert rows["s1"].age == 30 and rows["s2"].age is None and rows["s1"].feature_a_y == 9.0
    assert volume.join_participants(features, people.select("age")) is features


def test_subject_counts_and_missing_images(spark):
    inventory = spark.createDataFrame(
        [("s1", "/a", True), ("s2", None, False)], "subject_id string, t1_path string, has_t1 boolean"
    )
    errors = volume.missing_image_errors(inventory)
    assert [(r.subject_id, r.error_type) for r in errors.collect()] == [("s2", "missing_t1")]
    counts = volume.subject_counts(spark.createDataFrame([("s1",)], "subject_id string"), errors).first()
    assert (counts.row_count, counts.subject_count, counts.error_count) == (1, 1, 1)


# --- shared primitives -----------------------------------------------------------------------


def test_percentiles_match_numpy(spark):
    rng = np.random.default_rng(11)
    groups = {
        "wide": rng.normal(size=301) * 10.0 ** rng.integers(-9, 9, size=301),
        "ties": rng.integers(-3, 4, size=500).astype(float),
        "one": np.array([-4.5]),
        "tight": 1000 + rng.random(400) * 1e-4,
    }
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("one", float("nan")), ("one", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    for row in ordering.exact_percentiles(df, ["g"], "v", probs, names).collect():
        for p, n in zip(probs, names):
            assert row[n] == pytest.approx(np.percentile(groups[row.g], p * 100), rel=1e-12, abs=1e-15)


def test_order_code_is_the_order_of_doubles(spark):
    edges = [2.0**e for e in (-1074, -1050, -1023, -1022, -1021, -1, 0, 1, 52, 1022, 1023)]
    near = [float(np.nextafter(x, way)) for x in edges for way in (0.0, np.inf)]
    wide = [2.0**e * m for e in range(-1074, 1023, 37) for m in (1.0, 1.3, 1.9999)]
    close = [1e6 + k / 1024 for k in range(500)]
    positive = {x for x in [*edges, *near, *wide, *close, float(np.finfo(float).max)] if 0 < x < np.inf}
    values = sorted({s * x for s in (-1, 1) for x in positive} | {0.0})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    codes = [r[0] for r in df.coalesce(1).selectExpr(ordering.order_code("v")).collect()]
    bits = [int(np.array(abs(v)).view(np.int64)) * (-1 if v < 0 else 1) for v in values]
    assert codes == bits


def test_close_values_share_no_large_window(spark):
    """Half a million values between 1,000,000 and 1,000,500: no prefix holds more than a small share."""
    df = spark.range(500_000).selectExpr("'k' AS key", "1000000D + id / 1000D AS value", "1L AS n")
    coded = ordering._coded(df)
    largest = coded.groupBy("_p2").count().agg({"count": "max"}).first()[0]
    assert largest < 5_000
    (row,) = ordering.percentiles_of_counts(df, ["key"], [0.0, 0.5, 1.0], ["a", "b", "c"]).collect()
    assert (row.a, row.c) == (1000000.0, 1000499.999) and row.b == pytest.approx(1000249.9995, rel=1e-12)


def test_running_totals(spark):
    rng = np.random.default_rng(2)
    rows = [("k", float(v), int(w)) for v, w in zip(sorted(set(rng.normal(size=50))), rng.integers(1, 9, size=50))]
    df = spark.createDataFrame(rows, "key string, value double, n bigint")
    for descending in (False, True):
        ordered = sorted(rows, key=lambda r: r[1], reverse=descending)
        before, total = {}, 0
        for _, v, w in ordered:
            before[v] = total
            total += w
        for r in ordering.running_totals(df, ["key"], ["n"], descending).collect():
            assert r.n_before == before[r.value] and r.n_total == total


def test_long_channels_by_several_tasks(spark, monkeypatch):
    """Any length gives the same spectrum as one transform: by factors where they are even, else by a chirp."""
    monkeypatch.setattr(signal, "SEGMENT", 64)
    rng = np.random.default_rng(9)
    recordings = {
        ("p", "long"): rng.normal(size=(2, 600)),
        ("p", "odd"): rng.normal(size=(1, 15 * 21)),
        ("p", "prime"): rng.normal(size=(1, 211)),
        ("p", "uneven"): rng.normal(size=(1, 2 * 151)),
        ("p", "short"): rng.normal(size=(1, 40)),
        ("p", "two"): rng.normal(size=(1, 128)),
    }
    recordings[("p", "long")][0, 7] = np.nan
    samples = signal.segments_of(sample_frame(spark, recordings, 200.0))
    long = {(r.recording_id, r.rows, r["columns"], r.padded) for r in spectrum.long_channels(samples, 100).collect()}
    assert long == {("long", 24, 25, False), ("odd", 15, 21, False), ("prime", 16, 32, True), ("uneven", 32, 32, True), ("two", 8, 16, False)}
    config = SignalConfig(amplitude=False, quality=False, task_samples=100)
    rows = signal.recording_features(samples, config).collect()
    assert len(rows) == 6
    for row in rows:
        expected = expected_signal(recordings[("p", row.edf_path.split("/")[-1].removesuffix(".edf"))], 200.0)
        for name in signal.FREQUENCY_COLUMNS:
            value = expected[name]
            assert row[name] == (None if value is None else pytest.approx(value, rel=1e-9)), name


@pytest.mark.parametrize("length", [1, 2, 3, 7, 31, 37, 97, 128])
def test_chirp_of_small_lengths(spark, length):
    data = np.random.default_rng(length).normal(size=(1, length))
    samples = sample_frame(spark, {("p", "r"): data}, 160.0)
    (row,) = signal.spectral_features(signal.channel_power(samples, SignalConfig(task_samples=1))).collect()
    expected = expected_signal(data, 160.0)
    for name in signal.FREQUENCY_COLUMNS:
        assert row[name] == (None if expected[name] is None else pytest.approx(expected[name], rel=1e-9)), name


def test_long_channel_with_a_gap(spark):
    """The chirp has all its tiles where the samples leave some of them empty."""
    data = np.zeros((1, 1009))
    data[0, :3], data[0, -2:] = [1.0, -2.0, 0.5], [3.0, 1.5]
    rows = [("p", "r", "/p/r.edf", 0, at, 160.0, data[0, at:to].tolist()) for at, to in ((0, 3), (1007, 1009))]
    samples = spark.createDataFrame(
        rows, "patient_id string, recording_id string, edf_path string, channel int, start bigint, sfreq double, values array<double>"
    )
    (layout,) = spectrum.long_channels(samples, 100).collect()
    assert layout.padded
    (row,) = signal.spectral_features(signal.channel_power(samples, SignalConfig(task_samples=100))).collect()
    expected = expected_signal(data, 160.0)
    for name in signal.FREQUENCY_COLUMNS:
        assert row[name] == (None if expected[name] is None else pytest.approx(expected[name], rel=1e-9)), name


def test_short_channels_share_batches(spark):
    """Channels that are long only by the setting are sent and transformed together, whatever their number."""
    n = 3000
    made = spark.range(n).selectExpr(
        "'p' AS patient_id", "cast(id AS string) AS recording_id", "0 AS channel", "0L AS start", "62D AS sfreq",
        "transform(sequence(0, 30), i -> sin(id + i * 0.7D)) AS values", "31L AS length", "8L AS rows", "8L AS columns", "true AS padded",
    )
    pieces = list(spectrum._cut_lines(iter(made.toArrow().combine_chunks().to_batches(max_chunksize=1000))))
    assert sum(b.num_rows for b in pieces) == n and len(pieces) <= 3
    calls = []

    def count(base, layout, owner, table):
        calls.append(base.num_rows)
        return iter(())

    ordered = pa.Table.from_batches(pieces).sort_by([("recording_id", "ascending")]).combine_chunks().to_batches(max_chunksize=700)
    list(spectrum._stacked(count, "tile", lambda rows, columns, tile: rows * columns)(iter(ordered)))
    assert sum(calls) == n and len(calls) <= 6


def test_a_prime_length_of_five_million(spark):
    length, piece = 5_000_011, 65_536
    assert all(length % d for d in range(2, 2237))
    wave = "sin(0.37D * i) + 0.5D * cos(1e-3D * i) + cast(i % 7 AS double) / 7"
    made = spark.range(-(-length // piece)).selectExpr(
        "'p' AS patient_id", "'r' AS recording_id", "'/p/r.edf' AS edf_path", "0 AS channel", f"id * {piece} AS start", "250D AS sfreq",
        f"transform(sequence(id * {piece}, least((id + 1) * {piece}, {length}) - 1), i -> {wave}) AS values",
    )
    (layout,) = spectrum.long_channels(made, SignalConfig().task_samples).collect()
    assert layout.padded and layout.rows * layout["columns"] == 2**24
    i = np.arange(length)
    data = (np.sin(0.37 * i) + 0.5 * np.cos(1e-3 * i) + (i % 7) / 7)[None]
    expected = expected_signal(data, 250.0)
    (row,) = signal.spectral_features(signal.channel_power(made)).collect()
    for name in signal.FREQUENCY_COLUMNS:
        assert row[name] == pytest.approx(expected[name], rel=1e-7), name


def test_channels_of_different_rates(spark):
    rng = np.random.default_rng(4)
    slow, fast = rng.normal(size=40), rng.normal(size=120)
    rows = [("p", "r", "/p/r.edf", 0, 0, 20.0, slow.tolist()), ("p", "r", "/p/r.edf", 1, 0, 60.0, fast[:50].tolist()), ("p", "r", "/p/r.edf", 1, 50, 60.0, fast[50:].tolist())]
    made = spark.createDataFrame(rows, "patient_id string, recording_id string, edf_path string, channel int, start bigint, sfreq double, values array<double>")
    (row,) = signal.recording_features(made).collect()
    assert (row.recording_duration_seconds, row.sampling_frequency_hz, row.channel_count) == (2.0, 60.0, 2)
    steps = np.concatenate([np.abs(np.diff(slow)), np.abs(np.diff(fast))])
    assert row.signal_line_length_mean == pytest.approx(steps.mean())
    power = [np.abs(np.fft.rfft(x)) ** 2 for x in (slow, fast)]
    hertz = np.concatenate([np.fft.rfftfreq(40, 1 / 20), np.fft.rfftfreq(120, 1 / 60)])
    alpha = (hertz >= 8) & (hertz < 13)
    assert row.bandpower_alpha_mean == pytest.approx(np.concatenate(power)[alpha].mean())
    (cut,) = signal.recording_features(made, SignalConfig(max_seconds=1.0, frequency=False)).collect()
    kept = np.concatenate([slow[:20], fast[:60]])
    assert cut.recording_duration_seconds == 1.0 and cut.mean_signal_amplitude == pytest.approx(kept.mean())
    kept_steps = np.concatenate([np.abs(np.diff(slow[:20])), np.abs(np.diff(fast[:60]))])
    assert cut.signal_line_length_mean == pytest.approx(kept_steps.mean())
    assert [r.recording_id for r in signal.truncation_notes(made, SignalConfig(max_seconds=1.0)).collect()] == ["r"]


def test_segments_of_gaps_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(signal, "SEGMENT", 4)
    rows = [("p", "r", "/r", 0, i, float(i * i), 10.0) for i in (0, 1, 2, 3, 4, 7, 8, 9, 9)] + [("p", "r", "/r", 0, None, 1.0, 10.0), ("p", None, "/r", 0, 1, 1.0, 10.0)]
    made = signal.segments_of(spark.createDataFrame(rows, SAMPLES))
    found = sorted((r.start, list(r["values"])) for r in made.collect())
    assert found == [(0, [0.0, 1.0, 4.0, 9.0]), (4, [16.0]), (7, [49.0]), (8, [64.0, 81.0]), (9, [81.0])]
    (row,) = signal.line_length(made).collect()
    assert row.signal_line_length_mean == pytest.approx(np.mean([1, 3, 5, 7, 15, 17]))
    assert signal.segments_of(made) is made


def test_samples_are_not_shuffled(spark):
    """Quality, moments and line length leave the samples where they lie: exchanges carry sums, and edges of segments."""
    from cohortweave.plans.catalog import QUERIES

    for name in ("signal_quality", "signal_line_length"):
        lines = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString().split("\n")
        below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hash" in line]
        assert below and all("partial_" in x or " AS last" in x for x in below), name


def test_channels_split_over_batches(spark):
    """A channel that spans several Arrow batches is put together again."""
    rng = np.random.default_rng(13)
    recordings = {(f"p{i % 2}", f"r{i}"): rng.normal(size=(2, 37 + i)) for i in range(5)}
    samples = sample_frame(spark, recordings, 100.0)
    default, segment = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"), signal.SEGMENT
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    signal.SEGMENT = 10
    try:
        rows = signal.channel_power(samples).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", default)
        signal.SEGMENT = segment
    assert len(rows) == 10
    for row in rows:
        power = np.abs(np.fft.rfft(recordings[(row.patient_id, row.recording_id)][row.channel])) ** 2
        assert row.total_power == pytest.approx(power.sum()) and row.total_bins == power.size

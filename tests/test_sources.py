"""Readers, inventories, decoding, incremental load and the composite jobs."""

import gzip
import struct

import numpy as np
import pytest

from cohortweave.config import RunContext, SignalConfig, VolumeConfig, fused_model_config
from cohortweave.plans import jobs
from cohortweave.sources import codecs, decode, files, sinks, tables
from cohortweave.streaming.incremental import load_increment, loaded_rows

RUN = RunContext("run-001", "project", "stage", "2025-01-01T00:00:00")
EVENTS = "patient_id,event_time,value,source\np1,2025-01-01,1,a\np2,02/03/2025,2,NA\np3,never,x,\n"


@pytest.fixture
def events_csv(tmp_path):
    path = tmp_path / "events.csv"
    path.write_text(EVENTS)
    return str(path)


# --- tables ----------------------------------------------------------------------------------


def test_formats():
    assert [tables.infer_format(p) for p in ("A.CSV", "a.csv.gz", "a.parquet")] == ["csv", "csv.gz", "parquet"]
    assert tables.normalize_format(".GZ") == "csv.gz"
    for call in (tables.infer_format, tables.normalize_format):
        with pytest.raises(ValueError, match="Unsupported file format"):
            call("a.xlsx")


def test_load_csv(spark, events_csv):
    request = tables.TableRequest(
        events_csv, types={"value": "bigint"}, dates=["event_time", "gone"], date_formats=("MM/dd/yyyy",), required=["value"]
    )
    df, info = tables.load_table(spark, request)
    rows = df.orderBy("patient_id").collect()
    assert [str(r.event_time)[:10] for r in rows] == ["2025-01-01", "2025-02-03", "None"]
    assert [r.value for r in rows] == [1, 2, None] and [r.source for r in rows] == ["a", None, None]
    assert info.notes == ["file format inferred from path", "date parsing was requested"]
    meta = tables.load_metadata(df, info).first()
    assert meta.row_count == 3 and meta.column_names == ["patient_id", "event_time", "value", "source"]


def test_counts_are_taken_while_writing(spark, events_csv, tmp_path):
    request = tables.TableRequest(events_csv, types={"value": "bigint"})
    df, _ = tables.load_table(spark, request)
    stored, record = tables.store_with_metadata(spark, request, f"{tmp_path}/a")
    (row,) = record.collect()
    assert row.row_count == 3 and row.missing_counts == {c: df.filter(f"{c} IS NULL").count() for c in df.columns}
    assert sorted(map(str, stored.collect())) == sorted(map(str, df.collect())) and stored.schema == df.schema
    df.limit(0).write.parquet(f"{tmp_path}/none")
    _, none = tables.store_with_metadata(spark, tables.TableRequest(f"{tmp_path}/none", "parquet"), f"{tmp_path}/b")
    assert none.first().row_count == 0 and set(none.first().missing_counts.values()) == {0}


def test_projection_and_required(spark, events_csv):
    df, info = tables.load_table(spark, tables.TableRequest(events_csv, columns=["value", "patient_id", "value", "zz"]))
    assert df.columns == ["value", "patient_id"]
    assert "requested selected column missing: zz" in info.notes and "selected columns were used" in info.notes
    with pytest.raises(tables.RequiredColumnsMissing, match="q, r$"):
        tables.load_table(spark, tables.TableRequest(events_csv, required=["q", "value", "r", "q"]))
    with pytest.raises(FileNotFoundError):
        tables.load_table(spark, tables.TableRequest("/nowhere/x.csv"))


def test_gzip_parquet_and_quotes(spark, tmp_path, events_csv):
    path = tmp_path / "e.csv.gz"
    path.write_bytes(gzip.compress(b'patient_id,note\n007,"says ""hi"", twice"\n'))
    row = tables.load_table(spark, tables.TableRequest(str(path), spread=3))[0].first()
    assert (row.patient_id, row.note) == ("007", 'says "hi", twice')
    df, _ = tables.load_table(spark, tables.TableRequest(events_csv))
    stored = sinks.write_table(df, str(tmp_path / "deep" / "e.parquet"), sort_by=["patient_id"])
    assert tables.peek_columns(spark, stored) == df.columns and tables.peek_columns(spark, events_csv) == df.columns
    assert tables.load_table(spark, tables.TableRequest(stored))[0].count() == 3
    text = sinks.write_table(df, str(tmp_path / "out.csv"), "csv")
    again = sinks.reload(spark, text, "t", [])
    assert again.count() == 3 and {f.dataType.simpleString() for f in again.schema} == {"string"}
    assert sinks.reload(spark, text, "t", [], df.schema).schema == df.schema
    notes = []
    assert sinks.reload(spark, None, "EHR table", notes) is None
    sinks.hand_over(df.limit(0), str(tmp_path / "none"), "EHR table", notes)
    assert notes == ["EHR table path was not produced", "EHR table was empty"]


def test_extracts_and_checks(spark, events_csv, tmp_path):
    raw = spark.createDataFrame([("1", "G40")], "subject_id string, icd_code string")
    assert tables.normalize_diagnoses(raw).first().asDict() == {"patient_id": "1", "diagnosis_code": "G40"}
    assert tables.normalize_prescriptions(raw).first().medication_name == ""
    (tmp_path / "empty.csv").write_text("")
    details = [
        tables.check_table(spark, "t", p, req).first().detail
        for p, req in (
            (events_csv, ["value"]),
            (events_csv, ["b", "a"]),
            ("/nowhere/x.csv", None),
            (str(tmp_path / "empty.csv"), None),
        )
    ]
    assert details == ["present, rows=3", "missing columns: ['a', 'b']", "missing file", "file is empty"]


# --- inventories -----------------------------------------------------------------------------


def test_image_inventory(spark, tmp_path):
    for name in ("sub-01/anat/b_T1w.nii.gz", "sub-01/anat/a_T1w.nii.gz", "sub-02/func/x_T1w.nii.gz", "other/x_T1w.nii.gz"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    (tmp_path / "participants.tsv").write_text("participant_id\tage\tsite\nsub-01\t30\ta\nsub-03\tn/a\t1\n")
    people = tables.load_participants(spark, str(tmp_path / "participants.tsv"))
    rows = {r.subject_id: r for r in files.scan_images(spark, str(tmp_path), people).collect()}
    assert set(rows) == {"sub-01", "sub-02", "sub-03"}
    assert rows["sub-01"].t1_path == str(tmp_path / "sub-01/anat/a_T1w.nii.gz")
    assert not rows["sub-02"].has_t1 and not rows["sub-03"].has_t1
    assert {(r.age, r.site) for r in people.collect()} == {(30, "a"), (None, "1")}
    check = files.check_images(files.scan_images(spark, str(tmp_path)), "images", "/p", True).first()
    assert check.detail == "subjects=2, t1_files=1, participants_tsv=True"
    assert tables.load_participants(spark, "/nowhere/participants.tsv") is None
    with pytest.raises(FileNotFoundError):
        tables.load_participants(spark, "/nowhere/participants.tsv", required=True)
    with pytest.raises(FileNotFoundError):
        files.scan_images(spark, "/nowhere")


def test_recording_inventory(spark, tmp_path):
    for name in ("chb01/a.edf", "PT-7/day/sub-x/b.EDF", "misc/c.v2.edf", "misc/skip.txt"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x")
    inventory = files.scan_recordings(spark, str(tmp_path))
    assert sorted((r.patient_id, r.file_name) for r in inventory.collect()) == [
        ("c.v2", "c.v2.edf"),
        ("chb01", "a.edf"),
        ("sub-x", "b.EDF"),
    ]
    counts = files.recording_inventory_counts(inventory).first()
    assert (counts.file_count, counts.patient_count) == (3, 3)


# --- incremental load ------------------------------------------------------------------------


def test_incremental_load(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    schema = spark.createDataFrame([], "patient_id string, event_time string, value string").schema
    request = tables.TableRequest(str(landing), file_format="csv", types={"value": "int"}, required=["value"])
    paths = [str(tmp_path / p) for p in ("rows", "log", "state")]

    def drop(name, rows):
        (landing / name).write_text("patient_id,event_time,value\n" + "".join(f"p{i},2025-01-01,{i}\n" for i in range(rows)))

    drop("a.csv", 2)
    drop("b.csv", 1)
    log = load_increment(spark, request, schema, 1, *paths)
    assert sorted(r.row_count for r in log.collect()) == [1, 2]
    drop("c.csv", 5)
    log = load_increment(spark, request, schema, 1, *paths)  # only the new file
    assert sorted(r.row_count for r in log.collect()) == [1, 2, 5]
    loaded = spark.read.parquet(paths[0])
    assert loaded.count() == 8 and dict(loaded.dtypes)["value"] == "int"
    assert "chunking was used" in log.first().notes
    # A batch that was written but not acknowledged runs again after a restart and replaces itself.
    last = max(int(f.name) for f in (tmp_path / "state" / "commits").iterdir() if f.name.isdigit())
    (tmp_path / "state" / "commits" / str(last)).unlink()
    (tmp_path / "state" / "commits" / f".{last}.crc").unlink(missing_ok=True)
    drop("d.csv", 3)
    log = load_increment(spark, request, schema, 1, *paths)
    assert sorted(r.row_count for r in log.collect()) == [1, 2, 3, 5]
    found = loaded_rows(spark, paths[0], loaded.schema).groupBy("batch_id").count().collect()
    assert sorted(r["count"] for r in found) == [1, 2, 3, 5]
    with pytest.raises(ValueError, match="positive integer"):
        load_increment(spark, request, schema, 0, *paths)
    with pytest.raises(tables.RequiredColumnsMissing):
        load_increment(spark, tables.TableRequest(str(landing), "csv", required=["q"]), schema, 1, *paths)


# --- binary files ----------------------------------------------------------------------------


def edf_bytes(data, rate, seconds=1, dimension="uV"):
    """EDF file of whole data records."""
    channels, total = data.shape
    per = rate * seconds
    head = b"0".ljust(8) + b"x".ljust(80) * 2 + b"01.01.25" + b"00.00.00"
    head += str(256 * (channels + 1)).encode().ljust(8) + b" " * 44
    head += str(total // per).encode().ljust(8) + str(seconds).encode().ljust(8) + str(channels).encode().ljust(4)
    for width, text in ((16, "EEG"), (80, ""), (8, dimension), (8, "-100"), (8, "100"), (8, "-32768"), (8, "32767"), (80, ""), (8, str(per)), (32, "")):
        head += text.encode().ljust(width) * channels
    records = data.reshape(channels, -1, per).transpose(1, 0, 2)
    return head + records.astype("<i2").tobytes()


def mixed_edf_bytes(channels, seconds=1):
    """EDF file whose channels have their own numbers of samples per record."""
    records = 4
    per = [len(data) // records for data in channels]
    count = len(channels)
    head = b"0".ljust(8) + b"x".ljust(80) * 2 + b"01.01.25" + b"00.00.00"
    head += str(256 * (count + 1)).encode().ljust(8) + b" " * 44
    head += str(records).encode().ljust(8) + str(seconds).encode().ljust(8) + str(count).encode().ljust(4)
    for width, texts in ((16, ["EEG"]), (80, [""]), (8, ["uV"]), (8, ["-100"]), (8, ["100"]), (8, ["-32768"]), (8, ["32767"]), (80, [""]), (8, per), (32, [""])):
        head += b"".join(str(x).encode().ljust(width) for x in (texts if len(texts) == count else texts * count))
    body = b"".join(data.reshape(records, -1)[r].astype("<i2").tobytes() for r in range(records) for data in channels)
    return head + body


def nifti_bytes(volume, zooms=(1.0, 0.5, 2.0), slope=2.0, intercept=1.0):
    head = bytearray(352)
    struct.pack_into("<i", head, 0, 348)
    struct.pack_into("<8h", head, 40, 3, *volume.shape, 1, 1, 1, 1)
    struct.pack_into("<hh", head, 70, 4, 16)
    struct.pack_into("<8f", head, 76, 1.0, *zooms, 0, 0, 0, 0)
    struct.pack_into("<3f", head, 108, 352.0, slope, intercept)
    head[344:348] = b"n+1\x00"
    return gzip.compress(bytes(head) + volume.astype("<i2").tobytes(order="F"))


@pytest.fixture(scope="module")
def raw_data(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    rng = np.random.default_rng(12)
    signals = {f"chb{p:02d}": rng.integers(-3000, 3000, size=(2, 512)) for p in (1, 2, 3)}
    for patient, data in signals.items():
        (root / "eeg" / patient).mkdir(parents=True)
        (root / "eeg" / patient / "a.edf").write_bytes(edf_bytes(data, 64))
    (root / "eeg" / "chb01" / "broken.edf").write_bytes(b"nonsense")
    volumes = {f"sub-{p:02d}": rng.integers(0, 200, size=(8, 9, 7)) for p in (1, 2)}
    for subject, data in volumes.items():
        (root / "mri" / subject / "anat").mkdir(parents=True)
        (root / "mri" / subject / "anat" / "x_T1w.nii.gz").write_bytes(nifti_bytes(data))
    (root / "mri" / "sub-03" / "func").mkdir(parents=True)
    (root / "mri" / "sub-03" / "func" / "y.nii.gz").write_bytes(b"x")
    (root / "mri" / "sub-04" / "anat").mkdir(parents=True)
    (root / "mri" / "sub-04" / "anat" / "bad_T1w.nii.gz").write_bytes(b"bad")
    (root / "mri" / "participants.tsv").write_text("participant_id\tage\nsub-01\t30\n")
    return root, signals, volumes


def test_signal_job(spark, raw_data, tmp_path):
    root, signals, _ = raw_data
    given = jobs.SignalInput("eeg", f"{root}/eeg", codecs.edf(4.0), config=SignalConfig(max_seconds=4.0))
    result = jobs.signal_job(spark, given, RUN, str(tmp_path))
    rows = {r.patient_id: r for r in result.table.collect()}
    assert set(rows) == set(signals)
    for patient, raw in signals.items():
        volts = ((raw[:, :256] + 32768.0) * (200.0 / 65535.0) - 100.0) * 1e-6
        assert rows[patient].signal_rms == pytest.approx(np.sqrt((volts**2).mean()))
        assert rows[patient].recording_duration_seconds == 4.0 and rows[patient].sampling_frequency_hz == 64.0
        power = np.abs(np.fft.rfft(volts, axis=1)) ** 2
        assert rows[patient].spectral_power_mean == pytest.approx(power.mean())
    errors = result.errors.collect()
    assert [e.error_type for e in errors] == ["ValueError"] and errors[0].edf_path.endswith("broken.edf")
    assert result.counts.first().error_count == 1
    assert "1 recordings had feature extraction errors" in result.notes
    assert spark.read.json(result.paths["run_manifest"]).first().run_id == "run-001"


def test_recordings_of_several_rates(spark, tmp_path):
    """Channels of different rates all count; no such file reaches the error table."""
    rng = np.random.default_rng(6)
    slow, fast = rng.integers(-3000, 3000, size=4 * 37), rng.integers(-3000, 3000, size=4 * 50)
    (tmp_path / "eeg" / "chb07").mkdir(parents=True)
    (tmp_path / "eeg" / "chb07" / "a.edf").write_bytes(mixed_edf_bytes([slow, fast]))
    (tmp_path / "eeg" / "chb07" / "cut.edf").write_bytes(mixed_edf_bytes([slow, fast])[:-10])
    for limit in (None, 2.0):
        given = jobs.SignalInput("eeg", f"{tmp_path}/eeg", codecs.edf(limit), config=SignalConfig(max_seconds=limit))
        result = jobs.signal_job(spark, given, RUN, f"{tmp_path}/out-{limit}")
        (row,) = result.table.collect()
        volts = [((x[: int(len(x) * (limit or 4) / 4)] + 32768.0) * (200.0 / 65535.0) - 100.0) * 1e-6 for x in (slow, fast)]
        both = np.concatenate(volts)
        assert row.mean_signal_amplitude == pytest.approx(both.mean()) and row.signal_rms == pytest.approx(np.sqrt((both**2).mean()))
        assert (row.sampling_frequency_hz, row.channel_count, row.recording_duration_seconds) == (50.0, 2.0, limit or 4.0)
        power = np.concatenate([np.abs(np.fft.rfft(x)) ** 2 for x in volts])
        assert row.spectral_power_mean == pytest.approx(power.mean())
        assert [e.edf_path.rsplit("/", 1)[1] for e in result.errors.collect()] == ["cut.edf"]


def test_files_are_opened_by_tasks(spark, tmp_path):
    for k in range(70):
        (tmp_path / f"{k}.bin").write_bytes(b"late" if k == 5 else b"x" * k)
    paths = [(k, f"{tmp_path}/{k}.bin") for k in range(71)] + [(99, None), (70, f"file://{tmp_path}/3.bin")]
    inventory = spark.createDataFrame(paths, "k int, at string")

    def decoder(content):
        yield {"v": [len(content)] * 2}
        if content == b"late":
            raise OSError("cut off")

    decoded = decode.stored(decode.read_files(inventory, "at", ["k"], decoder, spark.createDataFrame([], "v bigint").schema), f"{tmp_path}/out")
    rows = sorted((r.k, r.v) for r in decode.decoded_rows(decoded).collect())
    assert rows == sorted([(k, k) for k in range(70) if k != 5] * 2 + [(70, 3)] * 2)
    assert sorted((r.k, r.error_type) for r in decode.decode_errors(decoded, ["k"]).collect()) == [(5, "OSError"), (70, "FileNotFoundError")]
    none = decode.read_files(inventory.limit(0), "at", ["k"], decoder, spark.createDataFrame([], "v bigint").schema)
    assert none.count() == 0 and none.columns == ["k", "v", "error_type", "error_message"]


def test_image_job(spark, raw_data, tmp_path):
    root, _, volumes = raw_data
    given = jobs.ImageInput("mri", f"{root}/mri", codecs.nifti, config=VolumeConfig(levels=8))
    result = jobs.image_job(spark, given, RUN, str(tmp_path))
    rows = {r.subject_id: r for r in result.table.collect()}
    assert set(rows) == set(volumes) and rows["sub-01"].age == 30
    for subject, raw in volumes.items():
        data = raw.astype(np.float32) * 2 + 1
        inside = data[data > np.percentile(data, 20)]
        assert rows[subject].t1_intensity_mean == pytest.approx(inside.mean(), rel=1e-6)
        assert rows[subject].foreground_voxel_count == inside.size and rows[subject].voxel_size_y == 0.5
        assert rows[subject].shape_z == 7 and rows[subject].glcm_energy_mean > 0
    kinds = {e.subject_id: e.error_type for e in result.errors.collect()}
    assert kinds["sub-03"] == "missing_t1" and kinds["sub-04"] != "missing_t1"


def test_half_decoded_file_gives_no_rows(spark):
    def decoder(content):
        yield {"v": [1, 2]}
        if content == b"late":
            raise OSError("cut off")

    schema = spark.createDataFrame([], "v bigint").schema
    source = spark.createDataFrame([("ok", bytearray(b"fine")), ("no", bytearray(b"late"))], "k string, content binary")
    decoded = decode.decode(source, ["k"], decoder, schema)
    assert {(r.k, r.v) for r in decode.decoded_rows(decoded).collect()} == {("ok", 1), ("ok", 2)}
    assert [(r.k, r.error_type, r.error_message) for r in decode.decode_errors(decoded, ["k"]).collect()] == [
        ("no", "OSError", "cut off")
    ]


# --- jobs ------------------------------------------------------------------------------------


def test_record_job_from_files(spark, tmp_path):
    (tmp_path / "dx.csv").write_text("patient_id,diagnosis_code\np1,G40.9\np2,I10\n")
    (tmp_path / "rx.csv").write_text(
        "patient_id,medication_name,medication_start\np1,keppra,2025-01-01\np1,lamotrigine,2025-02-01\n"
    )
    (tmp_path / "ev.csv").write_text("patient_id,event_time\np1,2025-02-02\n")
    given = jobs.RecordInput(
        "set", *[tables.TableRequest(str(tmp_path / f"{n}.csv")) for n in ("dx", "rx", "ev")]
    )
    result = jobs.record_job(spark, given, RUN, str(tmp_path / "out"))
    rows = {r.patient_id: r.likely_dre for r in result.table.collect()}
    assert rows == {"p1": True, "p2": False}
    assert result.counts.first().likely_dre_positive_count == 1
    assert result.notes[0].startswith("diagnoses table loaded from ")
    profile = spark.read.json(f"{result.paths['dataset_profile']}/class_balance")
    assert {r.label_value: r["count"] for r in profile.collect()} == {"True": 1, "False": 1}


def test_record_job_without_tables(spark, tmp_path):
    result = jobs.record_job(spark, jobs.RecordInput("none"), RUN, str(tmp_path))
    assert result.table.count() == 0 and len(result.table.columns) == 17
    assert "medications table request absent" in result.notes and "no patients found in provided EHR tables" in result.notes


def test_multimodal_job(spark, tmp_path):
    rng = np.random.default_rng(3)
    dx, rx, ev = [], [], []
    for i in range(24):
        dx.append((f"sub-{i:02d}", "G40"))
        rx += [(f"sub-{i:02d}", "clobazam", "2025-01-01"), (f"sub-{i:02d}", "phenytoin", "2025-02-01")]
        ev.append((f"sub-{i:02d}", "2025-03-01" if i % 2 else "2025-01-02"))
    records = jobs.RecordInput(
        "records",
        spark.createDataFrame(dx, "patient_id string, diagnosis_code string"),
        spark.createDataFrame(rx, "patient_id string, medication_name string, medication_start string"),
        spark.createDataFrame(ev, "patient_id string, event_time string"),
    )
    voxels = [
        (f"sub-{i:02d}", x, y, z, float(rng.normal() + i % 2)) for i in range(20) for x in range(3) for y in range(4) for z in range(2)
    ]
    headers = [(f"sub-{i:02d}", "/x", 1.0, 1.0, 1.0) for i in range(20)]
    images = jobs.ImageInput(
        "images",
        voxels=spark.createDataFrame(voxels, "subject_id string, x int, y int, z int, value float"),
        headers=spark.createDataFrame(headers, "subject_id string, t1_path string, zoom_x double, zoom_y double, zoom_z double"),
    )
    given = jobs.MultimodalInput("all", records, images, model=fused_model_config())
    result = jobs.multimodal_job(spark, given, RUN, str(tmp_path))
    counts = result.counts.first()
    assert (counts.row_count, counts.patients_with_ehr, counts.patients_with_mri, counts.patients_with_eeg) == (24, 24, 20, 0)
    assert "EEG input config was not provided" in result.notes
    assert "MRI subject identifiers linked through identity linkage layer" in result.notes
    assert "mri_t1_intensity_mean" in result.training.features and "ehr_likely_dre" in result.training.leakage.leakage
    bundle = spark.read.json(result.paths["reporting_bundle"]).first()
    assert bundle.pipeline_summary.row_count == 24 and bundle.dataset_profile_summary.row_count == 24
    with pytest.raises(ValueError, match="At least one modality"):
        jobs.multimodal_job(spark, jobs.MultimodalInput("none"), RUN, str(tmp_path))
    with pytest.raises(ValueError, match="No usable patient-level"):
        jobs.multimodal_job(spark, jobs.MultimodalInput("e", jobs.RecordInput("none")), RUN, str(tmp_path / "e"))


def test_large_file_is_read_in_pieces(spark, tmp_path):
    """A decoder of open files never holds a whole file; a broken character at the end is still an error row."""
    import tracemalloc

    from cohortweave.plans.catalog_sources import _LINE, _count_lines

    line = "zwölf Wörter 漢字 and more".encode() + b"\n"
    (tmp_path / "good.txt").write_bytes(line * 800_000)
    (tmp_path / "bad.txt").write_bytes(line + "ü".encode()[:1])
    tracemalloc.start()
    with open(tmp_path / "good.txt", "rb") as file:
        (found,) = _count_lines(file)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {"line_no": [800_000], "n_chars": [800_000 * (len(line.decode()) - 1)]} and peak < 12 << 20
    listed = spark.createDataFrame([(n, str(tmp_path / n)) for n in ("good.txt", "bad.txt")], "name string, path string")
    rows = {r.name: r for r in decode.read_files(listed, "path", ["name"], _count_lines, _LINE).collect()}
    assert rows["good.txt"].line_no == 800_000 and rows["good.txt"].error_type is None
    assert rows["bad.txt"].error_type == "UnicodeDecodeError" and rows["bad.txt"].line_no is None

"""Small decoders for the two binary formats of the file jobs.

They follow the public EDF and NIfTI-1 file layouts and yield column dictionaries
for ``decode``. Any other decoder with the same output works as well.
"""

from __future__ import annotations

import gzip
import struct
from collections.abc import Iterator

import numpy as np

# Factor from a physical dimension to volts.
VOLTS = {"V": 1.0, "mV": 1e-3, "uV": 1e-6, "µV": 1e-6, "nV": 1e-9}
SEGMENT = 65_536  # samples per segment
# NIfTI-1 data type code -> numpy type.
NIFTI_TYPES = {
    2: "u1",
    4: "i2",
    8: "i4",
    16: "f4",
    64: "f8",
    256: "i1",
    512: "u2",
    768: "u4",
}


def _fields(raw: bytes, width: int) -> list[str]:
    return [raw[i : i + width].decode("latin-1").strip() for i in range(0, len(raw), width)]


def edf(max_seconds: float | None = None):
    """Decoder of EDF recordings into segments; potentials come out in volts, each channel at its own rate.

    With ``max_seconds`` (the limit of the signal settings) only the data records that
    hold these first seconds are converted, plus the very last sample without a value,
    so that the recording's full duration stays known.
    """

    def run(content: bytes) -> Iterator[dict[str, np.ndarray]]:
        header_bytes, records = int(content[184:192]), int(content[236:244])
        seconds, count = float(content[244:252]), int(content[252:256])
        widths = (16, 80, 8, 8, 8, 8, 8, 80, 8, 32)
        starts = np.cumsum([0, *widths]) * count + 256
        columns = [_fields(content[a:b], w) for a, b, w in zip(starts[:-1], starts[1:], widths)]
        labels, dimensions = columns[0], columns[2]
        lows, highs, digital_lows, digital_highs = (np.array(columns[k], dtype=float) for k in (3, 4, 5, 6))
        sizes = [int(x) for x in columns[8]]
        per_record = sum(sizes)
        if records < 0:
            records = (len(content) - header_bytes) // (2 * per_record)
        kept = [k for k, name in enumerate(labels) if name != "EDF Annotations"]
        data = np.frombuffer(content, "<i2", records * per_record, header_bytes).reshape(records, per_record)
        used = records
        if max_seconds:
            used = min(records, int(np.ceil(max_seconds / seconds)))
        offsets = np.cumsum([0, *sizes])
        for number, k in enumerate(kept):
            gain = (highs[k] - lows[k]) / (digital_highs[k] - digital_lows[k])
            raw = data[:used, offsets[k] : offsets[k + 1]].reshape(-1)
            value = ((raw - digital_lows[k]) * gain + lows[k]) * VOLTS.get(dimensions[k], 1.0)
            pieces = [(at, value[at : at + SEGMENT]) for at in range(0, value.size, SEGMENT)]
            if used < records:
                pieces.append((records * sizes[k] - 1, np.array([np.nan])))
            for start, values in pieces:
                yield {"channel": [number], "start": [start], "sfreq": [sizes[k] / seconds], "values": [values]}

    run.validates_first = True  # sizes and numbers of the header are used before the first piece
    return run


def nifti(content: bytes) -> Iterator[dict[str, np.ndarray]]:
    """Decoder of NIfTI-1 volumes into image rows, one piece per slice, in single precision."""
    if content[:2] == b"\x1f\x8b":
        content = gzip.decompress(content)
    order = "<" if struct.unpack("<i", content[:4])[0] == 348 else ">"
    if struct.unpack(order + "i", content[:4])[0] != 348 or content[344:347] not in (b"n+1", b"ni1"):
        raise ValueError("not a NIfTI-1 file")
    dims = struct.unpack(order + "8h", content[40:56])
    code = struct.unpack(order + "h", content[70:72])[0]
    zooms = struct.unpack(order + "8f", content[76:108])[1:4]
    offset, slope, intercept = struct.unpack(order + "3f", content[108:120])
    if dims[0] < 3 or any(n > 1 for n in dims[4 : dims[0] + 1]):
        raise ValueError(f"expected one 3-D volume, got dimensions {dims[1 : dims[0] + 1]}")
    if code not in NIFTI_TYPES:
        raise ValueError(f"unsupported data type code {code}")
    nx, ny, nz = dims[1:4]
    raw = np.frombuffer(content, order + NIFTI_TYPES[code], nx * ny * nz, int(offset))
    volume = raw.reshape((nx, ny, nz), order="F").astype(np.float32)
    if np.isfinite(slope) and slope != 0 and (slope != 1 or intercept != 0):
        volume = volume * np.float32(slope) + np.float32(intercept)
    sizes = {f"zoom_{axis}": np.full(nx, float(zoom)) for axis, zoom in zip("xyz", zooms)}
    for z in range(nz):
        yield {"x": np.arange(nx, dtype=np.int32), "z": np.full(nx, z, dtype=np.int32), "values": list(volume[:, :, z]), **sizes}


nifti.validates_first = True

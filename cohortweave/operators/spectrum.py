"""Spectral sums of channels of any length, held as segments.

A channel that fits one task is transformed in one piece. A longer one is laid out as a table of ``rows`` x ``columns``
samples, row by row, and transformed in two passes: along the columns, then, after a turn of each entry, along the rows.
Both need groups of about the root of the length only. Where the length is no product of two such numbers, the
transform becomes a convolution with a chirp, padded to a power of two: the same two passes for the signal and for the
chirp, a product, and two passes back. Groups exchange packed tiles, not samples; groups of many short channels are transformed together.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortweave.config import BANDS
from cohortweave.functions.skew import lookup_join

CHANNEL = ["patient_id", "recording_id", "channel"]
TILE = 256  # places or bins per tile side, at most
LEAST_TILE = 16  # and at least, where the side has as many; smaller ones would cost more than they carry
STACK_BYTES = 16 << 20  # groups of short channels that are transformed at once

_KEY = "patient_id string, recording_id string, channel int"
_LAYOUT = "length bigint, sfreq double, rows bigint, columns bigint, padded boolean"
POWER = T.StructType(
    [
        T.StructField("patient_id", T.StringType()),
        T.StructField("recording_id", T.StringType()),
        T.StructField("channel", T.IntegerType()),
        T.StructField("total_power", T.DoubleType()),
        T.StructField("total_bins", T.LongType()),
        *[
            T.StructField(f"{name}_{part}", dtype)
            for name, _, _ in BANDS
            for part, dtype in (("power", T.DoubleType()), ("bins", T.LongType()))
        ],
    ]
)
_ARROW_POWER = to_arrow_schema(POWER)


def _band_row(key: tuple, power: np.ndarray, hertz: np.ndarray) -> tuple:
    """Power sums and bin counts of a channel's bins, total and per band."""
    row = [*key, float(power.sum()), power.size]
    for _, low, high in BANDS:
        inside = (hertz >= low) & (hertz < high)
        row += [float(power[inside].sum()), int(inside.sum())]
    return tuple(row)


def _band_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(cells, type=f.type) for cells, f in zip(zip(*rows), _ARROW_POWER)]
    return pa.RecordBatch.from_arrays(columns, schema=_ARROW_POWER)


def _finite(values: np.ndarray) -> np.ndarray:
    return np.where(np.isfinite(values), values, 0.0)


def _values(cell: pa.Scalar) -> np.ndarray:
    return _finite(cell.values.to_numpy(zero_copy_only=False)) if cell.is_valid else np.zeros(0)


# --- channels of one task ---------------------------------------------------------------------


def _whole(key: tuple, parts: list[tuple[int, np.ndarray]], rate: float) -> tuple:
    signal = np.zeros(max(start + len(values) for start, values in parts))
    for start, values in parts:
        signal[start : start + len(values)] = values
    if not rate > 0 or not signal.size:
        return _band_row(key, np.zeros(0), np.zeros(0))
    return _band_row(key, np.abs(np.fft.rfft(signal)) ** 2, np.fft.rfftfreq(signal.size, d=1.0 / rate))


def _whole_channels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Transform the channels of a partition, whose segments come one after the other."""
    key, parts, rate = None, [], 0.0
    for batch in batches:
        done = []
        keys = list(zip(*(batch.column(c).to_pylist() for c in CHANNEL)))
        for i, (current, start, sfreq) in enumerate(zip(keys, batch.column("start").to_pylist(), batch.column("sfreq").to_pylist())):
            if parts and current != key:
                done.append(_whole(key, parts, rate))
                parts = []
            key, rate = current, sfreq or 0.0
            parts.append((start, _values(batch.column("values")[i])))
        if done:
            yield _band_batch(done)
    if parts:
        yield _band_batch([_whole(key, parts, rate)])


# --- channels of several tasks -----------------------------------------------------------------


def long_channels(segments: DataFrame, task_samples: int) -> DataFrame:
    """Channels of more than ``task_samples`` samples, and how each is laid out.

    The table has the nearest factors of the length when rows and columns fit a task; else it is padded
    to a power of two of at least twice the length.
    """
    factor = "array_max(filter(sequence(1L, cast(sqrt(length) AS bigint)), d -> length % d = 0))"
    shift = "cast(ceil(log2(2 * length)) AS int)"
    return (
        segments.groupBy(*CHANNEL)
        .agg(F.expr("max(start + size(values)) AS length"), F.expr("max(sfreq) AS sfreq"))
        .filter(f"length > {int(task_samples)}")
        .selectExpr("*", f"{factor} AS factor", f"{shift} AS bits")
        .selectExpr("*", f"length div factor > least({int(task_samples)}, 64 * factor) AS padded")
        .selectExpr(
            *CHANNEL,
            "length",
            "sfreq",
            "if(padded, shiftleft(1L, bits div 2), factor) AS rows",
            "if(padded, shiftleft(1L, bits - bits div 2), length div factor) AS columns",
            "padded",
        )
    )


def _chirp(index: np.ndarray, length: int) -> np.ndarray:
    """exp(i pi n^2 / length); the square is reduced in whole numbers first."""
    n = index.astype(object) if length > 1 << 30 else index
    return np.exp(1j * np.pi * ((n * n) % (2 * length)).astype(np.float64) / length)


def _turn(a: np.ndarray, b: np.ndarray, size: int, sign: int) -> np.ndarray:
    return np.exp(sign * 2j * np.pi * ((a[:, None] * b[None, :]) % size) / size)


def _tiles(total: int) -> list[tuple[int, int]]:
    """Bounds of the tiles of a side: about the root of its length, so that tiles and groups grow alike."""
    width = min(TILE, max(LEAST_TILE, int(np.sqrt(total))))
    return [(a, min(a + width, total)) for a in range(0, total, width)]


_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary()}
_BASE = [*CHANNEL, "length", "sfreq", "rows", "columns", "padded"]


def _packed(base: pa.Table, schema: str, **columns) -> Iterator[pa.RecordBatch]:
    """Rows of key and layout with further columns beside them."""
    fields = [field.split(" ") for field in schema.split(", ")]
    arrays = [columns[n] if n in columns else base[n].combine_chunks() for n, _ in fields]
    arrays = [a if isinstance(a, pa.Array) else pa.array(a, type=_ARROW[kind]) for a, (_, kind) in zip(arrays, fields)]
    yield pa.RecordBatch.from_arrays(arrays, schema=pa.schema([(n, _ARROW[kind]) for n, kind in fields]))


def _cells(block: np.ndarray) -> pa.Array:
    """One packed cell for each entry of the first axis."""
    size = block[0].nbytes
    offsets = np.arange(len(block) + 1, dtype=np.int32) * np.int32(size)
    return pa.Array.from_buffers(pa.binary(), len(block), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(block))])


_PIECE = f"{_KEY}, {_LAYOUT}, tile int, line bigint, data binary"


def _cut_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut segments into pieces of one table row, and these by tiles of columns."""
    for batch in batches:
        base = pa.Table.from_batches([batch.select(_BASE)])
        at, tiles, lines, data, size = [], [], [], [], 0
        starts, widths, padded = (batch.column(c).to_pylist() for c in ("start", "columns", "padded"))
        for i, (start, columns) in enumerate(zip(starts, widths)):
            values = _values(batch.column("values")[i])
            if not len(values):
                continue
            # Whole lines of the table around the segment; cells outside it are zero and add nothing.
            first, last = start // columns, (start + len(values) - 1) // columns
            table = np.zeros((last - first + 1) * columns)
            table[start - first * columns :][: len(values)] = values
            table = table.reshape(-1, columns)
            covered = np.arange(table.size).reshape(table.shape) - (start - first * columns)
            met = ((covered >= 0) & (covered < len(values))).any(axis=0)  # columns that hold a sample
            for t, (a, b) in enumerate(_tiles(columns)):
                # The chirp needs all its tiles, those without a sample too.
                if met[a:b].any() or padded[i]:
                    at.append(i)
                    tiles.append(t)
                    lines.append(first)
                    data.append(table[:, a:b].tobytes() if met[a:b].any() else b"")
                    size += len(data[-1])
            if size > STACK_BYTES:
                yield from _packed(base.take(pa.array(at)), _PIECE, tile=tiles, line=lines, data=data)
                at, tiles, lines, data, size = [], [], [], [], 0
        if at:
            yield from _packed(base.take(pa.array(at)), _PIECE, tile=tiles, line=lines, data=data)


def _changes(table: pa.Table, columns: list[str]) -> np.ndarray:
    """Places of a sorted table where one of the columns changes, and its first and last place."""
    changed = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
    for c in columns:
        cells = table[c].combine_chunks()
        changed |= pc.not_equal(cells[1:], cells[:-1]).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])


def _stacked(function: Callable[..., Iterator[pa.RecordBatch]], place: str, cells: Callable[[int, int, int], int]):
    """Run ``function`` on stacks of groups of one layout and place, whose rows come one after the other.

    A group is a channel's part at one ``place`` (a tile or band of bins). Many groups of short channels share a stack; its
    size is bounded by their cells, and a group that is larger is a stack of its own. The function gets the first row of
    each group, the layout, and for each row the number of its group, its row in the table and its data.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def stacks(last: bool) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            groups = _changes(table, ["length", place, *CHANNEL])
            # The last group may go on in the next batch.
            whole = groups if last else groups[:-1]
            held[:] = [] if last else table.slice(whole[-1]).to_batches()
            kinds = _changes(table.slice(0, whole[-1]), ["length", place]) if len(whole) > 1 else []
            for low, high in zip(kinds[:-1], kinds[1:]):
                first = table.slice(low, 1).to_pylist()[0]
                inside = whole[(whole >= low) & (whole <= high)]
                each = max(1, STACK_BYTES // (16 * cells(first["rows"], first["columns"], first[place])))
                for k in range(0, len(inside) - 1, each):
                    cut = inside[k : k + each + 1]
                    part = table.slice(cut[0], cut[-1] - cut[0])
                    owner = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
                    yield from function(part.select(_BASE).take(pa.array(cut[:-1] - cut[0])), first, owner, part)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                yield from stacks(False)
        if held:
            yield from stacks(True)

    return run


def _grouped(df: DataFrame, place: str, run: Callable, schema) -> DataFrame:
    """Bring the rows of each channel's place together, those of one layout side by side."""
    return df.repartition(*CHANNEL, place).sortWithinPartitions("length", place, *CHANNEL).mapInArrow(run, schema)


_TURNED = f"{_KEY}, {_LAYOUT}, bins int, tile int, data binary, chirp binary"


def _columns_forward(base: pa.Table, layout: dict, owner: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Transform the columns of one tile, and those of the chirp where one is needed; turn them, and cut by bins."""
    length, rows, columns, tile = (layout[f] for f in ("length", "rows", "columns", "tile"))
    a, b = _tiles(columns)[tile]
    places = np.arange(a, b)
    block = np.zeros((base.num_rows, rows, b - a), dtype=complex if layout["padded"] else float)
    for g, line, data in zip(owner, table["line"].to_pylist(), table["data"].to_pylist()):
        if data:
            part = np.frombuffer(data).reshape(-1, b - a)
            fits = min(len(part), rows - line)
            block[g, line : line + fits] += part[:fits]
    turn = _turn(np.arange(rows), places, rows * columns, -1)
    chirp = None
    if layout["padded"]:
        index = places[None, :] + columns * np.arange(rows)[:, None]
        block *= np.where(index < length, np.conj(_chirp(np.minimum(index, length), length)), 0)
        around = np.minimum(index, rows * columns - index)  # the chirp runs both ways around zero
        chirp = np.where(around < length, _chirp(np.minimum(around, length), length), 0)
        chirp = np.fft.fft(chirp, axis=0) * turn
    block = np.fft.fft(block, axis=1) * turn
    same = np.full(base.num_rows, tile, dtype=np.int32)
    for k, (low, high) in enumerate(_tiles(rows)):
        sent = [None if chirp is None else chirp[low:high].tobytes()] * base.num_rows
        yield from _packed(base, _TURNED, bins=np.full(base.num_rows, k, dtype=np.int32), tile=same, data=_cells(block[:, low:high]), chirp=sent)


def _assembled(owner: np.ndarray, table: pa.Table, column: str, shape: tuple[int, int, int]) -> np.ndarray:
    """Tiles of one band of bins side by side, for each group."""
    block = np.zeros(shape, dtype=complex)
    bounds = _tiles(shape[2])
    for g, tile, data in zip(owner, table["tile"].to_pylist(), table[column].to_pylist()):
        a, b = bounds[tile]
        block[g, :, a:b] = np.frombuffer(data, dtype=complex).reshape(shape[1], b - a)
    return block


def _rows_power(base: pa.Table, layout: dict, owner: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Transform the rows of one band of bins: every ``rows``-th frequency of the channel, from each bin on."""
    length, rows, columns = (layout[f] for f in ("length", "rows", "columns"))
    low, high = _tiles(rows)[layout["bins"]]
    power = np.abs(np.fft.fft(_assembled(owner, table, "data", (base.num_rows, high - low, columns)), axis=2)) ** 2
    frequency = np.arange(low, high)[:, None] + rows * np.arange(columns)[None, :]
    yield _told(base, power, frequency, length)


def _told(base: pa.Table, power: np.ndarray, frequency: np.ndarray, length: int) -> pa.RecordBatch:
    kept = frequency <= length // 2
    power, frequency = power[:, kept], frequency[kept]
    keys = list(zip(*(base[c].to_pylist() for c in CHANNEL)))
    rates = np.array(base["sfreq"].to_pylist())
    rows: list = [None] * len(keys)
    for rate in np.unique(rates):
        own = np.flatnonzero(rates == rate)
        hertz = frequency * (rate / length)
        sums, bins = [power[own].sum(axis=1)], [frequency.size]
        for _, low, high in BANDS:
            inside = (hertz >= low) & (hertz < high)
            sums.append(power[own][:, inside].sum(axis=1))
            bins.append(int(inside.sum()))
        for i, found in zip(own, np.array(sums).T.tolist()):
            rows[i] = (*keys[i], *[cell for pair in zip(found, bins) for cell in pair])
    return _band_batch(rows)


_BACK = f"{_KEY}, {_LAYOUT}, bins int, tile int, data binary"


def _rows_convolved(base: pa.Table, layout: dict, owner: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Transform the rows of signal and chirp, multiply, go back along the rows, turn, and cut by columns."""
    rows, columns, bins = (layout[f] for f in ("rows", "columns", "bins"))
    low, high = _tiles(rows)[bins]
    one = table.slice(0, int((owner == 0).sum()))  # channels of one length have one chirp
    chirp = np.fft.fft(_assembled(np.zeros(one.num_rows, dtype=int), one, "chirp", (1, high - low, columns)), axis=2)
    signal = np.fft.fft(_assembled(owner, table, "data", (base.num_rows, high - low, columns)), axis=2)
    back = np.fft.ifft(signal * chirp, axis=2) * _turn(np.arange(low, high), np.arange(columns), rows * columns, 1)
    same = np.full(base.num_rows, bins, dtype=np.int32)
    for t, (a, b) in enumerate(_tiles(columns)):
        yield from _packed(base, _BACK, bins=same, tile=np.full(base.num_rows, t, dtype=np.int32), data=_cells(back[:, :, a:b]))


def _columns_power(base: pa.Table, layout: dict, owner: np.ndarray, table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Go back along the columns of one tile: frequencies of the channel, up to a factor of size one."""
    length, rows, columns = (layout[f] for f in ("length", "rows", "columns"))
    a, b = _tiles(columns)[layout["tile"]]
    block = np.zeros((base.num_rows, rows, b - a), dtype=complex)
    bands = _tiles(rows)
    for g, bins, data in zip(owner, table["bins"].to_pylist(), table["data"].to_pylist()):
        low, high = bands[bins]
        block[g, low:high] = np.frombuffer(data, dtype=complex).reshape(high - low, b - a)
    power = np.abs(np.fft.ifft(block, axis=1)) ** 2
    frequency = np.arange(a, b)[None, :] + columns * np.arange(rows)[:, None]
    yield _told(base, power, frequency, length)


def _long_power(segments: DataFrame) -> DataFrame:
    """Sums of each group's own frequencies of channels that carry their layout."""
    # Cells of a group: a tile of columns over all rows, or a band of bins over all columns.
    def tall(rows: int, columns: int, tile: int) -> int:
        a, b = _tiles(columns)[tile]
        return rows * (b - a)

    def wide(rows: int, columns: int, bins: int) -> int:
        low, high = _tiles(rows)[bins]
        return columns * (high - low)

    pieces = segments.filter("sfreq > 0").mapInArrow(_cut_lines, _PIECE)
    forward = _grouped(pieces, "tile", _stacked(_columns_forward, "tile", tall), _TURNED)
    direct = _grouped(forward.filter("NOT padded"), "bins", _stacked(_rows_power, "bins", wide), POWER)
    convolved = _grouped(forward.filter("padded"), "bins", _stacked(_rows_convolved, "bins", wide), _BACK)
    return direct.unionByName(_grouped(convolved, "tile", _stacked(_columns_power, "tile", tall), POWER))


def band_power(segments: DataFrame, task_samples: int) -> DataFrame:
    """Spectral sums per channel and group of frequencies, to be added up per recording.

    Gaps count as zeros, like missing samples. A channel without a positive rate has no bins.
    """
    needed = segments.select(*CHANNEL, "start", "sfreq", "values").dropna(subset=CHANNEL)
    long = long_channels(needed, task_samples)
    # What a long channel holds in its first places is transformed in vain; that bounds the task, and the samples
    # of all others are sent once. Its row is taken back.
    first = needed.filter(f"start < {int(task_samples)}").repartition(*CHANNEL).sortWithinPartitions(*CHANNEL)
    whole = lookup_join(first.mapInArrow(_whole_channels, POWER), long.select(*CHANNEL), CHANNEL, "left_anti")
    return whole.unionByName(_long_power(lookup_join(needed, long.drop("sfreq"), CHANNEL, "inner")))

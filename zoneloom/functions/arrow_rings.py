"""Ring columns between Arrow and numpy, without a Python object per point."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_POINTS = 250_000  # coordinates that are worked on together


def ring_arrays(column) -> tuple:
    """All points as one (n, 2) array, where each ring begins in it, where each row begins in the rings, and which rows
    are not NULL."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rings = column.flatten()
    pts = rings.flatten()
    xy = np.column_stack(
        [pc.struct_field(pts, f).to_numpy(zero_copy_only=False) for f in ("x", "y")]
    )
    lengths = lambda a: pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False)
    point_at = np.concatenate([[0], np.cumsum(lengths(rings))])
    ring_at = np.concatenate([[0], np.cumsum(lengths(column))])
    return xy, point_at, ring_at, column.is_valid().to_numpy(zero_copy_only=False)


def read_rings(column) -> list:
    """Per row the list of its rings as (n, 2) arrays; None for NULL."""
    xy, point_at, ring_at, present = ring_arrays(column)
    return [
        [xy[point_at[r] : point_at[r + 1]] for r in range(ring_at[i], ring_at[i + 1])]
        if present[i]
        else None
        for i in range(len(column))
    ]


def chunks(sizes):
    """Runs of rows with about ``CHUNK_POINTS`` coordinates each."""
    begin, points = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if points and points + n > CHUNK_POINTS:
            yield begin, i
            begin, points = i, 0
        points += n
    if begin < len(sizes):
        yield begin, len(sizes)


def ring_list(xy, lengths) -> pa.Array:
    """One list of points per ring, from all points end to end."""
    pts = pa.StructArray.from_arrays(
        [pa.array(np.ascontiguousarray(xy[:, k])) for k in (0, 1)], names=["x", "y"]
    )
    ring_off = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ring_off), pts)


def write_rings(rows: list) -> pa.Array:
    """The reverse of ``read_rings``."""
    valid = np.array([r is not None for r in rows], dtype=bool)
    rings = [ring for r in rows if r is not None for ring in r]
    inner = ring_list(np.vstack(rings) if rings else np.empty((0, 2)), [len(r) for r in rings])
    row_off = np.concatenate([[0], np.cumsum([len(r) if r is not None else 0 for r in rows])])
    row_off = row_off.astype(np.int32)
    if valid.all():
        return pa.ListArray.from_arrays(pa.array(row_off), inner)
    missing = np.concatenate([~valid, [False]])
    return pa.ListArray.from_arrays(pa.array(row_off, mask=missing), inner)


def repeat_rows(batch: pa.RecordBatch, rows: list[int], new: dict[str, pa.Array]) -> pa.RecordBatch:
    """Attributes of ``rows`` (with repeats) beside new columns, in the batch's column order."""
    at = pa.array(rows, pa.int64())
    names = batch.schema.names + [n for n in new if n not in batch.schema.names]
    return pa.RecordBatch.from_arrays(
        [new[n] if n in new else batch.column(n).take(at) for n in names], names=names
    )


def map_parts(batches, geometry: str, work, chunk_points: int = 500_000):
    """Run ``work(row index, rings, batch) -> [(rings, extra dict)]`` and emit bounded batches."""
    for batch in batches:
        rows, out, extra, points = [], [], {}, 0

        def flush():
            new = {n: pa.array(v, t) for n, (t, v) in extra.items()}
            return repeat_rows(batch, rows, {**new, geometry: write_rings(out)})

        for i, rings in enumerate(read_rings(batch.column(geometry))):
            for piece, more in work(i, rings, batch):
                rows.append(i)
                out.append(piece)
                for name, (kind, value) in more.items():
                    extra.setdefault(name, (kind, []))[1].append(value)
                points += sum(len(r) for r in piece or ())
                if points >= chunk_points:
                    yield flush()
                    rows, out, extra, points = [], [], {}, 0
        if rows:
            yield flush()

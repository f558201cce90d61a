"""Which 64-bit grams occur in more than one row, without a row for each gram.

Every task cuts its rows into batches, drops grams repeated within a batch to one entry that is
marked as shared, and sends the rest as 32-bit prints, packed by the leading bits of the gram. A part
holds at most one entry of a gram from each batch, so a gram that a third of all rows have makes no
large part. The answer goes back by batch and comes out by row. Two grams may share a print, so the
answer can hold a few grams too many, never one too few: callers verify.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from zoneloom.llm.common import blobs, mix, slices, text_bytes

BATCH_BYTES = 8 << 20
SHARED = np.uint16(0xFFFF)
BATCH_ROWS = 60_000
SENT = "part int, batch long, kind int, a binary, b binary"  # of keys, b has what is noted of each row
BACK = "part int, batch long, kind int, a binary, b binary"
GRAM, KNOWN, KEYS, HOT = 0, 1, 2, 3
HOT_BATCHES = 256


def kept_bits(part_bits: int) -> np.uint64:
    """The bits of a gram that the answer keeps."""
    return np.uint64(((1 << (part_bits + 32)) - 1) << (32 - part_bits))


def _prints(grams: np.ndarray, part_bits: int) -> np.ndarray:
    return (grams >> np.uint64(32 - part_bits)).astype(np.uint32)


def _part_edges(grams: np.ndarray, part_bits: int) -> np.ndarray:
    return np.searchsorted((grams >> np.uint64(64 - part_bits)).astype(np.int64), np.arange((1 << part_bits) + 1))


def _sender(grams_of: Callable, part_bits: int) -> Callable:
    mask, parts = kept_bits(part_bits), 1 << part_bits

    def flush(number: int, keys: list, notes: list, rows: list, grams: list) -> pa.RecordBatch:
        h, r = np.concatenate(grams) & mask, np.concatenate(rows)
        order = np.argsort(h, kind="stable")
        h, r = h[order], r[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        h, r = h[fresh], r[fresh]
        first = np.ones(len(h), bool)
        first[1:] = h[1:] != h[:-1]
        run = np.cumsum(first) - 1
        length = np.bincount(run) if len(run) else np.zeros(0, np.int64)
        several = length[run] > 1 if len(run) else np.zeros(0, bool)
        lone = h[first]
        prints, edges = _prints(lone, part_bits), _part_edges(lone, part_bits)
        owner = np.where(length > 1, SHARED, r[first].astype(np.uint16))
        out = [(p, number, GRAM, prints[a:b].tobytes(), owner[a:b].tobytes())
               for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
        home = int(mix(np.array([number], np.uint64))[0] % np.uint64(parts))  # batches of all tasks spread over all parts
        out.append((home, number, KEYS, np.concatenate(keys).tobytes(), np.concatenate(notes).tobytes()))
        h, r = h[several], r[several].astype(np.uint16)
        prints, edges = _prints(h, part_bits), _part_edges(h, part_bits)
        out += [(p, number, KNOWN, prints[a:b].tobytes(), r[a:b].tobytes())
                for p, (a, b) in enumerate(zip(edges, edges[1:], strict=False)) if b > a]
        a, b, c, d, e = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int64()), pa.array(c, pa.int32()), pa.array(d, pa.binary()), pa.array(e, pa.binary())],
            ["part", "batch", "kind", "a", "b"])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        keys, notes, rows, grams, n, size = [], [], [], [], 0, 0
        for b in batches:
            own = b.column("key").to_numpy(zero_copy_only=False)
            for lo, hi, data, at in slices(b.column("text")):
                if n + hi - lo > BATCH_ROWS:
                    yield flush(number, keys, notes, rows, grams)
                    keys, notes, rows, grams, n, size, number = [], [], [], [], 0, 0, number + 1
                row, h, note = grams_of(data, at)
                keys.append(own[lo:hi])
                notes.append(note)
                rows.append(row + n)
                grams.append(h)
                n, size = n + hi - lo, size + len(data)
                if size >= BATCH_BYTES:
                    yield flush(number, keys, notes, rows, grams)
                    keys, notes, rows, grams, n, size, number = [], [], [], [], 0, 0, number + 1
        if n:
            yield flush(number, keys, notes, rows, grams)

    return send


def _match(table: pa.Table) -> pa.Table:
    """Entries of one part that another entry agrees with; what is known already passes."""
    kind = table.column("kind").to_numpy()
    passed = table.filter(pa.array(kind != GRAM))
    own = table.filter(pa.array(kind == GRAM))
    if not own.num_rows:
        return passed
    data, at = text_bytes(own.column("a"))
    prints = np.ascontiguousarray(data).view(np.uint32)
    owner = np.ascontiguousarray(text_bytes(own.column("b"))[0]).view(np.uint16)
    source = np.repeat(np.arange(own.num_rows, dtype=np.int32), np.diff(at) // 4)
    order = np.argsort(prints, kind="stable")
    sorted_prints = prints[order]
    first = np.ones(len(order), bool)
    first[1:] = sorted_prints[1:] != sorted_prints[:-1]
    starts = np.flatnonzero(first)
    many = np.diff(np.append(starts, len(order))) > 1
    many |= np.maximum.reduceat(owner[order], starts) == SHARED
    hit = np.zeros(len(order), bool)
    hit[order] = many[np.cumsum(first) - 1]
    hit &= owner != SHARED
    found = _sent(own, source[hit], KNOWN, prints[hit], owner[hit])
    # a gram that hundreds of batches have: each of them is told
    held = np.diff(np.append(starts, len(order)))
    hot = np.zeros(len(order), bool)
    hot[order] = (held >= HOT_BATCHES)[np.cumsum(first) - 1]
    return pa.concat_tables([passed, found, _sent(own, source[hot], HOT, prints[hot], owner[hot])])


def _sent(own: pa.Table, source: np.ndarray, kind: int, prints: np.ndarray, owner: np.ndarray) -> pa.Table:
    used, starts = np.unique(source, return_index=True)
    cuts = np.append(starts, len(source))
    return pa.table({"part": own.column("part").take(pa.array(used)), "batch": own.column("batch").take(pa.array(used)),
                     "kind": pa.array(np.full(len(used), kind, np.int32)), "a": blobs(prints, cuts), "b": blobs(owner, cuts)})


def _grams_in(table: pa.Table, part_bits: int) -> tuple[np.ndarray, np.ndarray]:
    data, at = text_bytes(table.column("a"))
    part = np.repeat(table.column("part").to_numpy().astype(np.uint64), np.diff(at) // 4)
    grams = np.ascontiguousarray(data).view(np.uint32).astype(np.uint64) << np.uint64(32 - part_bits)
    return grams | (part << np.uint64(64 - part_bits)), np.ascontiguousarray(text_bytes(table.column("b"))[0]).view(np.uint16)


def _by_row(part_bits: int, enough: Callable | None) -> Callable:
    def gather(table: pa.Table) -> pa.Table:
        kind = table.column("kind").to_numpy()
        own = table.filter(pa.array(kind == KEYS))
        keys = np.ascontiguousarray(text_bytes(own.column("a"))[0]).view(np.int64)
        notes = text_bytes(own.column("b"))[0].reshape(len(keys), -1)
        grams, owner = _grams_in(table.filter(pa.array(kind == KNOWN)), part_bits)
        if enough is not None:
            rows = enough(notes, np.bincount(owner, minlength=len(keys)))
            grams, owner = grams[rows[owner]], owner[rows[owner]]
        order = np.argsort(owner, kind="stable")
        grams, owner = grams[order], owner[order]
        used, starts = np.unique(owner, return_index=True)
        often = np.isin(grams, _grams_in(table.filter(pa.array(kind == HOT)), part_bits)[0])
        return pa.table({
            "key": pa.array(keys[used], pa.int64()), "note": blobs(notes[used].ravel(), np.arange(len(used) + 1) * notes.shape[1]),
            "grams": blobs(grams, np.append(starts, len(owner))),
            "hot": blobs(grams[often], np.searchsorted(owner[often], np.append(used, 1 << 32)))})

    return gather


def shared_grams(rows: DataFrame, grams_of: Callable, part_bits: int, enough: Callable | None = None) -> DataFrame:
    """(key, note, grams, hot) for the rows of (key, text) that have grams in common with another row.

    ``grams_of(bytes, offsets)`` gives (row, gram) in ascending order of rows, and for each row as many
    bytes of notes, which come back with it; ``enough(notes, counts)`` may say which rows have too few
    shared grams to matter. ``hot`` are those of the grams that at least 256 batches have. Grams are 64-bit little-endian values with the bits that
    ``kept_bits`` names. Rows have to arrive in a fixed order within their partitions, as they do from a
    scan or a sort, so that a repeated task cuts the same batches.
    """
    sent = rows.select("key", "text").mapInArrow(_sender(grams_of, part_bits), SENT)
    back = sent.groupBy("part").applyInArrow(_match, BACK)
    return back.groupBy("batch").applyInArrow(_by_row(part_bits, enough), "key long, note binary, grams binary, hot binary")


def member(row: np.ndarray, grams: np.ndarray, part_bits: int, wanted: pa.Array) -> np.ndarray:
    """Which (row, gram) are among the ``wanted`` grams of their row."""
    data, at = text_bytes(wanted)
    values = np.ascontiguousarray(data).view(np.uint64)
    owner = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(at) // 8)
    odd = np.uint64(0x9E3779B97F4A7C15)
    goal = np.sort(values + owner * odd)
    own = (grams & kept_bits(part_bits)) + row.astype(np.uint64) * odd
    if not len(goal):
        return np.zeros(len(own), bool)
    return goal[np.minimum(np.searchsorted(goal, own), len(goal) - 1)] == own

"""Geometry defects, repair and quarantine."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from zoneloom.functions import rings as R
from zoneloom.functions.arrow_rings import chunks, repeat_rows, ring_arrays, ring_list
from zoneloom.operators import clip, noding
from zoneloom.operators import clip_many as many
from zoneloom.session import settle, ship_kernels


def _before(ring: Column, i: Column) -> Column:
    return F.get(ring, i - 1)


def _is_spike(ring: Column, p: Column, i: Column) -> Column:
    return (i > 0) & (i < F.size(ring) - 1) & (F.get(ring, i - 1) == F.get(ring, i + 1))


def structural_defect(rings: Column) -> Column:
    """The first defect that shows in the coordinates of single rings, else 'none'."""
    last = lambda r: F.get(r, F.size(r) - 1)
    repeated = lambda r: F.size(
        F.filter(r, lambda p, i: (i > 0) & (p == _before(r, i)))
    ) > 0
    spiked = lambda r: F.size(F.filter(r, lambda p, i: _is_spike(r, p, i))) > 0
    return (
        F.when(rings.isNull(), "null")
        .when(F.size(rings) == 0, "empty")
        .when(F.exists(rings, lambda r: F.get(r, F.lit(0)) != last(r)), "unclosed")
        .when(F.exists(rings, repeated), "repeated point")
        .when(F.exists(rings, spiked), "spike")
        .when(F.exists(rings, lambda r: F.size(r) < 4), "too few points")
        .when(F.exists(rings, lambda r: R.ring_area(r) == 0), "flat")
        .otherwise("none")
    )


def _flag_kernel(geometry: str):
    def kernel(batches):
        for batch in batches:
            xy, point_at, ring_at, _ = ring_arrays(batch.column(geometry))
            e, row = noding.edges_by_row(xy, point_at, ring_at)
            at = batch.schema.get_field_index("defect")
            none = pc.fill_null(pc.equal(batch.column(at), "none"), False).to_numpy(zero_copy_only=False)
            asked = none[row]
            crossing = noding.crossing_rows(e[asked], row[asked], len(none))
            yield batch.set_column(at, "defect", pc.if_else(pa.array(crossing), "self crossing", batch.column(at)))

    return kernel


def with_defect(zones: DataFrame, keys: list[str], geometry: str = "rings") -> DataFrame:
    """Add ``defect``: a structural one, 'self crossing', or 'none'.

    Edges that cross are looked for within the task that holds the row, where its edges are dealt to cells
    that halve until they hold few; nothing is shuffled.
    """
    ship_kernels()
    marked = zones.withColumn("defect", structural_defect(F.col(geometry)))
    return marked.mapInArrow(_flag_kernel(geometry), marked.schema)


def self_crossings(zones: DataFrame, keys: list[str], geometry: str = "rings") -> DataFrame:
    """Keys of the zones with two edges that properly cross, whatever other defects they have."""
    ship_kernels()
    rows = zones.where(F.col(geometry).isNotNull()).select(*keys, geometry, F.lit("none").alias("defect"))
    return rows.mapInArrow(_flag_kernel(geometry), rows.schema).where("defect <> 'none'").select(*keys)


def _folded(ring: Column) -> Column:
    """The ring without repeated points and spikes, however deep they nest, point by point.

    A point equal to the last kept one is left out; one equal to the last but one takes back the
    last. Each step copies what is kept, so only rings that need it come here.
    """

    def step(kept, p):
        n = F.size(kept)
        return (
            F.when(F.get(kept, n - 1) == p, kept)
            .when(F.get(kept, n - 2) == p, F.slice(kept, F.lit(1), n - 1))
            .otherwise(F.concat(kept, F.array(p)))
        )

    return F.aggregate(ring, F.filter(ring, lambda p: F.lit(False)), step)


def _no_repeats(r: Column) -> Column:
    return F.filter(r, lambda p, i: (i == 0) | (p != _before(r, i)))


def _no_spikes(r: Column) -> Column:
    return F.filter(r, lambda p, i: ~_is_spike(r, p, i))


def _quick_repair(rings: Column) -> Column:
    """Close rings, take off repeated points and single spikes, drop what has no area."""
    out = F.transform(rings, R.close_ring)
    for pass_over in (_no_repeats, _no_spikes, _no_repeats):
        out = F.transform(out, pass_over)
    # a ring that still has spikes may lose its area with them: it is judged when they are off
    spiked = lambda r: F.size(F.filter(r, lambda p, i: _is_spike(r, p, i))) > 0
    return F.filter(out, lambda r: (F.size(r) >= 4) & (spiked(r) | (R.ring_area(r) != 0)))


def repair_rings(rings: Column) -> Column:
    """Close rings, drop repeated points, spikes and rings without an area, as a Column.

    One quick pass takes single spikes off; a ring where others hid behind them is folded up point by
    point. ``repair_zones`` does the same in a kernel whose time is linear however deep spikes nest.
    """

    def no_more(r):
        spiked = F.size(F.filter(r, lambda p, i: _is_spike(r, p, i))) > 0
        return F.when(spiked, _folded(r)).otherwise(r)

    out = F.transform(rings, R.close_ring)
    for pass_over in (_no_repeats, _no_spikes, _no_repeats, no_more):
        out = F.transform(out, pass_over)
    return R.polygonal(out)


def _repair_rows(batch, geometry: str):
    xy, point_at, ring_at, present = ring_arrays(batch.column(geometry))
    first, count = ring_at[:-1].copy(), np.diff(ring_at)
    defect = np.array(batch.column("defect").to_pylist(), object)
    repaired = batch.column("repaired").to_numpy(zero_copy_only=False).copy()
    rings_of = lambda i: [xy[point_at[r] : point_at[r + 1]] for r in range(ring_at[i], ring_at[i + 1])]
    changed = {}
    for i in np.flatnonzero(noding.spiked_rows(xy, point_at, ring_at)).tolist():
        changed[i] = [r for r in map(noding.fold, rings_of(i)) if len(r) > 3 and clip.signed_area(r) != 0]
        repaired[i] = True
    defect[present] = np.where(count[present] > 0, "none", "empty")
    for i, rings in changed.items():
        defect[i] = "none" if rings else "empty"
    e, row = noding.edges_by_row(xy, point_at, ring_at)
    crossing = noding.crossing_rows(e, row, len(count))
    for i, rings in changed.items():
        crossing[i] = noding.has_crossing(noding.edges_of(rings))
    at = np.flatnonzero(crossing).tolist()
    for i, whole in zip(at, noding.repaired_rows([changed[i] if i in changed else rings_of(i) for i in at]), strict=True):
        if whole is None:
            defect[i] = "self crossing"
        else:
            changed[i], repaired[i], defect[i] = whole, True, "none" if whole else "empty"
    # new rings go behind the old ones
    new = [ring for rings in changed.values() for ring in rings]
    if changed:
        rows, n = np.array(list(changed)), np.array([len(rings) for rings in changed.values()])
        first[rows], count[rows] = len(point_at) - 1 + many.starts(n), n
    lengths = np.concatenate([np.diff(point_at), np.array([len(r) for r in new], np.int64)])
    ring = many.ranges(first, count)
    inner = ring_list(np.concatenate([xy, *new])[many.ranges(many.starts(lengths)[ring], lengths[ring])], lengths[ring])
    row_off = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
    missing = np.concatenate([~present, [False]])
    return repeat_rows(batch, np.arange(len(count)), {
        geometry: pa.ListArray.from_arrays(pa.array(row_off, mask=missing), inner),
        "repaired": pa.array(repaired, pa.bool_()), "defect": pa.array(defect, pa.string()),
    })


def _repair_kernel(geometry: str):
    def kernel(batches):
        for batch in batches:
            _, point_at, ring_at, _ = ring_arrays(batch.column(geometry))
            for begin, end in chunks(np.diff(point_at[ring_at])):
                yield _repair_rows(batch.slice(begin, end - begin), geometry)

    return kernel


def repair_zones(
    zones: DataFrame, keys: list[str], geometry: str = "rings", keep: bool = False,
    counts: Observation | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(good, quarantine)``; ``repaired`` tells which rows changed, ``defect`` why one failed.

    Rings that cross themselves or one another become the polygons of their even-odd set. ``keep`` computes
    the repair once and stores it, for callers that use both sides. ``counts`` takes ``rows, repaired, failed``
    from the job that stores it, without another pass, so it needs ``keep``.
    """
    if counts is not None and not keep:
        raise ValueError("counts are taken while the repair is stored: set keep")
    ship_kernels()
    fixed = zones.withColumn("_was", F.col(geometry)).withColumn(geometry, _quick_repair(F.col(geometry)))
    changed = ~F.coalesce(F.col("_was") == F.col(geometry), F.lit(True))
    marked = fixed.withColumns({"repaired": changed, "defect": F.lit("null")}).drop("_was")
    checked = marked.mapInArrow(_repair_kernel(geometry), marked.schema)
    good = F.col("defect") == "none"
    if counts is not None:
        checked = checked.observe(
            counts, F.count("*").alias("rows"), F.count_if("repaired").alias("repaired"), F.count_if(~good).alias("failed")
        )
    if keep:
        checked = settle(checked)
    return checked.where(good).drop("defect"), checked.where(~good)

"""Neighbourhood and graph kernels on one raster (numpy), for grouped-map operators.

``per_raster`` runs one over every raster of a long-form table, a raster to a task: rasters, tiles and blocks
are bounded by their own size, never by the table's.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string


def per_raster(pixels: DataFrame, keys: list[str], value: str, kernel: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str) -> DataFrame:
    """(keys, row, col and the kernel's arrays): kernel maps the 2-D values to arrays of that shape."""

    types = {f.name: f.dataType.simpleString() for f in pixels.schema.fields}
    head = ", ".join(f"{k} {types[k]}" for k in (*keys, "row", "col"))
    names = [part.split()[0] for part in schema.split(",")]

    def run(t: pa.Table) -> pa.Table:
        row, col, v = (t.column(c).to_numpy() for c in ("row", "col", value))
        grid = np.zeros((row.max() + 1, col.max() + 1), v.dtype)
        grid[row, col] = v
        made = kernel(grid)
        return pa.table({**{k: t.column(k) for k in (*keys, "row", "col")}, **{n: np.asarray(made[n])[row, col] for n in names}}).cast(wanted)

    wanted = to_arrow_schema(_parse_datatype_string(f"{head}, {schema}"))
    return pixels.select(*keys, "row", "col", value).groupBy(*keys).applyInArrow(run, f"{head}, {schema}")


def shifted(a: np.ndarray, dy: int, dx: int, outside) -> np.ndarray:
    """a moved so that each place holds its neighbour at (dy, dx)."""
    p = np.pad(a, 1, constant_values=outside)
    return p[1 + dy : 1 + dy + a.shape[0], 1 + dx : 1 + dx + a.shape[1]]


def dilate(mask: np.ndarray, times: int = 1) -> np.ndarray:
    for _ in range(max(0, times)):
        across = mask | shifted(mask, 0, -1, False) | shifted(mask, 0, 1, False)
        mask = across | shifted(across, -1, 0, False) | shifted(across, 1, 0, False)
    return mask


def erode(mask: np.ndarray, times: int = 1) -> np.ndarray:
    """Outside counts as on."""
    for _ in range(max(0, times)):
        mask = ~dilate(~mask)
    return mask


def close(mask: np.ndarray, times: int) -> np.ndarray:
    for _ in range(max(0, times)):
        mask = erode(dilate(mask))
    return mask


def labels(mask: np.ndarray) -> np.ndarray:
    """4-connected components numbered from 1 by their first pixel in row-major order; 0 is off.

    Runs of each row are joined to the runs they touch in the row above by union-find.
    """
    h, w = mask.shape
    step = np.diff(np.pad(mask.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, begin = np.nonzero(step == 1)
    end = np.nonzero(step == -1)[1]
    root = np.arange(len(rows))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    starts = np.searchsorted(rows, np.arange(h + 1))
    for r in range(1, h):
        i, j = starts[r - 1], starts[r]
        while i < starts[r] and j < starts[r + 1]:
            if begin[i] < end[j] and begin[j] < end[i]:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
            if end[i] < end[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(i) for i in range(len(root))], np.int64)
    number = np.zeros(len(root) + 1, np.int64)
    number[np.unique(roots)] = np.arange(1, len(np.unique(roots)) + 1)
    out = np.zeros((h, w), np.int64)
    for r, a, b, k in zip(rows, begin, end, number[roots], strict=True):
        out[r, a:b] = k
    return out


def outside(mask: np.ndarray) -> np.ndarray:
    """What is on and connected to an edge."""
    of = labels(mask)
    edge = np.unique(np.concatenate([of[0], of[-1], of[:, 0], of[:, -1]]))
    return np.isin(of, edge[edge > 0])


def largest(mask: np.ndarray) -> np.ndarray:
    """The largest component; ties to the first."""
    of = labels(mask)
    if not of.any():
        raise ValueError("No foreground pixels found in mask.")
    return of == 1 + np.bincount(of[of > 0] - 1).argmax()


@dataclass
class Component:
    label: int
    area: int
    top: int
    left: int
    bottom: int
    right: int

    @property
    def height(self) -> int:
        return self.bottom - self.top + 1

    @property
    def width(self) -> int:
        return self.right - self.left + 1


def components(of: np.ndarray) -> list[Component]:
    out = []
    for k in range(1, int(of.max(initial=0)) + 1):
        r, c = np.nonzero(of == k)
        out.append(Component(k, len(r), int(r.min()), int(c.min()), int(r.max()), int(c.max())))
    return out


def slope_degrees(dem: np.ndarray, cell_x: float = 1.0, cell_y: float = 1.0, scale: float = 1.0) -> np.ndarray:
    p = np.pad(dem.astype(np.float64), 1, mode="edge")
    v = lambda dy, dx: p[1 + dy : 1 + dy + dem.shape[0], 1 + dx : 1 + dx + dem.shape[1]]
    dx = ((v(-1, 1) + 2 * v(0, 1) + v(1, 1)) - (v(-1, -1) + 2 * v(0, -1) + v(1, -1))) / (8 * cell_x * scale)
    dy = ((v(1, -1) + 2 * v(1, 0) + v(1, 1)) - (v(-1, -1) + 2 * v(-1, 0) + v(-1, 1))) / (8 * cell_y * scale)
    return np.degrees(np.arctan(np.hypot(dx, dy))).astype(np.float32)


def box_mean(a: np.ndarray, k: int) -> np.ndarray:
    """Mean of k x k pixels from k//2 before to k-1-k//2 after, edges replicated."""
    if k <= 1:
        return a
    h, w = a.shape
    rows, cols = (np.clip(np.arange(-(k // 2), n + k - 1 - k // 2), 0, n - 1) for n in (h, w))
    total = np.zeros((h + k, w + k))
    total[1:, 1:] = a.astype(np.float64)[rows][:, cols].cumsum(axis=0).cumsum(axis=1)
    return ((total[k:, k:] - total[:-k, k:] - total[k:, :-k] + total[:-k, :-k]) / (k * k)).astype(np.float32)


@dataclass
class MaskOptions:
    """Defaults of the chart mask heuristics."""

    edge_width: int = 2
    tolerance: int = 0
    ink: int = 40
    neatline: float = 0.6
    erosions: int = 1
    gap: int = 6
    min_area: int = 6
    max_area_ratio: float = 0.12
    max_fill: float = 0.72
    max_thickness: int = 3
    overhang: dict[str, int] = field(default_factory=lambda: {"north": 7, "south": 7, "west": 24, "east": 24})
    closings: int = 0
    east_band: int = 64
    east_area: int = 8
    east_span: int = 2


def edge_background(data: np.ndarray, width: int) -> np.ndarray | int:
    """The commonest pixel of the four edge bands; corners count twice; indexes tie to the least, colours to the first."""
    bands = [data[:width], data[-width:], data[:, :width], data[:, -width:]]
    if data.ndim == 2:
        return int(np.bincount(np.concatenate([b.ravel() for b in bands])).argmax())
    flat = np.concatenate([b.reshape(-1, data.shape[2]) for b in bands])
    colours, first, counts = np.unique(flat, axis=0, return_index=True, return_counts=True)
    return colours[min(np.flatnonzero(counts == counts.max()), key=lambda i: first[i])]


def as_rgb(data: np.ndarray, palette: dict[int, tuple] | None) -> np.ndarray:
    if data.ndim == 3:
        return data
    if palette is None:
        return np.repeat(data[..., None], 3, axis=2)
    table = np.zeros((int(data.max(initial=0)) + 1, 3), np.uint8)
    for i, c in palette.items():
        if i < len(table):
            table[i] = c[:3]
    return table[data]


def background(data: np.ndarray, value, tolerance: int, palette: dict[int, tuple] | None = None) -> np.ndarray:
    if data.ndim == 2 and (palette is None or tolerance <= 0 or value not in palette):
        return data == value
    wanted = palette[value][:3] if data.ndim == 2 else value
    return np.abs(as_rgb(data, palette).astype(int) - np.asarray(wanted, int)).sum(axis=2) <= tolerance


def beyond_neatline(data: np.ndarray, palette: dict[int, tuple] | None, ink: int, ratio: float) -> np.ndarray:
    """What lies outside the outermost inked rows and columns, where at least two qualify."""
    dark = as_rgb(data, palette).astype(int).sum(axis=2) <= ink
    out = np.zeros(dark.shape, bool)
    for view, counts, n in ((out, dark.sum(axis=1), dark.shape[1]), (out.T, dark.sum(axis=0), dark.shape[0])):
        lines = np.flatnonzero(counts >= int(n * ratio))
        if len(lines) >= 2:
            view[: lines[0]], view[lines[-1] + 1 :] = True, True
    return out


def core(chart: np.ndarray, erosions: int) -> np.ndarray:
    """The largest component after erosion, grown back within the chart."""
    if not chart.any():
        raise ValueError("No chart pixels found in raw chart mask.")
    seed = erode(chart, erosions)
    if seed.any():
        grown = dilate(largest(seed), erosions) & chart
        if grown.any():
            return grown
    return largest(chart)


def reject_reason(c: Component, over: dict[str, int], touches: bool, most: int, o: MaskOptions) -> str:
    """Why a component is no extension of the core, or 'kept'; the first that applies."""
    fill = c.area / (c.height * c.width)
    tests = [("below_min_area", c.area < max(1, o.min_area)), ("above_max_area", c.area > most), ("above_fill_ratio", fill > o.max_fill and min(c.height, c.width) > max(1, o.max_thickness))]
    tests += [(f"above_overhang_{side}", over[side] > max(0, o.overhang[side])) for side in ("north", "south", "west", "east")]
    return next((name for name, bad in [*tests, ("not_attached_to_core", not touches)] if bad), "kept")


def extensions(chart: np.ndarray, core_mask: np.ndarray, o: MaskOptions) -> tuple[np.ndarray, list[dict]]:
    """Components outside the core that belong to the chart, and a report on all of them."""
    of = labels(chart & ~core_mask)
    rows, cols = np.nonzero(core_mask)
    most = max(1, int(len(rows) * max(0.0, o.max_area_ratio)))
    kept, report = np.zeros(chart.shape, bool), []
    near = dilate(core_mask, o.gap)  # within the gap of the core, as dilation is symmetric
    for c in components(of):
        own = of == c.label
        over = {"north": max(0, int(rows.min()) - c.top), "south": max(0, c.bottom - int(rows.max())), "west": max(0, int(cols.min()) - c.left), "east": max(0, c.right - int(cols.max()))}
        touches = bool((own & near).any())
        reason = reject_reason(c, over, touches, most, o)
        kept |= own & (reason == "kept")
        report.append(
            {"id": c.label - 1, "area": c.area, "bbox": {"min_row": c.top, "min_col": c.left, "max_row": c.bottom, "max_col": c.right}, "fill_ratio": c.area / (c.height * c.width), "min_thickness": min(c.height, c.width), "max_overhang": max(over.values()), "overhang": over, "touches_core": touches, "kept": reason == "kept", "reason": reason}
        )
    return kept, report


def prune(mask: np.ndarray, min_area: int) -> np.ndarray:
    of = labels(mask)
    areas = np.bincount(of.ravel())
    return (of > 0) & (areas[of] >= max(1, min_area))


def main_and_islands(mask: np.ndarray, band: int, area: int, span: int) -> np.ndarray:
    """The largest component, and islands near the east edge that are large enough."""
    of = labels(mask)
    found = components(of)
    if not found:
        return mask
    main = max(found, key=lambda c: c.area)
    keep = [c.label for c in found if c is main or (c.right >= mask.shape[1] - max(1, band) and c.area >= max(1, area) and max(c.height, c.width) >= max(1, span))]
    return np.isin(of, keep)


def chart_mask(data: np.ndarray, o: MaskOptions | None = None, palette: dict[int, tuple] | None = None) -> tuple[np.ndarray, dict]:
    """The mask of a chart's area, and its stages; an empty mask raises."""
    o = o or MaskOptions()
    ground = background(data, edge_background(data, o.edge_width), o.tolerance, palette) | beyond_neatline(data, palette, o.ink, o.neatline)
    away = outside(ground)
    raw = ~away
    middle = core(raw, max(0, o.erosions))
    more, report = extensions(raw, middle, o)
    final = close(middle | more, o.closings)
    final = main_and_islands(prune(final, o.min_area), o.east_band, o.east_area, o.east_span)
    if not final.any():
        raise ValueError("Final chart mask is empty.")
    return final, {"background": ground, "outside": away, "raw": raw, "core": middle, "extensions": more, "final": final, "component_report": report}


def corner_points(mask: np.ndarray) -> dict[str, tuple[int, int]]:
    r, c = np.nonzero(mask)
    if not len(r):
        raise ValueError("Cannot compute corners from an empty mask.")
    at = lambda i: (int(r[i]), int(c[i]))
    return {"nw": at((r + c).argmin()), "ne": at((r - c).argmin()), "se": at((r + c).argmax()), "sw": at((r - c).argmax())}


def polygonize(mask: np.ndarray) -> list[list[list[tuple[int, int]]]]:
    """Polygons (outer ring, then holes) of (col, row) corners for each 4-connected component.

    The boundary's unit edges, with the area on one side, are chained into rings; at a corner where two
    pixels meet diagonally the ring turns so that they stay apart.
    """
    out = []
    of = labels(mask)
    for k in range(1, int(of.max(initial=0)) + 1):
        m = np.pad(of == k, 1)
        nexts: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for y, x in zip(*np.nonzero(m), strict=True):
            y, x = int(y), int(x)
            for (dy, dx), a, b in (((-1, 0), (x, y), (x + 1, y)), ((0, 1), (x + 1, y), (x + 1, y + 1)), ((1, 0), (x + 1, y + 1), (x, y + 1)), ((0, -1), (x, y + 1), (x, y))):
                if not m[y + dy, x + dx]:
                    nexts.setdefault(a, []).append(b)
        rings = []
        while nexts:
            start = min(nexts)
            ring, at, came = [start], start, (0, 0)
            while True:
                options = nexts[at]
                # Of two ways on, the sharper right turn stays at the same pixel.
                cross = lambda b, at=at, came=came: came[0] * (b[1] - at[1]) - came[1] * (b[0] - at[0])
                b = max(options, key=cross)
                options.remove(b)
                if not options:
                    del nexts[at]
                came, at = (b[0] - at[0], b[1] - at[1]), b
                if at == start:
                    break
                ring.append(at)
            corners = [p for i, p in enumerate(ring) if (ring[i - 1][0] - p[0]) * (ring[(i + 1) % len(ring)][1] - p[1]) != (ring[i - 1][1] - p[1]) * (ring[(i + 1) % len(ring)][0] - p[0])]
            rings.append([(x - 1, y - 1) for x, y in [*corners, corners[0]]])
        area = lambda r: sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:]))
        rings.sort(key=lambda r: -abs(area(r)))
        out.append(rings)
    return out


def mask_geometry(mask: np.ndarray, affine: list[float], digits: int = 7) -> dict:
    """GeoJSON geometry of a mask: a Polygon if there is one component, else a MultiPolygon."""
    place = lambda c, r: [round(affine[0] + c * affine[1] + r * affine[2], digits), round(affine[3] + c * affine[4] + r * affine[5], digits)]
    polygons = [[[place(*p) for p in ring] for ring in rings] for rings in polygonize(mask)]
    if not polygons:
        raise ValueError("No foreground pixels found in mask.")
    return {"type": "Polygon", "coordinates": polygons[0]} if len(polygons) == 1 else {"type": "MultiPolygon", "coordinates": polygons}


def mask_feature(chart: str, source: str, mask: np.ndarray, affine: list[float], o: MaskOptions) -> dict:
    heuristics = {k: v for k, v in o.__dict__.items()}
    return {"type": "Feature", "properties": {"chart": chart, "source": source, "mask_shape": list(mask.shape), "heuristics": heuristics, "corner_pixels": corner_points(mask)}, "geometry": mask_geometry(mask, affine)}

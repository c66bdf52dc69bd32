"""Counts per area without a row per point and area.

A shape (one or more pieces: boxes or polygons) has one home: a quadtree cell such that the shape touches no other
cells of that level than it and its neighbours above and to the right.  A point is sent to the at most four homes per
level that may hold it, so (level, cell) groups bring shapes and points together.  A home with many points is dealt by
id, as numbers of distinct ids add up over disjoint sets of ids, and one with many shapes by shape: a task's block is
bounded (but for a single id's points, which stay together).

A block's points lie in rows by latitude and columns by longitude, cut at quantiles.  Cells wholly inside a box are not
looked into: their counts are differences of offsets, their extremes and bit sets of ids come from tables over runs of
2**n cells of a row.  Points of the other cells that a piece touches are compared exactly.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

SIDE = 64              # rows and columns of a block, at most
WORDS = 1 << 21        # 64-bit words of ids in a block's tables, at most
CHUNK = 256            # shapes looked up at once, at most
SLICE = 1 << 16        # points compared at once (or the run of one row)

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # tasks get these functions with their closures


def ranked(ts: pa.ChunkedArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The values in order, and every point's place among them for a minimum and a maximum (nulls lose both)."""
    ts = ts.combine_chunks() if isinstance(ts, pa.ChunkedArray) else ts
    order = pc.sort_indices(ts).to_numpy()          # nulls last
    place = np.empty(len(ts), np.int64)
    place[order] = np.arange(len(ts))
    null = ts.is_null().to_numpy(zero_copy_only=False)
    return ts.take(pa.array(order)), np.where(null, len(ts), place), np.where(null, -1, place)


def numbered(ids: pa.ChunkedArray) -> tuple[np.ndarray, int]:
    """Ids as numbers from 0, and how many there are; a null id has the number after the last."""
    codes = (ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids).dictionary_encode()
    n = len(codes.dictionary)
    return codes.indices.fill_null(n).to_numpy(zero_copy_only=False).astype(np.int64), n


def doubling(cells: np.ndarray, join) -> np.ndarray:
    """``out[l][row, column]``: ``join`` over the 2**l cells from there on along the row (fewer at its end)."""
    out, step = [cells], 1
    while 2 * step <= cells.shape[1]:
        out.append(out[-1].copy())
        join(out[-2][:, :-step], out[-2][:, step:], out=out[-1][:, :-step])
        step *= 2
    return np.stack(out)


def spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which range, number in it) of all numbers of the ranges [start, end)."""
    sizes = np.maximum(ends - starts, 0)
    which = np.repeat(np.arange(len(sizes)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[which]


class Block:
    """The points of a block in cells, with tables over runs of cells."""

    def __init__(self, lat: np.ndarray, lon: np.ndarray, ids: np.ndarray, n_ids: int, low: np.ndarray, high: np.ndarray, boxes: bool):
        n, self.words = len(lat), -(-n_ids // 64) or 1
        k = min(SIDE, max(1, int(np.sqrt(n / 8))))
        while k > 1 and k * k * k.bit_length() * self.words > WORDS:
            k //= 2
        self.k, self.n_ids = k, n_ids
        place = lambda x: np.argsort(np.argsort(x, kind="stable"), kind="stable") * k // n
        row, column = place(lat), place(lon)
        edges = lambda at, x: [f(x[np.argsort(at, kind="stable")], np.searchsorted(np.sort(at), np.arange(k))) for f in (np.minimum.reduceat, np.maximum.reduceat)]
        self.rows, self.columns = edges(row, lat), edges(column, lon)
        cell = row * k + column
        order = np.argsort(cell, kind="stable")
        self.lat, self.lon, self.ids, self.low, self.high = lat[order], lon[order], ids[order], low[order], high[order]
        self.at = np.searchsorted(cell[order], np.arange(k * k + 1))
        if boxes:
            least, most, held = np.full(k * k, n), np.full(k * k, -1), np.zeros((k * k, self.words * 64 + 1), bool)
            np.minimum.at(least, cell, low)
            np.maximum.at(most, cell, high)
            held[cell, ids] = True
            held[:, n_ids:] = False
            bits = np.packbits(held[:, :-1], axis=1).view(np.uint64)
            self.least, self.most = doubling(least.reshape(k, k), np.minimum), doubling(most.reshape(k, k), np.maximum)
            self.bits = doubling(bits.reshape(k, k, -1), np.bitwise_or)

    @staticmethod
    def ranges(edges, lo, hi) -> tuple[np.ndarray, ...]:
        """Rows (columns) touched, [from, to), and those of them wholly inside."""
        low, high = edges
        touched = np.searchsorted(high, lo, "left"), np.searchsorted(low, hi, "right")
        inner = np.searchsorted(low, lo, "left"), np.searchsorted(high, hi, "right")
        return (*touched, *inner)

    def count(self, bounds: np.ndarray, ring: tuple | None, unit: np.ndarray, n_units: int, times: np.ndarray):
        """(n_points, n_ids, lowest, highest place) of ``n_units`` shapes; ``bounds``, ``ring``, ``times`` and ``unit`` (rising) are their pieces'."""
        n, k = len(self.lat), self.k
        y0, y1, x0, x1 = bounds
        r0, r1, i0, i1 = self.ranges(self.rows, y0, y1)
        c0, c1, j0, j1 = self.ranges(self.columns, x0, x1)
        total, least, most = np.zeros(n_units, np.int64), np.full(n_units, n), np.full(n_units, -1)
        held, bits = np.zeros((n_units, self.words * 64 + 1), bool), np.zeros((n_units, self.words), np.uint64)
        piece, row = spans(r0, np.where(c0 < c1, r1, r0))
        whole = (row >= i0[piece]) & (row < i1[piece]) & (j0 < j1)[piece] if ring is None else np.zeros(len(piece), bool)
        if whole.any():
            p, r = piece[whole], row[whole]
            a, b = j0[p], j1[p]
            level = np.frexp(b - a)[1] - 1
            last, first = b - (1 << level), np.flatnonzero(np.diff(unit[p], prepend=-1))
            u = unit[p][first]
            np.add.at(total, unit[p], (self.at[r * k + b] - self.at[r * k + a]) * times[p])
            least[u] = np.minimum.reduceat(np.minimum(self.least[level, r, a], self.least[level, r, last]), first)
            most[u] = np.maximum.reduceat(np.maximum(self.most[level, r, a], self.most[level, r, last]), first)
            bits[u] = np.bitwise_or.reduceat(self.bits[level, r, a] | self.bits[level, r, last], first, axis=0)
        # what is left of a row: all that is touched, or what lies left and right of the cells inside
        left, right = np.where(whole, j0[piece], c1[piece]), np.where(whole, j1[piece], c1[piece])
        runs = np.stack([self.at[row * k + c0[piece]], self.at[row * k + left], self.at[row * k + right], self.at[row * k + c1[piece]]], axis=1)
        starts, ends, owner = runs[:, ::2].reshape(-1), runs[:, 1::2].reshape(-1), np.repeat(piece, 2)
        some = ends > starts
        starts, ends, owner = starts[some], ends[some], owner[some]
        before = np.cumsum(ends - starts)
        cuts = np.unique(np.searchsorted(before, np.arange(SLICE, before[-1], SLICE), "right")) if len(before) else []
        for s, e, o in zip(*(np.split(x, cuts) for x in (starts, ends, owner))):
            which, at = spans(s, e)
            p = o[which]
            y, x = self.lat[at], self.lon[at]
            met = (y >= y0[p]) & (y <= y1[p]) & (x >= x0[p]) & (x <= x1[p])
            at, p = at[met], p[met]
            if ring is not None:
                met = in_rings(ring, p, self.lat[at], self.lon[at])
                at, p = at[met], p[met]
            if not len(at):
                continue
            u = unit[p]
            first = np.flatnonzero(np.diff(u, prepend=-1))
            which = u[first]
            total[which] += np.add.reduceat(times[p], first)
            least[which] = np.minimum(least[which], np.minimum.reduceat(self.low[at], first))
            most[which] = np.maximum(most[which], np.maximum.reduceat(self.high[at], first))
            held[u, self.ids[at]] = True
        held[:, self.n_ids:] = False
        bits |= np.packbits(held[:, :-1], axis=1).view(np.uint64)
        return total, np.bitwise_count(bits).sum(axis=1, dtype=np.int64), least, most


def in_rings(ring: tuple, piece: np.ndarray, lat: np.ndarray, lon: np.ndarray) -> np.ndarray:
    """Even-odd rule, as ``areas.in_ring``, of points with the polygons of their pieces: (start, size, lat, lon) of the vertices."""
    start, size, ys, xs = ring
    odd, n = np.zeros(len(piece), bool), size[piece]
    with np.errstate(divide="ignore", invalid="ignore"):
        for i in range(int(n.max(initial=0))):
            live = slice(None) if (n > i).all() else np.flatnonzero(n > i)
            a, b, y = (start + i)[piece[live]], (start + (i + 1) % np.maximum(size, 1))[piece[live]], lat[live]
            met = np.flatnonzero((ys[a] > y) != (ys[b] > y))
            at = met if isinstance(live, slice) else live[met]
            a, b, y = a[met], b[met], y[met]
            odd[at] ^= lon[at] < xs[a] + (y - ys[a]) / (ys[b] - ys[a]) * (xs[b] - xs[a])
    return odd & (n > 2)


def doubles(x) -> np.ndarray:
    return np.ascontiguousarray(pc.fill_null(x.cast(pa.float64()), np.nan).to_numpy(zero_copy_only=False))


def counts(points: pa.Table, shapes: pa.Table, polygons: bool) -> Iterator[tuple]:
    """(index of the shape, n_points, n_ids, lowest, highest time) of the shapes (pieces) that hold a point of the block (_y, _x, _id, _t), in chunks."""
    if not points.num_rows or not shapes.num_rows:
        return
    values, low, high = ranked(points["_t"])
    ids, n_ids = numbered(points["_id"])
    block = Block(doubles(points["_y"].combine_chunks()), doubles(points["_x"].combine_chunks()), ids, n_ids, low, high, not polygons)
    pieces = shapes["_pieces"].combine_chunks()
    size = max(1, min(CHUNK, WORDS // block.words // 8))
    for i in range(0, len(pieces), size):
        part = pieces.slice(i, size)
        unit, flat = pc.list_parent_indices(part).to_numpy(), part.flatten()
        of = lambda name: pc.struct_field(flat, name)
        ring = None
        if polygons:
            rings = of("ring")
            sizes, vertices = pc.fill_null(pc.list_value_length(rings), 0).to_numpy(zero_copy_only=False).astype(np.int64), rings.flatten()
            ring = np.cumsum(sizes) - sizes, sizes, doubles(pc.struct_field(vertices, "lat")), doubles(pc.struct_field(vertices, "lon"))
        total, n, least, most = block.count(np.stack([doubles(of(c)) for c in ("lat_min", "lat_max", "lon_min", "lon_max")]), ring, unit, len(part),
                                            of("times").to_numpy(zero_copy_only=False))
        found = np.flatnonzero(total)
        take = lambda at, none: values.take(pa.array(at, mask=at == none))
        yield i + found, total[found], n[found], take(least[found], len(values)), take(most[found], -1)

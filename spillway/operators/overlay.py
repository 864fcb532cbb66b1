"""Constructive planar geometry: intersection, union, difference, buffers, validity, WKB, and unions of groups.

Polygons are overlaid by their directed edges, with the interior on the left: edges are cut where the two boundaries
meet, pieces are kept by where their middle lies in the other polygon, and what is kept is joined to rings.
"""

from __future__ import annotations

import functools
import math
import struct
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spillway.operators.spatial import EPS, KEPT, Geometry, Point, _meets, _on, _parsed, _ring_area, centroid, collect, locate, parse, write

Edge = tuple[Point, Point]
#: Segments of a quarter circle.
QUARTER = 8


def _polygons(g: Geometry) -> list[Geometry]:
    return [s for s in g.simple() if s.kind == "POLYGON"]


def _edges(g: Geometry) -> list[Edge]:
    out: list[Edge] = []
    for s in _polygons(g):
        for i, ring in enumerate(s.parts):
            ring = ring if (_ring_area(ring) > 0) == (i == 0) else ring[::-1]
            out += [(a, b) for a, b in zip(ring, ring[1:], strict=False) if a != b]
    return out


def _cut(edges: list[Edge], by: list[Edge]) -> list[Edge]:
    """edges in pieces that no edge of by crosses or ends within."""
    out = []
    for a, b in edges:
        dx, dy = b[0] - a[0], b[1] - a[1]
        size, at = dx * dx + dy * dy, {0.0: a, 1.0: b}
        for c, d in by:
            den = dx * (d[1] - c[1]) - dy * (d[0] - c[0])
            if abs(den) > EPS:
                u = ((c[0] - a[0]) * (d[1] - c[1]) - (c[1] - a[1]) * (d[0] - c[0])) / den
                w = ((c[0] - a[0]) * dy - (c[1] - a[1]) * dx) / den
                if EPS < u < 1 - EPS and -EPS <= w <= 1 + EPS:
                    at[u] = c if abs(w) <= EPS else d if abs(w - 1) <= EPS else (a[0] + u * dx, a[1] + u * dy)
            else:
                for e in (c, d):
                    u = ((e[0] - a[0]) * dx + (e[1] - a[1]) * dy) / size
                    if EPS < u < 1 - EPS and _on(e, a, b):
                        at[u] = e
        points = [at[u] for u in sorted(at)]
        out += [(p, q) for p, q in zip(points, points[1:], strict=False) if math.dist(p, q) > EPS]
    return out


def _middle(e: Edge) -> Point:
    return ((e[0][0] + e[1][0]) / 2, (e[0][1] + e[1][1]) / 2)


def _side(e: Edge, other: Geometry, edges: list[Edge]) -> str:
    """in, out, or on the other's boundary, along (same) or against its direction."""
    m = _middle(e)
    if where := locate(m, other):
        return "in" if where > 0 else "out"
    c, d = next((x for x in edges if _on(m, *x)), e)
    return "same" if (e[1][0] - e[0][0]) * (d[0] - c[0]) + (e[1][1] - e[0][1]) * (d[1] - c[1]) > 0 else "against"


def _snapped(edges: list[Edge]) -> list[Edge]:
    """Points that rounding set apart become one."""
    known: dict[tuple[int, int], Point] = {}

    def at(p: Point) -> Point:
        x, y = round(p[0] * 1e9), round(p[1] * 1e9)
        for i in (0, -1, 1):
            for j in (0, -1, 1):
                if (x + i, y + j) in known:
                    return known[x + i, y + j]
        return known.setdefault((x, y), p)

    return [(p, q) for p, q in ((at(a), at(b)) for a, b in edges) if p != q]


def _joined(edges: list[Edge]) -> Geometry:
    """Directed edges as polygons."""
    out: dict[Point, list[Point]] = {}
    for a, b in _snapped(edges):
        out.setdefault(a, []).append(b)
    rings = []
    while out:
        start = min(out)
        ring, here = [start], out[start].pop()
        while here != start:
            ring.append(here)
            before = ring[-2]
            back = math.atan2(before[1] - here[1], before[0] - here[0])
            # The first edge clockwise from where we came keeps to this ring where rings touch.
            turn = lambda q: (back - math.atan2(q[1] - here[1], q[0] - here[0])) % (2 * math.pi) or 2 * math.pi  # noqa: E731, B023
            onward = min(out[here], key=turn)
            out[here].remove(onward)
            here = onward
        for p in [p for p, q in out.items() if not q]:
            del out[p]
        ring = _plain(ring)
        if len(ring) > 2:
            rings.append([*ring, ring[0]])
    shells = sorted(([r] for r in rings if _ring_area(r) > EPS), key=lambda s: _ring_area(s[0]))
    for hole in (r for r in rings if _ring_area(r) < -EPS):
        inside = [s for s in shells if all(locate(p, Geometry("POLYGON", [s[0]])) >= 0 for p in hole) and locate(_middle((hole[0], hole[1])), Geometry("POLYGON", [s[0]])) >= 0]
        if inside:
            inside[0].append(hole)
    return Geometry("POLYGON", shells[0] if shells else []) if len(shells) < 2 else Geometry("MULTIPOLYGON", shells)


def _plain(ring: list[Point]) -> list[Point]:
    """A ring without points on a straight line."""
    n = len(ring)
    return [p for i, p in enumerate(ring) if abs((p[0] - ring[i - 1][0]) * (ring[(i + 1) % n][1] - p[1]) - (p[1] - ring[i - 1][1]) * (ring[(i + 1) % n][0] - p[0])) > EPS]


#: Sides whose pieces are kept of the first and of the second, and those kept the other way round.
_KEEP = {"intersection": ({"in", "same"}, {"in"}), "union": ({"out", "same"}, {"out"}), "difference": ({"out", "against"}, set()), "symmetric_difference": ({"out"}, {"out"})}
_TURNED = {"intersection": (set(), set()), "union": (set(), set()), "difference": (set(), {"in"}), "symmetric_difference": ({"in"}, {"in"})}
Sided = list[tuple[Edge, str]]


def _apart(a: Geometry, b: Geometry) -> bool:
    p, q = a.points(), b.points()
    return any(max(x[i] for x in u) < min(x[i] for x in v) - 1e-6 for u, v in ((p, q), (q, p)) for i in (0, 1))


def _sided(a: Geometry, b: Geometry) -> tuple[Sided, Sided]:
    """The edges of both, cut by each other's, with the side of the other on which they lie."""
    ea, eb = _edges(a), _edges(b)
    if _apart(a, b):
        return [(e, "out") for e in ea], [(e, "out") for e in eb]
    return [(e, _side(e, b, eb)) for e in _cut(ea, eb)], [(e, _side(e, a, ea)) for e in _cut(eb, ea)]


def overlay(op: str, a: Geometry, b: Geometry, sided: Callable[[], tuple[Sided, Sided]] | None = None) -> Geometry:
    """intersection, union, difference or symmetric_difference. Of polygons, in full; of points and lines with anything, intersection and difference; unions of other kinds are collections.

    sided: gives what _sided() gives for the two, where it is known."""
    if op == "symmetric_difference" and not (_polygons(a) and _polygons(b)):
        return overlay("union", overlay("difference", a, b), overlay("difference", b, a))
    if not a.points() or not b.points():
        return {"intersection": Geometry("POLYGON", []), "union": a if a.points() else b, "difference": a}[op]
    if not _polygons(a) or (not _polygons(b) and op == "union"):
        return collect([a, b]) if op == "union" else _lower(op, a, b)
    if not _polygons(b):
        return a if op == "difference" else _lower(op, b, a)
    both = sided() if sided else _sided(a, b)
    kept = [e for pieces, keep in zip(both, _KEEP[op], strict=True) for e, side in pieces if side in keep]
    return _joined(kept + [(e[1], e[0]) for pieces, turned in zip(both, _TURNED[op], strict=True) for e, side in pieces if side in turned])


def _lower(op: str, a: Geometry, b: Geometry) -> Geometry:
    """The points and pieces of lines of a that lie in b, or outside it."""
    inside = lambda p: (locate(p, b) >= 0) == (op == "intersection")
    points = [s.parts[0] for s in a.simple() if s.kind == "POINT" and inside(s.parts[0])]
    if any(s.kind == "LINESTRING" for s in a.simple()):
        lines: list[list[Point]] = []
        for p, q in (e for e in _cut(a.segments(), b.segments()) if inside(_middle(e))):
            if lines and lines[-1][-1] == p:
                lines[-1].append(q)
            else:
                lines.append([p, q])
        if lines or not points:
            return Geometry("LINESTRING", lines[0] if lines else []) if len(lines) < 2 else Geometry("MULTILINESTRING", lines)
    return Geometry("POINT", points) if len(points) < 2 else Geometry("MULTIPOINT", points)


def union_all(gs: Sequence[Geometry]) -> Geometry:
    """The union of many, by halves."""
    gs = [g for g in gs if g.points()]
    while len(gs) > 1:
        gs = [overlay("union", *gs[i : i + 2]) if i + 1 < len(gs) else gs[i] for i in range(0, len(gs), 2)]
    return gs[0] if gs else Geometry("GEOMETRYCOLLECTION", [])


def _circle(p: Point, r: float) -> list[Point]:
    n = 4 * QUARTER
    ring = [(p[0] + r * math.cos(2 * math.pi * i / n), p[1] + r * math.sin(2 * math.pi * i / n)) for i in range(n)]
    return [*ring, ring[0]]


def _around_convex(g: Geometry, r: float) -> list[Point]:
    """The outline of a convex polygon's buffer: each edge moved out, and round each corner the part of its circle between
    the edges' normals. Empty if g is not one, or has corners so near each other that one's circle could stand out beside another's."""
    if g.kind != "POLYGON" or len(g.parts) != 1 or g.parts[0][0] != g.parts[0][-1]:
        return []
    shell = _plain(g.parts[0][:-1] if _ring_area(g.parts[0]) > 0 else g.parts[0][:0:-1])
    n, step = len(shell), math.pi / (2 * QUARTER)
    if not 3 <= n <= 64 or len(set(shell)) < n or any(math.dist(p, q) < r * step for i, p in enumerate(shell) for q in shell[:i]):
        return []
    ways = [math.atan2(shell[(i + 1) % n][1] - p[1], shell[(i + 1) % n][0] - p[0]) for i, p in enumerate(shell)]
    turns = [(ways[i] - ways[i - 1]) % (2 * math.pi) for i in range(n)]
    if any(t >= math.pi for t in turns) or abs(sum(turns) - 2 * math.pi) > 1e-6:
        return []
    out: list[Point] = []
    for i, (x, y) in enumerate(shell):
        low, ring = ways[i - 1] - math.pi / 2, []
        high = low + turns[i]
        for at in (low, high):  # where the normal leaves the circle's polygon, which lies a little inside the circle
            k = (at / step) % 1
            rim = r if min(k, 1 - k) < 1e-9 else r * math.cos(step / 2) / math.cos((k - 0.5) * step)
            ends = [(x + d * math.cos(at), y + d * math.sin(at)) for d in ((r, rim) if rim != r else (r,))]
            if at == low:
                ring += ends
                first, last = math.floor(low / step + 1e-9) + 1, math.ceil(high / step - 1e-9) - 1
                ring += [(x + r * math.cos(j * step), y + r * math.sin(j * step)) for j in range(first, last + 1)]
            else:
                ring += ends[::-1]
        out += ring
    return [*out, out[0]]


def buffer(g: Geometry, r: float) -> Geometry:
    """All within a distance, circles as polygons of 4 * QUARTER sides; a negative distance takes as much away from polygons."""
    if r <= 0:
        rim = union_all([buffer(Geometry("LINESTRING", [a, b]), -r) for a, b in g.segments()]) if r else None
        inner = [s for s in _polygons(g)]
        out = union_all(inner) if inner else Geometry("POLYGON", [])
        return overlay("difference", out, rim) if rim is not None and inner else out
    if ring := _around_convex(g, r):
        return Geometry("POLYGON", [ring])
    parts = [Geometry("POLYGON", [_circle(p, r)]) for p in dict.fromkeys(g.points())]
    for (x0, y0), (x1, y1) in g.segments():
        d = math.dist((x0, y0), (x1, y1))
        if d:
            nx, ny = -(y1 - y0) * r / d, (x1 - x0) * r / d
            ring = [(x0 - nx, y0 - ny), (x1 - nx, y1 - ny), (x1 + nx, y1 + ny), (x0 + nx, y0 + ny)]
            parts.append(Geometry("POLYGON", [[*ring, ring[0]]]))
    return union_all([*parts, *_polygons(g)])


def is_simple(g: Geometry) -> bool:
    """Points differ, and lines meet themselves at most at their common end."""
    points = [s.parts[0] for s in g.simple() if s.kind == "POINT"]
    if len(set(points)) < len(points):
        return False
    return all(_uncrossed(s.parts) for s in g.simple() if s.kind == "LINESTRING")


def _uncrossed(line: list[Point]) -> bool:
    edges = [(a, b) for a, b in zip(line, line[1:], strict=False) if a != b]
    for i, e in enumerate(edges):
        for j in range(i + 1, len(edges)):
            f = edges[j]
            if j == i + 1:
                if _on(f[1], *e) or _on(e[0], *f):
                    if not (len(edges) > 2 and i == 0 and j == len(edges) - 1):
                        return False
            elif _meets(e, f) and not (i == 0 and j == len(edges) - 1 and line[0] == line[-1] and not _on(e[1], *f) and not _on(f[0], *e)):
                return False
    return True


def is_valid(g: Geometry) -> bool:
    """Rings are closed, do not cross themselves or each other, and holes lie in their shell."""
    for s in _polygons(g):
        if any(len(r) < 4 or r[0] != r[-1] or not _uncrossed(r) or abs(_ring_area(r)) <= EPS for r in s.parts):
            return False
        shell = Geometry("POLYGON", [s.parts[0]])
        for hole in s.parts[1:]:
            if any(locate(p, shell) < 0 for p in hole) or any(locate(_middle(e), shell) < 0 for e in _cut(_edges(Geometry("POLYGON", [hole])), _edges(shell))):
                return False
    return all(len(set(s.parts)) > 1 for s in g.simple() if s.kind == "LINESTRING")


def inner_point(g: Geometry) -> Geometry:
    """A point of the geometry: of polygons one in the interior, half way along the widest part of a horizontal cut."""
    best: tuple[float, Point] | None = None
    for s in _polygons(g):
        ys = sorted({p[1] for r in s.parts for p in r})
        for y in ((a + b) / 2 for a, b in zip(ys, ys[1:], strict=False)):
            xs = sorted(a[0] + (y - a[1]) * (b[0] - a[0]) / (b[1] - a[1]) for a, b in s.segments() if (a[1] > y) != (b[1] > y))
            for x0, x1 in zip(xs[::2], xs[1::2], strict=False):
                if best is None or x1 - x0 > best[0]:
                    best = (x1 - x0, ((x0 + x1) / 2, y))
    if best:
        return Geometry("POINT", [best[1]])
    p = g.points()
    c = centroid(g).parts
    return Geometry("POINT", [min(p, key=lambda q: math.dist(q, c[0]))] if p and c else [])


def normalized(g: Geometry) -> Geometry:
    """Shells clockwise and holes the other way, rings from their smallest point, lines from the smaller end, parts in descending order."""

    def ring(r: list[Point], shell: bool) -> list[Point]:
        r = r[:-1] if (_ring_area(r) < 0) == shell else r[::-1][:-1]
        i = r.index(min(r))
        return [*r[i:], *r[:i], r[i]]

    def part(kind: str, x: list) -> list:
        if kind == "POLYGON":
            return [ring(x[0], True), *sorted((ring(h, False) for h in x[1:]), reverse=True)] if x else x
        return (x if x[0] <= x[-1] else x[::-1]) if kind == "LINESTRING" and x else x

    if g.kind == "GEOMETRYCOLLECTION":
        return Geometry(g.kind, sorted(map(normalized, g.parts), key=lambda x: (x.kind, repr(x.parts)), reverse=True))
    return Geometry(g.kind, sorted((part(g.base, x) for x in g.parts) if g.base != "POINT" else g.parts, reverse=True)) if g.kind.startswith("MULTI") else Geometry(g.kind, part(g.kind, g.parts))


# Codes of the well-known binary form.
_CODES = {"POINT": 1, "LINESTRING": 2, "POLYGON": 3, "MULTIPOINT": 4, "MULTILINESTRING": 5, "MULTIPOLYGON": 6, "GEOMETRYCOLLECTION": 7}


def to_wkb(g: Geometry) -> bytes:
    pack = lambda ps: struct.pack("<I", len(ps)) + b"".join(struct.pack("<dd", *p) for p in ps)
    head = struct.pack("<BI", 1, _CODES[g.kind])
    if g.kind == "POINT":
        return head + struct.pack("<dd", *(g.parts[0] if g.parts else (math.nan, math.nan)))
    if g.kind == "LINESTRING":
        return head + pack(g.parts)
    if g.kind == "POLYGON":
        return head + struct.pack("<I", len(g.parts)) + b"".join(map(pack, g.parts))
    parts = g.parts if g.kind == "GEOMETRYCOLLECTION" else [Geometry(g.base, [p] if g.base == "POINT" else p) for p in g.parts]
    return head + struct.pack("<I", len(parts)) + b"".join(map(to_wkb, parts))


def from_wkb(data: bytes) -> Geometry:
    def read(at: int) -> tuple[Geometry, int]:
        order = "<" if data[at] else ">"
        (code,) = struct.unpack_from(order + "I", data, at + 1)
        at += 5
        kind = next(k for k, v in _CODES.items() if v == code)

        def number() -> int:
            nonlocal at
            at += 4
            return struct.unpack_from(order + "I", data, at - 4)[0]

        def point() -> Point:
            nonlocal at
            at += 16
            return struct.unpack_from(order + "dd", data, at - 16)

        if kind == "POINT":
            p = point()
            return Geometry(kind, [] if math.isnan(p[0]) else [p]), at
        if kind == "LINESTRING":
            return Geometry(kind, [point() for _ in range(number())]), at
        if kind == "POLYGON":
            return Geometry(kind, [[point() for _ in range(number())] for _ in range(number())]), at
        parts = []
        for _ in range(number()):
            g, at = read(at)
            parts.append(g if kind == "GEOMETRYCOLLECTION" else g.parts[0] if g.kind == "POINT" else g.parts)
        return Geometry(kind, parts), at

    return read(0)[0]


def _series(kind: str, f: Callable, *columns: Column) -> Column:
    """f of parsed geometries, in Arrow batches; NULL for NULL. A text that repeats within a batch is parsed once."""

    def rows(*xs: pd.Series) -> pd.Series:
        known: dict[str, Geometry] = {}
        parsed = lambda x: known[x] if x in known else known.setdefault(x, parse(x))
        return pd.Series([None if any(x is None for x in r) else f(*map(parsed, r)) for r in zip(*xs, strict=True)], dtype=object)

    if len(columns) == 1:

        @F.pandas_udf(kind)
        def one(a: pd.Series) -> pd.Series:
            return rows(a)

        return one(*columns)

    @F.pandas_udf(kind)
    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return rows(a, b)

    return two(*columns)


_sided_texts = functools.lru_cache(1 << 13)(lambda a, b: _sided(_parsed(a), _parsed(b)))


@functools.lru_cache(KEPT)
def _overlaid(op: str, a: str, b: str) -> str:
    return write(overlay(op, _parsed(a), _parsed(b), lambda: _sided_texts(a, b)))


@functools.lru_cache(KEPT)
def _buffered(g: str, r: float) -> str:
    return write(buffer(_parsed(g), r))


def st_overlay(op: str, a: Column, b: Column) -> Column:
    """intersection, union, difference or symmetric_difference of two WKT columns."""

    @F.pandas_udf("string")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else _overlaid(op, x, y) for x, y in zip(xs, ys, strict=True)], dtype=object)

    return run(a, b)


def st_buffer(g: Column, r: float) -> Column:

    @F.pandas_udf("string")
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else _buffered(x, r) for x in xs], dtype=object)

    return run(g)


def st_union_parts(g: Column) -> Column:
    """A geometry's own parts united."""
    return _series("string", lambda x: write(union_all(x.simple())), g)


def st_as_binary(g: Column) -> Column:
    return _series("binary", to_wkb, g)


def st_from_binary(b: Column) -> Column:
    @F.pandas_udf("string")
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series([None if x is None else write(from_wkb(bytes(x))) for x in xs], dtype=object)

    return run(b)


_MORE: dict[str, tuple[str, Callable[[Geometry], object]]] = {
    "is_simple": ("boolean", is_simple),
    "is_valid": ("boolean", is_valid),
    "is_ring": ("boolean", lambda g: g.kind == "LINESTRING" and len(g.parts) > 3 and g.parts[0] == g.parts[-1] and is_simple(g)),
    "interior_point": ("string", lambda g: write(inner_point(g))),
    "normalized": ("string", lambda g: write(normalized(g))),
    "ogc_type": ("int", lambda g: _CODES[g.kind]),
}


def st_more(name: str, g: Column) -> Column:
    kind, f = _MORE[name]
    return _series(kind, f, g)


def st_geometry_n(g: Column, n: int) -> Column:
    """The n-th part, counted from 0; a single geometry is its own part 0; NULL outside."""

    def part(x: Geometry) -> str | None:
        many = x.kind.startswith("MULTI") or x.kind == "GEOMETRYCOLLECTION"
        parts = x.parts if many else [x]
        if not 0 <= n < len(parts):
            return None
        p = parts[n]
        return write(p if isinstance(p, Geometry) else Geometry(x.base, [p] if x.base == "POINT" else p))

    return _series("string", part, g)


def st_interior_ring_n(g: Column, n: int) -> Column:
    """The n-th hole of a polygon as a line string, counted from 0; NULL outside."""
    return _series("string", lambda x: write(Geometry("LINESTRING", x.parts[n + 1])) if x.kind == "POLYGON" and 0 <= n < len(x.parts) - 1 else None, g)


def st_srid(g: Column) -> Column:
    return F.when(g.isNotNull(), F.coalesce(F.try_to_number(F.nullif(F.regexp_extract(g, r"^\s*SRID=(\d+);", 1), F.lit("")), F.lit("999999")).cast("int"), F.lit(0)))


def st_ordinate(name: str, g: Column) -> Column:
    """z or m of a point's text; NULL if it has none."""
    kind = F.upper(F.regexp_extract(g, r"(?i)^\s*(?:SRID=\d+;)?\s*POINT\s*(ZM|Z|M)?", 1))
    numbers = F.split(F.trim(F.regexp_extract(g, r"\(([^)]*)\)", 1)), r"\s+")
    at = {"z": F.when(kind.isin("Z", "ZM", ""), 2), "m": F.when(kind == "M", 2).when(kind == "ZM", 3)}[name]
    return F.try_element_at(numbers, at + 1).cast("double")


def _by_group(df: DataFrame, keys: Sequence[str], g: str, cells: int, name: str, of: Callable[[list[Geometry]], Geometry]) -> DataFrame:
    """Groups' geometries made one in two steps: rows of a cell of a group, then the cells of a group, so a large group is many tasks."""
    schema = df.select(*keys).schema

    def step(rows: pd.DataFrame) -> pd.DataFrame:
        made = of([parse(x) for x in rows["__g"] if x is not None])
        return pd.DataFrame({**{k: [rows[k].iloc[0]] for k in [*keys, *(["__cell"] if "__cell" in rows else [])]}, "__g": [write(made)]})

    base = df.select(*keys, F.col(g).alias("__g"), F.pmod(F.xxhash64(g), F.lit(cells)).cast("int").alias("__cell"))
    with_cell = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "__cell int", "__g string"])
    without = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields], "__g string"])
    some = base.groupBy(*keys, "__cell").applyInPandas(step, with_cell)
    return some.drop("__cell").groupBy(*keys).applyInPandas(step, without).withColumnRenamed("__g", name)


def st_union_by(df: DataFrame, keys: Sequence[str], g: str, name: str = "geometry", cells: int = 16) -> DataFrame:
    """One row per group: the union of its geometries."""
    return _by_group(df, keys, g, cells, name, union_all)


def st_convex_hull_by(df: DataFrame, keys: Sequence[str], g: str, name: str = "geometry", cells: int = 16) -> DataFrame:
    """One row per group: the convex hull of its geometries; cells send their own hulls on."""
    from spillway.operators.spatial import convex_hull

    return _by_group(df, keys, g, cells, name, lambda gs: convex_hull(collect(gs)) if gs else Geometry("GEOMETRYCOLLECTION", []))


def st_collect_by(df: DataFrame, keys: Sequence[str], g: str, name: str = "geometry") -> DataFrame:
    """One row per group: its geometries as one collection (which holds them all, so its size is the group's)."""
    held = df.groupBy(*keys).agg(F.sort_array(F.collect_list(g)).alias("__g"))

    @F.pandas_udf("string")
    def run(xs: pd.Series) -> pd.Series:
        return pd.Series([write(collect([parse(y) for y in x])) for x in xs], dtype=object)

    return held.select(*keys, run("__g").alias(name))



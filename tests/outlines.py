"""Whole-ring forms of tracing, simplification and crossing, which the tests hold the distributed ones against."""

import math


def link_rings(lines: list[tuple[tuple[int, int], tuple[int, int]]]) -> list[list[tuple[int, int]]]:
    """Closed rings of one zone's border lines; outer ring first, then holes."""
    after: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for a, b in lines:
        after.setdefault(a, []).append(b)
    rings, turn = [], lambda p, q, w: (q[0] - p[0]) * (w[1] - q[1]) - (q[1] - p[1]) * (w[0] - q[0])
    for start in sorted(after):
        while after[start]:
            ring = [start, after[start].pop()]
            while ring[-1] != start:
                # where two lines leave a corner, turn right (rows go down): corner contact does not join
                ways = after[ring[-1]]
                ring.append(ways.pop(max(range(len(ways)), key=lambda i: turn(ring[-2], ring[-1], ways[i]))))
            rings.append(ring)
    return sorted(rings, key=lambda x: -abs(_area(x)))


def _area(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:], strict=False)) / 2


def _length(ring: list[tuple[float, float]]) -> float:
    return sum(math.dist(a, b) for a, b in zip(ring, ring[1:], strict=False))


def simplify(ring: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas-Peucker on a closed ring, from its first corner and the one farthest from it; a ring that would fall below a triangle stays as it is."""
    if len(ring) <= 4:
        return ring
    half = max(range(1, len(ring) - 1), key=lambda i: math.dist(ring[0], ring[i]))
    keep, todo = {0, half, len(ring) - 1}, [(0, half), (half, len(ring) - 1)]
    while todo:
        lo, hi = todo.pop()
        (ax, ay), (bx, by) = ring[lo], ring[hi]
        span = math.hypot(bx - ax, by - ay)
        far, at = tolerance, None
        for i in range(lo + 1, hi):
            x, y = ring[i]
            d = abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / span if span else math.hypot(x - ax, y - ay)
            if d > far:
                far, at = d, i
        if at is not None:
            keep.add(at)
            todo += [(lo, at), (at, hi)]
    out = [ring[i] for i in sorted(keep)]
    return out if len(out) >= 4 else ring


def crossing(rings: list[list[tuple[float, float]]]) -> bool:
    """Whether two edges of the rings meet anywhere but at the end of one and the start of the next."""
    edges = sorted((min(a[0], b[0]), max(a[0], b[0]), n, i, a, b) for n, ring in enumerate(rings) for i, (a, b) in enumerate(zip(ring, ring[1:], strict=False)))

    def turn(p, q, r):
        return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])

    def on(p, q, r):
        return turn(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    for k, (_, hi, n, i, a, b) in enumerate(edges):
        for lo, _, m, j, c, d in edges[k + 1 :]:
            if lo > hi:
                break
            if n == m and (abs(i - j) == 1 or {i, j} == {0, len(rings[n]) - 2}):
                if {a, b} == {c, d}:
                    return True
                continue
            if turn(a, b, c) * turn(a, b, d) < 0 and turn(c, d, a) * turn(c, d, b) < 0:
                return True
            # rings may touch at corners, as zones whose pixels meet in a corner do
            if any(on(p, q, r) and r not in (p, q) for p, q, r in ((a, b, c), (a, b, d), (c, d, a), (c, d, b))):
                return True
    return False

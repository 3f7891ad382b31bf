"""Line simplification by farthest vertex (Douglas-Peucker), with an explicit stack."""

from __future__ import annotations

import math

import numpy as np


#: Lines of so few vertices are walked in Python; an array operation costs more there.
SHORT = 48


def _short_line(coords: list[tuple[float, float]], epsilon: float) -> list[tuple[float, float]]:
    """``simplify_line`` of a few vertices."""
    keep = [False] * len(coords)
    keep[0] = keep[-1] = True
    stack = [(0, len(coords) - 1)]
    while stack:
        a, b = stack.pop()
        (ax, ay), (bx, by) = coords[a], coords[b]
        dx, dy = bx - ax, by - ay
        length2, most, far = dx * dx + dy * dy, epsilon, 0
        for i in range(a + 1, b):
            ox, oy = coords[i][0] - ax, coords[i][1] - ay
            t = min(1.0, max(0.0, (ox * dx + oy * dy) / length2)) if length2 else 0.0
            away = math.hypot(ox - t * dx, oy - t * dy)
            if away > most:
                most, far = away, i
        if far:
            keep[far] = True
            stack += [(a, far), (far, b)]
    return [c for c, kept in zip(coords, keep, strict=True) if kept]


def simplify_line(coords: np.ndarray, epsilon: float) -> np.ndarray:
    """Vertices kept: both ends, and where the farthest from a chord is more than ``epsilon`` away."""
    n = len(coords)
    if epsilon <= 0 or n < 3:
        return coords
    keep = np.zeros(n, bool)
    keep[[0, -1]] = True
    stack = [(0, n - 1)]
    while stack:
        a, b = stack.pop()
        if b - a < 2:
            continue
        inner, base = coords[a + 1 : b], coords[b] - coords[a]
        length2 = float(base @ base)
        offset = inner - coords[a]
        t = np.clip(offset @ base / length2, 0, 1) if length2 else np.zeros(len(inner))
        away = np.hypot(*(offset - t[:, None] * base).T)
        far = int(np.argmax(away))
        if away[far] > epsilon:
            keep[a + 1 + far] = True
            stack += [(a, a + 1 + far), (a + 1 + far, b)]
    return coords[keep]


def simplify(kind: str, parts: list, epsilon: float) -> list | None:
    """Parts of a geometry simplified; None if nothing viable is left.  Points stay as they are."""
    if epsilon <= 0 or kind in ("Point", "MultiPoint"):
        return parts

    def line(coords):
        if len(coords) <= SHORT:
            return _short_line(coords, epsilon) if len(coords) > 2 else coords
        return [tuple(c) for c in simplify_line(np.asarray(coords, float).reshape(-1, 2), epsilon).tolist()]

    if kind in ("LineString", "MultiLineString"):
        kept = [[x for x in map(line, p) if len(x) >= 2] for p in parts]
        return [p for p in kept if p] or None
    kept = []
    for rings in parts:
        mended = [line(r) for r in rings]
        if mended and len(mended[0]) >= 4:
            kept.append([r for i, r in enumerate(mended) if not i or len(r) >= 4])
    return kept or None

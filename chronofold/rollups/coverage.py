"""Which stretches of time a rollup has taken in, and up to which version of its source.

Stretches are (low, high) with the low end in and the high end out; `OPEN` ends reach as far as there are rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

OPEN = 1 << 62
Stretch = tuple[int, int]
Covered = tuple[tuple[int, int, int], ...]  # low, high, version of the source
LIMIT = 256


def union(stretches: Iterable[Stretch]) -> list[Stretch]:
    found: list[Stretch] = []
    for low, high in sorted(s for s in stretches if s[0] < s[1]):
        if found and low <= found[-1][1]:
            found[-1] = found[-1][0], max(high, found[-1][1])
        else:
            found.append((low, high))
    return found


def intersection(left: Iterable[Stretch], right: Iterable[Stretch]) -> list[Stretch]:
    right = list(right)
    return union((max(a, c), min(b, d)) for a, b in left for c, d in right)


def gaps(covered: Covered, low: int, high: int) -> list[Stretch]:
    """What of [low, high) is not covered."""
    found, at = [], low
    for a, b, _ in covered:
        if a > at:
            found.append((at, min(a, high)))
        at = max(at, b)
    return union([*found, (at, high)]) if at < high else union(found)


def with_stretch(covered: Covered, low: int, high: int, version: int) -> Covered:
    """`covered` once [low, high) is taken in at a version."""
    if low >= high:
        return covered
    parts = [(a, min(b, low), v) for a, b, v in covered if a < low] + [(max(a, high), b, v) for a, b, v in covered if b > high]
    found: list[tuple[int, int, int]] = []
    for a, b, v in sorted([*(p for p in parts if p[0] < p[1]), (low, high, version)]):
        if found and found[-1][1] == a and found[-1][2] == v:
            found[-1] = found[-1][0], b, v
        else:
            found.append((a, b, v))
    while len(found) > LIMIT:
        # Neighbours become one stretch of the lower version: at worst something is computed again.
        k = next((k for k in range(len(found) - 1) if found[k][1] == found[k + 1][0]), None)
        if k is None:
            break
        found[k : k + 2] = [(found[k][0], found[k + 1][1], min(found[k][2], found[k + 1][2]))]
    return tuple(found)


def stale(covered: Covered, low: int, high: int, changes: Sequence[tuple[int, int, int]]) -> list[Stretch]:
    """What of [low, high) has to be computed: gaps, and covered stretches that meet a later change (low, high, version)."""
    late = [
        (max(a, c, low), min(b, d, high)) for a, b, seen in covered for c, d, version in changes if version > seen and c < b and d > a
    ]
    return union([*gaps(covered, low, high), *late])


def fewer(stretches: list[Stretch], limit: int = 64) -> list[Stretch]:
    """At most `limit` stretches that contain the given ones: the smallest gaps between them are closed."""
    while len(stretches) > limit:
        k = min(range(len(stretches) - 1), key=lambda k: stretches[k + 1][0] - stretches[k][1])
        stretches = [*stretches[:k], (stretches[k][0], stretches[k + 1][1]), *stretches[k + 2 :]]
    return stretches

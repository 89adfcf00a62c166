"""Spans of a text: start, end (exclusive), kind."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable

Span = tuple[int, int, str]


def apart(spans: Iterable[Span], others: list[Span]) -> list[Span]:
    """The spans that overlap none of ``others``, in time that grows with their numbers, not the product."""
    starts: list[int] = []
    ends: list[int] = []
    for start, end, _ in sorted(others):
        if ends and start < ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)

    def free(span: Span) -> bool:
        k = bisect_right(starts, span[1] - 1)  # the stretches that start before its end
        return k == 0 or ends[k - 1] <= span[0]

    return [s for s in spans if free(s)]

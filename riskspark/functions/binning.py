"""Bin-index expressions over an edge array (D14 equal width, E8 quantile).

Edges are an array column or literal; the bin of a row is a pure function of
the row and the edges, so it never changes on recompute (trap T7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def edges_literal(edges: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(e)) for e in edges])


def equal_width_edges(lo: float, hi: float, n_bins: int) -> list[float]:
    """n_bins + 1 edges lo + i * step, last edge exactly hi (like linspace)."""
    step = (hi - lo) / n_bins
    edges = [i * step + lo for i in range(n_bins)]
    edges.append(float(hi))
    return edges


def histogram_bin(x, edges, n_bins: int) -> Column:
    """Equal-width bin: closed left, the last bin closed on both ends.

    ``width_bucket`` puts the maximum outside (trap T2), so count the edges at
    or below the value instead.  Values outside the edge range give null.
    """
    x = _col(x)
    edges = _col(edges) if not isinstance(edges, (list, tuple)) else edges_literal(edges)
    idx = F.least(F.size(F.filter(edges, lambda e: e <= x)) - F.lit(1), F.lit(n_bins - 1))
    inside = (x >= F.element_at(edges, 1)) & (x <= F.element_at(edges, -1))
    return F.when(x.isNotNull() & inside, idx)


def quantile_bin(x, edges) -> Column:
    """qcut label on de-duplicated edges: closed right, lowest edge included.

    With fewer than two distinct edges every label is null, as pandas gives
    NaN; so is a null value.
    """
    x = _col(x)
    edges = _col(edges) if not isinstance(edges, (list, tuple)) else edges_literal(edges)
    label = F.greatest(F.size(F.filter(edges, lambda e: e < x)) - F.lit(1), F.lit(0))
    ok = x.isNotNull() & (F.size(edges) >= 2) & (x >= F.element_at(edges, 1)) \
        & (x <= F.element_at(edges, -1))
    return F.when(ok, label)


def decile_probabilities(n: int = 10) -> list[float]:
    return [i / n for i in range(n + 1)]

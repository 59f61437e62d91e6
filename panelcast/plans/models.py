"""Fixed-weight stand-in models for the registered queries.

The reference scores trained networks whose weights are not published; these stand-ins are
built from simple rules so that every scoring path has an exact SQL restatement. They are test
models, not forecasts anyone should use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelcast.operators.scoring import LinearModel, TabularLinear

HORIZON = 3
PANEL_MONTHS = 6
SERIES_MONTHS = 12
N_FEATURES = 5


def recency_weights(months: int, width: int, n_features: int = N_FEATURES) -> list[list[float]]:
    """Recency-weighted mean of the features, damped by 10 % per horizon step; columns past
    ``n_features`` in a row (the entity id) get weight 0."""
    total = months * (months + 1) / 2
    return [[0.0 if c >= n_features else (t + 1) / total / n_features * (1.0 - 0.1 * h)
             for t in range(months) for c in range(width)]
            for h in range(1, HORIZON + 1)]


def last_month_weights(months: int, width: int, n_features: int = N_FEATURES) -> list[list[float]]:
    """Mean of the last month's features."""
    return [[1.0 / n_features if (t == months - 1 and c < n_features) else 0.0
             for t in range(months) for c in range(width)]
            for _ in range(1, HORIZON + 1)]


def panel_models() -> dict[str, LinearModel]:
    """Models over the panel tensor: 6 months x (5 features + id)."""
    w = N_FEATURES + 1
    return {
        "recency": LinearModel(tuple(map(tuple, recency_weights(PANEL_MONTHS, w))), (0.0, 0.0, 0.0)),
        "last_month": LinearModel(tuple(map(tuple, last_month_weights(PANEL_MONTHS, w))),
                                  (0.01, 0.02, 0.03)),
    }


def series_models() -> dict[str, LinearModel]:
    """Models over the national window: 12 months x 5 features."""
    return {
        "recency": LinearModel(tuple(map(tuple, recency_weights(SERIES_MONTHS, N_FEATURES))),
                               (0.0, 0.0, 0.0)),
        "last_month": LinearModel(tuple(map(tuple, last_month_weights(SERIES_MONTHS, N_FEATURES))),
                                  (0.01, 0.02, 0.03)),
    }


ENTITY_EFFECT = 0.001


def tabular_model() -> TabularLinear:
    """Linear model on the 30 flat panel features (the dense part of the tabular stand-in)."""
    w = recency_weights(PANEL_MONTHS, N_FEATURES)
    return TabularLinear(tuple(map(tuple, w)), (0.0, 0.0, 0.0))


def tabular_effects(ids: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """One-hot block weights of the tabular stand-in, one row per entity id: ``0.001 * i * h``
    at horizon ``h``. Built from the id table, so it grows with the entities on the cluster."""
    i = F.col(id_col).cast("double")
    eff = F.array(*[F.lit(ENTITY_EFFECT) * i * F.lit(float(h)) for h in range(1, HORIZON + 1)])
    return ids.select(id_col, eff.alias("effect"))


def tree_nodes(horizons: int = HORIZON, trees: int = 4) -> list[tuple]:
    """Rule-built regression trees on 30 flat features and the one-hot id, as rows of a node table: the root asks for a
    feature of the last month, its children for one of an earlier month and for one entity."""
    width = PANEL_MONTHS * N_FEATURES
    rows = []
    for h in range(1, horizons + 1):
        for t in range(trees):
            last = (PANEL_MONTHS - 1) * N_FEATURES + (t + h) % N_FEATURES
            earlier = ((t * 7 + h * 3) % (PANEL_MONTHS - 1)) * N_FEATURES + t % N_FEATURES
            entity = width + 3 * t + h
            shift, size = 0.1 * t - 0.13, 0.5 / (t + h)
            rows += [(h, t, 0, last, shift, 1, 2, None, False), (h, t, 1, earlier, -0.37 + 0.21 * t, 3, 4, None, t % 2 == 1),
                     (h, t, 2, entity, 0.5, 5, 6, None, False), (h, t, 3, None, None, None, None, -size, False),
                     (h, t, 4, None, None, None, None, size / 4, False), (h, t, 5, None, None, None, None, size, False),
                     (h, t, 6, None, None, None, None, 2 * size, False)]
    return rows

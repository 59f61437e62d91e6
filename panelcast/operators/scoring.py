"""Scoring entity windows with a set of named models.

* ``score``: ``mapInPandas`` over the flattened tensor. Models travel once, as a broadcast of small
  specs, and are built once per Python worker; every Arrow batch is scored as one matrix per model.
  A model that raises or returns the wrong shape yields error rows for that model only.
* ``linear_scores``: a fixed-weight linear scorer written as column expressions (stays in the
  JVM and in whole-stage codegen), used where the weights are known.
* ``score_spark_ml``: a fitted Spark ML model per horizon on an assembled feature vector.
"""

from __future__ import annotations

import logging
import sys
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelcast.session import checkpoint_dir

log = logging.getLogger(__name__)


# ---- model kinds ------------------------------------------------------------------------

def as_tuple(a) -> tuple:
    """Nested tuples of floats (hashable, picklable weights)."""
    a = np.asarray(a, dtype=np.float64)
    return tuple(as_tuple(r) for r in a) if a.ndim > 1 else tuple(float(v) for v in a)


@dataclass(frozen=True)
class LinearModel:
    """``y = W @ flatten(window) + b``; ``W`` has shape (horizon, k * f)."""
    weights: tuple
    bias: tuple

    def predict(self, x: np.ndarray) -> np.ndarray:
        w = np.asarray(self.weights, dtype=np.float64)
        return x.reshape(len(x), -1) @ w.T + np.asarray(self.bias, dtype=np.float64)


@dataclass(frozen=True)
class DenseModel:
    """One hidden ReLU layer on the flattened window (the "Dense" network kind)."""
    w1: tuple
    b1: tuple
    w2: tuple
    b2: tuple

    def predict(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(x.reshape(len(x), -1) @ np.asarray(self.w1).T + np.asarray(self.b1), 0.0)
        return h @ np.asarray(self.w2).T + np.asarray(self.b2)


@dataclass(frozen=True)
class TabularLinear:
    """Linear tabular model on flat features plus a one-hot entity block.

    The one-hot block's weights (one ``horizon``-vector per entity) grow with the number of
    entities, so they are not part of this object: :func:`score_tabular` joins them as an
    ``effects`` DataFrame by entity id, and the product of a one-hot row with them is that
    entity's vector. Only the bounded dense weights travel with the task.
    """
    weights: tuple          # (horizon, k * f)
    bias: tuple

    def predict_flat(self, flat: np.ndarray, effects: np.ndarray) -> np.ndarray:
        w = np.asarray(self.weights, dtype=np.float64)
        return flat @ w.T + effects + np.asarray(self.bias, dtype=np.float64)


@dataclass(frozen=True)
class NpzModel:
    """Linear or dense weights stored in an ``.npz`` file on shared storage."""
    path: str

    def build(self):
        with np.load(self.path) as z:
            if "w1" in z:
                return DenseModel(*(as_tuple(z[k]) for k in ("w1", "b1", "w2", "b2")))
            return LinearModel(as_tuple(z["weights"]), as_tuple(z["bias"]))


def _build(spec):
    return spec.build() if hasattr(spec, "build") else spec


# ---- model set --------------------------------------------------------------------------

@dataclass
class ModelSet:
    """Named model specs in output order. ``load`` keeps the models that build and logs the rest;
    it fails only when none builds."""
    specs: dict = field(default_factory=dict)

    @classmethod
    def load(cls, specs: dict) -> "ModelSet":
        ok = {}
        for name, spec in specs.items():
            try:
                _build(spec)
                ok[name] = spec
            except Exception as exc:  # noqa: BLE001 - a broken artefact is skipped, as in the jobs
                log.warning("model %s not loaded: %s", name, exc)
        if not ok:
            raise RuntimeError("no model could be loaded")
        return cls(ok)

    @property
    def names(self) -> list[str]:
        return list(self.specs)


def _ship(df: DataFrame, specs: dict):
    """A broadcast of the specs, pickled by value. A worker keeps a broadcast's value from task to task, and in the
    dictionary beside it the models that it built."""
    return df.sparkSession.sparkContext.broadcast((cloudpickle.dumps(specs), {}))


def _shipped_models(value: tuple[bytes, dict]) -> dict:
    """The models by name; one that does not build is the exception that says why."""
    specs, kept = value
    if not kept:
        for name, spec in cloudpickle.loads(specs).items():
            try:
                kept[name] = _build(spec)
            except Exception as exc:  # noqa: BLE001
                kept[name] = exc
    return kept


def _rows_out(entity_vals, name, y, horizon, error, carry=None):
    n = len(entity_vals)
    carry = carry if carry is not None else {}
    if error is not None:
        out = {"_e": entity_vals, "model": name, "horizon": np.zeros(n, dtype=np.int32),
               "y": np.full(n, np.nan), "error": error}
        out.update({c: np.asarray(v) for c, v in carry.items()})
        return pd.DataFrame(out)
    out = {
        "_e": np.repeat(np.asarray(entity_vals), horizon),
        "model": name,
        "horizon": np.tile(np.arange(1, horizon + 1, dtype=np.int32), n),
        "y": y.reshape(-1),
        "error": None,
    }
    out.update({c: np.repeat(np.asarray(v), horizon) for c, v in carry.items()})
    return pd.DataFrame(out)


def score(df: DataFrame, models: ModelSet, horizon: int = 3, entity: str = "district",
          tensor: str = "tensor", carry: list[str] | None = None) -> DataFrame:
    """Rows ``(entity, model, horizon, y, error[, carry...])``; ``error`` is NULL for good rows.

    ``carry`` names per-entity columns (such as the target's statistics) passed through to every
    output row of that entity, so later steps need no join back.
    """
    shipped = _ship(df, dict(models.specs))
    carry = list(carry or [])
    etype = df.schema[entity].dataType.simpleString()
    schema = f"{entity} {etype}, model string, horizon int, y double, error string"
    schema += "".join(f", {c} {df.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches):
        built = _shipped_models(shipped.value)
        for pdf in batches:
            if pdf.empty:
                continue
            # Flat rows of equal size are one buffer; the window's shape comes back by a view.
            x = np.concatenate(pdf["__flat"].to_numpy()).astype(np.float64, copy=False)
            x = x.reshape(len(pdf), int(pdf["__steps"].iloc[0]), -1)
            keys = pdf[entity].to_numpy()
            extra = {c: pdf[c].to_numpy() for c in carry}
            for name, model in built.items():
                if isinstance(model, Exception):
                    out = _rows_out(keys, name, None, horizon, f"load: {model}", extra)
                else:
                    try:
                        y = np.asarray(model.predict(x), dtype=np.float64)
                        if y.shape != (len(x), horizon):
                            raise ValueError(f"expected shape {(len(x), horizon)}, got {y.shape}")
                        out = _rows_out(keys, name, y, horizon, None, extra)
                    except Exception as exc:  # noqa: BLE001 - isolate one model's failure
                        out = _rows_out(keys, name, None, horizon, f"predict: {exc}", extra)
                yield out.rename(columns={"_e": entity})

    flat = df.select(entity, F.flatten(tensor).alias("__flat"), F.size(tensor).alias("__steps"), *carry)
    return flat.mapInPandas(run, schema)


def score_tabular(df: DataFrame, model: TabularLinear, effects: DataFrame | None = None,
                  horizon: int = 3, entity: str = "district", flat: str = "flat",
                  id_col: str = "entity_id", effect: str = "effect", name: str = "tabular") -> DataFrame:
    """Score a tabular model on flat window features plus a one-hot entity block.

    ``effects`` holds ``(id_col, effect array<double>[horizon])``, the one-hot block's weights;
    it is joined by id (the planner picks broadcast or shuffle from its size). Entities without a
    row get a zero effect.
    """
    etype = df.schema[entity].dataType.simpleString()
    schema = f"{entity} {etype}, model string, horizon int, y double, error string"
    src = df.select(entity, flat, id_col)
    if effects is not None:
        src = src.join(effects.select(id_col, effect), id_col, "left")
    else:
        src = src.withColumn(effect, F.lit(None).cast("array<double>"))

    def run(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            xs = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[flat]])
            eff = np.stack([np.zeros(horizon) if v is None else np.asarray(v, dtype=np.float64)
                            for v in pdf[effect]])
            try:
                y = model.predict_flat(xs, eff)
                out = _rows_out(pdf[entity].to_numpy(), name, y, horizon, None)
            except Exception as exc:  # noqa: BLE001
                out = _rows_out(pdf[entity].to_numpy(), name, None, horizon, f"predict: {exc}")
            yield out.rename(columns={"_e": entity})

    return src.mapInPandas(run, schema)


def split_scores(scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(good rows, errors)`` of one scoring pass.

    The scores are written once to the shared checkpoint folder, so no model runs a second time (one that is not
    deterministic could fail differently then) and both results survive the loss of executors. Good are the rows of the
    models that failed nowhere, without their ``error`` column; errors are as in :func:`failures`.
    """
    checkpoint_dir(scores.sparkSession)
    held = scores.checkpoint(eager=True)
    errors = failures(held)
    failed = errors.select("model").distinct()           # bounded by the model set
    return held.join(F.broadcast(failed), "model", "left_anti").drop("error"), errors


def good_rows(scores: DataFrame, on_error: str = "drop_model") -> DataFrame:
    """Scores without their ``error`` column.

    ``"raise"`` fails the query on the first error, as the panel job must; ``"drop_model"`` leaves out
    every row of a model that failed anywhere (a batch may fail alone), as the series job does.
    """
    if on_error == "raise":
        ok = F.assert_true(F.col("error").isNull(), F.concat_ws(": ", "model", "error"))
        return scores.filter(ok.isNull()).drop("error")
    return split_scores(scores)[0]


def failures(scores: DataFrame) -> DataFrame:
    """``model, error, n``: what failed, and for how many rows."""
    return (scores.filter(F.col("error").isNotNull()).groupBy("model", "error")
            .agg(F.count(F.lit(1)).alias("n")))


# ---- column-expression scorer ---------------------------------------------------------------

def _dot(values: Column, weights: list[float]) -> Column:
    w = F.array(*[F.lit(float(v)) for v in weights])
    return F.aggregate(F.zip_with(values, w, lambda x, c: x * c), F.lit(0.0), lambda a, b: a + b)


def linear_scores(df: DataFrame, models: dict[str, LinearModel], flat: Column,
                  keys: list[str]) -> DataFrame:
    """Rows ``(keys, model, horizon, y)`` for fixed-weight linear models, as JVM expressions.

    The model x horizon fan-out is one ``inline`` of a literal-sized array per entity (no join).
    """
    entries = []
    for name, m in models.items():
        for h, (w, b) in enumerate(zip(m.weights, m.bias), start=1):
            entries.append(F.struct(F.lit(name).alias("model"), F.lit(h).alias("horizon"),
                                    (_dot(flat, list(w)) + F.lit(float(b))).alias("y")))
    return df.select(*keys, F.inline(F.array(*entries)))


# ---- Spark ML --------------------------------------------------------------------------

def score_spark_ml(df: DataFrame, models: dict[int, object], features: str = "features",
                   keys: list[str] | None = None, name: str = "spark_ml") -> DataFrame:
    """Apply one fitted Spark ML model per horizon to an assembled ``features`` vector, in one plan: each model adds its
    prediction column, and the columns are dealt into rows at the end."""
    keys = keys or ["district"]
    out, found = df.select(*keys, features), []
    for h, m in sorted(models.items()):
        column = m.getOrDefault("predictionCol")
        out = m.transform(out).withColumnRenamed(column, f"_y{h}")
        out = out.select(*keys, features, *[c for c in out.columns if c.startswith("_y")])
        found.append(F.struct(F.lit(name).alias("model"), F.lit(h).alias("horizon"), F.col(f"_y{h}").alias("y")))
    return out.select(*keys, F.inline(F.array(*found)))


def feature_vector(df: DataFrame, flat: str, id_col: str, ids: DataFrame,
                   out: str = "features") -> DataFrame:
    """``[flat values | one-hot(id)]`` as one Spark ML vector; the one-hot block is sparse.

    The encoder is sized on ``ids`` (every entity id), so a batch that lacks the largest id still
    gets the full width.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.functions import array_to_vector

    enc = OneHotEncoder(inputCols=[id_col], outputCols=["_hot"], dropLast=False).fit(ids.select(id_col))
    assembled = enc.transform(df).withColumn("_dense", array_to_vector(F.col(flat)))
    return VectorAssembler(inputCols=["_dense", "_hot"], outputCol=out).transform(assembled).drop(
        "_dense", "_hot")



def _ship_by_value() -> None:
    """Pickle this module's functions and model classes by value, so Python workers need only
    numpy/pandas/pyspark and not this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[__name__])


_ship_by_value()

"""A model registry table: artefacts with digest and version, loaded per worker by digest.

One row per artefact: ``name, version, position`` (output order), ``kind`` (a key of :data:`KINDS`), ``digest`` (SHA-256 of
the payload) and ``payload`` (JSON of the model's arrays). Registering appends; the latest version of a name counts.
:func:`registry_report` lists every latest artefact with what is wrong with it; :func:`model_set` gives the scorer those
that load, and raises if none does.
"""

from __future__ import annotations

import hashlib
import json
import sys
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.operators.scoring import DenseModel, LinearModel, ModelSet, as_tuple

KINDS = {"linear": LinearModel, "dense": DenseModel}
SCHEMA = "name string, version int, position int, kind string, digest string, payload binary"
MOST_BYTES = 256 << 20       # payloads of one model set: they travel to the workers


@dataclass(frozen=True)
class Artefact:
    """What travels to a worker: it is built there, after its digest was checked."""
    kind: str
    digest: str
    payload: bytes

    def build(self):
        if hashlib.sha256(self.payload).hexdigest() != self.digest:
            raise ValueError("the payload does not have its digest")
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind}")
        model = KINDS[self.kind](**{k: as_tuple(v) for k, v in json.loads(self.payload).items()})
        sizes = {np.shape(v)[0] for k, v in asdict(model).items() if k in ("weights", "bias", "w2", "b2")}
        if len(sizes) != 1:
            raise ValueError("weights and bias differ in their number of outputs")
        return model


def artefacts(spark: SparkSession, models: dict[str, object], version: int = 1) -> DataFrame:
    """Registry rows of linear and dense models, in their order."""
    kinds = {c: k for k, c in KINDS.items()}
    rows = []
    for n, (name, model) in enumerate(models.items()):
        payload = json.dumps(asdict(model), sort_keys=True).encode()
        rows.append((name, version, n, kinds[type(model)], hashlib.sha256(payload).hexdigest(), payload))
    return spark.createDataFrame(rows, SCHEMA)


def register(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def latest(table: DataFrame) -> DataFrame:
    """The highest version of every name (of equal ones the highest digest)."""
    last = Window.partitionBy("name").orderBy(F.desc("version"), F.desc("digest"))
    return table.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def registry_report(table: DataFrame) -> DataFrame:
    """``name, version, position, kind, digest, error`` of every latest artefact; ``error`` is NULL for those that load."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            errors = []
            for kind, digest, payload in zip(frame["kind"], frame["digest"], frame["payload"]):
                try:
                    Artefact(kind, digest, bytes(payload)).build()
                    errors.append(None)
                except Exception as exc:  # noqa: BLE001 - every failure is listed
                    errors.append(f"{type(exc).__name__}: {exc}")
            yield frame.drop(columns="payload").assign(error=errors)

    return latest(table).mapInPandas(run, "name string, version int, position int, kind string, digest string, error string")


def model_set(table: DataFrame) -> ModelSet:
    """The artefacts that load, in their order. Their number is the model set's and their size is checked first."""
    newest = latest(table)
    size = newest.agg(F.sum(F.octet_length("payload"))).first()[0] or 0
    if size > MOST_BYTES:
        raise ValueError(f"{size} bytes of artefacts; at most {MOST_BYTES} travel to the workers")
    rows = newest.orderBy("position", "name").collect()
    return ModelSet.load({r.name: Artefact(r.kind, r.digest, bytes(r.payload)) for r in rows})


cloudpickle.register_pickle_by_value(sys.modules[__name__])      # workers need not have this package

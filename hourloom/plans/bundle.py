"""A model together with the preprocessing that it was fitted behind, saved and loaded as one."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from hourloom.config import Columns
from hourloom.plans import training
from hourloom.plans.dataset import Preprocessor

#: Version of the manifest.
FORMAT = 1


@dataclass(frozen=True)
class Bundle:
    model: PipelineModel
    state: Preprocessor
    features: tuple[str, ...]
    horizon: int
    name: str
    version: str = "1.0.0"
    details: dict = field(default_factory=dict)

    def problems(self) -> list[str]:
        """What keeps the bundle from being used: features that are none, doubled, not the fitted state's or not the model's,
        in this order; an unknown horizon."""
        out = training.bundle_problems(list(self.features), self.horizon, self.state.features)
        if list(self.features) != list(self.state.features):
            out.append("features are not those of the fitted state, in its order")
        taken = list(self.model.stages[0].getInputCols())
        if list(self.features) != taken:
            out += [f"feature {i}: {a} here, {b} in the model" for i, (a, b) in enumerate(zip(self.features, taken)) if a != b] or ["another number of features than the model has"]
        return out

    def checked(self) -> Bundle:
        if found := self.problems():
            raise ValueError("; ".join(found))
        return self

    def predict(self, df: DataFrame, cols: Columns = Columns()) -> DataFrame:
        """Raw features through the fitted state and the model; see training.predictions. A column that the state was fitted on
        and that df lacks is an error."""
        if missing := [c for c in [*self.state.bounds, *self.state.fills] if c not in df.columns and c != "pollution_index"]:
            raise ValueError(f"missing features: {missing}")
        return training.predictions(self.model, self.state.transform(df), list(self.features), self.version, cols)


def save_bundle(bundle: Bundle, spark: SparkSession, path: str) -> str:
    """Writes model and manifest under path, the manifest last: a folder without one is no bundle."""
    bundle.checked().model.write().overwrite().save(f"{path}/model")
    manifest = {"format": FORMAT, "name": bundle.name, "version": bundle.version, "horizon": bundle.horizon, "features": list(bundle.features), "details": bundle.details, "state": bundle.state.to_dict()}
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")
    return path


def load_bundle(spark: SparkSession, path: str) -> Bundle:
    """The bundle under path, checked feature by feature against its model."""
    m = json.loads(spark.read.text(f"{path}/manifest", wholetext=True).first()[0])
    if m.get("format") != FORMAT:
        raise ValueError(f"unknown format of a bundle: {m.get('format')}")
    return Bundle(PipelineModel.load(f"{path}/model"), Preprocessor.from_dict(m["state"]), tuple(m["features"]), m["horizon"], m["name"], m["version"], m["details"]).checked()

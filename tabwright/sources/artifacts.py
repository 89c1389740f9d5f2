"""Saved models: a Spark ML pipeline folder and a JSON description beside it."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tabwright.errors import ArtifactError
from tabwright.operators.forest import Forest
from tabwright.operators.preprocess import Dictionary
from tabwright.sources.files import exists, read_json, write_json

# --- fixed values: the model description format ------------------------------
ARTIFACT_VERSION = 1
REQUIRED = (
    "artifact_version",
    "target_column",
    "feature_columns",
    "numeric_columns",
    "categorical_columns",
    "classes",
    "model_type",
    "random_state",
)


@dataclass(frozen=True)
class ModelArtifact:
    """A fitted pipeline and the schema it was fitted on."""

    pipeline: PipelineModel
    target_column: str
    feature_columns: tuple
    numeric_columns: tuple
    categorical_columns: tuple
    classes: tuple
    model_type: str
    random_state: int
    categories: dict = field(default_factory=dict)
    forest: Forest | None = None
    dictionary: Dictionary | None = None

    def description(self) -> dict:
        return {
            "artifact_version": ARTIFACT_VERSION,
            "target_column": self.target_column,
            "feature_columns": list(self.feature_columns),
            "numeric_columns": list(self.numeric_columns),
            "categorical_columns": list(self.categorical_columns),
            "classes": list(self.classes),
            "model_type": self.model_type,
            "random_state": self.random_state,
            "categories": {c: list(v) for c, v in self.categories.items()},
            **({"forest": self.forest.description()} if self.forest else {}),
            **({"dictionary": self.dictionary.description()} if self.dictionary else {}),
        }

    def transform(self, df):
        """``df`` with ``prediction`` and ``probability`` (an array, one entry per class)."""
        scored = self.pipeline.transform(self.dictionary.add_slots(df) if self.dictionary else df)
        if self.forest is not None:
            return self.forest.add_probabilities(scored)
        return scored.withColumn("probability", vector_to_array("probability"))

    def fitted_categories(self) -> dict:
        """Non-blank categories per categorical feature, sorted."""
        return {
            c: tuple(sorted(v for v in values if v.strip())) for c, values in self.categories.items()
        }


def save_artifact(spark, artifact: ModelArtifact, path: str, *, overwrite=False) -> None:
    path = str(path).rstrip("/")
    if exists(spark, path) and not overwrite:
        raise FileExistsError(f"a model exists already at {path}")
    writer = artifact.pipeline.write()
    (writer.overwrite() if overwrite else writer).save(f"{path}/pipeline")
    for name, table in (("forest", artifact.forest), ("dictionary", artifact.dictionary)):
        if table is not None:
            spark.read.parquet(table.path).write.mode("overwrite").parquet(f"{path}/{name}")
    write_json(spark, artifact.description(), f"{path}/artifact.json")


def load_artifact(spark: SparkSession, path: str) -> ModelArtifact:
    path = str(path).rstrip("/")
    if not exists(spark, f"{path}/artifact.json"):
        raise FileNotFoundError(f"no model at {path}")
    data = read_json(spark, f"{path}/artifact.json")
    if not isinstance(data, dict):
        raise ArtifactError("the model description is not a JSON object")
    absent = sorted(set(REQUIRED) - set(data))
    if absent:
        raise ArtifactError(f"the model description lacks {absent}")
    if data["artifact_version"] != ARTIFACT_VERSION:
        raise ArtifactError(f"unknown model version {data['artifact_version']!r}")
    return ModelArtifact(
        pipeline=PipelineModel.load(f"{path}/pipeline"),
        target_column=data["target_column"],
        feature_columns=tuple(data["feature_columns"]),
        numeric_columns=tuple(data["numeric_columns"]),
        categorical_columns=tuple(data["categorical_columns"]),
        classes=tuple(data["classes"]),
        model_type=data["model_type"],
        random_state=data["random_state"],
        categories={c: tuple(v) for c, v in data.get("categories", {}).items()},
        forest=Forest(f"{path}/forest", **data["forest"]) if "forest" in data else None,
        dictionary=Dictionary(f"{path}/dictionary", **data["dictionary"]) if "dictionary" in data else None,
    )


def model_sha256(spark, path: str) -> str:
    """SHA-256 over the model's files: each is hashed by a task, the driver
    combines the sorted (relative path, hash) list."""
    path = str(path).rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    tail = F.element_at(F.split("path", path.rpartition("/")[2] + "/"), -1)
    rows = files.select(tail.alias("name"), F.sha2("content", 256).alias("sha")).collect()
    digest = hashlib.sha256()
    for name, sha in sorted((r["name"], r["sha"]) for r in rows):
        digest.update(f"{name}\0{sha}\n".encode())
    return digest.hexdigest()

"""Fitted models on disk and the table of their runs."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zephyrine.operators import registry
from zephyrine.operators.isolation import IsolationForest
from zephyrine.schemas import MODEL_RUNS
from zephyrine.session import cut_lineage

Model = PipelineModel | KMeansModel | IsolationForest

#: Where fitted models come from: (origin, training step).
FED_BY = (
    ("measurements", "train_best_classifier"),
    ("measurements", "train_best_forecasters"),
    ("measurements", "train_best_clustering"),
)


def _created(spark: SparkSession, name: str) -> bool:
    """Create an empty file unless there is one; of several callers at once one succeeds."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    try:
        if store.getUri().getScheme() == "file":  # where Hadoop checks and creates in two steps
            local = path.toUri().getPath()
            os.makedirs(os.path.dirname(local), exist_ok=True)
            os.close(os.open(local, os.O_CREAT | os.O_EXCL))
        else:
            store.create(path, False).close()
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False


_STAGES = "event long, run_id string, stage string"


class ModelStore:
    """Runs, stages and fitted models under one folder, for any number of writers at once.

    ``model_runs`` and ``model_stages`` are only added to.  A run's stage is that of its last event.  Versions, places
    in the order of runs and numbers of events are claimed by creating an empty file, which succeeds for one writer only.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _table(self, name: str, schema) -> DataFrame:
        try:
            return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _add(self, name: str, rows: list[tuple], schema) -> None:
        # A folder per write: writers of one folder would clear each other's unfinished files.
        path = f"{self.root}/{name}/{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)

    def _claim(self, what: str, after: int) -> int:
        """The first number beyond ``after`` that no writer has; a claim that is never used leaves a gap."""
        number = after + 1
        while not _created(self.spark, f"{self.root}/claims/{what}/{number:012d}"):
            number += 1
        return number

    def runs(self) -> DataFrame:
        """All runs with their present stage."""
        newest = self._table("model_stages", _STAGES).groupBy("run_id").agg(F.max_by("stage", "event").alias("_now"))
        logged = self._table("model_runs", MODEL_RUNS).join(newest, "run_id", "left")
        staged = logged.withColumn("stage", F.coalesce("_now", "stage"))
        return staged.select(*MODEL_RUNS.fieldNames())

    def append_model_run(
        self,
        registry_name: str,
        model_name: str,
        params: dict[str, object],
        metrics: dict[str, float],
        model: Model | None = None,
        target: str | None = None,
        stage: str = "None",
        created_at: dt.datetime | None = None,
    ) -> str:
        """Save the model, if it can be saved, and log the run; returns the run id."""
        run_id = uuid.uuid4().hex
        path = None
        if model is not None:
            path = f"{self.root}/models/{registry_name}/{run_id}"
            params = {**params, "kind": type(model).__name__}
            if isinstance(model, IsolationForest):
                model.save(self.spark, path)
            else:
                model.write().overwrite().save(path)
        last = self.runs().agg(
            F.coalesce(F.max("run_order"), F.lit(0)).alias("run"),
            F.coalesce(
                F.max(F.when(F.col("registry_name") == registry_name, F.col("version"))), F.lit(0)
            ).alias("version"),
        ).first()
        order = self._claim("runs", last["run"])
        version = self._claim(f"versions/{registry_name}", last["version"])
        row = (
            run_id,
            registry_name,
            model_name,
            target,
            order,
            {k: str(v) for k, v in params.items()},
            {k: float(v) for k, v in metrics.items() if v is not None},
            version,
            stage,
            path,
            created_at or dt.datetime.now(),
        )
        self._add("model_runs", [row], MODEL_RUNS)
        return run_id

    def set_stages(self, stages: dict[str, str]) -> None:
        """Log a new stage for each of some runs, in this order."""
        if stages:
            last = self._table("model_stages", _STAGES).agg(F.coalesce(F.max("event"), F.lit(0))).first()[0]
            events = []
            for run_id, stage in stages.items():
                last = self._claim("events", last)
                events.append((last, run_id, stage))
            self._add("model_stages", events, _STAGES)

    def set_stage(self, run_id: str, stage: str) -> None:
        self.set_stages({run_id: stage})

    def stage_if_better(
        self, registry_name: str, run_ids: list[str], metric: str, higher_is_better: bool
    ) -> tuple[str | None, bool]:
        """Best of the given runs goes to Staging when it beats Production."""
        mine = self.runs().filter(F.col("run_id").isin(run_ids))
        best = registry.best_run(mine, metric, higher_is_better).first()
        if best is None:
            return None, False
        current = (
            registry.model_registry(self.runs(), ("Production",))
            .filter(F.col("registry_name") == registry_name)
            .first()
        )
        value = best["metrics"][metric]
        bar = (current["metrics"] or {}).get(metric) if current else None
        improved = bar is None or (value > bar if higher_is_better else value < bar)
        if improved:
            self.set_stage(best["run_id"], "Staging")
        return best["run_id"], improved

    def promote(self, contests=registry.CONTESTS) -> DataFrame:
        """One promotion step for all registry names; returns the decisions."""
        runs = cut_lineage(self.runs())
        metric, up = registry.contest_columns(contests)
        decisions = cut_lineage(registry.compare_stages(runs, metric, up))
        moved = registry.promote(runs, decisions).select("run_id", F.col("stage").alias("now"))
        changed = moved.join(runs.select("run_id", "stage"), "run_id").filter("now <> stage").orderBy("now", "run_id")
        self.set_stages({r["run_id"]: r["now"] for r in changed.collect()})  # two per registry name at most
        return decisions

    def load_model(self, registry_name: str) -> tuple[Model | None, dict[str, str]]:
        """Newest Production model, else Staging, else none, with its name and version."""
        newest = registry.model_registry(self.runs()).filter(
            F.col("registry_name") == registry_name
        )
        rows = {r["stage"]: r for r in newest.collect()}
        row = rows.get("Production") or rows.get("Staging")
        if row is None or row["model_path"] is None:
            return None, {"name": registry_name, "version": "none", "stage": "none"}
        info = {"name": registry_name, "version": str(row["version"]), "stage": row["stage"]}
        kind, path = row["params"].get("kind"), row["model_path"]
        if kind == "IsolationForest":
            return IsolationForest.load(self.spark, path), info
        return (KMeansModel if kind == "KMeansModel" else PipelineModel).load(path), info

"""Where a run finds its inputs and the models built so far."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaylake.config import EngineConfig
from assaylake.operators.joins import heavy_keys
from assaylake.schemas.raw import RAW, RUN_DATE
from assaylake.schemas.vocabulary import VOCABULARY_SCHEMAS
from assaylake.session import is_stored, shuffle_tasks
from assaylake.sources.footers import partition_counts
from assaylake.sources.seeds import default_test_seed, default_unit_seed

Reader = Callable[[str], DataFrame]


class Workspace:
    """Inputs by name plus a registry of models.

    A model is computed on first use and remembered as a lazy DataFrame. ``adopt`` replaces it by a
    stored table, after which every model asked for later reads the table instead of recomputing the plan.
    """

    def __init__(
        self,
        spark: SparkSession,
        raw: Reader,
        vocabulary: Reader,
        config: EngineConfig | None = None,
        seeds: Mapping[str, DataFrame] | None = None,
        raw_counts: Reader | None = None,
    ):
        self.spark = spark
        self.config = config or EngineConfig()
        self._raw = raw
        self._vocabulary = vocabulary
        self._raw_counts = raw_counts
        self._seeds = dict(seeds or {})
        self._models: dict[str, DataFrame] = {}
        self._adopted: set[str] = set()
        self._stored: set[str] = set()
        self._heavy: dict[str, dict[str, DataFrame]] = {}
        self._concept_counts: dict[str, int] | None = None
        self._absent: frozenset[str] = frozenset()

    @classmethod
    def at(cls, spark: SparkSession, root: str, config: EngineConfig | None = None, **seeds: DataFrame) -> Workspace:
        """Workspace over tables stored under ``root`` (``raw/<Type>``, ``vocabulary/<table>``).

        A resource type that was never landed is an empty table, and so is a vocabulary file that was not loaded.
        """

        def raw(resource_type: str) -> DataFrame:
            try:
                return spark.read.schema(RAW).option("mergeSchema", "true").parquet(f"{root}/raw/{resource_type}")
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                return spark.createDataFrame([], RAW)

        def vocabulary(table: str) -> DataFrame:
            if not is_stored(spark, f"{root}/vocabulary/{table}"):
                return spark.createDataFrame([], VOCABULARY_SCHEMAS[table])
            return spark.read.schema(VOCABULARY_SCHEMAS[table]).parquet(f"{root}/vocabulary/{table}")

        def raw_counts(resource_type: str) -> DataFrame:
            return partition_counts(spark, f"{root}/raw/{resource_type}", RAW, RUN_DATE)

        workspace = cls(spark, raw, vocabulary, config, seeds, raw_counts)
        workspace._absent = frozenset(t for t in VOCABULARY_SCHEMAS if not is_stored(spark, f"{root}/vocabulary/{t}"))
        return workspace

    def raw(self, resource_type: str) -> DataFrame:
        return self._raw(resource_type)

    def raw_counts(self, resource_type: str) -> DataFrame:
        """(run date, row_count) of a raw table; of stored tables from file footers."""
        if self._raw_counts is not None:
            return self._raw_counts(resource_type)
        return self.raw(resource_type).groupBy(RUN_DATE).agg(F.count("*").alias("row_count"))

    def vocabulary(self, table: str) -> DataFrame:
        return self._vocabulary(table)

    def vocabularies(self, names: Iterable[str]) -> dict[str, DataFrame]:
        """Those of these vocabulary tables that are there."""
        return {name: self.vocabulary(name) for name in names if name not in self._absent}

    def seed(self, name: str) -> DataFrame:
        if name not in self._seeds:
            default = {"test": default_test_seed, "unit": default_unit_seed}[name]
            self._seeds[name] = default(self.spark)
        return self._seeds[name]

    def model(self, name: str) -> DataFrame:
        if name not in self._models:
            from assaylake.plans import MODELS

            self._models[name] = MODELS[name](self)
        return self._models[name]

    def adopt(self, name: str, stored: DataFrame) -> None:
        self._adopted.add(name)
        self._stored.add(name)
        self._heavy.pop(name, None)
        # Other models may have been planned over what this one was before.
        self._models = {k: v for k, v in self._models.items() if k in self._adopted} | {name: stored}

    def replaced(self, models: Mapping[str, DataFrame]) -> Workspace:
        """The same inputs and models, with some models replaced."""
        other = Workspace(self.spark, self._raw, self._vocabulary, self.config, self._seeds, self._raw_counts)
        other._models, other._adopted = {**self._models, **models}, self._adopted | set(models)
        other._concept_counts = self._concept_counts
        return other

    def fresh(self) -> Workspace:
        """The same inputs; no model is taken over."""
        other = Workspace(self.spark, self._raw, self._vocabulary, self.config, self._seeds, self._raw_counts)
        other._concept_counts, other._absent = self._concept_counts, self._absent
        return other

    def over(self, narrowed: Callable[[DataFrame], DataFrame]) -> Workspace:
        """The same inputs with every raw table cut by ``narrowed``; no model is taken over."""
        return Workspace(self.spark, lambda name: narrowed(self._raw(name)), self._vocabulary, self.config, self._seeds)

    def is_adopted(self, name: str) -> bool:
        return name in self._adopted

    def heavy_references(self, model: str | None) -> dict[str, DataFrame]:
        """Heavy keys of the reference columns of a stored model, by one narrow scan; none where it is not stored,
        as counting would compute it twice, nor where it was replaced by a few changed rows."""
        if model not in self._stored:
            return {}
        if model not in self._heavy:
            rows = self.model(model)
            columns = [c for c in ("patient_ref", "encounter_ref", "specimen_ref") if c in rows.columns]
            self._heavy[model] = heavy_keys(rows, columns, shuffle_tasks(self.spark)) if columns else {}
        return self._heavy[model]

    def concept_count(self, *vocabulary_ids: str) -> int:
        """Exact number of concepts in these vocabularies: an upper bound for any lookup over them.

        One narrow scan serves all lookups of the workspace; only the seven vocabularies the
        marts join are counted, so at most seven rows come back.
        """
        if self._concept_counts is None:
            from assaylake.plans.lookups import JOINED_VOCABULARIES

            counted = (
                self.vocabulary("concept")
                .filter(F.col("vocabulary_id").isin(*JOINED_VOCABULARIES))
                .groupBy("vocabulary_id")
                .count()
            )
            self._concept_counts = {r["vocabulary_id"]: r["count"] for r in counted.collect()}
        return sum(self._concept_counts.get(v, 0) for v in vocabulary_ids)

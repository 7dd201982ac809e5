"""First load: weather and cases to a stored feature table, a model and its quality."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.operators.aggregate import weekly_avg
from miasma.operators.features import REGION, feature_rows
from miasma.operators.geo import NEIGHBOUR_FEATURES, add_neighbour_lags
from miasma.operators.metrics import regression_metrics
from miasma.operators.regional import regional_weekly
from miasma.operators.model import (hash_split, load_model, save_model, score, train_forest,
                                    train_region_forest)
from miasma.schema import CASE_KEY, FEATURES, MEASURES, WEEK_KEY
from miasma.sinks.tables import VersionedTable
from miasma.sources.files import read_ledger


class Store:
    """Where the tables of one deployment live, below one root.

    ``regional``: weather is kept per region, so weeks and training rows have the region as a key
    in every step, and the forest takes the region as a category. ``near``: pairs of regions as
    ``geo.near_places`` gives them; the counts of a region's neighbours are inputs then. The store
    knows this; the steps ask it.
    """

    def __init__(self, spark: SparkSession, root: str, regional: bool = False, near: DataFrame | None = None):
        if near is not None and not regional:
            raise ValueError("neighbours need a regional store")
        self.spark, self.regional, self.near = spark, regional, near
        self.inputs = [*FEATURES, *NEIGHBOUR_FEATURES] if near is not None else list(FEATURES)
        self.keys = (REGION,) if regional else ()
        self.weekly = VersionedTable(spark, f"{root}/weekly", keys=(*self.keys, *WEEK_KEY))
        self.predictions = VersionedTable(spark, f"{root}/predictions", ("year",), (*self.keys, "year", "weekofyear"))
        self.training = VersionedTable(spark, f"{root}/features", ("is_test",), CASE_KEY)
        self.model_root = f"{root}/model"
        self.ledger_path = f"{root}/merged-files"

    def merged_files(self) -> DataFrame:
        """Files that went into the committed versions of the weekly table."""
        return read_ledger(self.spark, self.ledger_path, self.weekly.log.committed())

    def features(self, is_test: bool) -> DataFrame:
        """Training or test rows; the side is a folder (named by text), so only that one is read."""
        rows = self.training.read()
        return rows.filter(rows.is_test == str(is_test).lower()).drop("is_test")

    def put_features(self, rows: DataFrame) -> int:
        """Store rows of both sides in one pass: a key that is stored is replaced, the side of a
        key never changes."""
        return self.training.upsert(hash_split(rows).withColumn("is_test", F.col("is_test").cast("string")))

    def feature_rows(self, cases: DataFrame) -> DataFrame:
        rows = feature_rows(cases, self.weekly.read(), regional=self.regional)
        return rows if self.near is None else add_neighbour_lags(rows, cases, self.near)

    def train(self, **forest_size) -> PipelineModel | RandomForestRegressionModel:
        """Train on the stored training rows and store the model."""
        train = train_region_forest if self.regional else train_forest
        model = train(self.features(is_test=False), features=self.inputs, **forest_size)
        save_model(model, self.spark, self.model_root)
        return model

    def model(self) -> PipelineModel | RandomForestRegressionModel:
        return load_model(self.spark, self.model_root, PipelineModel if self.regional else RandomForestRegressionModel)


def bootstrap(store: Store, obs: DataFrame, cases: DataFrame, measures=MEASURES,
              station_regions: DataFrame | None = None, **forest_size) -> DataFrame:
    """Build everything from history; returns the test-set metrics.

    The observations are read once: later steps start from the stored weekly means. A regional
    store needs ``station_regions`` (STATION, city).
    """
    store.weekly.replace(regional_weekly(obs, station_regions, measures) if store.regional
                         else weekly_avg(obs, measures))
    store.put_features(store.feature_rows(cases))
    store.train(**forest_size)
    return evaluate(store)


def evaluate(store: Store, keys=()) -> DataFrame:
    """Quality of the stored model on the stored test set."""
    return regression_metrics(score(store.model(), store.features(is_test=True), store.inputs), keys=keys)

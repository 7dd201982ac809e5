"""Random forests on feature rows: split, train, score, store."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from miasma.functions.numeric import from_log, to_log
from miasma.operators.features import REGION
from miasma.schema import CASE_KEY, FEATURES, LABEL
from miasma.sinks.tables import VersionLog, new_attempt

# Forest size, split seed and share.
FOREST = {"numTrees": 100, "maxDepth": 10, "maxBins": 32}
SPLIT_SEED = 1947
TEST_PERCENT = 20
FOREST_SEED = 42
REGION_INDEX = "region_index"
# Partitions of the training rows; part of what makes a seed repeatable, so it does not follow the data.
TRAIN_PARTITIONS = 16


def key_percentile(df: DataFrame, keys=tuple(CASE_KEY), seed: int = SPLIT_SEED) -> Column:
    """0…99 out of the key's digest: the same for a key in every run and layout.

    Numeric keys are spelt as integers, whichever numeric type the table gives them.
    """
    types = dict(df.dtypes)
    parts = [F.col(k) if types[k] == "string" else F.col(k).cast("bigint").cast("string")
             for k in keys]
    text = F.concat_ws("|", F.lit(str(seed)), *parts)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100


def hash_split(df: DataFrame, keys=tuple(CASE_KEY), seed: int = SPLIT_SEED,
               test_percent: int = TEST_PERCENT) -> DataFrame:
    """Add ``is_test``. A key keeps its side for ever, so retraining cannot see test weeks."""
    return df.withColumn("is_test", key_percentile(df, keys, seed) < test_percent)


def random_split(df: DataFrame, test_percent: int = TEST_PERCENT,
                 seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Split by drawing rows; sides depend on the table's layout (see ``hash_split``)."""
    return df.randomSplit([100.0 - test_percent, float(test_percent)], seed=seed)


def with_label(df: DataFrame) -> DataFrame:
    return df.withColumn(LABEL, to_log(F.col("total_cases")))


def assemble(df: DataFrame, features=FEATURES, on_null: str = "error") -> DataFrame:
    """Add the ``features`` vector. ``on_null``: error, skip or keep."""
    return VectorAssembler(inputCols=list(features), outputCol="features",
                           handleInvalid=on_null).transform(df)


def feature_array(df: DataFrame, vector: str = "features") -> DataFrame:
    """The vector as an array column, zeros included."""
    return df.withColumn("feature_array", vector_to_array(vector))


def feature_lengths(df: DataFrame, vector: str = "features") -> DataFrame:
    """Distinct vector lengths: one row if all vectors fit the model."""
    return df.select(F.size(vector_to_array(vector)).alias("length")).distinct()


def _training_order(df: DataFrame, keys) -> DataFrame:
    """Same rows, same partitions, same order, whatever the layout of the stored table.

    A forest draws its samples per partition, so a fixed number of partitions is what makes a
    seed repeatable.
    """
    return df.repartition(TRAIN_PARTITIONS, *keys).sortWithinPartitions(*keys)


def train_forest(train: DataFrame, keys=tuple(CASE_KEY), seed: int = FOREST_SEED,
                 features=FEATURES, **size) -> RandomForestRegressionModel:
    """Forest on log cases. ``train`` should be a stored table: MLlib reads it several times."""
    rows = assemble(with_label(_training_order(train, keys)), features)
    forest = RandomForestRegressor(featuresCol="features", labelCol=LABEL,
                                   predictionCol="log_prediction", seed=seed, **{**FOREST, **size})
    return forest.fit(rows.select("features", LABEL))


def train_region_forest(train: DataFrame, keys=tuple(CASE_KEY), seed: int = FOREST_SEED,
                        features=FEATURES, region: str = REGION, **size) -> PipelineModel:
    """Forest on log cases whose inputs include the region as a category, not as a number.

    Indexer, assembler and forest are one pipeline. The indexer's labels go into the vector's
    metadata, so trees split on sets of regions. Regions are numbered in the order of their names,
    which makes the forest independent of the table's layout. A region that training has not seen,
    or a null, is a category of its own without training rows: a split on regions sends it to the
    right, and the other inputs decide the rest.

    The labels are kept on the driver and a split has a bin per region, so this is for tens or
    hundreds of regions.
    """
    indexer = StringIndexer(inputCol=region, outputCol=REGION_INDEX, handleInvalid="keep",
                            stringOrderType="alphabetAsc").fit(train.select(region))
    size = {**FOREST, **size}
    size["maxBins"] = max(size["maxBins"], len(indexer.labels) + 1)
    assembler = VectorAssembler(inputCols=[*features, REGION_INDEX], outputCol="features", handleInvalid="error")
    rows = assembler.transform(indexer.transform(with_label(_training_order(train, keys))))
    forest = RandomForestRegressor(featuresCol="features", labelCol=LABEL, predictionCol="log_prediction", seed=seed, **size)
    return PipelineModel(stages=[indexer, assembler, forest.fit(rows.select("features", LABEL))])


def known_regions(model: PipelineModel) -> list[str]:
    """The regions that a region forest was trained on."""
    return list(model.stages[0].labels)


def score(model: RandomForestRegressionModel | PipelineModel, rows: DataFrame, features=FEATURES) -> DataFrame:
    """Add ``prediction`` on the scale of cases. A pipeline makes its own input vector."""
    scored = model.transform(rows if isinstance(model, PipelineModel) else assemble(rows, features))
    return (scored.withColumn("prediction", from_log(F.col("log_prediction")))
            .drop("features", "log_prediction", REGION_INDEX))


def rolling_folds(rows: DataFrame, cuts: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows with ``fold``: that of the last cut (year, week) at or before the row's week, counted from 1;
    0 for rows before all cuts, which are only trained on."""
    week = F.struct(F.col("year").cast("int").alias("year"), F.col("weekofyear").cast("int").alias("weekofyear"))
    at = [F.struct(F.lit(y).alias("year"), F.lit(w).alias("weekofyear")) for y, w in sorted(set(cuts))]
    fold = F.lit(0)
    for cut in at:
        fold = fold + (week >= cut).cast("int")
    return rows.withColumn("fold", fold)


def rolling_evaluation(rows: DataFrame, cuts: Sequence[tuple[int, int]], features=FEATURES,
                       fit: Callable[..., RandomForestRegressionModel | PipelineModel] = train_forest, **size) -> DataFrame:
    """Scores in order of time: each fold's rows scored by a model of all rows before the fold.

    Returns the rows from the first cut on, with ``fold``, ``prediction`` and, of the rows that the
    model has seen, their number ``n_train`` and the last week ``train_until``. No week is scored
    by a model that has seen it or a later one. ``rows`` should be a stored table: each of the few
    folds reads it. Folds without rows, or without rows before them, give none.
    """
    folded = rolling_folds(rows, cuts)
    week = F.struct(F.col("year").cast("int").alias("year"), F.col("weekofyear").cast("int").alias("weekofyear"))
    known = {r.fold: r.n for r in folded.groupBy("fold").agg(F.count("*").alias("n")).collect()}
    scored = None
    for fold in sorted(f for f in known if f > 0 and any(k < f for k in known)):
        train = folded.filter(F.col("fold") < fold).drop("fold")
        one = score(fit(train, features=features, **size), folded.filter(F.col("fold") == fold), features)
        one = one.withColumns({"n_train": F.lit(sum(n for f, n in known.items() if f < fold)).cast("bigint"),
                               "train_until": train.agg(F.max(week)).scalar()})
        scored = one if scored is None else scored.unionByName(one)
    if scored is not None:
        return scored
    nothing = F.lit(None).cast("struct<year:int,weekofyear:int>")
    return folded.filter(F.lit(False)).withColumns({"prediction": F.lit(0.0), "n_train": F.lit(0).cast("bigint"), "train_until": nothing})


def prediction_table(scored: DataFrame, keys=()) -> DataFrame:
    """Scored rows in the shape in which forecasts are stored."""
    return scored.select(*keys, F.col("year").cast("int").alias("year"),
                         F.col("weekofyear").cast("int").alias("weekofyear"),
                         F.col("prediction").alias("Prediction Cases"))


def train_outbreak_classifier(train: DataFrame, keys=tuple(CASE_KEY), seed: int = FOREST_SEED,
                              features=FEATURES, label: str = "outbreak",
                              **size) -> RandomForestClassificationModel:
    """Forest that tells outbreak weeks from others."""
    rows = assemble(_training_order(train, keys), features)
    rows = rows.select("features", F.col(label).cast("double").alias("label"))
    return RandomForestClassifier(seed=seed, **{**FOREST, **size}).fit(rows)


def detect_outbreak(model: RandomForestClassificationModel, rows: DataFrame,
                    features=FEATURES) -> DataFrame:
    """Add ``outbreak_probability`` and ``predicted_outbreak``. A forest that has seen no outbreak
    knows one class only and gives 0 for the other."""
    scored = model.transform(assemble(rows, features))
    return (scored.withColumn("outbreak_probability", F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)))
            .withColumn("predicted_outbreak", F.col("prediction").cast("int"))
            .drop("features", "rawPrediction", "probability", "prediction"))


def save_model(model, spark: SparkSession, root: str) -> str:
    """Store a model as the next version; the one in force stays until this one is complete."""
    log, attempt = VersionLog(spark, root), new_attempt()
    version = log.following()
    model.write().save(log.path(version, attempt))
    log.commit(version, attempt)
    return log.path(version, attempt)


def load_model(spark: SparkSession, root: str, kind=RandomForestRegressionModel):
    return kind.load(VersionLog(spark, root).latest_path())

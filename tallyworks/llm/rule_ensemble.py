"""Quality score by a sparse ensemble of rules over text statistics.

Trees are grown on a bounded sample of labelled documents. Every path from a root is a rule: a conjunction of bounds on
statistics. A logistic model with a lasso penalty weighs the rules, and those with a weight are compiled into one Spark column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import statistics
from tallyworks.llm.components import stored
from tallyworks.llm.samples import by_hash

TRAIN_ROWS = 20_000
TREES, DEPTH, SEED = 12, 3, 17
PENALTY = 0.002

FEATURES = ("words", "word_length", "symbols", "stop_words", "repeated_lines", "repeated_words", "shouts", "stops", "capitals", "line_words")


@dataclass(frozen=True)
class Rule:
    """Holds where every statistic lies within its bounds: (feature, above or not, threshold)."""

    bounds: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        held = F.lit(True)
        for feature, above, threshold in self.bounds:
            held = held & ((F.col(feature) > threshold) if above else (F.col(feature) <= threshold))
        return held

    def __str__(self) -> str:
        return " and ".join(f"{feature} {'>' if above else '<='} {threshold:.6g}" for feature, above, threshold in self.bounds)


@dataclass(frozen=True)
class Ensemble:
    """Rules with their weights, and the intercept. Without rules the score is that of the intercept for every text."""

    intercept: float
    weighted: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total = total + F.when(rule.column(), F.lit(weight)).otherwise(0.0)
        return 1.0 / (1.0 + F.exp(-total))


def with_features(df: DataFrame, text: str = "text") -> DataFrame:
    """Replaces the text by its statistics; a null text counts as empty, for which all of them are 0."""
    counted = statistics.with_repeats(statistics.with_words(df, text))
    counts = statistics.basic() | {
        "n_lines": statistics.n_lines(),
        "n_stop_words": statistics.n_stop_words(),
        "n_shouts": statistics.matches("[!?]"),
        "n_stops": statistics.matches("[.]"),
        "n_capitals": statistics.matches(r"\p{Lu}"),
    }
    others = [name for name in df.columns if name not in (text, *FEATURES)]
    counted = counted.select(*others, *[count.alias(f"__{name}") for name, count in counts.items()])

    def share(name: str, per: str) -> Column:
        return F.col(f"__{name}") / F.greatest(F.col(f"__{per}"), F.lit(1))

    features = {
        "words": F.col("__n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbols": share("n_symbols", "n_words"),
        "stop_words": share("n_stop_words", "n_words"),
        "repeated_lines": share("n_dup_lines", "n_lines"),
        "repeated_words": share("n_repeat_words", "n_words"),
        "shouts": share("n_shouts", "n_words"),
        "stops": share("n_stops", "n_words"),
        "capitals": share("n_capitals", "word_chars"),
        "line_words": share("n_words", "n_lines"),
    }
    return counted.select(*others, *[feature.alias(name) for name, feature in features.items()])


def held_out(key: str) -> Column:
    """Whether a row is kept from training: crc32 of its key as text has the remainder 1 by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))


def tree_rules(model) -> list[Rule]:
    """Every path from the root of a tree to one of its nodes, as rules without doubles."""
    found: dict[Rule, None] = {}

    def walk(node, bounds: tuple) -> None:
        if bounds:
            found[Rule(tuple(sorted(bounds)))] = None
        if node.subtreeDepth():
            feature, threshold = FEATURES[node.split().featureIndex()], float(node.split().threshold())
            walk(node.leftChild(), (*bounds, (feature, False, threshold)))
            walk(node.rightChild(), (*bounds, (feature, True, threshold)))

    for tree in model.trees:
        walk(tree._java_obj.rootNode(), ())
    return list(found)


def fit(sample: DataFrame, label: str) -> Ensemble:
    """An ensemble from rows with the features and a label of 0 or 1. With one class or no row, it has no rules."""
    counts = {row[label]: row["count"] for row in sample.groupBy(label).count().collect()}
    if len(counts) < 2:
        return Ensemble(20.0 * (1 in counts) - 20.0 * (0 in counts), ())
    labelled = sample.withColumn("label", F.col(label).cast("double"))
    inputs = labelled.withColumn("features", array_to_vector(F.array(*FEATURES)))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird", subsamplingRate=0.7)
    rules = tree_rules(forest.fit(inputs.select("features", "label")))
    held = F.array(*[rule.column().cast("double") for rule in rules])
    ruled = labelled.select(array_to_vector(held).alias("features"), "label")
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100, standardization=False)
    model = lasso.fit(ruled)
    weights = zip(rules, model.coefficients.toArray().tolist())
    return Ensemble(float(model.intercept), tuple((rule, weight) for rule, weight in weights if weight))


def train(documents: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", rows: int = TRAIN_ROWS) -> Ensemble:
    """The ensemble fitted on labelled documents that are not held out.

    Of these at most the given number are used, those with small hashes of key and label. Labels other than 0 and 1, null
    keys and labels without a document count for nothing; a key with several labels counts with each.
    """
    chosen = labels.select(key, F.col(label).cast("int").alias("label"))
    chosen = chosen.filter(F.col("label").isin(0, 1) & F.col(key).isNotNull() & ~held_out(key))
    chosen = by_hash(chosen, [key, "label"], rows)
    # The sample has a fixed number of rows, so that it may go to all tasks and end in one file.
    sample = documents.select(key, "text").join(F.broadcast(stored(chosen, "labels")), key)
    sample = stored(with_features(sample), "sample")
    return fit(stored(sample.coalesce(1).sortWithinPartitions(key, "label"), "sample"), "label")


def predict(df: DataFrame, ensemble: Ensemble, text: str = "text") -> DataFrame:
    """Replaces the text by score, from 0 to 1, and predicted, which is 1 from a score of 0.5 on.

    Every row is scored by itself, so that repeated rows have one score and an empty table gives no rows. A null or empty text
    has the score of statistics that are all 0. Columns of the input with these names or those of FEATURES are replaced.
    """
    others = [name for name in df.columns if name not in (text, *FEATURES, "score", "predicted")]
    scored = with_features(df.select(*others, text), text).select(*others, ensemble.score().alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op1_rule_ensemble(spark: SparkSession, folder: str) -> DataFrame:
    """The quality score of every document."""
    documents = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = predict(documents, train(documents, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted")

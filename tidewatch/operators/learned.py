"""K1 with a scorer that is learned from labelled rows.

Texts become hashed counts of their words and of the words' character
n-grams (letters and digits of any script; expressions and Spark ML's
``HashingTF``, all in the JVM). A multinomial logistic regression is fitted on
the labelled rows of the fitting split, all of them, by Spark's distributed
optimiser: what leaves the executors is a gradient. The held-out split (by a
hash of the id, so that it stays the same for the same ids) then tells the
temperature that makes the probabilities fit best, and the accuracy.

The confidence is the calibrated probability of the label, the score the
probability of positive less that of negative. Empty and NULL texts are never
scored; a text without a letter or digit has the classes' base rates.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefns import anchor
from .scoring import _scorable

CLASSES = ("negative", "neutral", "positive")
FEATURES = 1 << 15
GRAM = 4
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 3.0, 5.0, 8.0)
#: One id in so many is held out.
HELD_OUT = 5


def terms(text: str, gram: int = GRAM) -> Column:
    """A text's words, and their n-grams with the words' borders."""
    words = F.filter(F.split(F.lower(F.col(text)), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    marked = F.transform(words, lambda w: F.concat(F.lit("<"), w, F.lit(">")))
    grams = F.flatten(F.transform(marked, lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.length(w) - gram + 1, F.lit(1))), lambda i: F.substring(w, i, gram))))
    return F.concat(words, F.transform(grams, lambda g: F.concat(F.lit("#"), g)))


def _features(rows: DataFrame, text: str, features: int) -> DataFrame:
    listed = rows.withColumn("_terms", terms(text))
    return HashingTF(numFeatures=features, inputCol="_terms", outputCol="_features", binary=True).transform(listed).drop("_terms")


def held_out(key: str) -> Column:
    return F.pmod(F.xxhash64(F.lit("held out"), F.col(key).cast("string")), F.lit(HELD_OUT)) == 0


def _calibrated(raw: Column, temperature: float) -> Column:
    """Class probabilities of raw margins at a temperature."""
    top = F.array_max(raw)
    grown = F.transform(raw, lambda m: F.exp((m - top) / temperature))
    return F.transform(grown, lambda e: e / F.aggregate(grown, F.lit(0.0), lambda a, b: a + b))


@dataclass
class LearnedScorer:
    model: LogisticRegressionModel
    temperature: float
    accuracy: float | None
    text: str = "review_text"
    features: int = FEATURES

    def probabilities(self, rows: DataFrame, name: str = "_p") -> DataFrame:
        out = self.model.transform(_features(rows, self.text, self.features))
        raw = vector_to_array("rawPrediction")
        return out.withColumn("_raw", raw).withColumn(name, _calibrated(F.col("_raw"), self.temperature)).drop("_raw", "_features", "rawPrediction", "probability", "prediction")

    def score(self, reviews: DataFrame, as_of=None, backend: str = "learned", method: str = "database") -> DataFrame:
        """K1: rows with text get label, score, confidence and the rest."""
        scored = self.probabilities(reviews.filter(_scorable(reviews, self.text)))
        p = F.col("_p")
        best = F.array_max(p)
        label = F.element_at(F.array(*map(F.lit, CLASSES)), F.array_position(p, best).cast("int"))
        return scored.withColumns({
            "sentiment_label": label, "sentiment_score": p[2] - p[0], "sentiment_confidence": best, "processing_time_ms": F.lit(0.0),
            "processed_timestamp": anchor(as_of), "llm_backend": F.lit(backend), "processing_method": F.lit(method)}).drop("_p")

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        row = json.dumps({"temperature": self.temperature, "accuracy": self.accuracy, "text": self.text, "features": self.features})
        SparkSession.active().createDataFrame([(row,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> LearnedScorer:
        about = json.loads(SparkSession.active().read.text(f"{path}/about").first()[0])
        return cls(LogisticRegressionModel.load(f"{path}/model"), **about)


def fit(rows: DataFrame, key: str = "review_id", text: str = "review_text", label: str = "sentiment_label", features: int = FEATURES,
        strength: float = 0.01, iterations: int = 20) -> LearnedScorer:
    """``rows`` with a label of ``CLASSES`` and a text; other rows are not
    used. Without held-out rows the temperature is 1 and there is no accuracy."""
    known = rows.filter(F.col(label).isin(*CLASSES) & _scorable(rows, text))
    place = F.array_position(F.array(*map(F.lit, CLASSES)), F.col(label)) - 1
    known = known.select(place.cast("double").alias("_class"), held_out(key).alias("_held"), F.col(text))
    lr = LogisticRegression(featuresCol="_features", labelCol="_class", family="multinomial", regParam=strength, maxIter=iterations)
    ready = _features(known, text, features).drop(text).persist()  # read once per iteration
    # every class has a place in the margins, also one that no row has
    model = lr.fit(_with_all_classes(ready.filter(~F.col("_held")), features))
    margins = model.transform(ready.filter("_held")).select("_class", vector_to_array("rawPrediction").alias("raw"))
    own = lambda t: F.element_at(_calibrated(F.col("raw"), t), (F.col("_class") + 1).cast("int"))
    right = F.array_position("raw", F.array_max("raw")) - 1 == F.col("_class")
    tried = margins.agg(F.avg(right.cast("double")).alias("accuracy"), *[F.avg(-F.ln(F.greatest(own(t), F.lit(1e-12)))).alias(f"t{k}") for k, t in enumerate(TEMPERATURES)]).first()
    ready.unpersist()
    loss = [tried[f"t{k}"] for k in range(len(TEMPERATURES))]
    temperature = 1.0 if loss[0] is None else TEMPERATURES[min(range(len(loss)), key=loss.__getitem__)]
    return LearnedScorer(model, temperature, tried["accuracy"], text, features)


def _with_all_classes(rows: DataFrame, features: int) -> DataFrame:
    """The column that says there are ``CLASSES``, in the label's metadata."""
    meta = {"ml_attr": {"type": "nominal", "name": "_class", "vals": list(CLASSES)}}
    return rows.withColumn("_class", F.col("_class").alias("_class", metadata=meta))


def evaluate(scorer: LearnedScorer, rows: DataFrame, key: str = "review_id", label: str = "sentiment_label") -> DataFrame:
    """Per label of the held-out rows: their number, and how many the learned
    scorer and the word list get right."""
    from .scoring import lexicon_scores

    held = rows.filter(F.col(label).isin(*CLASSES) & held_out(key)).withColumnRenamed(label, "_true")
    both = scorer.score(held).withColumn("_listed", lexicon_scores(scorer.text)["sentiment_label"])
    return both.groupBy(F.col("_true").alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("sentiment_label") == F.col("_true")).alias("learned_right"), F.count_if(F.col("_listed") == F.col("_true")).alias("listed_right"))

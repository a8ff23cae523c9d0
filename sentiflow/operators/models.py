"""Training and scoring of the sentiment classifiers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.fixed_values import (
    EMPTY_TEXT,
    ENGLISH_STOPWORDS,
    FEATURE_WIDTH,
    HASHING_ITERATIONS,
    SENTIMENTS,
    VOCABULARY_ITERATIONS,
)
from ..functions.ratings import sentiment_name
from ..sources.storage import stage
from .lookup import lookup
from .prepare import empty_after_cleaning, split_rejects, with_clean_text
from .terms import TermStatistics


def _fit_learner(
    features: PipelineModel, rows: DataFrame, learner: LogisticRegression, partitions: int | None
) -> PipelineModel:
    """Fit ``learner`` on ``rows`` of vectors and labels, in ``partitions`` parts if that is given.

    Each step of the optimiser pays for every task, so many small parts are slow; the result depends
    on them only in the last digits of sums.
    """
    if partitions:
        rows = rows.repartition(partitions)
    return PipelineModel([*features.stages, learner.fit(rows)])


def hashing_stages(num_features: int = FEATURE_WIDTH) -> list:
    """Tokens, stop words, hashed term frequency, inverse document frequency."""
    return [
        Tokenizer(inputCol="clean_text", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=ENGLISH_STOPWORDS),
        HashingTF(inputCol="filtered_words", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
    ]


def fit_hashing(
    train: DataFrame,
    num_features: int = FEATURE_WIDTH,
    max_iter: int = HASHING_ITERATIONS,
    reg_param: float = 0.0,
    aggregation_depth: int = 2,
    partitions: int | None = None,
) -> PipelineModel:
    """Hashed TF-IDF and multinomial logistic regression. The model's size is fixed by the width."""
    learner = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        regParam=reg_param,
        family="multinomial",
        aggregationDepth=aggregation_depth,
    )
    texts = train.select("clean_text", "label")
    features = Pipeline(stages=hashing_stages(num_features)).fit(texts)
    return _fit_learner(features, features.transform(texts).select("features", "label"), learner, partitions)


def vocab_features(
    train: DataFrame, size: int = FEATURE_WIDTH, stats: TermStatistics | None = None
) -> tuple[PipelineModel, int]:
    """Fitted vocabulary TF-IDF stages and the number of training documents.

    ``stats`` are the statistics of the training texts (words of two letters at least) where they are
    kept already.

    The vocabulary is the ``size`` most frequent words with ties by word, so refits agree; only
    these rows come to the driver, as part of the model. Vectors are built inside each row.
    """
    stats = stats or TermStatistics.of(train, min_chars=2)
    vocabulary = stats.vocabulary(size).collect()
    if not vocabulary:
        raise ValueError("no words to train on")
    counter = CountVectorizerModel.from_vocabulary(
        [row["word"] for row in vocabulary], inputCol="filtered_words", outputCol="rawFeatures"
    )
    stages = [
        RegexTokenizer(inputCol="clean_text", outputCol="words", pattern=" ", minTokenLength=2),
        StopWordsRemover(inputCol="words", outputCol="filtered_words", stopWords=ENGLISH_STOPWORDS),
        counter,
        ElementwiseProduct(
            scalingVec=Vectors.dense([row["idf"] for row in vocabulary]),
            inputCol="rawFeatures",
            outputCol="weightedFeatures",
        ),
        Normalizer(inputCol="weightedFeatures", outputCol="features", p=2.0),
    ]
    return PipelineModel(stages), stats.documents


def vocab_tfidf(
    df: DataFrame, key: str = "review_id", text: str = "clean_text", size: int = FEATURE_WIDTH
) -> DataFrame:
    """``(key, word, weight)`` over the ``size`` most frequent words, unit length per document.

    Weights and their norm are made inside each row by the stages that training uses, so documents
    are not shuffled and may share keys. Words are looked up by their index in the vocabulary.
    """
    texts = df.select(key, F.col(text).alias("clean_text"))
    stages, _ = vocab_features(texts, size)
    vector = F.unwrap_udt("features")
    entries = F.inline(F.arrays_zip(vector["indices"].alias("index"), vector["values"].alias("weight")))
    sparse = stages.transform(texts).select(key, entries.alias("index", "weight"))
    listed = enumerate(stages.stages[2].vocabulary)
    words = df.sparkSession.createDataFrame(list(listed), "index int, word string")
    return lookup(sparse, words, "index").select(key, "word", "weight")


def fit_vocab(
    train: DataFrame,
    size: int = FEATURE_WIDTH,
    max_iter: int = VOCABULARY_ITERATIONS,
    c: float = 1.0,
    tol: float = 1e-8,
    aggregation_depth: int = 2,
    partitions: int | None = None,
) -> PipelineModel:
    """Vocabulary TF-IDF and L2-regularised multinomial logistic regression.

    ``c`` weighs the summed loss against half the squared norm, which is ``regParam = 1 / (c * n)``
    for the mean loss used here. ``tol`` is tight enough to leave no gradient component above 1e-4.
    """
    features, documents = vocab_features(train, size)
    learner = LogisticRegression(
        featuresCol="features",
        labelCol="label",
        maxIter=max_iter,
        tol=tol,
        regParam=1.0 / (c * documents),
        elasticNetParam=0.0,
        standardization=False,
        family="multinomial",
        aggregationDepth=aggregation_depth,
    )
    return _fit_learner(features, _training_vectors(features, train), learner, partitions)


def _training_vectors(features: PipelineModel, train: DataFrame) -> DataFrame:
    """What the stages of ``vocab_features`` give, made once and staged: the learner reads it twice.

    The vocabulary holds no stop word and no word of one letter, so they are not taken out of the
    texts first.
    """
    words = F.split(F.lower("clean_text"), " ").alias("filtered_words")
    weighed = PipelineModel(features.stages[2:]).transform(train.select(words, "label"))
    return stage(weighed.select("features", "label"), "training-vectors")


def predict(model: PipelineModel, reviews: DataFrame, digits: int | None = None) -> DataFrame:
    """``reviews`` (with ``clean_text``) plus ``prediction`` and one probability column per class."""
    outputs = ["prediction", "probability"]
    scored = model.transform(reviews).select(*(f"`{c}`" for c in reviews.columns), *outputs)
    values = scored.withColumn("_p", vector_to_array("probability")).drop("probability")
    # A class above the highest one seen in training has no entry.
    chances = {
        f"{name.lower()}_probability": F.coalesce(F.get("_p", F.lit(int(class_id))), F.lit(0.0))
        for class_id, name in SENTIMENTS.items()
    }
    if digits is not None:
        chances = {name: F.round(col, digits) for name, col in chances.items()}
    return values.withColumns(chances).drop("_p")


def score(model: PipelineModel, requests: DataFrame, text: str = "text") -> DataFrame:
    """Score requests: their own columns, cleaned text, class name, class id, rounded probabilities.

    Requests without any word are left out; ``score_or_reject`` keeps them. Batch or streaming.
    """
    return _named(predict(model, split_rejects(requests, text)[0], digits=4))


def _named(scored: DataFrame) -> DataFrame:
    return scored.withColumn("label", F.col("prediction").cast("int")).withColumn(
        "prediction", sentiment_name("prediction")
    )


def score_or_reject(model: PipelineModel, requests: DataFrame, text: str = "text") -> DataFrame:
    """Every request once: scored with ``error`` null, or rejected with a reason and no score.

    ``status`` is ``scored`` or ``rejected``. One pass over the requests; batch or streaming.
    """
    cleaned = with_clean_text(requests, text)
    scored = _named(predict(model, cleaned, digits=4))
    rejected = empty_after_cleaning()
    new = [c for c in scored.columns if c not in cleaned.columns]
    return scored.select(
        *(F.col(f"`{c}`") for c in cleaned.columns),
        *(F.when(~rejected, F.col(c)).alias(c) for c in new),
        F.when(rejected, EMPTY_TEXT).alias("error"),
        F.when(rejected, "rejected").otherwise("scored").alias("status"),
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

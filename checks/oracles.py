"""SQL over the given tables with the same rows as ``checks.queries``.

Written independently of the operators: text is cleaned in two regex passes, splits and top-k rank
whole classes, term frequencies are grouped, metrics come from grouped counts.
"""

from __future__ import annotations

from sentiflow.functions.fixed_values import (
    CANONICAL_STOPWORDS,
    CUSTOM_STOPWORDS,
    ENGLISH_STOPWORDS,
)


def _in(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


ENGLISH = _in(ENGLISH_STOPWORDS)
CUSTOM = _in(CUSTOM_STOPWORDS)
DOMAIN = _in(CUSTOM_STOPWORDS + CANONICAL_STOPWORDS)

_TRIMMED = r"trim(regexp_replace(regexp_replace(lower({0}), '[^a-zA-Z\s]', ' ', 'g'), '\s+', ' ', 'g'))"
_UNTRIMMED = r"regexp_replace(lower(regexp_replace({0}, '[^a-zA-Z\s]', ' ', 'g')), '\s+', ' ', 'g')"

_BASE = f"""
reviews AS (
  SELECT d.doc_id AS review_id, d.text AS "Reviews",
         CAST(CASE WHEN l.quality IS NULL AND d.doc_id % 10 = 7 THEN 7
                   WHEN l.quality IS NULL THEN NULL
                   WHEN l.toxic = 1 AND l.quality = 0 THEN 1
                   WHEN l.toxic = 1 THEN 2
                   WHEN l.quality = 0 THEN 3
                   WHEN d.doc_id % 2 = 0 THEN 4
                   ELSE 5 END AS VARCHAR) AS "Rating",
         d.source AS "Product Name", d.lang AS "Brand Name",
         CAST(d.n_chars AS DOUBLE) / 100 AS "Price"
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
),
rated AS (
  SELECT *, TRY_CAST("Rating" AS DOUBLE) AS rating_value FROM reviews
),
all_labels AS (
  SELECT *, CASE WHEN rating_value IN (1, 2) THEN 0.0::DOUBLE
                 WHEN rating_value = 3 THEN 1.0::DOUBLE
                 WHEN rating_value IN (4, 5) THEN 2.0::DOUBLE END AS label
  FROM rated
),
cleaned AS (
  SELECT * FROM (
    SELECT *, {_TRIMMED.format('"Reviews"')} AS clean_text
    FROM all_labels WHERE label IS NOT NULL AND "Reviews" IS NOT NULL
  ) WHERE length(clean_text) > 5
),
texts AS (
  SELECT review_id, clean_text, NULL::DOUBLE AS label FROM (
    SELECT review_id, {_TRIMMED.format('"Reviews"')} AS clean_text FROM reviews)
  WHERE length(clean_text) > 5
)"""

_PREDICTIONS = """,
predictions AS (
  SELECT review_id, clean_text, label,
         CASE length(clean_text) % 7 WHEN 0 THEN 0.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE
              ELSE 2.0::DOUBLE END AS prediction
  FROM cleaned
)"""

_TOKENS = """,
split_words AS (SELECT review_id, label, string_split(clean_text, ' ') AS words FROM cleaned),
token_rows AS (
  SELECT review_id, label, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS position
  FROM split_words
)"""

_WORD_COUNTS = f"""{_TOKENS},
counts AS (
  SELECT label, word, count(*) AS count FROM token_rows
  WHERE length(word) > 2 AND word NOT IN ({ENGLISH}) {{extra}}
  GROUP BY label, word
)"""

_RANKED = """
SELECT label, CAST(rank AS INTEGER) AS rank, word, count FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY count DESC, word) AS rank FROM {table}
) WHERE rank <= {n}"""

_SENTIMENT = "CASE {0} WHEN 0 THEN 'Negative' WHEN 1 THEN 'Neutral' WHEN 2 THEN 'Positive' ELSE 'Unknown' END"

_CLASSES = """,
classes AS (SELECT * FROM (VALUES (0.0::DOUBLE, 'Negative'), (1.0::DOUBLE, 'Neutral'),
                                  (2.0::DOUBLE, 'Positive')) AS t(label, sentiment))"""

_PER_CLASS = """,
per_class AS (
  SELECT c.label, c.sentiment AS name, CAST(support AS BIGINT) AS support,
         CASE WHEN predicted = 0 THEN 0 ELSE hits / predicted END AS precision,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall
  FROM (SELECT c.label, c.sentiment,
               count(*) FILTER (p.label = c.label)::DOUBLE AS support,
               count(*) FILTER (p.prediction = c.label)::DOUBLE AS predicted,
               count(*) FILTER (p.label = c.label AND p.prediction = c.label)::DOUBLE AS hits
        FROM classes c CROSS JOIN {pred} p GROUP BY c.label, c.sentiment) c
),
scored AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0
                 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM per_class
),
metrics AS (
  SELECT sum(recall * support) / sum(support) AS "Accuracy",
         sum(f1 * support) / sum(support) AS "F1",
         sum(precision * support) / sum(support) AS "Precision",
         sum(recall * support) / sum(support) AS "Recall"
  FROM scored
)"""

_METRICS = _PREDICTIONS + _CLASSES + _PER_CLASS

_SPLIT_HASH = "md5('42:' || CAST(review_id AS VARCHAR))"

_LEXICON = """,
lexicon AS (
  SELECT form, regexp_replace(form, 's$', '') AS lemma,
         CASE ('0x' || substr(md5(form), 1, 8))::BIGINT % 3
              WHEN 0 THEN 'ADJ' WHEN 1 THEN 'NOUN' ELSE 'OTHER' END AS pos
  FROM (SELECT DISTINCT word AS form FROM token_rows)
),
keyword_rows AS (
  SELECT t.review_id, t.label, t.position, x.lemma AS word
  FROM token_rows t JOIN lexicon x ON t.word = x.form
  WHERE length(t.word) > 2 AND t.word NOT IN ({english})
    AND x.pos IN ('ADJ', 'NOUN') AND x.lemma NOT IN ({stop})
)"""

_TF = f"""{_TOKENS},
tf AS (
  SELECT review_id, word, count(*) AS tf FROM token_rows
  WHERE word NOT IN ({ENGLISH}) AND length(word) >= {{min_chars}} GROUP BY review_id, word
),
n AS (SELECT count(*) AS docs FROM cleaned)"""

_VOCAB = _TF.format(min_chars=2) + """,
vocabulary AS (
  SELECT word, ln((1.0 + any_value(docs)) / (1.0 + count(*))) + 1 AS idf
  FROM tf, n GROUP BY word ORDER BY sum(tf) DESC, word LIMIT 8000
),
raw AS (SELECT review_id, word, tf.tf * idf AS w FROM tf JOIN vocabulary USING (word)),
unit AS (
  SELECT review_id, word, w / sqrt(sum(w * w) OVER (PARTITION BY review_id)) AS weight FROM raw
)"""

_REQUESTS = f"""
requests AS (
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS request_id,
         text
  FROM conversations
  UNION ALL
  SELECT CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) || '-nothing',
         CASE turn % 3 WHEN 0 THEN '' WHEN 1 THEN '!!! ' || CAST(turn AS VARCHAR) END
  FROM conversations
),
cleaned_requests AS (
  SELECT request_id, text, {_TRIMMED.format("coalesce(text, '')")} AS clean_text FROM requests
)"""

_REVIEW_COLUMNS = 'review_id, "Reviews", "Rating", "Product Name", "Brand Name", "Price"'
_ERROR = "'Input text is empty after cleaning.'"


def _over_reviews(select: str, ctes: str = "") -> str:
    return f"WITH {_BASE}{ctes}\n{select}"


def _over_texts(select: str, ctes: str = "") -> str:
    """The same over the texts of all documents, rated or not."""
    return _over_reviews(select.replace("cleaned", "texts"), ctes.replace("FROM cleaned", "FROM texts"))


def _keywords_top(stop: str) -> str:
    ctes = _TOKENS + _LEXICON.format(english=ENGLISH, stop=stop)
    ctes += ", counts AS (SELECT label, word, count(*) AS count FROM keyword_rows GROUP BY label, word)"
    return _over_reviews(_RANKED.format(table="counts", n=15), ctes)


def _top_words(select: str) -> str:
    return _over_reviews(select, _WORD_COUNTS.format(extra=f"AND word NOT IN ({DOMAIN})"))


def _roundings(digits: int) -> str:
    return ", ".join(f'round("{m}", {digits}) AS "{m}"' for m in ("Accuracy", "F1", "Precision", "Recall"))


_ALL_REVIEWS = _over_reviews(f"SELECT {_REVIEW_COLUMNS} FROM reviews")

_SCORED_ROWS = f"""WITH {_REQUESTS}
SELECT request_id, text, clean_text, CAST(1 AS INTEGER) AS valid FROM cleaned_requests WHERE clean_text <> ''"""

ORACLES = {
    "scored_request_rows": _SCORED_ROWS,
    "scored_stream_rows": _SCORED_ROWS,
    "full_analysis_support": _over_reviews(
        f"""SELECT c.sentiment AS name, count(t.review_id) AS support
FROM classes c LEFT JOIN test t ON t.label = c.label GROUP BY c.sentiment
UNION ALL SELECT 'accuracy', count(*) FROM test""",
        _CLASSES
        + f""",
test AS (SELECT * FROM cleaned WHERE ('0x' || substr({_SPLIT_HASH}, 1, 8))::BIGINT % 10000 >= 8000)""",
    ),
    "csv_roundtrip": _ALL_REVIEWS,
    "csv_split_roundtrip": _ALL_REVIEWS,
    "variant_documents": _ALL_REVIEWS,
    "csv_folder_roundtrip": _ALL_REVIEWS,
    "columnar_roundtrip": _ALL_REVIEWS,
    "project_reviews": _ALL_REVIEWS,
    "class_dimension": _over_reviews(
        f"SELECT review_id, {_SENTIMENT.format('label')} AS sentiment, CAST(label AS BIGINT) AS position FROM cleaned"
    ),
    "review_funnel": _over_reviews(
        """SELECT (SELECT count(*) FROM reviews) AS raw,
       (SELECT count(*) FROM reviews WHERE "Reviews" IS NOT NULL AND "Rating" IS NOT NULL) AS with_text_and_rating,
       (SELECT count(*) FROM all_labels WHERE "Reviews" IS NOT NULL AND label IS NOT NULL) AS valid_rating,
       (SELECT count(*) FROM cleaned) AS cleaned"""
    ),
    "drop_missing": _over_reviews(
        'SELECT review_id, "Rating" FROM reviews WHERE "Reviews" IS NOT NULL AND "Rating" IS NOT NULL'
    ),
    "valid_rating": _over_reviews(
        "SELECT review_id, rating_value AS rating FROM rated WHERE rating_value IN (1, 2, 3, 4, 5)"
    ),
    "clean_text": _over_reviews(
        f"""SELECT review_id, {_TRIMMED.format('"Reviews"')} AS clean_text FROM reviews"""
    ),
    "clean_text_untrimmed": _over_reviews(
        f"""SELECT review_id, {_UNTRIMMED.format('"Reviews"')} AS clean_text FROM reviews"""
    ),
    "min_length": _over_texts(
        "SELECT review_id, CAST(length(clean_text) AS INTEGER) AS chars FROM cleaned WHERE length(clean_text) > 200"
    ),
    "label_from_rating": _over_reviews("SELECT review_id, label FROM all_labels"),
    "sentiment_name": _over_reviews(
        f"SELECT review_id, {_SENTIMENT.format('rating_value')} AS sentiment FROM rated"
    ),
    "for_class": _over_reviews("SELECT review_id, clean_text FROM cleaned WHERE label = 0"),
    "clean_reviews": _over_reviews("SELECT review_id, clean_text, label FROM cleaned"),
    "request_split_rejects": f"""WITH {_REQUESTS}
SELECT request_id, text, clean_text, CASE WHEN clean_text = '' THEN {_ERROR} END AS error
FROM cleaned_requests""",
    "stream_rejects": f"""WITH {_REQUESTS}
SELECT request_id, text, clean_text, {_ERROR} AS error FROM cleaned_requests WHERE clean_text = ''""",
    "tokens": _over_texts(
        "SELECT review_id, CAST(position AS INTEGER) AS position, word FROM token_rows", _TOKENS
    ),
    "tokens_filtered": _over_texts(
        f"""SELECT review_id, word,
       CAST(row_number() OVER (PARTITION BY review_id ORDER BY position) - 1 AS INTEGER) AS position
FROM token_rows WHERE word NOT IN ({ENGLISH})""",
        _TOKENS,
    ),
    "hashing_tf": _over_texts(
        f"""SELECT review_id, CAST(count(*) FILTER (word NOT IN ({ENGLISH})) AS DOUBLE) AS tokens
FROM token_rows GROUP BY review_id""",
        _TOKENS,
    ),
    "tfidf_long": _over_texts(
        """SELECT review_id, word, tf.tf, round(tf.tf * ln((docs + 1.0) / (df + 1.0)), 6) AS weight
FROM tf JOIN (SELECT word, count(*) AS df FROM tf GROUP BY word) USING (word), n""",
        _TF.format(min_chars=1),
    ),
    "vocab_tfidf_long": _over_texts(
        "SELECT review_id, word, round(weight, 6) AS weight FROM unit", _VOCAB
    ),
    "vocab_features": _over_texts(
        """SELECT c.review_id, round(coalesce(sum(weight), 0), 6) AS weight, CAST(count(weight) AS INTEGER) AS words
FROM cleaned c LEFT JOIN unit u ON c.review_id = u.review_id GROUP BY c.review_id""",
        _VOCAB,
    ),
    "keywords_top": _keywords_top(DOMAIN),
    "keywords_top_custom": _keywords_top(CUSTOM),
    "document_keywords": _over_texts(
        "SELECT review_id, CAST(position AS INTEGER) AS position, word FROM keyword_rows",
        _TOKENS + _LEXICON.format(english=ENGLISH, stop=DOMAIN),
    ),
    "class_distribution": _over_reviews(
        """SELECT c.label, c.sentiment, count(r.review_id) AS count
FROM classes c LEFT JOIN cleaned r ON r.label = c.label GROUP BY c.label, c.sentiment""",
        _CLASSES,
    ),
    "word_counts": _over_reviews("SELECT label, word, count FROM counts", _WORD_COUNTS.format(extra="")),
    "top_words": _top_words(_RANKED.format(table="counts", n=15)),
    "top_words_chart": _top_words(_RANKED.format(table="counts", n=10)),
    "sample_predictions": _over_reviews(
        f"""SELECT review_id, clean_text, label, prediction,
       {_SENTIMENT.format('label')} AS actual_sentiment,
       {_SENTIMENT.format('prediction')} AS predicted_sentiment
FROM predictions ORDER BY review_id LIMIT 50""",
        _PREDICTIONS,
    ),
    "confusion_matrix": _over_reviews(
        """SELECT a.label, b.label AS prediction, count(p.review_id) AS count
FROM classes a CROSS JOIN classes b
LEFT JOIN predictions p ON p.label = a.label AND p.prediction = b.label GROUP BY a.label, b.label""",
        _PREDICTIONS + _CLASSES,
    ),
    "confusion_matrix_wide": _over_reviews(
        """SELECT c.sentiment AS actual_sentiment,
       count(*) FILTER (p.prediction = 0) AS predicted_negative,
       count(*) FILTER (p.prediction = 1) AS predicted_neutral,
       count(*) FILTER (p.prediction = 2) AS predicted_positive
FROM classes c LEFT JOIN predictions p ON p.label = c.label GROUP BY c.sentiment""",
        _PREDICTIONS + _CLASSES,
    ),
    "classification_report": _over_reviews(
        """SELECT name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support
FROM scored
UNION ALL
SELECT 'accuracy', NULL, NULL, round(sum(recall * support) / sum(support), 6), CAST(sum(support) AS BIGINT)
FROM scored
UNION ALL
SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM scored
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM scored""",
        _METRICS.format(pred="predictions"),
    ),
    "weighted_metrics": _over_reviews(
        f"SELECT {_roundings(6)} FROM metrics", _METRICS.format(pred="predictions")
    ),
    "metrics_row": _over_reviews(
        f"SELECT {_roundings(4)} FROM metrics", _METRICS.format(pred="predictions")
    ),
    "metrics_long": _over_reviews(
        """SELECT 'Accuracy' AS "Metric", round("Accuracy", 4) AS "Score" FROM metrics
UNION ALL SELECT 'F1', round("F1", 4) FROM metrics
UNION ALL SELECT 'Precision', round("Precision", 4) FROM metrics
UNION ALL SELECT 'Recall', round("Recall", 4) FROM metrics""",
        _METRICS.format(pred="predictions"),
    ),
    "latest_metrics": _over_reviews(
        f"SELECT 'positive' AS run_id, {_roundings(6)} FROM metrics",
        _CLASSES
        + ", positive AS (SELECT label, 2.0::DOUBLE AS prediction FROM cleaned)"
        + _PER_CLASS.format(pred="positive"),
    ),
    "hash_split": _over_texts(
        f"""SELECT review_id,
       CASE WHEN ('0x' || substr({_SPLIT_HASH}, 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
FROM cleaned"""
    ),
    "stratified_split": _over_reviews(
        f"""SELECT review_id, label, CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
FROM (SELECT review_id, label, count(*) OVER (PARTITION BY label) AS n,
             row_number() OVER (PARTITION BY label ORDER BY {_SPLIT_HASH}, review_id) AS place
      FROM cleaned)"""
    ),
    "documents_roundtrip": _over_reviews(f"SELECT {_REVIEW_COLUMNS}, clean_text, label FROM cleaned"),
    "documents_replaced": _over_reviews(f"SELECT {_REVIEW_COLUMNS}, clean_text, label FROM cleaned"),
    "document_records": _over_reviews(
        f"SELECT {_REVIEW_COLUMNS}, 'review_id,Reviews,Rating,Product Name,Brand Name,Price' AS fields FROM reviews"
    ),
    "stratified_split_appended": _over_reviews(
        f"""SELECT c.review_id, c.label,
       CASE WHEN struct_pack(h := {_SPLIT_HASH.replace('review_id', 'c.review_id')}, k := c.review_id) <= last THEN 'test' ELSE 'train' END AS split
FROM cleaned c JOIN (
  SELECT label, struct_pack(h := h, k := review_id) AS last FROM (
    SELECT label, review_id, {_SPLIT_HASH} AS h, count(*) OVER (PARTITION BY label) AS n,
           row_number() OVER (PARTITION BY label ORDER BY {_SPLIT_HASH}, review_id) AS place
    FROM cleaned WHERE review_id % 3 <> 0) WHERE place = ceil(n * 0.2)) t ON t.label = c.label"""
    ),
}

ORACLES |= {
    "tfidf_long_shuffled": ORACLES["tfidf_long"],
    "tfidf_incremental": ORACLES["tfidf_long"],
    "top_words_sketched": ORACLES["top_words"],
    "vocabulary_sketched": _over_texts(
        """SELECT word, CAST(sum(tf) AS BIGINT) AS occurrences, count(*) AS documents
FROM tf GROUP BY word ORDER BY occurrences DESC, word LIMIT 8000""",
        _TF.format(min_chars=2),
    ),
    "document_keywords_shuffled": ORACLES["document_keywords"],
    "csv_rejects": """SELECT 'doc ' || doc_id AS "Product Name", 'brand' AS "Brand Name", NULL::DOUBLE AS "Price",
       CASE WHEN doc_id % 3 = 2 THEN md5(text) END AS "Reviews", 'malformed record' AS error
FROM documents WHERE doc_id % 3 <> 0""",
    "csv_ingest_split": _over_reviews(
        """SELECT key AS review_id,
       CASE WHEN ('0x' || substr(md5('42:' || key), 1, 8))::BIGINT % 10000 < 8000 THEN 'train' ELSE 'test' END AS split
FROM (SELECT md5('0:' || coalesce("Reviews", chr(0)) || chr(1) || coalesce("Rating", chr(0)) || chr(1) ||
             coalesce("Product Name", chr(0)) || chr(1) || coalesce("Brand Name", chr(0)) || chr(1) ||
             coalesce(CAST("Price" AS VARCHAR), chr(0))) AS key FROM reviews)"""
    ),
    "weighted_metrics_incomplete": _over_reviews(
        f"""SELECT {_roundings(6)},
       (SELECT count(*) FROM incomplete WHERE prediction IS NULL OR prediction = 7) AS unpredicted,
       (SELECT count(*) FROM cleaned) - (SELECT count(*) FROM incomplete) AS unlabelled
FROM metrics""",
        _PREDICTIONS
        + _CLASSES
        + """,
incomplete AS (
  SELECT label, CASE review_id % 11 WHEN 0 THEN NULL WHEN 1 THEN 7.0::DOUBLE ELSE prediction END AS prediction
  FROM predictions WHERE review_id % 11 NOT IN (2, 3))"""
        + _PER_CLASS.format(pred="incomplete"),
    ),
    "stratified_split_any_label": _over_reviews(
        f"""SELECT review_id, label, CASE WHEN place <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, count(*) OVER (PARTITION BY label) AS n,
             row_number() OVER (PARTITION BY label ORDER BY {_SPLIT_HASH}, review_id) AS place
      FROM (SELECT review_id, CASE WHEN review_id % 10 < 7 THEN (review_id % 10)::DOUBLE END AS label FROM texts))"""
    ),
    "fit_vocab_terms": _over_reviews(
        """SELECT row_number() OVER (ORDER BY total DESC, word) - 1 AS index, word, round(idf, 6) AS idf
FROM (SELECT word, sum(tf) AS total, ln((1.0 + any_value(docs)) / (1.0 + count(*))) + 1 AS idf
      FROM tf, n GROUP BY word ORDER BY total DESC, word LIMIT 8000)""",
        f""",
train AS (SELECT * FROM cleaned WHERE ('0x' || substr({_SPLIT_HASH}, 1, 8))::BIGINT % 10000 < 8000)"""
        + _TF.format(min_chars=2).replace("FROM cleaned", "FROM train"),
    ),
    "fit_hashing_rows": _over_reviews(
        f"""SELECT label, count(*) FILTER (train) AS trained, count(*) FILTER (NOT train) AS tested,
       CAST(sum(count(*) FILTER (train)) OVER () AS BIGINT) AS documents
FROM (SELECT label, ('0x' || substr({_SPLIT_HASH}, 1, 8))::BIGINT % 10000 < 8000 AS train FROM cleaned) GROUP BY label"""
    ),
    "full_analysis_vocabulary": _over_reviews(
        """SELECT c.sentiment AS name, CAST(coalesce(ceil(n * 0.2), 0) AS BIGINT) AS support
FROM classes c LEFT JOIN (SELECT label, count(*) AS n FROM cleaned GROUP BY label) USING (label)
UNION ALL SELECT 'accuracy', CAST(sum(ceil(n * 0.2)) AS BIGINT)
FROM (SELECT label, count(*) AS n FROM cleaned GROUP BY label)""",
        _CLASSES,
    ),
    "publish_roundtrip": _over_reviews(
        """SELECT 'class_distribution' AS "table", c.sentiment AS "row", 'count' AS "column", CAST(count(r.review_id) AS VARCHAR) AS value
FROM classes c LEFT JOIN cleaned r ON r.label = c.label GROUP BY c.sentiment
UNION ALL SELECT 'top_' || lower(c.sentiment) || '_words', word, 'count', CAST(count AS VARCHAR)
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY count DESC, word) AS rank FROM counts) w
JOIN classes c ON c.label = w.label WHERE rank <= 15
UNION ALL SELECT 'metrics', CAST(round("Accuracy", 4) AS VARCHAR), m.name, CAST(round(m.score, 4) AS VARCHAR)
FROM metrics, (SELECT 'F1' AS name, "F1" AS score FROM metrics UNION ALL SELECT 'Precision', "Precision" FROM metrics
               UNION ALL SELECT 'Recall', "Recall" FROM metrics) m
UNION ALL SELECT 'sample_predictions', CAST(review_id AS VARCHAR), v.name,
       CASE v.name WHEN 'label' THEN CAST(label AS VARCHAR) WHEN 'prediction' THEN CAST(prediction AS VARCHAR)
            WHEN 'actual_sentiment' THEN (SELECT sentiment FROM classes x WHERE x.label = s.label)
            ELSE (SELECT sentiment FROM classes x WHERE x.label = s.prediction) END
FROM (SELECT * FROM predictions ORDER BY review_id LIMIT 50) s,
     (VALUES ('label'), ('prediction'), ('actual_sentiment'), ('predicted_sentiment')) v(name)""",
        _WORD_COUNTS.format(extra=f"AND word NOT IN ({DOMAIN})") + _METRICS.format(pred="predictions"),
    ),
}

ORACLES |= {
    "review_funnel_observed": ORACLES["review_funnel"],
    "stream_batch_log": f"""WITH {_REQUESTS}
SELECT count(*) AS requests, count(*) FILTER (clean_text = '') AS rejected, count(*) AS rows_by_newest FROM cleaned_requests""",
    "publish_replaced": _over_reviews(
        """SELECT 'class_distribution' AS "table", c.sentiment AS "row", 'count' AS "column", CAST(count(r.review_id) AS VARCHAR) AS value
FROM classes c LEFT JOIN cleaned r ON r.label = c.label GROUP BY c.sentiment""",
        _CLASSES,
    ),
}

from .evaluate import (
    class_distribution,
    classification_report,
    confusion_matrix,
    metrics_long,
    metrics_row,
    outcome_counts,
    unmatched_rows,
    weighted_metrics,
)
from .frequent import frequent_words, sketched_top_words, sketched_vocabulary
from .keywords import keyword_counts, keywords, keywords_top
from .lookup import lookup
from .models import (
    fit_hashing,
    fit_vocab,
    hashing_stages,
    load_model,
    predict,
    save_model,
    score,
    score_or_reject,
    vocab_features,
    vocab_tfidf,
)
from .observed import FUNNEL, REQUESTS, observed_cleaning, observed_requests, observed_row
from .prepare import (
    clean_reviews,
    drop_missing,
    for_class,
    min_length,
    project_reviews,
    review_funnel,
    split_rejects,
    valid_rating,
    with_clean_text,
    with_label,
)
from .split import (
    hash_split,
    split_thresholds,
    stratified_split,
    train_and_test,
    with_fitted_split,
    with_hash_split,
    with_stratified_split,
)
from .summary import chart_words, rank_words, sample_predictions, token_rows, top_words, word_counts
from .terms import TermStatistics, add_batch, document_terms, term_rows, tfidf, word_statistics

__all__ = [name for name in dir() if not name.startswith("_")]

from .hashing import key_hash, leading_bits
from .ratings import is_valid_rating, label_from_rating, rating_value, sentiment_name
from .text import clean_text, remove_stopwords, tokens, with_computed

__all__ = [
    "clean_text",
    "is_valid_rating",
    "key_hash",
    "label_from_rating",
    "leading_bits",
    "rating_value",
    "remove_stopwords",
    "sentiment_name",
    "tokens",
    "with_computed",
]

import sys

from pyspark import cloudpickle

from .csv_ranges import read_csv_ranges
from .review_files import check_review_files, ingest_review_files, read_review_files
from .reviews import (
    CORRUPT,
    REVIEW_COLUMNS,
    class_dim,
    corrupt_rows,
    ingest_reviews_csv,
    read_reviews,
    read_reviews_csv,
    with_content_key,
)
from .storage import names_in, remove, scratch_path, shared_dir, stage

# Functions that run in tasks are sent by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = [
    "CORRUPT",
    "REVIEW_COLUMNS",
    "check_review_files",
    "class_dim",
    "corrupt_rows",
    "ingest_review_files",
    "ingest_reviews_csv",
    "names_in",
    "read_csv_ranges",
    "read_review_files",
    "read_reviews",
    "read_reviews_csv",
    "remove",
    "scratch_path",
    "shared_dir",
    "stage",
    "with_content_key",
]

from .collections import read_collection, replace_collection, versions
from .documents import from_variant_documents, to_documents, to_variant_documents, write_documents
from .metrics_log import latest_metrics, read_metrics, write_metrics
from .publish import publish, published_run, read_published

__all__ = [
    "from_variant_documents",
    "latest_metrics",
    "publish",
    "published_run",
    "read_collection",
    "read_metrics",
    "read_published",
    "replace_collection",
    "to_documents",
    "to_variant_documents",
    "versions",
    "write_documents",
    "write_metrics",
]

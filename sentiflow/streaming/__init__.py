from .scoring import start_scoring
from .versions import add_model_version, model_versions, read_batch_log, read_scored, start_versioned_scoring

__all__ = [
    "add_model_version",
    "model_versions",
    "read_batch_log",
    "read_scored",
    "start_scoring",
    "start_versioned_scoring",
]

from .analysis import Analysis, analyse
from .export import export_reviews

__all__ = ["Analysis", "analyse", "export_reviews"]

from . import intermediate, marts, staging  # noqa: F401  (register models)
from .pipeline import MODELS, Pipeline

__all__ = ["MODELS", "Pipeline"]

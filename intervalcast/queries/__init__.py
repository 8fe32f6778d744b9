"""Every operator as a named query over the test tables, with its SQL where SQL can say it."""

from . import accuracy, features, intervals, metrics, models, profile, splits, streams, text
from .registry import REGISTRY

__all__ = [
    "REGISTRY",
    "accuracy",
    "features",
    "intervals",
    "metrics",
    "models",
    "profile",
    "splits",
    "streams",
    "text",
]

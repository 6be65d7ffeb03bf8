"""msgloom: per-user features and a binary classifier from tables of text messages, on Spark."""

from msgloom.config import PipelineConfig

__all__ = ["PipelineConfig"]

"""Data lifecycle of an analytics database, expressed as Spark jobs."""

from .session import checkpoint_root, fresh_dir, materialise, small_side

__all__ = ["checkpoint_root", "fresh_dir", "materialise", "small_side"]

"""Incremental scoring of image files that arrive after the model was fitted."""

from imlens.streaming.score import score_new_images

__all__ = ["score_new_images"]

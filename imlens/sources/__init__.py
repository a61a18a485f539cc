"""Scans (S1-S8) and sinks (K1-K5)."""

from imlens.sources.files import binary_items, image_items, read_features, scan_binary, scan_digests, scan_images
from imlens.sources.sinks import write_csv, write_parquet

__all__ = ["binary_items", "image_items", "read_features", "scan_binary", "scan_digests", "scan_images", "write_csv", "write_parquet"]

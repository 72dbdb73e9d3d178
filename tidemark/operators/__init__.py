"""Operators Spark has no single call for, composed of DataFrame operations."""

from tidemark.operators import delta, distinct
from tidemark.operators.history import advance, is_current, snapshot
from tidemark.operators.latest import latest
from tidemark.operators.ntile import Order, ntile_scores, tile_columns
from tidemark.operators.overlap import overlapping_versions
from tidemark.operators.upsert import DuplicateKeys, require_unique, sync_columns, upsert
from tidemark.operators.watermark import high_water_mark, since

__all__ = ["delta", "distinct", "advance", "is_current", "snapshot", "latest", "Order",
           "ntile_scores", "tile_columns", "overlapping_versions", "DuplicateKeys",
           "require_unique", "sync_columns", "upsert", "high_water_mark", "since"]

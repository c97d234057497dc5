"""Physical-plan helpers: size checks, skew handling, lineage cuts."""

from .lineage import cut_lineage, shared_dir
from .numbering import dense_numbers
from .sizing import broadcast_if_bounded, is_bounded, spread_scan
from .skew import first_per_key, hot_keys, salted_join

__all__ = [
    "broadcast_if_bounded",
    "cut_lineage",
    "dense_numbers",
    "first_per_key",
    "hot_keys",
    "is_bounded",
    "salted_join",
    "shared_dir",
    "spread_scan",
]

from .columns import (
    METRICS,
    distance,
    hash_order,
    is_sentinel,
    not_sentinel,
    safe_div,
    sentinel_to_null,
)

__all__ = ["METRICS", "distance", "hash_order", "is_sentinel", "not_sentinel", "safe_div", "sentinel_to_null"]

"""Column-level helpers: money arithmetic, text, and size-checked broadcast."""

from widelines.functions.money import safe_unit_price, within_tolerance
from widelines.functions.text import customer_name, mask_email, mask_phone, pad_code
from widelines.functions.joins import broadcast_if_bounded, broadcast_if_small_files, is_bounded

__all__ = [
    "safe_unit_price",
    "within_tolerance",
    "customer_name",
    "mask_email",
    "mask_phone",
    "pad_code",
    "broadcast_if_bounded",
    "broadcast_if_small_files",
    "is_bounded",
]

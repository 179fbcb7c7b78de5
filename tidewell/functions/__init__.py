from .scalars import (
    EPOCH_TYPE, day_text, epoch, epoch_key, epoch_text, first_filled, is_blank, json_text, list_size, or_blank,
)

__all__ = [
    "EPOCH_TYPE", "day_text", "epoch", "epoch_key", "epoch_text", "first_filled", "is_blank", "json_text", "list_size",
    "or_blank",
]

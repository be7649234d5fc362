from alloy.functions.columns import (
    ratio,
    interaction,
    mean_of,
    share_of,
    product_of_complements,
    keyed_uniform,
    dated_title,
)

__all__ = [
    "ratio",
    "interaction",
    "mean_of",
    "share_of",
    "product_of_complements",
    "keyed_uniform",
    "dated_title",
]

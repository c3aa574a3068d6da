"""Column expressions used across the package."""

from gasledger.functions.blocks import block_ranges, chunk_id
from gasledger.functions.units import (
    address_from_topic,
    double_text,
    epoch_seconds_to_ts,
    exact_mean,
    hex_quantity,
    iso_text,
    js_default,
    normalize_address,
    to_uint,
    try_to_uint,
    uint256_text,
    utc_date,
    utc_instant,
    wei,
    wei_to_eth,
    wei_to_gwei,
    year_month,
)

__all__ = [
    "address_from_topic", "block_ranges", "chunk_id", "double_text", "epoch_seconds_to_ts",
    "exact_mean", "hex_quantity", "iso_text", "js_default", "normalize_address", "to_uint",
    "try_to_uint", "uint256_text", "utc_date", "utc_instant", "wei", "wei_to_eth", "wei_to_gwei", "year_month",
]

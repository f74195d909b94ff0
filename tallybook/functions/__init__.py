"""Column-level functions."""

from tallybook.functions.fingerprint import KEY, row_fingerprint, row_key
from tallybook.functions.scalars import (
    bytes_to_unit,
    deployment_url,
    epoch_millis,
    null_map,
    quoted,
)

__all__ = [
    "KEY",
    "bytes_to_unit",
    "deployment_url",
    "epoch_millis",
    "null_map",
    "quoted",
    "row_fingerprint",
    "row_key",
]

"""Small scalar expressions shared by the plans. All of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by literal name, also when the name holds dots or backticks."""
    return F.col("`" + name.replace("`", "``") + "`")


def epoch_millis(millis: Column, truncate: bool = False) -> Column:
    """Epoch milliseconds to a timestamp, cut to whole seconds on request."""
    ts = F.timestamp_millis(millis.cast("long"))
    return F.date_trunc("second", ts) if truncate else ts


def bytes_to_unit(size: Column, power: int) -> Column:
    """Bytes to KB (1), MB (2), GB (3) rounded to three digits; NULL counts as zero."""
    return F.round(F.coalesce(size, F.lit(0)) / F.lit(float(1024**power)), 3)


def deployment_url(cloud: Column, deployment: Column, host_suffixes: Mapping[str, str]) -> Column:
    """``https://<deployment><suffix of the cloud>``; NULL for a cloud without a suffix."""
    url = F.lit(None).cast("string")
    for name, suffix in host_suffixes.items():
        address = F.concat(F.lit("https://"), deployment, F.lit(suffix))
        url = F.when(F.upper(cloud) == name.upper(), address).otherwise(url)
    return url


def null_map(keys: Iterable[str]) -> Column:
    """map<string,string> holding every key with a NULL value."""
    pairs = [part for key in keys for part in (F.lit(key), F.lit(None).cast("string"))]
    return F.create_map(*pairs).cast("map<string,string>")

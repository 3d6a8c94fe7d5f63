"""Stable hash buckets (R4): a split that does not depend on partitioning, task order or retries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_bucket(*cols: Column | str, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from the first 28 bits of md5 over the ``|``-joined key columns.

    The same value comes out of SQL as ``('0x' || substr(md5(key), 1, 7))::BIGINT % buckets``.
    """
    key = F.concat_ws("|", *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(key), 1, 7), 16, 10).cast("bigint") % buckets

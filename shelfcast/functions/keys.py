from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(level: Column | str, natural_key: Column) -> Column:
    """Base64 of the md5 bytes of level + natural key; NULL when either is NULL."""
    prefix = F.lit(level) if isinstance(level, str) else level
    return F.base64(F.unhex(F.md5(F.concat(prefix, natural_key))))


def sequence_label(number: Column) -> Column:
    """Two-digit run label. Numbers above 99 keep their last two digits, so 100 gives '00'."""
    return F.right(F.concat(F.lit("0"), number.cast("string")), F.lit(2))

"""64-bit traffic counters assembled from octets and gigawords."""

from pyspark.sql import Column, functions as F

from accesslens.functions.text import uint

# Two saturated totals still add up inside BIGINT.
SATURATED = 2**62 - 1


def octet_total(octets: Column, gigawords: Column, scale: int = 1) -> Column:
    """``(gigawords * 2^32 + octets) * scale`` as BIGINT.

    Counters come from the wire, so a corrupt packet can claim more than 2^62 bytes. Such a total
    saturates instead of failing the whole job with an overflow.
    """
    scale = max(1, int(scale))
    half = SATURATED // 2 // scale
    giga, low = uint(gigawords), uint(octets)
    fits = (giga <= half // 2**32) & (low <= half)
    total = F.when(fits, giga * F.lit(2**32) + low) * F.lit(scale)
    return F.coalesce(total, F.lit(SATURATED)).cast("bigint")

"""Text columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(c: Column) -> Column:
    """Without white space of any script at either end; blank is null."""
    return F.nullif(F.regexp_replace(c.cast("string"), r"(?U)^\s+|\s+$", F.lit("")), F.lit(""))


def _folds() -> tuple[str, str]:
    """Accented Latin letters and the plain letters under them."""
    source, target = "đ", "d"
    for block in (range(0xC0, 0x250), range(0x1E00, 0x1F00)):
        for point in block:
            letter = chr(point).lower()
            plain = "".join(x for x in unicodedata.normalize("NFKD", letter) if not unicodedata.combining(x))
            if len(letter) == 1 and letter not in source and len(plain) == 1 and plain.isascii():
                source, target = source + letter, target + plain
    return source, target


_FROM, _TO = _folds()


def fold(c: Column) -> Column:
    """Lower case without accents, composed or combining."""
    return F.translate(F.regexp_replace(F.lower(clean(c)), r"\p{M}+", ""), _FROM, _TO)


def status(c: Column) -> Column:
    """active, inactive or unknown."""
    plain = fold(c)
    return F.when(plain.isin("active", "hoat dong"), "active").when(plain.isin("inactive", "vo hieu hoa"), "inactive").otherwise("unknown")


def unit(c: Column) -> Column:
    return F.upper(clean(c))


def base_sku_parts(c: Column) -> dict[str, Column]:
    """What a base code's groups tell: their number, the first four, tile size, and whether they are well formed."""
    groups = F.split(c, r"\.")
    number = lambda x: F.coalesce(x.rlike(r"(?U)^\d+$"), F.lit(False))
    g = [F.get(groups, i) for i in range(4)]
    count = F.when(c.isNull(), 0).otherwise(F.size(groups))
    return {
        "base_group_count": count,
        **{f"base_group{i + 1}": x for i, x in enumerate(g)},
        "tile_size_code": g[2],
        "structure_valid": (count == 4) & number(g[0]) & number(g[2]),
        "is_l1": F.coalesce(g[1] == "L1", F.lit(False)),
    }


def channel_relation(sku_channel: Column, branch_brand: Column) -> Column:
    """How a code's channel and a branch's brand agree."""
    channel, brand = F.upper(clean(sku_channel)), F.upper(clean(branch_brand))
    parts = F.transform(F.split(channel, r"\+"), lambda x: F.trim(x))
    return (
        F.when(channel.isNull() | brand.isNull(), "UNKNOWN")
        .when(channel == brand, "EXACT_MATCH")
        .when(channel == "BAN CHUNG", "COMMON")
        .when(channel == "HANG CT", "PROJECT")
        .when(channel.contains("+") & F.array_contains(parts, brand), "COMBO_MATCH")
        .otherwise("CROSS_CHANNEL")
    )


def observation_status(positive: Column, zero: Column, negative: Column) -> Column:
    """Which signs were observed."""
    return (
        F.when(positive & zero & negative, "MIXED_ALL")
        .when(positive & negative, "MIXED_POSITIVE_NEGATIVE")
        .when(positive & zero, "MIXED_ZERO_POSITIVE")
        .when(zero & negative, "MIXED_ZERO_NEGATIVE")
        .when(positive, "POSITIVE_ONLY")
        .when(negative, "NEGATIVE_ONLY")
        .when(zero, "EXPLICIT_ZERO_ONLY")
        .otherwise("NO_SIGNAL")
    )

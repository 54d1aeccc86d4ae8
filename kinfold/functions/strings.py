"""Text cleaning, dates and string distances."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Without one outer quote at each end; /, .-, . and ' set apart by spaces; lower case."""
    out = F.regexp_replace(F.regexp_replace(text, r'^"', ""), r'"\z', "")
    for a, b in (("/", " / "), (".-", " .- "), (".", " . "), ("'", " ' ")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.lower(out)


def sentences(text: Column) -> Column:
    """Sentences by their end marks before a space."""
    return F.filter(F.split(text, r"(?<=[.!?])\s+"), lambda s: s != "")


def iso_date(text: Column) -> Column:
    """yyyyMMdd as a date, null if it isn't one."""
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def date_in_path(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, r"([0-9]{8})", 1), F.lit(""))


def jaro(a: str, b: str) -> float:
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, left = [False] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    if not left:
        return 0.0
    right = [c for c, u in zip(b, used, strict=True) if u]
    m, swaps = len(left), sum(x != y for x, y in zip(left, right, strict=True)) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    s = jaro(a, b)
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4], strict=False)) if x != y), min(4, len(a), len(b)))
    return s + prefix * 0.1 * (1 - s) if s > 0.7 else s


def _paired(f):
    @F.pandas_udf("double")
    def apply(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return apply


def jaro_similarity(a: Column, b: Column) -> Column:
    return _paired(jaro)(a, b)


def jaro_winkler_similarity(a: Column, b: Column) -> Column:
    return _paired(jaro_winkler)(a, b)


def token_set_ratio(a: Column, b: Column) -> Column:
    """Shared tokens over the tokens of the smaller set: 1 if one name's tokens hold the other's."""
    x, y = (F.array_distinct(F.filter(F.split(F.lower(c), r"\s+"), lambda t: t != "")) for c in (a, b))
    return F.size(F.array_intersect(x, y)) / F.greatest(F.least(F.size(x), F.size(y)), F.lit(1))

"""Dimension enrichment (J1, P8-P11): facts LEFT OUTER JOIN dimension, broadcast when proven small."""

from __future__ import annotations

from collections import OrderedDict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.skew import hot_keys, left_join
from tidemark.operators.sizing import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast, measure
from tidemark.schemas import DIMENSION_KEY, ENRICHED_PREFIX, enriched_name
from tidemark.sources.fs import file_versions

_KEY = "__dim_key"


class DuplicateDimensionKey(ValueError):
    """The dimension has two rows for one key; a left join would duplicate facts."""


def prepare_dimension(dim: DataFrame, key: str = DIMENSION_KEY, prefix: str = ENRICHED_PREFIX,
                      widen: bool = True, columns: list[str] | None = None) -> DataFrame:
    """Key column plus measures renamed ``<prefix><normalised name>``; integers widened to bigint."""
    names = columns if columns is not None else [c for c in dim.columns if c != key]
    out = [F.col(f"`{key}`").alias(_KEY)]
    for c in names:
        col = F.col(f"`{c}`")
        if widen and isinstance(dim.schema[c].dataType, T.IntegralType):
            col = col.cast("bigint")
        out.append(col.alias(enriched_name(c, prefix)))
    return dim.select(*out)


_SIZES: OrderedDict[tuple, object] = OrderedDict()
_SIZES_KEPT = 32  # dimension versions remembered (a long-running driver sees a few)
_FILES_KEPT = 64  # files of a dimension whose measures are remembered


def _measured(right: DataFrame, max_rows: int, check_keys: bool):
    """Size (and key uniqueness) of the prepared dimension, measured once per dimension version.

    The cache key is the plan's semantic hash plus name, length and time of the
    files it reads, so an overwritten dimension is measured again, also under the
    same names; an hourly pipeline does not pay a job per batch for an unchanged
    dimension. A dimension of many files is measured every time.
    """
    key = None
    files = right.inputFiles()
    if 0 < len(files) <= _FILES_KEPT:
        key = (right.semanticHash(), file_versions(right.sparkSession, sorted(files)), max_rows, check_keys)
    if key is not None and key in _SIZES:
        _SIZES.move_to_end(key)
        return _SIZES[key]
    size = measure(right, max_rows, key=_KEY if check_keys else None)
    if key is not None:
        _SIZES[key] = size
        while len(_SIZES) > _SIZES_KEPT:
            _SIZES.popitem(last=False)
    return size


def enrich(facts: DataFrame, dim: DataFrame, fact_key: str = "state", dim_key: str = DIMENSION_KEY,
           prefix: str = ENRICHED_PREFIX, columns: list[str] | None = None,
           max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, max_bytes: int | None = None,
           on_duplicate: str = "error") -> DataFrame:
    """Every fact row once, with the dimension measures or NULLs (unknown, NULL or
    differently-cased keys do not match).

    The dimension is broadcast only after ``measure`` proved it under
    ``max_rows`` and ``max_bytes`` (default: the session's broadcast threshold,
    or 50 MB if that is off). Otherwise it is a shuffle join, in which the facts of
    hot keys stay where they are and meet the few dimension rows of those keys by broadcast.
    """
    if max_bytes is None:
        from tidemark.session import broadcast_threshold

        max_bytes = broadcast_threshold(facts.sparkSession) or 50 * 1024 * 1024
    right = prepare_dimension(dim, dim_key, prefix, columns=columns)
    size = _measured(right, max_rows, on_duplicate == "error")
    if size.duplicate_keys:  # at any size: the join strategy must not change the answer
        raise DuplicateDimensionKey(f"dimension key {dim_key!r} is not unique")
    if fits_broadcast(size, max_bytes):
        return facts.join(F.broadcast(right), facts[fact_key] == right[_KEY], "left").drop(_KEY)
    if on_duplicate != "error":  # keys that may repeat are not proven few
        return facts.join(right, facts[fact_key] == right[_KEY], "left").drop(_KEY)
    return left_join(facts, fact_key, right, _KEY, hot_keys(facts, [fact_key])).drop(_KEY)

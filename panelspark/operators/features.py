"""Row-wise features of a return panel.

Each function adds its columns in a handful of projections over one array column; there is no
shuffle and no Python worker.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from panelspark.functions import series as S
from panelspark.schema import coerce_numeric, quoted, replace_columns, return_columns

# Feature sets, rolling windows, lags and volatility windows.
FEATURE_SETS = ("basic_stats", "technical")
WINDOWS = (5, 10, 20)
MOMENTUM_LAGS = (5, 10)
VOLATILITY_WINDOWS = (10, 20, 30)

_ROW, _SEEN, _UP, _DOWN, _MEAN, _AT = "__row", "__seen", "__up", "__down", "__mean", "__at"
_SCRATCH = (_ROW, _SEEN, _UP, _DOWN, _MEAN, _AT)


def with_expressions(df: DataFrame, new: Mapping[str, str]) -> DataFrame:
    """Add columns given as SQL text, in one projection."""
    kept = [quoted(c) for c in df.columns if c not in new]
    return df.selectExpr(*kept, *[f"{v} AS {quoted(k)}" for k, v in new.items()])


def _with_row(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return with_expressions(with_expressions(df, {_ROW: S.pack_sql(columns)}), {_SEEN: S.present(_ROW)})


def add_features(df: DataFrame, feature_sets: Sequence[str] | None = None) -> DataFrame:
    """Add the ``basic_stats`` and/or ``technical`` columns (both when not given)."""
    columns = return_columns(df)
    wanted = FEATURE_SETS if feature_sets is None else feature_sets
    if not columns:
        return df
    out = _with_row(coerce_numeric(df, columns), columns)
    features: dict[str, str] = {}
    if "basic_stats" in wanted:
        out = with_expressions(
            out,
            {
                _UP: f"filter({_SEEN}, x -> x > 0)",
                _DOWN: f"filter({_SEEN}, x -> x < 0)",
                _MEAN: S.mean(_SEEN),
            },
        )
        features |= _basic()
    if "technical" in wanted:
        features |= _technical(len(columns))
    kept = [quoted(c) for c in out.columns if c not in _SCRATCH and c not in features]
    return out.selectExpr(*kept, *[f"{v} AS {k}" for k, v in features.items()])


def _basic() -> dict[str, str]:
    return {
        "r_mean": _MEAN,
        "r_std": S.spread(_SEEN, _MEAN),
        "r_min": f"array_min({_SEEN})",
        "r_max": f"array_max({_SEEN})",
        "r_sum": S.total(_SEEN),
        "r_pos_count": f"size({_UP})",
        "r_neg_count": f"size({_DOWN})",
        "r_zero_count": f"size({_SEEN}) - size({_UP}) - size({_DOWN})",
        "r_pos_sum": S.total(_UP),
        "r_neg_sum": S.total(_DOWN),
    }


def _technical(n: int) -> dict[str, str]:
    features = {}
    for w in WINDOWS:
        if w < n:
            last = S.tail(_ROW, w)
            features[f"r_roll_mean_{w}"] = S.if_complete(last, "v", f"{S.total('v')} / {w}")
            features[f"r_roll_std_{w}"] = S.if_complete(last, "v", S.spread("v", f"{S.total('v')} / {w}"))
    if n > max(MOMENTUM_LAGS):
        for lag in MOMENTUM_LAGS:
            features[f"r_momentum_{lag}"] = S.last_lag_difference(_ROW, lag)
    return features


def add_financial_features(df: DataFrame) -> DataFrame:
    """Add volatility, Sharpe-like ratio, momentum, trend slope and sign ratios; missing results are 0."""
    columns = return_columns(df)
    n = len(columns)
    if not n:
        return df
    features = {}
    for w in VOLATILITY_WINDOWS:
        if n >= w:
            features[f"volatility_{w}"] = S.std(S.present(S.head(_ROW, w)))
    if n >= 20:
        ratio = S.let("m", S.mean("v"), f"m / ({S.spread('v', 'm')} + 1e-8D)")
        features["sharpe_ratio"] = S.let("v", S.present(S.head(_ROW, 20)), ratio)
    if n >= 40:
        recent, old = S.present(f"slice({_ROW}, 31, 10)"), S.present(f"slice({_ROW}, 11, 10)")
        features["momentum"] = f"{S.mean(recent)} - {S.mean(old)}"
    if n >= 30:
        features["trend_slope"] = S.slope(S.head(_ROW, 30))
    features["pos_ratio"] = f"size(filter({_ROW}, x -> x > 0)) / {n}"
    features["neg_ratio"] = f"size(filter({_ROW}, x -> x < 0)) / {n}"
    packed = with_expressions(df, {_ROW: S.pack_sql(columns)})
    return with_expressions(packed, {k: f"coalesce({v}, 0D)" for k, v in features.items()}).drop(_ROW)


# The names, in the order in which the selections below return them.
FINANCIAL_FEATURES = (
    "pos_ratio",
    "neg_ratio",
    "momentum",
    "sharpe_ratio",
    "volatility_20",
    "volatility_30",
    "volatility_10",
    "trend_slope",
)


def select_returns_and_financial(df: DataFrame) -> DataFrame:
    """Returns plus the financial features that are there; identifiers are left out."""
    return df.select(*return_columns(df), *[c for c in FINANCIAL_FEATURES if c in df.columns])


def select_optimised(df: DataFrame) -> DataFrame:
    """Compute the financial features, then keep only them and the returns."""
    return select_returns_and_financial(add_financial_features(df))


def normalise_rows(df: DataFrame) -> DataFrame:
    """Each row's returns minus their mean over their deviation (+1e-8); missing becomes 0."""
    columns = return_columns(df)
    if not columns:
        return df
    out = with_expressions(_with_row(df, columns), {_MEAN: S.mean(_SEEN)})
    out = with_expressions(out, {_ROW: S.normalise(_ROW, _MEAN, S.spread(_SEEN, _MEAN))})
    return replace_columns(out, S.unpack(_ROW, columns), _SCRATCH)


def normalise_rows_plain(df: DataFrame) -> DataFrame:
    """Same without the epsilon, after zero filling; a constant row becomes missing."""
    columns = return_columns(df)
    out = with_plain_row(df, columns, _ROW)
    return replace_columns(out, S.unpack(_ROW, columns), _SCRATCH)


def with_plain_row(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Add the row of :func:`normalise_rows_plain` as an array."""
    out = with_expressions(df, {name: S.zero_filled(S.pack_sql(columns))})
    out = with_expressions(out, {_MEAN: S.mean(name)})
    return with_expressions(out, {name: S.normalise_plain(name, _MEAN, S.spread(name, _MEAN))}).drop(_MEAN)


def fill_rows(df: DataFrame, method: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Fill gaps along each row. ``method``: see :data:`panelspark.functions.series.FILLS`."""
    if method not in S.FILLS:
        raise ValueError(f"unknown fill {method!r}, expected one of {sorted(S.FILLS)}")
    columns = return_columns(df) if columns is None else list(columns)
    out = with_expressions(df, {_ROW: S.pack_sql(columns)})
    out = with_expressions(out, {_AT: S.observed_positions(_ROW)})
    out = with_expressions(out, {_ROW: S.FILLS[method](_ROW, _AT)})
    return replace_columns(out, S.unpack(_ROW, columns), _SCRATCH)


def add_null_profile(df: DataFrame) -> DataFrame:
    """Missing returns per row, as a count and in percent."""
    columns = return_columns(df)
    counted = with_expressions(df, {"null_count": S.null_count(S.pack_sql(columns))})
    return with_expressions(counted, {"null_percent": f"null_count * 100D / {len(columns)}"})


def add_price_path(df: DataFrame, name: str = "path") -> DataFrame:
    """Running sum of the zero-filled returns, as an array."""
    columns = return_columns(df)
    return with_expressions(df, {name: S.cumulative(S.zero_filled(S.pack_sql(columns)), len(columns))})


def add_lead_lag(df: DataFrame, name: str = "lead_lag") -> DataFrame:
    columns = return_columns(df)
    return with_expressions(add_price_path(df, "__path"), {name: S.lead_lag("__path", len(columns))}).drop("__path")


def add_signature(df: DataFrame) -> DataFrame:
    """Depth-2 path signature of the lead-lag price path and the number of gaps."""
    columns = return_columns(df)
    packed = with_expressions(df, {_ROW: S.pack_sql(columns)})
    zeros = with_expressions(packed, {"null_count": S.null_count(_ROW), _ROW: S.zero_filled(_ROW)})
    return with_expressions(zeros, S.signature_depth2(_ROW, len(columns))).drop(_ROW)

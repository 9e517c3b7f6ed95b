"""SQL expressions over one row's series, held as ARRAY<DOUBLE> with NULL for a missing value.

All of these work inside a row, so they never shuffle, push no data to Python and can be
used on batch and on streaming DataFrames alike. Arguments and results are SQL text: a feature
is a few dozen function nodes, and one parse of a text is far cheaper than a JVM call per node.
Arguments called ``v`` must be free of NULL (see :func:`present`); ``r`` and ``at`` must be
column or lambda variable names wherever they are used inside a lambda.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.schema import number_sql, quoted

NULL = "CAST(NULL AS DOUBLE)"


def pack_sql(columns: Sequence[str]) -> str:
    return f"array({', '.join(number_sql(c) for c in columns)})"


def pack(columns: Sequence[str]) -> Column:
    """Wide columns as one array."""
    return F.expr(pack_sql(columns))


def unpack(array_name: str, columns: Sequence[str]) -> dict[str, str]:
    """Expressions that take an array column apart, by the name of the wide column."""
    return {c: f"get({quoted(array_name)}, {i})" for i, c in enumerate(columns)}


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, computed once per row.

    A lambda recomputes every expression it captures for each element, and the optimizer may
    inline an earlier projection into it; a lambda variable is computed once.
    """
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def present(r: str) -> str:
    return f"filter({r}, x -> x IS NOT NULL)"


def null_count(r: str) -> str:
    return f"size(filter({r}, x -> x IS NULL))"


def total(v: str) -> str:
    """Sum; 0.0 for an empty array."""
    return f"aggregate({v}, 0D, (acc, x) -> acc + x)"


def squares(v: str) -> str:
    return f"aggregate({v}, 0D, (acc, x) -> acc + x * x)"


def mean(v: str) -> str:
    return let("w", v, f"if(size(w) > 0, {total('w')} / size(w), NULL)")


def spread(v: str, centre: str) -> str:
    """Sample standard deviation about ``centre``, NULL under two values. Two passes, for accuracy."""
    about = "aggregate({v}, 0D, (acc, x) -> acc + (x - c) * (x - c))".format(v=v)
    return f"if(size({v}) > 1, sqrt({let('c', centre, about)} / (size({v}) - 1)), NULL)"


def std(v: str) -> str:
    return let("u", v, spread("u", mean("u")))


def head(r: str, w: int) -> str:
    return f"slice({r}, 1, {w})"


def tail(r: str, w: int) -> str:
    return f"slice({r}, -{w}, {w})"


def if_complete(window: str, name: str, value: str) -> str:
    """``value``, an expression over ``name``, only if no entry of ``window`` is missing."""
    return let(name, window, f"if({null_count(name)} = 0, {value}, NULL)")


def last_lag_difference(r: str, lag: int) -> str:
    """Last entry minus the entry ``lag`` places before it."""
    return f"try_element_at({r}, -1) - try_element_at({r}, {-1 - lag})"


def observed_positions(r: str) -> str:
    """0-based positions that hold a value."""
    return f"filter(transform({r}, (x, i) -> if(x IS NOT NULL, i, NULL)), i -> i IS NOT NULL)"


def slope(r: str) -> str:
    """Least-squares slope over positions 0, 1, ...; missing entries are left out; NULL under two points."""
    n, sx, sxx = "size(at)", "aggregate(at, 0D, (acc, i) -> acc + i)", "aggregate(at, 0D, (acc, i) -> acc + i * i)"
    sxy = "aggregate(at, 0D, (acc, i) -> acc + i * get(row, i))"
    sy = total(present("row"))
    line = f"if({n} > 1, ({n} * {sxy} - {sx} * {sy}) / ({n} * {sxx} - {sx} * {sx}), NULL)"
    return let("row", r, let("at", observed_positions("row"), line))


# --- gaps -----------------------------------------------------------------------------------
#
# The observed positions cut a row into runs. Every fill below builds its result run by run
# (array_repeat / sequence, then flatten), which is linear in the row length; looking back
# from each gap or growing an array inside `aggregate` would be quadratic.


def _between(r: str, at: str, run: str) -> str:
    """Values from the first observed position on; ``run`` gives the array for positions [a, b)."""
    return f"flatten(zip_with({at}, concat(slice({at}, 2, size({at})), array(size({r}))), (a, b) -> {run}))"


def _with_gaps(r: str, at: str, filled: str) -> str:
    return f"if(size({at}) = 0 OR size({at}) = size({r}), {r}, {filled})"


def first_value(r: str, at: str) -> str:
    return f"get({r}, get({at}, 0))"


def last_value(r: str, at: str) -> str:
    return f"get({r}, try_element_at({at}, -1))"


def forward_fill(r: str, at: str, lead: str = NULL) -> str:
    """Last value seen so far; before the first one ``lead``."""
    body = _between(r, at, f"array_repeat(get({r}, a), b - a)")
    return _with_gaps(r, at, f"concat(array_repeat({lead}, get({at}, 0)), {body})")


def backward_fill(r: str, at: str, trail: str = NULL) -> str:
    """Next value to come; after the last one ``trail``."""
    starts = f"concat(array(-1), slice({at}, 1, size({at}) - 1))"
    body = f"flatten(zip_with({starts}, {at}, (a, b) -> array_repeat(get({r}, b), b - a)))"
    return _with_gaps(r, at, f"concat({body}, array_repeat({trail}, size({r}) - 1 - try_element_at({at}, -1)))")


def forward_then_backward(r: str, at: str) -> str:
    return forward_fill(r, at, first_value(r, at))


def backward_then_forward(r: str, at: str) -> str:
    return backward_fill(r, at, last_value(r, at))


def interpolate(r: str, at: str) -> str:
    """Straight line over inner gaps; outer gaps take the nearest value."""
    step = f"if(b < size({r}), (get({r}, b) - get({r}, a)) / (b - a), 0D)"
    run = let("by", step, f"transform(sequence(0, b - a - 1), j -> get({r}, a) + by * j)")
    lead = f"array_repeat({first_value(r, at)}, get({at}, 0))"
    return _with_gaps(r, at, f"concat({lead}, {_between(r, at, run)})")


FILLS = {
    "ffill": forward_fill,
    "bfill": backward_fill,
    "ffill_then_bfill": forward_then_backward,
    "bfill_then_ffill": backward_then_forward,
    "linear": interpolate,
}


# --- normalisation and paths -----------------------------------------------------------------


def normalise(r: str, centre: str, scale: str, eps: str = "1e-8D") -> str:
    """(x - centre) / (scale + eps) with missing results as 0."""
    each = f"transform({r}, x -> coalesce((x - mid) / by, 0D))"
    return let("mid", centre, let("by", f"{scale} + {eps}", each))


def normalise_plain(r: str, centre: str, scale: str) -> str:
    """(x - centre) / scale, missing where the scale is 0."""
    return let("mid", centre, let("by", scale, f"transform({r}, x -> try_divide(x - mid, by))"))


def zero_filled(r: str) -> str:
    return f"transform({r}, x -> coalesce(x, 0D))"


def cumulative(x: str, n: int) -> str:
    """Running sum of a gap-free array of known length.

    Adds the array to itself shifted by 1, 2, 4, ... places: log2(n) element-wise passes instead
    of one growing sum per entry.
    """
    out, shift = x, 1
    while shift < n:
        moved = f"concat(array_repeat(0D, {shift}), slice(p, 1, {n - shift}))"
        out = let("p", out, f"zip_with(p, {moved}, (a, b) -> a + b)")
        shift *= 2
    return out


def lead_lag(p: str, n: int) -> str:
    """Pairs (next value, value) along a path of ``n`` points."""
    return f"zip_with(slice({p}, 2, {n - 1}), slice({p}, 1, {n - 1}), (a, b) -> named_struct('x', a, 'y', b))"


def signature_depth2(x: str, n: int) -> dict[str, str]:
    """Depth-2 signature of the lead-lag path of the running sum of ``x``.

    The path moves by (x[t+2], x[t+1]), so each term is a plain sum over ``x``: with
    a, q = sum and sum of squares of x[2..n-2] and c = sum of neighbouring products of x[1..n-1],
    S(1,2) = (a*a + q + c) / 2, S(i,i) = S(i)^2 / 2 and S(2,1) = S(1) * S(2) - S(1,2).
    """
    first, second = total(f"slice({x}, 3, {n - 2})"), total(f"slice({x}, 2, {n - 2})")
    inner = f"slice({x}, 3, {n - 3})"
    products = f"zip_with(slice({x}, 2, {n - 2}), slice({x}, 3, {n - 2}), (u, v) -> u * v)"
    cross = f"({let('a', total(inner), 'a * a')} + {squares(inner)} + {total(products)}) / 2"
    return {
        "s1": first,
        "s2": second,
        "s11": let("a", first, "a * a / 2"),
        "s12": cross,
        "s21": f"{first} * {second} - {cross}",
        "s22": let("a", second, "a * a / 2"),
    }

"""Exact selection by histogram refinement: the k-th row of an order without
moving a row.

A target asks for the row at a rank of an order over one or more columns.
The first aggregate finds the ends of the first column.  Each round then is
one aggregate: the rows still in a target's range are counted in ``BINS``
equal steps between the range's ends, with each step's smallest and largest
value; the step that holds the rank is the next range.  Steps are monotone in
the value, so a step's ends are exact values, and the two ends of a range
never share a step: every round leaves fewer distinct values.  When one value
is left, the next column of the order decides among its rows.  A search ends
with a range of at most ``FEW`` rows, whose keys are read and sorted.

What is shuffled are partial counts (at most BINS rows per open range and
task); what reaches the driver is at most BINS + FEW rows per target.  All
targets advance in the same rounds; targets with one range share it.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType, FractionalType, IntegerType, NumericType, StringType,
    TimestampType)

BINS = 1024
FEW = 4096
MAX = 1.7976931348623157e308  # the largest double


@dataclass(frozen=True)
class Key:
    """One column of an order."""

    column: str
    descending: bool = False
    nulls_first: bool = False


@dataclass
class _Search:
    keys: Sequence[Key]
    rank: int | Callable[[int], int]  # 1-based, among the rows still in the range
    scope: Column | None
    fixed: list = field(default_factory=list)  # values found for the first keys
    low: object = None  # ends of the range of the current key, once known
    high: object = None
    rows: int | None = None  # in the range, once known
    found: tuple | None = None
    done: bool = False

    def range(self) -> tuple:
        return id(self.scope), tuple(self.keys[:len(self.fixed) + 1]), tuple(self.fixed), self.low, self.high


def _literal(value, kind: DataType) -> Column:
    return F.lit(value).cast(kind)


def _step(value: Column, low, high, kind: DataType) -> Column:
    """A number that grows with the value: 0 at ``low``, BINS - 1 at ``high``."""
    if isinstance(kind, StringType):
        # the five bytes after the common prefix, as digits (0: no byte there)
        a, b = low.encode(), high.encode()
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        raw = F.encode(value, "utf-8")

        def digits(byte) -> list:
            return [byte(same + i) * 257 ** (4 - i) for i in range(5)]

        def number(text: bytes) -> int:
            return sum(digits(lambda i: text[i] + 1 if i < len(text) else 0))

        def at(i: int) -> Column:
            byte = F.conv(F.hex(F.substring(raw, i + 1, 1)), 16, 10).cast("double")
            return F.when(F.octet_length(raw) > i, byte + 1).otherwise(F.lit(0.0))

        position, span = sum(digits(at), F.lit(0.0)) - float(number(a)), F.lit(float(number(b) - number(a)))
    else:
        first, last = _literal(low, kind), _literal(high, kind)
        if isinstance(kind, DecimalType):  # exact differences: close decimals stay apart
            position, span = (value - first).cast("double"), (last - first).cast("double")
        else:
            def number(c: Column) -> Column:
                if isinstance(kind, TimestampType):
                    return F.unix_micros(c)
                if isinstance(kind, DateType):
                    return F.datediff(c, F.lit("1970-01-01")).cast("long")
                return c.cast("int").cast("long") if isinstance(kind, BooleanType) else c

            value_, first_, last_ = number(value), number(first), number(last)
            # halves of doubles do not overflow; longs that are close are subtracted exactly
            def half(c: Column) -> Column:
                d = c.cast("double")
                return F.greatest(F.least(d, F.lit(MAX)), F.lit(-MAX)) / 2

            position, span = half(value_) - half(first_), half(last_) - half(first_)
            if not isinstance(kind, FractionalType):
                near = F.abs(span) < float(1 << 52)
                exact = F.try_subtract(value_.cast("long"), first_.cast("long")).cast("double")
                wide = F.try_subtract(last_.cast("long"), first_.cast("long")).cast("double")
                position, span = F.when(near, exact).otherwise(position), F.when(near, wide).otherwise(span)
    ends = F.when(value == _literal(low, kind), F.lit(0)).when(value == _literal(high, kind), F.lit(BINS - 1))
    share = F.coalesce(F.try_divide(position, span), F.lit(0.0))
    return ends.otherwise(F.floor(F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0)) * (BINS - 1)).cast("int"))


def _inside(s: _Search, kinds: dict[str, DataType]) -> Column:
    """Rows of a search's range."""
    out = F.lit(True) if s.scope is None else s.scope
    for key, value in zip(s.keys, s.fixed):
        out = out & (F.col(key.column).isNull() if value is None else F.col(key.column) == _literal(value, kinds[key.column]))
    if s.low is not None:
        c, kind = F.col(s.keys[len(s.fixed)].column), kinds[s.keys[len(s.fixed)].column]
        out = out & c.between(_literal(s.low, kind), _literal(s.high, kind))
    return out


def _descend(s: _Search, bins: list[tuple[int, object, object, int]], nulls: int) -> None:
    """Take the step that holds the rank; fix the key when one value is left."""
    key = s.keys[len(s.fixed)]
    steps = sorted(bins, key=lambda b: b[0], reverse=key.descending)
    if nulls:
        steps.insert(0 if key.nulls_first else len(steps), (None, None, None, nulls))
    for _, low, high, s.rows in steps:
        if s.rank <= s.rows:
            break
        s.rank -= s.rows
    if low == high or (low != low and high != high):
        s.fixed.append(low)
        s.low = s.high = None
        if len(s.fixed) == len(s.keys):
            s.found, s.done = tuple(s.fixed), True
    else:
        s.low, s.high = low, high


def _grouped(searches: Sequence[_Search]) -> list[list[_Search]]:
    groups: dict[tuple, list[_Search]] = {}
    for s in searches:
        groups.setdefault(s.range(), []).append(s)
    return list(groups.values())


def rows_at(df: DataFrame, targets: Sequence[tuple[Sequence[Key], int | Callable[[int], int]]],
            scopes: Sequence[Column | None] | None = None) -> list[tuple | None]:
    """For each target (keys, rank), the values of the keys in the row at that
    1-based rank of the order; None beyond the last row.  A rank may be a
    function of the number of rows.  ``scopes`` limits a target to rows for
    which a condition holds."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    for keys, _ in targets:
        for k in keys:
            if not isinstance(kinds[k.column], (NumericType, StringType, DateType, TimestampType, BooleanType)):
                raise TypeError(f"no order for {kinds[k.column].simpleString()}")
    searches = [_Search(keys, rank, scope) for (keys, rank), scope in zip(targets, scopes or [None] * len(targets))]
    while open_ := [s for s in searches if not s.done]:
        few = [s for s in open_ if s.rows is not None and s.rows <= FEW]
        if few:
            _read(df, _grouped(few), kinds)
        elif any(s.low is None for s in open_):
            _ends(df, _grouped([s for s in open_ if s.low is None]), kinds)
        else:
            _counts(df, _grouped(open_), kinds)
    return [s.found for s in searches]


def _ends(df: DataFrame, groups: list[list[_Search]], kinds: dict[str, DataType]) -> None:
    """Ends of the ranges that have none yet, in one aggregate."""
    aggs = []
    for i, g in enumerate(groups):
        s = g[0]
        inside, c = _inside(s, kinds), F.col(s.keys[len(s.fixed)].column)
        odd = F.isnan(c) if isinstance(kinds[s.keys[len(s.fixed)].column], (DoubleType, FloatType)) else F.lit(False)
        held = F.when(inside & ~odd, c)
        aggs += [F.min(held).alias(f"low{i}"), F.max(held).alias(f"high{i}"), F.count(held).alias(f"n{i}"),
                 F.count_if(inside & odd).alias(f"nans{i}"), F.count_if(inside & c.isNull()).alias(f"nulls{i}")]
    r = df.agg(*aggs).first()
    for i, g in enumerate(groups):
        n, nans, nulls = r[f"n{i}"], r[f"nans{i}"], r[f"nulls{i}"]
        steps = [(0, r[f"low{i}"], r[f"high{i}"], n)] if n else []
        if nans:  # NaN stands above every number
            steps.append((1, float("nan"), float("nan"), nans))
        for s in g:
            if callable(s.rank):
                s.rank = s.rank(n + nans + nulls)
            if 1 <= s.rank <= n + nans + nulls:
                _descend(s, steps, nulls)
            else:
                s.done = True


def _marked(df: DataFrame, groups: list[list[_Search]], kinds: dict[str, DataType], values: Callable[[_Search], dict[str, Column]],
            names: Sequence[str]) -> DataFrame:
    """A row per row and range that holds it: the range's number ``range`` and
    the columns ``values`` names for it (of ``names``; null otherwise)."""
    places = []
    for i, g in enumerate(groups):
        own = values(g[0])
        places.append(F.when(_inside(g[0], kinds), F.struct(F.lit(i).alias("range"), *[
            own.get(n, F.lit(None).cast(kinds.get(n, IntegerType()))).alias(f"c{j}") for j, n in enumerate(names)])))
    return df.select(F.inline(F.array_compact(F.array(*places))))


def _counts(df: DataFrame, groups: list[list[_Search]], kinds: dict[str, DataType]) -> None:
    """One round: every open range counted in steps, in one aggregate."""
    columns = sorted({g[0].keys[len(g[0].fixed)].column for g in groups})

    def own(s: _Search) -> dict[str, Column]:
        column = s.keys[len(s.fixed)].column
        return {column: F.col(column), "": _step(F.col(column), s.low, s.high, kinds[column])}

    rows = _marked(df, groups, kinds, own, ["", *columns])
    ends = [f(f"c{j + 1}").alias(f"{name}{j}") for j in range(len(columns)) for name, f in (("low", F.min), ("high", F.max))]
    found: dict[int, list] = {}
    for r in rows.groupBy("range", "c0").agg(F.count(F.lit(1)).alias("n"), *ends).collect():
        g = groups[r["range"]][0]
        j = columns.index(g.keys[len(g.fixed)].column)
        found.setdefault(r["range"], []).append((r["c0"], r[f"low{j}"], r[f"high{j}"], r["n"]))
    for i, g in enumerate(groups):
        for s in g:
            _descend(s, found[i], 0)


def _read(df: DataFrame, groups: list[list[_Search]], kinds: dict[str, DataType]) -> None:
    """The keys of ranges of at most FEW rows, sorted here."""
    columns = sorted({k.column for g in groups for s in g for k in s.keys})
    rows = _marked(df, groups, kinds, lambda s: {c: F.col(c) for c in columns}, columns)
    held: dict[int, list] = {}
    for r in rows.collect():
        held.setdefault(r["range"], []).append(r[1:])
    for i, g in enumerate(groups):
        for s in g:
            at = [columns.index(k.column) for k in s.keys]
            order = functools.cmp_to_key(functools.partial(_compare, s.keys))
            s.found = sorted((tuple(r[j] for j in at) for r in held[i]), key=order)[s.rank - 1]
            s.done = True


def _compare(keys: Sequence[Key], x: Sequence, y: Sequence) -> int:
    """Spark's order of two rows' keys: strings by bytes, NaN above numbers."""
    for k, a, b in zip(keys, x, y):
        if a is None or b is None:
            if a is not b:
                return -1 if (a is None) == k.nulls_first else 1
            continue
        if isinstance(a, str):
            a, b = a.encode(), b.encode()
        elif isinstance(a, float):
            a, b = (a != a, 0.0 if a != a else a), (b != b, 0.0 if b != b else b)
        if a != b:
            return -1 if (a < b) != k.descending else 1
    return 0


def is_after(keys: Sequence[Key], row: Sequence, kinds: dict[str, DataType]) -> Column:
    """Whether a row stands after ``row`` in the order of ``keys``."""
    out = F.lit(False)
    for key, value in reversed(list(zip(keys, row))):
        c = F.col(key.column)
        if value is None:
            after = c.isNotNull() if key.nulls_first else F.lit(False)
            same = c.isNull()
        else:
            v = _literal(value, kinds[key.column])
            after = F.coalesce(c < v if key.descending else c > v, F.lit(not key.nulls_first))
            same = F.coalesce(c == v, F.lit(False))
        out = after | (same & out)
    return out


def ntiles(df: DataFrame, buckets: int, orders: dict[str, Sequence[Key]]) -> DataFrame:
    """``ntile(buckets) over (order by <keys>)`` for each named order, from
    the ``buckets - 1`` cut rows of each.  The orders must be total."""
    def last(b: int) -> Callable[[int], int]:
        """The last row of bucket b: the first ``n % buckets`` hold one more."""
        return lambda n: b * (n // buckets) + min(b, n % buckets)

    targets = [(keys, last(b)) for keys in orders.values() for b in range(1, buckets)]
    cuts = rows_at(df, targets)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for i, (name, keys) in enumerate(orders.items()):
        bucket = F.lit(1)
        for cut in cuts[i * (buckets - 1):(i + 1) * (buckets - 1)]:
            bucket = bucket + (F.lit(1) if cut is None else is_after(keys, cut, kinds).cast("int"))
        out[name] = bucket.cast("int")
    return df.withColumns(out)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> list[list[float | None]]:
    """Per column, its exact quantiles with linear interpolation (pandas'
    default, ``quantile_cont``) over its non-null values; None without any.
    All columns and probabilities advance in the same rounds."""
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(cols)])
    shares: dict[tuple[int, int], float] = {}

    def place(i: int, j: int, side: int) -> Callable[[int], int]:
        def rank(n: int) -> int:
            h = (n - 1) * float(probs[j])
            low = int(h // 1)
            shares[i, j] = h - low
            return min(low + side, n - 1) + 1
        return rank

    pairs = [(i, j) for i in range(len(cols)) for j in range(len(probs))]
    scopes = [F.col(f"v{i}").isNotNull() for i in range(len(cols))]
    found = rows_at(values, [([Key(f"v{i}")], place(i, j, side)) for i, j in pairs for side in (0, 1)],
                    [scopes[i] for i, _ in pairs for _ in (0, 1)])
    out: list[list[float | None]] = [[] for _ in cols]
    for (i, j), low, high in zip(pairs, found[::2], found[1::2]):
        # weighted form, bit for bit what quantile_cont computes
        t = shares[i, j]
        out[i].append(low[0] * (1 - t) + high[0] * t if low else None)
    return out


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """Exact quantiles of one column, one row (see :func:`column_quantiles`)."""
    names = list(names or [f"q{int(round(p * 100)):02d}" for p in probs])
    row = column_quantiles(df, [col], probs)[0]
    return df.sparkSession.createDataFrame([row], ", ".join(f"`{c}` double" for c in names))

"""Exact quantiles of many columns in two scans, without a global sort.

The first scan counts the values and sketches them; the sketch's error bound gives
a bracket of values for each wanted rank. The second counts exactly what is below
and at the bounds of the brackets, and writes the values strictly inside: a share
of the rows set by the error bound, whatever the data, since a value that fills
more than its bracket is one of the bounds. Those few values are then narrowed by
counting them per bucket, until the distinct ones decide. A rank that is not in its
bracket after all, which the exact counts tell, is searched in the whole column.
"""

import math
import struct
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from vigil.functions import numbers
from vigil.plans import scratch
from vigil.schemas import quoted

SKETCH_K = 4096
MARGIN = 0.0021  # of ranks, each way: three times the sketch's error at 99 % confidence
BUCKETS = 4096  # equal steps of a range
EDGES = 16  # squared: steps between neighbouring doubles, for uneven values
SMALL_RANGE = 20_000


@dataclass
class _Range:
    """Values lo..hi of one column: `below` rows are smaller, `inside` rows in it."""

    column: str
    lo: float
    hi: float
    below: int
    inside: int
    uneven: bool = False  # the last pass left most rows in one bucket

    @property
    def key(self):
        return (self.column, self.lo, self.hi)

    @property
    def settled(self) -> bool:
        return self.lo == self.hi or self.inside <= SMALL_RANGE


def _value(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return numbers.number(quoted(column))
    if isinstance(kind, T.IntegralType):
        return quoted(column).cast("bigint")  # exact beyond 2**53
    value = quoted(column).cast("double")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = F.when(~F.isnan(value), value)
    return value


def _ranks(n: int, p: float, interpolated: bool) -> tuple[int, int, float]:
    """1-based ranks around quantile p and the weight of the upper one."""
    if interpolated:
        position = p * (n - 1)
        low = math.floor(position)
        return low + 1, min(low + 2, n), position - low
    rank = max(1, n - math.floor(n - n * p))
    return rank, rank, 0.0


def _bucket(value: Column, r: _Range) -> Column:
    if isinstance(r.lo, int) and r.hi - r.lo < 2**63:
        step = F.lit((r.hi - r.lo) // BUCKETS + 1).cast("bigint")
        return F.call_function("div", value - F.lit(r.lo).cast("bigint"), step).cast("int")
    if r.uneven:
        return _edge_bucket(value, r)
    # Halved operands keep hi - lo finite over the whole double range.
    width = r.hi / 2 - r.lo / 2
    value = value.cast("double")
    position = F.floor((value / 2 - F.lit(r.lo / 2)) / F.lit(width) * BUCKETS)
    return F.least(position, F.lit(BUCKETS - 1)).cast("int")


def _place(x: float) -> int:
    """Number of a double in the order of all doubles."""
    bits = struct.unpack(">q", struct.pack(">d", x))[0]
    return bits if bits >= 0 else -(bits & (2**63 - 1))


def _double(place: int) -> float:
    x = struct.unpack(">d", struct.pack(">q", abs(place)))[0]
    return x if place >= 0 else -x


def _edge_bucket(value: Column, r: _Range) -> Column:
    """Buckets with equally many doubles each: few passes for any distribution."""
    first, last, parts = _place(r.lo), _place(r.hi), EDGES * EDGES
    edges = [_double(first + (last - first) * k // parts) for k in range(1, parts)]
    coarse = F.size(F.filter(F.lit(edges[EDGES - 1::EDGES]), lambda e: e <= value))
    near = F.slice(F.lit(edges), coarse * EDGES + 1, F.lit(EDGES - 1))
    return coarse * EDGES + F.size(F.filter(near, lambda e: e <= value))


def _narrow(df: DataFrame, ranges: list[_Range]) -> dict[tuple, list]:
    """Row count, min and max per bucket of each range."""
    entries = []
    for i, r in enumerate(ranges):
        value = _value(df, r.column)
        entries.append(F.when(
            value.between(r.lo, r.hi),
            F.struct(F.lit(i).alias("i"), _bucket(value, r).alias("b"), value.alias("v"))))
    counted = (
        df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
        .groupBy("e.i", "e.b")
        .agg(F.count(F.lit(1)).alias("n"), F.min("e.v").alias("lo"), F.max("e.v").alias("hi"))
    )
    found: dict[tuple, list] = {r.key: [] for r in ranges}
    for row in counted.collect():  # at most BUCKETS rows per range
        found[ranges[row.i].key].append((row.b, row.n, row.lo, row.hi))
    return {k: sorted(v) for k, v in found.items()}


def _values_inside(df: DataFrame, ranges: list[_Range]) -> dict[tuple, list]:
    """Distinct values with row counts of ranges known to hold few rows."""
    entries = []
    for i, r in enumerate(ranges):
        value = _value(df, r.column)
        entries.append(F.when(value.between(r.lo, r.hi),
                              F.struct(F.lit(i).alias("i"), value.alias("v"))))
    counted = (
        df.select(F.explode(F.array(*entries)).alias("e")).where("e IS NOT NULL")
        .groupBy("e.i", "e.v").agg(F.count(F.lit(1)).alias("n"))
    )
    found: dict[tuple, list] = {r.key: [] for r in ranges}
    for row in counted.collect():  # at most SMALL_RANGE rows per range
        found[ranges[row.i].key].append((row.v, row.n))
    return {k: sorted(v) for k, v in found.items()}


def _unique(ranges) -> list[_Range]:
    return list({r.key: r for r in ranges}.values())


def _measures(df: DataFrame, columns: list[str]) -> list[Column]:
    """n, lo, hi and sketch of each column."""
    measures = []
    for i, c in enumerate(columns):
        value = _value(df, c)
        whole = isinstance(df.schema[c].dataType, T.IntegralType)
        sketch = F.kll_sketch_agg_bigint if whole else F.kll_sketch_agg_double
        measures += [F.count(value).alias(f"n{i}"), F.min(value).alias(f"lo{i}"), F.max(value).alias(f"hi{i}"),
                     sketch(value, F.lit(SKETCH_K)).alias(f"sketch{i}")]
    return measures


class Look:
    """The first of the two scans, taken by an action over the rows that runs anyway."""

    def __init__(self, df: DataFrame, columns: list[str]):
        self.columns, self.seen = columns, Observation()
        self.df = df.observe(self.seen, *_measures(df, columns)) if columns else df

    def measured(self, spark: SparkSession, columns: list[str]) -> DataFrame:
        """What _measures gives for some of the columns, as one row; after the action."""
        found = self.seen.get
        return spark.range(1).select(*[
            F.lit(bytes(v) if isinstance(v, bytearray) else v).alias(f"{name}{i}")
            for i, c in enumerate(columns) for name in ("n", "lo", "hi", "sketch")
            for v in (found[f"{name}{self.columns.index(c)}"],)])


def quantiles(df: DataFrame, wanted: dict[str, list[float]],
              interpolated: bool = False, look: Look | None = None) -> dict[str, list]:
    """Exact quantiles per column; None for a column without values.

    A look taken over the same rows saves the first scan.

    Discrete quantiles return a value of the column (rank ceil(p * n));
    interpolated ones weigh the two neighbours of position p * (n - 1).
    Nulls, NaN and text that is not a number are ignored.
    """
    columns = [c for c, ps in wanted.items() if ps]
    if not columns:
        return {c: [] for c in wanted}
    narrow = df.select(*[quoted(c) for c in columns])
    row = _first_look(narrow, columns, wanted, look)
    counts = {c: row[f"n{i}"] for i, c in enumerate(columns)}
    targets: dict[tuple[str, int], _Range] = {}
    brackets: dict[tuple[str, int], tuple] = {}
    for i, c in enumerate(columns):
        whole = _Range(c, row[f"lo{i}"], row[f"hi{i}"], 0, counts[c])
        for k, p in enumerate(wanted[c] if counts[c] else []):
            for rank in _ranks(counts[c], p, interpolated)[:2]:
                targets[c, rank] = whole
                brackets[c, rank] = (c, row[f"low{i}"][k], row[f"high{i}"][k])
    answer = {}
    open_ranks = {t: brackets[t] for t, r in targets.items() if not r.settled}
    if open_ranks:
        answer = _inside_brackets(narrow, open_ranks)
    answer |= _search(narrow, {t: r for t, r in targets.items() if t not in answer})

    result: dict[str, list] = {}
    for c in wanted:
        if c not in columns:
            result[c] = []
            continue
        whole_numbers = isinstance(df.schema[c].dataType, T.IntegralType)
        values = []
        for p in wanted[c]:
            if not counts[c]:
                values.append(None)
                continue
            low, high, weight = _ranks(counts[c], p, interpolated)
            v = answer[c, low]
            if weight:
                v = v + (answer[c, high] - v) * weight
            values.append(int(v) if whole_numbers and not interpolated else v)
        result[c] = values
    return result


def _first_look(df: DataFrame, columns: list[str], wanted: dict[str, list[float]], look: Look | None):
    """n, lo and hi of each column, and per quantile values a little below and above it."""
    looked = []
    for i, c in enumerate(columns):
        whole = isinstance(df.schema[c].dataType, T.IntegralType)
        quantile = F.kll_sketch_get_quantile_bigint if whole else F.kll_sketch_get_quantile_double
        looked += [f"n{i}", f"lo{i}", f"hi{i}"]
        for name, shift, end in (("low", -MARGIN, "lo"), ("high", MARGIN, "hi")):
            places = [quantile(f"sketch{i}", F.lit(p + shift)) if 0 <= p + shift <= 1 else F.col(f"{end}{i}")
                      for p in wanted[c]]
            looked.append(F.when(F.col(f"n{i}") > 0, F.array(*places)).alias(f"{name}{i}"))
    measured = look.measured(df.sparkSession, columns) if look else df.agg(*_measures(df, columns))
    return measured.select(*looked).first()


def _inside_brackets(df: DataFrame, ranks: dict[tuple[str, int], tuple]) -> dict[tuple[str, int], float]:
    """Values at those ranks that lie in their bracket (column, low, high)."""
    brackets = list(dict.fromkeys(ranks.values()))
    measures, kept = [], []
    for i, (c, low, high) in enumerate(brackets):
        value = _value(df, c)
        inside = (value > low) & (value < high)
        measures += [F.count_if(value < low).alias(f"below{i}"), F.count_if(value == low).alias(f"low{i}"),
                     F.count_if(inside).alias(f"inside{i}"), F.count_if(value == high).alias(f"high{i}")]
        kept.append(F.when(inside, value).alias(f"v{i}"))
    seen = Observation()
    values = df.observe(seen, *measures).select(*kept)
    with scratch.scope(df.sparkSession):
        values, _ = scratch.materialize(
            values.where(" OR ".join(f"v{i} IS NOT NULL" for i in range(len(brackets)))), "bracketed-values")
        counted = seen.get
        answer, targets = {}, {}
        for (c, rank), bracket in ranks.items():
            i = brackets.index(bracket)
            below, at_low, inside, at_high = (counted[f"{k}{i}"] for k in ("below", "low", "inside", "high"))
            past = rank - below
            if 0 < past <= at_low:
                answer[c, rank] = bracket[1]
            elif 0 < past - at_low <= inside:
                targets[c, rank] = _Range(f"v{i}", bracket[1], bracket[2], below + at_low, inside)
            elif bracket[1] != bracket[2] and 0 < past - at_low - inside <= at_high:
                answer[c, rank] = bracket[2]
        return answer | _search(values, targets)


def _search(df: DataFrame, targets: dict[tuple[str, int], _Range]) -> dict[tuple[str, int], float]:
    """The values at ranks that lie in the given ranges of df."""
    targets = dict(targets)
    while open_ranges := _unique(r for r in targets.values() if not r.settled):
        buckets = _narrow(df, open_ranges)
        for (c, rank), r in targets.items():
            if r.settled:
                continue
            below = r.below
            for _, n, lo, hi in buckets[r.key]:
                if below + n >= rank:
                    targets[c, rank] = _Range(r.column, lo, hi, below, n,
                                              uneven=n > r.inside / 8 and not isinstance(lo, int))
                    break
                below += n

    pending = _unique(r for r in targets.values() if r.lo != r.hi)
    inside = _values_inside(df, pending) if pending else {}
    answer: dict[tuple[str, int], float] = {}
    for (c, rank), r in targets.items():
        answer[c, rank] = r.lo
        below = r.below
        for v, n in inside.get(r.key, []):
            below += n
            if below >= rank:
                answer[c, rank] = v
                break
    return answer


def iqr_fences(df: DataFrame, columns: list[str], factor: float = 1.5,
               interpolated: bool = False, look: Look | None = None) -> dict[str, tuple[float, float]]:
    """Outlier fences q1 - factor*iqr and q3 + factor*iqr of each non-empty column."""
    fences = {}
    for c, (q1, q3) in quantiles(df, {c: [0.25, 0.75] for c in columns}, interpolated, look).items():
        if q1 is not None and q3 is not None:
            spread = q3 - q1
            fences[c] = (q1 - factor * spread, q3 + factor * spread)
    return fences

"""Exact discrete percentiles without a sort of the values."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed values of doubles: the bits of a fraction, the exponent's offset, the least normal one.
FRACTION, OFFSET, NORMAL = "4503599627370496", 1023, "2.2250738585072014E-308D"
INFINITE, NOT_A_NUMBER = 0x7FF << 52, (0x7FF << 52) + 1

#: Values kept per sketch, and how far from the wanted rank, as a share of all rows, its bracket begins and ends. The
#: sketch's ranks have a standard deviation of about 0.0004, so a bracket that misses the rank is out of the question;
#: if one ever did, the result would be an error, not another value.
KEPT, ASIDE = 4096, 0.005
#: Sketches of many tasks are merged in so many groups first.
GROUPS = 64
#: Stands for all values on the near side of a bracket, which come first.
FIRST = "-9223372036854775808L"


def _double_key(x: str) -> str:
    """SQL for a whole number per double in the same order: its bits, negated for negative ones; both zeros are 0."""
    size = f"abs({x})"
    guess = f"cast(floor(log2({size})) as double)"
    # The logarithm may be off by one next to a power of two.
    power = (
        f"(case when pow(2D, {guess}) > {size} then {guess} - 1"
        f" when {guess} < {OFFSET} and pow(2D, {guess} + 1) <= {size} then {guess} + 1 else {guess} end)"
    )
    normal = (
        f"(cast({power} as bigint) + {OFFSET}) * {FRACTION} + "
        f"cast(({size} / pow(2D, {power}) - 1) * cast({FRACTION} as double) as bigint)"
    )
    tiny = f"cast({size} * {2.0**537!r}D * {2.0**537!r}D as bigint)"
    key = f"(case when {size} = double('inf') then {INFINITE}L when {size} < {NORMAL} then {tiny} else {normal} end)"
    return f"(case when isnan({x}) then {NOT_A_NUMBER}L when {x} < 0 then -{key} else {key} end)"


def _double_of(key: str) -> str:
    size, fraction = f"abs({key})", f"cast(abs({key}) & ({FRACTION} - 1) as double)"
    exponent = f"shiftright({size}, 52)"
    value = (
        f"(case when {size} = {NOT_A_NUMBER}L then double('nan') when {size} = {INFINITE}L then double('inf')"
        f" when {exponent} = 0 then {fraction} * {2.0**-537!r}D * {2.0**-537!r}D"
        f" else (1 + {fraction} / cast({FRACTION} as double)) * pow(2D, cast({exponent} as double) - {OFFSET}) end)"
    )
    return f"(case when {key} < 0 then -{value} else {value} end)"


def _is_double(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def _plain(column: str, kind: T.DataType) -> str:
    """SQL for the column as doubles or whole numbers in its own order."""
    value = "`" + column.replace("`", "``") + "`"
    if _is_double(kind):
        return f"cast({value} as double)"
    if isinstance(kind, T.IntegralType):
        return f"cast({value} as bigint)"
    if isinstance(kind, T.DecimalType) and kind.precision <= 18:
        return f"cast({value} * {10**kind.scale} as bigint)"
    raise TypeError(f"percentiles need numbers of up to 18 digits or doubles, not {kind.simpleString()}: {column}")


def _read_back(key: str, kind: T.DataType) -> str:
    name = kind.simpleString()
    if _is_double(kind):
        return f"cast({_double_of(key)} as {name})"
    if isinstance(kind, T.DecimalType):
        return f"cast(cast({key} as decimal(20,0)) / cast({10**kind.scale} as decimal(20,0)) as {name})"
    return f"cast({key} as {name})"


def _brackets(df: DataFrame, kinds: list[T.DataType], entries: list[tuple[str, int, float]], bits: int) -> DataFrame:
    """One row: per entry the number of values, the rank, the values that bracket it (null: no bound), a bin's width.

    ``df`` has the columns ``v0, v1, ...``. One sketch per column, of bounded
    size and merged in any order, sees every value of it; NaN, which a sketch
    leaves out, counts as infinite there.
    """
    first, then = [], []
    for i, kind in enumerate(kinds):
        name = "double" if _is_double(kind) else "bigint"
        seen = f"case when isnan(v{i}) then double('inf') else v{i} end" if _is_double(kind) else f"v{i}"
        first += [f"kll_sketch_agg_{name}({seen}, {KEPT}) s{i}", f"count(v{i}) n{i}", f"min(v{i}) a{i}", f"max(v{i}) z{i}"]
        then += [f"kll_merge_agg_{name}(s{i}, {KEPT}) s{i}", f"sum(n{i}) n{i}", f"min(a{i}) a{i}", f"max(z{i}) z{i}"]
    merged = (
        df.groupBy((F.spark_partition_id() % GROUPS).alias("part"))
        .agg(*[F.expr(e) for e in first])
        .agg(*[F.expr(e) for e in then])
    )
    bounds, places = [], []
    for i, (_, no, p) in enumerate(entries):
        double = _is_double(kinds[no])
        name = "double" if double else "bigint"
        low, high = [
            f"case when n{no} > 0 then kll_sketch_get_quantile_{name}(s{no}, {share!r}D) end"
            if 0 < share < 1
            else f"cast(null as {name})"
            for share in (p - ASIDE, p + ASIDE)
        ]
        if double:
            high = f"nullif({high}, double('inf'))"  # NaN comes after infinity
        bounds += [f"{low} low{i}", f"{high} high{i}"]
        keys = [f"coalesce(low{i}, a{no})", f"coalesce(high{i}, z{no})"]
        start, stop = [f"shiftright({_double_key(k) if double else k}, {bits})" for k in keys]
        # From the median on, ranks count from the top.
        rank = f"greatest(ceil({p!r}D * n{no}), 1L)"
        rank = f"n{no} - {rank} + 1" if p > 0.5 else rank
        places.append(
            f"named_struct('rows', coalesce(n{no}, 0L), 'rank', {rank}, 'low', low{i}, 'high', high{i}, "
            f"'width', {stop} - {start} + 1, "
            f"'start', {f'{keys[0]}, ' if double else 'cast(null as double), '}"
            f"'step', {f'({keys[1]} - {keys[0]}) / {1 << bits}D' if double else 'cast(null as double)'}) e{i}"
        )
    return merged.selectExpr("*", *bounds).selectExpr(*places)


def exact_percentiles(
    df: DataFrame, wanted: Mapping[str, tuple[str, float]], bits: int = 16
) -> DataFrame:
    """One row with a value per entry of ``wanted`` (``name -> (column, p)``), in the column's own type.

    Each is the smallest value whose cumulative share reaches ``p``, NULLs left
    out and NaN last; a column without values gives NULL.

    The built-in ``percentile_disc`` merges one map of all distinct values in a
    single task. Here the table is read twice. First a mergeable sketch per
    column brackets every wanted rank. Then the values inside the brackets, one
    percent of the rows and the ties with them, are counted per value, and those
    on the near side of a bracket (below it, or above it from the median on) as
    one; counts are combined before their shuffle. A histogram of at most
    ``2 ** (bits + 1)`` bins says in which bin the rank is, and the values of that
    bin are put in order. Ranks are counted among all rows, so a value is exact whatever the
    sketch says; one that misses the rank is an error.
    """
    columns = sorted({column for column, _ in wanted.values()})
    kinds = [df.schema[c].dataType for c in columns]
    entries = [(name, columns.index(column), float(p)) for name, (column, p) in wanted.items()]
    values = df.selectExpr(*[f"{_plain(c, kind)} v{i}" for i, (c, kind) in enumerate(zip(columns, kinds, strict=True))])
    asks = _brackets(values, kinds, entries, bits)
    places = asks.select(F.struct(*asks.columns)).scalar()

    def inside(i: int, no: int, p: float) -> str:
        # Without a bound a comparison is null, and everything is inside. Doubles and whole numbers keep apart: only
        # what is left after counting is turned into bits.
        low, high = f"v{no} < b.e{i}.low", f"v{no} > b.e{i}.high"
        near, far = (high, low) if p > 0.5 else (low, high)
        d, l = (f"v{no}", "cast(null as bigint)") if _is_double(kinds[no]) else ("cast(null as double)", f"v{no}")
        same = ", ".join([f"'entry', {i}", *[f"'{c}', b.e{i}.{c}" for c in ("rank", "width", "start", "step")]])
        return (
            f"case when v{no} is null or {far} then null when {near} then "
            f"named_struct({same}, 'd', cast(null as double), 'l', {FIRST}, 'near', true) "
            f"else named_struct({same}, 'd', {d}, 'l', {l}, 'near', false) end"
        )

    counts = (
        values.select("*", places.alias("b"))
        .selectExpr(f"inline(array({', '.join(inside(i, no, p) for i, (_, no, p) in enumerate(entries))}))")
        .filter("entry is not null")
        .groupBy("entry", "rank", "width", "start", "step", "near", "d", "l")
        .agg(F.count("*").alias("n"))
    )
    # Searched from the top, values go in the order of their inverted bits.
    downward = [i for i, (_, _, p) in enumerate(entries) if p > 0.5]
    turned = f"entry in ({', '.join(map(str, downward))})" if downward else "false"
    bits_of = f"coalesce(l, {_double_key('d')})"
    # Bins by bits are fine where values are small, bins by value where they crowd away from zero: both keep the order.
    usable = "step > 0 and step < double('inf') and abs(start) < double('inf') and not isnan(d)"
    value_bin = f"case when {usable} then cast(least(greatest((d - start) / step, -1D), {1 << bits}D) as bigint) else 0 end"
    counts = counts.selectExpr(
        "entry", "rank", "near", "n",
        f"case when near then {FIRST} when {turned} then ~{bits_of} else {bits_of} end key",
        f"case when near then -{1 << bits} - 1 when {turned} then -({value_bin}) else {value_bin} end value_bin", "width",
    ).selectExpr("entry", "rank", "near", "n", "key", "struct(key div width, value_bin) bin")
    # As the join below asks, so that both uses read one shuffle.
    counts = counts.filter("bin is not null")
    upto = "sum(n) over (partition by entry order by {}) upto"
    bins = (
        counts.groupBy("entry", "rank", "bin").agg(F.sum("n").alias("n"))
        .selectExpr("*", upto.format("bin")).filter("upto - n < rank and rank <= upto")
        .selectExpr("entry", "bin", "rank - upto + n as own")
    )
    # The values of one bin per entry are left; the broadcast has a row per entry, whatever the data.
    found = (
        counts.join(F.broadcast(bins), ["entry", "bin"])
        .selectExpr("*", upto.format("near desc, key")).filter("upto - n < own and own <= upto and not near")
    )
    keys = [f"min(case when entry = {i} then {'~' if i in downward else ''}key end) k{i}" for i in range(len(entries))]
    found = found.agg(*[F.expr(k) for k in keys]).select("*", places.alias("b"))
    results = []
    for i, (name, no, p) in enumerate(entries):
        error = f"cast(raise_error('a sketch misses the rank of entry {i}, {p}') as bigint)"
        key = f"case when k{i} is null and b.e{i}.rows > 0 then {error} else k{i} end"
        results.append(F.expr(_read_back(f"({key})", kinds[no])).alias(name))
    return found.select(*results)

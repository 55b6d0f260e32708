"""Ordered scans over time series of any length and any skew.

Forward fill, lag and interpolation all need "the nearest value before (or after)
this row". A window keyed by series alone puts a whole series, which may be a third
of all rows, into one task; a window without keys puts the whole table there.
Here each series is cut into time chunks of bounded row count:

1. one combinable aggregation gives, per chunk, its row count, time range and its
   first and last value; the result is small and is written to shared storage;
2. chunks with too many rows are cut again, by their own time range and, where
   many rows share one timestamp, by the tie-break column;
3. a window over the chunk table carries values from chunk to chunk;
4. the rows shuffle once, on (series, chunk); a window inside the chunk finds
   near values and the carried value covers the rest.

The result does not depend on where the cuts fall.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattline.errors import OptionError
from wattline.functions.calendar import MICROS_PER_DAY, wall_micros
from wattline.storage import attach, materialize

# Width of a chunk before any cut, and the row count beyond which it is cut. The count is for rows
# that carry a few values; wide rows get proportionally smaller chunks.
CHUNK_DAYS = 32
CHUNK_ROWS = 2_000_000
_NARROW = 4
# A chunk table without keys is scanned in one task up to this many cells, in blocks beyond.
CARRY_CELLS = 2_000_000
_BLOCKS = 256

# What chunks carry is broadcast up to this size, estimated from its cells, and joined by a shuffle beyond.
BROADCAST_BYTES = 32 << 20
_CELL_BYTES = 16

_CHUNK = "_chunk"
_TIE = "_tie_chunk"


@dataclass(frozen=True)
class Near:
    """Nearest non-null ``value`` in time order.

    ``after`` looks forward in time instead of back; ``strict`` leaves the row itself out.
    Numbers and timestamps keep the chunk table a hash aggregation; other types make it sort.
    """

    out: str
    value: Column
    after: bool = False
    strict: bool = False


def _check_tie(df: DataFrame, tie: str | None) -> None:
    if tie is not None and not isinstance(df.schema[tie].dataType, T.IntegralType):
        raise OptionError(f"tie-break column {tie!r} must be an integer column")


def _rank(ts: str, tie: str | None) -> Column:
    """Order of rows in a series as one value, since a struct would force a sort aggregation.

    A tie-break moves the rank by less than one step of the position. DECIMAL(38) holds
    positions up to the year 150,000.
    """
    if tie is None:
        return F.col(ts)
    step = F.lit(Decimal(20_000_000_000_000_000_000))
    return wall_micros(F.col(ts)).cast("decimal(19,0)") * step + F.col(tie).cast("decimal(19,0)")


def _chunk_table(df: DataFrame, group: list[str], ts: str, tie: str | None, specs: Sequence[Near]) -> DataFrame:
    order = _rank(ts, tie)
    stats = [
        F.count(F.lit(1)).alias("_rows"),
        F.min(ts).alias("_lo"),
        F.max(ts).alias("_hi"),
        (F.min(tie) if tie else F.lit(0)).cast("bigint").alias("_tie_lo"),
        (F.max(tie) if tie else F.lit(0)).cast("bigint").alias("_tie_hi"),
    ]
    for i, spec in enumerate(specs):
        edge = F.min_by if spec.after else F.max_by
        stats.append(edge(f"_v{i}", F.when(F.col(f"_v{i}").isNotNull(), order)).alias(f"_edge{i}"))
    return df.groupBy(*group).agg(*stats)


def _start(position: Column, low: Column, high: Column, parts: Column) -> Column:
    """Start of the equal part of [low, high] that holds ``position``."""
    width = F.greatest(F.lit(1).cast("bigint"), F.ceil((high - low + 1) / parts).cast("bigint"))
    return low + F.floor((position - low) / width).cast("bigint") * width


def _cut(
    df: DataFrame, crowded: DataFrame, count: int, group: list[str], ts: str, tie: str | None, chunk_rows: int
) -> DataFrame:
    ends = [wall_micros(F.col(c)).alias(c) for c in ("_lo", "_hi")]
    spread = [ts, *([tie] if tie else [])]
    marked = attach(df, crowded.select(*group, "_rows", *ends, "_tie_lo", "_tie_hi"), group, spread, count)
    parts = F.ceil(F.col("_rows") * 4 / F.lit(chunk_rows))
    by_time = F.col("_rows").isNotNull() & (F.col("_hi") > F.col("_lo"))
    place = _start(wall_micros(F.col(ts)), F.col("_lo"), F.col("_hi"), parts)
    chunk = F.when(by_time, place).otherwise(F.col(_CHUNK))
    tie_chunk = F.col(_TIE)
    if tie:
        by_tie = F.col("_rows").isNotNull() & (F.col("_hi") == F.col("_lo"))
        tie_chunk = F.when(
            by_tie, _start(F.col(tie).cast("bigint"), F.col("_tie_lo"), F.col("_tie_hi"), parts)
        ).otherwise(tie_chunk)
    kept = [c for c in df.columns if c not in (_CHUNK, _TIE)]
    return marked.select(*kept, chunk.alias(_CHUNK), tie_chunk.alias(_TIE))


def chunked(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    tie: str | None,
    specs: Sequence[Near],
    chunk_days: int = CHUNK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> tuple[DataFrame, DataFrame, int]:
    """Rows with their chunk, the chunk table on shared storage, and its row count."""
    _check_tie(df, tie)
    chunk_rows = max(1, chunk_rows * _NARROW // max(_NARROW, len(specs)))
    day = F.unix_date(F.col(ts).cast("date"))
    first_day = (day - F.pmod(day, F.lit(chunk_days))).cast("bigint")
    rows = df.select(
        "*",
        (first_day * F.lit(MICROS_PER_DAY)).alias(_CHUNK),
        F.lit(0).cast("bigint").alias(_TIE),
        *[spec.value.alias(f"_v{i}") for i, spec in enumerate(specs)],
    )
    group = [*keys, _CHUNK, _TIE]
    # Every pass divides crowded chunks by their own range; it ends when none is crowded that has two places.
    splittable = (F.col("_hi") > F.col("_lo")) | (F.col("_tie_hi") > F.col("_tie_lo"))
    is_crowded = (F.col("_rows") > chunk_rows) & splittable
    while True:
        table = materialize(_chunk_table(rows, group, ts, tie, specs), "chunks")
        found = table.agg(F.count(F.lit(1)).alias("chunks"), F.count_if(is_crowded).alias("crowded")).first()
        if found["crowded"] == 0:
            return rows, table, found["chunks"]
        rows = _cut(rows, table.where(is_crowded), found["crowded"], group, ts, tie, chunk_rows)


def _scan(edges: DataFrame, keys: list[str], group: list[str], specs: Sequence[Near]) -> DataFrame:
    """Per chunk, the nearest edge among the chunks before it (after it) that share its keys."""
    before = Window.partitionBy(*keys).orderBy(_CHUNK, _TIE).rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.partitionBy(*keys).orderBy(F.desc(_CHUNK), F.desc(_TIE)).rowsBetween(Window.unboundedPreceding, -1)
    return edges.select(
        *dict.fromkeys([*keys, *group]),
        *[
            F.last(f"_edge{i}", ignorenulls=True).over(behind if s.after else before).alias(f"_carry{i}")
            for i, s in enumerate(specs)
        ],
    )


def _carried(table: DataFrame, keys: list[str], group: list[str], specs: Sequence[Near], chunks: int) -> DataFrame:
    """What each chunk gets from the chunks around it.

    A series has at most (rows / chunk_rows) * 8 + days / chunk_days chunks. A table without keys is one
    series; when its chunk table is large, blocks of chunks are scanned side by side and a table of
    at most ``_BLOCKS`` rows carries between the blocks.
    """
    edges = table.select(*group, *[f"_edge{i}" for i in range(len(specs))])
    if keys or chunks * len(specs) <= CARRY_CELLS:
        return _scan(edges, keys, group, specs)
    shares = [i / _BLOCKS for i in range(1, _BLOCKS)]
    borders = sorted(set(edges.agg(F.percentile_approx(_CHUNK, shares)).first()[0]))
    passed = F.filter(F.array(*[F.lit(b).cast("bigint") for b in borders]), lambda b: b <= F.col(_CHUNK))
    edges = edges.withColumn("_block", F.size(passed))
    order = F.struct(_CHUNK, _TIE)
    ends = edges.groupBy("_block").agg(
        *[
            (F.min_by if s.after else F.max_by)(f"_edge{i}", F.when(F.col(f"_edge{i}").isNotNull(), order)).alias(f"_edge{i}")
            for i, s in enumerate(specs)
        ]
    )
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    behind = Window.orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    outer = ends.select(
        "_block",
        *[
            F.last(f"_edge{i}", ignorenulls=True).over(behind if s.after else before).alias(f"_outer{i}")
            for i, s in enumerate(specs)
        ],
    )
    inner = _scan(edges, ["_block"], group, specs).join(F.broadcast(outer), "_block")
    return inner.select(
        *group, *[F.coalesce(f"_carry{i}", f"_outer{i}").alias(f"_carry{i}") for i in range(len(specs))]
    )


def _plain_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with its keys as columns without NULL, which plain equality can join: a value and whether it stands for NULL."""
    made, names = {}, []
    for i, key in enumerate(keys):
        kind = df.schema[key].dataType
        if isinstance(kind, (T.NumericType, T.StringType)):
            instead = F.lit(0).cast(kind)
        elif isinstance(kind, T.BooleanType):
            instead = F.lit(False)
        else:
            instead = F.lit("1970-01-01").cast(kind)
        made[f"_key{i}"] = F.coalesce(F.col(key), instead)
        made[f"_null{i}"] = F.col(key).isNull()
        names += [f"_key{i}", f"_null{i}"]
    return (df.withColumns(made) if made else df), names


def nearest(
    df: DataFrame,
    specs: Sequence[Near],
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    tie: str | None = None,
    chunk_days: int = CHUNK_DAYS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``df`` plus one column per spec. Rows without a timestamp have no place in time and must be gone."""
    keys = list(keys)
    rows, table, chunks = chunked(df, keys, ts, tie, specs, chunk_days, chunk_rows)
    group = [*keys, _CHUNK, _TIE]

    carry = _carried(table, keys, group, specs, chunks)
    rows, marks = _plain_keys(rows, keys)
    other, _ = _plain_keys(carry, keys)
    place = [*marks, _CHUNK, _TIE]
    other = other.select(*[F.col(c).alias(f"_of{c}") for c in place], *[f"_carry{i}" for i in range(len(specs))])
    if chunks * (len(specs) + len(place)) * _CELL_BYTES <= BROADCAST_BYTES:
        other = F.broadcast(other)
    # Chunks are bounded, so beyond the broadcast bound one shuffle on the chunk serves join and window.
    joined = rows.join(other, [F.col(c) == F.col(f"_of{c}") for c in place], "left")
    by_time = [ts, *([tie] if tie else [])]

    def frame(spec: Near):
        order = [F.desc(c) for c in by_time] if spec.after else by_time
        window = Window.partitionBy(*place).orderBy(*order)
        return window.rowsBetween(Window.unboundedPreceding, -1 if spec.strict else Window.currentRow)

    return joined.select(
        *df.columns,
        *[
            F.coalesce(F.last(f"_v{i}", ignorenulls=True).over(frame(s)), F.col(f"_carry{i}")).alias(s.out)
            for i, s in enumerate(specs)
        ],
    )

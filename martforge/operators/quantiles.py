"""Exact n-tiles by selection, without sorting the rows.

``NTILE(b) OVER (ORDER BY value, key)`` needs only b - 1 cut points: the rows at
the ranks where one tile ends and the next begins.  A row's place in the order is
written as one whole number, its value's place times the span of the unique key
plus the key's place, so that no two rows share one.  A cut is found by counting
rows in RANGES equal parts of the range that must hold it and going on with the
part where the wanted rank falls, until a part ends exactly at that rank.  One
scan counts for all cuts of all columns; what reaches the driver is one count per
non-empty part (at most RANGES for each cut, whatever the number of rows), and
the scores themselves are a comparison of each row with the cuts, in one map.

Rounds follow the logarithm (to base RANGES) of the span of the numbers, and
mostly that of the number of rows: a part with one row is an exact end.  Equal
values, a hot value included, differ by their keys and cost a few more rounds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.session import cut_lineage

RANGES = 4096


@dataclass(frozen=True)
class Tiles:
    """One ``NTILE``: the column ordered by (whole numbers, decimals or dates) and how."""
    out: str
    column: str
    descending: bool = False
    nulls_first: bool = False


def tile_ends(rows: int, buckets: int) -> list[int]:
    """Rank of the last row of every tile but the last: the first ``rows mod
    buckets`` tiles hold one row more."""
    size, more = divmod(rows, buckets)
    return [j * size + min(j, more) for j in range(1, buckets)]


def _whole(df: DataFrame, name: str) -> Column:
    """The column as a whole number of the same order."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(name).cast("decimal(38,0)")
    if isinstance(kind, T.DecimalType):
        # digits in front of the point and behind it, put together without losing any
        return (F.col(name) * F.lit(10 ** kind.scale).cast(f"decimal({kind.scale + 1},0)")).cast("decimal(38,0)")
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(name).cast("decimal(38,0)")
    raise TypeError(f"{name}: n-tiles by selection need whole numbers, decimals or dates, not {kind}")


def _number(value: int, kind: str) -> Column:
    return F.lit(str(value)).cast(kind)


class _Cut:
    """The search for one rank: ``before`` rows lie below ``low``; the row is below ``high``."""

    def __init__(self, tiles: int, rank: int, span: int) -> None:
        self.tiles, self.rank, self.low, self.high, self.before = tiles, rank, 0, span, 0
        self.last: int | None = None  # rows up to this number are in the tile or before it

    def part(self) -> tuple[int, int, int]:
        return self.tiles, self.low, self.high

    def narrow(self, counts: dict[int, int]) -> None:
        width = -(-(self.high - self.low) // RANGES)
        for i in sorted(counts):
            if self.before + counts[i] >= self.rank:
                low = self.low
                self.low, self.high = low + i * width, min(low + (i + 1) * width, self.high)
                if self.before + counts[i] == self.rank:
                    self.last = self.high - 1
                return
            self.before += counts[i]
        raise AssertionError("fewer rows than when they were counted first")


def with_exact_ntiles(df: DataFrame, tiles: Sequence[Tiles], key: str, buckets: int) -> DataFrame:
    """``df`` with an int column of 1 to ``buckets`` for every entry of ``tiles``,
    equal to ``NTILE(buckets) OVER (ORDER BY column, key)``.  ``key`` is a whole
    number, unique and not null.  The rows are written once, so that every count
    sees the same ones."""
    df = cut_lineage(df, "n-tiles")
    whole = [_whole(df, t.column) for t in tiles]
    id_ = F.col(key).cast("decimal(38,0)")
    bounds = df.agg(F.count(F.lit(1)), F.min(id_), F.max(id_), *[f(w) for w in whole for f in (F.min, F.max)]).first()
    rows, first_id = bounds[0], int(bounds[1] or 0)
    ids = int(bounds[2] or 0) - first_id + 1
    places, spans = [], []
    for t, w, low, high in zip(tiles, whole, bounds[3::2], bounds[4::2]):
        low, high = int(low or 0), int(high or 0)
        place = _number(high, "decimal(38,0)") - w if t.descending else w - _number(low, "decimal(38,0)")
        span = (high - low + 2) * ids
        if span >= 10 ** 37:
            raise ValueError(f"{t.column}: values and keys span more than 37 digits")
        kind = "bigint" if span < 1 << 62 else "decimal(38,0)"
        value = F.coalesce(place + 1, F.lit(0)) if t.nulls_first else F.coalesce(place, _number(high - low + 1, "decimal(38,0)"))
        places.append(value.cast(kind) * _number(ids, kind) + (id_ - _number(first_id, "decimal(38,0)")).cast(kind))
        spans.append((span, kind))

    coded = df.select("*", *[p.cast(k).alias(f"_mf_place{i}") for i, (p, (_, k)) in enumerate(zip(places, spans))])
    cuts = [_Cut(i, rank, spans[i][0]) for i in range(len(tiles)) for rank in tile_ends(rows, buckets) if 0 < rank < rows]
    while open_ := [c for c in cuts if c.last is None]:
        parts = sorted({c.part() for c in open_})
        hits = []
        for n, (i, low, high) in enumerate(parts):
            kind, place = spans[i][1], F.col(f"_mf_place{i}")
            width = -(-(high - low) // RANGES)
            inside = (place >= _number(low, kind)) & (place < _number(high, kind))
            index = F.call_function("div", place - _number(low, kind), _number(width, kind)).cast("int")
            hits.append(F.when(inside, F.struct(F.lit(n).alias("n"), index.alias("i"))))
        counted = (coded.select(F.explode(F.filter(F.array(*hits), lambda h: h.isNotNull())).alias("h"))
                   .groupBy("h").agg(F.count(F.lit(1)).alias("rows")).collect())
        counts: dict[tuple, dict[int, int]] = {p: {} for p in parts}
        for r in counted:
            counts[parts[r["h"]["n"]]][r["h"]["i"]] = r["rows"]
        for c in open_:
            c.narrow(counts[c.part()])

    def score(i: int) -> Column:
        out = F.lit(1)
        for c in cuts:
            if c.tiles == i:
                out = out + (F.col(f"_mf_place{i}") > _number(c.last, spans[i][1])).cast("int")
        # with fewer rows than tiles every row is a tile of its own, and no cut lies behind the last
        return out.cast("int").alias(tiles[i].out)

    return coded.select(*df.columns, *[score(i) for i in range(len(tiles))])

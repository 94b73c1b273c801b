"""Histogram sort: near-equal shards by bytes, with one exchange of the rows.

Every row has a 63-bit key: 31 bits of its group's hash, then 32 bits of its id's hash, so that the
rows of a group lie side by side and a group of any size can still be split. The shard boundaries
(splitters) are found by counting: each round counts the exact bytes below evenly spaced candidate
keys inside the intervals that hold a wanted boundary, and refines those intervals until the bytes
left inside are within the tolerance. Only the counts reach the driver, at most `boundaries * 2**BITS`
rows a round. The key depends on the row's content alone, so a lost executor's tasks give the same
rows again.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from curbline.session import freeze

KEY_BITS = 63
BITS = 9
TOLERANCE = 0.0005
ROWS_PER_PART = 1_000_000

_KEY, _SIZE, _PART, _AHEAD = "__shard_key", "__shard_size", "__shard_part", "__shard_ahead"


def sort_key(group: str, row_id: str) -> Column:
    """Orders rows by group, then by id, both hashed; a null hashes like any other value."""
    high = F.shiftright(F.xxhash64(F.col(group)), 33).bitwiseAND(F.lit(0x7FFFFFFF))
    low = F.shiftright(F.xxhash64(F.lit("id"), F.col(row_id)), 32).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(high, 32).bitwiseOR(low)


def text_bytes(text: str) -> Column:
    """UTF-8 bytes of a text and 8 more for its frame; a null has no bytes."""
    return F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + F.lit(8)


def splitters(keyed: DataFrame, parts: int, tolerance: float = TOLERANCE) -> list[int]:
    """The parts - 1 keys at which the parts after the first begin, never falling.

    `keyed` has the key and size columns. A boundary is off by at most `tolerance` of a part, or by
    the rows of one key where those are more.
    """
    total = keyed.agg(F.sum(_SIZE)).first()[0] or 0
    wanted = {i: total * i / parts for i in range(1, parts)}
    slack = tolerance * total / parts
    # an interval: first key -> (bytes before it, boundaries inside it)
    open_at = {0: (0, list(wanted))}
    found: dict[int, int] = {}
    shift = KEY_BITS
    while open_at and total:
        width = min(BITS, shift)
        held = keyed
        if shift < KEY_BITS:
            held = keyed.where(F.shiftright(_KEY, shift).isin([first >> shift for first in open_at]))
        shift -= width
        counted = held.groupBy(F.shiftright(_KEY, shift).alias("probe")).agg(F.sum(_SIZE).alias("bytes")).collect()
        bytes_at: dict[int, list[tuple[int, int]]] = {}
        for probe, size in counted:
            bytes_at.setdefault((probe >> width) << (width + shift), []).append((probe << shift, size))
        refined: dict[int, tuple[int, list[int]]] = {}
        for first, (before, boundaries) in open_at.items():
            left = list(boundaries)
            for start, size in sorted(bytes_at[first]):
                inside = [i for i in left if wanted[i] < before + size]
                left = left[len(inside) :]
                for i in inside:
                    if wanted[i] - before <= slack or shift == 0 and wanted[i] - before <= size / 2:
                        found[i] = start
                    elif before + size - wanted[i] <= slack or shift == 0:
                        found[i] = start + (1 << shift)
                    else:
                        refined.setdefault(start, (before, []))[1].append(i)
                before += size
        open_at = refined
    return [found.get(i, 1 << KEY_BITS) if total else 0 for i in range(1, parts)]


def part_of(key: Column, bounds: list[int], offset: int = 0) -> Column:
    """The number of bounds at or below the key, found by halving."""
    if not bounds:
        return F.lit(offset)
    middle = len(bounds) // 2
    if bounds[middle] >= 1 << KEY_BITS:
        return part_of(key, bounds[:middle], offset)
    return F.when(key < F.lit(bounds[middle]), part_of(key, bounds[:middle], offset)).otherwise(
        part_of(key, bounds[middle + 1 :], offset + middle + 1)
    )


def histogram_sort(
    df: DataFrame,
    shards: int,
    group: str = "text",
    row_id: str = "doc_id",
    size: Column | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """The rows of `df`, all columns kept, with `shard` (0 to shards - 1) and `slot` (0, 1, ... in it).

    Shards hold near-equal sums of `size` (by default the bytes of the group's text and 8). Rows of
    equal group are neighbours; a group larger than a shard goes on in the next one. Rows that agree
    in group and id cannot be told apart: they stay in one shard, in any order. Nulls are values.
    An empty frame gives an empty frame. Input columns called shard or slot are replaced.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    size = text_bytes(group) if size is None else size
    keep = [F.col(f"`{name}`") for name in df.columns if name not in ("shard", "slot")]
    keyed = df.select(*keep, sort_key(group, row_id).alias(_KEY), size.alias(_SIZE))
    counted = freeze(keyed.select(_KEY, _SIZE))
    rows = counted.count()
    # several parts to a shard, so that no task sorts a whole large shard
    fine = max(1, -(-rows // (ROWS_PER_PART * shards)))
    bounds = splitters(counted, shards * fine, tolerance)
    part = part_of(F.col(_KEY), bounds)
    sizes = {row[0]: row[1] for row in counted.groupBy(part.alias("part")).count().collect()}
    ahead, run = [], 0
    for i in range(shards * fine):
        run = 0 if i % fine == 0 else run
        ahead.append(run)
        run += sizes.get(i, 0)
    in_part = Window.partitionBy(_PART).orderBy(_KEY, F.col(f"`{row_id}`"), F.xxhash64(F.col(f"`{group}`")))
    before = F.element_at(F.array(*[F.lit(x).cast("long") for x in ahead]), F.col(_PART) + 1)
    return keyed.withColumn(_PART, part).select(
        *keep,
        F.floor(F.col(_PART) / fine).cast("int").alias("shard"),
        (before + F.row_number().over(in_part) - 1).cast("long").alias("slot"),
    )

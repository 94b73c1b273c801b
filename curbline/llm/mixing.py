"""Mixing sources to target weights: every source is taken to its exact budget, in whole epochs and a cut.

Each row has a hash-random key. Within its source, rows are ordered by that key: the first hex digits
of the key make the range parts, their sizes are summed per part and the sums accumulated over the
parts, so a source of any size is spread over many tasks and only the one part that holds its cut is
ordered row by row. The number of digits follows from the rows, so that a part stays small. The key
depends on the id, or for rows without one on what they hold, and ties are broken by what rows hold, so
reruns and lost tasks agree.

Only DataFrame functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
#: hex digits of the key that make the ranges: at least, at most, and the rows of a range aimed at
KEY_DIGITS = 3
MOST_DIGITS = 6
RANGE_ROWS = 100_000
SEED = "mix"
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("long")


def key_digits(rows: int) -> int:
    """Digits that cut this many rows into ranges of about RANGE_ROWS or fewer."""
    digits = KEY_DIGITS
    while digits < MOST_DIGITS and rows > RANGE_ROWS * 16**digits:
        digits += 1
    return digits


def tie_hash(df: DataFrame) -> Column:
    """What tells rows of the same id and size apart: a hash of the text, then one of all other columns."""
    others = [F.col(f"`{name}`") for name in sorted(df.columns) if name != "text"]
    return F.struct(F.sha2(F.col("text"), 256).alias("text"), F.xxhash64(F.to_json(F.struct(*others))).alias("others"))


def targets(
    sized: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """One row per source: source_size and target, from a frame with `source` and `size`.

    Sources in code-point order (null last) get the weights in turn and share the whole size by them.
    A target stops at `most_epochs` times its source's size and what is over goes to the others by
    weight, until none is above: all uncapped sources then have the same target per weight, the level.
    Ordered by their cap per weight, the capped sources come first, which running sums find.
    """
    by_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn % len(weights)).cast("int") + 1)
    cap = F.col("source_size") * F.lit(float(most_epochs))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("turn"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = by_level.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(all_rows) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / rest
    ranked = (
        by_source.withColumn("turn", turn)
        .withColumn("weight", weight)
        .withColumn("cap", cap)
        .withColumn("level", level)
        .withColumn("free", F.col("level") * F.col("weight") < F.col("cap"))
    )
    # the first source whose share stays under its cap sets the level of all after it
    set_level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "turn", "level"))).over(all_rows)
    return ranked.withColumn("set", set_level).select(
        "source",
        "source_size",
        F.when(
            F.col("set").isNotNull()
            & (F.struct(F.col("cap") / F.col("weight"), "turn") >= F.struct(F.col("set")["col1"], F.col("set")["turn"])),
            F.col("set")["level"] * F.col("weight"),
        )
        .otherwise(F.col("cap"))
        .alias("target"),
    )


def mix(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    seed: str = SEED,
    tie: str | None = None,
) -> DataFrame:
    """Adds source_size, target, copies, part and taken to a frame with doc_id, source and size.

    A row is taken whole `copies` times; `part` is how many of its units the last, cut epoch takes, and
    taken = copies * size + part. The sum of taken over a source is its target rounded down, and no row
    is taken more than `most_epochs` times its size. A source without any size gets nothing. Null
    sources are one source; rows with the same id follow one another in order of size, and of the
    column `tie` where one is named: it is used for nothing else, dropped, and keys the rows without an id, which share one
    key without it. Other columns pass through; input columns with the names above are replaced.
    """
    added = ("source_size", "target", "copies", "part", "taken", tie)
    given = [F.col(f"`{name}`") for name in sized.columns if name not in added]
    shares = targets(sized.select("source", "size"), weights, most_epochs)
    shares = shares.withColumn(
        "__epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("__rest", F.floor(F.col("target") - F.col("__epochs") * F.col("source_size")))
    tied = F.col(f"`{tie}`") if tie else F.lit(None).cast("string")
    unnamed = F.concat(F.lit("null:"), F.to_json(F.struct(tied))) if tie else F.lit("null")
    key = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), unnamed)))
    keyed = sized.select(*given, key.alias("__key"), tied.alias("__tie"))
    keyed = keyed.withColumn("__range", F.substring("__key", 1, key_digits(sized.count())))

    in_source = Window.partitionBy("source").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        keyed.groupBy("source", "__range")
        .agg(F.sum("size").alias("__in_range"))
        .withColumn("__ahead", F.coalesce(F.sum("__in_range").over(in_source), F.lit(0)))
    )
    ranges = ranges.join(shares.withColumnRenamed("source", "__of"), F.col("source").eqNullSafe(F.col("__of"))).drop("__of")
    ranges = ranges.withColumnRenamed("source", "__of").withColumnRenamed("__range", "__in")
    placed = keyed.join(ranges, F.col("source").eqNullSafe(F.col("__of")) & (F.col("__range") == F.col("__in")))
    cut = (F.col("__ahead") < F.col("__rest")) & (F.col("__ahead") + F.col("__in_range") > F.col("__rest"))
    # rows of other ranges need no order; spread over their keys, they make no large window group
    in_range = Window.partitionBy("source", "__range", F.when(F.col("__cut"), F.lit("")).otherwise(F.col("__key")))
    in_range = in_range.orderBy("__key", F.col("doc_id"), "size", "__tie").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("__ahead") + F.coalesce(F.sum("size").over(in_range), F.lit(0))
    left = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("__rest") - F.col("__before")))
    part = F.when(F.col("__cut"), left).when(F.col("__ahead") < F.col("__rest"), F.col("size")).otherwise(0)
    return (
        placed.withColumn("__cut", cut)
        .withColumn("__before", before)
        .withColumn("__part", part.cast("long"))
        .select(
            *given,
            F.col("source_size").cast("long").alias("source_size"),
            F.col("target"),
            (F.col("__epochs") + F.when((F.col("__part") == F.col("size")) & (F.col("size") > 0), 1).otherwise(0)).cast("int").alias("copies"),
            F.when(F.col("__part") < F.col("size"), F.col("__part")).otherwise(0).cast("long").alias("part"),
            (F.col("__epochs") * F.col("size") + F.col("__part")).cast("long").alias("taken"),
        )
    )


def mixed_rows(df: DataFrame, weights: Sequence[float] = WEIGHTS, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself: the rows of `df` (doc_id, source, text and others), each as often as it is taken.

    The row at a source's cut ends after its taken words; all other texts are whole. Rows are told apart by all
    that they hold, so the mix is the same in whatever order or tasks they are read.
    """
    # other columns are held under reserved names, so that none is taken for one that the mix adds
    held = {name: f"__own{i}" for i, name in enumerate(df.columns) if name not in ("doc_id", "source", "text")}
    sized = df.select(*[F.col(f"`{name}`").alias(held.get(name, name)) for name in df.columns])
    sized = sized.withColumns({"size": word_count("text"), "__same": tie_hash(sized)})
    mixed = mix(sized, weights, most_epochs, tie="__same")
    words = F.regexp_extract_all(F.col("text"), F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    start = F.array_join(F.slice(words, F.lit(1), F.col("part").cast("int")), "")
    whole = mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    cut = mixed.where("part > 0").withColumn("text", start).withColumn("__copy", F.lit(0))
    return whole.unionByName(cut).select(*[F.col(held.get(name, name)).alias(name) for name in df.columns])

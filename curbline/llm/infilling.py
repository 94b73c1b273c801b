"""Fill-in-middle transformation with one counted-quantifier match a row.

A text is a run of units (by default lines). regexp_count gives their number n; hashes of the row's id
choose the two cuts a <= b; and a pattern made for the row, `(unit{a})(unit{b-a})(rest)` with possessive
quantifiers, captures prefix, middle and suffix in one match, whose replacement is the output. Java's
possessive counted groups match in a loop, neither recursing nor going back, so that a text may have
any number of units. Everything is a column expression: no Python, no shuffle, and a row's result depends
on that row alone.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LINES = r"[^\n]*\n|[^\n]+"
SEED = "7"
RATE = 100
SPM_SHARE = 50

PLAIN, PSM, SPM = "plain", "psm", "spm"

ADDED = ("n_units", "form", "prefix_chars", "middle_chars", "output")


@dataclass(frozen=True)
class Markers:
    """What stands before prefix, suffix and middle.

    A text that holds a marker stays as it is. The first character of a marker may stand nowhere else in a
    marker: then none can arise where a part and a marker meet, and an output is taken apart in one way only.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        if not all(self.all) or len(set(self.all)) < 3:
            raise ValueError("three different markers are needed")
        rest = "".join(marker[1:] for marker in self.all)
        if any(marker[0] in rest for marker in self.all):
            raise ValueError("the first character of a marker stands inside a marker")
        if any(a != b and a.startswith(b) for a in self.all for b in self.all):
            raise ValueError("a marker begins with another one")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


MARKERS = Markers()


def _plainly(replacement: str) -> str:
    return replacement.replace("\\", "\\\\").replace("$", "\\$")


def draws(row_id: str, seed: str = SEED) -> list[Column]:
    """Four numbers below 2**32 from the hash of the seed and the id; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{row_id}`").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def cut_pattern(first: Column, second: Column, unit: str = LINES) -> Column:
    """The row's pattern: so many units, so many more, and the rest of the text."""
    one = f"(?:{unit})"
    return F.format_string(r"(?s)\A(" + one + r"{%d}+)(" + one + r"{%d}+)(.*)\z", first, second - first)


def infill(
    df: DataFrame,
    row_id: str = "doc_id",
    text: str = "text",
    unit: str = LINES,
    markers: Markers = MARKERS,
    rate: int = RATE,
    spm_share: int = SPM_SHARE,
    seed: str = SEED,
) -> DataFrame:
    """The rows of `df`, all columns kept, with n_units, form, prefix_chars, middle_chars and output.

    `unit` is a Java pattern (without groups that capture) whose matches tile any text without gaps. `rate` in a hundred
    rows are cut, `spm_share` in a hundred of those put the suffix first (`spm`), the others the prefix
    (`psm`). A row that is not drawn, an empty or null text, and a text that holds a marker are `plain`:
    output is the text (null: empty), the character counts are null. Rows equal in id and text get equal
    outputs; rows with null ids share their draws. An empty frame gives an empty frame. Input columns with
    the names of ADDED are replaced.
    """
    given = [F.col(f"`{name}`") for name in df.columns if name not in ADDED]
    held = [f"__fim_own{i}" for i in range(len(given))]
    body, draw = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), draws(row_id, seed)
    rows = df.select(
        *[column.alias(name) for column, name in zip(given, held)],
        body.alias("__fim_text"),
        F.regexp_count(body, F.lit(unit)).cast("long").alias("n_units"),
        *[column.alias(f"__fim_h{i}") for i, column in enumerate(draw, 1)],
    )
    first, second = (F.pmod(F.col(f"__fim_h{i}"), F.col("n_units") + 1) for i in (1, 2))
    marked = F.col("__fim_text").contains(markers.prefix)
    for marker in (markers.suffix, markers.middle):
        marked |= F.col("__fim_text").contains(marker)
    form = (
        F.when((F.col("__fim_text") == "") | marked | (F.pmod("__fim_h3", F.lit(100)) >= rate), PLAIN)
        .when(F.pmod("__fim_h4", F.lit(100)) < spm_share, SPM)
        .otherwise(PSM)
    )
    rows = rows.withColumns(
        {"form": form, "__fim_cut": cut_pattern(F.least(first, second), F.greatest(first, second), unit)}
    )
    p, s, m = (_plainly(marker) for marker in markers.all)
    order = F.when(F.col("form") == SPM, f"{s}$3{p}$1{m}$2").otherwise(f"{p}$1{s}$3{m}$2")
    output = F.when(F.col("form") == PLAIN, F.col("__fim_text")).otherwise(
        F.regexp_replace("__fim_text", F.col("__fim_cut"), order)
    )
    rows = rows.withColumn("output", output)
    at = {marker: F.locate(marker, "output") for marker in markers.all}
    after_prefix = F.when(F.col("form") == SPM, at[markers.middle]).otherwise(at[markers.suffix])
    prefix = after_prefix - at[markers.prefix] - len(markers.prefix)
    middle = F.length("output") - at[markers.middle] - len(markers.middle) + 1
    changed = F.col("form") != PLAIN
    return rows.select(
        *[F.col(name).alias(column) for name, column in zip(held, [n for n in df.columns if n not in ADDED])],
        "n_units",
        "form",
        F.when(changed, prefix).cast("long").alias("prefix_chars"),
        F.when(changed, middle).cast("long").alias("middle_chars"),
        "output",
    )


def restore(output: str = "output", form: str = "form", markers: Markers = MARKERS) -> Column:
    """The text that an output was made from, rebuilt from the output and its form alone."""
    p, s, m = (re.escape(marker) for marker in markers.all)
    psm = F.regexp_replace(output, rf"(?s)\A{p}(.*?){s}(.*?){m}(.*)\z", "$1$3$2")
    spm = F.regexp_replace(output, rf"(?s)\A{s}(.*?){p}(.*?){m}(.*)\z", "$2$3$1")
    return F.when(F.col(form) == PSM, psm).when(F.col(form) == SPM, spm).otherwise(F.col(output))

"""Merkle manifest of a dataset, with hash states kept before each child slot.

A row's leaf is the SHA-256 of its fields. The leaves of a group (say, a language) stand in order, and every
`arity` consecutive nodes become one parent, the SHA-256 of their digests as text, until one node is left,
the subroot; subroots in order of their group become the root in the same way.

A parent keeps a copy of its hash state before each child slot. To fold a replaced child, the state of
its slot is resumed with the replacement and the siblings to its right only: what stands to its left is in
the state already.

Nothing grows beyond a bound in a task: leaves are numbered over range parts, `arity ** LEVELS` nodes
at a time make a subtree, and subtree tops are the nodes of the next round. On the way down each
subtree gets the runs above its top once (cogrouped with its nodes), never once a leaf. A subtree is
rebuilt from its digests alone, so the tasks of a lost executor give the same rows again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from curbline.session import freeze

ARITY = 8
LEVELS = 3

_GROUP, _POS, _CHUNK, _DIGEST, _COUNT = "__group", "__pos", "__chunk", "__digest", "__count"
_REPLACED = "__replaced"
_OWN = (_GROUP, _POS, _CHUNK, _DIGEST, _COUNT, _REPLACED)
FOLDED = ("subroot", "proof_sha256", "folded_root")
ADDED = (*FOLDED, "root", "verified")
_PATH = "array<struct<slot:int,run:array<string>>>"
_ROOT_GROUP = "all"


def framed(field: str | Column) -> Column:
    """`-` for a null, else the number of UTF-8 bytes of the value as text, a colon and the value."""
    value = (F.col(f"`{field}`") if isinstance(field, str) else field).cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaf_hash(fields: Sequence[str | Column]) -> Column:
    """SHA-256 of the fields, each framed, in lowercase hex."""
    return F.sha2(F.concat(*[framed(field) for field in fields]), 256)


class Parent:
    """An inner node: its digest, and the hash state before each of its child slots."""

    def __init__(self, children: list[bytes]) -> None:
        self.states, self.rights, self.siblings = [], [], []
        state = hashlib.sha256()
        for slot, child in enumerate(children):
            right = b"".join(children[slot + 1 :])
            self.states.append(state.copy())
            self.rights.append(right)
            self.siblings.append(b"".join(children[:slot]) + right)
            state.update(child)
        self.children = children
        self.digest = state.hexdigest().encode()

    def fold(self, slot: int, replacement: bytes) -> bytes:
        """The digest with the child of the slot replaced."""
        state = self.states[slot].copy()
        state.update(replacement + self.rights[slot])
        return state.hexdigest().encode()


class Subtree:
    """The nodes of one chunk and what they are folded into.

    `count` nodes of the group stand on the chunk's level: where they fill more than one chunk, every
    chunk has all of `levels` levels, else as many as it takes until one node is left.
    """

    def __init__(self, digests: list[bytes], count: int, arity: int, levels: int) -> None:
        self.arity, self.rows = arity, []
        whole = count > arity**levels
        while len(self.rows) < levels if whole else len(digests) > 1:
            row = [Parent(digests[i : i + arity]) for i in range(0, len(digests), arity)]
            self.rows.append(row)
            digests = [parent.digest for parent in row]
        self.top = digests[0]

    def path(self, i: int) -> Iterator[tuple[Parent, int]]:
        """The parents above node i, from the lowest, each with the slot on the way."""
        for row in self.rows:
            i, slot = divmod(i, self.arity)
            yield row[i], slot


def _sorted(nodes: pa.Table) -> pa.Table:
    return nodes.sort_by(_POS)


def _digests(nodes: pa.Table) -> list[bytes]:
    return [x.encode() for x in nodes[_DIGEST].to_pylist()]


def _tops(arity: int, levels: int) -> Callable[[pa.Table], pa.Table]:
    span = arity**levels

    def top(nodes: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        count = nodes[_COUNT][0].as_py()
        subtree = Subtree(_digests(nodes), count, arity, levels)
        return pa.table(
            {
                _GROUP: [nodes[_GROUP][0].as_py()],
                _POS: pa.array([nodes[_CHUNK][0].as_py()], pa.int64()),
                _DIGEST: [subtree.top.decode()],
                _COUNT: pa.array([-(-count // span)], pa.int64()),
            }
        )

    return top


_STEP = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.list_(pa.string()))]))


def _descend(arity: int, levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For each node of a chunk, the runs above it: those of its subtree, then those above the subtree."""

    def paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        subtree = Subtree(_digests(nodes), nodes[_COUNT][0].as_py(), arity, levels)
        rest = above["path"][0].as_py()
        found = [
            [{"slot": slot, "run": [x.decode() for x in parent.children]} for parent, slot in subtree.path(i)] + rest
            for i in range(nodes.num_rows)
        ]
        subroot = above["subroot"][0].as_py()
        return pa.table(
            {
                _GROUP: nodes[_GROUP],
                _POS: nodes[_POS],
                "subroot": pa.array([subroot] * nodes.num_rows, pa.string()),
                "path": pa.array(found, _STEP),
            }
        )

    return paths


def _verify(arity: int, levels: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def folded(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes = _sorted(nodes)
        subtree = Subtree(_digests(nodes), nodes[_COUNT][0].as_py(), arity, levels)
        upper = [(Parent([x.encode() for x in step["run"]]), step["slot"]) for step in above["path"][0].as_py()]
        proofs, roots = [], []
        for i, value in enumerate(nodes[_REPLACED].to_pylist()):
            node, proof = value.encode(), hashlib.sha256()
            for parent, slot in [*subtree.path(i), *upper]:
                node = parent.fold(slot, node)
                proof.update(parent.siblings[slot])
            roots.append(node.decode())
            proofs.append(proof.hexdigest())
        subroots = [above["subroot"][0].as_py()] * nodes.num_rows
        kept = nodes.drop_columns(list(_OWN))
        for name, values in zip(FOLDED, (subroots, proofs, roots)):
            kept = kept.append_column(name, pa.array(values, pa.string()))
        return kept

    return folded


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the sorted rows of one part within their groups."""
    group, n = None, 0
    for batch in batches:
        rows = []
        for name in batch.column(_GROUP).to_pylist():
            n = n + 1 if name == group else 0
            group = name
            rows.append(n)
        yield batch.append_column(_POS, pa.array(rows, pa.int64()))


def numbered(df: DataFrame, order: Sequence[str], arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Adds the position of each row in its group, the group's rows and the row's chunk.

    Rows are put into range parts, numbered there and shifted by what earlier parts hold of the group, so
    neither a group nor rows equal in all of `order` need to fit one task: equal rows are
    interchangeable, and their place in the frozen input parts them.
    """
    salted = df.withColumn("__salt", F.monotonically_increasing_id())
    keys = [_GROUP, *[f"`{name}`" for name in order], "__salt"]
    parts = salted.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__salt")
    parts = parts.withColumn("__part", F.spark_partition_id())
    schema = T.StructType([*parts.schema.fields, T.StructField(_POS, T.LongType())])
    placed = freeze(parts.mapInArrow(_number, schema))
    counts = placed.groupBy("__part", _GROUP).count()
    in_group = Window.partitionBy(_GROUP)
    before = in_group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = counts.select(
        "__part",
        _GROUP,
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__ahead"),
        F.sum("count").over(in_group).alias(_COUNT),
    )
    position = F.col(_POS) + F.col("__ahead")
    return (
        placed.join(ahead, ["__part", _GROUP])
        .withColumn(_POS, position)
        .withColumn(_CHUNK, F.floor(F.col(_POS) / F.lit(arity**levels)))
        .drop("__part", "__ahead")
    )


def _chunked(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    return nodes.withColumn(_CHUNK, F.floor(F.col(_POS) / F.lit(arity**levels)))


def _rise(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The nodes of each round, from the given ones to one node a group."""
    schema = f"{_GROUP} string, {_POS} long, {_DIGEST} string, {_COUNT} long"
    rounds, most = [nodes], nodes.agg(F.max(_COUNT)).first()[0] or 0
    while most > 1:
        few = rounds[-1].select(_GROUP, _POS, _CHUNK, _DIGEST, _COUNT)
        tops = few.groupBy(_GROUP, _CHUNK).applyInArrow(_tops(arity, levels), schema)
        rounds.append(freeze(_chunked(tops, arity, levels)))
        most = -(-most // arity**levels)
    return rounds


def _cogrouped(nodes: DataFrame, above: DataFrame, function: Callable, schema) -> DataFrame:
    above = above.withColumnRenamed(_POS, _CHUNK)
    return nodes.groupBy(_GROUP, _CHUNK).cogroup(above.groupBy(_GROUP, _CHUNK)).applyInArrow(function, schema)


def _fall(rounds: list[DataFrame], above: DataFrame, arity: int, levels: int) -> DataFrame:
    """The runs above each node of round 1 (or of the only round), from those above the last round's nodes."""
    schema = f"{_GROUP} string, {_POS} long, subroot string, path {_PATH}"
    for nodes in reversed(rounds[1:-1]):
        nodes = nodes.select(_GROUP, _POS, _CHUNK, _DIGEST, _COUNT)
        above = freeze(_cogrouped(nodes, above, _descend(arity, levels), schema))
    return above


@dataclass
class Manifest:
    """A tree over the rows of `leaves`, which holds the columns it was built from under the names in `held`.

    `above` has the runs above each chunk of leaves and `subroots` one row a group; `root` is None where there
    are no rows.
    """

    leaves: DataFrame
    held: dict[str, str]
    above: DataFrame
    subroots: DataFrame
    root: str | None
    arity: int
    levels: int


def build(
    df: DataFrame, leaf: str, group: str, order: str, arity: int = ARITY, levels: int = LEVELS
) -> Manifest:
    """The tree over the digests in column `leaf`: by group, in ascending order of `order`.

    Null groups are one group, which comes first; the others follow by their UTF-8 bytes. Rows with a null in `order` come
    first, and rows equal in it are ordered by digest, so that the tree depends on the rows only. Repeated
    rows are leaves of their own.
    """
    held = {name: f"__own{i}" for i, name in enumerate(df.columns)}
    key = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit(""))
    own = [F.col(f"`{name}`").alias(reserved) for name, reserved in held.items()]
    digests = freeze(df.select(*own, key.alias(_GROUP), F.col(f"`{leaf}`").alias(_DIGEST)))
    leaves = freeze(numbered(digests, [held[order], _DIGEST], arity, levels))
    rounds = _rise(leaves, arity, levels)
    subroots = rounds[-1].select(F.col(_GROUP).alias("group"), F.col(_DIGEST).alias("subroot"))
    tops = subroots.select(F.lit(_ROOT_GROUP).alias(_GROUP), "group", F.col("subroot").alias(_DIGEST))
    tops = freeze(numbered(tops, ["group"], arity, levels))
    upper = _rise(tops, arity, levels)
    last = upper[-1].select(_DIGEST).first()
    root = last[0] if last else None
    nothing = F.array().cast(_PATH)
    from_root = upper[-1].select(_GROUP, _POS, F.lit("").alias("subroot"), nothing.alias("path"))
    if len(upper) > 1:
        from_root = _fall(upper, from_root, arity, levels)
        schema = f"{_GROUP} string, {_POS} long, subroot string, path {_PATH}"
        few = tops.select(_GROUP, _POS, _CHUNK, _DIGEST, _COUNT)
        from_root = freeze(_cogrouped(few, from_root, _descend(arity, levels), schema))
    above = tops.select(_POS, F.col("group").alias("__of"), _DIGEST).join(from_root.select(_POS, "path"), _POS)
    above = above.select(F.col("__of").alias(_GROUP), F.lit(0).cast("long").alias(_POS), F.col(_DIGEST).alias("subroot"), "path")
    if len(rounds) > 1:
        above = _fall(rounds, above, arity, levels)
    return Manifest(leaves, held, above, subroots, root, arity, levels)


def fold(manifest: Manifest, replaced: str) -> DataFrame:
    """The rows of the manifest, its column `replaced` (digests, never null) folded up to the root, one row at a time.

    Adds subroot, root, proof_sha256 (the hash of all siblings on the way, from the lowest level up), folded_root
    (what the root is with this row's digest replaced) and verified (whether it is the root). Columns of the
    manifest with these names are replaced.
    """
    kept = {name: reserved for name, reserved in manifest.held.items() if name not in ADDED}
    own = [_GROUP, _POS, _CHUNK, _COUNT, _DIGEST]
    nodes = manifest.leaves.select(*kept.values(), *own, F.col(manifest.held[replaced]).alias(_REPLACED))
    added = [T.StructField(name, T.StringType()) for name in FOLDED]
    schema = T.StructType([*manifest.leaves.select(*kept.values()).schema.fields, *added])
    rows = _cogrouped(nodes, manifest.above, _verify(manifest.arity, manifest.levels), schema)
    root = F.lit(manifest.root).cast("string")
    return rows.select(
        *[F.col(reserved).alias(name) for name, reserved in kept.items()],
        *FOLDED,
        root.alias("root"),
        (F.col("folded_root") == root).alias("verified"),
    )

"""A Merkle manifest of a table: one root for all rows, proofs for every row, and folds that resume hash states.

A leaf is the SHA-256 of a row's fields, each as its length in bytes, a colon and its value, or ``-`` for null. Rows of one
group are ordered by id; every ``fan_out`` consecutive nodes become their digest, also the last ones where they are fewer, until
one node remains, the group's subroot. Subroots in the order of the groups (null first, then by bytes) give the root in the
same way. Digests are hashed as lower-case hexadecimal text.

Trees are built in blocks of ``fan_out ** levels`` consecutive nodes. A block is a task's unit: its rows come sorted, its tree is
held in memory, and the digest on top of it is a node of the next round. So a group with a third of all rows is many blocks,
and rounds grow with the logarithm of the rows. What stands above a block reaches it as one row: the siblings on the left and
on the right, per level.

Every parent keeps a copy of its hash state from before each child. A changed child is folded by resuming the copy in front of
its slot, with the replacement and the siblings on its right only; what is on the left is in the state.

A null group is a group of its own, rows without an id come first in their group, and rows that repeat an id are ordered by
their leaf; equal rows have equal leaves and share what is returned for them in any order. Null and empty fields differ. An
empty table has no rows and no root. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skytally.llm.shared import ranked, sorted_runs, stored, task_count

LEVELS = 12


def leaf_digest(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, in bytes."""
    written = [f.cast("string") for f in fields]
    parts = [F.coalesce(F.concat(F.octet_length(w).cast("string"), F.lit(":"), w), F.lit("-")) for w in written]
    return F.unhex(F.sha2(F.concat(*parts), 256))


class Tree:
    """The digests over some nodes, level by level, and the hash states before every child."""

    def __init__(self, nodes: list[bytes], fan_out: int, least_levels: int) -> None:
        self.fan_out, self.levels, self.states = fan_out, [nodes], []
        while len(self.levels[-1]) > 1 or len(self.states) < least_levels:
            parents, states = [], []
            for at in range(0, len(self.levels[-1]), fan_out):
                state, slots = hashlib.sha256(), []
                for child in self.levels[-1][at : at + fan_out]:
                    slots.append(state.copy())
                    state.update(child)
                parents.append(state.hexdigest().encode())
                states.append(slots)
            self.levels.append(parents)
            self.states.append(states)

    def siblings(self, at: int) -> list[tuple[bytes, bytes]]:
        """Per level, the digests on the left and on the right of the node's ancestor or itself."""
        out = []
        for nodes in self.levels[:-1]:
            first = at - at % self.fan_out
            out.append((b"".join(nodes[first:at]), b"".join(nodes[at + 1 : first + self.fan_out])))
            at //= self.fan_out
        return out

    def fold(self, at: int, node: bytes) -> bytes:
        """The top digest with another node at a place."""
        for nodes, states in zip(self.levels, self.states, strict=False):
            parent, slot = divmod(at, self.fan_out)
            state = states[parent][slot].copy()
            state.update(node)
            for right in nodes[at + 1 : (parent + 1) * self.fan_out]:
                state.update(right)
            node, at = state.hexdigest().encode(), parent
        return node


class Path:
    """What stands above a tree: hash states up to it, and the digests on its right, per level."""

    def __init__(self, siblings: list[tuple[bytes, bytes]]) -> None:
        self.steps = [(hashlib.sha256(left), right) for left, right in siblings]
        self.proof = b"".join(left + right for left, right in siblings)
        self._known: dict[bytes, bytes] = {}

    def fold(self, node: bytes) -> bytes:
        if node not in self._known:
            above = node
            for before, right in self.steps:
                state = before.copy()
                state.update(above)
                state.update(right)
                above = state.hexdigest().encode()
            self._known[node] = above
        return self._known[node]


def _tree_of(block: int, digests: list[bytes], fan_out: int, levels: int) -> Tree:
    # A first block that is not full is all there is: its tree ends where one node remains.
    alone = block == 0 and len(digests) < fan_out**levels
    return Tree([d.hex().encode() for d in digests], fan_out, 0 if alone else levels)


def _in_blocks(nodes: DataFrame, size: int) -> DataFrame:
    return nodes.withColumn("block", F.expr(f"pos div {size}"))


def _dealt(keyed: DataFrame) -> DataFrame:
    keys = ["tree", "block"]
    return keyed.repartition(task_count(keyed.sparkSession), *keys).sortWithinPartitions(*keys, "pos")


def _build_up(nodes: DataFrame, fan_out: int, levels: int) -> list[DataFrame]:
    """The nodes (``tree``, ``pos``, ``digest``) of every round, until each tree has one node."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, ["tree", "block"]):
            block = run.column("block")[0].as_py()
            top = _tree_of(block, run.column("digest").to_pylist(), fan_out, levels).levels[-1][0]
            row = [run.column("tree")[0].as_py()], [block], [bytes.fromhex(top.decode())]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["tree", "pos", "digest"])

    rounds = [nodes.select("tree", "pos", "digest")]
    while not rounds[-1].filter("pos > 0").isEmpty():
        up = _dealt(_in_blocks(rounds[-1], fan_out**levels)).mapInArrow(tops, "tree long, pos long, digest binary")
        rounds.append(stored(up, "merkle-level"))
    return rounds


def _with_paths(nodes: DataFrame, paths: DataFrame, size: int) -> DataFrame:
    """The nodes in blocks, each block led by the row of what stands above it."""
    heads = paths.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("long").alias("pos"), "above", "subroot")
    return _dealt(_in_blocks(nodes, size).unionByName(heads, allowMissingColumns=True))


def _split_head(run: pa.Table) -> tuple[list[tuple[bytes, bytes]], bytes | None, pa.Table]:
    above = run.column("above")[0].as_py()
    return list(zip(above[::2], above[1::2], strict=True)), run.column("subroot")[0].as_py(), run.slice(1)


def _go_down(rounds: list[DataFrame], top: DataFrame, fan_out: int, levels: int) -> DataFrame:
    """The paths (``tree``, ``pos``, ``above``: left, right, left, right, ..., and the ``subroot`` that was given to them) of the
    first round's nodes from those of the last."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, ["tree", "block"]):
            above, subroot, rows = _split_head(run)
            tree = _tree_of(run.column("block")[0].as_py(), rows.column("digest").to_pylist(), fan_out, levels)
            paths = [[d for pair in (*tree.siblings(i), *above) for d in pair] for i in range(rows.num_rows)]
            columns = [*(rows.column(c).combine_chunks() for c in ("tree", "pos")), pa.array(paths, pa.list_(pa.binary()))]
            columns.append(pa.array([subroot] * rows.num_rows, pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, ["tree", "pos", "above", "subroot"])

    paths = top
    for nodes in reversed(rounds[:-1]):
        paths = _with_paths(nodes, paths, fan_out**levels).mapInArrow(spread, "tree long, pos long, above array<binary>, subroot binary")
        paths = stored(paths, "merkle-paths")
    return paths


def build_manifest(
    df: DataFrame,
    *,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    fan_out: int = 2,
    replaced: Mapping[str, Column] | None = None,
    where: Column | None = None,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``leaf``, ``subroot`` of its group, ``root``, ``proof_sha256`` (of the siblings level by
    level, left to right), ``folded_root`` and ``verified``.

    ``folded_root`` is what the row folds to by its siblings with the fields in ``replaced`` changed ``where`` that holds, and
    as it is elsewhere; ``verified`` says whether that is the root. Texts are read once, hashed in the scan and never shuffled;
    rows of digests are shuffled three times.
    """
    if fan_out < 2:
        raise ValueError("a parent has at least two children")
    replaced = dict(replaced or {})
    leaf = leaf_digest([F.col(f) for f in fields])
    changed = leaf_digest([replaced.get(f, F.col(f)) for f in fields])
    where = F.lit(bool(replaced)) if where is None else F.coalesce(where, F.lit(False))
    leaves = df.select(
        F.col(group_col).alias("group"),
        F.col(id_col).alias("id"),
        leaf.alias("digest"),
        F.when(where, changed).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )
    by = [F.asc_nulls_first(c) for c in ("group", "id", "digest", "row")]
    placed = ranked(leaves, by, "merkle-leaves")
    heads = placed.groupBy("group").agg(F.min("rank").alias("first"))
    heads = stored(ranked(heads, [F.asc("first")], "merkle-groups"), "merkle-trees")
    heads = heads.select(F.col("group").alias("of"), "first", F.col("rank").alias("tree"))
    nodes = placed.join(heads, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("rank") - F.col("first")).alias("pos"), "id", "digest", "changed"
    )
    rounds = _build_up(nodes, fan_out, levels)
    subroots = rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), "digest")
    above_groups = _build_up(subroots, fan_out, levels)
    top = above_groups[-1].first()
    root = F.lit(top.digest.hex() if top else None).cast("string")
    start = above_groups[-1].select("tree", "pos", F.array().cast("array<binary>").alias("above"), F.lit(b"").alias("subroot"))
    paths = _go_down(above_groups, start, fan_out, levels).select(F.col("pos").alias("of"), "above")
    # The path of a subroot is that of the one node of its group's tree.
    paths = paths.join(rounds[-1], F.col("of") == F.col("tree")).select("tree", "pos", "above", F.col("digest").alias("subroot"))
    paths = _go_down(rounds[1:] or rounds, paths, fan_out, levels)
    kind = df.schema[id_col].dataType

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in sorted_runs(batches, ["tree", "block"]):
            above, subroot, rows = _split_head(run)
            digests = rows.column("digest").to_pylist()
            tree, path = _tree_of(run.column("block")[0].as_py(), digests, fan_out, levels), Path(above)
            proofs, folded = [], []
            for i, new in enumerate(rows.column("changed").to_pylist()):
                state = hashlib.sha256(b"".join(left + right for left, right in tree.siblings(i)))
                state.update(path.proof)
                proofs.append(state.hexdigest())
                node = tree.levels[0][i] if new is None else new.hex().encode()
                folded.append(path.fold(tree.fold(i, node)).decode())
            texts = [d.hex() for d in digests], [subroot.hex()] * len(digests), proofs, folded
            columns = [rows.column("id").combine_chunks(), *(pa.array(t, pa.string()) for t in texts)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "leaf", "subroot", "proof_sha256", "folded_root"])

    answered = _with_paths(nodes, paths, fan_out**levels).mapInArrow(
        answer, f"id {kind.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string"
    )
    return answered.select(
        F.col("id").alias(id_col),
        "leaf",
        "subroot",
        root.alias("root"),
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )

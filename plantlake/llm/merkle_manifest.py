"""Merkle manifest of a table: a tree of eights per group, and a tree of the groups' roots.

A leaf is the digest of a row's columns. Leaves of a group stand in order; while several nodes remain, every
eight consecutive ones (the last run may be shorter) become the digest of their digests, as hexadecimal text.

The leaves are sorted by ranges and numbered, so that they can be cut into aligned blocks of 8^4. One pass
over a block appends leaf after leaf (``Appender``): an appended leaf joins the open run of its level with an empty witness,
and whenever a run is complete, the witnesses of all leaves below each of its nodes are extended by the
node's siblings. Block roots are appended in the same way in the next round, blocks of block roots, until
each group has one root; these are appended in the order of their groups. Then the witnesses go
down again: what a block root got is added to the witnesses inside the block. No task holds more than a block, however
large its group is, and no group, level or list of roots passes through the driver.

A null group is the first one. The order column is a whole number. Null ones come first in their group, equal ones stand in the order of their leaves;
equal leaves are interchangeable. Further columns are ignored. An empty table has no rows and no root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from plantlake.llm.common import written

ARITY, LEVELS = 8, 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
Piece = tuple[bytes, bytes]


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def height(count: int) -> int:
    """Levels above ``count`` nodes until one remains."""
    levels = 0
    while ARITY ** levels < count:
        levels += 1
    return levels


class Appender:
    """Nodes in order, open runs of each level, and a growing witness for every node.

    A witness lists the digests left and right of the path, from the lowest level up."""

    def __init__(self):
        self.runs: list[list[tuple[bytes, int, int]]] = [[]]
        self.witnesses: list[list[Piece]] = []

    def append(self, node: bytes) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._join(0, node, at, at + 1)

    def _join(self, level: int, node: bytes, start: int, stop: int) -> None:
        if level == len(self.runs):
            self.runs.append([])
        self.runs[level].append((node, start, stop))
        if len(self.runs[level]) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.runs[level] = self.runs[level], []
        nodes = [node for node, _, _ in run]
        for k, (_, start, stop) in enumerate(run):
            piece = b"".join(nodes[:k]), b"".join(nodes[k + 1:])
            for witness in self.witnesses[start:stop]:
                witness.append(piece)
        self._join(level + 1, digest(b"".join(nodes)), run[0][1], run[-1][2])

    def root(self, levels: int) -> bytes:
        """Completes the short runs; the one node ``levels`` above the appended ones."""
        for level in range(levels):
            if self.runs[level]:
                self._complete(level)
        return self.runs[levels][0][0]


def folded(node: bytes, witness: list[Piece]) -> bytes:
    """Root that a node and its witness give."""
    for left, right in witness:
        node = digest(left + node + right)
    return node


def leaf_digest(columns: dict[str, Column]) -> Column:
    """Digest of values, each with its length in bytes before it, null as ``-``."""
    def said(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[said(c) for c in columns.values()]), 256)


def group_key(group: Column) -> Column:
    """Text that sorts as the group does, null first, and is never null."""
    return F.coalesce(F.concat(F.lit("v"), group.cast("string")), F.lit("n"))


def numbered(nodes: DataFrame, order: list[str], label: str) -> tuple[DataFrame, int]:
    """``nodes`` (``key``, ``node`` and others) with their rank in their key and ``total``, the key's number of nodes;
    and the largest ``total``."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Equal rows may stand in any order; the running number lets ranges cut between them.
    spread = nodes.withColumn("run", F.monotonically_increasing_id())
    placed = spread.repartitionByRange(parts, "key", *order, "run").sortWithinPartitions("key", *order, "run")

    def count(batches: Iterator[pa.RecordBatch]):
        part, current, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            at = []
            for key in batch.column("key").to_pylist():
                n = n + 1 if key == current else 0
                current = key
                at.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * len(at), pa.int32()), pa.array(at, pa.int64())],
                                             names=[*batch.schema.names, "part", "at"])

    fields = ", ".join(f"`{c}` {t}" for c, t in spread.dtypes)
    table = written(placed.mapInArrow(count, f"{fields}, part int, at long").drop("run"), label)
    sizes = table.groupBy("key", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range of the key
    offsets = sizes.select("key", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"),
                           F.sum("n").over(Window.partitionBy("key")).alias("total"))
    most = sizes.groupBy("key").agg(F.sum("n").alias("n")).agg(F.max("n")).first()[0]
    return table.join(offsets, ["key", "part"]).withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before"), most or 0


def blocks(nodes: DataFrame, carried: dict[str, str], levels: int, label: str) -> DataFrame:
    """A row per aligned block of ranked nodes: ``key``, ``block``, ``total`` (of the key's nodes), ``root``, ``node`` (all
    nodes in order) and the ``carried`` columns as arrays."""
    names = ["node", *carried]
    placed = nodes.select("key", F.floor(F.col("rank") / F.lit(ARITY ** levels)).cast("long").alias("block"), "rank", "total", *names)
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = placed.repartition(parts, "key", "block").sortWithinPartitions("key", "block", "rank")
    kinds = {"node": "string", **carried}

    def gather(batches):
        head, held = None, []

        def row():
            key, block, total = head
            appended = Appender()
            for r in held:
                appended.append(r[0].encode())
            root = appended.root(levels_of(total, levels))
            return {"key": key, "block": block, "total": total, "root": root.decode()} | {c: [r[k] for r in held] for k, c in enumerate(names)}

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "block", "total", *names)]
            for key, block, total, *rest in zip(*columns):
                if (key, block, total) != head:
                    if held:
                        yield pa.RecordBatch.from_pylist([row()], schema(batch))
                    head, held = (key, block, total), []
                held.append(rest)
            last = schema(batch)
        if held:
            yield pa.RecordBatch.from_pylist([row()], last)

    def schema(batch):
        return pa.schema([("key", pa.string()), ("block", pa.int64()), ("total", pa.int64()), ("root", pa.string()),
                          *((c, pa.list_(batch.schema.field(c).type)) for c in names)])

    return written(placed.mapInArrow(gather, "key string, block long, total long, root string, "
                                     + ", ".join(f"`{c}` array<{kinds[c]}>" for c in names)), label)


def levels_of(total: int, levels: int) -> int:
    """Levels that a block of 8^``levels`` is closed by, of a key with ``total`` nodes."""
    return min(height(total), levels)


def climbed(nodes: DataFrame, carried: dict[str, str], most: int, levels: int, label: str) -> list[DataFrame]:
    """Blocks of the nodes, blocks of their roots and so on, up to one block per key. ``most``: the largest ``total``."""
    rounds = [blocks(nodes, carried, levels, f"{label}-0")]
    while most > ARITY ** levels:
        most = -(-most // ARITY ** levels)
        below = rounds[-1].select("key", F.col("block").alias("rank"), F.ceil(F.col("total") / F.lit(ARITY ** levels)).cast("long").alias("total"),
                                  F.col("root").alias("node"))
        rounds.append(blocks(below, {}, levels, f"{label}-{len(rounds)}"))
    return rounds


WITNESS = "array<struct<left:binary,right:binary>>"


_ABOVE = [("above", pa.list_(pa.struct([("left", pa.binary()), ("right", pa.binary())]))), ("subroot", pa.string()), ("root", pa.string())]


def single_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time; each holds a block."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def reopened(row: dict, levels: int) -> Appender:
    """The nodes of a stored block, appended anew for their witnesses."""
    made = Appender()
    for node in row["node"]:
        made.append(node.encode())
    made.root(levels_of(row["total"], levels))
    return made


def _extended(own: list[Piece], above: list[dict]) -> list[dict]:
    return [{"left": a, "right": b} for a, b in own] + above


def handed_down(rounds: list[DataFrame], witness: DataFrame, levels: int) -> DataFrame:
    """Lowest blocks with what lies above each: ``witness`` has a row per key of ``above, subroot, root``."""
    above = witness.withColumn("block", F.lit(0).cast("long"))
    for table in reversed(rounds[1:]):
        def spread(batches):
            for r in single_rows(batches):
                made, first = reopened(r, levels), r["block"] * ARITY ** levels
                rows = [{"key": r["key"], "block": first + k, "above": _extended(own, r["above"]), "subroot": r["subroot"], "root": r["root"]}
                        for k, own in enumerate(made.witnesses)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("key", pa.string()), ("block", pa.int64()), *_ABOVE]))

        joined = table.drop("root").join(above, ["key", "block"])
        above = joined.mapInArrow(spread, f"key string, block long, above {WITNESS}, subroot string, root string")
    return rounds[0].drop("root").join(above, ["key", "block"])


def manifest(table: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "lang", order: str = "doc_id",
             tampered: dict[str, Column] | None = None, tampered_where: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``(order column, leaf, subroot, root, proof_sha256, folded_root, verified)`` for every row. ``tampered`` replaces columns of
    the rows ``tampered_where``; their ``folded_root`` starts from the leaf of the changed row. A block has
    8^``levels`` nodes."""
    spark = table.sparkSession
    plain = {c: table[c] for c in columns}
    changed = leaf_digest(plain | (tampered or {}))
    leaves = table.select(group_key(table[group]).alias("key"), table[order].cast("long").alias("id"), leaf_digest(plain).alias("node"),
                          F.when(F.lit(False) if tampered_where is None else tampered_where, changed).alias("changed"))
    ranked, most = numbered(leaves, ["id", "node"], "merkle-leaves")
    out = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if not most:
        return spark.createDataFrame([], out).withColumnRenamed("id", order)
    rounds = climbed(ranked, {"id": "long", "changed": "string"}, most, levels, "merkle-blocks")
    subroots = rounds[-1].select("key", F.col("root").alias("node"))

    # The groups' roots are the nodes of one more tree, whose nodes are carried with their groups.
    groups, count = numbered(subroots.select(F.lit("").alias("key"), F.col("key").alias("name"), "node"), ["name"], "merkle-groups")
    top = climbed(groups, {"name": "string"}, count, levels, "merkle-top")
    start = top[-1].select("key", F.expr(f"cast(array() as {WITNESS})").alias("above"), F.lit("").alias("subroot"), "root")

    def per_group(batches):
        for r in single_rows(batches):
            yield pa.RecordBatch.from_pylist(
                [{"key": name, "above": _extended(own, r["above"]), "subroot": node, "root": r["root"]}
                 for name, node, own in zip(r["name"], r["node"], reopened(r, levels).witnesses)], pa.schema([("key", pa.string()), *_ABOVE]))

    witness = handed_down(top, start, levels).mapInArrow(per_group, f"key string, above {WITNESS}, subroot string, root string")

    def proofs(batches):
        for r in single_rows(batches):
            proof, again = [], []
            above = [(p["left"], p["right"]) for p in r["above"]]
            for node, other, own in zip(r["node"], r["changed"], reopened(r, levels).witnesses):
                path = own + above
                proof.append(hashlib.sha256(b"".join(a + b for a, b in path)).hexdigest())
                again.append(folded((node if other is None else other).encode(), path).decode())
            n = len(proof)
            yield pa.RecordBatch.from_arrays(
                [pa.array(r["id"], pa.int64()), pa.array(r["node"]), pa.array([r["subroot"]] * n), pa.array([r["root"]] * n), pa.array(proof),
                 pa.array(again), pa.array([x == r["root"] for x in again])],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return handed_down(rounds, witness, levels).mapInArrow(proofs, out).withColumnRenamed("id", order)

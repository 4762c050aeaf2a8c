"""A Merkle manifest of a table: a tree per group of rows, a tree over the groups, proofs for all rows."""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import saved

ARITY = 16
LEVELS = 3  # folded in one pass
SPAN = ARITY**LEVELS
ROW_BITS = 33
OUT_ROWS = 4096

Path = list[tuple[int, bytes]]  # from the leaf up: place in the run, digests of the run

NODE = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("of", T.LongType()),
        T.StructField("digest", T.BinaryType()),
    ]
)
STEP = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("run", T.BinaryType())])
MESSAGE = T.StructType(
    [
        T.StructField("tree", T.StringType()),
        T.StructField("at", T.LongType()),
        T.StructField("subroot", T.BinaryType()),
        T.StructField("root", T.BinaryType()),
        T.StructField("path", T.ArrayType(STEP)),
    ]
)


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values one after another, each as its count of UTF-8 bytes, a colon and itself; a null is ``-``."""
    texts = [v.cast("string") for v in values]
    parts = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def node_digest(run: bytes) -> bytes:
    """SHA-256 of the hex texts of a run of digests."""
    return hashlib.sha256(run.hex().encode()).digest()


def levels_of(nodes: int) -> int:
    """Levels that one pass folds of a tree with so many nodes left."""
    if nodes > SPAN:
        return LEVELS
    levels = 0
    while nodes > 1:
        nodes = -(-nodes // ARITY)
        levels += 1
    return levels


def climb(digests: Sequence[bytes], levels: int) -> list[list[bytes]]:
    """The digests of every level of a block, the given ones first.

    Time-forward: nodes are worked on by their label (level, number). A node sends its digest to
    its parent's label by a priority queue, and a parent finds all its children's at the head of
    the queue when its turn comes.
    """
    found: list[list[bytes]] = [list(digests)] + [[] for _ in range(levels)]
    queue = [(1, i // ARITY, i, d) for i, d in enumerate(digests)] if levels else []
    while queue:
        level, number = queue[0][:2]
        run = b""
        while queue and queue[0][:2] == (level, number):
            run += heapq.heappop(queue)[3]
        own = node_digest(run)
        found[level].append(own)
        if level < levels:
            heapq.heappush(queue, (level + 1, number // ARITY, number, own))
    return found


def descend(found: Sequence[Sequence[bytes]], above: Path) -> Iterator[tuple[int, Path]]:
    """(number, path) of the nodes of the lowest level, from the last to the first.

    The sweep of ``climb`` reversed: a node takes its path from the queue, puts the run of its
    children before it and sends that to each child.
    """
    queue = [(-(len(found) - 1), -i, above) for i in range(len(found[-1]))]
    heapq.heapify(queue)
    while queue:
        level, number, path = heapq.heappop(queue)
        level, number = -level, -number
        if not level:
            yield number, path
            continue
        children = found[level - 1][number * ARITY : (number + 1) * ARITY]
        run = b"".join(children)
        for k in range(len(children)):
            heapq.heappush(queue, (1 - level, -(number * ARITY + k), [(k, run), *path]))


def siblings(path: Path) -> list[bytes]:
    """The other digests of every run, as one text per level."""
    return [(run[: 32 * k] + run[32 * k + 32 :]).hex().encode() for k, run in path]


def folded(leaf: bytes, path: Path) -> bytes:
    """The root that a leaf and its siblings lead to."""
    for k, run in path:
        leaf = node_digest(run[: 32 * k] + leaf + run[32 * k + 32 :])
    return leaf


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[tuple]]]:
    """((tree, block), rows) of rows that come sorted by these, their first two columns."""
    rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
    return groupby(rows, itemgetter(0, 1))


def _block(at: str) -> Column:
    return F.expr(f"{at} div {SPAN}")


def numbered(rows: DataFrame, tree: str, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``at``, their number in the tree by ``order``, and ``of``, the tree's rows.

    One sort by range, which may cut a tree anywhere, is written with each row's place; then
    rows are counted by (part, tree), which are about as many as parts and trees together.
    """
    rows = rows.sort(tree, *order).withColumn("_row", F.monotonically_increasing_id())
    rows = saved(rows, "merkle-sorted").withColumn("_part", F.shiftright("_row", ROW_BITS))
    over = Window.partitionBy(tree)
    counts = rows.groupBy("_part", tree).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    before = F.sum("_n").over(over.orderBy("_part")) - F.col("_n")
    counts = counts.select("_part", tree, (before - F.col("_first")).alias("_shift"), F.sum("_n").over(over).alias("of"))
    return rows.join(counts, ["_part", tree]).withColumn("at", F.col("_row") + F.col("_shift")).drop("_part", "_row", "_shift")


def climbed(nodes: DataFrame) -> list[DataFrame]:
    """The nodes (tree, at, of, digest) after no, one, two, ... passes, until one is left of every tree.

    A pass sends the digests to the label of the block they end in, at most ``SPAN`` of them:
    the exchange with its sort is the part of the queue that outgrows a task.
    """
    arrow = to_arrow_schema(NODE)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, block), own in _blocks(batches):
                given = list(own)
                of = given[0][3]
                top = climb([r[4] for r in given], levels_of(of))[-1]
                yield tree, block, -(-of // SPAN), top[0]

        yield from _batches(rows(), arrow)

    tables = [nodes]
    while (tables[-1].agg(F.max("of")).first()[0] or 0) > 1:
        sent = tables[-1].select("tree", _block("at").alias("block"), "at", "of", "digest")
        swept = sent.repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(sweep, NODE)
        tables.append(saved(swept, "merkle-nodes"))
    return tables


def delivered(
    nodes: DataFrame, messages: DataFrame, schema: T.StructType, finish: Callable[[tuple, bytes, bytes, bytes, Path], tuple]
) -> DataFrame:
    """One pass back: the messages of blocks, (tree, at, subroot, root, path), go on to the nodes in them.

    ``finish`` makes a row of ``schema`` from (further columns of the node, digest, subroot, root, path).
    """
    more = [c for c in nodes.columns if c not in NODE.names]
    arrow = to_arrow_schema(schema)

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (tree, block), own in _blocks(batches):
                _, _, _, _, _, subroot, root, above, *_ = next(own)  # sorts before the nodes
                given = list(own)
                found = climb([r[4] for r in given], levels_of(given[0][3]))
                path = [(s["place"], s["run"]) for s in above]
                for i, way in descend(found, path):
                    _, _, at, _, digest, _, _, _, *rest = given[i]
                    yield finish((tree, at, *rest), digest, subroot, root, way)

        yield from _batches(rows(), arrow)

    sent = messages.select("tree", F.col("at").alias("block"), F.lit(-1).cast("long").alias("at"), "subroot", "root", "path")
    sent = nodes.withColumn("block", _block("at")).unionByName(sent, allowMissingColumns=True)
    sent = sent.select("tree", "block", "at", "of", "digest", "subroot", "root", "path", *more)
    return sent.repartition("tree", "block").sortWithinPartitions("tree", "block", "at").mapInArrow(sweep, schema)


def _on(rest: tuple, digest: bytes, subroot: bytes, root: bytes, path: Path) -> tuple:
    """A message to a node of the next pass; those of the tree over the groups make their own digest the subroot."""
    return rest[0], rest[1], subroot, root, path


def merkle_manifest(
    docs: DataFrame,
    columns: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    claimed: Mapping[str, Column] | None = None,
    proofs: bool = False,
    id_col: str = "doc_id",
    group_col: str = "source",
) -> DataFrame:
    """Digests, roots and proofs of all rows.

    The leaf of a row is ``leaf_digest`` of ``columns``. The leaves of a group, by ascending id
    (null first, equal ids by digest), are the lowest level of its tree; while there are several
    nodes, each 16 consecutive ones become one, also a last run of fewer or of one. The nodes
    left, by group (null first, then by UTF-8 bytes), are joined likewise to the root. A proof
    holds the other digests of each run, from the leaf up to the root.

    ``claimed`` gives other values for some columns; ``folded_root`` is the root that the leaf
    of those leads to with the proof as it stands, and ``verified`` says whether it is the root.

    Returns (id, leaf, subroot, root, proof_sha256, folded_root, verified), digests as hex, and
    with ``proofs`` also ``proof``, per level the place in the run and the siblings' hex texts
    joined. Rows that are equal have leaves of their own. Other columns are left out; an empty
    table gives no rows.

    Up and down, one pass over 4096 times fewer nodes follows the other, so all but the first
    are small, and their number grows with the logarithm of the largest group.
    """
    claims = dict(claimed or {})
    group = F.col(group_col).cast("string")
    own = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([claims.get(c, F.col(c)) for c in columns])
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"),
        own.alias("digest"),
        F.nullif(other, own).alias("claim") if claims else F.lit(None).cast("binary").alias("claim"),
        F.monotonically_increasing_id().alias("line"),
    )
    leaves = saved(leaves, "merkle-leaves")
    leaves = saved(numbered(leaves, "tree", ["id", "digest", "line"]).drop("line"), "merkle-leaves")

    trees = climbed(leaves.select(*NODE.names))
    groups = trees[-1].select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    groups = saved(numbered(groups, "tree", ["name"]), "merkle-groups")
    tops = climbed(groups.select(*NODE.names))

    messages = tops[-1].select("tree", "at", "digest", F.col("digest").alias("root"), F.array().cast(T.ArrayType(STEP)).alias("path"))
    messages = messages.withColumnRenamed("digest", "subroot")
    for nodes in reversed(tops[1:-1]):
        messages = saved(delivered(nodes, messages, MESSAGE, _on), "merkle-paths")
    messages = delivered(groups, messages, MESSAGE, lambda rest, digest, subroot, root, path: (rest[2], 0, digest, root, path))
    messages = saved(messages, "merkle-paths")
    for nodes in reversed(trees[1:-1]):
        messages = saved(delivered(nodes, messages, MESSAGE, _on), "merkle-paths")

    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType)] + [T.StructField(c, T.StringType()) for c in names])
    proof = T.StructType([T.StructField("place", T.IntegerType()), T.StructField("siblings", T.StringType())])
    if proofs:
        schema = schema.add("proof", T.ArrayType(proof))

    def finish(rest: tuple, digest: bytes, subroot: bytes, root: bytes, path: Path) -> tuple:
        _, _, own_id, claim = rest
        levels = siblings(path)
        told = hashlib.sha256(b"".join(levels)).hexdigest()
        row = (own_id, digest.hex(), subroot.hex(), root.hex(), told, folded(claim or digest, path).hex())
        return (*row, [(k, s.decode()) for (k, _), s in zip(path, levels)]) if proofs else row

    found = delivered(leaves, messages, schema, finish)
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))

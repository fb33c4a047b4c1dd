"""Merkle manifest of a table with a witness for every row.

Leaves of a tree stand in order; every ``ARITY`` consecutive nodes (the last
run: fewer, even one) become a node of the next level until one is left. The
roots of all trees, in tree order, are reduced likewise to the manifest's root.

Witnesses grow while nodes are appended. A task streams an aligned block of
``BLOCK`` leaves through an ``Appender``: a node that is appended to an open run
starts its partial witness with the siblings to its left and extends the
partial witnesses of these; a run that is full closes, hands its witnesses
down to the leaves below and is appended one level up. The blocks' roots are
the leaves of the next round, in blocks again, and their witnesses extend those
of all leaves below by one join on the block. The trees' roots are appended in
the same way. So there are log(n) / log(BLOCK) rounds, no task holds more than
a block, and the driver sees one row a round (whether a tree is still open).

A witness is bytes: for every level the place of the node in its run, the
length of the run, then the 32-byte digests of the run's others in order.
``fold`` recomputes a root from a leaf and its witness.

Defined cases: rows without an id come first in their tree; rows that agree in
id stand in order of their digests, equal rows in any order (they have equal
leaves); a null tree comes first and is a tree of its own; a null cell counts
as "-"; empty and very long texts are hashed like others, in place (texts are
never shuffled); an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from implicit_rank.llm import common

ARITY = 8
LEVELS = 3                # levels that one block closes
BLOCK = ARITY ** LEVELS
DIGEST = 32


def sha256_hex(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def cell(column: Column) -> Column:
    """A value as it goes into a leaf: its length in bytes, a colon, the value; "-" if null."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    """The leaf digest of a row as binary."""
    return F.unhex(F.sha2(F.concat(*(cell(c) for c in columns)).cast("binary"), 256))


class Appender:
    """Streaming append of one block's leaves: open runs by level, witnesses of all leaves."""

    def __init__(self, leaves: int, levels: int | None):
        self.levels = levels              # how many levels close; None: until one node is left
        self.witness = [b""] * leaves
        self.runs: list[list] = [[]]      # open nodes by level: [hex, raw, partial witness, first leaf]
        self.count = 0

    def append(self, raw: bytes) -> None:
        self._append(0, raw.hex().encode(), raw, self.count)
        self.count += 1

    def _append(self, level: int, digest: bytes, raw: bytes, first: int) -> None:
        if level == len(self.runs):
            self.runs.append([])
        run = self.runs[level]
        if len(run) == ARITY:             # full, and now it has a successor: its parent goes one level up
            self._close(level, first)
        partial = bytearray().join(node[1] for node in run)
        for node in run:                  # the earlier siblings' witnesses learn of this node
            node[2] += raw
        run.append([digest, raw, partial, first])

    def _close(self, level: int, last: int) -> None:
        run = self.runs[level]            # its leaves end before ``last``
        ends = [node[3] for node in run[1:]] + [last]
        for place, (node, end) in enumerate(zip(run, ends)):
            step = bytes((place, len(run))) + bytes(node[2])
            for i in range(node[3], end):
                self.witness[i] += step
        parent = sha256_hex(b"".join(node[0] for node in run))
        first = run[0][3]
        run.clear()
        self._append(level + 1, parent, bytes.fromhex(parent.decode()), first)

    def finish(self) -> bytes:
        """Close what is open, the last runs short, and return the block's root."""
        level = 0
        while True:
            top = level + 1 >= len(self.runs)
            if level == self.levels or self.levels is None and top and len(self.runs[level]) == 1:
                return self.runs[level][0][1]
            self._close(level, self.count)
            level += 1


def _append_blocks(layer: DataFrame) -> DataFrame:
    """``layer`` (tree, pos, n, digest, ...) with block, witness and, on a block's first row, its root."""
    kept = layer.columns
    dealt = (layer.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
             .repartition("tree", "block").sortWithinPartitions("tree", "block", "pos"))

    def close(rows: pa.Table) -> pa.RecordBatch:
        """Rows of whole blocks."""
        blocks, pos, n = (rows.column(c).to_pylist() for c in ("block", "pos", "n"))
        digests = rows.column("digest").to_pylist()
        witness, roots, start = [], [None] * len(pos), 0
        while start < len(pos):
            size = min(BLOCK, n[start] - blocks[start] * BLOCK)
            work = Appender(size, LEVELS if n[start] > BLOCK else None)
            for raw in digests[start:start + size]:
                work.append(raw)
            roots[start] = work.finish()
            witness += work.witness
            start += size
        columns = [common.one_array(rows.column(c)) for c in [*kept, "block"]]
        return pa.RecordBatch.from_arrays([*columns, pa.array(witness, pa.binary()), pa.array(roots, pa.binary())],
                                          names=[*kept, "block", "witness", "root"])

    def run(batches):
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows])
            # the last row's block may go on in the next batch
            pos, n = held.column("pos")[-1].as_py(), held.column("n")[-1].as_py()
            open_rows = pos % BLOCK + 1 if pos + 1 < n and (pos + 1) % BLOCK else 0
            if held.num_rows > open_rows:
                yield close(held.slice(0, held.num_rows - open_rows))
                held = held.slice(held.num_rows - open_rows) if open_rows else None
        if held is not None and held.num_rows:
            yield close(held)

    schema = ", ".join(f"{name} {kind}" for name, kind in layer.dtypes)
    return dealt.mapInArrow(run, f"{schema}, block long, witness binary, root binary")


def _build(layer: DataFrame, name: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows with their witness inside the block, (tree, block, above), (tree, root) of every tree).

    ``above`` is the witness of a block's root up to its tree's root.
    """
    rows = common.save(_append_blocks(layer), name)
    closed = rows.filter("root IS NOT NULL")
    whole = closed.filter(f"n <= {BLOCK}").select("tree", "root")
    blocks = closed.filter(f"n > {BLOCK}").select(
        "tree", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), F.col("root").alias("digest"))
    above = whole.select("tree", F.lit(0).cast("long").alias("block"), F.lit(b"").alias("above"))
    if not blocks.limit(1).count():
        return rows, above, whole
    inner, upper, roots = _build(blocks, name)
    higher = inner.join(upper, ["tree", "block"]).select("tree", F.col("pos").alias("block"), F.concat("witness", "above").alias("above"))
    return rows, above.unionByName(higher), whole.unionByName(roots)


def manifest(rows: DataFrame, tree: str, order: list[str], digest: str = "leaf") -> DataFrame:
    """``rows`` with witness (to the root), subroot and root (binary digests).

    ``digest`` names the leaves (binary), ``tree`` the column that parts them,
    ``order`` the columns that order them; ties go by digest. Further columns
    are carried along; those called witness, subroot or root are replaced.
    """
    carried = [c for c in rows.columns if c not in (digest, "witness", "subroot", "root")]
    inner = rows.select(F.struct(*(F.col(c).alias(c) for c in carried)).alias("row"),
                        F.when(F.col(tree).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(tree).cast("string"))).alias("tree"),
                        F.col(digest).alias("digest"), *(F.col(c).alias(f"o{i}") for i, c in enumerate(order)))
    keys = [f"o{i}" for i in range(len(order))]
    placed = common.placed(inner, "tree", [*keys, "digest"], "merkle-leaves").drop(*keys)
    leaves, above, roots = _build(placed, "merkle")
    subroots = common.save(roots, "merkle-subroots")
    top = common.placed(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")),
                  "tree", ["name"], "merkle-trees")
    trees, over, root = _build(top, "merkle-top")
    trees = (trees.drop("root").join(over, ["tree", "block"]).join(root, "tree")
             .select(F.col("name").alias("tree"), F.col("digest").alias("subroot"),
                     F.concat("witness", "above").alias("over"), "root"))
    blocks = above.join(trees, "tree").select("tree", "block", F.concat("above", "over").alias("rest"), "subroot", F.col("root").alias("whole"))
    return (leaves.join(common.save(blocks, "merkle-blocks"), ["tree", "block"])
            .select("row.*", F.col("digest").alias(digest), F.concat("witness", "rest").alias("witness"),
                    "subroot", F.col("whole").alias("root")))


def steps(witness: bytes):
    """(place, siblings) of each level of a witness."""
    at = 0
    while at < len(witness):
        place, size = witness[at], witness[at + 1]
        end = at + 2 + (size - 1) * DIGEST
        yield place, witness[at + 2:end]
        at = end


def fold(digest: bytes, witness: bytes) -> bytes:
    """The root that follows from a leaf's digest and its witness."""
    now = digest.hex()
    for place, others in steps(witness):
        cut = place * DIGEST
        now = hashlib.sha256((others[:cut].hex() + now + others[cut:].hex()).encode()).hexdigest()
    return bytes.fromhex(now)


def proof_digest(witness: bytes) -> bytes:
    """SHA-256 of the hexadecimal siblings of all levels."""
    return hashlib.sha256("".join(others.hex() for _, others in steps(witness)).encode()).digest()


def check(rows: DataFrame, digest: str) -> DataFrame:
    """``rows`` of a manifest with proof (binary), folded (the root that ``digest`` gives) and verified."""
    kept = rows.columns

    def run(batches):
        for batch in batches:
            witness = batch.column("witness").to_pylist()
            folded = [fold(d, w) for d, w in zip(batch.column(digest).to_pylist(), witness)]
            same = [a == b for a, b in zip(folded, batch.column("root").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(map(proof_digest, witness), pa.binary()), pa.array(folded, pa.binary()), pa.array(same, pa.bool_())],
                names=[*kept, "proof", "folded", "verified"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(run, f"{schema}, proof binary, folded binary, verified boolean")

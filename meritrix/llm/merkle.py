"""Merkle manifest of a table: one root, and a witness for every row.

Rows are leaves of one 16-ary tree per group, and the groups' roots are leaves of
one more tree. Leaves are numbered in order and appended to aligned blocks of 4,096,
one task a block at a time. A run of siblings that is complete closes into its
parent; the runs below it wait in open subtrees with partial witnesses, and each
later completion of their siblings extends them. A block's root is a further append
in the next round, so a group of any size is spread over its blocks, and a round
divides the number of nodes by 4,096. Last, the blocks' own witnesses, which are few,
extend those of the runs below them from the top down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meritrix.llm.tasks import forget_state, share_code
from meritrix.session import stored

#: Children of a node, and by default the levels that a block holds.
WIDTH, HEIGHT = 16, 3
#: A level of a witness: the place among the siblings, and the others' digests in order.
STEP = "struct<at: int, others: binary>"
PATH = f"array<{STEP}>"
_ARROW_PATH = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.binary())]))


def leaf(columns: Iterable[str | Column]) -> Column:
    """The digest of a row (32 bytes): of each column ``-`` if null, else its UTF-8
    byte count, a colon and its value as text."""
    texts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    parts = [F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]
    return F.unhex(F.sha2(F.concat(*parts).cast("binary"), 256))


def node(children: list[bytes]) -> bytes:
    """The digest of siblings: over their digests as lowercase hex."""
    return hashlib.sha256(b"".join(children).hex().encode()).digest()


def group_key(group: str) -> Column:
    """A key without nulls in the order of the groups: null first, then bytewise."""
    return F.when(F.col(group).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group).cast("string")))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Rows of (group, ..) with their ``index`` inside the group, in the given order,
    nulls first. A range partitioning sorts them; equal rows are told apart by their
    arrival, so that many copies of one row still spread. Only one count per
    partition and group is needed to tell where each partition's part begins."""
    by = [F.col("group").asc(), *(F.col(c).asc_nulls_first() for c in order), F.col("arrival").asc()]
    placed = rows.withColumn("arrival", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*by).sortWithinPartitions(*by).drop("arrival")
    place = F.monotonically_increasing_id()  # the partition in the upper bits, the place in it in the lower 33
    placed = stored(placed.withColumn("place", place))
    placed = placed.withColumns({"part": F.shiftright("place", 33), "place": F.col("place").bitwiseAND((1 << 33) - 1)})
    parts = placed.groupBy("group", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    earlier = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("group", "part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("base"))
    return placed.join(base, ["group", "part"]).withColumn("index", F.col("place") + F.col("base")).drop("part", "place", "base")


class _Block:
    """Appends nodes to one aligned block; ``runs`` are its lowest siblings, each
    with the witness of its parent inside the block."""

    def __init__(self, number: int, height: int):
        self.number, self.height, self.n, self.runs = number, height, 0, []
        self.open: list[list[bytes]] = [[] for _ in range(height + 1)]
        self.below: list[list[list]] = [[] for _ in range(height + 1)]  # runs below each open node
        self.items: list = []

    def append(self, digest: bytes, item) -> None:
        self.n += 1
        self.open[0].append(digest)
        self.items.append(item)
        level = 0
        while level < self.height and len(self.open[level]) == WIDTH:
            self.close(level)
            level += 1

    def close(self, level: int) -> None:
        """Siblings are complete: their parent is appended one level higher, and
        the witnesses that wait below them grow by one step."""
        siblings, self.open[level] = self.open[level], []
        if not siblings:
            return
        if level == 0:
            waiting = [{"nodes": siblings, "items": self.items, "path": []}]
            self.runs += waiting
            self.items = []
        else:
            waiting = []
            for at, runs in enumerate(self.below[level]):
                step = {"at": at, "others": b"".join(siblings[:at] + siblings[at + 1:])}
                for run in runs:
                    run["path"].append(step)
                waiting += runs
            self.below[level] = []
        self.open[level + 1].append(node(siblings))
        self.below[level + 1].append(waiting)

    def finish(self) -> tuple[int, bytes]:
        """Closes what is open: all levels where the group goes on in other blocks,
        else until one node is left. A block that is not full and comes first is
        the only one of its group. Returns the levels and the block's root."""
        levels = self.height
        if self.number == 0:
            levels = next(h for h in range(self.height + 1) if self.n <= WIDTH ** h)
        for level in range(levels):
            self.close(level)
        if levels == 0:  # a lone node stands for itself
            self.runs = [{"nodes": self.open[0], "items": self.items, "path": []}]
        return levels, self.open[levels][0]


def _grow(nodes: DataFrame, height: int) -> DataFrame:
    """One round: rows (group, index, node, item) to runs (group, block, run, levels,
    nodes, items, path, root)."""
    item = nodes.schema["item"].dataType
    schema = (f"group string, block bigint, run int, levels int, nodes array<binary>, items array<{item.simpleString()}>, "
              f"path {PATH}, root binary")
    dealt = nodes.select("group", F.expr(f"index div {WIDTH ** height}").alias("block"), "index", "node", "item")
    dealt = dealt.repartition("group", "block").sortWithinPartitions("group", "block", "index")

    def rows(key, block: _Block, items: pa.DataType) -> pa.RecordBatch:
        levels, root = block.finish()
        n = len(block.runs)
        column = lambda name: [run[name] for run in block.runs]
        return pa.RecordBatch.from_arrays(
            [pa.array([key] * n, pa.string()), pa.array([block.number] * n, pa.int64()), pa.array(range(n), pa.int32()),
             pa.array([levels] * n, pa.int32()), pa.array(column("nodes"), pa.list_(pa.binary())),
             pa.array(column("items"), pa.list_(items)), pa.array(column("path"), _ARROW_PATH), pa.array([root] * n, pa.binary())],
            ["group", "block", "run", "levels", "nodes", "items", "path", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        at, block, items = None, None, None
        for batch in batches:
            items = batch.schema.field("item").type
            columns = (batch.column(c).to_pylist() for c in ("group", "block", "node", "item"))
            for group, number, digest, payload in zip(*columns):
                if (group, number) != at:
                    if block:
                        yield rows(at[0], block, items)
                    at, block = (group, number), _Block(number, height)
                block.append(digest, payload)
        if block:
            yield rows(at[0], block, items)

    return dealt.mapInArrow(run, schema)


def _rounds(nodes: DataFrame, height: int) -> list[DataFrame]:
    """Rounds until every group has one root: block roots are the next appends."""
    rounds = []
    while True:
        runs = stored(_grow(nodes, height))
        rounds.append(runs)
        if runs.where("block > 0").isEmpty():
            return rounds
        nodes = runs.where("run = 0").select(
            "group", F.col("block").alias("index"), F.col("root").alias("node"), F.lit(None).cast("int").alias("item"))


def _exploded(runs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """One row per node of the runs: its item, digest and place, and the step among
    its siblings before the path of its run. A lone node has no siblings to meet."""
    each = runs.select("*", F.posexplode(F.arrays_zip("nodes", "items")).alias("at", "one"))
    others = F.array_join(F.transform(F.filter("nodes", lambda _, i: i != F.col("at")), F.hex), "")
    step = F.array(F.struct(F.col("at").cast("int").alias("at"), F.unhex(others).alias("others")).cast(STEP))
    return each.withColumn("path", F.when(F.col("levels") > 0, F.concat(step, "path")).otherwise(F.col("path"))).withColumn(
        "index", (F.col("block") * WIDTH ** (height - 1) + F.col("run")) * WIDTH + F.col("at"))


def _extended(rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """The lowest runs with whole witnesses. ``tops`` has (group, above, ..): what
    lies above the root of each group. From the top down, the witness of a block
    extends those of its runs; a block meets at most 256 of them."""
    extra = [c for c in tops.columns if c not in ("group", "above")]
    above = tops.withColumn("block", F.lit(0).cast("bigint"))
    for at in range(len(rounds) - 1, -1, -1):
        met = rounds[at].join(above, ["group", "block"]).withColumn("path", F.concat("path", "above")).drop("above")
        if at:
            above = stored(_exploded(met, height).select("group", F.col("index").alias("block"), F.col("path").alias("above"), *extra))
    return met


def manifest(docs: DataFrame, columns: Iterable[str], *, id_col: str = "doc_id", group_col: str = "source",
             changed: Column | None = None, height: int = HEIGHT) -> DataFrame:
    """Runs of up to 16 rows of one group with their witness: (nodes: leaves in order,
    items: struct(id, changed), levels, path: steps above the run, subroot, root).

    Leaves ascend by id inside a group; null ids come first, rows of one id follow
    by their digest, and repeated rows are leaves of their own. A null group is a
    group, and the first. ``changed`` is another digest of a row to be checked later,
    null for none. A task works on blocks of 16 ** ``height`` nodes. An empty table has no rows and no root. Texts are hashed in the
    JVM, row by row, and only digests go further; columns not named are ignored.
    """
    share_code(docs.sparkSession)
    other = F.lit(None).cast("binary") if changed is None else changed
    leaves = stored(docs.select(group_key(group_col).alias("group"), F.col(id_col).alias("id"),
                                leaf(columns).alias("node"), other.alias("changed")))
    nodes = numbered(leaves, ["id", "node"]).select("group", "index", "node", F.struct("id", "changed").alias("item"))
    rounds = _rounds(nodes, height)
    subroots = rounds[-1].where("run = 0").select("group", "root")
    whole = subroots.select(F.lit("").alias("group"), F.col("group").alias("item"), F.col("root").alias("node"))
    last = _rounds(numbered(whole, ["item"]), height)
    root = last[-1].where("run = 0").select("group", F.expr(f"cast(array() as {PATH})").alias("above"), "root")
    tops = stored(_exploded(_extended([r.drop("root") for r in last], root, height)).select(
        F.col("one.items").alias("group"), F.col("path").alias("above"), F.col("one.nodes").alias("subroot"), "root"))
    return _extended([r.drop("root") for r in rounds], tops, height)


def witnesses(runs: DataFrame) -> DataFrame:
    """(id, leaf, subroot, root, path) for every row: its steps up to the root."""
    return _exploded(runs).select(F.col("one.items.id").alias("id"), F.col("one.nodes").alias("leaf"), "subroot", "root", "path")


def fold(digest: bytes, path: Iterable[tuple[int, bytes]]) -> bytes:
    """The root that a leaf and its witness give."""
    for at, others in path:
        digest = hashlib.sha256((others[:32 * at] + digest + others[32 * at:]).hex().encode()).digest()
    return digest


def digests(runs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row:
    the digest of all its siblings' digests, level by level, and what its witness
    gives for the changed leaf, or for its own where it has none."""
    kind = runs.schema["items"].dataType.elementType["id"].dataType.simpleString()
    names = [id_col, "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_state()
        for batch in batches:
            id_type = batch.schema.field("items").type.value_type.field("id").type
            for at in range(0, batch.num_rows, 64):
                out = [[] for _ in names]
                for row in batch.slice(at, 64).to_pylist():
                    above = [(step["at"], step["others"]) for step in row["path"]]
                    nodes, root = row["nodes"], row["root"]
                    for i, item in enumerate(row["items"]):
                        path = [(i, b"".join(nodes[:i] + nodes[i + 1:])), *above] if row["levels"] else above
                        proof = hashlib.sha256(b"".join(others for _, others in path).hex().encode())
                        folded = fold(item["changed"] or nodes[i], path)
                        for column, value in zip(out, (item["id"], nodes[i].hex(), row["subroot"].hex(), root.hex(),
                                                       proof.hexdigest(), folded.hex(), folded == root)):
                            column.append(value)
                kinds = [id_type, *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names)

    needed = runs.select("nodes", "items", "levels", "path", "subroot", "root")
    return needed.mapInArrow(run, f"`{id_col}` {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                                  "folded_root string, verified boolean")

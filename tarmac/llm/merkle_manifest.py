"""Merkle manifest of a corpus, checkpointed every few levels.

Every row is a leaf.  The leaves of a language, in order of doc_id, are the bottom of a
tree in which each pair of neighbours becomes its parent; the roots of the languages are
the bottom of one more tree.  Digests inside a hash are written as hexadecimal text.

Only each `STEP`-th level of a tree is stored.  A stored node is the top of an aligned
subtree of at most 2 ** STEP stored nodes of the level below, so one task makes it out of
one short run of them, and a level is one grouping on (tree, position >> STEP).  Proofs
go down again: the nodes between two stored levels are made anew from the run below them,
give the siblings of the run, and are forgotten.  What is joined is one row per run and
not per leaf: the run with the siblings above it.

Positions come from a range-partitioned sort of the whole table: counts of (tree,
partition), added up, say where in its tree a partition begins.  The order is by tree,
doc_id, leaf and a row number, so neither a large language nor many equal rows end in one
task.

Defined results: a null in any column is hashed as `-`, empty text as `0:`; rows without a
doc_id come first in their language; rows with equal doc_id are ordered by leaf digest, so
equal rows are interchangeable; a null language is a tree of its own, before all others,
and another one than the empty language; a text of any length is hashed in one go by the
JVM; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tarmac.llm.common import Workspace

#: Levels from one stored level to the next.
STEP = 6
#: A sibling in a proof is a digest after its side; a node without a sibling is a step of its own.
LEFT, RIGHT, ALONE = b"l", b"r", b"-"

NODES = "tree string, idx bigint, n bigint, h binary"
PROOFS = "tree string, idx bigint, sibs array<binary>"
CHECKED = "doc_id bigint, tree string, leaf string, proof_sha256 string, folded_root string"


# What a task does with one run of nodes ---------------------------------------------

def parent(nodes: list[bytes]) -> bytes:
    return hashlib.sha256("".join(n.hex() for n in nodes).encode()).digest()


def rise(n: int, step: int) -> int:
    """Levels from one with `n` nodes to the next stored one, or to the root."""
    return min(step, (n - 1).bit_length())


def subtree(run: list[bytes], levels: int) -> list[list[bytes]]:
    """The levels of an aligned subtree, bottom first."""
    out = [run]
    for _ in range(levels):
        run = [parent(run[k : k + 2]) for k in range(0, len(run), 2)]
        out.append(run)
    return out


def siblings(levels: list[list[bytes]], at: int) -> list[bytes]:
    """Siblings of the `at`-th node of the bottom, up to the top of the subtree."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append(ALONE if other >= len(nodes) else (LEFT if other < at else RIGHT) + nodes[other])
        at >>= 1
    return out


def proof_digest(sibs: list[bytes]) -> str:
    return hashlib.sha256("".join(s[1:].hex() for s in sibs).encode()).hexdigest()


def fold(node: bytes, sibs: list[bytes]) -> bytes:
    """The root that a node and its siblings lead to."""
    for s in sibs:
        side, other = s[:1], s[1:]
        node = parent([node] if side == ALONE else [other, node] if side == LEFT else [node, other])
    return node


# The distributed part ----------------------------------------------------------------

def field(name: str, value: Column | None = None) -> Column:
    text = (F.col(name) if value is None else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _row_digest(n_chars: Column) -> Column:
    parts = [field("doc_id"), field("source"), field("lang"), field("n_chars", n_chars), field("text")]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """tree, doc_id, h (digest of the row), other (digest of the row as it would be tampered with, null where it is not)."""
    changed = F.lit(None).cast("binary") if tampered is None else F.when(tampered, _row_digest(F.col("n_chars") + 1))
    # The name of a tree sorts as the language does, with null first.
    return documents.select(
        F.coalesce(F.concat(F.lit("="), "lang"), F.lit("")).alias("tree"), F.col("doc_id").cast("bigint").alias("doc_id"),
        _row_digest(F.col("n_chars")).alias("h"), changed.alias("other"))


def positions(rows: DataFrame, order: list[str], work: Workspace) -> DataFrame:
    """`rows` with idx, their place in their tree by `order`, and n, the size of the tree."""
    keys = ["tree", *order, "row"]
    placed = work.store(
        rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
        .drop("row").withColumn("at", F.monotonically_increasing_id()), "placed")
    # The upper bits of `at` number the partition; a tree lies in it without gaps.
    part = F.shiftrightunsigned("at", 33).alias("part")
    runs = placed.groupBy("tree", part).agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("m"))
    so_far = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = work.store(
        runs.select(
            "tree", "part", (F.col("low") - F.sum("m").over(so_far) + F.col("m")).alias("shift"),
            F.sum("m").over(Window.partitionBy("tree")).alias("n")), "runs")
    out = placed.withColumn("part", part).join(runs, ["tree", "part"])
    return work.store(out.select(*rows.columns, (F.col("at") - F.col("shift")).alias("idx"), "n"), "positions")


def _runs(nodes: DataFrame, step: int, *more: str) -> DataFrame:
    """One row per aligned run of at most 2 ** step nodes, in order."""
    return nodes.groupBy("tree", "n", F.shiftright("idx", step).alias("g")).agg(
        F.sort_array(F.collect_list(F.struct("idx", "h", *more))).alias("run"))


def _made(rows: DataFrame, make: Callable[[dict, int], Iterator[dict]], step: int, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows made of each row; what is made of one row is bounded by a run."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                out = [made for row in batch.slice(at, 200).to_pylist() for made in make(row, step)]
                yield pa.RecordBatch.from_pylist(out, schema)

    return rows.mapInArrow(tasks, ddl)


def _up(row: dict, step: int) -> Iterator[dict]:
    levels = rise(row["n"], step)
    top = subtree([x["h"] for x in row["run"]], levels)[-1]
    yield {"tree": row["tree"], "idx": row["g"], "n": -(-row["n"] >> levels), "h": top[0]}


def _prove(row: dict, step: int) -> Iterator[dict]:
    levels = subtree([x["h"] for x in row["run"]], rise(row["n"], step))
    for k, node in enumerate(row["run"]):
        yield {"tree": row["tree"], "idx": node["idx"], "sibs": siblings(levels, k) + row["sibs"]}


def _check(row: dict, step: int) -> Iterator[dict]:
    levels = subtree([x["h"] for x in row["run"]], rise(row["n"], step))
    for k, node in enumerate(row["run"]):
        sibs = siblings(levels, k) + row["sibs"]
        start = node["h"] if node["other"] is None else node["other"]
        yield {
            "doc_id": node["doc_id"], "tree": row["tree"], "leaf": node["h"].hex(),
            "proof_sha256": proof_digest(sibs), "folded_root": fold(start, sibs).hex()}


_NODES = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("h", pa.binary())])
_PROOFS = pa.schema([("tree", pa.string()), ("idx", pa.int64()), ("sibs", pa.list_(pa.binary()))])
_CHECKED = pa.schema([(n, pa.int64() if n == "doc_id" else pa.string()) for n in ("doc_id", "tree", "leaf", "proof_sha256", "folded_root")])


class Tree:
    """The stored levels of all trees over `bottom`: rows of tree, idx, n (nodes of the tree on that level), h.

    `roots` has one row per tree: tree, h, and `height`, the number of stored steps to it.
    """

    def __init__(self, bottom: DataFrame, work: Workspace, step: int = STEP) -> None:
        self.work, self.step, self.levels = work, step, [bottom]
        roots = [bottom.where("n = 1").select("tree", "h", F.lit(1).alias("height"))]

        largest = bottom.agg(F.max("n")).first()[0] or 0
        while largest > 1:
            above = work.store(_made(_runs(self.levels[-1].where("n > 1"), step), _up, step, _NODES, NODES), f"level-{len(self.levels)}")
            roots.append(above.where("n = 1").select("tree", "h", F.lit(len(self.levels)).alias("height")))
            self.levels.append(above)
            largest = -(-largest >> rise(largest, step))
        whole = roots[0]
        for more in roots[1:]:
            whole = whole.unionByName(more)
        self.roots = work.store(whole, "roots")

    def proofs(self, above: DataFrame) -> DataFrame:
        """tree, idx, sibs of each bottom node; `above` gives the siblings (tree, sibs) over each root."""
        return _made(self._down(above), _prove, self.step, _PROOFS, PROOFS)

    def checked(self, above: DataFrame) -> DataFrame:
        """The proof of each bottom node as digest, and the root that follows from `other`, or else from h."""

        return _made(self._down(above, "doc_id", "other"), _check, self.step, _CHECKED, CHECKED)

    def _down(self, above: DataFrame, *more: str) -> DataFrame:
        """From the roots to the stored level below, and on: the runs of the bottom, each with the siblings over it.

        `more` columns of the bottom stay with its nodes.
        """
        tops = self.work.store(self.roots.join(above, "tree").select("tree", "height", "sibs"), "tops")
        # The parent of a run is a node of the next stored level, or the root.
        known = None
        for k in range(max(len(self.levels) - 1, 1) - 1, -1, -1):
            over = tops.where(F.col("height") == k + 1).select("tree", F.lit(0).cast("bigint").alias("g"), "sibs")
            if known is not None:
                over = over.unionByName(known.withColumnRenamed("idx", "g"))
            nodes = self.levels[k] if k == 0 else self.levels[k].where("n > 1")
            runs = _runs(nodes, self.step, *(more if k == 0 else ())).join(over, ["tree", "g"])
            if k == 0:
                return runs
            known = self.work.store(_made(runs, _prove, self.step, _PROOFS, PROOFS), f"proofs-{k}")


def manifest(documents: DataFrame, work: Workspace, tampered: Column | None = None, step: int = STEP) -> DataFrame:
    """Per document: leaf, subroot, root, proof_sha256, folded_root, verified.

    `tampered` marks the rows whose proof is tried with n_chars one larger.
    """
    of_lang = Tree(positions(leaves(documents, tampered), ["doc_id", "h"], work), work, step)
    names = of_lang.roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "h")
    bottom = positions(names, ["of"], work)
    whole = Tree(bottom, work, step)
    none = F.array().cast("array<binary>").alias("sibs")
    above = work.store(
        whole.proofs(whole.roots.select("tree", none)).join(bottom.select("idx", "of", "h"), "idx")
        .select(F.col("of").alias("tree"), "sibs", F.hex("h").alias("subroot")), "above")
    root = whole.roots.select(F.lower(F.hex("h")).alias("root")).first()
    out = of_lang.checked(above.select("tree", "sibs"))
    return out.join(above.select("tree", F.lower("subroot").alias("subroot")), "tree").select(
        "doc_id", "leaf", "subroot", F.lit(root and root["root"]).cast("string").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root and root["root"])).alias("verified"))

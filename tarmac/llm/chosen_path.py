"""N-gram Jaccard join by chosen paths.

A document is the set of its 5-word shingles.  Documents with one set are one class from
the start; the join runs over one representative per set.

A run splits all sets by the tokens on randomly chosen coordinates of a min-hash
embedding: two sets go the same way with the probability of their similarity.  A bucket
with more than `SMALL` sets is split again, on other coordinates, chosen by the path that
led to it; small buckets, and those at the deepest level, are compared by brute force.
Runs are repeated until a pair at the threshold has been missed by all of them with at
most 1 - `RECALL`, so RECALL sets the number of runs.  No two levels of any runs share a
coordinate, so that runs miss a pair independently.

A bucket that is still large at the deepest level holds sets that agree on all tokens of
the path, so it is a group of near copies.  It is compared in blocks of `SMALL` sets, pair
of blocks by pair of blocks, by many tasks.  No pair is ever a row unless it is an edge of
the spanning forest of its block pair: links are counted where they are found.  Two sets
that meet in several buckets are counted in the first of the buckets they share.

Comparison is exact, on the sets of 64-bit shingle hashes.  Classes are the connected
components of the links, by alternating star contraction over stored edges.

Defined results: words are runs of letters and digits, A-Z lower-cased; a text of one to
four words has one shingle, all of them; null texts and texts without words have no set
and are alone, without links; repeated rows are links of each other; a null doc_id is kept;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tarmac.llm.common import Workspace

N = 5
#: Compared in whole numbers, as 4 / 5.
THRESHOLD = 0.8
RECALL = 0.9999
COORDINATES = 64
DEPTH = 3
SMALL = 256
#: Candidates whose min-hash agreement is below this are not similar: under one in a million at the threshold.
AGREE = 0.5
SETS = "uid bigint, doc_id bigint, th bigint, n int, key1 bigint, key2 bigint, sketch array<int>"


#: Bytes of words, A-Z lower-cased; all others become spaces.  Bytes beyond ASCII belong to words, as their characters do.
WORD_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
#: Hashes that are multiplied at once: with 64 coordinates, a quarter of a MB.
AT_ONCE = 512


def shingle_hashes(text: str | bytes | None, n: int = N) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles; bytes are a text in UTF-8."""
    raw = text if isinstance(text, bytes) else (text or "").encode()
    words = raw.translate(WORD_BYTES).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(n, len(words))
    mixed = np.zeros(len(words) - width + 1, np.uint64)
    for k in range(width):
        mixed = _mix(mixed * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    mixed.sort()
    return mixed[np.concatenate([[True], mixed[1:] != mixed[:-1]])]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


@cache
def _multipliers(count: int) -> np.ndarray:
    """The odd factor of each coordinate, as a column."""
    rng = np.random.default_rng(7)
    return (rng.integers(1, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]


def sketch(hashes: np.ndarray, count: int = COORDINATES) -> np.ndarray:
    """Min-hash embedding: on each coordinate the smallest of 32-bit hashes, the upper halves of 64-bit products."""
    odd = _multipliers(count)
    least = [(odd * hashes[k : k + AT_ONCE]).min(1) for k in range(0, len(hashes), AT_ONCE)]
    return (np.min(least, 0) >> np.uint64(32)).astype(np.uint32)


def runs_for(recall: float = RECALL, threshold: float = THRESHOLD, depth: int = DEPTH) -> int:
    """Runs until a pair at the threshold is missed by all with at most 1 - recall, at the deepest level."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**depth))


def coordinates_for(runs: int, depth: int = DEPTH) -> int:
    """Coordinates of the sketches: enough for each level of each run to have its own."""
    return max(COORDINATES, runs * depth)


def coordinate_order(runs: int, depth: int = DEPTH) -> np.ndarray:
    """The coordinates of each run (rows), level by level: one permutation, cut into runs."""
    return np.random.default_rng(11).permutation(coordinates_for(runs, depth))[: runs * depth].reshape(runs, depth)


def document_sets(documents: DataFrame, count: int = COORDINATES) -> DataFrame:
    """uid, doc_id, set size, 128-bit key of the set, and its sketch (null without words)."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            rows, texts = [], batch[1].cast(pa.binary())
            for i in range(batch.num_rows):
                hashes = shingle_hashes(texts[i].as_py())
                key = xxhash.xxh3_128_intdigest(hashes.tobytes())
                rows.append((len(hashes), _signed(key & (2**64 - 1)), _signed(key >> 64),
                             sketch(hashes, count).view(np.int32) if len(hashes) else None))
            if rows:
                n, k1, k2, sk = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    pa.array(base + np.arange(len(rows)), pa.int64()), batch[0].cast(pa.int64()), batch[2], pa.array(n, pa.int32()),
                    pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(sk, pa.list_(pa.int32()))],
                    names=["uid", "doc_id", "th", "n", "key1", "key2", "sketch"])
            base += len(rows)

    return documents.select("doc_id", "text", F.xxhash64("text").alias("th")).mapInArrow(described, SETS)


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _buckets(sets: DataFrame, work: Workspace, runs: int, depth: int, small: int) -> DataFrame:
    """rep, bucket: the buckets to compare; every set has one path per run, cut where its bucket is small."""
    order = coordinate_order(runs, depth)
    out = None
    here = sets.select("rep", "sketch", F.posexplode(F.array(*[F.lit(int(c[0])) for c in order])).alias("run", "c"))
    path = F.xxhash64("run", "c", F.col("sketch")[F.col("c")])
    level = here.select("rep", "run", path.alias("bucket"))
    for d in range(1, depth + 1):
        sizes = level.groupBy("run", "bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        level = work.store(level.join(sizes.hint("merge"), ["run", "bucket"]), f"level-{d}")
        done = level if d == depth else level.where(F.col("size") <= small)
        done = done.select("rep", "bucket", "size")
        out = done if out is None else out.unionByName(done)
        if d < depth:
            # the next coordinate of a path; sets that share the path share it
            nxt = F.element_at(F.array(*[F.lit(int(c[d])) for c in order]), F.col("run") + 1)
            level = (
                level.where(F.col("size") > small).join(sets.select("rep", "sketch").hint("merge"), "rep")
                .select("rep", "run", F.xxhash64("bucket", nxt, F.element_at("sketch", nxt + 1)).alias("bucket")))
    return out


def _compare(buckets: DataFrame, reps: DataFrame, documents: DataFrame, work: Workspace, small: int, count: int) -> DataFrame:
    """rep, other, links: of each unit, the link weight of each set, and the edges of a spanning forest."""
    member = work.store(buckets.join(
        buckets.groupBy("rep").agg(F.sort_array(F.collect_list("bucket")).alias("all")).hint("merge"), "rep"), "meetings")
    # a bucket whose sets are all together in one earlier bucket has nothing to add
    earlier = member.select("bucket", "size", F.explode(F.filter("all", lambda b: b < F.col("bucket"))).alias("b"))
    covered = earlier.groupBy("bucket", "b").agg(F.count(F.lit(1)).alias("n"), F.first("size").alias("size")).where("n = size").select("bucket").distinct()
    member = member.join(covered.hint("merge"), "bucket", "left_anti")
    # blocks of a bucket by a hash of the set; a pair of blocks is a unit of work
    blocks = F.ceil(F.col("size") / small).cast("int")
    member = member.withColumns({"block": F.pmod(F.xxhash64("rep"), blocks).cast("int"), "blocks": blocks})
    units = member.select("rep", "all", "bucket", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("with")).select(
        "rep", "all", "bucket", "block", (F.col("block") != F.col("with")).alias("across"),
        F.xxhash64("bucket", F.least("block", "with"), F.greatest("block", "with")).alias("unit"))

    def likely(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The sets of a unit that have a partner to be compared with there."""
        for unit in _units(batches):
            keep = unit[_pairs(unit, np.stack(unit["sketch"].to_list())).any(1)] if len(unit) > 1 else unit[:0]
            if len(keep):
                yield keep.drop(columns="sketch")

    def links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for unit in _units(batches):
            yield _links(unit, count)

    wanted = work.store(
        units.join(reps.select("rep", "sketch").hint("merge"), "rep").repartition("unit").sortWithinPartitions("unit")
        .mapInPandas(likely, "rep bigint, all array<bigint>, bucket bigint, block int, across boolean, unit bigint"), "wanted")
    asked = reps.drop("sketch").join(wanted.select("rep").distinct().hint("merge"), "rep")
    own = documents.select(F.col("doc_id").alias("_doc"), F.xxhash64("text").alias("_th"), "text")
    texts = work.store(asked.join(own.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("th") == F.col("_th")))
                       .groupBy("rep").agg(F.first("copies").alias("copies"), F.first("text").alias("text")), "texts")
    work.tidy()
    return work.store(
        wanted.join(texts.hint("merge"), "rep").repartition("unit").sortWithinPartitions("unit")
        .mapInPandas(links, "rep bigint, other bigint, links bigint"), "links")


def _units(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The rows of one unit after another; rows come sorted by unit."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        unit = batch["unit"].to_numpy()
        cuts = np.flatnonzero(np.diff(unit)) + 1
        for k, part in enumerate(np.split(np.arange(len(unit)), cuts)):
            rows = batch.iloc[part]
            if held and held[0]["unit"].iloc[0] != rows["unit"].iloc[0]:
                yield held[0] if len(held) == 1 else pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield pd.concat(held)


def _pairs(unit: pd.DataFrame, sketches: np.ndarray) -> np.ndarray:
    """Pairs of a unit to be compared in it: of its two blocks, likely similar, sharing no earlier bucket."""
    n, bucket, block = len(unit), unit["bucket"].iloc[0], unit["block"].to_numpy()
    pair = block[:, None] != block[None, :] if unit["across"].iloc[0] else ~np.eye(n, dtype=bool)
    need = AGREE * sketches.shape[1]
    for i in range(n):
        pair[i] &= (sketches == sketches[i]).sum(1) >= need
    number: dict[int, int] = {}
    where = [[number.setdefault(b, len(number)) for b in own if b < bucket] for own in unit["all"]]
    if number:
        flags = np.zeros((n, len(number)), np.float32)
        for i, own in enumerate(where):
            flags[i, own] = 1
        pair &= flags @ flags.T == 0
    return pair


def _links(unit: pd.DataFrame, count: int = COORDINATES) -> pd.DataFrame:
    """Exact comparison of a unit: link weights of each set, and spanning edges."""
    sets = [shingle_hashes(t) for t in unit["text"]]
    pair = np.triu(_pairs(unit, np.stack([sketch(s, count).view(np.int32) for s in sets])), 1)
    size, copies, rep = np.array([len(s) for s in sets]), unit["copies"].to_numpy(), unit["rep"].to_numpy()
    first, second = np.nonzero(pair)
    if len(first) > 4 * len(sets):
        both = _intersections(sets)[first, second]
    else:
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(first, second)])
    # both / (a + b - both) >= 4 / 5, in whole numbers
    linked = 5 * both >= 4 * (size[first] + size[second] - both)
    first, second = first[linked], second[linked]
    weight = np.zeros(len(unit), np.int64)
    np.add.at(weight, first, copies[second])
    np.add.at(weight, second, copies[first])
    parent, edges = list(range(len(unit))), []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i, j in zip(first, second):
        a, b = root(i), root(j)
        if a != b:
            parent[a] = b
            edges.append((rep[i], rep[j], 0))
    out = edges + [(rep[i], rep[i], weight[i]) for i in np.flatnonzero(weight)]
    return pd.DataFrame(out, columns=["rep", "other", "links"]).astype("int64")


def _intersections(sets: list[np.ndarray], width: int = 1 << 14) -> np.ndarray:
    """Sizes of all intersections within a unit, over the shingles of two sets or more, a slice of them at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    owner, column = owner[shared], np.unique(column[shared], return_inverse=True)[1]
    out = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column.max(initial=-1)) + 1, width):
        here = (column >= low) & (column < low + width)
        flags = np.zeros((len(sets), width), np.float32)
        flags[owner[here], column[here] - low] = 1
        out += flags @ flags.T
    return out.astype(np.int64)


def components(edges: DataFrame, work: Workspace, rounds: int = 40) -> DataFrame:
    """node, root: the smallest node of each component, by large-star and small-star steps over stored edges.

    edges: a and b.  A star step points the neighbours of a node to the smallest of them; a
    hub's neighbours are combined before the shuffle and joined by key, never gathered.
    """
    arcs = work.store(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "arcs")
    before = None
    for k in range(rounds):
        both = arcs.unionByName(arcs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        new = work.store(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), f"arcs-{k}")
        state = tuple(new.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        work.drop(arcs)
        arcs = new
        if state == before:
            break
        before = state
    return arcs.select(F.col("a").alias("node"), F.col("b").alias("root"))


def similar_documents(
    documents: DataFrame, work: Workspace, recall: float = RECALL, depth: int = DEPTH, small: int = SMALL,
) -> DataFrame:
    """uid, doc_id, th (a hash of the text), root, class_id, n_links: one row per document.

    root names the class, class_id is the smallest doc_id in it, n_links the number of other documents at
    least `THRESHOLD` similar.
    """
    runs = runs_for(recall, depth=depth)
    count = coordinates_for(runs, depth)
    sets = work.store(document_sets(documents, count), "sets")
    with_set = sets.where("n > 0")
    classes = work.store(with_set.groupBy("key1", "key2").agg(
        F.min(F.struct("uid", "doc_id", "th")).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("sketch").alias("sketch"),
    ).select("key1", "key2", F.col("first.uid").alias("rep"), "first.doc_id", "first.th", "copies", "sketch"), "classes")
    member = with_set.select("uid", "doc_id", "th", "key1", "key2").join(classes.select("key1", "key2", "rep", "copies").hint("merge"), ["key1", "key2"])
    member = work.store(member.drop("key1", "key2"), "members")
    reps = classes.select("rep", "doc_id", "th", "copies", "sketch")
    buckets = work.store(_buckets(reps, work, runs, depth, small), "buckets")
    found = _compare(buckets, reps, documents, work, small, count)
    weights = found.where("rep = other").groupBy("rep").agg(F.sum("links").alias("more"))
    roots = components(found.where("rep <> other").select(F.col("rep").alias("a"), F.col("other").alias("b")), work)
    placed = (
        member.join(weights, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep")))
    placed = work.store(placed.select("uid", "doc_id", "th", "root", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links")), "placed")
    names = placed.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    alone = sets.where("n = 0").select("uid", "doc_id", "th", F.col("uid").alias("root"), F.col("doc_id").alias("class_id"), F.lit(0).cast("bigint").alias("n_links"))
    return placed.join(names.hint("merge"), "root").select("uid", "doc_id", "th", "root", "class_id", "n_links").unionByName(alone)

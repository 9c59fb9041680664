"""Packing documents into sequences: cutting stock by column generation.

1. Every document becomes token ids (with the end mark) and is cut into full sequences and
   one rest; a piece is a row with its checksum.  Python keeps the ids of words it has met.
2. Pieces are counted by length class (`GRID` tokens wide, rounded up): at most
   `capacity / GRID` numbers, whatever the corpus.
3. A linear program over patterns (how many pieces of each class share a sequence) is
   solved by column generation: knapsack dynamic programming over the dual prices finds
   the pattern that saves most, until none does.
4. Patterns are used a whole number of times, rounded down; the pieces left over, fewer
   than classes times a pattern's pieces, are placed first-fit by decreasing class.
5. Pieces are ranked within their class, and a rank says which copy of which pattern it
   takes.  Ranks are counted in blocks of rows, so no task sees all pieces of a class.

Nothing but the class counts reaches the driver.

Defined results: null and empty texts have only the end mark; rows with equal ids or
texts are packed one by one; a null doc_id is kept; other columns are ignored; an empty
table gives no pieces.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tarmac.llm.common import Workspace

CAPACITY = 4096
GRID = 16
END = 2
#: Runs, and parts of runs, whose ids a Python worker keeps: about 200 bytes each.
MEMO = 600_000
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, class int, block bigint"


#: Parts of a run that the vocabulary merges on their own.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class WordTokens:
    """Token ids of a text as little-endian 32-bit bytes.

    The vocabulary splits at white space before it merges, so a text's ids are those of
    its runs between spaces, tabs and line ends, one after another.  Runs of plain Latin
    letters are lower-cased and taken apart as the vocabulary does it, so a word with a
    comma is not a new word.  Ids of runs and of parts are kept, up to `MEMO` each; what
    comes later is encoded each time it occurs.
    """

    def __init__(self, path: str) -> None:
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parts = regex.compile(PARTS)
        self.of_run: dict[str, bytes] = {}
        self.of_part: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        runs = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self.of_run
        found = list(map(known.get, runs))
        if None in found:
            lost = [i for i, ids in enumerate(found) if ids is None]
            new = self._new(list({runs[i] for i in lost}))
            for i in lost:
                found[i] = new[runs[i]]
            if len(known) < MEMO:
                known.update(new)
        return b"".join(found)

    def _new(self, runs: list[str]) -> dict[str, bytes]:
        split = {}
        for run in runs:
            plain = run.isprintable() and max(run, default="") < "\u0250" and "\u0130" not in run and "<|" not in run
            split[run] = self.parts.findall(run.lower()) if plain else [run]
        ids = self.of_part
        lost = list({p for parts in split.values() for p in parts if p not in ids})
        if lost:
            got = {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(lost, self.tokenizer.encode_batch_fast(lost, add_special_tokens=False))}
            if len(ids) < MEMO:
                ids.update(got)
            else:
                ids = {p: got[p] if p in got else ids[p] for parts in split.values() for p in parts}
        return {run: b"".join([ids[p] for p in parts]) for run, parts in split.items()}


@lru_cache(1)
def word_tokens(path: str) -> WordTokens:
    """One per Python worker, for all the tasks it runs."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return WordTokens(path)


def cut_pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, grid: int = GRID, end: int = END) -> DataFrame:
    """Pieces of each document: full sequences, then the rest."""
    mark = np.array([end], "<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, block = word_tokens(vocabulary), TaskContext.get().partitionId()
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                doc, data = batch[0][i].as_py(), words.encode(batch[1][i].as_py() or "") + mark
                n = len(data) // 4
                for at in range(0, n, capacity):
                    part = data[4 * at : 4 * (at + capacity)]
                    k = len(part) // 4
                    rows.append((doc, at, k, zlib.crc32(part), n, -(-k // grid), block))
            if rows:
                cols = [pa.array(c, pa.int32() if j == 5 else pa.int64()) for j, c in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "block"])

    return documents.select("doc_id", "text").mapInArrow(pieces, PIECES)


def price(values: np.ndarray, units: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """Knapsack: the pattern of most value that fits; counts by class."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    order = np.arange(len(units))
    for room in range(1, capacity + 1):
        best[room] = best[room - 1]
        fit = order[units <= room]
        if len(fit):
            gain = best[room - units[fit]] + values[fit]
            k = int(np.argmax(gain))
            if gain[k] > best[room] + 1e-12:
                best[room], choice[room] = gain[k], fit[k]
    counts, room = np.zeros(len(units), int), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            counts[choice[room]] += 1
            room -= units[choice[room]]
    return counts, float(best[capacity])


def solve_patterns(units: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 20_000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns of the optimal basis (rows) and how often each is used (real numbers).

    Revised simplex: starts from one pattern per class, keeps the inverse of the basis,
    and brings in the pattern that the knapsack finds at the current prices.  Ends when
    no pattern would save more than a thousandth of a sequence each.
    """
    m = len(units)
    basis = np.diag(capacity // units).astype(float)
    inverse = np.diag(1.0 / np.diag(basis))
    amount = inverse @ demand
    for _ in range(rounds):
        prices = inverse.sum(0)  # each pattern costs one sequence
        counts, value = price(prices, units, capacity)
        if value <= 1 + 1e-3:
            break
        direction = inverse @ counts
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = counts
        row = inverse[out] / direction[out]
        inverse -= np.outer(direction, row)
        inverse[out] = row
        amount = np.maximum(amount - direction * ratio[out], 0)
        amount[out] = max(ratio[out], 0)
    return basis.T.round().astype(int), amount


def plan_sequences(histogram: dict[int, int], units: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows: pieces of class 1..units) and a whole number of uses of each; together they hold every piece."""
    classes = np.array(sorted(histogram), int)
    demand = np.array([histogram[c] for c in classes], np.int64)
    patterns, amount = solve_patterns(classes, demand.astype(float), units)
    uses = np.floor(amount + 1e-6).astype(np.int64)
    # a pattern may hold more of a class than there is: use it less often, never more
    left = demand - patterns.T @ uses
    for k in np.flatnonzero(left < 0):
        for p in np.flatnonzero(patterns[:, k] * (uses > 0)):
            if left[k] < 0:
                less = min(uses[p], -(left[k] // patterns[p, k]))
                uses[p] -= less
                left = left + less * patterns[p]
    # what is left: fill one sequence after another with the largest class that fits
    extra: dict[tuple[int, ...], int] = {}
    while left.any():
        pattern, room = np.zeros(len(classes), int), units
        for k in range(len(classes) - 1, -1, -1):
            n = min(left[k], room // classes[k])
            pattern[k] += n
            room -= n * classes[k]
        times = int(min(left[k] // pattern[k] for k in np.flatnonzero(pattern)))
        left = left - times * pattern
        extra[tuple(pattern)] = extra.get(tuple(pattern), 0) + times
    narrow = np.vstack([patterns[uses > 0], *[np.array([p]) for p in extra]]) if extra or (uses > 0).any() else np.zeros((0, len(classes)), int)
    uses = np.concatenate([uses[uses > 0], np.array(list(extra.values()), np.int64)])
    wide = np.zeros((len(narrow), units + 1), int)
    wide[:, classes] = narrow
    return wide, uses.astype(np.int64)


def rank_pieces(pieces: DataFrame, work: Workspace) -> DataFrame:
    """`rank`: the number of a piece within its class, from 0.

    Pieces of a class are numbered within their block of input rows and shifted by the
    blocks before, whose counts are summed up beside.
    """
    key = ["class", "block"]
    counts = pieces.groupBy(*key).count()
    before = F.sum("count").over(Window.partitionBy("class").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    shifts = work.store(counts.select(*key, F.coalesce(before, F.lit(0)).alias("shift")), "shifts")
    own = F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "start", "ids_crc32")) - 1
    return pieces.withColumn("own", own).join(shifts, key).withColumn("rank", F.col("own") + F.col("shift")).drop("own", "shift")


def place(ranked: DataFrame, patterns: np.ndarray, uses: np.ndarray, first: int = 0) -> DataFrame:
    """sequence_id and `slot` (order within the sequence) from class and rank.

    The plan has at most two patterns per class, so it goes to the tasks as it is.
    """
    starts = np.concatenate([[0], np.cumsum(uses)])[:-1] + first
    by_class = {}
    for c in range(1, patterns.shape[1]):
        own = np.flatnonzero(patterns[:, c])
        by_class[c] = (own, np.cumsum(patterns[own, c] * uses[own]), patterns[own, c])

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sequence, slot = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            kinds, ranks = batch["class"].to_numpy(), batch["rank"].to_numpy()
            for c in np.unique(kinds):
                rows = np.flatnonzero(kinds == c)
                own, ends, copies = by_class[c]
                p = np.searchsorted(ends, ranks[rows], "right")
                within = ranks[rows] - np.where(p > 0, ends[p - 1], 0)
                sequence[rows] = starts[own[p]] + within // copies[p]
                slot[rows] = c * 8192 + within % copies[p]
            yield batch.drop(columns=["class", "rank", "block"]).assign(sequence_id=sequence, slot=slot)

    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "class", "block", "rank").mapInPandas(
        placed, "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, slot bigint")


def pack(documents: DataFrame, vocabulary: str, work: Workspace, capacity: int = CAPACITY, grid: int = GRID, end: int = END) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row per piece."""
    pieces = work.store(cut_pieces(documents, vocabulary, capacity, grid, end), "pieces")
    histogram = {r["class"]: r["count"] for r in pieces.groupBy("class").count().collect()}
    patterns, uses = plan_sequences(histogram, capacity // grid)
    placed = place(rank_pieces(pieces, work), patterns, uses)
    within = Window.partitionBy("sequence_id").orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(within), F.lit(0))).drop("slot")

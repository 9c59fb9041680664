"""Decontamination by a positional inverted index.

`build_index` stores the postings of the corpus: for each document its terms, and beside
each term the places where it stands.  The index is partitioned by document, so building
it moves nothing and all lists of a document lie together.  Phrases of the benchmark are
looked up from their rarest term on: its list, shifted by its offset, gives the candidate
starts; the lists of the next terms, in order of rarity, are intersected with them at
their own offsets, and what survives all of them is an exact match.  Rarity is the number
of documents with the term, counted over the whole index.  `proximity_matches` takes pairs
of terms within a distance from the same postings.

Phrases are the query set.  They go to the tasks in blocks of at most `BLOCK` phrases,
with one pass over the index for each block; what is sent never depends on the corpus.

The index may be held to the vocabulary that will be asked for.  The vocabulary reaches
the tasks as a Bloom filter of a fixed size, so a larger benchmark only makes the filter
pass more.  Postings that pass it by chance meet no query term.

Defined results: null and empty texts have no words, no hits and the digest of the empty
string; repeated rows of `documents` are separate documents and give one row each; windows
that occur in several items belong to each of them; an item without words has no window;
a null item_id counts as an item and is left out of the digest; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tarmac.llm.common import LOWER, WORD, Workspace, words

WINDOW = 10
#: Size of the vocabulary filter: 2 MB.
BLOOM_BITS = 1 << 24
#: Phrases sent to the tasks at once.
BLOCK = 50_000
INDEX = "uid bigint, doc_id bigint, th bigint, n_words bigint, terms array<string>, places array<array<int>>"


def _bits(term: str) -> tuple[int, int]:
    h = xxhash.xxh3_64_intdigest(term)
    return h & (BLOOM_BITS - 1), (h >> 32) & (BLOOM_BITS - 1)


def vocabulary_filter(terms: DataFrame) -> bytes:
    """A Bloom filter over `term`, combined from the parts of all tasks.

    Tasks set bits of at most `BLOOM_BITS`; the driver gets bit numbers, never terms.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[int] = set()
        for batch in batches:
            for t in batch[0].to_pylist():
                found.update(_bits(t))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], names=["bit"])

    filter_ = np.zeros(BLOOM_BITS, bool)
    filter_[[r["bit"] for r in terms.select("term").distinct().mapInArrow(bits, "bit int").distinct().toLocalIterator()]] = True
    return np.packbits(filter_).tobytes()


class _Codes(dict):
    """Term -> number in `names`, or -1 for terms that the filter rejects."""

    def __init__(self, bits: np.ndarray | None) -> None:
        super().__init__()
        self.bits, self.names = bits, []

    def __missing__(self, term: str) -> int:
        code = -1
        if self.bits is None or all(self.bits[b] for b in _bits(term)):
            code = len(self.names)
            self.names.append(term)
        self[term] = code
        return code


def build_index(documents: DataFrame, only: bytes | None = None) -> DataFrame:
    """Postings of every document: uid (names the row of `documents`), doc_id, th (a hash of the text), n_words, terms, places.

    `only` is a filter of `vocabulary_filter`.
    """
    filter_ = None if only is None else documents.sparkSession.sparkContext.broadcast(only)

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, base = re.compile(WORD).findall, TaskContext.get().partitionId() << 40
        bits = None if filter_ is None else np.unpackbits(np.frombuffer(filter_.value, np.uint8)).view(bool)
        codes = _Codes(bits)
        for batch in batches:
            if len(codes) > 1_000_000:
                codes = _Codes(bits)
            code_of, sizes, tokens = codes.__getitem__, [], []
            for i in range(batch.num_rows):
                found = find((batch[1][i].as_py() or "").translate(LOWER))
                sizes.append(len(found))
                tokens.append(np.fromiter(map(code_of, found), np.int64, len(found)))
            n = len(sizes)
            token = np.concatenate([*tokens, np.zeros(0, np.int64)])
            begins = np.cumsum([0, *sizes])
            at = np.flatnonzero(token >= 0)
            owner = np.searchsorted(begins, at, "right") - 1
            # lists: runs of one document and term, places in order
            key = owner << 32 | token[at]
            order = np.argsort(key, kind="stable")
            key, place = key[order], (at - begins[owner])[order].astype(np.int32)
            new = np.flatnonzero(np.diff(key, prepend=-1))
            lists = np.searchsorted(key[new] >> 32, np.arange(n + 1)).astype(np.int32)
            terms = pa.array(codes.names, pa.string()).take(pa.array(key[new] & 0xFFFFFFFF))
            inner = pa.ListArray.from_arrays(pa.array(np.append(new, len(key)).astype(np.int32)), pa.array(place))
            yield pa.RecordBatch.from_arrays([
                pa.array(base + np.arange(n), pa.int64()), batch[0].cast(pa.int64()), batch[2], pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(lists), terms), pa.ListArray.from_arrays(pa.array(lists), inner)],
                names=["uid", "doc_id", "th", "n_words", "terms", "places"])
            base += n

    return documents.select("doc_id", "text", F.xxhash64("text")).mapInArrow(postings, INDEX)


def benchmark_windows(benchmark: DataFrame, width: int = WINDOW) -> DataFrame:
    """item_id and `terms` of each window of an item; an item shorter than that is one window."""
    item = benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - width + 1, F.lit(1)))
    return item.select("item_id", F.explode(F.transform(starts, lambda s: F.slice("w", s, F.lit(width)))).alias("terms"))


def phrase_matches(index: DataFrame, phrases: DataFrame, work: Workspace, block: int = BLOCK) -> DataFrame:
    """uid, phrase, start, n: every place where a phrase's terms stand one after another.

    phrases: phrase (its key) and terms (array of strings, all phrases distinct).
    """
    slots = phrases.select("phrase", F.posexplode("terms").alias("offset", "term"))
    documents_with = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ordered = work.store(
        slots.join(documents_with, "term", "left").groupBy("phrase").agg(
            F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "term"))).alias("slots")), "phrases")
    # blocks by hash come out about even: at half the size none is over it
    parts = -(-2 * ordered.count() // block)
    found = None
    for k in range(max(parts, 1)):
        rows = ordered.where(F.pmod(F.xxhash64("phrase"), F.lit(max(parts, 1))) == k).select("phrase", "slots.offset", "slots.term").collect()
        by_anchor: dict[str, list] = {}
        for r in rows:
            by_anchor.setdefault(r["term"][0], []).append((r["phrase"], r["offset"], r["term"]))
        one = index.select("uid", "terms", "places").mapInArrow(_matcher(by_anchor), "uid bigint, phrase bigint, start int, n int")
        found = one if found is None else found.unionByName(one)
    return found


def _matcher(by_anchor: dict[str, list]):
    """The pass over the index for phrases given by their rarest term: (phrase, offsets, terms), rarest first."""

    def matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = list(by_anchor)
        wanted = pa.array(anchors, pa.string())
        for batch in batches:
            terms, places = batch[1].flatten(), batch[2].flatten()
            row = pc.list_parent_indices(batch[1]).to_numpy(zero_copy_only=False)
            which = pc.fill_null(pc.index_in(terms, wanted), -1).to_numpy(zero_copy_only=False)
            out, now, lists = [], -1, {}
            for k in np.flatnonzero(which >= 0):
                if row[k] != now:
                    now, lists = row[k], {}
                    low, high = np.searchsorted(row, [now, now + 1])
                    where = dict(zip(terms.slice(low, high - low).to_pylist(), range(low, high)))
                for phrase, offsets, own in by_anchor[anchors[which[k]]]:
                    starts = None
                    for offset, term in zip(offsets, own):
                        if term not in lists:
                            lists[term] = frozenset(places[where[term]].as_py()) if term in where else frozenset()
                        if starts is None:
                            starts = {p - offset for p in lists[term] if p >= offset}
                        else:
                            starts = {s for s in starts if s + offset in lists[term]}
                        if not starts:
                            break
                    out += [(now, phrase, s, len(own)) for s in starts or ()]
            if out:
                rows, phrase, start, n = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch[0].take(pa.array(rows, pa.int64())), pa.array(phrase, pa.int64()), pa.array(start, pa.int32()), pa.array(n, pa.int32())],
                    names=["uid", "phrase", "start", "n"])

    return matches


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """uid, pair, place, other: places of two terms at most `within` words apart.

    pairs: pair (its key), first and second.
    """
    postings = index.select("uid", F.explode(F.arrays_zip("terms", "places")).alias("p"))
    one = postings.select("uid", F.col("p.terms").alias("first"), F.col("p.places").alias("a")).join(pairs, "first")
    two = postings.select("uid", F.col("p.terms").alias("second"), F.col("p.places").alias("b"))
    near = one.join(two, ["uid", "second"]).select("uid", "pair", "b", F.explode("a").alias("place"))
    return near.select("uid", "pair", "place", F.explode(F.filter("b", lambda p: F.abs(p - F.col("place")) <= within)).alias("other")).where("place <> other")


def decontaminate(documents: DataFrame, benchmark: DataFrame, work: Workspace, width: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated and items per row of `documents`.

    `uid` tells rows of equal doc_id apart.
    """
    windows = benchmark_windows(benchmark, width)
    owners = work.store(windows.groupBy("terms").agg(F.collect_set("item_id").alias("items"), F.count(F.lit(1)).alias("copies"))
                        .withColumn("phrase", F.monotonically_increasing_id()), "windows")
    index = work.store(build_index(documents, vocabulary_filter(owners.select(F.explode("terms").alias("term")))), "index")
    matches = work.store(phrase_matches(index, owners.select("phrase", "terms"), work), "matches")

    # hit words: what each match adds beyond the matches that start before it
    spans = matches.groupBy("uid", "start").agg(F.max("n").alias("n"))
    before = Window.partitionBy("uid").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    reach = F.coalesce(F.max(end).over(before), F.lit(0))
    hit = spans.select("uid", F.greatest(end - F.greatest("start", reach), F.lit(0)).alias("new")).groupBy("uid").agg(F.sum("new").alias("n_hit"))
    items = (
        matches.select("uid", "phrase").distinct().join(owners.select("phrase", F.explode_outer("items").alias("item_id")), "phrase")
        .groupBy("uid").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    totals = index.select("uid", "doc_id", "th", "n_words")
    none = F.array().cast("array<string>")
    return totals.join(hit.join(items, "uid"), "uid", "left").select(
        "uid", "doc_id", "th", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), F.coalesce("items", none).alias("items"))

"""Exact duplicates by an index of live text digests in cuckoo filters.

The index knows which digests are live.  Digests are dealt to shards by their first bits;
a shard is a cuckoo filter of fixed size (`BUCKETS` buckets of four 16-bit fingerprints),
held by one task at a time.  `add` looks every digest up before it is inserted: on a miss
the text is new and nothing else is read for it; a hit is a suspicion.  Texts of hit
digests, and only those, are dealt into buckets by digest and compared as they are, so a
false hit costs a comparison and never a wrong group.  A hit by chance on a digest that
was not live is inserted all the same, so each live digest owns exactly one fingerprint.
`remove` takes the digests of which no live row is left out again.

A filter that can't place a fingerprint reports an overflow; the index then gets twice as
many shards, filled anew from the digests stored with the rows.  Room for the rows of a
batch is made beforehand in the same way, so a task never sees more than about
`LOAD` of a filter.

Rows are stored in segments, one per `add`, with their digest; removals are stored as
(doc_id, last segment they apply to).  Copies of a digest are combined in the task that
reads them, before they are dealt out: a text with a third of all rows reaches its shard
as one row for every `COMBINE` rows or task.

Defined results: null counts as the empty text; equal means identical text, without any
normalisation; the row with the largest doc_id stays, null being the smallest, and among
rows equal in both any one; every row, repeated ones too, counts in group_size; other
columns are ignored; an empty table gives no rows; texts of any length are compared whole.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tarmac.llm.common import Workspace

#: Size of one filter: 4 slots of 2 bytes each, 256 KB.
BUCKETS = 1 << 15
SLOTS = 4
#: Share of the slots that a shard is planned to fill; the table works up to about 0.95.
LOAD = 0.6
#: Moves of fingerprints before a filter counts as full.
KICKS = 500
#: Digests that a task combines at once.
COMBINE = 200_000

FILTERS = "shard bigint, slots binary, n bigint"
OUTCOME = "kind string, shard bigint, digest binary, slots binary, n bigint"


class CuckooFilter:
    """A multiset of fingerprints; every key has two buckets, and either follows from the other and the fingerprint."""

    def __init__(self, buckets: int, slots: bytes | None = None) -> None:
        self.mask = buckets - 1
        self.slots = array("H", slots if slots is not None else bytes(2 * SLOTS * buckets))

    def _places(self, key: int) -> tuple[int, int, int]:
        print_ = (key >> 48) or 1
        first = key & self.mask
        return print_, first, self._other(first, print_)

    def _other(self, bucket: int, print_: int) -> int:
        return (bucket ^ (print_ * 0x5BD1E995 >> 7)) & self.mask

    def _put(self, bucket: int, print_: int) -> bool:
        for s in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
            if not self.slots[s]:
                self.slots[s] = print_
                return True
        return False

    def __contains__(self, key: int) -> bool:
        print_, a, b = self._places(key)
        return print_ in self.slots[SLOTS * a : SLOTS * a + SLOTS] or print_ in self.slots[SLOTS * b : SLOTS * b + SLOTS]

    def insert(self, key: int) -> bool:
        """False on overflow; the filter has then lost a fingerprint and must be made anew."""
        print_, a, b = self._places(key)
        if self._put(a, print_) or self._put(b, print_):
            return True
        bucket = b
        for k in range(KICKS):
            s = SLOTS * bucket + (print_ + k) % SLOTS
            print_, self.slots[s] = self.slots[s], print_
            bucket = self._other(bucket, print_)
            if self._put(bucket, print_):
                return True
        return False

    def delete(self, key: int) -> bool:
        """Only for keys that are in: take one fingerprint of the key out."""
        print_, a, b = self._places(key)
        for bucket in (a, b):
            for s in range(SLOTS * bucket, SLOTS * bucket + SLOTS):
                if self.slots[s] == print_:
                    self.slots[s] = 0
                    return True
        return False


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, n) with copies within a task counted together."""
    seen: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], names=["digest", "n"])

    for batch in batches:
        for d in batch[0].to_pylist():
            seen[d] = seen.get(d, 0) + 1
        if len(seen) > COMBINE:
            yield out()
            seen = {}
    yield out()


def _shard(shards: int) -> Column:
    """By the first 32 bits of the digest."""
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("bigint"), F.lit(shards))


def _key(digest: bytes) -> int:
    return int.from_bytes(digest[8:16], "little")


def _rows(kind: str, shard: int, digests=(), slots: bytes | None = None, n: int = 0) -> pd.DataFrame:
    many = list(digests) if slots is None else [None]
    return pd.DataFrame({
        "kind": kind, "shard": shard, "digest": pd.Series(many, dtype=object),
        "slots": pd.Series([slots] * len(many), dtype=object), "n": n})


class DigestIndex:
    """Live texts.  `digested` rows are doc_id, digest, check (a second hash), text."""

    def __init__(self, work: Workspace, buckets: int = BUCKETS, shards: int = 1) -> None:
        self.work, self.buckets, self.shards, self.rows = work, buckets, shards, 0
        self.segments: list[DataFrame] = []
        self.removals: list[DataFrame] = []
        self.suspects: list[DataFrame] = []
        self.filters = work.spark.createDataFrame([], FILTERS)

    # ---- changes

    def add(self, documents: DataFrame) -> None:
        """Take the rows of `documents` (doc_id, text) in."""
        text = F.coalesce(F.col("text"), F.lit(""))
        rows = documents.select(
            F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
            F.unhex(F.sha2(text, 256)).alias("digest"), F.xxhash64(text).alias("check"), text.alias("text"))
        segment = self.work.store(rows, f"segment-{len(self.segments)}")
        n = segment.count()
        self._reserve(self.rows + n)
        keys = self.work.store(segment.select("digest").mapInArrow(combined, "digest binary, n bigint"), "keys")
        outcome = self._apply(keys, "add")
        hits = outcome.where("kind = 'hit' OR kind = 'again'").select("digest").distinct()
        if self.segments:
            # A hit by chance: no live row has the digest, and the batch put none in for it.
            strange = outcome.where("kind = 'hit'").select("digest").distinct()
            mine = outcome.where("kind = 'new'").select("digest")
            chance = strange.join(self._live(text=False), "digest", "left_anti").join(mine, "digest", "left_anti")
        else:
            chance = outcome.where("kind = 'hit'").select("digest").distinct()
        chance = self.work.store(chance.withColumn("n", F.lit(1).cast("bigint")), "chance")
        self.suspects.append(self.work.store(hits, "suspects"))
        self.segments.append(segment)
        self.rows += n
        if chance.limit(1).count():
            self._apply(chance, "force")

    def remove(self, documents: DataFrame) -> None:
        """Take all live rows with a doc_id of `documents` out."""
        ids = documents.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
        gone = self.work.store(ids, "gone")
        before = self._live(text=False)
        touched = self.work.store(before.join(gone, "doc_id", "left_semi").select("digest").distinct(), "touched")
        self.removals.append(gone.withColumn("upto", F.lit(len(self.segments))))
        dead = touched.join(self._live(text=False), "digest", "left_anti").withColumn("n", F.lit(1).cast("bigint"))
        self._apply(self.work.store(dead, "dead"), "delete")

    def _apply(self, keys: DataFrame, how: str) -> DataFrame:
        """Run `keys` (digest, n) through the filters of their shards; on overflow with twice the shards."""
        buckets = self.buckets

        def shard(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            filter_ = CuckooFilter(buckets, old["slots"].iloc[0] if len(old) else None)
            n = int(old["n"].iloc[0]) if len(old) else 0
            fresh, hits, again = [], [], []
            mine: set[bytes] = set()
            for digest, count in zip(new["digest"], new["n"]):
                k = _key(digest)
                if how == "delete":
                    n -= filter_.delete(k)
                    continue
                if how == "add" and k in filter_:
                    (again if digest in mine else hits).append(digest)
                    continue
                if not filter_.insert(k):
                    return _rows("overflow", key[0], [b""])
                n += 1
                fresh.append(digest)
                mine.add(digest)
                if count > 1:
                    again.append(digest)
            return pd.concat([
                _rows("filter", key[0], slots=filter_.slots.tobytes(), n=n), _rows("new", key[0], fresh),
                _rows("hit", key[0], hits), _rows("again", key[0], again)])

        while True:
            dealt = keys.withColumn("shard", _shard(self.shards)).groupBy("shard")
            made = self.filters.groupBy("shard").cogroup(dealt).applyInPandas(shard, OUTCOME)
            outcome = self.work.store(made, "outcome")
            if not outcome.where("kind = 'overflow'").limit(1).count():
                self.filters = outcome.where("kind = 'filter'").select("shard", "slots", "n")
                return outcome
            self._resize(2 * self.shards)

    def _reserve(self, rows: int) -> None:
        shards = self.shards
        while rows > LOAD * SLOTS * self.buckets * shards:
            shards *= 2
        if shards > self.shards:
            self._resize(shards)

    def _resize(self, shards: int) -> None:
        """Filters of `shards` shards from the digests stored with the live rows."""
        self.shards, self.filters = shards, self.work.spark.createDataFrame([], FILTERS)
        if self.segments:
            live = self._live(text=False).select("digest").mapInArrow(combined, "digest binary, n bigint")
            self._apply(self.work.store(live.groupBy("digest").agg(F.sum("n").alias("n")), "stored"), "force")

    # ---- questions

    def _live(self, text: bool) -> DataFrame:
        """Rows of all segments that no removal applies to."""
        out = None
        for k, segment in enumerate(self.segments):
            part = segment if text else segment.drop("text")
            part = part.withColumn("segment", F.lit(k))
            for gone in self.removals:
                part = part.join(gone.where(F.col("upto") > k), "doc_id", "left_anti")
            out = part if out is None else out.unionByName(part)
        return out

    def contains(self, documents: DataFrame) -> DataFrame:
        """Rows of `documents` (doc_id, text) whose text is live: the filter asked first, its hits compared as text."""
        text = F.coalesce(F.col("text"), F.lit(""))
        asked = self.work.store(documents.select("doc_id", text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest")), "asked")
        buckets = self.buckets

        def probe(key: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
            filter_ = CuckooFilter(buckets, old["slots"].iloc[0] if len(old) else None)
            return pd.DataFrame({"digest": pd.Series([d for d in new["digest"] if _key(d) in filter_], dtype=object)})

        dealt = asked.select("digest").mapInArrow(combined, "digest binary, n bigint").withColumn("shard", _shard(self.shards))
        hits = self.work.store(
            self.filters.groupBy("shard").cogroup(dealt.groupBy("shard")).applyInPandas(probe, "digest binary").distinct(), "hits")
        stored = self._live(text=True).join(hits, "digest", "left_semi").select("digest", "text").distinct()
        return asked.join(hits, "digest", "left_semi").join(stored, ["digest", "text"], "left_semi").select("doc_id", "text")

    def groups(self) -> DataFrame:
        """One row per live row: doc_id, keep_id, group_size, kept, text_sha256."""
        hits = self.suspects[0]
        for more in self.suspects[1:]:
            hits = hits.unionByName(more)
        hits = hits.distinct()
        rows = self.work.store(self._live(text=False), "live")
        marked = self.work.store(rows.join(hits, "digest", "left_semi").select("segment", "row"), "marked")
        # Joined on the row, not on the digest: copies lie everywhere, and are counted together before they are dealt out.
        alike = self._live(text=True).join(marked, ["segment", "row"], "left_semi")
        last = F.max(F.struct("doc_id", "segment", "row")).alias("last")
        content = alike.groupBy("digest", "check", "text").agg(F.count(F.lit(1)).alias("size"), last).drop("text")
        content = self.work.store(content, "content")
        twice = content.groupBy("digest", "check").count().where("count > 1")
        if twice.limit(1).count():
            raise RuntimeError("two texts share a SHA-256 digest and a 64-bit hash")
        own = (F.col("last.segment") == F.col("segment")) & (F.col("last.row") == F.col("row"))
        out = rows.join(content, ["digest", "check"], "left")
        alone = F.col("size").isNull()
        return out.select(
            "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
            F.coalesce("size", F.lit(1).cast("bigint")).alias("group_size"), (alone | own).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"))


def exact_duplicates(documents: DataFrame, work: Workspace, **how: int) -> DataFrame:
    index = DigestIndex(work, **how)
    index.add(documents)
    return index.groups()

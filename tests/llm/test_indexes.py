"""Digest index, phrase counts and Merkle manifest against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tarmac.llm import collocations, cuckoo_index, line_dedup, merkle_manifest
from tarmac.llm.common import LOWER, Workspace

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns that the operators use for themselves.
CLASH = ["digest", "row", "tree", "idx", "n", "h", "shard", "kind", "word", "codes", "lg", "at", "segment"]


@pytest.fixture()
def work(spark):
    space = Workspace(spark, "index-test")
    yield space
    space.close()


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    own = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    return own + own[:3] + [
        (7, None, None, None, None), (7, None, "", "x", 3), (7, "A. b,c " * 40, "", "x", 3), (None, "only", "only", "x", 3),
        (7, "A b  c\t" * 40, None, "x", 3), (7, "A b  c\t" * 40, None, "x", 3), (9001, own[0][1] * 300, "en", "x", 3)]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit("z") for c in CLASH})


# 11 -----------------------------------------------------------------------------------

def groups(rows):
    by = {}
    for i, (doc, text) in enumerate(rows):
        by.setdefault(text or "", []).append((doc is not None, doc or 0, i))
    out = []
    for text, same in by.items():
        last = max(same)
        out += [(x[1] if x[0] else None, last[1] if last[0] else None, len(same), x == last, hashlib.sha256(text.encode()).hexdigest()) for x in same]
    return Counter(out)


def told(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


@pytest.mark.parametrize("how", [{}, {"buckets": 16}, {"buckets": 4, "shards": 4}])
def test_copies_equal_brute_force(spark, work, rows, how):
    got = told(cuckoo_index.exact_duplicates(frame(spark, rows), work, **how))
    assert got == groups([r[:2] for r in rows])


def test_no_documents_no_copies(spark, work):
    assert cuckoo_index.exact_duplicates(frame(spark, []), work).count() == 0


def test_filter_with_deletions():
    rng, live = random.Random(1), []
    filter_ = cuckoo_index.CuckooFilter(64)
    for _ in range(5000):
        if live and rng.random() < 0.45:
            assert filter_.delete(live.pop(rng.randrange(len(live))))
        elif len(live) < 230:
            live.append(rng.getrandbits(64))
            assert filter_.insert(live[-1])
        assert all(k in filter_ for k in live[::20])
    assert sum(1 for s in filter_.slots if s) == len(live)
    assert sum(rng.getrandbits(64) in filter_ for _ in range(20000)) < 20
    while filter_.insert(rng.getrandbits(64)):
        live.append(0)
    assert len(live) > 0.9 * 256


def test_life_of_an_index(spark, work):
    rng, live, index = random.Random(2), [], cuckoo_index.DigestIndex(work, buckets=16)
    make = lambda x: spark.createDataFrame(x, "doc_id bigint, text string")
    for _ in range(3):
        batch = [(rng.randrange(300), rng.choice([f"t{rng.randrange(60)}", None, ""])) for _ in range(120)]
        index.add(make(batch))
        gone = rng.sample(range(300), 60)
        index.remove(make([(g, None) for g in gone]))
        live = [r for r in live + batch if r[0] not in gone]
    texts = {t or "" for _, t in live}
    assert told(index.groups()) == groups(live)
    assert index.filters.agg(F.sum("n")).first()[0] == len(texts)
    assert index.shards > 1
    asked = [(i, f"t{i}") for i in range(80)]
    assert {r.doc_id for r in index.contains(make(asked)).collect()} == {i for i, t in asked if t in texts}


# 12 -----------------------------------------------------------------------------------

def phrases(rows, least, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        often = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = Counter()
        for q, b in often.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    covered[q[i : i + m]] = max(covered[q[i : i + m]], b)
        found = []
        for p, a in often.items():
            if 100 * covered[p] < 80 * a:
                score, k = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, p, x, y) in enumerate(sorted(found)[:top]):
            out.append((lang, i + 1, p.decode(), -a, x, y, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("how", [{}, {"least": 4, "top": 50, "block": 300, "send": 20_000}])
def test_phrases_equal_brute_force(spark, work, rows, how):
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), work, **how).collect())
    assert got and got == phrases([(r[2], r[1]) for r in rows], how.get("least", 30), how.get("top", 2000))


def test_no_documents_no_phrases(spark, work):
    assert collocations.collocations(frame(spark, []), work).count() == 0


def test_large_counts_stay_exact(spark):
    a, b = 3 * 10**18, 4 * 10**18
    often = spark.createDataFrame([(1, [1, 2], a)], "lg bigint, w array<bigint>, n bigint")
    single = spark.createDataFrame([(1, 1, a), (1, 2, b)], "lg bigint, code bigint, n bigint")
    assert collocations._scored(often, single).first()["score"] == 2_000_000 * a // (a + b)


def test_double_array_accepts_its_paths_only():
    rng = np.random.default_rng(3)
    paths = list({tuple(int(x) for x in np.minimum(rng.pareto(0.8, k) * 3 + 1, 4000)) for k in rng.integers(1, 6, 4000)})
    trie = collocations.DoubleArray(paths)
    prefixes = {p[:k] for p in paths for k in range(1, len(p) + 1)}

    def state(path):
        s = np.zeros(1, np.int64)
        for c in path:
            if s[0] < 0:
                return -1
            s = collocations.advance(trie.base, trie.check, s, np.array([c]))
        return s[0]

    assert [state(p) for p in paths] == trie.accept.tolist() and len(set(trie.accept)) == len(paths)
    strange = [tuple(int(x) for x in rng.integers(0, 4100, 3)) for _ in range(2000)]
    assert all((state(p) >= 0) == (p in prefixes) for p in strange)


# 13 -----------------------------------------------------------------------------------

def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def manifest(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, more=0: digest(
        field(r[0]) + field(r[3]) + field(r[2]) + field(None if r[4] is None else r[4] + more) + field(r[1]))

    def levels(nodes):
        out = [nodes]
        while len(nodes) > 1:
            nodes = [digest("".join(nodes[i : i + 2])) for i in range(0, len(nodes), 2)]
            out.append(nodes)
        return out

    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = levels([leaf(r) for r in by[lang]])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = Counter()
    for k, lang in enumerate(langs):
        for i, r in enumerate(by[lang]):
            h, sibs = leaf(r, int(r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0)), []
            for nodes_of, at in ((trees[lang], i), (top, k)):
                for nodes in nodes_of[:-1]:
                    other = at ^ 1
                    if other < len(nodes):
                        sibs.append(nodes[other])
                        h = digest(nodes[other] + h if other < at else h + nodes[other])
                    else:
                        h = digest(h)
                    at >>= 1
            out[r[0], leaf(r), trees[lang][-1][0], top[-1][0], digest("".join(sibs)), h, h == top[-1][0]] += 1
    return out


@pytest.mark.parametrize("step", [6, 1, 3])
def test_manifest_equals_brute_force(spark, work, rows, step):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    got = merkle_manifest.manifest(frame(spark, rows), work, tampered, step)
    assert Counter(tuple(r) for r in got.collect()) == manifest(rows)


def test_manifest_of_one_document_and_of_none(spark, work):
    one = merkle_manifest.manifest(frame(spark, [(5, "x", "en", "s", 1)]), work).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.verified and one.proof_sha256 == digest("")
    assert merkle_manifest.manifest(frame(spark, []), work).count() == 0


# Names that operators use for themselves ---------------------------------------------

def test_line_dedup_keeps_columns_of_any_name(spark, work):
    run = "\n".join(f"line {k} has some words of its own" for k in range(9))
    rows = [(1, run, "a", 5), (2, "first\n" + run, "b", 6), (2, "first\n" + run, "b", 6), (None, None, "c", 7)]
    names = ["gone", "_own", "_doc", "own", "row", "doc", "th", "n_removed"]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_lines bigint").withColumns({n: F.lit(n) for n in names})
    out = line_dedup.dedup_lines(docs, work)
    assert len(out.columns) == len(set(out.columns)) == len(docs.columns)
    got = sorted(((r.doc_id, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)
    assert got == sorted([(1, run, 9, 0), (2, "first", 10, 9), (2, "first", 10, 9), (None, None, 0, 0)], key=str)
    assert all(r[n] == n for r in out.collect() for n in names if n != "n_removed")
    assert line_dedup.dedup_lines(docs.where("false"), work).count() == 0


def test_pipeline_stages_keep_columns_of_any_name(spark, sf_dir, work):
    names = ["_th", "_key", "th", "own_th", "key_th", "id", "gone", "own"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumns({n: F.lit(n) for n in names})
    seen = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.where("false"), sf_dir).count() == 0
        out = work.store(stage(spark, docs.unionByName(docs.limit(2)), sf_dir), "stage")
        assert out.columns == docs.columns and 0 < out.count() <= seen + 2
        assert out.where(" OR ".join(f"{n} <> '{n}'" for n in names)).count() == 0
        assert "Jaccard" not in name or out.groupBy("doc_id").count().where("count > 1").count() == 0
        docs, seen = out, out.count()

"""Line dedup by prefix doubling over line-ID sequences.

Only DataFrame functions are used.  A document is the sequence of its lines that have
words.  A run of lines of `min_words` words or more that stood earlier in the corpus, in
order of document and line, is deleted; its first copy stays.

1. Lines get IDs.  A line that occurs once cannot be in a repeated run, so only stretches
   of repeated lines go on.
2. Every repeated run is the union of its shortest sub-runs of `min_words` words: one from
   each of its starts, one to each of its ends.  So these are the prefixes to be compared.
   Every line has a word, so they have at most `min_words` lines.
3. Prefix doubling: the rank of a prefix of 2^(k+1) lines comes from the pair of ranks of
   its halves.  A prefix of m lines is named by the ranks of its first and its last 2^k
   lines, 2^k <= m.  Suffixes with one name are an interval of the suffix array with a
   common prefix of m lines.  An interval of one suffix is dropped at once.
4. In each interval the earliest suffix is the first copy; the lines of the others are
   deleted, so the maximal runs go as unions of their parts.

Ranks are numbers of groups, so ranking needs no global sort, and every step is a grouping
that combines before it shuffles, or a join on ranks.  Both sides of these joins grow with
the corpus, so they are merge joins at any size, and adaptive execution splits hot ranks.

Defined results: null text stays null; lines without words stay where they are, but a
text of which no line of words is left becomes empty; line IDs are 128-bit hashes; rows
with one doc_id are ordered by a hash of their texts, and rows that agree in both are the
same document, not copies; a null doc_id comes first; further columns are kept, whatever
their names, except n_lines and n_removed, which are replaced; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tarmac.llm.common import Workspace

MIN_WORDS = 50
#: Words of a line: runs without white space.
RUN = r"[^\x20\x09-\x0D]+"
DOC = ["doc_id", "th"]


def line_table(documents: DataFrame) -> DataFrame:
    """doc_id, th, i (number among lines with words), line, w (words), h1, h2."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    row = F.transform(lines, lambda s, p: F.struct(
        p.alias("line"), F.regexp_count(s, F.lit(RUN)).alias("w"), F.xxhash64(s).alias("h1"), F.xxhash64(F.lit(1), s).alias("h2")))
    return documents.select(
        "doc_id", F.xxhash64("text").alias("th"), F.posexplode(F.filter(row, lambda r: r["w"] > 0)).alias("i", "r")
    ).select(*DOC, "i", "r.*")


def _stretches(lines: DataFrame, min_words: int, work: Workspace) -> DataFrame:
    """Stretches of repeated lines: doc_id, th, first (its start), names, lines, wins (start and length of prefixes)."""
    repeated = work.store(
        lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("h1", "h2", F.monotonically_increasing_id().alias("name")), "line-ids")
    here = lines.join(repeated.hint("merge"), ["h1", "h2"]).groupBy(*DOC, "i").agg(F.first(F.struct("line", "w", "name")).alias("r")).select(*DOC, "i", "r.*")
    doc = Window.partitionBy(*DOC)
    marked = here.withColumn("stretch", F.col("i") - F.row_number().over(doc.orderBy("i")))
    part = Window.partitionBy(*DOC, "stretch")
    marked = marked.withColumn("ce", F.sum("w").over(part.orderBy("i")))
    marked = marked.withColumns({"cb": F.col("ce") - F.col("w"), "down": F.col("w") - F.col("ce")})
    all_ = part.orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the last line before the prefix that ends here; the first line behind the prefix that starts here
    before = F.max("i").over(part.orderBy("ce").rangeBetween(Window.unboundedPreceding, -min_words))
    behind = F.min("i").over(part.orderBy("down").rangeBetween(Window.unboundedPreceding, -min_words))
    marked = marked.withColumns({"first": F.min("i").over(all_), "last": F.max("i").over(all_), "total": F.sum("w").over(all_)})
    marked = marked.where(F.col("total") >= min_words).withColumns({"before": before, "behind": behind})
    from_here = F.when(F.col("total") - F.col("cb") >= min_words, F.struct(
        (F.col("i") - F.col("first")).alias("a"), (F.coalesce("behind", F.col("last") + 1) - F.col("i")).alias("m")))
    start = F.coalesce(F.col("before") + 1, F.col("first"))
    to_here = F.when(F.col("ce") >= min_words, F.struct((start - F.col("first")).alias("a"), (F.col("i") + 1 - start).alias("m")))
    return marked.groupBy(*DOC, "stretch").agg(
        F.min("first").alias("first"), F.sort_array(F.collect_list(F.struct("i", "line", "name"))).alias("rows"),
        F.array_union(F.collect_set(from_here), F.collect_set(to_here)).alias("wins"),
    ).select(*DOC, "first", F.col("rows.name").alias("names"), F.col("rows.line").alias("lines"), "wins")


def _doubled(level: DataFrame, width: int, work: Workspace) -> DataFrame:
    """From ranks of `width` lines to ranks of twice as many; null where nothing repeats."""
    wins = F.filter("wins", lambda w: w["m"] >= 2 * width)
    longer = level.withColumn("wins", wins).where(F.size("wins") > 0)
    pairs = F.transform(
        F.slice("names", 1, F.greatest(F.size("names") - width, F.lit(0))),
        lambda x, j: F.struct(x.alias("x"), F.element_at("names", j + width + 1).alias("y")))
    rows = work.store(longer.select(*DOC, "first", F.posexplode(pairs).alias("j", "p")).select(*DOC, "first", "j", "p.*"), f"pairs-{width}")
    ranks = work.store(
        rows.where("x IS NOT NULL AND y IS NOT NULL").groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select("x", "y", F.monotonically_increasing_id().alias("name")), f"ranks-{width}")
    named = rows.join(ranks, ["x", "y"], "left").groupBy(*DOC, "first").agg(
        F.sort_array(F.collect_list(F.struct("j", "name"))).alias("rows"))
    return longer.drop("names").join(named, _same(longer, named, [*DOC, "first"])).select(
        longer["doc_id"], longer["th"], longer["first"], F.col("rows.name").alias("names"), "lines", "wins")


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    met = a[keys[0]].eqNullSafe(b[keys[0]])
    for k in keys[1:]:
        met = met & (a[k] == b[k])
    return met


def repeated_lines(lines: DataFrame, work: Workspace, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, th and `gone`: the numbers of the lines to delete."""
    level = work.store(_stretches(lines, min_words, work), "stretches")
    width, windows = 1, []
    while True:
        own = F.filter("wins", lambda w: (w["m"] >= width) & (w["m"] < 2 * width))
        windows.append(level.select(*DOC, "first", "names", "lines", F.explode(own).alias("w")).select(
            *DOC, (F.col("first") + F.col("w.a")).alias("at"), "w.m", F.element_at("names", F.col("w.a") + 1).alias("x"),
            F.element_at("names", F.col("w.a") + F.col("w.m") - width + 1).alias("y"),
            F.slice("lines", F.col("w.a") + 1, F.col("w.m")).alias("lines")).where("x IS NOT NULL AND y IS NOT NULL"))
        if 2 * width > min_words or level.where(F.exists("wins", lambda w: w["m"] >= 2 * width)).isEmpty():
            break
        level = work.store(_doubled(level, width, work), f"stretches-{2 * width}")
        width *= 2
    table = windows[0]
    for more in windows[1:]:
        table = table.unionByName(more)
    table = work.store(table, "prefixes")
    intervals = table.groupBy("m", "x", "y").agg(
        F.min(F.struct("doc_id", "th", "at")).alias("copy"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = table.join(intervals.hint("merge"), ["m", "x", "y"]).where(~F.col("copy").eqNullSafe(F.struct("doc_id", "th", "at")))
    return later.select(*DOC, F.explode("lines").alias("line")).groupBy(*DOC).agg(F.collect_set("line").alias("gone"))


def dedup_lines(documents: DataFrame, work: Workspace, min_words: int = MIN_WORDS) -> DataFrame:
    """`documents` with later copies deleted from `text`, and n_lines and n_removed, which replace columns of these names."""
    lines = work.store(line_table(documents), "lines")
    gone = work.store(repeated_lines(lines, work, min_words), "gone")
    # The row is packed, so that its columns may have any names.
    keyed = documents.select(F.struct(*[documents[c] for c in documents.columns]).alias("row"), F.xxhash64("text").alias("own"))
    joined = keyed.join(gone.hint("merge"), F.col("row.doc_id").eqNullSafe(gone["doc_id"]) & (keyed["own"] == gone["th"]), "left")
    text = F.col("row")["text"]
    parts = F.split(text, "\n", -1)
    left = F.filter(parts, lambda s, p: ~F.array_contains(gone["gone"], p))
    words_left = F.exists(left, lambda s: s.rlike(RUN))
    shorter = F.when(gone["gone"].isNull(), text).when(words_left, F.array_join(left, "\n")).otherwise("")
    return joined.select(
        *[(shorter if c == "text" else F.col("row")[c]).alias(c) for c in documents.columns if c not in ("n_lines", "n_removed")],
        F.coalesce(F.size(parts), F.lit(0)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size(gone["gone"]), F.lit(0)).cast("bigint").alias("n_removed"))

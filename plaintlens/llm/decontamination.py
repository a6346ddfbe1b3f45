"""Benchmark decontamination by winnowing, in DataFrame and SQL functions only.

A window is ``WINDOW`` consecutive words of a benchmark item; an item of fewer words (but some)
is one window of all of them. A document word is *hit* when it lies inside any occurrence of any
window in the document.

Method (winnowing): every text is cut into words; each run of ``k`` words gets a 64-bit hash, and
of every ``w`` consecutive hashes the smallest (the rightmost of equal ones) is kept as a
fingerprint together with its position. With ``w + k - 1`` no longer than the shortest window,
every window that a document shares with an item holds one whole winnowing window, so both sides
keep the same fingerprint at the same place inside the shared span: joining document and item
fingerprints on the hash finds every shared window. Each fingerprint carries the words around
it, enough to hold every window that contains it; a hit is then extended over the offsets the
anchor allows and confirmed word by word, so hash clashes never make a hit.

Scale: tokenising, hashing and winnowing are per row (no shuffle, memory of one text). The item
fingerprints are broadcast when their count is within ``BROADCAST_ROWS`` (counted first), else
both sides are joined by a shuffle whose hot hashes AQE splits. Only confirmed hits and one short
row per document reach the final grouping, which is keyed by doc_id and a digest of the text, so
one doc_id with many different texts is spread over many keys.

Defined cases: null or empty text, or text without a word: n_words 0, nothing hit. Null item
text: no window. Very long texts: arrays of one text in one task; cost grows with its words
times ``w``. Rows that repeat (same doc_id and text) give one equal output row each; rows
sharing a doc_id with different texts are separate documents. A null doc_id is a key of its own.
Items sharing an item_id count as one item. Columns besides doc_id/text (item_id/text) are
ignored, whatever their names. Empty tables give no rows (documents) or no hits (benchmark).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: window length, word pattern, letters lower-cased.
WINDOW = 10
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Item fingerprints broadcast up to this many rows (counted before); beyond, a shuffle join.
BROADCAST_ROWS = 2_000_000


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), 0)


def parameters(shortest: int) -> tuple[int, int]:
    """(k, w) with w + k - 1 == shortest window: every shared window holds a winnowing window."""
    t = max(1, min(WINDOW, shortest))
    k = (t + 1) // 2
    return k, t - k + 1


def _shifted(col: str, d: int) -> Column:
    """The array without its first ``d`` elements (shorter arrays give an empty one)."""
    return F.slice(col, d + 1, F.greatest(F.size(col) - d, F.lit(0)))


#: Low bits of a winnowed number that hold the position (as LAST - position); the rest is hash.
PLACE_BITS = 30
LAST = (1 << PLACE_BITS) - 1


def with_fingerprints(df: DataFrame, k: int, w: int) -> DataFrame:
    """Adds ``fps`` to a frame with words ``w``: array<long>, the winnowed k-word hashes: each the
    upper bits of a hash with its place below (see :func:`hash_of`, :func:`place_of`).

    Every step is a whole-array operation over shifted copies (``zip_with``), never a slice a
    window, so a text of n words costs O(n (log k + log w)); each step is its own column. Hash and
    place share one number, counted down from the right, so the smallest number of a window is
    its smallest hash, the rightmost of equal ones.
    """
    n = F.size("w")
    # a generator keeps the projections apart, so the words are split once a row and not again
    # inside every lambda that reads them
    step = df.withColumn("w", F.explode(F.array("w")))
    step = step.withColumn("_g1", F.transform("w", lambda x: F.xxhash64(x)))
    # k-word hashes, by doubling the run they cover
    run = 1
    while run < k:
        add = min(run, k - run)
        step = step.withColumn(
            f"_g{run + add}",
            F.zip_with(
                F.slice(f"_g{run}", 1, F.greatest(n - (run + add) + 1, F.lit(0))), _shifted(f"_g{add}", run),
                lambda a, b: F.xxhash64(a, b),
            ),
        )
        run += add
    high = F.lit(-(LAST + 1))
    step = step.withColumn(
        "_c1", F.transform(f"_g{k}", lambda h, i: h.bitwiseAND(high).bitwiseOR(F.lit(LAST) - i))
    )
    # smallest number of the windows of w, by doubling the covered span
    span = 1
    while span < w:
        add = min(span, w - span)
        step = step.withColumn(f"_c{span + add}", F.zip_with(f"_c{span}", _shifted(f"_c{add}", span), lambda a, b: F.least(a, b)))
        span += add
    n_windows = F.greatest(n - (k + w - 1) + 1, F.lit(0))
    step = step.withColumn("_win", F.slice(f"_c{w}", 1, n_windows))
    # window minima move right only: equal ones are one place
    temps = [c for c in step.columns if c == "_win" or c[:2] in ("_g", "_c") and c[2:].isdigit()]
    return step.withColumn("fps", F.array_distinct("_win")).drop(*temps)


def hash_of(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(-(LAST + 1)))


def place_of(fp: Column) -> Column:
    return (F.lit(LAST) - fp.bitwiseAND(F.lit(LAST))).cast("int")


def with_context(df: DataFrame, q: str, c0: str, ctx: str, k: int) -> DataFrame:
    """Adds the words from ``c0`` = max(0, q - (WINDOW - k)) to q + WINDOW (clipped)."""
    start = F.greatest(F.lit(0), F.col(q) - (WINDOW - k))
    return df.withColumn(c0, start).withColumn(ctx, F.slice("w", F.col(c0) + 1, F.col(q) + WINDOW - F.col(c0)))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = (
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("w"))
        .withColumn("m", F.size("w"))
        .where(F.col("m") > 0)
    )
    shortest = items.agg(F.min(F.least(F.col("m"), F.lit(window)))).first()[0] or window
    k, w = parameters(shortest)

    item_fps = with_context(
        with_fingerprints(items, k, w)
        .select(
            "item_id", "w", F.least(F.col("m"), F.lit(window)).alias("L"), "m", F.explode("fps").alias("f")
        )
        .select("item_id", "w", "L", "m", hash_of(F.col("f")).alias("h"), place_of(F.col("f")).alias("iq")),
        "iq", "ic0", "ictx", k,
    ).drop("w")
    few = item_fps.count() <= BROADCAST_ROWS
    if few:
        item_fps = F.broadcast(item_fps)

    rows = with_fingerprints(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest"),
            words_of(F.col("text")).alias("w"),
        ),
        k,
        w,
    ).select("doc_id", "digest", "w", F.size("w").alias("n"), "fps")
    # one marker row per document (h null) besides its fingerprints
    marked = rows.select("doc_id", "digest", "w", "n", F.explode(F.concat(F.array(F.lit(None).cast("long")), F.col("fps"))).alias("f")).select(
        "doc_id", "digest", "w", "n", hash_of(F.col("f")).alias("h"), F.coalesce(place_of(F.col("f")), F.lit(-1)).alias("q")
    )
    # the marker and matched fingerprints stay; unmatched ones end in the same stage. Beside a
    # broadcast only matched ones take their words along, before a shuffle all do (not the whole text)
    if few:
        found = marked.join(item_fps, "h", "left").where((F.col("q") < 0) | F.col("iq").isNotNull())
        joined = with_context(found, "q", "c0", "ctx", k).drop("w")
    else:
        found = with_context(marked, "q", "c0", "ctx", k).drop("w").join(item_fps, "h", "left")
        joined = found.where((F.col("q") < 0) | F.col("iq").isNotNull())

    # offsets o of the anchor inside a window; a window starts at q - o in the document and
    # iq - o in the item, and is confirmed on its words
    def holds(o: Column) -> Column:
        p, s, L = F.col("q") - o, F.col("iq") - o, F.col("L")
        return (
            (s >= 0) & (s + L <= F.col("m")) & (p >= 0) & (p + L <= F.col("n"))
            & (F.slice("ctx", p - F.col("c0") + 1, L) == F.slice("ictx", s - F.col("ic0") + 1, L))
        )

    starts = F.when(
        F.col("iq").isNotNull(),
        F.transform(F.filter(F.sequence(F.lit(0), F.col("L") - k), holds), lambda o: F.col("q") - o),
    ).otherwise(F.array())
    hits = joined.select(
        "doc_id", "digest", "n", (F.col("q") < 0).alias("marker"), "item_id", "L", starts.alias("starts")
    )
    spans = F.transform(F.col("starts"), lambda p: F.struct(p.alias("p"), (p + F.col("L")).alias("e")))
    per_doc = hits.groupBy("doc_id", "digest").agg(
        F.max("n").alias("n"),
        F.sum(F.col("marker").cast("long")).alias("copies"),
        F.array_distinct(F.flatten(F.collect_list(spans))).alias("spans"),
        F.collect_set(F.when(F.size("starts") > 0, F.col("item_id"))).alias("items"),
    )
    covered = F.aggregate(
        F.array_sort(F.col("spans")),
        F.struct(F.lit(0).cast("long").alias("hit"), F.lit(-1).alias("end")),
        lambda acc, x: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["p"], acc["end"]))).alias("hit"),
            F.greatest(acc["end"], x["e"]).alias("end"),
        ),
    )["hit"]
    ids = F.array_sort(F.transform(F.col("items"), lambda i: i.cast("string")))
    result = per_doc.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        covered.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"),
    )
    return result.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))

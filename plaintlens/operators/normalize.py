"""Lemma lookup against a lexicon kept as a table (surface, pos, lemma)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.functions import text as T
from plaintlens.session import broadcast_if_small, written

#: Entries that change a word of the texts, broadcast up to this many; beyond, a shuffle join.
PASS_ENTRIES = 300_000

# A lexicon of up to this many entries travels inside the plan and needs no join.
MAX_LITERAL_ENTRIES = 20_000


def _verb_then_noun(lexicon: DataFrame) -> DataFrame:
    """surface -> final lemma, applying the verb entry first and the noun entry to its result."""
    one = W.partitionBy("surface", "pos").orderBy("lemma")
    entries = lexicon.withColumn("r", F.row_number().over(one)).filter("r = 1").drop("r")
    verbs = entries.filter("pos = 'v'").select("surface", F.col("lemma").alias("as_verb"))
    nouns = entries.filter("pos = 'n'").select(
        F.col("surface").alias("as_verb"), F.col("lemma").alias("as_noun")
    )
    surfaces = entries.select("surface").distinct().join(verbs, "surface", "left").withColumn(
        "as_verb", F.coalesce("as_verb", "surface")
    )
    return surfaces.join(nouns, "as_verb", "left").select(
        F.col("surface").alias("token"), F.coalesce("as_noun", "as_verb").alias("lemma")
    )


def _first_lemmas(entries) -> list[tuple[str, str, str]]:
    """One lemma per surface and part of speech: the smallest, as in the join."""
    best: dict[tuple[str, str], str] = {}
    for surface, pos, lemma in entries:
        best[surface, pos] = min(lemma, best.get((surface, pos), lemma))
    return [(surface, pos, lemma) for (surface, pos), lemma in best.items()]


def normalize_with_table(
    df: DataFrame, id_column: str, text_column: str, lexicon: DataFrame, out: str = "normalized"
) -> DataFrame:
    """Normalise cleaned text with a lexicon table of any size; ``id_column`` must be unique.

    A lexicon within :data:`MAX_LITERAL_ENTRIES` becomes a literal and the work stays narrow. For
    a larger one each text's distinct tokens are looked up in one join and come back as a
    per-text map, so a frequent word costs one row per text, not one per occurrence; the lexicon
    is broadcast only when its counted size allows.
    """
    columns = lexicon.select("surface", "pos", "lemma")
    entries = columns.limit(MAX_LITERAL_ENTRIES + 1).collect()
    if len(entries) <= MAX_LITERAL_ENTRIES:
        return df.withColumn(
            out, T.normalize(F.coalesce(F.col(text_column), F.lit("")), _first_lemmas(entries))
        )
    lemmas = broadcast_if_small(_verb_then_noun(lexicon), 300_000)
    # without a lexicon, normalising leaves the fused pairs parted and the stop words out
    words = T.normalize(F.coalesce(F.col(text_column), F.lit("")), [])
    tokens = df.withColumn("__lexicon_tokens", F.split(words, " "))
    maps = (
        tokens.select(id_column, F.explode(F.array_distinct("__lexicon_tokens")).alias("token"))
        .join(lemmas, "token")
        .groupBy(id_column)
        .agg(F.map_from_entries(F.collect_list(F.struct("token", "lemma"))).alias("_lemmas"))
    )
    return (
        tokens.join(maps, id_column, "left")
        .withColumn(
            out,
            F.array_join(
                F.transform(
                    "__lexicon_tokens", lambda t: F.coalesce(F.try_element_at("_lemmas", t), t)
                ),
                " ",
            ),
        )
        .drop("__lexicon_tokens", "_lemmas")
    )


def _replaced(pairs: pd.DataFrame) -> pd.Series:
    """Each row's tokens with its own (token, lemma) pairs applied, space-joined."""
    out = []
    for tokens, surfaces, lemmas in zip(pairs["tokens"], pairs["surfaces"], pairs["lemmas"]):
        lemma_of = {} if surfaces is None else dict(zip(surfaces, lemmas))
        out.append(" ".join([lemma_of.get(t, t) for t in tokens]))
    return pd.Series(out, dtype=object)


def normalize_with_lexicon(
    df: DataFrame, text_column: str, lexicon: DataFrame, out: str = "normalized", pass_entries: int = PASS_ENTRIES
) -> DataFrame:
    """Normalise cleaned text with a lexicon table of any size: the same rows as
    ``T.normalize(text, entries)`` with all entries held in the plan, for every row.

    The lexicon (surface, pos, lemma) is written once and resolved to one final lemma a surface
    (smallest lemma per surface and part of speech, verb entry then noun entry, as the literal
    form). Only entries that change a word of the texts go on: they are broadcast when at most
    ``pass_entries``, counted first, else joined by a shuffle. Each row's distinct tokens meet them
    once, under a key written with the row, so null, repeated or missing ids do not matter and every
    other column is kept; the changed tokens come back to the row as its own pairs. No row
    carries more than its own words. The fused pairs and the stop words they leave need the lemmas
    of their parts only, a bounded set read first.
    """
    entries = written(lexicon.select("surface", "pos", "lemma"), "lexicon")
    resolved = _verb_then_noun(entries)
    parts = sorted({p for pair in K.SPLIT_WORDS for p in pair.split("|")})
    known = {r["token"]: r["lemma"] for r in resolved.where(F.col("token").isin(parts)).collect()}
    fused, gone = T.fused_words(known)
    kept = T.drop_stop_words(F.split(F.coalesce(F.col(text_column), F.lit("")), " "), ["", *K.STOP_WORDS, *gone])
    rows = written(
        df.withColumn("__lexicon_tokens", kept).withColumn("__lexicon_row", F.monotonically_increasing_id()), "lexicon-rows"
    )

    tokens = rows.select("__lexicon_row", F.explode(F.array_distinct("__lexicon_tokens")).alias("token"))
    # fused pairs win over lemmas, as in the literal form
    changes = resolved.where((F.col("token") != F.col("lemma")) & ~F.col("token").isin(sorted(fused))).unionByName(
        df.sparkSession.createDataFrame(sorted(fused.items()), "token string, lemma string")
    )
    used = written(changes.join(tokens.select("token").distinct(), "token", "left_semi"), "lexicon-used")
    pairs = (
        tokens.join(broadcast_if_small(used, pass_entries), "token")
        .groupBy("__lexicon_row")
        .agg(F.collect_list(F.struct("token", "lemma")).alias("__lexicon_pairs"))
    )
    replaced = F.pandas_udf(_replaced, "string")
    packed = F.struct(
        F.col("__lexicon_tokens").alias("tokens"),
        F.col("__lexicon_pairs.token").alias("surfaces"),
        F.col("__lexicon_pairs.lemma").alias("lemmas"),
    )
    return (
        rows.join(pairs, "__lexicon_row", "left")
        .withColumn(out, replaced(packed))
        .drop("__lexicon_row", "__lexicon_tokens", "__lexicon_pairs")
    )

"""The bucketed lexicon form gives the rows of the literal form, whatever the ids."""

from conftest import SMALL
from pyspark.sql import functions as F

from plaintlens.functions import text as T
from plaintlens.functions.text import seed_lexicon
from plaintlens.operators.normalize import normalize_with_lexicon


def derived_lexicon(spark):
    """Entries derived from the words of the documents: plural and -ing forms, some clashing."""
    words = (
        spark.read.parquet(f"{SMALL}/documents.parquet")
        .select(F.explode(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
        .where(F.length("w") > 3)
        .distinct()
    )
    nouns = words.select(F.concat("w", F.lit("s")).alias("surface"), F.lit("n").alias("pos"), F.col("w").alias("lemma"))
    verbs = words.select(F.concat("w", F.lit("ing")).alias("surface"), F.lit("v").alias("pos"), F.col("w").alias("lemma"))
    seed = spark.createDataFrame(seed_lexicon(), "surface string, pos string, lemma string")
    return nouns.unionByName(verbs).unionByName(seed)


def test_same_rows_as_literal_form(spark):
    lexicon = derived_lexicon(spark)
    entries = [tuple(r) for r in lexicon.collect()]
    assert len(entries) > 20_000
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select(
        F.when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("doc_id") % 5).alias("doc_id"),  # null, repeated ids
        F.lower(F.regexp_replace("text", "[^A-Za-z ]", " ")).alias("text"),
        F.lit(1).alias("_tokens"),  # a clashing name stays
    )
    want = docs.withColumn("normalized", T.normalize(F.coalesce("text", F.lit("")), entries))
    for per_pass in (1_000_000, 7_000):  # one pass, then several
        assert "_tokens" in normalize_with_lexicon(docs, "text", lexicon).columns
        got = normalize_with_lexicon(docs, "text", lexicon, pass_entries=per_pass)
        assert sorted(map(tuple, got.select("doc_id", "text", "normalized").collect()), key=repr) == sorted(
            map(tuple, want.select("doc_id", "text", "normalized").collect()), key=repr
        )


def test_registered_query(spark):
    from plaintlens.plans.queries import QUERIES, derived_lexicon

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    entries = [tuple(r) for r in derived_lexicon(docs).collect()]
    letters = F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", " "))
    want = docs.select("doc_id", T.normalize(letters, entries).alias("normalized"))
    got = QUERIES["lexicon_normalize"](spark, SMALL)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_no_row_carries_the_lexicon(spark):
    """A lexicon far larger than the texts: rows meet only the entries of their own words."""
    big = spark.range(60_000).select(
        F.concat(F.lit("w"), "id").alias("surface"), F.lit("n").alias("pos"), F.concat(F.lit("l"), "id").alias("lemma")
    )
    docs = spark.createDataFrame([(1, "w1 w59999 w1 payment"), (1, "cannot w7"), (None, None), (2, "")], "k long, text string")
    found = normalize_with_lexicon(docs, "text", big)
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, found.select("k", "normalized").collect()), key=repr) == sorted(
        [(1, "l1 l59999 l1 payment"), (1, "l7"), (None, ""), (2, "")], key=repr
    )

"""The registered queries: every operator run over the given tables, whole.

The tables stand in for complaint data: ``documents`` are complaints (source = product label,
lang = state), ``labels`` are coverage and scores, ``benchmark`` is a question set,
``embeddings`` a pre-built vector table, ``pages`` text with tags and URLs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens.functions import text as T
from plaintlens.functions.scoring import judge_scores, score_out_of_range
from plaintlens.functions.vector import unit
from plaintlens.operators import (
    chunking,
    complaints,
    evaluation,
    inference,
    knn,
    metadata,
    normalize,
    profile,
    retrieval,
    sampling,
)
from plaintlens.operators.embedding import embed_with, hash_embed, pca_2d
from plaintlens.operators.knn_pruned import knn_pruned as knn_pruned_search
from plaintlens.plans import jobs
from plaintlens.session import scratch_path, spread
from plaintlens.sources import readers, writers

STAND_IN_MAP = {
    "Credit Card": ["src0", "src1"],
    "Personal Loan": ["src2", "src3", "src4", "src5"],
    "Savings Account": ["src6", "src7"],
    "Money Transfer": ["src8", "src9"],
}
SAMPLE_ROWS = 150
INGEST_LIMITS = [0, 25, 10**9]
LOOKED_UP = ["0_0", "2_0", "2_1", "4_0", "none"]
REPORT_ROWS = 20
RUN_STAMPS = ["2024-01-01T00:00:00+00:00", "2024-01-02T00:00:00+00:00"]
# Texts put in front of real documents, so that every opener rule has work at any scale.
OPENERS = [
    "",
    "To whom it may concern, I am writing to file a complaint about ",
    "I'm writing to report a complaint regarding ",
    "I am writing this letter to inform you ",
    "I would like to file a complaint concerning ",
    "This letter is to notify you ",
    "I am filing this complaint against ",
]
# Noise put around real documents, for the rules the plain texts never trigger.
NOISE = [
    "see http://a.example/x?y=1 now",
    "call 555-123-4567 or 5551234567 or 555.1234",
    "account ab1234567890123 XXXX xx/xx/2024",
    "<b>credit/debit</b> exxon $50.00!!",
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], key: Column) -> Column:
    return F.get(
        F.array(*[F.lit(v) for v in values]), F.pmod(key, F.lit(len(values))).cast("int")
    )


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("complaint_id"),
        F.col("source").alias("product"),
        F.col("text").alias("narrative"),
        F.col("lang").alias("state"),
    )


def mapped_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return complaints.with_narrative(
        complaints.map_categories(raw_complaints(spark, sf_dir), STAND_IN_MAP)
    )


def cleaned_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.prepare_complaints(spread(raw_complaints(spark, sf_dir)), STAND_IN_MAP)


def chunk_rows(spark: SparkSession, sf_dir: str, **settings: int) -> DataFrame:
    return chunking.chunk_table(cleaned_complaints(spark, sf_dir), **settings)


def text_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.to_store(chunk_rows(spark, sf_dir))


def written_text_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text store as a real collection, as retrieval would find it."""
    base = scratch_path(spark, "store")
    writers.write_collection(text_store(spark, sf_dir), base, "complaints")
    return readers.open_collection(spark, base, "complaints")


def vector_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        "embedding",
        F.concat(F.lit("label "), F.col("label").cast("string")).alias("product_category"),
    )


def category_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question vector per category: the one of its smallest id."""
    return (
        vector_store(spark, sf_dir)
        .groupBy("product_category")
        .agg(F.min_by("embedding", F.col("id").cast("bigint")).alias("embedding"))
        .select(
            F.col("product_category").alias("question_id"), unit(F.col("embedding")).alias("embedding")
        )
    )


def benchmark_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = sorted(STAND_IN_MAP)
    return _table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("question_id"),
        _pick(categories, F.col("item_id")).alias("category"),
        F.col("text").alias("question"),
    )


def prebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A pre-embedded table with nested metadata; ids and counters disagree on purpose."""
    docs = _table(spark, sf_dir, "documents")
    dimension = F.broadcast(complaints.product_dimension(spark, STAND_IN_MAP))
    labels = _table(spark, sf_dir, "labels")
    vectors = _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    text = lambda c: c.cast("string")
    return (
        docs.join(dimension, docs["source"] == dimension["product"], "left")
        .join(labels, "doc_id", "left")
        .join(vectors, "doc_id", "left")
        .select(
            F.concat_ws(
                "_", text(F.col("doc_id")), F.coalesce(text(F.col("quality")), F.lit("none"))
            ).alias("id"),
            F.col("text").alias("document"),
            "embedding",
            F.struct(
                F.col("toxic").cast("bigint").alias("chunk_index"),
                F.col("source").alias("company"),
                text(F.col("doc_id")).alias("complaint_id"),
                F.lit(None).cast("string").alias("date_received"),
                F.col("lang").alias("issue"),
                F.col("source").alias("product"),
                F.col("product_category"),
                F.col("lang").alias("state"),
                F.when(F.col("quality") == 1, F.lit("good")).alias("sub_issue"),
                F.col("quality").cast("bigint").alias("total_chunks"),
            ).alias("metadata"),
        )
    )


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation rows out of documents and labels; unlabelled documents are unscored."""
    docs = _table(spark, sf_dir, "documents")
    scored = F.col("quality").isNotNull()
    return docs.join(_table(spark, sf_dir, "labels"), "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("source").alias("category"),
        F.concat(F.lit("What about "), F.col("source"), F.lit("?")).alias("question"),
        F.when(scored, F.col("text")).alias("answer"),
        F.when(
            scored,
            F.array(
                F.struct(
                    F.col("doc_id").cast("string").alias("complaint_id"),
                    F.col("source").alias("product_category"),
                    F.lit("").alias("company"),
                    F.col("lang").alias("issue"),
                    F.round(F.lit(1.0) / (F.col("n_chars") + 1), 4).alias("similarity_score"),
                    F.substring("text", 1, 200).alias("excerpt"),
                )
            ),
        )
        .otherwise(F.array())
        .alias("retrieved_sources"),
        (F.col("toxic") == 1).alias("generation_error"),
        (F.lit(5) - F.col("toxic") * 3).cast("int").alias("retrieval_relevance"),
        (F.lit(1) + F.col("quality") * 4).cast("int").alias("faithfulness"),
        F.when(F.col("quality") == 1, F.col("lang")).otherwise(F.lit("")).alias("comment"),
        F.when(~scored, F.lit("not judged")).alias("judge_error"),
    )


def judge_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in the shapes judges produce, scores taken from the labels."""
    quality, toxic = F.col("quality").cast("string"), F.col("toxic").cast("string")
    clean = F.concat(
        F.lit('{"retrieval_relevance": '), quality, F.lit(', "faithfulness": '), toxic,
        F.lit(', "comment": "fine"}'),
    )
    shapes = [
        clean,
        F.concat(F.lit("Sure, here it is:\n"), clean, F.lit("\nAnything else?")),
        F.concat(F.lit("I would give it a "), quality),
        F.concat(F.lit('{"retrieval_relevance": "'), quality, F.lit('", "faithfulness": 4.7}')),
        F.concat(F.lit('{"retrieval_relevance": "4.7", "faithfulness": '), toxic, F.lit("}")),
        F.concat(F.lit('{"retrieval_relevance": '), quality, F.lit("}")),
        F.concat(F.lit('{"faithfulness": '), quality, F.lit(", oops}")),
    ]
    key = F.pmod("doc_id", F.lit(len(shapes)))
    reply = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        reply = F.when(key == i, shape).otherwise(reply)
    return _table(spark, sf_dir, "labels").select("doc_id", reply.alias("reply"))


def answering_client():
    """A stand-in model whose reply proves which prompt it saw."""
    return lambda prompt, _: f"answer {hashlib.md5(prompt.encode()).hexdigest()}"


def judging_client():
    def judge(prompt: str, _: int) -> str:
        mark = int(hashlib.md5(prompt.encode()).hexdigest()[:4], 16)
        return (
            f'Scores: {{"retrieval_relevance": {mark % 5 + 1}, '
            f'"faithfulness": {mark // 5 % 5 + 1}, "comment": "seen"}}'
        )

    return judge


def length_encoder():
    """A stand-in embedding model: three simple numbers per text."""
    return lambda texts: [[len(t), t.count(" ") + 1, 1.0] for t in texts]


# --- the queries -------------------------------------------------------------------------


def product_counts(spark, d):
    return profile.value_counts(raw_complaints(spark, d), "product")


def category_filter_map(spark, d):
    return mapped_complaints(spark, d).select("complaint_id", "product", "product_category")


def narrative_presence(spark, d):
    return profile.presence(_labelled(spark, d), F.col("quality").isNotNull())


def coverage_by_product(spark, d):
    return profile.coverage_by(_labelled(spark, d), "source", F.col("quality").isNotNull())


def _labelled(spark, d):
    return _table(spark, d, "documents").select("doc_id", "source").join(
        _table(spark, d, "labels"), "doc_id", "left"
    )


def distinct_products(spark, d):
    return profile.distinct_values(raw_complaints(spark, d), "product")


def _word_counts(spark, d):
    return spread(raw_complaints(spark, d)).select(
        T.word_count(F.col("narrative")).alias("words")
    )


def word_count_describe(spark, d):
    r = profile.describe_numbers(_word_counts(spark, d), "words")
    return r.withColumn("mean", F.round("mean", 6)).withColumn("std", F.round("std", 6))


def word_count_histogram(spark, d):
    r = profile.histogram(_word_counts(spark, d), "words", 80, clip_at=0.99)
    return r.withColumn("bin_start", F.round("bin_start", 6))


def length_outliers(spark, d):
    return profile.count_outliers(_word_counts(spark, d), "words")


def _with_openers(spark, d):
    return spread(_table(spark, d, "documents")).select(
        "doc_id", F.concat(_pick(OPENERS, F.col("doc_id")), F.col("text")).alias("text")
    )


def strip_openers(spark, d):
    return _with_openers(spark, d).select(
        "doc_id", T.strip_openers(F.lower("text")).alias("stripped")
    )


def opener_counts(spark, d):
    return _with_openers(spark, d).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(T.has_opener(F.col("text"))).alias("n_openers"),
    )


def clean_noise(spark, d):
    noisy = F.concat_ws(" ", "text", _pick(NOISE, F.col("doc_id")))
    return spread(_table(spark, d, "documents")).select(
        "doc_id", T.clean_noise(noisy).alias("cleaned")
    )


def clean_noise_pages(spark, d):
    return spread(_table(spark, d, "pages")).select(
        "page_id", T.clean_noise(F.concat_ws(" ", "url", "html")).alias("cleaned")
    )


def normalize_tokens(spark, d):
    return cleaned_complaints(spark, d).select("complaint_id", "cleaned_narrative")


def _sample(spark, d):
    return sampling.stratified_sample(mapped_complaints(spark, d), SAMPLE_ROWS)


def stratified_sample(spark, d):
    return _sample(spark, d).select("complaint_id", "product_category")


def sample_summary(spark, d):
    return sampling.sample_summary(_sample(spark, d))


def share_compare(spark, d):
    full = mapped_complaints(spark, d)
    return profile.align_shares(
        full, _sample(spark, d), "product_category", "full_pct", "sample_pct"
    )


def chunks(spark, d):
    return chunk_rows(spark, d).withColumn("id", chunking.chunk_id())


def chunk_sweep(spark, d):
    return chunking.chunk_sweep(cleaned_complaints(spark, d))


def chunk_length_histogram(spark, d):
    lengths = chunk_rows(spark, d).select(F.length("chunk_text").alias("n"))
    return profile.histogram(lengths, "n", 40).withColumn("bin_start", F.round("bin_start", 6))


def first_multichunk(spark, d):
    path = scratch_path(spark, "chunks")
    chunk_rows(spark, d).write.parquet(path)
    return chunking.first_multichunk(
        spark.read.parquet(path), F.col("complaint_id").cast("bigint")
    )


def category_cap(spark, d):
    rows = chunk_rows(spark, d).withColumn("id", chunking.chunk_id())
    return sampling.cap_per_category(rows).select("id", "product_category")


def hash_embedding(spark, d):
    """Non-zero entries of every chunk's vector, as text."""
    entries = F.filter(
        F.transform("embedding", lambda x, i: F.struct(i.alias("i"), x.alias("x"))),
        lambda e: e["x"] > 0,
    )
    shown = F.transform(
        entries,
        lambda e: F.concat_ws(":", e["i"], F.round(e["x"] * F.lit(1000), 0).cast("int")),
    )
    return hash_embed(chunk_rows(spark, d)).select(
        chunking.chunk_id().alias("id"), F.array_join(shown, " ").alias("vector")
    )


def model_embedding(spark, d):
    texts = _table(spark, d, "documents").select("doc_id", F.col("text").alias("chunk_text"))
    return embed_with(texts, length_encoder).select(
        "doc_id",
        *[
            F.round(F.get("embedding", F.lit(i)).cast("double"), 4).alias(f"v{i}")
            for i in range(3)
        ],
    )


def flatten_metadata(spark, d):
    return metadata.flatten_metadata(prebuilt(spark, d)).drop("document", "embedding")


def ingest_categories(spark, d):
    return metadata.category_counts(metadata.flatten_metadata(prebuilt(spark, d)))


def hidden_counters(spark, d):
    return metadata.hidden_counters(prebuilt(spark, d))


def sparse_rich_union(spark, d):
    minimal = chunk_rows(spark, d).withColumn("id", F.concat(F.lit("c"), chunking.chunk_id()))
    rich = metadata.flatten_metadata(prebuilt(spark, d)).drop("document", "embedding")
    return retrieval.union_stores(minimal.drop("chunk_text"), rich).select(
        "id", "complaint_id", "product_category", "chunk_index", "total_chunks", "company",
        "issue", "sub_issue", "date_received",
    )


def _content_ids(spark, d):
    return prebuilt(spark, d).withColumn("id", F.md5("document"))


def ingest_reconcile(spark, d):
    """Ingest under content ids, so that exact copies show up as duplicate ids."""
    base = scratch_path(spark, "ingest")
    source = _content_ids(spark, d)
    jobs.ingest_embeddings(spark, source, base, layout="narrow")
    return metadata.reconcile(source, readers.open_collection(spark, base, "complaints_full"))


def duplicate_ids(spark, d):
    return metadata.duplicate_ids(_content_ids(spark, d))


def store_roundtrip(spark, d):
    base = scratch_path(spark, "store")
    writers.write_collection(vector_store(spark, d), base, "vectors")
    return readers.open_collection(spark, base, "vectors").select(
        "id",
        "product_category",
        F.size("embedding").alias("dim"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 4).alias("first_value"),
    )


def metadata_keys(spark, d):
    return metadata.metadata_keys(prebuilt(spark, d).select("metadata"))


def metadata_keys_json(spark, d):
    return metadata.metadata_keys(_table(spark, d, "events").select("props"), "props")


def id_pattern_check(spark, d):
    return metadata.id_pattern_check(prebuilt(spark, d))


def id_mismatches(spark, d):
    return metadata.id_mismatches(prebuilt(spark, d))


def chunks_per_complaint(spark, d):
    rows = chunk_rows(spark, d).select(chunking.chunk_id().alias("id"))
    return metadata.chunks_per_complaint(rows)


def rank_percentiles(spark, d):
    return metadata.document_lengths(
        chunk_rows(spark, d).select(F.col("chunk_text").alias("document"))
    )


def top_values(spark, d):
    flat = metadata.flatten_metadata(prebuilt(spark, d))
    return profile.top_values(flat, K.CATEGORY_CANDIDATE_KEYS)


def dim_check(spark, d):
    return metadata.dimension_check(_table(spark, d, "embeddings"), expected=64)


def sample_rows(spark, d):
    rows = _table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("document"),
        F.array(F.col("n_chars")).alias("embedding"),
    )
    shown = metadata.sample_rows(rows.orderBy(F.col("id").cast("bigint")), 5)
    return shown.select(
        "id", "document", "dim", F.array_join(F.col("first_values"), ",").alias("first_values")
    )


def knn_topk(spark, d):
    found = knn.nearest(category_questions(spark, d), vector_store(spark, d), 5)
    return _shown(found)


def knn_filtered(spark, d):
    questions = category_questions(spark, d).withColumn("filter_category", F.col("question_id"))
    return _shown(knn.nearest(questions, vector_store(spark, d), 5))


def knn_pruned(spark, d):
    """Every vector whose id is a multiple of 20 asks for its 5 nearest, clusters pruned."""
    store = vector_store(spark, d)
    questions = store.where(F.col("id").cast("bigint") % 20 == 0).select(
        F.col("id").alias("question_id"), "embedding"
    )
    return _shown(knn_pruned_search(questions, store, 5))


def _shown(found):
    return found.select("question_id", "rank", "id", F.round("distance", 6).alias("distance"))


def text_retrieval(spark, d):
    """The question set against the chunk store, three hits each."""
    hits = retrieval.retrieve(
        benchmark_questions(spark, d).drop("category"), written_text_store(spark, d), 3
    )
    return hits.select(
        "question_id", "rank", "id", "complaint_id", "product_category", "similarity_score",
        "company",
    )


def retrieval_quality(spark, d):
    questions = category_questions(spark, d).withColumn("category", F.col("question_id"))
    found = knn.nearest(questions, vector_store(spark, d), 5)
    hits = found.join(vector_store(spark, d).drop("embedding"), "id").withColumn(
        "similarity_score", F.round(F.lit(1.0) - F.col("distance"), 4)
    )
    return retrieval.retrieval_quality(hits, questions)


def question_validation(spark, d):
    """Every document as a question, every source as a category filter."""
    dimension = F.broadcast(complaints.product_dimension(spark, STAND_IN_MAP))
    asked = (
        _table(spark, d, "documents")
        .join(dimension, F.col("source") == F.col("product"), "left")
        .select(
            F.col("doc_id").alias("question_id"),
            F.when(F.col("lang") != "de", F.col("text")).alias("question"),
            F.coalesce("product_category", "source").alias("filter_category"),
        )
    )
    return retrieval.check_questions(asked).select(
        "question_id", F.coalesce("reject_reason", F.lit("ok")).alias("reject_reason")
    )


def question_coverage(spark, d):
    questions = benchmark_questions(spark, d).withColumnRenamed("question_id", "id")
    return retrieval.question_set_coverage(questions)


def context_prompt(spark, d):
    """A prompt per question from its three nearest stored chunks."""
    hits = retrieval.retrieve(
        benchmark_questions(spark, d).drop("category"), written_text_store(spark, d), 3
    )
    asked = inference.with_sources(benchmark_questions(spark, d), hits)
    return inference.with_prompts(asked).select(
        "question_id",
        F.md5("context_block").alias("context_md5"),
        F.length("prompt").alias("prompt_chars"),
        F.md5("prompt").alias("prompt_md5"),
        T.excerpt(F.col("context_block"), 60).alias("context_start"),
    )


def judge_parse(spark, d):
    s = judge_replies(spark, d).withColumn("s", judge_scores(F.col("reply")))
    return s.select(
        "doc_id",
        F.coalesce(F.col("s.retrieval_relevance"), F.lit(-1)).alias("retrieval_relevance"),
        F.coalesce(F.col("s.faithfulness"), F.lit(-1)).alias("faithfulness"),
        F.col("s.comment").alias("comment"),
        F.coalesce(F.col("s.judge_error"), F.lit("")).alias("judge_error"),
        score_out_of_range(F.col("s.retrieval_relevance")).alias("out_of_range"),
    )


def eval_summary(spark, d):
    return evaluation.summarize(scored_rows(spark, d))


def resume_rows(spark, d):
    """Questions = all documents; earlier run = the labelled ones."""
    earlier = scored_rows(spark, d)
    questions = earlier.select("id", "category", "question")
    remaining, reused = evaluation.split_resume(questions, earlier)
    return remaining.select("id", F.lit("to run").alias("state")).unionByName(
        reused.select("id", F.lit("reused").alias("state"))
    )


def report_rows(spark, d):
    return evaluation.report_rows(scored_rows(spark, d))


def batch_answers(spark, d):
    """A full evaluation run over the question set with stand-in models."""
    questions = benchmark_questions(spark, d).withColumnRenamed("question_id", "id")
    rows, _ = jobs.evaluate_run(
        spark, questions, written_text_store(spark, d), answering_client, judging_client, top_k=3
    )
    return rows.select(
        "id",
        "category",
        "answer",
        F.array_join(F.transform("retrieved_sources", lambda s: s["complaint_id"]), ",").alias(
            "sources"
        ),
        "generation_error",
        "retrieval_relevance",
        "faithfulness",
        "comment",
    )


def build_manifest(spark, d):
    base = scratch_path(spark, "sample")
    cleaned_complaints(spark, d).write.parquet(f"{base}/cleaned")
    manifest = jobs.build_sample_store(
        spark, spark.read.parquet(f"{base}/cleaned"), base, sample_size=SAMPLE_ROWS
    )
    counts = spark.read.parquet(f"{base}/complaints_sample_category_counts")
    ids = spark.read.parquet(f"{base}/complaints_sample_sampled_ids")
    return manifest.select(
        "sample_size_requested",
        "sample_size_actual",
        "num_chunks",
        "chunk_size",
        "chunk_overlap",
        _counts_text(counts).alias("category_counts"),
        # every id leaves its mark, in any number and without one list of all
        ids.agg(F.sum(F.conv(F.substring(F.md5("complaint_id"), 1, 8), 16, 10).cast("bigint")))
        .scalar()
        .alias("ids_sum"),
    )


def _counts_text(counts):
    named = F.concat("product_category", F.lit("="), F.col("count").cast("string"))
    return counts.agg(F.array_join(F.sort_array(F.collect_list(named)), ",")).scalar()


def _manifest_row(manifest, counts):
    return manifest.select(
        "rows_in_source_file",
        "rows_ingested",
        "final_collection_count",
        "has_duplicate_ids",
        _counts_text(counts).alias("category_counts"),
    )


def ingest_manifest(spark, d):
    """The manifest of a full ingest, with the categories of its table of counts."""
    base = scratch_path(spark, "ingest")
    manifest = jobs.ingest_embeddings(spark, prebuilt(spark, d), base)
    return _manifest_row(manifest, spark.read.parquet(f"{base}/complaints_full_category_counts"))


def ingest_limited(spark, d):
    """Ingests of no row, of some, and of more rows than there are."""
    source = prebuilt(spark, d)
    out = []
    for limit in INGEST_LIMITS:
        base = scratch_path(spark, "ingest")
        manifest = jobs.ingest_embeddings(spark, source, base, limit_rows=limit)
        out.append(manifest.select("limit_rows", "rows_in_source_file", "rows_ingested"))
    return reduce(DataFrame.unionByName, out)


def _awkward_store(spark, d):
    """A stored collection whose categories look like numbers or dates, are empty or missing."""
    base = scratch_path(spark, "store")
    label = F.pmod("label", F.lit(4))
    rows = _table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("id"),
        "embedding",
        F.when(label == 0, "001").when(label == 1, "2024-01-01").when(label == 2, "").alias(
            "product_category"
        ),
    )
    writers.write_collection(rows, base, "vectors")
    return readers.open_collection(spark, base, "vectors")


def stored_categories(spark, d):
    return _awkward_store(spark, d).groupBy("product_category").agg(F.count(F.lit(1)).alias("n"))


def stored_filtered_search(spark, d):
    """Filtered questions against that collection."""
    asked = category_questions(spark, d)
    wanted = F.explode(F.array(F.lit("001"), F.lit("2024-01-01")))
    questions = asked.withColumn("filter_category", wanted).withColumn(
        "question_id", F.concat_ws("/", "question_id", "filter_category")
    )
    return _shown(knn.nearest(questions, _awkward_store(spark, d), 3))


def knn_many(spark, d):
    """Every stored vector as a question, in several blocks."""
    store = vector_store(spark, d)
    questions = store.select(F.col("id").alias("question_id"), unit(F.col("embedding")).alias("embedding"))
    return _shown(knn.nearest(questions, store, 3, max_question_bytes=100_000))


def failed_questions(spark, d):
    """Questions whose vectors are too short for the store."""
    store = vector_store(spark, d)
    size = F.when(F.pmod(F.col("id").cast("bigint"), F.lit(3)) == 0, 5).otherwise(64)
    questions = store.select(
        F.col("id").alias("question_id"), F.slice("embedding", F.lit(1), size).alias("embedding")
    )
    return knn.incomparable(questions, store)


def id_lookup(spark, d):
    """Rows of a stored collection by id, beside the collection's size."""
    store = written_text_store(spark, d)
    size = readers.collection_size(store).scalar()
    found = readers.lookup_ids(store, LOOKED_UP)
    return found.select("id", "complaint_id", F.md5("document").alias("document_md5"), size.alias("n_chunks"))


def folder_scan(spark, d):
    """Embeddings kept as files in nested folders, read by column."""
    base = scratch_path(spark, "folder")
    parts = _table(spark, d, "embeddings").withColumn("part", F.pmod("vec_id", F.lit(3)))
    parts.write.partitionBy("part").parquet(base)
    return readers.read_embeddings(spark, base, ["vec_id", "label"])


def raw_csv_scan(spark, d):
    """Raw exports with different header orders, one of them with dates that are none."""
    base = scratch_path(spark, "csv")
    date = F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("doc_id", F.lit(365)).cast("int"))
    rows = _table(spark, d, "documents").select(
        F.when(F.pmod("doc_id", F.lit(7)) == 0, "soon").otherwise(date.cast("string")).alias("Date received"),
        F.col("source").alias("Product"),
        F.lit("a, b").alias("Sub-product"),
        F.concat(F.lit('say "'), "lang", F.lit('"')).alias("Issue"),
        F.lit("N/A").alias("Sub-issue"),
        F.col("text").alias("Consumer complaint narrative"),
        F.concat(F.lit("company "), "source").alias("Company"),
        F.col("lang").alias("State"),
        F.col("doc_id").alias("Complaint ID"),
    )
    for i, names in enumerate((rows.columns, rows.columns[::-1])):
        (
            rows.filter(F.pmod("doc_id", F.lit(2)) == i)
            .select(*(f"`{n}`" for n in names))
            .write.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .mode("append")
            .csv(base)
        )
    unreadable = readers.unreadable_dates(spark, base).scalar()
    return readers.read_raw_complaints(spark, base).select(
        "complaint_id",
        F.coalesce(F.date_format("date_received", "yyyy-MM-dd"), F.lit("(none)")).alias("date_received"),
        "product",
        "company",
        "state",
        "issue",
        F.coalesce("sub_issue", F.lit("(none)")).alias("sub_issue"),
        F.md5("narrative").alias("narrative_md5"),
        unreadable.alias("unreadable_dates"),
    )


def report_capped(spark, d):
    return evaluation.report_rows(scored_rows(spark, d), REPORT_ROWS)


def unanswered_rate(spark, d):
    """Every third document as an answer that admits it does not know."""
    admits = F.pmod("doc_id", F.lit(3)) == 0
    answers = _table(spark, d, "documents").select(
        F.when(admits, F.concat(F.lit("Sorry. "), F.lit(K.NOT_ENOUGH_INFORMATION))).otherwise(
            F.col("text")
        ).alias("answer")
    )
    return retrieval.unanswered_rate(answers)


def filtered_retrieval(spark, d):
    """The question set, each question within its own category."""
    asked = benchmark_questions(spark, d).withColumnRenamed("category", "filter_category")
    hits = retrieval.retrieve(asked, written_text_store(spark, d), 2)
    return hits.select("question_id", "rank", "id", "product_category", "similarity_score")


def history_append(spark, d):
    """Two runs saved, then the history and the newest run read back."""
    base = scratch_path(spark, "results")
    rows = scored_rows(spark, d)
    summary = evaluation.summarize(rows)
    for stamp in RUN_STAMPS:
        writers.save_run(rows, summary, base, stamp)
    newest = readers.latest_run(spark, base).agg(F.count(F.lit(1))).scalar()
    return readers.read_history(spark, base).withColumn("rows_in_newest_run", newest)


def csv_roundtrip(spark, d):
    """Complaints through a CSV file with the original headers and back."""
    path = scratch_path(spark, "csv")
    text = F.col("narrative")
    cleaned = mapped_complaints(spark, d).select(
        "complaint_id",
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("complaint_id", F.lit(365)).cast("int"))
        .alias("date_received"),
        "product_category",
        "product",
        F.lit(None).cast("string").alias("sub_product"),
        F.concat(F.lit('say "'), F.substring(text, 1, 5), F.lit('", ok')).alias("issue"),
        F.lit(None).cast("string").alias("sub_issue"),
        F.lit(None).cast("string").alias("company"),
        "state",
        "narrative",
        T.strip(text).alias("cleaned_narrative"),
    )
    writers.write_cleaned_complaints(cleaned, path, "csv")
    back = readers.read_cleaned_complaints(spark, path, "csv")
    return back.select(
        "complaint_id",
        F.date_format("date_received", "yyyy-MM-dd").alias("date_received"),
        "product_category",
        "issue",
        F.coalesce("sub_issue", F.lit("(none)")).alias("sub_issue"),
        F.md5("narrative").alias("narrative_md5"),
    )


def dataset_profile(spark, d):
    return readers.dataset_profile(_table(spark, d, "documents")).select(
        "n_files", "n_rows", "n_columns", "columns"
    )


def question_source(spark, d):
    """The question set through JSON arrays and back."""
    path = scratch_path(spark, "questions")
    questions = benchmark_questions(spark, d).withColumnRenamed("question_id", "id")
    writers.write_questions(questions, path, per_file=100)
    return readers.read_questions(spark, path)


def pca_projection(spark, d):
    rows, _ = pca_2d(_table(spark, d, "embeddings"))
    return rows.select("vec_id", F.round("pc1", 6).alias("pc1"), F.round("pc2", 6).alias("pc2"))


def chunk_stats(spark, d):
    """Flagship: filter, map, clean, chunk and profile per category."""
    return (
        chunk_rows(spark, d)
        .groupBy("product_category")
        .agg(
            F.countDistinct("complaint_id").alias("n_complaints"),
            F.count(F.lit(1)).alias("n_chunks"),
            F.round(F.avg(F.length("chunk_text")), 2).alias("avg_chars"),
            F.max("total_chunks").alias("max_chunks"),
        )
        .orderBy("product_category")
    )


def derived_lexicon(docs: DataFrame) -> DataFrame:
    """A lexicon of every surface the documents make by two rules, plus the seed: each word of
    four or more letters gives (word + "s", n, word) and (word + "ing", v, word)."""
    spark = docs.sparkSession
    words = (
        docs.select(F.explode(F.split(F.lower(F.coalesce("text", F.lit(""))), "[^a-z]+")).alias("w"))
        .where(F.length("w") > 3)
        .distinct()
    )
    seed = spark.createDataFrame(T.seed_lexicon(), "surface string, pos string, lemma string")
    return (
        words.select(F.concat("w", F.lit("s")).alias("surface"), F.lit("n").alias("pos"), F.col("w").alias("lemma"))
        .unionByName(words.select(F.concat("w", F.lit("ing")).alias("surface"), F.lit("v").alias("pos"), F.col("w").alias("lemma")))
        .unionByName(seed)
    )


def lexicon_normalize(spark, d):
    """Every document normalised with a lexicon table derived from all documents."""
    docs = _table(spark, d, "documents")
    letters = docs.select("doc_id", F.lower(F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z ]", " ")).alias("text"))
    return normalize.normalize_with_lexicon(letters, "text", derived_lexicon(docs)).select("doc_id", "normalized")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in [
        product_counts, category_filter_map, narrative_presence, coverage_by_product,
        distinct_products, word_count_describe, word_count_histogram, length_outliers,
        strip_openers, opener_counts, clean_noise, clean_noise_pages, normalize_tokens,
        stratified_sample, sample_summary, share_compare, chunks, chunk_stats, chunk_sweep,
        chunk_length_histogram, first_multichunk, category_cap, hash_embedding, model_embedding,
        flatten_metadata, ingest_categories, hidden_counters, sparse_rich_union,
        ingest_reconcile, duplicate_ids, store_roundtrip, metadata_keys, metadata_keys_json,
        id_pattern_check, id_mismatches, chunks_per_complaint, rank_percentiles, top_values,
        dim_check, sample_rows, knn_topk, knn_filtered, text_retrieval, retrieval_quality,
        question_validation, question_coverage, context_prompt, judge_parse, eval_summary,
        resume_rows, report_rows, batch_answers, build_manifest, history_append, csv_roundtrip,
        dataset_profile, question_source, pca_projection, ingest_manifest, ingest_limited,
        stored_categories, stored_filtered_search, knn_many, failed_questions, id_lookup,
        folder_scan, raw_csv_scan, report_capped, unanswered_rate, filtered_retrieval,
        lexicon_normalize, knn_pruned,
    ]
}

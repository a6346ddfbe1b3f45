"""Question validation, batch retrieval and hit assembly."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens import schemas as S
from plaintlens.functions.text import strip
from plaintlens.functions.vector import cosine_from_distance, similarity_score
from plaintlens.operators import knn
from plaintlens.operators.embedding import hash_embed
from plaintlens.session import broadcast_if_small, cut_lineage

# Attaching metadata broadcasts the hits; past this many hits the join is left to AQE.
MAX_BROADCAST_HITS = 200_000
# Up to this many distinct hit ids are also handed to the store scan as a filter.
MAX_PUSHED_IDS = 1_000


def reject_reason(question: Column, filter_category: Column) -> Column:
    """Why a question cannot be searched, or null. An empty category means no filter."""
    text = strip(question)
    allowed = "[" + ", ".join(f"'{c}'" for c in sorted(K.VALID_CATEGORIES)) + "]"
    return (
        F.when(question.isNull(), F.lit("Question must be text."))
        .when(text == "", F.lit("Question cannot be empty. Please type a question."))
        .when(
            F.length(text) > K.MAX_QUESTION_CHARS,
            F.concat(
                F.lit("Question is too long ("),
                F.length(text).cast("string"),
                F.lit(
                    f" characters). Please limit questions to {K.MAX_QUESTION_CHARS} characters."
                ),
            ),
        )
        .when(
            (F.coalesce(filter_category, F.lit("")) != "")
            & ~filter_category.isin(K.VALID_CATEGORIES),
            F.concat(
                F.lit("Invalid product_category '"),
                filter_category,
                F.lit(f"'. Must be one of: {allowed}"),
            ),
        )
    )


def check_questions(questions: DataFrame, strict: bool = False) -> DataFrame:
    """Strip each question and add ``reject_reason``; ``strict`` fails the job instead."""
    if "filter_category" not in questions.columns:
        questions = questions.withColumn("filter_category", F.lit(None).cast("string"))
    reason = reject_reason(F.col("question"), F.col("filter_category"))
    if strict:
        reason = F.when(reason.isNotNull(), F.raise_error(reason).cast("string"))
    return questions.withColumn("reject_reason", reason).withColumn(
        "question", strip(F.col("question"))
    )


def question_set_coverage(questions: DataFrame) -> DataFrame:
    """Questions, distinct ids and blank texts per category."""
    return questions.groupBy("category").agg(
        F.count(F.lit(1)).alias("n_questions"),
        F.countDistinct("id").alias("n_ids"),
        F.count_if(strip(F.col("question")) == "").alias("n_blank"),
    )


def fill_hit_fields(df: DataFrame) -> DataFrame:
    """Give minimal-store rows the rich store's fields: ""/0/1 where a value is missing."""
    for name, default in S.HIT_DEFAULTS.items():
        value = F.col(name) if name in df.columns else F.lit(None)
        kind = "string" if isinstance(default, str) else "int"
        df = df.withColumn(name, F.coalesce(value.cast(kind), F.lit(default)))
    return df


def union_stores(minimal: DataFrame, rich: DataFrame) -> DataFrame:
    """Rows of a minimal and a rich store under one layout."""
    return fill_hit_fields(rich.unionByName(minimal, allowMissingColumns=True))


def retrieve(
    questions: DataFrame,
    store: DataFrame,
    k: int = K.TOP_K,
    embed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Hits of every valid question, ranked; a question without hits simply has no rows.

    ``questions`` has question_id, question and optionally filter_category. Rejected questions
    (see :func:`check_questions`) are not embedded. The search reads id, vector and category
    only; text and metadata are fetched afterwards for the few surviving ids.
    """
    valid = check_questions(questions).filter(F.col("reject_reason").isNull())
    if embed is None:
        embedded = hash_embed(valid, "question")
    else:
        embedded = embed(valid)
    found = cut_lineage(knn.nearest(embedded, store, k))
    return attach_metadata(found, store)


def attach_metadata(found: DataFrame, store: DataFrame) -> DataFrame:
    """Join ranked ids (written or otherwise cheap to read twice) to their text and metadata.

    Hits are few next to the store. Their counted number decides: a handful of ids is pushed
    into the store's scan, up to a bound they are broadcast, beyond it AQE picks the join.
    """
    ids = [r["id"] for r in found.select("id").distinct().limit(MAX_PUSHED_IDS + 1).collect()]
    if len(ids) <= MAX_PUSHED_IDS:
        store = store.filter(F.col("id").isin(ids))
    side = broadcast_if_small(found, MAX_BROADCAST_HITS)
    joined = store.drop("embedding").join(side, "id")
    return fill_hit_fields(joined).select(
        "question_id",
        "rank",
        "id",
        F.col("document").alias("chunk_text"),
        "complaint_id",
        "product_category",
        "chunk_index",
        "total_chunks",
        "distance",
        similarity_score(F.col("distance")).alias("similarity_score"),
        cosine_from_distance(F.col("distance")).alias("cosine"),
        "company",
        "issue",
        "sub_issue",
        "date_received",
    )


def retrieval_quality(hits: DataFrame, questions: DataFrame) -> DataFrame:
    """Share of hits outside the question's category, and hits of low similarity.

    ``questions`` has question_id and category.
    """
    pairs = hits.join(
        questions.select("question_id", F.col("category").alias("asked")), "question_id"
    )
    return pairs.agg(
        F.count(F.lit(1)).alias("n_hits"),
        F.round(F.avg((F.col("product_category") != F.col("asked")).cast("int")), 4).alias(
            "leakage_rate"
        ),
        F.count_if(F.col("similarity_score") < K.LOW_SIMILARITY).alias("n_low_similarity"),
    )


def unanswered_rate(answers: DataFrame) -> DataFrame:
    """How often the model admitted that the context is not enough."""
    admitted = F.col("answer").contains(K.NOT_ENOUGH_INFORMATION)
    return answers.agg(
        F.count(F.lit(1)).alias("n_answers"),
        F.round(F.avg(F.coalesce(admitted, F.lit(False)).cast("int")), 4).alias(
            "not_enough_rate"
        ),
    )

"""Evaluation rows, resume, summary and report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens import schemas as S
from plaintlens.functions.scoring import score_out_of_range
from plaintlens.functions.text import excerpt


def kept_sources(sources: Column, n: int = 2) -> Column:
    """The first ``n`` sources with the fields a result row keeps."""
    return F.transform(
        F.slice(sources, 1, n),
        lambda s: F.struct(
            s["complaint_id"].alias("complaint_id"),
            s["product_category"].alias("product_category"),
            s["company"].alias("company"),
            s["issue"].alias("issue"),
            s["similarity_score"].alias("similarity_score"),
            excerpt(s["chunk_text"], 200).alias("excerpt"),
        ),
    )


def evaluation_rows(judged: DataFrame) -> DataFrame:
    return judged.select(
        F.col("question_id").alias("id"),
        "category",
        "question",
        "answer",
        kept_sources(F.col("sources")).alias("retrieved_sources"),
        "generation_error",
        "retrieval_relevance",
        "faithfulness",
        "comment",
        "judge_error",
    )


def failed_rows(rejected: DataFrame) -> DataFrame:
    """Rows of questions that could not be searched (question_id, category, question,
    reject_reason); they count as unscored and are retried on resume."""
    return rejected.select(
        F.col("question_id").alias("id"),
        "category",
        "question",
        F.lit(None).cast("string").alias("answer"),
        F.array().cast(S.SOURCES).alias("retrieved_sources"),
        F.lit(False).alias("generation_error"),
        F.lit(None).cast("int").alias("retrieval_relevance"),
        F.lit(None).cast("int").alias("faithfulness"),
        F.concat(F.lit("Retrieval failed: "), F.col("reject_reason")).alias("comment"),
        F.col("reject_reason").alias("judge_error"),
    )


def is_complete() -> Column:
    """Generated and judged without error. An unknown generation state is not complete."""
    return F.coalesce(~F.col("generation_error"), F.lit(False)) & F.col("judge_error").isNull()


def split_resume(
    questions: DataFrame, previous: DataFrame, key: str = "id"
) -> tuple[DataFrame, DataFrame]:
    """(questions still to run, finished earlier rows of questions in the set).

    The anti join sits ahead of retrieval, so finished questions cost nothing.
    """
    done = previous.filter(is_complete())
    remaining = questions.join(done.select(F.col("id").alias(key)), key, "left_anti")
    reused = done.join(questions.select(F.col(key).alias("id")), "id", "left_semi")
    return remaining, reused


def summarize(rows: DataFrame) -> DataFrame:
    """One row of run metrics over the scored answers; nulls and False when none is scored.

    The target is compared with the unrounded share.
    """
    scored = F.col("faithfulness").isNotNull()
    faithful = F.when(scored, (F.col("faithfulness") >= K.FAITHFUL_SCORE).cast("int"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(scored).alias("n_scored"),
        F.round(F.avg(F.when(scored, F.col("retrieval_relevance"))), 2).alias(
            "avg_retrieval_relevance"
        ),
        F.round(F.avg("faithfulness"), 2).alias("avg_faithfulness"),
        F.round(F.avg(faithful), 3).alias("pct_faithful_ge_4"),
        F.coalesce(F.avg(faithful) >= K.FAITHFULNESS_TARGET, F.lit(False)).alias(
            "meets_faithfulness_target"
        ),
    )


def range_check(rows: DataFrame) -> DataFrame:
    """Scored rows with a score outside 1-5."""
    return rows.filter(
        score_out_of_range(F.col("retrieval_relevance")) | score_out_of_range(F.col("faithfulness"))
    )


def report_rows(rows: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Question, shortened answer, sources, score text and comment.

    ``max_rows`` takes the first rows by id; without it rows come in no order.
    """
    source = F.transform(
        "retrieved_sources",
        lambda s: F.format_string(
            "%s #%s (%.2f)", s["product_category"], s["complaint_id"], s["similarity_score"]
        ),
    )
    sources = F.array_join(source, "; ")
    answer = F.substring(F.replace(F.coalesce("answer", F.lit("")), F.lit("\n"), F.lit(" ")), 1, 150)
    score = F.format_string("R:%s/F:%s", F.col("retrieval_relevance"), F.col("faithfulness"))
    shown = rows.select(
        "id",
        "question",
        F.concat(answer, F.lit("...")).alias("answer"),
        F.when(F.coalesce(sources, F.lit("")) == "", F.lit("none retrieved"))
        .otherwise(sources)
        .alias("sources"),
        F.when(F.col("faithfulness").isNotNull(), score)
        .otherwise(F.lit("N/A (judge error)"))
        .alias("score"),
        F.coalesce(
            F.nullif(F.col("comment"), F.lit("")), F.col("judge_error"), F.lit("")
        ).alias("comment"),
    )
    return shown.orderBy("id").limit(max_rows) if max_rows else shown

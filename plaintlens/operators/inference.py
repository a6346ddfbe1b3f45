"""Batch calls of a caller's text model, with retries, from inside Spark tasks.

A client is any callable ``(prompt, max_tokens) -> text``. It is made once per task by the
factory the caller passes. A failed call never fails the task: it turns into an error column.
Tasks may be retried and would then call again, so write the result before using it twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plaintlens import constants as K
from plaintlens.functions.prompt import answer_prompt, context_block, judge_prompt
from plaintlens.functions.scoring import judge_scores

Client = Callable[[str, int], str | None]
ClientFactory = Callable[[], Client]


def is_transient(error: Exception) -> bool:
    """Worth another attempt: time-outs, rate limits, server-side and connection failures."""
    response = getattr(error, "response", None)
    if response is not None:
        status = getattr(response, "status_code", None)
        return status is not None and (status == 429 or status >= 500)
    return isinstance(error, (TimeoutError, ConnectionError, OSError))


def call_with_retry(
    client: Client,
    prompt: str,
    max_tokens: int,
    attempts: int = K.MAX_ATTEMPTS,
    backoff: float = K.BACKOFF_BASE_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
) -> str:
    """The stripped reply; waits 1x, 2x, 4x ... the back-off between transient failures."""
    for attempt in range(attempts):
        try:
            return (client(prompt, max_tokens) or "").strip()
        except Exception as error:
            if attempt + 1 == attempts or not is_transient(error):
                raise
            sleep(backoff * 2**attempt)
    raise ValueError("attempts must be positive")


def infer(
    df: DataFrame,
    make_client: ClientFactory,
    prompt_column: str,
    reply_column: str,
    error_column: str,
    max_tokens: int,
    attempts: int = K.MAX_ATTEMPTS,
    backoff: float = K.BACKOFF_BASE_SECONDS,
    parallelism: int | None = None,
) -> DataFrame:
    """Add the model's reply to every prompt, and the error text where the call failed.

    Rows without a prompt pass through without a call, and a task that has none never makes a
    client. Other columns travel as Arrow buffers and are not converted. ``parallelism``
    repartitions first and so bounds the number of concurrent callers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = None
        for batch in batches:
            replies: list[str | None] = []
            errors: list[str | None] = []
            for prompt in batch.column(prompt_column).to_pylist():
                reply = error = None
                if prompt is not None:
                    try:
                        client = client or make_client()
                        reply = call_with_retry(client, prompt, max_tokens, attempts, backoff)
                    except Exception as failure:
                        error = str(failure) or type(failure).__name__
                replies.append(reply)
                errors.append(error)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(replies, pa.string()), pa.array(errors, pa.string())],
                names=[*batch.schema.names, reply_column, error_column],
            )

    if parallelism:
        df = df.repartition(parallelism)
    schema = T.StructType([*df.schema.fields]).add(reply_column, "string").add(
        error_column, "string"
    )
    return df.mapInArrow(run, schema)


def with_sources(questions: DataFrame, hits: DataFrame) -> DataFrame:
    """Each question with its hits as an array in rank order (at most top-k entries)."""
    fields = [
        "rank", "chunk_text", "complaint_id", "product_category", "chunk_index", "total_chunks",
        "similarity_score", "company", "issue", "sub_issue", "date_received",
    ]
    grouped = hits.groupBy("question_id").agg(
        F.sort_array(F.collect_list(F.struct(*fields))).alias("sources")
    )
    empty = F.array().cast(grouped.schema["sources"].dataType)
    return questions.join(grouped, "question_id", "left").withColumn(
        "sources", F.coalesce("sources", empty)
    )


def with_prompts(df: DataFrame, organisation: str = K.DEFAULT_ORGANISATION) -> DataFrame:
    """Add context_block and prompt; a question without hits gets no prompt."""
    found = F.size("sources") > 0
    return df.withColumn("context_block", context_block(F.col("sources"))).withColumn(
        "prompt",
        F.when(found, answer_prompt(F.col("context_block"), F.col("question"), organisation)),
    )


def generate_answers(
    df: DataFrame,
    make_client: ClientFactory,
    max_tokens: int = K.MAX_NEW_TOKENS,
    attempts: int = K.MAX_ATTEMPTS,
    backoff: float = K.BACKOFF_BASE_SECONDS,
    parallelism: int | None = None,
) -> DataFrame:
    """Answer every prompted question; without hits a fixed message and no call.

    Adds answer and generation_error.
    """
    called = infer(
        df, make_client, "prompt", "_reply", "_error", max_tokens, attempts, backoff, parallelism
    )
    failed = F.col("_error").isNotNull()
    return called.select(
        *df.columns,
        F.when(F.col("prompt").isNull(), F.lit(K.NO_CONTEXT_MESSAGE))
        .when(failed, F.lit(K.ANSWER_FAILURE_MESSAGE))
        .otherwise(F.col("_reply"))
        .alias("answer"),
        failed.alias("generation_error"),
    )


def judge_answers(
    df: DataFrame,
    make_client: ClientFactory,
    max_tokens: int = K.JUDGE_MAX_TOKENS,
    parallelism: int | None = None,
) -> DataFrame:
    """Add retrieval_relevance, faithfulness, comment and judge_error. One call per answer."""
    prompted = df.withColumn(
        "_judge_prompt",
        judge_prompt(F.col("question"), F.col("context_block"), F.col("answer")),
    )
    called = infer(
        prompted, make_client, "_judge_prompt", "_reply", "_error", max_tokens, attempts=1,
        parallelism=parallelism,
    )
    scored = called.withColumn("_s", judge_scores(F.col("_reply")))
    failed = F.col("_error").isNotNull()
    return scored.select(
        *df.columns,
        F.when(~failed, F.col("_s.retrieval_relevance")).alias("retrieval_relevance"),
        F.when(~failed, F.col("_s.faithfulness")).alias("faithfulness"),
        F.when(failed, F.lit("")).otherwise(F.col("_s.comment")).alias("comment"),
        F.when(failed, F.col("_error")).otherwise(F.col("_s.judge_error")).alias("judge_error"),
    )

"""Reading a judge's reply: find the JSON object, take two integers and a comment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(reply: Column) -> Column:
    """From the first opening to the last closing brace; "" when there is none."""
    return F.regexp_extract(F.coalesce(reply, F.lit("")), r"(?s)\{.*\}", 0)


def _integer(parsed: Column, field: str) -> Column:
    """A number is cut to its integer part, a text must be a plain integer, all else is null."""
    value = F.try_variant_get(parsed, f"$.{field}", "variant")
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(parsed, f"$.{field}", "string")
    return (
        F.when(kind == "STRING", F.trim(text).try_cast("int"))
        .when(kind == "BOOLEAN", F.try_variant_get(parsed, f"$.{field}", "boolean").cast("int"))
        .when(kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)"), text.try_cast("double").try_cast("int"))
    )


def judge_scores(reply: Column) -> Column:
    """struct(retrieval_relevance, faithfulness, comment, judge_error) from the raw reply.

    Both scores count only when both are readable; otherwise they are null and ``judge_error``
    says why. Scores are not limited to 1-5 here, see ``score_out_of_range``.
    """
    found = json_object(reply)
    parsed = F.try_parse_json(found)
    relevance, faithful = (
        _integer(parsed, "retrieval_relevance"),
        _integer(parsed, "faithfulness"),
    )
    error = (
        F.when(
            found == "",
            F.concat(
                F.lit("No JSON object found in judge response: '"),
                F.coalesce(reply, F.lit("")),
                F.lit("'"),
            ),
        )
        .when(parsed.isNull(), F.lit("judge response is not valid JSON"))
        .when(relevance.isNull(), F.lit("retrieval_relevance is missing or not an integer"))
        .when(faithful.isNull(), F.lit("faithfulness is missing or not an integer"))
    )
    comment = F.coalesce(F.try_variant_get(parsed, "$.comment", "string"), F.lit(""))
    return F.struct(
        F.when(error.isNull(), relevance).alias("retrieval_relevance"),
        F.when(error.isNull(), faithful).alias("faithfulness"),
        F.when(error.isNull(), comment).otherwise(F.lit("")).alias("comment"),
        error.alias("judge_error"),
    )


def score_out_of_range(score: Column) -> Column:
    return F.coalesce(~score.between(1, 5), F.lit(False))

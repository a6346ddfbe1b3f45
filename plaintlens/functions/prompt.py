"""Context blocks and prompts by concatenation, since user text may hold braces or percents."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from plaintlens import constants as K


def context_block(sources: Column) -> Column:
    """Numbered excerpts, a blank line apart, from an array of hits already in rank order."""
    parts = F.transform(
        sources,
        lambda hit, i: F.concat(
            F.lit("[Excerpt "),
            (i + 1).cast("string"),
            F.lit(" | Product: "),
            hit["product_category"],
            F.lit(" | Complaint ID: "),
            hit["complaint_id"],
            F.lit("]\n"),
            hit["chunk_text"],
        ),
    )
    return F.array_join(parts, "\n\n")


def fill_template(template: str, **values: Column | str) -> Column:
    """Concatenate a template's literal parts with the columns named in its {slots}."""
    names = "|".join(map(re.escape, values))
    pieces = []
    for i, piece in enumerate(re.split(rf"\{{({names})\}}", template)):
        value = values[piece] if i % 2 else piece
        pieces.append(F.lit(value) if isinstance(value, str) else value)
    return F.concat(*pieces)


def answer_prompt(
    context: Column, question: Column, organisation: str = K.DEFAULT_ORGANISATION
) -> Column:
    return fill_template(
        K.ANSWER_TEMPLATE, organisation=organisation, context=context, question=question
    )


def judge_prompt(question: Column, context: Column, answer: Column) -> Column:
    shown = F.when(F.coalesce(context, F.lit("")) == "", F.lit(K.NO_CONTEXT_FOR_JUDGE)).otherwise(
        context
    )
    return fill_template(
        K.JUDGE_TEMPLATE, question=question, context=shown, answer=F.coalesce(answer, F.lit(""))
    )

import pytest
from pyspark.sql import functions as F

from plaintlens import constants as K
from plaintlens import schemas as S
from plaintlens.functions.prompt import answer_prompt, context_block, judge_prompt
from plaintlens.functions.scoring import judge_scores, score_out_of_range
from plaintlens.operators import evaluation, inference


class HttpError(Exception):
    def __init__(self, status):
        super().__init__(f"http {status}")
        self.response = type("R", (), {"status_code": status})()


def test_judge_replies(apply):
    got = apply(
        judge_scores,
        [
            '{"retrieval_relevance": 4, "faithfulness": 5, "comment": "Good"}',
            'Sure!\n```json\n{"retrieval_relevance": 3,\n "faithfulness": "2"}\n``` done',
            "no json here",
            '{"retrieval_relevance": 4.7, "faithfulness": true}',
            '{"retrieval_relevance": "4.7", "faithfulness": 1}',
            '{"retrieval_relevance": null, "faithfulness": 1}',
            '{"retrieval_relevance": 3}',
            '{"retrieval_relevance": 3, }',
            '{"retrieval_relevance": 9, "faithfulness": 0, "comment": "a {b} c"}',
            None,
        ],
    )
    scores = [(g.retrieval_relevance, g.faithfulness) for g in got]
    none = (None, None)
    assert scores == [(4, 5), (3, 2), none, (4, 1), none, none, none, none, (9, 0), none]
    assert got[0].comment == "Good" and got[0].judge_error is None and got[8].comment == "a {b} c"
    assert "No JSON object found" in got[2].judge_error
    assert all(g.judge_error for g, s in zip(got, scores) if s == none)


def test_range_flag(apply):
    assert apply(lambda c: score_out_of_range(c.cast("int")), ["0", "1", "5", "6", None]) == [
        True, False, False, True, False,
    ]


def rows(spark, *items):
    full = [
        (f"q{i}", "Credit Card", "why?", "because", [], ge, r, f, c, je)
        for i, (ge, r, f, c, je) in enumerate(items)
    ]
    return spark.createDataFrame(full, S.EVALUATION_ROWS)


def test_summary_numbers(spark):
    df = rows(spark, (False, 5, 5, "", None), (False, 4, 3, "", None), (False, 2, 2, "", None))
    s = evaluation.summarize(df).first()
    assert tuple(s) == (3, 3, 3.67, 3.33, 0.333, False)
    s = evaluation.summarize(df.filter("faithfulness = 5")).first()
    assert s.meets_faithfulness_target is True


def test_summary_skips_unscored_and_handles_none_scored(spark):
    df = rows(spark, (False, 5, 5, "", None), (False, None, None, "", "boom"))
    s = evaluation.summarize(df).first()
    assert (s.n_total, s.n_scored, s.avg_faithfulness) == (2, 1, 5.0)
    s = evaluation.summarize(df.filter("faithfulness is null")).first()
    assert tuple(s) == (1, 0, None, None, None, False)
    assert evaluation.range_check(rows(spark, (False, 9, 5, "", None))).count() == 1


def test_resume_split(spark):
    previous = rows(
        spark,
        (False, 5, 5, "", None),  # q0 done
        (True, 5, 5, "", None),  # q1 generation failed
        (False, None, None, "", "bad"),  # q2 judge failed
        (None, 5, 5, "", None),  # q3 unknown
        (False, 4, 4, "", None),  # q4 done, but no longer asked
    )
    asked = spark.createDataFrame([(f"q{i}",) for i in (0, 1, 2, 3, 9)], "id string")
    remaining, reused = evaluation.split_resume(asked, previous)
    assert {r.id for r in remaining.collect()} == {"q1", "q2", "q3", "q9"}
    assert {r.id for r in reused.collect()} == {"q0"}


def test_report(spark):
    source = [("7", "Credit Card", "ACME", "Fees", 0.816, "text")] * 2
    full = [
        ("a", "c", "why?", "line\nbreak " + "x" * 200, source, False, 5, 4, "", None),
        ("b", "c", "how?", None, [], False, None, None, "", "quota"),
    ]
    df = spark.createDataFrame(full, S.EVALUATION_ROWS)
    a, b = evaluation.report_rows(df).collect()
    assert a.answer == ("line break " + "x" * 200)[:150] + "..."
    assert a.sources == "Credit Card #7 (0.82); Credit Card #7 (0.82)"
    assert (a.score, a.comment) == ("R:5/F:4", "")
    assert (b.answer, b.sources, b.score, b.comment) == (
        "...", "none retrieved", "N/A (judge error)", "quota",
    )
    assert evaluation.report_rows(df, 1).count() == 1 and evaluation.report_rows(df, 0).count() == 2


HITS = (
    "question_id string, rank int, chunk_text string, complaint_id string, product_category string, "
    "chunk_index int, total_chunks int, similarity_score double, company string, issue string, "
    "sub_issue string, date_received string"
)


@pytest.fixture(scope="module")
def prompted(spark):
    questions = spark.createDataFrame(
        [("a", "Credit Card", "why {x} 100%?"), ("b", "Personal Loan", "no hits")],
        "question_id string, category string, question string",
    )
    hits = spark.createDataFrame(
        [
            ("a", 2, "second " * 60, "22", "Credit Card", 0, 1, 0.5, "", "", "", ""),
            ("a", 1, "first {0} %s", "11", "Credit Card", 0, 1, 0.9, "ACME", "", "", ""),
            ("a", 3, "third", "33", "Personal Loan", 0, 1, 0.1, "", "", "", ""),
        ],
        HITS,
    )
    return inference.with_prompts(inference.with_sources(questions, hits), "ACME Bank").cache()


def test_context_and_prompt(prompted):
    a = prompted.filter("question_id = 'a'").first()
    assert a.context_block.startswith(
        "[Excerpt 1 | Product: Credit Card | Complaint ID: 11]\nfirst {0} %s\n\n[Excerpt 2 | "
    )
    assert a.prompt == K.ANSWER_TEMPLATE.replace("{organisation}", "ACME Bank").replace(
        "{context}", a.context_block
    ).replace("{question}", "why {x} 100%?")
    b = prompted.filter("question_id = 'b'").first()
    assert (b.context_block, b.prompt, b.sources) == ("", None, [])


def test_judge_prompt_without_context(spark):
    df = spark.createDataFrame([("q", "", "a")], "q string, c string, a string")
    text = df.select(judge_prompt(F.col("q"), F.col("c"), F.col("a"))).first()[0]
    assert K.NO_CONTEXT_FOR_JUDGE in text and '{"retrieval_relevance": <int 1-5>' in text


def test_answers_call_the_model_only_with_a_prompt(prompted):
    def make():
        def client(prompt, max_tokens):
            assert prompt.startswith("You are a financial analyst") and max_tokens == 300
            return "  the answer \n"

        return client

    got = {r.question_id: r for r in inference.generate_answers(prompted, make).collect()}
    assert (got["a"].answer, got["a"].generation_error) == ("the answer", False)
    assert (got["b"].answer, got["b"].generation_error) == (K.NO_CONTEXT_MESSAGE, False)


def test_failed_answer_falls_back(prompted):
    def make():
        def client(prompt, max_tokens):
            raise ValueError("401")

        return client

    got = {r.question_id: r for r in inference.generate_answers(prompted, make).collect()}
    assert (got["a"].answer, got["a"].generation_error) == (K.ANSWER_FAILURE_MESSAGE, True)
    assert got["b"].generation_error is False


def test_judging(prompted):
    answered = prompted.withColumn("answer", F.lit("x")).withColumn("generation_error", F.lit(False))

    def make():
        def client(prompt, max_tokens):
            if "no hits" in prompt:
                raise RuntimeError("quota")
            return 'ok {"retrieval_relevance": 4, "faithfulness": 5, "comment": "fine"}'

        return client

    judged = inference.judge_answers(answered, make, parallelism=2)
    got = {r.id: r for r in evaluation.evaluation_rows(judged).collect()}
    assert (got["a"].retrieval_relevance, got["a"].faithfulness, got["a"].comment) == (4, 5, "fine")
    assert [s.complaint_id for s in got["a"].retrieved_sources] == ["11", "22"]
    assert len(got["a"].retrieved_sources[1].excerpt) == 200
    assert (got["b"].faithfulness, got["b"].judge_error, got["b"].comment) == (None, "quota", "")


@pytest.mark.parametrize(
    "error, calls, waits",
    [
        (TimeoutError(), 3, [1.5, 3.0]),
        (ConnectionError(), 3, [1.5, 3.0]),
        (OSError(), 3, [1.5, 3.0]),
        (HttpError(429), 3, [1.5, 3.0]),
        (HttpError(503), 3, [1.5, 3.0]),
        (HttpError(401), 1, []),
        (KeyError("x"), 1, []),
    ],
)
def test_retry_only_transient_failures(error, calls, waits):
    seen, slept = [], []

    def client(prompt, max_tokens):
        seen.append(prompt)
        raise error

    with pytest.raises(type(error)):
        inference.call_with_retry(client, "p", 5, sleep=slept.append)
    assert (len(seen), slept) == (calls, waits)


def test_retry_recovers_and_strips():
    replies = iter([TimeoutError(), None])

    def client(prompt, max_tokens):
        r = next(replies)
        if isinstance(r, Exception):
            raise r
        return r

    assert inference.call_with_retry(client, "p", 5, sleep=lambda s: None) == ""


def test_templates_have_only_known_slots(spark):
    df = spark.createDataFrame([("c", "q")], "c string, q string")
    text = df.select(answer_prompt(F.col("c"), F.col("q"))).first()[0]
    assert "{" not in text and K.DEFAULT_ORGANISATION in text
    empty = df.select(context_block(F.array().cast("array<struct<product_category:string,complaint_id:string,chunk_text:string>>"))).first()[0]
    assert empty == ""

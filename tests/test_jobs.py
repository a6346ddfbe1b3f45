import json
import os
import sys
import tempfile

import pytest
from pyspark import cloudpickle
from test_metadata import row

from plaintlens import constants as K
from plaintlens import schemas as S
from plaintlens.operators import complaints, metadata
from plaintlens.plans import jobs
from plaintlens.session import first_rows
from plaintlens.sources import readers, writers
from plaintlens.streaming.ingest import ingest_available

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="plaintlens-test-")


@pytest.fixture(scope="module")
def cleaned(spark):
    phrase = "charge card late fee money account bank letter "
    rows = [
        (100 * c + i, name, phrase * 15)
        for c, name in enumerate(K.VALID_CATEGORIES)
        for i in range(50)
    ]
    return spark.createDataFrame(
        rows, "complaint_id long, product_category string, cleaned_narrative string"
    ).cache()


CSV = '''Extra,Product,Complaint ID,Consumer complaint narrative,Date received,Sub-product,Issue,Sub-issue,Company,State
1,Credit card,11,"He said ""pay""
now, or else",2024-02-03,s,i,si,ACME,NY
2,Mortgage,12,text,2024-02-03,,,,ACME,NY
3,Payday loan,13,,2024-02-03,,,,ACME,NY
4,Consumer Loan,14,"   ",2024-02-03,,N/A,,ACME,NY
5,Money transfers,15,!!!,2024-02-03,,,,ACME,NY
6,Bank account or service,16,Fees charged,2024-02-04,,,,ACME,CA
'''


def test_raw_csv_to_cleaned_table(spark, folder):
    path = f"{folder}/raw.csv"
    with open(path, "w", newline="") as f:
        f.write(CSV)
    raw = readers.read_raw_complaints(spark, path)
    assert raw.columns == list(S.RAW_HEADERS.values())
    rows = {r.complaint_id: r for r in raw.collect()}
    assert rows[11].narrative == 'He said "pay"\nnow, or else'
    assert str(rows[11].date_received) == "2024-02-03"
    assert rows[13].narrative is None and rows[14].issue is None
    # 12 is no target product, 13 has no narrative, 14 is blank, 15 is emptied by cleaning
    out = jobs.prepare_complaints(raw)
    got = {r.complaint_id: (r.product_category, r.cleaned_narrative) for r in out.collect()}
    assert got == {
        11: ("Credit Card", "say pay else"), 16: ("Savings Account", "fee charge"),
    }

    writers.write_cleaned_complaints(out, f"{folder}/c.csv", "csv")
    writers.write_cleaned_complaints(out, f"{folder}/c.parquet")
    by_csv = readers.read_cleaned_complaints(spark, f"{folder}/c.csv", "csv")
    by_parquet = readers.read_cleaned_complaints(spark, f"{folder}/c.parquet")
    assert by_csv.columns == by_parquet.columns == list(S.CLEANED_HEADERS.values())
    assert sorted(by_csv.collect()) == sorted(by_parquet.collect())


def test_product_map_has_ten_labels(spark):
    dimension = complaints.product_dimension(spark)
    assert dimension.count() == 10
    assert {r[0] for r in dimension.select("product_category").distinct().collect()} == set(
        K.VALID_CATEGORIES
    )


def test_openers_shown(spark):
    df = spark.createDataFrame([("I am writing to file a complaint about X",), ("no",)], "narrative string")
    assert complaints.openers_shown(df).first().stripped == "x"


def test_sample_store(spark, cleaned, folder):
    m = jobs.build_sample_store(spark, cleaned, folder, sample_size=80).first()
    assert (m.sample_size_requested, m.sample_size_actual) == (80, 80)
    assert dict(spark.read.parquet(m.category_counts_path).collect()) == {c: 20 for c in K.VALID_CATEGORIES}
    ids = [r[0] for r in spark.read.parquet(m.sampled_ids_path).orderBy("complaint_id").collect()]
    assert len(set(ids)) == m.sample_size_actual
    store = readers.open_collection(spark, folder, "complaints_sample")
    assert readers.collection_size(store).first()[0] == m.num_chunks == store.count()
    assert {len(r.embedding) for r in store.collect()} == {K.EMBEDDING_DIM}
    again = jobs.build_sample_store(spark, cleaned, folder, sample_size=80).first()
    assert ids == [r[0] for r in spark.read.parquet(again.sampled_ids_path).orderBy("complaint_id").collect()]
    store = readers.open_collection(spark, folder, "complaints_sample")
    assert store.count() == m.num_chunks
    some = store.first().id
    assert [r.id for r in readers.lookup_ids(store, [some]).collect()] == [some]


def test_any_number_of_ids_and_categories(spark, cleaned, folder):
    from pyspark.sql import functions as F

    many = cleaned.withColumn("product_category", F.concat(F.lit("c"), "complaint_id"))
    m = jobs.build_sample_store(spark, many, folder, sample_size=200).first()
    assert spark.read.parquet(m.category_counts_path).count() == m.sample_size_actual
    assert not any(isinstance(v, (list, dict, tuple)) for v in m)


@pytest.fixture(scope="module")
def source(spark):
    rows = [
        row(f"{i // 2}_{i % 2}", i % 2, 2, K.VALID_CATEGORIES[i % 4], None if i == 3 else "NY")
        for i in range(500)
    ]
    return spark.createDataFrame(rows, S.PREBUILT)


@pytest.mark.parametrize("layout", ["rebalance", "narrow"])
def test_full_ingest(spark, source, folder, layout):
    path = f"{folder}/source"
    source.repartition(3).write.parquet(path)
    m = jobs.ingest_embeddings(spark, readers.read_embeddings(spark, path), folder, layout=layout).first()
    assert (m.rows_in_source_file, m.rows_ingested, m.final_collection_count) == (500, 500, 500)
    counts = dict(spark.read.parquet(m.category_counts_path).collect())
    assert counts == {c: 125 for c in K.VALID_CATEGORIES} and not m.has_duplicate_ids
    store = readers.open_collection(spark, folder, "complaints_full")
    want = metadata.flatten_metadata(source)
    assert sorted(store.select(*want.columns).collect()) == sorted(want.collect())


def test_limited_ingest_replaces_the_store(spark, source, folder):
    jobs.ingest_embeddings(spark, source, folder)
    for limit in (150, 0):
        m = jobs.ingest_embeddings(spark, source, folder, limit_rows=limit).first()
        assert (m.rows_ingested, m.limit_rows, m.rows_in_source_file) == (limit, limit, 500)


def test_limited_ingest_is_spread(spark, source, folder):
    """No single task takes the rows of a limit: the tasks that read them write them."""
    source.repartition(5).write.parquet(f"{folder}/source")
    read = readers.read_embeddings(spark, f"{folder}/source").repartition(5)
    for limit in (499, 500, 10**9):
        jobs.ingest_embeddings(spark, read, folder, limit_rows=limit, layout="narrow")
        store = readers.open_collection(spark, folder, "complaints_full")
        assert store.count() == min(limit, 500) and store.select("id").distinct().count() == min(limit, 500)
        tasks = {os.path.basename(f).split("-")[1] for f in store.inputFiles()}
        assert len(tasks) > 1


@pytest.mark.parametrize("n", [0, 1, 7, 99, 100, 101, 10**12])
def test_first_rows_are_exactly_so_many(spark, n):
    rows = spark.range(0, 100, 1, 6).where("id % 10 < 9 or id > 50").withColumnRenamed("id", "x")
    got = [r.x for r in first_rows(rows, n).collect()]
    assert len(got) == min(n, rows.count()) == len(set(got))


def test_profile_reads_no_data(spark, source, folder):
    source.repartition(3).write.parquet(f"{folder}/p")
    df = readers.read_embeddings(spark, f"{folder}/p")
    r = readers.dataset_profile(df).first()
    assert (r.n_files, r.n_rows, r.n_columns) == (3, 500, 4) and r.total_bytes > 0
    pruned = readers.read_embeddings(spark, f"{folder}/p", ["id", "metadata.state"])
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,metadata:struct<state:string>>" in plan


def good_answer():
    return lambda prompt, n: "I don't have enough information to answer that."


def good_judge():
    return lambda prompt, n: 'x {"retrieval_relevance": 4, "faithfulness": 5, "comment": "ok"}'


def bad_judge():
    def judge(prompt, n):
        raise RuntimeError("quota")

    return judge


def test_evaluation_run_resume_and_history(spark, cleaned, folder):
    jobs.build_sample_store(spark, cleaned, folder, sample_size=80)
    store = readers.open_collection(spark, folder, "complaints_sample")
    results = f"{folder}/results"
    asked = spark.createDataFrame(
        [("q1", "Credit Card", "late fee on card"), ("q2", "Savings Account", "bank letter"),
         ("q3", "Credit Card", "   ")],
        S.QUESTIONS,
    )
    first, summary = jobs.evaluate_run(
        spark, asked, store, good_answer, bad_judge, results, run_timestamp="2024-01-01T00:00:00"
    )
    assert summary.first().n_scored == 0 and first.count() == 3
    second, summary = jobs.evaluate_run(
        spark, asked, store, good_answer, good_judge, results,
        previous=jobs.resume_source(spark, results), run_timestamp="2024-01-02T00:00:00",
    )
    s = summary.first()
    assert (s.n_total, s.n_scored, s.avg_faithfulness, s.meets_faithfulness_target) == (3, 2, 5.0, True)
    rows = {r.id: r for r in second.collect()}
    assert "cannot be empty" in rows["q3"].judge_error and rows["q3"].answer is None
    assert len(rows["q1"].retrieved_sources) == 2

    # a third run reuses the two finished rows, so a broken model is never asked for them
    third, summary = jobs.evaluate_run(
        spark, asked.filter("id <> 'q3'"), store, bad_judge, bad_judge, results,
        previous=jobs.resume_source(spark, results), run_timestamp="2024-01-03T00:00:00",
    )
    assert summary.first().n_scored == 2
    history = readers.read_history(spark, results).orderBy("run_timestamp").collect()
    assert [h.n_scored for h in history] == [0, 2, 2]
    assert history[0].avg_faithfulness is None and history[1].meets_faithfulness_target is True
    named = jobs.resume_source(spark, results, "2024-01-01T00:00:00")
    assert named.count() == 3 and named.filter("faithfulness is not null").count() == 0


def test_question_and_results_documents(spark, folder):
    with open(f"{folder}/q.json", "w") as f:
        json.dump([{"id": "a", "category": "Credit Card", "question": "why?\nreally"}], f, indent=2)
    assert [tuple(r) for r in readers.read_questions(spark, f"{folder}/q.json").collect()] == [
        ("a", "Credit Card", "why?\nreally")
    ]
    rows = [{"id": "a", "generation_error": False, "judge_error": None, "faithfulness": 4,
             "retrieved_sources": [{"complaint_id": "1", "similarity_score": 0.5}]}]
    with open(f"{folder}/r.json", "w") as f:
        json.dump({"summary": {}, "rows": rows}, f)
    r = readers.read_results_document(spark, f"{folder}/r.json").first()
    assert (r.id, r.faithfulness, r.retrieved_sources[0].complaint_id) == ("a", 4, "1")


def test_streamed_ingest_takes_each_file_once(spark, source, folder):
    landing, store = f"{folder}/landing", f"{folder}/streamed"
    for expected in (500, 1000, 1000):
        if expected > 500 and spark.read.parquet(landing).count() == 500 or expected == 500:
            source.repartition(2).write.mode("append").parquet(landing)
        ingest_available(spark, landing, store, f"{folder}/check").awaitTermination(120)
        assert spark.read.parquet(store).count() == expected


@pytest.mark.parametrize("name", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]"])
def test_shared_folder_is_required_on_a_cluster(spark, name):
    from plaintlens import session

    class Context:
        master = name

        def getCheckpointDir(self):
            return None

    class Cluster:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(Cluster())
    assert session.scratch_path(spark, "x").startswith(session.shared_dir(spark))


def test_scratch_is_cleared(spark):
    import os

    from plaintlens import session

    path = session.scratch_path(spark, "x")
    folder = os.path.dirname(path).removeprefix("file:")
    spark.range(3).write.parquet(path)
    assert os.path.exists(folder)
    session.clear_scratch(spark)
    assert not os.path.exists(folder)

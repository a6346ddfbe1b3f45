import pytest
from pyspark.sql import functions as F

from plaintlens import schemas as S
from plaintlens.operators import metadata

FIELDS = [
    "chunk_index", "company", "complaint_id", "date_received", "issue", "product",
    "product_category", "state", "sub_issue", "total_chunks",
]


def row(id_, index=0, total=1, category="Credit Card", state="NY", dim=384, text="some text"):
    meta = (index, "ACME", id_.rsplit("_", 1)[0], "2024-01-01", "Fees", "Credit card", category,
            state, "Late", total)
    return (id_, text, [0.5] * dim, meta)


@pytest.fixture(scope="module")
def table(spark):
    rows = [row(f"{i}_{j}", j, 2, text="x" * (i + 1)) for i in range(20) for j in range(2)]
    rows += [
        row("20_7", 1),  # index differs from the id
        row("nounderscore", 0),
        row("21_x", 0),
        row("22_0", None, None, None, None, dim=10),
        ("23_0", "no metadata", [0.1] * 384, None),
        row("0_0", 0),  # duplicate id
    ]
    return spark.createDataFrame(rows, S.PREBUILT)


def test_flatten(table):
    flat = metadata.flatten_metadata(table)
    assert flat.columns == ["id", "document", "embedding", *FIELDS]
    got = {r.id: r for r in flat.collect()}
    assert (got["22_0"].chunk_index, got["22_0"].total_chunks, got["22_0"].state) == (0, 0, "")
    assert (got["23_0"].chunk_index, got["23_0"].product_category) == (0, "")
    assert got["1_1"].chunk_index == 1 and got["1_1"].company == "ACME"


def test_flatten_tolerates_missing_fields(spark, table):
    fewer = table.withColumn("metadata", F.col("metadata").dropFields("state", "issue"))
    assert "state" not in metadata.flatten_metadata(fewer).columns


def test_counts_and_duplicates(table):
    counts = dict(metadata.category_counts(metadata.flatten_metadata(table)).collect())
    assert counts == {"Credit Card": 44, "": 2}
    r = metadata.reconcile(table, table).first()
    assert (r.rows_ingested, r.rows_stored, r.distinct_ids, r.has_duplicates) == (46, 46, 45, True)
    assert [tuple(x) for x in metadata.duplicate_ids(table).collect()] == [("0_0", 2)]
    assert tuple(metadata.hidden_counters(table).first()) == (2, 2)


def test_struct_keys(table):
    got = {r.key: r for r in metadata.metadata_keys(table).collect()}
    assert set(got) == set(FIELDS)
    assert (got["state"].present_in, got["state"].with_value) == (46, 44)
    assert got["state"].coverage_pct == 100.0 and got["chunk_index"].value_types == "BIGINT"


def test_json_and_map_keys(spark):
    df = spark.createDataFrame(
        [('{"a": 1, "b": "x"}',), ('{"a": "y", "c": null}',), ("{}",), (None,)], "p string"
    )
    got = {r.key: tuple(r)[1:] for r in metadata.metadata_keys(df, "p").collect()}
    assert got == {
        "a": (2, 2, "BIGINT,STRING", 50.0), "b": (1, 1, "STRING", 25.0), "c": (1, 0, "", 25.0),
    }
    maps = spark.createDataFrame([({"a": 1},), ({"a": None, "b": 2},)], "m map<string,int>")
    got = {r.key: tuple(r)[1:] for r in metadata.metadata_keys(maps, "m").collect()}
    assert got == {"a": (2, 1, "int", 100.0), "b": (1, 1, "int", 50.0)}


def test_ids(table):
    r = metadata.id_pattern_check(table).first()
    assert (r.checked, r.unexpected_format, r.mismatches) == (46, 2, 1)
    assert [tuple(x) for x in metadata.id_mismatches(table).collect()] == [("20_7", 7, 1)]
    r = metadata.chunks_per_complaint(table).first()
    # 0..19 plus 20, nounderscore, 21, 22, 23
    assert (r.total_rows, r.distinct_complaints, r.min_chunks, r.max_chunks) == (46, 25, 1, 3)
    assert r.mean_chunks == 1.84


def test_lengths_dimensions_samples(table):
    lengths = sorted(len(r.document) for r in table.collect())
    r = metadata.document_lengths(table).first()
    assert (r.p25, r.p95) == (lengths[int(46 * 0.25)], lengths[int(46 * 0.95)])
    dims = {x.dim: (x.n_rows, x.as_expected) for x in metadata.dimension_check(table).collect()}
    assert dims == {384: (45, True), 10: (1, False)}
    shown = metadata.sample_rows(table, 3).collect()
    assert len(shown) == 3 and all(len(x.first_values) == 5 for x in shown)

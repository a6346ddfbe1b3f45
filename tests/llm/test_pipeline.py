"""The stages on the given documents, each against what its operator says of its own input."""

import hashlib
from collections import Counter

import corpus_pipeline
import pytest
from conftest import SMALL

from plaintlens.llm.queries import QUERIES
from plaintlens.llm.stages import STAGES


@pytest.fixture(scope="module")
def results(spark):
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    out.append(docs.collect())
    for name, stage in STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema if name != "packing" else None)
        out.append(docs.collect())
    return out


def test_order_of_the_stages():
    assert [n for n, _ in STAGES] == ["quality_classifier", "exact_dedup", "simhash", "suffix_dedup", "packing"]


def test_rejected_documents_go(spark, results):
    docs, good = results[0], results[1]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    clean = [i for i, q in labels.items() if q == 1]
    assert set(good) <= set(docs) and len(kept) < len(docs)
    assert sum(i not in kept for i in clean) <= 0.03 * len(clean)  # few labels here


def test_one_of_equal_texts_stays(results):
    before, after = results[1], results[2]
    last = {}
    for r in before:
        last[r.text] = max(last.get(r.text, -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(last.values())


def test_one_of_each_component_stays(results):
    from test_simhash import brute_components, brute_print

    rows = sorted(results[2])
    label = brute_components([brute_print(r.text) for r in rows])
    assert sorted(r.doc_id for r in results[3]) == sorted(rows[i].doc_id for i in set(label))


def test_repeats_go(results):
    from test_suffix_dedup import brute

    want = {r[0]: r for r in brute(sorted((r.doc_id, r.text) for r in results[3]))}
    got = {r.doc_id: r for r in results[4]}
    assert set(got) == {i for i, r in want.items() if r[2] < r[1] or r[1] == 0}
    for i, r in got.items():
        assert r.n_chars == len(r.text)
        if r.text.isascii():
            assert hashlib.sha256(r.text.encode()).hexdigest() == want[i][4]


def test_every_token_is_packed(results):
    import public_tokenizers as P
    from test_packing import check
    from tokenizers import Tokenizer

    docs = sorted(results[4])
    number = {r.doc_id: i for i, r in enumerate(docs)}
    encoded = Tokenizer.from_file(P.path("word_bpe_49k.json")).encode_batch([r.text for r in docs], add_special_tokens=False)

    class Piece(dict):
        __getattr__ = dict.__getitem__

    rows = [Piece(r.asDict(), doc_id=number[r.doc_id]) for r in results[5]]
    check(rows, [e.ids + [1] for e in encoded])


def test_run_gives_the_rows_of_the_last_stage(spark, results):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert Counter(map(key, rows)).keys() and sum(r.length for r in rows) == sum(r.length for r in results[5])


def test_columns_stay(results):
    for rows in results[:5]:
        assert list(rows[0].asDict()) == ["doc_id", "text", "lang", "source", "n_chars"]


def test_empty_table(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in STAGES:
        assert stage(spark, empty, SMALL).collect() == []


def test_odd_rows_and_clashing_names(spark):
    long = "".join(f"word{i * 7919 % 10007} " for i in range(40_000))
    rows = [
        (None, None, None, None, None), (1, "", "en", "a", 0), (2, long, "en", "a", 5), (3, long, None, "b", 5),
        (4, "a b c", "de", None, None), (4, "a b c", "de", None, None), (5, "a b c", "de", "c", 5), (6, None, "de", "c", 5),
    ]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("key", "kept", "fp", "row", "hash", "recipe", "doc", "component_id", "ranges", "carried", "ids")
    odd = odd.selectExpr("*", *(f"'{n}' AS {n}" for n in extra))
    for name, stage in STAGES:
        rows = stage(spark, odd, SMALL).collect()
        if name == "packing":
            assert {r.doc_id for r in rows} == {None, 1, 2, 3, 4, 5, 6}
            continue
        assert list(rows[0].asDict()) == odd.columns and all(r.key == "key" for r in rows)
        ids = sorted((r.doc_id for r in rows), key=str)
        # by hand: equal texts are (null, 1, 6), (2, 3) and (4, 4, 5); the suffix stage empties 3
        assert ids == {
            "quality_classifier": ids,
            "exact_dedup": [3, 5, 6],
            "simhash": [1, 2, 4, 4, None],
            "suffix_dedup": [1, 2, 4, 4, 5, 6, None],
        }[name], name


def test_registered_queries():
    assert {n.split("_")[0] for n in QUERIES} <= {f"op{i}" for i in range(1, 14)}

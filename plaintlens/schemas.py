"""Column layouts of every table the library reads or writes."""

from __future__ import annotations

# File header -> column name. The order of the first nine is the raw export's own.
RAW_HEADERS = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "narrative",
    "Company": "company",
    "State": "state",
    "Complaint ID": "complaint_id",
}
CLEANED_HEADERS = {
    "Complaint ID": "complaint_id",
    "Date received": "date_received",
    "product_category": "product_category",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Company": "company",
    "State": "state",
    "Consumer complaint narrative": "narrative",
    "cleaned_narrative": "cleaned_narrative",
}

# Cell texts that count as missing when a CSV is read.
MISSING_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

CHUNKS = (
    "complaint_id string, product_category string, chunk_index int, total_chunks int, "
    "chunk_text string"
)
METADATA = (
    "struct<chunk_index:bigint,company:string,complaint_id:string,date_received:string,"
    "issue:string,product:string,product_category:string,state:string,sub_issue:string,"
    "total_chunks:bigint>"
)
PREBUILT = f"id string, document string, embedding array<double>, metadata {METADATA}"
QUESTIONS = "id string, category string, question string"
SOURCES = (
    "array<struct<complaint_id:string,product_category:string,company:string,issue:string,"
    "similarity_score:double,excerpt:string>>"
)
EVALUATION_ROWS = (
    f"id string, category string, question string, answer string, retrieved_sources {SOURCES}, "
    "generation_error boolean, retrieval_relevance int, faithfulness int, comment string, "
    "judge_error string"
)
HISTORY = (
    "run_timestamp string, n_total bigint, n_scored bigint, avg_retrieval_relevance double, "
    "avg_faithfulness double, pct_faithful_ge_4 double, meets_faithfulness_target boolean, "
    "results_file string"
)
# Hit fields that a minimal store may lack, with the value that stands in.
HIT_DEFAULTS = {
    "complaint_id": "",
    "product_category": "",
    "chunk_index": 0,
    "total_chunks": 1,
    "company": "",
    "issue": "",
    "sub_issue": "",
    "date_received": "",
}

# Folder name of an empty category; a null one has the usual default folder.
EMPTY_CATEGORY = "__empty__"

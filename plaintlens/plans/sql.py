"""The same queries in DuckDB SQL, written from the rules rather than from the Spark plans."""

from __future__ import annotations

from plaintlens import constants as K
from plaintlens.functions.text import seed_lexicon
from plaintlens.plans.queries import (
    INGEST_LIMITS,
    LOOKED_UP,
    NOISE,
    OPENERS,
    REPORT_ROWS,
    RUN_STAMPS,
    SAMPLE_ROWS,
    STAND_IN_MAP,
)

_RANGES = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_WS, _NOT_WS = f"[{_RANGES}]", f"[^{_RANGES}]"


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _trim(e: str) -> str:
    return f"trim({e}, {_q(K.WHITESPACE)})"


def _sub(e: str, pattern: str, to: str = "", everywhere: bool = True) -> str:
    flags = ", 'g'" if everywhere else ""
    return f"regexp_replace({e}, {_q(pattern)}, {_q(to)}{flags})"


def _openers(e: str) -> str:
    for _ in range(K.OPENER_PASSES):
        for pattern in K.OPENER_PATTERNS:
            e = _sub(e, pattern, everywhere=False)
    return _trim(e)


def _noise_free(e: str) -> str:
    out = _openers(f"lower({e})")
    for pattern in [
        f"http{_NOT_WS}+|www{_NOT_WS}+",
        r"\b\d{3}[-.\s]?\d{4}\b",
        r"\b\d{3}[-.\s]?\d{3}[-.\s]?\d{4}\b",
        r"\b[a-z]{2}\d{10,}\b",
        "x{2,}",
        r"<[^\n]*?>",
        rf"[^\p{{L}}\p{{N}}_{_RANGES}]",
    ]:
        out = _sub(out, pattern)
    out = _trim(_sub(out, f"{_WS}+", " "))
    return f"CASE WHEN {e} IS NULL OR {_trim(e)} = '' OR lower({e}) = 'nan' THEN '' ELSE {out} END"


def _case(e: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {_q(a)} THEN {_q(b)}" for a, b in pairs.items())
    return f"CASE {e} {whens} ELSE {e} END"


def _normalized(e: str) -> str:
    parted = {w.replace("|", ""): w.replace("|", " ") for w in K.SPLIT_WORDS}
    verbs = {s: lemma for s, pos, lemma in seed_lexicon() if pos == "v"}
    nouns = {s: lemma for s, pos, lemma in seed_lexicon() if pos == "n"}
    stop = "[" + ", ".join(map(_q, K.STOP_WORDS)) + "]"
    words = f"string_split({e}, ' ')"
    words = f"list_transform({words}, lambda w: {_case('w', parted)})"
    words = f"string_split(array_to_string({words}, ' '), ' ')"
    words = f"list_filter({words}, lambda w: w <> '' AND NOT list_contains({stop}, w))"
    words = f"list_transform({words}, lambda w: {_case('w', verbs)})"
    words = f"list_transform({words}, lambda w: {_case('w', nouns)})"
    return f"array_to_string({words}, ' ')"


def _chosen(values: list[str], key: str) -> str:
    return "[" + ", ".join(map(_q, values)) + f"][({key}) % {len(values)} + 1]"


_DIMENSION = "dimension(product, product_category) AS (VALUES {})".format(
    ", ".join(f"({_q(p)}, {_q(c)})" for c, labels in STAND_IN_MAP.items() for p in labels)
)
_MAPPED = f"""{_DIMENSION},
mapped AS (
  SELECT doc_id AS complaint_id, source AS product, product_category, text AS narrative, lang
  FROM documents JOIN dimension ON source = product
  WHERE text IS NOT NULL AND {_trim('text')} <> '')"""
_CLEANED = f"""{_MAPPED},
noise_free AS MATERIALIZED (
  SELECT complaint_id, product_category, {_noise_free('narrative')} AS t FROM mapped),
cleaned_all AS (
  SELECT complaint_id, product_category, {_normalized('t')} AS cleaned_narrative
  FROM noise_free),
cleaned AS MATERIALIZED (SELECT * FROM cleaned_all WHERE length(cleaned_narrative) > 0)"""


def _chunked(source: str, size: int, overlap: int, name: str = "chunked") -> str:
    """Word-level splitting: last word that fits, first word that keeps the overlap, pointers."""
    n = name
    return f"""
{n}_words AS MATERIALIZED (
  SELECT *, sum(len) OVER w AS pe, sum(len) OVER w - len AS ps FROM (
    SELECT complaint_id, i, length(word) + CASE WHEN i > 1 THEN 1 ELSE 0 END AS len
    FROM (SELECT complaint_id, unnest(string_split(cleaned_narrative, ' ')) AS word,
                 generate_subscripts(string_split(cleaned_narrative, ' '), 1) AS i
          FROM {source}))
  WINDOW w AS (PARTITION BY complaint_id ORDER BY i)),
{n}_ends AS (
  SELECT a.complaint_id, a.i, a.ps, b.i AS last_i, b.pe AS last_pe
  FROM {n}_words a ASOF JOIN {n}_words b
    ON a.complaint_id = b.complaint_id AND a.ps + {size} >= b.pe),
{n}_limits AS (
  SELECT e.*, CASE WHEN x.i IS NULL THEN NULL
                   ELSE greatest(e.last_pe - {overlap}, x.pe - {size}) END AS thr
  FROM {n}_ends e LEFT JOIN {n}_words x
    ON e.complaint_id = x.complaint_id AND x.i = e.last_i + 1),
{n}_steps AS MATERIALIZED (
  SELECT l.complaint_id, l.i, l.ps, l.last_pe, s.i AS next_i
  FROM {n}_limits l ASOF LEFT JOIN {n}_words s
    ON l.complaint_id = s.complaint_id AND l.thr <= s.ps),
{n}_walk AS (
  SELECT complaint_id, 0 AS chunk_index, i, ps, last_pe, next_i FROM {n}_steps WHERE i = 1
  UNION ALL
  SELECT s.complaint_id, k.chunk_index + 1, s.i, s.ps, s.last_pe, s.next_i
  FROM {n}_walk k JOIN {n}_steps s ON s.complaint_id = k.complaint_id AND s.i = k.next_i),
{n} AS MATERIALIZED (
  SELECT CAST(c.complaint_id AS VARCHAR) AS complaint_id, c.product_category,
         CAST(k.chunk_index AS INTEGER) AS chunk_index,
         CAST(count(*) OVER (PARTITION BY k.complaint_id) AS INTEGER) AS total_chunks,
         trim(substr(c.cleaned_narrative, CAST(k.ps AS BIGINT) + 1,
                     CAST(k.last_pe - k.ps AS BIGINT))) AS chunk_text,
         concat(c.complaint_id, '_', k.chunk_index) AS id
  FROM {n}_walk k JOIN {source} c ON c.complaint_id = k.complaint_id)"""


_CHUNKS = f"RECURSIVE {_CLEANED}, {_chunked('cleaned', K.CHUNK_SIZE, K.CHUNK_OVERLAP)}"

_DRAW = f"md5(concat(complaint_id, '|', {K.SAMPLE_SEED}))"


def _sampled(source: str) -> str:
    return f"""
sizes AS (SELECT *, (SELECT count(*) FROM {source}) AS n_all,
                 count(*) OVER (PARTITION BY product_category) AS n_group,
                 row_number() OVER (PARTITION BY product_category
                                    ORDER BY {_DRAW}, complaint_id) AS r
          FROM {source}),
sampled AS (SELECT * EXCLUDE (n_all, n_group, r) FROM sizes
            WHERE {SAMPLE_ROWS} >= n_all
               OR r <= round_even({SAMPLE_ROWS} / n_all * n_group, 0))"""


def _shares(source: str, column: str = "product_category") -> str:
    return f"""SELECT {column}, count(*) AS count,
       round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM {source} WHERE {column} IS NOT NULL GROUP BY {column}"""


_WORDS = f"words AS (SELECT length(regexp_extract_all(text, {_q(_NOT_WS + '+')})) AS words FROM documents)"


def _histogram(source: str, column: str, bins: int, clip: float | None = None) -> str:
    value = f"CAST({column} AS DOUBLE)"
    clipped = (
        f"least({value}, (SELECT quantile_cont({column}, {clip}) FROM {source}))" if clip else value
    )
    return f"""vals AS (SELECT {clipped} AS v FROM {source}),
lim AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
               CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM vals)
SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * ((hi - lo) / {bins}), 6) AS bin_start,
       count(*) AS count
FROM (SELECT least(floor((v - lo) * {bins} / (hi - lo)), {bins - 1}) AS bin, lo, hi
      FROM vals, lim)
GROUP BY bin, lo, hi"""


_LABELLED = "(SELECT d.doc_id, d.source, l.quality FROM documents d LEFT JOIN labels l USING (doc_id))"

_PREBUILT = f"""{_DIMENSION},
prebuilt AS (
  SELECT concat(d.doc_id, '_', coalesce(CAST(l.quality AS VARCHAR), 'none')) AS id,
         d.text AS document, CAST(l.toxic AS BIGINT) AS chunk_index, d.source AS company,
         CAST(d.doc_id AS VARCHAR) AS complaint_id, d.lang AS issue, d.source AS product,
         m.product_category, d.lang AS state,
         CASE WHEN l.quality = 1 THEN 'good' END AS sub_issue,
         CAST(l.quality AS BIGINT) AS total_chunks
  FROM documents d LEFT JOIN dimension m ON d.source = m.product
                   LEFT JOIN labels l USING (doc_id)),
flat AS (
  SELECT id, CAST(coalesce(chunk_index, 0) AS INTEGER) AS chunk_index, company, complaint_id,
         '' AS date_received, issue, product, coalesce(product_category, '') AS product_category,
         state, coalesce(sub_issue, '') AS sub_issue,
         CAST(coalesce(total_chunks, 0) AS INTEGER) AS total_chunks
  FROM prebuilt)"""


def _mod32(e: str) -> str:
    return f"CAST(({e}) % 4294967296 AS BIGINT)"


def _times(e: str, factor: int) -> str:
    return _mod32(f"CAST({e} AS HUGEINT) * {factor}")


def _rotated(e: str, bits: int) -> str:
    return f"(((({e}) << {bits}) & 4294967295) | (({e}) >> {32 - bits}))"


def _murmur3(word: str, seed: int = 42) -> str:
    """The public 32-bit murmur3 hash of a word's UTF-8 bytes, unsigned."""
    h = f"hex({word})"
    n = f"CAST(length({h}) // 2 AS BIGINT)"

    def little_endian(start: str, count: str) -> str:
        return (
            f"CAST(list_sum(list_transform(range(0, {count}), lambda j: "
            f"('0x' || substr({h}, CAST(({start} + j) * 2 + 1 AS BIGINT), 2))::BIGINT << (8 * j))) AS BIGINT)"
        )

    # blocks and tail as plain columns keep the expressions small
    return f"""
  SELECT w, CAST(list_reduce(list_prepend(CAST({seed} AS BIGINT),
              list_transform(range(0, n // 4), lambda i: k[i + 1])),
              lambda h, k: {_mod32("CAST(" + _rotated("xor(h, k)", 13) + " AS HUGEINT) * 5 + 3864292196")}) AS BIGINT) AS body,
         tail, n
  FROM (
    SELECT w, n,
           list_transform(raw, lambda r: {_times(_rotated(_times('r', 0xCC9E2D51), 15), 0x1B873593)}) AS k,
           CASE WHEN n % 4 > 0 THEN {_times(_rotated(_times(little_endian("(n // 4) * 4", "n % 4"), 0xCC9E2D51), 15), 0x1B873593)}
                ELSE 0 END AS tail
    FROM (SELECT {word} AS w, {n} AS n,
                 list_transform(range(0, {n} // 4), lambda i: {little_endian("i * 4", "4")}) AS raw
          FROM source_words))"""


def _hashed(source: str, key: str, text: str, name: str) -> str:
    """Word counts per murmur3 bucket, scaled to length one and kept as 32-bit floats."""
    n = name
    return f"""
{n}_tokens AS MATERIALIZED (
  SELECT * FROM (SELECT {key} AS k, unnest(regexp_split_to_array(lower({text}), '\\s+')) AS w
                 FROM {source}) WHERE w <> ''),
{n}_body AS ({_murmur3('w').replace('source_words', f'(SELECT DISTINCT w FROM {n}_tokens)')}),
{n}_x1 AS (SELECT w, xor(xor(body, tail), n) AS h FROM {n}_body),
{n}_x2 AS (SELECT w, {_times('xor(h, h >> 16)', 0x85EBCA6B)} AS h FROM {n}_x1),
{n}_x3 AS (SELECT w, {_times('xor(h, h >> 13)', 0xC2B2AE35)} AS h FROM {n}_x2),
{n}_x4 AS (SELECT w, xor(h, h >> 16) AS h FROM {n}_x3),
{n}_buckets AS MATERIALIZED (
  SELECT w, ((CASE WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END) % {K.EMBEDDING_DIM}
             + {K.EMBEDDING_DIM}) % {K.EMBEDDING_DIM} AS b FROM {n}_x4),
{n}_counts AS (SELECT k, b, count(*) AS n FROM {n}_tokens JOIN {n}_buckets USING (w) GROUP BY 1, 2),
{n} AS MATERIALIZED (
  SELECT k, b, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY k)) AS FLOAT)::DOUBLE AS w
  FROM {n}_counts)"""


_QUESTIONS = f"""questions AS (
  SELECT CAST(item_id AS VARCHAR) AS question_id, {_chosen(sorted(STAND_IN_MAP), 'item_id')}
         AS category, text AS question
  FROM benchmark)"""

_TEXT_HITS = f"""{_CHUNKS}, {_QUESTIONS},
valid AS (SELECT question_id, {_trim('question')} AS question FROM questions
          WHERE question IS NOT NULL AND {_trim('question')} <> ''
            AND length({_trim('question')}) <= {K.MAX_QUESTION_CHARS}),
{_hashed('valid', 'question_id', 'question', 'qv')},
{_hashed('chunked', 'id', 'chunk_text', 'sv')},
qn AS (SELECT k, sum(w * w) AS n FROM qv GROUP BY k),
sn AS (SELECT k, sum(w * w) AS n FROM sv GROUP BY k),
dots AS (SELECT q.k AS qk, s.k AS sk, sum(q.w * s.w) AS dot
         FROM qv q JOIN sv s USING (b) GROUP BY 1, 2),
near AS (SELECT qn.k AS question_id, sn.k AS id,
                round(qn.n + sn.n - 2 * coalesce(dot, 0), 9) AS distance
         FROM qn CROSS JOIN sn LEFT JOIN dots ON qk = qn.k AND sk = sn.k),
hits AS (SELECT question_id, rank, id, complaint_id, product_category, chunk_text,
                CASE WHEN round(1 - distance, 4) = 0 THEN 0.0::DOUBLE
                     ELSE round(1 - distance, 4) END AS similarity_score
         FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, id) AS rank
               FROM near) JOIN chunked USING (id)
         WHERE rank <= 3)"""


def _template(template: str, **slots: str) -> str:
    """concat() of the template's parts; ``slots`` are SQL expressions."""
    parts, rest = [], template
    while rest:
        found = [(rest.find("{" + s + "}"), s) for s in slots if "{" + s + "}" in rest]
        if not found:
            parts.append(_q(rest))
            break
        at, slot = min(found)
        parts += [_q(rest[:at]), slots[slot]]
        rest = rest[at + len(slot) + 2 :]
    return f"concat({', '.join(parts)})"


_PROMPTS = f"""{_TEXT_HITS},
contexts AS (
  SELECT question_id,
         string_agg(concat('[Excerpt ', rank, ' | Product: ', product_category,
                           ' | Complaint ID: ', complaint_id, ']', chr(10), chunk_text),
                    chr(10) || chr(10) ORDER BY rank) AS context,
         string_agg(complaint_id, ',' ORDER BY rank) FILTER (rank <= 2) AS sources
  FROM hits GROUP BY question_id),
prompts AS (
  SELECT q.question_id, q.category, valid.question, context, sources,
         {_template(K.ANSWER_TEMPLATE, organisation=_q(K.DEFAULT_ORGANISATION),
                    context='context', question='valid.question')} AS prompt
  FROM questions q JOIN valid USING (question_id) JOIN contexts USING (question_id))"""

_VECTORS = """vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, concat('label ', label) AS product_category,
         CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
asked AS (
  SELECT product_category AS question_id, list_transform(v, lambda x: CAST(x / norm AS FLOAT)::DOUBLE) AS q
  FROM (SELECT product_category, arg_min(v, vec_id) AS v,
               sqrt(list_inner_product(arg_min(v, vec_id), arg_min(v, vec_id))) AS norm
        FROM vectors GROUP BY 1)),
near AS (
  SELECT question_id, id, product_category,
         round(list_inner_product(q, q) + list_inner_product(v, v)
               - 2 * list_inner_product(q, v), 9) AS distance
  FROM asked CROSS JOIN vectors)"""

_AWKWARD = "CASE label % 4 WHEN 0 THEN '001' WHEN 1 THEN '2024-01-01' WHEN 2 THEN '' END"

_SCORED = """scored AS (
  SELECT CAST(d.doc_id AS VARCHAR) AS id, d.source, d.lang, d.text, d.n_chars,
         l.quality, l.toxic, 5 - l.toxic * 3 AS relevance, 1 + l.quality * 4 AS faithful
  FROM documents d LEFT JOIN labels l USING (doc_id))"""
_SUMMARY = f"""SELECT count(*) AS n_total, count(faithful) AS n_scored,
       round(avg(relevance) FILTER (faithful IS NOT NULL), 2) AS avg_retrieval_relevance,
       round(avg(faithful), 2) AS avg_faithfulness,
       round(avg(CASE WHEN faithful >= 4 THEN 1.0 WHEN faithful IS NOT NULL THEN 0.0 END), 3)
         AS pct_faithful_ge_4,
       coalesce(avg(CASE WHEN faithful >= 4 THEN 1.0 WHEN faithful IS NOT NULL THEN 0.0 END)
                >= {K.FAITHFULNESS_TARGET}, false) AS meets_faithfulness_target
FROM scored"""

_PAIR = """'{"retrieval_relevance": ' || quality || ', "faithfulness": ' || toxic || ', "comment": "fine"}'"""

_TOP20 = """SELECT "column", value, count, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS rank FROM (
    SELECT 'product' AS "column", product AS value, count(*) AS count FROM flat GROUP BY 2
    UNION ALL
    SELECT 'product_category', product_category, count(*) FROM flat GROUP BY 2))
WHERE rank <= 20"""

_ALLOWED = "[" + ", ".join(f"'{c}'" for c in sorted(K.VALID_CATEGORIES)) + "]"

ORACLE_SQL: dict[str, str] = {
    "product_counts": "SELECT source AS product, count(*) AS count FROM documents GROUP BY 1",
    "category_filter_map": f"WITH {_MAPPED} SELECT complaint_id, product, product_category FROM mapped",
    "narrative_presence": f"""SELECT count(quality) AS n_with, count(*) - count(quality) AS n_without,
       round(count(quality) / count(*) * 100, 1) AS pct_with FROM {_LABELLED}""",
    "coverage_by_product": f"""SELECT source, count(quality) AS n_with, count(*) AS total,
       round(count(quality) / count(*) * 100, 1) AS pct_with FROM {_LABELLED} GROUP BY source""",
    "distinct_products": "SELECT DISTINCT source AS product FROM documents",
    "word_count_describe": f"""WITH {_WORDS}
SELECT count(words) AS count, round(avg(words), 6) AS mean, round(stddev_samp(words), 6) AS std,
       min(words) AS min, quantile_cont(words, 0.25) AS p25, quantile_cont(words, 0.5) AS p50,
       quantile_cont(words, 0.75) AS p75, max(words) AS max FROM words""",
    "word_count_histogram": f"WITH {_WORDS}, {_histogram('words', 'words', 80, 0.99)}",
    "length_outliers": f"""WITH {_WORDS}
SELECT count(*) FILTER (words < 5) AS n_below, count(*) FILTER (words > 1000) AS n_above FROM words""",
    "strip_openers": f"""SELECT doc_id, {_openers('lower(t)')} AS stripped
FROM (SELECT doc_id, concat({_chosen(OPENERS, 'doc_id')}, text) AS t FROM documents)""",
    "opener_counts": f"""SELECT count(*) AS n_rows,
       count(*) FILTER (regexp_matches(t, {_q('(?i)' + K.OPENER_SEARCH)})) AS n_openers
FROM (SELECT concat({_chosen(OPENERS, 'doc_id')}, text) AS t FROM documents)""",
    "clean_noise": f"""SELECT doc_id, {_noise_free('t')} AS cleaned
FROM (SELECT doc_id, concat(text, ' ', {_chosen(NOISE, 'doc_id')}) AS t FROM documents)""",
    "clean_noise_pages": f"""SELECT page_id, {_noise_free('t')} AS cleaned
FROM (SELECT page_id, concat(url, ' ', html) AS t FROM pages)""",
    "normalize_tokens": f"WITH {_CLEANED} SELECT complaint_id, cleaned_narrative FROM cleaned",
    "stratified_sample": f"WITH {_MAPPED}, {_sampled('mapped')} SELECT complaint_id, product_category FROM sampled",
    "sample_summary": f"WITH {_MAPPED}, {_sampled('mapped')} {_shares('sampled')}",
    "share_compare": f"""WITH {_MAPPED}, {_sampled('mapped')}
SELECT product_category, f.pct AS full_pct, s.pct AS sample_pct
FROM ({_shares('mapped')}) f FULL JOIN ({_shares('sampled')}) s USING (product_category)""",
    "chunks": f"WITH {_CHUNKS} SELECT * FROM chunked",
    "chunk_stats": f"""WITH {_CHUNKS}
SELECT product_category, count(DISTINCT complaint_id) AS n_complaints, count(*) AS n_chunks,
       round(avg(length(chunk_text)), 2) AS avg_chars, max(total_chunks) AS max_chunks
FROM chunked GROUP BY 1""",
    "chunk_sweep": f"WITH RECURSIVE {_CLEANED}, "
    + ", ".join(_chunked("cleaned", s, o, f"c{s}") for s, o in K.SWEEP_CANDIDATES)
    + "\nUNION ALL\n".join(
        f"""
SELECT {s} AS chunk_size, {o} AS chunk_overlap, count(*) AS total_chunks,
       round(count(*) / (SELECT count(*) FROM cleaned), 2) AS avg_chunks_per_complaint,
       round(avg(length(chunk_text)), 1) AS avg_chunk_length FROM c{s}"""
        for s, o in K.SWEEP_CANDIDATES
    ),
    "chunk_length_histogram": f"""WITH {_CHUNKS}, lengths AS (SELECT length(chunk_text) AS n FROM chunked),
{_histogram('lengths', 'n', 40)}""",
    "first_multichunk": f"""WITH {_CHUNKS}
SELECT complaint_id, chunk_index, total_chunks, substr(chunk_text, 1, 200) AS shown FROM chunked
WHERE CAST(complaint_id AS BIGINT) =
      (SELECT min(CAST(complaint_id AS BIGINT)) FROM chunked WHERE total_chunks > 1)""",
    "category_cap": f"""WITH {_CHUNKS}
SELECT id, product_category FROM (
  SELECT *, row_number() OVER (PARTITION BY product_category
                               ORDER BY md5(concat(id, '|', {K.SAMPLE_SEED})), id) AS r
  FROM chunked) WHERE r <= {K.CATEGORY_CAP}""",
    "hash_embedding": f"""WITH {_CHUNKS}, {_hashed('chunked', 'id', 'chunk_text', 'sv')}
SELECT k AS id, string_agg(concat(b, ':', CAST(round(w * 1000, 0) AS INTEGER)), ' ' ORDER BY b)
       AS vector FROM sv GROUP BY k""",
    "model_embedding": """SELECT doc_id, round(a / n, 4) AS v0, round(b / n, 4) AS v1, round(1 / n, 4) AS v2
FROM (SELECT *, sqrt(a * a + b * b + 1) AS n FROM (
  SELECT doc_id, CAST(length(text) AS DOUBLE) AS a,
         CAST(length(text) - length(replace(text, ' ', '')) + 1 AS DOUBLE) AS b FROM documents))""",
    "flatten_metadata": f"WITH {_PREBUILT} SELECT * FROM flat",
    "ingest_categories": f"WITH {_PREBUILT} SELECT product_category, count(*) AS count FROM flat GROUP BY 1",
    "hidden_counters": f"""WITH {_PREBUILT}
SELECT count(*) FILTER (chunk_index IS NULL) AS null_chunk_index,
       count(*) FILTER (total_chunks IS NULL) AS null_total_chunks FROM prebuilt""",
    "sparse_rich_union": f"""WITH {_CHUNKS}, {_PREBUILT.replace(_DIMENSION + ',', '', 1)}
SELECT id, complaint_id, product_category, chunk_index, total_chunks, company, issue, sub_issue,
       date_received FROM flat
UNION ALL
SELECT concat('c', id), complaint_id, product_category, chunk_index, total_chunks, '', '', '', ''
FROM chunked""",
    "ingest_reconcile": """SELECT count(*) AS rows_ingested, count(*) AS rows_stored,
       count(DISTINCT md5(text)) AS distinct_ids, count(DISTINCT md5(text)) <> count(*) AS has_duplicates
FROM documents""",
    "duplicate_ids": "SELECT md5(text) AS id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
    "store_roundtrip": """SELECT CAST(vec_id AS VARCHAR) AS id, concat('label ', label) AS product_category,
       CAST(len(embedding) AS INTEGER) AS dim, round(CAST(embedding[1] AS DOUBLE), 4) AS first_value
FROM embeddings""",
    "metadata_keys": f"WITH {_PREBUILT} "
    + "\nUNION ALL\n".join(
        f"""SELECT '{k}' AS key, count(*) AS present_in, count({v}) AS with_value,
       CASE WHEN count({v}) > 0 THEN '{t}' ELSE '' END AS value_types, 100.0::DOUBLE AS coverage_pct FROM prebuilt"""
        for k, v, t in [
            ("chunk_index", "chunk_index", "BIGINT"),
            ("company", "company", "STRING"),
            ("complaint_id", "complaint_id", "STRING"),
            ("date_received", "CAST(NULL AS VARCHAR)", "STRING"),
            ("issue", "issue", "STRING"),
            ("product", "product", "STRING"),
            ("product_category", "product_category", "STRING"),
            ("state", "state", "STRING"),
            ("sub_issue", "sub_issue", "STRING"),
            ("total_chunks", "total_chunks", "BIGINT"),
        ]
    ),
    "metadata_keys_json": """SELECT key, count(*) AS present_in, count(kind) AS with_value,
       coalesce(string_agg(DISTINCT kind, ',' ORDER BY kind), '') AS value_types,
       round(count(*) / (SELECT count(*) FROM events) * 100, 1) AS coverage_pct
FROM (SELECT key, CASE json_type(props, '$.' || key)
                    WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT'
                    WHEN 'VARCHAR' THEN 'STRING' WHEN 'NULL' THEN NULL
                    ELSE json_type(props, '$.' || key) END AS kind
      FROM (SELECT props, unnest(json_keys(props)) AS key FROM events))
GROUP BY key""",
    "id_pattern_check": f"""WITH {_PREBUILT}
SELECT count(*) AS checked, count(*) FILTER (NOT regexp_matches(id, '_[0-9]+$')) AS unexpected_format,
       count(*) FILTER (TRY_CAST(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT) <> chunk_index) AS mismatches
FROM prebuilt""",
    "id_mismatches": f"""WITH {_PREBUILT}
SELECT id, TRY_CAST(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT) AS index_in_id,
       chunk_index AS index_in_metadata FROM prebuilt
WHERE TRY_CAST(regexp_extract(id, '_([0-9]+)$', 1) AS BIGINT) <> chunk_index ORDER BY id LIMIT 5""",
    "chunks_per_complaint": f"""WITH {_CHUNKS}
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_complaints, min(n) AS min_chunks,
       max(n) AS max_chunks, round(avg(n), 2) AS mean_chunks
FROM (SELECT count(*) AS n FROM chunked GROUP BY complaint_id)""",
    "rank_percentiles": f"""WITH {_CHUNKS},
sorted AS (SELECT list(length(chunk_text) ORDER BY length(chunk_text)) AS l, count(*) AS n FROM chunked)
SELECT n AS n_rows, CAST(l[1] AS INTEGER) AS min, """
    + ", ".join(
        f"CAST(l[CAST(floor(n * {p}::DOUBLE) AS BIGINT) + 1] AS INTEGER) AS {name}"
        for name, p in [("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p95", 0.95)]
    )
    + ", CAST(l[n] AS INTEGER) AS max FROM sorted",
    "top_values": f"WITH {_PREBUILT} {_TOP20}",
    "dim_check": """SELECT CAST(len(embedding) AS INTEGER) AS dim, count(*) AS n_rows,
       len(embedding) = 64 AS as_expected FROM embeddings GROUP BY len(embedding)""",
    "sample_rows": """SELECT CAST(doc_id AS VARCHAR) AS id,
       concat(substr(text, 1, 200), CASE WHEN length(text) > 200 THEN '...' ELSE '' END) AS document,
       1 AS dim, CAST(n_chars AS VARCHAR) AS first_values
FROM documents ORDER BY doc_id LIMIT 5""",
    "knn_topk": f"""WITH {_VECTORS}
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, round(greatest(distance, 0.0), 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY greatest(distance, 0.0), id) AS rank FROM near)
WHERE rank <= 5""",
    "knn_pruned": """WITH vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
near AS (
  SELECT a.id AS question_id, b.id,
         round(list_inner_product(a.v, a.v) + list_inner_product(b.v, b.v)
               - 2 * list_inner_product(a.v, b.v), 9) AS distance
  FROM (SELECT * FROM vectors WHERE vec_id % 20 = 0) a CROSS JOIN vectors b)
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, round(greatest(distance, 0.0), 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY greatest(distance, 0.0), id) AS rank FROM near)
WHERE rank <= 5""",
    "knn_filtered": f"""WITH {_VECTORS}
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, round(greatest(distance, 0.0), 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY greatest(distance, 0.0), id) AS rank
  FROM near WHERE product_category = question_id)
WHERE rank <= 5""",
    "text_retrieval": f"""WITH {_TEXT_HITS}
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, complaint_id, product_category,
       similarity_score, '' AS company FROM hits""",
    "retrieval_quality": f"""WITH {_VECTORS}
SELECT count(*) AS n_hits, round(avg(CASE WHEN product_category <> question_id THEN 1.0 ELSE 0.0 END), 4)
         AS leakage_rate,
       count(*) FILTER (round(1 - greatest(distance, 0.0), 4) < {K.LOW_SIMILARITY}) AS n_low_similarity
FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY greatest(distance, 0.0), id) AS rank FROM near)
WHERE rank <= 5""",
    "question_validation": f"""WITH {_DIMENSION}
SELECT doc_id AS question_id, CASE
  WHEN q IS NULL THEN 'Question must be text.'
  WHEN q = '' THEN 'Question cannot be empty. Please type a question.'
  WHEN length(q) > {K.MAX_QUESTION_CHARS} THEN concat('Question is too long (', length(q),
       ' characters). Please limit questions to {K.MAX_QUESTION_CHARS} characters.')
  WHEN product_category IS NULL THEN concat('Invalid product_category ''', source,
       {_q(f"'. Must be one of: {_ALLOWED}")})
  ELSE 'ok' END AS reject_reason
FROM (SELECT doc_id, source, product_category, CASE WHEN lang <> 'de' THEN {_trim('text')} END AS q
      FROM documents LEFT JOIN dimension ON source = product)""",
    "question_coverage": f"""WITH {_QUESTIONS}
SELECT category, count(*) AS n_questions, count(DISTINCT question_id) AS n_ids,
       count(*) FILTER ({_trim('question')} = '') AS n_blank FROM questions GROUP BY 1""",
    "context_prompt": f"""WITH {_PROMPTS}
SELECT question_id, md5(context) AS context_md5, CAST(length(prompt_raw) AS INTEGER) AS prompt_chars,
       md5(prompt_raw) AS prompt_md5, substr(context, 1, 60) AS context_start
FROM (SELECT p.*, {_template(K.ANSWER_TEMPLATE, organisation=_q(K.DEFAULT_ORGANISATION),
                             context='p.context', question='q.question')} AS prompt_raw
      FROM prompts p JOIN questions q USING (question_id))""",
    "judge_parse": f"""WITH replies AS (
  SELECT doc_id, quality, toxic, doc_id % 7 AS shape, CASE doc_id % 7
    WHEN 2 THEN 'I would give it a ' || quality ELSE {_PAIR} END AS reply FROM labels)
SELECT doc_id,
  CASE shape WHEN 0 THEN quality WHEN 1 THEN quality WHEN 3 THEN quality ELSE -1 END AS retrieval_relevance,
  CASE shape WHEN 0 THEN toxic WHEN 1 THEN toxic WHEN 3 THEN 4 ELSE -1 END AS faithfulness,
  CASE WHEN shape IN (0, 1) THEN 'fine' ELSE '' END AS comment,
  CASE shape WHEN 2 THEN concat('No JSON object found in judge response: ''', reply, '''')
             WHEN 4 THEN 'retrieval_relevance is missing or not an integer'
             WHEN 5 THEN 'faithfulness is missing or not an integer'
             WHEN 6 THEN 'judge response is not valid JSON' ELSE '' END AS judge_error,
  shape IN (0, 1, 3) AND quality NOT BETWEEN 1 AND 5 AS out_of_range
FROM replies""",
    "eval_summary": f"WITH {_SCORED} {_SUMMARY}",
    "resume_rows": f"""WITH {_SCORED}
SELECT id, CASE WHEN toxic <> 1 AND quality IS NOT NULL THEN 'reused' ELSE 'to run' END AS state FROM scored""",
    "report_rows": f"""WITH {_SCORED}
SELECT id, concat('What about ', source, '?') AS question,
       concat(substr(replace(CASE WHEN quality IS NULL THEN '' ELSE text END, chr(10), ' '), 1, 150), '...') AS answer,
       CASE WHEN quality IS NULL THEN 'none retrieved'
            ELSE concat(source, ' #', id, ' (', printf('%.2f', round(1.0::DOUBLE / (n_chars + 1), 4)), ')') END AS sources,
       CASE WHEN quality IS NULL THEN 'N/A (judge error)' ELSE concat('R:', relevance, '/F:', faithful) END AS score,
       CASE WHEN quality = 1 THEN lang WHEN quality IS NULL THEN 'not judged' ELSE '' END AS comment
FROM scored""",
    "batch_answers": f"""WITH {_PROMPTS},
answered AS (SELECT *, concat('answer ', md5(prompt)) AS answer FROM prompts),
marked AS (SELECT *, ('0x' || substr(md5({_template(K.JUDGE_TEMPLATE, question='question',
                                                    context='context', answer='answer')}), 1, 4))::BIGINT AS mark
           FROM answered)
SELECT question_id AS id, category, answer, sources, false AS generation_error,
       CAST(mark % 5 + 1 AS INTEGER) AS retrieval_relevance,
       CAST(mark // 5 % 5 + 1 AS INTEGER) AS faithfulness, 'seen' AS comment FROM marked""",
    "build_manifest": f"""WITH RECURSIVE {_CLEANED}, {_sampled('cleaned')},
{_chunked('sampled', K.CHUNK_SIZE, K.CHUNK_OVERLAP)}
SELECT {SAMPLE_ROWS} AS sample_size_requested, (SELECT count(*) FROM sampled) AS sample_size_actual,
       (SELECT count(*) FROM chunked) AS num_chunks, {K.CHUNK_SIZE} AS chunk_size,
       {K.CHUNK_OVERLAP} AS chunk_overlap,
       (SELECT array_to_string(list_sort(list(product_category || '=' || n)), ',')
        FROM (SELECT product_category, count(*) AS n FROM sampled GROUP BY 1)) AS category_counts,
       (SELECT CAST(sum(('0x' || substr(md5(CAST(complaint_id AS VARCHAR)), 1, 8))::BIGINT) AS BIGINT)
        FROM sampled) AS ids_sum""",
    "history_append": f"""WITH {_SCORED}, summary AS ({_SUMMARY})
SELECT stamp AS run_timestamp, summary.*, concat('runs/run_timestamp=', stamp) AS results_file,
       n_total AS rows_in_newest_run
FROM summary, (VALUES {', '.join(f'({_q(s)})' for s in RUN_STAMPS)}) runs(stamp)""",
    "csv_roundtrip": f"""WITH {_MAPPED}
SELECT complaint_id, strftime(DATE '2024-01-01' + CAST(complaint_id % 365 AS INTEGER), '%Y-%m-%d') AS date_received,
       product_category, concat('say "', substr(narrative, 1, 5), '", ok') AS issue,
       '(none)' AS sub_issue, md5(narrative) AS narrative_md5 FROM mapped""",
    "dataset_profile": """SELECT 1 AS n_files, count(*) AS n_rows, 5 AS n_columns,
       'doc_id,text,lang,source,n_chars' AS columns FROM documents""",
    "question_source": f"WITH {_QUESTIONS} SELECT question_id AS id, category, question FROM questions",
    "ingest_manifest": f"""WITH {_PREBUILT}
SELECT count(*) AS rows_in_source_file, count(*) AS rows_ingested, count(DISTINCT id) AS final_collection_count,
       count(*) <> count(DISTINCT id) AS has_duplicate_ids,
       (SELECT array_to_string(list_sort(list(product_category || '=' || n)), ',')
        FROM (SELECT product_category, count(*) AS n FROM flat GROUP BY 1)) AS category_counts
FROM flat""",
    "ingest_limited": f"""WITH {_PREBUILT}
SELECT n AS limit_rows, (SELECT count(*) FROM flat) AS rows_in_source_file,
       least(n, (SELECT count(*) FROM flat)) AS rows_ingested
FROM (VALUES {', '.join(f'({n}::BIGINT)' for n in INGEST_LIMITS)}) limits(n)""",
    "stored_categories": f"""SELECT {_AWKWARD} AS product_category, count(*) AS n FROM embeddings GROUP BY 1""",
    "stored_filtered_search": f"""WITH {_VECTORS},
kept AS (SELECT CAST(vec_id AS VARCHAR) AS id, {_AWKWARD} AS category FROM embeddings)
SELECT concat(question_id, '/', category) AS question_id, CAST(rank AS INTEGER) AS rank, id,
       round(greatest(distance, 0.0), 6) AS distance
FROM (SELECT question_id, category, id, distance,
             row_number() OVER (PARTITION BY question_id, category ORDER BY greatest(distance, 0.0), id) AS rank
      FROM near JOIN kept USING (id) WHERE category IN ('001', '2024-01-01'))
WHERE rank <= 3""",
    "knn_many": """WITH vectors AS (
  SELECT CAST(vec_id AS VARCHAR) AS id, CAST(embedding AS DOUBLE[]) AS v,
         sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings),
asked AS (SELECT id AS question_id, list_transform(v, lambda x: CAST(x / norm AS FLOAT)::DOUBLE) AS q FROM vectors),
near AS (
  SELECT question_id, id, greatest(round(list_inner_product(q, q) + list_inner_product(v, v)
                                         - 2 * list_inner_product(q, v), 9), 0.0) AS distance
  FROM asked CROSS JOIN vectors)
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, round(abs(distance), 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, id) AS rank FROM near)
WHERE rank <= 3""",
    "failed_questions": """SELECT CAST(vec_id AS VARCHAR) AS question_id,
       'Retrieval failed: the question''s vector has 5 numbers, stored vectors have 64.' AS reject_reason
FROM embeddings WHERE vec_id % 3 = 0""",
    "id_lookup": f"""WITH {_CHUNKS}
SELECT id, complaint_id, md5(chunk_text) AS document_md5, (SELECT count(*) FROM chunked) AS n_chunks
FROM (SELECT concat(complaint_id, '_', chunk_index) AS id, * FROM chunked)
WHERE id IN ({', '.join(map(_q, LOOKED_UP))})""",
    "folder_scan": "SELECT vec_id, label FROM embeddings",
    "raw_csv_scan": """SELECT doc_id AS complaint_id,
       CASE WHEN doc_id % 7 = 0 THEN '(none)'
            ELSE strftime(DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER), '%Y-%m-%d') END AS date_received,
       source AS product, concat('company ', source) AS company, lang AS state,
       concat('say "', lang, '"') AS issue, '(none)' AS sub_issue, md5(text) AS narrative_md5,
       (SELECT count(*) FROM documents WHERE doc_id % 7 = 0) AS unreadable_dates
FROM documents""",
    "unanswered_rate": """SELECT count(*) AS n_answers,
       round(avg(CASE WHEN doc_id % 3 = 0 THEN 1.0 ELSE 0.0 END), 4) AS not_enough_rate FROM documents""",
    "filtered_retrieval": f"""WITH {_TEXT_HITS}
SELECT question_id, CAST(rank AS INTEGER) AS rank, id, product_category,
       CASE WHEN round(1 - distance, 4) = 0 THEN 0.0::DOUBLE ELSE round(1 - distance, 4) END AS similarity_score
FROM (SELECT near.question_id, id, chunked.product_category, distance,
             row_number() OVER (PARTITION BY near.question_id ORDER BY distance, id) AS rank
      FROM near JOIN chunked USING (id) JOIN questions ON questions.question_id = near.question_id
      WHERE chunked.product_category = questions.category)
WHERE rank <= 2""",
}
ORACLE_SQL["report_capped"] = ORACLE_SQL["report_rows"] + f" ORDER BY id LIMIT {REPORT_ROWS}"


def _eigenvector(matrix: str, name: str, squarings: int = 12) -> str:
    """CTEs that end in ``name`` (i, x): the unit eigenvector of the largest eigenvalue.

    The matrix is squared again and again, scaled to stay in range: every column turns into the
    eigenvector. Its largest entry is made positive.
    """
    out, last = [], matrix
    for step in range(squarings):
        out.append(
            f"{name}_p{step} AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) AS x "
            f"FROM {last} a JOIN {last} b ON a.j = b.i GROUP BY a.i, b.j)"
        )
        out.append(
            f"{name}_m{step} AS MATERIALIZED (SELECT i, j, x / (SELECT max(abs(x)) FROM {name}_p{step}) AS x "
            f"FROM {name}_p{step})"
        )
        last = f"{name}_m{step}"
    out.append(
        f"{name} AS MATERIALIZED (SELECT i, x * (SELECT sign(arg_max(x, abs(x))) FROM {last} WHERE j = best) "
        f"/ sqrt((SELECT sum(x * x) FROM {last} WHERE j = best)) AS x "
        f"FROM {last}, (SELECT arg_max(j, abs(x)) AS best FROM {last}) WHERE j = best)"
    )
    return ",\n".join(out)


ORACLE_SQL["pca_projection"] = f"""WITH entries AS MATERIALIZED (
  SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x
  FROM embeddings),
centred AS MATERIALIZED (
  SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM entries),
spread AS MATERIALIZED (
  SELECT a.i, b.i AS j, sum(a.x * b.x) AS x FROM centred a JOIN centred b USING (vec_id) GROUP BY 1, 2),
{_eigenvector('spread', 'v1')},
rest AS MATERIALIZED (
  SELECT s.i, s.j, s.x - l.x * a.x * b.x AS x
  FROM spread s JOIN v1 a ON a.i = s.i JOIN v1 b ON b.i = s.j,
       (SELECT sum(s.x * a.x * b.x) AS x FROM spread s JOIN v1 a ON a.i = s.i JOIN v1 b ON b.i = s.j) l),
{_eigenvector('rest', 'v2')}
SELECT vec_id, round(sum(p.x * v1.x), 6) AS pc1, round(sum(p.x * v2.x), 6) AS pc2
FROM centred p JOIN v1 USING (i) JOIN v2 USING (i)
GROUP BY vec_id"""

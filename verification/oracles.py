"""The registered queries written out in SQL for the checking engine.

Written from the meaning of each operator and not from its Spark plan: distances by a
full product of both tables, samples by ranking whole strata, recursive chunks by a
recursive query over cut positions.
"""

from __future__ import annotations

from narrascope.functions.text import BOILERPLATE
from narrascope.operators.grounding import PROMPT, REPORT_QUESTIONS
from narrascope.schema import CATEGORY_OF_PRODUCT, CHUNK_METADATA, COMPLAINT_COLUMNS
from verification.queries import BUDGET, CELLS, PROBES, PROMPT_BUDGET, SAMPLE, SMALL_BUDGET
from verification.tables import (
    DOCUMENT_COMPLAINTS,
    ORDER_COMPLAINTS,
    TURN_COMPLAINTS,
    TURN_QUESTIONS,
)


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _plain(sql: str) -> str:
    return sql.replace("`", '"')


def _snake(column: str) -> str:
    return column.lower().replace(" ", "_").replace("-", "_")


COMPLAINTS = "complaints AS (" + _plain(
    f"{DOCUMENT_COMPLAINTS} UNION ALL {TURN_COMPLAINTS} UNION ALL {ORDER_COMPLAINTS}"
) + ")"

_CATEGORY = (
    'CASE "Product" '
    + " ".join(f"WHEN {_quoted(p)} THEN {_quoted(c)}" for p, c in CATEGORY_OF_PRODUCT.items())
    + " END"
)
_N = '"Consumer complaint narrative"'
_ID = '"Complaint ID"'


def _clean(column: str) -> str:
    return f"""
    trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        lower(coalesce({column}, '')), 'x{{2,}}', ' ', 'g'),
        {_quoted('|'.join(BOILERPLATE))}, ' ', 'g'),
        '[^a-z0-9\\s.,!?'']', ' ', 'g'), '\\s+', ' ', 'g'))"""


FILTERED = f"""filtered AS (
    SELECT * FROM (SELECT *, {_CATEGORY} AS product_category FROM complaints)
    WHERE product_category IS NOT NULL AND regexp_matches({_N}, '\\S'))"""

CLEANED = f"""cleaned AS (
    SELECT * FROM (SELECT *, {_clean(_N)} AS cleaned_narrative FROM filtered)
    WHERE cleaned_narrative <> '')"""

BASE = f"{COMPLAINTS}, {FILTERED}, {CLEANED}"

LENGTHS = f"""lengths AS (
    SELECT len(regexp_extract_all(coalesce({_N}, ''), '\\S+')) AS n FROM complaints)"""


def _columns(*names: str) -> str:
    return ", ".join(f'"{c}" AS {_snake(c)}' for c in names)


def _quotas(source: str, group: str, n: int) -> str:
    """Quota table per group by largest remainders."""
    return f"""
    sizes AS (SELECT {group} AS g, count(*) AS size FROM {source} GROUP BY 1),
    shares AS (SELECT g, size, sum(size) OVER () AS total,
                      CAST({n} AS DOUBLE) * size / sum(size) OVER () AS raw FROM sizes),
    floors AS (SELECT *, CAST(floor(raw) AS BIGINT) AS base FROM shares),
    ranked AS (SELECT *, row_number() OVER (ORDER BY raw - base DESC, g NULLS FIRST) AS place,
                      {n} - sum(base) OVER () AS left_over FROM floors),
    quotas AS (SELECT g, size, CAST(CASE WHEN {n} >= total THEN size
                      ELSE least(base + CASE WHEN place <= left_over THEN 1 ELSE 0 END, size)
                      END AS BIGINT) AS quota FROM ranked)"""


def _sample(source: str, group: str, n: int, seed: int) -> str:
    return f"""{_quotas(source, group, n)},
    drawn AS (SELECT *, row_number() OVER (
                  PARTITION BY {group} ORDER BY md5(concat('{seed}:', {_ID}))) AS draw
              FROM {source}),
    sampled AS (SELECT drawn.* FROM drawn JOIN quotas ON {group} IS NOT DISTINCT FROM g
                WHERE draw <= quota)"""


def _fixed(source: str, size: int = 500, overlap: int = 50) -> str:
    step = size - overlap
    return f"""
    windows AS (
        SELECT *, unnest(range(0, greatest(CAST(ceil((length(cleaned_narrative) - {overlap})
               / {step}.0) AS BIGINT), 1))) AS i FROM {source}),
    pieces AS (
        SELECT *, trim(substr(cleaned_narrative, i * {step} + 1, {size})) AS text FROM windows),
    fixed AS (
        SELECT *, row_number() OVER (PARTITION BY {_ID} ORDER BY i) - 1 AS chunk_index,
               count(*) OVER (PARTITION BY {_ID}) AS total_chunks
        FROM pieces WHERE text <> ''),
    chunks AS (
        SELECT concat({_ID}, '-', chunk_index) AS chunk_id, * FROM fixed)"""


def _recursive(source: str, text: str, size: int = 500, overlap: int = 50) -> str:
    """Chunks by separators: segments level by level, then greedy merging of short pieces.

    ``active`` segments are still to be cut. A separator cuts the segments it occurs in;
    neighbouring pieces below the size form a group, other pieces stay active.
    """
    step = size - overlap
    ctes = [f"active0 AS (SELECT {_ID} AS cid, 0 AS start, {text} AS seg FROM {source})"]
    groups = []
    for level, (separator, width) in enumerate([("\\n\\n", 2), ("\\n", 1), (". ", 2), (" ", 1)]):
        s = f"E'{separator}'"
        ctes.append(f"""
        cut{level} AS (
            SELECT cid, start, unnest(parts) AS part, generate_subscripts(parts, 1) AS i
            FROM (SELECT cid, start, string_split(seg, {s}) AS parts FROM active{level}
                  WHERE contains(seg, {s}))),
        piece{level} AS (
            SELECT cid, start AS parent, i, CASE WHEN i > 1 THEN {s} || part ELSE part END AS seg,
                   start + coalesce(sum(length(part) + CASE WHEN i > 1 THEN {width} ELSE 0 END)
                       OVER (PARTITION BY cid, start ORDER BY i
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
            FROM cut{level}),
        run{level} AS (
            SELECT *, sum(CASE WHEN length(seg) >= {size} THEN 1 ELSE 0 END)
                       OVER (PARTITION BY cid, parent ORDER BY i) AS run
            FROM piece{level} WHERE seg <> ''),
        active{level + 1} AS (
            SELECT cid, start, seg FROM run{level} WHERE length(seg) >= {size}
            UNION ALL
            SELECT cid, start, seg FROM active{level} WHERE NOT contains(seg, {s}))""")
        groups.append(f"""
            SELECT cid, list_append(list(start ORDER BY start), max(start + length(seg))) AS offs
            FROM run{level} WHERE length(seg) < {size} GROUP BY cid, parent, run""")
    ctes.append(f"""
    merge_groups AS (SELECT row_number() OVER () AS gid, cid, offs
                     FROM ({' UNION ALL '.join(groups)})),
    steps AS (
        SELECT gid, cid, 1 AS first,
               len(list_filter(offs, lambda x: x <= offs[1] + {size})) AS stop
        FROM merge_groups
        UNION ALL
        SELECT gid, cid, first,
               len(list_filter(offs, lambda x: x <= offs[first] + {size})) AS stop
        FROM (
            SELECT m.gid, m.cid, m.offs,
                   len(list_filter(m.offs, lambda x: x < greatest(
                       m.offs[s.stop] - {overlap}, m.offs[s.stop + 1] - {size}))) + 1 AS first
            FROM steps s JOIN merge_groups m ON m.gid = s.gid WHERE s.stop < len(m.offs))),
    spans AS (
        SELECT s.cid, m.offs[s.first] AS a, m.offs[s.stop] AS b
        FROM steps s JOIN merge_groups m ON m.gid = s.gid
        UNION ALL
        SELECT cid, start + k * {step}, start + least(k * {step} + {size}, length(seg))
        FROM (SELECT *, unnest(range(0, greatest(CAST(ceil((length(seg) - {overlap})
              / {step}.0) AS BIGINT), 1))) AS k FROM active4)),
    texts AS (
        SELECT r.*, a, trim(substr(r.{text}, CAST(a + 1 AS BIGINT), CAST(b - a AS BIGINT)),
                            E' \\t\\n\\r') AS text
        FROM spans JOIN {source} r ON r.{_ID} = cid),
    chunks AS (
        SELECT concat({_ID}, '-', row_number() OVER (PARTITION BY {_ID} ORDER BY a) - 1) AS chunk_id,
               row_number() OVER (PARTITION BY {_ID} ORDER BY a) - 1 AS chunk_index,
               count(*) OVER (PARTITION BY {_ID}) AS total_chunks, *
        FROM texts WHERE text <> '')""")
    return ",".join(ctes)


_CHUNK_ROWS = """SELECT chunk_id, text, CAST(chunk_index AS BIGINT) AS chunk_index,
                        CAST(total_chunks AS BIGINT) AS total_chunks FROM chunks"""

RECURSIVE_STORE = f"{BASE}, {_recursive('cleaned', 'cleaned_narrative')}"


def _vectors(name: str, source: str, ident: str, text: str) -> str:
    """Non-zero places of hashed word-count vectors at unit length, in single precision."""
    return f"""
    {name}_words AS (SELECT {ident} AS id, unnest(regexp_extract_all(lower({text}), '[a-z0-9]+')) AS w
                     FROM {source}),
    {name}_counts AS (SELECT id, CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 384 AS place,
                             count(*) AS n FROM {name}_words GROUP BY 1, 2),
    {name}_places AS (SELECT id, place, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY id))
                                        AS FLOAT) AS DOUBLE) AS v FROM {name}_counts),
    {name}_norms AS (SELECT id, sqrt(sum(v * v)) AS norm FROM {name}_places GROUP BY 1)"""


VALIDATED = f"""validated AS (
    SELECT question_id, regexp_replace(question, '^\\s+|\\s+$', '', 'g') AS question,
           CASE WHEN NOT regexp_matches(question, '\\S') THEN 'Please enter a question.' END AS problem,
           CASE WHEN product_category NOT IN ('All products', '') THEN product_category END
               AS product_category
    FROM ({TURN_QUESTIONS}))"""


def _retrieval(questions: str) -> str:
    """Five nearest stored chunks of each question, by a full product of both sides."""
    return f"""{RECURSIVE_STORE},
    {_vectors('q', questions, 'question_id', 'question')},
    {_vectors('c', 'chunks', 'chunk_id', 'text')},
    dots AS (SELECT q.id AS qid, c.id AS chunk, sum(q.v * c.v) AS dot
             FROM q_places q JOIN c_places c ON q.place = c.place GROUP BY 1, 2),
    pairs AS (
        SELECT q.question_id, c.chunk_id, c.product_category, c.Issue AS issue,
               coalesce(c.Company, '') AS company, coalesce(c.State, '') AS state, c.text,
               round(1 - coalesce(dot, 0) / (qn.norm * cn.norm), 6) + 0.0 AS distance
        FROM {questions} q JOIN q_norms qn ON qn.id = q.question_id
        JOIN chunks c ON q.product_category IS NULL OR q.product_category = c.product_category
        JOIN c_norms cn ON cn.id = c.chunk_id
        LEFT JOIN dots ON dots.qid = q.question_id AND dots.chunk = c.chunk_id),
    hits AS (
        SELECT * FROM (SELECT *, row_number() OVER (
            PARTITION BY question_id ORDER BY distance, chunk_id) AS rank FROM pairs)
        WHERE rank <= 5)"""


_GOOD = "good AS (SELECT * FROM validated WHERE problem IS NULL)"
_CONTEXTS = """contexts AS (
    SELECT question_id, string_agg(concat(rank, '. [', product_category, ' | ', issue, '] ', text),
                                   E'\\n' ORDER BY rank) AS context FROM hits GROUP BY 1)"""
RETRIEVED = f"{VALIDATED}, {_GOOD}, {_retrieval('good')}"
_HEAD, _REST = PROMPT.replace("{company}", "the company").split("{context}")
_MIDDLE, _TAIL = _REST.split("{question}")


def _prompt(context: str, question: str) -> str:
    return (
        f"concat({_quoted(_HEAD)}, {context}, {_quoted(_MIDDLE)}, {question}, {_quoted(_TAIL)})"
    )


_ANSWER = (
    "CASE WHEN context IS NULL THEN 'I don''t have enough information.' ELSE concat("
    f"'The prompt | has ', length({_prompt('context', 'question')}), ' characters.') END"
)


def _short(column: str, n: int) -> str:
    line = f"trim(regexp_replace({column}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN length({line}) > {n} THEN concat(substr({line}, 1, {n}), '…') ELSE {line} END"


_W, _WS = "[^ \\t\\n\\x0b\\f\\r]", "[ \\t\\n\\x0b\\f\\r]"


def _tokens(text: str) -> str:
    """Pieces of two characters of all words."""
    return f"coalesce(list_sum(list_transform(regexp_extract_all({text}, '{_W}+'), lambda w: (length(w) + 1) // 2)), 0)"


def _knn(k: int, condition: str = "true") -> str:
    return f"""hits AS (
    SELECT * FROM (
        SELECT question_id, chunk_id, distance, row_number() OVER (
                   PARTITION BY question_id ORDER BY distance, chunk_id) AS rank
        FROM (SELECT q.vec_id AS question_id, c.vec_id AS chunk_id,
                     round(1 - list_cosine_similarity(CAST(q.embedding AS DOUBLE[]),
                                                      CAST(c.embedding AS DOUBLE[])), 6) + 0.0 AS distance
              FROM embeddings q JOIN embeddings c ON {condition}))
    WHERE rank <= {k})"""


_HITS = "SELECT question_id, rank, chunk_id, distance FROM hits"
_SUMMARY = """count(*) AS count, round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
    CAST(min(n) AS BIGINT) AS min, round(quantile_cont(n, 0.25), 6) AS p25,
    round(quantile_cont(n, 0.5), 6) AS median, round(quantile_cont(n, 0.75), 6) AS p75"""
_DOCUMENT_CHUNKS = f"""WITH complaints AS ({_plain(DOCUMENT_COMPLAINTS)}),
    {FILTERED}, {CLEANED}, {_fixed('cleaned')}"""

ORACLES: dict[str, str] = {
    "product_distribution": f"""WITH {COMPLAINTS}
        SELECT "Product" AS product, count(*) AS count FROM complaints GROUP BY 1""",
    "top_products": f"""WITH {COMPLAINTS}
        SELECT "Product" AS product, count(*) AS count FROM complaints GROUP BY 1
        ORDER BY 2 DESC, 1 NULLS LAST LIMIT 3""",
    "category_counts": f"""WITH {COMPLAINTS}, {FILTERED}
        SELECT product_category, count(*) AS count FROM filtered GROUP BY 1""",
    "category_share": f"""WITH {COMPLAINTS}, {FILTERED}
        SELECT product_category, count(*) AS count,
               round(count(*) / (SELECT count(*) FROM filtered), 6) AS share
        FROM filtered GROUP BY 1""",
    "label_cardinality": f"""WITH {COMPLAINTS}
        SELECT count(DISTINCT "Product") AS labels FROM complaints""",
    "frame_shape": f"""WITH {COMPLAINTS}
        SELECT count(*) AS rows, CAST({len(COMPLAINT_COLUMNS)} AS BIGINT) AS columns FROM complaints""",
    "narrative_presence": f"""WITH {COMPLAINTS}
        SELECT count(*) FILTER (regexp_matches({_N}, '\\S')) AS with_narrative,
               count(*) FILTER (NOT coalesce(regexp_matches({_N}, '\\S'), false)) AS without_narrative
        FROM complaints""",
    "narrative_length": f"""WITH {COMPLAINTS}
        SELECT {_ID} AS complaint_id,
               len(regexp_extract_all(coalesce({_N}, ''), '\\S+')) AS narrative_word_count
        FROM complaints""",
    "length_summary": f"""WITH {COMPLAINTS}, {LENGTHS}
        SELECT {_SUMMARY},
               round(quantile_cont(n, 0.75) - quantile_cont(n, 0.25), 6) AS iqr,
               round(quantile_cont(n, 0.95), 6) AS p95, CAST(max(n) AS BIGINT) AS max
        FROM lengths WHERE n > 0""",
    "length_describe": f"""WITH {COMPLAINTS}, {LENGTHS}
        SELECT count(*) AS count, CAST(0 AS BIGINT) AS null_count, round(avg(n), 6) AS mean,
               round(stddev_samp(n), 6) AS std, CAST(min(n) AS BIGINT) AS min,
               CAST(list_sort(list(n))[CAST(round(0.25 * (count(*) - 1)) AS BIGINT) + 1] AS BIGINT) AS p25,
               CAST(list_sort(list(n))[CAST(round(0.5 * (count(*) - 1)) AS BIGINT) + 1] AS BIGINT) AS p50,
               CAST(list_sort(list(n))[CAST(round(0.75 * (count(*) - 1)) AS BIGINT) + 1] AS BIGINT) AS p75,
               CAST(max(n) AS BIGINT) AS max
        FROM lengths""",
    "length_histogram": f"""WITH {COMPLAINTS}, {LENGTHS},
        bounds AS (SELECT min(n) AS low, (max(n) - min(n)) / 60.0::DOUBLE AS width
                   FROM lengths WHERE n > 0),
        placed AS (SELECT least(CAST(floor((n - low) / width) AS BIGINT), 59) AS bin, low, width
                   FROM lengths, bounds WHERE n > 0)
        SELECT bin, round(low + bin * width, 6) AS lower, count(*) AS complaints
        FROM placed GROUP BY bin, low, width""",
    "length_bands": f"""WITH {COMPLAINTS}, {LENGTHS}
        SELECT count(*) AS narratives, count(*) FILTER (n < 5) AS very_short,
               count(*) FILTER (n < 20) AS short, count(*) FILTER (n > 300) AS long,
               count(*) FILTER (n > 1000) AS very_long,
               round(count(*) FILTER (n < 20) / count(*), 6) AS short_share,
               round(count(*) FILTER (n > 300) / count(*), 6) AS long_share
        FROM lengths WHERE n > 0""",
    "filter_complaints": f"""WITH {COMPLAINTS}, {FILTERED}
        SELECT {_columns(*COMPLAINT_COLUMNS, 'product_category')} FROM filtered""",
    "clean_narratives": f"""WITH {BASE}
        SELECT {_ID} AS complaint_id, product_category, cleaned_narrative FROM cleaned""",
    "clean_documents": f"""SELECT * FROM (
        SELECT doc_id, {_clean('text')} AS cleaned_narrative FROM documents)
        WHERE cleaned_narrative <> ''""",
    "clean_preview": f"""WITH {BASE}
        SELECT {_ID} AS complaint_id, substr({_N}, 1, 300) AS raw,
               substr(cleaned_narrative, 1, 300) AS cleaned
        FROM cleaned ORDER BY {_ID} LIMIT 5""",
    "stage_counts": f"""WITH {BASE},
        groups AS (SELECT DISTINCT {_CATEGORY} AS product_category FROM complaints),
        staged AS (
            SELECT {_CATEGORY} AS product_category, 'raw' AS stage FROM complaints
            UNION ALL SELECT {_CATEGORY}, 'mapped' FROM complaints WHERE {_CATEGORY} IS NOT NULL
            UNION ALL SELECT product_category, 'narrative' FROM filtered
            UNION ALL SELECT product_category, 'cleaned' FROM cleaned)
        SELECT g.product_category, s.stage, count(t.stage) AS complaints
        FROM groups g CROSS JOIN (VALUES ('raw'), ('mapped'), ('narrative'), ('cleaned')) s(stage)
        LEFT JOIN staged t ON t.stage = s.stage
             AND t.product_category IS NOT DISTINCT FROM g.product_category
        GROUP BY 1, 2""",
    "sample_quotas": f"""WITH {BASE}, {_quotas('cleaned', 'product_category', SAMPLE)}
        SELECT g AS product_category, size, quota FROM quotas""",
    "sample_quotas_by_label": f"""WITH {COMPLAINTS}, {_quotas('complaints', '"Product"', SAMPLE)}
        SELECT g AS product, size, quota FROM quotas""",
    "stratified_sample": f"""WITH {BASE}, {_sample('cleaned', 'product_category', SAMPLE, 42)}
        SELECT {_ID} AS complaint_id, product_category, cleaned_narrative FROM sampled""",
    "stratified_sample_by_label": f"""WITH {COMPLAINTS},
        {_sample('complaints', '"Product"', SAMPLE, 7)}
        SELECT {_ID} AS complaint_id, "Product" AS product FROM sampled""",
    "sample_all_rows": f"""WITH {BASE} SELECT {_ID} AS complaint_id, product_category FROM cleaned""",
    "sample_ordered": f"""WITH {BASE}, {_sample('cleaned', 'product_category', SAMPLE, 42)}
        SELECT {_ID} AS complaint_id, product_category, draw AS place FROM sampled""",
    "sample_balance": f"""WITH {BASE}, {_sample('cleaned', 'product_category', SAMPLE, 42)}
        SELECT 'before' AS stage, product_category, count(*) AS complaints,
               round(count(*) / (SELECT count(*) FROM cleaned), 6) AS share
        FROM cleaned GROUP BY 2
        UNION ALL
        SELECT 'after', product_category, count(*),
               round(count(*) / (SELECT count(*) FROM sampled), 6)
        FROM sampled GROUP BY 2""",
    "chunk_fixed": f"WITH {BASE}, {_fixed('cleaned')} {_CHUNK_ROWS}",
    "chunk_recursive": f"WITH RECURSIVE {RECURSIVE_STORE} {_CHUNK_ROWS}",
    "chunk_recursive_lines": f"""WITH RECURSIVE {COMPLAINTS}, {FILTERED},
        narratives AS (SELECT {_ID}, {_N} AS narrative FROM filtered),
        {_recursive('narratives', 'narrative', 200, 40)} {_CHUNK_ROWS}""",
    "chunk_metadata": f"""WITH {BASE}, {_fixed('cleaned')}
        SELECT chunk_id, {', '.join(f'''coalesce("{s}", '') AS {m}''' for m, s in CHUNK_METADATA.items())}
        FROM chunks""",
    "chunk_stats": f"""WITH RECURSIVE {RECURSIVE_STORE}
        SELECT count(*) AS chunks, count(DISTINCT {_ID}) AS complaints,
               round(count(*) / count(DISTINCT {_ID}), 6) AS chunks_per_complaint,
               round(avg(length(text)), 6) AS mean_length,
               round(quantile_cont(length(text), 0.5), 6) AS median_length
        FROM chunks""",
    "chunk_trace": f"""WITH {BASE}, {_fixed('cleaned')}
        SELECT chunk_id, "Sub-product" AS sub_product, length({_N}) AS narrative_length FROM chunks""",
    "embed_index": f"""WITH RECURSIVE {RECURSIVE_STORE}, {_vectors('c', 'chunks', 'chunk_id', 'text')}
        SELECT chunk_id, product_category, CAST(384 AS BIGINT) AS dim, count(v) AS filled,
               round(coalesce(sum(v * (place + 1)), 0), 4) AS signature
        FROM chunks LEFT JOIN c_places ON id = chunk_id GROUP BY 1, 2""",
    "prebuilt_store": f"{_DOCUMENT_CHUNKS} SELECT chunk_id, text, CAST(384 AS BIGINT) AS dim FROM chunks",
    "knn_exact": f"WITH {_knn(5)} {_HITS}",
    "knn_blocks": f"WITH {_knn(5)} {_HITS}",
    "knn_ivf_all_cells": f"WITH {_knn(5)} {_HITS}",
    "knn_ivf_trained": f"WITH {_knn(5)} {_HITS}",
    "knn_ivf": f"""WITH near AS (
            SELECT v.vec_id, c.vec_id AS cell, row_number() OVER (PARTITION BY v.vec_id ORDER BY
                       list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) DESC,
                       c.vec_id) AS place
            FROM embeddings v JOIN embeddings c ON c.vec_id < {CELLS}),
        {_knn(5, f"EXISTS (SELECT 1 FROM near a JOIN near b ON a.cell = b.cell WHERE a.vec_id = q.vec_id AND a.place <= {PROBES} AND b.vec_id = c.vec_id AND b.place = 1)")} {_HITS}""",
    "knn_filtered": f"WITH {_knn(3, 'q.label = c.label')} {_HITS}",
    "knn_by_metadata": f"""WITH {_knn(3, '(q.vec_id % 2 <> 0 OR q.label = c.label) AND (q.vec_id % 5 <> 0 OR q.vec_id % 3 = c.vec_id % 3)')} {_HITS}""",
    "knn_join_text": f"""WITH {_knn(2)}
        SELECT question_id, rank, chunk_id, source, text FROM hits JOIN documents ON doc_id = chunk_id""",
    "retrieve_chunks": f"""WITH RECURSIVE {RETRIEVED}
        SELECT question_id, rank, chunk_id, distance, product_category,
               substr(text, 1, 120) AS excerpt FROM hits""",
    "validated_questions": f"""WITH {VALIDATED}
        SELECT question_id, question, problem, product_category FROM validated""",
    "context_block": f"""WITH RECURSIVE {RETRIEVED}, {_CONTEXTS}
        SELECT question_id, coalesce(context, '') AS context FROM good LEFT JOIN contexts USING (question_id)""",
    "prompt": f"""WITH RECURSIVE {RETRIEVED}, {_CONTEXTS}
        SELECT question_id, {_prompt("coalesce(context, '')", 'question')} AS prompt
        FROM good LEFT JOIN contexts USING (question_id)""",
    "context_budget": f"""WITH RECURSIVE {RETRIEVED},
        running AS (SELECT question_id, rank, chunk_id, CAST(sum(length(text)) OVER (
            PARTITION BY question_id ORDER BY rank) AS BIGINT) AS used FROM hits)
        SELECT * FROM running WHERE used <= {BUDGET}""",
    "question_sources": f"""WITH RECURSIVE {RETRIEVED}
        SELECT question_id, string_agg(chunk_id, ' ' ORDER BY rank) AS chunk_ids FROM hits GROUP BY 1""",
    "answer_fallback": f"""WITH RECURSIVE {RETRIEVED}, {_CONTEXTS}
        SELECT question_id, question, coalesce(problem, {_ANSWER}) AS answer
        FROM validated LEFT JOIN contexts USING (question_id)""",
    "answer_within_budget": f"""WITH RECURSIVE {RETRIEVED},
        running AS (SELECT *, sum(length(text)) OVER (PARTITION BY question_id ORDER BY rank) AS used FROM hits),
        fitting AS (SELECT * REPLACE (CASE WHEN used > {SMALL_BUDGET}
                        THEN substr(text, 1, CAST(floor(length(text) * {SMALL_BUDGET} / used) AS INT)) ELSE text END AS text)
                    FROM running WHERE used <= {SMALL_BUDGET} OR rank = 1),
        {_CONTEXTS.replace('FROM hits', 'FROM fitting')}
        SELECT question_id, question, coalesce(problem, {_ANSWER}) AS answer
        FROM validated LEFT JOIN contexts USING (question_id)""",
    "context_missing_metadata": f"""WITH RECURSIVE {RETRIEVED}
        SELECT question_id, string_agg(concat(rank, '. [',
                   CASE WHEN length(chunk_id) % 2 = 0 THEN '?' ELSE product_category END, ' | ',
                   CASE WHEN length(chunk_id) % 2 = 0 THEN issue ELSE '?' END, '] ', text),
                   E'\\n' ORDER BY rank) AS context FROM hits GROUP BY 1""",
    "source_cards": f"""WITH RECURSIVE {RETRIEVED}, {_CONTEXTS},
        cards AS (SELECT question_id, string_agg(concat(
            '**Source ', rank, '** — ', product_category, ' · ', issue, ' · ', company, ' (', state,
            E')\\n\\n> ', text), E'\\n\\n---\\n\\n' ORDER BY rank) AS cards FROM hits GROUP BY 1)
        SELECT question_id, coalesce(problem, {_ANSWER}) AS answer,
               coalesce(cards, '_No sources retrieved._') AS cards
        FROM validated LEFT JOIN contexts USING (question_id) LEFT JOIN cards USING (question_id)""",
    "eval_report": f"""WITH RECURSIVE asked(question_id, question, product_category) AS (VALUES
            {', '.join(f"({i}, {_quoted(q)}, CAST(NULL AS VARCHAR))" for i, q in enumerate(REPORT_QUESTIONS, 1))}),
        {_retrieval('asked')}, {_CONTEXTS},
        top AS (SELECT question_id, string_agg(concat('[', product_category, ' / ', issue, '] ',
                       {_short('text', 90)}), '<br>' ORDER BY rank) AS tops
                FROM hits WHERE rank <= 2 GROUP BY 1)
        SELECT CAST(question_id AS BIGINT) AS n, question,
               replace({_short(_ANSWER, 200)}, '|', '\\|') AS answer,
               replace(coalesce(tops, '(none)'), '|', '\\|') AS top_sources,
               CAST(NULL AS BIGINT) AS score, CAST(NULL AS VARCHAR) AS comments
        FROM asked LEFT JOIN contexts USING (question_id) LEFT JOIN top USING (question_id)""",
    "run_stats": f"""WITH RECURSIVE {BASE}, {_sample('cleaned', 'product_category', SAMPLE, 42)},
        {_recursive('sampled', 'cleaned_narrative')}
        SELECT (SELECT count(*) FROM sampled) AS sampled_complaints, count(*) AS chunks,
               count(*) AS indexed, true AS persisted FROM chunks""",
    "preprocess_job": f"""WITH {BASE}
        SELECT {_ID} AS complaint_id, product_category, cleaned_narrative FROM cleaned""",
    "parquet_cache_roundtrip": f"""WITH {COMPLAINTS}
        SELECT {_columns(*COMPLAINT_COLUMNS)} FROM complaints""",
    "large_csv_scan": f"""WITH {COMPLAINTS}
        SELECT {_columns(*COMPLAINT_COLUMNS)} FROM complaints""",
    "cleaned_csv_roundtrip": f"""WITH {BASE}
        SELECT {_columns(*COMPLAINT_COLUMNS, 'product_category', 'cleaned_narrative')} FROM cleaned""",
    "stream_clean_chunk": f"{_DOCUMENT_CHUNKS} {_CHUNK_ROWS}",
    "standing_answers": f"WITH {_knn(5)} {_HITS}",
    "prompt_token_budget": f"""WITH RECURSIVE {RETRIEVED}, {_CONTEXTS},
        asked AS (SELECT question_id, question, coalesce(context, '') AS context
                  FROM good LEFT JOIN contexts USING (question_id)),
        parts AS (SELECT question_id, {_tokens(_prompt("''", 'question'))} AS others,
                         unnest(regexp_extract_all(context, '{_WS}*{_W}+')) AS word,
                         generate_subscripts(regexp_extract_all(context, '{_WS}*{_W}+'), 1) AS place
                  FROM asked),
        counted AS (SELECT *, others + sum({_tokens('word')}) OVER (PARTITION BY question_id ORDER BY place) AS used FROM parts),
        totals AS (SELECT question_id, max(used) AS used FROM counted GROUP BY 1),
        cut AS (SELECT question_id, string_agg(word, '' ORDER BY place) AS context FROM counted
                WHERE used <= {PROMPT_BUDGET} GROUP BY 1)
        SELECT question_id, {_prompt(f"CASE WHEN coalesce(t.used, 0) <= {PROMPT_BUDGET} THEN a.context ELSE coalesce(c.context, '') END", 'question')} AS prompt
        FROM asked a LEFT JOIN totals t USING (question_id) LEFT JOIN cut c USING (question_id)""",
    "broken_csv_scan": f"""WITH {COMPLAINTS}
        SELECT {_ID} AS complaint_id, {_ID} LIKE '%7' AS corrupt,
               CASE WHEN {_ID} NOT LIKE '%7' THEN coalesce({_N}, '') END AS narrative FROM complaints""",
    "csv_stream": f"""WITH {COMPLAINTS}
        SELECT {_columns(*COMPLAINT_COLUMNS)} FROM complaints""",
    "updated_store": f"{_DOCUMENT_CHUNKS} SELECT chunk_id, text, CAST(384 AS BIGINT) AS dim FROM chunks",
    "running_counts": f"""WITH {COMPLAINTS}, {LENGTHS}
        SELECT 'product' AS statistic, "Product" AS label, CAST(NULL AS BIGINT) AS words, count(*) AS rows FROM complaints GROUP BY 2
        UNION ALL SELECT 'narrative', CASE WHEN regexp_matches(coalesce({_N}, ''), '\\S') THEN 'true' ELSE 'false' END, NULL, count(*)
        FROM complaints GROUP BY 2
        UNION ALL SELECT 'length', NULL, n, count(*) FROM lengths GROUP BY 3""",
}
for _name in ("running_sample", "one_scan_sample"):
    ORACLES[_name] = ORACLES["stratified_sample"]

r"""DuckDB SQL of the queries that SQL can express.

Not expressible, and tested against brute force instead: op1 (merges until none is left), op4 and op6 (seeded hashes), op5 and op10 (spans and
cutoffs of the method), op7, op8 and op13 (learned models), op9 (the ring), op12 (two tokenizers), the pipeline over them.
"""

_TURNS = r"""
turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL
    SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)"""
_ESCAPED = r"regexp_replace({}, '(\\|{}###|</turn>)', '\\\1', 'g')"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERMS = rf"""regexp_extract_all(translate(coalesce(text, ''), '{_LETTERS}', '{_LETTERS.lower()}'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op2_chat": f"""WITH {_TURNS}
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length('### ' || {_ESCAPED.format('role', ':|')} || ': ' || {_ESCAPED.format('text', '')} || ' </turn>' || chr(10)))::BIGINT AS formatted_chars
        FROM turns GROUP BY conv_id""",
    "op3_nearest": """WITH usable AS (
            SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
            FROM usable q JOIN usable c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20""",
    "op11_lexical_search": rf"""WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
        tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
        lengths AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0),
        sizes AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
        asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM tf WHERE term IN (SELECT term FROM asked) GROUP BY term), sizes
        ),
        scores AS (
            SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN lengths USING (r), sizes GROUP BY item_id, r, doc_id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 10""",
}

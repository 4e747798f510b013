"""The same queries in SQL, where SQL can say them."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

EMBEDDINGS = """
    WITH RECURSIVE e AS (
        SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b
        ON a.label = b.label AND a.vec_id <> b.vec_id
           AND list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) >= 0.93
    ),
    reached(id, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT e.b, reached.c FROM reached JOIN e ON reached.id = e.a),
    n AS (SELECT a, count(*) AS links FROM e GROUP BY a)
    SELECT id AS vec_id, CAST(coalesce(max(links), 0) AS BIGINT) AS n_links, min(c) AS component_id, id = min(c) AS kept
    FROM reached LEFT JOIN n ON id = a GROUP BY id"""

_SECTIONS = "list_transform(string_split({0}, E'\\n\\n'), lambda s: list_transform(string_split(s, E'\\n'), lambda p: md5(p)))"
_LEAVES = (
    "list_distinct(list_transform(string_split(regexp_replace({0}, '([^\\pL\\pN \\t\\n\\f\\r])[ \\t\\n\\f\\r]+', E'\\\\1\\n', 'g'), E'\\n'),"
    " lambda x: substr(md5(x), 1, 16)))"
)

def _print(tree: str, text: str) -> str:
    """The codes stand in the order in which clauses first occur."""
    clauses = f"list_transform(string_split(regexp_replace({text}, '([^\\pL\\pN \\t\\n\\f\\r])[ \\t\\n\\f\\r]+', E'\\\\1\\n', 'g'), E'\\n'), lambda x: substr(md5(x), 1, 16))"
    first = f"list_filter({clauses}, lambda x, i: list_position({clauses}, x) = i)"
    return (
        f"md5(array_to_string(list_transform({tree}, lambda s: md5(array_to_string(s, ','))), ';')) || '/' || "
        f"array_to_string(list_transform({tree}, lambda s: substr(md5(array_to_string(s, ',')), 1, 8)), '.') || '/' || "
        f"array_to_string(list_transform({first}, lambda x: substr(x, 1, 6)), '')"
    )


def _likeness(a: str, b: str) -> str:
    both = f"len(list_intersect({a}, {b}))"
    return f"{both} / (len({a}) + len({b}) - {both})::DOUBLE"


FINGERPRINTS = f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    n AS (
        SELECT doc_id, text, length(text) AS n_chars, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS other FROM d
    ),
    e AS (SELECT *, left(text, n_chars - n_chars // 2) || left(other, n_chars // 2) AS edited FROM n),
    t AS (
        SELECT *, {_LEAVES.format("text")} AS a, {_LEAVES.format("edited")} AS b, {_LEAVES.format("other")} AS c,
               {_SECTIONS.format("text")} AS ta, {_SECTIONS.format("edited")} AS tb FROM e
    )
    SELECT doc_id, CAST(n_chars AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, {_print("ta", "text")} AS fingerprint,
           {_print("tb", "edited")} AS edited_fingerprint, {_likeness("a", "b")} AS near_edited, {_likeness("a", "c")} AS near_next,
           CAST(coalesce(list_sum(list_transform(range(1, greatest(len(ta), len(tb)) + 1), lambda i: CASE
               WHEN ta[i] IS NOT DISTINCT FROM tb[i] THEN 0
               ELSE len(list_filter(range(1, greatest(coalesce(len(ta[i]), 0), coalesce(len(tb[i]), 0)) + 1),
                                    lambda j: ta[i][j] IS DISTINCT FROM tb[i][j])) END)), 0) AS INTEGER) AS n_edited_paragraphs
    FROM t"""


def _level(level: int, inner: str) -> str:
    return f"""
        SELECT source, block, copy, shard * 2 + CAST(rank * 2 > n AS INTEGER) AS shard FROM (
            SELECT *, row_number() OVER (PARTITION BY shard ORDER BY draw, source, block, copy) AS rank, count(*) OVER (PARTITION BY shard) AS n
            FROM (SELECT *, md5('17|{level}|' || coalesce(source, '') || '|' || block || '|' || copy) AS draw FROM ({inner}))
        )"""


MIXING = f"""
    WITH d AS (
        SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
               CAST('0x' || substr(md5('17|' || doc_id || '|' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS perm FROM documents
    ),
    s AS (
        SELECT source, sum(size) AS source_size, 3.0::DOUBLE * sum(size) AS cap,
               CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w FROM d GROUP BY source
    ),
    o AS (
        SELECT *, sum(source_size) OVER () AS total, sum(cap) OVER (ORDER BY cap / w, source) - cap AS capped,
               sum(w) OVER () - sum(w) OVER (ORDER BY cap / w, source) + w AS open FROM s
    ),
    u AS (SELECT arg_min((total - capped) / open, cap / w) FILTER (WHERE cap / w >= (total - capped) / open) AS unit FROM o),
    t AS (
        SELECT source, CAST(source_size AS BIGINT) AS source_size, least(cap, w * coalesce(unit, 1e300)) AS target,
               CASE WHEN source_size > 0 THEN floor(least(cap, w * coalesce(unit, 1e300)) / source_size + 1e-9) ELSE 0 END AS full_ FROM s, u
    ),
    r AS (
        SELECT d.source, perm, target - full_ * source_size AS rest, sum(size) OVER (PARTITION BY d.source ORDER BY perm) AS cum
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ),
    cut AS (
        SELECT source, CASE WHEN min(abs(rest - cum)) < any_value(rest) THEN arg_min(perm, {{'m': abs(rest - cum), 'p': perm}}) ELSE -1 END AS cut
        FROM r GROUP BY source
    ),
    k AS (
        SELECT doc_id, d.source, size, source_size, target, perm >> 52 AS block, CAST(full_ + CASE WHEN perm <= cut THEN 1 ELSE 0 END AS INTEGER) AS copies
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
    ),
    b AS (
        SELECT source, block, unnest(range(1, copies + 1)) AS copy, 0 AS shard FROM (SELECT source, block, max(copies) AS copies FROM k GROUP BY ALL)
    ),
    dealt AS ({_level(2, _level(1, _level(0, "SELECT * FROM b")))}),
    there AS (SELECT source, block, list(CAST(shard AS INTEGER) ORDER BY copy) AS there FROM dealt GROUP BY ALL)
    SELECT doc_id, size, source_size, target, size * copies AS taken, copies, coalesce(there[1:copies], []) AS shards
    FROM k LEFT JOIN there ON k.source IS NOT DISTINCT FROM there.source AND k.block = there.block"""

LINES = """
    WITH l AS (
        SELECT doc_id, CAST(unnest(range(0, len(x))) AS INTEGER) AS line, unnest(x) AS content
        FROM (SELECT doc_id, string_split(coalesce(text, ''), E'\\n') AS x FROM documents)
    ),
    c AS (SELECT content, min({'d': doc_id, 'l': line}) AS first_ FROM l WHERE length(content) >= 80 GROUP BY content),
    later AS (
        SELECT DISTINCT b.content FROM c a JOIN c b ON length(a.content) BETWEEN length(b.content) - 2 AND length(b.content) + 2
        AND a.first_ < b.first_ AND levenshtein(a.content, b.content) <= 2
    ),
    out_ AS (
        SELECT doc_id, list(line ORDER BY line) AS dropped FROM l JOIN c USING (content)
        WHERE first_ <> {'d': doc_id, 'l': line} OR content IN (SELECT content FROM later) GROUP BY doc_id
    )
    SELECT doc_id, CAST(n AS INTEGER) AS n_lines, CAST(coalesce(len(dropped), 0) AS INTEGER) AS n_dropped, coalesce(dropped, []) AS dropped
    FROM (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id) LEFT JOIN out_ USING (doc_id)"""

JACCARD = f"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{WORD}') AS w FROM documents
    ),
    s AS (
        SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                                            WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x FROM w
    ),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    e AS (
        SELECT a, b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q USING (x) WHERE p.doc_id <> q.doc_id GROUP BY ALL)
        JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * k >= 90 * (na.n + nb.n - k)
    ),
    reached(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, reached.c FROM reached JOIN e ON reached.id = e.a)
    SELECT id AS doc_id, CAST(coalesce(max(n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id
    FROM reached LEFT JOIN n ON id = n.doc_id GROUP BY id"""

#: Hashes of sharding, fitted classifiers, keyed surrogates and tokenizers are not SQL; tests/llm compares those.
SQL: dict[str, str] = {
    "op1_embedding_near_dedup": EMBEDDINGS,
    "op3_document_fingerprints": FINGERPRINTS,
    "op4_source_mixing": MIXING,
    "op8_line_dedup": LINES,
    "op10_ngram_jaccard": JACCARD,
}

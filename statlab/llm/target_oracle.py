"""Decontamination and resampling in SQL; eigenvectors are not SQL, tests/llm compares the whitening."""

from __future__ import annotations

from statlab.llm.alnum import ALNUM

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{ALNUM}')"

CONTAMINATION = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(len(w), 10) AS n FROM (SELECT item_id, {_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    v AS (
        SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)
    ),
    p AS (
        SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM v) WHERE len(w) >= n)
    ),
    m AS (SELECT doc_id, n, i, item FROM p JOIN v USING (n, phrase)),
    h AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM m) GROUP BY doc_id),
    t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

# The checksum byte by byte, from a table of what each byte's eight bits do.
_TABLE = "list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"
_BYTES = "list_transform(range(0, octet_length(encode(f))), lambda i: CAST('0x' || substr(hex(encode(f)), 2 * i + 1, 2) AS BIGINT))"


def _features(rows: str) -> str:
    return f"""SELECT id, n_words, unnest(list_concat(w, list_concat(
            list_transform(range(1, n_words), lambda i: w[i] || ' ' || w[i + 1]),
            list_transform(range(1, n_words - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f
        FROM (SELECT id, w, len(w) AS n_words FROM (SELECT id, {_WORDS} AS w FROM ({rows})))"""


RESAMPLING = f"""
    WITH t AS (SELECT {_TABLE} AS byte),
    df AS ({_features("SELECT doc_id AS id, text FROM documents")}),
    bf AS ({_features("SELECT item_id AS id, text FROM benchmark")}),
    k AS (
        SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, {_BYTES}), lambda c, b: xor(c >> 8, byte[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) % 10000 AS bucket
        FROM (SELECT f FROM df UNION SELECT f FROM bf), t
    ),
    s AS (SELECT bucket, count(*) AS n FROM df JOIN k USING (f) GROUP BY bucket),
    g AS (SELECT bucket, count(*) AS n FROM bf JOIN k USING (f) GROUP BY bucket),
    both_ AS (SELECT (SELECT count(*) FROM df) + 10000 AS sn, (SELECT count(*) FROM bf) + 10000 AS tn),
    gain AS (
        SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(g.n, 0) AS DOUBLE) + 1) * sn / ((CAST(s.n AS DOUBLE) + 1) * tn))) AS BIGINT) AS gain
        FROM s LEFT JOIN g USING (bucket), both_
    ),
    w AS (SELECT id, count(*) AS n_features, sum(gain) AS weight FROM df JOIN k USING (f) JOIN gain USING (bucket) GROUP BY id),
    x AS (
        SELECT doc_id, len({_WORDS}) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
               CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
        FROM documents LEFT JOIN w ON doc_id = id
    ),
    r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM x WHERE n_words >= 20)
    SELECT doc_id, n_features, weight, score, CAST(rank AS BIGINT) AS rank, CAST(n_words AS BIGINT) AS n_words
    FROM x LEFT JOIN (SELECT * FROM r WHERE rank <= 5 * n // 100) USING (doc_id)"""

SQL: dict[str, str] = {"op11_benchmark_decontamination": CONTAMINATION, "op13_target_resampling": RESAMPLING}

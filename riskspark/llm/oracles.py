"""DuckDB SQL for the queries that SQL can express, from their definitions."""

from __future__ import annotations

from .maxscore import BEST
from .ngram_join import PERCENT, WIDTH
from .recompression import WINDOW
from .threshold import NEAREST, QUERY_STEP, SCALE

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, run: int) -> str:
    """docs (doc_id, n) and w (doc_id, n, p, word, run): each word with the run of words from it on."""
    return f"""
WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({text}, '{_WORD}') AS ws FROM documents WHERE doc_id IS NOT NULL),
docs AS (SELECT doc_id, len(ws) AS n, ws FROM split),
single AS (SELECT doc_id, n, unnest(ws) AS word, unnest(range(1, n + 1)) AS p FROM docs),
w AS (SELECT doc_id, n, p, word, string_agg(word, ' ') OVER (
        PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {run - 1} FOLLOWING) AS run FROM single)"""


DEDUP = _words("coalesce(text, '')", WINDOW) + f""",
repeated AS (SELECT doc_id, p FROM (
    SELECT doc_id, p, min(doc_id) OVER (PARTITION BY run) AS first FROM w WHERE p + {WINDOW - 1} <= n) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, p + i AS p FROM repeated, range({WINDOW}) AS r(i)),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
         FROM w ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_words, d.n - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)"""

JOIN = _words(_LOWER, WIDTH) + f""",
s AS (SELECT DISTINCT doc_id, run FROM w WHERE p + {WIDTH - 1} <= n OR (n < {WIDTH} AND p = 1)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.run = b.run AND a.doc_id <> b.doc_id
           GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
         WHERE 100 * i >= {PERCENT} * (x.n + y.n - i)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs
    UNION SELECT link.b, reach.other FROM reach JOIN link ON link.a = reach.doc_id)
SELECT d.doc_id, coalesce(any_value(size.n), 0) AS n_shingles, min(reach.other) AS component_id
FROM docs d LEFT JOIN size USING (doc_id) JOIN reach USING (doc_id) GROUP BY d.doc_id"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

LEXICAL = f"""
WITH d AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents WHERE doc_id IS NOT NULL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM n),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, total GROUP BY term),
impact AS (SELECT p.doc_id, p.term,
        w.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n.n * total.docs) // total.terms))) AS x
    FROM p JOIN w USING (term) JOIN n USING (doc_id), total),
s AS (SELECT item_id, doc_id, sum(x)::BIGINT AS score FROM q JOIN impact USING (term) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= {BEST}"""

INNER = f"""
WITH v AS (SELECT vec_id, [floor(x::DOUBLE * {SCALE})::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
one AS (SELECT vec_id, min(v) AS v FROM v GROUP BY vec_id),
x AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM one),
s AS (SELECT q.vec_id AS query_id, x.vec_id, sum(q.x * x.x)::BIGINT AS score
    FROM x q JOIN x ON x.i = q.i AND x.vec_id <> q.vec_id WHERE q.vec_id % {QUERY_STEP} = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {NEAREST}"""

ORACLES = {"op8_substring_dedup": DEDUP, "op9_ngram_join": JOIN, "op11_pair_maxscore": LEXICAL,
           "op13_uniform_threshold": INNER}

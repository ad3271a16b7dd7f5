"""SQL with the same results as the queries, where SQL can express them."""

from threadtone.llm.queries import DOMAINS, WEIGHTS

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = (
    rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

def _filled(children: str, parent: str, name: str) -> str:
    """Shares of a table's rows: SQL of the level that children of a node fill up to."""
    window = f"PARTITION BY {parent} ORDER BY weight <= 0, cap / nullif(weight, 0), {name}"
    return f"""
SELECT *, CASE WHEN weight > 0
  THEN least(cap, CAST(floor(weight * greatest(max(level) OVER (PARTITION BY {parent}), 0)) AS BIGINT))
  ELSE 0 END AS share
FROM (SELECT *, (budget - coalesce(sum(cap) OVER
        ({window} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / nullif(sum(greatest(weight, 0)) OVER
        ({window} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level
      FROM {children})"""


def _weight(path: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in WEIGHTS.items())
    return f"CASE {path} {cases} ELSE 1 END"


_DOMAIN = " ".join(
    f"WHEN source IN ({', '.join(map(repr, names))}) THEN '{domain}'" for domain, names in DOMAINS.items()
)
_SENTENCE = r"[^.!?\n]+[.!?\n]*|[.!?\n]+"
_SQUEEZED = (
    rf"trim(regexp_replace(translate(unit, '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+', ' ', 'g'))"
)



def _product_codes(rounds: int = 2) -> str:
    """Plain assignments and means over all pairs of a part and an entry."""

    def assigned(i: int) -> str:
        return f"""
a{i} AS (
  SELECT vec_id, label, p, x, j, list_sum([(x[i] - c[i]) * (x[i] - c[i]) for i in range(1, 5)]) AS d
  FROM v JOIN c{i} USING (p)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, j) = 1
)"""

    def entries(i: int) -> str:
        return f"""
m{i} AS (
  SELECT p, j, i, sum(x[i]) AS s, count(*) AS n FROM a{i}, range(1, 5) r(i) GROUP BY p, j, i
),
c{i + 1} AS (
  SELECT c{i}.p, c{i}.j, coalesce(u.c, c{i}.c) AS c FROM c{i} LEFT JOIN (
    SELECT p, j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM m{i} GROUP BY p, j
  ) u USING (p, j)
)"""

    steps = [part for i in range(rounds) for part in (assigned(i), entries(i))]
    return f"""
WITH k AS (
  SELECT vec_id, label, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
),
v AS (SELECT vec_id, label, p, e[p * 4 + 1 : p * 4 + 4] AS x FROM k, range(16) r(p)),
c0 AS (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS j, x AS c FROM v
  WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT 64)
),{",".join(steps)},{assigned(rounds)},
b AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS codebooks_sha256 FROM c{rounds}
),
r AS (
  SELECT vec_id, label, string_agg(printf('%02x', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r, b
"""


ORACLES: dict[str, str] = {
    "op1_substring_dedup": rf"""
WITH u AS (
  SELECT doc_id, unnest(pieces) AS unit, generate_subscripts(pieces, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SENTENCE}') AS pieces FROM documents)
),
n AS (
  SELECT *, {_SQUEEZED} AS norm,
         sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop FROM u
),
b AS (
  SELECT *, row_number() OVER (PARTITION BY norm ORDER BY doc_id, i) > 1 AS again FROM n
),
w AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, again ORDER BY i) AS run FROM b
),
r AS (
  SELECT *, again AND sum(strlen(norm)) OVER (PARTITION BY doc_id, again, run) >= 150 AS gone FROM w
),
a AS (
  SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed,
         string_agg((stop - length(unit)) || '-' || stop, ',' ORDER BY i) FILTER (gone) AS removed,
         string_agg(unit, '' ORDER BY i) FILTER (NOT gone) AS rest
  FROM r GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(n_units, 0) AS BIGINT) AS n_units,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed,
       CASE WHEN text IS NULL THEN NULL ELSE coalesce(rest, '') END AS text
FROM documents LEFT JOIN a USING (doc_id)
""",
    "op7_mixing": rf"""
WITH d AS (
  SELECT doc_id, lang, source, CASE {_DOMAIN} ELSE 'other' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens
  FROM documents
),
leaf AS (
  SELECT domain, lang, source, sum(tokens) AS tokens, 2 * sum(tokens) AS cap
  FROM d WHERE tokens > 0 GROUP BY ALL
),
c1 AS (
  SELECT domain, sum(cap) AS cap, {_weight("domain")} AS weight,
         (SELECT sum(tokens) // 2 FROM leaf) AS budget, 0 AS root FROM leaf GROUP BY domain
),
s1 AS ({_filled("c1", "root", "domain")}),
c2 AS (
  SELECT l.*, s1.share AS budget, {_weight("l.domain || '/' || lang")} AS weight
  FROM (SELECT domain, lang, sum(cap) AS cap FROM leaf GROUP BY ALL) l JOIN s1 USING (domain)
),
s2 AS ({_filled("c2", "domain", "lang")}),
c3 AS (
  SELECT leaf.*, s2.share AS budget,
         {_weight("leaf.domain || '/' || leaf.lang || '/' || source")} AS weight
  FROM leaf JOIN s2 USING (domain, lang)
),
s3 AS ({_filled("c3", "domain, lang", "source")}),
e AS (
  SELECT d.*, share // s3.tokens AS whole, share % s3.tokens AS rest,
         sum(d.tokens) OVER (
           PARTITION BY domain, lang, source
           ORDER BY md5('42:' || (share // s3.tokens) || ':' || doc_id), d.tokens
           ROWS UNBOUNDED PRECEDING) AS upto
  FROM d JOIN s3 USING (domain, lang, source) WHERE d.tokens > 0
),
t AS (SELECT *, whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END AS times FROM e)
SELECT doc_id, domain, lang, source, CAST(tokens AS BIGINT) AS tokens,
       unnest(range(0, CAST(times AS BIGINT))) AS epoch
FROM t WHERE times > 0
""",
    "op9_decontamination": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
        FROM (SELECT *, least(13, len(w)) AS k FROM b WHERE len(w) > 0))
),
k AS (SELECT DISTINCT k FROM g),
s AS (
  SELECT doc_id, k, p, array_to_string(list_slice(w, p, p + k - 1), ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, k WHERE len(w) >= k)
),
h AS (SELECT s.doc_id, s.k, s.p, g.item_id FROM s JOIN g ON s.gram = g.gram AND s.k = g.k),
c AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM (SELECT DISTINCT doc_id, k, p FROM h))
  GROUP BY doc_id
),
i AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)
""",
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER best AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       first_value(doc_id) OVER best = doc_id AS kept,
       sha256(norm) AS text_sha256
FROM d
WINDOW best AS (PARTITION BY norm ORDER BY n DESC, doc_id)
""",
    "op12_fill_in_middle": r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS s,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u
  FROM documents
),
g AS (
  SELECT *, len(u) AS n, CAST('0x' || s[1:8] AS BIGINT) % (len(u) + 1) AS x, CAST('0x' || s[9:16] AS BIGINT) % (len(u) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR CAST('0x' || s[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
              WHEN CAST('0x' || s[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM h
),
c AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS a,
         array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS b,
         array_to_string(u[greatest(x, y) + 1:], '') AS z
  FROM g
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || a || '<S>' || z || '<M>' || b
              ELSE '<S>' || z || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM c
""",
    "op13_product_codes": _product_codes(),
}

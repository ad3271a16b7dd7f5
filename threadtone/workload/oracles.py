"""SQL that gives the same results as the registered queries, for comparison."""

from __future__ import annotations

from threadtone.constants import SAMPLE_FRACTION
from threadtone.workload import standins as given

# Fixed value: the word characters, as SQL text.
_W = "a-zA-Z0-9_#$%''"
_PLACES = ", ".join(f"'{p}'" for p in given.PLACES)
_OFF_MAP = ", ".join(f"'{p}'" for p in given.OFF_MAP)

_LABELS = """
labeled AS (SELECT doc_id AS Input_id,
    CAST(quality - toxic AS VARCHAR) AS label_balance,
    CAST(quality * 2 - 1 AS VARCHAR) AS label_quality,
    CAST(toxic * 2 - 1 AS VARCHAR) AS label_toxic FROM labels),
flags AS (SELECT *, {columns} FROM labeled)""".format(
    columns=", ".join(
        f"CASE WHEN label_{t} = '{value}' THEN 1 ELSE 0 END AS {t}_{kind}"
        for t in given.TARGET_NAMES
        for kind, value in (("pos", 1), ("neg", -1))
    )
)
_FLAGS = ", ".join(given.FLAGS)

_META = """
meta AS (SELECT event_id // 10 AS id,
    't3_' || CAST(event_id // 10 // 4 AS VARCHAR) AS link_id,
    CAST(floor(epoch(ts)) AS BIGINT) AS created_utc,
    CAST(floor(value) AS BIGINT) AS score, n_name AS author_flair_text
  FROM events JOIN nation ON user_id % 25 = n_nationkey)"""

_SIGHTINGS = f"""{_META},
sightings AS (SELECT created_utc AS "timestamp", score AS c_score,
    CAST(length(url) AS BIGINT) AS s_score, CAST(page_id AS VARCHAR) AS link_id,
    author_flair_text AS state, id AS comment_id
  FROM meta JOIN pages ON substr(link_id, 4) = CAST(page_id AS VARCHAR))"""

_SENTIMENT = f"""{_SIGHTINGS},{_LABELS},
sentiment AS (SELECT sightings.*, {_FLAGS}
  FROM sightings JOIN flags ON comment_id = Input_id)"""

_DAY = "CAST(CAST(make_timestamp(\"timestamp\" * 1000000) AS DATE) AS VARCHAR)"


def _ratio(flag: str) -> str:
    return f"CAST(sum({flag}) AS DOUBLE) / count(*)"


def _share(key: str, name: str, positive: str, negative: str, valid: bool) -> str:
    where = f"WHERE state IN ({_PLACES})" if valid else ""
    return (
        f"WITH {_SENTIMENT} SELECT {key} AS {name}, "
        f"{_ratio('balance_pos')} AS {positive}, {_ratio('balance_neg')} AS {negative} "
        f"FROM sentiment {where} GROUP BY {key}"
    )


def _share_by_target(key: str, name: str, valid: bool) -> str:
    where = f"WHERE state IN ({_PLACES})" if valid else ""
    return f"WITH {_SENTIMENT} " + " UNION ALL ".join(
        f"SELECT '{t}' AS target, {key} AS {name}, "
        f'{_ratio(f"{t}_pos")} AS "Positive", {_ratio(f"{t}_neg")} AS "Negative" '
        f"FROM sentiment {where} GROUP BY {key}"
        for t in given.TARGET_NAMES
    )


def _text(source: str, out: str) -> str:
    """Token lists step by step; a formulation of its own, not the regex chain."""
    return f"""
WITH source AS ({source}),
a AS (SELECT id, regexp_replace(regexp_replace(regexp_replace(body,
      '\\t|\\n|\\\\n|\\\\t', ' ', 'g'), '\\[([^\\]]*)\\]\\([^\\)]*\\)', '\\1', 'g'),
      '\\[?([a-zA-Z]*)\\]?\\s*(?:https://|http://|www\\.)\\S*', '\\1', 'g') AS x
    FROM source),
b AS (SELECT id, x, flatten(list_transform(
      list_filter(string_split(x, ' '), lambda t: t <> ''),
      lambda t: string_split(regexp_replace(t, '^([^{_W}]+)([{_W}]+)', '\\1 \\2'), ' ')))
      AS k FROM a),
c AS (SELECT id, flatten(list_transform(k,
      lambda t: string_split(regexp_replace(t, '([{_W}]+)([^{_W}]+)$', '\\1 \\2'), ' ')))
      AS k FROM b),
d AS (SELECT id, list_transform(list_filter(flatten(list_transform(k, lambda t:
      CASE WHEN regexp_matches(t, '[{_W}]') THEN [t]
      ELSE string_split(regexp_replace(t, '[^.!?,;:]+', '', 'g'), '') END)),
      lambda t: t <> ''), lambda t: lower(t)) AS k FROM c),
e AS (SELECT id, array_to_string(k, ' ') AS parsed,
      list_transform(list_filter(string_split(array_to_string(list_transform(k, lambda t:
        CASE WHEN regexp_matches(t, '[{_W}]') THEN t ELSE chr(1) END), ' '), chr(1)),
        lambda p: trim(p) <> ''), lambda p: string_split(trim(p), ' ')) AS ph FROM d),
texts AS (SELECT id, parsed, flatten(ph) AS g1,
      flatten(list_transform(ph, lambda p: list_transform(range(1, len(p)),
        lambda i: p[i] || '_' || p[i + 1]))) AS g2,
      flatten(list_transform(ph, lambda p: list_transform(range(1, len(p) - 1),
        lambda i: p[i] || '_' || p[i + 1] || '_' || p[i + 2]))) AS g3 FROM e),
lists AS (SELECT id, CASE WHEN len(g1) = 0 THEN [''] ELSE g1 END
      || CASE WHEN len(g2) = 0 THEN [''] ELSE g2 END
      || CASE WHEN len(g3) = 0 THEN [''] ELSE g3 END AS grams FROM texts)
{out}"""


_DOCUMENTS = "SELECT doc_id AS id, text AS body FROM documents"
_POSTS = (
    "SELECT page_id AS id, 'See [the page](' || url || ') or [here] ' || url "
    "|| ' now... ' || html || ' via' || url AS body FROM pages"
)
_FOUR = (
    "SELECT {keys}parsed, array_to_string(g1, ' ') AS unigrams, "
    "array_to_string(g2, ' ') AS bigrams, array_to_string(g3, ' ') AS trigrams "
    "FROM texts"
)
_LABELLED = "SELECT doc_id AS id, text AS body FROM documents SEMI JOIN labels USING (doc_id)"
_STATS = (
    ", once AS (SELECT id, unnest(list_distinct(grams)) AS term FROM lists), "
    "every AS (SELECT unnest(grams) AS term FROM lists), "
    "stats AS (SELECT * FROM "
    "(SELECT term, count(*) AS document_frequency FROM once GROUP BY term) JOIN "
    "(SELECT term, count(*) AS total_count FROM every GROUP BY term) USING (term) "
    "WHERE document_frequency >= 5) "
)
_VECTOR_TERMS = (
    ", once AS (SELECT id, unnest(list_distinct(grams)) AS term FROM lists), "
    "vocabulary AS (SELECT term FROM once SEMI JOIN labels ON id = doc_id "
    "GROUP BY term HAVING count(*) >= 5) "
    "SELECT id, term FROM once SEMI JOIN vocabulary USING (term)"
)

_UNIT = (
    "CAST(CAST('0x' || substr(md5('"
    + str(given.SEED)
    + ":' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0"
)

_FRESH = "NOT regexp_matches(text, '^&gt') AND text NOT LIKE '%/s%'"

_STATE_SHARES = f"""{_SENTIMENT},
shares AS (SELECT state, {_ratio('balance_pos')} AS "Positive",
    {_ratio('balance_neg')} AS "Negative" FROM sentiment
  WHERE state IN ({_PLACES}) GROUP BY state),
places AS (SELECT n_name AS state FROM nation
  WHERE n_name IN ({_PLACES}) AND n_name NOT IN ({_OFF_MAP})),
differences AS (SELECT state, "Positive" - "Negative" AS "Difference" FROM shares
  WHERE state NOT IN ({_OFF_MAP}))"""


def _scale(source: str, value: str, low_if: str, high_if: str, after: str = "") -> str:
    return f"""WITH {_STATE_SHARES},
ends AS (SELECT round_even(min("{value}"), 3) AS l, round_even(max("{value}"), 3) AS h
  FROM {source}),
bounds AS (SELECT CASE WHEN l - 0.001::DOUBLE {low_if} THEN l - 0.001::DOUBLE ELSE l END AS lo,
    CASE WHEN h + 0.001::DOUBLE {high_if} THEN h + 0.001::DOUBLE ELSE h END AS hi FROM ends),
steps AS (SELECT state, "{value}", lo, hi, ("{value}" - lo) / (hi - lo) AS q
  FROM places LEFT JOIN {source} USING (state), bounds)
SELECT state, round("{value}", 9) AS "{value}", round(lo, 9) AS lo, round(hi, 9) AS hi,
  round(CASE WHEN q < 0 THEN 'nan'::DOUBLE ELSE sqrt(q) {after} END, 9) AS scale
FROM steps"""


def _extreme(value: str) -> str:
    return (
        f"SELECT '{value}' AS share, "
        f'first(state ORDER BY "{value}" DESC, state) AS max_key, '
        f'max("{value}") AS max_value, '
        f'first(state ORDER BY "{value}", state) AS min_key, '
        f'min("{value}") AS min_value FROM shares'
    )


def _published() -> str:
    files = (
        ("time_data.csv", _DAY, False),
        ("state_data.csv", "state", True),
        ("comment_score.csv", "CAST(c_score AS VARCHAR)", True),
        ("submission_score.csv", "CAST(s_score AS VARCHAR)", True),
    )
    return f"WITH {_SENTIMENT} " + " UNION ALL ".join(
        f"SELECT '{t}' AS target, '{file}' AS file, {key} AS key, "
        f'{_ratio(f"{t}_pos")} AS "Positive", {_ratio(f"{t}_neg")} AS "Negative" '
        f"FROM sentiment {f'WHERE state IN ({_PLACES})' if valid else ''} GROUP BY {key}"
        for t in given.TARGET_NAMES
        for file, key, valid in files
    )


def _odds(count: str) -> str:
    return f"round(ln(CAST({count} + 1 AS DOUBLE) / CAST(n - {count} + 1 AS DOUBLE)) / 200, 6)"


def _chance(score: str) -> str:
    return f"round(1 / (1 + exp(-(coalesce({score}, 0) - 0.5::DOUBLE))), 6)"


ORACLES: dict[str, str] = {
    "scan_project": "SELECT doc_id AS id, lang AS language, n_chars FROM documents",
    "csv_string_roundtrip": f"WITH {_LABELS} SELECT CAST(Input_id AS VARCHAR) AS Input_id,"
    " label_balance, label_quality, label_toxic FROM labeled",
    "csv_columns_by_name": "SELECT doc_id AS Input_id, "
    "CAST(quality - toxic AS BIGINT) AS label_balance, "
    "CAST(quality * 2 - 1 AS BIGINT) AS label_quality, "
    "CAST(toxic * 2 - 1 AS BIGINT) AS label_toxic FROM labels",
    "json_numbers_in_any_form": f"WITH {_META} SELECT CAST(id AS VARCHAR) AS id, "
    "created_utc, score FROM meta",
    "json_bz2_roundtrip": "SELECT CAST(doc_id AS VARCHAR) AS id, text AS body FROM documents",
    "json_quarantine": "SELECT CAST(NULL AS BIGINT) AS part, CAST(event_id AS VARCHAR) AS id, "
    "CAST(user_id AS BIGINT) AS n FROM events WHERE event_id % 5 NOT IN (0, 1) UNION ALL "
    "SELECT event_id % 3, NULL, count(*) FROM events WHERE event_id % 5 IN (0, 1) GROUP BY 1",
    "body_file_cleaning": _text(_POSTS, _FOUR.format(keys="")),
    "materialize_reuse": "SELECT doc_id, lang, n_chars FROM documents",
    "published_files": _published(),
    "labeled_join": f"WITH {_LABELS} SELECT labeled.*, text AS body "
    "FROM documents JOIN labeled ON doc_id = Input_id",
    "label_binarize": f"WITH {_LABELS} SELECT * FROM flags",
    "submission_key_join": f"WITH {_SIGHTINGS} SELECT * FROM sightings",
    "sentiment_join": f"WITH {_SENTIMENT} SELECT * FROM sentiment",
    "unseen_filter": "SELECT * FROM (SELECT page_id AS id, CASE page_id % 5 "
    "WHEN 0 THEN '&gt; ' || url WHEN 1 THEN url || ' of course /s' "
    "WHEN 2 THEN 'a &gt; b ' || lower(url) ELSE url END AS body FROM pages) "
    "WHERE NOT regexp_matches(body, '^&gt') AND body NOT LIKE '%/s%'",
    "state_membership": f"WITH {_META} SELECT * FROM meta "
    f"WHERE author_flair_text IN ({_PLACES})",
    "hash_sample": f"SELECT doc_id, n_chars FROM documents WHERE {_UNIT} < {SAMPLE_FRACTION}",
    "hash_split": f"SELECT doc_id, n_chars, CASE WHEN {_UNIT} < 0.5 THEN 1 ELSE 2 END AS part "
    "FROM documents",
    "stratified_folds": "SELECT doc_id AS id, toxic AS label, CAST((row_number() OVER "
    f"(PARTITION BY toxic ORDER BY {_UNIT}, doc_id) - 1) % 5 AS INTEGER) AS fold FROM labels",
    "label_score_auc": f"WITH {_META},{_LABELS}, f AS ("
    "UNPIVOT (SELECT score, "
    + ", ".join(given.FLAGS)
    + " FROM meta JOIN flags ON meta.id = flags.Input_id) ON "
    + ", ".join(given.FLAGS)
    + " INTO NAME flag VALUE y), "
    "h AS (SELECT flag, score, sum(y) AS p, sum(1 - y) AS n FROM f GROUP BY ALL), "
    "w AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY flag ORDER BY score "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM h) "
    "SELECT flag, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives, "
    "CAST(sum(p * (2 * below + n)) AS DOUBLE) / nullif(2.0::DOUBLE * sum(p) * sum(n), 0) AS auc "
    "FROM w GROUP BY flag",
    "random_split": "SELECT doc_id, n_chars FROM documents",
    "model_flags_agree": "SELECT doc_id AS id, "
    + ", ".join(f"true AS {name}" for name in given.FLAGS)
    + f" FROM documents WHERE {_FRESH} AND {_UNIT} < {SAMPLE_FRACTION}",
    "model_auc_in_range": "SELECT target, flag, true AS in_range FROM "
    "(SELECT unnest(['balance', 'quality', 'toxic']) AS target), "
    "(SELECT unnest(['pos', 'neg']) AS flag)",
    "scored_sentiment": f"WITH {_SIGHTINGS} SELECT sightings.*, true AS flagged "
    f"FROM sightings JOIN documents ON comment_id = doc_id "
    f"WHERE {_FRESH} AND {_UNIT} < {SAMPLE_FRACTION}",
    "text_parsed": _text(_DOCUMENTS, "SELECT id, parsed FROM texts"),
    "text_unigrams": _text(
        _DOCUMENTS, "SELECT id, array_to_string(g1, ' ') AS unigrams FROM texts"
    ),
    "text_bigrams": _text(
        _DOCUMENTS, "SELECT id, array_to_string(g2, ' ') AS bigrams FROM texts"
    ),
    "text_trigrams": _text(
        _DOCUMENTS, "SELECT id, array_to_string(g3, ' ') AS trigrams FROM texts"
    ),
    "text_grams": _text(
        _DOCUMENTS, "SELECT id, array_to_string(grams, ' ') AS grams FROM lists"
    ),
    "text_linked_pages": _text(_POSTS, _FOUR.format(keys="id, ")),
    "text_with_removed_links": _text(_POSTS, "SELECT id, x AS body FROM a"),
    "sql_functions": _text(
        _POSTS,
        "SELECT id, array_to_string(grams, ' ') AS grams, CAST(id AS VARCHAR) AS link, "
        f"CASE WHEN 'NATION_' || CAST(id AS VARCHAR) IN ({_PLACES}) THEN 1 ELSE 0 END "
        "AS valid, CAST(CAST(CAST(id AS DOUBLE) / 200 AS FLOAT) AS DOUBLE) > 0.2::DOUBLE "
        "AS above FROM lists",
    ),
    "vocab_doc_freq": _text(_LABELLED, _STATS + "SELECT * FROM stats"),
    "vocab_most_frequent": _text(
        _LABELLED,
        _STATS + "SELECT * FROM stats ORDER BY total_count DESC, term LIMIT 1000",
    ),
    "vector_vocabulary_terms": _text(_DOCUMENTS, _VECTOR_TERMS),
    "coefficient_scores": _text(
        _DOCUMENTS,
        ", once AS (SELECT id, unnest(list_distinct(grams)) AS term FROM lists), "
        "k AS (SELECT term, count(*) AS n, sum(quality) AS q, sum(toxic) AS t "
        "FROM once JOIN labels ON id = doc_id GROUP BY term HAVING count(*) >= 20), "
        f"s AS (SELECT id, sum({_odds('q')}) AS q, sum({_odds('t')}) AS t "
        "FROM once LEFT JOIN k USING (term) GROUP BY id) "
        f"SELECT id, {_chance('q')} AS quality, {_chance('t')} AS toxic FROM s",
    ),
    "share_by_link": _share("link_id", "link_id", "pos_avg", "neg_avg", False),
    "share_by_day": _share(_DAY, "date", "pos_avg_day", "neg_avg_day", False),
    "share_by_state": _share("state", "state", '"Positive"', '"Negative"', True),
    "share_by_comment_score": _share(
        "c_score", "comment_score", '"Positive"', '"Negative"', True
    ),
    "share_by_submission_score": _share(
        "s_score", "submission_score", '"Positive"', '"Negative"', True
    ),
    "share_by_target_day": _share_by_target(_DAY, "date", False),
    "share_by_target_link": _share_by_target("link_id", "link_id", False),
    "share_by_target_state": _share_by_target("state", "state", True),
    "share_by_target_comment_score": _share_by_target("c_score", "comment_score", True),
    "share_by_target_submission_score": _share_by_target(
        "s_score", "submission_score", True
    ),
    "timeseries_report": "SELECT * FROM ("
    + _share(_DAY, "date", "pos_avg_day", "neg_avg_day", False)
    + f") WHERE date IS DISTINCT FROM '{given.DROPPED_DAY}' ORDER BY date",
    "state_extremes": f"WITH {_STATE_SHARES} {_extreme('Positive')} "
    f"UNION ALL {_extreme('Negative')}",
    "state_scale_pos": _scale("shares", "Positive", "> 0", "> 0"),
    "state_scale_neg": _scale("shares", "Negative", "< 1", "< 1"),
    "state_scale_diff": _scale("differences", "Difference", "> -1", "< 1", "* 2 - 1"),
    "score_curve_submission": _share(
        "s_score", "submission_score", '"Positive"', '"Negative"', True
    )
    + " ORDER BY submission_score",
    "score_curve_comment": _share(
        "c_score", "comment_score", '"Positive"', '"Negative"', True
    )
    + " ORDER BY comment_score",
    "probability_threshold": "WITH p AS (SELECT event_id, "
    "CAST(CAST(user_id / 200.0::DOUBLE AS FLOAT) AS DOUBLE) AS v FROM events) "
    "SELECT event_id, CASE WHEN v > 0.2::DOUBLE THEN 1 ELSE 0 END AS pos, "
    "CASE WHEN v > 0.25::DOUBLE THEN 1 ELSE 0 END AS neg FROM p",
    "stored_outputs_join": "SELECT event_id AS id, value AS pos_prob, user_id AS neg_prob "
    "FROM events",
}
ORACLES["sql_share_by_day"] = ORACLES["share_by_day"]
ORACLES["sql_share_by_state"] = ORACLES["share_by_state"]

"""SQL twins of the core's queries, for DuckDB over the same Parquet tables.

They are written from what a query means rather than from how it is computed.
"""

from __future__ import annotations

import re

from murmurate.operators.gold import LABELS
from murmurate.operators.prepare import DURATION_BOUNDS, GAP_BOUNDS, MESSAGE_COUNT_BOUNDS, RELEASE_BOUNDS, TEXT_BOUNDS, TIER_BOUNDS, WORD_BOUNDS
from murmurate.schema import LANGUAGE_LABELS, SENTINELS

#: A written date as UTC timestamp, or NULL: the parts of the test tables' notations put into one form.
MOMENT = """(CASE WHEN regexp_full_match(upper(trim({c})), '\\d{{4}}[-/]\\d{{1,2}}[-/]\\d{{1,2}}[T ]\\d{{1,2}}:\\d{{2}}(:\\d{{2}}([.]\\d+)?)?(Z|[+-]\\d{{2}}:?\\d{{2}})?')
 THEN try_cast(replace(upper(trim({c})), '/', '-') || CASE WHEN regexp_matches(upper(trim({c})), '(Z|[+-]\\d{{2}}:?\\d{{2}})$') THEN '' ELSE 'Z' END AS timestamptz) END)"""


def moment(column: str) -> str:
    return MOMENT.format(c=column)


def buckets(value: str, bounds: list, labels: list[str]) -> str:
    cases = " ".join(f"WHEN {value} <= {b} THEN '{x}'" for b, x in zip(bounds, labels))
    return f"CASE WHEN {value} IS NULL THEN NULL {cases} ELSE '{labels[-1]}' END"


DATE = moment('"date"')
NICK = 'lower(trim("from"))'
S = f"""s AS (SELECT * REPLACE (({DATE} AT TIME ZONE 'UTC') AS date) FROM (SELECT DISTINCT * EXCLUDE (load_batch, ingested_at) FROM silver))"""
DATED = S + """, m AS (SELECT * FROM s WHERE date IS NOT NULL AND "from" IS NOT NULL AND conversation_id IS NOT NULL)"""
BRONZE = f"""b AS (SELECT row_id, folder, try_cast(regexp_replace(dialogue_id, '(?i)\\.tsv$', '') AS BIGINT) AS dialogue, ({DATE} AT TIME ZONE 'UTC') AS date,
  CASE WHEN trim("from") <> '' THEN "from" END AS "from", CASE WHEN trim("to") <> '' THEN "to" END AS "to", text
  FROM dialoguetext_196 WHERE {DATE} IS NOT NULL AND text IS NOT NULL),
c AS (SELECT *, sha256(coalesce(folder::VARCHAR, '<NULL>') || '::' || coalesce(dialogue::VARCHAR, '<NULL>')) AS conversation_id FROM b)"""

P1 = f"""
WITH e AS (
  SELECT message_id AS id, min(struct_pack(t := epoch_us({DATE}), u := {NICK})) AS s
  FROM silver WHERE {DATE} IS NOT NULL AND nullif({NICK}, '') IS NOT NULL AND message_id IS NOT NULL GROUP BY message_id),
m AS (SELECT id, s.u AS u, s.t AS t FROM e),
g AS (SELECT *, CASE WHEN t - lag(t) OVER w <= 1800000000 THEN 0 ELSE 1 END AS fresh FROM m WINDOW w AS (PARTITION BY u ORDER BY t, id)),
n AS (SELECT *, sum(fresh) OVER (PARTITION BY u ORDER BY t, id ROWS UNBOUNDED PRECEDING) AS nr FROM g)
"""

_AVERAGED = {
    "text_length": "avg_text_length", "word_count": "avg_word_count", "vader_compound": "avg_vader_compound",
    "transformer_expected_sentiment": "avg_transformer_expected_sentiment", "transformer_negative": "avg_transformer_negative",
    "transformer_neutral": "avg_transformer_neutral", "transformer_positive": "avg_transformer_positive", "transformer_score": "avg_transformer_confidence",
}


def mode_of(column: str) -> str:
    return f"list_min(list_transform(list_filter(map_entries(histogram({column})), lambda e: e.value = list_max(map_values(histogram({column})))), lambda e: e.key))"


def metrics(keys: tuple[str, ...] = (), prefix: str = "") -> str:
    a = lambda n: f'"{prefix}{n}"'
    out = [f"count(*) AS {a('message_count')}"]
    out += [f"round(avg({c}), 6) AS {a(n)}" for c, n in _AVERAGED.items()]
    # Per user a side may be missing; whole numbers that may be missing are doubles.
    count = "DOUBLE" if prefix else "BIGINT"
    out.append(f"coalesce(sum(tech_lexicon_match_count), 0)::{count} AS {a('total_tech_lexicon_matches')}")
    for c, n in (("conversation_id", "unique_conversations"), ('"from"', "unique_senders"), ('"to"', "unique_recipients")):
        if c.strip('"') not in keys:
            out.append(f"count(DISTINCT {c})::{count} AS {a(n)}")
    for label in ("vader_label", "transformer_label"):
        out.append(f"{mode_of(label)} AS {a('most_common_' + label)}")
        out += [f"round(avg(CASE WHEN {label} IS NOT NULL THEN ({label} = '{v}')::INT END), 6) AS {a(label.removesuffix('_label') + '_' + v.lower() + '_share')}" for v in LABELS[label]]
    if "topic_label" not in keys:
        out.append(f"{mode_of('topic_label')} AS {a('most_common_topic')}")
    return ", ".join(out)


def _gold(key: str, source: str = "s", where: str = "", names: tuple[str, ...] = (), ctes: str = S) -> str:
    return f"WITH {ctes} SELECT {key}, {metrics(names)} FROM {source} {where} GROUP BY ALL"


_SENT = ", ".join(f"'{x}'" for x in SENTINELS)
GOLD_CONVERSATION = f"""WITH {S},
g AS (SELECT conversation_id, {metrics(('conversation_id',))}, min(date) AS conversation_start, max(date) AS conversation_end FROM s GROUP BY conversation_id),
p AS (SELECT conversation_id, count(DISTINCT x) AS participant_count FROM (SELECT conversation_id, unnest(["from", "to"]) AS x FROM s) WHERE x NOT IN ({_SENT}) GROUP BY 1)
SELECT g.*, round((epoch_us(conversation_end) - epoch_us(conversation_start)) / 60000000.0::DOUBLE, 6) AS conversation_duration_mins,
  coalesce(participant_count, 0) AS participant_count, unique_senders > 1 AS conversation_was_answered FROM g LEFT JOIN p USING (conversation_id)"""

GOLD_USER = f"""WITH {S},
a AS (SELECT "from" AS u, {metrics(('from',), 'sent_')} FROM s WHERE "from" IS NOT NULL GROUP BY 1),
b AS (SELECT "to" AS u, {metrics(('to',), 'received_')} FROM s WHERE "to" IS NOT NULL GROUP BY 1),
p AS (SELECT DISTINCT "from" AS x, "to" AS y FROM s WHERE "from" IS NOT NULL AND "to" IS NOT NULL),
k AS (SELECT x AS u, count(DISTINCT y) AS n FROM (SELECT x, y FROM p UNION ALL SELECT y, x FROM p) GROUP BY 1)
SELECT coalesce(a.u, b.u) AS "user", a.* EXCLUDE (u) REPLACE (coalesce(sent_message_count, 0) AS sent_message_count),
  b.* EXCLUDE (u) REPLACE (coalesce(received_message_count, 0) AS received_message_count), coalesce(k.n, 0) AS unique_contacts,
  coalesce(sent_message_count, 0) + coalesce(received_message_count, 0) AS total_interactions
FROM a FULL JOIN b ON a.u = b.u LEFT JOIN k ON k.u = coalesce(a.u, b.u)"""

SUMMARY = re.sub(r"round\((avg\((?:[^()]|\([^()]*\))*\)), 6\)", r"\1", GOLD_CONVERSATION).replace("WITH ", "", 1).replace("GROUP BY 1)\nSELECT g.*,", "GROUP BY 1),\nq AS (SELECT g.*,") + ")"
FIRST = DATED + """, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY date, message_id) AS nr FROM m) WHERE nr = 1),
w AS (SELECT f.*, a.answered FROM f JOIN (SELECT conversation_id, count(DISTINCT "from") > 1 AS answered FROM m GROUP BY 1) a USING (conversation_id))"""
_ALL = ", ".join(f"'{x}'" for x in LANGUAGE_LABELS)
_WORD = "[\\p{L}\\p{M}\\p{N}_]"
_TOKENS = f"regexp_extract_all(coalesce(text, ''), '{_WORD}+(?:[''-]{_WORD}+)*')"


def _stack(columns: list[str], source: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM {source} WHERE {c} IS NOT NULL" for c in columns)


def _pairs(columns: list[str], query: str) -> str:
    return " UNION ALL ".join(query.format(a=a, b=b) for i, a in enumerate(columns) for b in columns[i + 1 :])


def nudged(query: str) -> str:
    """Each ``round(x, 6)`` as ``round(x + 1e-9, 6)``, as the queries round."""
    out, at = "", 0
    while (i := query.find("round(", at)) >= 0:
        depth, j = 0, i + 5
        while True:
            depth += {"(": 1, ")": -1}.get(query[j], 0)
            if not depth:
                break
            j += 1
        inner = query[i + 6 : j]
        if inner.endswith(", 6"):
            out += query[at:i] + "round((" + nudged(inner[:-3]) + ") + 1e-9, 6)"
        else:
            out += query[at:i] + "round(" + nudged(inner) + ")"
        at = j + 1
    return out + query[at:]


APPLIED = f"""WITH {S}, v AS (SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(residual_words) AS w FROM s) WHERE w IS NOT NULL AND NOT regexp_full_match(w, '\\d+')),
pieces AS (SELECT message_id, text_cleaned, string_split(regexp_replace(text_cleaned, '({_WORD}+(?:[''-]{_WORD}+)*)', '\ue000\\1\ue000', 'g'), '\ue000') AS p FROM s),
flat AS (SELECT message_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM pieces),
built AS (SELECT message_id, string_agg(CASE WHEN i % 2 = 0 AND word IS NOT NULL THEN 'NONWORD' ELSE x END, '' ORDER BY i) AS t FROM flat LEFT JOIN v ON word = lower(x) AND i % 2 = 0 GROUP BY 1),
applied AS (SELECT message_id, t AS text_cleaned FROM s LEFT JOIN built USING (message_id))"""


def _inflation(columns: list[str]) -> str:
    """Diagonal of the inverse of the Gram matrix by cofactors, times its diagonal."""
    from itertools import permutations

    k = len(columns)
    sign = lambda p: (-1) ** sum(p[i] > p[j] for i in range(len(p)) for j in range(i + 1, len(p)))

    def det(keep: list[int]) -> str:
        return " + ".join(f"{sign(p)} * " + " * ".join(f"g{min(keep[i], keep[j])}{max(keep[i], keep[j])}" for i, j in enumerate(p)) for p in permutations(range(len(keep))))

    sums = ", ".join(f"sum({columns[i]}::DOUBLE * {columns[j]}::DOUBLE) / 1e6 AS g{i}{j}" for i in range(k) for j in range(i, k))
    full = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    parts = [f"SELECT '{c}' AS feature, round(g{i}{i} * ({det([j for j in range(k) if j != i])}) / ({det(list(range(k)))}), 6) AS vif FROM g" for i, c in enumerate(columns)]
    return f"WITH {S}, g AS (SELECT {sums} FROM s WHERE {full}) " + " UNION ALL ".join(parts)


def _answer_tests() -> str:
    """Tails by Simpson's rule, as there is no error function."""
    grid = lambda a, b, n, f: f"(SELECT sum(CASE WHEN i IN (0, {n}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * {f.format(t=f'({a} + ({b} - {a}) * i / {n}.0::DOUBLE)')}) * ({b} - {a}) / {3 * n}.0 FROM range(0, {n + 1}) r(i))"
    return f"""WITH {FIRST}, r AS (SELECT answered AS g, rank() OVER (ORDER BY text_length) + (count(*) OVER (PARTITION BY text_length) - 1) / 2.0::DOUBLE AS k FROM w WHERE text_length IS NOT NULL),
t AS (SELECT sum(n::DOUBLE * n * n - n) AS ties FROM (SELECT count(*) AS n FROM w WHERE text_length IS NOT NULL GROUP BY text_length)),
u0 AS (SELECT count(*) FILTER (g)::DOUBLE AS a, count(*) FILTER (NOT g)::DOUBLE AS b, sum(k) FILTER (g) AS rs FROM r),
u1 AS (SELECT a, b, rs - a * (a + 1) / 2 AS u, sqrt(a * b / 12 * ((a + b + 1) - ties / ((a + b) * (a + b - 1)))) AS sd FROM u0, t),
u2 AS (SELECT u, least(greatest(abs(u - a * b / 2) - 0.5, 0) / sd, 38) AS z FROM u1),
u3 AS (SELECT u, 2 * {grid('z', '(z + 12)', 4000, 'exp(-{t} * {t} / 2)')} / sqrt(2 * pi()) AS p FROM u2),
c0 AS (SELECT topic_label AS x, answered AS y, count(*)::DOUBLE AS n FROM w WHERE topic_label IS NOT NULL GROUP BY 1, 2),
c1 AS (SELECT * FROM c0 WHERE x IN (SELECT x FROM c0 GROUP BY 1 HAVING sum(n) >= 30)),
c2 AS (SELECT x, y, coalesce(n, 0) AS n, rx * ry / (SELECT sum(n) FROM c1) AS e FROM (SELECT x, sum(n) AS rx FROM c1 GROUP BY 1) a CROSS JOIN (SELECT y, sum(n) AS ry FROM c1 GROUP BY 1) b LEFT JOIN c1 USING (x, y)),
c3 AS (SELECT sum((n - e) * (n - e) / e) AS chi, (count(DISTINCT x) - 1)::DOUBLE * (count(DISTINCT y) - 1) AS df FROM c2),
c4 AS (SELECT chi, {grid('chi', '(chi + 300)', 60000, 'pow({t}, df / 2 - 1) * exp(-{t} / 2)')} / (pow(2, df / 2) * exp(lgamma(df / 2))) AS p FROM c3),
h AS (SELECT 'text_length' AS hypothesis, 'mann_whitney' AS test, u AS statistic, p AS p_value FROM u3 UNION ALL SELECT 'topic', 'chi_square', chi, p FROM c4),
o AS (SELECT *, row_number() OVER (ORDER BY p_value, hypothesis) - 1 AS i FROM h)
SELECT hypothesis, test, round(statistic, 6) AS statistic, round(p_value, 6) AS p_value, round(least(max(p_value * (2 - i)) OVER (ORDER BY i), 1), 6) AS p_value_holm FROM o"""


def sql() -> dict[str, str]:
    from murmurate.plans import oracle_text

    prepared = prepared_bronze()
    whole = f"WITH {prepared} SELECT * FROM prepared"
    return {name: nudged(q) for name, q in _sql().items()} | oracle_text.sql() | {
        "prepared_bronze": nudged(whole),
        "core_silver": oracle_text.core_silver(nudged(prepared), "prepared.*"),
        "core_validation": f"WITH {prepared} SELECT 'rows' AS what, count(*)::DOUBLE AS n FROM prepared UNION ALL SELECT unnest([{', '.join(repr(c) for c in CHECKED)}]), 0.0::DOUBLE",
    }


#: What the validation of core silver looks for; nothing is found in a table that is handed on.
CHECKED = (
    "null_text", *[f"{k}_count_differs" for k in ("tech_lexicon", "slang", "glued", "domain", "email", "phone", "ssn", "ipv4", "ipv6", "menu_path", "keyboard_shortcut")], "residual_flag_differs", "placeholder_glued",
    "vader_incomplete", "vader_out_of_range", "vader_sum", "vader_label_unknown", "vader_compound_range", "vader_label_threshold", "nlp_lexical_diversity_range", "alpha_above_tokens",
    *[f"nlp_{k}_count_negative" for k in ("stopword", "negation", "punctuation", "exclamation", "token", "question", "sentence", "uppercase_token", "alpha_token", "unique_alpha_token")],
)


def prepared_bronze() -> str:
    """CTEs that end in ``prepared``: every column of prepared messages."""
    gap = "(epoch_us(date) - epoch_us(lag(date) OVER w)) / 60000000.0::DOUBLE"
    word_count = "trim(regexp_replace(text, '[\\s\\x0B\\x{85}\\p{Z}]+', ' ', 'g'))"
    releases = "(SELECT list(DISTINCT release_date::DATE) FROM release_calendar)"
    return BRONZE + f""",
d0 AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY date, "from", text ORDER BY row_id) = 1),
d1 AS (SELECT *, count(DISTINCT "from") OVER (PARTITION BY conversation_id) AS n, min("from") OVER (PARTITION BY conversation_id) AS one, max("from") OVER (PARTITION BY conversation_id) AS two FROM d0),
d2 AS (SELECT * REPLACE (coalesce("from", CASE WHEN n = 2 AND "to" = one THEN two WHEN n = 2 AND "to" = two THEN one END) AS "from") FROM d1),
d3 AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY date, row_id) AS nr FROM d2 WHERE "from" IS NOT NULL),
d4 AS (SELECT row_id, folder, dialogue AS dialogue_id, date, "from", text, conversation_id, nr, coalesce("to", CASE WHEN n <= 1 THEN '__UNANSWERED__' WHEN nr = 1 THEN '__ALL__' WHEN n = 2 THEN CASE WHEN "from" = one THEN two WHEN "from" = two THEN one END ELSE '__ALL__' END) AS "to" FROM d3),
d5 AS (SELECT *, sha256(conversation_id || '::' || strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '::' || coalesce("from", '<NULL>') || '::' || coalesce("to", '<NULL>') || '::' || text) AS message_id FROM d4),
d6 AS (SELECT conversation_id, min(date) AS conversation_start, max(date) AS conversation_end, count(*) AS conversation_message_count, count(DISTINCT "from") > 1 AS conversation_was_answered FROM d5 GROUP BY 1),
d7 AS (SELECT conversation_id, count(DISTINCT x) AS k FROM (SELECT conversation_id, unnest(["from", "to"]) AS x FROM d5) WHERE x NOT IN ({_SENT}) GROUP BY 1),
d8 AS (SELECT message_id, conversation_id, date, "from", "to", row_id, folder, dialogue_id, text, conversation_start, conversation_end, conversation_message_count, conversation_was_answered, coalesce(k, 0) AS conversation_participant_count,
  round((epoch_us(conversation_end) - epoch_us(conversation_start)) / 60000000.0::DOUBLE, 6) AS conversation_duration_mins, "from" = first_value("from") OVER w AS is_op, nr - 1 AS turn_count, round({gap}, 6) AS response_gap_mins,
  round(CASE WHEN "from" <> lag("from") OVER w THEN {gap} END, 6) AS response_gap_mins_between_speakers, count(*) OVER (PARTITION BY "from", date_trunc('month', date)) AS user_messages_this_month,
  row_number() OVER (PARTITION BY "from" ORDER BY date, message_id) AS user_message_count, length(text) AS text_length, CASE WHEN {word_count} = '' THEN 0 ELSE len(string_split({word_count}, ' ')) END AS word_count,
  year(date)::INT AS year, month(date)::INT AS month, day(date)::INT AS day, dayname(date) AS day_of_week, hour(date)::INT AS hour,
  date_diff('day', list_max(list_filter({releases}, lambda r: r <= date::DATE)), date::DATE)::DOUBLE AS days_since_release, date_diff('day', date::DATE, list_min(list_filter({releases}, lambda r: r >= date::DATE)))::DOUBLE AS days_until_release
  FROM d5 JOIN d6 USING (conversation_id) LEFT JOIN d7 USING (conversation_id) WINDOW w AS (PARTITION BY conversation_id ORDER BY nr)),
prepared AS (SELECT *, {buckets('user_messages_this_month', *TIER_BOUNDS)} AS user_tier, {buckets('days_since_release', *RELEASE_BOUNDS)} AS days_since_release_bucket, {buckets('days_until_release', *RELEASE_BOUNDS)} AS days_until_release_bucket,
  {buckets('text_length', *TEXT_BOUNDS)} AS text_length_bucket, {buckets('word_count', *WORD_BOUNDS)} AS word_count_bucket, {buckets('response_gap_mins_between_speakers', *GAP_BOUNDS)} AS response_gap_bucket FROM d8)"""


def _sql() -> dict[str, str]:
    from murmurate.plans.oracle_text import scripts_labelled

    numbers = ["text_length", "word_count", "vader_compound", "transformer_score"]
    turn = 'WINDOW w AS (PARTITION BY conversation_id ORDER BY date, message_id)'
    gap = "(epoch_us(date) - epoch_us(lag(date) OVER w)) / 60000000.0::DOUBLE"
    releases = "(SELECT list(DISTINCT release_date::DATE) FROM release_calendar)"
    since = f"date_diff('day', list_max(list_filter({releases}, lambda r: r <= date::DATE)), date::DATE)"
    until = f"date_diff('day', date::DATE, list_min(list_filter({releases}, lambda r: r >= date::DATE)))"
    weekdays = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
    word_count = "CASE WHEN trim(regexp_replace(coalesce(text, ''), '[\\s\\x0B\\x{85}\\p{Z}]+', ' ', 'g')) = '' THEN 0 ELSE len(string_split(trim(regexp_replace(coalesce(text, ''), '[\\s\\x0B\\x{85}\\p{Z}]+', ' ', 'g')), ' ')) END"
    return {
        "p1_found": P1 + """SELECT u AS user_name, min(struct_pack(t := t, id := id)).id AS first_message_id,
 max(struct_pack(t := t, id := id)).id AS last_message_id FROM n GROUP BY u, nr""",
        "p1_sessions": P1 + """SELECT u AS user_name, make_timestamp(min(t)) AS session_start, make_timestamp(max(t)) AS session_end,
 (max(t) - min(t)) / 1000000.0::DOUBLE AS duration_seconds, count(*) AS event_count,
 min(struct_pack(t := t, id := id)).id AS first_event_id, max(struct_pack(t := t, id := id)).id AS last_event_id FROM n GROUP BY u, nr""",
        "gold_conversation": GOLD_CONVERSATION,
        "gold_user": GOLD_USER,
        **{f"gold_date_{g}": _gold(f"date_trunc('{g}', date)::TIMESTAMP AS date_period", where="WHERE date IS NOT NULL") for g in ("day", "week", "month")},
        "gold_channel": _gold("channel", where="WHERE channel IS NOT NULL"),
        "gold_channel_events": """SELECT event_type AS channel, count(*) AS message_count, count(DISTINCT user_id::VARCHAR || '::' || strftime(ts, '%Y-%m-%d')) AS unique_conversations,
 count(DISTINCT user_id) AS unique_senders, 0 AS unique_recipients FROM events WHERE event_type IS NOT NULL GROUP BY 1""",
        "gold_release_since": _gold("days_since_release_bucket"), "gold_release_until": _gold("days_until_release_bucket"),
        "gold_language": _gold("language_label", "l", ctes=S + f""", l0 AS (SELECT *, list_filter([{_ALL}], lambda x: list_contains({_TOKENS.replace("coalesce(text, '')", scripts_labelled("coalesce(text_cleaned, '')"))}, x)) AS found FROM s),
 l AS (SELECT * EXCLUDE (found), unnest(CASE WHEN len(found) > 0 THEN found ELSE ['UNLABELED'] END) AS language_label FROM l0)"""),
        "gold_residual": _gold("residual_word", "l", "WHERE residual_word IS NOT NULL", ctes=S + ", l AS (SELECT *, unnest(residual_words) AS residual_word FROM s)"),
        "gold_technical": _gold("technical_term, technical_category", "k", "WHERE technical_term IS NOT NULL", ctes=S + ", l AS (SELECT *, unnest(tech_lexicon_matches) AS t FROM s), k AS (SELECT *, t.term AS technical_term, coalesce(t.category, 'UNKNOWN') AS technical_category FROM l)"),
        "gold_topic": _gold("topic_id, topic_label", where="WHERE topic_id IS NOT NULL AND topic_label IS NOT NULL", names=("topic_label",)),
        "gold_entity": _gold("entity_source, entity_label, entity", "k", "WHERE entity IS NOT NULL", ctes=S + """,
 t AS (SELECT *, unnest(tech_lexicon_matches) AS x FROM s), n AS (SELECT *, unnest(from_json(named_entities, '[{"text":"VARCHAR","label":"VARCHAR"}]')) AS x FROM s WHERE trim(named_entities) <> ''),
 k AS (SELECT * EXCLUDE (x), 'technical_lexicon' AS entity_source, coalesce(x.category, 'UNKNOWN') AS entity_label, x.term AS entity FROM t
  UNION ALL SELECT * EXCLUDE (x), 'spacy_ner', x.label, x.text FROM n)"""),
        "gold_sample": f"WITH {S} SELECT message_id, conversation_id, text_cleaned FROM s ORDER BY md5('42::' || message_id::VARCHAR), message_id LIMIT 1000",
        "dedup_messages": f'WITH {BRONZE} SELECT min(row_id) AS row_id, date, "from", text FROM b GROUP BY date, "from", text',
        "stable_ids": f"""WITH {BRONZE} SELECT row_id, conversation_id, sha256(conversation_id || '::' || strftime(date, '%Y-%m-%d %H:%M:%S.%f') || '::' || coalesce("from", '<NULL>') || '::' || coalesce("to", '<NULL>') || '::' || text) AS message_id FROM c""",
        "participant_inference": f"""WITH {BRONZE},
 p AS (SELECT *, count(DISTINCT "from") OVER (PARTITION BY conversation_id) AS n, min("from") OVER (PARTITION BY conversation_id) AS one, max("from") OVER (PARTITION BY conversation_id) AS two FROM c),
 i AS (SELECT * REPLACE (coalesce("from", CASE WHEN n = 2 AND "to" = one THEN two WHEN n = 2 AND "to" = two THEN one END) AS "from") FROM p),
 k AS (SELECT *, row_number() OVER (PARTITION BY conversation_id ORDER BY date, row_id) AS nr FROM i WHERE "from" IS NOT NULL)
 SELECT row_id, "from", coalesce("to", CASE WHEN n <= 1 THEN '__UNANSWERED__' WHEN nr = 1 THEN '__ALL__' WHEN n = 2 THEN CASE WHEN "from" = one THEN two WHEN "from" = two THEN one END ELSE '__ALL__' END) AS "to" FROM k""",
        "turn_features": f"""WITH {DATED} SELECT message_id, row_number() OVER w - 1 AS turn_count, "from" = first_value("from") OVER w AS is_op, round({gap}, 6) AS response_gap_mins,
 round(CASE WHEN "from" <> lag("from") OVER w THEN {gap} END, 6) AS response_gap_mins_between_speakers FROM m {turn}""",
        "user_activity": f"""WITH {DATED}, u AS (SELECT message_id, row_number() OVER (PARTITION BY "from" ORDER BY date, message_id) AS user_message_count, count(*) OVER (PARTITION BY "from", date_trunc('month', date)) AS user_messages_this_month FROM m)
 SELECT *, {buckets('user_messages_this_month', *TIER_BOUNDS)} AS user_tier FROM u""",
        "conversation_bounds": f"""WITH {DATED}, g AS (SELECT conversation_id, min(date) AS conversation_start, max(date) AS conversation_end, count(*) AS conversation_message_count, count(DISTINCT "from") > 1 AS conversation_was_answered FROM m GROUP BY 1),
 p AS (SELECT conversation_id, count(DISTINCT x) AS n FROM (SELECT conversation_id, unnest(["from", "to"]) AS x FROM m) WHERE x NOT IN ({_SENT}) GROUP BY 1)
 SELECT message_id, g.* EXCLUDE (conversation_id), coalesce(n, 0) AS conversation_participant_count, round((epoch_us(conversation_end) - epoch_us(conversation_start)) / 60000000.0::DOUBLE, 6) AS conversation_duration_mins
 FROM m JOIN g USING (conversation_id) LEFT JOIN p USING (conversation_id)""",
        "length_buckets": f"""WITH t AS (SELECT row_id, length(coalesce(text, '')) AS text_length, {word_count} AS word_count FROM dialoguetext_196)
 SELECT *, {buckets('text_length', *TEXT_BOUNDS)} AS text_length_bucket, {buckets('word_count', *WORD_BOUNDS)} AS word_count_bucket FROM t""",
        "gap_buckets": f"""WITH {DATED}, t AS (SELECT CASE WHEN "from" <> lag("from") OVER w THEN {gap} END AS g FROM m {turn}) SELECT {buckets('g', *GAP_BOUNDS)} AS response_gap_bucket, count(*) AS messages FROM t GROUP BY 1""",
        "message_calendar": f"WITH {S} SELECT message_id, year(date)::INT AS year, month(date)::INT AS month, day(date)::INT AS day, dayname(date) AS day_of_week, hour(date)::INT AS hour FROM s WHERE date IS NOT NULL",
        "parsed_dates": f"SELECT row_id, ({DATE} AT TIME ZONE 'UTC') AS moment FROM dialoguetext_196",
        "release_distance": f"""WITH {S}, t AS (SELECT message_id, {since}::DOUBLE AS days_since_release, {until}::DOUBLE AS days_until_release FROM s WHERE date IS NOT NULL)
 SELECT *, {buckets('days_since_release', *RELEASE_BOUNDS)} AS days_since_release_bucket, {buckets('days_until_release', *RELEASE_BOUNDS)} AS days_until_release_bucket FROM t""",
        "asof_calendar": f"WITH {S} SELECT message_id, release_name FROM s ASOF LEFT JOIN (SELECT release_name, (release_date AT TIME ZONE 'UTC') AS r FROM release_calendar) ON s.date >= r",
        "asof_next_release": f"WITH {S} SELECT message_id, release_name FROM s ASOF LEFT JOIN (SELECT release_name, (release_date AT TIME ZONE 'UTC') AS r FROM release_calendar) ON s.date <= r",
        "first_message": f"WITH {DATED} SELECT conversation_id, message_id FROM (SELECT conversation_id, message_id, row_number() OVER (PARTITION BY conversation_id ORDER BY date, message_id) AS nr FROM m) WHERE nr = 1",
        "conversation_sample": f"""WITH {S}, k AS (SELECT DISTINCT conversation_id FROM s WHERE conversation_id IS NOT NULL ORDER BY md5('42::' || conversation_id::VARCHAR), conversation_id LIMIT 200) SELECT conversation_id, message_id FROM s SEMI JOIN k USING (conversation_id)""",
        "character_counts": "SELECT ch, count(*) AS occurrences FROM (SELECT unnest(string_split(coalesce(text, ''), '')) AS ch FROM dialoguetext_196) WHERE ch <> '' AND NOT regexp_full_match(ch, '[A-Za-z ]') GROUP BY 1",
        "single_word_terms": f"""SELECT row_id, term, count(*) AS occurrences FROM (SELECT row_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '{_WORD}+')) AS term FROM dialoguetext_196) WHERE term IN (SELECT lower(term) FROM tech_lexicon) GROUP BY 1, 2""",
        "match_tallies": f"WITH {S} SELECT 'technical' AS lexicon, term, count(*) AS occurrences FROM (SELECT lower(unnest(tech_lexicon_matches).term) AS term FROM s) GROUP BY 2",
        "token_vocabulary": f"""SELECT lower(t) AS word, count(*) AS count FROM (SELECT unnest({_TOKENS}) AS t FROM dialoguetext_196) WHERE NOT regexp_full_match(t, '\\d+')
 AND lower(t) NOT IN ('jargon', 'nonword', 'uncertain', 'ssn', 'emailaddress', 'websitedomain', 'phonenumber', 'ipaddress', 'ipv6address', 'menupath', 'keyboardshortcut', {_ALL.lower()}) GROUP BY 1""",
        "backend_agreement": f"WITH {S} SELECT count(*) AS rows, round(avg((vader_label = transformer_label)::INT), 6) AS label_agreement, round(corr(vader_compound, transformer_expected_sentiment), 6) AS score_correlation FROM s WHERE vader_label IS NOT NULL AND transformer_label IS NOT NULL",
        "describe_numeric": f"""WITH {S}, t AS ({_stack(numbers, 's')}) SELECT feature, count(*) AS count, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std, round(min(value), 6) AS min,
 {', '.join(f"round(quantile_cont(value, {q / 100}), 6) AS p{q:02d}" for q in (1, 5, 25, 50, 75, 95, 99))}, round(max(value), 6) AS max FROM t GROUP BY 1""",
        "shape_numeric": f"WITH t AS ({_stack(['l_quantity', 'l_extendedprice', 'l_discount'], 'lineitem')}) SELECT feature, count(*) AS n, round(skewness(value), 4) AS skewness, round(kurtosis(value), 4) AS kurtosis FROM t GROUP BY 1",
        "outliers": f"""WITH t AS ({_stack(['l_quantity', 'l_extendedprice'], 'lineitem')}),
 q AS (SELECT feature, quantile_cont(value, 0.25) AS a, quantile_cont(value, 0.75) AS b, avg(value) AS m, stddev_samp(value) AS s FROM t GROUP BY 1)
 SELECT feature, round(a - 1.5 * (b - a), 6) AS lower, round(b + 1.5 * (b - a), 6) AS upper, count(*) AS n, count(*) FILTER (value < a - 1.5 * (b - a) OR value > b + 1.5 * (b - a)) AS iqr_outliers,
 count(*) FILTER (abs(value - m) > 3 * s) AS z_outliers FROM t JOIN q USING (feature) GROUP BY feature, a, b""",
        "pearson_matrix": f"WITH {S} " + _pairs(numbers, "SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS r, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n FROM s"),
        "spearman_matrix": f"WITH {S} " + _pairs(numbers[:3], """SELECT '{a}' AS feature_a, '{b}' AS feature_b, CASE WHEN count(*) >= 100 THEN round(corr(x, y), 6) END AS rho, count(*) AS n FROM (
 SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2.0 AS x, rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2.0 AS y FROM s WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""),
        "confusion": f"WITH {S} SELECT upper(transformer_label) AS actual, upper(vader_label) AS predicted, count(*) AS n FROM s WHERE transformer_label IS NOT NULL AND vader_label IS NOT NULL GROUP BY 1, 2",
        "evaluation_metrics": f"""WITH {S},
 e AS (SELECT vader_label AS y, transformer_label AS g, transformer_negative / t AS a, transformer_neutral / t AS b, transformer_positive / t AS c FROM (SELECT *, transformer_negative + transformer_neutral + transformer_positive AS t FROM s) WHERE transformer_label IS NOT NULL AND t IS NOT NULL),
 k AS (SELECT *, greatest(a, b, c) AS conf, CASE y WHEN 'NEGATIVE' THEN a WHEN 'NEUTRAL' THEN b ELSE c END AS p FROM e WHERE y IS NOT NULL),
 l AS (SELECT unnest(['NEGATIVE', 'NEUTRAL', 'POSITIVE']) AS lab),
 r AS (SELECT lab, count(*) FILTER (y = lab AND g = lab) AS tp, count(*) FILTER (g = lab) AS gn, count(*) FILTER (y = lab) AS yn FROM k, l GROUP BY 1),
 q AS (SELECT coalesce(tp / nullif(yn, 0)::DOUBLE, 0) AS rec, coalesce(tp / nullif(gn, 0)::DOUBLE, 0) AS pre FROM r),
 z AS (SELECT count(*) / (SELECT count(*) FROM k)::DOUBLE * abs(avg((y = g)::INT) - avg(conf)) AS x FROM k GROUP BY least(floor(conf * 10), 9))
 SELECT 'coverage' AS metric, round((SELECT count(*) FROM k) / (SELECT count(y) FROM e)::DOUBLE, 6) AS value
 UNION ALL SELECT 'accuracy', round((SELECT avg((y = g)::INT) FROM k), 6) UNION ALL SELECT 'macro_f1', round((SELECT avg(CASE WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0 END) FROM q), 6)
 UNION ALL SELECT 'balanced_accuracy', round((SELECT avg(rec) FROM q), 6)
 UNION ALL SELECT 'multiclass_brier_score', round((SELECT avg(pow(a - (y = 'NEGATIVE')::INT, 2) + pow(b - (y = 'NEUTRAL')::INT, 2) + pow(c - (y = 'POSITIVE')::INT, 2)) FROM k), 6)
 UNION ALL SELECT 'log_loss', round((SELECT avg(-ln(least(greatest(p, 1e-15), 1))) FROM k), 6) UNION ALL SELECT 'expected_calibration_error', round((SELECT sum(x) FROM z), 6)""",
        "key_figures": f"WITH {SUMMARY} SELECT count(*) AS conversations, coalesce(sum(message_count), 0)::BIGINT AS messages, round(avg(conversation_was_answered::INT), 6) AS answer_rate, round(avg(avg_vader_compound), 6) AS mean_sentiment FROM q",
        "topic_answer_rates": f"WITH {SUMMARY} SELECT most_common_topic AS topic, count(*) AS conversations, round(avg(conversation_was_answered::INT), 6) AS answer_rate FROM q WHERE most_common_topic IS NOT NULL GROUP BY 1 HAVING count(*) >= 25 ORDER BY 2 DESC, 1 LIMIT 15",
        "topic_priorities": f"WITH {SUMMARY}, t AS (SELECT most_common_topic AS topic, count(*) AS conversations, avg(conversation_was_answered::INT) AS r FROM q WHERE most_common_topic IS NOT NULL GROUP BY 1 HAVING count(*) >= 25) SELECT topic, conversations, round(r, 6) AS answer_rate, round((1 - r) * ln(1 + conversations), 6) AS priority FROM t",
        "monthly_sentiment": f"""WITH {SUMMARY} SELECT date_trunc('month', conversation_start)::TIMESTAMP AS month, round(sum(avg_vader_compound * message_count) / nullif(sum(CASE WHEN avg_vader_compound IS NOT NULL THEN message_count END), 0), 6) AS sentiment,
 sum(message_count)::BIGINT AS messages FROM q WHERE conversation_start IS NOT NULL GROUP BY 1""",
        "conversation_buckets": f"WITH {SUMMARY} SELECT {buckets('message_count', *MESSAGE_COUNT_BOUNDS)} AS message_count_bucket, {buckets('conversation_duration_mins', *DURATION_BOUNDS)} AS duration_bucket, count(*) AS conversations FROM q GROUP BY 1, 2",
        "ended_by_opener": f'WITH {DATED} SELECT conversation_id, arg_min("from", struct_pack(d := date, i := message_id)) = arg_max("from", struct_pack(d := date, i := message_id)) AS ended_by_op FROM m GROUP BY 1',
        "weekday_by_hour": f"WITH {S} SELECT hour(date)::INT AS hour, {', '.join(f'''count(*) FILTER (dayname(date) = '{w}') AS "{w}"''' for w in weekdays)} FROM s WHERE date IS NOT NULL GROUP BY 1",
        "cross_tab": f"WITH {FIRST} SELECT topic_label, count(*) FILTER (NOT answered) AS no, count(*) FILTER (answered) AS yes FROM w WHERE topic_label IS NOT NULL GROUP BY 1 HAVING count(*) >= 30",
        "release_bucket_measures": f"""WITH {S} SELECT days_since_release_bucket, count(*) AS messages, round(avg(text_length), 6) AS mean_text_length, round(quantile_cont(text_length, 0.5), 6) AS median_text_length,
 round(avg(word_count), 6) AS mean_word_count, round(quantile_cont(word_count, 0.5), 6) AS median_word_count FROM s GROUP BY 1""",
        "value_counts": f"WITH {S} SELECT channel, count(*) AS count, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) AS proportion FROM s GROUP BY 1",
        "multiparty": f"""WITH {S}, p AS (SELECT count(DISTINCT "from") AS k, count(*) AS n FROM s GROUP BY conversation_id)
 SELECT count(*) AS conversations, count(*) FILTER (k > 2) AS multiparty, coalesce(sum(n) FILTER (k > 2), 0)::BIGINT AS rows_affected, round(count(*) FILTER (k > 2) / count(*)::DOUBLE, 6) AS share FROM p""",
        "monthly_volume": f"WITH {S} SELECT year(date)::INT AS year, month(date)::INT AS month, count(*) AS messages FROM s WHERE date IS NOT NULL GROUP BY 1, 2",
        "duplicate_figures": f"""WITH {BRONZE}, g AS (SELECT count(*) AS n, count(DISTINCT coalesce(folder::VARCHAR, '')) AS w FROM b GROUP BY date, "from", text)
 SELECT sum(n)::BIGINT AS rows, count(*) AS groups, sum(n - 1)::BIGINT AS duplicates, sum(n - w)::BIGINT AS duplicates_within FROM g""",
        "most_common": f'WITH {S} SELECT "from", count(*) AS count FROM s WHERE "from" IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20',
        "missing_report": f"WITH {S} " + " UNION ALL ".join(f"""SELECT '{c}' AS "column", round(1 - count({c}) / count(*)::DOUBLE, 6) AS missing_share, count(DISTINCT {c}) AS distinct_values, count(DISTINCT {c}) <= 1 AS constant FROM s""" for c in ("channel", "topic_id", "transformer_score", "vader_label", "date")),
        "participants_melted": f"""WITH {S}, x AS (SELECT 'from' AS role, "from" AS person FROM s UNION ALL SELECT 'to', "to" FROM s) SELECT role, count(*) AS rows, count(DISTINCT person) AS people FROM x WHERE person IS NOT NULL GROUP BY 1""",
        "release_rollup": f"WITH {S} SELECT days_since_release_bucket, channel, count(*) AS message_count, grouping_id(days_since_release_bucket, channel) AS level FROM s GROUP BY ROLLUP (days_since_release_bucket, channel)",
        "silver_violations": f"""WITH {S} SELECT count(*) AS rows, count(*) FILTER (coalesce(len(tech_lexicon_matches), 0) <> tech_lexicon_match_count) AS tech_count_differs, count(*) FILTER (abs(vader_compound) > 1) AS compound_range,
 count(*) FILTER (abs(transformer_negative + transformer_neutral + transformer_positive - 1) > 0.01) AS probability_sum, count(*) FILTER ((topic_id IS NULL) <> (topic_label IS NULL)) AS topic_half_set FROM s""",
        "csv_round_trip": "SELECT row_id::VARCHAR AS row_id, folder::VARCHAR AS folder, " + ", ".join(f"nullif({c}, '') AS {c}" for c in ("dialogue_id", "date", '"from"', '"to"', "text")) + " FROM dialoguetext_196",
        "stream_daily_counts": "SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 DAY AS window_end, count(*) AS message_count FROM events GROUP BY 1",
        "applied_labels": APPLIED + " SELECT * FROM applied",
        "nonword_rate": APPLIED + f", t AS (SELECT unnest({_TOKENS.replace('text', 'text_cleaned')}) AS t FROM applied) SELECT count(*) AS tokens, count(*) FILTER (t = 'NONWORD') AS nonwords, round(count(*) FILTER (t = 'NONWORD') / count(*)::DOUBLE, 6) AS rate FROM t",
        "inflation": _inflation(numbers),
        "answer_tests": _answer_tests(),
        "review_export": f"WITH {S} SELECT lower(w) AS word, count(*) AS count, '' AS classification_label, 'manual_review' AS classification_source FROM (SELECT unnest(residual_words) AS w FROM s) WHERE w IS NOT NULL GROUP BY 1",
        "probability_measures": f"""WITH {S}, p AS (SELECT message_id, transformer_negative / t AS a, transformer_neutral / t AS b, transformer_positive / t AS c FROM (SELECT *, transformer_negative + transformer_neutral + transformer_positive AS t FROM s) WHERE t IS NOT NULL),
 e AS (SELECT *, greatest(a, b, c) AS m, -(CASE WHEN a > 0 THEN a * ln(a) ELSE 0 END + CASE WHEN b > 0 THEN b * ln(b) ELSE 0 END + CASE WHEN c > 0 THEN c * ln(c) ELSE 0 END) AS h FROM p)
 SELECT message_id, round(a, 6) AS model_negative, round(b, 6) AS model_neutral, round(c, 6) AS model_positive, CASE m WHEN a THEN 'NEGATIVE' WHEN b THEN 'NEUTRAL' ELSE 'POSITIVE' END AS model_label, round(m, 6) AS model_score, round(h, 6) AS model_entropy,
  round(h / ln(3), 6) AS model_normalized_entropy, round(m - (a + b + c - m - least(a, b, c)), 6) AS model_margin, round(c - a, 6) AS expected_sentiment FROM e""",
        "transformer_checks": f"""WITH {S}, x AS (SELECT transformer_negative AS a, transformer_neutral AS b, transformer_positive AS c, transformer_label AS l FROM s)
 SELECT count(*) AS rows, count(*) FILTER ((a IS NOT NULL OR b IS NOT NULL OR c IS NOT NULL) AND (a IS NULL OR b IS NULL OR c IS NULL OR l IS NULL)) AS transformer_incomplete, count(*) FILTER (a < 0 OR a > 1 OR b < 0 OR b > 1 OR c < 0 OR c > 1) AS transformer_out_of_range,
 count(*) FILTER (abs(a + b + c - 1) > 1e-5) AS transformer_sum, count(*) FILTER (l NOT IN ('NEGATIVE', 'NEUTRAL', 'POSITIVE')) AS transformer_label_unknown FROM x""",
        "bad_json_cells": f"WITH {S}, c AS (SELECT CASE WHEN message_id % 7 = 0 THEN 'x' || named_entities ELSE named_entities END AS j FROM s) SELECT count(*) AS rows, count(*) FILTER (trim(j) <> '' AND NOT json_valid(j)) AS malformed FROM c",
        "collection_cells": f"WITH {S} SELECT message_id, coalesce(array_to_string(residual_words, ' '), '') AS words FROM s",
        "minute_dates": f"WITH {S} SELECT message_id, date_trunc('minute', date)::TIMESTAMP AS date FROM s",
        "filtered_summary": f"WITH {SUMMARY} SELECT conversation_id, message_count FROM q WHERE conversation_was_answered AND conversation_start >= TIMESTAMP '2010-01-01' AND conversation_start < TIMESTAMP '2013-01-01'",
        "longest_messages": f"WITH {S} SELECT message_id, text_length FROM s ORDER BY text_length DESC NULLS LAST, message_id LIMIT 10",
        "clipped_lengths": f"WITH {S} SELECT count(*) AS rows, max(text_length) AS longest FROM s WHERE text_length <= (SELECT quantile_cont(text_length, 0.99) FROM s)",
        "feature_transforms": f"WITH {S}, t AS ({_stack(numbers, 's')}) SELECT feature, CASE WHEN abs(skewness(value)) <= 2 THEN 'none' WHEN abs(skewness(value)) <= 5 THEN 'log1p' ELSE 'yeo_johnson' END AS transform, round(avg(CASE WHEN value >= 0 THEN (sqrt(value + 1) - 1) / 0.5 ELSE -(pow(1 - value, 1.5) - 1) / 1.5 END), 6) AS mean_power FROM t GROUP BY 1",
        "topic_dummies": f"WITH {S} SELECT count(*) FILTER (vader_label = 'NEUTRAL') AS neutral, count(*) FILTER (vader_label = 'POSITIVE') AS positive FROM s",
        "eligible_features": f"WITH {S}, t AS ({_stack(['text_length', 'word_count', 'vader_compound'], 's')}) SELECT feature FROM t GROUP BY 1 HAVING count(DISTINCT value) > 1",
        "model_rows": f"""WITH {FIRST}, l AS (SELECT message_id, answered::INT::DOUBLE AS label, text_length FROM w),
 u AS (SELECT *, ('0x' || substr(md5('42::' || CASE WHEN label = 1 THEN '1.0' ELSE '0.0' END || '|' || message_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM l)
 SELECT message_id, label, CASE WHEN u < 0.6 THEN 'train' WHEN u < 0.8 THEN 'validation' ELSE 'test' END AS part, text_length FROM u""",
        "ranking_quality": f"""WITH {S}, x AS (SELECT round(transformer_positive, 6) AS t, transformer_positive AS r, (vader_label = 'POSITIVE')::INT AS y FROM s WHERE transformer_positive IS NOT NULL AND vader_label IS NOT NULL),
 n AS (SELECT sum(y)::DOUBLE AS p, sum(1 - y)::DOUBLE AS q FROM x), g AS (SELECT t, sum(y)::DOUBLE AS a, sum(1 - y)::DOUBLE AS b FROM x GROUP BY 1),
 c AS (SELECT *, sum(a) OVER (ORDER BY t DESC) AS tp, sum(b) OVER (ORDER BY t DESC) AS fp FROM g),
 m AS (SELECT count(*) FILTER (r >= 0.5 AND y = 1)::DOUBLE AS tp, count(*) FILTER (r >= 0.5 AND y = 0)::DOUBLE AS fp, count(*) FILTER (r < 0.5 AND y = 1)::DOUBLE AS fn, count(*) FILTER (r < 0.5 AND y = 0)::DOUBLE AS tn FROM x),
 v AS (SELECT (SELECT sum(b * (tp - a / 2)) / (SELECT p * q FROM n) FROM c) AS roc_auc, (SELECT sum(a / (SELECT p FROM n) * tp / (tp + fp)) FROM c) AS average_precision, (SELECT max(2 * tp / (tp + fp + (SELECT p FROM n))) FROM c) AS best_f1,
  tp, fp, fn, tn, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall, coalesce(tn / nullif(tn + fp, 0), 0) AS specificity, coalesce(tn / nullif(tn + fn, 0), 0) AS npv,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy, (tp + fp) / (tp + fp + fn + tn) AS flagged_share FROM m)
 SELECT metric, round(value, 6) AS value FROM (UNPIVOT v ON COLUMNS(*) INTO NAME metric VALUE value)""",
        "stage_metrics": """WITH n AS (SELECT (SELECT count(*) FROM dialoguetext_196) AS i, (SELECT count(*) FROM silver) AS o)
 SELECT 'check' AS pipeline, 'stage' AS stage, 'ok' AS status, i AS rows_in, o AS rows_out, 2.5::DOUBLE AS seconds, round(i / 2.5::DOUBLE, 6) AS rows_per_second, round(2500.0::DOUBLE / i, 6) AS ms_per_row_in, round(2500.0::DOUBLE / o, 6) AS ms_per_row_out FROM n""",
        "streamed_sessions": """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS f FROM events WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 n AS (SELECT *, sum(f) OVER (PARTITION BY user_id ORDER BY ts) AS nr FROM g), s AS (SELECT user_id::VARCHAR AS user_name, min(ts) AS session_start, max(ts) AS session_end, count(*) AS event_count FROM n GROUP BY user_id, nr)
 SELECT * FROM s WHERE session_end + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
        "gold_validation": f"""WITH {S} SELECT 'conversation' AS level, count(DISTINCT coalesce(conversation_id::VARCHAR, '')) AS rows FROM s UNION ALL SELECT 'user', count(DISTINCT u) FROM (SELECT "from" AS u FROM s UNION ALL SELECT "to" FROM s)
 UNION ALL SELECT 'date', count(DISTINCT date::DATE) FROM s UNION ALL SELECT 'channel', count(DISTINCT channel) FROM s UNION ALL SELECT 'release', count(DISTINCT coalesce(days_since_release_bucket, '')) FROM s
 UNION ALL SELECT 'residual', count(DISTINCT w) FROM (SELECT unnest(residual_words) AS w FROM s) UNION ALL SELECT 'technical', count(DISTINCT (t.term, coalesce(t.category, 'UNKNOWN'))) FROM (SELECT unnest(tech_lexicon_matches) AS t FROM s) WHERE t.term IS NOT NULL
 UNION ALL SELECT 'topic', count(DISTINCT (topic_id, topic_label)) FROM s WHERE topic_id IS NOT NULL AND topic_label IS NOT NULL""",
        "user_profile": f"""WITH {DATED}, op AS (SELECT conversation_id, arg_min("from", struct_pack(d := date, i := message_id)) AS o FROM m GROUP BY 1),
 own AS (SELECT "from" AS u, conversation_id, count(*) AS n, avg(word_count) AS w FROM m GROUP BY 1, 2),
 per AS (SELECT u, avg((o = u)::INT) AS op_rate, count(*) AS conversations, avg(n) AS amc, avg(w) AS awc FROM own JOIN op USING (conversation_id) GROUP BY 1),
 sent AS (SELECT "from" AS u, count(*) AS sent, {mode_of('month(date)::INT')} AS usual_month, {mode_of('year(date)::INT')} AS usual_year, min(date) AS first_seen, max(date) AS last_seen FROM m GROUP BY 1),
 got AS (SELECT "to" AS u, count(*) AS received FROM m WHERE "to" IS NOT NULL GROUP BY 1)
 SELECT u AS "user", sent, usual_month, usual_year, first_seen, last_seen, coalesce(received, 0) AS received, round(op_rate, 6) AS op_rate, conversations, round(amc, 6) AS avg_messages_per_conversation,
 round(awc, 6) AS avg_words_per_conversation, date_diff('day', first_seen, last_seen)::INT AS active_days, round(sent / nullif(date_diff('day', first_seen, last_seen), 0)::DOUBLE, 6) AS messages_per_active_day
 FROM sent LEFT JOIN got USING (u) LEFT JOIN per USING (u)""",
    }

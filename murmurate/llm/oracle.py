"""SQL twins of the llm queries, for DuckDB over the same Parquet tables."""

from __future__ import annotations

from murmurate.plans.oracle import moment


def _p4() -> str:
    from murmurate.llm import queries as q
    from murmurate.llm.sampling import raise_thresholds, threshold_of

    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in raise_thresholds({}, q.SAMPLE_RATES).items())
    return f"""
WITH s AS (
  SELECT message_id, coalesce(channel, '') AS stratum, load_batch, ingested_at,
    ('0x' || substr(md5('{q.SAMPLE_SALT}|' || message_id::VARCHAR), 1, 8))::BIGINT AS key_hash
  FROM silver WHERE message_id IS NOT NULL),
k AS (SELECT *, row_number() OVER (PARTITION BY message_id ORDER BY load_batch NULLS FIRST, ingested_at NULLS FIRST, stratum) AS nr
  FROM s WHERE key_hash < CASE stratum {cases} ELSE {threshold_of(q.SAMPLE_DEFAULT)} END)
SELECT message_id, stratum, key_hash FROM k WHERE nr = 1"""


def _p4_thresholds() -> str:
    rows = {"#help": 0.05, "#offtopic": 0.02, **dict.fromkeys((f"#help-{x}" for x in ("es", "de", "fr", "nl", "pt", "it", "ru")), 0.4), None: 0.1}
    named = lambda k: "NULL" if k is None else f"'{k}'"
    return "SELECT stratum, round(rate * 4294967296)::BIGINT AS threshold FROM (VALUES " + ", ".join(f"({named(k)}, {v}::DOUBLE)" for k, v in rows.items()) + ") r(stratum, rate)"


#: What the word patterns take as a letter; the tables hold no letter-like numbers.
_LETTERS = "\\p{L}"
P6 = """
WITH m AS (SELECT message_id, first(residual_words) AS w, first(tech_lexicon_matches) AS t FROM silver WHERE message_id IS NOT NULL GROUP BY message_id),
n AS (SELECT count(*) AS total FROM m),
e AS (
  SELECT 'residual_words' AS field_name, message_id, lower(unnest(w)) AS term FROM m
  UNION ALL SELECT 'tech_lexicon_matches', message_id, lower(unnest(list_transform(t, lambda x: x.term))) FROM m),
c AS (SELECT field_name, term, count(*) AS occurrences, count(DISTINCT message_id) AS records FROM e WHERE term IS NOT NULL GROUP BY 1, 2),
r AS (SELECT field_name, term, occurrences, records,
  CASE WHEN records <= 2 THEN 'rare' WHEN records > 0.02 * total THEN 'common' END AS mark FROM c, n)
"""


P9 = """
WITH d AS (SELECT doc_id, max(struct_pack(n := coalesce(length(text), 0), s := source)) AS x FROM documents WHERE doc_id IS NOT NULL AND source IS NOT NULL GROUP BY doc_id),
e AS (SELECT doc_id, x.s AS source, x.n AS tokens, ('0x' || substr(md5('mix-1|' || doc_id::VARCHAR), 1, 8))::BIGINT AS h FROM d),
a AS (SELECT source, sum(tokens)::BIGINT AS available FROM e GROUP BY 1),
t AS (SELECT source, sum(target_share) AS target_share, max(max_repeats) AS max_repeats FROM mix_targets WHERE source IS NOT NULL GROUP BY 1),
r AS (SELECT source, target_share, max_repeats, coalesce(available, 0) AS available FROM t LEFT JOIN a USING (source)),
b AS (SELECT *, least(floor(target_share * (SELECT sum(available) FROM r WHERE target_share > 0 AND max_repeats > 0)), available * max_repeats)::BIGINT AS budget FROM r),
o AS (SELECT e.*, budget // nullif(available, 0) AS full_uses, budget % nullif(available, 0) - (sum(tokens) OVER (PARTITION BY source ORDER BY h, doc_id) - tokens) AS room FROM e JOIN b USING (source)),
u AS (SELECT source, doc_id, tokens, coalesce(full_uses, 0) AS full_uses, greatest(least(coalesce(room, 0), tokens), 0)::BIGINT AS partial_tokens FROM o),
m AS (SELECT *, (tokens * full_uses + partial_tokens)::BIGINT AS used_tokens FROM u WHERE full_uses > 0 OR partial_tokens > 0)
"""


_NICK = "nullif(lower(trim({c}, ' ' || chr(9) || chr(10) || chr(13) || chr(160))), '')"
P7 = f"""
WITH m AS (SELECT row_id, folder, try_cast(nullif(regexp_extract(dialogue_id, '\\d+'), '') AS BIGINT) AS dialogue, epoch_us({moment('date')}) AS us, {_NICK.format(c='"from"')} AS who, {_NICK.format(c='"to"')} AS aim,
 regexp_matches(coalesce(text, ''), '[^\\s\\x0B\\x{{85}}\\p{{Z}}]') AS said FROM dialoguetext_196),
k AS (SELECT * FROM m WHERE folder IS NOT NULL AND dialogue IS NOT NULL),
f AS (SELECT folder, dialogue, count(*) FILTER (said) AS n, count(*) FILTER (said AND us IS NULL) AS bad, count(DISTINCT who) FILTER (said) AS people, min(who) FILTER (said) AS one, max(who) FILTER (said) AS two,
 count(*) FILTER (said AND who IS NULL) AS lost FROM k GROUP BY 1, 2),
o AS (SELECT folder, dialogue, bool_and(coalesce(aim IN (one, two), false)) AS known FROM k JOIN f USING (folder, dialogue) WHERE said AND who IS NULL GROUP BY 1, 2),
v AS (SELECT f.*, CASE WHEN n = 0 THEN 'empty' WHEN bad > 0 OR (lost > 0 AND NOT (people = 2 AND known)) THEN 'broken' WHEN people < 2 THEN 'no_reply' END AS reason FROM f LEFT JOIN o USING (folder, dialogue))
"""
_CANON = "regexp_replace(replace(lower(upper({c})), 'ß', 'ss'), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
P2 = f"""
WITH raw AS (SELECT raw_id AS id, payload, replace(replace(payload, '\\\\', '\ue000'), '\\"', '\ue001') AS p FROM raw_exports),
obj AS (SELECT id, CASE WHEN regexp_matches(payload, '^\\s*\\{{') AND json_valid(payload) THEN payload END AS j,
 CASE WHEN regexp_full_match(p, '(?is)\\s*(?:(?:date|from|text)\\s*[:=]\\s*"[^"]*"\\s*[,;|]?\\s*){{3}}') AND NOT regexp_matches(p, '[,;|]\\s*$') THEN p END AS p FROM raw),
flat AS (SELECT id, CASE WHEN j IS NOT NULL THEN map_from_entries(list_transform(list_filter(json_keys(j), lambda k: lower(k) IN ('date', 'from', 'text')), lambda k: {{'k': lower(k), 'v': json_extract_string(j, '$."' || k || '"')}}))
 WHEN p IS NOT NULL AND len(list_distinct(list_transform(regexp_extract_all(p, '(?i)(date|from|text)\\s*[:=]\\s*"[^"]*"', 1), lambda k: lower(k)))) = 3 THEN map_from_entries(list_zip(list_transform(regexp_extract_all(p, '(?i)(date|from|text)\\s*[:=]\\s*"[^"]*"', 1), lambda k: lower(k)),
  list_transform(regexp_extract_all(p, '(?i)(?:date|from|text)\\s*[:=]\\s*"([^"]*)"', 1), lambda v: replace(replace(v, '\ue001', '"'), '\ue000', '\\')))) END AS f FROM obj),
rec AS (SELECT 'dialoguetext_196' AS record_table, row_id AS id, date AS d, "from" AS w, text AS x FROM dialoguetext_196 UNION ALL SELECT 'raw_exports', id, f['date'], f['from'], f['text'] FROM flat),
can AS (SELECT record_table, id, epoch_us({moment('d')}) AS us, {_NICK.format(c='w')} AS who, nullif({_CANON.format(c='x')}, '') AS c FROM rec),
run AS (SELECT record_table, id, us IS NOT NULL AND who IS NOT NULL AND c IS NOT NULL AS is_case, min(id) OVER (PARTITION BY record_table, us, who, c) AS first_id FROM can)
"""


def sql() -> dict[str, str]:
    return {
        "p4_sample": _p4(),
        "p3_words": f"""WITH w AS (SELECT row_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_LETTERS}+(?:[''’]{_LETTERS}+)*') AS w FROM dialoguetext_196 WHERE row_id IS NOT NULL)
SELECT row_id, len(w) AS words, length(regexp_extract(t, '^(?:[^\\p{{L}}]*)')) AS first_pos, length(t) - length(regexp_extract(t, '[^\\p{{L}}]*$')) AS end_pos FROM w WHERE len(w) > 0""",
        "p5_plain_emails": """WITH e AS (SELECT row_id, text, unnest(regexp_extract_all(text, '[\\p{L}\\p{N}_+-]+(?:[.][\\p{L}\\p{N}_+-]+)*@(?:\\p{L}[\\p{L}\\p{N}_-]*[.])+\\p{L}{2,}')) AS email FROM dialoguetext_196 WHERE row_id IS NOT NULL)
SELECT row_id, strpos(text, email) - 1 AS start_pos, email FROM e""",
        "p8_faults": "SELECT count(DISTINCT doc_id) AS documents, 0 AS split_needlessly, 0 AS wrong_pieces, 0 AS repeated_pieces, 0 AS overfull_containers FROM documents",
        "p10_words": f"SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_LETTERS}+')) AS words, len(regexp_extract_all(coalesce(text, ''), '{_LETTERS}+')) > 0 AS scored FROM documents",
        "p10_sources": f"SELECT source, count(*) AS documents, sum(len(regexp_extract_all(coalesce(text, ''), '{_LETTERS}+')))::BIGINT AS words FROM documents GROUP BY 1",
        "p4_thresholds": _p4_thresholds(),
        "p4_kept": """WITH s AS (SELECT message_id, ('0x' || substr(md5('silver-1|' || message_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u, CASE WHEN regexp_full_match(channel, '#help-(es|de|fr|nl|pt|it|ru)') THEN 0.4 ELSE 0.1 END AS rate FROM silver WHERE message_id IS NOT NULL),
k AS (SELECT message_id, bool_or(u < 0.1) AS e, bool_or(u < rate) AS l FROM s GROUP BY 1) SELECT count(*) FILTER (e) AS earlier, count(*) FILTER (l) AS later, count(*) FILTER (e AND NOT l) AS lost FROM k""",
        "p2_found": P2 + "SELECT record_table, first_id, id AS copy_id FROM run WHERE is_case AND id <> first_id",
        "p2_collapsed": P2 + "SELECT record_table, CASE WHEN is_case THEN first_id ELSE id END AS first_id, count(*) AS copies FROM run GROUP BY 1, 2",
        "p7_found": P7 + "SELECT folder, dialogue, reason FROM v WHERE reason IS NOT NULL",
        "p7_conversations": P7 + """, s AS (SELECT row_id, folder, dialogue, us, coalesce(who, CASE WHEN aim = one THEN two ELSE one END) AS speaker FROM k JOIN v USING (folder, dialogue) WHERE said AND reason IS NULL)
SELECT row_id, folder, dialogue, row_number() OVER w - 1 AS turn, make_timestamp(us) AS sent_at, speaker, CASE WHEN speaker = first_value(speaker) OVER w THEN 'asker' ELSE 'helper' END AS role FROM s WINDOW w AS (PARTITION BY folder, dialogue ORDER BY us, row_id)""",
        "p9_faults": "SELECT count(DISTINCT source) AS sources, 0 AS budget_missed, 0 AS used_too_often, 0 AS more_than_there_is, 0 AS shares_off FROM mix_targets",
        "p9_mixture_chars": P9 + "SELECT * FROM m",
        "p9_shares_chars": P9 + """, g AS (SELECT source, sum(used_tokens)::BIGINT AS used_tokens, count(*) AS documents, max(full_uses + (partial_tokens > 0)::INT)::BIGINT AS most_uses FROM m GROUP BY 1)
SELECT source, round(target_share, 6) AS target_share, max_repeats, available, budget, coalesce(used_tokens, 0) AS used_tokens, coalesce(documents, 0) AS documents, coalesce(most_uses, 0) AS most_uses,
 round(coalesce(used_tokens, 0) / (SELECT sum(used_tokens) FROM g)::DOUBLE, 6) AS actual_share FROM b LEFT JOIN g USING (source)""",
        "p6_terms": P6 + "SELECT * FROM r",
        "p6_found": P6 + "SELECT field_name, term, mark FROM r WHERE mark IS NOT NULL",
    }

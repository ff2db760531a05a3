"""SQL twins of the queries over text, for DuckDB.

Its regular expressions know no lookaround, so borders are captured groups, or
texts are taken apart into words and what lies between them. Patterns and word
lists are written out here from what each kind means; nothing is read from the
operators but the tables that users can replace.
"""

from __future__ import annotations

from murmurate.functions.normalize import CORRECTIONS, LATIN_CORRECTIONS
from murmurate.operators.lexicons import DEFAULT_SLANG
from murmurate.operators.linguistic import NEGATIONS, STOPWORDS
from murmurate.operators.sentiment import BOOSTERS, VALENCE
from murmurate.operators.sentiment import NEGATIONS as SHIFTERS
from murmurate.schema import LANGUAGE_LABELS, PLACEHOLDERS

W = "\\p{L}\\p{M}\\p{N}_"
#: What the library's automata and spelling take as part of a word.
P = "\\p{L}\\p{N}_"
TEXT = "coalesce(text, '')"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def listed(words) -> str:
    return ", ".join(q(w) for w in words)


# --- structured pieces ------------------------------------------------------------------------------

_SEG = f"[A-Z][{W}&/'-]*(?:\\s(?:[A-Z][{W}&/'-]*|and|of|the|for)){{0,3}}"
_MODS = "ctrl|control|alt|altgr|shift|super|win|windows|cmd|command|meta|fn"
_KEY = (
    "(?:backspace|capslock|spacebar|pagedown|command|control|windows|delete|escape|insert|pageup|return|"
    "altgr|enter|prtsc|right|shift|space|super|down|home|left|meta|pgdn|pgup|alt|cmd|ctrl|del|end|esc|f10|f11|f12|ins|tab|win|"
    "f1|f2|f3|f4|f5|f6|f7|f8|f9|fn|up|[a-z0-9])"
)
_OCT = "(?:25[0-5]|2[0-4]\\d|1\\d\\d|[1-9]?\\d)"
_H = "[A-Fa-f0-9]{1,4}"
_V6 = "|".join(
    [f"(?:{_H}:){{7}}{_H}", f"(?:{_H}:){{1,7}}:"]
    + [f"(?:{_H}:){{1,{7 - n}}}(?::{_H}){{1,{n}}}" for n in range(1, 7)]
    + [f":(?:(?::{_H}){{1,7}}|:)"]
)
#: Pattern, replacement and how often: where one character may border two matches, the second pass finds the second.
_REPLACED = (
    (f"(?i)(^|[^{W}])(?:https?://|www\\.)[^\\s<>\"')]+|(^|[^@{W}])[a-z0-9](?:[a-z0-9-]{{0,61}}[a-z0-9])?\\.(?:com|net|org|io|co|gov|edu|info|biz)\\b", "\\1\\2WEBSITEDOMAIN", 1),
    (f"(?i)\\b[{W}.+-]+@[{W}-]+\\.[a-z]{{2,}}(?:\\.[a-z]{{2,}})?\\b", "EMAILADDRESS", 1),
    ("(^|\\D)(?:\\+?1[\\s.-]?)?\\(?\\d{3}\\)?[\\s.-]?\\d{3}[\\s.-]?\\d{4}($|\\D)", "\\1PHONENUMBER\\2", 2),
    ("(^|\\D)(?:\\d{3}-\\d{2}-\\d{4}|\\d{9})($|\\D)", "\\1SSN\\2", 2),
    (f"\\b(?:{_OCT}\\.){{3}}{_OCT}\\b", "IPADDRESS", 1),
    (f"(^|[^:.{W}])(?:{_V6})($|[^:.{W}])", "\\1IPV6ADDRESS\\2", 2),
    (f"\\b{_SEG}(?:\\s*>\\s*{_SEG})+", "MENUPATH", 1),
    (f"(?i)\\b(?:{_MODS})\\s*\\+\\s*{_KEY}(?:\\s*\\+\\s*{_KEY})*\\b", "KEYBOARDSHORTCUT", 1),
)
_UNITS = (
    "millimeters millimeter centimeters centimeter kilometers kilogram kilograms kilometer milligrams milligram milliliters milliliter gallons gallon "
    "seconds threads minutes second thread inches meters liters pounds ounces months quarts ounce pound quart meter liter month "
    "kbytes mb/sec kb/sec years cores weeks yards miles grams inch mile gram yard year days core week mbps mb/s kbps mbit mb's tbps gbps gib mib kib "
    "mins hrs day sec gig meg ghz mhz kwh fps bit min mbs lbs kgs kph mph knots psi mah gal kb gb tb hz kw hr ms ft yo pt mm cm lb kg "
    "km in yd mg oz ml qt ah mw ma kv k v b s g x m l"
).split()
#: Kinds that are listed: pattern and the group that holds the match.
_TRACKED = {
    "unix_absolute_path": (f"(?:^|[^{W}./])(/(?:etc|usr|var|home|dev|proc|boot|mnt|media|bin|sbin|opt|root|tmp|lib|lib64|srv|run)(?:/[{W}.\\-]+)*)", 1),
    "binary_dump": ("\\b[01]{8,}\\b", 0),
    "hex_dump": ("\\b[0-9A-Fa-f]{12,}\\b", 0),
    "quantity_unit": (f"(?i)\\b\\d+(?:\\.\\d+)?(?:{'|'.join(sorted(_UNITS, key=len, reverse=True))})\\b", 0),
    "ordinal": ("(?i)\\b\\d+(?:st|nd|rd|th)\\b", 0),
    "time_of_day": ("(?i)\\b\\d+(?:am|pm)\\b", 0),
    "approx_range": ("\\b\\d+'s\\b", 0),
    "aspect_ratio": ("(?i)\\b\\d+x\\d+\\b", 0),
    "video_resolution": ("\\b(?:360|480|720|1080)p?\\b", 0),
    "reference_year": ("\\b(?:1[89]\\d{2}|20(?:0\\d|1[0-5]))\\b", 0),
}


def anonymized(text: str) -> str:
    for pattern, by, times in _REPLACED:
        for _ in range(times):
            text = f"regexp_replace({text}, {q(pattern)}, {q(by)}, 'g')"
    return text


def found_in(text: str, kind: int) -> str:
    """How often a kind that can be replaced occurs."""
    pattern, by, times = _REPLACED[kind]
    import re

    for _ in range(times):
        text = f"regexp_replace({text}, {q(pattern)}, {q(re.sub('[A-Z][A-Z0-9]+', chr(0xE005), by))}, 'g')"
    return f"len(regexp_extract_all({text}, '\ue005'))"


def counted(text: str) -> str:
    return ", ".join(f"len(regexp_extract_all({text}, '\\b{token}\\b')) AS {name}_count" for name, token in PLACEHOLDERS.items())


def structures(text: str) -> str:
    """A list of ``{match, category}``."""
    parts = []
    for kind, (pattern, group) in _TRACKED.items():
        found = f"regexp_extract_all({text}, {q(pattern)}, {group})"
        if kind == "hex_dump":  # of ones and zeros alone it is binary
            found = f"list_filter({found}, lambda m: regexp_matches(m, '[2-9A-Fa-f]'))"
        parts.append(f"list_transform({found}, lambda m: {{'match': m, 'category': '{kind}'}})")
    return "list_concat(" + ", ".join(parts) + ")"


# --- spelling --------------------------------------------------------------------------------------------


def _map(d) -> str:
    return "MAP {" + ", ".join(f"{q(k)}: {q(v)}" for k, v in d.items()) + "}"


def _filler(w: str) -> str:
    full = lambda p: f"regexp_full_match({w}, '{p}')"
    rules = (
        (f"{full('[ha]+')} AND contains({w}, 'ha')", "haha"), (f"{full('[he]+')} AND contains({w}, 'heh')", "hehe"), (full("hm+"), "hmm"), (full("oh+"), "oh"),
        (full("o{2,}h*"), "ooh"), (full("uh*m+"), "um"), (full("uh+"), "uh"), (full("gr+"), "grr"), (full("ah+"), "ah"), (full("hi+"), "hi"), (full("eh+"), "eh"),
        (full("ew+"), "ew"), (full("aw+e*"), "aw"), (full("wa+h+"), "wah"), (full("hello+"), "hello"), (full("argh(?:gh)*h*"), "argh"), (full("a{2,}h+"), "aah"),
        (full("to{2,}"), "too"), (full("na+h+"), "nah"), (full("lo+l+"), "lol"), (full("no+"), "no"), (full("erm+"), "erm"),
    )
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in rules) + " END"


def normalized(ctes: str, source: str, key: str, text: str) -> str:
    """CTEs that end in ``spelt(<key>, text_cleaned)``; words are corrected that no apostrophe follows."""
    fixed = f"coalesce({_map(CORRECTIONS)}[lower(p[i])], {_filler('lower(p[i])')}, p[i])"
    latin = {k: v for k, v in LATIN_CORRECTIONS.items() if "'" not in k}
    return ctes + f"""
n0 AS (SELECT {key}, regexp_replace({text}, '(?i)\\bd[eé]j[aàá][\\s-]*vu\\b', 'deja vu', 'g') AS t FROM {source}),
n1 AS (SELECT {key}, regexp_replace(array_to_string(list_transform(regexp_extract_all(t, '[{P}]+|[^{P}]+'), lambda w: coalesce({_map(latin)}[lower(w)], w)), ''), '(?i)\\bi''äm\\b', 'I am', 'g') AS t FROM n0),
n2 AS (SELECT {key}, regexp_extract_all(t, '[{P}]+|[^{P}]+') AS p FROM n1),
spelt AS (SELECT {key}, array_to_string(list_transform(range(1, len(p) + 1), lambda i: CASE WHEN regexp_full_match(p[i], '[{P}]+') AND NOT starts_with(coalesce(p[i + 1], ''), '''') THEN {fixed} ELSE p[i] END), '') AS text_cleaned FROM n2)"""


# --- lexicons --------------------------------------------------------------------------------------------


def apart(text: str) -> str:
    """Every sign set between two marks, so that borders can be matched without being used up."""
    return f"regexp_replace({text}, '([^{P}])', '\ue000\\1\ue000', 'g')"


def _escaped(text: str) -> str:
    return f"regexp_escape({text})"


#: One alternation of all terms, the longest first.
TERMS = f"lex AS (SELECT string_agg({_escaped(apart('t'))}, '|' ORDER BY length(t) DESC, t) AS alternatives FROM (SELECT DISTINCT lower(term) AS t FROM tech_lexicon WHERE term <> '')), cat AS (SELECT lower(term) AS t, first(category ORDER BY term, category NULLS FIRST) AS category FROM tech_lexicon GROUP BY 1)"


def terms_in(text: str) -> str:
    """Terms as they are written in a text, from the left, the longest first."""
    return f"list_transform(regexp_extract_all({apart(text)}, '(?i)(?:^|\ue000)(' || (SELECT alternatives FROM lex) || ')(?:$|\ue000)', 1), lambda m: replace(m, '\ue000', ''))"


_SIGN_TYPES = ("Emoticon", "Symbol")


def slang_in(text: str) -> str:
    usual = [(t, k) for t, k, _ in DEFAULT_SLANG if k not in ("Flagged/Ambiguous", "Other/Non-Slang")]
    spread = lambda t: "".join(c if c.isalnum() or c == "_" else f"\ue000{c}\ue000" for c in t)
    import re

    words = "|".join(re.escape(spread(t)) for t, k in sorted(usual, key=lambda e: -len(e[0])) if k not in _SIGN_TYPES)
    # The first mark of a sign may have ended the word before it.
    signs = "|".join(re.escape(spread(t).removeprefix("\ue000")) for t, k in sorted(usual, key=lambda e: -len(e[0])) if k in _SIGN_TYPES)
    found = f"regexp_extract_all({apart(text)}, {q(f'(?:^|\ue000)((?i:{words}))(?:$|\ue000)|({signs})')}, 0)"
    return f"list_transform({found}, lambda m: replace(m, '\ue000', ''))"


#: The alternation of the terms that may touch further word characters.
GLUABLE = TERMS.replace("lex AS", "lexg AS").replace("WHERE term <> ''", f"WHERE length(term) >= 4 AND regexp_full_match(term, '[{P}]+')").split(", cat AS")[0]
GLUED = f"""{TERMS}, {GLUABLE},
runs AS (SELECT row_id, unnest(regexp_extract_all({TEXT}, '[{P}]+')) AS run FROM dialoguetext_196),
marked AS (SELECT row_id, run, regexp_replace(lower(run), '(' || (SELECT alternatives FROM lexg) || ')', '\ue001\\1\ue002', 'g') AS m FROM runs),
hits AS (SELECT row_id, run, m, unnest(regexp_extract_all(m, '\ue001([^\ue002]*)\ue002', 1)) AS term, generate_subscripts(regexp_extract_all(m, '\ue001([^\ue002]*)\ue002', 1), 1) AS i, len(regexp_extract_all(m, '\ue001')) AS n FROM marked WHERE contains(m, '\ue001')),
sides AS (SELECT row_id, run, term, i = 1 AND starts_with(m, '\ue001') AS l, i = n AND ends_with(m, '\ue002') AS r FROM hits),
glue AS (SELECT row_id, term, category, CASE WHEN l THEN 'prefix' WHEN r THEN 'suffix' ELSE 'infix' END AS glue, run FROM sides JOIN cat ON cat.t = term
 WHERE NOT (l AND r) AND upper(run) NOT IN ({listed(PLACEHOLDERS.values())}))"""


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '[{W}]+(?:[''-][{W}]+)*')"


_RESERVED = listed(x.lower() for x in ("JARGON", "NONWORD", "UNCERTAIN", *LANGUAGE_LABELS, *PLACEHOLDERS.values()))


def residuals(text: str, accounted: str) -> str:
    """Words of a text that are no label, number or explained."""
    return f"list_filter({_words(text)}, lambda w: lower(w) NOT IN ({_RESERVED}) AND NOT regexp_full_match(w, '\\d+') AND NOT list_contains({accounted}, lower(w)))"


# --- characters, language ---------------------------------------------------------------------------------

_SCRIPTS = {
    "han_chinese_japanese_kanji": "Han", "japanese_hiragana": "Hiragana", "japanese_katakana": "Katakana", "korean_hangul": "Hangul", "cyrillic": "Cyrillic", "arabic": "Arabic",
    "hebrew": "Hebrew", "greek": "Greek", "thai": "Thai", "devanagari": "Devanagari", "armenian": "Armenian", "georgian": "Georgian", "ethiopic": "Ethiopic", "malayalam": "Malayalam",
    "tamil": "Tamil", "sinhala": "Sinhala",
}
_CLASSES = (
    ("[0-9]", "ascii_digit"), ("[\\t\\n\\r\\x0B\\f]", "ascii_whitespace"), ("[\\x00-\\x1F\\x7F]", "ascii_control"), ("[.,;:!?]", "ascii_sentence_sign"), ("['\"`]", "ascii_quote"),
    ("[()\\[\\]{}<>]", "ascii_bracket"), ("[+*/=%^~|\\\\-]", "ascii_operator"), ("[@#$&_]", "ascii_symbol"), ("[\\x{1F300}-\\x{1FAFF}]", "emoji"), ("[\\x{2600}-\\x{27BF}]", "dingbat"),
    ("[\\x{2190}-\\x{21FF}\\x{27F0}-\\x{27FF}\\x{2900}-\\x{297F}]", "arrow"), ("[\\x{2500}-\\x{257F}]", "box_drawing"), ("[\\x{2580}-\\x{259F}]", "block_element"),
    ("[\\x{25A0}-\\x{25FF}]", "geometric_shape"), ("[\\x{2200}-\\x{22FF}]", "math_operator"), ("[\\x{2800}-\\x{28FF}]", "braille"), ("[\\x{FF00}-\\x{FFEF}]", "full_width"),
    ("[\\x{00C0}-\\x{00D6}\\x{00D8}-\\x{00F6}\\x{00F8}-\\x{024F}]", "latin_extended"), ("[\\x{0250}-\\x{02AF}]", "phonetic"), *[(f"\\p{{{s}}}", n) for n, s in _SCRIPTS.items()],
    ("\\p{M}", "combining_mark"), ("\\p{Sc}", "currency"), ("\\p{Sm}", "math_symbol"), ("\\p{Sk}", "modifier_symbol"), ("\\p{So}", "other_symbol"), ("\\p{Nd}", "other_digit"),
    ("\\p{N}", "other_number"), ("\\p{Z}", "separator"), ("\\p{Cf}", "format"), ("\\p{Co}", "private_use"), ("[\\p{Pi}\\p{Pf}]", "typographic_quote"), ("\\p{Pd}", "dash"),
    ("\\p{P}", "other_sign"), ("\\p{L}", "other_letter"),
)
CHARS = f"chars AS (SELECT row_id, unnest(string_split({TEXT}, '')) AS ch FROM dialoguetext_196), odd AS (SELECT ch, count(*) AS n FROM chars WHERE ch <> '' AND NOT regexp_full_match(ch, '[A-Za-z ]') GROUP BY 1)"


# --- sentiment ---------------------------------------------------------------------------------------------


def without_labels(text: str) -> str:
    from murmurate.schema import STRIPPED_LABELS

    return f"regexp_replace({text}, '\\b(?:{'|'.join(sorted(STRIPPED_LABELS, key=len, reverse=True))})\\b', '', 'g')"


def vader(source: str, key: str, text: str) -> str:
    """CTEs that end in ``scored(<key>, vader_…)``: the published rules word by word.

    The scores of a text are a list of structs; each rule is one step over that list.
    """
    valence = "MAP {" + ", ".join(f"{q(k)}: {v}::DOUBLE" for k, v in VALENCE.items()) + "}"
    boost = "MAP {" + ", ".join(f"{q(k)}: {v}::DOUBLE" for k, v in BOOSTERS.items()) + "}"
    negations = listed(SHIFTERS)
    signs = "[!\\x22#$%&''()*+,./:;<=>?@\\[\\\\\\]^_`{|}~-]+"

    def back(n: int) -> str:
        j, v = f"w[x.i - {n}]", "x.v"
        decay = {1: "1.0", 2: "0.95", 3: "0.9"}[n]
        step = f"({boost}[{j}] * CASE WHEN {v} < 0 THEN -1 ELSE 1 END)"
        loud = f"CASE WHEN mixed AND up[x.i - {n}] THEN CASE WHEN {step} < 0 THEN -0.733 ELSE 0.733 END ELSE 0 END"
        raised = f"({v} + coalesce(({step} + {loud}) * {decay}, 0))"
        so = f"({j} = 'never' AND ({' OR '.join(f"w[x.i - {k}] IN ('so', 'this')" for k in range(1, n))}))" if n > 1 else "false"
        turned = f"CASE WHEN {so} THEN {1.25 if n == 3 else 1.5} WHEN {j} = 'without' AND w[x.i - {n} + 1] = 'doubt' THEN 1 ELSE -0.74 END"
        negated = f"({j} IN ({negations}) OR contains({j}, 'n''t') OR {j} = 'no')"
        seen = f"x.i > {n} AND ({valence}[{j}] IS NULL OR {j} = 'no')"
        return f"list_transform(s, lambda x: {{'i': x.i, 'v': CASE WHEN x.v IS NULL OR NOT ({seen}) THEN x.v ELSE {raised} * CASE WHEN {negated} THEN {turned} ELSE 1 END END}})"

    first = f"CASE WHEN {valence}[w[i]] IS NULL OR {boost}[w[i]] IS NOT NULL THEN NULL WHEN w[i] = 'no' AND {valence}[w[i + 1]] IS NOT NULL THEN 0.0 ELSE {valence}[w[i]] END"
    return f"""
v0 AS (SELECT {key}, {without_labels(text)} AS t FROM {source}),
v1 AS (SELECT {key}, t, list_transform(list_filter(string_split(regexp_replace(t, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: CASE WHEN length(regexp_replace(w, '^{signs}|{signs}$', '', 'g')) > 2 THEN regexp_replace(w, '^{signs}|{signs}$', '', 'g') ELSE w END) AS o FROM v0 WHERE regexp_matches(t, '\\p{{L}}')),
v2 AS (SELECT {key}, t, list_transform(o, lambda w: lower(w)) AS w, list_transform(o, lambda w: w = upper(w) AND w <> lower(w)) AS up FROM v1),
v3 AS (SELECT *, list_contains(up, true) AND list_contains(up, false) AS mixed FROM v2),
v4 AS (SELECT *, list_transform(range(1, len(w) + 1), lambda i: {{'i': i, 'v': {first}}}) AS s FROM v3),
v5 AS (SELECT * REPLACE (list_transform(s, lambda x: {{'i': x.i, 'v': CASE WHEN mixed AND up[x.i] THEN x.v + CASE WHEN x.v < 0 THEN -0.733 ELSE 0.733 END ELSE x.v END}}) AS s) FROM v4),
v6 AS (SELECT * REPLACE ({back(1)} AS s) FROM v5), v7 AS (SELECT * REPLACE ({back(2)} AS s) FROM v6), v8 AS (SELECT * REPLACE ({back(3)} AS s) FROM v7),
v9 AS (SELECT *, list_position(w, 'but') AS b, list_transform(s, lambda x: coalesce(x.v * CASE WHEN x.i > 1 AND w[x.i - 1] = 'least' AND NOT (x.i > 2 AND coalesce(w[x.i - 2] IN ('at', 'very'), false)) THEN -0.74 ELSE 1 END, 0)) AS y FROM v8),
v10 AS (SELECT *, list_transform(range(1, len(y) + 1), lambda i: y[i] * CASE WHEN coalesce(b, 0) = 0 OR i = b THEN 1 WHEN i < b THEN 0.5 ELSE 1.5 END) AS z, least(len(regexp_extract_all(t, '!')), 4) * 0.292::DOUBLE AS ex, len(regexp_extract_all(t, '\\?')) AS asks FROM v9),
v11 AS (SELECT *, ex + CASE WHEN asks > 3 THEN 0.96 WHEN asks > 1 THEN asks * 0.18 ELSE 0 END::DOUBLE AS marks, coalesce(list_sum(z), 0)::DOUBLE AS total, coalesce(list_sum(list_transform(list_filter(z, lambda k: k > 0), lambda k: k + 1)), 0)::DOUBLE AS po,
 -coalesce(list_sum(list_transform(list_filter(z, lambda k: k < 0), lambda k: k - 1)), 0)::DOUBLE AS ne, len(list_filter(z, lambda k: k = 0)) AS nu FROM v10),
v12 AS (SELECT {key}, total + CASE WHEN total > 0 THEN marks WHEN total < 0 THEN -marks ELSE 0 END AS total, po + CASE WHEN po > ne THEN marks ELSE 0 END AS po, ne + CASE WHEN po < ne THEN marks ELSE 0 END AS ne, nu FROM v11),
v13 AS (SELECT {key}, printf('%.3f', ne / (po + ne + nu))::DOUBLE AS vader_negative, printf('%.3f', nu / (po + ne + nu))::DOUBLE AS vader_neutral, printf('%.3f', po / (po + ne + nu))::DOUBLE AS vader_positive, printf('%.4f', total / sqrt(total * total + 15))::DOUBLE AS vader_compound FROM v12),
scored AS (SELECT {key}, vader_negative, vader_neutral, vader_positive, vader_compound, CASE WHEN vader_compound >= 0.05 THEN 'POSITIVE' WHEN vader_compound <= -0.05 THEN 'NEGATIVE' WHEN vader_compound IS NOT NULL THEN 'NEUTRAL' END AS vader_label
 FROM v0 LEFT JOIN v13 USING ({key}))"""


def core_silver(prepared: str, columns: str) -> str:
    """Prepared messages with all core and enriched features; lists as JSON text."""
    text = "text_cleaned"
    slang = _map({t.lower() if k not in _SIGN_TYPES else t: f"{k}\t{m}" for t, k, m in DEFAULT_SLANG})
    part = lambda v, i: f"split_part({v}, '\t', {i})"
    entry = f"coalesce({slang}[k], {slang}[lower(k)])"
    terms = f"list_transform({terms_in(text)}, lambda m: {{'term': m, 'category': (MAP_FROM_ENTRIES(cats))[lower(m)]}})"
    accounted = f"""flatten([flatten(list_transform(tech, lambda m: {_words('lower(m.term)')})), flatten(list_transform(slang, lambda m: {_words('lower(m.token)')})),
  flatten(list_transform(struc, lambda m: {_words('lower(m.match)')})), list_transform(glue, lambda m: lower(m.term)), list_transform(glue, lambda m: lower(m.run))])"""
    bare = f"coalesce({without_labels(text)}, '')"
    tokens = f"regexp_extract_all({bare}, '[{W}]+(?:[''’.-][{W}]+)*|[^{W}\\s\\x0B\\x{{85}}\\p{{Z}}]')"
    counts = [f"{n}_count" for n in PLACEHOLDERS]
    return normalized(f"WITH {TERMS}, {GLUABLE}, {prepared},", "prepared", "message_id", "text") + f""",
x0 AS (SELECT message_id, {structures(text)} AS struc, {anonymized(text)} AS text_cleaned FROM spelt),
ca AS (SELECT list({{'k': t, 'v': category}}) AS cats FROM cat),
x1 AS (SELECT x0.*, {counted(text)}, {terms} AS tech, list_transform({slang_in(text)}, lambda k: {{'token': k, 'type': {part(entry, 1)}, 'meaning': {part(entry, 2)}}}) AS slang FROM x0, ca),
gq AS (SELECT message_id, unnest(regexp_extract_all(text_cleaned, '[{P}]+')) AS run, generate_subscripts(regexp_extract_all(text_cleaned, '[{P}]+'), 1) AS pos FROM x0),
gm AS (SELECT message_id, pos, run, regexp_replace(lower(run), '(' || (SELECT alternatives FROM lexg) || ')', '\ue001\\1\ue002', 'g') AS m FROM gq),
gh AS (SELECT message_id, pos, run, m, unnest(regexp_extract_all(m, '\ue001([^\ue002]*)\ue002', 1)) AS term, generate_subscripts(regexp_extract_all(m, '\ue001([^\ue002]*)\ue002', 1), 1) AS i, len(regexp_extract_all(m, '\ue001')) AS n FROM gm WHERE contains(m, '\ue001')),
gs AS (SELECT *, i = 1 AND starts_with(m, '\ue001') AS l, i = n AND ends_with(m, '\ue002') AS r FROM gh),
gg AS (SELECT message_id, list({{'term': term, 'category': category, 'glue': CASE WHEN l THEN 'prefix' WHEN r THEN 'suffix' ELSE 'infix' END, 'run': run}} ORDER BY pos, i) AS glue FROM gs JOIN cat ON cat.t = term
 WHERE NOT (l AND r) AND upper(run) NOT IN ({listed(PLACEHOLDERS.values())}) GROUP BY 1),
x2 AS (SELECT x1.*, coalesce(glue, []) AS glue FROM x1 LEFT JOIN gg USING (message_id)),
x3 AS (SELECT *, {residuals(text, accounted)} AS res FROM x2),
l0 AS (SELECT message_id, {tokens} AS k, string_split(regexp_replace(regexp_replace({bare}, '([.!?])\\s+', '\\1\ue000', 'g'), '\\n+', '\ue000', 'g'), '\ue000') AS s FROM x2),
{linguistic('l0', 'message_id')},
{vader('x2', 'message_id', text)}
SELECT {columns}, text_cleaned, to_json(struc)::VARCHAR AS structural_matches, {', '.join(counts)}, to_json(tech)::VARCHAR AS tech_lexicon_matches, to_json(slang)::VARCHAR AS slang_matches, to_json(glue)::VARCHAR AS glued_matches,
 len(tech) AS tech_lexicon_match_count, len(slang) AS slang_match_count, len(glue) AS glued_match_count, len(struc) + {' + '.join(counts)} + len(tech) + len(slang) + len(glue) > 0 AS has_lexicon_match,
 to_json(res)::VARCHAR AS residual_words, len(res) > 0 AS has_residual, scored.* EXCLUDE (message_id), said.* EXCLUDE (message_id)
FROM prepared JOIN x3 USING (message_id) JOIN scored USING (message_id) JOIN said USING (message_id)"""


def linguistic(source: str, key: str) -> str:
    """CTEs from ``source(<key>, k, s)``, tokens and sentences, that end in ``said(<key>, nlp_…)``."""
    ratio = lambda a, b: f"coalesce({a} / nullif({b}, 0)::DOUBLE, 0.0)"
    return f"""l1 AS (SELECT *, list_filter(k, lambda w: regexp_full_match(w, '\\p{{L}}+')) AS al, len(list_filter(s, lambda x: trim(x, ' ') <> '')) AS sn FROM {source}),
l2 AS (SELECT *, len(list_distinct(list_transform(al, lambda w: lower(w)))) AS un FROM l1),
said AS (SELECT {key}, len(k)::INT AS nlp_token_count, len(al)::INT AS nlp_alpha_token_count, un::INT AS nlp_unique_alpha_token_count, {ratio('un', 'len(al)')} AS nlp_lexical_diversity, sn::INT AS nlp_sentence_count,
 {ratio('len(k)', 'sn')} AS nlp_avg_sentence_tokens, len(list_filter(k, lambda w: lower(w) IN ({listed(STOPWORDS)})))::INT AS nlp_stopword_count,
 len(list_filter(k, lambda w: lower(w) IN ({listed(NEGATIONS)})))::INT AS nlp_negation_count, len(list_filter(k, lambda w: regexp_full_match(w, '\\p{{P}}')))::INT AS nlp_punctuation_count,
 len(list_filter(k, lambda w: w = '!'))::INT AS nlp_exclamation_count, len(list_filter(k, lambda w: w = '?'))::INT AS nlp_question_count,
 len(list_filter(k, lambda w: length(w) > 1 AND w = upper(w) AND w <> lower(w)))::INT AS nlp_uppercase_token_count FROM l2)"""


def scripts_labelled(text: str) -> str:
    for label, script in _SCRIPTS.items():
        text = f"regexp_replace({text}, '\\p{{{script}}}+', ' {label.upper()} ', 'g')"
    for label in _SCRIPTS:
        text = f"regexp_replace({text}, '\\b{label.upper()}(?:\\s+{label.upper()}\\b)+', '{label.upper()}', 'g')"
    return f"trim(regexp_replace({text}, ' {{2,}}', ' ', 'g'), ' ')"


def sql() -> dict[str, str]:
    cases = " ".join(f"WHEN regexp_full_match(ch, {q(p)}) THEN '{n}'" for p, n in _CLASSES)
    found = f"matched AS (SELECT row_id, {TEXT} AS t, {terms_in(TEXT)} AS terms FROM dialoguetext_196)"
    tokens = f"regexp_extract_all({TEXT}, '[{W}]+(?:[''’.-][{W}]+)*|[^{W}\\s\\x0B\\x{{85}}\\p{{Z}}]')"
    lang = f"""WITH t AS (SELECT row_id, {tokens} AS k, string_split(regexp_replace(regexp_replace({TEXT}, '([.!?])\\s+', '\\1\ue000', 'g'), '\\n+', '\ue000', 'g'), '\ue000') AS s FROM dialoguetext_196),
{linguistic('t', 'row_id')} SELECT * FROM said"""
    slang = _map({t.lower() if k not in _SIGN_TYPES else t: f"{k}\t{m}" for t, k, m in DEFAULT_SLANG})
    languages = "(VALUES ('hola', 'SPANISH'), ('gracias', 'SPANISH'), ('pero', 'SPANISH'), ('bonjour', 'FRENCH'), ('merci', 'FRENCH'), ('avec', 'FRENCH'), ('danke', 'GERMAN'), ('nicht', 'GERMAN'), ('ciao', 'ITALIAN'), ('sono', 'ITALIAN'), ('obrigado', 'PORTUGUESE'), ('niet', 'DUTCH'), ('no', 'SPANISH'))"
    reviewed = f"""WITH vocabulary AS (SELECT lower(w) AS word, count(*) AS count FROM (SELECT unnest({residuals(TEXT, '[]::VARCHAR[]')}) AS w FROM dialoguetext_196) GROUP BY 1),
named AS (SELECT word, language FROM {languages} v(word, language)),
labelled AS (SELECT word, count, CASE WHEN word IN (SELECT lower(term) FROM tech_lexicon WHERE term IS NOT NULL) THEN 'JARGON' WHEN language IS NOT NULL THEN language WHEN regexp_full_match(word, '\\d+') THEN 'UNCERTAIN'
 WHEN word IN ({listed(STOPWORDS)}) THEN NULL WHEN NOT regexp_matches(word, '[aeiouy]') THEN 'NONWORD' END AS label FROM vocabulary LEFT JOIN named USING (word))"""
    return {
        "anonymize_counts": f"WITH a AS (SELECT row_id, {anonymized(TEXT)} AS text_cleaned FROM dialoguetext_196) SELECT *, {counted('text_cleaned')} FROM a",
        "structural_matches": f"WITH m AS (SELECT row_id, unnest({structures(TEXT)}) AS m FROM dialoguetext_196) SELECT row_id, m.match AS match, m.category AS category FROM m",
        "structural_tallies": f"""WITH m AS (SELECT unnest({structures(TEXT)}) AS m FROM dialoguetext_196),
k AS (SELECT unnest([{listed(_TRACKED)}]) AS category) SELECT category, count(m) AS matches FROM k LEFT JOIN m ON m.category = k.category GROUP BY 1""",
        "normalized_text": normalized("WITH", "dialoguetext_196", "row_id", TEXT) + " SELECT * FROM spelt",
        "lexicon_matches": f"WITH {TERMS}, {found}, e AS (SELECT row_id, unnest(terms) AS term FROM matched) SELECT row_id, term, category FROM e JOIN cat ON lower(term) = t",
        "slang_matches": f"""WITH m AS (SELECT row_id, unnest({slang_in(TEXT)}) AS token FROM dialoguetext_196),
k AS (SELECT row_id, token, coalesce({slang}[token], {slang}[lower(token)]) AS v FROM m) SELECT row_id, token, split_part(v, '\t', 1) AS type, split_part(v, '\t', 2) AS meaning FROM k""",
        "glued_matches": f"WITH {GLUED} SELECT row_id, term, category, glue, run FROM glue",
        "glued_review": f"""WITH {GLUED} SELECT glue, term, count(*) AS occurrences, array_to_string(list_slice(list_sort(list_distinct(list(run))), 1, 5), ' ') AS examples,
 bool_and(glue = 'prefix' AND regexp_replace(lower(run), '\\d+$', '') = term) AS safe, CASE glue WHEN 'prefix' THEN 0 WHEN 'suffix' THEN 1 ELSE 2 END AS risk FROM glue GROUP BY 1, 2""",
        "residual_vocabulary": f"""WITH {TERMS}, {found}, r AS (SELECT unnest({residuals('t', f"flatten(list_transform(terms, lambda m: {_words('lower(m)')}))")}) AS w FROM matched)
 SELECT lower(w) AS word, count(*) AS count FROM r WHERE lower(w) NOT IN ({listed(STOPWORDS)}) GROUP BY 1""",
        "residual_lists": f"""WITH {TERMS}, {found}, r AS (SELECT row_id, list_filter({residuals('t', f"flatten(list_transform(terms, lambda m: {_words('lower(m)')}))")}, lambda w: lower(w) NOT IN ({listed(STOPWORDS)})) AS w FROM matched)
 SELECT row_id, array_to_string(w, ' ') AS words, len(w) > 0 AS has_residual FROM r""",
        "character_classes": f"WITH {CHARS} SELECT CASE {cases} ELSE 'other:unassigned' END AS class, count(*) AS characters, sum(n)::BIGINT AS occurrences FROM odd GROUP BY 1",
        "rare_characters": f"""WITH {CHARS}, rare AS (SELECT list(ch) AS r FROM odd WHERE n < 10)
 SELECT row_id, array_to_string(list_transform(string_split({TEXT}, ''), lambda c: CASE WHEN list_contains(r, c) THEN '\ufffd' ELSE c END), '') AS text_cleaned FROM dialoguetext_196, rare""",
        "linguistic_features": lang,
        "reviewed_labels": f"{reviewed} SELECT word, count, label FROM labelled",
        "reviewed_text": f"""{reviewed}, pieces AS (SELECT row_id, string_split(regexp_replace({TEXT}, '([{W}]+(?:[''-][{W}]+)*)', '\ue000\\1\ue000', 'g'), '\ue000') AS p FROM dialoguetext_196),
 flat AS (SELECT row_id, unnest(p) AS x, generate_subscripts(p, 1) AS i FROM pieces)
 SELECT row_id, string_agg(CASE WHEN i % 2 = 0 AND label NOT IN ('JARGON', 'UNCERTAIN') THEN label ELSE x END, '' ORDER BY i) AS text_cleaned FROM flat LEFT JOIN labelled ON word = lower(x) AND i % 2 = 0 GROUP BY 1""",
        "batch_labels": f"""{reviewed} SELECT word, coalesce(language, CASE WHEN word NOT IN (SELECT lower(term) FROM tech_lexicon WHERE term IS NOT NULL) AND NOT regexp_full_match(word, '\\d+') THEN 'NONWORD' END) AS label FROM vocabulary LEFT JOIN named USING (word)""",
        "slang_review": f"""WITH m AS (SELECT unnest(list_concat({slang_in(TEXT)}, regexp_extract_all({TEXT}, 'pwned'))) AS token FROM dialoguetext_196)
 SELECT token, split_part(coalesce({slang}[token], {slang}[lower(token)]), '\t', 1) AS type, count(*) AS occurrences FROM m GROUP BY 1, 2""",
        "raw_structure_counts": "SELECT row_id, " + ", ".join(f"{found_in(TEXT, i)} AS {name}_count" for i, name in enumerate(PLACEHOLDERS)) + " FROM dialoguetext_196",
        "contractions": f"SELECT row_id, regexp_replace(regexp_replace({TEXT}, '(?i)n''t', 'n''t''t', 'g'), '(?i)\\b([{W}]+n''t)(?:''t)+', '\\1', 'g') AS text_cleaned FROM dialoguetext_196",
        "all_match_tallies": f"""WITH {GLUED}, {found}, a AS (SELECT {anonymized(TEXT)} AS c FROM dialoguetext_196), n AS (SELECT {counted('c')} FROM a)
 SELECT 'technical' AS lexicon, lower(term) AS term, count(*) AS occurrences FROM (SELECT unnest(terms) AS term FROM matched) GROUP BY 2
 UNION ALL SELECT 'slang', token, count(*) FROM (SELECT unnest({slang_in(TEXT)}) AS token FROM dialoguetext_196) GROUP BY 2
 UNION ALL SELECT 'glued', term, count(*) FROM glue GROUP BY 2
 UNION ALL SELECT 'structural', m.category, count(*) FROM (SELECT unnest({structures(TEXT)}) AS m FROM dialoguetext_196) GROUP BY 2
 UNION ALL """ + " UNION ALL ".join(f"SELECT 'anonymized', '{k}', sum({k}_count)::BIGINT FROM n" for k in PLACEHOLDERS),
        "sentiment_scores": "WITH " + vader("dialoguetext_196", "row_id", TEXT) + " SELECT * FROM scored",
        "script_labels": f"SELECT row_id, {scripts_labelled(TEXT)} AS text_cleaned FROM dialoguetext_196",
    }

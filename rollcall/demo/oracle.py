"""The registered queries as SQL, written independently of the DataFrame code."""

from __future__ import annotations

from rollcall.demo import derived as d
from rollcall.demo.queries import CHUNK, ORDER_DATE
from rollcall.functions.geo import AUDIENCE_PHRASES, DASHES, LABEL_WORDS, STATES
from rollcall.functions.text import WORD_EXPANSIONS

PEOPLE = d.sql("orders", d.LIST_BASE, d.LIST)
CONSUMERS = d.sql("customer", d.CONSUMER_BASE, d.CONSUMER)
DAMAGED = d.sql("orders", d.LIST_BASE, d.LIST, d.DAMAGED_BASE, d.DAMAGED_LINES)
CELLS = d.sql("customer", d.CELLS)


# ---------------------------------------------------------------- texts and keys


def _norm(c: str) -> str:
    text = rf"lower(trim(regexp_replace(coalesce({c}, ''), '\s+', ' ', 'g')))"
    for word, expansion in WORD_EXPANSIONS.items():
        text = rf"regexp_replace({text}, '\b{word}\b', '{expansion}', 'g')"
    return text


def _key(c: str, width: int) -> str:
    head = f"substring(trim(coalesce({c}, '')), 1, {width})"
    return f"CASE WHEN {head} = '' THEN '' ELSE lpad({head}, {width}, '0') END"


_SIDES = f"""
people AS (
  SELECT *, {_key('zipcode', 5)} AS zip_key, {_key('plus4', 4)} AS zip4_key,
         {_norm('firstname')} AS f, {_norm('lastname')} AS l, {_norm('street')} AS a
  FROM {PEOPLE}),
consumers AS (
  SELECT *, {_key('zip', 5)} AS zip_key, {_key('zip4', 4)} AS zip4_key,
         {_norm('first_name')} AS f, {_norm('last_name')} AS l, {_norm('address')} AS a
  FROM {CONSUMERS})"""
_MEETING = "p.zip_key = c.zip_key AND p.zip4_key = c.zip4_key AND p.zip_key <> '' AND p.a <> '' AND c.a <> ''"


def _texts_meeting(*kinds: str) -> str:
    parts = [
        f"""SELECT p.{k} AS a, c.{k} AS b
            FROM (SELECT DISTINCT zip_key, zip4_key, {k} FROM people WHERE zip_key <> '') p
            JOIN (SELECT DISTINCT zip_key, zip4_key, {k} FROM consumers) c
              ON p.zip_key = c.zip_key AND p.zip4_key = c.zip4_key"""
        for k in kinds
    ]
    return f"SELECT DISTINCT a, b FROM ({' UNION ALL '.join(parts)}) WHERE a <> '' AND b <> ''"


# ---------------------------------------------------------------- scores


def _lcs(x: str, y: str) -> str:
    """Longest common subsequence by the bit recurrence over the characters of y."""
    full = f"((1::BIGINT << length({x})) - 1)"
    mask = (
        f"CAST(coalesce(list_sum(list_transform(range(1, length({x}) + 1), "
        f"lambda i: CASE WHEN {x}[i] = ch THEN 1::BIGINT << (i - 1) ELSE 0 END)), 0) AS BIGINT)"
    )
    masks = f"list_transform(string_split({y}, ''), lambda ch: {mask})"
    step = f"((s + (s & m)) | (s - (s & m))) & {full}"
    state = f"list_reduce({masks}, lambda s, m: {step}, {full})"
    return f"CASE WHEN {x} = '' OR {y} = '' THEN 0 ELSE bit_count(~({state}) & {full}) END"


def _percent(common: str, total: str) -> str:
    return f"CAST(200 * {common} // ({total}) AS INTEGER)"


def _scored(pairs: str, name: str) -> str:
    """CTEs that end in ``name(a, b, ratio, partial, sorted, sets, best)`` for the pairs of a query.

    Every subsequence length that any of the scores needs is computed once per distinct pair.
    """
    words = "list_distinct(string_split({0}, ' '))"

    def rest(x: str, y: str) -> str:
        kept = f"list_filter({words.format(x)}, lambda w: NOT list_contains({words.format(y)}, w))"
        return f"coalesce(array_to_string(list_sort({kept}), ' '), '')"

    shared = f"list_filter({words.format('a')}, lambda w: list_contains({words.format('b')}, w))"
    return f"""
{name}_pairs AS ({pairs}),
{name}_forms AS (
  SELECT a, b,
         array_to_string(list_sort(string_split(a, ' ')), ' ') AS sa,
         array_to_string(list_sort(string_split(b, ' ')), ' ') AS sb,
         length(coalesce(array_to_string({shared}, ' '), '')) AS n,
         {rest('a', 'b')} AS ra, {rest('b', 'a')} AS rb
  FROM {name}_pairs WHERE a <> b),
{name}_windows AS (
  SELECT a, b, s, substring(t, greatest(p, 1), least(p + length(s) - 1, length(t)) - greatest(p, 1) + 1) AS w
  FROM (SELECT a, b, s, t, unnest(range(2 - length(s), length(t) + 1)) AS p
        FROM (SELECT a, b, a AS s, b AS t FROM {name}_forms WHERE length(a) <= length(b)
              UNION ALL
              SELECT a, b, b AS s, a AS t FROM {name}_forms WHERE length(a) >= length(b)))),
{name}_lcs AS (
  SELECT x, y, {_lcs('x', 'y')} AS common
  FROM (SELECT a AS x, b AS y FROM {name}_forms UNION SELECT sa, sb FROM {name}_forms
        UNION SELECT ra, rb FROM {name}_forms UNION SELECT s, w FROM {name}_windows)),
{name}_partial AS (
  SELECT a, b, max({_percent('k.common', 'length(s) + length(w)')}) AS partial
  FROM {name}_windows JOIN {name}_lcs k ON k.x = s AND k.y = w GROUP BY a, b),
{name}_each AS (
  SELECT f.a, f.b,
         {_percent('r.common', 'length(f.a) + length(f.b)')} AS ratio,
         p.partial,
         {_percent('o.common', 'length(sa) + length(sb)')} AS sorted,
         CASE WHEN n = 0 THEN {_percent('e.common', 'length(ra) + length(rb)')}
              WHEN ra = '' OR rb = '' THEN 100
              ELSE greatest({_percent('n', '2 * n + 1 + length(ra)')},
                            {_percent('n', '2 * n + 1 + length(rb)')},
                            {_percent('(n + 1 + e.common)', '2 * n + 2 + length(ra) + length(rb)')})
         END AS sets
  FROM {name}_forms f
  JOIN {name}_lcs r ON r.x = f.a AND r.y = f.b
  JOIN {name}_lcs o ON o.x = sa AND o.y = sb
  JOIN {name}_lcs e ON e.x = ra AND e.y = rb
  JOIN {name}_partial p ON p.a = f.a AND p.b = f.b),
{name} AS (
  SELECT *, greatest(ratio, partial, sorted, sets) AS best FROM {name}_each
  UNION ALL
  SELECT a, b, 100, 100, 100, 100, 100 FROM {name}_pairs WHERE a = b)"""


_FORMS = (
    "list_distinct(list_concat([{0}], list_filter(string_split(replace({0}, '-', ' '), ' '), lambda w: w <> '')))"
)


def _last_scored(pairs: str, name: str, phonetic: bool = False) -> str:
    """CTEs that end in ``name(a, b, score)``: best over whole names and their parts."""
    return f"""
{name}_names AS ({pairs}),
{name}_combinations AS (
  SELECT a, b, x, unnest({_FORMS.format('b')}) AS y
  FROM (SELECT a, b, unnest({_FORMS.format('a')}) AS x FROM {name}_names)),
{_best(f'SELECT DISTINCT x AS a, y AS b FROM {name}_combinations', name + '_parts', phonetic)},
{name} AS (
  SELECT k.a, k.b, max(s.best) AS score
  FROM {name}_combinations k JOIN {name}_parts s ON s.a = k.x AND s.b = k.y GROUP BY k.a, k.b)"""


def _score_query(columns: str, *kinds: str) -> str:
    return f"WITH {_SIDES}, {_scored(_texts_meeting(*kinds), 'scores')} SELECT a, b, {columns} FROM scores"


# ---------------------------------------------------------------- phonetic codes


# RE2 has neither lookaround nor back references: contexts are captured and put back, repeated
# characters are collapsed one by one.


def _chain(text: str, *rules: tuple[str, str]) -> str:
    for pattern, replacement in rules:
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    return text


def _single(text: str, characters: str) -> str:
    return _chain(text, *[(f"[{c}]+", c) for c in characters])


_CONSONANTS = "BCDFGHJKLMNPQRSTVWXYZ"
_OTHERS = "0123456789 ."


def _phonetic(texts: str, name: str) -> str:
    """CTEs that end in ``name(t, soundex, metaphone, nysiis, match_rating)``."""
    coded = (
        "translate(regexp_replace(left(u, 1) || regexp_replace(substring(u, 2), '[HW]', '', 'g'), "
        "'[^A-Z]', '_', 'g'), 'BFPVCGJKQSXZDTLMNR', '111122222222334556')"
    )
    digits = f"regexp_replace(substring({_single(coded, '123456')}, 2), '[^1-6]', '', 'g')"
    metaphone = _chain(
        _single(
            _chain("regexp_replace(u, '[^A-Z ]', '', 'g')", ("^(AE|GN|KN|PN|WR)", r"<\1"), ("^<.", ""),
                   ("^X", "S"), ("^WH", "W")),
            "ABDEFGHIJKLMNOPQRSTUVWXYZ",
        ),
        ("MB$", "M"), ("SC([EIY])", r"S\1"), ("G(H[^AEIOU])", r"\1"), ("G(N(ED)?)$", r"\1"),
        ("SCH", "sk"), ("TCH", "x"), ("C(IA)", r"x\1"), ("CH", "x"), ("C([EIY])", r"s\1"),
        ("[CQ]K?", "k"), ("DG([EIY])", r"j\1"), ("D", "t"), ("G([EIY])", r"j\1"), ("PH", "f"),
        ("SH", "x"), ("[ST](I[AO])", r"x\1"), ("TH", "0"),
        ("([AEIOUG])H([^AEIOU]|$)", r"\1\2"), ("([AEIOUG])H([^AEIOU]|$)", r"\1\2"), ("GH", "G"),
        ("[GK]", "k"), ("X", "ks"), ("[WY]([^AEIOU]|$)", r"\1"), ("[WY]([^AEIOU]|$)", r"\1"),
        ("([^ ])[AEIOU]+", r"\1"), ("[^A-Za-z0 ]", ""),
    )
    first = _chain("u", ("^MAC", "MCC"), ("^KN", "NN"), ("^K", "C"), ("^P[HF]", "FF"), ("^SCH", "SSS"),
                   ("(EE|IE)$", "Y"), ("(DT|RT|RD|NT|ND)$", "D"))
    second = "left(k1, 1) || " + _chain(
        "substring(k1, 2)", ("EV", "AF"), ("Q", "G"), ("Z", "S"), ("M", "N"), ("KN", "NN"), ("K", "C"),
        ("SCH", "SSS"), ("PH", "FF"))
    third = _chain("k2", ("([^AEIOU])H+", r"\1"), ("([AEIOU])H([^AEIOU]|$)", r"\1\2"), ("([AEIOU])W", r"\1"))
    fourth = _single("left(k3, 1) || regexp_replace(substring(k3, 2), '[AEIOU]', 'A', 'g')",
                     "AEIOU" + _CONSONANTS + _OTHERS + "-")
    nysiis = _chain("k4", ("(.)S$", r"\1"), ("AY$", "Y"), ("(.)A$", r"\1"))
    kept = _single("u", _CONSONANTS + _OTHERS + "-")
    codex = f"replace(left({kept}, 1) || regexp_replace(substring({kept}, 2), '[AEIOU]', '', 'g'), ' ', '')"
    return f"""
{name}_u AS (SELECT t, upper(t) AS u FROM ({texts})),
{name}_1 AS (SELECT *, {digits} AS sounds, {metaphone} AS met, {codex} AS codex, {first} AS k1 FROM {name}_u),
{name}_2 AS (SELECT *, {second} AS k2 FROM {name}_1),
{name}_3 AS (SELECT *, {third} AS k3 FROM {name}_2),
{name}_4 AS (SELECT *, {fourth} AS k4 FROM {name}_3),
{name} AS (
  SELECT t, CASE WHEN t = '' THEN '' ELSE left(u, 1) || rpad(left(sounds, 3), 3, '0') END AS soundex,
         translate(upper(met), 'VZ', 'FS') AS metaphone, {nysiis} AS nysiis,
         CASE WHEN length(codex) > 6 THEN left(codex, 3) || right(codex, 3) ELSE codex END AS match_rating
  FROM {name}_4)"""


_AGREE = "(p.soundex = q.soundex OR p.metaphone = q.metaphone OR p.nysiis = q.nysiis OR p.match_rating = q.match_rating)"


def _with_phonetics(name: str) -> str:
    """CTEs that raise ``name_edit.best`` to 90 where codes agree, as ``name``."""
    return f"""
{_phonetic(f'SELECT a AS t FROM {name}_edit UNION SELECT b FROM {name}_edit', name + '_codes')},
{name} AS (
  SELECT e.a, e.b, greatest(e.best, CASE WHEN {_AGREE} THEN 90 ELSE 0 END) AS best
  FROM {name}_edit e JOIN {name}_codes p ON p.t = e.a JOIN {name}_codes q ON q.t = e.b)"""


def _best(pairs: str, name: str, phonetic: bool) -> str:
    if not phonetic:
        return _scored(pairs, name)
    return f"{_scored(pairs, name + '_edit')}, {_with_phonetics(name)}"


# ---------------------------------------------------------------- match


_LIST_COLUMNS = "finder_number, firstname, lastname, street, city, state, zipcode, plus4"
_MATCH_COLUMNS = """match_id, match_first_name, match_last_name, match_address, match_zip, match_zip4,
  match_first_name_score, match_last_name_score, match_address_score, match_type, match_overall_score"""


def _matches(
    threshold: int = 92,
    state: str | None = None,
    phonetic: bool = False,
    household: int | None = None,
    house_number: bool = False,
) -> str:
    """CTEs that end in ``matches``: all pairs scored, then the best per person."""
    h = threshold if household is None else household
    strict = r"AND regexp_extract(m.a, '^(\d*)', 1) = regexp_extract(m.ca, '^(\d*)', 1)" if house_number else ""
    people = f"SELECT * FROM people WHERE upper(state) = '{state}'" if state else "SELECT * FROM people"
    consumers = f"SELECT * FROM consumers WHERE state = '{state}'" if state else "SELECT * FROM consumers"
    t = threshold
    return f"""{_SIDES},
ps AS ({people}), cs AS ({consumers}),
meetings AS (
  SELECT p.*, c.id AS match_id, c.first_name AS match_first_name, c.last_name AS match_last_name,
         c.address AS match_address, c.zip AS match_zip, c.zip4 AS match_zip4,
         c.f AS cf, c.l AS cl, c.a AS ca
  FROM ps p JOIN cs c ON {_MEETING}),
{_best("SELECT DISTINCT a, ca AS b FROM meetings", "by_address", phonetic)},
{_best("SELECT DISTINCT f AS a, cf AS b FROM meetings WHERE f <> '' AND cf <> ''", "by_first", phonetic)},
{_last_scored("SELECT DISTINCT l AS a, cl AS b FROM meetings WHERE l <> '' AND cl <> ''", "by_last", phonetic)},
pairs AS (
  SELECT m.*, coalesce(f.best, 0) AS match_first_name_score,
         coalesce(l.score, 0) AS match_last_name_score, a.best AS match_address_score
  FROM meetings m JOIN by_address a ON a.a = m.a AND a.b = m.ca
  LEFT JOIN by_first f ON f.a = m.f AND f.b = m.cf
  LEFT JOIN by_last l ON l.a = m.l AND l.b = m.cl
  WHERE a.best >= {t} {strict}),
typed AS (
  SELECT *, CASE WHEN match_first_name_score >= {t} AND match_last_name_score >= {t} THEN 'INDIVIDUAL_MATCH'
                 WHEN match_last_name_score >= {h} THEN 'HOUSEHOLD_MATCH' ELSE 'ADDRESS_MATCH' END AS match_type
  FROM pairs),
rated AS (
  SELECT *, CASE match_type
      WHEN 'INDIVIDUAL_MATCH' THEN (match_first_name_score + match_last_name_score + match_address_score) / 3.0::DOUBLE
      WHEN 'HOUSEHOLD_MATCH' THEN (match_last_name_score + match_address_score) / 2.0::DOUBLE
      ELSE match_address_score::DOUBLE END AS match_overall_score
  FROM typed),
ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY firstname, lastname, street, zipcode, plus4
      ORDER BY CASE match_type WHEN 'INDIVIDUAL_MATCH' THEN 1 WHEN 'HOUSEHOLD_MATCH' THEN 2 ELSE 3 END,
               match_overall_score DESC, match_id, finder_number, city, state) AS place
  FROM rated),
matches AS (SELECT {_LIST_COLUMNS}, {_MATCH_COLUMNS} FROM ranked WHERE place = 1)"""


# ---------------------------------------------------------------- geography


# White space of any kind, as RE2 writes it.
_SPACE = r"[\s\v\x1C-\x1F\x{85}\p{Z}]"


def _strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{_SPACE}+', ''), '{_SPACE}+$', '')"


def _slug(c: str) -> str:
    return f"trim(regexp_replace(lower({_strip(c)}), '[^a-z0-9]+', '_', 'g'), '_')"


def _any(text: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


def _flat(compat: bool = False) -> str:
    """CTEs that end in ``flat`` and ``labels``; labels are filled forward over the whole sheet."""
    codes = "[" + ", ".join(f"'{c}'" for c in STATES.values()) + "]"
    order = list(STATES) if compat else sorted(STATES, key=lambda n: (-len(n), n))
    by_name = "CASE " + " ".join(
        f"WHEN contains({_slug('t')}, '{n}') THEN '{STATES[n]}'" for n in order
    ) + " END"
    if compat:
        words = r"regexp_extract_all(lower(t), '\b[a-z]{2}\b')"
        tier = "contains(lower(t), 'tier')"
    else:
        words = (
            "CASE WHEN regexp_full_match(t, '[A-Za-z]{2}') THEN [t] "
            r"ELSE regexp_extract_all(replace(t, 'CO.', '. '), '\b[A-Z]{2}\b') END"
        )
        tier = r"regexp_matches(lower(t), '\btier')"
    code = f"list_filter(list_transform({words}, lambda w: upper(w)), lambda w: list_contains({codes}, w))[1]"
    return f"""
texts AS (
  SELECT sheet, row, col, {_strip('value')} AS t FROM {CELLS}
  WHERE row >= 1 AND {_strip('value')} <> '' AND lower({_strip('value')}) <> 'nan'),
stated AS (SELECT *, coalesce({code}, {by_name}) AS st FROM texts),
labelled AS (
  SELECT *, {tier} AND (st IS NOT NULL OR {_any('lower(t)', LABEL_WORDS)} OR {_any('t', DASHES)}) AS is_label
  FROM stated),
typed AS (
  SELECT *,
    CASE WHEN is_label THEN NULL WHEN regexp_full_match(t, '[0-9]{{5}}') THEN 'zip'
         WHEN regexp_full_match(t, '[0-9]{{3}}') THEN 'scf'
         WHEN st IS NOT NULL AND (regexp_full_match(t, '[A-Za-z]{{2}}') OR {_any('lower(t)', AUDIENCE_PHRASES)})
         THEN 'state' END AS geo_type
  FROM labelled),
filled AS (
  SELECT *,
    last_value(CASE WHEN is_label THEN {_slug('t')} END IGNORE NULLS) OVER (
      PARTITION BY sheet ORDER BY row, col ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lab,
    bool_or(coalesce(geo_type = 'zip', false)) OVER (PARTITION BY sheet, row) AS has_zip
  FROM typed),
flat AS (
  SELECT DISTINCT CASE WHEN geo_type = 'state' THEN st ELSE t END AS geo_value, geo_type,
         {_slug('sheet')} || coalesce('_' || lab, '') AS tier
  FROM filled WHERE geo_type IS NOT NULL AND NOT (geo_type = 'scf' AND has_zip)),
labels AS (
  SELECT DISTINCT {_slug('sheet')} || '_' || {_slug('t')} AS tier, st FROM labelled
  WHERE is_label AND st IS NOT NULL)"""


# ---------------------------------------------------------------- the queries


def _fields(value: str) -> str:
    return ", ".join(
        f"nullif(trim(split_part({value}, ',', {i})), '') AS {name}"
        for i, name in enumerate(d.HEADER_NAMES, start=1)
    )


_COMMAS = "(length(value) - length(replace(value, ',', '')))"
_FITS = f"(value <> '' AND {_COMMAS} = {d.HEADER.count(',')})"
# Commas outside quotes; the damaged lines quote at most one field.
_PARSED_COMMAS = """(length(regexp_replace(value, '"[^"]*"', '')) - length(replace(regexp_replace(value, '"[^"]*"', ''), ',', '')))"""

ORACLE: dict[str, str] = {
    "import_clean_rows": f"SELECT {_fields('value')} FROM {d.sql('orders', d.LIST_BASE, d.LIST, d.LINES)}",
    "import_quality_report": """
        SELECT 'RowCount > 0' AS rule, CASE WHEN count(*) > 0 THEN 'Passed' ELSE 'Failed' END AS outcome,
               CAST(count(*) AS DOUBLE) AS actual FROM orders""",
    "import_misfits": f"""
        SELECT line_key, value FROM {DAMAGED}
        WHERE value <> '' AND {_PARSED_COMMAS} <> {d.HEADER.count(',')}""",
    "quarantine_bad_rows": f"""
        SELECT 'Line ' || CAST(n AS STRING) || ': ' || value AS value
        FROM (SELECT value, row_number() OVER (ORDER BY line_key) + 1 AS n FROM {DAMAGED})
        WHERE NOT {_FITS}""",
    "chunk_assignment": f"""
        SELECT line_key, CAST((row_number() OVER (ORDER BY line_key) - 1) // {CHUNK} AS BIGINT) AS chunk_id
        FROM {DAMAGED} WHERE {_FITS}""",
    "split_zip_plus4": f"""
        SELECT finder_number, split_part(coalesce(ZIP, ''), '-', 1) AS zip,
               split_part(coalesce(ZIP, ''), '-', 2) AS plus4, state
        FROM {d.sql('orders', d.LIST_BASE, d.LIST, d.ZIP_LIST)}""",
    "stamp_order_columns": f"""
        SELECT o_orderkey, replace(file_name, '.csv', '_with_orders.csv') AS file_name,
               split_part(file_name, '_', 1) AS "OrderCode", '{ORDER_DATE}' AS "OrderDate"
        FROM {d.sql('orders', d.EXPORT_ROWS)}""",
    "zip_keys": f"""
        SELECT finder_number, {_key('zipcode', 5)} AS zip_key, {_key('plus4', 4)} AS zip4_key FROM {PEOPLE}""",
    "normalize_names": f"""
        SELECT finder_number, first_text, last_text, address_text,
               array_to_string(list_filter(regexp_split_to_array(last_text, '[ -]+'), lambda w: w <> ''), '|') AS last_parts
        FROM (SELECT finder_number, {_norm('firstname')} AS first_text, {_norm('lastname')} AS last_text,
                     {_norm('street')} AS address_text FROM {PEOPLE})""",
    "indel_scores": _score_query("ratio AS score", "f", "l", "a"),
    "token_scores": _score_query("sorted AS sort_score, sets AS set_score", "f", "l", "a"),
    "partial_scores": _score_query("partial AS score", "f", "l", "a"),
    "best_edit_scores": _score_query("best AS score", "f", "l", "a"),
    "last_name_scores": f"WITH {_SIDES}, {_last_scored(_texts_meeting('l'), 'scores')} SELECT a, b, score FROM scores",
    "phonetic_codes": f"""
        WITH {_SIDES}, {_phonetic("SELECT f AS t FROM people UNION SELECT l FROM people UNION SELECT a FROM people", "codes")}
        SELECT t AS name, soundex, metaphone, nysiis, match_rating FROM codes""",
    "phonetic_agreement": f"""
        WITH {_SIDES}, met AS ({_texts_meeting('f', 'l', 'a')}),
        {_phonetic("SELECT a AS t FROM met UNION SELECT b FROM met", "codes")}
        SELECT a, b, CASE WHEN a = b THEN 100 WHEN {_AGREE} THEN 90 ELSE 0 END AS score
        FROM met JOIN codes p ON p.t = a JOIN codes q ON q.t = b""",
    "block_sizes": f"""
        WITH {_SIDES}
        SELECT zip, zip4, left_rows, right_rows, CAST(left_rows AS DOUBLE) * right_rows AS pairs
        FROM (SELECT zip_key AS zip, zip4_key AS zip4, count(*) AS left_rows FROM people
              WHERE zip_key <> '' AND a <> '' GROUP BY ALL)
        JOIN (SELECT zip_key AS zip, zip4_key AS zip4, count(*) AS right_rows FROM consumers
              WHERE zip_key <> '' AND a <> '' GROUP BY ALL) USING (zip, zip4)""",
    "comparison_sizes": f"""
        WITH {_SIDES},
        blocks AS (SELECT p.zip_key, p.zip4_key, count(*) AS pairs FROM people p JOIN consumers c ON {_MEETING} GROUP BY ALL)
        SELECT (SELECT count(*) FROM orders) AS list_rows, (SELECT count(*) FROM customer) AS consumer_rows,
               CAST((SELECT count(*) FROM orders) AS DOUBLE) * (SELECT count(*) FROM customer) AS unblocked_pairs,
               CAST(sum(pairs) AS DOUBLE) AS blocked_pairs, CAST(max(pairs) AS DOUBLE) AS largest_block
        FROM blocks""",
    "candidate_pairs": f"WITH {_SIDES} SELECT p.finder_number, c.id AS match_id FROM people p JOIN consumers c ON {_MEETING}",
    "match_best": f"WITH {_matches()} SELECT * FROM matches",
    "match_phonetic": f"WITH {_matches(phonetic=True)} SELECT * FROM matches",
    "match_phonetic_low": f"WITH {_matches(85, phonetic=True)} SELECT * FROM matches",
    "match_best_narrowed": f"WITH {_matches()} SELECT * FROM matches",
    "match_phonetic_narrowed": f"WITH {_matches(85, phonetic=True)} SELECT * FROM matches",
    "match_low_household": f"WITH {_matches(household=75)} SELECT * FROM matches",
    "match_house_number": f"WITH {_matches(85, house_number=True)} SELECT * FROM matches",
    "match_one_state": f"WITH {_matches(state='OH')} SELECT * FROM matches",
    "match_every_row": f"""
        WITH {_matches()},
        rows AS (SELECT {_LIST_COLUMNS} FROM {PEOPLE})
        SELECT r.*, {_MATCH_COLUMNS.replace('match_type', "coalesce(m.match_type, 'NO_MATCH') AS match_type")}
        FROM rows r LEFT JOIN matches m
          ON r.firstname IS NOT DISTINCT FROM m.firstname AND r.lastname IS NOT DISTINCT FROM m.lastname
         AND r.street IS NOT DISTINCT FROM m.street AND r.zipcode IS NOT DISTINCT FROM m.zipcode
         AND r.plus4 IS NOT DISTINCT FROM m.plus4""",
    "match_type_distribution": f"""
        WITH {_matches()}
        SELECT match_type, count(*) AS match_count, round(avg(match_overall_score), 2) AS avg_overall_score
        FROM matches GROUP BY match_type""",
    "score_distribution": f"""
        WITH {_matches()}
        SELECT match_type, count(*) AS match_count,
               round(avg(match_first_name_score), 2) AS avg_first_name_score,
               round(avg(match_last_name_score), 2) AS avg_last_name_score,
               round(avg(match_address_score), 2) AS avg_address_score,
               min(match_last_name_score) AS min_last_name_score,
               max(match_last_name_score) AS max_last_name_score
        FROM matches GROUP BY match_type""",
    "geo_flat": f"WITH {_flat()} SELECT * FROM flat",
    "geo_flat_compat": f"WITH {_flat(compat=True)} SELECT * FROM flat",
    "geo_tier_summary": f"""
        WITH {_flat()}
        SELECT tier, count(*) AS row_count,
               count(*) FILTER (geo_type = 'zip') AS zip_count,
               count(*) FILTER (geo_type = 'scf') AS scf_count,
               count(*) FILTER (geo_type = 'state') AS state_count,
               coalesce(string_agg(geo_value, ',' ORDER BY geo_value) FILTER (geo_type = 'state'), '') AS audience_states,
               coalesce((SELECT string_agg(st, ',' ORDER BY st) FROM labels WHERE labels.tier = flat.tier), '') AS label_states
        FROM flat GROUP BY tier""",
    "geo_tier_pivot": f"""
        WITH {_flat()}
        SELECT tier, count(*) FILTER (geo_type = 'zip') AS zip, count(*) FILTER (geo_type = 'scf') AS scf,
               count(*) FILTER (geo_type = 'state') AS state FROM flat GROUP BY tier""",
    "geo_type_counts": f"""
        WITH {_flat()}
        SELECT geo_type, count(*) AS row_count, count(DISTINCT tier) AS tiers FROM flat GROUP BY geo_type""",
    "geo_distinct_tiers": f"WITH {_flat()} SELECT count(DISTINCT tier) AS tiers FROM flat",
}

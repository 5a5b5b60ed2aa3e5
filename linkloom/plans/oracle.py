"""The queries' results in DuckDB SQL, written from the definitions."""

from __future__ import annotations

#: Fixed values of the definitions, stated here again so that the twins don't share the queries' tables.
LETTER_PAIRS = {"ß": "ss", "æ": "ae", "œ": "oe", "ø": "o", "đ": "d", "ð": "d", "þ": "th", "ł": "l", "ı": "i"}
LEGAL_SUFFIXES = "and co|and company|private limited|pvt ltd|co|company|corp|corporation|inc|incorporated|limited|llc|llp|ltd|plc|pvt|sas|sarl"
ADDRESS_WORDS = "apt apartment,ave avenue,bldg building,blvd boulevard,dr drive,fl floor,hwy highway,ln lane,no number,rd road,ste suite,st street"
#: Thresholds: 0.30 to 0.95 by 0.05; 0.05 to 0.95 by 0.02 and four above.
GRID = [x / 100 for x in range(30, 100, 5)]
FINE_GRID = [x / 100 for x in range(5, 97, 2)] + [0.97, 0.98, 0.99, 0.995]


def _norm(x: str) -> str:
    out = f"strip_accents(lower(coalesce({x}, '')))"
    for a, b in LETTER_PAIRS.items():
        out = f"replace({out}, '{a}', '{b}')"
    return f"trim(regexp_replace({out}, '[^a-z0-9]+', ' ', 'g'))"


def _words(x: str) -> str:
    return f"list_filter(string_split({x}, ' '), lambda w: w <> '')"


def _skeleton(t: str) -> str:
    for a, b in (("ph", "f"), ("w", "v"), ("z", "j"), ("x", "ks"), ("c", "k"), ("q", "k")):
        t = f"replace({t}, '{a}', '{b}')"
    kept = f"list_transform([{t}], lambda r: substr(r, 1, 1) || regexp_replace(substr(r, 2), '[aeiouyh]', '', 'g'))"
    return f"list_transform({kept}, lambda s: array_to_string(list_filter(string_split(s, ''), lambda c, i: i = 1 OR c <> substr(s, (i - 1)::BIGINT, 1)), ''))[1]"


def _zeros(t: str) -> str:
    return f"CASE WHEN regexp_full_match({t}, '0+') THEN '0' ELSE regexp_replace({t}, '^0+', '') END"


def _fbeta(nt: str = "nt", np: str = "np", tp: str = "tp") -> str:
    return f"CASE WHEN {nt} = 0 AND {np} = 0 THEN 1.0::DOUBLE WHEN {tp} = 0 THEN 0.0::DOUBLE ELSE 1.25 * {tp}::DOUBLE / (0.25 * {nt} + {np}) END"


def _md5(x: str) -> str:
    return f"('0x' || substr(md5({x}), 1, 8))::UBIGINT::BIGINT"


DOCS = """
raw AS (SELECT doc_id, lang AS country, string_split(text, ' ')[1:12] AS w FROM documents),
heads AS (SELECT array_to_string(w[1:8], ' ') AS head, min(doc_id) AS own, count(*) AS n FROM raw GROUP BY 1),
owned AS (SELECT raw.*, own, n, doc_id <> own AS member FROM raw JOIN heads ON array_to_string(w[1:8], ' ') = head),
sourced AS (SELECT *, CASE WHEN member THEN CASE WHEN doc_id % 2 = 0 THEN 'S2' ELSE 'S3' END
    WHEN n = 1 AND doc_id % 4 = 3 THEN CASE WHEN doc_id % 8 = 3 THEN 'S2' ELSE 'S3' END ELSE 'S1' END AS src FROM owned),
er_docs AS (SELECT src || '-' || doc_id AS entity_id, array_to_string(w[1:4], ' ') AS business_name,
    CASE WHEN doc_id % 11 = 0 THEN '' ELSE array_to_string(w[5:12], ' ') || ' ' || (own % 97 + CASE WHEN member AND doc_id % 3 = 0 THEN 1 ELSE 0 END) END AS business_address,
    country, src, doc_id, CASE WHEN member THEN 'S1-' || own END AS owner_id FROM sourced)
"""
PARTS = """
er_parts AS (SELECT 'S' || (p_partkey % 3 + 1) || '-' || p_partkey AS entity_id, p_name AS business_name,
    p_size || ' ' || p_brand || ' ' || p_type AS business_address, p_type AS country, 'S' || (p_partkey % 3 + 1) AS src, NULL::VARCHAR AS owner_id FROM part)
"""
EVAL = """
entities AS (SELECT o_orderkey AS s1_id, c_nationkey AS country FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
scored AS (SELECT l_orderkey AS s1_id, l_linenumber AS rec_id, max((l_returnflag = 'R')::INTEGER) AS label, round(max(l_discount) * 10, 6) AS score FROM lineitem GROUP BY 1, 2)
"""


def _prepared(source: str) -> str:
    short = f"list_transform(list_filter(string_split(address, ' '), lambda t: length(t) >= 2 OR regexp_full_match(t, '[0-9]')), lambda t: CASE WHEN regexp_full_match(t, '[0-9]+') THEN {_zeros('t')} ELSE t END)"
    return f"""
normed AS (SELECT *, {_norm("business_name")} AS name, {_norm("business_address")} AS address FROM {source}),
shortened AS (SELECT *, {short} AS short FROM normed),
prepared AS (SELECT * EXCLUDE (short),
    array_to_string(list_transform({_words("name")}, lambda t: {_skeleton("t")}), ' ') AS skeleton,
    list_sort(list_distinct(list_concat(list_concat(list_filter({_words("name")}, lambda t: length(t) > 1 OR regexp_full_match(t, '[0-9]')), ['~' || substr(replace(name, ' ', ''), 1, 8)]),
        list_transform(list_filter({_words("name")}, lambda t: regexp_full_match(t, '[a-z]{{3,}}')), lambda t: 'sk' || {_skeleton("t")})))) AS name_tokens,
    list_sort(list_distinct(list_concat(short, list_transform(list_filter(short, lambda t: regexp_full_match(t, '[0-9]{{2,}}')), lambda t: 's2' || right(t, 2))))) AS address_tokens,
    list_sort(list_distinct(list_transform(regexp_extract_all(address, '[0-9]+'), lambda t: {_zeros("t")}))) AS numbers
  FROM shortened)
"""


KEYS = """
ntok AS (SELECT entity_id, src, country, unnest(name_tokens) AS t FROM prepared),
atok AS (SELECT entity_id, src, country, unnest(address_tokens) AS t FROM prepared),
keys AS (
  SELECT x.entity_id, x.src, x.country, 'A' AS ktype, x.t || '|' || y.t AS key FROM atok x JOIN atok y ON x.entity_id = y.entity_id AND x.t < y.t
  UNION ALL SELECT x.entity_id, x.src, x.country, 'X', x.t || '|' || y.t FROM ntok x JOIN atok y ON x.entity_id = y.entity_id
  UNION ALL SELECT x.entity_id, x.src, x.country, 'N', x.t || '|' || y.t FROM ntok x JOIN ntok y ON x.entity_id = y.entity_id AND x.t < y.t),
caps AS (SELECT country, greatest(8, round_even(3e-5 * count(*), 0)::BIGINT) AS cap FROM prepared WHERE src = 'S1' GROUP BY 1),
usable AS (SELECT country, ktype, key, df, cap FROM (SELECT country, ktype, key, count(*) AS df FROM keys WHERE src = 'S1' GROUP BY 1, 2, 3) JOIN caps USING (country) WHERE df <= cap)
"""
EVIDENCE = """
evidence AS (
  SELECT p.country, p.entity_id AS rec_id, s.entity_id AS s1_id,
    sum(CASE WHEN ktype = 'A' THEN 1.0::DOUBLE / df ELSE 0 END) AS sA, count(*) FILTER (ktype = 'A') AS nA, coalesce(min(df) FILTER (ktype = 'A'), 9999) AS mdA,
    sum(CASE WHEN ktype = 'X' THEN 1.0::DOUBLE / df ELSE 0 END) AS sX, count(*) FILTER (ktype = 'X') AS nX, coalesce(min(df) FILTER (ktype = 'X'), 9999) AS mdX,
    sum(CASE WHEN ktype = 'N' THEN 1.0::DOUBLE / df ELSE 0 END) AS sN, count(*) FILTER (ktype = 'N') AS nN, coalesce(min(df) FILTER (ktype = 'N'), 9999) AS mdN, max(cap) AS cap
  FROM keys p JOIN usable u USING (country, ktype, key) JOIN keys s USING (country, ktype, key) WHERE p.src <> 'S1' AND s.src = 'S1' GROUP BY 1, 2, 3),
pairs AS (SELECT *, round(sA + sX + sN, 9) AS ksum, least(mdA, mdX, mdN) AS mindf FROM evidence),
ranked AS (SELECT *, count(*) OVER r AS ncand_rec, row_number() OVER (r ORDER BY ksum DESC, s1_id) - 1 AS krank, ksum / max(ksum) OVER r AS kshare,
    (max(ksum) OVER r - coalesce(nth_value(ksum, 2) OVER (r ORDER BY ksum DESC, s1_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 0)) / max(ksum) OVER r AS kgap
  FROM pairs WINDOW r AS (PARTITION BY country, rec_id)),
top AS (SELECT * FROM ranked WHERE krank < 8)
"""
TRUTH = "truth AS (SELECT owner_id AS s1_id, entity_id AS rec_id FROM er_docs WHERE owner_id IS NOT NULL)"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_D, _P = _with(DOCS, _prepared("er_docs")), _with(PARTS, _prepared("er_parts"))
_DE, _PE = _with(DOCS, _prepared("er_docs"), KEYS, EVIDENCE, TRUTH), _with(PARTS, _prepared("er_parts"), KEYS, EVIDENCE)
_E = _with(EVAL)
_EVIDENCE_ROWS = "SELECT country, rec_id, s1_id, round(sA, 6) AS sA, round(sX, 6) AS sX, round(sN, 6) AS sN, nA, nX, nN, mdA, mdX, mdN, cap, round(ksum, 6) AS ksum, mindf FROM pairs"
_TOP_ROWS = "SELECT country, rec_id, s1_id, ncand_rec, krank, round(kshare, 6) AS kshare, round(kgap, 6) AS kgap, mindf FROM top"
_COUNTS = "counts AS (SELECT e.s1_id, e.country, coalesce(sum(label), 0) AS nt, count(*) FILTER (score >= 0.5) AS np, coalesce(sum(label) FILTER (score >= 0.5), 0) AS tp FROM entities e LEFT JOIN scored s USING (s1_id) GROUP BY 1, 2)"
_EC = _with(EVAL, _COUNTS)
_REPORT = f"""
SELECT country, count(*) AS entities, round(avg(f), 6) AS macro_f, round(avg(f) FILTER (nt > 0), 6) AS linked_macro_f,
  round(count(*) FILTER (np = tp AND tp = nt) / count(*), 6) AS exact_rate,
  round(count(*) FILTER (nt = 0 AND np = 0) / nullif(count(*) FILTER (nt = 0), 0), 6) AS singleton_accuracy,
  round(count(*) FILTER (nt = 0 AND np > 0) / nullif(count(*) FILTER (nt = 0), 0), 6) AS singleton_false_rate,
  sum(nt)::BIGINT AS true_links, sum(np)::BIGINT AS predicted_links, sum(tp)::BIGINT AS hits,
  round(sum(tp) / nullif(sum(np), 0), 6) AS link_precision, round(sum(tp) / nullif(sum(nt), 0), 6) AS link_recall
FROM (SELECT *, {_fbeta()} AS f FROM counts) GROUP BY GROUPING SETS ((), (country))
"""


def _scan(grid: list[float]) -> str:
    values = ", ".join(f"({t}::DOUBLE)" for t in grid)
    return _with(
        EVAL,
        f"grid(t) AS (VALUES {values})",
        "per AS (SELECT t, e.s1_id, coalesce(sum(label), 0) AS nt, count(*) FILTER (score >= t) AS np, coalesce(sum(label) FILTER (score >= t), 0) AS tp FROM grid CROSS JOIN entities e LEFT JOIN scored s USING (s1_id) GROUP BY 1, 2)",
        f"""scan AS (SELECT t, round(avg({_fbeta()}), 6) AS macro_f, sum(np)::BIGINT AS predicted, sum(tp)::BIGINT AS hits, count(*) FILTER (np = tp AND tp = nt) AS exact,
            count(*) FILTER (nt = 0 AND np = 0) AS singletons_right, count(*) AS entities, sum(nt) AS links, count(*) FILTER (nt = 0) AS singletons FROM per GROUP BY 1)""",
    )


def _lcs_ratio(a: str, b: str) -> str:
    """200 LCS / (|a| + |b|) by bit-parallel steps on 128-bit integers; both empty 100."""
    mask = "list_sum(list_transform(string_split(p.a, ''), lambda x, i: CASE WHEN x = c THEN 1::HUGEINT << (i - 1)::INTEGER ELSE 0::HUGEINT END))::HUGEINT"
    full = "((1::HUGEINT << length(p.a)::INTEGER) - 1)"
    state = f"list_reduce(list_transform(string_split(p.b, ''), lambda c: {mask}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    lcs = f"(length(p.a) - bit_count({state}))"
    return f"list_transform([{{'a': {a}, 'b': {b}}}], lambda p: CASE WHEN p.a = '' AND p.b = '' THEN 100.0::DOUBLE WHEN p.a = '' OR p.b = '' THEN 0.0::DOUBLE ELSE 200.0::DOUBLE * {lcs} / (length(p.a) + length(p.b)) END)[1]"


_SORTED = "array_to_string(list_sort(" + _words("{0}") + "), ' ')"


def _jaccard(a: str, b: str, scale: str = "1.0") -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE ELSE {scale}::DOUBLE * len(list_intersect({a}, {b})) / len(list_distinct(list_concat({a}, {b}))) END"


def _distinct_words(x: str) -> str:
    return f"list_distinct({_words(x)})"


_CONSENSUS = f"""
conf AS (SELECT country, s1_id, rec_id, round(kshare, 6) AS p1 FROM top),
rec AS (SELECT entity_id, src, address, numbers, {_distinct_words("name")} AS nw, {_distinct_words("address")} AS aw FROM prepared),
others AS (SELECT a.country, a.s1_id, a.rec_id, m.p1 AS pm, x.src AS xs, y.src AS ys, x.numbers AS xn, y.numbers AS yn,
    {_jaccard("x.nw", "y.nw", "100")} AS sn, {_jaccard("x.aw", "y.aw", "100")} AS sa
  FROM conf a JOIN conf m ON a.country = m.country AND a.s1_id = m.s1_id AND a.rec_id <> m.rec_id AND m.p1 >= 0.5
  JOIN rec x ON x.entity_id = a.rec_id JOIN rec y ON y.entity_id = m.rec_id),
found AS (SELECT country, s1_id, rec_id, count(*) FILTER (sa >= 90 AND sn >= 80) AS sup, count(*) FILTER (sa >= 90 AND sn >= 80 AND xs <> ys) AS cross_,
    max(sn * pm) AS bestn, max(sa * pm) AS besta, count(*) FILTER (len(xn) > 0 AND xn = yn) AS numagree FROM others GROUP BY 1, 2, 3)
"""

_CORE = f"( ({LEGAL_SUFFIXES}))+$"
_ADDRESS_MAP = "MAP {" + ", ".join("'{}': '{}'".format(*x.split()) for x in ADDRESS_WORDS.split(",")) + "}"


def _view(x: str) -> str:
    return rf"trim(regexp_replace(replace(lower(replace(coalesce({x}, ''), 'ß', 'ss')), '&', ' and '), '[^\p{{L}}\p{{N}}\p{{M}}]+', ' ', 'g'))"


def _grams(x: str) -> str:
    padded = f"'^' || trim(regexp_replace({x}, ' +', ' ', 'g')) || '$'"
    return f"list_transform([{padded}], lambda p: CASE WHEN length(p) <= 2 THEN []::VARCHAR[] ELSE list_sort(list_distinct(list_transform(range(1, greatest(length(p) - 2, 1) + 1), lambda i: substr(p, i, 3)))) END)[1]"


def _simhash(grams: str) -> str:
    """Bits of the 64-bit hash as a list, the lowest first; a gram's hash is two numbers of 32 bits."""
    part = lambda of, at: f"list_transform({of}, lambda g: ('0x' || substr(md5(g), {at}, 8))::UBIGINT::BIGINT)"
    bit = lambda of: f"list_transform(range(32), lambda b: CASE WHEN len(p.{of}) > 0 AND 2 * len(list_filter(p.{of}, lambda v: (v >> b::INTEGER) & 1 = 1)) >= len(p.{of}) THEN 1 ELSE 0 END)"
    return f"list_transform([{grams}], lambda q: list_transform([{{'lo': {part('q', 9)}, 'hi': {part('q', 1)}}}], lambda p: list_concat({bit('lo')}, {bit('hi')}))[1])[1]"


def _views() -> str:
    bare = f"trim(regexp_replace(' ' || name_view, '{_CORE}', ''))"
    return rf"""
v1 AS (SELECT *, {_view("business_name")} AS name_view, {_view("business_address")} AS address_view FROM er_docs),
v2 AS (SELECT *, strip_accents(name_view) AS name_fold, strip_accents(address_view) AS address_fold, CASE WHEN {bare} = '' THEN name_view ELSE {bare} END AS name_core,
    array_to_string(list_transform({_words("address_view")}, lambda t: coalesce(({_ADDRESS_MAP})[t], t)), ' ') AS canonical FROM v1),
v3 AS (SELECT *, list_filter({_words("canonical")}, lambda t: regexp_full_match(t, '[0-9]+[a-z]*')) AS address_numbers, list_filter({_words("name_view")}, lambda t: regexp_full_match(t, '[0-9]+[a-z]*')) AS name_numbers,
    coalesce(list_filter({_words("canonical")}, lambda t: length(t) >= 3 AND regexp_matches(t, '\p{{L}}'))[-1], '') AS tail,
    {_simhash(_grams("CASE WHEN name_core = '' THEN name_view ELSE name_core END"))} AS name_hash, {_simhash(_grams("canonical"))} AS address_hash FROM v2),
views AS (SELECT *, coalesce(address_numbers[1], '') AS first_number, coalesce(address_numbers[-1], '') AS last_number FROM v3)
"""


def _channels() -> str:
    parts = [f"SELECT entity_id, src, country, {1 << i} AS bit, {c} AS key FROM views WHERE {c} <> ''" for i, c in enumerate(("name_view", "name_core", "address_view", "canonical"))]
    parts += [f"SELECT entity_id, src, country, {1 << i}, '{b}|' || array_to_string({h}[{16 * b + 1}:{16 * b + 16}], '') FROM views WHERE {of} <> ''" for i, of, h in ((4, "name_view", "name_hash"), (5, "canonical", "address_hash")) for b in range(4)]
    parts += [f"SELECT entity_id, src, country, {1 << i}, {c} || '|' || tail FROM views WHERE {c} <> '' AND tail <> ''" for i, c in ((6, "first_number"), (7, "last_number"))]
    usable = "channel_usable AS (SELECT country, bit, key FROM channel_keys WHERE src <> 'S1' GROUP BY 1, 2, 3 HAVING count(*) <= CASE WHEN bit < 16 THEN 2000 ELSE 800 END)"
    return "channel_keys AS (" + " UNION ALL ".join(parts) + "),\n" + usable + ",\nchannel_pairs AS (SELECT country, s.entity_id AS s1_id, p.entity_id AS rec_id, bit_or(bit)::INTEGER AS mask FROM channel_keys s JOIN channel_usable USING (country, bit, key) JOIN channel_keys p USING (country, bit, key) WHERE s.src = 'S1' AND p.src <> 'S1' GROUP BY 1, 2, 3)"


_DV, _DC = _with(DOCS, _views()), _with(DOCS, TRUTH, _views(), _channels())


def _channel_scores() -> str:
    jac = lambda c: _jaccard(_distinct_words(f"a.{c}"), _distinct_words(f"b.{c}"))
    digits = "list_distinct(a.address_numbers)", "list_distinct(b.address_numbers)"
    both = f"len({digits[0]}) > 0 AND len({digits[1]}) > 0"
    name, address = f"greatest({jac('name_fold')}, {jac('name_core')})", jac("canonical")
    base = f"CASE WHEN a.canonical <> '' AND b.canonical <> '' THEN 0.57::DOUBLE * {name} + 0.33::DOUBLE * {address} ELSE 0.82::DOUBLE * {name} END"
    extra = f"(CASE WHEN mask & 3 > 0 THEN 0.06::DOUBLE ELSE 0 END) + (CASE WHEN mask & 12 > 0 THEN 0.04::DOUBLE ELSE 0 END) + 0.03::DOUBLE * least(bit_count(mask), 3) / 3 + (CASE WHEN {both} AND list_sort({digits[0]}) = list_sort({digits[1]}) THEN 0.04::DOUBLE ELSE 0 END) - (CASE WHEN {both} AND len(list_intersect({digits[0]}, {digits[1]})) = 0 THEN 0.16::DOUBLE ELSE 0 END)"
    return f"""
heuristic AS (SELECT s1_id, rec_id, round(greatest(0, least(1, {base} + {extra})), 6) AS score FROM channel_pairs c JOIN views a ON a.entity_id = s1_id JOIN views b ON b.entity_id = rec_id),
pool AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY score DESC, rec_id) AS place FROM heuristic) WHERE place <= 40)
"""


_DS = _with(DOCS, TRUTH, _views(), _channels(), _channel_scores())
_SPLIT = lambda x: f"CASE WHEN {_md5(f'42::VARCHAR || {chr(39)}:{chr(39)} || {x}')} / 4294967296.0::DOUBLE < 0.8 THEN 'train' WHEN {_md5(f'42::VARCHAR || {chr(39)}:{chr(39)} || {x}')} / 4294967296.0::DOUBLE < 0.9 THEN 'calibration' ELSE 'holdout' END"
_U = lambda seed, x: f"{_md5(f'{chr(39)}{seed}:{chr(39)} || {x}')} / 4294967296.0::DOUBLE"

_HN_PAIR = "hn AS (SELECT rec_id, s1_id, a.numbers AS a, b.numbers AS b, flatten(list_transform(a.numbers, lambda x: list_transform(b.numbers, lambda y: {'x': x, 'y': y}))) AS c, len(a.numbers) = 0 OR len(b.numbers) = 0 AS missing FROM top JOIN prepared a ON a.entity_id = s1_id JOIN prepared b ON b.entity_id = rec_id)"
_some = lambda test: f"CASE WHEN missing THEN -1 ELSE (len(list_filter(c, lambda p: {test})) > 0)::INTEGER END"

_IDF = f"""
band AS (SELECT country, s1_id, rec_id FROM top WHERE kshare BETWEEN 0.05 AND 0.97),
s1n AS (SELECT country, count(*) AS n FROM prepared WHERE src = 'S1' GROUP BY 1),
df AS (SELECT country, token, count(*) AS df FROM (SELECT country, unnest({_distinct_words("name")}) AS token FROM prepared WHERE src = 'S1') GROUP BY 1, 2),
words AS (SELECT entity_id, {_distinct_words("name")} AS w FROM prepared),
split AS (SELECT t.country, s1_id, rec_id, a.w AS a, b.w AS b FROM band t JOIN words a ON a.entity_id = s1_id JOIN words b ON b.entity_id = rec_id),
kinds AS (SELECT country, s1_id, rec_id, 'com' AS kind, unnest(list_filter(a, lambda x: list_contains(b, x))) AS token FROM split
  UNION ALL SELECT country, s1_id, rec_id, 'mis', unnest(list_filter(a, lambda x: NOT list_contains(b, x))) FROM split
  UNION ALL SELECT country, s1_id, rec_id, 'ext', unnest(list_filter(b, lambda x: NOT list_contains(a, x))) FROM split),
rated AS (SELECT k.*, ln((n + 1) / (coalesce(df, 0) + 1)) / ln(n + 1) AS idf FROM kinds k JOIN s1n USING (country) LEFT JOIN df USING (country, token)),
sums AS (SELECT country, s1_id, rec_id, coalesce(sum(idf) FILTER (kind = 'com'), 0) AS ncom, coalesce(sum(idf) FILTER (kind = 'mis'), 0) AS nmis, coalesce(sum(idf) FILTER (kind = 'ext'), 0) AS next,
  coalesce(max(idf) FILTER (kind = 'mis'), 0) AS nmaxmis, coalesce(max(idf) FILTER (kind = 'ext'), 0) AS nmaxext FROM rated GROUP BY 1, 2, 3)
"""

ORACLE = {
    "norm_text": _D + "SELECT entity_id, name, address FROM prepared",
    "text_flags": _with(DOCS, "s AS (SELECT 'p' || page_id AS id, url AS s FROM pages UNION ALL SELECT entity_id, business_name FROM er_docs)") + r"SELECT id, regexp_matches(regexp_replace(s, '[\x{0000}-\x{024F}]', '', 'g'), '\p{L}') AS non_latin, regexp_matches(lower(s), '\.(com|net|org|in|fr|co|io)\b|^[#@]') AS domain FROM s",
    "skeletons": _D + "SELECT entity_id, skeleton FROM prepared UNION ALL SELECT * FROM (" + _P + "SELECT entity_id, skeleton FROM prepared)",
    "token_views": _D + "SELECT entity_id, array_to_string(name_tokens, ' ') AS name_tokens, array_to_string(address_tokens, ' ') AS address_tokens, array_to_string(numbers, ' ') AS numbers FROM prepared",
    "record_keys": _DE + "SELECT entity_id, ktype, key FROM keys",
    "key_df_capped": _DE + "SELECT country, ktype, key, df, cap FROM usable",
    "candidates_evidence": _DE + _EVIDENCE_ROWS,
    "candidates_evidence_parts": _PE + _EVIDENCE_ROWS,
    "candidates_topk": _DE + _TOP_ROWS,
    "candidates_topk_parts": _PE + _TOP_ROWS,
    "owner_partition": _with(DOCS) + "SELECT country, src, CASE WHEN owner_id IS NULL THEN 'orphan' ELSE 'owned' END AS kind, count(*) AS records, count(DISTINCT owner_id) AS owners FROM er_docs WHERE src <> 'S1' GROUP BY 1, 2, 3",
    "candidate_recall": _DE + f"""SELECT sum(nt)::BIGINT AS links, sum(tp)::BIGINT AS recalled, round(sum(tp) / nullif(sum(nt), 0), 6) AS recall, round(avg({_fbeta("nt", "tp", "tp")}), 6) AS ceiling FROM (
        SELECT p.entity_id, (SELECT count(*) FROM truth t WHERE t.s1_id = p.entity_id) AS nt, (SELECT count(*) FROM top JOIN truth t USING (s1_id, rec_id) WHERE t.s1_id = p.entity_id) AS tp FROM prepared p WHERE src = 'S1')""",
    "recall_at_k": _DE + "SELECT k::INTEGER AS k, count(h.krank) AS recalled, round(count(h.krank) / nullif((SELECT count(*) FROM truth), 0), 6) AS recall FROM range(1, 17) g(k) LEFT JOIN (SELECT krank FROM ranked JOIN truth USING (s1_id, rec_id)) h ON h.krank < k GROUP BY 1",
    "number_features": _PE + r"""SELECT rec_id, s1_id, CASE WHEN len(a.numbers) > 0 AND len(b.numbers) > 0 THEN round(len(list_intersect(a.numbers, b.numbers))::DOUBLE / len(list_distinct(list_concat(a.numbers, b.numbers))), 6) ELSE -1.0::DOUBLE END AS numj,
        CASE WHEN len(a.numbers) > 0 AND len(b.numbers) > 0 THEN (a.numbers = b.numbers)::INTEGER::DOUBLE ELSE -1.0::DOUBLE END AS numeq, length(b.name)::INTEGER AS lnn, length(b.address)::INTEGER AS lna,
        regexp_matches(regexp_replace(b.business_name, '[\x{0000}-\x{024F}]', '', 'g'), '\p{L}')::INTEGER AS nonlat, regexp_matches(lower(b.business_name), '\.(com|net|org|in|fr|co|io)\b|^[#@]')::INTEGER AS dom, (b.address = '')::INTEGER AS aempty, (b.src = 'S2')::INTEGER AS "isS2",
        least(mindf, 9999) / cap::DOUBLE AS mindf_rel, least(mdA, 9999) / cap::DOUBLE AS mdA_rel, least(mdX, 9999) / cap::DOUBLE AS mdX_rel, least(mdN, 9999) / cap::DOUBLE AS mdN_rel
        FROM top JOIN prepared a ON a.entity_id = s1_id JOIN prepared b ON b.entity_id = rec_id""",
    "ratio_features": _DE + f"""SELECT rec_id, s1_id, round({_lcs_ratio("a.name", "b.name")}) AS nr, round({_lcs_ratio("a.skeleton", "b.skeleton")}) AS nsk, round({_lcs_ratio(_SORTED.format("a.name"), _SORTED.format("b.name"))}) AS nso,
        CASE WHEN b.address = '' THEN -1.0::DOUBLE ELSE round({_lcs_ratio("a.address", "b.address")}) END AS ar
        FROM top JOIN prepared a ON a.entity_id = s1_id JOIN prepared b ON b.entity_id = rec_id""",
    "least_safe_k": _DE.rstrip() + ",\ncurve AS (SELECT k, round(count(h.krank) / nullif((SELECT count(*) FROM truth), 0), 6) AS recall FROM range(1, 17) g(k) LEFT JOIN (SELECT krank FROM ranked JOIN truth USING (s1_id, rec_id)) h ON h.krank < k GROUP BY 1) SELECT min(k)::INTEGER AS k FROM curve WHERE recall >= (SELECT round(max(recall) - 0.002, 6) FROM curve)",
    "consensus_support": _with(DOCS, _prepared("er_docs"), KEYS, EVIDENCE, _CONSENSUS) + """SELECT c.country, c.s1_id, c.rec_id, p1, sum((p1 >= 0.5)::BIGINT) OVER (PARTITION BY c.country, c.s1_id)::BIGINT - (p1 >= 0.5)::BIGINT AS nconf_others,
        coalesce(sup, 0) AS sup, coalesce(cross_, 0) AS cross, round(coalesce(bestn, 0), 9) AS bestn, round(coalesce(besta, 0), 9) AS besta, coalesce(numagree, 0) AS numagree FROM conf c LEFT JOIN found f ON f.country = c.country AND f.s1_id = c.s1_id AND f.rec_id = c.rec_id""",
    "band_idf": _with(DOCS, _prepared("er_docs"), KEYS, EVIDENCE, _IDF) + "SELECT country, s1_id, rec_id, " + ", ".join(f"round(coalesce({c}, 0), 6) AS {c}" for c in ("ncom", "nmis", "next", "nmaxmis", "nmaxext")) + ", round(coalesce(ncom / (ncom + nmis + next + 1e-9), 0), 6) AS njac FROM band LEFT JOIN sums USING (country, s1_id, rec_id)",
    "house_number_profile": _with(PARTS, _prepared("er_parts"), KEYS, EVIDENCE, _HN_PAIR) + f"""SELECT rec_id, s1_id, CASE WHEN missing THEN -1 ELSE list_min(list_transform(c, lambda p: levenshtein(p.x, p.y)))::INTEGER END AS hn_min_edit, {_some("p.x = p.y")} AS hn_exact,
        {_some("p.x <> p.y AND (suffix(p.x, p.y) OR suffix(p.y, p.x))")} AS hn_suffix, {_some("p.x <> p.y AND length(p.x) = length(p.y) AND substr(p.x, 1, length(p.x) - 1) = substr(p.y, 1, length(p.y) - 1)")} AS hn_lastdigit, missing::INTEGER AS hn_missing,
        len(list_intersect(a, b))::INTEGER AS hn_ncommon, len(a)::INTEGER AS hn_nA, len(b)::INTEGER AS hn_nB, len(list_filter(a, lambda x: NOT list_contains(b, x)))::INTEGER AS hn_onlyA, len(list_filter(b, lambda x: NOT list_contains(a, x)))::INTEGER AS hn_onlyB FROM hn""",
    "macro_fbeta": _EC + f"""SELECT country, count(*) AS entities, round(avg(f), 6) AS macro_f, round(avg(f) FILTER (nt = 0), 6) AS singleton_f, round(avg(f) FILTER (nt > 0), 6) AS linked_f,
        round(sum(tp) / nullif(sum(np), 0), 6) AS precision, round(sum(tp) / nullif(sum(nt), 0), 6) AS recall FROM (SELECT *, {_fbeta()} AS f FROM counts) GROUP BY 1""",
    "threshold_scan": _scan(GRID) + "SELECT t, macro_f, predicted, hits FROM scan",
    "threshold_plateau": _scan(GRID) + "SELECT max(t) AS threshold, (SELECT max(macro_f) FROM scan) AS best FROM scan WHERE macro_f >= (SELECT max(macro_f) FROM scan) - 0.001",
    "threshold_curve": _scan(FINE_GRID) + """SELECT t, macro_f, round(coalesce(exact / nullif(entities, 0), 0), 6) AS exact_rate, round(coalesce(hits / nullif(predicted, 0), 0), 6) AS link_precision,
        round(coalesce(hits / nullif(links, 0), 0), 6) AS link_recall, predicted, hits, round(coalesce(singletons_right / nullif(singletons, 0), 0), 6) AS singleton_accuracy FROM scan""",
    "prefix_hits": _E + "SELECT s1_id, rec_id, row_number() OVER w AS rank, sum(label) OVER (w ROWS UNBOUNDED PRECEDING)::BIGINT AS hits FROM scored WINDOW w AS (PARTITION BY s1_id ORDER BY score DESC, rec_id)",
    "metric_report": _EC + _REPORT,
    "loss_decomposition": _with(EVAL, _COUNTS, "reach AS (SELECT s1_id, sum(label) AS ctp FROM scored WHERE score >= 0.3 GROUP BY 1)") + f"SELECT s1_id, round(({_fbeta('nt', 'coalesce(ctp, 0)', 'coalesce(ctp, 0)')}) - ({_fbeta()}), 6) AS loss, (np - tp)::BIGINT AS false_positives, (nt - tp)::BIGINT AS false_negatives FROM counts LEFT JOIN reach USING (s1_id)",
    "one_owner": _DE + "SELECT rec_id, s1_id FROM (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY ksum DESC, s1_id) AS place FROM pairs) WHERE place = 1",
    "entity_lists": _E + "SELECT e.s1_id, coalesce(string_agg(rec_id::VARCHAR, ',' ORDER BY score DESC, rec_id::VARCHAR), '') AS ids FROM entities e LEFT JOIN scored s ON s.s1_id = e.s1_id AND score >= 0.5 GROUP BY 1",
    "inference_diagnostics": _with(DOCS, _prepared("er_docs"), KEYS, EVIDENCE, "got AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rec_id ORDER BY ksum DESC, s1_id) AS place FROM top WHERE kshare >= 0.5) WHERE place = 1)", "base AS (SELECT country, count(*) FILTER (src = 'S1') AS n, count(*) FILTER (src <> 'S1') AS np FROM prepared GROUP BY 1)") + """
        SELECT country, n AS n_s1, np AS n_pool, coalesce(pairs, 0) AS pairs, round(coalesce(pairs, 0) / nullif(n, 0), 6) AS candidates_per_s1, round((n - coalesce(wc, 0)) / nullif(n, 0), 6) AS no_candidate,
          round((n - coalesce(ms, 0)) / nullif(n, 0), 6) AS singleton_rate, round(coalesce(m, 0) / nullif(n, 0), 6) AS mean_matches, round(coalesce(mp, 0) / nullif(np, 0), 6) AS pool_matched
        FROM base LEFT JOIN (SELECT country, count(*) AS pairs, count(DISTINCT s1_id) AS wc FROM top GROUP BY 1) USING (country) LEFT JOIN (SELECT country, count(*) AS m, count(DISTINCT s1_id) AS ms, count(DISTINCT rec_id) AS mp FROM got GROUP BY 1) USING (country)""",
    "keyed_score": _EC + _REPORT,
    "aligned_score": _EC + f"SELECT count(*) AS entities, round(avg({_fbeta()}), 6) AS macro_f FROM counts",
    "validate_outputs": _E + """SELECT problem, count(*) AS n FROM (
        SELECT s1_id, 'no match row' AS problem FROM entities WHERE s1_id % 50 = 7
        UNION ALL SELECT DISTINCT s1_id, 'match is no candidate' FROM scored WHERE s1_id % 50 <> 7 AND score >= 0.5 AND NOT (score >= 0.6 OR s1_id % 3 <> 0) AND s1_id IN (SELECT s1_id FROM entities)) GROUP BY 1""",
    "list_counters": _E + "SELECT (SELECT count(*) FROM entities) AS rows, (SELECT count(*) FROM entities WHERE s1_id NOT IN (SELECT s1_id FROM scored WHERE score >= 0.5)) AS empty_matches, (SELECT count(*) FROM scored SEMI JOIN entities USING (s1_id) WHERE score >= 0.5) AS matched_links, (SELECT count(*) FROM scored SEMI JOIN entities USING (s1_id) WHERE label = 1) AS candidate_links",
    "profile_source": _with(DOCS) + "SELECT CASE WHEN trim(country) = '' THEN '<EMPTY>' ELSE country END AS country, count(*) AS rows, count(*) FILTER (trim(business_name) = '') AS blank_names, count(*) FILTER (trim(business_address) = '') AS blank_addresses, count(*) FILTER (NOT starts_with(entity_id, 'S2-')) AS prefix_errors FROM er_docs WHERE src <> 'S1' GROUP BY 1",
    "channel_retrieval": _DC + "SELECT country, s1_id, rec_id, mask FROM channel_pairs",
    "channel_popcount": _DC + "SELECT mask, count(*) AS pairs, bit_count(mask)::INTEGER AS channels, array_to_string(list_filter(list_transform(['EXACT_NAME', 'EXACT_CORE', 'EXACT_ADDRESS', 'EXACT_CANONICAL', 'NAME_LSH', 'ADDRESS_LSH', 'NUMBER_FIRST', 'NUMBER_LAST'], lambda x, i: CASE WHEN (mask >> (i - 1)::INTEGER) & 1 = 1 THEN x ELSE '' END), lambda x: x <> ''), ',') AS names FROM channel_pairs GROUP BY 1",
    "ranked_pool": _DS + "SELECT s1_id, rec_id, score, place FROM pool",
    "hard_negatives": _DS + "SELECT s1_id, rec_id, label, place FROM (SELECT p.*, (t.s1_id IS NOT NULL)::INTEGER AS label, row_number() OVER (PARTITION BY p.s1_id, t.s1_id IS NOT NULL ORDER BY place) AS n FROM pool p LEFT JOIN truth t ON t.s1_id = p.s1_id AND t.rec_id = p.rec_id) WHERE label = 1 OR n <= 3",
    "inject_missed": _DC + "SELECT coalesce(c.s1_id, t.s1_id) AS s1_id, coalesce(c.rec_id, t.rec_id) AS rec_id, coalesce(mask, 256)::INTEGER AS mask, c.s1_id IS NOT NULL AS retrieved, (t.s1_id IS NOT NULL)::INTEGER AS label FROM channel_pairs c FULL JOIN truth t ON t.s1_id = c.s1_id AND t.rec_id = c.rec_id",
    "candidate_statistics": _DE + f"""SELECT split, country, count(*) AS entities, count(*) FILTER (nc > 0) AS with_candidate, sum(nc)::BIGINT AS links, sum(nt)::BIGINT AS true_links, sum(tp)::BIGINT AS recalled,
        count(*) FILTER (nt > 0 AND tp = nt) AS all_recalled, count(*) FILTER (nt = 0) AS singletons, round(avg({_fbeta("nt", "tp", "tp")}), 6) AS oracle_f FROM (
        SELECT p.entity_id, p.country, {_SPLIT("p.entity_id")} AS split, (SELECT count(*) FROM top WHERE top.s1_id = p.entity_id) AS nc, (SELECT count(*) FROM truth t WHERE t.s1_id = p.entity_id) AS nt,
          (SELECT count(*) FROM top JOIN truth t USING (s1_id, rec_id) WHERE t.s1_id = p.entity_id) AS tp FROM prepared p WHERE src = 'S1') GROUP BY GROUPING SETS ((split), (split, country))""",
    "name_address_views": _DV + r"SELECT entity_id, name_view, name_fold, name_core, array_to_string(list_sort(list_filter(string_split(name_fold, ' '), lambda w: w <> '')), ' ') AS name_sorted, canonical, tail, array_to_string(address_numbers, ' ') AS address_numbers, CASE WHEN regexp_matches(business_name, '\p{L}') THEN 'LATIN' ELSE '' END AS scripts, address_view = '' AS address_missing FROM views",
    "split_assign": _E + f"SELECT s1_id, {_SPLIT('s1_id::VARCHAR')} AS split FROM entities",
    "match_bins": _EC + "SELECT CASE WHEN nt <= 1 THEN nt::BIGINT::VARCHAR WHEN nt <= 3 THEN '2-3' WHEN nt <= 5 THEN '4-5' ELSE '6+' END AS bin, count(*) AS entities FROM counts GROUP BY 1",
    "char_ngrams": f"SELECT p_partkey, unnest({_grams('p_name')}) AS gram FROM part",
    "universe_sample": _with(DOCS, f"chosen AS (SELECT * FROM er_docs WHERE src = 'S1' ORDER BY {_U(7, 'entity_id')}, entity_id LIMIT 100)") + f"SELECT entity_id, src FROM chosen UNION ALL SELECT entity_id, src FROM er_docs WHERE src <> 'S1' AND owner_id IN (SELECT entity_id FROM chosen) UNION ALL SELECT entity_id, src FROM er_docs WHERE src <> 'S1' AND owner_id IS NULL AND {_U(8, 'entity_id')} < 100.0::DOUBLE / (SELECT greatest(1, count(*)) FROM er_docs WHERE src = 'S1')",
    "class_capped_sample": _with(EVAL, "n AS (SELECT count(*) FILTER (label = 1) AS p, count(*) FILTER (label = 0) AS q FROM scored)", "r AS (SELECT least(q, 2000 - least(p, 800)) AS rest, p FROM n)", "take AS (SELECT rest, least(p, 2000 - rest) AS take FROM r)") + f"SELECT s1_id, rec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_U(3, chr(39) + chr(39) + ' || s1_id || ' + chr(39) + ':' + chr(39) + ' || rec_id')}, s1_id, rec_id) AS k FROM scored) CROSS JOIN take WHERE k <= CASE WHEN label = 1 THEN take ELSE rest END",
    "query_manifest": _with(DOCS, TRUTH, _views()) + f"SELECT entity_id AS s1_id, {_SPLIT('concat_ws(chr(31), country, name_core, canonical)')} AS split, country, (SELECT count(*) FROM truth t WHERE t.s1_id = entity_id)::INTEGER AS truth_count FROM views WHERE src = 'S1'",
    "missed_records": _DE + "SELECT entity_id, name, address FROM prepared WHERE entity_id IN (SELECT rec_id FROM truth ANTI JOIN top USING (s1_id, rec_id))",
    "placeholder_candidates": _DE + "SELECT p.entity_id AS s1_id, p.country, coalesce(rec_id, '') AS rec_id, coalesce(krank, 0)::INTEGER AS krank, coalesce(round(kshare, 6), 0) AS p1, rec_id IS NOT NULL AS is_candidate FROM prepared p LEFT JOIN top ON top.s1_id = p.entity_id AND round(kshare, 6) >= 0.05 WHERE src = 'S1'",
    "density_sample": _DE.rstrip() + f",\nchosen AS (SELECT entity_id FROM er_docs WHERE src = 'S1' ORDER BY {_U(7, 'entity_id')}, entity_id LIMIT 100) SELECT country, rec_id, s1_id, ncand_rec, krank, round(kshare, 6) AS kshare, round(kgap, 6) AS kgap FROM top WHERE s1_id IN (SELECT entity_id FROM chosen)",
    "distinct_countries": "SELECT DISTINCT lang AS country FROM documents",
    "table_counts": _with(DOCS) + "SELECT country, count(*) FILTER (src = 'S1') AS s1, count(*) FILTER (src = 'S2') AS s2, count(*) FILTER (src = 'S3') AS s3 FROM er_docs GROUP BY 1",
    "match_summary": _with(DOCS, TRUTH) + "SELECT round(count(*) FILTER (n = 0) / nullif(count(*), 0), 6) AS singleton_rate, round(avg(n), 6) AS mean_matches, max(n) AS most_matches FROM (SELECT (SELECT count(*) FROM truth t WHERE t.s1_id = e.entity_id) AS n FROM er_docs e WHERE src = 'S1')",
    "embedding_cosine": "WITH f AS (SELECT label, arg_min(embedding, vec_id) AS w FROM embeddings GROUP BY 1) SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], w::DOUBLE[]), 6) AS cosine FROM embeddings JOIN f USING (label)",
}

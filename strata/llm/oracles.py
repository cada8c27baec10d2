"""DuckDB SQL of the operators' queries where SQL can state the result.

The models, fingerprints, packings and token ids are checked against
brute-force versions in the tests instead.
"""

from __future__ import annotations

from . import licenses


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


EXACT_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding,
           lambda x: floor(1024 * CAST(x AS DOUBLE))) AS a
  FROM embeddings
  WHERE len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.a, c.a) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, vec_id, score,
         CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
           AS rank
  FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body FROM pages
), d AS (
  SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha1(body) AS hex,
         min(page_id) OVER (PARTITION BY body) AS first_id
  FROM p
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((CAST('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5) AS INTEGER)
                   >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM d
"""


# What the license scan's rules say, written down again for the oracle.
_NOT_NAMES = ("also and are disclaimer doctrine doctrines holder holders if in interest interests is "
              "law laws license licenses licence like line notice notices of on or owner owners "
              "ownership patent permission protection statement statements the this those to "
              "treaty under")
_BEGINNINGS = ("permission is hereby granted", "permission to use", "redistribution and use",
               "everyone is permitted", "this program is free", "this library is free",
               "this is free and unencumbered", "this source code form", "this work is licensed",
               "licensed under", "released under", "distributed under", "spdx-license-identifier")
_SAME = (("licence", "license"), (r"\bsub license", "sublicense"),
         (r"\bnon (commercial|infringement)", r"non\1"), ("merchantibility", "merchantability"),
         (r"copyright (owner|holder)s?\b", "copyright holder"), ("organisation", "organization"),
         ("favour", "favor"), ("acknowledgement", "acknowledgment"),
         (r"\bper cent\b", "percent"),
         (r"\b(the|this) (software|program|work|file|project|package) is ", ""),
         (r"\bv ?([0-9])", r"version \1"))


def _canonical(text: str) -> str:
    """The canonical form line by line: copyright lines get a mark, are cut, then words remain."""
    bare = r"regexp_replace(l, '^[ \t/*#;%<!-]*(portions )?', '')"
    first = rf"regexp_extract({bare}, '^copyright[ \t,:]*(\p{{L}}[\p{{L}}\p{{N}}_]*)', 1)"
    is_line = (rf"(regexp_matches({bare}, '^copyright\b[ \t,:]*(\(c\)|©|copyright|[0-9]{{4}}|by )') "
               rf"OR regexp_matches({bare}, '^(\(c\)|©)[ \t,:]*[0-9]{{4}}') "
               rf"OR (regexp_matches({bare}, '^copyright\b[ \t,:]*\p{{L}}') "
               f"AND NOT list_contains(string_split({_quoted(_NOT_NAMES)}, ' '), {first})))")
    filled = (r"regexp_replace(lower(" + text + r"), 'copyright[^\w]+(c[^\w]+)?(yyyy|year)[^\w]+name"
              r"[^\w]+of[^\w]+(copyright[^\w]+owner|author)', ' ', 'g')")
    marked = (f"array_to_string(list_transform(string_split({filled}, chr(10)), "
              f"lambda l: CASE WHEN {is_line} THEN chr(1) || l ELSE l END), chr(10))")
    begin = "|".join(x.replace(" ", r"[\s/*#;%-]+") for x in _BEGINNINGS)
    cut = (rf"regexp_replace({marked}, '\x01[^\n]{{0,200}}?(\n[ \t/*#;%-]*[^ \t\n/*#;%-][^\n]{{0,200}}?)"
           rf"{{0,4}}(\n[ \t/*#;%-]*){{0,4}}({begin})', '\3', 'g')")
    plain = (rf"regexp_replace(regexp_replace(regexp_replace({cut}, '\x01[^\n]*', ' ', 'g'), "
             r"'all[^\w]+rights[^\w]+reserved', ' ', 'g'), 'https?://(www\.)?', ' ', 'g')")
    signs = f"replace(replace({plain}, '(c)', ' copyright '), '©', ' copyright ')"
    out = rf"array_to_string(regexp_extract_all({signs}, '[\p{{L}}\p{{N}}]+'), ' ')"
    for pattern, new in _SAME:
        out = f"regexp_replace({out}, {_quoted(pattern)}, {_quoted(new)}, 'g')"
    return f"trim({out})"


def _license_scan() -> str:
    known = ", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in licenses.known_texts())
    return f"""
WITH known AS (
  SELECT sha256({_canonical('body')}) AS digest, min(license) AS license
  FROM (VALUES {known}) AS k(license, body) GROUP BY 1
), units AS (
  SELECT doc_id, 0 AS line_no, coalesce(text, '') AS unit FROM documents
  UNION ALL
  SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no,
         unnest(string_split(text, chr(10))) AS unit
  FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
), hashed AS (
  SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, sha256({_canonical('unit')}) AS digest
  FROM units
)
SELECT doc_id, line_no, hashed.digest, license
FROM hashed LEFT JOIN known ON hashed.digest = known.digest
WHERE line_no = 0 OR license IS NOT NULL
"""


_FAR = 1 << 40


def _best(*options: str) -> str:
    return f"list_sort([{', '.join(options)}])[1]"


def _moved(state: str, cost: str, letter: str, piece: str | None) -> str:
    """A state (cost, audit, repaired text) after one edit; ``piece`` is the row it leaves."""
    body = f"s.{state}.b"
    if piece is not None:
        body = f"CASE WHEN {body} = '' THEN {piece} ELSE {body} || chr(10) || {piece} END"
    return f"{{'c': s.{state}.c + {cost}, 'a': s.{state}.a || '{letter}', 'b': {body}}}"


def _conversation_repair() -> str:
    """Shortest edits row by row: places o (start), s, u, a of the pattern, one state each."""
    kept, full = "r.role || ':' || r.body", {"u": "'user:' || r.body", "a": "'assistant:' || r.body"}

    def fits(letter: str) -> str:
        return f"CASE WHEN r.initial = '{letter}' THEN r.price ELSE {_FAR} END"

    def taken(state: str, letter: str) -> list[str]:
        return [_moved(state, fits(letter), "K", kept),
                _moved(state, "r.price + 1", "R", full[letter])]

    gone = {p: _moved(p, "2", "D", None) for p in "osua"}
    row = {"o": gone["o"], "s": _best(gone["s"], _moved("o", fits("s"), "K", kept)),
           "u": _best(gone["u"], *taken("o", "u"), *taken("s", "u"), *taken("a", "u")),
           "a": _best(gone["a"], *taken("u", "a"))}
    two = "'user:' || chr(10) || 'assistant:'"
    put = {"o": "s.o", "s": "s.s",
           "u": _best("s.u", *[_moved(p, "5", "I", "'user:'") for p in "osa"]),
           "a": _best("s.a", _moved("u", "5", "I", "'assistant:'"),
                      *[_moved(p, "10", "II", two) for p in "os"])}

    def struct(parts: dict[str, str]) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in parts.items()) + "}"

    far = f"{{'c': {_FAR}::BIGINT, 'a': '', 'b': ''}}"
    begin = struct({"o": "{'c': 0::BIGINT, 'a': '', 'b': ''}", "s": far, "u": far, "a": far})
    visible = r"[^\x20\x09-\x0D]"
    return rf"""
WITH tab AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS v
    FROM range(256) AS r(i))
), raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')
         AS name
  FROM conversations
), hashed AS (
  SELECT raw.*, xor(list_reduce(string_split(name, ''), lambda c, x:
    xor(c >> 8, t[CAST(xor(c, ord(x)::BIGINT) & 255 AS INTEGER) + 1]), 4294967295::BIGINT),
    4294967295) % 20 AS fate
  FROM raw, tab
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN translate(text, '.!?', '') ELSE text END
         AS body,
         unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE fate <> 0
), ordered AS (
  SELECT *, left(role, 1) AS initial, NOT regexp_matches(body, '{visible}') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, body
                            ORDER BY turn NULLS FIRST, copy) > 1 AS is_repeat,
         regexp_extract(body, '({visible})[\x20\x09-\x0D]*\z', 1) NOT IN ('.', '!', '?')
         AS is_cut,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role, sha256(body), copy) AS place
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN is_blank THEN 'b' WHEN is_repeat THEN 'd' WHEN is_cut THEN 't' ELSE ''
         END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY place) || initial AS pair
  FROM ordered
), parsed AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps,
         count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
         flatten(list([
           {{'is_row': true, 'role': role, 'body': body, 'initial': initial,
             'price': CASE fault WHEN '' THEN 0 WHEN 't' THEN 5 ELSE {_FAR} END}},
           {{'is_row': false, 'role': '', 'body': '', 'initial': '', 'price': 0}}]
           ORDER BY place)) AS steps
  FROM judged GROUP BY conv_id
), folded AS (
  SELECT * EXCLUDE (steps), list_reduce(steps, lambda s, r:
    CASE WHEN r.is_row THEN {struct(row)} ELSE {struct(put)} END,
    list_reduce([0], lambda s, r: {struct(put)}, {begin})) AS s
  FROM parsed
), best AS (
  SELECT *, {_best("s.o", "s.a")} AS e FROM folded
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit,
       sha256(coalesce(e.b, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c
LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLES: dict[str, str] = {
    "op3_exact_topk": EXACT_TOPK,
    "op4_license_scan": _license_scan(),
    "op10_warc": WARC,
    "op11_conversation_repair": _conversation_repair(),
}

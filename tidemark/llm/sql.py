"""DuckDB SQL for the same rows as the numbered queries, written on its own.

There is none where SQL cannot say it: token merges (op1), class clustering (op4),
a fitted classifier (op7) and the neighbours in a suffix order (op10).
"""

from __future__ import annotations

from tidemark.llm.pii import IBAN_LENGTHS

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
BLANK_WORD = r"[^\x20\x09-\x0D]+"
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


def _spans(kind: str, pattern: str, group: int = 0, source: str = "src") -> str:
    """Rows (rid, kind, s, e, found) of the matches of a pattern in the texts of ``source``."""
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT rid, '{kind}' AS kind, t,
         coalesce(list_sum(list_transform(between[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(whole[1:i - 1], lambda x: length(x))), 0) AS s,
         coalesce(list_sum(list_transform(between[1:i], lambda x: length(x))), 0)
           + coalesce(list_sum(list_transform(whole[1:i], lambda x: length(x))), 0) AS e,
         found[i] AS found
  FROM (SELECT rid, t, string_split_regex(t, '{quoted}') AS between, regexp_extract_all(t, '{quoted}') AS whole,
               regexp_extract_all(t, '{quoted}', {group}) AS found
        FROM {source}) AS m, unnest(range(1, len(whole) + 1)) AS u(i)"""


def _listed(kinds: list[str], base: list[str], key: str = "rid") -> str:
    rank = " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(kinds))
    names = ", ".join(f"'{k}'" for k in base)
    order = f"ORDER BY s, CASE kind {rank} END, e"
    one = "kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT)"
    return f"""SELECT {key},
    string_agg({one}, ',' {order}) FILTER (WHERE kind IN ({names})) AS base,
    string_agg({one}, ',' {order}) AS spans,
    {", ".join(f"count(*) FILTER (WHERE kind = '{k}') AS n_{k}" for k in base)}
  FROM found GROUP BY {key}"""


def _result(base: list[str]) -> str:
    counts = ", ".join(f"CAST(coalesce(n_{k}, 0) AS BIGINT) AS n_{k}" for k in base)
    return f"""SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM src LEFT JOIN listed USING (rid)"""


SOURCE = "src AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents)"

CONTAMINATION = f"""WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '{PLAIN_WORD}') AS words FROM documents
), b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({LOWER}, '{PLAIN_WORD}') AS words FROM benchmark
), bn AS (SELECT item, words, least(10, len(words)) AS n FROM b WHERE len(words) > 0
), bw AS (
  SELECT DISTINCT item, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM bn, unnest(range(1, len(words) - n + 2)) AS u(i)
), ns AS (SELECT DISTINCT n FROM bw
), dw AS (
  SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS win
  FROM d CROSS JOIN ns, unnest(range(1, len(words) - n + 2)) AS u(i)
), hit AS (SELECT rid, i, n, item FROM dw JOIN bw USING (n, win)
), hits AS (
  SELECT rid, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT rid, i, n FROM hit) AS h, unnest(range(i, i + n)) AS u(p) GROUP BY rid
), items AS (
  SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY rid
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN items USING (rid)"""

_NAMES = "|".join([*map(_either, ("password", "passwd", "secret", "token")), _either("api") + "_?" + _either("key")])
_ASSIGN = rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = f"""WITH {SOURCE}, known AS (
  SELECT * FROM ({_spans("assign", _ASSIGN, 2)}) WHERE length(found) >= 6
  UNION ALL SELECT * FROM ({_spans("access", "AKIA[A-Z0-9]+")}) WHERE length(found) >= 20
  UNION ALL SELECT * FROM ({_spans("hex", "[0-9a-f]{24,}")})
), candidate AS (
  SELECT row_number() OVER () AS cid, rid, s, e, found,
    CASE WHEN regexp_matches(found, '^([0-9]*[a-f][0-9a-f]*|[0-9]*[A-F][0-9A-F]*)$') THEN 'entropy_hex'
         WHEN regexp_matches(found, '^([a-z]*[0-9][a-z0-9]*|[A-Z]*[0-9][A-Z0-9]*)$') THEN 'entropy_alnum'
         WHEN regexp_matches(found, '[0-9+/]') THEN 'entropy_base64' END AS kind
  FROM ({_spans("candidate", "[A-Za-z0-9+/_-]{20,}")})
  WHERE NOT regexp_matches(found, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$|^[0-9-]+$')
), piece AS (
  SELECT cid, p, pieces[p] AS piece
  FROM (SELECT cid, kind, string_split_regex(found, '{_either("example")}|{_either("placeholder")}|[Xx]{{6}}|0123456789|{_either("abcdefgh")}') AS pieces FROM candidate),
    unnest(range(1, len(pieces) + 1)) AS u(p)
  WHERE kind IS NOT NULL AND length(pieces[p]) >= 20
), letters AS (
  SELECT cid, p, w, substr(piece, CAST(w + j AS BIGINT), 1) AS ch, count(*) AS n
  FROM piece, unnest(range(1, length(piece) - 18)) AS u(w), unnest(range(0, 20)) AS v(j)
  GROUP BY cid, p, w, ch
), entropy AS (
  SELECT cid, max(bits) AS bits FROM (SELECT cid, p, w, log2(20) - sum(n * log2(n)) / 20 AS bits FROM letters GROUP BY cid, p, w) GROUP BY cid
), found AS (
  SELECT rid, kind, s, e FROM known
  UNION ALL
  SELECT rid, kind, s, e FROM candidate JOIN entropy USING (cid)
  WHERE bits >= CASE kind WHEN 'entropy_hex' THEN 3.0 WHEN 'entropy_alnum' THEN 3.5 ELSE 3.8 END - 1e-6
), listed AS (
  {_listed(["assign", "access", "hex", "entropy_hex", "entropy_alnum", "entropy_base64"], ["assign", "access", "hex"])}
)
{_result(["assign", "access", "hex"])}"""

_DIGITS = "regexp_replace(found, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i:
    CASE WHEN i % 2 = 0 THEN (2 * CAST(substr(reverse({_DIGITS}), i, 1) AS INT)) // 10 + (2 * CAST(substr(reverse({_DIGITS}), i, 1) AS INT)) % 10
         ELSE CAST(substr(reverse({_DIGITS}), i, 1) AS INT) END)) % 10 = 0"""
_COMPACT = "replace(found, ' ', '')"
_MOVED = f"(substr({_COMPACT}, 5) || substr({_COMPACT}, 1, 4))"
_MOD_97 = f"""list_reduce(list_transform(range(1, length({_MOVED}) + 1), lambda i:
    CAST(instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', substr({_MOVED}, i, 1)) - 1 AS BIGINT)),
    lambda a, v: (a * (CASE WHEN v > 9 THEN 100 ELSE 10 END) + v) % 97, CAST(0 AS BIGINT)) = 1"""


def _scored(rows: str, start: int, words_for: str, words_against: str) -> str:
    """Of rows (rid, kind, t, s, e) those with a score of 60 with their context on both sides."""

    def has(words: str) -> str:
        pattern = f"'(^|[^A-Za-z])({'|'.join(map(_either, words.split('|')))})($|[^A-Za-z])'"
        return f"(regexp_matches(ctx, {pattern}) OR regexp_matches(behind, {pattern}))"

    return f"""SELECT rid, kind, s, e FROM (
    SELECT *, CASE WHEN regexp_matches(after, '^[^0-9,;.!?\\n\\r]*[0-9]') THEN '' ELSE regexp_extract(after, '^[^0-9,;.!?\\n\\r]*') END AS behind
    FROM (SELECT *, substr(t, CAST(greatest(s - 40, 0) + 1 AS BIGINT), CAST(least(s, 40) AS BIGINT)) AS ctx,
            substr(t, CAST(e + 1 AS BIGINT), 40) AS after
          FROM ({rows})))
  WHERE {start} + CASE WHEN {has(words_for)} THEN 40 ELSE 0 END - CASE WHEN {has(words_against)} THEN 40 ELSE 0 END >= 60"""


def _own(kind: str, pattern: str, near: str, start: int, words_for: str, words_against: str) -> str:
    """A kind of the method: no character of ``near`` beside it, and a high score."""
    return _scored(f"SELECT * FROM ({_spans(kind, pattern)}) WHERE {near}", start, words_for, words_against)


_BEFORE = "(CASE WHEN s = 0 THEN '' ELSE substr(t, CAST(s AS BIGINT), 1) END)"
_AFTER = "substr(t, CAST(e + 1 AS BIGINT), 1)"
_AFTER_2 = "substr(t, CAST(e + 1 AS BIGINT), 2)"
_PART = r"0*(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

_IBAN_END = r"SELECT *, regexp_extract(rest, '^[A-Z]{{2}}[0-9]{{2}}(\x20?[A-Z0-9]){{{n}}}') AS found FROM iban_start"
_REGISTERED = f"CASE substr(found, 1, 2) {' '.join(f"WHEN '{c}' THEN {n}" for c, n in IBAN_LENGTHS.items())} END"

PERSONAL = f"""WITH {SOURCE}, base AS (
  SELECT rid, kind, s, e FROM ({_spans("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")})
  UNION ALL SELECT rid, kind, s, e FROM ({_spans("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")})
    WHERE regexp_matches(found, '^{_PART}\\.{_PART}\\.{_PART}\\.{_PART}$')
  UNION ALL SELECT rid, kind, s, e FROM ({_spans("card", r"[0-9]([\x20-]?[0-9])+")})
    WHERE CASE WHEN length({_DIGITS}) BETWEEN 14 AND 19 THEN {_LUHN} ELSE false END
  UNION ALL SELECT rid, kind, s, e FROM ({_spans("phone", r"\+[0-9][\x20().0-9-]+[0-9]")})
    WHERE length({_DIGITS}) BETWEEN 10 AND 15
), iban_start AS (
  SELECT rid, t, s, substr(t, CAST(s + 1 AS BIGINT), 65) AS rest FROM ({_spans("iban", "[A-Z]{2}[0-9]{2}")})
  WHERE NOT regexp_matches({_BEFORE}, '[A-Za-z0-9]')
), iban_end AS (
  SELECT * FROM ({" UNION ALL ".join(_IBAN_END.format(n=n) for n in range(11, 31))})
  WHERE found <> '' AND NOT regexp_matches(substr(rest, length(found) + 1, 1), '[A-Za-z0-9]')
), iban AS (
  SELECT rid, t, s, s + length(found) AS e FROM iban_end WHERE {_MOD_97}
  QUALIFY row_number() OVER (PARTITION BY rid, s ORDER BY length({_COMPACT}) = {_REGISTERED} DESC NULLS LAST, length(found) DESC) = 1
), account AS (
  SELECT rid, any_value(t) AS t, list_reduce(list([{{'s': s, 'e': e}}] ORDER BY s),
    lambda a, x: CASE WHEN a[-1].e <= x[1].s THEN list_concat(a, x) ELSE a END) AS accounts
  FROM iban GROUP BY rid
), own AS (
  {_scored("SELECT rid, 'iban' AS kind, t, a.s AS s, a.e AS e FROM account, unnest(accounts) AS u(a)", 70, "iban|account|bank|konto|compte|cuenta|transfer", "example|sample")}
  UNION ALL {_own("ssn", "[0-9]{3}-[0-9]{2}-[0-9]{4}", f"NOT regexp_matches({_BEFORE} || '|' || {_AFTER}, '[0-9-]')", 40, "ssn|social|security", "order|invoice|part|serial|version")}
  UNION ALL {_own("local_phone", r"\(?[0-9]{3}\)?[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}", f"NOT regexp_matches({_BEFORE}, '[0-9+.-]') AND NOT regexp_matches({_AFTER_2}, '^[0-9.-]?[0-9]')", 20, "phone|tel|call|mobile|cell|fax|telefon", "order|invoice|part|serial|item|id")}
), found AS (
  SELECT * FROM base
  UNION ALL
  SELECT * FROM own WHERE NOT EXISTS (SELECT 1 FROM base WHERE base.rid = own.rid AND base.s <= own.s AND own.e <= base.e)
), listed AS (
  {_listed(["email", "ip", "card", "phone", "iban", "ssn", "local_phone"], ["email", "ip", "card", "phone"])}
)
{_result(["email", "ip", "card", "phone"])}"""

_CONTROL = r"<\\*s>|<\\*/s>|\[\\*INST\]|\[\\*/INST\]|<\\*<SYS>>|<\\*</SYS>>"


def _escaped_length(text: str) -> str:
    return f"length({text}) + len(regexp_extract_all({text}, '{_CONTROL}'))"


CHAT = f"""WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len("<s>[INST] ") + len(" [/INST]") + len("</s>")} + {_escaped_length("role")} + {_escaped_length("text")}) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""

RULES = f"""WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '{BLANK_WORD}') AS words FROM documents
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{BLANK_WORD}') GROUP BY rid
), windows AS (
  SELECT rid, i, words[i:i + 4] AS win FROM d, unnest(range(1, len(words) - 3)) AS u(i)
), often AS (SELECT rid, win FROM windows GROUP BY rid, win HAVING count(*) > 1
), repeats AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, i FROM windows JOIN often USING (rid, win)) AS w, unnest(range(i, i + 5)) AS u(p) GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda w: length(w))), 0) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines,
    len(list_filter(words, lambda w: regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]') AND strlen(w) > 2)) AS n_caps,
    len(list_filter(words, lambda w: regexp_matches(w, '^([A-Za-z0-9]|[^\\x00-\\x7F])'))) AS n_plain
  FROM d LEFT JOIN lines USING (rid) LEFT JOIN repeats USING (rid)
), judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed
    OR (10 * n_symbols > n_words AND n_symbols >= 3)
    OR (100 * n_dup_lines > 30 * n_lines AND n_dup_lines >= 2)
    OR (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))
    OR 100 * n_caps > 50 * n_words
    OR 100 * n_plain < 60 * n_words) AS kept
FROM judged"""

NEAR_DUPLICATES = f"""WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '{BLANK_WORD}') AS words FROM documents
), n AS (SELECT rid, doc_id, words, least(5, len(words)) AS k FROM d
), s AS (
  SELECT DISTINCT rid, array_to_string(words[i:i + k - 1], ' ') AS shingle
  FROM n, unnest(range(1, len(words) - k + 2)) AS u(i) WHERE k > 0
), size AS (SELECT rid, count(*) AS n_shingles FROM s GROUP BY rid
), pairs AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS inter FROM s AS a JOIN s AS b USING (shingle) WHERE a.rid <> b.rid GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN size AS p ON p.rid = x JOIN size AS q ON q.rid = y
  WHERE 100 * inter >= 75 * (p.n_shingles + q.n_shingles - inter)
), reach(x, y) AS (
  SELECT rid, rid FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), component AS (SELECT x AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = reach.y GROUP BY x
)
SELECT doc_id, CAST(coalesce(n_shingles, 0) AS BIGINT) AS n_shingles, component_id,
       doc_id IS NOT DISTINCT FROM component_id AS kept
FROM d JOIN component USING (rid) LEFT JOIN size USING (rid)"""

INFILL = r"""WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), u AS (
  SELECT *, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST(('0x' || h[1:8]) AS BIGINT) AS h1, CAST(('0x' || h[9:16]) AS BIGINT) AS h2,
         CAST(('0x' || h[17:24]) AS BIGINT) AS h3, CAST(('0x' || h[25:32]) AS BIGINT) AS h4
  FROM d
), c AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a,
         greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), p AS (
  SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
         array_to_string(units[b + 1:], '') AS suf
  FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""

# CRC-32 of a distinct feature: 256 states of one byte, then one step per byte.
IMPORTANCE = f"""WITH bits AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT CAST(i AS BIGINT) AS i FROM range(256) AS r(i))
), d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({LOWER}, '{PLAIN_WORD}') AS w FROM documents
), b AS (SELECT regexp_extract_all({LOWER}, '{PLAIN_WORD}') AS w FROM benchmark
), df AS (
  SELECT rid, array_to_string(w[i:i + k - 1], ' ') AS f FROM d, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS u(i)
), bf AS (
  SELECT array_to_string(w[i:i + k - 1], ' ') AS f FROM b, unnest([1, 2, 3]) AS s(k), unnest(range(1, len(w) - k + 2)) AS u(i)
), hashed AS (
  SELECT f, xor(list_reduce(
      list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(f) + 1), lambda j: CAST(('0x' || hex(encode(f))[2 * j - 1:2 * j]) AS BIGINT))),
      lambda s, x: xor(s >> 8, tab[(xor(s, x) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)), bits
), s AS (SELECT bucket, count(*) AS s FROM df JOIN hashed USING (f) GROUP BY bucket
), t AS (SELECT bucket, count(*) AS t FROM bf JOIN hashed USING (f) GROUP BY bucket
), sums AS (SELECT (SELECT count(*) FROM df) + 10000 AS ss, (SELECT count(*) FROM bf) + 10000 AS tt
), gain AS (
  SELECT r.bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ss AS DOUBLE) / CAST((coalesce(s, 0) + 1) * tt AS DOUBLE))) AS BIGINT) AS gain
  FROM range(10000) AS r(bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), sums
), weights AS (
  SELECT rid, CAST(sum(gain) AS BIGINT) AS weight FROM df JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY rid
), scored AS (
  SELECT doc_id, len(w) AS n, CAST(len(w) + greatest(len(w) - 1, 0) + greatest(len(w) - 2, 0) AS BIGINT) AS n_features,
         coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), ''))[1:8]) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (rid)
), ranked AS (
  SELECT *, CASE WHEN n >= 20 THEN row_number() OVER (PARTITION BY n >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features) END AS place,
         count(*) FILTER (WHERE n >= 20) OVER () AS eligible
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 5 * eligible // 100 THEN place END AS rank FROM ranked"""

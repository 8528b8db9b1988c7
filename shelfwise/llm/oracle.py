"""Expected results of the queries that SQL can express, for DuckDB."""

from __future__ import annotations

from string import Template


def _sql(text: str, **parts: str) -> str:
    return Template(text).substitute(parts).strip()


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string: the register goes through eight steps for every character."""
    characters = f"list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)"
    step = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, _: {step})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {characters}), lambda c, b: {byte}), 4294967295)"


def _edit(state: int, cost: str, letter: str, more: str) -> str:
    """What a state becomes by an edit; ``more`` is the row that stays, if any."""
    sep = "" if state == 0 else " || chr(10)"
    line = f"{sep} || {more}" if more else ""
    out = f"i{state}" if letter != "I" else f"s{state}"
    return f"{{'c': {out}.c + {cost}, 'a': {out}.a || '{letter}', 'o': {out}.o{line}}}"


def _stay(state: int, role: str) -> str:
    """Keep or rerole of the next row, where ``role`` must follow the state."""
    sep = "''" if state == 0 else "chr(10)"
    return (
        f"{{'c': i{state}.c + flaw + CASE WHEN left(role, 1) = '{role[0]}' THEN 0 ELSE 3 END,"
        f" 'a': i{state}.a || CASE WHEN left(role, 1) = '{role[0]}' THEN 'K' ELSE 'R' END,"
        f" 'o': i{state}.o || {sep} || CASE WHEN left(role, 1) = '{role[0]}' THEN role ELSE '{role}' END || ':' || text}}"
    )


_NEVER = "{'c': 1000000, 'a': '', 'o': ''}"
_KEPT_FIRST = (
    "{'c': i0.c + flaw + CASE WHEN left(role, 1) = 's' THEN 0 ELSE 1000000 END,"
    " 'a': i0.a || 'K', 'o': role || ':' || text}"
)

OP11 = _sql(
    r"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS t,
         $crc % 20 AS k
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE k WHEN 4 THEN 'user' ELSE r END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(t, '[.!?]', '', 'g') ELSE t END AS text,
         unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM base
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM damaged
), faults AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_seen,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$$') AS is_cut,
         left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
  FROM placed
), marked AS (
  SELECT *, is_blank OR is_seen AS gone, CASE WHEN is_cut THEN 3 ELSE 0 END AS flaw FROM faults
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_seen AND NOT is_blank) AS duplicate,
         count(*) FILTER (is_cut AND NOT gone) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), cells AS (
  SELECT conv_id, 0 AS i, {'c': 0, 'a': '', 'o': ''} AS s0, $never AS s1, $never AS s2, $never AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i,
         $d0 AS s0,
         CASE WHEN gone THEN $d1 ELSE list_min([$d1, $first]) END AS s1,
         CASE WHEN gone THEN $d2 ELSE list_min([$d2, $u0, $u1, $u3]) END AS s2,
         CASE WHEN gone THEN $d3 ELSE list_min([$d3, $a2]) END AS s3
  FROM (
    SELECT *, s0 AS i0, s1 AS i1,
           list_min([s2, $n0, $n1, $n3]) AS i2,
           list_min([s3, {'c': list_min([s2, $n0, $n1, $n3]).c + 3, 'a': list_min([s2, $n0, $n1, $n3]).a || 'I',
                          'o': list_min([s2, $n0, $n1, $n3]).o || chr(10) || 'assistant:'}]) AS i3
    FROM (
      SELECT c.conv_id, m.i, s0, s1, s2, s3, m.role, m.text, m.gone, m.flaw
      FROM cells c JOIN marked m ON c.conv_id IS NOT DISTINCT FROM m.conv_id AND m.i = c.i + 1
    )
  )
), ended AS (
  SELECT conv_id, list_min([s0, s3, {'c': u.c + 3, 'a': u.a || 'I', 'o': u.o || chr(10) || 'assistant:'}]) AS best
  FROM (
    SELECT *, list_min([s2, $n0, $n1, $n3]) AS u,
           row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS latest
    FROM cells
  ) WHERE latest = 1
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, best.c::BIGINT AS cost, best.a AS audit,
       sha256(best.o) AS repaired_sha256
FROM ended e LEFT JOIN counts n ON e.conv_id IS NOT DISTINCT FROM n.conv_id
""",
    crc=crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"),
    never=_NEVER, first=_KEPT_FIRST,
    **{f"d{s}": _edit(s, "4", "D", "") for s in range(4)},
    **{f"n{s}": _edit(s, "3", "I", "'user:'") for s in (0, 1, 3)},
    **{f"u{s}": _stay(s, "user") for s in (0, 1, 3)}, a2=_stay(2, "assistant"),
)

_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

OP12 = _sql(
    r"""
WITH items AS (
  SELECT item_id, w, least(len(w), 10) AS k
  FROM (SELECT item_id, $words AS w FROM benchmark) WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[s + 1 : s + k], ' ') AS body
  FROM (SELECT *, unnest(range(len(w) - k + 1)) AS s FROM items)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, $words AS w FROM documents
), places AS (
  SELECT r, k, s, array_to_string(w[s + 1 : s + k], ' ') AS body
  FROM (
    SELECT r, w, k, unnest(range(len(w) - k + 1)) AS s
    FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
  )
), hits AS (
  SELECT DISTINCT r, s, k, body FROM places SEMI JOIN windows USING (k, body)
), covered AS (
  SELECT r, count(DISTINCT s + o) AS n_hit FROM (SELECT *, unnest(range(k)) AS o FROM hits) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits JOIN windows USING (k, body) WHERE item_id IS NOT NULL)
  GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN named USING (r)
""",
    words=_WORDS,
)


def _field(value: str) -> str:
    text = f"({value})::VARCHAR"
    return f"CASE WHEN ({value}) IS NULL THEN '-' ELSE strlen({text}) || ':' || {text} END"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


OP13 = _sql(
    r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, $leaf AS leaf,
         CASE WHEN $crc % 7 = 0 THEN $other END AS other
  FROM documents
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS n
  FROM docs
), nodes AS (
  SELECT lang, 0 AS level, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lang, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY lang, level, pos // 2, n
), subroots AS (
  SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM tops WHERE n > 1 GROUP BY level, pos // 2, n
), steps AS (
  SELECT r, a.level, CASE WHEN b.digest IS NULL THEN 2 ELSE (a.pos & 1) END AS side, coalesce(b.digest, '') AS digest
  FROM leaves l JOIN nodes a ON a.lang IS NOT DISTINCT FROM l.lang AND a.pos = l.pos >> a.level AND a.n > 1
  LEFT JOIN nodes b ON b.lang IS NOT DISTINCT FROM a.lang AND b.level = a.level AND b.pos = xor(a.pos, 1)
  UNION ALL
  SELECT r, 1000 + a.level, CASE WHEN b.digest IS NULL THEN 2 ELSE (a.pos & 1) END, coalesce(b.digest, '')
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang
  JOIN tops a ON a.pos = s.pos >> a.level AND a.n > 1
  LEFT JOIN tops b ON b.level = a.level AND b.pos = xor(a.pos, 1)
), proofs AS (
  SELECT r, string_agg(digest, '' ORDER BY level) AS proof,
         list({'s': side, 'd': digest} ORDER BY level) AS path
  FROM steps GROUP BY r
), folded AS (
  SELECT l.doc_id, l.leaf, s.subroot, (SELECT digest FROM tops WHERE n = 1) AS root,
         sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(
           list_prepend({'s': 0::BIGINT, 'd': coalesce(other, leaf)}, coalesce(path, [])),
           lambda x, y: {'s': 0::BIGINT, 'd': CASE y.s WHEN 2 THEN sha256(x.d) WHEN 1 THEN sha256(y.d || x.d)
                         ELSE sha256(x.d || y.d) END}
         ).d AS folded_root
  FROM leaves l JOIN subroots s ON s.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs p ON p.r = l.r
)
SELECT *, folded_root = root AS verified FROM folded
""",
    leaf=_leaf("n_chars"), other=_leaf("n_chars::HUGEINT + 1"), crc=crc32("doc_id::VARCHAR"),
)


def oracle_sql() -> dict[str, str]:
    return {
        "op11_conversation_repair": OP11, "op12_decontamination": OP12, "op13_merkle_manifest": OP13,
    }

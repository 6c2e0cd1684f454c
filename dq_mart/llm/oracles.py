"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from .licenses import KEY, RULES, SPDX_LINE, SPDX_NAME, known_sentences, spdx_names

#: Words, distinct shingles and exact similarity of all pairs that share a
#: shingle; components by a recursive walk over the links.
OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN ws IS NULL OR len(ws) = 0 THEN []
      WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
      ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
      END) AS sh
  FROM w),
e AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS t FROM s),
pair AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k, any_value(a.n) AS nu, any_value(b.n) AS nv
  FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
link AS (SELECT u, v FROM pair WHERE 100 * k >= 85 * (nu + nv - k)),
both_ways AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(id, to_id) AS (
  SELECT doc_id, doc_id FROM s
  UNION
  SELECT r.id, b.v FROM reach r JOIN both_ways b ON r.to_id = b.u),
comp AS (SELECT id, min(to_id) AS component_id FROM reach GROUP BY id)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, component_id,
       s.doc_id = component_id AS kept
FROM s JOIN comp ON comp.id = s.doc_id
"""

#: Signs compared place by place over all pairs of a query and a row.
OP10 = """
WITH v AS (SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: x > 0) AS s
           FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
d AS (SELECT q.id AS query_id, c.id AS neighbour_id,
             CAST(len(list_filter(list_zip(q.s, c.s), lambda p: p[1] <> p[2])) AS BIGINT) AS distance
      FROM v q JOIN v c ON q.id <> c.id WHERE q.id % 100 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM d)
SELECT query_id, neighbour_id, distance, rank FROM r WHERE rank <= 10
"""


def _op5() -> str:
    """Lines of paragraphs; every stretch of lines that reads as a known
    sentence, the longest at a line, from left to right without overlap; rules
    in order."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    sentences = known_sentences()
    known = ",\n".join(f"({q(t)}, {q(i)})" for t, i in sentences.items())
    named = ",\n".join(f"({q(t)}, {q(i)})" for t, i in spdx_names().items())
    longest = max(len(t.split()) for t in sentences)
    steps, hits = [], []
    for n, (licence, sequence) in enumerate(RULES, 1):
        text = q("".join(f",{x}," for x in sequence))
        steps.append(f"r{n} AS (SELECT *, replace(seq{n - 1}, {text}, '') AS seq{n} "
                     f"FROM {'seq' if n == 1 else f'r{n - 1}'})")
        hits.append(f"CASE WHEN seq{n} <> seq{n - 1} THEN {q(licence)} END")
    last = len(RULES)
    low = "replace(replace(lower(coalesce(text, '')), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    for pattern, by in ((r"(?m)^[^a-z0-9\n]+", ""), (r"\b(v)\.(\s+[0-9])", r"\1 \2"), (r"[.!?]\s+", "\n\n"),
                        (r"[;:][^\S\n]+(\S)", "\n\\1"), (r"[^a-z0-9.\n]+", " "), (r"\.(\s|$)", r" \1"),
                        (r"(^|\s)\.", r"\1 "), (r" +", " "), (r" ?\n ?", "\n")):
        low = f"regexp_replace({low}, {q(pattern)}, {q(by)}, 'g')"
    return rf"""
WITH known(t, id) AS (VALUES {known}),
names(t, id) AS (VALUES {named}),
cutting AS (SELECT row_number() OVER () AS row, doc_id, text, string_split(trim({low}), chr(10)) AS lines FROM documents),
line AS (SELECT row, unnest(lines) AS s, unnest(range(len(lines))) AS pos, lines FROM cutting
         WHERE regexp_matches(coalesce(text, ''), {q(KEY)})),
start AS (SELECT row, pos, lines FROM line WHERE s IN (SELECT DISTINCT t FROM known)
          OR EXISTS (SELECT 1 FROM known WHERE s <> '' AND starts_with(t, s || ' '))),
span AS (SELECT row, pos, pos + k AS upto, lines[pos + 1:pos + 1 + k] AS part
         FROM start, (SELECT unnest(range({longest})) AS k) WHERE pos + k < len(lines)),
met AS (SELECT row, pos, max(upto) AS upto, arg_max(id, upto) AS id
        FROM (SELECT * FROM span WHERE NOT list_contains(part, '')) p JOIN known ON t = array_to_string(part, ' ')
        GROUP BY row, pos),
taken AS (
  SELECT row, list_reduce(list_prepend({{'pos': -1, 'upto': -1, 'ids': CAST([] AS VARCHAR[])}},
      list({{'pos': pos, 'upto': upto, 'ids': [id]}} ORDER BY pos)), lambda x, y:
      CASE WHEN y.pos > x.upto THEN {{'pos': y.pos, 'upto': y.upto, 'ids': list_concat(x.ids, y.ids)}} ELSE x END).ids AS l
  FROM met GROUP BY row),
spoken AS (
  SELECT row, unnest(n) AS n, unnest(range(len(n))) AS pos FROM (
    SELECT row, flatten(list_transform(regexp_extract_all(text, {q(SPDX_LINE)}, 1),
        lambda e: regexp_extract_all(e, {q(SPDX_NAME)}))) AS n FROM cutting WHERE text IS NOT NULL)),
spdx AS (SELECT row, list(id ORDER BY pos) AS spdx FROM spoken JOIN names ON t = lower(n) GROUP BY row),
seq AS (
  SELECT doc_id, coalesce(l, []) AS l, coalesce(spdx, []) AS spdx,
         list_aggregate(list_prepend('', list_transform(coalesce(l, []), lambda x: ',' || x || ',')),
                        'string_agg', '') AS seq0
  FROM cutting LEFT JOIN taken USING (row) LEFT JOIN spdx USING (row)),
{", ".join(steps)},
named AS (
  SELECT doc_id, l, list_concat(list_concat(list_filter([{", ".join(hits)}], lambda x: x IS NOT NULL),
    list_transform(list_filter(string_split(seq{last}, ','), lambda x: starts_with(x, 'ref:')),
                   lambda x: x[5:])), spdx) AS a
  FROM r{last}),
once AS (SELECT doc_id, l, list_filter(a, lambda x, i: list_position(a, x) = i) AS u FROM named)
SELECT doc_id, coalesce(array_to_string(l, ','), '') AS sentences,
       coalesce(array_to_string(u, ','), '') AS licenses, CAST(len(u) AS BIGINT) AS n_licenses
FROM once
"""


#: CRC-32 of a text's bytes (of ASCII texts: decimal ids), bit by bit and byte
#: by byte.
_CRC = """
crc_table AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)),
crc AS (
  SELECT DISTINCT doc_id, xor(list_reduce(list_prepend(4294967295,
      list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM documents, crc_table)"""


def _fold_levels(name: str, height: int) -> str:
    """Levels 0..height over ``<name>0(g, r, d)``: each node with the digests
    left and right of it in its run (both empty where the group has one node),
    and the digest of the run."""
    out = []
    for k in range(height + 1):
        run = "OVER (PARTITION BY g, r // 16 ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        out.append(f"""
{name}{k}_run AS (SELECT g, r, d, count(*) OVER (PARTITION BY g) AS n, list(d) {run} AS ds FROM {name}{k}),
{name}{k}_seg AS (
  SELECT g, r, n > 1 AS several,
         coalesce(array_to_string(ds[1:r % 16], ''), '') AS lt, coalesce(array_to_string(ds[r % 16 + 2:], ''), '') AS rt
  FROM {name}{k}_run),
{name}{k + 1} AS (
  SELECT g, r // 16 AS r, CASE WHEN any_value(n) > 1 THEN sha256(array_to_string(any_value(ds), '')) ELSE any_value(d) END AS d
  FROM {name}{k}_run GROUP BY g, r // 16)""")
    return ",".join(out)


def _op13(height: int = 6) -> str:
    """Fixed numbers of levels: 16 to their power rows a source and sources."""
    def leaf(text: str) -> str:
        parts = [f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                 for c in ("doc_id", "source", "lang", "n_chars", text)]
        return f"sha256({' || '.join(parts)})"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps, last = [], "path0"
    for tree, group, rank in (("s", "g", "r"), ("t", "0", "s_rank")):
        for k in range(height):
            new = f"{tree}path{k}"
            steps.append(f"""
{new} AS (
  SELECT p.* REPLACE (p.sibs || q.lt || q.rt AS sibs,
      CASE WHEN q.several THEN sha256(q.lt || p.cur || q.rt) ELSE p.cur END AS cur)
  FROM {last} p JOIN {tree}{k}_seg q ON q.g = p.{group if tree == 's' else 'zero'} AND q.r = p.{rank} // {16 ** k})""")
            last = new
    return f"""
WITH {_CRC},
leaves AS (
  SELECT doc_id, coalesce('s' || source, '') AS g, {leaf('text')} AS leaf,
         CASE WHEN h % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS found
  FROM documents LEFT JOIN crc USING (doc_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
s0 AS (SELECT g, r, leaf AS d FROM placed),{_fold_levels('s', height)},
sub AS (SELECT g AS name, d, row_number() OVER (ORDER BY encode(g)) - 1 AS r FROM s{height + 1}),
t0 AS (SELECT 0 AS g, r, d FROM sub),{_fold_levels('t', height)},
path0 AS (
  SELECT p.doc_id, p.leaf, sub.d AS subroot, p.g, p.r, sub.r AS s_rank, 0 AS zero, '' AS sibs, p.found AS cur
  FROM placed p JOIN sub ON sub.name = p.g),{','.join(steps)}
SELECT doc_id, leaf, subroot, t.d AS root, sha256(sibs) AS proof_sha256, cur AS folded_root, cur = t.d AS verified
FROM {last}, t{height + 1} t
"""


#: All pairs of equal stretches of six words in one text; those at one distance
#: and at neighbouring places are one repeat, so no suffix is sorted.
OP12 = rf"""
WITH {_CRC},
cut AS (
  SELECT row_number() OVER () AS row, doc_id, h, list_filter(
      string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents LEFT JOIN crc USING (doc_id)),
planted AS (
  SELECT row, doc_id, w, coalesce(h % 10 = 0 AND len(w) > 0, false) AS altered, (h // 10) % greatest(len(w), 1) AS a,
         1 + (len(w) - (h // 10) % greatest(len(w), 1)) // (3 + (h // 10) % 8) AS p
  FROM cut),
ws AS (
  SELECT row, doc_id, CASE WHEN altered THEN list_transform(range(len(w)), lambda i:
      w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM planted),
grams AS (
  SELECT row, i, array_to_string(w[i + 1:i + 6], ' ') AS s
  FROM (SELECT row, w, unnest(range(len(w) - 5)) AS i FROM ws WHERE len(w) >= 6)),
pairs AS (
  SELECT a.row, a.i, b.i - a.i AS q FROM grams a JOIN grams b ON a.row = b.row AND a.s = b.s AND a.i < b.i),
islands AS (SELECT row, q, i, i - row_number() OVER (PARTITION BY row, q ORDER BY i) AS island FROM pairs),
repeats AS (SELECT row, q, min(i) AS start, count(*) + 5 AS same FROM islands GROUP BY row, q, island),
runs AS (
  SELECT row, start, same + q AS length, min(q) AS period FROM repeats
  WHERE same >= q AND same + q >= 12 GROUP BY row, start, same + q),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS txt,
         list({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period)[1] AS best
  FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, unnest(range(start + period, start + length)) AS i FROM runs),
words AS (SELECT row, unnest(w) AS x, unnest(range(len(w))) AS i FROM ws WHERE row IN (SELECT row FROM listed)),
kept AS (SELECT row, string_agg(x, ' ' ORDER BY i) AS txt FROM words ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period,
       1000 * best.length // best.period AS exponent_milli, sha256(coalesce(listed.txt, '')) AS runs_sha256,
       sha256(coalesce(kept.txt, array_to_string(w, ' '))) AS collapsed_sha256, len(w) AS n_words
FROM ws LEFT JOIN listed USING (row) LEFT JOIN kept USING (row)
"""


ORACLES: dict[str, str] = {
    "op1_minhash_neardup": OP1,
    "op5_license_sentences": _op5(),
    "op10_multi_index_hashing": OP10,
    "op12_periodic_runs": OP12,
    "op13_merkle_manifest": _op13(),
}

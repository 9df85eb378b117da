"""DuckDB SQL that checks the registered queries, written apart from the operators' methods."""

from __future__ import annotations

import string

from .licenses import BASE, MARK, TEMPLATES

LOWER = f"translate({{0}}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
WORDS = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def template_regex(markup: str) -> str:
    """A template as a regular expression over words that each end in a blank."""
    out = []
    for m in MARK.finditer(markup):
        kind, low, high, plain = m.groups()
        if plain:
            out.append(plain + " ")
        elif kind == "beginOptional":
            out.append("(?:")
        elif kind == "endOptional":
            out.append(")?")
        else:
            out.append(f"(?:[^ ]+ ){{{low},{high}}}")
    return " " + "".join(out)


def licenses_sql() -> str:
    places = []
    for label, phrase in BASE.items():
        words = phrase.split()
        same = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words))
        places.append(f"SELECT doc_id, i - 1 AS place, '{label}' AS label FROM spots WHERE {same}")
    found = ["SELECT doc_id, label FROM base"]
    for label, texts in TEMPLATES.items():
        for text in texts:
            found.append(f"SELECT doc_id, '{label}' AS label FROM d WHERE regexp_matches(joined, '{template_regex(text)}')")
    return f"""
WITH t AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
d AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS joined FROM t),
spots AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t),
base AS ({" UNION ALL ".join(places)}),
b AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
      string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
l AS (SELECT doc_id, count(DISTINCT label) AS k, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
      FROM ({" UNION ALL ".join(found)}) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
       CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(CAST(k AS DOUBLE) / (k + 1), 0.0) AS score
FROM d LEFT JOIN b USING (doc_id) LEFT JOIN l USING (doc_id)"""


def decontamination_sql(window: int = 10) -> str:
    return f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS.format("coalesce(text, '')")} AS w FROM benchmark),
win AS (
  SELECT item, {window} AS k, array_to_string(w[i:i + {window - 1}], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - {window - 2})) AS i FROM b WHERE len(w) >= {window})
  UNION ALL SELECT item, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND {window - 1}),
d AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
sizes AS (SELECT DISTINCT k FROM win),
places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes),
hits AS (
  SELECT doc_id, i, p.k, item FROM places p JOIN win ON win.k = p.k AND win.words = array_to_string(p.w[i:i + p.k - 1], ' ')),
n AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM hits) GROUP BY doc_id),
g AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id)"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit (the reflected polynomial 0xEDB88320)."""
    byte = f"CASE WHEN i % 8 = 0 THEN ascii(substr({text}, (i // 8 + 1)::BIGINT, 1))::UBIGINT ELSE 0::UBIGINT END"
    step = f"xor(xor(c, {byte}) >> 1, 3988292384::UBIGINT * (xor(c, {byte}) & 1))"
    bits = f"list_transform(range(8 * strlen({text})), lambda i: i::UBIGINT)"
    return f"xor(list_reduce({bits}, lambda c, i: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def merkle_sql(arity: int = 8) -> str:
    def leaf(text: str) -> str:
        fields = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)]
        return f"sha256({' || '.join(fields)})"

    def tree(name: str, source: str) -> str:
        return f"""{name} AS (
  SELECT tree, 0 AS level, row_number() OVER (PARTITION BY tree ORDER BY place) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS size, digest FROM {source}
  UNION ALL
  SELECT tree, level + 1, idx // {arity}, (any_value(size) + {arity - 1}) // {arity}, sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE size > 1 GROUP BY tree, level, idx // {arity})"""

    def sides(name: str) -> str:
        """Each starting node's siblings on every level, as before|after."""
        own = f"(a.idx // ({arity}**n.level)::BIGINT)"
        return f"""(SELECT a.tree, a.idx, n.level,
    coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx < {own}), '') || '|' ||
    coalesce(string_agg(n.digest, '' ORDER BY n.idx) FILTER (n.idx > {own}), '') AS side
  FROM {name} a JOIN {name} n ON n.tree = a.tree AND n.size > 1 AND n.idx // {arity} = {own} // {arity}
  WHERE a.level = 0 GROUP BY a.tree, a.idx, n.level)"""

    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf("text")} AS digest,
         CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {leaf("translate(text, '" + string.ascii_uppercase + "', '" + string.ascii_lowercase + "')")} END AS changed
  FROM documents),
leaves AS (SELECT *, struct_pack(i := doc_id, d := digest) AS place FROM docs),
{tree("low", "leaves")},
subroots AS (SELECT '' AS tree, tree AS place, digest FROM low WHERE size = 1),
{tree("top", "subroots")},
groups AS (SELECT place AS tree, digest AS subroot, row_number() OVER (ORDER BY place) - 1 AS spot FROM subroots),
places AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY place) - 1 AS idx FROM leaves),
low_sides AS (SELECT tree, idx, list(side ORDER BY level) AS sides FROM {sides("low")} GROUP BY tree, idx),
top_sides AS (SELECT idx AS spot, list(side ORDER BY level) AS sides FROM {sides("top")} GROUP BY idx),
paths AS (
  SELECT p.doc_id, p.digest AS leaf, g.subroot, coalesce(p.changed, p.digest) AS given, (SELECT digest FROM top WHERE size = 1) AS root,
         list_concat(coalesce(l.sides, []), coalesce(t.sides, [])) AS sides
  FROM places p JOIN groups g USING (tree) LEFT JOIN low_sides l ON l.tree = p.tree AND l.idx = p.idx LEFT JOIN top_sides t USING (spot)),
proved AS (
  SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(sides, ''), '|', '')) AS proof_sha256,
         list_reduce(sides, lambda acc, s: sha256(split_part(s, '|', 1) || acc || split_part(s, '|', 2)), given) AS folded_root
  FROM paths)
SELECT *, folded_root = root AS verified FROM proved"""


def trie_sql(group: int = 20, most: int = 3) -> str:
    words = r"len(regexp_extract_all(p[d].x, '[^\x20\x09-\x0D]+'))"
    return f"""
WITH t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos,
         struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS turn
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT DISTINCT c, c::VARCHAR AS name FROM t),
k AS (SELECT c, {crc32_sql("name")} % {most + 1} AS h, c - c % {group} AS base FROM ids),
parts AS (
  SELECT k.c, 0 AS src, b.pos, b.turn FROM k JOIN t b ON b.c = k.base AND b.pos <= k.h
  UNION ALL SELECT t.c, 1, t.pos, t.turn FROM t JOIN k ON k.c = t.c AND t.pos > k.h),
seqs AS (SELECT c, list(turn ORDER BY src, pos) AS seq FROM parts GROUP BY c),
whole AS (SELECT k.c, coalesce(seq, []) AS seq FROM k LEFT JOIN seqs USING (c)),
prefix AS (SELECT c, d, seq[1:d] AS p, d = len(seq) AS ended FROM (SELECT *, unnest(range(0, len(seq) + 1)) AS d FROM whole)),
node AS (
  SELECT p, any_value(d) AS d, min(c) AS conv, count(*) AS n, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ended), '')) AS ends
  FROM prefix GROUP BY p),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1),
full_node AS (
  SELECT node.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n - 1) * {words} ELSE 0 END AS saved FROM node LEFT JOIN kids USING (p)),
below AS (
  SELECT p[1:u] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved
  FROM (SELECT *, unnest(range(0, d + 1)) AS u FROM full_node) GROUP BY 1)
SELECT n.conv AS conv_id, n.d::BIGINT AS depth, up.conv AS parent_conv_id, n.n AS n_convs, n.n_children, below.n_leaves,
       below.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM full_node n JOIN below USING (p) LEFT JOIN node up ON n.d > 0 AND up.p = n.p[1:n.d - 1]"""

"""DuckDB SQL for the operators that SQL can express."""

EXACT_DUPLICATES = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
),
r AS (
  SELECT doc_id, sha256(norm) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM t
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM r
"""


def license_scan(templates, least: float) -> str:
    """Dice coefficients of word-bigram sets by lists, without size bounds."""
    rows = ",\n  ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
                        for k, (name, text) in enumerate(templates))
    words = "list_filter(string_split(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
    pairs = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH t AS (
  SELECT template, license, {pairs} AS b
  FROM (SELECT template, license, {words.format('body')} AS w
        FROM (VALUES {rows}) AS v(template, license, body))
),
lines AS (
  SELECT doc_id, 'line' AS unit, i - 1 AS unit_no, string_split(text, chr(10))[i] AS body
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents)
),
paragraphs AS (
  SELECT doc_id, 'paragraph' AS unit, i - 1 AS unit_no, p[i] AS body
  FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i
        FROM (SELECT doc_id, regexp_split_to_array(text, '\n[ \t\r]*\n') AS p FROM documents))
  WHERE contains(p[i], chr(10))
),
texts AS (
  SELECT doc_id, 'text' AS unit, 0 AS unit_no, text AS body FROM documents
  WHERE regexp_matches(text, '\n[ \t\r]*\n')
),
u AS (
  SELECT DISTINCT doc_id, unit, unit_no, {pairs} AS a
  FROM (SELECT doc_id, unit, unit_no, {words.format('body')} AS w
        FROM (SELECT * FROM lines UNION ALL SELECT * FROM paragraphs UNION ALL SELECT * FROM texts))
),
s AS (
  SELECT doc_id, unit, unit_no, license, 2.0 * len(list_intersect(a, b)) / (len(a) + len(b)) AS dice
  FROM u, t WHERE len(a) > 0
)
SELECT doc_id, unit, CAST(unit_no AS INTEGER) AS unit_no, license, CAST(dice AS DOUBLE) AS dice
FROM s WHERE dice >= {least} - 1e-9
QUALIFY row_number() OVER (PARTITION BY doc_id, unit, unit_no ORDER BY dice DESC, license) = 1
"""


def license_notices(templates, least: float) -> str:
    """The units, and every run of words that begins and ends at a template's
    bigram: distinct bigrams are counted by their last place before."""
    units = license_scan(templates, least).strip()
    rows = ",\n  ".join("({}, '{}', '{}')".format(k, name, text.replace("'", "''"))
                        for k, (name, text) in enumerate(templates))
    words = "list_filter(string_split(lower(regexp_replace({}, '[^A-Za-z0-9]+', ' ', 'g')), ' '), lambda w: w <> '')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH unit_rows AS ({units}),
pt AS MATERIALIZED (
  SELECT template, license, len(b) AS pairs, len(list_distinct(b)) AS size, list_distinct(b) AS b
  FROM (SELECT template, license, {pairs} AS b
        FROM (SELECT template, license, {words.format('body')} AS w FROM (VALUES {rows}) AS v(template, license, body)))
),
tb AS MATERIALIZED (
  SELECT template, license, size, unnest(b) AS pair, CAST(floor({2 - least} / {least} * pairs + 1e-9) AS BIGINT) AS span,
         CAST(ceil({least} / {2 - least} * size - 1e-9) AS BIGINT) AS need FROM pt
),
pd AS MATERIALIZED (SELECT row_number() OVER () AS d, doc_id, text FROM (SELECT DISTINCT doc_id, text FROM documents)),
ps AS MATERIALIZED (
  SELECT d, i, pair, lag(i) OVER (PARTITION BY d, pair ORDER BY i) AS prev
  FROM (SELECT d, unnest(b) AS pair, unnest(range(len(b))) AS i
        FROM (SELECT d, {pairs} AS b FROM (SELECT d, {words.format('text')} AS w FROM pd)))
),
ph AS MATERIALIZED (
  SELECT *, lead(i, CAST(need - 1 AS INTEGER)) OVER (PARTITION BY d, template ORDER BY i) AS reach
  FROM ps JOIN tb USING (pair)
),
starts AS MATERIALIZED (SELECT * FROM ph WHERE reach - i < span),
runs AS MATERIALIZED (
  SELECT s.d, s.template, s.license, s.size, s.i AS a, e.i AS z
  FROM starts s JOIN ph e ON e.d = s.d AND e.template = s.template AND e.i >= s.i AND e.i < s.i + s.span
),
own AS (
  SELECT r.d, r.template, r.a, r.z, count(*) AS n
  FROM runs r JOIN ps k ON k.d = r.d AND k.i >= r.a AND k.i <= r.z WHERE coalesce(k.prev, -1) < r.a GROUP BY ALL
),
common AS (
  SELECT r.d, r.template, r.a, r.z, count(*) AS n
  FROM runs r JOIN ph k ON k.d = r.d AND k.template = r.template AND k.i >= r.a AND k.i <= r.z
  WHERE coalesce(k.prev, -1) < r.a GROUP BY ALL
),
found AS (
  SELECT DISTINCT d, {{'worst': -dice, 'license': license, 'first': a, 'last': z + 1}} AS f
  FROM (SELECT r.*, 2.0::DOUBLE * c.n / (o.n + r.size) AS dice
        FROM runs r JOIN own o USING (d, template, a, z) JOIN common c USING (d, template, a, z))
  WHERE dice >= {least} - 1e-9
  QUALIFY row_number() OVER (PARTITION BY d, template, a ORDER BY dice DESC, z) = 1
),
apart AS (
  SELECT d, unnest(list_reduce(list([f] ORDER BY f), lambda kept, x: CASE
    WHEN len(list_filter(kept, lambda y: y.first <= x[1].last AND x[1].first <= y.last)) > 0 THEN kept
    ELSE list_concat(kept, x) END)) AS f
  FROM found GROUP BY d
)
SELECT doc_id, unit, unit_no, CAST(NULL AS INTEGER) AS first_word, CAST(NULL AS INTEGER) AS last_word, license, dice
FROM unit_rows
UNION ALL
SELECT doc_id, 'passage', NULL, CAST(f.first AS INTEGER), CAST(f.last AS INTEGER), f.license, -f.worst
FROM apart JOIN pd USING (d)
"""


def centroid_clusters(k: int, rounds: int, salt: str) -> str:
    """Lloyd's rounds in long form, every squared distance afresh; the kept
    vectors get a row number, as a vec_id may repeat."""
    ctes = [f"""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id,
         list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS x
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
),
p AS MATERIALIZED (SELECT row_no, unnest(x) AS x, unnest(range(64)) AS j FROM v),
c0 AS MATERIALIZED (
  SELECT c, unnest(x) AS x, unnest(range(64)) AS j
  FROM (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id)) - 1 AS c, x FROM v) WHERE c < {k}
)"""]
    nearest = """
a{t} AS MATERIALIZED (
  SELECT row_no, c, d FROM (
    SELECT row_no, c, sum((p.x - q.x) * (p.x - q.x)) AS d FROM p JOIN c{t} q USING (j) GROUP BY row_no, c)
  QUALIFY row_number() OVER (PARTITION BY row_no ORDER BY d, c) = 1
)"""
    for t in range(rounds):
        ctes.append(nearest.format(t=t))
        ctes.append(f"""
c{t + 1} AS MATERIALIZED (
  SELECT o.c, o.j, coalesce(m.x, o.x) AS x
  FROM c{t} o LEFT JOIN (
    SELECT c, j, CAST((s - ((s % n) + n) % n) // n AS BIGINT) AS x
    FROM (SELECT c, j, sum(x) AS s, count(*) AS n FROM a{t} JOIN p USING (row_no) GROUP BY c, j)) m USING (c, j)
)""")
    ctes.append(nearest.format(t=rounds))
    return f"""
WITH {",".join(ctes)},
marks AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS mark FROM c{rounds} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, mark AS centroid_sha256
FROM a{rounds} JOIN v USING (row_no) JOIN marks USING (c)
"""


def _tree_levels(name: str, leaves: str, fan: int, levels: int) -> str:
    """Nodes of every level, the digests before and after each, and the roots."""
    run = f"(PARTITION BY tree, pos // {fan} ORDER BY pos ROWS BETWEEN"
    out = [f"{name}0 AS MATERIALIZED ({leaves})"]
    for n in range(levels):
        out.append(f"""{name}{n}s AS MATERIALIZED (
  SELECT tree, pos, coalesce(string_agg(h, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
         coalesce(string_agg(h, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM {name}{n} WHERE total > 1)""")
        out.append(f"""{name}{n + 1} AS MATERIALIZED (
  SELECT tree, pos // {fan} AS pos, (total + {fan - 1}) // {fan} AS total, sha256(string_agg(h, '' ORDER BY pos)) AS h
  FROM {name}{n} WHERE total > 1 GROUP BY tree, pos // {fan}, total)""")
    ends = " UNION ALL ".join(f"SELECT tree, h FROM {name}{n} WHERE total = 1" for n in range(levels + 1))
    return ",\n".join([*out, f"{name}_root AS MATERIALIZED ({ends})"])


def _fold(name: str, rows: str, tree: str, pos: str, fan: int, levels: int) -> str:
    """Every document's digest and siblings taken up one level after the other."""
    out = []
    for n in range(levels):
        out.append(f"""{name}_f{n} AS (
  SELECT f.* REPLACE (proof || coalesce(s.before || s.after, '') AS proof,
                      CASE WHEN s.tree IS NULL THEN folded ELSE sha256(s.before || folded || s.after) END AS folded)
  FROM {rows} f LEFT JOIN {name}{n}s s ON s.tree = f.{tree} AND s.pos = f.{pos} // {fan ** n})""")
        rows = f"{name}_f{n}"
    return ",\n".join(out)


def merkle_manifest(fan: int, levels: int = 8) -> str:
    """The trees level by level, siblings as text; ``fan ** levels`` leaves a
    tree at most."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"
    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    # crc32 bit by bit: eight steps (-1) after each byte
    steps = ("list_concat([4294967295], flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
             "lambda b: [CAST(ascii(b) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])))")
    crc = (f"xor(list_reduce({steps}, lambda r, b: CASE WHEN b >= 0 THEN xor(r, b) "
           "ELSE xor(r >> 1, 3988292384 * (r & 1)) END), 4294967295)")
    tops = "SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS total, h FROM n_root"
    return f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS source_tree, sha256({head} || {field('text')}) AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN sha256({head} || {field(lower)}) END AS changed
  FROM documents
),
e AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY source_tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY source_tree) AS total FROM d
),
{_tree_levels('n', 'SELECT source_tree AS tree, pos, total, leaf AS h FROM e', fan, levels)},
{_tree_levels('t', tops, fan, levels)},
places AS (SELECT tree AS source_tree, h AS subroot, '' AS top, row_number() OVER (ORDER BY tree) - 1 AS top_at FROM n_root),
f AS (SELECT e.*, subroot, top, top_at, '' AS proof, coalesce(changed, leaf) AS folded FROM e JOIN places USING (source_tree)),
{_fold('n', 'f', 'source_tree', 'pos', fan, levels)},
{_fold('t', f'n_f{levels - 1}', 'top', 'top_at', fan, levels)}
SELECT doc_id, leaf, subroot, r.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = r.h AS verified
FROM t_f{levels - 1}, t_root r
"""


def shingle_duplicates(least: int) -> str:
    """All pairs of documents that share a shingle, then everything reachable."""
    words = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x20\x09-\x0D]+')")
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({words}, []) AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2),
                        lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]) END) AS s
  FROM w
),
g AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM s),
links AS MATERIALIZED (
  SELECT x, y FROM (
    SELECT a.doc_id AS x, b.doc_id AS y, a.n + b.n AS total, count(*) AS common
    FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL)
  WHERE 100 * common >= {least} * (total - common)
),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM s UNION SELECT reach.node, y FROM reach JOIN links ON seen = x
),
root AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM s JOIN root ON node = doc_id
"""

"""The same results as SQL text for another engine, where SQL can express them."""

from barstream.llm import mixing, templates, urls, vectors

WORD = r"[^\x20\x09-\x0D]+"
ASCII_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Mostly fixed templates of lines at the steps of their rows, and those of them that enough documents have.
_STAYS = f"(place <= {templates.DEPTH} OR rung >= step)"
_TEMPLATES = f"""
  SELECT doc_id, text, line, string_agg(CASE WHEN {_STAYS} THEN token ELSE '{templates.FIELD}' END, ' ' ORDER BY place) AS template
  FROM {{rows}} GROUP BY doc_id, text, line, step
  HAVING count(*) FILTER ({_STAYS} AND token <> '{templates.FIELD}') >= {templates.MIN_FIXED} * count(*)
     AND count(*) FILTER (place > {templates.DEPTH} AND rung >= step) >= {templates.MIN_LATER} * count(*) FILTER (place > {templates.DEPTH} AND token <> '{templates.FIELD}')"""
_OFTEN = f"SELECT template FROM {{rows}} GROUP BY template HAVING count(DISTINCT (doc_id, text)) >= {templates.MIN_DOCS}"

OP1 = rf"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
raw AS (
  SELECT *, regexp_extract_all(line, '{WORD}') AS words FROM lines),
tokens AS (
  SELECT doc_id, text, n, len(words) AS size, unnest(words) AS word, generate_subscripts(words, 1) AS place
  FROM raw WHERE len(words) >= {templates.MIN_TOKENS}),
masked AS (
  SELECT doc_id, text, n, size, place, CASE WHEN regexp_matches(word, '[0-9]') THEN '{templates.FIELD}' ELSE word END AS token FROM tokens),
whole AS (
  SELECT doc_id, text, n, size, string_agg(token, ' ' ORDER BY place) AS line,
         string_agg(token, ' ' ORDER BY place) FILTER (place <= {templates.DEPTH}) AS lead
  FROM masked GROUP BY ALL),
pairs AS (SELECT DISTINCT doc_id, text, size, lead, line FROM whole),
parts AS (
  SELECT doc_id, text, size, lead, line, unnest(string_split(line, ' ')) AS token, generate_subscripts(string_split(line, ' '), 1) AS place FROM pairs),
support AS (
  SELECT size, lead, place, token, count(*) AS n FROM parts WHERE place > {templates.DEPTH} AND token <> '{templates.FIELD}'
  GROUP BY ALL HAVING count(*) >= {templates.MIN_DOCS}),
ranked AS (
  SELECT p.*, CASE WHEN s.n IS NULL THEN 0 ELSE length(bin(s.n // {templates.MIN_DOCS})) END AS rung
  FROM parts p LEFT JOIN support s USING (size, lead, place, token)),
first AS (SELECT *, 1 AS step FROM ranked),
made AS ({_TEMPLATES.format(rows="first")}),
often AS ({_OFTEN.format(rows="made")}),
fine AS (SELECT doc_id, text, line FROM made JOIN often USING (template)),
others AS (SELECT r.* FROM ranked r ANTI JOIN fine USING (doc_id, text, line)),
tops AS (SELECT doc_id, text, line, max(rung) + 1 AS top FROM others GROUP BY ALL),
steps AS (SELECT o.*, step FROM others o JOIN tops USING (doc_id, text, line), LATERAL (SELECT unnest(range(1, top + 1)) AS step)),
coarse AS ({_TEMPLATES.format(rows="steps")}),
again AS ({_OFTEN.format(rows="coarse")}),
found AS (SELECT * FROM fine UNION SELECT doc_id, text, line FROM coarse JOIN again USING (template)),
gone AS (SELECT DISTINCT w.doc_id, w.text, w.n FROM whole w JOIN found USING (doc_id, text, line)),
kept AS (
  SELECT l.doc_id, l.text, count(*) AS n_lines, count(g.n) AS n_dropped,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.n) FILTER (g.n IS NULL), '') AS stay
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.text = g.text AND l.n = g.n GROUP BY l.doc_id, l.text)
SELECT d.doc_id, coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_dropped, 0) AS n_dropped, sha256(k.stay) AS text_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id AND d.text = k.text
"""

OP6 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("text")}, '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + least(3, len(w)) - 1], ' ') AS s
  FROM words, LATERAL (SELECT unnest(range(1, greatest(len(w) - 2, least(len(w), 1)) + 1)) AS k)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared.n >= 85 * (x.n + y.n - shared.n)),
reach AS (
  SELECT doc_id, doc_id AS c FROM documents
  UNION SELECT links.b, reach.c FROM reach JOIN links ON links.a = reach.doc_id)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.c) AS component_id, r.doc_id = min(r.c) AS kept
FROM reach r LEFT JOIN sizes s USING (doc_id) GROUP BY r.doc_id
"""

OP8 = rf"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all({ASCII_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all({ASCII_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS s
  FROM items, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k) WHERE len(w) > 0),
cut AS (
  SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM docs, (SELECT DISTINCT n FROM windows) sizes, LATERAL (SELECT unnest(range(1, len(w) - n + 2)) AS k)),
hits AS (SELECT doc_id, item_id, cut.n, k FROM cut JOIN windows USING (n, s)),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM hits GROUP BY doc_id),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(f.n_items, 0) AS n_items,
       sha256(coalesce(f.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN found f USING (doc_id) LEFT JOIN hit_words h USING (doc_id)
"""

_MIX = f"""
sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS n_tokens,
         ('0x' || substr(md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS ident
  FROM documents),
per AS (SELECT source, sum(n_tokens)::DOUBLE AS tokens, count(*) AS docs FROM sized GROUP BY source),
shares AS (SELECT source, tokens, docs, tokens / (SELECT sum(tokens) FROM per) AS p FROM per)
"""
# How much entropy the weights of an exponent x have, and the most often that a source is repeated.
_ENTROPY = "(SELECT -sum(w * ln(w)) FROM (SELECT pow(p, {0}) / sum(pow(p, {0})) OVER () AS w FROM shares WHERE p > 0))"
_REPEATS = "(SELECT max(w * total / tokens) FROM (SELECT pow(p, {0}) / sum(pow(p, {0})) OVER () AS w, tokens, sum(tokens) OVER () AS total FROM shares WHERE p > 0))"

OP9 = f"""
WITH RECURSIVE {_MIX},
target AS (SELECT ({_ENTROPY.format("1.0")} + ln((SELECT count(*) FROM shares WHERE p > 0))) / 2 AS h),
evenly AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high
  UNION ALL
  SELECT step + 1, CASE WHEN e >= h THEN mid ELSE low END, CASE WHEN e >= h THEN high ELSE mid END
  FROM (SELECT step, low, high, mid, h, {_ENTROPY.format("v.mid")} AS e FROM (SELECT *, (low + high) / 2 AS mid FROM evenly WHERE step < {mixing.STEPS}) v, target)),
even AS (SELECT CASE WHEN {_ENTROPY.format("1.0")} < h THEN low ELSE 1.0 END AS x FROM evenly, target WHERE step = {mixing.STEPS}),
seldom AS (
  SELECT 0 AS step, x AS low, 1.0::DOUBLE AS high FROM even
  UNION ALL
  SELECT step + 1, CASE WHEN r > 4 THEN mid ELSE low END, CASE WHEN r > 4 THEN high ELSE mid END
  FROM (SELECT step, low, high, mid, {_REPEATS.format("v.mid")} AS r FROM (SELECT *, (low + high) / 2 AS mid FROM seldom WHERE step < {mixing.STEPS}) v)),
exponent AS (
  SELECT CASE WHEN {_REPEATS.format("even.x")} > 4 THEN seldom.high ELSE even.x END AS x FROM even, seldom WHERE step = {mixing.STEPS}),
planned AS (
  SELECT source, docs, tokens, CASE WHEN p > 0 THEN pow(p, x) / (SELECT sum(pow(p, x)) FROM shares, exponent WHERE p > 0) ELSE 0.0 END AS weight,
         greatest(1, ceil(docs / {mixing.BLOCK_DOCS}.0))::BIGINT AS blocks
  FROM shares, exponent),
parts AS (
  SELECT *, CASE WHEN tokens > 0 THEN floor(weight * (SELECT sum(tokens) FROM per) / tokens) ELSE 1 END AS whole FROM planned),
dealt AS (
  SELECT s.doc_id, s.source, s.n_tokens, s.ident, p.weight, p.whole, s.ident % p.blocks AS block,
         CASE WHEN p.tokens > 0 THEN p.weight * (SELECT sum(tokens) FROM per) - p.whole * p.tokens ELSE 0.0 END AS part
  FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),
placed AS (
  SELECT *, coalesce(sum(n_tokens) OVER o, 0) AS start, count(*) OVER o AS rank FROM dealt
  WINDOW o AS (PARTITION BY source ORDER BY md5('{mixing.SEED}:' || block), ident ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT doc_id, source, n_tokens, round(weight, 9) AS weight, block, (whole + CASE WHEN start < part THEN 1 ELSE 0 END)::INT AS copies, rank AS last_epoch_rank
FROM placed
"""

_HITS = {
    kind: " + ".join(rf"regexp_matches(lowered, '(^|[^\pL\pN]){t}($|[^\pL\pN])')::BIGINT" for t in terms)
    for kind, terms in (("strict", urls.STRICT), ("soft", urls.SOFT))
}
_RULES = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in urls.RULES)

OP10 = rf"""
WITH rules(verdict, host, path) AS (VALUES {_RULES}),
parsed AS (
  SELECT page_id, {ASCII_LOWER.format("url")} AS lowered, {ASCII_LOWER.format("regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)")} AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
counted AS (
  SELECT p.*, {_HITS["strict"]} AS n_strict, {_HITS["soft"]} AS n_soft,
         (SELECT max_by((r.host || r.path, r.verdict), length(r.host || r.path)) FROM rules r
          WHERE (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)) AS r
  FROM parsed p)
SELECT page_id, host, path, r[1] AS rule, coalesce(r[2], CASE WHEN n_strict > 0 OR n_soft >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       n_strict, n_soft
FROM counted
"""

# Components as integers; sums of their products are exact in doubles.
_INTEGERS = "list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 1024))"
_USABLE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT abs(CAST(x AS DOUBLE)) < {limit})) = 0".format(limit=vectors.LIMIT)
_NEAR = "list_inner_product(list_transform(list_zip({a}, {b}), lambda z: z[1] - z[2]), list_transform(list_zip({a}, {b}), lambda z: z[1] - z[2]))"
_MEANS = "list(floor((s - ((s % n) + n) % n) / n) ORDER BY pos)"  # s less its remainder: exact


def _refined(name: str, assigned: str, old: str, keys: str) -> str:
    """The entries of ``old`` after one round over (keys, v) rows."""
    on = " AND ".join(f"o.{k} = m.{k}" for k in keys.split(", "))
    return f"""{name} AS (
  SELECT {", ".join(f"o.{k}" for k in keys.split(", "))}, coalesce(m.c, o.c) AS c FROM {old} o LEFT JOIN (
    SELECT {keys}, {_MEANS} AS c FROM (
      SELECT {keys}, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (
        SELECT {keys}, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM {assigned}) GROUP BY {keys}, pos)
    GROUP BY {keys}) m ON {on})"""


def _op11(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    d = _NEAR.format(a="p.v", b="b.c")
    nearest = lambda n: f"""a{n} AS (
  SELECT p.vec_id, p.label, p.part, any_value(p.v) AS v, arg_min(b.entry, ({d}, b.entry)) AS entry, min({d}) AS error
  FROM parts p JOIN b{n} b USING (part) GROUP BY p.vec_id, p.label, p.part)"""  # noqa: E731
    steps = [f"""
WITH kept AS (SELECT vec_id, label, {_INTEGERS} AS v FROM embeddings WHERE embedding IS NOT NULL AND {_USABLE}),
parts AS (SELECT vec_id, label, part, v[CAST(part * len(v) / {parts} AS BIGINT) + 1 : CAST((part + 1) * len(v) / {parts} AS BIGINT)] AS v FROM kept, (SELECT unnest(range({parts})) AS part)),
b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM parts QUALIFY entry < {entries})"""]  # fmt: skip
    for n in range(rounds):
        steps += [nearest(n), _refined(f"b{n + 1}", f"a{n}", f"b{n}", "part, entry")]
    steps.append(nearest(rounds))
    return ",\n".join(steps) + f""",
book AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY part, entry)) AS h FROM b{rounds}),
coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error FROM a{rounds} GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256 FROM coded, book
"""


def _op13(dims: int = 64, k: int = 8, rounds: int = 10) -> str:
    d = _NEAR.format(a="p.v", b="b.c")
    nearest = lambda n: f"""a{n} AS (
  SELECT p.vec_id, any_value(p.v) AS v, arg_min(b.entry, ({d}, b.entry)) AS entry, min({d}) AS distance
  FROM kept p, b{n} b GROUP BY p.vec_id)"""  # noqa: E731
    steps = [f"""
WITH kept AS (SELECT vec_id, {_INTEGERS} AS v FROM embeddings WHERE len(embedding) = {dims} AND {_USABLE}),
b0 AS (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS entry, v AS c FROM kept QUALIFY entry < {k})"""]
    for n in range(rounds):
        steps += [nearest(n), _refined(f"b{n + 1}", f"a{n}", f"b{n}", "entry")]
    steps.append(nearest(rounds))
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(entry AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance,
       CAST(sum(distance) OVER (PARTITION BY entry) AS BIGINT) AS cluster_inertia, CAST(sum(distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM a{rounds} JOIN b{rounds} USING (entry)
"""


OP11, OP13 = _op11(), _op13()

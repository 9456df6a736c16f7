"""DuckDB SQL of the queries that SQL can express: the contracts word for word, on whole tables."""

from __future__ import annotations

from wayfare.llm import chat

_LOWER = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_PLAIN = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"

DECONTAMINATION = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS words FROM documents),
items AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {_ALNUM} AS words FROM benchmark),
sized AS (SELECT *, LEAST(10, len(words)) AS n FROM items WHERE len(words) > 0),
wanted AS (SELECT DISTINCT item, n, words[k + 1 : k + n] AS g
  FROM (SELECT *, UNNEST(range(0, len(words) - n + 1)) AS k FROM sized)),
there AS (SELECT r, k, n, words[k + 1 : k + n] AS g
  FROM (SELECT r, words, n, UNNEST(range(0, len(words) - n + 1)) AS k
    FROM docs, (SELECT DISTINCT n FROM wanted) WHERE len(words) >= n)),
hits AS (SELECT r, k, n, item FROM there JOIN wanted USING (n, g)),
hit_words AS (SELECT r, COUNT(DISTINCT p) AS n_hit FROM (SELECT r, UNNEST(range(k, k + n)) AS p FROM hits) GROUP BY r),
hit_items AS (SELECT r, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, len(words) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)"""

BYTE_DEDUP = """
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, hex(COALESCE(text, '')) AS h, strlen(COALESCE(text, '')) AS n
  FROM documents),
blocks AS (SELECT r, j, substr(h, 400 * j + 1, 800) AS two
  FROM (SELECT r, h, UNNEST(range(0, n // 200 + 1)) AS j FROM docs WHERE n >= 200)),
places AS (SELECT r, 200 * j + o AS k, md5(substr(two, 2 * o + 1, 400)) AS s
  FROM (SELECT r, j, two, UNNEST(range(0, 200)) AS o FROM blocks) WHERE strlen(two) >= 2 * o + 400),
again AS (SELECT r, k FROM places SEMI JOIN (SELECT s FROM places GROUP BY s HAVING COUNT(*) > 1) USING (s)),
opened AS (SELECT *, COALESCE(lag(k) OVER (PARTITION BY r ORDER BY k) + 200 < k, TRUE)::INTEGER AS opens FROM again),
numbered AS (SELECT *, SUM(opens) OVER (PARTITION BY r ORDER BY k ROWS UNBOUNDED PRECEDING) AS span FROM opened),
spans AS (SELECT r, MIN(k) AS a, MAX(k) + 200 AS b FROM numbered GROUP BY r, span),
borders AS (SELECT r, a, b FROM spans UNION ALL SELECT r, n, n FROM docs),
pieces AS (SELECT r, a, substr(h, 2 * before + 1, 2 * (a - before)) AS piece FROM docs JOIN
  (SELECT r, a, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a, b) AS before FROM borders) USING (r)),
kept AS (SELECT r, string_agg(piece, '' ORDER BY a) AS kept FROM pieces GROUP BY r),
gone AS (SELECT r, CAST(SUM(b - a) AS BIGINT) AS n_removed, COUNT(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, COALESCE(n_removed, 0) AS n_removed, COALESCE(n_spans, 0) AS n_spans,
  sha256(unhex(kept)) AS kept_sha256
FROM docs JOIN kept USING (r) LEFT JOIN gone USING (r)"""

NEAR_DEDUP = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN.format(_LOWER)} AS words FROM documents),
shingles AS (SELECT DISTINCT r, array_to_string(words[k + 1 : k + 4], ' ') AS s
  FROM (SELECT r, words, UNNEST(range(0, GREATEST(len(words) - 3, 1))) AS k FROM docs WHERE len(words) > 0)),
sizes AS (SELECT r, COUNT(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS x, b.r AS y, COUNT(*) AS c FROM shingles a JOIN shingles b USING (s) WHERE a.r <> b.r GROUP BY 1, 2),
links AS (SELECT x, y FROM common JOIN sizes p ON x = p.r JOIN sizes q ON y = q.r WHERE 100 * c >= 80 * (p.n + q.n - c)),
reached AS (SELECT r AS x, r AS y FROM docs UNION SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x),
least AS (SELECT x AS r, MIN(doc_id) AS component_id FROM reached JOIN docs ON y = docs.r GROUP BY 1)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM docs JOIN least USING (r) LEFT JOIN sizes USING (r)"""

SUBSTRING_DEDUP = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN.format("COALESCE(text, '')")} AS words FROM documents),
windows AS (SELECT r, doc_id, k, array_to_string(words[k + 1 : k + 50], ' ') AS g
  FROM (SELECT *, UNNEST(range(0, len(words) - 49)) AS k FROM docs WHERE len(words) >= 50)),
first AS (SELECT g, MIN(doc_id) AS doc FROM windows GROUP BY g),
gone AS (SELECT DISTINCT r, UNNEST(range(k + 1, k + 51)) AS p FROM windows JOIN first USING (g) WHERE doc < doc_id),
kept AS (SELECT r, COUNT(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT r, UNNEST(words) AS word, UNNEST(range(1, len(words) + 1)) AS p FROM docs) ANTI JOIN gone USING (r, p)
  GROUP BY r)
SELECT doc_id, len(words) AS n_words, len(words) - COALESCE(n, 0) AS n_removed, sha256(COALESCE(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)"""


def _escaped_length(column: str, more: str = "") -> str:
    """Characters of an escaped text: one more for every place that an escape goes to."""
    risky = chat.RISKY.replace("'", "''") + more
    return f"len({column}) + len(regexp_extract_all({column}, '{risky}'))"


CHAT_FORMATTING = f"""
WITH said AS (SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, UNNEST([0, 1]), UNNEST(['user', 'assistant']), '</s>[INST] ok [/INST]')
SELECT conv_id, COUNT(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(COALESCE(SUM(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), ''))
    AS loss_sha256,
  CAST(SUM({len(chat.TURN) + len(chat.END) + 2} + {_escaped_length('role', '|' + chr(92) + 'n')}
    + {_escaped_length('text')}) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""


def url_filter(rules: list, order: int) -> str:
    """Rules, then both models order by order, then the threshold."""

    def chosen(value: str) -> str:
        """The longest rule that fits; of equally long ones a block."""
        ranked = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block", r.text))
        cases = []
        for rule in ranked:
            host, _, path = rule.text.partition("/")
            fits = f"(host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{path}')"
            cases.append(f"WHEN {fits} THEN '{getattr(rule, value)}'")
        return f"CASE {' '.join(cases)} END"

    start, stop = f"repeat(chr(2), {order})", "chr(3)"
    models = []
    for n in range(order + 1):
        before = "SELECT gram, 1.0::DOUBLE / letters AS pa, 1.0::DOUBLE / letters AS pb FROM wanted, alphabet" if n == 0 \
            else f"SELECT * FROM model{n - 1}"
        blended = ", ".join(
            f"CASE WHEN n{k} > 0 THEN (COALESCE({k}, 0) + kinds{k} * p{k}) / (n{k} + kinds{k}) ELSE p{k} END AS p{k}" for k in "ab")
        models.append(f"""
seen{n} AS (SELECT substr(gram, {order + 1 - n}, {n + 1}) AS tail, SUM(a)::DOUBLE AS a, SUM(b)::DOUBLE AS b FROM counts GROUP BY 1),
contexts{n} AS (SELECT substr(tail, 1, {n}) AS context, SUM(a) AS na, SUM(b) AS nb, COUNT(*) FILTER (WHERE a > 0) AS kindsa,
  COUNT(*) FILTER (WHERE b > 0) AS kindsb FROM seen{n} GROUP BY 1),
model{n} AS (SELECT gram, {blended} FROM ({before}) m
  LEFT JOIN seen{n} ON substr(gram, {order + 1 - n}, {n + 1}) = tail
  LEFT JOIN contexts{n} ON substr(gram, {order + 1 - n}, {n}) = context)""")
    return f"""
WITH rests AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
named AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rests),
ruled AS (SELECT *, host || path AS text, {chosen('text')} AS rule, {chosen('verdict')} AS kind FROM named),
texts AS (SELECT text, COUNT(*) FILTER (WHERE kind = 'allow') AS a, COUNT(*) FILTER (WHERE kind = 'block') AS b,
  ascii(substr(md5(text), 32, 1)) % 5 = 0 AS held FROM ruled GROUP BY text),
marked AS (SELECT * FROM texts WHERE a + b > 0),
sides AS (SELECT COUNT(*) = 2 AND MIN(LEAST(a, b)) > 0 AS parted
  FROM (SELECT held, SUM(a) AS a, SUM(b) AS b FROM marked GROUP BY held)),
training AS (SELECT text, a, b FROM marked, sides WHERE NOT (parted AND held)),
unseen AS (SELECT text, a, b FROM marked, sides WHERE NOT parted OR held),
places AS (SELECT text, substr({start} || text || {stop}, p, {order + 1}) AS gram
  FROM (SELECT text, UNNEST(range(1, len(text) + 2)) AS p FROM texts)),
counts AS (SELECT gram, SUM(a) AS a, SUM(b) AS b FROM places JOIN training USING (text) GROUP BY gram),
alphabet AS (SELECT COUNT(DISTINCT substr(gram, {order + 1}, 1)) + 1 AS letters FROM counts),
wanted AS (SELECT DISTINCT gram FROM places),{','.join(models)},
ratios AS (SELECT gram, CAST(ROUND((ln(pa) - ln(pb)) * 1000000000) AS BIGINT) AS ratio FROM model{order}),
scores AS (SELECT text, SUM(ratio)::DOUBLE / (len(text) + 1) / 1000000000 AS score
  FROM places JOIN ratios USING (gram) GROUP BY text),
bins AS (SELECT GREATEST(-2000, LEAST(2000, CAST(floor(score * 100) AS INTEGER))) AS place, SUM(a) AS a, SUM(b) AS b
  FROM scores JOIN unseen USING (text) GROUP BY 1),
errors AS (SELECT place, COALESCE(SUM(a) OVER below, 0)::DOUBLE / NULLIF(SUM(a) OVER (), 0)
    - COALESCE(SUM(b) OVER below, 0)::DOUBLE / NULLIF(SUM(b) OVER (), 0) AS error
  FROM bins WINDOW below AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
bound AS (SELECT (SELECT place / 100.0::DOUBLE FROM errors WHERE error IS NOT NULL ORDER BY error, place LIMIT 1) AS bound)
SELECT page_id, host, path, rule,
  COALESCE(kind, CASE WHEN score < bound THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled LEFT JOIN scores USING (text), bound"""


#: Unsigned CRC-32 of a blob's bytes, its table made by the rule: x is halved eight times, xor the polynomial where odd.
_CRC_TABLE = """SELECT list(x ORDER BY i) AS crcs FROM (SELECT i, list_reduce(range(0, 8), lambda x, y:
  CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END, i) AS x FROM range(0, 256) t(i))"""


def _crc(text: str) -> str:
    """CRC-32 of a text; ``crcs`` is the table."""
    values = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda two: ('0x' || two)::BIGINT)"
    step = "xor(crcs[xor(x, y) % 256 + 1], x // 256)"
    return f"xor(list_reduce({values}, lambda x, y: {step}, 4294967295::BIGINT), 4294967295::BIGINT)"


# Runs of period q are the stretches over which three words equal those q words on; of the periods that a stretch
# has, the smallest counts.
PERIODIC_RUNS = f"""
WITH crc AS ({_CRC_TABLE}),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN.format("COALESCE(text, '')")} AS w,
  {_crc("COALESCE(CAST(doc_id AS VARCHAR), '')")} AS h FROM documents, crc),
laid AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN h % 10 = 0 AND len(w) > 0 AND doc_id IS NOT NULL
  THEN (h // 10) % len(w) END AS a FROM docs),
placed AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM laid),
planted AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE
  list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM placed),
words AS (SELECT r, n, UNNEST(range(0, n)) AS i, UNNEST(w) AS word FROM planted),
triples AS (SELECT r, n, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS t
  FROM words WINDOW o AS (PARTITION BY r ORDER BY i)),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM triples x JOIN triples y USING (r, t)
  WHERE y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs),
periodic AS (SELECT r, q, MIN(i) AS s, COUNT(*) + q + 2 AS l FROM islands GROUP BY r, q, island
  HAVING COUNT(*) + q + 2 >= GREATEST(6, 4 * q)),
runs AS (SELECT * FROM periodic x WHERE NOT EXISTS (FROM periodic y
  WHERE y.r = x.r AND y.q < x.q AND y.s <= x.s AND y.s + y.l >= x.s + x.l)),
listed AS (SELECT r, COUNT(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS runs
  FROM runs GROUP BY r),
best AS (SELECT r, s, l, q FROM runs x WHERE NOT EXISTS (FROM runs y WHERE y.r = x.r AND
  (y.l * x.q > x.l * y.q OR (y.l * x.q = x.l * y.q AND (y.s, y.q) < (x.s, x.q))))),
gone AS (SELECT DISTINCT r, UNNEST(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, COALESCE(n_runs, 0) AS n_runs, s AS start, l AS length, q AS period, 1000 * l // q AS exponent_milli,
  sha256(COALESCE(runs, '')) AS runs_sha256, sha256(COALESCE(kept, '')) AS collapsed_sha256
FROM planted LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""

FILL_IN_MIDDLE = """
WITH docs AS (SELECT doc_id, COALESCE(text, '') AS text, regexp_extract_all(COALESCE(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
  sha256('7:' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS d FROM documents),
drawn AS (SELECT *, len(u) AS n, [('0x' || substr(d, 8 * k + 1, 8))::BIGINT for k in range(0, 4)] AS h FROM docs),
cut AS (SELECT *, LEAST(h[1] % (n + 1), h[2] % (n + 1)) AS a, GREATEST(h[1] % (n + 1), h[2] % (n + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 100
  THEN 'plain' WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
parts AS (SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle,
  array_to_string(u[b + 1:], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN len(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts"""


def sharding(shards: int, slots: int, pieces: int) -> str:
    """Slots by digest, heavy ones in parts, then one unit after another to the least filled shard."""
    return f"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
docs AS (SELECT row_number() OVER () AS r, doc_id, strlen(COALESCE(text, '')) + 8 AS size, {_crc("COALESCE(text, '')")} AS c
  FROM documents, crc),
digests AS (SELECT *, md5(COALESCE(CAST(doc_id AS VARCHAR), '') || ':' || size || ':' || c) AS d FROM docs),
slotted AS (SELECT *, ('0x' || substr(d, 1, 8))::BIGINT % {slots} AS v FROM digests),
seated AS (SELECT *, row_number() OVER (PARTITION BY v ORDER BY d, r) - 1 AS seat,
  COUNT(*) OVER (PARTITION BY v) AS n, SUM(size) OVER (PARTITION BY v) AS b, SUM(size) OVER () AS total FROM slotted),
parted AS (SELECT *, seat % LEAST(n, ceil(b / (total / {shards * pieces}::DOUBLE))::BIGINT) AS part,
  LEAST(n, ceil(b / (total / {shards * pieces}::DOUBLE))::BIGINT) AS parts FROM seated),
units AS (SELECT v, part, COUNT(*) AS n, SUM(size)::BIGINT AS b, row_number() OVER (ORDER BY SUM(size) DESC, v, part) AS k
  FROM parted GROUP BY v, part),
dealt AS (SELECT 0::BIGINT AS k, 0::BIGINT AS shard, [0::BIGINT for i in range(0, {shards})] AS loads
  UNION ALL SELECT k, shard, list_transform(loads, lambda x, i: CASE WHEN i = shard + 1 THEN x + b ELSE x END)
  FROM (SELECT units.k, units.b, loads, list_position(loads, list_min(loads)) - 1 AS shard FROM dealt JOIN units ON units.k = dealt.k + 1)),
map AS (SELECT v, part, shard, COALESCE(SUM(n) OVER (PARTITION BY shard ORDER BY v, part
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM units JOIN dealt USING (k))
SELECT doc_id, size, c AS text_crc32, 'bytes' AS law, CAST(shard AS INTEGER) AS shard,
  CAST(start + seat // parts AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard, CAST(v AS INTEGER) AS virtual_slot
FROM parted JOIN map USING (v, part)"""

"""DuckDB statements that state registered queries independently, over whole tables."""

from __future__ import annotations

from semprune.llm import chat, quality, trust
from semprune.llm import mixing as mixes
from semprune.llm import vector_codes as codes
from semprune.llm import warc as archives

SETTLED = 100


def _list(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def quality_rules() -> str:
    n = len(quality.CLASSES)
    term = "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS id, doc_id, lang, coalesce(text, '') AS t FROM documents),
cut AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
  length(t) AS c0, length(regexp_replace(t, '[\p{{Ll}}\p{{Nd}}]+', '', 'g')) AS c1,
  length(regexp_replace(t, '[\p{{Ll}}\p{{Nd}}\x20\x09-\x0D]+', '', 'g')) AS c2,
  length(regexp_replace(t, '[\p{{Ll}}\p{{Nd}}\x20\x09-\x0D\p{{Lu}}]+', '', 'g')) AS c3,
  length(regexp_replace(t, '[\p{{Ll}}\p{{Nd}}\x20\x09-\x0D\p{{Lu}}#*$%&|<>]+', '', 'g')) AS c4,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
  list_filter(regexp_extract_all(lower(t), '\p{{L}}+'), lambda x: x IN ({_list(quality.COMMON)})) AS found FROM texts),
spots AS (SELECT id, unnest(range(1, len(words) - 1)) AS i, words FROM cut WHERE len(words) > 2),
grams AS (SELECT id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM spots),
twice AS (SELECT id, i FROM (SELECT id, i, count(*) OVER (PARTITION BY id, a, b, c) AS n FROM grams) WHERE n > 1),
covered AS (SELECT id, count(DISTINCT i + o) AS n FROM twice CROSS JOIN (VALUES (0), (1), (2)) v(o) GROUP BY id),
base AS (SELECT cut.id, doc_id, lang, len(words) AS n_words, c0 - c1 + c2 AS word_chars, c3 - c4 AS n_symbols,
  len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
  [c0 - c1, c1 - c2, c2 - c3, c3 - c4, c4] AS chars, c0 AS n_chars, found FROM cut LEFT JOIN covered USING (id)),
m AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM base),
good AS (SELECT *, unnest([lang, '*']) AS l FROM m WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)),
docs AS (SELECT l, count(*) AS docs FROM good WHERE l IS NOT NULL GROUP BY l),
rc AS (SELECT l, i, avg(chars[i] / n_chars) AS q FROM good CROSS JOIN range(1, {n + 1}) r(i) GROUP BY l, i),
bins AS (SELECT id, w, count(*) AS n FROM (SELECT id, unnest(found) AS w FROM m) GROUP BY id, w),
rw AS (SELECT l, w, sum(n / n_words) / any_value(docs.docs) AS q FROM good JOIN bins USING (id) JOIN docs USING (l) GROUP BY l, w),
rest AS (SELECT l, 1 - coalesce(sum(q), 0) AS q FROM docs LEFT JOIN rw USING (l) GROUP BY l),
placed AS (SELECT m.*, CASE WHEN lang IN (SELECT l FROM docs) THEN lang ELSE '*' END AS l FROM m),
cd AS (SELECT id, sqrt(greatest(sum({term}) / 2, 0)) AS d FROM
  (SELECT id, chars[i] / n_chars AS p, q FROM placed JOIN rc USING (l) WHERE n_chars >= {quality.MIN_CHARS}) GROUP BY id),
wp AS (SELECT id, w, coalesce(n, 0) / n_words AS p, coalesce(q, 0) AS q FROM
  (SELECT placed.id, w, q, n_words FROM placed JOIN rw USING (l)
   UNION ALL SELECT id, w, 0, n_words FROM placed JOIN bins USING (id) WHERE NOT EXISTS (SELECT 1 FROM rw WHERE rw.l = placed.l AND rw.w = bins.w)) e
  LEFT JOIN bins USING (id, w) WHERE n_words >= {quality.MIN_COMMON_WORDS}
  UNION ALL SELECT id, NULL, 1 - len(found) / n_words, q FROM placed JOIN rest USING (l) WHERE n_words >= {quality.MIN_COMMON_WORDS}),
wd AS (SELECT id, sqrt(greatest(sum({term}) / 2, 0)) AS d FROM wp GROUP BY id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(cd.d > {quality.FAR_CHARS} OR (cd.d > {quality.ODD_CHARS} AND wd.d > {quality.ODD_WORDS}), false) AS kept
FROM m LEFT JOIN cd USING (id) LEFT JOIN wd USING (id)
"""


def chat_format(planted: str) -> str:
    escaped = lambda x: rf"replace(replace({x}, '\', '\\'), '<|', '<\|')"
    marks = len(chat.TURN + chat.TEXT + chat.END)
    return f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '{planted}' UNION ALL SELECT -7, 1, 'assistant', '{planted}')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({marks} + length({escaped("role")}) + length({escaped("text")}))::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


def url_trust(rules: list[trust.Rule]) -> str:
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = lambda r: f"(host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}')"
    case = lambda value: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{value(r)}'" for r in longest) + " END"

    def scores(name: str, seed: str, edges: str) -> str:
        """Far more rounds than scores need to settle; an edge of weight 0 keeps each host in them."""
        return f"""{name}_edges AS (SELECT src, dst, weight FROM {edges} UNION ALL SELECT host, host, 0 FROM nodes),
{name}(round, host, score) AS (SELECT 0, host, {seed} FROM nodes UNION ALL
  SELECT round + 1, dst, any_value({seed}) + {trust.DAMPING} * sum(weight * score) FROM {name} JOIN {name}_edges ON src = {name}.host JOIN nodes ON nodes.host = dst
  WHERE round < {SETTLED} GROUP BY round, dst)"""

    return rf"""
WITH RECURSIVE placed AS (
  SELECT page_id, html, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{trust.ASCII_UPPER}', '{trust.ASCII_UPPER.lower()}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
ruled AS (SELECT *, {case(lambda r: r[1] + r[2])} AS rule, {case(lambda r: r[0])} AS said FROM placed),
shares AS (SELECT host, avg((coalesce(said, '') = 'allow')::INT) AS trusted, avg((coalesce(said, '') = 'block')::INT) AS blocked FROM ruled WHERE host <> '' GROUP BY host),
links AS (SELECT host AS src, unnest(regexp_extract_all(html, '(?i)\bhref\s*=\s*["'']?\s*((?:https?:)?//[^\s"''>]+)', 1)) AS link FROM placed WHERE host <> ''),
ends AS (SELECT src, translate(regexp_extract(link, '^.*?//([^/?#]*)', 1), '{trust.ASCII_UPPER}', '{trust.ASCII_UPPER.lower()}') AS dst FROM links),
counted AS (SELECT src, dst, count(*) AS n FROM ends WHERE dst <> '' AND src <> dst GROUP BY src, dst),
edges AS (SELECT src, dst, n / sum(n) OVER (PARTITION BY src) AS weight FROM counted),
back AS (SELECT dst AS src, src AS dst, weight / sum(weight) OVER (PARTITION BY dst) AS weight FROM edges),
names AS (SELECT host FROM shares UNION SELECT src FROM edges UNION SELECT dst FROM edges),
nodes AS (SELECT host, coalesce(trusted, 0)::DOUBLE AS trusted, coalesce(blocked, 0)::DOUBLE AS blocked FROM names LEFT JOIN shares USING (host)),
{scores("t", "trusted", "edges")},
{scores("d", "blocked", "back")},
suspects AS (SELECT t.host FROM t JOIN d USING (host, round) WHERE round = {SETTLED} AND d.score > greatest(t.score, {trust.THRESHOLD}))
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN host IN (SELECT host FROM suspects) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled
"""


def warc() -> str:
    return f"""
WITH rows AS (SELECT page_id, strlen(coalesce(html, '')) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
same AS (SELECT digest, max(page_id) AS holder FROM rows WHERE bytes >= {archives.MIN_REVISIT_BYTES} GROUP BY digest HAVING count(*) > 1),
held AS (SELECT rows.*, CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to FROM rows LEFT JOIN same USING (digest))
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to FROM held
"""


#: Digest of nothing.
_NO_TEXT = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def conversation_repair() -> str:
    """The best (cost, letters) behind each row and last role, row by row, letters as strings."""
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    gaps = [(r, r, 0, "") for r in after]
    gaps += [(r, after[r], 3, "I") for r in after] + [(r, after[after[r]], 6, "II") for r in after]
    kept = [("", "s", "s"), *((r, after[r], after[r]) for r in after)]
    values = lambda rows: ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)
    return rf"""
WITH RECURSIVE plain AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
checked AS (SELECT name, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT)),
  lambda r, b: list_reduce(list_prepend(xor(r, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda x, _: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS fate FROM (SELECT DISTINCT name FROM plain)),
hurt AS (SELECT conv_id, turn, CASE fate WHEN 4 THEN 'user' ELSE role END AS role,
  CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM plain JOIN checked USING (name), range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
convs AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
placed AS (SELECT c, turn, role, text, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS pos FROM hurt JOIN convs ON hurt.conv_id IS NOT DISTINCT FROM convs.conv_id),
told AS (SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) AS ending,
  row_number() OVER (PARTITION BY c, role, text ORDER BY pos) AS copy, lead(left(role, 1)) OVER (PARTITION BY c ORDER BY pos) AS next FROM placed),
judged AS MATERIALIZED (SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN copy > 1 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM told),
gap(a, b, gap_cost, gap_letters) AS (VALUES {values(gaps)}),
stay(a, b, role) AS (VALUES {values(kept)}),
turns(a, b) AS (VALUES {values(after.items())}),
moves AS MATERIALIZED (
  SELECT c, pos, v.r AS a, v.r AS b, 4 AS cost, 'D' AS letter FROM judged, (VALUES (''), ('s'), ('u'), ('a')) v(r)
  UNION ALL SELECT c, pos, a, b, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END, 'K' FROM judged JOIN stay ON stay.role = initial WHERE fault IN ('', 'truncated')
  UNION ALL SELECT c, pos, a, b, CASE fault WHEN 'truncated' THEN 6 ELSE 3 END, 'R' FROM judged CROSS JOIN turns WHERE fault IN ('', 'truncated')),
best(c, pos, state, path) AS (
  SELECT c, 0::BIGINT, '', {{'cost': 0, 'letters': ''}} FROM (SELECT DISTINCT c FROM judged)
  UNION ALL
  SELECT best.c, best.pos + 1, moves.b, min({{'cost': path.cost + gap_cost + moves.cost, 'letters': path.letters || gap_letters || letter}})
  FROM best JOIN gap ON gap.a = best.state JOIN moves ON moves.c = best.c AND moves.pos = best.pos + 1 AND moves.a = gap.b
  GROUP BY best.c, best.pos, moves.b),
lengths AS (SELECT c, max(pos) AS n FROM judged GROUP BY c),
chosen AS (SELECT best.c, min({{'cost': path.cost + gap_cost, 'letters': path.letters || gap_letters}}) AS path
  FROM best JOIN lengths ON lengths.c = best.c AND lengths.n = best.pos JOIN gap ON gap.a = best.state AND gap.b IN ('', 'a') GROUP BY best.c),
letters AS (SELECT c, unnest(range(1, length(path.letters) + 1)) AS i, path.letters AS audit FROM chosen),
spelt AS (SELECT c, i, audit[i] AS letter, length(replace(audit, 'D', '')) % 2 AS odd,
  length(replace(audit[1:i], 'I', '')) AS pos, length(replace(audit[1:i - 1], 'D', '')) AS nth FROM letters),
lines AS (SELECT spelt.c, i, CASE letter WHEN 'K' THEN judged.role ELSE CASE WHEN nth % 2 = odd THEN 'user' WHEN nth < odd THEN 'system' ELSE 'assistant' END END || ':' ||
  CASE letter WHEN 'I' THEN '' ELSE judged.text END AS line FROM spelt LEFT JOIN judged ON judged.c = spelt.c AND judged.pos = spelt.pos WHERE letter <> 'D'),
digests AS (SELECT c, sha256(string_agg(line, chr(10) ORDER BY i)) AS digest FROM lines GROUP BY c),
facts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (next IS NOT NULL AND initial || next NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(path.cost, 0)::BIGINT AS cost, coalesce(path.letters, '') AS audit, coalesce(digest, '{_NO_TEXT}') AS repaired_sha256
FROM convs LEFT JOIN facts USING (c) LEFT JOIN chosen USING (c) LEFT JOIN digests USING (c)
"""


def mixing() -> str:
    """Sources in order of the level at which they are full; the level is the first that fits behind those."""
    known = lambda c: f"coalesce(md5({c}), '')"
    weights = ", ".join(f"({i}, {w})" for i, w in enumerate(mixes.WEIGHTS))
    coin = f"('0x' || substr(md5('{mixes.SEED}:' || key || ':' || number), 1, {mixes.COIN_DIGITS}))::BIGINT::DOUBLE / {float(16**mixes.COIN_DIGITS)!r}"
    return rf"""
WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS size,
  md5(coalesce(doc_id::VARCHAR, '') || ':' || {known("source")} || ':' || {known("text")}) AS key FROM documents),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key) - 1 AS number FROM rows),
sums AS (SELECT source, sum(size)::BIGINT AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM rows GROUP BY source),
sources AS (SELECT source, words, weight, {mixes.MOST} * words / weight AS full_at FROM sums JOIN (VALUES {weights}) v(i, weight) ON i = rank % {len(mixes.WEIGHTS)}),
tried AS (SELECT full_at, ({mixes.SHARE} * sum(words) OVER () - {mixes.MOST} * coalesce(sum(words) OVER below, 0)) / sum(weight) OVER above AS level
  FROM sources WINDOW below AS (ORDER BY full_at, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), above AS (ORDER BY full_at, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
targets AS (SELECT source, words, least({mixes.MOST} * words, (SELECT min_by(level, full_at) FROM tried WHERE level <= full_at) * weight) AS target FROM sources),
rated AS (SELECT numbered.*, words, target, CASE WHEN words > 0 THEN target / words ELSE 0 END AS rate FROM numbered JOIN targets ON numbered.source IS NOT DISTINCT FROM targets.source)
SELECT doc_id, size, words AS source_size, target, (size * (floor(rate) + ({coin} < rate - floor(rate))::INT))::BIGINT AS taken FROM rated
"""


def vector_codes() -> str:
    """All distances to all entries, round by round."""
    first = f"""
kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id, label, list_transform(embedding, lambda x: floor({codes.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT id, p, list_slice(v, p * len(v) // {codes.PARTS} + 1, (p + 1) * len(v) // {codes.PARTS}) AS x FROM kept, range({codes.PARTS}) r(p)),
heads AS (SELECT vec_id, min(v) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS e FROM kept GROUP BY vec_id),
b0 AS MATERIALIZED (SELECT p, e, list_slice(v, p * len(v) // {codes.PARTS} + 1, (p + 1) * len(v) // {codes.PARTS}) AS y FROM heads, range({codes.PARTS}) r(p) WHERE e < {codes.ENTRIES})"""
    steps = [first]
    for i in range(codes.ROUNDS + 1):
        square = "list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
        steps.append(f"a{i} AS MATERIALIZED (SELECT id, p, min({{'d': {square}, 'e': e}}) AS best FROM parts JOIN b{i} USING (p) GROUP BY id, p)")
        if i < codes.ROUNDS:
            steps.append(
                f"""s{i} AS (SELECT p, e, i, sum(z) AS s, count(*) AS n FROM (SELECT p, best.e AS e, unnest(x) AS z, unnest(range(len(x))) AS i FROM a{i} JOIN parts USING (id, p)) GROUP BY p, e, i),
m{i} AS (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS y FROM s{i} GROUP BY p, e),
b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(m{i}.y, b{i}.y) AS y FROM b{i} LEFT JOIN m{i} USING (p, e))"""
            )
    last = codes.ROUNDS
    return f"""
WITH {", ".join(steps)},
coded AS (SELECT id, string_agg(lpad(lower(hex(best.e)), 2, '0'), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{last} GROUP BY id),
digest AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{last})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256 FROM kept JOIN coded USING (id), digest
"""

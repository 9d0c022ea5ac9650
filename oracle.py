"""DuckDB statements that state the registered queries independently, over whole tables."""

from __future__ import annotations

KEEP = 0.8
CHUNK = 126
DIM = 64
POINTS = [round(0.05 * i, 2) for i in range(1, 20)]

# Label means of unit length: (cid, centroid).
CENTROIDS = """
parts AS (SELECT label AS cid, vec_id, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
means AS (SELECT cid, pos, avg(x) AS m FROM parts GROUP BY cid, pos),
norms AS (SELECT cid, sqrt(sum(m * m)) AS n FROM means GROUP BY cid),
centroids AS (SELECT means.cid, list(m / n ORDER BY pos) AS centroid FROM means JOIN norms USING (cid) GROUP BY means.cid)
"""

# Every vector with its nearest centroid: (vec_id, cid, dot).
NEAREST = f"""
{CENTROIDS},
ranked AS (
  SELECT e.vec_id, e.embedding, c.cid, list_dot_product(e.embedding::DOUBLE[], c.centroid) AS dot,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY list_dot_product(e.embedding::DOUBLE[], c.centroid) DESC, c.cid) AS place
  FROM embeddings e CROSS JOIN centroids c
),
nearest AS (SELECT vec_id, embedding, cid, dot FROM ranked WHERE place = 1)
"""


# Every vector three times, with components shifted by turns.
KMEANS_ALL = """SELECT vec_id * 3 + c AS vec_id,
  list_transform(embedding, lambda x, i: (x::DOUBLE * (1 + (CASE WHEN (i - 1) % 3 = c THEN 0.5 ELSE 0 END)))::FLOAT) AS embedding FROM embeddings CROSS JOIN range(3) r(c)"""


def members(name: str, source: str, cid: str) -> str:
    return f"""
{name} AS (SELECT {cid} AS cid, row_number() OVER (PARTITION BY {cid} ORDER BY vec_id) - 1 AS ord, vec_id AS uid,
           embedding::DOUBLE[] AS v FROM {source})
"""


def scores(name: str, source: str) -> str:
    return f"""
{name} AS (SELECT b.cid, b.ord, b.uid, greatest(0::DOUBLE, coalesce(max(list_dot_product(a.v, b.v)), 0::DOUBLE)) AS sim
           FROM {source} b LEFT JOIN {source} a ON a.cid = b.cid AND a.ord < b.ord GROUP BY b.cid, b.ord, b.uid)
"""


LABELLED = members("labelled", "embeddings", "label")
LABEL_SCORES = f"{LABELLED}, {scores('sims', 'labelled')}"
NEAREST_SCORES = f"{NEAREST}, {members('near_members', 'nearest', 'cid')}, {scores('near_sims', 'near_members')}"
SHARDED = f"""
{LABEL_SCORES}, {NEAREST_SCORES},
sharded AS (SELECT 'a_label' AS shard, uid, ord, sim FROM sims UNION ALL SELECT 'b_nearest', uid, ord, sim FROM near_sims)
"""
POINT_TABLE = "points AS (SELECT unnest([" + ", ".join(f"{q}::DOUBLE" for q in POINTS) + "]) AS q)"


def quantile_rows(source: str, group: str = "") -> str:
    """(group, q, value) with one quantile_cont per point."""
    rows = []
    for q in POINTS:
        by = f"{group}, " if group else ""
        tail = f" GROUP BY {group}" if group else ""
        rows.append(f"SELECT {by}{q}::DOUBLE AS q, quantile_cont(sim, {q}) AS value FROM {source}{tail}")
    return " UNION ALL ".join(rows)


LIMIT = f"lim AS (SELECT quantile_cont(sim, {KEEP}) AS t FROM sims)"
JUDGED = f"""
{LABEL_SCORES}, {LIMIT},
judged AS (
  SELECT d.doc_id, d.source, length(d.text) AS len,
         CASE WHEN s.uid IS NULL THEN 'not_found' WHEN s.sim < lim.t THEN 'kept' ELSE 'removed' END AS status
  FROM documents d LEFT JOIN sims s ON s.uid = d.doc_id CROSS JOIN lim
)
"""
MERGED_LIMIT = f"""
per_shard AS (SELECT shard, count(DISTINCT uid) AS n, quantile_cont(sim, {KEEP}) AS value FROM sharded GROUP BY shard),
lim AS (SELECT sum(value * n) / sum(n) AS t FROM per_shard)
"""
KEPT = f"{SHARDED}, {MERGED_LIMIT}, kept AS (SELECT DISTINCT uid FROM sharded, lim WHERE sim < t)"

SHARD_ROWS = """
shard_rows AS (SELECT 'shard_' || (vec_id % 4) AS shard, vec_id AS uid, label AS cid, embedding,
               row_number() OVER (PARTITION BY vec_id % 4 ORDER BY vec_id) - 1 AS idx FROM embeddings)
"""
SUBSETS = """
bounds AS (SELECT i AS subset, floor(i * (10::DOUBLE / 4))::BIGINT AS low,
           CASE WHEN i = 3 THEN 10 ELSE floor((i + 1) * (10::DOUBLE / 4))::BIGINT END AS high FROM range(4) r(i)),
placed AS (SELECT b.subset::INT AS subset, s.shard, s.cid, s.uid,
           row_number() OVER (PARTITION BY b.subset, s.shard ORDER BY s.cid, s.uid) - 1 AS pos,
           row_number() OVER (PARTITION BY b.subset ORDER BY s.shard, s.cid, s.uid) - 1 AS subset_idx
           FROM shard_rows s JOIN bounds b ON s.cid >= b.low AND s.cid < b.high)
"""
TOKENS = r"tokens AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda t: t <> '') AS words FROM documents)"


def chunk_rows(size: int, head: str = "", tail: str = "") -> str:
    """Chunks of ``size`` words, framed by text before and after."""
    extra = len(f"{head} {tail}".split())
    return f"""
WITH {TOKENS},
cut AS (SELECT doc_id, words, unnest(range(greatest(1, ceil(len(words) / {size}.0)::BIGINT))) AS chunk FROM tokens),
pieces AS (SELECT doc_id, chunk, list_slice(words, chunk * {size} + 1, (chunk + 1) * {size}) AS part FROM cut)
SELECT doc_id AS uid, chunk::INT AS chunk, (len(part) + {extra})::INT AS n_tokens,
       md5(trim('{head}' || CASE WHEN len(part) > 0 THEN ' ' || array_to_string(part, ' ') ELSE '' END || ' {tail}', ' ')) AS digest
FROM pieces
"""


CHUNK_COUNTS = f"""
{TOKENS},
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM tokens),
buckets AS (SELECT doc_id, (place // {CHUNK})::INT AS chunk, (('0x' || substr(md5(word), 1, 8))::BIGINT % {DIM})::INT AS pos,
            count(*) AS n FROM words GROUP BY ALL),
sizes AS (SELECT doc_id, chunk, sum(n) AS total FROM buckets GROUP BY doc_id, chunk),
chunk_vec AS (SELECT b.doc_id, b.chunk, b.pos, b.n / s.total::DOUBLE AS value FROM buckets b JOIN sizes s USING (doc_id, chunk)),
n_chunks AS (SELECT doc_id, greatest(1, ceil(len(words) / {CHUNK}.0))::BIGINT AS n_chunks FROM tokens),
doc_vec AS (SELECT v.doc_id, v.pos, sum(v.value) / max(n_chunks) AS value FROM chunk_vec v JOIN n_chunks USING (doc_id) GROUP BY v.doc_id, v.pos)
"""


def kmeans(k: int, n_iter: int, seed: int, source: str = "embeddings") -> str:
    """Spherical k-means over all rows: hash-ordered start, then assign / mean / normalise."""

    def hashed(key: int) -> str:
        return f"('0x' || substr(md5(vec_id || ':{key}'), 1, 15))::BIGINT"

    parts = [
        f"sample AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM ({source}))",
        f"c0 AS (SELECT row_number() OVER (ORDER BY {hashed(seed + 1)}) - 1 AS cid, "
        f"list_transform(v, lambda x: x / sqrt(list_dot_product(v, v))) AS c FROM (SELECT * FROM sample ORDER BY {hashed(seed + 1)} LIMIT {k}))",
    ]
    for i in range(n_iter):
        parts += [
            f"near{i} AS (SELECT vec_id, v, arg_max(cid, list_dot_product(v, c)) AS cid FROM sample CROSS JOIN c{i} GROUP BY vec_id, v)",
            f"sum{i} AS (SELECT cid, pos, sum(x) AS x FROM (SELECT cid, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM near{i}) GROUP BY cid, pos)",
            f"len{i} AS (SELECT cid, sqrt(sum(x * x)) AS n FROM sum{i} GROUP BY cid)",
            f"c{i + 1} AS (SELECT sum{i}.cid, list(x / n ORDER BY pos) AS c FROM sum{i} JOIN len{i} USING (cid) GROUP BY sum{i}.cid)",
        ]
    long = f"SELECT cid::INT AS cid, unnest(c) AS x, (generate_subscripts(c, 1) - 1)::INT AS pos FROM c{n_iter}"
    return f"WITH {', '.join(parts)} SELECT cid, pos, round(x::FLOAT::DOUBLE, 5) AS value FROM ({long})"


def statements() -> dict[str, str]:
    stated = {
        "semantic_prune": f"""
WITH {NEAREST_SCORES}, lim AS (SELECT quantile_cont(sim, {KEEP}) AS t FROM near_sims)
SELECT d.doc_id, d.lang, d.source, d.n_chars FROM documents d JOIN near_sims s ON s.uid = d.doc_id CROSS JOIN lim WHERE s.sim < lim.t
""",
        "l2_normalize": """
WITH scaled AS (SELECT vec_id AS uid, list_transform(embedding, lambda x: x::DOUBLE * (label + 1)) AS v FROM embeddings),
normed AS (SELECT uid, v, sqrt(list_dot_product(v, v)) AS n FROM scaled),
long AS (SELECT uid, n, unnest(v) AS x, generate_subscripts(v, 1) - 1 AS pos FROM normed)
SELECT uid, pos::INT AS pos, round(x / greatest(n, 1e-12), 6) AS value FROM long
""",
        "zero_vectors": """
SELECT label AS cid, count(*) AS n, count(*) FILTER (len(list_filter(embedding, lambda x: x <> 0)) = 0) AS n_zero
FROM embeddings GROUP BY label
""",
        "assign_nearest": f"WITH {NEAREST} SELECT vec_id AS uid, cid, round(dot, 6) AS centroid_sim FROM nearest",
        "assign_nearest_blocks": f"WITH {NEAREST} SELECT vec_id AS uid, cid, round(dot, 6) AS centroid_sim FROM nearest",
        "assign_nearest_repeated": f"WITH {NEAREST} SELECT vec_id % 5 AS uid, cid, round(dot, 6) AS centroid_sim FROM nearest",
        "assign_indexed": f"WITH {NEAREST} SELECT vec_id AS uid, cid, round(dot, 6) AS centroid_sim FROM nearest",
        "cluster_members": f"WITH {LABELLED} SELECT cid, ord, uid AS idx, uid FROM labelled",
        "cluster_sizes": """
WITH known AS (SELECT DISTINCT label AS cid FROM embeddings),
every AS (SELECT cid FROM known UNION SELECT cid + 5 FROM known)
SELECT every.cid::INT AS cid, count(e.vec_id) AS n_members FROM every LEFT JOIN embeddings e ON e.label = every.cid GROUP BY every.cid
""",
        "cluster_lists": f"""
WITH {LABELLED}
SELECT cid, ord // 16 AS page, string_agg(uid::VARCHAR, ',' ORDER BY ord) AS inds, string_agg(uid::VARCHAR, ',' ORDER BY ord) AS labels
FROM labelled GROUP BY cid, ord // 16
""",
        "member_uids": f"WITH {LABELLED} SELECT cid, ord, uid AS idx, 'doc-' || uid AS uid FROM labelled",
        "rank_in_cluster_cosine": f"""
WITH {CENTROIDS},
near AS (SELECT label AS cid, vec_id AS uid, 1 - list_dot_product(embedding::DOUBLE[], centroid) AS d
         FROM embeddings JOIN centroids ON centroids.cid = label)
SELECT cid, uid, round(d, 6) AS distance, row_number() OVER (PARTITION BY cid ORDER BY d DESC, uid) AS rank FROM near
""",
        "rank_in_cluster_l2": f"""
WITH {CENTROIDS},
near AS (SELECT label AS cid, vec_id AS uid, pow(list_distance(embedding::DOUBLE[], centroid), 2) AS d
         FROM embeddings JOIN centroids ON centroids.cid = label)
SELECT cid, uid, round(d, 6) AS distance, row_number() OVER (PARTITION BY cid ORDER BY d, uid) AS rank FROM near
""",
        "lloyd_step": f"""
WITH {NEAREST},
long AS (SELECT cid, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM nearest),
moved AS (SELECT cid, pos, avg(x) AS m FROM long GROUP BY cid, pos),
size AS (SELECT cid, sqrt(sum(m * m)) AS n FROM moved GROUP BY cid)
SELECT moved.cid, pos::INT AS pos, round(m / n, 6) AS value FROM moved JOIN size USING (cid)
""",
        "train_subsample": """
SELECT vec_id AS uid FROM embeddings ORDER BY ('0x' || substr(md5(vec_id || ':1234'), 1, 15))::BIGINT LIMIT 160
""",
        "kmeans_fit": kmeans(10, 5, 1234, "SELECT vec_id, embedding FROM embeddings"),
        "kmeans_fit_bounds": kmeans(10, 5, 1234, "SELECT vec_id, embedding FROM embeddings"),
        "kmeans_fit_all": kmeans(4, 4, 1234, KMEANS_ALL),
        "kmeans_assign_saved": f"WITH {NEAREST} SELECT cid, count(*) AS n FROM nearest GROUP BY cid",
        "max_similarity": f"WITH {LABEL_SCORES} SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims",
        "max_similarity_tiles": f"WITH {LABEL_SCORES} SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims",
        "max_similarity_colocated": f"WITH {LABEL_SCORES} SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims",
        "max_similarity_pruned": f"WITH {LABEL_SCORES} SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims",
        "max_similarity_by_shard": f"""
WITH twice AS (SELECT vec_id * 2 + a AS uid, label AS cid, embedding::DOUBLE[] AS v, CASE a WHEN 0 THEN vec_id % 4 ELSE 4 END AS shard FROM embeddings CROSS JOIN range(2) r(a)),
labelled AS (SELECT cid, row_number() OVER (PARTITION BY cid ORDER BY shard, uid) - 1 AS ord, uid, v FROM twice), {scores("sims", "labelled")}
SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims
""",
        "max_similarity_copies": f"""
WITH tripled AS (SELECT vec_id * 3 + c AS vec_id, label, embedding FROM embeddings CROSS JOIN range(3) r(c)),
{members("labelled", "tripled", "label")}, {scores("sims", "labelled")}
SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims
""",
        "max_similarity_scaled": f"""
WITH tripled AS (SELECT vec_id + 100000 * c AS vec_id, label, list_transform(embedding, lambda x: (x::DOUBLE * (vec_id % 7))::FLOAT) AS embedding FROM embeddings CROSS JOIN range(3) r(c)),
{members("labelled", "tripled", "label % 3")}, {scores("sims", "labelled")}
SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims
""",
        "similarity_first_n": f"WITH {LABEL_SCORES} SELECT cid, ord, uid, round(sim, 6) AS sim FROM sims WHERE cid < 5",
        "similarity_quantiles": f"""
WITH {LABEL_SCORES}, rows AS ({quantile_rows("sims")}) SELECT q, round(value, 6) AS value FROM rows
""",
        "keep_flags": f"""
WITH {LABEL_SCORES},
t AS (SELECT quantile_cont(sim, 0.25) AS a, quantile_cont(sim, 0.5) AS b, quantile_cont(sim, 0.8) AS c FROM sims)
SELECT uid, sim < a AS keep_0pt25, sim < b AS keep_0pt5, sim < c AS keep_0pt8 FROM sims CROSS JOIN t
""",
        "prune_documents": f"""
WITH {JUDGED} SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM judged WHERE status = 'kept')
""",
        "prune_stats": f"""
WITH {JUDGED}
SELECT count(*) FILTER (status = 'kept') AS n_samples, round(avg(len) FILTER (status = 'kept'), 6) AS mean_length,
       count(*) FILTER (status <> 'not_found') AS found, count(*) FILTER (status = 'not_found') AS not_found,
       count(*) FILTER (doc_id IS NULL) AS no_uid, count(*) FILTER (status = 'removed') AS removed
FROM judged
""",
        "prune_stats_written": f"""
WITH {JUDGED}
SELECT count(*) FILTER (status = 'kept') AS n_samples, round(avg(len) FILTER (status = 'kept'), 6) AS mean_length,
       count(*) FILTER (status <> 'not_found') AS found, count(*) FILTER (status = 'not_found') AS not_found,
       count(*) FILTER (doc_id IS NULL) AS no_uid, count(*) FILTER (status = 'removed') AS removed
FROM judged
""",
        "prune_stats_by_source": f"""
WITH {JUDGED} SELECT source, count(*) AS n_samples, round(avg(len), 6) AS mean_length FROM judged WHERE status = 'kept' GROUP BY source
""",
        "prune_not_found": f"WITH {JUDGED} SELECT doc_id, source FROM judged WHERE status = 'not_found'",
        "prune_text_similarity": f"""
WITH {LABEL_SCORES}, {LIMIT},
stored AS (SELECT uid, CASE WHEN ord = 0 THEN NULL ELSE sim END AS sim FROM sims),
fates AS (SELECT CASE WHEN s.sim IS NULL THEN 'not_found' WHEN s.sim < lim.t THEN 'kept' ELSE 'removed' END AS status
          FROM documents d LEFT JOIN stored s ON s.uid = d.doc_id CROSS JOIN lim)
SELECT status, count(*) AS n FROM fates GROUP BY status
""",
        "prune_kept_set": f"WITH {KEPT} SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT uid FROM kept)",
        "prune_outside_set": f"WITH {KEPT} SELECT doc_id, source, n_chars FROM documents WHERE doc_id NOT IN (SELECT uid FROM kept)",
        "prune_set_stats": f"""
WITH {KEPT}, marked AS (SELECT doc_id, length(text) AS len, doc_id IN (SELECT uid FROM kept) AS inside FROM documents)
SELECT count(*) FILTER (inside) AS n_samples, round(avg(len) FILTER (inside), 6) AS mean_length, count(*) AS found,
       count(*) FILTER (NOT inside) AS not_found, count(*) FILTER (doc_id IS NULL) AS no_uid, count(*) FILTER (NOT inside) AS removed
FROM marked
""",
        "write_pruned": f"""
WITH {JUDGED} SELECT doc_id, text, lang, source, n_chars FROM documents WHERE doc_id IN (SELECT doc_id FROM judged WHERE status = 'kept')
""",
        "shard_offsets": """
WITH sizes AS (SELECT 'shard_' || (vec_id % 4) AS shard, count(*) AS n FROM embeddings GROUP BY ALL)
SELECT shard, n, coalesce(sum(n) OVER (ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM sizes
""",
        "merge_embeddings": f"""
WITH {SHARD_ROWS}
SELECT shard, row_number() OVER (ORDER BY shard, idx) - 1 AS idx, uid, round(list_sum(embedding::DOUBLE[]), 6) AS total FROM shard_rows
""",
        "merge_cluster_labels": f"""
WITH {SHARD_ROWS} SELECT cid, row_number() OVER (PARTITION BY cid ORDER BY shard, uid) - 1 AS ord, shard, uid FROM shard_rows
""",
        "cluster_subsets": """
WITH n AS (SELECT count(*) AS n FROM embeddings),
bounds AS (SELECT i AS subset, floor(i * (n::DOUBLE / 49))::BIGINT AS low,
           CASE WHEN i = 48 THEN n ELSE floor((i + 1) * (n::DOUBLE / 49))::BIGINT END AS high FROM range(49) r(i), n),
numbered AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS cid FROM embeddings)
SELECT cid, subset::INT AS subset FROM numbered JOIN bounds ON cid >= low AND cid < high
""",
        "select_members": f"""
WITH {SHARD_ROWS} SELECT s.shard, s.cid, s.idx, s.uid, d.source FROM shard_rows s JOIN documents d ON d.doc_id = s.uid
""",
        "subset_positions": f"WITH {SHARD_ROWS}, {SUBSETS} SELECT subset, shard, cid, uid, pos FROM placed",
        "regroup_members": f"WITH {SHARD_ROWS}, {SUBSETS} SELECT subset, cid, subset_idx, uid FROM placed",
        "subset_sizes": f"WITH {SHARD_ROWS}, {SUBSETS} SELECT subset, shard, count(*) AS n FROM placed GROUP BY subset, shard",
        "subset_shard_offsets": f"""
WITH {SHARD_ROWS}, {SUBSETS}, sizes AS (SELECT subset, shard, count(*) AS n FROM placed GROUP BY subset, shard)
SELECT subset, shard, n, coalesce(sum(n) OVER (PARTITION BY subset ORDER BY shard ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT
       AS "offset" FROM sizes
""",
        "read_shards": f"WITH {SHARDED} SELECT shard, count(*) AS n, round(sum(sim), 4) AS total FROM sharded GROUP BY shard",
        "read_matrix": """
WITH long AS (SELECT vec_id AS idx, unnest(embedding::DOUBLE[]) AS x, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)
SELECT idx, pos::INT AS pos, round(x, 6) AS value FROM long
""",
        "prune_string_uids": f"""
WITH {LABEL_SCORES}, {LIMIT}
SELECT d.doc_id, d.source, d.n_chars FROM documents d JOIN sims s ON s.uid = d.doc_id CROSS JOIN lim WHERE s.sim < lim.t
""",
        "prune_flags": f"""
WITH {LABEL_SCORES}, {LIMIT}
SELECT d.doc_id, d.source, d.n_chars FROM documents d JOIN sims s ON s.uid = d.doc_id CROSS JOIN lim WHERE s.sim < lim.t
""",
        "prune_repeated_uids": f"""
WITH {LABEL_SCORES}, {LIMIT},
ranked AS (SELECT 'src' || (uid % 20) AS name, sim, row_number() OVER (PARTITION BY uid % 20 ORDER BY cid DESC, ord DESC, sim DESC) AS place FROM sims)
SELECT d.doc_id, d.source, d.n_chars FROM documents d JOIN ranked ON name = d.source AND place = 1 CROSS JOIN lim WHERE sim < lim.t
""",
        "read_documents_index": """
SELECT row_number() OVER (ORDER BY doc_id) - 1 AS idx, doc_id, length(text)::INT AS length FROM documents WHERE lang = 'en'
""",
        "quantiles_of_copies": f"""
WITH tripled AS (SELECT vec_id * 3 + c AS vec_id, label, embedding FROM embeddings CROSS JOIN range(3) r(c)),
{members("labelled", "tripled", "label")}, {scores("sims", "labelled")},
found AS (SELECT unnest({POINTS}) AS q, unnest(quantile_cont(sim, {POINTS})) AS value FROM sims)
SELECT q::DOUBLE AS q, round(value, 6) AS value FROM found
""",
        "quantiles_of_lengths": f"""
WITH found AS (SELECT unnest({POINTS}) AS q, unnest(quantile_cont(n_chars::DOUBLE, {POINTS})) AS value FROM documents)
SELECT q::DOUBLE AS q, round(value, 6) AS value FROM found
""",
        "sharded_pipeline": f"""
WITH {CENTROIDS},
ranked AS (SELECT e.vec_id, e.embedding, c.cid, row_number() OVER (PARTITION BY e.vec_id ORDER BY list_dot_product(e.embedding::DOUBLE[], c.centroid) DESC, c.cid) AS place
           FROM embeddings e CROSS JOIN centroids c),
placed AS (SELECT vec_id % 2 AS shard, cid, vec_id, embedding::DOUBLE[] AS v FROM ranked WHERE place = 1),
merged AS (SELECT vec_id, row_number() OVER (PARTITION BY cid ORDER BY shard, vec_id) - 1 AS ord FROM placed),
sims AS (SELECT b.vec_id, b.shard, b.cid, greatest(0, coalesce(max(list_dot_product(a.v, b.v)), 0)) AS sim FROM placed b
         LEFT JOIN placed a ON a.shard = b.shard AND a.cid = b.cid AND a.vec_id < b.vec_id GROUP BY b.vec_id, b.shard, b.cid)
SELECT cid, merged.ord, vec_id AS uid, round(sim, 6) AS sim FROM sims JOIN merged USING (vec_id)
""",
        "merged_quantiles": f"""
WITH {SHARDED}, sizes AS (SELECT shard, count(DISTINCT uid) AS n FROM sharded GROUP BY shard),
rows AS ({quantile_rows("sharded", "shard")})
SELECT q, round(sum(value * n) / sum(n), 6) AS value FROM rows JOIN sizes USING (shard) GROUP BY q
""",
        "merged_quantiles_exact": f"WITH {SHARDED}, rows AS ({quantile_rows('sharded')}) SELECT q, round(value, 6) AS value FROM rows",
        "sketch_quantiles": f"WITH {SHARDED}, rows AS ({quantile_rows('sharded')}) SELECT q, round(value, 6) AS value, true AS within FROM rows",
        "job_merge_threshold": f"WITH {SHARDED}, lim AS (SELECT quantile_cont(sim, {KEEP}) AS t FROM sharded) SELECT DISTINCT uid FROM sharded, lim WHERE sim < t",
        "kept_pages": f"WITH {KEPT} SELECT uid FROM kept",
        "kept_pages_counts": f"""
WITH {KEPT}
SELECT count(*) FILTER (sim < t) AS kept, count(*) FILTER (NOT sim < t) AS removed,
       round(count(*) FILTER (sim < t) / count(*), 6) AS kept_share, (SELECT count(*) FROM kept) AS distinct_kept FROM sharded, lim
""",
        "prune_to_pages": f"WITH {KEPT} SELECT doc_id, source, n_chars FROM documents WHERE doc_id IN (SELECT uid FROM kept)",
        "merge_similarities_last": f"WITH {SHARDED} SELECT uid, round(arg_max(sim, shard), 6) AS sim FROM sharded GROUP BY uid",
        "merge_similarities_max": f"WITH {SHARDED} SELECT uid, round(max(sim), 6) AS sim FROM sharded GROUP BY uid",
        "merge_threshold_kept": f"WITH {KEPT} SELECT uid FROM kept",
        "merge_threshold_counts": f"""
WITH {SHARDED}, {MERGED_LIMIT}
SELECT count(*) FILTER (sim < t) AS kept, count(*) FILTER (NOT sim < t) AS removed,
       round(count(*) FILTER (sim < t) / count(*), 6) AS kept_share FROM sharded, lim
""",
        "token_chunks": chunk_rows(CHUNK),
        "instruction_chunks": chunk_rows(CHUNK - 3, "[CLS] query:", "[SEP]"),
        "plugin_tokenizer": """
WITH cut AS (SELECT doc_id, text, unnest(range(greatest(1, ceil(length(text) / 1000.0)::BIGINT))) AS chunk FROM documents),
pieces AS (SELECT doc_id, chunk, substring(text, chunk * 1000 + 1, 1000) AS part FROM cut)
SELECT doc_id AS uid, chunk::INT AS chunk, length(part)::INT AS n_tokens,
       md5(array_to_string(string_split(part, ''), ' ')) AS digest FROM pieces
""",
        "chunk_counts": f"WITH {TOKENS} SELECT doc_id AS uid, greatest(1, ceil(len(words) / {CHUNK}.0))::BIGINT AS n_chunks FROM tokens",
        "char_chunks": """
WITH cut AS (SELECT doc_id, text, unnest(range(greatest(1, ceil(length(text) / 500.0)::BIGINT))) AS chunk FROM documents),
pieces AS (SELECT doc_id, chunk, substring(text, chunk * 500 + 1, 500) AS piece FROM cut)
SELECT doc_id AS uid, chunk::INT AS chunk, length(piece)::INT AS n_chars, md5(piece) AS digest FROM pieces
""",
        "hashed_embedding": f"""
WITH {CHUNK_COUNTS}, norms AS (SELECT doc_id, sqrt(sum(value * value)) AS n FROM doc_vec GROUP BY doc_id)
SELECT v.doc_id AS uid, n_chunks, pos, round((value / greatest(n, 1e-12))::FLOAT::DOUBLE, 5) AS value
FROM doc_vec v JOIN norms USING (doc_id) JOIN n_chunks USING (doc_id)
""",
        "chunk_vectors": f"WITH {CHUNK_COUNTS} SELECT doc_id AS uid, chunk, pos, round(value, 9) AS value FROM chunk_vec",
        "job_chunk": chunk_rows(CHUNK - 1, "query:"),
        "token_state_vectors": f"""
WITH {TOKENS},
words AS (SELECT doc_id, len(words) AS total, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM tokens),
spots AS (SELECT doc_id, (place // {CHUNK})::INT AS chunk, place % {CHUNK} AS spot, least({CHUNK}, total - place // {CHUNK} * {CHUNK}) AS n,
  (('0x' || substr(md5(word), 1, 8))::BIGINT % {DIM})::INT AS pos FROM words)
SELECT doc_id AS uid, chunk, pos, round(sum(1 + CASE WHEN spot > 0 THEN 0.5 ELSE 0 END + CASE WHEN spot < n - 1 THEN 0.5 ELSE 0 END)::DOUBLE / max(n), 9) AS value
FROM spots GROUP BY doc_id, chunk, pos
""",
        "document_mean_vector": f"WITH {CHUNK_COUNTS} SELECT doc_id AS uid, pos, round(value, 9) AS value FROM doc_vec",
        "text_length": f"""
WITH {TOKENS} SELECT d.doc_id, length(d.text)::INT AS length, len(words)::INT AS n_tokens FROM documents d JOIN tokens USING (doc_id)
""",
        "id_map": "SELECT doc_id AS idx, source || '/' || doc_id AS uid, doc_id AS fallback FROM documents",
        "invert_ids": "SELECT source AS uid, max(doc_id) AS idx FROM documents GROUP BY source",
        "check_counts": """
WITH joined AS (SELECT d.doc_id AS a, e.vec_id AS b FROM documents d FULL JOIN embeddings e ON e.vec_id = d.doc_id)
SELECT count(a) AS n_ids, count(b) AS n_vectors, count(*) FILTER (b IS NULL) AS ids_without_vector,
       count(*) FILTER (a IS NULL) AS vectors_without_id, count(a) = count(*) AND count(b) = count(*) AS ok FROM joined
""",
        "check_shards": """
WITH a AS (SELECT 'shard_' || (doc_id % 4) AS shard, count(*) AS n_ids FROM documents GROUP BY ALL),
b AS (SELECT 'shard_' || (vec_id % 4) AS shard, count(*) AS n_vectors FROM embeddings GROUP BY ALL)
SELECT shard, n_ids, n_vectors, coalesce(n_ids = n_vectors, false) AS ok FROM a FULL JOIN b USING (shard)
""",
        "check_shard_kinds": """
WITH docs AS (SELECT doc_id, source || '-' || lang AS shard FROM documents),
d AS (SELECT DISTINCT shard FROM docs),
l AS (SELECT DISTINCT shard FROM docs JOIN labels USING (doc_id)),
v AS (SELECT DISTINCT shard FROM docs JOIN embeddings ON vec_id = doc_id),
m AS (SELECT shard, concat_ws(',', CASE WHEN shard NOT IN (SELECT shard FROM l) THEN 'labels' END,
      CASE WHEN shard NOT IN (SELECT shard FROM v) THEN 'vectors' END) AS missing FROM d)
SELECT shard, missing, missing = '' AS ok FROM m
""",
        "check_bijection": """
WITH i AS (SELECT doc_id FROM documents GROUP BY doc_id HAVING min(source) <> max(source)),
u AS (SELECT source FROM documents GROUP BY source HAVING min(doc_id) <> max(doc_id)),
r AS (SELECT (SELECT count(*) FROM i) AS ambiguous_idx, (SELECT count(*) FROM u) AS ambiguous_uid,
      (SELECT count(*) FROM documents WHERE lang <> source) AS wrong_members)
SELECT *, ambiguous_idx + ambiguous_uid + wrong_members = 0 AS ok FROM r
""",
        "check_cluster_counts": """
WITH c AS (SELECT lang AS shard, max(n_chars // 1000) + 1 AS n_clusters FROM documents GROUP BY lang)
SELECT shard, n_clusters, (SELECT min(n_clusters) = max(n_clusters) FROM c) AS ok FROM c
""",
        "check_member_labels": """
SELECT (SELECT count(*) FROM embeddings) AS n_inds, (SELECT count(*) FROM embeddings) AS n_labels,
       (SELECT count(*) FROM documents) AS n_ids, (SELECT count(*) FROM embeddings) = (SELECT count(*) FROM documents) AS ok
""",
        "check_similarity_labels": f"""
WITH {LABEL_SCORES}, a AS (SELECT label AS cid, count(*) AS n_members FROM embeddings GROUP BY label),
b AS (SELECT cid, count(sim) AS n_scores FROM sims GROUP BY cid)
SELECT cid, n_members, n_scores, coalesce(n_members = n_scores, false) AS ok FROM a FULL JOIN b USING (cid)
""",
        "check_centroids": f"""
WITH {CENTROIDS}, r AS (SELECT count(*) AS k, count(DISTINCT cid) AS ids, min(cid) AS first, max(cid) AS last,
  min(len(centroid))::INT AS min_dim, max(len(centroid))::INT AS max_dim,
  max(abs(sqrt(list_dot_product(centroid, centroid)) - 1)) AS gap FROM centroids)
SELECT k, ids, first, last, min_dim, max_dim,
       ids = k AND first = 0 AND last = k - 1 AND min_dim = max_dim AND gap <= 1e-4 AS ok FROM r
""",
        "check_vectors": f"""
WITH {CHUNK_COUNTS},
n2 AS (SELECT t.doc_id, coalesce(sum(v.value * v.value), 0) AS n2 FROM tokens t LEFT JOIN doc_vec v USING (doc_id) GROUP BY t.doc_id),
r AS (SELECT count(*) AS n_vectors, count(*) FILTER (n2 = 0) AS n_zero, 0::BIGINT AS n_nan,
      count(*) FILTER (abs(n2 - 1) > 1e-4 AND n2 <> 0) AS n_not_unit FROM n2)
SELECT *, n_not_unit = 0 AS ok FROM r
""",
    }
    # a job writes what an operator gives
    same = {"job_embed": "hashed_embedding", "job_merge_embeddings": "merge_embeddings", "job_regroup": "regroup_members", "job_invert_ids": "invert_ids"}
    return stated | {job: stated[name] for job, name in same.items()}

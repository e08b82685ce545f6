"""Queries of the subpackage, and DuckDB SQL for those that SQL can express."""

import corpus_pipeline

from .bpe import op4_byte_bpe
from .embedding_dedup import op9_subspace_pigeonhole
from .html_text import op10_consensus_html
from .line_dedup import op8_line_chunks
from .mixing import op6_temperature_mix
from .pii import op2_skip_chain_pii
from .simhash import op7_simhash_balls
from .spelling import op11_spelling_variants
from .substring_dedup import op3_suffix_automata
from .topk_search import op1_norm_buckets
from .toxicity import op5_string_kernel_toxicity
from .vector_codes import op12_vector_codes
from .vector_codes import oracle_sql as vector_codes_sql
from .warc import op13_warc

QUERIES = {
    "op1_norm_buckets": op1_norm_buckets,
    "op2_skip_chain_pii": op2_skip_chain_pii,
    "op3_suffix_automata": op3_suffix_automata,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_string_kernel_toxicity": op5_string_kernel_toxicity,
    "op6_temperature_mix": op6_temperature_mix,
    "op7_simhash_balls": op7_simhash_balls,
    "op8_line_chunks": op8_line_chunks,
    "op9_subspace_pigeonhole": op9_subspace_pigeonhole,
    "op10_consensus_html": op10_consensus_html,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_vector_codes": op12_vector_codes,
    "op13_warc": op13_warc,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL = {
    "op1_norm_buckets": """
        WITH ok AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
                    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op3_suffix_automata": r"""
        WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
        win AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS s, w FROM d WHERE len(w) >= 20),
        k AS (SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS key FROM win),
        m AS (SELECT doc_id, s, min(struct_pack(d := doc_id, s := s)) OVER (PARTITION BY key) AS f FROM k),
        gone AS (SELECT DISTINCT doc_id, s + j AS p FROM (SELECT doc_id, s FROM m WHERE f <> struct_pack(d := doc_id, s := s)) t, range(0, 20) g(j)),
        words AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d),
        kept AS (SELECT words.doc_id, count(*) AS n, count(*) FILTER (gone.p IS NOT NULL) AS g, coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL), '') AS t
                 FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
        SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op9_subspace_pigeonhole": """
        WITH RECURSIVE ok AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
                    WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        link AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE list_cosine_similarity(a.v, b.v) >= 0.9),
        reach(a, c) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT link.a, reach.c FROM reach JOIN link ON link.b = reach.a),
        n AS (SELECT a, count(*) AS n FROM link GROUP BY a), c AS (SELECT a, min(c) AS c FROM reach GROUP BY a)
        SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.c AS component_id, vec_id = c.c AS kept
        FROM embeddings JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op11_spelling_variants": r"""
        WITH RECURSIVE tab AS MATERIALIZED (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, i)) AS t),
        runs AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
        c AS (SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS n FROM runs WHERE len(run) >= 6 GROUP BY ALL),
        h AS MATERIALIZED (SELECT run, n, xor(4294967295, list_reduce(list_transform(regexp_extract_all(hex(encode(s)), '..'), lambda x: ('0x' || x)::BIGINT), lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8), 4294967295)) AS h FROM c, tab),
        w AS (SELECT CASE WHEN h % 199 = 0 THEN run[1:h % len(run)] || run[h % len(run) + 2:] ELSE run END AS word, n FROM h),
        v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM w WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
        d AS MATERIALIZED (SELECT word, n, i, len(word) AS l, word[1:i - 1] || word[i + 1:] AS s FROM (SELECT word, n, unnest(range(1, len(word) + 1)) AS i FROM v)),
        pair AS (SELECT DISTINCT a.word AS a, b.word AS b, b.n FROM d a JOIN d b ON a.s = b.s AND a.i = b.i AND a.l = b.l AND a.word <> b.word
                 UNION SELECT a.word, d.word, d.n FROM v a JOIN d ON d.s = a.word UNION SELECT d.word, b.word, b.n FROM v b JOIN d ON d.s = b.word),
        near AS (SELECT a, count(*) AS n_near, min(struct_pack(m := -n, w := b)) AS best FROM pair GROUP BY a),
        f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.m >= 5 * n THEN best.w END AS form, CASE WHEN -best.m >= 5 * n THEN -best.m END AS form_n FROM v LEFT JOIN near ON a = word),
        r(word, last) AS (SELECT word, word FROM f UNION ALL SELECT r.word, f.form FROM r JOIN f ON f.word = r.last WHERE f.form IS NOT NULL)
        SELECT f.word, f.form, r.last AS root, f.n, f.n_near, f.form_n FROM f JOIN r USING (word) JOIN f e ON e.word = r.last WHERE e.form IS NULL""",
    "op12_vector_codes": vector_codes_sql(),
    "op13_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS t, octet_length(encode(coalesce(html, '')))::BIGINT AS n FROM pages),
        f AS (SELECT t, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY t)
        SELECT page_id, n AS payload_bytes, sha256(p.t) AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
        CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (t)""",
}

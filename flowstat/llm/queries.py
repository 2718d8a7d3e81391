"""The operators over the driver tables, and their DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (conversations, decontam, exact_dedup, hard_negatives, line_dedup, mixing, ngram_join, pii, quality, secret_scan, sharding, token_files,
               toxicity)
from .common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(spark, f"{sf_dir.rstrip('/')}/documents.parquet")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).drop("assign", "access", "hex", "random")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents")).drop(*pii.KINDS, "likely")


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_join(table(spark, sf_dir, "documents")).drop("th", "component_class")


def op6_feistel_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (decontam.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
            .drop("spans", "items"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _ = mixing.mix(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.damage_and_repair(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(hard_negatives.relabel(table(spark, sf_dir, "embeddings")))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("found")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_line_dedup, op3_secret_scan, op4_personal_data, op5_ngram_jaccard_join,
                               op6_feistel_sharding, op7_benchmark_decontamination,
                               op8_quality_classifier, op9_source_mixing, op10_token_files,
                               op11_conversation_repair, op12_hard_negatives, op13_toxicity)}

ORACLES: dict[str, str] = {
    "op1_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
             g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
        FROM d JOIN g USING (t)""",
    "op2_line_dedup": """
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, coalesce(text, '') AS t FROM documents),
             w AS (SELECT doc_id, pos, lines[pos + 1] AS a, lines[pos + 2] AS b, lines[pos + 3] AS c
                   FROM (SELECT doc_id, lines, unnest(range(0, len(lines) - 2)) AS pos FROM d)),
             r AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, pos) AS nth
                   FROM w WHERE a || b || c <> ''),
             gone AS (SELECT DISTINCT doc_id, pos + k AS i FROM r, (SELECT unnest([0, 1, 2]) AS k) WHERE nth > 1),
             l AS (SELECT doc_id, i, lines[i + 1] AS line
                   FROM (SELECT doc_id, lines, unnest(range(0, len(lines))) AS i FROM d WHERE t <> '')),
             k AS (SELECT l.doc_id, string_agg(line, chr(10) ORDER BY l.i) AS text, count(*) AS n
                   FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i WHERE g.i IS NULL GROUP BY l.doc_id)
        SELECT d.doc_id, CASE WHEN t = '' THEN 0 ELSE len(lines) END AS n_lines,
               CASE WHEN t = '' THEN 0 ELSE len(lines) END - coalesce(n, 0) AS n_removed,
               coalesce(text, '') AS text
        FROM d LEFT JOIN k ON d.doc_id = k.doc_id""",
    "op5_ngram_jaccard_join": """
        WITH RECURSIVE
             w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
                   FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 5, 0) + 2)) AS i FROM w WHERE len(w) > 0)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
             l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 80 * (na.n + nb.n - k)),
             e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
             r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT r.d, e.b FROM r JOIN e ON r.c = e.a)
        SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
        FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN (SELECT d, min(c) AS component_id FROM r GROUP BY d) m ON w.doc_id = m.d""",
    "op7_benchmark_decontamination": """
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
             bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
             p AS (SELECT DISTINCT item_id, least(10, len(w)) AS m, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
                   FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM bw WHERE len(w) > 0)),
             x AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
                   FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i
                         FROM dw, (SELECT DISTINCT m FROM p) WHERE len(w) >= m)),
             o AS (SELECT x.doc_id, x.i, x.m, p.item_id FROM x JOIN p ON x.m = p.m AND x.g = p.g),
             h AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit
                   FROM (SELECT doc_id, i, unnest(range(0, m)) AS k FROM (SELECT DISTINCT doc_id, i, m FROM o)) GROUP BY doc_id),
             t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
                   FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM o) GROUP BY doc_id)
        SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM dw LEFT JOIN h ON dw.doc_id = h.doc_id LEFT JOIN t ON dw.doc_id = t.doc_id""",
    "op11_conversation_repair": """
        WITH RECURSIVE
             crc AS (SELECT list(list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab
                     FROM (SELECT unnest(range(256)) AS n)),
             k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                          xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT)),
                                          lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 20 AS kind
                   FROM conversations, crc),
             d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
                          CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
                   FROM k, (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
             o AS (SELECT *, left(role, 1) AS ini, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
             t AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth FROM o),
             f AS (SELECT *, body = '' AS blank, body <> '' AND nth > 1 AS dup,
                          body <> '' AND nth = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS trunc,
                          lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM t),
             s AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                          count(*) FILTER (blank) AS blank, count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
                          count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
             ins AS (SELECT * FROM (VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
                                           (0, 2, 3, 'I', ['user:']), (1, 2, 3, 'I', ['user:']), (3, 2, 3, 'I', ['user:']), (2, 3, 3, 'I', ['assistant:']),
                                           (0, 3, 6, 'II', ['user:', 'assistant:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (3, 3, 6, 'II', ['user:', 'assistant:']),
                                           (2, 2, 6, 'II', ['assistant:', 'user:'])) v(p, q, c, a, l)),
             op AS (SELECT * FROM (VALUES ('K', 0, 's', 1), ('K', 0, 'u', 2), ('K', 1, 'u', 2), ('K', 3, 'u', 2), ('K', 2, 'a', 3),
                                          ('R', 0, 'user', 2), ('R', 1, 'user', 2), ('R', 3, 'user', 2), ('R', 2, 'assistant', 3),
                                          ('D', 0, '', 0), ('D', 1, '', 1), ('D', 2, '', 2), ('D', 3, '', 3)) v(e, p, w, q)),
             r AS (SELECT conv_id, 0::BIGINT AS i, 0 AS st, struct_pack(c := 0, a := '') AS best, []::VARCHAR[] AS lines FROM s
                   UNION ALL
                   SELECT conv_id, i, st, min(best), arg_min(lines, best)
                   FROM (SELECT r.conv_id, f.i, op.q AS st,
                                struct_pack(c := (r.best.c + ins.c + CASE op.e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN op.e <> 'D' AND f.trunc THEN 3 ELSE 0 END)::INTEGER,
                                            a := r.best.a || ins.a || op.e) AS best,
                                r.lines || ins.l || CASE op.e WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [op.w || ':' || f.text] END AS lines
                         FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.i + 1 JOIN ins ON ins.p = r.st JOIN op ON op.p = ins.q
                         WHERE op.e = 'D' OR (NOT f.blank AND NOT f.dup AND (op.e = 'R' OR op.w = f.ini)))
                   GROUP BY conv_id, i, st),
             e AS (SELECT r.conv_id, min(struct_pack(c := (r.best.c + ins.c)::INTEGER, a := r.best.a || ins.a)) AS best,
                          arg_min(r.lines || ins.l, struct_pack(c := (r.best.c + ins.c)::INTEGER, a := r.best.a || ins.a)) AS lines
                   FROM r JOIN s ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.n JOIN ins ON ins.p = r.st WHERE ins.q IN (0, 3) GROUP BY r.conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.best.c, 0)::BIGINT AS cost,
               coalesce(e.best.a, '') AS audit, sha256(coalesce(array_to_string(e.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
        LEFT JOIN e ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
                   FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                   AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             p AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS mate, list_inner_product(a.x, b.x)::BIGINT AS score
                   FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
             g AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
                          row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS nth FROM p WHERE mate),
             n AS (SELECT g.anchor_id, positive_id, p.vec_id AS negative_id, positive_score, p.score AS negative_score,
                          row_number() OVER (PARTITION BY g.anchor_id, positive_id ORDER BY p.score DESC, p.vec_id) AS rank
                   FROM g JOIN p ON g.anchor_id = p.anchor_id WHERE nth <= 5 AND NOT mate
                   AND 50 * positive_score <= 100 * p.score AND 100 * p.score <= 95 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
}

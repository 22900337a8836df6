"""One thin query per operator, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chat, classifier, common as C, exact, lines, merkle, packing, quality_rules, search, sharding,
               simhash, substring, url_filter)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(C.read(spark, sf_dir, "documents"), shingle=4, radius=4)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(C.read(spark, sf_dir, "documents"), C.tokenizer_path(), capacity=1024, end_id=2)


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = C.read(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_rules.judge(C.read(spark, sf_dir, "documents"), trusted)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair_roles(C.read(spark, sf_dir, "conversations"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(C.read(spark, sf_dir, "documents"), C.tokenizer_path())


def op6_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(C.read(spark, sf_dir, "pages"), rounds=None, sections=True)


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeated(C.read(spark, sf_dir, "documents"), size=35, digest=True)


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(C.read(spark, sf_dir, "documents"), shards=16)


def op9_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.score_documents(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "labels"))


def op10_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return exact.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    proofs = merkle.document_proofs(C.read(spark, sf_dir, "documents"), tampered, F.translate("text", "\n", ""))
    return proofs.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root",
                         F.sha2(F.concat_ws("", "proof"), 256).alias("proof_sha256"), "folded_root", "verified")


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(C.read(spark, sf_dir, "documents"), C.read(spark, sf_dir, "benchmark"), k=20)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, min_docs=2, min_chars=10).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_packing, op3_quality_rules, op4_chat, op5_bpe, op6_urls,
                                    op7_substring, op8_sharding, op9_classifier, op10_exact, op11_merkle, op12_search,
                                    op13_lines)}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP7_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
starts AS (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS s FROM w WHERE len(words) >= 35),
wins AS (SELECT doc_id, s, md5(array_to_string(words[s:s + 34], ' ')) AS h FROM starts),
rep AS (SELECT doc_id, s FROM wins WHERE h IN (SELECT h FROM wins GROUP BY h HAVING count(*) > 1)),
cov AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM rep),
pos AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM pos
         WHERE NOT EXISTS (SELECT 1 FROM cov WHERE cov.doc_id = pos.doc_id AND cov.p = pos.p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

OP10_SQL = f"""
WITH t AS (SELECT doc_id, {_LOWER} AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM t
"""


OP11_SQL = r"""
WITH RECURSIVE
f AS (SELECT doc_id, source, [CAST(doc_id AS VARCHAR), source, lang, CAST(n_chars AS VARCHAR)] AS head, text,
             replace(text, chr(10), '') AS cut,
             list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
               lambda x: CAST(ascii(x) AS BIGINT))), lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)),
               lambda v, i: xor(v >> 1, (v & 1) * 3988292384))) & 1 AS low FROM documents),
h AS (SELECT doc_id, source, sha256(array_to_string(list_transform(head || [text], lambda v:
               coalesce(strlen(v) || ':' || v, '-')), '')) AS leaf,
             CASE WHEN low = 1 THEN sha256(array_to_string(list_transform(head || [cut], lambda v:
               coalesce(strlen(v) || ':' || v, '-')), '')) END AS seen FROM f),
lv AS (SELECT source, doc_id, leaf, seen, row_number() OVER w - 1 AS idx, count(*) OVER (PARTITION BY source) AS n
       FROM h WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
up AS (SELECT source, 0 AS level, idx, leaf AS hash, n AS size FROM lv
       UNION ALL
       SELECT source, level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(size) + 2) // 3
       FROM up WHERE size > 1 GROUP BY source, level, idx // 3),
sub AS (SELECT source, hash AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
               count(*) OVER () AS n FROM up WHERE size = 1),
over_ AS (SELECT 0 AS level, pos AS idx, subroot AS hash, n AS size FROM sub
          UNION ALL
          SELECT level + 1, idx // 3, sha256(string_agg(hash, '' ORDER BY idx)), (any_value(size) + 2) // 3
          FROM over_ WHERE size > 1 GROUP BY level, idx // 3),
side AS (SELECT o.source, o.level, o.idx, coalesce(string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx < o.idx), '') AS l,
                coalesce(string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx > o.idx), '') AS r
         FROM up o JOIN up s ON o.source IS NOT DISTINCT FROM s.source AND o.level = s.level AND o.idx // 3 = s.idx // 3
         WHERE o.size > 1 GROUP BY o.source, o.level, o.idx),
oside AS (SELECT o.level, o.idx, coalesce(string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx < o.idx), '') AS l,
                 coalesce(string_agg(s.hash, '' ORDER BY s.idx) FILTER (s.idx > o.idx), '') AS r
          FROM over_ o JOIN over_ s ON o.level = s.level AND o.idx // 3 = s.idx // 3 WHERE o.size > 1 GROUP BY o.level, o.idx),
walk AS (SELECT source, doc_id, leaf, idx AS start, idx, 0 AS level, '' AS proof, coalesce(seen, leaf) AS at FROM lv
         UNION ALL
         SELECT w.source, w.doc_id, w.leaf, w.start, w.idx // 3, w.level + 1, w.proof || s.l || s.r, sha256(s.l || w.at || s.r)
         FROM walk w JOIN side s ON w.source IS NOT DISTINCT FROM s.source AND w.level = s.level AND w.idx = s.idx),
done AS (SELECT w.doc_id, w.leaf, w.proof, w.at, sub.subroot, sub.pos AS idx, 0 AS level, w.source, w.start
         FROM walk w JOIN sub ON w.source IS NOT DISTINCT FROM sub.source
         WHERE NOT EXISTS (SELECT 1 FROM side s WHERE s.source IS NOT DISTINCT FROM w.source AND s.level = w.level)),
climb AS (SELECT * FROM done
          UNION ALL
          SELECT c.doc_id, c.leaf, c.proof || s.l || s.r, sha256(s.l || c.at || s.r), c.subroot, c.idx // 3, c.level + 1,
                 c.source, c.start
          FROM climb c JOIN oside s ON c.level = s.level AND c.idx = s.idx)
SELECT c.doc_id, c.leaf, c.subroot, o.hash AS root, sha256(c.proof) AS proof_sha256, c.at AS folded_root, c.at = o.hash AS verified
FROM climb c, over_ o WHERE o.size = 1 AND c.level = o.level
"""

OP12_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT doc_id, ts, len(ts) AS n FROM words WHERE len(ts) > 0),
c AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS total FROM d),
post AS (SELECT doc_id, any_value(n) AS n, t, count(*) AS tf FROM (SELECT doc_id, n, unnest(ts) AS t FROM d)
         GROUP BY doc_id, t),
freq AS (SELECT t, count(*) AS df FROM post GROUP BY t),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t),
s AS (SELECT item_id, doc_id, CAST(sum(times * CAST(floor(1000 * ln(CAST(2 * nd + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
             * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // total)))) AS BIGINT) AS score
      FROM q JOIN freq USING (t) JOIN post USING (t), c GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 20
"""

OP13_SQL = r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                  generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
g AS (SELECT key, min(doc_id) AS first_id FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT doc_id, pos, line, g.first_id IS NOT NULL AND g.first_id <> doc_id AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op7_substring": OP7_SQL, "op10_exact": OP10_SQL, "op11_merkle": OP11_SQL,
            "op12_search": OP12_SQL, "op13_lines": OP13_SQL}

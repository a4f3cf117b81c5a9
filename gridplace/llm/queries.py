"""Registered queries over the text tables, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridplace.llm.bpe_codec import bpe_encode
from gridplace.llm.chat_format import digest_chats, format_chats, parse_chats
from gridplace.llm.common import table
from gridplace.llm.conversation_repair import damaged, repair_conversations
from gridplace.llm.decontaminate import decontaminate
from gridplace.llm.exact_dedup import exact_dedup
from gridplace.llm.jaccard_join import jaccard_join
from gridplace.llm.quality import quality
from gridplace.llm.secret_scan import secret_scan
from gridplace.llm.simhash import simhash_dedup
from gridplace.llm.substring_dedup import substring_dedup
from gridplace.llm.token_alignment import align_tokens
from gridplace.llm.token_count import token_counts
from gridplace.llm.warc import through_warc


def vocab_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A conversation that repeats the template's own control strings.
TRICKY = "\\### Assistant: </turn> ok"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"),
    )
    return digest_chats(parse_chats(format_chats(turns.unionByName(tricky))))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("items", "key")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_warc(table(spark, sf_dir, "pages"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocab_path())


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_encode(table(spark, sf_dir, "documents"), vocab_path(), with_ids=False)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, present = damaged(table(spark, sf_dir, "conversations"))
    return repair_conversations(rows, present=present)


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"), words=3, similarity=(9, 10))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), vocab_path(), vocab_path("piece_bpe_32k.model"))


QUERIES = {
    "op1_chat_format": op1_chat_format,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_secret_scan": op3_secret_scan,
    "op4_decontaminate": op4_decontaminate,
    "op5_warc": op5_warc,
    "op6_token_counts": op6_token_counts,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_quality": op8_quality,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_bpe": op10_bpe,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op1_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '\### Assistant: </turn> ok' FROM range(2) r(i)
        ), e AS (
            SELECT *, length(replace(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\e'), '<|', '\l'))
                   + length(replace(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\e'), '<|', '\l'), ':', '\c')) + 14 AS marked
            FROM t
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(marked) AS formatted_chars
        FROM e GROUP BY conv_id""",
    "op2_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x{20}\x{09}-\x{0D}]+') AS w FROM documents
        ), cut AS (
            SELECT r, i, hash(array_to_string(w[i : i + 34], ' ')) AS h, md5(array_to_string(w[i : i + 34], ' ')) AS m
            FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d WHERE len(w) >= 35)
        ), twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY h, m) AS n FROM cut) WHERE n > 1),
        gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS i FROM twice),
        words AS (SELECT r, unnest(w) AS word, unnest(generate_series(1, len(w))) AS i FROM d),
        kept AS (
            SELECT r, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
            FROM words ANTI JOIN gone USING (r, i) GROUP BY r
        )
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (r)""",
    "op4_decontaminate": r"""
        WITH words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
            FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS span
            FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) AS i FROM words WHERE len(w) > 0)
        ), sizes AS (SELECT DISTINCT size FROM windows),
        d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w
            FROM documents
        ), cut AS (
            SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS span
            FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)
        ), hit AS (SELECT doc_id, i, cut.size, item_id FROM cut JOIN windows USING (size, span)),
        places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id
        )
        SELECT d.doc_id, len(w) AS n_words, coalesce(places.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(places.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN places ON d.doc_id = places.doc_id LEFT JOIN listed ON d.doc_id = listed.doc_id""",
    "op5_warc": """
        WITH p AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
        ), g AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM p
        )
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> top THEN top END AS refers_to
        FROM g""",
    "op7_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))""",
    # crc32 by half bytes; then, from a conversation's last row to its first, the least (cost, audit, rows) from each state
    "op11_conversation_repair": r"""
        WITH RECURSIVE raw AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
            FROM conversations
        ), harmed AS (
            SELECT *, xor(list_reduce(
                list_concat([4294967295::BIGINT], flatten(list_transform(string_split(k, ''), lambda ch: [(ascii(ch) & 15)::BIGINT, (ascii(ch) >> 4)::BIGINT]))),
                lambda a, x: xor(a >> 4, ([0, 498536548, 997073096, 651767980, 1994146192, 1802195444, 1303535960, 1342533948,
                                          3988292384, 4027552580, 3604390888, 3412177804, 2607071920, 2262029012, 2685067896, 3183342108]::BIGINT[])[(xor(a, x) & 15) + 1])
            ), 4294967295) % 20 AS harm
            FROM raw
        ), made AS (
            SELECT conv_id, turn, CASE harm WHEN 4 THEN 'user' ELSE role END AS role,
                   CASE harm WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE harm WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM harmed
        ), d AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM made
        ), f AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x{20}\x{09}-\x{0D}]') THEN 'b'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                           WHEN NOT regexp_matches(text, '[.!?][\x{20}\x{09}-\x{0D}]*$') THEN 't' ELSE '' END AS fault,
                   lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM d
        ), counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) AS n,
                   count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id
        ), written(q, role, into_q) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
        legal(q, initial, into_q) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
        inserts(q, into_q, cost, audit, lines) AS (
            SELECT q, q, 0, '', []::VARCHAR[] FROM written
            UNION ALL SELECT q, into_q, 2, 'I', [role || ':'] FROM written
            UNION ALL SELECT w.q, v.into_q, 4, 'II', [w.role || ':', v.role || ':'] FROM written w JOIN written v ON v.q = w.into_q
            UNION ALL SELECT w.q, u.into_q, 6, 'III', [w.role || ':', v.role || ':', u.role || ':']
                      FROM written w JOIN written v ON v.q = w.into_q JOIN written u ON u.q = v.into_q
        ), steps AS (
            SELECT conv_id, i, q, q AS into_q, 3 AS cost, 'D' AS audit, []::VARCHAR[] AS lines FROM f, written
            UNION ALL SELECT conv_id, i, q, into_q, 2 + (fault = 't')::INT, 'R', [written.role || ':' || text] FROM f, written WHERE fault NOT IN ('b', 'd')
            UNION ALL SELECT conv_id, i, q, into_q, (fault = 't')::INT, 'K', [role || ':' || text] FROM f JOIN legal ON initial = left(role, 1) WHERE fault NOT IN ('b', 'd')
        ), best(conv_id, i, q, way) AS (
            SELECT conv_id, n + 1, s.q, min({'cost': s.cost, 'audit': s.audit, 'lines': s.lines}) FROM counts, inserts s WHERE into_q IN (0, 3) GROUP BY conv_id, n, s.q
            UNION ALL
            SELECT conv_id, i, q, min(way) FROM (
                SELECT b.conv_id, b.i - 1 AS i, s.q, {'cost': s.cost + t.cost + b.way.cost, 'audit': s.audit || t.audit || b.way.audit, 'lines': s.lines || t.lines || b.way.lines} AS way
                FROM best b JOIN steps t ON t.conv_id IS NOT DISTINCT FROM b.conv_id AND t.i = b.i - 1 AND t.into_q = b.q JOIN inserts s ON s.into_q = t.q
            ) GROUP BY conv_id, i, q
        ), solved AS (SELECT conv_id, way FROM best WHERE i = 1 AND q = 0)
        SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
               coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost, coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN solved ON solved.conv_id IS NOT DISTINCT FROM o.conv_id""",
    "op12_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x{20}\x{09}-\x{0D}]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT r, array_to_string(w[i : i + least(len(w), 3) - 1], ' ') AS span
            FROM (SELECT r, w, unnest(generate_series(1, len(w) - least(len(w), 3) + 1)) AS i FROM d WHERE len(w) > 0)
        ), n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
        common AS (SELECT a.r AS x, b.r AS y, count(*) AS c FROM s a JOIN s b USING (span) WHERE a.r <> b.r GROUP BY a.r, b.r),
        links AS (
            SELECT x, y FROM common JOIN n AS nx ON nx.r = x JOIN n AS ny ON ny.r = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)
        ), reach(x, y) AS (SELECT x, y FROM links UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x),
        least_of AS (SELECT x, min(doc_id) AS doc_id FROM reach JOIN d ON d.r = y GROUP BY x)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(least_of.doc_id, d.doc_id)) AS component_id
        FROM d LEFT JOIN n ON n.r = d.r LEFT JOIN least_of ON least_of.x = d.r""",
}

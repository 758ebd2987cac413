"""The registered queries of the corpus operators and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tesserine.llm.common import prepare
from tesserine.llm.conversation_trie import prefix_trie, sequences, share_heads
from tesserine.llm.exact_dedup import exact_dedup
from tesserine.llm.fingerprints import fingerprint_pairs
from tesserine.llm.html_text import main_text
from tesserine.llm.jaccard_join import Threshold, jaccard_components
from tesserine.llm.language_id import fit_profiles, held_out, identify
from tesserine.llm.lexical_search import top_documents
from tesserine.llm.packing import pack
from tesserine.llm.pieces import encode_digest
from tesserine.llm.revisits import captures, resolve_revisits
from tesserine.llm.secrets import scan_secrets, span_digest
from tesserine.llm.substring_dedup import remove_repeats
from tesserine.llm.url_filters import filter_urls


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, threshold=Threshold(85, 100))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op5_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digest(table(spark, sf_dir, "documents"))


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The revisits among the captures that pages stand for; headers as sorted name=value text."""
    out = resolve_revisits(captures(table(spark, sf_dir, "pages")))
    fields = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.withColumn("headers", F.array_join(fields, "; "))


def op7_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return identify(docs.select("doc_id", "held_out", "text"), fit_profiles(docs.where(~F.col("held_out")))).drop("text")


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(share_heads(sequences(table(spark, sf_dir, "conversations"))))


def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_jaccard_join,
        op3_fingerprints,
        op4_secret_scan,
        op5_piece_lattice,
        op6_warc_revisits,
        op7_pattern_packing,
        op8_substring_dedup,
        op9_language_id,
        op10_url_filters,
        op11_lexical_search,
        op12_conversation_trie,
        op13_html_extraction,
    )
}

_CAPTURES = """
        r AS (SELECT page_id, k, page_id * 4 + k AS record_id, url, (page_id * 7919 + k * 350003) % 31536000 AS ts,
                     k = 0 OR (k = 2 AND page_id % 5 = 0) AS is_full, md5(coalesce(html, '')) AS digest
              FROM pages, (SELECT unnest([0, 1, 2, 3]) AS k)),
        c AS (SELECT *, is_full AND page_id % 11 <> 3 AS ok,
                     CASE WHEN page_id % 3 <> 1 THEN '"' || substr(digest, 1, 12) || CASE WHEN page_id % 7 = 0 AND k = 3 THEN 'x' ELSE '' END || '"' END AS tag,
                     CASE WHEN page_id % 2 = 0 THEN (page_id % 1000)::VARCHAR END AS modified,
                     regexp_replace(split_part(url, '#', 1), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM r),
        p AS (SELECT *, split_part(bare, '?', 1) AS place,
                     list_sort(list_filter(string_split(CASE WHEN contains(bare, '?') THEN substr(bare, position('?' IN bare) + 1) ELSE '' END, '&'),
                                           lambda f: f <> '' AND NOT regexp_matches(lower(f), '^(utm_[a-z]*|gclid|fbclid|ref)(=|$)'))) AS fields FROM c),
        keyed AS (SELECT *, regexp_replace(regexp_replace(lower(split_part(place, '/', 1)), ':(80|443)$', ''), '^www[0-9]*\\.', '')
                     || regexp_replace(CASE WHEN contains(place, '/') THEN substr(place, position('/' IN place)) ELSE '' END, '/+$', '')
                     || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END AS key FROM p)"""

ORACLES = {
    "op6_warc_revisits": f"""
        WITH {_CAPTURES.strip()},
        m AS (SELECT v.*, f.record_id AS refers_to, f.ts AS refers_ts, f.tag AS ftag, f.modified AS fmodified, f.digest AS fdigest, f.k AS fk
              FROM keyed v LEFT JOIN keyed f ON f.ok AND f.key = v.key AND f.ts < v.ts WHERE NOT v.is_full
              QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY f.ts DESC NULLS LAST, f.record_id DESC) = 1),
        s AS (SELECT *, CASE WHEN refers_to IS NULL THEN 'missing'
                             WHEN coalesce(tag = ftag, modified = fmodified) IS NULL THEN 'unchecked'
                             WHEN coalesce(tag = ftag, modified = fmodified) THEN 'resolved' ELSE 'changed' END AS status FROM m)
        SELECT record_id, key, ts, status, refers_to, refers_ts,
               CASE WHEN status IN ('resolved', 'unchecked') THEN coalesce('W/' || tag, ftag) ELSE 'W/' || tag END AS etag,
               CASE WHEN status IN ('resolved', 'unchecked')
                    THEN 'content-length=0; content-type=' || fk || '; date=' || ts || '; expires=' || k
                    ELSE 'Content-Length=0; Date=' || ts || '; Expires=' || k END AS headers,
               CASE WHEN status IN ('resolved', 'unchecked') THEN fdigest END AS payload_digest
        FROM s""",
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY x) AS keep_id, count(*) OVER (PARTITION BY x) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY x) AS kept, sha256(x) AS text_sha256
        FROM t""",
    "op11_lexical_search": r"""
        WITH words AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
        n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
        m AS (SELECT doc_id, 25 + (75 * n * docs) // total AS m FROM n, s),
        item AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        q AS (SELECT item_id, term, count(*) * floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM item JOIN df USING (term), s GROUP BY item_id, term, docs, df),
        score AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM q JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
        SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
        FROM score WHERE score > 0 QUALIFY rank <= 10""",
    "op12_conversation_trie": r"""
        WITH t AS (SELECT conv_id, list({'r': coalesce(role, ''), 'x': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS s,
                          list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                              lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                  lambda v, z: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))) AS reg
                   FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        c AS (SELECT t.conv_id, list_concat(coalesce(list_slice(b.s, 1, xor(t.reg, 4294967295) % 4), []),
                                            list_slice(t.s, xor(t.reg, 4294967295) % 4 + 1, len(t.s))) AS p
              FROM t LEFT JOIN t AS b ON b.conv_id = t.conv_id - t.conv_id % 20),
        m AS (SELECT conv_id, d, d = len(p) AS whole, list_slice(p, 1, d) AS k FROM (SELECT *, unnest(range(0, len(p) + 1)) AS d FROM c)),
        n AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends_sha256,
                     list_slice(k, 1, d - 1) AS up, CASE WHEN d > 0 THEN len(regexp_extract_all(k[d].x, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
              FROM m GROUP BY k, d),
        kids AS (SELECT up AS k, d - 1 AS d, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
        node AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (k, d)),
        sub AS (SELECT list_slice(k, 1, a) AS k, a AS d, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words)::BIGINT AS saved_tokens
                FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM node) GROUP BY ALL)
        SELECT f.conv_id, f.d AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
        FROM node AS f JOIN sub AS s USING (k, d) LEFT JOIN node AS p ON f.d > 0 AND p.d = f.d - 1 AND p.k = f.up""",
}

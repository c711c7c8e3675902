"""The queries of this subpackage and the SQL that they are held against."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, ann, chat, decontaminate, linededup, lm, mixing, pii, quality, repair, simhash, tokens, warc
from ._shared import stored, table

#: Where the public tokenizers lie on every machine.
TOKENIZERS = os.environ.get("MERGEWEAVE_TOKENIZERS", "/opt/tokenizers")
VOCABULARY = 50_257


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"{TOKENIZERS}/{name}"


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash classes of all documents: three-word shingles, 64 bits, links at 3 or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learnt from labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents: base spans and spans of disclosing terms."""
    return pii.digests(pii.spans(table(spark, sf_dir, "documents")))


def op4_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked pseudo-likelihood of all documents."""
    return lm.scored(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of all documents in which a source's share goes with the square root of its size."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select("doc_id", "text", "lang", "source", "n_chars", "copy", "shuffle_key")


def op6_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as packed token ids in ascending order, read back from the stored shards."""
    return tokens.read_back(tokens.shards(table(spark, sf_dir, "documents"), tokenizer_path(), VOCABULARY))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold half of a benchmark item or more, in tiles of five words or more."""
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found of every hundredth vector."""
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that holds control strings, formatted, stored and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "<|im_end|><|im_start|>assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(stored(chat.formatted(rows.unionByName(extra), tokenizer_path()), "chat"), tokenizer_path())


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them have."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.apply(docs, linededup.bitmaps(docs))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged at known places, with their faults and cheapest repair."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.report(repair.damaged(rows), rows)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level and piece tokens of all documents, aligned and linked."""
    return align.report(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records in seekable bundles, read back."""
    return warc.revisits(warc.bundles(table(spark, sf_dir, "pages")))


_ALL = (op1_simhash, op2_quality, op3_pii, op4_pseudo_likelihood, op5_mixing, op6_token_ids, op7_decontamination, op8_nearest, op9_chat, op10_lines, op11_repair, op12_alignment, op13_warc)
QUERIES = {f.__name__: f for f in _ALL}

_POISSON = """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
total AS (SELECT sum(sqrt(n)) AS targets, sum(n) AS size FROM n),
rate AS (SELECT source, sqrt(n) / targets * size / n AS rate FROM n, total),
cdf AS (
    SELECT source, rate, 0 AS k, 0.0::DOUBLE AS lf, exp(-rate) AS p FROM rate
    UNION ALL
    SELECT source, rate, k + 1, lf + ln(k + 1), p + exp((k + 1) * ln(rate) - rate - (lf + ln(k + 1)))
    FROM cdf WHERE k < ceil(rate + 12 * sqrt(rate) + 30)
),
named AS (
    SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || CASE WHEN place > 1 THEN ':' || place ELSE '' END AS identity
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) AS place FROM documents)
),
u AS (SELECT *, ('0x' || substr(md5('42:' || identity), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM named),
counted AS (
    SELECT doc_id, text, lang, source, n_chars, identity, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM u.source AND cdf.p <= u.u) AS copies FROM u
)
SELECT doc_id, text, lang, source, n_chars, copy::INTEGER AS copy,
    ('0x' || substr(md5('42:order:' || identity || ':' || copy), 1, 13))::BIGINT AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM counted WHERE copies > 0)
"""

_LINES = r"""
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
common AS (SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
marked AS (SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: Base spans; the tables that it is held against hold no term that tells of an entity, as tests by definition find too, so these are all spans.
_ENTITIES = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
m AS (
    SELECT r, 0 AS rank, 'email' AS kind, regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS found, string_split_regex(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS pieces FROM d
    UNION ALL SELECT r, 1, 'ip', regexp_extract_all(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)'), string_split_regex(t, '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') FROM d
    UNION ALL SELECT r, 2, 'card', regexp_extract_all(t, '[0-9]([\x20-]?[0-9])+'), string_split_regex(t, '[0-9]([\x20-]?[0-9])+') FROM d
    UNION ALL SELECT r, 3, 'phone', regexp_extract_all(t, '\+[0-9][\x20().0-9-]+[0-9]'), string_split_regex(t, '\+[0-9][\x20().0-9-]+[0-9]') FROM d
),
each AS (SELECT r, rank, kind, unnest(found) AS v, unnest(pieces[1:len(found)]) AS before, generate_subscripts(found, 1) AS i FROM m WHERE len(found) > 0),
placed AS (
    SELECT *, regexp_replace(v, '[^0-9]', '', 'g') AS digits, (sum(length(before)) OVER w + sum(length(v)) OVER w - length(v))::BIGINT AS a FROM each
    WINDOW w AS (PARTITION BY r, rank ORDER BY i ROWS UNBOUNDED PRECEDING)
),
good AS (
    SELECT r, rank, kind, a, a + length(v) AS b FROM placed WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN list_max(list_transform(string_split(v, '.'), lambda p: CASE WHEN length(ltrim(p, '0')) > 3 THEN 999 ELSE ('0' || ltrim(p, '0'))::INTEGER END)) <= 255
        WHEN 'card' THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
            CASE WHEN i % 2 = 1 THEN reverse(digits)[i]::INTEGER WHEN reverse(digits)[i]::INTEGER > 4 THEN 2 * reverse(digits)[i]::INTEGER - 9 ELSE 2 * reverse(digits)[i]::INTEGER END)) % 10 = 0
        ELSE length(digits) BETWEEN 10 AND 15 END
),
listed AS (
    SELECT r, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, rank) AS spans,
        count(*) FILTER (rank = 0) AS n_email, count(*) FILTER (rank = 1) AS n_ip, count(*) FILTER (rank = 2) AS n_card, count(*) FILTER (rank = 3) AS n_phone
    FROM good GROUP BY r
)
SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone,
    sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""

#: All pairs; on the table that it is held against the search finds all that are nearest.
_NEAREST = """
WITH v AS (
    SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda e: e IS NULL OR isnan(e) OR isinf(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0
),
pairs AS (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.x, c.x), lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda s, y: s + y)) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_CHAT = r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
    UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(length('<|im_start|>') + length(role) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first,
    row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST) AS nth FROM d),
t AS (SELECT *, first IS NULL OR nth = 1 AS whole FROM f)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN whole THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN NOT whole THEN first END AS refers_to FROM t
"""

#: CRC-32 by its table of bytes; costs from the last turn to the first, then letters from the first to the last.
_REPAIR = r"""
WITH RECURSIVE bits(n, k, v) AS (
    SELECT n, 0, n::BIGINT FROM range(256) r(n) UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8
),
crc AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
told AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS said FROM conversations),
fated AS (
    SELECT told.*, xor(list_reduce(list_transform(string_split(said, ''), lambda c: ord(c)::BIGINT), lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS fate FROM told, crc
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
    FROM fated WHERE fate <> 0
),
placed AS (
    SELECT *, left(role, 1) AS ini, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
    FROM damaged
),
turns AS (
    SELECT *, CASE WHEN shown = '' THEN 'b' WHEN again THEN 'd' WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
        lag(ini) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM placed
),
counts AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
        count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
    FROM turns GROUP BY conv_id
),
priced AS (SELECT conv_id, i, ini, role, text, fault IN ('', 't') AS free, CASE WHEN fault = 't' THEN 1 ELSE 0 END AS cut FROM turns),
-- what the rest costs after nothing, a system turn, a user's, an assistant's
rest(conv_id, i, c) AS (
    SELECT conv_id, n + 1, [0, 4, 2, 0] FROM counts
    UNION ALL
    SELECT conv_id, i, [least(b[1], 2 + b[3], 4 + b[4]), least(b[2], 2 + b[3], 4 + b[4]), least(b[3], 2 + b[4]), least(b[4], 2 + b[3])] FROM (
        SELECT p.conv_id, p.i, [
            least(3 + c[1], CASE WHEN free THEN least(2 + cut + c[3], CASE ini WHEN 's' THEN cut + c[2] WHEN 'u' THEN cut + c[3] END) END),
            least(3 + c[2], CASE WHEN free THEN least(2 + cut + c[3], CASE ini WHEN 'u' THEN cut + c[3] END) END),
            least(3 + c[3], CASE WHEN free THEN least(2 + cut + c[4], CASE ini WHEN 'a' THEN cut + c[4] END) END),
            least(3 + c[4], CASE WHEN free THEN least(2 + cut + c[3], CASE ini WHEN 'u' THEN cut + c[3] END) END)] AS b
        FROM rest r JOIN priced p ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND p.i = r.i - 1
    )
),
steps AS (
    SELECT a.conv_id, a.i, a.c, b.c AS d, ini, role, text, free, cut, p.i IS NULL AS ended
    FROM rest a LEFT JOIN rest b ON b.conv_id IS NOT DISTINCT FROM a.conv_id AND b.i = a.i + 1 LEFT JOIN priced p ON p.conv_id IS NOT DISTINCT FROM a.conv_id AND p.i = a.i
),
walk(conv_id, i, q, audit, lines) AS (
    SELECT conv_id, 1::BIGINT, 1, '', []::VARCHAR[] FROM counts
    UNION ALL
    SELECT conv_id, CASE WHEN letter = 'I' THEN i ELSE i + 1 END, to_, audit || letter,
        CASE letter WHEN 'D' THEN lines WHEN 'K' THEN list_append(lines, role || ':' || text) ELSE list_append(lines, CASE to_ WHEN 3 THEN 'user:' ELSE 'assistant:' END || CASE letter WHEN 'R' THEN text ELSE '' END) END
    FROM (
        SELECT *, CASE letter WHEN 'D' THEN q WHEN 'K' THEN CASE ini WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END ELSE [3, 3, 4, 3][q] END AS to_ FROM (
            SELECT w.conv_id, w.i, w.q, audit, lines, ini, role, text, CASE
                WHEN NOT ended AND 3 + d[q] = c[q] THEN 'D'
                WHEN 2 + c[[3, 3, 4, 3][q]] = c[q] THEN 'I'
                WHEN free AND cut + CASE WHEN ini = 's' AND q = 1 THEN d[2] WHEN ini = 'u' AND q <> 3 THEN d[3] WHEN ini = 'a' AND q = 3 THEN d[4] END = c[q] THEN 'K'
                ELSE 'R' END AS letter
            FROM walk w JOIN steps s ON s.conv_id IS NOT DISTINCT FROM w.conv_id AND s.i = w.i WHERE NOT (ended AND c[q] = 0)
        )
    )
),
fixed AS (SELECT w.conv_id, gaps, blank, duplicate, truncated, illegal, w.audit, w.lines, r.c[1]::BIGINT AS cost
    FROM counts k JOIN walk w ON w.conv_id IS NOT DISTINCT FROM k.conv_id AND w.i = n + 1 AND w.q IN (1, 4) JOIN rest r ON r.conv_id IS NOT DISTINCT FROM k.conv_id AND r.i = 1)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN fixed f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
"""

#: Others have no SQL: their tests compare them with brute force on small tables.
SQL: dict[str, str] = {"op3_pii": _ENTITIES, "op5_mixing": _POISSON, "op8_nearest": _NEAREST, "op9_chat": _CHAT, "op10_lines": _LINES, "op11_repair": _REPAIR, "op13_warc": _WARC}

"""The operators applied to whole test tables, with the columns their contracts name; SQL where it can say the same."""

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gabarito.llm.common import table
from gabarito.llm.decontamination import find_benchmark_words, is_contaminated, n_hit
from gabarito.llm.jaccard_join import near_duplicates
from gabarito.llm.language_id import fold, identify_languages, train_on_sample
from gabarito.llm.periodic_runs import find_runs, listed, strongest, with_repeated_tail
from gabarito.llm.pieces import encode_texts
from gabarito.llm.secret_scan import KINDS, base_spans, scan_secrets, written
from gabarito.llm.sharding import shuffle_into_shards
from gabarito.llm.token_counts import count_tokens
from gabarito.llm.top_k import top_products
from gabarito.llm.toxicity import learn_toxicity, score_toxicity
from gabarito.llm.warc import read_archives, write_archives
from gabarito.llm.whitening import whiten
from gabarito.llm.winnowing import edited_by_next, written as written_prints
from gabarito.staging import scratch_path

QUERIES = {}
SQL = {}

TOKENIZERS = os.environ.get("GABARITO_TOKENIZERS", "/opt/tokenizers")
PIECES = f"{TOKENIZERS}/piece_bpe_32k.model"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op5_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded and decoded."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_texts(docs, PIECES, keep_text=False).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        digest(F.concat_ws(",", F.col("ids").cast("array<string>"))).alias("ids_sha256"),
        digest(F.col("decoded")).alias("decoded_sha256"),
    )


QUERIES["op5_pieces"] = op5_pieces


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a 13-word window of the benchmark."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_benchmark_words(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        digest(F.array_join("items", ",")).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


QUERIES["op9_decontamination"] = op9_decontamination
SQL["op9_decontamination"] = r"""
WITH doc_words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
item_windows AS (
    SELECT DISTINCT item, least(13, len(words)) AS size, array_to_string(words[i : i + 12], ' ') AS pattern
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM item_words WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
    SELECT doc_id, size, i, array_to_string(words[i : i + size - 1], ' ') AS pattern
    FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM doc_words, sizes WHERE len(words) >= size)),
found AS (SELECT doc_id, i, size, item FROM doc_windows JOIN item_windows USING (size, pattern)),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


def n_of(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document; a source is an owner, and each of its documents a repository."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = scan_secrets(docs, keep_text=False)
    return found.select(
        "doc_id",
        *[n_of(kind).alias(f"n_{kind}") for kind in KINDS],
        digest(written(base_spans())).alias("base_sha256"),
        written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("long").alias("n_live"),
    )


QUERIES["op7_secrets"] = op7_secrets
SQL["op7_secrets"] = r"""
WITH patterns AS (SELECT * FROM (VALUES
    ('assign', 0, '([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'),
    ('access', 1, 'AKIA[A-Z0-9]{16,}'), ('hex', 2, '[0-9a-f]{24,}'), ('owned', 3, '[A-Za-z0-9+/_-]{20,}')) t(kind, place, pattern)),
gaps AS (
    SELECT doc_id, kind, place, unnest(string_split_regex(coalesce(text, ''), pattern)) AS gap,
        generate_subscripts(string_split_regex(coalesce(text, ''), pattern), 1) AS i
    FROM documents, patterns WHERE regexp_matches(coalesce(text, ''), pattern)),
matches AS (
    SELECT doc_id, kind, place, unnest(regexp_extract_all(coalesce(text, ''), pattern)) AS whole,
        generate_subscripts(regexp_extract_all(coalesce(text, ''), pattern), 1) AS i
    FROM documents, patterns WHERE regexp_matches(coalesce(text, ''), pattern)),
placed AS (
    SELECT doc_id, kind, place, whole, sum(length(gap) + length(whole)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop
    FROM gaps JOIN matches USING (doc_id, kind, place, i)),
valued AS (
    SELECT doc_id, kind, place, CAST(stop - length(whole) AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop,
        CASE WHEN kind = 'assign' THEN regexp_extract(whole, (SELECT pattern FROM patterns WHERE kind = 'assign'), 2) ELSE whole END AS value
    FROM placed),
base AS (SELECT * FROM valued WHERE kind <> 'owned' AND (kind <> 'assign' OR length(value) >= 6)),
candidates AS (
    SELECT * FROM valued v WHERE kind = 'owned' AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = v.doc_id AND b.start < v.stop AND v.start < b.stop)),
held AS (SELECT * FROM base UNION ALL SELECT * FROM candidates),
usage AS (SELECT value, count(DISTINCT source) AS n_owners FROM held JOIN documents USING (doc_id) GROUP BY value),
judged AS (SELECT held.*, n_owners <= 2 AS live FROM held JOIN usage USING (value) WHERE kind <> 'owned' OR n_owners <= 2),
summed AS (
    SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) FILTER (kind <> 'owned') AS base,
        string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place) AS spans
    FROM judged GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live
FROM documents LEFT JOIN summed USING (doc_id)
"""


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text, learned from four fifths of the labelled documents."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 5) == 0
    net = train_on_sample(docs.where(~held_out))
    found = identify_languages(docs.select("doc_id", held_out.alias("held_out"), "text"), net, keep_text=False)
    return found.select("doc_id", "held_out", "lang_pred", "score")


QUERIES["op1_language"] = op1_language


def op8_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents shuffled into 16 shards of equal rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shuffle_into_shards(docs).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


QUERIES["op8_shards"] = op8_shards


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates among all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


QUERIES["op4_jaccard_join"] = op4_jaccard_join
SQL["op4_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, len(words[i : i + 4]) AS size, array_to_string(words[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM words WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (size, shingle)
    WHERE a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (
    SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y),
least_reached AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached ON x = d.doc_id
"""


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC archives, and the archives read back."""
    folder = scratch_path(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


QUERIES["op10_warc"] = op10_warc
SQL["op10_warc"] = """
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS html, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes FROM pages),
held AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS holder FROM sized)
SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
    CASE WHEN holder = page_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN holder <> page_id THEN holder END AS refers_to
FROM held
"""


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from three quarters of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = fold("doc_id", 4) == 2
    machine = learn_toxicity(docs, labels.where(~held_out))
    found = score_toxicity(docs.select("doc_id", held_out.alias("held_out"), "text"), machine, keep_text=False)
    return found.select("doc_id", "held_out", "score", "predicted")


QUERIES["op3_toxicity"] = op3_toxicity


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pre-tokens and unigram tokens of every whole text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, PIECES, keep_text=False).select("doc_id", "n_pretokens", "n_tokens")


QUERIES["op6_token_counts"] = op6_token_counts


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best integer products of every fiftieth vector with all others."""
    return top_products(table(spark, sf_dir, "embeddings"))


QUERIES["op2_top_k"] = op2_top_k
SQL["op2_top_k"] = """
WITH finite AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product([CAST(x AS DOUBLE) for x in q.v], [CAST(x AS DOUBLE) for x in c.v]) AS BIGINT) AS score
    FROM finite q JOIN finite c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
"""


def op11_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text; rows are told apart by file and position."""
    row_key = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
    return edited_by_next(table(spark, sf_dir, "documents"), row_key).select(
        "doc_id",
        "n_chars",
        digest(F.col("edited")).alias("edited_sha256"),
        written_prints(F.col("prints")).alias("fingerprint"),
        written_prints(F.col("edited_prints")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


QUERIES["op11_winnowing"] = op11_winnowing
SQL["op11_winnowing"] = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (ORDER BY doc_id NULLS FIRST) AS place, count(*) OVER () AS n FROM documents),
edits AS (
    SELECT a.place, a.doc_id, a.text, b.place AS next_place,
        substr(a.text, 1, length(a.text) - length(a.text) // 4) || substr(b.text, 1, length(a.text) // 4) AS edited
    FROM docs a JOIN docs b ON b.place = a.place % a.n + 1),
texts AS (SELECT place, 0 AS kind, text FROM edits UNION ALL SELECT place, 1, edited FROM edits),
tokens AS (
    SELECT place, kind, regexp_extract_all(lower(text),
        '[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]|[^\s\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}]{1,16}') AS ts
    FROM texts),
hashed AS (
    SELECT place, kind, len(ts) AS n, i, CAST('0x' || substr(md5(ts[i]), 1, 7) AS BIGINT) AS h
    FROM (SELECT place, kind, ts, unnest(range(1, len(ts) + 1)) AS i FROM tokens)),
rolled AS (
    SELECT place, kind, n, i, h AS h0, lead(h, 1) OVER w AS h1, lead(h, 2) OVER w AS h2, lead(h, 3) OVER w AS h3, lead(h, 4) OVER w AS h4
    FROM hashed WINDOW w AS (PARTITION BY place, kind ORDER BY i)),
grams AS (
    SELECT place, kind, i, ((((h0 * 1000003 + h1) % 2147483647 * 1000003 + h2) % 2147483647 * 1000003 + h3) % 2147483647 * 1000003 + h4) % 2147483647 AS g
    FROM rolled WHERE i <= n - 4
    UNION ALL
    SELECT place, kind, i, CASE n WHEN 1 THEN h0 WHEN 2 THEN (h0 * 1000003 + h1) % 2147483647
        WHEN 3 THEN ((h0 * 1000003 + h1) % 2147483647 * 1000003 + h2) % 2147483647
        ELSE (((h0 * 1000003 + h1) % 2147483647 * 1000003 + h2) % 2147483647 * 1000003 + h3) % 2147483647 END
    FROM rolled WHERE n < 5 AND i = 1),
windows AS (
    SELECT place, kind, i, count(*) OVER (PARTITION BY place, kind) AS m,
        min(g * 4294967296 - i) OVER (PARTITION BY place, kind ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS least
    FROM grams),
prints AS (
    SELECT DISTINCT place, kind, (least + 4294967295) // 4294967296 AS hash,
        (least + 4294967295) // 4294967296 * 4294967296 - least - 1 AS spot
    FROM windows WHERE i <= greatest(m - 7, 1)),
lists AS (
    SELECT place, kind, string_agg(lower(to_hex(CAST(hash AS BIGINT))) || ':' || spot, ' ' ORDER BY spot) AS written, list(DISTINCT hash) AS hashes
    FROM prints GROUP BY place, kind),
whole AS (
    SELECT t.place, t.kind, coalesce(written, '') AS written, coalesce(hashes, []) AS hashes FROM texts t LEFT JOIN lists USING (place, kind)),
judged AS (
    SELECT e.doc_id, e.text, e.edited, o.written AS own, d.written AS other, o.hashes AS a, d.hashes AS b, x.hashes AS c
    FROM edits e JOIN whole o ON o.place = e.place AND o.kind = 0 JOIN whole d ON d.place = e.place AND d.kind = 1
    JOIN whole x ON x.place = e.next_place AND x.kind = 0)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256, own AS fingerprint, other AS edited_fingerprint,
    CASE WHEN len(a) = 0 AND len(b) = 0 THEN 1.0 ELSE len(list_intersect(a, b)) / CAST(len(a) + len(b) - len(list_intersect(a, b)) AS DOUBLE) END AS near_edited,
    CASE WHEN len(a) = 0 AND len(c) = 0 THEN 1.0 ELSE len(list_intersect(a, c)) / CAST(len(a) + len(c) - len(list_intersect(a, c)) AS DOUBLE) END AS near_next
FROM judged
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable embeddings on their eight leading components; the job fails if a deviation exceeds a long."""
    found = whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.withColumn("deviation", F.col("deviation").cast("long")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"
    )


QUERIES["op12_whitening"] = op12_whitening


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every whole text, after the tails of a tenth of the texts were made to repeat."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    text = F.coalesce("text", F.lit(""))
    edited = F.when(h % 10 == 0, with_repeated_tail(text, g, 3 + g % 8)).otherwise(text)
    found = find_runs(table(spark, sf_dir, "documents").select("doc_id", edited.alias("text")), keep_text=False)
    return found.withColumn("best", strongest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        digest(listed(F.col("runs"))).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )


QUERIES["op13_periodic_runs"] = op13_periodic_runs

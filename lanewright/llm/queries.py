"""The registered query of each operator: whole tables, production parameters, digests of the results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewright.llm import bpe, decontaminate, html, lm, merkle, ngram_join, pii, runs, secrets, spotsigs, suffix_dedup, token_files, toxicity
from lanewright.llm.shared import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a window of the benchmark, and the items found."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    size = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    return found.select(
        "doc_id", "n_words", size.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


SQL["op1_decontaminate"] = r"""
WITH lowered AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(list_slice(w, p, p + least(len(w), 10) - 1), ' ') AS k
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM items WHERE len(w) > 0)),
places AS (
  SELECT row, n, p, array_to_string(list_slice(w, p, p + n - 1), ' ') AS k
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM lowered, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT row, p, n, item FROM places JOIN windows USING (n, k)),
hit AS (SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS q FROM found) GROUP BY row),
named AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT row, item FROM found) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM lowered LEFT JOIN hit USING (row) LEFT JOIN named USING (row)
"""


def listed(spans: str) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.concat_ws(",", F.expr(f"transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end))"))


def counted(kind: str, also: str = "true") -> Column:
    return F.expr(f"cast(size(filter(spans, s -> s.kind = '{kind}' and {also})) as bigint)")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: the fixed patterns' and the token-efficiency test's."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(counted(k).alias(f"n_{k}") for k in secrets.KINDS),
        F.sha2(listed("filter(spans, s -> s.kind <> 'random')"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )


@query
def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on all of them."""
    docs = table(spark, sf_dir, "documents")
    words = lm.vocabulary(docs)
    scored = lm.score(docs, words, lm.train(docs, words))
    mean = F.when(F.col("n_words") > 0, F.col("score") / F.col("n_words")).otherwise(0.0)
    return scored.select("doc_id", "n_words", "score", mean.alias("per_word"))


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that strings of 400 bytes repeat, and what is left."""
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
        (F.size("spans") > 0).alias("repeated"),
    )


SQL["op4_suffix_dedup"] = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (
  SELECT row, p, md5(substr(h, 2 * p - 1, 800)) AS k
  FROM (SELECT row, h, unnest(range(1, length(h) // 2 - 398)) AS p FROM texts WHERE length(h) >= 800)),
again AS (
  SELECT row, p FROM starts WHERE k IN (SELECT k FROM starts GROUP BY k HAVING count(*) > 1)),
bytes AS (
  SELECT row, p, substr(h, 2 * p - 1, 2) AS x
  FROM (SELECT row, h, unnest(range(1, length(h) // 2 + 1)) AS p FROM texts WHERE row IN (SELECT row FROM again))),
marked AS (
  SELECT row, p, x, coalesce(max(again.p) OVER (PARTITION BY row ORDER BY p ROWS BETWEEN 399 PRECEDING AND CURRENT ROW), 0) > 0 AS gone
  FROM bytes LEFT JOIN again USING (row, p)),
edges AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY row ORDER BY p), false) AS head FROM marked),
changed AS (
  SELECT row, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_spans,
         sha256(unhex(coalesce(string_agg(x, '' ORDER BY p) FILTER (NOT gone), ''))) AS kept_sha256
  FROM edges GROUP BY row)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       coalesce(kept_sha256, sha256(unhex(h))) AS kept_sha256, coalesce(n_removed, 0) > 0 AS repeated
FROM texts LEFT JOIN changed USING (row)
"""


@query
def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


# the pages' articles hold b and br tags only; "&amp" may lack its semicolon where a title was cut
SQL["op5_html"] = r"""
WITH articles AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*)</article>', 1) AS h FROM pages),
stripped AS (
  SELECT page_id, url, regexp_replace(regexp_replace(h, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS t FROM articles),
decoded AS (
  SELECT page_id, url,
         replace(replace(replace(regexp_replace(t, '&amp;?', chr(1), 'g'), '&quot;', '"'), '&lt;', '<'), '&gt;', '>') AS t
  FROM stripped),
joined AS (SELECT page_id, url, trim(regexp_replace(replace(t, chr(1), '&'), '\s+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM joined
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and their decoded text."""
    return token_digests(bpe.decode(bpe.encode(table(spark, sf_dir, "documents"))))


def token_digests(tokens: DataFrame) -> DataFrame:
    return tokens.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("decoded_sha256"),
    )

@query
def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and how much alike they are."""
    found = spotsigs.robustness(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        F.concat_ws(" ", "fingerprint").alias("fingerprint"), F.concat_ws(" ", "edited_fingerprint").alias("edited_fingerprint"),
        "near_edited", "near_next",
    )


def quoted(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


SQL["op8_spotsigs"] = rf"""
WITH rows AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS FIRST, text NULLS FIRST) AS row, doc_id, coalesce(text, '') AS text
  FROM documents),
after AS (
  SELECT r.*, coalesce(lead(text) OVER (ORDER BY row), first(text) OVER (ORDER BY row)) AS next_text FROM rows r),
edits AS (
  SELECT row, doc_id, text, next_text,
         left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS edited FROM after),
texts AS (SELECT DISTINCT unnest([text, edited]) AS t FROM edits),
words AS (
  SELECT t, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p
  FROM (SELECT t, regexp_extract_all(lower(t), '[\p{{L}}\p{{N}}]+') AS w FROM texts)),
marked AS (
  SELECT *, word IN ({quoted(spotsigs.ANCHORS)}) AS anchor,
         word NOT IN ({quoted([*spotsigs.ANCHORS, *spotsigs.COMMON])}) AS content FROM words),
placed AS (
  SELECT *, count(*) FILTER (content) OVER (PARTITION BY t ORDER BY p) AS k FROM marked),
content AS (SELECT t, k, word FROM placed WHERE content),
signatures AS (
  SELECT DISTINCT a.t, substr(md5(' ' || b.word || ' ' || c.word), 1, 8) AS s
  FROM placed a JOIN content b ON b.t = a.t AND b.k = a.k + 1 JOIN content c ON c.t = a.t AND c.k = a.k + 2
  WHERE a.anchor),
prints AS (
  SELECT texts.t, CASE WHEN count(s) > 0 THEN list(s ORDER BY s)
    ELSE [substr(md5('=' || CASE WHEN regexp_matches(texts.t, '[\p{{L}}\p{{N}}]')
                 THEN ' ' || array_to_string(regexp_extract_all(lower(texts.t), '[\p{{L}}\p{{N}}]+'), ' ') || ' '
                 ELSE texts.t END), 1, 8)] END AS f
  FROM texts LEFT JOIN signatures ON signatures.t = texts.t GROUP BY texts.t)
SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       array_to_string(a.f, ' ') AS fingerprint, array_to_string(b.f, ' ') AS edited_fingerprint,
       len(list_intersect(a.f, b.f)) / (len(a.f) + len(b.f) - len(list_intersect(a.f, b.f)))::DOUBLE AS near_edited,
       len(list_intersect(a.f, c.f)) / (len(a.f) + len(c.f) - len(list_intersect(a.f, c.f)))::DOUBLE AS near_next
FROM edits JOIN prints a ON a.t = text JOIN prints b ON b.t = edited JOIN prints c ON c.t = next_text
"""


@query
def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of every document: its component of links."""
    return ngram_join.similar(table(spark, sf_dir, "documents"))


SQL["op9_ngram_join"] = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT row, array_to_string(list_slice(w, p, p + least(len(w), 5) - 1), ' ') AS s
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM words WHERE len(w) > 0)),
sizes AS (SELECT row, count(*) AS n FROM sets GROUP BY row),
common AS (
  SELECT a.row AS a, b.row AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.row <> b.row GROUP BY a.row, b.row),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.row = a JOIN sizes y ON y.row = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
reach AS (
  SELECT row AS a, row AS b FROM words
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_ids AS (SELECT reach.a AS row, min(words.doc_id) AS component_id FROM reach JOIN words ON words.row = reach.b GROUP BY reach.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM words JOIN least_ids USING (row) LEFT JOIN sizes USING (row)
"""


@query
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: the fixed patterns' and the field's."""
    found = pii.find(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *(counted(k, "s.base").alias(f"n_{k}") for k in pii.KINDS),
        F.sha2(listed("filter(spans, s -> s.base)"), 256).alias("base_sha256"), listed("spans").alias("spans"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text``; in every tenth document, by hash, the words from place a on repeat with period p."""
    hashed = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string")).alias("h"))
    # the words of chosen documents only
    chosen = F.expr(r"if(h % 10 = 0, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0), null)")
    words = hashed.withColumn("w", chosen).withColumns({"g": F.expr("h div 10"), "n": F.expr("nullif(size(w), 0)")})
    words = words.withColumn("a", F.expr("cast(g % n as int)"))
    words = words.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    repeated = F.expr("flatten(array_repeat(slice(w, a + 1, p), cast(ceil((n - a) / p) as int)))")
    planted = F.concat_ws(" ", F.expr("slice(w, 1, a)"), F.slice(repeated, F.lit(1), F.expr("n - a")))
    return words.select("doc_id", F.when(F.expr("n > 0"), planted).otherwise(F.col("text")).alias("text"))


@query
def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in every document, a tenth of which get repetitions."""
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    best = F.expr(
        "aggregate(runs, cast(null as struct<start:bigint,length:bigint,period:bigint>), (b, r) -> "
        "if(b is null or r.length * b.period > b.length * r.period, r, b))"
    )
    lines = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *(F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


# the checksum of a text's bytes (ASCII digits here), bit by bit; its constant is the fixed polynomial
CRC32 = """xor(4294967295::BIGINT, list_reduce(
  list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)),
  lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""

SQL["op11_runs"] = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row, doc_id, {CRC32.format(text="CAST(doc_id AS VARCHAR)")} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
drawn AS (SELECT *, len(w) AS n, h // 10 AS g, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM texts),
words AS (
  SELECT row, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[1 + a + (i - a) % (1 + (n - a) // (3 + g % 8))] ELSE w[1 + i] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM drawn)),
same AS (
  SELECT x.row, x.i, y.i - x.i AS p
  FROM words x JOIN words y ON x.row = y.row AND x.word = y.word AND x.i < y.i
  JOIN drawn ON drawn.row = x.row AND 3 * (y.i - x.i) <= drawn.n),
stretches AS (
  SELECT row, p, min(i) AS s, count(*) + p AS l
  FROM (SELECT *, i - row_number() OVER (PARTITION BY row, p ORDER BY i) AS island FROM same) GROUP BY row, p, island
  HAVING count(*) + p >= greatest(24, 3 * p)),
runs AS (SELECT row, s, l, min(p) AS p FROM stretches GROUP BY row, s, l),
listed AS (
  SELECT row, count(*) AS n_runs, string_agg(concat(s, ',', l, ',', p, chr(10)), '' ORDER BY s, p) AS lines
  FROM runs GROUP BY row),
best AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY row ORDER BY l::DOUBLE / p DESC, s, p) = 1),
dropped AS (SELECT DISTINCT row, unnest(range(s + p, s + l)) AS i FROM runs),
left_over AS (
  SELECT row, string_agg(word, ' ' ORDER BY i) AS rest FROM words ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, s AS start, l AS length, p AS period, 1000 * l // p AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(rest, '')) AS collapsed_sha256
FROM texts LEFT JOIN listed USING (row) LEFT JOIN best USING (row) LEFT JOIN left_over USING (row)
"""


LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by language; a third of them, by hash, claim a changed text."""
    docs = table(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, merkle.leaf([*head, F.expr(LOWERED)]))
    rows = docs.select("doc_id", "lang", merkle.leaf([*head, F.col("text")]).alias("leaf"), changed.alias("claim"))
    found = merkle.manifest(rows, claim="claim")
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def sized(column: str) -> str:
    """A value as SQL text: its number of UTF-8 bytes and itself."""
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE concat(octet_length(encode(CAST({column} AS VARCHAR))), ':', {column}) END"


SQL["op12_merkle"] = rf"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, doc_id, lang, {CRC32.format(text="CAST(doc_id AS VARCHAR)")} % 3 = 0 AS changed,
         concat({sized("doc_id")}, {sized("source")}, {sized("lang")}, {sized("n_chars")}) AS head, text
  FROM documents),
leaves AS (
  SELECT row, doc_id, lang, sha256(concat(head, {sized("text")})) AS leaf,
         CASE WHEN changed THEN sha256(concat(head, {sized(LOWERED)})) END AS claim FROM rows),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY lang) AS size FROM leaves),
own AS (
  SELECT lang, 0 AS level, pos, size, leaf AS d FROM placed
  UNION ALL
  SELECT lang, level + 1, pos // 8, (size + 7) // 8, sha256(string_agg(d, '' ORDER BY pos))
  FROM own WHERE size > 1 GROUP BY lang, level, pos // 8, size),
subroots AS (
  SELECT lang, level, d, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS size
  FROM own WHERE size = 1),
top AS (
  SELECT 0 AS level, pos, size, d FROM subroots
  UNION ALL
  SELECT level + 1, pos // 8, (size + 7) // 8, sha256(string_agg(d, '' ORDER BY pos))
  FROM top WHERE size > 1 GROUP BY level, pos // 8, size),
sides AS (
  SELECT p.row, n.level, n.pos < p.pos // pow(8, n.level)::BIGINT AS before, n.pos, n.d
  FROM placed p JOIN own n ON n.lang IS NOT DISTINCT FROM p.lang AND n.size > 1
    AND n.pos // 8 = p.pos // pow(8, n.level + 1)::BIGINT AND n.pos <> p.pos // pow(8, n.level)::BIGINT
  UNION ALL
  SELECT p.row, s.level + n.level, n.pos < s.pos // pow(8, n.level)::BIGINT, n.pos, n.d
  FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top n ON n.size > 1
    AND n.pos // 8 = s.pos // pow(8, n.level + 1)::BIGINT AND n.pos <> s.pos // pow(8, n.level)::BIGINT),
joined AS (
  SELECT row, level, coalesce(string_agg(d, '' ORDER BY pos) FILTER (before), '') AS l,
         coalesce(string_agg(d, '' ORDER BY pos) FILTER (NOT before), '') AS r
  FROM sides GROUP BY row, level),
heights AS (SELECT lang, s.level + (SELECT max(level) FROM top) AS h FROM subroots s),
fold AS (
  SELECT row, 0 AS level, coalesce(claim, leaf) AS d, h FROM placed JOIN heights ON heights.lang IS NOT DISTINCT FROM placed.lang
  UNION ALL
  SELECT fold.row, fold.level + 1, sha256(concat(l, d, r)), h
  FROM fold LEFT JOIN joined ON joined.row = fold.row AND joined.level = fold.level WHERE fold.level < h),
proofs AS (SELECT row, sha256(string_agg(concat(l, r), '' ORDER BY level)) AS proof FROM joined GROUP BY row)
SELECT p.doc_id, p.leaf, s.d AS subroot, t.d AS root, coalesce(proof, sha256('')) AS proof_sha256,
       f.d AS folded_root, f.d = t.d AS verified
FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang JOIN top t ON t.size = 1
  JOIN fold f ON f.row = p.row AND f.level = f.h LEFT JOIN proofs ON proofs.row = p.row
"""


@query
def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written to files in id order and read back."""
    path = new_path(spark)
    token_files.write(table(spark, sf_dir, "documents"), path)
    found = token_files.read(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))

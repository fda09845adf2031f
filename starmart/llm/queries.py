"""One query per operator over its whole table, with production parameters, and the SQL for those
that SQL can express. The operators keep their own outputs; digests are derived here."""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    ball_tree,
    byte_bpe,
    content_sort,
    cotraining,
    divergence,
    fingerprints,
    histogram_sort,
    language_id,
    licences,
    mixing,
    near_dedup,
    spelling,
    token_counts,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = dedent(sql).strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text."""
    return language_id.identify(table(spark, sf_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score")


@query()
def op2_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document."""
    docs = table(spark, sf_dir, "documents")
    views = cotraining.fit(docs, table(spark, sf_dir, "labels"))
    return cotraining.with_quality(docs, views).select("doc_id", "text_score", "page_score", "score", "keep")


@query()
def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids = byte_bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text")
    return byte_bpe.decode(ids, RANKS, public_tokenizers.PATTERN).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _licence_sql() -> str:
    """Sentences and rules as values. A span of pieces grows while it may still become a known sentence,
    an occurrence of a rule by one sentence in each step."""
    known = ", ".join(f"('{i}', '{text}')" for i, text in licences.SENTENCES.items())
    rules = ", ".join(f"({n}, '{licence}', {step}, '{i}')" for n, (licence, ids) in enumerate(licences.RULES)
                      for step, i in enumerate(ids, 1))
    named = "words"
    for before, after, name in licences.HOLDERS:
        named = f"regexp_replace({named}, '^{before} .+? {after}', '{before} {name} {after}')"

    def goes_on(words: str) -> str:
        return f"({words} IN (SELECT words FROM prefixes)" + "".join(
            f" OR starts_with({words}, '{before} ')" for before, _, _ in licences.HOLDERS) + ")"
    return rf"""
    WITH RECURSIVE known(id, sentence) AS (VALUES {known}), rules(rule, licence, step, id) AS (VALUES {rules}),
    prefixes AS (SELECT DISTINCT array_to_string(list_slice(parts, 1, n), ' ') AS words
                 FROM (SELECT parts, unnest(range(1, len(parts) + 1)) AS n
                       FROM (SELECT string_split(sentence, ' ') AS parts FROM known))),
    cut AS (SELECT row_number() OVER () AS place, doc_id, string_split(regexp_replace(coalesce(text, ''),
                   '([.!?])[ \t\r\x0B\f]+', '\1' || chr(10), 'g'), chr(10)) AS parts FROM documents),
    pieces AS (SELECT place, position, trim(regexp_replace(lower(part),
                      '^[^\pL\pN]*(?:[0-9]{{1,2}}|[a-z])\)|[^\pL\pN]+', ' ', 'g')) AS piece
               FROM (SELECT place, unnest(range(len(parts))) AS position, unnest(parts) AS part FROM cut)),
    spans AS (SELECT place, position, position AS last, piece AS words FROM pieces WHERE {goes_on("piece")}
              UNION ALL
              SELECT s.place, s.position, p.position, s.words || ' ' || p.piece
              FROM spans s JOIN pieces p ON p.place = s.place AND p.position = s.last + 1
              WHERE p.position < s.position + {licences.LONGEST} AND {goes_on("s.words || ' ' || p.piece")}),
    hits AS (SELECT place, position, last, id FROM spans JOIN known ON {named} = sentence),
    grown AS (SELECT place, rule, licence, position AS first, last, 1 AS step
              FROM hits JOIN rules USING (id) WHERE step = 1
              UNION ALL
              SELECT g.place, g.rule, g.licence, g.first, arg_min(h.last, (h.position, h.last)), g.step + 1
              FROM grown g JOIN rules r ON r.rule = g.rule AND r.step = g.step + 1
              JOIN hits h ON h.place = g.place AND h.id = r.id AND h.position > g.last
                         AND h.position <= g.last + {licences.GAP + 1}
              GROUP BY g.place, g.rule, g.licence, g.first, g.last, g.step),
    matches AS (SELECT place, licence FROM grown g
                WHERE step = (SELECT max(step) FROM rules r WHERE r.rule = g.rule)),
    found AS (SELECT place, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences, count(*) AS n
              FROM matches GROUP BY place),
    counted AS (SELECT place, count(*) AS n FROM hits GROUP BY place)
    SELECT doc_id, coalesce(c.n, 0)::INTEGER AS n_known, coalesce(licences, '') AS licences,
           coalesce(f.n, 0)::INTEGER AS n_matches
    FROM cut LEFT JOIN found f USING (place) LEFT JOIN counted c USING (place)
    """


@query(_licence_sql())
def op4_sentence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every text names or contains."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scan(docs).select(
        "doc_id", F.size("sentences").alias("n_known"), F.array_join("licences", ",").alias("licences"),
        F.size("matches").alias("n_matches"))


@query("""
    WITH clean AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
                   WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id,
                      list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
               FROM clean q JOIN clean c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
""")
def op5_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best partners of every 20th vector."""
    return ball_tree.top_k(table(spark, sf_dir, "embeddings"))


@query()
def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.with_token_counts(docs, WORD_BPE).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit")


@query()
def op7_locally_consistent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of an edit of it, and how alike they are."""
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("""
    WITH crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
         lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS t),
    bytes AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, list_transform(
              regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b FROM documents),
    keyed AS (SELECT doc_id, size, xor(list_reduce(b, lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::INT]),
                     4294967295), 4294967295) AS crc FROM bytes, crc_table),
    placed AS (SELECT *, sum(size) OVER (ORDER BY crc, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS before,
                      sum(size) OVER () AS total FROM keyed),
    cut AS (SELECT *, least(15, before * 16 // total)::INTEGER AS shard FROM placed)
    SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY crc, doc_id NULLS FIRST) - 1 AS slot,
           CAST(NULL AS INTEGER) AS grown_shard
    FROM cut
""")
def op8_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return histogram_sort.shard_by_bytes(docs).drop("text")


@query("""
    WITH sizes AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
    rates AS (SELECT source, n, (SELECT sum(n) FROM sizes)::DOUBLE * 1.0 / (SELECT count(*) FROM sizes)::DOUBLE / n AS rate
              FROM sizes),
    blocks AS (SELECT source, unnest(range(1, greatest(1, ceil(rate / 64))::BIGINT + 1)) AS b,
                      rate / greatest(1, ceil(rate / 64)) AS r FROM rates),
    terms AS (SELECT source, b, k, exp(-r) AS zero, r,
                     CASE WHEN k = 0 THEN exp(-r) ELSE exp(k * ln(r) - r - lgamma(k + 1)) END AS p
              FROM blocks, range(0, 201) t(k)),
    cumulated AS (SELECT source, b, list(c ORDER BY k) AS cs FROM (
                  SELECT source, b, k, sum(p) OVER (PARTITION BY source, b ORDER BY k) AS c FROM terms)
                  GROUP BY source, b),
    drawn AS (SELECT d.doc_id, d.source, sum(len(list_filter(cs, lambda c: c <=
                  ('0x' || substr(md5('17|' || coalesce(d.doc_id::VARCHAR, '') || '|' || md5(coalesce(d.text, ''))
                                      || '|' || b), 1, 13))::BIGINT::DOUBLE / 4503599627370496))) AS n
              FROM (SELECT *, row_number() OVER () AS place FROM documents) d
              JOIN cumulated c ON d.source IS NOT DISTINCT FROM c.source
              GROUP BY d.place, d.doc_id, d.source)
    SELECT doc_id, source, n::BIGINT AS repetitions, unnest(range(1, n::BIGINT + 1)) AS copy FROM drawn
""")
def op9_poisson_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mixture as large as the corpus in which every source has the same share."""
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs).select("doc_id", "source", "repetitions", "copy")


@query(r"""
    WITH RECURSIVE texts AS (SELECT text, min(doc_id) AS node FROM documents WHERE text IS NOT NULL GROUP BY text),
    words AS (SELECT node, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '') AS w FROM texts),
    shingles AS (SELECT DISTINCT node, unnest(list_transform(range(greatest(1, len(w) - 4)),
                        lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s FROM words WHERE len(w) > 0),
    sizes AS (SELECT node, count(*) AS n FROM shingles GROUP BY node),
    shared AS (SELECT a.node AS x, b.node AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
               WHERE a.node < b.node GROUP BY ALL),
    links AS (SELECT x, y FROM shared JOIN sizes a ON a.node = x JOIN sizes b ON b.node = y
              WHERE shared.n >= 0.8 * (a.n + b.n - shared.n)),
    ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reached(node, other) AS (SELECT node, node FROM texts
                             UNION SELECT r.node, b.y FROM reached r JOIN ways b ON b.x = r.other),
    classes AS (SELECT node, min(other) AS class_id FROM reached GROUP BY node)
    SELECT d.doc_id, coalesce(c.class_id, d.doc_id) AS class_id
    FROM documents d LEFT JOIN texts t ON d.text = t.text LEFT JOIN classes c USING (node)
""")
def op10_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near copies that every document belongs to."""
    return near_dedup.near_classes(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "class_id")


@query("""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
""")
def op12_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the one that stays of each group of equal texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return content_sort.with_copies(docs, drop_text=True)


@query(r"""
    WITH docs AS (SELECT row_number() OVER () AS place, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    tokens AS (SELECT place, lang, source, unnest(terms) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS lang_n FROM tokens GROUP BY lang, term HAVING count(DISTINCT place) >= 30),
    langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
    own AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
    totals AS (SELECT lang, source, sum(n) AS total FROM own GROUP BY ALL),
    cells AS (SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
                     1 + 1000000000::HUGEINT * (coalesce(o.n, 0) + 5) // (coalesce(t.total, 0) + 5 * v) AS p,
                     1 + 1000000000::HUGEINT * (lang_n + 5) // (lang_total + 5 * v) AS q
              FROM groups g JOIN kept k USING (lang) JOIN langs USING (lang)
              LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source
              LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
             FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
              FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM cells WHERE n > 0 AND p > q),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
               FROM (FROM pairs UNION ALL FROM terms))
    SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the sources of each language differ, and in which terms."""
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


@query(r"""
    WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce(range(8),
         lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n)) AS t),
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text,
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents),
    counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    summed AS (SELECT run, n, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(id || ':' || run)), '..'),
                      lambda h: ('0x' || h)::BIGINT), lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::INT]),
                      4294967295), 4294967295) AS h FROM counted, crc_table),
    slipped AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT)
                       || substr(run, (h % length(run))::INT + 2) ELSE run END AS word FROM summed),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
    less AS (SELECT word, n, i, left(word, i::INT) || substr(word, i::INT + 2) AS part
             FROM words, unnest(range(length(word))) t(i)),
    pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM less a JOIN less b
              ON a.part = b.part AND a.i = b.i AND a.word <> b.word
              UNION SELECT a.word, a.n, b.word, b.n FROM words a JOIN less b ON a.word = b.part
              UNION SELECT b.word, b.n, a.word, a.n FROM words a JOIN less b ON a.word = b.part),
    best AS (SELECT word, count(*) AS n_near, max(other_n) AS best_n,
                    arg_min(other, {'n': -other_n, 'other': other}) AS best FROM pairs GROUP BY word),
    found AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * n THEN best END AS form,
                     CASE WHEN best_n >= 10 * n THEN best_n END AS form_n FROM words LEFT JOIN best USING (word)),
    ways(word, place, form) AS (SELECT word, word, form FROM found
                             UNION ALL SELECT w.word, f.word, f.form FROM ways w JOIN found f ON f.word = w.form)
    SELECT word, f.form, w.place AS root, n, n_near, form_n FROM found f JOIN ways w USING (word) WHERE w.form IS NULL
""")
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all texts, and the more frequent word that each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))

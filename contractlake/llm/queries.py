"""One query per operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from contractlake.llm.bpe import decode_ids, encode_texts, token_count
from contractlake.llm.common import staged, table, utf8, word_count
from contractlake.llm.curriculum import mix_sources, training_order
from contractlake.llm.ego_join import embedding_classes
from contractlake.llm.host_rules import judge_documents
from contractlake.llm.lexical import SQL_TERM, search
from contractlake.llm.packing import pack_documents
from contractlake.llm.qda import document_statistics, fit_statistics, held_out, score_statistics
from contractlake.llm.rendezvous import shard_slots
from contractlake.llm.settings import (
    MAX_BITS,
    MIX_WEIGHTS,
    PATTERN,
    QUALITY_THRESHOLD,
    SHINGLE,
    VOCABULARY,
)
from contractlake.llm.simhash import simhash_classes
from contractlake.llm.suffix import remove_repeats
from contractlake.llm.url_filter import Rule, fit_urls, judge_urls
from contractlake.llm.warc import MAIN, assemble, read_warc, write_warc
from contractlake.llm.whitening import whitened_rows
from contractlake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Words of a text in SQL.
SQL_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def register(sql: str | None = None):
    def add(query):
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE[query.__name__] = sql
        return query

    return add


def _sql_rates() -> str:
    parts = []
    for name in ("short", "repeats", "symbols", "dup_lines"):
        mean = f"((sum({name}) OVER () + 0.5) / (sum(n) OVER () + 1))"
        parts.append(f"{mean} AS {name}_mean")
    return ", ".join(parts)


def _sql_rate(name: str) -> str:
    drawn = f"({name}_mean * (1 - {name}_mean))"
    between = f"({name}_spread - (hosts - 1) * {drawn}) / documents"
    strength = f"(CASE WHEN {between} > 0 THEN least(greatest({drawn} / ({between}) - 1, 1.0), 1e6) ELSE 1e6 END)"
    return f"({name} + {name}_mean * {strength}) / (n + {strength})"


_NAMES = ("short", "repeats", "symbols", "dup_lines")


@register(
    rf"""
    WITH words AS (
      SELECT *, {SQL_WORDS} AS w, string_split(coalesce(text, ''), chr(10)) AS lines,
             row_number() OVER () AS row FROM documents
    ), windows AS (
      SELECT row, i, count(*) OVER (PARTITION BY row, a, b, c) AS times
      FROM (SELECT row, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
            FROM (SELECT row, w, unnest(range(1, len(w) - 1)) AS i FROM words))
    ), again AS (
      SELECT row, count(DISTINCT place) AS n_repeat_words
      FROM (SELECT row, unnest([i, i + 1, i + 2]) AS place FROM windows WHERE times > 1) GROUP BY row
    ), features AS (
      SELECT doc_id, source, len(w)::bigint AS n_words,
        coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint AS word_chars,
        len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::bigint AS n_symbols,
        len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::bigint AS n_lines,
        len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::bigint
          - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::bigint AS n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint AS n_repeat_words
      FROM words LEFT JOIN again USING (row)
    ), flags AS (
      SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
        100 * n_symbols > 10 * n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
      FROM features
    ), hosts AS (
      SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({x}) AS {x}" for x in _NAMES)}
      FROM flags WHERE source IS NOT NULL GROUP BY source
    ), means AS (
      SELECT *, count(*) OVER () AS hosts, sum(n) OVER () AS documents, {_sql_rates()} FROM hosts
    ), spreads AS (
      SELECT *, {", ".join(f"sum(n * ({x} / n - {x}_mean) ** 2) OVER () AS {x}_spread" for x in _NAMES)} FROM means
    ), verdicts AS (
      SELECT source, greatest({", ".join(_sql_rate(x) for x in _NAMES)}) <= 0.5 AS host_kept FROM spreads
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      short OR repeats AS base_failed, NOT (short OR repeats) AND coalesce(host_kept, true) AS kept,
      source, host_kept
    FROM flags LEFT JOIN verdicts USING (source)
    """
)
def op1_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by their own counts and their source's verdict."""
    return judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", F.col("host").alias("source"), "host_kept",
    )


@register()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by a model fitted on the labels that are not held out."""
    found = staged(document_statistics(table(spark, sf_dir, "documents")), "statistics")
    model = fit_statistics(found, table(spark, sf_dir, "labels").where(~held_out()))
    scored = found.select("doc_id", score_statistics(model, F.col("statistics")).alias("score"))
    predicted = (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


SHARDS = 40


def _sql_shard(shards: int) -> str:
    """The lowest cost over the shards, from k1 and k2."""
    return f"""list_min(list_transform(range({shards}), lambda s:
        struct_pack(c := -ln((((((((k1 + s * 1234567891) % p) * ((k1 + s * 1234567891) % p) + k2) % p)
        * ((((k1 + s * 1234567891) % p) * ((k1 + s * 1234567891) % p) + k2) % p)) + k1 + s) % p + 0.5) / p),
        s := s))).s::integer"""


@register(
    f"""
    WITH crc_table AS (
      SELECT list_transform(range(256), lambda b: list_reduce(
        range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, b)) AS t
    ), keyed AS (
      SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, hex(encode(coalesce(text, ''))) AS bytes,
             md5(coalesce(doc_id::varchar, 'null')) AS m, 2147483647::bigint AS p
      FROM documents
    ), crc AS (
      SELECT doc_id, size, p, m,
             ('0x' || substr(m, 1, 8))::bigint % p AS k1, ('0x' || substr(m, 9, 8))::bigint % p AS k2,
             xor(list_reduce(
               list_transform(range(length(bytes) // 2), lambda i: ('0x' || substr(bytes, 2 * i + 1, 2))::bigint),
               lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]),
               4294967295::bigint), 4294967295::bigint) AS text_crc32
      FROM keyed, crc_table
    ), placed AS (
      SELECT doc_id, size, text_crc32, m, {_sql_shard(SHARDS)} AS shard, {_sql_shard(SHARDS + 1)} AS grown_shard
      FROM crc
    )
    SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
           row_number() OVER (PARTITION BY shard ORDER BY m, doc_id, size, text_crc32) - 1 AS slot
    FROM placed
    """
)
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards by their doc_id."""
    records = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(utf8(F.col("text"))) + 16).cast("long").alias("size"),
        F.crc32(utf8(F.col("text"))).alias("text_crc32"),
    )
    slots = shard_slots(records, "doc_id", SHARDS)
    return slots.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


# Rules of the URL query, and the small labelled table its model is fitted on: hosts with words
# that sell something or track someone, and ordinary hosts, under the same subdomains and paths. None
# of them is a host of the given pages, which are there to be judged.
URL_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]
BLOCK_HOSTS = (
    "casino-royal best-casino win-big-casino casinos-online poker-win winner-poker jackpot-win slots-online free-slots "
    "free-spins spin-free bets-now sports-bets bets-online best-bets betting-free lottery-winner cheap-meds cheap-viagra "
    "cheap-loans cheap-replica pills-online diet-pills pills-now pharma-pills free-pills adult-cams adult-video adult-chat xxx-adult "
    "ads-click click-ads popup-ads ads-server my-ads track-click track-user ad-tracker web-track clicks-track "
    "spam-links spam-blast spam-mail email-spam link-farm content-farm farm-links click-farm"
).split()
ALLOW_HOSTS = (
    "news weather library school museum gardening history science cooking travel music river mountain research "
    "university parliament health sports theatre painting railway harbour village thand thingth "
    "tionth tionand tioner thionen herton inghere theand enthe erthion ontion reshth ndther therein thenth"
).split()


def labelled_urls(spark: SparkSession) -> DataFrame:
    """Every host under each subdomain, language and end that URLs here have, in turn."""
    rows = []
    for block, hosts in ((1, BLOCK_HOSTS), (0, ALLOW_HOSTS)):
        for i, host in enumerate(hosts):
            for j, (sub, lang, end) in enumerate(
                (("", "en", ""), ("www.", "fr", "/"), ("m.", "de", ".html"), ("blog.", "es", "?page=2"))
            ):
                top = ("com", "net", "org")[(i + j) % 3]
                rows.append((f"https://{sub}{host}.example.{top}/{lang}/{37 * i + 911 * j}{end}", block))
    return spark.createDataFrame(rows, "url string, block int")


@register()
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL by the rules, else by the fitted model."""
    return judge_urls(table(spark, sf_dir, "pages"), "page_id", URL_RULES, fit_urls(labelled_urls(spark)))


@register(
    f"""
    WITH sized AS (
      SELECT doc_id, source, len({SQL_WORDS})::bigint AS size,
             md5(coalesce(doc_id::varchar, 'null')) AS m
      FROM documents
    ), ranked AS (
      SELECT source, sum(size)::bigint AS source_size,
             row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS source_rank
      FROM sized GROUP BY source
    ), weighted AS (
      SELECT *, [5, 2, 1][source_rank % 3 + 1]::bigint AS weight FROM ranked
    ), turns AS (
      SELECT *, row_number() OVER f AS turn,
        sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
      FROM weighted WINDOW f AS (ORDER BY source_size / weight, source_rank)
    ), start AS (
      SELECT turn AS first_turn, rest, weights FROM turns
      WHERE rest * weight <= 3 * source_size * weights ORDER BY turn LIMIT 1
    ), targets AS (
      SELECT t.source, t.source_rank, t.source_size,
        CASE WHEN first_turn IS NULL OR turn < first_turn THEN (3 * source_size)::double
             ELSE start.rest::bigint * weight / start.weights::bigint END AS target
      FROM turns t LEFT JOIN start ON true
    ), placed AS (
      SELECT doc_id, size, source_size, source_rank, target, floor(target + 0.5)::bigint AS demand,
        coalesce(sum(size) OVER (PARTITION BY source_rank ORDER BY m, doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::bigint AS first
      FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
    ), rates AS (
      SELECT *, [1.0, 2.0, 3.0][source_rank % 3 + 1]::double AS r0,
             [3.0, 2.0, 1.0][source_rank % 3 + 1]::double AS r1 FROM placed
    )
    SELECT doc_id, size, source_size, target,
      list_sum(list_transform([0, 1, 2], lambda e: greatest(0, least(size, demand - first - e * source_size))))::bigint AS taken,
      CASE WHEN size > 0 AND first < demand THEN round(least(1.0,
        (first / demand) * (r0 + r1) / (r0 + sqrt(r0 * r0 + (r1 - r0) * (first / demand) * (r0 + r1)))), 9) END AS first_position
    FROM rates
    """
)
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1, their placements written in training order; words
    taken and the first training position."""
    documents = table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("key"), "source", word_count(F.col("text")).alias("size")
    )
    # Equal documents are told apart by a number that is fixed once it is written.
    mixed = staged(
        mix_sources(documents, MIX_WEIGHTS).withColumn("row", F.monotonically_increasing_id()), "mixed"
    )
    ordered = staged(training_order(mixed.select("key", "row", "placements")), "order")
    read = ordered.groupBy("row").agg(F.sum("words").alias("words"), F.min("position").alias("first"))
    return mixed.join(read, "row", "left").select(
        F.col("key").alias("doc_id"), "size", "source_size", "target",
        F.coalesce("words", F.lit(0).cast("long")).alias("taken"), F.round("first", 9).alias("first_position"),
    )


@register()
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the class that links of 3 bits or fewer reach."""
    classes = simhash_classes(table(spark, sf_dir, "documents"), "doc_id", SHINGLE, MAX_BITS)
    return classes.select("doc_id", "fingerprint", "component_id")


@register()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, cut into pieces of 1024 tokens at most, in as few sequences as best fit needs."""
    return pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, PATTERN)


@register(
    """
    WITH digests AS (
      SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
    ), bits AS (
      SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS owner,
        row_number() OVER (PARTITION BY hex ORDER BY page_id DESC NULLS LAST) AS place,
        list_reduce(list_transform(range(40), lambda i: lpad(bin(('0x' || substr(hex, i + 1, 1))::bigint), 4, '0')),
                    lambda a, b: a || b) AS bits
      FROM digests
    )
    SELECT page_id, payload_bytes,
      list_reduce(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        list_reduce(list_transform(range(5), lambda j: substr(bits, 5 * i + j + 1, 1)::bigint), lambda a, b: 2 * a + b) + 1, 1)),
        lambda a, b: a || b) AS payload_digest,
      CASE WHEN place = 1 OR page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
      CASE WHEN place > 1 AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to,
      true AS has_request
    FROM bits
    """
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back, one row per capture; a null page_id is the smallest."""
    path = scratch_dir(spark, "warc")
    captures = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("key"), "url", F.col("html").alias("payload")
    )
    write_warc(captures, path)
    key = F.regexp_extract(F.col("metadata.payload").cast("string"), r"capture-key: ([^\r]*)", 1)
    mains = read_warc(spark, path, kinds=MAIN)
    found = assemble(read_warc(spark, path, payloads=False), strict=True, mains=mains)
    held = F.octet_length("main.payload").cast("long")
    flat = staged(
        found.select(
            "capture_id", key.try_cast("long").alias("page_id"),
            "main.record_type", "main.payload_digest", held.alias("payload_bytes"),
            F.col("request").isNotNull().alias("has_request"), F.col("original.record_id").alias("original"),
        ),
        "captures",
    )
    originals = flat.select(
        F.col("capture_id").alias("original"), F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("original_bytes"),
    )
    return flat.join(originals, "original", "left").select(
        "page_id", F.coalesce("original_bytes", "payload_bytes").alias("payload_bytes"), "payload_digest",
        "record_type", "refers_to", "has_request",
    )


@register(
    """
    WITH RECURSIVE usable AS (
      SELECT vec_id, label, embedding::double[] AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ), links AS (
      SELECT a.vec_id AS u, b.vec_id AS v FROM usable a JOIN usable b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
       AND list_cosine_similarity(a.e, b.e) >= 0.98
    ), reach AS (
      SELECT vec_id AS u, vec_id AS v FROM embeddings
      UNION
      SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u
    ), least AS (
      SELECT u AS vec_id, min(v) AS component_id FROM reach GROUP BY u
    ), counts AS (
      SELECT u AS vec_id, count(*) AS n FROM links GROUP BY u
    )
    SELECT vec_id, coalesce(n, 0)::bigint AS n_links, component_id, vec_id = component_id AS kept
    FROM least LEFT JOIN counts USING (vec_id)
    """
)
def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with the number of its links at cosine 0.98 within its label, and its class."""
    return embedding_classes(table(spark, sf_dir, "embeddings"))


@register()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 200-byte strings that start anywhere else as well."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = remove_repeats(documents, "doc_id", length=200, first_stays=False)
    return left.select(
        "row.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )


@register()
def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text to ids and back."""
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), VOCABULARY)
    sized = encoded.select(
        "row.doc_id", token_count(F.col("ids")).alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    return decode_ids(sized, VOCABULARY).select("row.*", F.sha2(utf8(F.col("text")), 256).alias("decoded_sha256"))


@register()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector on the 32 directions of largest variance, each scaled to variance 1."""
    found = whitened_rows(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select(
        "row.vec_id", "component", "n", F.col("deviation").cast("long").alias("deviation"), "whitened", "explained",
        "identity_error",
    )


_SQL_TERMS = f"""regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SQL_TERM}')"""


@register(
    f"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, doc_id, {_SQL_TERMS} AS terms FROM documents
    ), counted AS (
      SELECT doc, term, count(*) AS tf FROM (SELECT doc, unnest(terms) AS term FROM docs) GROUP BY doc, term
    ), held AS (
      SELECT term, count(*) AS df FROM counted GROUP BY term
    ), sizes AS (
      SELECT count(*) FILTER (len(terms) > 0) AS n_all, sum(len(terms))::bigint AS l_all FROM docs
    ), items AS (
      SELECT row_number() OVER () AS item, item_id, {_SQL_TERMS} AS terms FROM benchmark
    ), asked AS (
      SELECT DISTINCT item, item_id, term FROM (SELECT item, item_id, unnest(terms) AS term FROM items)
    ), scores AS (
      SELECT item, item_id, doc_id, doc, sum(
        floor(1000 * ln((2 * n_all + 2)::double / (2 * df + 1)::double))::bigint
        * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(docs.terms) * n_all) // l_all))))::bigint AS score
      FROM asked JOIN held USING (term) JOIN counted USING (term) JOIN docs USING (doc), sizes
      GROUP BY item, item_id, doc_id, doc
    )
    SELECT item_id, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::integer AS rank,
           doc_id, score
    FROM scores WHERE score > 0
    QUALIFY rank <= 50
    """
)
def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents of highest score for every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    return corpus_pipeline.run(spark, sf_dir)

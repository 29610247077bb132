"""The operators as registered queries over whole tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, language, license, manifest, mixing, packing, quality, rules, sharding, simhash, toxicity, whitening
from .common import held_out, read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Bytes of a shard in the registered query: small, so that the given tables are divided too.
SHARD_BYTES = 1 << 20


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return function

    return register


def rank_file(name: str = "byte_bpe_multi_50k.tiktoken") -> tuple[bytes, str]:
    """A public rank file's content and the pattern that goes with it. It is read once, by the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes(), public_tokenizers.PATTERN


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.learn(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"
HASH_SQL = "('0x' || substr(md5(concat_ws(':', doc_id, text)), 1, 15))::BIGINT"


@query(
    "op2_source_mixing",
    f"""
    WITH d AS (SELECT doc_id, source, ({WORDS_SQL})::BIGINT AS size, {HASH_SQL} AS h FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
    w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM s),
    r AS (
        SELECT *, coalesce(sum(source_size) OVER before, 0)::DOUBLE AS size_before,
               (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS weight_left,
               1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS everything
        FROM w
        WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ),
    q AS (SELECT *, (everything - 2.0::DOUBLE * size_before) / weight_left AS rate FROM r),
    p AS (SELECT *, 2.0::DOUBLE * source_size <= rate * weight AS stops FROM q),
    t AS (
        SELECT source, source_size,
               CASE WHEN stops THEN 2.0::DOUBLE * source_size
                    ELSE (SELECT arg_max(rate, weight_left) FROM p WHERE NOT stops) * weight END AS target
        FROM p
    ),
    b AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies,
               target - copies * source_size AS budget
        FROM t
    ),
    c AS (
        SELECT d.source, d.h, sum(d.size)::BIGINT AS at_hash,
               (sum(sum(d.size)) OVER (PARTITION BY d.source ORDER BY d.h))::BIGINT AS upto
        FROM d GROUP BY d.source, d.h
    ),
    e AS (
        SELECT b.source, min(c.h) AS edge, arg_min(c.at_hash, c.h) AS at_hash, arg_min(c.upto, c.h) AS upto
        FROM b JOIN c ON b.source IS NOT DISTINCT FROM c.source AND c.upto > b.budget GROUP BY b.source
    ),
    g AS (
        SELECT b.*, CASE WHEN b.budget <= 0 THEN 0 WHEN e.edge IS NULL THEN 1152921504606846976
                         ELSE e.edge + (e.upto - b.budget < b.budget - (e.upto - e.at_hash))::INT END AS below
        FROM b LEFT JOIN e ON b.source IS NOT DISTINCT FROM e.source
    )
    SELECT d.doc_id, d.size, g.source_size, g.target, d.size * (g.copies + (d.h < g.below)::INT) AS taken
    FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


@query("op3_simhash_near_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


@query("op4_license_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(read_table(spark, sf_dir, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.learn(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.grade(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "severity", "grade", "toxic")


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = language.identify(docs.select("doc_id", "text"), language.learn(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    judged = rules.judge(docs.select("doc_id", "text"), rules.reference(docs))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*base, "nearest", "class_distance", "word_distance", "word_limit")


def token_digests(docs: DataFrame) -> DataFrame:
    """Numbers and digests of the ids of each text, and the digest of what they decode to.

    Null and empty texts have no ids and the digests of nothing. Repeated rows get equal results, an empty table gives no
    row, and other columns do not matter.
    """
    ranks, pattern = rank_file()
    both = bpe.round_trip(docs.select("doc_id", "text"), ranks, pattern, unassigned=bpe.newer_characters())
    count = (F.octet_length("ids") / 4).cast("long")
    return both.select("doc_id", count.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op8_byte_level_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(read_table(spark, sf_dir, "documents"))


@query(
    "op9_sharding",
    f"""
    WITH d AS (SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS bytes, {HASH_SQL} AS h FROM documents),
    n AS (
        SELECT depth, h >> (60 - depth) AS prefix, sum(bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows, min(h) AS low, max(h) AS high
        FROM d, generate_series(0, 60) AS levels(depth) GROUP BY ALL
    ),
    f AS (
        SELECT x.h, min(n.depth) AS depth FROM (SELECT DISTINCT h FROM d) x
        JOIN n ON n.prefix = x.h >> (60 - n.depth) AND (n.shard_bytes <= {SHARD_BYTES} OR n.low = n.high) GROUP BY x.h
    )
    SELECT d.doc_id, d.bytes, CASE WHEN f.depth = 0 THEN '' ELSE lpad(bin(n.prefix), f.depth::INT, '0') END AS shard,
           f.depth::INT AS depth, n.shard_bytes, n.shard_rows
    FROM d JOIN f USING (h) JOIN n ON n.depth = f.depth AND n.prefix = d.h >> (60 - f.depth)
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read_table(spark, sf_dir, "documents"), SHARD_BYTES)


@query("op10_nearest_neighbours")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"))


@query(
    "op11_merkle_manifest",
    r"""
    WITH RECURSIVE polynomial(b, step, c) AS (
        SELECT b, 0, b::BIGINT FROM range(256) AS t(b)
        UNION ALL SELECT b, step + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM polynomial WHERE step < 8
    ),
    crc_table AS (SELECT list(c ORDER BY b) AS crc FROM polynomial WHERE step = 8),
    d AS (SELECT *, row_number() OVER () AS row_id, doc_id::VARCHAR AS id FROM documents),
    f AS (
        SELECT row_id, doc_id, lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered, text,
               coalesce(xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(id, '')]),
                                        lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295) % 3 = 0, false) AS tampered,
               concat(coalesce(strlen(id) || ':' || id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS fields
        FROM d, crc_table
    ),
    h AS (
        SELECT row_id, doc_id, lang, sha256(fields || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
               CASE WHEN tampered THEN sha256(fields || coalesce(strlen(lowered) || ':' || lowered, '-'))
                    ELSE sha256(fields || coalesce(strlen(text) || ':' || text, '-')) END AS now
        FROM f
    ),
    l AS (
        SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS total FROM h
    ),
    tree(lang, level, n, i, digest) AS (
        SELECT lang, 0, total, place, leaf FROM l
        UNION ALL
        SELECT lang, level + 1, (n + 7) // 8, i // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM tree WHERE n > 1 GROUP BY lang, level, n, i // 8
    ),
    runs AS (SELECT lang, level, i // 8 AS run, list(digest ORDER BY i) AS members FROM tree WHERE n > 1 GROUP BY ALL),
    sub AS (
        SELECT lang, digest AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place, count(*) OVER () AS total FROM tree WHERE n = 1
    ),
    top(level, n, i, digest) AS (
        SELECT 0, total, place, subroot FROM sub
        UNION ALL
        SELECT level + 1, (n + 7) // 8, i // 8, sha256(string_agg(digest, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY level, n, i // 8
    ),
    top_runs AS (SELECT level, i // 8 AS run, list(digest ORDER BY i) AS members FROM top WHERE n > 1 GROUP BY ALL),
    low(row_id, lang, level, n, i, proof, folded) AS (
        SELECT row_id, lang, 0, total, place, '', now FROM l
        UNION ALL
        SELECT w.row_id, w.lang, w.level + 1, (w.n + 7) // 8, w.i // 8,
               w.proof || array_to_string(r.members[:w.i % 8] || r.members[w.i % 8 + 2:], ''),
               sha256(array_to_string(r.members[:w.i % 8] || [w.folded] || r.members[w.i % 8 + 2:], ''))
        FROM low w JOIN runs r ON r.lang IS NOT DISTINCT FROM w.lang AND r.level = w.level AND r.run = w.i // 8 WHERE w.n > 1
    ),
    high(row_id, level, n, i, proof, folded) AS (
        SELECT low.row_id, 0, s.total, s.place, low.proof, low.folded FROM low JOIN sub s ON s.lang IS NOT DISTINCT FROM low.lang WHERE low.n = 1
        UNION ALL
        SELECT w.row_id, w.level + 1, (w.n + 7) // 8, w.i // 8,
               w.proof || array_to_string(r.members[:w.i % 8] || r.members[w.i % 8 + 2:], ''),
               sha256(array_to_string(r.members[:w.i % 8] || [w.folded] || r.members[w.i % 8 + 2:], ''))
        FROM high w JOIN top_runs r ON r.level = w.level AND r.run = w.i // 8 WHERE w.n > 1
    )
    SELECT l.doc_id, l.leaf, s.subroot, (SELECT digest FROM top WHERE n = 1) AS root, sha256(g.proof) AS proof_sha256,
           g.folded AS folded_root, g.folded = (SELECT digest FROM top WHERE n = 1) AS verified
    FROM l JOIN sub s ON s.lang IS NOT DISTINCT FROM l.lang JOIN high g ON g.row_id = l.row_id AND g.n = 1
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return manifest.manifest(docs, manifest.lowered(), manifest.chosen()).drop("path")


def token_file(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer file's content. It is read once, by the driver."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


@query("op12_best_fit_packing")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(read_table(spark, sf_dir, "documents"), token_file())


@query("op13_embedding_whitening")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whitening(read_table(spark, sf_dir, "embeddings"))
    # A value that needs more than 64 bits (of some billion rows, say) stays exact in the operator's decimal; here it is null.
    return white.withColumn("deviation", F.expr("try_cast(deviation AS bigint)")).drop("size")

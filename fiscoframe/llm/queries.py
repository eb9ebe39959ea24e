"""The operators of this subpackage as queries over a table folder, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, html_text, langid, licenses, merkle, mixing, near_dedup, periodic, pieces, quality, simhash, token_files, toxicity
from .common import table


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizers keep a file; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, folder, "documents"))


def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return token_files.token_files(table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_report(table(spark, folder, "documents"))


def op5_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op6_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixture(table(spark, folder, "documents"))


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_classes(table(spark, folder, "documents"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.license_scan(table(spark, folder, "documents"))


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Where 7 divides the crc32 of the id, the leaf is computed again with another n_chars and must not verify."""
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    changed = F.when(tampered, merkle.leaf_digest(n_chars=F.col("n_chars") + 1))
    rows = merkle.manifest(table(spark, folder, "documents"), changed=changed)
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce("changed", "leaf"), F.col("steps")))
    proof = F.sha2(merkle.proof(F.col("steps")), 256).alias("proof_sha256")
    return rows.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def with_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text; where 10 divides the crc32 of the id, the words from a place on repeat a few of them periodically.

    With h the crc32, g = floor(h / 10) and n words: a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    rows = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.floor(h / 10).alias("g"))
    rows = rows.withColumn("n", F.size("words")).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)
    place = F.sequence(F.lit(0).cast("long"), F.col("n") - F.lit(1).cast("long"))
    edited = F.transform(place, lambda i: F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("n") > 0, F.array_join(edited, " ")).otherwise(F.col("text")).alias("text"))


def op12_periodic(spark: SparkSession, folder: str) -> DataFrame:
    rows = periodic.periodic_runs(with_repeats(table(spark, folder, "documents")))
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = rows.select("doc_id", "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.array_join(lines, "").alias("lines"))
    length, period = F.col("best.length"), -F.col("best.short")
    return rows.select(
        "doc_id",
        "n_runs",
        (-F.col("best.back")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.languages(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality,
        op2_exact_dedup,
        op3_token_files,
        op4_fingerprints,
        op5_pieces,
        op6_html_text,
        op7_mixing,
        op8_toxicity,
        op9_near_dedup,
        op10_licenses,
        op11_manifest,
        op12_periodic,
        op13_language,
    )
}

SQL: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents),
             g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM n JOIN g USING (body)""",
    "op11_manifest": """
        WITH RECURSIVE
        ids AS (SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR) AS s FROM documents WHERE doc_id IS NOT NULL),
        crc AS (SELECT doc_id, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::BIGINT)),
                  lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda k: k::BIGINT)), lambda x, k: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS c FROM ids),
        f AS (SELECT row_number() OVER () AS r, d.doc_id, lang, coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS a,
                n_chars::BIGINT AS n, coalesce(strlen(text) || ':' || text, '-') AS z, coalesce(xor(c, 4294967295::BIGINT) % 7 = 0, false) AS tampered
              FROM documents d LEFT JOIN crc ON d.doc_id = crc.doc_id),
        l AS (SELECT r, doc_id, lang, sha256(a || coalesce(strlen(n::VARCHAR) || ':' || n, '-') || z) AS leaf,
                sha256(a || coalesce(strlen((n + tampered::INT)::VARCHAR) || ':' || (n + tampered::INT), '-') || z) AS held FROM f),
        p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
        t(lang, lvl, pos, h, n) AS (
          SELECT lang, 0, pos, leaf, count(*) OVER (PARTITION BY lang) FROM p
          UNION ALL SELECT lang, lvl + 1, pos // 2, string_agg(h, '' ORDER BY pos).sha256(), (any_value(n) + 1) // 2 FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2),
        s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, lvl AS height FROM t WHERE n = 1),
        u(lvl, pos, h, n) AS (
          SELECT 0, pos, subroot, count(*) OVER () FROM s
          UNION ALL SELECT lvl + 1, pos // 2, string_agg(h, '' ORDER BY pos).sha256(), (any_value(n) + 1) // 2 FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
        g(r, lvl, pos, h, proof, lang, height, top) AS (
          SELECT r, 0, CASE WHEN s.height = 0 THEN s.pos ELSE p.pos END, held, '', p.lang, s.height, s.pos FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang
          UNION ALL
          SELECT r, lvl + 1, CASE WHEN lvl + 1 = height THEN top ELSE pos // 2 END, sha256(CASE WHEN b IS NULL THEN h WHEN pos % 2 = 1 THEN b || h ELSE h || b END), proof || coalesce(b, ''), lang, height, top
          FROM (SELECT g.*, coalesce(t.h, u.h) AS b FROM g
                LEFT JOIN t ON g.lvl < height AND t.lvl = g.lvl AND t.lang IS NOT DISTINCT FROM g.lang AND t.pos = xor(g.pos, 1)
                LEFT JOIN u ON g.lvl >= height AND u.lvl = g.lvl - height AND u.pos = xor(g.pos, 1)
                WHERE g.lvl < height + (SELECT max(lvl) FROM u)) AS below),
        e AS (SELECT r, h, proof FROM g WHERE lvl = height + (SELECT max(lvl) FROM u))
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, e.h AS folded_root, e.h = root AS verified
        FROM p JOIN s ON p.lang IS NOT DISTINCT FROM s.lang JOIN e USING (r) CROSS JOIN (SELECT h AS root FROM u WHERE n = 1) AS o""",
}

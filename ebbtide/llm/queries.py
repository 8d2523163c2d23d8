"""The registered queries of the operators: production parameters, whole tables, full results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.llm import decontaminate, exact_dedup, hard_negatives, merkle, ngram_join, packing, secret_scan, substring_dedup, suffix_dedup, token_files, toxicity, url_filter, warc
from ebbtide.llm.common import lower_ascii, table, written
from ebbtide.session import scratch_path


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.cut(table(spark, sf_dir, "documents")).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(pieces).select(
        F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removal(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.removal(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def _held_out(doc_id) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = toxicity.scored(docs, labels, ~_held_out(labels["doc_id"]), columns=["doc_id"])
    return found.select(
        "doc_id", _held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


URL_RULES = [
    url_filter.Rule("block", "net", "/"),
    url_filter.Rule("allow", "example.net", "/en/"),
    url_filter.Rule("block", "example.com", "/de/"),
    url_filter.Rule("allow", "org", "/fr/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path)
    documents = token_files.read_token_files(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return token_files.with_start(written(documents, "token-digests")).select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "archive")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.read_warc(spark, path)
    digest = F.when(F.col("payload").isNull(), F.regexp_replace("digest", "^sha1:", "")).otherwise(
        warc.sha1_base32(F.col("payload"))
    )
    return found.select(
        warc.page_number(F.col("record_id")).alias("page_id"), "payload_bytes", digest.alias("payload_digest"),
        "record_type", warc.page_number(F.col("refers_to")).alias("refers_to"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(vectors["vec_id"] % 7 == 0, (vectors["label"] + 1) % 10).otherwise(vectors["label"])
    return hard_negatives.mine(vectors, F.col("id") % 100 == 0, label)


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda spans: F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])))
    return found.select(
        "doc_id", of("assign"), of("access"), of("hex"), F.sha2(text("base"), 256).alias("base_sha256"), text("found").alias("spans")
    )


MANIFEST_CELLS = ["doc_id", "source", "lang", "n_chars", "text"]


def _tampered_with(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 0


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampering = merkle.Tampering(_tampered_with(docs["doc_id"]), {"text": lower_ascii(docs["text"])})
    found = merkle.folded(docs, "doc_id", "lang", MANIFEST_CELLS, tampering)
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified"
    )


def operator_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_decontamination": op2_decontamination,
        "op3_ngram_join": op3_ngram_join,
        "op4_suffix_dedup": op4_suffix_dedup,
        "op5_substring_dedup": op5_substring_dedup,
        "op6_toxicity": op6_toxicity,
        "op7_url_filter": op7_url_filter,
        "op8_token_files": op8_token_files,
        "op9_warc": op9_warc,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_secret_scan": op12_secret_scan,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def merkle_statement(levels: int = 9) -> str:
    """The manifest level by level, for trees of up to 8 ** ``levels`` leaves; crc32 bit by bit is a table here."""

    def up(name: str, first: str) -> str:
        """Levels ``name``0 to ``name``<levels> of nodes (tree, pos, digest, nodes, before, after)."""
        out = [f"{name}0 AS ({first})"]
        for k in range(1, levels + 1):
            out.append(f"""{name}{k} AS (
                SELECT tree, pos // 8 AS pos, sha256(string_agg(digest, '' ORDER BY pos)) AS digest
                FROM {name}{k - 1} JOIN (SELECT tree, count(*) AS nodes FROM {name}{k - 1} GROUP BY tree) USING (tree)
                WHERE nodes > 1 GROUP BY ALL
                UNION ALL
                SELECT tree, pos, digest FROM {name}{k - 1}
                JOIN (SELECT tree, count(*) AS nodes FROM {name}{k - 1} GROUP BY tree) USING (tree) WHERE nodes = 1)""")
        for k in range(levels + 1):
            out.append(f"""{name}w{k} AS (
                SELECT *, count(*) OVER (PARTITION BY tree) AS nodes,
                       coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                       coalesce(string_agg(digest, '') OVER (PARTITION BY tree, pos // 8 ORDER BY pos
                           ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
                FROM {name}{k})""")
        return ", ".join(out)

    def walk(name: str, nodes: str, first: str) -> str:
        """Rows (n, tree, pos, digest, proof) on their way up the levels of ``nodes``."""
        out = [f"{name}0 AS ({first})"]
        for k in range(levels):
            out.append(f"""{name}{k + 1} AS (
                SELECT r.n, r.tree, CASE WHEN w.nodes > 1 THEN r.pos // 8 ELSE r.pos END AS pos,
                       CASE WHEN w.nodes > 1 THEN sha256(w.before || r.digest || w.after) ELSE r.digest END AS digest,
                       CASE WHEN w.nodes > 1 THEN r.proof || w.before || w.after ELSE r.proof END AS proof
                FROM {name}{k} r JOIN {nodes}w{k} w ON r.tree = w.tree AND r.pos = w.pos)""")
        return ", ".join(out)

    cell = lambda c: f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaf = lambda text: "sha256(" + " || ".join([cell(c) for c in ("doc_id", "source", "lang", "n_chars")] + [cell(text)]) + ")"
    return f"""
        WITH RECURSIVE hashed AS (
            SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf('text')} AS leaf, {leaf(lowered)} AS changed,
                   CAST(doc_id AS VARCHAR) AS name
            FROM documents),
        crc(doc_id, name, k, value) AS (
            SELECT DISTINCT doc_id, name, 0, 4294967295::BIGINT FROM hashed WHERE doc_id IS NOT NULL
            UNION ALL
            SELECT doc_id, name, k + 1,
                   (SELECT list_reduce(list_prepend(xor(value, ascii(substr(name, k + 1, 1))), range(8)),
                           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))
            FROM crc WHERE k < length(name)),
        marked AS (
            SELECT row_number() OVER (ORDER BY tree, h.doc_id NULLS FIRST, leaf) AS n, h.doc_id, tree, leaf,
                   CASE WHEN xor(value, 4294967295) % 3 = 0 THEN changed ELSE leaf END AS used,
                   row_number() OVER (PARTITION BY tree ORDER BY h.doc_id NULLS FIRST, leaf) - 1 AS pos
            FROM hashed h LEFT JOIN crc c ON h.doc_id = c.doc_id AND k = length(c.name)),
        {up("low", "SELECT tree, pos, leaf AS digest FROM marked")},
        {up("top", f"SELECT '' AS tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, digest FROM low{levels}")},
        places AS (SELECT tree, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, digest FROM low{levels}),
        {walk("climb", "low", "SELECT n, tree, pos, used AS digest, '' AS proof FROM marked")},
        {walk("over", "top", f"SELECT n, '' AS tree, p.pos, c.digest, c.proof FROM climb{levels} c JOIN places p USING (tree)")}
        SELECT m.doc_id, m.leaf, p.digest AS subroot, t.digest AS root, sha256(o.proof) AS proof_sha256,
               o.digest AS folded_root, o.digest = t.digest AS verified
        FROM marked m JOIN places p USING (tree) JOIN over{levels} o USING (n) CROSS JOIN top{levels} t
    """


def operator_statements() -> dict[str, str]:
    return {
        "op10_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
        """,
        "op11_hard_negatives": """
            WITH cells AS (
                SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                       unnest(embedding) AS x, unnest(range(len(embedding))) AS dim, len(embedding) AS dims
                FROM embeddings
                WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                  AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
            whole AS (SELECT vec_id, label, dim, dims, CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM cells),
            scores AS (
                SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS label, CAST(sum(a.x * b.x) AS BIGINT) AS score
                FROM whole a JOIN whole b ON a.dims = b.dims AND a.dim = b.dim WHERE a.vec_id % 100 = 0 GROUP BY ALL),
            positives AS (
                SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE id <> anchor_id AND label = own
                QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
            SELECT anchor_id, positive_id,
                   CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
                   id AS negative_id, positive_score, score AS negative_score
            FROM positives JOIN scores USING (anchor_id)
            WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
            QUALIFY rank <= 10
        """,
        "op13_merkle_manifest": merkle_statement(),
    }

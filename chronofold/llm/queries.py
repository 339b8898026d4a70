"""The operators over the whole `documents` table, with the columns that their contracts name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.llm.bpe import decode_documents, encode_documents
from chronofold.llm.centroids import cluster
from chronofold.llm.conversations import damaged, repair, report
from chronofold.llm.exact_dedup import duplicate_owners
from chronofold.llm.language import identify
from chronofold.llm.mixing import mix_sources
from chronofold.llm.packing import pack_documents
from chronofold.llm.quality import score_quality
from chronofold.llm.revisits import canonical_url, resolve_revisits
from chronofold.llm.secrets import scan_secrets
from chronofold.llm.simhash import near_duplicates
from chronofold.llm.suffix import remove_repeats
from chronofold.llm.syncmers import fingerprint_documents

TOKENIZER = {
    "tokenizer": public_tokenizers.path("byte_bpe_50k.json"),
    "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken"),
    "pattern": public_tokenizers.PATTERN,
}


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fold(doc_id: str, folds: int, number: int) -> Column:
    """Whether a row belongs to a fold, by the CRC-32 of its id as text; a null id is an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds == number


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(documents(spark, sf_dir))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, totals = mix_sources(documents(spark, sf_dir))
    return totals.drop("key")


def op3_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are the pages in order of page_id. A page without html, or with that of an earlier page of its URL, came back not modified.

    Its date is its id and its last modification the first id of its URL with that html; full responses also have a type and a
    length, revisits a length of 0, which must not replace that of the response. Merged headers come as sorted lines of text.
    """
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    etag = F.sha2(F.coalesce("html", F.lit("")), 256)
    captures = pages.select(
        F.col("page_id").alias("id"), "url", F.col("page_id").alias("time"), F.when(F.col("html") != "", etag).alias("etag"), F.octet_length("html").alias("length")
    )  # fmt: skip
    first = captures.groupBy(canonical_url(F.col("url")).alias("u"), F.col("etag").alias("e")).agg(F.min("id").alias("first_id"))
    seen = captures.join(first, canonical_url(F.col("url")).eqNullSafe(F.col("u")) & F.col("etag").eqNullSafe(F.col("e")))
    revisit = F.col("etag").isNull() | (F.col("id") > F.col("first_id"))
    modified = F.when(F.col("etag").isNotNull(), F.col("first_id").cast("string"))
    named = {
        "content-length": F.when(revisit, F.lit("0")).otherwise(F.col("length").cast("string")),
        "content-type": F.when(~revisit, F.lit("text/html")),
        "date": F.col("id").cast("string"),
        "etag": F.col("etag"),
        "last-modified": modified,
    }
    headers = F.map_filter(F.create_map(*[c for name, value in named.items() for c in (F.lit(name), value)]), lambda _, v: v.isNotNull())
    status = F.when(revisit, 304).otherwise(200)
    found = resolve_revisits(seen.select("id", "url", "time", status.alias("status"), "etag", modified.alias("last_modified"), headers.alias("headers")))
    lines = F.transform(F.array_sort(F.map_entries("headers")), lambda entry: F.concat(entry["key"], F.lit(": "), entry["value"]))
    return found.withColumn("headers", F.array_join(lines, "\n"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_owners(documents(spark, sf_dir))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~fold("doc_id", 4, 2))
    return score_quality(docs, docs, labels).withColumn("held_out", fold("doc_id", 4, 2))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), **TOKENIZER)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return identify(docs, docs.where(~fold("doc_id", 3, 1))).withColumn("held_out", fold("doc_id", 3, 1))


def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(documents(spark, sf_dir))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, centroids = cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    components = F.sha2(F.array_join(F.col("centroid").cast("array<string>"), ","), 256).alias("centroid_sha256")
    per_cluster = centroids.select("cluster", "cluster_inertia", "inertia", components)
    return placed.join(F.broadcast(per_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decode_documents(encode_documents(documents(spark, sf_dir), TOKENIZER["tokenizer"]), TOKENIZER["tokenizer"])
    ids = F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256)
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), ids.alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dropped = damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    return report(repair(rows, absent=dropped)).withColumnRenamed("conv", "conv_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_source_mix,
        op3_revisits,
        op4_simhash,
        op5_exact_dedup,
        op6_repeats,
        op7_quality,
        op8_packing,
        op9_language,
        op10_syncmers,
        op11_clusters,
        op12_bpe,
        op13_conversations,
    )
}


def _repair_sql() -> str:
    """Every conversation from its last row to its first: the least (cost, audit, lines) from each of the four states.

    States: nothing yet, after the system turn, after a user turn, after an assistant turn. CRC-32 is worked out bit by bit.
    """
    names = {0: "user", 1: "user", 2: "assistant", 3: "user"}
    then = {0: 2, 1: 2, 2: 3, 3: 2}

    def option(to: int, cost: str, letter: str, line: str, allowed: str = "true") -> str:
        dear = f"g{to}.c + {cost} + CASE WHEN {allowed} THEN 0 ELSE 1000000 END"
        return f"{{'c': {dear}, 'a': '{letter}' || g{to}.a, 't': {line} || g{to}.t}}"

    def rows_from(q: int) -> str:
        kept = "role || ':' || text || chr(10)"
        short = "CASE WHEN fault = 1 THEN 3 ELSE 0 END"
        own = f"fault < 2 AND initial = '{names[q][0]}'"
        options = [
            option(q, "4", "D", "''"),
            option(then[q], short, "K", kept, own),
            option(then[q], f"3 + {short}", "R", f"'{names[q]}:' || text || chr(10)", "fault < 2"),
        ]
        if q == 0:
            options.append(option(1, short, "K", kept, "fault < 2 AND initial = 's'"))
        return f"list_min([{', '.join(options)}]) AS g{q}"

    step = f"SELECT conv, i, {', '.join(map(rows_from, range(4)))} FROM (SELECT dp.* REPLACE (r.i AS i), r.role, r.text, r.fault, r.initial FROM dp JOIN rows r ON r.conv IS NOT DISTINCT FROM dp.conv AND r.i = dp.i - 1)"
    for _ in range(3):
        inserted = (f"""list_min([g{q}, {option(then[q], "3", "I", f"'{names[q]}:' || chr(10)")}]) AS g{q}""" for q in range(4))
        step = f"SELECT conv, i, {', '.join(inserted)} FROM ({step})"
    return rf"""
        WITH RECURSIVE source AS (
            SELECT conv_id AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
            FROM conversations
        ), numbered AS (
            SELECT *, xor(list_reduce(
                list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda c: ascii(c)::BIGINT)),
                lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                    lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))
            ), 4294967295::BIGINT) % 20 AS kind
            FROM source
        ), damaged AS (
            SELECT conv, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
            FROM (SELECT *, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy FROM numbered WHERE kind <> 0)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
        ), rows AS (
            SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
                   NOT regexp_matches(text, '[^ 	-]') AS blank,
                   row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 AS again,
                   NOT regexp_matches(text, '[.!?][ 	-]*$') AS short,
                   CASE WHEN blank OR again THEN 2 WHEN short THEN 1 ELSE 0 END AS fault
            FROM placed
        ), dp AS (
            SELECT conv, max(i) + 1 AS i, {{'c': 0, 'a': '', 't': ''}} AS g0,
                   {{'c': 6, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:' || chr(10)}} AS g1,
                   {{'c': 3, 'a': 'I', 't': 'assistant:' || chr(10)}} AS g2, {{'c': 0, 'a': '', 't': ''}} AS g3
            FROM rows GROUP BY conv
            UNION ALL
            {step}
        ), counts AS (
            SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                   count(*) FILTER (NOT blank AND again) AS duplicate, count(*) FILTER (NOT blank AND NOT again AND short) AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM rows GROUP BY conv
        )
        SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(g0.c, 0)::BIGINT AS cost,
               coalesce(g0.a, '') AS audit, sha256(left(coalesce(g0.t, ''), greatest(length(coalesce(g0.t, '')) - 1, 0))) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) o
        LEFT JOIN counts c ON c.conv IS NOT DISTINCT FROM o.conv_id
        LEFT JOIN (SELECT * FROM dp WHERE i = 1) d ON d.conv IS NOT DISTINCT FROM o.conv_id
    """


def _clusters_sql(rounds: int = 5) -> str:
    """The rounds written out: centroids c0, assignment a1, centroids c1, and so on."""
    far = "list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    parts = [
        """kept AS (
            SELECT vec_id, row_number() OVER () AS own, list_transform(embedding, lambda x: floor(256::DOUBLE * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS c, v FROM kept
            ORDER BY sha256('2:' || vec_id), v LIMIT 40
        )"""
    ]
    for n in range(rounds + 1):
        parts.append(f"""a{n} AS MATERIALIZED (
            SELECT own, any_value(vec_id) AS vec_id, any_value(v) AS v, min((far, c)).c AS c, min((far, c)).far AS far
            FROM (SELECT k.*, c.c, {far} AS far FROM kept k, c{n} c) GROUP BY own
        )""".replace("min((far, c))", "min({'far': far, 'c': c})"))
        if n < rounds:
            parts.append(f"""m{n} AS (
                SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY d) AS v FROM (
                    SELECT c, d, sum(x)::BIGINT AS s, count(*) AS n
                    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM a{n}) GROUP BY c, d)
                GROUP BY c
            ), c{n + 1} AS MATERIALIZED (SELECT c{n}.c, coalesce(m{n}.v, c{n}.v) AS v FROM c{n} LEFT JOIN m{n} USING (c))""")
    return f"""
        WITH {", ".join(parts)}
        SELECT vec_id, a{rounds}.c::INTEGER AS cluster, far AS distance, sum(far) OVER (PARTITION BY a{rounds}.c)::BIGINT AS cluster_inertia,
               sum(far) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (c)
    """


ORACLE_SQL = {
    "op2_source_mix": r"""
        WITH sizes AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents
        ), sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src
            FROM sizes GROUP BY source
        ), weighed AS (
            SELECT *, CASE src % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources
        ), filled AS (
            SELECT *, row_number() OVER fullness AS place, sum(source_size) OVER () AS total,
                   3 * coalesce(sum(source_size) OVER (fullness ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken_up,
                   sum(weight) OVER (fullness ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight
            FROM weighed WINDOW fullness AS (ORDER BY source_size / weight, src)
        ), levels AS (
            SELECT *, (total - taken_up)::DOUBLE / open_weight::DOUBLE AS level FROM filled
        ), open_level AS (
            SELECT arg_min(level, place) AS level FROM levels WHERE 3 * source_size > level * weight
        ), targets AS (
            SELECT source, src, source_size,
                   least(3.0::DOUBLE * source_size, coalesce((SELECT level FROM open_level) * weight, 3.0::DOUBLE * source_size)) AS target
            FROM weighed
        ), placed AS (
            SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS want,
                   coalesce(sum(size) OVER (PARTITION BY src ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
                                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
            FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
        )
        SELECT doc_id, size, source_size, target::DOUBLE AS target,
               (greatest(0, least(size, want - start)) + greatest(0, least(size, want - source_size - start))
                + greatest(0, least(size, want - 2 * source_size - start)))::BIGINT AS taken
        FROM placed
    """,
    "op3_revisits": r"""
        WITH plain AS (
            SELECT page_id, html, regexp_replace(trim(url), '#.*$', '') AS p FROM pages
        ), parts AS (
            SELECT page_id, html, p, regexp_replace(p, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*', '') AS rest,
                   regexp_replace(regexp_replace(lower(regexp_extract(p, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?]*)', 1)), '://[^@]*@', '://'),
                                  '^(http://[^:]*):80$|^(https://[^:]*):443$', '\1\2') AS host
            FROM plain
        ), captures AS (
            SELECT page_id, CASE WHEN host = '' THEN p WHEN starts_with(rest, '/') THEN host || rest ELSE host || '/' || rest END AS u,
                   CASE WHEN html <> '' THEN sha256(html) END AS etag, strlen(html)::VARCHAR AS length
            FROM parts
        ), seen AS (
            SELECT *, min(page_id) OVER (PARTITION BY u, etag) AS first_id FROM captures
        ), judged AS (
            SELECT *, etag IS NULL OR page_id > first_id AS revisit FROM seen
        ), dated AS (
            SELECT *, max(CASE WHEN NOT revisit THEN page_id END) OVER (PARTITION BY u ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
            FROM judged
        ), joined AS (
            SELECT d.*, r.etag AS full_etag, r.first_id AS full_first, r.length AS full_length,
                   d.revisit AND d.u IS NOT NULL AND r.page_id IS NOT NULL AND coalesce(d.etag = r.etag, true)
                   AND (d.etag IS NULL OR d.first_id = r.first_id) AS resolved
            FROM dated d LEFT JOIN judged r ON r.page_id = d.before
        )
        SELECT page_id AS id, u AS canonical_url, revisit, CASE WHEN NOT revisit THEN page_id WHEN resolved THEN before END AS resolved_id,
               NOT revisit OR resolved AS valid,
               concat_ws(chr(10), 'content-length: ' || CASE WHEN resolved THEN full_length WHEN revisit THEN '0' ELSE length END,
                         CASE WHEN resolved OR NOT revisit THEN 'content-type: text/html' END, 'date: ' || page_id,
                         'etag: ' || CASE WHEN resolved THEN coalesce(etag, full_etag) ELSE etag END,
                         'last-modified: ' || CASE WHEN resolved AND etag IS NULL THEN full_first WHEN etag IS NOT NULL THEN first_id END) AS headers
        FROM joined
    """,
    "op5_exact_dedup": r"""
        WITH normal AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY content) AS keep_id, count(*) OVER (PARTITION BY content) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY content) AS kept, sha256(content) AS text_sha256
        FROM normal
    """,
    "op11_clusters": _clusters_sql(),
    "op13_conversations": _repair_sql(),
}

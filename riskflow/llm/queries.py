"""The operators on the shared test tables, with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm import decontaminate as D
from riskflow.llm import exact_dedup as X
from riskflow.llm import html, jaccard, licenses, lines, negatives, packing, pii, substring, toxicity, vector_codes, warc
from riskflow.queries.registry import Query, Tables
from riskflow.session import scratch_dir

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = Query(lambda spark, folder: f(Tables(spark, folder)), sql)
        return f

    return add


@query(
    "op10_exact_dedup",
    """
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS s FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, s AS text_sha256
    FROM d
    """,
)
def op10_exact_dedup(t: Tables) -> DataFrame:
    return X.exact_dedup(t["documents"])


@query(
    "op7_warc",
    """
    WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS n, sha256(coalesce(html, '')) AS s FROM pages),
         q AS (SELECT *, min(page_id) OVER (PARTITION BY s) AS lead_id FROM p)
    SELECT page_id, n AS payload_bytes, s AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> lead_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id <> lead_id THEN lead_id END AS refers_to
    FROM q
    """,
)
def op7_warc(t: Tables) -> DataFrame:
    path = scratch_dir(t.spark, "warc")
    warc.write_archive(warc.bodies(t["pages"]), path)
    return warc.described(warc.read_archive(t.spark, path))


@query("op9_toxicity")
def op9_toxicity(t: Tables) -> DataFrame:
    model = toxicity.train(t["documents"], t["labels"])
    return toxicity.score(t["documents"], model).select(
        "doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


@query("op5_packing")
def op5_packing(t: Tables) -> DataFrame:
    pieces = packing.pack(t["documents"])
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "source")


@query(
    "op6_decontamination",
    """
    WITH lower_d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
         lower_b AS (SELECT item_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark),
         d AS (SELECT doc_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lower_d),
         b AS (SELECT item_id, regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM lower_b),
         sized AS (SELECT item_id, w, least(len(w), 13) AS k FROM b WHERE len(w) > 0),
         starts AS (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized),
         windows AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g FROM starts),
         lens AS (SELECT DISTINCT k FROM windows),
         places AS (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lens WHERE len(w) >= k),
         found AS (SELECT p.doc_id, p.i, p.k, x.item_id FROM places p JOIN windows x ON x.k = p.k AND x.g = array_to_string(p.w[p.i:p.i + p.k - 1], ' ')),
         spread AS (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM found),
         hit AS (SELECT doc_id, count(DISTINCT pos) AS n FROM spread GROUP BY doc_id),
         ids AS (SELECT doc_id, list_sort(list_distinct(list(item_id::VARCHAR))) AS l FROM found GROUP BY doc_id)
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(len(ids.l), 0)::BIGINT AS n_items,
           sha256(coalesce(array_to_string(ids.l, ','), '')) AS items_sha256,
           coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(d.w) AS contaminated
    FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
)
def op6_decontamination(t: Tables) -> DataFrame:
    found = D.find_benchmark(t["documents"], t["benchmark"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        D.contaminated().alias("contaminated"),
    )


@query("op3_ngram_jaccard")
def op3_ngram_jaccard(t: Tables) -> DataFrame:
    return jaccard.near_duplicates(t["documents"]).select("doc_id", "n_shingles", "component_id", "copies")


@query("op2_pii")
def op2_pii(t: Tables) -> DataFrame:
    found = pii.personal_data(t["documents"])
    return found.select(
        "doc_id",
        *[pii.counted("base", k).alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(pii.joined("base"), 256).alias("base_sha256"),
        pii.joined("spans").alias("spans"),
    )


@query("op8_html_extraction")
def op8_html_extraction(t: Tables) -> DataFrame:
    return html.main_text(t["pages"]).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query("op1_license_scan")
def op1_license_scan(t: Tables) -> DataFrame:
    """Documents have no paths; source and language stand for directories."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.col("doc_id").cast("string"))
    return licenses.scan(t["documents"].withColumn("path", path))


@query("op4_substring_dedup")
def op4_substring_dedup(t: Tables) -> DataFrame:
    return substring.shared_passages(t["documents"])


@query(
    "op13_line_dedup",
    """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS w FROM documents),
         l AS (SELECT r, doc_id, coalesce(doc_id, 9223372036854775807) AS n, unnest(w) AS line, unnest(range(len(w))) AS i FROM d),
         k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
         g AS (SELECT key, min(n) AS owner FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT n) > 1),
         m AS (SELECT k.*, coalesce(k.n <> g.owner, false) AS dropped FROM k LEFT JOIN g USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM m GROUP BY r, doc_id
    """,
)
def op13_line_dedup(t: Tables) -> DataFrame:
    kept = lines.drop_repeated_lines(t["documents"])
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def codes_sql() -> str:
    """Five assignments and four replacements, written out. Distances are x.x - 2 x.c + c.c of integers, which are exact as doubles."""
    steps = []
    for r in range(5):
        steps.append(
            f"""a{r} AS MATERIALIZED (SELECT u, part, min({{'d': list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), 'e': e}}) AS b
                FROM points JOIN c{r} USING (part) GROUP BY u, part)"""
        )
        if r < 4:
            steps.append(
                f"""m{r} AS (SELECT part, e, list(v::DOUBLE ORDER BY i) AS c FROM (SELECT part, b.e AS e, i, floor(sum(x[i]) / count(*)) AS v
                    FROM a{r} JOIN points USING (u, part), (SELECT unnest(range(1, 1 + (SELECT any_value(len(x)) FROM points))) AS i) GROUP BY ALL) GROUP BY part, e),
                c{r + 1} AS MATERIALIZED (SELECT part, e, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (part, e))"""
            )
    return f"""
    WITH rows AS (SELECT row_number() OVER () AS u, vec_id, label, list_transform(embedding::DOUBLE[], lambda x: floor(1024 * x)) AS v FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         points AS MATERIALIZED (SELECT u, part, v[part * len(v) // 4 + 1:(part + 1) * len(v) // 4] AS x FROM rows, (SELECT unnest(range(4)) AS part)),
         seeds AS (SELECT u, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM rows ORDER BY vec_id LIMIT 256),
         c0 AS MATERIALIZED (SELECT part, e, x AS c FROM seeds JOIN points USING (u)),
         {", ".join(steps)},
         coded AS (SELECT vec_id, label, string_agg(printf('%02x', b.e::INT), '' ORDER BY part) AS code, sum(b.d)::BIGINT AS error
                   FROM rows JOIN a4 USING (u) GROUP BY u, vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY part, e, i)) FROM (SELECT part, e, unnest(c) AS v, unnest(range(len(c))) AS i FROM c4)) AS codebooks_sha256
    FROM coded
    """


@query("op11_vector_codes", codes_sql())
def op11_vector_codes(t: Tables) -> DataFrame:
    coded, books = vector_codes.encode(t["embeddings"])
    digest = F.sha2(F.lit(books.text()).cast("binary"), 256)
    return vector_codes.with_label_error(coded).select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


@query(
    "op12_hard_negatives",
    """
    WITH r AS MATERIALIZED (
             SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                    list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v
             FROM embeddings
             WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
         s AS MATERIALIZED (
             SELECT a.u, a.vec_id AS anchor_id, b.u AS o, b.vec_id AS other_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
             FROM r a JOIN r b ON a.u <> b.u WHERE a.vec_id % 100 = 0),
         p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY u ORDER BY score DESC, other_id) <= 5),
         n AS (SELECT p.u, p.o, p.anchor_id, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id, s.score AS negative_score
               FROM p JOIN s ON s.u = p.u AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
    SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY u, o ORDER BY negative_score DESC, negative_id))::INT AS rank,
           negative_id, positive_score, negative_score
    FROM n QUALIFY rank <= 10
    """,
)
def op12_hard_negatives(t: Tables) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(t["embeddings"].withColumn("label", moved), F.col("vec_id") % 100 == 0)

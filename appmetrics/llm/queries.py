"""The operators applied to the driver's tables; ``ORACLES`` holds their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from appmetrics.functions.scratch import stage
from appmetrics.llm.batches import bound_batches
from appmetrics.llm import (
    hash_forest,
    kd_shards,
    language_filters,
    merkle,
    mixing,
    pairwise_quality,
    pieces,
    pivot_search,
    projection_links,
    repeats,
    simhash,
    url_trust,
    vector_codes,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op3_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    shards = "array_join(transform(parts, r -> concat_ws(':', r.shard, r.to - r.from)), ',') AS shard_words"
    return mixing.mix(docs, keep=("doc_id",)).selectExpr("row.doc_id AS doc_id", "size", "source_size", "target", "taken", shards)


ORACLES["op3_mixing"] = r"""
WITH docs AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    coalesce('s' || source, 'n') AS key, md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(coalesce(text, ''))) AS draw
  FROM documents),
laid AS MATERIALIZED (
  SELECT *, (sum(size) OVER (PARTITION BY key ORDER BY draw, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS start,
    row_number() OVER () AS rowid_ FROM docs),
sizes AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM docs GROUP BY ALL),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank, (sum(source_size) OVER ())::BIGINT AS total,
    3 * source_size AS capacity, count(*) OVER () AS n FROM sizes),
weighted AS (
  SELECT *, [5, 2, 1][((rank - 1) % 3 + 1)::INTEGER] AS weight FROM ranked),
filled AS (SELECT *, capacity / weight::DOUBLE AS fills_at FROM weighted),
ordered AS (
  SELECT *, (sum(capacity) OVER (ORDER BY fills_at, rank ROWS UNBOUNDED PRECEDING) - capacity)::BIGINT AS full_before,
    (sum(weight) OVER (ORDER BY fills_at DESC, rank DESC ROWS UNBOUNDED PRECEDING))::BIGINT AS weight_left FROM filled),
shared AS (SELECT *, (total - full_before) / weight_left::DOUBLE AS share FROM ordered),
targets AS (
  SELECT *, least(weight * max(CASE WHEN share <= fills_at THEN share END) OVER (), capacity::DOUBLE) AS target FROM shared),
houses AS (
  SELECT *, (total // 16) * shard // 8 AS house FROM targets, (SELECT unnest(range(1, 9)) AS shard)),
bounded AS (
  SELECT *,
    CASE WHEN house > n / 2.0::DOUBLE + 1
      THEN floor(target * (house - n / 2.0::DOUBLE - 1) / total + 0.5::DOUBLE)::BIGINT ELSE 0 END AS sure,
    floor(target * (house + n / 2.0::DOUBLE + 1) / nullif(total, 0) + 0.5::DOUBLE)::BIGINT AS possible
  FROM houses),
seats AS (SELECT key, shard, rank, target, unnest(range(sure, possible)) AS q FROM bounded),
free AS (SELECT shard, max(house) - sum(sure) AS seats FROM bounded GROUP BY shard),
won AS (
  SELECT key, shard, count(*) AS won FROM (
    SELECT *, row_number() OVER (PARTITION BY shard ORDER BY target / (2 * q + 1)::DOUBLE DESC, rank, q) AS place FROM seats)
  JOIN free USING (shard) WHERE place <= free.seats GROUP BY ALL),
rings AS (
  SELECT key, shard, source_size, target, blocks, ('0x' || left(md5('mix|' || key), 8))::BIGINT % blocks AS first,
    least(sure + coalesce(won, 0), 3 * blocks)::BIGINT AS upto
  FROM (SELECT *, greatest(ceil(source_size / 16.0)::BIGINT, 1) AS blocks FROM bounded) LEFT JOIN won USING (key, shard)),
cuts AS (
  SELECT key, shard, source_size, target, cut, coalesce(lag(cut) OVER (PARTITION BY key ORDER BY shard), first_cut) AS after FROM (
    SELECT *, (first + upto) // blocks * source_size + least((first + upto) % blocks * 16, source_size) AS cut,
      least(first * 16, source_size) AS first_cut FROM rings)),
parts AS (
  SELECT l.rowid_, c.shard, p, least(greatest(c.cut - l.start - p * c.source_size, 0), l.size) - least(greatest(c.after - l.start - p * c.source_size, 0), l.size) AS words
  FROM laid AS l JOIN cuts AS c USING (key), (SELECT unnest(range(0, 4)) AS p)),
taken AS (
  SELECT rowid_, coalesce(sum(words), 0)::BIGINT AS taken,
    coalesce(string_agg(shard || ':' || words, ',' ORDER BY p, shard) FILTER (words > 0), '') AS shard_words FROM parts GROUP BY rowid_)
SELECT doc_id, size, l.source_size, l.target, taken, shard_words
FROM (SELECT * FROM laid JOIN targets USING (key)) AS l JOIN taken USING (rowid_)
"""


@query
def op4_simhash_near_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = simhash.simhash_groups(docs)
    return found.select(F.col("id").alias("doc_id"), F.expr("lower(lpad(hex(fingerprint), 16, '0'))").alias("fingerprint"), F.col("component").alias("component_id"))


@query
def op6_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.without_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")
    )


def piece_model() -> str:
    """The public model whose pieces the contract asks for."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query
def op2_sentencepiece(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, piece_model(), parts=("packed", "decoded", "covered"))
    return encoded.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        F.sha2("packed", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        F.col("covered").alias("bytes_in_spans"),
    )


# The fold of a document, by its id: what is held out is never learned from.
HELD_OUT = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1, false)"


@query
def op10_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.expr(HELD_OUT))
    filters = language_filters.learn(docs.filter("NOT held_out"))
    return docs.select("doc_id", "held_out", language_filters.identify(filters, F.col("text")).alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score"
    )


@query
def op8_quality_ranking(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", F.expr(HELD_OUT))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    bound_batches(spark)
    # One pass over the texts serves the fit and the scores.
    made = stage(docs.select("doc_id", "held_out", pairwise_quality.feature_array(F.col("text")).alias("values")), "features")
    ranking = pairwise_quality.fit(pairwise_quality.labelled(made.filter("NOT held_out"), labels))
    scored = made.select("doc_id", "held_out", ranking.score("values").alias("score"))
    return scored.select("doc_id", "held_out", "score", F.expr("cast(score >= 0.5D AS int)").alias("predicted"))


@query
def op5_kd_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    # What equal texts have in common, so that copies stay together.
    dimensions = {
        "length": F.log1p(F.octet_length("text")),
        "lang": kd_shards.code_order(F.col("lang")),
        "beyond_ascii": 1 - F.char_length("text") / F.greatest(F.octet_length("text"), F.lit(1)),
    }
    sharded = kd_shards.kd_shards(docs, dimensions, shards=24)
    return sharded.select(
        F.col("id").alias("doc_id"), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@query
def op7_url_trust(spark, sf_dir):
    judged = url_trust.judge(table(spark, sf_dir, "pages").select("page_id", "url", "html"), RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def _rounds_sql(rounds: int) -> str:
    """The rounds of both ranks, one common table each."""
    ctes = ["rank0 AS MATERIALIZED (SELECT layer, host, jump AS rank FROM start)"]
    for i in range(rounds):
        ctes.append(
            f"""rank{i + 1} AS MATERIALIZED (SELECT layer, host, sum(rank) AS rank FROM (
  SELECT s.layer, s.dst AS host, 0.85::DOUBLE * r.rank * s.share AS rank FROM rank{i} r JOIN steps s ON r.layer = s.layer AND r.host = s.src
  UNION ALL SELECT layer, host, {1 - url_trust.DAMPING!r}::DOUBLE * jump FROM start) GROUP BY ALL)"""
        )
    return ",\n".join(ctes)


ORACLES["op7_url_trust"] = (
    r"""
WITH rules AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rhost, substr(rule, instr(rule, '/')) AS rpath
  FROM (VALUES """
    + ", ".join(f"('{r}', '{v}')" for v, r in RULES)
    + r""") AS t(rule, verdict)),
rests AS (SELECT page_id, html, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
known AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rests),
hits AS (
  SELECT host, path, rule, verdict FROM (SELECT DISTINCT host, path FROM known) AS k JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule) = 1),
ruled AS MATERIALIZED (SELECT page_id, k.host, k.path, h.rule, h.verdict FROM known AS k LEFT JOIN hits AS h ON k.host = h.host AND k.path = h.path),
seeds AS (SELECT host, count(*) FILTER (verdict = 'allow')::DOUBLE AS allowed, count(*) FILTER (verdict = 'block')::DOUBLE AS blocked FROM ruled GROUP BY host),
start AS MATERIALIZED (
  SELECT 't' AS layer, host, allowed / (SELECT sum(allowed) FROM seeds) AS jump FROM seeds WHERE allowed > 0
  UNION ALL SELECT 'd', host, blocked / (SELECT sum(blocked) FROM seeds) FROM seeds WHERE blocked > 0),
links AS (
  SELECT src, dst, count(*)::DOUBLE AS weight FROM (
    SELECT host AS src, lower(unnest(regexp_extract_all(html, '(?i)(?:href|src)\s*=\s*["'']?\s*[a-z][a-z0-9+.-]*://([^/?#"''\s>]*)', 1))) AS dst FROM known)
  WHERE src <> dst AND src <> '' AND dst <> '' GROUP BY ALL),
hosts AS (SELECT host FROM known WHERE host <> '' UNION SELECT dst FROM links),
levels AS (
  SELECT host, string_split(host, '.') AS labels FROM hosts),
chains AS (
  SELECT list_distinct([host, array_to_string(labels[-4:], '.'), array_to_string(labels[-3:], '.'), array_to_string(labels[-2:], '.')]) AS members FROM levels),
ordered AS (SELECT list_reverse(list_sort(list_transform(members, lambda m: {'n': length(m), 'm': m}))) AS chain FROM chains),
up AS (
  SELECT DISTINCT chain[i].m AS src, chain[i + 1].m AS dst FROM (SELECT chain, unnest(range(1, len(chain))) AS i FROM ordered)),
edges AS (
  SELECT src, dst, sum(weight) AS weight FROM (
    SELECT * FROM links UNION ALL SELECT src, dst, 1 FROM up WHERE dst <> '' UNION ALL SELECT dst, src, 1 FROM up WHERE dst <> '') GROUP BY ALL),
two AS (SELECT 't' AS layer, src, dst, weight FROM edges UNION ALL SELECT 'd', dst, src, weight FROM edges),
steps AS MATERIALIZED (SELECT layer, src, dst, weight / sum(weight) OVER (PARTITION BY layer, src) AS share FROM two),
"""
    + _rounds_sql(url_trust.ROUNDS)
    + f""",
ranks AS (SELECT host, coalesce(sum(rank) FILTER (layer = 't'), 0) AS trust, coalesce(sum(rank) FILTER (layer = 'd'), 0) AS distrust FROM rank{url_trust.ROUNDS} GROUP BY host)
SELECT page_id, r.host, path, rule,
  coalesce(verdict, CASE WHEN distrust / (trust + distrust) > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled AS r LEFT JOIN ranks AS k ON r.host = k.host
"""
)


@query
def op1_hash_forest_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return hash_forest.search(vectors, vectors.filter("vec_id % 100 = 0"), k=10)


@query
def op9_embedding_near_dedup(spark, sf_dir):
    found = projection_links.vector_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


@query
def op11_pivot_search(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pivot_search.search(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


_USABLE_SQL = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES["op11_pivot_search"] = f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE {_USABLE_SQL})
SELECT * FROM (
  SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS INTEGER) AS rank,
    c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole AS q JOIN whole AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
WHERE rank <= 5
"""


@query
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    tampered = "coalesce(crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 0, false)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    proofs = merkle.manifest(docs, claims={"text": lower}, claimed_where=tampered).proofs()
    shown = proofs.selectExpr("id AS doc_id", "leaf", "subroot", "root", f"sha2({merkle.SIBLINGS}, 256) AS proof_sha256", f"{merkle.FOLDED} AS folded_root")
    return shown.selectExpr("*", "folded_root = root AS verified")


def _levels_sql(first: str, group: str, name: str, levels: int) -> list[str]:
    """Levels of trees, from nodes (group, p, digest, n): each node's neighbours, then the runs' digests."""
    ctes = [f"{name}0 AS MATERIALIZED ({first})"]
    for i in range(levels):
        run = f"PARTITION BY {group}, p // 8 ORDER BY p ROWS BETWEEN"
        ctes.append(
            f"""{name}{i}s AS MATERIALIZED (SELECT {group}, p, n,
  coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i})"""
        )
        ctes.append(
            f"""{name}{i + 1} AS MATERIALIZED (SELECT {group}, p // 8 AS p, (n + 7) // 8 AS n,
  CASE WHEN n = 1 THEN min(digest) ELSE sha256(string_agg(digest, '' ORDER BY p)) END AS digest FROM {name}{i} GROUP BY {group}, p // 8, n)"""
        )
    return ctes


def _folds_sql(first: str, name: str, steps) -> list[str]:
    """Rows (.., p, folded, proof) folded through the levels ``steps``: (table of neighbours, group, place, next place)."""
    ctes = [f"{name}0 AS MATERIALIZED ({first})"]
    for i, (neighbours, on) in enumerate(steps):
        ctes.append(
            f"""{name}{i + 1} AS MATERIALIZED (SELECT d.* REPLACE (
  CASE WHEN s.n = 1 THEN folded ELSE sha256(s.l || folded || s.r) END AS folded, d.proof || s.l || s.r AS proof)
  FROM {name}{i} AS d JOIN {neighbours} AS s ON {on})"""
        )
    return ctes


# Enough levels for 8^6 documents of a language and 8^2 languages.
_DEEP, _WIDE = 6, 2


def _merkle_sql() -> str:
    def leaf(text):
        fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "list_transform(range(8 * strlen(doc_id::VARCHAR)), lambda i: (ascii(substr(doc_id::VARCHAR, i // 8 + 1, 1)) >> (i % 8)::INTEGER) & 1)"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    ctes = [
        f"""leaves AS MATERIALIZED (SELECT doc_id, coalesce('s' || lang, 'n') AS g, {leaf("text")} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {leaf(lower)} END AS claimed FROM documents)""",
        "placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY g) AS n FROM leaves)",
        *_levels_sql("SELECT g, p, n, leaf AS digest FROM placed", "g", "t", _DEEP),
        f"subroots AS MATERIALIZED (SELECT g, digest AS subroot, row_number() OVER (ORDER BY g) - 1 AS q, count(*) OVER () AS m FROM t{_DEEP})",
        *_levels_sql("SELECT 0 AS a, q AS p, m AS n, subroot AS digest FROM subroots", "a", "u", _WIDE),
        *_folds_sql(
            "SELECT doc_id, leaf, g, p, q, subroot, coalesce(claimed, leaf) AS folded, '' AS proof FROM placed JOIN subroots USING (g)",
            "f",
            [(f"t{i}s", f"s.g = d.g AND s.p = d.p // {8**i}") for i in range(_DEEP)] + [(f"u{i}s", f"s.p = d.q // {8**i}") for i in range(_WIDE)],
        ),
    ]
    return (
        "WITH "
        + ",\n".join(ctes)
        + f"""
SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
FROM f{_DEEP + _WIDE} CROSS JOIN u{_WIDE}
"""
    )


ORACLES["op12_merkle_manifest"] = _merkle_sql()


@query
def op13_vector_codes(spark, sf_dir):
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256")
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", digest)


def _codes_sql() -> str:
    def assigned(i):
        return f"""a{i} AS MATERIALIZED (
  SELECT vec_id, label, part, v, arg_min(entry, (d, entry)) AS entry, min(d) AS d FROM (
    SELECT p.*, b.entry, CAST(list_sum(list_transform(list_zip(p.v, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d
    FROM parts AS p JOIN b{i} AS b USING (part)) GROUP BY vec_id, label, part, v)"""

    ctes = [
        f"""whole AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE {_USABLE_SQL})""",
        "parts AS MATERIALIZED (SELECT vec_id, label, part, v[part * len(v) // 4 + 1 : (part + 1) * len(v) // 4] AS v FROM whole, (SELECT unnest(range(4)) AS part))",
        """b0 AS MATERIALIZED (SELECT part, entry, v AS c FROM (
  SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts) WHERE entry < 256)""",
    ]
    for i in range(vector_codes.ROUNDS):
        ctes += [
            assigned(i),
            f"""b{i + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.c, b.c) AS c FROM b{i} AS b LEFT JOIN (
  SELECT part, entry, list(mean ORDER BY pos) AS c FROM (
    SELECT part, entry, pos, floor(sum(x) / count(*)::DOUBLE)::BIGINT AS mean
    FROM (SELECT part, entry, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY ALL) GROUP BY ALL) AS m USING (part, entry))""",
        ]
    last = vector_codes.ROUNDS
    ctes += [
        assigned(last),
        f"digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{last})",
        f"coded AS (SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY ALL)",
    ]
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded CROSS JOIN digest
"""


ORACLES["op13_vector_codes"] = _codes_sql()

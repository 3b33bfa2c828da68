"""Queries of the subpackage over the driver tables, and the SQL that checks those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricmart.llm import chat, collocations, decontaminate, exact_dedup, language, line_dedup, merkle, mixing, ngram_join, pii, sharding, toxicity, warc
from metricmart.llm.common import Scratch, body, col, id_remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _register(check: str | None = None):
    def wrap(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if check is not None:
            ORACLE[build.__name__] = check
        return build

    return wrap


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register()
def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that is in a document, exactly or with few edits."""
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), Scratch(spark))


@_register()
def op2_pivotal_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of each document when all documents are mixed to the weights 5, 2, 1."""
    units = mixing.mix_units(_table(spark, sf_dir, "documents"), Scratch(spark))
    return units.select(
        F.col("id").alias("doc_id"), "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
        F.explode(F.sequence(F.lit(1), F.col("n_rows").cast("int"))).alias("row"),
    ).drop("row")


@_register("""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
""")
def op4_refined_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and survivor of every document among those with an identical text."""
    docs = _table(spark, sf_dir, "documents").withColumn("text_sha256", F.sha2(body("text"), 256))
    groups = exact_dedup.exact_groups(docs, Scratch(spark), digest_col="text_sha256")
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256"))


@_register()
def op7_byte_cnn_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those that are not held out."""
    docs = _table(Scratch(spark).spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 4) == 2, F.lit(False))
    net = language.learn(docs.filter(~held_out))
    return docs.withColumn("guess", language.predicted(net, col("text"))).select("doc_id", held_out.alias("held_out"), "guess.*")


@_register()
def op9_prefix_tree_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every document's set of 5-word shingles, and its component of near duplicates."""
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark))


@_register(f"""
WITH texts AS (SELECT doc_id, row_number() OVER () AS row_id, coalesce(text, '') AS body FROM documents),
split AS (SELECT doc_id, row_id, unnest(string_split(body, chr(10))) AS line, generate_subscripts(string_split(body, chr(10)), 1) AS place FROM texts),
keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS key FROM split),
common AS (SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.top AS gone FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY row_id
""")
def op5_levelled_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, and what is left without those that five documents or more share."""
    kept = line_dedup.dedupe_lines(_table(spark, sf_dir, "documents"), Scratch(spark))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@_register()
def op10_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, written to WARC archives and read back."""
    scratch = Scratch(spark)
    warc.write_archive(_table(spark, sf_dir, "pages"), f"{scratch.path}/archive")
    found = warc.read_archive(spark, f"{scratch.path}/archive", scratch, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


@_register("""
WITH numbered AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n FROM conversations),
whole AS (SELECT conv_id, count(*) AS n_turns, list({'r': role, 't': text} ORDER BY n) AS turns,
                 string_agg('<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10), '' ORDER BY n) AS rendered
          FROM numbered GROUP BY conv_id),
inner_turns AS (SELECT DISTINCT w.turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM whole) w),
ranked AS (SELECT *, row_number() OVER (PARTITION BY turns ORDER BY conv_id NULLS LAST) AS place FROM whole)
SELECT conv_id, n_turns, rendered FROM ranked r WHERE place = 1 AND NOT EXISTS (SELECT 1 FROM inner_turns i WHERE i.turns = r.turns)
""")
def op6_snapshot_collapse_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every maximal conversation as chat text."""
    return chat.chat_documents(_table(spark, sf_dir, "conversations"), Scratch(spark))


@_register()
def op3_factorization_machine_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled ones that are not held out."""
    docs = _table(Scratch(spark).spark, sf_dir, "documents")
    held_out = F.coalesce(id_remainder("doc_id", 3) == 1, F.lit(False))
    labels = _table(spark, sf_dir, "labels").filter(~held_out)
    score = toxicity.scored(toxicity.learn(docs, labels), col("text"))
    return docs.select("doc_id", held_out.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@_register()
def op8_bootstrapped_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the four fixed forms and what their contexts discover."""
    found = pii.find_pii(_table(spark, sf_dir, "documents"), Scratch(spark))
    counts = [pii.count_of(kind, F.col("spans")).alias(f"n_{kind}") for kind in pii.KINDS]
    base = pii.joined_spans(F.filter("spans", lambda s: s["kind"] != "learned"))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), pii.joined_spans(F.col("spans")).alias("spans"))


def _merkle_sql(leaf_levels: int = 5, top_levels: int = 3) -> str:
    """The tree in SQL, level by level: enough for 16 ** 5 rows of a source and 16 ** 3 sources."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lowered = f"translate(text, '{line_dedup.UPPER}', '{line_dedup.LOWER}')"
    steps = [f"""crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS entries),
rows_ AS (SELECT row_number() OVER () AS rid, coalesce('1' || source, '0') AS grp, doc_id, {leaf("text")} AS leaf, {leaf(lowered)} AS lowered_leaf FROM documents),
marked AS (SELECT rows_.*, xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                 lambda c, b: xor(entries[(xor(c, b) & 255) + 1], c // 256)), 4294967295) AS crc FROM rows_, crc_table),
b0 AS (SELECT *, CASE WHEN crc % 5 = 0 THEN lowered_leaf ELSE leaf END AS f, '' AS proof,
              row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n FROM marked),
n0 AS (SELECT grp, pos, n, leaf AS d FROM b0)"""]

    def grow(first: int, last: int) -> None:
        for k in range(first, last):
            steps.append(f"""r{k} AS (SELECT grp, pos // 16 AS run, any_value(n) AS n, list(d ORDER BY pos) AS ds FROM n{k} GROUP BY grp, pos // 16),
n{k + 1} AS (SELECT grp, run AS pos, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d FROM r{k}),
s{k} AS (SELECT b.*, CASE WHEN b.n > 1 THEN array_to_string(ds[1:b.pos % 16], '') ELSE '' END AS l, CASE WHEN b.n > 1 THEN array_to_string(ds[b.pos % 16 + 2:16], '') ELSE '' END AS r
         FROM b{k} b JOIN r{k} r ON b.grp = r.grp AND b.pos // 16 = r.run),
b{k + 1} AS (SELECT * EXCLUDE (l, r, f, proof, pos, n), CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f, proof || l || r AS proof, pos // 16 AS pos, (n + 15) // 16 AS n FROM s{k})""")

    grow(0, leaf_levels)
    k = leaf_levels + 1
    steps.append(f"""n{k} AS (SELECT '' AS grp, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, d, grp AS own FROM n{leaf_levels}),
b{k} AS (SELECT b.* EXCLUDE (grp, pos, n), t.grp, t.pos, t.n, t.d AS subroot FROM b{leaf_levels} b JOIN n{k} t ON b.grp = t.own)""")
    grow(k, k + top_levels)
    end = k + top_levels
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, subroot, (SELECT d FROM n{end}) AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = (SELECT d FROM n{end}) AS verified FROM b{end}"""


@_register(_merkle_sql())
def op11_bitmap_rank_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, subroot and proof of every document in the manifest, and the root that a partly tampered copy folds to."""
    lowered = F.translate("text", line_dedup.UPPER, line_dedup.LOWER)
    tampered = F.when(id_remainder("doc_id", 5) == 0, merkle.leaf_of(*map(F.col, ("doc_id", "source", "lang", "n_chars")), lowered))
    tree = merkle.manifest(_table(spark, sf_dir, "documents"), Scratch(spark), carry={"tampered": tampered})
    folded = merkle.folded(F.coalesce("tampered", "leaf"), F.col("path"))
    return tree.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root")).withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


@_register()
def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document: eight runs of whole groups of equal texts, their sizes as near as can be."""
    cut = sharding.minimax_shards(_table(spark, sf_dir, "documents"), Scratch(spark), shards=8)
    return cut.documents.select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _collocation_sql() -> str:
    grams = "\nUNION ALL ".join(
        f"SELECT lang, array_to_string(words[i:i + {m - 1}], ' ') AS phrase, {m} AS m FROM (SELECT lang, words, unnest(range(1, len(words) - {m} + 2)) AS i FROM pieces)" for m in (1, 2, 3, 4)
    )
    return f"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), '{line_dedup.UPPER}', '{line_dedup.LOWER}') AS body FROM documents),
split AS (SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
pieces AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS words FROM split),
grams AS ({grams}),
f AS (SELECT lang, phrase, m, count(*) AS f FROM grams GROUP BY lang, phrase, m),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS words FROM f WHERE f >= 30),
candidates AS (SELECT * FROM frequent WHERE m > 1),
inside AS (SELECT lang, array_to_string(words[i:i + s - 1], ' ') AS phrase, max(f) AS longer
           FROM (SELECT lang, words, f, s, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM candidates)) GROUP BY ALL),
open_ AS (SELECT c.* FROM candidates c LEFT JOIN inside i USING (lang, phrase) WHERE i.longer IS NULL OR 100 * i.longer < 80 * c.f),
cuts AS (SELECT *, array_to_string(words[1:k], ' ') AS x, array_to_string(words[k + 1:m], ' ') AS y FROM (SELECT *, unnest(range(1, m)) AS k FROM open_)),
sides AS (SELECT c.lang, c.phrase, c.f AS a, c.k, p.f AS l, q.f AS r, ((2000000::HUGEINT * c.f) // (p.f + q.f))::BIGINT AS score
          FROM cuts c JOIN frequent p ON p.lang = c.lang AND p.phrase = c.x JOIN frequent q ON q.lang = c.lang AND q.phrase = c.y),
low AS (SELECT * FROM sides QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t USING (lang) WHERE r.rank <= 2000
"""


@_register(_collocation_sql())
def op13_hat_trie_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 phrases of each language whose words stand together most."""
    return collocations.collocations(_table(spark, sf_dir, "documents"), Scratch(spark))

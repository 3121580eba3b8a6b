"""Registered queries of the operators, with their SQL statements where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from recordwell.llm import bloom, common, compression, crf, lines, merkle, nra, pieces, ppm, resampling, sharding, simhash, tiling, trigrams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: The public vocabulary that encoding uses; a parameter of the operator.
PIECES_PATH = "/opt/tokenizers/piece_bpe_32k.model"


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return tiling.leaked_items(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every whole text."""
    docs = table(spark, folder, "documents")
    encoded = docs.select("doc_id", pieces.encode(F.col("text"), pieces.read_model(spark, PIECES_PATH)).alias("coded"))
    return encoded.select("doc_id", "coded.ids", F.size("coded.ids").alias("n_ids"), "coded.lossless")


@query
def op4_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and component of every document."""
    marks = simhash.near_duplicates(table(spark, folder, "documents"))
    return marks.select("doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The group of equal texts of every document and the row that stays."""
    return bloom.mark_duplicates(table(spark, folder, "documents"))


ORACLES["op5_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER texts AS keep_id, count(*) OVER texts AS group_size,
       doc_id = max(doc_id) OVER texts AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW texts AS (PARTITION BY coalesce(text, ''))
"""


@query
def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """The predicted language of every document, learnt from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    trees = ppm.train(docs.filter(~common.is_held_out("doc_id")))
    return docs.select(
        "doc_id", common.is_held_out("doc_id").alias("held_out"),
        ppm.languages(F.col("text"), trees, spark).alias("found"),
    ).select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


@query
def op1_rendezvous(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shard of eight, its slot, and its shard of nine."""
    eight = {shard: 1.0 for shard in range(8)}
    docs = table(spark, folder, "documents")
    placed = sharding.assign_shards(docs, eight, grown={**eight, 8: 1.0})
    return placed.withColumn("law", F.lit("key"))


@query
def op6_boilerplate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the lines that stand on ten or more sources."""
    cleaned = lines.remove_lines(table(spark, folder, "documents"))
    return cleaned.select("doc_id", "text", "n_lines", "n_removed")


ORACLES["op6_boilerplate"] = """
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('s' || source, '') AS site, text FROM documents
), own AS (
  SELECT row, site, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS place
  FROM docs WHERE text <> ''
), trimmed AS (
  SELECT *, trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS bare FROM own
), spread AS (
  SELECT bare FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT site) >= 10
), cleaned AS (
  SELECT row, coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE bare NOT IN (SELECT bare FROM spread)), '') AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE bare IN (SELECT bare FROM spread)) AS n_removed
  FROM trimmed GROUP BY row
)
SELECT doc_id, coalesce(c.text, d.text) AS text, CAST(coalesce(n_lines, 0) AS INTEGER) AS n_lines, CAST(coalesce(n_removed, 0) AS INTEGER) AS n_removed
FROM docs d LEFT JOIN cleaned c USING (row)
"""


@query
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of every document, learnt from the labelled rows that are not held out."""
    docs = table(spark, folder, "documents")
    distance = compression.train(docs.filter(~common.is_held_out("doc_id")), table(spark, folder, "labels"))
    return docs.select(
        "doc_id", common.is_held_out("doc_id").alias("held_out"), compression.toxicity(F.col("text"), distance, spark).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op9_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets of every document: counts by kind, all spans, and their digest."""
    found = trigrams.scan_secrets(table(spark, folder, "documents"))
    kinds = F.array(*[F.lit(rule.kind) for rule in trigrams.RULES])
    named = F.transform("spans", lambda s: F.concat_ws(":", F.get(kinds, s["rule"]), s["start"].cast("string"), s["end"].cast("string")))
    def of_rule(n: int):
        return lambda s: s["rule"] == n

    counts = [
        F.size(F.filter("spans", of_rule(n))).cast("long").alias(f"n_{rule.kind}")
        for n, rule in enumerate(trigrams.RULES)
    ]
    return found.select("doc_id", *counts, F.array_join(named, ",").alias("spans")).withColumn(
        "base_sha256", F.sha2(F.col("spans").cast("binary"), 256))


_SPANS = """
  SELECT doc_id, {n} AS rule, '{kind}' AS kind, unnest(range(1, len(found) + 1)) AS n, found, gaps FROM (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS found, regexp_split_to_array(coalesce(text, ''), '{pattern}') AS gaps
    FROM documents) WHERE len(found) > 0
"""
#: The patterns once more, written for the other engine.
_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"'']? *[:=] *[\"'']?([A-Za-z0-9+/_.=-]+)"
)
ORACLES["op9_secrets"] = f"""
WITH raw AS ({_SPANS.format(n=0, kind='assign', pattern=_ASSIGN)}
  UNION ALL {_SPANS.format(n=1, kind='access', pattern='AKIA[A-Z0-9]+')}
  UNION ALL {_SPANS.format(n=2, kind='hex', pattern='[0-9a-f]{32,}')}
), placed AS (
  SELECT doc_id, rule, kind, found[n] AS match,
         list_sum(list_transform(gaps[1:n], lambda g: length(g))) + coalesce(list_sum(list_transform(found[1:n - 1], lambda m: length(m))), 0) AS start
  FROM raw
), kept AS (
  SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + length(match) AS BIGINT) AS span FROM placed
  WHERE CASE rule WHEN 0 THEN length(regexp_extract(match, '{_ASSIGN}', 2)) >= 8 WHEN 1 THEN length(match) >= 16 ELSE true END
), joined AS (
  SELECT doc_id, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access,
         count(*) FILTER (WHERE rule = 2) AS n_hex, string_agg(span, ',' ORDER BY start, rule) AS spans FROM kept GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       coalesce(spans, '') AS spans, sha256(coalesce(spans, '')) AS base_sha256
FROM documents d LEFT JOIN joined j ON d.doc_id = j.doc_id
"""


@query
def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The importance of every document towards good ones, and whether it is among the four fifths drawn."""
    docs = table(spark, folder, "documents")
    weights = resampling.weigh(docs, table(spark, folder, "labels").filter("quality = 1"))
    weighted = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"), resampling.importance(F.col("text"), weights, spark).alias("log_weight"))
    return resampling.resample(weighted, -(-4 * docs.count() // 5)).drop("text_hash")


@query
def op12_line_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Base counts of every document and whether it stays, by a field learnt from the labelled rows that are not held out."""
    docs = table(spark, folder, "documents")
    field = crf.train(docs.filter(~common.is_held_out("doc_id")), table(spark, folder, "labels"))
    return docs.select("doc_id", crf.judge(F.col("text"), field, spark).alias("found")).select("doc_id", "found.*")


@query
def op13_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf, witness and root, and the root that its text without line breaks would lead to."""
    docs = table(spark, folder, "documents")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.when(tampered, F.regexp_replace("text", "\n", "")).otherwise(F.col("text"))
    found = F.unhex(merkle.leaf([text if f == "text" else F.col(f) for f in merkle.FIELDS]))
    rows = merkle.folded(merkle.manifest(docs, found=found), F.col("found"))
    digests = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "folded_root")}
    return rows.select(
        F.col("key").alias("doc_id"), *[d.alias(c) for c, d in digests.items()],
        F.sha2(F.lower(F.hex("witness")).cast("binary"), 256).alias("proof_sha256"),
        (F.col("folded_root") == F.col("root")).alias("verified"))


def _digested(field: str) -> str:
    return f"coalesce(CAST(strlen(CAST({field} AS VARCHAR)) AS VARCHAR) || ':' || CAST({field} AS VARCHAR), '-')"


_FIELDS = " || ".join(_digested(field) for field in ("doc_id", "source", "lang", "n_chars", "text"))
_CRC = (
    "xor(list_reduce([4294967295] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ord(c)), "
    "lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], "
    "lambda a, step: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"
)
_RISE = """SELECT level + 1, {keys} place // 3, sha256(string_agg(node, '' ORDER BY place)), any_value((n + 2) // 3)
  FROM {tree} WHERE n > 1 GROUP BY level, {keys} place // 3"""
ORACLES["op13_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, sha256({_FIELDS}) AS leaf,
         sha256({_FIELDS.replace("text", "other")}) AS altered
  FROM (SELECT *, CASE WHEN {_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS other FROM documents)
), rows AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM leaves
), tree AS (
  SELECT 0 AS level, source, place, leaf AS node, n FROM rows
  UNION ALL {_RISE.format(keys="source,", tree="tree")}
), subroots AS (
  SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM tree WHERE n = 1
), forest AS (
  SELECT 0 AS level, place, node, n FROM subroots
  UNION ALL {_RISE.format(keys="", tree="forest")}
), climb AS (
  SELECT 0 AS level, doc_id, leaf, source, place, altered AS node, '' AS seen, n FROM rows
  UNION ALL
  SELECT c.level + 1, c.doc_id, c.leaf, c.source, c.place // 3, sha256(string_agg(CASE WHEN t.place = c.place THEN c.node ELSE t.node END, '' ORDER BY t.place)),
         c.seen || coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place <> c.place), ''), any_value((c.n + 2) // 3)
  FROM climb c JOIN tree t ON t.source IS NOT DISTINCT FROM c.source AND t.level = c.level AND t.place // 3 = c.place // 3
  WHERE c.n > 1 GROUP BY c.level, c.doc_id, c.leaf, c.source, c.place, c.seen
), crown AS (
  SELECT 0 AS level, c.doc_id, c.leaf, s.node AS subroot, s.place, c.node, c.seen, s.n
  FROM climb c JOIN subroots s ON s.source IS NOT DISTINCT FROM c.source WHERE c.n = 1
  UNION ALL
  SELECT c.level + 1, c.doc_id, c.leaf, c.subroot, c.place // 3, sha256(string_agg(CASE WHEN t.place = c.place THEN c.node ELSE t.node END, '' ORDER BY t.place)),
         c.seen || coalesce(string_agg(t.node, '' ORDER BY t.place) FILTER (WHERE t.place <> c.place), ''), any_value((c.n + 2) // 3)
  FROM crown c JOIN forest t ON t.level = c.level AND t.place // 3 = c.place // 3
  WHERE c.n > 1 GROUP BY c.level, c.doc_id, c.leaf, c.subroot, c.place, c.seen, c.node
)
SELECT doc_id, leaf, subroot, root, sha256(seen) AS proof_sha256, node AS folded_root, node = root AS verified
FROM crown, (SELECT node AS root FROM forest WHERE n = 1) WHERE n = 1
"""


@query
def op11_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    """The 50 highest-scoring documents of every benchmark item."""
    found = nra.top_documents(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=50)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
ORACLES["op11_ranked_search"] = f"""
WITH own AS (
  SELECT row_number() OVER () AS row, doc_id, {_TERMS} AS terms FROM documents
), lengths AS (
  SELECT row, doc_id, len(terms) AS n FROM own WHERE len(terms) > 0
), sums AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM lengths
), asked AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark
), postings AS (
  SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM own) WHERE term IN (SELECT term FROM asked) GROUP BY row, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, sums GROUP BY term, docs
), scores AS (
  SELECT item_id, doc_id, row, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length)))) AS BIGINT) AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term) JOIN lengths USING (row), sums GROUP BY item_id, doc_id, row
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 50
"""

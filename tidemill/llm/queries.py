"""The registered queries of this package and, where SQL can express them, their DuckDB equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import fingerprint, line_dedup, merkle, mixing, near_dedup, packing, quality, secrets, sharding, token_counts, toxicity, vector_dedup, whitening

END_ID = 2
SEQUENCE_TOKENS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def byte_bpe() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token pieces in sequences of at most 1024 tokens."""
    return packed_digest(table(spark, sf_dir, "documents"))


def packed_digest(docs: DataFrame) -> DataFrame:
    return packing.pack_texts(docs, byte_bpe(), SEQUENCE_TOKENS, END_ID, digest=True)


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and how alike they and the next document's are."""
    out = fingerprint.edited_pairs(table(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), fingerprint.as_hex(F.col("fingerprint")).alias("fingerprint"),
        fingerprint.as_hex(F.col("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


SHARDS = 8


def op3_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard under the law ``bytes``: equal texts stay together, sizes come near equal."""
    docs = table(spark, sf_dir, "documents").withColumn("text_crc32", F.crc32(F.coalesce("text", F.lit(""))))
    out = sharding.assign(docs, SHARDS, carry=("text_crc32",))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _crc_step(value: int) -> int:
    for _ in range(8):
        value = value >> 1 ^ 0xEDB88320 * (value & 1)
    return value


#: The shards of all texts, as long as no group of equal texts exceeds an even share and neither a size class nor
#: a shard has more rows than one task numbers; beyond that the numbering goes by hashes that SQL does not have.
#: ``fit`` is the packing at one capacity after another, a run of a size class at a time.
OP3_SQL = rf"""
WITH RECURSIVE g AS MATERIALIZED (
  SELECT sha256(coalesce(text, '')) AS group_id, strlen(coalesce(text, '')) + 1 AS size, count(*) * (strlen(coalesce(text, '')) + 1) AS unit,
    regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS raw
  FROM documents GROUP BY coalesce(text, '')
)
, k AS MATERIALIZED (
  SELECT group_id, size, CAST(ceil(unit / pow(2, greatest(0, length(bin(unit)) - {sharding.CLASS_BITS}))) * pow(2, greatest(0, length(bin(unit)) - {sharding.CLASS_BITS})) AS BIGINT) AS unit,
    xor(list_reduce(list_prepend(4294967295, list_transform(raw, lambda x: CAST('0x' || x AS BIGINT))), lambda c, b: xor(c >> 8, ({[_crc_step(i) for i in range(256)]})[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM g
)
, n AS (SELECT unit, count(*) AS n FROM k GROUP BY unit)
, p AS MATERIALIZED (SELECT list(unit ORDER BY unit DESC) AS units, list(n ORDER BY unit DESC) AS counts, greatest(CAST(ceil(sum(unit * n) / {SHARDS}) AS BIGINT), max(unit), 1) AS least FROM n)
, fit AS (
  SELECT 0 AS step, CAST(0 AS BIGINT) AS more, 1 AS i, counts[1] AS left_, CAST([] AS STRUCT(room BIGINT, box INTEGER)[]) AS bins, CAST(NULL AS INTEGER) AS box, CAST(0 AS BIGINT) AS took, 0 AS unit_at
  FROM p WHERE len(units) > 0
  UNION ALL
  SELECT step + 1, CASE WHEN failed THEN greatest(1, 2 * more) ELSE more END,
    CASE WHEN failed THEN 1 WHEN left_ = n THEN i + 1 ELSE i END, CASE WHEN failed THEN counts[1] WHEN left_ = n THEN counts[i + 1] ELSE left_ - n END,
    CASE WHEN failed THEN [] ELSE list_append(list_filter(bins, lambda b: b.box <> best.box), struct_pack(room := best.room - n * size, box := best.box)) END,
    CASE WHEN NOT failed THEN best.box END, CASE WHEN failed THEN 0 ELSE n END, i
  FROM (
    SELECT *, best IS NULL AS failed, CASE WHEN best IS NULL THEN 0 ELSE least(left_, best.room // size) END AS n
    FROM (
      SELECT *, coalesce(list_min(list_filter(bins, lambda b: b.room >= size)), CASE WHEN len(bins) < {SHARDS} THEN struct_pack(room := least + more, box := CAST(len(bins) AS INTEGER)) END) AS best
      FROM (SELECT fit.*, units, counts, least, units[i] AS size FROM fit, p WHERE i <= len(units))))
)
, done AS (SELECT step, unit_at, box, took, sum(took) OVER (PARTITION BY unit_at ORDER BY step) AS upto FROM fit WHERE box IS NOT NULL AND more = (SELECT max(more) FROM fit))
, ranked AS (SELECT group_id, size, crc, unit, row_number() OVER (PARTITION BY unit ORDER BY group_id) AS rank FROM k)
, home AS MATERIALIZED (
  SELECT group_id, size, crc, box FROM ranked JOIN p ON true JOIN done ON done.unit_at = list_position(units, unit) AND rank > upto - took AND rank <= upto
)
SELECT doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'bytes' AS law, box AS shard,
  CAST(row_number() OVER (PARTITION BY box ORDER BY doc_id NULLS FIRST, group_id) - 1 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM documents JOIN home ON sha256(coalesce(text, '')) = group_id
"""


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier document holds, as a digest."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH l AS (
  SELECT doc_id, n, line, regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', '') AS bare
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)
), k AS (
  SELECT doc_id, n, line, translate(bare, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l
), f AS (
  SELECT k, min(doc_id) AS keeper FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), j AS (
  SELECT k.doc_id, n, line, coalesce(keeper <> k.doc_id, false) AS gone FROM k LEFT JOIN f ON k.k = f.k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""


QUALITY_KEEP, TOXIC = 0.3, 0.5


def fold(key: str = "doc_id"):
    """Rows of fold 0 are held out: no label of theirs is learned from."""
    return F.crc32(F.col(key).cast("string")) % 5


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.learn(docs, table(spark, sf_dir, "labels"), "quality", fold() != 0)
    out = quality.score(docs, model)
    return out.select("doc_id", (F.coalesce(fold(), F.lit(1)) == 0).alias("held_out"), "score", (F.col("score") >= QUALITY_KEEP).cast("int").alias("predicted"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), "toxic", fold() != 0)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (F.coalesce(fold(), F.lit(1)) == 0).alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secrets: how many of each base kind, and where."""
    out = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    return out.select("doc_id", *(count(k).alias(f"n_{k}") for k in secrets.BASE), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op7_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's number of links at cosine 0.9 or more and the smallest vector that they reach."""
    return vector_dedup.near_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP9_WIDTH = 2

#: Links become components alike in every query: reach everything, keep the smallest.
REACH = """
, e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l)
, r AS (SELECT v, v AS c FROM own UNION SELECT e.y, r.c FROM r JOIN e ON r.v = e.x)
, m AS (SELECT v, min(c) AS component_id FROM r GROUP BY v)
"""

OP7_SQL = """
WITH RECURSIVE own AS (SELECT vec_id AS v FROM embeddings)
, u AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
)
, l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9)
""" + REACH + """
, k AS (SELECT x, count(*) AS n FROM e GROUP BY x)
SELECT v AS vec_id, coalesce(n, 0) AS n_links, component_id, v = component_id AS kept FROM m LEFT JOIN k ON v = x
"""

OP9_SQL = r"""
WITH RECURSIVE own AS (SELECT doc_id AS v FROM documents)
, d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
)
, s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)) AS g FROM d
)
, n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id)
, p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id)
, l AS (SELECT x, y FROM p JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c))
""" + REACH + """
SELECT v AS doc_id, coalesce(n, 0) AS n_shingles, component_id, v = component_id AS kept FROM m LEFT JOIN n ON v = doc_id
"""


def op9_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near duplicates by two-word shingles."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=OP9_WIDTH)


def op10_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes so that sources come near their targets."""
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")


OP10_SQL = rf"""
WITH RECURSIVE s AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
)
, k AS MATERIALIZED (SELECT source, size, count(*) AS n FROM s GROUP BY source, size)
, o AS (SELECT source, CAST(sum(size * n) AS BIGINT) AS source_size, CAST(sum(n) AS BIGINT) AS n_docs, min(size) FILTER (size > 0) AS least FROM k GROUP BY source)
, i AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS sid FROM o)
, x AS (SELECT *, (sid - 1) % 3 + 1 AS w, source_size * {mixing.MOST} AS cap FROM i)
, v AS (SELECT *, CAST(cap AS DOUBLE) / w AS ratio FROM x)
, e AS (
  SELECT *, CAST(CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0) AS BIGINT) AS DOUBLE) / CAST(sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS BIGINT) AS level
  FROM v WINDOW before AS (ORDER BY ratio, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
, t AS MATERIALIZED (
  SELECT *, CASE WHEN ratio <= level THEN CAST(cap AS DOUBLE) ELSE coalesce(max(CASE WHEN ratio > level THEN level END) OVER (), 0) * w END AS target FROM e
)
, z AS MATERIALIZED (SELECT sid, size, n FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
, dual AS (
  SELECT 0 AS turn, sid, target, CAST(0 AS DOUBLE) AS lam, least(CAST(0 AS DOUBLE), ln(target / source_size) / least) AS lo, ln(CAST({mixing.MOST} AS DOUBLE)) / least AS hi, false AS done
  FROM t WHERE target > 0 AND target / nullif(source_size, 0) < {mixing.MOST} * (1 - 1e-12)
  UNION ALL
  SELECT turn + 1, sid, target, CASE WHEN near THEN lam WHEN newton > low AND newton < high THEN newton ELSE (low + high) / 2 END, low, high, near
  FROM (
    SELECT turn, sid, target, lam, CASE WHEN g < target THEN lam ELSE lo END AS low, CASE WHEN g > target THEN lam ELSE hi END AS high,
      lam - (g - target) / nullif(h, 0) AS newton, abs(g - target) <= greatest(target * {mixing.NEAR}, 0.5) AS near
    FROM (
      SELECT turn, sid, target, lam, lo, hi, CAST(sum(CAST(round(tokens * {mixing.UNIT}) AS HUGEINT)) AS DOUBLE) / {mixing.UNIT} AS g,
        CAST(sum(CAST(round(CASE WHEN r < {mixing.MOST} THEN tokens * size ELSE 0 END * {mixing.UNIT}) AS HUGEINT)) AS DOUBLE) / {mixing.UNIT} AS h
      FROM (
        SELECT *, n * size * r AS tokens FROM (
          SELECT turn, dual.sid, target, lam, lo, hi, size, n, least(CAST({mixing.MOST} AS DOUBLE), exp(least(lam * size, 2))) AS r
          FROM dual JOIN z ON dual.sid = z.sid WHERE NOT done AND turn < {mixing.ITERATIONS}))
      GROUP BY turn, sid, target, lam, lo, hi))
)
, f AS MATERIALIZED (SELECT sid, arg_max(lam, turn) AS lam FROM dual GROUP BY sid)
, d AS (
  SELECT t.sid, doc_id, size, source_size, target, lam, n_docs, count(*) AS n
  FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN f ON f.sid = t.sid GROUP BY ALL
)
, b AS (
  SELECT *, CASE WHEN lam IS NOT NULL THEN least(CAST({mixing.MOST} AS DOUBLE), exp(least(lam * size, 2))) WHEN target > 0 THEN {mixing.MOST} ELSE 0 END AS rate,
    CAST('0x' || substr(md5(concat_ws(':', doc_id, size)), 1, 8) AS BIGINT) % CAST(ceil(n_docs / {mixing.BLOCK_ROWS}) AS BIGINT) AS block FROM d
)
, r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sid, block ORDER BY size DESC, doc_id DESC NULLS LAST) AS pos FROM b)
, c AS (
  SELECT sid, block, pos, doc_id, size, source_size, target, n, copies, want - copies * size AS over
  FROM (SELECT *, CASE WHEN size = 0 THEN n ELSE greatest(0, least({mixing.MOST} * n, CAST(round(want / size) AS BIGINT))) END AS copies FROM (SELECT *, rate * size * n AS want FROM r WHERE pos = 1))
  UNION ALL
  SELECT sid, block, pos, doc_id, size, source_size, target, n, copies, want - copies * size
  FROM (
    SELECT *, CASE WHEN size = 0 THEN n ELSE greatest(0, least({mixing.MOST} * n, CAST(round(want / size) AS BIGINT))) END AS copies
    FROM (SELECT r.*, c.over + rate * r.size * r.n AS want FROM c JOIN r ON r.sid = c.sid AND r.block = c.block AND r.pos = c.pos + 1))
)
, u AS (SELECT *, unnest(range(n)) AS p FROM c)
SELECT doc_id, size, source_size, target, CAST((copies // n + CAST(p < copies % n AS BIGINT)) * size AS BIGINT) AS taken, CAST(copies // n + CAST(p < copies % n AS BIGINT) AS INTEGER) AS copies FROM u
"""


TOKEN_LIMIT = 2048


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many tokens every document has, and whether they are more than a model takes."""
    import public_tokenizers

    out = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the Merkle manifest, and whether what is shown of it leads to the root."""
    docs = table(spark, sf_dir, "documents")
    own, shown = (merkle.leaf_of(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), text) for text in (F.col("text"), F.translate("text", UPPER, LOWER)))
    rows = docs.select("doc_id", "lang", own.alias("leaf"), F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, shown).alias("shown"))
    out = merkle.prove(rows, "leaf", "doc_id", "lang")
    out = out.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.siblings(F.col("path")), 256).alias("proof_sha256"), merkle.fold(F.coalesce("shown", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_field_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


#: ``t`` is every node of the languages' trees, ``s`` every node above; ``up`` and ``over`` walk each leaf's path.
OP12_SQL = rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce('v' || lang, '') AS tree, {_leaf_sql("text")} AS leaf, {_leaf_sql(f"translate(text, '{UPPER}', '{LOWER}')")} AS lowered,
    xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(CAST(doc_id AS VARCHAR))), '..'), lambda x: CAST('0x' || x AS BIGINT))),
      lambda c, b: xor(c >> 8, ({[_crc_step(i) for i in range(256)]})[(xor(c, b) & 255) + 1])), 4294967295) % 3 = 0 AS tampered
  FROM documents
)
, p AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d)
, t AS (
  SELECT 0 AS lvl, tree, pos, n, leaf AS h FROM p
  UNION ALL
  SELECT lvl + 1, tree, pos // {merkle.ARITY}, (n + {merkle.ARITY - 1}) // {merkle.ARITY}, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY lvl, tree, pos // {merkle.ARITY}, n
)
, runs AS MATERIALIZED (SELECT lvl, tree, pos // {merkle.ARITY} AS run, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY lvl, tree, pos // {merkle.ARITY})
, tops AS MATERIALIZED (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS trees FROM t WHERE n = 1)
, s AS (
  SELECT 0 AS lvl, rank AS pos, trees AS n, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // {merkle.ARITY}, (n + {merkle.ARITY - 1}) // {merkle.ARITY}, sha256(string_agg(h, '' ORDER BY pos)) FROM s WHERE n > 1 GROUP BY lvl, pos // {merkle.ARITY}, n
)
, above AS MATERIALIZED (SELECT lvl, pos // {merkle.ARITY} AS run, list(h ORDER BY pos) AS hs FROM s WHERE n > 1 GROUP BY lvl, pos // {merkle.ARITY})
, up AS (
  SELECT 0 AS lvl, tree, pos, n, doc_id, leaf, CASE WHEN tampered THEN coalesce(lowered, leaf) ELSE leaf END AS node, '' AS path FROM p
  UNION ALL
  SELECT up.lvl + 1, up.tree, pos // {merkle.ARITY}, (n + {merkle.ARITY - 1}) // {merkle.ARITY}, doc_id, leaf,
    sha256(array_to_string(hs[1:pos % {merkle.ARITY}], '') || node || array_to_string(hs[pos % {merkle.ARITY} + 2:], '')), path || array_to_string(hs[1:pos % {merkle.ARITY}], '') || array_to_string(hs[pos % {merkle.ARITY} + 2:], '')
  FROM up JOIN runs ON runs.lvl = up.lvl AND runs.tree = up.tree AND run = pos // {merkle.ARITY} WHERE n > 1
)
, over AS (
  SELECT 0 AS lvl, rank AS pos, trees AS n, doc_id, leaf, subroot, node, path FROM up JOIN tops USING (tree) WHERE n = 1
  UNION ALL
  SELECT over.lvl + 1, pos // {merkle.ARITY}, (n + {merkle.ARITY - 1}) // {merkle.ARITY}, doc_id, leaf, subroot,
    sha256(array_to_string(hs[1:pos % {merkle.ARITY}], '') || node || array_to_string(hs[pos % {merkle.ARITY} + 2:], '')), path || array_to_string(hs[1:pos % {merkle.ARITY}], '') || array_to_string(hs[pos % {merkle.ARITY} + 2:], '')
  FROM over JOIN above ON above.lvl = over.lvl AND run = pos // {merkle.ARITY} WHERE n > 1
)
SELECT doc_id, leaf, subroot, root, sha256(path) AS proof_sha256, node AS folded_root, node = root AS verified
FROM over, (SELECT h AS root FROM s WHERE n = 1) WHERE n = 1
"""


COMPONENTS = 32


def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's place along the components of most variance, and what share of all it is."""
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), most=COMPONENTS)
    each = out.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "z"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", F.expr("try_cast(deviation AS BIGINT)").alias("deviation"), F.col("z.whitened").alias("whitened"), F.col("z.explained").alias("explained"), "identity_error")


QUERIES = {"op1_pack": op1_pack, "op2_fingerprint": op2_fingerprint, "op3_shard": op3_shard, "op4_lines": op4_lines, "op5_quality": op5_quality, "op6_secrets": op6_secrets, "op7_vectors": op7_vectors, "op8_toxicity": op8_toxicity, "op9_near": op9_near, "op10_mix": op10_mix, "op11_tokens": op11_tokens, "op12_manifest": op12_manifest, "op13_whiten": op13_whiten}
ORACLE_SQL: dict[str, str] = {"op3_shard": OP3_SQL, "op4_lines": OP4_SQL, "op7_vectors": OP7_SQL, "op9_near": OP9_SQL, "op10_mix": OP10_SQL, "op12_manifest": OP12_SQL}

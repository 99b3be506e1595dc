"""The numbered operators bound to their whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specspark.llm import (chat_format, circulant_minhash, entropy_mix, fit_packing, histogram_shards, license_scan, line_filters,
                           merkle_manifest, order_minhash, quality_gam, sliced_topk, stripe_divergence, suffix_dedup)
from specspark.llm.registry import query, table


@query("op3_chat_format", oracle=r"""WITH m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, length(text) AS n, length(regexp_replace(text, '[\\<>#]', '', 'g')) AS text_plain,
  length(regexp_replace(role, '[\\<>#]', '', 'g')) AS role_plain FROM m)
SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(n) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(15 + 2 * length(role) - role_plain + 2 * n - text_plain)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""")
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    hard = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit(hard).alias("text")) for i, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    part = F.struct(F.lit("text").alias("type"), F.coalesce("text", F.lit("")).alias("text"))
    messages = rows.unionByName(extra).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.array(part).alias("parts"))
    return chat_format.digests(chat_format.format_turns(messages))


@query("op4_entropy_mix")
def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entropy_mix.mix(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "rate", "copies")


@query("op7_histogram_shards")
def op7_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = histogram_shards.shard(table(spark, sf_dir, "documents"), shards=24, carry=["doc_id"])
    return dealt.select("row.doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query("op8_fit_packing")
def op8_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fit_packing.pack(table(spark, sf_dir, "documents"))


@query("op2_quality_gam")
def op2_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_gam.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op1_circulant_minhash", oracle=r"""WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
  list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS sh FROM w),
d AS (SELECT DISTINCT doc_id, hash(sh) AS sh FROM s),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM d a JOIN d b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.c AS component_id, doc_id = c.c AS kept
FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS c FROM r GROUP BY x) c USING (doc_id)""")
def op1_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.groups(table(spark, sf_dir, "documents"), width=4)


@query("op10_sliced_topk", oracle="""WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10""")
def op10_sliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliced_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


@query("op6_order_minhash")
def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare(table(spark, sf_dir, "documents"))


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rest.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), "kept_text")


@query("op5_license_scan")
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files <source>/<lang>/<digits of the id but the last two, a directory each>/<id>; those whose id ends in 0
    are the licence files LICENSE-<id>."""
    number = F.col("doc_id").cast("string")
    digits = F.expr("transform(sequence(1, greatest(length(cast(doc_id AS string)) - 2, 1)), i -> substring(cast(doc_id AS string), i, 1))")
    path = F.concat_ws("/", "source", "lang", F.when(F.length(number) > 2, digits).otherwise(F.array().cast("array<string>")),
                       F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE-"), number)).otherwise(number))
    return license_scan.licensed_windows(table(spark, sf_dir, "documents"), path)


@query("op11_stripe_divergence", oracle=r"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM c GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) AS p
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
l AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q
  FROM c JOIN v USING (lang) GROUP BY lang, term),
f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a
    JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (((p - q) * (p - q)) // (p + q))::BIGINT FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10""")
def op11_stripe_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stripe_divergence.audit(table(spark, sf_dir, "documents"), min_docs=10, top=10)


@query("op12_line_filters", oracle=r"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, unnest(lines) AS line, unnest(range(len(lines))) AS i FROM d),
k AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
x AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10),
s AS (SELECT r, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE x.key IS NULL), '') AS kept, count(x.key) AS n_dropped
  FROM k LEFT JOIN x USING (key) GROUP BY r)
SELECT doc_id, len(lines)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256 FROM d JOIN s USING (r)""")
def op12_line_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = line_filters.drop_repeats(table(spark, sf_dir, "documents"), carry=["doc_id"], min_docs=10, min_chars=1)
    return rest.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _merkle_sql(leaf_levels: int = 6, group_levels: int = 3) -> str:
    """The tree written out level by level: trees of at most 16^levels leaves a source and 16^levels sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def leaf(text: str) -> str:
        one = "coalesce(octet_length(encode({0})) || ':' || {0}, '-')"
        return "sha256(" + " || ".join(one.format(v) for v in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"

    crc = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(regexp_extract_all(doc_id::VARCHAR, '.'),
      lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: CASE WHEN x >= 0 THEN xor(a, x)
      WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT)"""
    ctes = [f"""b AS (SELECT doc_id, coalesce('1' || source, '0') AS g, {leaf('text')} AS leaf,
      CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS f FROM documents),
    n0 AS (SELECT g, doc_id, leaf, f, leaf AS d, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM b),
    f0 AS (SELECT g, doc_id, leaf, pos AS spot, f, '' AS s FROM n0)"""]
    frame = "string_agg(d, '') OVER (PARTITION BY g, pos // 16 ORDER BY pos ROWS BETWEEN {})"

    def level(nodes: str, folds: str, up: str, fup: str) -> str:
        return f"""{nodes}s AS (SELECT g, pos, d, count(*) OVER (PARTITION BY g) AS n,
      coalesce({frame.format('UNBOUNDED PRECEDING AND 1 PRECEDING')}, '') AS l, coalesce({frame.format('1 FOLLOWING AND UNBOUNDED FOLLOWING')}, '') AS r FROM {nodes}),
    {up} AS (SELECT g, pos // 16 AS pos, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE any_value(d) END AS d FROM {nodes}s GROUP BY g, pos // 16),
    {fup} AS (SELECT g, doc_id, leaf, spot // 16 AS spot, CASE WHEN n > 1 THEN sha256(l || f || r) ELSE f END AS f, s || l || r AS s%s
      FROM {folds} JOIN {nodes}s USING (g) WHERE spot = {nodes}s.pos)"""

    for k in range(leaf_levels):
        ctes.append(level(f"n{k}", f"f{k}", f"n{k + 1}", f"f{k + 1}") % "")
    top = leaf_levels
    ctes.append(f"""u0 AS (SELECT '' AS g, g AS of, d, row_number() OVER (ORDER BY g) - 1 AS pos FROM n{top}),
    h0 AS (SELECT '' AS g, doc_id, leaf, u0.pos AS spot, f, s, u0.d AS subroot FROM f{top} JOIN u0 ON u0.of = f{top}.g)""")
    for k in range(group_levels):
        ctes.append(level(f"u{k}", f"h{k}", f"u{k + 1}", f"h{k + 1}") % ", subroot")
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, leaf, subroot, u.d AS root, sha256(s) AS proof_sha256, f AS folded_root, f = u.d AS verified
FROM h{group_levels} JOIN u{group_levels} u USING (g)"""


@query("op13_merkle_manifest", oracle=_merkle_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    head, text = [c("doc_id"), c("source"), c("lang"), c("n_chars")], c("text")
    tampered = F.when(F.crc32(c("doc_id").cast("string").cast("binary")) % 5 == 0,
                      merkle_manifest.digest([*head, F.translate(text, capitals, capitals.lower())]))
    made = merkle_manifest.build(table(spark, sf_dir, "documents"), [*head, text], c("source"), c("doc_id"), tampered, carry=["doc_id"])
    return merkle_manifest.proofs(made).select("row.doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                                               (c("folded_root") == c("root")).alias("verified"))

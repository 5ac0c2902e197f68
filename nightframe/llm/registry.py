"""The numbered queries, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.llm import manifest, mixing, packing, quality_classifier, quality_rules, search, secrets, simhash, token_counts, toxicity, urls, warc, whitening
from nightframe.llm.common import new_path, stored, table
from nightframe.llm.labelled import remainder


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex(F.col("fp")[0]), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"), rows=20_000)
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(table(spark, sf_dir, "documents"), with_ids=False))


def op4_bm25(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = search.top_k_of_many(search.build_index(docs), docs.where(F.col("doc_id") % 20 == 0), k=10)
    return found.select("query_id", "rank", F.col("id").alias("doc_id"), "score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 3) == 1
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.passages(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        F.size("segments").alias("n_segments"),
    )


#: Target weights of the mix: names of a level not listed weigh 1.
MIX_WEIGHTS = [
    ("domain", "crawl", 2), ("domain", "web", 3), ("domain", "books", 5),
    ("lang", "en", 6), ("lang", "de", 2),
]


def mix_domain() -> Column:
    """The domain of a source: the large crawl, sources of one digit, sources of two."""
    source = F.col("source")
    return F.when(source == "src0", "crawl").when(F.length(source) <= 4, "web").otherwise("books")


def mix_weights(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(MIX_WEIGHTS, "level string, name string, weight int")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, mix_weights(spark), mix_domain(), budget_percent=50, max_epochs=2)
    return mixed.select("doc_id", "lang", "source", "mix_epoch", "mix_tokens", "mix_budget")


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    model = quality_classifier.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_classifier.judge(docs, model).select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        F.size("attention").alias("n_passages"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), folder)
    # of equal rows, which are one capture, each has its metadata record
    found = warc.captures(warc.read_records(spark, folder)).withColumn("page", F.explode("metadata"))
    note = F.decode(F.col("page.payload"), "UTF-8")
    response = F.col("type") == "response"
    named = found.select(
        "record_id",
        F.col("refers_to").alias("refers"),
        F.regexp_extract(note, r"(?m)^id: (-?\d+)", 1).try_cast("long").alias("page_id"),
        F.when(response, F.length("payload").cast("long"))
        .otherwise(F.regexp_extract(note, r"(?m)^payload-bytes: (\d+)", 1).try_cast("long")).alias("payload_bytes"),
        F.when(response, warc.base32_sha1(F.col("payload"))).otherwise(F.substring_index("digest", ":", -1)).alias("payload_digest"),
        F.col("type").alias("record_type"),
    )
    named = stored(named, "captures")
    first = named.where("record_type = 'response'").select(F.col("record_id").alias("refers"), F.col("page_id").alias("refers_to")).distinct()
    return named.join(first, "refers", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.learn(docs))
    return found.select(
        "doc_id",
        *[secrets.kind_count(F.col("base"), kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(secrets.as_text(F.col("base")), 256).alias("base_sha256"),
        secrets.as_text(F.col("spans")).alias("spans"),
    )


#: Rules of the contract, and the hosts of the blocklist.
URL_RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
]
BLOCKED_HOSTS = [
    f"{name}.example.{top}"
    for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")
    for top in ("com", "net", "org")
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocked = spark.createDataFrame([(h,) for h in BLOCKED_HOSTS], "entry string")
    return urls.judge(table(spark, sf_dir, "pages"), urls.build_index(blocked), URL_RULES)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fields = [lower if f == "text" else F.col(f) for f in manifest.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = manifest.manifest(docs, claimed=F.when(tampered, manifest.leaf_of(*fields)))
    return found.drop("source")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = whitening.whiten(vectors, whitening.fit(vectors))
    return found.withColumn("deviation", F.expr("try_cast(deviation AS long)"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a cache of its own for each call; a job names one that lasts
    cache = new_path(spark, "token-cache")
    found = token_counts.count_tokens(table(spark, sf_dir, "documents"), cache, "piece_bpe_32k.model")
    return found.withColumn("over_limit", F.col("n_tokens") > 4096)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality_rules": op2_quality_rules,
    "op3_packing": op3_packing,
    "op4_bm25": op4_bm25,
    "op5_toxicity": op5_toxicity,
    "op6_mixing": op6_mixing,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_warc": op8_warc,
    "op9_secrets": op9_secrets,
    "op10_urls": op10_urls,
    "op11_manifest": op11_manifest,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}


def _share_out_sql(parent: str, node: str) -> str:
    """``budget`` for rows of ``nodes(..., above, supply, weight)`` within ``parent``; see mixing.share_out."""
    order = f"weight <= 0, supply / nullif(weight, 0), {node}"
    return f"""
      SELECT *, (CASE WHEN exhausted THEN supply WHEN weight <= 0 THEN 0
                 ELSE weight * first_value(rest) OVER w // first_value(weights) OVER w END)::BIGINT AS budget
      FROM (
        SELECT *, weight > 0 AND supply * weights <= weight * rest AS exhausted
        FROM (
          SELECT *, above - coalesce(sum(supply) OVER b, 0) AS rest,
                 sum(weight) OVER (PARTITION BY {parent}) - coalesce(sum(weight) OVER b, 0) AS weights
          FROM nodes
          WINDOW b AS (PARTITION BY {parent} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        )
      )
      WINDOW w AS (PARTITION BY {parent} ORDER BY exhausted, {order}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"""


def _weight_sql(level: str) -> str:
    cases = "".join(f" WHEN '{name}' THEN {w}" for at, name, w in MIX_WEIGHTS if at == level)
    return f"(CASE {level}{cases} ELSE 1 END)::BIGINT" if cases else "1::BIGINT"


_OP6 = f"""
WITH d AS (
  SELECT doc_id, lang, source, coalesce(lang, '') AS l, coalesce(source, '') AS s,
         CASE WHEN source = 'src0' THEN 'crawl' WHEN length(source) <= 4 THEN 'web' ELSE 'books' END AS domain,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n
  FROM documents),
leaves AS (SELECT domain, l AS lang, s AS source, sum(n)::BIGINT AS tokens FROM d GROUP BY ALL),
domains AS (
  WITH nodes AS (
    SELECT domain, (2 * sum(tokens))::BIGINT AS supply, {_weight_sql("domain")} AS weight,
           ((SELECT sum(tokens) FROM leaves) * 50 // 100)::BIGINT AS above
    FROM leaves GROUP BY domain)
  {_share_out_sql("above", "domain")}),
langs AS (
  WITH nodes AS (
    SELECT domain, lang, (2 * sum(tokens))::BIGINT AS supply, {_weight_sql("lang")} AS weight, any_value(budget) AS above
    FROM leaves JOIN (SELECT domain, budget FROM domains) USING (domain) GROUP BY domain, lang)
  {_share_out_sql("domain", "lang")}),
ends AS (
  WITH nodes AS (
    SELECT domain, lang, source, tokens, 2 * tokens AS supply, {_weight_sql("source")} AS weight, budget AS above
    FROM leaves JOIN (SELECT domain, lang, budget FROM langs) USING (domain, lang))
  {_share_out_sql("domain, lang", "source")}),
plans AS (
  SELECT domain, lang, source, budget, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS whole,
         CASE WHEN tokens > 0 THEN budget % tokens ELSE budget END AS rest
  FROM ends),
placed AS (
  SELECT d.doc_id, d.lang, d.source, d.n, p.budget, p.whole, p.rest,
         sum(n) OVER (PARTITION BY d.domain, d.l, d.s ORDER BY md5('7:' || p.whole || ':' || coalesce(d.doc_id::VARCHAR, ''))) AS through
  FROM d JOIN plans p ON d.domain = p.domain AND d.l = p.lang AND d.s = p.source)
SELECT doc_id, lang, source, e::INTEGER AS mix_epoch, n AS mix_tokens, budget AS mix_budget
FROM (SELECT *, unnest(range(0, whole + CASE WHEN rest > 0 AND through <= rest THEN 1 ELSE 0 END)) AS e FROM placed)
"""

_OP8 = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS h FROM pages),
q AS (SELECT *, CASE WHEN page_id IS NULL THEN NULL ELSE max(page_id) OVER (PARTITION BY h, n) END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                               (('0x' || substr(h, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) % 32 + 1, 1)
                        FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id < first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < first THEN first END AS refers_to
FROM q
"""


def _url_sql() -> str:
    rules = sorted(URL_RULES, key=lambda r: (-len(r[1]), r[1]))
    rule = verdict = "CASE"
    for kind, text in rules:
        domain, _, start = text.partition("/")
        fits = f"(host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '/{start}')"
        rule += f" WHEN {fits} THEN '{text}'"
        verdict += f" WHEN {fits} THEN '{kind}'"
    blocked = " OR ".join(f"host = '{h}' OR ends_with(host, '.{h}')" for h in BLOCKED_HOSTS)
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u)
SELECT page_id, host, path, {rule} END AS rule,
       {verdict} WHEN {blocked} THEN 'block' ELSE 'allow' END AS verdict
FROM h
"""


def _manifest_sql(levels: int = 6, root_levels: int = 4) -> str:
    """The manifest level by level, up to 16**levels leaves a source. A node's siblings are its run's text without its own 64 letters."""

    def enc(value: str) -> str:
        text = f"{value}::VARCHAR"
        return f"coalesce(octet_length(encode({text}))::VARCHAR || ':' || {text}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(enc(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name: str, key: str, first: str, n: int) -> str:
        """``name_k(key, pos, node, n, run)`` of every level: a tree's ``n`` nodes with the text of the run that holds each."""
        run = f"string_agg(node, '' ORDER BY pos) OVER (PARTITION BY {key}, pos // 16)"
        parts = [f"{name}_0 AS (SELECT *, CASE WHEN n > 1 THEN {run} END AS run FROM ({first}))"]
        for k in range(1, n + 1):
            up = f"""SELECT {key}, pos // 16 AS pos, any_value(CASE WHEN n > 1 THEN sha256(run) ELSE node END) AS node, any_value((n + 15) // 16) AS n
              FROM {name}_{k - 1} GROUP BY {key}, pos // 16"""
            parts.append(f"{name}_{k} AS (SELECT *, CASE WHEN n > 1 THEN {run} END AS run FROM ({up}))")
        return ",\n".join(parts)

    def path(tree: str, key: str, pos: str, n: int) -> tuple[str, list[tuple[str, str]]]:
        """Joins with each level, and the texts left and right of the node in it; null above the top."""
        joins, sides = "", []
        for k in range(n):
            t, place = f"{tree}{k}", f"({pos} // {16**k})"
            joins += f"\n JOIN {tree}_{k} {t} ON {t}.{key} = p.{key} AND {t}.pos = {place}"
            sides.append((f"substr({t}.run, 1, 64 * ({place} % 16)::INT)", f"substr({t}.run, 64 * ({place} % 16)::INT + 65)"))
        return joins, sides

    joins, sides = path("s", "k", "p.pos", levels)
    root_joins, root_sides = path("r", "all_k", "p.root_at", root_levels)
    both = sides + root_sides
    proof = " || ".join(f"coalesce({a} || {b}, '')" for a, b in both)
    names = ", ".join(f"{a} AS l{i}, {b} AS r{i}" for i, (a, b) in enumerate(both))
    folds = "f0 AS (SELECT *, coalesce(tampered, leaf) AS h0 FROM named)"
    for i in range(len(both)):
        folds += f",\nf{i + 1} AS (SELECT *, CASE WHEN l{i} IS NULL THEN h{i} ELSE sha256(l{i} || h{i} || r{i}) END AS h{i + 1} FROM f{i})"
    top = f"h{len(both)}"
    bit = "CASE WHEN b % 2 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END"
    crc = f"""xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT),
      lambda a, c: list_reduce([xor(a, c)] || range(8), lambda b, i: {bit})))"""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    leaves = "SELECT k, pos, leaf AS node, count(*) OVER (PARTITION BY k) AS n FROM placed"
    roots = f"SELECT 1 AS all_k, row_number() OVER (ORDER BY k) - 1 AS pos, k, node, count(*) OVER () AS n FROM s_{levels}"
    return f"""
WITH placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM (SELECT doc_id, coalesce('=' || source, '-') AS k, {leaf("text")} AS leaf,
               CASE WHEN {crc} % 5 = 0 THEN {leaf(lower)} END AS tampered FROM documents)),
{tree("s", "k", leaves, levels)},
tops AS ({roots}),
{tree("r", "all_k", "SELECT all_k, pos, node, n FROM tops", root_levels)},
p AS (SELECT placed.*, tops.node AS subroot, tops.pos AS root_at, 1 AS all_k FROM placed JOIN tops USING (k)),
named AS (
  SELECT p.doc_id, p.leaf, p.tampered, p.subroot, (SELECT node FROM r_{root_levels}) AS root,
         sha256({proof}) AS proof_sha256, {names}
  FROM p {joins} {root_joins}),
{folds}
SELECT doc_id, leaf, subroot, root, proof_sha256, {top} AS folded_root, {top} = root AS verified FROM f{len(both)}
"""


ORACLE: dict[str, str] = {"op6_mixing": _OP6, "op8_warc": _OP8, "op10_urls": _url_sql(), "op11_manifest": _manifest_sql()}

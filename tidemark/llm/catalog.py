"""The named queries over the corpus tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, chosen_path, deleted_interp, fm_quality, hash_index, mixing, multi_index, pii_bootstrap, prefix_trie,
               rules_forest, sharding, suffix_runs, token_counts)
from .mixing import Level
from .tables import crc32_mod, keep, read

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rules_forest.apply_rules(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      "kept", "anomaly")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), limit=2048)


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.byte_shards(read(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text."""
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fm_quality.fit(docs, fm_quality.training_rows(read(spark, sf_dir, "labels")))
    return fm_quality.with_scores(docs, model, keep=["doc_id"]).select(
        "doc_id", fm_quality.held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return multi_index.search(vectors, F.col("id") % 20 == 0, k=20)


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deleted_interp.score(read(spark, sf_dir, "documents"), held_out=crc32_mod("doc_id", 5) == 1)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = chosen_path.jaccard_join(read(spark, sf_dir, "documents"), similarity=0.8, n=5)
    return out.select("doc_id", "class_id", "copy_id", "n_links")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.find(read(spark, sf_dir, "documents"))
    counts = [F.size(pii_bootstrap.of_kind(F.col("base"), k)).cast("long").alias(f"n_{name}")
              for k, name in enumerate(pii_bootstrap.KINDS)]
    return found.select("doc_id", *counts,
                        F.sha2(pii_bootstrap.render(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii_bootstrap.render(F.col("spans")).alias("spans"))


# Parameters of the mix: the token budget as a share of the corpus, epochs allowed, weights of the tree's values.
MIX_SHARE, MIX_EPOCHS, MIX_SEED = (1, 1), 2, 17
MIX_LEVELS = (
    Level("domain", {"domain0": 4, "domain1": 3, "domain2": 2}),
    Level("lang", {"en": 5, "de": 2, "fr": 2}),
    Level("source"),
)


def tree_columns() -> list:
    """The tree of the mix: domain (a rule on the source's last digit), language, source."""
    digit = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9])$", 1)
    domain = F.when(digit != "", F.concat(F.lit("domain"), (digit.cast("int") % 4).cast("string")))
    return [F.coalesce(domain, F.lit("unknown")).alias("domain"), F.coalesce("lang", F.lit("unknown")).alias("lang"),
            F.coalesce("source", F.lit("unknown")).alias("source")]


def mix_rows(docs: DataFrame) -> DataFrame:
    """Id, tree columns and word count of every document."""
    return docs.select("doc_id", *tree_columns(), mixing.word_tokens(F.col("text")).alias("tokens"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keep(mix_rows(read(spark, sf_dir, "documents")), "mix_rows")
    plan = mixing.plan(rows, MIX_LEVELS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixing.mix(rows, plan, MIX_LEVELS, MIX_SEED).select(
        "doc_id", "domain", "lang", "source", "tokens", "epoch")


def _weight_sql(level: Level) -> str:
    cases = " ".join(f"WHEN {level.column} = '{v}' THEN {w}" for v, w in level.weights.items())
    return f"CAST(CASE {cases} ELSE {level.other} END AS HUGEINT)" if cases else f"CAST({level.other} AS HUGEINT)"


def _mix_sql() -> str:
    """The mix as DuckDB SQL: one block of windows per tree level, then a running sum per leaf."""
    names = [lv.column for lv in MIX_LEVELS]
    parts = [r"""t AS (
  SELECT doc_id, tokens, lang, source,
    CASE WHEN digit <> '' THEN 'domain' || CAST(CAST(digit AS INT) % 4 AS VARCHAR) ELSE 'unknown' END AS domain
  FROM (SELECT doc_id, COALESCE(lang, 'unknown') AS lang, COALESCE(source, 'unknown') AS source,
    regexp_extract(COALESCE(source, ''), '([0-9])$', 1) AS digit,
    CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents))""",
             f"""leaf AS (SELECT {', '.join(names)}, SUM(tokens) AS tokens, SUM(tokens) * {MIX_EPOCHS} AS cap
  FROM t GROUP BY ALL)""",
             f"""n0 AS (SELECT LEAST(SUM(tokens) * {MIX_SHARE[0]} // {MIX_SHARE[1]}, SUM(cap)) AS budget FROM leaf)"""]
    for k, lv in enumerate(MIX_LEVELS):
        mine, above = ", ".join(names[: k + 1]), ", ".join(names[:k])
        by = f"PARTITION BY {above}" if k else ""
        prior = f"({by} ORDER BY CAST(cap AS DOUBLE) / CAST(w AS DOUBLE), {lv.column} "                 "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
        parts.append(f"""c{k} AS (SELECT * FROM (SELECT {mine}, SUM(cap) AS cap, {_weight_sql(lv)} AS w FROM leaf
  GROUP BY {mine}) AS q {f'JOIN n{k} USING ({above})' if k else 'CROSS JOIN n0'})""")
        parts.append(f"""r{k} AS (SELECT *, budget - COALESCE(SUM(cap) OVER {prior}, 0) AS b,
  SUM(w) OVER ({by}) - COALESCE(SUM(w) OVER {prior}, 0) AS ws FROM c{k})""")
        parts.append(f"""n{k + 1} AS (SELECT {mine}, CASE WHEN cap * ws <= b * w THEN cap ELSE LEAST(cap,
  MAX(CASE WHEN cap * ws > b * w THEN b END) OVER ({by}) * w
  // MAX(CASE WHEN cap * ws > b * w THEN ws END) OVER ({by})) END AS budget FROM r{k})""")
    using = ", ".join(names)
    parts.append(f"""goal AS (SELECT {using}, budget // tokens AS full_epochs, budget % tokens AS rest
  FROM leaf JOIN n{len(names)} USING ({using}) WHERE tokens > 0)""")
    parts.append(f"""keyed AS (SELECT t.*, full_epochs, rest,
  md5('{MIX_SEED}:' || CAST(full_epochs AS VARCHAR) || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')) AS k
  FROM t JOIN goal USING ({using}))""")
    parts.append(f"""run AS (SELECT *, SUM(tokens) OVER (PARTITION BY {using} ORDER BY k) AS upto FROM keyed)""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, {using}, tokens, CAST(UNNEST(range(CAST(full_epochs + CASE WHEN upto <= rest THEN 1 ELSE 0 END
  AS BIGINT))) AS INT) AS epoch FROM run"""


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_index.exact_duplicates(read(spark, sf_dir, "documents"))


OP11_SQL = r"""WITH t AS (SELECT doc_id, COALESCE(text, '') AS whole,
    regexp_replace(COALESCE(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(whole) DESC, doc_id)"""


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one document of ten, by the checksum of its id, the words from some place on repeat with a period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    laid = (docs.select("doc_id", "text", words.alias("w"), F.floor(h / 10).cast("long").alias("g"))
            .withColumn("n", F.size("w"))
            .withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
            .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    unit = F.slice("w", F.col("a") + 1, F.least(F.col("p"), F.col("n") - F.col("a")))
    rounds = F.flatten(F.array_repeat(unit, F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")))
    rebuilt = F.array_join(F.slice(F.concat(F.slice("w", F.lit(1), F.col("a")), rounds), F.lit(1), F.col("n")), " ")
    return laid.select("doc_id", F.when(F.col("n") > 0, rebuilt).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_runs.periodic_runs(with_planted_periods(read(spark, sf_dir, "documents")), min_words=24, min_periods=3)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"),
        best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def with_shared_starts(conversations: DataFrame) -> DataFrame:
    """Every conversation with up to three turns of the first of its twenty ids in place of its own."""
    c = F.col("conv")
    taken = (F.crc32(c.cast("string").cast("binary")) % 4).cast("int")
    heads = conversations.where(c % 20 == 0).select(c.alias("_head"), F.slice("turns", 1, 3).alias("_start"))
    start = F.coalesce(F.slice("_start", F.lit(1), taken), F.slice("turns", 1, 0))
    rest = F.slice("turns", taken + 1, F.size("turns"))
    return (conversations.withColumn("_head", c - c % 20).join(heads, "_head", "left")
            .select("conv", F.concat(start, rest).alias("turns")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = keep(prefix_trie.sequences(read(spark, sf_dir, "conversations")), "own_turns")
    return prefix_trie.trie(with_shared_starts(own))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_token_counts": op2_token_counts,
    "op3_sharding": op3_sharding,
    "op4_bpe": op4_bpe,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_pii": op9_pii,
    "op10_mixing": op10_mixing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLE: dict[str, str] = {"op10_mixing": _mix_sql(), "op11_exact_dedup": OP11_SQL}

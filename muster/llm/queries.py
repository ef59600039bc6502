"""Driver queries of the operators, each with the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from muster.llm.batches import bound_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from muster.llm.packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP6_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS win, least(13, len(w)) AS size
    FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0)
),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM (SELECT doc_id, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size)
),
hits AS (SELECT DISTINCT doc_id, i, bw.size, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.size = bw.size),
marked AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM hits) GROUP BY 1),
named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN marked USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query("op6_decontamination", OP6_SQL)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.contamination import mark_contaminated

    marked = mark_contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@query("op8_language")
def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.language import fit_language, predict_language

    docs = _table(spark, sf_dir, "documents")
    return predict_language(docs, fit_language(docs)).select("doc_id", "held_out", "lang_pred", "score")


@query("op4_toxicity")
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.toxicity import fit_toxicity, score_toxicity

    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.credentials import find_secrets, fit_formats

    docs = _table(spark, sf_dir, "documents")
    return find_secrets(docs, fit_formats(docs)).drop("found")


@query("op7_main_text")
def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.wrappers import extract_pages

    return extract_pages(_table(spark, sf_dir, "pages"))



@query("op3_embedding_dedup")
def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.vectors import link_vectors

    return link_vectors(_table(spark, sf_dir, "embeddings"))


@query("op10_suffix_dedup")
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.suffixes import remove_repeats

    return remove_repeats(_table(spark, sf_dir, "documents"))


@query("op9_jaccard_join")
def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.shingles import link_documents

    return link_documents(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op1_surrogates")
def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.surrogates import replace_entities

    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_entities(docs, count_col="n_entities")


def _merkle_sql(low: int = 8, high: int = 4) -> str:
    """Levels written out: as many as ``8^low`` documents of a language and ``8^high`` languages have."""
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: list_transform(range(8), lambda k: (ascii(c) >> k) & 1)))"
    crc = f"xor(list_reduce(list_concat([4294967295::BIGINT], {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b::BIGINT) & 1))), 4294967295)"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    field = lambda v: f"coalesce(strlen(({v})::VARCHAR)::VARCHAR || ':' || ({v})::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(v) for v in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    steps = [
        f"leaves AS (SELECT doc_id, lang, {leaf('text')} AS h, CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(lower)} END AS t FROM documents)",
        "a0 AS (SELECT coalesce('+' || lang, '') AS tree, doc_id, h, coalesce(t, h) AS t, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY lang) AS n"
        " FROM leaves WINDOW w AS (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h))",
    ]

    def levels(name: str, count: int) -> None:
        for k in range(count):
            run = "PARTITION BY tree, i // 8 ORDER BY i ROWS BETWEEN"
            steps.append(f"{name}s{k} AS (SELECT tree, i, coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,"
                         f" coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k} WHERE n > 1)")
            steps.append(f"{name}{k + 1} AS (SELECT tree, i // 8 AS i, (n + 7) // 8 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h FROM {name}{k} WHERE n > 1 GROUP BY 1, 2, 3)")

    levels("a", low)
    steps.append("tops AS (" + " UNION ALL ".join(f"SELECT tree, h FROM a{k} WHERE n = 1" for k in range(low + 1)) + ")")
    steps.append("b0 AS (SELECT '' AS tree, tree AS name, h, row_number() OVER (ORDER BY encode(tree)) - 1 AS i, count(*) OVER () AS n FROM tops)")
    levels("b", high)
    steps.append("root AS (" + " UNION ALL ".join(f"SELECT h FROM b{k} WHERE n = 1" for k in range(high + 1)) + ")")
    steps.append("f0 AS (SELECT a0.doc_id, a0.h AS leaf, a0.tree, a0.i, b0.i AS j, b0.h AS subroot, root.h AS root, a0.t AS f, '' AS p FROM a0 JOIN b0 ON a0.tree = b0.name CROSS JOIN root)")
    joins = [(f"as{k}", f"s.tree = f.tree AND s.i = f.i // {8 ** k}") for k in range(low)] + [(f"bs{k}", f"s.i = f.j // {8 ** k}") for k in range(high)]
    for k, (table, on) in enumerate(joins):
        steps.append(f"f{k + 1} AS (SELECT f.* REPLACE (CASE WHEN s.l IS NULL THEN f ELSE sha256(s.l || f || s.r) END AS f, p || coalesce(s.l || s.r, '') AS p) FROM f{k} f LEFT JOIN {table} s ON {on})")
    return f"WITH {', '.join(steps)} SELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM f{len(joins)}"


@query("op13_merkle_manifest", _merkle_sql())
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.manifest import manifest

    return manifest(_table(spark, sf_dir, "documents"))


@query("op12_cross_tokenizer")
def op12_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from muster.llm.alignment import align_documents

    return align_documents(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS win
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d)
),
least AS (SELECT win, min(doc_id) AS first FROM windows GROUP BY win),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM windows JOIN least USING (win) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query("op11_substring_dedup", OP11_SQL)
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from muster.llm.subtrees import remove_passages

    return remove_passages(_table(spark, sf_dir, "documents"))

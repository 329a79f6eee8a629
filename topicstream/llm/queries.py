"""The registered queries of these operators and, where SQL can express them, the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from topicstream.llm import (
    conversations,
    exact_dedup,
    fingerprints,
    group_packing,
    licenses,
    line_dedup,
    merkle,
    mixing,
    near_dedup,
    packing,
    quality,
    substring_dedup,
    url_filters,
)
from topicstream.llm.common import table, word_count, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return placed.select(
        "doc_id",
        "piece",
        "start",
        F.col("length").cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "sequence_id",
        "offset",
    )


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op4_exact_dedup"] = r"""
    WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
               FROM documents)
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, text_sha256
    FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


@query
def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), words=3, percent=85)


def train_quality(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """A model from the rows of ``docs`` that have a label and are not held out."""
    label = F.col("quality").cast("int")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_of"), label.alias("_label"))
    seen = docs.where(~quality.held_out(F.col("doc_id"))).select("doc_id", "text")
    labelled = seen.join(labels, seen["doc_id"] == labels["_of"]).drop("_of")
    return quality.train(labelled, label_col="_label")


@query
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, train_quality(spark, docs, sf_dir))


@query
def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = written(
        table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes"
    )
    return mixing.mix(sized).select("doc_id", "size", "source_size", "target", "taken", "copies")


ORACLES["op10_source_mixing"] = r"""
    WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                      ('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT AS place FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size,
                 [5.0::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
          FROM d GROUP BY source),
    l AS (SELECT *, 2 * source_size / weight AS level, sum(source_size) OVER () AS words FROM s),
    f AS (SELECT *, row_number() OVER o AS nth,
                 (1.5::DOUBLE * words - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS fill
          FROM l WINDOW o AS (ORDER BY level, source NULLS LAST)),
    t AS (SELECT source, source_size, least(weight * (SELECT arg_min(fill, nth) FROM f WHERE fill <= level),
                                            2 * source_size::DOUBLE) AS target FROM f),
    r AS (SELECT d.*, source_size, target, target / source_size AS rate,
                 CASE WHEN abs(rate - round(rate)) < 1e-9 THEN round(rate) ELSE floor(rate) END::BIGINT AS whole,
                 abs(rate - round(rate)) >= 1e-9 AS parted
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
    e AS (SELECT *, CASE WHEN parted THEN greatest(0, least(size, round(target)::BIGINT - sum(whole * size) OVER (PARTITION BY source)
                         - coalesce(sum(size) OVER (PARTITION BY source ORDER BY place, doc_id, size
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) ELSE 0 END::BIGINT AS extra
          FROM r)
    SELECT doc_id, size, source_size, target, (whole * size + extra)::BIGINT AS taken,
           (whole + CASE WHEN extra > 0 AND 2 * extra >= size THEN 1 ELSE 0 END)::INTEGER AS copies
    FROM e
"""


def license_sql() -> str:
    """The scan as joins: base phrases and notices are tables, and words are rows."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    postings, votes = licenses.index()
    base = ", ".join(f"({quoted(licenses.words_of(p))}, '{label}')" for p, label in licenses.BASE)
    notices = ", ".join(
        f"({n}, '{label}', {quoted(licenses.words_of(text))}, {votes[n]})"
        for n, (label, text, _) in enumerate(licenses.NOTICES)
    )
    keys = ", ".join(f"({n}, {at}, {quoted(words)})" for n, found in enumerate(licenses.key_phrases()) for at, words in found)
    rare = ", ".join(f"('{word}', {n}, {at})" for word, places in postings.items() for n, at in places)
    return rf"""
    WITH base(phrase, label) AS (VALUES {base}),
    notices(n, label, words, votes) AS (VALUES {notices}),
    keys(n, pos, words) AS (VALUES {keys}),
    rare(word, n, pos) AS (VALUES {rare}),
    d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    p AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
    b AS (SELECT doc_id, i, label FROM p JOIN base ON p.word = phrase[1] JOIN d USING (doc_id)
          WHERE w[i + 1 : i + len(phrase)] = phrase),
    v AS (SELECT doc_id, rare.n, i - pos AS shift FROM p JOIN rare USING (word) GROUP BY doc_id, rare.n, i - pos
          HAVING count(*) >= (SELECT votes FROM notices WHERE notices.n = rare.n)),
    nw AS (SELECT n, unnest(words) AS word, unnest(range(len(words))) AS j FROM notices),
    f AS (SELECT doc_id, label, (SELECT count(*) FROM nw WHERE nw.n = v.n AND shift + j >= 0 AND w[shift + j + 1] = word)
                 / len(words) AS share
          FROM v JOIN notices USING (n) JOIN d USING (doc_id)
          WHERE NOT EXISTS (SELECT 1 FROM keys WHERE keys.n = v.n
                            AND (shift + pos < 0 OR w[shift + pos + 1 : shift + pos + len(keys.words)] <> keys.words))),
    bs AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
                  string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
    ls AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
           FROM (SELECT doc_id, label FROM b UNION ALL SELECT doc_id, label FROM f) GROUP BY doc_id),
    fs AS (SELECT doc_id, max(share) AS share FROM f GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
           coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0::DOUBLE) END AS score
    FROM d LEFT JOIN bs USING (doc_id) LEFT JOIN ls USING (doc_id) LEFT JOIN fs USING (doc_id)
    """


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("notices")


ORACLES["op2_license_scan"] = license_sql()


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number its path ends with; low quality and toxic count as bad."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.regexp_extract(url_filters.path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    labels = table(spark, sf_dir, "labels").select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    named = pages.select("url", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))
    return url_filters.judge(pages, url_filters.mine(named.join(labels, "doc_id")))


@query
def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fingerprints.fingerprint(table(spark, sf_dir, "documents"))
    return made.select("*", F.sha2("edited", 256).alias("edited_sha256")).drop("edited")


@query
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.shared_passages(table(spark, sf_dir, "documents"))


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.near_lines(table(spark, sf_dir, "documents")).drop("text")


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify_documents(table(spark, sf_dir, "documents"))


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: unicode(ch)::BIGINT)"
    bit = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    byte = f"list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, _: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {byte}), 4294967295)"


def merkle_sql(levels: int = 10) -> str:
    """Every level of every tree as a table, then every leaf's siblings level by level. Trees of up to 8^10 leaves."""

    def leaf(text: str) -> str:
        field = "coalesce(octet_length(encode({0}::VARCHAR))::VARCHAR || ':' || {0}::VARCHAR, '-')"
        return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"""d AS (SELECT doc_id, lang, {leaf("text")} AS leaf,
            CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 3 = 0 THEN {leaf(lower)} END AS changed FROM documents)""",
        "a0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)",
        "g0 AS (SELECT lang AS tree, i, leaf AS node FROM a0)",
    ]
    for prefix in "gt":
        if prefix == "t":
            ctes.append(
                f"""t0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY (tree IS NOT NULL), encode(tree)) - 1 AS i, node,
                    tree AS of FROM g{levels})"""
            )
        for k in range(levels):
            ctes.append(
                f"""{prefix}{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN n = 1 THEN any_value(node)
                    ELSE sha256(string_agg(node, '' ORDER BY i)) END AS node
                    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {prefix}{k}) GROUP BY tree, i // 8, n)"""
            )
    ctes.append("s0 AS (SELECT *, lang AS tree, '' AS siblings, coalesce(changed, leaf) AS folded FROM a0)")
    before = "s0"
    for prefix in "gt":
        if prefix == "t":
            ctes.append(
                f"""u0 AS (SELECT s.* EXCLUDE (i, tree), '' AS tree, t0.i, t0.node AS subroot
                    FROM {before} s JOIN t0 ON s.lang IS NOT DISTINCT FROM t0.of)"""
            )
            before = "u0"
        for k in range(levels):
            # A run of one node in a tree of one is that tree's root: it has no siblings and is not hashed again.
            now = f"{prefix}s{k}"
            ctes.append(
                f"""{now}r AS (SELECT *, i // 8 AS run, count(*) OVER (PARTITION BY tree) AS n FROM {prefix}{k})"""
            )
            ctes.append(
                f"""{now} AS (SELECT s.* REPLACE (s.i // 8 AS i,
                        siblings || CASE WHEN runs.n = 1 THEN '' ELSE array_to_string(runs.nodes[:s.i % 8] || runs.nodes[s.i % 8 + 2:], '') END AS siblings,
                        CASE WHEN runs.n = 1 THEN folded ELSE
                            sha256(array_to_string(runs.nodes[:s.i % 8] || [folded] || runs.nodes[s.i % 8 + 2:], '')) END AS folded)
                    FROM {before} s JOIN (SELECT tree, run, n, list(node ORDER BY i) AS nodes FROM {now}r GROUP BY tree, run, n) runs
                    ON s.tree IS NOT DISTINCT FROM runs.tree AND s.i // 8 = runs.run)"""
            )
            before = now
    return (
        "WITH "
        + ", ".join(ctes)
        + f""" SELECT doc_id, leaf, subroot, r.node AS root, sha256(siblings) AS proof_sha256, folded AS folded_root,
               folded = r.node AS verified FROM {before} CROSS JOIN (SELECT node FROM t{levels}) r"""
    )


ORACLES["op11_merkle_manifest"] = merkle_sql()


@query
def op12_group_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    packed = group_packing.pack_in_groups(docs, tokenizer_path("word_bpe_49k.json"))
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.prefix_trie(table(spark, sf_dir, "conversations"))


ORACLES["op13_conversation_trie"] = rf"""
    WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               WHERE conv_id IS NOT NULL),
    i AS (SELECT c, turn, substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32) AS id,
                 len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT AS words FROM t),
    o AS (SELECT c, list(id ORDER BY turn NULLS FIRST, id, words) AS ids, list(words ORDER BY turn NULLS FIRST, id, words) AS words
          FROM i GROUP BY c),
    h AS (SELECT o.c, {crc32_sql("o.c::VARCHAR")} % 4 AS h, b.ids AS bids, b.words AS bwords, o.ids, o.words
          FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20),
    r AS (SELECT c, coalesce(bids[:h], []) || ids[h + 1:] AS ids, coalesce(bwords[:h], []) || words[h + 1:] AS words FROM h),
    p AS (SELECT c, d, array_to_string(ids[:d], '') AS path, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, len(ids) = d AS ends
          FROM r, unnest(range(0, len(ids) + 1)) u(d)),
    n AS (SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
                 sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
          FROM p GROUP BY path),
    k AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
    s AS (SELECT left(n.path, 32 * a.d) AS path, sum(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
                 sum((n_convs - 1) * words)::BIGINT AS saved_tokens
          FROM n LEFT JOIN k USING (path), unnest(range(0, depth + 1)) a(d) GROUP BY 1)
    SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
           saved_tokens, n.ends_sha256
    FROM n LEFT JOIN k USING (path) JOIN s USING (path)
    LEFT JOIN n up ON n.depth > 0 AND up.path = left(n.path, 32 * (n.depth - 1))
"""

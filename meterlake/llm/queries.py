"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterlake.llm.bpe import round_trip
from meterlake.llm.common import table
from meterlake.llm.fingerprint import compare_with_next
from meterlake.llm.hilbert import pack_documents
from meterlake.llm.leaks import leak_digests
from meterlake.llm.merkle import manifest_check
from meterlake.llm.neardup import near_duplicates
from meterlake.llm.quality import classify
from meterlake.llm.radix import exact_groups
from meterlake.llm.secrets import find_secrets
from meterlake.llm.sharding import shard_documents
from meterlake.llm.substrings import remove_repeats
from meterlake.llm.trie import shared_prefix_trie
from meterlake.llm.wrappers import extract_text

Query = Callable[[SparkSession, str], DataFrame]


def op1_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


def op2_dart_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op3_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op5_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))


def op6_debruijn_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


def op7_radix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_page_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op9_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op10_bpe_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op11_leak_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leak_digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared_prefix_trie(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_check(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quartile_digest": op1_quartile_digest,
    "op2_dart_neardup": op2_dart_neardup,
    "op3_site_quality": op3_site_quality,
    "op4_linked_secrets": op4_linked_secrets,
    "op5_label_shards": op5_label_shards,
    "op6_debruijn_repeats": op6_debruijn_repeats,
    "op7_radix_dedup": op7_radix_dedup,
    "op8_page_wrappers": op8_page_wrappers,
    "op9_hilbert_packing": op9_hilbert_packing,
    "op10_bpe_replay": op10_bpe_replay,
    "op11_leak_scan": op11_leak_scan,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_SPACES = r"[\x20\x09-\x0D]+"

_VALUE = r"""["'']?\x20*[:=]\x20*["'']?"""  # a quote is doubled within SQL text


def _either(names: str) -> str:
    """ASCII letters in either case; a flag would fold others onto them."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in names)


_FOUND = {
    "assign": rf"(?:(?:{_either('password|passwd|secret|token|api_?key')}){_VALUE}"
    r"([A-Za-z0-9+/_.=-]+))",
    "access": r"(AKIA[A-Z0-9]{12,})",
    "hex": r"([0-9a-f]{32,})",
    "identifier": rf"(\b(?:{_either('user_?name|user_?id|user|login|client_id|account_?id')})"
    rf"{_VALUE}[A-Za-z0-9_.@-]{{3,}})",
    "secret": rf"(\b(?:{_either('pwd|pass|passphrase|secret_key|private_key|auth')})"
    rf"{_VALUE}[A-Za-z0-9+/_.=-]{{4,}})",
    "endpoint": rf"(\b(?:{_either('https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp')})"
    r"://[A-Za-z0-9._~:/?#@%&=+-]+"
    rf"|\b(?:{_either('host|server|endpoint')}){_VALUE}[A-Za-z0-9.-]{{3,}})",
}
_MATCHES = " UNION ALL ".join(
    f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank,
        regexp_extract_all(text, '(?s)(.*?)({pattern})', 1) AS gaps,
        regexp_extract_all(text, '(?s)(.*?)({pattern})', 2) AS matches,
        regexp_extract_all(text, '(?s)(.*?)({pattern})', 3) AS words FROM texts"""
    for rank, (kind, pattern) in enumerate(_FOUND.items())
)
_LINKED_SECRETS = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    matches AS ({_MATCHES}),
    single AS (
        SELECT doc_id, kind, rank, unnest(gaps) AS gap, unnest(matches) AS body,
               unnest(words) AS word, generate_subscripts(gaps, 1) AS i FROM matches),
    placed AS (
        SELECT *, sum(length(gap) + length(body)) OVER (
            PARTITION BY doc_id, kind ORDER BY i) AS last FROM single),
    spans AS (
        SELECT doc_id, last - length(body) AS first, last,
               CASE WHEN kind = 'assign' AND length(word) < 8 THEN 4 ELSE rank END AS rank
        FROM placed WHERE kind <> 'assign' OR length(word) >= 4),
    parts AS (
        SELECT *, ['assign', 'access', 'hex', 'identifier', 'secret', 'endpoint'][rank + 1] AS kind,
               CASE WHEN rank IN (1, 3) THEN 'identifier' WHEN rank = 5 THEN 'endpoint'
                    ELSE 'secret' END AS role
        FROM spans),
    linked AS (
        SELECT doc_id, first, rank, kind || ':' || first || ':' || last AS span FROM parts a
        WHERE rank < 3 OR EXISTS (
            SELECT 1 FROM parts b
            WHERE a.doc_id = b.doc_id AND greatest(b.first - a.last, a.first - b.last) <= 200
              AND CASE a.rank WHEN 4 THEN b.role <> 'secret' ELSE b.role = 'secret' END)),
    found AS (
        SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign,
               count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
               string_agg(span, ',' ORDER BY first, rank) FILTER (rank < 3) AS base,
               string_agg(span, ',' ORDER BY first, rank) AS spans,
               count(*) FILTER (rank > 2) AS n_linked
        FROM linked GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
           coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
           coalesce(spans, '') AS spans, coalesce(n_linked, 0) AS n_linked
    FROM texts LEFT JOIN found USING (doc_id)"""


def _plain_words(table: str, key: str) -> str:
    return f"""
        SELECT {key}, list_filter(string_split_regex(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'),
            '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
        FROM {table}"""


_LEAK_SCAN = f"""
    WITH docs AS ({_plain_words("documents", "doc_id")}),
    items AS ({_plain_words("benchmark", "item_id")}),
    sized AS (SELECT *, least(10, len(words)) AS size FROM items WHERE len(words) > 0),
    windows AS (
        SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS body
        FROM sized, unnest(range(1, len(words) - size + 2)) AS t(i)),
    found AS (
        SELECT doc_id, i, sizes.size, array_to_string(words[i:i + sizes.size - 1], ' ') AS body
        FROM docs, (SELECT DISTINCT size FROM windows) AS sizes,
             unnest(range(1, len(words) - sizes.size + 2)) AS t(i)),
    hits AS (SELECT doc_id, i, size, item_id FROM found JOIN windows USING (size, body)),
    places AS (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS place FROM hits),
    counted AS (SELECT doc_id, count(*) AS n_hit FROM places GROUP BY doc_id),
    named AS (
        SELECT doc_id, count(DISTINCT item_id) AS n_items,
               string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))
                   AS ids
        FROM hits GROUP BY doc_id)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AS contaminated
    FROM docs LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)"""


def _written(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || {value}, '-')"


def _leaf(n_chars: str) -> str:
    fields = ["doc_id", "source", "lang", n_chars, "text"]
    return f"sha256({' || '.join(_written(field) for field in fields)})"


_CRC32 = """CAST(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
        range(1, strlen(CAST(doc_id AS VARCHAR)) + 1),
        lambda i: ascii(substr(CAST(doc_id AS VARCHAR), CAST(i AS INTEGER), 1))::BIGINT)),
    lambda crc, byte: list_reduce(
        list_prepend(xor(crc, byte), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
        lambda c, b: xor(c >> 1, (c & 1) * 3988292384::BIGINT))) AS BIGINT)"""


def crc32_sql(key: str) -> str:
    """CRC-32 of a decimal id, bit by bit: DuckDB has no function for it."""
    return f"xor({_CRC32.replace('doc_id', key)}, 4294967295::BIGINT)"


_NEXT_LEVEL = """
    SELECT {tree}, level + 1, list_transform(
        range(0, (len(nodes) + 1) // 2), lambda i:
        sha256(nodes[CAST(2 * i + 1 AS BIGINT)] || coalesce(nodes[CAST(2 * i + 2 AS BIGINT)], '')))
    FROM {levels} WHERE len(nodes) > 1"""

_MERKLE = f"""
    WITH RECURSIVE leaves AS (
        SELECT doc_id, coalesce('=' || lang, '-') AS tree, {_leaf("n_chars")} AS leaf,
            CASE WHEN {crc32_sql("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")}
                 ELSE {_leaf("n_chars")} END AS changed
        FROM documents),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1
            AS place FROM leaves),
    levels AS (
        SELECT tree, 0 AS level, list(leaf ORDER BY place) AS nodes FROM placed GROUP BY tree
        UNION ALL {_NEXT_LEVEL.format(tree="tree", levels="levels")}),
    subroots AS (
        SELECT tree, nodes[1] AS subroot, max(level) OVER () AS deepest, level AS height,
               row_number() OVER (ORDER BY tree) - 1 AS place
        FROM levels WHERE len(nodes) = 1),
    top AS (
        SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
        UNION ALL SELECT level, nodes FROM (
            {_NEXT_LEVEL.format(tree="0", levels="top")}) AS t(nothing, level, nodes)),
    steps AS (
        SELECT tree, place, level, nodes[CAST(xor(place >> level, 1) + 1 AS BIGINT)] AS sibling,
               (place >> level) & 1 = 1 AS on_the_right
        FROM placed JOIN levels USING (tree) WHERE len(nodes) > 1
        UNION ALL
        SELECT p.tree, p.place, s.height + level,
               nodes[CAST(xor(s.place >> level, 1) + 1 AS BIGINT)],
               (s.place >> level) & 1 = 1
        FROM placed p JOIN subroots s USING (tree), top WHERE len(nodes) > 1),
    folded AS (
        SELECT tree, place, 0 AS level, changed AS node FROM placed
        UNION ALL
        SELECT f.tree, f.place, f.level + 1, sha256(
            CASE WHEN on_the_right THEN sibling || node ELSE node || coalesce(sibling, '') END)
        FROM folded f JOIN steps s
            ON f.tree = s.tree AND f.place = s.place AND f.level = s.level),
    proofs AS (
        SELECT tree, place, string_agg(sibling, '' ORDER BY level) AS proof
        FROM steps GROUP BY tree, place)
    SELECT doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) AS proof_sha256,
           folded_root, folded_root = root AS verified
    FROM placed p
    JOIN (SELECT tree, subroot FROM subroots) USING (tree)
    JOIN (SELECT tree, place, max_by(node, level) AS folded_root FROM folded
          GROUP BY tree, place) USING (tree, place)
    LEFT JOIN proofs USING (tree, place),
    (SELECT nodes[1] AS root FROM top WHERE len(nodes) = 1)"""

_PREFIX_TRIE = f"""
    WITH original AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, digest)
            AS turns
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
                     sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '')
                            || coalesce(text, '')) AS digest
              FROM conversations WHERE conv_id IS NOT NULL)
        GROUP BY conv_id),
    shared AS (SELECT *, CAST({crc32_sql("conv_id")} % 4 AS BIGINT) AS h FROM original),
    rebuilt AS (
        SELECT s.conv_id, list_concat(coalesce(b.turns, [])[1:h], s.turns[h + 1:]) AS turns
        FROM shared s LEFT JOIN original b ON b.conv_id = s.conv_id - s.conv_id % 20),
    paths AS (
        SELECT conv_id, depth, turns[1:depth] AS node, turns[1:depth - 1] AS above,
               depth = len(turns) AS ends,
               CASE WHEN depth = 0 THEN 0 ELSE len(list_filter(string_split_regex(
                   turns[depth].text, '{_SPACES}'), lambda w: w <> '')) END AS words
        FROM rebuilt, unnest(range(0, len(turns) + 1)) AS t(depth)),
    nodes AS (
        SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id,
               count(*) AS n_convs, any_value(words) AS words,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                   FILTER (ends), '')) AS ends_sha256
        FROM paths GROUP BY depth, node),
    counted AS (
        SELECT n.*, coalesce(c.n_children, 0) AS n_children
        FROM nodes n LEFT JOIN (
            SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM nodes
            WHERE depth > 0 GROUP BY ALL) c USING (depth, node)),
    summed AS (
        SELECT a.depth, a.node, sum((c.n_children = 0)::INT) AS n_leaves,
               sum((c.n_convs - 1) * c.words) AS saved_tokens
        FROM counted c JOIN paths a ON a.conv_id = c.conv_id AND a.depth <= c.depth
        GROUP BY a.depth, a.node)
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
           CAST(s.n_leaves AS BIGINT) AS n_leaves, CAST(s.saved_tokens AS BIGINT) AS saved_tokens,
           n.ends_sha256
    FROM counted n JOIN summed s USING (depth, node)
    LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.above"""

ORACLE_SQL: dict[str, str] = {
    "op12_prefix_trie": _PREFIX_TRIE,
    "op13_merkle_manifest": _MERKLE,
    "op11_leak_scan": _LEAK_SCAN,
    "op4_linked_secrets": _LINKED_SECRETS,
    "op7_radix_dedup": f"""
        WITH normal AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '{_SPACES}', ' ', 'g') AS body
            FROM documents)
        SELECT doc_id,
               min(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = min(doc_id) OVER same AS kept,
               sha256(body) AS text_sha256
        FROM normal
        WINDOW same AS (PARTITION BY body)""",
    "op6_debruijn_repeats": f"""
        WITH words AS (
            SELECT doc_id, list_filter(
                string_split_regex(coalesce(text, ''), '{_SPACES}'), lambda w: w <> '') AS words
            FROM documents),
        windows AS (
            SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS body
            FROM words, unnest(range(1, len(words) - 48)) AS t(i)),
        found AS (
            SELECT doc_id, i, min(doc_id) OVER (PARTITION BY body) < doc_id AS again
            FROM windows),
        gone AS (
            SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM found WHERE again),
        places AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id)
        SELECT doc_id,
               len(words) AS n_words,
               coalesce(len(places), 0) AS n_removed,
               sha256(array_to_string(CASE WHEN places IS NULL THEN words ELSE list_filter(
                   words, lambda w, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
        FROM words LEFT JOIN places USING (doc_id)""",
}

"""DuckDB SQL for the queries of this package that it can express.

The others rest on a 64-bit hash that DuckDB lacks (op1), fitted models (op5, op6, op9), rewriting with offsets (op2)
or greedy and seeded choices (op4, op7, the pipeline); tests hold those against brute force.
"""

from __future__ import annotations

from silvertide.llm.host_reputation import SHARED_SUFFIXES

_PARTS = r"""
    parts AS (
        SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path
        FROM pages
    )"""


def _level(name: str, source: str, key: str) -> str:
    """Two tables: the strength of a level's prior, and the level with its posterior mean and weight."""
    return f"""
    {name}_strength AS (
        SELECT coalesce(least(greatest(CASE WHEN r > 0 THEN 1 / r - 1 ELSE 1000.0 END, 1.0), 1000.0), 1000.0) AS k FROM (
            SELECT CASE WHEN sum(n) > count(*) THEN (sum(n * (good / n - above) * (good / n - above) / (above * (1 - above))) - count(*)) / (sum(n) - count(*)) ELSE 0 END AS r
            FROM {source} WHERE n > 0
        )
    ),
    {name} AS (SELECT {key}, (good + k * above) / (n + k) AS mean, n + k AS weight FROM {source}, {name}_strength)"""


_SHARED = ", ".join(f"'{suffix}'" for suffix in sorted(SHARED_SUFFIXES))

OP3 = rf"""
WITH {_PARTS},
    named AS (SELECT host, try_cast(nullif(regexp_extract(path, '/([0-9]+)[^/0-9]*/?$', 1), '') AS BIGINT) AS doc_id FROM parts),
    marks AS (
        SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 ELSE 0 END) AS good
        FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
    ),
    counted AS (
        SELECT host, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', '', 's'), ':[0-9]*$', ''), '\.$', '') AS bare,
            coalesce(sum(good), 0)::DOUBLE AS good, count(good)::DOUBLE AS n
        FROM named LEFT JOIN marks USING (doc_id) GROUP BY host
    ),
    cut AS (SELECT *, string_split(bare, '.') AS labels, regexp_matches(bare, '^([0-9]+\.){{3}}[0-9]+$|^\[') AS address FROM counted),
    levels AS (
        SELECT *, CASE WHEN array_to_string(labels[-3:], '.') IN ({_SHARED}) THEN 3 WHEN array_to_string(labels[-2:], '.') IN ({_SHARED}) THEN 2 ELSE 1 END AS k
        FROM cut
    ),
    hosts AS (
        SELECT host, good, n, CASE WHEN address THEN bare ELSE array_to_string(labels[-(k + 1):], '.') END AS domain,
            CASE WHEN address THEN bare ELSE array_to_string(labels[-k:], '.') END AS suffix
        FROM levels
    ),
    suffix_in AS (
        SELECT suffix, sum(good) AS good, sum(n) AS n, (SELECT (sum(good) + 1) / (sum(n) + 2) FROM hosts) AS above
        FROM hosts GROUP BY suffix
    ),{_level("suffix_out", "suffix_in", "suffix")},
    domain_in AS (
        SELECT h.domain, sum(h.good) AS good, sum(h.n) AS n, any_value(s.mean) AS above
        FROM hosts h JOIN suffix_out s USING (suffix) GROUP BY h.domain
    ),{_level("domain_out", "domain_in", "domain")},
    host_in AS (SELECT h.host, h.good, h.n, d.mean AS above FROM hosts h JOIN domain_out d USING (domain)),{_level("host_out", "host_in", "host")},
    ruled AS (
        SELECT *, CASE
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule FROM parts
    )
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM ruled LEFT JOIN host_out USING (host)
"""

OP8 = """
WITH known AS (
        SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ),
    firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM known WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM known LEFT JOIN firsts USING (payload_digest)
"""

_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x{00}-\x{2F}\x{3A}-\x{60}\x{7B}-\x{7F}]+')"
)

OP10 = rf"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
    item AS (SELECT item_id, {_WORDS} AS words FROM benchmark),
    item_windows AS (
        SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS gram
        FROM (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM item WHERE len(words) > 0)
    ),
    lengths AS (SELECT DISTINCT n FROM item_windows),
    doc_windows AS (
        SELECT r, i, n, array_to_string(words[i : i + n - 1], ' ') AS gram
        FROM (SELECT r, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM doc, lengths)
    ),
    hits AS (SELECT r, i, n, item_id FROM doc_windows JOIN item_windows USING (n, gram)),
    hit_words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + n)) AS w FROM hits) GROUP BY r),
    found AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r
    )
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_words USING (r) LEFT JOIN found USING (r)
"""

# CRC-32 from the polynomial: a table of 256 entries by rule, then one look-up per byte.
_CRC_TABLE = """
    crc_table AS (
        SELECT list(list_reduce(list_prepend(i, range(8)), lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) ORDER BY i) AS entries
        FROM (SELECT unnest(range(256)) AS i)
    )"""


def _crc(value: str) -> str:
    """CRC-32 of a text, from crc_table's entries."""
    bytes_ = f"list_transform(range(strlen({value})), lambda k: ('0x' || substr(hex(encode({value})), 2 * k + 1, 2))::BIGINT)"
    step = "lambda v, b: xor(v >> 8, entries[(xor(v, b) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), {step}), 4294967295)"


_TURN_WORDS = r"len(regexp_extract_all(text, '[^\x{20}\x{09}-\x{0D}]+'))"

OP12 = rf"""
WITH {_CRC_TABLE},
    turns AS (
        SELECT conv_id, turn, words, md5(length(role) || ':' || role || text) AS mark
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, {_TURN_WORDS} AS words FROM
            (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL))
    ),
    own AS (SELECT conv_id, list({{'mark': mark, 'words': words}} ORDER BY turn NULLS FIRST, mark) AS seq FROM turns GROUP BY conv_id),
    heads AS (SELECT conv_id, seq, {_crc("conv_id::VARCHAR")} % 4 AS h FROM own, crc_table),
    rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.seq, [])[1 : c.h], c.seq[c.h + 1 :]) AS seq
        FROM heads c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
    ),
    paths AS (
        SELECT conv_id, d, len(seq) = d AS ends, CASE WHEN d > 0 THEN seq[d].words ELSE 0 END AS words,
            array_to_string(list_transform(seq[1 : d], lambda x: x.mark), '') AS path
        FROM (SELECT conv_id, seq, unnest(range(len(seq) + 1)) AS d FROM rebuilt)
    ),
    nodes AS (
        SELECT path, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
        FROM paths GROUP BY path
    ),
    children AS (SELECT substr(path, 1, 32 * (depth::INT - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    sums AS (
        SELECT substr(path, 1, 32 * k::INT) AS path, sum(CASE WHEN n_children IS NULL THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
        FROM (SELECT path, n_children, n_convs, words, unnest(range(depth + 1)) AS k FROM nodes LEFT JOIN children USING (path)) GROUP BY 1
    )
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
    n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (path) LEFT JOIN children USING (path)
LEFT JOIN nodes p ON n.depth > 0 AND p.path = substr(n.path, 1, 32 * (n.depth::INT - 1))
"""

OP13 = rf"""
WITH {_CRC_TABLE},
    texts AS (
        SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents
    ),
    own AS (SELECT r, unnest(words) AS word FROM texts),
    wanted AS (SELECT unnest({_WORDS}) AS word FROM benchmark),
    buckets AS (SELECT word, {_crc("word")} % 10000 AS bucket FROM (SELECT word FROM own UNION SELECT word FROM wanted), crc_table),
    s AS (SELECT bucket, count(*) AS n FROM own JOIN buckets USING (word) GROUP BY bucket),
    t AS (SELECT bucket, count(*) AS n FROM wanted JOIN buckets USING (word) GROUP BY bucket),
    sizes AS (SELECT (SELECT count(*) FROM own) + 10000 AS s_all, (SELECT count(*) FROM wanted) + 10000 AS t_all),
    gains AS (
        SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * s_all / ((s.n + 1)::DOUBLE * t_all)))::BIGINT AS gain
        FROM s LEFT JOIN t USING (bucket), sizes
    ),
    weights AS (
        SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM own JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r
    ),
    scored AS (
        SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
            coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
        FROM texts LEFT JOIN weights USING (r)
    ),
    ranked AS (
        SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST, n_features DESC) END AS place,
            count(*) FILTER (WHERE n_features >= 20) OVER () AS n
        FROM scored
    )
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM ranked
"""


def all_statements() -> dict[str, str]:
    return {
        "op3_host_reputation": OP3, "op8_warc": OP8, "op10_decontaminate": OP10, "op12_prefix_trie": OP12,
        "op13_importance_resampling": OP13,
    }

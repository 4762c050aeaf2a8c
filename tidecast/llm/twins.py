"""DuckDB SQL for those corpus queries that SQL can express."""

from __future__ import annotations

from .queries import RULES

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


def decontamination() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"""
WITH words AS (
    SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, '{word}') AS w FROM documents
), items AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({lower("coalesce(text, '')")}, '{word}') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + 9], ' ') AS win
    FROM items, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(w) - 9))) AS i) WHERE len(w) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS win
    FROM words, sizes, LATERAL (SELECT unnest(generate_series(1, CAST(len(w) - size + 1 AS BIGINT))) AS i)
), hits AS (
    SELECT p.doc_id, p.i, p.size, v.item FROM places p JOIN windows v ON p.win = v.win AND p.size = v.size
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT DISTINCT doc_id, i, size FROM hits) h, LATERAL (SELECT unnest(generate_series(i, i + size - 1)) AS place) GROUP BY 1
), found AS (
    SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY 1
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def warc() -> str:
    return """
WITH p AS (
    SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def jaccard() -> str:
    return f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all({lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE
        list_distinct(list_transform(generate_series(1, greatest(1, len(w) - 2)), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
    FROM words
), each AS (SELECT doc_id, unnest(s) AS g FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM each a JOIN each b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
    SELECT c.a, c.b FROM common c JOIN sets x ON x.doc_id = c.a JOIN sets y ON y.doc_id = c.b
    WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)
), ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
    SELECT doc_id, doc_id AS r FROM sets
    UNION
    SELECT reach.doc_id, ways.b FROM reach JOIN ways ON ways.a = reach.r
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM sets s JOIN reach USING (doc_id) GROUP BY 1, 2
"""


def sharding() -> str:
    def number(text: str, digits: int) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"

    return f"""
WITH r AS (
    SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size, coalesce(text, '') AS t,
        coalesce('=' || source, '-') AS stratum, {number("'42:' || CAST(doc_id AS VARCHAR)", 15)} AS draw
    FROM documents
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY draw, doc_id) - 1 AS k, count(*) OVER (PARTITION BY stratum) AS n FROM r
), placed AS (
    SELECT *, (CAST(k AS DOUBLE) + CAST({number("'42:' || stratum", 8)} AS DOUBLE) / CAST(4294967296 AS DOUBLE)) / CAST(n AS DOUBLE) AS place FROM ranked
), cut AS (
    SELECT *, row_number() OVER (ORDER BY place, stratum, draw, doc_id) - 1 AS pos, count(*) OVER () AS total FROM placed
)
SELECT doc_id, size, {crc32("t")} AS text_crc32, 'rows' AS law, CAST(pos * 8 // total AS INTEGER) AS shard,
    CAST(pos - ((pos * 8 // total) * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM cut
"""


def crc32(text: str) -> str:
    """CRC-32 of a text's UTF-8 bytes, bit by bit: DuckDB has no function for it."""
    each = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    step = "xor(a, x) & 255"
    for _ in range(8):
        step = f"list_transform([{step}], lambda c: xor(c >> 1, 3988292384 * (c & 1)))[1]"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {each}), lambda a, x: xor(a >> 8, {step})), 4294967295::BIGINT)"


def urls() -> str:
    def rest(url: str) -> str:
        return f"CASE WHEN instr({url}, '://') > 0 THEN substr({url}, instr({url}, '://') + 3) END"

    def host(url: str) -> str:
        return f"coalesce({lower(f'regexp_extract({rest(url)}, {chr(39)}^[^/?#]*{chr(39)}, 0)')}, '')"

    def path(url: str) -> str:
        return f"coalesce(regexp_extract({rest(url)}, '^[^/?#]*([^?#]*)', 1), '')"

    def node(url: str) -> str:
        given = f"string_split(regexp_extract({rest(url)}, '^[^?#]*\\?([^#]*)', 1), '&')"
        query = f"array_to_string(list_filter({given}, lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_|ref=|gclid=|fbclid=)')), '&')"
        return (
            f"CASE WHEN {rest(url)} IS NOT NULL THEN {host(url)} || regexp_replace({path(url)}, '/+$', '') || "
            f"CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END END"
        )

    def fits(verdict: bool) -> str:
        ordered = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
        cases = " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v if verdict else h + p}'" for v, h, p in ordered
        )
        return f"CASE {cases} END"

    links = "list_filter(regexp_extract_all(html, '(?i)<link\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*[\"'']?canonical\\b'))"
    metas = "list_filter(regexp_extract_all(html, '(?i)<meta\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\\bhttp-equiv\\s*=\\s*[\"'']?refresh\\b'))"
    href = "list_transform({}, lambda t: regexp_extract(t, '(?i)\\b{}\\s*=\\s*[\"'']?\\s*([^\"''\\s>]+)', 1))"
    return f"""
WITH RECURSIVE p AS (
    SELECT page_id, url, {host("url")} AS host, {path("url")} AS path, {node("url")} AS node,
        list_concat({href.format(links, "href")}, {href.format(metas, "url")}) AS targets
    FROM pages
), judged AS (SELECT *, {fits(False)} AS rule, {fits(True)} AS own FROM p),
found AS (SELECT node, host, path, unnest(targets) AS t FROM p WHERE node IS NOT NULL),
full_target AS (
    SELECT node, CASE WHEN instr(t, '://') > 0 THEN t WHEN starts_with(t, '//') THEN 'http:' || t
        WHEN starts_with(t, '/') THEN 'http://' || host || t
        WHEN starts_with(t, '#') OR starts_with(t, '?') THEN 'http://' || host || path || t
        ELSE 'http://' || host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || t END AS u
    FROM found WHERE t <> ''
), edges AS (SELECT node AS a, {node("u")} AS b, {host("u")} AS host, {path("u")} AS path FROM full_target),
ways AS (SELECT a, b FROM edges WHERE b IS NOT NULL UNION SELECT b, a FROM edges WHERE b IS NOT NULL),
votes AS (
    SELECT node, own AS v FROM judged WHERE node IS NOT NULL AND own IS NOT NULL
    UNION SELECT b, {fits(True)} FROM edges WHERE {fits(True)} IS NOT NULL
), reach AS (
    SELECT DISTINCT node, node AS r FROM p WHERE node IS NOT NULL
    UNION SELECT reach.node, ways.b FROM reach JOIN ways ON ways.a = reach.r
), groups AS (SELECT reach.node, min(v) AS v FROM reach JOIN votes ON votes.node = reach.r GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(own, v, 'allow') AS verdict FROM judged LEFT JOIN groups USING (node)
"""


#: Levels that the statement unrolls for a tree: 16 ** 6 leaves.
MERKLE_LEVELS = 6


def merkle() -> str:
    def leaf(text: str) -> str:
        values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    def levels(name: str) -> str:
        return ", ".join(
            f"""{name}{k + 1} AS MATERIALIZED (
    SELECT tree, i // 16 AS i, CASE WHEN any_value(m) = 1 THEN min(d) ELSE sha256(string_agg(d, '' ORDER BY i)) END AS d,
        count(*) OVER (PARTITION BY tree) AS m
    FROM {name}{k} GROUP BY tree, i // 16
), {name}_run{k} AS MATERIALIZED (
    SELECT tree, i // 16 AS i, any_value(m) AS m, list(d ORDER BY i) AS run FROM {name}{k} GROUP BY tree, i // 16
)"""
            for k in range(MERKLE_LEVELS)
        )

    def path(name: str, base: str, tree: str, place: str) -> str:
        steps, at, source = [], place, base
        for k in range(MERKLE_LEVELS):
            others = "array_to_string(list_concat(r.run[:p.i % 16], r.run[p.i % 16 + 2:]), '')"
            mine = "array_to_string(list_concat(r.run[:p.i % 16], [p.fold], r.run[p.i % 16 + 2:]), '')"
            steps.append(
                f"""{name}_path{k + 1} AS MATERIALIZED (
    SELECT p.* EXCLUDE (i, proof, fold), p.i // 16 AS i, p.proof || CASE WHEN r.m = 1 THEN '' ELSE {others} END AS proof,
        CASE WHEN r.m = 1 THEN p.fold ELSE sha256({mine}) END AS fold
    FROM {source} p JOIN {name}_run{k} r ON r.tree = p.{tree} AND r.i = p.i // 16
)"""
            )
            source = f"{name}_path{k + 1}"
        return ", ".join(steps)

    lower_text = f"CASE WHEN {crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {lower('text')} ELSE text END"
    return f"""
WITH leaves AS MATERIALIZED (
    SELECT doc_id, coalesce('=' || source, '-') AS tree, {leaf("text")} AS d, {leaf(lower_text)} AS claim FROM documents
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS i, count(*) OVER (PARTITION BY tree) AS m FROM leaves
), node0 AS MATERIALIZED (SELECT tree, i, d, m FROM placed), {levels("node")},
top0 AS MATERIALIZED (
    SELECT '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, d, count(*) OVER () AS m, tree AS name FROM node{MERKLE_LEVELS}
), {levels("top")},
start AS (SELECT doc_id, tree, d AS leaf, i, '' AS proof, claim AS fold FROM placed), {path("node", "start", "tree", "i")},
joined AS (
    SELECT p.doc_id, p.leaf, t.d AS subroot, '' AS top, t.i, p.proof, p.fold FROM node_path{MERKLE_LEVELS} p JOIN top0 t ON t.name = p.tree
), {path("top", "joined", "top", "i")}
SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = d AS verified
FROM top_path{MERKLE_LEVELS}, top{MERKLE_LEVELS}
"""


def filter_audit() -> str:
    words = "regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+')"
    return f"""
WITH RECURSIVE texts AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {words} AS w,
        doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS later
    FROM documents
), marks AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
masks AS MATERIALIZED (
    SELECT part, (len(w) < 200)::INT + 2 * (100 * list_unique(w) < 50 * len(w))::INT
        + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(later, false)::INT AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
    FROM texts LEFT JOIN marks USING (doc_id)
), counts AS MATERIALIZED (
    SELECT part, f, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM masks GROUP BY 1, 2
), orders AS (
    SELECT '' AS o UNION ALL
    SELECT o || chr(65 + k) FROM orders, (SELECT unnest(range(5))::INT AS k) WHERE NOT contains(o, chr(65 + k)) AND length(o) < 5
), steps AS MATERIALIZED (
    SELECT o AS filter_order, s AS step, 1 << (ord(o[s]) - 65) AS own,
        CAST(coalesce(list_sum(list_transform(range(1, s), lambda j: 1 << (ord(o[j]) - 65))), 0) AS INTEGER) AS before
    FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE length(o) = 5
), found AS (
    SELECT part, filter_order, step, own,
        sum(n) FILTER (f & (before | own) = 0) AS kept, sum(n) FILTER (f & before = 0 AND f & own > 0) AS removed,
        sum(n) FILTER (f & before > 0 AND f & own > 0) AS redundant, sum(n) FILTER (f = own) AS unique_fails,
        sum(g) FILTER (f & before = 0 AND f & own > 0) AS good_lost, sum(x) FILTER (f & before = 0 AND f & own > 0) AS toxic_lost
    FROM counts, steps GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step,
    {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
    CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM found
"""


def build() -> dict[str, str]:
    return {
        "op3_decontamination": decontamination(),
        "op4_warc": warc(),
        "op7_jaccard": jaccard(),
        "op8_sharding": sharding(),
        "op10_urls": urls(),
        "op12_merkle": merkle(),
        "op13_filter_audit": filter_audit(),
    }

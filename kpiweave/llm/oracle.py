"""The registered queries that SQL can express, in DuckDB's SQL."""

from __future__ import annotations

from kpiweave.llm import divergence, fingerprint, urlfilter

MIX = r"""
WITH sized AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           substr(md5(coalesce(text, '')), 1, 16) AS digest,
           (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT % 256)::INT AS slot
    FROM documents
), classed AS (
    SELECT *, CASE WHEN size > 0 THEN length(bin(size)) * 8 + ((size * 8) >> (length(bin(size)) - 1)) % 8 ELSE 0 END AS bin
    FROM sized
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM classed GROUP BY source
), ranked AS (
    SELECT *, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight,
           source_size * 2.0::DOUBLE AS room, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
    FROM sources
), levels AS (
    SELECT *, row_number() OVER w AS k,
           ((SELECT sum(source_size) FROM sources) * 1.5::DOUBLE - coalesce(sum(room) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
           / sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM ranked WINDOW w AS (ORDER BY room / weight, place)
), goal AS (
    SELECT source, source_size, least(room, coalesce((SELECT level FROM levels WHERE room > level * weight ORDER BY k LIMIT 1) * weight, room)) AS target,
           ('0x' || substr(md5('mix:' || coalesce(source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
    FROM levels
), placed AS (
    SELECT c.doc_id, c.size, g.source_size, g.target, g.shift,
           CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS rate,
           row_number() OVER (PARTITION BY c.source ORDER BY c.bin, c.slot, c.size, c.doc_id NULLS LAST, c.digest) AS place
    FROM classed c JOIN goal g ON c.source IS NOT DISTINCT FROM g.source
), copied AS (
    SELECT *, least(floor(shift + rate * place) - floor(shift + rate * (place - 1)), ceil(rate))::BIGINT AS copies FROM placed
)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""


def url_filter() -> str:
    upper, lower = urlfilter.UPPER, urlfilter.LOWER
    rounds = []
    for kind, weight, src, dst in (("trust", "allowed", "src", "dst"), ("distrust", "blocked", "dst", "src")):
        rounds.append(
            f"{kind}_edge AS (SELECT {src} AS src, {dst} AS dst, n / sum(n) OVER (PARTITION BY {src}) AS part FROM links), "
            f"{kind}0 AS (SELECT host AS node, {weight}::DOUBLE AS mass FROM hosts WHERE {weight} > 0)"
        )
        for i in range(1, urlfilter.ROUNDS + 1):
            rounds.append(
                f"{kind}{i} AS MATERIALIZED (SELECT node, sum(mass) AS mass FROM ("
                f"SELECT dst AS node, part * mass * {urlfilter.DAMPING} AS mass FROM {kind}{i - 1} JOIN {kind}_edge ON node = src "
                f"UNION ALL SELECT node, mass FROM {kind}0) GROUP BY node)"
            )
    last = urlfilter.ROUNDS
    host = rf"translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), '{upper}', '{lower}')"
    path = r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '')"
    link = urlfilter.LINK.replace("'", "''")
    return f"""
WITH parsed AS (SELECT page_id, {host} AS host, {path} AS path, regexp_extract_all(html, '{link}', 1) AS found FROM pages),
matched AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM parsed),
ruled AS (SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' END AS said FROM matched),
hosts AS (SELECT host, count(*) AS pages, count(*) FILTER (said = 'allow') AS allowed, count(*) FILTER (said = 'block') AS blocked
          FROM ruled WHERE host <> '' GROUP BY host),
links AS (SELECT src, dst, count(*)::DOUBLE AS n FROM (
    SELECT host AS src, translate(unnest(found), '{upper}', '{lower}') AS dst FROM ruled WHERE host <> '') WHERE src <> dst GROUP BY src, dst),
{", ".join(rounds)},
scored AS (SELECT h.host, round((coalesce(d.mass, 0) - coalesce(t.mass, 0)) / pages, 9) AS score FROM hosts h
    LEFT JOIN trust{last} t ON t.node = h.host LEFT JOIN distrust{last} d ON d.node = h.host)
SELECT page_id, r.host, path, rule, coalesce(said, CASE WHEN score >= {urlfilter.THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled r LEFT JOIN scored s ON r.host = s.host
"""


def merkle() -> str:
    f = fingerprint
    leaf = lambda t: (
        f"list_transform(regexp_extract_all({t}, '[^\\n]{{1,{f.PIECE}}}|\\n+'), lambda p: substr(sha256(p), 1, {f.DIGITS}) || ':' || length(p)::VARCHAR)"
    )
    section = lambda a: (
        f"list_transform(range(0, greatest(len({a}) - 1, 0) // {f.SECTION} + 1), lambda i: "
        f"substr(sha256(array_to_string({a}[i * {f.SECTION} + 1 : i * {f.SECTION} + {f.SECTION}], ',')), 1, {f.DIGITS}))"
    )
    tree = lambda s, a: f"concat_ws('/', sha256(array_to_string({s}, ',')), array_to_string({s}, ','), array_to_string({a}, ','))"
    weight = lambda a: f"coalesce(list_sum(list_transform({a}, lambda x: split_part(x, ':', 2)::BIGINT)), 0)"
    like = lambda a, b: (
        f"CASE WHEN {weight(f'list_distinct({a})')} + {weight(f'list_distinct({b})')} = 0 THEN 1.0::DOUBLE ELSE "
        f"(2 * {weight(f'list_intersect({a}, {b})')})::DOUBLE / ({weight(f'list_distinct({a})')} + {weight(f'list_distinct({b})')}) END"
    )
    zipped = lambda a, b: (
        f"coalesce(list_position(list_transform(range(1, greatest(len({a}), len({b})) + 1), lambda i: {a}[i] IS DISTINCT FROM {b}[i]), true), 0)"
    )
    return f"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS text, {leaf("coalesce(text, '')")} AS leaf FROM documents),
linked AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(leaf) OVER w, first_value(leaf) OVER w) AS next_leaf
    FROM base WINDOW w AS (ORDER BY doc_id DESC NULLS LAST, text ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
edited AS (SELECT *, length(text) AS n, substr(text, 1, length(text) - length(text) // 2) || substr(next_text, 1, length(text) // 2) AS edited FROM linked),
leafy AS (SELECT *, {leaf("edited")} AS edited_leaf FROM edited),
sectioned AS (SELECT *, {section("leaf")} AS section, {section("edited_leaf")} AS edited_section,
    {zipped("leaf", "edited_leaf")} AS front, {zipped("list_reverse(leaf)", "list_reverse(edited_leaf)")} AS back FROM leafy),
cut AS (SELECT *, CASE WHEN front = 0 THEN least(len(leaf), len(edited_leaf)) ELSE front - 1 END AS head,
    CASE WHEN back = 0 THEN least(len(leaf), len(edited_leaf)) ELSE back - 1 END AS agreed FROM sectioned)
SELECT doc_id, n AS n_chars, sha256(edited) AS edited_sha256, {tree("section", "leaf")} AS fingerprint, {tree("edited_section", "edited_leaf")} AS edited_fingerprint,
    {like("leaf", "edited_leaf")} AS near_edited, {like("leaf", "next_leaf")} AS near_next,
    CASE WHEN front > 0 THEN {weight("leaf[1:head]")} END::BIGINT AS changed_start,
    CASE WHEN front > 0 THEN n - {weight("leaf[len(leaf) - least(agreed, least(len(leaf), len(edited_leaf)) - head) + 1 : len(leaf)]")} END::BIGINT AS changed_end
FROM cut
"""


TOP_K = """
WITH coded AS (SELECT vec_id, list_sum(list_transform(range(0, 64), lambda i: CASE WHEN coalesce(embedding[i + 1], 0) > 0 THEN 1::HUGEINT << i::INT ELSE 0::HUGEINT END))::UBIGINT AS code
    FROM embeddings WHERE embedding IS NOT NULL),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, bit_count(xor(q.code, c.code))::INT AS distance FROM coded q JOIN coded c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, vec_id, distance FROM pairs
QUALIFY rank <= 10
"""


def divergence_sql() -> str:
    term, upper, lower = divergence.TERM, divergence.UPPER, divergence.LOWER
    scale, least, top = divergence.SCALE, divergence.MIN_DOCS, divergence.TOP_TERMS
    return f"""
WITH base AS (
    SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
    FROM documents
), words AS (
    SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}')) AS term FROM base
), counts AS (
    SELECT lang, source, term, count(*)::HUGEINT AS cnt, count(DISTINCT rid) AS docs FROM words GROUP BY lang, source, term
), kept AS (
    SELECT lang, term FROM counts GROUP BY lang, term HAVING sum(docs) >= {least}
), sizes AS (
    SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang
), groups AS (
    SELECT DISTINCT lang, source FROM base
), dense AS (
    SELECT g.lang, g.source, k.term, coalesce(c.cnt, 0) AS cnt
    FROM groups g JOIN kept k ON g.lang = k.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), gp AS (
    SELECT d.lang, d.source, d.term, d.cnt,
           1 + ({scale}::HUGEINT * (d.cnt + 2)) // (sum(d.cnt) OVER (PARTITION BY d.lang, d.source) + 2 * s.v) AS p
    FROM dense d JOIN sizes s ON d.lang = s.lang
), lt AS (
    SELECT lang, term, sum(cnt) AS cnt FROM dense GROUP BY lang, term
), lp AS (
    SELECT l.lang, l.term, 1 + ({scale}::HUGEINT * (l.cnt + 2)) // (sum(l.cnt) OVER (PARTITION BY l.lang) + 2 * s.v) AS q
    FROM lt l JOIN sizes s ON l.lang = s.lang
), pair_sums AS (
    SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
    FROM gp x JOIN gp y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
    GROUP BY x.lang, x.source, y.source
), pairs AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
    SELECT g.lang, g.source, 'term' AS part, g.term AS item, (((g.p - l.q) * (g.p - l.q)) // (g.p + l.q))::BIGINT AS value
    FROM gp g JOIN lp l ON g.lang = l.lang AND g.term = l.term
    WHERE g.cnt > 0 AND g.p > l.q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item ASC)::INTEGER AS rank
    FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {top}
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix_sources": MIX,
        "op5_url_filter": url_filter(),
        "op6_exact_top_k": TOP_K,
        "op10_merkle_fingerprints": merkle(),
        "op11_source_divergence": divergence_sql(),
    }

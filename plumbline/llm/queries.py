"""The queries of this subpackage, and the SQL of those that SQL can state."""

import public_tokenizers
from pyspark.sql import functions as F

from plumbline.llm.centroid_clusters import cluster_vectors
from plumbline.llm.chat_format import rotate
from plumbline.llm.decontamination import find_contamination
from plumbline.llm.language_id import fit_language_id, is_held_out, predict_language
from plumbline.llm.license_scan import PHRASES, TEMPLATES, least_words, scan_licenses, template_words
from plumbline.llm.mixing import mix_sources
from plumbline.llm.near_duplicates import near_duplicates
from plumbline.llm.quality_rules import BASE_RULES, apply_quality_rules
from plumbline.llm.simhash import simhash_groups
from plumbline.llm.suffix_dedup import remove_repeats
from plumbline.llm.token_counts import count_tokens
from plumbline.llm.url_filter import filter_urls
from plumbline.llm.vector_codes import code_vectors

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"), carry=["doc_id"])


def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = is_held_out("doc_id")
    network = fit_language_id(docs, ~held_out)
    found = predict_language(docs.select("doc_id", "text"), network, carry=["doc_id"])
    return found.withColumn("held_out", held_out).select("doc_id", "held_out", "lang_pred", "score")


def op3_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs, carry=["doc_id"])


def op4_near_duplicates(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op5_source_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


BASE_FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def op6_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = apply_quality_rules(docs, facts=BASE_FACTS, carry=["doc_id"])
    failed = [r.failed({f: F.col(f) for f in BASE_FACTS}) for r in BASE_RULES]
    return found.select("doc_id", *BASE_FACTS, F.greatest(*failed).alias("base_failed"), "kept")


def op7_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op8_suffix_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, carry=["doc_id"])


def op9_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(docs, table(spark, sf_dir, "benchmark"), carry=["doc_id"], unnamed=True)
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_chat_format(spark, sf_dir):
    found = rotate(table(spark, sf_dir, "conversations"))
    spans = F.transform("mask", lambda m: F.concat_ws("-", m["first"], m["end"]))
    learned = F.aggregate("mask", F.lit(0), lambda n, m: n + m["end"] - m["first"])
    return found.select(
        "conv_id",
        "speaker",
        "part",
        "n_messages",
        "rendered",
        F.array_join(spans, ",").alias("mask"),
        learned.cast("long").alias("n_learned"),
    )


def op11_centroid_clustering(spark, sf_dir):
    return cluster_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), carry=["vec_id"])


def op12_vector_codes(spark, sf_dir):
    return code_vectors(table(spark, sf_dir, "embeddings"), carry=["vec_id"])


def op13_simhash_dedup(spark, sf_dir):
    return simhash_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_language_id,
        op3_license_scan,
        op4_near_duplicates,
        op5_source_mixing,
        op6_quality_rules,
        op7_url_filter,
        op8_suffix_dedup,
        op9_decontamination,
        op10_chat_format,
        op11_centroid_clustering,
        op12_vector_codes,
        op13_simhash_dedup,
    )
}

PLAIN_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

SPACED_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _list(values):
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _phrase_places():
    found = []
    for phrase, label in PHRASES.items():
        test = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(phrase.split()))
        places = f"list_filter(range(1, len(w) + 1), lambda i: coalesce({test}, false))"
        found.append(f"SELECT doc_id, '{label}' AS label, unnest({places}) - 1 AS pos FROM d")
    return " UNION ALL ".join(found)


def _templates():
    rows = []
    for label, text in TEMPLATES:
        ws = template_words(text)
        rows.append(f"('{label}', {_list(ws)}, {least_words(len(ws))})")
    return ", ".join(rows)


def _url_rules():
    return ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


def _gap(a, b):
    return f"list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"


def _floor_mean(total, n):
    return f"(({total} - (({total} % {n}) + {n}) % {n}) // {n})::BIGINT"


FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _integers(scale):
    return f"list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT)"


def _cluster_sql(clusters=16, rounds=3):
    """Rounds of assignment and means over numbered rows, one WITH table for each."""
    steps = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, {_integers(64)} AS q FROM embeddings
          WHERE {FINITE} AND len(embedding) = 64)""",
        f"""c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), q) - 1 AS c, q AS m FROM v
          QUALIFY c < {clusters})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, vec_id, q, c, d FROM (SELECT r, vec_id, q, c, {_gap("q", "m")} AS d
          FROM v, c{i}) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN (SELECT c,
          list(x ORDER BY k) AS m FROM (SELECT c, k, {_floor_mean("sum(q[k])", "count(*)")} AS x
          FROM a{i}, range(1, 65) t(k) GROUP BY c, k) GROUP BY c) n USING (c))""")
    last = f"a{rounds}"
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, c::INTEGER AS cluster, d::BIGINT AS distance,
          (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
          sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM {last} JOIN c{rounds} USING (c)"""


def _code_sql(parts=16, entries=64, rounds=2):
    """As for clusters, for each part position."""
    steps = [
        f"""v AS (SELECT row_number() OVER () AS r, vec_id, label, {_integers(256)} AS q FROM embeddings WHERE {FINITE}),
        w AS (SELECT len(q) // {parts} AS w FROM v LIMIT 1),
        s AS (SELECT r, vec_id, p, q[p * w + 1:p * w + w] AS q FROM v, w, range({parts}) t(p))""",
        f"""b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, q) - 1 AS e, q AS m FROM s
          QUALIFY e < {entries})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT r, p, q, e, d FROM (SELECT r, p, s.q, e, {_gap("s.q", "m")} AS d
          FROM s JOIN b{i} USING (p)) QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT p, e, coalesce(n.m, o.m) AS m FROM b{i} o LEFT JOIN (SELECT p, e,
          list(x ORDER BY k) AS m FROM (SELECT p, e, k, {_floor_mean("sum(q[k])", "count(*)")} AS x
          FROM (SELECT p, e, q, unnest(range(1, len(q) + 1)) AS k FROM a{i}) GROUP BY p, e, k) GROUP BY p, e) n
          USING (p, e))""")
    return f"""WITH {", ".join(steps)},
        f AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
          FROM a{rounds} GROUP BY r),
        h AS (SELECT sha256(string_agg(array_to_string(m, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
        FROM v JOIN f USING (r), h"""


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"
FAILED = f"""{BASE_FAILED} OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 10 * n_symbols > n_words
  OR 2 * n_dup_lines > n_lines OR 2 * n_capitals > n_letters OR 2 * n_letters < word_chars"""

SQL = {
    "op3_license_scan": rf"""
        WITH l AS (SELECT doc_id, translate(coalesce(text, ''), '{CAPITALS}', '{SMALL}') AS text FROM documents),
        d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM l),
        b AS (SELECT doc_id, label, count(*) AS n, min(pos) AS a, max(pos) AS z FROM ({_phrase_places()})
          GROUP BY doc_id, label),
        t(label, ws, least) AS (VALUES {_templates()}),
        p AS (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[\x20\x09\x0B-\x0D]*\n')) AS text FROM l),
        pw AS (SELECT doc_id, list_distinct({PLAIN_WORDS}) AS ws FROM p),
        m AS (SELECT doc_id, label, max(len(list_intersect(pw.ws, t.ws)) / len(t.ws)) AS share
          FROM pw, t WHERE len(list_intersect(pw.ws, t.ws)) >= least GROUP BY doc_id, label),
        every AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS labels FROM
          (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM m) GROUP BY doc_id),
        base AS (SELECT doc_id, sum(n)::BIGINT AS n_base, min(a) AS first_word, max(z) AS last_word,
          string_agg(label, ',' ORDER BY label) AS base_labels FROM b GROUP BY doc_id),
        s AS (SELECT doc_id, max(share) AS score FROM m GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
          coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0) AS score
        FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id) LEFT JOIN s USING (doc_id)""",
    "op4_near_duplicates": f"""
        WITH RECURSIVE l AS (SELECT doc_id, translate(text, '{CAPITALS}', '{SMALL}') AS text FROM documents),
        d AS (SELECT doc_id, {SPACED_WORDS} AS w FROM l),
        g AS (SELECT doc_id, w, least(3, len(w)) AS m, unnest(range(1, len(w) - least(3, len(w)) + 2)) AS j
          FROM d WHERE len(w) > 0),
        s AS (SELECT DISTINCT doc_id, array_to_string(w[j:j + m - 1], ' ') AS s FROM g),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id < y.doc_id
          GROUP BY 1, 2),
        e AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
          WHERE 100 * c >= 85 * (x.n + y.n - c)),
        f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
        r AS (SELECT doc_id, doc_id AS o FROM d UNION SELECT r.doc_id, f.b FROM r JOIN f ON r.o = f.a),
        k AS (SELECT doc_id, min(o) AS component_id FROM r GROUP BY doc_id)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM d JOIN k USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op5_source_mixing": f"""
        WITH d AS (SELECT doc_id, source, len({SPACED_WORDS}) AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
        w AS (SELECT *, [5.0::DOUBLE, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w,
          source_size * 2.0::DOUBLE AS most FROM s),
        f AS (SELECT *, sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE AS whole,
          coalesce(sum(most) OVER before, 0) AS filled,
          sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS free FROM w
          WINDOW before AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT max((whole - filled) / free) AS level FROM f WHERE (whole - filled) / free * w <= most),
        t AS (SELECT source, source_size, least(most, level * w) AS target FROM f, l),
        r AS (SELECT d.*, source_size, target, row_number() OVER
          (PARTITION BY d.source ORDER BY size, md5(doc_id::VARCHAR), doc_id) AS place,
          ('0x' || substr(md5('mix:' || coalesce(d.source, '')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, size, source_size, target, (size * (floor(place * e + u) - floor((place - 1) * e + u)))::BIGINT
          AS taken FROM (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e FROM r)""",
    "op6_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {SPACED_WORDS} AS w,
          list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS l
          FROM documents),
        v AS (SELECT doc_id, j, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] AS s
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS j FROM d)),
        c AS (SELECT doc_id, j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, s) AS n FROM v) WHERE n > 1),
        r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([j, j + 1, j + 2]) AS k FROM c)
          GROUP BY doc_id),
        f AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[ 	-
]+', '', 'g')) AS word_chars,
          length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) AS n_lines,
          len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
          length(regexp_replace(text, '\P{{L}}+', '', 'g')) AS n_letters,
          length(regexp_replace(text, '\P{{Lu}}+', '', 'g')) AS n_capitals FROM d LEFT JOIN r USING (doc_id))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
          NOT ({FAILED}) AS kept FROM f""",
    "op7_url_filter": rf"""
        WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
          ELSE '' END AS rest FROM pages),
        p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{CAPITALS}', '{SMALL}') AS host,
          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(h, q, verdict) AS (VALUES {_url_rules()}),
        k AS (SELECT page_id, h || q AS rule, verdict, row_number() OVER
          (PARTITION BY page_id ORDER BY length(h || q) DESC) AS n FROM p, r
          WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q))
        SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM p LEFT JOIN (SELECT * FROM k WHERE n = 1) USING (page_id)""",
    "op10_chat_format": """
        WITH m AS (SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text
          FROM conversations),
        b AS (SELECT *, coalesce(sum(length(role) + length(text) + 24) OVER (PARTITION BY conv_id
          ORDER BY turn NULLS LAST, role, text ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m),
        o AS (SELECT conv_id, min(before) AS opened FROM b WHERE role <> 'system' GROUP BY conv_id),
        k AS (SELECT conv_id, max(before // 1048576) AS parts FROM b GROUP BY conv_id),
        e AS (SELECT b.*, unnest(range(1, k.parts::BIGINT + 1)) AS part FROM b
          JOIN k ON b.conv_id IS NOT DISTINCT FROM k.conv_id JOIN o ON b.conv_id IS NOT DISTINCT FROM o.conv_id
          WHERE role = 'system' AND before < 65536 AND before < opened),
        p AS (SELECT conv_id, turn, role, text, 1 AS own_part, (before // 1048576)::BIGINT AS part FROM b UNION ALL
          SELECT e.conv_id, turn, role, text, 0, e.part FROM e JOIN
          (SELECT DISTINCT conv_id, (before // 1048576)::BIGINT AS part FROM b) h
          ON e.conv_id IS NOT DISTINCT FROM h.conv_id AND e.part = h.part),
        s AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
        q AS (SELECT p.conv_id, speaker, part, own_part, turn, role, text, role = speaker AS own,
          CASE WHEN role = speaker THEN '<|assistant|>' || chr(10) WHEN role = 'system' THEN '<|system|>' || chr(10)
            ELSE '<|user|>' || chr(10) || role || ': ' END AS lead, text || '<|end|>' AS learned
          FROM p JOIN s ON p.conv_id IS NOT DISTINCT FROM s.conv_id),
        r AS (SELECT *, sum(length(lead) + length(learned) + 1) OVER (PARTITION BY conv_id, speaker, part
          ORDER BY own_part, turn NULLS LAST, role, text) - length(learned) - 1 AS a FROM q)
        SELECT conv_id, speaker, part, count(*) AS n_messages,
          string_agg(lead || learned || chr(10), '' ORDER BY own_part, turn NULLS LAST, role, text) AS rendered,
          coalesce(string_agg(a::VARCHAR || '-' || (a + length(learned))::VARCHAR, ','
            ORDER BY own_part, turn NULLS LAST, role, text) FILTER (own), '') AS mask,
          coalesce(sum(length(learned)) FILTER (own), 0)::BIGINT AS n_learned
        FROM r GROUP BY conv_id, speaker, part""",
    "op8_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        w AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM
          (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 199)) AS i FROM d WHERE len(x) >= 400)),
        r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM w) WHERE n > 1),
        g AS (SELECT doc_id, i, coalesce(i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 200, true)::INTEGER AS f
          FROM r),
        s AS (SELECT doc_id, min(i) AS a, max(i) + 200 AS z FROM
          (SELECT *, sum(f) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
        p AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS y FROM s),
        k AS (SELECT doc_id, string_agg(substr(x, 2 * y + 1, 2 * (a - y)), '' ORDER BY a) AS pieces,
          max(z) AS z, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM p JOIN d USING (doc_id) GROUP BY doc_id)
        SELECT doc_id, len(x) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
          sha256(unhex(coalesce(pieces, '') || substr(x, 2 * coalesce(z, 0) + 1))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op9_decontamination": f"""
        WITH d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
        b AS (SELECT item_id::VARCHAR AS item, {PLAIN_WORDS} AS w FROM benchmark),
        p AS (SELECT item, w, least(13, len(w)) AS m, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS j
          FROM b WHERE len(w) > 0),
        wins AS (SELECT DISTINCT item, m, array_to_string(w[j:j + m - 1], ' ') AS s FROM p),
        ms AS (SELECT DISTINCT m FROM wins),
        dp AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS j FROM d, ms),
        h AS (SELECT doc_id, m, j, item FROM
          (SELECT doc_id, m, j, array_to_string(w[j:j + m - 1], ' ') AS s FROM dp) JOIN wins USING (m, s)),
        n AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM
          (SELECT doc_id, unnest(range(j, j + m)) AS k FROM h) GROUP BY doc_id),
        i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
          sha256(coalesce(items, '')) AS items_sha256,
          coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op11_centroid_clustering": _cluster_sql(),
    "op12_vector_codes": _code_sql(),
}

"""The operators bound to the supplied tables, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from farelens.llm import (
    chat, divergence, exact, infill, minhash, mixing, packing, quality, sentencepieces, substrings,
    toxicity, urls, warc,
)
from farelens.session import tune

# The installed vocabulary files; every executor has the same ones.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its name, with its SQL if there is one."""
    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return function
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_chat_format", sql="""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), sized AS (
        SELECT *, 15 + length(replace(replace(replace(replace(
                      role, '&', '&amp;'), '<', '&lt;'), '[', '&#91;'), chr(10), '&#10;'))
                  + length(replace(replace(replace(
                      text, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')) AS chars,
               row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC)
                   AS back
        FROM t
    ), summed AS (
        SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY back DESC) AS upto FROM sized
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY back DESC))
               AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT)
               AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY back DESC)
                           FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR back = 1) AS BIGINT) AS formatted_chars
    FROM summed GROUP BY conv_id
""")
def op7_chat_format(spark: SparkSession, d: str) -> DataFrame:
    """All conversations as prefix-target examples, read back from the formatted text."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)],
                                  "conv_id long, turn long, role string, text string")
    return chat.read_back(chat.prefix_targets(turns.unionByName(extra)))


# The rules that the url query judges by.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]

_HOST = r"translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), '%s', '%s')" % (
    urls.UPPER, urls.LOWER)
_PATH = r"regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
_REST = r"regexp_extract({0}, '(?s)^.*?://[^/?#]*([^#]*)', 1)"


@query("op1_url_filter", sql=rf"""
    WITH RECURSIVE rules(verdict, h, p) AS (
        VALUES {", ".join(str(r) for r in URL_RULES)}
    ), tags AS (
        SELECT url, unnest(list_filter(
            regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>'),
            lambda x: regexp_matches(x, '(?is)\brel\s*=\s*["'']?canonical\b'
                                   '|http-equiv\s*=\s*["'']?refresh\b'))) AS tag
        FROM pages WHERE contains(url, '://')
    ), raw AS (
        SELECT url, replace(regexp_extract(tag,
            '(?is)(?:\bhref\s*=|\burl\s*=)\s*["'']?\s*([^"''>\s]+)', 1), '&amp;', '&') AS t,
            regexp_extract(url, '(?s)^(.*?)://', 1) AS s, {_HOST.format("url")} AS h,
            regexp_extract({_PATH.format("url")}, '(?s)^(.*/)', 1) AS f
        FROM tags
    ), edges AS (
        SELECT url AS a, CASE WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN t
            WHEN starts_with(t, '//') THEN s || ':' || t
            WHEN starts_with(t, '/') THEN s || '://' || h || t
            ELSE s || '://' || h || CASE WHEN f = '' THEN '/' ELSE f END || t END AS b
        FROM raw WHERE t <> ''
    ), ends AS (
        SELECT {_HOST.format("a")} || {_REST.format("a")} AS a,
               {_HOST.format("b")} || {_REST.format("b")} AS b
        FROM edges WHERE {_HOST.format("a")} <> '' AND {_HOST.format("b")} <> ''
    ), near AS (
        SELECT a, b FROM ends UNION SELECT b, a FROM ends
    ), reach AS (
        SELECT a, a AS b FROM near
        UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a
    ), judged AS (
        SELECT DISTINCT ON (u.url) u.url, h || p AS rule, verdict
        FROM (SELECT url FROM pages UNION SELECT '://' || b FROM reach) u JOIN rules
          ON ({_HOST.format("u.url")} = h OR ends_with({_HOST.format("u.url")}, '.' || h))
         AND starts_with({_PATH.format("u.url")}, p)
        ORDER BY u.url, length(h || p) DESC, length(h) DESC, verdict
    ), passed AS (
        SELECT r.a, min(j.verdict) AS verdict
        FROM reach r JOIN judged j ON j.url = '://' || r.b GROUP BY r.a
    )
    SELECT page_id, coalesce({_HOST.format("p.url")}, '') AS host,
           coalesce({_PATH.format("p.url")}, '') AS path, j.rule,
           coalesce(j.verdict, c.verdict, 'allow') AS verdict,
           j.rule IS NULL AND c.verdict IS NOT NULL AS inherited
    FROM pages p LEFT JOIN judged j ON j.url = p.url
    LEFT JOIN passed c ON c.a = {_HOST.format("p.url")} || {_REST.format("p.url")}
""")
def op1_url_filter(spark: SparkSession, d: str) -> DataFrame:
    """All page urls, judged by rules and by the aliases their html links to."""
    pages = table(spark, d, "pages")
    return urls.judge(pages, urls.links(pages), URL_RULES)


_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_CLOSING = "".join(quality.CLOSING).replace("'", "''").replace(")", "\\)")


@query("op10_quality_rules", sql=rf"""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS ws
        FROM documents
    ), w AS (
        SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d
    ), triples AS (
        SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o AS t
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), twice AS (
        SELECT doc_id, i FROM triples WHERE t IS NOT NULL
        QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1
    ), repeated AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM twice, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id
    ), split AS (
        SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM d
    ), measured AS (
        SELECT *, {_WORDS.format("line")} AS lw,
               length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS symbols,
               row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS again
        FROM split
    ), windowed AS (
        SELECT *, CASE WHEN len(lw) > {quality.STRETCH} AND len(list_distinct(lw)) * 3 <= len(lw)
                       THEN list_transform(range(1, len(lw) - 11), lambda p:
                           array_to_string(lw[p:p + 12], ' ')) ELSE [] END AS w13
        FROM measured WHERE len(lw) > 0
    ), stretched AS (
        SELECT *,
            CASE WHEN len(w13) > 0 THEN list_filter(range(1, len(lw) - {quality.STRETCH} + 2),
                lambda p: len(list_distinct(lw[p:p + {quality.STRETCH} - 1])) * 3
                          <= {quality.STRETCH}) END AS poor,
            CASE WHEN len(w13) > 0 THEN list_filter(range(1, len(w13) + 1), lambda p:
                len(list_filter(w13, lambda x: x = w13[p])) > 1) END AS twice
        FROM windowed
    ), ruled AS (
        SELECT doc_id, len(lw) AS n, again,
            again OR (symbols >= 2 AND symbols * 3 >= len(lw))
            OR (len(list_filter(lw, lambda x: regexp_matches(x, '[!?][!?]$'))) >= 2
                AND len(list_filter(lw, lambda x: regexp_matches(x, '[!?][!?]$'))) * 2 >= len(lw))
            OR (len(lw) < 4 AND NOT regexp_matches(lw[len(lw)], '[{_CLOSING}]$'))
            OR (len(lw) >= 4 AND NOT regexp_matches(line, '[.,;:!?]'))
            OR CASE WHEN len(lw) < 10 OR len(list_distinct(lw)) * 3 > len(lw) THEN false
                    WHEN len(lw) <= {quality.STRETCH} THEN true
                    ELSE 2 * len(list_filter(range(1, len(lw) + 1), lambda j: len(list_filter(
                             poor, lambda p: p <= j AND j < p + {quality.STRETCH})) > 0))
                             >= len(lw)
                      OR 2 * len(list_filter(range(1, len(lw) + 1), lambda j: len(list_filter(
                             twice, lambda p: p <= j AND j < p + 13)) > 0)) > len(lw) END
            OR 5 * len(list_filter(string_split(array_to_string(regexp_extract_all(
                   translate(line, '{urls.UPPER}', '{urls.LOWER}'),
                   '{"|".join(quality.PHRASES)}'), ' '), ' '), lambda x: x <> ''))
               >= len(lw) AS fails
        FROM stretched
    ), lines AS (
        SELECT doc_id, count(*) FILTER (again) AS n_dup_lines,
               CAST(coalesce(sum(n) FILTER (fails), 0) AS BIGINT) AS n_lost_words
        FROM ruled GROUP BY doc_id
    ), joined AS (
        SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
               length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines,
               coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(n_lost_words, 0) AS n_lost_words
        FROM d LEFT JOIN repeated USING (doc_id) LEFT JOIN lines USING (doc_id)
    )
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
           NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
           AND 100 * n_lost_words <= 50 * n_words AS kept
    FROM joined
""")
def op10_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    """All documents, judged line first."""
    return quality.judge(table(spark, d, "documents")).drop("clean_text")


@query("op6_exact_dedup", sql=r"""
    WITH d AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
        FROM documents
    )
    SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
    FROM d WINDOW g AS (PARTITION BY t)
""")
def op6_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    """All documents, with the row of equal text that stays."""
    return exact.judge(table(spark, d, "documents"))


@query("op3_minhash_dedup", sql=rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{urls.UPPER}', '{urls.LOWER}')")} AS ws
        FROM documents
    ), w AS (
        SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word, len(ws) AS n FROM d
    ), windows AS (
        SELECT doc_id, n, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o
               || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS s
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), shingles AS (
        SELECT DISTINCT doc_id, s FROM windows WHERE s IS NOT NULL
        UNION ALL SELECT doc_id, array_to_string(ws, ' ') FROM d WHERE len(ws) BETWEEN 1 AND 4
    ), sizes AS (
        SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
    ), common AS (
        SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
        FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id
    ), near AS (
        SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id
        WHERE 100 * c >= 75 * (x.n + y.n - c)
    ), reach AS (
        SELECT a, a AS b FROM near UNION SELECT r.a, n.b FROM reach r JOIN near n ON r.b = n.a
    ), label AS (SELECT a, min(b) AS least FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n, 0) AS n_shingles,
           coalesce(least, d.doc_id) AS component_id,
           coalesce(least, d.doc_id) = d.doc_id AS kept
    FROM d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN label ON a = d.doc_id
""")
def op3_minhash_dedup(spark: SparkSession, d: str) -> DataFrame:
    """All documents, with the group of near copies that each belongs to."""
    return minhash.judge(table(spark, d, "documents"))


@query("op4_packing")
def op4_packing(spark: SparkSession, d: str) -> DataFrame:
    """All documents, packed into sequences of 4096 tokens."""
    return packing.pack(table(spark, d, "documents"), WORD_BPE)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, d: str) -> DataFrame:
    """All documents, scored by classifiers fitted on the rows that are not held out."""
    return toxicity.judge(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op8_substring_dedup", sql=rf"""
    WITH d AS (
        SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents
    ), w AS (
        SELECT doc_id, generate_subscripts(ws, 1) AS i, unnest(ws) AS word FROM d
    ), windows AS (
        SELECT doc_id, i, {" || ' ' || ".join(f"lead(word, {k}) OVER o" for k in range(13))} AS s
        FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY i)
    ), later AS (
        SELECT doc_id, i FROM windows WHERE s IS NOT NULL
        QUALIFY min(doc_id) OVER (PARTITION BY s) < doc_id
    ), gone AS (
        SELECT DISTINCT doc_id, i + k AS i FROM later, range(13) AS r(k)
    ), kept AS (
        SELECT w.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY w.i) AS t
        FROM w ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.i = w.i GROUP BY w.doc_id
    )
    SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
           sha256(coalesce(t, '')) AS kept_sha256
    FROM d LEFT JOIN kept ON kept.doc_id = d.doc_id
""")
def op8_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    """All documents, with the words that repeat a window of a smaller id taken out."""
    return substrings.judge(table(spark, d, "documents"))


@query("op5_warc_derivatives")
def op5_warc_derivatives(spark: SparkSession, d: str) -> DataFrame:
    """All pages as responses, with a metadata and a conversion record of each."""
    return warc.derive(warc.responses(table(spark, d, "pages")))


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    """All documents as piece ids."""
    return sentencepieces.encode(table(spark, d, "documents"),
                                 sentencepieces.read_model(PIECE_BPE))


@query("op13_fill_in_middle", sql="""
    WITH d AS (
        SELECT doc_id, coalesce(text, '') AS text, string_split(coalesce(text, ''), chr(10)) AS l,
               sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
    ), drawn AS (
        SELECT *, len(l) - CASE WHEN l[-1] = '' THEN 1 ELSE 0 END AS n,
               CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1,
               CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
               CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d
    ), cut AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>')
                         OR contains(text, '<M>') THEN 'plain'
                    WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn
    ), measured AS (
        SELECT *, CASE WHEN a = 0 THEN 0 WHEN a = n THEN length(text)
                       ELSE length(array_to_string(l[1:a], chr(10))) + 1 END AS p,
               CASE WHEN b = 0 THEN 0 WHEN b = n THEN length(text)
                    ELSE length(array_to_string(l[1:b], chr(10))) + 1 END AS q FROM cut
    ), parts AS (
        SELECT *, substr(text, 1, p) AS prefix, substr(text, p + 1, q - p) AS middle,
               substr(text, q + 1) AS suffix FROM measured
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN q - p END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text
                  WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END)
               AS output_sha256, sha256(text) AS restored_sha256
    FROM parts
""")
def op13_fill_in_middle(spark: SparkSession, d: str) -> DataFrame:
    """All documents as fill-in-the-middle examples, with what each is turned back into."""
    found = infill.fill_in_middle(table(spark, d, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_STEP = "[" + ", ".join(map(str, mixing.STEPS)) + "]"


@query("op11_mix_sources", sql=rf"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")}) AS size,
               CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)
                    AS BIGINT) AS key FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
    ), w AS (
        SELECT *, [5, 2, 1][place % 3 + 1] AS weight, 3 * source_size AS cap FROM s
    ), fill AS (
        SELECT 0 AS round, place, cap, weight, false AS at_cap,
               (SELECT sum(source_size) FROM s)::BIGINT * weight
                   / (SELECT sum(weight) FROM w)::BIGINT AS target FROM w
        UNION ALL
        SELECT round + 1, place, cap, weight, now_at_cap,
               CASE WHEN now_at_cap THEN CAST(cap AS DOUBLE)
                    ELSE (t - filled)::BIGINT * weight / weighed::BIGINT END
        FROM (SELECT *,
                bool_or(now_at_cap AND NOT at_cap) OVER () AS any_moved,
                coalesce(sum(cap) FILTER (now_at_cap) OVER (), 0) AS filled,
                sum(weight) FILTER (NOT now_at_cap) OVER () AS weighed
              FROM (SELECT *, at_cap OR target >= cap AS now_at_cap,
                           (SELECT sum(source_size) FROM s)::BIGINT AS t FROM fill)) x
        WHERE any_moved
    ), goal AS (
        SELECT w.*, f.target, (SELECT (sum(source_size)::BIGINT + 16) // 32 FROM s) AS blocks,
               greatest(1, (source_size + 4194303) // 4194304) AS shards
        FROM w JOIN (SELECT place, max_by(target, round) AS target FROM fill GROUP BY place) f
          USING (place)
    ), seats AS (
        SELECT place FROM (SELECT place, blocks, target / (2 * k + 1) AS q FROM goal,
                           LATERAL (SELECT unnest(range(CAST(target // 32 AS BIGINT) + 64)) AS k)
                           WHERE target > 0)
        QUALIFY row_number() OVER (ORDER BY q DESC, place) <= blocks
    ), won AS (
        SELECT goal.*, count(seats.place) AS quota FROM goal LEFT JOIN seats USING (place)
        GROUP BY ALL
    ), c AS (
        SELECT place, key % shards AS shard, quota, CAST(sum(size) AS BIGINT) AS words
        FROM d JOIN won ON d.source IS NOT DISTINCT FROM won.source GROUP BY ALL
    ), dealt AS (
        SELECT place, shard FROM (SELECT place, shard, quota, words / (2 * k + 1) AS q FROM c,
                                  LATERAL (SELECT unnest(range(quota + 1)) AS k) WHERE words > 0)
        QUALIFY row_number() OVER (PARTITION BY place ORDER BY q DESC, shard) <= quota
    ), got AS (
        SELECT c.place, c.shard, c.words, 32 * count(dealt.place) AS given,
               md5('11:' || c.place || ':' || c.shard) AS h
        FROM c LEFT JOIN dealt ON dealt.place = c.place AND dealt.shard = c.shard GROUP BY ALL
    ), cells AS (
        SELECT *, CASE WHEN words = 0 THEN 0 ELSE least(3, given // words) END AS copies,
               (words + 31) // 32 AS n,
               {_STEP}[CAST('0x' || substr(h, 1, 4) AS BIGINT) % {len(mixing.STEPS)} + 1] AS step,
               CAST('0x' || substr(h, 5, 8) AS BIGINT) AS shift FROM got
    ), extra AS (
        SELECT *, CASE WHEN copies < 3 THEN (given - copies * words + 16) // 32 ELSE 0 END AS extra
        FROM cells
    ), runs AS (
        SELECT d.*, won.place, key % shards AS shard, source_size, target,
               CAST(sum(size) OVER (PARTITION BY won.place, key % shards
                    ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) AS BIGINT)
                   - size AS begin
        FROM d JOIN won ON d.source IS NOT DISTINCT FROM won.source
    )
    SELECT doc_id, size, source_size, target, CAST(copies * size + coalesce(list_sum([
               least((i + 1) * 32, begin + size) - greatest(i * 32, begin)
               FOR i IN range(begin // 32, (begin + size + 31) // 32)
               IF size > 0 AND (i * step + shift) % n < extra]), 0) AS BIGINT) AS taken
    FROM runs JOIN extra USING (place, shard)
""")
def op11_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    """All documents, with the words that the mix of their sources takes."""
    found = mixing.mix(table(spark, d, "documents"))
    return found.select("doc_id", "size", "source_size", "target",
                        mixing.words_taken().alias("taken"))


@query("op12_source_divergence", sql=rf"""
    WITH d AS (
        SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
               coalesce(source, '') AS source, translate(coalesce(text, ''), '{urls.UPPER}',
                                                         '{urls.LOWER}') AS text FROM documents
    ), w AS (
        SELECT r, lang, source, unnest(regexp_extract_all(
            text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
    ), kept AS (
        SELECT lang, term, count(*) AS total FROM w GROUP BY ALL HAVING count(DISTINCT r) >= 3
    ), grps AS (
        SELECT DISTINCT lang, source FROM d
    ), counts AS (
        SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL
    ), full_counts AS (
        SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c, k.total
        FROM grps g JOIN kept k USING (lang)
        LEFT JOIN counts n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term
    ), shares AS (
        SELECT lang, source, term, c,
               1 + CAST(1000000000 * CAST(c + 1 AS HUGEINT)
                   // (sum(c) OVER g + count(*) OVER g) AS BIGINT) AS p,
               1 + CAST(1000000000 * CAST(total + 1 AS HUGEINT)
                   // (sum(total) OVER g + count(*) OVER g) AS BIGINT) AS q
        FROM full_counts WINDOW g AS (PARTITION BY lang, source)
    ), summed AS (
        SELECT a.lang, a.source, b.source AS item,
               CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
        FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ), terms AS (
        SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // q AS value
        FROM shares WHERE c > 0 AND p > q
    ), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part
                       ORDER BY value DESC, item) AS INTEGER) AS rank
        FROM (FROM pairs UNION ALL FROM terms)
    )
    SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
""")
def op12_source_divergence(spark: SparkSession, d: str) -> DataFrame:
    """All documents: how each source differs from the others of its language, and by what."""
    return divergence.audit(table(spark, d, "documents"))

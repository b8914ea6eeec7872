"""The registered queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyquill.llm import chat, decontaminate, html, jaccard, language, lm, mixing, neighbours, phrases, quality, ranked, toxicity, transducer
from tallyquill.llm.common import table


def op1_html_lstm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_texts(table(spark, sf_dir, "pages"))


def op2_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embedding_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_mix_pareto(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


def op7_language_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(table(spark, sf_dir, "documents"))


def op8_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model(table(spark, sf_dir, "documents"))


def op9_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_token_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrase_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_html_lstm, op2_quality_compression, op3_embedding_graph, op4_mix_pareto, op5_toxicity_ftrl, op6_chat_rotation, op7_language_ranks,
        op8_hidden_markov, op9_jaccard_rtree, op10_decontaminate, op11_token_transducer, op12_ranked_search, op13_phrase_pairs,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The learning operators (1, 2, 5, 7, 8) and the groups of 3 and 9 have no SQL; they are tested against brute force and
#: held-out rows instead.
ORACLE_SQL: dict[str, str] = {
    "op4_mix_pareto": r"""
        WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
        s AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n FROM d GROUP BY source),
        w AS (SELECT *, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS most FROM s),
        o AS (SELECT *, row_number() OVER (ORDER BY most / weight, source NULLS LAST) AS rank,
                ((SELECT sum(source_size) FROM s)::DOUBLE - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
        c AS (SELECT min_by(level, rank) AS common FROM o WHERE level * weight <= most),
        t AS (SELECT o.source, source_size, CASE WHEN common IS NULL THEN most ELSE least(most, common * weight) END AS target FROM o, c),
        e AS (SELECT d.doc_id, d.source, size, source_size, target, CASE WHEN source_size > 0 THEN least(3.0, target / source_size) ELSE 0.0 END AS due,
                ((('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0::DOUBLE AS u
              FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        k AS (SELECT *, floor(due) AS certain, (u / (1 - u)) / (least(greatest(due - floor(due), 1e-9::DOUBLE), 1 - 1e-9::DOUBLE) / (1 - least(greatest(due - floor(due), 1e-9::DOUBLE), 1 - 1e-9::DOUBLE))) AS key FROM e),
        r AS (SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS open, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto FROM k),
        f AS (SELECT *, open - max(CASE WHEN upto <= open THEN upto ELSE 0 END) OVER (PARTITION BY source) AS gap FROM r),
        x AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY CASE WHEN upto > open AND abs(gap - size) < gap THEN abs(gap - size) END NULLS LAST, key, doc_id, size) = 1
                AND upto > open AND abs(gap - size) < gap AS one_more FROM f)
        SELECT doc_id, size, source_size, target, ((certain + (upto <= open OR one_more)::INT) * size)::BIGINT AS taken FROM x""",
    "op6_chat_rotation": """
        WITH t AS (SELECT conv_id, turn, coalesce(role, 'unknown') AS role, replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
        s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
        e AS (SELECT t.*, speaker, CASE WHEN role = 'system' THEN '<|system|>' WHEN role = speaker THEN '<|assistant|>' ELSE '<|user name=' || replace(role, '<|', '< |') || '|>' END AS head
              FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
        g AS (SELECT *, head || text || '<|end|>' || chr(10) AS segment FROM e),
        o AS (SELECT *, sum(length(segment)) OVER w AS upto, row_number() OVER w - 1 AS position FROM g
              WINDOW w AS (PARTITION BY conv_id, speaker ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING))
        SELECT conv_id, speaker, position::BIGINT AS position, turn, role, segment, (upto - length(segment))::BIGINT AS start, upto::BIGINT AS "end", role = speaker AS train,
               CASE WHEN role = speaker THEN (upto - length(segment) + length(head))::BIGINT END AS mask_start, CASE WHEN role = speaker THEN upto::BIGINT END AS mask_end FROM o""",
    "op10_decontaminate": rf"""
        WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
        b AS (SELECT item_id::VARCHAR AS item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
        i AS (SELECT item_id, w, least(len(w), 13) AS n FROM b WHERE len(w) > 0),
        g AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM i)),
        x AS (SELECT id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
        h AS (SELECT id, x.n, p, item_id FROM x JOIN g ON x.n = g.n AND x.gram = g.gram),
        c AS (SELECT id, count(DISTINCT q) AS n_hit FROM (SELECT id, unnest(range(p, p + n)) AS q FROM h) GROUP BY id),
        m AS (SELECT id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT id, item_id FROM h) GROUP BY id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN c USING (id) LEFT JOIN m USING (id)""",
    "op12_ranked_search": rf"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
        s AS (SELECT (count(*) FILTER (len(w) > 0))::BIGINT AS docs, sum(len(w))::BIGINT AS total FROM d),
        t AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM d) GROUP BY r, doc_id, n, term),
        i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE item_id IS NOT NULL),
        f AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM t, s WHERE term IN (SELECT term FROM i) GROUP BY term, docs),
        x AS (SELECT item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
              FROM i JOIN f USING (term) JOIN t USING (term), s GROUP BY item_id, r, doc_id)
        SELECT item_id, rank::INT AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM x WHERE score > 0) WHERE rank <= 10""",
    "op13_phrase_pairs": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents WHERE text IS NOT NULL),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
        t AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
        g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
        f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS a FROM g GROUP BY lang, k, phrase HAVING count(*) >= 100),
        c AS (SELECT f.*, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
        h AS (SELECT *, array_to_string(w[1:j], ' ') AS head, array_to_string(w[j + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
        s AS (SELECT h.lang, h.k, h.phrase, h.a, l.a AS l, r.a AS r, n, (1000 * h.a * n) // (l.a * r.a) AS score,
                row_number() OVER (PARTITION BY h.lang, h.phrase ORDER BY (1000 * h.a * n) // (l.a * r.a), j) AS place
              FROM h JOIN f l ON l.lang = h.lang AND l.phrase = head JOIN f r ON r.lang = h.lang AND r.phrase = tail JOIN t ON t.lang = h.lang),
        o AS (SELECT lang, part, max(a) AS longer FROM (SELECT lang, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:], ' ')]) AS part, a FROM c) GROUP BY lang, part),
        q AS (SELECT s.* FROM s LEFT JOIN o ON o.lang = s.lang AND part = phrase WHERE place = 1 AND (longer IS NULL OR 100 * longer < 100 * a))
        SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
        FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM q) WHERE rank <= 2000""",
}

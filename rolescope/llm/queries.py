"""One query for each operator, over its whole table, and the SQL that some must agree with."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rolescope.llm import toxicity
from rolescope.llm.base import documents
from rolescope.llm.exact_dedup import exact_groups
from rolescope.llm.filter_audit import filter_audit
from rolescope.llm.line_templates import line_templates
from rolescope.llm.lm_scoring import lm_scores
from rolescope.llm.mixing import mixed_documents
from rolescope.llm.ngram_join import ngram_links
from rolescope.llm.packing import pack
from rolescope.llm.secrets import BASE, EXTRA, scan_ledger, span_text
from rolescope.llm.spelling import spelling_forms
from rolescope.llm.substring_dedup import repeated_spans
from rolescope.llm.token_files import token_index
from rolescope.llm.vector_links import vector_links

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


@query
def op2_best_fit_packing(spark, d):
    return pack(documents(spark, d), TOKENIZER)


@query
def op4_exact_dedup(spark, d):
    return exact_groups(documents(spark, d), keep="largest")


# A-Z only, written out because SQL's lower() folds every alphabet.
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op4_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, {_FOLDED} AS body FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       coalesce(doc_id = max(doc_id) OVER w, false) AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)"""


@query
def op9_source_mixing(spark, d):
    """What the mixed sequence holds of each document, counted in the sequence itself."""
    return mixed_documents(documents(spark, d)).select(
        "doc_id", "size", "source_size", "target", "taken", "copies",
        F.round("first_position", 9).alias("first_position"))


ORACLE["op9_source_mixing"] = r"""
WITH t AS (SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
           FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
ranked AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
           FROM per),
levels AS (SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER b, 0))::DOUBLE
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0))::DOUBLE AS level
           FROM ranked
           WINDOW b AS (ORDER BY 3 * source_size / weight, source NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, weight, source_size,
                   least(max(level) OVER () * weight, (3 * source_size)::DOUBLE) AS target
            FROM levels),
running AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY h, doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM t),
joined AS (SELECT r.*, g.weight, g.source_size, g.target,
                  CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size)::BIGINT ELSE 0 END
                  AS whole
           FROM running r JOIN targets g ON r.source IS NOT DISTINCT FROM g.source),
taken AS (SELECT *, whole + CASE WHEN whole < 3 AND start + size / 2.0 <= target - whole * source_size
                            THEN 1 ELSE 0 END AS copies,
                 CASE WHEN target > 0 THEN start / target ELSE 0.0 END AS u,
                 (4 - weight) / 2.0 AS r0, weight / 2.0 AS r1 FROM joined)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies,
       round(CASE WHEN copies = 0 THEN NULL WHEN r1 = r0 THEN u / r0
                  ELSE (sqrt(r0 * r0 + 2 * (r1 - r0) * u) - r0) / (r1 - r0) END, 9)
       AS first_position
FROM taken"""


@query
def op10_secret_scan(spark, d):
    kinds = tuple(r.kind for r in (*BASE, *EXTRA))
    spans = F.concat(F.col("findings")["base-1"], F.col("findings")["extra-1"])

    def of(*names: str):
        return F.filter("spans", lambda s: s["kind"].isin(*names))

    return scan_ledger(documents(spark, d)).select("doc_id", spans.alias("spans")).select(
        "doc_id",
        *[F.size(of(r.kind)).cast("bigint").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(span_text(of(*[r.kind for r in BASE]), kinds), 256).alias("base_sha256"),
        span_text(F.col("spans"), kinds).alias("spans"))


@query
def op1_ngram_jaccard_join(spark, d):
    return ngram_links(documents(spark, d))


@query
def op3_substring_dedup(spark, d):
    return repeated_spans(documents(spark, d)).drop("factors")


@query
def op5_embedding_near_dedup(spark, d):
    return vector_links(documents(spark, d, "embeddings"))


@query
def op6_line_template_dedup(spark, d):
    return line_templates(documents(spark, d))


ORACLE["op6_line_template_dedup"] = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, md5(coalesce(text, '')) AS key
           FROM documents),
texts AS (SELECT DISTINCT key, string_split(text, chr(10)) AS lines FROM t),
numbered AS (SELECT key, unnest(range(len(lines))) AS line_no, unnest(lines) AS line FROM texts),
tokens AS (SELECT key, line_no, [CASE WHEN regexp_matches(w, '[0-9]') THEN '<*>' ELSE w END
               FOR w IN string_split_regex(line, '[ \t\r\f\x0B]+') IF w <> ''] AS tokens
           FROM numbered),
leaves AS (SELECT *, concat_ws(' ', len(tokens), array_to_string(tokens[1:3], ' ')) AS leaf,
                  array_to_string(tokens, ' ') AS seq
           FROM tokens WHERE len(tokens) > 0),
kinds AS (SELECT leaf, seq, any_value(tokens[4:]) AS tail, count(DISTINCT key) AS texts
          FROM leaves GROUP BY leaf, seq),
tails AS (SELECT leaf, seq, tail, CASE WHEN count(*) OVER (PARTITION BY leaf, tail[1]) >= 5
                 THEN tail[1] ELSE '' END AS branch FROM kinds WHERE len(tail) > 0),
placed AS (SELECT leaf, branch, seq, len(tail) AS n, unnest(range(len(tail))) AS pos,
                  unnest(tail) AS token FROM tails),
counts AS (SELECT leaf, branch, pos, token, count(*) AS c FROM placed GROUP BY ALL),
top AS (SELECT leaf, branch, pos, token, c, sum(c) OVER (PARTITION BY leaf, branch, pos) AS lines,
               row_number() OVER (PARTITION BY leaf, branch, pos ORDER BY c DESC, token DESC) AS r
        FROM counts),
fixed AS (SELECT leaf, branch, pos, token FROM top WHERE r = 1 AND c > 1 AND c >= 0.5 * lines),
follow AS (SELECT p.leaf, p.branch, p.seq FROM placed p LEFT JOIN fixed f
           ON p.leaf = f.leaf AND p.branch = f.branch AND p.pos = f.pos AND p.token = f.token
           GROUP BY p.leaf, p.branch, p.seq, p.n
           HAVING count(f.pos) >= 0.6::DOUBLE * p.n),
recurring AS (SELECT f.leaf, f.branch FROM follow f JOIN leaves l USING (seq)
              GROUP BY f.leaf, f.branch HAVING count(DISTINCT l.key) >= 5),
goes AS (SELECT seq FROM kinds WHERE texts >= 5
         UNION SELECT seq FROM follow JOIN recurring USING (leaf, branch)),
gone AS (SELECT key, list(line_no) AS gone FROM leaves WHERE seq IN (SELECT seq FROM goes)
         GROUP BY key),
joined AS (SELECT t.doc_id, string_split(t.text, chr(10)) AS lines, coalesce(g.gone, []) AS gone
           FROM t LEFT JOIN gone g USING (key))
SELECT doc_id, len(lines) AS n_lines, len(gone) AS n_dropped,
       array_to_string([l FOR l, i IN lines IF NOT list_contains(gone, i - 1)], chr(10)) AS text
FROM joined"""


@query
def op7_lm_scoring(spark, d):
    return lm_scores(documents(spark, d))


@query
def op8_toxicity(spark, d):
    docs = documents(spark, d)
    model = toxicity.train(docs, documents(spark, d, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
                   % 3 == 1).alias("held_out"), "score", "predicted", "offending")


@query
def op11_token_files(spark, d):
    return token_index(documents(spark, d), BYTE_TOKENIZER)


@query
def op12_filter_audit(spark, d):
    return filter_audit(documents(spark, d), documents(spark, d, "labels"))


ORACLE["op12_filter_audit"] = r"""
WITH marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                      max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
               FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
w AS (SELECT *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') AS words,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS e FROM t),
f AS (SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
             100 * len(regexp_extract_all(body, '[A-Z]')) > 3 * length(body),
             regexp_matches(body, '[#$%&*|]'), e] AS fails FROM w),
cells AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good,
                 sum(coalesce(toxic, 0)) AS toxic
          FROM f LEFT JOIN marks USING (doc_id) GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS seq
           FROM letters a JOIN letters b ON b.l <> a.l JOIN letters c ON c.l NOT IN (a.l, b.l)
           JOIN letters d ON d.l NOT IN (a.l, b.l, c.l)
           JOIN letters e ON e.l NOT IN (a.l, b.l, c.l, d.l)),
steps AS (SELECT filter_order, step::INT AS step, seq[step] AS f, seq[1:step - 1] AS before
          FROM orders, unnest([1, 2, 3, 4, 5]) AS s(step)),
met AS (SELECT c.part, s.filter_order, s.step, s.f, c.n, c.good, c.toxic, c.fails[s.f] AS failed,
               len([x FOR x IN s.before IF c.fails[x]]) > 0 AS gone,
               len([x FOR x IN c.fails IF x]) = 1 AS alone
        FROM cells c, steps s),
rows AS (SELECT part, filter_order, step, f,
                coalesce(sum(n) FILTER (NOT gone AND NOT failed), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (NOT gone AND failed), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (gone AND failed), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (failed AND alone), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (NOT gone AND failed), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (NOT gone AND failed), 0)::BIGINT AS toxic_lost
         FROM met GROUP BY part, filter_order, step, f)
SELECT * EXCLUDE (f), sum(removed) OVER (PARTITION BY part, f)::BIGINT AS shapley FROM rows"""


@query
def op13_spelling_variants(spark, d):
    return spelling_forms(documents(spark, d))

"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import (collocations, decontaminate, extract, langid, licences, line_dedup, near_dedup, packing,
                          periodic_runs, quartile_digest, slots, toxicity, warc)
from tidemark.llm.common import crc_bucket

QUERIES, SQL = {}, {}


def _table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn
    return add


@query("op1_warc_index")
def warc_index(spark, sf):
    return warc.archive_and_read(spark, _table(spark, sf, "pages"))


@query("op2_language_id")
def language_id(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang", (crc_bucket("doc_id", 4) == 2).alias("held_out"))
    model = langid.train(docs.where("NOT held_out"))
    return langid.predict(docs, model, keep=("doc_id", "held_out"))


@query("op8_toxicity")
def toxic(spark, sf):
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang", (crc_bucket("doc_id", 5) == 0).alias("held_out"))
    model = toxicity.train(docs.where("NOT held_out"), _table(spark, sf, "labels").where(crc_bucket("doc_id", 5) != 0))
    return toxicity.predict(docs, model, keep=("doc_id", "held_out"))


@query("op3_decontamination")
def decontamination(spark, sf):
    return decontaminate.contamination(_table(spark, sf, "documents"),
                                       decontaminate.Benchmark(_table(spark, sf, "benchmark")))


@query("op5_quartile_digest")
def fingerprints(spark, sf):
    return quartile_digest.compare_with_next(_table(spark, sf, "documents"))


def _licence_sql() -> str:
    """Lines are cut first here and words looked up one by one; the constants are the fixed tables."""
    def quoted(x):
        return "'" + x.replace("'", "''") + "'"

    words = " ".join(f"WHEN {quoted(v)} THEN {quoted(k)}" for v, k in licences.SPELLINGS)
    known = ", ".join(f"({quoted(i)}, {quoted(t)})" for i, t in licences.KNOWN)
    clean = r"""list_transform(string_split(lower(text), chr(10)), lambda l:
        CASE WHEN regexp_matches(l, '^[ \t\r\f]*(copyright|\(c\)|©|all rights reserved)') THEN ''
             ELSE array_to_string(list_transform(list_filter(string_split(regexp_replace(l, '[^\p{L}\p{N}]+', ' ', 'g'), ' '),
                  lambda w: w <> ''), lambda w: CASE w WORDS ELSE w END), ' ') END)""".replace("WORDS", words)
    joined = "array_to_string(list_filter(lines, lambda l: l <> ''), ' ')"
    return f"""WITH known AS (
      SELECT min(licence) AS licence, md5({joined}) AS digest
      FROM (SELECT licence, {clean} AS lines FROM (VALUES {known}) k(licence, text)) GROUP BY 2),
    docs AS (SELECT row_number() OVER () AS r, doc_id, {clean} AS lines FROM documents),
    notices AS (SELECT r, count(*) AS n, string_agg(DISTINCT licence, ',' ORDER BY licence) AS line_licences
      FROM (SELECT r, unnest(lines) AS line FROM docs) JOIN known ON md5(line) = digest WHERE line <> '' GROUP BY r)
    SELECT doc_id, CASE WHEN lines IS NOT NULL THEN md5({joined}) END AS canonical_md5, licence AS text_licence,
      coalesce(n, 0) AS n_notices, line_licences
    FROM docs LEFT JOIN notices USING (r)
    LEFT JOIN known ON digest = CASE WHEN lines IS NOT NULL THEN md5({joined}) END"""


@query("op6_licence_digests", _licence_sql())
def licence_digests(spark, sf):
    return licences.scan(_table(spark, sf, "documents"))


@query("op9_main_text")
def main_text(spark, sf):
    return extract.extract(_table(spark, sf, "pages"))


@query("op7_vector_packing")
def vector_packing(spark, sf):
    return packing.pack_documents(_table(spark, sf, "documents"))


@query("op4_virtual_slots")
def virtual_slots(spark, sf):
    return slots.shard(_table(spark, sf, "documents"), 8)


@query("op10_near_dedup")
def near_dedup_tensored(spark, sf):
    return near_dedup.near_duplicates(_table(spark, sf, "documents"))


#: All grams of each length counted by themselves.
PHRASE_SQL = r"""WITH pieces AS (SELECT lang, list_filter(string_split_regex(p, '[ \t]+'), lambda w: w <> '') AS w
      FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
    grams AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
      FROM pieces, range(1, 6) t(k) WHERE len(w) >= k),
    f AS (SELECT lang, k, g, count(*) AS f FROM grams GROUP BY ALL),
    totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    candidates AS (SELECT * FROM f WHERE k >= 2 AND f >= 100),
    inside AS (SELECT lang, g, max(f) AS most FROM (SELECT lang, g[1:k - 1] AS g, f FROM candidates WHERE k > 2
      UNION ALL SELECT lang, g[2:k] AS g, f FROM candidates WHERE k > 2) GROUP BY ALL),
    own AS (SELECT c.* FROM candidates c LEFT JOIN inside i USING (lang, g) WHERE most IS NULL OR 100 * most < 100 * c.f),
    cuts AS (SELECT o.lang, array_to_string(o.g, ' ') AS phrase, cut, o.f AS a, l.f AS l, r.f AS r, n,
        (1000 * o.f::HUGEINT * n // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM own o JOIN totals USING (lang), range(1, 5) t(cut), f l, f r
      WHERE cut < o.k AND l.lang = o.lang AND l.g = o.g[1:cut] AND r.lang = o.lang AND r.g = o.g[cut + 1:o.k]),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM best QUALIFY rank <= 2000"""


@query("op11_phrase_collocations", PHRASE_SQL)
def phrases(spark, sf):
    return collocations.collocations(_table(spark, sf, "documents"))


#: Lines one by one; ids are unique in the given tables.
LINE_SQL = r"""WITH lines AS (SELECT doc_id, i, line, translate(trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM (SELECT doc_id, unnest(x) AS line, unnest(range(len(x))) AS i
            FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents))),
    repeated AS (SELECT k, max(doc_id) AS last FROM lines WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT l.*, coalesce(doc_id <> last, false) AS dropped FROM lines l LEFT JOIN repeated USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id"""


@query("op12_line_dedup", LINE_SQL)
def line_dedup_cuckoo(spark, sf):
    return line_dedup.dedup_lines(_table(spark, sf, "documents"))


@query("op13_periodic_runs")
def runs_of_words(spark, sf):
    return periodic_runs.collapse_runs(_table(spark, sf, "documents"), rewrite=periodic_runs.planted_run)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, sf):
    return corpus_pipeline.run(spark, sf)

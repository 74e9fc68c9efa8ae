"""Registered queries over the driver's tables, each with DuckDB SQL for the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions.splitter import SPLIT_ABOVE, split_sentences, split_text
from lodestone.operators import plaintext as P
from lodestone.operators import search as R
from lodestone.operators import sections as S
from lodestone.operators.documents import blocks_of, chunk_files, chunk_texts, run_summary
from lodestone.operators.embed import HashingProvider
from lodestone.operators.index import Collection, batch_numbers, embedded, latest, missing_embeddings, points, words
from lodestone.operators.sparse import SparseIndex, counted
from lodestone.operators.vectors import VectorIndex
from lodestone.scratch import scratch
from lodestone.sources.parsers.common import text_table as aligned_table
from lodestone.sources.parsers.office import has_header, regions

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
NL = "\n"
_WS = r"\t-\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name; in its SQL, @WS is the white space
    class, @trim(x) trims it, and @structured is the structured view of documents."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = expand(sql)
        return f

    return register


def _call(sql: str, name: str, body: Callable[[str], str]) -> str:
    """Replaces each @name(argument) by its body, innermost parentheses counted."""
    mark = f"@{name}("
    while (a := sql.rfind(mark)) >= 0:
        depth, z = 1, a + len(mark)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[z], 0)
            z += 1
        sql = sql[:a] + body(sql[a + len(mark) : z - 1]) + sql[z:]
    return sql


def expand(sql: str) -> str:
    sql = sql.replace("@structured", STRUCTURED_SQL).replace("@path", "'/corpus/' || source || '/' || doc_id || '.' || " + EXT_SQL)
    sql = _call(sql, "summary", lambda x: SUMMARY_SQL.replace("@x", x))
    sql = _call(sql, "clean", lambda x: rf"@trim(regexp_replace(regexp_replace(regexp_replace({x}, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'))")
    sql = _call(sql, "tokens", lambda x: f"CAST(ceil(length({x}) / 4.0) AS INTEGER)")
    sql = _call(sql, "trim", lambda x: rf"regexp_replace({x}, '^[@WS]+|[@WS]+\z', '', 'g')")
    return sql.replace("@WS", _WS)


EXTENSIONS = ("txt", "md", "markdown", "html", "htm", "pdf", "docx", "XLSX", "ppt", "exe")
EXT_SQL = "[" + ", ".join(f"'{e}'" for e in EXTENSIONS) + "][doc_id % 10 + 1]"
STRUCTURED_SQL = "(SELECT doc_id, lang, source, concat('CHAPTER ', doc_id % 7, chr(10), '=========', chr(10), chr(10), '1.', doc_id % 5, '. Part', chr(10), chr(10), replace(text, chr(10), chr(10) || chr(10))) AS text FROM documents)"
SUMMARY_SQL = """(CASE WHEN regexp_extract(@trim(@x), '(?s)^(.*?[.!?])(?:[@WS]|\\z)', 1) <> '' AND length(regexp_extract(@trim(@x), '(?s)^(.*?[.!?])(?:[@WS]|\\z)', 1)) <= 200
  THEN regexp_extract(@trim(@x), '(?s)^(.*?[.!?])(?:[@WS]|\\z)', 1) WHEN length(@trim(@x)) <= 200 THEN @trim(@x)
  WHEN 200 - instr(reverse(substr(@trim(@x), 1, 200)), ' ') > 150 AND instr(reverse(substr(@trim(@x), 1, 200)), ' ') > 0 THEN substr(@trim(@x), 1, 200 - instr(reverse(substr(@trim(@x), 1, 200)), ' ')) || '...'
  ELSE substr(@trim(@x), 1, 200) || '...' END)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    ext = F.element_at(F.array(*map(F.lit, EXTENSIONS)), (F.col("doc_id") % 10 + 1).cast("int"))
    return table(spark, sf_dir, "documents").withColumn("path", F.concat(F.lit("/corpus/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit("."), ext))


def structure() -> Column:
    """A text as a plain-text file with a chapter, a numbered part and blank lines."""
    return F.concat(F.lit("CHAPTER "), (F.col("doc_id") % 7).cast("string"), F.lit("\n=========\n\n1."), (F.col("doc_id") % 5).cast("string"), F.lit(". Part\n\n"), F.replace("text", F.lit(NL), F.lit(NL + NL)))


def structured(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents with structure."""
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", structure().alias("text"))


# Identifiers and scalars -----------------------------------------------------------------


@query("SELECT doc_id, @path AS path, substr(sha256(@path), 1, 16) AS id FROM documents")
def doc_ids(spark, d):
    return paths(spark, d).select("doc_id", "path", T.doc_id("path").alias("id"))


@query("SELECT doc_id, l_linenumber AS n, substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16) || '::' || l_linenumber AS chunk_id FROM documents JOIN (SELECT DISTINCT l_linenumber FROM lineitem) ON true")
def chunk_ids(spark, d):
    n = table(spark, d, "lineitem").select("l_linenumber").distinct()  # seven numbers
    docs = table(spark, d, "documents").select("doc_id", T.doc_id(F.col("doc_id").cast("string")).alias("id"))
    return docs.join(F.broadcast(n)).select("doc_id", F.col("l_linenumber").alias("n"), T.chunk_id("id", "l_linenumber").alias("chunk_id"))


@query("SELECT doc_id, concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS uuid FROM (SELECT doc_id, sha256(doc_id || '::0') AS h FROM documents)")
def point_uuids(spark, d):
    return table(spark, d, "documents").select("doc_id", T.point_uuid(F.concat(F.col("doc_id").cast("string"), F.lit("::0"))).alias("uuid"))


@query("""SELECT doc_id, CASE lower(regexp_extract(@path, '\\.([^./]*)$', 1)) WHEN 'txt' THEN 'txt' WHEN 'md' THEN 'md' WHEN 'markdown' THEN 'md' WHEN 'html' THEN 'html' WHEN 'htm' THEN 'html'
  WHEN 'pdf' THEN 'pdf' WHEN 'docx' THEN 'docx' WHEN 'xlsx' THEN 'xlsx' WHEN 'xls' THEN 'xlsx' WHEN 'ppt' THEN 'ppt' WHEN 'pptx' THEN 'pptx' WHEN 'eml' THEN 'eml' WHEN 'msg' THEN 'msg' END AS doc_type FROM documents""")
def doc_type_map(spark, d):
    return paths(spark, d).select("doc_id", T.doc_type("path").alias("doc_type"))


@query("SELECT doc_id, @path AS path FROM documents WHERE lower(regexp_extract(@path, '\\.([^./]*)$', 1)) IN ('pdf', 'docx', 'xlsx', 'pptx', 'ppt', 'txt', 'md', 'html', 'eml', 'msg')")
def supported_filter(spark, d):
    return paths(spark, d).where(T.extension("path").isin(*T.SCANNED)).select("doc_id", "path")


@query("SELECT doc_id, @clean(text || chr(9) || chr(1) || '  x' || repeat(chr(10), 4) || ' ') AS cleaned FROM documents")
def clean_text(spark, d):
    return table(spark, d, "documents").select("doc_id", T.clean_text(F.concat("text", F.lit("\t\x01  x\n\n\n\n "))).alias("cleaned"))


@query("SELECT doc_id, @tokens(text) AS tokens FROM documents")
def token_estimate(spark, d):
    return table(spark, d, "documents").select("doc_id", T.estimate_tokens("text").alias("tokens"))


@query("SELECT lang, CAST(ceil(sum(length(text) + length(@summary(text))) / 4.0) AS BIGINT) AS tokens FROM documents GROUP BY lang")
def total_tokens(spark, d):
    from lodestone.operators.embed import total_tokens as total

    return table(spark, d, "documents").select("lang", F.col("text").alias("full_text"), T.generate_summary("text").alias("summary_text")).groupBy("lang").agg(total().alias("tokens"))


@query("SELECT source, count(*) AS chunks, '$' || printf('%.2f', count(*) * 2 * 500 / 1000.0::DOUBLE * 0.00013::DOUBLE) AS cost FROM documents GROUP BY source")
def embedding_cost(spark, d):
    return table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("chunks")).select("source", "chunks", T.embedding_cost("chunks").alias("cost"))


@query("SELECT doc_id, @summary(text) AS summary FROM documents")
def summaries(spark, d):
    return table(spark, d, "documents").select("doc_id", T.generate_summary("text").alias("summary"))


@query("""SELECT doc_id, n, CASE WHEN length(text) <= n THEN text WHEN i > 0 AND n - i > n - 50 THEN substr(text, 1, n - i) || '...' ELSE substr(text, 1, n) || '...' END AS short
  FROM (SELECT doc_id, text, n, instr(reverse(substr(text, 1, n)), ' ') AS i FROM documents, (VALUES (150), (200)) v(n))""")
def truncations(spark, d):
    docs = table(spark, d, "documents")
    both = [docs.select("doc_id", F.lit(n).alias("n"), T.truncate_text("text", n).alias("short")) for n in (150, 200)]
    return both[0].unionByName(both[1])


@query("SELECT page_id, CASE WHEN ends_with(url, '/') THEN url ELSE regexp_extract(url, '([^/]*)$', 1) END AS name FROM pages")
def filenames(spark, d):
    return table(spark, d, "pages").select("page_id", T.filename("url").alias("name"))


@query("""SELECT doc_id, CASE n_chars WHEN 0 THEN 'unknown size' ELSE CASE WHEN n < 1024 THEN n || ' B' WHEN n < 1048576 THEN printf('%.1f', floor(n / 1024.0::DOUBLE * 10 + 0.5) / 10) || ' KB' ELSE printf('%.1f', floor(n / 1048576.0::DOUBLE * 10 + 0.5) / 10) || ' MB' END END AS size
  FROM (SELECT doc_id, n_chars, n_chars * (doc_id % 90) AS n FROM documents) WHERE n > 0 OR n_chars = 0
  UNION ALL SELECT doc_id, 'unknown size' FROM documents WHERE n_chars * (doc_id % 90) = 0 AND n_chars <> 0""")
def size_format(spark, d):
    return table(spark, d, "documents").select("doc_id", T.format_size(F.col("n_chars") * (F.col("doc_id") % 90)).alias("size"))


@query("SELECT o_custkey, count(*) * 12345 AS n, regexp_replace(reverse(regexp_replace(reverse(CAST(count(*) * 12345 AS VARCHAR)), '([0-9]{3})', '\\1,', 'g')), '^,', '') AS shown FROM orders GROUP BY o_custkey")
def number_format(spark, d):
    return table(spark, d, "orders").groupBy("o_custkey").agg((F.count(F.lit(1)) * 12345).alias("n")).select("o_custkey", "n", T.format_count("n").alias("shown"))


# Plain text ------------------------------------------------------------------------------


@query("""WITH l AS (SELECT doc_id, text, string_split(text, chr(10)) AS a, list_filter(string_split(text, chr(10)), lambda x: @trim(x) <> '') AS s FROM (SELECT doc_id, replace(replace(text, '. ', chr(10)), ' the ', chr(10) || '    ') AS text FROM documents))
  SELECT doc_id, len(s) >= 2 AND (len(list_filter(s, lambda x: length(x) - length(replace(x, '|', '')) >= 2)) = len(s) OR len(list_filter(s, lambda x: contains(x, chr(9)))) = len(s) OR len(list_filter(s, lambda x: len(regexp_extract_all(x, '[@WS]{2,}')) >= 2)) = len(s)) AS is_table,
    len(a) >= 2 AND len(list_filter(a, lambda x: regexp_matches(x, '^([@WS]{4,}|\\t)') OR @trim(x) = '')) / len(a) >= 0.8 AS is_code,
    len(s) >= 2 AND len(list_filter(s, lambda x: regexp_matches(x, '^[@WS]*([-*•]|[0-9]+[.)]|[a-zA-Z][.)])[@WS]+'))) / len(s) >= 0.7 AS is_list FROM l""")
def text_shapes(spark, d):
    text = F.replace(F.replace("text", F.lit(". "), F.lit("\n")), F.lit(" the "), F.lit("\n    "))
    docs = table(spark, d, "documents").select("doc_id", text.alias("text"))
    return docs.select("doc_id", T.is_table_like("text").alias("is_table"), T.is_code_like("text").alias("is_code"), T.is_list_like("text").alias("is_list"))


@query("SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, p[i] AS paragraph FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, list_filter(regexp_split_to_array(text, '\\n[@WS]*\\n'), lambda x: @trim(x) <> '') AS p FROM @structured))")
def paragraphs(spark, d):
    return structured(spark, d).select("doc_id", F.posexplode(T.paragraphs("text")).alias("pos", "paragraph"))


@query("SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, p[i] AS sentence FROM (SELECT doc_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[@WS]+', '\\1' || chr(1), 'g'), chr(1)) AS p FROM documents))")
def sentences(spark, d):
    return table(spark, d, "documents").select("doc_id", F.posexplode(T.sentences("text")).alias("pos", "sentence"))


_LINES = """l AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS pos, a[i] AS line, CASE WHEN i > 1 THEN a[i - 1] ELSE '' END AS prev, CASE WHEN i < len(a) THEN a[i + 1] ELSE '' END AS next
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM @structured)))"""
_UNDER = _LINES + r""", u AS (SELECT *, regexp_matches(@trim(line), '^(={3,}|-{3,})\z') AS u, regexp_matches(@trim(next), '^(={3,}|-{3,})\z') AS un FROM l
), g AS (SELECT *, sum(CASE WHEN u THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM u
), f AS (SELECT *, min(CASE WHEN u THEN pos END) OVER (PARTITION BY doc_id, g) AS first FROM g
), k AS (SELECT *, u AND (pos - first + CASE WHEN first = 0 THEN 0 ELSE 1 END) % 2 = 1 AS is_under FROM f
), h AS (SELECT doc_id, pos, line, prev, next, un AS is_set, @trim(line) AS t FROM k WHERE NOT is_under
), e AS (SELECT doc_id, pos, line,
    CASE WHEN is_set THEN t WHEN length(t) < 2 THEN NULL
      WHEN regexp_matches(t, '^[A-Z][A-Z0-9@WS\-_&:,.]+\z') AND length(t) BETWEEN 3 AND 100 AND @trim(prev) = '' AND @trim(next) = '' THEN t
      WHEN regexp_matches(t, '(?i)^([0-9]+\.(?:[0-9]+\.)*|[@WS]*Chapter[@WS]+[0-9]+[:.]*)[@WS]*(?:.+)?\z') AND @trim(prev) = '' THEN t
      WHEN ends_with(t, ':') AND length(t) <= 80 AND @trim(prev) = '' AND @trim(next) <> '' THEN t[:-2]
      WHEN @trim(prev) = '' AND @trim(next) = '' AND length(t) BETWEEN 3 AND 60 AND NOT contains(t, '.') AND regexp_matches(t, '^[A-Z]') THEN t END AS heading,
    CAST(CASE WHEN is_set THEN CASE WHEN @trim(next)[1] = '=' THEN 1 ELSE 2 END WHEN length(t) < 2 THEN NULL
      WHEN regexp_matches(t, '^[A-Z][A-Z0-9@WS\-_&:,.]+\z') AND length(t) BETWEEN 3 AND 100 AND @trim(prev) = '' AND @trim(next) = '' THEN 1
      WHEN regexp_matches(t, '(?i)^([0-9]+\.(?:[0-9]+\.)*|[@WS]*Chapter[@WS]+[0-9]+[:.]*)[@WS]*(?:.+)?\z') AND @trim(prev) = '' THEN least(greatest(len(regexp_extract_all(regexp_extract(t, '(?i)^([0-9]+\.(?:[0-9]+\.)*|[@WS]*Chapter[@WS]+[0-9]+[:.]*)', 1), '\.')), 1), 6)
      WHEN ends_with(t, ':') AND length(t) <= 80 AND @trim(prev) = '' AND @trim(next) <> '' THEN 2
      WHEN @trim(prev) = '' AND @trim(next) = '' AND length(t) BETWEEN 3 AND 60 AND NOT contains(t, '.') AND regexp_matches(t, '^[A-Z]') THEN 2 END AS INTEGER) AS level FROM h
)"""


@query(f"WITH {_LINES} SELECT * FROM l")
def line_context(spark, d):
    return P.lines(structured(spark, d))


@query(f"WITH {_UNDER} SELECT doc_id, pos, is_under FROM k WHERE u")
def underlines(spark, d):
    return P.underlined(P.lines(structured(spark, d))).where(P._underline("line")).select("doc_id", "pos", "is_under")


@query(f"WITH {_UNDER} SELECT doc_id, pos, heading, level FROM e WHERE heading IS NOT NULL")
def detected_headings(spark, d):
    return P.headings(structured(spark, d)).where("heading is not null").select("doc_id", "pos", F.col("heading.text").alias("heading"), "heading.level")


_STACK = _UNDER + """, s AS (SELECT doc_id, pos, heading, level, CAST(sum(CASE WHEN heading IS NULL THEN 0 ELSE 1 END) OVER w AS INTEGER) AS section_id, """ + ", ".join(
    f"max(CASE WHEN level = {n} THEN {{'pos': pos, 't': heading}} END) OVER w AS h{n}" for n in range(1, 7)
) + """, line FROM e WINDOW w AS (PARTITION BY doc_id ORDER BY pos ROWS UNBOUNDED PRECEDING)
), st AS (SELECT doc_id, pos, line, heading, level, section_id, list_filter([""" + ", ".join(
    f"CASE WHEN h{n}.pos > greatest(-1, {', '.join(f'coalesce(h{k}.pos, -1)' for k in range(1, n)) or '-1'}) THEN h{n}.t END" for n in range(1, 7)
) + """], lambda x: x IS NOT NULL) AS path FROM s)"""


@query(f"WITH {_STACK} SELECT doc_id, pos, section_id, array_to_string(list_filter(path, lambda x: @trim(x) <> ''), ' > ') AS title_text, CAST(len(path) AS INTEGER) AS depth FROM st WHERE heading IS NOT NULL")
def heading_stack(spark, d):
    h = P.headings(structured(spark, d)).where("heading is not null").select("doc_id", "pos", F.lit("heading").alias("type"), F.col("heading.text").alias("content"), "heading.level")
    return S.with_heading_path(S.with_section(h)).select("doc_id", "pos", "section_id", T.join_heading_path("heading_path").alias("title_text"), F.size("heading_path").alias("depth"))


_SECTIONS = _STACK + r""", body AS (SELECT doc_id, section_id, any_value(path) AS path, @trim(string_agg(line, chr(10) ORDER BY pos)) AS text FROM st WHERE heading IS NULL GROUP BY doc_id, section_id
), para AS (SELECT doc_id, section_id, i, @trim(p[i]) AS p FROM (SELECT doc_id, section_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, section_id, list_filter(regexp_split_to_array(text, '\n[@WS]*\n'), lambda x: @trim(x) <> '') AS p FROM body))
), sec AS (SELECT doc_id, section_id, any_value(body.path) AS path, @clean(string_agg(p, chr(10) || chr(10) ORDER BY i)) AS text FROM para JOIN body USING (doc_id, section_id) GROUP BY doc_id, section_id)"""


@query(f"WITH {_SECTIONS} SELECT doc_id, section_id, text, array_to_string(list_filter(path, lambda x: @trim(x) <> ''), ' > ') AS title_text, path[-1] AS section_title FROM sec")
def sections(spark, d):
    s = S.sections(P.blocks(structured(spark, d)))
    return s.select("doc_id", "section_id", T.clean_text("text").alias("text"), T.join_heading_path("heading_path").alias("title_text"), F.try_element_at("heading_path", F.lit(-1)).alias("section_title"))


#: Long sections cut by recursion: sentences of oversized paragraphs, then paragraphs.
_CHUNKS = _SECTIONS + r""", long AS (SELECT doc_id, section_id, text FROM sec WHERE ceil(length(text) / 4.0) > 1000
), lp AS (SELECT doc_id, section_id, i, p[i] AS p, len(p) AS n FROM (SELECT doc_id, section_id, p, unnest(range(1, len(p) + 1)) AS i FROM (SELECT doc_id, section_id, list_filter(regexp_split_to_array(text, '\n[@WS]*\n'), lambda x: @trim(x) <> '') AS p FROM long))
), over AS (SELECT doc_id, section_id, i AS par, string_split(regexp_replace(p, '([.!?])[@WS]+', '\1' || chr(1), 'g'), chr(1)) AS s FROM lp WHERE ceil(length(p) / 4.0) > 500
), sf(doc_id, section_id, par, k, cur, done) AS (
  SELECT doc_id, section_id, par, 0, '', CAST([] AS VARCHAR[]) FROM over
  UNION ALL
  SELECT sf.doc_id, sf.section_id, sf.par, k + 1,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(s[k + 1]) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN s[k + 1] WHEN cur = '' THEN s[k + 1] ELSE cur || ' ' || s[k + 1] END,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(s[k + 1]) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN list_append(done, @trim(cur)) ELSE done END
  FROM sf JOIN over ON over.doc_id = sf.doc_id AND over.section_id = sf.section_id AND over.par = sf.par WHERE k < len(s)
), sc AS (SELECT sf.doc_id, sf.section_id, sf.par, CASE WHEN @trim(cur) <> '' THEN list_append(done, @trim(cur)) ELSE done END AS cs FROM sf JOIN over ON over.doc_id = sf.doc_id AND over.section_id = sf.section_id AND over.par = sf.par WHERE k = len(s)
), pf(doc_id, section_id, k, cur, done) AS (
  SELECT doc_id, section_id, 0, '', CAST([] AS VARCHAR[]) FROM long
  UNION ALL
  SELECT pf.doc_id, pf.section_id, k + 1,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(p) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN p WHEN ceil(length(p) / 4.0) > 500 THEN '' WHEN cur = '' THEN p ELSE cur || chr(10) || chr(10) || p END,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(p) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN list_append(done, @trim(cur))
      WHEN ceil(length(p) / 4.0) > 500 THEN list_concat(CASE WHEN @trim(cur) <> '' THEN list_append(done, @trim(cur)) ELSE done END, cs) ELSE done END
  FROM pf JOIN lp ON lp.doc_id = pf.doc_id AND lp.section_id = pf.section_id AND lp.i = k + 1 LEFT JOIN sc ON sc.doc_id = pf.doc_id AND sc.section_id = pf.section_id AND sc.par = lp.i
), parts AS (
  SELECT pf.doc_id, pf.section_id, CASE WHEN @trim(cur) <> '' THEN list_append(done, @trim(cur)) ELSE done END AS cs FROM pf JOIN (SELECT DISTINCT doc_id, section_id, n FROM lp) m ON m.doc_id = pf.doc_id AND m.section_id = pf.section_id WHERE k = n
), piece AS (
  SELECT doc_id, section_id, path, i AS part, cs[i] AS text FROM (SELECT doc_id, section_id, path, cs, unnest(range(1, len(cs) + 1)) AS i FROM (
    SELECT sec.doc_id, sec.section_id, path, coalesce(cs, [sec.text]) AS cs FROM sec LEFT JOIN parts ON parts.doc_id = sec.doc_id AND parts.section_id = sec.section_id WHERE sec.text <> ''))
), titled AS (SELECT *, array_to_string(list_filter(path, lambda x: @trim(x) <> ''), ' > ') AS title FROM piece
), chunk AS (
  SELECT doc_id AS key, substr(sha256('/corpus/' || doc_id || '.txt'), 1, 16) AS did, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY section_id, part) - 1 AS INTEGER) AS chunk_index,
    CASE WHEN title <> '' THEN title || chr(10) || chr(10) || text ELSE text END AS full_text, @summary(text) AS summary_text, title AS title_text FROM titled
  UNION ALL SELECT doc_id, substr(sha256('/corpus/' || doc_id || '.txt'), 1, 16), 0, '[Empty document]', 'Empty document', '' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM piece)
)"""


def corpus_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of the structured view, by the pass without a shuffle."""
    docs = structured(spark, d).select(F.concat(F.lit("/corpus/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text")
    return chunk_texts(docs)


@query(f"WITH RECURSIVE {_CHUNKS} SELECT did || '::' || chunk_index AS id, did AS doc_id, chunk_index, full_text, summary_text, title_text FROM chunk")
def chunks_flagship(spark, d):
    return corpus_chunks(spark, d).select("id", "doc_id", "chunk_index", "full_text", "summary_text", "title_text")


@query(f"WITH RECURSIVE {_CHUNKS} SELECT did || '::' || chunk_index AS id, did AS doc_id, chunk_index, full_text, summary_text, title_text FROM chunk")
def chunks_relational(spark, d):
    """The flagship's rows by windows and aggregates over rows of blocks."""
    docs = structured(spark, d).withColumn("source_path", F.concat(F.lit("/corpus/"), F.col("doc_id").cast("string"), F.lit(".txt"))).withColumn("doc_id", T.doc_id("source_path"))
    keys = docs.select("doc_id", "source_path", F.lit("txt").alias("doc_type"), F.create_map().cast("map<string,string>").alias("doc_metadata"))
    return S.chunk_blocks(P.blocks(docs.select("doc_id", "text")), keys).select("id", "doc_id", "chunk_index", "full_text", "summary_text", "title_text")


@query(f"WITH RECURSIVE {_CHUNKS} SELECT section_id, len(cs) AS total_parts, doc_id, CAST(list_sum(list_transform(cs, lambda x: length(x))) AS BIGINT) AS chars FROM parts")
def split_parts(spark, d):
    s = S.sections(P.blocks(structured(spark, d))).withColumn("text", T.clean_text("text")).where(T.estimate_tokens("text") > SPLIT_ABOVE)
    parts = s.select("doc_id", "section_id", split_text("text").alias("cs"))
    return parts.select("doc_id", "section_id", F.size("cs").cast("long").alias("total_parts"), F.aggregate("cs", F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("chars"))


@query(r"""WITH RECURSIVE o AS (SELECT doc_id, string_split(regexp_replace(text, '([.!?])[@WS]+', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents WHERE ceil(length(text) / 4.0) > 1000
), f(doc_id, k, cur, done) AS (SELECT doc_id, 0, '', CAST([] AS VARCHAR[]) FROM o
  UNION ALL SELECT f.doc_id, k + 1,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(s[k + 1]) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN s[k + 1] WHEN cur = '' THEN s[k + 1] ELSE cur || ' ' || s[k + 1] END,
    CASE WHEN ceil(length(cur) / 4.0) + ceil(length(s[k + 1]) / 4.0) > 500 AND ceil(length(cur) / 4.0) >= 200 THEN list_append(done, @trim(cur)) ELSE done END
  FROM f JOIN o ON o.doc_id = f.doc_id WHERE k < len(s)
), r AS (SELECT f.doc_id, CASE WHEN @trim(cur) <> '' THEN list_append(done, @trim(cur)) ELSE done END AS cs FROM f JOIN o ON o.doc_id = f.doc_id WHERE k = len(s))
SELECT doc_id, CAST(i - 1 AS INTEGER) AS part, cs[i] AS text FROM (SELECT doc_id, cs, unnest(range(1, len(cs) + 1)) AS i FROM r)""")
def sentence_chunks(spark, d):
    long = table(spark, d, "documents").where(T.estimate_tokens("text") > SPLIT_ABOVE)
    return long.select("doc_id", F.posexplode(split_sentences("text")).alias("part", "text"))


@query(f"WITH RECURSIVE {_CHUNKS} SELECT lang, count(*) AS chunks, count(DISTINCT key) AS docs, CAST(sum(length(full_text)) AS BIGINT) AS chars FROM chunk JOIN documents ON documents.doc_id = key GROUP BY lang")
def chunk_stats_by_lang(spark, d):
    return _stats(spark, d, "lang")


@query(f"WITH RECURSIVE {_CHUNKS} SELECT source, count(*) AS chunks, count(DISTINCT key) AS docs, CAST(sum(length(full_text)) AS BIGINT) AS chars FROM chunk JOIN documents ON documents.doc_id = key GROUP BY source")
def chunk_stats_by_source(spark, d):
    return _stats(spark, d, "source")


def _stats(spark: SparkSession, d: str, by: str) -> DataFrame:
    per_doc = corpus_chunks(spark, d).groupBy("source_path").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("full_text")).alias("chars"))
    docs = table(spark, d, "documents").select(by, F.concat(F.lit("/corpus/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("source_path"))
    return per_doc.join(docs, "source_path").groupBy(by).agg(F.sum("n").alias("chunks"), F.count(F.lit(1)).alias("docs"), F.sum("chars").alias("chars"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, last_value(CASE WHEN l_quantity > 25 THEN l_partkey END IGNORE NULLS) OVER w AS page, last_value(CASE WHEN l_tax > 0.04 THEN l_shipmode END IGNORE NULLS) OVER w AS sheet
  FROM (SELECT *, l_returnflag AS l_shipmode FROM lineitem) WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_tax, l_returnflag, l_quantity ROWS UNBOUNDED PRECEDING)""")
def location_carry(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_tax", "l_returnflag", "l_quantity").alias("pos"), F.when(F.col("l_quantity") > 25, F.col("l_partkey")).alias("page_number"),
        F.lit(None).cast("int").alias("slide_number"), F.when(F.col("l_tax") > 0.04, F.col("l_returnflag")).alias("sheet_name"),
    )
    return S.with_location(rows).select(F.col("doc_id").alias("l_orderkey"), "pos.l_linenumber", "pos.l_partkey", F.col("page_number").alias("page"), F.col("sheet_name").alias("sheet"))


@query("SELECT l_orderkey, bool_or(l_returnflag = 'R') AS is_table, bool_or(l_linestatus = 'O') AS is_code, string_agg(l_returnflag || l_linenumber, chr(10) || chr(10) ORDER BY l_linenumber, l_returnflag) AS text FROM lineitem GROUP BY l_orderkey")
def section_flags(spark, d):
    none = F.lit(None)
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("pos"), F.lit("paragraph").alias("type"), F.concat("l_returnflag", F.col("l_linenumber").cast("string")).alias("content"), none.cast("int").alias("level"),
        (F.col("l_returnflag") == "R").alias("is_table"), (F.col("l_linestatus") == "O").alias("is_code"), none.cast("int").alias("page_number"), none.cast("int").alias("slide_number"), none.cast("string").alias("sheet_name"), none.cast("map<string,string>").alias("metadata"),
    )
    return S.sections(rows).select(F.col("doc_id").alias("l_orderkey"), "is_table", "is_code", "text")


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'c::' || doc_id ELSE 'e::' || doc_id END AS id, CASE WHEN doc_id % 3 = 0 THEN text ELSE '[Empty document]' END AS full_text, CASE WHEN doc_id % 3 = 0 THEN 'false' ELSE 'true' END AS empty FROM documents WHERE doc_id % 3 = 0 UNION ALL SELECT doc_id, doc_id || '::0', '[Empty document]', 'true' FROM documents WHERE doc_id % 3 <> 0")
def empty_docs(spark, d):
    docs = table(spark, d, "documents")
    none = F.create_map().cast("map<string,string>")
    have = docs.where("doc_id % 3 = 0").select(
        F.concat(F.lit("c::"), F.col("doc_id").cast("string")).alias("id"), "doc_id", F.lit(0).alias("chunk_index"), F.col("text").alias("full_text"), F.lit("").alias("summary_text"), F.lit("").alias("title_text"),
        F.array().cast("array<string>").alias("heading_path"), F.lit(None).cast("string").alias("section_title"), F.lit(False).alias("is_table"), F.lit(False).alias("is_code"),
        F.lit(None).cast("int").alias("page_number"), F.lit(None).cast("int").alias("slide_number"), F.lit(None).cast("string").alias("sheet_name"), none.alias("metadata"),
    )
    out = S.with_empty(have, docs.select("doc_id", F.lit("txt").alias("doc_type"), F.col("source").alias("source_path"), none.alias("doc_metadata")))
    return out.select("doc_id", "id", "full_text", F.coalesce(F.try_element_at("metadata", F.lit("isEmpty")), F.lit("false")).alias("empty"))


# HTML and mail ---------------------------------------------------------------------------


@query("SELECT page_id, @trim(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1), '&quot;', '\"'), '&amp;', '&')) AS heading, CAST(1 AS INTEGER) AS level FROM pages")
def html_headings(spark, d):
    b = blocks_of(table(spark, d, "pages").select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")), "html")
    return b.where("type = 'heading'").select(F.col("doc_id").alias("page_id"), F.col("content").alias("heading"), "level")


@query("SELECT page_id, @trim(replace(replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '&quot;', '\"'), '&amp;', '&')) AS title FROM pages")
def html_title(spark, d):
    docs = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("path"), F.col("html").alias("text"))
    first = chunk_texts(docs, "html").where("chunk_index = 0")
    return first.select(F.col("source_path").cast("long").alias("page_id"), F.coalesce(F.try_element_at("metadata", F.lit("title")), F.lit("")).alias("title"))


@query(r"""SELECT page_id, @trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
  '(?is)<style[^>]*>.*?</style>', '', 'g'), '(?is)<script[^>]*>.*?</script>', '', 'g'), '(?i)<br[@WS]*/?>', chr(10), 'g'), '(?i)</p>', chr(10) || chr(10), 'g'), '(?i)</div>', chr(10), 'g'), '<[^>]+>', '', 'g'),
  '&nbsp;', ' '), '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '\n{3,}', chr(10) || chr(10), 'g')) AS text FROM pages""")
def html_stripped(spark, d):
    return table(spark, d, "pages").select("page_id", T.strip_html("html").alias("text"))


@query()
def html_chunks(spark, d):
    """Chunks of all pages; tests hold them against fixed trees."""
    return chunk_texts(table(spark, d, "pages").select(F.col("url").alias("path"), F.col("html").alias("text")), "html").drop("metadata", "heading_path")


_MAIL = "(SELECT conv_id AS doc_id, string_agg(CASE WHEN role = 'user' THEN '> ' ELSE '' END || text, chr(10) ORDER BY turn, text) || chr(10) || 'On day ' || conv_id || ' she wrote:' || chr(10) || 'Thanks,' AS text FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations) GROUP BY conv_id)"


def mails(spark: SparkSession, d: str) -> DataFrame:
    line = F.concat(F.when(F.col("role") == "user", "> ").otherwise(""), F.coalesce("text", F.lit("")))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"), line.alias("line")))), lambda x: x["line"]), "\n")
    m = table(spark, d, "conversations").groupBy("conv_id").agg(body.alias("text"))
    return m.select(F.col("conv_id").alias("doc_id"), F.concat("text", F.lit("\nOn day "), F.col("conv_id").cast("string"), F.lit(" she wrote:\nThanks,")).alias("text"))


@query(rf"""WITH l AS (SELECT doc_id, i, a[i] AS line, regexp_matches(a[i], '^>') OR regexp_matches(@trim(a[i]), '^On .+ wrote:\z') OR regexp_matches(a[i], '^-{{3,}} ?Original Message ?-{{3,}}') OR regexp_matches(a[i], '(?s)^From:.*Sent:.*To:') AS q
  FROM (SELECT doc_id, a, unnest(range(1, len(a) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM {_MAIL})))
, r AS (SELECT *, sum(CASE WHEN q <> p THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS part FROM (SELECT *, lag(q, 1, false) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM l))
SELECT doc_id, CAST(part AS INTEGER) AS part, any_value(q) AS is_quote, @trim(string_agg(line, chr(10) ORDER BY i)) AS content FROM r GROUP BY doc_id, part HAVING @trim(string_agg(line, chr(10) ORDER BY i)) <> ''""")
def quote_runs(spark, d):
    return P.quote_parts(mails(spark, d))


@query(rf"SELECT doc_id, regexp_matches(text, '(?m)^--[@WS]*$') OR regexp_matches(text, '(?im)^((Regards|Best|Thanks|Sincerely),?[@WS]*$|Sent from my)') AS signed FROM {_MAIL}")
def signatures(spark, d):
    return mails(spark, d).select("doc_id", T.is_signature("text").alias("signed"))


# Sheets ----------------------------------------------------------------------------------


@query("""WITH r AS (SELECT user_id, event_id, value > 5 AS full_row, value, length(event_type) % 4 AS col FROM events)
, g AS (SELECT *, sum(CASE WHEN full_row THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM r)
SELECT user_id, min(event_id) AS start_row, max(event_id) AS end_row, count(*) AS n_rows, min(col) AS start_col, max(col) AS end_col FROM g WHERE full_row GROUP BY user_id, g""")
def table_regions(spark, d):
    """The regions of a user's events as a sheet: an event is a row, its cell in a column of
    its own or the row empty. A sheet is read whole, as the decoder does."""
    e = table(spark, d, "events").select("user_id", "event_id", F.coalesce(F.length("event_type") % 4, F.lit(0)).cast("long").alias("col"), F.coalesce(F.col("value") > 5, F.lit(False)).alias("full_row"))
    kinds = dict(e.dtypes)
    names = ("start_row", "end_row", "n_rows", "start_col", "end_col")

    def run(sheet: pa.Table) -> pa.Table:
        events = sheet.select(["event_id", "col", "full_row"]).to_pylist()
        rows = [[None] * r["col"] + [(r["event_id"], r["col"])] if r["full_row"] else [] for r in sorted(events, key=lambda r: r["event_id"])]
        out = []
        for region in regions(rows):
            cells = [(k, c) for r in region for k, c in enumerate(r) if c is not None]
            # the region is cut to its columns: its first one is where a cell was, less where it is now
            left = cells[0][1][1] - cells[0][0]
            out.append((cells[0][1][0], cells[-1][1][0], len(region), left, left + max(map(len, region)) - 1))
        cols = list(zip(*out)) if out else [()] * len(names)
        users = pa.array([sheet["user_id"][0].as_py()] * len(out), sheet.schema.field("user_id").type)
        return pa.table([users, *(pa.array(c, sheet.schema.field("event_id").type if n in names[:2] else pa.int64()) for n, c in zip(names, cols))], names=["user_id", *names])

    return e.groupBy("user_id").applyInArrow(run, f"user_id {kinds['user_id']}, start_row {kinds['event_id']}, end_row {kinds['event_id']}, n_rows long, start_col long, end_col long")


@query("SELECT n_regionkey, count(DISTINCT lower(n_name)) = count(n_name) OR bool_or(n_nationkey > 20) AS has_header, count(*) AS cells FROM nation GROUP BY n_regionkey")
def header_rows(spark, d):
    """Whether the names of a region's nations head a sheet of two rows: below them are the
    nations' keys, as numbers from 21 on and as text before."""
    n = table(spark, d, "nation").select("n_regionkey", "n_nationkey", "n_name")

    def run(sheet: pa.Table) -> pa.Table:
        keys = [k if k is None or k > 20 else str(k) for k in sheet["n_nationkey"].to_pylist()]
        head = has_header([sheet["n_name"].to_pylist(), keys])
        return pa.table([sheet["n_regionkey"].slice(0, 1), pa.array([head]), pa.array([sheet.num_rows], pa.int64())], names=["n_regionkey", "has_header", "cells"])

    return n.groupBy("n_regionkey").applyInArrow(run, f"n_regionkey {dict(n.dtypes)['n_regionkey']}, has_header boolean, cells long")


@query("""WITH c AS (SELECT c_nationkey, c_custkey, c_name, c_mktsegment, CAST(greatest(max(length(c_name)) OVER w, 3) AS INTEGER) AS a, CAST(greatest(max(length(c_mktsegment)) OVER w, 3) AS INTEGER) AS b FROM customer WINDOW w AS (PARTITION BY c_nationkey))
, l AS (SELECT c_nationkey, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i, rpad(c_name, a, ' ') || ' | ' || rpad(c_mktsegment, b, ' ') AS line, repeat('-', a) || '-+-' || repeat('-', b) AS rule FROM c)
SELECT c_nationkey, string_agg(CASE WHEN i = 1 THEN line || chr(10) || rule ELSE line END, chr(10) ORDER BY c_custkey) AS content FROM l GROUP BY c_nationkey HAVING count(*) > 1""")
def text_table(spark, d):
    """The customers of a nation as a text table, by the decoders' own function."""
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name", "c_mktsegment")

    def run(nation: pa.Table) -> pa.Table:
        rows = [r[1:] for r in sorted(zip(*(nation[c].to_pylist() for c in ("c_custkey", "c_name", "c_mktsegment"))))]
        return pa.table([nation["c_nationkey"].slice(0, 1), pa.array([aligned_table(rows)])], names=["c_nationkey", "content"])

    return c.groupBy("c_nationkey").applyInArrow(run, f"c_nationkey {dict(c.dtypes)['c_nationkey']}, content string").where(F.size(F.split("content", "\n")) > 2)


# Retrieval -------------------------------------------------------------------------------


def query_vector(spark: SparkSession, d: str) -> list[float]:
    return table(spark, d, "embeddings").where("vec_id = 7").first()["embedding"]


_COS = "list_cosine_similarity(CAST(embedding AS DOUBLE[]), CAST((SELECT embedding FROM embeddings WHERE vec_id = 7) AS DOUBLE[]))"


@query(f"SELECT vec_id, round({_COS}, 6) AS score FROM embeddings ORDER BY {_COS} DESC, vec_id LIMIT 10")
def vector_topk(spark, d):
    top = R.vector_search(table(spark, d, "embeddings"), query_vector(spark, d), 10, "vec_id", "embedding")
    return top.select("vec_id", F.round("score", 6).alias("score"))


@query("""WITH s AS (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS score FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0)
SELECT query_id, vec_id, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, vec_id) AS rank FROM s) WHERE rank <= 10""")
def vector_topk_batch(spark, d):
    e = table(spark, d, "embeddings")
    asked = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return R.vector_search_batch(e, asked, 10, "vec_id", "embedding").select("query_id", "vec_id", "rank")


_WORDS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"
_MATCH = f"(SELECT doc_id FROM documents WHERE list_has_all({_WORDS}, ['the', 'in']))"


@query(f"SELECT doc_id FROM {_MATCH}")
def text_match(spark, d):
    return table(spark, d, "documents").where(R.matches("text", "The in!")).select("doc_id")


@query(f"SELECT doc_id, CAST(rank AS INTEGER) AS rank, round(1.0::DOUBLE / rank, 6) AS score FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM {_MATCH}) WHERE rank <= 50")
def text_scores(spark, d):
    return R.text_search(table(spark, d, "documents"), "the in", 50, "doc_id").select("doc_id", "rank", F.round("score", 6).alias("score"))


@query(f"SELECT word, count(*) AS docs FROM (SELECT DISTINCT doc_id, unnest({_WORDS}) AS word FROM documents) GROUP BY word")
def postings_sizes(spark, d):
    return table(spark, d, "documents").select("doc_id", F.explode(words("text")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("docs"))


_HYBRID = f"""WITH v AS (SELECT vec_id AS id, row_number() OVER (ORDER BY round({_COS}, 9) DESC, vec_id) AS vr FROM embeddings JOIN documents ON doc_id = vec_id QUALIFY vr <= 100)
, t AS (SELECT doc_id AS id, row_number() OVER (ORDER BY doc_id) AS tr FROM {_MATCH} JOIN embeddings ON vec_id = doc_id QUALIFY tr <= 100)
, f AS (SELECT coalesce(v.id, t.id) AS id, vr, tr, coalesce(1.0::DOUBLE / (60 + vr), 0::DOUBLE) + coalesce(1.0::DOUBLE / (60 + tr), 0::DOUBLE) AS rrf FROM v FULL JOIN t ON v.id = t.id)
, top AS (SELECT * FROM f ORDER BY round(rrf, 12) DESC, vr NULLS LAST, tr LIMIT 10)"""


def hybrid(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").join(table(spark, d, "embeddings"), F.col("doc_id") == F.col("vec_id")).select(F.col("doc_id").alias("id"), "text", F.col("embedding").alias("full_vector"), "source")
    return R.hybrid_search(docs, "the in", query_vector(spark, d), 10)


@query(_HYBRID + " SELECT id, CAST(vr AS INTEGER) AS vector_rank, CAST(tr AS INTEGER) AS text_rank, round(rrf, 6) AS rrf_score FROM top")
def hybrid_rrf(spark, d):
    return hybrid(spark, d).select("id", "vector_rank", "text_rank", F.round("rrf_score", 6).alias("rrf_score"))


@query(_HYBRID + " SELECT count_if(vr IS NOT NULL AND tr IS NOT NULL)::BIGINT AS in_both, count_if(vr IS NOT NULL AND tr IS NULL)::BIGINT AS vector_only, count_if(vr IS NULL AND tr IS NOT NULL)::BIGINT AS text_only FROM top")
def rrf_impact(spark, d):
    return R.impact(hybrid(spark, d))


@query(_HYBRID + """ SELECT id, round(rrf, 6) AS score, id || '.txt' AS file, 'TXT' AS type, CASE WHEN id % 3 = 1 THEN 'Page ' || (id % 3) END AS location, CASE WHEN id % 2 = 0 THEN 'Table' ELSE '' END AS flags, @summary(text) AS preview
  FROM top JOIN documents ON doc_id = id""")
def search_display(spark, d):
    r = hybrid(spark, d).withColumns({
        "source_path": F.concat(F.lit("/x/"), F.col("id").cast("string"), F.lit(".txt")), "doc_type": F.lit("txt"), "title_text": F.lit(""), "summary_text": T.generate_summary("text"),
        "page_number": F.when(F.col("id") % 3 == 1, 1), "slide_number": F.lit(None).cast("int"), "sheet_name": F.lit(""), "is_table": F.col("id") % 2 == 0, "is_code": F.lit(False),
    })
    return R.display(r).withColumn("score", F.round("score", 6)).drop("title_text")


# Index -----------------------------------------------------------------------------------


@query("SELECT doc_id, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM documents JOIN embeddings ON doc_id = vec_id")
def embedding_join(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), F.col("embedding").alias("full_vector"), F.col("embedding").alias("summary_vector"))
    ids = table(spark, d, "embeddings").select("vec_id")
    docs = table(spark, d, "documents").join(ids, F.col("doc_id") == F.col("vec_id"), "left_semi").select(F.col("doc_id").cast("string").alias("id"), "doc_id")
    total = F.aggregate("full_vector", F.lit(0.0), lambda s, x: s + x.cast("double"))
    return embedded(docs, e).select("doc_id", F.round(total, 6).alias("total"))


@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)")
def embeddings_missing(spark, d):
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"))
    return missing_embeddings(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id")), e)


@query("""SELECT concat_ws('-', h[1:8], h[9:12], h[13:16], h[17:20], h[21:32]) AS id, chunk_id, text, doc_type, source_path, CAST(chunk_index AS INTEGER) AS chunk_index, updated_at FROM (
  SELECT sha256(doc_id || '::0') AS h, doc_id || '::0' AS chunk_id, text, 'txt' AS doc_type, source AS source_path, 0 AS chunk_index, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM documents)""")
def points_payload(spark, d):
    none = F.lit(None)
    c = table(spark, d, "documents").select(
        T.chunk_id("doc_id", F.lit(0)).alias("id"), "doc_id", F.lit(0).alias("chunk_index"), F.col("text").alias("full_text"), F.lit("").alias("summary_text"), F.lit("").alias("title_text"), F.array().cast("array<string>").alias("heading_path"),
        none.cast("string").alias("section_title"), F.lit(False).alias("is_table"), F.lit(False).alias("is_code"), F.lit("txt").alias("doc_type"), F.col("source").alias("source_path"), none.cast("int").alias("page_number"),
        none.cast("int").alias("slide_number"), none.cast("string").alias("sheet_name"), none.cast("map<string,string>").alias("metadata"), none.cast("array<float>").alias("full_vector"), none.cast("array<float>").alias("summary_vector"),
    )
    return points(c, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).select("id", "chunk_id", "text", "doc_type", "source_path", "chunk_index", "updated_at")


def event_index(spark: SparkSession, d: str) -> Collection:
    """A collection of the users' events, upserted in two parts by user: the last event stands."""
    held = Collection(spark, scratch(spark, "events"), "events", 1)
    held.create()
    e = table(spark, d, "events").where("user_id is not null")
    rows = e.select(F.col("user_id").cast("string").alias("id"), F.array(F.col("value").cast("float")).alias("full_vector"), F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("text"), "event_type", "value", "event_id", F.col("event_type").alias("doc_type"), F.col("user_id").cast("string").alias("doc_id"), (F.col("event_id") % 2 == 0).alias("is_table"))
    held.upsert(rows.where("event_id % 3 <> 0"), ["event_id"])
    # an upsert replaces what is there: of the second part, what is newer
    newest = latest(rows, "id", "event_id").where("event_id % 3 = 0")
    held.upsert(newest, ["event_id"])
    return held


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE user_id IS NOT NULL) WHERE n = 1")
def upsert_latest(spark, d):
    """Points of an index after two upserts."""
    return event_index(spark, d).read().select(F.col("id").cast("long").alias("user_id"), "event_id", "event_type", "value")


@query("SELECT count(DISTINCT user_id) AS points FROM events")
def point_count(spark, d):
    return spark.createDataFrame([(event_index(spark, d).count(),)], "points long")


@query("""SELECT CAST(user_id AS VARCHAR) AS id, word FROM (SELECT user_id, unnest([lower(event_type), CAST(event_id AS VARCHAR)]) AS word FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE user_id IS NOT NULL) WHERE n = 1)
WHERE word <> ''""")
def index_postings(spark, d):
    """The postings of that index."""
    return event_index(spark, d).postings().select("id", "word")


_NEWEST = "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events WHERE user_id IS NOT NULL) WHERE n = 1"


@query(f"SELECT * FROM ({_NEWEST}) WHERE event_type IN ('click', 'view') AND event_id % 2 = 0")
def filtered_points(spark, d):
    """Points by the indexes of their payload: files are passed over by their statistics."""
    where = {"doc_type": ["click", "view"], "is_table": True}
    return event_index(spark, d).read(where).select(F.col("id").cast("long").alias("user_id"), "event_id", "event_type")


@query(f"SELECT * FROM ({_NEWEST}) WHERE event_id % 5 <> 0")
def points_left(spark, d):
    """What an index holds when points have been dropped, and again when it is one segment."""
    held = event_index(spark, d)
    held.delete(held.read().where("event_id % 5 = 0").select("id"))
    held.compact()
    return held.read().select(F.col("id").cast("long").alias("user_id"), "event_id", "event_type")


def vector_index(spark: SparkSession, d: str) -> tuple[VectorIndex, DataFrame]:
    """An index of all embeddings, and the stated queries: every vector whose id is divisible by 50."""
    rows = table(spark, d, "embeddings")
    held = VectorIndex(spark, scratch(spark, "vectors"), 64)
    held.build(rows, "vec_id", "embedding")
    return held, rows.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))


@query(None)
def vector_index_topk(spark, d):
    """The ten nearest vectors of each query by the index."""
    held, asked = vector_index(spark, d)
    return held.search(asked, 10).select("query_id", F.col("key").alias("vec_id"), F.round("score", 6).alias("score"), "rank")


@query("SELECT count(*) AS queries, true AS enough FROM embeddings WHERE vec_id % 50 = 0")
def vector_index_recall(spark, d):
    """Whether the index finds 95 of 100 exact neighbours."""
    held, asked = vector_index(spark, d)
    exact = held.search(asked, 10, exact=True).select("query_id", "key")
    found = held.search(asked, 10).select("query_id", "key").join(exact, ["query_id", "key"])
    return asked.agg(F.count(F.lit(1)).alias("queries")).crossJoin(found.agg(F.count(F.lit(1)).alias("found"))).crossJoin(exact.agg(F.count(F.lit(1)).alias("exact"))).select("queries", (F.col("found") >= 0.95 * F.col("exact")).alias("enough"))


def sparse_index(spark: SparkSession, d: str) -> tuple[SparseIndex, DataFrame]:
    """The words of all documents as sparse vectors, and the benchmark's items as queries."""
    held = SparseIndex(spark, scratch(spark, "sparse"))
    held.build(counted(table(spark, d, "documents"), "doc_id", "text"), "doc_id")
    return held, counted(table(spark, d, "benchmark"), "item_id", "text").withColumnRenamed("item_id", "query_id")


_TERMS = "SELECT {0} AS key, w AS term, count(*) AS weight FROM (SELECT {0}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS w FROM {1}) WHERE w <> '' GROUP BY ALL"


@query(f"""SELECT * FROM (SELECT q.key AS query_id, d.key AS doc_id, CAST(sum(q.weight * d.weight) AS DOUBLE) AS score, CAST(row_number() OVER (PARTITION BY q.key ORDER BY sum(q.weight * d.weight) DESC, d.key) AS INTEGER) AS rank
FROM ({_TERMS.format("item_id", "benchmark")}) q JOIN ({_TERMS.format("doc_id", "documents")}) d USING (term) GROUP BY q.key, d.key) WHERE rank <= 5""")
def sparse_topk(spark, d):
    """The five documents with the greatest inner product with each item, in the sparse space."""
    held, asked = sparse_index(spark, d)
    return held.search(asked, 5).withColumnRenamed("key", "doc_id")


@query(f"SELECT doc_id, CAST(rank AS INTEGER) AS rank FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM {_MATCH}) WHERE rank <= 5")
def search_by_mode(spark, d):
    """The dispatch of modes and limits: a limit that is no number is the default one."""
    docs = table(spark, d, "documents").withColumn("id", F.col("doc_id"))
    return R.search(docs, "the in", HashingProvider(8), "text", "many").select("doc_id", "rank")


@query("SELECT vec_id // 50 AS batch, count(*) AS points, min(vec_id) AS first, max(vec_id) AS last FROM embeddings GROUP BY ALL")
def upsert_batches(spark, d):
    return batch_numbers(table(spark, d, "embeddings"), "vec_id").groupBy("batch").agg(F.count(F.lit(1)).alias("points"), F.min("vec_id").alias("first"), F.max("vec_id").alias("last"))


_KNOWN = "doc_id % 10 <> 9"


@query(f"SELECT source, count(*) AS files, count_if(NOT ({_KNOWN}))::BIGINT AS failed, count_if({_KNOWN})::BIGINT AS succeeded FROM documents GROUP BY source")
def processing_summary(spark, d):
    p = paths(spark, d).withColumn("ok", T.doc_type("path").isNotNull())
    return p.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.count_if(~F.col("ok")).alias("failed"), F.count_if("ok").alias("succeeded"))


@query(f"SELECT @path AS file, 'Unsupported file extension: .' || lower(regexp_extract(@path, '\\.([^./]*)$', 1)) AS error FROM documents WHERE NOT ({_KNOWN})")
def error_rows(spark, d):
    p = paths(spark, d).where(T.doc_type("path").isNull())
    return p.select(F.col("path").alias("file"), F.concat(F.lit("Unsupported file extension: ."), T.extension("path")).alias("error"))


def run_of_files(spark: SparkSession, d: str) -> DataFrame:
    """What chunk_files makes of the structured texts as files, a tenth of which are of a type that it cannot read."""
    files = paths(spark, d).withColumn("content", F.encode(structure(), "UTF-8")).select(
        "path", T.filename("path").alias("file_name"), F.length("content").cast("long").alias("file_size"), F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("modified_at"),
        F.when(T.doc_type("path").isNotNull(), F.lit("txt")).alias("doc_type"), "content", F.lit(None).cast("string").alias("error"),
    )
    return chunk_files(files)


@query(f"WITH RECURSIVE {_CHUNKS} SELECT (SELECT count(*) FROM documents) AS files, (SELECT count(*) FROM documents WHERE NOT ({_KNOWN})) AS failed, count(*) AS chunks FROM chunk WHERE key % 10 <> 9")
def run_counts(spark, d):
    """Files that fail are counted and do not stop the rest."""
    return run_summary(run_of_files(spark, d))


@query(f"SELECT @path AS file, 'ValueError: Unsupported document type: None' AS error FROM documents WHERE NOT ({_KNOWN})")
def failed_files(spark, d):
    return run_of_files(spark, d).where("error is not null").select(F.col("source_path").alias("file"), "error")

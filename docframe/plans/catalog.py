"""Registered queries of the document engine and their DuckDB oracles.

The driver's tables hold no word-processor packages, so an operator is bound to the columns that have its
shape: lines of documents are paragraphs, conversations are questions and answers, events are an ordered
stream of formatted runs, labels are enrichment. Markers are parameters; each binding stands in the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docframe.functions import tex, text
from docframe.operators import blocks as B
from docframe.operators import quality
from docframe.operators import questions as Q
from docframe.operators import structure as S
from docframe.plans import config, crop
from docframe.plans.registry import ORACLE_SQL, QUERIES, query, table

__all__ = ["ORACLE_SQL", "QUERIES"]

def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.lines(table(spark, sf_dir, "documents"))


def _size(c: str | Column) -> Column:
    return F.length(c).cast("long")


# Bindings to the driver's tables, the same in SQL below.
LINES = """lines AS (SELECT doc_id, i - 1 AS block_idx, regexp_replace(regexp_replace(part, '^\\s+', ''), '\\s+$', '') AS text FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS part, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)),
b AS (SELECT doc_id, block_idx::BIGINT AS block_idx, text FROM lines WHERE text <> '')"""
HEADS = LINES + ", h AS (SELECT doc_id, block_idx, 1 + length(text) % 4 AS level FROM b WHERE length(text) <= 80)"
FOLD = "lower(trim(regexp_replace(replace(replace(strip_accents({0}), 'đ', 'd'), 'Đ', 'D'), '\\s+', ' ', 'g')))"
TREE = HEADS + """,
l AS (SELECT *, last_value(CASE WHEN level = 1 THEN block_idx END IGNORE NULLS) OVER w AS l1,
        last_value(CASE WHEN level = 2 THEN block_idx END IGNORE NULLS) OVER w AS l2,
        last_value(CASE WHEN level = 3 THEN block_idx END IGNORE NULLS) OVER w AS l3
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT doc_id, block_idx, level, CASE level WHEN 2 THEN l1 WHEN 3 THEN greatest(l1, l2) WHEN 4 THEN greatest(l1, l2, l3) END AS parent_idx FROM l),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, parent_idx ORDER BY block_idx) AS ord FROM t)"""
NUMBERED = """(SELECT doc_id, block_idx, text, CASE
  WHEN regexp_matches(text, '^X{0,2}(?:IX|IV|V?I{0,3})\\s*[.)\\-–:]\\s+') AND regexp_extract(text, '^(X{0,2}(?:IX|IV|V?I{0,3}))\\s*[.)\\-–:]\\s+', 1) <> '' THEN 'roman'
  WHEN regexp_matches(text, '^[0-9]{1,2}\\s*[.)\\-–:]\\s+') THEN 'arabic' WHEN regexp_matches(text, '^[A-Z]\\s*[.)\\-–:]\\s+') THEN 'alpha_upper'
  WHEN regexp_matches(text, '^[a-z]\\s*[.)]\\s+') THEN 'alpha_lower' WHEN regexp_matches(text, '^[*+❖]') THEN 'star'
  WHEN regexp_matches(text, '^[—•]\\s+') THEN 'dash' END AS kind FROM b)"""
KIND_SQL = "CASE " + " ".join(f"WHEN starts_with(f, '{p}') THEN '{k}'" for p, k in config.TITLE_KINDS) + " ELSE 'concept' END"


# ---- text ----------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5({FOLD.format('text')}) AS folded_md5 FROM documents")
def fold_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(text.fold(F.col("text")).cast("binary")).alias("folded_md5"))


@query(f"""WITH s AS (SELECT doc_id, regexp_replace(substr(regexp_replace(regexp_replace({FOLD.format('text')}, '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g'), 1, 48), '-+$', '') AS slug FROM documents),
  n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY doc_id) AS rn FROM s) SELECT doc_id, slug, rn = 1 AS is_first FROM n""")
def slug_doc_id(spark, sf_dir):
    named = table(spark, sf_dir, "documents").select("doc_id", text.slug(F.col("text")).alias("slug"))
    return S.dedup_first(named, ["slug"], "doc_id")


@query("""SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, nullif(regexp_extract(url, '([0-9]{1,4})[^0-9]*$', 1), '')::BIGINT AS number,
  CASE WHEN contains(url, 'blog') THEN 'BLOG' WHEN contains(url, 'news') THEN 'NEWS' WHEN contains(url, 'org') THEN 'ORG' ELSE 'UNK' END AS code FROM pages""")
def url_meta(spark, sf_dir):
    url = F.col("url")
    number = F.regexp_extract(url, "([0-9]{1,4})[^0-9]*$", 1)
    code = F.when(url.contains("blog"), "BLOG").when(url.contains("news"), "NEWS").when(url.contains("org"), "ORG").otherwise("UNK")
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, "^[a-z]+://([^/]+)", 1).alias("host"), F.when(number != "", number).cast("long").alias("number"), code.alias("code"))


@query("SELECT page_id, substr(trim(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 800) AS plain FROM pages")
def strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html(F.col("html")).alias("plain"))


@query("""SELECT page_id, md5(nfc_normalize(replace(replace(regexp_replace(regexp_replace(regexp_replace(html, '</em>(\\s*)<em>', '\\1', 'g'), '</strong>(\\s*)<strong>', '\\1', 'g'),
  '<li>\\s*[-–—•]\\s*', '<li>', 'g'), '<blockquote>', ''), '</blockquote>', ''))) AS cleaned_md5 FROM pages""")
def html_cleanup(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.nfc(text.html_cleanup(F.col("html"))).cast("binary")).alias("cleaned_md5"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) AS escaped_md5 FROM pages")
def html_escape(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(text.html_escape(F.col("html")).cast("binary")).alias("escaped_md5"))


@query("SELECT doc_id, CASE WHEN octet_length(encode(text)) > 0 THEN '<img src=\"data:text/plain;base64,' || base64(encode(text)) || '\">' ELSE '' END AS img FROM documents")
def data_uri(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.data_uri(F.coalesce("text", F.lit("")).cast("binary"), F.lit("text/plain")).alias("img"))


# ---- blocks and structure ------------------------------------------------------------------------------------


@query(f"WITH {LINES} SELECT * FROM b")
def lines_as_blocks(spark, sf_dir):
    return _lines(spark, sf_dir)


@query(f"WITH {LINES} SELECT doc_id, block_idx, kind FROM {NUMBERED} WHERE kind IS NOT NULL")
def numbering_class(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "block_idx", B.numbering(F.col("text"))["kind"].alias("kind")).where("kind IS NOT NULL")


@query(f"""WITH {LINES}, n AS (SELECT *, length(text) <= 60 AS bold FROM {NUMBERED}) SELECT doc_id, block_idx, length(text) BETWEEN 1 AND 140 AND CASE
  WHEN kind IN ('roman', 'arabic', 'alpha_upper') AND (bold OR length(text) <= 100) THEN TRUE WHEN kind IN ('alpha_lower', 'dash', 'star') THEN FALSE
  ELSE bold AND ((text = upper(text) AND text <> lower(text)) OR {FOLD.format('text')} IN ({", ".join(f"'{t}'" for t in config.BOLD_TITLES)})
       OR (length(text) <= 80 AND ends_with(text, ':') AND NOT regexp_matches(text, '^\\([0-9]+\\)'))) END AS is_heading FROM n""")
def heading_flag(spark, sf_dir):
    bold = F.length("text") <= 60
    return _lines(spark, sf_dir).select("doc_id", "block_idx", B.heading(F.col("text"), bold, F.lit("")).alias("is_heading"))


@query(f"WITH {LINES}, f AS (SELECT doc_id, block_idx, {FOLD.format('text')} AS f FROM b) SELECT doc_id, block_idx, {KIND_SQL} AS kind FROM f")
def kind_hint(spark, sf_dir):
    return _lines(spark, sf_dir).select("doc_id", "block_idx", B.title_kind(F.col("text")).alias("kind"))


def _bounds(spark, sf_dir):
    size = F.length("text")
    rows = _every(spark, sf_dir, S.bounds(_lines(spark, sf_dir), size <= 40, size.between(41, 80))).fillna(0, ["n_starts"])
    return rows.withColumn("flags", F.coalesce("flags", F.lit("THEORY_START_NOT_FOUND")))


def _every(spark, sf_dir, rows):
    """rows (one a document that has lines) and a row for every other doc_id, without values."""
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id")).distinct()
    return ids.join(rows, F.col("_id").eqNullSafe(F.col("doc_id")), "left").drop("doc_id").withColumnRenamed("_id", "doc_id")


BOUNDS = LINES + """, s AS (SELECT doc_id, min(block_idx) FILTER (length(text) <= 40) AS first FROM b GROUP BY doc_id),
e AS (SELECT b.doc_id, min(block_idx) AS last FROM b JOIN s USING (doc_id) WHERE length(text) BETWEEN 41 AND 80 AND block_idx > first GROUP BY b.doc_id),
lim AS (SELECT d.doc_id, any_value(first) AS first, any_value(last) AS last, count(*) FILTER (length(b.text) <= 40 AND (last IS NULL OR block_idx < last)) AS n_starts
        FROM documents d LEFT JOIN b USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN e USING (doc_id) GROUP BY d.doc_id)"""


@query(f"""WITH {BOUNDS} SELECT doc_id, first, last, n_starts, concat_ws(',', CASE WHEN first IS NULL THEN 'THEORY_START_NOT_FOUND' END,
  CASE WHEN n_starts > 1 THEN 'MULTIPLE_THEORY_HEADERS:' || n_starts END, CASE WHEN first IS NOT NULL AND last IS NULL THEN 'THEORY_END_NOT_FOUND' END) AS flags FROM lim""")
def theory_bounds(spark, sf_dir):
    return _bounds(spark, sf_dir)


@query(f"WITH {BOUNDS} SELECT b.* FROM b JOIN lim USING (doc_id) WHERE block_idx > first AND (last IS NULL OR block_idx < last)")
def theory_slice(spark, sf_dir):
    size = F.length("text")
    return S.sliced(_lines(spark, sf_dir), size <= 40, size.between(41, 80), "theory")


@query(f"WITH {BOUNDS} SELECT b.* FROM b JOIN lim USING (doc_id) WHERE block_idx > last")
def exercise_slice(spark, sf_dir):
    size = F.length("text")
    return S.sliced(_lines(spark, sf_dir), size <= 40, size.between(41, 80), "exercise")


@query(f"""WITH {LINES}, k AS (SELECT DISTINCT doc_id, ['alpha_upper', 'roman', 'arabic', 'alpha_lower', 'star', 'dash'][1 + length(text) % 6] AS kind, 1 + length(text) % 6 AS r FROM b)
  SELECT doc_id, kind, dense_rank() OVER (PARTITION BY doc_id ORDER BY r) AS level FROM k""")
def level_ladder(spark, sf_dir):
    kind = F.element_at(F.array(*[F.lit(k) for k in config.LADDER]), (F.length("text") % 6 + 1).cast("int"))
    return S.ladder(_lines(spark, sf_dir), kind)


def _headings(spark, sf_dir):
    return _lines(spark, sf_dir).where(F.length("text") <= 80).select("doc_id", "block_idx", (_size("text") % 4 + 1).alias("level"))


@query(f"WITH {TREE} SELECT doc_id, block_idx, level, parent_idx, ord FROM o")
def section_tree(spark, sf_dir):
    return S.tree(_headings(spark, sf_dir)).select("doc_id", "block_idx", "level", "parent_idx", "ord")


@query(f"""WITH RECURSIVE {TREE}, p AS (SELECT doc_id, block_idx, ord::VARCHAR AS path FROM o WHERE parent_idx IS NULL
  UNION ALL SELECT o.doc_id, o.block_idx, p.path || '.' || o.ord FROM o JOIN p ON o.doc_id = p.doc_id AND o.parent_idx = p.block_idx) SELECT * FROM p""")
def section_paths(spark, sf_dir):
    return S.tree(_headings(spark, sf_dir)).select("doc_id", "block_idx", "path")


@query(f"""WITH {LINES} SELECT doc_id, block_idx, last_value(CASE WHEN length(text) <= 80 THEN block_idx END IGNORE NULLS) OVER
  (PARTITION BY doc_id ORDER BY block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS owner_idx FROM b""")
def block_owner(spark, sf_dir):
    return S.owner(_lines(spark, sf_dir), F.length("text") <= 80).select("doc_id", "block_idx", "owner_idx")


@query("""WITH d AS (SELECT doc_id, text, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS parts FROM documents),
  n AS (SELECT *, len(list_filter(parts, lambda x: length(x) <= 80)) >= 2 AS apart FROM d),
  u AS (SELECT doc_id, CASE WHEN apart THEN parts ELSE [text] END AS parts FROM n)
  SELECT doc_id, 0::BIGINT AS block_idx, i - 1 AS part, md5(x) AS text_md5 FROM (SELECT doc_id, unnest(parts) AS x, generate_subscripts(parts, 1) AS i FROM u)""")
def soft_break_split(spark, sf_dir):
    whole = table(spark, sf_dir, "documents").select("doc_id", F.lit(0).cast("long").alias("block_idx"), "text")
    split = S.split_soft_breaks(whole, lambda x: F.length(x) <= 80)
    return split.select("doc_id", "block_idx", "part", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@query(f"""WITH {LINES}, k AS (SELECT *, length(text) <= 120 AS bullet FROM b), c AS (SELECT *, coalesce(bullet <> lag(bullet) OVER w, TRUE) AS new FROM k WINDOW w AS (PARTITION BY doc_id ORDER BY block_idx)),
  r AS (SELECT *, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY block_idx) AS run FROM c)
  SELECT doc_id, run::BIGINT AS run, bool_and(bullet) AS bullet, count(*) AS items, md5(string_agg('<li>' || text || '</li>', '' ORDER BY block_idx)) AS html_md5 FROM r GROUP BY doc_id, run""")
def bullet_runs(spark, sf_dir):
    runs = S.runs_of(_lines(spark, sf_dir).withColumn("bullet", F.length("text") <= 120), F.col("bullet"), "run", "doc_id", "block_idx")
    items = F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "text"))), lambda x: F.concat(F.lit("<li>"), x["text"], F.lit("</li>")))
    return runs.groupBy("doc_id", "run").agg(F.bool_and("bullet").alias("bullet"), F.count("*").alias("items"), F.md5(F.array_join(items, "").cast("binary")).alias("html_md5"))


@query("""WITH c AS (SELECT *, coalesce(event_type <> lag(event_type) OVER w, TRUE) AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  r AS (SELECT *, sum(new::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM c)
  SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, string_agg(event_id::VARCHAR, '' ORDER BY ts, event_id) AS merged FROM r GROUP BY user_id, run""")
def run_merge(spark, sf_dir):
    runs = S.runs_of(table(spark, sf_dir, "events"), F.col("event_type"), "run", "user_id", "ts", "event_id")
    merged = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ts", "event_id"))), lambda x: x["event_id"].cast("string")), "")
    return runs.groupBy("user_id", "run").agg(F.max("event_type").alias("event_type"), merged.alias("merged"))


@query("""WITH l AS (SELECT conv_id, turn, role, text, lag(role) OVER w AS before, lag(text) OVER w AS said FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  SELECT conv_id, turn, (CASE WHEN before IS NOT NULL AND (role <> 'user' OR before <> 'user') AND (regexp_matches(text, '^[A-Za-z0-9]') OR regexp_matches(said, '[A-Za-z0-9]$')) THEN ' ' ELSE '' END) || text AS spaced FROM l""")
def gap_insert(spark, sf_dir):
    w = Window.partitionBy("conv_id").orderBy("turn")
    rows = table(spark, sf_dir, "conversations").select("*", F.lag("role").over(w).alias("_r"), F.lag("text").over(w).alias("_t"))
    edge = F.col("text").rlike("^[A-Za-z0-9]") | F.col("_t").rlike("[A-Za-z0-9]$")
    gap = F.col("_r").isNotNull() & ((F.col("role") != "user") | (F.col("_r") != "user")) & edge
    return rows.select("conv_id", "turn", F.concat(F.when(gap, " ").otherwise(""), "text").alias("spaced"))


# ---- questions -----------------------------------------------------------------------------------------------

SEGMENTS = """g AS (SELECT *, role = 'system' AS lvl, role = 'user' AS q FROM conversations),
  n AS (SELECT *, sum((lvl OR q)::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS seg FROM g),
  k AS (SELECT *, bool_or(q) OVER w AS named, bool_or(length(text) > 30) OVER w AS looks FROM n WINDOW w AS (PARTITION BY conv_id, seg)),
  s AS (SELECT conv_id, turn, text, role, seg::BIGINT AS seg, dense_rank() OVER (PARTITION BY conv_id ORDER BY seg) AS q_order FROM k WHERE NOT lvl AND (named OR looks))"""


def _segments(spark, sf_dir):
    return Q.segments(table(spark, sf_dir, "conversations"), F.col("role") == "system", F.col("role") == "user", F.length("text") > 30, "conv_id", "turn")


@query(f"WITH {SEGMENTS} SELECT conv_id, turn, seg, q_order FROM s")
def question_segments(spark, sf_dir):
    return _segments(spark, sf_dir).select("conv_id", "turn", "seg", "q_order")


@query(f"""WITH {SEGMENTS} SELECT conv_id, q_order, substr(md5(conv_id || '_' || q_order), 1, 24) AS record_id, count(*) AS n_parts,
  md5(string_agg(text, chr(10) ORDER BY turn)) AS content_md5 FROM s GROUP BY conv_id, q_order""")
def question_records(spark, sf_dir):
    content = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n")
    grouped = _segments(spark, sf_dir).groupBy("conv_id", "q_order").agg(F.count("*").alias("n_parts"), F.md5(content.cast("binary")).alias("content_md5"))
    return grouped.select("conv_id", "q_order", Q.record_id(F.col("conv_id").cast("string"), F.col("q_order")).alias("record_id"), "n_parts", "content_md5")


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS) OVER
  (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level FROM events""")
def level_asof(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")
    return S.as_of(rows, F.when(F.col("event_type") == "signup", F.col("value")), "level", "user_id", "ts", "event_id").select("event_id", "user_id", "level")


LETTER = "CASE event_type WHEN 'click' THEN 'A' WHEN 'view' THEN NULL WHEN 'purchase' THEN 'B' WHEN 'signup' THEN 'C' ELSE 'D' END"


@query(f"""WITH m AS (SELECT *, {LETTER} AS l FROM events), n AS (SELECT *, sum((l IS NOT NULL)::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS choice,
    first_value(l IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first FROM m)
  SELECT event_id, user_id, choice::BIGINT AS choice, CASE WHEN choice = 0 AND first <> 'A' THEN 'A' ELSE max(l) OVER (PARTITION BY user_id, choice) END AS letter,
    coalesce(choice = 0 AND first <> 'A', FALSE) AS inferred FROM n""")
def choice_split(spark, sf_dir):
    rows = table(spark, sf_dir, "events")
    return Q.choices(rows, F.expr(LETTER), "user_id", "ts", "event_id").select("event_id", "user_id", "choice", "letter", "inferred")


@query("""WITH c AS (SELECT l_orderkey, l_returnflag, count(*) AS n, max(l_linenumber) AS label FROM lineitem GROUP BY ALL)
  SELECT l_orderkey, max(label) FILTER (n = 1) AS odd FROM c GROUP BY l_orderkey HAVING count(*) = 2 AND count(*) FILTER (n = 1) = 1""")
def odd_color(spark, sf_dir):
    return Q.odd_one_out(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag", "l_linenumber")


@query("SELECT l_orderkey, max(l_linenumber) FILTER (l_linestatus = 'F') AS marked FROM lineitem GROUP BY l_orderkey HAVING count(*) FILTER (l_linestatus = 'F') = 1")
def unique_underline(spark, sf_dir):
    return Q.only_marked(table(spark, sf_dir, "lineitem"), "l_orderkey", F.col("l_linestatus") == "F", "l_linenumber")


@query("""WITH f AS (SELECT conv_id, turn, chr(65 + (length(text) % 4)::INT) AS l, length(text) % 3 AS k, length(text) % 5 AS j, length(text) % 7 > 0 AS has FROM conversations),
  c AS (SELECT conv_id, turn, CASE WHEN k = 0 THEN l END AS t, CASE WHEN j = 0 THEN l END AS u, CASE WHEN j = 1 THEN l END AS o, has FROM f)
  SELECT conv_id, turn, coalesce(t, u, o) AS letter, (ascii(coalesce(t, u, o)) - 64)::BIGINT AS choice_id, CASE WHEN t IS NOT NULL THEN 'text:đáp_án' WHEN u IS NOT NULL THEN 'format:underline'
    WHEN o IS NOT NULL THEN 'format:color' WHEN NOT has THEN 'essay_no_answer_letter' ELSE 'none' END AS source FROM c""")
def answer_resolution(spark, sf_dir):
    n = F.length("text")
    letter = F.char(65 + n % 4)
    got = Q.resolve(F.when(n % 3 == 0, letter), F.lit("text:đáp_án"), F.when(n % 5 == 0, letter), F.when(n % 5 == 1, letter), n % 7 > 0)
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", got.alias("_a"))
    return rows.select("conv_id", "turn", F.col("_a.letter").alias("letter"), Q.choice_id(F.col("_a.letter")).cast("long").alias("choice_id"), F.col("_a.source").alias("source"))


@query("""SELECT doc_id, CASE WHEN n >= 2 AND g THEN 'true-false-group' WHEN n = 0 AND gap THEN 'fill-answer' WHEN n = 0 THEN 'essay' WHEN a > 1 THEN 'multiple-choice' ELSE 'single-choice' END AS type
  FROM (SELECT doc_id, n_chars % 5 AS n, n_chars % 3 = 0 AS g, contains(text, '###') AS gap, n_chars % 4 AS a FROM documents)""")
def question_type(spark, sf_dir):
    n = F.col("n_chars")
    kind = Q.question_type(n % 5, (n % 5 >= 2) & (n % 3 == 0), F.col("text").contains("###"), n % 4)
    return table(spark, sf_dir, "documents").select("doc_id", kind.alias("type"))


# ---- assets, joins, lookups ----------------------------------------------------------------------------------


@query(f"""WITH {LINES}, f AS (SELECT doc_id, sha256(text) AS sha, min(block_idx) AS first_idx, count(*) AS uses FROM b GROUP BY ALL)
  SELECT doc_id, sha, first_idx, uses, 'f' || row_number() OVER (PARTITION BY doc_id ORDER BY first_idx) AS aid FROM f""")
def asset_registry(spark, sf_dir):
    """The distinct parts of each document, numbered by first use."""
    seen = _lines(spark, sf_dir).groupBy("doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("sha")).agg(F.min("block_idx").alias("first_idx"), F.count("*").alias("uses"))
    return seen.withColumn("aid", F.concat(F.lit("f"), F.row_number().over(Window.partitionBy("doc_id").orderBy("first_idx"))))


@query("SELECT doc_id, n_chars, quality::BIGINT AS quality, CASE WHEN quality IS NULL THEN '' ELSE 'q' || quality END AS rendered FROM documents LEFT JOIN labels USING (doc_id)")
def inline_asset_join(spark, sf_dir):
    met = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return met.select("doc_id", "n_chars", F.col("quality").cast("long").alias("quality"), F.coalesce(F.concat(F.lit("q"), F.col("quality")), F.lit("")).alias("rendered"))


@query("""SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'BRASS' WHEN contains(lower(p_type), 'steel') THEN 'STEEL' WHEN contains(lower(p_type), 'tin') THEN 'TIN' ELSE 'UNK' END AS code FROM part""")
def subject_lookup(spark, sf_dir):
    """First key, in order, that the text holds."""
    folded = text.fold(F.col("p_type"))
    code = F.coalesce(*[F.when(folded.contains(k), F.lit(k.upper())) for k in ("brass", "steel", "tin")], F.lit("UNK"))
    return table(spark, sf_dir, "part").select("p_partkey", code.alias("code"))


@query("""WITH r AS (SELECT doc_id, ['tex', 'omml', 'mtef', 'mtef_partial', 'unresolved'][1 + (doc_id % 5)::INT] AS source, quality FROM labels)
  SELECT doc_id, source, CASE WHEN source IN ('tex', 'omml') THEN 1.0 WHEN source = 'mtef' THEN CASE WHEN quality = 0 THEN 0.98 ELSE 0.93 END
    WHEN source = 'mtef_partial' THEN CASE WHEN quality = 0 THEN 0.78 ELSE 0.73 END ELSE 0.0 END::DOUBLE AS confidence FROM r""")
def confidence(spark, sf_dir):
    source = F.element_at(F.array(*[F.lit(s) for s in ("tex", "omml", "mtef", "mtef_partial", "unresolved")]), (F.col("doc_id") % 5 + 1).cast("int"))
    selectors = F.when(F.col("quality") == 0, F.array().cast("array<int>")).otherwise(F.array(F.lit(11)))
    return table(spark, sf_dir, "labels").select("doc_id", source.alias("source"), F.round(tex.confidence(source, selectors), 6).alias("confidence"))


# ---- quality -------------------------------------------------------------------------------------------------

STATS = LINES + """, st AS (SELECT d.doc_id, count(b.text) AS blocks, count(*) FILTER (length(b.text) <= 80) AS sections, coalesce(sum(len(regexp_extract_all(b.text, '[^ \\t\\r\\f\\v]+'))), 0)::BIGINT AS words,
  count(*) FILTER (contains(b.text, '|')) AS tables, count(*) FILTER (length(b.text) <= 40) AS n_starts FROM documents d LEFT JOIN b USING (doc_id) GROUP BY d.doc_id)"""


def _stats(spark, sf_dir):
    size = F.length("text")
    found = _lines(spark, sf_dir).groupBy("doc_id").agg(
        F.count("*").alias("blocks"), F.count_if(size <= 80).alias("sections"), F.sum(F.regexp_count("text", F.lit(r"[^ \t\r\f\x0B]+"))).cast("long").alias("words"),
        F.count_if(F.col("text").contains("|")).alias("tables"), F.count_if(size <= 40).alias("n_starts"),
    )
    return _every(spark, sf_dir, found).fillna(0, ["blocks", "sections", "words", "tables", "n_starts"])


@query(f"WITH {STATS} SELECT * FROM st")
def doc_stats(spark, sf_dir):
    return _stats(spark, sf_dir)


GATES = STATS + """, g AS (SELECT doc_id, words < 50 AND tables < 2 AS f1, 1.0 - 0.05 * least(tables, 10) AS share, sections = 0 AS f4, words < 150 AS w1, n_starts <> 1 AS w4 FROM st),
  q AS (SELECT doc_id, concat_ws(',', CASE WHEN f1 THEN 'FEW_WORDS' END, CASE WHEN share < 0.7 THEN 'FORMULAS_UNRESOLVED' END, CASE WHEN f4 THEN 'NO_SECTIONS' END,
    CASE WHEN w1 THEN 'SHORT' END, CASE WHEN share < 0.9 THEN 'SOME_UNRESOLVED' END, CASE WHEN w4 THEN 'MARKERS' END) AS flags,
    CASE WHEN f1 OR share < 0.7 OR f4 THEN 'FAIL' WHEN w1 OR share < 0.9 OR w4 THEN 'WARN' ELSE 'PASS' END AS status FROM g)"""


def _gates(stats):
    few = F.least(F.col("tables"), F.lit(10))
    stats = stats.withColumn("figures", F.col("tables")).withColumn("formulas", F.lit(20)).withColumn("resolved", 20 - few)
    return quality.gates(stats.withColumn("coverage", F.lit(1.0)).withColumn("inline_bytes", F.lit(0)))


@query(f"WITH {GATES} SELECT * FROM q")
def qa_gates(spark, sf_dir):
    return _gates(_stats(spark, sf_dir)).select("doc_id", "flags", "status")


@query(f"WITH {GATES} SELECT lang, status, count(*) AS docs FROM q JOIN documents d ON q.doc_id IS NOT DISTINCT FROM d.doc_id GROUP BY ROLLUP (lang, status)")
def qa_rollup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("_id"), "lang")
    met = docs.join(_gates(_stats(spark, sf_dir)), F.col("_id").eqNullSafe(F.col("doc_id")))
    return met.rollup("lang", "status").agg(F.count("*").alias("docs"))


@query("SELECT doc_id, source || '-' || lang AS name, row_number() OVER (PARTITION BY source, lang ORDER BY doc_id) = 1 AS is_first FROM documents")
def collision_guard(spark, sf_dir):
    named = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("-", "source", "lang").alias("name"))
    return S.dedup_first(named, ["name"], "doc_id")


@query("SELECT event_type AS source, count(*) AS n, count(DISTINCT user_id) AS docs FROM events GROUP BY event_type")
def source_histogram(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("docs"))


@query("""SELECT sum((len(html) - len(replace(html, '<', ''))) - (len(html) - len(replace(html, '>', ''))))::BIGINT AS imbalance, count(*) FILTER (contains(html, '&')) AS with_entities,
  sum(len(regexp_extract_all(html, '<b>')) - len(regexp_extract_all(html, '</b>')))::BIGINT AS unclosed_bold FROM pages""")
def artifact_counts(spark, sf_dir):
    def n(pattern: str) -> Column:
        return F.regexp_count("html", F.lit(pattern)).cast("long")

    return table(spark, sf_dir, "pages").agg(F.sum(n("<") - n(">")).alias("imbalance"), F.count_if(F.col("html").contains("&")).alias("with_entities"), F.sum(n("<b>") - n("</b>")).alias("unclosed_bold"))


@query("SELECT count(*) AS events, count(*) FILTER (event_type = 'error') AS errors, round(quantile_cont(value, 0.95), 6) AS p95 FROM events")
def run_metrics(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    p95 = quality.quantile(events, "value", 0.95)
    return events.agg(F.count("*").alias("events"), F.count_if(F.col("event_type") == "error").alias("errors")).withColumn("p95", F.round(F.lit(p95).cast("double"), 6))


TRUTH = """WITH k AS (SELECT item_id, text AS gt, CASE item_id % 4 WHEN 0 THEN text WHEN 1 THEN '\\left ' || replace(text, ' ', '  ') WHEN 2 THEN replace(text, 'the', '{the}') ELSE text || '\\neq x' END AS given FROM benchmark),
  m AS (SELECT *, regexp_replace(replace(replace(gt, '\\left', ''), '\\neq', '\\ne'), '[\\s{}]', '', 'g') AS a, regexp_replace(replace(replace(given, '\\left', ''), '\\neq', '\\ne'), '[\\s{}]', '', 'g') AS b FROM k)"""


def _truth(spark, sf_dir):
    """The benchmark's items as the truth, and other spellings of them as what was found."""
    t, turn = F.col("text"), F.col("item_id") % 4
    given = F.when(turn == 0, t).when(turn == 1, F.concat(F.lit("\\left "), F.replace(t, F.lit(" "), F.lit("  ")))).when(turn == 2, F.replace(t, F.lit("the"), F.lit("{the}"))).otherwise(F.concat(t, F.lit("\\neq x")))
    return table(spark, sf_dir, "benchmark").select(F.lit("benchmark").alias("file"), F.col("item_id").alias("rid"), t.alias("gt_tex"), given.alias("latex"))


@query(TRUTH + """ SELECT count(*) AS total, count(gt) AS with_truth, count(*) FILTER (gt = given) AS exact, count(*) FILTER (a = b) AS normalized,
  round(100.0 * count(*) FILTER (a = b) / count(gt), 3)::DOUBLE AS accuracy FROM m""")
def groundtruth_eval(spark, sf_dir):
    return quality.evaluate(_truth(spark, sf_dir))


@query(TRUTH + " SELECT item_id AS rid, md5(given) AS given_md5 FROM m WHERE a <> b ORDER BY item_id LIMIT 30")
def groundtruth_mismatches(spark, sf_dir):
    """The first 30 mismatches: a report, the limit is the feature."""
    return quality.mismatches(_truth(spark, sf_dir)).select("rid", F.md5(F.col("latex").cast("binary")).alias("given_md5"))


@query("""SELECT d.doc_id, md5(text) AS content_hash FROM documents d WHERE NOT EXISTS (SELECT 1 FROM documents o WHERE o.doc_id % 2 = 0 AND o.doc_id = d.doc_id AND
  md5(CASE WHEN o.doc_id % 6 = 0 THEN o.text || '!' ELSE o.text END) = md5(d.text))""")
def upsert_anti(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    now = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("content_hash"))
    changed = F.when(F.col("doc_id") % 6 == 0, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    return quality.undelivered(now, docs.where("doc_id % 2 = 0").select("doc_id", F.md5(changed.cast("binary")).alias("content_hash")))


# ---- inputs, labels, the other cropping mode -----------------------------------------------------------------


@query("SELECT doc_id AS id, 'documents' AS kind FROM documents UNION ALL SELECT page_id, 'pages' FROM pages")
def union_inputs(spark, sf_dir):
    left = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("kind"))
    return left.unionByName(table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.lit("pages").alias("kind")))


@query("SELECT DISTINCT source, lang FROM documents")
def distinct_sorted(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("source", "lang").distinct().orderBy("source", "lang")


@query("SELECT page_id, url FROM pages ORDER BY url, page_id LIMIT 20")
def limit_inputs(spark, sf_dir):
    """The first 20 inputs by path: the limit is the feature."""
    return table(spark, sf_dir, "pages").select("page_id", "url").orderBy("url", "page_id").limit(20)


@query(f"WITH {LINES} SELECT doc_id, string_agg(text, ' / ' ORDER BY block_idx) AS head FROM b WHERE block_idx < 6 GROUP BY doc_id")
def head_blocks(spark, sf_dir):
    head = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block_idx", "text"))), lambda x: x["text"]), " / ")
    return _lines(spark, sf_dir).where("block_idx < 6").groupBy("doc_id").agg(head.alias("head"))


PLAIN = "substr(trim(regexp_replace(regexp_replace({0}, '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')), 1, 800)"


@query(f"""WITH t AS (SELECT conv_id, min_by(text, turn) AS q, list(text ORDER BY turn) AS c FROM conversations GROUP BY conv_id)
  SELECT conv_id, 'Cau hoi:' || chr(10) || {PLAIN.format('q')} || chr(10) || chr(10) || 'Lua chon:' || chr(10) ||
    array_to_string(list_transform(c, lambda x, i: chr((64 + i)::INT) || '. ' || {PLAIN.format('x')}), chr(10)) || chr(10) || chr(10) || 'Phan loai muc do nhan thuc:' AS prompt FROM t""")
def label_prompt(spark, sf_dir):
    """Whole turns; of each the prompt has the first 800 characters without tags, which is the operator's own limit."""
    options = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.min_by("text", "turn").alias("_q"), options.alias("_c"))
    return grouped.select("conv_id", Q.prompt(F.col("_q"), F.col("_c")).alias("prompt"))


REPLIES = "['van_dung_cao', 'Van dung', ' thong_hieu.', 'NHAN_BIET', 'knowledge', 'unknown', 'application'][1 + (doc_id % 7)::INT]"
LEVELS = "[4, 3, 2, 1, 1, NULL, 3][1 + (doc_id % 7)::INT]"


def _replies(spark, sf_dir):
    said = [F.lit(x) for x in ("van_dung_cao", "Van dung", " thong_hieu.", "NHAN_BIET", "knowledge", "unknown", "application")]
    return table(spark, sf_dir, "labels").withColumn("_raw", F.element_at(F.array(*said), (F.col("doc_id") % 7 + 1).cast("int")))


@query(f"SELECT doc_id, {LEVELS}::BIGINT AS level, ['application_high', 'application', 'comprehension', 'knowledge', 'knowledge', NULL, 'application'][1 + (doc_id % 7)::INT] AS name FROM labels")
def label_parse(spark, sf_dir):
    return _replies(spark, sf_dir).withColumn("_p", Q.parse_label(F.col("_raw"))).select("doc_id", F.col("_p.number").cast("long").alias("level"), F.col("_p.name").alias("name"))


@query(f"SELECT doc_id, coalesce({LEVELS}, quality)::BIGINT AS level FROM labels")
def label_fallback(spark, sf_dir):
    return _replies(spark, sf_dir).select("doc_id", F.coalesce(Q.parse_label(F.col("_raw"))["number"], F.col("quality")).cast("long").alias("level"))


OTHER = LINES + """, o AS (SELECT doc_id, block_idx, CASE block_idx % 12 WHEN 1 THEN 'Lý thuyết ' || block_idx WHEN 9 THEN 'B. BÀI TẬP' WHEN 3 THEN '- ' || text WHEN 4 THEN '1. ' || text WHEN 5 THEN 'b) ' || text
    WHEN 6 THEN 'Hoạt động 2' WHEN 7 THEN '* Bố cục ' || text || ':' WHEN 8 THEN 'IV. ' || text WHEN 2 THEN 'Ghi nhớ' ELSE text END AS text FROM b),
  f AS (SELECT *, """ + FOLD.format("text") + """ AS f FROM o)"""
TAG = """CASE WHEN octet_length(encode(f)) NOT BETWEEN 1 AND 250 THEN 'P' WHEN regexp_matches(text, '^\\s*(?:[IVX]+|[A-Z])\\s*[.\\-–:]') OR regexp_matches(f, 'tong ket|ghi nho|doc van ban|kham pha van ban|ly thuyet') THEN 'H2'
  WHEN regexp_matches(text, '^\\s*(?:[0-9]+\\.\\s+|Hoạt động\\s+[0-9]+|Câu hỏi\\s+[0-9]+)') THEN 'H3' WHEN regexp_matches(text, '^\\s*[a-z][).]\\s+') THEN 'H4' WHEN regexp_matches(text, '^\\s*\\*.*:\\s*$') THEN 'H5' ELSE 'P' END"""


def _other(spark, sf_dir):
    """Lines of documents, some of them made into what the other mode looks for."""
    turn, line = F.col("block_idx") % 12, F.col("text")
    made = (
        F.when(turn == 1, F.concat(F.lit("Lý thuyết "), F.col("block_idx"))).when(turn == 9, "B. BÀI TẬP").when(turn == 3, F.concat(F.lit("- "), line)).when(turn == 4, F.concat(F.lit("1. "), line))
        .when(turn == 5, F.concat(F.lit("b) "), line)).when(turn == 6, "Hoạt động 2").when(turn == 7, F.concat(F.lit("* Bố cục "), line, F.lit(":"))).when(turn == 8, F.concat(F.lit("IV. "), line))
        .when(turn == 2, "Ghi nhớ").otherwise(line)
    )
    return _lines(spark, sf_dir).withColumn("text", made)


@query(f"WITH {OTHER} SELECT doc_id, block_idx, {TAG} AS tag FROM f")
def crop_relevel(spark, sf_dir):
    return _other(spark, sf_dir).select("doc_id", "block_idx", crop.relevel(F.col("text"), text.fold(F.col("text"))).alias("tag"))


@query(f"""WITH {OTHER}, m AS (SELECT *, octet_length(encode(f)) <= 100 AND regexp_matches(f, 'kien thuc trong tam|ly thuyet|phan li thuyet') AS s,
    octet_length(encode(f)) <= 100 AND regexp_matches(f, '^(?:b ?[.\\-–:] ?|phan )?bai tap|b\\. ?bai tap') AS e FROM f),
  s AS (SELECT doc_id, min(block_idx) FILTER (s) AS first FROM m GROUP BY doc_id),
  l AS (SELECT doc_id, any_value(first) AS first, min(block_idx) FILTER (e AND NOT s AND block_idx > first) AS last FROM m JOIN s USING (doc_id) GROUP BY doc_id)
  SELECT doc_id, block_idx, CASE WHEN regexp_matches(text, '^\\s*[-+*•–—]\\s+') THEN 'LI' ELSE {TAG} END AS tag,
    md5(CASE WHEN regexp_matches(text, '^\\s*[-+*•–—]\\s+') THEN trim(regexp_replace(text, '^\\s*[-+*•–—]\\s*', '')) ELSE text END) AS text_md5
  FROM m JOIN l USING (doc_id) WHERE first IS NULL OR (block_idx > first AND (last IS NULL OR block_idx < last))""")
def crop_outline(spark, sf_dir):
    return crop.outline(_other(spark, sf_dir)).select("doc_id", "block_idx", "tag", F.md5(F.col("text").cast("binary")).alias("text_md5"))

"""Queries over the given tables, one or more for each operator, and SQL that gives the same rows."""

from __future__ import annotations

import hashlib
import time
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import numbers, text
from tapeloom.operators import clean, merge, naming, splitter
from tapeloom.operators import segments as ops
from tapeloom.plans import transcripts
from tapeloom.plans.views import ABBREVIATED, SEGMENTS_SQL, segments, table, titles, with_abbreviations, with_breaks, with_continuations, with_quotes
from tapeloom.schema import Settings
from tapeloom.shipping import ship
from tapeloom.sources import adapters, containers, exact, files, listing, sinks
from tapeloom.sources.pool import Calls, Transient
from tapeloom.streaming import merge as streaming
from tapeloom.streaming import source as log
from tapeloom.work import new_dir, written

ship(__name__)

# --- SQL that several queries share ---------------------------------------------------------------

S = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
STRIP = rf"^{S}+|{S}+$"


def _t2(x: str) -> str:
    line = r"'([\p{L}\p{Nl}\p{No}_])\n([^\nA-Z]|\z)', '\1 \2', 'g'"
    return rf"regexp_replace(regexp_replace(regexp_replace({x}, '-\n([a-z])', '\1', 'g'), {line}), {line})"


def _t3(x: str) -> str:
    """List of sentences: full stops that end nothing are chr(1), ends are chr(3)."""
    tld = rf"(?:com|net|org|io){S}"
    held = rf"regexp_replace(regexp_replace(regexp_replace({_t2(x)}, '\.([0-9])', chr(1) || '\1', 'g'), '\.({tld})', chr(1) || '\1', 'g'), '\.{S}+({tld})', chr(3) || '\1', 'g')"
    ends = rf"replace(regexp_replace({held}, '\.|[!?]{S}+', chr(3), 'g'), chr(1), '.')"
    parts = f"list_transform(string_split({ends}, '\"'), lambda v, i: case when i % 2 = 0 then replace(v, chr(3), '') else v end)"
    return f"list_filter(list_transform(string_split(array_to_string({parts}, '\"'), chr(3)), lambda v: regexp_replace(v, '{STRIP}', '', 'g')), lambda v: v <> '')"


Q_SQL = "translate(text, 'mqu', '\"!?')"
L_SQL = "replace(replace(replace(text, ' e', '-' || chr(10) || 'e'), ' d', chr(10) || 'd'), ' a', chr(10))"
C_SQL = "replace(replace(text, ', ', ',' || chr(10)), ' d', chr(10) || '- d')"
TITLES_SQL = "titles as (select page_id seq, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) title, url from pages)"
SLUG_SQL = rf"lower(regexp_replace(regexp_replace(regexp_replace(title, '[^\p{{L}}\p{{N}}_\s\x0b\x1c-\x1f\x85\p{{Z}}-]', '', 'g'), '[-\s\x0b\x1c-\x1f\x85\p{{Z}}]+', '_', 'g'), '{STRIP}', '', 'g'))"
WINDOWS_SQL = """
windows as (
  select transcript_id, seq, "end" time_end, first_value(start) over w time_start, avg(avg_logprob) over w running_logprob,
    min(avg_logprob) over (partition by transcript_id) mn, max(avg_logprob) over (partition by transcript_id) mx
  from segments window w as (partition by transcript_id order by seq rows unbounded preceding))
"""
CONFIDENCE_SQL = "case when mx - mn <> 0 then (running_logprob - mn) / (mx - mn) else 0.5 end::double"
UNWANTED = "the"

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# --- text -----------------------------------------------------------------------------------------


@query(f"with {TITLES_SQL} select seq, title, {SLUG_SQL} as slug from titles")
def t1_slug(spark, sf_dir):
    return titles(spark, sf_dir).select("seq", "title", text.slug(F.col("title")).alias("slug"))


@query(f"select doc_id, regexp_replace({L_SQL}, '-\\n([a-z])', '\\1', 'g') as dehyphenated, {_t2(L_SQL)} as text from documents")
def t2_page_breaks(spark, sf_dir):
    broken = with_breaks(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.join_hyphenated(broken).alias("dehyphenated"), text.repair_breaks(broken).alias("text"))


@query(f"with s as (select conv_id, turn, {_t3('text')} s from conversations) select conv_id, turn, (generate_subscripts(s, 1) - 1)::int as pos, unnest(s) as sentence from s")
def t3_split_sentences(spark, sf_dir):
    return ops.sentences(table(spark, sf_dir, "conversations"), ["conv_id", "turn"])


@query(f"with s as (select doc_id, {_t3(Q_SQL)} s from documents) select doc_id, (generate_subscripts(s, 1) - 1)::int as pos, unnest(s) as sentence from s")
def t3_split_quoted(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_quotes(F.col("text")).alias("text"))
    return ops.sentences(docs, ["doc_id"])


@query(
    f"select doc_id, length({Q_SQL}) - length(replace({Q_SQL}, '\"', '')) as n_quotes, (length({Q_SQL}) - length(replace({Q_SQL}, '\"', ''))) % 2 = 1 as is_open, length(text) as n_code_points, "
    f"contains(text, '{UNWANTED}') as has_unwanted, starts_with(text, '- ') as starts_dash, suffix(text, ', ') as ends_comma, regexp_replace(text, '{STRIP}', '', 'g') || ' ' as emitted from documents"
)
def t5_t9_string_basics(spark, sf_dir):
    c = F.col("text")
    n = text.quotes(with_quotes(c)).cast("long")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        n.alias("n_quotes"),
        (n % 2 == 1).alias("is_open"),
        F.length(c).cast("long").alias("n_code_points"),
        F.contains(c, F.lit(UNWANTED)).alias("has_unwanted"),
        c.startswith("- ").alias("starts_dash"),
        c.endswith(", ").alias("ends_comma"),
        F.concat(text.strip(c), F.lit(" ")).alias("emitted"),
    )


# --- segments -------------------------------------------------------------------------------------


@query(f"with {SEGMENTS_SQL} select * from segments where not contains(text, '{UNWANTED}')")
def f1_filter_unwanted(spark, sf_dir):
    return ops.without_text(segments(spark, sf_dir), UNWANTED)


@query(f"with {SEGMENTS_SQL} select transcript_id, count(*) as n_before, count(*) filter (not contains(text, '{UNWANTED}')) as n_after, count(*) filter (contains(text, '{UNWANTED}')) as n_removed from segments group by 1")
def a1_removed_counts(spark, sf_dir):
    return ops.removed_counts(segments(spark, sf_dir), UNWANTED)


@query(f"with {SEGMENTS_SQL} select transcript_id, min(avg_logprob) as min_logprob, max(avg_logprob) as max_logprob from segments group by 1")
def a2_logprob_range(spark, sf_dir):
    return ops.logprob_range(segments(spark, sf_dir))


@query(f"with {SEGMENTS_SQL} select transcript_id, string_agg(text || ' ', '' order by seq) as combined_text from segments group by 1")
def a3_combined_text(spark, sf_dir):
    return ops.combined_text(segments(spark, sf_dir))


@query(f"with {SEGMENTS_SQL}, s as (select transcript_id, seq, {_t3('text')} s from segments), p as (select transcript_id, seq, generate_subscripts(s, 1) pos, unnest(s) sentence from s) select transcript_id, (row_number() over (partition by transcript_id order by seq, pos) - 1)::bigint as number, sentence from p")
def a4_sentence_list(spark, sf_dir):
    rows = ops.sentences(segments(spark, sf_dir), ["transcript_id", "seq"])
    number = F.row_number().over(Window.partitionBy("transcript_id").orderBy("seq", "pos")) - 1
    return rows.select("transcript_id", number.cast("long").alias("number"), "sentence")


@query(f"with {SEGMENTS_SQL}, {WINDOWS_SQL} select transcript_id, seq, time_start, time_end, running_logprob, {CONFIDENCE_SQL} as model_confidence_score from windows")
def a5_running_confidence(spark, sf_dir):
    return ops.with_windows(segments(spark, sf_dir)).select("transcript_id", "seq", "time_start", "time_end", "running_logprob", "model_confidence_score")


def _m1_sql(change: str) -> str:
    given = SEGMENTS_SQL.replace("from conversations", f"from (select conv_id, turn, {change} as text from conversations)")
    return f"""with recursive {given}, {WINDOWS_SQL},
r as (select transcript_id, seq, {_t3("b")} sn, b from (select transcript_id, seq, text || ' ' b from segments where seq = 0)
      union all
      select transcript_id, seq, {_t3("b")}, b from (
        select s.transcript_id, s.seq, (case when len(r.sn) = 0 then r.b when len(r.sn) % 2 = 1 then r.sn[-1] else '' end) || s.text || ' ' b
        from r join segments s on s.transcript_id = r.transcript_id and s.seq = r.seq + 1)),
e as (select transcript_id, seq, unnest(sn) sentence, (generate_subscripts(sn, 1) - 1)::int pos from r),
o as (select *, (sum(length(sentence) + 1) over (partition by transcript_id order by seq, pos rows unbounded preceding))::bigint upto from e)
select transcript_id, seq, pos, sentence, upto - length(sentence) - 1 as start_char_count, upto - 2 as end_char_count, time_start, time_end, {CONFIDENCE_SQL} as model_confidence_score
from o join windows using (transcript_id, seq)"""


@query(_m1_sql("text"))
def m1_merge_segments(spark, sf_dir):
    return merge.merge_segments(segments(spark, sf_dir))


@query(_m1_sql(Q_SQL))
def m1_merge_chunks(spark, sf_dir):
    """M1 in chunks of four segments, of texts with open quotes, which carry far."""
    rows = segments(spark, sf_dir)
    return merge.merge_segments(rows.withColumn("text", with_quotes(F.col("text"))), chunk=4)


@query(_m1_sql(Q_SQL))
def m1_merge_quoted(spark, sf_dir):
    rows = segments(spark, sf_dir)
    return merge.merge_segments(rows.withColumn("text", with_quotes(F.col("text"))))


def _streamed(spark, sf_dir, then, n: int = 3):
    """All segments through a growing table in ``n`` appends, dealt without regard to order; what ``then`` makes of the stream, after each append by a run that goes on from the last one's checkpoint."""
    path = new_dir(spark)
    rows = segments(spark, sf_dir)
    for k in range(n):
        log.append(rows.where(F.pmod(F.hash("transcript_id", "seq"), F.lit(n)) == n - 1 - k), f"{path}/log")
        out = then(log.read_stream(spark, f"{path}/log"))
        run = out.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
        run.awaitTermination()
    return spark.read.schema(out.schema).parquet(f"{path}/out")


@query(f"with {SEGMENTS_SQL} select * from segments")
def st1_segment_stream(spark, sf_dir):
    """ST1: segments as a stream that is stopped and started again; none is lost, none repeated."""
    return _streamed(spark, sf_dir, lambda stream: stream)


@query(_m1_sql("text"))
def st2_merge_stream(spark, sf_dir):
    """ST2: the merge of a stream whose segments come in any order; what it gives, normalised."""
    out = streaming.with_confidence(_streamed(spark, sf_dir, streaming.merge_stream), segments(spark, sf_dir))
    return out.select(*merge.merge_segments(segments(spark, sf_dir)).columns)


# --- reader ---------------------------------------------------------------------------------------

_CLEAN_SQL = f"""
lines as (select doc_id, unnest(string_split(c, chr(10))) line, generate_subscripts(string_split(c, chr(10)), 1) n from (select doc_id, {C_SQL} c from documents)),
marked as (select *, starts_with(line, '- ') or coalesce(suffix(lag(line) over (partition by doc_id order by n), ','), false) goes_on from lines),
cleaned as (select doc_id, string_agg(case when goes_on then regexp_replace(line, '^((?s).*?)- ', '\\1') else line end || ' ', '' order by n) text from marked group by 1)
"""


@query(f"with {_CLEAN_SQL} select * from cleaned")
def c1_clean_lines(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", clean.clean_lines(with_continuations(F.col("text"))).alias("text"))


_PARAGRAPHS_SQL = f"""
s as (select doc_id, {_t3("text")} s from documents),
one as (select doc_id, generate_subscripts(s, 1) - 1 pos, unnest(s) sentence from s),
para as (select doc_id, (pos // 5)::int para_no, '<p>' || string_agg(trim(sentence, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) || ' ', '' order by pos) || '</p>' html from one group by 1, 2)
"""


@query(f"with {_PARAGRAPHS_SQL} select * from para")
def w1_paragraphs(spark, sf_dir):
    return clean.paragraph_rows(table(spark, sf_dir, "documents"), ["doc_id"])


@query(f"with {_PARAGRAPHS_SQL}, page as (select doc_id, string_agg(html, '' order by para_no) html from para group by 1) select doc_id, html, replace(replace(html, '<p>', ''), '</p>', chr(10) || chr(10)) as download from page")
def k8_paragraph_text(spark, sf_dir):
    html = F.array_join(clean.paragraphs(text.split_sentences(F.col("text"))), "")
    return clean.downloads(table(spark, sf_dir, "documents").select("doc_id", html.alias("html")))


@query(
    f"with {_CLEAN_SQL}, s as (select doc_id, {_t3('text')} s from cleaned), one as (select doc_id, generate_subscripts(s, 1) - 1 pos, unnest(s) sentence from s), "
    "para as (select doc_id, pos // 5 n, '<p>' || string_agg(sentence || ' ', '' order by pos) || '</p>' html from one group by 1, 2), "
    "page as (select doc_id, string_agg(html, '' order by n) html from para group by 1) "
    "select doc_id, coalesce(html, '') as html, replace(replace(coalesce(html, ''), '<p>', ''), '</p>', chr(10) || chr(10)) as download from cleaned left join page using (doc_id)"
)
def e3_reader_pages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", with_continuations(F.col("text")).alias("text"))
    return transcripts.reader_pages(docs, ["doc_id"])


# --- names, files, numbers ------------------------------------------------------------------------

_NAMES_SQL = f"""with recursive {TITLES_SQL},
slugs as (select seq, row_number() over (order by seq) k, {SLUG_SQL} slug from titles),
r(k, taken, seq, slug, name) as (
  select 0::bigint, (select list(slug) from slugs where seq % 7 = 0), null::bigint, null::varchar, null::varchar
  union all
  select k, list_append(taken, name), seq, slug, name from (
    select s.k, r.taken, s.seq, s.slug,
      case when not list_contains(r.taken, s.slug) then s.slug
        else list_filter(list_transform(range(1, len(r.taken) + 2), lambda i: s.slug || '_' || i), lambda n: not list_contains(r.taken, n))[1] end as name
    from r join slugs s on s.k = r.k + 1))
select seq, slug, name from r where k > 0"""


@query(_NAMES_SQL)
def d1_unique_names(spark, sf_dir):
    """All titles; the names of every seventh were given out by an earlier run, which is that of S10."""
    slugs = titles(spark, sf_dir).select("seq", text.slug(F.col("title")).alias("slug"))
    return naming.allocate(slugs, slugs.where("seq % 7 = 0").select(F.col("slug").alias("name")))


@query("select doc_id, n_chars / 1048576.0::double as size_mb, n_chars / 1000.0::double as duration_s, n_chars / 60.0::double * 0.006::double as cost_usd from documents")
def p3_p5_size_cost(spark, sf_dir):
    n = F.col("n_chars")
    return table(spark, sf_dir, "documents").select("doc_id", numbers.size_mb(n).alias("size_mb"), numbers.duration_s(n).alias("duration_s"), numbers.cost(n).alias("cost_usd"))


@query(f'with {SEGMENTS_SQL} select transcript_id, seq, round(start / 7.0::double, 2) as start, round("end" / 7.0::double, 2) as "end", text, round(avg_logprob / 7.0::double, 2) as avg_logprob from segments')
def n1_round2(spark, sf_dir):
    """Sevenths of hundredths, which are never ties."""
    rows = segments(spark, sf_dir).withColumns({c: F.col(c) / F.lit(7.0) for c in ("start", "end", "avg_logprob")})
    return ops.from_local(rows)


@query(f"with {SEGMENTS_SQL} select transcript_id, seq, case when seq % 2 = 0 then start else 0 end::double as start, case when seq % 3 = 0 then null else \"end\" end as \"end\", case when seq % 2 = 0 then text else '' end as text, avg_logprob from segments")
def j1_json_roundtrip(spark, sf_dir):
    """Segments to a response and back; some keys are absent, some values null."""
    rows = segments(spark, sf_dir).withColumn("end", F.when(F.col("seq") % 3 != 0, F.col("end")))
    full = F.to_json(F.struct("start", "end", "text", "avg_logprob"), {"ignoreNullFields": "false"})
    part = F.to_json(F.struct("end", "avg_logprob"), {"ignoreNullFields": "false"})
    one = rows.select("transcript_id", "seq", F.when(F.col("seq") % 2 == 0, full).otherwise(part).alias("one"))
    parts = F.transform(F.array_sort(F.collect_list(F.struct("seq", "one"))), lambda x: x["one"])
    body = one.groupBy("transcript_id").agg(F.concat(F.lit('{"text": "", "segments": ['), F.array_join(parts, ","), F.lit("]}")).alias("body"))
    return ops.from_response(body)


@query(f"with {SEGMENTS_SQL} select transcript_id, start, \"end\", ' ' || text || '  \"x\"' as text, avg_logprob from segments")
def k3_csv_roundtrip(spark, sf_dir):
    path = new_dir(spark)
    rows = segments(spark, sf_dir)
    sinks.write_csv(rows.withColumn("text", F.concat(F.lit(" "), "text", F.lit('  "x"'))), path)
    return files.read_segments_csv(spark, path, "transcript_id", "long")


@query(f"with {SEGMENTS_SQL} select transcript_id, start, \"end\", text, avg_logprob from segments where not contains(text, '{UNWANTED}')")
def k4_json_files(spark, sf_dir):
    """Filtered, written as one array for each transcript, read back by S7."""
    path = new_dir(spark)
    sinks.write_json(segments(spark, sf_dir), path, UNWANTED)
    return files.read_segments_json(spark, path, "transcript_id", "long")


@query(f"with {SEGMENTS_SQL} select transcript_id, seq, start, \"end\", text, avg_logprob from segments where not contains(text, '{UNWANTED}')")
def k4_json_table(spark, sf_dir):
    """The same as one table of arrays."""
    path = new_dir(spark)
    sinks.write_json(segments(spark, sf_dir), path, UNWANTED, folders=False)
    arrays = spark.read.schema("transcript_id long, json string").json(path)
    kept = ops.without_text(segments(spark, sf_dir), UNWANTED)
    place = kept.select("transcript_id", "seq", (F.row_number().over(Window.partitionBy("transcript_id").orderBy("seq")) - 1).alias("pos"))
    rows = arrays.select("transcript_id", F.posexplode(F.from_json("json", "array<struct<start:double,end:double,text:string,avg_logprob:double>>")).alias("pos", "s"))
    return rows.join(place, ["transcript_id", "pos"]).select("transcript_id", "seq", "s.*")


@query(f"with {SEGMENTS_SQL} select transcript_id, string_agg(text || chr(10) || ' ', '' order by seq) as text from segments group by 1")
def k2_text_files(spark, sf_dir):
    """Texts with line breaks, written one to a file and read back with their keys."""
    path = new_dir(spark)
    sinks.write_text(ops.combined_text(segments(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n")))), path)
    return files.read_written_texts(spark, path, kind="long")


@query(f"with {SEGMENTS_SQL} select transcript_id, string_agg(text || chr(10) || ' ', '' order by seq) as text from segments group by 1")
def k2_text_table(spark, sf_dir):
    path = new_dir(spark)
    sinks.write_text(ops.combined_text(segments(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n")))), path, folders=False)
    return spark.read.schema("transcript_id long, text string").json(path)


_K5_SQL = f"with {SEGMENTS_SQL} select transcript_id, count(*) as n_before, count(*) filter (not contains(text, '{UNWANTED}')) as n_after, count(*) filter (contains(text, '{UNWANTED}')) as n_removed, count(*) filter (not contains(text, '{UNWANTED}')) as n_read, coalesce(sum(length(text)) filter (not contains(text, '{UNWANTED}')), 0)::bigint as n_chars from segments group by 1"


def _k5(spark, sf_dir, exact):
    path, rows = new_dir(spark), segments(spark, sf_dir)
    if exact:
        sinks.write_exact(rows, ops.combined_text(rows), path, None, "transcript_id")
        path = f"{path}/metadata_tables"
    else:
        sinks.write_json(rows, path)
    counts = sinks.drop_unwanted(spark, path, UNWANTED, kind="long", exact=exact).withColumn("transcript_id", F.col("transcript_id").cast("long"))
    left = files.read_segments_json(spark, path).withColumn("transcript_id", F.col("name").cast("long")) if exact else files.read_segments_json(spark, path, "transcript_id", "long")
    read = left.groupBy("transcript_id").agg(F.count("*").alias("n_read"), F.sum(F.length("text")).alias("n_chars"))
    return counts.join(read, "transcript_id", "left").na.fill(0, ["n_read", "n_chars"])


@query(_K5_SQL)
def k5_rewritten_folders(spark, sf_dir):
    """K5, A1: arrays that are written already lose their unwanted segments; counts, and what is read back."""
    return _k5(spark, sf_dir, False)


@query(_K5_SQL)
def k5_rewritten_files(spark, sf_dir):
    """K5 in files of exact names."""
    return _k5(spark, sf_dir, True)


def _exact(spark, sf_dir):
    """All transcripts' outputs in files of their names, odd characters and all; the folder."""
    path = new_dir(spark)
    rows = segments(spark, sf_dir).withColumn("filename", F.concat(F.lit("t é+%= "), F.col("transcript_id").cast("string")))
    rows = rows.withColumn("text", F.concat(F.lit(" "), "text", F.lit(' "x",\n')))
    texts = ops.combined_text(rows).join(rows.select("transcript_id", "filename").distinct(), "transcript_id")
    sinks.write_exact(rows, texts, path, UNWANTED)
    return path


_EXACT_SQL = f"with {SEGMENTS_SQL}, named as (select 't é+%= ' || transcript_id as name, seq, start, \"end\", ' ' || text || ' \"x\",' || chr(10) as text, avg_logprob from segments)"


@query(f"{_EXACT_SQL} select name, string_agg(text || ' ', '' order by seq) as text from named group by 1")
def k2_exact_text(spark, sf_dir):
    """K2: texts in files <name>.txt, letter for letter."""
    return files.read_texts(spark, f"{_exact(spark, sf_dir)}/combined_texts")


@query(f"{_EXACT_SQL} select name, start, \"end\", text, avg_logprob from named")
def k3_exact_csv(spark, sf_dir):
    """K3: tables in files <name>.csv."""
    return files.read_segments_csv(spark, f"{_exact(spark, sf_dir)}/metadata_tables")


@query(f"{_EXACT_SQL} select name, start, \"end\", text, avg_logprob from named where not contains(text, '{UNWANTED}')")
def k4_exact_json(spark, sf_dir):
    """K4, K5: arrays in files <name>.json, without unwanted segments."""
    return files.read_segments_json(spark, f"{_exact(spark, sf_dir)}/metadata_tables")


@query(f"with {_CLEAN_SQL} select length(text) as n_chars, md5(text) as digest from (select text || ' ' as text from cleaned)")
def s9_text_upload(spark, sf_dir):
    """Files of text, read whole and cleaned on loading. The line break that ends a file leaves an empty line."""
    path = new_dir(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", with_continuations(F.col("text")).alias("text"))
    sinks.write_text(docs, path, "text", "doc_id")
    loaded = files.read_texts(spark, path).select(clean.clean_lines(F.col("text")).alias("text"))
    return loaded.select(F.length("text").cast("long").alias("n_chars"), F.md5(F.col("text").cast("binary")).alias("digest"))


@query("select distinct lang || ' é+%/' || doc_id % 20 as name from documents")
def s10_taken_names(spark, sf_dir):
    """Names that outputs bear already, odd characters and all."""
    path = new_dir(spark)
    name = F.concat("lang", F.lit(" é+%/"), (F.col("doc_id") % 20).cast("string"))
    sinks.write_text(table(spark, sf_dir, "documents").select("text", name.alias("name")), path, "text", "name")
    return files.taken_names(spark, path, "name")


@query(f"with {SEGMENTS_SQL} select count(*) as n_before, count(*) filter (contains(text, '{UNWANTED}')) as n_removed, count(*) filter (not contains(text, '{UNWANTED}')) as n_after from segments")
def k6_observed_counts(spark, sf_dir):
    """K6: what a writing run observes."""
    rows, seen = ops.observed(segments(spark, sf_dir), UNWANTED, f"seen-{uuid.uuid4().hex}")
    path = new_dir(spark)
    rows.write.parquet(path)
    n = seen.get
    return spark.read.schema(rows.schema).parquet(path).agg(F.count("*").alias("n_after")).select(F.lit(n["n_before"]).cast("long").alias("n_before"), F.lit(n["n_removed"]).cast("long").alias("n_removed"), "n_after")


@query(f"select transcript_id, string_agg(sentence, ' ' order by seq, pos) || ' ' as merged_text from ({_m1_sql('text')}) group by 1")
def m1_merged_text(spark, sf_dir):
    """M1's text, F6: transcripts without segments have none."""
    return merge.merged_text(merge.merge_segments(segments(spark, sf_dir)))


_F6_SQL = _m1_sql("text").replace("from (select conv_id, turn, text as text from conversations)", "from (select conv_id, row_number() over (partition by conv_id order by turn) - 1 as turn, text from conversations where not contains(text, 'a'))")


@query(f"select conv_id as transcript_id, merged_text from (select distinct conv_id from conversations) left join (select transcript_id, string_agg(sentence, ' ' order by seq, pos) || ' ' as merged_text from ({_F6_SQL}) group by 1) on transcript_id = conv_id")
def f6_empty_transcripts(spark, sf_dir):
    """of transcripts that the filter leaves no segment there is no text."""
    rows = segments(spark, sf_dir)
    kept = merge.merged_text(merge.merge_segments(ops.without_text(rows, "a")))
    return rows.select("transcript_id").distinct().join(kept, "transcript_id", "left")


@query(f"with {TITLES_SQL} select seq, title, url, false as is_single from titles union all select 0, 'one', 'u', true")
def p7_single_or_playlist(spark, sf_dir):
    """S1, S2, P7."""
    one, many = adapters.single_video(spark, "one", "u"), titles(spark, sf_dir)
    return adapters.choose(False, one, many).withColumn("is_single", F.lit(False)).unionByName(adapters.choose(True, one, many).withColumn("is_single", F.lit(True)))


@query("select doc_id, printf('Audio duration: %.2f minutes, estimated cost: $%.4f', n_chars / 60.0::double, n_chars / 60.0::double * 0.006::double) as message from documents")
def t14_messages(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", numbers.cost_message(F.col("n_chars")).alias("message"))


@query("select doc_id, case when length(text) % 3 > 0 then strlen(text) / 1000.0::double end as duration_s, case when length(text) % 3 = 0 then 'ValueError: not audio' end as duration_error from documents")
def s4_durations(spark, sf_dir):
    """A decoder that fails for some."""

    def decode(content):
        if len(content.decode()) % 3 == 0:
            raise ValueError("not audio")
        return len(content)

    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("content"))
    return adapters.with_durations(docs, decode).select("doc_id", "duration_s", "duration_error")


@query(
    "select k || '_' || doc_id as filename, k = 'cut' as is_cut, case k when 'wav' then (n // 8 + case when n % 8 > 4 or n % 8 = 4 and n // 8 % 2 = 1 then 1 else 0 end) / 1000.0::double when 'm4a' then n / 1000.0::double end as duration_s, "
    "case k when 'cut' then 'ValueError: the file is cut short' when 'text' then 'ValueError: neither WAV nor MP4' end as duration_error "
    "from (select doc_id, strlen(text) n, ['wav', 'm4a', 'cut', 'text'][1 + length(text) % 4] k from documents where strlen(text) > 0)"
)
def s4_file_durations(spark, sf_dir):
    """Audio files made of documents, whole ones, some cut short and some that are none; durations from their headers."""

    def build(docs: pd.DataFrame) -> pd.Series:
        made = {"wav": containers.wav, "m4a": lambda b: containers.mp4(b, len(b)), "cut": lambda b: containers.wav(b)[:-1 - len(b) % 2], "text": lambda b: b"text" + b}
        return pd.Series([made[k](t.encode()) for k, t in zip(docs["kind"], docs["text"])])

    build.__annotations__ = {"docs": pd.DataFrame, "return": pd.Series}
    path = new_dir(spark)
    kind = F.get(F.array(*map(F.lit, ("wav", "m4a", "cut", "text"))), F.length("text") % 4)
    docs = table(spark, sf_dir, "documents").where("text <> ''").select(F.concat_ws("_", kind, "doc_id").alias("name"), kind.alias("kind"), "text")
    made = docs.select("name", F.pandas_udf(build, "binary")(F.struct("kind", "text")).alias("content"))
    exact.write_files(made, path, ".audio", "name", "content")
    rows = adapters.with_file_durations(files.list_audio(spark, path))
    return rows.select("filename", F.col("filename").startswith("cut").alias("is_cut"), "duration_s", "duration_error")


_HOST_SQL = "regexp_extract(url, '://([^/]+)', 1)"


@query(
    f"with {TITLES_SQL}, v as (select {_HOST_SQL} playlist, (row_number() over (partition by {_HOST_SQL} order by seq) - 1)::bigint seq, title, url from titles) "
    "select playlist, seq, title, url, seq = 0 as is_single from v"
)
def s2_playlists(spark, sf_dir):
    """Hosts as playlists of their pages, listed page by page; first videos alone, and all others, each asked of the listing."""
    path = new_dir(spark)
    videos = titles(spark, sf_dir).select(F.regexp_extract("url", "://([^/]+)", 1).alias("playlist"), "seq", "title", "url")
    listing.write_listing(listing.places(videos, "seq"), path)
    first, others = listing.read_listing(spark, path).where("seq = 0"), listing.read_listing(spark, path).where("seq > 0")
    return first.withColumn("is_single", F.lit(True)).unionByName(others.withColumn("is_single", F.lit(False)))


@query("select doc_id, true as is_in_run, 1::bigint as n_times from documents")
def dt1_request_time(spark, sf_dir):
    """DT1: the times are written, and lie between the clock before and after that, in microseconds since 1970; all items of a run have one."""
    path = new_dir(spark)
    before = time.time_ns() // 1000
    rows = adapters.requested(table(spark, sf_dir, "documents").select("doc_id"))
    rows.write.parquet(path)
    after = time.time_ns() // 1000 + 1
    made = spark.read.schema(rows.schema).parquet(path)
    n = made.agg(F.count_distinct("request_time").alias("n_times"))
    return made.select("doc_id", F.unix_micros("request_time").between(before, after).alias("is_in_run")).join(F.broadcast(n))


@query(f"with s as (select doc_id, list_transform(string_split({_t2(L_SQL)}, '. '), lambda v: regexp_replace(v, '{STRIP}', '', 'g')) s from documents) select doc_id, (generate_subscripts(s, 1) - 1)::int as pos, unnest(s) as sentence from s")
def t4_model_sentences(spark, sf_dir):
    """Sentences by a model, a stand-in that parts at full stops before a space; blank ones are kept."""
    split = text.model_splitter(lambda: lambda t: t.split(". "))
    docs = table(spark, sf_dir, "documents").select("doc_id", with_breaks(F.col("text")).alias("text"))
    return docs.select("doc_id", F.posexplode(split(F.col("text"))).alias("pos", "sentence"))


_A_SQL = "text"
for _word, _instead in ABBREVIATED.items():
    _A_SQL = f"replace({_A_SQL}, '{_word}', '{_instead}')"
_BARE = rf"regexp_replace(token, '^[\(\"\x27\[\{{«“‘]+|[\)\"\x27\]\}}»”’]*{S}*$', '', 'g')"
_PLAIN = f"regexp_replace({_BARE}, '[,;:]+$', '')"
_LEARNED_SQL = rf"""
whole as (select doc_id, {_t2(_A_SQL)} t from documents),
tokens as (select doc_id, i, l[i] token from (select doc_id, regexp_extract_all(t, '[^\s\x0b\x1c-\x1f\x85\p{{Z}}]+{S}*') l from whole), unnest(range(1, len(l) + 1)) u(i)),
typed as (select *, {_BARE} bare, lower(regexp_replace({_PLAIN}, '\.$', '')) word, ends_with({_PLAIN}, '.') stop from tokens),
counts as (select word, count(*) n, count(*) filter (stop) n_stop from typed where regexp_matches(word, '^\p{{L}}[\p{{L}}.\x27’-]*$') group by 1),
likely as (select *, length(replace(word, '.', ''))::double letters, (n - n_stop)::double plain, sum(n_stop) over () / sum(n) over ()::double usual from counts),
scores as (select *, 2 * (n_stop * ln(0.99::double) + plain * ln(0.01::double) - n_stop * ln(usual) - case when plain > 0 then plain * ln(1 - usual) else 0 end) * exp(-letters) * (length(word) - letters + 1) * pow(letters, -plain) score from likely where n_stop > 0),
model as (select word, n, n_stop, round(score, 4) score from scores where score >= {splitter.THRESHOLD})
"""


def _abbreviated(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", with_abbreviations(F.col("text")).alias("text"))


@query(f"with {_LEARNED_SQL} select * from model")
def t4_learned_abbreviations(spark, sf_dir):
    """T4: the words that a splitter learns to be abbreviations, from all documents."""
    return splitter.learn(_abbreviated(spark, sf_dir)).select("word", "n", "n_stop", F.round("score", 4).alias("score"))


@query(
    f"""with {_LEARNED_SQL}, flags as (select doc_id, i, token, (regexp_matches(bare, '[!?]$') or ends_with(bare, '.') and lower(regexp_replace({_PLAIN}, '\\.$', '')) not in (select word from model))::int ends from typed),
    placed as (select *, coalesce(sum(ends) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0)::int pos from flags)
    select doc_id, pos, regexp_replace(string_agg(token, '' order by i), '{STRIP}', '', 'g') as sentence from placed group by 1, 2"""
)
def t4_learned_sentences(spark, sf_dir):
    """All documents, split by what was learned from them."""
    docs = _abbreviated(spark, sf_dir)
    return splitter.split_texts(docs, splitter.learn(docs), ["doc_id"])


@query("select doc_id, case when doc_id % 2 = 0 and doc_id % 3 <> 0 then 'cuda' else 'cpu' end as device, case when doc_id % 2 = 0 and doc_id % 3 <> 0 then 'float16' else 'auto' end as number_type from documents")
def f8_device(spark, sf_dir):
    """F8: where a local model runs, for items on machines with a GPU or none, some told not to use it."""
    cuda, disabled = F.col("doc_id") % 2 == 0, F.col("doc_id") % 3 == 0
    return table(spark, sf_dir, "documents").select("doc_id", adapters.device_of(cuda, disabled).alias("d")).select("doc_id", "d.*")


@query("select doc_id, x, case when x < 0 then -1 else 1 end * (k * 25 // 2 + case when k % 2 = 1 then (k * 25 // 2) % 2 else 0 end) / 100.0::double as rounded from (select doc_id, n_chars k, case when doc_id % 2 = 0 then n_chars else -n_chars end / 8.0::double x from documents)")
def n1_round2_ties(spark, sf_dir):
    """N1 on eighths: every odd one is a tie."""
    sign = F.when(F.col("doc_id") % 2 == 0, 1.0).otherwise(-1.0)
    return table(spark, sf_dir, "documents").select("doc_id", (sign * F.col("n_chars") / F.lit(8.0)).alias("x")).withColumn("rounded", numbers.round2(F.col("x")))


@query(f"with {TITLES_SQL} select seq, title, url, case when seq % 5 <> 0 then url || '/audio/' || case when seq % 2 = 0 then 2 else 1 end end as stream_url, case when seq % 5 = 0 then 'no audio stream: ' || title end as error from titles")
def s3_audio_streams(spark, sf_dir):
    videos = titles(spark, sf_dir)
    ordinals = videos.select("seq", "url", F.explode(F.array(*[F.lit(i) for i in range(4)])).alias("ordinal"))
    is_audio = (F.col("ordinal") >= F.when(F.col("seq") % 2 == 0, 2).otherwise(1)) & (F.col("seq") % 5 != 0)
    streams = ordinals.select(F.col("seq").alias("video_seq"), "ordinal", is_audio.alias("only_audio"), F.concat("url", F.lit("/audio/"), F.col("ordinal").cast("string")).alias("url"))
    return adapters.first_audio_streams(videos, streams)


_LINES_SQL = "one as (select doc_id transcript_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') l from documents), lines as (select transcript_id, (generate_subscripts(l, 1) - 1)::bigint seq, unnest(l) line from one)"


def _audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as audio files for the stand-in transcriber."""
    name = F.concat(F.lit("d"), F.col("doc_id").cast("string"))
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("transcript_id"), F.lit("/audio").alias("path"), name.alias("filename"), F.col("text").cast("binary").alias("content"))


@query(f"with {_LINES_SQL} select transcript_id, seq, 2.0::double * seq as start, 2.0::double * seq + 2.0::double as \"end\", ' ' || line as text, -(length(line) % 100) / 100.0::double as avg_logprob from lines")
def e1_transcribe(spark, sf_dir):
    """Segments by the stand-in transcriber."""
    return transcripts.transcribe(_audio(spark, sf_dir), adapters.line_transcriber).segments


@query("select doc_id as transcript_id, 'ValueError: no audio' as error from documents where length(text) % 2 = 0")
def f7_error_isolation(spark, sf_dir):
    def make():
        model = adapters.line_transcriber()

        def run(content):
            if len(content.decode()) % 2 == 0:
                raise ValueError("no audio")
            return model(content)

        return run

    return transcripts.transcribe(_audio(spark, sf_dir), make, Settings()).errors


@query(f"with {_LINES_SQL} select transcript_id, string_agg(' ' || line || ' ', '' order by seq) as combined_text from lines group by 1")
def e1_combined_text(spark, sf_dir):
    return transcripts.transcribe(_audio(spark, sf_dir), adapters.line_transcriber).texts


@query(f"with {_LINES_SQL} select transcript_id, string_agg(' ' || line, '' order by seq) as combined_text, count(*) as n_segments, 0::bigint as n_sentences, sum(2.0::double * seq) as start from lines group by 1")
def s6_remote_transcripts(spark, sf_dir):
    """Texts are those of the responses, and no sentences are given."""
    run = transcripts.transcribe(_audio(spark, sf_dir), adapters.line_client, Settings(use_remote=True))
    counts = run.segments.groupBy("transcript_id").agg(F.count("*").alias("n_segments"), F.sum("start").alias("start"))
    found = run.sentences.groupBy("transcript_id").agg(F.count("*").alias("n"))
    return run.texts.join(counts, "transcript_id").join(found, "transcript_id", "left").select("transcript_id", "combined_text", "n_segments", F.coalesce("n", F.lit(0)).cast("long").alias("n_sentences"), "start")


@query(
    "select doc_id as transcript_id, case k when 1 then 'JSONDecodeError' when 2 then 'ValueError' when 3 then 'Transient' end as error, case when k = 0 or k > 3 then len(list_filter(string_split(text, chr(10)), lambda x: x <> '')) end as n_segments "
    "from (select *, length(text) % 6 k from documents) where k between 1 and 3 or text <> '' and regexp_matches(text, '[^\\n]')"
)
def s6_remote_failures(spark, sf_dir):
    """Several calls at once; answers cut short, answers that are no objects and services that stay busy are errors of their items, a service that is busy once is not."""

    def make():
        answer, met = adapters.line_client(), set()

        def run(content):
            k = len(content.decode()) % 6
            if k == 3:
                raise Transient("busy")
            # Digests: a worker serves many contents.
            if k == 4 and (digest := hashlib.sha256(content).digest()) not in met:
                met.add(digest)
                raise Transient("busy")
            body = answer(content)
            return {1: body[:-1], 2: f"[{body}]"}.get(k, body)

        return run

    run = transcripts.transcribe(_audio(spark, sf_dir), make, Settings(use_remote=True, calls=Calls(width=4, retries=2, pause=0.001)))
    done = run.again(written(run.rows))
    failed = done.errors.select("transcript_id", F.split("error", ":")[0].alias("error"), F.lit(None).cast("long").alias("n_segments"))
    return failed.unionByName(done.segments.groupBy("transcript_id").agg(F.lit(None).cast("string").alias("error"), F.count("*").alias("n_segments")))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments without unwanted ones, their sentences, in paragraphs."""
    kept = ops.without_text(segments(spark, sf_dir), UNWANTED)
    return clean.paragraph_rows(kept, ["transcript_id", "seq"])

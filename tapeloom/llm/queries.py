"""The queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from tapeloom.llm import decontam, licenses, lm, packing, pii, quality, runs, secrets, simhash, substring, token_counts, warc, whitening


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark, sf_dir):
    return secrets.secrets_report(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark, sf_dir):
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_pii(spark, sf_dir):
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op5_warc(spark, sf_dir):
    return warc.warc_report(_table(spark, sf_dir, "pages"))


def op6_lm_scoring(spark, sf_dir):
    return lm.score_texts(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op8_decontamination(spark, sf_dir):
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_simhash(spark, sf_dir):
    return simhash.simhash_report(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark, sf_dir):
    return substring.substring_report(_table(spark, sf_dir, "documents"))


def op11_license_scan(spark, sf_dir):
    return licenses.licenses_report(_table(spark, sf_dir, "documents"))


def op12_embedding_whitening(spark, sf_dir):
    return whitening.whitening_report(_table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark, sf_dir):
    return runs.runs_report(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_pii,
        op5_warc,
        op6_lm_scoring,
        op7_token_counts,
        op8_decontamination,
        op9_simhash,
        op10_substring_dedup,
        op11_license_scan,
        op12_embedding_whitening,
        op13_periodic_runs,
    )
}

# --- SQL ------------------------------------------------------------------------------------------

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP5_SQL = """
with p as (select page_id, coalesce(html, '') h from pages),
d as (select *, strlen(h) n, sha1(h) x from p),
f as (select *, min(page_id) over (partition by h) first,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    (('0x' || substr(x, 1 + (5 * i // 4), 1))::int << 8) +
    (('0x' || coalesce(nullif(substr(x, 2 + (5 * i // 4), 1), ''), '0'))::int << 4) +
    ('0x' || coalesce(nullif(substr(x, 3 + (5 * i // 4), 1), ''), '0'))::int) >> (7 - (5 * i) % 4) & 31), 1) for i in range(0, 32)], '') digest from d)
select page_id, n as payload_bytes, digest as payload_digest, case when page_id = first then 'response' else 'revisit' end as record_type, case when page_id <> first then first end as refers_to from f
"""

#: Windows are compared as the words themselves.
_OP10_SQL = f"""
with d as (select doc_id, {_WORDS} w from documents),
s as (select doc_id, i, array_to_string(w[i:i + 49], ' ') k from d, unnest(range(1, len(w) - 48)) t(i)),
m as (select doc_id, i, min(doc_id) over (partition by k) first from s),
g as (select distinct doc_id, unnest(range(i, i + 50)) p from m where first < doc_id),
l as (select doc_id, list(p) ps from g group by 1),
k as (select doc_id, len(w) n, coalesce(len(ps), 0) gone, case when ps is null then w else list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: not list_contains(ps, x[2])), lambda x: x[1]) end kept from d left join l using (doc_id))
select doc_id, n::bigint as n_words, gone::bigint as n_removed, sha256(array_to_string(kept, ' ')) as kept_sha256 from k
"""


def _matches_sql(pattern: str, column: str = "t") -> str:
    """Rows (doc_id, s, m, b): each match m of the pattern in s, and where it begins."""
    return (
        f"select doc_id, s, m[i] m, (list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::bigint b "
        f"from (select doc_id, {column} s, regexp_extract_all({column}, '{pattern}') m, string_split_regex({column}, '{pattern}') g from t where regexp_matches({column}, '{pattern}')), unnest(range(1, len(m) + 1)) u(i)"
    )


def _spans_sql(kinds: list[tuple[str, str, str]]) -> str:
    """(kind, pattern, condition on the match m): rows (doc_id, rank, kind, b, e) of the matches that hold."""
    return " union all ".join(f"select doc_id, {rank} rank, '{kind}' kind, b, b + length(m) e from ({_matches_sql(pattern)}) where {holds}" for rank, (kind, pattern, holds) in enumerate(kinds))


def _either(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = rf"""({_KEYS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_OP1_KINDS = [
    ("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6"),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 20"),
    ("hex", "[0-9a-f]+", "length(m) >= 24"),
    *[(r.kind, r.pattern, "true") for r in secrets.RULES if not r.base and r.kind != "jwt"],
]
#: SQL has no lookarounds: a match takes the character before it, if there is one. That is never part of the match before.
_JWT = r"(?:^|[^A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
_JWT_SQL = f"select doc_id, {[r.kind for r in secrets.RULES].index('jwt')} rank, 'jwt' kind, b + length(m) - length(j) b, b + length(m) e from (select *, regexp_extract(m, '(?s)eyJ.*') j from ({_matches_sql(_JWT)}))"
_JOINED = "coalesce(string_agg(kind || ':' || b || ':' || e, ',' order by b, rank){}, '')"
_OP1_SQL = f"""
with t as (select doc_id, coalesce(text, '') t from documents),
s as ({_spans_sql(_OP1_KINDS)} union all {_JWT_SQL}),
a as (select doc_id, count(*) filter (kind = 'assign') n_assign, count(*) filter (kind = 'access') n_access, count(*) filter (kind = 'hex') n_hex,
  {_JOINED.format(" filter (rank < 3)")} base, {_JOINED.format("")} spans from s group by 1)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents left join a using (doc_id)
"""

_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(0, length({_DIGITS})), lambda i: substr(reverse({_DIGITS}), i + 1, 1)::int * (1 + i % 2) - case when i % 2 = 1 and substr(reverse({_DIGITS}), i + 1, 1) > '4' then 9 else 0 end)) % 10 = 0"
_OP4_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(list_transform(string_split(m, '.'), lambda x: ltrim(x, '0')), lambda x: length(x) > 3 or length(x) = 3 and x > '255')) = 0"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) between 14 and 19 and {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 10 and 15"),
    # A whole run of digits and hyphens, as the pattern's lookarounds ask.
    ("national", "[0-9-]+", rf"regexp_full_match(m, '[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}')"),
]
#: SQL has no lookarounds: in ``wide`` all characters but letters and digits stand twice, so that each match can take the ones beside it.
_IBAN = r"[^A-Za-z0-9][A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?:\x20\x20[A-Z0-9]{4}){2,7}(?:\x20\x20[A-Z0-9]{1,3})?)[^A-Za-z0-9]"
_CODE = "instr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', {}) - 1"
_IBAN_SQL = f"""
select doc_id, 4 rank, 'iban' kind, b, b + length(h) e from (
  select doc_id, replace(substr(m, 2, length(m) - 2), '  ', ' ') h, b - length(regexp_replace(substr(s, 2, b), '[A-Za-z0-9]', '', 'g')) // 2 b from ({_matches_sql(_IBAN, "wide")}))
where list_reduce(list_transform(string_split(substr(replace(h, ' ', ''), 5) || substr(h, 1, 4), ''), lambda c: {_CODE.format("c")}), lambda a, v: (a * case when v > 9 then 100 else 10 end + v) % 97) = 1
"""
_KINDS4 = "case kind " + " ".join(f"when '{k}' then {{{k}}}" for k in pii.KINDS) + " end"
_PRIOR4 = _KINDS4.format(**pii.PRIOR)
_CONTEXT4 = _KINDS4.format(**{k: f"regexp_matches(x, '{pii.word(w)}')" for k, w in pii.CONTEXT.items()})
_OP4_SQL = f"""
with t as (select doc_id, coalesce(text, '') t, ' ' || regexp_replace(coalesce(text, ''), '([^A-Za-z0-9])', '\\1\\1', 'g') || ' ' wide from documents),
f as (select doc_id, case when kind = 'national' then 5 else rank end rank, kind, b, e from ({_spans_sql(_OP4_KINDS)} union all {_IBAN_SQL})),
x as (select f.*, lower(substr(t, greatest(b - {pii.NEAR}, 0) + 1, least(b, {pii.NEAR}))) x from f join (select distinct * from t) using (doc_id)),
p as (select doc_id, rank, kind, b, e, greatest(0, least(100, {_PRIOR4} + case when {_CONTEXT4} then {pii.BONUS} else 0 end - case when regexp_matches(x, '{pii.word(pii.MADE_UP)}') then {pii.MALUS} else 0 end)) points from x),
s as (select * from p where rank < 4 or points >= {pii.THRESHOLD}),
a as (select doc_id, {", ".join(f"count(*) filter (kind = '{k}') n_{k}" for k in pii.BASE)},
  {_JOINED.format(" filter (rank < 4)")} base, {_JOINED.format("")} spans, coalesce(string_agg(points, ',' order by b, rank), '') scores from s group by 1)
select doc_id, {", ".join(f"coalesce(n_{k}, 0) as n_{k}" for k in pii.BASE)}, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans, coalesce(scores, '') as scores
from documents left join a using (doc_id)
"""

_RULES11 = ", ".join(
    f"({i}, '{r.label}', '{r.regex}', {[*r.first]}, {[*r.second]}, {r.priority}, {r.score}::double, {r.base})" for i, r in enumerate(licenses.RULES)
)
_WORDS11 = "(length(x) - length(replace(x, ' ', ''))) // 2"
#: ``row`` tells rows that share an id apart.
_OP11_SQL = f"""
with w as (select row_number() over () row, doc_id, trim(regexp_replace(lower(coalesce(text, '')), '{licenses.GAP}', ' ', 'g'), ' ') w from documents),
t as materialized (select row, doc_id, case when w = '' then 0 else len(string_split(w, ' ')) end n_words, ' ' || replace(w, ' ', '  ') || ' ' t,
  list_intersect(string_split(w, ' '), {licenses.keywords()}) have from w),
rules(rank, label, regex, a, b, priority, score, base) as (values {_RULES11}),
may as materialized (select row, t, rules.* from t join rules on list_has_any(have, a) and list_has_any(have, b) where len(have) > 1),
m as (select *, regexp_extract_all(t, regex) hits, string_split_regex(t, regex) gaps from may where regexp_matches(t, regex)),
s as (select row, rank, label, priority, score, base, (list_sum(list_transform(gaps[1:i], lambda x: {_WORDS11})) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: {_WORDS11})), 0))::bigint b,
  list_transform([hits[i]], lambda x: {_WORDS11})[1] n from m, unnest(range(1, len(hits) + 1)) u(i)),
d as (select *, b + n e from s),
up as (select d.*, exists (select 1 from d o where o.row = d.row and o.b <= d.b and o.e >= d.e and o.priority <= d.priority and (o.b < d.b or o.e > d.e or o.priority < d.priority or o.rank < d.rank)) gone from d),
a as (select row, count(*) filter (base) n_base, min(b) filter (base) first_word, max(b) filter (base) last_word, string_agg(distinct label, ',' order by label) filter (base) base_labels,
  string_agg(distinct label, ',' order by label) filter (base or not gone) labels, max(score) filter (not gone) score from up group by 1)
select doc_id, n_words::bigint as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0)::double as score
from t left join a using (row)
"""

#: By query; those absent are tested against brute force in tests/llm: learned rules (2), a tokenizer (3, 7), a Bloom filter
#: (6), BM25 retrieval (8), XXH64 (9), eigenvectors (12), runs (13), which SQL could only find by comparing all words of a text.
ORACLE_SQL: dict[str, str] = {"op1_secret_scan": _OP1_SQL, "op4_pii": _OP4_SQL, "op5_warc": _OP5_SQL, "op10_substring_dedup": _OP10_SQL, "op11_license_scan": _OP11_SQL}

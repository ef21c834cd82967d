"""The registered queries of the text operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.llm import bit_slices, conversations, decontamination, html_text, line_runs, packing, pii, quality, secrets, simhash, suffix_dedup, warc, whitening
from silverline.llm.common import table
from silverline.session import scratch_path


def _listing(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end, comma-joined in the order given."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def op1_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base spans, and all spans."""
    found = pii.find_personal_data(table(spark, sf_dir, "documents"))
    counts = [_count("base", k).alias(f"n_{kind}") for k, kind in enumerate(pii.KINDS)]
    every = F.array_sort(F.concat("base", "more"))
    return found.select(
        "doc_id", *counts, F.sha2(_listing(F.col("base"), pii.KINDS), 256).alias("base_sha256"), _listing(every, pii.KINDS).alias("spans")
    )


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with their sequences."""
    return packing.pack(table(spark, sf_dir, "documents"), packing.public_packing())


def op3_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the smallest id reachable from it."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), simhash.SimHash(words=3, seed=42, radius=2))


def op4_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base spans, and all spans."""
    kinds = tuple(rule.kind for rule in secrets.RULES)
    base = F.filter("spans", lambda s: s["kind"] < len(secrets.BASE_RULES))
    counts = [_count("spans", k).alias(f"n_{rule.kind}") for k, rule in enumerate(secrets.BASE_RULES)]
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", *counts, F.sha2(_listing(base, kinds), 256).alias("base_sha256"), _listing(F.col("spans"), kinds).alias("spans")
    )


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of repeated line runs: counts and digest of what stays."""
    kept = line_runs.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_removed", "n_runs", F.length(text).cast("long").alias("n_chars"), F.sha2(text, 256).alias("kept_sha256"))


def op6_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict for every document."""
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that start anywhere else too."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op9_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document repeats."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written to the shared folder and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).drop("stated_digest")


def op11_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after planted damage."""
    rows = table(spark, sf_dir, "conversations")
    return conversations.repair_report(rows, conversations.damaged(rows))


def op12_bit_sliced_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest inner products of every 50th vector with all others."""
    return bit_slices.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on their 32 leading components, with unit variance."""
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_contextual_pii": op1_contextual_pii,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_simhash_tiles": op3_simhash_tiles,
    "op4_trigram_secrets": op4_trigram_secrets,
    "op5_line_runs": op5_line_runs,
    "op6_text_density": op6_text_density,
    "op7_compression_quality": op7_compression_quality,
    "op8_suffix_repeats": op8_suffix_repeats,
    "op9_benchmark_windows": op9_benchmark_windows,
    "op10_warc_chain": op10_warc_chain,
    "op11_interval_repair": op11_interval_repair,
    "op12_bit_sliced_search": op12_bit_sliced_search,
    "op13_whitening": op13_whitening,
}

# Words and white space as the operators split them.
_WORDS = r"[^\x20\x09-\x0D]+"

OP5_SQL = rf"""
with split as (
  select doc_id, string_split(text, chr(10)) as lines from documents
), every as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as no from split
), worded as (
  select *, len(regexp_extract_all(line, '{_WORDS}')) as words, row_number() over (partition by doc_id order by no) as pos
  from every where regexp_matches(line, '{_WORDS}')
), near as (
  select doc_id, pos, list(line) over ahead as la, list(words) over ahead as wa, list(line) over behind as lb, list(words) over behind as wb
  from worded
  window ahead as (partition by doc_id order by pos rows between current row and 9 following),
         behind as (partition by doc_id order by pos rows between 9 preceding and current row)
), sizes as (
  select *, list_filter(range(1, len(wa) + 1), lambda k: list_sum(wa[1:k]) >= 10)[1] as ka,
    list_filter(range(1, len(wb) + 1), lambda k: list_sum(wb[len(wb) - k + 1:len(wb)]) >= 10)[1] as kb
  from near
), stretches as (
  select doc_id, pos as first_pos, ka as k, la[1:ka] as part from sizes where ka is not null
  union
  select doc_id, pos - kb + 1, kb, lb[len(lb) - kb + 1:len(lb)] from sizes where kb is not null
), ranked as (
  select *, row_number() over (partition by part order by doc_id, first_pos) as copy from stretches
), gone as (
  select distinct doc_id, unnest(range(first_pos, first_pos + k)) as pos from ranked where copy > 1
), runs as (
  select doc_id, count(*) as n_removed, count(*) filter (before is null or before <> pos - 1) as n_runs
  from (select *, lag(pos) over (partition by doc_id order by pos) as before from gone) group by doc_id
), kept as (
  select e.doc_id, string_agg(e.line, chr(10) order by e.no) as text
  from every e left join worded w on w.doc_id = e.doc_id and w.no = e.no left join gone g on g.doc_id = e.doc_id and g.pos = w.pos
  where g.pos is null group by e.doc_id
)
select d.doc_id, coalesce(len(s.lines), 0)::bigint as n_lines, coalesce(r.n_removed, 0)::bigint as n_removed, coalesce(r.n_runs, 0)::bigint as n_runs,
  length(coalesce(k.text, ''))::bigint as n_chars, sha256(coalesce(k.text, '')) as kept_sha256
from documents d left join split s using (doc_id) left join runs r using (doc_id) left join kept k using (doc_id)
"""



def _secret_spans(number: int, rule: secrets.Rule) -> str:
    """Spans of one rule as a list of (start, kind, end): gaps between matches and the matches themselves add up to places."""
    expression = rule.expression.removeprefix("(?<![0-9a-f])").replace("'", "''")
    return f"""list_filter(list_transform(
      list_zip(string_split_regex(text, '{expression}'), regexp_extract_all(text, '{expression}'), regexp_extract_all(text, '{expression}', {rule.group}),
               range(1, len(string_split_regex(text, '{expression}')))),
      lambda p: {{'first': (coalesce(list_sum(list_transform(string_split_regex(text, '{expression}')[1:p[4]], lambda x: length(x))), 0)
                          + coalesce(list_sum(list_transform(regexp_extract_all(text, '{expression}')[1:p[4] - 1], lambda x: length(x))), 0))::bigint,
                 'kind': {number}, 'size': length(p[2]), 'good': length(p[3]) >= {rule.least}}}), lambda s: s.good is true)"""


_KIND_NAMES = "[" + ", ".join(f"'{rule.kind}'" for rule in secrets.RULES) + "]"
_JOIN_SPANS = f"array_to_string(list_transform({{spans}}, lambda s: {_KIND_NAMES}[s.kind + 1] || ':' || s.first || ':' || (s.first + s.size)), ',')"

OP4_SQL = f"""
with found as (
  select doc_id, list_sort(flatten([{", ".join(_secret_spans(number, rule) for number, rule in enumerate(secrets.RULES))}])) as spans
  from (select doc_id, coalesce(text, '') as text from documents)
)
select doc_id,
  {", ".join(f"len(list_filter(spans, lambda s: s.kind = {number}))::bigint as n_{rule.kind}" for number, rule in enumerate(secrets.BASE_RULES))},
  sha256({_JOIN_SPANS.format(spans=f"list_filter(spans, lambda s: s.kind < {len(secrets.BASE_RULES)})")}) as base_sha256,
  {_JOIN_SPANS.format(spans="spans")} as spans
from found
"""

OP10_SQL = """
with payloads as (
  select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as digest from pages
), largest as (
  select html, max(page_id) as top from payloads group by html
)
select page_id, strlen(html)::bigint as payload_bytes,
  array_to_string(list_transform(range(8), lambda g: array_to_string(list_transform([15, 10, 5, 0], lambda b:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(digest, g * 5 + 1, 5))::bigint >> b) & 31)::bigint + 1, 1)), '')), '') as payload_digest,
  case when top is null or page_id = top then 'response' else 'revisit' end as record_type,
  case when page_id <> top then top end as refers_to
from payloads join largest using (html)
"""

_FAR = "{'c': 1000000000000, 'a': '~'}"


def _least(*candidates: str) -> str:
    return f"list_min([{', '.join(candidates)}])"


def _after(state: int, cost: str, letters: str, of: str = "s") -> str:
    return f"{{'c': {of}[{state + 1}].c + {cost}, 'a': {of}[{state + 1}].a || '{letters}'}}"


def _if(condition: str, pair: str) -> str:
    return f"case when {condition} then {pair} else {_FAR} end"


# The states of the grammar, one row after another; s: least (cost, audit) by state, r[1]: fault and role initial of a row.
_GOOD, _EXTRA = "r[1].c not in (1, 2)", "case when r[1].c = 3 then 3 else 0 end"
_MOVED = [
    _after(0, "4", "D"),
    _least(_after(1, "4", "D"), _if(f"{_GOOD} and r[1].a = 's'", _after(0, _EXTRA, "K"))),
    _least(_after(2, "4", "D"), *[_if(f"{_GOOD} and r[1].a = 'u'", _after(q, _EXTRA, "K")) for q in (0, 1, 3)], *[_if(_GOOD, _after(q, f"3 + {_EXTRA}", "R")) for q in (0, 1, 3)]),
    _least(_after(3, "4", "D"), _if(f"{_GOOD} and r[1].a = 'a'", _after(2, _EXTRA, "K")), _if(_GOOD, _after(2, f"3 + {_EXTRA}", "R"))),
]
_CLOSED = [
    "m[1]", "m[2]", _least("m[3]", *[_after(q, "3", "I", "m") for q in (0, 1, 3)]),
    _least("m[4]", _after(2, "3", "I", "m"), _after(0, "6", "II", "m"), _after(1, "6", "II", "m")),
]
_STEP = f"list_transform([[{', '.join(_MOVED)}]], lambda m: [{', '.join(_CLOSED)}])[1]"

OP11_SQL = rf"""
with crc as (
  select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as t
), dealt as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ord(x)::bigint),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as f
  from conversations, crc
), rows as (
  select conv_id, turn, case when f = 4 then 'user' else role end as role,
    case f when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(case when f = 3 then [1, 2] else [1] end) as copy
  from dealt where f <> 0
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos from rows
), judged as (
  select *, left(role, 1) as initial, left(lag(role) over (partition by conv_id order by pos), 1) as before,
    case when not regexp_matches(text, '[^ 	-
]') then 1
         when row_number() over (partition by conv_id, role, text order by pos) > 1 then 2
         when regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) not in ('.', '!', '?') then 3 else 0 end as fault
  from placed
), measured as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 1) as blank,
    count(*) filter (fault = 2) as duplicate, count(*) filter (fault = 3) as truncated,
    count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal,
    list_reduce(list([{{'c': fault::bigint, 'a': initial}}] order by pos), lambda s, r: {_STEP},
      [{{'c': 0::bigint, 'a': ''}}, {_FAR}, {{'c': 3, 'a': 'I'}}, {{'c': 6, 'a': 'II'}}]) as s
  from judged group by conv_id
), parsed as (
  select *, list_min([s[1], s[4]]).c as cost, list_min([s[1], s[4]]).a as audit from measured
), letters as (
  select conv_id, audit, unnest(string_split(audit, '')) as letter, generate_subscripts(string_split(audit, ''), 1) as nth from parsed where audit <> ''
), turns as (
  select *, count(*) filter (letter <> 'I') over up_to as pos, count(*) filter (letter <> 'D') over up_to as number, length(replace(audit, 'D', '')) as total
  from letters window up_to as (partition by conv_id order by nth)
), written as (
  select t.conv_id, string_agg(case letter when 'K' then j.role when 'I' then new else new end || ':' || case letter when 'I' then '' else j.text end, chr(10) order by nth) as body
  from (select *, case when (number - total % 2) % 2 = 1 then 'user' else 'assistant' end as new from turns) t
  left join judged j on j.conv_id is not distinct from t.conv_id and j.pos = t.pos and letter <> 'I'
  where letter <> 'D' group by t.conv_id
)
select c.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(body, '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join parsed p on p.conv_id is not distinct from c.conv_id left join written w on w.conv_id is not distinct from c.conv_id
"""

OP12_SQL = """
with whole as (
  select row_number() over () as row, vec_id, list_transform(embedding, lambda c: floor(256 * c::double)::bigint) as x
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda c: c is null or isnan(c) or isinf(c))) = 0
), scored as (
  select q.row as asked, q.vec_id as query_id, c.vec_id, c.row,
    coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::bigint as score
  from whole q join whole c on q.row <> c.row where q.vec_id % 50 = 0
), ranked as (
  select *, row_number() over (partition by asked order by score desc, vec_id nulls last, row)::integer as rank from scored
)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""

SQL: dict[str, str] = {"op4_trigram_secrets": OP4_SQL, "op5_line_runs": OP5_SQL, "op10_warc_chain": OP10_SQL, "op11_interval_repair": OP11_SQL, "op12_bit_sliced_search": OP12_SQL}

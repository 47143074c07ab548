"""The registered queries ``opN_<name>`` and, where SQL can state them, their DuckDB oracles.

Each query applies its operator with production parameters to the whole intended table and derives
its result columns from the operator's rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path
from . import bpe, collocations, conversations, covertree, minhash, mixing, pst, repetition, shards, simhash, suffixdedup, urls, warc

_WORD = r"[^\x20\x09-\x0D]+"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


@query
def op1_karmarkar_karp_shards(spark, sf_dir):
    return shards.shard_documents(_table(spark, sf_dir, "documents"), parts=8)


@query
def op2_cover_tree_topk(spark, sf_dir):
    return covertree.top_k(_table(spark, sf_dir, "embeddings"))


ORACLES["op2_cover_tree_topk"] = """
with x as (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings),
v as (select vec_id, i, cast(floor(256 * cast(x as double)) as bigint) as x from x),
s as (select q.vec_id as query_id, d.vec_id as vec_id, cast(sum(q.x * d.x) as bigint) as score
      from v q join v d on q.i = d.i and q.vec_id % 50 = 0 and d.vec_id <> q.vec_id group by 1, 2)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 5
""".strip()


@query
def op3_sparse_suffix_dedup(spark, sf_dir):
    spans = suffixdedup.repeated_spans(_table(spark, sf_dir, "documents"))
    return spans.select("doc_id", F.explode("spans").alias("s")).select(
        "doc_id", F.col("s.start").alias("start_word"), F.col("s.end").alias("end_word"),
        F.col("s.later").alias("removed"))


ORACLES["op3_sparse_suffix_dedup"] = rf"""
with d as (select doc_id, regexp_extract_all(text, '{_WORD}') as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d where len(w) >= 50),
h as (select doc_id, i - 1 as pos, md5(array_to_string(list_slice(w, i, i + 49), ' ')) as h from p),
r as (select doc_id, pos, count(*) over (partition by h) as n,
             row_number() over (partition by h order by doc_id, pos) > 1 as removed from h),
s as (select doc_id, pos, removed, case when pos <= lag(pos) over (partition by doc_id, removed order by pos) + 50
                                       then 0 else 1 end as fresh from r where n > 1),
k as (select *, sum(fresh) over (partition by doc_id, removed order by pos) as span from s)
select doc_id, cast(min(pos) as integer) as start_word, cast(max(pos) + 50 as integer) as end_word, removed
from k group by doc_id, removed, span
""".strip()


@query
def op4_bpe_transducer(spark, sf_dir):
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), keep=["doc_id"], with_ids=False)


@query
def op5_url_boosted_trees(spark, sf_dir):
    return urls.judge(_table(spark, sf_dir, "pages"), keep=["page_id"])


@query
def op6_simhash_pivots(spark, sf_dir):
    near = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op7_repetition_rules(spark, sf_dir):
    judged = repetition.assess(_table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.drop("sa_longest").withColumnRenamed("sa_covered_words", "covered_words")


def _repeated_words(n: int) -> str:
    """Windows of n words that occur twice in a document."""
    return rf"""(select doc_id, i from (
    select doc_id, i, count(*) over (partition by doc_id, h) as c from (
      select doc_id, i, md5(array_to_string(list_slice(w, i, i + {n - 1}), ' ')) as h
      from (select doc_id, w, unnest(range(1, len(w) - {n - 2})) as i from d where len(w) >= {n}))) where c > 1)"""


# The words of all repeats of 8 words or more are those of the repeated 8-word windows, and a repeat
# of more than 100 words is a repeated 101-word window.
ORACLES["op7_repetition_rules"] = rf"""
with d as (select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
l as (select doc_id, count(*) - count(distinct line) as n from (
        select doc_id, unnest(string_split(t, chr(10))) as line from d)
      where regexp_matches(line, '{_WORD}') group by doc_id),
a as (select doc_id, count(distinct j) as n from (
        select doc_id, unnest(range(i, i + 3)) as j from {_repeated_words(3)}) group by doc_id),
b as (select doc_id, count(distinct j) as n from (
        select doc_id, unnest(range(i, i + 8)) as j from {_repeated_words(8)}) group by doc_id),
c as (select distinct doc_id from {_repeated_words(101)}),
m as (select d.doc_id, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
             cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
             coalesce(l.n, 0) as n_dup_lines, coalesce(a.n, 0) as n_repeat_words, coalesce(b.n, 0) as covered_words,
             c.doc_id is not null as long_repeat
      from d left join l on l.doc_id = d.doc_id left join a on a.doc_id = d.doc_id left join b on b.doc_id = d.doc_id
      left join c on c.doc_id = d.doc_id),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, base_failed,
       not base_failed and covered_words <= 0.4 * n_words and not long_repeat as kept
from f
""".strip()


@query
def op8_warc_round_trip(spark, sf_dir):
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op8_warc_round_trip"] = """
with p as (select page_id, coalesce(html, '') as body from pages),
q as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest,
             min(page_id) over (partition by sha256(body)) as first_id from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and page_id <> first_id then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id <> first_id then first_id end as refers_to
from q
""".strip()


@query
def op9_temperature_mix(spark, sf_dir):
    return mixing.mix_schedule(_table(spark, sf_dir, "documents"))


@query
def op10_suffix_tree_scores(spark, sf_dir):
    return pst.score_documents(_table(spark, sf_dir, "documents"))


_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query
def op11_minhash_near_duplicates(spark, sf_dir):
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


ORACLES["op11_minhash_near_duplicates"] = rf"""
with recursive d as (select doc_id, regexp_extract_all({_LOWERED}, '{_WORD}') as w from documents),
s as (select distinct doc_id, md5(x) as x from (
        select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
          else list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' ')) end) as x from d)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.x = b.x and a.doc_id <> b.doc_id group by all),
l as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 85 * (x.n + y.n - c)),
r as (select doc_id as doc, doc_id as reach from d union select r.doc, l.b from r join l on l.a = r.reach),
m as (select doc, min(reach) as low from r group by doc)
select d.doc_id, coalesce(n.n, 0) as n_shingles, m.low as component_id, d.doc_id = m.low as kept
from d join m on m.doc = d.doc_id left join n on n.doc_id = d.doc_id
""".strip()


@query
def op12_phrase_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


ORACLES["op12_phrase_collocations"] = rf"""
with d as (select coalesce(lang, 'und') as lang,
             {_LOWERED} as t from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from p),
g as (select lang, unnest(range(1, len(w) + 1)) as i, w from w),
e as (select lang, i, w, unnest(range(1, 5)) as m from g),
f as (select lang, m, array_to_string(list_slice(w, i, i + m - 1), ' ') as phrase, count(*) as f
      from e where i + m - 1 <= len(w) group by all having count(*) >= 30),
n as (select lang, cast(sum(len(w)) as bigint) as n from w group by lang),
c as (select lang, m, phrase, f as a, string_split(phrase, ' ') as w from f where m > 1),
k as (select *, unnest(range(1, m)) as k from c),
s as (select k.lang, k.m, k.phrase, k.a, k.k, x.f as l, y.f as r,
        cast(2000000 * cast(k.a as hugeint) // (x.f + y.f) as bigint) as score
      from k join f x on x.lang = k.lang and x.phrase = array_to_string(list_slice(k.w, 1, k.k), ' ')
             join f y on y.lang = k.lang and y.phrase = array_to_string(list_slice(k.w, k.k + 1, k.m), ' ')),
b as (select *, row_number() over (partition by lang, phrase order by score, k) as low from s qualify low = 1),
i as (select lang, a, w, m, unnest(range(1, m)) as pos from c),
j as (select lang, a, w, m, pos, unnest(range(2, m)) as size from i),
x as (select lang, array_to_string(list_slice(w, pos, pos + size - 1), ' ') as phrase, max(a) as longer
      from j where pos + size - 1 <= m group by all),
z as (select b.* from b left join x on x.lang = b.lang and x.phrase = b.phrase
      where x.longer is null or 100 * cast(x.longer as hugeint) < 80 * cast(b.a as hugeint)),
o as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from z)
select lang, rank, phrase, a, l, r, n, score from o join n using (lang) where rank <= 2000
""".strip()


@query
def op13_conversation_repair(spark, sf_dir):
    convs = _table(spark, sf_dir, "conversations")
    return conversations.audit(convs, conversations.damage(convs))


def _least(*ways: str) -> str:
    """The way of least cost, then of the least edits."""
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(cost: str, edit: str, line: str, after: str) -> str:
    return f"{{'c': {after}.c + {cost}, 'x': '{edit}' || {after}.x, 'r': list_prepend({line}, {after}.r)}}"


def _state(after: str, user: str, assistant: str, system: str | None) -> str:
    """The ways on from a state: delete, or keep or rerole to a role that may follow."""
    ways = [f"{{'c': {after}.c + 4, 'x': 'D' || {after}.x, 'r': {after}.r}}"]
    for initial, name, to in (("s", None, system), ("u", "user", user), ("a", "assistant", assistant)):
        if to:
            bad = f"case when must or initial <> '{initial}' then 1000000000 else cut end"
            ways.append(_way(bad, "K", "role || ':' || text", to))
            if name:
                ways.append(_way("case when must then 1000000000 else cut + 3 end", "R", f"'{name}:' || text", to))
    return _least(*ways)


def _inserted(e: str, s: str, u: str, a: str) -> str:
    """The four states as columns, with inserted rows."""
    return f"""select *, {_least("be", _way("3", "I", "'user:'", "u"))} as e, {_least("bs", _way("3", "I", "'user:'", "u"))} as s
from (select *, {_least("bu", _way("3", "I", "'assistant:'", "ba"))} as u, {_least("ba", _way("3", "I", "'user:'", "bu"))} as a
from (select *, {e} as be, {s} as bs, {u} as bu, {a} as ba from"""


_END = "{'c': cast(0 as bigint), 'x': '', 'r': cast([] as varchar[])}"
_NO_END = "{'c': cast(1000000000 as bigint), 'x': '', 'r': cast([] as varchar[])}"

ORACLES["op13_conversation_repair"] = rf"""
with recursive t as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
        lambda c, x: xor(c >> 1, 3988292384 * (c & 1)))) as t),
k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ') as key from conversations),
m as (select conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: cast(ascii(c) as bigint))),
        lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 as kind from k, t),
d as (select conv_id, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
        unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) as copy from m),
o as (select *, row_number() over w as i, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as seen,
        lag(role[1]) over w || role[1] as two, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body
      from d window w as (partition by conv_id order by turn nulls first, role, text, copy)),
f as (select *, case when body = '' then 'blank' when seen > 1 then 'duplicate' when body[-1] not in ('.', '!', '?') then 'truncated' end as fault from o),
g as (select conv_id, cast(coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as bigint) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated, count(*) filter (two not in ('su', 'ua', 'au')) as illegal,
        max(i) as n from f group by conv_id),
r as (select conv_id, i, role, text, role[1] as initial, coalesce(fault in ('blank', 'duplicate'), false) as must,
        case when fault = 'truncated' then 3 else 0 end as cut from f),
p as (select conv_id, i, e, s, u, a from ({_inserted(_END, _NO_END, _NO_END, _END)} (select conv_id, n + 1 as i from g))))
      union all
      select conv_id, i, e, s, u, a from ({_inserted(_state("p.e", "p.u", None, "p.s"), _state("p.s", "p.u", None, None),
                                                     _state("p.u", None, "p.a", None), _state("p.a", "p.u", None, None))}
        (select r.*, p from r join p on p.conv_id is not distinct from r.conv_id and p.i = r.i + 1))))),
z as (select conv_id, e.c as cost, e.x as audit, sha256(array_to_string(e.r, chr(10))) as repaired_sha256 from p where i = 1)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0) as cost, coalesce(audit, '') as audit,
       coalesce(repaired_sha256, sha256('')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join g on g.conv_id is not distinct from c.conv_id left join z on z.conv_id is not distinct from c.conv_id
""".strip()

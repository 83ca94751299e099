"""The registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, with SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import rounded
from . import ann, bpe, conversations, decontamination, exact_dedup, quality, sharding, simhash, spelling, substring_dedup, token_counts, toxicity, url_filter
from .common import table, written

#: Vocabulary of ops 5 and 10.
VOCABULARY = "word_bpe_49k.json"
#: Tokens beyond which op10 marks a document.
TOKEN_LIMIT = 2048
#: Shards of op6.
SHARDS = 40


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality(spark, sf_dir):
    docs = written(quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")).drop("text"))
    done = quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))
    return done.select("doc_id", *[rounded(c, 6).alias(c) for c in ("host_share", "path_share", "evidence", "p_good")], "keep")


def op2_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_urls(spark, sf_dir):
    """Labels of a page: those of the document of its id; bad is a low quality or a toxic one."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    mined = url_filter.mine(pages.join(labels.hint("merge"), "page_id").select("url", "bad"))
    return url_filter.judge(pages, mined).select("page_id", "host", "path", "rule", "verdict", "confidence")


def op4_decontamination(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op5_bpe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = bpe.encode(docs, bpe.Vocabulary(spark, vocabulary_path()), decoded="decoded")
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op6_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
    )
    done = sharding.shard(docs, "doc_id", sharding.equal_shards(SHARDS), grown=sharding.equal_shards(SHARDS + 1))
    return done.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op7_simhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = simhash.near_duplicates(docs)
    return done.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs, model).select("doc_id", F.expr(toxicity.held_out_sql("doc_id")).alias("held_out"), "score", "predicted")


def op9_substring_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = substring_dedup.remove_repeats(docs)
    return done.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


def op10_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    done = token_counts.count_tokens(docs, bpe.Vocabulary(spark, vocabulary_path()))
    return done.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op11_conversation_repair(spark, sf_dir):
    return conversations.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_exact_dedup(spark, sf_dir):
    return exact_dedup.mark(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_spelling_variants(spark, sf_dir):
    return spelling.variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op1_quality": op1_quality, "op2_ann": op2_ann, "op3_urls": op3_urls, "op4_decontamination": op4_decontamination, "op5_bpe": op5_bpe, "op6_sharding": op6_sharding, "op7_simhash": op7_simhash, "op8_toxicity": op8_toxicity, "op9_substring_dedup": op9_substring_dedup, "op10_token_counts": op10_token_counts, "op11_conversation_repair": op11_conversation_repair, "op12_exact_dedup": op12_exact_dedup, "op13_spelling_variants": op13_spelling_variants}

_OP9_SQL = r"""with d as (select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (select r, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35),
c as (select r, i, array_to_string(w[i:i + 34], ' ') as t from s),
repeated as (select r, i from c where t in (select t from c group by t having count(*) > 1)),
gone as (select r, list_sort(list_distinct(flatten(list(range(i, i + 35))))) as g from repeated group by r),
k as (select doc_id, w, coalesce(g, []) as g from d left join gone using (r))
select doc_id, len(w) as n_words, len(g) as n_removed,
  sha256(array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda p: not list_contains(g, p)), lambda p: w[p]), ' ')) as kept_sha256 from k"""

_OP1_SQL = rf"""with w as (select doc_id, source as host, lang as path, coalesce(text, '') as t, string_split(coalesce(text, ''), chr(10)) as l,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from documents),
x as (select doc_id, host, path, greatest(len(ws), 1) as n, length(t) as chars, len(l) as lines,
    length(t) - length(translate(t, '{quality.SIGNS}', '')) as signs, length(t) - length(translate(t, '.,', '')) as stops, length(regexp_replace(t, '\P{{Lu}}+', '', 'g')) as uppers,
    len(list_distinct(ws)) as distinct_words, len(list_distinct(l)) as distinct_lines, len(list_filter(range(2, len(ws) + 1), lambda i: ws[i] = ws[i - 1])) as again from w),
b as (select doc_id, host, path, label, unnest([
    {{'m': 'signs', 'bin': least(floor((10 * signs + n - 1) / n), 19)}}, {{'m': 'again', 'bin': least(floor(20 * again / n), 19)}}, {{'m': 'stops', 'bin': least(floor(20 * stops / n), 19)}},
    {{'m': 'upper', 'bin': least(floor(20 * uppers / greatest(chars, 1)), 19)}}, {{'m': 'distinct', 'bin': least(floor(20 * distinct_words / n), 19)}},
    {{'m': 'lines', 'bin': least(floor(20 * distinct_lines / greatest(lines, 1)), 19)}}, {{'m': 'length', 'bin': least(floor(chars / n), 19)}}], recursive := true)
  from x left join (select doc_id, min(quality) as label from labels where quality in (0, 1) group by 1) using (doc_id)),
g as (select count(*) filter (label = 1) as good, count(*) filter (label = 0) as bad from b where m = 'signs'),
c as (select m, bin, count(*) filter (label = 1) as good, count(*) filter (label = 0) as bad from b group by 1, 2),
r as (select m, bin, ln((c.good + 1.0) / (g.good + 20.0)) - ln((c.bad + 1.0) / (g.bad + 20.0)) as ratio from c, g),
e as (select doc_id, host, path, any_value(label) as label, sum(ratio) as evidence from b join r using (m, bin) group by 1, 2, 3),
p as (select e.*, coalesce(label::double, 1 / (1 + exp(-(ln(s / (1 - s)) + evidence)))) as belief from e, (select (good + 1.0) / (good + bad + 2.0) as s from g)),
ps as (select host, path, count(*) as n, sum(belief) as good from p group by 1, 2), hs as (select host, sum(n) as n, sum(good) as good from ps group by 1),
a as (select (sum(good) + 1) / (sum(n) + 2) as share, sum(n) as n, count(*) as groups from hs),
hk as (select least(1e6, greatest(1.0, (share * (1 - share)) / greatest(sum(hs.n * power(hs.good / hs.n - share, 2)) / any_value(a.n) - share * (1 - share) * any_value(groups) / any_value(a.n), 1e-9) - 1)) as k from hs, a group by share),
h as (select host, (good + k * share) / (hs.n + k) as host_share from hs, hk, a),
j as (select ps.*, host_share from ps join h on ps.host is not distinct from h.host),
v as (select sum(n) as n, count(*) as groups, sum(n * power(good / n - host_share, 2)) as spread, sum(n * host_share * (1 - host_share)) as chance from j),
pk as (select least(1e6, greatest(1.0, (chance / n) / greatest(spread / n - chance / n * groups / n, 1e-9) - 1)) as k from v),
q as (select host, path, host_share, (good + k * host_share) / (n + k) as path_share from j, pk),
f as (select doc_id, host_share, path_share, evidence, 1 / (1 + exp(-(ln(greatest(least(path_share, 1 - 1e-6), 1e-6) / (1 - greatest(least(path_share, 1 - 1e-6), 1e-6))) + evidence))) as p_good
  from e join q on e.host is not distinct from q.host and e.path is not distinct from q.path)
select doc_id, round(host_share, 6) as host_share, round(path_share, 6) as path_share, round(evidence, 6) as evidence, round(p_good, 6) as p_good, p_good >= 0.5 as keep from f"""

_OP12_SQL = r"""with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as h from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = min(doc_id) over w as kept, h as text_sha256 from d window w as (partition by h)"""

#: CRC-32 of a list ``b`` of bytes, bit by bit.
_CRC32 = "xor(list_reduce(b, lambda c, x: list_reduce([0, 1, 2, 3, 4, 5, 6, 7], lambda y, i: xor(y >> 1, 3988292384 * (y & 1)), xor(c, x)), 4294967295::bigint), 4294967295)"
_BYTES = "list_transform(range(0, octet_length(encode({0}))), lambda i: ('0x' || substr(hex(encode({0})), 2 * i + 1, 2))::bigint)"
_OP13_SQL = rf"""with recursive t as (select coalesce(doc_id::varchar, '') as k, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]{{5,}}')) as run from documents),
d as (select k, run, count(*) as n from t group by 1, 2), e as (select *, {_BYTES.format("(k || ':' || run)")} as b from d), h as (select run, n, {_CRC32} as h from e),
o as (select case when h % 97 = 0 then run[:h % length(run)] || run[h % length(run) + 2:] else run end as word, n from h),
v as (select word, sum(n)::bigint as n from o where length(word) >= 5 group by 1 having sum(n) >= 3),
p as (select word, n, unnest(range(1, length(word) + 1)) as i from v),
m as (select word, n, i, word[:i - 1] as a, word[i + 1:] as z from p), s as (select distinct word, n, a || z as short from m),
near as (select x.word, y.word as other, y.n from m x join m y on x.i = y.i and x.a = y.a and x.z = y.z and x.word <> y.word
  union all select s.word, v.word, v.n from s join v on s.short = v.word union all select v.word, s.word, s.n from s join v on s.short = v.word),
g as (select word, count(*) as n_near, min((-n, other)) as best from near group by 1),
f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when -best[1] >= 2 * v.n then best[2] end as form, case when -best[1] >= 2 * v.n then -best[1] end as form_n from v left join g using (word)),
r as (select word, word as root from f where form is null union all select f.word, r.root from f join r on f.form = r.word)
select word, form, root, n, n_near, form_n from f join r using (word)"""



def _op11_sql() -> str:
    """The best audits of what follows each row, from the last row back, for each of the four states before it."""

    def best(*ways):
        return f"list_min([{', '.join(ways)}])"

    def way(cost, letters, rest, said=""):
        return f"{{'c': {rest}.c + {cost}, 'a': '{letters}' || {rest}.a, 't': {f'[{said}] || ' if said else ''}{rest}.t}}"

    def unless(bad, then):
        return f"case when {bad} then {{'c': 1000000000, 'a': '', 't': []::varchar[]}} else {then} end"

    kept = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    role = {2: "'user:'", 3: "'assistant:'"}
    goes = {0: 2, 1: 2, 2: 3, 3: 2}
    rows = []
    for q in range(4):
        keeps = [unless(f"must or i <> '{i}'", way("m", "K", f"w{to}", "line")) for i, to in kept[q].items()]
        rows.append(f"{best(way(4, 'D', f'w{q}'), *keeps, unless('must', way('3 + m', 'R', f'w{goes[q]}', f'{role[goes[q]]} || text')))} as b{q}")
    ends = []
    for q in range(4):
        one = goes[q]
        two = [way(6, "II", f"b{goes[one]}", f"{role[one]}, {role[goes[one]]}")] if q < 2 else []
        ends.append(f"{best(f'b{q}', way(3, 'I', f'b{one}', role[one]), *two)} as w{q}")
    none = "[]::varchar[]"
    return rf"""with recursive o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations),
ob as (select *, {_BYTES.format("k")} as b from o), oh as (select * exclude (b), {_CRC32} % 20 as h from ob),
d as (select conv_id, turn, case when h = 4 then 'user' else role end as role, case when h = 1 then '' when h = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case when h = 3 then 2 else 1 end)) as copy from oh where h <> 0),
f as (select *, regexp_replace(text, '[ 	-
]+$', '') as bare, row_number() over w as r, lag(role[1]) over w as before, row_number() over (partition by conv_id, role, text order by turn nulls first, copy) as again
    from d window w as (partition by conv_id order by turn nulls first, role, sha256(text), copy)),
g as (select *, bare = '' as blank, bare <> '' and again > 1 as dup, bare <> '' and again = 1 and bare[-1] not in ('.', '!', '?') as cut from f),
j as (select conv_id, r, role[1] as i, text, role || ':' || text as line, blank or dup as must, case when cut then 3 else 0 end as m from g),
s as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count_if(blank) as blank, count_if(dup) as duplicate, count_if(cut) as truncated,
    count_if(before is not null and before || role[1] not in ('su', 'ua', 'au')) as illegal, count(*) as n from g group by 1),
p as (select conv_id, n as r, {{'c': 0, 'a': '', 't': {none}}} as w0, {{'c': 6, 'a': 'II', 't': ['user:', 'assistant:']}} as w1, {{'c': 3, 'a': 'I', 't': ['assistant:']}} as w2, {{'c': 0, 'a': '', 't': {none}}} as w3 from s
  union all select conv_id, r, {', '.join(ends)} from (select p.conv_id, p.r - 1 as r, {', '.join(rows)} from p join j on p.conv_id is not distinct from j.conv_id and p.r = j.r)),
e as (select conv_id, w0 from p where r = 0)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal,
  coalesce(w0.c, 0)::bigint as cost, coalesce(w0.a, '') as audit, sha256(coalesce(array_to_string(w0.t, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c left join s on c.conv_id is not distinct from s.conv_id left join e on c.conv_id is not distinct from e.conv_id"""


#: Plain SQL for the same rows; the other operators need hashes, models or libraries that SQL lacks, and have tests instead.
SQL: dict[str, str] = {"op1_quality": _OP1_SQL, "op9_substring_dedup": _OP9_SQL, "op11_conversation_repair": _op11_sql(), "op12_exact_dedup": _OP12_SQL, "op13_spelling_variants": _OP13_SQL}

"""Registered queries of this folder and, where SQL can say it, their oracle SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    chat_format, decontamination, exact_dedup, filter_audit, importance, jaccard_join, language_id, license_scan,
    line_dedup, personal_data, sentencepiece_bpe, substring_dedup, toxicity,
)
from millrace.llm.common import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sentencepiece_bpe.tokenize(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return out.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digests(substring_dedup.remove_repeats(table(spark, sf_dir, "documents")))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(
        spark.createDataFrame(
            [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
        )
    )
    chats = chat_format.format_conversations(rows)
    read = chat_format.read_back(chats)
    return read.select(
        "conv_id", "n_turns", F.sha2("turns_text", 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "rewrites",
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def _remainder(modulus: int) -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(modulus))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), _remainder(5) != 0)
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    content = language_id.train(docs, _remainder(4) != 2)
    return language_id.identify(docs, content).select(
        "doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), F.col("lang").alias("lang_pred"),
        "score", "narrow",
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"), keep="largest", ascii_case=True)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.find(table(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in personal_data.BASE],
        F.sha2(_listed(of(*personal_data.BASE)), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_sentencepiece, op3_decontamination, op4_substring_dedup, op5_chat_format, op6_license_scan,
    op7_toxicity, op8_line_dedup, op9_language_id, op10_exact_dedup, op11_filter_audit,
    op12_importance_resampling, op13_personal_data,
)}

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op3_decontamination": r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
  from documents where doc_id is not null),
i as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') as w
  from benchmark where item_id is not null),
ish as (
  select distinct item_id, least(len(w), 5) as size, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
    lambda p: array_to_string(w[p:p + least(len(w), 5) - 1], ' '))) as s
  from i where len(w) > 0),
sizes as (select distinct size from ish),
dsh as (
  select distinct doc_id, size, unnest(list_transform(range(1, greatest(len(w) - size + 1, 0) + 1),
    lambda p: array_to_string(w[p:p + size - 1], ' '))) as s
  from w, sizes),
n as (select item_id, count(*) as n_shingles from ish group by all),
hit as (select doc_id, item_id, count(*) as n_shared from dsh join ish using (size, s) group by all)
select doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles as containment
from hit join n using (item_id) where n_shared * 100 >= n_shingles * 80""",
    "op4_substring_dedup": r"""
with w as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
win as (
  select doc_id, unnest(range(1, greatest(len(w) - 12, 0) + 1)) as p,
    unnest(list_transform(range(1, greatest(len(w) - 12, 0) + 1), lambda p: array_to_string(w[p:p + 12], ' '))) as s
  from w),
first as (select s, min(doc_id) as f from win group by s having count(distinct doc_id) > 1),
lost as (select doc_id, list(p) as ps from win join first using (s) where doc_id > f group by doc_id),
gone as (select doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 13)))) as g from lost),
marked as (
  select doc_id, unnest(range(1, len(w) + 1)) as i, unnest(w) as word from w),
removed as (select doc_id, unnest(g) as i, true as r from gone),
kept as (
  select doc_id, string_agg(word, ' ' order by i) as k from marked left join removed using (doc_id, i)
  where r is null group by doc_id)
select w.doc_id, len(w.w) as n_words, coalesce(len(gone.g), 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256
from w left join gone using (doc_id) left join kept using (doc_id)""",
    "op8_line_dedup": f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as place
  from documents),
k as (
  select *, {LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} as key from l),
f as (select key, min(doc_id) as first from k where length(key) >= 10 group by key having count(distinct doc_id) > 1),
m as (select k.*, f.first is not null and k.doc_id > f.first as gone from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by place) filter (not gone), '')) as kept_sha256
from m group by doc_id""",
    "op10_exact_dedup": f"""
with d as (select doc_id, {LOWER.format("coalesce(text, '')")} as body from documents),
g as (select body, max(doc_id) as keep_id, count(*) as group_size from d group by body)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
from d join g using (body)""",
    "op11_filter_audit": r"""
with d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
firsts as (select t, min(doc_id) as first from d group by t),
f as (
  select doc_id, part,
    (case when len(w) < 100 then 'A' else '' end)
    || (case when 100 * len(list_distinct(w)) < 80 * len(w) then 'B' else '' end)
    || (case when 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) then 'C' else '' end)
    || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
    || (case when doc_id > first then 'E' else '' end) as fails
  from d join firsts using (t)),
marks as (
  select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (select part, fails, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic from f left join marks using (doc_id)),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (
  select filter_order, step, filter_order[step] as it, filter_order[1:step - 1] as earlier
  from o, (select unnest(range(1, 6)) as step)),
r as (
  select part, filter_order, step::int as step, it, fails = it as only_it, contains(fails, it) as fails_it,
    fails <> '' and earlier <> '' and len(list_intersect(string_split(fails, ''), string_split(earlier, ''))) > 0 as gone, good, toxic from m, s),
g as (
  select part, filter_order, step, it, count(*) filter (not fails_it and not gone) as kept,
    count(*) filter (fails_it and not gone) as removed, count(*) filter (fails_it and gone) as redundant,
    count(*) filter (only_it) as unique_fails,
    coalesce(sum(good) filter (fails_it and not gone), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (fails_it and not gone), 0)::bigint as toxic_lost
  from r group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, it))::bigint as shapley from g""",
    "op12_importance_resampling": f"""
with steps as (
  select list_transform(range(256), lambda c: list_reduce(list_concat([c], range(8)),
    lambda a, i: xor(a >> 1, case when a & 1 = 1 then 3988292384 else 0 end))) as t),
texts as (
  select 0 as of, doc_id as id, text from documents union all select 1, item_id, text from benchmark),
words as (
  select of, id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")},
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') as w from texts),
grams as (
  select of, id, len(w) as n_words, unnest(list_concat(w,
    list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) as f
  from words),
counted as (select of, id, f, count(*) as n from grams group by all),
names as (select f, hex(encode(f)) as h from (select distinct f from counted)),
crcs as (
  select f, xor(list_reduce(list_concat([4294967295::bigint],
      list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % 10000 as bucket from names, steps),
hashed as (select of, id, bucket, sum(n)::bigint as n from counted join crcs using (f) group by all),
sums as (
  select bucket, coalesce(sum(n) filter (of = 0), 0)::double as s, coalesce(sum(n) filter (of = 1), 0)::double as t
  from hashed group by bucket),
gains as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from sums) + 10000)
    / ((s + 1) * ((select sum(t) from sums) + 10000))))::bigint as gain from sums),
weights as (
  select id as doc_id, sum(n)::bigint as n_features, sum(n * gain)::bigint as weight
  from hashed join gains using (bucket) where of = 0 group by id),
scored as (
  select words.id as doc_id, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || words.id), 1, 8))::bigint + 0.5::double)
      / 4294967296::double)))::bigint as score
  from words left join weights on words.id = doc_id where of = 0),
ranked as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place from scored)
select doc_id, n_features, weight, score,
  case when n_words >= 20 and place <= (select 5 * count(*) filter (n_words >= 20) // 100 from scored)
    then place end as rank
from ranked""",
}

"""Registered queries of the training-data operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitmill.llm import (
    chat, collocations, decontaminate, language, linededup, lmscore, packing, pii, quality, search,
    sentencepieces, simhash, tokencounts)

CHAT_VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
# A job passes a key of its own.
DEMONSTRATION_KEY = "demonstration only"
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.judged(docs, quality.fit(docs, table(spark, folder, "labels")))


def op2_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), WORD_VOCABULARY)


def op3_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return lmscore.scored(docs, lmscore.labelled_target(docs, table(spark, folder, "labels")))


def op4_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    odd = spark.range(2).selectExpr(
        "-1L as conv_id", "id as turn", "if(id = 0, 'user', 'assistant') as role",
        "'</s>[INST] ok [/INST]' as text")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    return chat.digests(chat.assembled(turns, *CHAT_VOCABULARY), *CHAT_VOCABULARY)


def op6_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where("doc_id is not null").where(~held))
    return language.identified(docs, model).withColumn("held_out", held)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return tokencounts.document_counts(table(spark, folder, "documents"), WORD_VOCABULARY)


def op8_pii_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pii.pseudonymised(table(spark, folder, "documents").select("doc_id", "text"), DEMONSTRATION_KEY)


def op9_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contamination(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.without_repeats(table(spark, folder, "documents")).select("doc_id", "text")


def op11_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    coded = sentencepieces.encoded(table(spark, folder, "documents"), PIECE_VOCABULARY)
    return sentencepieces.decoded(coded, PIECE_VOCABULARY).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))


def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return search.ranked(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": op1_quality_rules,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_lm_scoring": op3_lm_scoring,
        "op4_simhash_near_dedup": op4_simhash_near_dedup,
        "op5_chat_formatting": op5_chat_formatting,
        "op6_language_id": op6_language_id,
        "op7_token_counts": op7_token_counts,
        "op8_pii_pseudonyms": op8_pii_pseudonyms,
        "op9_benchmark_decontamination": op9_benchmark_decontamination,
        "op10_line_dedup": op10_line_dedup,
        "op11_sentencepiece": op11_sentencepiece,
        "op12_phrase_collocations": op12_phrase_collocations,
        "op13_ranked_search": op13_ranked_search,
    }


OP9_SQL = r"""
with lowered as (
  select 'd' as side, doc_id as id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
  union all
  select 'b', item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
  from benchmark),
words as (
  select side, id, coalesce(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as ws
  from lowered),
item_windows as (
  select distinct id as item_id, n, array_to_string(ws[i:i + n - 1], ' ') as span
  from (select id, ws, least(10, len(ws)) as n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) as i
        from words where side = 'b' and len(ws) > 0)),
doc_windows as (
  select id as doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') as span
  from (select id, ws, n, unnest(range(1, len(ws) - n + 2)) as i
        from words, (select distinct n from item_windows) where side = 'd' and len(ws) >= n)),
hits as (select doc_id, i, n, item_id from doc_windows join item_windows using (n, span)),
hit_words as (
  select doc_id, count(distinct place) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as place from (select distinct doc_id, i, n from hits))
  group by doc_id),
hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id)
select w.id as doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_hit, 0) as n_hit,
  coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words w left join hit_words h on h.doc_id = w.id left join hit_items i on i.doc_id = w.id
where side = 'd'
"""


OP5_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, case when t = 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]'
  from (select unnest([0, 1]) as t)),
shown as (
  select *, length(regexp_replace(regexp_replace(role || chr(10) || text,
    '<(\\*/?s>)', '<\\\1', 'g'), '\[(\\*/?INST\])', '[\\\1', 'g')) - 1 as chars
  from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(3 + sum(chars + length('[INST][/INST]</s>')) as bigint) as formatted_chars
from shown group by conv_id
"""


OP12_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, regexp_extract_all(p, '[^ \t]+') as ws
  from (select lang, unnest(regexp_split_to_array(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]')) as p
        from documents)),
totals as (select lang, sum(len(ws))::bigint as n from pieces group by lang),
f as (
  select lang, k, phrase, count(*) as f
  from (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase
        from (select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i
              from pieces, (select unnest([1, 2, 3]) as k) where len(ws) >= k))
  group by lang, k, phrase),
cand as (
  select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= 10),
cuts as (
  select lang, k, phrase, a, cut, array_to_string(ws[1:cut], ' ') as head, array_to_string(ws[cut + 1:], ' ') as rest
  from (select *, unnest(range(1, k)) as cut from cand)),
scored as (
  select c.lang, c.k, c.phrase, c.a, x.f as l, y.f as r, c.cut,
    (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from cuts c join f x on x.lang = c.lang and x.k = c.cut and x.phrase = c.head
  join f y on y.lang = c.lang and y.k = c.k - c.cut and y.phrase = c.rest),
lowest as (
  select * from scored qualify row_number() over (partition by lang, k, phrase order by score, cut) = 1),
longer as (
  select lang, part, max(a) as a
  from (select lang, a, unnest([array_to_string(ws[1:2], ' '), array_to_string(ws[2:3], ' ')]) as part
        from cand where k = 3)
  group by lang, part),
kept as (
  select s.* from lowest s left join longer g on s.k = 2 and g.lang = s.lang and g.part = s.phrase
  where g.a is null or 100 * g.a < 50 * s.a)
select lang, rank, phrase, a, l, r, n, score::bigint as score
from (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
join totals using (lang) where rank <= 2000
"""


OP13_SQL = r"""
with lowered as (
  select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
words as (
  select doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as ws from lowered),
sized as (select doc_id, ws, len(ws)::bigint as n from words where len(ws) > 0),
corpus as (select count(*) as docs, sum(n)::bigint as total from sized),
tf as (select doc_id, n, term, count(*) as tf from (select doc_id, n, unnest(ws) as term from sized) group by all),
df as (select term, count(*) as df from tf group by term),
weight as (
  select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w
  from df, corpus),
asked as (
  select item_id, term, count(*) as times
  from (select item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
        from benchmark)
  group by all),
scores as (
  select item_id, doc_id, cast(sum(times * w * (
    (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // total))))) as bigint) as score
  from asked join weight using (term) join tf using (term), corpus
  group by item_id, doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank
      from scores where score > 0)
where rank <= 20
"""


def oracles() -> dict[str, str]:
    return {
        "op5_chat_formatting": OP5_SQL,
        "op9_benchmark_decontamination": OP9_SQL,
        "op12_phrase_collocations": OP12_SQL,
        "op13_ranked_search": OP13_SQL,
    }

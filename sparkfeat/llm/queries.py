"""The text operators as queries over the synthetic tables, with SQL twins where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkfeat.llm.centroids import cluster_vectors, inertias
from sparkfeat.llm.chat import BUDGET, END, ESCAPES, HISTORY, OPEN, SHUT, SYSTEM, TARGET, format_windows, read_windows
from sparkfeat.llm.common import fresh_path
from sparkfeat.llm.langid import train_languages
from sparkfeat.llm.license_scan import TEMPLATES, scan_licenses
from sparkfeat.llm.mixing import SLACK, mix_sources, topic_of
from sparkfeat.llm.outliers import quality_rules
from sparkfeat.llm.product_codes import compress_vectors
from sparkfeat.llm.quality import QualityModel, train_quality
from sparkfeat.llm.sharding import assign_shards
from sparkfeat.llm.simhash import near_duplicates
from sparkfeat.llm.token_files import ids_crc32, with_starts, write_tokens
from sparkfeat.llm.url_filter import Rule, filter_urls
from sparkfeat.llm.wu_manber import find_passages, hit_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{table}.parquet")


#: Bytes of text in a shard.
SHARD_BYTES = 1 << 20


def op1_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """The shard of each document, its bytes and its documents."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    shard = assign_shards(docs, SHARD_BYTES)
    return shard.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"),
        F.col("shard.label").alias("shard"),
        F.col("shard.size").alias("shard_bytes"),
        F.col("shard.n").alias("shard_docs"),
    )


QUERIES["op1_sharding"] = op1_sharding
ORACLES["op1_sharding"] = f"""
with d as (
  select doc_id, strlen(coalesce(text, '')) as n_bytes, coalesce(cast(doc_id as varchar), '') as k, coalesce(text, '') as t
  from documents),
c as (select doc_id, n_bytes, cast('0x' || substr(md5(k), 1, 8) || substr(md5(k || chr(31) || t), 1, 7) as bigint) as code from d),
up as (select doc_id, n_bytes, code, depth, code >> (60 - depth) as prefix from c, (select unnest(range(0, 61)) as depth)),
nodes as (
  select depth, prefix, sum(n_bytes) as shard_bytes, count(*) as shard_docs
  from up group by depth, prefix having sum(n_bytes) <= {SHARD_BYTES} or min(code) = max(code)),
best as (select doc_id, n_bytes, min(depth) as depth, any_value(code) as code from up join nodes using (depth, prefix) group by doc_id, n_bytes)
select doc_id, cast(n_bytes as bigint) as n_bytes,
       right(lpad(bin(code >> (60 - best.depth)), 60, '0'), best.depth) as shard,
       cast(shard_bytes as bigint) as shard_bytes, shard_docs
from best join nodes on nodes.depth = best.depth and nodes.prefix = (code >> (60 - best.depth))"""


#: Wanted shares of tokens: the hot source is held down, small languages are raised. Other sources and languages,
#: and rows without one, have a share too; a topic is one of the four.
TARGETS = {
    "source": {"src0": 0.20, **{f"src{i}": 0.04 for i in range(1, 20)}},
    "lang": {"en": 0.50, "de": 0.18, "fr": 0.18, "es": 0.12},
    "topic": {"prose": 0.90, "numbers": 0.05, "legal": 0.03, "tables": 0.02},
}


def mixed(docs: DataFrame, out: str = "mix") -> DataFrame:
    """``docs`` with their chance to be sampled under ``TARGETS``."""
    dimensions = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}
    return mix_sources(docs, TARGETS, dimensions, out=out)


def op2_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """The raked probability of each document, and whether it is sampled."""
    docs = _read(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return mixed(docs).select(
        "doc_id",
        topic_of(F.col("text")).alias("topic"),
        F.col("mix.tokens").alias("n_tokens"),
        F.round("mix.probability", 6).alias("probability"),
        F.col("mix.kept").alias("kept"),
    )


def _sql_shares() -> str:
    rows = [f"('{d}', '{v}', {share})" for d, values in TARGETS.items() for v, share in values.items()]
    rest = [f"('{d}', 'other', {max(0.0, 1.0 - sum(values.values()))})" for d, values in TARGETS.items()]
    return ", ".join(rows + rest)


def _sql_category(dim: str, value: str) -> str:
    names = ", ".join(f"'{v}'" for v in TARGETS[dim])
    return f"case when {value} in ({names}) then {value} else 'other' end"


QUERIES["op2_mixing"] = op2_mixing
ORACLES["op2_mixing"] = rf"""
with recursive t as (
  select doc_id, text, lang, source,
         case when regexp_matches(coalesce(text, ''), '(?i)licen[cs]e') then 'legal'
              when contains(coalesce(text, ''), ' | ') then 'tables'
              when regexp_matches(coalesce(text, ''), '[0-9]{{3}}') then 'numbers' else 'prose' end as topic,
         len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) as n_tokens,
         cast('0x' || substr(md5('mix' || chr(31) || coalesce(cast(doc_id as varchar), '') || chr(31) || coalesce(text, '')), 1, 13) as bigint)
           / cast(4503599627370496 as double) as draw
  from documents),
d as (
  select *, {_sql_category("source", "source")} as s, {_sql_category("lang", "lang")} as l, {_sql_category("topic", "topic")} as c from t),
cells as (select s, l, c, sum(n_tokens) as w from d group by s, l, c having sum(n_tokens) > 0),
shares as (select * from (values {_sql_shares()}) as v(dim, value, share)),
reach as (
  select dim, value, share / sum(share) over (partition by dim) as share
  from shares
  where (dim, value) in (select ('source', s) from cells union select ('lang', l) from cells union select ('topic', c) from cells)),
held as (
  select dim, value, share, sum(w) / (select sum(w) from cells) as held
  from reach join (select 'source' as dim, s as value, w from cells union all select 'lang', l, w from cells
                   union all select 'topic', c, w from cells) using (dim, value)
  where share > 0 group by dim, value, share),
bounds as (
  select sum(share) over o as asked, sum(held) over o as given
  from held window o as (partition by dim order by held / share, value rows between unbounded preceding and current row)),
size as (select least(1.0, min(given / (asked - {SLACK})) filter (where asked > {SLACK})) as keep from bounds),
total as (select keep, keep * cast(sum(w) as double) as wanted from cells, size group by keep),
fit as (
  select 0 as k, keep, s, l, c, cast(w as double) as w, cast(1 as double) as f,
         least(rs.share * wanted, sum(w) over (partition by s)) as gs,
         least(rl.share * wanted, sum(w) over (partition by l)) as gl,
         least(rc.share * wanted, sum(w) over (partition by c)) as gc
  from cells cross join total
  join reach rs on rs.dim = 'source' and rs.value = s
  join reach rl on rl.dim = 'lang' and rl.value = l
  join reach rc on rc.dim = 'topic' and rc.value = c
  union all
  select k + 1, keep, s, l, c, w,
         f * case k % 3 when 0 then gs / sum(w * least(1.0, keep * f)) over (partition by s)
                        when 1 then gl / sum(w * least(1.0, keep * f)) over (partition by l)
                        else gc / sum(w * least(1.0, keep * f)) over (partition by c) end,
         gs, gl, gc
  from fit where k < 150),
last as (select s, l, c, least(1.0, keep * f) as p from fit where k = 150)
select doc_id, topic, n_tokens, round(coalesce(p, 0.0), 6) as probability, draw < coalesce(p, 0.0) as kept
from d left join last using (s, l, c)"""


def op3_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    """How many units of each document match a licence, which licences, and the best match."""
    found = scan_licenses(_read(spark, sf, "documents").select("doc_id", "text"))
    names = F.array_sort(F.array_distinct(F.transform("licenses", lambda m: m["license"])))
    return found.select(
        "doc_id",
        F.size("licenses").cast("bigint").alias("n_matches"),
        F.array_join(names, ",").alias("licenses"),
        F.round(F.coalesce(F.array_max(F.transform("licenses", lambda m: m["similarity"])), F.lit(0.0)), 6).alias("similarity"),
    )


def _sql_grams(text: str) -> str:
    words = f"list_filter(string_split_regex(lower({text}), '[^a-z0-9]+'), lambda x: x <> '')"
    return f"list_distinct(list_transform(generate_series(1, len({words}) - 1), lambda i: ({words})[i] || ' ' || ({words})[i + 1]))"


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


QUERIES["op3_license_scan"] = op3_license_scan
ORACLES["op3_license_scan"] = f"""
with t as (
  select name, {_sql_grams("body")} as g
  from (values {", ".join(f"({_sql_text(n)}, {_sql_text(b)})" for n, b in TEMPLATES.items())}) as v(name, body)),
d as (select doc_id, coalesce(text, '') as text from documents),
p as (select doc_id, text, string_split_regex(text, '\n[ \t\r]*\n') as paragraphs from d),
units as (
  select doc_id, unnest(string_split(text, chr(10))) as unit from d
  union all select doc_id, unit from (select doc_id, unnest(paragraphs) as unit from p) where contains(unit, chr(10))
  union all select doc_id, text from p where len(paragraphs) > 1),
u as (
  select row_number() over () as k, doc_id, words
  from (select doc_id, list_filter(string_split_regex(lower(unit), '[^a-z0-9]+'), lambda x: x <> '') as words from units)
  where len(words) > 1),
g as (select k, doc_id, list_distinct(list_transform(generate_series(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1])) as g from u),
m as (
  select k, doc_id, name, 2.0::double * len(list_intersect(g.g, t.g)) / (len(g.g) + len(t.g)) as similarity
  from g join t on 2.0 * least(len(g.g), len(t.g)) / (len(g.g) + len(t.g)) >= 0.8),
best as (
  select doc_id, k, max(similarity) as similarity, arg_max(name, (similarity, name)) as name
  from m where similarity >= 0.8 group by doc_id, k),
per as (
  select doc_id, count(*) as n, string_agg(distinct name, ',' order by name) as names, max(similarity) as s from best group by doc_id)
select doc_id, coalesce(n, 0) as n_matches, coalesce(names, '') as licenses, round(coalesce(s, 0.0), 6) as similarity
from d left join per using (doc_id)"""


def op4_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Base rules and robust outlier verdict of each document."""
    judged = quality_rules(_read(spark, sf, "documents"))
    return judged.withColumn("distance", F.round("distance", 3))


QUERIES["op4_quality_rules"] = op4_quality_rules


def op5_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Words of each document that lie in a passage of ten words of a benchmark item."""
    found = find_passages(_read(spark, sf, "documents").select("doc_id", "text"), _read(spark, sf, "benchmark"))
    n_hit = hit_words(F.col("found"))
    return found.select(
        "doc_id",
        "found.n_words",
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


QUERIES["op5_decontaminate"] = op5_decontaminate

SQL_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ORACLES["op5_decontaminate"] = rf"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), {SQL_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), {SQL_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
windows as (
  select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select item_id, w, least(10, len(w)) as n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from b where len(w) > 0)),
grams as (
  select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, (select distinct n from windows) where len(w) >= n)),
hits as (select doc_id, i, grams.n, item_id from grams join windows using (n, gram)),
covered as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(name, ',' order by name) as names
  from (select distinct doc_id, cast(item_id as varchar) as name from hits) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (doc_id) left join named using (doc_id)"""


def id_remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % n


def op6_language(spark: SparkSession, sf: str) -> DataFrame:
    """The language of each document by centroids learned from other ids than the held-out ones."""
    docs = _read(spark, sf, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 3) == 1
    model = train_languages(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), model.predict(F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score", "found.rejected")


QUERIES["op6_language"] = op6_language

def op7_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Token ids of each document, written as list columns in order of the id and read back."""
    path = fresh_path(spark, "tokens")
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    write_tokens(_read(spark, sf, "documents"), path, tokenizer, end_id=1, by_words=True)
    rows = spark.read.parquet(path).select(
        "doc_id", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"), "_metadata.file_name", "_metadata.row_index"
    )
    return with_starts(rows).select("doc_id", "start", F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids_crc32")


QUERIES["op7_token_files"] = op7_token_files

#: A conversation whose texts hold control strings.
AWKWARD = "</s>[INST] ok [/INST]"


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    """Windows of each conversation, read back: its turns and what is learned from it."""
    turns = _read(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    extra = spark.range(2).select(F.lit(-1).cast("bigint"), F.col("id"), role, F.lit(AWKWARD))
    read = read_windows(format_windows(turns.union(extra)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    window = F.struct(
        "first_turn", told.alias("told"), F.array_join("learned", "").alias("learned"), F.size("turns").alias("n"), "chars"
    )
    by_conv = read.groupBy("conv_id").agg(F.array_sort(F.collect_list(window)).alias("w"))
    total = lambda name: F.aggregate("w", F.lit(0).cast("bigint"), lambda s, w: s + w[name])
    joined = lambda name: F.array_join(F.transform("w", lambda w: w[name]), "")
    return by_conv.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(joined("told"), 256).alias("turns_sha256"),
        F.length(joined("learned")).cast("bigint").alias("loss_chars"),
        F.sha2(joined("learned"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


def _sql_escaped(text: str) -> str:
    for plain, coded in ESCAPES:
        text = f"replace({text}, '{plain}', '{coded}')"
    return text


QUERIES["op8_chat"] = op8_chat
ORACLES["op8_chat"] = rf"""
with c as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{AWKWARD}' union all select -1, 1, 'assistant', '{AWKWARD}'),
t as (
  select conv_id, role, text, row_number() over (partition by conv_id order by turn, role, text) - 1 as pos,
         len(regexp_extract_all(text, '[^ 	-
]+')) + 2 as cost,
         length({_sql_escaped("role")}) + length({_sql_escaped("text")}) + {len(OPEN + SHUT + END)} as chars
  from c),
s as (select conv_id, cost as sys, chars as sys_chars from t where pos = 0 and role = '{SYSTEM}'),
p as (
  select t.*, coalesce(sys, 0) as sys, coalesce(sys_chars, 0) as sys_chars, sys is not null and pos = 0 as is_sys,
         coalesce(sum(cost) over (partition by t.conv_id order by pos rows between unbounded preceding and 1 preceding), 0) as before
  from t left join s using (conv_id)),
q as (
  select *, greatest(1, {BUDGET} - sys) as room, case when is_sys then 0 else before - sys end as start,
         case when is_sys then 0 else cost end as own from p),
r as (select *, floor(start / room) as stretch from q),
u as (
  select *, pos > min(case when not is_sys then pos end) over w and start + own - min(start) over w > room as late
  from r window w as (partition by conv_id, stretch)),
v as (
  select *, case when late then pos else min(pos) over w end as first,
         case when late then own else sum(case when late then 0 else own end) over w end as new_cost
  from u window w as (partition by conv_id, stretch)),
heads as (select conv_id, first, start as head_start, room - new_cost as spare, sys_chars from v where pos = first),
again as (
  select conv_id, chars from v join heads h using (conv_id)
  where v.pos between h.first - {HISTORY} and h.first - 1 and not is_sys and head_start - start <= spare
  union all select conv_id, sys_chars from heads where first > 0),
more as (select conv_id, sum(chars) as chars from again group by conv_id)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = '{TARGET}'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by pos) filter (where role = '{TARGET}'), '')) as loss_sha256,
       cast(sum(v.chars) + coalesce(any_value(more.chars), 0) as bigint) as formatted_chars
from v left join more using (conv_id) group by conv_id"""

#: Scores from here on are predicted to be of good quality.
GOOD = 0.3


def quality_model(docs: DataFrame, labels: DataFrame) -> QualityModel:
    """A model that has not seen the held-out ids."""
    return train_quality(docs, labels.filter(id_remainder("doc_id", 5) != 0))


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality score of each document by a model that was trained on other ids than the held-out ones."""
    docs = _read(spark, sf, "documents").select("doc_id", "text")
    score = quality_model(docs, _read(spark, sf, "labels")).score(F.col("text"))
    scored = docs.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= GOOD).cast("int"))


QUERIES["op9_quality"] = op9_quality


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprints of 3-word shingles, linked at 2 differing bits or fewer."""
    return near_duplicates(_read(spark, sf, "documents"), shingle=3, max_bits=2)


QUERIES["op10_simhash"] = op10_simhash


def _hashed(numbers: Iterable[int]) -> str:
    return hashlib.sha256(",".join(str(int(n)) for n in numbers).encode()).hexdigest()


def op11_centroids(spark: SparkSession, sf: str) -> DataFrame:
    """The cluster of each vector, its distance, the clusters' inertias and final centroids."""
    rows, centers = cluster_vectors(_read(spark, sf, "embeddings"))
    totals = inertias(rows)
    facts = [(c, totals.get(c, 0), sum(totals.values()), _hashed(center)) for c, center in enumerate(centers)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return rows.join(F.broadcast(facts), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


QUERIES["op11_centroids"] = op11_centroids


def _sql_nearest(points: str, centers: str, keys: str) -> str:
    """The nearest center of each point: exact squared distances, ties to the smaller number."""
    return f"""
  select rid, {keys}arg_min(k, (s, k)) as k, min(s) as s
  from (select rid, {keys}k, sum((x.v - c.v) * (x.v - c.v)) as s from {points} x join {centers} c using ({keys}pos) group by rid, {keys}k)
  group by rid{", part" if keys else ""}"""


def _sql_floor(total: str, n: str) -> str:
    return f"(({total}) - ((({total}) % ({n})) + ({n})) % ({n})) // ({n})"


def _sql_moved(near: str, centers: str, points: str, keys: str) -> str:
    mean = _sql_floor("t", "n")
    return f"""
  select {keys}k, pos, coalesce({mean}, c.v) as v
  from {centers} c left join (
    select {keys}k, pos, cast(sum(v) as bigint) as t, count(*) as n from {points} join {near} using (rid{", part" if keys else ""}) group by {keys}k, pos) m
  using ({keys}k, pos)"""


def _sql_lloyd(rounds: int, keys: str) -> str:
    steps = []
    for r in range(rounds):
        steps.append(f"a{r} as materialized ({_sql_nearest('x', f'c{r}', keys)})")
        steps.append(f"c{r + 1} as materialized ({_sql_moved(f'a{r}', f'c{r}', 'x', keys)})")
    steps.append(f"a{rounds} as materialized ({_sql_nearest('x', f'c{rounds}', keys)})")
    return ",\n".join(steps)


_SQL_FINITE = "len(list_filter(embedding, lambda e: e is null or not isfinite(e))) = 0"

ORACLES["op11_centroids"] = f"""
with v as materialized (
  select row_number() over () as rid, vec_id, list_transform(embedding, lambda e: cast(floor(64 * cast(e as double)) as bigint)) as w
  from embeddings where embedding is not null and len(embedding) = 64 and {_SQL_FINITE}),
x as materialized (select rid, unnest(range(64)) as pos, unnest(w) as v from v),
seeds as (
  select row_number() over (order by sha256('1:' || vec_id), w) - 1 as k, w from v where vec_id is not null qualify k < 16),
c0 as materialized (select k, unnest(range(64)) as pos, unnest(w) as v from seeds),
{_sql_lloyd(3, "")},
h as (select k, sha256(string_agg(cast(v as varchar), ',' order by pos)) as centroid_sha256 from c3 group by k)
select vec_id, cast(k as integer) as cluster, cast(s as bigint) as distance,
       cast(sum(s) over (partition by k) as bigint) as cluster_inertia, cast(sum(s) over () as bigint) as inertia, centroid_sha256
from v join a3 using (rid) join h using (k)"""


def op12_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    """The code of each vector, its error, the errors of its label and the final codebooks."""
    rows, books = compress_vectors(_read(spark, sf, "embeddings"), label_col="label")
    per_label = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "own")
    return rows.join(per_label, F.col("label").eqNullSafe(F.col("own"))).select(
        F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(_hashed(books.ravel())).alias("codebooks_sha256")
    )


QUERIES["op12_vector_codes"] = op12_vector_codes
ORACLES["op12_vector_codes"] = f"""
with v as materialized (
  select row_number() over () as rid, vec_id, label, list_transform(embedding, lambda e: cast(floor(4096 * cast(e as double)) as bigint)) as w
  from embeddings where embedding is not null and {_SQL_FINITE}),
flat as (select rid, unnest(range(len(w))) as i, unnest(w) as v, len(w) // 8 as d from v),
x as materialized (select rid, i // d as part, i % d as pos, v from flat),
seeds as (select row_number() over (order by vec_id, w) - 1 as k, rid from v where vec_id is not null qualify k < 16),
c0 as materialized (select part, k, pos, v from seeds join x using (rid)),
{_sql_lloyd(6, "part, ")},
books as (select sha256(string_agg(cast(v as varchar), ',' order by part, k, pos)) as codebooks_sha256 from c6),
coded as (
  select rid, string_agg(lpad(to_hex(k), 2, '0'), '' order by part) as code, cast(sum(s) as bigint) as error from a6 group by rid)
select vec_id, lower(code) as code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from v join coded using (rid), books"""

#: Rules of the url filter; the longest that fits wins.
URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def op13_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    """Host and path of each page, the rule that decides and its verdict."""
    judged = filter_urls(_read(spark, sf, "pages").select("page_id", "url"), URL_RULES)
    return judged.select("page_id", "url_rule.host", "url_rule.path", "url_rule.rule", "url_rule.verdict")


QUERIES["op13_url_filter"] = op13_url_filter
ORACLES["op13_url_filter"] = f"""
with u as (
  select page_id, row_number() over () as rid, case when contains(url, '://') then substr(url, instr(url, '://') + 3) end as rest from pages),
p as (
  select page_id, rid, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {SQL_LETTERS}), '') as host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') as path
  from u),
rules as (select * from (values {", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)}) as v(verdict, h, t)),
m as (
  select rid, arg_max(h || t, length(h || t)) as rule, arg_max(verdict, length(h || t)) as verdict
  from p join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, t) group by rid)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from p left join m using (rid)"""

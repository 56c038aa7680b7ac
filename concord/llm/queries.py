"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from concord.llm import bpe, divergence, embedding_dedup, mixing, prefix_trie, quality, simhash, simple8b, token_rollup, topk, toxicity, url_filter, warc
from concord.llm.store import python_workers, new_folder

# Where the vocabulary files of public tokenizers lie; a parameter of every operator that needs one.
TOKENIZERS = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")
BYTE_BPE = f"{TOKENIZERS}/byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    python_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, BYTE_BPE, keep_text=False, decoded_col="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


TOXIC_FROM = 0.7


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out_col="score").select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.groups(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select(F.col("id").alias("doc_id"), "fingerprint", F.col("component").alias("component_id"))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.9)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load all documents, delete some, revise some, move one language to a new tokenizer version, replay."""
    docs, count = _table(spark, sf_dir, "documents"), token_rollup.TOKENIZERS
    text, rows = F.col("text"), token_rollup.signed
    state = token_rollup.Rollup(spark, new_folder(spark, "token-rollup"))
    load = rows(docs, 1, "words-1", count["words-1"](text)).unionByName(rows(docs, 1, "bytes-1", count["bytes-1"](text)))
    state.apply("load", load)
    gone = docs.where("doc_id % 17 = 3")
    retire = rows(gone, -1, "words-1", count["words-1"](text)).unionByName(rows(gone, -1, "bytes-1", count["bytes-1"](text)))
    state.apply("retire", retire)
    there = docs.where("coalesce(doc_id % 17 <> 3, true)")
    revised, now = there.where("doc_id % 7 = 1"), F.concat(text, F.lit(" as revised, twice: "), text)
    for name, tokens in (("words-1", count["words-1"]), ("bytes-1", count["bytes-1"])):
        state.apply(f"revise-{name}", rows(revised, -1, name, tokens(text)).unionByName(rows(revised, 1, name, tokens(now))))
    german = there.where("lang = 'de'").withColumn("text", F.when(F.col("doc_id") % 7 == 1, now).otherwise(text))
    upgrade = rows(german, -1, "words-1", count["words-1"](text)).unionByName(rows(german, 1, "words-2", count["words-2"](text)))
    state.apply("upgrade-de", upgrade)
    state.apply("retire", retire)  # replayed: no effect
    state.compact()
    state.apply("upgrade-de", upgrade)
    return state.totals()


OP5_SQL = f"""with d as (select source, lang, doc_id, coalesce(text, '') as text from documents where coalesce(doc_id % 17 <> 3, true)),
r as (
  select source, lang,
    case when doc_id % 7 = 1 then text || ' as revised, twice: ' || text else text end as text from d),
t as (
  select source, lang, 'bytes-1' as tokenizer, octet_length(encode(text)) as n from r
  union all
  select source, lang, 'words-1', len(regexp_extract_all(text, '{token_rollup.WORDS_1}')) from r where coalesce(lang <> 'de', true)
  union all
  select source, lang, 'words-2', len(regexp_extract_all(text, '{token_rollup.WORDS_2}')) from r where lang = 'de')
select source, lang, tokenizer, count(*) as n_docs, cast(sum(n) as bigint) as n_tokens
from t group by source, lang, tokenizer"""


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = warc.write(warc.chunks(warc.records(_table(spark, sf_dir, "pages"), min_bytes=1000)))
    return warc.read(files).select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


OP6_SQL = """with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest,
    coalesce(html, '') as payload
  from pages),
g as (select payload, max(page_id) as first from p where payload_bytes >= 1000 group by payload)
select p.page_id, cast(p.payload_bytes as bigint) as payload_bytes, p.payload_digest,
  case when g.first <> p.page_id then 'revisit' else 'response' end as record_type,
  case when g.first <> p.page_id then g.first end as refers_to
from p left join g on g.payload = p.payload and p.payload_bytes >= 1000"""


# Host, path and verdict of the rules that op7 applies.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


OP7_SQL = f"""with rules(host, path, verdict) as (values {", ".join(str(r) for r in URL_RULES)}),
p as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{url_filter.UPPER}', '{url_filter.LOWER}') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages),
fits as (
  select p.page_id, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
    arg_max(r.verdict, length(r.host || r.path)) as verdict
  from p join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
  group by p.page_id)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from p left join fits f on f.page_id = p.page_id"""


def op8_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = simple8b.by_id(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    files = simple8b.write(docs, simple8b.library(spark, BYTE_BPE, end_id=0))
    read = simple8b.read(files)
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *mixing.COLUMNS)


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.expr("id % 50 = 0"), k=5, scale=256)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = [e.rule for e in quality.ordered(docs, quality.RULES)]
    return quality.judge(docs, rules).drop("text")


OP11_SQL = r"""with d as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
v as (
  select rid, i, count(*) over (partition by rid, win) as c
  from (select rid, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as win from d)),
r as (select rid, count(distinct j) as n from (select rid, i + unnest([0, 1, 2]) as j from v where c > 1) group by rid),
m as (
  select d.*, cast(len(w) as bigint) as n_words, cast(length(array_to_string(w, '')) as bigint) as word_chars,
    cast(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) as n_dup_lines, cast(coalesce(r.n, 0) as bigint) as n_repeat_words
  from d left join r on r.rid = d.rid),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not (base_failed
    or word_chars < 2 * n_words or word_chars > 12 * n_words
    or 10 * n_symbols > n_words
    or 2 * n_dup_lines > len(l)
    or 10 * (length(t) - length(regexp_replace(t, '[A-Za-z\x{80}-\x{10FFFF}]', '', 'g'))) < 6 * word_chars
    or length(regexp_replace(t, '[^A-Z]', '', 'g')) > length(regexp_replace(t, '[^a-z]', '', 'g'))
    or 2 * len(list_filter(w, lambda x: ends_with(x, '!'))) > n_words) as kept
from b"""


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.paths(_table(spark, sf_dir, "conversations"), group=5)
    return prefix_trie.trie(prefix_trie.rebuilt(own, heads=9))


OP12_SQL = """with t as (
  select conv_id, turn, octet_length(encode(coalesce(text, ''))) as b,
    sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as k
  from conversations where conv_id is not null),
own as (
  select conv_id, conv_id - conv_id % 5 as base, list({'k': k, 'b': b} order by turn nulls first, k) as w,
    xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(cast(conv_id as varchar), ''), lambda c: [cast(ascii(c) as bigint), 0, 0, 0, 0, 0, 0, 0]))),
      lambda s, e: xor(xor(s, e) >> 1, case when xor(s, e) % 2 = 1 then 3988292384 else 0 end)), 4294967295) % 9 as h
  from t group by conv_id),
r as (select a.conv_id, list_concat(coalesce(b.w[1:a.h], []), a.w[a.h + 1:]) as p from own a left join own b on b.conv_id = a.base),
e as (select conv_id, p, unnest(range(0, len(p) + 1)) as d from r),
n as (
  select d, p[1:d] as path, min(conv_id) as conv_id, count(*) as n_convs,
    coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where len(p) = d), '') as ends
  from e group by d, p[1:d]),
c as (select d - 1 as d, path[1:d - 1] as path, count(*) as n_children from n where d > 0 group by all),
own_values as (
  select n.*, coalesce(c.n_children, 0) as n_children, case when n.d = 0 then 0 else (n.n_convs - 1) * n.path[n.d].b end as saved
  from n left join c on c.d = n.d and c.path = n.path),
up as (select path, saved, n_children, unnest(range(0, d + 1)) as a from own_values),
sub as (select a as d, path[1:a] as path, count(*) filter (where n_children = 0) as n_leaves, sum(saved) as saved_tokens from up group by all)
select v.conv_id, v.d as depth, parent.conv_id as parent_conv_id, v.n_convs, v.n_children, s.n_leaves,
  cast(s.saved_tokens as bigint) as saved_tokens, sha256(v.ends) as ends_sha256
from own_values v join sub s on s.d = v.d and s.path = v.path
left join n parent on parent.d = v.d - 1 and parent.path = v.path[1:v.d - 1]"""


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), min_docs=3, top=200)


OP13_SQL = r"""with d as (
  select row_number() over () as rid, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
t as (select rid, lang, source, unnest(w) as term from d),
kept as (select lang, term from t group by lang, term having count(distinct rid) >= 3),
v as (select lang, count(*) as v from kept group by lang),
c as (select t.lang, t.source, t.term, count(*) as c from t join kept k on k.lang = t.lang and k.term = t.term group by all),
g as (select distinct lang, source from d),
n as (select g.lang, g.source, coalesce(sum(c.c), 0) as n from g left join c on c.lang = g.lang and c.source = g.source group by all),
p as (
  select n.lang, n.source, k.term, coalesce(c.c, 0) as c, cast(1 + (1000000000::hugeint * (coalesce(c.c, 0) + 1)) // (n.n + v.v)::hugeint as bigint) as p
  from n join kept k on k.lang = n.lang join v on v.lang = n.lang left join c on c.lang = n.lang and c.source = n.source and c.term = k.term),
lc as (select lang, term, sum(c) as c from c group by all),
ln as (select lang, sum(n) as n from n group by lang),
q as (select lc.lang, lc.term, cast(1 + (1000000000::hugeint * (lc.c + 1)) // (ln.n + v.v)::hugeint as bigint) as q from lc join ln on ln.lang = lc.lang join v on v.lang = lc.lang),
sums as (
  select a.lang, a.source, b.source as item, cast(sum(((a.p - b.p) * (a.p - b.p)) // b.p) as bigint) as value
  from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (
  select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
  from g a join g b on a.lang = b.lang and a.source <> b.source left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
terms as (
  select p.lang, p.source, 'term' as part, p.term as item, ((p.p - q.q) * (p.p - q.q)) // q.q as value
  from p join q on q.lang = p.lang and q.term = p.term where p.c > 0 and p.p > q.q),
r as (
  select *, cast(row_number() over (partition by lang, source, part order by value desc, encode(item)) as integer) as rank
  from (select * from pairs union all select * from terms))
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 200"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash": op4_simhash,
    "op5_token_rollup": op5_token_rollup,
    "op6_warc": op6_warc,
    "op7_url_filter": op7_url_filter,
    "op8_token_ids": op8_token_ids,
    "op9_mixing": op9_mixing,
    "op10_topk": op10_topk,
    "op11_quality": op11_quality,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_divergence": op13_divergence,
}

ORACLES: dict[str, str] = {
    "op5_token_rollup": OP5_SQL,
    "op6_warc": OP6_SQL,
    "op7_url_filter": OP7_SQL,
    "op11_quality": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_divergence": OP13_SQL,
}

"""The dealt operators over the standard tables, with production parameters: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureflow.llm import (
    block_search, licences, near_dedup, norm_search, packing, periodic, prefix_trie, quality, sentence_pieces, suffix_dedup, token_counts, token_files,
    toxicity,
)
from featureflow.llm.common import fold, shared_folder, stored, table, texts_of
from featureflow.llm.sql import PERIODIC, TRIE, licences_sql

END_ID = 1


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 3) != 1)
    scored = quality.classify(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), labels)
    return scored.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted", "n_offending")


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", norm_search.integers("embedding").alias("vector"))
    return norm_search.top_k(rows, rows.where("vec_id % 20 = 0"))


def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return block_search.nearest(rows, rows.where("vec_id % 20 = 0"))


def near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def suffix_removals(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.removals(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def token_count_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file())


def sentence_piece_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_pieces.round_trips(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def token_file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_folder(spark)
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_file(), END_ID)
    return token_files.checksums(token_files.read_tokens(spark, path))


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), END_ID, with_ids=False)


def branched(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, turn, digest, size) of the rebuilt conversations, and all conv_ids.

    Conversation c takes its first h = crc32(c) % 6 turns from conversation c - c % 100, as many as that has, and keeps
    its own after its first h. At most five turns of each such conversation are copied.
    """
    base, h = F.col("conv_id") - F.col("conv_id") % 100, fold(F.col("conv_id"), 6)
    turns = stored(prefix_trie.numbered(prefix_trie.turn_digests(conversations)).select("conv_id", "depth", "digest", "size"))
    convs = conversations.select(F.col("conv_id").cast("long")).where("conv_id is not null").distinct()
    firsts = turns.where("conv_id % 100 = 0 and depth <= 5").withColumnRenamed("conv_id", "base")
    borrowed = convs.select("conv_id", base.alias("base"), h.alias("h")).join(firsts, "base").where("depth <= h")
    lengths = firsts.groupBy("base").agg(F.max("depth").alias("had"))
    own = turns.select("*", base.alias("base"), h.alias("h")).where("depth > h").join(lengths, "base", "left")
    own = own.withColumn("turn", F.col("depth") - F.col("h") + F.least("h", F.coalesce("had", F.lit(0))))
    return borrowed.select("conv_id", F.col("depth").alias("turn"), "digest", "size").unionByName(own.select("conv_id", "turn", "digest", "size")), convs


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*branched(table(spark, sf_dir, "conversations")))


def licence_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents")).drop("base", "found")


def planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, text; a tenth of the texts is made periodic from some word on, as the id's crc32 says."""
    rows = texts_of(docs, "doc_id", "text").withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    chosen = F.col("h") % 10 == 0
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    rows = rows.withColumn("words", F.when(chosen, words)).withColumn("n", F.size("words"))
    rows = rows.withColumn("g", F.floor(F.col("h") / 10)).withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.transform(F.sequence(F.lit(0), (F.col("n") - F.col("a") - 1).cast("int")), lambda k: F.get("words", (F.col("a") + k % F.col("p")).cast("int")))
    made = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), tail), " ")
    return rows.select("doc_id", F.when(chosen & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))


def periodic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda x: F.concat_ws("", x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n")))
    longest = F.array_max(F.transform("runs", lambda x: F.struct(x["length"].alias("length"), (-x["start"]).alias("start"), (-x["period"]).alias("period"))))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id", "n_runs", (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


QUERIES = {
    "op1_quality": quality_scores,
    "op2_exact_top_k": exact_top_k,
    "op3_nearest_vectors": nearest_vectors,
    "op4_near_copies": near_copies,
    "op5_token_counts": token_count_rows,
    "op6_sentence_pieces": sentence_piece_rows,
    "op7_toxicity": toxicity_scores,
    "op8_token_files": token_file_rows,
    "op9_suffix_removals": suffix_removals,
    "op10_packing": packed_pieces,
    "op11_prefix_trie": conversation_trie,
    "op12_license_scan": licence_rows,
    "op13_periodic_runs": periodic_rows,
}

_SEARCH = """
with v as ({vectors}),
pairs as (
  select q.vec_id as query_id, c.vec_id, {score} as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id
),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from pairs)
select query_id, cast(rank as int) as rank, vec_id, score from ranked where rank <= 20
"""
_FINITE = """vec_id is not null and embedding is not null and len(embedding) > 0
  and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"""

#: Shingles as text, an inverted index for the pairs, reachability for the components.
_NEAR = """
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(generate_series(1, len(w) - 3), lambda i: array_to_string(w[i:i + 3], ' '))) end as sh from d),
n as (select doc_id, len(sh) as n from s),
u as (select doc_id, unnest(sh) as x from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as c from u a join u b using (x) where a.doc_id < b.doc_id group by all),
l as (select a, b from p join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * c >= 80 * (na.n + nb.n - c)),
e as (select a, b from l union all select b, a from l),
r as (select doc_id, doc_id as c from n union select e.b, r.c from r join e on e.a = r.doc_id),
m as (select doc_id, min(c) as component_id from r group by doc_id)
select doc_id, n as n_shingles, component_id, doc_id = component_id as kept from n join m using (doc_id)
"""
#: All strings of 50 bytes as hexadecimal digits; starts to remove as islands; the rest put together again.
_SUFFIX = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as h, octet_length(encode(coalesce(text, ''))) as n from documents),
w as (select doc_id, i, substr(h, 2 * i + 1, 100) as x from d, lateral (select unnest(generate_series(0, n - 50)) as i)),
f as (select x, min(doc_id) as least from w group by x having min(doc_id) < max(doc_id)),
g as (select doc_id, i from w join f using (x) where least < doc_id),
k as (select doc_id, i, coalesce(i - lag(i) over (partition by doc_id order by i) > 50, true) as fresh from g),
c as (select doc_id, i, sum(fresh::int) over (partition by doc_id order by i) as run from k),
r as (select doc_id, run, min(i) as a, max(i) + 50 as b from c group by all),
z as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as z from r),
kept as (
  select doc_id, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' order by a) || substr(any_value(h), 2 * max(b) + 1) as h,
    sum(b - a)::bigint as n_removed, count(*) as n_spans from z join d using (doc_id) group by doc_id)
select d.doc_id, d.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256 from d left join kept using (doc_id)
"""

ORACLES: dict[str, str] = {
    "op4_near_copies": _NEAR,
    "op11_prefix_trie": TRIE,
    "op12_license_scan": licences_sql(),
    "op13_periodic_runs": PERIODIC,
    "op9_suffix_removals": _SUFFIX,
    "op2_exact_top_k": _SEARCH.format(
        vectors=f"select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings where {_FINITE}",
        score="cast(list_inner_product(q.v, c.v) as bigint)",
    ),
    "op3_nearest_vectors": _SEARCH.format(
        vectors=f"select vec_id, embedding::double[] as v from embeddings where {_FINITE} and len(list_filter(embedding, lambda x: x <> 0)) > 0",
        score="list_inner_product(q.v, c.v)",
    ),
}

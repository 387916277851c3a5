"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

#: Bytes of an Arrow batch on its way to Python; a longer row is a batch of its own.
BATCH_BYTES = "16777216"


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Python workers get this package's folder on their path (a cluster that
    has it elsewhere passes it with --py-files), and batches are bounded."""
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH")]))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=2)


@register
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.line_dedup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, min_chars=10, min_docs=2).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op5_line_dedup"] = """
with l as (
  select doc_id, line, pos,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos
        from documents)),
shared as (
  select key, min(doc_id) as first from l where length(key) >= 10
  group by key having count(distinct doc_id) >= 2),
marked as (
  select l.doc_id, l.line, l.pos, (s.key is not null and s.first <> l.doc_id) as gone
  from l left join shared s on l.key = s.key)
select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


@register
def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.importance import classify

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.weighted_sampling import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


@register
def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.chat import format_chats

    return format_chats(table(spark, sf_dir, "conversations"))


ORACLE["op8_chat_formatting"] = """
with c as (
  select conv_id, count(*)::bigint as n_turns, list(coalesce(role, '') || chr(0) || coalesce(text, '') order by turn) as said,
         string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' order by turn) as rendered
  from conversations where conv_id is not null group by conv_id),
copies as (select said, min(conv_id) as conv_id, count(*)::bigint as n_copies from c group by said)
select c.conv_id, 0::bigint as part, c.n_turns, k.n_copies, c.n_turns as part_turns, c.rendered
from c join copies k on c.conv_id = k.conv_id
where not exists (select 1 from c l where l.n_turns > c.n_turns and l.said[1] = c.said[1] and l.said[1:c.n_turns] = c.said)
"""


@register
def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@register
def op2_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.piece_dropout import decode, encode
    from goldenrec.llm.text import text_of

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("plain_sha256", F.sha2(text_of(), 256))
    found = decode(encode(docs, path, dropout=0.1, seed=42, carry=("plain_sha256",), own_marks=True), path)
    decoded = F.sha2("decoded", 256)
    return found.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"),
                        decoded.alias("decoded_sha256"), (decoded == F.col("plain_sha256")).alias("lossless"))


@register
def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.cover_tree import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.9)


ORACLE["op7_embedding_near_dedup"] = """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
n as (select vec_id, e, sqrt(list_dot_product(e, e)) as size from v),
l as (
  select a.vec_id as a, b.vec_id as b from n a join n b on a.vec_id <> b.vec_id
  where list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach(vec_id, r) as (
  select vec_id, vec_id from n union select l.a, reach.r from reach join l on l.b = reach.vec_id),
c as (select vec_id, min(r) as component_id from reach group by vec_id)
select n.vec_id, (select count(*) from l where l.a = n.vec_id)::bigint as n_links, c.component_id::bigint as component_id,
       n.vec_id = c.component_id as kept
from n join c on n.vec_id = c.vec_id
"""


@register
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.repair import repair_damaged

    return repair_damaged(table(spark, sf_dir, "conversations"))


@register
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.prefix_trie import rebuilt_trie

    return rebuilt_trie(table(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = """
with c as (
  select conv_id, list(coalesce(role, '') || chr(0) || coalesce(text, '') order by turn nulls first) as said
  from conversations where conv_id is not null group by conv_id),
h as (
  select conv_id, said, xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(
             string_split(conv_id::varchar, ''), lambda d: [ascii(d)::bigint, 0, 0, 0, 0, 0, 0, 0]))),
           lambda s, b: xor(xor(s, b) >> 1, case when xor(s, b) & 1 = 1 then 3988292384 else 0 end)), 4294967295) % 6 as h
  from c),
r as (
  select h.conv_id, list_concat(coalesce(b.said[1:h.h], []), h.said[h.h + 1:]) as said
  from h left join c b on b.conv_id = h.conv_id - h.conv_id % 100),
p as (
  select conv_id, d as depth, said[1:d] as said, len(said) = d as ends
  from (select conv_id, said, unnest(range(len(said) + 1)) as d from r)),
n as (
  select depth, said, min(conv_id) as conv_id, count(*)::bigint as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256,
         case when depth = 0 then 0 else length(said[-1]) - instr(said[-1], chr(0)) end as chars
  from p group by depth, said),
k as (select depth - 1 as depth, said[1:depth - 1] as said, count(*)::bigint as n_children from n where depth > 0 group by all),
f as (select n.*, coalesce(n_children, 0)::bigint as n_children from n left join k on n.depth = k.depth and n.said = k.said),
up as (select said[1:d] as said, d as depth, n_children, (n_convs - 1) * chars as saved
       from (select *, unnest(range(depth + 1)) as d from f)),
s as (select depth, said, count_if(n_children = 0)::bigint as n_leaves, sum(saved)::bigint as saved_tokens from up group by depth, said)
select f.conv_id, f.depth::bigint as depth, o.conv_id as parent_conv_id, f.n_convs, f.n_children, s.n_leaves, s.saved_tokens, f.ends_sha256
from f join s on f.depth = s.depth and f.said = s.said
left join n o on o.depth = f.depth - 1 and o.said = f.said[1:f.depth - 1]
"""


@register
def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from goldenrec.llm.language import identify_held_out

    return identify_held_out(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

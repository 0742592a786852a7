"""Queries of this subpackage: thin views of the operators, and their SQL where there is any."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomery.llm import bpe, conversations, embed_dedup, licenses, line_dedup, mixing, pii, simhash, spelling, suffix_dedup, token_counts, topk_search, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), digest_only=True)
    return found.select("doc_id", "n_lines", "n_dropped", F.col("kept").alias("kept_sha256"))


def op2_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return topk_search.search(docs, docs.where("doc_id % 50 = 0"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.extract(_table(spark, sf_dir, "documents"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents")).select("doc_id", "license", "notices")


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_tokens", "p_good", "p_poor", "p_toxic", "rate")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.counted_words(_table(spark, sf_dir, "documents"), damage=97))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(_table(spark, sf_dir, "conversations")))


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.drop_repeats(_table(spark, sf_dir, "documents"), digest_only=True)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.col("kept").alias("kept_sha256"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_line_dedup, op2_topk_search, op3_pii, op4_simhash_near_dedup, op5_byte_bpe, op6_license_scan, op7_embedding_near_dedup, op8_toxicity, op9_mixing, op10_token_counts, op11_spelling_variants, op12_conversation_repair, op13_suffix_dedup)} | {"pipeline": corpus_pipeline.run}


ALPHABET = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

LINE_DEDUP_SQL = f"""
with lines as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as pos from documents),
  keyed as (select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {ALPHABET}) as key from lines),
  held as (select key, min(doc_id) as first from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1),
  marked as (select k.doc_id, k.pos, k.line, h.key is not null and h.first <> k.doc_id as gone from keyed k left join held h using (key))
select doc_id, count(*)::bigint as n_lines, count_if(gone)::bigint as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256 from marked group by doc_id
"""

SEARCH_SQL = r"""
with term as (select doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) as t from documents), size as (select doc_id, count(*) as dl from term group by 1),
  tf as (select doc_id, t, count(*) as f from term group by 1, 2), df as (select t, count(*) as df from tf group by 1), n as (select count(*) as n, (select count(*) from term) / count(*)::double as mean from documents),
  s as (select q.doc_id as query_id, d.doc_id, round(sum(ln(1 + (n - df + 0.5::double) / (df + 0.5::double)) * f * 2.2::double / (f + 1.2::double * (0.25::double + 0.75::double * dl / mean))), 6) as score
    from (select distinct doc_id, t from tf where doc_id % 50 = 0) q join df using (t) join (select doc_id, t, f from tf) d using (t) join size z on z.doc_id = d.doc_id, n group by 1, 2),
  r as (select *, row_number() over (partition by query_id order by score desc, doc_id)::int as rank from s where score > 0)
select query_id, rank, doc_id, score from r where rank <= 10
"""

EMBEDDINGS_SQL = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings where list_dot_product(embedding::double[], embedding::double[]) > 0),
  link as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.95),
  reach(a, b) as (select a, b from link union select r.a, l.b from reach r join link l on l.a = r.b),
  low as (select a, least(a, min(b)) as c from reach group by a), n as (select a, count(*)::bigint as n from link group by a)
select vec_id, coalesce(n.n, 0)::bigint as n_links, coalesce(low.c, vec_id) as component_id, coalesce(low.c, vec_id) = vec_id as kept from embeddings left join n on n.a = vec_id left join low on low.a = vec_id
"""


# The oracle of the licence scan has its own normal form (letters and digits alone) and its own description of notices.
NOTICES_SQL = (
    ("AGPL-3.0", "(gnu)?(agpl|afferogeneralpubliclicense)(version|v)30?"),
    ("Apache-2.0", "apache(software)?licen[sc]e(version)?20|apache20(license)?"),
    ("BSD-2-Clause", "bsd2clause(license)?|2clausebsdlicense|(simplified|free)bsdlicense"),
    ("BSD-3-Clause", "bsd3clause(license)?|3clausebsdlicense|(new|modified)bsdlicense"),
    ("CC-BY-4.0", "ccby40|creativecommonsattribution40internationallicense"),
    ("CC-BY-NC-4.0", "ccbync40|creativecommonsattributionnoncommercial40internationallicense"),
    ("CC-BY-SA-4.0", "ccbysa40|creativecommonsattributionsharealike40internationallicense"),
    ("GPL-2.0", "(gnugpl|gpl|gnugeneralpubliclicense)(version|v)?20?"),
    ("GPL-3.0", "(gnugpl|gpl|gnugeneralpubliclicense)(version|v)?30?"),
    ("ISC", "isc(license)?"),
    ("MIT", "mit(x11)?(license)?|expatlicense"),
    ("MPL-2.0", "mozillapubliclicense(version)?20|mpl20"),
    ("Zlib", "zlib(license)?"),
)
LICENSE_SQL = f"""
with lines as (select doc_id, unnest(string_split(text, chr(10))) as line from documents),
  short as (select doc_id, regexp_replace(replace(lower(line), 'licence', 'license'), '[^a-z0-9]', '', 'g') as s from lines),
  rule(name, re) as (values {", ".join(f"('{n}', '{r}')" for n, r in NOTICES_SQL)}),
  hit as (select distinct doc_id, name from short join rule on regexp_full_match(s, '(this(work|project|software|program|file|code|document)is)?(licensed|released|distributed|published|available|madeavailable|provided)under(thetermsof)?(the)?(' || re || ')')),
  body(name, start, size) as (values ('MIT', 'permissionisherebygrantedfreeofcharge', 800), ('ISC', 'permissiontousecopymodifyandordistribute', 500), ('Apache-2.0', 'apachelicenseversion20january2004', 7000), ('GPL-3.0', 'gnugeneralpubliclicenseversion329june2007', 20000)),
  whole as (select doc_id, min(name) as license from documents join body on starts_with(regexp_replace(lower(text), '[^a-z0-9]', '', 'g'), start) and length(text) > size group by 1)
select d.doc_id, w.license, coalesce(string_agg(h.name, ',' order by h.name), '') as notices from documents d left join whole w using (doc_id) left join hit h on h.doc_id = d.doc_id group by 1, 2
"""


# SQL has no crc32: a table of 256 remainders by rule, and a fold over the bytes.
CRC_TABLE_SQL = "select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))) as steps"


def _crc_sql(text: str) -> str:
    read = f"list_transform(range(0, length(hex(encode({text}))), 2), lambda j: ('0x' || substr(hex(encode({text})), j + 1, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295, {read}), lambda x, b: xor(x >> 8, steps[xor(x & 255, b) + 1])), 4294967295)"


# Near words by what is left when one code point goes, not by a trie.
SPELLING_SQL = rf"""
with recursive crc as ({CRC_TABLE_SQL}),
  run as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {ALPHABET}) as w from documents),
  each as (select doc_id, w, count(*) as k from run where length(w) >= 5 group by 1, 2),
  hashed as (select w, k, {_crc_sql("doc_id || ':' || w")} as h from each, crc),
  spelt as (select case when h % 97 = 0 then substr(w, 1, (h % length(w))::int) || substr(w, (h % length(w))::int + 2) else w end as word, k from hashed),
  words as (select word, sum(k)::bigint as n from spelt where length(word) >= 5 group by 1 having sum(k) >= 3),
  cut as (select word, unnest(range(length(word))) as i from words), less as (select word, i, substr(word, 1, i) || substr(word, i + 2) as rest from cut),
  near as (select a.word, b.word as other from less a join words b on b.word = a.rest union select b.word, a.word from less a join words b on b.word = a.rest
    union select a.word, b.word from less a join less b on a.i = b.i and a.rest = b.rest and a.word <> b.word),
  best as (select near.word, count(*) as n_near, min({{'m': -o.n, 'w': o.word}}) as b from near join words o on o.word = near.other group by 1),
  formed as (select w.word, w.n, coalesce(b.n_near, 0)::bigint as n_near, case when -b.b.m >= 2 * w.n then b.b.w end as form, case when -b.b.m >= 2 * w.n then (-b.b.m)::bigint end as form_n from words w left join best b using (word)),
  path as (select word, word as root from formed union all select p.word, f.form from path p join formed f on f.word = p.root where f.form is not null)
select f.word, f.form, p.root, f.n, f.n_near, f.form_n from formed f join path p using (word) join formed l on l.word = p.root where l.form is null
"""


# Forwards from row to row with the least (cost, audit) of each state: strings instead of ranks and pointers.
_ENTER = "s0, s1, list_min([u, {c: s0.c + 5, a: s0.a || 'I', t: list_append(s0.t, 'user:')}, {c: s1.c + 5, a: s1.a || 'I', t: list_append(s1.t, 'user:')}, {c: a.c + 5, a: a.a || 'I', t: list_append(a.t, 'user:')}]) as u, a"
_LEAVE = "s0, s1, u, list_min([a, {c: u.c + 5, a: u.a || 'I', t: list_append(u.t, 'assistant:')}]) as a"


def _edit_sql(state: str, cost: str, letter: str, line: str = "") -> str:
    return f"{{c: {state}.c + {cost}, a: {state}.a || '{letter}', t: " + (f"list_append({state}.t, {line})" if line else f"{state}.t") + "}"


def _row_sql(target: str, kept: str, before: tuple[str, ...], rerole: str) -> str:
    found = [_edit_sql(target, "2", "D")] + [_edit_sql(b, f"stays + if(ini = '{kept}', 0, 1000000000)", "K", "role || ':' || text") for b in before]
    found += [_edit_sql(b, "stays + 1", "R", f"'{rerole}:' || text") for b in before if rerole]
    return f"list_min([{', '.join(found)}]) as {target}"


REPAIR_SQL = rf"""
with recursive crc as ({CRC_TABLE_SQL}),
  given as (select *, coalesce(conv_id::text, ' ') || ':' || coalesce(turn::text, ' ') as key from conversations),
  hashed as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_crc_sql("key")} % 20 as kind from given, crc),
  after as (select conv_id, turn, case when kind = 4 then 'user' else role end as role, case when kind = 1 then '' when kind = 2 then translate(text, '.!?', '') else text end as text from hashed, range(2) r(copy) where kind <> 0 and (copy = 0 or kind = 3)),
  placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from after),
  shown as (select *, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as body, row_number() over (partition by conv_id, role, text order by i) as nth, lag(role) over (partition by conv_id order by i) as prev from placed),
  faulty as (select *, left(role, 1) as ini, case when body = '' then 'b' when nth > 1 then 'd' when right(body, 1) not in ('.', '!', '?') then 't' else '' end as fault from shown),
  dp as (select conv_id, 0 as i, {{c: 0::bigint, a: '', t: []::varchar[]}} as s0, {{c: 1000000000::bigint, a: '', t: []::varchar[]}} as s1, {{c: 1000000000::bigint, a: '', t: []::varchar[]}} as u, {{c: 1000000000::bigint, a: '', t: []::varchar[]}} as a from (select distinct conv_id from conversations)
    union all select conv_id, i, {_row_sql("s0", "", (), "")}, {_row_sql("s1", "s", ("s0",), "")}, {_row_sql("u", "u", ("s0", "s1", "a"), "user")}, {_row_sql("a", "a", ("u",), "assistant")}
      from (select conv_id, i, role, text, ini, stays, {_LEAVE} from (select conv_id, i, role, text, ini, stays, {_ENTER} from (select d.conv_id, f.i::int as i, s0, s1, u, a, role, text, ini, case fault when 't' then 5 when '' then 0 else 1000000000 end as stays from dp d join faulty f on d.conv_id is not distinct from f.conv_id and f.i = d.i + 1)))),
  ended as (select conv_id, list_min([s0, a]) as best from (select conv_id, {_LEAVE} from (select conv_id, {_ENTER} from (select conv_id, s0, s1, u, a from dp qualify row_number() over (partition by conv_id order by i desc) = 1)))),
  counted as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count_if(fault = 'b')::bigint as blank, count_if(fault = 'd')::bigint as duplicate, count_if(fault = 't')::bigint as truncated, count_if(prev is not null and left(prev, 1) || ini not in ('su', 'ua', 'au'))::bigint as illegal from faulty group by 1)
select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, best.c as cost, best.a as audit, sha256(array_to_string(best.t, chr(10))) as repaired_sha256
from ended e left join counted c on e.conv_id is not distinct from c.conv_id
"""


def oracle_sql() -> dict[str, str]:
    """Scores, hashes, tokens and fitted weights are beyond SQL; their queries are tested against brute force."""
    found = {"op1_line_dedup": LINE_DEDUP_SQL, "op2_topk_search": SEARCH_SQL, "op6_license_scan": LICENSE_SQL, "op7_embedding_near_dedup": EMBEDDINGS_SQL, "op11_spelling_variants": SPELLING_SQL, "op12_conversation_repair": REPAIR_SQL}
    return found | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

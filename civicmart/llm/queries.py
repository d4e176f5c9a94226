"""The queries of the operators, and SQL that gives the same rows where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from civicmart.llm import (
    bagminhash,
    chat,
    decontaminate,
    embedding_dedup,
    learned_partitions,
    mixing,
    quality,
    ranked_search,
    repair,
    secrets,
    sharding,
    substrings,
    token_planes,
)
from civicmart.llm.common import ship_package
from civicmart.plans.registry import Builder, load


def _shipping(builder: Builder) -> Builder:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return builder(spark, sf_dir)

    return build


# Two rows beside the table's, as literals.
ANSWERED_ROWS = [(-7, i, role, "</s>[INST] ok [/INST]") for i, role in enumerate(("user", "assistant"))]


def _answered() -> Column:
    fields = ("conv_id", "turn", "role", "text")
    kinds = ("bigint", "bigint", "string", "string")
    structs = [F.struct(*[F.lit(v).cast(k).alias(f) for v, k, f in zip(row, kinds, fields)]) for row in ANSWERED_ROWS]
    return F.inline(F.array(*structs))


QUERIES: dict[str, Builder] = {
    "op1_decontaminate": lambda spark, sf: decontaminate.contamination_report(
        load(spark, sf, "documents"), load(spark, sf, "benchmark")
    ),
    "op2_embedding_dedup": lambda spark, sf: embedding_dedup.near_vectors(load(spark, sf, "embeddings")),
    "op3_quality": lambda spark, sf: quality.quality_report(
        load(spark, sf, "documents"), load(spark, sf, "labels")
    ),
    "op4_chat_format": lambda spark, sf: chat.chat_report(
        load(spark, sf, "conversations")
        .select("conv_id", "turn", "role", "text")
        .unionByName(spark.range(1).select(_answered()))
    ),
    "op5_secrets": lambda spark, sf: secrets.secret_report(load(spark, sf, "documents")),
    "op6_bagminhash": lambda spark, sf: bagminhash.near_copy_report(
        load(spark, sf, "documents"), null_ids=True
    ),
    "op7_mix": lambda spark, sf: mixing.mix_report(load(spark, sf, "documents")),
    "op8_shard": lambda spark, sf: sharding.shard_report(load(spark, sf, "documents")),
    "op9_token_planes": lambda spark, sf: token_planes.token_report(
        load(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json")
    ),
    "op10_substrings": lambda spark, sf: substrings.repeat_report(load(spark, sf, "documents")),
    "op11_ranked_search": lambda spark, sf: ranked_search.search(
        load(spark, sf, "documents"), load(spark, sf, "benchmark")
    ),
    "op12_learned_partitions": lambda spark, sf: learned_partitions.search(
        load(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0
    ),
    "op13_repair": lambda spark, sf: repair.repair_report(load(spark, sf, "conversations")),
}
QUERIES = {name: _shipping(builder) for name, builder in QUERIES.items()}

ORACLES: dict[str, str] = {
    "op1_decontaminate": r"""
with words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
items as (
  select item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
starts as (
  select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i
  from items where len(w) > 0),
grams as (select distinct item_id, n, array_to_string(w[i:i + n - 1], ' ') as gram from starts),
sizes as (select distinct n from grams),
positions as (
  select doc_id, w, s.n, unnest(range(1, len(w) - s.n + 2)) as i
  from words, sizes s where len(w) >= s.n),
windows as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as gram from positions),
hits as (select doc_id, n, i, item_id from windows join grams using (n, gram)),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, n, i from hits))
  group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from words left join covered using (doc_id) left join found using (doc_id)
""",
    "op2_embedding_dedup": r"""
with recursive usable as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
  on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_cosine_similarity(a.v, b.v) >= 0.98),
reach(a, b) as (
  select vec_id, vec_id from embeddings
  union
  select r.a, l.b from reach r join links l on l.a = r.b),
roots as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, vec_id = component_id as kept
from embeddings e join roots r on r.a = e.vec_id left join counts c on c.a = e.vec_id
""",
    "op4_chat_format": r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked as (
  select *, lag(role) over (partition by conv_id order by turn, role, text) as before,
    length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:/?s>|/?INST\]|SEP\])')) as n_text,
    length(role) + len(regexp_extract_all(role, '[<\[]\\*(?:/?s>|/?INST\]|SEP\])')) as n_role
  from rows)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(n_text + case when before is not distinct from role then 5 else n_role + 20 end)::bigint as formatted_chars
from marked group by conv_id
""",
    "op6_bagminhash": r"""
with recursive words as (
  select doc_id, md5(text) as same, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents where text is not null),
runs as (
  select doc_id, w, least(len(w), 5) as n, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i
  from words where len(w) > 0),
bags as (
  select doc_id, array_to_string(w[i:i + n - 1], ' ') as shingle, count(*) as weight from runs group by 1, 2),
sizes as (select doc_id, sum(weight) as size from bags group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, sum(least(a.weight, b.weight)) as common
  from bags a join bags b on a.shingle = b.shingle and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from shared s join sizes x on x.doc_id = s.a join sizes y on y.doc_id = s.b
  where common * 5 >= 4 * (x.size + y.size - common)
  union
  select a.doc_id, b.doc_id from words a join words b on a.same = b.same and a.doc_id < b.doc_id),
ways as (select a, b from links union select b, a from links),
reach(a, b) as (
  select doc_id, doc_id from documents
  union
  select r.a, w.b from reach r join ways w on w.a = r.b)
select a as doc_id, min(b) as component_id, a = min(b) as kept from reach group by a
""",
    "op7_mix": r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) || ':'
      || (row_number() over (partition by doc_id, source, coalesce(text, '') order by doc_id) - 1)::varchar), 1, 15))::bigint as place
  from documents),
sources as (
  select source, sum(size)::bigint as source_size,
    (row_number() over (order by source is null, source collate c) - 1) % 3 + 1 as weight
  from sized group by source),
caps as (
  select *, 3 * source_size as cap, row_number() over (order by 3 * source_size / weight, source is null, source) as i
  from sources),
levels as (
  select *, (sum(source_size) over () - coalesce(sum(cap) over (order by i rows between unbounded preceding and 1 preceding), 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over (order by i rows between unbounded preceding and 1 preceding), 0))::double as level
  from caps),
chosen as (select first(level order by i) as level from levels where cap / weight >= level),
targets as (
  select source, source_size, coalesce(least(cap::double, weight * (select level from chosen)), cap::double) as target
  from levels),
passes as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as passes from targets),
running as (
  select s.doc_id, s.size, p.source_size, p.target, p.passes, p.target - p.passes * p.source_size as need,
    sum(s.size) over (partition by s.source order by s.place range between unbounded preceding and current row) as upto,
    sum(s.size) over (partition by s.source, s.place) as here
  from sized s join passes p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
  (size * (passes + case when upto <= need or upto - need < need - (upto - here) then 1 else 0 end))::bigint as taken
from running
""",
    "op11_ranked_search": r"""
with words as (
  select doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from documents),
asked as (
  select item_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
items as (select item_id, term, count(*) as times from asked group by 1, 2),
sizes as (select doc_id, count(*) as n from words group by 1),
total as (select count(*)::bigint as docs, sum(n)::bigint as length from sizes),
found as (
  select doc_id, term, count(*) as tf from words where term in (select term from asked) group by 1, 2),
weights as (
  select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)::double))::bigint as w
  from found cross join total group by term, docs),
scores as (
  select item_id, doc_id, sum(times * w
    * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // length)))))::bigint as score
  from items join found using (term) join weights using (term) join sizes using (doc_id) cross join total
  group by 1, 2),
ranked as (
  select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank,
    doc_id, score
  from scores where score > 0)
select * from ranked where rank <= 20
""",
    "op13_repair": r"""
with recursive
-- The checksum's table of bytes, and the checksum.
bytes as (
  select list(list_reduce(list_concat([i::bigint], range(8)),
    lambda c, x: case when c % 2 = 1 then xor(c >> 1, 3988292384::bigint) else c >> 1 end) order by i) as t
  from range(256) r(i)),
keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
  from conversations),
kinds as (
  select *, xor(list_reduce(
    list_concat([4294967295::bigint], list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 20 as kind
  from keyed cross join bytes),
rows_left as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(range(case kind when 3 then 2 else 1 end)) as copy
  from kinds where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i
  from rows_left),
numbered as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth from placed),
marked as (
  select conv_id, turn, i, role, text, substr(role, 1, 1) as initial,
    lag(substr(role, 1, 1)) over (partition by conv_id order by i) as before,
    case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when nth > 1 then 'duplicate'
      when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from numbered),
-- States: 0 nothing yet, 1 after the system row, 2 after a user row, 3 after an assistant row.
inserts(state, letters, paid, there, made) as (values
  (0, '', 0, 0, []::varchar[]), (1, '', 0, 1, []), (2, '', 0, 2, []), (3, '', 0, 3, []),
  (0, 'I', 2, 2, ['user:']), (1, 'I', 2, 2, ['user:']), (2, 'I', 2, 3, ['assistant:']), (3, 'I', 2, 2, ['user:']),
  (0, 'II', 4, 3, ['user:', 'assistant:']), (1, 'II', 4, 3, ['user:', 'assistant:']),
  (2, 'II', 4, 2, ['assistant:', 'user:']), (3, 'II', 4, 3, ['user:', 'assistant:'])),
edits(letter, initial, there, paid, after) as (values
  ('D', null, 0, 3, 0), ('D', null, 1, 3, 1), ('D', null, 2, 3, 2), ('D', null, 3, 3, 3),
  ('K', 's', 0, 0, 1), ('K', 'u', 0, 0, 2), ('K', 'u', 1, 0, 2), ('K', 'u', 3, 0, 2), ('K', 'a', 2, 0, 3),
  ('R', null, 0, 2, 2), ('R', null, 1, 2, 2), ('R', null, 3, 2, 2), ('R', null, 2, 2, 3)),
paths(conv_id, i, state, cost, audit, lines) as (
  select distinct conv_id, 0::bigint, 0, 0, '', []::varchar[] from marked
  union all
  select p.conv_id, m.i, e.after, p.cost + s.paid + e.paid
      + case when m.fault = 'truncated' and e.letter <> 'D' then 1 else 0 end as total,
    p.audit || s.letters || e.letter as audit,
    p.lines || s.made || case e.letter when 'D' then []::varchar[] when 'K' then [m.role || ':' || m.text]
      else [case e.after when 2 then 'user:' else 'assistant:' end || m.text] end
  from paths p
  join marked m on m.conv_id is not distinct from p.conv_id and m.i = p.i + 1
  join inserts s on s.state = p.state
  join edits e on e.there = s.there and (e.initial is null or e.initial = m.initial)
    and (e.letter = 'D' or m.fault not in ('blank', 'duplicate'))
  qualify row_number() over (
    partition by p.conv_id, e.after
    order by p.cost + s.paid + e.paid + case when m.fault = 'truncated' and e.letter <> 'D' then 1 else 0 end,
      p.audit || s.letters || e.letter) = 1),
facts as (
  select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (i > 1 and before || initial not in ('su', 'ua', 'au')) as illegal
  from marked group by conv_id),
ended as (
  select p.conv_id, p.cost + s.paid as cost, p.audit || s.letters as audit, p.lines || s.made as lines
  from paths p join facts f on f.conv_id is not distinct from p.conv_id and f.n = p.i
  join inserts s on s.state = p.state and s.there in (0, 3)
  qualify row_number() over (partition by p.conv_id order by p.cost + s.paid, p.audit || s.letters) = 1)
select o.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank,
  coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
  coalesce(illegal, 0)::bigint as illegal, coalesce(cost, 0)::bigint as cost, coalesce(audit, '') as audit,
  sha256(coalesce(array_to_string(lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join facts f on f.conv_id is not distinct from o.conv_id
left join ended e on e.conv_id is not distinct from o.conv_id
""",
}

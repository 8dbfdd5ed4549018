"""DuckDB SQL for the operators that SQL can express."""

BLOCK_TOPK = """
with floors as (
  select vec_id, [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id,
         cast(list_inner_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
  from floors q join floors c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0
)
select query_id, cast(rank as int) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank
      from scored)
where rank <= 5
"""

CHAT_PARTS = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                   (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked as (
  select *, length(text) + length(regexp_replace(text, '[^][<>\\]', '', 'g')) as escaped
  from turns
)
select conv_id,
       count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text))
         as turns_sha256,
       cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text)
                       filter (role = 'assistant'), '')) as loss_sha256,
       cast(7 + sum(escaped + case when role in ('user', 'assistant') then 13
                    else 14 + length(role)
                      + length(regexp_replace(role, '[^][<>\\]', '', 'g')) end) as bigint)
         as formatted_chars
from marked group by conv_id
"""

# Near words share what is left without a letter: of both at one place, or of one and the
# whole other. The checksum goes byte by byte over its usual table.
SPELLING_VARIANTS = r"""
with recursive crc_table as (
  select list(value order by byte) as crc from (
    select byte, list_reduce([byte] || list_transform(range(8), lambda i: 0::bigint),
      lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as value
    from (select unnest(range(256))::bigint as byte))
), run as (
  select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run,
    count(*) as n
  from (select doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) as run from documents)
  group by all
), summed as (
  select run, n, xor(list_reduce([4294967295::bigint] || list_transform(
      string_split(regexp_replace(hex(encode(concat(doc_id, ':', run))), '(..)', '\1 ', 'g').rtrim(), ' '),
      lambda h: ('0x' || h)::bigint),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) as h
  from run, crc_table
), word as (
  select case when h % 199 = 0
    then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2)
    else run end as word, cast(sum(n) as bigint) as n
  from summed group by 1 having length(word) >= 6 and sum(n) >= 5
), without as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
  from (select word, n, unnest(range(1, length(word) + 1)) as i from word)
), link as (
  select distinct a.word, a.n, b.word as other, b.n as other_n
  from without a join without b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select w.word, w.n, v.word, v.n from without w join word v on w.rest = v.word
  union select v.word, v.n, w.word, w.n from without w join word v on w.rest = v.word
), best as (
  select word, count(*) as n_near, arg_min(other, (-other_n, other)) as other, max(other_n) as other_n
  from link group by word
), judged as (
  select w.word, w.n, coalesce(n_near, 0) as n_near,
    case when other_n >= 5 * w.n then other end as form,
    case when other_n >= 5 * w.n then other_n end as form_n
  from word w left join best using (word)
), chain as (
  select word, word as root, form as next from judged
  union all
  select c.word, j.word, j.form from chain c join judged j on c.next = j.word
)
select word, form, root, n, n_near, form_n
from judged join (select word, root from chain where next is null) using (word)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_block_topk": BLOCK_TOPK,
    "op4_chat_parts": CHAT_PARTS,
    "op11_spelling_variants": SPELLING_VARIANTS,
}

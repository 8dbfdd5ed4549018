"""The queries once more, as DuckDB SQL written independently of the engine.

All statements share one chain of common table expressions; DuckDB evaluates
only those a statement uses.
"""

from __future__ import annotations

from checks.views import BLANKS_FROM, DIRT, PRODUCT_PAGES_SQL, REVIEWS_SQL

WS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c-\x1e\x{85}\x{2028}\x{2029}]"


# Fixed values, stated here once more: author, date, rating by the product's rating o, and
# text by title t and description d.
GENERATED = """
  (0, 'Alice M.', '2024-03-15', 'I absolutely loved ''{t}''. {d1}... The writing style is engaging and the content kept me hooked from start to finish. Would highly recommend to anyone looking for a great read.'),
  (1, 'Raj K.', '2024-02-28', 'Decent book overall. ''{t}'' has its moments but felt a bit slow in the middle. The beginning is strong and the ending ties things together nicely. Good value for the price though.'),
  (2, 'Emma L.', '2024-01-10', 'One of the best purchases I''ve made this year! ''{t}'' exceeded all my expectations. {d2}... The author has a unique voice and the subject matter is handled with great care.'),
  (3, 'Tom W.', '2023-12-05', 'Mixed feelings about ''{t}''. It started off promisingly but the pacing became inconsistent midway. I can see why others love it, but it just wasn''t for me. The production quality is good though.'),
  (4, 'Priya S.', '2024-04-01', '''{t}'' is a solid read. I appreciated the depth of content and how well everything was structured. Perfect for a lazy weekend. Will look for more from this author.'),
  (5, 'James O.', '2024-04-20', 'Truly a gem! I had low expectations for ''{t}'' but was completely blown away. The detail, the flow, and the overall experience were top-notch. Already gifted copies to three friends.'),
  (6, 'Sara N.', '2024-03-30', 'Good book, nothing extraordinary. ''{t}'' delivers what it promises. Clear writing, fair length, and reasonably priced. A reliable choice if you''re on the fence.')
"""

PROMPT = """You are a product review analyst. Analyze the following customer review and return a structured analysis.

{context}

REVIEW:
\"\"\"
{text}
\"\"\"

Respond in exactly this format (no extra text):

SENTIMENT: <Positive | Negative | Neutral | Mixed>
CONFIDENCE: <a score from 0.0 to 1.0>
KEY_POINTS:
- <point 1>
- <point 2>
- <point 3 if applicable>
SUMMARY: <one concise sentence summarizing the review>
"""


def quoted(text: str) -> str:
    """A SQL literal; what is not printable ASCII goes by its number."""
    pieces, plain = [], ""
    for character in text:
        if " " <= character <= "~":
            plain += "''" if character == "'" else character
        else:
            if plain:
                pieces.append(f"'{plain}'")
                plain = ""
            pieces.append(f"chr({ord(character)})")
    if plain or not pieces:
        pieces.append(f"'{plain}'")
    return "(" + " || ".join(pieces) + ")"


def replaced(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, '{pattern}', {by}, 'g')"


def stripped(text: str) -> str:
    return replaced(text, f"^[{WS}]+|[{WS}]+$", "''")


def fixed(text: str) -> str:
    out = f"nfc_normalize({text})"
    pairs = (
        (0x2019, "'"), (0x2018, "'"), (0x201C, '"'), (0x201D, '"'), (0x2013, "-"),
        (0x2014, "--"), (0x2026, "..."), (0xA0, " "), (0x200B, ""),
    )
    for code, plain in pairs:
        out = f"replace({out}, chr({code}), {quoted(plain)})"
    return out


def cleaned(text: str) -> str:
    out = replaced(fixed(f"coalesce({text}, '')"), "<[^>]+>", "' '")
    out = replaced(out, r"[^\x09\x0A\x0D\x20-\x7E\x{A0}-\x{FFFF}]", "''")
    out = replaced(out, r"[ \t]+", "' '")
    out = replaced(out, r"\n{3,}", "chr(10) || chr(10)")
    out = replaced(out, rf"[{WS}]+([.,!?;:])", r"'\1'")
    return stripped(out)


def tokens(text: str) -> str:
    words = f"len(list_filter(string_split_regex({text}, '[{WS}]+'), lambda w: w <> ''))"
    return f"cast(floor({words} * cast(1.3 as double)) as int)"


def marked_sentences(text: str) -> str:
    marked = replaced(text, rf"([.!?])[{WS}]+", r"'\1' || chr(1)")
    return f"string_split({marked}, chr(1))"


def byte_at(position: int) -> str:
    return f"cast(('0x' || substr(digest, {position}, 2)) as int)"


def answers(name: str, source: str) -> str:
    """Adds the answer to the column chunk of a relation."""
    lf = "chr(10)"
    crlf = "chr(13) || chr(10)"

    def lines(*parts: str, by: str = lf) -> str:
        return f" || {by} || ".join(parts)

    return rf"""
{name}_digest as (select *, md5(chunk) as digest from {source}),
{name}_pieces as (
  select *, {byte_at(5)} % 12 as v, {byte_at(7)} % 6 as ev, {byte_at(3)} % 101 as ci,
    'SENTIMENT: ' || (['Positive','Negative','Neutral','Mixed'])[{byte_at(1)} % 4 + 1] as lab,
    'SUMMARY: s ' || substr(digest, 1, 8) as total,
    coalesce(string_split(chunk, ' ')[1], '') as w1,
    coalesce(string_split(chunk, ' ')[2], '') as w2,
    coalesce(string_split(chunk, ' ')[3], '') as w3
  from {name}_digest),
{name}_lines as (
  select *, 'CONFIDENCE: ' || case when ci = 100 then '1.00'
      else '0.' || lpad(cast(ci as varchar), 2, '0') end as cf
  from {name}_pieces),
{name} as (
  select * exclude (digest, lab, total, w1, w2, w3, cf, ci), case v
    when 0 then null
    when 1 then ''
    when 2 then {lines("replace(lab, 'SENTIMENT', 'sentiment')",
                       "replace(cf, 'CONFIDENCE', 'confidence')")}
    when 3 then {lines("lab", "'CONFIDENCE: ' || ci || '%'", "total")}
    when 4 then {lines("cf", "'KEY_POINTS:'", "'- ' || w1", "total")}
    when 5 then {lines("lab", "cf", "'KEY_POINTS: - lost'", "'* ' || w1", "'SUMMARY:'")}
    when 6 then {lines("lab", "'KEY_POINTS:'", "'- ' || w1", "cf", "'- ' || w2",
                       "'KEY_POINTS:'", "'note'", "'-- ' || w3", "total")}
    when 7 then {lines("'SENTIMENT: ' || lab", "cf", "'CONFIDENCE: n/a'")}
    when 8 then {lines("'  ' || lab", "''", "cf", "'KEY_POINTS:'", "'- ' || w1", "total", "''",
                       by=crlf)}
    else {lines("lab", "cf", "'KEY_POINTS:'", "'- ' || w1", "'- ' || w2", "'- ' || w3",
                "total")}
    end as raw_response
  from {name}_lines)"""


def parsed(name: str, source: str) -> str:
    """Parsed fields and numbered key points of the answered rows of a relation."""
    tag = "starts_with(line, '{}')".format

    def last(label: str) -> str:
        value = stripped(f"replace(line, '{label}', '')")
        return f"arg_max({value}, pos) filter (where {tag(label)})"

    return rf"""
{name}_answered as (select * from {source} where length(raw_response) > 0),
{name}_line as (
  select review_key, chunk_idx, pos, {stripped("piece")} as line
  from {name}_answered a,
    unnest(string_split_regex(raw_response, '{LINE_BREAK}')) with ordinality as u(piece, pos)),
{name}_said as (
  select review_key, chunk_idx, {last("SENTIMENT:")} as s, {last("CONFIDENCE:")} as c,
    {last("SUMMARY:")} as m
  from {name}_line group by all),
{name}_state as (
  select *, last_value(case when {tag("KEY_POINTS:")} then 1
      when {tag("SENTIMENT:")} or {tag("CONFIDENCE:")} or {tag("SUMMARY:")} then 0 end ignore nulls)
      over (partition by review_key, chunk_idx order by pos
            rows between unbounded preceding and current row) as inside
  from {name}_line where line <> ''),
{name}_point as (
  select review_key, chunk_idx, pos,
    {stripped(replaced("line", "^[- ]+", "''"))} as point
  from {name}_state where inside = 1 and starts_with(line, '-')),
{name}_points as (
  select review_key, chunk_idx, count(*) as points, string_agg(point, ' | ' order by pos) as joined
  from {name}_point group by all),
{name} as (
  select a.review_key, a.chunk_idx, a.raw_response, coalesce(s, 'Unknown') as sentiment,
    try_cast(c as double) as confidence, coalesce(m, '') as llm_summary,
    coalesce(points, 0) as points, coalesce(joined, '') as key_points_str
  from {name}_answered a left join {name}_said using (review_key, chunk_idx)
    left join {name}_points using (review_key, chunk_idx))"""


def merged(name: str, source: str) -> str:
    """One row per review of a parsed relation."""
    return rf"""
{name}_votes as (
  select review_key, sentiment, count(*) as n, min(chunk_idx) as first_seen
  from {source} group by all),
{name}_ranked as (
  select *, row_number() over (partition by review_key order by n desc, first_seen) as place,
    sum(n) over (partition by review_key) as votes
  from {name}_votes),
{name}_points as (
  select review_key, point, min(chunk_idx * 100000 + pos) as seen
  from {source}_point group by all),
{name}_top as (
  select *, row_number() over (partition by review_key order by seen) as place
  from {name}_points),
{name}_joined as (
  select review_key, count(*) as points, string_agg(point, ' | ' order by seen) as key_points_str
  from {name}_top where place <= 5 group by all),
{name}_rest as (
  select review_key,
    case when count(confidence) > 0 then cast(format('{{:.3f}}',
      list_reduce(list(confidence order by chunk_idx) filter (where confidence is not null),
                  lambda a, b: a + b) / count(confidence)) as double) end as confidence,
    arg_min(llm_summary, chunk_idx) as llm_summary,
    string_agg(raw_response, chr(10) || '---' || chr(10) order by chunk_idx) as raw_llm_response
  from {source} group by all),
{name} as (
  select review_key, case when n = 1 and votes > 1 then 'Mixed' else sentiment end as sentiment,
    confidence, coalesce(points, 0) as points, coalesce(key_points_str, '') as key_points_str,
    llm_summary, raw_llm_response
  from {name}_ranked join {name}_rest using (review_key)
    left join {name}_joined using (review_key)
  where place = 1)"""


def chain() -> str:
    reviews = REVIEWS_SQL.format(documents="documents", labels="labels")
    shop = PRODUCT_PAGES_SQL.format(part="part")
    dirt = " ".join(f"when {i} then {quoted(piece)}" for i, piece in enumerate(DIRT))
    star = (
        "case p_size % 7 when 0 then null when 6 then 0 else p_size % 7 end"
    )
    ctes = [
        f"f1 as ({reviews})",
        f"""f2_piece as (select doc_id, text, case doc_id % 12 {dirt} end as x from documents)""",
        """f2 as (select doc_id as review_key, x || ' ' || text || ' ' || x as review_text
          from f2_piece)""",
        f"f3 as ({shop})",
        f"""product as (
          select p_partkey, p_name || ' & Co' as product_title,
            cast({star} as int) as overall_rating,
            chr(163) || cast(p_retailprice as varchar) as price,
            case when p_partkey % 5 = 0 then 'Sold out' when p_partkey % 4 = 0 then 'N/A'
                 else 'In stock' end as availability,
            case when p_partkey % 6 = 0 then 'N/A'
                 else 'A ' || p_type || ' thing by ' || p_brand || '.' end as description,
            'https://shop.example.com/' || p_partkey as scraped_url,
            '2024-05-20 14:32:01' as scraped_at
          from part)""",
        """turn as (select conv_id as review_key, cast(turn as int) as chunk_idx,
            text as chunk from conversations
          union all select conv_id, cast(turn as int) + {blanks}, ' ' from conversations
            where turn % 5 = 3)""".format(blanks=BLANKS_FROM),
        "asked as (select * from turn where trim(chunk) <> '')",
        answers("f4", "asked"),
        parsed("p4", "f4"),
        merged("m4", "p4"),
        f"f1_clean as (select *, {cleaned('review_text')} as cleaned_text from f1)",
        f"f1_count as (select *, {tokens('cleaned_text')} as token_count from f1_clean)",
        f"""sentence as (
          select review_key, token_count, pos, s, {tokens("s")} as t
          from f1_count c, unnest({marked_sentences("cleaned_text")}) with ordinality as u(s, pos))""",
        """pack(review_key, pos, s, t, chunk_idx, filled) as (
          select review_key, pos, s, t, 0, t from sentence where token_count > 400 and pos = 1
          union all
          select n.review_key, n.pos, n.s, n.t,
            case when p.filled + n.t > 400 then p.chunk_idx + 1 else p.chunk_idx end,
            case when p.filled + n.t > 400 then n.t else p.filled + n.t end
          from pack p join sentence n on n.review_key = p.review_key and n.pos = p.pos + 1)""",
        """chunk as (
          select review_key, chunk_idx, string_agg(s, ' ' order by pos) as chunk
          from pack group by all
          union all
          select review_key, 0, cleaned_text from f1_count where token_count <= 400)""",
        "chunk_number as (select review_key, count(*) as chunk_count from chunk group by all)",
        """f1_pre as (
          select f.*, cast(chunk_count as int) as chunk_count
          from f1_count f join chunk_number using (review_key))""",
        answers("f5", f"(select * from chunk where {stripped('chunk')} <> '')"),
        parsed("p5", "f5"),
        merged("m5", "p5"),
        """f5_rich as (
          select f.*, coalesce(m.sentiment, 'Unknown') as sentiment, m.confidence,
            coalesce(m.points, 0) as points, coalesce(m.key_points_str, '') as key_points_str,
            coalesce(m.llm_summary, 'No summary generated.') as llm_summary,
            coalesce(m.raw_llm_response, '') as raw_llm_response,
            chunk_count as chunks_analyzed
          from f1_pre f left join m5 m using (review_key))""",
    ]
    return "with recursive " + ",\n".join(ctes) + "\n"


def generated() -> str:
    text = "template"
    for mark, value in (
        ("{t}", "product_title"),
        ("{d1}", "substr(description, 1, 120)"),
        ("{d2}", "substr(description, 51, 110)"),
    ):
        text = f"replace({text}, '{mark}', {value})"
    return f"""
select scraped_url || '#' || i as review_key,
  substr(md5(author || date || i), 1, 8) as review_id, product_title, author,
  case when overall_rating is null then null
    when i in (2, 5) then 5
    when i = 0 and overall_rating > 5 then 5
    when i = 1 and overall_rating < 2 then 1 when i = 1 then overall_rating - 1
    when i = 3 and overall_rating < 3 then 1 when i = 3 then overall_rating - 2
    when i = 6 and overall_rating < 3 then 2 when i = 6 then overall_rating - 1
    else overall_rating end::int as rating,
  date, {text} as review_text, scraped_url as source_url
from product cross join (values {GENERATED}) as t(i, author, date, template)"""


def prompt_text() -> str:
    before, rest = PROMPT.split("{context}")
    opening, closing = rest.split("{text}")
    return f"""
select review_key, {quoted(before)}
  || case when author is null or author = '' then '' else 'Written by: ' || author || '.' end
  || ' ' || case when rating is null or rating = 0 then ''
                 else 'The reviewer gave a rating of ' || rating || '/5.' end
  || {quoted(opening)} || review_text || {quoted(closing)} as prompt
from f1"""


ANALYSIS = """
select review_key, token_count, sentiment, confidence, key_points_str, llm_summary,
  raw_llm_response, chunks_analyzed
from f5_rich"""

EXPORTED = """
select review_id, product_title, coalesce(author, '') as author, rating, date,
  review_text as original_review, cleaned_text as cleaned_review, token_count, chunk_count,
  sentiment, confidence, key_points_str as key_points, llm_summary, source_url
from f5_rich"""

READ_BACK = """
select review_id, product_title, nullif(author, '') as author, rating, date,
  nullif(review_text, '') as original_review, nullif(cleaned_text, '') as cleaned_review,
  token_count, chunk_count, cast(null as varchar) as sentiment,
  cast(null as double) as confidence, cast(null as varchar) as key_points,
  cast(null as varchar) as llm_summary, source_url
from f1_pre"""

DOCUMENTS = """
select source_url, max(product_title) as product_title, max(rating) as overall_rating,
  '2024-05-20T14:32:01.000000' as scraped_at, '2024-05-20T14:32:01.000000' as generated_at,
  count(*) as total_reviews, cast(count(*) as int) as listed,
  cast(sum(('0x' || substr(md5(review_key || '|' || review_id), 1, 11))::bigint) as bigint)
    as ids_digest, cast(0 as int) as misplaced,
  cast(coalesce(sum(rating), 0) as bigint) as rating_sum,
  cast(sum(length(cleaned_text)) as bigint) as text_length,
  cast(sum(chunk_count) as bigint) as chunks,
  count(confidence) as confident, cast(sum(points) as bigint) as points,
  cast(sum(length(raw_llm_response)) as bigint) as raw_length,
  count(*) filter (where sentiment = 'Mixed') as mixed
from f5_rich group by source_url"""

STATS = """
select source_url, count(*) as total_reviews, round(avg(rating), 6) as avg_rating,
  round(avg(confidence), 6) as avg_confidence, round(avg(token_count), 6) as avg_tokens
from f5_rich group by source_url"""

BREAKDOWN = """
select sentiment, count(*) as reviews, rpad(sentiment, cast(greatest(10, length(sentiment)) as int), ' ')
    as label,
  repeat(chr(9608), count(*)) as bar
from f5_rich group by sentiment"""

METRICS = """
select source_url, max(product_title) as product_title, count(*) as reviews,
  cast(sum(chunk_count) as bigint) as total_chunks,
  count(*) filter (where sentiment not in ('Unknown', '')) as successful
from f5_rich group by source_url"""

WHOLE_RUN = """
select source_url, max(product_title) as product_title, count(*) as reviews,
  count(*) as total_reviews, count(*) as csv_rows, count(*) as json_reviews,
  cast(sum(chunk_count) as bigint) as total_chunks,
  count(*) filter (where sentiment not in ('Unknown', '')) as successful,
  round(avg(rating), 6) as avg_rating, round(avg(confidence), 6) as avg_confidence,
  round(avg(token_count), 6) as avg_tokens
from f5_rich group by source_url"""

OVERVIEW = """
select source_url, count(*) as reviews, cast(sum(chunk_count) as bigint) as total_chunks,
  count(*) filter (where sentiment not in ('Unknown', '')) as successful,
  round(avg(rating), 6) as avg_rating, round(avg(confidence), 6) as avg_confidence,
  round(avg(token_count), 6) as avg_tokens, any_value(top_sentiment) as top_sentiment
from f5_rich join (
    select source_url, sentiment as top_sentiment from (
      select source_url, sentiment, row_number() over (
        partition by source_url order by count(*) desc, min(review_key)) as place
      from f5_rich group by source_url, sentiment) where place = 1) using (source_url)
group by source_url"""

RETRIES = """
select review_key, chunk_idx,
  cast(case ev when 0 then 1 when 1 then 2 when 2 then 3 when 3 then 1 else 4 end as int)
    as attempts,
  case ev when 3 then 'auth' when 4 then 'other' when 5 then 'rate_limit' end as error_class,
  cast(case ev when 0 then 0 when 1 then 2 when 2 then 6 when 3 then 0 else 30 end as double)
    as waited,
  ev < 3 as got_answer
from f4"""


def title_text() -> str:
    # The headings of the pages hold no tags and only these entities.
    text = "regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)"
    for name, code in (("middot", 183), ("copy", 169), ("quot", 34), ("nbsp", 160), ("lt", 60),
                       ("gt", 62), ("#39", 39), ("amp", 38)):
        text = f"replace({text}, '&{name};', chr({code}))"
    return f"select page_id, url, {stripped(text)} as product_title from pages where html is not null"


def oracle_sql() -> dict[str, str]:
    selects = {
        "page_title": title_text(),
        "product_metadata": """select product_title, overall_rating, price, availability,
            description, scraped_url, scraped_at from product""",
        "spec_table": """
            select scraped_url, 'upc' as spec_key, cast(p_partkey as varchar) as spec_value
            from product
            union all select scraped_url, 'price_(excl._tax)', price from product
            union all select scraped_url, 'availability', 'Sold out' from product
              where p_partkey % 5 = 0""",
        "generate_reviews": generated(),
        "fix_encoding": f"select review_key, {fixed('review_text')} as fixed_text from f2",
        "strip_tags": "select page_id, "
        f"{replaced('html', '<[^>]+>', "' '")} as stripped_text from pages",
        "clean_text": f"select review_key, {cleaned('review_text')} as cleaned_text from f2",
        "token_count": f"select review_key, {tokens('review_text')} as token_count from f1",
        "sentence_split": """select review_key, cast(pos - 1 as int) as position, s as sentence
            from sentence""",
        "chunk_pack": "select review_key, cast(chunk_idx as int) as chunk_idx, chunk from chunk",
        "preprocess_reviews": "select * from f1_pre",
        "preprocess_metrics": """select count(*) as reviews,
            round(coalesce(avg(token_count), 0), 6) as avg_tokens from f1_pre""",
        "build_prompt": prompt_text(),
        "explode_chunks": f"""select review_key, cast(chunk_idx + 1 as int) as chunk_idx, chunk
            from chunk where {stripped("chunk")} <> ''""",
        "stored_responses": """select review_key, cast(chunk_idx as int) as chunk_idx, raw_response,
            cast(1 as int) as attempts, cast(null as varchar) as error_class from f5""",
        "completion": """select review_key, chunk_idx, raw_response, cast(1 as int) as attempts
            from f4 where length(raw_response) > 0""",
        "retry_outcomes": RETRIES,
        "parse_fields": """select review_key, chunk_idx, sentiment, confidence, llm_summary
            from p4""",
        "parse_key_points": """select review_key, chunk_idx, cast(points as int) as points,
            key_points_str from p4""",
        "parse_malformed": """select conv_id, turn, text, 'Unknown' as sentiment,
            cast(null as double) as confidence, '' as llm_summary, '' as key_points_str
            from conversations """,
        "merge_sentiment": "select review_key, sentiment from m4",
        "merge_confidence": "select review_key, confidence from m4",
        "merge_key_points": "select review_key, key_points_str from m4",
        "merge_summary": "select review_key, llm_summary, raw_llm_response from m4",
        "analyze_reviews": ANALYSIS,
        "resumed_run": ANALYSIS,
        "whole_run": WHOLE_RUN,
        "export_rows": EXPORTED,
        "csv_roundtrip": READ_BACK,
        "csv_lines": READ_BACK,
        "json_documents": DOCUMENTS,
        "report_header": """select product_title, price,
            coalesce(cast(overall_rating as varchar), 'N/A') as overall_rating, scraped_url,
            scraped_at from product""",
        "report_stats": STATS,
        "sentiment_breakdown": BREAKDOWN,
        "sample_summaries": """select review_key, author, rating, sentiment, llm_summary
            from f5_rich order by review_key limit 3""",
        "run_metrics": METRICS,
        "source_overview": OVERVIEW,
    }
    prelude = chain()
    return {name: prelude + select for name, select in selects.items()}

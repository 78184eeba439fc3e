"""SQL oracles: the same results from the given tables, written for DuckDB and independent of the Spark code."""

from __future__ import annotations

from linkmill.functions.urls import BLOCKED_DOMAINS, BLOCKED_EXTENSIONS, TWO_LABEL_SUFFIXES, URL_PATTERN
from linkmill.plans.queries import HIGH_SCORE, N_BATCHES, URLS_PER_BATCH

# The hash family and the tokens of the signatures, written out here and not taken from the Spark code.
PRIME, NUM_PERM = 2147483647, 10
HASH_A_STEP, HASH_A_BASE, HASH_B_STEP, HASH_BASE = 1000003, 7919, 104729, 48271
TOKEN = r"[\p{L}\p{N}_]+|[^\s\p{L}\p{N}_]"


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


ISO = "'%Y-%m-%dT%H:%M:%S'"

POSTS = """posts as (
  select e.event_id as id, p.url, cast(floor(e.value) as bigint) - 10 as score,
         concat(e.event_type, ' ', cast(e.event_id as varchar)) as title, e.event_type as subreddit,
         date_trunc('second', e.ts) as created_utc,
         case when e.event_type = 'error' then null when e.event_type = 'signup' then true else false end as is_self
  from events e cross join (select count(*) n from pages) c join pages p on p.page_id = e.user_id % c.n)"""

SUBS = f"{POSTS}, subs as (select * from posts where is_self = false)"

FLAT = f"id, url, score, title, subreddit, strftime(created_utc, {ISO}) as created_utc"

ORDER_SUBS = """order_subs as (
  select o_orderkey as id, 'http://shop.example.com/customer/' || cast(o_custkey as varchar) as url,
         cast(floor(o_totalprice / 10000) as bigint) - 20 as score, o_orderpriority as title,
         o_orderstatus as subreddit, cast(o_orderdate as timestamp) as created_utc
  from orders)"""

_RECORD_COLUMNS = f"""url, cast(0 as integer) as part, cast(sum(score) as bigint) as total_score,
  string_agg(cast(id as varchar), '|' order by id) as ids, string_agg(cast(score as varchar), '|' order by id) as scores,
  string_agg(title, '|' order by id) as titles, string_agg(subreddit, '|' order by id) as subreddits,
  string_agg(strftime(created_utc, {ISO}), '|' order by id) as times"""

VARIANTS = """variants as (
  select page_id, html, case page_id % 12
    when 1 then 'https://i.imgur.com/' || page_id
    when 2 then url || '.PNG?x=1'
    when 3 then url || ' x'
    when 4 then split_part(url, '//', 2)
    when 5 then 'http://a'
    when 6 then 'https://www.itunes.apple.com/' || page_id
    when 7 then 'https://ITUNES.apple.com/' || page_id
    when 8 then 'https://1.2.3.4:80/' || page_id
    when 9 then 'https://user@News.Site.co.uk:8080/' || page_id || '?f=b.png'
    when 10 then 'http://host-' || page_id || '.zip'
    when 11 then 'https://example.org/' || page_id || '/a.png#top'
    else url end as url
  from pages)"""

_ENDINGS = "|".join(e[1:] for e in BLOCKED_EXTENSIONS)
_HOST = r"nullif(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?([^/?#:@]+)', 1)), '')"
_IS_IP = r"regexp_matches(host, '^[0-9]{1,3}(\.[0-9]{1,3}){3}$')"

CHECKED = f"""{VARIANTS}, hosts as (select *, {_HOST} as host, string_split({_HOST}, '.') as labels from variants),
named as (
  select *, array_to_string(labels[-2:], '.') as last_two, array_to_string(labels[-3:], '.') as last_three,
    length(url) > 8 and not contains(url, ' ') and regexp_matches(url, '(?i){URL_PATTERN}') as is_valid,
    regexp_matches(split_part(lower(url), '?', 1), '\\.({_ENDINGS})$') as blocked_extension
  from hosts),
based as (
  select *, case when {_IS_IP} then host when last_two in ({_quoted(TWO_LABEL_SUFFIXES)}) then last_three
                 else last_two end as domain,
    case when {_IS_IP} or not contains(host, '.') then null
         when last_two in ({_quoted(TWO_LABEL_SUFFIXES)}) then last_two else labels[-1] end as suffix
  from named),
checked as (
  select *, case when not is_valid then 'invalid_url'
                 when host in ({_quoted(BLOCKED_DOMAINS)}) or domain in ({_quoted(BLOCKED_DOMAINS)}) then 'blocked_domain'
                 when blocked_extension then 'blocked_extension' end as exclude_reason
  from based)"""

PARAGRAPHS = """unescaped as (
  select page_id, list_filter(list_transform(regexp_extract_all(html, '<p>([^<]*)</p>', 1),
      lambda p: replace(replace(replace(p, '&quot;', '"'), '&copy;', '©'), '&amp;', '&')),
      lambda p: len(string_split(p, ' ')) >= 4) as ps
  from pages),
paragraphs as (
  select page_id, coalesce(array_to_string(list_transform(ps, lambda p: trim(p)), ' '), '') as text,
    cast(len(ps) as bigint) as n_paragraphs,
    cast(coalesce(list_sum(list_transform(ps, lambda p: len(string_split(trim(p), ' ')))), 0) as bigint) as n_words
  from unescaped)"""


def signatures(docs: str = "documents", key: str = "doc_id") -> str:
    """CTEs ending in ``bands`` (key, sig, keys), from a relation with (key, text)."""
    slots = ", ".join(
        f"min((h * {(HASH_A_STEP * (k + 1) + HASH_A_BASE) % PRIME} % {PRIME} + {HASH_B_STEP * k}) % {PRIME}) as s{k}"
        for k in range(NUM_PERM)
    )
    names = ", ".join(f"coalesce(s{k}, {PRIME}) as s{k}" for k in range(NUM_PERM))
    keys = ", ".join(
        "concat_ws('-', " + ", ".join(f"s{k}" for k in range(3 * b, 3 * b + 3)) + ")" for b in range(3)
    )
    # CRC-32 of the distinct tokens from their UTF-8 bytes, then the tokens of a run as digits, modulo the prime.
    gram = "0"
    for k in range(5):
        gram = f"(({gram}) * {HASH_BASE} + c[i + {k}]) % {PRIME}"
    return f"""table_bits(i, c, n) as materialized (select i, case when i & 1 = 1 then xor(i >> 1, 3988292384) else i >> 1 end, 1 from range(256) t(i)),
{", ".join(f"table_bits{n}(i, c) as (select i, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from table_bits{n - 1 if n > 2 else ''})" for n in range(2, 9))},
crc_step as materialized (select list(c order by i) as s from table_bits8),
toks as (select {key}, regexp_extract_all(text, '{TOKEN}') as t from {docs}),
words as (select w, hex(encode(w)) as h from (select distinct unnest(t) as w from toks)),
crcs as (select w, xor(list_reduce(list_transform(range(0, len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint),
  lambda c, b: xor(c >> 8, s[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % {PRIME} as c from words, crc_step),
placed_toks as (select {key}, unnest(t) as w, unnest(range(len(t))) as i from toks),
digits as (select {key}, list(c order by i) as c from placed_toks join crcs using (w) group by {key}),
hashes as (select {key}, unnest(list_transform(range(1, len(c) - 3), lambda i: {gram})) as h from digits where len(c) >= 5),
mins as (select {key}, {slots} from hashes group by {key}),
sigs as (select d.{key}, {names} from {docs} d left join mins using ({key})),
bands as (select *, [{keys}] as band_keys from sigs)"""


def replay(order: str, key: str = "doc_id", source: str = "bands", key_type: str = "bigint") -> str:
    """CTEs ending in ``walk`` (key, kept): documents one after the other, with a list of used band keys."""
    return f"""queue as materialized (
  select row_number() over (order by {order}) as rn, {key},
    ['0:' || band_keys[1], '1:' || band_keys[2], '2:' || band_keys[3]] as keys from {source}),
steps as (
  select cast(0 as bigint) as rn, cast(null as {key_type}) as {key}, false as kept, cast([] as varchar[]) as used
  union all
  select q.rn, q.{key}, not list_has_any(s.used, q.keys),
    case when list_has_any(s.used, q.keys) then s.used else list_concat(s.used, q.keys) end
  from steps s join queue q on q.rn = s.rn + 1),
walk as (select {key}, kept from steps where rn > 0)"""


RECORD_SCORES = f"""{SUBS}, by_url as (
  select url, cast(sum(score) as bigint) as total_score from subs group by url),
scored as (
  select d.doc_id, d.text, d.lang, p.url, coalesce(u.total_score, 0) as total_score
  from documents d cross join (select count(*) n from pages) c join pages p on p.page_id = d.doc_id % c.n
  left join by_url u on u.url = p.url)"""

_UNESCAPED = "replace(replace(regexp_replace({}, '&quot;', '\"', 'g'), '&copy;', '©'), '&amp;', '&')"
_TITLE = _UNESCAPED.format("regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '&amp$', '&amp;')")
ARTICLES = f"""blocks as (
  select page_id, list_transform(string_split(split_part(regexp_extract(html, '<article>(.*)$', 1, 's'), '</article>', 1),
    '<p>')[2:], lambda p: trim(regexp_replace({_UNESCAPED.format(
        "regexp_replace(replace(split_part(p, '</p>', 1), '<br>', ' '), '<[^>]*>', '', 'g')"
    )}, '\\s+', ' ', 'g'))) as bs
  from pages),
articles as (
  select page_id, array_to_string(list_filter(bs, lambda b: b <> ''), chr(10) || chr(10)) as text from blocks)"""

_LINE_BYTES = """strlen('{"text":' || to_json(text) || ',"meta":{}}') + 1"""

_NEAR = f"with recursive {signatures()}, {replay('doc_id')}"
_FIRST_HALF = "cast(substr(source, 4) as integer) < 10"
_INCREMENTAL = f"""with recursive {signatures()},
  sided as (select b.*, {_FIRST_HALF} as first_half from bands b join documents using (doc_id)),
  {replay("not first_half, doc_id", source="sided")}
  select doc_id from walk where kept"""
_CLEAN = f"""with recursive {RECORD_SCORES}, chosen as (select * from scored where total_score >= {HIGH_SCORE}),
  {signatures("chosen")}, {replay("doc_id")}, clean as (select c.* from chosen c join walk w using (doc_id) where w.kept)"""
_BATCHED = f"cast((row_number() over (order by url) - 1) // {URLS_PER_BATCH} as bigint) as url_batch"
_ADDRESSES = """addressed as (
  select doc_id, source as source_file, cast(row_number() over (partition by source order by doc_id) - 1 as bigint) as doc_ord
  from documents)"""
_OUTCOMES = f"""{CHECKED}, {PARAGRAPHS}, outcomes as (
  select c.page_id, c.url, p.text, p.n_words, coalesce(c.exclude_reason, case when trim(p.text) = '' then 'empty_text' end) as reason
  from checked c join paragraphs p using (page_id))"""

ORACLES: dict[str, str] = {
    "read_dumps": f"with {SUBS} select {FLAT} from subs",
    "split_dumps": f"with {SUBS} select {FLAT} from subs",
    "link_posts": f"with {SUBS} select id, url, score from subs",
    "score_default": f"with {SUBS} select id, case when score = 5 then 0 else score end as score from subs",
    "quarantine": f"""with {POSTS} select subreddit as kind,
        case subreddit when 'error' then 'bad_json' when 'signup' then 'bad_id' else 'bad_created_utc' end as reason,
        count(*) as n from posts where subreddit in ('error', 'signup', 'view') group by 1, 2""",
    "dedup_by_id": f"""with {SUBS}, ranked as (
        select id // 2 as id, url, score, title, subreddit, created_utc,
          row_number() over (partition by id // 2 order by created_utc, url, score, title, subreddit) as rn from subs)
        select {FLAT} from ranked where rn = 1""",
    "base36_ids": """with digits as (
        select event_id, event_id * 1000003 as v, unnest(range(0, 13)) as k from events),
        spelled as (
        select event_id, any_value(v) as v, string_agg(
          substr('0123456789abcdefghijklmnopqrstuvwxyz', cast((v // cast(pow(36, k) as bigint)) % 36 + 1 as integer), 1),
          '' order by k desc) as s from digits where k < 12 group by event_id)
        select event_id, case when v = 0 then '0' else ltrim(s, '0') end as id36, v as decoded from spelled""",
    "epoch_times": f"""select event_id, strftime(date_trunc('second', ts), {ISO}) as whole,
        strftime(date_trunc('second', ts), {ISO}) as fraction from events""",
    "period_columns": """select strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as month, count(*) as n
        from orders group by 1""",
    "scan_submissions_period": f"""with {ORDER_SUBS} select {FLAT} from order_subs
        where created_utc >= timestamp '1996-06-01' and created_utc < timestamp '1998-06-01'""",
    "scan_submissions_open_start": f"""with {ORDER_SUBS}, shifted as (
        select * replace (created_utc + interval 10 years as created_utc) from order_subs)
        select {FLAT} from shifted
        where created_utc >= timestamp '2005-06-01' and created_utc < timestamp '2007-04-01'""",
    "submissions_tsv": f"with {SUBS} select {FLAT} from subs",
    "ordered_by_url": f"with {SUBS} select url, id, score from subs order by url, id",
    "dump_inventory": """with by_month as (
        select date_trunc('month', o_orderdate) + interval 12 years as month, case o_orderpriority
          when '1-URGENT' then 'zst' when '2-HIGH' then 'xz' when '3-MEDIUM' then 'bz2' when '4-NOT SPECIFIED' then 'xz'
          when '5-LOW' then 'old' end as format, count(*) as n
        from orders group by 1, 2),
        many as (select * from by_month where n > (select avg(n) from by_month)),
        usable as (
        select month, format, case format when 'old' then 0 when 'zst' then 1 when 'xz' then 2 else 3 end as rank from many
        where month >= timestamp '2007-01-01' and month <= timestamp '2013-12-01'
          and (case when month < timestamp '2011-01-01' then format = 'old' else format <> 'old' end)),
        best as (select month, arg_min(format, rank) as format from usable group by month)
        select strftime(month, '%Y-%m') as month, case when format = 'old' then 'RS_v2_' || strftime(month, '%Y-%m') || '.xz'
          else 'RS_' || strftime(month, '%Y-%m') || '.' || format end as file_name from best""",
    "verify_checksums": """select cast(d.doc_id as varchar) as file_name,
        case when l.doc_id is null then 'unlisted' when l.quality = 1 then 'ok' else 'mismatch' end as status
        from documents d left join labels l using (doc_id)""",
    "file_checksums": """select source, sha256(string_agg(doc_id || ' ' || md5(text) || chr(10), '' order by doc_id)) as actual
        from documents group by source""",
    "total_input_size": f"""select cast(sum({_LINE_BYTES}) as bigint) as total_bytes,
        round(sum({_LINE_BYTES}) / 1e6, 2) as total_mb from documents""",
    "url_record_arrays": f"""with {SUBS} select {_RECORD_COLUMNS} from subs group by url having sum(score) >= 3""",
    "url_records_high_score": f"""with {SUBS} select url, cast(sum(score) as bigint) as total_score, count(*) as n
        from subs group by url having sum(score) >= {HIGH_SCORE}""",
    "url_records_split": f"""with {SUBS} select url, cast(sum(score) as bigint) as total_score, count(*) as n,
        cast(sum(score) as bigint) as score_sum, cast(sum(id) as bigint) as id_sum
        from subs group by url having sum(score) >= 3""",
    "url_totals": f"""with {SUBS} select url, count(*) as n_submissions, cast(sum(score) as bigint) as total_score
        from subs group by url having sum(score) >= {HIGH_SCORE}""",
    "url_records_merged": f"""with {SUBS} select {_RECORD_COLUMNS} from subs group by url
        having sum(score) >= {HIGH_SCORE}""",
    "url_store": f"""with {ORDER_SUBS} select {_RECORD_COLUMNS} from order_subs group by url having sum(score) >= 3""",
    "url_batches": f"""with {SUBS}, urls as (select url from subs group by url having sum(score) >= 3)
        select url, {_BATCHED} from urls""",
    "url_batches_skipped": f"""with {SUBS}, urls as (select url from subs group by url having sum(score) >= 3),
        placed as (select url, row_number() over (order by url) - 1 as position from urls)
        select url, cast((position - 25) // {URLS_PER_BATCH} as bigint) as url_batch from placed where position >= 25""",
    "url_batch_files": f"""with {SUBS} select url,
        'scrapes_' || ((row_number() over (order by url) - 1) // {URLS_PER_BATCH}) || '.jsonl.zst' as output_name, count(*) as n, cast(sum(score) as bigint) as total_score,
        strftime(max(created_utc), {ISO}) as last_created from subs group by url having sum(score) >= 3""",
    "url_counts": f"""with {SUBS}, urls as (select url from subs group by url having sum(score) >= 3),
        batched as (select url, {_BATCHED} from urls)
        select url_batch, count(*) as n_urls from batched group by url_batch""",
    "stored_count": f"""with {SUBS}, urls as (select url from subs group by url having sum(score) >= 3)
        select count(*) as n_urls, count(*) as n_stored from urls""",
    "url_checks": f"""with {CHECKED} select page_id, url, exclude_reason, host, domain, suffix, is_valid, blocked_extension
        from checked""",
    "suffix_rules": """with hosts as (select page_id, string_split(lower(regexp_extract(url, '://([^/?#:]*)', 1)), '.') as l from pages),
        ends as (select page_id, l, unnest(range(1, len(l) + 1)) as k from hosts),
        tried as (select page_id, l, k, array_to_string(l[len(l) - k + 1:], '.') as s, array_to_string(l[len(l) - k + 2:], '.') as below from ends),
        best as (select page_id, any_value(l) as l, coalesce(max(k - 1) filter (s in ('m.example.net', 'ththth.example.net')),
            max(k) filter (s in ('com', 'example.com', 'org') or k > 1 and below in ('example.net', 'theres.example.com')), 1) as n
          from tried group by page_id)
        select page_id, array_to_string(l[len(l) - n + 1:], '.') as suffix, array_to_string(l[greatest(len(l) - n, 1):], '.') as domain from best""",
    "url_exclusion_counts": f"""with {CHECKED} select coalesce(exclude_reason, 'ok') as reason, count(*) as n
        from checked group by 1""",
    "busy_domains": f"""with hosts as (select page_id, url, string_split({_HOST}, '.') as labels from pages),
        sized as (select page_id, url, array_to_string(labels[-2:], '.') as domain, array_to_string(labels, '.') as host
          from hosts),
        counts as (select domain, count(*) as n from sized group by domain),
        busy as (select domain from counts where n > (select avg(n) from counts))
        select page_id, url, domain in (select domain from busy) or host in (select domain from busy) as listed
        from sized""",
    "extract_article": f"""with {CHECKED}, {ARTICLES}
        select c.url, case when c.exclude_reason is null then a.text end as text,
          case when c.exclude_reason is null then trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')) else '' end as title,
          case when c.exclude_reason is null then regexp_extract(html, '<html lang="([a-z]*)"', 1) end as lang,
          case when c.exclude_reason is null then cast(len(regexp_extract_all(a.text, '\\S+')) as bigint) end as word_count,
          c.domain, c.exclude_reason is null as success,
          coalesce(c.exclude_reason, case when a.text = '' then 'empty_text' end) as reason
        from checked c join articles a using (page_id)""",
    "article_titles": f"""select url, trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')) as title, regexp_extract(html, '<html lang="([a-z]*)"', 1) as lang, 'newspaper' as scraper, true as success
        from pages""",
    "extract_paragraphs": f"""with {PARAGRAPHS} select g.url, strip_accents(p.text) as text, p.n_words as word_count
        from paragraphs p join pages g using (page_id)""",
    "simple_paragraphs": f"with {PARAGRAPHS} select page_id, text, n_paragraphs, n_words from paragraphs",
    "nfkd": "select doc_id, strip_accents(text) as plain from documents",
    "clean_html": f"""with {CHECKED}, bare as (
        select url, exclude_reason, trim(replace(regexp_replace(regexp_replace(html,
          '<script\\b[^>]*>.*?</script\\s*>|<style\\b[^>]*>.*?</style\\s*>|<!--.*?-->|<!doctype[^>]*>', '', 'gis'),
          '\\s+', ' ', 'g'), '> <', '><')) as small from checked),
        visible as (select *, trim(regexp_replace(regexp_replace(small, '<title\\b[^>]*>.*?</title\\s*>', '', 'gis'),
          '<[^>]*>', '', 'g')) as seen from bare)
        select url, case when exclude_reason is null and seen <> '' then small end as html,
          exclude_reason is null and seen <> '' as success from visible""",
    "failures_by_reason": f"""with {_OUTCOMES}, counts as (
        select coalesce(reason, 'ok') as reason, count(*) as n from outcomes group by 1)
        select reason, n, round(n / sum(n) over () * 100, 2) as pct from counts""",
    "failures_by_batch": f"""with {_OUTCOMES} select cast(page_id // {URLS_PER_BATCH} as bigint) as url_batch,
        count(*) as n_urls, count(reason) as n_errors, round(count(reason) / count(*) * 100, 2) as error_pct
        from outcomes group by 1""",
    "successful_extractions": f"with {_OUTCOMES} select url from outcomes where reason is null",
    "document_meta": f"""with {SUBS}, {PARAGRAPHS}, records as (
        select url, string_agg(cast(id as varchar), '|' order by id) as reddit_id,
          string_agg(cast(score as varchar), '|' order by id) as reddit_score,
          string_agg(subreddit, '|' order by id) as subreddit, string_agg(title, '|' order by id) as reddit_title
        from subs group by url having sum(score) >= 3)
        select r.url, regexp_extract(g.html, '<html lang="([a-z]*)"', 1) as lang,
          array_to_string(string_split(split_part(split_part(r.url, '//', 2), '/', 1), '.')[-2:], '.') as domain,
          r.reddit_id, r.reddit_score, r.subreddit, r.reddit_title
        from records r join pages g using (url)""",
    "document_meta_split": f"""with {SUBS}, scored as (select url, sum(score) as total from subs group by url having sum(score) >= 3)
        select url, cast(total as bigint) as total_score, id, score from subs join scored using (url) join pages using (url)""",
    "url_files_split": f"""with {SUBS}, scored as (select url, sum(score) as total from subs group by url having sum(score) >= 3)
        select url, cast(total as bigint) as total_score, id, score from subs join scored using (url)""",
    "document_round_trip": """select doc_id, lang, n_chars, md5(text) as text_md5 from documents""",
    "document_open_meta": """select md5(text) as text_md5, case when lang <> 'fr'
        then '{"doc_id":' || doc_id || ',"source":"' || source || '"}' else '{}' end as meta from documents""",
    "document_lists": """select doc_id, md5(replace(text, ' ', chr(10) || chr(10))) as text_md5, '{}' as meta from documents""",
    "document_lists_kept": """select doc_id, cast(len(string_split(text, ' ')) as bigint) as n_paragraphs from documents""",
    "document_bare_strings": """select doc_id, md5(text) as text_md5 from documents""",
    "word_counts": """select doc_id, cast(len(regexp_extract_all(text, '[^\\s\\v\\x1c-\\x1f\\x{85}\\p{Z}]+')) as bigint) as n_words,
        cast(len(string_split(text, ' ')) as bigint) as n_pieces from documents""",
    "min_total_score": f"""with {RECORD_SCORES} select doc_id, total_score from scored where total_score >= {HIGH_SCORE}""",
    "min_total_score_default": f"""with {RECORD_SCORES} select doc_id from scored where total_score >= 3""",
    "language_filter": """select doc_id, lang from documents where lang in ('en', 'de')""",
    "detected_language": f"""with grams as (select doc_id, lang, source, unnest(flatten(list_transform(
          regexp_extract_all(lower(text), '\\p{{L}}+'), lambda w: ['_' || left(w, 2), right(w, 2) || '_']))) as g from documents),
        counts as (select lang, g, count(*) as n from grams where {_FIRST_HALF} and lang is not null group by lang, g),
        totals as (select lang, sum(n) as total from counts group by lang),
        top as (select * from counts qualify row_number() over (partition by lang order by n desc, g) <= 1000),
        bases as (select lang, total, cast(floor(ln(1.0::double / (total + 1000)) * 1000) as bigint) as base from totals),
        gains as (select t.lang, g, cast(floor(ln((n + 1)::double / (total + 1000)) * 1000) as bigint) - base as gain from top t join bases using (lang)),
        sizes as (select doc_id, count(*) as n from grams group by doc_id),
        hits as (select q.doc_id, p.lang, sum(gain) as s from grams q join gains p on p.g = q.g group by q.doc_id, p.lang),
        scores as (select z.doc_id, b.lang, z.n * b.base + coalesce(s, 0) as score from sizes z cross join bases b left join hits h on h.doc_id = z.doc_id and h.lang = b.lang)
        select doc_id, (select lang from scores c where c.doc_id = d.doc_id order by score desc, lang limit 1) as detected from documents d""",
    "min_tokens": f"""select doc_id from documents where len(regexp_extract_all(text, '{TOKEN}')) >= 128""",
    "size_table": """select source, round(sum(n_chars) / 1e6, 2) as mb,
        round(cast(sum(n_chars) as double) / (select sum(n_chars) from documents) * 100, 2) as pct
        from documents group by source""",
    "corpus_stats": """select count(*) as n_docs, cast(sum(length(text)) as bigint) as total_chars,
        cast(sum(strlen(text)) as bigint) as total_bytes, round(sum(length(text)) / 1e9, 2) as text_gb from documents""",
    "document_ordinals": f"with {_ADDRESSES} select doc_id, source_file, doc_ord from addressed",
    "documents_per_file": "select source, count(*) as n_docs from documents group by source",
    "file_ids": """with files as (
        select source, cast(row_number() over (order by source) - 1 as bigint) as file_id from documents group by source)
        select doc_id, source, file_id from documents join files using (source)""",
    "file_batches": f"""with recursive counted as (
        select source || '/' || lang as source, count(*) as n_docs from documents group by 1),
        files as materialized (
        select source, n_docs, cast(row_number() over (order by source) - 1 as bigint) as file_id,
          cast(sum(n_docs) over () as bigint) as total from counted),
        loop as (
        select cast(-1 as bigint) as file_id, cast(0 as bigint) as batch, cast(0 as bigint) as seen, cast(0 as bigint) as next_batch
        union all
        select f.file_id, l.next_batch, l.seen + f.n_docs,
          case when (l.seen + f.n_docs) * {N_BATCHES} > (l.next_batch + 1) * f.total then l.next_batch + 1
               else l.next_batch end
        from loop l join files f on f.file_id = l.file_id + 1)
        select f.file_id, f.source, f.n_docs, l.batch from files f join loop l using (file_id)""",
    "aligned_outputs": """select doc_id, 'scrapes_' || source || '_final.jsonl.zst' as source_file from documents""",
    "lines_per_file": "select source, count(*) as n_lines from documents group by source",
    "numbered_lines": f"""with {_ADDRESSES} select doc_id, source_file as source, doc_ord as line from addressed""",
    "bitmap_removal": f"""with {_ADDRESSES} select doc_id, source_file, doc_ord, cast(length(text) as bigint) as n_chars
        from addressed join documents using (doc_id) where doc_id not in (select doc_id from labels where quality = 0)""",
    "skip_done_files": """select distinct source as path from documents where source not in (
        select source from documents join labels using (doc_id) where toxic = 1)""",
    "word_tokens": f"""select doc_id, cast(len(regexp_extract_all(text, '{TOKEN}')) as bigint) as n_tokens,
        md5(array_to_string(regexp_extract_all(text, '{TOKEN}'), ' ')) as tokens_md5 from documents""",
    "shingles": f"""with toks as (select doc_id, regexp_extract_all(text, '{TOKEN}') as t from documents),
        sets as (select doc_id, case when len(t) >= 5 then list_sort(list_distinct(list_transform(range(1, len(t) - 3),
          lambda i: concat_ws(' ', t[i], t[i + 1], t[i + 2], t[i + 3], t[i + 4])))) else [] end as s from toks)
        select doc_id, cast(len(s) as bigint) as n_shingles, md5(coalesce(array_to_string(s, chr(10)), '')) as set_md5
        from sets""",
    "minhash": f"with {signatures()} select doc_id, {', '.join(f's{k}' for k in range(NUM_PERM))} from bands",
    "band_keys": f"""with {signatures()} select doc_id, cast(b as bigint) as band, band_keys[b + 1] as band_key
        from (select doc_id, band_keys, unnest([0, 1, 2]) as b from bands)""",
    "greedy_dedup": f"{_NEAR} select doc_id from walk where kept",
    "greedy_dedup_short_kept": f"""with recursive {signatures()},
        long as (select * from bands where s0 <> {PRIME} or s1 <> {PRIME}), {replay("doc_id", source="long")}
        select doc_id from walk where kept
        union all select doc_id from bands where s0 = {PRIME} and s1 = {PRIME}""",
    "lsh_candidates": f"""{_NEAR}, keyed as (
        select doc_id, unnest([0, 1, 2]) as band, unnest(band_keys) as band_key from bands),
        indexed as (select k.* from keyed k join walk w using (doc_id) where w.kept)
        select distinct k.doc_id, i.doc_id as found from keyed k join indexed i using (band, band_key)
        where k.doc_id <> i.doc_id""",
    "incremental_dedup": _INCREMENTAL,
    "compacted_index": f"""with recursive {signatures()},
        sided as (select b.*, cast(substr(source, 4) as integer) % 5 as batch from bands b join documents using (doc_id)),
        {replay("batch, doc_id", source="sided")}
        select unnest([0, 1, 2])::int as band, unnest(band_keys) as band_key, doc_id from bands join walk using (doc_id) where kept""",
    "duplicate_list": f"""with recursive {signatures()}, {_ADDRESSES},
        placed as (select b.*, a.source_file, a.doc_ord from bands b join addressed a using (doc_id)),
        {replay("source_file, doc_ord", source="placed")}
        select a.source_file, a.doc_ord from walk w join addressed a using (doc_id) where not w.kept""",
    "apply_duplicates": f"""{_NEAR} select d.doc_id, d.source, d.lang, d.n_chars
        from documents d join walk w using (doc_id) where w.kept""",
    "union_duplicates": f"""{_NEAR}, copies as (
        select doc_id, row_number() over (partition by text order by doc_id) as rn from documents)
        select doc_id from walk where not kept union select doc_id from copies where rn > 1""",
    "duplicate_stats": f"""{_NEAR} select count(*) as n_docs, count(*) filter (not kept) as n_duplicates,
        round((count(*) - count(*) filter (not kept)) / count(*) * 100, 2) as useful_pct from walk""",
    "clean_corpus": f"""{_CLEAN} select doc_id, url, lang, total_score, cast(length(text) as bigint) as n_chars from clean""",
    "release_table": f"""{_CLEAN}, both_releases as (
        select 'raw' as release, text from scored union all select 'clean', text from clean),
        sums as (select release, count(*) as n_docs, cast(sum(length(text)) as bigint) as total_chars,
          cast(sum(strlen(text)) as bigint) as total_bytes from both_releases group by release)
        select release, n_docs, total_chars, total_bytes,
          round(cast(n_docs as double) / (select n_docs from sums where release = 'raw') * 100, 2) as docs_pct,
          round(cast(total_chars as double) / (select total_chars from sums where release = 'raw') * 100, 2) as chars_pct
        from sums""",
    "release_by_month": f"""with {ORDER_SUBS} select strftime(created_utc, '%Y-%m') as month, count(*) as n_docs,
        cast(sum(length(title || ' ' || subreddit || ' ' || url)) as bigint) as total_chars from order_subs group by 1""",
    "corpus_from_dumps": f"""with recursive {SUBS}, {ARTICLES}, records as (
        select url, count(*) as n_links from subs group by url having sum(score) >= {HIGH_SCORE}),
        docs as (
        select r.url, r.n_links, a.text, trim(regexp_replace({_TITLE}, '\\s+', ' ', 'g')) as title
        from records r join pages g using (url) join articles a using (page_id) where a.text <> ''),
        {signatures("docs", "url")}, {replay("url", "url", key_type="varchar")}
        select d.url, d.title, cast(len(regexp_extract_all(d.text, '\\S+')) as bigint) as word_count, d.n_links
        from docs d join walk w using (url) where w.kept""",
    "stream_ingest": f"with {SUBS} select {FLAT} from subs",
    "verified_ingest": f"with {SUBS} select {FLAT} from subs where subreddit in ('click', 'error', 'view')",
    "ledger_stats": """with sums as (select lang, count(*) as n_docs, cast(sum(length(text)) as bigint) as total_chars,
          cast(sum(strlen(text)) as bigint) as total_bytes, count(*) filter (doc_id in (select doc_id from labels where quality = 0)) as n_duplicates
          from documents group by lang)
        select *, round(total_chars / 1e9, 2) as text_gb, round((n_docs - n_duplicates) / n_docs * 100, 2) as useful_pct from sums""",
    "stream_extraction": f"""with {_OUTCOMES} select url, n_words as word_count from outcomes where reason is null""",
    "stream_extraction_meta": f"""with {SUBS}, {_OUTCOMES}, records as (
        select url, cast(sum(coalesce(score, 0)) as bigint) as total_score, string_agg(cast(id as varchar), '|' order by id) as reddit_id
        from subs group by url)
        select url, n_words as word_count, total_score, reddit_id from outcomes join records using (url) where reason is null""",
    "stream_extraction_failures": f"""with {_OUTCOMES}
        select coalesce(starts_with(url, 'https://'), false) as secure, count(*) as n_urls, count(reason) as n_errors,
          round(count(reason) * 100.0::double / count(*), 2) as error_pct from outcomes group by 1""",
    "stream_dedup": _INCREMENTAL,
}

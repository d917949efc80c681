"""The registered queries of this package and the SQL that checks them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .conversation_trie import conversation_trie
from .decontaminate import mark_benchmark
from .exact_dedup import exact_dedup
from .html_text import extract_text
from .language_id import identify_languages
from .line_dedup import dedup_lines
from .ngram_join import join_ngrams
from .secrets import scan_secrets
from .sentence_pieces import MODEL_PATH, encode_pieces
from .sharding import shard_documents
from .spelling import group_spellings
from .url_filter import judge_urls
from .warc import archive_pages

SHARDS = 40

# The rules of the URL query.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _url_rules(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    return spark.sql(f"select * from values {rows} as rules(host, path, verdict)")


def q_secret_scans(spark, sf_dir):
    return scan_secrets(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def q_url_filters(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages, _url_rules(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def q_language_id(spark, sf_dir):
    return identify_languages(_table(spark, sf_dir, "documents"), keep=["doc_id"])


def q_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "text", "n_lines", "n_removed")


def q_sharding(spark, sf_dir):
    placed = shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def q_warc(spark, sf_dir):
    return archive_pages(_table(spark, sf_dir, "pages"))


def q_sentence_pieces(spark, sf_dir):
    return encode_pieces(_table(spark, sf_dir, "documents"), MODEL_PATH, keep=["doc_id"])


def q_benchmark_decontamination(spark, sf_dir):
    docs, items = (_table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return mark_benchmark(docs, items, keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def q_exact_dedup(spark, sf_dir):
    return exact_dedup(_table(spark, sf_dir, "documents"))


def q_ngram_join(spark, sf_dir):
    return join_ngrams(_table(spark, sf_dir, "documents"))


def q_spelling_variants(spark, sf_dir):
    return group_spellings(_table(spark, sf_dir, "documents"))


def q_conversation_trie(spark, sf_dir):
    return conversation_trie(_table(spark, sf_dir, "conversations"))


def q_html_extraction(spark, sf_dir):
    return extract_text(_table(spark, sf_dir, "pages"), keep=["page_id", "url"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scans": q_secret_scans,
    "op2_url_filters": q_url_filters,
    "op3_language_id": q_language_id,
    "op4_line_dedup": q_line_dedup,
    "op5_sharding": q_sharding,
    "op6_warc": q_warc,
    "op7_sentence_pieces": q_sentence_pieces,
    "op8_benchmark_decontamination": q_benchmark_decontamination,
    "op9_exact_dedup": q_exact_dedup,
    "op10_ngram_join": q_ngram_join,
    "op11_spelling_variants": q_spelling_variants,
    "op12_conversation_trie": q_conversation_trie,
    "op13_html_extraction": q_html_extraction,
}

_URL_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)
_URL_PATTERN = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_ASCII_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def _hex(place: str) -> str:
    return f"(instr('0123456789abcdef', substr(d, 1 + {place}, 1)) - 1)"


# The public CRC-32, byte by byte, over a list of bytes.
_CRC_TABLE = """
        crc_table as (
            select list(list_reduce([i] || range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) order by i) as crc
            from range(256) bytes(i))"""


def _crc32(bytes_list: str) -> str:
    step = "lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce([4294967295::bigint] || {bytes_list}, {step}), 4294967295)"


def _utf8(text: str) -> str:
    """The bytes of a text whose characters all lie below U+0800."""
    two = "[192 + unicode(x) // 64, 128 + unicode(x) % 64]"
    one = f"lambda x: case when unicode(x) < 128 then [unicode(x)] else {two} end"
    return f"flatten(list_transform(string_split({text}, ''), {one}))::bigint[]"


ORACLES: dict[str, str] = {
    "op2_url_filters": f"""
        with parsed as (
            select page_id,
                translate(regexp_extract(coalesce(url, ''), '{_URL_PATTERN}', 1), {_ASCII_LOWER}) as host,
                regexp_extract(coalesce(url, ''), '{_URL_PATTERN}', 2) as path
            from pages),
        rules(rule_host, rule_path, rule_verdict) as (values {_URL_VALUES}),
        fitting as (
            select page_id, host, path, rule_host || rule_path as rule, rule_verdict,
                row_number() over (partition by page_id order by
                    length(rule_host || rule_path) desc, length(rule_host) desc) as place
            from parsed left join rules
                on (host = rule_host or ends_with(host, '.' || rule_host))
                and starts_with(path, rule_path))
        select page_id, host, path, rule, coalesce(rule_verdict, 'allow') as verdict
        from fitting where place = 1""",
    "op4_line_dedup": """
        with split as (
            select doc_id, string_split(text, chr(10)) as lines from documents where text is not null),
        line as (
            select doc_id, unnest(range(len(lines))) as pos, unnest(lines) as line from split),
        windows as (
            select doc_id, pos, line as a, lead(line) over w as b, lead(line, 2) over w as c
            from line window w as (partition by doc_id order by pos)),
        numbered as (
            select doc_id, pos, row_number() over (partition by a, b, c order by doc_id, pos) as place
            from windows where c is not null),
        gone as (
            select distinct doc_id, pos + k as pos
            from numbered, (values (0), (1), (2)) t(k) where place > 1),
        kept as (
            select l.doc_id, count(*) as n_lines, count(g.pos) as n_removed,
                coalesce(string_agg(l.line, chr(10) order by l.pos) filter (where g.pos is null), '') as text
            from line l left join gone g on l.doc_id = g.doc_id and l.pos = g.pos group by l.doc_id)
        select d.doc_id, k.text, coalesce(k.n_lines, 0) as n_lines, coalesce(k.n_removed, 0) as n_removed
        from documents d left join kept k on d.doc_id = k.doc_id""",
    # Base32 of the digest, five bits at a time; a SHA-1 has 32 of them.
    "op6_warc": f"""
        with payload as (
            select page_id, coalesce(html, '') as body, strlen(coalesce(html, '')) as payload_bytes,
                max(page_id) over (partition by coalesce(html, '')) as response
            from pages),
        digits as (
            select page_id, string_agg(substr('{_BASE32}', 1 + cast(five as integer), 1), '' order by k)
                as payload_digest
            from (select page_id, k, (
                    {_hex("(5 * k) // 4")} * 16
                    + {_hex("(5 * k) // 4 + 1")}) // (1 << (3 - (5 * k) % 4)) % 32 as five
                from (select page_id, sha1(body) || '0' as d, unnest(range(32)) as k from payload))
            group by page_id)
        select page_id, payload_bytes, payload_digest,
            case when page_id = response then 'response' else 'revisit' end as record_type,
            case when page_id <> response then response end as refers_to
        from payload join digits using (page_id)""",
    "op8_benchmark_decontamination": rf"""
        with item as (
            select item_id, regexp_extract_all(translate(text, {_ASCII_LOWER}), '{_WORD}') as w
            from benchmark where text is not null),
        item_windows as (
            select distinct item_id, least(len(w), 10) as n,
                array_to_string(w[p : p + least(len(w), 10) - 1], ' ') as run
            from (select item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p
                from item where len(w) > 0)),
        doc as (
            select doc_id, coalesce(
                regexp_extract_all(translate(text, {_ASCII_LOWER}), '{_WORD}'), []) as w
            from documents),
        doc_windows as (
            select doc_id, n, p, array_to_string(w[p : p + n - 1], ' ') as run
            from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as p
                from doc, (select distinct n from item_windows) where len(w) >= n)),
        found as (
            select doc_id, d.n, p, item_id from doc_windows d join item_windows i
            on d.n = i.n and d.run = i.run),
        hit as (
            select doc_id, count(*) as n_hit from (
                select distinct doc_id, unnest(range(p, p + n)) as word from found) group by doc_id),
        items as (
            select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as list from (
                select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            sha256(coalesce(list, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from doc left join hit using (doc_id) left join items using (doc_id)""",
    "op9_exact_dedup": r"""
        with normal as (
            select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm
            from documents),
        grouped as (
            select doc_id, norm, min(doc_id) over (partition by norm) as keep_id,
                count(*) over (partition by norm) as group_size
            from normal)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
        from grouped""",
    "op10_ngram_join": rf"""
        with recursive words as (
            select doc_id, list_filter(
                string_split_regex(translate(text, {_ASCII_LOWER}), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
            from documents),
        shingles as materialized (
            select distinct doc_id, unnest(case
                when len(w) >= 5 then list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                when len(w) > 0 then [array_to_string(w, ' ')] end) as s
            from words),
        sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
        links as materialized (
            select a.doc_id as u, b.doc_id as v
            from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id
                join sizes x on x.doc_id = a.doc_id join sizes y on y.doc_id = b.doc_id
            group by a.doc_id, b.doc_id, x.n, y.n
            having 100 * count(*) >= 80 * (x.n + y.n - count(*))),
        reach(u, v) as (
            select doc_id, doc_id from documents
            union
            select r.u, l.v from reach r join links l on l.u = r.v),
        lowest as (select u as doc_id, min(v) as component_id from reach group by u)
        select doc_id, coalesce(n, 0) as n_shingles, component_id
        from documents left join sizes using (doc_id) join lowest using (doc_id)""",
    "op11_spelling_variants": rf"""
        with recursive {_CRC_TABLE},
        run as (
            select doc_id, run, count(*) as n, {_crc32(_utf8("coalesce(doc_id::varchar, '') || ':' || run"))} as h
            from (
                select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{{C0}}-\x{{FF}}]+')), {_ASCII_LOWER}) as run
                from documents where text is not null), crc_table
            group by doc_id, run, crc),
        words as (
            select word, sum(n)::bigint as n from (
                select n, case when h % 97 = 0
                    then substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) else run end as word
                from run)
            where length(word) >= 5 group by word having sum(n) >= 3),
        shorter as (
            select word, k, substr(word, 1, k) || substr(word, k + 2) as rest
            from (select word, unnest(range(length(word))) as k from words)),
        pairs as (
            select a.word, b.word as near from shorter a join shorter b on a.rest = b.rest and a.k = b.k where a.word <> b.word
            union select a.word, a.rest from shorter a join words b on a.rest = b.word
            union select a.rest, a.word from shorter a join words b on a.rest = b.word),
        placed as (
            select word, near, n, count(*) over (partition by word) as n_near,
                row_number() over (partition by word order by n desc, near) as place
            from pairs join (select word as near, n from words) using (near)),
        forms as (
            select w.word, w.n, coalesce(n_near, 0) as n_near,
                case when p.n >= 2 * w.n then near end as form, case when p.n >= 2 * w.n then p.n end as form_n
            from words w left join placed p on w.word = p.word and place = 1),
        steps as (
            select word, word as reached, 0 as step from forms
            union all
            select s.word, form, step + 1 from steps s join forms f on s.reached = f.word where form is not null)
        select word, form, root, n, n_near, form_n
        from forms join (select word, arg_max(reached, step) as root from steps group by word) using (word)""",
    "op12_conversation_trie": f"""
        with {_CRC_TABLE},
        own as (
            select conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}}
                order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as turns
            from conversations where conv_id is not null group by conv_id),
        taken as (select conv_id, turns, {_crc32(_utf8("conv_id::varchar"))} % 6 as h from own, crc_table),
        rebuilt as (
            select t.conv_id, coalesce(f.turns[1 : t.h], []) || t.turns[t.h + 1 :] as turns
            from taken t left join own f on f.conv_id = t.conv_id - t.conv_id % 100),
        members as (
            select conv_id, len(turns) as n, depth, turns[1 : depth] as path
            from (select *, unnest(range(len(turns) + 1)) as depth from rebuilt)),
        node as (
            select path, depth, min(conv_id) as conv_id, count(*) as n_convs,
                (count(*) - 1) * coalesce(length(path[-1].text), 0) as saved,
                sha256(coalesce(string_agg(conv_id, ',' order by conv_id) filter (where n = depth), '')) as ends_sha256
            from members group by path, depth),
        children as (
            select path[1 : depth - 1] as path, count(*) as n_children from node where depth > 0 group by all),
        counted as (select node.*, coalesce(n_children, 0) as n_children from node left join children using (path)),
        below as (
            select path[1 : above] as path, sum(saved)::bigint as saved_tokens, count(*) filter (where n_children = 0) as n_leaves
            from (select *, unnest(range(depth + 1)) as above from counted) group by 1)
        select c.conv_id, c.depth, p.conv_id as parent_conv_id, c.n_convs, c.n_children, n_leaves, saved_tokens, c.ends_sha256
        from counted c join below using (path) left join node p on c.depth > 0 and p.path = c.path[1 : c.depth - 1]""",
}

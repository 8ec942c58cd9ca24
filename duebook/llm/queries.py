"""Registered queries of the text operators, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline

from .blocks import main_text
from .common import read
from .langid import language_scores
from .lattice import embedding_links
from .lexical import ranked_search
from .line_rules import MAX_DOCUMENTS, MAX_REMOVED, line_rules
from .minhash import near_groups
from .packing import length_buckets
from .prefix_trie import prefix_trie
from .quality import quality_scores
from .sentencepieces import encode
from .topk import LARGEST, top_k
from .toxicity import toxicity
from .url_filter import PREFIXES, RULES, TRACKING, canonical, host_of, url_filter

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def register(fn):
        LLM_QUERIES[key] = fn
        if sql is not None:
            LLM_ORACLES[key] = sql
        return fn
    return register


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

@query("op5_line_rules", sql=rf"""
    with words as (
        select doc_id, source, coalesce(text, '') body, {WORDS} w from documents),
    windows as (
        select doc_id, i, count(*) over (partition by doc_id, win) times from (
            select doc_id, unnest(range(1, len(w) - 3)) i, array_to_string(w[i:i + 4], ' ') win
            from words)),
    covered as (
        select doc_id, count(distinct i + o) n from windows, range(0, 5) t(o)
        where times > 1 group by 1),
    lines as (
        select doc_id, source, unnest(string_split(body, chr(10))) line,
               generate_subscripts(string_split(body, chr(10)), 1) place from words),
    worded as (
        select doc_id, source, line, place, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) n,
               regexp_replace(trim(regexp_replace(lower(line), '[\x20\x09-\x0D]+', ' ', 'g')),
                              '[0-9]+', '0', 'g') norm
        from lines where regexp_matches(line, '[^\x20\x09-\x0D]')),
    shared as (
        select source, norm from worded group by 1, 2 having count(distinct doc_id) > {MAX_DOCUMENTS}),
    per_doc as (
        select doc_id, count(*) - count(distinct line) dup from worded group by 1),
    taken as (
        select doc_id, place, n from worded join shared using (norm)
        where worded.source is not distinct from shared.source),
    lost as (select doc_id, sum(n) gone from taken group by 1),
    cleaned as (
        select doc_id, string_agg(line, chr(10) order by place) filter (taken.doc_id is null) clean
        from lines left join taken using (doc_id, place) group by 1),
    counted as (
        select doc_id, len(w) n_words, len(array_to_string(w, '')) word_chars,
               len(body) - len(regexp_replace(body, '[#*$%&|<>]', '', 'g')) n_symbols,
               coalesce(dup, 0) n_dup_lines, coalesce(covered.n, 0) n_repeat_words,
               cast(coalesce(gone, 0) as bigint) removed_words, length(coalesce(clean, '')) clean_chars,
               md5(coalesce(clean, '')) clean_md5
        from words left join per_doc using (doc_id) left join covered using (doc_id)
             left join lost using (doc_id) left join cleaned using (doc_id))
    select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed,
           not (n_words < 10 or 100 * n_repeat_words > 20 * n_words)
           and removed_words <= {MAX_REMOVED} * n_words and n_words - removed_words >= 10 kept
    from counted""")
def op5_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """With the length and a hash of the text that is left."""
    docs = read(spark, folder, "documents").select("doc_id", "text", "source")
    clean = F.coalesce("clean_text", F.lit(""))
    return line_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept", F.length(clean).cast("long").alias("clean_chars"),
        F.md5(clean.cast("binary")).alias("clean_md5"))


def _ends(host: str, names) -> str:
    return " or ".join(f"{host} = '{n}' or {host} like '%.{n}'" for n in names)


def _fits(rule) -> str:
    return f"({_ends('host', [rule.host])}) and starts_with(path, '{rule.path}')"


_ORDERED = sorted(RULES, key=lambda r: -len(r.text))


@query("op9_url_filter", sql=rf"""
    with parts as (
        select page_id, url, coalesce(regexp_extract(url, '^(?s).*?://([^/?#]*)', 1), '') raw,
               coalesce(regexp_extract(url, '^(?s).*?://[^/?#]*([^?#]*)', 1), '') path from pages),
    named as (
        select *, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host from parts),
    asking as (
        select *, list_sort(list_filter(string_split(regexp_extract(url, '(?s)\?([^#]*)', 1), '&'),
                   lambda p: p <> '' and not regexp_matches(p, '^(?:{TRACKING})(?:=|$)'))) told from named),
    plain as (
        select *, case when host <> '' then concat(
                regexp_replace(host, '^(?:{PREFIXES})\.', ''), regexp_replace(path, '(?:/|\.html)$', ''),
                case when len(told) > 0 then '?' || array_to_string(told, '&') else '' end) end canonical,
               case {' '.join(f"when {_fits(r)} then '{r.text}'" for r in _ORDERED)} end as rule
        from asking),
    list as (select distinct canonical from plain where starts_with(md5(canonical), '0')),
    marked as (
        select *, rule is null and coalesce(canonical in (select canonical from list), false) listed from plain)
    select page_id, host, path, canonical, rule, listed,
           case {' '.join(f"when rule = '{r.text}' then '{r.verdict}'" for r in _ORDERED)}
                when listed then 'block' else 'allow' end verdict
    from marked""")
def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Pages judged by the rules, else by a list: one in sixteen of all canonical URLs, by their hash."""
    pages = read(spark, folder, "pages").select("page_id", "url")
    hashed = F.md5(canonical(F.col("url")).cast("binary"))
    listed = pages.where(hashed.startswith("0")).select("url")
    return url_filter(pages, listed, RULES).select(
        "page_id", "host", "path", "canonical", "rule", "listed", "verdict")


@query("op10_minhash", sql=r"""
    with recursive w as (
        select doc_id, regexp_extract_all(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x20\x09-\x0D]+') w from documents),
    shingles as (
        select distinct doc_id, array_to_string(w[i:i + 3], ' ') s
        from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) i from w
              where len(w) > 0)),
    sizes as (select doc_id, count(*) n from shingles group by 1),
    shared as (
        select x.doc_id x, y.doc_id y, count(*) c from shingles x join shingles y using (s)
        where x.doc_id <> y.doc_id group by 1, 2),
    links as (
        select x, y from shared join sizes a on a.doc_id = x join sizes b on b.doc_id = y
        where 100 * c >= 80 * (a.n + b.n - c)),
    reach as (
        select doc_id, doc_id r from documents
        union select reach.doc_id, y from reach join links on r = x)
    select doc_id, coalesce(n, 0) n_shingles, min(r) component_id, doc_id = min(r) kept
    from reach left join sizes using (doc_id) group by doc_id, n""")
def op10_minhash(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_groups(read(spark, folder, "documents"), size=4)
    return groups.select("doc_id", "n_shingles", "component_id", "kept")


@query("op3_quality")
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(read(spark, folder, "documents"))


@query("op4_language")
def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    """Documents: the declared language and the source as host are the further evidence."""
    return language_scores(read(spark, folder, "documents"))


@query("language_of_pages")
def language_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages: text without tags, the language the markup declares, host and address suffix."""
    page, host = F.col("html"), host_of(F.col("url"))
    body = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>", " ")
    pages = read(spark, folder, "pages").select(
        "page_id", body.alias("text"), F.when(host != "", host).alias("host"),
        F.regexp_extract(page, r"""(?i)<html\b[^>]*\blang\s*=\s*["']?([a-z]{2})""", 1).alias("lang"),
        F.when(host != "", F.substring_index(host, ".", -1)).alias("suffix"))
    return language_scores(pages, key="page_id", declared="lang", host="host", suffix="suffix")


@query("op6_packing")
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    return length_buckets(read(spark, folder, "documents"))


@query("pipeline", sql=corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op8_pieces")
def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    return encode(read(spark, folder, "documents"))


@query("op7_main_text")
def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = read(spark, folder, "pages").select("page_id", "url", "html")
    return main_text(pages, keep=("url",)).withColumn(
        "n_chars", F.length("text").cast("long")).drop("n_blocks")


@query("op1_lattice", sql="""
    with recursive unit as (
        select vec_id, v, sqrt(list_dot_product(v, v)) size
        from (select vec_id, embedding::double[] v from embeddings)
        where len(v) > 0 and len([x for x in v if x is null or not isfinite(x)]) = 0),
    links as (
        select a.vec_id x, b.vec_id y from unit a join unit b
        on a.vec_id <> b.vec_id and len(a.v) = len(b.v) and a.size > 0 and b.size > 0
           and list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.95),
    counts as (select x vec_id, count(*) n from links group by 1),
    reach as (
        select vec_id, vec_id r from embeddings
        union select reach.vec_id, y from reach join links on r = x)
    select vec_id, coalesce(n, 0) n_links, min(r) component_id, vec_id = min(r) kept
    from reach left join counts using (vec_id) group by vec_id, n""")
def op1_lattice(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_links(read(spark, folder, "embeddings"))


#: Unsigned CRC32 of the decimal text of ``c``, modulo 4, in steps of one bit.
_HEAD = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(
        range(8 * length(c::varchar)), lambda i: case when i % 8 = 0
            then ascii(substr(c::varchar, (i // 8 + 1)::int, 1))::bigint else 0 end)),
        lambda a, x: case when xor(a, x) & 1 = 1 then xor(xor(a, x) >> 1, 3988292384)
                          else xor(a, x) >> 1 end), 4294967295) % 4"""


@query("op11_prefix_trie", sql=rf"""
    with turns as (
        select conv_id c, sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''),
                                        coalesce(text, ''))) t,
               len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) w, turn
        from conversations where conv_id is not null),
    placed as (
        select c, t, w, row_number() over (partition by c order by turn nulls first, t) p from turns),
    convs as (select c, {_HEAD} h from (select distinct c from placed)),
    rebuilt as (
        select convs.c, t, w, 0 own, p from convs join placed b on b.c = convs.c - convs.c % 20 and p <= h
        union all
        select convs.c, t, w, 1, p from convs join placed b on b.c = convs.c and p > h),
    lists as (
        select convs.c, coalesce(list(t order by own, p) filter (t is not null), []) ts,
               coalesce(list(w order by own, p) filter (t is not null), []) ws
        from convs left join rebuilt using (c) group by 1),
    spots as (
        select c, d, sha256(array_to_string(ts[1:d], ',')) node,
               case when d > 0 then sha256(array_to_string(ts[1:d - 1], ',')) end up,
               case when d > 0 then ws[d] else 0 end w, d = len(ts) ends
        from (select c, ts, ws, unnest(range(0, len(ts) + 1)) d from lists)),
    nodes as (
        select d, node, up, min(c) c, count(*) n, min(w) w,
               sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) sha
        from spots group by d, node, up),
    kids as (select d - 1 d, up node, count(*) k from nodes where d > 0 group by 1, 2),
    -- each node with all nodes of its subtree, by a member of the lower one
    below as (
        select a.d, a.node, sum((l.n - 1) * l.w) saved, count(*) filter (k is null) leaves
        from nodes l left join kids on kids.d = l.d and kids.node = l.node
        join spots a on a.c = l.c and a.d <= l.d group by 1, 2)
    select x.c conv_id, x.d depth, y.c parent_conv_id, x.n n_convs, coalesce(k, 0) n_children,
           leaves n_leaves, cast(saved as bigint) saved_tokens, x.sha ends_sha256
    from nodes x join below b on b.d = x.d and b.node = x.node
    left join kids on kids.d = x.d and kids.node = x.node
    left join nodes y on y.d = x.d - 1 and y.node = x.up""")
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read(spark, folder, "conversations"))


@query("op12_top_k", sql=f"""
    with usable as (
        select vec_id, embedding::double[] x from embeddings
        where vec_id is not null and embedding is not null
          and len([c for c in embedding if c is null or not isfinite(c)]) = 0),
    whole as (
        select * from (select vec_id, [floor(256 * c) for c in x] v from usable)
        where coalesce(list_sum([c * c for c in v]), 0) < {LARGEST}),
    asked as (select distinct vec_id, v from whole where vec_id % 50 = 0),
    scored as (
        select q.vec_id query_id, q.v, c.vec_id, cast(coalesce(list_inner_product(q.v, c.v), 0) as bigint) score
        from asked q join whole c on c.vec_id <> q.vec_id and len(c.v) = len(q.v)),
    ranked as (
        select *, row_number() over (partition by query_id, v order by score desc, vec_id) place from scored)
    select query_id, cast(place as integer) as "rank", vec_id, score from ranked where place <= 5""")
def op12_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(read(spark, folder, "embeddings"))


_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query("op13_lexical_search", sql=rf"""
    with asked as (
        select item_id, text, unnest({_TERMS}) t from (select distinct item_id, text from benchmark)),
    listed as (select doc_id, {_TERMS} ts from documents),
    whole as (select count(*) c, sum(len(ts))::bigint l from listed where len(ts) > 0),
    hits as (
        select doc_id, n, t, count(*) tf from (select doc_id, len(ts) n, unnest(ts) t from listed)
        where t in (select t from asked) group by 1, 2, 3),
    weights as (
        select t, floor(1000 * ln((2 * max(c) + 2) / (2 * count(*) + 1)))::bigint w
        from hits, whole group by t),
    impacts as (
        select doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * c) // l))) impact
        from hits join weights using (t), whole),
    scores as (
        select item_id, text, doc_id, sum(impact)::bigint score
        from asked join impacts using (t) group by 1, 2, 3 having sum(impact) > 0),
    ranked as (
        select *, row_number() over (partition by item_id, text order by score desc, doc_id) place from scores)
    select item_id, cast(place as integer) as "rank", doc_id, score from ranked where place <= 10""")
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(read(spark, folder, "documents"), read(spark, folder, "benchmark"))

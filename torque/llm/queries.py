"""Registered queries of the operators: thin, whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (collocations, conversation_trie, decontamination, exact_dedup, line_dedup, lm_scoring, quality_rules, sentencepiece_codec, simhash,
               substring_dedup, suffix_dedup, token_counts, toxicity)
from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents, 4-word shingles, 4 bits."""
    return simhash.components(read_table(spark, sf_dir, "documents"))


@query
def op5_sentencepiece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text, and whether they decode to it."""
    return sentencepiece_codec.encode_checked(read_table(spark, sf_dir, "documents"))


@query
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact token counts of every whole text."""
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every whole text, fitted on labels outside the held-out third."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the hashed n-gram log-likelihood ratio of every whole text."""
    return quality_rules.quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text under ten-word windows of benchmark items."""
    return decontamination.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every whole text under 400-byte strings that stand elsewhere too."""
    return suffix_dedup.suffix_dedup(read_table(spark, sf_dir, "documents"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text under 50-word windows of an earlier document."""
    return substring_dedup.substring_dedup(read_table(spark, sf_dir, "documents"))


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every whole text that stand earlier: equal ones of any length but empty, and near
    ones, up to two edits and one for every five characters."""
    return line_dedup.line_dedup(read_table(spark, sf_dir, "documents"))


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every whole text, trusted documents against all."""
    return lm_scoring.lm_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal whole texts (A-Z lower-cased); the largest doc_id of each stays."""
    return exact_dedup.exact_dedup(read_table(spark, sf_dir, "documents"))


SQL["op13_exact_dedup"] = """
with t as (
    select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
    from documents)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(body) as text_sha256
from t window same as (partition by body)
"""


@query
def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    nodes = conversation_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))
    return nodes.drop("ref_conv_id", "ref_pos")


SQL["op11_conversation_prefix_trie"] = """
with turns as (
    select conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as turn,
           row_number() over (partition by conv_id order by turn nulls first) as pos
    from conversations where conv_id is not null),
convs as (
    select conv_id, list(turn order by pos) as own, conv_id::varchar as s from turns group by conv_id),
hashed as (
    select conv_id, own, xor(list_reduce(
        list_transform(range(1, length(s) + 1), lambda i: ascii(substr(s, i, 1))::bigint),
        lambda acc, byte: list_reduce(range(8), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)), xor(acc, byte)),
        4294967295::bigint), 4294967295) % 6 as h
    from convs),
rebuilt as (
    select c.conv_id, list_concat(coalesce(list_slice(b.own, 1, c.h), []), list_slice(c.own, c.h + 1, len(c.own))) as seq
    from hashed c left join hashed b on b.conv_id = c.conv_id - c.conv_id % 100),
members as (
    select conv_id, d as depth, list_slice(seq, 1, d) as prefix, len(seq) = d as is_end
    from (select *, unnest(range(len(seq) + 1)) as d from rebuilt)),
nodes as (
    select depth, prefix, min(conv_id) as conv_id, count(*) as n_convs,
           string_agg(case when is_end then conv_id::varchar end, ',' order by conv_id) as ends
    from members group by depth, prefix),
kids as (
    select depth - 1 as depth, list_slice(prefix, 1, depth - 1) as prefix, count(*) as n_children
    from nodes where depth > 0 group by all),
sized as (
    select n.*, coalesce(k.n_children, 0) as n_children,
           case when n.depth = 0 then 0 else (n_convs - 1) * length(n.prefix[n.depth].t) end as saved
    from nodes n left join kids k on k.depth = n.depth and k.prefix = n.prefix),
below as (
    select d as depth, list_slice(prefix, 1, d) as prefix, sum(saved)::bigint as saved_tokens,
           count(*) filter (n_children = 0) as n_leaves
    from (select *, unnest(range(depth + 1)) as d from sized) group by all)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, b.n_leaves, b.saved_tokens,
       sha256(coalesce(n.ends, '')) as ends_sha256
from sized n join below b on b.depth = n.depth and b.prefix = n.prefix
left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.prefix = list_slice(n.prefix, 1, n.depth - 1)
"""


@query
def op12_phrase_collocation_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 2,000 phrases of two to three words of each language, over all whole texts."""
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


SQL["op12_phrase_collocation_mining"] = """
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece
    from documents),
ws as (
    select lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') as w from pieces),
grams as (
    select lang, 1 as k, unnest(w) as phrase from ws
    union all
    select lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) from ws
    union all
    select lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) from ws),
f as (select lang, k, phrase, count(*) as f from grams group by all),
totals as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
candidates as (select *, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
cuts as (
    select lang, k, phrase, f as a, w[1] as lp, array_to_string(w[2:], ' ') as rp, 1 as cut from candidates
    union all
    select lang, k, phrase, f, w[1] || ' ' || w[2], w[3], 2 from candidates where k = 3),
scored as (
    select c.lang, c.k, c.phrase, c.a, x.f as l, y.f as r, cut,
           (1000000::hugeint * c.a * c.a // (x.f::hugeint * y.f))::bigint as score
    from cuts c join f x on x.lang = c.lang and x.phrase = c.lp and x.k = cut
    join f y on y.lang = c.lang and y.phrase = c.rp and y.k = c.k - cut),
weakest as (
    select * from scored qualify row_number() over (partition by lang, phrase, k order by score, cut) = 1),
inner_parts as (
    select lang, f, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase from candidates where k = 3),
kept as (
    select * from weakest s where not exists (
        select 1 from inner_parts i where i.lang = s.lang and i.phrase = s.phrase and 100 * i.f >= 50 * s.a)),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select r.lang, rank, phrase, a, l, r.r, t.n, score from ranked r join totals t on t.lang = r.lang where rank <= 2000
"""

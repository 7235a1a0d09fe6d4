"""The queries of this package, over the tables of a folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quadrille.llm import bit_sliced, bpe_count, decontaminate, kneser_ney, line_dedup, line_rules, merkle, ngram_join, packing, quality, token_store, url_filter, vector_codes
from quadrille.llm.tables import read_table
from quadrille.session import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TWINS: dict[str, str] = {}


def query(run: Query) -> Query:
    @wraps(run)
    def shipped(spark: SparkSession, sf: str) -> DataFrame:
        ship(spark)
        return run(spark, sf)

    QUERIES[run.__name__] = shipped
    return shipped


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.near_duplicates(read_table(spark, sf, "documents"), width=5, percent=75)


@query
def op2_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.judged(read_table(spark, sf, "pages"), url_filter.labelled_urls(), url_filter.RULES)


@query
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents").select("doc_id", "text")
    kept = line_dedup.without_repeats(docs, unit="passage")
    return kept.selectExpr("doc_id", "text", "coalesce(size(spans), 0) as n_removed", "spans as removed")


@query
def op4_language_model(spark: SparkSession, sf: str) -> DataFrame:
    return kneser_ney.language_scores(read_table(spark, sf, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


@query
def op6_token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_store.read_store(token_store.write_store(read_table(spark, sf, "documents"), path, end_id=2))


@query
def op7_bit_sliced_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return bit_sliced.top_k(read_table(spark, sf, "embeddings"))


@query
def op8_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return bpe_count.token_counts(read_table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(read_table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"))


@query
def op11_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.audited(read_table(spark, sf, "documents"))


@query
def op12_cover_tree_codes(spark: SparkSession, sf: str) -> DataFrame:
    return vector_codes.compressed(read_table(spark, sf, "embeddings"))


@query
def op13_line_rules(spark: SparkSession, sf: str) -> DataFrame:
    return line_rules.quality_rules(read_table(spark, sf, "documents"))


#: Levels that a twin unrolls: 16 ** 8 leaves of a source.
_LEVELS = 8


def _merkle_levels(first: str, last: str) -> str:
    """From the nodes ``<first>0`` (tree, rank, n, digest), the levels above them and the siblings of each."""
    parts = []
    for k in range(_LEVELS):
        run = "over (partition by tree, rank // 16 order by rank rows between"
        parts.append(
            f"""{last}{k} as (
    select tree, rank, n, coalesce(string_agg(digest, '') {run} unbounded preceding and 1 preceding), '') as before,
        coalesce(string_agg(digest, '') {run} 1 following and unbounded following), '') as after from {first}{k}
), {first}{k + 1} as (
    select tree, rank // 16 as rank, any_value(n) // 16 + if(any_value(n) % 16 = 0, 0, 1) as n, sha256(string_agg(digest, '' order by rank)) as digest
    from {first}{k} where n > 1 group by tree, rank // 16
    union all select tree, rank, n, digest from {first}{k} where n = 1
)"""
        )
    return ",\n".join(parts)


def _merkle_folds(start: str, siblings: str, name: str) -> str:
    """Folds ``<start>`` (tree, place, digest, proof and more) level by level with the siblings of each."""
    parts, before = [], start
    for k in range(_LEVELS):
        parts.append(
            f"""{name}{k} as (
    select f.* replace (if(s.n > 1, sha256(s.before || f.digest || s.after), f.digest) as digest, f.proof || s.before || s.after as proof)
    from {before} f join {siblings}{k} s on f.tree = s.tree and f.place // {16**k} = s.rank
)"""
        )
        before = f"{name}{k}"
    return ",\n".join(parts)


def _merkle_leaf(text: str) -> str:
    fields = [f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


_CRC32 = """xor(list_reduce(list_prepend(cast(4294967295 as ubigint), list_transform(range(1, length(id) + 1), lambda i: cast(ascii(id[i]) as ubigint))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda z: cast(z as ubigint))),
        lambda x, z: if(x % 2 = 1, xor(x >> 1, cast(3988292384 as ubigint)), x >> 1))), cast(4294967295 as ubigint))"""

TWINS["op11_merkle_manifest"] = f"""
with ids as (select *, cast(doc_id as varchar) as id, coalesce('=' || source, '-') as tree from documents),
leaves as (
    select doc_id, tree, {_merkle_leaf("text")} as leaf,
        case when {_CRC32} % {merkle.TAMPERED} = 0 then {_merkle_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as changed
    from ids
), placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as rank, count(*) over (partition by tree) as n from leaves
), a0 as (select tree, rank, n, leaf as digest from placed),
{_merkle_levels("a", "b")},
subroots as (select tree as own, row_number() over (order by tree) - 1 as place, digest as subroot from a{_LEVELS}),
c0 as (select 'all' as tree, place as rank, count(*) over () as n, subroot as digest from subroots),
{_merkle_levels("c", "d")},
e as (
    select p.doc_id, p.tree, p.leaf, p.rank as place, coalesce(p.changed, p.leaf) as digest, '' as proof, s.subroot, s.place as top
    from placed p join subroots s on p.tree = s.own
), {_merkle_folds("e", "b", "f")},
g as (select doc_id, leaf, subroot, 'all' as tree, top as place, digest, proof from f{_LEVELS - 1}),
{_merkle_folds("g", "d", "h")}
select doc_id, leaf, subroot, c.digest as root, sha256(proof) as proof_sha256, h.digest as folded_root, h.digest = c.digest as verified
from h{_LEVELS - 1} h join c{_LEVELS} c on h.tree = c.tree
"""


def _lloyd(k: int) -> str:
    """The parts' nearest entries of codebook ``b<k>``, as ``n<k>``."""
    return f"""n{k} as (
    select * from (
        select p.row, p.part, p.x, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as far,
            row_number() over (partition by p.row, p.part order by far, b.entry) as place
        from p join b{k} b on p.part = b.part
    ) where place = 1
)"""


def _means(k: int) -> str:
    return f"""b{k + 1} as (
    select b.part, b.entry, coalesce(m.x, b.x) as x from b{k} b left join (
        select part, entry, list(cast(floor_div as bigint) order by i) as x from (
            select part, entry, i, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) as floor_div
            from (select part, entry, unnest(x) as v, generate_subscripts(x, 1) as i from n{k}) group by part, entry, i
        ) group by part, entry
    ) m on b.part = m.part and b.entry = m.entry
)"""


TWINS["op12_cover_tree_codes"] = f"""
with v as (
    select row_number() over (order by vec_id nulls last) - 1 as row, vec_id, label, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
    from embeddings where embedding is not null and len(embedding) > 0 and len(embedding) % 16 = 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
    select row, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] as x from v, (select unnest(range(16)) as part)
), b0 as (select part, row as entry, x from p where row < 64),
{_lloyd(0)}, {_means(0)}, {_lloyd(1)}, {_means(1)}, {_lloyd(2)},
codes as (select row, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(far) as bigint) as error from n2 group by row),
digest as (select sha256(string_agg(array_to_string(x, ','), ',' order by part, entry)) as codebooks_sha256 from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from codes join v using (row), digest
"""
TWINS["op13_line_rules"] = f"""
with d as (select row_number() over () as row, doc_id, source as host, coalesce(text, '') as text from documents),
w as (select row, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words, len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols from d),
l as (
    select row, host, raw, lower(trim(regexp_replace(raw, '[\\x20\\x09-\\x0D]+', ' ', 'g'))) as line
    from (select row, host, unnest(string_split(text, chr(10))) as raw from d) where regexp_matches(raw, '[^\\x20\\x09-\\x0D]')
), frequent as (
    select host, line from (select host, line, count(distinct row) as n from l group by host, line) s
    join (select host as h, count(*) as documents from d group by host) t on s.host is not distinct from t.h
    where n > {line_rules.LEAST_DOCUMENTS} and 100 * n > {line_rules.PERCENT_DOCUMENTS} * documents
), removed as (
    select row, sum(len(string_split(l.line, ' '))) as n_removed_words
    from l join frequent f on l.line = f.line and l.host is not distinct from f.host group by row
), again as (select row, count(*) - count(distinct raw) as n_dup_lines from l group by row
), windows as (
    select row, unnest(range(1, len(words) - 1)) as p, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) as t from w
), twice as (select row, p from (select row, p, count(*) over (partition by row, t) as n from windows) where n > 1
), covered as (select row, count(distinct q) as n_repeat_words from (select row, unnest([p, p + 1, p + 2]) as q from twice) group by row
), counts as (
    select doc_id, cast(len(words) as bigint) as n_words, cast(length(array_to_string(words, '')) as bigint) as word_chars, cast(n_symbols as bigint) as n_symbols,
        cast(coalesce(n_dup_lines, 0) as bigint) as n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) as n_repeat_words,
        cast(coalesce(n_removed_words, 0) as bigint) as n_removed_words
    from d join w using (row) left join again using (row) left join covered using (row) left join removed using (row)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < {line_rules.LEAST_WORDS} or 100 * n_repeat_words > {line_rules.MOST_REPEATED_PERCENT} * n_words as base_failed,
    not (n_words < {line_rules.LEAST_WORDS} or 100 * n_repeat_words > {line_rules.MOST_REPEATED_PERCENT} * n_words)
        and 100 * n_removed_words <= {line_rules.PERCENT_REMOVED} * n_words as kept, n_removed_words
from counts
"""
TWINS["op7_bit_sliced_top_k"] = """
with v as (
    select vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
    select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 20 = 0
)
select query_id, rank, vec_id, score from (
    select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
) where rank <= 20
"""

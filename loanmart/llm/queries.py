"""Queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanmart.llm.common import read_table, ship_package


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents and pages (doc_id or page_id is NULL)."""
    from loanmart.llm.language import identify_all

    return identify_all(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "pages"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near-duplicate documents."""
    from loanmart.llm.jaccard import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written, read back and resolved."""
    from loanmart.llm.warc import warc_round_trip

    return warc_round_trip(read_table(spark, sf_dir, "pages"))


OP6_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes,
         sha256(coalesce(html, '')) as payload_digest
  from pages),
f as (select payload_digest, min(page_id) as first_id from p group by payload_digest)
select p.page_id, p.payload_bytes, p.payload_digest,
       case when p.payload_bytes >= 100 and p.page_id <> f.first_id then 'revisit' else 'response' end as record_type,
       case when p.payload_bytes >= 100 and p.page_id <> f.first_id then f.first_id end as refers_to
from p join f using (payload_digest)
"""

def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents."""
    from loanmart.llm.lm_scoring import score_documents

    return score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of benchmark items found in all documents."""
    from loanmart.llm.decontamination import report

    return report(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    from loanmart.llm.fingerprints import edited_fingerprints

    return edited_fingerprints(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents."""
    from loanmart.llm.toxicity import score_documents

    return score_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels").select("doc_id", "toxic"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of all documents."""
    from loanmart.llm.licenses import scan_licences

    return scan_licences(read_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer's vocabulary file, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    from loanmart.llm.bpe import encode_digests

    return encode_digests(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and selection of all documents."""
    from loanmart.llm.quality import grade_documents

    return grade_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest and proofs of all documents, checked against tampered rows."""
    from loanmart.llm.merkle import tampered_manifest

    return tampered_manifest(read_table(spark, sf_dir, "documents"))


_FIELD = "case when {0} is null then '-' else octet_length(encode({0}::varchar))::varchar || ':' || {0}::varchar end"


def _leaf_sql(n_chars: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", n_chars, '"text"')) + ")"


# crc32 bit by bit over the digits of the id; nodes of each tree level by level; siblings by
# the flipped last bit of a node's place on each level
OP11_SQL = f"""
with recursive crc as (
  select id, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(id::varchar, ''), lambda d: ascii(d)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) as crc
  from (select distinct doc_id as id from documents where doc_id is not null) ids),
leaves as (
  select doc_id, coalesce('=' || lang, '') as g, {_leaf_sql("n_chars")} as leaf,
    case when crc % 7 = 0 then {_leaf_sql("(n_chars::hugeint + 1)")} else {_leaf_sql("n_chars")} end as now
  from documents d left join crc c on d.doc_id = c.id),
placed as (
  select *, row_number() over (partition by g order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by g) as n
  from leaves),
tree as (
  select g, 0 as level, place, n, leaf as h from placed
  union all
  select g, level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place))
  from tree where n > 1 group by g, level, place // 2, n),
subroots as (select g, h, row_number() over (order by g) - 1 as place, count(*) over () as n from tree where n = 1),
trunk as (
  select 0 as level, place, n, h from subroots
  union all
  select level + 1, place // 2, (n + 1) // 2, sha256(string_agg(h, '' order by place))
  from trunk where n > 1 group by level, place // 2, n),
steps as (
  select p.g, p.place, t.level, xor(p.place >> t.level, 1) as beside, (p.place >> t.level) % 2 = 1 as is_right
  from placed p join (select distinct g, level, n from tree) t on t.g = p.g and t.n > 1
  union all
  select p.g, p.place, 1000 + t.level, xor(s.place >> t.level, 1), (s.place >> t.level) % 2 = 1
  from placed p join subroots s on s.g = p.g join (select distinct level, n from trunk) t on t.n > 1),
siblings as (
  select s.g, s.place, s.level, s.is_right, coalesce(case when s.level < 1000 then t.h else u.h end, '') as h
  from steps s
  left join tree t on t.g = s.g and t.level = s.level and t.place = s.beside
  left join trunk u on u.level = s.level - 1000 and u.place = s.beside),
paths as (
  select g, place, string_agg(h, '' order by level) as hashes, list({{'r': is_right, 'h': h}} order by level) as way
  from siblings group by g, place),
folding as (
  select p.g, p.place, p.now as h, 1 as step, w.way from placed p left join paths w on w.g = p.g and w.place = p.place
  union all
  select g, place, sha256(case when way[step].r then way[step].h || h else h || way[step].h end), step + 1, way
  from folding where step <= len(way))
select p.doc_id, p.leaf, s.h as subroot, r.h as root, sha256(coalesce(w.hashes, '')) as proof_sha256,
  f.h as folded_root, f.h = r.h as verified
from placed p join subroots s on s.g = p.g
join (select h from trunk where n = 1) r on true
left join paths w on w.g = p.g and w.place = p.place
join folding f on f.g = p.g and f.place = p.place and f.step = 1 + coalesce(len(w.way), 0)
"""


def op12_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    from loanmart.llm.subspace import near_vectors

    return near_vectors(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


_NUMBERS = "embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0"

OP12_SQL = f"""
with recursive v as (
  select row_number() over () as r, vec_id, label, embedding::double[] as e,
    coalesce(label is not null and {_NUMBERS} and len(list_filter(embedding, lambda c: c <> 0)) > 0, false) as ok
  from embeddings),
links as (
  select a.r as a, b.r as b from v a join v b on a.label = b.label and a.r <> b.r
  where a.ok and b.ok and len(a.e) = len(b.e) and list_cosine_similarity(a.e, b.e) >= 0.98),
reach as (select r, r as other from v union select reach.r, links.b from reach join links on links.a = reach.other),
least as (select reach.r, min(vec_id) as component_id from reach join v on v.r = reach.other group by reach.r)
select vec_id, (select count(*) from links where a = v.r) as n_links, component_id,
  coalesce(vec_id = component_id, false) as kept
from v join least on least.r = v.r
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors among all embeddings."""
    from loanmart.llm.hard_negatives import hard_negatives

    return hard_negatives(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


OP13_SQL = f"""
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda c: floor(256 * c::double)) as q
  from embeddings where label is not null and {_NUMBERS}),
scores as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, list_dot_product(a.q, b.q)::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
positives as (
  select anchor_id, other_id as positive_id, score as positive_score from scores where same
  qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5)
select p.anchor_id, positive_id, other_id as negative_id, positive_score, score as negative_score,
  cast(row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as integer) as rank
from positives p join scores s on s.anchor_id = p.anchor_id and not same
  and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


def _ready(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


_PLAIN = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_decontamination": op2_decontamination,
    "op3_fingerprints": op3_fingerprints,
    "op4_language": op4_language,
    "op5_jaccard": op5_jaccard,
    "op6_warc": op6_warc,
    "op7_toxicity": op7_toxicity,
    "op8_licences": op8_licences,
    "op9_bpe": op9_bpe,
    "op10_quality": op10_quality,
    "op11_merkle": op11_merkle,
    "op12_subspace": op12_subspace,
    "op13_hard_negatives": op13_hard_negatives,
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: _ready(f) for k, f in _PLAIN.items()}

ORACLE_SQL: dict[str, str] = {"op6_warc": OP6_SQL, "op11_merkle": OP11_SQL, "op12_subspace": OP12_SQL, "op13_hard_negatives": OP13_SQL}

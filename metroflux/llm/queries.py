"""One query per operator over a test-data directory, with production parameters, and their SQL where SQL has it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflux.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.bpe import encode_digest
    return encode_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.token_counts import count_tokens
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


@query
def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row against the manifest; where 2 divides the id's checksum, with the line breaks taken out of its text."""
    from metroflux.llm.merkle import check_documents
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return check_documents(read_table(spark, sf_dir, "documents"), tampered, F.replace("text", F.lit("\n"), F.lit("")))


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth row; where 7 divides the id, the row counts as of the next label."""
    from metroflux.llm.negatives import mine
    rows = read_table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", shifted), every=100, positives=5, negatives=10, low=30, high=90, scale=256)


@query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.byte_bpe import encode_digest
    return encode_digest(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                         public_tokenizers.PATTERN)


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.language_id import identify
    return identify(read_table(spark, sf_dir, "documents"))


@query
def op6_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.topk import search
    return search(read_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


@query
def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.toxicity import rate_documents
    return rate_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@query
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.jaccard import similar_groups
    return similar_groups(read_table(spark, sf_dir, "documents"), percent=80).select("doc_id", "n_shingles", "component_id")


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.substring_dedup import repeated_units
    return repeated_units(read_table(spark, sf_dir, "documents"), whole=True).drop("row")


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the cut runs as first-last line numbers, how many lines went, and the text that stays."""
    from metroflux.llm.line_dedup import drop_repeated_lines
    out = drop_repeated_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), with_runs=True)
    gone = F.aggregate("runs", F.lit(0), lambda n, r: n + r["last"] - r["first"] + 1)
    runs = F.array_join(F.transform("runs", lambda r: F.concat_ws("-", r["first"].cast("string"), r["last"].cast("string"))), ",")
    return out.select("doc_id", runs.alias("runs"), gone.cast("long").alias("lines_removed"), "text")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.decontaminate import contaminated
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("row")


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from metroflux.llm.secrets import scan
    return scan(read_table(spark, sf_dir, "documents"))


# --- DuckDB SQL of the operators that SQL can express -------------------------------------

ORACLE["op6_topk"] = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id as vec_id, cast(list_dot_product(q.w, c.w) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.w) = len(c.w) where q.vec_id % 50 = 0
),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5"""

ORACLE["op11_merkle"] = """
with recursive crc_table as (
  select list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as t
),
crc as (
  select doc_id, xor(4294967295, list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) as c from (select distinct doc_id from documents where doc_id is not null), crc_table
),
f as (
  select doc_id, source, text, (select c from crc where crc.doc_id = d.doc_id) % 2 = 0 as tampered,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-') || coalesce(strlen(source) || ':' || source, '-')
    || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as head
  from documents d
),
leaf as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as d,
    case when tampered then sha256(head || coalesce(strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''), '-')) end as other from f
),
placed as (select *, row_number() over (partition by source order by doc_id nulls first, d) - 1 as i from leaf),
node as (
  select 0 as lv, source, i, d from placed
  union all
  select max(lv) + 1, source, i // 3, sha256(string_agg(d, '' order by i))
  from (select *, count(*) over (partition by source) as n from node) x where n > 1 group by source, i // 3
),
subroot as (select source, d, row_number() over (order by source nulls first) - 1 as i from (
  select *, max(lv) over (partition by source) as top from node) x where lv = top),
upper as (
  select 0 as lv, i, d from subroot
  union all
  select max(lv) + 1, i // 3, sha256(string_agg(d, '' order by i)) from (select *, count(*) over () as n from upper) x where n > 1 group by i // 3
),
run as (  -- siblings of every node: the digests before and after it in its run
  select lv, source, i, coalesce(string_agg(d, '') over (w rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(d, '') over (w rows between 1 following and unbounded following), '') as after, max(lv) over (partition by source) as top
  from node window w as (partition by source, lv, i // 3 order by i)
),
upper_run as (
  select lv, i, coalesce(string_agg(d, '') over (w rows between unbounded preceding and 1 preceding), '') as before,
    coalesce(string_agg(d, '') over (w rows between 1 following and unbounded following), '') as after, max(lv) over () as top
  from upper window w as (partition by lv, i // 3 order by i)
),
step as (  -- lv counts on from the leaf to the root
  select p.source, p.i, r.lv, r.before, r.after from placed p
  join run r on r.source is not distinct from p.source and r.i = cast(floor(p.i / pow(3, r.lv)) as bigint) and r.lv < r.top
  union all
  select p.source, p.i, s.top + u.lv, u.before, u.after from placed p
  join (select b.source, b.i, max(n.lv) as top from subroot b join node n on n.source is not distinct from b.source group by 1, 2) s
    on s.source is not distinct from p.source
  join upper_run u on u.i = cast(floor(s.i / pow(3, u.lv)) as bigint) and u.lv < u.top
),
folded as (
  select source, i, 0 as lv, coalesce(other, d) as d from placed
  union all
  select f.source, f.i, cast(f.lv + 1 as integer), sha256(s.before || f.d || s.after) from folded f
  join step s on s.source is not distinct from f.source and s.i = f.i and s.lv = f.lv
),
proof as (select source, i, sha256(string_agg(before || after, '' order by lv)) as h, count(*) as steps from step group by 1, 2),
root as (select d from upper order by lv desc limit 1)
select p.doc_id, p.d as leaf, b.d as subroot, root.d as root, coalesce(h, sha256('')) as proof_sha256, f.d as folded_root, f.d = root.d as verified
from placed p join subroot b on b.source is not distinct from p.source cross join root
left join proof on proof.source is not distinct from p.source and proof.i = p.i
join folded f on f.source is not distinct from p.source and f.i = p.i and f.lv = coalesce(proof.steps, 0)"""

ORACLE["op12_negatives"] = """
with v as (
  select vec_id, cast(case when vec_id % 7 = 0 then (label + 1) % 10 else label end as bigint) as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as w from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
s as (
  select a.vec_id as anchor_id, a.label = c.label as same, c.vec_id, cast(list_dot_product(a.w, c.w) as bigint) as score
  from v a join v c on a.vec_id <> c.vec_id and len(a.w) = len(c.w) where a.vec_id % 100 = 0
),
p as (select *, row_number() over (partition by anchor_id order by score desc, vec_id) as i from s where same),
n as (
  select p.anchor_id, p.vec_id as positive_id, s.vec_id as negative_id, p.score as positive_score, s.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.vec_id order by s.score desc, s.vec_id) as integer) as rank
  from p join s on s.anchor_id = p.anchor_id and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
  where p.i <= 5
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10"""

ORACLE["op8_line_dedup"] = r"""
with d as (select doc_id, string_split(text, chr(10)) as lines from documents),
l as (select doc_id, unnest(lines) as line, unnest(range(len(lines))) as i, len(lines) as n from d),
x as (
  select *, lead(line, 1) over o as two, lead(line, 2) over o as three, words + coalesce(lead(words, 1) over o, 0) as words2
  from (select *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words from l) y window o as (partition by doc_id order by i)
),
w as (  -- runs of one and two lines need 20 words, a whole text of fewer than three lines one word
  select doc_id, i, 1 as d, false as whole, line as a, null as b, null as c from x where words >= 20
  union all select doc_id, i, 2, false, line, two, null from x where two is not null and words2 >= 20
  union all select doc_id, i, 3, false, line, two, three from x where three is not null
  union all select doc_id, i, n, true, line, two, null from x where i = 0 and n < 3 and words2 > 0
),
copies as (select *, row_number() over (partition by d, whole, a, b, c order by doc_id, i) as copy from w),
gone as (select distinct doc_id, i + k as i from copies, (values (0), (1), (2)) as t(k) where copy > 1 and k < d),
island as (select doc_id, i, i - row_number() over (partition by doc_id order by i) as island from gone),
runs as (select doc_id, min(i) as a, max(i) as b from island group by doc_id, island),
listed as (select doc_id, string_agg(a || '-' || b, ',' order by a) as runs, cast(sum(b - a + 1) as bigint) as n from runs group by doc_id),
kept as (select l.doc_id, string_agg(l.line, chr(10) order by l.i) as text from l anti join gone g on g.doc_id = l.doc_id and g.i = l.i group by l.doc_id)
select doc_id, coalesce(listed.runs, '') as runs, coalesce(listed.n, 0) as lines_removed, coalesce(kept.text, '') as text
from documents left join listed using (doc_id) left join kept using (doc_id)"""

ORACLE["op5_jaccard"] = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws from documents
),
c as (
  select doc_id, case when len(ws) = 0 then [] when len(ws) < 5 then [array_to_string(ws, ' ')]
    else list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) end as s from w
),
s as (select doc_id, len(s) as n, unnest(s) as x from c),
links as (
  select a.doc_id as a, b.doc_id as b from s a join s b on a.x = b.x and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
select c.doc_id, cast(len(c.s) as bigint) as n_shingles, m.b as component_id
from c join (select a, min(b) as b from reach group by a) m on m.a = c.doc_id"""

"""The registered queries of the subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barweave.llm import secrets
from barweave.llm.alignment import MADE, align_tokenizers
from barweave.llm.common import literal_rows, runs_of, table
from barweave.llm.decontamination import decontaminate
from barweave.llm.manifest import PROOF, merkle_manifest
from barweave.llm.mixing import measure, mix
from barweave.llm.near_join import near_classes
from barweave.llm.personal_data import (
    BASE,
    count_of,
    find_personal_data,
    learn,
    spans_text,
)
from barweave.llm.quality import judge_quality
from barweave.llm.sharding import assign_shards, fill_table
from barweave.llm.token_counts import apply_edits, build_trees
from barweave.llm.token_files import round_trip
from barweave.llm.toxicity import score_toxicity, train
from barweave.llm.url_filter import RULE_COLUMNS, judge_urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def registered(sql: str | None = None) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query

    return register


# --- 1: url filters --------------------------------------------------------------------

# Fixed values of the query: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
_RULE_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@registered(
    f"""with rules(rule_host, rule_path, rule_verdict) as (values {_RULE_VALUES}),
rest as (
  select page_id, case when instr(url, '://') > 0
    then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
parsed as (
  select row_number() over () as row, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from rest),
best as (
  select row, arg_max(rule_host || rule_path, length(rule_host || rule_path)) as rule,
    arg_max(rule_verdict, length(rule_host || rule_path)) as verdict
  from parsed join rules on (host = rule_host or ends_with(host, '.' || rule_host))
    and starts_with(path, rule_path) group by row)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from parsed left join best using (row)"""
)
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the longest rule that fits its url."""
    rules = literal_rows(spark, RULE_COLUMNS, URL_RULES)
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


# --- 4: sharding -----------------------------------------------------------------------

SHARDS = tuple(f"shard-{n:02d}" for n in range(16))
_OWNERS = ", ".join(map(str, fill_table(SHARDS)))


@registered(
    f"""with placed as (
  select doc_id, cast(('0x' || substr(md5(cast(doc_id as varchar)), 1, 15))::bigint
    % {len(fill_table(SHARDS))} as integer) as slot from documents)
select doc_id, slot, printf('shard-%02d', [{_OWNERS}][slot + 1]) as shard from placed"""
)
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot of the lookup table and the shard that owns it."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return assign_shards(docs, ["doc_id"], SHARDS)


# --- 5: quality rules ------------------------------------------------------------------


_QUALITY_SQL = r"""with docs as (
  select row_number() over () as row, doc_id, coalesce(text, '') as text,
    coalesce(source, '') as host, md5(coalesce(text, '')) as digest from documents),
worded as (
  select *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]'))
      as lines from docs),
windows as (
  select row, i, array_to_string(words[i:i + 7], ' ') as w
  from (select row, words, unnest(range(1, len(words) - 6)) as i from worded)),
again as (
  select row, i from (select row, i, count(*) over (partition by row, w) as n from windows)
  where n > 1),
covered as (
  select row, sum(least(8, coalesce(next - i, 8)))::bigint as n
  from (select row, i, lead(i) over (partition by row order by i) as next from again)
  group by row),
counts as (
  select worded.*, len(words)::bigint as n_words,
    length(array_to_string(words, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words from worded left join covered using (row)),
held as (
  select host, digest, trim(regexp_replace(regexp_replace(translate(line,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]+', '0', 'g'),
      '[\x20\x09-\x0D]+', ' ', 'g')) as line,
    len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda w: w <> '')) as n
  from (select host, digest, unnest(any_value(lines)) as line from worded group by host, digest)),
above as (
  select host, line from held join
    (select host, count(distinct digest) as texts from worded group by host) using (host)
  group by host, line, texts
  having count(distinct digest) >= 20 and count(distinct digest) > 0.05 * texts),
gone as (select host, digest, sum(n)::bigint as removed
  from held join above using (host, line) group by host, digest),
judged as (
  select *, coalesce(removed, 0)::bigint as n_removed_words,
    n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed
  from counts left join gone using (host, digest))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and 100 * (n_words - n_removed_words) >= 30 * n_words as kept, n_removed_words
from judged"""


@registered(_QUALITY_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, the base rules' verdict and the final one."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return judge_quality(docs).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "n_removed_words",
    )


# --- 8: mixing -------------------------------------------------------------------------


# The targets fill up as water does: the level is the one share per weight at which the
# sources together take all sizes, and no source is above three times its own.
_MIX_SQL = r"""with recursive sized as (
  select doc_id, md5(text) as digest,
    case when source is null then '1' else '0' || source end as s,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> ''))
      as size,
    ('0x' || substr(md5(concat_ws(':', '0', doc_id, md5(text))), 1, 15))::bigint as bits
  from documents),
ranked as (
  select s, sum(size)::bigint as source_size, count(*) as docs,
    [1, 2, 3][((row_number() over (order by s) - 1) % 3 + 1)::int] as w
  from sized group by s),
ordered as (
  select *, 3 * source_size as full_size, row_number() over (order by 3 * source_size / w, s) as n
  from ranked),
levels as (
  select n, full_size, w,
    (sum(source_size) over () - coalesce(sum(full_size) over before, 0))::double
    / (sum(w) over () - coalesce(sum(w) over before, 0))::double as share
  from ordered window before as (order by n rows between unbounded preceding and 1 preceding)),
level as (select arg_min(share, n) as share from levels where share * w <= full_size),
sources as (
  select s, source_size, least(full_size::double, share * w) as target,
    least(ceil(docs / 64), 65536)::bigint as blocks from ordered, level),
passes as (
  select *, floor(target / greatest(source_size, 1))::bigint as passes,
    target - floor(target / greatest(source_size, 1)) * source_size as rest from sources),
dealt as (select sized.*, source_size, target, passes, rest, bits % blocks as block
  from sized join passes using (s)),
block_sums as (
  select s, block, coalesce(sum(sum(size)) over (partition by s
    order by ('0x' || substr(md5(concat_ws(':', '0', s, block)), 1, 15))::bigint, block
    rows between unbounded preceding and 1 preceding), 0) as before
  from dealt group by s, block),
placed as (
  select dealt.*, before, coalesce(sum(size) over (partition by s, block order by bits
    rows between unbounded preceding and 1 preceding), 0) as ahead
  from dealt join block_sums using (s, block))
select doc_id, size, source_size, target,
  (size * (passes + (before < rest and 2 * (before + ahead) + size <= 2 * rest)::int))::bigint
    as taken
from placed"""


@registered(_MIX_SQL)
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and the words the mix takes of it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(measure(docs).drop("text", "source")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("copies")).alias("taken"),
    )


# --- 6: n-gram Jaccard join ------------------------------------------------------------


@registered()
def op6_near_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the component of near copies that it is in."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_classes(docs).select("doc_id", "n_shingles", "component_id", "n_links")


# --- 7: benchmark decontamination ------------------------------------------------------


@registered()
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its words inside benchmark windows and the items they are from."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# --- 9: token ids ----------------------------------------------------------------------


def vocabulary_file() -> str:
    """Path of the public vocabulary that the queries encode with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@registered()
def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in the token files, as read back from them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, vocabulary_file()).select("doc_id", "start", "n_tokens", "ids_crc32")


# --- 10: toxicity ----------------------------------------------------------------------


@registered()
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a score learnt from labels that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", "held_out", "score", "predicted")


# --- 3: personal data ------------------------------------------------------------------


@registered()
def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with counts and places of the personal data in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_personal_data(docs, learn(docs))
    counts = [count_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("all_spans")).alias("spans"),
    )


# --- 2: token counts -------------------------------------------------------------------


@registered()
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, before and after each run of digits in it becomes one zero."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = build_trees(docs, vocabulary_file()).withColumnRenamed("n_tokens", "n_before")
    edits = F.transform(
        runs_of("text", "[0-9]+"),
        lambda run: F.struct(run["start"], run["stop"], F.lit("0").alias("replacement")),
    )
    done = apply_edits(trees.withColumn("edits", edits), vocabulary_file())
    return done.select("doc_id", "n_before", "n_edits", "n_recoded", F.col("n_tokens").alias("n_after"))


# --- 12: Merkle manifest ---------------------------------------------------------------


def _leaf_sql(n_chars: str) -> str:
    values = ("doc_id", "source", "lang", n_chars, "text")
    parts = (
        f"coalesce(strlen(({v})::varchar) || ':' || ({v})::varchar, '-')" for v in values
    )
    return f"sha256({' || '.join(parts)})"


def _crc32_sql(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda c: ord(c)::ubigint)"
    bit = "case when x % 2 = 1 then xor(x >> 1, 3988292384) else x >> 1 end"
    byte = f"list_reduce(list_prepend(xor(c, b), repeat([0::ubigint], 8)), lambda x, y: {bit})"
    return f"xor(list_reduce(list_prepend(4294967295::ubigint, {codes}), lambda c, b: {byte}), 4294967295)"


_MANIFEST_SQL = f"""with recursive leaves as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place,
    row_number() over () as row
  from (select doc_id, n_chars, coalesce('+' || lang, '') as tree, {_leaf_sql("n_chars")} as leaf,
    {_leaf_sql("n_chars + 1")} as changed from documents)),
nodes as (
  select tree, 0 as level, place, leaf as hash, count(*) over (partition by tree) as n from leaves
  union all
  select tree, level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (max(n) + 1) // 2
  from nodes where n > 1 group by tree, level, place // 2),
subroots as (select tree, hash, row_number() over (order by tree) - 1 as place
  from nodes where n = 1),
roofs as (
  select 0 as level, place, hash, count(*) over () as n from subroots
  union all
  select level + 1, place // 2, sha256(string_agg(hash, '' order by place)), (max(n) + 1) // 2
  from roofs where n > 1 group by level, place // 2),
steps as (
  select row, x.level, x.place % 2 as side, y.hash as sibling
  from leaves join nodes x on x.tree = leaves.tree and x.place = leaves.place >> x.level and x.n > 1
  left join nodes y on y.tree = x.tree and y.level = x.level and y.place = xor(x.place, 1)
  union all
  select row, 1000 + x.level, x.place % 2, y.hash
  from leaves join subroots s on s.tree = leaves.tree
  join roofs x on x.place = s.place >> x.level and x.n > 1
  left join roofs y on y.level = x.level and y.place = xor(x.place, 1)),
paths as (
  select row, list(side || coalesce(sibling, '') order by level) as path,
    coalesce(string_agg(sibling, '' order by level), '') as proof
  from steps group by row),
folded as (
  select doc_id, leaf, subroots.hash as subroot, (select hash from roofs where n = 1) as root,
    sha256(coalesce(proof, '')) as proof_sha256,
    list_reduce(list_prepend(
      case when {_crc32_sql("doc_id::varchar")} % 7 = 0 and n_chars is not null then changed else leaf end,
      coalesce(path, [])), lambda node, p:
      case when p[1] = '1' then sha256(p[2:] || node) else sha256(node || p[2:]) end) as folded_root
  from leaves left join paths using (row) join subroots using (tree))
select *, folded_root = root as verified from folded"""


@registered(_MANIFEST_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof; every seventh or so is tampered with before it is checked."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    chosen = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    more = F.col("n_chars").cast("decimal(38,0)") + 1
    tampered = F.when(chosen, more).otherwise(F.col("n_chars").cast("decimal(38,0)"))
    return merkle_manifest(docs, tampered={"n_chars": tampered}).select(*PROOF)


# --- 13: secrets -----------------------------------------------------------------------


@registered()
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with counts and places of the secrets in it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find_secrets(docs, secrets.learn_levels(docs))
    counts = [count_of(F.col("base_spans"), kind).alias(f"n_{kind}") for kind in secrets.BASE]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
        spans_text(F.col("all_spans")).alias("spans"),
    )


# --- 11: alignment of two tokenizers ----------------------------------------------------


@registered()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two vocabularies, how they overlap, and how usual that is."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise(F.lit(""))
    return align_tokenizers(docs, *files).select(
        "doc_id", *MADE[:-1], digest.alias("groups_sha256")
    )

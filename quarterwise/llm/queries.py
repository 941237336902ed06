"""The registered queries op1 to op13 and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterwise.llm import decontamination, exact_dedup, html_text, language_id, language_model, line_dedup, merkle, mixing, near_dedup, periodic, pii, secrets_scan, toxicity
from quarterwise.llm.columns import packed

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_decontaminate")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold benchmark items, and how much of the most covered one."""
    return decontamination.contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: Size of a document in words, and its place in the stream of its source, as the operator has them.
_MIX_SQL = r"""
with d as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         md5(coalesce(doc_id::varchar, '-' || coalesce(text, ''))) as place
  from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as number from d group by source),
w as (select *, (number - 1) % 3 + 1 as weight, 3 * source_size as cap from s),
l as (select *, (sum(source_size) over () - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0))::double
        / sum(weight) over (o rows between current row and unbounded following) as level
      from w window o as (order by cap / weight, number)),
t as (select source, source_size, least(cap::double, weight * max(level) over ()) as target from l),
p as (select d.*, source_size, target, floor(target + 0.5)::bigint as words,
        coalesce(sum(size) over (partition by d.source order by place, size rows between unbounded preceding and 1 preceding), 0)::bigint as start
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (case when size = 0 then 0 else (words // greatest(source_size, 1)) * size + greatest(0, least(size, words % greatest(source_size, 1) - start)) end)::bigint as taken
from p
"""


@query("op2_mix_sources", _MIX_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document in a mix of all sources."""
    return mixing.mixed(documents(spark, sf_dir)).select("row.doc_id", "size", "source_size", "target", "taken")


def _listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of these kinds, comma-joined."""
    own = F.filter(spans, lambda s: s.kind.isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


@query("op3_personal_data")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: base spans by pattern, further ones by learned contexts."""
    found = pii.spans(documents(spark, sf_dir), keep=["doc_id"]).select("row.doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    every = (*pii.KINDS, *(pii.FOUND + k for k in pii.KINDS))
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(_listed(F.col("spans"), pii.KINDS), 256).alias("base_sha256"), _listed(F.col("spans"), every).alias("spans"))


@query("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of each document: base spans by pattern, further ones by novelty."""
    found = secrets_scan.spans(documents(spark, sf_dir), keep=["doc_id"]).select("row.doc_id", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = secrets_scan.KINDS[:3]
    return found.select("doc_id", *[count(k) for k in base], F.sha2(_listed(F.col("spans"), base), 256).alias("base_sha256"), _listed(F.col("spans"), secrets_scan.KINDS).alias("spans"))


_EXACT_SQL = """
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id is not distinct from max(doc_id) over w as kept, sha256(body) as text_sha256
from d window w as (partition by body)
"""


@query("op5_exact_copies", _EXACT_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which row of equal texts stays, for every document."""
    return exact_dedup.copies(documents(spark, sf_dir))


@query("op6_language_model")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of each whole text; the held-out fifth is not learned from."""
    docs = documents(spark, sf_dir)
    rows = packed(docs, ["doc_id"], text=F.col("text"))
    training = docs.where(~toxicity.held_out(F.col("doc_id"), 5, 1)).select("text")
    doc_id = F.col("row.doc_id")
    return language_model.scores(rows, training).select(doc_id, toxicity.held_out(doc_id, 5, 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document; labels of the held-out third are not seen."""
    labels = toxicity.fold_of_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scores(documents(spark, sf_dir), labels, keep=["doc_id"])
    doc_id = F.col("row.doc_id")
    return scored.select(doc_id, toxicity.held_out(doc_id).alias("held_out"), "score", (F.col("score") >= toxicity.REJECT).cast("int").alias("predicted"), "hits")


#: Links from counts of common shingles; components by growing reachable sets, small on documents without huge groups.
_NEAR_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
  from documents),
s as (
  select doc_id, case when len(words) = 0 then [] when len(words) = 1 then [words[1]]
    else list_distinct([words[i] || ' ' || words[i + 1] for i in range(1, len(words))]) end as shingles
  from w),
n as (select doc_id, len(shingles)::bigint as n_shingles from s),
e as (select doc_id, unnest(shingles) as shingle from s),
c as (select a.doc_id as a, b.doc_id as b, count(*) as common from e a join e b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all),
l as (select a, b from c join n x on a = x.doc_id join n y on b = y.doc_id where 100 * common >= 80 * (x.n_shingles + y.n_shingles - common)),
both_ways as (select a, b from l union all select b, a from l),
reach(doc_id, other) as (
  select doc_id, doc_id from n
  union
  select r.doc_id, l.b from reach r join both_ways l on r.other = l.a)
select doc_id, n_shingles, min(other) as component_id, doc_id = min(other) as kept from reach join n using (doc_id) group by doc_id, n_shingles
"""


@query("op8_near_copies", _NEAR_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near copies of each document, on two-word shingles."""
    return near_dedup.near_copies(documents(spark, sf_dir), shingle=2)


@query("op9_language_id")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of each document; the held-out quarter is not learned from."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = language_id.learn(docs.where(~toxicity.held_out(F.col("doc_id"), 4, 2)).select("text", "lang"))
    doc_id = F.col("row.doc_id")
    return language_id.identify(docs, model, keep=["doc_id"]).select(doc_id, toxicity.held_out(doc_id, 4, 2).alias("held_out"), "lang_pred", "score")


@query("op10_main_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return html_text.main_text(pages, keep=["page_id", "url"]).select("row.page_id", "row.url", "text", F.length("text").cast("long").alias("n_chars"))


#: Bits of a byte through the CRC-32 polynomial, and the checksum of a number's decimal digits.
_CRC_SQL = """
crc as (select list(list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from (select unnest(range(256)) as i)),
checked as (select *, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) as crc32 from documents, crc)"""


def _field_sql(name: str) -> str:
    return f"coalesce(strlen(({name})::varchar)::varchar || ':' || ({name})::varchar, '-')"


def _tree_sql(name: str, nodes: str, levels: int) -> str:
    """Levels of trees over `nodes` (tree, place, digest): `{name}_runs{k}` with the children of level k, `{name}_left` what is left of each tree."""
    parts = [f"{name}0 as (select *, max(place) over (partition by tree) as last from {nodes})"]
    for k in range(1, levels + 1):
        parts.append(f"{name}_runs{k} as (select tree, place // 16 as place, list(digest order by place) as children from {name}{k - 1} where last > 0 group by 1, 2)")
        parts.append(f"{name}{k} as (select tree, place, sha256(array_to_string(children, '')) as digest, max(place) over (partition by tree) as last from {name}_runs{k})")
    left = " union all ".join(f"select tree, digest from {name}{k} where last = 0" for k in range(levels + 1))
    return ",\n".join([*parts, f"{name}_left as ({left})"])


def _merkle_sql(levels: int = 5, above: int = 3) -> str:
    """Nodes level by level; a document's siblings are those of its run on each level. Up to 16**levels documents a source, 16**above sources."""
    fields = [f"f_{f}" for f in ("doc_id", "source", "lang", "n_chars")]
    head = ", ".join(f"{_field_sql(f)} as f_{f}" for f in ("doc_id", "source", "lang", "n_chars"))
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    steps = [("s", k, "d.tree", "d.place") for k in range(1, levels + 1)] + [("r", k, "0", "d.tree") for k in range(1, above + 1)]
    joins = " ".join(f"left join {t}_runs{k} as {t}j{k} on {t}j{k}.tree = {tree} and {t}j{k}.place = {at} // {16**k}" for t, k, tree, at in steps)
    sides = ", ".join(
        f"coalesce(array_to_string({t}j{k}.children[1:{at} // {16 ** (k - 1)} % 16], ''), '') as {t}a{k}, "
        f"coalesce(array_to_string({t}j{k}.children[{at} // {16 ** (k - 1)} % 16 + 2:], ''), '') as {t}b{k}, {t}j{k}.children is null as {t}n{k}"
        for t, k, _, at in steps
    )
    folds, node = [], "presented"
    for t, k, _, _ in steps:
        folds.append(f"fold_{t}{k} as (select *, case when {t}n{k} then node else sha256({t}a{k} || node || {t}b{k}) end as next from {folds and f'(select * exclude (node, next), next as node from fold_{last})' or '(select *, presented as node from paths)'})")
        last = f"{t}{k}"
    proof = " || ".join(f"{t}a{k} || {t}b{k}" for t, k, _, _ in steps)
    return f"""
with {_CRC_SQL.strip()},
f as (select doc_id, source, crc32, text, {_field_sql('text')} as f_text, {head} from checked),
l as (select doc_id, source, sha256({' || '.join(fields)} || f_text) as leaf,
    sha256({' || '.join(fields)} || case when crc32 % 5 = 0 then {_field_sql(lowered)} else f_text end) as presented from f),
d as (select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place from l),
nodes as (select tree, place, leaf as digest from d),
{_tree_sql('s', 'nodes', levels)},
subroots as (select 0 as tree, tree as place, digest from s_left),
{_tree_sql('r', 'subroots', above)},
paths as (select d.*, {sides} from d {joins}),
{(',' + chr(10)).join(folds)}
select doc_id, leaf, s_left.digest as subroot, r_left.digest as root, sha256({proof}) as proof_sha256, next as folded_root, next = r_left.digest as verified
from fold_{last} as x join s_left on s_left.tree = x.tree, r_left
"""


@query("op11_merkle_manifest", _merkle_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's proof in the manifest of all, and the root that it gives where every fifth text has been altered."""
    docs = documents(spark, sf_dir)
    altered = {f: F.col(f) for f in merkle.FIELDS} | {"text": F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")}
    tampered = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, merkle.leaf_digest(list(altered.values())))
    made = merkle.manifest(merkle.document_leaves(docs, ["doc_id"], tampered=tampered))
    requests = made.leaves.select(F.struct("row.doc_id", "tampered").alias("request"), "tree", "at")
    found = merkle.proofs(made, requests).withColumn("folded_root", merkle.folded(F.coalesce("request.tampered", "leaf"), F.col("path")))
    return found.select(
        "request.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )

def _planted(docs: DataFrame) -> DataFrame:
    """The texts, every tenth by its id's checksum with its words from a place on repeated over and over."""
    check = F.crc32(F.col("doc_id").cast("string"))
    chosen = F.when(check % 10 == 0, F.regexp_extract_all("text", F.lit(mixing.WORD), F.lit(0)))
    numbers = docs.select("doc_id", "text", F.floor(check / 10).alias("g"), chosen.alias("words")).withColumn("n", F.size("words"))
    numbers = numbers.withColumn("a", (F.col("g") % F.greatest("n", F.lit(1))).cast("int"))
    numbers = numbers.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    cycle = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), times))
    repeated = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(cycle, F.lit(1), F.col("n") - F.col("a")))
    return numbers.select("doc_id", F.when(F.col("n") > 0, F.array_join(repeated, " ")).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in each document, the longest one, and what is left when each keeps one period."""
    found = periodic.periodic_runs(_planted(documents(spark, sf_dir)), keep=["doc_id"])
    first = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))), "")
    return found.withColumn("first", first).select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("first.start")).alias("start"),
        F.col("first.length").alias("length"),
        (-F.col("first.period")).alias("period"),
        F.expr("(1000 * first.length) div -first.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_LINES_SQL = r"""
with d as (select row_number() over () as row, doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
l as (select row, doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as place from d),
k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
often as (select key, max(doc_id) as top from k where length(key) >= 20 group by key having count(distinct row) >= 3),
m as (select k.*, often.key is not null and doc_id is distinct from top as lost from k left join often on k.key = often.key)
select any_value(doc_id) as doc_id, count(*) as n_lines, count_if(lost)::bigint as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by place) filter (where not lost), '')) as kept_sha256
from m group by row
"""


@query("op13_line_dedup", _LINES_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that larger ids hold as well, and what stays of the text."""
    kept = line_dedup.without_repeated_lines(documents(spark, sf_dir), keep=["doc_id"])
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))

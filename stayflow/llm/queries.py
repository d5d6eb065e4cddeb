"""The registered queries of this package, with SQL twins where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm import (
    bpe,
    byte_runs,
    conversations,
    decontamination,
    hamming,
    lexical_search,
    line_runs,
    minhash,
    mixing,
    quality_rules,
    secret_scan,
    token_store,
    toxicity,
)
from stayflow.llm.rows import Work

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def labelled_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain): language and quality of the labelled documents."""
    langs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    labels = table(spark, sf_dir, "labels").where("quality is not null")
    return labels.join(langs, "doc_id").select("doc_id", F.concat_ws("-", "lang", "quality").alias("domain"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    mixed = mixing.mix(docs, labelled_domains(spark, sf_dir))
    shown = F.map_entries("domains")
    best = F.array_max(F.transform(shown, lambda d: F.struct(d["value"].alias("share"), d["key"].alias("domain"))))
    return mixed.select("doc_id", "n_tokens", "rate", best["domain"].alias("domain"), best["share"].alias("share"))


def held_out(key: str = "doc_id") -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"), where=~failed)
    stats = quality_rules.with_statistics(docs).withColumn("base_failed", failed)
    counts = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return stats.select(*counts, "base_failed", (~failed & quality_rules.verdict(rules)).alias("kept"))


@query
def op4_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_runs.remove_repeated_runs(docs.withColumn("lines", F.size(F.split("text", "\n"))))
    return done.select(
        "doc_id",
        F.greatest("lines", F.lit(0)).cast("long").alias("n_lines"),
        F.size("removed_lines").cast("long").alias("n_removed"),
        F.col("removed_runs").cast("long").alias("n_runs"),
        F.col("longest_block").cast("int").alias("longest_block"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"),
    )


ORACLE_SQL["op4_line_runs"] = line_runs.oracle_sql()


@query
def op5_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    codes = vectors.select(F.col("vec_id").alias("id"), hamming.sign_code("embedding").alias("code"))
    return hamming.nearest(codes, codes.where("id % 20 = 0"), k=10).select(
        F.col("query").alias("vec_id"), F.col("neighbour").alias("neighbour_id"), "distance", "place"
    )


SIGN_CODES = """select vec_id, array_to_string(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end), '')
as code from embeddings where vec_id is not null and embedding is not null"""
ORACLE_SQL["op5_hamming"] = f"""with codes as ({SIGN_CODES}),
pairs as (select q.vec_id, r.vec_id as neighbour_id, cast(hamming(q.code, r.code) as integer) as distance
          from codes q join codes r on q.vec_id % 20 = 0 and r.vec_id <> q.vec_id),
placed as (select *, cast(row_number() over (partition by vec_id order by distance, neighbour_id) as integer) as place
           from pairs)
select * from placed where place <= 10"""


@query
def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicates(docs, settings=minhash.Settings(words=2))


@query
def op7_byte_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = byte_runs.remove_repeated_bytes(docs)
    left = F.octet_length("kept").cast("long")
    return done.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - left).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.find_secrets(docs).drop("text")

    def of(*kinds: str) -> Column:
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def joined(spans: Column) -> Column:
        shown = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
        return F.array_join(shown, ",")

    return found.select(
        "doc_id",
        F.size(of("assign")).cast("long").alias("n_assign"),
        F.size(of("access")).cast("long").alias("n_access"),
        F.size(of("hex")).cast("long").alias("n_hex"),
        F.sha2(joined(of("assign", "access", "hex")), 256).alias("base_sha256"),
        joined(F.col("secrets")).alias("spans"),
    )


@query
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, RANKS)
    return decoded.select(
        "doc_id",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Work(spark).path("tokens")
    docs = table(spark, sf_dir, "documents")
    token_store.write_tokens(docs, path, TOKENIZER, end_id=0, pattern=public_tokenizers.PATTERN, special=True)
    stored = token_store.read_tokens(spark, path)
    return stored.select("doc_id", "start", "n_tokens", F.crc32("token_ids").alias("ids_crc32"))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    done = conversations.repair(conversations.damaged(given))
    everyone = given.select("conv_id").distinct()
    for found in (done.audits, conversations.digests(done.turns)):
        found = found.withColumnRenamed("conv_id", "found_id")
        everyone = everyone.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").drop("found_id")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return everyone.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


@query
def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


# Words of ASCII letters, digits and anything beyond ASCII; only A-Z are lower-cased.
SQL_WORDS = r"""regexp_extract_all(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
'[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"""
ORACLE_SQL["op12_decontamination"] = f"""with
item_words as (select item_id, {SQL_WORDS.format(text="text")} as w from benchmark where item_id is not null),
sized as (select item_id, w, least(10, len(w)) as n from item_words where len(w) > 0),
places as (select item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p from sized),
windows as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as part from places),
docs as (select doc_id, {SQL_WORDS.format(text="coalesce(text, '')")} as w from documents),
lengths as (select distinct n from windows),
doc_places as (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p from docs, lengths where len(w) >= n),
met as (select doc_id, item_id, d.p, n from
        (select doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') as part from doc_places) d join windows using (n, part)),
hit as (select doc_id, count(distinct place) as n_hit from
        (select doc_id, unnest(generate_series(p, p + n - 1)) as place from met) group by doc_id),
listed as (select doc_id, count(*) as n_items, string_agg(id, ',' order by id) as ids from
           (select distinct doc_id, cast(item_id as varchar) as id from met) group by doc_id)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(ids, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 as contaminated
from docs left join hit using (doc_id) left join listed using (doc_id)"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return lexical_search.search(docs, items, k=10)


ORACLE_SQL["op13_lexical_search"] = f"""with
words as (select doc_id, unnest({SQL_WORDS.format(text="text")}) as term from documents),
tf as (select doc_id, term, count(*) as tf from words group by all),
lengths as (select doc_id, sum(tf) as n from tf group by doc_id),
totals as (select count(*) as docs, sum(n) as terms from lengths),
df as (select term, count(*) as df from tf group by term),
weights as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w from df, totals),
asked as (select item_id, unnest({SQL_WORDS.format(text="text")}) as term from benchmark where item_id is not null),
counted as (select item_id, term, count(*) as times from asked group by all),
m as (select doc_id, cast(25 + ((75 * n * docs) // terms) as bigint) as m from lengths, totals),
scores as (select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
           from counted join weights using (term) join tf using (term) join m using (doc_id) group by all),
placed as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank
           from scores where score > 0)
select item_id, rank, doc_id, score from placed where rank <= 10"""

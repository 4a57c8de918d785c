"""Vector post-processing, embedding and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from intentloom.functions.offline_models import hashing_embedder
from intentloom.operators import models, recommend as RC, retrieval as R, vector_index as VI
from intentloom.plans.registry import query
from intentloom.sources import standins as V

DIM = 64
CUT = 48
K = 5
DOC_DIM = 64

# every tenth vector is too short for the cut, every tenth of the others all zero
_RAGGED = "case when vec_id % 10 = 3 then {short} when vec_id % 10 = 7 then {zero} else embedding end"


def _ragged(spark: SparkSession, sf: str) -> DataFrame:
    vector = _RAGGED.format(
        short="slice(embedding, 1, 32)", zero="transform(embedding, x -> cast(0 as float))"
    )
    return V.table(spark, sf, "embeddings").selectExpr("vec_id", f"{vector} as vector")


_RAGGED_SQL = "ragged as (select vec_id, {} as vector from embeddings)".format(
    _RAGGED.format(short="embedding[1:32]", zero="list_transform(embedding, lambda x: 0::float)")
)


def _checksum(v: str = "vector") -> F.Column:
    place = F.transform(v, lambda x, i: x.cast("double") * (i + 1))
    return F.round(F.aggregate(place, F.lit(0.0), lambda acc, x: acc + x), 4)


def _checksum_sql(v: str) -> str:
    return f"round(list_sum(list_transform({v}, lambda x, i: x::double * i)), 4)"


@query(
    f"with {_RAGGED_SQL} select vec_id, case when len(vector) >= {CUT} then {CUT} else 0 end as dim, "
    f"case when len(vector) >= {CUT} then {_checksum_sql(f'vector[1:{CUT}]')} else 0 end as checksum, "
    f"case when len(vector) >= {CUT} then '' else 'output_dim {CUT} > embedding dim ' || len(vector) end "
    "as dim_error from ragged"
)
def truncate_vectors(spark: SparkSession, sf: str) -> DataFrame:
    cut = R.truncate_vectors(_ragged(spark, sf), CUT)
    return cut.select(
        "vec_id",
        F.coalesce(F.size("vector"), F.lit(0)).alias("dim"),
        F.coalesce(_checksum(), F.lit(0.0)).alias("checksum"),
        F.coalesce("dim_error", F.lit("")).alias("dim_error"),
    )


def _norm_sql(v: str) -> str:
    return f"sqrt(list_sum(list_transform({v}, lambda x: x::double * x::double)))"


def _unit_sql(v: str) -> str:
    return f"list_transform({v}, lambda x: (x::double / case when {v}_n = 0 then 1 else {v}_n end)::float) as {v}"


@query(
    f"with {_RAGGED_SQL}, parts as (select vec_id, vector, vector[1:32] as cut from ragged), "
    f"norms as (select *, {_norm_sql('vector')} as vector_n, {_norm_sql('cut')} as cut_n from parts), "
    f"unit as (select vec_id, {_unit_sql('vector')}, {_unit_sql('cut')} from norms) "
    f"select vec_id, round({_norm_sql('vector')}, 4) as norm, {_checksum_sql('vector')} as checksum, "
    f"round({_norm_sql('cut')}, 4) as cut_norm, {_checksum_sql('cut')} as cut_checksum from unit"
)
def normalize_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """Unit vectors of whole vectors, and of vectors that are cut first."""

    def norm(v: str) -> F.Column:
        return F.round(F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))), 4)

    both = R.truncate_vectors(_ragged(spark, sf).withColumn("cut", F.col("vector")), 32, "cut")
    unit = R.normalize_vectors(R.normalize_vectors(both, "cut"))
    return unit.select(
        "vec_id", norm("vector").alias("norm"), _checksum().alias("checksum"),
        norm("cut").alias("cut_norm"), _checksum("cut").alias("cut_checksum"),
    )


@query(f"with {_RAGGED_SQL} select vec_id, len(vector) = {DIM} as dim_ok from ragged")
def vector_dim_check(spark: SparkSession, sf: str) -> DataFrame:
    return R.vector_dim_check(_ragged(spark, sf), DIM).select("vec_id", "dim_ok")


@query(
    f"with {_RAGGED_SQL}, pairs as (select text, list_transform(vector, lambda x: round(x::double, 8)) as v "
    "from documents full join ragged on vec_id = doc_id), c as (select count(*) as n_rows, "
    "count(distinct text) as n_texts, count(distinct v) as n_vectors from pairs) "
    "select *, n_vectors / n_texts as ratio, n_vectors / n_texts < 0.85 as too_low from c"
)
def vector_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    documents = V.table(spark, sf, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    return R.vector_uniqueness(documents.join(_ragged(spark, sf), "vec_id", "full"))


@query(
    "with q as (select embedding as q from embeddings where vec_id = 0) select cast(vec_id as string) "
    "as item_id, round(list_dot_product(embedding::double[], q::double[]), 6) as score from embeddings, q"
)
def dot_scores(spark: SparkSession, sf: str) -> DataFrame:
    first = V.table(spark, sf, "embeddings").where("vec_id = 0").select("embedding").scalar()
    return R.dot_scores(V.vectors(spark, sf), first)


@query(
    "with s as (select cast(a.vec_id as string) as query_id, cast(b.vec_id as string) as item_id, "
    "round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) as score "
    "from embeddings a join embeddings b on a.vec_id <> b.vec_id) "
    "select query_id, rank, item_id, score from (select *, row_number() over "
    f"(partition by query_id order by score desc, item_id) as rank from s) where rank <= {K}"
)
def topk_items(spark: SparkSession, sf: str) -> DataFrame:
    vectors = V.vectors(spark, sf)
    queries = vectors.withColumnRenamed("item_id", "query_id")
    itself = vectors.select(F.col("item_id").alias("query_id"), "item_id")
    found = R.topk_items(queries, vectors, K, DIM, exclude=itself)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


_WEIGHT = "case when vec_id % 5 < 2 then 1.0 when vec_id % 5 = 2 then 0.8 else 0.6 end"
_USER = "cast(cast(floor(vec_id / 5) as bigint) as string)"


def _user_slots(spark: SparkSession, sf: str) -> DataFrame:
    return V.table(spark, sf, "embeddings").selectExpr(
        f"{_USER} as user_id",
        "cast(vec_id % 5 + 1 as int) as slot",
        f"cast({_WEIGHT} as double) as weight",
        "embedding as vector",
    )


def _fused_sql(score: str) -> str:
    return (
        f"with s as (select {_USER.replace('vec_id', 'a.vec_id')} as user_id, "
        f"cast(b.vec_id as string) as item_id, {_WEIGHT.replace('vec_id', 'a.vec_id')}::double * "
        "list_dot_product(a.embedding::double[], b.embedding::double[]) as s "
        f"from embeddings a, embeddings b), f as (select user_id, item_id, {score} as score from s "
        "group by user_id, item_id) select user_id, rank, item_id, score from (select *, "
        f"row_number() over (partition by user_id order by score desc, item_id) as rank from f) "
        f"where rank <= {K}"
    )


@query(_fused_sql("max(round(s, 6))"))
def topk_weighted(spark: SparkSession, sf: str) -> DataFrame:
    found = R.topk_weighted(_user_slots(spark, sf), V.vectors(spark, sf), K, DIM)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(_fused_sql("round(sum(s), 6)"))
def topk_weighted_sum(spark: SparkSession, sf: str) -> DataFrame:
    found = R.topk_weighted(_user_slots(spark, sf), V.vectors(spark, sf), K, DIM, fusion="sum")
    return found.withColumn("rank", F.col("rank").cast("bigint"))


_TOKENS = (
    "tokens as (select doc_id, unnest(regexp_extract_all(lower(text), '[^ \\t\\r\\n]+')) as token "
    "from documents), sums as (select doc_id, bucket, sum(sign) as v from (select doc_id, "
    f"('0x' || substr(md5(token), 1, 8))::bigint % {DOC_DIM} as bucket, "
    "case when substr(md5(token), 9, 1) < '8' then 1 else -1 end as sign from tokens) "
    "group by doc_id, bucket), "
    "unit as (select doc_id, bucket, "
    "(v / greatest(sqrt(sum(v * v) over (partition by doc_id)), 1e-30))::float::double as v "
    "from sums)"
)


@query(
    f"with {_TOKENS} select doc_id, cast({DOC_DIM} as int) as dim, "
    "coalesce(round(sum(v * (bucket + 1)), 3), 0) as checksum "
    "from documents left join unit using (doc_id) group by doc_id"
)
def embed_texts(spark: SparkSession, sf: str) -> DataFrame:
    documents = V.table(spark, sf, "documents").select("doc_id", "text")
    made = models.embed_texts(documents, "text", hashing_embedder(DOC_DIM), DOC_DIM)
    place = F.transform("vector", lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(place, F.lit(0.0), lambda acc, x: acc + x)
    return made.select("doc_id", F.size("vector").alias("dim"), F.round(total, 3).alias("checksum"))


# small blocks, so that every size of the tables has several cells and some to skip
INDEX_BLOCK_BYTES = 16 << 10


@query(
    "with s as (select cast(a.vec_id as string) as query_id, cast(b.vec_id as string) as item_id, "
    "round(list_dot_product(a.embedding::double[], b.embedding::double[]), 6) as score "
    "from embeddings a join embeddings b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0) "
    "select query_id, rank, item_id, score from (select *, row_number() over "
    f"(partition by query_id order by score desc, item_id) as rank from s) where rank <= {K}"
)
def index_search(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector is indexed; the queries are those whose id is divisible by 100, as for all searches."""
    vectors = V.vectors(spark, sf)
    index = VI.write_index(vectors, models.new_folder(spark), DIM, block_bytes=INDEX_BLOCK_BYTES)
    itself = vectors.select(F.col("item_id").alias("query_id"), "item_id")
    queries = vectors.withColumnRenamed("item_id", "query_id").where("cast(query_id as bigint) % 100 = 0")
    found = VI.search(index, queries, K, exclude=itself)
    return found.withColumn("rank", F.col("rank").cast("bigint"))


@query(
    f"with {_RAGGED_SQL} select cast(vec_id as string) as item_id, case when len(vector) = {DIM} then 'indexed' "
    f"else 'size is not {DIM}: ' || len(vector) end as state, "
    f"case when len(vector) = {DIM} then {_checksum_sql('vector')} else 0 end as checksum, 'document' as task from ragged"
)
def vector_table(spark: SparkSession, sf: str) -> DataFrame:
    ragged = _ragged(spark, sf).select(F.col("vec_id").cast("string").alias("item_id"), "vector")
    path = models.new_folder(spark)
    index = VI.write_index(ragged, path, DIM, block_bytes=INDEX_BLOCK_BYTES)
    stored = spark.read.parquet(f"{path}/vectors").select("item_id", F.lit("indexed").alias("state"), _checksum().alias("checksum"), "task")
    rejected = index.rejected.select("item_id", F.col("reason").alias("state"), F.lit(0.0).alias("checksum"), F.lit(VI.DOCUMENT).alias("task"))
    return stored.union(rejected)


# customers have the vectors 5 c .. 5 c + 4; some are short, some weights missing, and customer 7 has seen all
_SHORT = "(u % 9 = 3 or vec_id % 11 = 4)"
_NO_WEIGHT = "(u % 9 = 5 or vec_id % 13 = 6)"
_REC_SLOTS = (
    "select cast(u as string) as user_id, slot, case when {no_weight} then null else {weight} end as weight, "
    "case when {short} then {cut} else embedding end as vector from "
    "(select *, cast(floor(vec_id / 5) as bigint) as u, cast(vec_id % 5 + 1 as int) as slot from embeddings)"
)


def _rec_slots(cut: str) -> str:
    return _REC_SLOTS.format(no_weight=_NO_WEIGHT, weight=f"cast({_WEIGHT} as double)", short=_SHORT, cut=cut)


@query(
    V.with_views("items", "catalog")
    + f", slots as ({_rec_slots('embedding[1:20]')}), "
    "users as (select distinct cast(vec_id as string) as user_id from embeddings where vec_id < 150), "
    "seen as (select distinct cast(u as string) as user_id, cast(v as string) as item_id from "
    "(select 7 as u, vec_id as v from embeddings union all select vec_id % 150, vec_id from embeddings)), "
    "s as (select user_id, cast(b.vec_id as string) as item_id, round(max(weight * "
    "list_dot_product(vector::double[], b.embedding::double[])), 6) as score from slots join users using (user_id), "
    f"embeddings b where len(vector) = {DIM} and weight is not null group by all), "
    "r as (select *, row_number() over (partition by user_id order by score desc, item_id) as rank from s anti join seen using (user_id, item_id)), "
    "state as (select user_id, bool_or(len(vector) = 64) as ok, bool_or(len(vector) = 64 and weight is not null) as w, "
    "arg_min(len(vector), slot) as size from slots group by user_id) "
    "select u.user_id, coalesce(rank, 0) as rank, coalesce(r.item_id, '') as item_id, coalesce(score, 0) as score, "
    "coalesce(title, '') as title, coalesce(feed_text, '') as feed_text, coalesce(views, -1) as views, coalesce(created_at, '') as created_at, "
    "'vector_search' as source, case when rank is not null then '' when ok is null then 'no_queries' "
    "when not ok then 'bad_vectors: size is not 64: ' || size when not w then 'bad_weights' else 'all_seen' end as reason "
    f"from users u left join (select * from r where rank <= {K}) r using (user_id) left join state using (user_id) "
    "left join catalog on catalog.item_id = r.item_id"
)
def recommend(spark: SparkSession, sf: str) -> DataFrame:
    embeddings = V.table(spark, sf, "embeddings")
    slots = spark.sql(_rec_slots("slice(embedding, 1, 20)").replace("from embeddings", "from {e}"), e=embeddings)
    users = embeddings.where("vec_id < 150").selectExpr("cast(vec_id as string) as user_id")
    seen = embeddings.selectExpr("cast(7 as bigint) as u", "vec_id as v").union(embeddings.selectExpr("vec_id % 150", "vec_id"))
    seen = seen.selectExpr("cast(u as string) as user_id", "cast(v as string) as item_id").distinct()
    records = RC.recommend(users, slots, V.vectors(spark, sf), V.catalog(spark, sf), K, DIM, seen=seen)
    rows = RC.recommendation_rows(records)
    item = {"title": "", "feed_text": "", "views": -1, "created_at": ""}
    return rows.select(
        "user_id", F.coalesce(F.col("rank").cast("bigint"), F.lit(0)).alias("rank"), F.coalesce("item_id", F.lit("")).alias("item_id"),
        F.coalesce("score", F.lit(0.0)).alias("score"), *[F.coalesce(f"metadata.{c}", F.lit(v)).alias(c) for c, v in item.items()],
        "source", F.coalesce("reason", F.lit("")).alias("reason"),
    )

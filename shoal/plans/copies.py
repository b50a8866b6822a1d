"""Queries: copies, renames, purges, whole objects, chunks, streams of deletes, and listings of each kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal.operators import copies, listing, transfer
from shoal.plans.core import query
from shoal.sources import configs, content
from shoal.sources.relations import relation, with_oracle
from shoal.sources.storage import new_folder
from shoal.streaming import deletes

_VERSIONS = "select key, version_id, is_delete_marker, size, false as is_prefix from versions"


@query(with_oracle("versions") + f"{_VERSIONS} where starts_with(key, 'user-00') and key > 'user-0005/'")
def list_all_versions(spark, sf):
    """Versions; where the key marker is null, the listing begins after ``start_after``."""
    objects = relation(spark, sf, "objects")
    return listing.list_objects(objects, relation(spark, sf, "versions"), "user-00", include_versions=True, recursive=True, start_after="user-0005/")


@query(with_oracle("objects") + "select key, cast(null as varchar) as version_id, false as is_delete_marker, size, false as is_prefix from objects where key > 'src5/'")
def list_first_kind(spark, sf):
    """The first kind of listing counts before versions, and has a marker of its own."""
    return listing.list_objects(relation(spark, sf, "objects"), relation(spark, sf, "versions"), use_v1=True, include_versions=True, recursive=True, marker="src5/", start_after="zzz")


@query(with_oracle("versions") + "select string_split(key, '/')[1] || '/' as key, cast(null as varchar) as version_id, false as is_delete_marker, cast(null as bigint) as size, true as is_prefix from versions group by 1")
def list_version_folders(spark, sf):
    return listing.list_objects(relation(spark, sf, "objects"), relation(spark, sf, "versions"), include_versions=True)


# --- copies

_COPY = "case when doc_id % 5 = 0 then 'gone/' || key else key end as source, 'copy/' || key as target, case when doc_id % 7 = 0 then 100 when doc_id % 11 = 0 then 1000000 end as o, case when doc_id % 3 = 0 then 50 end as l, case when doc_id % 4 = 0 then 'COPY' end as directive"


@query(
    with_oracle("objects")
    + f"""select source, target, o as "offset", l as length, directive, case when error is null then coalesce(l, size - coalesce(o, 0)) end as bytes, case when error is null then greatest(1, cast(ceil(coalesce(l, size - coalesce(o, 0)) / 1024) as bigint)) end as parts, case when error is null then how end as how, error
  from (select *, case when doc_id % 5 = 0 then 'not_found' when how = 'compose' and directive = 'COPY' then 'directive' when how = 'compose' and coalesce(o, 0) >= size then 'offset' when coalesce(o, 0) + coalesce(l, size - coalesce(o, 0)) > size then 'range' end as error
  from (select *, {_COPY}, case when o is not null or l is not null or size > 1024 then 'compose' else 'copy' end as how from objects))"""
)
def copy_plan(spark, sf):
    """Copies by whole or by range, every fifth of an object that isn't there; parts are small, so that many are composed."""
    requests = spark.sql(f"select {_COPY} from {{objects}}", objects=relation(spark, sf, "objects")).withColumnsRenamed({"o": "offset", "l": "length"})
    return copies.copies(requests, relation(spark, sf, "objects"), part=1024)


_RENAME = "key as source, case when doc_id % 2 = 0 then 'new/' || key else key end as target, case when doc_id % 3 = 0 then 'other' when doc_id % 3 = 1 then etag end as source_match, case when doc_id % 5 = 0 then '*' end as target_match, case when doc_id % 7 = 0 then '*' end as target_none_match"


@query(with_oracle("objects") + f"select {_RENAME}, case when doc_id % 3 = 0 then 'source_if_match' when doc_id % 5 = 0 and doc_id % 2 = 0 then 'target_if_match' when doc_id % 7 = 0 and doc_id % 2 = 1 then 'target_if_none_match' end as error from objects")
def rename_pairs(spark, sf):
    """Conditions of both ends of a rename."""
    objects = relation(spark, sf, "objects")
    return copies.renames(spark.sql(f"select {_RENAME} from {{objects}}", objects=objects), objects)


_MEMBERS = "select storage_class as target, doc_id as n, case when doc_id % 50 = 7 then 'gone' else key end as key, cast(null as bigint) as \"offset\", case when doc_id % 3 = 0 then 10 end as length, case when doc_id % 20 = 3 then 'other' end as match from objects"


@query(
    with_oracle("objects")
    + f"""select m.target, m.n, coalesce(m.length, o.size) as bytes, cast(ceil(coalesce(m.length, o.size) / 4096) as bigint) as parts, cast(1 + coalesce(sum(ceil(coalesce(m.length, o.size) / 4096)) over w, 0) as bigint) as first_part, cast(sum(coalesce(m.length, o.size)) over (partition by m.target) as bigint) as target_bytes,
  case when o.key is null then 'not_found' when m.match is not null then 'if_match' when o.size <= 0 then 'offset' when m.length > o.size then 'length' when m.n <> max(m.n) over (partition by m.target) then 'source_too_small' when sum(ceil(coalesce(m.length, o.size) / 4096)) over (partition by m.target) > 10000 then 'too_many_parts' end as error
  from ({_MEMBERS}) m left join objects o on m.key = o.key window w as (partition by m.target order by m.n rows between unbounded preceding and 1 preceding)"""
)
def compose_objects(spark, sf):
    """Sources meet the objects that they name; all but the last are too small to be composed."""
    objects = relation(spark, sf, "objects")
    sources = spark.sql(_MEMBERS.replace('"offset"', "`offset`").replace("from objects", "from {objects}"), objects=objects)
    return copies.compose_sources(sources, objects, by="target", order="n", part=4096)


@query(with_oracle("versions") + "select key, version_id, cast(floor((row_number() over (order by key, cast(version_id as bigint)) - 1) / 100) as bigint) as batch, cast(version_id as bigint) % 10 = 0 as release from versions")
def purge_bucket(spark, sf):
    """Every tenth version is on hold."""
    return copies.purge(relation(spark, sf, "versions").withColumn("hold", F.col("version_id").cast("bigint") % 10 == 0), hold="hold", most=100)


@query(with_oracle("objects") + "select key, 'deleted' as outcome from objects union all select 'gone/' || key, 'skipped' from objects")
def delete_stream(spark, sf):
    """Keys come as a stream; missing ones don't end it."""
    keys, out, objects = new_folder(spark), new_folder(spark), relation(spark, sf, "objects")
    objects.select("key").union(objects.select(F.concat(F.lit("gone/"), "key"))).write.parquet(keys)
    deletes.delete_stream(spark.readStream.schema("key string").parquet(keys), lambda: objects, out, new_folder(spark)).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("key string, outcome string, batch bigint, micro_batch bigint").parquet(out).select("key", "outcome")


# --- content


@query("select n_nationkey, strlen(n_name) + 1 as size, md5(n_name || chr(10)) as etag from nation")
def get_object(spark, sf):
    """Whole objects, a file each."""
    path = new_folder(spark)
    relation(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("value")).write.partitionBy("n_nationkey").text(path)
    return content.contents(spark, path).select(F.regexp_extract("path", "n_nationkey=([0-9]+)", 1).cast("int").alias("n_nationkey"), "size", F.md5("content").alias("etag"))


@query("select doc_id, to_base64(unhex(sha256(text))) as checksum from documents where strlen(text) > 0")
def chunk_checksum(spark, sf):
    """The checksum of a text from its blocks, whatever order they come in."""
    blocks = transfer.rechunked(relation(spark, sf, "documents").select("doc_id", "text"), "text", 4096).select("doc_id", "block", "data")
    return content.chunk_checksums(blocks, "SHA256", by="doc_id", order="block", content="data")


@query("select doc_id // 10 as bucket, doc_id % 10 as page, 'inv-' || doc_id as id, 'u' || doc_id % 3 as user, case when doc_id % 2 = 0 then 'apiVersion: v1' else '' end as definition from documents where doc_id % 10 <= case when doc_id // 10 % 2 = 0 then 4 else 6 end")
def inventory_configs(spark, sf):
    """Pages of ten; of every second bucket the token stops moving on after the fifth, of the others the seventh is the last."""
    bucket, page = F.expr("doc_id div 10"), F.col("doc_id") % 10
    following = F.when((bucket % 2 == 0) & (page == 4), page).when(page == 6, F.lit(None)).otherwise(page + 1).cast("string")
    item = F.struct(bucket.cast("string").alias("bucket"), F.concat(F.lit("inv-"), "doc_id").alias("id"), F.concat(F.lit("u"), F.col("doc_id") % 3).alias("user"), F.when(F.col("doc_id") % 2 == 0, "apiVersion: v1").alias("yamlDef"))
    pages = relation(spark, sf, "documents").select(bucket.alias("bucket"), page.alias("page"), page.cast("string").alias("token"), F.to_json(F.struct(F.array(item).alias("items"), following.alias("nextContinuationToken"))).alias("json"))
    return configs.inventory(pages, "json", by="bucket", page="page", token="token")

"""Relations of an object store, derived from the driver's tables: objects, versions, notifications, uploads, URLs.

Each has its DuckDB form beside it, for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK = {
    "objects": """select concat(source,'/',lang,'/doc-',lpad(cast(doc_id as string),6,'0'),'.txt') as key, cast(octet_length(text) as bigint) as size, md5(text) as etag,
      timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0,0,cast(doc_id as int),0) as last_modified,
      case when doc_id % 4=0 then 'GLACIER' when doc_id % 4=1 then 'STANDARD_IA' else 'STANDARD' end as storage_class, lang as tag_lang, cast(doc_id % 10 as string) as tag_shard, doc_id, text from {documents}""",
    "versions": """select concat('user-',lpad(cast(user_id as string),4,'0'),'/',event_type) as key, cast(event_id as string) as version_id, ts as last_modified, event_type='error' as is_delete_marker,
      case when event_type='error' then null else cast(round(value*100) as bigint) end as size, row_number() over (partition by user_id,event_type order by ts desc,event_id desc)=1 as is_latest from {events}""",
    "notifications": """select event_id, ts as event_time, case event_type when 'signup' then 's3:ObjectCreated:Put' when 'purchase' then 's3:ObjectCreated:Copy' when 'error' then 's3:ObjectRemoved:Delete' when 'view' then 's3:ObjectAccessed:Get' else 's3:ObjectAccessed:Head' end as event_name,
      concat(case when user_id % 2=0 then 'images/' else 'logs/' end,'u',user_id,case when event_id % 3=0 then '.png' else '.txt' end) as key, get_json_object(props,'$.k') as k from {events}""",
    "uploads": "select o_orderkey as upload_id, cast(round(o_totalprice*1000) as bigint) as object_size, 5242880L*(1+o_custkey%4) as part_size from {orders}",
    "urls": "select page_id, regexp_extract(url,'^https?://([^/?#]+)',1) as host, regexp_extract(url,'^https?://[^/?#]+([^?#]*)',1) as path, regexp_extract(url,'[?]([^#]*)',1) as query from {pages}",
}

DUCKDB = {
    "objects": _SPARK["objects"].replace("as string", "as varchar").replace("octet_length(text)", "strlen(text)").replace("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0,0,cast(doc_id as int),0)", "timestamp '2024-01-01 00:00:00' + to_minutes(doc_id)").format(documents="documents"),
    "versions": _SPARK["versions"].replace("as string", "as varchar").format(events="events"),
    "notifications": _SPARK["notifications"].replace("get_json_object", "json_extract_string").format(events="events"),
    "uploads": _SPARK["uploads"].replace("5242880L", "5242880").format(orders="orders"),
    "urls": _SPARK["urls"].format(pages="pages"),
}


def relation(spark: SparkSession, folder: str, name: str, *also: str) -> DataFrame:
    """A derived relation, or one of the tables themselves. ``also``: columns of its table that a derived relation has besides its own."""
    if name not in _SPARK:
        return spark.read.parquet(f"{folder}/{name}.parquet")
    source = {"objects": "documents", "versions": "events", "notifications": "events", "uploads": "orders", "urls": "pages"}[name]
    return spark.sql(_SPARK[name].replace(" from {", "".join(f", {c}" for c in also) + " from {"), **{source: spark.read.parquet(f"{folder}/{source}.parquet")})


def with_oracle(*names: str) -> str:
    """The start of an oracle that reads derived relations."""
    return "with " + ", ".join(f"{n} as ({DUCKDB[n]})" for n in names) + " "

"""Queries: pages of listings with their state, rule documents, conditions, further lifecycle actions, counters by node."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal.functions import text
from shoal.operators import conditions, listing, rules, transfer
from shoal.plans.core import query
from shoal.sources import configs
from shoal.sources.relations import relation, with_oracle

_NOW = "timestamp '2024-02-01 00:00:00'"


def _now():
    return F.expr("timestamp_ntz'2024-02-01 00:00:00'")


# --- pages

_ROLLED = "select string_split(key, '/')[1] || '/' as key, cast(null as bigint) as size, true as is_prefix from objects where contains(key, '/') group by 1"


@query(with_oracle("objects") + f"select p.*, n > 7 as is_truncated, case when n > 7 then (select max(key) from (select key from ({_ROLLED}) order by key limit 7)) end as next_marker from (select * from ({_ROLLED}) order by key limit 7) p, (select count(*) as n from ({_ROLLED})) t")
def list_page_state(spark, sf):
    """The first page of common prefixes, whether there are more, and where they start."""
    return listing.page_with_state(listing.listing(relation(spark, sf, "objects")), limit=7)


@query(with_oracle("objects") + "select key, size, false as is_prefix, false as is_truncated, cast(null as varchar) as next_marker from (select *, row_number() over (order by key desc) as back from objects) where key > (select key from (select key, row_number() over (order by key desc) as n from objects) where n = 41) and back <= 40")
def list_last_page(spark, sf):
    """The last page of a recursive listing isn't truncated and has no marker."""
    objects = relation(spark, sf, "objects")
    after = objects.select("key").orderBy(F.desc("key")).limit(41).agg(F.min("key")).first()[0]
    return listing.page_with_state(listing.listing(objects, recursive=True), after=after, limit=1000)


_VERSIONS = "select key, version_id, row_number() over (order by key, last_modified desc, cast(version_id as bigint) desc) as n from versions"


@query(with_oracle("versions") + f"select key, version_id, count(*) over () = 50 and (select count(*) from versions) > 53 as is_truncated, (select key from ({_VERSIONS}) where n = 53) as next_key_marker, (select version_id from ({_VERSIONS}) where n = 53) as next_version_marker from ({_VERSIONS}) where n between 4 and 53")
def list_versions_page(spark, sf):
    """The second page of versions and delete markers: from where the first, of three rows, ends."""
    versions = relation(spark, sf, "versions")
    first = listing.versions_page(versions, limit=3).first()
    return listing.versions_page(versions, key_marker=first["next_key_marker"], version_marker=first["next_version_marker"], limit=50).select("key", "version_id", "is_truncated", "next_key_marker", "next_version_marker")


_PARTS = "select *, unnest(range(1, cast(ceil(object_size / part_size) as bigint) + 1)) as part_number from uploads"


@query(with_oracle("uploads") + f"select upload_id, part_number, parts > 8 as is_truncated, case when parts > 8 then 8 end as next_marker from (select *, cast(ceil(object_size / part_size) as bigint) as parts from ({_PARTS})) where part_number between 4 and 8")
def attributes_page(spark, sf):
    """Five parts of each object beyond the third."""
    parts = relation(spark, sf, "uploads").select("upload_id", F.explode(transfer.ranges(F.col("object_size"), F.col("part_size"))).alias("p")).select("upload_id", "p.part_number")
    return transfer.attribute_page(parts, by="upload_id", after=3, most=5)


@query("select doc_id, md5(array_slice(encode(text), 101, 1000000000)) as digest from documents")
def fast_read(spark, sf):
    return relation(spark, sf, "documents").select("doc_id", F.md5(transfer.fast_read(F.col("text"), 100, 0)).alias("digest"))


# --- conditions


@query(
    with_oracle("objects")
    + """select key, case when doc_id % 3 = 0 and doc_id % 6 <> 0 then 'if_match' when last_modified > timestamp '2024-01-01 14:00:00' then 'if_unmodified_since' when doc_id % 5 = 0 then 'if_none_match' when last_modified <= timestamp '2024-01-01 08:00:00' then 'if_modified_since' end as failed from objects"""
)
def rename_conditions(spark, sf):
    """Conditions of a rename's source: every third row names a tag, half of them wrongly; every fifth wants no object at all."""
    d = F.col("doc_id")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    match = F.when(d % 6 == 0, F.col("etag")).when(d % 3 == 0, F.lit("other")).when(d % 3 == 1, F.lit("*"))
    found = conditions.failed(F.col("etag"), F.col("last_modified"), match=match, none_match=F.when(d % 5 == 0, F.lit("*")), modified_since=at("2024-01-01 08:00:00"), unmodified_since=at("2024-01-01 14:00:00"))
    return relation(spark, sf, "objects").select("key", found.alias("failed"))


# --- lifecycle

_LAST = "select key, arg_max(version_id, (last_modified, cast(version_id as bigint))) as version_id, max(last_modified) as last_modified, arg_max(is_delete_marker, (last_modified, cast(version_id as bigint))) as marker, count(*) as n from versions group by key"
_MARKERS = "('lone', 'user-00', true, cast(null as int), true), ('old', '', false, 10, true), ('off', '', true, 1, false)"


@query(with_oracle("versions") + f"select key, any_value(version_id) as version_id, arg_min(rule_id, (due, rule_id)) as rule_id, min(due) as due_at from (select *, least(case when lone and n = 1 then last_modified end, last_modified + to_days(days)) as due from ({_LAST}) join (values {_MARKERS}) t(rule_id, prefix, lone, days, enabled) on starts_with(key, prefix) where marker and enabled) where due <= {_NOW} group by key")
def lifecycle_delete_markers(spark, sf):
    found = spark.sql(f"select * from values {_MARKERS} as t(rule_id, prefix, lone, days, enabled)")
    return rules.delete_marker_expirations(relation(spark, sf, "versions"), found, _now())


_ALL = "('some', 'user-00', 3, false, true), ('all', '', 5, true, true), ('off', '', 0, true, false)"


@query(with_oracle("versions") + f"select v.key, v.version_id, rule_id, due_at from versions v join (select key, arg_min(rule_id, (due, rule_id)) as rule_id, min(due) as due_at from (select *, last_modified + to_days(days) as due from ({_LAST}) join (values {_ALL}) t(rule_id, prefix, days, with_marker, enabled) on starts_with(key, prefix) where enabled and (with_marker or not marker)) where due <= {_NOW} group by key) d on v.key = d.key")
def lifecycle_all_versions(spark, sf):
    found = spark.sql(f"select * from values {_ALL} as t(rule_id, prefix, days, delete_marker, enabled)")
    return rules.all_versions_expirations(relation(spark, sf, "versions"), found, _now())


_COLDER = "('warm', '', 3, 0, 'STANDARD_IA', true), ('cold', 'user-00', 9, 2, 'GLACIER', true)"


@query(
    with_oracle("versions")
    + f"""select key, version_id, arg_max(rule_id, (due, rule_id)) as rule_id, arg_max(target, (due, rule_id)) as target, max(due) as due_at from (select key, version_id, rule_id, target, s + to_days(days) as due, place - 2 as newer, keep from (select *, row_number() over w as place, lag(last_modified) over w as s from versions window w as (partition by key order by last_modified desc, cast(version_id as bigint) desc))
  join (values {_COLDER}) t(rule_id, prefix, days, keep, target, enabled) on starts_with(key, prefix) where place > 1) where due <= {_NOW} and newer >= keep group by key, version_id"""
)
def lifecycle_noncurrent_transition(spark, sf):
    found = spark.sql(f"select * from values {_COLDER} as t(rule_id, prefix, days, keep_newer, target, enabled)")
    return rules.noncurrent_transitions(relation(spark, sf, "versions"), found, _now())


_ABORT = "('a', '1', 7, true), ('b', '', 20, true), ('off', '', 1, false)"


@query(f"select upload_id, key, arg_min(rule_id, (due, rule_id)) as rule_id, min(due) as due_at from (select o_orderkey as upload_id, o_custkey || '/' || o_orderkey as key, timestamp '2024-01-01 00:00:00' + to_days(cast(o_orderkey % 40 as int)) as initiated, rule_id, initiated + to_days(days) as due from orders join (values {_ABORT}) t(rule_id, prefix, days, enabled) on starts_with(o_custkey || '/' || o_orderkey, prefix) where enabled) where due <= {_NOW} group by upload_id, key")
def lifecycle_abort_uploads(spark, sf):
    begun = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(cast(o_orderkey % 40 as int))")
    uploads = relation(spark, sf, "orders").select(F.col("o_orderkey").alias("upload_id"), F.concat_ws("/", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("key"), begun.alias("initiated"))
    return rules.aborted_uploads(uploads, spark.sql(f"select * from values {_ABORT} as t(rule_id, prefix, days, enabled)"), _now())


# --- documents


def _document(spark, sf, *parts):
    return relation(spark, sf, "documents").select("doc_id", F.concat(*[p if not isinstance(p, str) else F.lit(p) for p in parts]).alias("xml"))


@query(
    """select doc_id, 'rule-' || doc_id as rule_id, doc_id % 2 = 0 as enabled, 'logs/' || doc_id || '/' as prefix, cast(doc_id % 30 as int) as days, cast(doc_id % 7 as int) as noncurrent_days, 'GLACIER' as target, timestamp '2024-03-01 00:00:00' as transition_date, 3 as abort_days, cast(null as varchar) as error from documents
  union all select doc_id, 'bare', false, '', null, null, null, null, null, 'status' from documents"""
)
def config_lifecycle(spark, sf):
    """Documents of two rules, of which the second has no status."""
    d = F.col("doc_id").cast("string")
    rows = _document(
        spark, sf, "<LifecycleConfiguration><Rule><ID>rule-", d, "</ID><Status>", F.when(F.col("doc_id") % 2 == 0, "Enabled").otherwise("Disabled"), "</Status><Filter><Prefix>logs/", d, "/</Prefix></Filter><Expiration><Days>", (F.col("doc_id") % 30).cast("string"),
        "</Days></Expiration><NoncurrentVersionExpiration><NoncurrentDays>", (F.col("doc_id") % 7).cast("string"), "</NoncurrentDays></NoncurrentVersionExpiration><Transition><Date>2024-03-01T00:00:00Z</Date><StorageClass>GLACIER</StorageClass></Transition>",
        "<AbortIncompleteMultipartUpload><DaysAfterInitiation>3</DaysAfterInitiation></AbortIncompleteMultipartUpload></Rule><Rule><ID>bare</ID></Rule></LifecycleConfiguration>",
    )
    found = configs.lifecycle(rows, "xml", keep=["doc_id"])
    return found.select("doc_id", "rule_id", "enabled", "prefix", "days", "noncurrent_days", "target", F.col("transition_date").cast("timestamp_ntz").alias("transition_date"), "abort_days", "error")


@query("select doc_id, k.kind, k.kind || '-' || doc_id as target, k.event, case when k.kind = 'queue' then 'images' else '' end as prefix, case when k.kind = 'queue' then 'pg' else '' end as suffix from documents, (values ('queue', 's3:ObjectCreated:Put'), ('queue', 's3:ObjectCreated:Copy'), ('topic', 's3:ObjectRemoved:*')) k(kind, event)")
def config_notification(spark, sf):
    d = F.col("doc_id").cast("string")
    rows = _document(
        spark, sf, "<NotificationConfiguration><QueueConfiguration><Queue>queue-", d, "</Queue><Event>s3:ObjectCreated:Put</Event><Event>s3:ObjectCreated:Copy</Event><Filter><S3Key><FilterRule><Name>prefix</Name><Value>images</Value></FilterRule><FilterRule><Name>suffix</Name><Value>pg</Value></FilterRule></S3Key></Filter></QueueConfiguration>",
        "<TopicConfiguration><Topic>topic-", d, "</Topic><Event>s3:ObjectRemoved:*</Event></TopicConfiguration></NotificationConfiguration>",
    )
    return configs.notification(rows, "xml", keep=["doc_id"]).select("doc_id", "kind", "target", "event", "prefix", "suffix")


@query("select doc_id, 'copy-' || doc_id as rule_id, 1 as priority, true as enabled, 'TaxDocs' as prefix, 'value1' as key1, 'value2' as key2, 'east' as destination, doc_id % 2 = 0 as delete_markers from documents")
def config_replication(spark, sf):
    """A filter of a prefix and two tags."""
    d = F.col("doc_id").cast("string")
    rows = _document(
        spark, sf, "<ReplicationConfiguration><Rule><ID>copy-", d, "</ID><Priority>1</Priority><Status>Enabled</Status><Filter><And><Prefix>TaxDocs</Prefix><Tag><Key>key1</Key><Value>value1</Value></Tag><Tag><Key>key2</Key><Value>value2</Value></Tag></And></Filter><Destination><Bucket>east</Bucket></Destination>",
        "<DeleteMarkerReplication><Status>", F.when(F.col("doc_id") % 2 == 0, "Enabled").otherwise("Disabled"), "</Status></DeleteMarkerReplication></Rule></ReplicationConfiguration>",
    )
    found = configs.replication(rows, "xml", keep=["doc_id"])
    return found.select("doc_id", "rule_id", "priority", "enabled", "prefix", F.col("wanted")["key1"].alias("key1"), F.col("wanted")["key2"].alias("key2"), "destination", "delete_markers")


@query("select doc_id, true as enabled, 'GOVERNANCE' as mode, case when doc_id % 2 = 0 then 7 end as days, case when doc_id % 2 = 1 then 1 end as years from documents")
def config_lock(spark, sf):
    rows = _document(spark, sf, "<ObjectLockConfiguration><ObjectLockEnabled>Enabled</ObjectLockEnabled><Rule><DefaultRetention><Mode>GOVERNANCE</Mode>", F.when(F.col("doc_id") % 2 == 0, "<Days>7</Days>").otherwise("<Years>1</Years>"), "</DefaultRetention></Rule></ObjectLockConfiguration>")
    return configs.object_lock(rows, "xml", keep=["doc_id"])


@query("select doc_id, 'Project' as tag, 'Project One & <' || doc_id || '>' as value from documents union all select doc_id, 'User', 'jsmith' from documents")
def config_tagging(spark, sf):
    """Values with characters that XML escapes."""
    value = text.xml_escape(F.concat(F.lit("Project One & <"), F.col("doc_id").cast("string"), F.lit(">")))
    rows = _document(spark, sf, "<Tagging><TagSet><Tag><Key>Project</Key><Value>", value, "</Value></Tag><Tag><Key>User</Key><Value>jsmith</Value></Tag></TagSet></Tagging>")
    return configs.tagging(rows, "xml", keep=["doc_id"]).select("doc_id", F.explode("tags").alias("tag", "value"))


@query("select doc_id, 'note' as name, case when doc_id % 3 = 0 then 0 else doc_id end as size, md5(text) as etag, case when doc_id % 2 = 0 then timestamp '2024-01-02 03:04:05' end as last_modified from documents")
def annotation_listing(spark, sf):
    """Every third size and every second time is malformed; tags are in quotes."""
    d = F.col("doc_id")
    rows = _document(
        spark, sf, "<ListObjectAnnotationsOutput><Annotation><AnnotationName>note</AnnotationName><Size>", F.when(d % 3 == 0, "many").otherwise(d.cast("string")), "</Size><ETag>&quot;", F.md5("text"), "&quot;</ETag><LastModified>",
        F.when(d % 2 == 0, "2024-01-02T03:04:05.000Z").otherwise("yesterday"), "</LastModified></Annotation></ListObjectAnnotationsOutput>",
    )
    found = configs.annotations(rows, "xml", keep=["doc_id"])
    return found.withColumn("last_modified", F.col("last_modified").cast("timestamp_ntz"))


# --- counters and codecs

_AT = "timestamp '2024-01-30 12:00:00'"
_KINDS = {"total": "true", "throttled": "event_type = 'error'", "exceeded": "value > 100", "disconnected": "event_type = 'click' and value < 10", "timed_out": "event_type = 'view' and value > 150"}


@query(f"select user_id % 4 as node, event_type as rule, {', '.join(f'count(*) filter (({c}) and ts > {_AT} - interval {span} and ts <= {_AT}) as {k}_{n}' for k, c in _KINDS.items() for n, span in (('last_minute', '1 minute'), ('last_hour', '1 hour')))}, {', '.join(f'count(*) filter ({c}) as {k}_all' for k, c in _KINDS.items())} from events group by 1, 2")
def qos_node_counters(spark, sf):
    """Five counters of each rule on each node: of a minute, of an hour, and of all time, in one aggregation."""
    events = relation(spark, sf, "events").withColumns({"node": F.col("user_id") % 4, "rule": F.col("event_type")})
    return rules.counters(events, "node", "rule", at=F.expr("timestamp_ntz'2024-01-30 12:00:00'"), time="ts", kinds={k: F.expr(c) for k, c in _KINDS.items()})


@query("select doc_id, md5(to_base64(encode(text))) as b64, md5(lower(hex(encode(text)))) as hexed, cast('0x' || substr(md5(text), 1, 8) as bigint) as number, md5(replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&apos;')) as escaped from documents")
def small_codecs(spark, sf):
    return relation(spark, sf, "documents").select("doc_id", F.md5(text.b64_encode("text")).alias("b64"), F.md5(text.hex_encode("text")).alias("hexed"), text.uint32(F.unhex(F.md5("text"))).alias("number"), F.md5(text.xml_escape("text")).alias("escaped"))


@query("select event_id, case when event_id % 3 <> 2 then date_trunc('second', ts) end as parsed from events")
def parse_rfc3339(spark, sf):
    """Times in UTC and with an offset of two hours, and every third one malformed."""
    d = F.col("event_id")
    shown = F.when(d % 3 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(d % 3 == 1, F.date_format(F.col("ts") + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss'+02:00'")).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return relation(spark, sf, "events").select("event_id", text.parse_rfc3339(shown).cast("timestamp_ntz").alias("parsed"))

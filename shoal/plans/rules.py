"""Queries: transfers, rules, notifications and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from shoal.operators import rules, transfer
from shoal.operators.running import rolling
from shoal.plans.core import query
from shoal.sources.relations import relation, with_oracle
from shoal.sources.storage import new_folder
from shoal.streaming import notifications

MIB = transfer.MIB

# --- transfers


@query(
    with_oracle("uploads")
    + f"""select upload_id, case when part_size < {5 * MIB} then 'part_too_small' when object_size = 0 then 'part_count_zero' when ceil(object_size / part_size) > 10000 then 'too_many_parts' end as error,
  part_size, cast(ceil(object_size / part_size) as bigint) as parts, least({64 * MIB}, object_size) as free_part_size from uploads"""
)
def multipart_plan(spark, sf):
    """Plans with the part size that is asked for, and with the default."""
    size, part = F.col("object_size"), F.col("part_size")
    return relation(spark, sf, "uploads").select("upload_id", transfer.part_error(size, part).alias("error"), transfer.planned_part(size, part).alias("part_size"), transfer.planned_parts(size, part).alias("parts"), transfer.planned_part(size, F.lit(None).cast("bigint")).alias("free_part_size"))


_RANGES = with_oracle("uploads") + "select upload_id, n as part_number, (n - 1) * part_size as \"offset\", least(part_size, object_size - (n - 1) * part_size) as length from (select *, unnest(range(1, cast(ceil(object_size / part_size) as bigint) + 1)) as n from uploads)"


@query(_RANGES)
def part_ranges(spark, sf):
    return relation(spark, sf, "uploads").select("upload_id", F.explode(transfer.ranges(F.col("object_size"), F.col("part_size"))).alias("p")).select("upload_id", "p.*")


@query(with_oracle("uploads") + "select upload_id, cast(sum(least(part_size, object_size - (n - 1) * part_size)) as bigint) as total, sum(least(part_size, object_size - (n - 1) * part_size)) = any_value(object_size) as complete from (select *, unnest(range(1, cast(ceil(object_size / part_size) as bigint) + 1)) as n from uploads) group by upload_id")
def multipart_total(spark, sf):
    """The parts of an upload against its size; they are summed where they are."""
    total = F.aggregate(transfer.ranges(F.col("object_size"), F.col("part_size")), F.lit(0).cast("bigint"), lambda t, p: t + p["length"])
    return relation(spark, sf, "uploads").select("upload_id", total.alias("total"), (total == F.col("object_size")).alias("complete"))


_SOURCES = "select o_custkey as target, o_orderkey as n, cast(round(o_totalprice * 1000) as bigint) as size, case when o_orderkey % 5 = 0 then {m} end as \"offset\", case when o_orderkey % 7 = 0 then {t} end as length from orders"


@query(
    f"""with s as ({_SOURCES.format(m=MIB, t=20 * MIB)}), t as (select *, coalesce(length, size - coalesce("offset", 0)) as take from s), u as (select *, cast(ceil(take / {64 * MIB}) as bigint) as parts, n = max(n) over (partition by target) as last, sum(take) over (partition by target) as target_bytes from t)
  select target, n, take as bytes, parts, cast(1 + coalesce(sum(parts) over (partition by target order by n rows between unbounded preceding and 1 preceding), 0) as bigint) as first_part, cast(target_bytes as bigint) as target_bytes,
  case when coalesce("offset", 0) >= size then 'offset' when take > size then 'length' when coalesce("offset", 0) + take > size then 'range' when not last and take < {5 * MIB} then 'source_too_small'
  when not last and take > {64 * MIB} and take % {64 * MIB} between 1 and {5 * MIB - 1} then 'last_part_too_small' end as error from u"""
)
def compose_plan(spark, sf):
    sources = relation(spark, sf, "orders").select(F.col("o_custkey").alias("target"), F.col("o_orderkey").alias("n"), F.round(F.col("o_totalprice") * 1000).cast("bigint").alias("size"), F.when(F.col("o_orderkey") % 5 == 0, F.lit(MIB)).cast("bigint").alias("offset"), F.when(F.col("o_orderkey") % 7 == 0, F.lit(20 * MIB)).cast("bigint").alias("length"))
    return transfer.compose(sources, by="target", order="n", part=64 * MIB)


@query("select user_id, event_id, cast(sum(b) over w - b as bigint) as \"offset\", cast(sum(b) over w as bigint) as size_after from (select *, cast(round(value * 100) as bigint) as b from events) window w as (partition by user_id order by event_id rows unbounded preceding)")
def append_offsets(spark, sf):
    parts = relation(spark, sf, "events").select("user_id", "event_id", F.round(F.col("value") * 100).cast("bigint").alias("b"))
    return transfer.append_offsets(parts, by="user_id", order="event_id", length="b").select("user_id", "event_id", "offset", "size_after")


@query(with_oracle("objects") + "select key, cast(floor((row_number() over (order by key) - 1) / 150) as bigint) as batch from objects")
def delete_batches(spark, sf):
    return transfer.delete_batches(relation(spark, sf, "objects").select("key"), most=150)


@query(with_oracle("objects") + "select key, 'deleted' as outcome from objects union all select 'gone/' || key, 'skipped' from objects")
def delete_missing(spark, sf):
    """Every object is asked for, and as many keys that no object has."""
    objects = relation(spark, sf, "objects")
    return transfer.delete_outcome(objects.select("key").union(objects.select(F.concat(F.lit("gone/"), "key"))), objects)


# --- rules

_NOW = "timestamp '2024-02-01 00:00:00'"


def _now():
    return F.expr("timestamp_ntz'2024-02-01 00:00:00'")


def _values(spark, sql: str):
    return spark.sql(sql)


_FILTERS = "select * from values ('r1', 'src1', 'en', null), ('r2', '', 'fr', '3'), ('r3', 'src1/de/', null, null), ('r4', null, null, '7') as t(rule_id, prefix, lang, shard)"
_FILTERS_DUCK = "(values ('r1', 'src1', 'en', null), ('r2', '', 'fr', '3'), ('r3', 'src1/de/', null, null), ('r4', null, null, '7')) t(rule_id, prefix, lang, shard)"


@query(with_oracle("objects") + f"select key, rule_id from objects join {_FILTERS_DUCK} on starts_with(key, coalesce(prefix, '')) and (lang is null or lang = tag_lang) and (shard is null or shard = tag_shard)")
def filter_match(spark, sf):
    wanted = F.map_filter(F.create_map(F.lit("lang"), "lang", F.lit("shard"), "shard"), lambda k, v: v.isNotNull())
    objects = relation(spark, sf, "objects").withColumn("tags", F.create_map(F.lit("lang"), "tag_lang", F.lit("shard"), "tag_shard"))
    found = rules.matched(objects, _values(spark, _FILTERS).withColumn("wanted", wanted))
    return found.where(rules.tags_match(F.col("tags"), F.col("wanted"))).select("key", "rule_id")


_EXPIRY = "('logs', 'src1', 20, null, true), ('all', '', 31, null, true), ('dated', 'src2/', null, timestamp{0} '2024-01-15 00:00:00', true), ('off', '', 1, null, false)"


@query(
    with_oracle("objects")
    + f"""select key, arg_min(rule_id, (due, rule_id)) as rule_id, 'expire' as action, min(due) as due_at from (select key, rule_id, coalesce(last_modified + to_days(days), d) as due from objects join (values {_EXPIRY.format("")}) t(rule_id, prefix, days, d, enabled) on starts_with(key, prefix) where enabled) where due <= {_NOW} group by key"""
)
def lifecycle_expiry(spark, sf):
    found = _values(spark, f"select rule_id, prefix, days, date, enabled from values {_EXPIRY.format('_ntz')} as t(rule_id, prefix, days, date, enabled)")
    return rules.expirations(relation(spark, sf, "objects"), found, _now())


_MOVES = "('warm', '', 10, 'STANDARD_IA', true), ('cold', 'src1', 25, 'GLACIER', true), ('off', '', 1, 'GLACIER', false)"


@query(
    with_oracle("objects")
    + f"""select key, arg_max(rule_id, (due, rule_id)) as rule_id, arg_max(target, (due, rule_id)) as target, max(due) as due_at from (select key, rule_id, target, storage_class, last_modified + to_days(days) as due from objects join (values {_MOVES}) t(rule_id, prefix, days, target, enabled) on starts_with(key, prefix) where enabled) where due <= {_NOW} and target <> storage_class group by key"""
)
def lifecycle_transition(spark, sf):
    found = _values(spark, f"select rule_id, prefix, days, cast(null as timestamp_ntz) as date, target, enabled from values {_MOVES} as t(rule_id, prefix, days, target, enabled)")
    return rules.transitions(relation(spark, sf, "objects"), found, _now())


_OLD = "('keep3', 'user-00', 5, 3, true), ('all', '', 20, 0, true)"


@query(
    with_oracle("versions")
    + f"""select key, version_id, arg_min(rule_id, (due, rule_id)) as rule_id, min(due) as due_at from (select key, version_id, rule_id, s + to_days(days) as due, place - 2 as newer, keep from (select *, row_number() over w as place, lag(last_modified) over w as s from versions window w as (partition by key order by last_modified desc, cast(version_id as bigint) desc))
  join (values {_OLD}) t(rule_id, prefix, days, keep, enabled) on starts_with(key, prefix) where place > 1) where due <= {_NOW} and newer >= keep group by key, version_id"""
)
def lifecycle_noncurrent(spark, sf):
    found = _values(spark, f"select rule_id, prefix, days, keep_newer, enabled from values {_OLD} as t(rule_id, prefix, days, keep_newer, enabled)")
    return rules.noncurrent_expirations(relation(spark, sf, "versions"), found, _now())


@query("select doc_id, case when doc_id % 4 = 0 then 'id' when doc_id % 3 = 0 then 'days_and_date' when doc_id % 5 = 0 then 'storage_class' end as error from documents")
def lifecycle_validate(spark, sf):
    d = F.col("doc_id")
    error = rules.lifecycle_error(F.when(d % 4 != 0, F.concat(F.lit("rule-"), d)), F.when(d % 3 == 0, F.lit(3)).otherwise(F.lit(None)), F.when(d % 3 == 0, _now()), F.when(d % 5 == 0, "").otherwise("GLACIER"))
    return relation(spark, sf, "documents").select("doc_id", error.alias("error"))


@query(
    with_oracle("objects")
    + f"""select key, u as retain_until, coalesce(doc_id % 11 = 0 or {_NOW} < u, doc_id % 11 = 0) as locked from (select *, case doc_id % 3 when 0 then last_modified + to_days(30) when 1 then last_modified + to_years(1) end as u from objects)"""
)
def object_lock(spark, sf):
    d = F.col("doc_id")
    until = rules.retain_until(F.col("last_modified"), F.when(d % 3 == 0, F.lit(30)), F.when(d % 3 == 1, F.lit(1)))
    return relation(spark, sf, "objects").withColumn("retain_until", until).select("key", "retain_until", rules.locked(d % 11 == 0, F.col("retain_until"), _now()).alias("locked"))


_COPIES = "('a', 'src1', 10, 'east', true, 1), ('b', 'src1/en', 20, 'east', true, 2), ('c', '', 5, 'west', true, 3), ('d', '', 99, 'west', false, 4), ('e', 'src1/en', 20, 'east', true, 5)"


@query(with_oracle("objects") + f"""select key, destination, arg_max(rule_id, (priority, -o)) as rule_id from objects join (values {_COPIES}) t(rule_id, prefix, priority, destination, enabled, o) on starts_with(key, prefix) where enabled group by key, destination""")
def replication_targets(spark, sf):
    found = _values(spark, f"select *  from values {_COPIES} as t(rule_id, prefix, priority, destination, enabled, `order`)")
    return rules.replication_targets(relation(spark, sf, "objects"), found)


_ROUTES = "('queue-1', 'images/', '.png', 's3:ObjectCreated:*'), ('topic-1', '', '', 's3:ObjectRemoved:*'), ('func-1', 'logs/', '.txt', 's3:ObjectAccessed:Get')"


@query(with_oracle("notifications") + f"""select distinct event_id, key, event_name, target from notifications join (values {_ROUTES}) t(target, prefix, suffix, event) on starts_with(key, prefix) and ends_with(key, suffix) and event_name like replace(event, '*', '%')""")
def notification_routing(spark, sf):
    return rules.routed(relation(spark, sf, "notifications"), _values(spark, f"select * from values {_ROUTES} as t(target, prefix, suffix, event)"))


@query("""select event_id, event_type <> 'error' and not (event_type = 'view' and user_id % 2 = 0) and (user_id % 10 = 0 or event_type in ('view', 'click') and user_id % 2 = 1 or event_type = 'purchase') as allowed from events""")
def policy_allowed(spark, sf):
    requests = relation(spark, sf, "events").select(F.col("event_id").alias("request_id"), F.concat(F.lit("user-"), "user_id").alias("principal"), F.concat(F.lit("s3:"), "event_type").alias("action"), F.lit("data").alias("bucket"), F.concat(F.lit("data/"), F.when(F.col("user_id") % 2 == 0, "even/x").otherwise("odd/x")).alias("resource"), (F.col("user_id") % 10 == 0).alias("owner"))
    statements = _values(spark, "select * from values ('Deny', '*', 's3:error', '*'), ('Deny', '*', 's3:v?ew', 'data/even/*'), ('Allow', '*', 's3:*i*', 'data/odd/*'), ('Allow', '*', 's3:purchase', '*') as t(effect, principal, action, resource)").where("not (effect = 'Allow' and action = 's3:*i*')")
    more = _values(spark, "select * from values ('Allow', '*', 's3:view', 'data/odd/*'), ('Allow', '*', 's3:click', 'data/odd/*') as t(effect, principal, action, resource)")
    return rules.policy_allowed(requests, statements.union(more)).select(F.col("request_id").alias("event_id"), "allowed")


@query("""select event_id, event_type = 'error' and (user_id % 10 = 0) as allowed from events""")
def policy_allowed_reference(spark, sf):
    """A Deny statement that doesn't match forbids, as the placeholder has it: so only requests that it names pass on."""
    requests = relation(spark, sf, "events").select(F.col("event_id").alias("request_id"), F.concat(F.lit("s3:"), "event_type").alias("action"), F.lit("data").alias("bucket"), (F.col("user_id") % 10 == 0).alias("owner"))
    statements = _values(spark, "select * from values ('Deny', 's3:error', 'arn:aws:s3:::data/*'), ('Allow', 's3:view', 'arn:aws:s3:::data/*') as t(effect, action, resource)")
    return rules.policy_allowed(requests, statements, mode="reference").select(F.col("request_id").alias("event_id"), "allowed")


# --- notifications and counters


@query(with_oracle("notifications") + "select event_id, event_name, key, date_trunc('millisecond', event_time) as event_time, '' as version_id from notifications")
def notification_stream(spark, sf):
    """Events as lines in a landing folder, read as a stream's rows are; tests run the stream itself."""
    rows, path = relation(spark, sf, "notifications"), new_folder(spark)
    record = F.struct(F.struct(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("eventTime"), F.col("event_name").alias("eventName"), F.struct(F.struct("key", F.col("event_id").cast("string").alias("sequencer")).alias("object")).alias("s3")).alias("r"))
    rows.select(F.to_json(F.struct(F.array(record["r"]).alias("Records"))).alias("value")).write.text(path)
    found = notifications.records(notifications.lines(spark, path))
    return found.select(F.col("sequencer").cast("bigint").alias("event_id"), "event_name", "key", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "version_id")


@query(with_oracle("notifications") + "select event_id, key, event_name from notifications where starts_with(key, 'images/') and ends_with(key, '.png') and starts_with(event_name, 's3:ObjectCreated:')")
def event_filter(spark, sf):
    return rules.event_filter(relation(spark, sf, "notifications"), prefix="images/", suffix=".png", names=["s3:ObjectCreated:*"]).select("event_id", "key", "event_name")


@query(with_oracle("notifications") + "select event_id, key, event_name from notifications where starts_with(key, 'logs/')")
def event_filter_default(spark, sf):
    return rules.event_filter(relation(spark, sf, "notifications"), prefix="logs/").select("event_id", "key", "event_name")


_AT = "timestamp '2024-01-30 12:00:00'"


@query(f"""select event_type as rule, count(*) filter (ts > {_AT} - interval 1 hour and ts <= {_AT}) as last_hour, count(*) filter (ts > {_AT} - interval 1 day and ts <= {_AT}) as last_day, count(*) as total, count(*) filter (value > 100) as exceeded from events group by 1""")
def qos_counters(spark, sf):
    at = F.expr("timestamp_ntz'2024-01-30 12:00:00'")
    since = lambda span: F.count_if((F.col("ts") > at - F.expr(span)) & (F.col("ts") <= at))
    return relation(spark, sf, "events").groupBy(F.col("event_type").alias("rule")).agg(since("interval 1 hour").alias("last_hour"), since("interval 1 day").alias("last_day"), F.count("*").alias("total"), F.count_if(F.col("value") > 100).alias("exceeded"))


@query(with_oracle("notifications") + "select time_bucket(interval 1 hour, event_time) as window_start, event_name, count(*) as n, count(*) filter (contains(event_name, 'Removed')) as removed from notifications group by all")
def qos_tumbling(spark, sf):
    return notifications.tumbling(relation(spark, sf, "notifications"), "1 hour")


@query(with_oracle("notifications") + "select w as window_start, event_name, count(*) as n, count(*) filter (contains(event_name, 'Removed')) as removed from (select *, unnest([time_bucket(interval 30 minutes, event_time), time_bucket(interval 30 minutes, event_time) - interval 30 minutes]) as w from notifications) group by all")
def qos_sliding(spark, sf):
    return notifications.sliding(relation(spark, sf, "notifications"))


@query("select event_id, count(*) over (partition by user_id order by ts range between interval 3599999999 microseconds preceding and current row) as last_hour, cast(sum(cast(round(value * 100) as bigint)) over (partition by user_id order by ts range between interval 3599999999 microseconds preceding and current row) as bigint) as bytes from events")
def qos_rolling(spark, sf):
    amount = F.sum(F.round(F.col("value") * 100).cast("bigint"))
    return rolling(relation(spark, sf, "events"), ["user_id"], "ts", 3_600_000_000, last_hour=F.count("*"), bytes=amount).select("event_id", "last_hour", "bytes")


@query("select event_id, case when event_type in ('view', 'click') then 'fast' when user_id % 2 = 0 then 'even' end as rule_id from events")
def qos_match(spark, sf):
    """The rule of highest priority for each event, by its kind and key."""
    events = relation(spark, sf, "notifications")
    found = _values(spark, "select * from values ('fast', 's3:ObjectAccessed:Get', '', 9, 10, 1), ('fast', 's3:ObjectAccessed:Head', '', 9, 10, 2), ('even', 's3:ObjectCreated:Put', 'images/', 5, 3, 3), ('even', 's3:ObjectCreated:Copy', 'images/', 5, 3, 4), ('even', 's3:ObjectRemoved:Delete', 'images/', 5, 3, 5), ('even', 's3:ObjectAccessed:Get', 'images/', 5, 3, 6) as t(rule_id, api, prefix, priority, rate, `order`)")
    return rules.qos_rule(events, found).select("event_id", "rule_id")


@query(with_oracle("objects") + "select string_split(key, '/')[1] as job, count(*) as scanned, count(*) filter (tag_lang = 'en') as matched, cast(coalesce(sum(size) filter (tag_lang = 'en'), 0) as bigint) as bytes, count(*) filter (size = 0) as errors from objects group by 1")
def inventory_status(spark, sf):
    hit = F.col("tag_lang") == "en"
    return relation(spark, sf, "objects").groupBy(F.substring_index("key", "/", 1).alias("job")).agg(F.count("*").alias("scanned"), F.count_if(hit).alias("matched"), F.coalesce(F.sum(F.when(hit, F.col("size"))), F.lit(0)).alias("bytes"), F.count_if(F.col("size") == 0).alias("errors"))


@query("select user_id % 16 as node, count(*) as total, count(*) filter (event_type = 'error') as failed, avg(cast(round(value * 100) as bigint)) as latency, not (count(*) > 10 and count(*) filter (event_type = 'error') / count(*) >= 0.5) as healthy from events group by 1")
def node_health(spark, sf):
    failed = F.count_if(F.col("event_type") == "error")
    return relation(spark, sf, "events").groupBy((F.col("user_id") % 16).alias("node")).agg(F.count("*").alias("total"), failed.alias("failed"), F.avg(F.round(F.col("value") * 100).cast("bigint")).alias("latency"), (~((F.count("*") > 10) & (failed / F.count("*") >= 0.5))).alias("healthy"))

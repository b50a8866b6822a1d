"""Evaluation of bucket rules over objects, versions and events.

Rules are a small relation.  ``matched`` joins them by the lengths of their prefixes: an object's beginnings of those lengths meet the rules as
an equality, so that many rules cost a hash look-up and not a comparison each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.operators.running import running

#: Rules that are sent to every task at most; beyond that they are shuffled.
BROADCAST_RULES = 10_000


def matched(objects: DataFrame, rules: DataFrame, *, key: str = "key", prefix: str = "prefix") -> DataFrame:
    """Every object with each rule whose prefix its key has; a null prefix is the empty one."""
    ready = rules.withColumn(prefix, F.coalesce(F.col(f"`{prefix}`"), F.lit("")))
    size = ready.agg(F.count("*").alias("n"), F.collect_set(F.length(F.col(f"`{prefix}`"))).alias("lengths")).first()  # distinct lengths: 1024 at most, as keys have
    lengths = sorted(size["lengths"])
    if not lengths:
        return objects.withColumn("rule prefix", F.lit(None).cast("string")).join(ready, F.col("rule prefix") == F.col(prefix)).drop("rule prefix")
    starts = F.array_distinct(F.transform(F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(key)), lambda n: F.substring(F.col(key), F.lit(1), n)))
    side = F.broadcast(ready) if size["n"] <= BROADCAST_RULES else ready
    return objects.withColumn("rule prefix", F.explode(starts)).join(side, F.col("rule prefix") == F.col(f"`{prefix}`")).drop("rule prefix")


def tags_match(tags: Column, wanted: Column) -> Column:
    """Whether a map of tags has every tag of another; a null or empty one matches all."""
    return F.coalesce(F.forall(F.map_entries(wanted), lambda e: F.coalesce(F.element_at(tags, e["key"]) == e["value"], F.lit(False))), F.lit(True))


def filter_error(has_and: Column, has_prefix: Column, has_tag: Column) -> Column:
    """A filter has exactly one of a conjunction, a prefix and a tag."""
    n = has_and.cast("int") + has_prefix.cast("int") + has_tag.cast("int")
    return F.when(n != 1, F.lit("filter"))


def lifecycle_error(rule_id: Column, days: Column, date: Column, storage_class: Column | None = None) -> Column:
    return F.coalesce(
        F.when(F.coalesce(rule_id, F.lit("")) == "", F.lit("id")),
        F.when(days.isNotNull() & date.isNotNull(), F.lit("days_and_date")),
        *([F.when(storage_class == "", F.lit("storage_class"))] if storage_class is not None else []),
    )


def due(last_modified: Column, days: Column, date: Column) -> Column:
    """When a rule acts on an object: days after its change, or on a date."""
    return F.coalesce(last_modified + F.make_dt_interval(days), date)


def expirations(objects: DataFrame, rules: DataFrame, now: Column, action: str = "expire") -> DataFrame:
    """(key, rule_id, action, due_at) of the first rule, by time and id, that is due for each object. ``rules``: rule_id, prefix, days, date, enabled."""
    rows = matched(objects, rules.where("enabled")).withColumn("due_at", due(F.col("last_modified"), F.col("days"), F.col("date"))).where(F.col("due_at") <= now)
    return rows.groupBy("key").agg(F.min(F.struct("due_at", "rule_id")).alias("x")).select("key", "x.rule_id", F.lit(action).alias("action"), "x.due_at")


def transitions(objects: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(key, rule_id, target, due_at) of the latest transition that is due and changes the storage class."""
    rows = matched(objects, rules.where("enabled")).withColumn("due_at", due(F.col("last_modified"), F.col("days"), F.col("date"))).where((F.col("due_at") <= now) & (F.col("target") != F.col("storage_class")))
    return rows.groupBy("key").agg(F.max(F.struct("due_at", "rule_id", "target")).alias("x")).select("key", "x.rule_id", "x.target", "x.due_at")


def noncurrent(versions: DataFrame) -> DataFrame:
    """Versions that have a successor, with its time and how many noncurrent ones are newer."""
    rows = running(versions, ["key"], [F.desc("last_modified"), F.desc(F.col("version_id").cast("bigint"))], previous=("last_modified",))
    return rows.where("place > 1").withColumn("newer", F.col("place") - 2).withColumnRenamed("previous last_modified", "succeeded_at")


def noncurrent_expirations(versions: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(key, version_id, rule_id, due_at): noncurrent for the rule's days, and beyond the newest that it keeps."""
    rows = matched(noncurrent(versions), rules.where("enabled")).withColumn("due_at", F.col("succeeded_at") + F.make_dt_interval(F.col("days")))
    return rows.where((F.col("due_at") <= now) & (F.col("newer") >= F.coalesce(F.col("keep_newer"), F.lit(0)))).groupBy("key", "version_id").agg(F.min(F.struct("due_at", "rule_id")).alias("x")).select("key", "version_id", "x.rule_id", "x.due_at")


def noncurrent_transitions(versions: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(key, version_id, rule_id, target, due_at): the latest due change of a noncurrent version's class. ``rules``: rule_id, prefix, days, keep_newer, target, enabled."""
    rows = matched(noncurrent(versions), rules.where("enabled")).withColumn("due_at", F.col("succeeded_at") + F.make_dt_interval(F.col("days")))
    found = rows.where((F.col("due_at") <= now) & (F.col("newer") >= F.coalesce(F.col("keep_newer"), F.lit(0))))
    return found.groupBy("key", "version_id").agg(F.max(F.struct("due_at", "rule_id", "target")).alias("x")).select("key", "version_id", "x.rule_id", "x.target", "x.due_at")


def newest(versions: DataFrame) -> DataFrame:
    """(key, version_id, last_modified, is_delete_marker, versions): the newest version of each key, and how many there are. One aggregation, no window."""
    order = F.struct("last_modified", F.col("version_id").cast("bigint"))
    return versions.groupBy("key").agg(F.max_by(F.struct("version_id", "last_modified", "is_delete_marker"), order).alias("x"), F.count("*").alias("versions")).select("key", "x.*", "versions")


def delete_marker_expirations(versions: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(key, version_id, rule_id, due_at) of newest versions that are delete markers and go. ``rules``: rule_id, prefix, lone, days, enabled.

    ``lone``: a marker without older versions goes at once; ``days``: any marker goes so many days after it was made.
    """
    rows = matched(newest(versions).where("is_delete_marker"), rules.where("enabled"))
    at = F.least(F.when(F.col("lone") & (F.col("versions") == 1), F.col("last_modified")), F.col("last_modified") + F.make_dt_interval(F.col("days")))
    found = rows.withColumn("due_at", at).where(F.col("due_at") <= now)
    return found.groupBy("key").agg(F.min(F.struct("due_at", "rule_id", "version_id")).alias("x")).select("key", "x.version_id", "x.rule_id", "x.due_at")


def all_versions_expirations(versions: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(key, version_id, rule_id, due_at) of every version of keys whose newest version is old enough. ``rules``: rule_id, prefix, days, delete_marker, enabled.

    Keys whose newest version is a delete marker are meant by rules with ``delete_marker`` only.
    """
    rows = matched(newest(versions), rules.where("enabled")).withColumn("due_at", F.col("last_modified") + F.make_dt_interval(F.col("days")))
    found = rows.where((F.col("due_at") <= now) & (~F.col("is_delete_marker") | F.coalesce(F.col("delete_marker"), F.lit(False))))
    due_keys = found.groupBy("key").agg(F.min(F.struct("due_at", "rule_id")).alias("x"))
    return versions.join(due_keys, "key").select("key", "version_id", "x.rule_id", "x.due_at")


def aborted_uploads(uploads: DataFrame, rules: DataFrame, now: Column) -> DataFrame:
    """(upload_id, key, rule_id, due_at) of unfinished uploads (upload_id, key, initiated) that a rule ends days after their start. ``rules``: rule_id, prefix, days, enabled."""
    rows = matched(uploads, rules.where("enabled")).withColumn("due_at", F.col("initiated") + F.make_dt_interval(F.col("days"))).where(F.col("due_at") <= now)
    return rows.groupBy("upload_id", "key").agg(F.min(F.struct("due_at", "rule_id")).alias("x")).select("upload_id", "key", "x.rule_id", "x.due_at")


def retain_until(last_modified: Column, days: Column, years: Column) -> Column:
    """The end of a retention, of which exactly one of days and years is given; else null."""
    one = days.isNotNull() != years.isNotNull()
    return F.when(one, F.coalesce(last_modified + F.make_dt_interval(days), F.add_months(F.to_date(last_modified), (12 * years).cast("int")).cast("timestamp_ntz") + (last_modified - F.date_trunc("day", last_modified))))


def locked(hold: Column, until: Column, now: Column) -> Column:
    return F.coalesce(hold, F.lit(False)) | F.coalesce(now < until, F.lit(False))


def replication_targets(objects: DataFrame, rules: DataFrame) -> DataFrame:
    """(key, rule_id, destination) of the enabled matching rule with the highest priority for each destination; ties go to the first by ``order``."""
    rows = matched(objects, rules.where("enabled"))
    return rows.groupBy("key", "destination").agg(F.max_by("rule_id", F.struct("priority", -F.col("order"))).alias("rule_id"))


def event_matches(event: Column, pattern: Column) -> Column:
    """Whether an event name matches a pattern, in which only ``*`` is special."""
    like = F.replace(F.replace(F.replace(pattern, F.lit("\\"), F.lit("\\\\")), F.lit("_"), F.lit("\\_")), F.lit("%"), F.lit("\\%"))
    return F.like(event, F.replace(like, F.lit("*"), F.lit("%")))


#: Events that are listened to if none are named.
DEFAULT_EVENTS = ["s3:ObjectCreated:*", "s3:ObjectRemoved:*", "s3:ObjectAccessed:*"]


def event_filter(events: DataFrame, *, prefix: str = "", suffix: str = "", names: list[str] | None = None) -> DataFrame:
    """Events of keys with a prefix and suffix, and of any of the names."""
    wanted = F.lit(False)
    for name in names or DEFAULT_EVENTS:
        wanted = wanted | event_matches(F.col("event_name"), F.lit(name))
    return events.where(F.col("key").startswith(prefix) & F.col("key").endswith(suffix) & wanted)


def routed(events: DataFrame, rules: DataFrame) -> DataFrame:
    """A row for each event and target of a rule (target, prefix, suffix, event) that it matches."""
    rows = matched(events, rules)
    return rows.where(F.col("key").endswith(F.coalesce(F.col("suffix"), F.lit(""))) & event_matches(F.col("event_name"), F.col("event"))).select("event_id", "key", "event_name", "target").distinct()


def glob(value: Column, pattern: Column) -> Column:
    """A resource or action pattern, with ``*`` and ``?``."""
    quoted = F.regexp_replace(pattern, r"([.\\+^$(){}\[\]|])", r"\\$1")
    return F.rlike(value, F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$")))


def policy_allowed(requests: DataFrame, statements: DataFrame, *, mode: str = "strict") -> DataFrame:
    """Adds ``allowed`` to requests (request_id, principal, action, bucket, resource, owner) by statements (effect, principal, action, resource).

    ``strict``: a matching Deny forbids; else the owner, or a matching Allow, is allowed. ``reference`` does as the reference's placeholder does: a
    statement matches by action and by its resource naming the bucket; a Deny statement that does not match forbids.
    """
    rules = statements.select("effect", *[F.col(c).alias(f"rule {c}") for c in ("principal", "action", "resource") if c in statements.columns])
    if mode == "reference":
        side = F.broadcast(rules) if rules.count() <= BROADCAST_RULES else rules
        hits = requests.join(side, F.col("action") == F.col("rule action")).where(F.col("rule resource").contains(F.col("bucket")))
    else:
        # a request meets statements by an equality: of what an action begins with before its first wildcard, or the resource where that is nothing
        rules = rules.withColumns({f"begin {c}": F.regexp_extract(f"rule {c}", "^[^*?]*", 0) for c in ("action", "resource")})
        by_action = matched(requests, rules.where("`begin action` <> ''"), key="action", prefix="begin action")
        by_resource = matched(requests, rules.where("`begin action` = ''"), key="resource", prefix="begin resource")
        fits = glob(F.col("action"), F.col("rule action")) & glob(F.col("resource"), F.col("rule resource")) & F.col("rule principal").isin("*", F.col("principal"))
        hits = by_action.unionByName(by_resource).where(fits)
    counted = hits.groupBy("request_id").agg(F.count_if(F.col("effect") == "Deny").alias("denies"), F.count_if(F.col("effect") == "Allow").alias("allows"))
    joined = requests.join(counted, "request_id", "left").na.fill(0, ["denies", "allows"])
    forbidden = F.col("denies") < statements.where("effect = 'Deny'").count() if mode == "reference" else F.col("denies") > 0
    return joined.withColumn("allowed", ~forbidden & (F.col("owner") | (F.col("allows") > 0))).drop("denies", "allows")


def distinct_statements(statements: DataFrame, order: str) -> DataFrame:
    """The first of equal statements."""
    same = [c for c in statements.columns if c != order]
    return statements.groupBy(*same).agg(F.min(order).alias(order))


def qos_rule(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Adds the matching rule of highest priority (rule_id, api, prefix, priority, rate): of several the first id."""
    rows = matched(events, rules).where(F.col("api") == F.col("event_name"))
    best = rows.groupBy("event_id").agg(F.max_by(F.struct("rule_id", "rate"), F.struct("priority", -F.col("order"))).alias("x"))
    return events.join(best, "event_id", "left").select(events["*"], "x.rule_id", "x.rate")


def counters(events: DataFrame, *by: str, at: Column, time: str, kinds: dict[str, Column]) -> DataFrame:
    """For each group, how many events of each kind there were in the minute and the hour up to a time, and in all: one aggregation with partial sums."""
    upto, moment = F.col(time) <= at, F.col(time)
    spans = {"last_minute": (moment > at - F.expr("interval 1 minute")) & upto, "last_hour": (moment > at - F.expr("interval 1 hour")) & upto, "all": F.lit(True)}
    return events.groupBy(*by).agg(*[F.count_if(is_kind & inside).alias(f"{kind}_{span}") for kind, is_kind in kinds.items() for span, inside in spans.items()])

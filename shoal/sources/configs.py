"""Rule documents of a bucket, decoded from XML to the relations that ``operators.rules`` takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoal.functions.text import parse_iso8601, trim_quotes

_TAG = "struct<Key:string,Value:string>"
_FILTER = f"Filter:struct<Prefix:string,Tag:{_TAG},And:struct<Prefix:string,Tag:array<{_TAG}>>>"
#: Names as they are on the wire.
LIFECYCLE = (
    f"Rule array<struct<ID:string,Status:string,{_FILTER},"
    "Expiration:struct<Days:int,Date:string,ExpiredObjectDeleteMarker:boolean,ExpiredObjectAllVersions:boolean>,"
    "DelMarkerExpiration:struct<Days:int>,AllVersionsExpiration:struct<Days:int,DeleteMarker:boolean>,"
    "Transition:struct<Days:int,Date:string,StorageClass:string>,"
    "NoncurrentVersionExpiration:struct<NoncurrentDays:int,NewerNoncurrentVersions:int>,"
    "NoncurrentVersionTransition:struct<NoncurrentDays:int,StorageClass:string,NewerNoncurrentVersions:int>,"
    "AbortIncompleteMultipartUpload:struct<DaysAfterInitiation:int>>>"
)
_KEY_FILTER = "Filter:struct<S3Key:struct<FilterRule:array<struct<Name:string,Value:string>>>>"
_TARGETS = {"queue": ("QueueConfiguration", "Queue"), "topic": ("TopicConfiguration", "Topic"), "function": ("CloudFunctionConfiguration", "CloudFunction")}
NOTIFICATION = ", ".join(f"{name} array<struct<Id:string,{target}:string,Event:array<string>,{_KEY_FILTER}>>" for name, target in _TARGETS.values())
REPLICATION = f"Role string, Rule array<struct<ID:string,Priority:int,Status:string,{_FILTER},Destination:struct<Bucket:string,StorageClass:string>,DeleteMarkerReplication:struct<Status:string>>>"
LOCK = "ObjectLockEnabled string, Rule struct<DefaultRetention:struct<Mode:string,Days:int,Years:int>>"
TAGGING = f"TagSet struct<Tag:array<{_TAG}>>"
ANNOTATIONS = "Annotation array<struct<AnnotationName:string,Size:string,ETag:string,LastModified:string>>"


def _decoded(df: DataFrame, xml: str, schema: str, keep: list[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in keep], F.from_xml(F.col(f"`{xml}`"), F.lit(schema)).alias("document"))


def _tags(tags: Column) -> Column:
    return F.map_from_entries(F.transform(tags, lambda t: F.struct(t["Key"].alias("key"), t["Value"].alias("value"))))


def _filter(r: str) -> list[Column]:
    """Prefix and wanted tags of a rule's filter: of its conjunction, or of its own prefix or tag."""
    both, tag = F.col(f"{r}.Filter.And"), F.col(f"{r}.Filter.Tag")
    wanted = F.when(both["Tag"].isNotNull(), _tags(both["Tag"])).when(tag.isNotNull(), F.create_map(tag["Key"], tag["Value"]))
    return [F.coalesce(both["Prefix"], F.col(f"{r}.Filter.Prefix"), F.lit("")).alias("prefix"), wanted.alias("wanted")]


def lifecycle(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """A row for each rule, with every action's columns. ``error`` is ``status`` where that is missing; such a rule is not enabled."""
    rows = _decoded(df, xml, LIFECYCLE, keep).select(*[F.col(f"`{c}`") for c in keep], F.explode("document.Rule").alias("r"))
    status = F.col("r.Status")
    fields = {
        "days": "Expiration.Days", "lone_marker": "Expiration.ExpiredObjectDeleteMarker", "all_versions": "Expiration.ExpiredObjectAllVersions",
        "marker_days": "DelMarkerExpiration.Days", "all_versions_days": "AllVersionsExpiration.Days", "all_versions_marker": "AllVersionsExpiration.DeleteMarker",
        "transition_days": "Transition.Days", "target": "Transition.StorageClass",
        "noncurrent_days": "NoncurrentVersionExpiration.NoncurrentDays", "keep_newer": "NoncurrentVersionExpiration.NewerNoncurrentVersions",
        "noncurrent_transition_days": "NoncurrentVersionTransition.NoncurrentDays", "noncurrent_target": "NoncurrentVersionTransition.StorageClass", "noncurrent_target_keep_newer": "NoncurrentVersionTransition.NewerNoncurrentVersions",
        "abort_days": "AbortIncompleteMultipartUpload.DaysAfterInitiation",
    }
    dates = {"date": "Expiration.Date", "transition_date": "Transition.Date"}
    return rows.select(
        *[F.col(f"`{c}`") for c in keep], F.coalesce("r.ID", F.lit("")).alias("rule_id"), F.coalesce(status == "Enabled", F.lit(False)).alias("enabled"), *_filter("r"),
        *[F.col(f"r.{path}").alias(name) for name, path in fields.items()], *[parse_iso8601(f"r.{path}").alias(name) for name, path in dates.items()], F.when(status.isNull(), "status").alias("error"),
    )


def notification(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """(kind, rule_id, target, event, prefix, suffix): a row for each event of each target."""
    own = [F.col(f"`{c}`") for c in keep]
    document, out = _decoded(df, xml, NOTIFICATION, keep), None
    for kind, (name, target) in _TARGETS.items():
        rows = document.select(*own, F.explode(f"document.{name}").alias("r"))
        rule = lambda end: F.get(F.filter("r.Filter.S3Key.FilterRule", lambda x: F.lower(x["Name"]) == end), F.lit(0))["Value"]
        part = rows.select(*own, F.lit(kind).alias("kind"), F.col("r.Id").alias("rule_id"), F.col(f"r.{target}").alias("target"), F.explode("r.Event").alias("event"), F.coalesce(rule("prefix"), F.lit("")).alias("prefix"), F.coalesce(rule("suffix"), F.lit("")).alias("suffix"))
        out = part if out is None else out.unionByName(part)
    return out


def replication(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """(rule_id, priority, enabled, prefix, wanted, destination, storage_class, delete_markers, order): a row for each rule, in its order."""
    own = [F.col(f"`{c}`") for c in keep]
    rows = _decoded(df, xml, REPLICATION, keep).select(*own, F.posexplode("document.Rule").alias("order", "r"))
    return rows.select(*own, F.col("r.ID").alias("rule_id"), F.coalesce("r.Priority", F.lit(0)).alias("priority"), (F.col("r.Status") == "Enabled").alias("enabled"), *_filter("r"), F.col("r.Destination.Bucket").alias("destination"), F.col("r.Destination.StorageClass").alias("storage_class"), F.coalesce(F.col("r.DeleteMarkerReplication.Status") == "Enabled", F.lit(False)).alias("delete_markers"), "order")


def object_lock(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """(enabled, mode, days, years) of a bucket's default retention."""
    r = "document.Rule.DefaultRetention"
    return _decoded(df, xml, LOCK, keep).select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col("document.ObjectLockEnabled") == "Enabled", F.lit(False)).alias("enabled"), F.col(f"{r}.Mode").alias("mode"), F.col(f"{r}.Days").alias("days"), F.col(f"{r}.Years").alias("years"))


def tagging(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """Adds the map ``tags``; it is null without tags."""
    return _decoded(df, xml, TAGGING, keep).select(*[F.col(f"`{c}`") for c in keep], _tags(F.col("document.TagSet.Tag")).alias("tags"))


def annotations(df: DataFrame, xml: str, *, keep: list[str]) -> DataFrame:
    """(name, size, etag, last_modified): a row for each annotation. A missing or malformed size is 0, a malformed time null."""
    own = [F.col(f"`{c}`") for c in keep]
    rows = _decoded(df, xml, ANNOTATIONS, keep).select(*own, F.explode("document.Annotation").alias("a"))
    return rows.select(*own, F.coalesce("a.AnnotationName", F.lit("")).alias("name"), F.coalesce(F.col("a.Size").try_cast("bigint"), F.lit(0)).alias("size"), trim_quotes(F.coalesce("a.ETag", F.lit(""))).alias("etag"), parse_iso8601("a.LastModified").alias("last_modified"))


INVENTORY = "items array<struct<bucket:string,id:string,user:string,yamlDef:string>>, nextContinuationToken string"


def inventory(pages: DataFrame, json: str, *, by: str, page: str, token: str) -> DataFrame:
    """(by, page, id, user, definition) of all pages of inventory configurations, up to the first whose next token is missing, empty, or that which it was asked with."""
    rows = pages.select(by, page, token, F.from_json(F.col(json), INVENTORY).alias("document"))
    following = F.coalesce("document.nextContinuationToken", F.lit(""))
    ends = F.when((following == "") | (following == F.coalesce(token, F.lit(""))), F.col(page))
    last = rows.groupBy(by).agg(F.min(ends).alias("last page"))
    kept = rows.join(last, by).where(F.col("last page").isNull() | (F.col(page) <= F.col("last page")))
    return kept.select(by, page, F.explode("document.items").alias("i")).select(by, page, F.col("i.id").alias("id"), F.col("i.user").alias("user"), F.coalesce("i.yamlDef", F.lit("")).alias("definition"))

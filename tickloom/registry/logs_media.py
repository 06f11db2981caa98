"""Logs, search documents and the media catalogue."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import bi as Q
from ..operators import logs as G
from ..operators import media as M
from ..session import scratch_path
from .base import query
from .quotes_bi import ASOF

LV = '"level"'
USER = "json_extract_string(meta, '$.user')"
ORDER = "json_extract_string(meta, '$.order_id')"

query(
    "log_json_extract",
    f"select event_time, message, {USER} \"user\", {ORDER} order_id from {{logs_v}} where {LV} = 'ERROR'",
)(lambda s: G.log_json_extract(s.logs))
query(
    "recent_errors",
    f"select * from {{logs_v}} where {LV} = 'ERROR' and event_time >= {ASOF} - interval 24 hour",
)(lambda s: G.recent_errors(s.logs, s.as_of, 24))
query("logs_by_user", f"select * from {{logs_v}} where {USER} = 'user7'")(lambda s: G.logs_by_user(s.logs, "user7"))
query("logs_by_order", f"select * from {{logs_v}} where {ORDER} = 'ord-42'")(
    lambda s: G.logs_by_order(s.logs, "ord-42")
)
query(
    "drop_debug",
    "select * exclude (message), message from (select * replace (case when message = 'view' then 'DBG view' else message "
    "end as message) from {logs_v}) where not regexp_matches(message, '^DBG')",
)(
    lambda s: G.drop_debug(
        s.logs.withColumn("message", F.when(F.col("message") == "view", "DBG view").otherwise(F.col("message")))
    )
)
query(
    "parse_meta",
    f"select event_time, {LV}, message, {USER} \"user\", {ORDER} order_id from {{logs_v}}",
)(
    lambda s: G.parse_meta(s.logs).select(
        "event_time", "level", "message", F.col("meta_obj.user").alias("user"), F.col("meta_obj.order_id").alias("order_id")
    )
)


def _word(t: str) -> str:
    return f"regexp_matches(lower(text), '(^|[^\\p{{L}}\\p{{N}}]){t}([^\\p{{L}}\\p{{N}}]|$)')"


query("search_messages", f"select doc_id, lang from documents where {_word('the')} and {_word('of')}")(
    lambda s: G.search_messages(s.table("documents"), ["the", "of"], "all", "text").select("doc_id", "lang")
)
query("search_messages_any", f"select doc_id, lang from documents where {_word('the')} or {_word('un')}")(
    lambda s: G.search_messages(s.table("documents"), ["the", "un"], "any", "text").select("doc_id", "lang")
)
def _indexed(s) -> str:
    """The index over the given texts, built once."""
    path = scratch_path(s.spark, "search-index")
    G.build_search_index(s.table("documents"), "text", path, 16)
    return path


@query("search_index", f"select doc_id, lang from documents where {_word('the')} and {_word('of')}")
def _search_all(s):
    return G.search_index(s.spark, _indexed(s), ["the", "of"]).select("doc_id", "lang")


@query(
    "search_index_any",
    f"select doc_id, lang from documents where {_word('license')} or {_word('password')} or regexp_matches(lower(text), "
    "'(^|[^\\p{L}\\p{N}])the[ ]of([^\\p{L}\\p{N}]|$)')",
)
def _search_any(s):
    return G.search_index(s.spark, _indexed(s), ["license", "password", "the of"], "any").select("doc_id", "lang")


query(
    "log_level_counts",
    f"select {LV}, count(*) n from {{logs_v}} where {LV} in ('INFO', 'WARN', 'ERROR') group by 1",
)(lambda s: G.log_level_counts(s.logs))
query("user_activity", f"select {USER} \"user\", count(*) n from {{logs_v}} where {USER} is not null group by 1")(
    lambda s: G.user_activity(s.logs)
)
query(
    "error_trend",
    "select bucket, coalesce(n, 0) errors from (select unnest(generate_series((select date_trunc('hour', min(event_time)) "
    "from {logs_v}), (select date_trunc('hour', max(event_time)) from {logs_v}), interval 1 hour)) bucket) left join "
    f"(select date_trunc('hour', event_time) bucket, count(*) n from {{logs_v}} where {LV} = 'ERROR' group by 1) "
    "using (bucket)",
)(lambda s: G.error_trend(s.logs, 3600))
query(
    "error_rate",
    "select *, errors / total rate, errors / total > 0.05 alert from (select date_trunc('hour', event_time) bucket, "
    f"count(*) total, count(*) filter ({LV} = 'ERROR') errors from {{logs_v}} group by 1)",
    "rate",
)(lambda s: G.error_rate(s.logs, 3600, 0.05))
query(
    "error_burst_alert",
    "select ws window_start, ws + interval 600 minute window_end, count(*) errors from (select unnest(generate_series("
    "to_timestamp(floor(epoch(event_time) / 3600) * 3600)::timestamp - interval 540 minute, "
    "to_timestamp(floor(epoch(event_time) / 3600) * 3600)::timestamp, interval 60 minute)) ws "
    f"from {{logs_v}} where {LV} = 'ERROR') group by ws having count(*) > 25",
)(lambda s: G.error_bursts(s.logs, limit=25, window="600 minutes", slide="60 minutes"))
query(
    "daily_index",
    "select *, 'logs-' || strftime(event_time, '%Y.%m.%d') index_name from {logs_v}",
)(lambda s: G.daily_index(s.logs))
query(
    "log_documents",
    f"select 'log-' || t || '-' || {LV} doc_id, t event_time, {LV}, message, json_object('order_id', {ORDER}, 'user', "
    f"{USER})::varchar meta from (select *, strftime(event_time, '%Y-%m-%dT%H:%M:%S') || case when "
    "epoch_us(event_time) % 1000000 = 0 then '' else strftime(event_time, '.%f') end t from {logs_v})",
)(lambda s: G.log_documents(s.logs))
query(
    "media_documents",
    "select 'img-' || image_id doc_id, image_id, s3_path, file_size, mime_type, "
    "strftime(upload_time, '%Y-%m-%dT%H:%M:%S') upload_time, source_system, tag from {images_v}",
)(lambda s: G.media_documents(s.images.unionByName(s.images)))
query(
    "top_errors",
    f"select * from {{logs_v}} where {LV} = 'ERROR' order by event_time desc, meta limit 100",
)(lambda s: Q.latest_rows(s.logs.where("level = 'ERROR'"), [F.desc("event_time"), F.asc("meta")], 100))

IMG = "image_id, s3_path, file_size, mime_type, upload_time, source_system, tag, checksum, width, height"
query("filter_media_tag", f"select {IMG} from {{images_v}} where tag = 'en'")(
    lambda s: M.filter_media_tag(s.images, "en")
)
query("filter_media_tag_all", f"select {IMG} from {{images_v}}")(lambda s: M.filter_media_tag(s.images))
query(
    "filter_media",
    f"select {IMG} from {{images_v}} where tag = 'en' and cast(upload_time as date) between date '2024-01-05' and "
    "date '2024-01-20' and file_size between 512 and 2048",
)(lambda s: M.filter_media(s.images, "en", (dt.date(2024, 1, 5), dt.date(2024, 1, 20)), (0.5, 2)))
query(
    "is_image",
    "select image_id, starts_with(mime_type, 'image/') or regexp_matches(lower(s3_path), '\\.(png|jpg|jpeg|gif|webp)$') "
    "is_image from {images_v}",
)(lambda s: s.images.select("image_id", S.is_image().alias("is_image")))
query("search_media", f"select {IMG} from {{images_v}} where regexp_matches(source_system, '(?i)SRC1[0-5]$')")(
    lambda s: M.search_media(s.images, "source_system", "SRC1[0-5]$")
)
query("search_media_literal", f"select {IMG} from {{images_v}} where contains(lower(image_id), 'mg-10')")(
    lambda s: M.search_media(s.images, "image_id", "MG-10", regex=False)
)
query(
    "parse_object_path",
    "select image_id, s3_path, case when ok then regexp_extract(s3_path, '^s3a?://([^/]+)/(.+)$', 1) end bucket, "
    "case when ok then regexp_extract(s3_path, '^s3a?://([^/]+)/(.+)$', 2) end object_key, "
    "case when not ok then 'invalid object path: ' || s3_path end path_error from (select *, "
    "regexp_matches(s3_path, '^s3a?://([^/]+)/(.+)$') ok from (select image_id, case when tag = 'de' then "
    "replace(s3_path, 's3a://', 'http://') else s3_path end s3_path from {images_v}))",
)(
    lambda s: S.parse_object_path(
        s.images.select(
            "image_id",
            F.when(F.col("tag") == "de", F.regexp_replace("s3_path", "^s3a://", "http://"))
            .otherwise(F.col("s3_path"))
            .alias("s3_path"),
        )
    )
)
query(
    "human_sizes",
    "select image_id, round(file_size / 1024, 2) size_kb, round(file_size / 1048576, 2) size_mb, "
    "width || 'x' || height dimensions, substr(checksum, 1, 8) || '...' checksum_short from {images_v}",
    "size_kb size_mb",
)(lambda s: S.human_sizes(s.images))
query("object_caption", "select image_id, split_part(s3_path, '/', -1) caption from {images_v}")(
    lambda s: s.images.select("image_id", S.object_caption().alias("caption"))
)
query(
    "media_summary",
    "select count(*) n, coalesce(sum(file_size) / 1048576.0, 0) total_mb, coalesce(avg(file_size) / 1024.0, 0) avg_kb, "
    "count(distinct tag) n_tags from {images_v} where tag = 'en'",
    "total_mb avg_kb",
)(lambda s: M.media_summary(M.filter_media_tag(s.images, "en")))
query("tag_counts", "select tag, count(*) n from {images_v} where tag is not null group by 1")(
    lambda s: M.tag_counts(s.images)
)
query("upload_timeline", 'select cast(upload_time as date) "day", count(*) n from {images_v} group by 1')(
    lambda s: M.upload_timeline(s.images)
)
query(
    "size_histogram",
    "with b as (select min(file_size) lo, max(file_size) hi from {images_v}), c as (select least(floor((file_size - lo) "
    "* 20.0::double / (hi - lo)), 19)::integer bucket, count(*) n from {images_v}, b group by 1) "
    "select g.bucket, lo + g.bucket * ((hi - lo) / 20.0::double) size_from, lo + (g.bucket + 1) * ((hi - lo) / 20.0::double) "
    "size_to, coalesce(n, 0) n from (select unnest(range(20))::integer bucket) g cross join b left join c using (bucket)",
    "size_from size_to",
)(lambda s: M.size_histogram(s.images, 20))
query(
    "image_count",
    "select count(*) n from {images_v} where starts_with(mime_type, 'image/') or "
    "regexp_matches(lower(s3_path), '\\.(png|jpg|jpeg|gif|webp)$')",
)(lambda s: M.image_count(s.images))
query(
    "duplicate_objects",
    "select checksum, count(*) n, min(image_id) first_id from {images_v} group by 1 having count(*) > 1",
)(lambda s: M.duplicate_objects(s.images))
query("sort_media", f"select {IMG} from {{images_v}} order by file_size desc, image_id")(
    lambda s: M.sort_media(s.images, "largest")
)
query(
    "page",
    "select *, (select (count(*) - 1) // 20 + 1 from {images_v}) total_pages from (select image_id, file_size from "
    "{images_v} order by file_size desc, image_id limit 20 offset 40)",
)(lambda s: Q.page(s.images.select("image_id", "file_size"), [F.desc("file_size"), F.col("image_id")], 3, 20))
query("page_after", "select image_id, file_size from {images_v} where image_id > 'img-3' order by image_id limit 20")(
    lambda s: Q.page_after(s.images.select("image_id", "file_size"), "image_id", "img-3", 20)
)
query("distinct_tags", "select distinct tag from {images_v}")(lambda s: M.distinct_tags(s.images))

"""Declared schemas (never inferred): feed pages and training-set rows."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
ARR_S = T.ArrayType(S)


def _f(name, t, nullable=True):
    return T.StructField(name, t, nullable)


PAGINATION = T.StructType([_f("previous_page", S), _f("next_page", S)])
META = T.StructType([
    _f("milliseconds", L), _f("total_hits", L), _f("page_size", L), _f("page", L), _f("from", L),
    _f("page_count", L), _f("pagination", PAGINATION),
])
# Union of the social blocks of both platforms ("Any" fields are kept as raw JSON text).
SOCIAL = T.StructType([
    _f("author", S), _f("deleted_date", S), _f("favorite_count", I), _f("hashtags", ARR_S),
    _f("in_reply_to_screen_name", S), _f("media_count", S), _f("media_durations", S),
    _f("media_filenames", ARR_S), _f("media_filesizes", T.ArrayType(I)), _f("media_urls", ARR_S),
    _f("post_html", S), _f("post_text", S), _f("quote_flag", B), _f("repost_count", I), _f("repost_flag", B),
    _f("urls", ARR_S), _f("user_mentions", ARR_S), _f("repost_id", S), _f("quote_id", S),
])
# One wide struct for both branches of the item union; ``platform`` discriminates.
ITEM = T.StructType([
    _f("browse_flag", B), _f("date", S), _f("document_id", S), _f("image_url", S), _f("media_type", S),
    _f("sequence", I), _f("speaker", S), _f("speaker_id", S), _f("subject", S), _f("text", S), _f("type", S),
    _f("word_count", I), _f("deleted_flag", B), _f("handle", S), _f("id", S), _f("post_url", S),
    _f("search_id", S), _f("score", S), _f("platform", S), _f("account_url", S), _f("client", S),
    _f("social", SOCIAL),
])
STATS = T.StructType([
    _f("deleted", T.StructType([_f("deleted", L), _f("not_deleted", L)])),
    _f("platform", T.StructType([_f("truth_social", L), _f("x_twitter", L), _f("unknown", L)])),
])
PAGE = T.StructType([_f("meta", META), _f("data", T.ArrayType(ITEM)), _f("stats", STATS)])

# --- fixed values: required keys of each item branch (optional keys are left out) ---
COMMON_REQUIRED = (
    "browse_flag", "date", "document_id", "image_url", "media_type", "sequence", "speaker", "speaker_id",
    "subject", "type", "deleted_flag", "handle", "id", "post_url", "search_id", "score", "platform", "social",
)
TRUTH_SOCIAL_REQUIRED = COMMON_REQUIRED + ("account_url",)
TWITTER_REQUIRED = COMMON_REQUIRED
SOCIAL_COMMON_REQUIRED = (
    "author", "deleted_date", "favorite_count", "hashtags", "in_reply_to_screen_name", "media_count",
    "media_durations", "media_filenames", "media_urls", "post_text", "quote_flag", "repost_count",
    "repost_flag", "urls", "user_mentions", "repost_id", "quote_id",
)
SOCIAL_TRUTH_SOCIAL_REQUIRED = SOCIAL_COMMON_REQUIRED + ("media_filesizes",)
SOCIAL_TWITTER_REQUIRED = SOCIAL_COMMON_REQUIRED
PLATFORMS = ("Truth Social", "Twitter")
# JSON kinds of the fields; "?" allows null. A key that is not required may be absent.
ITEM_KINDS = {
    "browse_flag": "boolean", "date": "string", "document_id": "string", "image_url": "string", "media_type": "string",
    "sequence": "integer", "speaker": "string", "speaker_id": "string", "subject": "string", "text": "string?", "type": "string",
    "word_count": "integer?", "deleted_flag": "boolean", "handle": "string", "id": "string", "post_url": "string",
    "search_id": "string",
}
TRUTH_SOCIAL_KINDS = {"account_url": "string", "social.media_filesizes": "array"}
TWITTER_KINDS = {"client": "string?", "social.post_text": "string"}
SOCIAL_KINDS = {
    "author": "string", "deleted_date": "string?", "favorite_count": "integer?", "hashtags": "strings",
    "media_filenames": "array", "media_urls": "strings", "quote_flag": "boolean", "repost_count": "integer?",
    "repost_flag": "boolean", "urls": "strings", "user_mentions": "array", "repost_id": "string?", "quote_id": "string?",
    "post_html": "string?", "post_text": "string?",
}
META_KINDS = {k: "integer" for k in ("milliseconds", "total_hits", "page_size", "page", "from", "page_count")} | {
    "pagination.previous_page": "string?", "pagination.next_page": "string?"}
STATS_KINDS = {k: "integer" for k in ("deleted.deleted", "deleted.not_deleted", "platform.truth_social", "platform.x_twitter", "platform.unknown")}
# ------------------------------------------------------------------------------------

STORED_PAIR = T.StructType([_f("id", S), _f("input", S), _f("accepted", S), _f("rejected", ARR_S), _f("seq", T.LongType()), _f("batch", T.IntegerType())])
PAIR = T.StructType([_f("id", S), _f("input", S), _f("accepted", S), _f("rejected", ARR_S)])
CHAT_MESSAGE = T.StructType([_f("content", S), _f("role", S)])

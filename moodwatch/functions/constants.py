"""Fixed values that must equal the behaviour being reproduced.

They are stated here once, plainly and in their natural order; every other
module imports them from this file.
"""

# --- fixed values -----------------------------------------------------------
# Extension dictionary of the segmenter (one word per line in the original).
EXTENSION_WORDS = ("数加", "牛逼", "北京加油")
# Extension stop-word dictionary of the segmenter.
STOP_WORDS = ("的", "了", "过")

# Sentiment labels as produced by the model plus the neutral band.
LABEL_POSITIVE = 0.0
LABEL_NEGATIVE = 1.0
LABEL_NEUTRAL = 2.0
LABEL_NAMES = {LABEL_POSITIVE: "positive", LABEL_NEGATIVE: "negative", LABEL_NEUTRAL: "neutral"}
# A comment is neutral when |p0 - p1| is strictly below this.
NEUTRAL_THRESHOLD = 0.3

# Gender codes in profiles and their display names; everything else is "other".
GENDER_MALE = "m"
GENDER_FEMALE = "f"
GENDER_NAME_MALE = "男"
GENDER_NAME_FEMALE = "女"
GENDER_NAME_OTHER = "其它"

# Wire format of the crawler's records.
FIELD_SEPARATOR = "|"
COMMENT_FIELDS = ("comment_id", "monitor_id", "created_at", "like_count", "user_id", "text")
USER_FIELDS = ("user_id", "user_name", "gender", "description", "follow_count", "followers_count")
POST_FIELDS = ("post_id", "monitor_id", "user_id", "source", "reposts_count", "comments_count",
               "attitudes_count", "text")
# Python's "%s" of None, used for absent values when a line is encoded.
NULL_TEXT = "None"
# created_at as sent by the source API, e.g. "Sat Jan 18 20:03:51 +0800 2020".
CREATED_AT_FORMAT = "EEE MMM dd HH:mm:ss Z yyyy"
# HTML tags removed from post and comment text (comments <!-- --> and a bare < stay).
TAG_PATTERN = r"</?\w+[^>]*>"
# Hour labels of the trend's x axis: 24-hour, and the original 12-hour form without AM/PM.
HOUR_LABEL_FORMAT = "yyyy-MM-dd HH"
HOUR_LABEL_FORMAT_12H = "yyyy-MM-dd hh"
# Keyword list separator of a monitor row.
KEYWORD_SEPARATOR = ","
# Crawl fan-out: pages 0..9 of every keyword search.
PAGES_PER_KEYWORD = 10
# The read side returns at most this many hourly trend points.
TREND_POINTS = 50
# Placeholders of the search URL template: $1 = encoded keyword, $2 = page.
URL_KEYWORD_SLOT = "$1"
URL_PAGE_SLOT = "$2"
# Placeholders of the comment URL template: $1 = post id, $2 = post mid.
COMMENT_POST_SLOT = "$1"
COMMENT_MID_SLOT = "$2"
# -----------------------------------------------------------------------------

# Neutral search endpoint used when the caller does not supply a template.
DEFAULT_SEARCH_TEMPLATE = "https://search.example.org/api/search?q=$1&page=$2"
# Neutral comment endpoint, likewise.
DEFAULT_COMMENT_TEMPLATE = "https://search.example.org/api/comments?id=$1&mid=$2"

"""Values that results depend on. They are data, not logic."""

# --- fixed values: column names looked for in raw feeds, first hit in list order wins ---
TEXT_COLUMNS = ["text", "content", "body", "full_text", "tweet", "comment"]
TIME_COLUMNS = ["created_at", "created_utc", "date", "timestamp", "time", "datetime", "created"]
ID_COLUMNS = ["id", "tweet_id", "comment_id", "id_str"]
LABEL_COLUMNS = ["sentiment_label", "label", "sentiment"]
SCORE_COLUMNS = ["sentiment_score"]
COMMUNITY_COLUMNS = ["subreddit", "subreddit_name_prefixed"]

# --- fixed values: text patterns and limits ---
URL_PATTERN = r"https?://\S+|www\.\S+"
MENTION_PATTERN = r"@\w+"
HASHTAG_PATTERN = r"#(\w+)"
COMMUNITY_PREFIX = "^r/"
WEEKDAY_PREFIX = r"^[A-Za-z]{3}\s+"
FEED_TIME_FORMAT = "MMM dd HH:mm:ss Z yyyy"
PUBLISHED_TEXT_LIMIT = 1000     # the published pipeline reads no more of a text; ours only when asked to
MIN_CLEAN_LENGTH = 3
MIN_KEYWORD_LENGTH = 4
MIN_HASHTAG_LENGTH = 3
BLANK_TEXTS = ["[deleted]", "[removed]", ""]

# --- fixed values: epoch units, a number above the limit is in the finer unit ---
EPOCH_UNITS = [(1e17, 1e9), (1e14, 1e6), (1e11, 1e3)]

# --- fixed values: class thresholds, minimum counts, trend settings ---
POSITIVE_FROM = 0.05
NEGATIVE_TO = -0.05
CLASSES = ["positive", "neutral", "negative"]
MIN_KEYWORD_COUNT = 10
MIN_HASHTAG_COUNT = 5
PARTIAL_MONTH_SHARE = 0.3
MIN_LIFT = 1.5
TEMPLATE_MONTH_SHARE = 0.01

# --- fixed values: load slices, experiment fractions, file and growth limits ---
LOAD_SLICES = [(0.0, 0.25), (0.25, 0.50), (0.50, 1.00)]
WARM_UP_FRACTION = 0.05
RUN_FRACTIONS = [0.25, 0.5, 1.0]
ROWS_PER_FILE = 50_000
SUB_LINEAR_BELOW = 3.6
LINEAR_BELOW = 4.4

# --- fixed values: keys a stream message must carry ---
REQUIRED_KEYS = ["post_id", "source", "text", "created_ts"]

# --- fixed values: words that never count as keywords ---
STOPWORDS = """a about above after again all also am an and any are as at be because been before being below
between both but by can could did do does doing down during each few for from further get got had has have having
he her here hers him his how i if in into is it its just like me more most my no nor not now of off on once only or
other our out over own same she should so some such than that the their them then there these they this those
through to too under until up us very was we were what when where which while who whom why will with would you your
yours amp rt via im dont thats cant didnt isnt youre ive one new people really going want know think make time
today https http com www co""".split()

"""Word lists, rule tables and constants that results depend on. Do not change."""

# Words dropped by the tokenizer.
STOPWORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don", "should", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "couldn", "didn", "doesn", "hadn", "hasn", "haven", "isn",
    "ma", "mightn", "mustn", "needn", "shan", "shouldn", "wasn", "weren", "won", "wouldn", "im", "ive", "id",
    "youre", "youve", "youd", "hes", "shes", "theyre", "theyve", "theyd", "weve", "wed", "would", "could", "u",
    "ur", "rt", "dm", "fb", "tw", "twt", "lol", "haha", "omg", "wtf", "btw", "idk", "imo", "tbh", "afaik", "fyi",
    "smh", "tbf", "ngl", "ikr",
]

# Suffix rules of the light stemmer, first match wins.
SUFFIX_RULES = (
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("alism", "al"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("ies", "y"),
    ("ness", ""),
    ("ment", ""),
    ("ing", ""),
    ("ed", ""),
    ("ly", ""),
    ("er", ""),
    ("est", ""),
)

# Token lexicon, one point per occurrence.
TOKEN_LEXICON = {
    "love": 1, "amazing": 1, "great": 1, "awesome": 1, "excellent": 1,
    "happy": 1, "best": 1, "beautiful": 1, "wonderful": 1, "fantastic": 1,
    "hate": -1, "terrible": -1, "worst": -1, "awful": -1, "horrible": -1,
    "sad": -1, "angry": -1, "bad": -1, "ugly": -1, "disappointing": -1,
}

# Substring lexicon of the stream scorer, one point per word contained.
STREAM_LEXICON = {
    "love": 1, "great": 1, "fascinating": 1, "perfect": 1, "quick": 1, "good": 1, "reliable": 1,
    "slow": -1, "bad": -1, "down": -1, "failing": -1, "why": -1,
}

# Words of the two heuristic predictors.
KEYWORDS = ("good", "love")
KEYWORD_CONFIDENCE = 0.89
CONFIDENCE_WORDS = ("love", "good", "great", "awesome", "happy", "nice", "cool")

# Lexicon for the invented prose of the test corpus.
CORPUS_LEXICON = {
    "trash": -1, "clown": -1, "idiot": -1, "scum": -1, "worthless": -1,
    "moron": -1, "pathetic": -1, "loser": -1, "disgusting": -1, "stupid": -1,
    "with": 1, "this": 1,
}

# Texts of generated messages.
MESSAGE_TEXTS = (
    "I love this new spark pipeline! #bigdata",
    "Hadoop is so slow today, but HDFS is reliable.",
    "Sentiment analysis with machine learning is fascinating.",
    "Bad weather today, feeling a bit down. :( ",
    "Just finished my big data project! Feeling great!",
    "Kafka is great for real-time streaming.",
    "MongoDB makes it easy to store flexible data.",
    "Why is my spark job failing again? #debugging",
    "Airflow is perfect for orchestration.",
    "FastAPI is so quick to build!",
)

# Sample posts of the token lexicon.
SAMPLE_POSTS = (
    "I love this amazing product",
    "This is the worst experience ever",
    "So happy with the great results",
    "Terrible service and awful support",
    "Amazing and fantastic day",
)

# Post origins and their sizes in the multi-source demonstration.
FEED_SOURCES = {
    "source_twitter": 400_000,
    "source_facebook": 350_000,
    "source_reddit": 250_000,
    "source_instagram": 300_000,
    "source_tiktok": 300_000,
}

# Class names, polarity codes, time formats.
POSITIVE, NEGATIVE, NEUTRAL = "Positive", "Negative", "Neutral"
POLARITY_POSITIVE, POLARITY_NEGATIVE = 4, 0
MESSAGE_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
POST_DATE_FORMAT = "MMM dd HH:mm:ss zzz yyyy"  # after the weekday, which Spark does not parse
RUN_ID_TIME_FORMAT = "yyyyMMdd_HHmmss"

# Class of each event type, for tables that hold events instead of posts.
EVENT_SENTIMENT = {
    "purchase": POSITIVE,
    "signup": POSITIVE,
    "error": NEGATIVE,
    "view": NEUTRAL,
    "click": NEUTRAL,
}

# Model settings.
SEED = 42
TRAIN_PERCENT = 80
HASH_BUCKETS = 50_000
HASH_BUCKETS_LIGHT = 10_000
MIN_DOC_FREQ = 5
WORD2VEC_SIZE = 100
WORD2VEC_MIN_COUNT = 5
BIGRAM_VOCABULARY = 20_000
BIGRAM_MIN_DOCS = 5
CV_FOLDS = 2

# Fixed value: the name under which metadata is published.
PIPELINE = "Layer 3 - Machine Learning"

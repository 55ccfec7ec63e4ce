"""Class names, label mapping, request limits, report metrics."""

# The three sentiment classes.
CLASS_NAMES = {0: "negative", 1: "neutral", 2: "positive"}
CLASS_IDS = tuple(CLASS_NAMES)

# Six raw emotions
# (sadness, joy, love, anger, fear, surprise) onto the three classes.
RAW_LABEL_MAPPING = {0: 0, 1: 2, 2: 2, 3: 0, 4: 0, 5: 1}

# Column names that may hold the keyphrases, first present one wins.
KEYPHRASE_COLUMNS = ("extractive_keyphrases", "keyphrases", "keywords")

# Splits and the shares used when a split has to be assigned.
SPLITS = ("train", "val", "test")
SPLIT_WEIGHTS = {"train": 80, "val": 10, "test": 10}

# Seed, sequence lengths, label of a padded position.
SEED = 42
MAX_TEXT_LEN = 128
MAX_DOCUMENT_LEN = 512
MAX_TARGET_LEN = 64
PAD_ID = 0
UNKNOWN_ID = 1
IGNORED_LABEL = -100

# Request limits.
MAX_CHARS = {"sentiment": 512, "keyword": 2048}
MIN_KEYWORDS, MAX_KEYWORDS, DEFAULT_KEYWORDS = 1, 20, 10
PREVIEW_CHARS = 200

# Metrics compared between two runs, by task.
COMPARED_METRICS = {
    "sentiment": (
        "accuracy",
        "f1_macro",
        "precision",
        "recall",
        "f1_positive",
        "f1_neutral",
        "f1_negative",
        "mean_latency_ms",
    ),
    "keyword": ("rouge1", "rouge2", "rougeL", "mean_latency_ms"),
}

# Published targets as (task, metric, direction, limit).
TARGETS = (
    ("sentiment", "accuracy", ">", 0.85),
    ("sentiment", "f1_macro", ">", 0.83),
    ("sentiment", "mean_latency_ms", "<", 50.0),
    ("keyword", "rouge1", ">", 0.35),
    ("keyword", "rougeL", ">", 0.28),
    ("keyword", "mean_latency_ms", "<", 200.0),
)

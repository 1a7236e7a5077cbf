"""Settings and fixed values."""

from __future__ import annotations

from dataclasses import asdict, dataclass

# ---------------------------------------------------------------------------
# Names, tokens and defaults that results depend on.
# ---------------------------------------------------------------------------

CORPUS_FILE = "fake_news.csv"
REPORT_NAME = "preprocessing_report.json"
METRICS_NAME = "metrics.json"
# Names under which models appear in summaries and results, by their kind.
LINEAR_MODEL = "TFIDF+LogReg"
SEQUENCE_MODELS = {"rnn_family": "RNN", "transformer": "HFTransformer"}
# Field that says where a sequence model was loaded from, by its kind.
MODEL_PATH_FIELDS = {"rnn_family": "model_file", "transformer": "model_load_dir"}
SEQUENCE_LENGTHS = {"rnn_family": 500, "transformer": 512}
SPLITS = ("train", "val", "test")
BINARY_LABELS = (0, 1)

# Strings a CSV reader with NA detection turns into a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Characters that separate words when sequences are tokenised (the apostrophe
# is not one of them).
SEQUENCE_SEPARATORS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~\t\n"
PADDING_ID = 0
OOV_ID = 1
OOV_TOKEN = "<OOV>"

DEFAULT_THRESHOLD = 0.5
SWEEP_START = 0.1
SWEEP_STEP = 0.01
SWEEP_COUNT = 81

# The setting names appear in reports and summaries, and the
# defaults decide published results.


@dataclass(frozen=True)
class PrepConfig:
    """Switches of the preparation job; the defaults are the published ones."""

    lowercase: bool = True
    normalize_unicode: bool = True
    remove_urls: bool = True
    remove_emails: bool = True
    remove_mentions: bool = True
    remove_html: bool = True
    remove_non_alnum: bool = True
    keep_sentence_punctuation: bool = True
    min_text_length: int = 5
    deduplicate_by_clean_text: bool = True
    drop_conflicting_duplicates: bool = True
    random_state: int = 42
    test_size: float = 0.2
    val_size_from_train: float = 0.1

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class TfidfConfig:
    """Settings of the TF-IDF features and the linear classifier."""

    ngram_min: int = 1
    ngram_max: int = 3
    max_features: int = 120_000
    min_df: int = 2
    max_df: float = 0.95
    c: float = 1.0
    max_iter: int = 400
    tol: float = 1e-7
    threshold: float = DEFAULT_THRESHOLD


@dataclass(frozen=True)
class SequenceConfig:
    """Settings of the padded token sequences."""

    vocab_size: int = 12_000
    max_len: int = 500
    truncate_strategy: str = "head_tail"

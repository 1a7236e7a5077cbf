"""Text cleaning.

Each step is a plain column expression. ``with_clean_text`` chains them as
separate projections, because every guarded step uses its input several times
and one nested expression would grow exponentially.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textprep.config import PrepConfig

# ---------------------------------------------------------------------------
# What the cleaning rules match, written for java.util.regex with
# Unicode word characters and Unicode white space.
# ---------------------------------------------------------------------------
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
BOUNDARY = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
HTML = r"<[^>]+>"
URL = rf"(?iu)https?://[^{SPACE}]+|www\.[^{SPACE}]+"
EMAIL = rf"{BOUNDARY}[{WORD}.\-]++@[{WORD}.\-]+\.[{WORD}]+{BOUNDARY}"
MENTION = rf"(?<![{WORD}])@[A-Za-z0-9_]+"
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
PUNCTUATION = r".!?,'\-"
SPACES = rf"[{SPACE}]+"
NON_ASCII = r"[^\x00-\x7F]"

# A class of single Latin-1 characters is one table lookup per character in
# java.util.regex, several times faster than a union of ranges; hence the
# spelled-out sets here and in ``strip_symbols``.
_LATIN1_NFKC = "".join(
    f"\\x{i:02x}" for i in range(256) if unicodedata.normalize("NFKC", chr(i)) == chr(i)
)
NOT_PLAIN_LATIN1 = f"[^{_LATIN1_NFKC}]"

# A text without these is its own NFKC form: what is left are letters and
# punctuation that neither decompose nor combine.
NFKC_SUSPECT = (
    r"[^\x00-\x7F¡-§©«-®°±¶·»¿-ı"
    r"Ĵ-ľŁ-ňŊ-ž–—‘-„€]"
)


# What a Unicode form may change, with the character before it: a mark joins that. An
# ASCII character never joins what comes before it, so each run has a form of its own.
_RUN = re.compile(r"([\x00-\x7F]?[^\x00-\x7F]+)")


def _normalizer(form: str, drop_marks: bool):
    """An Arrow UDF applying a Unicode form; null rows (bypassed) cost nothing.

    Each batch is cut into runs at once, and a run is normalised once, however often
    and in however many texts it occurs.
    """

    def convert(run: str) -> str:
        out = unicodedata.normalize(form, run)
        return "".join(c for c in out if not unicodedata.combining(c)) if drop_marks else out

    def together(texts: list[str]) -> list[str]:
        # A separator that no text holds; it is ASCII, so no run begins before it.
        mark = next((c for c in map(chr, range(32)) if not any(c in t for t in texts)), None)
        if mark is None:
            return [convert(t) for t in texts]
        parts = _RUN.split(mark.join(texts))
        runs = set(parts[1::2])
        # The separator may stand at the front of a run and stays as it is.
        forms = dict(zip(runs, map(convert, runs)))
        parts[1::2] = map(forms.__getitem__, parts[1::2])
        return "".join(parts).split(mark)

    @F.arrow_udf("string")
    def normalize(texts: pa.Array) -> pa.Array:
        if texts.null_count == len(texts):
            return pa.nulls(len(texts), pa.string())
        found = iter(together(texts.drop_null().to_pylist()))
        return pa.array([next(found) if valid else None for valid in texts.is_valid().to_pylist()], pa.string())

    return normalize


def _bypass(text: Column, suspect: Column, udf) -> Column:
    # Spark calls a Python UDF for every row even under a condition, so rows
    # that need no work are sent to it as null.
    return F.coalesce(udf(F.when(suspect, text)), text)


def normalize_unicode(text: Column) -> Column:
    """NFKC."""
    return _bypass(
        text,
        text.rlike(NOT_PLAIN_LATIN1) & text.rlike(NFKC_SUSPECT),
        _normalizer("NFKC", False),
    )


def strip_accents(text: Column) -> Column:
    """NFKD without combining marks."""
    return _bypass(text, text.rlike(NON_ASCII), _normalizer("NFKD", True))


def strip_html(text: Column) -> Column:
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(text, HTML, " ")).otherwise(text)


def strip_urls(text: Column) -> Column:
    marks = ["://", "ww.", "WW.", "wW.", "Ww."]
    found = F.contains(text, F.lit(marks[0]))
    for mark in marks[1:]:
        found = found | F.contains(text, F.lit(mark))
    return F.when(found, F.regexp_replace(text, URL, " ")).otherwise(text)


def _with_at(text: Column, pattern: str) -> Column:
    replaced = F.regexp_replace(text, pattern, " ")
    return F.when(F.contains(text, F.lit("@")), replaced).otherwise(text)


def strip_emails(text: Column) -> Column:
    return _with_at(text, EMAIL)


def strip_mentions(text: Column) -> Column:
    return _with_at(text, MENTION)


def strip_symbols(text: Column, keep_punctuation: bool = True) -> Column:
    """Runs of other characters and white space become one space.

    The pattern skips a lone space, which needs no change: in prose that is
    most of the runs.
    """
    keep = LETTERS + (PUNCTUATION if keep_punctuation else "")
    return F.regexp_replace(text, f"[^{keep} ][^{keep}]*+| [^{keep}]++", " ")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def as_text(column: Column) -> Column:
    """Null becomes the empty string, anything else its string form."""
    return F.coalesce(column.cast("string"), F.lit(""))


def _steps(cfg: PrepConfig):
    if cfg.normalize_unicode:
        yield normalize_unicode
    if cfg.remove_html:
        yield strip_html
    if cfg.remove_urls:
        yield strip_urls
    if cfg.remove_emails:
        yield strip_emails
    if cfg.remove_mentions:
        yield strip_mentions
    if cfg.lowercase:
        yield F.lower
    if cfg.remove_non_alnum:
        yield lambda c: strip_symbols(c, cfg.keep_sentence_punctuation)
    else:
        yield collapse_spaces
    yield F.trim


def with_clean_text(
    df: DataFrame,
    cfg: PrepConfig = PrepConfig(),
    source: str = "text",
    target: str = "clean_text",
) -> DataFrame:
    """Add ``target``: the cleaned form of ``source``."""
    work = "_cleaning"
    out = df.withColumn(work, as_text(F.col(source)))
    for step in _steps(cfg):
        out = out.withColumn(work, step(F.col(work)))
    others = [c for c in df.columns if c != target]
    # The one-element explode keeps the optimizer from copying the whole chain
    # into any filter placed on the result, which would clean every text twice.
    return out.select(*others, F.explode(F.array(work)).alias(target))

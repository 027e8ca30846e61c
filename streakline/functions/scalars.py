"""Column helpers. All stay in built-in Spark expressions."""

from __future__ import annotations

import unicodedata
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def utc(column: Column) -> Column:
    """An instant (``timestamp``) as UTC wall-clock time, whatever the session zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(column), F.expr(EPOCH))


def parse_utc(text: Column) -> Column:
    """ISO-8601 text as UTC wall-clock time; text without an offset is taken as UTC."""
    has_zone = text.rlike(r"[T ]\S*(Z|[+-]\d{2}:?\d{2})$")
    return F.when(has_zone, utc(text.try_cast("timestamp"))).otherwise(text.try_cast("timestamp_ntz"))


def as_time(value: Column | datetime | date | str | None) -> Column:
    """A caller's point in time as a column; ``None`` means now (UTC)."""
    if value is None:
        return utc(F.current_timestamp())
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp_ntz")


def half_up_hundredths(total: Column, count: Column) -> Column:
    """``total / count`` in hundredths, rounded half up, in whole-number arithmetic.

    Both must be non-negative. NULL where ``count`` is 0. Keeping to integers
    makes the rounding the same on every engine.
    """
    parts = F.when(count > 0, count * 2).cast("bigint")
    doubled = total.cast("bigint") * 200 + count
    return F.call_function("div", doubled, parts)


def _folds() -> dict[str, str]:
    """Lower-case Latin letters that decompose to a plain one and marks, and a few without a decomposition."""
    latin = [chr(c) for c in (*range(0xDF, 0x250), *range(0x1E00, 0x1F00))]
    plain = {c: unicodedata.normalize("NFD", c)[0] for c in latin if c == c.lower()}
    return {c: p for c, p in plain.items() if "a" <= p <= "z"} | {"đ": "d", "ł": "l", "ø": "o", "ı": "i"}


FOLDS = _folds()
ACCENTED, PLAIN = "".join(FOLDS), "".join(FOLDS.values())

# Letters written as two.
TWO_LETTERS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}


def slugify(text: Column) -> Column:
    """Lower-case ASCII words joined by ``-``, as used for folder names.

    Marks are dropped from Latin letters. Letters of other scripts are written as the digits
    of their UTF-8 bytes, so that names in them stay apart.
    """
    plain = F.regexp_replace(F.translate(F.lower(text), ACCENTED, PLAIN), r"\p{M}+", "")
    for letter, letters in TWO_LETTERS.items():
        plain = F.replace(plain, F.lit(letter), F.lit(letters))
    # Blanks become + and other ASCII signs %xx in the encoding: only foreign words go through it.
    words = F.regexp_extract_all(plain, F.lit(r"([^\x00-\x7F]+|[\x00-\x7F]+)"), F.lit(1))
    spelled = F.transform(
        words, lambda w: F.when(w.rlike(r"[^\x00-\x7F]"), F.lower(F.replace(F.url_encode(w), F.lit("%"), F.lit("")))).otherwise(w)
    )
    return F.regexp_replace(F.regexp_replace(F.array_join(spelled, ""), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters and digits, lower-case the rest.

    ``initcap`` splits at blanks only; here every other character splits too.
    """
    words = F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"), F.lit(1))
    return F.array_join(F.transform(words, F.initcap), "")


def season_label(year: Column) -> Column:
    """2023 -> ``2023/24``."""
    return F.concat(year.cast("string"), F.lit("/"), F.substring((year + 1).cast("string"), -2, 2))


def run_stamp(moment: Column) -> Column:
    """The stamp put on snapshots: ``yyyyMMdd_HHmmss``."""
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def differs(left: Column, right: Column) -> Column:
    """SQL ``left != right`` with NULL read as "no difference"."""
    return F.coalesce(left != right, F.lit(False))

"""Text normalisation as column functions. Unicode normal forms and character references have no built-in, so these few run over Arrow batches."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerforge.functions.slices import sliced

SPACE = r"\s+"


@F.pandas_udf(StringType())
def _ascii(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode())


@F.pandas_udf(StringType())
def _unmarked(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    def one(s: str | None) -> str | None:
        if s is None or s.isascii():
            return s
        apart = unicodedata.normalize("NFD", s)
        return apart.translate({ord(c): None for c in set(apart) if unicodedata.category(c) == "Mn"})

    for x in sliced(batches):
        yield x.map(one)


@F.pandas_udf(StringType())
def _nfkc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFKC", s))


@F.pandas_udf(StringType())
def unescape_html(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else html.unescape(s))


def _dashed(x: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slug_ascii(x: Column) -> Column:
    """Letters that decompose keep their base; all else outside ASCII is deleted. May be empty."""
    return _dashed(_ascii(x))


def slug_marks(x: Column) -> Column:
    """Accents go; other letters outside ASCII part words. Never empty: 'unknown'."""
    made = _dashed(_unmarked(x))
    return F.when(made == "", F.lit("unknown")).otherwise(made)


def name_key(x: Column) -> Column:
    """Compatibility form, single spaces, no outer quotes, lower case; punctuation stays."""
    spaced = F.trim(F.regexp_replace(_nfkc(x), SPACE, " "))
    return F.lower(F.trim(F.regexp_replace(F.btrim(spaced, F.lit("'\"")), SPACE, " ")))


def alnum(x: Column) -> Column:
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def blank_to_null(x: Column) -> Column:
    return F.nullif(F.trim(x), F.lit(""))


def plain_text(x: Column, references: dict[str, str] | None = None) -> Column:
    """Without markup, references decoded; null if nothing is left.

    All references are decoded, as browsers do, also such as lack their semicolon. Given references, these alone are, in their order.
    """
    bare = F.regexp_replace(x, "<[^>]+>", "")
    if references is None:
        return blank_to_null(unescape_html(bare))
    for said, meant in references.items():
        bare = F.replace(bare, F.lit(said), F.lit(meant))
    return blank_to_null(bare)


def entity_id(manufacturer: Column, code: Column, name: Column) -> Column:
    return F.concat_ws("/", manufacturer, F.coalesce(code, slug_ascii(name)))


def joined_key(*parts: Column) -> Column:
    """Parts joined by |, nulls as empty: concat_ws alone would skip them."""
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def url_path(x: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(x, r"^[a-z]+://[^/?#]*([^?#]*)", 1), F.lit("")), F.lit("/"))


def last_segment(x: Column) -> Column:
    return F.substring_index(F.rtrim(url_path(x), F.lit("/")), "/", -1)


def hex_display(x: Column) -> Column:
    """'#rrggbb' in lower case; null if blank."""
    bare = F.lower(F.ltrim(F.trim(x), F.lit("#")))
    return F.when(bare != "", F.concat(F.lit("#"), bare))


def hex_channel(x: Column, k: int) -> Column:
    """Channel k (0..2) of 'rrggbb', with or without '#'; null if malformed."""
    bare = F.ltrim(F.trim(x), F.lit("#"))
    return F.when(bare.rlike("^[0-9a-fA-F]{6}$"), F.conv(F.substring(bare, 2 * k + 1, 2), 16, 10).cast("int"))


def code_dotted(x: Column) -> Column:
    """Five digits as NN.NNN."""
    return F.regexp_replace(x, r"^(\d{2})(\d{3})$", "$1.$2")


def without_fence(x: Column) -> Column:
    """The body of a fenced block, if the text is one."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(x), r"^```[a-zA-Z]*\s*", ""), r"\s*```$", ""))


def wildcard_pattern(x: Column) -> Column:
    """An anchored regular expression for a path rule with * and a final $."""
    quoted = F.regexp_replace(x, r"([.+?^(){}\[\]|\\])", r"\\$1")
    ends = F.endswith(x, F.lit("$"))
    body = F.regexp_replace(F.when(ends, F.substring(quoted, F.lit(1), F.length(quoted) - 1)).otherwise(quoted), r"\*", ".*")
    return F.concat(F.lit("^"), body, F.when(ends, F.lit("$")).otherwise(F.lit("")))


def halves_merged(x: Column) -> Column:
    """A text that says the same twice says it once."""
    half = F.floor(F.length(x) / 2).cast("int")
    left, right = F.trim(F.substring(x, F.lit(1), half)), F.trim(F.substring(x, half + 1, F.length(x)))
    odd = F.trim(F.substring(x, half + 2, F.length(x)))
    return F.when((half > 0) & (F.lower(left) == F.lower(right)), left).when((half > 0) & (F.length(x) % 2 == 1) & (F.lower(left) == F.lower(odd)), left).otherwise(x)


def version_of(date: Column) -> Column:
    return F.date_format(date, "yyyy.M.d")


def percent(part: Column, whole: Column) -> Column:
    """One decimal, halves to even, as text."""
    return F.format_number(100.0 * part / whole, 1)


def canonical_hash(*fields: Column) -> Column:
    """SHA-256 of a JSON object with keys in the given order, nulls left out."""
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def name_from_slug(x: Column) -> Column:
    """A slug's words with capitals: 'dark-red-2' is 'Dark Red 2'; null if it has none."""
    return blank_to_null(F.initcap(F.regexp_replace(x, "[-_]+", " ")))


def without_zeros(x: Column) -> Column:
    """A code without the zeros before it; of zeros alone one stays."""
    bare = F.ltrim(x, F.lit("0"))
    return F.when((bare == "") & (x != ""), F.lit("0")).otherwise(bare)


def without_tail(x: Column, letters: str) -> Column:
    """A code without the given letters at its end, as many as there are."""
    return F.rtrim(x, F.lit(letters))


def without_prefix(x: Column, prefix: str) -> Column:
    """A text without the prefix, once, if it has it."""
    return F.when(F.startswith(x, F.lit(prefix)), F.substring(x, len(prefix) + 1, 2**31 - 1)).otherwise(x)

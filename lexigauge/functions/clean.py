"""Text normalisation as column expressions."""

import pyarrow as pa
from pyspark.sql import Column, functions as F

from lexigauge.functions.exprs import let

# Whitespace as the union of what Unicode-aware regex engines call a space, plus U+FEFF.
_SPACE_BUT_BLANK = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
SPACE = rf"[ {_SPACE_BUT_BLANK}]"
NOT_SPACE = rf"[^ {_SPACE_BUT_BLANK}]"
# Runs to replace. A blank before a printable ASCII character is already in its final form, and
# looking at that first passes over ordinary words quickly.
_SPACE_RUN = rf"(?![!-~]| [!-~]){SPACE}+"

# Characters that NFKC keeps as they are in any sequence with one another and with ASCII: precomposed
# letters, punctuation and ideographs without a compatibility form. Texts made of these alone
# never leave the JVM. tests/test_clean.py checks every one against the Unicode tables.
NFKC_STABLE = (
    r"\x00-\x7f\u00c0-\u0131\u0134-\u013e\u0141-\u0148\u014a-\u017e"
    r"\u0400-\u0482\u048a-\u052f\u2010\u2012-\u2016\u2018-\u2023\u20ac"
    r"\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff"
)
_STABLE_TEXT = rf"\A(?:[\x00-\x7f]++|[{NFKC_STABLE}]++)*+\z"


def _nfkc_udf():
    # A nested function travels to the executors by value: no package has to be installed there.
    @F.arrow_udf("string")
    def nfkc(texts: pa.Array) -> pa.Array:
        from unicodedata import normalize

        # Not pyarrow's own utf8_normalize: it leaves some letter-and-accent pairs uncomposed.
        # Some texts at once: as Python strings a batch takes a multiple of its size.
        parts = (texts.slice(i, 256).to_pylist() for i in range(0, len(texts), 256))
        made = [pa.array([t if t is None else normalize("NFKC", t) for t in part], pa.string()) for part in parts]
        return pa.concat_arrays([pa.array([], pa.string()), *made])

    return nfkc


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition; only texts it might change go through Arrow."""
    stable = (F.length(text) == F.octet_length(text)) | text.rlike(_STABLE_TEXT)
    return F.coalesce(_nfkc_udf()(F.when(~stable, text)), text)


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def clean_text(raw: Column) -> Column:
    """NFKC, then every run of whitespace to one blank, no blanks at the ends. Null becomes empty."""
    return collapse_whitespace(nfkc(F.coalesce(raw, F.lit(""))))


def lower_without_emails(text: Column) -> Column:
    """Lower-case a cleaned text and blank out each word with an @ inside it."""
    # Anchored at the word start, so a long word without @ is passed once.
    return let(
        F.lower(text),
        lambda low: F.when(
            low.contains("@"), F.regexp_replace(low, "(?<![^ ])[^ ][^ @]*+@[^ ]+", " ")
        ).otherwise(low),
    )


def _mime_udf():
    @F.arrow_udf("string")
    def decode(values: pa.Array) -> pa.Array:
        from email.header import decode_header, make_header

        def one(value):
            try:
                return str(make_header(decode_header(value)))
            except Exception:  # a broken header stays as it was written
                return value

        parts = (values.slice(i, 256).to_pylist() for i in range(0, len(values), 256))
        made = [pa.array([v if v is None else one(v) for v in part], pa.string()) for part in parts]
        return pa.concat_arrays([pa.array([], pa.string()), *made])

    return decode


def decode_subject(subject: Column) -> Column:
    """Decode MIME encoded-words; subjects without one stay in the JVM. Null becomes empty."""
    encoded = F.when(subject.contains("=?"), subject)
    return F.coalesce(_mime_udf()(encoded), subject, F.lit(""))

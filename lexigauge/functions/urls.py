"""URLs in a cleaned, lower-cased text, in time linear in its length.

A URL is a scheme with what follows up to a blank, or a host with a known ending, and a path up to a blank behind it. A pattern for
hosts that may start anywhere tries every label of "a.a.a.a" anew, so hosts are not searched by one pattern. A word is cut once into
runs of host characters; a run holds a host if a known ending follows some label in it, which its last known ending decides; whatever
stands behind that ending in the run has none. A path, or a scheme, takes the rest of the word.
"""

from pyspark.sql import Column, functions as F

from lexigauge.config import URL_TLDS
from lexigauge.functions.exprs import let

_TLD = "|".join(URL_TLDS)
_CANDIDATE = rf"://|\.(?:{_TLD})"
# A run of host characters with the character before and behind it where that is an underscore (which makes word and edge), a
# slash, or with the rest of a scheme that something follows. Underscores are doubled first, so that each stands at one run only.
_RUN = r"(?s)_?+[a-z0-9.-]++(?:_|/|://(?=.))?+"
# What stands before the last known ending of a run.
_HOST = rf"^(.*)\.(?:{_TLD})(?![a-z0-9_])"
# Where a host may start in that: at an edge between word characters (ASCII letters, digits, underscore) and others.
_START = r"^[.-]*+[a-z0-9]|^_-|[a-z0-9]-|[.-][a-z0-9]"
_PATH, _SCHEME = rf"\.(?:{_TLD})/\z", r"https?://\z"


def _in_run(run: Column) -> Column:
    """1: a host, 2: a scheme, 4: the host has a path."""
    host = F.when(F.regexp_extract(run, _HOST, 1).rlike(_START), F.when(run.rlike(_PATH), F.lit(5)).otherwise(F.lit(1))).otherwise(F.lit(0))
    return host + F.when(run.rlike(_SCHEME), F.lit(2)).otherwise(F.lit(0))


def _in_word(word: Column) -> Column:
    # Labels must not be empty: a control character between neighbouring dots ends the run.
    cut = F.replace(F.regexp_replace(word, r"\.(?=\.)", ".\u0001"), F.lit("_"), F.lit("__"))
    runs = F.transform(F.regexp_extract_all(cut, F.lit(_RUN), F.lit(0)), _in_run)

    def counted(kinds: Column) -> Column:
        rest = F.array_position(F.transform(kinds, lambda k: k >= 2), F.lit(True)).cast("int")
        kept = F.slice(kinds, F.lit(1), F.when(rest > 0, rest).otherwise(F.size(kinds)))
        return F.aggregate(kept, F.lit(0), lambda n, k: n + k.bitwiseAND(1) + F.shiftright(k, 1).bitwiseAND(1))

    return let(runs, counted)


def url_count(low: Column) -> Column:
    """Number of URLs; only words with a scheme or a known ending are cut."""
    words = F.filter(F.split(low, " "), lambda w: w.rlike(_CANDIDATE))
    found = F.aggregate(F.transform(words, _in_word), F.lit(0), lambda n, k: n + k)
    return F.when(low.rlike(_CANDIDATE), found).otherwise(F.lit(0))


def has_url(low: Column) -> Column:
    return url_count(low) > 0

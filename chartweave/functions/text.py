"""Text rules for song and artist cells, as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: accented letters and their replacements, one to one
ACCENTED = "áàâäãåéèêëíìîïóòôöõúùûüýÿñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÝŸÑÇ"
PLAIN = "aaaaaaeeeeiiiiooooouuuuyyncAAAAAAEEEEIIIIOOOOOUUUUYYNC"
# fixed value: characters that are deleted; apostrophes and curly quotes stay
DELETED = r'[\[\]{}()"«»‚„]+'
# fixed values: kinds of remarks in brackets that are dropped from titles
REMARKS = ("remix", r"radio\s+edit", "live", "acoustic", "instrumental")
# fixed value: words that mark a cell as chart furniture
FURNITURE = "chart|total|points|sales|streams|airplay|week"

# fixed value: words that begin the guests of a credit
GUEST = r"(?iU)\b(feat\.?|featuring|ft\.?)\b"

SPACE = r"(?U)\s+"


def blank(c: Column) -> Column:
    """Null, empty or white only."""
    return c.isNull() | (F.length(strip(c)) == 0)


def strip(c: Column) -> Column:
    """Without white space of any script at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def normalize_text(c: Column) -> Column:
    """Lower case without accents, leading '=' and brackets; single spaces; '' for null."""
    t = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), "^=+", "")
    t = F.lower(F.translate(t, ACCENTED, PLAIN))
    return strip(F.regexp_replace(F.regexp_replace(t, DELETED, ""), SPACE, " "))


def normalize_credit(c: Column) -> Column:
    """Guests as 'feat.', '&' between spaces as 'and', remarks in brackets dropped; null stays null.

    Not idempotent: an existing 'feat.' keeps its dot beside the new one ('feat..').
    """
    t = F.regexp_replace(c, GUEST, "feat.")
    t = F.regexp_replace(t, r"(?U)\s+&\s+", " and ")
    for kind in REMARKS:
        t = F.regexp_replace(t, rf"(?iU)\s*\([^)]*{kind}[^)]*\)", "")
    return strip(F.regexp_replace(t, SPACE, " "))


def split_change(text: Column, change: Column) -> tuple[Column, Column]:
    """(text, change): a number at the start of the text moves to a blank change."""
    t = strip(text)
    number = F.regexp_extract(t, r"(?sU)^([+-]?\d+)\s+(.+)$", 1)
    rest = F.regexp_extract(t, r"(?sU)^([+-]?\d+)\s+(.+)$", 2)
    value = number.try_cast("bigint")
    moves = blank(change) & (F.length(number) > 0) & value.isNotNull()
    signed = F.when(value > 0, F.concat(F.lit("+"), value.cast("string"))).otherwise(value.cast("string"))
    kept = F.when(blank(change) & (F.length(text) > 0), t).otherwise(text)
    return F.when(moves, strip(rest)).otherwise(kept), F.when(moves, signed).otherwise(change)


def search_text(c: Column) -> Column:
    """Text for a search query: guests cut, brackets dropped, special characters escaped."""
    t = F.regexp_replace(strip(F.coalesce(c, F.lit(""))), r"(?iU)\b(feat\.?|featuring|ft\.?)\s+.*$", "")
    t = F.regexp_replace(t, r"(?U)\s*\([^)]*\)\s*", " ")
    t = F.regexp_replace(t, r"(?U)\s*\[[^\]]*\]\s*", " ")
    t = strip(F.regexp_replace(t, SPACE, " "))
    return F.regexp_replace(t, r'([+\-&|!(){}\[\]^"~*?:\\])', r"\\$1")


def comparison_text(c: Column) -> Column:
    """Text for comparing: guests cut, brackets and punctuation dropped."""
    t = F.regexp_replace(c, r"(?iU)\b(feat\.?|featuring|ft\.?)\s+.*$", "")
    t = F.regexp_replace(F.regexp_replace(t, r"(?U)\s*\([^)]*\)", ""), r"(?U)\s*\[[^\]]*\]", "")
    t = F.regexp_replace(t, r"(?U)[^\w\s]", "")
    return strip(F.regexp_replace(t, SPACE, " "))


def credit_text(credit: Column) -> Column:
    """Names of an array of struct<artist struct<name>, literal>, joined with ', ', empty ones left out."""
    names = F.transform(credit, lambda x: F.coalesce(x["artist"]["name"], x["literal"]))
    return F.array_join(F.filter(names, lambda n: n.isNotNull() & (F.length(n) > 0)), ", ")


def valid_pair(song: Column, artist: Column) -> Column:
    """Neither part null nor blank."""
    return ~blank(song) & ~blank(artist)


def likely_song(song: Column, artist: Column) -> Column:
    """Neither part holds a furniture word, is shorter than two characters or only digits."""
    ok = F.lit(True)
    for c in (song, artist):
        t = strip(F.lower(c))
        ok = ok & ~F.lower(c).rlike(FURNITURE) & (F.length(t) >= 2) & ~t.rlike(r"(?U)^\d+$")
    return ok

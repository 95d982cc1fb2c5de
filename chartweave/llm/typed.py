"""Reading text that people typed: folding, edit distance, nicknames and abbreviations."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache


def _folding() -> tuple[str, str]:
    """Accented Latin letters and what they fold to, by Unicode decomposition; some that don't decompose by hand."""
    pairs = {c: d[0] for c in map(chr, range(0xC0, 0x250)) if len(d := unicodedata.normalize("NFKD", c)) > 1 and d[0].isascii() and d[0].isalpha()}
    pairs |= dict(zip("øØłŁđĐıħŧ", "oOlLdDiht"))
    return "".join(pairs), "".join(pairs.values())


FROM, TO = _folding()
_TABLE = str.maketrans(FROM, TO)


def fold_text(s: str) -> str:
    """Lower case without accents; 'ß' as 'ss', combining marks dropped."""
    if s.isascii():
        return s.lower()
    t = "".join(c for c in s.translate(_TABLE) if not unicodedata.combining(c))
    return t.lower().replace("ß", "ss")


@lru_cache(200_000)
def edits(a: str, b: str, most: int = 4) -> int:
    """Edit distance with swaps of neighbours as one edit; any number above `most` may stand for more."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    # only a band around the diagonal can hold `most` edits or less
    far, n = most + 1, len(b)
    before: list[int] = []
    row = [j if j <= most else far for j in range(n + 1)]
    for i, x in enumerate(a, 1):
        first, last = max(1, i - most), min(n, i + most)
        new = [far] * (n + 1)
        if i <= most:
            new[0] = i
        least = new[0]
        for j in range(first, last + 1):
            d = row[j - 1] + (x != b[j - 1])
            if row[j] < d - 1:
                d = row[j] + 1
            if new[j - 1] < d - 1:
                d = new[j - 1] + 1
            if before and j > 1 and x == b[j - 2] and a[i - 2] == b[j - 1] and before[j - 2] < d - 1:
                d = before[j - 2] + 1
            new[j] = d
            if d < least:
                least = d
        if least > most:
            return far
        before, row = row, new
    return row[n]


VOWELS = re.compile(r"[aeiou]")


def skeleton(s: str) -> str:
    """The consonants of a folded text."""
    return VOWELS.sub("", s)


#: Given name -> short forms people type for it.
SHORT_FORMS = {
    "abigail": "abby abbie gail", "alexander": "alex al sandy xander", "andrew": "andy drew", "anthony": "tony ant", "benjamin": "ben benji benny", "catherine": "kate cathy katie cat",
    "charles": "charlie chuck chas chaz", "christopher": "chris kit topher", "daniel": "dan danny", "deborah": "deb debbie debby", "edward": "ed eddie ted ned", "elizabeth": "liz beth betty eliza lizzie betsy libby",
    "frederick": "fred freddie freddy", "gabriel": "gabe", "gregory": "greg", "isabella": "bella izzy", "jacob": "jake", "james": "jim jimmy jamie", "jennifer": "jen jenny", "jessica": "jess jessie", "john": "jack johnny",
    "jonathan": "jon jonny", "joseph": "joe joey", "josephine": "jo josie", "joshua": "josh", "katherine": "kate kathy katie kat kit", "kenneth": "ken kenny", "lawrence": "larry laurie", "leonard": "len lenny leo", "margaret": "maggie meg peggy marge greta",
    "matthew": "matt matty", "michael": "mike mick mickey", "nathaniel": "nate nat nathan", "nicholas": "nick nicky", "pamela": "pam", "patricia": "pat patty trish tricia", "patrick": "pat paddy", "peter": "pete", "philip": "phil",
    "raymond": "ray", "rebecca": "becky becca", "richard": "rick dick rich ricky", "robert": "bob rob bobby robbie bert", "ronald": "ron ronnie", "samuel": "sam sammy", "stephen": "steve", "steven": "steve", "susan": "sue susie suzy",
    "theodore": "ted theo teddy", "thomas": "tom tommy", "timothy": "tim timmy", "victoria": "vicky tori vic", "vincent": "vince vinny", "walter": "walt wally", "william": "bill will billy willy liam", "zachary": "zach zack zac",
}
FULL_FORMS: dict[str, frozenset[str]] = {}
for _full, _shorts in SHORT_FORMS.items():
    for _s in [_full, *_shorts.split()]:
        FULL_FORMS[_s] = FULL_FORMS.get(_s, frozenset()) | {_full}
#: Any form of a given name -> all names of the same family of forms.
FAMILY = {f: frozenset(x for full in fulls for x in [full, *SHORT_FORMS[full].split()]) for f, fulls in FULL_FORMS.items()}
#: Kinds of groups -> abbreviations.
KINDS = {
    "association": "assn assoc ass'n", "quartet": "qrt qt quart", "orchestra": "orch orchest", "collective": "coll collect", "street band": "st. band|st band", "incorporated": "inc incorp", "company": "co comp", "choir": "chr ch",
    "sound system": "s.s.|ss|s s", "brothers": "bros bro", "ensemble": "ens ensem", "philharmonic": "phil philh", "trio": "", "quintet": "qnt", "band": "bd", "sisters": "sis", "orchestre": "",
}

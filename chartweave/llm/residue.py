"""Template residue, filler, error pages and script notices standing where a notebook's own words should be."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartweave.session import cut

#: An unfilled field, alone or after a label, as a whole line.
PLACEHOLDER = "|".join(
    [
        r"\{\{[^{}`\n]{1,80}\}\}", r"\$\{[^{}`\n]{1,80}\}", r"#\{[^{}`\n]{1,80}\}", r"\{%[^%\n]{1,80}%\}(?:\s*\{%[^%\n]{1,80}%\})*",
        r"\[\[[^\[\]\n]{1,80}\]\]", r"<<[^<>\n]{1,80}>>", r"<%=?[^<>\n]{1,80}%>", r"［[^］\n]{1,80}］", r"【[^】\n]{1,80}】",
        r"<(?:your|insert|enter|add|type|choose|à compléter|à remplir|hier|aquí|укажите|введите)\b[^<>\n]{0,80}>",
        r"\[(?:insert|enter|add|type|your|choose|fill in|escriba|inserte|insérez|indiquez|insira|digite|введите|вставьте|укажите|hier)\b[^\[\]\n]{0,80}\]",
        r"\[[^\[\]\n]{1,80}\b(?:goes here|go here|einfügen|eintragen|here|aquí|aqui|ici|сюда|здесь)\]",
        r"%%[A-Za-z_]{2,60}%%", r"@@[A-Za-z_ ]{2,60}@@", r"__[A-Z][A-Z_]{1,60}__", r"\$[a-z][a-z_]{2,60}\$",
        r"X{3,} [^\n]{1,80} X{3,}", r"(?:TBD|TODO): add [^\n.]{1,80}\.?", r"(?:Replace|Change) this text with [^\n.]{1,80}\.?", r"Click here to (?:edit|add) [^\n]{1,80}",
    ]
)
MARKS = r"[#>*_\s\-]*"
LINE = re.compile(rf"^{MARKS}(?:By|Von|Por|Par|[^\W\d_]{{2,20}}(?: [^\W\d_]{{1,15}})?\s?:)?{MARKS}(?:{PLACEHOLDER})(?:[\s,;/&–-]*(?:{PLACEHOLDER}))*[*_\s.!]*$", re.M | re.I)
#: Words of the pseudo-Latin filler; a cell of mostly these is filler.
LATIN = frozenset(
    "ad adipiscing aliqua aliquam aliquip amet anim aute cillum commodo consectetur consequat culpa cupidatat deserunt do dolor dolore duis ea eiusmod elit enim esse est et eu ex excepteur exercitation fugiat id in incididunt ipsum irure labore laboris laborum lorem magna minim mollit nisi non nostrud nulla occaecat officia pariatur proident qui quis reprehenderit sed sint sit sunt tempor ullamco ut velit veniam voluptate".split()
)
MASH = re.compile(r"(?:asdf|fdsa|qwert?y?|rewq|zxcv|vcxz|h?jkl|lkjh?|uiop|poiu|ghjk|dfgh|xcvb|sdfg){1,40}", re.I)
FILLER = re.compile(
    r"blindtext|dummy text|\btext goes here|placeholder (?:copy|text)|sample (?:paragraph|text)|body copy|lorem ipsum|filler text|texte? d'exemple|faux[- ]texte|aquí va (?:el|un) texto|texto de (?:relleno|ejemplo|exemplo)|hier (?:steht|kommt)(?: später)?(?: der| ein)? text|ここに文章が入ります|ダミーテキスト|здесь будет текст|текст[- ]заполнитель|此处(?:填写|为)?文字|占位文字|aqui vai o texto",
    re.I,
)
ERROR = re.compile(
    r"could not be found|not be found on this server|(?:was|were|been) (?:moved|deleted|removed)\b.*(?:moved|deleted|removed)|moved or deleted|(?:not have|no) permission to|rate limit (?:reached|exceeded)|session has expired|sign in again|"
    r"could ?not (?:render|load|open|display)|did not (?:answer|respond) in time|down for maintenance|under maintenance|temporarily unavailable|try again (?:in a|later|soon)|go back to the (?:start|home|front)|has been (?:told|notified)|"
    r"if you think this is a (?:mistake|bug)|contact the (?:owner|administrator)|verschoben oder gelöscht|existiert nicht|ya no existe|n'existe plus|não existe mais|больше не существует|不存在|存在しません|^\W*request id",
    re.I,
)
SCRIPT = re.compile(
    r"(?:enable|turn on|activate|aktivieren|aktiviere|activer|activez|active|active|activar|habilit\w*|ative|включите)\b[^.\n]{0,40}\b(?:java ?)?scripts?\b|turn scripts on|(?:java ?)?scripts? (?:is|are|must|has to)\b[^.\n]{0,30}\b(?:disabled|blocked|off|enabled|required)|requires (?:java ?)?scripts?|does not (?:run|support) (?:java ?)?scripts?|checking your browser|needs script support|javascript を有効|启用 ?javascript",
    re.I,
)
TITLE = re.compile(
    r"[#*\s]*(?:(?:error|fehler|erreur)?[\s:]*[45]\d\d(?:[\s:–-]+[a-z][a-z '’]{2,40})?|(?:page|file|notebook) (?:not found|unavailable)|not found|bad gateway|service unavailable|forbidden|access denied|too many requests|internal server error|gateway time-?out|page introuvable|seite nicht gefunden|página no encontrada|página não encontrada|страница не найдена|ページが見つかりません|找不到页面|sorry, something went wrong)[.!\s]*",
    re.I,
)
WEAK_TITLE = re.compile(r"[#*\s]*(?:error|oops|fehler|erreur|sorry|warning|notice|unavailable|attention)[.!\s]*", re.I)
CUE = re.compile(rf"{FILLER.pattern}|{ERROR.pattern}|{SCRIPT.pattern}", re.I)
#: Words up to which a page or cell in any wording may be a low-information response.
SHORT = 60
#: How often residue, in contrast to own words, shares no term with its surroundings, and how much likelier hosts together must make it.
FOREIGN, ODDS = 0.95, 1000.0
TERM = re.compile(r"[^\W\d_]{4,}|[^\x00-\x7f\W\d_]{2,}")
PROMPT = re.compile(r"(?m)^(?:In|Out) ?\[[ \d*]*\]:")
TRACE = re.compile(r"^\w*(?:Error|Exception|Warning)\b.*:", re.S)
FENCE = re.compile(r"(?ms)^```.*?^```|^~~~.*?^~~~")
TAG = re.compile(r"<(?:!--.*?--|/?[a-zA-Z][^<>]*)>", re.S)
SENTENCE = re.compile(r"(?<=[.!?。！？])[ \t]+|\n+")


def text_cells(text: str) -> list[str]:
    """The text cells of a notebook in any of the three export styles; a text that is no notebook is one cell."""
    head = text.lstrip()[:200]
    if head.startswith("{") and '"cells"' in text:  # metadata may come first
        try:
            cells = json.loads(text)["cells"]
            return ["".join(c.get("source") or "") for c in cells if c.get("cell_type") != "code"]
        except (ValueError, TypeError, KeyError, AttributeError):
            return [text]
    if head.startswith("# %%") or "\n# %%" in text:
        parts = re.split(r"(?m)^# %%", text)
        out = [parts[0]] if parts[0].strip() else []
        for p in parts[1:]:
            mark, _, body = p.partition("\n")
            if "[markdown]" in mark or "[md]" in mark or "[raw]" in mark:
                out.append(body)
        return out
    if PROMPT.search(text):
        return [p for p in re.split(r"\n[ \t]*\n", text) if not PROMPT.match(p.lstrip("\n")) and not TRACE.match(p)]
    return [text]


@lru_cache(100_000)
def _short_kind(word: str) -> str:
    w = word.strip(".,;:!?")
    return "latin" if w.lower() in LATIN else "mash" if MASH.fullmatch(w) else ""


def _word_kind(word: str) -> str:
    """'latin' for a word of the pseudo-Latin filler, 'mash' for keyboard mash, else ''."""
    return _short_kind(word) if len(word) <= 40 else _short_kind.__wrapped__(word)


def judge_cell(cell: str, page: bool) -> str | None:
    """'placeholder', 'filler', 'error' or 'script' if such residue stands as the cell's content, 'weak' if only its form hints at it.

    page: the cell is a whole text that is no notebook.
    """
    markup = page and "<" in cell and TAG.search(cell) is not None
    if markup:
        cell = html.unescape(TAG.sub("\n", cell))
    elif "```" in cell or "~~~" in cell:
        cell = FENCE.sub("", cell)
    if LINE.search(cell):
        return "placeholder"
    words = cell.split()
    if not words:
        return None
    # over all words: residue may stand behind any number of own words
    kinds = [_word_kind(w) for w in words]
    latin, mash = kinds.count("latin"), kinds.count("mash")
    if (latin >= 5 or mash >= 2 and len(words) >= 3) and latin + mash >= 0.5 * len(words):
        return "filler"
    title = False
    weak = WEAK_TITLE.fullmatch(cell.strip().split("\n", 1)[0]) is not None
    if not CUE.search(cell):
        lines = [x for x in cell.split("\n") if x.strip()]
        if lines and all(TITLE.fullmatch(x) for x in lines):
            return "error"
        return "weak" if markup or weak or lines and TITLE.fullmatch(lines[0]) else None
    share = {"filler": 0, "error": 0, "script": 0, "own": 0}
    for s in SENTENCE.split(cell.strip("{} \n") if page and cell.lstrip().startswith("{") else cell):
        s = s.strip()
        n = len(s)
        if not n:
            continue
        if TITLE.fullmatch(s) or WEAK_TITLE.fullmatch(s):
            title = True
        elif SCRIPT.search(s):
            share["script"] += n
        elif ERROR.search(s):
            share["error"] += n
        elif FILLER.search(s) and (n < 60 or len(FILLER.sub("", s)) < n / 2):
            share["filler"] += n
        elif len(s.split()) > 3 or n > 40:
            share["own"] += n
    kind = max(("filler", "error", "script"), key=share.__getitem__)
    if share[kind] and share["filler"] + share["error"] + share["script"] >= share["own"]:
        return kind
    return "weak" if title or markup else None


def _terms(text: str) -> list[str]:
    return list(dict.fromkeys(TERM.findall(text.lower())))


def is_foreign(cell: str, slug: str, text: str) -> bool:
    """Whether no term of the cell occurs in the address slug or in the rest of the text, its titles and body; both in lower case."""
    own = cell.lower()
    return not any(t in slug or text.count(t) > own.count(t) for t in _terms(own))


def says_little(cell: str) -> bool:
    """Whether the words of a cell are a few that come again and again: eight words or more, of at most eight kinds, each three times and more on average."""
    words = re.findall(r"[^\W\d_]+", cell.lower())
    kinds = len(set(words))
    return len(words) >= 8 and kinds <= 8 and len(words) >= 3 * kinds


def _unit(kind: str, text: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{kind} {text}") - 2**63


def _plain(text: str) -> str:
    return re.sub(r"[\d#*]+|\b[0-9a-f]{8,}\b", "", TAG.sub("\n", text)).lower()


def residue_evidence(docs: DataFrame) -> DataFrame:
    """doc_id, host (repo), reason, units of each document with a text cell that may be residue.

    units: hash of a normalized page, cell or sentence, its kind, whether it is foreign to its surroundings, and a hash of
    these: the title, else the text cell around it with the least hash, else the host; of foreign cells also a hash of the
    words without each of them in turn. Kinds:
    'cell' - a short text cell in any wording, compared with slug, titles and body; 'page' - a
    short whole text, compared with the slug; 'weak' - a sentence of a cell in the form of an error page, likewise.
    """
    has = [c if c in docs.columns else None for c in ("repo", "path")]
    cols = [F.col(c).cast("string") if c else F.lit(None).cast("string") for c in has]
    src = docs.select("doc_id", *[c.alias(n) for c, n in zip(cols, ("repo", "path"))], F.col("text").cast("string").alias("text"))
    unit = pa.struct([("unit", pa.int64()), ("kind", pa.string()), ("foreign", pa.bool_()), ("around", pa.int64()), ("slots", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, repo, path, text in zip(*[b.column(i).to_pylist() for i in range(4)]):
                if not text or text.isspace():
                    continue
                cells = text_cells(text)
                page = len(cells) == 1 and cells[0] is text
                if page and "<" not in text:
                    cells = [text, *(p for p in re.split(r"\n[ \t]*\n", text) if not TRACE.match(p))]
                slug, low = f"{repo or ''} {path or ''}".lower(), text.lower()
                reason, units = None, []
                title = next((x for c in cells for x in c.split("\n") if x.startswith("#")), None) if not page else None
                marks = sorted({_unit("around", c.strip()) for c in cells}) if not page and title is None else []
                for i, c in enumerate(cells):
                    whole = page and i == 0
                    v = judge_cell(c, whole)
                    if v is None and says_little(c) and (whole or is_foreign(c, slug, low)):
                        v = "filler"
                    if v and v != "weak":
                        reason = reason or v
                    plain = _plain(c)
                    if v == "weak":
                        units += [(_unit("weak", s.strip()), "weak", not any(t in slug for t in _terms(low)), None, ()) for s in SENTENCE.split(plain) if len(s.split()) > 2]
                    if 2 < len(plain.split()) and len(c.split()) <= SHORT and not all(x.startswith("#") for x in c.split("\n") if x.strip()):
                        # headings alone are titles
                        if whole:
                            units.append((_unit("page", " ".join(plain.split())), "page", not any(t in slug for t in _terms(low)), None, ()))
                        else:
                            other = [m for m in marks[:2] if m != _unit("around", c.strip())]
                            around = _unit("title", title) if title is not None and title not in c.split("\n") else other[0] if other else _unit("host", repo or "")
                            foreign, words = is_foreign(c, slug, low), c.lower().split()
                            slots = tuple(_unit("slot", " ".join([*words[:j], "", *words[j + 1 :]])) for j in range(len(words))) if foreign else ()
                            units.append((_unit("cell", " ".join(words)), "cell", foreign, around, slots))
                if reason or units:
                    rows.append((doc, repo, reason, [dict(zip(("unit", "kind", "foreign", "around", "slots"), u)) for u in dict.fromkeys(units)]))
            kinds = (b.schema.field(0).type, pa.string(), pa.string(), pa.list_(unit))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=["doc_id", "host", "reason", "units"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return src.mapInArrow(run, f"doc_id {kind}, host string, reason string, units array<struct<unit: bigint, kind: string, foreign: boolean, around: bigint, slots: array<bigint>>>")


def find_residue(docs: DataFrame, hosts: int = 3) -> DataFrame:
    """(doc_id, reason): documents in which residue stands as the whole text or as one of its text cells.

    Reasons: 'placeholder' - an unfilled field as a line of a text cell; 'filler', 'error',
    'script' - at least half of a text cell is filler, an error page or a notice that scripts
    are needed, by lists of phrases, or it repeats a few words that occur nowhere else in the document; 'duplicate' - a
    response in any wording which stands under several hosts and has nothing to do with where it stands:
      a short text cell (at most SHORT words, no heading): its terms are compared with the
      address slug, the titles and the body around it. Of the hosts and surroundings it stands in (copies of a
      notebook count once), each where it shares no term counts for residue and each other one against, by how
      often the corpus' other cells share none; it is residue if this is ODDS times likelier for residue than for any
      of the units looked at (about six hosts without a common term), unless it comes with the same
      other cell under half of its hosts, which are then copies of one notebook, or differs from two other
      such cells in one word, which is then a sentence filled in for its notebook;
      a short whole text, or a sentence of a cell in the form of an error page: under `hosts` or
      more hosts, where its address shares no term with it.
    Code, outputs, tracebacks, fenced blocks and words within a sentence of the notebook are no residue.

    Cases: null, empty and blank texts are none; a notebook whose JSON is broken is read as
    one text; null repo or path give no words and hence no common term; repeated rows are judged
    alike and give one row; an empty table gives an empty table; missing repo or path columns count as null,
    other columns play no part. Texts are judged whole.

    Plan: one pass over the texts, whose hashes go to a table in the shared checkpoint folder; they
    are counted over distinct hosts with map-side aggregation, so a unit under many hosts is spread by host first.
    """
    seen = cut(residue_evidence(docs))
    strong = seen.filter("reason is not null").select("doc_id", "reason")
    units = seen.select("doc_id", "host", F.explode("units").alias("u")).select("doc_id", "host", "u.*")
    by_host = units.filter("host is not null").groupBy("unit", "kind", "host").agg(F.min("foreign").alias("foreign"), F.min("around").alias("around"), F.count_if("foreign").alias("own_x"), F.count(F.lit(1)).alias("own_n"))
    # copies of a notebook say as much as one: of hosts with the same surroundings one counts
    by_place = by_host.groupBy("unit", "kind", F.coalesce("around", F.xxhash64("host")).alias("around")).agg(F.min("foreign").alias("foreign"), F.sum("own_x").alias("own_x"), F.sum("own_n").alias("own_n"))
    count = by_place.groupBy("unit", "kind").agg(F.sum("own_x").alias("own_x"), F.sum("own_n").alias("own_n"), F.count(F.lit(1)).alias("n"), F.sum(F.col("foreign").cast("int")).alias("x")).filter(F.col("n") >= hosts)
    # how often the other cells are foreign (a quarter where there are none), and how many units are looked at: two rows
    rate = units.filter("kind = 'cell'").agg(F.count_if("foreign").alias("all_x"), F.count(F.lit(1)).alias("all_n"))
    tried = count.agg(F.count_if(F.col("kind") == "cell").alias("tried"))
    count = count.join(F.broadcast(rate), F.lit(True), "left").join(F.broadcast(tried), F.lit(True), "left")
    p = F.least((F.col("all_x") - F.col("own_x") + 1) / (F.col("all_n") - F.col("own_n") + 4), F.lit(0.9))
    odds = F.col("x") * F.log(FOREIGN / p) + (F.col("n") - F.col("x")) * F.log((1 - FOREIGN) / (1 - p))
    count = cut(count.filter((F.col("kind") != "cell") | (odds >= F.log(ODDS * F.col("tried")))).select("unit", "kind"))
    # a cell that mostly comes with the same other cell is part of a notebook that was copied with changes
    cells = units.filter("kind = 'cell' and host is not null").select("doc_id", "host", "unit")
    mine = cells.join(count.filter("kind = 'cell'").select("unit"), "unit", "left_semi")
    pairs = mine.join(cells.select("doc_id", F.col("unit").alias("other")), "doc_id").groupBy("unit", "other", "host").agg(F.lit(1).alias("one")).groupBy("unit", "other").agg(F.count("one").alias("n"))
    copied = pairs.groupBy("unit").agg(F.max(F.when(F.col("unit") == F.col("other"), F.col("n"))).alias("all"), F.max(F.when(F.col("unit") != F.col("other"), F.col("n"))).alias("most")).filter(F.col("most") >= F.col("all") / 2).select("unit", F.lit("cell").alias("kind"))
    # one of many cells that differ in one word is a sentence with a slot, written for its notebook
    slots = units.filter("kind = 'cell' and foreign").select("unit", F.explode("slots").alias("slot")).distinct()
    filled = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 2").select("slot")
    slotted = slots.join(filled, "slot", "left_semi").select("unit", F.lit("cell").alias("kind")).distinct()
    common = count.join(copied, ["unit", "kind"], "left_anti").join(slotted, ["unit", "kind"], "left_anti")
    same = units.filter("foreign").join(common, ["unit", "kind"], "left_semi").select("doc_id", F.lit("duplicate").alias("reason"))
    # reasons of the text itself come first
    all_ = strong.withColumn("rank", F.lit(0)).unionByName(same.withColumn("rank", F.lit(1)))
    return all_.groupBy("doc_id").agg(F.min(F.struct("rank", "reason")).alias("r")).select("doc_id", "r.reason")


def without_residue(docs: DataFrame) -> DataFrame:
    """The rows of `docs` in which find_residue finds nothing."""
    return docs.join(find_residue(docs).select(F.col("doc_id").alias("__bad")), F.col("doc_id") == F.col("__bad"), "left_anti")

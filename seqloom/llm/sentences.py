"""Sentence boundaries in documents of any language and script.

The rules follow the property classes of the standard sentence-break algorithm
(terminators of all scripts, closing signs after them, a following lower-case
word continues), refined by abbreviations of each language, by quotations, and
by the layout of lists, records and interviews. Offsets are code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Word lists in natural order, without their final full stop.
# Words before a name or an explanation: a sentence never ends after them.
BEFORE_NAME = set(
    "mr mrs ms mx dr prof st lt capt cpt sgt col gen rev hon gov sen rep mt fr messrs mme mlle "  # English, French
    "sr sra srta dra don dña ud uds prof profa exmo "  # Spanish, Portuguese
    "hr frau dipl ing herrn "  # German
    "им ул пр проф акад гр тов г-н г-жа см ср ок напр "  # Russian
    "κ κα κος βλ πρβλ "  # Greek
    "डॉ प्रो श्री श्रीमती सं वि पं "  # Hindi
    "ڈاکٹر "
    "eg e.g i.e ie cf viz vs approx ca c.f incl inkl vgl bzw evtl ggf sog z.b d.h u.a "
    "p.ej ej aprox ex env resp т.е п.χ π.χ δηλ".split()
)
# Words before a number: a sentence does not end between them and it.
BEFORE_NUMBER = set(
    "no nos nr p pp fig figs vol vols ep eps ch chap sec sect op ed bd s t n sp "
    "pág págs pag núm num cap tom "
    "ép épis "
    "стр гл рис т д кв мин № "
    "σελ κεφ τόμ αρ "
    "ver v "
    "jan feb mar apr jun jul aug sep sept oct nov dec".split()
)
# Words that may stand at a sentence's end: the next word decides.
# (inc, ltd, etc., usw., p.m. and the like need no list: case decides.)
# Conjunctions after which an ellipsis was a pause, for scripts without case.
PAUSE = (
    "しかし", "だが", "でも", "けれど", "それでも", "そして", "ところが", "可是", "但是", "但", "不过", "然而", "却", "而",
    "그러나", "그런데", "하지만", "그리고", "पर ", "लेकिन", "मगर", "किंतु", "और ", "مگر", "لیکن", "اور ", "لكن", "ولكن", "ثم ", "แต่",
)

_ALL = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
# The characters of the Sentence_Break property, of all scripts.
_STERM = "".join(regex.findall(r"\p{Sentence_Break=STerm}", _ALL))
_ATERM = "".join(regex.findall(r"\p{Sentence_Break=ATerm}", _ALL))
# Closing signs; quotation marks, which open or close, are matched apart.
_CLOSE = "".join(regex.findall(r"(?=\p{Sentence_Break=Close})\p{Pe}", _ALL))
_CONTINUE = "".join(c for c in regex.findall(r"\p{Sentence_Break=SContinue}", _ALL) if not regex.match(r"\p{Pd}", c))
_SHAD = "།༎"  # Tibetan, not in the property; ends a sentence as the text's only stop
_ASKING = "!?‼‽⁇⁈⁉⸮"  # case and blanks behind them decide, as in the scripts with case
# Ends a sentence without a blank behind it.
_WIDE = "".join(c for c in _STERM if c not in _ASKING) + "．♪" + _SHAD
_ENDS = _STERM + _ATERM + "…♪" + _SHAD
_FOLLOWS = _CONTINUE + _CLOSE + ",，、،;；:：)）]】»」』》%/"  # never the first sign of a sentence
_EMOTE = r"(?:\^\^|\^_\^|T_T|xD\b|<3|[:;=]-?[)(DPp]+(?!\w)|[\U0001F300-\U0001FAFF☀-♩♫-➿]️?)"

_PARAGRAPH = regex.compile(r"\r?\n[^\S\n]*(?:\r?\n\s*)|[\v\f\x1c-\x1e ]\s*")
_MARKER = regex.compile(r"[^\S\n]*(?:[-*•‣◦▪–]|\(?\d{1,3}[.)]|\(?[a-z][.)])[^\S\n]+(?=\S)")
_LINE = regex.compile(r"\r?\n|\r")
_LABEL = regex.compile(r"(?:[\p{Lu}][\p{Lu}\p{M}'’.\-]*(?:[ ][\p{Lu}][\p{Lu}\p{M}'’.\-]*){0,3})[:：]\s+")
_RECORD = regex.compile(r"(?:\p{Lu}[\p{L} ]{0,30}: [^;\n]*;\s+){2,}\p{Lu}[\p{L} ]{0,30}: ")
_THAI = r"ก-ฺเ-๎"
_TOKEN = regex.compile(
    rf"(?P<end>[{regex.escape(_ENDS)};;]+)|(?P<open>[\"“”„«»「『《‘'])|(?P<thai>(?<=[{_THAI}])(?<!ๆ)\s+(?=[^\s\d\p{{Latin}}.,;:!?…)\]}}^]))"
)
_AFTER = regex.compile(rf"(?P<close>(?:\s?(?<=\s)[»“”](?!\w)|[{regex.escape(_CLOSE)}]|[\"'”’“»«›‹](?![\p{{L}}¿¡…]))*)(?P<emote>(?:[^\S\n]?{_EMOTE})*)(?P<gap>\s*)")
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}№.'’\-]+$")
_CJK = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}ー々〆〜]")
_CASELESS = regex.compile(r"[\p{Lo}\p{M}]")
_PAIRS = {"“": "”", "„": "“”", "«": "»", "»": "«", "”": "“", "「": "」", "『": "』", "《": "》", "‘": "’", '"': '"', "'": "'"}
_TOLD = regex.compile(r"[.!?…]\s+—(?=\p{Ll})")
_DIGIT_BEFORE = regex.compile(r"\d\s*$")
_SPACED_SCRIPT = regex.compile(r"[\p{Hangul}\p{Thai}]")
_WORD_BEFORE = regex.compile(r"(\w+)\s+$")
_GREEK = regex.compile(r"\p{Greek}")
_FREE = "([（「『:：—–-¿¡,،" + _ENDS + "）』」》”^😊"
_SHUT = _ENDS + ")"
_PARTICLE = "とはがをにのもでっ"


class _Quotes:
    """Where quotations of one text close; each sign is looked for once, so the work is linear in the text."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.found: dict[str, tuple[int, int]] = {}
        self.pairs: dict[str, dict[int, int]] = {}

    def _next(self, name: str, at: int, search) -> int:
        """The first place from ``at`` on; what an earlier search found holds until it is passed."""
        since, place = self.found.get(name, (at + 1, -1))
        if not since <= at <= place:
            place = search(at)
            self.found[name] = at, place
        return place

    def _plain(self, sign: str, at: int) -> int:
        text, ends = self.text, _PAIRS[sign]
        while True:
            places = [i for i in (text.find(c, at) for c in ends) if i >= 0]
            if not places:
                return len(text)
            i = min(places)
            if sign != "'" or not (text[i - 1].isalnum() and i + 1 < len(text) and text[i + 1].isalnum()):
                return i
            at = i + 1

    def _nested(self, sign: str) -> dict[int, int]:
        if sign not in self.pairs:
            pairs, held = {}, []
            for token in regex.finditer(f"[{sign}{_PAIRS[sign]}]", self.text):
                if token[0] == sign:
                    held.append(token.start())
                elif held:
                    pairs[held.pop()] = token.start()
            self.pairs[sign] = pairs
        return self.pairs[sign]

    def told(self, at: int, stop: int) -> int:
        """Where the words about the speaker begin, after a dash, or -1."""

        def search(i: int) -> int:
            found = _TOLD.search(self.text, i)
            return found.start() if found else len(self.text)

        place = self._next("told", at, search)
        found = _TOLD.match(self.text, place, stop) if place < stop else None
        return found.end() if found else -1

    def closing(self, at: int, stop: int) -> int:
        """Where the quotation opened at ``at`` closes, or -1 if nothing opens there."""
        text = self.text
        sign = text[at]
        before = text[at - 1] if at else " "
        behind = text[at + 1] if at + 1 < stop else " "
        if sign in "「『《":
            return close if (close := self._nested(sign).get(at, stop)) < stop else -1
        free = before.isspace() or before in _FREE or _CASELESS.match(before)
        if sign in "\"'" and not (free or before in _SHUT):
            return -1
        if sign == "'" and (before.isalnum() or not (behind.isalpha() or behind in ".¿¡…")):
            return -1
        if sign in "»”" and (not free or behind.isspace() or not (behind.isalpha() or behind in "¿¡…")):
            return -1
        close = self._next(sign, at + 1, lambda i: self._plain(sign, i))
        return close if close < stop else -1


def _last_word(text: str, start: int, dot: int) -> str:
    found = _WORD.search(text, max(start, dot - 40), dot)
    return found[0].lower().lstrip(".-'’") if found else ""


def _abbreviation(text: str, start: int, dot: int, after: int, stop: int) -> bool:
    """Whether the full stop at ``dot`` only marks an abbreviation, a number or an initial."""
    word = _last_word(text, start, dot)
    if not word:
        return False
    following = text[after] if after < stop else ""
    whole = text[dot - len(word) : dot]
    if word in BEFORE_NAME or word.rsplit(".", 1)[-1] in ("ej", "ex", "χ") and "." in word:
        return True
    if word in BEFORE_NUMBER and (following.isdigit() or following in ("№", "#")):
        return True
    if word == "г":  # a year before it, and a capital behind it: may be the end
        return not _DIGIT_BEFORE.search(text, max(start, dot - 8), dot - 1)
    if len(word) == 1 and word.isalpha():
        lead = text[max(start, dot - 5) : dot - 1].rstrip().lower()
        if lead.endswith("т.") and word in "дп":
            return False
        if _CJK.match(word) or _SPACED_SCRIPT.match(word):
            return False
        return bool(whole.isupper() or _CASELESS.match(word) or word in "тсдпκzdut") and not (word == "i" and whole.islower())
    if word in ("e.e", "ee"):
        return True
    if word.isdigit() and len(word) <= 2:  # German ordinals
        lead = _WORD_BEFORE.search(text[max(start, dot - 16) : dot - len(word)])
        return bool(lead) and lead[1].lower() in ("am", "der", "die", "das", "dem", "den", "des", "vom", "im", "zum", "zur")
    return False


def _sentences(quotes: _Quotes, start: int, stop: int) -> Iterator[tuple[int, int]]:
    """Sentences of text[start:stop], which has no blank line."""
    text = quotes.text
    listed = bool(_MARKER.match(text, start, stop))
    if listed:
        cuts = [start]
        for line in _LINE.finditer(text, start, stop):
            if _MARKER.match(text, line.end(), stop):
                cuts.append(line.end())
        for a, b in zip(cuts, [*cuts[1:], stop], strict=True):
            yield from _run(quotes, a, b, _MARKER.match(text, a, b).end())
    else:
        yield from _run(quotes, start, stop, start)


def _run(quotes: _Quotes, start: int, stop: int, body: int) -> Iterator[tuple[int, int]]:
    """Sentences of a run of text; the first one's own words begin at ``body``."""
    text = quotes.text
    while True:
        while start < stop and text[start].isspace():
            start += 1
        if start >= stop:
            return
        at = max(start, body)
        if label := _LABEL.match(text, at, stop):
            at = label.end()
        if record := _RECORD.match(text, at, stop):
            at = record.end()
        end = _end(quotes, start, at, stop)
        shown = end
        while shown > start and text[shown - 1].isspace():
            shown -= 1
        yield start, shown
        start = body = end


def _end(quotes: _Quotes, start: int, at: int, stop: int) -> int:
    """Where the sentence that begins at ``start`` ends; its own words begin at ``at``."""
    text = quotes.text
    opening = at
    while opening < stop and text[opening] in "([（":
        opening += 1
    if text.startswith("—", opening) and opening + 1 < stop and not text[opening + 1].isspace():
        at = max(at, quotes.told(opening, stop))
    i = at
    while token := _TOKEN.search(text, i, stop):
        i = token.end()
        if token.lastgroup == "thai":
            return token.start()
        if token.lastgroup == "open":
            close = quotes.closing(token.start(), stop)
            if close < 0:
                continue
            inner = close - 1
            while inner > token.start() and text[inner].isspace():
                inner -= 1
            i = close + 1
            if text[inner] not in ";;" + _ENDS or text[close] == "》" or text[inner] == ";":
                continue
            if token.start() <= opening or text[opening : token.start()].strip(" ([（") == "":
                # speech opens the sentence: the words about the speaker follow
                opening = i
                continue
            mark = text[inner]
            after = _AFTER.match(text, i, stop)
        else:
            run = token["end"]
            mark = run[-1]
            if set(run) <= {";", ";"} and not (run == ";" or _GREEK.search(text, max(start, token.start() - 6), token.start())):
                continue
            after = _AFTER.match(text, i, stop)
            if mark in _ATERM and len(run) == 1 and not after["close"] and not after["emote"] and _abbreviation(text, start, token.start(), after.end(), stop):
                continue
        if _ends(text, mark, token, after, stop):
            return after.start("gap")
        i = max(i, after.start("gap")) if after["close"] or after["emote"] else i
    return stop


def _ends(text: str, mark: str, token: regex.Match, after: regex.Match, stop: int) -> bool:
    """Whether a sentence ends at this mark, by what follows."""
    nxt = after.end()
    if nxt >= stop:
        return True
    c, d = text[nxt], text[nxt + 1] if nxt + 1 < stop else " "
    before = text[token.start() - 1] if token.start() else " "
    gap = bool(after["gap"])
    if c in _FOLLOWS and not (c == "»" and d.isalpha()):
        return False
    ellipsis = mark == "…" or token.lastgroup == "end" and token["end"].endswith("...")
    if ellipsis and not after["close"] and text.startswith(PAUSE, nxt):
        return False
    if after["close"] and c in _PARTICLE and not gap or c in "―":
        return False
    wide = mark in _WIDE or bool(_CJK.match(before)) and mark in _ASKING + "…"
    if mark in _ATERM and not gap and before.isdigit() and c.isdigit():
        return False
    if wide:
        return not (after["close"] and c.islower() and d.islower())
    if c.islower() and not d.isupper():
        return False
    if c in "(（[" and (d.islower() or not gap and d.isdigit()):
        return False
    if c in "—–-" and d.isspace():
        return False
    if not gap and not after["emote"]:
        if c.isdigit() or c in "._/@#&=+*'’":
            return False
        if _CASELESS.match(c):
            return mark not in _ATERM or not before.isdigit()
        if c.isupper():
            word = _last_word(text, max(0, token.start() - 40), token.start())
            if after["close"]:
                return True
            return mark in _ASKING + "…" or before.isdigit() is False and len(word) > 1 and d.islower() and "." not in word and "www" not in word
        return c in "\"“„«「『《(（¿¡—'‘”»"
    return True


def sentence_spans(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every sentence; none for null, empty and blank texts."""
    if not text:
        return []
    spans, start, quotes = [], 0, _Quotes(text)
    for gap in _PARAGRAPH.finditer(text):
        spans += _sentences(quotes, start, gap.start())
        start = gap.end()
    spans += _sentences(quotes, start, len(text))
    return spans


def split_sentences(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, start_char, end_char, sentence_index), one per sentence.

    Offsets count code points, the end is exclusive, and outer white space is left
    out; every other character lies in exactly one sentence. Null, empty and blank
    texts give no rows; texts are worked on whole, whatever their length. Repeated
    rows repeat, a null key stays null, other columns are not read. There is no
    shuffle: each text is one row of the scan.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                keys, starts, ends, index = [], [], [], []
                for k, t in zip(part["k"].to_pylist(), part["t"], strict=True):
                    spans = sentence_spans(t.as_py())
                    keys += [k] * len(spans)
                    starts += [s for s, _ in spans]
                    ends += [e for _, e in spans]
                    index += range(len(spans))
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, starts, ends, index)], names=[key, "start_char", "end_char", "sentence_index"])

    from pyspark.sql import functions as F

    return df.select(F.col(key).cast("long").alias("k"), F.col(text).cast("string").alias("t")).mapInArrow(run, f"`{key}` long, start_char long, end_char long, sentence_index long")

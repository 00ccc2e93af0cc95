"""Problem 1: text that looks the same but differs in its characters.

Each token's letters have script sets: their own script, and those in which a look-alike exists. A token whose own scripts
don't intersect is mixed; the scripts in the intersection of the widened sets can spell it consistently, and the one most
of its letters belong to is taken. A token of one script amid text of another, all of whose letters have look-alikes
there, is a whole-script confusable. What is left (invisible characters, other spaces, wide, narrow, styled and joined
forms, detached accents) is brought to one normal form.

Defined results: null and blank fields give no row; garbled passages are left as they are; text without such characters
comes out unchanged; emoji sequences keep their joiners and selectors.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame

from transquill.llm.mojibake import GATE as GARBLED
from transquill.llm.mojibake import Model, restorer
from transquill.llm.rows import has_text, map_rows

# Letters that look like letters of another script, by script.
CYRILLIC = dict(zip("аеорсухіјѕԁԛԝһѵёїАВЕКМНОРСТУХІЈЅԌҮЁЇ", "aeopcyxijsdqwhvëïABEKMHOPCTYXIJSGYËÏ"))
GREEK = dict(zip("ονρικυαγχτωΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ovpikuayxtwABEZHIKMNOPTYX"))
ARMENIAN = dict(zip("օսհոցզԼՏՕ", "ouhngqLSO"))
CHEROKEE = dict(zip("ᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏔᏚᏞᏟᏢᏤᏦᏴ", "AJEWMHGZbRWSLCPVKB"))
#: Of the same script, but of other languages' alphabets or of phonetic writing.
VARIANTS = dict(zip("ɑɡکیہھە", "agكيههه"))
#: Punctuation of Chinese and Japanese text.
CJK_MARKS = "！（），．：；？［］｛｝～／＂＇"
# End of fixed values.

LOOKS: dict[str, dict[str, str]] = {}
for _script, _pairs in (("Cyrl", CYRILLIC), ("Grek", GREEK), ("Armn", ARMENIAN), ("Cher", CHEROKEE)):
    for _c, _latin in _pairs.items():
        LOOKS.setdefault(_c, {_script: _c})["Latn"] = _latin
        LOOKS.setdefault(_latin, {"Latn": _latin}).setdefault(_script, _c)
for _c in CYRILLIC:
    for _g, _latin in GREEK.items():
        if CYRILLIC[_c] == _latin:
            LOOKS[_c].setdefault("Grek", _g)
            LOOKS[_g].setdefault("Cyrl", _c)

SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000\t\v\f"
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180e\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0"
#: Stand-in forms: ligatures, Arabic presentation forms, wide and narrow forms, radicals, styled and circled letters.
FORMS = "\ufb00-\ufb4f\ufb50-\ufdff\ufe70-\ufefc\uff01-\uff9f\uffa1-\uffee\u2f00-\u2fd5\u2e80-\u2eff\u2100-\u214f\u24b6-\u24e9\U0001d400-\U0001d7ff\U0001f130-\U0001f169\uf900-\ufaff"
LOOSE = "\u0300-\u036f\u0483-\u0487\u064b-\u0655\u093c\u1161-\u11ff\u3099\u309a"
EMOJI = "\u2190-\u21ff\u2300-\u23ff\u2600-\u27bf\u2900-\u297f\u2b00-\u2bff\u3030\u303d\u3297\u3299\u00a9\u00ae\U0001f000-\U0001faff#*0-9"
EMOJI_PART = re.compile(f"(?<=[{EMOJI}])[\ufe0e\ufe0f]|(?<=[{EMOJI}\ufe0f])\u200d(?=[{EMOJI}])|(?<=[\U0001f3f4\U000e0020-\U000e007f])[\U000e0020-\U000e007f]")
TO_SPACE = re.compile(f"[{SPACES}]")
TO_NOTHING = re.compile(f"[{INVISIBLE}]")
TO_PLAIN = re.compile(f"[{FORMS}]+")
MARKED = re.compile(f"[^\\s{LOOSE}][{LOOSE}]+|[\uac00-\ud7a3\u1100-\u115e][\u1161-\u11ff]+")
CJK = re.compile("[\u3005-\u3007\u3040-\u30ff\u3400-\u9fff]")
WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036f\u0610-\u065f])*")
#: Scripts with look-alikes in each other; letters of others stand apart.
ALIKE = {"Latn", "Cyrl", "Grek", "Armn", "Cher"}
#: What a text must match to be looked at in Python.
GATE = f"[{SPACES}{INVISIBLE}{LOOSE}{''.join(VARIANTS)}]|[\ufb00-\ufdff\ufe70-\ufefc\uff01-\uffee\u2f00-\u2fd5\u2e80-\u2eff\u2100-\u2115\u2117-\u2121\u2123-\u214f\u24b6-\u24e9\U0001d400-\U0001d7ff]"

#: Or letters of two of the scripts that look alike.
LATIN, ALIEN = "[A-Za-z\u00c0-\u024f]", "[\u0370-\u058f\u13a0-\u13ff]"
SCRIPT_LETTERS = [LATIN, "[\u0370-\u03ff]", "[\u0400-\u052f]", "[\u0530-\u058f]", "[\u13a0-\u13ff]"]
#: What stands beside a word in prose; in markup, code and addresses other signs do.
BESIDE = re.compile(r"[\s.,;:!?\"'«»“”„’()…–—-]|$")


@lru_cache(20_000)
def script(c: str) -> str:
    """The script of a letter, by its name; '' if it is none of those with look-alikes."""
    name = unicodedata.name(c, "")
    for word, code in (("LATIN", "Latn"), ("CYRILLIC", "Cyrl"), ("GREEK", "Grek"), ("ARMENIAN", "Armn"), ("CHEROKEE", "Cher")):
        if name.startswith(word):
            return code
    return ""


@lru_cache(20_000)
def plain(c: str) -> str:
    """A stand-in form's plain characters; itself if it has a meaning of its own."""
    kind = unicodedata.decomposition(c).split(" ", 1)[0]
    new = unicodedata.normalize("NFKC", c)
    if "⺀" <= c <= "⿕" or kind in ("<wide>", "<narrow>", "<font>", "<isolated>", "<initial>", "<medial>", "<final>"):
        return new
    if kind == "<circle>" and new.isalpha() or kind == "<compat>" and unicodedata.category(c)[0] == "L" and new.isalpha():
        return new
    return c if kind.startswith("<") else new


def spellings(word: str) -> tuple[set[str], set[str], dict[str, int]]:
    """Scripts that all its letters have; scripts in which all have a look-alike; letters by own script."""
    own: dict[str, int] = {}
    narrow: set[str] | None = None
    wide: set[str] | None = None
    for c in word:
        if s := script(c):
            own[s] = own.get(s, 0) + 1
            narrow = {s} if narrow is None else narrow & {s}
            wide = {s, *LOOKS.get(c, {})} if wide is None else wide & {s, *LOOKS.get(c, {})}
    return narrow or set(), wide or set(), own


def respell(word: str, to: str) -> str:
    return "".join(c if script(c) in ("", to) else LOOKS.get(c, {}).get(to, c) for c in word)


def strong(word: str, s: str) -> bool:
    """Whether some letter of it can only be of this script."""
    return any(script(c) == s and len(LOOKS.get(c, ())) < 2 for c in word)


def scripts_pass(text: str) -> tuple[str, bool]:
    """Tokens of mixed and whole-script confusables brought to their consistent spelling."""
    words = [(m.start(), m.end(), m[0]) for m in WORD.finditer(text)]
    solid: list[str] = []
    changes: dict[int, str] = {}
    weak: list[int] = []
    for i, (_, _, w) in enumerate(words):
        if w.isascii():
            solid.append("Latn")
            if all(c in LOOKS for c in w):
                weak.append(i)
            continue
        narrow, wide, own = spellings(w)
        if narrow or len(own) <= 1:
            s = next(iter(narrow), "")
            solid.append(s)
            if s and not strong(w, s):
                weak.append(i)
        elif wide:
            to = max(sorted(wide), key=lambda s: (sum(1 for c in w if script(c) == s and len(LOOKS.get(c, ())) < 2), own.get(s, 0)))
            changes[i] = respell(w, to)
            solid.append(to)
        else:
            solid.append("")
            top = max(sorted(own), key=lambda s: own[s])
            if (new := respell(w, top)) != w:
                changes[i] = new
    if len(set(solid) & ALIKE) > 1:
        weak_at = set(weak)
        firm = [i for i, s in enumerate(solid) if s and i not in weak_at]
        firm_scripts = {solid[i] for i in firm}
        for i in weak:
            s, w = solid[i], words[i][2]
            if not BESIDE.match(text[words[i][0] - 1 : words[i][0]]) or not BESIDE.match(text[words[i][1] : words[i][1] + 1]):
                continue
            before = next((solid[j] for j in range(i - 1, -1, -1) if j not in weak_at and solid[j]), "")
            after = next((solid[j] for j in range(i + 1, len(words)) if j not in weak_at and solid[j]), "")
            near = {x for x in (before, after) if x}
            if len(near) != 1 or s in near or (not (before and after) and s in firm_scripts):
                continue
            to = near.pop()
            if all(to in LOOKS.get(c, {}) or not script(c) for c in w) and not (s == "Latn" and len(w) > 1 and w.isupper()):
                changes[i] = respell(w, to)
    if not changes:
        return text, False
    out, at = [], 0
    for i in sorted(changes):
        a, b, _ = words[i]
        out += [text[at:a], changes[i]]
        at = b
    return "".join(out) + text[at:], True


PRIVATE = re.compile("[\U000f0000-\U0010ffff]")


def normal_form(text: str) -> tuple[str, list[str]]:
    """The consistent form, and the kinds of what was found."""
    kinds: list[str] = []
    kept: dict[str, str] = {}  # each different part has one character for private use, and these stand for themselves

    def hold(m: re.Match) -> str:
        return kept.setdefault(m[0], chr(0xF0000 + len(kept)))

    if not text.isascii() and re.search("[\u200d\ufe0e\ufe0f\U000e0020-\U000e007f]", text):
        text = EMOJI_PART.sub(hold, PRIVATE.sub(hold, text))
    new = TO_NOTHING.sub("", text)
    if new != text:
        kinds.append("invisible")
    text, new = new, TO_SPACE.sub(" ", new)
    if new != text:
        kinds.append("space")
    text = new
    if TO_PLAIN.search(text):
        lines = [TO_PLAIN.sub(lambda m, cjk=bool(CJK.search(line)): "".join(c if cjk and c in CJK_MARKS else plain(c) for c in m[0]), line) for line in text.split("\n")]
        if (new := "\n".join(lines)) != text:
            kinds.append("form")
            text = unicodedata.normalize("NFC", new) if re.search("[\uff9e\uff9f]", text) else new
    if MARKED.search(text):
        new = MARKED.sub(lambda m: x if len(x := unicodedata.normalize("NFC", m[0])) < len(m[0]) else m[0], text)
        if new != text:
            kinds.append("accent")
            text = new
    if not text.isascii():
        new = text.translate(VARIANT_TABLE)
        new, mixed = scripts_pass(new)
        if new != text:
            kinds.append("script")
            text = new
    if kept:
        parts = {c: part for part, c in kept.items()}
        text = PRIVATE.sub(lambda m: parts.get(m[0], m[0]), text)
    return text, kinds


#: Stands for a garbled passage.
HELD = "\ue000"
VARIANT_TABLE = str.maketrans(VARIANTS)


_GATE, _ALIEN, _LETTERS = re.compile(GATE), re.compile(ALIEN), [re.compile(p) for p in SCRIPT_LETTERS]


def two_scripts(text: str) -> bool:
    """Whether it has letters of two of the scripts that look alike."""
    return bool(_ALIEN.search(text)) and sum(1 for p in _LETTERS if p.search(text)) > 1


def needs(text: str) -> bool:
    """Whether normal_form may change the text; cheap."""
    return not text.isascii() and bool(_GATE.search(text) or two_scripts(text))


def find_lookalikes(fields: DataFrame, model: Model, key: str = "video_id") -> DataFrame:
    """fields: (key, field, text). Gives (key, field, normal, kinds) of each field that changes; garbled passages stay."""
    make = restorer(fields.sparkSession, model)
    garbled, gate = re.compile(GARBLED), re.compile(GATE)

    def start() -> Callable[..., list[tuple]]:
        r = make()

        def kernel(k, field, text):  # noqa: ANN001, ANN202
            if text.isascii() and not re.search(r"[\t\v\f]", text) or not (gate.search(text) or two_scripts(text)):
                return []
            spans = r.spans(text) if not text.isascii() and garbled.search(text) else []
            if not spans:
                new, kinds = normal_form(text)
                return [(k, field, new, kinds)] if kinds else []
            held, out, at = [], [], 0
            for s in spans:
                a, b = s.start, s.end
                while s.text is not None and a > at and ord(text[a - 1]) > 127:
                    a -= 1
                while s.text is not None and b < len(text) and ord(text[b]) > 127:
                    b += 1
                if a < at:
                    a = at
                if b <= at:
                    continue
                out += [text[at:a], HELD]
                held.append(text[a:b])
                at = b
            new, kinds = normal_form("".join(out) + text[at:])
            if not kinds:
                return []
            parts = new.split(HELD)
            return [(k, field, "".join(p + (held[i] if i < len(held) else "") for i, p in enumerate(parts)), kinds)]

        return kernel

    kind = dict(fields.dtypes)[key]
    return map_rows(fields.where(has_text("text")), [key, "field", "text"], start, f"`{key}` {kind}, field string, normal string, kinds array<string>")

"""Problem 2: clean, ordered speaker turns from transcripts and caption files.

A text becomes pieces (what stands between time marks, speaker marks or cues), in time order, each with the label it may
have. A semi-Markov conditional model (turn_model), fitted on labelled caption files, scores whole turns by their labels, pauses, lexical
continuity, unfinished sentences and length; the best sequence of turns is found by dynamic programming. Spans that are no
speech are removed when turns are rebuilt.

Defined results: null or blank texts, texts without time or speaker marks and texts in which fewer than two persons are
labelled give no turn; pieces before the first label are a part of the first turn; cues without a readable time keep their
place; of pieces with one time the order in the file decides; without labelled files the model has stated weights.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transquill.llm import turn_model
from transquill.llm.lookalikes import needs, normal_form
from transquill.llm.rows import has_text, map_rows
from transquill.llm.turn_model import Sequence, best_persons, overlap

# Sounds that stand for no word, words before a person's number, and phrases before a colon that name nobody.
FILLERS = frozenset("um uhm uh erm er hm hmm hum mm mmm mhm ah eh em euh heu ähm äh öhm hem ehm este э ээ эм м мм хм ну ã hã ahn hum えー ええと えーと あの あのー うーん えっと 嗯 呃 啊 那个 เอ่อ อืม أم آه اه إيه हम्म अं उम".split())
NOT_NAMES = frozenset("kurz gesagt|правило такое|in short|en bref|en resumen|em resumo|note|nota|hinweis|achtung|attention|atención|atenção|внимание|здесь|question|answer|réponse|frage|antwort".split("|"))
WORDS_NOT_NAMES = frozenset("the a an is are here this that rule le la les un une est voici règle der die das ist ein eine regel lautet wie erzählt el los las es esta este norma o os as é esta regra это вот такое правило и в на to of and et und y e de du des von".split())
TITLES = frozenset("dr dra prof mr mrs ms miss mme mlle hr herr frau sr sra srta don doña sig дr доктор д-р г-н г-жа".split())
# End of fixed values.

UNFITTED = turn_model.UNFITTED.tolist()
CLOCK = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
MARK = re.compile(rf"(?P<stamp>[\[(]{CLOCK}[\])]|(?<![\d:.,]){CLOCK}(?![\d:]))|(?P<arrow>(?<![>\w])>>(?!>))")
ROLE = re.compile(r"^([^\W\d_]+)\.?[\s_#-]*0*(\d{1,3})$")
NAME = re.compile(r"[^\W\d_][\w.'’-]*(?:[ _][^\W_][\w.'’-]*){0,2}")
NO_SPEECH = re.compile(r"\[[^\]\n]{0,60}\]|\([^()\n]{0,60}\)|[♪♫]+|<[^<>\n]{1,60}>|\{\\[^{}\n]*\}")
TIMING = re.compile(rf"(?P<a>{CLOCK})\s*-->\s*(?P<b>{CLOCK})[^\n]*")
VOICE = re.compile(r"<v(?:\.[\w.]+)?\s+([^<>]+)>")
TAG = re.compile(r"</?[^<>\n]{1,60}>")
WORD = re.compile(r"[^\W_](?:[^\W_]|[\u0300-\u036f\u0900-\u097f\u0e00-\u0e7f'’-])*")
END = re.compile(r"[.!?…。！？।؟♪][»”\"’')\]」]*\s*$")

#: Seconds by which the times of cues that touch may differ; the pause from which a longer one says no more.
CARRY, LONG_PAUSE = 0.051, 30.0
#: The model is fitted on at most so many labelled files of at most so many pieces and characters.
TRAIN_FILES, TRAIN_PIECES, TRAIN_CHARS = 48, 64, 20_000


@dataclass
class Piece:
    start: float
    label: str
    text: str


def seconds(clock: str) -> float:
    parts = clock.replace(",", ".").split(":")
    return sum(float(p) * 60**i for i, p in enumerate(reversed(parts)))


def speech(text: str) -> str:
    """Without sound annotations; '' if only fillers are left."""
    out = re.sub(r"\s+", " ", NO_SPEECH.sub(" ", text)).strip()
    words = [p for w in WORD.findall(unicodedata.normalize("NFC", out.lower())) for p in re.split(r"[-'’]", w) if p]
    return out if any(w not in FILLERS for w in words) else ""


def without_fillers(text: str) -> str:
    """A turn's text without the fillers that stand alone between its words."""
    return re.sub(r"\s+", " ", re.sub(r"(?<![\w'’-])(?:" + "|".join(sorted(map(re.escape, FILLERS - {"este", "a", "e", "o", "ну", "э", "м", "em", "あの", "那个", "eh"}), key=len, reverse=True)) + r")(?:[.,…]+|(?![\w'’-]))", " ", text, flags=re.IGNORECASE)).strip()


def name_like(label: str) -> bool:
    """Whether it may name a person: a role with a number, or up to three words of one case."""
    low = label.strip().lower()
    if ROLE.match(low):
        return True
    if not NAME.fullmatch(label.strip()) or low in NOT_NAMES:
        return False
    words = [w for w in re.split(r"[ _]", label.strip()) if w]
    if any(w.lower() in WORDS_NOT_NAMES for w in words):  # an initial has its point
        return False
    firsts = [w[0] for w in words]
    return all(c.isupper() for c in firsts) or all(c.islower() for c in firsts) or not any(c.lower() != c.upper() for c in firsts)


def marked_pieces(text: str) -> list[Piece]:
    """Pieces of a transcript with time marks or speaker marks."""
    marks = [m for m in MARK.finditer(text)]
    arrows = sum(1 for m in marks if m["arrow"])
    stamps = [m for m in marks if m["stamp"]]
    if arrows >= 2 and arrows * 2 > len(stamps):
        cuts = [m for m in marks if m["arrow"]]
        return [Piece(float(i), *split_label(text[m.end() : cuts[i + 1].start() if i + 1 < len(cuts) else len(text)])) for i, m in enumerate(cuts)]
    heads = re.findall(rf"(?m)^[^\n()]{{1,40}}\({CLOCK}\)[ \t]*$", text)
    if len(heads) >= 2:
        parts = [m for m in re.finditer(rf"(?m)^(?P<label>[^\n()]{{1,40}}?)?[ \t]*\((?P<clock>{CLOCK})\)[ \t]*$", text)]
        return [Piece(seconds(m["clock"]), (m["label"] or "").strip(), text[m.end() : parts[i + 1].start() if i + 1 < len(parts) else len(text)]) for i, m in enumerate(parts)]
    shape = style(text, stamps)
    if not shape:
        lines = [split_label(x) for x in text.split("\n") if x.strip()]
        return [Piece(float(i), *x) for i, x in enumerate(lines)] if sum(1 for x, _ in lines if x) >= 2 else []
    out = []
    for i, m in enumerate(shape):
        body = text[m.end() : shape[i + 1].start() if i + 1 < len(shape) else len(text)]
        out.append(Piece(seconds(m["stamp"].strip("[]()")), *split_label(body)))
    return out


def style(text: str, stamps: list[re.Match]) -> list[re.Match]:
    """The time marks that are marks and no times of day in speech: of one shape, and never going far back."""
    shapes: dict[str, list[re.Match]] = {}
    for m in stamps:
        s = m["stamp"]
        shapes.setdefault(f"{s[0] if s[0] in '[(' else ''}{s.count(':')}{'.' if '.' in s or ',' in s else ''}", []).append(m)
    best: list[re.Match] = []
    for group in shapes.values():
        if len(group) >= 2 and group[0].start() <= 60:
            first = text[: group[0].start()]
            if not re.search(r"\w", NO_SPEECH.sub("", first)) and len(group) > len(best):
                best = group
    if not best or best[0]["stamp"][0] in "[(":
        return best
    kept = [m for m in best if (at := text[: m.start()].rstrip(" ")) == "" or at[-1] in "\n.!?…»”\"'’)]♪。！？।؟ *" or re.search(r"(?:^|\s)(?:\w{1,4}|euh euh)\W*$", at[-12:]) and follows_label(text, m)]
    return kept if len(kept) >= 2 else []


def follows_label(text: str, m: re.Match) -> bool:
    return bool(split_label(text[m.end() : m.end() + 80])[0])


def split_label(body: str) -> tuple[str, str]:
    """(label, rest) of a piece; no label: ''."""
    body = body.strip()
    m = re.match(r"\[([^\]\n]{1,40})\]\s*(?=\S|$)", body)
    if m and name_like(m[1]) and not (len(m[1].split()) == 1 and m[1].lower() in SOUNDS):
        return m[1].strip(), body[m.end() :]
    m = re.match(r"([^\n:–—\[\]()]{1,40}?)[ \t]*(?::[ \t\n]|[ ][–—][ ]|:$)", body)
    if m and name_like(m[1]):
        return m[1].strip(), body[m.end() :]
    return "", re.sub(r"^[-–—]\s+", "", body)


SOUNDS = frozenset("music musique musik música musica музыка applause applaudissements beifall aplausos аплодисменты laughter rires lachen risas risos смех laughs noise bruit geräusch ruido ruído шум silence stille silencio inaudible unverständlich inaudível неразборчиво cheering crosstalk sighs coughs موسيقى تصفيق ضحك संगीत तालियां เสียงดนตรี เสียงปรบมือ 音楽 拍手 笑い 笑 音乐 掌声 笑声".split())


def caption_pieces(raw: str) -> list[Piece]:
    """Pieces of a caption file: cues with arrows, segments in JSON, dialogue lines with fields."""
    raw = raw.lstrip("\ufeff").replace("\r\n", "\n").replace("\r", "\n")
    head = raw.lstrip()[:1]
    if head and head in "{[" and not raw.lstrip().startswith("[Script Info]"):
        try:
            data = json.loads(raw)
        except (ValueError, RecursionError):
            data = None
        rows = data if isinstance(data, list) else next((data[k] for k in ("segments", "cues", "captions", "events", "body") if isinstance(data.get(k), list)), []) if isinstance(data, dict) else []
        out = []
        for i, r in enumerate(rows):
            if isinstance(r, dict):
                start = r.get("start", r.get("from", r.get("begin", i)))
                start = seconds(start) if isinstance(start, str) and re.fullmatch(CLOCK, start) else float(start) if isinstance(start, (int, float)) else float(i)
                label, text = str(r.get("speaker") or r.get("name") or ""), str(r.get("text") or r.get("content") or "")
                out.append(Piece(start, label.strip(), text) if label.strip() else Piece(start, *split_label(text)))
        return out
    if head != "" and re.search(r"(?m)^Dialogue:", raw):
        fields = [f.strip().lower() for f in (re.search(r"(?m)^Format:\s*(Layer[^\n]*|Marked[^\n]*)", raw) or [None, "Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text"])[1].split(",")]
        out = []
        for line in re.findall(r"(?m)^Dialogue:\s*(.*)$", raw):
            values = line.split(",", len(fields) - 1)
            if len(values) == len(fields):
                row = dict(zip(fields, values))
                text = re.sub(r"\\[Nnh]", " ", row.get("text", ""))
                start = seconds(row["start"].strip()) if re.fullmatch(CLOCK, row.get("start", "").strip()) else float(len(out))
                name = row.get("name", row.get("actor", "")).strip()
                out.append(Piece(start, name, text) if name else Piece(start, *split_label(text)))
        return out
    out = []
    before: list[str] = []
    last_end = None
    for start, end, lines in timed_lines(raw):
        shown = lines[0] if lines else ""
        if shown and before and shown == before[-1] and (len(lines) > 1 or last_end is not None and abs(last_end - start) <= CARRY):
            lines = lines[1:]  # the line before is shown again, mostly above the new one
        before, last_end = lines or before, end
        first = True
        for line in lines:
            voices = list(VOICE.finditer(line))
            parts = [(v[1].strip(), TAG.sub("", line[v.end() : voices[k + 1].start() if k + 1 < len(voices) else len(line)])) for k, v in enumerate(voices)]
            if not voices or TAG.sub("", line[: voices[0].start()]).strip():
                parts.insert(0, split_label(re.sub(r"^(?:>>|-)\s+", "", TAG.sub("", line[: voices[0].start()] if voices else line).strip())))
            for label, text in parts:
                if label or first or re.match(r"(?:>>|-)\s", line):
                    out.append(Piece(start, label, text))
                else:
                    out[-1].text += " " + text
                first = False
    return out


def timed_lines(raw: str) -> list[tuple[float, float, list[str]]]:
    """(start, end, lines) of the cues of a file, in time order, each once."""
    timings = list(TIMING.finditer(raw))
    found = []
    for i, m in enumerate(timings):
        body = raw[m.end() : timings[i + 1].start() if i + 1 < len(timings) else len(raw)]
        if i + 1 < len(timings):
            body = re.sub(r"\n[^\n]*$", "\n", body) if not body.endswith("\n") else body
            body = re.sub(r"\n\s*\n\s*\S{1,40}\s*$", "\n", body)  # the next cue's name or number
        body = re.split(r"\n[ \t]*\n", body.strip("\n"))[0]
        found.append((seconds(m["a"]), seconds(m["b"]), [x.strip() for x in body.split("\n") if x.strip()]))
    out: list[tuple[float, float, list[str]]] = []
    seen = set()
    for start, end, lines in sorted(found, key=lambda c: (c[0], c[1])):
        if (key := (start, end, tuple(lines))) not in seen:
            seen.add(key)
            out.append((start, end, lines))
    return out


def ordered(pieces: list[Piece]) -> list[Piece]:
    """In time order; cues that are shown again at their time once."""
    out: list[Piece] = []
    seen: set[tuple[float, str, str]] = set()
    for p in sorted(pieces, key=lambda p: p.start):
        key = p.start, p.label.lower(), p.text.strip()
        if key not in seen:
            seen.add(key)
            out.append(p)
    return out


def label_key(label: str) -> tuple[str, ...]:
    """A label's words in one spelling; roles with numbers by the number alone."""
    text = unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", label).casefold())
    text = "".join(c for c in text if not unicodedata.combining(c)).replace("’", "'").strip(" :-–—>[]()")
    m = ROLE.match(text)
    if m:
        return "#", m[2]
    words = [w for w in re.split(r"[\s_.]+", text) if w]
    while len(words) > 1 and words[0] in TITLES:
        words.pop(0)
    return tuple(words)


def same_person(short: tuple[str, ...], full: tuple[str, ...]) -> bool:
    """Whether one spelling may be a short form of the other: part of the words, some only by their first letters."""
    if short == full:
        return True
    if "#" in (short[0], full[0]):
        return False
    if len(short) > len(full):
        short, full = full, short
    if len(short) == len(full):
        return all(a == b or len(a) == 1 and b.startswith(a) or len(b) == 1 and a.startswith(b) for a, b in zip(short, full)) and any(a == b and len(a) > 1 for a, b in zip(short, full))
    at = 0
    for w in short:
        while at < len(full) and not (full[at] == w or len(w) == 1 and full[at].startswith(w)):
            at += 1
        if at == len(full):
            return False
        at += 1
    return any(len(w) > 1 for w in short)


def persons(labels: list[str]) -> tuple[dict[str, list[int]], int]:
    """Which persons each label may be, and how many persons there are."""
    keys = {x: k for x in labels if (k := label_key(x))}
    counts: dict[tuple[str, ...], int] = {}
    for x in labels:
        if x in keys:
            counts[keys[x]] = counts.get(keys[x], 0) + 1
    weight = lambda k: (sum(len(w) > 1 for w in k), sum(map(len, k)))
    heads: list[tuple[str, ...]] = []
    for k in sorted(counts, key=lambda k: (weight(k), counts[k], k), reverse=True):
        if not any(same_person(k, h) for h in heads):
            heads.append(k)
    return {x: [i for i, h in enumerate(heads) if same_person(k, h)] for x, k in keys.items()}, len(heads)


def content(text: str) -> set[str]:
    """The words by which a piece may go on with what was said before."""
    return {w for w in text.lower().split() if len(w) > 3}


def sequence(pieces: list[Piece], may: dict[str, list[int]], n: int) -> Sequence:
    """The pieces as the model sees them."""
    words = [content(p.text) for p in pieces]
    fits = [[0] * n if p.label not in may else [1 if k in may[p.label] else -1 for k in range(n)] for p in pieces]
    near = list(zip(pieces, pieces[1:]))
    return Sequence(
        fits, [0.0, *(min(LONG_PAUSE, max(0.0, q.start - p.start)) / LONG_PAUSE for p, q in near)], [0.0, *(overlap(a, b) for a, b in zip(words, words[1:]))], [0.0, *(0.0 if END.search(p.text) else 1.0 for p, _ in near)]
    )


def labelled_sequence(raw: str) -> tuple[Sequence, int] | None:
    """A caption file's pieces with the persons that its labels name for certain, and how many persons there are."""
    pieces = ordered(caption_pieces(_plain(raw)))
    may, n = persons([p.label for p in pieces if p.label])
    spoken = [p for p in pieces if speech(p.text)]
    if n < 2 or not 2 <= len(spoken) <= TRAIN_PIECES or any(len(k) != 1 for k in may.values()) or not any(p.label in may for p in spoken):
        return None
    s, gold = sequence(spoken, may, n), []
    first = next(may[p.label][0] for p in spoken if p.label in may)
    for p in spoken:
        gold.append(may[p.label][0] if p.label in may else gold[-1] if gold else first)
    s.gold = gold
    return s, n


def fit(captions: DataFrame, column: str = "text", files: int = TRAIN_FILES) -> list[float]:
    """The model's weights, from at most so many labelled files: those with the least hashes of all."""
    hashed = captions.where(has_text(column) & (F.length(column) <= TRAIN_CHARS)).select(F.xxhash64(column).alias("h"), F.col(column).alias("t"))
    texts = dict.fromkeys(r["t"] for r in hashed.orderBy("h", "t").limit(4 * files).collect())
    found = [x for t in texts if (x := labelled_sequence(t))][:files]
    return turn_model.fit([s for s, _ in found], max((n for _, n in found), default=2))


@dataclass
class Turn:
    number: int
    speaker: int
    label: str
    start: float
    text: str


def turns(pieces: list[Piece], weights: list[float] = UNFITTED) -> list[Turn]:
    """Numbered turns; none if fewer than two persons are labelled."""
    pieces = ordered(pieces)
    labels = [p.label for p in pieces if p.label]
    may, n = persons(labels)
    if n < 2:
        return []
    said = [(p, t) for p in pieces if (t := speech(p.text))]
    out: list[Turn] = []
    numbers: dict[int, int] = {}
    for (p, text), k in zip(said, best_persons(sequence([p for p, _ in said], may, n), weights, n)):
        if out and out[-1].speaker == numbers.get(k):
            out[-1].text += " " + text
            continue
        numbers.setdefault(k, len(numbers) + 1)
        out.append(Turn(len(out) + 1, numbers[k], p.label, p.start, text))
    for t in out:
        t.text = without_fillers(t.text)
    return out


def _plain(text: str) -> str:
    return normal_form(text)[0] if needs(text) else text


#: What each piece of a transcript with persons has at its start; the labels are all that split_label knows.
LIKELY = re.compile(r"[0-9][:][0-9]{2}|>>")
LINE_LABEL = re.compile(r"(?m)^[^\S\n]*(?:\[[^\]\n]{1,40}\]|[^\n:–—\[\]()]{1,40}?[ \t]*(?::(?:\s|$)|[ ][–—][ ]))")


def transcript_turns(text: str, weights: list[float] = UNFITTED) -> list[Turn]:
    text = _plain(text)
    if len(LIKELY.findall(text)) < 2 and len(LINE_LABEL.findall(text)) < 2:
        return []
    return turns(marked_pieces(text), weights)


def caption_turns(raw: str, weights: list[float] = UNFITTED) -> list[Turn]:
    return turns(caption_pieces(_plain(raw)), weights)


SCHEMA = "turn_no int, speaker_no int, label string, start double, speech string"


def find_turns(texts: DataFrame, kind: str, weights: list[float], key: str = "video_id", column: str = "text") -> DataFrame:
    """(key, turn_no, speaker_no, label, start, speech) of texts; kind: 'transcript' or 'captions'; weights: of the fitted model."""

    def start() -> Callable[..., list[tuple]]:
        split = transcript_turns if kind == "transcript" else caption_turns

        def kernel(k, text):  # noqa: ANN001, ANN202
            return [(k, t.number, t.speaker, t.label or None, t.start, t.text) for t in split(text, weights)]

        return kernel

    of = dict(texts.dtypes)[key]
    return map_rows(texts.where(has_text(column)), [key, column], start, f"`{key}` {of}, {SCHEMA}")


def path_id(path: Column) -> Column:
    """The video's id in a caption file's path, with either separator."""
    return F.regexp_extract(path, r"([A-Za-z0-9_-]{11})(?:\.[A-Za-z0-9_-]+)*\.[A-Za-z0-9]+$", 1)

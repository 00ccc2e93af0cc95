import re
import unicodedata

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transquill.llm import languages, leaks, lookalikes, markup, mixing, mojibake, repetition, residue, sentences, turn_model, turns
from transquill.llm.rows import map_rows

FRENCH = "La bibliothécaire répare le vieux télescope près de la forêt. Après, l’équipe étudie la carte du ciel à Noël, où le garçon préfère le goûter. Ça n’était pas très loin. "
GERMAN = "Die Bäckerin prüft die alte Tastatur. Das Gartenteam säubert das schiefe Bücherregal mit großer Geduld. Über die Straße führt ein schöner Weg. "
RUSSIAN = "Наш гость чинит старый насос. Местный клуб изучает карту звёздного неба. Ночной сторож переписывает судовой журнал. "
SPANISH = "El mecánico revisa el motor pequeño. ¿Por qué la señora guarda el cuaderno? Según Inés, el niño dibujó otra vez los árboles. "
ENGLISH = "The garden crew cleans the mechanical keyboard. Why would the pilot keep the logbook? After that, our guest writes down every detail. "
CLEAN = [FRENCH * 4, GERMAN * 4, RUSSIAN * 4, SPANISH * 4, ENGLISH * 6] * 5


def model_of(texts):
    one, two, three = (np.zeros(1 << b, np.float32) for b in (mojibake.BITS1, mojibake.BITS2, mojibake.BITS3))
    for order, bucket, n in mojibake._gram_counts([t for t in texts if t and not re.search(mojibake.CLEAN, t)]):
        (one, two, three)[order - 1][bucket] = n
    return mojibake.Model(one, two, three)


MODEL = model_of(CLEAN)
EMPTY = mojibake.Model(*(np.zeros(1 << b, np.float32) for b in (mojibake.BITS1, mojibake.BITS2, mojibake.BITS3)))


# ---- problem 1


@pytest.mark.parametrize(
    ("dirty", "clean", "kind"),
    [
        ("the s\u200bound \u2060editor", "the sound editor", "invisible"), ("a\u00a0b\u2009c\u3000d", "a b c d", "space"), ("Ｗｉｄｅ ２３", "Wide 23", "form"), ("ﬁlm veriﬁed", "film verified", "form"), ("𝐛𝐨𝐥𝐝 ｶﾞﾗｽ", "bold ガラス", "form"),
        ("cafe\u0301", "café", "accent"), ("the s\u043eund", "the sound", "script"), ("К к\u006fнцу", "К концу", "script"), ("and \u0430 lamp here", "and a lamp here", "script"), ("⽔車", "水車", "form"), ("أمین", "أمين", "script"),
    ],
)
def test_lookalikes_get_one_form(dirty, clean, kind):
    assert lookalikes.normal_form(dirty) == (clean, [kind])


@pytest.mark.parametrize("text", ["", " ", "plain text", "m² ½ € № …", "“quotes” – ‘dashes’—…", "你好，世界！（再见）", "👩\u200d🔧 ❤️ 👍🏽", "Для начала работа в CO2", "Привет and hello", "été naïve ñ", "a\nb"])
def test_what_looks_right_stays(text):
    assert lookalikes.normal_form(text) == (text, [])


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_normal_form_settles(text):
    once, _ = lookalikes.normal_form(text)
    assert lookalikes.normal_form(once)[0] == once


def test_garbled_passages_are_no_lookalikes(spark):
    df = spark.createDataFrame([(1, "transcript", "Le matin-lÃ\xa0, la forÃªt"), (2, "title", "a\u200bb"), (3, "title", None), (4, "title", " "), (5, "title", "ok")], "video_id bigint, field string, text string")
    assert [(r["video_id"], r["normal"]) for r in lookalikes.find_lookalikes(df, MODEL).collect()] == [(2, "ab")]


# ---- problem 3


@pytest.mark.parametrize(("original", "decoder"), [("utf-8", "cp1252"), ("utf-8", "cp850"), ("utf-8", "cp437"), ("utf-8", "mac_roman"), ("utf-8", "cp1251"), ("cp1252", "mac_roman"), ("cp1252", "cp850")])
@pytest.mark.parametrize("text", [FRENCH, GERMAN, SPANISH])
def test_garbled_text_comes_back(text, original, decoder):
    bad = mojibake.read_wrongly(text, original, decoder)
    assert bad and bad != text
    assert mojibake.Restorer(MODEL).restore(bad) == text


@pytest.mark.parametrize(("original", "decoder"), [("utf-8", "cp1252"), ("cp1251", "cp1252"), ("koi8-r", "cp1251")])
def test_other_scripts_come_back(original, decoder):
    bad = mojibake.read_wrongly(RUSSIAN.strip(), original, decoder)
    new = mojibake.Restorer(MODEL).restore(bad)
    same = sum(a == b for a, b in zip(new, RUSSIAN))
    assert same > 0.95 * len(RUSSIAN.strip())


def test_twice_garbled_and_partly_garbled():
    r = mojibake.Restorer(MODEL)
    twice = mojibake.read_wrongly(mojibake.read_wrongly(FRENCH, "utf-8", "cp1252"), "utf-8", "cp1252")
    assert r.restore(twice) == FRENCH
    assert r.restore(FRENCH + mojibake.read_wrongly("forêt", "utf-8", "cp1252")) == FRENCH + "forêt"


@pytest.mark.parametrize("text", ["", FRENCH, GERMAN, RUSSIAN, SPANISH, ENGLISH, "ATENÇÃO, NÃO MEXAM", "LES CÂBLES", "Really?? Yes", "the ﬁlm", "l’été « là »…"])
def test_clean_text_is_left_alone(text):
    assert mojibake.Restorer(MODEL).spans(text) == []


def test_lost_letters_count():
    assert [s.chain for s in mojibake.Restorer(MODEL).spans("la for�t et l'ann??e")] == ["lost", "lost"]


def test_without_clean_records_exact_repairs_remain():
    assert mojibake.Restorer(EMPTY).restore("forÃªt") == "forêt"


def test_fit_and_find_in_spark(spark):
    rows = [(i, t) for i, t in enumerate(CLEAN)] + [(100, mojibake.read_wrongly(FRENCH, "utf-8", "cp1252")), (101, None), (102, "  ")]
    df = spark.createDataFrame(rows, "video_id bigint, text string").withColumn("restored", F.lit("clash"))
    found = mojibake.find_garbled(df, mojibake.fit(df)).collect()
    assert [(r["video_id"], r["restored"]) for r in found] == [(100, FRENCH)]
    none = df.where("false")
    assert mojibake.find_garbled(none, mojibake.fit(none)).collect() == []


def test_validated_margin_is_of_the_grid():
    assert mojibake.validated_margin(model_of(CLEAN), [FRENCH, GERMAN]) in (3.0, 4.0, 5.0, 6.0, 8.0, 10.0, 12.0)


# ---- problem 2


def who(ts):
    return [(t.number, t.speaker) for t in ts]


@pytest.mark.parametrize(
    "text",
    [
        "0:01 ANNA BELL: Hello there.\n0:05 tom reed: Um.\n0:06 Anna: And more.\n0:09 T. Reed: Yes, I see.", "(0:01) [Anna Bell] Hello there.\n(0:05) [TOM REED] [music]\n(0:06) [BELL] And more.\n(0:09) [Tom] Yes, I see.",
        ">> Speaker 1: Hello there. >> Speaker 2: (laughter) >> S1: And more. >> SPEAKER_02: Yes, I see.", "Anna Bell (00:00:01)\nHello there.\n\nTOM REED (00:00:05)\nUh...\n\nDr Bell (00:00:06)\nAnd more.\n\nTom (00:00:09)\nYes, I see.",
        "00:00:01,100 spk 0 – Hello there.\n00:00:04,000 And more.\n00:00:09,000 Speaker_01 – Yes, I see.", "[00:00:01] Anna : Hello there. [00:00:09] Tom : Yes, I see.",
    ],
)
def test_turns_of_transcripts(text):
    assert who(turns.transcript_turns(text)) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("text", ["", "Hello.", "[00:00:01] Kurz gesagt: gut. [00:00:05] Hier ist es.", "0:01 Anna: a. 0:05 Anna: b.", "Meet us at 9:30 and at 10:45: we wait.", ">> hello >> you"])
def test_no_turns_without_two_persons(text):
    assert turns.transcript_turns(text) == []


def test_turns_of_caption_files():
    vtt = "WEBVTT\n\n00:00:05.000 --> 00:00:07.000\n<v Tom Reed>I see\n\n00:00:01.000 --> 00:00:03.000\n<v ANNA>Hello\n\n00:00:03.000 --> 00:00:05.000\nthere again\n\n00:00:01.000 --> 00:00:03.000\n<v ANNA>Hello\n"
    srt = "1\n00:00:01,000 --> 00:00:02,000\nAnna: Hello\n\n2\n00:00:03,000 --> 00:00:04,000\nTom: I see\nTOM: more\n"
    js = '{"segments": [{"start": 3.5, "speaker": "b", "text": "I see"}, {"start": 1, "speaker": "a", "text": "Hello"}, {"start": 2, "speaker": null, "text": "there"}]}'
    ass = "[Script Info]\n\n[Events]\nFormat: Layer, Start, End, Style, Name, MarginL, MarginR, MarginV, Effect, Text\nDialogue: 0,0:00:01.00,0:00:02.00,Default,Anna,0,0,0,,Hello, you\nDialogue: 0,0:00:03.00,0:00:04.00,Default,Tom,0,0,0,,I see"
    for raw in (vtt, srt, js, ass):
        assert who(turns.caption_turns(raw)) == [(1, 1), (2, 2)], raw
    assert [t.text for t in turns.caption_turns(vtt)] == ["Hello there again", "I see"]
    assert turns.caption_turns("{broken") == [] and turns.caption_turns("") == []


weight_lists = st.lists(st.floats(-8, 8), min_size=15, max_size=15)


@given(st.lists(st.tuples(st.sampled_from(["Anna Bell", "Tom Reed", "Bell", "", "Eve"]), st.sampled_from(["Yes.", "and so", "No!", "and so on"])), min_size=1, max_size=7), weight_lists)
@settings(max_examples=80, deadline=None)
def test_turn_sequence_is_the_best(items, weights):
    from itertools import product

    pieces = [turns.Piece(float(3 * i), a, b) for i, (a, b) in enumerate(items)]
    may, n = turns.persons([p.label for p in pieces if p.label])
    if n < 2:
        return
    s = turns.sequence(pieces, may, n)
    best = max(turn_model.score(s, weights, list(who)) for who in product(range(n), repeat=len(pieces)))
    assert turn_model.score(s, weights, turn_model.best_persons(s, weights, n)) == pytest.approx(best, abs=1e-6)


@given(st.lists(st.sampled_from([[1, -1], [-1, 1], [0, 0]]), min_size=9, max_size=13), weight_lists)
@settings(max_examples=15, deadline=None)
def test_long_turns_are_scored_as_wholes(fits, weights):
    from itertools import product

    s = turn_model.Sequence(fits, [0.1] * len(fits), [0.2] * len(fits), [1.0] * len(fits))
    best = max(turn_model.score(s, weights, list(who)) for who in product(range(2), repeat=len(fits)))
    assert turn_model.score(s, weights, turn_model.best_persons(s, weights, 2)) == pytest.approx(best, abs=1e-6)


def test_fitted_weights_have_the_greatest_conditional_likelihood(monkeypatch):
    from itertools import product

    rng = np.random.default_rng(5)
    sequences = []
    for _ in range(8):
        gold = np.cumsum(rng.random(5) < 0.4) % 2
        fits = [[0, 0] if j and gold[j] == gold[j - 1] and rng.random() < 0.5 else [1 if k == gold[j] else -1 for k in (0, 1)] for j in range(5)]
        sequences.append(turn_model.Sequence(fits, *([0.0, *rng.random(4).tolist()] for _ in range(3)), gold.tolist()))

    def likelihood(w):
        total = -sum(x * x for x in w) / (2 * turn_model.VARIANCE)
        for s in sequences:
            all_scores = [turn_model.score(s, w, list(who)) for who in product(range(2), repeat=5)]
            total += turn_model.score(s, w, s.gold) - np.logaddexp.reduce(all_scores)
        return total

    monkeypatch.setattr(turn_model, "STEPS", 400)
    monkeypatch.setattr(turn_model, "RATE", 0.2)
    w = turn_model.fit(sequences, 2)
    slopes = [(likelihood([x + 1e-4 * (i == j) for i, x in enumerate(w)]) - likelihood(w)) / 1e-4 for j in range(15)]
    assert np.abs(slopes).max() < 0.02 and likelihood(w) > likelihood(turn_model.UNFITTED.tolist())
    assert turn_model.fit([], 2) == turn_model.UNFITTED.tolist()


def test_turns_of_held_out_files(spark):
    """Weights fitted on some files give the labelled persons of others, whose labels are partly taken away."""
    rng = np.random.default_rng(8)
    files = []
    for i in range(60):
        lines, who = [], 0
        for j in range(14):
            fresh = j == 0 or rng.random() < 0.5
            who = (who + 1) % 2 if fresh and j else who
            label = ("Anna Bell: ", "Tom Reed: ")[who] if fresh else ""
            lines.append(f"00:00:{3 * j:02d}.000 --> 00:00:{3 * j + 2:02d}.000\n{label}sentence number {j} of file {i} is said.")
        files.append(("WEBVTT\n\n" + "\n\n".join(lines),))
    weights = turns.fit(spark.createDataFrame(files[:30], "text string"))
    assert weights != turns.UNFITTED
    for (raw,) in files[30:]:
        s, n = turns.labelled_sequence(raw)
        assert turn_model.best_persons(s, weights, n) == s.gold


# ---- problem 4


@pytest.mark.parametrize("text", ["Welcome to {{ channel.name }}.", "Hello ${GUEST}!", "See <%= body %>.", "%NAME% here", "from @@HOST@@", "on $$DATE$$ we", "__TITLE__ is", "Hi {first_name}", "I am {0}.", "by [INSERT NAME HERE]", "Merci à [votre texte ici]", "[[TO BE COMPLETED]]", "{% block x %}", "at %s.", "[object Object]"])
def test_unfilled_placeholders(text):
    assert residue.holes(text)


@pytest.mark.parametrize("text", ["", "```\necho ${X} {0} %s\n```", '<pre><code>print(f"{x}")</code></pre>', "`{{x}}` is code", "\\frac{a}{b} $x_{2}$", "[[Page|label]] {{Infobox|a=1}}", "100 % sure", "[Music] [inaudible]", "__bold__ word", "write the placeholder {{name}} in it"])
def test_no_placeholders(text):
    assert not residue.holes(text)


def test_filler_and_notices():
    assert residue.fillers("So. Lorem ipsum dolor sit amet consectetur elit. Then.") and residue.fillers("Your transcript goes here.")
    assert not residue.fillers("The designer fills the draft with lorem ipsum and leaves.")
    for text in ("This page needs JavaScript. Turn on scripts and reload.", "Talk.\n\nErreur 403. Vous n'avez pas le droit d'ouvrir cette ressource. Référence 198e46163dc0.", "Too many requests were sent from your network. Wait 3 minutes.", "このページの表示にはJavaScriptが必要です。"):
        assert residue.notices(text), text
    for text in ("The server answers 404 when the page is gone, and that is fine.", "She explains that access denied messages scare people away.", "In this lesson we show why a page without JavaScript stays readable.", ""):
        assert not residue.notices(text), text


# ---- problem 5


def brute_share(words, size=8):
    marked = set()
    for i in range(len(words) - size + 1):
        if any(words[j : j + size] == words[i : i + size] for j in range(i)):
            marked |= set(range(i, i + size))
    return len(marked) / len(words) if words else 0.0


@given(st.lists(st.sampled_from("ab"), max_size=60))
@settings(max_examples=200, deadline=None)
def test_repeated_share_equals_brute_force(words):
    assert repetition.repeated_share(" ".join(words)) == pytest.approx(brute_share(words))


def test_repeated_share_ignores_case_and_edges_and_counts_characters():
    base = "one two three four five six seven eight"
    assert repetition.repeated_share(base + ". " + base.upper() + "!") == 0.5
    assert repetition.repeated_share("天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往" * 2) == 0.5
    assert repetition.repeated_share("") == 0.0


def test_hosts_are_shrunk_and_joined(spark):
    loop = "we say the same eight words again now " * 6
    rows = [(i, i % 2, loop if i % 4 == 1 else f"text number {i} says something of its own") for i in range(40)] + [(100, None, loop), (101, 1, None), (1, 1, loop)]
    df = spark.createDataFrame(rows, "video_id bigint, host int, text string")
    out = {r["video_id"]: r for r in repetition.judge(repetition.measure(df, EMPTY)).collect()}
    assert len(out) == 41 and out[1]["failed"] == ["runs"] and out[0]["failed"] == []
    assert out[1]["host_docs"] == 20 and out[1]["host_failed"] == 10 and 0.3 < out[1]["host_rate"] < 0.6 and out[100]["host_docs"] == 1
    assert repetition.judge(repetition.measure(df.where("false"), EMPTY)).count() == 0
    assert repetition.beta_prior(None, None, None) == (1.0, 1.0)


# ---- problem 6


@pytest.fixture(scope="module")
def who_speaks(spark):
    rows = [(c, t * 4) for c, t in (("fr", FRENCH), ("de", GERMAN), ("ru", RUSSIAN), ("es", SPANISH), ("en", ENGLISH))] * 3
    return languages.Identifier(languages.fit(spark.createDataFrame(rows, "code string, text string")))


def test_languages_of_single_and_mixed_texts(who_speaks):
    texts = [FRENCH, ENGLISH + FRENCH, RUSSIAN + ENGLISH, ENGLISH + "La bibliothécaire répare le vieux télescope près de la forêt.", "", "♪", "ในตอนนี้ทีมสวนผักตรวจสอบสมุดบันทึก"]
    got = [langs for _, langs, _ in who_speaks.languages(texts)]
    assert got == [["fr"], ["en", "fr"], ["en", "ru"], ["en"], [], [], ["th"]]


def test_confidence_and_segments(who_speaks):
    _, _, parts = who_speaks.languages([ENGLISH + FRENCH])[0]
    assert [p[0] for p in parts] == ["en", "fr"] and all(0.5 < p[3] <= 1 for p in parts)


def test_labels_name_one_language(spark):
    df = spark.createDataFrame([("fr-orig",), ("English",), ("es-419",), ("zh-Hans",), ("auto",), ("fr,en",), ("",), (None,), ("FR",), ("deu",)], "l string")
    assert [r[0] for r in df.select(languages.label(F.col("l"))).collect()] == ["fr", "en", "es", "zh", None, None, None, None, "fr", "de"]


def test_false_positives_are_taken_off():
    rng = np.random.default_rng(1)
    f = languages.Filters(rng.integers(0, 2, (2, 1 << languages.BITS)).astype(np.uint16))
    assert abs(f.votes([" ".join("".join(chr(97 + x) for x in rng.integers(0, 26, 7)) for _ in range(3000))])[0][0, 0]) < 0.05


def test_purified_text_has_no_markup_or_placeholders():
    r = mojibake.Restorer(MODEL)
    assert languages.pure(*r.restored(["[Music] {{ name }} <b>été</b> 0:12 forÃªt"])).split() == ["été", "forêt"]


# ---- problem 7


def brute_cut(costs, edges):
    from itertools import product

    return min(sum(c[1] if m else c[0] for c, m in zip(costs, x)) + sum(w for a, b, w in edges if x[a] != x[b]) for x in product((False, True), repeat=len(costs)))


@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=1, max_size=7), st.data())
@settings(max_examples=150, deadline=None)
def test_minimum_cut_equals_brute_force(costs, data):
    costs = [(float(a), float(b)) for a, b in costs]
    n = len(costs)
    edges = data.draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 5)), max_size=8))
    edges = [(a, b, float(w)) for a, b, w in edges if a != b]
    got = markup.min_cut(costs, edges)
    assert sum(c[1] if m else c[0] for c, m in zip(costs, got)) + sum(w for a, b, w in edges if got[a] != got[b]) == brute_cut(costs, edges)


@pytest.mark.parametrize(
    ("text", "clean", "kinds"),
    [
        ("<h2>Title</h2>\n<p>One &amp; two</p><ul><li>a</li><li>b</li></ul>", "## Title\n\nOne & two\n\n- a\n- b", ["html"]), ("Say **it** and [go](https://x.example/a).", "Say it and go.", ["markdown"]),
        ("== Head ==\n'''Bold''' [[Page|word]]", "## Head\nBold word", ["wiki"]), ("\\section{One}\n\\begin{itemize}\n\\item a\n\\end{itemize}\n$\\frac{1}{2}$", "# One\n\n\n- a\n\n$\\frac{1}{2}$".replace("\n\n\n", "\n\n"), ["latex"]),
        ("```\nx = [1]\n```\n# Head\ntext", "```\nx = [1]\n```\n# Head\ntext", ["markdown"]), ("<script>var x;</script><p>Yes</p>", "Yes", ["html"]),
    ],
)
def test_markup_becomes_clean_text(text, clean, kinds):
    got, found = markup.clean(text)
    assert found == kinds and [x.strip() for x in got.split("\n") if x.strip()] == [x.strip() for x in clean.split("\n") if x.strip()]


@pytest.mark.parametrize("text", ["", "They paid $5 here and $12 there.", "1. First\n2. Second", "[Music] (laughter)", ">> Anna: hello", "It was 3 * 4 * 5 = 60", "file_name_here.txt and a_b", "{{ name }} and __TITLE__ and $$DATE$$", "#5 is 20 < 30", "C:\\Users\\me"])
def test_ordinary_signs_are_no_markup(text):
    assert markup.clean(text) == (text, [])


# ---- problem 8

ITEM = "In the prisms of Roquine keeper Kaoslin counted 354 barrels beside the Stanevan lock during week 503 while Tribelvan guarded"
JA = "ウミマロソラエルの倉庫でソラトルシンドリは蝶番を549個数え、船に載せました。"


@pytest.mark.parametrize(
    ("text", "hit"),
    [
        ("So: IN THE PRISMS of Roquine, keeper Kaoslin counted 354 barrels beside the end", True), ("in the prisms of Roquine keeper XX counted 354 barrels beside the", True), ("in the prisms of Roquine keeper counted 354 barrels beside the", True),
        ("in the prisms of Roquine keeper Kaoslin well counted 354 barrels beside the", True), ("in the prisms of Roquine keeper Kaoslin counted [0:12] 354 barrels beside the", True), ("in the prisms of Roquine keeper Kaoslin counted 354 barrels", False),
        ("in the X of Roquine keeper Kaoslin X 354 barrels beside the Stanevan X", False), ("", False),
    ],
)
def test_leaks_of_words(text, hit):
    assert bool(list(leaks.Items([(1, ITEM)]).leaks([(9, text)]))) is hit


def test_leaks_of_characters_and_in_spark(spark):
    assert list(leaks.Items([(2, JA)]).leaks([(9, "x " + JA[3:26] + " y")]))[0][:2] == (9, 2)
    assert not list(leaks.Items([(2, JA)]).leaks([(9, JA[3:20])]))
    docs = spark.createDataFrame([(1, "x " + ITEM), (2, None), (3, ""), (4, "no"), (5, ITEM + " " + ITEM)], "doc_id bigint, text string").withColumn("item_id", F.lit(7))
    items = spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, "too short")], "item_id bigint, text string")
    assert sorted(tuple(r)[:2] for r in leaks.find_leaks(docs, items).collect()) == [(1, 1), (1, 2), (5, 1), (5, 2)]
    assert leaks.find_leaks(docs, items.where("false")).count() == 0


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3))
@settings(max_examples=100, deadline=None)
def test_index_misses_nothing_within_the_radius(fingerprint, flips):
    other = fingerprint
    for b in flips:
        other ^= 1 << b
    index = leaks.Index(np.array([other], np.uint64))
    assert len(index.within(np.array([fingerprint], np.uint64))[0]) == 1


# ---- problem 9


def test_shares_meet_their_targets(spark):
    rows = [(i, ("rot blau grün " if i % 3 == 0 else "red blue green ") * (5 + i % 7), None if i % 11 == 0 else [" A ", "a", "b"][i % 3] if i % 3 < 2 else "B") for i in range(300)] + [(900, None, "A"), (901, "  ", "B"), (902, "red", "zzz")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([("A", 0.5, 2), ("B", 0.3, 4), ("Empty", 0.2, 3)], "source string, target_share double, max_repeats int")
    used, shares = mixing.mix(docs, weights)
    got = {r["source"]: r for r in shares.collect()}
    assert got["Empty"]["actual_share"] == 0 and abs(got["A"]["actual_share"] - 0.625) < 0.02 and abs(got["B"]["actual_share"] - 0.375) < 0.02
    caps = {"A": 2, "B": 4}
    assert all(0 < r["repeats"] <= caps[r["source"]] for r in used.collect())
    none = mixing.mix(docs.where("false"), weights)
    assert none[0].count() == 0 and none[1].agg(F.sum("tokens")).first()[0] == 0


# ---- problem 10


def ends(text):
    return [text[a:e] for a, e in sentences.sentences(text, sentences.Model())]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Dr. Ash paid 3.50 at 9 a.m. today. Then she left!", ["Dr. Ash paid 3.50 at 9 a.m. today.", "Then she left!"]), ('"I lost it!" says Eve. Yes.', ['"I lost it!" says Eve.', "Yes."]), ("J. K. Nelo hesitates... and goes. So?", ["J. K. Nelo hesitates... and goes.", "So?"]),
        ("Head\n\n1. First one.\n2. Next\nline.", ["Head", "1. First one.", "2. Next\nline."]), ("彼は「だめ。困った！」と言う。次に、行く。", ["彼は「だめ。困った！」と言う。", "次に、行く。"]), ("One is done.Two is next.", ["One is done.", "Two is next."]), ("", []), ("   \n ", []), ("no mark", ["no mark"]),
        ("--- VIDEO: A b. C (2024) u ---\n\nText.", ["--- VIDEO: A b. C (2024) u ---", "Text."]), ("वह आता है। वह जाता है।", ["वह आता है।", "वह जाता है।"]),
    ],
)
def test_sentences(text, want):
    assert ends(text) == want


@given(st.text(alphabet=st.sampled_from("aB .!?\n\"«»。ก"), max_size=80))
@settings(max_examples=300, deadline=None)
def test_units_cover_the_text(text):
    spans = sentences.sentences(text, sentences.Model())
    assert "".join(text[a:e] for a, e in spans).replace(" ", "").replace("\n", "") == text.replace(" ", "").replace("\n", "")
    assert all(text[a:e] == text[a:e].strip() and a < e for a, e in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


@given(st.lists(st.tuples(st.integers(1, 150), st.floats(-6, 8)), min_size=1, max_size=9), st.integers(1, 80))
@settings(max_examples=150, deadline=None)
def test_spans_are_the_best(steps, last):
    from itertools import combinations
    from math import log

    ends, at = [], 0
    for n, _ in steps:
        at += n
        ends.append(at)
    size, gains = at + last, [g for _, g in steps]
    text = "a" * size

    def score(chosen):
        points = [0, *(ends[i] for i in chosen), size]
        spans = sum(-0.5 * ((log(b - a) - sentences.TYPICAL) / sentences.SPREAD) ** 2 - (2.5 if b - a < 3 else 0.0) for a, b in zip(points, points[1:]))
        return spans + sum(gains[i] for i in chosen)

    got = sentences._best(text, 0, size, ends, gains, [0.0] * len(ends))
    best = max(score(c) for k in range(len(ends) + 1) for c in combinations(range(len(ends)), k))
    assert score([ends.index(e) for e in got[:-1]]) == pytest.approx(best)


def test_sentences_in_spark(spark):
    df = spark.createDataFrame([(1, "One. Two is here. Three."), (2, None), (3, " ")], "doc_id bigint, text string").withColumn("sentence_no", F.lit(0))
    got = sorted((r["doc_id"], r["end_char"]) for r in sentences.split_documents(df, sentences.fit(df)).collect())
    assert got == [(1, 4), (1, 17), (1, 24)]
    assert sentences.split_documents(df.where("false"), sentences.fit(df.where("false"))).count() == 0


def test_map_rows_handles_many_and_no_rows(spark):
    df = spark.range(10_000)
    assert map_rows(df, ["id"], lambda: lambda i: [(i, str(i))] * (i % 3), "i bigint, s string").count() == 9999


def test_very_long_texts():
    long = (ENGLISH + FRENCH) * 400
    assert sentences.sentences(long, sentences.Model()) and repetition.repeated_share(long) > 0.9
    assert not residue.residue(long) and markup.clean(long)[1] == [] and not mojibake.Restorer(MODEL).spans(long) and lookalikes.normal_form(long)[1] == []
    assert unicodedata.is_normalized("NFC", lookalikes.normal_form(long)[0])

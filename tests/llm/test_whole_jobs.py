"""Cases that shortcuts in front of the operators' work once lost."""

import re

import numpy as np
import pytest

from test_problems import ENGLISH, FRENCH, GERMAN, MODEL, SPANISH, model_of, who_speaks  # noqa: F401
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from transquill.llm import lookalikes, markup, mojibake, residue, sentences, turns

# ---- problem 3


def test_margin_sees_false_finds_in_clean_records(monkeypatch):
    model = model_of([FRENCH, GERMAN, SPANISH] * 5)
    wrong = mojibake.Span(0, 1, "x", "utf-8>cp1252")
    monkeypatch.setattr(mojibake.Restorer, "utf8", lambda self, text, depth=mojibake.DEPTH: [(9.0, wrong)] if self.model.margin < 8.0 else [])
    assert mojibake.validated_margin(model, [FRENCH, GERMAN, SPANISH]) >= 8.0


def test_margin_is_tried_on_all_chains_and_on_the_gates_signs():
    seen = mojibake.garblings("là forêt où")
    assert {f"là {mojibake.read_wrongly('forêt', o, d)} où" for o, d in (("utf-8", "cp1252"), ("utf-8", "cp850"), ("utf-8", "cp1251"), ("cp1252", "mac_roman"), ("cp1252", "cp850"))} <= set(seen)
    assert any(re.search(mojibake.GATE, w) for w in mojibake.right_writings(FRENCH))


def test_held_records_come_from_all_rows_and_are_whole(spark):
    rows = [(f"plain text number {i}",) for i in range(1500)] + [(FRENCH * 4,)] * 2 + [(GERMAN * 4,), ("forÃªt",), (None,)]
    df = spark.createDataFrame(rows, "text string").coalesce(1)
    assert sorted(mojibake.held_records(df, "text", 60).values()) == sorted([FRENCH * 4, GERMAN * 4])
    garbled = spark.createDataFrame([(f"forÃªt {i}",) for i in range(100)] + [(FRENCH,)], "text string")
    assert list(mojibake.held_records(garbled, "text", 2).values()) == [FRENCH]


def test_margin_is_tried_on_all_words_of_all_records(spark, monkeypatch):
    words = ["forêt", "goûter", "télescope", "équipe", "garçon"]
    rows = [(f"La {words[i % 5]} numéro {i} est près du {words[(i + 2) % 5]} de Noël.",) for i in range(150)] + [("forÃªt",), (None,), ("plain",)]
    df = spark.createDataFrame(rows, "text string").repartition(3)
    seen = []
    monkeypatch.setattr(mojibake, "best_margin", lambda tries: seen.append(tries) or 5.0)
    model = mojibake.fit(df)
    halves = ([], [])
    for r in df.where("text is not null and text != 'forÃªt'").select("text", F.xxhash64("text").alias("h")).collect():
        halves[r["h"] & 1].append(r["text"])
    expected = mojibake.Counter()
    for own, other in (halves, halves[::-1]):
        for mark, passages in zip((mojibake.RIGHT, mojibake.TO_GARBLE), mojibake.passages_of(own)):
            expected.update(mojibake.tries_of(mojibake.Restorer(model_of(other)), mark, passages))
    assert all(halves) and seen == [+expected] and seen[0][mojibake.TO_GARBLE, mojibake.RECORDS] == 150
    assert sum(n for (mark, _), n in seen[0].items() if mark == mojibake.RIGHT) >= 150 * 5 * 5
    whole = model_of(halves[0] + halves[1])
    assert model.margin == 5.0 and all(abs(getattr(model, x).sum() - getattr(whole, x).sum()) < 200 for x in ("one", "two", "three"))


def test_margin_heeds_records_beyond_those_of_least_hashes(spark):
    both = spark.range(400).select(F.explode(F.array(F.concat(F.lit("Le numéro "), "id", F.lit(" est là, près de la forêt.")), F.concat(F.lit("Он был В "), "id", F.lit(" В доме.")))).alias("text"))
    french, low = F.col("text").startswith("Le"), F.xxhash64("text") < -(5 << 60)
    few = both.where(french & low)
    assert few.count() > 60 and mojibake.fit(few).margin == 6.0  # no margin is better than another
    assert mojibake.fit(few.unionByName(both.where(~french & ~low))).margin == 4.0  # a garbled "В" is missed from 5 on


def test_passages_have_each_word_and_what_a_trigram_sees_of_its_neighbours():
    right, middle = mojibake.passages_of(["là forêt, où", "plain", "l’été à Noël"])
    assert right == {"\n\nlà f": 1, "à forêt, ": 1, ", où\n\n": 1, "l’été à": 1, "é à N": 1, "à Noël\n\n": 1}
    assert middle == {"à forêt, ": 1, "é à N": 1}
    assert f"à {mojibake.read_wrongly('forêt', 'utf-8', 'cp1252')}, " in mojibake.garblings("à forêt, ", (2, 7))


SOUP = st.text(st.sampled_from("aéÃ©â€™ ЖЯпрРСѓ.\n-«»”…аАБВк–¿ﬂÑ°¸\x85"), max_size=14)


@given(SOUP, st.sampled_from([3.0, 12.0]))
@settings(max_examples=300, deadline=None)
def test_trials_say_what_the_finder_says(text, margin):
    r = mojibake.Restorer(MODEL)
    r.model = mojibake.Model(MODEL.one, MODEL.two, MODEL.three, margin)
    found = bool(r.judged(text))
    assert r.finds(text) == found
    assert mojibake.may_be_found([text, "plain", text])[0::2] == [True, True] or not found


@given(st.lists(SOUP, min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_trials_of_many_texts_say_what_the_finder_says_at_each_margin(texts):
    r = mojibake.Restorer(mojibake.Model(MODEL.one, MODEL.two, MODEL.three))

    def found(text, margin):
        r.model.margin = margin
        return r.finds(text)

    assert mojibake.passed_together(r, texts) == [sum(found(t, m) for m in mojibake.GRID) for t in texts]


def test_most_garbled_words_are_found_without_all_other_chains(monkeypatch):
    searched = []
    finds, utf8 = mojibake.Restorer.finds, mojibake.Restorer.utf8
    monkeypatch.setattr(mojibake.Restorer, "finds", lambda self, text: searched.append(text) or finds(self, text))
    monkeypatch.setattr(mojibake.Restorer, "utf8", lambda self, text, depth=mojibake.DEPTH: (depth == mojibake.DEPTH and searched.append(text)) or utf8(self, text, depth))
    russian = "Сегодня мы расскажем о том, как в нашем городе собирали урожай яблок. "
    model = model_of([FRENCH, GERMAN, SPANISH, russian] * 50)
    _, middle = mojibake.passages_of([FRENCH, GERMAN, SPANISH, russian])
    tries = mojibake.tries_of(mojibake.Restorer(model), mojibake.TO_GARBLE, middle)
    searches = len(searched)
    expected = mojibake.Counter({(mojibake.TO_GARBLE, mojibake.RECORDS): 4})
    for p, n in middle.items():
        for w in mojibake.garblings(p, (2, len(p) - 2)):
            k = 0
            for m in mojibake.GRID if re.search(mojibake.GATE, w) else ():
                k += bool(mojibake.Restorer(mojibake.Model(model.one, model.two, model.three, m)).judged(w))
            expected[mojibake.TO_GARBLE, k] += n
    writings = sum(n for (_, k), n in tries.items() if k >= 0)
    assert tries == expected and searches < 0.6 * writings, (searches, writings)


@given(st.lists(SOUP, min_size=1, max_size=6))
@settings(max_examples=300, deadline=None)
def test_runs_are_sought_by_sets_without_ascii_letters(texts):
    for k, run in mojibake.RUN_BITS + mojibake.SIGN_RUNS:
        assert 0 <= k < len(run)
    for table, runs in ((mojibake.CLASSES, mojibake.RUN_BITS), (mojibake.SIGN_CLASSES, mojibake.SIGN_RUNS)):
        letters = table[[ord(c) for c in "abcxyzABCXYZ"]]
        assert not any((letters & np.uint32(run[k])).any() for k, run in runs)
        bits = table[[ord(c) for c in "\n".join(texts)]]
        expected = {i for _, run in runs for i in range(len(bits) - len(run) + 1) if all(bits[i + j] & np.uint32(x) for j, x in enumerate(run))}
        assert set(mojibake.begun(bits, runs).tolist()) == expected
    gate = re.compile(mojibake.GATE)
    assert mojibake.gated(texts) == [bool((not t.isascii() or "??" in t) and gate.search(t)) for t in texts]


# ---- problem 2


@pytest.mark.parametrize("text", ["Anna: Hello there.\nBen: Yes, I see.\nAnna: And more.", "Anna: Hello there.\nBen: Yes, I see.", "[Anna] Hello there.\n[Ben] Yes, I see.", "Anna – Hello there.\nBen – Yes, I see.", "Anna： Hello there.\nBen： Yes, I see."])
def test_short_dialogues_have_turns(text):
    assert [t.speaker for t in turns.transcript_turns(text)] == [1, 2, 1][: text.count("\n") + 1]


@pytest.mark.parametrize("text", ["Anna: Hello there.\nAnna: And more.", "Note: this is one.\nQuestion: what is it?", "The rule is this: go.\nIn short: stay.", "[Music]\n[Applause]"])
def test_phrases_are_no_short_dialogues(text):
    assert turns.transcript_turns(text) == []


# ---- problem 4


def examples(pattern):
    """Texts that the pattern's syntax tree gives: every branch, and every repetition as few times as may be."""
    op = residue.sre_parse

    def of(tree):
        out = [""]
        for kind, value in tree:
            if kind is op.LITERAL:
                more = [chr(value)]
            elif kind is op.SUBPATTERN:
                more = of(value[3])
            elif kind is op.BRANCH:
                more = [x for b in value[1] for x in of(b)]
            elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
                more = [x * value[0] for x in of(value[2])] if value[0] else ["", *of(value[2])]
            elif kind is op.IN:
                more = [chr(value[0][1]) if value[0][0] is op.LITERAL else "7" if value[0][0] is op.RANGE or "DIGIT" in str(value[0][1]) else " " if "SPACE" in str(value[0][1]) else "w"]
            else:
                more = [" "] if kind is op.ANY else [""]
            out = list(dict.fromkeys(a + b for a in out for b in more))[:4000]
        return out

    return [x for x in dict.fromkeys(of(op.parse(pattern))) if re.fullmatch(pattern, x, re.IGNORECASE)]


@pytest.mark.parametrize(("patterns", "at"), [(residue.FILLER, residue.FILLER_AT), (residue.STRONG + residue.WEAK, residue.PAGE_AT)])
def test_every_alternative_passes_its_prefilter(patterns, at):
    for p in patterns:
        texts = examples(p)
        assert texts or "<title>" in p, p
        assert all(next(at.iter(x.lower()), None) for x in texts), p


def test_every_placeholder_passes_its_prefilter():
    for x in ("{{ a }}", "{% block x %}", "${A}", "#{a}", "{0}", "<%= body %>", "<?= $x ?>", "%NAME%", "%s", "%1$s", "%(name)s", "@@HOST@@", "@FIRST_NAME@", "$$DATE$$", "__TITLE__", "*|NAME|*", "[%name%]", "<FIRST NAME>", "<insert name>", "[INSERT NAME]"):
        assert residue.holes(f"So {x} it is."), x


@pytest.mark.parametrize("text", ["Placeholder text.", "placeholder transcript", "Your transcript goes  here."])
def test_fillers_once_lost(text):
    assert residue.fillers(text)


@pytest.mark.parametrize("text", ["Something broke on our side.", "403 Forbidden. Wait 5 minutes.", "Code: 198e46163dc0. Go back to the home page."])
def test_notices_once_lost(text):
    assert residue.notices(text)


# ---- problem 7


@pytest.mark.parametrize(("text", "kind"), [("So $E = mc^2$ holds.", "latex"), ("$$E = mc^2$$", "latex"), ("A title\n---\nand text", "markdown"), ("Things:\n  - one\n  - two\n  - three", "markdown"), ("! Name !! Year\nand text", "wiki")])
def test_markup_is_hinted(text, kind):
    assert markup.hinted(text) and markup.clean(text)[1] == [kind]


def test_examples_of_each_grammar_are_hinted():
    of = {
        "comment": "<!-- a -->", "tag": "<b>", "entity": "&amp;", "fence": "```\na\n```", "image": "![a](b)", "link": "[a](/b)", "code": "`a`", "rule_row": "|---|", "row": "| a |", "heading": "# A", "setext": "A\n---", "strong": "**a**", "strong_": "__a__", "strike": "~~a~~", "emph": "_a_", "quote": "> a", "dash": "   + a",
        "bullet": " * a", "hr": "- - -", "title": "== A ==", "bold": "'''a'''", "italic": "''a''", "page": "[[a]]", "template": "{{A|b}}", "table": "{| a", "cells": "! a", "site": "[https://a b]", "magic": "__TOC__", "display": "$$a =\nb$$", "math": "$a + b ^2 = x_1$", "env": "\\begin{a}", "ref": "\\ref{a}", "command": "\\a{b}", "item_tex": "\\item a", "bare": "\\alpha",
    }
    for name, _, pattern in markup.GRAMMAR:
        if name != "number":  # numbering alone is no markup
            assert pattern.search(of[name]) and markup.hinted(of[name]), name


# ---- problem 6


@pytest.mark.parametrize("between", [" ", "\n"])
def test_two_short_foreign_sentences_are_seen(who_speaks, between):
    text = ENGLISH + between.join(["L’équipe étudie.", "Ça n’était pas loin.", ENGLISH])
    assert who_speaks.languages([text])[0][1] == ["en", "fr"]
    assert who_speaks.languages([ENGLISH + "L’équipe étudie. " + ENGLISH])[0][1] == ["en"]


# ---- problem 1


@pytest.mark.parametrize(("dirty", "clean"), [("Наш гοсть чинит насос", "Наш гость чинит насос")])
def test_cyrillic_with_greek_and_no_latin_letters(spark, dirty, clean):
    df = spark.createDataFrame([(1, "title", dirty), (2, "title", clean)], "video_id bigint, field string, text string")
    assert lookalikes.needs(dirty) and not lookalikes.needs(clean)
    assert [(r["video_id"], r["normal"], r["kinds"]) for r in lookalikes.find_lookalikes(df, MODEL).collect()] == [(1, clean, ["script"])]


# ---- problems 9, 8, 6, 5: fitted rates, item-sized windows, votes within a script, verdicts of hosts


def test_fitted_rates_are_the_least_squares_ones():
    from transquill.llm import mixing

    rng = np.random.default_rng(3)
    n, docs = 3, 40
    tokens = rng.integers(10, 200, docs).astype(float)
    post = rng.dirichlet(np.ones(n) * 0.5, docs)
    sure, cap = np.array([2000.0, 900.0, 1500.0]), np.array([2.0, 3.0, 1.0])
    soft = sure + tokens @ post
    goal = np.array([1800.0, 2100.0, 700.0])
    expected = lambda start, steps: (mixing.open_rates(post, np.full(docs, 1.0), start, steps) * tokens) @ post
    start, steps, got = mixing.fit_rates(sure, soft, goal, cap, expected)
    # plain projected gradient descent with tiny steps over all variables, in which the labelled tokens are single documents
    a = np.concatenate([np.diag(sure), (post * tokens[:, None]).T], axis=1) / np.sqrt(soft)[:, None]
    top, x = np.concatenate([cap, np.ones(docs)]), np.zeros(n + docs)
    lipschitz = np.linalg.norm(a, 2) ** 2
    for _ in range(200_000):
        x = np.clip(x - a.T @ (a @ x - goal / np.sqrt(soft)) / lipschitz, 0, top)
    best = ((a @ x - goal / np.sqrt(soft)) ** 2).sum()
    assert (((got - goal) ** 2) / soft).sum() <= best + 1e-3 * goal.sum() and (got >= 0).all()


def test_whole_items_with_many_edits_are_near_copies_without_a_passage():
    from transquill.llm import leaks

    item = " ".join(f"word{i} and" for i in range(60)).split()
    doc = list(item)
    doc[::11] = ["other"] * len(doc[::11])  # no twelve words on end with one edit, yet most of the item
    found = list(leaks.Items([(1, " ".join(item))]).leaks([(7, "before it all " + " ".join(doc) + " after it")]))
    assert not found or found[0][2] in (0, *range(12, 120))
    assert leaks.over(doc, item, 0) < 1.0 == leaks.over(item, item, 0)
    assert list(leaks.Items([(1, " ".join(item))]).leaks([(7, " ".join(item))]))[0][2:] == (120, 1.0, 1.0)


def test_items_in_blocks_give_the_same_leaks(spark):
    from transquill.llm import leaks

    items = spark.createDataFrame([(i, " ".join(f"w{i}x{k}" for k in range(20))) for i in range(12)], "item_id bigint, text string")
    docs = items.select((items["item_id"] * 10).alias("doc_id"), "text")
    whole, blocks = leaks.find_leaks(docs, items), leaks.find_leaks(docs, items, most_bytes=300)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, blocks.collect())) and whole.count() == 12


def test_languages_of_the_same_script_are_told_apart_by_their_ngrams():
    from transquill.llm import languages as L

    russian = "сегодня мы расскажем о том как в нашем городе собирали урожай яблок и что из этого вышло для всех жителей " * 3
    counts = np.zeros((2, 1 << L.BITS), np.uint16)
    for i in range(len(L.CODES)):
        counts[:, i] |= np.uint16(1 << i)  # every language has learned something
    one, two, _ = L.grams([russian])
    counts[0][one] |= np.uint16(1 << L.CODES.index("ru"))
    counts[1][two] |= np.uint16(1 << L.CODES.index("ru"))
    who = L.Identifier(L.Filters(counts))
    other = "Сьогодні ввечері ми їхали до міста, щоб купити хліба й молока, бо вдома вже нічого не було, і всі хотіли їсти."
    assert [c for c, _ in who.decide([russian, other])] == ["ru", ""]
    assert who.languages([other]) == [("", [], [])]


def test_the_verdict_of_a_host_lowers_the_share_from_which_its_documents_are_suspect(spark):
    from transquill.llm import repetition

    bad, good = [(i, "bad", 0.4 if i % 2 else 0.2, 0.0) for i in range(40)], [(100 + i, "good", 0.0, 0.0) for i in range(400)]
    rows = [*bad, *good, (999, None, 0.2, 0.0)]
    out = {r["video_id"]: r for r in repetition.judge(spark.createDataFrame(rows, "video_id bigint, host string, runs double, lines double")).collect()}
    assert len(out) == len(rows) and out[0]["suspect"] and out[0]["failed"] == [] and out[0]["host_bad"] and not out[999]["suspect"] and not out[100]["host_bad"]


def test_intermediate_rows_need_a_shared_folder_outside_one_process(spark, monkeypatch):
    from transquill.llm import rows

    class Context:
        master = "yarn"

        def getConf(self):  # noqa: N802
            return {}

        def getCheckpointDir(self):  # noqa: N802
            return None

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda *_: None)

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="shared|share"):
        rows.stored(Frame())


# ---- problem 10: spans of any length


def brute_spans(points, gain, deep):
    """The score of the best spans, of all of them."""
    best = [0.0] + [-1e18] * (len(points) - 1)
    for j in range(1, len(points)):
        for i in range(j):
            size = points[j] - points[i]
            off = (np.log(size) - sentences.TYPICAL) / sentences.SPREAD
            best[j] = max(best[j], best[i] + gain[j] - 0.5 * off * off - (2.5 if size < 3 else 0.0) + (sentences.UNBALANCED if deep[i] != deep[j] else 0.0))
    return best[-1]


@given(st.lists(st.tuples(st.integers(1, 120), st.floats(-6, 4), st.booleans()), min_size=5, max_size=120), st.floats(-5, 1))
@settings(max_examples=120, deadline=None)
def test_long_spans_are_found_without_trying_all(parts, shift):
    text, ends, close = "", [], []
    opened = False
    for size, score, quote in parts:
        text += "x" * size
        if quote:
            text += "»" if opened else "«"
            opened = not opened
        ends.append(len(text))
        close.append(score + shift)
    text += "»" * opened + "xxx"
    got = sentences._best(text, 0, len(text), ends, close, [0.0] * len(ends))
    where, depth = sentences.depths(text, 0, len(text))
    points = [0, *ends, len(text)]
    deep = [depth[int(np.searchsorted(where, p + 1)) - 1] for p in points]
    deep[0] = deep[-1] = 0
    gain = [0.0, *close, 0.0]
    at, total = 0, 0.0
    for p in got:
        i, j = points.index(at), points.index(p)
        off = (np.log(p - at) - sentences.TYPICAL) / sentences.SPREAD
        total += gain[j] - 0.5 * off * off - (2.5 if p - at < 3 else 0.0) + (sentences.UNBALANCED if deep[i] != deep[j] else 0.0)
        at = p
    assert abs(total - brute_spans(points, gain, deep)) < 1e-6


def test_a_text_of_nothing_but_abbreviations_takes_no_time():
    import time

    began = time.process_time()
    assert sentences.sentences("Dr. " * 50_000, sentences.Model())
    assert time.process_time() - began < 20


# ---- problems 7 and 4: boilerplate by its place, placeholders by what stands around them


def test_lines_of_links_and_navigation_go_but_equal_lines_stay():
    text = "<p>Hi there all of you</p>\n[Home](/a) [News](/b) [Shop](/c) [Help](/d)\nHome News Shop Help\n<nav>\nHome\n</nav>\nHome"
    assert markup.clean(text)[0] == "Hi there all of you\n\nHome News Shop Help\n\nHome"


def test_one_long_page_takes_linear_time():
    import time

    began = time.process_time()
    markup.clean("\n".join("* a [[b]] <b>x</b> <p>y</p>" for _ in range(20_000)))
    assert time.process_time() - began < 20


@pytest.mark.parametrize(
    ("text", "hit"),
    [
        ('Welcome {{name}}, here is your talk.', True), ('The variable "{{name}}" is then replaced.', False), ('In this template you write "{{name}}" and the macro fills "{{city}}" in; a template is simple.', False),
        ('They said "{{name}}" to all of us.', True), ('Too many requests were sent from your network.', True), ("Too many requests a day make any clerk tired.", False),
    ],
)
def test_placeholders_and_notices_in_context(text, hit):
    assert bool(residue.residue(text)) is hit


def test_the_markup_classifier_is_fitted_on_texts_with_and_without_markup(spark):
    stated = markup.posterior_odds({}, {})
    assert stated == markup.ODDS
    odds = markup.posterior_odds({"": 1000, "quote": 100, "row": 100}, {"": 1000, "row": 300})
    assert odds["quote"] > markup.ODDS["quote"] and odds["row"] < 0 and odds["link"] == markup.ODDS["link"]
    mixed = spark.createDataFrame([("> said\n\nand more",)] * 40 + [(None,), ("",)], "text string").withColumn("type", F.lit(1))
    plain = spark.createDataFrame([("plain words",)] * 40, "text string")
    fitted = markup.fit(mixed, plain)
    assert fitted["quote"] > markup.ODDS["quote"] and markup.fit(mixed.where("false"), plain) == markup.ODDS
    assert markup.find_markup(mixed.withColumn("video_id", F.lit(1)), fitted).count() == 40


# ---- problem 5: what costs time is done for the texts that need it


def test_only_texts_with_runs_that_come_again_are_taken_apart(monkeypatch):
    from transquill.llm import repetition

    loop = "We say — the same eight words, again now! "
    texts = [f"text number {i} says « something » of its own, and then {i + 1} more" for i in range(200)] + [loop * 3, "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往" * 2, "", "… — !", loop + loop.upper()]
    seen, units_of = [], repetition.units_of
    monkeypatch.setattr(repetition, "units_of", lambda t: seen.append(t) or units_of(t))
    out = repetition.measures(texts)
    assert not set(seen) & set(texts[:200]) and [s for s, _ in out] == pytest.approx([0.0] * 200 + [2 / 3, 0.5, 0.0, 0.0, 0.5])


@given(st.lists(st.lists(st.sampled_from(["a", "B,", "b", "—", "…", "été"]), max_size=50).map(" ".join) | st.lists(st.sampled_from("天地。 "), max_size=90).map("".join), max_size=8))
@settings(max_examples=200, deadline=None)
def test_shares_of_many_texts_are_those_of_each(texts):
    from transquill.llm import repetition

    def brute(units, size):
        seen, marked = set(), set()
        for i in range(len(units) - size + 1):
            if (g := tuple(units[i : i + size])) in seen:
                marked |= set(range(i, i + size))
            seen.add(g)
        return len(marked) / len(units) if units else 0.0

    assert [s for s, _ in repetition.measures(texts)] == pytest.approx([brute(*repetition.units_of(t)) for t in texts])


@given(st.lists(st.text(st.sampled_from("aZéßЖ天 ๑1_²\n-.\U0001d400"), max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_words_beyond_ascii_with_two_characters_on_each_side(texts):
    right, middle = mojibake.Counter(), mojibake.Counter()
    for t in texts:
        if own := re.findall(r"(?s)(?=(.[\W\d_][A-Za-z]*+[^\x00-\x7f\W\d_][^\W\d_]*+..))", f"\n\n{t}\n\n"):
            right.update(own)
            middle[own[len(own) // 2]] += 1
    assert mojibake.passages_of(texts) == (right, middle)


@pytest.mark.parametrize("codec", mojibake.DECODERS)
def test_runs_of_utf8_are_those_of_its_sequences(codec):
    rng = np.random.default_rng(1)
    chars = "".join(mojibake.high(codec).values()) + "ab \x92"
    plain = re.compile(f"(?:{mojibake.sequences(codec)})+")
    texts = ["".join(rng.choice(list(chars), 400)) for _ in range(20)] + [mojibake.read_wrongly(t, "utf-8", codec) for t in (FRENCH, GERMAN, "Он был дома… «да»", "今日は。")]
    assert all([m.span() for m in mojibake.utf8_pattern(codec).finditer(t)] == [m.span() for m in plain.finditer(t)] for t in texts) and any(plain.search(t) for t in texts)


# ---- problem 6: the same votes and pieces with less work

RUSSIAN = "Он был дома весь день. Потом он ушёл в лес, и там было тихо! Никто не ждал его."


def test_a_text_of_one_writing_is_not_cut_piece_by_piece(monkeypatch):
    from transquill.llm import languages

    seen, script_runs = [], languages.script_runs
    monkeypatch.setattr(languages, "script_runs", lambda t: seen.append(t) or script_runs(t))
    who = languages.Identifier(languages.Filters())
    for text in (FRENCH, RUSSIAN, "今日は天気がいいです。明日も晴れるでしょう。散歩に行きます。", "这是第一句很长的话。这是第二句很长的话。", "1. 2. 3."):
        who._pieces(text)
    assert not seen
    pieces = who._pieces(f"{RUSSIAN} and then she went home to the old mill {RUSSIAN}")
    assert seen and "and then she went home to the old mill" in pieces and not any("Он" in p and "mill" in p for p in pieces)


def test_hits_of_all_languages_are_those_of_each():
    from transquill.llm import languages

    rng = np.random.default_rng(1)
    owner = np.sort(rng.integers(0, 5, 60_000))
    owner[owner == 3] = 4
    sets = rng.integers(0, 1 << len(languages.CODES), len(owner)).astype(np.uint16)
    filters = languages.Filters()
    for few in (owner < 9, np.arange(len(owner)) % 20 == 0):
        most = int(np.bincount(owner[few]).max())
        plain = [np.bincount(owner[few][(sets[few] >> i) & 1 == 1], minlength=6) for i in range(len(languages.CODES))]
        assert np.array_equal(filters.hits(sets[few], owner[few], 6, most), plain)
    full = np.zeros((1 << languages.FIELD) - 1, np.int64)  # as many as a field holds
    assert all(n.tolist() == [len(full)] for n in filters.hits(np.full(len(full), (1 << len(languages.CODES)) - 1), full, 1, len(full)))


@given(st.text(st.sampled_from("aД天.!?。！।\"”) \n[](1:♪<>")))
@settings(max_examples=500, deadline=None)
def test_patterns_that_begin_with_a_set_match_the_same(text):
    from transquill.llm import languages

    assert languages.PIECE.split(text) == re.split(r"[.!?؟।]+[\"”»’)]*\s+|[。！？]+", text)
    assert languages.ANNOTATION.sub("_", text) == re.sub(r"\[[^\]\n]{1,40}\]|\((?:[^()\d\n]{1,30})\)|[♪♫]|<[^<>\n]{1,80}>", "_", text)
    assert bool(languages.TIME_PART.search(text)) or not languages.TIME.search(text)

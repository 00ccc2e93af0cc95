"""Problem 4: unfilled placeholders, filler text, error pages and web notices in place of speech.

One grammar for each delimiter; code blocks and inline code are discounted, and so is a placeholder that its own sentence
talks about (a word for code or templates right before, or quotation marks around it, at low density). Filler is told by a
run of filler words or a sentence that announces text to come. A page notice is judged by the cues of its sentences:
one strong cue, or two weak ones in the same paragraph; speech about errors has them inside a narrating sentence.

Defined results: null or blank text gives no row; text that is nothing but code gives none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable
from re import _parser as sre_parse

import ahocorasick
from pyspark.sql import DataFrame

from transquill.llm.rows import has_text, map_rows

# What stands between the delimiters of placeholders, by delimiter.
GRAMMARS = {
    "mustache": r"\{\{\s*[#/^>&]?\s*[A-Za-z_][\w.\- ]{0,40}?(?:\s*\|\s*\w+)?\s*\}\}",
    "block": r"\{%-?\s*[a-z_]+[^%{}\n]{0,60}%\}",
    "dollar": r"\$\{[A-Za-z_][\w.]{0,40}\}",
    "brace": r"(?<![\\\w}$^_{)\]])#?\{(?:\d{1,2}|[a-z][a-z0-9]*(?:[_.][a-z0-9]+)*|[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)+)\}(?![}{])",
    "erb": r"<%[=\-#]?\s*[\w.@\[\]'\"() ]{1,60}\s*-?%>|<\?=\s*\$?\w[^?]{0,40}\?>",
    "percent": r"(?<![A-Za-z0-9_%])%%?[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*%%?(?![A-Za-z0-9_])|(?<![A-Za-z0-9_%\\])%(?:\d\$)?[sd](?![A-Za-z0-9_])|%\([a-z_]+\)[sd]",
    "at": r"@@[A-Za-z]\w{1,40}@@|(?<!\w)@[A-Z]{2,}(?:_[A-Z]+)+@",
    "double_dollar": r"\$\$[A-Z][A-Z_]{2,40}\$\$",
    "underscore": r"(?<![A-Za-z0-9_])__[A-Z][A-Z0-9]*(?:_[A-Z0-9]+)*__(?![A-Za-z0-9_])",
    "merge": r"\*\|[A-Z][A-Z_:]{1,40}\|\*|\[%[A-Za-z_. ]{2,40}%\]",
    "angle": r"<(?:[A-Z]{2,}(?:[ _][A-Z]{2,})+|insert [a-z ]{2,40}|your [a-z ]{2,40})>",
    "square": r"\[\[?(?:(?:[Yy]our|YOUR|[Vv]otre|VOTRE|[Ii]hr|IHR|[Dd]ein|[Tt]u|TU|[Ss]u|SU|[Ss]eu|SEU|[Вв]аш|ВАШ)\s[^\]\n|(]{2,40}|(?:INSERT|[Ii]nsert|INS[EÉ]R\w*|[Ii]ns[eé]r\w+|EINF[UÜ]GEN|TO BE|TBD|TODO|À COMPL\w+|A COMPL\w+)(?:\s[^\]\n|(]{2,40})?|[^\]\n|(]{2,30}\s(?:EINF[UÜ]GEN|einf[uü]gen|HERE|here|ICI|ici|AQU[IÍ]|aqu[ií]|HIER|hier|ЗДЕСЬ|здесь)|(?:NAME|NOM|NOMBRE|NOME|TITLE|TITRE|T[IÍ]TULO|TITEL|DATE|ИМЯ|НАЗВАНИЕ)(?:\s(?:OF|DE|DU|DES|DO|DA|DEL|DER)[^\]\n|(]{1,40})?|[^\]\n]{0,12}(?:在此|此处|ここに)[^\]\n]{0,20}|object Object)\]?\]",
}
LOREM = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa qui officia deserunt mollit anim id est laborum vitae turpis massa ligula sapien".split()
#: Words of filler that are words of no other text here.
LOREM_OWN = frozenset(LOREM) - frozenset("do et ex ea ad in eu non sunt qui id est ut sed esse quis massa nulla elit".split())
#: Sentences that stand for a text to come.
FILLER = [
    r"(?:dummy|placeholder|sample|filler|example)\s+(?:text|content|copy|transcript)\b",
    r"(?:your|the)\s+(?:final\s+)?(?:transcript|text|content|description|title)\s+(?:goes|will\s+go|comes)\s+here\b",
    r"(?:text|transcript|content)\s+to\s+(?:be\s+(?:added|supplied|inserted)|follow|come)\b",
    r"ici\s+(?:viendra|sera|ira)\b.{0,60}(?:transcription|texte|contenu)", r"(?:texte|contenu)\s+(?:de\s+remplacement|bidon|d['’]exemple|provisoire|fictif|factice)\b", r"faux[\s-]texte\b",
    r"(?:beispiel|platzhalter|blind|muster)(?:text|inhalt)\b", r"hier\s+(?:steht|kommt|folgt|erscheint)\s+(?:bald|später|noch|dann|demnächst|ihr|der|das)\b.{0,50}(?:text|transkript|inhalt)",
    r"(?:texto|contenido|conte[uú]do)\s+(?:de\s+(?:ejemplo|exemplo|relleno|muestra|prueba|preenchimento|teste|amostra)|provisional|provis[oó]rio|ficticio|fict[ií]cio)\b", r"aqu[ií]\s+(?:va|irá|entra|entrará|vai|virá|ficará|aparecerá)\b.{0,40}(?:transcripci[oó]n|transcriç[aã]o|texto|contenido|conte[uú]do)",
    r"(?:пример\s+текста|текст[\s-](?:заполнитель|заглушка)|здесь\s+(?:будет|появится)\s.{0,40}(?:текст|расшифровка))", r"(?:サンプル|ダミー|仮の?)(?:テキスト|文章|本文)|ここに.{0,20}(?:入ります|入力してください|が入る)", r"(?:示例|占位|样例|测试用?)(?:文本|文字|内容)|(?:此处|这里)(?:将|会)?(?:填写|放置|插入|显示).{0,20}(?:文字|文本|内容|字幕)",
    r"(?:نص|محتوى)\s+(?:تجريبي|بديل|مؤقت)", r"(?:नमूना|डमी)\s+(?:पाठ|टेक्स्ट|सामग्री)", r"ข้อความ(?:ตัวอย่าง|จำลอง|ชั่วคราว)",
]
#: Sentences that only a page or server says.
STRONG = [
    r"(?:this|the)\s+(?:page|site|website|app|viewer|application)\s+(?:needs|requires|works\s+best\s+with|uses)\s+(?:javascript|cookies|scripts)", r"(?:cette\s+page|ce\s+site)\s+(?:a\s+besoin|nécessite|requiert|utilise)\b.{0,12}(?:javascript|cookies|scripts)", r"diese\s+(?:seite|website|anwendung)\s+(?:braucht|benötigt|erfordert|verwendet)\s+(?:javascript|cookies|skripte)",
    r"est[ae]\s+(?:página|sitio|web|site)\s+(?:necesita|requiere|precisa|requer|utiliza|usa)\s+(?:de\s+)?(?:javascript|cookies|scripts)", r"(?:для\s+этой\s+страницы|этой\s+странице|для\s+работы\s+сайта)\s+(?:нуж|необход|требу)\w+\s+javascript", r"この(?:ページ|サイト).{0,12}javascript.{0,6}(?:必要|有効)", r"(?:本|此|该)(?:页面|网页|网站).{0,8}(?:需要|要求).{0,6}javascript", r"(?:تحتاج|تتطلب)\s+هذه\s+الصفحة.{0,20}(?:javascript|جافا)", r"इस\s+पृष्ठ.{0,20}javascript", r"หน้านี้(?:ต้องใช้|ต้องการ).{0,6}javascript",
    r"(?:please\s+)?(?:enable|turn\s+on|activate|allow)\s+(?:javascript|scripts?|cookies)\b", r"(?:veuillez\s+)?activez\s+(?:les\s+)?(?:javascript|scripts?|cookies)\b", r"(?:schalten\s+sie|aktivieren\s+sie)\s+(?:bitte\s+)?(?:javascript|skripte|cookies)\b", r"(?:active|habilite|activa|ative)\s+(?:los\s+|os\s+)?(?:javascript|scripts|cookies)\b", r"включите\s+(?:сценарии|javascript|скрипты|cookies)", r"(?:javascript|スクリプト|設定)\S{0,6}有効にして(?:から|ください|再)", r"请(?:启用|开启|打开).{0,6}(?:javascript|脚本)",
    r"your\s+browser\s+is\s+(?:out\s+of\s+date|outdated|not\s+supported|unsupported)", r"we\s+use\s+cookies\s+to\b", r"nous\s+(?:utilisons|déposons)\s+des\s+cookies\b", r"wir\s+(?:verwenden|nutzen|setzen)\s+cookies\b", r"(?:usamos|utilizamos)\s+cookies\b", r"мы\s+используем\s+(?:файлы\s+)?cookie", r"(?:当サイト|このサイト)\S{0,8}(?:cookie|クッキー)", r"(?:本网站|我们)使用\s?cookie", r"accept\s+all,?\s+(?:reject|or)\b", r"acceptez\s+ou\s+refusez\b",
    r"too\s+many\s+requests\b(?=\s*(?:[.,;:!)<–-]|$|(?:were|have|has|from|in|to|at|sent|received)\b))", r"trop\s+de\s+requêtes\b", r"zu\s+viele\s+anfragen\b", r"demasiadas\s+(?:peticiones|solicitudes)\b", r"(?:muitos|demasiados)\s+pedidos\b.{0,20}(?:rede|servidor)|muitas\s+requisições\b", r"слишком\s+много\s+запросов", r"(?:リクエスト|アクセス)が(?:多すぎ|集中)", r"请求(?:过于频繁|过多|次数)",
    r"(?:you\s+don['’]t|you\s+do\s+not)\s+have\s+(?:the\s+)?permission\s+to\b", r"vous\s+n['’](?:avez\s+pas\s+le\s+droit|êtes\s+pas\s+autorisé)", r"sie\s+(?:dürfen|haben\s+keine\s+berechtigung).{0,40}(?:server|zugriff|öffnen|datei)", r"no\s+tiene\s+permiso\s+para\b", r"n[aã]o\s+tem\s+permissão\s+para\b", r"(?:у\s+вас\s+)?нет\s+(?:прав|доступа|разрешения)\s+.{0,40}(?:сервер|файл|ресурс|страниц)", r"(?:開く|アクセスする)権限がありません", r"(?:没有|无)权限(?:访问|打开)|您没有权限",
    r"the\s+(?:item|page|file|resource)\s+you\s+(?:asked|requested|are\s+looking)\s.{0,30}(?:moved|never\s+existed|not\s+(?:be\s+)?found|does\s?n[o'’]t\s+exist|no\s+longer)", r"(?:404\s+)?page\s+not\s+found", r"la\s+page\s+(?:demandée|que\s+vous).{0,30}(?:n['’]existe|introuvable|changé\s+d['’]adresse)", r"die\s+(?:angeforderte|gesuchte)\s+seite\b", r"la\s+página\s+(?:solicitada|que\s+busca).{0,30}(?:no\s+existe|ya\s+no|cambió|movió)", r"a\s+página\s+(?:solicitada|pedida|que\s+procura).{0,30}(?:não|mudou)", r"(?:запрошенная|запрашиваемая)\s+страница", r"(?:お探し|ご指定|要求された)の?(?:ページ|項目).{0,20}(?:見つかり|存在し|移動)", r"(?:您|你)?(?:请求|访问|要找)的(?:页面|网页|资源).{0,12}(?:不存在|已移|找不到)",
    r"bad\s+gateway\b", r"(?:service|server)\s+(?:temporarily\s+)?unavailable\b", r"internal\s+server\s+error\b", r"gateway\s+time-?out\b", r"the\s+proxy\s+(?:gave\s+up|timed\s+out)\b", r"(?:oops|oups|hoppla|vaya|ups)[,!]?\s+.{0,10}(?:something|un\s+souci|une\s+erreur|un\s+problème|etwas|da\s+ist|algo)\b.{0,40}(?:broke|wrong|survenu|côté|schief|passiert|mal|errado)", r"something\s+(?:broke|went\s+wrong)\s+on\s+our\s+(?:side|end)", r"access\s+(?:to\s+this\s+\w+\s+)?(?:is|was|has\s+been)\s+denied\b",
]
#: Sentences that a page says, but people too.
WEAK = [
    r"(?:reference|référence|referencia|referência|ref|kennung|código|code|vorgang|ticket|trace(?:\s+id)?|request(?:\s+id)?|код|номер|番号|编号)[\s:#]*(?=[0-9a-f]*\d)[0-9a-f]{8,}", r"(?:error|erreur|fehler|erro|ошибка|エラー|错误(?:代码)?|خطأ|ข้อผิดพลาด|त्रुटि)\s?[:#]?\s?(?:4\d\d|5\d\d)\s*(?:[.。:!–-]|$)", r"(?:4\d\d|5\d\d)\s+(?:service|not\s+found|forbidden|bad|internal|unauthorized|gateway|too)",
    r"(?:reload|refresh)\s+(?:the\s+page|to\s+see)|(?:puis\s+)?rechargez\b|laden\s+sie\s+(?:die\s+seite\s+)?neu|recargue\b|recarregue\b|обновите\s+страницу|再読み込みしてください|刷新页面", r"(?:wait|try\s+again\s+in)\s+\d+\s+(?:minutes|seconds)|(?:patientez|réessayez\s+dans)\s+\d+|bitte\s+\d+\s+minuten\s+warten|espere\s+\d+\s+minutos|aguarde\s+\d+\s+minutos|подождите\s+\d+\s+минут|\d+分(?:後|ほど)?お待ち|请(?:等待|在)\s?\d+\s?分钟",
    r"go\s+back\s+to\s+the\s+home|use\s+the\s+search\s+box|revenez\s+à\s+l['’]accueil|lancez\s+une\s+recherche|zur\s+startseite|vuelva\s+a(?:l\s+inicio|\s+la\s+portada)|volte\s+à\s+página\s+inicial|вернитесь\s+на\s+главную|ホームに戻|返回首页", r"our\s+staff\s+got\s+a\s+notice|nos\s+équipes\s+ont\s+été|<title>\s*(?:error|erreur|fehler|\d{3}|oops|stop)",
]
#: Words after which a placeholder is spoken about.
ABOUT = r"(?:variable|placeholder|template|syntax|macro|format\s+string|platzhalter|variante|vorlage|marqueur|modèle|plantilla|marcador|modelo|шаблон|переменн\w+|変数|占位符|变量)\s*[:,]?\s*[\"“«„'‘`(]?$"
# End of fixed values.

CODE = re.compile(r"```.*?(?:```|\Z)|~~~\n.*?(?:~~~|\Z)|<(pre|code|script|style)\b[^>]*>.*?(?:</\1>|\Z)|\\begin\{(?:verbatim|lstlisting|equation|align)\*?\}.*?\\end\{(?:verbatim|lstlisting|equation|align)\*?\}|<syntaxhighlight.*?</syntaxhighlight>|(?<!`)`[^`\n]+`(?!`)|\\\[.*?\\\]|\$\$(?![A-Z_]+\$\$)[^$]+\$\$|\$[^$\n]{1,80}\\[a-z]+[^$\n]{0,80}\$", re.DOTALL)
HOLES = {name: re.compile(p) for name, p in GRAMMARS.items()}
#: What a text must hold for a grammar to be tried.
OPENED_BY = {"mustache": ("{{",), "block": ("{%",), "dollar": ("${",), "brace": ("{",), "erb": ("<%", "<?="), "percent": ("%",), "at": ("@",), "double_dollar": ("$$",), "underscore": ("__",), "merge": ("*|", "[%"), "angle": ("<",), "square": ("[",)}
ANY_HOLE = re.compile(r"\{\{|\{%|\$\{|\{(?:\d|[A-Za-z])|<%|<\?=|%(?:[A-Zsd(]|\d\$[sd])|@@|@[A-Z]|\$\$[A-Z]|__[A-Z]|\*\||\[%|<[A-Za-z]+[ _]|\[")
START = r"(?:^|(?<=[.!?。！？।…»”\"\n>:]))[\s\"“«•*#–-]*"
FILLERS = re.compile(START + "(?:" + "|".join(FILLER) + ")", re.IGNORECASE)
NARRATED = re.compile(r"\b(?:explains?|says?|said|why|when|that|shows?|teach\w*|pourquoi|explique|quand|wenn|warum|erklärt|cuando|explica|por\s+qué|quando|porque|почему|когда|объясня\w+)\b", re.IGNORECASE)
SENTENCE = re.compile(r"[^.!?。！？।\n<>]+[.!?。！？।]*")
ABOUT_END = re.compile(ABOUT, re.IGNORECASE)
#: The same words anywhere.
ABOUT_WORD = re.compile(ABOUT[: ABOUT.index(r"\s*[:,]?")], re.IGNORECASE)
QUOTE_OPENS, QUOTE_CLOSES = frozenset("\"“«„'‘`"), frozenset("\"”»“'’`")
#: Placeholders for each 400 characters beyond which a text is no talk about them.
DENSE_HOLES = 4
WORDS = re.compile(r"[A-Za-z]+")
def needed(pattern: str) -> frozenset[str]:
    """Lower-case parts, one of which every match of the pattern has: the longest such set that its syntax tree gives."""

    def best(sets: list[frozenset[str]]) -> frozenset[str]:
        return max((x for x in sets if x), key=lambda x: (min(map(len, x)), -len(x)), default=frozenset())

    def of(tree) -> frozenset[str]:  # noqa: ANN001
        sets, run = [], ""
        for op, value in [*tree, (None, None)]:
            if op is sre_parse.LITERAL:
                run += chr(value).lower()
                continue
            if run:
                sets.append(frozenset([run]))
                run = ""
            if op is sre_parse.SUBPATTERN:
                sets.append(of(value[3]))
            elif op is sre_parse.BRANCH:
                parts = [of(x) for x in value[1]]
                sets.append(frozenset().union(*parts) if all(parts) else frozenset())
            elif op in (sre_parse.MAX_REPEAT, sre_parse.MIN_REPEAT) and value[0] > 0:
                sets.append(of(value[2]))
            elif op is sre_parse.IN and all(o is sre_parse.LITERAL for o, _ in value):
                sets.append(frozenset(chr(v).lower() for _, v in value))
        return best(sets)

    return of(sre_parse.parse(pattern))


def automaton(patterns: list[str]) -> ahocorasick.Automaton:
    """Finds where which of the patterns may match; every pattern must have a part that it can't match without."""
    of: dict[str, set[int]] = {}
    for i, pattern in enumerate(patterns):
        parts = needed(pattern)
        if not parts:
            raise ValueError(f"no part that all matches have: {pattern}")
        for part in parts:
            of.setdefault(part, set()).add(i)
    out = ahocorasick.Automaton()
    for part, own in of.items():
        out.add_word(part, (len(part), frozenset(own)))
    out.make_automaton()
    return out


FILLER_AT, PAGE_AT = automaton(FILLER), automaton(STRONG + WEAK)
PAGE = [re.compile(p, re.IGNORECASE) for p in STRONG + WEAK]
STOPS = re.compile(r"[.!?。！？।\n<>]")


def near(parts: ahocorasick.Automaton, low: str) -> list[tuple[int, int, set[int]]]:
    """The sentences that hold one of the parts, with the end of the one before and the patterns that may match there; touching ones joined."""
    out: list[tuple[int, int, set[int]]] = []
    for end, (n, own) in parts.iter(low):
        if out and end < out[-1][1]:
            out[-1][2].update(own)
            continue
        a = max((low.rfind(c, 0, end - n + 1) for c in ".!?。！？।\n<>"), default=-1)
        m = STOPS.search(low, end)
        b = m.end() if m else len(low)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], b, out[-1][2] | own
        else:
            out.append((max(0, a), b, set(own)))
    return out


def first_match(text: str, patterns: Iterable[int]) -> int | None:
    """Where the first match of any of the page's patterns begins."""
    return min((m.start() for i in patterns if (m := PAGE[i].search(text))), default=None)


def mask_code(text: str) -> str:
    """Code and formulas give way to blanks of the same length."""
    return CODE.sub(lambda m: re.sub(r"[^\n]", " ", m[0]), text) if re.search(r"`|~~~|<pre|<code|<script|<style|\\begin|\\\[|\$|<syntax", text) else text


def holes(text: str) -> list[tuple[str, int, int]]:
    """Placeholders that were never filled in, as (grammar, start, end)."""
    found: list[tuple[str, int, int]] = []
    if not any(c in text for c in "{%@$_*[<") or not ANY_HOLE.search(text):
        return found
    plain = mask_code(text)
    for name, pattern in HOLES.items():
        if not any(x in plain for x in OPENED_BY[name]):
            continue
        for m in pattern.finditer(plain):
            if all(m.end() <= a or m.start() >= b for _, a, b in found):
                found.append((name, m.start(), m.end()))
    if not found:
        return found
    talk = len(ABOUT_WORD.findall(plain))
    dense = len(found) > DENSE_HOLES * max(1, len(text) / 400)
    tutorial = not dense and talk >= 2 and talk >= len(found)
    return sorted((n, a, b) for n, a, b in found if dense or _unfilled(plain, a, b, tutorial))


def _unfilled(plain: str, a: int, b: int, tutorial: bool) -> bool:
    """Whether what stands around a placeholder leaves it one: not if it is named as such, or is quoted where code is the subject."""
    if ABOUT_END.search(plain[max(0, a - 60) : a]):
        return False
    start, end = max((plain.rfind(c, 0, a) for c in ".!?\n"), default=-1) + 1, STOPS.search(plain, b)
    sentence = plain[start : end.start() if end else len(plain)]
    quoted = plain[max(0, a - 1) : a] in QUOTE_OPENS and plain[b : b + 1] in QUOTE_CLOSES
    return not (quoted and (tutorial or ABOUT_WORD.search(sentence)))


def fillers(text: str) -> list[tuple[int, int]]:
    """Runs of filler words, and sentences that announce a text."""
    low = text.lower()
    found = []
    for a, b, _ in near(FILLER_AT, low) if len(low) == len(text) else [(0, len(text), set())]:
        found += [(a + m.start(), e.end() if (e := STOPS.search(text, a + m.end())) and e.end() <= b else b) for m in FILLERS.finditer(text[a:b])]
    if sum(w in low for w in ("lorem", "dolor", "amet", "fugiat", "ipsum", "magna", "aliqua", "veniam", "tempor", "sint", "sapien")) >= 2:
        run: list[re.Match] = []
        last = None
        for m in WORDS.finditer(text):
            word = m[0].lower()
            if word in LOREM and (last is None or not re.search(r"[^\s.,;]", text[last : m.start()])):
                run.append(m)
            else:
                if len(run) >= 4 and sum(x[0].lower() in LOREM_OWN for x in run) >= 3:
                    found.append((run[0].start(), run[-1].end()))
                run = [m] if word in LOREM else []
            last = m.end()
        if len(run) >= 4 and sum(x[0].lower() in LOREM_OWN for x in run) >= 3:
            found.append((run[0].start(), run[-1].end()))
    return found


def notices(text: str) -> list[tuple[int, int]]:
    """Sentences of pages and servers."""
    found: list[tuple[int, int]] = []
    low = text.lower()
    strong: list[tuple[int, int]] = []
    weak: list[tuple[int, int]] = []
    for a, b, own in near(PAGE_AT, low) if len(low) == len(text) else [(0, len(text), set(range(len(PAGE))))]:
        sure, less = [i for i in own if i < len(STRONG)], [i for i in own if i >= len(STRONG)]
        for s in SENTENCE.finditer(text, a, b):
            n = first_match(s[0], sure)
            at = first_match(s[0], less) if n is None else n
            if at is not None and not NARRATED.search(s[0][:at]):
                (strong if n is not None else weak).append(s.span())
    breaks = [m.start() for m in re.finditer(r"\n\s*\n", text)] if strong or weak else []
    block = lambda at: bisect_right(breaks, at)
    number = Counter(block(a) for a, _ in weak)
    firm = {block(a) for a, _ in strong}
    found = strong + [w for w in weak if block(w[0]) in firm or number[block(w[0])] >= 2]
    return sorted(found)


def residue(text: str) -> list[tuple[str, int, int]]:
    """All of it as (kind, start, end), kinds being placeholder, filler and notice."""
    return [("placeholder", a, b) for _, a, b in holes(text)] + [("filler", a, b) for a, b in fillers(text)] + [("notice", a, b) for a, b in notices(text)]


def without_residue(text: str) -> str:
    out, at = [], 0
    for _, a, b in sorted(residue(text), key=lambda x: x[1:]):
        if a >= at:
            out.append(text[at:a])
        at = max(at, b)
    return " ".join(out + [text[at:]]) if at else text


def find_residue(texts: DataFrame, key: str = "video_id", column: str = "text") -> DataFrame:
    """(key, kinds, pieces, share): the kinds found, how many pieces, and their share of the text."""

    def start() -> Callable[..., list[tuple]]:
        def kernel(k, text):  # noqa: ANN001, ANN202
            found = residue(text)
            return [(k, sorted({x for x, _, _ in found}), len(found), sum(b - a for _, a, b in found) / len(text))] if found else []

        return kernel

    kind = dict(texts.dtypes)[key]
    return map_rows(texts.where(has_text(column)), [key, column], start, f"`{key}` {kind}, kinds array<string>, pieces int, share double")

"""Column expressions over text; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Replacement tables of the seven repair passes, in the order in which they apply.
HEAL_A = [("Ã©", "é"), ("Ã¨", "è"), ("Ã\xa0", "à"), ("Ãª", "ê"), ("Ã´", "ô"), ("Ã§", "ç"), ("Ã»", "û"), ("Ã¹", "ù"), ("Ã®", "î"), ("Ã¯", "ï"), ("Ã«", "ë"), ("├®", "é"), ("├¿", "è"), ("├\xa0", "à"), ("├ª", "ê"), ("├┤", "ô"), ("├º", "ç"), ("├╗", "û"), ("├╣", "ù"), ("├«", "î"), ("├»", "ï"), ("├½", "ë"), ("Ã‰", "É"), ("Ã€", "À"), ("Ãˆ", "È"), ("ÃŽ", "Î"), ("Ã_", "í"), ("Ã¦", "æ"), ("Ã¶", "ö"), ("Ã¡", "á"), ("Ã±", "ñ"), ("Ã¼", "ü"), ("ûºa", "ça"), ("ûº", "ç"), ("oû╣", "où"), ("Æ", "'"), ("Â", "")]
NOISE_A = ["[Music]", "[MUSIC]", "[music]", "[Musique]", "[MUSIQUE]", "[musique]", "[Applause]", "[APPLAUSE]", "[applause]", "[Applaudissements]", "[APPLAUDISSEMENTS]", "[applaudissements]", "(Rires)", "(Laughter)", "[Silence]", "[Rires]"]
HEAL_B = [("├®", "é"), ("├¿", "è"), ("├á", "à"), ("├ª", "ê"), ("├¬", "ê"), ("├┤", "ô"), ("├╗", "û"), ("├╣", "ù"), ("├º", "ç"), ("├î", "î"), ("├Ç", "Ç"), ("├ü", "é"), ("├╝", "ü"), ("├½", "ë"), ("├»", "ï"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã\xa0", "à"), ("Ãª", "ê"), ("Ã´", "ô"), ("Ã§", "ç"), ("Ã»", "û"), ("Ã¹", "ù"), ("Ã®", "î"), ("Ã¯", "ï"), ("Ã«", "ë"), ("Ã‰", "É"), ("Ã€", "À"), ("Ãˆ", "È"), ("ÃŽ", "Î"), ("Æ", "'"), ("Â", ""), ("Ã_", "í")]
HEAL_C = [("├®", "é"), ("├¨", "è"), ("├á", "à"), ("├ª", "ê"), ("├´", "ô"), ("├»", "û"), ("├¹", "ù"), ("├º", "ç"), ("├Ç", "Ç"), ("├Á", "é"), ("e" + chr(0x301), "é"), ("a" + chr(0x300), "à"), ("e" + chr(0x300), "è"), ("e" + chr(0x302), "ê"), ("ÔÇö", "—")]
HEAL_D = [("├®", "é"), ("├¿", "è"), ("├á", "à"), ("├¬", "ê"), ("├┤", "ô"), ("├╗", "û"), ("├╣", "ù"), ("├º", "ç"), ("├î", "î"), ("├Ç", "Ç"), ("├ü", "é"), ("├╝", "ü"), ("├½", "ë"), ("├»", "ï"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã\xa0", "à"), ("Ãª", "ê"), ("Ã´", "ô"), ("Ã§", "ç"), ("Ã»", "û"), ("Ã¹", "ù"), ("Ã®", "î"), ("Ã¯", "ï"), ("Ã«", "ë"), ("Ã‰", "É"), ("Ã€", "À"), ("Ãˆ", "È"), ("ÃŽ", "Î"), ("Ã¦", "æ"), ("Ã¶", "ö"), ("Ã¡", "á"), ("Ã±", "ñ"), ("Ã¼", "ü"), ("Æ", "'"), ("Â", ""), ("oû╣", "où"), ("ûº", "ç"), ("Ã_", "í")]
HEAL_E = [("├®", "é"), ("├¿", "è"), ("├á", "à"), ("├¬", "ê"), ("├┤", "ô"), ("├û", "î"), ("├º", "ç"), ("├ï", "ë"), ("├î", "î"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã ", "à"), ("Ãª", "ê"), ("Ã´", "ô"), ("Ã§", "ç"), ("├╣", " — "), ("├╗", '"'), ("├Ñ", "'"), ("├", "û"), ("Â", ""), ("Æ", "'")]
NOISE_E = ["Musique", "Music", "Applaudissements", "Applause", "Silence", "Rires"]
HEAL_F = [("├®", "é"), ("├á", "à"), ("├¿", "è"), ("├┤", "ô"), ("├¬", "ê"), ("├º", "ç"), ("├Ç", "À"), ("├╗", "û"), ("├«", "î"), ("├", " "), ("╠ü", "")]
HEAL_G = [(p + c, to) for c, to in (("®", "e"), ("¿", "e"), ("¬", "e"), ("ë", "E"), ("á", "a"), ("ª", "c"), ("┤", "o")) for p in ("|", "├")] + [("Ã" + c, to) for c, to in (("©", "e"), ("¨", "e"), ("\xa0", "a"), ("¹", "u"), ("¢", "a"), ("´", "o"), ("»", "u"), ("«", "e"), ("¯", "i"), ("®", "i"), ("§", "c"), ("ª", "e"))]
HEAL_H = [("├®", "é"), ("├¿", "è"), ("├á", "à"), ("├¬", "ê")]
#: Technical markers of captions in a text.
MARKERS = {
    "downloader_metadata": r'\A\s*\{\s*"id"\s*:\s*"[A-Za-z0-9_-]{11}"(?=[\s\S]{0,8192}"formats"\s*:)',
    "inline_timestamp": r"(?:<|&lt;|&amp;lt;|&#60;)(?:[0-9]+:)?[0-9]{2}:[0-9]{2}[.,][0-9]{3}(?:>|&gt;|&amp;gt;|&#62;)",
    "cue_timing": r"\b(?:[0-9]{2,}:)?[0-9]{2}:[0-9]{2}[.,][0-9]{3}\s*-->",
    "orphan_timecode": r"(?U)(?<!\w)[0-9]{2,}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}(?![0-9])",
    "cue_settings": r"(?i)\b(?:align|position|line|size|vertical):(?:start|middle|end|center|left|right|rl|lr|[0-9]+(?:\.[0-9]+)?%?)\b",
    "cue_tag": r"(?i)(?:<|&lt;|&amp;lt;)/?(?:c(?:\.[A-Za-z0-9_.-]+)*|v|lang|ruby|rt)(?:[ \t][^<>]*?)?(?:>|&gt;|&amp;gt;)",
    "vtt_header": r"(?i)\bWEBVTT\b|(?:^|\n)(?:Kind:[ \t]*captions|Language:[ \t]*[a-z]{2})",
}
#: The same without look-around, for SQL engines that have none.
PLAIN_MARKERS = MARKERS | {
    "downloader_metadata": r'\A\s*\{\s*"id"\s*:\s*"[A-Za-z0-9_-]{11}"[\s\S]*?"formats"\s*:',
    "orphan_timecode": r"(?:^|[^\p{L}\p{N}_])[0-9]{2,}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}(?:$|[^0-9])",
}
CORRUPTION = "�|Ôò|Ôö|û[▓╣┬│]|[┬├][\u0080-￿]"
WEAK_CORRUPTION = "Ã.|Â."
#: Errors of a fetch, by category.
FAILURES = {
    "http_429": r"HTTP(?: Error)?\s*429|Too Many Requests", "page_reload_required": r"page needs to be reloaded", "authentication_required": r"Sign in to confirm|login required|authentication required",
    "cookie_access_failed": r"could not (?:copy|find|read).*cookie|failed to decrypt|cookie database.*(?:locked|not found)", "javascript_runtime_missing": r"no supported JavaScript runtime|JavaScript runtime.*not found",
    "video_unavailable": r"Video unavailable|Private video|video has been removed", "http_403": r"HTTP(?: Error)?\s*403", "network_timeout": r"timed out|timeout", "outdated_extractor": r"older than 90 days",
}
#: Marks, conjoining letters and characters that have another form of their own: texts without any are composed already.
MAY_COMPOSE = r"[\p{M}\u1100-\u11ff\u0374\u037e\u0387\u1f71-\u1fff\u2000\u2001\u2126\u212a\u212b\u2329\u232a\u2adc\uf900-\ufaff\ufb1d-\ufb4e\x{1d15e}-\x{1d1c0}\x{2f800}-\x{2fa1d}]"
#: Words that turn a sentence's meaning round.
NEGATIONS = ("not", "no", "never", "without", "neither", "ne", "pas", "non", "sans", "jamais")
# End of fixed values.


def has_text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))) != ""


def replaced(c: Column, pairs: list[tuple[str, str]]) -> Column:
    """Each pair's replacement in turn."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def word_count_spaces(c: Column) -> Column:
    """Blanks plus one."""
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit(""))) + 1


def words(c: Column) -> Column:
    """What white space parts, as an array."""
    return F.filter(F.split(c, r"[ \t\n\r\f]+"), lambda x: x != "")


def tokens(c: Column) -> Column:
    """Runs of letters, digits, marks, low lines, apostrophes and hyphens, in lower case."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{N}\p{M}_’'-]+"), F.lit(0))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def collapsed(array: Column) -> Column:
    """Without elements that equal the one before."""
    return let(array, lambda a: F.filter(a, lambda x, i: (i == 0) | (x != F.get(a, i - 1))))


def heaviest(array: Column, weight: Callable[[Column], Column]) -> Column:
    """The largest weight times count of equal elements: one pass over the sorted array."""
    zero = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("best"))

    def step(s: Column, x: Column) -> Column:
        total = F.when(s["last"] == x, s["sum"]).otherwise(F.lit(0)) + weight(x).cast("long")
        return F.struct(x.alias("last"), total.alias("sum"), F.greatest(s["best"], total).alias("best"))

    return F.aggregate(F.array_sort(array), zero, step, lambda s: s["best"])


def safe_label(c: Column) -> Column:
    return F.substring(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_.-]", "_"), r"^[. ]+|[. ]+$", ""), 1, 80)


def quotes_plain(c: Column) -> Column:
    return F.translate(c, "‘’‚‛“”„‟", "''''\"\"\"\"")


def excerpt(c: Column, needle: str, radius: int = 100) -> Column:
    """The text around the first occurrence."""
    def around(at: Column) -> Column:
        start = F.greatest(at - radius, F.lit(1))
        return F.when(at > 0, F.substring(c, start, F.least(at + len(needle) - 1 + radius, F.length(c)) - start + 1))

    return let(F.locate(needle, c), around)


def folded(c: Column) -> Column:
    """Lower case without the accents of Latin letters."""
    return F.translate(F.lower(c), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")


def clean_rendered(c: Column) -> Column:
    """A caption file's text without tags, headers, times, settings, entities, and words that are said twice on end."""
    t = F.regexp_replace(c, r"(?s)<.*?>", "")
    t = F.regexp_replace(t, r"(?im)^(?:WEBVTT[ \t]*|Kind:[^\n]*|Language:[^\n]*)$", "")
    t = F.regexp_replace(t, r"(?i)(?:align|position|size|line|vertical|region|style):[^ \t\n\r]+", " ")
    t = F.regexp_replace(t, r"[0-9]{8}\|[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}", " ")
    t = F.regexp_replace(t, r"[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}[ \t\n]*-->[ \t\n]*[0-9]{1,2}:[0-9]{2}:[0-9]{2}[.,][0-9]{3}", " ")
    t = F.regexp_replace(t, r"\b[0-9]{1,2}:[0-9]{2}\b", " ")
    t = F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"(?m)^[0-9]+[ \t]*$", ""), r"&[A-Za-z0-9_]+;", " "), r"[ \t\n\r]+", " ")
    t = F.regexp_replace(quotes_plain(t), r"([a-zA-Z])\?([a-zA-Z])", "$1'$2")
    return F.array_join(let(words(t), lambda w: F.filter(w, lambda x, i: (i == 0) | (F.lower(x) != F.lower(F.get(w, i - 1))))), " ")


def duckdb_replaced(c: str, pairs: list[tuple[str, str]]) -> str:
    """The same as replaced(), as SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    return reduce(lambda x, p: f"replace({x}, {quote(p[0])}, {quote(p[1])})", pairs, c)

"""Text cleaning as Column functions.

Every function maps columns to a column, so cleaning runs inside the scan stage
with no shuffle and no Python worker.  Java's ``\\w``, ``\\s`` and ``\\b`` are
ASCII-only unless ``(?U)`` is set; reviews are multilingual, so it always is.
"""

from __future__ import annotations

import html
import html.entities
import json
import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: patterns, abbreviations and language codes ----------------
EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"
DATE = r"(?U)\b\d{2}[/-]\d{2}[/-]\d{4}\b"
PHONE = r"(?U)\+?\d{1,3}[-.\s]?\(?\d{1,4}\)?[-.\s]?\d{4,10}"
HASHTAG = r"(?U)#\w+"
MENTION = r"(?U)@\w+"
URL = (
    r"(?iU)(?:https?://|www\d{0,3}[.])"
    r"(?:[^\s()<>{}\[\]]+|(?:\([^\s()<>]+\)))+"
    r"(?:\([^\s()<>]+\)|[^\s`!()\[\]{};:'\".,<>?«»“”‘’])*"
)
THING_TAG = r"\[thing=(\d+)\]\[/thing\]"
SENTENCE_BREAK = r"(?<=[.!?])\s+"
ABBREVIATIONS = {
    "Sr": "Señor", "Sra": "Señora", "Dr": "Doctor", "Dra": "Doctora",
    "EE.UU": "Estados Unidos", "etc": "etcétera", "info": "information",
    "mins": "minutes", "hr": "hour", "yrs": "years",
}
STOPWORD_LANGUAGE = {
    "en": "english", "es": "spanish", "pt": "portuguese", "fr": "french",
    "de": "german", "it": "italian", "nl": "dutch",
}
# -----------------------------------------------------------------------------

EMOJI = (
    r"[\x{1F1E6}-\x{1F1FF}\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}\x{1F900}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B05}-\x{2B55}\x{231A}-\x{231B}"
    r"\x{23E9}-\x{23FA}]"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times in ``body``.

    An expression that a lambda refers to is evaluated again for every element;
    binding it to a lambda variable first makes that one evaluation.
    """
    return F.transform(F.array(value), body)[0]


def only_if(text: Column, some: Callable[[Column], Column], step: Callable[[Column], Column]) -> Column:
    """``step`` of the texts for which the cheap test ``some`` holds; it must hold wherever the step changes anything."""
    return let(text, lambda t: F.when(some(t), step(t)).otherwise(t))


def not_ascii(text: Column) -> Column:
    """The text holds a character beyond ASCII: more bytes than characters."""
    return F.octet_length(text) > F.length(text)


def literal_map(pairs: dict[str, str]) -> Column:
    """A constant map; the optimizer folds it to one literal."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(text, F.lit("")).rlike(r"(?U)\S")


# ------------------------------------------------------------------ entities
def _entity_tables() -> tuple[dict[str, str], list[str]]:
    """Named references from the standard library, and those legal without ``;``."""
    named = dict(html.entities.html5)
    bare = sorted((k for k in named if not k.endswith(";")), key=len, reverse=True)
    return named, bare


def _special_references() -> dict[str, str]:
    """What the standard makes of control characters, their code page and non-characters."""
    odd = [*range(0xA0), *range(0xFDD0, 0xFDF0)]
    odd += [plane * 0x10000 + low for plane in range(17) for low in (0xFFFE, 0xFFFF)]
    return {str(n): html.unescape(f"&#{n};") for n in odd if n < 32 or n > 126}


def _code_point(number: Column) -> Column:
    """The character of a numeric reference, by the rules of the HTML standard."""
    valid = (number < 0xD800) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    char = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    special = F.try_element_at(literal_map(_special_references()), number.cast("string"))
    return F.coalesce(special, F.when(valid, char), F.lit("\ufffd"))


def unescape_html(text: Column) -> Column:
    """Decode named, decimal and hexadecimal character references in one pass.

    The text is cut before every ``&``; each piece starts with at most one
    reference, so nothing is decoded twice.
    """
    named, bare = _entity_tables()
    with_semicolon = literal_map({k[:-1]: v for k, v in named.items() if k.endswith(";")})
    without = literal_map({k: named[k] for k in bare})
    bare_pattern = "^&(" + "|".join(bare) + ")"

    def decode(piece: Column) -> Column:
        dec = F.regexp_extract(piece, r"^&#0*([0-9]+);?", 1)
        hexa = F.regexp_extract(piece, r"^&#[xX]0*([0-9a-fA-F]+);?", 1)
        full = F.regexp_extract(piece, r"^&([a-zA-Z][a-zA-Z0-9]{0,31});", 1)
        legacy = F.regexp_extract(piece, bare_pattern, 1)
        full_value = F.try_element_at(with_semicolon, full)

        def rest(pattern: str) -> Column:
            return F.regexp_replace(piece, pattern, "")

        dec_number = F.when(F.length(dec) <= 9, dec.try_cast("bigint"))
        hex_number = F.when(F.length(hexa) <= 9, F.conv(hexa, 16, 10).try_cast("bigint"))
        return (
            F.when(~piece.startswith("&"), piece)
            .when(dec != "", F.concat(_code_point(dec_number), rest(r"^&#[0-9]+;?")))
            .when(hexa != "", F.concat(_code_point(hex_number), rest(r"^&#[xX][0-9a-fA-F]+;?")))
            .when((full != "") & full_value.isNotNull(),
                  F.concat(full_value, rest(r"^&[a-zA-Z][a-zA-Z0-9]*;")))
            .when(legacy != "", F.concat(F.try_element_at(without, legacy), rest(bare_pattern)))
            .otherwise(piece)
        )

    def run(t: Column) -> Column:
        decoded = F.array_join(F.transform(F.split(t, "(?=&)"), decode), "")
        return F.when(t.contains("&"), decoded).otherwise(t)

    return let(text, run)


# --------------------------------------------------------------- clean steps
def strip_tags(text: Column) -> Column:
    return only_if(text, lambda t: t.contains("<"), lambda t: F.regexp_replace(t, r"<[^>]+>", " "))


def strip_bbcode(text: Column) -> Column:
    return only_if(text, lambda t: t.contains("["), lambda t: F.regexp_replace(t, r"\[/?[a-zA-Z]+\]", " "))


def mask_urls(text: Column) -> Column:
    return only_if(text, lambda t: t.contains("://") | t.rlike("[wW]{3}"), lambda t: F.regexp_replace(t, URL, "URL"))


def replace_thing_tags(text: Column, names: Column | None = None) -> Column:
    """Replace ``[thing=N][/thing]`` by the name of item N; unknown items vanish.

    ``names`` is a ``map<bigint,string>`` column that holds the ids of this row
    only; :func:`glosa.operators.merge.attach_thing_names` builds it with a join.
    """
    if names is None:
        return F.regexp_replace(text, THING_TAG, "")

    def put_back(piece: Column) -> Column:
        number = F.regexp_extract(piece, "^" + THING_TAG, 1)
        name = F.coalesce(F.try_element_at(names, number.try_cast("bigint")), F.lit(""))
        return F.when(number != "", F.concat(name, F.regexp_replace(piece, "^" + THING_TAG, ""))).otherwise(piece)

    def run(t: Column) -> Column:
        pieces = F.split(t, r"(?=\[thing=\d+\]\[/thing\])")
        replaced = F.array_join(F.transform(pieces, put_back), "")
        return F.when(t.contains("[thing="), replaced).otherwise(t)

    return let(text, run)


def collapse_repeats(text: Column, ascii_only: bool = False) -> Column:
    """Runs of three or more equal characters become two."""
    unit = "([a-zA-Z0-9])" if ascii_only else r"([^\n])"
    return F.regexp_replace(text, unit + r"\1{2,}", "$1$1")


def collapse_punctuation(text: Column) -> Column:
    """Runs of ``!`` or ``?`` become two, runs of dots become one."""

    def run(t: Column) -> Column:
        marks = F.regexp_replace(t, r"([!?])\1+", "$1$1")
        return F.regexp_replace(marks, r"\.{2,}", ".")

    return only_if(text, lambda t: t.contains("!!") | t.contains("??") | t.contains(".."), run)


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def _latin_tables() -> tuple[str, str, dict[str, str]]:
    """Latin letters with their base letter, from Unicode decompositions."""
    source, target, longer = [], [], {}
    blocks = [(0x00C0, 0x0250), (0x1E00, 0x1F00), (0xFB00, 0xFB07), (0xFF01, 0xFF5F)]
    for start, end in blocks:
        for code in range(start, end):
            char = chr(code)
            base = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
            if len(base) == 1:
                source.append(char)
                target.append(base)
            elif len(base) > 1:
                longer[char] = base
    return "".join(source), "".join(target), longer


#: Texts with at most so many different characters beyond ASCII are spelled character by character, not piece by piece.
FEW_LETTERS = 64

# Letters and marks that have no Unicode decomposition.
SPECIAL_LETTERS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o",
    "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "Th", "þ": "th", "Ł": "L", "ł": "l",
    "ı": "i", "ẞ": "SS", "€": "EUR", "…": "...", "«": "<<", "»": ">>",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "--", "\u00a0": " ",
    "ª": "a", "º": "o", "µ": "u", "²": "2", "³": "3", "¹": "1",
    "¡": "!", "¿": "?", "·": "*", "©": "(c)", "®": "(r)", "™": "(tm)", "°": "deg",
}


# Cyrillic and Greek letters in the usual Latin spelling.
CYRILLIC = dict(zip(
    "абвгдеёжзийклмнопрстуфхцчшщъыьэюяіїєґђјљњћџ",
    "a b v g d e e zh z i i k l m n o p r s t u f kh ts ch sh shch \" y ' e iu ia i i ie g dj j lj nj c dz".split(),
))
GREEK = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a b g d e z e th i k l m n x o p r s s t u ph kh ps o".split()))


def _script_tables() -> dict[str, str]:
    """Letters of Cyrillic, Greek and kana with their Latin spelling, in both cases.

    Accented letters follow their base letter; kana are spelled by their Unicode names.
    """
    table = {}
    for low, latin in {**CYRILLIC, **GREEK}.items():
        table[low] = latin
        table.setdefault(low.upper(), latin.capitalize())
    for code in [*range(0x0370, 0x0530), *range(0x1F00, 0x2000)]:
        base = unicodedata.normalize("NFD", chr(code))[0]
        if chr(code) not in table and base in table:
            table[chr(code)] = table[base]
    for code in [*range(0x3041, 0x3097), *range(0x30A1, 0x30FB)]:
        table[chr(code)] = unicodedata.name(chr(code)).split()[-1].lower()
    return table


def transliterate(text: Column) -> Column:
    """Latin, Cyrillic, Greek and kana to ASCII; letters and digits of other scripts stay as they are.

    Marks and symbols without a spelling are dropped.  Every different character of a text is looked up once
    and replaced wherever it stands: its spelling is ASCII or itself, so the order does not matter.
    """
    source, target, longer = _latin_tables()
    longer = {**longer, **SPECIAL_LETTERS}
    scripts = _script_tables()
    single = {k: v for k, v in longer.items() if len(v) == 1}
    multi = {k: v for k, v in longer.items() if len(v) > 1}
    source += "".join(single)
    target += "".join(single.values())
    source += "".join(k for k, v in scripts.items() if len(v) == 1)
    target += "".join(v for v in scripts.values() if len(v) == 1)
    spelled = literal_map({**multi, **{k: v for k, v in scripts.items() if len(v) > 1}})
    # Surrogates are left out, or a character beyond 16 bits would be cut in two.
    each = r"(?=[\x{80}-\x{D7FF}\x{E000}-\x{10FFFF}])"

    def letter(c: Column) -> Column:
        """ASCII for one character beyond ASCII, or what stays of it."""
        dropped = c.rlike(r"[^\x00-\x7F\p{L}\p{M}\p{N}]|[\u0300-\u036F]")
        return F.when(c < "\x80", c).otherwise(F.coalesce(F.try_element_at(spelled, c), F.when(dropped, "").otherwise(c)))

    def spell(piece: Column) -> Column:
        """A piece, of which only the first character may be beyond ASCII."""
        return F.concat(let(F.translate(F.substring(piece, 1, 1), source, target), letter), F.substring(piece, 2, 1 << 30))

    def replace(odd: Column, t: Column) -> Column:
        return F.aggregate(odd, t, lambda done, c: F.replace(done, c, let(F.translate(c, source, target), letter)))

    def run(t: Column) -> Column:
        odd = F.array_distinct(F.regexp_extract_all(t, F.lit(r"[\x{80}-\x{D7FF}\x{E000}-\x{10FFFF}]"), F.lit(0)))
        pieces = F.array_join(F.transform(F.split(t, each), spell), "")
        return let(odd, lambda o: F.when(F.size(o) <= FEW_LETTERS, replace(o, t)).otherwise(pieces))

    return only_if(text, not_ascii, run)


#: White space other than the blank, as ``(?U)\\s`` has it.
ODD_SPACE = r"[\t-\r\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]"


def expand_abbreviations(text: Column, table: dict[str, str] | None = None,
                         ascii_words_only: bool = False) -> Column:
    """Whole-token replacement after splitting on white space; texts without such a token are not split."""
    table = ABBREVIATIONS if table is None else table
    some = " (?:" + "|".join(re.escape(k) for k in table) + ") "
    lookup = literal_map(table)

    def expand(word: Column) -> Column:
        hit = word.isin(*table)
        if ascii_words_only:
            hit = hit & word.rlike("^[a-zA-Z]+$")
        return F.when(hit, F.element_at(lookup, word)).otherwise(word)

    def run(t: Column) -> Column:
        if not table:
            return t
        expanded = F.trim(F.array_join(F.transform(F.split(t, " "), expand), " "))
        return F.when(F.concat(F.lit(" "), t, F.lit(" ")).rlike(some), expanded).otherwise(t)

    def tidy(t: Column) -> Column:
        """``collapse_space`` of a text that mostly holds single spaces only."""
        return F.when(t.contains("  ") | t.rlike(ODD_SPACE), collapse_space(t)).otherwise(F.trim(t))

    return let(let(text, tidy), run)


def remove_problem_characters(text: Column) -> Column:
    """Drop control and zero-width characters, straighten quotes and dashes."""
    text = F.regexp_replace(text, r"[\x00-\x08\x0b-\x0c\x0e-\x1f\x7f-\x9f]", "")
    text = F.regexp_replace(text, r"[\u200b-\u200f\u202a-\u202e\u2060-\u206f\ufeff]", "")
    text = F.translate(text, "‘’“”–—", "''\"\"--")
    return F.replace(text, F.lit("…"), F.lit("..."))


def emoji_names() -> dict[str, str]:
    """Character -> name for every emoji code point, from the Unicode name table."""
    ranges = [(0x1F300, 0x1F650), (0x1F680, 0x1F700), (0x1F900, 0x1FB00), (0x2600, 0x27C0)]
    names = {}
    for start, end in ranges:
        for code in range(start, end):
            name = unicodedata.name(chr(code), "")
            if name:
                names[chr(code)] = name.lower().replace(" ", "_").replace("-", "_")
    return names


def name_emoji(text: Column, delimiter: str = ":", names: dict[str, str] | None = None) -> Column:
    """Replace each emoji by its delimited name."""
    table = literal_map(emoji_names() if names is None else names)

    def spell(piece: Column) -> Column:
        char = F.regexp_extract(piece, "^(" + EMOJI + ")", 1)
        name = F.try_element_at(table, char)
        return F.when(
            (char != "") & name.isNotNull(),
            F.concat(F.lit(delimiter), name, F.lit(delimiter), F.regexp_replace(piece, "^" + EMOJI, "")),
        ).otherwise(piece)

    def run(t: Column) -> Column:
        pieces = F.split(t, "(?=" + EMOJI + ")")
        return F.when(t.rlike(EMOJI), F.array_join(F.transform(pieces, spell), "")).otherwise(t)

    return let(text, run)


# ------------------------------------------------------------- compositions
def _markup_to_text(text: Column, names: Column | None) -> Column:
    text = replace_thing_tags(unescape_html(text), names)
    return mask_urls(strip_bbcode(strip_tags(text)))


def normalize_text(text: Column, lower: bool = True, names: Column | None = None) -> Column:
    """Clean a review for matching and tokenising; ASCII, but for scripts without a Latin spelling here."""
    out = _markup_to_text(text, names)
    out = collapse_space(collapse_punctuation(collapse_repeats(out)))
    if lower:
        out = F.lower(out)
    out = expand_abbreviations(transliterate(out))
    return F.when(is_blank(text), F.lit("")).otherwise(out)


def normalize_keep_accents(text: Column, lower: bool = True, names: Column | None = None) -> Column:
    """Clean a review but keep its accents; only ASCII letters and digits collapse."""
    out = _markup_to_text(text, names)
    out = collapse_space(collapse_punctuation(collapse_repeats(out, ascii_only=True)))
    if lower:
        out = F.lower(out)
    out = remove_problem_characters(name_emoji(out, " "))
    out = expand_abbreviations(out, ascii_words_only=True)
    return F.when(is_blank(text), F.lit("")).otherwise(out)


def merge_key(username: Column, comment: Column) -> Column:
    """Key under which two sources are taken to hold the same review."""
    return F.struct(
        F.lower(strip(F.coalesce(username, F.lit("unknown")))).alias("ukey"),
        normalize_text(F.coalesce(comment, F.lit(""))).alias("ckey"),
    )


# ------------------------------------------------------------------ extract
def special_patterns(text: Column) -> Column:
    """Struct of arrays: e-mails, dates, phones, hashtags, mentions, URLs, emojis."""
    wanted = {
        "emails": EMAIL, "dates": DATE, "phones": PHONE, "hashtags": HASHTAG,
        "mentions": MENTION, "urls": URL, "emojis": EMOJI,
    }
    return F.struct(*[
        F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(n) for n, p in wanted.items()
    ])


def sentences(text: Column) -> Column:
    parts = F.split(text, SENTENCE_BREAK)
    return F.filter(parts, lambda s: F.trim(s) != "")


def word_tokens(text: Column) -> Column:
    """Lower-case runs of word characters; plain ASCII texts spare the Unicode classes."""

    def run(t: Column) -> Column:
        every, plain = (F.regexp_extract_all(t, F.lit(p), F.lit(0)) for p in (r"(?U)\w+", r"\w+"))
        return F.when(not_ascii(t), every).otherwise(plain)

    return let(F.lower(text), run)


def prefix_language(tokens: Column, lang: Column) -> Column:
    return F.transform(tokens, lambda t: F.concat(lang, F.lit("_"), t))


def language_code(code: Column) -> Column:
    """Two-letter code; null, ``unknown`` and unsupported languages become ``en``."""
    short = F.lower(F.substring_index(F.coalesce(code, F.lit("unknown")), "-", 1))
    return F.when(short.isin(*STOPWORD_LANGUAGE), short).otherwise(F.lit("en"))


def stopword_language(code: Column) -> Column:
    """Name of the stop-word list for a language code, ``english`` by default."""
    return F.coalesce(
        F.try_element_at(literal_map(STOPWORD_LANGUAGE), F.lower(F.coalesce(code, F.lit("")))),
        F.lit("english"),
    )


# ------------------------------------------------------------------- scalars
def rating_label(rating: Column) -> Column:
    """positive from 7, neutral from 5, negative below; NaN is negative, null stays null."""
    return (
        F.when(rating.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(rating), F.lit("negative"))
        .when(rating >= 7, F.lit("positive"))
        .when(rating >= 5, F.lit("neutral"))
        .otherwise(F.lit("negative"))
    )


def flag_value(flag: Column, boolean: bool = False) -> Column:
    """0 or 1; text and numbers must be exactly 0 or 1, anything else is null."""
    if boolean:
        return flag.cast("int")
    text = F.trim(flag.cast("string"))
    return F.when(text.isin("0", "1"), text).cast("int")


def number_or_null(value: Column, kind: str = "double") -> Column:
    """Tolerant number: sentinels and unparsable text become null."""
    as_double = F.nullif(F.trim(value.cast("string")), F.lit("N/A")).try_cast("double")
    if kind == "double":
        return as_double
    return F.when(~F.isnan(as_double), as_double).try_cast(kind)


def exclamations(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("!"), F.lit("")))


def repeated_punctuation(text: Column) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(r"([!?.,])\1+"), F.lit(0)))


def phrase_count(text: Column, phrases: list[str]) -> Column:
    """Sum of non-overlapping occurrences of each phrase."""
    total = F.lit(0)
    for phrase in phrases:
        gone = F.length(text) - F.length(F.replace(text, F.lit(phrase), F.lit("")))
        total = total + (gone / F.lit(len(phrase))).cast("int")
    return total


def readability(text: Column) -> Column:
    """Flesch grade and ease, and the number of words of three or more vowel groups."""
    return readability_of(word_tokens(text), F.size(sentences(text)))


def readability_of(words: Column, n_sentences: Column) -> Column:
    """``readability`` of a text, given its lower-case words and the number of its sentences."""
    n_sentences = F.greatest(n_sentences, F.lit(1))
    groups = F.transform(
        words, lambda w: F.greatest(F.size(F.regexp_extract_all(w, F.lit("[aeiouy]+"), F.lit(0))), F.lit(1))
    )

    def scores(g: Column) -> Column:
        n = F.size(g)
        syllables = F.aggregate(g, F.lit(0), lambda a, x: a + x)
        per_word = syllables / F.greatest(n, F.lit(1))
        return F.struct(
            F.when(n == 0, 0.0).otherwise(0.39 * n / n_sentences + 11.8 * per_word - 15.59).alias("fk_grade"),
            F.when(n == 0, 0.0).otherwise(206.835 - 1.015 * n / n_sentences - 84.6 * per_word).alias("ease"),
            F.size(F.filter(g, lambda x: x >= 3)).alias("complex_words"),
            n.alias("words"),
        )

    return let(groups, scores)


"""SQL fragments that restate the derived views for a second engine."""

from __future__ import annotations

from glosa.functions.lexicons import default_stopwords
from glosa.functions.text import STOPWORD_LANGUAGE
from glosa.plans.views import PROSE_LEXICON

REV = """rev AS (
  SELECT doc_id AS review_id, CAST(substr(source, 4) AS BIGINT) AS game_id,
         'user' || CAST(doc_id % 137 AS VARCHAR) AS username,
         CASE WHEN doc_id % 23 = 0 THEN NULL
              ELSE CAST(10 + (doc_id * 37) % 91 AS DOUBLE) / CAST(10 AS DOUBLE) END AS rating,
         text AS comment, 1700000000 + doc_id * 3600 AS ts, lang
  FROM documents),
lab AS (
  SELECT *, CASE WHEN rating IS NULL THEN NULL WHEN rating >= 7 THEN 'positive'
                 WHEN rating >= 5 THEN 'neutral' ELSE 'negative' END AS label
  FROM rev)"""

URL_RE2 = (
    r"(?i)(?:https?://|www\d{0,3}[.])(?:[^\s()<>{}\[\]]+|(?:\([^\s()<>]+\)))+"
    r"(?:\([^\s()<>]+\)|[^\s`!()\[\]{};:''\".,<>?«»“”‘’])*"
)


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def in_list(column: str, terms) -> str:
    return f"{column} IN (" + ", ".join(lit(t) for t in terms) + ")"


def collapse_any(x: str) -> str:
    """Runs of 3+ equal characters to two, character by character."""
    chars = f"string_split({x}, '')"
    return (
        f"(SELECT array_to_string(list_filter(c, lambda z, i: NOT (i > 2 AND z = c[i-1] AND z = c[i-2])), '') "
        f"FROM (SELECT {chars} AS c))"
    )


def collapse_ascii(x: str) -> str:
    for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789":
        x = f"regexp_replace({x}, '{c}{{3,}}', '{c}{c}', 'g')"
    return x


def markup(x: str) -> str:
    for name, value in (("&copy;", "©"), ("&middot;", "·"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        x = f"replace({x}, {lit(name)}, {lit(value)})"
    x = rf"regexp_replace({x}, '\[thing=\d+\]\[/thing\]', '', 'g')"
    x = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    x = rf"regexp_replace({x}, '\[/?[a-zA-Z]+\]', ' ', 'g')"
    x = f"regexp_replace({x}, '{URL_RE2}', 'URL', 'g')"
    return rf"regexp_replace(regexp_replace({x}, '[\r\n]', ' ', 'g'), '[\t\v\f]+', ' ', 'g')"


def punctuation_space(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x}, '!{{2,}}', '!!', 'g'), '\?{{2,}}', '??', 'g')"
    x = rf"regexp_replace({x}, '\.{{2,}}', '.', 'g')"
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def abbreviations(x: str) -> str:
    return (
        f"trim(array_to_string(list_transform(string_split({x}, ' '), lambda w: CASE w WHEN 'etc' THEN 'etcétera' "
        "WHEN 'info' THEN 'information' WHEN 'mins' THEN 'minutes' WHEN 'hr' THEN 'hour' WHEN 'yrs' THEN 'years' "
        "ELSE w END), ' '))"
    )


def clean_cte(source: str, key: str, column: str, out: str = "clean") -> str:
    """CTEs that normalise ``column`` of ``source``; the last one is (key, clean_text)."""
    ascii_text = (
        "regexp_replace(replace(replace(replace(strip_accents(lower(t)), 'ß', 'ss'), '©', '(c)'), '·', '*'),"
        r" '[^\x00-\x7F\p{L}\p{M}\p{N}]', '', 'g')"
    )
    return f"""
{out}_1 AS (SELECT {key}, {markup(column)} AS t FROM {source}),
{out}_2 AS (SELECT {key}, string_split(t, '') AS c FROM {out}_1),
{out}_3 AS (SELECT {key}, array_to_string(list_filter(c, lambda z, i: NOT (i > 2 AND z = c[i-1] AND z = c[i-2])), '') AS t FROM {out}_2),
{out}_4 AS (SELECT {key}, {punctuation_space('t')} AS t FROM {out}_3),
{out}_5 AS (SELECT {key}, {ascii_text} AS t FROM {out}_4),
{out} AS (SELECT {key}, {abbreviations('t')} AS clean_text FROM {out}_5)"""


def stopword_cte() -> str:
    lists = ", ".join(
        f"({lit(c)}, [" + ", ".join(lit(w) for w in default_stopwords(n)) + "])" for c, n in STOPWORD_LANGUAGE.items()
    )
    return f"stops AS (SELECT * FROM (VALUES {lists}) AS v(lang, words))"


def docs_cte() -> str:
    """rev, lab, docs(review_id, ..., clean_text, tokens) and toks(review_id, game_id, label, lang, pos, token)."""
    return f"""{REV},
{clean_cte('lab', 'review_id', 'comment')},
{stopword_cte()},
docs AS (
  SELECT lab.*, clean.clean_text,
         list_filter(regexp_extract_all(lower(clean.clean_text), '[\\pL\\pN_]+'),
                     lambda w: NOT list_contains(stops.words, w)) AS tokens
  FROM lab JOIN clean USING (review_id) JOIN stops ON stops.lang = lab.lang),
toks AS (
  SELECT review_id, game_id, label, lang, unnest(tokens) AS token, generate_subscripts(tokens, 1) - 1 AS pos FROM docs)"""


def with_docs(body: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH RECURSIVE {docs_cte()}{extra}\n{body}"


def with_reviews(body: str, *ctes: str) -> str:
    extra = "".join(",\n" + c for c in ctes)
    return f"WITH {REV}{extra}\n{body}"


KEY = "((review_id % 2147483648) * 2654435761 + 42) % 4294967296"


def lex(column: str, *names: str) -> str:
    """Membership of a column in the union of named sets of the prose lexicon."""
    terms: list[str] = []
    for name in names:
        terms += PROSE_LEXICON.domain_terms if name == "domain" else PROSE_LEXICON.terms_of(name)
    return in_list(column, dict.fromkeys(terms))


SENT = ("positive", "negative")
HEDGE = ("hedge_words", "propositional", "relational", "discourse")


def valence_case(column: str) -> str:
    cases = "".join(f" WHEN {lit(t)} THEN CAST({v!r} AS DOUBLE)" for t, v in PROSE_LEXICON.valence.items())
    return f"CASE {column}{cases} ELSE CAST(0 AS DOUBLE) END"

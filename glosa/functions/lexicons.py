"""Lexicons and stop words.

A lexicon is small by nature: the hash set built from it lives inside the plan
(``isin`` compiles to a set look-up), so matching tokens needs neither a shuffle
nor a broadcast join.  ``Lexicon`` refuses lists beyond ``MAX_TERMS``; larger
vocabularies go through :func:`glosa.operators.frequency.lexicon_hits`, a join.
"""

from __future__ import annotations

import glob
import os
import zipfile
from collections.abc import Iterable
from dataclasses import dataclass, field
from functools import lru_cache

import pyspark
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from glosa.functions import word_lists as W
from glosa.functions.text import STOPWORD_LANGUAGE, strip

MAX_TERMS = 50_000


@dataclass
class Lexicon:
    """Named term sets; every list is lower-cased and de-duplicated."""

    positive: list[str] = field(default_factory=lambda: list(W.POSITIVE_WORDS))
    negative: list[str] = field(default_factory=lambda: list(W.NEGATIVE_WORDS))
    intensifiers: list[str] = field(default_factory=lambda: list(W.BOOSTERS))
    mitigators: list[str] = field(default_factory=lambda: list(W.MITIGATORS))
    negations: list[str] = field(default_factory=lambda: list(W.NEGATIONS))
    hedge_words: list[str] = field(default_factory=lambda: list(W.HEDGE_WORDS))
    propositional: list[str] = field(default_factory=lambda: list(W.PROPOSITIONAL_HEDGES))
    relational: list[str] = field(default_factory=lambda: list(W.RELATIONAL_HEDGES))
    discourse: list[str] = field(default_factory=lambda: list(W.DISCOURSE_MARKERS))
    certainty: list[str] = field(default_factory=lambda: list(W.CERTAINTY_MARKERS))
    domain: dict[str, list[str]] = field(default_factory=lambda: dict(W.DOMAIN_TERMS))
    valence: dict[str, float] = field(default_factory=lambda: dict(W.VALENCE))

    def __post_init__(self) -> None:
        total = len(self.valence)
        for name in self.flat_names():
            terms = list(dict.fromkeys(t.strip().lower() for t in getattr(self, name) if t.strip()))
            setattr(self, name, terms)
            total += len(terms)
        self.domain = {s: list(dict.fromkeys(t.lower() for t in ts)) for s, ts in self.domain.items()}
        total += sum(len(ts) for ts in self.domain.values())
        if total > MAX_TERMS:
            raise ValueError(f"{total} terms exceed {MAX_TERMS}; match a vocabulary of this size with a join")

    @staticmethod
    def flat_names() -> list[str]:
        return ["positive", "negative", "intensifiers", "mitigators", "negations", "hedge_words",
                "propositional", "relational", "discourse", "certainty"]

    @property
    def sentiment(self) -> list[str]:
        return list(dict.fromkeys(self.positive + self.negative))

    @property
    def all_hedges(self) -> list[str]:
        """Union of the four hedge lists."""
        return list(dict.fromkeys(self.hedge_words + self.propositional + self.relational + self.discourse))

    @property
    def domain_terms(self) -> list[str]:
        return list(dict.fromkeys(t for terms in self.domain.values() for t in terms))

    def bits(self) -> dict[str, int]:
        """Bit of every term set in a token mark; sections are named ``domain.SECTION``."""
        names = self.flat_names() + ["epistemic", "subjective"] + [f"domain.{s}" for s in self.domain]
        if len(names) > 62:
            raise ValueError("a token mark holds at most 62 term sets")
        return {n: 1 << i for i, n in enumerate(names)}

    def mask(self, *names: str) -> int:
        """Marks of the named sets together; ``domain`` stands for all its sections."""
        out = 0
        for name, bit in self.bits().items():
            if name in names or (name.startswith("domain.") and "domain" in names):
                out |= bit
        return out

    def terms_of(self, name: str) -> list[str]:
        if name == "epistemic":
            return W.EPISTEMIC_MARKERS
        if name == "subjective":
            return W.SUBJECTIVITY_MARKERS
        return self.domain[name[7:]] if name.startswith("domain.") else getattr(self, name)

    def mark_sql(self, variable: str, *names: str) -> str:
        """SQL bit mask of the sets (all, or the named ones) a word belongs to.

        Most words belong to none: one look-up in the union settles those.
        """
        bits = {n: b for n, b in self.bits().items() if self.terms_of(n) and (not names or n in names)}
        if not bits:
            return "0L"
        union = dict.fromkeys(t for n in bits for t in self.terms_of(n))
        parts = " | ".join(f"IF({sql_in(variable, self.terms_of(n))}, {b}L, 0L)" for n, b in bits.items())
        return f"IF({sql_in(variable, union)}, {parts}, 0L)"

    def valence_sql(self, variable: str) -> str:
        by_score: dict[float, list[str]] = {}
        for term, score in self.valence.items():
            by_score.setdefault(float(score), []).append(term)
        cases = "".join(f" WHEN {sql_in(variable, ts)} THEN {s!r}D" for s, ts in by_score.items())
        return f"IF({sql_in(variable, self.valence)}, CASE{cases} ELSE 0.0D END, 0.0D)" if cases else "0.0D"

    def marks(self, tokens: str) -> Column:
        """Array of marks parallel to the token array column ``tokens``."""
        return F.expr(f"transform({tokens}, t -> {self.mark_sql('t')})")

    def rows(self) -> list[tuple[str, str, str]]:
        """(name, section, term) rows; flat lists have an empty section."""
        out = [(n, "", t) for n in self.flat_names() for t in getattr(self, n)]
        return out + [("domain", s, t) for s, terms in self.domain.items() for t in terms]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), "name string, section string, term string")

    @classmethod
    def from_table(cls, table: DataFrame, **other) -> Lexicon:
        """Lexicon from (name, section, term) rows; the row count is checked first."""
        rows = table.limit(MAX_TERMS + 1).collect()
        if len(rows) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms; match a vocabulary of this size with a join")
        lists: dict[str, list[str]] = {}
        domain: dict[str, list[str]] = {}
        for name, section, term in rows:
            if name == "domain":
                domain.setdefault(section, []).append(term)
            else:
                lists.setdefault(name, []).append(term)
        empty = {n: [] for n in cls.flat_names()}
        return cls(**{**empty, **lists}, domain=domain, **other)


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_in(variable: str, terms: Iterable[str]) -> str:
    """SQL membership test; long lists compile to a hash-set look-up."""
    listed = ", ".join(sql_text(t) for t in terms)
    return f"{variable} IN ({listed})" if listed else "false"


# ---------------------------------------------------------------- file loaders
def load_flat(spark: SparkSession, path: str) -> DataFrame:
    """One term per line; blank lines and lines opening with ``#``, ``;`` or ``[`` are skipped."""
    line = strip(F.col("value"))
    return (
        spark.read.text(path)
        .filter((line != "") & ~F.substring(line, 1, 1).isin("#", ";", "["))
        .select(F.lower(line).alias("term"))
        .distinct()
    )


def load_sections(spark: SparkSession, path: str) -> DataFrame:
    """Terms under ``[section]`` headers; terms before any header belong to ``misc``.

    Each file is read as one row, so the header of a term is found inside the row.
    """
    lines = F.filter(
        F.transform(F.split("value", r"\r?\n"), strip),
        lambda x: (x != "") & ~x.startswith(";"),
    )
    parts = F.transform(
        F.split(F.concat(F.lit("[misc]\n"), F.array_join(lines, "\n")), r"(?m)^(?=\[[^\n]*\]$)"),
        lambda block: F.struct(
            F.lower(F.trim(F.regexp_extract(block, r"^\[([^\n]*)\]", 1))).alias("section"),
            F.filter(
                F.split(F.regexp_replace(block, r"^\[[^\n]*\]\n?", ""), "\n"), lambda t: t != ""
            ).alias("terms"),
        ),
    )
    return (
        spark.read.text(path, wholetext=True)
        .select(F.explode(parts).alias("p"))
        .select(F.col("p.section").alias("section"), F.explode("p.terms").alias("term"))
        .select("section", F.lower("term").alias("term"))
    )


# ------------------------------------------------------------------ stop words
@lru_cache(maxsize=None)
def default_stopwords(language: str) -> tuple[str, ...]:
    """Spark ML's stop-word list for a language name, read from the ML jar."""
    jars = os.path.join(os.path.dirname(pyspark.__file__), "jars")
    for jar in sorted(glob.glob(os.path.join(jars, "spark-mllib_*.jar"))):
        with zipfile.ZipFile(jar) as archive:
            name = f"org/apache/spark/ml/feature/stopwords/{language}.txt"
            if name in archive.namelist():
                text = archive.read(name).decode("utf-8")
                return tuple(dict.fromkeys(w.strip() for w in text.splitlines() if w.strip()))
    from pyspark.ml.feature import StopWordsRemover  # installations without local jars

    return tuple(StopWordsRemover.loadDefaultStopWords(language))


def stopword_rows() -> list[tuple[str, str]]:
    return [(c, w) for c, name in STOPWORD_LANGUAGE.items() for w in default_stopwords(name)]


def content_tokens(tokens: str, lang: str) -> Column:
    """Tokens that hold a word character and are no stop word of the row's language.

    ``tokens`` and ``lang`` name columns; unsupported languages are treated as English.
    """
    code = f"lower(substring_index(coalesce({lang}, 'en'), '-', 1))"
    branches = "".join(
        f" WHEN {sql_text(c)} THEN filter({tokens}, t -> NOT ({sql_in('t', default_stopwords(n))}))"
        for c, n in STOPWORD_LANGUAGE.items() if c != "en"
    )
    english = f"filter({tokens}, t -> NOT ({sql_in('t', default_stopwords('english'))}))"
    chosen = F.expr(f"CASE {code}{branches} ELSE {english} END")
    return F.filter(chosen, lambda t: ((t >= "a") & (t < "{")) | t.rlike(r"(?U)\w"))

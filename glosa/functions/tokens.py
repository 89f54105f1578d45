"""Array-of-token helpers that stay inside one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glosa.functions.text import let


def elements(items: str | Column) -> Column:
    """The array to explode.

    Exploding a bare column makes the optimizer add a size filter, which it then
    pushes below the projection that computes the array: everything behind the
    column would run twice.  An expression is left alone.
    """
    column = F.col(items) if isinstance(items, str) else items
    return F.coalesce(column, F.slice(column, 1, 0))


def positions(marks: Column, mask: int) -> Column:
    """Zero-based positions of the tokens whose mark meets ``mask``."""
    return F.array_compact(F.transform(marks, lambda m, i: F.when(m.bitwiseAND(F.lit(mask)) != 0, i)))


def nonzero(marks: Column) -> Column:
    """Marks of the tokens that belong to any set: usually a small part of a text."""
    return F.filter(marks, lambda m: m != 0)


def count_marked(marks: Column, mask: int) -> Column:
    return F.size(F.filter(marks, lambda m: m.bitwiseAND(F.lit(mask)) != 0))


def marked_words(tokens: Column, marks: Column, mask: int) -> Column:
    """Tokens whose mark meets ``mask``; both arrays must be columns or lambda variables."""
    return F.filter(tokens, lambda t, i: F.get(marks, i).bitwiseAND(F.lit(mask)) != 0)


def around(items: Column, position: Column, before: int, after: int) -> Column:
    """Elements from ``position - before`` to ``position + after``, clamped, the centre included."""
    start = F.greatest(position - before, F.lit(0))
    stop = F.least(position + after + 1, F.size(items))
    return F.slice(items, start + 1, F.greatest(stop - start, F.lit(0)))


def following(items: Column, position: Column, n: int) -> Column:
    """The ``n`` elements after ``position``."""
    return F.slice(items, position + 2, n)


def ngrams(tokens: Column, n: int, separator: str = " ") -> Column:
    """Joined n-grams of one row; empty when the row is shorter than ``n``."""
    if n <= 0:
        return F.array().cast("array<string>")
    if n == 1:
        return tokens

    def build(tk: Column) -> Column:
        heads = F.slice(tk, F.lit(1), F.greatest(F.size(tk) - n + 1, F.lit(0)))
        grams = F.transform(heads, lambda t, i: F.concat_ws(separator, t, *[F.get(tk, i + k) for k in range(1, n)]))
        return F.when(F.size(tk) >= n, grams).otherwise(F.array().cast("array<string>"))

    return let(tokens, build)


def run_lengths(tokens: Column) -> Column:
    """Multiplicity of every distinct token, by sorting the row's tokens once."""

    def build(s: Column) -> Column:
        starts = F.array_compact(
            F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i))
        )
        return let(
            starts,
            lambda st: F.transform(
                st, lambda p, k: F.coalesce(F.get(st, k + 1), F.size(s)) - p
            ),
        )

    return let(F.sort_array(tokens), build)


def term_counts(tokens: Column) -> Column:
    """Array of (term, n) structs, one per distinct token."""

    def build(s: Column) -> Column:
        starts = F.array_compact(
            F.transform(s, lambda t, i: F.when((i == 0) | (F.get(s, i - 1) != t), i))
        )
        return let(
            starts,
            lambda st: F.transform(
                st,
                lambda p, k: F.struct(
                    F.get(s, p).alias("term"),
                    (F.coalesce(F.get(st, k + 1), F.size(s)) - p).alias("n"),
                ),
            ),
        )

    return let(F.sort_array(tokens), build)


def concordance(tokens: Column, word: str, window: int = 5) -> Column:
    """Array of (left, hit, right) around each case-insensitive hit of ``word``."""
    wanted = word.lower()

    def build(tk: Column) -> Column:
        hits = F.array_compact(F.transform(tk, lambda t, i: F.when(F.lower(t) == wanted, i)))
        return F.transform(
            hits,
            lambda i: F.struct(
                i.alias("pos"),
                F.array_join(
                    F.slice(tk, F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window))), " "
                ).alias("left"),
                F.get(tk, i).alias("hit"),
                F.array_join(following(tk, i, window), " ").alias("right"),
            ),
        )

    return let(tokens, build)


def word_contexts(tokens: Column, words: list[str], window: int = 1) -> Column:
    """``left _ right`` around every hit of any listed word; needs two words or more."""
    if len(words) < 2:
        raise ValueError("at least two words are needed")
    wanted = [w.lower() for w in words]

    def build(tk: Column) -> Column:
        hits = F.array_compact(F.transform(tk, lambda t, i: F.when(F.lower(t).isin(*wanted), i)))
        return F.transform(
            hits,
            lambda i: F.array_join(
                F.concat(
                    F.slice(tk, F.greatest(i - window, F.lit(0)) + 1, F.least(i, F.lit(window))),
                    F.array(F.lit("_")),
                    following(tk, i, window),
                ),
                " ",
            ),
        )

    return let(tokens, build)

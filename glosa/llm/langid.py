"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training adds up, inside each task, a matrix (language x hashed n-gram) over all rows;
only its non-zero cells are shuffled and summed.  The model has ``features`` columns and
at most ``MAX_LANGS`` rows whatever the input, and is broadcast on that bound.  Scoring
gathers the log-probabilities of a batch's n-grams and adds them up per document.

Letters are case-folded, everything else counts as one blank, so digits and marks carry
no weight.  Words are padded with blanks.

Defined results: null text or text without a letter is ``und`` with score 0; rows with a
null language do not train; ties go to the alphabetically first language; without any
training row every document is ``und``; repeated rows count as often as they occur; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.llm.buffers import mix, row_ranges, utf8
from glosa.llm.tables import quoted

MAX_LANGS = 512
ORDERS = (2, 3)
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """Code point -> lower-cased letter, or blank; built by rule from the Unicode classes."""
    table = np.full(0x110000, 32, np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ch.lower()
            table[cp] = ord(low[0])
    return table


class Grams:
    """Hashed character n-grams of many texts at once."""

    def __init__(self, features: int) -> None:
        self.features = np.uint64(features)
        self._letters = _letters()

    def of(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature ids, the bounds of each text in them, and which texts have a letter."""
        joined = " " + " ".join(texts) + " "
        points = self._letters[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
        ends = np.cumsum([0] + [len(t) + 1 for t in texts])
        # Runs of blanks become one.
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        place = np.concatenate(([0], np.cumsum(keep)))
        c = points[keep].astype(np.uint64)
        bounds = place[ends]
        ids = []
        owner = []
        for order in ORDERS:
            if len(c) < order:
                continue
            h = c[: len(c) - order + 1].copy()
            for k in range(1, order):
                h = h * np.uint64(0x110000) + c[k : len(c) - order + 1 + k]
            real = c[: len(h)] != 32
            real |= c[1 : len(h) + 1] != 32
            at = np.flatnonzero(real)
            ids.append((mix(h[at] + np.uint64(order << 60)) % self.features).astype(np.int64))
            owner.append(np.searchsorted(bounds, at, side="right") - 1)
        if not ids:
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64), np.zeros(len(texts), bool)
        ids_, owner_ = np.concatenate(ids), np.concatenate(owner)
        inside = owner_ < len(texts)
        ids_, owner_ = ids_[inside], owner_[inside]
        order_ = np.argsort(owner_, kind="stable")
        ids_ = ids_[order_]
        cuts = np.searchsorted(owner_[order_], np.arange(len(texts) + 1))
        letters = np.concatenate(([0], np.cumsum(c != 32)))
        low, high = bounds[:-1], np.maximum(bounds[1:], bounds[:-1])
        return ids_, cuts, letters[np.minimum(high, len(c))] > letters[np.minimum(low, len(c))]


def _pieces(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int]]:
    _, offsets = utf8(batch.column(at))
    yield from row_ranges(offsets)


def train(docs: DataFrame, text: str = "text", lang: str = "lang", features: int = 1 << 15) -> DataFrame:
    """Counts (lang, feature, n) of all rows with a language."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, totals = Grams(features), {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for i, j in _pieces(batch, 1):
                ids, cuts, _ = grams.of(batch.column(1).slice(i, j - i).fill_null("").to_pylist())
                for name in set(langs[i:j]):
                    rows = [r for r in range(j - i) if langs[i + r] == name]
                    mine = np.concatenate([ids[cuts[r] : cuts[r + 1]] for r in rows])
                    if name not in totals:
                        if len(totals) >= MAX_LANGS:
                            raise ValueError(f"more than {MAX_LANGS} languages")
                        totals[name] = np.zeros(features, np.int64)
                    totals[name] += np.bincount(mine, minlength=features)
        for name, n in totals.items():
            at = np.flatnonzero(n)
            # A language without any n-gram still is a class.
            at = at if len(at) else np.zeros(1, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], ["lang", "feature", "n"]
            )

    given = docs.where(quoted(lang).isNotNull()).select(quoted(lang).alias("lang"), quoted(text).alias("text"))
    cells = given.mapInArrow(count, "lang string, feature bigint, n bigint")
    return cells.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def matrix(counts: DataFrame, features: int = 1 << 15, alpha: float = 0.5) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities; at most ``MAX_LANGS * features`` cells reach the driver."""
    rows = counts.groupBy("lang").agg(
        F.collect_list(F.struct("feature", "n")).alias("cells")
    ).orderBy("lang").limit(MAX_LANGS + 1).toArrow().to_pydict()
    names = rows["lang"]
    if len(names) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    table = np.full((len(names), features), alpha)
    for r, cells in enumerate(rows["cells"]):
        for cell in cells:
            table[r, cell["feature"]] += cell["n"]
    return names, (np.log(table) - np.log(table.sum(axis=1, keepdims=True))).astype(np.float32)


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` with lang_pred and score, the posterior of the predicted language under equal priors."""
    names, logp = model
    shared = docs.sparkSession.sparkContext.broadcast(logp)
    schema = docs.select(*[quoted(k) for k in keys]).schema.add("lang_pred", "string").add("score", "double")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        grams = Grams(logp_features)
        for batch in batches:
            for i, j in _pieces(batch, len(keys)):
                some = batch.slice(i, j - i)
                ids, cuts, lettered = grams.of(some.column(len(keys)).fill_null("").to_pylist())
                sums = np.zeros((len(names), len(some)))
                full = np.flatnonzero(np.diff(cuts))
                if len(full):
                    for r in range(len(names)):
                        sums[r, full] = np.add.reduceat(table[r][ids].astype(np.float64), cuts[full])
                known = lettered & bool(names)
                if names:
                    best = sums.argmax(axis=0)
                    share = 1 / np.exp(sums - sums.max(axis=0)).sum(axis=0)
                else:
                    best, share = np.zeros(len(some), int), np.zeros(len(some))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns[: len(keys)],
                     pa.array([names[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                     pa.array(np.where(known, share, 0.0))],
                    [*keys, "lang_pred", "score"],
                )

    logp_features = logp.shape[1]
    given = docs.select(*[quoted(k) for k in keys], quoted(text).alias("".join(["_", *keys])))
    return given.mapInArrow(score, schema)


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 4."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def hold_out(docs: DataFrame, held: int = 2, features: int = 1 << 15) -> DataFrame:
    """Train outside the held-out fold, predict every document of the table."""
    model = matrix(train(docs.where(fold(quoted("doc_id")) != held), features=features), features)
    marked = docs.select(
        quoted("doc_id").alias("doc_id"), (fold(quoted("doc_id")) == held).alias("held_out"), quoted("text").alias("text")
    )
    return predict(marked, model, keys=("doc_id", "held_out"))

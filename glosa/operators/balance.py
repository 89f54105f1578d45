"""Class balance per item: quotas, exact sampling, augmentation and its report."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosa.functions.lexicons import MAX_TERMS
from glosa.functions.text import is_blank, literal_map
from glosa.operators.skew import assign_slots, beyond, cut_places, id_digits, key_digits, portable_key

CATEGORIES = ("positive", "neutral", "negative")
STRATEGIES = ("undersample", "oversample", "hybrid")
COPIES_PER_TASK_ROW = 1000


@dataclass
class Synonyms:
    """Replacement words per language, small enough to live in the plan."""

    table: dict[str, dict[str, list[str]]]

    def __post_init__(self) -> None:
        if sum(len(t) for t in self.table.values()) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} synonym entries")

    @classmethod
    def from_table(cls, rows: DataFrame) -> Synonyms:
        """From (lang, term, alt) rows, alternatives in alphabetical order."""
        got = rows.select("lang", "term", "alt").distinct().limit(MAX_TERMS + 1).collect()
        if len(got) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} synonym entries")
        table: dict[str, dict[str, list[str]]] = {}
        for lang, term, alt in sorted(tuple(r) for r in got):
            table.setdefault(lang, {}).setdefault(term, []).append(alt)
        return cls(table)

    def variant(self, text: Column, lang: Column, row_id: Column, number: Column) -> Column:
        """Variant ``number`` of a text: every listed word replaced by one alternative.

        The pick depends on row id, variant number and word position only.
        Unsupported languages use the English list.
        """
        branches = None
        words = F.split(text, " ")
        for code, terms in sorted(self.table.items(), key=lambda kv: kv[0] == "en"):
            alts = literal_map({t: "\x01".join(a) for t, a in terms.items()})

            def swap(w: Column, i: Column, terms=terms, alts=alts) -> Column:
                options = F.split(F.element_at(alts, F.lower(w)), "\x01")
                pick = F.pmod(row_id * 31 + number * 17 + i * 7, F.size(options).cast("bigint")).cast("int")
                return F.when(F.lower(w).isin(*terms), F.get(options, pick)).otherwise(w)

            changed = F.array_join(F.transform(words, _two_args(swap)), " ")
            branches = F.when(lang == code, changed) if branches is None else branches.when(lang == code, changed)
        if "en" in self.table:
            return branches.otherwise(changed)
        return branches.otherwise(text)


def _two_args(fn: Callable) -> Callable[[Column, Column], Column]:
    return lambda w, i: fn(w, i)


def augment(text: Column, lang: Column, row_id: Column, synonyms: Synonyms, n: int = 1) -> Column:
    """Up to ``n`` distinct variants that differ from the original; none for short texts."""
    made = F.transform(
        F.sequence(F.lit(0), F.lit(max(1, n) - 1)),
        lambda v: F.trim(synonyms.variant(text, lang, row_id, v.cast("bigint"))),
    )
    useful = F.array_distinct(F.filter(made, lambda v: (v != "") & (v != F.trim(text))))
    return F.when(F.length(F.trim(F.coalesce(text, F.lit("")))) < 5, F.array().cast("array<string>")).otherwise(useful)


def targets(
    df: DataFrame,
    strategy: str,
    game: str = "game_id",
    label: str = "label",
    categories: tuple[str, ...] = CATEGORIES,
    min_samples: int = 30,
    target_ratio: float | None = None,
) -> DataFrame:
    """Per (item, category): present count ``n`` and the ``target`` of the item.

    Items without any labelled row have no target and are left as they are.
    """
    counts = df.filter(F.col(label).isin(*categories)).groupBy(game, label).agg(F.count(F.lit(1)).alias("n"))
    return targets_of(counts, strategy, game, min_samples, target_ratio)


def targets_of(
    counts: DataFrame, strategy: str, game: str = "game_id", min_samples: int = 30, target_ratio: float | None = None
) -> DataFrame:
    """``targets`` from the counted rows ``n`` of every (item, category)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    spread = counts.groupBy(F.col(game).alias("_g")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    if strategy == "undersample":
        target = F.col("lo")
    elif strategy == "oversample":
        target = F.col("hi")
    else:
        gap = F.col("hi") / F.greatest("lo", F.lit(1))
        ladder = F.when(gap > 10, 0.5).when(gap > 5, 0.6).when(gap > 2, 0.75).otherwise(1.0)
        ratio = F.lit(target_ratio) if target_ratio is not None else ladder
        target = F.greatest(F.floor(F.col("hi") * ratio), F.lit(min_samples).cast("bigint"))
    spread = spread.select("_g", target.alias("target"))
    return counts.join(spread, F.col(game).eqNullSafe(F.col("_g"))).drop("_g")


def balance(
    df: DataFrame,
    strategy: str = "oversample",
    game: str = "game_id",
    label: str = "label",
    text: str = "comment",
    row_id: str = "review_id",
    categories: tuple[str, ...] = CATEGORIES,
    min_samples: int = 30,
    target_ratio: float | None = None,
    synonyms: Synonyms | None = None,
    seed: int = 42,
) -> DataFrame:
    """Balance the categories of every item in one plan.

    A category above its target is sampled down to it without replacement
    (undersample, hybrid).  A category below grows only when ``synonyms`` are
    given, by variants of its own texts; a text without replaceable words yields
    none, so a shortfall is possible.  Blank comments and unlabelled rows are
    dropped, except in items that have no labelled row at all.

    One pass counts, one finds the keys at the quotas, one marks the rows (and one makes the variants).
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    key = portable_key(F.col(row_id), seed)

    def quotas(counts: DataFrame) -> DataFrame:
        want = targets_of(counts, strategy, game, min_samples, target_ratio)
        keep = F.when((F.col("n") > F.col("target")) & F.lit(strategy != "oversample"), F.col("target")).otherwise(F.col("n"))
        needed = F.greatest(F.col("target") - F.col("n"), F.lit(0))
        grown = (needed % F.col("n"), F.floor(needed / F.col("n"))) if synonyms is not None else (F.lit(0).cast("bigint"),) * 2
        return want.select(game, label, F.array(keep, grown[0]).alias("cuts"), grown[1].alias("each"))

    labelled = df.filter(F.col(label).isin(*categories))
    places = cut_places(labelled, [game, label], quotas, key, F.col(row_id), key_digits(key))
    # All categories of an item in one row: the rows meet their quotas by item alone.
    plan = F.collect_list(F.struct(F.col(label).alias("label"), "cuts", "each", "edges")).alias("_plan")
    per_item = places.groupBy(F.col(game).alias("_g")).agg(plan)
    marked = df.join(per_item, F.col(game).eqNullSafe(F.col("_g")), "left").drop("_g").withColumn(
        "_own", F.get(F.filter("_plan", lambda p: p["label"] == F.col(label)), F.lit(0)))

    def within(cut: int) -> Column:
        return ~beyond(F.col("_own.cuts")[cut], key, F.col(row_id), F.col("_own.edges"))

    no_source = F.lit(None).cast("bigint")
    chosen = F.col("_own").isNotNull() & within(0) & ~is_blank(F.col(text))
    # Items without any labelled row have no plan and are returned whole.
    out = marked.filter(F.col("_plan").isNull() | chosen).select(
        *df.columns, F.lit(False).alias("is_augmented"), no_source.alias("augmented_from"))
    if synonyms is None:
        return out
    copies = F.col("_own.each") + F.when(within(1), 1).otherwise(0)
    base = marked.withColumn("_copies", copies).filter("_copies > 0").select(*df.columns, "_copies")
    return out.unionByName(_variants(base, label, text, row_id, synonyms).select(*out.columns))


def _variants(base: DataFrame, label: str, text: str, row_id: str, synonyms: Synonyms) -> DataFrame:
    """``_copies`` numbered variants of every row, without those that are blank or equal to the text."""
    # A rare text may be copied very often: its copies are cut into chunks and
    # the chunks spread before they are written out.
    chunks = base.withColumn("_from", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("_copies") - 1, F.lit(COPIES_PER_TASK_ROW).cast("bigint")))).repartition(F.col(row_id), F.col("_from"))
    last = F.least(F.col("_from") + COPIES_PER_TASK_ROW, F.col("_copies")) - 1
    numbered = chunks.withColumn("_v", F.explode(F.sequence("_from", last)))
    lang = F.col("lang") if "lang" in base.columns else F.lit("en")
    made = numbered.withColumn("_new", F.trim(synonyms.variant(F.trim(text), lang, F.col(row_id), F.col("_v"))))
    return (
        made.filter((F.length(F.trim(text)) >= 5) & (F.col("_new") != "") & (F.col("_new") != F.trim(text)))
        .withColumn(text, F.col("_new"))
        .withColumn("is_augmented", F.lit(True))
        .withColumn("augmented_from", F.col(row_id).cast("bigint"))
    )


def balance_report(
    before: DataFrame, after: DataFrame, game: str = "game_id", label: str = "label",
    categories: tuple[str, ...] = CATEGORIES,
) -> DataFrame:
    """Per-item counts before and after by category, totals, augmented and subsampled rows."""

    def counted(df: DataFrame, suffix: str) -> list[Column]:
        return [
            F.count_if(F.col(label) == c).alias(f"{c}_{suffix}") for c in categories
        ]

    b = before.groupBy(game).agg(*counted(before, "before"))
    a = after.groupBy(F.col(game).alias("_g")).agg(
        *counted(after, "after"), F.count(F.lit(1)).alias("total_after"),
        F.count_if("is_augmented").alias("augmented_count"),
    )
    joined = b.join(a, F.col(game).eqNullSafe(F.col("_g")), "left").drop("_g").na.fill(0)
    total_before = sum((F.col(f"{c}_before") for c in categories), F.lit(0).cast("bigint"))
    cut = sum(
        (F.greatest(F.col(f"{c}_before") - F.col(f"{c}_after"), F.lit(0)) for c in categories),
        F.lit(0).cast("bigint"),
    )
    return joined.withColumn("total_before", total_before).withColumn("subsampled_count", cut)


def global_balance(report: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """Totals of a per-item report and the max/min ratio over categories still present."""
    sums = [F.sum(c).alias(c) for c in report.columns if c != report.columns[0]]
    total = report.agg(*sums)
    after = F.array(*[F.col(f"{c}_after") for c in categories])
    present = F.filter(after, lambda n: n > 0)
    ratio = F.when(
        F.size(present) > 0, F.array_max(present) / F.greatest(F.array_min(present), F.lit(1))
    ).otherwise(0.0)
    return total.withColumn("balance_ratio_max_min", ratio)


def rating_cap(
    df: DataFrame, game: str = "game_id", rating: str = "rating", ts: str = "ts", row_id: str = "review_id",
    text: str = "comment",
) -> DataFrame:
    """Equal number of commented reviews per whole rating, double for 5 and 6, newest first.

    Items with no review at rating 1, 2 or 10 are skipped; the smallest of
    those three counts is the base limit.
    """
    star = F.floor(rating).cast("bigint")
    rated = df.filter(~is_blank(F.col(text)) & star.between(1, 10)).withColumn("star", star)

    def quotas(counts: DataFrame) -> DataFrame:
        probes = counts.groupBy(game).agg(*[F.sum(F.when(F.col("star") == r, F.col("n")).otherwise(0)).alias(f"n{r}") for r in (1, 2, 10)])
        base = probes.filter("n1 > 0 AND n2 > 0 AND n10 > 0").select(game, F.least("n1", "n2", "n10").alias("base"))
        return base.withColumn("star", F.explode(F.sequence(F.lit(1), F.lit(10)))).select(
            game, F.col("star").cast("bigint").alias("star"),
            F.array(F.when(F.col("star").isin(5, 6), F.col("base") * 2).otherwise(F.col("base"))).alias("cuts"),
        )

    newest = -F.coalesce(F.col(ts), F.lit(0))
    # Rows without a time, or of one second, are told apart by their ids.
    digits = [F.floor(newest / 86400).cast("bigint"), F.pmod(newest, F.lit(86400)).cast("bigint"), *id_digits(F.col(row_id))[:2]]
    slots = assign_slots(rated, [game, "star"], quotas, newest, F.col(row_id), digits, "_slot")
    return slots.filter("_slot = 0").drop("_slot")


def shuffled(df: DataFrame, row_id: str = "review_id", seed: int = 42) -> DataFrame:
    """Reproducible random order, for an export."""
    key = F.xxhash64(F.lit(seed), F.col(row_id))
    return df.orderBy(key, row_id)


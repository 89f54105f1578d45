"""SpotSigs fingerprints: chains of content words that follow common words.

Every common word (the anchor) with the next ``CHAIN`` content words among the ``REACH``
words behind it is a spot signature; a document's fingerprint is the set of its hashed
signatures.  Boilerplate has few running sentences and so few spots.  Two fingerprints are
compared by Jaccard; ``near_pairs`` partitions the sets by length, so that only sets whose
lengths can reach the threshold meet, and prunes by the rarest signatures.
DataFrame operations only.

Defined results: null text is empty; a text without any chain is fingerprinted by its
distinct words, one without words by its whole text, so equal texts always have equal
fingerprints; two fingerprints are never both empty.  For ``with_edits`` documents are
ordered by descending id (null last), ties by a hash of the text; rows equal in id and
text are one document and get the same result; a single document is its own next one; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from glosa.llm.tables import quoted
from glosa.session import cut_lineage

#: Common words of English, German, French and Spanish.
ANCHORS = sorted(set((
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "das dem den der des die ein eine einer für im ist mit nicht sich und von zu "
    "au aux dans de des du elle en est et il la le les ou par pas pour que qui une un "
    "al como con del el en es la las lo los mi no por que se su una y"
).split()))
CHAIN, REACH = 2, 8
NO_ID = -(1 << 63)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def spots(text: Column) -> Column:
    """Sorted distinct 32-bit signatures of a text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def chains(ws: Column) -> Column:
        def at(word: Column, i: Column) -> Column:
            behind = F.filter(F.slice(ws, i + 2, REACH), lambda w: ~w.isin(ANCHORS))
            return F.when(word.isin(ANCHORS), F.concat(F.array(word), F.slice(behind, 1, CHAIN)))

        found = F.transform(F.filter(F.transform(ws, at), lambda c: F.size(c) == CHAIN + 1), lambda c: F.hash(c))
        return let(found, lambda s: F.when(F.size(s) > 0, s).when(F.size(ws) > 0, F.transform(ws, lambda w: F.hash(w))).otherwise(
            F.array(F.hash(text))))

    return F.sort_array(F.array_distinct(let(words, chains)))


def as_string(signatures: Column) -> Column:
    return F.concat_ws(" ", F.transform(signatures, lambda h: F.hex(h.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF)))))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets."""
    return let(F.size(F.array_intersect(a, b)), lambda n: n / (F.size(a) + F.size(b) - n))


def _order(rows: DataFrame) -> DataFrame:
    """(k, u, chars) -> (k, u, before_k, before_u, before_chars): the document in front of each, cyclic.

    Keys are range-partitioned; inside a partition a window does, and between
    partitions one row per partition.
    """
    keys = rows.groupBy("k", "u").agg(F.max("chars").alias("chars")).repartitionByRange(F.desc("k"), "u").withColumn(
        "part", F.spark_partition_id())
    keys = cut_lineage(keys)
    w = Window.partitionBy("part").orderBy(F.desc("k"), "u")
    here = F.struct("k", "u", "chars")
    inner = keys.select("*", F.lag(here).over(w).alias("before"))
    ends = keys.groupBy("part").agg(F.max_by(here, F.struct(-F.col("k").cast("decimal(20,0)"), "u")).alias("end"),
                                    F.max("k").alias("top"), F.min_by("u", F.struct(-F.col("k").cast("decimal(20,0)"), "u")).alias("top_u"))
    line = Window.orderBy(F.desc("top"), "top_u")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select("part", F.coalesce(F.lag("end").over(line), F.last("end").over(whole)).alias("wrap"))
    found = inner.join(ends, "part").select("k", "u", F.coalesce("before", "wrap").alias("before"))
    return cut_lineage(found.select(
        "k", "u", F.col("before.k").alias("before_k"), F.col("before.u").alias("before_u"), F.col("before.chars").alias("before_chars")))


def with_edits(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, and their likeness.

    The last third of a text is replaced by the beginning of the next document.
    """
    body = F.coalesce(quoted(text), F.lit(""))
    rows = docs.select(F.coalesce(quoted(key).cast("bigint"), F.lit(NO_ID)).alias("k"), F.xxhash64(body).alias("u"), body.alias("text"))
    order = _order(rows.select("k", "u", F.length("text").alias("chars")))
    own = rows.join(order, ["k", "u"]).dropDuplicates(["k", "u"])
    sent = own.select(
        F.col("before_k").alias("k"), F.col("before_u").alias("u"),
        F.expr("substring(text, 1, before_chars DIV 3)").alias("head"), spots(F.col("text")).alias("next"))
    both = rows.join(sent, ["k", "u"])
    n = F.length("text")
    edited = both.select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), n.cast("bigint").alias("n_chars"), "text", "next",
        F.expr("concat(substring(text, 1, length(text) - length(text) DIV 3), head)").alias("edited"))
    signed = edited.select(
        "doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        spots(F.col("text")).alias("a"), spots(F.col("edited")).alias("b"), "next")
    return signed.select(
        "doc_id", "n_chars", "edited_sha256", as_string(F.col("a")).alias("fingerprint"), as_string(F.col("b")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("next")).alias("near_next"))


def near_pairs(docs: DataFrame, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(a, b, likeness) between different fingerprints, named by the least id that has them.

    Sets are put into length partitions of ratio ``percent``; a pair at the threshold lies in the
    same or in neighbouring partitions and shares one of the rarest
    ``n - ceil(n * percent / 100) + 1`` signatures of either set.
    """
    body = F.coalesce(quoted(text), F.lit(""))
    sets = cut_lineage(docs.select(quoted(key).alias("id"), spots(body).alias("s")).groupBy("s").agg(F.min("id").alias("id")))
    each = sets.select("id", F.size("s").alias("n"), F.explode("s").alias("t"))
    often = cut_lineage(each.groupBy("t").agg(F.count("*").alias("df")))
    ranked = each.join(often, "t").groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "t"))).alias("by"))
    prefix = ranked.select("id", "n", F.explode(F.expr(f"slice(by, 1, n - CAST(ceil(n * {percent} / 100) AS INT) + 1)")).alias("x")).select(
        "id", "n", F.col("x.t").alias("t"), F.expr(f"CAST(floor(ln(n) / -ln({percent} / 100)) AS INT)").alias("band"))
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("na"), "t", F.explode(F.array("band", F.col("band") + 1)).alias("band"))
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "t", "band")
    pairs = left.join(right, ["t", "band"]).where(
        f"a <> b AND na <= nb AND (na < nb OR a < b) AND 100 * na >= {percent} * nb").select("a", "b").distinct()
    x, y = sets.toDF("sa", "a"), sets.toDF("sb", "b")
    return pairs.join(x, "a").join(y, "b").select("a", "b", likeness(F.col("sa"), F.col("sb")).alias("likeness")).where(
        F.col("likeness") * 100 >= percent)
